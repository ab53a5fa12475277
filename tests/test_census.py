"""Edge cases of the census that the tables do not hold."""

from __future__ import annotations

import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from siltstone.functions.html import generator
from siltstone.functions.urls import netloc, url_hash
from siltstone.operators import dashboard, discover, reports, store
from siltstone.operators.classify import classified, known_categories, signals
from siltstone.operators.links import links_of, without_excluded
from siltstone.plans import budgets, census
from siltstone.plans.dims import excluded_domains, tld_buckets
from siltstone.plans.values import BUCKETS, COUNTRIES, ENGINES, EXCLUDED
from siltstone.sources import candidates, index, warc
from siltstone.streaming.incremental import discover_by_part, emitted

INDEX = "part int, row_in_part int, url string, url_host_tld string, url_host_registered_domain string, fetch_status int, content_mime_detected string, warc_filename string, warc_record_offset long, warc_record_length long"
CO = tld_buckets()["co"]


def test_fixed_values():
    assert (len(ENGINES), len(signals()), len(BUCKETS), len(tld_buckets()), len(COUNTRIES), len(EXCLUDED)) == (61, 198, 37, 188, 189, 23)
    assert len(known_categories()) == 12
    assert "com" in tld_buckets() and "com" not in COUNTRIES


def test_tld_in_two_buckets_is_an_error():
    with pytest.raises(ValueError, match="two buckets"):
        tld_buckets({"a": "co cl", "b": ["CL"]})


GENERATORS = [
    ("", ""),
    ('<head><meta name="generator" content="WordPress 6"></head>', "wordpress 6"),
    ('<meta content="Joomla" name=generator>', "joomla"),
    ("<meta name='generator' content=Drupal><meta name=generator content='X'>", "x"),
    ('<meta name="generator" content="">', ""),
    ('<head></head><meta name="generator" content="Late">', ""),
    ('<META\nNAME = " Generator" CONTENT="A>', "a"),
    ('<meta name =generator content="Nbsp">', "nbsp"),
    ('<metax name="generator" content="No">', ""),
    ("x" * 400_000 + '<meta name="generator" content="Far">', ""),
]


def test_generator(spark):
    rows = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(GENERATORS)], "i int, html string")
    got = {r.i: r.g for r in rows.select("i", generator(F.col("html")).alias("g")).collect()}
    assert got == {i: g for i, (_, g) in enumerate(GENERATORS)}


def test_classifier_order(spark):
    rows = [
        ("a", '<meta name="generator" content="WordPress"> wp-content/plugins/woocommerce', "http://x/"),
        ("b", "", "http://x/showthread.php?tid=1"),  # an earlier engine has the shorter signal
        ("c", "POWERED BY PHPBB", "http://x/threads/"),
        ("d", "nothing", "http://x/"),
        ("e", None, None),
    ]
    got = {r.k: (r.engine_category, r.engine_name, r.signal) for r in classified(spark.createDataFrame(rows, "k string, html string, url string")).collect()}
    assert got["a"] == ("E-commerce", "WooCommerce", "html:wp-content/plugins/woocommerce")
    assert got["b"] == ("Forum", "vBulletin", "url:showthread.php")
    assert got["c"] == ("Forum", "phpBB", "html:powered by phpbb")
    assert got["d"] == got["e"] == (None, None, None)


def test_netloc(spark):
    urls = ["http://User:p@EX.com:80/a", "https://a_b.com", "//h/x", "mailto:x", "", None, "http://münchen.de/", "ftp://[::1]/x", "nourl"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(netloc(F.col("u"))).collect()]
    assert got == ["user:p@ex.com:80", "a_b.com", "h", "", "", "", "münchen.de", "[::1]", ""]


def test_excluded_suffixes(spark):
    hosts = ["x.com", "www.x.com", "notx.com", "x.com:80", "", None]
    rows = spark.createDataFrame([(h,) for h in hosts], "h string")
    assert {r.h for r in without_excluded(rows, "h", excluded_domains()).collect()} == {"notx.com", "x.com:80", "", None}


def test_links():
    html = '<a href=" /a ">A <b>b</b></a><a href="#f">f</a><a href="javascript:x">j</a><a href="?q">q</a><a href="//h/y">h</a><a>none</a><a href="HTTP://X/">u</a><a href="http://[bad">b</a><a href="mailto:x">m</a><a href="">e</a>'
    assert links_of(html, "https://s.com/p/i?z") == [("https://s.com/a", "Ab"), ("https://s.com/p/i?q", "q"), ("https://h/y", "h")]
    assert ("HTTP://X/", "u") not in links_of(html, "https://s.com/")
    assert links_of(f'<a href="http://x/">{"y" * 300}</a>', "http://s/")[0][1] == "y" * 200


def test_url_hash_of_a_long_url(spark):
    url = "https://example.test/" + "x" * 3000
    got = spark.createDataFrame([(url,)], "u string").select(url_hash(F.col("u"))).first()[0]
    assert bytes(got) == hashlib.sha256(url.encode()).digest()


def index_frame(spark, rows):
    return spark.createDataFrame([(p, i, f"http://{d}/{p}/{i}", "co", d, 200, "text/html", "f", i, 1) for p, i, d in rows], INDEX)


def test_both_modes_of_discovery_differ_where_the_cap_loses_rows(spark, tmp_path):
    rows = index_frame(spark, [(0, 0, "d1.co"), (0, 1, "d1.co"), (0, 2, "d2.co")])
    everywhere = discover.discover(rows, {CO: 2}, excluded_domains(), 1)
    assert {r.url_host_registered_domain for r in everywhere.collect()} == {"d1.co", "d2.co"}
    rows.coalesce(1).write.parquet(f"{tmp_path}/index")
    by_part = discover_by_part(spark, f"{tmp_path}/index", INDEX, f"{tmp_path}/out", {CO: 2}, excluded_domains(), max_per_domain=1)
    assert [r.url_host_registered_domain for r in by_part.collect()] == ["d1.co"]


def test_discovery_by_part_resumes_with_the_first_budgets(spark, tmp_path):
    for part in range(2):
        index_frame(spark, [(part, i, f"d{i % 2}.co") for i in range(3)]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/index")
    out = f"{tmp_path}/out"
    run = lambda budget: discover_by_part(spark, f"{tmp_path}/index", INDEX, out, {CO: budget}, excluded_domains(), max_per_domain=3).count()
    assert run(5) == 5
    index_frame(spark, [(2, i, f"e{i}.co") for i in range(3)]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/index")
    assert run(100) == 5  # the budget of the first run is used up
    assert emitted(spark, out).count() == 5


def test_budget_edges(spark):
    rows = index_frame(spark, [(p, i, f"d{i}.co") for p in range(3) for i in range(4)])
    for budget in (0, 1, 4, 5, 11, 12, 50):
        got = discover.discover(rows, {CO: budget}, excluded_domains()).collect()
        assert len(got) == min(budget, 12)
        assert {r.url for r in got} == {f"http://d{i}.co/{p}/{i}" for p, i in [(p, i) for p in range(3) for i in range(4)][:budget]}


def test_budgets():
    assert budgets.allocate_budget({"a": 1, "b": 1, "c": 1}, 10) == {"a": 3, "b": 3, "c": 4}
    assert budgets.allocate_budget({}, 5) == {}
    assert budgets.jdbc_options("mysql://reader:a%2Fb%3A1@db.internal.test:4406/census") == {
        "url": "jdbc:mysql://db.internal.test:4406/census", "user": "reader", "password": "a/b:1", "driver": "com.mysql.cj.jdbc.Driver",
    }
    with pytest.raises(ValueError):
        budgets.jdbc_options("sqlite:///x")
    assert budgets.settings({"_x": 1, "comment2": 2, "workers": 3, "crawl": "a"}, {"PIPELINE_WORKERS": "9"}, crawl="b", none=None) == {"workers": "9", "crawl": "b"}


def page(spark, *rows):
    columns = "url string, domain string, crawl string, timestamp string, tld string, country string, bucket string, engine_category string, engine_name string, outlink_count int"
    return spark.createDataFrame([tuple(r) + (None,) * (10 - len(r)) for r in rows], columns)


def test_store_is_idempotent(spark, tmp_path):
    s = store.CensusStore(spark, str(tmp_path))
    assert s.pages.count() == 0
    p = page(spark, ("u1", "a", "c", ""), ("u1", "b", "c", ""), ("u2", None, "c", ""))
    s.save_pages(p)
    s.save_pages(p)
    assert [(r.url, r.domain) for r in s.pages.orderBy("url").collect()] == [("u1", "a"), ("u2", "")]
    assert s.pages.where("fetched_at is null").count() == 0
    links = spark.createDataFrame([("u1", "https://Target.test/x", "t")], "source_url string, target_url string, anchor_text string")
    s.save_links(links)
    assert [r.target_domain for r in s.links.collect()] == ["target.test"]
    assert s.query("SELECT count(*) FROM pages p JOIN links l ON p.url = l.source_url WHERE p.url = ?", ["u1"]).first()[0] == 1


def test_merge_and_migration(spark):
    merged = store.merge_pages([page(spark, ("u", "first")), page(spark, ("u", "second"), ("v", "second"))])
    assert {(r.url, r.domain) for r in merged.collect()} == {("u", "first"), ("v", "second")}
    links = spark.createDataFrame([("s", "t", "d", "a")], store.LINK)
    assert (store.merge_links([links, links]).count(), store.merge_links([links, links], dedup=True).count()) == (2, 1)
    with pytest.raises(ValueError, match="crawl"):
        store.coerced(page(spark).drop("crawl"))


def test_reports_on_no_pages(spark):
    pages, links = page(spark), spark.createDataFrame([], store.LINK)
    for name in reports.REPORTS:
        rows = reports.report(name, pages, links).collect()
        assert len(rows) == (name in ("summary", "unclassified-rate"))
    assert reports.report("unclassified-rate", pages, links).first()["unclassified_pct"] is None
    assert dashboard.totals(pages).first()["classified_pct"] is None
    assert dashboard.document(pages)["buckets"] == []


def test_dashboard_document(spark, tmp_path):
    pages = page(spark, ("1", "a", "", "", "co", "C", "B", "CMS", "X"), ("2", "a", "", "", "co", "C", "B", "Forum", "Y"), ("3", "b", "", "", "co", "C", "B"))
    dashboard.export(pages, f"{tmp_path}/d.json")
    doc = json.loads((tmp_path / "d.json").read_text())
    assert (doc["pages"], doc["domains"], doc["classified_pct"]) == (3, 2, 67)
    assert doc["buckets"] == [{"name": "B", "domains": 2, "cats": {"CMS": 1}, "top": [["X", 1], ["Y", 1]]}]


def record(body: bytes, kind: bytes = b"response", mime: bytes = b"text/html", extra: bytes = b"") -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: " + mime + b"\r\n" + extra + b"\r\n" + body
    return gzip.compress(b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nContent-Length: " + str(len(http)).encode() + b"\r\n\r\n" + http + b"\r\n\r\n")


def test_warc_records():
    assert warc.html_of(record(b"<p>caf\xc3\xa9\xff")) == "<p>café�"
    assert warc.html_of(record(b"x", b"request") + record(b"y")) == "y"
    assert warc.html_of(record(b"x", mime=b"image/png")) is None
    assert warc.html_of(record(gzip.compress(b"zipped"), extra=b"Content-Encoding: gzip\r\n")) == "zipped"
    assert warc.html_of(record(b"5\r\nchunk\r\n0\r\n\r\n", extra=b"Transfer-Encoding: chunked\r\n")) == "chunk"
    assert warc.html_of(b"") is None


def test_the_whole_run(spark, tmp_path):
    pages = {"a.co": b"<p>Powered by phpBB <a href='https://t.org/'>t</a><a href='https://x.com/'>no</a>", "b.co": b"plain"}
    data, rows = b"", []
    for host, body in pages.items():
        rec = record(body)
        rows.append((0, len(rows), f"http://{host}/", "co", host, 200, "text/html", "f.warc.gz", len(data), len(rec)))
        data += rec
    rows.append((0, 9, "http://c.co/", "co", "c.co", 200, "text/html", "missing", 0, 5))
    (tmp_path / "f.warc.gz").write_bytes(data)
    s = store.CensusStore(spark, f"{tmp_path}/store")
    frame = spark.createDataFrame(rows, INDEX)
    results = {r.url: r.ok for r in census.run_census(frame, s, f"file://{tmp_path}", {CO: 10}, "CRAWL", store_links=True).collect()}
    assert results == {"http://a.co/": True, "http://b.co/": True, "http://c.co/": False}
    assert {(r.url, r.engine_name, r.outlink_count, r.country) for r in s.pages.collect()} == {("http://a.co/", "phpBB", 1, "Colombia"), ("http://b.co/", None, 0, "Colombia")}
    assert [r.target_url for r in s.links.collect()] == ["https://t.org/"]


def test_sources(spark, tmp_path):
    (tmp_path / "paths.gz").write_bytes(gzip.compress(b"x/subset=warc/1\n\nx/subset=robots/2\nx/subset=warc/3\n"))
    assert [tuple(r) for r in index.index_parts(spark, f"{tmp_path}/paths.gz", "http://b/").collect()] == [(0, "http://b/x/subset=warc/1"), (1, "http://b/x/subset=warc/3")]
    (tmp_path / "cdx.json").write_text('{"url": "u", "status": "200", "mime": "text/html", "offset": "5"}\n\nbroken\n{"url": "v", "status": "404", "mime": "text/html"}\n')
    rows = index.read_cdx(spark, f"{tmp_path}/cdx.json")
    assert [(r.url, r.offset) for r in rows.orderBy("url").collect()] == [("u", 5), ("v", None)]
    assert [r.url for r in index.html_records(rows).collect()] == ["u"]
    assert index.read_cdx_domains(spark, [("a", f"{tmp_path}/cdx.json"), ("b", f"{tmp_path}/cdx.json")], 1).count() == 2
    found = spark.createDataFrame([("u", "co", "d", "b", "f", 1, 2)], candidates.CANDIDATE)
    candidates.write_candidates(found, f"{tmp_path}/c")
    candidates.write_candidates(found, f"{tmp_path}/c", append=True)
    assert candidates.read_candidates(spark, f"{tmp_path}/c").count() == 2
    found.select(F.lit("u").alias("url"), F.lit(200).alias("fetch_status")).write.parquet(f"{tmp_path}/i")
    assert index.scan_index(spark, f"{tmp_path}/i").select("row_in_part").first()[0] == 0


def test_domain_mode(spark):
    rows = census.input_patterns(spark.createDataFrame([("a.co",), ("*.b.co",), (" ",), ("www.x.com",)], "domain string"))
    assert {(r.domain, r.pattern) for r in rows.collect()} == {("a.co", "a.co/*"), ("*.b.co", "*.b.co")}


def test_stream_of_pages_is_classified(spark, tmp_path):
    from siltstone.streaming.incremental import classify_stream

    spark.createDataFrame([("http://a.co/", "co", "Powered by phpBB"), ("http://b.co/", "co", "")], "url string, tld string, html string").write.parquet(f"{tmp_path}/in")
    stream = classify_stream(spark.readStream.schema("url string, tld string, html string").parquet(f"{tmp_path}/in"))
    query = stream.writeStream.format("memory").queryName("classified_pages").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {(r.url, r.engine_name) for r in spark.table("classified_pages").collect()} == {("http://a.co/", "phpBB"), ("http://b.co/", None)}


def test_command_line(spark, tmp_path):
    from siltstone.cli import budgets_of, main

    rec = record(b"<title>T</title>Powered by phpBB")
    (tmp_path / "f").write_bytes(rec)
    rows = [(f"http://{d}/", "co", d, 200, "text/html", "f", 0, len(rec)) for d in ("a.co", "b.co", "x.com")]
    spark.createDataFrame(rows, index.INDEX).coalesce(1).write.parquet(f"{tmp_path}/index")
    (tmp_path / "config.json").write_text(json.dumps({"comment": "x", "countries": "de,co", "total_limit": 10, "index": "overridden"}))
    found, kept = f"{tmp_path}/found", f"{tmp_path}/store"
    out = main(["discover", "--config", f"{tmp_path}/config.json", "--index", f"{tmp_path}/index", "--candidates-file", found], spark)
    assert [tuple(r) for r in out.collect()] == [("co", 2)]
    assert main(["fetch", "--candidates-file", found, "--warc-root", f"file://{tmp_path}", "--store", kept, "--crawl", "C"], spark).count() == 0
    assert [tuple(r) for r in main(["report", "--store", kept, "--report", "engine-distribution"], spark).collect()] == [("Forum", 2)]
    assert main(["report", "--store", kept, "--sql", "SELECT count(*) FROM pages"], spark).first()[0] == 2
    main(["merge", f"{tmp_path}/merged", kept, kept], spark)
    main(["dashboard", "--store", f"{tmp_path}/merged", "--out", f"{tmp_path}/d.json"], spark)
    assert json.loads((tmp_path / "d.json").read_text())["pages"] == 2
    seen = main(["preview", "--candidates-file", found, "--warc-root", f"file://{tmp_path}", "-n", "1", "--save", f"{tmp_path}/html"], spark)
    assert [r.title for r in seen.collect()] == ["T"] and (tmp_path / "html/preview_1.html").exists()
    with pytest.raises(SystemExit):
        budgets_of({})


# --- plans: what runs once, and what reaches the scan ----------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def test_pages_are_parsed_and_classified_once(spark):
    from siltstone.plans.queries import QUERIES

    for name, most in (("link_facts", 1), ("report_engine_share_by_bucket", 1), ("report_platform_sites", 1), ("report_top_domains", 1), ("page_facts", 2)):
        optimised, _ = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert optimised.count("ArrowEvalPython") == most, (name, optimised)


def test_discovery_scans_only_domains_with_a_budget(spark, tmp_path):
    index_frame(spark, [(0, 0, "d1.co")]).drop("part", "row_in_part").write.parquet(f"{tmp_path}/index")
    found = discover.discover(index.scan_index(spark, f"{tmp_path}/index"), {CO: 2}, excluded_domains(), 1)
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    _, physical = plan_of(found)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = [line for line in physical.splitlines() if "PushedFilters" in line]
    assert pushed and all("EqualTo(fetch_status,200)" in line and "url_host_tld" in line.split("PushedFilters")[1].split("ReadSchema")[0] for line in pushed)
    assert found.count() == 1


def test_rows_without_a_domain_share_one_cap(spark):
    rows = spark.createDataFrame([(0, i, f"u{i}", t, None, 200, "text/html", "f", i, 1) for i, t in enumerate(["co", "co", "ke", "ke"])], INDEX)
    assert discover.discover(rows, {CO: 9, tld_buckets()["ke"]: 9}, excluded_domains(), 3).count() == 3


def test_by_part_stops_when_budgets_are_used_up(spark, tmp_path):
    for part in range(3):
        index_frame(spark, [(part, i, f"d{i}.co") for i in range(3)]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/index")
    out = f"{tmp_path}/out"
    assert discover_by_part(spark, f"{tmp_path}/index", INDEX, out, {CO: 4}, excluded_domains(), max_per_domain=9).count() == 4
    assert sorted(p.name for p in (tmp_path / "out/left").iterdir()) == ["batch=0", "batch=1", "batch=2"]
    assert sorted(p.name for p in (tmp_path / "out/candidates").iterdir()) == ["batch=0", "batch=1"]  # the third part was not read
    assert discover_by_part(spark, f"{tmp_path}/index", INDEX, f"{tmp_path}/none", {CO: 0}, excluded_domains()).count() == 0


# --- stores, modes and options ---------------------------------------------------------------------


def test_long_exclusion_lists(spark):
    rows = spark.createDataFrame([("x.d9999.com",), ("e.com",)], "h string")
    assert [r.h for r in without_excluded(rows, "h", [f"d{i}.com" for i in range(20_000)]).collect()] == ["e.com"]
    assert without_excluded(rows, "h", []).count() == 2


def test_custom_footprints(spark, tmp_path):
    from siltstone.operators.classify import load_engines

    (tmp_path / "f.json").write_text(json.dumps({"comment": "x", "engines": [{"category": "Wiki", "name": "Own", "html_contains": ["MyWiki"]}, {"category": "Wiki", "name": "Late", "generator": ["own"], "url_path_contains": ["/w/"]}]}))
    engines = load_engines(f"{tmp_path}/f.json")
    rows = spark.createDataFrame([("1", "a mywiki page", "http://x/w/"), ("2", "", "http://x/W/"), ("3", '<meta name="generator" content="OWN 1">', "http://x/"), ("4", "Powered by phpBB", "")], "k string, html string, url string")
    got = {r.k: (r.engine_name, r.signal) for r in classified(rows, engines).collect()}
    assert got == {"1": ("Own", "html:mywiki"), "2": ("Late", "url:/w/"), "3": ("Late", "generator:own"), "4": (None, None)}


def test_store_in_a_database(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    s = store.JdbcStore(spark, {"url": url, "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "pushDownPredicate": "false"}, fetch_size=10)  # Derby cannot compare CLOBs
    assert s.pages.count() == s.links.count() == 0
    p = page(spark, ("u1", "a", "c", ""), ("u1", "b", "c", ""), ("u2", None, "c", "", "co", None, None, "CMS", "X", 3))
    s.save_pages(p)
    s.save_pages(p)
    assert sorted((r.url, r.domain, r.outlink_count) for r in s.pages.collect()) == [("u1", "a", None), ("u2", "", 3)]
    s.save_links(spark.createDataFrame([("u1", "https://Target.test/x", "t")], "source_url string, target_url string, anchor_text string"))
    assert s.query("SELECT l.target_domain FROM pages p JOIN links l ON p.url = l.source_url WHERE p.url = ?", ["u1"]).first()[0] == "target.test"
    target = store.CensusStore(spark, f"{tmp_path}/target")
    assert store.migrate(s.pages, target) == {"source": 2, "attempted": 2, "total": 2}
    assert store.migrate(s.pages, target) == {"source": 2, "attempted": 2, "total": 2}


def test_choice_of_store(spark, tmp_path):
    assert isinstance(store.open_store(spark, "x"), store.CensusStore)
    mysql = store.open_store(spark, "", environ={"DB_BACKEND": " MySQL ", "MYSQL_DSN": "mysql://a:b@h/d"})
    assert isinstance(mysql, store.JdbcStore) and mysql.options["url"] == "jdbc:mysql://h:3306/d" and mysql.options["fetchsize"] == "10000"
    for backend in ("mysql", "oracle"):
        with pytest.raises(ValueError):
            store.open_store(spark, "x", backend)


def test_domains_mode_end_to_end(spark, tmp_path):
    from siltstone.cli import main

    bodies = {"http://a.co/": b"<p>Powered by phpBB <a href='https://t.org/'>t</a><a href='https://x.com/'>no</a>", "http://a.co/2": b"plain", "http://a.co/3": b"late"}
    data, lines = b"", []
    for url, body in bodies.items():
        rec = record(body)
        lines.append(json.dumps({"url": url, "status": "200", "mime": "text/html", "offset": str(len(data)), "length": str(len(rec)), "filename": "f.warc.gz"}))
        data += rec
    (tmp_path / "f.warc.gz").write_bytes(data)
    (tmp_path / "answers").mkdir()
    (tmp_path / "answers" / "a.co__").write_text("\n".join(lines))
    args = ["domains", "--domains", "a.co", "facebook.com", "gone.co", "--answers", f"{tmp_path}/answers", "--warc-root", f"file://{tmp_path}", "--crawl", "C", "--limit", "2", "--store", f"{tmp_path}/store"]
    for _ in range(2):
        assert main(args, spark).count() == 0  # no errors
    s = store.CensusStore(spark, f"{tmp_path}/store")
    assert sorted((r.url, r.engine_name, r.tld, r.outlink_count, r.crawl) for r in s.pages.collect()) == [("http://a.co/", "phpBB", None, None, "C"), ("http://a.co/2", None, None, None, "C")]
    assert {r.target_url for r in s.links.collect()} == {"https://t.org/"}


def test_more_commands(spark, tmp_path, monkeypatch):
    from siltstone.cli import budgets_of, main

    rec = record(b"Powered by phpBB")
    (tmp_path / "f").write_bytes(rec)
    rows = [(f"http://{d}/", "co", d, 200, "text/html", "f", 0, len(rec)) for d in ("a.co", "b.co")]
    for r in rows:
        spark.createDataFrame([r], index.INDEX).coalesce(1).write.mode("append").parquet(f"{tmp_path}/index")
    monkeypatch.setenv("PIPELINE_TOTAL_LIMIT", "9")
    monkeypatch.setenv("PIPELINE_COUNTRIES", "co cl")
    monkeypatch.setenv("PIPELINE_CRAWL", "FROM-ENV")
    common = ["countries", "--index", f"{tmp_path}/index", "--candidates-file", f"{tmp_path}/found", "--warc-root", f"file://{tmp_path}", "--store", f"{tmp_path}/store"]
    assert [tuple(r) for r in main([*common, "--discovery-only", "--max-parts", "1"], spark).collect()] == [("co", 1)]
    main([*common, "--skip-discovery"], spark)
    assert store.CensusStore(spark, f"{tmp_path}/store").pages.count() == 1
    main([*common, "--store-links"], spark)
    assert {r.crawl for r in store.CensusStore(spark, f"{tmp_path}/store").pages.collect()} == {"FROM-ENV"}
    assert tuple(main(["migrate", "--source", f"{tmp_path}/store", "--store", f"{tmp_path}/copy"], spark).first()) == (2, 2, 2)
    assert budgets_of({"countries": "DE,fr", "per_country_limit": 7})[0] == {"de": 7, "fr": 7}
    (tmp_path / "log").write_text("10:00 skip part 2: timeout\nok\n10:01 skip part 9: x\n")
    (tmp_path / "state.json").write_text(json.dumps({"scanned_parts": [1, 2, 3], "remaining": {"a": 1}}))
    assert tuple(main(["repair", "--log", f"{tmp_path}/log", "--state", f"{tmp_path}/state.json"], spark).first()) == (2, 3, 2)
    assert json.loads((tmp_path / "state.json").read_text()) == {"scanned_parts": [1, 3], "remaining": {"a": 1}}


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    from siltstone import session

    class Context:
        master = "spark://somewhere:7077"

        class _jsc:  # noqa: N801
            @staticmethod
            def sc():
                return Context

        class getCheckpointDir:  # noqa: N801
            @staticmethod
            def isDefined():  # noqa: N802
                return False

    class Session:
        sparkContext = Context  # noqa: N815

        class conf:  # noqa: N801
            get = staticmethod(lambda k, d: d)

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        session.shared_dir(Session)
