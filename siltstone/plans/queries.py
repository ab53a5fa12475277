"""The census' registered queries, over the derived fixtures. Each names the inventory items it covers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import generator
from ..functions.urls import host_suffixes, in_shard, netloc, url_hash
from ..operators import dashboard, discover, links, reports, store
from ..operators.classify import classified, known_categories, signals
from ..session import run_folder
from ..sources import index
from ..sources.candidates import read_candidates, write_candidates
from ..sources.warc import fetch_pages
from ..streaming.incremental import discover_by_part
from . import census, fixtures
from .budgets import allocate_budget, jdbc_options, settings
from .dims import bucket_frame, country_frame, excluded_domains, tld_buckets
from .values import COUNTRIES

#: Budgets by bucket for the index fixture: some run out, one does not. Keys are looked up by a domain of the bucket.
BUDGETS = {tld_buckets()[t]: n for t, n in (("co", 90), ("cl", 100_000), ("ke", 200), ("de", 50), ("com", 120))}
PER_TLD = 40
CDX_LIMIT = 3


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census.page_facts(fixtures.html_pages(spark, sf_dir), "count", excluded_domains())


def engines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page facts for the reports that do not look at links: no page is parsed."""
    return census.page_facts(fixtures.html_pages(spark, sf_dir), "none")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.link_facts(fixtures.html_pages(spark, sf_dir), excluded_domains())


def classify_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 F2 J6"""
    return classified(fixtures.html_pages(spark, sf_dir)).select("page_id", "engine_category", "engine_name", "signal")


def extract_generator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1"""
    return fixtures.html_pages(spark, sf_dir).select("page_id", generator(F.col("html")).alias("generator"))


def page_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 J2 J3 F4 P4 J4"""
    return facts(spark, sf_dir).select("page_id", "url", "domain", "tld", "country", "bucket", "engine_category", "engine_name", "outlink_count")


def domain_mode_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-domain mode's page records. Q5 Q8b"""
    rows = census.domain_pages(fixtures.html_pages(spark, sf_dir), "CRAWL")
    return rows.select("url", "domain", "crawl", "timestamp", "tld", "country", "bucket", "engine_category", "engine_name", "outlink_count")


def link_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 F6 P4 P8 J4"""
    return edges(spark, sf_dir).select("source_url", "target_url", "target_domain", "anchor_text")


def links_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts of the index and whether a host is excluded"""
    hosts = fixtures.index_rows(spark, sf_dir).select(F.col("url_host_registered_domain").alias("host")).distinct()
    hosts = hosts.unionByName(hosts.select(F.concat(F.lit("m."), "host").alias("host"))).unionByName(hosts.select(F.concat(F.lit("not"), "host").alias("host")))
    return links.without_excluded(hosts, "host", excluded_domains())


def host_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authority of the raw page URLs and its suffixes"""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    host = netloc(F.col("url"))
    return pages.select("page_id", host.alias("domain"), F.array_join(host_suffixes(host), " ").alias("suffixes"))


def _link_report(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pages = engines(spark, sf_dir) if name not in ("top-domains", "top-pages-by-outlinks") else None
        return reports.report(name, pages, edges(spark, sf_dir))

    return run


def _page_report(name: str):
    return lambda spark, sf_dir: reports.report(name, engines(spark, sf_dir), None)


LINK_REPORTS = ("top-domains", "top-pages-by-outlinks", "external-vs-internal", "summary")


def dash_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1"""
    return dashboard.totals(engines(spark, sf_dir))


def dash_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2"""
    return dashboard.categories(engines(spark, sf_dir))


def dash_platforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3"""
    return dashboard.platforms(engines(spark, sf_dir))


def dash_dominant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4 W4"""
    return dashboard.dominant(engines(spark, sf_dir))


def dash_bucket_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5"""
    return dashboard.bucket_domains(engines(spark, sf_dir))


def dash_bucket_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 W5"""
    return dashboard.bucket_top(engines(spark, sf_dir))


def dash_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The buckets, flat: maps and arrays as text"""
    rows = dashboard.buckets(engines(spark, sf_dir))
    text = lambda xs: F.array_join(xs, ";")
    cats = F.transform(F.map_entries("cats"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return rows.select("name", "domains", text(F.array_sort(cats)).alias("cats"), text(F.transform("top", lambda t: F.concat_ws("=", t["name"], t["sites"].cast("string")))).alias("top"))


def index_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 J2 S2"""
    rows = discover.with_bucket(discover.fetched_pages(fixtures.index_rows(spark, sf_dir), ["co", "cl", "ng", "ke", "com"]))
    return rows.select("part", "row_in_part", "url", "bucket")


def fair_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1"""
    return discover.fair_share(discover.fetched_pages(fixtures.index_rows(spark, sf_dir)), PER_TLD).select("part", "row_in_part", "url_host_tld")


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.discover(fixtures.index_rows(spark, sf_dir), BUDGETS, excluded_domains(), fixtures.DOMAIN_CAP)


def discover_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 J4 P3 K1"""
    return _found(spark, sf_dir)


def _by_part(spark: SparkSession, sf_dir: str, per_tld: int) -> DataFrame:
    place = run_folder(spark, "by-part")
    index = fixtures.index_rows(spark, sf_dir)
    for part in range(8):
        index.where(F.col("part") == part).coalesce(1).write.mode("append").parquet(f"{place}/index")
    schema = index.schema.simpleString()[7:-1].replace(":", " ")
    return discover_by_part(spark, f"{place}/index", schema, f"{place}/out", BUDGETS, excluded_domains(), per_tld, fixtures.DOMAIN_CAP)


def discover_per_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of the index as files, worked off in order with carried budgets"""
    return _by_part(spark, sf_dir, 100_000)


def budget_shortfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A18"""
    return discover.shortfall(_found(spark, sf_dir), BUDGETS)


def candidates_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A16 T7"""
    return discover.by_bucket(_found(spark, sf_dir))


def candidate_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A20"""
    return _found(spark, sf_dir).agg(F.count("*").alias("candidates"))


def shard_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 F11"""
    return fixtures.index_rows(spark, sf_dir).where(in_shard(F.col("url"), 4, 1)).select("url")


def resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates less the pages of even rows"""
    stored = fixtures.index_rows(spark, sf_dir).where("row_in_part % 2 = 0").select("url")
    return discover.unseen(_found(spark, sf_dir), stored).select("url", "bucket")


def merge_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three overlapping shards of events as pages of users; the first shard wins"""
    rows = fixtures.index_rows(spark, sf_dir)
    pages = rows.groupBy("url_host_registered_domain", "part").agg(F.count("*").cast("int").alias("outlink_count"))
    shards = [pages.where(F.col("part") % 3 == i).groupBy(F.col("url_host_registered_domain").alias("url")).agg(F.max("outlink_count").alias("outlink_count"), F.lit(f"shard{i}").alias("crawl")) for i in range(3)]
    return store.merge_pages(shards).select("url", "crawl", "outlink_count")


def migrated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A foreign table with null keys, coerced"""
    source = fixtures.index_rows(spark, sf_dir).select(
        "url", F.when(F.col("row_in_part") % 3 == 0, None).otherwise(F.col("url_host_registered_domain")).alias("domain"), F.lit(None).cast("string").alias("crawl"), F.lit("").alias("timestamp"),
        F.col("part").cast("string").alias("outlink_count"),
    )
    return store.coerced(source).select("url", "domain", "crawl", "timestamp", "tld", "outlink_count")


def url_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10"""
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.lower(F.hex(url_hash(F.col("url")))).alias("url_hash"))


def part_stride(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3"""
    parts = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").alias("ordinal"), F.col("n_name").alias("part_url"))
    return discover.part_stride(parts, 7)


def error_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A17"""
    rows = fixtures.index_rows(spark, sf_dir)
    ok = (F.col("fetch_status") == 200) & (F.col("content_mime_detected") == "text/html")
    results = rows.select(ok.alias("ok"), F.concat_ws(" ", F.col("fetch_status").cast("string"), "content_mime_detected", F.col("part").cast("string")).alias("error"))
    return reports.error_histogram(results)


def repair_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that the log says failed are taken off the scanned ones"""
    rows = fixtures.index_rows(spark, sf_dir)
    log = rows.where("fetch_status = 404 AND part < 3").select(F.concat(F.lit("12:00 skip part "), F.col("part").cast("string"), F.lit(": timeout")).alias("value"))
    return store.repaired(rows.select(F.col("part").cast("int").alias("part")).distinct(), store.failed_parts(log))


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 F9"""
    return census.preview(fixtures.html_pages(spark, sf_dir))


def preview_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded sample of one bucket's candidates (a sampling operator)"""
    return discover.sample(_found(spark, sf_dir), 10, bucket=tld_buckets()["cl"]).select("url", "bucket")


def shuffled_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 T5"""
    return discover.shuffled(_found(spark, sf_dir)).select("url")


def dim_tlds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every top-level domain with its bucket and country"""
    return bucket_frame(spark).join(country_frame(spark), "tld", "left").select("tld", "bucket", F.coalesce("country_name", F.upper("tld")).alias("country"))


def category_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A19"""
    return spark.createDataFrame([(c,) for c in known_categories()], "category string")


def index_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gzipped listing of parts, some of other subsets"""
    place = run_folder(spark, "listing")
    n = F.col("n_nationkey")
    path = F.concat(F.lit("crawl/subset="), F.when(n % 3 == 0, "robotstxt").otherwise("warc"), F.lit("/part-"), n.cast("string"))
    spark.read.parquet(f"{sf_dir}/nation.parquet").coalesce(1).sortWithinPartitions("n_nationkey").select(path.alias("value")).write.option("compression", "gzip").text(place)
    return index.index_parts(spark, place, "https://data.example/")


def index_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan with its order, read from files"""
    rows = discover.fetched_pages(index.scan_index(spark, fixtures.index_files(spark, sf_dir)), ["co", "ke"])
    return rows.select("url", F.regexp_extract("part", "part_no=([0-9]+)", 1).cast("int").alias("part"), F.col("row_in_part").cast("long").alias("row_in_part"))


def cdx_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured answers with blank and broken lines; HTML captures"""
    rows = index.html_records(index.read_cdx(spark, fixtures.cdx_files(spark, sf_dir)))
    return rows.select("url", "mime", "status", "length", "offset", "filename")


def cdx_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first captures of each of several domains; one has no answer"""
    place = fixtures.cdx_files(spark, sf_dir)
    files = sorted({f for f in spark.read.text(place).inputFiles()})
    asked = [(f.split("domain=")[1].split("/")[0], f) for f in files] + [("none.example", f"{place}/none")]
    rows = index.html_records(index.read_cdx_domains(spark, asked, CDX_LIMIT))
    return rows.select("query_domain", "url", "offset")


def candidate_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates written as JSON lines, in two goes, and read again"""
    place, found = run_folder(spark, "candidates"), _found(spark, sf_dir)
    even = F.col("offset") % 2000 == 0
    write_candidates(found.where(even), place)
    write_candidates(found.where(~even), place, append=True)
    return read_candidates(spark, place)


def warc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages from WARC records by byte range; one range of each hundred is wrong"""
    root, found = fixtures.warc_files(spark, sf_dir)
    wrong = F.when(F.col("page_id") % 100 == 7, F.lit("missing")).otherwise(F.col("filename"))
    return fetch_pages(found.withColumn("filename", wrong), root).select("page_id", F.md5("html").alias("html_md5"), "ok")


def stored_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages saved twice and links once; ad-hoc SQL over the tables"""
    kept = store.CensusStore(spark, run_folder(spark, "store"))
    rows = facts(spark, sf_dir).withColumns({"crawl": F.lit("C"), "timestamp": F.lit("")})
    kept.save_pages(rows.where("page_id % 2 = 0"))
    kept.save_pages(rows)
    kept.save_links(edges(spark, sf_dir))
    return kept.query(
        "SELECT p.domain, p.engine_name, count(DISTINCT p.url) AS pages, count(l.target_url) AS links, count(DISTINCT l.target_domain) AS targets "
        "FROM pages p LEFT JOIN links l ON l.source_url = p.url WHERE p.crawl = ? GROUP BY p.domain, p.engine_name",
        ["C"],
    )


def domains_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-domain mode from captured answers to stored pages; pages are those of the raw table"""
    root, records = fixtures.warc_files(spark, sf_dir)
    place = run_folder(spark, "answers")
    lines = records.withColumn("domain", netloc(F.col("url"))).select(
        "domain", "url", F.lit("text/html").alias("mime"), F.lit("200").alias("status"), F.col("length").cast("string").alias("length"), F.col("offset").cast("string").alias("offset"), "filename"
    )
    lines.repartition("domain").write.partitionBy("domain").json(place)
    files = sorted(spark.read.text(place).inputFiles())
    answers = {f"{f.split('domain=')[1].split('/')[0]}/*": f for f in files}
    domains = lines.select("domain").distinct().unionByName(spark.createDataFrame([("facebook.com",), (" ",), ("none.example",)], "domain string"))
    kept = store.CensusStore(spark, run_folder(spark, "store"))
    census.run_domains(domains, answers, kept, root, "C", 1_000_000)
    return kept.pages.select("url", "domain", "crawl", "timestamp", "tld", "country", "bucket", "outlink_count")


def input_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to ask the index for"""
    hosts = fixtures.index_rows(spark, sf_dir).select(F.col("url_host_registered_domain").alias("domain")).distinct()
    hosts = hosts.unionByName(hosts.select(F.concat(F.lit(" *."), "domain").alias("domain"))).unionByName(hosts.select(F.lit(" ").alias("domain")))
    return census.input_patterns(hosts)


def discover_per_part_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part by part under a fair-share cap, which counts rows before exclusions and domain caps"""
    return _by_part(spark, sf_dir, PER_TLD)


def exclusion_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed list and one of the caller's"""
    more = [f" {r.host.upper()}" for r in fixtures.index_rows(spark, sf_dir).select(F.col("url_host_registered_domain").alias("host")).distinct().collect()]
    return spark.createDataFrame([(d,) for d in excluded_domains(excluded_domains(), more)], "domain string")


def dsn_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F19"""
    got = jdbc_options("mysql+pymysql://reader:a%2Fb%3A1@db.internal.test/census")
    return spark.createDataFrame([(got["url"], got["user"], got["password"])], "url string, user string, password string")


def merged_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File, then environment, then what is given"""
    got = settings({"comment_x": 1, "_note": 2, "crawl": "file", "total_limit": 5, "shard": "0/2"}, {"PIPELINE_CRAWL": "env", "PIPELINE_TOTAL_LIMIT": "7", "OTHER": "x"}, crawl="given", shard=None)
    return spark.createDataFrame(sorted((k, str(v)) for k, v in got.items()), "name string, value string")


def budget_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16 F17"""
    return spark.createDataFrame(list(allocate_budget({"ru": 3, "de": 2, "fr": 1, "us": 1}, 1000).items()), "tld string, budget long")


QUERIES = {
    f.__name__: f
    for f in (
        classify_pages, extract_generator, page_facts, domain_mode_facts, link_facts, links_excluded, host_parts, dash_totals, dash_categories, dash_platforms, dash_dominant, dash_bucket_domains,
        dash_bucket_top5, dash_doc, index_filter, fair_share, discover_global, discover_per_part, budget_shortfall, candidates_by_bucket, candidate_total, shard_slice, resume_anti, merge_first_wins,
        migrated_pages, url_hashes, part_stride, error_histogram, repair_parts, preview_rows, preview_sample, shuffled_candidates, dim_tlds, category_list, budget_split, index_listing, index_scan, cdx_records,
        cdx_domains, candidate_file, warc_pages, stored_census, domains_mode, input_patterns, discover_per_part_capped, exclusion_list, dsn_parts, merged_settings,
    )
} | {f"report_{n.replace('-', '_')}": (_link_report if n in LINK_REPORTS else _page_report)(n) for n in reports.REPORTS}


# --- SQL -----------------------------------------------------------------------------------------


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(_text(x) if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


def _sql() -> dict[str, str]:
    order = signals()
    # one CASE to the number of the first signal that matches
    column = {"generator": "gen", "url": "lower(url)", "html": "lower(html)"}
    first = "CASE " + " ".join(f"WHEN contains({column[c]}, {_text(s)}) THEN {i}" for i, (c, s, _, _) in enumerate(order)) + " END"
    named = _values([(i, f"{c}:{s}", cat, name) for i, (c, s, cat, name) in enumerate(order)])
    q = """["'']"""
    html = f"""
fx_html AS ({fixtures.FX_HTML}),
head AS (SELECT *, CASE WHEN position('</head>' IN lower(html)) > 0 THEN substr(html, 1, position('</head>' IN lower(html)) + 6) ELSE substr(html, 1, 400000) END AS scan FROM fx_html),
gen AS (SELECT *, lower(coalesce(regexp_extract(list_filter(regexp_extract_all(scan, '(?i)<meta\\b[^>]*>'),
    lambda m: regexp_matches(m, '(?i)name\\s*=\\s*{q}?\\s*generator') AND regexp_matches(m, '(?i)content\\s*=\\s*{q}'))[1], '(?i)content\\s*=\\s*{q}([^"''>]*)', 1), '')) AS gen FROM head),
hit AS (SELECT *, {first} AS i FROM gen),
sig(i, signal, engine_category, engine_name) AS (VALUES {named}),
bucket_of(tld, bucket) AS (VALUES {_values(sorted(tld_buckets().items()))}),
country_of(tld, name) AS (VALUES {_values(sorted(COUNTRIES.items()))}),
bad(domain) AS (VALUES {_values([(d,) for d in excluded_domains()])}),
pf AS (SELECT page_id, url, lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1)) AS domain, hit.tld, coalesce(c.name, upper(hit.tld), '') AS country, bucket,
    signal, engine_category, engine_name, html, gen
  FROM hit LEFT JOIN sig USING (i) LEFT JOIN bucket_of b ON b.tld = hit.tld LEFT JOIN country_of c ON c.tld = lower(hit.tld)),
a AS (SELECT url AS source_url, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS txt FROM fx_html),
u AS (SELECT source_url, replace(replace(replace(replace(href, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS href, replace(replace(replace(replace(txt, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS txt FROM a),
t AS (SELECT source_url, CASE WHEN href LIKE 'http%' THEN href ELSE regexp_extract(source_url, '^https?://[^/?#]*') || href END AS target_url, left(trim(txt), 200) AS anchor_text FROM u),
td AS (SELECT *, lower(regexp_extract(target_url, '^https?://([^/?#]*)', 1)) AS target_domain FROM t),
lf AS (SELECT * FROM td WHERE NOT EXISTS (SELECT 1 FROM bad WHERE target_domain = bad.domain OR ends_with(target_domain, '.' || bad.domain)))
"""
    index = f"""
fx AS ({fixtures.FX_INDEX}),
bucket_of(tld, bucket) AS (VALUES {_values(sorted(tld_buckets().items()))}),
budget_of(bucket, budget) AS (VALUES {_values(sorted(BUDGETS.items()))}),
bad(domain) AS (VALUES {_values([(d,) for d in excluded_domains()])}),
ok AS (SELECT * FROM fx WHERE fetch_status = 200 AND content_mime_detected = 'text/html'),
elig AS (SELECT ok.*, b.bucket, budget FROM ok JOIN bucket_of b ON b.tld = url_host_tld JOIN budget_of g ON g.bucket = b.bucket
  WHERE NOT EXISTS (SELECT 1 FROM bad WHERE url_host_registered_domain = bad.domain OR ends_with(url_host_registered_domain, '.' || bad.domain))),
capped AS (SELECT *, row_number() OVER (PARTITION BY url_host_registered_domain ORDER BY part, row_in_part) AS rd FROM elig),
placed AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY part, row_in_part) AS rc FROM capped WHERE rd <= {fixtures.DOMAIN_CAP}),
found AS (SELECT url, url_host_tld, url_host_registered_domain, bucket, warc_filename AS filename, CAST(warc_record_offset AS BIGINT) AS "offset", CAST(warc_record_length AS BIGINT) AS length,
    row_in_part, budget FROM placed WHERE rc <= budget)
"""
    pages = lambda s: f"WITH {html} {s}"
    scan = lambda s: f"WITH {index} {s}"
    share = lambda n, key: f"round(100.0::DOUBLE * {n} / sum({n}) OVER (PARTITION BY bucket), 1) AS {key}"
    bucket_pages = "FROM pf WHERE bucket IS NOT NULL"
    discovered = 'SELECT url, url_host_tld, url_host_registered_domain, bucket, filename, "offset", length FROM found'
    return {
        "classify_pages": pages("SELECT page_id, engine_category, engine_name, signal FROM pf"),
        "extract_generator": pages("SELECT page_id, gen AS generator FROM pf"),
        "page_facts": pages(
            "SELECT page_id, url, domain, tld, country, bucket, engine_category, engine_name, CAST(coalesce(n, 0) AS INTEGER) AS outlink_count FROM pf LEFT JOIN (SELECT source_url, count(*) AS n FROM lf GROUP BY 1) l ON l.source_url = url"
        ),
        "domain_mode_facts": pages(
            "SELECT url, domain, 'CRAWL' AS crawl, '' AS timestamp, CAST(NULL AS VARCHAR) AS tld, CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS bucket, engine_category, engine_name, CAST(NULL AS INTEGER) AS outlink_count FROM pf"
        ),
        "link_facts": pages("SELECT source_url, target_url, target_domain, anchor_text FROM lf"),
        "links_excluded": scan(
            "SELECT host FROM (SELECT DISTINCT p || url_host_registered_domain AS host FROM fx, (VALUES (''), ('m.'), ('not')) v(p)) WHERE NOT EXISTS (SELECT 1 FROM bad WHERE host = bad.domain OR ends_with(host, '.' || bad.domain))"
        ),
        "host_parts": r"""WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)) AS domain FROM pages)
SELECT page_id, domain, array_to_string(list_transform(range(1, len(string_split(domain, '.')) + 1), lambda i: array_to_string(string_split(domain, '.')[i:], '.')), ' ') AS suffixes FROM h""",
        "report_top_domains": pages("SELECT target_domain, count(*) AS link_count FROM lf GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"),
        "report_top_pages_by_outlinks": pages("SELECT source_url, count(*) AS outlink_count FROM lf GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"),
        "report_external_vs_internal": pages(
            "SELECT p.domain AS source_domain, CAST(sum(CASE WHEN target_domain = p.domain THEN 1 ELSE 0 END) AS BIGINT) AS internal_links, CAST(sum(CASE WHEN target_domain <> p.domain THEN 1 ELSE 0 END) AS BIGINT) AS external_links FROM lf JOIN pf p ON p.url = source_url GROUP BY 1"
        ),
        "report_summary": pages("SELECT (SELECT count(*) FROM pf) AS pages_crawled, (SELECT count(*) FROM lf) AS total_links, (SELECT count(DISTINCT target_domain) FROM lf) AS unique_target_domains"),
        "report_engine_distribution": pages("SELECT engine_category, count(*) AS pages FROM pf WHERE engine_category IS NOT NULL GROUP BY 1"),
        "report_engine_detail": pages("SELECT engine_category, engine_name, count(*) AS pages FROM pf WHERE engine_category IS NOT NULL GROUP BY 1, 2"),
        "report_engine_by_country": pages("SELECT country, engine_category, count(*) AS pages FROM pf WHERE engine_category IS NOT NULL AND country IS NOT NULL GROUP BY 1, 2"),
        "report_country_coverage": pages("SELECT country, tld, count(*) AS pages_crawled, count(engine_category) AS classified_pages FROM pf WHERE country IS NOT NULL GROUP BY 1, 2"),
        "report_bucket_coverage": pages(
            f"SELECT bucket, count(*) AS pages, count(engine_category) AS classified, round(100.0::DOUBLE * sum(CASE WHEN engine_category IS NULL THEN 1 ELSE 0 END) / count(*), 1) AS unclassified_pct {bucket_pages} GROUP BY 1"
        ),
        "report_engine_by_bucket": pages(f"SELECT bucket, engine_category, count(*) AS pages {bucket_pages} AND engine_category IS NOT NULL GROUP BY 1, 2"),
        "report_engine_share_by_bucket": pages(f"SELECT bucket, engine_category, count(*) AS pages, {share('count(*)', 'pct_of_bucket')} {bucket_pages} AND engine_category IS NOT NULL GROUP BY 1, 2"),
        "report_platform_share_by_bucket": pages(f"SELECT bucket, engine_name, count(*) AS pages, {share('count(*)', 'pct_of_bucket')} {bucket_pages} AND engine_name IS NOT NULL GROUP BY 1, 2"),
        "report_engine_share_by_bucket_sites": pages(
            f"SELECT bucket, engine_category, count(*) AS sites, {share('count(*)', 'pct_of_bucket_sites')} FROM (SELECT DISTINCT bucket, engine_category, domain {bucket_pages} AND engine_category IS NOT NULL) GROUP BY 1, 2"
        ),
        "report_platform_sites": pages("SELECT engine_category, engine_name, count(DISTINCT domain) AS sites, count(*) AS pages FROM pf WHERE engine_name IS NOT NULL GROUP BY 1, 2"),
        "report_unclassified_rate": pages(
            "SELECT count(*) AS total_pages, count(*) - count(engine_category) AS unclassified, round(100.0::DOUBLE * (count(*) - count(engine_category)) / nullif(count(*), 0), 1) AS unclassified_pct FROM pf"
        ),
        "dash_totals": pages(
            "SELECT count(*) AS pages, count(DISTINCT domain) AS domains, count(engine_category) AS classified, CAST(round_even(100.0::DOUBLE * count(engine_category) / nullif(count(*), 0), 0) AS BIGINT) AS classified_pct FROM pf"
        ),
        "dash_categories": pages("SELECT engine_category, count(DISTINCT domain) AS sites FROM pf WHERE engine_category IS NOT NULL GROUP BY 1"),
        "dash_platforms": pages("SELECT engine_name, count(DISTINCT domain) AS sites FROM pf WHERE engine_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 16"),
        "dash_dominant": pages(
            "SELECT bucket, engine_category, count(*) AS sites FROM (SELECT bucket, domain, engine_category, row_number() OVER (PARTITION BY bucket, domain ORDER BY count(*) DESC, engine_category) AS rn FROM pf WHERE engine_category IS NOT NULL GROUP BY 1, 2, 3) WHERE rn = 1 GROUP BY 1, 2"
        ),
        "dash_bucket_domains": pages(f"SELECT bucket, count(DISTINCT domain) AS domains {bucket_pages} GROUP BY 1"),
        "dash_bucket_top5": pages(
            "SELECT * FROM (SELECT bucket, engine_name, count(DISTINCT domain) AS sites, CAST(row_number() OVER (PARTITION BY bucket ORDER BY count(DISTINCT domain) DESC, engine_name) AS INTEGER) AS place FROM pf WHERE engine_name IS NOT NULL GROUP BY 1, 2) WHERE place <= 5"
        ),
        "dash_doc": pages(
            """, dom AS (SELECT bucket, engine_category, count(*) AS n FROM (SELECT bucket, domain, engine_category, row_number() OVER (PARTITION BY bucket, domain ORDER BY count(*) DESC, engine_category) AS rn FROM pf WHERE engine_category IS NOT NULL GROUP BY 1, 2, 3) WHERE rn = 1 GROUP BY 1, 2),
tops AS (SELECT * FROM (SELECT bucket, engine_name, count(DISTINCT domain) AS n, row_number() OVER (PARTITION BY bucket ORDER BY count(DISTINCT domain) DESC, engine_name) AS place FROM pf WHERE engine_name IS NOT NULL GROUP BY 1, 2) WHERE place <= 5)
SELECT b.bucket AS name, b.domains, coalesce(c.cats, '') AS cats, coalesce(t.top, '') AS top FROM (SELECT bucket, count(DISTINCT domain) AS domains FROM pf WHERE bucket IS NOT NULL GROUP BY 1) b
LEFT JOIN (SELECT bucket, string_agg(engine_category || '=' || n, ';' ORDER BY engine_category || '=' || n) AS cats FROM dom GROUP BY 1) c ON c.bucket = b.bucket
LEFT JOIN (SELECT bucket, string_agg(engine_name || '=' || n, ';' ORDER BY place) AS top FROM tops GROUP BY 1) t ON t.bucket = b.bucket"""
        ),
        "index_filter": scan("SELECT part, row_in_part, url, bucket FROM ok JOIN bucket_of b ON b.tld = url_host_tld WHERE url_host_tld IN ('co', 'cl', 'ng', 'ke', 'com')"),
        "fair_share": scan(f"SELECT part, row_in_part, url_host_tld FROM (SELECT *, row_number() OVER (PARTITION BY part, url_host_tld ORDER BY row_in_part) AS rn FROM ok) WHERE rn <= {PER_TLD}"),
        "discover_global": scan(discovered),
        # With these budgets no part holds more rows of a domain than a budget, so both modes agree.
        "discover_per_part": scan(discovered),
        "budget_shortfall": scan("SELECT b.bucket, b.budget - coalesce(n, 0) AS remaining FROM budget_of b LEFT JOIN (SELECT bucket, count(*) AS n FROM found GROUP BY 1) f ON f.bucket = b.bucket WHERE b.budget > coalesce(n, 0)"),
        "candidates_by_bucket": scan("SELECT bucket, count(*) AS candidates FROM found GROUP BY 1"),
        "candidate_total": scan("SELECT count(*) AS candidates FROM found"),
        "resume_anti": scan("SELECT url, bucket FROM found WHERE row_in_part % 2 <> 0"),
        "merge_first_wins": scan(
            ", n AS (SELECT url_host_registered_domain AS url, part, count(*) AS n FROM fx GROUP BY 1, 2), s AS (SELECT url, part % 3 AS shard, max(n) AS n FROM n GROUP BY 1, 2) SELECT url, 'shard' || min(shard) AS crawl, CAST(arg_min(n, shard) AS INTEGER) AS outlink_count FROM s GROUP BY 1"
        ),
        "migrated_pages": scan(
            "SELECT url, CASE WHEN row_in_part % 3 = 0 THEN '' ELSE url_host_registered_domain END AS domain, '' AS crawl, '' AS timestamp, CAST(NULL AS VARCHAR) AS tld, CAST(part AS INTEGER) AS outlink_count FROM fx"
        ),
        "url_hashes": "SELECT page_id, sha256(url) AS url_hash FROM pages",
        "part_stride": "SELECT n_nationkey AS ordinal, n_name AS part_url FROM nation WHERE n_nationkey IN (SELECT i * (SELECT count(*) FROM nation) // 7 FROM range(7) r(i))",
        "error_histogram": scan(
            "SELECT fetch_status || ' ' || content_mime_detected || ' ' || part AS error, count(*) AS n FROM fx WHERE NOT (fetch_status = 200 AND content_mime_detected = 'text/html') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
        ),
        "repair_parts": scan("SELECT DISTINCT CAST(part AS INTEGER) AS part FROM fx WHERE part NOT IN (SELECT part FROM fx WHERE fetch_status = 404 AND part < 3)"),
        "preview_rows": pages(
            r"""SELECT url, engine_category, engine_name, signal, left(trim(regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title', 1)), 90) AS title, left(gen, 60) AS generator, CAST(length(html) AS INTEGER) AS html_length,
 left(trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<noscript\b.*?</noscript\s*>|<!--.*?-->|<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'), '\s+', ' ', 'g')), 400) AS snippet FROM pf"""
        ),
        "preview_sample": scan(f"SELECT url, bucket FROM found WHERE bucket = {_text(tld_buckets()['cl'])} ORDER BY md5('42|' || url), url LIMIT 10"),
        # CRC-32 bit by bit
        "shard_slice": scan(
            """SELECT url FROM fx WHERE xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(url) + 1), lambda i: ascii(url[i])::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda a, k: xor(a >> 1, 3988292384 * (a & 1))))) % 4 = 1"""
        ),
        "index_listing": "SELECT CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS INTEGER) AS ordinal, 'https://data.example/crawl/subset=warc/part-' || n_nationkey AS part_url FROM nation WHERE n_nationkey % 3 <> 0",
        "index_scan": scan(
            "SELECT url, CAST(part AS INTEGER) AS part, place AS row_in_part FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY row_in_part) - 1 AS place FROM fx) WHERE fetch_status = 200 AND content_mime_detected = 'text/html' AND url_host_tld IN ('co', 'ke')"
        ),
        "cdx_records": scan(
            'SELECT url, content_mime_detected AS mime, CAST(fetch_status AS VARCHAR) AS status, CAST(warc_record_length AS BIGINT) AS length, CAST(warc_record_offset AS BIGINT) AS "offset", warc_filename AS filename FROM ok'
        ),
        "cdx_domains": scan(
            f'SELECT query_domain, url, CAST(warc_record_offset AS BIGINT) AS "offset" FROM (SELECT *, url_host_registered_domain AS query_domain, row_number() OVER (PARTITION BY url_host_registered_domain ORDER BY row_in_part) AS n FROM fx) WHERE n <= {CDX_LIMIT} AND fetch_status = 200 AND content_mime_detected = \'text/html\''
        ),
        "candidate_file": scan(discovered),
        "warc_pages": "SELECT page_id, CASE WHEN page_id % 100 <> 7 THEN md5(coalesce(html, '')) END AS html_md5, page_id % 100 <> 7 AS ok FROM pages",
        "stored_census": pages(
            "SELECT p.domain, p.engine_name, count(DISTINCT p.url) AS pages, count(lf.target_url) AS links, count(DISTINCT lf.target_domain) AS targets FROM pf p LEFT JOIN lf ON lf.source_url = p.url GROUP BY p.domain, p.engine_name"
        ),
        "domains_mode": "SELECT DISTINCT url, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)) AS domain, 'C' AS crawl, '' AS timestamp, CAST(NULL AS VARCHAR) AS tld, CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS bucket, CAST(NULL AS INTEGER) AS outlink_count FROM pages",
        "input_patterns": scan(
            "SELECT domain, CASE WHEN contains(domain, '*') THEN domain ELSE domain || '/*' END AS pattern FROM (SELECT DISTINCT p || url_host_registered_domain AS domain FROM fx, (VALUES (''), ('*.')) v(p)) d WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE d.domain = b.domain OR ends_with(d.domain, '.' || b.domain))"
        ),
        "discover_per_part_capped": scan(
            f""", fair AS (SELECT ok.*, row_number() OVER (PARTITION BY part, url_host_tld ORDER BY row_in_part) AS rf FROM ok),
shared AS (SELECT f.*, b.bucket, budget FROM fair f JOIN bucket_of b ON b.tld = url_host_tld JOIN budget_of g ON g.bucket = b.bucket WHERE rf <= {PER_TLD}
  AND NOT EXISTS (SELECT 1 FROM bad WHERE url_host_registered_domain = bad.domain OR ends_with(url_host_registered_domain, '.' || bad.domain))),
once AS (SELECT *, row_number() OVER (PARTITION BY url_host_registered_domain ORDER BY part, row_in_part) AS rd FROM shared),
kept AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY part, row_in_part) AS rc FROM once WHERE rd <= {fixtures.DOMAIN_CAP})
SELECT url, url_host_tld, url_host_registered_domain, bucket, warc_filename AS filename, CAST(warc_record_offset AS BIGINT) AS "offset", CAST(warc_record_length AS BIGINT) AS length FROM kept WHERE rc <= budget"""
        ),
        "exclusion_list": scan("SELECT domain FROM bad UNION SELECT url_host_registered_domain FROM fx"),
        "dsn_parts": "SELECT 'jdbc:mysql://db.internal.test:3306/census' AS url, 'reader' AS user, 'a/b:1' AS password",
        "merged_settings": "SELECT * FROM (VALUES ('crawl', 'given'), ('shard', '0/2'), ('total_limit', '7')) v(name, value)",
        "shuffled_candidates": scan("SELECT url FROM found"),
        "dim_tlds": f"SELECT b.tld, bucket, coalesce(name, upper(b.tld)) AS country FROM (VALUES {_values(sorted(tld_buckets().items()))}) b(tld, bucket) LEFT JOIN (VALUES {_values(sorted(COUNTRIES.items()))}) c(tld, name) ON c.tld = b.tld",
        "category_list": f"SELECT DISTINCT category FROM (VALUES {_values([(c,) for _, _, c, _ in order])}) v(category)",
        "budget_split": "SELECT * FROM (VALUES ('ru', 429), ('de', 286), ('fr', 143), ('us', 142)) v(tld, budget)",
    }


SQL = _sql()
