"""Command line: python -m siltstone.cli COMMAND ... (X12 and the original's commands, on Parquet stores)."""

from __future__ import annotations

import argparse
import json
import os
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.urls import in_shard
from .operators import dashboard, discover, reports, store
from .operators.classify import load_engines
from .plans import census
from .plans.budgets import allocate_budget, load_priorities, settings
from .plans.dims import bucket_frame, excluded_domains
from .plans.values import BUCKETS, ENGINES, Engine
from .sources.candidates import read_candidates, write_candidates
from .sources.index import scan_index
from .sources.warc import fetch_pages


def _store_options(p: argparse.ArgumentParser) -> None:
    p.add_argument("--store", help="folder of the Parquet tables (unused for a database)")
    p.add_argument("--db-backend", choices=["parquet", "mysql"], help="default: DB_BACKEND or parquet; mysql takes its DSN from MYSQL_DSN")


def _discover_options(p: argparse.ArgumentParser) -> None:
    p.add_argument("--config", help="JSON file with defaults for these options; PIPELINE_* of the environment comes between")
    p.add_argument("--index")
    p.add_argument("--candidates-file")
    p.add_argument("--countries", help="top-level domains with a budget each, by weight; commas or spaces between")
    p.add_argument("--total-limit", type=int)
    p.add_argument("--per-country-limit", type=int, help="the same budget for each of the countries")
    p.add_argument("--priorities")
    p.add_argument("--categories-file", help="JSON: bucket to top-level domains, which share a budget; 'default' for the fixed ones")
    p.add_argument("--per-category-limit", type=int)
    p.add_argument("--max-per-domain", type=int)
    p.add_argument("--max-parts", type=int, help="at most so many parts of the index, evenly spread")
    p.add_argument("--exclude-file", help="JSON with a list 'domains', besides the fixed ones")


def _fetch_options(p: argparse.ArgumentParser) -> None:
    p.add_argument("--warc-root")
    p.add_argument("--crawl")
    p.add_argument("--shard", help="i/n: only candidates with CRC-32 of the URL modulo n equal to i")
    p.add_argument("--store-links", action="store_true", default=None)
    p.add_argument("--footprints", help="JSON file of engines in order of precedence, instead of the fixed ones")


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="siltstone")
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("report", help="a canned report, or SQL over the views pages and links")
    _store_options(p)
    what = p.add_mutually_exclusive_group(required=True)
    what.add_argument("--report", choices=list(reports.REPORTS))
    what.add_argument("--sql")
    p = sub.add_parser("dashboard", help="the dashboard document as JSON")
    _store_options(p)
    p.add_argument("--out", default="dashboard_data.json")
    p = sub.add_parser("merge", help="merge stores into the first; stored pages win, links are appended")
    p.add_argument("target")
    p.add_argument("shards", nargs="+")
    p = sub.add_parser("migrate", help="copy the pages of another store into this one; pages that are there stay")
    p.add_argument("--source", required=True, help="folder of a Parquet store, or a JDBC URL")
    _store_options(p)
    p = sub.add_parser("repair", help="take parts that a log says were skipped off the scanned parts of a state file")
    p.add_argument("--log", required=True)
    p.add_argument("--state", required=True)
    p = sub.add_parser("discover", help="candidates under budgets, as JSON lines")
    _discover_options(p)
    p = sub.add_parser("fetch", help="fetch, classify and store candidates that are not stored yet")
    _store_options(p)
    _fetch_options(p)
    p.add_argument("--candidates-file", required=True)
    p.add_argument("--exclude-file")
    p = sub.add_parser("countries", help="discover and fetch in one run")
    _store_options(p)
    _discover_options(p)
    _fetch_options(p)
    how = p.add_mutually_exclusive_group()
    how.add_argument("--skip-discovery", action="store_true", default=None, help="take the candidates file as it is")
    how.add_argument("--discovery-only", action="store_true", default=None)
    p = sub.add_parser("domains", help="fetch, classify and store captures of given domains")
    _store_options(p)
    _fetch_options(p)
    p.add_argument("--domains", nargs="+", required=True)
    p.add_argument("--answers", required=True, help="folder with the index's answer for each pattern, JSON lines, named by the pattern with / as _")
    p.add_argument("--limit", type=int, default=1000)
    p.add_argument("--exclude-file")
    p = sub.add_parser("preview", help="a look at some candidates' pages")
    p.add_argument("--candidates-file", required=True)
    p.add_argument("--warc-root", required=True)
    p.add_argument("--bucket")
    p.add_argument("--url")
    p.add_argument("-n", type=int, default=3)
    p.add_argument("--save", help="folder for the pages' HTML")
    return top


def budgets_of(options: dict) -> tuple[dict[str, int], dict[str, str | Sequence[str]]]:
    """(budgets, buckets): by country, each a bucket of its own, or by category."""
    if bool(options.get("countries")) == bool(options.get("categories_file")):
        raise SystemExit("give either --countries or --categories-file")
    if options.get("countries"):
        given = options["countries"]
        tlds = [t.lower() for t in (given.replace(",", " ").split() if isinstance(given, str) else given)]
        if options.get("per_country_limit"):
            return dict.fromkeys(tlds, int(options["per_country_limit"])), {t: [t] for t in tlds}
        weights = load_priorities(options.get("priorities"), tlds)
        chosen = {t: weights[t] for t in tlds if t in weights}  # a country without a weight has no budget
        return allocate_budget(chosen, int(options.get("total_limit") or 1000)), {t: [t] for t in tlds}
    file = options["categories_file"]
    buckets = BUCKETS if file == "default" else json.loads(Path(file).read_text(encoding="utf-8"))
    return {b: int(options.get("per_category_limit") or 1000) for b in buckets}, buckets


def _excluded(options: dict) -> list[str]:
    more = json.loads(Path(options["exclude_file"]).read_text(encoding="utf-8"))["domains"] if options.get("exclude_file") else []
    return excluded_domains(excluded_domains(), more)


def _number(options: dict, name: str) -> int | None:
    return int(options[name]) if options.get(name) else None


def _discover(spark: SparkSession, options: dict) -> DataFrame:
    budgets, buckets = budgets_of(options)
    index = scan_index(spark, options["index"], _number(options, "max_parts"))
    found = discover.discover(index, budgets, _excluded(options), _number(options, "max_per_domain"), bucket_frame(spark, buckets))
    write_candidates(found, options["candidates_file"])
    return discover.by_bucket(read_candidates(spark, options["candidates_file"]))


def _engines(options: dict) -> Sequence[Engine]:
    return load_engines(options["footprints"]) if options.get("footprints") else ENGINES


def _fetch(spark: SparkSession, options: dict, kept: store.Store) -> DataFrame:
    found = read_candidates(spark, options["candidates_file"])
    if options.get("shard"):
        i, n = map(int, options["shard"].split("/"))
        found = found.where(in_shard(F.col("url"), n, i))
    results = census.fetch_and_store(found, kept, options["warc_root"], options["crawl"], bool(options.get("store_links")), _excluded(options), _engines(options))
    return reports.error_histogram(results)


def _domains(spark: SparkSession, options: dict, kept: store.Store) -> DataFrame:
    domains = spark.createDataFrame([(d,) for d in options["domains"]], "domain string")
    excluded = _excluded(options)
    patterns = [r.pattern for r in census.input_patterns(domains, excluded).collect()]
    answers = {p: f"{options['answers']}/{p.replace('/', '_').replace('*', '_')}" for p in patterns}
    results = census.run_domains(domains, answers, kept, options["warc_root"], options["crawl"], int(options["limit"]), excluded, _engines(options))
    return reports.error_histogram(results)


def _migrate(spark: SparkSession, source: str, kept: store.Store) -> DataFrame:
    reader = spark.read.format("jdbc").options(url=source, dbtable="pages", fetchsize="10000") if source.startswith("jdbc:") else spark.read.format("parquet").option("path", f"{source}/pages")
    return spark.createDataFrame([tuple(store.migrate(reader.load(), kept).values())], "source long, attempted long, total long")


def save_previews(pages: DataFrame, folder: str) -> None:
    """The HTML of a few pages, one file each."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    for i, row in enumerate(pages.select("html").collect(), 1):
        Path(folder, f"preview_{i}.html").write_text(row.html or "", encoding="utf-8")


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> DataFrame | None:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("siltstone").getOrCreate()
    file = json.loads(Path(args.config).read_text(encoding="utf-8")) if getattr(args, "config", None) else None
    environ = os.environ if args.command in ("discover", "countries") else None
    options = settings(file, environ, **{k: v for k, v in vars(args).items() if k not in ("command", "config")})
    kept = store.open_store(spark, options.get("store", ""), options.get("db_backend"), environ=os.environ) if hasattr(args, "db_backend") else None
    out: DataFrame | None = None
    if args.command == "report":
        out = kept.query(args.sql) if args.sql else reports.report(args.report, kept.pages, kept.links)
    elif args.command == "dashboard":
        dashboard.export(kept.pages, args.out)
    elif args.command == "merge":
        target, shards = store.CensusStore(spark, args.target), [store.CensusStore(spark, s) for s in args.shards]
        target.save_pages(store.merge_pages([s.pages for s in shards]))
        target.save_links(store.merge_links([s.links for s in shards]))
    elif args.command == "migrate":
        out = _migrate(spark, args.source, kept)
    elif args.command == "repair":
        out = spark.createDataFrame([tuple(store.repair_state(spark, args.log, args.state).values())], "failed long, before long, after long")
    elif args.command == "discover":
        out = _discover(spark, options)
    elif args.command == "fetch":
        out = _fetch(spark, options, kept)
    elif args.command == "countries":
        out = None if options.get("skip_discovery") else _discover(spark, options)
        out = out if options.get("discovery_only") else _fetch(spark, options, kept)
    elif args.command == "domains":
        out = _domains(spark, options, kept)
    else:
        found = discover.sample(read_candidates(spark, args.candidates_file), args.n, bucket=args.bucket, url=args.url)
        pages = fetch_pages(found, args.warc_root).where("ok")
        if args.save:
            save_previews(pages, args.save)
        out = census.preview(pages)
    if out is not None:
        out.show(1000, truncate=100)
    return out


if __name__ == "__main__":
    main()
