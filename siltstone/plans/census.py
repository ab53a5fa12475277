"""The census: pages to page facts and link facts, and the whole run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import generator, snippet, title
from ..functions.urls import index_pattern, netloc
from ..operators.classify import classified
from ..operators.discover import discover, unseen
from ..operators.links import link_facts, outlink_count, with_links, without_excluded
from ..operators.store import Store
from ..session import run_folder
from ..sources.index import html_records, read_cdx_domains
from ..sources.warc import fetch_pages
from .dims import bucket_frame, country_frame, excluded_domains
from .values import ENGINES, Engine


def with_country(pages: DataFrame) -> DataFrame:
    """country of the top-level domain; the domain itself in capitals if unknown, '' if null."""
    low: Column = F.lower("tld")
    named = pages.join(F.broadcast(country_frame(pages.sparkSession).withColumnRenamed("tld", "_tld")), low == F.col("_tld"), "left")
    return named.withColumn("country", F.coalesce("country_name", F.upper("tld"), F.lit(""))).drop("_tld", "country_name")


def with_bucket(pages: DataFrame) -> DataFrame:
    buckets = bucket_frame(pages.sparkSession).withColumnRenamed("tld", "_tld")
    return pages.join(F.broadcast(buckets), F.col("tld") == F.col("_tld"), "left").drop("_tld")


def page_facts(pages: DataFrame, links: str = "count", excluded: Sequence[str] = (), engines: Sequence[Engine] = ENGINES) -> DataFrame:
    """From (url, tld, html, ...): the page columns with engine, country, bucket and outlink_count, without html.

    links: 'none' (outlink_count 0: links are not looked at), or 'count' (links are parsed and counted). All of it is local to
    the page's row: no shuffle.
    """
    linked = pages if links == "none" or "links" in pages.columns else with_links(pages)
    facts = with_bucket(with_country(classified(linked, engines).withColumn("domain", netloc(F.col("url")))))
    count = F.lit(0) if links == "none" else outlink_count(F.col("links"), excluded)
    return facts.withColumn("outlink_count", count.cast("int")).drop("html", "links")


def domain_pages(pages: DataFrame, crawl: str, engines: Sequence[Engine] = ENGINES) -> DataFrame:
    """Page facts of the per-domain mode: no top-level domain, country, bucket or link count."""
    none = {c: F.lit(None).cast("string") for c in ("tld", "country", "bucket")}
    facts = classified(pages.drop(*none), engines).withColumn("domain", netloc(F.col("url"))).drop("html")
    return facts.withColumns(none | {"outlink_count": F.lit(None).cast("int"), "crawl": F.lit(crawl), "timestamp": F.lit("")})


def input_patterns(domains: DataFrame, excluded: Sequence[str] | None = None) -> DataFrame:
    """From (domain): what to ask the index for; blank and excluded domains are skipped."""
    rows = domains.select(F.trim("domain").alias("domain")).where("domain <> ''")
    return without_excluded(rows, "domain", excluded_domains() if excluded is None else excluded).withColumn("pattern", index_pattern(F.col("domain")))


def preview(pages: DataFrame) -> DataFrame:
    """url, engine, title, generator, html_length and a snippet of each page."""
    found = classified(pages)
    return found.select(
        "url", "engine_category", "engine_name", "signal", title(F.col("html")).alias("title"), F.left(generator(F.col("html")), F.lit(60)).alias("generator"),
        F.char_length("html").alias("html_length"), snippet(F.col("html")).alias("snippet"),
    )


def _fetched(found: DataFrame, warc_root: str) -> DataFrame:
    """Fetch results, written to the shared folder: pages and links of a run come from the same bytes, whatever executors are lost."""
    place = run_folder(found.sparkSession, "fetched")
    fetch_pages(found, warc_root).write.parquet(place)
    return found.sparkSession.read.parquet(place)


def fetch_and_store(
    found: DataFrame, store: Store, warc_root: str, crawl: str, store_links: bool = False, excluded: Sequence[str] | None = None, engines: Sequence[Engine] = ENGINES
) -> DataFrame:
    """Fetches the candidates that are not stored yet, classifies and stores them. Returns the results (url, ok, error)."""
    excluded = excluded_domains() if excluded is None else excluded
    results = _fetched(unseen(found, store.pages), warc_root).withColumnRenamed("url_host_tld", "tld").drop("bucket")
    good = results.where("ok")
    facts = page_facts(good, "count" if store_links else "none", excluded, engines).withColumns({"crawl": F.lit(crawl), "timestamp": F.lit("")})
    store.save_pages(facts)
    if store_links:
        store.save_links(link_facts(good, excluded))
    return results.select("url", "ok", "error")


def run_census(index: DataFrame, store: Store, warc_root: str, budgets: Mapping[str, int], crawl: str, max_per_domain: int | None = None, store_links: bool = False) -> DataFrame:
    """Discover, fetch what is not stored yet, classify and store. Returns the fetch results (url, ok, error)."""
    return fetch_and_store(discover(index, budgets, excluded_domains(), max_per_domain), store, warc_root, crawl, store_links)


def run_domains(
    domains: DataFrame, answers: Mapping[str, str], store: Store, warc_root: str, crawl: str, limit: int = 1000, excluded: Sequence[str] | None = None, engines: Sequence[Engine] = ENGINES
) -> DataFrame:
    """The per-domain mode: captures of the given domains (column domain) are fetched, classified and stored with their links.

    answers: for each pattern (see input_patterns) the captured answer of the index, JSON lines. Excluded domains and those whose
    answer is missing are skipped. At most ``limit`` captures a domain are looked at, then kept if they are HTML. Returns (url, ok, error).
    """
    excluded = excluded_domains() if excluded is None else excluded
    asked = [(r.domain, answers[r.pattern]) for r in input_patterns(domains, excluded).distinct().orderBy("domain").collect() if r.pattern in answers]  # the caller's list
    records = html_records(read_cdx_domains(domains.sparkSession, asked, limit)).select("url", "filename", "offset", "length")
    results = _fetched(records, warc_root)
    good = results.where("ok")
    store.save_pages(domain_pages(good.drop("filename", "offset", "length", "ok", "error"), crawl, engines))
    store.save_links(link_facts(good, excluded))
    return results.select("url", "ok", "error")
