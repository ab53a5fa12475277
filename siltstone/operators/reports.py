"""The canned reports over page facts and link facts.

Ties that an ORDER BY would leave open are broken by the keys, so results are the same in every run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _percent(part: Column, whole: Column) -> Column:
    """100 * part / whole to one decimal, in doubles; null if whole is 0."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole), 1).cast("double")


def _count(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias(name))


def _share(rows: DataFrame, by: str, counted: str, name: str) -> DataFrame:
    whole = F.sum(counted).over(Window.partitionBy(by))
    return rows.withColumn(name, _percent(F.col(counted), whole))


def _known(pages: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        pages = pages.where(F.col(c).isNotNull())
    return pages


def top_domains(pages: DataFrame, links: DataFrame, limit: int = 20) -> DataFrame:
    return _count(links, ["target_domain"], "link_count").orderBy(F.desc("link_count"), "target_domain").limit(limit)


def top_pages_by_outlinks(pages: DataFrame, links: DataFrame, limit: int = 20) -> DataFrame:
    return _count(links, ["source_url"], "outlink_count").orderBy(F.desc("outlink_count"), "source_url").limit(limit)


def external_vs_internal(pages: DataFrame, links: DataFrame) -> DataFrame:
    """Links are counted by (source, target domain) before the join, so it moves a row for each pair, not one for each link."""
    pairs = _count(links, ["source_url", "target_domain"], "n")
    joined = pairs.join(pages.select("url", F.col("domain").alias("source_domain")), F.col("url") == F.col("source_url"))
    same = F.col("target_domain") == F.col("source_domain")
    return joined.groupBy("source_domain").agg(
        F.sum(F.when(same, F.col("n")).otherwise(0)).alias("internal_links"), F.sum(F.when(~same, F.col("n")).otherwise(0)).alias("external_links")
    )


def summary(pages: DataFrame, links: DataFrame) -> DataFrame:
    """Each side is one row before they are put together."""
    return pages.agg(F.count("*").alias("pages_crawled")).join(links.agg(F.count("*").alias("total_links"), F.countDistinct("target_domain").alias("unique_target_domains")))


def engine_distribution(pages: DataFrame, links: DataFrame) -> DataFrame:
    return _count(_known(pages, "engine_category"), ["engine_category"], "pages").orderBy(F.desc("pages"), "engine_category")


def engine_detail(pages: DataFrame, links: DataFrame) -> DataFrame:
    return _count(_known(pages, "engine_category"), ["engine_category", "engine_name"], "pages").orderBy("engine_category", F.desc("pages"), "engine_name")


def engine_by_country(pages: DataFrame, links: DataFrame) -> DataFrame:
    return _count(_known(pages, "engine_category", "country"), ["country", "engine_category"], "pages").orderBy("country", F.desc("pages"), "engine_category")


def country_coverage(pages: DataFrame, links: DataFrame) -> DataFrame:
    return (
        _known(pages, "country").groupBy("country", "tld").agg(F.count("*").alias("pages_crawled"), F.count("engine_category").alias("classified_pages")).orderBy(F.desc("pages_crawled"), "country", "tld")
    )


def bucket_coverage(pages: DataFrame, links: DataFrame) -> DataFrame:
    counted = _known(pages, "bucket").groupBy("bucket").agg(F.count("*").alias("pages"), F.count("engine_category").alias("classified"))
    return counted.withColumn("unclassified_pct", _percent(F.col("pages") - F.col("classified"), F.col("pages"))).orderBy(F.desc("pages"), "bucket")


def engine_by_bucket(pages: DataFrame, links: DataFrame) -> DataFrame:
    return _count(_known(pages, "engine_category", "bucket"), ["bucket", "engine_category"], "pages").orderBy("bucket", F.desc("pages"), "engine_category")


def engine_share_by_bucket(pages: DataFrame, links: DataFrame) -> DataFrame:
    """Shares of the classified pages."""
    counted = _count(_known(pages, "engine_category", "bucket"), ["bucket", "engine_category"], "pages")
    return _share(counted, "bucket", "pages", "pct_of_bucket").orderBy("bucket", F.desc("pages"), "engine_category")


def platform_share_by_bucket(pages: DataFrame, links: DataFrame) -> DataFrame:
    counted = _count(_known(pages, "engine_name", "bucket"), ["bucket", "engine_name"], "pages")
    return _share(counted, "bucket", "pages", "pct_of_bucket").orderBy("bucket", F.desc("pages"), "engine_name")


def engine_share_by_bucket_sites(pages: DataFrame, links: DataFrame) -> DataFrame:
    """A site counts once in each of its categories, so shares are of (site, category) pairs."""
    sites = _known(pages, "engine_category", "bucket").select("bucket", "engine_category", "domain").distinct()
    counted = _count(sites, ["bucket", "engine_category"], "sites")
    return _share(counted, "bucket", "sites", "pct_of_bucket_sites").orderBy("bucket", F.desc("sites"), "engine_category")


def platform_sites(pages: DataFrame, links: DataFrame) -> DataFrame:
    return (
        _known(pages, "engine_name")
        .groupBy("engine_category", "engine_name")
        .agg(F.countDistinct("domain").alias("sites"), F.count("*").alias("pages"))
        .orderBy(F.desc("sites"), "engine_category", "engine_name")
    )


def unclassified_rate(pages: DataFrame, links: DataFrame) -> DataFrame:
    """One row even without pages; the percentage is null then."""
    counted = pages.agg(F.count("*").alias("total_pages"), F.count(F.when(F.col("engine_category").isNull(), 1)).alias("unclassified"))
    return counted.withColumn("unclassified_pct", _percent(F.col("unclassified"), F.col("total_pages")))


REPORTS: dict[str, Callable[..., DataFrame]] = {
    "top-domains": top_domains,
    "top-pages-by-outlinks": top_pages_by_outlinks,
    "external-vs-internal": external_vs_internal,
    "summary": summary,
    "engine-distribution": engine_distribution,
    "engine-detail": engine_detail,
    "engine-by-country": engine_by_country,
    "country-coverage": country_coverage,
    "bucket-coverage": bucket_coverage,
    "engine-by-bucket": engine_by_bucket,
    "engine-share-by-bucket": engine_share_by_bucket,
    "platform-share-by-bucket": platform_share_by_bucket,
    "engine-share-by-bucket-sites": engine_share_by_bucket_sites,
    "platform-sites": platform_sites,
    "unclassified-rate": unclassified_rate,
}


def report(name: str, pages: DataFrame, links: DataFrame) -> DataFrame:
    if name not in REPORTS:
        raise ValueError(f"no report '{name}'; there are {', '.join(REPORTS)}")
    return REPORTS[name](pages, links)


def error_histogram(results: DataFrame, limit: int = 10) -> DataFrame:
    """Most frequent errors of failed fetches."""
    failed = results.where(~F.col("ok"))
    return _count(failed, ["error"], "n").orderBy(F.desc("n"), "error").limit(limit)
