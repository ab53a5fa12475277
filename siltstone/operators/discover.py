"""Budgeted discovery of candidate pages in a URL index.

Index rows: part, row_in_part, url, url_host_tld, url_host_registered_domain, fetch_status,
content_mime_detected, warc_filename, warc_record_offset, warc_record_length.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.dims import bucket_frame
from .links import without_excluded

CANDIDATE = ["url", "url_host_tld", "url_host_registered_domain", "bucket", "filename", "offset", "length"]


def fetched_pages(index: DataFrame, tlds: list[str] | None = None) -> DataFrame:
    """HTML pages that were fetched, of the given top-level domains. The filters reach the Parquet scan."""
    rows = index.where((F.col("fetch_status") == 200) & (F.col("content_mime_detected") == "text/html"))
    return rows if tlds is None else rows.where(F.col("url_host_tld").isin(tlds))


def with_bucket(index: DataFrame, buckets: DataFrame | None = None) -> DataFrame:
    """Inner look-up of the bucket; rows of unknown top-level domains go."""
    buckets = buckets if buckets is not None else bucket_frame(index.sparkSession)
    return index.join(F.broadcast(buckets), index["url_host_tld"] == buckets["tld"]).drop("tld")


def fair_share(index: DataFrame, cap: int) -> DataFrame:
    """At most cap rows of each top-level domain in each part, in scan order."""
    place = F.row_number().over(Window.partitionBy("part", "url_host_tld").orderBy("row_in_part"))
    return index.withColumn("_place", place).where(F.col("_place") <= cap).drop("_place")


def part_stride(parts: DataFrame, most: int) -> DataFrame:
    """Evenly spread sample of at most ``most`` parts by ordinal: floor(i * n / most). (S3)"""
    n = parts.count()
    keep = {i * n // most for i in range(most)} if n > most else set(range(n))
    return parts.where(F.col("ordinal").isin(sorted(keep)))


def _budget_of(budgets: Mapping[str, int]) -> Column:
    return F.element_at(F.create_map(*[x for k, v in sorted(budgets.items()) for x in (F.lit(k), F.lit(v))]), F.col("bucket"))


def within_budgets(rows: DataFrame, budgets: Mapping[str, int], max_per_domain: int | None) -> DataFrame:
    """The first rows of each registered domain up to its cap, then of each bucket up to its budget, in scan order.

    A domain lies in one bucket, so its cap nests inside the budget; rows without a domain count as one domain. A window over a whole bucket would sort a hot one in
    a single task: instead each part's rows are counted, which gives the room that is left for it, and rows are placed within their part.
    """
    if max_per_domain is not None:
        place = F.row_number().over(Window.partitionBy("url_host_registered_domain").orderBy("part", "row_in_part"))
        rows = rows.withColumn("_place", place).where(F.col("_place") <= max_per_domain).drop("_place")
    counted = rows.groupBy("bucket", "part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    room = counted.select("bucket", "part", (_budget_of(budgets) - before).alias("_room")).where("_room > 0")
    placed = rows.join(room, ["bucket", "part"]).withColumn("_place", F.row_number().over(Window.partitionBy("bucket", "part").orderBy("row_in_part")))
    return placed.where("_place <= _room").drop("_place", "_room")


def candidates(rows: DataFrame) -> DataFrame:
    return rows.select(
        "url", "url_host_tld", "url_host_registered_domain", "bucket", F.col("warc_filename").alias("filename"), F.col("warc_record_offset").alias("offset"), F.col("warc_record_length").alias("length")
    )


def tlds_of(buckets: DataFrame, wanted: Mapping[str, int]) -> list[str]:
    """Top-level domains of the wanted buckets; a dimension of a few hundred rows."""
    return sorted(r.tld for r in buckets.collect() if r.bucket in wanted)


def discover(index: DataFrame, budgets: Mapping[str, int], excluded: Sequence[str], max_per_domain: int | None = None, buckets: DataFrame | None = None) -> DataFrame:
    """Candidates under budgets, over the whole index at once. The top-level domains of buckets with a budget are a filter of the scan."""
    buckets = buckets if buckets is not None else bucket_frame(index.sparkSession)
    rows = with_bucket(fetched_pages(index, tlds_of(buckets, budgets)), buckets).where(F.col("bucket").isin(sorted(budgets)))
    return candidates(within_budgets(without_excluded(rows, "url_host_registered_domain", excluded), budgets, max_per_domain))


def by_bucket(found: DataFrame) -> DataFrame:
    """Candidates of each bucket, or top-level domain where there is none."""
    return found.groupBy(F.coalesce("bucket", "url_host_tld").alias("bucket")).agg(F.count("*").alias("candidates")).orderBy(F.desc("candidates"), "bucket")


def shortfall(found: DataFrame, budgets: Mapping[str, int]) -> DataFrame:
    """What is left of each budget, where anything is."""
    budget = found.sparkSession.createDataFrame(sorted(budgets.items()), "bucket string, budget long")
    counted = found.groupBy("bucket").agg(F.count("*").alias("n"))
    left = budget.join(counted, "bucket", "left").select("bucket", F.greatest(F.col("budget") - F.coalesce("n", F.lit(0)), F.lit(0)).alias("remaining"))
    return left.where("remaining > 0")


def unseen(found: DataFrame, stored: DataFrame) -> DataFrame:
    """Candidates whose page is not stored yet."""
    return found.join(stored.select("url").distinct(), "url", "left_anti").select(*found.columns)


def _draw(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col("url")))


def shuffled(found: DataFrame, seed: int = 42) -> DataFrame:
    """A seeded permutation."""
    return found.orderBy(_draw(seed), "url")


def sample(found: DataFrame, n: int, seed: int = 42, scanned: int = 20_000, bucket: str | None = None, url: str | None = None) -> DataFrame:
    """n of the first ``scanned`` candidates for a preview, of one bucket or one URL if given."""
    if url is not None:
        return found.where(F.col("url") == url).limit(1)
    rows = found if bucket is None else found.where(F.col("bucket") == bucket)
    return rows.limit(scanned).orderBy(_draw(seed), "url").limit(n)
