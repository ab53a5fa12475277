"""Small dimension tables as DataFrames. Their sizes are those of the fixed values, so they may be broadcast."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from .values import BUCKETS, COUNTRIES, EXCLUDED


def tld_buckets(buckets: Mapping[str, str | Iterable[str]] = BUCKETS) -> dict[str, str]:
    """tld -> bucket. A domain in two buckets would make budgets ambiguous, so it is an error."""
    out: dict[str, str] = {}
    for bucket, tlds in buckets.items():
        for tld in tlds.split() if isinstance(tlds, str) else tlds:
            if out.setdefault(tld.lower(), bucket) != bucket:
                raise ValueError(f"'{tld}' is in two buckets: '{out[tld.lower()]}' and '{bucket}'")
    return out


def bucket_frame(spark: SparkSession, buckets: Mapping[str, str | Iterable[str]] = BUCKETS) -> DataFrame:
    return spark.createDataFrame(sorted(tld_buckets(buckets).items()), "tld string, bucket string")


def country_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(COUNTRIES.items()), "tld string, country_name string")


def excluded_domains(*lists: Iterable[str]) -> list[str]:
    """Union of exclusion lists, the fixed ones by default; lower case, without repeats."""
    return sorted({d.strip().lower() for domains in lists or (EXCLUDED,) for d in domains if d.strip()})
