"""Candidate lists as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CANDIDATE = "url string, url_host_tld string, url_host_registered_domain string, bucket string, filename string, offset long, length long"


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CANDIDATE).json(path)


def write_candidates(found: DataFrame, path: str, append: bool = False) -> None:
    found.write.mode("append" if append else "overwrite").json(path)
