"""URL index: list of parts, columnar scan, captured JSON lines."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

log = logging.getLogger(__name__)

INDEX = (
    "url string, url_host_tld string, url_host_registered_domain string, fetch_status int, content_mime_detected string, warc_filename string, warc_record_offset long, warc_record_length long"
)
CDX = "urlkey string, timestamp string, url string, mime string, status string, digest string, length string, offset string, filename string"


def index_parts(spark: SparkSession, listing: str, base: str = "") -> DataFrame:
    """ordinal, part_url of the parts with fetched pages, from a (gzipped) listing of paths; ordinals follow the listing."""
    lines = spark.read.text(listing, wholetext=True).select(F.posexplode(F.split("value", r"\n")).alias("line", "path"))
    parts = lines.where(F.contains("path", F.lit("/subset=warc/"))).select("line", F.concat(F.lit(base), F.trim("path")).alias("part_url"))
    return parts.select((F.row_number().over(Window.orderBy("line")) - 1).alias("ordinal"), "part_url")


def scan_index(spark: SparkSession, paths: str | list[str], max_parts: int | None = None) -> DataFrame:
    """Index rows with their scan order: part (by file name) and row_in_part. Only the columns used are read.

    max_parts: an evenly spread sample of the files, by name. (S3)
    """
    rows = spark.read.schema(INDEX).parquet(*([paths] if isinstance(paths, str) else paths))
    if max_parts is not None and len(files := sorted(rows.inputFiles())) > max_parts:
        rows = spark.read.schema(INDEX).parquet(*[files[i * len(files) // max_parts] for i in range(max_parts)])
    return rows.select("*", F.col("_metadata.file_path").alias("part"), F.col("_metadata.row_index").alias("row_in_part"))


def read_cdx(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Captured index answers: JSON lines; blank and malformed lines are dropped. Offset and length are numbers."""
    rows = _numbered(spark.read.schema(CDX).option("mode", "DROPMALFORMED").json(path))
    return rows if limit is None else rows.limit(limit)


def _numbered(rows: DataFrame) -> DataFrame:
    return rows.where("url is not null").withColumns({c: F.expr(f"try_cast({c} as bigint)") for c in ("length", "offset")})


def _plain_path(spark: SparkSession, path: str) -> str:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toUri().getPath()


def read_cdx_domains(spark: SparkSession, paths: Iterable[tuple[str, str]], limit_per_domain: int = 1000) -> DataFrame:
    """Answers of several domains, (domain, file) each, the first so many lines a domain. A domain whose file is missing is skipped, with a
    warning. All files are one scan; a row's file says its domain."""
    there = []
    for domain, path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            there.append((domain, path))
        else:
            log.warning("no answer for %s: %s", domain, path)
    if not there:
        return spark.createDataFrame([], f"{CDX}, query_domain string").withColumns({c: F.col(c).cast("long") for c in ("length", "offset")})
    asked = spark.createDataFrame([(d, _plain_path(spark, p)) for d, p in there], "query_domain string, _path string")  # the caller's list
    path = F.regexp_replace(F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")), "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    rows = _numbered(spark.read.schema(CDX).option("mode", "DROPMALFORMED").json([p for _, p in dict.fromkeys(there)])).withColumn("_path", path)
    rows = rows.withColumn("_line", F.monotonically_increasing_id()).join(F.broadcast(asked), "_path")
    place = F.row_number().over(Window.partitionBy("query_domain").orderBy("_line"))
    return rows.withColumn("_place", place).where(F.col("_place") <= limit_per_domain).drop("_path", "_line", "_place")


def html_records(cdx: DataFrame) -> DataFrame:
    """Successful HTML captures; applied after any limit."""
    return cdx.where((F.col("status") == "200") & F.contains("mime", F.lit("html")))
