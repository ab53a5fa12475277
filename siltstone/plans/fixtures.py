"""Derived inputs: the driver's pages and events with platform signals, top-level domains and an index layout planted.

The texts run alike on Spark and DuckDB and hold no operator's logic.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import run_folder, ship_package

FX_HTML = """
SELECT page_id,
       concat(regexp_replace(url, '[.]example[.](com|net|org)', concat('.example.', tld)),
              CASE WHEN page_id % 11 = 2 THEN '/viewtopic.php' ELSE '' END) AS url,
       tld,
       replace(replace(CASE CAST(page_id % 11 AS INT)
         WHEN 0 THEN replace(html, '<head>', '<head><meta name="generator" content="WordPress 6.4">')
         WHEN 1 THEN concat(html, '<!-- Powered by phpBB -->')
         WHEN 3 THEN replace(concat(html, '<!-- wp-content/plugins/woocommerce -->'), '<head>', '<head><META NAME=generator content="WordPress">')
         WHEN 4 THEN concat(html, '<script src="https://CDN.shopify.com/s.js"></script>')
         WHEN 5 THEN replace(html, '<head>', '<head><meta content="Joomla! 5" name="generator">')
         WHEN 6 THEN replace(html, '<head>', '<head><meta name="generator" content=Drupal>')
         WHEN 7 THEN replace(html, '</head>', '</head><meta name="generator" content="Ghost 5">')
         ELSE html END,
         '<body>', concat('<body><a href="https://ext', CAST(page_id % 6 AS VARCHAR(9)), '.example.org/p">Ext</a><a href="https://www.facebook.com/x">f</a>')),
         '<zzz>', '') AS html
FROM (SELECT page_id, url, html,
        CASE CAST(page_id % 9 AS INT) WHEN 0 THEN 'co' WHEN 1 THEN 'cl' WHEN 2 THEN 'ng' WHEN 3 THEN 'de'
          WHEN 4 THEN 'ru' WHEN 5 THEN 'com' WHEN 6 THEN 'ke' WHEN 7 THEN 'xx' ELSE 'uk' END AS tld FROM pages) t
"""

FX_INDEX = """
SELECT event_id % 8 AS part, event_id AS row_in_part,
       concat('https://', dom, '/p/', CAST(event_id AS VARCHAR(20))) AS url, tld AS url_host_tld, dom AS url_host_registered_domain,
       CASE WHEN event_type = 'error' THEN 404 ELSE 200 END AS fetch_status,
       CASE WHEN event_type = 'signup' THEN 'application/pdf' ELSE 'text/html' END AS content_mime_detected,
       concat('crawl/part-', CAST(event_id % 8 AS VARCHAR(9))) AS warc_filename, event_id * 1000 AS warc_record_offset, 500 + event_id % 97 AS warc_record_length
FROM (SELECT *, CASE WHEN user_id % 13 = 0 THEN 'facebook.com' ELSE concat('s', CAST(user_id % 40 AS VARCHAR(9)), '.', tld) END AS dom
      FROM (SELECT *, CASE WHEN user_id % 13 = 0 THEN 'com' ELSE CASE CAST(user_id % 6 AS INT) WHEN 0 THEN 'co' WHEN 1 THEN 'cl' WHEN 2 THEN 'ng' WHEN 3 THEN 'ke' WHEN 4 THEN 'de' ELSE 'com' END END AS tld FROM events) a) b
"""

#: Budgets that some buckets of the index fixture fill and others do not.
DOMAIN_CAP = 12


def fixture(spark: SparkSession, sf_dir: str, text: str, table: str) -> DataFrame:
    """The text over the table, without leaving a view behind."""
    return spark.sql(text.replace(f"FROM {table}", "FROM {source}"), source=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, FX_HTML, "pages")


def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, FX_INDEX, "events")


def index_files(spark: SparkSession, sf_dir: str) -> str:
    """The index fixture as Parquet, a file a part, rows in order; the folder."""
    place = run_folder(spark, "index")
    rows = index_rows(spark, sf_dir).coalesce(1).sortWithinPartitions("part", "row_in_part")
    rows.withColumn("part_no", F.col("part")).drop("part").write.partitionBy("part_no").parquet(place)
    return place


def cdx_files(spark: SparkSession, sf_dir: str) -> str:
    """The index fixture as captured answers: JSON lines with all fields as text, a file a domain, blank and broken lines between; the folder."""
    place = run_folder(spark, "answers")
    rows = index_rows(spark, sf_dir).select(
        F.col("url_host_registered_domain").alias("domain"), "row_in_part", "url", F.col("content_mime_detected").alias("mime"), F.col("fetch_status").cast("string").alias("status"),
        F.col("warc_record_length").cast("string").alias("length"), F.col("warc_record_offset").cast("string").alias("offset"), F.col("warc_filename").alias("filename"),
    )
    line = F.to_json(F.struct("url", "mime", "status", "length", "offset", "filename"))
    noisy = F.when(F.col("row_in_part") % 5 == 0, F.concat(line, F.lit("\n\n{broken"))).otherwise(line)
    rows.coalesce(1).sortWithinPartitions("domain", "row_in_part").select("domain", noisy.alias("value")).write.partitionBy("domain").text(place)
    return place


def warc_files(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The pages as gzipped WARC records, a file a partition, after a request record each: the root, and url, filename, offset, length, page_id."""
    place = run_folder(spark, "warc")
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(place)
        system.create_dir(base, recursive=True)
        name, at = f"{uuid.uuid4()}.warc.gz", 0
        with system.open_output_stream(f"{base}/{name}", compression=None) as out:
            for b in batches:
                offsets, lengths = [], []
                for html in b.column(1).to_pylist():
                    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (html or "").encode()
                    record = b"".join(
                        b"WARC/1.0\r\nWARC-Type: %s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (kind, len(body), body) for kind, body in ((b"request", b"GET / HTTP/1.1\r\n\r\n"), (b"response", http))
                    )
                    blob = gzip.compress(record, 1)
                    out.write(blob)
                    offsets.append(at)
                    lengths.append(len(blob))
                    at += len(blob)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([name] * len(offsets)), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), b.column(2)], ["url", "filename", "offset", "length", "page_id"])

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("url", "html", "page_id")
    listing = run_folder(spark, "warc-listing")
    pages.mapInArrow(run, "url string, filename string, offset long, length long, page_id long").write.parquet(listing)
    return place, spark.read.parquet(listing)
