"""Page and link tables: insert-if-absent, merge, migration, repair."""

from __future__ import annotations

import copy
import json
from abc import ABC, abstractmethod
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.urls import netloc
from ..plans.budgets import jdbc_options

PAGE = "url string, domain string, crawl string, timestamp string, tld string, country string, bucket string, engine_category string, engine_name string, outlink_count int, fetched_at timestamp"
LINK = "source_url string, target_url string, target_domain string, anchor_text string"
REQUIRED = ("url", "domain", "crawl", "timestamp")


def first_wins(pages: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row a URL: the first in the given order."""
    place = F.row_number().over(Window.partitionBy("url").orderBy(*order))
    return pages.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def absent(pages: DataFrame, stored: DataFrame) -> DataFrame:
    return pages.join(stored.select("url"), "url", "left_anti").select(*pages.columns)


def merge_pages(shards: Sequence[DataFrame]) -> DataFrame:
    """Pages of all shards, the first shard that has a URL winning. Within a shard URLs are unique."""
    numbered = [s.withColumn("_shard", F.lit(i)) for i, s in enumerate(shards)]
    union = numbered[0]
    for s in numbered[1:]:
        union = union.unionByName(s, allowMissingColumns=True)
    return first_wins(union, ["_shard"]).drop("_shard")


def merge_links(shards: Sequence[DataFrame], dedup: bool = False) -> DataFrame:
    """Links of all shards, appended; a repeated merge repeats them unless dedup."""
    union = shards[0]
    for s in shards[1:]:
        union = union.unionByName(s, allowMissingColumns=True)
    return union.distinct() if dedup else union


def coerced(pages: DataFrame) -> DataFrame:
    """A foreign page table in our columns: keys must exist, null keys become ''."""
    if missing := [c for c in REQUIRED if c not in pages.columns]:
        raise ValueError(f"source pages lack {', '.join(missing)}")
    schema = [tuple(c.strip().split(" ")) for c in PAGE.split(",")]
    kept = lambda c, t: F.col(c).cast(t) if c in pages.columns else F.lit(None).cast(t)
    return pages.select(*[(F.coalesce(kept(c, t), F.lit("")) if c in REQUIRED[1:] else kept(c, t)).alias(c) for c, t in schema])


def failed_parts(log: DataFrame) -> DataFrame:
    """Parts that a log (column value) says were skipped."""
    part = F.regexp_extract("value", r"skip part (\d+)", 1)
    return log.select(part.alias("p")).where("p <> ''").select(F.col("p").cast("int").alias("part")).distinct()


def repaired(scanned: DataFrame, failed: DataFrame) -> DataFrame:
    """Scanned parts (column part) without the failed ones."""
    return scanned.join(failed, "part", "left_anti").distinct()


class Store(ABC):
    """Page and link tables. A save writes only pages that are not there yet, so saving twice changes nothing.

    One writer at a time: two concurrent saves could both find a page absent.
    """

    spark: SparkSession

    @property
    @abstractmethod
    def pages(self) -> DataFrame: ...

    @property
    @abstractmethod
    def links(self) -> DataFrame: ...

    @abstractmethod
    def _append(self, name: str, rows: DataFrame) -> None: ...

    def save_pages(self, pages: DataFrame, order: Sequence[str] = ("domain", "crawl", "timestamp")) -> None:
        """The first row of a URL wins, in the given order; fetched_at is now where it is null."""
        rows = coerced(first_wins(pages, list(order))).withColumn("fetched_at", F.coalesce("fetched_at", F.current_timestamp()))
        self._append("pages", absent(rows, self.pages))

    def save_links(self, links: DataFrame) -> None:
        """Appends (source_url, target_url, anchor_text); the target's domain is derived."""
        self._append("links", links.select("source_url", "target_url", netloc(F.col("target_url")).alias("target_domain"), "anchor_text"))

    def query(self, sql: str, args: Sequence | None = None) -> DataFrame:
        """Ad-hoc SQL over the views pages and links, in a session of its own; ? are parameters."""
        there = copy.copy(self)
        there.spark = session = self.spark.newSession()
        there.pages.createOrReplaceTempView("pages")
        there.links.createOrReplaceTempView("links")
        return session.sql(sql, args=list(args)) if args else session.sql(sql)


class CensusStore(Store):
    """Parquet tables pages and links under a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if self._exists(name) else self.spark.createDataFrame([], schema)

    @property
    def pages(self) -> DataFrame:
        return self._read("pages", PAGE)

    @property
    def links(self) -> DataFrame:
        return self._read("links", LINK)

    def _append(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.path}/{name}")

    def _exists(self, name: str) -> bool:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


class JdbcStore(Store):
    """Tables pages and links of a database (options of the JDBC source; its driver must be on the classpath).

    Only the columns and filters that a plan needs are sent for; ``fetch_size`` rows come at a time. (S13, X10)
    """

    def __init__(self, spark: SparkSession, options: dict[str, str], fetch_size: int = 10_000):
        self.spark, self.options = spark, {**options, "fetchsize": str(fetch_size)}

    def _read(self, name: str, schema: str) -> DataFrame:
        if not self._exists(name):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.format("jdbc").options(**self.options, dbtable=name).load()
        return rows.select(*[F.col(c).cast(t).alias(c) for c, t in (x.strip().split(" ") for x in schema.split(","))])

    def _exists(self, name: str) -> bool:
        try:
            self.spark.read.format("jdbc").options(**self.options, dbtable=f"(SELECT * FROM {name} WHERE 1 = 0) siltstone_probe").load()
        except Exception as e:  # each database has an error of its own for a missing table
            if any(sign in str(e).lower() for sign in ("does not exist", "doesn't exist", "not found")):
                return False
            raise
        return True

    @property
    def pages(self) -> DataFrame:
        return self._read("pages", PAGE)

    @property
    def links(self) -> DataFrame:
        return self._read("links", LINK)

    def _append(self, name: str, rows: DataFrame) -> None:
        rows.write.format("jdbc").options(**self.options, dbtable=name).mode("append").save()


def open_store(spark: SparkSession, path: str, backend: str | None = None, dsn: str | None = None, environ: Mapping[str, str] | None = None) -> Store:
    """The store a backend names: parquet (the default) under the path, or mysql by its DSN.

    What is not given comes from DB_BACKEND and MYSQL_DSN of the environment.
    """
    environ = environ or {}
    backend = (backend or environ.get("DB_BACKEND") or "parquet").strip().lower()
    if backend == "parquet":
        return CensusStore(spark, path)
    if backend != "mysql":
        raise ValueError("the backend is parquet or mysql")
    if not (dsn := dsn or environ.get("MYSQL_DSN")):
        raise ValueError("the mysql backend needs a DSN (MYSQL_DSN)")
    return JdbcStore(spark, jdbc_options(dsn))


def migrate(source: DataFrame, target: Store) -> dict[str, int]:
    """Saves a foreign page table; pages that are there already stay. Returns counts: source, attempted and total. (K6)"""
    pages = coerced(source)
    target.save_pages(pages)
    n = source.count()
    return {"source": n, "attempted": n, "total": target.pages.count()}


def repair_state(spark: SparkSession, log: str, state: str) -> dict[str, int]:
    """Takes the parts that a log says were skipped off scanned_parts of a JSON state file, so that a resumed run reads them."""
    kept = json.loads(Path(state).read_text(encoding="utf-8"))
    failed = failed_parts(spark.read.text(log))
    scanned = spark.createDataFrame([(p,) for p in kept["scanned_parts"]], "part int")
    before = len(set(kept["scanned_parts"]))
    kept["scanned_parts"] = sorted(r.part for r in repaired(scanned, failed).collect())
    Path(state).write_text(json.dumps(kept), encoding="utf-8")
    return {"failed": failed.count(), "before": before, "after": len(kept["scanned_parts"])}
