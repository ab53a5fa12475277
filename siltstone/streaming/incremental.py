"""Discovery part by part, resumable: one index part a micro-batch. (P2, W1, W3 with carried state, K9, X1, X3)

Each batch carries the budgets that are left and, under a cap, the candidates of each domain so far to the next one, so a batch reads its
part and the state of the batch before, however many parts there were. It writes folders of its own, so a batch that
is run again after a crash overwrites itself, and nothing is counted twice. The budgets of the first run are kept; later runs continue
with those. A part is scanned for the top-level domains that still have a budget; without any it is not read.

Parts are taken in the order in which their files were written, which is that of the listing for an index fetched in order. Order
within a part is the scan order; the fair-share cap counts rows before exclusions and domain caps, as the original
discovery does, so rows that are capped out are lost to their top-level domain in that part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.discover import candidates, fetched_pages, tlds_of, with_bucket
from ..operators.links import without_excluded
from ..plans.dims import bucket_frame
from ..sources.candidates import CANDIDATE

DOMAIN = "url_host_registered_domain"


def emitted(spark: SparkSession, out: str) -> DataFrame:
    """Candidates of all batches."""
    if not _exists(spark, f"{out}/candidates"):
        return spark.createDataFrame([], CANDIDATE)
    return spark.read.schema(f"{CANDIDATE}, batch long").option("basePath", f"{out}/candidates").json(f"{out}/candidates").drop("batch")


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def take_part(part: DataFrame, left: Mapping[str, int], had: DataFrame | None, excluded: Sequence[str], per_tld_cap: int, max_per_domain: int | None) -> DataFrame:
    """Candidates of one part. left: budgets; had: candidates of each domain so far (columns of DOMAIN, n)."""
    spark = part.sparkSession
    left = {b: n for b, n in left.items() if n > 0}
    rows = with_bucket(fetched_pages(part, tlds_of(bucket_frame(spark), left)))
    rows = rows.join(F.broadcast(spark.createDataFrame(sorted(left.items()), "bucket string, budget long")), "bucket")  # one row a bucket
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("row_in_part"))
    rows = rows.withColumn("_fair", place("url_host_tld")).where(F.col("_fair") <= min(max(left.values(), default=0), per_tld_cap))
    rows = without_excluded(rows, DOMAIN, excluded)
    if max_per_domain is not None:
        rows = rows.withColumn("_had", F.lit(0))
        if had is not None:
            had = had.select(F.col(DOMAIN).alias("_domain"), "n")
            rows = rows.join(had, F.col(DOMAIN).eqNullSafe(F.col("_domain")), "left").withColumn("_had", F.coalesce("n", F.lit(0)))
        rows = rows.withColumn("_nth", place(DOMAIN) + F.col("_had")).where(F.col("_nth") <= max_per_domain)
    return candidates(rows.withColumn("_in", place("bucket")).where(F.col("_in") <= F.col("budget")))


def discover_by_part(
    spark: SparkSession, index: str, schema: str, out: str, budgets: Mapping[str, int], excluded: Sequence[str], per_tld_cap: int = 250_000, max_per_domain: int | None = None
) -> DataFrame:
    """Works off the parts under ``index`` (Parquet, oldest first) that are not done yet; returns all candidates so far."""
    budget_rows = lambda b: spark.createDataFrame(sorted(b.items()), "bucket string, budget long").coalesce(1)
    if not _exists(spark, f"{out}/budgets"):
        budget_rows(budgets).write.mode("overwrite").parquet(f"{out}/budgets")

    def one(part: DataFrame, batch: int) -> None:
        state = f"{out}/left/batch={batch - 1}" if batch else f"{out}/budgets"
        left = {r.bucket: r.budget for r in spark.read.parquet(state).collect()}  # one row a bucket
        if max(left.values(), default=0) > 0:
            known = f"{out}/domains/batch={batch - 1}"
            had = spark.read.parquet(known) if _exists(spark, known) else None
            found = f"{out}/candidates/batch={batch}"
            take_part(part, left, had, excluded, per_tld_cap, max_per_domain).write.mode("overwrite").json(found)
            new = spark.read.schema(CANDIDATE).json(found)
            for r in new.groupBy("bucket").count().collect():
                left[r.bucket] -= r["count"]
            if max_per_domain is not None:
                counted = new.groupBy(DOMAIN).agg(F.count("*").alias("n"))
                counted = counted if had is None else counted.unionByName(had).groupBy(DOMAIN).agg(F.sum("n").alias("n"))
                counted.write.mode("overwrite").parquet(f"{out}/domains/batch={batch}")
        budget_rows(left).write.mode("overwrite").parquet(f"{out}/left/batch={batch}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(index)
    stream.writeStream.foreachBatch(one).option("checkpointLocation", f"{out}/progress").trigger(availableNow=True).start().awaitTermination()
    return emitted(spark, out)


def classify_stream(pages: DataFrame) -> DataFrame:
    """Streaming page facts: the classifier is row-local, so it runs on a stream as it does on a table."""
    from ..plans.census import page_facts

    return page_facts(pages, links="none")
