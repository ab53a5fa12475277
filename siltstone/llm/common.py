"""Shared helpers: tables, shared storage, sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import run_folder, shared_dir, ship_package  # noqa: F401

#: ASCII white space, and a word: a maximal run of anything else.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialised(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder once and cuts its lineage there; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialised_lean(df: DataFrame) -> DataFrame:
    """As materialised(); what df's plan shuffled is deleted once df is written, not when the driver next collects garbage.

    For steps that shuffle about as much as the input. Shuffles of other plans, df's later ones included, stay.
    """
    spark, switch = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(switch, "false")
    spark.conf.set(switch, "true")
    try:
        return materialised(df.select("*"))  # a plan of its own: a plan takes the switch as it is when the plan is made
    finally:
        spark.conf.set(switch, before)


def materialised_by(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """As materialised(), dealt by the key; later groupings by the key find the partitions in place and do not shuffle again.

    The written plan keeps its partitioning only if adaptive execution, which might merge partitions, is off while it runs.
    """
    spark, switch = df.sparkSession, "spark.sql.adaptive.enabled"
    before = spark.conf.get(switch)
    spark.conf.set(switch, "false")
    try:
        return materialised(df.repartition(partitions, key))
    finally:
        spark.conf.set(switch, before)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def free_name(columns: list[str], wanted: str) -> str:
    """wanted, with underscores in front until no column of that name (case ignored) exists."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(rows: DataFrame, order: list[Column], sums: dict[str, str], group: list[str] | None = None) -> DataFrame:
    """rows with the sums of columns over all rows before, in an order without ties: sums maps a new column to the one that it sums.

    Rows are range-partitioned by group and order and written once; each partition sums on its own, starting from the sums of the
    partitions before. So no task holds a group, only its part, and a row for each partition.
    """
    group = group or []
    spread = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *[F.col(g).asc_nulls_last() for g in group], *order)
    spread = materialised(spread.withColumn("_part", F.spark_partition_id()))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    totals = spread.groupBy(*group, "_part").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    earlier = before(Window.partitionBy(*group).orderBy("_part"))
    starts = totals.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("_part").alias("_of"), *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums])
    same = spread["_part"] == starts["_of"]
    for g in group:
        same &= spread[g].eqNullSafe(starts[f"_{g}"])
    inside = before(Window.partitionBy("_part", *group).orderBy(*order))
    met = spread.join(starts if group else F.broadcast(starts), same)  # without groups: a row a partition
    return met.select(*rows.columns, *[(F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_{n}")).alias(n) for n, c in sums.items()])
