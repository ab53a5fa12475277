"""Exact dedup by an extendible-hash index on shared files (DataFrame functions only).

1. Every text is normalised (ASCII white space deleted) and hashed to 64 bits.
2. The directory. A bucket that holds more than ``capacity`` distinct hashes is split at its next bit, and the directory doubles
   whenever a bucket as deep as the directory splits; there is no limit to the depth. The outcome is written down
   directly: a bucket's depth is the least number of leading bits at which no more than ``capacity`` hashes share them, and the
   directory's depth is that of its deepest bucket. Counting is distributed; the driver sees the largest count only.
3. Rows are addressed through the directory to (bucket, hash) and pre-aggregated with their normalised bytes before the
   shuffle, so a group of copies costs one row a task. Grouping on the bytes themselves compares them.
4. Owner tasks take ranges of (bucket, hash), chain the different texts that collide on one hash, and write their buckets to a
   shared file in key order, without the texts.
5. Each row finds its entry through the directory by (bucket, hash, SHA-256). Groups of more than ``max(HOT, rows / HOT_GROUPS)`` rows, of
   which there are at most ``HOT_GROUPS``, are looked up in a broadcast, so their rows stay where they are; all others
   meet their entries by a join, in which no group is larger than that.

The directory is broadcast while it has at most ``2 * CELLS`` cells. Capacity is at least hashes / CELLS * 4, which keeps it there, as
hashes are spread evenly; should it be larger still, it is joined without broadcast.

Null texts count as empty; empty texts form one group. Of a group the row with the most code points in
its original text stays, then the smallest doc_id (null ids last). Rows that repeat a doc_id are
rows of their own: each is returned, and of rows alike in all this one stays. An empty table gives an empty result. Extra input
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialised, run_folder, shuffle_partitions, text_or_empty

#: The ASCII white space that normalisation deletes.
DELETED = " \t\n\x0b\x0c\r"
CELLS = 1 << 18
HOT, HOT_GROUPS = 500, 10_000


def normalised(text: Column) -> Column:
    return F.translate(text, DELETED, "")


def _prefix(h: Column, bits: int) -> Column:
    """The first bits of a signed 64-bit hash, unsigned."""
    return F.shiftrightunsigned(h, 64 - bits) if bits else F.lit(0).cast("long")


class Directory:
    """Extendible-hash directory: cells of ``depth`` bits, each with its bucket (the bucket's first cell) and the bucket's own depth."""

    def __init__(self, depth: int, cells: DataFrame):
        self.depth, self.cells = depth, materialised(cells)
        self.size = self.cells.count()

    def address(self, keyed: DataFrame) -> DataFrame:
        """keyed (column h) with its bucket."""
        if not self.depth:
            return keyed.withColumn("bucket", F.lit(0).cast("long"))
        cells = self.cells.select("cell", "bucket")
        cells = F.broadcast(cells) if self.size <= 2 * CELLS else cells
        return keyed.withColumn("cell", _prefix(F.col("h"), self.depth)).join(cells, "cell").drop("cell")


def _histogram(hashes: DataFrame, capacity: int, bits: int) -> tuple[DataFrame, int]:
    """Counts of the hashes by so many leading bits or more: enough that no cell holds more than capacity."""
    while True:
        counts = materialised(hashes.groupBy(_prefix(F.col("h"), bits).alias("cell")).agg(F.count("*").alias("n")))
        if (counts.agg(F.max("n")).first()[0] or 0) <= capacity:  # 64 bits hold one hash a cell
            return counts, bits
        bits = min(64, bits + 3)


def build_directory(hashes: DataFrame, capacity: int) -> Directory:
    """hashes: distinct values h."""
    n = hashes.count()
    capacity = max(1, capacity, -(-n * 4 // CELLS))
    counts, bits = _histogram(hashes, capacity, 0 if n <= capacity else min(64, math.ceil(math.log2(n / capacity)) + 2))
    # every node above a cell, and the cell's bucket: the highest node that is not overfull
    node = F.when(F.col("deep") == 0, F.lit(0).cast("long")).otherwise(F.expr(f"shiftrightunsigned(cell, {bits} - deep)"))
    above = counts.withColumn("deep", F.explode(F.sequence(F.lit(0), F.lit(bits)))).withColumn("node", node)
    fitting = above.groupBy("deep", "node").agg(F.sum("n").alias("held")).where(F.col("held") <= capacity)
    local = above.join(fitting, ["deep", "node"]).groupBy("cell").agg(F.min("deep").alias("local"))
    local = materialised(local)
    depth = local.agg(F.max("local")).first()[0] or 0
    if not depth:
        return Directory(0, hashes.sparkSession.createDataFrame([(0, 0, 0)], "cell long, local int, bucket long"))
    cells = local.select(F.shiftrightunsigned("cell", bits - depth).alias("cell"), "local").distinct()
    first = F.when(F.col("local") == 0, F.lit(0).cast("long")).otherwise(F.expr(f"shiftleft(shiftrightunsigned(cell, {depth} - local), {depth} - local)"))
    return Directory(depth, cells.withColumn("bucket", first))


def _rank() -> Column:
    """A number that orders rows as they are to be kept: points, then known ids, then small ids."""
    number = lambda n: F.lit(Decimal(n))
    own = F.coalesce(number(2**64 + 2**63 - 1) - F.col("doc_id").cast("decimal(20,0)"), number(0))
    return (F.col("points").cast("decimal(11,0)") * number(2**66) + own).cast("decimal(38,0)").alias("rank")


def build_index(keyed: DataFrame, directory: Directory) -> DataFrame:
    """Entries bucket, h, text_sha256, chain, group_size, keep_id, rank (of the row to keep) from rows with doc_id, points, h and norm."""
    entries = (
        directory.address(keyed.select("doc_id", "h", "norm", _rank()))
        .groupBy("bucket", "h", "norm")
        .agg(F.count("*").alias("group_size"), F.max("rank").alias("rank"), F.max_by("doc_id", "rank").alias("keep_id"))
        .select("bucket", "h", F.sha2("norm", 256).alias("text_sha256"), "group_size", "rank", "keep_id")
    )
    owners = entries.repartitionByRange(shuffle_partitions(keyed.sparkSession), "bucket", "h")
    chained = owners.withColumn("chain", F.row_number().over(Window.partitionBy("bucket", "h").orderBy("text_sha256")).cast("long") - 1)
    place = run_folder(keyed.sparkSession, "exact-index")
    chained.write.parquet(place)
    return keyed.sparkSession.read.parquet(place)


def exact_dedup(docs: DataFrame, capacity: int = 500, hash_of: Callable[[str], Column] = F.xxhash64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, chain: one row for each row of docs.

    chain is the text's place among different texts of one 64-bit hash (0 unless hashes collide).
    """
    text, key = text_or_empty(), ["bucket", "h", "text_sha256"]
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.char_length(text).cast("long").alias("points"), normalised(text).alias("norm"))
    keyed = keyed.withColumn("h", hash_of("norm"))
    rows = materialised(keyed.select("doc_id", "points", "h", F.sha2("norm", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("rid")))
    directory = build_directory(materialised(rows.select("h").distinct()), capacity)
    index = build_index(keyed, directory)

    most = max(HOT, -(-rows.count() // HOT_GROUPS))
    hot, cold = (F.broadcast(index.where(F.col("group_size") > most)), index.where(F.col("group_size") <= most))
    own = directory.address(rows.select("doc_id", "h", "text_sha256", "rid", _rank().alias("own")))
    best = F.when(F.col("own") == F.col("rank"), F.col("rid"))
    # rows of hot groups leave before the shuffle that brings the others to their entries
    found = own.join(F.broadcast(hot.select(*key)), key, "left_anti").join(cold, key).withColumn("stays", F.min(best).over(Window.partitionBy(*key)))
    met = own.join(hot, key)
    stays = met.groupBy(*key).agg(F.min(best).alias("stays"))  # at most HOT_GROUPS rows
    found = found.unionByName(met.join(F.broadcast(stays), key))
    return found.select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("stays")).alias("kept"), "text_sha256", "chain")
