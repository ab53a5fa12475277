"""Mixing sources to target weights (DataFrame functions only).

Every row gets a hash-random key. Rows are grouped by (source, key), so repeated rows share a group and
a hot source is pre-aggregated; groups are dealt into cells of the key's leading digits, cell sums give the offset of
every cell within its source, and a window inside each cell finishes the prefix sum of sizes. No task
holds a source or all of its cells, nor the list of sources: prefix sums over cells and over sources are range-partitioned. Each source is cut where its prefix sum passes its exact budget; budgets over a
source's size take whole epochs first and cut the last one.

Targets: all sizes together are shared by weight (sources by code point, null last, weigh ``weights`` in
turn), a target stops at ``max_epochs`` times its source's size and the excess is shared again by
weight among the rest. This has a closed form: the level at which the capped sources, a prefix in the order of
cap/weight, leave the rest to the others.

Null texts have size 0; null ids, texts and sources are values like any other. Groups of equal rows at the cut
share what is left evenly (rounded down). A source of size 0 has target 0 and takes nothing. An empty table gives an
empty result. The result depends on the rows only, never on their order or partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, free_name, materialised, prefix_sums, text_or_empty

WEIGHTS = (5, 2, 1)


def size_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def key_of(seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), text_or_empty()))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """From (source, source_size), one row a source: source, source_size, target."""
    by_name = F.col("source").asc_nulls_last()
    placed = prefix_sums(sizes.withColumn("one", F.lit(1).cast("long")), [by_name], {"ordinal": "one"})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("ordinal") % len(weights) + 1).cast("int")).cast("long")
    ranked = placed.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs).withColumn("ratio", F.col("cap") / F.col("weight"))
    ranked = prefix_sums(ranked, [F.col("ratio").asc(), by_name], {"capped": "cap", "passed": "weight"})
    whole, all_weights = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    # level: what a unit of weight would get if exactly the sources before this one were capped
    level = (F.lit(whole or 0).cast("long") - F.col("capped")) / (F.lit(all_weights or 1).cast("long") - F.col("passed"))
    # the first source whose cap is not below that level fixes it
    fixed = ranked.withColumn("level", level).where("ratio >= level").agg(F.min(F.struct("passed", "level"))["level"]).first()[0]
    return ranked.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(fixed).cast("double")).alias("target"))


def _digits(rows: int, per_cell: int) -> int:
    digits = 1
    while 16**digits * per_cell < rows and digits < 8:
        digits += 1
    return digits


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, seed: str = "mix", per_cell: int = 2_000) -> tuple[DataFrame, DataFrame]:
    """(rows, cuts). rows: doc_id, source, size, key of every row. cuts, one row a source: source, source_size,
    target, epochs, cut_key, cut_size (left for the rows of cut_key), cut_rows; keys below cut_key take one more epoch."""
    rows = materialised(docs.select("doc_id", "source", size_of(text_or_empty()).alias("size"), key_of(seed).alias("key")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    budget = (
        targets(sizes, weights, max_epochs)
        .withColumn("whole", F.floor("target").cast("long"))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("whole div source_size")).otherwise(F.lit(0)).cast("long"))
        .withColumn("rest", F.col("whole") - F.col("epochs") * F.col("source_size"))
    )
    digits = _digits(rows.count(), per_cell)
    groups = rows.groupBy("source", "key").agg(F.sum("size").alias("group_size"), F.count("*").alias("cut_rows")).withColumn("cell", F.substring("key", 1, digits))
    cells = groups.groupBy("source", "cell").agg(F.sum("group_size").alias("cell_size"))
    offsets = prefix_sums(cells, [F.col("cell").asc()], {"offset": "cell_size"}, ["source"])
    same_source = lambda a, b: a["source"].eqNullSafe(b["source"])
    # only the cell that holds the cut needs its rows in order
    cut_cells = (
        offsets.alias("o")
        .join(budget.alias("b"), F.col("o.source").eqNullSafe(F.col("b.source")))
        .where("offset <= rest and rest < offset + cell_size")
        .select("o.source", "cell", "offset", "rest")
    )
    at = (
        groups.alias("g")
        .join(cut_cells.alias("c"), F.col("g.source").eqNullSafe(F.col("c.source")) & (F.col("g.cell") == F.col("c.cell")))
        .select("g.source", "g.key", "group_size", "cut_rows", "rest", "offset", "g.cell")
        .withColumn("start", F.col("offset") + F.sum("group_size").over(Window.partitionBy("source", "cell").orderBy("key")) - F.col("group_size"))
        .where("start <= rest and rest < start + group_size")
        .select("source", F.col("key").alias("cut_key"), (F.col("rest") - F.col("start")).alias("cut_size"), "cut_rows")
    )
    cuts = budget.join(at, same_source(budget, at), "left").select(budget["source"], "source_size", "target", "epochs", "cut_key", "cut_size", "cut_rows")
    return rows, materialised(cuts)


def _taken(size: Column) -> Column:
    part = F.when(F.col("key") < F.col("cut_key"), size).when(F.col("key") == F.col("cut_key"), F.least(size, F.expr("cut_size div cut_rows"))).otherwise(F.lit(0))
    return F.col("epochs") * size + F.coalesce(part, F.lit(0))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target, taken: one row for each row of docs."""
    rows, cuts = plan_mix(docs, weights, max_epochs, seed)
    return (
        rows.alias("r")
        .join(cuts.alias("c"), F.col("r.source").eqNullSafe(F.col("c.source")))
        .select("doc_id", "size", "source_size", "target", _taken(F.col("size")).cast("long").alias("taken"))
    )


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """The mixed corpus, in the columns of docs: a row stands once for every epoch that takes it whole, and once more
    if the cut takes at least half of its words in the last one; texts are never shortened."""
    _, cuts = plan_mix(docs, weights, max_epochs, seed)
    columns = docs.columns
    names = {c: free_name(columns, f"mix_{c}") for c in ("key", "size", "source", "epochs", "cut_key", "cut_size", "cut_rows", "copy")}
    cuts = cuts.select(*[F.col(c).alias(names[c]) for c in ("source", "epochs", "cut_key", "cut_size", "cut_rows")])
    keyed = docs.withColumn(names["key"], key_of(seed)).withColumn(names["size"], size_of(text_or_empty()))
    n = {k: F.col(v) for k, v in names.items()}
    share = F.expr(f"{names['cut_size']} div {names['cut_rows']}")
    last = F.when(n["key"] < n["cut_key"], 1).when((n["key"] == n["cut_key"]) & (n["size"] > 0) & (share * 2 >= n["size"]), 1).otherwise(0)
    copies = (n["epochs"] + F.coalesce(last, F.lit(0))).cast("int")
    return (
        keyed.join(cuts, F.col("source").eqNullSafe(n["source"]))
        .withColumn(names["copy"], F.explode(F.array_repeat(F.lit(1), copies)))
        .select(*[F.col(f"`{c}`") for c in columns])
    )
