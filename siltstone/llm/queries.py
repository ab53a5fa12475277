"""The registered queries of this subpackage, with SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, exact_dedup, licences, mixing, pii, quality, sharding, simhash, suffix_dedup, toxicity
from .common import table

SHARDS = 64


def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels table marks two categories: junk (quality 0), then toxic."""
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    return toxicity.toxicity(table(spark, sf_dir, "documents"), labels, ["junk", "toxic"])


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign_shards(docs, sharding.shard_names(SHARDS)).select("doc_id", "slot", "shard")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(*columns)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_repeated_passages, op2_decontamination, op3_toxicity, op4_sharding, op5_quality, op6_licences, op7_simhash, op8_exact_dedup, op9_mixing, op10_pii)}


OP8_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM n
"""

OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS k
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source
), w AS (
  SELECT *, CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS cap FROM s
), o AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS DOUBLE)
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level,
         row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST) AS place
  FROM w WINDOW before AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (SELECT arg_min(level, place) AS fixed FROM o WHERE CAST(cap AS DOUBLE) / weight >= level),
t AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * fixed) AS target FROM o, f
), b AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t
), g AS (
  SELECT d.source, k, sum(size) AS group_size, count(*) AS copies FROM d GROUP BY d.source, k
), p AS (
  SELECT g.*, sum(group_size) OVER (PARTITION BY source ORDER BY k) - group_size AS start FROM g
), c AS (
  SELECT p.source, p.k, CAST(floor(b.target) AS BIGINT) - b.epochs * b.source_size - p.start AS spare, p.group_size, p.copies
  FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source
)
SELECT d.doc_id, d.size, b.source_size, b.target,
       CAST(b.epochs * d.size + CASE WHEN c.spare >= c.group_size THEN d.size WHEN c.spare <= 0 THEN 0 ELSE least(d.size, c.spare // c.copies) END AS BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source JOIN c ON c.source IS NOT DISTINCT FROM d.source AND c.k = d.k
"""


def _licence_sql() -> str:
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    rows = ", ".join(
        f"('{name}', [{', '.join(map(quoted, grams))}], {low}, {high})"
        for name, grams in licences.flat_templates(licences.TEMPLATES)
        for low, high in [licences.bounds(len(grams), 0.8)]
    )
    return rf"""
WITH t(name, grams, low, high) AS (VALUES {rows}),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
s AS (
  SELECT r, unnest(list_distinct(list_concat(list_concat(string_split(x, chr(10)), regexp_split_to_array(x, '\n[\x20\x09\x0D]*\n')), [x]))) AS seg FROM d
), w AS (
  SELECT r, list_filter(regexp_split_to_array(lower(seg), '[^\p{{L}}\p{{N}}]+'), lambda v: v <> '') AS words FROM s
), g AS (
  SELECT DISTINCT r, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS grams FROM w WHERE len(words) > 1
), m AS (
  SELECT r, t.name, 2.0::DOUBLE * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)) AS dice
  FROM g JOIN t ON len(g.grams) BETWEEN t.low AND t.high
), found AS (
  SELECT r, array_to_string(list_sort(list_distinct(list(name))), ',') AS licences, max(dice) AS best_dice, count(*) AS n_matches FROM m WHERE dice >= 0.8 GROUP BY r
)
SELECT d.doc_id, licences, best_dice, coalesce(n_matches, 0) AS n_matches FROM d LEFT JOIN found USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_licences": _licence_sql(), "op8_exact_dedup": OP8_SQL, "op9_mixing": OP9_SQL}
