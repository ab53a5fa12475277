"""The dashboard roll-up."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def totals(pages: DataFrame) -> DataFrame:
    """pages, domains, classified, classified_pct (rounded half to even; null without pages)."""
    counted = pages.agg(F.count("*").alias("pages"), F.countDistinct("domain").alias("domains"), F.count("engine_category").alias("classified"))
    return counted.withColumn("classified_pct", F.bround(F.try_divide(F.lit(100.0) * F.col("classified"), F.col("pages")), 0).cast("long"))


def categories(pages: DataFrame) -> DataFrame:
    """Sites of each category."""
    sites = pages.where(F.col("engine_category").isNotNull()).select("engine_category", "domain").distinct()
    return sites.groupBy("engine_category").agg(F.count("*").alias("sites")).orderBy(F.desc("sites"), "engine_category")


def platforms(pages: DataFrame, limit: int = 16) -> DataFrame:
    """(D3)"""
    counted = pages.where(F.col("engine_name").isNotNull()).groupBy("engine_name").agg(F.countDistinct("domain").alias("sites"))
    return counted.orderBy(F.desc("sites"), "engine_name").limit(limit)


def dominant(pages: DataFrame) -> DataFrame:
    """Sites of each (bucket, category), a site counting for the category of most of its pages; ties: first by name.

    The best category of a site is an aggregate, not a window, so it is combined before the shuffle.
    """
    counted = pages.where(F.col("engine_category").isNotNull()).groupBy("bucket", "domain", "engine_category").agg(F.count("*").alias("n"))
    best = counted.groupBy("bucket", "domain").agg(F.min(F.struct((-F.col("n")).alias("minus"), F.col("engine_category").alias("category"))).alias("best"))
    return best.groupBy("bucket", F.col("best.category").alias("engine_category")).agg(F.count("*").alias("sites"))


def bucket_domains(pages: DataFrame) -> DataFrame:
    """(D5)"""
    return pages.where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.countDistinct("domain").alias("domains"))


def bucket_top(pages: DataFrame, limit: int = 5) -> DataFrame:
    """The platforms with most sites in each bucket, with their rank."""
    sites = pages.where(F.col("engine_name").isNotNull()).select("bucket", "engine_name", "domain").distinct()
    counted = sites.groupBy("bucket", "engine_name").agg(F.count("*").alias("sites"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("sites"), "engine_name"))
    return counted.withColumn("place", place).where(F.col("place") <= limit)


def buckets(pages: DataFrame) -> DataFrame:
    """One row a bucket: name, domains, cats (map), top (array), most sites first."""
    cats = dominant(pages).groupBy("bucket").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("engine_category", "sites")))).alias("cats"))
    ranked = F.sort_array(F.collect_list(F.struct("place", "engine_name", "sites")))
    top = bucket_top(pages).groupBy("bucket").agg(F.transform(ranked, lambda x: F.struct(x["engine_name"].alias("name"), x["sites"].alias("sites"))).alias("top"))
    none = F.expr("map()").cast("map<string,bigint>"), F.expr("array()").cast("array<struct<name:string,sites:bigint>>")
    return (
        bucket_domains(pages)
        .join(cats, "bucket", "left")
        .join(top, "bucket", "left")
        .select(F.col("bucket").alias("name"), "domains", F.coalesce("cats", none[0]).alias("cats"), F.coalesce("top", none[1]).alias("top"))
    )


def document(pages: DataFrame) -> dict[str, Any]:
    """The whole dashboard, put together on the driver: a row for each bucket and category, however many pages there are."""
    total = totals(pages).first()
    by_size = buckets(pages).orderBy(F.desc("domains"), "name").collect()
    return {
        "pages": total["pages"],
        "domains": total["domains"],
        "classified_pct": total["classified_pct"],
        "cats": [list(r) for r in categories(pages).collect()],
        "platforms": [list(r) for r in platforms(pages).collect()],
        "buckets": [{"name": r["name"], "domains": r["domains"], "cats": r["cats"], "top": [list(t) for t in r["top"]]} for r in by_size],
    }


def export(pages: DataFrame, path: str) -> None:
    Path(path).write_text(json.dumps(document(pages), ensure_ascii=False), encoding="utf-8")
