"""Ordered first-match platform classifier.

Signals are plain substrings in order of precedence. They are searched in Python, in Arrow batches: its substring search is faster
than expressions over 198 needles a page, and it lower-cases and stops as the table's order asks.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import generator
from ..plans.values import ENGINES, Engine
from ..session import ship_package

RESULT = "struct<engine_category: string, engine_name: string, signal: string>"


def signals(engines: Sequence[Engine] = ENGINES) -> list[tuple[str, str, str, str]]:
    """(channel, needle, category, name) in order: engine by engine, generator before URL before page."""
    return [(c, s, e.category, e.name) for e in engines for c, needles in (("generator", e.generator), ("url", e.url), ("html", e.html)) for s in needles]


def load_engines(path: str) -> tuple[Engine, ...]:
    """Engines of a JSON file, in its order: {"engines": [{"category", "name", "generator", "html_contains", "url_path_contains"}]}."""
    needles = lambda e, k: tuple(s.lower() for s in e.get(k, ()))
    rows = json.loads(Path(path).read_text(encoding="utf-8"))["engines"]
    return tuple(Engine(e["category"], e["name"], needles(e, "generator"), needles(e, "html_contains"), needles(e, "url_path_contains")) for e in rows)


class Matcher:
    """Finds the first signal, in the common order, that a page shows in any channel."""

    def __init__(self, engines: Sequence[Engine]):
        self.order = signals(engines)
        self.channels = [[(i, s) for i, (c, s, _, _) in enumerate(self.order) if c == channel] for channel in ("generator", "url", "html")]

    def place(self, *texts: str) -> int | None:
        best = len(self.order)
        for needles, text in zip(self.channels, texts, strict=True):
            if text:
                best = min(best, next((i for i, s in needles if i >= best or s in text), best))
        return best if best < len(self.order) else None


def classify(html: Column, url: Column, engines: Sequence[Engine] = ENGINES) -> Column:
    """struct(engine_category, engine_name, signal), all null if nothing matches.

    Marked as not deterministic, so that the optimiser neither repeats it nor moves it: it runs once a page.
    """
    matcher = Matcher(engines)
    named = [pa.array([x[2] for x in matcher.order], pa.string()), pa.array([x[3] for x in matcher.order], pa.string()), pa.array([f"{x[0]}:{x[1]}" for x in matcher.order], pa.string())]

    @F.arrow_udf(RESULT)
    def run(generator: pa.Array, url: pa.Array, html: pa.Array) -> pa.Array:
        low = lambda x: (x.as_py() or "").lower()
        at = pa.array([matcher.place(low(g), low(u), low(h)) for g, u, h in zip(generator, url, html, strict=True)], pa.int32())
        return pa.StructArray.from_arrays([column.take(at) for column in named], ["engine_category", "engine_name", "signal"])

    return run.asNondeterministic()(generator(html), url, html)


def classified(pages: DataFrame, engines: Sequence[Engine] = ENGINES) -> DataFrame:
    """pages (html, url, ...) with engine_category, engine_name and signal."""
    ship_package(pages.sparkSession)
    return pages.withColumn("_c", classify(F.col("html"), F.col("url"), engines)).select("*", "_c.*").drop("_c")


def known_categories(engines: Sequence[Engine] = ENGINES) -> list[str]:
    """(A19)"""
    return sorted({e.category for e in engines})
