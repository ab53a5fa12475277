"""Outbound links of pages.

HTML is parsed in Python, in Arrow batches: a parser and RFC 3986 resolution have no built-in counterpart.
"""

from __future__ import annotations

from collections.abc import Sequence
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import host_suffixes, netloc
from ..session import ship_package

ANCHOR_LIMIT = 200


class _Anchors(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, list[str]]] = []
        self.open: list[list[str]] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "a":
            href = dict(attrs).get("href")
            text: list[str] = []
            if href is not None:
                self.found.append((href, text))
            self.open.append(text)

    def handle_endtag(self, tag: str) -> None:
        if tag == "a" and self.open:
            self.open.pop()

    def handle_data(self, data: str) -> None:
        if text := data.strip():
            for own in self.open:
                own.append(text)


def links_of(html: str, page_url: str) -> list[tuple[str, str]]:
    """(absolute URL, anchor text) in document order."""
    parser = _Anchors()
    parser.feed(html)
    parser.close()
    out = []
    for href, text in parser.found:
        target = href.strip()
        if not target or target.startswith(("#", "javascript:")):
            continue
        try:
            target = urljoin(page_url, target)
        except ValueError:
            continue
        if target.startswith(("http://", "https://")):
            out.append((target, "".join(text)[:ANCHOR_LIMIT]))
    return out


LINKS = "array<struct<target_url: string, anchor_text: string>>"
_LINKS = pa.list_(pa.struct([("target_url", pa.string()), ("anchor_text", pa.string())]))


def with_links(pages: DataFrame) -> DataFrame:
    """pages (url, html, ...) with links, in document order. Row-local; a page that cannot be parsed has none.

    The parser is marked as not deterministic, so that the optimiser does not repeat it for conditions on its result.
    """
    ship_package(pages.sparkSession)

    @F.arrow_udf(LINKS)
    def parse(url: pa.Array, html: pa.Array) -> pa.Array:
        out = []
        for u, h in zip(url, html, strict=True):
            try:
                found = links_of(h.as_py() or "", u.as_py() or "")
            except (AssertionError, ValueError):
                found = []
            out.append([{"target_url": t, "anchor_text": a} for t, a in found])
        return pa.array(out, _LINKS)

    return pages.withColumn("links", parse.asNondeterministic()("url", "html"))


def extract_links(pages: DataFrame) -> DataFrame:
    """source_url, position, target_url, anchor_text of pages with links (which are parsed if the column is not there)."""
    linked = pages if "links" in pages.columns else with_links(pages)
    return linked.select(F.col("url").alias("source_url"), F.posexplode("links").alias("position", "link")).select("source_url", "position", "link.*")


def is_excluded(host: Column, excluded: Sequence[str]) -> Column:
    """Whether a host is an excluded domain or below one.

    Each of the host's few suffixes is looked up in a constant set: no join, whatever the length of the list.
    """
    return F.exists(host_suffixes(host), lambda s: s.isin(list(excluded))) if excluded else F.lit(False)


def outlink_count(links: Column, excluded: Sequence[str]) -> Column:
    return F.size(F.filter(links, lambda x: ~is_excluded(netloc(x["target_url"]), excluded)))


def without_excluded(rows: DataFrame, host: str, excluded: Sequence[str]) -> DataFrame:
    return rows.where(~is_excluded(F.col(host), excluded))


def link_facts(pages: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    """source_url, position, target_url, target_domain, anchor_text, without excluded targets."""
    links = extract_links(pages).withColumn("target_domain", netloc(F.col("target_url")))
    return without_excluded(links, "target_domain", excluded)
