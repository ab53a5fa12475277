"""HTML functions as column expressions, without a parser."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters searched for the generator when a page has no </head>.
HEAD_LIMIT = 400_000


def head_of(html: Column) -> Column:
    """Text up to and with the first </head>; the position is that in the lower-cased text."""
    at = F.locate("</head>", F.lower(html))
    return F.when(at > 0, F.substring(html, F.lit(1), at + 6)).otherwise(F.substring(html, F.lit(1), F.lit(HEAD_LIMIT)))


def generator(html: Column) -> Column:
    """Lower-case content of the first meta tag that names a generator and quotes its content; '' if none. (F1)"""
    tags = F.when(F.contains(F.lower(html), F.lit("generator")), F.regexp_extract_all(head_of(html), F.lit(r"(?iU)<meta\b[^>]*>"), F.lit(0))).otherwise(F.array().cast("array<string>"))
    content = F.transform(
        F.filter(tags, lambda m: F.rlike(m, F.lit(r"""(?iU)name\s*=\s*["']?\s*generator""")) & F.rlike(m, F.lit(r"""(?iU)content\s*=\s*["']"""))),
        lambda m: F.regexp_extract(m, r"""(?iU)content\s*=\s*["']([^"'>]*)""", 1),
    )
    return F.lower(F.coalesce(F.get(content, F.lit(0)), F.lit("")))


def title(html: Column, limit: int = 90) -> Column:
    """Text of the first title element."""
    return F.left(F.trim(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title", 1)), F.lit(limit))


def snippet(html: Column, limit: int = 400) -> Column:
    """Start of the visible text: no scripts, styles or tags, white space collapsed. Entities stay as written. (F8)"""
    bare = F.regexp_replace(html, r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.left(F.trim(F.regexp_replace(bare, r"(?U)\s+", " ")), F.lit(limit))
