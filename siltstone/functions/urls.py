"""URL functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def netloc(url: Column) -> Column:
    """Authority of a URL in lower case, with user and port; '' if there is none.

    A regular expression, because parse_url refuses odd URLs and drops user and port.
    """
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))


def host_suffixes(host: Column) -> Column:
    """a.b.c -> [a.b.c, b.c, c]: turns 'is, or ends with .d' into an equality."""
    labels = F.split(F.coalesce(host, F.lit("")), r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def in_shard(url: Column, shards: int, shard: int) -> Column:
    """CRC-32 of the URL modulo the number of shards."""
    return F.pmod(F.crc32(url), F.lit(shards)) == shard


def url_hash(url: Column) -> Column:
    """32 raw bytes of SHA-256."""
    return F.unhex(F.sha2(url, 256))


def index_pattern(domain: Column) -> Column:
    """What to ask a URL index for: the pattern itself, or everything of the domain."""
    return F.when(F.contains(domain, F.lit("*")), domain).otherwise(F.concat(domain, F.lit("/*")))
