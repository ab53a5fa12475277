"""Sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a prime-sized table: a start and a stride taken from
digests of its name. Shards take turns, each claiming the first free slot of its order, until the table is
full; so shares differ by at most one slot, and when a shard leaves, few slots of the others move. The table is
broadcast (its size is a parameter, never the data's) and a document is placed by one look-up: no shuffle.

The place of a document depends on its key columns only. Null keys are a value of their own; the text's
digest is part of the default key, so rows without ids spread too. Repeated rows go to one shard. An
empty table gives an empty result. Extra columns are kept, clashing names included.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

#: Prime; over 100 slots a shard for up to 655 shards, so shares differ by under 1 %.
TABLE_SIZE = 65537


def shard_names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}|{name}".encode()).digest()[:8], "big")


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(names: list[str], size: int = TABLE_SIZE) -> list[int]:
    """table[slot] = index into names."""
    if not _is_prime(size):
        raise ValueError(f"table size {size} is not prime")
    if not names or len(set(names)) != len(names) or len(names) > size:
        raise ValueError("need distinct shard names, at most one a slot")
    strides = [_number(n, "stride") % (size - 1) + 1 for n in names]
    at = [_number(n, "start") % size for n in names]
    table, free = [-1] * size, size
    while True:
        for shard in range(len(names)):
            slot = at[shard]
            while table[slot] >= 0:
                slot = (slot + strides[shard]) % size
            table[slot] = shard
            at[shard] = (slot + strides[shard]) % size
            free -= 1
            if not free:
                return table


def slot_of(size: int, *key: Column) -> Column:
    """Slot of a key: the first 60 bits of the MD5 of its parts, modulo the table's size."""
    text = F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("\u0000")) for k in key])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def assign_shards(docs: DataFrame, names: list[str], size: int = TABLE_SIZE, key: list[Column] | None = None) -> DataFrame:
    """docs with the columns slot and shard (under free names if docs has such columns)."""
    key = key or [F.col("doc_id"), F.md5(F.coalesce(F.col("text"), F.lit("")))]
    table = fill_table(names, size)
    slot, shard = free_name(docs.columns, "slot"), free_name(docs.columns, "shard")
    lookup = docs.sparkSession.createDataFrame([(i, names[s]) for i, s in enumerate(table)], f"`{slot}` int, `{shard}` string")
    placed = docs.withColumn(slot, slot_of(size, *key)).join(F.broadcast(lookup), slot, "left")
    return placed.select(*[F.col(f"`{c}`") for c in [*docs.columns, slot, shard]])
