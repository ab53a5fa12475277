"""SimHash near-duplicates by a binary trie self-join.

1. Each text gets a 64-bit fingerprint: ASCII letters lower-cased, words split at ASCII white space, shingles of
   ``words`` words (repeats count; fewer words: all of them as one shingle), each hashed by XXH64 with seed 42; a bit is 1 if set in
   over half of the hashes. No words: fingerprint zero, which is linked like any other.
2. Equal fingerprints form a class before anything is compared, so groups of copies are one row.
3. ``budget`` differing bits leave one of budget + 1 blocks of bits untouched. So there are budget + 1 tries, each over the
   fingerprints turned until another block comes first, and in each the node pairs of the first block have no error to spend: only a node
   with itself. Every class goes to one node of each trie, whatever the number of classes.
4. Nodes with more than ``capacity`` classes (a corpus of near copies) are walked further before they are dealt: pairs of their
   descendants some bits below, pruned by the budget, so that no task holds such a node.
5. A task walks its nodes' pairs together, level by level in NumPy in chunks of bounded size: differing bits add up and a pair is
   pruned as soon as they exceed the budget. It keeps a spanning forest of the links it finds: at most one row a class and node.
6. Connected components over the forests give the smallest reachable doc_id.

Null texts count as empty. Rows without doc_id take part; a group with no other rows has a null component_id. Repeated rows are
rows of their own. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialised, ship_package, text_or_empty
from .components import connected_components


def fingerprint(text: bytes, words: int = 3) -> int:
    w = text.lower().split()  # bytes: exactly ASCII letters and ASCII white space
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts[: len(w) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[at : at + (1 << 14)], np.uint64)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, h (hash of the text), fp (as a signed long): a row for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py(), words) for t in texts), np.uint64, batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps, pa.int64())], ["doc_id", "h", "fp"])

    ship_package(docs.sparkSession)
    return docs.select(id_of(), text_or_empty().alias("text"), text_hash()).mapInArrow(run, "doc_id long, h long, fp long")


def text_hash() -> Column:
    return F.xxhash64(text_or_empty()).alias("h")


def id_of() -> Column:
    return F.col("doc_id").cast("long").alias("doc_id")


# --- the trie ------------------------------------------------------------------------------------


def walk_pairs(a: np.ndarray, nodes: np.ndarray, budget: int, depth: int = 0, chunk: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i < j, with popcount(a[i] ^ a[j]) <= budget below pairs of trie nodes.

    nodes: rows (from, to, from, to) of two ranges of a that are the same or apart, the first one first; within a range a is sorted,
    without repeats, and the first ``depth`` bits of both are equal. Each level splits both ranges at the next bit; equal bits keep
    the count of differing bits, unequal ones add one, and counts over the budget are pruned. Pairs of small nodes are compared directly.
    """
    levels: dict[int, np.ndarray] = {}

    def ones(depth: int) -> np.ndarray:
        """Set bits at this depth before each place of a; only for the levels that are reached."""
        if depth not in levels:
            levels[depth] = np.concatenate((np.zeros(1, np.int32), np.cumsum((a >> np.uint64(63 - depth)) & np.uint64(1), dtype=np.int32)))
        return levels[depth]

    if not len(nodes):
        return
    stack = [(depth, np.column_stack((nodes, np.zeros(len(nodes), np.int64))).astype(np.int64))]
    while stack:
        depth, nodes = stack.pop()
        if len(nodes) > chunk:
            stack += [(depth, part) for part in np.array_split(nodes, -(-len(nodes) // (chunk // 2)))]
            continue
        na, nb = nodes[:, 1] - nodes[:, 0], nodes[:, 3] - nodes[:, 2]
        small = (na * nb <= 16) if depth < 64 else np.ones(len(nodes), bool)
        if small.any():
            part = nodes[small]
            size = (na * nb)[small]
            of = np.repeat(np.arange(len(part)), size)
            k = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
            width = (part[:, 3] - part[:, 2])[of]
            i, j = part[of, 0] + k // width, part[of, 2] + k % width
            good = (i < j) & (np.bitwise_count(a[i] ^ a[j]) <= budget)
            if good.any():
                yield i[good], j[good]
            nodes = nodes[~small]
        if not len(nodes):
            continue
        alo, ahi, blo, bhi, wrong = nodes.T
        before = ones(depth)
        amid = ahi - (before[ahi] - before[alo])
        bmid = bhi - (before[bhi] - before[blo])
        kids = [
            np.stack((alo, amid, blo, bmid, wrong), 1),
            np.stack((amid, ahi, bmid, bhi, wrong), 1),
            np.stack((alo, amid, bmid, bhi, wrong + 1), 1),
            np.stack((amid, ahi, blo, bmid, wrong + 1), 1)[alo != blo],  # of a node with itself the two mixed pairs are one
        ]
        nodes = np.concatenate(kids)
        nodes = nodes[(nodes[:, 1] > nodes[:, 0]) & (nodes[:, 3] > nodes[:, 2]) & (nodes[:, 4] <= budget)]
        if len(nodes):
            stack.append((depth + 1, nodes))


class Forest:
    """Components of the nodes 0..n-1 under links that come in blocks."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def link(self, u: np.ndarray, v: np.ndarray) -> None:
        while len(u):
            u, v = self.parent[u], self.parent[v]
            apart = u != v
            u, v = u[apart], v[apart]
            np.minimum.at(self.parent, np.maximum(u, v), np.minimum(u, v))
            while (up := self.parent[self.parent]) is not None and not np.array_equal(up, self.parent):
                self.parent = up


def block_edges(budget: int) -> list[int]:
    """Bits where the budget + 1 blocks of a fingerprint begin, and 64."""
    return [64 * i // (budget + 1) for i in range(budget + 2)]


def _join_task(budget: int):
    edges = block_edges(budget)
    common = min(b - a for a, b in zip(edges[:-1], edges[1:], strict=True))

    def run(t: pa.Table) -> pa.Table:
        turn, top, low, high, side = (t.column(c).to_numpy() for c in ("turn", "top", "low", "high", "side"))
        fp = t.column("fp").to_numpy().view(np.uint64)
        order = np.lexsort((fp, side, high, low, top, turn))
        turn, top, low, high, side, fp = (x[order] for x in (turn, top, low, high, side, fp))
        new = np.concatenate(([True], (turn[1:] != turn[:-1]) | (top[1:] != top[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])))
        start = np.flatnonzero(new)
        end = np.concatenate((start[1:], [len(fp)]))
        middle = end - np.add.reduceat(side.astype(np.int64), start)
        own = low[start] == high[start]
        nodes = np.stack((start, np.where(own, end, middle), np.where(own, start, middle), end), 1)
        nodes = nodes[np.where(own, end - start > 1, (middle > start) & (end > middle))]
        forest = Forest(len(fp))
        for i, j in walk_pairs(fp, nodes, budget, common):
            forest.link(i, j)
        linked = np.flatnonzero(forest.parent != np.arange(len(fp)))
        back = np.array(edges, np.uint64)[turn]  # turned back, so that the first bit is the first again
        plain = np.where(back > 0, fp >> back | fp << (np.uint64(64) - back) % np.uint64(64), fp)
        return pa.table({"u": plain[linked].view(np.int64), "v": plain[forest.parent[linked]].view(np.int64)})

    return run


def fingerprint_links(classes: DataFrame, budget: int = 2, capacity: int = 131_072) -> DataFrame:
    """From distinct fingerprints (column fp): u, v, edges whose components are those of all links."""
    ship_package(classes.sparkSession)
    edges = block_edges(budget)
    turned = []
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        fp = F.shiftleft("fp", a).bitwiseOR(F.shiftrightunsigned("fp", 64 - a)) if a else F.col("fp")
        turned.append(F.struct(F.lit(i).alias("turn"), F.shiftrightunsigned(fp, 64 - (b - a)).alias("top"), fp.alias("fp")))
    dealt = classes.select(F.inline(F.array(*turned)))
    crowded = materialised(dealt.groupBy("turn", "top").agg(F.count("*").alias("n")).where(F.col("n") > capacity))
    nodes, largest, rows = crowded.agg(F.count("*"), F.max("n"), F.sum("n")).first()
    n = (budget + 1) * classes.count()
    routed = dealt.withColumns({"low": F.lit(0), "high": F.lit(0), "side": F.lit(0)})
    if nodes:
        width = max(b - a for a, b in zip(edges[:-1], edges[1:], strict=True))
        deeper = min(16, 64 - width, max(1, (4 * (largest - 1) // capacity).bit_length()))
        masks = [m for m in range(1 << deeper) if m.bit_count() <= budget]
        # at most n / capacity nodes are crowded
        crowded = crowded.drop("n")
        marked = dealt.join(F.broadcast(crowded) if nodes <= 100_000 else crowded, ["turn", "top"])
        rest = routed.join(F.broadcast(crowded) if nodes <= 100_000 else crowded, ["turn", "top"], "left_anti")
        block = F.element_at(F.array(*[F.lit(b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]), F.col("turn") + 1)
        marked = marked.withColumn("block", block).withColumn("below", F.expr(f"int(shiftrightunsigned(shiftleft(fp, block), {64 - deeper}))"))
        marked = marked.withColumn("other", F.explode(F.array(*[F.col("below").bitwiseXOR(F.lit(m)) for m in masks])))
        low, high = F.least("below", "other"), F.greatest("below", "other")
        marked = marked.select("turn", "top", "fp", low.alias("low"), high.alias("high"), (F.col("below") > F.col("other")).cast("int").alias("side"))
        routed, n = rest.select(*marked.columns).unionByName(marked), n + rows * len(masks)
    tasks = max(1, -(-n // (2 * capacity)))
    task = F.pmod(F.xxhash64("turn", "top", "low", "high"), F.lit(tasks))
    return routed.withColumn("task", task).groupBy("task").applyInArrow(_join_task(budget), "u long, v long")


def labelled(docs: DataFrame, words: int = 3, budget: int = 2) -> DataFrame:
    """doc_id, h, fp, root (a fingerprint that names the group), component (its smallest doc_id): a row for each row of docs."""
    rows = materialised(fingerprints(docs, words))
    classes = materialised(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = connected_components(fingerprint_links(classes.select("fp"), budget))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(smallest, "root").select("fp", "root", "component")
    return rows.join(named, "fp").select("doc_id", "h", "fp", "root", "component")


def near_duplicates(docs: DataFrame, words: int = 3, budget: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: a row for each row of docs."""
    found = labelled(docs, words, budget)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def carrier() -> Column:
    """What names one row of a group: the smallest doc_id (null last), then the smallest text hash."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "h"))


def keep_smallest(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """docs with one row a group: the smallest doc_id (null last), then the smallest text hash. groups: doc_id, h, root, a row for each row of docs."""
    kept_id, kept_hash = (free_name(docs.columns, c) for c in ("kept_id", "kept_hash"))
    kept = groups.groupBy("root").agg(carrier().alias("row")).select(F.col("row.doc_id").alias("one_id"), F.col("row.h").alias("one_hash"))
    keyed = docs.withColumn(kept_id, id_of()).withColumn(kept_hash, text_hash())
    same = keyed[kept_id].eqNullSafe(kept["one_id"]) & (keyed[kept_hash] == kept["one_hash"])
    # rows that repeat both are combined before the shuffle
    return keyed.join(kept, same, "left_semi").dropDuplicates([kept_id, kept_hash]).select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_one(docs: DataFrame, words: int = 3, budget: int = 2) -> DataFrame:
    """docs without rows of like fingerprints: of each group one row with the smallest id stays, even where ids or rows repeat.

    Links are not verified: fingerprints say little about the share of common shingles. See minhash.keep_one for that.
    """
    return keep_smallest(docs, labelled(docs, words, budget))
