"""Removal of long repeated passages by run-length indexes.

A byte goes if it lies in a ``length``-byte string that also starts in a document with a smaller doc_id. The corpus is cut so that
equal strings meet in one task, whatever their number, and each task indexes what it got:

1. Texts are dealt into blocks of about ``BLOCK`` bytes, compressed, and written to the shared folder once.
2. A window (a string of ``length`` bytes) is keyed by the least hash of its ``ANCHOR``-byte substrings, so equal windows have equal keys
   and neighbouring windows mostly share one: a run of windows with one key is a piece. Each block sends its distinct keys,
   packed, to the tasks that own key ranges, and gets back which keys other documents have too, and which are very frequent. Keys of
   one document only, which is most of them, end here.
3. Blocks send the pieces of repeated keys to the owners. Pieces equal to an earlier document's in the same block are settled there
   and stay, so a passage costs one piece a block however many copies there are. Pieces of very frequent keys are cut
   into single windows, which are owned by their whole content: a common line in many surroundings spreads over all owners.
4. An owner builds a run-length index (see runindex) of its distinct pieces in order of their smallest doc_id, streams
   matching statistics and finds for each window the first document that has it; windows of later documents are marked.
5. Blocks merge the marks and cut the texts.

Texts are UTF-8 bytes; null counts as empty. Rows without doc_id come after all others and never count as
smaller; rows that repeat a doc_id do not remove from each other. Strings are judged on the input, not on what is left. Texts shorter
than ``length`` are kept. An empty table gives an empty result. Extra input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialised_by, ship_package, shuffle_partitions, text_or_empty
from .runindex import RunIndex

ANCHOR = 16
#: Bytes of text for each block, for each range of keys that are judged together and for each owner of pieces: they bound what a task holds at
#: a time. Rows that carry keys number blocks times ranges, so the larger both are, the later a row carries few keys only.
BLOCK = 8_000_000
JUDGED = 32_000_000
RANGE = 1_000_000
#: Small inputs are cut into parts of this many bytes or more, so that all cores have one.
SMALL = 1_000_000
#: Bytes of text for each task, as long as that makes no more than so many tasks, for what a shuffle keeps grows with their square. A task takes
#: its blocks or owners in turn, so what it holds does not depend on either.
TASK, TASKS = 16_000_000, 20_000
#: Bytes whose windows are keyed at once.
CHUNK = 1_000_000
#: Windows in a piece at most, so that suffixes are short to sort: with 50-byte windows 112 bytes, 7 * 2**4.
PIECE = 63
#: Pieces of a key from which on it counts as very frequent and its windows are dealt one by one, so that no owner gets them all. A rule of
#: balance only: windows are found either way. Counts are carried up to 65,535 a block, which is more.
FREQUENT = 20_000
LAST = (1 << 63) - 1


def _pack(*arrays: np.ndarray, data: bytes = b"") -> bytes:
    head = np.array([len(a.tobytes()) for a in arrays], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head, *[a.tobytes() for a in arrays], data]))


def _unpack(blob: bytes, *types: str) -> list:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, np.int64, len(types))
    out, at = [], 8 * len(types)
    for kind, size in zip(types, sizes.tolist(), strict=True):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return [*out, raw[at:]]


# --- windows and pieces --------------------------------------------------------------------------


def _hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ANCHOR bytes from each position on."""
    n = len(data) - ANCHOR + 1
    words = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
    h = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += words[8 : n + 8]
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    return h


def _spread(h: np.ndarray) -> np.ndarray:
    """Minima crowd at small values; mixed once more they fill all key ranges alike."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(33))


def _sliding_minimum(h: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    rest = width - span
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


class Block:
    """The documents of one block in the order of their row ids."""

    def __init__(self, table: pa.Table, length: int):
        order = np.argsort(table.column("rid").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        self.length = length
        self.doc_id = table.column("doc_id").combine_chunks()
        # one less, so that LAST is free for rows without doc_id; the two smallest numbers of 64 bits are not told apart
        ids = self.doc_id.fill_null(LAST).to_numpy()
        self.key = np.where(self.doc_id.is_null().to_numpy(zero_copy_only=False), LAST, ids - (ids > -LAST))
        unzip = zstandard.ZstdDecompressor().decompress
        self.texts = [unzip(z.as_py()) for z in table.column("z")]
        self.size = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        self.start = np.cumsum(self.size) - self.size
        self.data = b"".join(self.texts)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """keys, first windows, numbers of windows and documents of all pieces."""
        n, out = len(self.data), []
        buffer = np.frombuffer(self.data, np.uint8)
        for low in range(0, max(0, n - self.length + 1), CHUNK):
            part = buffer[low : low + CHUNK + self.length - 1]
            least = _sliding_minimum(_hashes(part), self.length - ANCHOR + 1)
            whole = np.zeros(len(least), bool)  # windows within one document
            near = slice(max(0, int(np.searchsorted(self.start, low)) - 1), int(np.searchsorted(self.start, low + len(least))))
            first = np.clip(self.start[near] - low, 0, len(least))
            last = np.clip(self.start[near] + self.size[near] - self.length + 1 - low, 0, len(least))
            for a, b in zip(first.tolist(), last.tolist(), strict=True):
                whole[a:b] = True
            begins = whole.copy()
            begins[1:] &= ~whole[:-1] | (least[1:] != least[:-1])
            stops = whole.copy()
            stops[:-1] &= ~whole[1:] | begins[1:]
            a, b = np.flatnonzero(begins), np.flatnonzero(stops) + 1
            out.append((_spread(least[a]), a + low, b - a))
        if not out:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, first, count = map(np.concatenate, zip(*out, strict=True))
        return keys, first, count, np.searchsorted(self.start, first, side="right") - 1

    def window_hashes(self, at: np.ndarray) -> np.ndarray:
        """Hash of all ``length`` bytes of single windows."""
        h, buffer = np.zeros(len(at), np.uint64), np.frombuffer(self.data, np.uint8)
        for i in range(self.length):
            h = (h ^ buffer[at + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h


def _owner(keys: np.ndarray, owners: int) -> np.ndarray:
    """Key ranges: rising with the key."""
    return ((keys >> np.uint64(40)) * np.uint64(owners) >> np.uint64(24)).astype(np.int64)


def _cut(keys: np.ndarray, first: np.ndarray, count: np.ndarray, doc: np.ndarray, size: int | np.ndarray) -> tuple:
    """Pieces of at most size windows."""
    parts = -(-count // size)
    of = np.repeat(np.arange(len(keys)), parts)
    k = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    limit = size[of] if isinstance(size, np.ndarray) else size
    return keys[of], first[of] + k * limit, np.minimum(count[of] - k * limit, limit), doc[of]


def _slices(owner: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(owner, from, to) of a sorted array."""
    if len(owner):
        edges = np.concatenate(([0], np.flatnonzero(np.diff(owner)) + 1, [len(owner)]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield int(owner[a]), a, b


# --- the tasks -----------------------------------------------------------------------------------


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    zip_ = zstandard.ZstdCompressor(level=3)
    for b in batches:
        z = [zip_.compress(t.as_py()) for t in b.column(1).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(z, pa.binary())], ["doc_id", "h", "z"])


def _send_keys(length: int, ranges: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        block = Block(table, length)
        keys, _, _, doc = block.runs()
        order = np.argsort(keys, kind="stable")
        keys, doc = keys[order], doc[order]
        edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        times = np.diff(np.concatenate((edge, [len(keys)])))
        several = np.maximum.reduceat(doc, edge) != np.minimum.reduceat(doc, edge) if len(edge) else np.zeros(0, bool)
        times = np.where(several, np.minimum(times, 65_535), 0).astype(np.uint16)
        keys = keys[edge]
        rows = [
            (o, _pack(keys[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].copy(), times[a:b])) for o, a, b in _slices(_owner(keys, ranges))
        ]
        return pa.table({"owner": pa.array([r[0] for r in rows], pa.int32()), "block": pa.array([key[0].as_py()] * len(rows), pa.int32()), "packed": pa.array([r[1] for r in rows], pa.binary())})

    return run


def _judge_keys(table: pa.Table) -> pa.Table:
    """For each key of each block: 0 if one document has it, 1 if several have, 2 if it is very frequent."""
    parts = [_unpack(p.as_py(), "u1", "u2")[:2] for p in table.column("packed")]
    keys = [np.pad(k.reshape(-1, 5), ((0, 0), (0, 3))).view("<u8").ravel() for k, _ in parts]
    every, times = np.concatenate(keys), np.concatenate([t for _, t in parts]).astype(np.int64)
    _, which, blocks = np.unique(every, return_inverse=True, return_counts=True)
    total = np.bincount(which, weights=np.maximum(times, 1))
    verdict = np.where(total >= FREQUENT, 2, np.where((blocks > 1) | (np.bincount(which, weights=times) > 0), 1, 0)).astype(np.uint8)[which]
    at = np.cumsum([len(k) for k in keys])[:-1]
    return pa.table({"block": table.column("block"), "owner": table.column("owner"), "verdicts": pa.array([_pack(v) for v in np.split(verdict, at)], pa.binary())})


def _send_pieces(length: int, ranges: int, owners: int):
    def run(key: tuple, table: pa.Table, verdicts: pa.Table) -> pa.Table:
        block = Block(table, length)
        keys, first, count, doc = block.runs()
        rows: list[tuple[int, int, bytes]] = []
        if len(keys):
            distinct, which = np.unique(keys, return_inverse=True)
            verdict = np.zeros(len(distinct), np.uint8)
            got = {o.as_py(): v.as_py() for o, v in zip(verdicts.column("owner"), verdicts.column("verdicts"), strict=True)}
            for o, a, b in _slices(_owner(distinct, ranges)):
                verdict[a:b] = _unpack(got[o], "u1")[0]
            level = verdict[which]
            chosen = np.flatnonzero(level)
            keys, first, count, doc = _cut(keys[chosen], first[chosen], count[chosen], doc[chosen], np.where(level[chosen] == 2, 1, PIECE))
            rows = _pieces(block, keys, first, count, doc, verdict[np.searchsorted(distinct, keys)] == 2, owners)
        number = key[0].as_py()
        return pa.table(
            {
                "owner": pa.array([r[0] for r in rows], pa.int32()),
                "block": pa.array([number] * len(rows), pa.int32()),
                "settled": pa.array([r[1] for r in rows], pa.int32()),
                "packed": pa.array([r[2] for r in rows], pa.binary()),
            }
        )

    return run


def _pieces(block: Block, keys: np.ndarray, first: np.ndarray, count: np.ndarray, doc: np.ndarray, single: np.ndarray, owners: int) -> list[tuple[int, int, bytes]]:
    """(owner, 0, pieces) rows for the owners, and one (owner, 1, marks) row of what the block settles itself."""
    keys = keys.copy()
    keys[single] = block.window_hashes(first[single])
    owner = _owner(keys, owners)
    order = np.lexsort((block.key[doc], owner))
    owner, first, count, doc = owner[order], first[order], count[order], doc[order]
    doc_key, data = block.key[doc].tolist(), block.data
    stays, settled = np.ones(len(owner), bool), []
    for _, a, b in _slices(owner):
        seen: dict[bytes, int] = {}
        for i, s, e in zip(range(a, b), first[a:b].tolist(), (first[a:b] + count[a:b] + block.length - 1).tolist(), strict=True):
            if seen.setdefault(data[s:e], doc_key[i]) < doc_key[i]:
                stays[i] = False
                settled.append(i)
    rows = []
    offset = first - block.start[doc]
    if settled:
        i = np.array(settled)
        rows.append((int(owner[i[0]]), 1, _pack(doc[i].astype(np.uint32), offset[i].astype(np.uint32), count[i].astype(np.uint16))))
    owner, first, count, doc, offset = owner[stays], first[stays], count[stays], doc[stays], offset[stays]
    for o, a, b in _slices(owner):
        content = b"".join([data[s:e] for s, e in zip(first[a:b].tolist(), (first[a:b] + count[a:b] + block.length - 1).tolist(), strict=True)])
        rows.append((o, 0, _pack(doc[a:b].astype(np.uint32), offset[a:b].astype(np.uint32), count[a:b].astype(np.uint16), block.key[doc[a:b]], data=content)))
    return rows


def _mark(length: int):
    def run(table: pa.Table) -> pa.Table:
        blocks, out = table.column("block").to_pylist(), []
        # (smallest key, content), pieces by block
        pieces, least = [], {}
        for n, (settled, blob) in enumerate(zip(table.column("settled").to_pylist(), table.column("packed"), strict=True)):
            if settled:
                out.append((blocks[n], blob.as_py()))
                continue
            doc, offset, count, key, data = _unpack(blob.as_py(), "u4", "u4", "u2", "i8")
            ends = np.cumsum(count.astype(np.int64) + length - 1)
            content = [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            for c, k in zip(content, key.tolist(), strict=True):
                if k < least.get(c, LAST + 1):
                    least[c] = k
            pieces.append((blocks[n], doc, offset, count, key, content))
        ordered = sorted(least.items(), key=lambda x: (x[1], x[0]))
        place = {c: i for i, (c, _) in enumerate(ordered)}
        index = RunIndex([c for c, _ in ordered])
        if index.n:
            begin = np.concatenate(([0], index.text_end[:-1]))
            of_text = np.repeat(np.arange(len(ordered)), np.diff(np.concatenate((begin, [index.n]))))
            first_key = np.array([k for _, k in ordered], np.int64)[of_text[index.first_occurrence(length)]]
        for block, doc, offset, count, key, content in pieces:
            text = np.fromiter(map(place.__getitem__, content), np.int64, len(content))
            count = count.astype(np.int64)
            of = np.repeat(np.arange(len(doc)), count)
            k = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            hit = first_key[begin[text[of]] + k] < key[of]
            # runs of marked windows
            start = hit & ~np.concatenate(([False], hit[:-1] & (of[1:] == of[:-1])))
            stop = hit & ~np.concatenate((hit[1:] & (of[1:] == of[:-1]), [False]))
            a, b = np.flatnonzero(start), np.flatnonzero(stop)
            if len(a):
                out.append((block, _pack(doc[of[a]], (offset[of[a]] + k[a]).astype(np.uint32), (b - a + 1).astype(np.uint16))))
        return pa.table({"block": pa.array([x[0] for x in out], pa.int32()), "marks": pa.array([x[1] for x in out], pa.binary())})

    return run


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges as maximal ranges; touching ones join."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    if not len(starts):
        return starts, ends
    new = np.concatenate(([True], starts[1:] > ends[:-1]))
    return starts[new], ends[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(ends) - 1]))]


def _cut_texts(length: int, with_text: bool):
    def run(key: tuple, table: pa.Table, marks: pa.Table) -> pa.Table:
        block = Block(table, length)
        got = [_unpack(m.as_py(), "u4", "u4", "u2")[:3] for m in marks.column("marks")]
        doc, offset, count = (np.concatenate([g[i] for g in got]).astype(np.int64) if got else np.zeros(0, np.int64) for i in range(3))
        a = block.start[doc] + offset if len(doc) else doc
        # ranges of different documents do not touch unless the texts do: cut at document starts
        starts, ends, removed, spans, digests, kept_texts = a, a + count + length - 1, [], [], [], []
        order = np.argsort(doc, kind="stable")
        edges = np.searchsorted(doc[order], np.arange(len(block.texts) + 1))
        for i, text in enumerate(block.texts):
            mine = order[edges[i] : edges[i + 1]]
            s, e = merged(starts[mine] - block.start[i], ends[mine] - block.start[i])
            kept = text
            if len(s):
                cuts = [0, *np.column_stack((s, e)).ravel().tolist(), len(text)]
                kept = b"".join([text[x:y] for x, y in zip(cuts[::2], cuts[1::2], strict=True)])
            removed.append(len(text) - len(kept))
            spans.append(len(s))
            digests.append(hashlib.sha256(kept).hexdigest())
            kept_texts.append(kept)
        out = {"doc_id": block.doc_id, "n_bytes": block.size, "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
        return pa.table(out | ({"kept": pa.array(kept_texts, pa.binary())} if with_text else {}))

    return run


def _parts(spark: SparkSession, total: int, size: int) -> int:
    """Parts of size bytes, or smaller ones of an input that would not keep all cores busy."""
    return max(1, -(-total // size), min(-(-total // SMALL), 2 * spark.sparkContext.defaultParallelism))


def remove_repeats(docs: DataFrame, length: int = 50, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with with_text the bytes kept: a row for each row of docs."""
    if length < ANCHOR:
        raise ValueError(f"length must be at least {ANCHOR}")
    spark = docs.sparkSession
    ship_package(spark)
    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    total = ready.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks, ranges, owners = (_parts(spark, total, size) for size in (BLOCK, JUDGED, RANGE))
    tasks = max(min(-(-total // TASK), TASKS), 2 * spark.sparkContext.defaultParallelism)

    def owned(rows: DataFrame):
        return (rows.repartition(tasks, "owner") if tasks > shuffle_partitions(spark) else rows).groupBy("owner")

    zipped = ready.withColumn("h", F.xxhash64("doc_id", "text")).mapInArrow(_compress, "doc_id long, h long, z binary")
    dealt = zipped.select("doc_id", "z", F.pmod("h", F.lit(blocks)).cast("int").alias("block"), F.monotonically_increasing_id().alias("rid"))
    blocked = materialised_by(dealt, "block", min(blocks, tasks))
    sent = blocked.groupBy("block").applyInArrow(_send_keys(length, ranges), "owner int, block int, packed binary")
    verdicts = owned(sent).applyInArrow(_judge_keys, "block int, owner int, verdicts binary")
    pieces = blocked.groupBy("block").cogroup(verdicts.groupBy("block")).applyInArrow(_send_pieces(length, ranges, owners), "owner int, block int, settled int, packed binary")
    marks = owned(pieces).applyInArrow(_mark(length), "block int, marks binary")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return blocked.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(_cut_texts(length, with_text), schema)
