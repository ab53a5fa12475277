"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

An item matches a document if some run of the document's words is within ``floor((1 - similarity) * n)`` word edits of the
item's n words (words: lower case, split at ASCII white space and marks).

1. Places. An item cut into k + 1 pieces has one piece untouched by k edits, so a matching document holds one of its pieces
   word for word, with at least n - k of the item's words around it. This is an exact bound, not a search: item-sized windows are only
   embedded where it does not rule a match out, and nothing that matches is lost.
2. CGK embedding. A random walk copies the current word and moves on or stays by a random bit for
   (step, word); all windows and items share the bits, so windows within few edits fall into step and agree at most
   positions: edit distance becomes Hamming distance. Windows have the item's size and start at every shift within the budget.
3. Bit sampling. Each repetition has a walk of its own and compares windows at a few sampled positions, an LSH
   band for the Hamming distance. The number of repetitions is set for each item size, on items of that size edited at random at the
   full budget, so that a single window at the right start already reaches ``recall``. A size that does not get there within
   ``most`` repetitions is not filtered at all: each of its places is verified.
4. Windows that agree with their item in any repetition are verified: exact edit distance of the item to the best
   run of words in the region.

Items and what is built from them are broadcast: their size is the benchmark's and does not grow with the documents. A benchmark of more than
``max_items`` different items is searched in parts, one after the other. Null and empty texts match nothing, as do items without words. Repeated rows are searched each. Empty tables
give empty results.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, ship_package, text_or_empty

_SPLIT = bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 128), *range(0, 9), *range(14, 32)])
_SPACED = bytes.maketrans(_SPLIT, b" " * len(_SPLIT))
_WORD = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_SPACED).split()


def edit_budget(n: int, similarity: float) -> int:
    return int((1 - similarity) * n + 1e-9)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def cgk(rows: np.ndarray, steps: int, walks: np.ndarray) -> np.ndarray:
    """CGK embeddings of equally long rows of word numbers, one for each walk: (row, walk, step). Past its end a row pads with zero."""
    n, size = rows.shape
    padded = np.concatenate((rows.astype(np.uint64), np.zeros((n, 1), np.uint64)), axis=1)
    every = np.repeat(np.arange(n), len(walks))
    seeds = np.tile(walks.astype(np.uint64) * np.uint64(1_000_003 * 2) + np.uint64(1), n)
    at, out = np.zeros(len(every), np.int64), np.zeros((len(every), steps), np.uint64)
    for step in range(steps):
        out[:, step] = word = padded[every, at]
        at += ((word + seeds + np.uint64(2 * step)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(37) & np.uint64(1)).astype(np.int64)
        np.minimum(at, size, out=at)
    return out.reshape(n, len(walks), steps)


def best_run(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end): the run region[start:end] closest to item; ties: earliest end, then the longest run."""
    m, n = len(item), len(region)
    cost, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
    ramp = np.arange(n + 1)
    big = np.int64(1 << 32)
    for i in range(1, m + 1):
        up = cost * big + start + big
        diagonal = cost[:-1] * big + start[:-1] + big * (region != item[i - 1])
        best = up
        best[1:] = np.minimum(best[1:], diagonal)
        # insertions: running minimum of best[j] - j * big, then + j * big
        best = np.minimum.accumulate(best - ramp * big) + ramp * big
        cost, start = best // big, best % big
    end = int(np.argmin(cost))
    return int(cost[end]), int(start[end]), end


class Index:
    """Seeds, walks and samples of the items."""

    def __init__(self, items: list[tuple[int, str]], similarity: float, recall: float, sampled: int = 2, most: int = 512, seed: int = 7):
        self.items, self.vocabulary = [], {}
        for item_id, text in items:
            if words := words_of(text or ""):
                ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int64)
                self.items.append((item_id, ids, edit_budget(len(ids), similarity)))
        self.sampled, self.seed = sampled, seed
        self.codes = mix(np.arange(len(self.vocabulary) + 1, dtype=np.uint64) + np.uint64(seed * 2 + 1))
        pieces: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for k, (_, ids, budget) in enumerate(self.items):
            cuts = np.linspace(0, len(ids), budget + 2).astype(int).tolist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b > a:
                    pieces[b - a][int(self._grams(self.codes[ids[a:b]], b - a)[0])].append((k, a))
        self.pieces = {g: dict(p) for g, p in pieces.items()}
        self.filters = {}
        for g, p in self.pieces.items():
            self.filters[g] = bits = np.zeros(1 << 20, bool)
            bits[np.array(list(p), np.uint64) >> np.uint64(44)] = True
        self.most, self._sampled = most, {}
        self.keys: dict[int, np.ndarray] = {}
        sizes: dict[int, list[int]] = defaultdict(list)
        for k, (_, ids, _b) in enumerate(self.items):
            sizes[len(ids)].append(k)
        #: Item size -> repetitions; none: every place is verified.
        self.repetitions: dict[int, int | None] = {n: self._calibrate([self.items[k] for k in group], recall) for n, group in sizes.items()}
        for n, group in sizes.items():
            if self.repetitions[n]:
                rows = np.stack([self.items[k][1] for k in group])
                self.keys |= dict(zip(group, self._bits(rows, 0, self.repetitions[n]), strict=True))

    @staticmethod
    def _grams(codes: np.ndarray, g: int) -> np.ndarray:
        """Hash of every run of g words from the words' codes."""
        n = len(codes) - g + 1
        h = codes[:n].copy()
        for i in range(1, g):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += codes[i : n + i]
        return h

    def _positions(self, size: int) -> np.ndarray:
        """(repetition, sample): steps to compare. A walk of 2 * size steps nearly always passes the whole window."""
        if size not in self._sampled:
            rng = np.random.default_rng([self.seed, size])
            self._sampled[size] = np.sort(rng.permuted(np.tile(np.arange(2 * size), (self.most, 1)), axis=1)[:, : self.sampled], axis=1)
        return self._sampled[size]

    def _bits(self, rows: np.ndarray, first: int, last: int) -> np.ndarray:
        """(row, repetition, sample) of the repetitions first to last."""
        positions = self._positions(rows.shape[1])[first:last]
        walks = cgk(rows, int(positions.max()) + 1, self.seed * 1000 + np.arange(first, last))
        return np.take_along_axis(walks, np.broadcast_to(positions, (len(rows), *positions.shape)), axis=2)

    def _calibrate(self, items: list[tuple], recall: float, trials: int = 400, step: int = 32) -> int | None:
        """Repetitions after which so large a share of edited items of one size agrees with its item at least once."""
        if not items[0][2]:
            return 1  # no edits: equal windows agree at once
        rng = np.random.default_rng([self.seed, len(items[0][1])])
        chosen = [items[i % len(items)] for i in range(trials)]
        edited = np.stack([self._edited(ids, budget, rng) for _, ids, budget in chosen])
        plain = np.stack([ids for _, ids, _ in chosen])
        missed, done = np.ones(trials, bool), 0
        while done < self.most:
            agreed = (self._bits(edited[missed], done, done + step) == self._bits(plain[missed], done, done + step)).all(axis=2)
            reached = 1 - (missed.sum() - np.logical_or.accumulate(agreed, axis=1).sum(axis=0)) / trials
            if (reached >= recall).any():
                return done + int(np.argmax(reached >= recall)) + 1
            missed[np.flatnonzero(missed)[agreed.any(axis=1)]] = False
            done += step
        return None

    @staticmethod
    def _edited(ids: np.ndarray, budget: int, rng: np.random.Generator) -> np.ndarray:
        """A window of the item's size over the item after budget random edits."""
        words = ids.tolist()
        for _ in range(budget):
            at, kind = int(rng.integers(len(words))), int(rng.integers(3))
            words[at : at + (kind > 0)] = [-int(rng.integers(1, 1 << 30))] * (kind < 2)
        return np.array((words + [-1] * budget)[: len(ids)], np.int64)

    def candidates(self, ids: np.ndarray) -> dict[int, list[int]]:
        """item -> window starts that a seed aligns (may be negative)."""
        found: dict[int, set[int]] = defaultdict(set)
        codes = self.codes[ids]
        for g, table in self.pieces.items():
            if len(ids) >= g:
                h = self._grams(codes, g)
                for p in np.flatnonzero(self.filters[g][h >> np.uint64(44)]).tolist():
                    for item, offset in table.get(int(h[p]), ()):
                        found[item].add(p - offset)
        out = {}
        for k, starts in found.items():
            _, item, budget = self.items[k]
            own = np.concatenate(([0], np.cumsum(np.isin(ids, item))))
            at = np.array(sorted(starts))
            held = own[np.clip(at + len(item) + budget, 0, len(ids))] - own[np.clip(at - budget, 0, len(ids))]
            if (held >= len(item) - budget).any():
                out[k] = at[held >= len(item) - budget].tolist()
        return out

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, start, end, distance) for each matching item: its closest run, in word numbers."""
        words = words_of(text)
        if not words:
            return []
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))  # 0: a word of no item
        out = []
        for k, starts in self.candidates(ids).items():
            item_id, item, budget = self.items[k]
            n = len(item)
            # the seed may be shifted by edits before it: windows at every shift within the budget
            at = np.unique((np.array(starts)[:, None] + np.arange(-budget, budget + 1)).ravel())
            at = at[(at > -n) & (at < len(ids))]
            padded = np.concatenate((np.zeros(n, np.int64), ids, np.zeros(n, np.int64)))
            rows = padded[(at + n)[:, None] + np.arange(n)]
            repetitions = self.repetitions[n]
            near = (self._bits(rows, 0, repetitions) == self.keys[k]).all(axis=2).any(axis=1) if repetitions else np.ones(len(at), bool)
            best = None
            for a, b in _regions(at[near] - budget, n + 2 * budget, len(ids)):
                d, s, e = best_run(item, ids[a:b])
                if d <= budget and (best is None or d < best[0]):
                    best = (d, a + s, a + e)
            if best:
                out.append((item_id, best[1], best[2], best[0]))
        return out


def _regions(starts: np.ndarray, size: int, n: int) -> list[tuple[int, int]]:
    """Overlapping windows joined, within 0..n."""
    out: list[list[int]] = []
    for s in starts.tolist():
        a, b = max(0, s), min(n, s + size)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        elif a < b:
            out.append([a, b])
    return [(a, b) for a, b in out]


def build_indexes(benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.99, max_items: int = 100_000) -> Iterator[Index]:
    """One index for each part of at most about max_items different items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    n = items.count()
    parts = 1 if n <= max_items else -(-2 * n // max_items)
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()  # about max_items / 2 of several parts
        yield Index(sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")), similarity, recall)


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.99, max_items: int = 100_000) -> DataFrame:
    """doc_id, item_id, span_start, span_end (code points of the source text), distance, item_words: a row for each
    document row and item that match, with the closest passage. Items that repeat id and text count once."""
    ship_package(docs.sparkSession)
    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    found = [ready.mapInArrow(_find(docs.sparkSession.sparkContext.broadcast(index)), LEAK) for index in build_indexes(benchmark, similarity, recall, max_items)]
    return reduce(DataFrame.unionAll, found)


LEAK = "doc_id long, item_id long, span_start long, span_end long, distance long, item_words long"


def _find(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        sizes = {i: len(w) for i, w, _ in index.items}
        names = ["doc_id", "item_id", "span_start", "span_end", "distance", "item_words"]
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if hits := index.search(t := text.as_py()):
                    at = [m.span() for m in _WORD.finditer(t)]
                    rows += [(doc_id, i, at[a][0] if a < e else 0, at[e - 1][1] if a < e else 0, d, sizes[i]) for i, a, e, d in hits]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 6, names)

    return run


def keep_clean(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.99, max_items: int = 100_000) -> DataFrame:
    """docs without the rows that match any item. Row-local: no shuffle."""
    ship_package(docs.sparkSession)
    text = free_name(docs.columns, "searched_text")
    ready = docs.withColumn(text, text_or_empty())
    for index in build_indexes(benchmark, similarity, recall, max_items):
        ready = ready.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(index), ready.columns.index(text)), ready.schema)
    return ready.select(*[F.col(f"`{c}`") for c in docs.columns])


def _clean(shared, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([not shared.value.search(t.as_py()) for t in b.column(at)], pa.bool_()))

    return run
