"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text's terms are trigrams of character classes (lower, upper, digit, space, line break, each ASCII mark; hashed to
``DIMS``) and a few bins of how much its words repeat. Terms are weighted by square-root frequency and inverse document frequency
and projected onto the leading singular vectors of the labelled texts (latent semantic analysis). The labelled
vectors are broadcast: at most ``max_labelled`` of them, whatever the input. Every text then gets the
exact cosine with every labelled vector, in blocks of matrix products, and its ``neighbours`` nearest vote with their similarity as weight.
Similarities are rounded to nine places, so that they do not depend on the blocks; neighbours that tie with the last one vote too.

Training reads labels of rows outside the held-out quarter only, and at most ``max_labelled`` of them (those whose MD5
of doc_id is smallest, one text each: a bounded sample, the same in every run); everything else covers all rows and whole texts.

Null and empty texts are scored like any other (no terms: the share of label 1). Rows without doc_id are not held out.
Labels that are null or have no document are unused; without usable labels every score is 0.5. Repeated
rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, ship_package, text_or_empty

DIMS, BINS = 1024, 8
_CLASS = np.full(256, 1, np.uint32)  # lower-case and bytes of other alphabets
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[32, 9, 11, 12, 13]] = 4
_CLASS[10] = 5
for _i, _b in enumerate([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]):
    _CLASS[_b] = 6 + _i


def _bins(share: float) -> np.ndarray:
    """A share of 0 to 1 spread over two neighbouring bins."""
    at = min(max(share, 0.0), 1.0) * (BINS - 1)
    low = int(at)
    out = np.zeros(BINS, np.float32)
    out[low] += 1 - (at - low)
    if low + 1 < BINS:
        out[low + 1] += at - low
    return out


def features(text: bytes) -> np.ndarray:
    """DIMS trigram frequencies (square roots, unit length), then bins of adjacent repeats and of distinct words per 50."""
    out = np.zeros(DIMS + 2 * BINS, np.float32)
    c = _CLASS[np.frombuffer(text, np.uint8)]
    if len(c) >= 3:
        code = (c[:-2] * 1681 + c[1:-1] * 41 + c[2:]) * np.uint32(2654435761) >> np.uint32(22)
        counts = np.sqrt(np.bincount(code, minlength=DIMS).astype(np.float32))
        out[:DIMS] = counts / np.linalg.norm(counts)
    words = text.split()
    if len(words) > 1:
        out[DIMS : DIMS + BINS] = _bins(sum(map(eq, words, words[1:])) / (len(words) - 1))
        blocks = [words[i : i + 50] for i in range(0, len(words), 50)]
        out[DIMS + BINS :] = _bins(sum(len(set(b)) for b in blocks) / len(words))
    return out


def held_out(fold: int = 2) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == fold, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame, columns: list[str], limit: int) -> DataFrame:
    """doc_id, text and the label columns of at most limit labelled documents outside the held-out fold: one row a doc_id,
    of rows that repeat it the smallest text."""
    usable = labels.where(F.col("doc_id").isNotNull() & ~held_out())
    for c in columns:
        usable = usable.where(F.col(c).isNotNull())
    # one row a document; of contradicting labels the smallest
    one = usable.groupBy("doc_id").agg(*[F.min(c).alias(c) for c in columns]).join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = one.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(limit)
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", *columns).agg(F.min("text").alias("text")).select("doc_id", "text", *columns)


class Model:
    """Latent-semantic vectors of the labelled texts, and the vote."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rank: int, neighbours: int):
        self.neighbours, self.prior = neighbours, float(y.mean()) if len(y) else 0.5
        self.idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
        w = x * self.idf
        values, vectors = np.linalg.eigh(w.T @ w)
        self.basis = vectors[:, ::-1][:, :rank].astype(np.float64)
        self.known = self._unit(w.astype(np.float64) @ self.basis)
        self.y = y.astype(np.float64)

    @staticmethod
    def _unit(v: np.ndarray) -> np.ndarray:
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def _vote(self, cosine: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Mean label of each row's neighbours, with the similarity as weight: sharpened, so that the nearest count most."""
        weight = np.maximum(cosine, 0.0) ** 8
        total = weight.sum(axis=1)
        return np.where(total > 0, np.round((weight * y).sum(axis=1) / np.maximum(total, 1e-300), 9), self.prior)

    def scores(self, x: np.ndarray, block: int = 512) -> np.ndarray:
        out = np.full(len(x), self.prior)
        if not len(self.y):
            return out
        k = min(self.neighbours, len(self.y))
        for at in range(0, len(x), block):
            v = self._unit((x[at : at + block] * self.idf).astype(np.float64) @ self.basis)
            cosine = np.round(v @ self.known.T, 9)
            near = np.sort(np.argpartition(cosine, -k, axis=1)[:, -k:], axis=1)
            own = np.take_along_axis(cosine, near, axis=1)
            votes = self._vote(own, self.y[near])
            last = own.min(axis=1, keepdims=True)
            for i in np.flatnonzero((cosine >= last).sum(axis=1) > k).tolist():
                tied = cosine[i] >= last[i]
                votes[i] = self._vote(cosine[i][None, tied], self.y[None, tied])[0]
            out[at : at + block] = votes
        return np.clip(out, 0.0, 1.0)


def _featured(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return np.stack([features(t.as_py()) for t in batch.column(column).cast(pa.binary())]) if batch.num_rows else np.zeros((0, DIMS + 2 * BINS), np.float32)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = 5_000, rank: int = 48, neighbours: int = 25) -> Model:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _featured(b, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.astype(np.float16).tobytes() for r in x], pa.binary()), b.column(2)], ["doc_id", "x", "y"])

    ship_package(docs.sparkSession)
    rows = labelled_rows(docs, labels, [label], max_labelled).select(F.col("doc_id").cast("long"), "text", F.col(label).cast("int").alias("y"))
    got = sorted((r.doc_id, bytes(r.x), r.y) for r in rows.mapInArrow(run, "doc_id long, x binary, y int").collect())  # at most max_labelled
    x = np.stack([np.frombuffer(r[1], np.float16) for r in got]).astype(np.float32) if got else np.zeros((0, DIMS + 2 * BINS), np.float32)
    return Model(x, np.array([r[2] for r in got], np.float32), rank, neighbours)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with the column ``name``. The model's size is bounded by max_labelled and rank."""
    text = free_name(docs.columns, "scored_text")
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ready = docs.withColumn(text, text_or_empty())
    schema = ready.drop(text).schema.add(name, "double")
    at = ready.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(i, 1024) for i in range(0, b.num_rows, 1024)):
                s = shared.value.scores(_featured(part, at))
                columns = [part.column(i) for i in range(part.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(s, pa.float64())], [f.name for f in schema.fields])

    return ready.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted: a row for each row of docs."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """docs without the rows scored under the threshold."""
    name = free_name(docs.columns, "quality_score")
    return score(docs, train(docs, labels), name).where(F.col(name) >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
