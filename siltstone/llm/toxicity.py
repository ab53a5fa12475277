"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic models over the presence of words; the model of a category also
gets the log-odds of all earlier ones. While training, those come from models that have not seen the row (out-of-fold
predictions), so later models learn to rely on earlier ones no more than they will deserve. At scoring time the chain
runs on its own probabilities.

Words are runs without ASCII white space or marks, ASCII letters lower-cased. The vocabulary is the words found in at
least ``min_docs`` training texts whose log odds for some category are ``least`` standard errors from zero, at most ``max_words``; training reads at most ``max_labelled``
labelled rows (smallest MD5 of doc_id) outside the held-out fold. These bounds hold whatever the input; scoring covers all rows and
whole texts.

Null and empty texts have no words and get the models' base rates. Without usable labels every probability is 0.5.
Repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, text_or_empty
from .quality import held_out, labelled_rows

_MARKS = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 128))
_SPACED = bytes.maketrans(_MARKS, b" " * len(_MARKS))


def word_set(text: bytes) -> set[bytes]:
    return set(text.lower().translate(_SPACED).split())


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Rows:
    """Sparse 0/1 rows: the word numbers of all rows in one array, and where each row starts."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.n, self.width = len(rows), width
        self.word = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.word], minlength=self.n)

    def transposed_times(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, weights=g[self.row], minlength=self.width)


def fit_linear(x: Rows, extra: np.ndarray, y: np.ndarray, use: np.ndarray, steps: int = 80, decay: float = 0.1, rate: float = 0.15) -> np.ndarray:
    """Logistic model by Adam on the rows in use: weights of the words, of the extra columns, and the intercept.

    Both classes weigh alike in sum, so rare categories are learnt.
    """
    size = x.width + extra.shape[1] + 1
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    positive = max(float((use * y).sum()), 1.0)
    negative = max(float((use * (1 - y)).sum()), 1.0)
    weight = use * np.where(y > 0, 0.5 / positive, 0.5 / negative)
    for step in range(1, steps + 1):
        z = x.times(w[: x.width]) + extra @ w[x.width : -1] + w[-1]
        g = weight * (_sigmoid(z) - y)
        grad = np.concatenate((x.transposed_times(g), extra.T @ g, [g.sum()]))
        grad[:-1] += decay * w[:-1] / 100
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


class Chain:
    """words -> number, and one weight vector a category."""

    def __init__(self, vocabulary: dict[bytes, int], weights: list[np.ndarray], categories: list[str]):
        self.vocabulary, self.weights, self.categories = vocabulary, weights, categories

    def numbers(self, text: bytes) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([i for i in map(get, word_set(text)) if i is not None], np.int64)

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        x = Rows([self.numbers(t) for t in texts], len(self.vocabulary))
        extra, out = np.zeros((len(texts), 0)), np.zeros((len(texts), len(self.categories)))
        for k, w in enumerate(self.weights):
            z = x.times(w[: x.width]) + extra @ w[x.width : -1] + w[-1]
            out[:, k] = _sigmoid(z)
            extra = np.column_stack((extra, np.clip(z, -10, 10)))
        return out


def choose_words(texts: list[set[bytes]], labels: np.ndarray, min_docs: int, max_words: int, least: float) -> dict[bytes, int]:
    """Words whose log odds for some category differ from zero by at least ``least`` standard errors, the surest first."""
    total = Counter(w for t in texts for w in t)
    common = [w for w, n in total.items() if n >= min_docs]
    best = np.zeros(len(common))
    df = np.array([total[w] for w in common], float)
    for k in range(labels.shape[1]):
        inside = Counter(w for t, y in zip(texts, labels[:, k], strict=True) if y for w in t)
        a = np.array([inside[w] for w in common], float)
        p, n = labels[:, k].sum(), (1 - labels[:, k]).sum()
        cells = [a + 0.5, df - a + 0.5, p - a + 0.5, n - (df - a) + 0.5]
        odds = np.log(cells[0] * cells[3] / (cells[1] * cells[2]))
        best = np.maximum(best, np.abs(odds) / np.sqrt(sum(1 / c for c in cells)))
    order = sorted((i for i in range(len(common)) if best[i] >= least), key=lambda i: (-best[i], common[i]))[:max_words]
    return {common[i]: k for k, i in enumerate(order)}


def fit_chain(texts: list[bytes | set[bytes]], labels: np.ndarray, categories: list[str], folds: int = 3, min_docs: int = 3, max_words: int = 30_000, least: float = 3.5) -> Chain:
    if not texts:
        return Chain({}, [np.zeros(k + 1) for k in range(len(categories))], categories)
    sets = [t if isinstance(t, set) else word_set(t) for t in texts]
    vocabulary = choose_words(sets, labels, min_docs, max_words, least)
    x = Rows([np.array([vocabulary[w] for w in s if w in vocabulary], np.int64) for s in sets], len(vocabulary))
    fold = np.arange(len(texts)) % folds
    extra, weights, everyone = np.zeros((len(texts), 0)), [], np.ones(len(texts))
    for k in range(len(categories)):
        y = labels[:, k].astype(float)
        weights.append(fit_linear(x, extra, y, everyone))
        if k + 1 < len(categories):
            unseen = np.zeros(len(texts))
            for f in range(folds):
                w = fit_linear(x, extra, y, (fold != f).astype(float))
                z = x.times(w[: x.width]) + extra @ w[x.width : -1] + w[-1]
                unseen[fold == f] = z[fold == f]
            extra = np.column_stack((extra, np.clip(unseen, -10, 10)))
    return Chain(vocabulary, weights, categories)


def train_chain(docs: DataFrame, labels: DataFrame, categories: list[str], max_labelled: int = 8_000) -> Chain:
    """Learns from at most max_labelled rows, of which the driver gets the distinct words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = pa.array([sorted(word_set(t.as_py())) for t in b.column(1).cast(pa.binary())], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([b.column(0), words, *b.columns[2:]], ["doc_id", "words", *categories])

    rows = labelled_rows(docs, labels, categories, max_labelled).select(F.col("doc_id").cast("long"), "text", *[F.col(f"`{c}`").cast("int") for c in categories])
    sent = rows.mapInArrow(run, ", ".join(["doc_id long, words array<binary>", *[f"`{c}` int" for c in categories]]))
    got = sorted(((r[0], {bytes(w) for w in r[1]}, tuple(r[2:])) for r in sent.toLocalIterator()), key=lambda r: r[0])  # one row a doc_id
    return fit_chain([r[1] for r in got], np.array([r[2] for r in got]).reshape(len(got), len(categories)), categories)


def toxicity(docs: DataFrame, labels: DataFrame, categories: list[str], threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, p_<category> each, and <category> 0/1 each (threshold): a row for each row of docs."""
    ship_package(docs.sparkSession)
    chain = docs.sparkSession.sparkContext.broadcast(train_chain(docs, labels, categories))
    names = ["doc_id", *[f"p_{c}" for c in categories]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(i, 512) for i in range(0, b.num_rows, 512)):
                p = chain.value.probabilities([t.as_py() for t in part.column(1).cast(pa.binary())])
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(p[:, k]) for k in range(len(categories))]], names)

    schema = ", ".join(["doc_id long", *[f"`p_{c}` double" for c in categories]])
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, schema)
    return scored.select(
        "doc_id", held_out().alias("held_out"), *[F.col(f"`p_{c}`") for c in categories], *[(F.col(f"`p_{c}`") >= threshold).cast("int").alias(c) for c in categories]
    )
