"""Quality classifier (operator 7): random-indexing word vectors, pooled per
document, and a two-layer network with calibrated probabilities.

Words fall into a fixed number of hashed rows. Each row has a sparse random
index vector; its word vector sums the index vectors of the words around it,
as integers, so the sums are the same in any order, plus its own. A document is
the mean of its words' vectors. A small numpy network is fitted to labelled
documents and its logits are divided by a temperature fitted on held-back
labels."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import BoundedCache, map_batches, texts_of

ROWS, DIM, NONZERO, REACH, HIDDEN = 1 << 13, 48, 6, 2, 24
#: About how many labelled documents the model is fitted on at most (a sample
#: by a hash of the id; all of them if there are fewer).
MAX_TRAIN_DOCS = 20_000
_PIECES = re.compile(r"[^\W_]+|[\W_]+")


def word_rows(word: str) -> tuple[int, ...]:
    """Rows of a white-space separated word: its runs of letters and digits,
    lower-cased, its runs of other signs, and a mark if it is in capitals."""
    rows = [crc32(x.encode()) % (ROWS - 1) + 1 for x in _PIECES.findall(word.lower())]
    if len(word) > 1 and word.isupper():
        rows.append(0)
    return tuple(rows)


class Rows:
    """Word rows of whole texts."""

    def __init__(self):
        self.cache = BoundedCache(word_rows)

    def __call__(self, text: str) -> np.ndarray:
        return np.fromiter(chain.from_iterable(map(self.cache.__getitem__, text.split())), np.int32)


def index_vectors(seed: int = 11) -> np.ndarray:
    """ROWS x DIM, NONZERO entries of +1 or -1 in each row."""
    rng = np.random.default_rng(seed)
    out = np.zeros((ROWS, DIM), np.int32)
    for r in range(ROWS):
        at = rng.choice(DIM, NONZERO, replace=False)
        out[r, at] = rng.choice((-1, 1), NONZERO)
    return out


@dataclass
class Model:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float

    def pool(self, rows: list[np.ndarray]) -> np.ndarray:
        return pool(self.vectors, rows)

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        z = logits(self.layers, (pooled - self.mean) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def pool(vectors: np.ndarray, docs: list[np.ndarray]) -> np.ndarray:
    """Mean vector of each document's words; none: zero."""
    out = np.zeros((len(docs), vectors.shape[1]), np.float64)
    for k, rows in enumerate(docs):
        if len(rows):
            out[k] = vectors[rows].mean(axis=0, dtype=np.float64)
    return out


def logits(layers: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    w1, b1, w2, b2 = layers
    return np.maximum(x @ w1 + b1, 0) @ w2 + b2


def fit_net(x: np.ndarray, y: np.ndarray, seed: int = 5, epochs: int = 60, batch: int = 256) -> list[np.ndarray]:
    """Adam on the cross entropy with a light weight decay."""
    rng = np.random.default_rng(seed)
    layers = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN), np.zeros(())]
    m, v, step = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            xb, yb = x[order[at : at + batch]], y[order[at : at + batch]]
            h = np.maximum(xb @ layers[0] + layers[1], 0)
            z = np.clip(h @ layers[2] + layers[3], -60, 60)
            dz = (1 / (1 + np.exp(-z)) - yb) / len(xb)
            dh = np.outer(dz, layers[2]) * (h > 0)
            grads = [xb.T @ dh + 1e-4 * layers[0], dh.sum(0), h.T @ dz + 1e-4 * layers[2], dz.sum()]
            step += 1
            for k, g in enumerate(grads):
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                layers[k] = layers[k] - 0.005 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return layers


def fit_temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least cross entropy, by golden section on its
    logarithm."""
    def loss(log_t: float) -> float:
        s = z / np.exp(log_t)
        return float(np.mean(np.logaddexp(0, s) - y * s))

    lo, hi, g = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def constant_model(y: np.ndarray) -> Model:
    """For labels of fewer than two classes: their smoothed mean everywhere."""
    p = (float(y.sum()) + 0.5) / (len(y) + 1)
    layers = [np.zeros((DIM, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.array(np.log(p / (1 - p)))]
    return Model(np.zeros((ROWS, DIM), np.float32), np.zeros(DIM), np.ones(DIM), layers, 1.0)


def by_id(rows: DataFrame) -> DataFrame:
    """One row of each id: the mean of its vectors ``x``, added up before the
    shuffle."""
    return rows.groupBy("id", "y").agg(F.array(*[F.avg(F.col("x")[k]) for k in range(DIM)]).alias("x"))


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN_DOCS, doc_id: str = "doc_id",
          text: str = "text", label: str = "quality") -> Model:
    """Word vectors from the texts of all of ``docs``, the network and its
    temperature from the labelled sample. Labels that are null, or whose id is
    null, are not used; an id with several labels counts with their mean, 1 from
    a half up. A document id of several rows counts once, with the mean of their
    vectors. With labels of one class, or none, every document gets the same
    score."""
    spark = docs.sparkSession
    y = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
         .groupBy(F.col(doc_id).cast("long").alias("__tw_id"))
         .agg((F.avg(label) >= 0.5).cast("int").alias("y")))
    n = y.count()
    share = min(1.0, max_docs / max(n, 1))
    y = y.where(F.pmod(F.xxhash64("__tw_id", F.lit(77)), F.lit(1 << 20)) < int(share * (1 << 20)) + (share == 1.0))
    # the sample has about max_docs rows of two numbers: a bounded broadcast
    picked = (docs.select(F.col(doc_id).cast("long").alias("__tw_id"), F.col(text).alias("text"))
              .join(F.broadcast(y), "__tw_id").select("__tw_id", "y", "text"))
    base = index_vectors()
    shared_base = spark.sparkContext.broadcast(base)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one more row, without an index vector, stands between texts
        base, rows_of, total = np.vstack((shared_base.value, np.zeros((1, DIM)))).astype(np.int8), Rows(), np.zeros((ROWS + 1, DIM), np.int64)
        gap = np.full(REACH, ROWS, np.int32)

        def add(parts: list[np.ndarray]) -> None:
            rows = np.concatenate(parts)
            own = base[rows]
            near = np.zeros_like(own)  # sums of 2 * REACH numbers of -1 to 1
            for k in range(1, REACH + 1):
                near[k:] += own[:-k]
                near[:-k] += own[k:]
            order = np.argsort(rows.astype(np.int16), kind="stable")
            edges = np.flatnonzero(np.diff(rows[order], prepend=-1))
            total[rows[order][edges]] += np.add.reduceat(near[order], edges, axis=0, dtype=np.int64)

        parts, size = [gap], 0
        for batch in batches:
            for t in texts_of(batch):
                parts += [rows_of(t), gap]
                size += len(parts[-2])
                if size > 1 << 17:
                    add(parts)
                    parts, size = [gap], 0
        add(parts)
        used = np.flatnonzero(np.abs(total[:ROWS]).sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(list(total[used]), pa.list_(pa.int64()))], ["row", "sums"])

    sums = map_batches(docs.select(F.col(text).alias("text")), contexts, "row int, sums array<long>").groupBy("row").agg(
        F.array(*[F.sum(F.col("sums")[k]) for k in range(DIM)]).alias("sums"))
    context = np.zeros((ROWS, DIM), np.float64)
    for r in sums.collect():  # at most ROWS rows
        context[r["row"]] = r["sums"]
    norm = np.linalg.norm(context, axis=1, keepdims=True)
    vectors = (context / np.where(norm > 0, norm, 1) + base / NONZERO**0.5).astype(np.float32)
    shared = spark.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = Rows()
        for batch in batches:
            x = pool(shared.value, [rows_of(t) for t in texts_of(batch)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("__tw_id"), batch.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["id", "y", "x"])

    got = sorted(by_id(map_batches(picked, features, "id long, y int, x array<double>")).collect())  # about max_docs rows
    labels_y = np.array([r["y"] for r in got], np.float64)
    if len(got) < 10 or labels_y.min() == labels_y.max():
        return constant_model(labels_y)
    x = np.array([r["x"] for r in got])
    aside = np.array([crc32(b"%d" % r["id"]) // 5 % 5 == 0 for r in got])
    if min(labels_y[aside].sum(), (1 - labels_y[aside]).sum(), labels_y[~aside].sum(), (1 - labels_y[~aside]).sum()) < 1:
        aside = np.zeros(len(got), bool)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / scale
    layers = fit_net(z[~aside], labels_y[~aside])
    held = aside if aside.any() else ~aside
    return Model(vectors, mean, scale, layers, fit_temperature(logits(layers, z[held]), labels_y[held]))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` of every row: the probability of label 1. Null and
    empty texts get the score of a document without words; null and repeated
    ids stay, a row each; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, rows_of = shared.value, Rows()
        for batch in batches:
            p = m.probability(m.pool([rows_of(t) for t in texts_of(batch)]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    return map_batches(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run,
                       f"doc_id {docs.schema[doc_id].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is at least
    ``threshold``. Rows pass through one task each, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, rows_of = shared.value, Rows()
        for batch in batches:
            p = m.probability(m.pool([rows_of(t) for t in texts_of(batch, text)]))
            yield batch.filter(pa.array(p >= threshold))

    return map_batches(docs, run, docs.schema)
