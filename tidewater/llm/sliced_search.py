"""Ranked lexical search over bit-sliced Bloom signatures (operator 11).

The index holds documents in blocks of like size. A block's signature is a
matrix of bits, a row (slice) per bit of the Bloom filters and a column per
document: a term that occurs in a document at least ``LEVELS[j]`` times sets,
for each such j, ``PROBES`` bits of its column. The and of a term's slices is a
bitmap of the documents that may hold it that often, never one too few. Summed
with what a term can contribute at most at each level, given the document's
exact length, the bitmaps give an upper bound of every document's score for
every query. Documents are scored exactly, from their terms, best bound first,
until the bounds fall below the k-th best exact score: only what is provably
outside the result is left out."""

from __future__ import annotations

import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidewater.llm.common import BoundedCache, map_batches
from tidewater.session import scratch_path, stage

#: Occurrences from which a term sets the bits of a level.
LEVELS = (1, 2, 3, 4, 6, 8, 12, 16, 32, 64)
BITS, PROBES = 12, 4
#: A block is closed at so many documents or bytes of terms; blocks of a file.
BLOCK_DOCS, BLOCK_BYTES, BLOCKS_A_FILE = 512, 1_000_000, 128
#: Queries of one matrix, and characters of queries in one pass over the index.
QUERIES, PASS_CHARS = 256, 2_000_000
HELD_TERMS = 500_000
RANK_GROUPS = 64

#: Fixed values of the score: bytes that make a term (A-Z lower-cased), saturation
#: and length constants.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_UNIT, _TF, _LENGTH = 1_000_000_000, 1000, 12


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return (text or b"").translate(_TERM_BYTES).split()


def length_part(n: int, docs: int, total: int) -> int:
    """A document's m."""
    return 100 - 25 + (25 * n * docs) // total


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def slices_of(hashes: np.ndarray, level: int, n_slices: int) -> list[np.ndarray]:
    """The slices of terms (by hash) at a level."""
    h = (hashes + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(31)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h >> np.uint64(8)) + np.uint64(k) * step) % np.uint64(n_slices) for k in range(PROBES)]


# -- the index ----------------------------------------------------------------


class OpenBlock:
    """Documents of like size on their way into a block."""

    def __init__(self):
        self.ids, self.lengths, self.terms, self.parts, self.held, self.keys = [], [], [], [], 0, 1

    def add(self, doc_id, terms: list[bytes], hashes: np.ndarray, tf: np.ndarray, keys: int) -> bool:
        """Whether the block is full."""
        self.ids.append(doc_id)
        self.lengths.append(len(terms))
        self.terms.append(b" ".join(terms))
        self.parts.append((hashes, tf))
        self.held += len(self.terms[-1])
        self.keys = max(self.keys, keys)
        return len(self.ids) >= BLOCK_DOCS or self.held >= BLOCK_BYTES

    def signature(self) -> tuple[int, bytes]:
        n_slices = BITS * self.keys
        owner = np.repeat(np.arange(len(self.ids)), [len(h) for h, _ in self.parts])
        hashes, tf = np.concatenate([h for h, _ in self.parts]), np.concatenate([t for _, t in self.parts])
        on = np.zeros((n_slices, -(-len(self.ids) // 8) * 8), bool)
        for level, least in enumerate(LEVELS):
            here = tf >= least
            if not here.any():
                break
            for rows in slices_of(hashes[here], level, n_slices):
                on[rows.astype(np.int64), owner[here]] = True
        return n_slices, np.packbits(on, axis=1).tobytes()

    def row(self) -> pa.RecordBatch:
        n_slices, bits = self.signature()
        return pa.RecordBatch.from_arrays(
            [pa.array([len(self.ids)], pa.int64()), pa.array([sum(self.lengths)], pa.int64()), pa.array([n_slices], pa.int64()),
             pa.array([bits], pa.binary()), pa.array([self.ids], pa.list_(pa.int64())), pa.array([self.lengths], pa.list_(pa.int64())),
             pa.array([self.terms], pa.list_(pa.binary()))],
            ["n_docs", "n_terms", "n_slices", "slices", "doc_ids", "lengths", "terms"])


def build_blocks(docs: DataFrame) -> DataFrame:
    """A row per block of ``docs`` (doc_id, text as bytes); documents without a
    term are in none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_of = BoundedCache(xxhash.xxh64_intdigest, 200_000)
        blocks: dict[int, OpenBlock] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                terms = terms_of(text)
                if not terms:
                    continue
                tfs = Counter(terms)
                hashes = np.fromiter(map(hash_of.__getitem__, tfs), np.uint64, len(tfs))
                tf = np.fromiter(tfs.values(), np.int64, len(tfs))
                keys = sum(int(np.count_nonzero(tf >= least)) for least in LEVELS)
                size = keys.bit_length()
                block = blocks.setdefault(size, OpenBlock())
                if block.add(doc_id, terms, hashes, tf, keys):
                    yield blocks.pop(size).row()
        for block in blocks.values():
            yield block.row()

    return map_batches(docs, run, "n_docs long, n_terms long, n_slices long, slices binary, doc_ids array<long>, "
                                  "lengths array<long>, terms array<binary>")


def vocabulary(docs: DataFrame) -> DataFrame:
    """``term, df`` of all terms; counted within a task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                df.update(set(terms_of(text)))
                if len(df) >= HELD_TERMS:
                    yield from packed(df)
                    df = Counter()
        yield from packed(df)

    def packed(df: Counter) -> Iterator[pa.RecordBatch]:
        terms = list(df)
        for at in range(0, len(terms), 20_000):
            some = terms[at : at + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary()), pa.array([df[t] for t in some], pa.int64())], ["term", "df"])

    return map_batches(docs.select("text"), run, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Index:
    """Blocks, vocabulary and totals of a table of documents, written in the
    shared folder. ``docs`` counts the documents with a term, ``total`` all their
    terms."""

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text"):
        self.spark = docs.sparkSession
        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
        path = scratch_path(self.spark, "search-blocks")
        build_blocks(rows).write.option("maxRecordsPerFile", BLOCKS_A_FILE).parquet(path)
        self.blocks = self.spark.read.parquet(path)
        self.vocabulary = stage(vocabulary(rows), "search-terms")
        zero = F.lit(0)
        self.docs, self.total = self.blocks.agg(F.coalesce(F.sum("n_docs"), zero), F.coalesce(F.sum("n_terms"), zero)).first()


# -- queries ------------------------------------------------------------------


class Queries:
    """Up to ``QUERIES`` queries as a matrix of term weights."""

    def __init__(self, rows: list[tuple[int, object, Counter]], df: dict[bytes, int], docs: int):
        self.rows = rows
        self.terms = sorted({t for _, _, q in rows for t in q if t in df})
        place = {t: k for k, t in enumerate(self.terms)}
        w = {t: weight(docs, df[t]) for t in self.terms}
        self.hashes = np.array([xxhash.xxh64_intdigest(t) for t in self.terms], np.uint64)
        self.exact = [[(t, n * w[t]) for t, n in q.items() if t in w] for _, _, q in rows]
        self.weights = np.zeros((len(rows), len(self.terms)))
        for i, q in enumerate(self.exact):
            for t, x in q:
                self.weights[i, place[t]] = x

    def bounds(self, n_slices: int, slices: bytes, lengths: np.ndarray, docs: int, total: int) -> np.ndarray:
        """Upper bounds of the scores, a row per query and a column per document."""
        bits = np.frombuffer(slices, np.uint8).reshape(n_slices, -1)
        n = lengths.astype(float)
        under = _LENGTH * (100 - 25 - 1 + 25 * n * docs / total)  # no more than the exact value
        out, before = np.zeros((len(self.rows), len(lengths))), np.zeros(len(lengths))
        some, hit = np.arange(len(self.terms)), None
        for level in range(len(LEVELS)):
            rows = slices_of(self.hashes[some], level, n_slices)
            now = bits[rows[0].astype(np.int64)]
            for r in rows[1:]:
                now &= bits[r.astype(np.int64)]
            if hit is not None:
                now &= hit  # as often as this means as often as that
            there = now.any(axis=1)
            some, hit = some[there], now[there]
            if not len(some):
                break
            most = np.minimum(LEVELS[level + 1] - 1, n) if level + 1 < len(LEVELS) else n
            share = _UNIT * most / (_TF * most + under)
            present = np.unpackbits(hit, axis=1, count=len(lengths)).astype(float)
            out += (self.weights[:, some] @ present) * np.maximum(share - before, 0)
            before = np.maximum(share, before)
        return out * (1 + 1e-9) + (out > 0)

    def score(self, i: int, tf: Counter, m: int) -> int:
        return sum(w * ((_UNIT * f) // (_TF * f + _LENGTH * m)) for t, w in self.exact[i] if (f := tf.get(t)))


class Searcher:
    """The best ``k`` documents of each query among the blocks it is shown."""

    def __init__(self, queries: Queries, k: int, docs: int, total: int):
        self.queries, self.k, self.docs, self.total = queries, k, docs, total
        self.best: list[list[tuple]] = [[] for _ in queries.rows]
        self.least = np.zeros(len(queries.rows))
        self.rescored = 0

    def look(self, n_slices: int, slices: bytes, doc_ids: list, lengths: list[int], terms: list[bytes], tfs: dict[int, Counter]) -> None:
        """``tfs`` keeps the counts of documents of this block already met."""
        bound = self.queries.bounds(n_slices, slices, np.array(lengths), self.docs, self.total)
        for i in np.flatnonzero((bound >= np.maximum(self.least, 1)[:, None]).any(axis=1)).tolist():
            best, row = self.best[i], bound[i]
            cand = np.flatnonzero(row >= max(self.least[i], 1))
            for d in cand[np.argsort(-row[cand], kind="stable")].tolist():
                if row[d] < self.least[i]:
                    break
                tf = tfs.get(d)
                if tf is None:
                    tf = tfs[d] = Counter(terms[d].split(b" "))
                self.rescored += 1
                score = self.queries.score(i, tf, length_part(lengths[d], self.docs, self.total))
                if score > 0:
                    insort(best, (-score, doc_ids[d] is None, doc_ids[d] or 0))
                    del best[self.k :]
                    if len(best) == self.k:
                        self.least[i] = -best[-1][0]


def passes(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, object, Counter]]]:
    """The queries (number, id, terms) in lots of at most ``PASS_CHARS``
    characters, streamed through the driver a partition at a time."""
    rows, held, number = [], 0, 0
    for r in items.select(F.col(item_id).alias("i"), F.col(text).cast("binary").alias("t")).toLocalIterator():
        size = len(r["t"] or b"")
        if rows and held + size > PASS_CHARS:
            yield rows
            rows, held = [], 0
        rows.append((number, r["i"], Counter(terms_of(bytes(r["t"] or b"")))))
        number, held = number + 1, held + size
    if rows:
        yield rows


def search(index: Index, items: DataFrame, k: int = 20, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents with a score
    above 0 of every row of ``items``, best first, equal scores by doc_id.

    The items are the stated query set: a lot of at most ``PASS_CHARS`` characters
    is broadcast at a time and run against all blocks. A null or empty text gives
    no rows, as do empty tables; repeated items are answered each, repeated
    documents each take a rank; null doc_ids come after others of their score;
    other columns are not read. A task passes on ``k`` rows a query, so no group
    grows with the size of a group of copies."""
    spark = index.spark
    kind = items.schema[item_id].dataType
    schema = f"item long, item_id {kind.simpleString()}, doc_id long, score long"
    kinds = [pa.int64(), to_arrow_type(kind), pa.int64(), pa.int64()]
    docs, total, out = index.docs, index.total, None
    for rows in passes(items, item_id, text) if docs else ():
        asked = spark.createDataFrame([(t,) for t in {t for _, _, q in rows for t in q}], "term binary")
        df = {bytes(r[0]): r[1] for r in index.vocabulary.join(asked, "term").collect()}  # no more than this lot's terms
        lots = [Queries(rows[at : at + QUERIES], df, docs) for at in range(0, len(rows), QUERIES)]
        shared = spark.sparkContext.broadcast(lots)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            searchers = [Searcher(q, k, docs, total) for q in shared.value]
            for batch in batches:
                cols = [batch.column(c) for c in ("n_slices", "slices", "doc_ids", "lengths", "terms")]
                for b in range(batch.num_rows):
                    block, tfs = [c[b].as_py() for c in cols], {}
                    for s in searchers:
                        s.look(*block, tfs)
            for s in searchers:
                found = [(number, name, None if none else d, -score)
                         for (number, name, _), best in zip(s.queries.rows, s.best) for score, none, d in best]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)],
                                                     ["item", "item_id", "doc_id", "score"])

        blocks = index.blocks.select("n_slices", "slices", "doc_ids", "lengths", "terms")
        part = blocks.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], schema)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    group = F.pmod(F.xxhash64("doc_id"), F.lit(RANK_GROUPS))
    some = out.withColumn("rank", F.row_number().over(Window.partitionBy("item", group).orderBy(*order))).where(F.col("rank") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
