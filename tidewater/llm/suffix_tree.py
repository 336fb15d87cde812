"""Language-model scores by a probabilistic suffix tree (operator 8).

Symbols are the bytes of the words joined by single spaces, each byte its own
symbol (the end of a text is one as well). Contexts are the up to ``DEPTH``
bytes before. Contexts and their next symbols are counted over all training
documents in Spark, and the counts, the tree and its probabilities are tables
that grow with the corpus. From the root on, a context's next-symbol
distribution is smoothed towards that of its suffix; a context stays in the
tree only if its distribution diverges from its suffix's by a likelihood-ratio
test (or a longer one below it stays). A symbol is scored in the state of the
longest suffix in the tree. Next to it stands the unigram base score over
words, whose counts cover all training documents."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import crc_bucket, map_batches
from tidewater.session import stage

SYMBOLS, DEPTH = 226, 5
#: Contexts of one symbol: what the driver holds as an array. Longer ones are rows.
STATES = SYMBOLS
#: Bits of a symbol in a code: the context's symbols, oldest first, then the next symbol.
BITS = 8
#: Weight of the suffix's distribution, in observations.
SMOOTH = 8.0
#: Least likelihood-ratio statistic (2 n KL) of a context that stays.
DIVERGENCE = 60.0
#: Words broadcast as the head of the vocabulary; the rest is joined.
HEAD_WORDS, HEAD_BYTES = 50_000, 64
#: Codes broadcast with their probabilities; the rest is joined.
HEAD_CODES = 1 << 19
#: Distinct codes that a task adds up before it hands them on.
TASK_CODES = 1_500_000
END = b"\n"  # no word holds white space, so this stands for the end


def _classes() -> np.ndarray:
    """The symbol of each byte: the end first, the bytes 0 to 8 last. Upper-case
    letters and white space other than the space occur in no word."""
    absent = {9, 11, 12, 13, *range(65, 91)}
    out = np.zeros(256, np.int64)
    for k, b in enumerate([10, *(b for b in range(14, 256) if b not in absent), *range(9)]):
        out[b] = k
    return out


CLASSES = _classes()


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased, cut at ASCII white space."""
    return text.lower().split()


def layout(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all documents, each after DEPTH and before one end byte; the
    first position and the length (with the end) of each."""
    gap = END * DEPTH
    joined = [b" ".join(d) for d in docs]
    lengths = np.array([len(x) + 1 for x in joined], np.int64)
    data = np.frombuffer(gap + b"".join([x + END + gap for x in joined]), np.uint8)
    return data, DEPTH + np.concatenate(([0], np.cumsum(lengths + DEPTH)[:-1])).astype(np.int64), lengths


def codes_of(data: np.ndarray) -> np.ndarray:
    """For each position from DEPTH on: context and symbol as one number."""
    s = CLASSES[data]
    n = len(s) - DEPTH
    out = s[:n].copy()
    for k in range(1, DEPTH + 1):
        out <<= BITS
        out += s[k : k + n]
    return out


def inside(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """True at the positions of documents and their ends."""
    edge = np.zeros(n + 1, np.int8)
    np.add.at(edge, starts - DEPTH, 1)
    np.add.at(edge, starts - DEPTH + lengths, -1)
    return np.cumsum(edge[:-1], dtype=np.int8).astype(bool)


class Tree:
    """The root and the contexts of one symbol as arrays. ``p[context, symbol]``
    is smoothed towards ``root``; ``diverges``: which contexts stay by the test.
    ``logp``: base 10, each symbol in the longest of these states; ``share``:
    each byte's part of its symbol (log10(1) = 0 where a symbol is one byte)."""

    def __init__(self, counts: np.ndarray, byte_counts: np.ndarray):
        c = counts.reshape(STATES, SYMBOLS).astype(np.float64)
        first = c.sum(0)
        self.root = (first + 0.5) / (first.sum() + 0.5 * SYMBOLS)
        n = c.sum(1, keepdims=True)
        self.p = (c + SMOOTH * self.root) / (n + SMOOTH)
        with np.errstate(divide="ignore", invalid="ignore"):
            test = 2 * np.nansum(np.where(c > 0, c * np.log((c / n) / self.root), 0), axis=1)
        self.diverges = test >= DIVERGENCE
        self.logp = np.log10(np.where(self.diverges[:, None], self.p, self.root)).reshape(-1)
        share = byte_counts + 0.5
        share[list(range(10)) + list(range(11, 14)) + list(range(65, 91))] = 0
        total = np.bincount(CLASSES, share, SYMBOLS)[CLASSES]
        with np.errstate(divide="ignore", invalid="ignore"):
            self.share = np.where(share > 0, np.log10(share / total), 0.0)


class Head:
    """log10 probabilities of the most frequent codes. A code has one slot of a
    table; the more frequent of two keeps it, the other is found by a search."""

    def __init__(self, codes: np.ndarray, logp: np.ndarray):
        """``codes`` by falling frequency."""
        self.shift = np.uint64(64 - max(4, int(4 * max(1, len(codes))).bit_length()))
        self.keys = np.full(1 << (64 - int(self.shift)), -1, np.int64)
        self.values = np.zeros(len(self.keys))
        at = self.slots(codes)
        self.keys[at[::-1]], self.values[at[::-1]] = codes[::-1], logp[::-1]
        lost = self.keys[at] != codes
        order = np.argsort(codes[lost])
        self.more, self.more_values = codes[lost][order], logp[lost][order]

    def slots(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value of each code (0 if it has none here), and which have one."""
        at = self.slots(codes)
        found = self.keys[at] == codes
        value = np.where(found, self.values[at], 0.0)
        rest = np.flatnonzero(~found)
        if len(rest) and len(self.more):
            k = np.minimum(np.searchsorted(self.more, codes[rest]), len(self.more) - 1)
            same = self.more[k] == codes[rest]
            value[rest[same]], found[rest[same]] = self.more_values[k[same]], True
        return value, found


def known_and_missing(head: Head, docs: list[list[bytes]]) -> tuple[np.ndarray, pa.Array]:
    """Of each document, the sum over the codes in the head, and the others with
    how often they occur."""
    data, starts, lengths = layout(docs)
    codes = codes_of(data)
    value, found = head.look_up(codes)
    bounds = np.stack((starts - DEPTH, starts - DEPTH + lengths), axis=1).reshape(-1)
    sums = np.add.reduceat(np.append(value, 0.0), bounds)[::2]
    miss = np.flatnonzero(~found & inside(starts, lengths, len(codes)))
    doc = np.searchsorted(starts - DEPTH, miss, side="right") - 1
    order = np.lexsort((codes[miss], doc))
    doc, code = doc[order], codes[miss][order]
    new = np.append(True, (np.diff(doc) != 0) | (np.diff(code) != 0))[: len(doc)]
    at = np.flatnonzero(new)
    offsets = np.searchsorted(doc[at], np.arange(len(docs) + 1))
    pairs = pa.StructArray.from_arrays([pa.array(code[at], pa.int64()), pa.array(np.diff(np.append(at, len(doc))), pa.int64())], ["c", "k"])
    return sums, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)


def added(parts: list[np.ndarray]) -> np.ndarray:
    """Rows (code, times in training, times in all) added up by code."""
    code, of = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    total = [np.bincount(of, np.concatenate([p[k] for p in parts]), len(code)).astype(np.int64) for k in (1, 2)]
    return np.stack((code, *total))


def gather(rows: DataFrame) -> DataFrame:
    """``word, code, n, uses``: counts of words (and of the end) in the training
    documents, and of all codes, one row each; ``n`` counts the training
    documents, ``uses`` all. Tasks add up what they read before anything is
    shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        parts: list[np.ndarray] = []
        for batch in batches:
            texts, held = batch.column("text").to_pylist(), batch.column("held_out").to_pylist()
            for out in (False, True):
                docs = [words_of(t or b"") for t, h in zip(texts, held, strict=True) if h == out]
                if not docs:
                    continue
                if not out:
                    for d in docs:
                        words.update(d)
                    words[END] += len(docs)
                data, starts, lengths = layout(docs)
                code, times = np.unique(codes_of(data)[inside(starts, lengths, len(data) - DEPTH)], return_counts=True)
                parts.append(np.stack((code, np.zeros_like(times) if out else times, times)))
            if len(words) > 300_000:
                yield word_rows(words)
                words.clear()
            if sum(p.shape[1] for p in parts[1:]) > TASK_CODES:
                parts = [added(parts)]
                if parts[0].shape[1] > TASK_CODES:
                    yield code_rows(parts.pop())
        yield word_rows(words)
        if parts:
            yield code_rows(added(parts))

    names = ["word", "code", "n", "uses"]

    def word_rows(words: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(words.keys()), pa.binary()), pa.nulls(len(words), pa.int64()), pa.array(list(words.values()), pa.int64()),
             pa.nulls(len(words), pa.int64())], names)

    def code_rows(part: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.nulls(part.shape[1], pa.binary()), *[pa.array(x, pa.int64()) for x in part]], names)

    return (map_batches(rows, run, "word binary, code long, n long, uses long").groupBy("word", "code")
            .agg(F.sum("n").alias("n"), F.sum("uses").alias("uses")))


def last(code: Column, k: int) -> Column:
    """The code with ``k`` symbols of context only."""
    return code.bitwiseAND(F.lit((1 << BITS * (k + 1)) - 1))


def with_probabilities(codes: DataFrame) -> DataFrame:
    """``code, uses, logp`` of each ``code, n, uses``: log10 of its symbol's
    probability in the state of its longest suffix in the tree. All levels are
    tables; a key of a join has as many rows as there are symbols at most."""
    spark = codes.sparkSession
    levels = {DEPTH: codes.select("code", "n")}
    for k in range(DEPTH - 1, 0, -1):
        longer = levels[k + 1].select(last(F.col("code"), k).alias("code"), "n")
        levels[k] = stage(longer.groupBy("code").agg(F.sum("n").alias("n")), f"lm-level-{k}")
    counts = np.zeros((STATES, SYMBOLS), np.int64)
    for r in levels[1].collect():  # at most SYMBOLS * SYMBOLS
        counts[r[0] >> BITS, r[0] & ((1 << BITS) - 1)] = r[1]
    tree = Tree(counts, np.bincount(CLASSES, minlength=256).astype(np.float64))
    ctx, x = np.divmod(np.arange(STATES * SYMBOLS), SYMBOLS)
    first = pa.table({"code": (ctx << BITS) + x, "p": tree.p.reshape(-1), "up": tree.root[x], "diverges": tree.diverges[ctx]})
    found = {1: spark.createDataFrame(first)}
    for k in range(2, DEPTH + 1):
        shorter = found[k - 1].select(F.col("code").alias("suffix"), F.col("p").alias("up"))
        rows = levels[k].withColumn("suffix", last(F.col("code"), k - 1)).join(shorter, "suffix")
        state = Window.partitionBy("ctx")
        each = F.when(F.col("n") > 0, F.col("n") * F.log(F.col("n") / F.col("total") / F.col("up"))).otherwise(0.0)
        rows = rows.withColumn("ctx", F.shiftright("code", BITS)).withColumn("total", F.sum("n").over(state))
        rows = rows.withColumn("diverges", 2 * F.sum(each).over(state) >= DIVERGENCE)
        p = (F.col("n") + SMOOTH * F.col("up")) / (F.col("total") + SMOOTH)
        found[k] = stage(rows.select("code", p.alias("p"), "up", "diverges"), f"lm-states-{k}")
    # a suffix of a context that stays, stays
    stays = None
    best = None
    kept = {}
    for k in range(DEPTH, 0, -1):
        own = found[k].where("diverges").select(F.shiftright("code", BITS).alias("ctx"))
        stays = own if stays is None else own.union(stays.select(F.col("ctx").bitwiseAND(F.lit((1 << BITS * k) - 1))))
        stays = kept[k] = stage(stays.distinct(), f"lm-kept-{k}")
    for k in range(1, DEPTH + 1):
        rows = found[k].withColumn("ctx", F.shiftright("code", BITS)).join(kept[k].withColumn("stays", F.lit(True)), "ctx", "left")
        shorter = F.col("up")
        if best is not None:
            rows = rows.withColumn("suffix", last(F.col("code"), k - 1)).join(
                best.select(F.col("code").alias("suffix"), F.col("p").alias("short")), "suffix")
            shorter = F.col("short")
        best = stage(rows.select("code", F.when(F.col("stays"), F.col("p")).otherwise(shorter).alias("p")), f"lm-best-{k}")
    return codes.select("code", "uses").join(best, "code").select("code", "uses", F.log10("p").alias("logp"))


def least_of_head(counts: DataFrame, n: str, rows: int) -> int:
    """A count that at most ``rows`` rows reach, as low as a histogram with
    steps of an eighth shows it. The driver gets one row a step, at most 512,
    whatever the number of rows or partitions."""
    step = F.floor(8 * F.log2(F.col(n).cast("double"))).cast("int")
    steps = counts.where(F.col(n) > 0).groupBy(step.alias("step")).agg(F.count("*").alias("rows"), F.min(n).alias("least"))
    least, taken = 2**63 - 1, 0
    for r in sorted(steps.collect(), key=lambda r: -r["step"]):
        taken += r["rows"]
        if taken > rows:
            break
        least = r["least"]
    return least


def score(docs: DataFrame, folds: int = 5, held: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    of every row; documents whose id's crc32 modulo ``folds`` is ``held`` are
    scored but not learned from.

    A null text is the empty text (its end alone is scored); a null id counts as
    the empty text for the fold; repeated rows are learned from and scored as
    often as they come; with no training rows the base is log10(1) = 0 a token
    and the tree is uniform; an empty table gives no rows; other columns are not
    read. At most the 50,000 most frequent words and ``HEAD_CODES`` codes are
    broadcast (``least_of_head``); only rarer ones are joined, so no key of the
    joins is frequent. No score depends on where the heads end."""
    spark = docs.sparkSession
    remainder = crc_bucket(F.col(doc_id), folds)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (remainder == held).alias("held_out"),
                       F.col(text).cast("binary").alias("text"))
    stats = stage(gather(rows.select("held_out", "text")), "lm-counts")
    words = stats.where(F.col("word").isNotNull()).select("word", "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    states = stage(with_probabilities(stats.where(F.col("code").isNotNull()).select("code", "n", "uses")), "lm-tree")
    top = states.where(F.col("uses") >= least_of_head(states, "uses", HEAD_CODES)).select("code", "logp").toArrow()
    codes = Head(top.column("code").to_numpy(), top.column("logp").to_numpy())
    short = words.where(F.length("word") <= HEAD_BYTES)
    head = {bytes(r[0]): r[1] for r in short.where(F.col("n") >= least_of_head(short, "n", HEAD_WORDS)).collect()}
    shared = spark.sparkContext.broadcast((codes, head))
    floor = np.log10(0.5 / (total + 0.5 * (distinct + 1)))
    bottom = float(total + 0.5 * (distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, head = shared.value
        value = {w: float(np.log10((n + 0.5) / bottom)) for w, n in head.items()}
        for batch in batches:
            docs = [words_of(t or b"") for t in batch.column("text").to_pylist()]
            base, known, rare = [], [], []
            for d in docs:
                got = list(map(value.get, d))
                here = [x for x in got if x is not None]
                end = value.get(END, floor)
                base.append(float(np.sum(here)) + end)
                known.append(len(here) + (END in value))
                rare.append(list(Counter(w for w, x in zip(d, got) if x is None).items()) if len(here) < len(d) else [])
            if not docs:
                continue
            sums, missing = known_and_missing(codes, docs)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([len(d) + 1 for d in docs], pa.int64()),
                 pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(sums, pa.float64()),
                 pa.array([[{"w": w, "k": k} for w, k in r] for r in rare], pa.list_(pa.struct([("w", pa.binary()), ("k", pa.int64())]))), missing],
                ["doc_id", "held_out", "n_tokens", "n_known", "base", "known", "rare", "missing"])

    scored = map_batches(rows, run, "doc_id long, held_out boolean, n_tokens long, n_known long, base double, known double, "
                                    "rare array<struct<w:binary,k:long>>, missing array<struct<c:long,k:long>>")
    scored = stage(scored.withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    asked = scored.select("row", F.explode("rare").alias("r")).select("row", F.col("r.w").alias("word"), F.col("r.k").alias("k"))
    tail = asked.join(words, "word", "left")
    value = F.log10((F.coalesce("n", F.lit(0)) + F.lit(0.5)) / F.lit(bottom))
    sums = tail.groupBy("row").agg(F.sum(F.col("k") * value).alias("s"),
                                   F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("m"))
    deep = scored.select("row", F.explode("missing").alias("r")).select("row", F.col("r.c").alias("code"), F.col("r.k").alias("k"))
    deep = deep.join(states.select("code", "logp"), "code").groupBy("row").agg(F.sum(F.col("k") * F.col("logp")).alias("t"))
    return (scored.drop("rare", "missing").join(sums, "row", "left").join(deep, "row", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("m", F.lit(0))).alias("n_known"),
                    F.lit(int(total)).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("s", F.lit(0.0))).alias("base_score"),
                    (F.col("known") + F.coalesce("t", F.lit(0.0))).alias("score")))
