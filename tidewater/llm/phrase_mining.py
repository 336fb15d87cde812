"""Phrase collocation mining over a prefix-free parse (operator 13).

Every piece of a text (what stands between two signs that end a clause) is cut
into chunks where its content says so: a chunk ends with a window of three words
whose hash is a multiple of ``ONE_IN`` and the next one starts with that window,
so that equal passages give equal chunks wherever they stand. The dictionary of
distinct chunks with their frequencies in the parse is all that is counted:
n-grams of one to four words inside each distinct chunk, weighted by its
frequency. Chunks overlap by three words; an n-gram belongs to the chunk that
owns its first word, and the shared words are owned by the later chunk alone, so
each occurrence counts once.

Longer phrases are counted by a 64-bit hash first: two words, then three and four
where both two-word phrases at each end may be frequent. Hashes whose count
reaches the least go into a Bloom filter of ``FILTER_BITS`` bits, and only the
phrases it lets pass are counted as strings. Phrases that share a hash or pass by
mistake cost time; what is reported are the counts of the strings."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import map_batches, texts_of
from tidewater.session import stage

#: Words of a trigger window, and of the overlap of two chunks.
OVERLAP = 3
MAX_WORDS = OVERLAP + 1
#: One window in so many ends a chunk; pieces of at most ``WHOLE`` words are one
#: chunk, and a chunk that meets no trigger ends after ``LONGEST`` words.
ONE_IN, WHOLE, LONGEST = 16, 16, 64
FILTER_BITS = 1 << 26
PROBES = 3
#: Characters of new chunks, and bytes of distinct ones, that a task holds before it passes them on.
HELD_CHARS, HELD_BYTES = 16_000_000, 12_000_000
#: Groups in which the best of a language are sought before they meet.
RANK_GROUPS = 64

_ENDS = re.compile(r" ?[.,;:!?\x0A-\x0D] ?")
_BLANKS = re.compile(r"[ \t]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


# -- the parse ----------------------------------------------------------------


def pieces(text: str) -> list[str]:
    """The pieces that hold a word, A-Z lower-cased, words joined by a blank."""
    low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    if "  " in low or "\t" in low:
        low = _BLANKS.sub(" ", low)
    return [p for p in _ENDS.split(low.strip(" ")) if p]


def window_hash(words: list[str]) -> int:
    return xxhash.xxh32_intdigest(" ".join(words))


def parse(piece: str) -> Iterator[tuple[str, bool]]:
    """(chunk, whether it is the last of its piece). The last chunk owns all its
    words, another all but its last ``OVERLAP``."""
    if piece.count(" ") < WHOLE:
        yield piece, True
        return
    words, start = piece.split(" "), 0
    for i in range(1, len(words) - OVERLAP + 1):
        if i - start >= LONGEST or window_hash(words[i : i + OVERLAP]) % ONE_IN == 0:
            yield " ".join(words[start : i + OVERLAP]), False
            start = i
    yield " ".join(words[start:]), True


def chunk_table(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """``lang, chunk, last, n``: the distinct chunks and how often the parse has
    them. Copies are counted within a task before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, cut, held = defaultdict(Counter), Counter(), 0
        for batch in batches:
            for where, t in zip(batch.column("lang").to_pylist(), texts_of(batch)):
                found = pieces(t)
                whole[where].update([p for p in found if p.count(" ") < WHOLE])
                for piece in found:
                    if piece.count(" ") >= WHOLE:
                        cut.update([(where, *c) for c in parse(piece)])
                held += len(t)
                if held > HELD_CHARS:
                    yield from packed(whole, cut)
                    whole, cut, held = defaultdict(Counter), Counter(), 0
        yield from packed(whole, cut)

    def packed(whole: dict[str, Counter], cut: Counter) -> Iterator[pa.RecordBatch]:
        for where, found in whole.items():
            chunks = list(found)
            for at in range(0, len(chunks), 20_000):
                some = chunks[at : at + 20_000]
                yield row_batch([where] * len(some), some, [True] * len(some), [found[c] for c in some])
        keys = list(cut)
        for at in range(0, len(keys), 20_000):
            some = keys[at : at + 20_000]
            yield row_batch(*map(list, zip(*some)), [cut[k] for k in some])

    def row_batch(langs: list, chunks: list, last: list, n: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(chunks, pa.string()),
                                           pa.array(last, pa.bool_()), pa.array(n, pa.int64())], ["lang", "chunk", "last", "n"])

    picked = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    parts = map_batches(picked, run, "lang string, chunk string, last boolean, n long")
    return parts.groupBy("lang", "chunk", "last").agg(F.sum("n").alias("n"))


# -- counting -----------------------------------------------------------------


class PhraseFilter:
    """Bloom filter over phrase hashes, as an array of bytes."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        ok = np.ones(len(hashes), bool)
        for at in probes(hashes):
            ok &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
        return ok


def probes(hashes: np.ndarray) -> Iterator[np.ndarray]:
    """The bits of each phrase."""
    h = hashes ^ (hashes >> np.uint64(29))
    for k in range(PROBES):
        h = h * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(k)
        yield (h >> np.uint64(20)) % np.uint64(FILTER_BITS)


def phrase_filter(hashes: DataFrame) -> PhraseFilter:
    """The filter of a table of hashes: each task sets bits in an array of the
    filter's size, the 64-bit words with a bit are united in Spark and at most
    ``FILTER_BITS / 64`` of them come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for batch in batches:
            for at in probes(batch.column(0).to_numpy().view(np.uint64)):
                np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        words = bits.view("<i8")
        at = np.flatnonzero(words)
        for k in range(0, len(at), 50_000):
            some = at[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(words[some], pa.int64())], ["at", "word"])

    found = hashes.select("h").mapInArrow(run, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    words = np.zeros(FILTER_BITS // 64, "<i8")
    words[found.column("at").to_numpy()] = found.column("word").to_numpy()
    return PhraseFilter(words.view(np.uint8))


class Words:
    """Some distinct chunks as flat arrays: for each word its number, the hash of
    its language and itself, the words from it to the end of its chunk, whether
    the chunk owns it, and the chunk's frequency."""

    def __init__(self, table: pa.Table):
        lists = pc.split_pattern(table.column("chunk").combine_chunks(), " ")
        coded = lists.flatten().dictionary_encode()
        self.ids, self.names = coded.indices.to_numpy(), coded.dictionary
        lengths = pc.list_value_length(lists).to_numpy()
        langs = table.column("lang").combine_chunks().dictionary_encode()
        self.langs, self.lang_ids = langs.dictionary, np.repeat(langs.indices.to_numpy(), lengths)
        place = np.arange(len(self.ids), dtype=np.int32) - np.repeat((np.cumsum(lengths) - lengths).astype(np.int32), lengths)
        self.room = np.repeat(lengths, lengths) - place
        last = table.column("last").to_numpy()
        self.own = place < np.repeat(lengths - OVERLAP * ~last, lengths)
        self.weight = np.repeat(table.column("n").to_numpy(), lengths)

    def hashes(self, most: int) -> dict[int, np.ndarray]:
        """By size from 1 to ``most``, the hash of the phrase at each word (what
        runs over the end of a chunk means nothing)."""
        code = lambda names: np.fromiter(map(xxhash.xxh64_intdigest, names.to_pylist()), np.uint64, len(names))
        word = code(self.names)[self.ids]
        out = {1: code(self.langs)[self.lang_ids] * _BASE + word}
        for size in range(2, most + 1):
            longer = np.zeros(len(word), np.uint64)
            longer[: len(word) - size + 1] = out[size - 1][: len(word) - size + 1] * _BASE + word[size - 1 :]
            out[size] = longer
        return out

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        parts = [self.names.take(pa.array(self.ids[at + k])) for k in range(size)]
        return parts[0] if size == 1 else pc.binary_join_element_wise(*parts, " ")

    def totals(self, keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(a place, the summed frequency) of each distinct key of the words
        ``at``."""
        _, first, number = np.unique(keys, return_index=True, return_inverse=True)
        total = np.zeros(len(first), np.int64)
        np.add.at(total, number, self.weight[at])
        return at[first], total


def over_chunks(chunks: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(Words)`` over some ``HELD_BYTES`` of chunks at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column("chunk").nbytes
            if size > HELD_BYTES:
                yield from fn(Words(pa.Table.from_batches(held)))
                held, size = [], 0
        if sum(b.num_rows for b in held):
            yield from fn(Words(pa.Table.from_batches(held)))

    return chunks.select("lang", "chunk", "last", "n").mapInArrow(run, schema)


def sliced(names: list[str], *columns: pa.Array) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), 50_000):
        yield pa.RecordBatch.from_arrays([c.slice(at, 50_000) for c in columns], names)


def frequent_hashes(chunks: DataFrame, sizes: tuple[int, ...], min_count: int, pairs: PhraseFilter | None) -> DataFrame:
    """``h``: hashes of phrases of the given sizes whose counts reach
    ``min_count``, with ``pairs`` only of those made of pairs that pass it."""
    shared = None if pairs is None else chunks.sparkSession.sparkContext.broadcast(pairs.bits)

    def count(w: Words) -> Iterator[pa.RecordBatch]:
        hashes = w.hashes(max(sizes))
        ok = w.room > 1 if shared is None else (w.room > 1) & PhraseFilter(shared.value).holds(hashes[2])
        for size in range(2, max(sizes) + 1):
            if size > 2:  # the pair at the end of the phrase passes too
                ok = ok & (w.room >= size) & np.append(pair[size - 2 :], np.zeros(size - 2, bool))[: len(ok)]
            else:
                pair = ok
            if size in sizes:
                at = np.flatnonzero(ok & w.own)
                first, total = w.totals(hashes[size][at], at)
                yield from sliced(["h", "f"], pa.array(hashes[size][first].view(np.int64)), pa.array(total))

    found = over_chunks(chunks, count, "h long, f long").groupBy("h").agg(F.sum("f").alias("f"))
    return found.where(F.col("f") >= min_count).select("h")


def phrase_counts(chunks: DataFrame, most: int, passed: PhraseFilter) -> DataFrame:
    """``lang, phrase, size, f`` of all words and of the longer phrases that pass
    the filter."""
    shared = chunks.sparkSession.sparkContext.broadcast(passed.bits)

    def count(w: Words) -> Iterator[pa.RecordBatch]:
        hashes, passed = w.hashes(most), PhraseFilter(shared.value)
        for size in range(1, most + 1):
            at = np.flatnonzero(w.own & (w.room >= size))
            if size == 1:
                code, names = w.ids[at], len(w.names)
            else:
                at = at[passed.holds(hashes[size][at])]
                coded = w.phrases(at, size).dictionary_encode()
                code, names = coded.indices.to_numpy(), len(coded.dictionary)
            first, total = w.totals(w.lang_ids[at].astype(np.int64) * (names + 1) + code, at)
            yield from sliced(["lang", "phrase", "size", "f"], w.langs.take(pa.array(w.lang_ids[first])), w.phrases(first, size),
                              pa.array(np.full(len(first), size, np.int32)), pa.array(total))

    parts = over_chunks(chunks, count, "lang string, phrase string, size int, f long")
    return parts.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))


# -- candidates ---------------------------------------------------------------


def _part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored(frequent: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score``: every phrase of two words and more with
    its lowest-scoring cut (ties: the first)."""
    words = F.split("phrase", " ")
    longer = frequent.where("size > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = longer.select("lang", "phrase", F.col("f").alias("a"), "k", _part(words, F.lit(1), F.col("k")).alias("head"),
                         _part(words, F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    heads = frequent.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = frequent.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    both = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    both = both.withColumn("twice", wide("a") * F.lit(2_000_000).cast("decimal(7,0)")).withColumn("parts", wide("l") + wide("r"))
    best = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("twice div parts").alias("score"), "k", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "a", "b.l", "b.r", "b.score")


def longest_share(frequent: DataFrame, min_words: int = 2) -> DataFrame:
    """``lang, phrase, most``: the largest count of a longer phrase that holds
    the phrase."""
    words = F.split("phrase", " ")
    lengths = F.explode(F.sequence(F.lit(min_words), F.col("size") - 1))
    inner = (frequent.where(F.col("size") > min_words).withColumn("len", lengths)
             .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("len") + 1))))
    return (inner.select("lang", _part(words, F.col("start"), F.col("len")).alias("phrase"), "f")
            .groupBy("lang", "phrase").agg(F.max("f").alias("most")))


def best_of(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language, numbered: the first of each group of
    phrases, then of those."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
    some = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", group).orderBy(*order))).where(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)


def mine(docs: DataFrame, min_count: int = 30, max_words: int = MAX_WORDS, held_share: int = 80, top: int = 2000,
         lang: str = "lang", text: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the collocations of each
    language. ``a`` is the phrase's count, ``l`` and ``r`` those of the two parts
    of its lowest-scoring cut, ``n`` all words of the language, the score
    ``floor(2000000 * a / (l + r))`` in exact arithmetic. A phrase that a longer
    frequent one holds in at least ``held_share`` percent of its occurrences goes.

    A null language is ``und``, a null text empty; texts and languages without a
    frequent phrase and empty tables give no rows; repeated rows count as often
    as they come; ties go by count, then phrase (UTF-8 bytes); other columns are
    not read. No document is held whole in a group: what is shuffled are distinct
    chunks and counts, summed within each task before."""
    if not 2 <= max_words <= MAX_WORDS:
        raise ValueError(f"phrases have 2 to {MAX_WORDS} words")
    chunks = stage(chunk_table(docs, lang, text), "phrase-chunks")
    hashes = stage(frequent_hashes(chunks, (2,), min_count, None), "phrase-pairs")
    if max_words > 2:
        longer = frequent_hashes(chunks, tuple(range(3, max_words + 1)), min_count, phrase_filter(hashes))
        hashes = hashes.unionByName(stage(longer, "phrase-hashes"))
    counts = stage(phrase_counts(chunks, max_words, phrase_filter(hashes)), "phrase-counts")
    totals = counts.where("size = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    table = counts.where(F.col("f") >= min_count)
    kept = scored(table).join(longest_share(table), ["lang", "phrase"], "left")
    hundred = F.col("most").cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")
    kept = kept.where(F.col("most").isNull() | (hundred < F.col("a").cast("decimal(20,0)") * F.lit(held_share).cast("decimal(3,0)")))
    return (best_of(kept.drop("most"), top).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
