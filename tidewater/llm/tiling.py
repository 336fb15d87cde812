"""Benchmark decontamination by greedy string tiling (operator 6).

Words are lower-cased runs of letters and digits. Windows of ``min_match``
words are hashed by a rolling polynomial (Karp-Rabin); windows that a document
shares with a benchmark text are seeds. Seeds in a row on one diagonal are one
match; the longest match whose words are still unmarked is marked as a tile,
again and again, until none of ``min_match`` words is left. Where repeats make
more seed pairs than words, the longest matches are found by prints of growing
windows instead of a list of seeds; the tiles are the same. Tiles do not
overlap, in either text, but may come in any order, so passages that were
reordered are caught. A document is contaminated by a benchmark text if the
tiles cover at least ``min_coverage`` of its words."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import BoundedCache, map_batches, texts_of

_WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Characters of benchmark text that one broadcast block holds at most (one
#: longer text is a block of its own).
BLOCK_CHARS = 8_000_000


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def windows(ids: np.ndarray, width: int) -> np.ndarray:
    """Rolling hash of each window of ``width`` ids."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    plain = ids.astype(np.int64).view(np.uint64)
    for k in range(width):
        out = out * _BASE + plain[k : k + n] + np.uint64(1)
    return out


def matches(a: np.ndarray, b: np.ndarray, seeds: list[tuple[int, int]], width: int) -> list[tuple[int, int, int]]:
    """(length, start in a, start in b) of the maximal runs of seeds; a seed is
    a pair of window starts, checked here word by word."""
    out: list[tuple[int, int, int]] = []
    run = None
    for diagonal, i in sorted((j - i, i) for i, j in seeds if np.array_equal(a[i : i + width], b[j : j + width])):
        if run and run[0] == diagonal and run[2] == i - 1:
            run[2] = i
        else:
            if run:
                out.append((run[2] - run[1] + width, run[1], run[1] + run[0]))
            run = [diagonal, i, i]
    if run:
        out.append((run[2] - run[1] + width, run[1], run[1] + run[0]))
    return out


def tile(found: list[tuple[int, int, int]], n_a: int, n_b: int, width: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (length, start in a, start in b): longest first, ties by
    the start in a, then in b."""
    heap = [(-n, i, j) for n, i, j in found]
    heapq.heapify(heap)
    free_a, free_b = np.ones(n_a, bool), np.ones(n_b, bool)
    tiles = []
    while heap:
        n, i, j = heapq.heappop(heap)
        n = -n
        free = free_a[i : i + n] & free_b[j : j + n]
        if free.all():
            tiles.append((n, i, j))
            free_a[i : i + n] = free_b[j : j + n] = False
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], free.view(np.int8), [0]))))
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if hi - lo >= width:
                heapq.heappush(heap, (lo - hi, i + lo, j + lo))
    return tiles


class Prints:
    """Karp-Rabin prints of every window of any one length of a sequence of ids,
    from prefix sums modulo two primes of 31 bits."""

    PRIMES, BASES = (2147483647, 2147483629), (1103515245, 1664525)

    def __init__(self, ids: np.ndarray, longest: int):
        self.parts = []
        self.n, self.longest = len(ids), longest
        for prime, base in zip(self.PRIMES, self.BASES):
            power = np.ones(longest + 1, np.uint64)
            known = 1
            while known <= longest:  # base^(known + i) = base^known * base^i
                step = np.uint64(pow(base, known, prime))
                more = power[: min(known, longest + 1 - known)] * step % np.uint64(prime)
                power[known : known + len(more)] = more
                known += len(more)
            terms = (ids.astype(np.int64) + 2).astype(np.uint64) * power[: self.n] % np.uint64(prime)
            self.parts.append((np.uint64(prime), power, np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms) % np.uint64(prime)))))

    def of(self, width: int) -> np.ndarray:
        n, out = self.n - width + 1, np.zeros(max(0, self.n - width + 1), np.uint64)
        for prime, power, sums in self.parts:
            window = (sums[width : width + n] + prime - sums[:n]) % prime
            # all windows are moved to the same power
            out = (out << np.uint64(32)) | (window * power[self.longest - np.arange(n)] % prime)
        return out


def tile_by_prints(a: np.ndarray, b: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """The tiles of ``tile``, without a list of matches, for texts with so many
    repeats that the pairs of equal windows outnumber their words: the greatest
    length at which unmarked windows have equal prints is searched for, its
    matches are checked word by word and marked, and again with what is left. A
    window of one text only moves forward through the places of its print."""
    most = max(len(a), len(b))
    prints = Prints(a, most), Prints(b, most)
    free = np.ones(len(a), bool), np.ones(len(b), bool)

    def open_windows(side: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        taken = np.concatenate(([0], np.cumsum(~free[side])))
        at = np.flatnonzero(taken[length:] == taken[:-length])
        return at, prints[side].of(length)[at]

    def shared(length: int) -> bool:
        return bool(np.isin(open_windows(0, length)[1], open_windows(1, length)[1]).any())

    tiles, top = [], min(len(a), len(b))
    while top >= width and shared(width):
        low, high = width, top  # the greatest length with equal windows
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if shared(middle) else (low, middle - 1)
        at_a, print_a = open_windows(0, low)
        at_b, print_b = open_windows(1, low)
        places: dict[int, list[int]] = {}
        some = np.isin(print_b, print_a)
        for j, x in zip(at_b[some].tolist(), print_b[some].tolist()):
            places.setdefault(x, []).append(j)
        upto = dict.fromkeys(places, 0)
        some = np.isin(print_a, print_b)
        for i, x in zip(at_a[some].tolist(), print_a[some].tolist()):
            if not (free[0][i] and free[0][i + low - 1]):  # tiles of this round are as long, so they cover an end
                continue
            here, k = places[x], upto[x]
            while k < len(here) and not (free[1][here[k]] and free[1][here[k] + low - 1]):
                k += 1
            upto[x] = k
            if k < len(here) and np.array_equal(a[i : i + low], b[here[k] : here[k] + low]):
                tiles.append((low, i, here[k]))
                free[0][i : i + low] = free[1][here[k] : here[k] + low] = False
        top = low - 1
    return tiles


class Block:
    """Benchmark texts ready for matching: word ids, and seeds by hash."""

    def __init__(self, items: list[tuple[int, str]], min_match: int):
        self.vocab: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray, int]] = []
        seeds: dict[int, dict[int, dict[int, list[int]]]] = {}
        for item_id, text in items:
            ids = np.array([self.vocab.setdefault(w, len(self.vocab)) for w in words_of(text or "")], np.int64)
            if not len(ids):
                continue
            width = min(min_match, len(ids))
            for i, h in enumerate(windows(ids, width).tolist()):
                seeds.setdefault(width, {}).setdefault(h, {}).setdefault(len(self.items), []).append(i)
            self.items.append((item_id, ids, width))
        self.seeds = {w: (np.array(sorted(s), np.uint64), s) for w, s in seeds.items()}

    def tilings(self, docs: list[np.ndarray]) -> Iterator[tuple[int, int, float, list[tuple[int, int, int]]]]:
        """(number of the document, item_id, coverage, tiles) of every text and
        document that share a seed; a document is its word ids (-1: a word of
        no text)."""
        apart = np.array([-1], np.int64)
        ids = np.concatenate([x for d in docs for x in (d, apart)] or [apart])
        starts = np.cumsum([0] + [len(d) + 1 for d in docs])
        unknown = np.concatenate(([0], np.cumsum(ids < 0)))
        pairs: dict[tuple[int, int], list[tuple[list[int], int]]] = {}
        for width, (sorted_seeds, seeds) in self.seeds.items():
            at = np.flatnonzero(unknown[width:] == unknown[:-width])
            if not len(at):
                continue
            h = np.zeros(len(at), np.uint64)
            for k in range(width):
                h = h * _BASE + ids[at + k].view(np.uint64) + np.uint64(1)
            k = np.minimum(np.searchsorted(sorted_seeds, h), len(sorted_seeds) - 1)
            hit = sorted_seeds[k] == h
            at, h = at[hit], h[hit]
            doc = np.searchsorted(starts, at, "right") - 1
            for d, j, x in zip(doc.tolist(), (at - starts[doc]).tolist(), h.tolist()):
                for item, here in seeds[x].items():
                    pairs.setdefault((d, item), []).append((here, j))
        for (d, item), found in pairs.items():
            item_id, a, width = self.items[item]
            b = docs[d]
            if sum(len(here) for here, _ in found) <= 4 * (len(a) + len(b)):
                tiles = tile(matches(a, b, [(i, j) for here, j in found for i in here], width), len(a), len(b), width)
            else:
                tiles = tile_by_prints(a, b, width)
            yield d, item_id, sum(t[0] for t in tiles) / len(a), tiles


def blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's texts in blocks of at most ``BLOCK_CHARS`` characters,
    streamed through the driver a partition at a time."""
    rows, held = [], 0
    for r in benchmark.select(F.col(item_id).cast("long"), F.coalesce(F.col(text), F.lit(""))).toLocalIterator():
        if rows and held + len(r[1]) > BLOCK_CHARS:
            yield rows
            rows, held = [], 0
        rows.append((r[0], r[1]))
        held += len(r[1])
    if rows:
        yield rows


def find_overlaps(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, min_coverage: float = 0.5,
                  doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, coverage, n_tiles, longest_tile`` for every document
    and benchmark text whose tiles cover at least ``min_coverage`` of the text.

    The benchmark is the stated query set: each block of it (bounded by
    ``BLOCK_CHARS``) is broadcast and run against all rows, so a larger
    benchmark means more passes, never a larger broadcast. Texts shorter than
    ``min_match`` words match as a whole; texts without a word match nothing.
    Null texts are empty and match nothing; null ids stay null; repeated rows of
    either table each give rows; empty tables give no rows; other columns are
    not read."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, coverage double, n_tiles long, longest_tile long"
    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = None
    for rows in blocks(benchmark, item_id, item_text):
        shared = spark.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = Block(shared.value, min_match)
            look = block.vocab.get
            ids_of = BoundedCache(lambda chunk: tuple(look(w, -1) for w in words_of(chunk)))
            for batch in batches:
                found = []
                doc_ids = batch.column("doc_id").to_pylist()
                ids = [np.fromiter(chain.from_iterable(map(ids_of.__getitem__, t.split())), np.int64) for t in texts_of(batch)]
                for d, item, coverage, tiles in block.tilings(ids):
                    if coverage >= min_coverage:
                        found.append((doc_ids[d], item, coverage, len(tiles), max(x[0] for x in tiles)))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*found), (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
                        ["doc_id", "item_id", "coverage", "n_tiles", "longest_tile"])

        part = map_batches(picked, run, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **kw) -> DataFrame:
    """The rows of ``docs``, all columns, that ``find_overlaps`` does not report.
    The verdict hangs on the text alone, so rows are matched by a hash of it;
    a null text is kept."""
    key = F.xxhash64(F.col(text))
    hit = find_overlaps(docs.select(key.alias("doc_id"), F.col(text).alias("text")), benchmark, **kw)
    hit = hit.select(F.col("doc_id").alias("__tw_hit")).distinct()
    return docs.join(hit, (key == F.col("__tw_hit")) & F.col(text).isNotNull(), "left_anti")
