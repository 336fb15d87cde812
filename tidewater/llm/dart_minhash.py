"""Near-duplicate classes by DartMinHash (operator 9).

A document is the bag of its five-word shingles, each weighted by how often it
occurs. Darts are thrown at the plane of weight and rank of each shingle: the
weight axis is cut into the regions [2^v - 1, 2^(v+1) - 1), and in a region the
ranks of the darts are a Poisson process whose gaps come from a hash of
(shingle, region, number of the dart), so equal shingles get equal darts in
every document. A dart counts if its weight lies below the shingle's weight.
Each dart names a coordinate of the signature; the earliest (least rank) dart
of each coordinate is kept. Two documents agree in a coordinate with the
probability of their weighted Jaccard similarity. Only darts up to a rank that
fills the signature are made, so the work is about k log k + size, not k times
size.

Bands of the signature propose pairs, the exact weighted similarity confirms
them, and linked documents form classes."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import BoundedCache, map_batches, texts_of
from tidewater.llm.components import components
from tidewater.session import stage

WORDS, SIMILARITY = 5, 0.8
#: BANDS bands of BAND_ROWS coordinates: a pair at 0.8 shares none with
#: probability (1 - 0.8^6)^36 = 2e-5, a pair at 0.3 shares one with 3 percent.
BANDS, BAND_ROWS = 36, 6
K = BANDS * BAND_ROWS
#: Pairs whose signatures agree in less than this share of the coordinates are
#: not compared exactly: 0.8 less 4.5 standard deviations of the estimate.
ESTIMATE = SIMILARITY - 4.5 * math.sqrt(SIMILARITY * (1 - SIMILARITY) / K)
#: Members of a bucket that the others are compared with in the second pass.
CENTRES = 4
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finisher: a hash of each number."""
    x = x ^ (x >> _U(30))  # a new array, changed in place from here on
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def words_of(text: str) -> list[bytes]:
    """Lower-cased words between ASCII white space."""
    return text.lower().encode().split()


def name_of(words: list[bytes]) -> bytes | None:
    """A 128-bit name of a word sequence; none for no words."""
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None


class Shingler:
    """Shingle hashes of whole texts, with repeats: windows of WORDS lower-cased
    words; a shorter text is one shingle, a text without words none."""

    def __init__(self, words: int = WORDS):
        self.words, self.hashes = words, BoundedCache(word_hash, 100_000)

    def __call__(self, text: str) -> tuple[int, bytes | None, np.ndarray]:
        """Number of words, name of the word sequence, shingles."""
        words = words_of(text)
        name = name_of(words)
        ids = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        width = min(self.words, len(ids))
        if not width:
            return 0, name, ids
        out = np.full(len(ids) - width + 1, width, np.uint64)
        for k in range(width):
            out = _mix(out * _U(0x9E3779B97F4A7C15) + ids[k : k + len(out)])
        return len(words), name, out


def bag(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingles, return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], k: int = K) -> np.ndarray:
    """A row of k 64-bit dart names per bag of (element, weight > 0); weights
    may be fractions. A bag without elements gets zeros."""
    out = np.zeros((len(bags), k), np.uint64)
    size = np.array([float(np.sum(w)) for _, w in bags])
    todo = np.flatnonzero(size > 0)
    reach = np.zeros(len(bags))
    reach[todo] = k * (math.log(k) + 2) / size[todo]
    while len(todo):
        elements = np.concatenate([bags[d][0] for d in todo])
        weights = np.concatenate([np.asarray(bags[d][1], np.float64) for d in todo])
        doc = np.repeat(np.arange(len(todo)), [len(bags[d][0]) for d in todo])
        slots, ranks, names = [], [], []
        for v in range(int(np.log2(weights.max() + 1)) + 1):
            at = np.flatnonzero(weights > 2**v - 1)
            cell = _mix(elements[at] ^ _mix(np.full(1, v + 1, np.uint64)))
            weight, row, limit = weights[at], doc[at], reach[todo][doc[at]]
            rank, number = np.zeros(len(at)), 0
            while len(cell):
                number += 1
                dart = _mix(cell + _U(number * 0x9E3779B97F4A7C15 % 2**64))
                rank = rank - np.log1p(-(dart >> _U(11)).astype(np.float64) * 2.0**-53) / 2**v
                near = np.flatnonzero(rank < limit)
                cell, weight, row, limit, rank, dart = (x.take(near) for x in (cell, weight, row, limit, rank, dart))
                hit_row, hit_rank, hit = row, rank, dart
                if v or (weight < 1).any():  # the first region has whole weight below any weight of 1 and more
                    height = (_mix(dart + _U(1)) >> _U(11)).astype(np.float64) * 2.0 ** (v - 53)
                    below = np.flatnonzero((2**v - 1 + height < weight) | ((v == 0) & (weight >= 1)))
                    hit_row, hit_rank, hit = row.take(below), rank.take(below), dart.take(below)
                name = _mix(hit + _U(2))
                slots.append(hit_row * k + (name % _U(k)).astype(np.int64))
                ranks.append(hit_rank)
                names.append(name)
        slot, rank, name = np.concatenate(slots), np.concatenate(ranks), np.concatenate(names)
        best = np.full(len(todo) * k, np.inf)
        np.minimum.at(best, slot, rank)
        first = rank == best[slot]
        flat = np.zeros(len(todo) * k, np.uint64)
        flat[slot[first]] = name[first]
        full = np.isfinite(best).reshape(len(todo), k).all(axis=1)
        out[todo[full]] = flat.reshape(len(todo), k)[full]
        todo = todo[~full]
        reach[todo] *= 2
    return out


def signatures_in_parts(bags: list[tuple[np.ndarray, np.ndarray]], most: int = 500_000) -> np.ndarray:
    """``signatures``, for about ``most`` elements at a time."""
    part = np.cumsum([len(e) for e, _ in bags]) // most if bags else np.empty(0)
    groups = [[bags[i] for i in np.flatnonzero(part == g)] for g in np.unique(part)]
    return np.concatenate([signatures(g) for g in groups] or [np.zeros((0, K), np.uint64)])


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row."""
    parts = sig.reshape(len(sig), BANDS, BAND_ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sig), BANDS)).copy()
    for r in range(BAND_ROWS):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + parts[:, :, r])
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags sorted by element."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(a[1][i], b[1][j]).sum())
    return low / max(1, int(a[1].sum()) + int(b[1].sum()) - low)


def _sketches(docs: DataFrame) -> DataFrame:
    """``name, least, at, copies, size, sig``: a row per different word
    sequence, with the least doc_id of its rows, id and text hash of one of them
    and 2 bytes of each coordinate's dart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler()
        for batch in batches:
            rows = [shingle(t) for t in texts_of(batch)]
            once = {name: k for k, (n, name, _) in enumerate(rows) if n}
            order = list(once.values())
            sig = signatures_in_parts([bag(rows[k][2]) for k in order])
            place = {name: i for i, name in enumerate(once)}
            keep = [k for k, r in enumerate(rows) if r[0]]
            at = [place[rows[k][1]] for k in keep]
            keys = band_keys(sig) if len(sig) else np.empty((0, BANDS), np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[k][1] for k in keep], pa.binary()), *batch.select(["doc_id", "mark"]).take(pa.array(keep, pa.int64())).columns,
                 pa.array([len(rows[k][2]) for k in keep], pa.int64()),
                 pa.array([sig[i].astype(np.uint16).view(np.int16) for i in at], pa.list_(pa.int16())),
                 pa.array([keys[i].view(np.int64) for i in at], pa.list_(pa.int64()))],
                ["name", "doc_id", "mark", "size", "sig", "keys"])

    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    rows = map_batches(marked, run, "name binary, doc_id long, mark long, size long, sig array<smallint>, keys array<long>")
    return rows.groupBy("name").agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "mark")).alias("at"), F.count("*").alias("copies"),
                                    F.first("size").alias("size"), F.first("sig").alias("sig"), F.first("keys").alias("keys"))


def _agreeing(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures and sizes allow the similarity."""
    side = lambda c: sketches.select(F.col("name").alias(c), F.col("sig").alias(f"sig_{c}"), F.col("size").alias(f"size_{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c).flatten().to_numpy().reshape(-1, K) for c in ("sig_a", "sig_b"))
            ok = (x == y).mean(axis=1) >= ESTIMATE
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    joined = pairs.join(side("a"), "a").join(side("b"), "b").where(_sizes_allow(F.col("size_a"), F.col("size_b")))
    return map_batches(joined.select("a", "b", "sig_a", "sig_b"), run, "a binary, b binary")


def _confirmed(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs whose exact weighted similarity is at least SIMILARITY."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("bag_a").to_pylist(), batch.column("bag_b").to_pylist()):
                ok.append(similarity(bag(np.frombuffer(x, np.uint64)), bag(np.frombuffer(y, np.uint64))) >= SIMILARITY)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    side = lambda c: bags.select(F.col("name").alias(c), F.col("bag").alias(f"bag_{c}"))
    return map_batches(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "bag_a", "bag_b"), run, "a binary, b binary")


def _bags(docs: DataFrame, sketches: DataFrame, names: DataFrame) -> DataFrame:
    """``name, bag``: the shingles of one row of each named word sequence. Its
    text is found by id and hash, so many texts of one id, or of none, meet only
    their own rows."""
    wanted = sketches.join(names, "name", "left_semi").select(F.col("at.doc_id").alias("wanted"), F.col("at.mark").alias("mark"), "name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler()
        for batch in batches:
            rows = [(w, shingle(t)) for w, t in zip(batch.column("name").to_pylist(), texts_of(batch))]
            rows = [(w, s) for w, (_, name, s) in rows if w == name]  # hashes may collide
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.binary()),
                                              pa.array([s.tobytes() for _, s in rows], pa.binary())], ["name", "bag"])

    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")) & (F.xxhash64("text") == F.col("mark"))).select("name", "text")
    return map_batches(texts, run, "name binary, bag binary").groupBy("name").agg(F.first("bag").alias("bag"))


def _own(bags: DataFrame) -> DataFrame:
    """``name, own``: the weight of the shingles that no other of these bags
    holds. They are in no intersection, which bounds the similarity of a pair
    from above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch.column("name").to_pylist(), batch.column("bag").to_pylist()):
                e, n = bag(np.frombuffer(raw, np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(e), pa.binary()), pa.array(e.view(np.int64)), pa.array(n)],
                                                 ["name", "shingle", "n"])

    each = map_batches(bags, run, "name binary, shingle long, n long")
    alone = each.groupBy("shingle").agg(F.count("*").alias("bags"), F.first("name").alias("name"), F.first("n").alias("n")).where("bags = 1")
    return alone.groupBy("name").agg(F.sum("n").alias("own"))


def _rooted(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """The members of the buckets with the root of their class."""
    joined = shared.join(classes, shared["name"] == classes["node"], "left")
    return stage(joined.select(*shared.columns, F.coalesce("root", "name").alias("root")), "dart-rooted")


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    if links.isEmpty():
        return classes
    return components(classes.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links))


def word_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sketches, classes): ``name, least, copies`` of every word sequence, and
    ``name, root`` of those that are linked to another one (roots have no row).

    Every two similar documents that share a bucket end in one class, but the
    pairs within a large group of copies are never listed: first all members of
    a bucket are compared with its least member; then, where they still lie in
    several classes, those of other classes with each of a few members that have
    few shingles of their own; then, where they still do, every pair of members of different classes
    that sizes and own shingles do not rule out. Members that their own shingles rule out
    against any other leave the bucket before they are paired."""
    sketches = stage(_sketches(docs), "dart-sketches")
    members = sketches.select("name", "size", F.explode("keys").alias("key"))
    buckets = members.groupBy("key").agg(F.min("name").alias("a"), F.max("name").alias("z")).where("a <> z").select("key", "a")
    buckets = stage(buckets, "dart-shared")  # as a table, so that a large bucket's side of the join can be split
    shared = stage(members.join(buckets, "key"), "dart-buckets")
    classes = components(_compare(shared.where("name <> a").select("a", F.col("name").alias("b")).distinct(), sketches, docs))
    shared = shared.drop("a")

    rooted = _rooted(shared, classes)
    mixed = stage(_mixed(rooted), "dart-mixed")
    rooted = stage(rooted.join(mixed, "key", "left_semi"), "dart-mixed-rows")
    bags = stage(_bags(docs, sketches, rooted.select("name").distinct()), "dart-bags")
    own = stage(_own(bags), "dart-own")
    shared = rooted.drop("root").join(own, "name", "left").select("key", "name", "size", F.coalesce("own", F.lit(0)).alias("own"))
    # whose own shingles weigh more than a fifth is like no other one: unlike documents of a bucket are never paired
    shared = stage(shared.where(F.col("size") - F.col("own") >= F.lit(SIMILARITY) * F.col("size")), "dart-owned")
    rooted = _rooted(shared, classes)
    # members with few shingles of their own are like the most others
    drawn = [F.min(F.struct(F.floor(F.col("own") / F.lit(2**s)).alias("o"), F.xxhash64("name", F.lit(s)).alias("h"), F.col("name").alias("c"),
                            F.col("root").alias("rc"), F.col("size").alias("sc"), F.col("own").alias("oc"))) for s in range(CENTRES)]
    centres = rooted.groupBy("key").agg(F.array(*drawn).alias("drawn")).select("key", F.explode("drawn").alias("d"))
    centres = stage(centres.select("key", "d.c", "d.rc", "d.sc", "d.oc").distinct(), "dart-centres")
    near = rooted.join(centres, "key").where((F.col("root") != F.col("rc")) & _may_reach("size", "own", "sc", "oc"))
    pairs = near.select(F.least("name", "c").alias("a"), F.greatest("name", "c").alias("b")).distinct()
    classes = _merged(classes, _compare(pairs, sketches, docs, bags))

    rooted = _rooted(shared, classes)
    mixed = stage(_mixed(rooted), "dart-mixed")
    rooted = stage(rooted.join(mixed, "key", "left_semi"), "dart-mixed-rows")
    # in a bucket the members of its largest class are not paired with each other
    main = (rooted.groupBy("key", "root").agg(F.count("*").alias("n"))
            .groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main")))
    rooted = rooted.join(main, "key").join(sketches.select("name", "sig", "keys"), "name")
    rooted = stage(rooted, "dart-rest")
    sides = ("name", "size", "root", "own", "sig", "keys")
    x = rooted.where("root <> main").select("key", *[F.col(c).alias(f"{c}_x") for c in sides])
    y = rooted.select("key", *[F.col(c).alias(f"{c}_y") for c in sides])
    same = lambda c: F.zip_with(f"{c}_x", f"{c}_y", lambda p, q: p == q)
    rest = x.join(y, "key").where(
        (F.col("root_x") != F.col("root_y")) & _may_reach("size_x", "own_x", "size_y", "own_y")
        & (F.get("keys_x", F.array_position(same("keys"), True).cast("int") - 1) == F.col("key"))  # in the first bucket shared only
        & (F.size(F.filter(same("sig"), lambda e: e)) >= F.lit(math.ceil(ESTIMATE * K))))
    rest = rest.select(F.least("name_x", "name_y").alias("a"), F.greatest("name_x", "name_y").alias("b")).distinct()
    rest = stage(rest, "dart-pairs")  # sizes and signatures are compared by the join above
    return sketches, _merged(classes, stage(_confirmed(rest, bags), "dart-links"))


def _mixed(rooted: DataFrame) -> DataFrame:
    """The buckets with members of several classes."""
    return rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")


def _may_reach(size_x: str, own_x: str, size_y: str, own_y: str) -> Column:
    """Whether sizes and own shingles leave the similarity possible."""
    low = F.least(F.col(size_x) - F.col(own_x), F.col(size_y) - F.col(own_y))  # the intersection weighs no more
    return low >= F.lit(SIMILARITY) * (F.col(size_x) + F.col(size_y) - low)


def _sizes_allow(x: Column, y: Column) -> Column:
    return F.least(x, y) >= F.lit(SIMILARITY) * F.greatest(x, y)


def _compare(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, bags: DataFrame | None = None) -> DataFrame:
    """The pairs (a, b) that are similar, written."""
    near = stage(_agreeing(pairs, sketches), "dart-pairs")
    if near.isEmpty():
        return near
    if bags is None:
        bags = stage(_bags(docs, sketches, near.select(F.explode(F.array("a", "b")).alias("name")).distinct()), "dart-bags")
    return stage(_confirmed(near, bags), "dart-links")


def _picked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def _names(docs: DataFrame) -> DataFrame:
    """``doc_id, name`` of each row; null name: no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [name_of(words_of(t)) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.binary())], ["doc_id", "name"])

    return map_batches(docs, run, "doc_id long, name binary")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, class_id, class_rows`` of every row: class_id is the least
    doc_id of its class (weighted similarity of shingles 0.8 or more, and all
    linked by such), class_rows the number of its rows.

    Texts with the same words (case and white space aside) are one node, so
    copies cost no comparison. Null texts and texts without words are in no
    class: class_id is their own id, class_rows 1. A null id counts as greater
    than all others; repeated rows are in one class; an empty table gives no
    rows; other columns are not read."""
    docs = _picked(docs, doc_id, text)
    sketches, classes = word_classes(docs)
    rooted = (sketches.select("name", "least", "copies").join(classes, F.col("name") == F.col("node"), "left")
              .select("name", F.coalesce("root", "name").alias("root"), "least", "copies"))
    sums = rooted.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_rows"))
    by_name = rooted.join(sums, "root").select("name", "class_id", "class_rows")
    return (_names(docs).join(by_name, "name", "left")
            .select("doc_id", F.when(F.col("class_rows").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("class_rows", F.lit(1)).cast("long").alias("class_rows")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each class: the one
    with the least id (of several with it, that whose words come first; of
    equal rows, any). Rows without words all stay."""
    picked = _picked(docs, doc_id, text)
    sketches, classes = word_classes(picked)
    best = (sketches.join(classes, F.col("name") == F.col("node"), "left")
            .groupBy(F.coalesce("root", "name").alias("root"))
            .agg(F.min(F.struct(F.col("least").isNull(), F.col("least"), F.col("name"))).alias("best"))
            .select(F.col("best.name").alias("__tw_best"), F.col("best.least").alias("__tw_least")))
    wordless = F.coalesce(F.col(text), F.lit("")).rlike("[^\\x20\\x09-\\x0D]") == F.lit(False)
    row = docs.where(~wordless).select(F.struct("*").alias("__tw_row"))
    fields = ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [name_of(words_of(t)) for t in batch.column(0).field(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.binary())], ["__tw_row", "__tw_name"])

    named = map_batches(row, run, f"__tw_row struct<{fields}>, __tw_name binary")
    named = named.withColumn("__tw_id", F.col("__tw_row")[doc_id].cast("long"))
    chosen = named.join(best, (F.col("__tw_name") == F.col("__tw_best")) & F.col("__tw_id").eqNullSafe(F.col("__tw_least")))
    chosen = chosen.groupBy("__tw_name", "__tw_id").agg(F.first("__tw_row").alias("__tw_row"))
    return docs.where(wordless).unionByName(chosen.select("__tw_row.*"))
