"""Operators 6 and 9, components, and the pipeline."""
import random
import time
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import SF_MID, SF_SMALL, no_docs, odd_docs
from tidewater.llm import dart_minhash, registry, tiling
from tidewater.llm.components import components


def plain_tiles(a, b, width):
    """Greedy tiling straight from its definition: look for the longest match
    of unmarked words, mark it, start again."""
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < width:
            return out
        out.append(best)
        free_a[i : i + n] = [False] * n
        free_b[j : j + n] = [False] * n


def test_op6_tiles_equal_the_definition():
    rng = random.Random(6)
    for _ in range(150):
        a = [rng.choice("abc") * rng.randint(1, 2) for _ in range(rng.randint(1, 25))]
        b = [rng.choice("abc") * rng.randint(1, 2) for _ in range(rng.randint(0, 40))]
        cut = rng.randint(0, len(a))
        b = b[:10] + a[cut:] + b[10:] + a[:cut]
        block = tiling.Block([(7, " ".join(a))], 5)
        ids = np.array([block.vocab.get(w, -1) for w in b], np.int64)
        got = list(block.tilings([ids[:0], ids]))
        width = min(5, len(a))
        want = plain_tiles(a, b, width)
        assert sorted(t[0] for _, _, _, tiles in got for t in tiles) == sorted(t[0] for t in want)
        if want:
            assert got[0][:2] == (1, 7) and abs(got[0][2] - sum(t[0] for t in want) / len(a)) < 1e-9


def test_op6_prints_give_the_same_tiles():
    rng = random.Random(16)
    for n in range(200):
        a = [rng.choice("abc"[: 1 + n % 3]) for _ in range(rng.randint(1, 30))]
        b = a[rng.randint(0, len(a)) :] + [rng.choice("abc"[: 1 + n % 3]) for _ in range(rng.randint(0, 40))]
        x, y = (np.array([ord(w) - 97 for w in t], np.int64) for t in (a, b))
        width = rng.randint(1, min(5, len(a)))
        assert tiling.tile_by_prints(x, y, width) == plain_tiles(a, b, width)
    assert tiling.tile_by_prints(np.array([-1, 0, 1]), np.array([], np.int64), 1) == []


def test_op6_repeats_cost_no_pair_of_places():
    """A word, a phrase and two words by chance, over and over, in 20,000 words."""
    rng = random.Random(26)
    cases = [("a " * 2000, "a " * 20000, [2000]), ("p q r s t u " * 400, "x " + "p q r s t u " * 3300, [2400]),
             (" ".join(rng.choice("ab") for _ in range(2000)), " ".join(rng.choice("ab") for _ in range(20000)), None)]
    for item, text, lengths in cases:
        block = tiling.Block([(1, item)], 5)
        ids = np.array([block.vocab.get(w, -1) for w in tiling.words_of(text)], np.int64)
        tracemalloc.start()
        start = time.process_time()
        ((_, _, coverage, tiles),) = block.tilings([ids])
        spent, peak = time.process_time() - start, tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert spent < 20 and peak < 100e6
        assert lengths is None or [t[0] for t in tiles] == lengths
        assert coverage == sum(t[0] for t in tiles) / len(item.split())


def test_op6_query_finds_what_holds_a_text(spark):
    docs = {r["doc_id"]: " ".join(tiling.words_of(r["text"])) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    items = {r["item_id"]: " ".join(tiling.words_of(r["text"])) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()}
    whole = {(d, i) for d, t in docs.items() for i, x in items.items() if f" {x} " in f" {t} "}
    got = {(r["doc_id"], r["item_id"]): r for r in registry.op6_tiling(spark, SF_MID).collect()}
    assert whole and whole <= got.keys()
    assert all(got[k]["coverage"] == 1 and got[k]["n_tiles"] == 1 for k in whole)


def test_op6_reordered_short_and_odd_rows(spark, monkeypatch):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    w = item.split()
    bench = spark.createDataFrame([(1, item), (2, "Two words!"), (3, None), (4, "..."), (None, "one lone text with no id")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x " + " ".join(w[6:]) + " y, " + " ".join(w[:6]).upper() + " z"), (2, "just two, WORDS here"), (3, None),
                                  (4, " ".join(w[:5])), (5, "one lone text with no id"), (None, item)], "doc_id long, text string")
    want = {(1, 1, 1.0, 2), (2, 2, 1.0, 1), (5, None, 1.0, 1), (None, 1, 1.0, 1)}
    rows = lambda: {(r["doc_id"], r["item_id"], r["coverage"], r["n_tiles"]) for r in tiling.find_overlaps(docs, bench).collect()}
    assert rows() == want
    monkeypatch.setattr(tiling, "BLOCK_CHARS", 20)  # a block for nearly each text
    assert rows() == want
    assert tiling.find_overlaps(odd_docs(spark), bench).count() == 0
    assert tiling.find_overlaps(no_docs(spark), bench).count() == 0
    assert tiling.find_overlaps(docs, bench.limit(0)).count() == 0
    left = tiling.drop_contaminated(odd_docs(spark), spark.createDataFrame([(1, "same id, other text")], "item_id long, text string"))
    assert left.count() == odd_docs(spark).count() - 1 and left.columns == odd_docs(spark).columns


def plain_bag(text):
    words = (text or "").lower().encode().split()
    width = min(5, len(words))
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else Counter()


def plain_classes(texts):
    bags = [plain_bag(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for i, b in enumerate(bags):
        for s in b:
            where.setdefault(s, []).append(i)
    pairs = {(i, j) for v in where.values() for i in v for j in v if i < j}
    for i, j in pairs:
        low = sum((bags[i] & bags[j]).values())
        if low >= 0.8 * (sum(bags[i].values()) + sum(bags[j].values()) - low):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(texts))]


def test_op9_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    elements = rng.integers(0, 2**63, 400, dtype=np.uint64)
    for _ in range(3):
        a, b = rng.integers(0, 6, 400).astype(float), rng.integers(0, 6, 400).astype(float)
        b[:250] = a[:250]
        a[300:] += 0.5
        sig = dart_minhash.signatures([(elements[a > 0], a[a > 0]), (elements[b > 0], b[b > 0])], k=4000)
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((sig[0] == sig[1]).mean() - want) < 0.04
    assert not dart_minhash.signatures([(elements[:0], np.empty(0))]).any()
    one = dart_minhash.signatures([(elements[:1], np.ones(1))])
    assert (one != 0).all()


def test_op9_query_equals_all_pairs(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect())
    want = plain_classes([t for _, t in docs])
    got = {r["doc_id"]: (r["class_id"], r["class_rows"]) for r in registry.op9_dart_minhash(spark, SF_MID).collect()}
    size = Counter(want)
    assert got == {d: (docs[c][0], size[c]) for (d, _), c in zip(docs, want)}


def test_op9_chains_through_a_bucket_are_not_lost(spark):
    """Copies that drift: neighbours are similar, far ones are not."""
    rng = random.Random(4)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(150)]
    texts = []
    for i in range(60):
        texts.append(" ".join(words))
        words[rng.randrange(150)] = f"n{i}"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = plain_classes(texts)
    got = [r["class_id"] for r in dart_minhash.near_duplicates(docs).orderBy("doc_id").collect()]
    assert got == want


def test_op9_many_texts_of_one_id_or_none(spark):
    """Candidates meet their own rows only: the fetch is linear in the rows."""
    rng = random.Random(9)
    rows = []
    for i in range(400):
        words = [f"w{rng.randint(0, 10**9)}" for _ in range(60)]
        near = [*words[:-1], "other"]
        rows += [(7 if i % 2 else None, " ".join(words)), (7 if i % 2 else None, " ".join(near))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sketches = dart_minhash.stage(dart_minhash._sketches(docs), "test-sketches")
    bags = dart_minhash._bags(docs, sketches, sketches.select("name"))
    assert bags.count() == 800
    joined = docs.join(sketches.select(F.col("at.doc_id").alias("i"), F.col("at.mark").alias("m")),
                       F.col("doc_id").eqNullSafe(F.col("i")) & (F.xxhash64("text") == F.col("m")))
    assert joined.count() == 800
    got = Counter((r["class_id"], r["class_rows"]) for r in dart_minhash.near_duplicates(docs).collect())
    assert got == Counter({(7, 2): 400, (None, 2): 400})


def test_op9_unlike_texts_of_one_bucket_are_not_paired(spark, monkeypatch):
    """A passage of two thirds in common: many share buckets, none is similar."""
    rng = random.Random(19)
    common = [f"c{i}" for i in range(160)]
    texts = [" ".join(common + [f"w{rng.randint(0, 10**9)}" for _ in range(80)]) for _ in range(1500)]
    texts.append(texts[0] + " more")
    tables = {}
    real = dart_minhash.stage

    def spy(df, label):
        out = real(df, label)
        tables.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(dart_minhash, "stage", spy)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["class_id"] for r in dart_minhash.near_duplicates(docs).orderBy("doc_id").collect()]
    assert got == [*range(1500), 0]
    members = tables["dart-buckets"][0]
    assert members > 1500 and max(tables["dart-owned"]) <= 100
    assert all(n <= members for label in tables for n in tables[label])


def test_op9_on_odd_rows(spark):
    got = dart_minhash.near_duplicates(odd_docs(spark)).collect()
    rows = Counter((r["doc_id"], r["class_id"], r["class_rows"]) for r in got)
    assert rows == Counter({(1, 1, 1): 1, (None, None, 1): 1, (2, 2, 1): 1, (3, 3, 1): 1, (4, 4, 3): 2, (4, 4, 1): 1, (5, 4, 3): 1,
                            (6, 6, 1): 1, (7, 7, 1): 1, (8, 8, 1): 1})
    assert dart_minhash.near_duplicates(no_docs(spark)).count() == 0
    kept = dart_minhash.keep_one(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, None, 2, 3, 4, 4, 6, 7, 8])
    assert dart_minhash.keep_one(no_docs(spark)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100), (200, 201), (201, 200)] + [(300, 300 + i) for i in range(1, 50)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 201: 200, **{300 + i: 300 for i in range(1, 50)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    for name, fn in corpus_pipeline.STAGES:
        out.append((name, docs, fn(spark, docs, SF_SMALL).cache()))
        docs = out[-1][2]
    return out


def test_pipeline_stages(spark, stages):
    assert [n for n, *_ in stages] == ["quality", "near_duplicates", "decontamination", "privacy", "tokens"]
    columns = spark.read.parquet(f"{SF_SMALL}/documents.parquet").columns
    for _, _, after in stages[:-1]:
        assert after.columns == columns
    by = {n: (before.collect(), after.collect()) for n, before, after in stages}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in by["quality"][1]}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.97 * len(good)
    before = sorted((r["doc_id"], r["text"]) for r in by["near_duplicates"][0])
    roots = plain_classes([t for _, t in before])
    assert {r["doc_id"] for r in by["near_duplicates"][1]} == {before[c][0] for c in roots}
    items = [" ".join(tiling.words_of(r["text"])) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert not any(x in " ".join(tiling.words_of(r["text"])) for r in by["decontamination"][1] for x in items)
    assert len(by["privacy"][0]) == len(by["privacy"][1]) == len(by["tokens"][1])
    assert not any("@" in w and "." in w.split("@")[1] for r in by["privacy"][1] for w in r["text"].split())


def test_pipeline_on_odd_rows(spark):
    docs = odd_docs(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for name, fn in corpus_pipeline.STAGES:
        for d in (docs, docs.limit(0)):
            out = fn(spark, d, SF_SMALL)
            assert out.count() >= 0
            if name != "tokens":
                assert out.columns == docs.columns


def test_op9_whole_weights_need_no_heights_of_darts(monkeypatch):
    """Below a weight of 1 and more lies the whole first region, so no height is hashed there."""
    import numpy as np

    mix, sizes = dart_minhash._mix, []
    monkeypatch.setattr(dart_minhash, "_mix", lambda x: sizes.append(len(x)) or mix(x))
    elements = np.arange(1, 301, dtype=np.uint64)
    whole = dart_minhash.signatures([(elements, np.ones(300))])
    hashed = sum(sizes)
    sizes.clear()
    part = dart_minhash.signatures([(elements, np.full(300, 0.999))])
    assert hashed < 0.85 * sum(sizes)
    assert (whole == part).mean() > 0.9
