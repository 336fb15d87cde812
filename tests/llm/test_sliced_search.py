import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import SF_SMALL, no_docs, odd_docs
from tidewater.llm import registry, sliced_search
from tidewater.llm.sliced_search import Index, OpenBlock, Queries, Searcher, search, slices_of, terms_of, weight

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    """docs: (doc_id, text); items: (item_id, text)."""
    bags = [(d, Counter(plain_terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n_docs, total = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        query, found = Counter(plain_terms(text)), []
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in query if df[t]}
        for d, b, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // total
            s = sum(q * w[t] * ((10**9 * b[t]) // (1000 * b[t] + 12 * m)) for t, q in query.items() if b[t])
            if s > 0:
                found.append((-s, d is None, d or 0))
        out += [(item, rank, None if none else d, -s) for rank, (s, none, d) in enumerate(sorted(found)[:k], 1)]
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0, r[3])


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=key)


def random_docs(rng, n, vocab):
    return [(d, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 3, 20, 60, 400])))) for d in range(n)]


VOCAB = [f"w{int(1000 * x ** 3)}" for x in (i / 400 for i in range(400))] + ["The", "the", "É", "é", "漢字", "a-b", "x_y", "3.5"]


def test_terms_follow_the_contract():
    text = "Ab-C é漢\x7fÉx_1\x00Ω.9 "
    assert [t.decode() for t in terms_of(text.encode())] == plain_terms(text)


def block_of(docs):
    block, counts = OpenBlock(), []
    for d, t in docs:
        terms = terms_of(t.encode())
        tf = Counter(terms)
        hashes = np.array([sliced_search.xxhash.xxh64_intdigest(x) for x in tf], np.uint64)
        n = np.array(list(tf.values()))
        block.add(d, terms, hashes, n, sum(int((n >= x).sum()) for x in sliced_search.LEVELS))
        counts.append(tf)
    return block, counts


def test_signatures_never_miss_and_bounds_hold():
    rng = random.Random(4)
    docs = [(d, t) for d, t in random_docs(rng, 300, VOCAB) if t]
    block, counts = block_of(docs)
    n_slices, raw = block.signature()
    bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(n_slices, -1), axis=1)
    for d, tf in enumerate(counts):
        for t, n in tf.items():
            h = np.array([sliced_search.xxhash.xxh64_intdigest(t)], np.uint64)
            for level, least in enumerate(sliced_search.LEVELS):
                if n >= least:
                    assert all(bits[int(r[0]), d] for r in slices_of(h, level, n_slices))
    df = Counter(t for tf in counts for t in tf)
    total = sum(block.lengths)
    queries = Queries([(i, i, Counter(terms_of(docs[i][1].encode()))) for i in range(0, len(docs), 7)], df, len(docs))
    bounds = queries.bounds(n_slices, raw, np.array(block.lengths), len(docs), total)
    exact = np.array([[queries.score(i, tf, sliced_search.length_part(n, len(docs), total)) for tf, n in zip(counts, block.lengths)]
                      for i in range(len(queries.rows))])
    assert (bounds >= exact).all()
    assert bounds[exact > 0].sum() < 1.4 * exact.sum()


def test_bounds_leave_documents_out():
    rng = random.Random(6)
    docs = [(d, t) for d, t in random_docs(rng, 500, VOCAB) if t]
    block, counts = block_of(docs)
    df, total = Counter(t for tf in counts for t in tf), sum(block.lengths)
    queries = Queries([(i, i, Counter(terms_of(docs[i][1].encode()))) for i in range(0, 60)], df, len(docs))
    s = Searcher(queries, 5, len(docs), total)
    s.look(*block.signature(), block.ids, block.lengths, block.terms, {})
    assert 0 < s.rescored < 0.25 * len(docs) * len(queries.rows)


def test_weight_rounds_down():
    assert [weight(10, df) for df in (0, 1, 5, 10)] == [math.floor(1000 * math.log(22 / (2 * df + 1))) for df in (0, 1, 5, 10)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed, monkeypatch):
    rng = random.Random(seed)
    docs = random_docs(rng, 200, VOCAB) + [(7, "the the rare0 w0")] * 40 + [(None, "the w0 rare0"), (8, None)]
    items = [(i, " ".join(rng.choice(VOCAB) for _ in range(rng.randint(1, 40)))) for i in range(30)]
    items += [(30, "rare0"), (30, "rare0"), (31, None), (None, "the the"), (32, "nowhere"), (33, "")]
    monkeypatch.setattr(sliced_search, "PASS_CHARS", 1500)
    monkeypatch.setattr(sliced_search, "QUERIES", 4)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    i = spark.createDataFrame(items, "item_id long, text string")
    assert got(search(Index(d), i)) == sorted(brute(docs, items), key=key)
    assert got(search(Index(d), i, k=3)) == sorted(brute(docs, items, 3), key=key)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert got(registry.llm_queries()["op11_sliced_search"](spark, SF_SMALL)) == sorted(brute(docs, items), key=key)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    items = [(1, "word wort1 plain1"), (2, "null ID here é漢字🙂"), (3, "x" * 100_000)]
    i = spark.createDataFrame([(*r, 0.5, 1) for r in items], "item_id long, text string, score double, rank int")
    assert got(search(Index(docs), i)) == sorted(brute(rows, items), key=key)
    assert search(Index(no_docs(spark)), i).count() == 0
    assert search(Index(docs), i.where("item_id > 9")).count() == 0
