"""Operators 5, 7 and 8 and the statistics that they rest on."""
import math
import random
from collections import Counter
from zlib import crc32

import numpy as np

from tests.llm.helpers import SF_MID, SF_SMALL, no_docs, odd_docs
from tidewater.llm import quality_net, registry, suffix_tree, url_trees


def plain_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    cut = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:cut]


def plain_rule(host, path):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?y=1", "http://example.net/EN/", "http://x.net", "http://x.net?q/",
        "https://netz/", "http://ÄB.org/fr/é#x", "http://a.b://c.org/fr/", "http://org/fr/", "http://example.com/de", "://net/x", "http://xexample.com/de/"]


def test_op5_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(URLS)], "page_id long, url string, host string, score int")
    got = {r["page_id"]: r for r in url_trees.judge(pages, registry.URL_RULES).collect()}
    for i, u in enumerate(URLS):
        host, path = plain_parts(u)
        rule, verdict = plain_rule(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert got[i]["verdict"] == verdict or verdict is None and got[i]["verdict"] in ("allow", "block")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_trees.judge(empty, registry.URL_RULES).count() == 0
    assert {r["verdict"] for r in url_trees.judge(pages, []).collect()} == {"allow"}


def test_op5_query(spark):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()}
    got = registry.op5_url_trees(spark, SF_MID).collect()
    assert len(got) == len(pages)
    for r in got:
        host, path = plain_parts(pages[r["page_id"]])
        rule, verdict = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and (verdict in (None, r["verdict"]))


def test_op5_trees_learn_from_labelled_urls(spark):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    rows = []
    for i in range(600):
        if i % 2:
            rows.append((i, f"http://{word(4)}.com/{word(6)}/{word(7)}.html", 0))
        else:
            rows.append((i, f"http://{word(9)}-{rng.randint(1000, 99999)}.com/{word(3)}?a={rng.randint(1, 9**9)}&b={word(20)}&c=1", 1))
    feats = url_trees.with_features(url_trees.with_parts(spark.createDataFrame(rows, "id long, url string, y int")))
    model = url_trees.train(feats.where("id < 400"), "y")
    scored = model.transform(url_trees._assembled(feats.where("id >= 400"))).select("y", "prediction").collect()
    assert sum(r["y"] == r["prediction"] for r in scored) >= 0.97 * len(scored)


def test_op5_entropy(spark):
    from pyspark.sql import functions as F

    got = [r[0] for r in spark.createDataFrame([("aabb",), ("abcd",), ("",), ("AAAA",)], "u string").select(url_trees.entropy(F.col("u"))).collect()]
    assert np.allclose(got, [1, 2, 0, 0])


def test_op7_query_on_held_out_labels(spark):
    got = {r["doc_id"]: r for r in registry.op7_quality_net(spark, SF_MID).collect()}
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").collect()
    for d, r in got.items():
        assert r["held_out"] == (crc32(str(d).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    held = [(got[x["doc_id"]]["predicted"], x["quality"]) for x in labels if got[x["doc_id"]]["held_out"]]
    assert sum(p == q for p, q in held) >= 0.93 * len(held)


def test_op7_word_vectors_are_sums_of_neighbours(spark):
    rows_of = quality_net.Rows()
    base = quality_net.index_vectors()
    assert (np.abs(base).sum(1) == quality_net.NONZERO).all()
    assert 0 in quality_net.word_rows("SHOUT!!") and len(quality_net.word_rows("SHOUT!!")) == 3
    text = "one two three two one"
    rows = rows_of(text)
    want = np.zeros_like(base)
    for i, r in enumerate(rows):
        for j in range(max(0, i - 2), min(len(rows), i + 3)):
            if j != i:
                want[r] += base[rows[j]]
    docs = spark.createDataFrame([(1, text), (2, "alone"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    model = quality_net.train(docs, labels)  # too few for a network: constant
    assert len({r["score"] for r in quality_net.score(docs, model).collect()}) == 1
    many = spark.createDataFrame([(i, text if i % 2 else "$$ ## two") for i in range(40)], "doc_id long, text string")
    y = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None)], "doc_id long, quality int")
    fitted = quality_net.train(many, y)
    other = rows_of("$$ ## two")
    for i, r in enumerate(other):
        for j in range(max(0, i - 2), min(len(other), i + 3)):
            if j != i:
                want[r] += base[other[j]]  # as often as the first text
    norm = np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(fitted.vectors, want / np.where(norm > 0, norm, 1) + base / quality_net.NONZERO**0.5, atol=1e-5)
    p = {r["doc_id"]: r["score"] for r in quality_net.score(many, fitted).collect()}
    assert min(p[i] for i in p if i % 2) > max(p[i] for i in p if not i % 2)


def test_op7_temperature():
    rng = np.random.default_rng(1)
    z = rng.normal(0, 2, 20000)
    y = (rng.random(20000) < 1 / (1 + np.exp(-z))).astype(float)
    assert abs(quality_net.fit_temperature(3 * z, y) - 3) < 0.3


def test_op7_on_odd_rows(spark):
    model = quality_net.train(odd_docs(spark), spark.createDataFrame([], "doc_id long, quality int"))
    got = quality_net.score(odd_docs(spark), model)
    assert got.count() == odd_docs(spark).count() and got.where("score is null").count() == 0
    assert quality_net.score(no_docs(spark), model).count() == 0
    kept = quality_net.keep_good(odd_docs(spark), model)
    assert sorted(map(str, kept.collect())) == sorted(map(str, odd_docs(spark).collect()))
    assert quality_net.train(no_docs(spark), no_docs(spark).selectExpr("doc_id", "1 as quality")) is not None


def plain_words(text):
    return (text or "").encode().lower().split()


def plain_base(rows, held=1):
    train = [plain_words(t) for d, t in rows if crc32(("" if d is None else str(d)).encode()) % 5 != held]
    c = Counter(w for d in train for w in [*d, b"\n"])
    n, v = sum(c.values()), len(c)
    out = []
    for d, t in rows:
        w = [*plain_words(t), b"\n"]
        out.append((d, crc32(("" if d is None else str(d)).encode()) % 5 == held, len(w), sum(c[x] > 0 for x in w), n,
                    sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)))
    return out


def _same_base(got, rows):
    key = lambda r: (str(r[0]), r[2], r[5])
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key)
    for a, b in zip(got, sorted(plain_base(rows), key=key), strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) <= 1e-9 * max(1, abs(b[5]))


def test_op8_base_scores(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    monkeypatch.setattr(suffix_tree, "HEAD_WORDS", 50)  # most words then take the joined way
    _same_base(suffix_tree.score(docs).collect(), rows)
    monkeypatch.undo()
    _same_base(registry.op8_suffix_tree(spark, SF_SMALL).collect(), rows)


def test_op8_on_odd_rows(spark):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs(spark).collect()]
    _same_base(suffix_tree.score(odd_docs(spark)).collect(), rows)
    assert suffix_tree.score(no_docs(spark)).count() == 0
    held = spark.createDataFrame([(i, "a b") for i in range(40)], "doc_id long, text string").where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 1")
    got = suffix_tree.score(held).collect()
    assert got and all(r["train_tokens"] == 0 and r["base_score"] == 0 and r["score"] < 0 for r in got)


def plain_tree_score(train, doc):
    """Next-symbol counts by context as dictionaries, and the longest suffix in
    the tree looked up symbol by symbol."""
    depth, classes, symbols = suffix_tree.DEPTH, suffix_tree.CLASSES, suffix_tree.SYMBOLS
    count = [Counter() for _ in range(depth + 1)]
    single = Counter()

    def steps(words):
        data = b" ".join(words) + b"\n"
        s = [0] * depth + [int(classes[x]) for x in data]
        return [(tuple(s[i : i + depth]), s[i + depth], data[i]) for i in range(len(data))]

    for words in train:
        for ctx, x, byte in steps(words):
            single[byte] += 1
            for k in range(depth + 1):
                count[k][ctx[depth - k :], x] += 1
    total = [Counter() for _ in count]
    for k, c in enumerate(count):
        for (ctx, _), n in c.items():
            total[k][ctx] += n

    def p(ctx, x):
        if not ctx:
            return (count[0][(), x] + 0.5) / (total[0][()] + 0.5 * symbols)
        return (count[len(ctx)][ctx, x] + suffix_tree.SMOOTH * p(ctx[1:], x)) / (total[len(ctx)][ctx] + suffix_tree.SMOOTH)

    kept = {()}
    for k in range(depth, 0, -1):
        for ctx, n in total[k].items():
            stat = 2 * sum(count[k][ctx, x] * math.log(count[k][ctx, x] / n / p(ctx[1:], x)) for x in range(symbols) if count[k][ctx, x])
            if stat >= suffix_tree.DIVERGENCE:
                kept.update(ctx[i:] for i in range(k))
    out = 0.0
    legal = [b for b in range(256) if not (b < 10 or 11 <= b < 14 or 65 <= b < 91)]
    for ctx, x, byte in steps(doc):
        state = next(ctx[i:] for i in range(depth + 1) if ctx[i:] in kept)
        share = (single[byte] + 0.5) / sum(single[b] + 0.5 for b in legal if classes[b] == x)
        out += math.log10(p(state, x) * share)
    return out


def test_op8_suffix_tree_against_dictionaries(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(1000, "É1 x"), (1001, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    train = [plain_words(t) for d, t in rows if crc32(str(d).encode()) % 5 != 1]
    got = {r["doc_id"]: r["score"] for r in suffix_tree.score(docs).collect()}
    for d, t in rows[:5] + rows[-2:]:
        assert abs(got[d] - plain_tree_score(train, plain_words(t))) < 1e-6 * max(1, abs(got[d]))


def test_op8_probabilities_sum_to_one():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 50, suffix_tree.STATES * suffix_tree.SYMBOLS) * (rng.random(suffix_tree.STATES * suffix_tree.SYMBOLS) < 0.1)
    tree = suffix_tree.Tree(counts, rng.integers(0, 9, 256).astype(float))
    assert np.allclose((10 ** tree.logp).reshape(-1, suffix_tree.SYMBOLS).sum(1), 1)
    legal = np.array([not (b < 10 or 11 <= b < 14 or 65 <= b < 91) for b in range(256)])
    assert np.allclose(np.bincount(suffix_tree.CLASSES[legal], 10 ** tree.share[legal]), 1)


def test_op8_contexts_are_bytes_and_grow_with_the_text(spark, monkeypatch):
    """Other scripts get contexts of their own, of more than three symbols, and
    the joined way gives what the broadcast one does."""
    rows = [(i, "мама мыла раму жук ест лук" if i % 2 else "кот спит + a<=b (c) [d]") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    train = [plain_words(t) for d, t in rows if crc32(str(d).encode()) % 5 != 1]
    got = {r["doc_id"]: r["score"] for r in suffix_tree.score(docs).collect()}
    for d, t in rows[:2]:
        assert abs(got[d] - plain_tree_score(train, plain_words(t))) < 1e-6 * abs(got[d])
        assert got[d] > -0.25 * len(t.encode())  # the contexts nearly fix the next byte
    monkeypatch.setattr(suffix_tree, "HEAD_CODES", 3)
    few = {r["doc_id"]: r["score"] for r in suffix_tree.score(docs).collect()}
    assert all(abs(few[d] - got[d]) < 1e-9 * abs(got[d]) for d in got)
    stats = suffix_tree.gather(docs.selectExpr("doc_id % 2 = 0 as held_out", "cast(text as binary) text")).where("code is not null")
    assert stats.count() > 40 and stats.where("n = 0").count() > 0


def test_op8_head_is_cut_by_a_histogram(spark):
    rows = [(n,) for n in [1] * 500 + [2] * 60 + [3] * 30 + [7, 8, 100, 1000, 0]]
    counts = spark.createDataFrame(rows, "n long")
    for most, want in [(0, 2**63 - 1), (1, 1000), (3, 8), (4, 7), (33, 7), (34, 3), (94, 2), (593, 2), (594, 1), (10_000, 1)]:
        least = suffix_tree.least_of_head(counts, "n", most)
        assert least == want and sum(n >= least for (n,) in rows) <= most
    assert suffix_tree.least_of_head(counts.where("n < 0"), "n", 5) == 2**63 - 1
