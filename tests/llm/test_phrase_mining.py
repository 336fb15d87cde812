import random
import re
from collections import Counter

import pytest

from tests.llm.helpers import SF_MID, no_docs, odd_docs
from tidewater.llm import phrase_mining, registry
from tidewater.llm.phrase_mining import OVERLAP, mine, parse, pieces

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, min_count, max_words=4, share=80, top=2000):
    counts = {}
    for lang, text in rows:
        f = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(words)):
                for k in range(1, max_words + 1):
                    if i + k <= len(words):
                        f[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in cand.items():
            held = any(100 * b >= share * a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
                       for q, b in cand.items() if len(q) > len(p))
            if not held:
                s, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-s, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_parse_gives_each_word_one_owner():
    rng = random.Random(3)
    for _ in range(300):
        words = [rng.choice(["a", "b", "c", "dd"]) for _ in range(rng.randint(1, 200))]
        chunks = list(parse(" ".join(words)))
        back = [w for c, last in chunks for w in (c.split(" ") if last else c.split(" ")[:-OVERLAP])]
        assert back == words and [last for _, last in chunks] == [False] * (len(chunks) - 1) + [True]
        for (c, _), (d, _) in zip(chunks, chunks[1:]):
            assert c.split(" ")[-OVERLAP:] == d.split(" ")[:OVERLAP]


def test_equal_passages_give_equal_chunks():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(400)]
    seen = [Counter(c for c, _ in parse(" ".join([word() for _ in range(70 + k)] + passage + [word() for _ in range(70)])))
            for k in range(3)]
    shared = seen[0] & seen[1] & seen[2]
    assert sum(len(c.split(" ")) for c in shared) > 300


def test_pieces_follow_the_contract():
    assert pieces("A b,\tC\td .\n\n;É a\x0bX") == ["a b", "c d", "É a", "x"]
    assert pieces(" . , a ,, b\t\t") == ["a", "b"] and pieces("  ") == []


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    vocab = ["new", "york", "The", "the", "city", "é", "of", "_", "x y", "in\tfact", "a,", "b.", "漢 字"]
    passage = " ".join(rng.choice(vocab) for _ in range(120)).replace(",", "").replace(".", "")
    rows = [(rng.choice(["en", "de", None, "und"]), " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 90)))) for _ in range(120)]
    rows += [("en", "so " * k + passage) for k in range(40)] + [("fr", None), (None, ""), ("fr", "new york " * 2000)]
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, text string")
    for top in (2000, 7):
        assert got(mine(docs, min_count=8, top=top)) == brute(rows, 8, top=top)


def test_a_filter_that_passes_everything_changes_nothing(spark, monkeypatch):
    rows = [("en", "the old man and the sea and the old man"), ("en", "the old man")] * 4
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, text string")
    want = brute(rows, 3)
    assert got(mine(docs, min_count=3)) == want
    monkeypatch.setattr(phrase_mining.PhraseFilter, "holds", lambda self, h: h == h)
    assert got(mine(docs, min_count=3)) == want


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("lang", "text").collect()]
    assert got(registry.llm_queries()["op13_phrase_mining"](spark, SF_MID)) == brute(rows, 30)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    assert got(mine(docs, min_count=2)) == brute(rows, 2)
    assert mine(no_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        mine(docs, max_words=5)
