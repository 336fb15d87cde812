"""Operators 2, 3 and 10 against plain Python over whole texts."""
import hashlib
import math
import re
from collections import Counter

from tests.llm.helpers import SF_MID, SF_SMALL, no_docs, odd_docs
from tidewater.llm import license_scan, ngram_ratio, private_spans, registry

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def base_of(text):
    text = text or ""
    words = SPACE.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if SPACE.search(x):
            dup += x in seen
            seen.add(x)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n)


COLS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_op2_query(spark):
    got = {r["doc_id"]: r for r in registry.op2_ngram_ratio(spark, SF_MID).collect()}
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    assert len(got) == len(docs)
    for d in docs:
        assert tuple(got[d["doc_id"]][c] for c in COLS) == base_of(d["text"])
    sound = [got[d] for d, q in labels.items() if q == 1 and not got[d]["base_failed"]]
    junk = [got[d] for d, q in labels.items() if q == 0 and not got[d]["base_failed"]]
    assert sum(r["kept"] for r in sound) >= 0.98 * len(sound)
    assert sum(r["kept"] for r in junk) <= 0.1 * len(junk)


def test_op2_ratio_is_that_of_the_counts(spark):
    docs = spark.createDataFrame([(1, "good plain words here"), (2, "bad $$$ words $$$"), (3, None)], "doc_id long, text string")
    trusted = spark.createDataFrame([(1,), (None,), (77,)], "doc_id long")
    ratio = ngram_ratio.fit_ratio(docs, trusted, buckets=1 << 10)
    rows = ngram_ratio.with_buckets(docs.where("text is not null"), "text", "b", 1 << 10).collect()
    raw, good = Counter(), Counter()
    for r in rows:
        raw.update(r["b"])
        if r["doc_id"] == 1:
            good.update(r["b"])
    assert len(rows[0]["b"]) == 7 and len(rows[1]["b"]) == 7
    for b, x in enumerate(ratio):
        want = math.log((good[b] + 1) / (sum(good.values()) + 1024)) - math.log((raw[b] + 1) / (sum(raw.values()) + 1024))
        assert abs(x - want) < 1e-12
    score = {r["doc_id"]: r["score"] for r in ngram_ratio.judge(docs, trusted, buckets=1 << 10).collect()}
    assert score[1] > score[2] and score[3] is None
    assert abs(score[2] - sum(ratio[b] for b in rows[1]["b"]) / 7) < 1e-12


def test_op2_on_odd_rows(spark):
    got = ngram_ratio.judge(odd_docs(spark), odd_docs(spark).select("doc_id"))
    want = sorted((str(r["doc_id"]), *base_of(r["text"])) for r in odd_docs(spark).collect())
    assert sorted((str(r["doc_id"]), *(r[c] for c in COLS)) for r in got.collect()) == want
    assert ngram_ratio.judge(no_docs(spark), no_docs(spark)).count() == 0


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                          ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


TRICKY = [
    "a@b.c-x%y@e.f a@b.c.d@e.f @x.y a@b a..b@c.d. é漢字🙂 z@q.w", "1.2.3.4.5 256.1.1.1 01.002.3.255 1.2.3 9.9.9.9999 0000255.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111 4111  1111", "+1 (555) 123-4567. +49 30 1234567890123 +1-2 ++33 1 23 45 67 89 +1 2345678 ",
    "a" * 3000 + "@" + "b." * 3000 + "c", "1" * 5000, "+" * 3000 + "1 ( ) 5", "1-" * 4000, "2." * 4000,
    "IBAN GB82 WEST 1234 5698 7654 32 and DE89370400440532013000, ssn 123-45-6789", "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"",
]


def test_op3_base_spans_equal_the_plain_patterns(spark):
    texts = TRICKY + [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in private_spans.find_private(docs).collect()}
    for i, t in enumerate(texts):
        want = base_spans(t)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        r = got[i]
        assert [x for x in r["spans"].split(",") if x.split(":")[0] in private_spans.BASE] == [x for x in listed.split(",") if x], t[:80]
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in private_spans.BASE] == [sum(x[0] == k for x in want) for k in private_spans.BASE]


def test_op3_checks_and_context(spark):
    texts = {1: "IBAN GB82 WEST 1234 5698 7654 32", 2: "GB82 WEST 1234 5698 7654 33", 3: "my ssn is 123-45-6789", 4: "order no 123-45-6789",
             5: "secret key 24be64439e3e49cf46b2d7c90f3602a3d0b907ff", 6: "commit 24be64439e3e49cf46b2d7c90f3602a3d0b907ff",
             7: "passport C01234567 issued", 8: "part C01234567"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kinds = {r["doc_id"]: {f["kind"] for f in r["found"]} for r in private_spans.find_private(docs).collect()}
    assert [("iban" in kinds[1]), ("iban" in kinds[2]), ("ssn" in kinds[3]), ("ssn" in kinds[4]), ("key" in kinds[5]), ("key" in kinds[6]),
            ("plate_id" in kinds[7]), ("plate_id" in kinds[8])] == [True, False, True, False, True, False, True, False]


def test_op3_on_odd_rows_and_redaction(spark):
    docs = odd_docs(spark)
    got = private_spans.find_private(docs)
    assert got.count() == docs.count()
    assert {r["base_sha256"] for r in got.where("doc_id in (1, 2, 3)").collect()} == {hashlib.sha256(b"").hexdigest()}
    assert private_spans.find_private(no_docs(spark)).count() == 0
    out = private_spans.redact(docs)
    assert out.schema == docs.schema or out.columns == docs.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[8]["text"].startswith("mail <EMAIL> and é漢字🙂 <IP> then\n\nLicensed") and rows[8]["n_chars"] == len(rows[8]["text"])
    assert rows[1]["text"] is None and rows[1]["n_chars"] is None
    same = docs.where("doc_id <> 8 or doc_id is null")
    assert sorted(map(str, out.where("doc_id <> 8 or doc_id is null").collect())) == sorted(map(str, same.collect()))


def test_op3_redaction_of_overlaps(spark):
    text = "x +4111 1111 1111 1111 y a@b.c"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert private_spans.redact(docs).collect()[0]["text"] == "x <CARD> y <EMAIL>" or private_spans.redact(docs).collect()[0]["text"] == "x +<CARD> y <EMAIL>"


def dice_rows(text):
    text = text or ""
    units = [("line", i, x) for i, x in enumerate(text.split("\n"))]
    units += [("paragraph", i, x) for i, x in enumerate(re.split("\n[ \t\r]*\n", text)) if "\n" in x]
    units += [("text", 0, text)] if "\n" in text else []
    for unit, no, x in units:
        a = set(license_scan.bigrams(license_scan.normalised(x)))
        for n, t in enumerate(license_scan.TEMPLATES):
            b = set(license_scan.bigrams(license_scan.normalised(t.text)))
            if a and 2 * len(a & b) / (len(a) + len(b)) >= license_scan.LEAST:
                yield unit, no, n, t.license_id, round(2 * len(a & b) / (len(a) + len(b)), 9)


def test_op10_query(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    want = sorted((d["doc_id"], *x) for d in docs for x in dice_rows(d["text"]))
    got = sorted((*r[:5], round(r["dice"], 9)) for r in registry.op10_license_scan(spark, SF_MID).collect())
    assert got == want and len(got) > 20


def test_op10_units_and_odd_rows(spark):
    mit = license_scan.TEMPLATES[2].text
    wrapped = "Intro line\n\n" + "\n".join(mit[i : i + 70] for i in range(0, len(mit), 70)) + "\n\nafter"
    docs = spark.createDataFrame([(1, wrapped), (2, mit.upper().replace(",", "")), (3, mit[:200])], "doc_id long, text string")
    rows = {(r["doc_id"], r["unit"], r["license_id"]) for r in license_scan.scan(docs).collect()}
    assert (1, "paragraph", "MIT") in rows and (2, "line", "MIT") in rows and not any(r[0] == 3 for r in rows)
    odd = license_scan.scan(odd_docs(spark)).collect()
    assert {(r["doc_id"], r["unit"], r["unit_no"], r["license_id"]) for r in odd} == {
        (8, "line", 2, "CC-BY-NC-4.0"), (8, "paragraph", 1, "CC-BY-NC-4.0")}
    assert license_scan.scan(no_docs(spark)).count() == 0
    assert license_scan.scan(docs, templates=[]).count() == 0
