"""Texts with very many spans: places and redaction against a plain walk."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tidewater.llm import private_spans


@pytest.mark.parametrize("n", [1, 255, 256, 257, 512, 513, 1500])
def test_running_values_equal_a_loop(spark, n):
    v = [random.Random(n).randrange(-50, 50) for _ in range(n)]
    row = spark.createDataFrame([(v,)], "v array<int>").select(
        private_spans.running(F.col("v"), lambda a, b: a + b).alias("s"),
        private_spans.running(F.col("v"), lambda a, b: F.greatest(a, b)).alias("m")).first()
    assert row["s"] == [sum(v[: i + 1]) for i in range(n)] and row["m"] == [max(v[: i + 1]) for i in range(n)]


def test_parts_of_chunks_equal_slices(spark):
    text = "".join(random.Random(1).choice("aé🙂\n\r ") for _ in range(5 * 1024))
    cuts = [(0, 0), (0, 1024), (1023, 1025), (1024, 2048), (5, 5000), (5120, 5120), (5000, 5120), (1024, 1024), (4000, 4040)]
    rows = spark.createDataFrame([(text, a, b) for a, b in cuts], "t string, a int, b int").withColumn("c", private_spans.chunks_of(F.col("t")))
    for r in rows.withColumn("p", private_spans.part_of(F.col("c"), F.col("a"), F.col("b"))).collect():
        assert r["p"] == text[r["a"] : r["b"]], (r["a"], r["b"])


def redacted(text, spans):
    out, at = [], 0
    for start, end, kind in sorted(spans, key=lambda x: (x[0], -x[1], private_spans_order(x[2]))):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def private_spans_order(kind):
    return [k.name for k in private_spans.KINDS].index(kind)


def test_op3_long_texts_of_many_spans(spark):
    rng = random.Random(3)
    some = ["a@b.cd", "1.2.3.4", "+4111 1111 1111 1111", "+1 555 123 4567", "ssn 123-45-6789", "é🙂", "order 123-45-6789", "bank DE89370400440532013000",
            "words between", "\n", "x" * 1500]
    texts = [" ".join(rng.choice(some) for _ in range(n)) for n in (3, 700, 3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["found"] for r in private_spans.find_private(docs).collect()}
    new = {r["doc_id"]: r["text"] for r in private_spans.redact(docs).collect()}
    for i, t in enumerate(texts):
        for x in found[i]:
            if x["kind"] == "ssn":
                assert t[x["start"] : x["end"]] == "123-45-6789"
        assert [(x["start"], x["end"]) for x in found[i] if x["kind"] == "email"] == [
            (k, k + 6) for k in range(len(t)) if t.startswith("a@b.cd", k)]
        assert new[i] == redacted(t, [(x["start"], x["end"], x["kind"]) for x in found[i]])


def test_op3_time_a_span_does_not_grow(spark):
    took = []
    for n in (2_000, 20_000, 200_000):
        docs = spark.createDataFrame([(1, "a@b.cd ssn 123-45-6789 " * (n // 2))], "doc_id long, text string").coalesce(1)
        start = time.time()
        row = private_spans.find_private(docs).select(F.size("found").alias("n")).first()
        length = private_spans.redact(docs).select(F.length("text").alias("n")).first()
        took.append(time.time() - start)
        assert row["n"] == n and length["n"] == (n // 2) * len("<EMAIL> ssn <SSN> ")
    assert took[2] < 40 * max(took[1], 0.5), took
    print(took)
