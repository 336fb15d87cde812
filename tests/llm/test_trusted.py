"""Operator 2: the target counts cover every trusted document."""
from tidewater.llm import ngram_ratio


def test_op2_no_trusted_document_is_left_out(spark):
    docs = spark.createDataFrame([(i, f"word{i} sign{i} $$") for i in range(40)], "doc_id long, text string")
    trusted = spark.range(400_000).selectExpr("id as doc_id")
    assert max(map(abs, ngram_ratio.fit_ratio(docs, trusted, buckets=1 << 10))) == 0


def test_op2_counts_are_exact_when_bits_collide(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i} sign{(i or 0) % 7} $$") for i in [*range(60), None, 3]], "doc_id long, text string")
    trusted = spark.range(0, 60, 3).selectExpr("id as doc_id")
    want = ngram_ratio.fit_ratio(docs, trusted, buckets=1 << 10)
    monkeypatch.setattr(ngram_ratio, "ID_BITS", 16)
    assert ngram_ratio.fit_ratio(docs, trusted, buckets=1 << 10) == want
    some = ngram_ratio.fit_ratio(docs.where("doc_id % 3 = 0"), trusted, buckets=1 << 10)
    assert max(map(abs, some)) == 0
