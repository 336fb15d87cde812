"""Operator 7: word vectors are statistics of the whole corpus."""
import numpy as np

from tidewater.llm import quality_net


def test_op7_word_vectors_cover_texts_without_a_label(spark):
    texts = ["good plain words", "$$ ## bad"] * 20 + ["unseen glyphs travel unseen", None, "", "lone"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = quality_net.train(docs, spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, quality int"))
    rows_of, base = quality_net.Rows(), quality_net.index_vectors()
    want = np.zeros_like(base)
    for t in texts:
        rows = rows_of(t or "")
        for i, r in enumerate(rows):
            for j in range(max(0, i - quality_net.REACH), min(len(rows), i + quality_net.REACH + 1)):
                want[r] += base[rows[j]] if j != i else 0
    assert np.abs(want[rows_of("glyphs")]).sum() > 0
    norm = np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(model.vectors, want / np.where(norm > 0, norm, 1) + base / quality_net.NONZERO**0.5, atol=1e-5)


def test_op7_a_repeated_document_counts_once(spark):
    x = [[float(k)] * quality_net.DIM for k in range(3)]
    rows = spark.createDataFrame([(1, 1, x[0]), (1, 1, x[1]), (1, 1, x[2]), (2, 0, x[2])], "id long, y int, x array<double>")
    got = {r["id"]: (r["y"], r["x"]) for r in quality_net.by_id(rows).collect()}
    assert got == {1: (1, x[1]), 2: (0, x[2])}
