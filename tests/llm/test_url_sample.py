"""Operator 5: what the trees are fitted on."""
import inspect

from tidewater.llm import url_trees


def test_op5_number_of_trees():
    assert inspect.signature(url_trees.train).parameters["trees"].default == 20


def test_op5_sample_is_drawn_by_row_and_label(spark, monkeypatch):
    rows = [(i, "http://hot.net/x", 1) for i in range(3900)] + [(9000 + i, "http://cold.com/y", 0) for i in range(100)]
    df = spark.createDataFrame(rows, "page_id long, url string, y int")
    feats = url_trees.with_features(url_trees.with_parts(df))
    monkeypatch.setattr(url_trees, "LEAST_OF_LABEL", 50)
    got = {r["y"]: r["count"] for r in url_trees.sampled(feats, "y", {1: 3900, 0: 100}, 400).groupBy("y").count().collect()}
    assert 300 < got[1] < 480 and 25 < got[0] < 75
