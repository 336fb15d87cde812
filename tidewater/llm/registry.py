"""The queries of this subpackage: each applies one operator, with production
parameters, to the whole of its table. ``corpus_pipeline.py`` at the top of the
repository is query ``pipeline``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (
    dart_minhash,
    license_scan,
    ngram_ratio,
    oracles,
    phrase_mining,
    prefix_bpe,
    private_spans,
    quality_net,
    sliced_search,
    stream_bpe,
    suffix_tree,
    tiling,
    token_output,
    url_trees,
)
from tidewater.llm.common import crc_bucket, table
from tidewater.session import apply_defaults

FOLDS = 5
URL_RULES = [url_trees.parse_rule("net/", "block"), url_trees.parse_rule("example.net/en/", "allow"),
             url_trees.parse_rule("example.com/de/", "block"), url_trees.parse_rule("org/fr/", "allow")]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.encode_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2)


def op2_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return ngram_ratio.judge(table(spark, sf_dir, "documents"), trusted)


def op3_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_spans.find_private(table(spark, sf_dir, "documents")).drop("found")


def op4_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return prefix_bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trees.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op6_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_net.train(docs, labels.where(crc_bucket(F.col("doc_id"), FOLDS) != 0))
    scored = quality_net.score(docs, model)
    return scored.select("doc_id", (crc_bucket(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"), FOLDS, 1)


def op9_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op11_sliced_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = sliced_search.Index(table(spark, sf_dir, "documents"))
    return sliced_search.search(index, table(spark, sf_dir, "benchmark"))


def op12_stream_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.mine(table(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_token_files, op2_ngram_ratio, op3_private_spans, op4_prefix_bpe, op5_url_trees, op6_tiling,
             op7_quality_net, op8_suffix_tree, op9_dart_minhash, op10_license_scan, op11_sliced_search, op12_stream_bpe, op13_phrase_mining]

    def prepared(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        return run

    return {fn.__name__: prepared(fn) for fn in found}


def llm_oracles() -> dict[str, str]:
    return {"op11_sliced_search": oracles.SLICED_SEARCH, "op13_phrase_mining": oracles.PHRASE_MINING}
