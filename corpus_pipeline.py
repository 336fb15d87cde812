"""From raw documents to training data: five stages, each over all that the one
before it kept. Every stage but the last returns the columns of ``documents``
(``text`` and ``n_chars`` as they then are); each table is written as Parquet in
the shared folder and read again by the next stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import dart_minhash, prefix_bpe, private_spans, quality_net, tiling
from tidewater.llm.common import table
from tidewater.llm.registry import vocabulary
from tidewater.session import apply_defaults, stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. It is fitted on the
    labels of the documents at hand."""
    model = quality_net.train(docs, table(spark, sf_dir, "labels"))
    return quality_net.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return dart_minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark text go."""
    return tiling.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return private_spans.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, checked by decoding them."""
    import public_tokenizers

    return prefix_bpe.encode_decode(docs, vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("privacy", privacy), ("tokens", tokens)]

#: The classifier, the near-duplicate classes and the tilings have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    apply_defaults(spark)
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
