"""Quality rules (operator 2), DataFrame functions only.

Base rules on whole texts, then a log-likelihood ratio of hashed n-grams:
words and runs of signs, alone and in pairs, fall into a fixed number of
buckets; the ratio compares their shares in trusted documents with those in the
whole raw corpus. A document's score is the mean ratio of its n-grams, and one
fixed threshold judges every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import let
from tidewater.session import stage

BUCKETS = 1 << 14
#: Mean log ratio (natural) under which a document goes.
THRESHOLD = -0.25
#: Bits of the bitmap of trusted ids.
ID_BITS = 1 << 26
SPACE = "[\\x20\\x09-\\x0D]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def with_base(df: DataFrame, text: str = "__tw_text") -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and
    ``base_failed`` for a text column without nulls. All work stays in the row;
    windows that occur twice are found by sorting their hashes."""
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = df.withColumn("__tw_words", _words(F.col(text))).withColumn("__tw_lines", lines)
    df = df.withColumn("n_words", F.size("__tw_words").cast("long"))
    hashes = F.transform(F.slice("__tw_words", 1, F.greatest(F.size("__tw_words") - 2, F.lit(0))),
                         lambda x, i: F.xxhash64(x, F.get("__tw_words", i + 1), F.get("__tw_words", i + 2)))
    df = df.withColumn("__tw_hash", hashes)
    # (hash, place), sorted; only where some hash occurs twice
    df = df.withColumn("__tw_sorted", F.when(F.size(F.array_distinct("__tw_hash")) < F.size("__tw_hash"),
                                             F.sort_array(F.transform("__tw_hash", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    near = lambda x, k: F.get("__tw_sorted", k)["h"].eqNullSafe(x["h"])
    places = F.sort_array(F.filter(
        F.transform("__tw_sorted", lambda x, k: F.when(near(x, k - 1) | near(x, k + 1), x["i"])), lambda i: i.isNotNull()))
    df = df.withColumn("__tw_at", places)
    covered = F.aggregate(F.transform("__tw_at", lambda x, k: F.least(F.lit(3), F.get("__tw_at", k + 1) - x)), F.lit(0), lambda a, b: a + b)
    return (df.withColumn("word_chars", F.length(F.array_join("__tw_words", "")).cast("long"))
            .withColumn("n_symbols", F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"))
            .withColumn("n_dup_lines", (F.size("__tw_lines") - F.size(F.array_distinct("__tw_lines"))).cast("long"))
            .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .withColumn("base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))
            .drop("__tw_words", "__tw_lines", "__tw_hash", "__tw_sorted", "__tw_at"))


def with_buckets(df: DataFrame, text: str, out: str, buckets: int = BUCKETS) -> DataFrame:
    """Add the buckets of a text's n-grams: each word or run of signs, and each
    pair of neighbours."""
    bucket = lambda *c: F.pmod(F.xxhash64(*c), F.lit(buckets)).cast("int")

    def grams(pieces: Column) -> Column:
        one = F.transform(pieces, lambda x: bucket(x))
        first = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
        return F.concat(one, F.transform(first, lambda x, i: bucket(x, F.get(pieces, i + 1))))

    pieces = F.regexp_extract_all(F.lower(F.col(text)), F.lit("[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}\\s]+"), F.lit(0))
    return df.withColumn(out, let(pieces, grams))


def fit_ratio(docs: DataFrame, trusted_ids: DataFrame, doc_id: str = "doc_id", text: str = "text",
              buckets: int = BUCKETS) -> list[float]:
    """The log ratio of each bucket: its add-one share among the n-grams of the
    trusted rows over that among those of all rows, the same plan at every size.

    All rows are counted in one pass without a join of texts: a row counts as
    trusted if its id's bit is set in a bitmap of the trusted ids (``ID_BITS`` bits
    whatever their number). Ids that only share a bit with a trusted one are then
    found by a join of ids, and the counts of their rows, told by a bitmap of
    theirs and an exact join, are taken off again: the counts are exact, and texts
    are shuffled only where bits collide. Counts are added up before the shuffle;
    what comes back is a number per bucket."""
    marked = trusted_ids.select(F.col(doc_id).alias("__tw_id")).where("__tw_id is not null").distinct()
    rows = docs.select(F.col(doc_id).alias("__tw_id"), F.coalesce(F.col(text), F.lit("")).alias("__tw_text"))
    grams = lambda df: with_buckets(df, "__tw_text", "__tw_b", buckets)
    hit = grams(_with_hit(rows, marked)).select("__tw_hit", F.explode("__tw_b").alias("b"))
    counts = hit.groupBy("b").agg(F.count("*").alias("raw"), F.count_if("__tw_hit").alias("good")).collect()
    ids = rows.select("__tw_id").where("__tw_id is not null").distinct()
    alike = _with_hit(ids, marked).where("__tw_hit").select("__tw_id").join(marked, "__tw_id", "left_anti")
    alike = stage(alike, "ratio-collisions")
    few = _with_hit(rows, alike).where("__tw_hit").select("__tw_id", "__tw_text").join(alike, "__tw_id", "left_semi")
    off = {r["b"]: r["count"] for r in grams(few).select(F.explode("__tw_b").alias("b")).groupBy("b").count().collect()}
    return ratio_of({r["b"]: (r["good"] - off.get(r["b"], 0), r["raw"]) for r in counts}, buckets)


def _with_hit(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """``__tw_hit``: whether the bit of ``__tw_id`` is set in the bitmap of the ids
    of ``marked`` (at most ``ID_BITS / 8`` bytes, 8 MB, are broadcast)."""
    place = F.pmod(F.xxhash64(F.col("__tw_id").cast("string")), F.lit(ID_BITS))
    maps = (marked.withColumn("__tw_h", place).groupBy(F.bitmap_bucket_number("__tw_h").alias("__tw_map"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__tw_h")).alias("__tw_bits")))
    asked = (rows.withColumn("__tw_h", place).withColumn("__tw_map", F.bitmap_bucket_number("__tw_h"))
             .withColumn("__tw_at", F.bitmap_bit_position("__tw_h")).join(F.broadcast(maps), "__tw_map", "left"))
    byte = F.conv(F.hex(F.substring("__tw_bits", (F.col("__tw_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.col("__tw_id").isNotNull() & (F.expr("shiftright(__tw_byte, cast(__tw_at % 8 as int)) & 1") == 1)
    return asked.withColumn("__tw_byte", byte).withColumn("__tw_hit", F.coalesce(is_set, F.lit(False))).select(*rows.columns, "__tw_hit")


def ratio_of(counts: dict[int, tuple[int, int]], buckets: int) -> list[float]:
    from math import log

    good = sum(g for g, _ in counts.values()) + buckets
    raw = sum(r for _, r in counts.values()) + buckets
    return [log((counts.get(b, (0, 0))[0] + 1) / good) - log((counts.get(b, (0, 0))[1] + 1) / raw) for b in range(buckets)]


def judge(docs: DataFrame, trusted_ids: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id",
          text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``doc_id``, the base columns, ``base_failed``, ``score`` and ``kept`` of
    every row: kept if the base rules pass and the mean log ratio of the text's
    n-grams is at least ``threshold``.

    A null or empty text has no words: its base fails, its score is null. Null
    and repeated ids stay, a row each. Trusted ids that are null or unknown do
    nothing; with no trusted text at all every ratio is near 0 and the base rules
    alone decide. An empty table gives no rows; other columns are not read."""
    ratio = fit_ratio(docs, trusted_ids, doc_id, text, buckets)
    spark = docs.sparkSession
    weights = spark.createDataFrame([(ratio,)], "w array<double>").scalar()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__tw_text"))
    rows = with_buckets(with_base(rows), "__tw_text", "__tw_b", buckets)
    total = F.aggregate("__tw_b", F.lit(0.0), lambda a, b: a + F.get(F.col("__tw_w"), b))
    rows = rows.withColumn("__tw_w", weights).withColumn("score", F.when(F.size("__tw_b") > 0, total / F.size("__tw_b")))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score",
                       (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"))
