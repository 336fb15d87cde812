"""URL filter (operator 5): rules first, else gradient-boosted trees on
lexical features, trained from the URLs that rules label."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "hyphens", "entropy",
            "parameters", "parameter_length", "has_fragment", "has_extension", "suffix_length", "suffix_share",
            "suffix_hosts"]
#: Rules are compiled into one expression, so their number is bounded.
MAX_RULES = 1000
#: About how many labelled URLs the trees are fitted on at most.
MAX_TRAIN_URLS = 200_000
LEAST_OF_LABEL = 1000
SAMPLE_PARTITIONS = 6


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rule(text: str, verdict: str) -> Rule:
    host, _, path = text.partition("/")
    return Rule(host, "/" + path, verdict)


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``: after the first ``://`` up to ``/ ? #`` or the
    end, A-Z lower-cased; then up to ``? #`` or the end. Null, or no ``://``:
    both empty."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    return (df.withColumn("__tw_rest", rest)
            .withColumn("host", F.translate(F.regexp_extract("__tw_rest", "^[^/?#]*", 0), UPPER, LOWER))
            .withColumn("path", F.regexp_extract("__tw_rest", "^[^/?#]*([^?#]*)", 1)).drop("__tw_rest"))


def rule_for(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none. Of equally
    long ones the first in alphabetical order counts."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES}")
    name = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text, r.verdict)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, r.text) if name is None else name.when(fits, r.text)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def _count(text: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{chars}]+", ""))


def entropy(text: Column) -> Column:
    """Bits per character, over the signs a-z, 0-9 and the rest as one."""
    n = F.length(text)
    low = F.translate(text, UPPER, LOWER)
    out = F.lit(0.0)
    for c in [*LOWER, *"0123456789./-_", None]:
        k = n - F.length(F.translate(low, c, "")) if c else F.length(F.regexp_replace(low, "[a-z0-9./_-]+", ""))
        out = out + F.when(k > 0, -(k / n) * F.log2(k / n)).otherwise(0.0)
    return out


def suffix_of(host: Column) -> Column:
    """The host's last label."""
    return F.substring_index(host, ".", -1)


def with_features(df: DataFrame, url: str = "url") -> DataFrame:
    """Add the lexical features to rows that have ``host`` and ``path``. Suffix
    statistics cover all rows: the share of URLs with the host's last label and
    how many hosts there are with it (logarithms). A suffix may hold a third of
    all rows: its counts are added up before the shuffle, the table of suffixes
    is joined back by Spark's own choice."""
    u = F.coalesce(F.col(url), F.lit(""))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    host, path = F.col("host"), F.col("path")
    hosts = df.groupBy("host").agg(F.count("*").alias("n"))
    stats = (hosts.groupBy(suffix_of(host).alias("__tw_suffix"))
             .agg(F.sum("n").alias("__tw_urls"), F.count("*").alias("__tw_hosts")))
    total = hosts.agg(F.sum("n").alias("n")).first()["n"] or 1
    return (df.withColumn("url_length", F.length(u)).withColumn("host_length", F.length(host)).withColumn("path_length", F.length(path))
            .withColumn("depth", _count(path, "/")).withColumn("labels", _count(host, "."))
            .withColumn("digit_ratio", _count(u, "0-9") / F.greatest(F.length(u), F.lit(1)))
            .withColumn("hyphens", _count(u, "-")).withColumn("entropy", entropy(u))
            .withColumn("parameters", F.when(query == "", 0).otherwise(_count(query, "&") + 1))
            .withColumn("parameter_length", F.length(query)).withColumn("has_fragment", u.contains("#").cast("int"))
            .withColumn("has_extension", path.rlike(r"\.[A-Za-z0-9]{1,5}$").cast("int"))
            .withColumn("suffix_length", F.length(suffix_of(host))).withColumn("__tw_suffix", suffix_of(host))
            .join(stats, "__tw_suffix", "left")
            .withColumn("suffix_share", F.log1p(F.col("__tw_urls") / F.lit(total) * 1000))
            .withColumn("suffix_hosts", F.log1p("__tw_hosts"))
            .drop("__tw_suffix", "__tw_urls", "__tw_hosts"))


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="__tw_x", handleInvalid="keep").transform(df)


def sampled(labelled: DataFrame, label: str, found: dict[int, int], max_urls: int, key: str = "page_id") -> DataFrame:
    """About ``max_urls`` of the rows, each label (``found``: its rows) by the
    same share, but at least about ``LEAST_OF_LABEL`` of it or all. Rows are
    drawn by a hash of ``key`` too, so copies of a URL are not in or out
    together."""
    total = sum(found.values())
    draw = F.pmod(F.xxhash64(key, "host", "path", *FEATURES), F.lit(1 << 20))
    keep = F.lit(False)
    for value, n in found.items():
        share = min(1.0, max(max_urls / total, LEAST_OF_LABEL / n))
        keep = keep | ((F.col(label) == value) & (draw < int(share * (1 << 20))))
    return labelled.where(keep)


def train(labelled: DataFrame, label: str, max_urls: int = MAX_TRAIN_URLS, trees: int = 20, depth: int = 4,
          seed: int = 7, key: str = "page_id") -> GBTClassificationModel | float:
    """Trees for rows with features and a 0/1 column ``label`` (1: block), from
    about ``max_urls`` of them, chosen row by row (see ``sampled``). With labels
    of one class, or none, the share of label 1 (0 for none) instead."""
    found = {r[0]: r[1] for r in labelled.groupBy(label).count().collect()}
    n = sum(found.values())
    if len(found) < 2:
        return float(next(iter(found), 0))
    some = labelled if n <= max_urls else sampled(labelled, label, found, max_urls, key)
    gbt = GBTClassifier(featuresCol="__tw_x", labelCol="__tw_y", maxIter=trees, maxDepth=depth, seed=seed, stepSize=0.2, cacheNodeIds=False)
    # a bounded sample that each of the many small jobs reads again: staged, in few partitions
    sample = stage(some.select(F.col(label).cast("double").alias("__tw_y"), *FEATURES), "url-sample").coalesce(SAMPLE_PARTITIONS)
    return gbt.fit(_assembled(sample).select("__tw_x", "__tw_y"))


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", page_id: str = "page_id", threshold: float = 0.5) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row: the verdict
    of the longest rule that fits, else of the trees (block from ``threshold``
    up); score is the trees' probability of block.

    Null URLs and URLs without ``://`` have empty host and path, fit no rule and
    are judged by the trees; null and repeated ids stay, a row each; an empty
    table gives no rows; with rules of one verdict, or none that fits, that
    verdict (allow for none) is given to all; other columns are not read."""
    parts = with_parts(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")))
    rule, verdict = rule_for(rules, F.col("host"), F.col("path"))
    rows = with_features(parts.withColumn("rule", rule).withColumn("ruled", verdict))
    model = train(rows.where(F.col("ruled").isNotNull()).withColumn("__tw_block", (F.col("ruled") == "block").cast("int")), "__tw_block")
    if isinstance(model, float):
        scored = rows.withColumn("score", F.lit(model))
    else:
        scored = model.transform(_assembled(rows)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("ruled", F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"), "score")
