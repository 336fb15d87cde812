"""Governance on data: PII classification (G1-G4, G11, A8, O2), masking and
row policies (G5-G7, G9, F1), retention (G8), erasure (J8), lineage
reachability (G12), access anomalies (G10) and catalog reshape (M1, M2).

Everything runs as DataFrame jobs: classification is one aggregate pass per
table over all its string columns, masking is a projection, row policies are
filters, the token vault is a distinct, erasure is an anti join, lineage is a
frontier loop of joins with the lineage cut by checkpoints.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.hashing import salted_sha256, token_of
from tidewater.functions.regex import full_match_pattern
from tidewater.session import stage

# --------------------------------------------------------------------------
# The PII rule library (must equal the established rules).
# Each category: name, sensitivity, column-name patterns, optional value rule
# (regex that a whole value must match, minimum matching fraction).
# --------------------------------------------------------------------------

PII_CATEGORIES = [
    {"name": "email", "sensitivity": "PII",
     "patterns": ["(?i).*email.*", "(?i).*e_mail.*"],
     "sample_rule": {"regex": r"^[^@\s]+@[^@\s]+\.[^@\s]+$", "min_match_fraction": 0.7}},
    {"name": "ssn", "sensitivity": "PII",
     "patterns": ["(?i).*ssn.*", "(?i).*social_?security.*"],
     "sample_rule": {"regex": r"^\d{3}-?\d{2}-?\d{4}$", "min_match_fraction": 0.8}},
    {"name": "phone", "sensitivity": "PII",
     "patterns": ["(?i).*phone.*", "(?i).*mobile.*", "(?i).*tel(_?num)?.*"],
     "sample_rule": {"regex": r"^\+?\d[\d\s()-]{6,}$", "min_match_fraction": 0.7}},
    {"name": "full_name", "sensitivity": "PII",
     "patterns": ["(?i).*first_?name.*", "(?i).*last_?name.*", "(?i).*full_?name.*", "(?i)^name$"]},
    {"name": "address", "sensitivity": "PII",
     "patterns": ["(?i).*address.*", "(?i).*street.*", "(?i).*postal_?code.*", "(?i).*zip(_?code)?.*"]},
    {"name": "dob", "sensitivity": "PII",
     "patterns": ["(?i).*dob.*", "(?i).*date_?of_?birth.*", "(?i).*birth_?date.*"]},
    {"name": "mrn", "sensitivity": "PHI",
     "patterns": ["(?i).*mrn.*", "(?i).*medical_?record.*", "(?i).*patient_?id.*"]},
    {"name": "diagnosis", "sensitivity": "PHI",
     "patterns": ["(?i).*diagnos.*", r"(?i).*icd(_?\d+)?_?code.*"]},
    {"name": "credit_card", "sensitivity": "PCI",
     "patterns": ["(?i).*card_?num.*", "(?i).*credit_?card.*", "(?i).*pan$"],
     "sample_rule": {"regex": r"^\d{13,19}$", "min_match_fraction": 0.8}},
    {"name": "iban", "sensitivity": "PCI",
     "patterns": ["(?i).*iban.*"],
     "sample_rule": {"regex": r"^[A-Z]{2}\d{2}[A-Z0-9]{1,30}$", "min_match_fraction": 0.8}},
]
NAME_HIT_CONFIDENCE = 0.95

# Patterns for free text (G11), counted as non-overlapping matches. They are
# narrower than the value rules where a rule alone would match much ordinary
# text: an ssn needs its hyphens, an iban 11 signs and more after its check
# digits, a phone ends in a digit.
TEXT_SCAN_PATTERNS = {
    "email": r"[^@\s]+@[^@\s]+\.[^@\s]+",
    "ssn": r"\d{3}-\d{2}-\d{4}",
    "phone": r"\+?\d[\d\s()-]{6,}\d",
    "credit_card": r"\d{13,19}",
    "iban": r"[A-Z]{2}\d{2}[A-Z0-9]{11,30}",
}

BLANK = r"[ \t\n\r\f\x0B]*"
BLANK_CHARS = " \t\n\r\f\x0b"


def _rule_guard(tag: str, c: str) -> Column:
    """A cheap condition every full match of the category's value rule
    satisfies (required character or length range). Long free texts skip
    the regex; the rule itself stays the regex above."""
    col = F.col(c)
    if tag == "email":
        return col.contains("@")
    if tag == "ssn":
        return F.length(col).between(9, 11)
    if tag == "phone":
        return (F.length(col) >= 7) & F.substring(col, 1, 1).rlike("[+0-9]")
    if tag == "credit_card":
        return F.length(col).between(13, 19)
    if tag == "iban":
        return F.length(col).between(5, 34)
    return F.lit(True)


def _text_guard(tag: str, c: str) -> Column:
    """Same idea for the free-text search patterns."""
    col = F.col(c)
    if tag == "email":
        return col.contains("@")
    if tag == "ssn":
        return col.contains("-")
    if tag in ("phone", "credit_card"):
        return col.rlike("[0-9]")
    return F.lit(True)

CLASSIFICATION_SCHEMA = (
    "table_fqn string, column string, tag string, sensitivity string, confidence double, reason string"
)


def column_inventory(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_fqn, column, data_type, ordinal) from the tables' schemas."""
    rows = [
        (fqn, f.name, f.dataType.simpleString(), i + 1)
        for fqn, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, "table_fqn string, column string, data_type string, ordinal int")


def classify_by_name(columns: DataFrame, categories=PII_CATEGORIES) -> DataFrame:
    """A column is tagged when any pattern of a category finds a match.

    The rule library is compiled into one expression per row (no join): each
    category contributes ``when(any pattern matches, struct(tag, ...))`` and
    the hits are exploded.
    """
    hits = []
    for cat in categories:
        matched = None
        for p in cat["patterns"]:
            cond = F.col("column").rlike(p)
            matched = cond if matched is None else (matched | cond)
        hits.append(F.when(matched, F.struct(F.lit(cat["name"]).alias("tag"),
                                             F.lit(cat["sensitivity"]).alias("sensitivity"))))
    return columns.select("table_fqn", "column", F.explode(F.array_compact(F.array(*hits))).alias("h")).select(
        "table_fqn", "column", "h.tag", "h.sensitivity",
        F.lit(NAME_HIT_CONFIDENCE).alias("confidence"),
        F.concat(F.lit("column-name match: "), F.col("column")).alias("reason"),
    )


def _value_rules(categories=PII_CATEGORIES):
    return [(c["name"], c["sensitivity"], c["sample_rule"]) for c in categories if c.get("sample_rule")]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def filled_counts(df: DataFrame, table_fqn: str) -> DataFrame:
    """(table_fqn, column, filled_rows): the rows with a value, per column, in one pass."""
    counts = [F.count(F.col(f"`{c}`")).alias(f"n{j}") for j, c in enumerate(df.columns)]
    cells = [F.struct(F.lit(table_fqn).alias("table_fqn"), F.lit(c).alias("column"), F.col(f"n{j}").alias("filled_rows"))
             for j, c in enumerate(df.columns)]
    return df.agg(*counts).select(F.inline(F.array(*cells)))


def value_match_counts(df: DataFrame, table_fqn: str, columns: list[str] | None = None,
                       categories=PII_CATEGORIES, sample_fraction: float | None = None,
                       seed: int = 42, emit: list[tuple[str, str]] | None = None) -> DataFrame:
    """Per (column, category) the non-blank values and how many match.

    One aggregate pass over all string columns at once (no row blow-up). The
    default reads every value (exact, repeatable); ``sample_fraction`` reads a
    seeded Bernoulli sample instead. ``emit`` lists (table label, column)
    result rows when one scan serves several logical tables (e.g. a table and
    a view derived from it); each column is still counted once.
    """
    cols = columns or string_columns(df)
    emit = emit or [(table_fqn, c) for c in cols]
    cols = list(dict.fromkeys(cols + [c for _, c in emit]))
    src = df.select(*cols)
    if sample_fraction is not None:
        src = src.sample(fraction=sample_fraction, seed=seed)
    rules = _value_rules(categories)
    built_in = {tag: rule["regex"] for tag, _, rule in _value_rules(PII_CATEGORIES)}
    aggs, cells = [], []
    for j, c in enumerate(cols):
        nonblank = F.col(c).isNotNull() & (F.length(F.trim(F.col(c), F.lit(BLANK_CHARS))) > 0)
        aggs.append(F.sum(F.when(nonblank, 1).otherwise(0)).cast("long").alias(f"n{j}"))
        for k, (tag, sens, rule) in enumerate(rules):
            # a guard belongs to one regex; a caller's own rule has none
            guard = _rule_guard(tag, c) if rule["regex"] == built_in.get(tag) else F.lit(True)
            hit = nonblank & guard & F.col(c).rlike(full_match_pattern(rule["regex"]))
            aggs.append(F.sum(F.when(hit, 1).otherwise(0)).cast("long").alias(f"m{j}_{k}"))
    for label, c in emit:
        j = cols.index(c)
        for k, (tag, sens, rule) in enumerate(rules):
            cells.append(
                F.struct(
                    F.lit(label).alias("table_fqn"), F.lit(c).alias("column"), F.lit(tag).alias("tag"),
                    F.lit(sens).alias("sensitivity"), F.lit(float(rule["min_match_fraction"])).alias("threshold"),
                    F.col(f"m{j}_{k}").alias("matches"), F.col(f"n{j}").alias("nonblank"),
                )
            )
    if not cells:
        return df.sparkSession.createDataFrame(
            [], "table_fqn string, column string, tag string, sensitivity string, threshold double, "
                "matches long, nonblank long")
    return src.agg(*aggs).select(F.inline(F.array(*cells)))


def classify_by_values(counts: DataFrame) -> DataFrame:
    """Hit when matches / non-blank >= threshold; confidence = round(fraction, 2)."""
    m, n = F.col("matches"), F.col("nonblank")
    # round(m / n, 2) half-up, in integers (no binary-fraction surprises)
    num = m * 200 + n
    pct = ((num - F.pmod(num, 2 * n)) / (2 * n)).cast("long")
    need = F.round(F.col("threshold") * 100).cast("long")  # whole percent
    return counts.where((n > 0) & (m * 100 >= need * n)).select(
        "table_fqn", "column", "tag", "sensitivity",
        (pct.cast("double") / 100.0).alias("confidence"),
        F.format_string("%d/%d sample values matched", F.col("matches"), F.col("nonblank")).alias("reason"),
    )


def best_per_tag(name_hits: DataFrame, value_hits: DataFrame) -> DataFrame:
    """Highest confidence per (table, column, tag); a tie keeps the name hit."""
    both = name_hits.withColumn("_name_first", F.lit(1)).unionByName(value_hits.withColumn("_name_first", F.lit(0)))
    best = both.groupBy("table_fqn", "column", "tag").agg(
        F.max(F.struct("confidence", "_name_first", "sensitivity", "reason")).alias("b")
    )
    return best.select("table_fqn", "column", "tag", "b.sensitivity", "b.confidence", "b.reason")


def text_pii_scan(df: DataFrame, id_col: str, text_col: str, patterns=TEXT_SCAN_PATTERNS) -> DataFrame:
    """Per row, match counts of each category in a free-text column
    (whole texts); rows without any hit are dropped."""
    counts = [
        F.when(_text_guard(k, text_col) if p == TEXT_SCAN_PATTERNS.get(k) else F.lit(True), F.regexp_count(F.col(text_col), F.lit(p))).otherwise(F.lit(0))
        .cast("long").alias(f"{k}_hits")
        for k, p in patterns.items()
    ]
    out = df.select(id_col, *counts)
    any_hit = None
    for k in patterns:
        cond = F.col(f"{k}_hits") > 0
        any_hit = cond if any_hit is None else (any_hit | cond)
    return out.where(any_hit)


# --------------------------------------------------------------------------
# Policies: masking, row access, tokenization, de-identification
# --------------------------------------------------------------------------

MASKED = "<masked>"


class AccessDenied(PermissionError):
    pass


@dataclass
class AccessRule:
    role: str
    masking: str  # hash | tokenize | none
    condition: str | None = None


@dataclass
class DatasetPolicy:
    name: str
    sensitivity: str
    retention_days: int
    pii_columns: list[str]
    access: list[AccessRule] = field(default_factory=list)

    @classmethod
    def from_dict(cls, d: dict) -> "DatasetPolicy":
        rules = [AccessRule(a["role"], a["masking"], a.get("condition")) for a in d.get("access", [])]
        seen = set()
        for r in rules:
            if r.masking not in ("hash", "tokenize", "none"):
                raise ValueError(f"unknown masking {r.masking!r} for role {r.role!r}")
            if r.role in seen:
                raise ValueError(f"conflicting rules for role {r.role!r} on {d['name']}")
            seen.add(r.role)
        if not rules:
            raise ValueError(f"dataset {d['name']} has no access entry (default deny would orphan it)")
        return cls(d["name"], d["sensitivity"], int(d["retention_days"]), list(d["pii_columns"]), rules)

    def rule_for(self, role: str) -> AccessRule:
        for r in self.access:
            if r.role == role:
                return r
        raise AccessDenied(f"role {role!r} has no access to {self.name}")


SUPPORTED_POLICY_VERSIONS = (1,)


def load_policies(doc) -> dict[str, DatasetPolicy]:
    """Policy document (YAML text or parsed dict: version, domains ->
    datasets -> access) -> {dataset name: DatasetPolicy}. Unknown versions
    are refused; raw (``none``) access without a condition is allowed but
    warned about, since the spec only permits it with a condition."""
    import warnings

    if isinstance(doc, str):
        import yaml  # optional dependency, only for YAML text

        doc = yaml.safe_load(doc)
    if doc.get("version") not in SUPPORTED_POLICY_VERSIONS:
        raise ValueError(f"unsupported policy version {doc.get('version')!r}")
    out: dict[str, DatasetPolicy] = {}
    for domain in doc.get("domains", []):
        for ds in domain.get("datasets", []):
            pol = DatasetPolicy.from_dict(ds)
            for r in pol.access:
                if r.masking == "none" and not r.condition:
                    warnings.warn(f"{pol.name}: role {r.role!r} reads raw values without a condition")
            out[pol.name] = pol
    return out


def policy_for(policies: dict[str, DatasetPolicy], dataset: str) -> DatasetPolicy:
    """Datasets not in the document are denied (catch-all)."""
    if dataset not in policies:
        raise AccessDenied(f"dataset {dataset!r} is not covered by the policy document")
    return policies[dataset]


def bind_session(condition: str, session: dict[str, object] | None) -> str:
    """Replace session functions such as ``current_user_dept()`` by literals."""
    out = condition
    for fn, value in (session or {}).items():
        out = out.replace(f"{fn}()", _sql_literal(value))
    return out


def _sql_literal(value: object) -> str:
    """A value as SQL text that cannot end its own literal."""
    if isinstance(value, str):
        # by code points, so that neither quotes nor backslashes are ever parsed
        return "''" if not value else "concat(" + ", ".join(f"chr({ord(c)})" if ord(c) < 128 else f"'{c}'" for c in value) + ")"
    if value is None:
        return "NULL"
    if isinstance(value, (bool, int, float)):
        return str(value)
    raise TypeError(f"session value of type {type(value).__name__}")


def _named(df: DataFrame, names) -> set[str]:
    """The columns of ``df`` that ``names`` means, compared as the session
    resolves names; a name that is no column raises."""
    strict = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    fold = (lambda c: c) if strict else str.lower
    here: dict[str, list[str]] = {}
    for c in df.columns:
        here.setdefault(fold(c), []).append(c)
    absent = [n for n in names if fold(n) not in here]
    if absent:
        raise ValueError(f"no such columns: {absent}")
    return {c for n in names for c in here[fold(n)]}


def mask_column(col: str, masking: str, salt: str = "") -> Column:
    if masking == "hash":
        return salted_sha256(col, salt)
    if masking == "tokenize":
        return token_of(col, salt)
    if masking == "none":
        return F.col(col)
    return F.lit(MASKED)


def apply_policy(df: DataFrame, policy: DatasetPolicy, role: str, salt: str = "",
                 session: dict[str, object] | None = None) -> DataFrame:
    """Project with the role's mask on each PII column, filter rows by
    the role's condition. Unlisted roles are denied."""
    rule = policy.rule_for(role)
    out = df
    if rule.condition:
        out = out.where(F.expr(bind_session(rule.condition, session)))
    private = _named(df, policy.pii_columns)
    cols = [
        mask_column(c, rule.masking, salt).alias(c) if c in private else F.col(c)
        for c in df.columns
    ]
    return out.select(*cols)


def token_vault(df: DataFrame, columns: list[str], salt: str = "") -> DataFrame:
    """(token, value) for every distinct value of the PII columns."""
    vals = None
    for c in columns:
        v = df.select(F.col(c).cast("string").alias("value")).where(F.col("value").isNotNull())
        vals = v if vals is None else vals.unionByName(v)
    return vals.distinct().select(token_of("value", salt).alias("token"), "value")


def detokenize(masked: DataFrame, vault: DataFrame, columns: list[str]) -> DataFrame:
    """Reverse tokenization for authorised callers (one join per column). NULLs
    are spread over many keys that no vault has, else one task would get them all."""
    out = masked
    for c in columns:
        v = vault.select(F.col("token").alias(f"_tok_{c}"), F.col("value").alias(f"_val_{c}"))
        spread = F.concat(F.lit("null "), F.pmod(F.xxhash64(*masked.columns, F.monotonically_increasing_id()), F.lit(1024)).cast("string"))
        out = out.withColumn("_tok_key", F.coalesce(F.col(c), spread))
        out = out.join(v, F.col("_tok_key") == F.col(f"_tok_{c}"), "left").withColumn(c, F.col(f"_val_{c}")).drop(
            f"_tok_{c}", f"_val_{c}", "_tok_key"
        )
    return out


def deidentify(df: DataFrame, identifiers: list[str], dates: list[str], salt: str = "") -> DataFrame:
    """Identifiers hashed, dates truncated to the year."""
    cols = []
    identifiers, dates = _named(df, identifiers), _named(df, dates)
    for c in df.columns:
        if c in identifiers:
            cols.append(salted_sha256(c, salt).alias(c))
        elif c in dates:
            cols.append(F.date_trunc("year", F.col(c)).cast(df.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def register_mask_functions(spark: SparkSession) -> None:
    """SQL functions for masks; the role is an argument (no group lookup)."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION tw_mask_hash(v STRING, salt STRING) RETURNS STRING "
        "RETURN sha2(concat(salt, v), 256)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION tw_mask_for_role(v STRING, role STRING, allowed STRING, "
        "salt STRING) RETURNS STRING "
        f"RETURN CASE WHEN role = allowed THEN sha2(concat(salt, v), 256) ELSE '{MASKED}' END"
    )


# --------------------------------------------------------------------------
# Retention, erasure, lineage
# --------------------------------------------------------------------------


def retain(df: DataFrame, ts_col: str, retention_days: int, as_of, nulls: str = "keep") -> DataFrame:
    """Keep rows newer than ``as_of - retention_days``. A row without a time
    cannot be judged: it stays, or goes with ``nulls="drop"``. A stored table is
    trimmed by ``plans/retention.py``."""
    if nulls not in ("keep", "drop"):
        raise ValueError(f"nulls are kept or dropped, not {nulls!r}")
    edge = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(retention_days)} DAYS")
    new = F.col(ts_col) >= edge
    return df.where(new | F.col(ts_col).isNull() if nulls == "keep" else new)


def erase(df: DataFrame, key: str, subjects: DataFrame, subject_key: str) -> DataFrame:
    """Drop rows of the given subjects (anti join)."""
    s = subjects.select(F.col(subject_key).alias("_erase_key")).distinct()
    return df.join(s, F.col(key) == F.col("_erase_key"), "left_anti")


def reachable(edges: DataFrame, starts: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Nodes reachable from ``starts`` over ``edges(src, dst)`` with the
    first depth they are reached at.

    Frontier loop: join, drop nodes already seen, union, until the frontier is
    empty. Each new frontier is staged as Parquet in the shared checkpoint
    folder, so ``seen`` is a union of staged parts (short lineage; a lost
    executor repeats one round at most), and its bytes tell Spark whether to
    broadcast it and filter the (large) edge list in place. A given
    ``max_depth`` that does not suffice raises: nothing is left out silently.
    """
    edges = stage(edges.select("src", "dst"), "reach-edges")  # built once, scanned every round
    frontier = stage(starts.select(F.col("node"), F.lit(0).alias("depth")).distinct(), "reach-0")
    seen, depth = frontier, 0
    while not frontier.isEmpty():
        depth += 1
        frontier = stage(
            edges.join(frontier.select("node"), F.col("src") == F.col("node")).select(F.col("dst").alias("node")).distinct()
            .join(seen.select("node"), "node", "left_anti")
            .withColumn("depth", F.lit(depth)),
            f"reach-{depth}",
        )
        if frontier.isEmpty():
            break
        if max_depth is not None and depth > max_depth:
            raise ValueError(f"nodes beyond depth {max_depth} are reachable")
        seen = seen.unionByName(frontier)
        if depth % 16 == 0:  # a union of many parts plans slowly
            seen = stage(seen, "reach-seen")
    return seen


LINEAGE_KINDS = ["customer", "order", "part", "supplier"]


def lineage_node(kind: str, id_col: str) -> Column:
    """Compact node id: ``id * 4 + kind`` (a long — cheap to shuffle and join)."""
    return F.col(id_col).cast("long") * len(LINEAGE_KINDS) + LINEAGE_KINDS.index(kind)


def lineage_label(node_col: str = "node") -> Column:
    """``kind:id`` text of a compact node id."""
    n = len(LINEAGE_KINDS)
    kind = F.element_at(F.array(*[F.lit(k) for k in LINEAGE_KINDS]), (F.pmod(F.col(node_col), F.lit(n)) + 1).cast("int"))
    return F.concat(kind, F.lit(":"), F.floor(F.col(node_col) / n).cast("long").cast("string"))


def record_lineage_edges(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Record-level lineage in the warehouse: customer -> order -> part -> supplier."""
    c2o = orders.select(lineage_node("customer", "o_custkey").alias("src"), lineage_node("order", "o_orderkey").alias("dst"))
    o2p = lineitem.select(lineage_node("order", "l_orderkey").alias("src"), lineage_node("part", "l_partkey").alias("dst"))
    p2s = lineitem.select(lineage_node("part", "l_partkey").alias("src"), lineage_node("supplier", "l_suppkey").alias("dst"))
    return c2o.unionByName(o2p).unionByName(p2s).distinct()


# --------------------------------------------------------------------------
# Access anomalies
# --------------------------------------------------------------------------


def access_anomalies(log: DataFrame, user: str, ts: str, role: str, baseline_days: int = 14,
                     trailing_days: int = 7, sigmas: int = 3, min_history: int = 3,
                     off_hours=(6, 22), off_hours_min: int = 3) -> DataFrame:
    """Flags ``(user, day, kind, events)``:

    * ``volume`` — a day's count exceeds mean + sigmas * stddev of the user's
      previous ``trailing_days`` active days (integer-exact comparison);
    * ``new_role`` — a (user, role) pair never seen in the baseline period;
    * ``off_hours`` — at least ``off_hours_min`` events outside [6, 22) h.
    """
    from pyspark.sql import Window

    day = F.to_date(ts)
    daily = log.groupBy(F.col(user).alias("user_id"), day.alias("day")).agg(F.count(F.lit(1)).alias("events"))
    w = Window.partitionBy("user_id").orderBy("day").rowsBetween(-trailing_days, -1)
    n, s, q = F.count("events").over(w), F.sum("events").over(w), F.sum((F.col("events").cast("decimal(14,0)") * F.col("events").cast("decimal(14,0)")).cast("decimal(28,0)")).over(w)
    stats = daily.select("user_id", "day", "events", n.alias("n"), s.alias("s"), q.alias("q"))
    # counts and sums as decimals: their products pass the range of a long
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    n_, e_, s_ = wide("n"), wide("events"), wide("s")
    d = (n_ * e_ - s_).cast("decimal(24,0)")
    volume = stats.where(
        (F.col("n") >= min_history) & (d > 0)
        & ((d * d).cast("decimal(34,0)") * (F.col("n") - 1).cast("decimal(3,0)")
           > (F.lit(sigmas * sigmas).cast("decimal(3,0)") * F.col("n").cast("decimal(3,0)")
              * (F.col("n").cast("decimal(3,0)") * F.col("q").cast("decimal(30,0)") - (s_ * s_).cast("decimal(31,0)")).cast("decimal(32,0)")))
    ).select("user_id", "day", F.lit("volume").alias("kind"), "events")

    start = log.agg(F.min(day).alias("d0")).first()["d0"]
    cut = F.date_add(F.lit(start), baseline_days)
    base = log.where(day < cut).select(F.col(user).alias("user_id"), F.col(role).alias("role")).distinct()
    later = log.where(day >= cut).select(F.col(user).alias("user_id"), F.col(role).alias("role"), day.alias("day"))
    new_role = (
        later.join(base, ["user_id", "role"], "left_anti")
        .groupBy("user_id", "role").agg(F.min("day").alias("day"), F.count(F.lit(1)).alias("events"))
        .select("user_id", "day", F.lit("new_role").alias("kind"), "events")
    )
    h = F.hour(F.col(ts))
    off = (
        log.where((h < off_hours[0]) | (h >= off_hours[1]))
        .groupBy(F.col(user).alias("user_id"), day.alias("day")).agg(F.count(F.lit(1)).alias("events"))
        .where(F.col("events") >= off_hours_min)
        .select("user_id", "day", F.lit("off_hours").alias("kind"), "events")
    )
    return volume.unionByName(new_role).unionByName(off)


# --------------------------------------------------------------------------
# Catalog metadata reshape
# --------------------------------------------------------------------------

# Foreign type base name -> catalog type name (default VARCHAR).
CATALOG_TYPE_MAP = {
    "NUMBER": "NUMBER", "DECIMAL": "DECIMAL", "INT": "INT", "BIGINT": "BIGINT",
    "FLOAT": "DOUBLE", "TEXT": "VARCHAR", "VARCHAR": "VARCHAR",
    "BOOLEAN": "BOOLEAN", "DATE": "DATE", "TIMESTAMP_NTZ": "TIMESTAMP",
    "TIMESTAMP_TZ": "TIMESTAMP", "VARIANT": "JSON", "OBJECT": "JSON",
    "ARRAY": "ARRAY", "BINARY": "BINARY",
}


def warehouse_type_name(dt: T.DataType) -> str:
    """Spark type -> the warehouse's information-schema type spelling."""
    if isinstance(dt, T.LongType):
        return "NUMBER(19,0)"
    if isinstance(dt, T.IntegerType):
        return "NUMBER(10,0)"
    if isinstance(dt, T.DecimalType):
        return f"NUMBER({dt.precision},{dt.scale})"
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return "FLOAT"
    if isinstance(dt, T.StringType):
        return "TEXT"
    if isinstance(dt, T.TimestampNTZType):
        return "TIMESTAMP_NTZ"
    if isinstance(dt, T.TimestampType):
        return "TIMESTAMP_TZ"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dt, T.DateType):
        return "DATE"
    if isinstance(dt, T.ArrayType):
        return "ARRAY"
    if isinstance(dt, T.BinaryType):
        return "BINARY"
    return "VARIANT"


def information_schema(spark: SparkSession, tables: dict[str, DataFrame], catalog: str = "LAKE",
                       schema: str = "RAW") -> tuple[DataFrame, DataFrame]:
    """(column rows, table rows) as a warehouse information schema would list them."""
    cols = [
        (catalog, schema, name.upper(), f.name.upper(), warehouse_type_name(f.dataType),
         "YES" if f.nullable else "NO", None, i + 1)
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    tabs = [(catalog, schema, name.upper(), "BASE TABLE", None) for name in tables]
    c = spark.createDataFrame(
        cols, "table_catalog string, table_schema string, table_name string, column_name string, "
              "data_type string, is_nullable string, column_comment string, ordinal_position int")
    t = spark.createDataFrame(
        tabs, "table_catalog string, table_schema string, table_name string, table_type string, "
              "table_comment string")
    return c, t


def catalog_flat(columns: DataFrame, tables: DataFrame) -> DataFrame:
    """M1 + M2: join USING the three name parts, drop the system schema, map types."""
    m = F.create_map(*[x for k, v in CATALOG_TYPE_MAP.items() for x in (F.lit(k), F.lit(v))])
    base = F.upper(F.split_part(F.col("data_type"), F.lit("("), F.lit(1)))
    j = columns.join(tables, ["table_catalog", "table_schema", "table_name"],
                     "inner").where(
        F.col("table_schema") != "INFORMATION_SCHEMA"
    )
    return j.select(
        "table_catalog", "table_schema", "table_name", "table_type",
        F.coalesce(F.col("table_comment"), F.lit("")).alias("table_description"),
        F.col("column_name").alias("name"),
        F.coalesce(m[base], F.lit("VARCHAR")).alias("dataType"),
        (F.col("is_nullable") == "YES").alias("nullable"),
        F.coalesce(F.col("column_comment"), F.lit("")).alias("description"),
        F.col("ordinal_position").alias("ordinalPosition"),
    ).orderBy("table_catalog", "table_schema", "table_name", "ordinalPosition")


def catalog_nested(flat: DataFrame) -> DataFrame:
    """One record per table with its ordered column list (bounded by the
    table's width, never by its row count)."""
    return flat.groupBy("table_catalog", "table_schema", "table_name", "table_type", "table_description").agg(
        F.sort_array(F.collect_list(F.struct("ordinalPosition", "name", "dataType", "nullable", "description")))
        .alias("columns")
    )
