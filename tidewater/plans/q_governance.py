"""Governance queries with their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators.dedup import union_by_name
from tidewater.plans import governance as gv
from tidewater.plans.erasure import KeyEdge, KeyGraph, erase_cascade
from tidewater.plans.exposure import ClassificationRegister, RoleRule, exposed_view
from tidewater.plans.retention import retain_table
from tidewater.registry import Tables, query
from tidewater.session import scratch_path
from tidewater.sources.files import write_table

ALL_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split()
SALT = "tw-salt-1"

# The string columns of every table, as the SQL oracle lists them. The Spark side
# reads them off the schemas and must agree.
ORACLE_STRING_COLUMNS = {
    "region": ["r_name"],
    "nation": ["n_name"],
    "customer": ["c_name", "c_mktsegment"],
    "supplier": ["s_name"],
    "part": ["p_name", "p_brand", "p_type"],
    "orders": ["o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus"],
    "events": ["event_type", "props"],
    "documents": ["text", "lang", "source"],
    "pages": ["url", "html"],
    "benchmark": ["text"],
    "conversations": ["role", "text"],
    "contacts": ["contact_email", "contact_phone", "card_number", "lang", "source"],
}

CONTACT_PATTERNS = {
    "contact_email": gv.TEXT_SCAN_PATTERNS["email"],
    "contact_phone": gv.TEXT_SCAN_PATTERNS["phone"],
    "card_number": gv.TEXT_SCAN_PATTERNS["credit_card"],
}


CONTACT_GUARDS = {"contact_email": "email", "contact_phone": "phone", "card_number": "credit_card"}


def contacts(documents):
    """Contact fields pulled out of free text (first match per document; ''
    when none). The guard skips texts that cannot contain a match."""
    return _documents_with_contacts(documents).select("doc_id", *CONTACT_PATTERNS, "lang", "source")


CONTACTS_SQL = "contacts AS (SELECT doc_id, " + ", ".join(
    f"regexp_extract(text, '{p}', 0) AS {c}" for c, p in CONTACT_PATTERNS.items()
) + ", lang, source FROM documents)"


def _frames(t: Tables, names=None) -> dict:
    names = list(names or ALL_TABLES + ["contacts"])
    d = {name: getattr(t, name) for name in names if name != "contacts"}
    if "contacts" in names:
        d["contacts"] = contacts(d["documents"] if "documents" in d else t.documents)
    return d


def _rules_values_sql() -> str:
    rows = ", ".join(
        f"('{c['name']}', '{c['sensitivity']}', '{p}')" for c in gv.PII_CATEGORIES for p in c["patterns"]
    )
    return f"rules(tag, sensitivity, pattern) AS (VALUES {rows})"


NAME_HITS_SQL = f"""
{_rules_values_sql()},
cols AS (
  SELECT table_name AS table_fqn, column_name AS col FROM information_schema.columns
  WHERE table_name IN ({", ".join(f"'{x}'" for x in ALL_TABLES)})
  UNION ALL
  SELECT * FROM (VALUES ('contacts', 'doc_id'), ('contacts', 'contact_email'), ('contacts', 'contact_phone'),
                        ('contacts', 'card_number'), ('contacts', 'lang'), ('contacts', 'source')) v(table_fqn, col)
),
name_hits AS (
  SELECT DISTINCT c.table_fqn, c.col AS "column", r.tag, r.sensitivity, CAST(0.95 AS DOUBLE) AS confidence,
         'column-name match: ' || c.col AS reason
  FROM cols c JOIN rules r ON regexp_matches(c.col, r.pattern)
)"""


def _value_counts_sql() -> str:
    parts = []
    for table, cols in ORACLE_STRING_COLUMNS.items():
        for c in cols:
            nonblank = f"{c} IS NOT NULL AND NOT regexp_full_match({c}, '{gv.BLANK}')"
            for cat in gv.PII_CATEGORIES:
                rule = cat.get("sample_rule")
                if not rule:
                    continue
                parts.append(
                    f"SELECT '{table}' AS table_fqn, '{c}' AS \"column\", '{cat['name']}' AS tag, "
                    f"'{cat['sensitivity']}' AS sensitivity, CAST({rule['min_match_fraction']} AS DOUBLE) AS threshold, "
                    f"CAST(count(*) FILTER (WHERE {nonblank} AND regexp_full_match({c}, '{rule['regex']}')) AS BIGINT) AS matches, "
                    f"CAST(count(*) FILTER (WHERE {nonblank}) AS BIGINT) AS nonblank FROM {table}"
                )
    return "value_counts AS (\n" + "\nUNION ALL\n".join(parts) + "\n)"


VALUE_HITS_SQL = f"""
{CONTACTS_SQL},
{_value_counts_sql()},
value_hits AS (
  SELECT table_fqn, "column", tag, sensitivity,
         CAST((matches * 200 + nonblank) // (2 * nonblank) AS DOUBLE) / 100.0 AS confidence,
         printf('%d/%d sample values matched', matches, nonblank) AS reason
  FROM value_counts
  WHERE nonblank > 0 AND matches * 100 >= CAST(round(threshold * 100) AS BIGINT) * nonblank
)"""


def _name_hits(spark, t):
    inv = gv.column_inventory(spark, _frames(t))
    return gv.classify_by_name(inv)


def _value_counts(spark, t):
    """One aggregate pass per base table over all its string columns; the
    contacts view is derived from documents, so its columns are counted in the
    same documents scan."""
    frames = _frames(t, ALL_TABLES)
    documents = frames.pop("documents")
    parts = [gv.value_match_counts(df, name) for name, df in frames.items() if gv.string_columns(df)]
    emit = [(name, c) for name, df in (("documents", documents), ("contacts", contacts(documents)))
            for c in gv.string_columns(df)]
    parts.append(gv.value_match_counts(_documents_with_contacts(documents), "documents", emit=emit))
    return union_by_name(parts)


def _documents_with_contacts(documents):
    """documents plus the contact columns extracted from its text."""
    return documents.select(
        *documents.columns,
        *[
            F.when(gv._text_guard(CONTACT_GUARDS[c], "text"), F.regexp_extract("text", p, 0))
            .otherwise(F.lit("")).alias(c)
            for c, p in CONTACT_PATTERNS.items()
        ],
    )


FILLED_SQL = "filled AS (" + " UNION ALL ".join(
    f"SELECT '{x}' AS table_fqn, \"column\", filled_rows FROM (UNPIVOT (SELECT count(COLUMNS('.*')) AS '\\0' FROM {x}) "
    "ON COLUMNS(*) INTO NAME \"column\" VALUE filled_rows)"
    for x in [*ALL_TABLES, "contacts"]) + ")"


@query(
    "classify_names",
    f"""WITH {CONTACTS_SQL}, {FILLED_SQL}, {NAME_HITS_SQL}
SELECT h.*, f.filled_rows FROM name_hits h JOIN filled f USING (table_fqn, "column")""",
)
def q_classify_names(spark, t):
    """Column-name rules over every table's columns (incl. the contacts
    view), with the rows in which a tagged column holds a value."""
    filled = union_by_name([gv.filled_counts(df, name) for name, df in _frames(t).items()])
    return _name_hits(spark, t).join(filled, ["table_fqn", "column"])


@query("classify_value_counts", f"WITH {VALUE_HITS_SQL}\nSELECT * FROM value_counts")
def q_classify_value_counts(spark, t):
    """Non-blank values and full matches per (column, value rule), one pass per table."""
    return _value_counts(spark, t)


@query("classify_values", f"WITH {VALUE_HITS_SQL}\nSELECT * FROM value_hits")
def q_classify_values(spark, t):
    """Value-based hits (fraction >= threshold), confidence rounded half-up."""
    return gv.classify_by_values(_value_counts(spark, t))


@query(
    "classify_best",
    f"""WITH {NAME_HITS_SQL}, {VALUE_HITS_SQL},
both_hits AS (SELECT *, 1 AS name_first FROM name_hits UNION ALL SELECT *, 0 AS name_first FROM value_hits)
SELECT table_fqn, "column", tag, sensitivity, confidence, reason FROM (
  SELECT *, row_number() OVER (PARTITION BY table_fqn, "column", tag
                               ORDER BY confidence DESC, name_first DESC) AS rn FROM both_hits)
WHERE rn = 1""",
)
def q_classify_best(spark, t):
    """Best confidence per (table, column, tag); ties keep the name hit."""
    return gv.best_per_tag(_name_hits(spark, t), gv.classify_by_values(_value_counts(spark, t)))


TEXT_SCAN_SQL = "SELECT doc_id, " + ", ".join(
    f"CAST(len(regexp_extract_all(text, '{p}')) AS BIGINT) AS {k}_hits" for k, p in gv.TEXT_SCAN_PATTERNS.items()
) + " FROM documents"


@query(
    "text_pii_scan",
    f"SELECT * FROM ({TEXT_SCAN_SQL}) WHERE "
    + " OR ".join(f"{k}_hits > 0" for k in gv.TEXT_SCAN_PATTERNS),
)
def q_text_pii_scan(spark, t):
    """PII-like matches per document over whole texts."""
    return gv.text_pii_scan(t.documents, "doc_id", "text")


CUSTOMER_POLICY = gv.DatasetPolicy.from_dict({
    "name": "lake.raw.customer",
    "sensitivity": "PII",
    "retention_days": 1095,
    "pii_columns": ["c_name"],
    "access": [
        {"role": "marketing_analyst", "masking": "hash"},
        {"role": "data_scientist", "masking": "tokenize"},
        {"role": "campaign_manager", "masking": "none", "condition": "c_mktsegment = current_user_segment()"},
    ],
})


@query(
    "masked_view",
    f"SELECT c_custkey, sha256('{SALT}' || c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def q_masked_view(spark, t):
    """The analyst role sees salted SHA-256 of the PII column."""
    return gv.apply_policy(t.customer, CUSTOMER_POLICY, "marketing_analyst", SALT)


EXPOSURE_RULES = [RoleRule("marketing_analyst", {"PII": "hash"}),
                  RoleRule("auditor", {"PII": "none", "PCI": "tokenize"}, "lang = current_user_lang()")]


@query(
    "classified_view",
    f"""
WITH {CONTACTS_SQL}
SELECT doc_id, sha256('{SALT}' || contact_email) AS contact_email, sha256('{SALT}' || contact_phone) AS contact_phone,
       '<masked>' AS card_number, lang, source, '<masked>' AS next_of_kin FROM contacts""",
)
def q_classified_view(spark, t):
    """Contact fields are shown as their classification allows the
    analyst: PII hashed, PCI masked, and a column that came after the last run
    masked until it is classified."""
    frames = _frames(t)
    register = ClassificationRegister(spark, scratch_path(spark, "register"))
    hits = gv.best_per_tag(_name_hits(spark, t), gv.classify_by_values(_value_counts(spark, t)))
    register.record(frames, hits, run_id=1)
    later = frames["contacts"].withColumn("next_of_kin", F.col("contact_email"))
    return exposed_view(later, "contacts", register, EXPOSURE_RULES, "marketing_analyst", SALT)


@query("row_policy", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def q_row_policy(spark, t):
    """The campaign role sees raw values, only rows of its own segment."""
    return gv.apply_policy(t.customer, CUSTOMER_POLICY, "campaign_manager", SALT,
                           session={"current_user_segment": "BUILDING"})


@query(
    "token_vault",
    f"SELECT DISTINCT substr(sha256('{SALT}' || c_name), 1, 32) AS token, c_name AS value FROM customer",
)
def q_token_vault(spark, t):
    """Token vault (token -> value) for the tokenized column."""
    return gv.token_vault(t.customer, CUSTOMER_POLICY.pii_columns, SALT)


@query("detokenize", "SELECT * FROM customer")
def q_detokenize(spark, t):
    """Tokenized view joined back through the vault gives the raw rows."""
    masked = gv.apply_policy(t.customer, CUSTOMER_POLICY, "data_scientist", SALT)
    vault = gv.token_vault(t.customer, CUSTOMER_POLICY.pii_columns, SALT)
    return gv.detokenize(masked, vault, CUSTOMER_POLICY.pii_columns)


@query(
    "deidentified",
    f"""
SELECT o_orderkey, sha256('{SALT}' || CAST(o_custkey AS VARCHAR)) AS o_custkey, o_orderstatus, o_totalprice,
       date_trunc('year', o_orderdate) AS o_orderdate, o_orderpriority FROM orders""",
)
def q_deidentified(spark, t):
    """Identifiers hashed, dates truncated to the year."""
    return gv.deidentify(t.orders, ["o_custkey"], ["o_orderdate"], SALT)


@query(
    "sql_mask",
    f"""
SELECT c_custkey, sha256('{SALT}' || c_name) AS name_for_analyst, '<masked>' AS name_for_intern FROM customer""",
)
def q_sql_mask(spark, t):
    """SQL mask functions with the role as an argument."""
    gv.register_mask_functions(spark)
    t.customer.createOrReplaceTempView("tw_customer_src")
    return spark.sql(
        f"SELECT c_custkey, tw_mask_for_role(c_name, 'marketing_analyst', 'marketing_analyst', '{SALT}') "
        f"AS name_for_analyst, tw_mask_for_role(c_name, 'intern', 'marketing_analyst', '{SALT}') "
        f"AS name_for_intern FROM tw_customer_src"
    )


@query(
    "retention",
    """
SELECT * FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 1095 DAY""",
)
def q_retention(spark, t):
    """Orders inside the 1095-day retention window before the newest order;
    an order without a date is in no window."""
    o = t.orders
    as_of = o.agg(F.max("o_orderdate").alias("m")).first()["m"]
    return gv.retain(o, "o_orderdate", CUSTOMER_POLICY.retention_days, as_of, nulls="drop")


@query(
    "retention_partitions",
    """
WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate FROM orders)
SELECT * FROM o WHERE o_orderdate IS NULL OR o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 1095 DAY""",
)
def q_retention_partitions(spark, t):
    """The orders stored by month, some without a date, trimmed in place: old
    months deleted unread, the month that the edge cuts rewritten, rows without a
    date kept."""
    o = t.orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderdate")))
    o = o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", F.trunc("o_orderdate", "month").alias("order_month"))
    path = scratch_path(spark, "orders-by-month")
    write_table(o, path, partition_by=["order_month"])
    as_of = t.orders.agg(F.max("o_orderdate").alias("m")).first()["m"]
    retain_table(spark, path, "order_month", "o_orderdate", CUSTOMER_POLICY.retention_days, as_of, period="month")
    return spark.read.parquet(path).drop("order_month")


SUBJECTS_SQL = "(SELECT c_custkey FROM customer WHERE c_acctbal < 0)"
ERASED_ORDERS_SQL = f"(SELECT o_orderkey FROM orders WHERE o_custkey IN {SUBJECTS_SQL})"


#: What refers to what; a further copy of customer data is a further line.
WAREHOUSE_KEYS = KeyGraph(
    keys={"customer": ["c_custkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"]},
    edges=[KeyEdge("customer", "c_custkey", "orders", "o_custkey"), KeyEdge("orders", "o_orderkey", "lineitem", "l_orderkey")],
)


def _subjects(t):
    return t.customer.where(F.col("c_acctbal") < 0).select("c_custkey")


def _erased(t):
    tables = {name: getattr(t, name) for name in WAREHOUSE_KEYS.keys}
    return erase_cascade(tables, WAREHOUSE_KEYS, "customer", _subjects(t), "c_custkey")


@query("erasure", f"SELECT * FROM orders WHERE o_custkey NOT IN {SUBJECTS_SQL}")
def q_erasure(spark, t):
    """Orders of erased subjects removed."""
    return _erased(t)[0]["orders"]


@query("erasure_lines", f"SELECT * FROM lineitem WHERE l_orderkey NOT IN {ERASED_ORDERS_SQL}")
def q_erasure_lines(spark, t):
    """Downstream copy — lines of erased orders removed."""
    return _erased(t)[0]["lineitem"]


@query(
    "erasure_log",
    f"""
SELECT 'customer' AS table_name, count(*) AS erased_rows FROM customer WHERE c_custkey IN {SUBJECTS_SQL}
UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey IN {SUBJECTS_SQL}
UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey IN {ERASED_ORDERS_SQL}""",
)
def q_erasure_log(spark, t):
    """Erased rows of every table that the key graph reaches."""
    return _erased(t)[1]


@query(
    "lineage_reach",
    f"""
WITH RECURSIVE edges AS (
  SELECT DISTINCT src, dst FROM (
    SELECT 'customer:' || CAST(o_custkey AS VARCHAR) AS src, 'order:' || CAST(o_orderkey AS VARCHAR) AS dst FROM orders
    UNION ALL
    SELECT 'order:' || CAST(l_orderkey AS VARCHAR), 'part:' || CAST(l_partkey AS VARCHAR) FROM lineitem
    UNION ALL
    SELECT 'part:' || CAST(l_partkey AS VARCHAR), 'supplier:' || CAST(l_suppkey AS VARCHAR) FROM lineitem)),
reach(node, depth) AS (
  SELECT 'customer:' || CAST(c_custkey AS VARCHAR), 0 FROM customer WHERE c_acctbal < 0
  UNION
  SELECT e.dst, r.depth + 1 FROM reach r JOIN edges e ON e.src = r.node WHERE r.depth < 64)
SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM reach GROUP BY node""",
)
def q_lineage_reach(spark, t):
    """Records reachable from erased subjects (customer -> order -> part -> supplier)."""
    edges = gv.record_lineage_edges(t.orders, t.lineitem)
    starts = t.customer.where(F.col("c_acctbal") < 0).select(gv.lineage_node("customer", "c_custkey").alias("node"))
    return gv.reachable(edges, starts).select(gv.lineage_label("node").alias("node"), "depth")


@query(
    "access_anomalies",
    """
WITH log AS (SELECT user_id, ts, event_type AS role, CAST(ts AS DATE) AS day FROM events),
daily AS (SELECT user_id, day, count(*) AS events FROM log GROUP BY user_id, day),
stats AS (
  SELECT user_id, day, events, count(events) OVER w AS n, sum(events) OVER w AS s,
         sum(events * events) OVER w AS q
  FROM daily WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
volume AS (
  SELECT user_id, day, 'volume' AS kind, events FROM stats
  WHERE n >= 3 AND n * events - s > 0
    AND (n * events - s) * (n * events - s) * (n - 1) > 9 * n * (n * q - s * s)),
cut AS (SELECT min(day) + 14 AS d FROM log),
base AS (SELECT DISTINCT user_id, role FROM log WHERE day < (SELECT d FROM cut)),
new_role AS (
  SELECT l.user_id, min(l.day) AS day, 'new_role' AS kind, count(*) AS events
  FROM log l
  WHERE l.day >= (SELECT d FROM cut)
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.user_id = l.user_id AND b.role = l.role)
  GROUP BY l.user_id, l.role),
off_hours AS (
  SELECT user_id, day, 'off_hours' AS kind, count(*) AS events FROM log
  WHERE hour(ts) < 6 OR hour(ts) >= 22 GROUP BY user_id, day HAVING count(*) >= 3)
SELECT * FROM volume UNION ALL SELECT * FROM new_role UNION ALL SELECT * FROM off_hours""",
)
def q_access_anomalies(spark, t):
    """Volume spikes, first-time roles after the baseline, off-hours bursts."""
    return gv.access_anomalies(t.events, "user_id", "ts", "event_type")


CATALOG_SQL = f"""
WITH cols AS (
  SELECT 'LAKE' AS table_catalog, 'RAW' AS table_schema, upper(table_name) AS table_name,
         upper(column_name) AS column_name,
         CASE WHEN data_type = 'BIGINT' THEN 'NUMBER(19,0)' WHEN data_type = 'INTEGER' THEN 'NUMBER(10,0)'
              WHEN data_type IN ('DOUBLE', 'FLOAT') THEN 'FLOAT' WHEN data_type = 'VARCHAR' THEN 'TEXT'
              WHEN data_type LIKE 'TIMESTAMP%' AND data_type NOT LIKE '%TIME ZONE%' THEN 'TIMESTAMP_NTZ'
              WHEN data_type = 'BOOLEAN' THEN 'BOOLEAN'
              WHEN data_type = 'DATE' THEN 'DATE' WHEN data_type LIKE '%[]' THEN 'ARRAY'
              ELSE 'VARIANT' END AS data_type,
         is_nullable, CAST(NULL AS VARCHAR) AS column_comment, CAST(ordinal_position AS INTEGER) AS ordinal_position
  FROM information_schema.columns
  WHERE table_name IN ({", ".join(f"'{x}'" for x in ALL_TABLES)})),
tabs AS (SELECT DISTINCT table_catalog, table_schema, table_name, 'BASE TABLE' AS table_type,
                CAST(NULL AS VARCHAR) AS table_comment FROM cols),
sizes AS ({" UNION ALL ".join(f"SELECT '{x.upper()}' AS table_name, count(*) AS row_count FROM {x}" for x in ALL_TABLES)})
SELECT table_catalog, table_schema, table_name, table_type, coalesce(table_comment, '') AS table_description,
       column_name AS name,
       CASE upper(split_part(data_type, '(', 1))
         {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in gv.CATALOG_TYPE_MAP.items())}
         ELSE 'VARCHAR' END AS "dataType",
       is_nullable = 'YES' AS nullable, coalesce(column_comment, '') AS description,
       ordinal_position AS "ordinalPosition", row_count
FROM cols JOIN tabs USING (table_catalog, table_schema, table_name) JOIN sizes USING (table_name)
WHERE table_schema <> 'INFORMATION_SCHEMA'"""


def _catalog_flat(spark, t):
    cols, tabs = gv.information_schema(spark, _frames(t, ALL_TABLES))
    return gv.catalog_flat(cols, tabs)


def _with_row_counts(t, catalog):
    """The catalog with the measured size of each table."""
    sizes = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name.upper()).alias("table_name"), "row_count")
             for name, df in _frames(t, ALL_TABLES).items()]
    return catalog.join(union_by_name(sizes), "table_name")


@query("catalog_flat", CATALOG_SQL)
def q_catalog_flat(spark, t):
    """Column rows joined to table rows and table sizes, type names mapped, ordered."""
    return _with_row_counts(t, _catalog_flat(spark, t)).orderBy("table_catalog", "table_schema", "table_name", "ordinalPosition")


@query("catalog_nested")
def q_catalog_nested(spark, t):
    """One record per table with its ordered nested column list."""
    return _with_row_counts(t, gv.catalog_nested(_catalog_flat(spark, t)))


@query(
    "catalog_nested_columns",
    f"""SELECT table_name, row_count, string_agg(CAST("ordinalPosition" AS VARCHAR) || ':' || name || ':' || "dataType", ',' ORDER BY "ordinalPosition") AS columns
FROM ({CATALOG_SQL}) GROUP BY 1, 2""",
)
def q_catalog_nested_columns(spark, t):
    """The nested column lists, in their order, as text."""
    nested = _with_row_counts(t, gv.catalog_nested(_catalog_flat(spark, t)))
    one = lambda c: F.concat_ws(":", c["ordinalPosition"].cast("string"), c["name"], c["dataType"])
    return nested.select("table_name", "row_count", F.array_join(F.transform("columns", one), ",").alias("columns"))
