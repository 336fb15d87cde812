"""Classification, policies, tokenization, lineage and range tagging."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators.geo import tag_points
from tidewater.plans import governance as gv


def test_sample_classification_email(spark):
    rows = [("jane@example.com",), ("j.smith@example.com",), ("x@y.io",), ("not-an-email",), (None,),
            ("another@example.com",)]
    df = spark.createDataFrame(rows, "user_contact string")
    hits = gv.classify_by_values(gv.value_match_counts(df, "demo.users")).collect()
    email = [h for h in hits if h["tag"] == "email"]
    assert len(email) == 1 and email[0]["confidence"] == 0.8 and email[0]["sensitivity"] == "PII"
    assert email[0]["reason"] == "4/5 sample values matched"


def test_full_match_rejects_trailing_newline(spark):
    df = spark.createDataFrame([("a@b.co\n",)] * 10, "v string")
    assert gv.classify_by_values(gv.value_match_counts(df, "t")).count() == 0


def test_name_rules_and_best_per_tag(spark):
    inv = gv.column_inventory(spark, {"t": spark.createDataFrame([], "email string, hotel string, name string")})
    names = gv.classify_by_name(inv)
    got = {(r["column"], r["tag"]) for r in names.collect()}
    assert got == {("email", "email"), ("hotel", "phone"), ("name", "full_name")}
    values = spark.createDataFrame([("t", "email", "email", "PII", 0.95, "4/4 sample values matched")],
                                   gv.CLASSIFICATION_SCHEMA)
    best = {r["column"]: r["reason"] for r in gv.best_per_tag(names, values).collect()}
    assert best["email"].startswith("column-name match")


POLICY = gv.DatasetPolicy.from_dict({
    "name": "prod.patient_visits", "sensitivity": "PHI", "retention_days": 2555,
    "pii_columns": ["mrn", "patient_name"],
    "access": [{"role": "analyst_clinical", "masking": "hash"},
               {"role": "physician", "masking": "none", "condition": "current_user_dept() = visit_dept"}],
})


@pytest.fixture()
def visits(spark):
    return spark.createDataFrame([("MRN-1", "Ann", "cardio"), ("MRN-2", "Bob", "neuro")],
                                 "mrn string, patient_name string, visit_dept string")


def test_hash_role_masks_every_pii_column(visits):
    out = gv.apply_policy(visits, POLICY, "analyst_clinical", salt="s").collect()
    assert all(len(r["mrn"]) == 64 and len(r["patient_name"]) == 64 for r in out)
    assert {r["visit_dept"] for r in out} == {"cardio", "neuro"}


def test_condition_filters_rows_for_its_role_only(visits):
    phys = gv.apply_policy(visits, POLICY, "physician", session={"current_user_dept": "cardio"}).collect()
    assert [(r["mrn"], r["patient_name"]) for r in phys] == [("MRN-1", "Ann")]
    assert gv.apply_policy(visits, POLICY, "analyst_clinical").count() == 2


def test_unlisted_role_is_denied(visits):
    with pytest.raises(gv.AccessDenied):
        gv.apply_policy(visits, POLICY, "intern")


def test_policy_validation():
    with pytest.raises(ValueError):
        gv.DatasetPolicy.from_dict({"name": "x", "sensitivity": "PII", "retention_days": 1, "pii_columns": [],
                                    "access": [{"role": "a", "masking": "hash"}, {"role": "a", "masking": "none"}]})
    with pytest.raises(ValueError):
        gv.DatasetPolicy.from_dict({"name": "x", "sensitivity": "PII", "retention_days": 1, "pii_columns": [],
                                    "access": []})


def test_tokens_round_trip(spark, visits):
    vault = gv.token_vault(visits, ["mrn", "patient_name"], salt="k")
    assert vault.select("token").distinct().count() == vault.count() == 4
    masked = visits.select(*[gv.mask_column(c, "tokenize", "k").alias(c) if c != "visit_dept" else F.col(c)
                             for c in visits.columns])
    back = gv.detokenize(masked, vault, ["mrn", "patient_name"]).select(*visits.columns)
    assert back.exceptAll(visits).count() == 0


def test_lineage_matches_brute_force_with_cycle(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")]
    e = spark.createDataFrame(edges, "src string, dst string")
    starts = spark.createDataFrame([("a",)], "node string")
    got = {(r.node, r.depth) for r in gv.reachable(e, starts).collect()}
    # brute-force BFS
    depth, frontier, adj = {"a": 0}, ["a"], {}
    for s, d in edges:
        adj.setdefault(s, []).append(d)
    while frontier:
        nxt = []
        for n in frontier:
            for m in adj.get(n, []):
                if m not in depth:
                    depth[m] = depth[n] + 1
                    nxt.append(m)
        frontier = nxt
    assert got == set(depth.items())


def test_grid_tagging_cell_size_and_paths_agree(spark, tables):
    pts = tables.customer.select("c_custkey", (F.col("c_acctbal") / 100.0).alias("lat"),
                                 F.col("c_nationkey").cast("double").alias("lon"))
    zones = spark.createDataFrame([("Z1", 0.0, 20.0, 0.0, 5.0), ("Z2", 10.0, 40.0, 3.0, 12.0)],
                                  "zone_id string, min_lat double, max_lat double, min_lon double, max_lon double")
    a = tag_points(pts, zones, "lat", "lon")
    b = tag_points(pts, zones, "lat", "lon", cell_size=5.0)
    c = tag_points(pts, zones, "lat", "lon")
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_retention_and_erasure(spark):
    df = spark.createDataFrame([(1, "2020-01-01 00:00:00"), (2, "2020-12-31 00:00:00")], "k int, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert [r.k for r in gv.retain(df, "ts", 30, "2021-01-10 00:00:00").collect()] == [2]
    subj = spark.createDataFrame([(2,)], "k int")
    assert [r.k for r in gv.erase(df, "k", subj, "k").collect()] == [1]


POLICY_DOC = """
version: 1
domains:
  - name: clinical
    owner: data@example.com
    datasets:
      - name: prod.patient_visits
        sensitivity: PHI
        retention_days: 2555
        pii_columns: [mrn, patient_name]
        access:
          - role: analyst_clinical
            masking: hash
          - role: physician
            masking: none
            condition: "current_user_dept() = visit_dept"
      - name: prod.lab_results
        sensitivity: PHI
        retention_days: 2555
        pii_columns: [mrn]
        access:
          - role: physician
            masking: none
"""


def test_policy_document_loading(visits):
    with pytest.warns(UserWarning):
        pols = gv.load_policies(POLICY_DOC)
    assert set(pols) == {"prod.patient_visits", "prod.lab_results"}
    pv = gv.policy_for(pols, "prod.patient_visits")
    assert gv.apply_policy(visits, pv, "physician", session={"current_user_dept": "neuro"}).count() == 1
    with pytest.raises(gv.AccessDenied):
        gv.policy_for(pols, "prod.unknown")
    with pytest.raises(ValueError):
        gv.load_policies({"version": 2, "domains": []})


def test_sampled_classification_is_repeatable(spark, tables):
    docs = tables.documents
    a = gv.value_match_counts(docs, "documents", sample_fraction=0.5, seed=7).collect()
    b = gv.value_match_counts(docs, "documents", sample_fraction=0.5, seed=7).collect()
    full = {(r.column, r.tag): r.nonblank for r in gv.value_match_counts(docs, "documents").collect()}
    assert a == b
    assert all(r.nonblank <= full[(r.column, r.tag)] for r in a)


def test_catalog_reshape_on_literal_rows(spark):
    cols = spark.createDataFrame(
        [("DB", "PUBLIC", "USERS", "ID", "NUMBER(38,0)", "NO", None, 1),
         ("DB", "PUBLIC", "USERS", "CREATED", "TIMESTAMP_NTZ(9)", "YES", "load time", 2),
         ("DB", "PUBLIC", "USERS", "DOC", "GEOGRAPHY", "YES", None, 3),
         ("DB", "INFORMATION_SCHEMA", "TABLES", "X", "TEXT", "YES", None, 1)],
        "table_catalog string, table_schema string, table_name string, column_name string, data_type string, "
        "is_nullable string, column_comment string, ordinal_position int")
    tabs = spark.createDataFrame(
        [("DB", "PUBLIC", "USERS", "BASE TABLE", None), ("DB", "INFORMATION_SCHEMA", "TABLES", "VIEW", None)],
        "table_catalog string, table_schema string, table_name string, table_type string, table_comment string")
    flat = gv.catalog_flat(cols, tabs).collect()
    assert [(r.name, r.dataType, r.nullable, r.description) for r in flat] == [
        ("ID", "NUMBER", False, ""), ("CREATED", "TIMESTAMP", True, "load time"), ("DOC", "VARCHAR", True, "")]
    nested = gv.catalog_nested(gv.catalog_flat(cols, tabs)).collect()
    assert len(nested) == 1 and [c.name for c in nested[0].columns] == ["ID", "CREATED", "DOC"]
