"""Expectation suites on literal patient-visit rows and the promotion gate."""

import pytest

from tidewater.plans.quality import QualityGateError, Suite, gate, validate

PATIENT_SUITE = Suite("patient_visits_suite", [
    {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "mrn"}},
    {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "visit_id"}},
    {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "visit_id"}},
    {"expectation_type": "expect_column_values_to_match_regex", "kwargs": {"column": "mrn", "regex": r"^MRN-\d{7,}$"}},
    {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "age", "min_value": 0, "max_value": 130}},
    {"expectation_type": "expect_column_values_to_be_in_set",
     "kwargs": {"column": "visit_type", "value_set": ["inpatient", "outpatient", "emergency", "telehealth"]}},
    {"expectation_type": "expect_column_pair_values_a_to_be_greater_than_b",
     "kwargs": {"column_A": "discharge_ts", "column_B": "admission_ts", "or_equal": True}},
    {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 3}},
])
SCHEMA = "mrn string, visit_id string, age int, visit_type string, admission_ts int, discharge_ts int"


def _results(spark, rows):
    return {r["idx"]: r for r in validate(spark.createDataFrame(rows, SCHEMA), PATIENT_SUITE).collect()}


def test_clean_rows_pass(spark):
    rows = [("MRN-1234567", "v1", 40, "inpatient", 1, 2), ("MRN-7654321", "v2", 0, "telehealth", 5, 5),
            ("MRN-12345678", "v3", 130, "emergency", 1, 9)]
    res = _results(spark, rows)
    assert all(r["success"] for r in res.values()), res


def test_each_violation_is_counted(spark):
    rows = [("MRN-123", "v1", 131, "walk-in", 5, 4), (None, "v1", -1, None, None, 3),
            ("MRN-1234567", None, None, "inpatient", 1, 1)]
    res = _results(spark, rows)
    assert res[0]["unexpected_count"] == 1            # mrn null
    assert res[1]["unexpected_count"] == 1            # visit_id null
    assert res[2]["unexpected_count"] == 2            # v1 twice
    assert res[3]["unexpected_count"] == 1            # MRN-123 too short; NULL ignored
    assert res[4]["unexpected_count"] == 2            # 131 and -1
    assert res[5]["unexpected_count"] == 1            # walk-in
    assert res[6]["unexpected_count"] == 1 and res[6]["element_count"] == 2
    assert res[7]["success"] is True and res[7]["element_count"] == 3


def test_gate_blocks_and_passes(spark):
    bad = spark.createDataFrame([("MRN-1", "v1", 10, "inpatient", 1, 2)], SCHEMA)
    with pytest.raises(QualityGateError):
        gate(bad, PATIENT_SUITE)
    good = spark.createDataFrame([("MRN-1234567", f"v{i}", 10, "inpatient", 1, 2) for i in range(3)], SCHEMA)
    assert gate(good, PATIENT_SUITE).count() == 3


def test_suite_round_trips_json():
    import json

    text = json.dumps({"expectation_suite_name": "s", "expectations": PATIENT_SUITE.expectations})
    assert Suite.from_json(text).expectations == PATIENT_SUITE.expectations
