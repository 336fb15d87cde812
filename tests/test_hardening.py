"""Inputs that the given tables do not hold: NULL and repeated keys, late
snapshots, storage errors, deep graphs, odd names and values."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidewater import session
from tidewater.operators.keys import assign_surrogate_keys
from tidewater.operators.upsert import DuplicateKeyError, upsert_partitioned_table
from tidewater.plans import governance as gv
from tidewater.plans import telemetry as tm
from tidewater.plans import warehouse as wh
from tidewater.session import read_if_there
from tidewater.streaming import jobs


def _apply(spark, target, rows, ts, **kw):
    src = spark.createDataFrame(rows, "k int, a string")
    return wh.scd2_apply(target, src, "k", ["a"], ts, "sk", **kw)


def _rows(df):
    return sorted(((r.k is not None, r.k or 0), r.a, str(r.valid_from)[:10], str(r.valid_to)[:10], r.is_current, r.sk) for r in df.collect())


def test_scd2_null_key_is_a_key_and_idempotent(spark):
    one = _apply(spark, None, [(None, "x"), (1, "y")], "2020-01-01")
    two = _apply(spark, one, [(None, "x2"), (1, "y")], "2021-01-01")
    again = _apply(spark, two, [(None, "x2"), (1, "y")], "2021-01-01")
    assert _rows(two) == _rows(again)
    assert [(r[0][0], r[1], r[4]) for r in _rows(two)] == [(False, "x", False), (False, "x2", True), (True, "y", True)]
    assert len({r[5] for r in _rows(two)}) == 3


def test_scd2_refuses_repeated_keys_and_late_snapshots(spark):
    one = _apply(spark, None, [(1, "y")], "2020-01-01")
    with pytest.raises(DuplicateKeyError):
        _apply(spark, one, [(1, "a"), (1, "b")], "2021-01-01")
    with pytest.raises(ValueError, match="older"):
        _apply(spark, one, [(1, "z")], "2019-01-01")


def test_storage_errors_are_not_empty_tables(spark, tmp_path, monkeypatch):
    assert read_if_there(spark, str(tmp_path / "none")) is None
    sink = jobs.KeyedUpsertSink(str(tmp_path / "t"), ["k"])
    sink(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string"), 0)

    def broken(*a, **kw):
        raise AnalysisException("the store is away", errorClass="FAILED_READ_FILE.NO_HINT", messageParameters={})

    with monkeypatch.context() as m:
        m.setattr(jobs, "read_if_there", broken)
        with pytest.raises(Exception):
            sink(spark.createDataFrame([(4, "d")], "k int, v string"), 1)
    sink(spark.createDataFrame([(4, "d")], "k int, v string"), 1)
    assert sorted(r.k for r in sink.current(spark).collect()) == [1, 2, 3, 4]


def test_sinks_leave_nothing_cached(spark, tmp_path):
    held = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before = held()
    batch = spark.createDataFrame([(i % 3, dt.datetime(2024, 1, 1 + i % 2)) for i in range(9)], "k int, ts timestamp_ntz")
    dedupe = jobs.BatchDedupeSink(str(tmp_path / "out"), str(tmp_path / "seen"), ["k"], "ts")
    for b in (0, 1, 1):
        dedupe(batch, b)
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 2]
    upsert = jobs.KeyedUpsertSink(str(tmp_path / "t"), ["k"])
    for b in range(2):
        upsert(batch.dropDuplicates(["k"]), b)
    assert held() == before


def test_every_report_counts_dropped_rows():
    class Op:
        numRowsDroppedByWatermark = 2

    class Progress:
        runId, stateOperators = "r", [Op(), Op()]

    class Event:
        progress = Progress()

    listener = jobs.DroppedRows()
    for _ in range(250):
        listener.onQueryProgress(Event())
    assert listener.by_query == {"r": 1000}


def test_reachable_goes_to_the_end_or_raises(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(70)], "src int, dst int")
    starts = spark.createDataFrame([(0,)], "node int")
    assert gv.reachable(edges, starts).agg(F.max("depth"), F.count("*")).first()[:] == (70, 71)
    with pytest.raises(ValueError, match="beyond depth"):
        gv.reachable(edges, starts, max_depth=3)


POLICY = {"name": "t", "sensitivity": "high", "retention_days": 30, "pii_columns": ["mrn"], "access": [{"role": "r", "masking": "hash", "condition": "dept = current_dept()"}]}


def test_masks_follow_the_case_rule_and_values_stay_values(spark):
    df = spark.createDataFrame([("m1", "a"), ("m2", "it's"), ("m3", "back\\slash")], "MRN string, dept string")
    policy = gv.DatasetPolicy.from_dict(POLICY)
    out = gv.apply_policy(df, policy, "r", session={"current_dept": "a"}).collect()
    assert [r.dept for r in out] == ["a"] and out[0].MRN not in ("m1", None)
    for value, n in (("x' OR '1'='1", 0), ("it's", 1), ("back\\slash", 1), ("\\' OR 1=1 -- ", 0), ("", 0)):
        assert gv.apply_policy(df, policy, "r", session={"current_dept": value}).count() == n
    with pytest.raises(ValueError, match="no such columns"):
        gv.apply_policy(df.drop("MRN"), policy, "r", session={"current_dept": "a"})
    assert gv.deidentify(df, ["mrn"], []).where("MRN in ('m1', 'm2')").count() == 0


def test_anomalies_of_busy_accounts_do_not_overflow(spark):
    days = [("u", dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(6)]
    log = spark.createDataFrame([(u, dt.datetime.combine(d, dt.time(12)), "r") for u, d in days], "u string, ts timestamp_ntz, r string")
    assert gv.access_anomalies(log, "u", "ts", "r").where("kind = 'volume'").count() == 0
    big = 900_000_000
    d = big * 7 - big
    assert d * d * 6 > 2**63  # what a long could not hold
    spark.sql(f"select (cast({d} as decimal(24,0)) * cast({d} as decimal(24,0)))").collect()


def test_mean_speed_is_that_of_the_real_values(spark):
    rows = [("e%d" % i, 1, dt.datetime(2024, 1, 1), "z", 1.004, False) for i in range(3)]
    tel = spark.createDataFrame(rows, "event_id string, vehicle_id int, event_ts timestamp_ntz, geofence_id string, speed_kph double, harsh_braking boolean")
    assert abs(tm.minute_kpis(tel).first()["avg_speed_kph"] - 1.004) < 1e-12


def test_partitioned_upsert_prunes_by_literals(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(40).selectExpr("id", "id % 4 as p", "0 as v").write.partitionBy("p").parquet(path)
    before = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("p=[023]/*.parquet")}
    src = spark.createDataFrame([(1, 1, 9), (400, 1, 9)], "id long, p long, v int")
    upsert_partitioned_table(spark, path, src, ["id"], "p", str(tmp_path / "s"))
    out = spark.read.parquet(path)
    assert out.count() == 41 and out.where("v = 9").count() == 2
    assert before == {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("p=[023]/*.parquet")}


def test_no_local_folder_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(Conf)
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.checkpoint_root(Session())


def test_numbering_uses_no_global_window(spark):
    plan = assign_surrogate_keys(spark.range(50).withColumnRenamed("id", "k"), ["k"], "sk")._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_state_store_of_a_supplied_session(spark):
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == session.ROCKSDB_PROVIDER
