"""Benchmark: headline queries on $BENCH_SF_DIR (default sf0.1) on
local[$BENCH_CPUS]; prints ONE JSON line.

Each query is executed to completion with the ``noop`` sink (full
computation, nothing collected to the driver). ``rows_per_sec`` relates the
query time to the rows of its main input table, for comparison with the
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = {
    # query name: main input table (for rows/s)
    "scd2_dimension": "customer",
    "pit_fact_sales": "lineitem",
    "sales_daily_enriched": "lineitem",
    "sales_daily_incremental": "lineitem",
    "kpi_minute": "events",
    "alerts_union": "events",
    "kpi_stream": "events",
    "suite_orders": "orders",
    "classify_values": "documents",
    "text_pii_scan": "documents",
    "access_anomalies": "events",
    "lineage_reach": "lineitem",
}


def stream_throughput(spark, sf_dir: str) -> dict:
    """Events/s the alert (stateless) and KPI (stateful) streams sustain (all rows
    over all trigger time), from
    their own progress reports, on the events table replayed as files."""
    from tidewater.plans import telemetry as tm
    from tidewater.registry import load
    from tidewater.session import scratch_path
    from tidewater.streaming import jobs

    ev = load(spark, sf_dir, "events")
    src = scratch_path(spark, "bench-events")
    jobs.stage_files(ev, src, 8, "ts")
    out = {}
    for name, build in (("alerts", jobs.alert_stream), ("kpi", jobs.kpi_stream)):
        stream = tm.telemetry_from_events(jobs.file_stream(spark, src, ev.schema, max_files_per_trigger=4))
        q = jobs.run_available_now(
            jobs.write_parquet(build(stream), scratch_path(spark, f"bench-{name}"), scratch_path(spark, f"bench-{name}-ckpt"))
        )
        done = [p for p in q.recentProgress if p.get("numInputRows")]
        seconds = sum(p["durationMs"]["triggerExecution"] for p in done) / 1000
        out[name] = round(sum(p["numInputRows"] for p in done) / seconds, 1) if seconds else None
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:]]
    from tidewater.registry import all_queries, load
    from tidewater.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="tidewater-bench")
    qs = all_queries()
    counts = {t: load(spark, sf_dir, t).count() for t in set(HEADLINE.values())}
    # warm-up on the smallest scale: JIT-compiles the code paths once, so the
    # timings below are steady-state throughput, as on a long-running cluster
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in HEADLINE:
            if not only or name in only:
                qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times, rates = {}, {}
    for name, table in HEADLINE.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        dt = time.perf_counter() - t0
        times[name] = round(dt, 3)
        rates[name] = round(counts[table] / dt, 1) if dt > 0 else None
    stream_rates = {} if only else stream_throughput(spark, sf_dir)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows_per_sec": rates,
        "stream_rows_per_sec": stream_rates,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
