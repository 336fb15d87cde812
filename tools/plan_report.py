"""Summarise the physical plan of every registered query into PLANS.md.

    python tools/plan_report.py [sf_dir]

Counts shuffles (Exchange), join strategies and aggregate kinds from
``explain()`` and notes pushed-down filters — a quick scale review.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPS = [
    ("Exchange hashpartitioning", "hash shuffles"),
    ("Exchange rangepartitioning", "range shuffles"),
    ("Exchange RoundRobinPartitioning", "round-robin"),
    ("BroadcastHashJoin", "broadcast joins"),
    ("SortMergeJoin", "sort-merge joins"),
    ("HashAggregate", "hash aggs"),
    ("SortAggregate", "sort aggs"),
    ("Window", "windows"),
]


def main() -> None:
    from tidewater.registry import all_queries
    from tidewater.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `tools/plan_report.py` on `{sf_dir}` (initial AQE plans; staged inputs",
        "such as dimensions appear as Parquet scans). Counts are operator occurrences.",
        "",
        "| query | " + " | ".join(label for _, label in OPS) + " | pushed filters |",
        "|---|" + "---|" * (len(OPS) + 1),
    ]
    for name, fn in sorted(all_queries().items()):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf_dir).explain()
        plan = buf.getvalue()
        counts = [str(plan.count(op)) for op, _ in OPS]
        pushed = sorted({m for m in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if m})
        lines.append(f"| {name} | " + " | ".join(counts) + f" | {'; '.join(pushed)[:120]} |")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
