"""Alerts, KPIs and archive as one application.

A job is a streaming frame, a sink and a trigger interval. The runner starts all
jobs together, each with its own checkpoint under one root, so that a restarted
runner goes on where every job stopped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewater.session import scratch_path

#: Trigger intervals of the hot, warm and cold path.
ALERT_INTERVAL, KPI_INTERVAL, ARCHIVE_INTERVAL = "2 seconds", "10 seconds", "60 seconds"
FILE_FORMATS = ("parquet", "json", "csv", "orc")


@dataclass(frozen=True)
class Sink:
    """Where a job writes. ``kafka`` needs ``options`` with servers and topic and
    a frame of ``key, value``; file formats a ``path``; ``memory`` keeps a table of
    the job's name in the driver (tests); ``batches`` is a function of a
    micro-batch and its id."""

    format: str
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    batches: Callable[[DataFrame, int], None] | None = None

    def __post_init__(self):
        if self.format == "batches" and self.batches is None:
            raise ValueError("a batches sink needs a function")
        if self.format in FILE_FORMATS and not self.path:
            raise ValueError(f"a {self.format} sink needs a path")
        if self.format == "kafka" and not {"kafka.bootstrap.servers", "topic"} <= set(self.options):
            raise ValueError("a kafka sink needs kafka.bootstrap.servers and topic")
        if self.format not in (*FILE_FORMATS, "kafka", "memory", "noop", "batches"):
            raise ValueError(f"unknown sink format {self.format!r}")


@dataclass(frozen=True)
class Job:
    """``interval`` is a processing-time trigger; None takes what is there and
    ends."""

    name: str
    frame: DataFrame
    sink: Sink
    interval: str | None = None
    mode: str = "append"


class JobRunner:
    """Starts jobs together and watches them. ``root`` (in the shared folder)
    holds a checkpoint per job. A memory table does not outlive its query, so a
    memory job reads its source from the start each time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.jobs = spark, root.rstrip("/"), {}
        self.queries: dict[str, StreamingQuery] = {}

    def add(self, job: Job) -> JobRunner:
        if job.name in self.jobs:
            raise ValueError(f"two jobs are named {job.name!r}")
        self.jobs[job.name] = job
        return self

    def _start(self, job: Job) -> StreamingQuery:
        sink = job.sink
        where = scratch_path(self.spark, f"memory-{job.name}") if sink.format == "memory" else f"{self.root}/{job.name}"
        w = job.frame.writeStream.queryName(job.name).outputMode(job.mode).option("checkpointLocation", where)
        if sink.format == "batches":
            w = w.foreachBatch(sink.batches)
        else:
            w = w.format(sink.format).options(**sink.options)
            w = w.option("path", sink.path) if sink.path else w
            w = w.partitionBy(*sink.partition_by) if sink.partition_by else w
        w = w.trigger(availableNow=True) if job.interval is None else w.trigger(processingTime=job.interval)
        return w.start()

    def start(self) -> JobRunner:
        """Start every job that is not running. If one cannot start, those already
        started are stopped and the error is raised."""
        try:
            for name, job in self.jobs.items():
                if name not in self.queries or not self.queries[name].isActive:
                    self.queries[name] = self._start(job)
        except Exception:
            self.stop()
            raise
        return self

    def failures(self) -> dict[str, str]:
        return {n: str(q.exception()) for n, q in self.queries.items() if q.exception() is not None}

    def drain(self) -> None:
        """Wait until every job has processed what is there; a failed job raises."""
        for q in self.queries.values():
            q.processAllAvailable() if q.isActive else q.awaitTermination()
        if failed := self.failures():
            raise RuntimeError(f"jobs failed: {failed}")

    def stop(self) -> None:
        for q in self.queries.values():
            q.stop()

    def __enter__(self) -> JobRunner:
        return self.start()

    def __exit__(self, *_) -> None:
        self.stop()
