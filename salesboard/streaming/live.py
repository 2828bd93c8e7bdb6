"""End-to-end live run over a table-derived log (used by the catalogue and tests).

The log (``raw_ticks``, one record per ``events`` row) is cut into ordinal
ranges by the feeder.  Ranges are published one by one, the last two as a backlog;
after each arrival every streaming query runs with ``availableNow`` (each resumes
from its own checkpoint, exactly as after a restart) and takes one arrival a batch.
Finally one empty file is published (the job must skip the empty batch) and the last
batch with rows is replayed through ``process_batch`` (the log must not change).

Queries run on the whole log; all folders are new sub-folders of the
session's scratch root (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from salesboard.operators.state import publish_state
from salesboard.session import conf_override, fresh_dir
from salesboard.sources.topic import read_envelope_files
from salesboard.streaming import native as N
from salesboard.streaming.feeder import Feeder
from salesboard.streaming.job import JobConfig, process_batch, run
from salesboard.streaming.totals import ServingConfig, run_totals

N_CHUNKS = 4
ENVELOPE_COLUMNS = ["topic", "partition", "offset", "timestamp", "value"]


@dataclass
class LiveRun:
    root: str
    cfg: JobConfig
    serving: ServingConfig
    source: str
    staging: str
    paths: dict = field(default_factory=dict)
    batches_committed: int = 0


_RUNS: dict[tuple[str, str], LiveRun] = {}


def live_run(spark: SparkSession, log: DataFrame, key: str, n_chunks: int = N_CHUNKS) -> LiveRun:
    """Run (once per Spark application and ``key``) and return the output folders."""
    memo = (spark.sparkContext.applicationId, key)
    if memo in _RUNS:
        return _RUNS[memo]
    root = fresh_dir(spark, "live")
    ck = f"{root}/checkpoints"
    lr = LiveRun(root=root, cfg=JobConfig(state_root=f"{root}/state", stream_id="s0"),
                 serving=ServingConfig(root=f"{root}/serving", checkpoint=f"{ck}/totals"),
                 source=f"{root}/source", staging=f"{root}/staging")
    feeder = Feeder(spark, log, lr.staging, lr.source, n_chunks, keep=ENVELOPE_COLUMNS)
    p = lr.paths
    for name in ("points", "raw", "published"):
        p[name] = f"{root}/out/{name}"

    def source():
        return read_envelope_files(spark, lr.source, max_files_per_trigger=feeder.files)

    def start_all():
        raw = source()
        return [
            run(raw, lr.cfg, f"{ck}/job"),
            run_totals(raw, lr.serving),
            N.append_sink(N.native_trend(N.valid_stream(raw)), p["points"], f"{ck}/points"),
            N.append_sink(raw, p["raw"], f"{ck}/raw"),
        ]

    # stateful queries fix their state partitions at first start: size them to
    # the cluster's cores, not to a batch-job default (state here is small)
    state_parts = str(max(8, spark.sparkContext.defaultParallelism))
    with conf_override(spark, {"spark.sql.shuffle.partitions": state_parts}):
        backlog = max(0, n_chunks - 2)
        for arrivals in [[k] for k in range(backlog)] + [list(range(backlog, n_chunks))]:
            for k in arrivals:
                feeder.publish(k)
            for sq in start_all():
                sq.awaitTermination()
        # an empty arrival: the job sees a new batch with no rows and must skip it
        feeder.publish_empty()
        run_totals(source(), lr.serving).awaitTermination()
    job = run(source(), lr.cfg, f"{ck}/job")
    job.awaitTermination()
    lr.batches_committed = (job.lastProgress or {}).get("batchId", -1) + 1
    # a crash after the outputs but before the commit: the last batch runs again
    process_batch(feeder.chunk(n_chunks - 1), n_chunks - 1, lr.cfg)
    publish_state(spark, lr.serving.checkpoint, p["published"])
    _RUNS[memo] = lr
    return lr
