"""Uploads that become complete, outcomes and job tables as streams."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from simquarry.functions import fixed_values as fv
from simquarry.session import freeze
from simquarry.streaming.ordered import in_order, to_micros, to_time


_LANDINGS = "ticket_id long, collection string, times long, n_landings long"
_TOLD = "ticket_id long, n_landings long"


def take_markers(markers: DataFrame, batch: int, path: str) -> None:
    """Take the markers of micro-batch ``batch`` into the folder at ``path``.

    The marked landings of open tickets are a table with one version a batch, made
    from the one before; tickets that are complete leave it and are told.  A batch
    that runs again writes the same.
    """
    spark = markers.sparkSession
    found = markers.where((F.col("name") == fv.COMPLETION_MARKER) & (F.col("size") > 0)).select("collection").distinct()
    told = complete_tickets(spark, path, batch).select("ticket_id")
    new = spark.read.schema(_LANDINGS).parquet(f"{path}/landings").join(found, "collection").join(told, "ticket_id", "left_anti")
    held = spark.read.schema(_LANDINGS).parquet(f"{path}/open/batch={batch - 1}")
    marked = freeze(held.unionByName(new).distinct())
    done = freeze(marked.groupBy("ticket_id", "n_landings").agg(F.sum("times").alias("seen")).where("seen = n_landings").drop("seen"))
    marked.join(done, "ticket_id", "left_anti").write.mode("overwrite").parquet(f"{path}/open/batch={batch}")
    done.write.mode("overwrite").parquet(f"{path}/told/batch={batch}")


def complete_tickets(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Tickets told by ``completion_stream``, once each: ticket_id, n_landings."""
    told = spark.read.schema(f"{_TOLD}, batch int").parquet(f"{path}/told")
    return (told if before is None else told.where(F.col("batch") < before)).select("ticket_id", "n_landings")


def completion_stream(parts: DataFrame, markers: DataFrame, path: str) -> StreamingQuery:
    """Tell tickets as their last non-empty marker arrives; see ``complete_tickets``.

    ``parts`` is the static table of parsed entries, ``markers`` a stream of catalog
    objects that may come more than once.  What is kept between micro-batches is the
    marked landings of open tickets, on shared storage: a complete ticket leaves them,
    and the tickets told are what the stream has written anyway.  A version before
    the last one may be removed.
    """
    spark, ok = markers.sparkSession, parts.where("ok")
    valid = ok.groupBy("collection", "ticket_id").agg(F.count(F.lit(1)).alias("times"))
    wanted = ok.groupBy("ticket_id").agg(F.count(F.lit(1)).alias("n_landings"))
    valid.join(wanted, "ticket_id").select("ticket_id", "collection", "times", "n_landings").write.parquet(f"{path}/landings")
    spark.createDataFrame([], _LANDINGS).write.parquet(f"{path}/open/batch=-1")
    spark.createDataFrame([], _TOLD).write.parquet(f"{path}/told/batch=-1")
    return (
        markers.writeStream.option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(lambda df, batch: take_markers(df, batch, path))
        .start()
    )


def outcome_stream(log: DataFrame) -> DataFrame:
    """Last line per bundle of a streamed log; write it in update mode.

    Only changed bundles come out of a micro-batch, so the cost follows the new
    lines; ``bundles.latest_outcomes`` over the written rows is the view.
    """
    rest = [c for c in log.columns if c not in ("bundle", "seq")]
    return (
        log.groupBy("bundle")
        .agg(F.max(F.struct("seq", *rest)).alias("r"))
        .select("bundle", "r.seq", *[f"r.{c}" for c in rest])
    )


_JOB_OUTPUT = (
    "job_id long, micros long, seq long, applied boolean, status string, num_attempts int, exit_code int, started_at long, finished_at long"
)
_JOB_STATE = "status string, num_attempts int, exit_code int, started_at long, finished_at long"


def job_step(state: tuple | None, ts, kind: str, exit_code, retryable: bool, max_attempts: int = fv.MAX_ATTEMPTS):
    """Job (status, attempts, exit code, started, finished) after one event.

    ``kind`` is enqueue, claim or end.  An event that does not fit the status
    changes nothing; a retry can be claimed once its back-off is over.
    """
    if state is None:
        return ("pending", 0, None, None, None) if kind == "enqueue" else None
    status, attempts, code, started, finished = state
    if kind == "claim" and status == "pending":
        wait = min(fv.BACKOFF_BASE_MIN * fv.BACKOFF_FACTOR ** min(max(attempts - 1, 0), 10), fv.BACKOFF_CAP_MIN)
        if finished is None or finished + timedelta(minutes=wait) <= ts:
            return ("running", attempts, code, ts, finished)
    if kind == "end" and status == "running":
        if exit_code == 0:
            return ("succeeded", attempts, 0, started, ts)
        if exit_code is not None and retryable and attempts < max_attempts:
            return ("pending", attempts + 1, exit_code, None, ts)
        return ("failed", attempts, exit_code, started, ts)
    return state


def _job_event(state: tuple | None, event: Row) -> tuple[tuple, list[Row]]:
    held = None
    if state is not None and state[0] is not None:
        held = (*state[:3], to_time(state[3]), to_time(state[4]))
    after = job_step(held, to_time(event.micros), event.kind, event.exit_code, bool(event.retryable))
    status, attempts, code, started, finished = after or (None,) * 5
    row = (status, attempts, code, to_micros(started), to_micros(finished))
    names = ("status", "num_attempts", "exit_code", "started_at", "finished_at")
    return row, [Row(job_id=event.job_id, micros=event.micros, seq=event.seq, applied=after != held, **dict(zip(names, row, strict=True)))]


def job_stream(events: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Row of the job after each event (job_id, ts, seq, kind, exit_code, retryable).

    Events of a job are applied in the order of (ts, seq) once the watermark has
    passed them; ``applied`` tells whether the event fitted.
    """
    typed = events.selectExpr(
        "cast(job_id as long) as job_id", "ts", "cast(seq as long) as seq", "kind", "cast(exit_code as int) as exit_code", "retryable",
    )
    out = in_order(typed, "job_id", _job_event, _JOB_STATE, _JOB_OUTPUT, lateness)
    time = lambda c: F.timestamp_micros(c).alias("ts" if c == "micros" else c)
    return out.select("job_id", time("micros"), "seq", "applied", "status", "num_attempts", "exit_code", time("started_at"), time("finished_at"))


def current_jobs(rows: DataFrame) -> DataFrame:
    """The job table: the row after the latest event of each job."""
    rest = ["status", "num_attempts", "exit_code", "started_at", "finished_at"]
    return (
        rows.groupBy("job_id")
        .agg(F.max(F.struct("ts", "seq", *rest)).alias("r"))
        .select("job_id", *[f"r.{c}" for c in rest])
    )
