"""Structured Streaming over append-only sources: event-time windows, deduplication, job states, log tails."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyloom.functions.text import log_kind, log_parts
from tallyloom.session import ship
from tallyloom.sources.byte_log import follow_log


def source(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A stream over the Parquet files at path (a file or a folder)."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", max_files) if max_files else reader
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def drained(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Run a stream until its source is read and return what it wrote; path holds rows and progress."""
    spark = stream.sparkSession
    if mode == "append":
        query = stream.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/progress")
    else:
        def keep(rows: DataFrame, epoch: int) -> None:
            rows.write.mode("overwrite").parquet(f"{path}/rows/epoch={epoch}")
        query = stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{path}/progress")
    query.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(stream.schema if mode == "append" else stream.schema.add("epoch", "long")).parquet(f"{path}/rows")
    if mode == "append":
        return rows
    last = rows.agg(F.max("epoch").alias("epoch"))
    return rows.join(F.broadcast(last), "epoch").drop("epoch") if mode == "complete" else rows


def tumbling(events: DataFrame, at: str, width: str, *keys: str, late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """(start, keys, n, total) by event-time windows; rows later than `late` are dropped in a stream."""
    w = F.window(F.col(at), width, slide) if slide else F.window(F.col(at), width)
    own = events.withWatermark(at, late) if events.isStreaming else events
    return own.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(20,6)")).alias("total")).select(F.col("w.start").alias("start"), *keys, "n", "total")


def sessions(events: DataFrame, at: str, gap: str, key: str, late: str = "10 minutes") -> DataFrame:
    """(key, start, end, n) of runs of rows no more than gap apart: silence splits them."""
    own = events.withWatermark(at, late) if events.isStreaming else events
    return own.groupBy(F.session_window(F.col(at), gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def once(events: DataFrame, at: str, late: str, *keys: str) -> DataFrame:
    """The first row of each key within the watermark."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(list(keys)) if events.isStreaming else events.dropDuplicates(list(keys))


JOB = "job_id long, status string, seen timestamp, changes int"


def job_states(events: DataFrame, stale: str = "60 seconds") -> DataFrame:
    """(job_id, status, seen, changes) whenever a job's state changes; a running job that is silent is interrupted.

    events: (job_id long, at timestamp, status string). Silence is measured in event time, by the watermark.
    """
    ship(events.sparkSession)
    wait = int(pd.Timedelta(stale).total_seconds() * 1000)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status, seen, n = state.get if state.exists else ("", None, 0)
        if state.hasTimedOut:
            state.remove()
            if status == "running":
                yield pd.DataFrame([(key[0], "interrupted", seen, n + 1)], columns=["job_id", "status", "seen", "changes"])
            return
        rows = pd.concat(list(batches)).sort_values("at")
        changed = rows[rows["status"].ne(rows["status"].shift(fill_value=status))]
        n += len(changed)
        status, seen = rows["status"].iloc[-1], rows["at"].iloc[-1]
        state.update((status, seen.to_pydatetime(), n))
        state.setTimeoutTimestamp(int(seen.timestamp() * 1000) + wait)
        yield pd.DataFrame([(key[0], status, seen, n)], columns=["job_id", "status", "seen", "changes"])

    return events.withWatermark("at", stale).groupBy("job_id").applyInPandasWithState(
        step, JOB, "status string, seen timestamp, changes int", "append", GroupStateTimeout.EventTimeTimeout)


def log_lines(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """Lines as they are appended: (file, offset, ts, msg, kind). A file that has grown is read from where it ended."""
    own = follow_log(spark, path, suffix).select("file", "offset", log_parts(F.col("line")).alias("p"))
    return own.select("file", "offset", "p.ts", "p.msg", log_kind(F.col("p.msg")).alias("kind"))


#: What a message that moves a job to the next stage contains.
STAGES = (("download", r"Step 1:"), ("vad", r"Step 2:|Splitting video by VAD|existing clips found"), ("face", r"Step 3:|Processing clips\.\.\."))


def log_state(lines: DataFrame, job: str, order: str) -> DataFrame:
    """(job, videos, current_video, stage, position, total, errors) from lines (job, order, msg), by aggregates alone."""
    msg = F.col("msg")
    video = F.nullif(F.coalesce(F.nullif(F.regexp_extract(msg, r"(?i)Processing video\s+\d+/\d+:\s*(\S+)", 1), F.lit("")), F.regexp_extract(msg, r"(?i)Step 1:.*?video:\s*(\S+)", 1)), F.lit(""))
    stage = None
    for name, mark in STAGES:
        stage = F.when(msg.rlike(f"(?i){mark}"), name) if stage is None else stage.when(msg.rlike(f"(?i){mark}"), name)
    at = lambda i: F.nullif(F.regexp_extract(msg, r"(?i)Processing video\s+(\d+)/(\d+)", i), F.lit("")).cast("int")
    told = lines.select(job, order, video.alias("video"), stage.alias("stage"), at(1).alias("pos"), at(2).alias("of"), log_kind(msg).alias("kind"))
    newest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
    sums = told.groupBy(job).agg(
        F.count_distinct("video").alias("videos"), newest("video"), newest("stage"), newest("pos"), newest("of"), F.count_if(F.col("kind") == "error").alias("errors"),
        F.max(F.when(F.col("video").isNotNull(), F.col(order))).alias("began"), F.max(F.when(F.col("stage").isNotNull(), F.col(order))).alias("moved"))
    current = F.when(F.col("moved") >= F.coalesce("began", "moved"), F.col("stage"))
    return sums.select(job, "videos", F.col("video").alias("current_video"), current.alias("stage"), F.coalesce("pos", F.lit(0)).alias("position"), F.coalesce("of", F.lit(0)).alias("total"), "errors")
