"""The state of processing jobs, folded from their log lines: as a batch over all lines, and as a stream with keyed state.

A line may begin another video, which resets what is kept for a video (stage, stages done or failed, clip counters), while
totals of the job stay. The batch form keeps only lines that say something (marks), numbers the segments between resets by
running sums, reduces each segment by aggregates and takes the last one of each job. The stream keeps the same state by
job in RocksDB: scalars as a value, errors in order as a list, videos and stages as maps, and a timer of silence.

Lines are (job, order, msg), in a stream with their time too. Defined cases: orders are unique in a job; a null message says
nothing; in a stream a line whose order isn't above the last one of its job is late: it is counted and changes nothing.
"""

from __future__ import annotations

import contextlib
import functools
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tallyloom.functions.text import log_kind
from tallyloom.session import ship

#: The stages of a video, in order.
STAGES = ("download", "vad", "face", "asd", "asr", "export", "quality")
#: What lines say, case aside.
SAYS = {
    "batch": r"Processing video\s+(\d+)/(\d+):\s*(\S+)",
    "step1": r"Step 1:",
    "video": r"video:\s*(\S+)",
    "step2": r"Step 2:|Splitting video by VAD|existing clips found",
    "step3": r"Step 3:|Processing clips\.\.\.",
    "to_process": r"(\d+)\s+clips?\s+to\s+process",
    "face": r"\]\s*face detection",
    "asd": r"\]\s*ASD scoring|\]\s*SyncNet verification",
    "asr": r"\]\s*transcribing",
    "export": r"\]\s*exporting LRS2",
    "quality": r"^Speaker identity \[|^Auto-set metadata for",
    "speakers": r"→\s*(\d+)\s+speakers?",
    "clip": r"CLIP\s+(\d+)/(\d+)\s+(dropped|exported)",
    "summary": r"Exported\s+(\d+)\s+segments?",
    "failed": r"Pipeline failed for\s+(\S+?)\s*:",
    "finished": r"Pipeline finished(?!\s+with\s+errors)|Process exited with code 0",
    "broken": r"Process exited with code [^0]|Pipeline finished with errors",
}
SUBSTAGES = ("face", "asd", "asr", "export", "quality")
#: Stages that begin together, and stages that a summary of exports ends.
OPENED, EXPORTED = ("face", "asd", "asr", "export"), ("face", "asd", "asr", "export")
STATE = """stage string, done array<string>, errors array<string>, opened array<string>, video string, position int, total int, videos int,
    finished int, failed int, exported bigint, clip int, clips int, speakers bigint"""


def _says(msg: Column, what: str) -> Column:
    return msg.rlike(f"(?i){SAYS[what]}")


def _part(msg: Column, what: str, i: int) -> Column:
    return F.nullif(F.regexp_extract(msg, f"(?i){SAYS[what]}", i), F.lit(""))


def read_lines(lines: DataFrame, job: str, order: str, msg: str = "msg") -> DataFrame:
    """lines as (job, order, msg) with what each says; a line of the first four kinds says nothing else."""
    m = F.regexp_replace(F.coalesce(F.col(msg), F.lit("")), r"^\s+|\s+$", "")
    own = lines.select(F.col(job).alias("job"), F.col(order).cast("bigint").alias("order"), m.alias("msg"))
    m = F.col("msg")
    kind = F.when(_says(m, "batch"), "batch").when(_says(m, "step1"), "step1").when(_says(m, "step2"), "step2").when(_says(m, "step3"), "step3").otherwise("other")
    own = own.withColumn("line", kind)
    sub = None
    for name in SUBSTAGES:
        sub = F.when(_says(m, name), name) if sub is None else sub.when(_says(m, name), name)
    other = F.col("line") == "other"
    only = lambda c: F.when(other, c)
    own = own.withColumns({
        "mention": F.when(F.col("line") == "batch", _part(m, "batch", 3)).when(F.col("line") == "step1", _part(m, "video", 1)), "substage": only(sub),
        "to_process": only(_part(m, "to_process", 1).cast("int")), "clip": only(_part(m, "clip", 1).cast("int")), "clips": only(_part(m, "clip", 2).cast("int")), "end": only(F.lower(_part(m, "clip", 3))),
        "summary": only(_part(m, "summary", 1).cast("bigint")), "failed": only(_part(m, "failed", 1)), "finished": other & _says(m, "finished"), "broken": other & _says(m, "broken"),
    })
    told = own.withColumns({
        "position": F.when(F.col("line") == "batch", _part(m, "batch", 1).cast("int")), "total": F.when(F.col("line") == "batch", _part(m, "batch", 2).cast("int")),
        "speakers": F.when(F.col("substage") == "quality", _part(m, "speakers", 1).cast("bigint")),
        "sets": F.when(F.col("line") == "step1", "download").when(F.col("line") == "step2", "vad").when(F.col("line") == "step3", "face").otherwise(F.col("substage")),
    })
    # a generator keeps later filters from being pushed into the patterns, which would match each line twice
    return told.select(F.inline(F.array(F.struct(*told.columns))))


def _segments(read: DataFrame) -> DataFrame:
    """read with the number of its segment, and the stage before and after each line."""
    by_job = Window.partitionBy("job").orderBy("order")
    before = F.last("mention", True).over(by_job.rowsBetween(Window.unboundedPreceding, -1))
    reset = (F.col("line") == "batch") | ((F.col("line") == "step1") & F.col("mention").isNotNull() & ~F.col("mention").eqNullSafe(before))
    told = read.withColumn("reset", reset.cast("int")).withColumn("segment", F.sum("reset").over(by_job.rowsBetween(Window.unboundedPreceding, 0)))
    within = Window.partitionBy("job", "segment").orderBy("order")
    return told.withColumns({"was": F.last("sets", True).over(within.rowsBetween(Window.unboundedPreceding, -1)), "now": F.last("sets", True).over(within.rowsBetween(Window.unboundedPreceding, 0))})


def feed(lines: DataFrame, job: str, order: str, msg: str = "msg") -> DataFrame:
    """(job, order, msg, kind, stage): every line with its kind, and the stage that it belongs to where one is known."""
    told = _segments(read_lines(lines, job, order, msg))
    within = Window.partitionBy("job", "segment").orderBy("order").rowsBetween(Window.unboundedPreceding, 0)
    broken = F.max(F.col("failed").isNotNull() | F.col("broken")).over(within)
    stage = F.when(F.col("line") != "batch", F.coalesce("now", F.when(broken, "download")))
    return told.select(F.col("job").alias(job), F.col("order").alias(order), "msg", F.when(F.col("line") == "batch", "info").otherwise(log_kind(F.col("msg"))).alias("kind"), stage.alias("stage"))


def fold(lines: DataFrame, job: str, order: str, msg: str = "msg") -> DataFrame:
    """(job and the columns of STATE) after all lines, one row for each job."""
    read = read_lines(lines, job, order, msg)
    said = ["mention", "sets", "to_process", "clip", "summary", "failed"]
    marks = read.filter((F.col("line") != "other") | F.col("finished") | F.col("broken") | F.coalesce(*[F.col(c).cast("string") for c in said]).isNotNull())
    told = _segments(marks.drop("msg"))
    # what a line does, in the order in which it does it: fail, finish, break
    at = lambda k: F.col("order") * 3 + k
    stage = F.coalesce("now", F.lit("download"))
    told = told.withColumns({"fails_at": F.when(F.col("failed").isNotNull(), at(0)), "ends_at": F.when(F.col("finished"), at(1)), "breaks_at": F.when(F.col("broken"), at(2)), "at_stage": stage})
    latest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("order")))
    clips = F.coalesce("clips", "to_process")
    first_error = lambda s: F.min(F.when(F.col("at_stage") == s, F.least("fails_at", "breaks_at")))
    passed = {"download": (F.col("line") == "step2") & (F.col("was") == "download"), "vad": (F.col("line") == "step3") & (F.col("was") == "vad")}
    done = lambda s: F.coalesce(F.max(F.col("summary").isNotNull() if s in EXPORTED else passed.get(s, F.lit(False))), F.lit(False))
    segments = told.groupBy("job", "segment").agg(
        latest("sets").alias("stage"), latest("mention").alias("video"), F.coalesce(latest("clip"), F.lit(0)).alias("clip"),
        F.coalesce(F.max_by(clips, F.when(clips.isNotNull(), F.col("order"))), F.lit(0)).alias("clips"), F.min("ends_at").alias("ends_at"),
        F.struct(*[first_error(s).alias(s) for s in STAGES]).alias("error_at"), F.struct(*[done(s).alias(s) for s in STAGES]).alias("passed"),
        F.collect_set("sets").alias("set"), F.max(F.col("line") == "step3").alias("opens"),
        # what counts for the whole job
        F.max(F.when(F.col("position").isNotNull(), F.struct("order", "position", "total"))).alias("place"), F.max(F.col("summary").isNotNull()).alias("summed"), F.collect_set("failed").alias("failed"),
        F.count_if(F.col("end") == "exported").alias("exported"), F.min(F.when(F.col("end") == "exported", F.col("order"))).alias("first_export"),
        F.min(F.when(F.col("summary") > 0, F.struct("order", "summary"))).alias("first_summary"), F.coalesce(F.sum("speakers"), F.lit(0)).alias("speakers"),
    )
    e = lambda s: F.col("error_at")[s]
    is_done = lambda s: F.col("passed")[s] | F.coalesce((F.col("ends_at").isNotNull()) & (e(s).isNull() | (e(s) > F.col("ends_at"))), F.lit(False))
    listed = lambda test: F.array_compact(F.array(*[F.when(test(s), s) for s in STAGES]))
    opened = lambda s: F.array_contains("set", s) | e(s).isNotNull() | (F.col("opens") if s in OPENED else F.lit(False))
    segments = segments.withColumns({"done": listed(is_done), "errors": listed(lambda s: e(s).isNotNull()), "opened": listed(opened)})
    last = F.struct("segment", "stage", "done", "errors", "opened", "clip", "clips")
    jobs = segments.groupBy("job").agg(
        F.max_by(last, "segment").alias("x"), F.max_by("video", F.when(F.col("video").isNotNull(), F.col("segment"))).alias("video"), F.max("place").alias("place"),
        F.size(F.collect_set("video")).alias("videos"), F.size(F.collect_set(F.when(F.col("summed"), F.col("video")))).alias("finished"),
        F.size(F.array_distinct(F.flatten(F.collect_list("failed")))).alias("failed"), F.sum("exported").alias("n"), F.min("first_export").alias("first_export"),
        F.min("first_summary").alias("first_summary"), F.sum("speakers").alias("speakers"),
    )
    summary_first = F.col("first_summary").isNotNull() & (F.col("first_export").isNull() | (F.col("first_summary.order") < F.col("first_export")))
    exported = F.col("n") + F.when(summary_first, F.col("first_summary.summary")).otherwise(0)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("int")
    silent = read.select("job").distinct()
    told = silent.alias("s").join(jobs.alias("j"), F.col("s.job").eqNullSafe(F.col("j.job")), "left")
    none = F.array().cast("array<string>")
    return told.select(
        F.col("s.job").alias(job), "x.stage", *[F.coalesce(f"x.{c}", none).alias(c) for c in ("done", "errors", "opened")], "video", zero(F.col("place.position")).alias("position"), zero(F.col("place.total")).alias("total"),
        zero(F.col("videos")).alias("videos"), zero(F.col("finished")).alias("finished"), zero(F.col("failed")).alias("failed"), F.coalesce(exported, F.lit(0)).alias("exported"),
        zero(F.col("x.clip")).alias("clip"), zero(F.col("x.clips")).alias("clips"), F.coalesce("speakers", F.lit(0)).alias("speakers"),
    )


_PATTERNS = {name: re.compile(p, re.I | re.A) for name, p in SAYS.items()}
NOW = """stage string, video string, position int, total int, exported bigint, clip int, clips int, speakers bigint, last bigint, late bigint, over boolean,
    videos int, finished int, failed int, done string, errors string, opened string""".replace("\n", "")
NOW_NAMES = [x.split()[0] for x in NOW.split(", ")]
OUT = f"job bigint, {STATE}, last bigint, late bigint, silent boolean".replace("\n", "")
OUT_NAMES = [x.split()[0] for x in OUT.split(", ")]
FLAGS = ("seen", "finished", "failed")


@functools.lru_cache(4096)
def _read(m: str) -> tuple[str, tuple]:
    """What a line says, as (kind, (name, its groups)...); logs repeat many of their lines."""
    for name in ("batch", "step1", "step2", "step3"):
        if hit := _PATTERNS[name].search(m):
            video = _PATTERNS["video"].search(m) if name == "step1" else None
            return name, hit.groups() if name == "batch" else (video and video[1],)
    return "other", tuple((name, hit.groups()) for name in _OTHERS if (hit := _PATTERNS[name].search(m)))


_OTHERS = ("to_process", *SUBSTAGES, "speakers", "clip", "summary", "failed", "finished", "broken")


class JobLog(StatefulProcessor):
    """Keyed state of a job; emits the state after each batch of its lines, and once more if it falls silent before its end.

    A batch reads and writes a job's scalars and stages once, and of its videos those that its lines name.
    """

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.now = handle.getValueState("now", NOW)
        self.videos = handle.getMapState("videos", "video string", "seen boolean, finished boolean, failed boolean")

    def close(self) -> None:
        pass

    def _video(self, s: dict, video: str, flag: str) -> None:
        """Set a flag of a video; named holds those of the batch as (stored, now)."""
        named = s["named"]
        if video not in named:
            held = None if s["new"] else self.videos.getValue((video,))
            named[video] = (held and tuple(held), tuple(held or (False, False, False)))
        stored, flags = named[video]
        i = FLAGS.index(flag)
        if not flags[i]:
            s["videos" if flag == "seen" else flag] += 1
            named[video] = (stored, (*flags[:i], True, *flags[i + 1 :]))

    @staticmethod
    def _reset(s: dict, video: str | None) -> None:
        s |= {"stage": None, "clip": 0, "clips": 0, "video": video, "done": set(), "errors": set(), "opened": set()}

    @staticmethod
    def _error(s: dict) -> None:
        stage = s["stage"] or "download"
        s["errors"].add(stage)
        s["opened"].add(stage)

    def step(self, s: dict, m: str) -> None:
        """One line."""
        kind, said = _read(m)
        if kind == "batch":
            s |= {"position": int(said[0]), "total": int(said[1]), "over": False}
            self._reset(s, said[2])
            self._video(s, said[2], "seen")
            return
        if kind != "other":
            if kind == "step1" and said[0] and said[0] != s["video"]:
                self._reset(s, said[0])
                self._video(s, said[0], "seen")
            if (kind, s["stage"]) in (("step2", "download"), ("step3", "vad")):
                s["done"].add(s["stage"])
            s["stage"] = {"step1": "download", "step2": "vad", "step3": "face"}[kind]
            s["opened"].update(OPENED if kind == "step3" else (s["stage"],))
            return
        hit = dict(said)
        if t := hit.get("to_process"):
            s["clips"] = int(t[0])
        if sub := next((x for x in SUBSTAGES if x in hit), None):
            s["stage"] = sub
            s["opened"].add(sub)
            if sub == "quality" and "speakers" in hit:
                s["speakers"] += int(hit["speakers"][0])
        if c := hit.get("clip"):
            s |= {"clip": int(c[0]), "clips": int(c[1]), "exported": s["exported"] + (c[2].lower() == "exported")}
        if x := hit.get("summary"):
            s["exported"] = s["exported"] or int(x[0])
            s["done"].update(EXPORTED)
            if s["video"]:
                self._video(s, s["video"], "finished")
        if f := hit.get("failed"):
            self._video(s, f[0], "failed")
            self._error(s)
        if "finished" in hit:
            s["done"].update(x for x in STAGES if x not in s["errors"])
        if "broken" in hit:
            self._error(s)
        s["over"] = "finished" in hit or "broken" in hit

    @staticmethod
    def _told(key, s: dict, silent: bool) -> Row:
        own = s | {"job": key, "silent": silent} | {c: [x for x in STAGES if x in s[c]] for c in ("done", "errors", "opened")}
        return Row(**{c: own[c] for c in OUT_NAMES})

    def _held(self) -> dict:
        held = self.now.get()
        if held is None:
            s = {n: None if n in ("stage", "video", "last") else False if n == "over" else 0 for n in NOW_NAMES} | {c: set() for c in ("done", "errors", "opened")}
        else:
            s = dict(zip(NOW_NAMES, held, strict=True))
            s |= {c: set(s[c].split(",")) - {""} for c in ("done", "errors", "opened")}
        return s | {"named": {}, "new": held is None}

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        s, newest = self._held(), None
        for order, m, at in sorted(((r["order"], r["msg"], r["at_ms"]) for r in rows), key=lambda x: x[0]):
            newest = at if newest is None else newest if at is None else max(at, newest)
            if s["last"] is not None and order <= s["last"]:
                s["late"] += 1
                continue
            s["last"] = order
            self.step(s, re.sub(r"^\s+|\s+$", "", m or "", flags=re.A))
        for video, (stored, flags) in s["named"].items():
            if flags != stored:
                self.videos.updateValue((video,), flags)
        own = s | {c: ",".join(sorted(s[c])) for c in ("done", "errors", "opened")}
        self.now.update(tuple(own[n] for n in NOW_NAMES))
        if not s["new"]:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        if not s["over"] and newest is not None:
            self.handle.registerTimer(newest + self.wait_ms)
        yield self._told(key[0], s, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield self._told(key[0], self._held(), True)


def follow(lines: DataFrame, silent: str = "60 seconds", late: str = "60 seconds") -> DataFrame:
    """A stream of (job bigint, order, at, msg) as the columns of OUT: a job's state after each batch that has lines of it.

    A job that isn't over and whose lines stop for longer than silent, in event time, is told once more with silent set.
    """
    ship(lines.sparkSession)
    own = lines.select(F.col("job").cast("bigint").alias("job"), F.col("order").cast("bigint").alias("order"), "at", F.unix_millis("at").alias("at_ms"), "msg").withWatermark("at", late)
    wait = int(pd.Timedelta(silent).total_seconds() * 1000)
    return own.groupBy("job").transformWithState(JobLog(wait), OUT, "Update", "eventTime")


@contextlib.contextmanager
def state_store(spark: SparkSession):
    """Streams that begin within have their state in RocksDB, which this keyed state needs."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: What lines of a bulk import say, case aside; the first that fits counts.
IMPORT_SAYS = {
    "at": r"\[(\d+)/(\d+)\]\s*Importing:\s*(\S+)",
    "ok": r"\b([a-z]+_\d+)\s+downloaded OK",
    "failed": r"\b([a-z]+_\d+)\s+download error",
    "nothing": r"download returned (no path|None)",
    "same": r"Already in CSV\s*\(same YouTube ID\s+(\S+?)\)\s*:\s*skipped",
    "skipped": r"Already in CSV.*?:\s*skipped",
}


def fold_imports(lines: DataFrame, job: str, order: str, msg: str = "msg") -> DataFrame:
    """(job, current, total, ok, failed, skipped, decided): where a bulk import stands; an id or line counts once a verdict."""
    m = F.coalesce(F.col(msg), F.lit(""))
    part = lambda what, i=1: F.nullif(F.regexp_extract(m, f"(?i){IMPORT_SAYS[what]}", i), F.lit(""))
    kind = None
    for name, p in IMPORT_SAYS.items():
        kind = F.when(m.rlike(f"(?i){p}"), name) if kind is None else kind.when(m.rlike(f"(?i){p}"), name)
    read = lines.select(F.col(job).alias("job"), F.col(order).alias("order"), kind.alias("kind"), part("at").cast("int").alias("i"), part("at", 2).cast("int").alias("n"),
        F.when(kind == "ok", part("ok")).when(kind == "failed", part("failed")).when(kind == "same", part("same")).otherwise(m).alias("id"))
    verdict = F.when(F.col("kind") == "ok", "ok").when(F.col("kind").isin("failed", "nothing"), "failed").when(F.col("kind").isin("same", "skipped"), "skipped")
    place = read.groupBy("job").agg(F.max(F.when(F.col("kind") == "at", F.struct("order", "i", "n"))).alias("p"))
    # each id once, before they are counted: no set of them is gathered
    each = read.select("job", verdict.alias("v"), "id").filter("v IS NOT NULL").distinct().groupBy("job").agg(*[F.count_if(F.col("v") == v).alias(v) for v in ("ok", "failed", "skipped")])
    told = place.alias("a").join(each.alias("b"), F.col("a.job").eqNullSafe(F.col("b.job")), "left")
    n = {v: F.coalesce(v, F.lit(0)) for v in ("ok", "failed", "skipped")}
    return told.select(F.col("a.job").alias(job), F.coalesce("p.i", F.lit(0)).alias("current"), F.coalesce("p.n", F.lit(0)).alias("total"), *[c.alias(v) for v, c in n.items()], sum(n.values()).alias("decided"))
