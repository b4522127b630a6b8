"""Queries of job logs: the state of jobs by a batch fold and by a stream, the feed of lines, and bulk imports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.registry import query
from tallyloom.session import fresh_path, table
from tallyloom.streaming import job_log, streams

#: Lines of the made-up logs: an event picks one of them by its numbers.
LINES = (
    "Processing video {n}/9: v_{v}", "Step 1: fetch video: v_{v}", "Step 1: again", "Step 2: cut", "12 existing clips found", "Step 3: go", "{n} clips to process", "[clip_1] face detection", "[clip_1] ASD scoring (3/5 tracks)",
    "[c] SyncNet verification", "[c] transcribing", "[c] exporting LRS2", "Speaker identity [x] → {n} speakers", "CLIP {n}/{v} dropped (short)", "CLIP {n}/{v} exported: ok", "Exported {n} segments", "Pipeline failed for v_{v}: boom",
    "Pipeline finished", "Pipeline finished with errors", "Process exited with code 0", "Process exited with code 1", " noise ", "saved all", "frame done",
)
IMPORTS = (
    "[{n}/9] Importing: u{v}", "md_{v} downloaded OK", "md_{n} download error: x", "download returned None at {v}", "Already in CSV (same YouTube ID y{v}): skipped", "Already in CSV as md_{n}: skipped", "noise",
)


def made(events, lines):
    i = F.col("event_id")
    held = F.get(F.array(*map(F.lit, lines)), ((i * 7 + F.floor(i / 5) + F.col("user_id")) % len(lines)).cast("int"))
    n, v = (i % 5 + 1).cast("string"), (i % 4 + 1).cast("string")
    msg = F.replace(F.replace(held, F.lit("{n}"), n), F.lit("{v}"), v)
    return events.select(F.col("user_id").cast("bigint").alias("job"), i.cast("bigint").alias("order"), F.col("ts").cast("timestamp").alias("at"), msg.alias("msg"))


def made_sql(lines) -> str:
    listed = ", ".join(f"'{x}'" for x in lines)
    return f"SELECT user_id AS job, event_id AS o, replace(replace([{listed}][(event_id * 7 + event_id // 5 + user_id) % {len(lines)} + 1], '{{n}}', (event_id % 5 + 1)::VARCHAR), '{{v}}', (event_id % 4 + 1)::VARCHAR) AS m FROM events"


def _says(what: str) -> str:
    p = job_log.SAYS[what].replace(r"(?!\s+with\s+errors)", r"([^ ]|$|\s+[^ w])")
    return f"regexp_matches(m, '{p}', 'i')"


def _part(what: str, i: int) -> str:
    return f"nullif(regexp_extract(m, '{job_log.SAYS[what]}', {i}, 'i'), '')"


S = job_log.STAGES
OTHER = "line = 'other'"
READ = f"""e AS ({made_sql(LINES)}),
k AS (SELECT job, o, trim(m) AS m, CASE WHEN {_says('batch')} THEN 'batch' WHEN {_says('step1')} THEN 'step1' WHEN {_says('step2')} THEN 'step2' WHEN {_says('step3')} THEN 'step3' ELSE 'other' END AS line FROM e),
x AS (SELECT *, CASE line WHEN 'batch' THEN {_part('batch', 3)} WHEN 'step1' THEN {_part('video', 1)} END AS mention,
    CASE WHEN line = 'step1' THEN 'download' WHEN line = 'step2' THEN 'vad' WHEN line = 'step3' THEN 'face' {' '.join(f"WHEN {_says(s)} THEN '{s}'" for s in job_log.SUBSTAGES)} END AS sets0,
    CASE WHEN {OTHER} THEN {_part('failed', 1)} END AS failed, {OTHER} AND {_says('finished')} AS finished, {OTHER} AND {_says('broken')} AS broken FROM k),
y AS (SELECT *, CASE WHEN line <> 'batch' THEN sets0 END AS sets, coalesce(line = 'batch' OR (line = 'step1' AND mention IS NOT NULL AND mention IS DISTINCT FROM
    last_value(mention IGNORE NULLS) OVER (PARTITION BY job ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), false) AS reset FROM x),
z AS (SELECT *, sum(reset::INT) OVER (PARTITION BY job ORDER BY o) AS seg FROM y),
w AS (SELECT *, last_value(sets IGNORE NULLS) OVER (PARTITION BY job, seg ORDER BY o ROWS UNBOUNDED PRECEDING) AS now,
    last_value(sets IGNORE NULLS) OVER (PARTITION BY job, seg ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was,
    last_value(mention IGNORE NULLS) OVER (PARTITION BY job ORDER BY o ROWS UNBOUNDED PRECEDING) AS video FROM z)"""
FAILS = "CASE WHEN failed IS NOT NULL THEN o * 3 WHEN broken THEN o * 3 + 2 END"
NUMBER = lambda what, i: f"CASE WHEN {OTHER} THEN {_part(what, i)}::INT END"


def _passed(s: str) -> str:
    test = {"download": "line = 'step2' AND was = 'download'", "vad": "line = 'step3' AND was = 'vad'", "quality": "false"}.get(s, f"{NUMBER('summary', 1)} IS NOT NULL")
    return f"coalesce(bool_or({test}), false)"


def _listed(test) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {test(s)} THEN '{s}' END" for s in S) + "], lambda x: x IS NOT NULL), ',')"


STATE_SQL = f"""WITH {READ},
l AS (SELECT job, arg_max(sets, o) FILTER (WHERE sets IS NOT NULL) AS stage, min(CASE WHEN finished THEN o * 3 + 1 END) AS ends, coalesce(bool_or(line = 'step3'), false) AS opens, list(sets) AS held,
    coalesce(arg_max({NUMBER('clip', 1)}, o) FILTER (WHERE {NUMBER('clip', 1)} IS NOT NULL), 0) AS clip,
    coalesce(arg_max(coalesce({NUMBER('clip', 2)}, {NUMBER('to_process', 1)}), o) FILTER (WHERE coalesce({NUMBER('clip', 2)}, {NUMBER('to_process', 1)}) IS NOT NULL), 0) AS clips,
    {', '.join(f"min(CASE WHEN coalesce(now, 'download') = '{s}' THEN {FAILS} END) AS e_{s}, {_passed(s)} AS p_{s}" for s in S)}
    FROM w JOIN (SELECT job, max(seg) AS seg FROM w GROUP BY job) USING (job, seg) GROUP BY job),
t AS (SELECT job, arg_max(mention, o) FILTER (WHERE mention IS NOT NULL) AS video, coalesce(arg_max({_part('batch', 1)}::INT, o) FILTER (WHERE line = 'batch'), 0) AS "position",
    coalesce(arg_max({_part('batch', 2)}::INT, o) FILTER (WHERE line = 'batch'), 0) AS total, count(DISTINCT mention)::INT AS videos,
    (count(DISTINCT video) FILTER (WHERE {NUMBER('summary', 1)} IS NOT NULL))::INT AS finished, count(DISTINCT failed)::INT AS failed,
    count(*) FILTER (WHERE {OTHER} AND lower({_part('clip', 3)}) = 'exported') AS n, min(o) FILTER (WHERE {OTHER} AND lower({_part('clip', 3)}) = 'exported') AS first_export,
    min(o) FILTER (WHERE {NUMBER('summary', 1)} > 0) AS first_summary, arg_min({NUMBER('summary', 1)}, o) FILTER (WHERE {NUMBER('summary', 1)} > 0) AS summary,
    coalesce(sum({_part('speakers', 1)}::INT) FILTER (WHERE {OTHER} AND sets = 'quality'), 0)::BIGINT AS speakers FROM w GROUP BY job)
SELECT job, stage, {_listed(lambda s: f"p_{s} OR (ends IS NOT NULL AND (e_{s} IS NULL OR e_{s} > ends))")} AS done, {_listed(lambda s: f"e_{s} IS NOT NULL")} AS errors,
    {_listed(lambda s: f"list_contains(held, '{s}') OR e_{s} IS NOT NULL" + (" OR opens" if s in job_log.OPENED else ""))} AS opened,
    video, "position", total, videos, finished, failed, n + CASE WHEN first_summary IS NOT NULL AND (first_export IS NULL OR first_summary < first_export) THEN summary ELSE 0 END AS exported, clip, clips, speakers
FROM l JOIN t USING (job)"""


def shown(rows):
    listed = [F.array_join(c, ",").alias(c) for c in ("done", "errors", "opened")]
    return rows.select("job", "stage", *listed, "video", "position", "total", "videos", "finished", "failed", "exported", "clip", "clips", "speakers")


@query("job_log_state", STATE_SQL)
def job_log_state(spark, d):
    """Every job's state after all its lines, by segments between resets."""
    return shown(job_log.fold(made(table(spark, d, "events"), LINES), "job", "order"))


@query("stream_job_log", STATE_SQL)
def stream_job_log(spark, d):
    """The same by a stream with keyed state: what was last told of each job."""
    lines = made(streams.source(spark, f"{d}/events.parquet"), LINES)
    with job_log.state_store(spark):
        told = streams.drained(job_log.follow(lines), fresh_path(spark, "job-log"), "update")
    return shown(told.groupBy("job").agg(F.max_by(F.struct(*[c for c in told.columns if c != "job"]), "last").alias("x")).select("job", "x.*"))


@query("job_log_feed", f"""WITH {READ}, f AS (SELECT *, coalesce(bool_or(failed IS NOT NULL OR broken) OVER (PARTITION BY job, seg ORDER BY o ROWS UNBOUNDED PRECEDING), false) AS bad FROM w)
    SELECT job, o AS "order", m AS msg, CASE WHEN line = 'batch' THEN 'info' WHEN regexp_matches(m, 'error|fail|exception|traceback', 'i') THEN 'error' WHEN regexp_matches(m, 'skip|skipping|dropped', 'i') THEN 'warn'
    WHEN regexp_matches(m, 'done|completed|success|saved|exported|finished|wrote', 'i') THEN 'success' ELSE 'info' END AS kind, CASE WHEN line <> 'batch' THEN coalesce(now, CASE WHEN bad THEN 'download' END) END AS stage FROM f""")
def job_log_feed(spark, d):
    """Every line with its kind and stage."""
    return job_log.feed(made(table(spark, d, "events"), LINES), "job", "order")


@query("import_state", f"""WITH e AS ({made_sql(IMPORTS)}), k AS (SELECT *, CASE WHEN m LIKE '[%' THEN 'at' WHEN m LIKE '% downloaded OK' THEN 'ok' WHEN m LIKE '% download error%' THEN 'failed' WHEN m LIKE 'download returned%' THEN 'nothing'
    WHEN m LIKE '%same YouTube%' THEN 'same' WHEN m LIKE '%skipped' THEN 'skipped' END AS k, regexp_extract(m, 'md_\\d+|y\\d+') AS id FROM e), n AS (SELECT job, coalesce(arg_max(nullif(regexp_extract(m, '(\\d+)/(\\d+)', 1), '')::INT, o) FILTER (WHERE k = 'at'), 0) AS "current",
    CASE WHEN bool_or(k = 'at') THEN 9 ELSE 0 END AS total, count(DISTINCT id) FILTER (WHERE k = 'ok') AS ok, count(DISTINCT CASE k WHEN 'failed' THEN id ELSE m END) FILTER (WHERE k IN ('failed', 'nothing')) AS failed,
    count(DISTINCT CASE k WHEN 'same' THEN id ELSE m END) FILTER (WHERE k IN ('same', 'skipped')) AS skipped FROM k GROUP BY job) SELECT *, ok + failed + skipped AS decided FROM n""")
def import_state(spark, d):
    """Where each bulk import stands."""
    return job_log.fold_imports(made(table(spark, d, "events"), IMPORTS), "job", "order")
