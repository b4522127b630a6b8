"""Queries of review, tagging and job queues, the explorer, and the payloads of the query entry points."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.functions import rules
from tallyloom.operators import changelog, queues
from tallyloom.plans import binding as b
from tallyloom.plans import serving
from tallyloom.plans.binding import CLIP, SEG
from tallyloom.registry import query
from tallyloom.session import table

C = f"WITH c AS ({CLIP})"
S = f"WITH s AS ({SEG})"
D = "CAST({} AS DECIMAL(20,6))"


def union(parts):
    return reduce(lambda x, y: x.unionByName(y), parts)


@query("review_queues", f"""{C}, s AS (SELECT DISTINCT speaker_id FROM c WHERE asd_score >= 6), m AS (SELECT segment_id, unnest(list_filter(['all', CASE WHEN review_status = '' THEN 'pending' END,
    CASE WHEN wer_dialect IS NOT NULL AND transcript_source = '' THEN 'transcript-select' END, CASE WHEN lower(needs_review) IN ('true', '1') THEN 'needs-review' END,
    CASE WHEN speaker_id IN (SELECT speaker_id FROM s) THEN 'auto-identity' END, CASE WHEN contains(lower(mouth_roi_method), 'fallback') THEN 'mouth-fallback' END,
    CASE WHEN contains(lower(boundary_type), 'forced') THEN 'forced-boundary' END], lambda x: x IS NOT NULL)) AS mode FROM c) SELECT segment_id, mode FROM m""")
def review_queues(spark, d):
    clips = b.clips(spark, d)
    auto = clips.filter("asd_score >= 6").select("speaker_id")
    return queues.review_modes(clips, auto).select("segment_id", F.explode("modes").alias("mode"))


ORDERS = {"most-dialect": "coalesce(wer_dialect, 0) DESC", "worst-whisper": "coalesce(whisper_conf, 0)", "worst-asd": "coalesce(asd_score, 0)",
    "shortest": "coalesce(duration, 'inf'::DOUBLE)", "longest": "coalesce(duration, 0) DESC"}


@query("review_orders", f"{C} " + " UNION ALL ".join(f"SELECT '{k}' AS ordering, segment_id, row_number() OVER (ORDER BY {o}, segment_id) AS pos FROM c QUALIFY pos <= 40" for k, o in ORDERS.items()))
def review_orders(spark, d):
    """The first page of each order."""
    clips = b.clips(spark, d)
    return union([queues.page(clips, [*queues.review_order(k), F.col("segment_id")], 1, 40).select(F.lit(k).alias("ordering"), "segment_id", "pos") for k in ORDERS])


SORTS = {"dur": "duration", "asd": "asd_score", "sync": "syncnet_conf", "wh": "whisper_conf"}


@query("explorer_sorts", f"{C} " + " UNION ALL ".join(
    f"SELECT '{k}-{w}' AS sorting, segment_id, row_number() OVER (ORDER BY {o} {w} NULLS LAST, segment_id) AS pos FROM c QUALIFY pos BETWEEN 21 AND 60"
    for k, o in [*SORTS.items(), ("text", "lower(text)")] for w in ("asc", "desc")))
def explorer_sorts(spark, d):
    """The second page of each sort; texts compare by code point."""
    clips, options = b.clips(spark, d), [f"{k}-{w}" for k in [*SORTS, "text"] for w in ("asc", "desc")]
    return union([queues.page(clips, [*queues.explorer_order(o), F.col("segment_id")], 21, 60).select(F.lit(o).alias("sorting"), "segment_id", "pos") for o in options])


@query("speaker_sorts", f"""{C}, s AS (SELECT speaker_id, avg(syncnet_conf) FILTER (WHERE segment_id % 23 > 4) v, upper(speaker_id) AS name FROM c GROUP BY 1)
    SELECT 'number' AS sorting, speaker_id, row_number() OVER (ORDER BY v NULLS FIRST, speaker_id) AS pos FROM s
    UNION ALL SELECT 'text', speaker_id, row_number() OVER (ORDER BY lower(name) DESC, speaker_id) FROM s""")
def speaker_sorts(spark, d):
    s = b.clips(spark, d).groupBy("speaker_id").agg(F.avg(F.when(F.col("segment_id") % 23 > 4, F.col("syncnet_conf"))).alias("v"), F.upper("speaker_id").alias("name"))
    ranked = lambda name, order: queues.numbered(s, [*order, F.col("speaker_id")]).select(F.lit(name).alias("sorting"), "speaker_id", "pos")
    return ranked("number", queues.speaker_order("v", True, True)).unionByName(ranked("text", queues.speaker_order("name", False, False)))


@query("registry_search", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND (contains(lower(o_orderkey::VARCHAR), 'urg') OR contains(lower(o_orderpriority), 'urg'))")
def registry_search(spark, d):
    v = table(spark, d, "orders").withColumn("status", F.col("o_orderstatus"))
    return queues.registry(v, "F", "URG", ["o_orderkey", "o_orderpriority"]).select("o_orderkey", "o_orderpriority")


@query("rejected_ids", f"{C} SELECT DISTINCT segment_id FROM c WHERE review_status = 'rejected'")
def rejected_ids(spark, d):
    return queues.rejected_ids(b.clips(spark, d))


@query("without_rejected", f"{C} SELECT l.doc_id FROM labels l WHERE doc_id NOT IN (SELECT segment_id FROM c WHERE review_status = 'rejected')")
def without_rejected(spark, d):
    gone = queues.rejected_ids(b.clips(spark, d)).withColumnRenamed("segment_id", "doc_id")
    return table(spark, d, "labels").join(gone, "doc_id", "left_anti").select("doc_id")


@query("resumable", """WITH v AS (SELECT o_orderkey video_id, CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'P' THEN 'processing' ELSE 'completed' END status FROM orders)
    SELECT video_id, status FROM v WHERE status IN ('processing', 'failed') AND video_id IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')""")
def resumable(spark, d):
    status = F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "P", "processing").otherwise("completed")
    v = table(spark, d, "orders").select(F.col("o_orderkey").alias("video_id"), status.alias("status"))
    files = table(spark, d, "lineitem").filter("l_linestatus = 'F'").select(F.col("l_orderkey").alias("video_id"))
    return queues.resumable(v, files)


@query("eligible_videos", """SELECT mode, count(*) n, sum(CAST(o_totalprice AS DECIMAL(20,6)))::DOUBLE AS seconds FROM (SELECT CASE o_orderstatus WHEN 'P' THEN 'batch-pending' WHEN 'F' THEN 'retry' END AS mode, * FROM orders
    UNION ALL SELECT 'resume', * FROM orders WHERE o_orderstatus IN ('F', 'O')) WHERE mode IS NOT NULL GROUP BY 1""")
def eligible_videos(spark, d):
    """How many videos each kind of job may take, and how long they are."""
    status = F.when(F.col("o_orderstatus") == "P", "pending").when(F.col("o_orderstatus") == "F", "failed").otherwise("processing")
    v = table(spark, d, "orders").withColumn("status", status)
    each = {"batch-pending": queues.eligible(v, "batch-pending"), "resume": queues.eligible(v, "resume"), "retry": queues.eligible(v, "resume", True)}
    return union([x.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(20,6)")).cast("double").alias("seconds")).select(F.lit(k).alias("mode"), "n", "seconds") for k, x in each.items()])


@query("tagging_queue", """WITH q AS (SELECT doc_id, source FROM documents WHERE (doc_id % 3 = 0 OR doc_id % 4 = 0) AND lang = 'en'),
    s AS (SELECT min(doc_id) b FROM q WHERE doc_id = 300) SELECT doc_id FROM q, s WHERE b IS NULL OR doc_id >= b""")
def tagging_queue(spark, d):
    v = table(spark, d, "documents").select("doc_id", F.col("lang").alias("channel"), F.when(F.col("doc_id") % 3 != 0, "x").alias("environment"), F.when(F.col("doc_id") % 4 != 0, "y").alias("noise"))
    return queues.tagging_queue(v, "doc_id", ["environment", "noise"], "en", 300, "doc_id").select("doc_id")


@query("dialect_queue", f"""{C} SELECT segment_id, trim(upper(quality_tier)) AS tier FROM c WHERE review_status <> 'rejected' AND transcript_source = '' AND region IN ('de', 'fr') ORDER BY quality_tier, segment_id LIMIT 100""")
def dialect_queue(spark, d):
    clips = b.clips(spark, d).withColumn("video_id", F.col("region"))
    return queues.dialect_queue(clips, "transcript_source", videos=["de", "fr"], limit=100).select("segment_id", queues.tier_name(F.col("quality_tier")).alias("tier"))


@query("refined_flags", f"{C} SELECT segment_id, coalesce(wer > 0.15, false) AS needs_review FROM c")
def refined_flags(spark, d):
    return queues.refined(b.clips(spark, d), "wer").select("segment_id", "needs_review")


@query("transcript_list", f"""{C}, p AS (SELECT * FROM c WHERE review_status IN ('', 'pending')),
    w AS (SELECT segment_id, row_number() OVER (ORDER BY CASE WHEN coalesce(wer_dialect, 0) > 0.05 THEN 0 ELSE 1 END, coalesce(wer_dialect, 0) DESC, segment_id) AS pos FROM p WHERE coalesce(wer_dialect, 0) <> 0),
    t AS (SELECT segment_id, row_number() OVER (ORDER BY quality_tier, segment_id) AS pos FROM p) SELECT 'wer' AS kind, * FROM w WHERE pos <= 80 UNION ALL SELECT 'tier', * FROM t WHERE pos <= 80""")
def transcript_list(spark, d):
    clips = b.clips(spark, d)
    by_wer, wer_order = queues.transcript_list(clips, True, True)
    by_tier, tier_order = queues.transcript_list(clips, False, False)
    first = lambda rows, order, kind: queues.page(rows, [*order, F.col("segment_id")], 1, 80).select(F.lit(kind).alias("kind"), "segment_id", "pos")
    return first(by_wer, wer_order, "wer").unionByName(first(by_tier, tier_order, "tier"))


@query("checked_proposals", """WITH p AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN ' Studio ' WHEN 1 THEN 'INDOOR' WHEN 2 THEN 'cave' WHEN 3 THEN '' END e, CASE doc_id % 3 WHEN 0 THEN 'Low' WHEN 1 THEN 'loud' END n FROM documents),
    x AS (SELECT doc_id, 'environment' AS "column", lower(trim(coalesce(e, ''))) AS value FROM p UNION ALL SELECT doc_id, 'noise', lower(trim(coalesce(n, ''))) FROM p)
    SELECT *, value IN ('indoor', 'outdoor', 'studio', 'mixed', 'unknown') AND "column" = 'environment' OR value IN ('none', 'low', 'moderate', 'high') AND "column" = 'noise' AS valid FROM x WHERE value <> ''""")
def checked_proposals(spark, d):
    i = F.col("doc_id")
    e = F.when(i % 5 == 0, " Studio ").when(i % 5 == 1, "INDOOR").when(i % 5 == 2, "cave").when(i % 5 == 3, "")
    p = table(spark, d, "documents").select("doc_id", e.alias("environment"), F.when(i % 3 == 0, "Low").when(i % 3 == 1, "loud").alias("noise"))
    return queues.checked_proposals(p, {"environment": queues.ENVIRONMENTS, "noise": queues.NOISES}, "doc_id")


@query("orphan_causes", """WITH o AS (SELECT o_orderkey, o_orderstatus, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F') v, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') a FROM orders)
    SELECT CASE WHEN o_orderstatus = 'P' THEN 'rejected' WHEN NOT v AND NOT a THEN 'both_missing' WHEN NOT a THEN 'anno_missing' WHEN NOT v THEN 'video_missing' ELSE 'unknown' END AS cause, count(*) n FROM o GROUP BY 1""")
def orphan_causes(spark, d):
    has = lambda name, cond: table(spark, d, "lineitem").filter(cond).select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn(name, F.lit(True))
    o = table(spark, d, "orders").join(has("v", "l_linestatus = 'F'"), "o_orderkey", "left").join(has("a", "l_returnflag = 'R'"), "o_orderkey", "left")
    some = lambda c: F.coalesce(c, F.lit(False))
    cause = queues.orphan_cause(F.when(F.col("o_orderstatus") == "P", "rejected"), some(F.col("v")), some(F.col("a")))
    return o.groupBy(cause.alias("cause")).agg(F.count(F.lit(1)).alias("n"))


@query("tier_names", f"{C} SELECT t AS tier, count(*) n FROM (SELECT CASE segment_id % 4 WHEN 3 THEN 'x' ELSE quality_tier END q, CASE WHEN segment_id % 4 < 3 THEN upper(trim(quality_tier)) END t FROM c) GROUP BY 1")
def tier_names(spark, d):
    raw = F.when(F.col("segment_id") % 4 == 3, "x").otherwise(F.col("quality_tier"))
    return b.clips(spark, d).groupBy(queues.tier_name(raw).alias("tier")).agg(F.count(F.lit(1)).alias("n"))


JOBS = """SELECT o_orderkey AS job_id, CASE o_orderstatus WHEN 'P' THEN 'cancel_requested' WHEN 'F' THEN 'completed' ELSE 'pending' END AS status,
    CASE WHEN o_custkey % 2 = 0 THEN epoch_us(o_orderdate) END AS started_at, CASE WHEN o_orderstatus = 'F' THEN epoch_us(o_orderdate) + 1 END AS finished_at FROM orders"""


def jobs(spark, d):
    at = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    status = F.when(F.col("o_orderstatus") == "P", "cancel_requested").when(F.col("o_orderstatus") == "F", "completed").otherwise("pending")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("job_id"), status.alias("status"), F.when(F.col("o_custkey") % 2 == 0, at).alias("started_at"), F.when(F.col("o_orderstatus") == "F", at + 1).alias("finished_at"))


@query("newest_jobs", f"SELECT * FROM ({JOBS}) ORDER BY job_id DESC LIMIT 50")
def newest_jobs(spark, d):
    return queues.newest_jobs(jobs(spark, d))


@query("cancel_sweep", f"""SELECT job_id, CASE WHEN i THEN 'cancelled' ELSE status END AS status, started_at, CASE WHEN i THEN 17 ELSE finished_at END AS finished_at FROM (SELECT *, status = 'cancel_requested' AND started_at IS NULL i FROM ({JOBS}))""")
def cancel_sweep(spark, d):
    return queues.cancel_unclaimed(jobs(spark, d), 17)


@query("next_claim", f"SELECT min(job_id) AS job_id FROM ({JOBS}) WHERE status = 'pending' HAVING count(*) > 0")
def next_claim(spark, d):
    return changelog.next_claim(jobs(spark, d))


@query("job_admissions", """WITH e AS (SELECT user_id, event_id, event_type <> 'purchase' AS ask, event_type <> 'purchase' AND event_id % 7 < 6 AS good FROM events),
    n AS (SELECT *, count(*) FILTER (WHERE NOT ask) OVER (PARTITION BY user_id ORDER BY event_id) AS ends FROM e),
    t AS (SELECT *, good AND count(*) FILTER (WHERE good) OVER (PARTITION BY user_id, ends ORDER BY event_id) = 1 AS taken FROM n),
    i AS (SELECT *, count(*) FILTER (WHERE taken) OVER (PARTITION BY user_id ORDER BY event_id) AS id FROM t)
    SELECT user_id, event_id, CASE WHEN NOT good THEN 400 WHEN taken THEN 201 ELSE 409 END AS answer, CASE WHEN good THEN id END AS job_id FROM i WHERE ask""")
def job_admissions(spark, d):
    """Requests for jobs, a queue for each user: purchases end what is active, and a seventh of the rest asks for an unknown type."""
    kind = F.when(F.col("event_type") == "purchase", "end").otherwise("request")
    asked = F.get(F.array(*map(F.lit, [*changelog.JOB_TYPES, "other"])), (F.col("event_id") % 7).cast("int"))
    return changelog.admissions(table(spark, d, "events").select("user_id", "event_id", kind.alias("kind"), asked.alias("type")), "user_id", "event_id", "kind", "type")


@query("words_presence", """WITH w AS (SELECT doc_id, len(list_filter(string_split_regex(text, '\\s+'), lambda x: contains(x, '.'))) n FROM documents) SELECT doc_id, n > 0 AS present FROM w""")
def words_presence(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.filter(F.split("text", r"\s+"), lambda w: w.contains(".")).alias("words"))
    return union([queues.with_words(docs, present=p).select("doc_id", F.lit(p).alias("present")) for p in (True, False)])


@query("capabilities", f"""{C} SELECT count(wer_dialect) > 0 AS wer_dialect, bool_or(trim(transcript_source) <> '') AS transcript_source, coalesce(max(trimmed) <> 0, false) AS trimmed FROM c""")
def capabilities(spark, d):
    from tallyloom.operators.stats import filled_columns

    return filled_columns(b.clips(spark, d), ["wer_dialect", "transcript_source", "trimmed"])


@query("video_rows", f"""{S}, f AS (SELECT video_id, count(*) n, round(sum(CAST(duration AS DECIMAL(20,6))), 2)::DOUBLE t, count(*) FILTER (WHERE tier = 'A') a FROM s WHERE review_status <> 'rejected' GROUP BY 1)
    SELECT o_orderkey AS video_id, o_orderstatus AS status, coalesce(n, 0) AS total_segments, coalesce(t, 0) AS total_duration, coalesce(a, 0) AS tier_a FROM orders LEFT JOIN f ON o_orderkey = f.video_id""")
def video_rows(spark, d):
    return serving.videos_with_stats(b.videos(spark, d), b.segments(spark, d)).select("video_id", "status", "total_segments", "total_duration", "tier_a")


@query("segment_scan", f"""{S} SELECT video_id, segment_no, l_partkey, duration, tier, r_name AS region FROM s LEFT JOIN supplier ON s.l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey WHERE review_status <> 'rejected' AND tier <> 'C'""")
def segment_scan(spark, d):
    """Fields of the segments that aren't rejected, with their region, in order."""
    own = b.segments(spark, d).filter(rules.not_rejected(F.col("review_status"))).filter("tier <> 'C'")
    return own.join(b.speaker_regions(spark, d), "l_suppkey", "left").select("video_id", "segment_no", "l_partkey", "duration", "tier", "region").orderBy("video_id", "segment_no")


@query("segment_lookup", f"{S} SELECT video_id, segment_no, speaker_id, duration, tier FROM s WHERE video_id = 77 AND segment_no IN (1, 2, 3)")
def segment_lookup(spark, d):
    """Point lookups, as rows read back from the documents that the entry point gives."""
    seg = b.segments(spark, d).select("video_id", "segment_no", "speaker_id", "duration", "tier")
    docs = union([serving.segment_detail(seg, 77, n) for n in (1, 2, 3)])
    return docs.select(F.from_json("json", seg.schema).alias("r")).select("r.*")


@query("segment_documents", f"{S} SELECT video_id, segment_no, l_partkey, speaker_id, tier, count(*) n FROM s WHERE review_status <> 'rejected' GROUP BY ALL")
def segment_documents(spark, d):
    """The list entry point: every document, read back."""
    seg = b.segments(spark, d).select("video_id", "segment_no", "l_partkey", "speaker_id", "tier", "review_status")
    back = serving.segment_list(seg).select(F.from_json("json", seg.schema).alias("r")).select("r.*")
    return back.groupBy("video_id", "segment_no", "l_partkey", "speaker_id", "tier").agg(F.count(F.lit(1)).alias("n"))


V = """SELECT CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'failed' END AS status, o_totalprice AS duration, CASE WHEN o_custkey % 3 > 0 THEN o_totalprice / 4 END AS extracted,
    CASE WHEN o_custkey % 4 > 0 THEN 'r' || (o_custkey % 4) END AS region, 'c' || (o_custkey % 50) AS channel, CASE WHEN o_custkey % 5 = 0 THEN ' ' ELSE o_orderpriority END AS license FROM orders"""


def catalog_videos(spark, d):
    k = F.col("o_custkey")
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "pending").otherwise("failed")
    return table(spark, d, "orders").select(
        status.alias("status"), F.col("o_totalprice").alias("duration"), F.when(k % 3 > 0, F.col("o_totalprice") / 4).alias("extracted"), F.when(k % 4 > 0, F.concat(F.lit("r"), (k % 4).cast("string"))).alias("region"),
        F.concat(F.lit("c"), (k % 50).cast("string")).alias("channel"), F.when(k % 5 == 0, " ").otherwise(F.col("o_orderpriority")).alias("license"))


def long(part, key, n="NULL", value="NULL", rest=""):
    return f"SELECT {part} AS part, {key} AS key, ({n})::BIGINT AS n, ({value})::DOUBLE AS value {rest}"


def half_up(x, digits):
    return f"floor(({x}) * 1e{digits} + 0.5) / 1e{digits}"


def dec(c, rest=""):
    return f"(coalesce(sum({D.format(c)}) {rest}, 0)::DOUBLE)"


def mean(c, digits, rest=""):
    return half_up(f"sum({D.format(c)}) {rest}::DOUBLE / count({c}) {rest}", digits)


def one_row(part, source, counts, values):
    """SQL of a payload's part from one row of aggregates."""
    cols = ", ".join(f"({x}) AS \"{k}\"" for k, x in {**counts, **values}.items())
    rows = [long(f"'{part}'", f"'{k}'", n=f'"{k}"', rest="FROM t") for k in counts] + [long(f"'{part}'", f"'{k}'", value=f'"{k}"', rest="FROM t") for k in values]
    return f"SELECT * FROM (WITH t AS (SELECT {cols} FROM {source}) {' UNION ALL '.join(rows)})"


def top20(column):
    return f"SELECT * FROM ({long(f'{chr(39)}by_{column}{chr(39)}', f'trim({column})', n='count(*)', rest=f'FROM v WHERE trim({column}) <> {chr(39)*2} GROUP BY 2 ORDER BY n DESC, key LIMIT 20')})"


SOME = "CASE WHEN extracted > 0 THEN extracted END"


@query("video_payload", f"WITH v AS ({V}) " + " UNION ALL ".join([
    one_row("totals", "v", {"total": "count(*)"}, {
        "extracted_h": half_up(f"{dec('extracted')} / 3600", 2), "source_s": half_up(dec("duration"), 2), "min_duration": "round(min(duration), 2)", "max_duration": "round(max(duration), 2)", "mean_duration": mean("duration", 2),
        "min_extracted": f"round(min({SOME}), 2)", "max_extracted": f"round(max({SOME}), 2)", "mean_extracted": half_up(f"sum({D.format(SOME)})::DOUBLE / count({SOME})", 2)}),
    long("'by_status'", "status", n="count(*)", rest="FROM v GROUP BY status"),
    f"SELECT * FROM ({long(chr(39) + 'speech_by_region' + chr(39), 'coalesce(region, ' + chr(39) + 'UNKNOWN' + chr(39) + ')', value=half_up(dec('extracted'), 2), rest='FROM v GROUP BY 2')}) WHERE value > 0",
    *[top20(c) for c in ("region", "channel", "license")]]))
def video_payload(spark, d):
    return serving.video_payload(catalog_videos(spark, d), ("region", "channel", "license"))


F_ = "FILTER (WHERE {})"
OK, TIER = "review_status = 'approved'", "upper(trim(quality_tier))"
LEVEL = "CASE WHEN whisper_conf_min IS NULL THEN 'unknown' WHEN whisper_conf_min >= 0.7 AND whisper_conf >= 0.9 THEN '3' WHEN whisper_conf_min >= 0.5 AND whisper_conf >= 0.7 THEN '2' ELSE '1' END"
BAND = "CASE WHEN duration < 1 THEN '<1s' WHEN duration < 3 THEN '1-3s' WHEN duration < 6 THEN '3-6s' WHEN duration < 10 THEN '6-10s' WHEN duration < 15 THEN '10-15s' ELSE '>15s' END"


@query("segment_payload", f"""{C}, f AS (SELECT * FROM c WHERE review_status <> 'rejected'), w AS (SELECT upper(trim(replace(unnest(string_split_regex(text, '\\s+')), 'ß', 'SS'), '.,;:!?"''()[]')) AS word, {OK} AS ok FROM f),
    g AS (SELECT word, count(*) n, bool_or(ok) ok FROM w WHERE word <> '' GROUP BY 1) """ + " UNION ALL ".join([
    one_row("totals", "f", {
        "total": "count(*)", "words": "sum(num_words)", "chars": "sum(num_chars)", "with_wer": "count(wer)", "approved": f"count(*) {F_.format(OK)}", "approved_words": f"coalesce(sum(num_words) {F_.format(OK)}, 0)",
        "ready": f"count(*) {F_.format(f'{OK} AND {TIER} IN (' + chr(39) + 'A' + chr(39) + ', ' + chr(39) + 'B' + chr(39) + ')')}", "min_words": "min(num_words)", "max_words": "max(num_words)",
        **{f"conf_{k}": f"count(*) {F_.format(f'{LEVEL} = {chr(39)}{k}{chr(39)}')}" for k in ("3", "2", "1", "unknown")}, **{f"tier_{t}": f"count(*) {F_.format(f'{TIER} = {chr(39)}{t}{chr(39)}')}" for t in "ABC"}}, {
        "duration_s": half_up(dec("duration"), 2), "approved_s": half_up(dec("duration", F_.format(OK)), 2), "ready_s": half_up(dec("duration", F_.format(f"{OK} AND {TIER} IN ('A', 'B')")), 2),
        "avg_wer": mean("wer", 4), "min_s": "round(min(duration), 2)", "mean_s": mean("duration", 2), "max_s": "round(max(duration), 2)", "mean_words": half_up("sum(num_words)::DOUBLE / count(num_words)", 1),
        "avg_asd": mean("asd_score", 3), "avg_sync": mean("syncnet_conf", 3), "avg_conf": mean("whisper_conf", 3), "wpm": half_up(f"sum(num_words) / {dec('duration')} * 60", 1),
        **{f"tier_{t}_s": half_up(dec("duration", F_.format(f"{TIER} = '{t}'")), 2) for t in "ABC"}}),
    one_row("all", "c", {"rejected": "count(*) FILTER (WHERE review_status = 'rejected')", "edited": "count(*) FILTER (WHERE transcript_edited = 1 OR trimmed = 1)"}, {}),
    one_row("duration", "f", {}, {k: f"round(quantile_cont(duration, {p}), 2)" for k, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("p95", 0.95))}),
    one_row("vocabulary", "g", {"unique": "count(*)", "once": "count(*) FILTER (WHERE n = 1)", "twice": "count(*) FILTER (WHERE n = 2)", "approved": "count(*) FILTER (WHERE ok)"}, {}),
    long("'bands'", BAND, n="count(*)", value=f"round(sum({D.format('duration')}), 2)", rest="FROM f GROUP BY 2"), long("'by_region'", "coalesce(region, 'UNKNOWN')", n="count(*)", value=half_up(dec("duration"), 1), rest="FROM f GROUP BY 2")]))
def segment_payload(spark, d):
    return serving.segment_payload(b.clips(spark, d))


@query("corpus_kpis", f"""WITH v AS ({V}), c AS ({CLIP}), a AS (SELECT {dec('duration')} source_s, count(*) FILTER (WHERE status = 'completed') done FROM v),
    e AS (SELECT count(*) FILTER (WHERE review_status <> 'rejected') total, count(*) FILTER (WHERE {OK}) approved, count(*) FILTER (WHERE review_status = 'rejected') rejected,
    {dec('duration', "FILTER (WHERE review_status <> 'rejected')")} x, {dec('duration', f"FILTER (WHERE {OK})")} y, {dec('duration', "FILTER (WHERE review_status <> 'rejected' AND region = 'en')")} z FROM c)
    SELECT total, approved, greatest(0, total - approved - rejected) pending, {half_up('100 * x / source_s', 1)} mined_pct, {half_up('100 * y / x', 1)} approved_pct, {half_up('100 * z / 720000', 1)} target_pct,
    {half_up('x / total', 1)} mean_clip_s, {half_up('x / done', 1)} speech_per_video_s FROM a, e""")
def corpus_kpis(spark, d):
    return serving.kpis(catalog_videos(spark, d), b.clips(spark, d), "en")


@query("explorer_strip", f"""{C} SELECT count(*) n, {half_up(dec('duration', 'FILTER (WHERE duration > 0)'), 3)} AS seconds, {half_up(f"sum({D.format('duration')}) FILTER (WHERE duration > 0)::DOUBLE / count(*) FILTER (WHERE duration > 0)", 3)} mean_s,
    count(DISTINCT video_id) videos, count(*) FILTER (WHERE {OK}) approved FROM c""")
def explorer_strip(spark, d):
    return serving.explorer_strip(b.clips(spark, d))


@query("distributions", f"{C} " + " UNION ALL ".join(one_row(c, "c", {"n": f"count({c})"}, {
    "min": f"round(min({c}), 3)", "mean": mean(c, 3), "max": f"round(max({c}), 3)", "median": f"round(quantile_cont({c}, 0.5), 3)", "p95": f"round(quantile_cont({c}, 0.95), 3)"}) for c in ("asd_score", "wer", "duration")))
def distributions(spark, d):
    return serving.distributions(b.clips(spark, d), ["asd_score", "wer", "duration"])


@query("region_rollup", f"""{C}, v AS (SELECT source AS video_id, any_value(lang) AS region FROM (SELECT source, lang, row_number() OVER (PARTITION BY source ORDER BY doc_id) r FROM documents) WHERE r = 1 GROUP BY 1)
    SELECT v.region, count(DISTINCT v.video_id) AS videos, count(c.segment_id) AS segments, {half_up(dec('duration'), 1)} AS total_s, {half_up('100 * count(c.segment_id) / (SELECT count(*) FROM c WHERE review_status <> ' + chr(39) + 'rejected' + chr(39) + ')::DOUBLE', 1)} AS pct
    FROM v LEFT JOIN (SELECT * FROM c WHERE review_status <> 'rejected') c ON c.video_id = v.video_id GROUP BY 1""")
def region_rollup(spark, d):
    """Per region of the videos: videos, segments that aren't rejected, their seconds and share."""
    v = table(spark, d, "documents").groupBy(F.col("source").alias("video_id")).agg(F.min_by("lang", "doc_id").alias("region"))
    own = b.clips(spark, d).filter(rules.not_rejected(F.col("review_status"))).groupBy("video_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("duration").cast("decimal(20,6)")).alias("s"))
    each = v.join(own, "video_id", "left").groupBy("region").agg(F.count(F.lit(1)).alias("videos"), F.coalesce(F.sum("n"), F.lit(0)).alias("segments"), F.coalesce(F.sum("s").cast("double"), F.lit(0.0)).alias("s"))
    total = F.sum("segments").over(Window.partitionBy())  # a row for each region
    return each.select("region", "videos", "segments", serving.stats.rounded(F.col("s"), 1).alias("total_s"), serving.stats.rounded(100 * F.col("segments") / total, 1).alias("pct"))


@query("transcript_progress", f"{C} SELECT count(*) FILTER (WHERE text <> '') AS standard, count(*) FILTER (WHERE transcript_source <> '') AS dialect, count(*) FILTER (WHERE needs_review <> '') AS large FROM c")
def transcript_progress(spark, d):
    """How many segments each transcript variant has."""
    b.clips(spark, d).createOrReplaceTempView("progress_clips")
    return spark.sql("SELECT count(*) FILTER (WHERE text <> '') AS standard, count(*) FILTER (WHERE transcript_source <> '') AS dialect, count(*) FILTER (WHERE needs_review <> '') AS large FROM progress_clips")


@query("consensus_report", f"""{C}, l AS (SELECT *, CASE WHEN wer IS NULL OR wer_dialect IS NULL THEN 'insufficient' WHEN wer < 0.2 AND wer_dialect < 0.2 THEN 'all_agree' WHEN wer >= 0.2 AND wer_dialect >= 0.2 THEN 'all_disagree'
    WHEN wer_dialect < 0.2 THEN 'dialectal_agree' ELSE 'std_large_agree' END label, upper(trim(quality_tier)) tier FROM (SELECT *, CASE WHEN wer < 0.2 AND wer_dialect < 0.2 THEN 0 ELSE 1 END FROM c))
    SELECT label, tier, count(*) n, {half_up(f'{dec("duration")} / 3600', 3)} AS hours FROM l GROUP BY GROUPING SETS ((label), (label, tier), ())""")
def consensus_report(spark, d):
    w, x = F.col("wer"), F.col("wer_dialect")
    sm = F.when((w < 0.2) & (x < 0.2), 0.0).otherwise(1.0)  # the third pair agrees only where both others do
    label = F.when(w.isNull() | x.isNull(), "insufficient").otherwise(rules.consensus_label(sm, w, x))
    own = b.clips(spark, d).select(label.alias("label"), queues.tier_name(F.col("quality_tier")).alias("tier"), "duration")
    sets = [[F.col("label")], [F.col("label"), F.col("tier")], []]
    return own.groupingSets(sets, F.col("label"), F.col("tier")).agg(F.count(F.lit(1)).alias("n"), serving.stats.rounded(serving._sum("duration") / 3600, 3).alias("hours"))


@query("wer_buckets", f"""{C}, u AS (SELECT 'wer' AS kind, wer v FROM c UNION ALL SELECT 'wer_dialect', wer_dialect FROM c)
    SELECT kind, CASE WHEN v < 0.1 THEN '0-10%' WHEN v < 0.2 THEN '10-20%' WHEN v < 0.3 THEN '20-30%' WHEN v < 0.5 THEN '30-50%' WHEN v < 1 THEN '50-100%' ELSE '>100%' END AS bucket, count(*) n,
    {mean('v', 4)} AS mean, min(v) AS least, max(v) AS most FROM u WHERE v IS NOT NULL GROUP BY 1, 2""")
def wer_buckets(spark, d):
    u = b.clips(spark, d).unpivot([], ["wer", "wer_dialect"], "kind", "v").filter("v IS NOT NULL")
    bucket = rules.band(F.col("v"), (0.1, 0.2, 0.3, 0.5, 1.0), ("0-10%", "10-20%", "20-30%", "30-50%", "50-100%", ">100%"))
    return u.groupBy("kind", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), serving.stats.exact_avg(F.col("v")).alias("mean"), F.min("v").alias("least"), F.max("v").alias("most"))
