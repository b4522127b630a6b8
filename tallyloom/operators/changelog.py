"""Writes as an append-only log of changes; state is the latest value of each column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.text import stat_tokens
from tallyloom.functions.wer import wer


def latest(log: DataFrame, key: str, version: str) -> DataFrame:
    """The newest row of each key; ties are broken by the whole row, so that reruns agree."""
    rest = [c for c in log.columns if c not in (key, version)]
    best = log.groupBy(key).agg(F.max(F.struct(version, *rest)).alias("r"))
    return best.select(key, *[F.col(f"r.{c}").alias(c) for c in log.columns if c != key]).select(log.columns)


def latest_columns(log: DataFrame, key: str, version: str, columns: Sequence[str]) -> DataFrame:
    """Partial updates: for each column the newest value that isn't null."""
    return log.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(version))).alias(c) for c in columns])


def insert_absent(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows of incoming whose key is new, once each."""
    return incoming.dropDuplicates([key]).join(current, key, "left_anti")


def upsert(current: DataFrame, incoming: DataFrame, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """incoming over current; columns in keep stay where incoming has none."""
    names = [c for c in current.columns if c != key]
    both = current.withColumn("_c", F.lit(True)).alias("c").join(incoming.withColumn("_i", F.lit(True)).alias("i"), key, "full")
    new = lambda c: F.coalesce(f"i.{c}", f"c.{c}") if c in keep else F.when(F.col("_i"), F.col(f"i.{c}")).otherwise(F.col(f"c.{c}"))
    return both.select(key, *[new(c).alias(c) for c in names])


def set_columns(current: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Bulk partial update: columns of updates replace current's where they aren't null."""
    names = [c for c in updates.columns if c != key]
    both = current.join(updates.select(key, *[F.col(c).alias(f"_{c}") for c in names]), key, "left")
    return both.select(*[F.coalesce(f"_{c}", c).alias(c) if c in names else F.col(c) for c in current.columns])


def delete_cascade(parents: DataFrame, gone: DataFrame, key: str, *children: DataFrame) -> list[DataFrame]:
    """parents and each child table without the keys of gone."""
    return [t.join(gone, key, "left_anti") for t in (parents, *children)]


def curator_import(current: DataFrame, incoming: DataFrame, key: str, curated: Sequence[str]) -> DataFrame:
    """Curated columns are always taken from incoming, all others only for new rows."""
    names = [c for c in current.columns if c != key]
    both = current.withColumn("_c", F.lit(True)).alias("c").join(incoming.withColumn("_i", F.lit(True)).alias("i"), key, "full")
    value = lambda c: F.when(F.col("_i") & (F.col("_c").isNull() | F.lit(c in curated)), F.col(f"i.{c}")).otherwise(F.col(f"c.{c}"))
    return both.select(key, *[value(c).alias(c) for c in names])


def review_state(events: DataFrame, key: str, at: str) -> DataFrame:
    """(key, status, text, edited): approve and reject set the status, save the text, revert forgets all before it."""
    since = F.coalesce(F.max(F.when(F.col("action") == "revert", F.col(at))).over(Window.partitionBy(key)), F.lit(None))
    live = events.withColumn("_since", since).filter(F.col("_since").isNull() | (F.col(at) >= F.col("_since")))
    verdict = F.when(F.col("action").isin("approve", "reject"), F.col("action"))
    out = live.groupBy(key).agg(F.max_by(verdict, F.when(verdict.isNotNull(), F.col(at))).alias("v"), F.max_by("text", F.when(F.col("action") == "save", F.col(at))).alias("text"))
    status = F.when(F.col("v") == "approve", "approved").when(F.col("v") == "reject", "rejected").otherwise("")
    return out.select(key, status.alias("status"), "text", F.col("text").isNotNull().cast("int").alias("edited"))


def reassigned(log: DataFrame, key: str, version: str, column: str) -> DataFrame:
    """Every change of column with the value before it."""
    before = F.lag(column).over(Window.partitionBy(key).orderBy(version))
    return log.withColumn("old", before).filter(F.col("old").isNotNull() & (F.col("old") != F.col(column)))


def pull_and_push(current: DataFrame, incoming: DataFrame, key: str, array: str, item: str) -> DataFrame:
    """Each array without items named like an incoming one, with the incoming ones, in order."""
    new = incoming.groupBy(key).agg(F.collect_list(array).alias("_new"))
    both = current.join(new, key, "left").withColumn("_new", F.coalesce("_new", F.array().cast(f"array<{incoming.schema[array].dataType.simpleString()}>")))
    kept = F.filter(array, lambda x: ~F.exists("_new", lambda y: y[item] == x[item]))
    return both.withColumn(array, F.array_sort(F.concat(kept, "_new"))).drop("_new")


def drop_rows(videos: DataFrame, key: str = "video_id", drops: str = "dropped_clips") -> DataFrame:
    """The embedded rejections as rows, with their parent's id, by clip."""
    return videos.select(key, F.explode(drops).alias("d")).select(key, "d.*").orderBy(key, "clip_id")


def record_drops(videos: DataFrame, drops: DataFrame, key: str = "video_id", array: str = "dropped_clips") -> DataFrame:
    """videos with the rejections (key, clip_id, ...) embedded; one of the same clip is replaced, an unknown parent is added."""
    parents = videos.unionByName(drops.select(key).distinct().join(videos, key, "left_anti"), allowMissingColumns=True)
    item = videos.schema[array].dataType.elementType
    entry = drops.select(key, F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in item]).alias(array))
    return pull_and_push(parents.withColumn(array, F.coalesce(array, F.array().cast(videos.schema[array].dataType))), entry, key, array, "clip_id")


def with_stubs(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """parents and a bare row for each key that only children have."""
    return parents.unionByName(children.select(key).distinct().join(parents, key, "left_anti"), allowMissingColumns=True)


def recovered(index: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """index and the rows that were found on disk but aren't in it; what a side lacks is null."""
    return index.unionByName(found.join(index.select(key), key, "left_anti"), allowMissingColumns=True)


def replace_array(rows: DataFrame, incoming: DataFrame, key: str, array: str) -> DataFrame:
    """rows whose array is replaced where incoming has the key; an empty one is taken off."""
    new = incoming.select(key, F.col(array).alias("_new"), F.lit(True).alias("_hit"))
    value = F.when(F.col("_hit"), F.when(F.size("_new") > 0, F.col("_new"))).otherwise(F.col(array))
    return rows.join(new, key, "left").withColumn(array, value).drop("_new", "_hit")


def editable_upsert(current: DataFrame, incoming: DataFrame, key: str, editable: Sequence[str]) -> DataFrame:
    """upsert of the editable columns alone; all others stay, and new rows have none."""
    own = incoming.select(key, *editable)
    old = set_columns(current, own, key)
    return old.unionByName(own.join(current, key, "left_anti"), allowMissingColumns=True)


def segment_rows(results: DataFrame) -> DataFrame:
    """Rows of the catalog from what a clip's analysis gives (segment_id, video_id, speaker_id, text, confidence, ...)."""
    blank = F.coalesce("speaker_id", F.lit("")) == ""
    nan = lambda c: F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c)
    return results.select(
        "segment_id", "video_id", F.regexp_replace("segment_id", r"_[^_]*$", "").alias("clip_id"), F.when(blank, F.concat("video_id", F.lit("_spk_unknown"))).otherwise(F.col("speaker_id")).alias("speaker_id"),
        "text", F.col("text").alias("original_text"), "num_words", F.coalesce(F.length("text"), F.lit(0)).alias("num_chars"), nan("conf_min"), F.round("visibility", 4).alias("visibility"),
        F.col("mismatch").cast("int").alias("mismatch"), F.lit(0.0).alias("wer"), F.col("num_words").alias("wer_words"),
    )


def finished_videos(videos: DataFrame, results: DataFrame, status: str, day, key: str = "video_id") -> DataFrame:
    """videos with what their finished segments (duration, asd_score) add up to; means stay where there are none."""
    sums = results.groupBy(key).agg(F.count("duration").alias("_n"), F.sum(F.col("duration").cast("decimal(20,6)")).cast("double").alias("_s"), (F.sum(F.col("asd_score").cast("decimal(20,6)")).cast("double") / F.count("asd_score")).alias("_a"))
    both, done = videos.join(sums, key, "left"), F.col("_n").isNotNull()
    new = {"status": F.lit(status), "processed_date": F.lit(day), "total_segments": F.col("_n"), "total_duration": F.col("_s"), "avg_asd": F.coalesce("_a", "avg_asd")}
    return both.withColumns({c: F.when(done, v).otherwise(F.col(c)) for c, v in new.items()}).drop("_n", "_s", "_a")


def synced_videos(videos: DataFrame, live: DataFrame, files: DataFrame, key: str = "video_id") -> DataFrame:
    """(key, total_segments, total_duration, avg_asd) of videos without totals that have files: live statistics, else the files'.

    live and files: (key, n, duration, asd).
    """
    own = videos.filter(F.coalesce("total_segments", F.lit(0)) == 0).select(key)
    told = lambda rows, p: rows.select(key, *[F.col(c).alias(f"{p}_{c}") for c in ("n", "duration", "asd")])
    both = own.join(told(files, "f"), key).join(told(live, "l"), key, "left")
    has = F.col("l_n").isNotNull()
    pick = lambda c: F.when(has, F.col(f"l_{c}")).otherwise(F.col(f"f_{c}"))
    return both.select(key, pick("n").alias("total_segments"), F.round(F.coalesce(pick("duration"), F.lit(0.0)), 2).alias("total_duration"), F.round(pick("asd"), 3).alias("avg_asd"))


def corrections(proposals: DataFrame, pairs: DataFrame, key: str, column: str, allowed: Sequence[str], text: str = "value") -> tuple[DataFrame, DataFrame]:
    """proposals with the column set by lines 'id:value' of an allowed value, and the ids that no row has."""
    parts = pairs.filter(F.col(text).contains(":")).select(F.trim(F.substring_index(text, ":", 1)).alias(key), F.lower(F.trim(F.expr(f"substring(`{text}`, instr(`{text}`, ':') + 1)"))).alias("_new"))
    own = parts.filter(F.col("_new").isin(*allowed)).dropDuplicates([key])
    done = proposals.join(own, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")
    return done, own.select(key).join(proposals, key, "left_anti")


def recomputed_wer(segments: DataFrame, original: str = "original_text", text: str = "text", key: str = "segment_id") -> DataFrame:
    """(key, wer, wer_words) of edited segments that have an original to compare with; others keep what they had."""
    some = segments.filter(F.coalesce(F.trim(original), F.lit("")) != "")
    return some.select(key, wer(F.col(original), F.col(text)).alias("wer"), F.size(stat_tokens(F.col(original))).alias("wer_words"))


def newest_backups(files: DataFrame, name: str, keep: int = 5) -> DataFrame:
    """files with expired: true beyond the newest `keep` names."""
    newest = files.select(name).orderBy(F.desc(name)).limit(keep)
    return files.join(newest.withColumn("_k", F.lit(True)), name, "left").withColumn("expired", F.col("_k").isNull()).drop("_k")


def job_states(events: DataFrame, now, stale_seconds: int = 60) -> DataFrame:
    """(job_id, status): the last status; running jobs whose last sign of life is too old are interrupted."""
    last = events.groupBy("job_id").agg(F.max_by("status", "at").alias("status"), F.max("at").alias("seen"))
    old = F.col("seen") < F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {stale_seconds} SECONDS")
    return last.select("job_id", F.when((F.col("status") == "running") & old, "interrupted").otherwise(F.col("status")).alias("status"))


def next_claim(states: DataFrame) -> DataFrame:
    """The oldest pending job, if none runs. Claiming it is for the caller's own store: a query can't be a lock."""
    one = states.agg(F.min(F.when(F.col("status") == "pending", F.col("job_id"))).alias("job_id"), F.count_if(F.col("status") == "running").alias("busy"))
    return one.filter("busy = 0 AND job_id IS NOT NULL").select("job_id")


#: The kinds of jobs that may be asked for.
JOB_TYPES = ("single", "batch", "resume", "resume_batch", "sync", "bulk_import")


def admissions(log: DataFrame, queue: str, order: str, kind: str, job_type: str) -> DataFrame:
    """(queue, order, answer, job_id) of every request in a queue's log, where one job at a time may be active.

    log: rows of kind 'request' (with a type) and 'end' (of whatever is active). A request of an unknown type is answered
    with 400, one while a job is active with 409 and that job's id, the others with 201 and the next id of the queue. An
    end opens the queue again, so that the first good request behind each end is the one that is taken: no state is
    carried from row to row but counts.
    """
    by = Window.partitionBy(queue).orderBy(order)
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    good = (F.col(kind) == "request") & F.coalesce(F.col(job_type).isin(*JOB_TYPES), F.lit(False))
    own = log.select(queue, order, kind, good.alias("_good")).withColumn("_ends", F.sum((F.col(kind) == "end").cast("int")).over(upto))
    before = F.sum(F.col("_good").cast("int")).over(Window.partitionBy(queue, "_ends").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    taken = own.withColumn("_taken", F.col("_good") & (before == 1)).withColumn("_id", F.sum(F.col("_taken").cast("int")).over(upto))
    answer = F.when(~F.col("_good"), 400).when(F.col("_taken"), 201).otherwise(409)
    return taken.filter(F.col(kind) == "request").select(queue, order, answer.alias("answer"), F.when(F.col("_good"), F.col("_id")).cast("bigint").alias("job_id"))


def delete_prefixes(rows: DataFrame, gone: DataFrame, key: str, prefix: str) -> DataFrame:
    """rows without those whose key begins with one of gone's prefixes and '_'.

    Every key is looked up by its own prefixes, so that this is an equi-join.
    """
    parts = F.split(key, "_")
    heads = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "_"))
    hit = rows.select(key, F.explode(heads).alias(prefix)).filter(F.col(prefix) != F.col(key)).join(gone.select(prefix), prefix, "left_semi").select(key).distinct()
    return rows.join(hit, key, "left_anti")


def rewrite_ids(rows: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """rows whose key 'prefix_number...' begins with a mapped id (old) get the new one in its place."""
    old = F.regexp_extract(key, r"^([A-Za-z]+_\d+)", 1)
    both = rows.withColumn("_old", old).join(mapping.select(F.col("old").alias("_old"), F.col("new").alias("_new")), "_old", "left")
    changed = F.concat(F.col("_new"), F.expr(f"substring(`{key}`, length(_old) + 1)"))
    return both.withColumn(key, F.coalesce(changed, F.col(key))).drop("_old", "_new")


def next_index(ids: DataFrame, column: str) -> DataFrame:
    """(stem, next) of ids 'stemN': the number after the largest."""
    p = r"^(.*?)(\d+)$"
    return ids.groupBy(F.regexp_extract(column, p, 1).alias("stem")).agg((F.max(F.regexp_extract(column, p, 2).cast("int")) + 1).alias("next"))


def mined_class(source: Column, extracted: Column) -> Column:
    """(pct, class) of how much of a source was taken; null without a source. 25 and 10 percent."""
    pct = F.when(source > 0, 100 * extracted / source)
    return F.struct(pct.alias("pct"), F.when(pct >= 25, "green").when(pct >= 10, "cyan").otherwise("dim").alias("class"))
