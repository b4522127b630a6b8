"""Queries of live views: rows of a changing table, kept up to date batch by batch instead of being computed anew."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.plans import binding as b
from tallyloom.registry import query
from tallyloom.session import fresh_path
from tallyloom.streaming import live

#: The rows as they stand after all changes: drafts of a quarter of the videos stay, a fifth of the videos is deleted.
S = f"""WITH a AS ({b.SEG}), s AS (SELECT video_id, speaker_id, CASE WHEN video_id % 4 = 0 THEN duration + 1 ELSE duration END AS duration, asd_score, wer,
    CASE WHEN video_id % 4 = 0 THEN 'C' ELSE tier END AS tier, review_status FROM a WHERE video_id % 5 <> 0)"""
DUR = "CAST(duration AS DECIMAL(20,6))"
ASD = "CAST(asd_score AS DECIMAL(20,6))"


def changes(spark, d):
    """Batches of changes of the segments: drafts of all, then what replaces most of them, then deletions and late changes."""
    own = b.segments(spark, d).select("video_id", "segment_no", "l_partkey", "speaker_id", "duration", "asd_score", "wer", "tier", "review_status", "l_extendedprice")
    number, v = F.col("video_id") * 10 + F.col("segment_no"), F.col("video_id")
    image = lambda seq, op, duration, tier: own.select(
        (number + seq).cast("bigint").alias("seq"), F.lit(op).alias("op"), F.concat_ws("_", "video_id", "segment_no", "l_partkey", "speaker_id", "l_extendedprice").alias("id"), v.cast("string").alias("video_id"), "speaker_id", duration.alias("duration"),
        F.col("asd_score"), F.col("wer"), tier.alias("tier"), "review_status")
    draft = image(1 << 40, "upsert", F.col("duration") + 1, F.lit("C"))
    final = image(2 << 40, "upsert", F.col("duration"), F.col("tier"))
    late = image(0, "upsert", F.col("duration") + 7, F.lit("B")).filter(F.col("video_id").cast("bigint") % 7 == 0)
    gone = image(3 << 40, "delete", F.col("duration"), F.col("tier")).filter(F.col("video_id").cast("bigint") % 5 == 0)
    return [draft, final.filter(F.col("video_id").cast("bigint") % 4 != 0), gone.unionByName(late)]


def opened(spark, d, view) -> live.LiveViews:
    """A view without rows, with a bucket for each million of segments, and for each core."""
    return live.LiveViews(spark, fresh_path(spark, "live"), max(spark.sparkContext.defaultParallelism, b.segments(spark, d).count() // 1_000_000), [view])


def applied(spark, d, view) -> live.LiveViews:
    """The view after all batches, the second of which comes twice."""
    views, batches = opened(spark, d, view), changes(spark, d)
    for epoch in (0, 1, 1, 2):
        views.apply(batches[epoch], epoch)
    return views


@query("live_video_stats", f"""{S} SELECT video_id::BIGINT video_id, count(*) total_segments, round(sum({DUR}), 2)::DOUBLE total_duration, floor(sum({ASD})::DOUBLE / count(*) * 1e3 + 0.5) / 1e3 avg_asd,
    count(*) FILTER (WHERE tier='A') tier_a, count(*) FILTER (WHERE tier='B') tier_b, count(*) FILTER (WHERE tier='C') tier_c FROM s GROUP BY 1""")
def live_video_stats(spark, d):
    return applied(spark, d, "videos").video_stats().withColumn("video_id", F.col("video_id").cast("bigint"))


@query("live_fresh_video_stats", f"""{S} SELECT video_id::BIGINT video_id, count(*) total_segments, round(sum({DUR}), 2)::DOUBLE total_duration, floor(sum({ASD})::DOUBLE / count(*) * 1e3 + 0.5) / 1e3 avg_asd,
    count(*) FILTER (WHERE tier='A') tier_a, count(*) FILTER (WHERE tier='B') tier_b, count(*) FILTER (WHERE tier='C') tier_c FROM s WHERE review_status <> 'rejected' GROUP BY 1""")
def live_fresh_video_stats(spark, d):
    return applied(spark, d, "videos").video_stats(fresh=True).withColumn("video_id", F.col("video_id").cast("bigint"))


@query("live_speaker_stats", f"""{S} SELECT speaker_id, count(DISTINCT video_id) video_count, count(*) total_segments, round(sum({DUR}), 2)::DOUBLE total_duration,
    floor(sum({ASD})::DOUBLE / count(*) * 1e3 + 0.5) / 1e3 avg_asd, floor(sum(CAST(coalesce(wer, 0) AS DECIMAL(20,6)))::DOUBLE / count(*) * 1e4 + 0.5) / 1e4 avg_wer FROM s WHERE speaker_id <> '' GROUP BY 1""")
def live_speaker_stats(spark, d):
    return applied(spark, d, "speakers").speaker_stats()


@query("live_overview", f"""{S} SELECT count(*) segments, count(DISTINCT video_id) videos, count(DISTINCT speaker_id) speakers, round((sum({DUR}) / 3600)::DECIMAL(20,6), 2)::DOUBLE AS hours FROM s""")
def live_overview(spark, d):
    """The same by a stream over a log of changes, and read back from the payload of its last version."""
    log, views = fresh_path(spark, "change-log"), opened(spark, d, "totals")
    payloads = live.Payloads(views, {"overview": lambda v, version: v.dataset_overview(version=version)})
    for batch in changes(spark, d):
        batch.write.mode("append").option("compression", "zstd").parquet(log)
        views.follow(spark.readStream.schema(live.CHANGES).parquet(log), f"{views.path}/progress").trigger(availableNow=True).start().awaitTermination()
        payloads.refresh()
    rows, fresh = payloads.get("overview")
    return rows.filter(F.lit(fresh))
