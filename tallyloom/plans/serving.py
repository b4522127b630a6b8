"""Payloads of the query entry points as DataFrames; streaming.live keeps them by version of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.rules import confidence_level, known, not_rejected
from tallyloom.functions.text import SPACE, stat_token
from tallyloom.operators import stats
from tallyloom.operators.queues import tier_name


def documents(rows: DataFrame, *order: str) -> DataFrame:
    """(json) of each row, in order if one is asked for."""
    own = rows.orderBy(*order) if order else rows
    return own.select(F.to_json(F.struct("*")).alias("json"))


def segment_list(segments: DataFrame, with_rejected: bool = False) -> DataFrame:
    own = segments if with_rejected else segments.filter(not_rejected(F.col("review_status")))
    return documents(own, "video_id", "segment_no")


def segment_detail(segments: DataFrame, video_id, segment_no) -> DataFrame:
    return documents(segments.filter((F.col("video_id") == video_id) & (F.col("segment_no") == segment_no)))


def videos_with_stats(videos: DataFrame, segments: DataFrame) -> DataFrame:
    """Videos with their live statistics; 0 where there are none."""
    live = stats.fresh_video_stats(segments)
    return videos.join(live, "video_id", "left").na.fill(0, [c for c in live.columns if c != "video_id"])


def video_list(videos: DataFrame, segments: DataFrame) -> DataFrame:
    return documents(videos_with_stats(videos, segments), "video_id")


def speaker_list(segments: DataFrame) -> DataFrame:
    return documents(stats.speaker_stats(segments), "speaker_id")


def _part(rows: DataFrame, part: str, key: Column, n: Column, value: Column) -> DataFrame:
    return rows.select(F.lit(part).alias("part"), key.cast("string").alias("key"), n.cast("bigint").alias("n"), value.cast("double").alias("value"))


def _single(row: DataFrame, part: str, names: Sequence[str], counts: Sequence[str] = ()) -> DataFrame:
    """The columns of one row as rows: counts in n, other names in value."""
    each = [F.struct(F.lit(c).alias("key"), F.col(c).cast("bigint").alias("n"), F.lit(None).cast("double").alias("value")) for c in counts]
    each += [F.struct(F.lit(c).alias("key"), F.lit(None).cast("bigint").alias("n"), F.col(c).cast("double").alias("value")) for c in names]
    return row.select(F.lit(part).alias("part"), F.inline(F.array(*each)))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _sum(c: str | Column, when: Column | None = None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(stats.exact_sum(c if when is None else F.when(when, c)).cast("double"), F.lit(0.0))


def _counts(rows: DataFrame, column: str, part: str, most: int = 20) -> DataFrame:
    """The most frequent values that aren't blank; ties by the value."""
    value = F.trim(F.col(column).cast("string"))
    n = rows.filter(F.coalesce(value, F.lit("")) != "").groupBy(value.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return _part(n.orderBy(F.desc("n"), "k").limit(most), part, F.col("k"), F.col("n"), F.lit(None))


def video_payload(videos: DataFrame, counted: Sequence[str] = ("region", "source", "license", "channel")) -> DataFrame:
    """(part, key, n, value) of the registry: status, durations and their spread, values of columns, speech by region.

    videos: (status, extracted, duration, region and the counted columns).
    """
    spread = [F.round(f(c), 2).alias(f"{name}_{c}") for c in ("duration",) for name, f in (("min", F.min), ("max", F.max))]
    some = F.when(F.col("extracted") > 0, F.col("extracted"))
    one = videos.agg(
        F.count(F.lit(1)).alias("total"), stats.rounded(_sum("extracted") / 3600, 2).alias("extracted_h"), stats.rounded(_sum("duration"), 2).alias("source_s"), *spread,
        stats.exact_avg(F.col("duration"), 2).alias("mean_duration"), F.round(F.min(some), 2).alias("min_extracted"), F.round(F.max(some), 2).alias("max_extracted"), stats.exact_avg(some, 2).alias("mean_extracted"),
    )
    region = F.coalesce("region", F.lit("UNKNOWN"))
    speech = videos.groupBy(region.alias("k")).agg(stats.rounded(_sum("extracted"), 2).alias("s")).filter("s > 0")
    status = videos.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    values = ["extracted_h", "source_s", "min_duration", "max_duration", "mean_duration", "min_extracted", "max_extracted", "mean_extracted"]
    return _union([
        _single(one, "totals", values, ["total"]), _part(status, "by_status", F.col("status"), F.col("n"), F.lit(None)),
        _part(speech, "speech_by_region", F.col("k"), F.lit(None), F.col("s")), *[_counts(videos, c, f"by_{c}") for c in counted],
    ])


def segment_payload(segments: DataFrame) -> DataFrame:
    """(part, key, n, value) of the segments that aren't rejected: one wide aggregate and a few small groupings."""
    status = F.coalesce("review_status", F.lit(""))
    whole = segments.agg(F.count_if(status == "rejected").alias("rejected"), F.count_if((F.coalesce("transcript_edited", F.lit(0)) == 1) | (F.coalesce("trimmed", F.lit(0)) == 1)).alias("edited"))
    own = segments.filter(not_rejected(F.col("review_status"))).withColumns({"_tier": tier_name(F.col("quality_tier")), "_ok": status == "approved", "_conf": confidence_level(F.col("whisper_conf_min"), F.col("whisper_conf"))})
    d, ok = known(F.col("duration")), F.col("_ok")
    counts = {"total": F.count(F.lit(1)), "words": F.sum("num_words"), "chars": F.sum("num_chars"), "with_wer": F.count(known(F.col("wer"))), "approved": F.count_if(ok),
        "approved_words": F.coalesce(F.sum(F.when(ok, F.col("num_words"))), F.lit(0)), "ready": F.count_if(ok & F.col("_tier").isin("A", "B")), "min_words": F.min("num_words"), "max_words": F.max("num_words")}
    counts |= {f"conf_{k}": F.count_if(F.col("_conf") == k) for k in ("3", "2", "1", "unknown")} | {f"tier_{t}": F.count_if(F.col("_tier") == t) for t in "ABC"}
    values = {"duration_s": stats.rounded(_sum(d), 2), "approved_s": stats.rounded(_sum(d, ok), 2), "ready_s": stats.rounded(_sum(d, ok & F.col("_tier").isin("A", "B")), 2),
        "avg_wer": stats.exact_avg(known(F.col("wer"))), "min_s": F.round(F.min(d), 2), "mean_s": stats.exact_avg(d, 2), "max_s": F.round(F.max(d), 2), "mean_words": stats.exact_avg(F.col("num_words").cast("double"), 1),
        "avg_asd": stats.exact_avg(F.col("asd_score"), 3), "avg_sync": stats.exact_avg(F.col("syncnet_conf"), 3), "avg_conf": stats.exact_avg(F.col("whisper_conf"), 3),
        "wpm": F.when(_sum(d) > 0, stats.rounded(F.sum("num_words") / _sum(d) * 60, 1)).otherwise(0.0)}
    values |= {f"tier_{t}_s": stats.rounded(_sum(d, F.col("_tier") == t), 2) for t in "ABC"}
    one = own.agg(*[c.alias(k) for k, c in (counts | values).items()])
    quantiles = stats.quantiles(own, "duration")
    bands = stats.duration_bands(own)
    region = own.groupBy(F.coalesce("region", F.lit("UNKNOWN")).alias("k")).agg(F.count(F.lit(1)).alias("n"), stats.rounded(_sum(d), 1).alias("s"))
    words = own.select("_ok", F.explode_outer(F.split("text", SPACE)).alias("raw")).select("_ok", stat_token(F.col("raw")).alias("word")).filter("word <> ''")
    each = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.max("_ok").alias("ok"))
    vocabulary = each.agg(F.count(F.lit(1)).alias("unique"), F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"), F.count_if("ok").alias("approved"))
    return _union([
        _single(one, "totals", list(values), list(counts)), _single(whole, "all", [], ["rejected", "edited"]), _single(quantiles, "duration", quantiles.columns), _single(vocabulary, "vocabulary", [], vocabulary.columns),
        _part(bands, "bands", F.col("band"), F.col("n"), F.col("duration")), _part(region, "by_region", F.col("k"), F.col("n"), F.col("s")),
    ])


def overview(segments: DataFrame) -> DataFrame:
    """(part, key, n, value) of totals, quantiles, bands, balance and funnel; each part is a small aggregate."""
    fresh = segments.filter(not_rejected(F.col("review_status")))
    quantiles, balance = stats.quantiles(fresh, "duration"), stats.speaker_balance(fresh)
    return _union([
        _single(stats.dataset_overview(fresh), "totals", ["hours"], ["segments", "videos", "speakers"]), _single(quantiles, "duration", quantiles.columns),
        _part(stats.duration_bands(fresh), "bands", F.col("band"), F.col("n"), F.col("duration")), _single(balance, "balance", ["top1_pct", "top10_pct"], ["n_speakers", "with_10min", "under_1min"]),
        _part(stats.training_funnel(fresh), "funnel", F.col("step"), F.col("n"), F.col("duration")),
    ])


def as_json(payload: DataFrame) -> DataFrame:
    """(part, json): a payload's parts as documents of their keys."""
    entry = F.struct("key", F.struct("n", "value"))
    return payload.groupBy("part").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("json"))


#: The goal of the corpus in hours.
TARGET_HOURS = 200


def kpis(videos: DataFrame, segments: DataFrame, target_region: str, target_hours: float = TARGET_HOURS) -> DataFrame:
    """One row of the funnel from source to approved speech; rejected segments are out, and so `pending` counts them twice."""
    status = F.coalesce("review_status", F.lit(""))
    v = videos.agg(_sum("duration").alias("source_s"), F.count_if(F.col("status") == "completed").alias("done"))
    fresh, d = status != "rejected", F.col("duration")
    s = segments.agg(
        F.count_if(fresh).alias("total"), F.count_if(status == "approved").alias("approved"), F.count_if(status == "rejected").alias("rejected"), _sum(d, fresh).alias("extracted_s"),
        _sum(d, status == "approved").alias("approved_s"), _sum(d, fresh & (F.col("region") == target_region)).alias("target_s"),
    )
    pct = lambda a, b: F.when(b > 0, stats.rounded(100 * a / b, 1)).otherwise(0.0)
    c = F.col
    return v.join(F.broadcast(s)).select(
        "total", "approved", F.greatest(F.lit(0), c("total") - c("approved") - c("rejected")).alias("pending"), pct(c("extracted_s"), c("source_s")).alias("mined_pct"),
        pct(c("approved_s"), c("extracted_s")).alias("approved_pct"), pct(c("target_s"), F.lit(target_hours * 3600.0)).alias("target_pct"),
        F.when(c("total") > 0, stats.rounded(c("extracted_s") / c("total"), 1)).alias("mean_clip_s"), F.when(c("done") > 0, stats.rounded(c("extracted_s") / c("done"), 1)).alias("speech_per_video_s"),
    )


def explorer_strip(segments: DataFrame) -> DataFrame:
    """One row over what the explorer shows: rows, seconds of those above 0, their mean, videos and approved ones."""
    some = F.when(known(F.col("duration")) > 0, F.col("duration"))
    return segments.agg(
        F.count(F.lit(1)).alias("n"), stats.rounded(_sum(some), 3).alias("seconds"), F.coalesce(stats.exact_avg(some, 3), F.lit(0.0)).alias("mean_s"),
        F.count_distinct("video_id").alias("videos"), F.count_if(F.col("review_status") == "approved").alias("approved"),
    )


def distributions(segments: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(part, key, n, value): number, least, mean, median, p95 and largest value of each column, to three decimals."""
    measures = {"n": F.count, "min": lambda v: F.round(F.min(v), 3), "mean": lambda v: stats.exact_avg(v, 3), "max": lambda v: F.round(F.max(v), 3)}
    one = segments.agg(*[f(known(F.col(c))).alias(f"{c}.{k}") for c in columns for k, f in measures.items()])
    nothing = F.lit(None)
    entry = lambda c, k: F.struct(
        F.lit(c).alias("part"), F.lit(k).alias("key"), (F.col(f"`{c}.n`") if k == "n" else nothing).cast("bigint").alias("n"),
        (nothing if k == "n" else F.col(f"`{c}.{k}`")).cast("double").alias("value"),
    )
    rows = one.select(F.inline(F.array(*[entry(c, k) for c in columns for k in measures])))
    ranked = stats.column_quantiles(segments, columns, (("median", 0.5), ("p95", 0.95)), 3)
    return _union([rows, *[_single(q, c, ["median", "p95"]) for c, q in ranked.items()]])
