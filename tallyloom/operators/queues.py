"""Work queues over the catalog: who is next, in which order, and what a page of the explorer shows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.rules import known, not_rejected
from tallyloom.session import saved


def with_words(segments: DataFrame, words: str = "words", present: bool = True) -> DataFrame:
    """Segments that hold at least one embedded word, or none."""
    some = F.coalesce(F.size(words) > 0, F.lit(False))
    return segments.filter(some if present else ~some)


def rejected_ids(segments: DataFrame, key: str = "segment_id") -> DataFrame:
    return segments.filter("review_status = 'rejected'").select(key).distinct()


def resumable(videos: DataFrame, files: DataFrame, key: str = "video_id", status: str = "status") -> DataFrame:
    """Interrupted or failed videos whose files are still there."""
    return videos.filter(F.col(status).isin("processing", "failed")).join(files.select(key), key, "left_semi")


def registry(videos: DataFrame, status: str | None, search: str, columns: Sequence[str]) -> DataFrame:
    """Videos of a status (None: any) with the text in one of the columns, case aside."""
    hit = F.lit(search == "")
    for c in columns:
        hit = hit | F.coalesce(F.lower(F.col(c).cast("string")).contains(search.lower()), F.lit(False))
    return videos.filter(hit if status is None else hit & (F.col("status") == status))


def flag_set(c: Column) -> Column:
    """Flags as files bear them: true or 1, in any case."""
    return F.coalesce(F.lower(c.cast("string")).isin("true", "1"), F.lit(False))


def review_modes(segments: DataFrame, auto_speakers: DataFrame) -> DataFrame:
    """segments with `modes`, the review queues that each is in.

    auto_speakers: (speaker_id) of those matched across recordings by themselves. Queues by theme ignore the status.
    """
    auto = auto_speakers.select("speaker_id").distinct().withColumn("_auto", F.lit(True))
    own = segments.join(auto, "speaker_id", "left")
    says = lambda c, word: F.coalesce(F.lower(F.col(c)).contains(word), F.lit(False))
    modes = {
        "all": F.lit(True), "pending": F.coalesce(F.nullif("review_status", F.lit("")), F.lit("pending")) == "pending",
        "transcript-select": F.col("wer_dialect").isNotNull() & (F.coalesce("transcript_source", F.lit("")) == ""),
        "needs-review": flag_set(F.col("needs_review")), "auto-identity": F.coalesce("_auto", F.lit(False)),
        "mouth-fallback": says("mouth_roi_method", "fallback"), "forced-boundary": says("boundary_type", "forced"),
    }
    held = F.array(*[F.when(hit, F.lit(name)) for name, hit in modes.items()])
    return own.withColumn("modes", F.array_compact(held)).drop("_auto")


def review_order(name: str) -> list[Column]:
    """Sort columns of a review queue; missing measures count as 0, and a missing duration as endless for the shortest."""
    zero = lambda c: F.coalesce(known(F.col(c)), F.lit(0.0))
    return {
        "default": [], "most-dialect": [zero("wer_dialect").desc()], "worst-whisper": [zero("whisper_conf").asc()], "worst-asd": [zero("asd_score").asc()],
        "shortest": [F.coalesce(known(F.col("duration")), F.lit(float("inf"))).asc()], "longest": [zero("duration").desc()],
    }[name]


def explorer_order(option: str) -> list[Column]:
    """Sort columns of 'dur-asc', 'asd-desc', 'text-asc', ...: missing numbers come last both ways, missing texts are empty."""
    key, way = option.split("-")
    if key == "text":
        text = F.lower(F.coalesce("text", F.lit("")))
        return [text.asc() if way == "asc" else text.desc()]
    value = known(F.col({"dur": "duration", "asd": "asd_score", "sync": "syncnet_conf", "wh": "whisper_conf"}[key]))
    return [value.asc_nulls_last() if way == "asc" else value.desc_nulls_last()]


def speaker_order(column: str, ascending: bool, numeric: bool) -> list[Column]:
    """Sort columns of the speaker table: a missing number is below all, text compares in lower case and missing is ''."""
    value = known(F.col(column)) if numeric else F.lower(F.coalesce(column, F.lit("")))
    return [value.asc_nulls_first() if ascending else value.desc_nulls_last()]


def page(rows: DataFrame, order: Sequence[Column | str], first: int, last: int) -> DataFrame:
    """Rows first..last (from 1) of an order, with pos; the sort stops at the last row of the page."""
    head = rows.orderBy(*order).limit(last)
    return head.withColumn("pos", F.row_number().over(Window.orderBy(*order))).filter(F.col("pos") >= first)


def numbered(rows: DataFrame, order: Sequence[Column | str], name: str = "pos") -> DataFrame:
    """rows with their place (from 1) in an order that has no ties, for any number of rows.

    Ranges of the order are sorted side by side; a range's places follow those of the ranges before it, of which only the
    numbers of rows are added up. The ranges are written before they are counted, as they depend on samples.
    """
    at, low = F.monotonically_increasing_id(), 33  # the range, and below it the place within
    held = saved(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at))
    sizes = held.groupBy(F.shiftright("_at", low).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))
    placed = held.withColumn("_range", F.shiftright("_at", low)).join(F.broadcast(before), "_range")  # a row a range
    return placed.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << low) - 1) + 1).select(*rows.columns, name)


def tagging_queue(videos: DataFrame, order: str, columns: Sequence[str], channel: str | None = None, start: str | None = None, key: str = "video_id", everything: bool = False) -> DataFrame:
    """Videos with a tag missing, of a channel if one is named, from video `start` on if the queue holds it."""
    blank = F.lit(everything)
    for c in columns:
        blank = blank | F.col(c).isNull()
    own = videos.filter(blank)
    own = own if channel is None else own.filter(F.coalesce("channel", F.lit("")) == channel)
    if start is None:
        return own
    begin = own.filter(F.col(key) == start).agg(F.min(order).alias("_begin"))
    return own.join(F.broadcast(begin)).filter(F.col("_begin").isNull() | (F.col(order) >= F.col("_begin"))).drop("_begin")


def dialect_queue(segments: DataFrame, target: str, tier: str | None = None, videos: Sequence | None = None, force: bool = False, limit: int | None = None, key: Sequence[str] = ("segment_id",)) -> DataFrame:
    """Segments that lack the target transcript (all with force), by tier and id; a limit where one is asked for."""
    own = segments.filter(not_rejected(F.col("review_status")))
    own = own if tier is None else own.filter(F.col("quality_tier") == tier)
    own = own if not videos else own.filter(F.col("video_id").isin(*videos))
    own = own if force else own.filter(F.coalesce(target, F.lit("")) == "")
    ordered = own.orderBy(F.coalesce("quality_tier", F.lit("")), *key)
    return ordered.limit(limit) if limit else ordered


def refined(segments: DataFrame, wer: str, least: float = 0.15) -> DataFrame:
    """segments with needs_review: the refined transcript is further than `least` from the first."""
    return segments.withColumn("needs_review", F.coalesce(known(F.col(wer)) > least, F.lit(False)))


def transcript_list(segments: DataFrame, skip_identical: bool, by_wer: bool, tier: str | None = None, key: Sequence[str] = ("segment_id",)) -> tuple[DataFrame, list[Column]]:
    """Pending segments and their order: large differences first if by_wer, else by tier and id."""
    own = segments.filter(F.coalesce("review_status", F.lit("")).isin("", "pending"))
    own = own if tier is None else own.filter(F.col("quality_tier") == tier)
    own = own.filter(F.coalesce("wer_dialect", F.lit(0.0)) != 0) if skip_identical else own
    w = F.coalesce("wer_dialect", F.lit(0.0))
    order = [F.when(w > 0.05, 0).otherwise(1).asc(), w.desc()] if by_wer else [F.coalesce(F.nullif("quality_tier", F.lit("")), F.lit("Z")).asc(), *[F.col(k).asc() for k in key]]
    return own, order


#: What a recording's environment and background noise may be called.
ENVIRONMENTS, NOISES = ("indoor", "outdoor", "studio", "mixed", "unknown"), ("none", "low", "moderate", "high")


def checked_proposals(proposals: DataFrame, allowed: dict[str, Sequence[str]], key: str = "video_id") -> DataFrame:
    """(key, column, value, valid) of the proposed values that aren't blank, trimmed and in lower case."""
    value = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    each = [F.struct(F.lit(c).alias("column"), value(c).alias("value"), value(c).isin(*ok).alias("valid")) for c, ok in allowed.items()]
    return proposals.select(key, F.explode(F.array(*each)).alias("x")).select(key, "x.*").filter("value <> ''")


def orphan_cause(status: Column, has_video: Column, has_annotation: Column) -> Column:
    """Why a row has no files."""
    return (
        F.when(F.coalesce(status == "rejected", F.lit(False)), "rejected").when(~has_video & ~has_annotation, "both_missing")
        .when(~has_annotation, "anno_missing").when(~has_video, "video_missing").otherwise("unknown")
    )


def tier_name(c: Column) -> Column:
    """A, B or C of any spelling; else null."""
    tier = F.upper(F.trim(c.cast("string")))
    return F.when(tier.isin("A", "B", "C"), tier)


def newest_jobs(jobs: DataFrame, n: int = 50, key: str = "job_id") -> DataFrame:
    return jobs.orderBy(F.desc(key)).limit(n)


def cancel_unclaimed(jobs: DataFrame, now) -> DataFrame:
    """jobs (status, started_at, finished_at) with those cancelled that were asked to stop before anyone had claimed them."""
    idle = (F.col("status") == "cancel_requested") & F.col("started_at").isNull()
    at = F.lit(now).cast(jobs.schema["finished_at"].dataType)
    return jobs.withColumns({"finished_at": F.when(idle, at).otherwise(F.col("finished_at")), "status": F.when(idle, "cancelled").otherwise(F.col("status"))})


def eligible(videos: DataFrame, mode: str, retry_failed: bool = False) -> DataFrame:
    """Videos that a job of the mode may take: pending ones in a batch, interrupted and failed ones when it resumes."""
    status = ("pending",) if mode == "batch-pending" else ("failed",) if retry_failed else ("processing", "failed")
    return videos.filter(F.col("status").isin(*status))
