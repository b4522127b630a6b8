"""Operators over ordered streams: segmentation, carrying forward, interpolation, coverage, renumbering."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.text import ends_sentence
from tallyloom.operators.tracks import in_order


def boundaries(words: DataFrame, keys: Sequence[str], order: Sequence[str], silence: float = 0.5) -> DataFrame:
    """words (raw, start, end, speaker) with end_type (null inside a unit) and unit, the number of the unit.

    The end of the media comes before punctuation, a change of speaker, and silence.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    next_start, next_speaker = F.lead("start").over(w), F.lead("speaker").over(w)
    kind = (
        F.when(next_start.isNull(), "media").when(ends_sentence(F.col("raw")), "punctuation")
        .when(next_speaker != F.col("speaker"), "speaker_change").when(next_start - F.col("end") >= silence, "silence")
    )
    typed = words.withColumn("end_type", kind)
    before = F.sum(F.col("end_type").isNotNull().cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return typed.withColumn("unit", F.coalesce(before, F.lit(0)))


def units(marked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Units of marked words: start, end, words, dominant voice (the first of equals) and what ended them."""
    votes = marked.filter("speaker IS NOT NULL").groupBy(*keys, "unit", "speaker").agg(F.count(F.lit(1)).alias("n"), F.min("start").alias("first"))
    voice = votes.groupBy(*keys, "unit").agg(F.max_by("speaker", F.struct("n", -F.col("first"))).alias("voice"))
    sums = marked.groupBy(*keys, "unit").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n_words"), F.max("end_type").alias("end_type"))
    return sums.join(voice, [*keys, "unit"], "left")


@dataclass(frozen=True)
class Segmentation:
    """Limits of the sentence windows, in seconds."""

    silence: float = 0.5
    target_min: float = 2.0
    target_max: float = 12.0
    hard_min: float = 1.0
    hard_max: float | None = None
    merge_gap: float = 1.0
    pad: float = 0.15


def _voice(speakers: Sequence[str | None]) -> str | None:
    """The most frequent; the first seen of equals; None if all are missing."""
    n = Counter(x for x in speakers if x is not None)
    return max(n, key=n.get) if n else None


def _largest_gap(starts: np.ndarray, ends: np.ndarray) -> int:
    """Index of the word after which the longest pause lies; the one nearest the middle of equals."""
    gap, middle = starts[1:] - ends[:-1], (len(starts) - 1) / 2
    widest = np.flatnonzero(gap == gap.max())
    return int(widest[np.abs(widest - middle).argmin()])


def sentence_windows(words: DataFrame, key: str, order: Sequence[str], limits: Segmentation = Segmentation(), pieces: bool = True) -> DataFrame:
    """(key, window, start, end, n_words, text, voice, start_type, end_type) of every recording's sentences.

    Boundaries are found by window functions; merging short units and splitting long ones depends on what was done
    before, so it runs in Python. No rule looks across a unit's end behind which there is silence of more than the merge gap
    and both paddings: recordings are cut there, each piece is decided by itself, and prefix sums of the pieces'
    numbers of windows number them. The longest stretch without such a silence bounds what is held; without pieces a recording is one.
    """
    marked = boundaries(words, [key], order, limits.silence)
    w = Window.partitionBy(key).orderBy(*order)
    ends = F.lit(pieces) & F.col("end_type").isNotNull() & (F.lead("start").over(w) - F.col("end") > max(limits.merge_gap, 2 * limits.pad))
    marked = marked.withColumn("_ends", ends).withColumns({"_piece": F.coalesce(F.sum(F.col("_ends").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_began": F.coalesce(F.lag("end_type").over(w), F.lit("media"))})
    needed = ["_began", "unit", "start", "end", "clean", "speaker", "end_type"]
    marked = marked.select(key, "_piece", *needed, *[c for c in order if c not in ("start", "end")])
    kind = dict(words.dtypes)[key]

    def gather(piece: dict, state):
        return None, [*(state or []), {c: piece[c] for c in needed}]

    def build(name: tuple, state: list) -> dict:
        own = {c: state[0][c] if len(state) == 1 else np.concatenate([s[c] for s in state]) for c in needed}
        at, till = own["start"].astype(float), own["end"].astype(float)
        starts, ends = at.tolist(), till.tolist()
        speakers = [None if x is None or x != x else x for x in own["speaker"].tolist()]
        kinds, clean = own["end_type"].tolist(), own["clean"].tolist()
        edges = [0, *(np.flatnonzero(np.diff(own["unit"])) + 1).tolist(), len(starts)]
        runs, before = [], own["_began"][0]  # (first word, last word + 1, what began it, what ended it)
        for a, z in pairwise(edges):
            began, before = before, kinds[z - 1]
            if runs:
                first, last, kind_first, _ = runs[-1]
                short = ends[last - 1] - starts[first] < limits.target_min and starts[a] - ends[last - 1] <= limits.merge_gap
                if short and ends[z - 1] - starts[first] <= limits.target_max:
                    voices = _voice(speakers[first:last]), _voice(speakers[a:z])
                    if None in voices or voices[0] == voices[1]:
                        runs[-1] = (first, z, kind_first, before)
                        continue
            runs.append((a, z, began, before))
        whole = []
        for run in runs:
            todo = [run]
            while todo:
                a, z, began, ended = todo.pop()
                if limits.hard_max is None or ends[z - 1] - starts[a] <= limits.hard_max or z - a < 2:
                    whole.append((a, z, began, ended))
                    continue
                middle = a + _largest_gap(at[a:z], till[a:z]) + 1
                todo += [(middle, z, "word_gap", ended), (a, middle, began, "word_gap")]
        rows = []
        for i, (a, z, began, ended) in enumerate(whole):
            start, end = starts[a], ends[z - 1]
            room = [limits.pad, limits.pad]
            if i:
                room[0] = min(limits.pad, max(0.0, (start - ends[whole[i - 1][1] - 1]) / 2))
            if i + 1 < len(whole):
                room[1] = min(limits.pad, max(0.0, (starts[whole[i + 1][0]] - end) / 2))
            first, last = max(0.0, start - room[0]), end + room[1]
            if last - first >= limits.hard_min:
                text = " ".join(w for w in clean[a:z] if w)
                rows.append((*name, len(rows), first, last, z - a, text, _voice(speakers[a:z]) or "", began, ended))
        return {c: [r[i] for r in rows] for i, c in enumerate(names)} if rows else None

    schema = f"{key} {kind}, _piece bigint, window int, start double, end double, n_words int, text string, voice string, start_type string, end_type string"
    names = [key, "_piece", "window", "start", "end", "n_words", "text", "voice", "start_type", "end_type"]
    # a task walks through its pieces in order; a group each would cost more than what is decided in it
    found = in_order(marked, [key, "_piece"], order, gather, schema, build)
    # the windows of a piece follow those of all pieces before it; a row for each piece is what is summed
    earlier = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, 0)
    counted = found.groupBy(key, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = counted.select(key, "_piece", (F.sum("_n").over(earlier) - F.col("_n")).cast("int").alias("_before"))
    return found.join(before, [key, "_piece"]).withColumn("window", F.col("window") + F.col("_before")).drop("_piece", "_before")


def islands(rows: DataFrame, keys: Sequence[str], at: str, gap: Column) -> DataFrame:
    """rows with island, the number of the run of rows no two of which are further apart than gap says."""
    w = Window.partitionBy(*keys).orderBy(at)
    new = F.coalesce((F.col(at) - F.lag(at).over(w) >= gap).cast("int"), F.lit(0))
    return rows.withColumn("_new", new).withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def equal_chunks(spans: DataFrame, longest: float) -> DataFrame:
    """spans (start, end) cut into equal parts no longer than longest."""
    n = F.greatest(F.lit(1), F.ceil((F.col("end") - F.col("start")) / longest)).cast("int")
    cut = spans.withColumn("_n", n).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    step = (F.col("end") - F.col("start")) / F.col("_n")
    return cut.withColumns({"start": F.col("start") + step * F.col("part"), "end": F.col("start") + step * (F.col("part") + 1)}).drop("_n")


def carry_forward(rows: DataFrame, keys: Sequence[str], at: str, column: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(column, F.last(column, ignorenulls=True).over(w))


def interpolate(rows: DataFrame, keys: Sequence[str], at: str, column: str, hold_edges: bool = False) -> DataFrame:
    """Gaps (null or NaN) filled linearly over `at`; before the first and after the last value null, or held."""
    v = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    back = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(at).rowsBetween(0, Window.unboundedFollowing)
    point = F.when(F.col("_v").isNotNull(), F.struct(F.col(at).alias("x"), F.col("_v").alias("y")))
    a, b = F.last(point, ignorenulls=True).over(back), F.first(point, ignorenulls=True).over(ahead)
    held = rows.withColumn("_v", v).withColumns({"_a": a, "_b": b})
    line = F.col("_a.y") + (F.col("_b.y") - F.col("_a.y")) * (F.col(at) - F.col("_a.x")) / (F.col("_b.x") - F.col("_a.x"))
    edge = F.coalesce("_a.y", "_b.y") if hold_edges else F.lit(None).cast("double")
    out = F.when(F.col("_v").isNotNull(), F.col("_v")).when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), line).otherwise(edge)
    return held.withColumn(column, out).drop("_v", "_a", "_b")


def merged_spans(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The union of spans (start, end) of each key, as disjoint spans."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col("start") > reach).cast("int"), F.lit(1))
    marked = spans.withColumn("_new", new).withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_g").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_g")


def coverage(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, coverage): frames in the union of closed frame spans over all frames from the first to the last."""
    joined = merged_spans(spans, keys)
    return joined.groupBy(*keys).agg((F.sum(F.col("end") - F.col("start") + 1) / (F.max("end") - F.min("start") + 1)).alias("coverage"))


def rolling_corr(rows: DataFrame, keys: Sequence[str], at: str, a: str, b: str, reach: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(at).rowsBetween(-reach, reach)
    return rows.withColumn("corr", F.corr(a, b).over(w))


def best_lag(rows: DataFrame, keys: Sequence[str], at: str, a: str, b: str, most: int) -> DataFrame:
    """(keys, lag, corr): the shift of b against a, in rows, of the highest correlation; the smallest shift of equals."""
    by_key = Window.partitionBy(*keys)
    shifted = lambda c, lag: F.lead(c, lag).over(by_key.orderBy(at)) if lag > 0 else F.lag(c, -lag).over(by_key.orderBy(at))
    lags = [x for x in range(-most, most + 1) if x]
    own = rows.select(*keys, F.col(at).alias("_at"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    at = "_at"
    met = own.select(*keys, "_a", F.col("_b").alias("_b0"), *[shifted("_b", x).alias(f"_b{x}") for x in lags])
    # rows stay where the windows have put them: no pairs are shuffled, and null behind an end is a missing value to corr
    sums = met.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.corr("_a", F.col(f"_b{x}")).alias(f"_c{x}") for x in (0, *lags)])
    each = sums.select(*keys, "_n", F.inline(F.array(*[F.struct(F.lit(x).alias("lag"), F.col(f"_c{x}").alias("corr")) for x in (0, *lags)])))
    each = each.withColumn("n", F.col("_n") - F.abs("lag")).filter("n > 2 AND corr IS NOT NULL AND NOT isnan(corr)").dropna(subset=list(keys))
    best = F.max_by(F.struct("lag", "corr"), F.struct(F.round("corr", 9), -F.abs("lag"), -F.col("lag"))).alias("x")
    return each.groupBy(*keys).agg(best).select(*keys, "x.lag", "x.corr")


def renumber(rows: DataFrame, prefix: str, number: str, width: str) -> DataFrame:
    """rows with new_id: within a prefix and width the survivors get 1, 2, ... in order of their numbers, zero-padded."""
    n = F.row_number().over(Window.partitionBy(prefix, width).orderBy(number))
    return rows.withColumn("new_id", F.concat(F.col(prefix), F.lit("_"), F.lpad(n.cast("string"), F.greatest(F.col(width), F.length(n.cast("string"))), "0")))


def trim_words(words: Column, low: Column, high: Column) -> Column:
    """Words (word, start, end) that meet low..high, shifted to begin at 0 and clamped."""
    kept = F.filter(words, lambda w: (w["end"] > low) & (w["start"] < high))
    return F.transform(kept, lambda w: F.struct(
        w["word"].alias("word"), F.round(F.greatest(w["start"], low) - low, 2).alias("start"), F.round(F.least(w["end"], high) - low, 2).alias("end")))


def trimmed(segments: DataFrame, low: str, high: str, words: str = "words", text: str = "text") -> DataFrame:
    """segments cut to low..high: words, and from them text (kept if no word is left), num_words and duration."""
    kept = segments.withColumn(words, trim_words(F.col(words), F.col(low), F.col(high)))
    own = F.array_join(F.transform(words, lambda w: w["word"]), " ")
    return kept.withColumns({
        text: F.when(F.size(words) > 0, own).otherwise(F.col(text)), "num_words": F.size(words), "duration": F.round(F.col(high) - F.col(low), 3), "trimmed": F.lit(1),
    })


def score_by_ratio(scores: Column, i: Column, n: Column) -> Column:
    """The score of word i of n when the scores are spread over the words by index."""
    k = F.size(scores)
    return F.get(scores, F.least(F.floor(i * k / n), k - 1).cast("int"))
