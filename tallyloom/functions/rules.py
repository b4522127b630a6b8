"""Scoring rules as Column builders; thresholds are data that callers may replace."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tier:
    conf: float
    conf_min: float
    visibility: float
    mouth_fail: float


@dataclass(frozen=True)
class TierRules:
    """Thresholds of the quality tiers and the paths that cap a segment at B."""

    a: Tier = Tier(0.90, 0.70, 0.95, 0.05)
    b: Tier = Tier(0.70, 0.50, 0.85, 0.15)
    preferred: tuple[float, float] = (2.0, 12.0)
    degraded: dict = field(
        default_factory=lambda: {
            "asd_method": ("fallback_motion",), "syncnet_method": ("fallback_correlation", "error"),
            "mouth_roi_method": ("retinaface_fallback",), "boundary_start_type": ("forced",), "boundary_end_type": ("forced",),
        }
    )


def known(c: Column) -> Column:
    """NaN is null, so that no comparison holds for it."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def quality_tier(rules: TierRules = TierRules(), c=F.col) -> Column:
    """A, B or C; missing measures fail."""
    passes = lambda t: (
        (known(c("whisper_conf")) >= t.conf) & (known(c("whisper_conf_min")) >= t.conf_min)
        & (known(c("face_visibility_ratio")) >= t.visibility) & (known(c("mouth_landmark_fail_rate")) <= t.mouth_fail)
    )
    capped = F.coalesce(~c("duration").between(*rules.preferred), F.lit(False))
    for name, values in rules.degraded.items():
        capped = capped | F.coalesce(c(name).isin(*values), F.lit(False))
    return F.when(~capped & passes(rules.a), "A").when(passes(rules.b), "B").otherwise("C")


def cap_mismatch(tier: Column, mismatch: Column) -> Column:
    """A voice whose face is another's caps A at B."""
    return F.when((mismatch == 1) & (tier == "A"), "B").otherwise(tier)


def confidence_level(least: Column, mean: Column) -> Column:
    """'3', '2', '1' or 'unknown' from the least and the mean word confidence. The limits."""
    lo, mid = known(least), known(mean)
    return (
        F.when(lo.isNull() | mid.isNull(), "unknown").when((lo >= 0.7) & (mid >= 0.9), "3")
        .when((lo >= 0.5) & (mid >= 0.7), "2").otherwise("1")
    )


def band(value: Column, edges: Sequence[float], labels: Sequence[str], missing: str | None = None) -> Column:
    """Half-open bands: labels[i] for edges[i-1] <= value < edges[i]; the last label takes the rest."""
    out = F.when(value.isNull(), F.lit(missing))
    for edge, label in zip(edges, labels, strict=False):
        out = out.when(value < edge, label)
    return out.otherwise(labels[-1])


DURATION_EDGES = (1, 3, 6, 10, 15)
DURATION_BANDS = ("<1s", "1-3s", "3-6s", "6-10s", "10-15s", ">15s")


def histogram_bin(value: Column, low: float, high: float, n: int) -> Column:
    """Bin 0..n-1 of n equal ones, the last closed; null outside."""
    out = F.when(value.isNull() | (value < low) | (value > high), F.lit(None).cast("int"))
    for i in range(1, n):
        out = out.when(value < F.lit(low + i * (high - low) / n), i - 1)
    return out.otherwise(n - 1)


def consensus_label(sm: Column, sl: Column, ml: Column, limit: float = 0.20) -> Column:
    """Agreement of three transcripts by the error rates of their pairs (sm, sl, ml); a pair agrees below limit.

    Fixed values: the labels. Of one or two agreeing pairs ml names the label first, then sl, then sm.
    """
    near = [x < limit for x in (sm, sl, ml)]
    n = sum((x.cast("int") for x in near), F.lit(0))
    return (
        F.when(n.isNull(), "insufficient").when(n == 3, "all_agree").when(n == 0, "all_disagree")
        .when(near[2], "dialectal_agree").when(near[1], "std_large_agree").otherwise("std_med_agree")
    )


#: Upper limits of the classes of an error rate, and their names.
WER_CLASSES = ((0.0, "identical"), (0.05, "almost identical"), (0.20, "dialect captured"), (0.40, "large changes"))


def wer_label(wer: Column) -> Column:
    out = F.when(wer.isNull(), "none")
    for limit, label in WER_CLASSES:
        out = out.when(wer <= limit, label)
    return out.otherwise("grave")


@dataclass(frozen=True)
class ClipGates:
    """Limits that a clip must keep."""

    visibility: float = 0.7
    confidence: float = 0.2
    asd: float = 0.5
    overlap: float = 0.3


def clip_gates(limits: ClipGates = ClipGates(), c=F.col) -> list[tuple[str, Column, Column | None]]:
    """The checks of a clip, in order, for drop_reason; a measure that was never taken is null and fails no limit.

    Fixed values: the codes.
    """
    no = lambda x: F.coalesce(x, F.lit(False))
    return [
        ("processing_error", no(c("failed")), None), ("no_face_track", no(c("tracks") == 0), None), ("face_visibility", no(c("visibility") < limits.visibility), c("visibility")),
        ("whisper_error", no(c("whisper_failed")), None), ("no_transcription", no(c("transcripts") == 0), None), ("empty_transcription", F.coalesce(F.trim(c("text")), F.lit("")) == "", None),
        ("unknown_confidence", no(F.isnan(c("confidence"))), None), ("low_confidence", no(c("confidence") < limits.confidence), c("confidence")), ("no_track_overlaps_speech", no(~c("overlaps")), None),
        ("low_asd_score", no(c("asd") < limits.asd), c("asd")), ("track_too_short", no(c("track_overlap") < limits.overlap), c("track_overlap")), ("no_words_in_track_range", no(c("words_left") == 0), None),
        ("export_failed", no(~c("exported")), None),
    ]


def drop_reason(checks: Sequence[tuple[str, Column, Column | None]]) -> Column:
    """The first failed check as code or code=value; null if none fails. checks: (code, failed, value)."""
    out = None
    for code, failed, value in checks:
        says = F.lit(code) if value is None else F.concat(F.lit(f"{code}="), F.format_string("%.2f", value))
        out = F.when(failed, says) if out is None else out.when(failed, says)
    return out


def reason_struct(c: Column) -> Column:
    """'code=1.25' as (code, value, decimals); other texts are a code alone."""
    p = r"^([a-z_]+)=(-?\d+(?:\.\d+)?)$"
    hit, number = c.rlike(p), F.regexp_extract(c, p, 2)
    return F.struct(
        F.when(hit, F.regexp_extract(c, p, 1)).otherwise(c).alias("code"), F.when(hit, number.try_cast("double")).alias("value"),
        F.when(hit, F.length(F.regexp_extract(number, r"\.(\d+)$", 1))).alias("decimals"),
    )


def reason_text(reason: Column) -> Column:
    """The inverse: the value with its decimals."""
    shown = F.array(*[F.format_string(f"%.{n}f", reason["value"]) for n in range(10)])
    number = F.get(shown, F.coalesce(reason["decimals"], F.lit(0)))
    return F.when(reason["value"].isNull(), reason["code"]).otherwise(F.concat(reason["code"], F.lit("="), number))


#: Noise classes, the flatness from which and the voice ratio below which each holds.
NOISE = (("high", 0.18, 0.35), ("moderate", 0.10, 0.55), ("low", 0.05, 0.75))


def noise_class(flatness: Column, voice: Column) -> Column:
    out = None
    for label, flat, ratio in NOISE:
        hit = (flatness >= flat) | (voice < ratio)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise("none")


#: Limits of the colour classes.
COLOURS = {"asd": (5.0, 2.0), "sync": (0.55, 0.40), "whisper": (0.75, 0.55)}


def colour(value: Column, kind: str) -> Column:
    high, middle = COLOURS[kind]
    v = known(value)
    return F.when(v.isNull(), "dim").when(v >= high, "green").when(v >= middle, "orange").otherwise("red")


def age_group(age: Column) -> Column:
    return F.when(age.isNull(), "").when(age < 31, "18-30").when(age < 51, "31-50").otherwise("51+")


def review_flagged(status: Column, edited: Column, trimmed: Column) -> Column:
    return (F.coalesce(status, F.lit("")) != "") | (F.coalesce(edited, F.lit(0)) != 0) | F.coalesce(trimmed == 1, F.lit(False))


def not_rejected(status: Column) -> Column:
    return F.coalesce(status, F.lit("")) != "rejected"
