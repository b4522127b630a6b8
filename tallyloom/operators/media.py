"""Operators over what media analysis leaves: chunks of words, vectors, audio samples, lip landmarks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType

from tallyloom.functions.rules import noise_class
from tallyloom.operators.ordered import carry_forward, interpolate
from tallyloom.operators.tracks import gaussian_window, in_order, one_euro_piece
from tallyloom.session import ship


def chunk_plan(media: DataFrame, longest: float = 7200.0, overlap: float = 60.0) -> DataFrame:
    """(media_id, chunk, clean_start, clean_end, audio_start, audio_end) of media (media_id, duration)."""
    n = F.greatest(F.lit(1), F.ceil(F.col("duration") / longest)).cast("int")
    each = media.withColumn("_n", n).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).withColumn("_d", F.col("duration") / F.col("_n"))
    start = F.col("chunk") * F.col("_d")
    end = F.when(F.col("chunk") < F.col("_n") - 1, (F.col("chunk") + 1) * F.col("_d")).otherwise(F.col("duration"))
    return each.select("media_id", "chunk", start.alias("clean_start"), end.alias("clean_end"), F.greatest(F.lit(0.0), start - overlap).alias("audio_start"), F.least("duration", end + overlap).alias("audio_end"))


def stitch(words: DataFrame, plan: DataFrame) -> DataFrame:
    """Words (media_id, chunk, start, end in the chunk's audio) of each chunk's own zone, in the media's time."""
    met = words.join(plan, ["media_id", "chunk"]).withColumns({"start": F.col("start") + F.col("audio_start"), "end": F.col("end") + F.col("audio_start")})
    return met.filter((F.col("start") >= F.col("clean_start")) & (F.col("start") < F.col("clean_end"))).drop("clean_start", "clean_end", "audio_start", "audio_end")


def middle(duration: Column, longest: float) -> Column:
    """(start, end) of the middle of a clip, no longer than longest."""
    start = F.greatest(F.lit(0.0), (duration - longest) / 2)
    return F.struct(start.alias("start"), F.least(duration, start + longest).alias("end"))


def to_clip_time(at: Column, clip_start: Column, length: Column) -> Column:
    """An absolute time in a clip's own time, clamped to it."""
    return F.greatest(F.lit(0.0), F.least(at - clip_start, length))


def zero_based(words: Column) -> Column:
    """(shift, words): words whose times are shifted so that none is negative."""
    low = F.least(F.lit(0.0), F.coalesce(F.array_min(F.transform(words, lambda w: w["start"])), F.lit(0.0)))
    return F.struct(low.alias("shift"), F.transform(words, lambda w: w.withField("start", w["start"] - low).withField("end", w["end"] - low)).alias("words"))


def from_zero_based(shifted: Column) -> Column:
    """The words of zero_based with their own times again."""
    return F.transform(shifted["words"], lambda w: w.withField("start", w["start"] + shifted["shift"]).withField("end", w["end"] + shifted["shift"]))


def feature_rows(rows: Column, start: Column, end: Column, rate: int = 100) -> Column:
    """Rows of an array at rate a second between start and end, clamped."""
    first = F.least(F.greatest(F.floor(start * rate).cast("int"), F.lit(0)), F.size(rows))
    last = F.least(F.greatest(F.floor(end * rate).cast("int"), first), F.size(rows))
    return F.slice(rows, first + 1, last - first)


def sampled(rows: DataFrame, key: str, order: str, parts: int = 4) -> DataFrame:
    """Every n/parts-th row of a key, at most parts of them."""
    w = Window.partitionBy(key)
    one = rows.withColumns({"_i": F.row_number().over(w.orderBy(order)) - 1, "_n": F.count(F.lit(1)).over(w)})
    step = F.greatest(F.floor(F.col("_n") / parts), F.lit(1))
    return one.filter((F.col("_i") % step == 0) & (F.col("_i") / step < parts)).drop("_i", "_n")


@F.pandas_udf(BinaryType())
def vector_bytes_udf(v: pd.Series) -> pd.Series:
    return v.map(lambda x: None if x is None else np.asarray(x, "<f4").tobytes())


@F.pandas_udf(ArrayType(FloatType()))
def bytes_vector_udf(v: pd.Series) -> pd.Series:
    return v.map(lambda x: None if x is None else np.frombuffer(x, "<f4"))


def audio_features(samples: np.ndarray, rate: int) -> tuple[float, float, float]:
    """Loudness in dB, spectral flatness, and the share of energy between 300 and 3400 Hz."""
    level = 20 * np.log10(max(float(np.sqrt(np.mean(np.square(samples, dtype=np.float64)))), 1e-6))
    power = np.abs(np.fft.rfft(samples * np.hanning(len(samples)).astype(np.float32))) ** 2 + 1e-12
    pitch = np.fft.rfftfreq(len(samples), 1 / rate)
    flat = np.exp(np.log(power).mean()) / power.mean()
    voice = power[(pitch >= 300) & (pitch <= 3400)].sum() / power.sum()
    return round(level, 2), round(float(flat), 4), round(float(voice), 4)


def noise_tags(audio: DataFrame, key: str) -> DataFrame:
    """(key, rms_db, flatness, voice_ratio, noise) of audio (key, samples array<float>, rate)."""
    ship(audio.sparkSession)
    kind = dict(audio.dtypes)[key]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own = pdf[pdf["samples"].map(lambda s: s is not None and len(s) > 0)]
            rows = [(k, *audio_features(np.asarray(s, np.float32), r)) for k, s, r in zip(own[key], own["samples"], own["rate"], strict=True)]
            yield pd.DataFrame(rows, columns=[key, "rms_db", "flatness", "voice_ratio"])

    found = audio.select(key, "samples", "rate").mapInPandas(work, f"{key} {kind}, rms_db double, flatness double, voice_ratio double")
    return found.withColumn("noise", noise_class(F.col("flatness"), F.col("voice_ratio")))


def nearest_landmarks(landmarks: DataFrame, clip: str = "clip", half: str = "width") -> DataFrame:
    """landmarks with gaps taken from the frame nearest to them, the earlier of equals."""
    back = Window.partitionBy(clip).orderBy("frame").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(clip).orderBy("frame").rowsBetween(0, Window.unboundedFollowing)
    here = F.when(F.col(half).isNotNull(), F.struct("frame", "cx", "cy", half))
    held = landmarks.withColumns({"_a": F.last(here, ignorenulls=True).over(back), "_b": F.first(here, ignorenulls=True).over(ahead)})
    later = F.col("_a").isNull() | (F.col("_b.frame") - F.col("frame") < F.col("frame") - F.col("_a.frame"))
    near = F.when(later & F.col("_b").isNotNull(), F.col("_b")).otherwise(F.col("_a"))
    return held.withColumn("_near", near).withColumns({c: F.col(f"_near.{c}") for c in ("cx", "cy", half)}).drop("_a", "_b", "_near")


def widest_mouth_trajectory(landmarks: DataFrame, clip: str = "clip", multiplier: float = 1.8, least_half: int = 20, sigma: float = 3.0) -> DataFrame:
    """(clip, frame, x, y, half): centres of the nearest landmarks, Gaussian smoothed; the size follows the widest mouth."""
    held = nearest_landmarks(landmarks, clip)
    half = held.groupBy(clip).agg(F.greatest(F.lit(least_half), (F.max("width") * multiplier / 2).cast("int")).alias("half"))
    x = gaussian_window(held.select(clip, "frame", "cx", "cy"), clip, "frame", "cx", sigma).withColumnRenamed("smoothed", "sx")
    y = gaussian_window(x, clip, "frame", "cy", sigma)
    return y.join(half, clip).select(clip, "frame", F.rint("sx").cast("int").alias("x"), F.rint("smoothed").cast("int").alias("y"), "half")


def mouth_trajectory(landmarks: DataFrame, clip: str = "clip", multiplier: float = 1.8, least_half: int = 20, smoothing: str = "one_euro", **options) -> DataFrame:
    """(clip, frame, x, y, half, roll) of landmarks (clip, frame, cx, cy, width, roll), null where none was found.

    The size follows the median width; gaps carry the last landmarks forward (the first ones backward) before centres
    are smoothed.
    """
    ship(landmarks.sparkSession)
    half = landmarks.filter("width IS NOT NULL").groupBy(clip).agg(F.greatest(F.lit(least_half), (F.percentile("width", F.lit(0.5)) * multiplier / 2).cast("int")).alias("half"))
    held = landmarks
    for c in ("cx", "cy", "roll"):
        held = carry_forward(held, [clip], "frame", c)
    for c in ("cx", "cy"):
        held = interpolate(held, [clip], "frame", c, hold_edges=True)
    rows = held.select(clip, "frame", "cx", "cy", F.coalesce("roll", F.lit(0.0)).alias("roll"))
    if smoothing == "gaussian":
        x = gaussian_window(rows, clip, "frame", "cx", **options)
        done = gaussian_window(x.drop("cx").withColumnRenamed("smoothed", "cx"), clip, "frame", "cy", **options).drop("cy").withColumnRenamed("smoothed", "cy")
    else:
        kind = dict(landmarks.dtypes)[clip]

        def step(piece: dict, state):
            both = [one_euro_piece(piece[c].astype(float), state and state[i], **options) for i, c in enumerate(("cx", "cy"))]
            return piece | {"cx": both[0][0], "cy": both[1][0]}, [after for _, after in both]

        done = in_order(rows, clip, ["frame"], step, f"{clip} {kind}, frame int, cx double, cy double, roll double")
    return done.join(half, clip).select(clip, "frame", F.rint("cx").cast("int").alias("x"), F.rint("cy").cast("int").alias("y"), "half", "roll")


def landmark_failures(landmarks: DataFrame, clip: str = "clip") -> DataFrame:
    """(clip, fail_rate)."""
    return landmarks.groupBy(clip).agg((F.count_if(F.col("width").isNull()) / F.count(F.lit(1))).alias("fail_rate"))


def median_box(boxes: DataFrame, key: str) -> DataFrame:
    return boxes.groupBy(key).agg(*[F.percentile(c, F.lit(0.5)).cast("int").alias(c) for c in ("x", "y", "w", "h")])


def word_confidence(words: DataFrame, key: str, confidence: str = "confidence") -> DataFrame:
    """(key, mean, least, p25, low_quarter): nulls and NaN don't count; low_quarter is the sorted value at n // 4 - 1."""
    c = F.nanvl(F.col(confidence), F.lit(None).cast("double"))
    each = words.groupBy(key).agg(F.avg(c).alias("mean"), F.min(c).alias("least"), F.percentile(c, F.lit(0.25)).alias("p25"), F.sort_array(F.collect_list(c)).alias("s"))
    at = F.greatest(F.floor(F.size("s") / 4).cast("int") - 1, F.lit(0))
    return each.select(key, "mean", "least", "p25", F.get("s", at).alias("low_quarter"))
