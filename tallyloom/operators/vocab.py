"""Vocabulary: words with samples, occurrences and duration."""

from __future__ import annotations

import functools
import math
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.text import STRIPPED
from tallyloom.operators.stats import exact_sum
from tallyloom.session import ship


def recorded(segments: DataFrame, key: str = "segment_id", words: str = "words") -> DataFrame:
    """(word, key, n, duration) of embedded words (word, start, end); they aren't cleaned again."""
    w = segments.select(key, F.explode(words).alias("w"))
    length = F.greatest(F.coalesce("w.end", F.lit(0.0)) - F.coalesce("w.start", F.lit(0.0)), F.lit(0.0))
    return w.groupBy(F.col("w.word").alias("word"), key).agg(F.count(F.lit(1)).alias("n"), exact_sum(length).alias("duration"))


#: Words that a task counts before it hands them on.
MOST_WORDS = 200_000


def micros(seconds: float | None, parts: int) -> int | None:
    """A part of so many seconds in millionths, rounded half up as a cast to decimal(20,6) does; None if it isn't known."""
    if seconds is None or not math.isfinite(seconds):
        return None
    return int(Decimal(repr(seconds / parts)).quantize(Decimal("0.000001"), ROUND_HALF_UP).scaleb(6))


def fallback(segments: DataFrame, text: str, duration: str) -> DataFrame:
    """(word, samples, n, duration) of segments without words, not yet summed: their cleaned tokens share the duration evenly.

    Words are counted within their row, and then over rows of a task up to a bound: texts and tokens are never shuffled.
    Array functions take four times as long.
    """
    ship(segments.sparkSession)
    own = segments.select(F.upper(F.coalesce(text, F.lit(""))).alias("text"), F.col(duration).cast("double").alias("d"))

    def count(batches):
        held: dict[str, list] = {}

        def told():
            rows = [(w, x[0], x[1], None if x[2] is None else Decimal(x[2]).scaleb(-6)) for w, x in held.items()]
            names, kinds = ("word", "samples", "n", "duration"), (pa.string(), pa.int64(), pa.int64(), pa.decimal128(30, 6))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for upper, seconds in zip(batch.column("text").to_pylist(), batch.column("d").to_pylist(), strict=True):
                own: dict[str, int] = {}
                for raw, n in Counter(upper.split()).items():
                    if word := raw.strip(STRIPPED):
                        own[word] = own.get(word, 0) + n
                share = micros(seconds, sum(own.values())) if own else None
                for word, n in own.items():
                    x = held.get(word)
                    if x is None:
                        held[word] = [1, n, None if share is None else share * n]
                    else:
                        x[0] += 1
                        x[1] += n
                        if share is not None:
                            x[2] = (x[2] or 0) + share * n
                if len(held) > MOST_WORDS:
                    yield told()
                    held = {}
        if held:
            yield told()

    return own.mapInArrow(count, "word string, samples bigint, n bigint, duration decimal(30,6)")


def vocabulary(*entries: DataFrame) -> DataFrame:
    """(word, samples, occurrences, duration); a word counts once a segment as a sample, where entries don't say how often."""
    counted = [e if "samples" in e.columns else e.withColumn("samples", F.lit(1)) for e in entries]
    whole = functools.reduce(DataFrame.unionByName, [e.select("word", "samples", "n", "duration") for e in counted])
    return whole.groupBy("word").agg(
        F.sum("samples").alias("samples"), F.sum("n").alias("occurrences"), F.round(F.sum("duration"), 2).cast("double").alias("duration")
    )


def with_shares(vocab: DataFrame) -> DataFrame:
    """Derived columns of a vocabulary: length, share of all occurrences in percent, mean duration."""
    total = vocab.agg(F.sum("occurrences").alias("total"))
    return vocab.join(F.broadcast(total)).select(
        vocab["*"], F.length("word").alias("len"), F.round(100.0 * F.col("occurrences") / F.col("total"), 4).alias("share"),
        F.round(F.col("duration") / F.col("occurrences"), 4).alias("avg_duration"),
    )


def rare_words(tokens: DataFrame, word: str = "word") -> DataFrame:
    """One row: distinct words, and those that occur once or twice."""
    n = tokens.groupBy(word).agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.count(F.lit(1)).alias("unique_words"), F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"))


def top(rows: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows and their rank; ties end by the columns given last."""
    return rows.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
