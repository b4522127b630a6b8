"""Aggregates over segments, speakers and videos."""

from __future__ import annotations

import functools
import math
import struct
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.rules import DURATION_BANDS, DURATION_EDGES, band, histogram_bin, known, not_rejected
from tallyloom.functions.text import digit_share
from tallyloom.session import saved


def exact_sum(c: Column) -> Column:
    """The sum of a double as a decimal, whatever the order of rows."""
    return F.sum(c.cast("decimal(20,6)"))


def exact_avg(c: Column, digits: int = 4) -> Column:
    return rounded(exact_sum(c).cast("double") / F.count(c), digits)


def rounded(c: Column, digits: int) -> Column:
    """Half up in binary floating point, so that other engines agree on ties."""
    scale = 10.0**digits
    return F.floor(c * scale + 0.5) / scale


def speaker_stats(segments: DataFrame) -> DataFrame:
    """Live view: every speaker but ''; rejected rows count; a missing error rate is 0."""
    return segments.filter("speaker_id <> ''").groupBy("speaker_id").agg(
        F.count_distinct("video_id").alias("video_count"), F.count(F.lit(1)).alias("total_segments"),
        F.round(exact_sum(F.col("duration")), 2).cast("double").alias("total_duration"),
        exact_avg(F.col("asd_score"), 3).alias("avg_asd"), exact_avg(F.coalesce("wer", F.lit(0.0))).alias("avg_wer"),
    )


def video_stats(segments: DataFrame) -> DataFrame:
    tier = lambda t: F.count_if(F.col("tier") == t)
    return segments.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("total_segments"), F.round(exact_sum(F.col("duration")), 2).cast("double").alias("total_duration"),
        exact_avg(F.col("asd_score"), 3).alias("avg_asd"), tier("A").alias("tier_a"), tier("B").alias("tier_b"), tier("C").alias("tier_c"),
    )


def fresh_video_stats(segments: DataFrame) -> DataFrame:
    return video_stats(segments.filter(not_rejected(F.col("review_status"))))


def dataset_overview(segments: DataFrame) -> DataFrame:
    """One row; '' is a speaker here, a null isn't."""
    return segments.agg(
        F.count(F.lit(1)).alias("segments"), F.count_distinct("video_id").alias("videos"), F.count_distinct("speaker_id").alias("speakers"),
        F.round(exact_sum(F.col("duration")) / 3600, 2).cast("double").alias("hours"),
    )


def training_funnel(segments: DataFrame) -> DataFrame:
    """(step, n, duration) of five filters, each on top of those before; a missing value passes none."""
    visual = (known(F.col("asd_score")) >= 2) & (known(F.col("mouth_fail")) < 0.5)
    text = visual & (known(F.col("whisper_conf")) > 0.20) & (F.col("num_words") >= 4)
    length = text & F.col("duration").between(1.0, 16.0)
    agreed = length & F.col("consensus").isin("all_agree", "dialectal_agree")
    steps = {"1_all": F.col("duration").isNotNull(), "2_visual": visual, "3_text": text, "4_length": length, "5_agreed": agreed}
    sums = [x for k, c in steps.items() for x in (F.count_if(c).alias(f"n{k}"), F.sum(F.when(c, F.col("duration").cast("decimal(20,6)"))).alias(f"d{k}"))]
    one = segments.agg(*sums)
    rows = F.array(*[F.struct(F.lit(k).alias("step"), F.col(f"n{k}").alias("n"), F.round(F.coalesce(F.col(f"d{k}"), F.lit(0)).cast("double"), 1).alias("duration")) for k in steps])
    return one.select(F.inline(rows))


#: Bits below those that one pass towards an order statistic counts: sign and exponent first, then 13 of the fraction each.
PASSES = (52, 39, 26, 13, 0)


def with_order_key(rows: DataFrame, column: str, name: str) -> DataFrame:
    """rows with a bigint that sorts like the doubles of a column: the bit pattern, negative for negative numbers; both zeros are 0.

    One step a projection, since each uses the one before several times.
    """
    v, (size, guess, exponent, scaled) = F.col(column), (f"{name}{i}" for i in range(4))
    c, power = F.col, lambda e: F.pow(F.lit(2.0), e.cast("double"))
    some = (c(size) > 0) & (c(size) < float("inf"))
    # the logarithm may miss by one next to a power of two; powers of two and quotients by them are exact
    low = F.when(power(c(guess)) > c(size), -1).when(power(c(guess) + 1) <= c(size), 1).otherwise(0)
    bits = F.when(c(scaled) >= 1, (c(exponent) + 1022) * (1 << 52)).otherwise(0) + (c(scaled) * float(1 << 52)).cast("bigint")
    bits = F.when(some, bits).when(c(size) == 0, 0).when(v.isNotNull(), 0x7FF << 52)
    return (
        rows.withColumn(size, F.abs(v))
        .withColumn(guess, F.when(some, F.greatest(F.floor(F.log2(size)), F.lit(-1022))))
        .withColumn(exponent, F.greatest(c(guess) + low, F.lit(-1022)))
        .withColumn(scaled, c(size) / power(c(exponent)))  # 1 to 2, below 1 for subnormal numbers only
        .withColumn(name, F.when(v < 0, -bits).otherwise(bits).cast("bigint"))
        .drop(size, guess, exponent, scaled)
    )


def key_value(k: Column) -> Column:
    """The double of a with_order_key."""
    a = F.abs(k)
    e, fraction = F.shiftright(a, 52), (a % (1 << 52)).cast("double") / float(1 << 52)
    size = F.when(e == 0x7FF, F.lit(float("inf"))).when(e == 0, fraction * F.pow(F.lit(2.0), F.lit(-1022.0))).otherwise((fraction + 1) * F.pow(F.lit(2.0), (e - 1023).cast("double")))
    return F.when(k < 0, -size).otherwise(size)


def value_of_key(k: int) -> float:
    return math.copysign(struct.unpack("<d", struct.pack("<q", abs(k)))[0], k)


def order_statistics(rows: DataFrame, columns: Sequence[str], ranks: Callable[[int], Sequence[int]]) -> dict[str, tuple[int, dict[int, float]]]:
    """For each column the number n of known values, and the values at ranks(n) of their sorted order, from 0.

    Radix selection on the bit patterns: a pass over all columns at once counts the bins below every prefix that a rank
    is still looked for in, and goes on in the bin that holds it, until that has one value. There are as many passes as
    PASSES at most, for any values; a pass brings a few thousand rows of counts for each open prefix to the driver.
    """
    entry = lambda i, c: F.struct(F.lit(i).alias("c"), known(F.col(c)).alias("v"))
    own = rows.select(F.inline(F.array(*[entry(i, c) for i, c in enumerate(columns)]))).filter("v IS NOT NULL")
    own = with_order_key(own, "v", "k").select("c", "k")
    found: dict[int, dict[int, float]] = {i: {} for i in range(len(columns))}
    n, open_, before = dict.fromkeys(found, 0), None, None
    for shift in PASSES:
        near = own
        if open_ is not None:
            prefixes = own.sparkSession.createDataFrame(sorted({(i, p) for i, p, _, _ in open_}), "c int, p bigint")
            near = own.withColumn("p", F.shiftright("k", before)).join(F.broadcast(prefixes), ["c", "p"])
        counts = near.groupBy("c", F.shiftright("k", shift).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).collect()
        bins: dict[tuple, list] = {}
        for r in sorted(counts, key=lambda r: (r.c, r.b)):
            bins.setdefault((r.c, r.b >> (before - shift) if open_ is not None else None), []).append(r)
        if open_ is None:
            n |= {c: sum(r.n for r in own_bins) for (c, _), own_bins in bins.items()}
            open_ = [(c, None, r, r) for c in found if n[c] for r in ranks(n[c])]
        left = []
        for c, prefix, rank, rest in open_:
            for r in bins[c, prefix]:
                if rest < r.n:
                    break
                rest -= r.n
            if r.low == r.high:
                found[c][rank] = value_of_key(r.low)
            else:
                left.append((c, r.b, rank, rest))
        open_, before = left, shift
        if not open_:
            break
    return {name: (n[i], found[i]) for i, name in enumerate(columns)}


SHARES = (("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("p95", 0.95))


def both_ranks(shares: Sequence[tuple[str, float]]) -> Callable[[int], list[int]]:
    return lambda n: sorted({int(f(p * (n - 1))) for _, p in shares for f in (math.floor, math.ceil)})


def between(low: float, high: float, share: float) -> float:
    """Linear interpolation; equal ends are that value, infinite ones too."""
    return low if low == high or share == 0 else low * (1 - share) + high * share if math.isinf(high - low) else low + (high - low) * share


def column_quantiles(rows: DataFrame, columns: Sequence[str], shares: Sequence[tuple[str, float]] = SHARES, digits: int = 2) -> dict[str, DataFrame]:
    """For each column one row of its quantiles with linear interpolation, null without values, by the same passes."""

    def values(n: int, at: dict[int, float]) -> tuple:
        place = lambda p: p * (n - 1)
        return tuple(float(between(at[math.floor(place(p))], at[math.ceil(place(p))], place(p) % 1)) if n else None for _, p in shares)

    told, schema = order_statistics(rows, columns, both_ranks(shares)), ", ".join(f"{name} double" for name, _ in shares)
    return {c: rows.sparkSession.createDataFrame([values(*told[c])], schema).select(*[F.round(name, digits).alias(name) for name, _ in shares]) for c in columns}


def quantiles(segments: DataFrame, column: str, shares: Sequence[tuple[str, float]] = SHARES, digits: int = 2) -> DataFrame:
    """One row: p25, median, p75, p95 with linear interpolation; null without values."""
    return column_quantiles(segments, [column], shares, digits)[column]


def grouped_quantiles(rows: DataFrame, keys: Sequence[str], column: str, shares: Sequence[tuple[str, float]] = SHARES, digits: int = 2) -> DataFrame:
    """(keys, n, quantiles) of every group, exact for any number and size of groups; groups without values have nulls.

    Rows of a group with equal values are counted first, partly before the shuffle, and only these counts are read again.
    The passes of order_statistics as joins: every pass counts the bins of each group's open prefixes, so that a group of
    most rows is a few thousand counts a task; running sums of these find each rank's bin. Open prefixes are broadcast up
    to 65,536 of them and 32 MB: a few large groups would otherwise be a task each.
    """
    keys = list(keys)
    name = {k: f"_g{i}" for i, k in enumerate(keys)}
    g = list(name.values())
    base = with_order_key(rows.select(*[F.col(f"`{k}`").alias(a) for k, a in name.items()], known(F.col(column)).alias("_v")).groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_w")), "_v", "_k").drop("_v")
    base = saved(base)
    equal = lambda x, y: [F.col(f"{x}.{a}").eqNullSafe(F.col(f"{y}.{a}")) for a in g]
    groups = base.groupBy(*g).agg(F.coalesce(F.sum(F.when(F.col("_k").isNotNull(), F.col("_w"))), F.lit(0)).alias("_n"))
    wanted = F.array(*[f((F.col("_n") - 1) * p).cast("bigint") for _, p in shares for f in (F.floor, F.ceil)])
    open_ = groups.filter("_n > 0").select(*g, F.explode(F.array_distinct(wanted)).alias("_rank")).withColumns({"_p": F.lit(0).cast("bigint"), "_rest": F.col("_rank")})
    done = []
    for shift, before in zip(PASSES, (None, *PASSES), strict=False):
        near = base.filter("_k IS NOT NULL").withColumn("_p", F.lit(0).cast("bigint") if before is None else F.shiftright("_k", before)).alias("x")
        if before is not None:
            prefixes = open_.select(*g, "_p").distinct()
            near = near.join((F.broadcast(prefixes) if few else prefixes).alias("o"), [*equal("x", "o"), F.col("x._p") == F.col("o._p")], "left_semi")
        bins = near.groupBy(*g, "_p", F.shiftright("_k", shift).alias("_b")).agg(F.sum("_w").alias("_m"), F.min("_k").alias("_low"), F.max("_k").alias("_high"))
        upto = F.sum("_m").over(Window.partitionBy(*g, "_p").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
        held = (F.col("o._rest") < F.col("b._upto")) & (F.col("o._rest") >= F.col("b._upto") - F.col("b._m"))
        met = open_.alias("o").join(bins.withColumn("_upto", upto).alias("b"), [*equal("o", "b"), F.col("o._p") == F.col("b._p"), held])
        rest = (F.col("o._rest") - F.col("b._upto") + F.col("b._m")).alias("_rest")
        told = saved(met.select(*[F.col(f"o.{a}").alias(a) for a in g], F.col("o._rank").alias("_rank"), F.col("b._b").alias("_p"), rest, "_low", "_high"))  # a row a rank and group
        done.append(told.filter("_low = _high").select(*g, "_rank", key_value(F.col("_low")).alias("_v")))
        open_ = told.filter("_low < _high").drop("_low", "_high")
        n, size = open_.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.to_json(F.struct(*g, "_p"))))).first()
        if not n:
            break
        few = n <= 1 << 16 and size <= 32 << 20
    found = functools.reduce(DataFrame.unionAll, done)
    at = found.groupBy(*g).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))
    a, b = groups.alias("a"), at.alias("b")
    told = a.join(b, equal("a", "b"), "left")

    def value(p: float) -> Column:
        place = (F.col("_n") - 1) * p
        low, high = (F.try_element_at("_at", f(place).cast("bigint")) for f in (F.floor, F.ceil))
        share, wide = place - F.floor(place), F.abs(high - low) == float("inf")
        return F.when((low == high) | (share == 0), low).when(wide, low * (1 - share) + high * share).otherwise(low + (high - low) * share)

    return told.select(*[F.col(f"a.{x}").alias(k) for k, x in name.items()], F.col("_n").alias("n"), *[F.round(value(p), digits).alias(c) for c, p in shares])


def duration_bands(segments: DataFrame) -> DataFrame:
    """(band, n, pct, duration)."""
    named = segments.filter("duration IS NOT NULL").withColumn("band", band(F.col("duration"), DURATION_EDGES, DURATION_BANDS))
    sums = named.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.round(exact_sum(F.col("duration")), 2).cast("double").alias("duration"))
    return sums.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))


def histogram(segments: DataFrame, column: str, low: float, high: float, n: int) -> DataFrame:
    return segments.withColumn("bin", histogram_bin(known(F.col(column)), low, high, n)).filter("bin IS NOT NULL").groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def speaker_balance(segments: DataFrame) -> DataFrame:
    """One row: how much of all speech the first and the ten first speakers hold, and how many have much or little."""
    each = segments.filter("trim(speaker_id) <> ''").groupBy("speaker_id").agg(exact_sum(F.col("duration")).alias("d"))
    # a rank over speakers alone: the top is taken by sort and limit, not by a window over all of them
    top = each.orderBy(F.desc("d"), "speaker_id").limit(10).withColumn("i", F.row_number().over(Window.orderBy(F.desc("d"), "speaker_id")))
    head = top.agg(F.min_by("speaker_id", "i").alias("top1_id"), F.max("d").alias("top1"), F.sum("d").alias("top10"))
    rest = each.agg(
        F.count(F.lit(1)).alias("n_speakers"), F.sum("d").alias("total"), F.count_if(F.col("d") >= 600).alias("with_10min"), F.count_if(F.col("d") < 60).alias("under_1min")
    )
    pct = lambda c: F.round((100 * F.col(c) / F.col("total")).cast("double"), 1)
    return rest.join(F.broadcast(head)).select("n_speakers", "top1_id", pct("top1").alias("top1_pct"), pct("top10").alias("top10_pct"), "with_10min", "under_1min")


def health(segments: DataFrame) -> DataFrame:
    low = F.col("conf_level") == "1"
    return segments.agg(
        F.count(F.lit(1)).alias("scanned"), F.count_if(F.col("speaker_id").isNull() | (F.col("speaker_id") == "")).alias("missing_speaker"),
        F.count_if(known(F.col("wer")).isNull()).alias("missing_wer"), F.count_if(low).alias("conf_low"),
        F.round(100.0 * F.count_if(low) / F.greatest(F.count(F.lit(1)), F.lit(1)), 2).alias("conf_low_pct"),
    )


def shares(rows: DataFrame, key: str, weight: str | None = None) -> DataFrame:
    """(key, n, pct) or with weight (key, n, weight, pct): each value's share of all."""
    of = exact_sum(F.col(weight)) if weight else F.count(F.lit(1))
    each = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), of.alias("w"))
    whole = F.sum("w").over(Window.partitionBy())
    return each.select(key, "n", F.col("w").cast("double").alias("weight"), F.round((100 * F.col("w") / whole).cast("double"), 2).alias("pct"))


def interaction_types(segments: DataFrame) -> DataFrame:
    n = segments.groupBy("video_id").agg(F.count_distinct("speaker_id").alias("k"))
    kind = F.when(F.col("k") == 1, "monologue").when(F.col("k") == 2, "dialogue").otherwise("group")
    return n.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("videos"))


def digit_labels(rows: DataFrame, text: str) -> DataFrame:
    rows, share = rows.select(digit_share(F.col(text)).alias("share")), F.coalesce("share", F.lit(0.0))
    return rows.agg(F.count_if(share > 0).alias("with_digits"), F.count_if(share >= 0.5).alias("mostly_digits"), F.count(F.lit(1)).alias("n"))


def videos_validated(segments: DataFrame) -> DataFrame:
    """A video counts as validated if some segment is left and all that are left are approved."""
    left = segments.filter(not_rejected(F.col("review_status"))).groupBy("video_id").agg(F.every(F.col("review_status") == "approved").alias("ok"))
    return segments.select("video_id").distinct().join(left, "video_id", "left").select("video_id", F.coalesce("ok", F.lit(False)).alias("validated"))


def filled_columns(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row of flags: whether a column has any value that counts (numbers: not 0; texts: not '')."""
    def filled(c):
        text = dict(rows.dtypes)[c] == "string"
        return F.coalesce(F.max((F.trim(c) != "") if text else (F.col(c).isNotNull() & (F.col(c) != 0))), F.lit(False)).alias(c)
    return rows.agg(*map(filled, columns))


def cumulative_hours(rows: DataFrame, at: str, seconds: str) -> DataFrame:
    """Hours by day and in total up to it; the window runs over one row a day."""
    day = rows.groupBy(F.to_date(at).alias("day")).agg(exact_sum(F.col(seconds)).alias("s"))
    total = F.sum("s").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0))
    return day.select("day", rounded(F.col("s").cast("double") / 3600, 4).alias("hours"), rounded(total.cast("double") / 3600, 4).alias("total_hours"))


def tree_hash(rows: DataFrame, key: str, order: str, digest: str, fan: int = 1024, levels: int = 4) -> DataFrame:
    """(key, digest): a hash over the digests of a key in order, by ranges of fan orders (0 and up), then of fan ranges.

    No group holds more than fan digests while each order has one; levels of them reach orders below fan ** levels.
    """
    at = rows.select(key, F.col(order).alias("_k"), F.col(digest).alias("_h"))
    for level in range(levels):
        above = F.lit(0) if level == levels - 1 else F.floor(F.col("_k") / fan)
        held = at.groupBy(key, above.alias("_up")).agg(F.array_sort(F.collect_list(F.struct("_k", "_h"))).alias("x"))
        at = held.select(key, F.col("_up").alias("_k"), F.sha2(F.array_join(F.transform("x", lambda x: x["_h"]), "\n"), 256).alias("_h"))
    return at.select(key, F.col("_h").alias(digest))
