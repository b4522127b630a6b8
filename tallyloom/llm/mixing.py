"""Mixing sources to target weights with DataFrame operations only.

Every document gets a hash-random key. Within a source the keys are sorted by ranges: the leading digits of the key
deal the rows of even one huge source out to many ranges, a window sorts each range, and the ranges' sums, added up in
key order, turn the running sums of a range into those of the source. The budget of a source then cuts its sequence:
whole epochs first, and of the last epoch each document of which at least half lies before the cut.

Defined cases: a null or empty text has size 0 and is taken 0 words; null is a source of its own, after all others;
repeated rows are separate documents that share one key; an empty table gives an empty result; other columns are
carried along untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import free_name
from tallyloom.session import table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
SEED = "mix-1"
#: Hex digits of the key that name a range: 4,096 ranges a source.
RANGE_DIGITS = 3


def source_targets(sums: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(_s, source_size, target) from (_s, source, source_size), one row for each source.

    The total is shared by weight; no target exceeds `most` times its source. Sources sorted by size over weight reach
    that limit in this order, so the level at which the rest shares the remainder follows from running sums.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    limit = F.col("source_size") * most
    levels = (
        sums.withColumn("weight", weight.cast("long"))
        .withColumn("rank", F.row_number().over(fill))
        .withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum(limit).over(before), F.lit(0)))
        .withColumn("sharers", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    fits = (F.col("weight") * F.col("left")).cast("double") / F.col("sharers") <= limit
    first = F.min(F.when(fits, F.struct("rank", "left", "sharers"))).over(whole)
    share = (F.col("weight") * F.col("first.left")).cast("double") / F.col("first.sharers")
    target = F.when(F.col("rank") < F.col("first.rank"), limit.cast("double")).otherwise(share)
    return levels.withColumn("first", first).select("_s", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS, seed: str = SEED, carry: Sequence[str] | None = None,
) -> DataFrame:
    """(row struct of the carried columns, size, source_size, target, copies, taken), one row for each document."""
    carry = list(docs.columns if carry is None else carry)
    source = F.col(source_col).cast("string")
    key = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(seed)))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.col(id_col).alias("_id"),
        source.alias("source"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("_s"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        key.alias("_key"),
    ).withColumn("_range", F.substring("_key", 1, RANGE_DIGITS))
    ranges = rows.groupBy("_s", "source", "_range").agg(F.sum("size").alias("in_range"))
    sums = ranges.groupBy("_s", "source").agg(F.sum("in_range").alias("source_size"))
    targets = source_targets(sums, weights, most)
    earlier = Window.partitionBy("_s").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("_s", "_range", F.coalesce(F.sum("in_range").over(earlier), F.lit(0)).alias("offset")).join(targets, "_s")
    within = Window.partitionBy("_s", "_range").orderBy("_key", "_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("_run", F.sum("size").over(within)).join(offsets, ["_s", "_range"])
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(F.lit(0))
    ahead = F.col("offset") + F.col("_run") - F.col("size")
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    extra = (F.col("epochs") < most) & (F.col("size") > 0) & (ahead * 2 + F.col("size") <= rest * 2)
    return (
        placed.withColumn("epochs", epochs.cast("long"))
        .withColumn("copies", (F.col("epochs") + extra.cast("long")).cast("int"))
        .select("row", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken."""
    mixed = mix(docs, **options)
    again = free_name(docs.columns, "again")
    return mixed.select("row.*", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias(again)).drop(again)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op9_mixing": op9_mixing}

ORACLE = {
    "op9_mixing": rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
    md5(concat_ws(':', doc_id::VARCHAR, '{SEED}')) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight FROM s),
l AS (SELECT *, row_number() OVER f AS rnk,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS lft,
    (sum(weight) OVER () - coalesce(sum(weight) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS sharers
    FROM w WINDOW f AS (ORDER BY source_size / weight, source ASC NULLS LAST)),
c AS (SELECT rnk AS first_rnk, lft AS first_lft, sharers AS first_sharers FROM l
    WHERE (weight * lft)::DOUBLE / sharers <= 3 * source_size ORDER BY rnk LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN rnk < first_rnk THEN (3 * source_size)::DOUBLE
    ELSE (weight * first_lft)::DOUBLE / first_sharers END AS target FROM l, c),
p AS (SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS epochs,
    sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS ahead
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, ((epochs + CASE WHEN epochs < 3 AND size > 0
    AND ahead * 2 + size <= (target - epochs * source_size) * 2 THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM p"""
}
