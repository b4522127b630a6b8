"""Queries of chunk stitching, sampling, codecs, prefix deletes, and payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import changelog, media
from tallyloom.operators.stats import rounded
from tallyloom.plans import binding as b
from tallyloom.plans import serving
from tallyloom.plans.stats_queries import consensus
from tallyloom.plans.binding import SEG
from tallyloom.registry import ORACLE, query
from tallyloom.session import ship, table


@query("chunk_plan", """WITH m AS (SELECT o_orderkey k, o_totalprice d, greatest(1, ceil(o_totalprice / 7200))::INT n FROM orders), c AS (SELECT *, unnest(range(0, n)) c FROM m)
    SELECT k media_id, c::INT chunk, floor(c * (d / n) * 1e3 + 0.5) / 1e3 clean_start, floor(CASE WHEN c < n - 1 THEN (c + 1) * (d / n) ELSE d END * 1e3 + 0.5) / 1e3 clean_end FROM c""")
def chunk_plan(spark, d):
    m = table(spark, d, "orders").select(F.col("o_orderkey").alias("media_id"), F.col("o_totalprice").alias("duration"))
    return media.chunk_plan(m).select("media_id", "chunk", rounded(F.col("clean_start"), 3).alias("clean_start"), rounded(F.col("clean_end"), 3).alias("clean_end"))


@query("sampled_rows", """WITH r AS (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 i, count(*) OVER (PARTITION BY user_id) n FROM events)
    SELECT event_id FROM r WHERE i % greatest(n // 4, 1) = 0 AND i / greatest(n // 4, 1) < 4""")
def sampled_rows(spark, d):
    return media.sampled(table(spark, d, "events"), "user_id", "ts").select("event_id")


@query("middle_window", "SELECT o_orderkey, round(greatest(0, (o_totalprice / 1000 - 60) / 2), 6) AS start, round(least(o_totalprice / 1000, greatest(0, (o_totalprice / 1000 - 60) / 2) + 60), 6) AS stop FROM orders")
def middle_window(spark, d):
    w = table(spark, d, "orders").select("o_orderkey", media.middle(F.col("o_totalprice") / 1000, 60.0).alias("w"))
    return w.select("o_orderkey", F.round("w.start", 6).alias("start"), F.round("w.end", 6).alias("stop"))


@query("vector_codec", "SELECT vec_id, len(embedding)::INT dims FROM embeddings")
def vector_codec(spark, d):
    """Vectors as bytes and back; only those that come back unchanged are counted with their length."""
    ship(spark)
    v = table(spark, d, "embeddings").withColumn("back", media.bytes_vector_udf(media.vector_bytes_udf("embedding")))
    return v.filter("back = embedding").select("vec_id", F.size("back").alias("dims"))


@query("delete_prefixes", "SELECT 'v_' || o_custkey || '_' || o_orderkey id FROM orders WHERE o_custkey % 10 <> 0")
def delete_prefixes(spark, d):
    rows = table(spark, d, "orders").select(F.concat_ws("_", F.lit("v"), "o_custkey", "o_orderkey").alias("id"))
    gone = table(spark, d, "customer").filter("c_custkey % 10 = 0").select(F.concat_ws("_", F.lit("v"), "c_custkey").alias("p"))
    return changelog.delete_prefixes(rows, gone, "id", "p")


@query("rewrite_ids", "SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN 'ro_' || (o_custkey // 2) ELSE 'md_' || o_custkey END || '_' || o_orderkey id FROM orders")
def rewrite_ids(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.concat_ws("_", F.lit("md"), "o_custkey", "o_orderkey").alias("id"))
    even = table(spark, d, "customer").filter("c_custkey % 2 = 0")
    return changelog.rewrite_ids(rows, even.select(F.concat_ws("_", F.lit("md"), "c_custkey").alias("old"), F.concat_ws("_", F.lit("ro"), (F.col("c_custkey") / 2).cast("long")).alias("new")), "id")


@query("next_index", "SELECT source[1:3] stem, max(source[4:]::INT) + 1 AS next FROM documents GROUP BY 1")
def next_index(spark, d):
    return changelog.next_index(table(spark, d, "documents"), "source")


@query("mined_classes", """WITH m AS (SELECT l_orderkey k, sum(CAST(l_quantity AS DECIMAL(20,6)))::DOUBLE e FROM lineitem GROUP BY 1), p AS (SELECT 100 * e * 200 / o_totalprice p FROM orders JOIN m ON o_orderkey = k WHERE o_totalprice > 0)
    SELECT CASE WHEN p >= 25 THEN 'green' WHEN p >= 10 THEN 'cyan' ELSE 'dim' END AS kind, count(*) n FROM p GROUP BY 1""")
def mined_classes(spark, d):
    m = table(spark, d, "lineitem").groupBy("l_orderkey").agg((F.sum(F.col("l_quantity").cast("decimal(20,6)")).cast("double")).alias("e"))
    both = table(spark, d, "orders").filter("o_totalprice > 0").join(m, F.col("o_orderkey") == F.col("l_orderkey"))
    return both.groupBy(changelog.mined_class(F.col("o_totalprice"), F.col("e") * 200)["class"].alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("word_confidence", """SELECT l_orderkey, round(avg(l_discount), 6) mean, min(l_discount) least, round(quantile_cont(l_discount, 0.25), 6) p25, list_sort(list(l_discount))[greatest(count(*) // 4 - 1, 0) + 1] low_quarter FROM lineitem GROUP BY 1""")
def word_confidence(spark, d):
    out = media.word_confidence(table(spark, d, "lineitem"), "l_orderkey", "l_discount")
    return out.select("l_orderkey", F.round("mean", 6).alias("mean"), "least", F.round("p25", 6).alias("p25"), "low_quarter")


def fresh_sql(name):
    """The reference SQL of a query over the segments that aren't rejected."""
    return ORACLE[name].replace(f"WITH s AS ({SEG})", f"WITH s AS (SELECT * FROM ({SEG}) WHERE review_status <> 'rejected')")


def unpivoted(name, part, counts, values):
    each = [f"SELECT '{part}' AS part, '{c}' AS key, {c}::BIGINT AS n, NULL::DOUBLE AS value FROM x" for c in counts] + [f"SELECT '{part}', '{c}', NULL, {c}::DOUBLE FROM x" for c in values]
    return f"SELECT * FROM (WITH x AS ({fresh_sql(name)}) {' UNION ALL '.join(each)})"


@query("overview_payload", " UNION ALL ".join([
    unpivoted("dataset_overview", "totals", ["segments", "videos", "speakers"], ["hours"]), unpivoted("duration_quantiles", "duration", [], ["p25", "median", "p75", "p95"]),
    f"SELECT 'bands', band, n, duration FROM ({fresh_sql('duration_bands')})", unpivoted("speaker_balance", "balance", ["n_speakers", "with_10min", "under_1min"], ["top1_pct", "top10_pct"]),
    f"SELECT 'funnel', step, n, duration FROM ({fresh_sql('training_funnel')})"]))
def overview_payload(spark, d):
    return serving.overview(consensus(b.segments(spark, d)))
