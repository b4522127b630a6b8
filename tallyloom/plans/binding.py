"""The driver tables bound to the engine's entities; SEG is the same binding in SQL, for reference queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import table

SEG = """SELECT l_orderkey AS video_id, l_linenumber AS segment_no, CAST(l_suppkey AS VARCHAR) AS speaker_id, l_suppkey, l_partkey,
    l_quantity / 3 AS duration, l_extendedprice / 10000 AS asd_score, l_tax * 10 AS mouth_fail, 1 - l_discount * 6 AS whisper_conf,
    0.9 - l_discount * 8 AS whisper_conf_min, l_discount * 4 AS wer, l_tax * 5 AS wer_sm, l_linenumber + 1 AS num_words,
    CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'B' ELSE 'C' END AS tier,
    CASE WHEN l_returnflag = 'R' AND l_quantity > 40 THEN 'rejected' WHEN l_linestatus = 'F' THEN 'approved' ELSE '' END AS review_status,
    l_shipdate AS created_at, l_extendedprice, l_quantity FROM lineitem"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    flag = c("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        c("l_orderkey").alias("video_id"), c("l_linenumber").alias("segment_no"), c("l_suppkey").cast("string").alias("speaker_id"),
        "l_suppkey", "l_partkey", (c("l_quantity") / 3).alias("duration"), (c("l_extendedprice") / 10000).alias("asd_score"),
        (c("l_tax") * 10).alias("mouth_fail"), (1 - c("l_discount") * 6).alias("whisper_conf"), (0.9 - c("l_discount") * 8).alias("whisper_conf_min"),
        (c("l_discount") * 4).alias("wer"), (c("l_tax") * 5).alias("wer_sm"), (c("l_linenumber") + 1).alias("num_words"),
        F.when(flag == "A", "A").when(flag == "N", "B").otherwise("C").alias("tier"),
        F.when((flag == "R") & (c("l_quantity") > 40), "rejected").when(c("l_linestatus") == "F", "approved").otherwise("").alias("review_status"),
        c("l_shipdate").alias("created_at"), "l_extendedprice", "l_quantity",
    )


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("video_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("channel"),
        F.col("o_totalprice").alias("source_seconds"), F.col("o_orderdate").alias("processed_at"), F.col("o_custkey").alias("curator"),
    )


def speaker_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_suppkey, region): small dimensions, which Catalyst broadcasts by their size."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    held = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return held.select(F.col("s_suppkey").alias("l_suppkey"), F.col("r_name").alias("region"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("voice"), "text")


CLIP = """SELECT doc_id AS segment_id, source AS video_id, lang AS region, text, n_chars AS num_chars, n_chars / 15::DOUBLE AS duration, length(text) - length(replace(text, ' ', '')) + 1 AS num_words,
    CASE WHEN doc_id % 7 = 0 THEN 'rejected' WHEN doc_id % 7 < 3 THEN 'approved' ELSE '' END AS review_status, (doc_id % 5 = 0)::INT AS transcript_edited, (doc_id % 11 = 0)::INT AS trimmed,
    CASE WHEN doc_id % 4 > 0 THEN (doc_id % 100) / 100::DOUBLE END AS wer, CASE WHEN doc_id % 3 > 0 THEN (doc_id % 40) / 100::DOUBLE END AS wer_dialect, (doc_id % 13) / 2::DOUBLE AS asd_score,
    CASE WHEN doc_id % 6 > 0 THEN (doc_id % 17) / 16::DOUBLE END AS syncnet_conf, (doc_id % 21) / 20::DOUBLE AS whisper_conf, CASE WHEN doc_id % 9 > 0 THEN (doc_id % 19) / 20::DOUBLE END AS whisper_conf_min,
    CASE doc_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN ' b ' ELSE 'c' END AS quality_tier, 's' || (doc_id % 23) AS speaker_id,
    CASE WHEN doc_id % 4 = 1 THEN 'std' ELSE '' END AS transcript_source, CASE doc_id % 5 WHEN 0 THEN 'True' WHEN 1 THEN '1' WHEN 2 THEN 'no' END AS needs_review,
    CASE doc_id % 3 WHEN 0 THEN 'retina_Fallback' WHEN 1 THEN 'mesh' END AS mouth_roi_method, CASE doc_id % 10 WHEN 0 THEN 'FORCED' ELSE 'silence' END AS boundary_type FROM documents"""


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A segment for each document; CLIP is the same in SQL."""
    i = F.col("doc_id")
    part = lambda n, by, when=None: F.when(F.lit(True) if when is None else when, (i % n) / float(by))
    return table(spark, sf_dir, "documents").select(
        i.alias("segment_id"), F.col("source").alias("video_id"), F.col("lang").alias("region"), "text", F.col("n_chars").alias("num_chars"), (F.col("n_chars") / 15.0).alias("duration"),
        (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1).alias("num_words"),
        F.when(i % 7 == 0, "rejected").when(i % 7 < 3, "approved").otherwise("").alias("review_status"), (i % 5 == 0).cast("int").alias("transcript_edited"), (i % 11 == 0).cast("int").alias("trimmed"),
        part(100, 100, i % 4 > 0).alias("wer"), part(40, 100, i % 3 > 0).alias("wer_dialect"), part(13, 2).alias("asd_score"), part(17, 16, i % 6 > 0).alias("syncnet_conf"),
        part(21, 20).alias("whisper_conf"), part(19, 20, i % 9 > 0).alias("whisper_conf_min"), F.when(i % 3 == 0, "A").when(i % 3 == 1, " b ").otherwise("c").alias("quality_tier"),
        F.concat(F.lit("s"), (i % 23).cast("string")).alias("speaker_id"), F.when(i % 4 == 1, "std").otherwise("").alias("transcript_source"),
        F.when(i % 5 == 0, "True").when(i % 5 == 1, "1").when(i % 5 == 2, "no").alias("needs_review"), F.when(i % 3 == 0, "retina_Fallback").when(i % 3 == 1, "mesh").alias("mouth_roi_method"),
        F.when(i % 10 == 0, "FORCED").otherwise("silence").alias("boundary_type"),
    )
