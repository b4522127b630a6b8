"""Queries of the aggregate, funnel, histogram, vocabulary and top-k operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import rules, text
from tallyloom.operators import stats, vocab
from tallyloom.plans import binding as b
from tallyloom.plans.binding import SEG
from tallyloom.registry import query
from tallyloom.session import table

D = "CAST({} AS DECIMAL(20,6))"
DUR, ASD = D.format("duration"), D.format("asd_score")
S = f"WITH s AS ({SEG})"
CONS = """CASE WHEN wer_sm IS NULL OR wer IS NULL THEN 'insufficient' ELSE CASE (wer_sm < 0.2)::INT + (wer < 0.2)::INT + (mouth_fail / 4 < 0.2)::INT
    WHEN 3 THEN 'all_agree' WHEN 0 THEN 'all_disagree' ELSE CASE WHEN mouth_fail / 4 < 0.2 THEN 'dialectal_agree'
    WHEN wer < 0.2 THEN 'std_large_agree' ELSE 'std_med_agree' END END END"""
KEY = "concat(l_orderkey, '_', l_linenumber)"


def consensus(seg):
    return seg.withColumn("consensus", rules.consensus_label(F.col("wer_sm"), F.col("wer"), F.col("mouth_fail") / 4))


@query("video_stats", f"""{S} SELECT video_id, count(*) total_segments, round(sum({DUR}), 2)::DOUBLE total_duration,
    floor(sum({ASD})::DOUBLE / count(*) * 1e3 + 0.5) / 1e3 avg_asd, count(*) FILTER (WHERE tier='A') tier_a, count(*) FILTER (WHERE tier='B') tier_b,
    count(*) FILTER (WHERE tier='C') tier_c FROM s GROUP BY 1""")
def video_stats(spark, d):
    return stats.video_stats(b.segments(spark, d))


@query("fresh_video_stats", f"""{S} SELECT video_id, count(*) total_segments, round(sum({DUR}), 2)::DOUBLE total_duration,
    floor(sum({ASD})::DOUBLE / count(*) * 1e3 + 0.5) / 1e3 avg_asd, count(*) FILTER (WHERE tier='A') tier_a, count(*) FILTER (WHERE tier='B') tier_b,
    count(*) FILTER (WHERE tier='C') tier_c FROM s WHERE review_status <> 'rejected' GROUP BY 1""")
def fresh_video_stats(spark, d):
    return stats.fresh_video_stats(b.segments(spark, d))


@query("speaker_stats", f"""{S} SELECT speaker_id, count(DISTINCT video_id) video_count, count(*) total_segments, round(sum({DUR}), 2)::DOUBLE total_duration,
    floor(sum({ASD})::DOUBLE / count(*) * 1e3 + 0.5) / 1e3 avg_asd, floor(sum(CAST(coalesce(wer, 0) AS DECIMAL(20,6)))::DOUBLE / count(*) * 1e4 + 0.5) / 1e4 avg_wer
    FROM s WHERE speaker_id <> '' GROUP BY 1""")
def speaker_stats(spark, d):
    return stats.speaker_stats(b.segments(spark, d))


@query("dataset_overview", f"""{S} SELECT count(*) segments, count(DISTINCT video_id) videos, count(DISTINCT speaker_id) speakers,
    round((sum({DUR}) / 3600)::DECIMAL(20,6), 2)::DOUBLE AS hours FROM s""")
def dataset_overview(spark, d):
    return stats.dataset_overview(b.segments(spark, d))


@query("training_funnel", f"""{S}, c AS (SELECT *, {CONS} consensus FROM s),
v AS (SELECT *, asd_score >= 2 AND mouth_fail < 0.5 v, whisper_conf > 0.2 AND num_words >= 4 t, duration BETWEEN 1 AND 16 l, consensus IN ('all_agree','dialectal_agree') a FROM c),
x AS (SELECT unnest(['1_all','2_visual','3_text','4_length','5_agreed']) step, unnest([true, v, v AND t, v AND t AND l, v AND t AND l AND a]) ok, duration FROM v)
SELECT step, count(*) FILTER (WHERE ok) n, round(coalesce(sum({DUR}) FILTER (WHERE ok), 0)::DOUBLE, 1) duration FROM x GROUP BY 1""")
def training_funnel(spark, d):
    return stats.training_funnel(consensus(b.segments(spark, d)))


@query("consensus_labels", f"""{S}, c AS (SELECT *, {CONS} consensus FROM s) SELECT consensus, tier, count(*) n, round(sum({DUR}), 2)::DOUBLE duration FROM c GROUP BY 1, 2""")
def consensus_labels(spark, d):
    return consensus(b.segments(spark, d)).groupBy("consensus", "tier").agg(
        F.count(F.lit(1)).alias("n"), F.round(stats.exact_sum(F.col("duration")), 2).cast("double").alias("duration"))


@query("duration_quantiles", f"""{S} SELECT round(quantile_cont(duration, 0.25), 2) p25, round(quantile_cont(duration, 0.5), 2) median,
    round(quantile_cont(duration, 0.75), 2) p75, round(quantile_cont(duration, 0.95), 2) p95 FROM s WHERE review_status <> 'rejected'""")
def duration_quantiles(spark, d):
    return stats.quantiles(b.segments(spark, d).filter(rules.not_rejected(F.col("review_status"))), "duration")


BANDS = """CASE WHEN duration < 1 THEN '<1s' WHEN duration < 3 THEN '1-3s' WHEN duration < 6 THEN '3-6s' WHEN duration < 10 THEN '6-10s'
    WHEN duration < 15 THEN '10-15s' ELSE '>15s' END"""


@query("tier_quantiles", f"""{S} SELECT tier, count(duration) n, round(quantile_cont(duration, 0.25), 2) p25, round(quantile_cont(duration, 0.5), 2) median,
    round(quantile_cont(duration, 0.75), 2) p75, round(quantile_cont(duration, 0.95), 2) p95 FROM s GROUP BY tier""")
def tier_quantiles(spark, d):
    return stats.grouped_quantiles(b.segments(spark, d), ["tier"], "duration")


@query("duration_bands", f"""{S} SELECT {BANDS} band, count(*) n, round(sum({DUR}), 2)::DOUBLE duration,
    round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM s), 4) pct FROM s GROUP BY 1""")
def duration_bands(spark, d):
    return stats.duration_bands(b.segments(spark, d))


@query("wer_histogram", f"""{S}, x AS (SELECT (SELECT count(*) FROM range(1, 20) t(i) WHERE wer >= i::DOUBLE / 20) bin FROM s WHERE wer BETWEEN 0 AND 1)
    SELECT bin::INT bin, count(*) n FROM x GROUP BY 1""")
def wer_histogram(spark, d):
    return stats.histogram(b.segments(spark, d), "wer", 0.0, 1.0, 20)


@query("duration_histogram", f"""{S} SELECT least(floor(duration) - 1, 13)::INT bin, count(*) n FROM s WHERE duration BETWEEN 1 AND 15 GROUP BY 1""")
def duration_histogram(spark, d):
    return stats.histogram(b.segments(spark, d), "duration", 1.0, 15.0, 14)


CONF = "CASE WHEN whisper_conf_min >= 0.7 AND whisper_conf >= 0.9 THEN '3' WHEN whisper_conf_min >= 0.5 AND whisper_conf >= 0.7 THEN '2' ELSE '1' END"


@query("conf_levels", f"{S} SELECT {CONF} conf_level, count(*) n FROM s WHERE review_status <> 'rejected' GROUP BY 1")
def conf_levels(spark, d):
    level = rules.confidence_level(F.col("whisper_conf_min"), F.col("whisper_conf")).alias("conf_level")
    return b.segments(spark, d).filter(rules.not_rejected(F.col("review_status"))).groupBy(level).agg(F.count(F.lit(1)).alias("n"))


@query("health", f"""{S} SELECT count(*) scanned, count(*) FILTER (WHERE speaker_id IS NULL OR speaker_id = '') missing_speaker,
    count(*) FILTER (WHERE wer IS NULL) missing_wer, count(*) FILTER (WHERE {CONF} = '1') conf_low,
    round(100.0::DOUBLE * count(*) FILTER (WHERE {CONF} = '1') / count(*), 2) conf_low_pct FROM s""")
def health(spark, d):
    return stats.health(b.segments(spark, d).withColumn("conf_level", rules.confidence_level(F.col("whisper_conf_min"), F.col("whisper_conf"))))


@query("speaker_balance", f"""{S}, e AS (SELECT speaker_id, sum({DUR}) d FROM s WHERE trim(speaker_id) <> '' GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY d DESC, speaker_id) i FROM e)
SELECT count(*) n_speakers, min(speaker_id) FILTER (WHERE i = 1) top1_id, round((100 * sum(d) FILTER (WHERE i = 1) / sum(d))::DOUBLE, 1) top1_pct,
    round((100 * sum(d) FILTER (WHERE i <= 10) / sum(d))::DOUBLE, 1) top10_pct, count(*) FILTER (WHERE d >= 600) with_10min,
    count(*) FILTER (WHERE d < 60) under_1min FROM r""")
def speaker_balance(spark, d):
    return stats.speaker_balance(b.segments(spark, d))


@query("quality_tier", f"""{S}, m AS (SELECT *, 1 - l_quantity / 300 vis FROM s),
t AS (SELECT *, CASE WHEN duration BETWEEN 2 AND 12 AND whisper_conf >= 0.9 AND whisper_conf_min >= 0.7 AND vis >= 0.95 AND mouth_fail <= 0.05 THEN 'A'
    WHEN whisper_conf >= 0.7 AND whisper_conf_min >= 0.5 AND vis >= 0.85 AND mouth_fail <= 0.15 THEN 'B' ELSE 'C' END q FROM m)
SELECT q, count(*) n FROM t GROUP BY 1""")
def quality_tier(spark, d):
    seg = b.segments(spark, d).withColumns({
        "face_visibility_ratio": 1 - F.col("l_quantity") / 300, "mouth_landmark_fail_rate": F.col("mouth_fail"),
        **{n: F.lit("") for n in ("asd_method", "syncnet_method", "mouth_roi_method", "boundary_start_type", "boundary_end_type")}})
    return seg.groupBy(rules.quality_tier().alias("q")).agg(F.count(F.lit(1)).alias("n"))


REG = "JOIN supplier ON s.l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query("region_join", f"{S} SELECT coalesce(nullif(r_name, ''), 'UNKNOWN') region, count(*) n, round(sum({DUR}), 2)::DOUBLE duration FROM s LEFT {REG} GROUP BY 1")
def region_join(spark, d):
    joined = b.segments(spark, d).join(b.speaker_regions(spark, d), "l_suppkey", "left")
    return joined.groupBy(F.coalesce(F.nullif("region", F.lit("")), F.lit("UNKNOWN")).alias("region")).agg(
        F.count(F.lit(1)).alias("n"), F.round(stats.exact_sum(F.col("duration")), 2).cast("double").alias("duration"))


@query("tier_by_region", f"""{S} SELECT r_name region, tier, count(*) n FROM s {REG} GROUP BY ROLLUP (r_name, tier)""")
def tier_by_region(spark, d):
    return b.segments(spark, d).join(b.speaker_regions(spark, d), "l_suppkey").rollup("region", "tier").agg(F.count(F.lit(1)).alias("n"))


@query("cube_tiers", f"{S} SELECT tier, review_status, count(*) n, grouping_id(tier, review_status)::BIGINT g FROM s GROUP BY CUBE (tier, review_status)")
def cube_tiers(spark, d):
    return b.segments(spark, d).cube("tier", "review_status").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))


@query("speakers_with_stats", """WITH t AS (SELECT o_custkey, count(*) n FROM orders GROUP BY 1)
    SELECT c_custkey speaker, coalesce(n, 0) total_segments FROM customer LEFT JOIN t ON c_custkey = o_custkey""")
def speakers_with_stats(spark, d):
    n = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return table(spark, d, "customer").join(n, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("speaker"), F.coalesce("n", F.lit(0)).alias("total_segments"))


@query("interaction_types", f"""{S}, k AS (SELECT video_id, count(DISTINCT speaker_id) k FROM s GROUP BY 1)
    SELECT CASE WHEN k = 1 THEN 'monologue' WHEN k = 2 THEN 'dialogue' ELSE 'group' END kind, count(*) videos FROM k GROUP BY 1""")
def interaction_types(spark, d):
    return stats.interaction_types(b.segments(spark, d))


@query("demographics", """SELECT c_mktsegment, count(*) n, sum(CAST(c_acctbal AS DECIMAL(20,6)))::DOUBLE weight,
    round((100 * sum(CAST(c_acctbal AS DECIMAL(20,6))) / (SELECT sum(CAST(c_acctbal AS DECIMAL(20,6))) FROM customer))::DOUBLE, 2) pct FROM customer GROUP BY 1""")
def demographics(spark, d):
    return stats.shares(table(spark, d, "customer"), "c_mktsegment", "c_acctbal")


@query("source_shares", "SELECT source, count(*) n, count(*)::DOUBLE weight, round((100 * count(*) / (SELECT count(*) FROM documents))::DOUBLE, 2) pct FROM documents GROUP BY 1")
def source_shares(spark, d):
    return stats.shares(table(spark, d, "documents"), "source")


@query("videos_validated", f"""{S} SELECT video_id, coalesce(bool_and(review_status = 'approved') FILTER (WHERE review_status <> 'rejected'), false) validated FROM s GROUP BY 1""")
def videos_validated(spark, d):
    return stats.videos_validated(b.segments(spark, d))


@query("filled_columns", """SELECT max(l_tax) <> 0 AS l_tax, max(l_discount) <> 0 AS l_discount, bool_or(trim(l_returnflag) <> '') AS l_returnflag, max(l_linenumber) <> 0 AS l_linenumber FROM lineitem""")
def filled_columns(spark, d):
    return stats.filled_columns(table(spark, d, "lineitem"), ["l_tax", "l_discount", "l_returnflag", "l_linenumber"])


@query("cumulative_hours", """WITH x AS (SELECT o_orderdate::DATE AS day, sum(CAST(o_totalprice AS DECIMAL(20,6))) s FROM orders GROUP BY 1)
    SELECT day, floor(s::DOUBLE / 3600 * 1e4 + 0.5) / 1e4 AS hours, floor((sum(s) OVER (ORDER BY day))::DOUBLE / 3600 * 1e4 + 0.5) / 1e4 AS total_hours FROM x""")
def cumulative_hours(spark, d):
    return stats.cumulative_hours(b.videos(spark, d), "processed_at", "source_seconds")


@query("digit_labels", r"""WITH w AS (SELECT list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') w FROM documents),
    r AS (SELECT CASE WHEN len(w) > 0 THEN len(list_filter(w, lambda x: regexp_matches(x, '[0-9]'))) / len(w) ELSE 0 END r FROM w)
    SELECT count(*) FILTER (WHERE r > 0) with_digits, count(*) FILTER (WHERE r >= 0.5) mostly_digits, count(*) n FROM r""")
def digit_labels(spark, d):
    return stats.digit_labels(table(spark, d, "documents"), "text")


TOKENS = r"""SELECT doc_id, n_chars / 100 AS dur, list_filter(list_transform(string_split_regex(text, '\s+'), lambda x: upper(trim(replace(x, 'ß', 'SS'), '.,;:!?"''()[]'))), lambda x: x <> '') t FROM documents"""


@query("vocab_fallback", f"""WITH k AS ({TOKENS}), e AS (SELECT doc_id, dur / len(t) s, unnest(t) word FROM k),
    g AS (SELECT word, doc_id, count(*) n, sum(CAST(s AS DECIMAL(20,6))) d FROM e GROUP BY 1, 2)
    SELECT word, count(*) samples, sum(n)::BIGINT occurrences, round(sum(d), 2)::DOUBLE duration FROM g GROUP BY 1""")
def vocab_fallback(spark, d):
    docs = table(spark, d, "documents").withColumn("dur", F.col("n_chars") / 100)
    return vocab.vocabulary(vocab.fallback(docs, "text", "dur"))


def event_segments(spark, d):
    """A segment for each user and day whose words are the events, a tenth of value long."""
    e = table(spark, d, "events").withColumn("s", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    word = F.struct(F.upper("event_type").alias("word"), F.lit(0.0).alias("start"), (F.col("value") / 10).alias("end"))
    return e.groupBy(F.concat_ws("_", "user_id", F.to_date("ts")).alias("segment_id")).agg(F.array_sort(F.collect_list(F.struct("ts", word.alias("w")))).alias("x")).select(
        "segment_id", F.transform("x", lambda x: x["w"]).alias("words"))


@query("vocabulary", """WITH g AS (SELECT upper(event_type) word, concat_ws('_', user_id, ts::DATE) k, count(*) n, sum(CAST(greatest(value / 10, 0) AS DECIMAL(20,6))) d FROM events GROUP BY 1, 2)
    SELECT word, count(*) samples, sum(n)::BIGINT occurrences, round(sum(d), 2)::DOUBLE duration FROM g GROUP BY 1""")
def vocabulary(spark, d):
    return vocab.vocabulary(vocab.recorded(event_segments(spark, d)))


@query("vocab_shares", f"""WITH k AS ({TOKENS}), e AS (SELECT doc_id, dur / len(t) s, unnest(t) word FROM k),
    g AS (SELECT word, doc_id, count(*) n, sum(CAST(s AS DECIMAL(20,6))) d FROM e GROUP BY 1, 2),
    v AS (SELECT word, count(*) samples, sum(n)::BIGINT occurrences, round(sum(d), 2)::DOUBLE duration FROM g GROUP BY 1)
    SELECT *, length(word) len, round(100.0::DOUBLE * occurrences / (SELECT sum(occurrences) FROM v), 4) share, round(duration / occurrences, 4) avg_duration,
    row_number() OVER (ORDER BY occurrences DESC, word) AS rank FROM v WHERE contains(word, 'TH') ORDER BY occurrences DESC, word LIMIT 500""")
def vocab_shares(spark, d):
    return vocab.top(vocab.with_shares(vocab_fallback(spark, d)).filter(F.col("word").contains("TH")), 500, F.desc("occurrences"), F.col("word"))


@query("rare_words", f"""WITH k AS ({TOKENS}), n AS (SELECT word, count(*) n FROM (SELECT unnest(t) word FROM k) GROUP BY 1)
    SELECT count(*) unique_words, count(*) FILTER (WHERE n = 1) once, count(*) FILTER (WHERE n = 2) twice FROM n""")
def rare_words(spark, d):
    return vocab.rare_words(table(spark, d, "documents").select(F.explode(text.stat_tokens(F.col("text"))).alias("word")))


@query("top_mined", """WITH m AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(20,6))) e FROM lineitem GROUP BY 1)
    SELECT o_orderkey video_id, round((e / o_totalprice)::DOUBLE, 6) ratio, row_number() OVER (ORDER BY e::DOUBLE / o_totalprice DESC, o_orderkey) AS rank
    FROM orders JOIN m ON o_orderkey = l_orderkey WHERE o_totalprice > 0 ORDER BY e::DOUBLE / o_totalprice DESC, o_orderkey LIMIT 10""")
def top_mined(spark, d):
    mined = b.segments(spark, d).groupBy("video_id").agg(stats.exact_sum(F.col("l_extendedprice")).alias("e"))
    ratio = F.col("e").cast("double") / F.col("source_seconds")
    rows = b.videos(spark, d).filter("source_seconds > 0").join(mined, "video_id").select("video_id", ratio.alias("r"))
    return vocab.top(rows, 10, F.desc("r"), F.col("video_id")).select("video_id", F.round("r", 6).alias("ratio"), "rank")


@query("value_counts", "SELECT source, count(*) n, row_number() OVER (ORDER BY count(*) DESC, source) AS rank FROM documents GROUP BY 1 ORDER BY n DESC, source LIMIT 20")
def value_counts(spark, d):
    return vocab.top(table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")), 20, F.desc("n"), F.col("source"))


@query("kpi_sql", """SELECT count(*) total, count(*) FILTER (WHERE l_returnflag = 'A') approved, count(DISTINCT l_suppkey) speakers,
    count(DISTINCT l_orderkey) FILTER (WHERE l_linestatus = 'F') finished FROM lineitem""")
def kpi_sql(spark, d):
    table(spark, d, "lineitem").createOrReplaceTempView("kpi_lineitem")
    return spark.sql("""SELECT count(*) total, count(*) FILTER (WHERE l_returnflag = 'A') approved, count(DISTINCT l_suppkey) speakers,
        count(DISTINCT l_orderkey) FILTER (WHERE l_linestatus = 'F') finished FROM kpi_lineitem""")


@query("region_balance", """WITH a AS (SELECT n_regionkey k, count(*) n FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name LIKE 'I%' GROUP BY 1), v AS (SELECT n_regionkey k, count(*) m FROM nation GROUP BY 1)
    SELECT coalesce(a.k, v.k) k, coalesce(n, m) n FROM a FULL JOIN v ON a.k = v.k""")
def region_balance(spark, d):
    """Where a region has rows of the finer breakdown these count, else those of the coarser one; two regions have nations in I."""
    nation = table(spark, d, "nation")
    fine = table(spark, d, "customer").join(nation.filter("n_name LIKE 'I%'"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_regionkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    coarse = nation.groupBy(F.col("n_regionkey").alias("k")).agg(F.count(F.lit(1)).alias("m"))
    return fine.join(coarse, "k", "full").select("k", F.coalesce("n", "m").alias("n"))
