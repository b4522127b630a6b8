"""Queries of row-wise rules, embedded arrays, and writes to the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import rules, text
from tallyloom.functions.wer import word_changes
from tallyloom.operators import changelog, identity, media, ordered, tracks
from tallyloom.plans import binding as b
from tallyloom.plans.binding import CLIP
from tallyloom.plans.row_queries import TURN_TOKENS, UNIT, events, vectors
from tallyloom.registry import ORACLE, query
from tallyloom.session import table
from tallyloom.sources import catalog

C = f"WITH c AS ({CLIP})"


@query("drop_reasons", """WITH x AS (SELECT l_linenumber = 7 f, l_suppkey % 9 t, l_discount * 10 v, l_partkey % 17 = 0 wf, l_partkey % 13 n, CASE WHEN l_returnflag = 'R' AND l_linenumber = 2 THEN ' ' ELSE 'x' END s,
    CASE WHEN l_partkey % 29 > 0 THEN l_tax * 10 ELSE 'nan'::DOUBLE END c, l_suppkey % 11 > 0 o, l_quantity / 50 a, l_tax * 10 k, l_linenumber - 1 w, l_quantity <> 50 e FROM lineitem)
    SELECT CASE WHEN f THEN 'processing_error' WHEN t = 0 THEN 'no_face_track' WHEN v < 0.7 THEN printf('face_visibility=%.2f', v) WHEN wf THEN 'whisper_error' WHEN n = 0 THEN 'no_transcription' WHEN trim(s) = '' THEN 'empty_transcription'
    WHEN isnan(c) THEN 'unknown_confidence' WHEN c < 0.2 THEN printf('low_confidence=%.2f', c) WHEN NOT o THEN 'no_track_overlaps_speech' WHEN a < 0.5 THEN printf('low_asd_score=%.2f', a) WHEN k < 0.3 THEN printf('track_too_short=%.2f', k)
    WHEN w = 0 THEN 'no_words_in_track_range' WHEN NOT e THEN 'export_failed' END AS reason, count(*) n FROM x GROUP BY 1""")
def drop_reasons(spark, d):
    c = F.col
    x = table(spark, d, "lineitem").select(
        (c("l_linenumber") == 7).alias("failed"), (c("l_suppkey") % 9).alias("tracks"), (c("l_discount") * 10).alias("visibility"), (c("l_partkey") % 17 == 0).alias("whisper_failed"), (c("l_partkey") % 13).alias("transcripts"),
        F.when((c("l_returnflag") == "R") & (c("l_linenumber") == 2), " ").otherwise("x").alias("text"), F.when(c("l_partkey") % 29 > 0, c("l_tax") * 10).otherwise(float("nan")).alias("confidence"),
        (c("l_suppkey") % 11 > 0).alias("overlaps"), (c("l_quantity") / 50).alias("asd"), (c("l_tax") * 10).alias("track_overlap"), (c("l_linenumber") - 1).alias("words_left"), (c("l_quantity") != 50).alias("exported"))
    return x.groupBy(rules.drop_reason(rules.clip_gates()).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("reason_codec", """WITH r AS (SELECT l_orderkey k, CASE l_linenumber WHEN 1 THEN printf('low_conf=%.2f', l_discount) WHEN 2 THEN 'no_face' WHEN 3 THEN printf('asd=%.1f', l_quantity) WHEN 4 THEN 'x=' || l_partkey ELSE 'Odd=1' END r FROM lineitem),
    p AS (SELECT *, regexp_matches(r, '^([a-z_]+)=(-?\\d+(?:\\.\\d+)?)$') h FROM r) SELECT r AS back, CASE WHEN h THEN split_part(r, '=', 1) ELSE r END AS code, CASE WHEN h THEN split_part(r, '=', 2)::DOUBLE END AS value, count(*) n FROM p GROUP BY ALL""")
def reason_codec(spark, d):
    n = F.col("l_linenumber")
    r = F.when(n == 1, F.format_string("low_conf=%.2f", F.col("l_discount"))).when(n == 2, "no_face").when(n == 3, F.format_string("asd=%.1f", F.col("l_quantity"))).when(n == 4, F.concat(F.lit("x="), F.col("l_partkey").cast("string"))).otherwise("Odd=1")
    held = table(spark, d, "lineitem").select(rules.reason_struct(r).alias("reason"))
    return held.groupBy(rules.reason_text(F.col("reason")).alias("back"), F.col("reason.code").alias("code"), F.col("reason.value").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def colour_sql(c, high, middle):
    return f"CASE WHEN {c} IS NULL THEN 'dim' WHEN {c} >= {high} THEN 'green' WHEN {c} >= {middle} THEN 'orange' ELSE 'red' END"


@query("score_classes", f"""{C} SELECT CASE WHEN wer IS NULL THEN 'none' WHEN wer <= 0 THEN 'identical' WHEN wer <= 0.05 THEN 'almost identical' WHEN wer <= 0.2 THEN 'dialect captured' WHEN wer <= 0.4 THEN 'large changes' ELSE 'grave' END AS label,
    {colour_sql('asd_score', 5, 2)} AS asd, {colour_sql('syncnet_conf', 0.55, 0.4)} AS sync, {colour_sql('whisper_conf', 0.75, 0.55)} AS whisper, count(*) n FROM c GROUP BY ALL""")
def score_classes(spark, d):
    c = F.col
    keys = [rules.wer_label(c("wer")).alias("label"), rules.colour(c("asd_score"), "asd").alias("asd"), rules.colour(c("syncnet_conf"), "sync").alias("sync"), rules.colour(c("whisper_conf"), "whisper").alias("whisper")]
    return b.clips(spark, d).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query("noise_classes", """SELECT CASE WHEN f >= 0.18 OR v < 0.35 THEN 'high' WHEN f >= 0.1 OR v < 0.55 THEN 'moderate' WHEN f >= 0.05 OR v < 0.75 THEN 'low' ELSE 'none' END AS noise, count(*) n FROM (SELECT l_tax * 2 f, 1 - l_discount * 7 v FROM lineitem) GROUP BY 1""")
def noise_classes(spark, d):
    noise = rules.noise_class(F.col("l_tax") * 2, 1 - F.col("l_discount") * 7)
    return table(spark, d, "lineitem").groupBy(noise.alias("noise")).agg(F.count(F.lit(1)).alias("n"))


@query("media_rates", """WITH x AS (SELECT l_partkey p, l_linenumber n, CASE l_linenumber WHEN 1 THEN l_partkey || 'M' WHEN 2 THEN l_partkey || 'k' WHEN 3 THEN l_partkey::VARCHAR WHEN 4 THEN '2G' ELSE 'x' END r,
    CASE l_linenumber WHEN 1 THEN l_partkey || '/1' WHEN 2 THEN '30000/1001' WHEN 3 THEN l_partkey || '/0' ELSE '25' END f FROM lineitem)
    SELECT CASE n WHEN 1 THEN p * 1048576 WHEN 2 THEN p * 1024 WHEN 3 THEN p WHEN 4 THEN 2147483648 ELSE 5242880 END AS rate, CASE n WHEN 1 THEN p::DOUBLE WHEN 2 THEN round(30000 / 1001::DOUBLE, 6) ELSE 25 END AS fps, count(*) n FROM x GROUP BY 1, 2""")
def media_rates(spark, d):
    n, p = F.col("l_linenumber"), F.col("l_partkey").cast("string")
    r = F.when(n == 1, F.concat(p, F.lit("M"))).when(n == 2, F.concat(p, F.lit("k"))).when(n == 3, p).when(n == 4, "2G").otherwise("x")
    f = F.when(n == 1, F.concat(p, F.lit("/1"))).when(n == 2, "30000/1001").when(n == 3, F.concat(p, F.lit("/0"))).otherwise("25")
    return table(spark, d, "lineitem").groupBy(text.rate_bytes(r).alias("rate"), F.round(text.frame_rate(f), 6).alias("fps")).agg(F.count(F.lit(1)).alias("n"))


@query("best_resolutions", """WITH x AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey DESC, l_partkey, l_linenumber, l_quantity) r FROM lineitem WHERE l_returnflag <> 'R' AND l_suppkey > 0)
    SELECT o.k AS l_orderkey, coalesce(l_partkey || 'x' || l_suppkey, 'unknown') AS resolution, coalesce(l_quantity, 25) AS fps FROM (SELECT DISTINCT l_orderkey k FROM lineitem) o LEFT JOIN x ON o.k = x.l_orderkey AND r = 1""")
def best_resolutions(spark, d):
    one = F.struct(F.col("l_partkey").alias("width"), "l_linenumber", F.col("l_quantity").alias("fps"), F.col("l_suppkey").alias("height"), F.when(F.col("l_returnflag") == "R", "none").otherwise("avc").alias("vcodec"))
    held = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(one)).alias("formats"))
    return held.select("l_orderkey", text.best_resolution(F.col("formats")).alias("b")).select("l_orderkey", "b.resolution", "b.fps")


@query("licences", """WITH x AS (SELECT CASE doc_id % 5 WHEN 0 THEN 'Creative Commons BY' WHEN 1 THEN 'Standard' WHEN 2 THEN NULL ELSE 'cc by-sa' END l, CASE doc_id % 3 WHEN 0 THEN 'see CreativeCommons.org/x' WHEN 1 THEN source END s FROM documents)
    SELECT l, coalesce(regexp_matches(lower(coalesce(l, '') || ' | ' || coalesce(s, '')), 'creative commons|cc-by|cc by|creativecommons\\.org'), false) AS open, count(*) n FROM x GROUP BY 1, 2""")
def licences(spark, d):
    i = F.col("doc_id")
    licence = F.when(i % 5 == 0, "Creative Commons BY").when(i % 5 == 1, "Standard").when(i % 5 > 2, "cc by-sa")
    about = F.when(i % 3 == 0, "see CreativeCommons.org/x").when(i % 3 == 1, F.col("source"))
    return table(spark, d, "documents").groupBy(licence.alias("l"), text.is_open_licence(licence, about).alias("open")).agg(F.count(F.lit(1)).alias("n"))


@query("duration_texts", """WITH x AS (SELECT o_orderkey, floor(o_totalprice / 50 + 0.5)::BIGINT s FROM orders), y AS (SELECT *, s // 3600 h, s % 3600 // 60 m, s % 60 r FROM x)
    SELECT o_orderkey, CASE WHEN h > 0 THEN h || 'h ' || m || 'm ' || r || 's' WHEN m > 0 THEN m || 'm ' || r || 's' ELSE r || 's' END AS long_text, CASE WHEN h > 0 THEN h || 'h ' || m || 'm' WHEN m > 0 THEN m || 'm ' || r || 's' ELSE r || 's' END AS short_text FROM y""")
def duration_texts(spark, d):
    s = F.col("o_totalprice") / 50
    return table(spark, d, "orders").select("o_orderkey", text.duration_text(s).alias("long_text"), text.duration_text(s, True).alias("short_text"))


@query("scrubbed_cells", """SELECT l_orderkey, l_linenumber, count(CASE WHEN l_linenumber NOT IN (1, 2) THEN l_quantity END) AS numbers, sum(len(CASE WHEN l_linenumber = 3 THEN '' ELSE l_returnflag END)) AS signs FROM lineitem GROUP BY 1, 2""")
def scrubbed_cells(spark, d):
    n = F.col("l_linenumber")
    raw = F.when(n == 1, "nan").when(n == 2, "NaN").otherwise(F.col("l_quantity").cast("string"))
    flag = text.cell(F.when(n != 3, F.col("l_returnflag")))
    return table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(text.number_or_null(raw)).alias("numbers"), F.sum(F.length(flag)).alias("signs"))


@query("diacritics", """SELECT doc_id, md5(translate(nfc_normalize(source || 's' || chr(806) || lang || 'a' || chr(774) || 'ŞţE' || chr(769)), 'şŞţŢ', 'șȘțȚ')) AS h FROM documents""")
def diacritics(spark, d):
    raw = F.concat("source", F.lit("ș"), "lang", F.lit("ăŞţÉ"))
    return table(spark, d, "documents").select("doc_id", F.md5(text.normalize_diacritics(raw)).alias("h"))


@query("clip_times", "SELECT l_orderkey, l_partkey, sum(greatest(0, least(l_quantity - 10, 25)))::DOUBLE AS inside FROM lineitem GROUP BY 1, 2")
def clip_times(spark, d):
    inside = media.to_clip_time(F.col("l_quantity"), F.lit(10.0), F.lit(25.0))
    return table(spark, d, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.sum(inside).alias("inside"))


@query("feature_slices", """WITH x AS (SELECT vec_id, embedding e, least(floor((vec_id % 9) * 10 / 10)::INT, len(embedding)) a, len(embedding) k FROM embeddings), y AS (SELECT *, least(greatest(floor((vec_id % 9) + (vec_id % 70))::INT, a), k) z FROM x)
    SELECT vec_id, z - a AS n, e[a + 1]::DOUBLE AS first_value FROM y WHERE z > a UNION ALL SELECT vec_id, 0, NULL FROM y WHERE z <= a""")
def feature_slices(spark, d):
    start, length = F.col("vec_id") % 9, F.col("vec_id") % 70
    part = media.feature_rows(F.col("embedding"), start / 10, (start + length) / 10, 10)
    return table(spark, d, "embeddings").select("vec_id", part.alias("p")).select("vec_id", F.size("p").alias("n"), F.get("p", F.lit(0)).cast("double").alias("first_value"))


@query("word_scores", "WITH x AS (SELECT vec_id, embedding e, unnest(range(0, 7)) i FROM embeddings) SELECT vec_id, i::INT AS i, e[least(floor(i * len(e) / 7)::INT, len(e) - 1) + 1]::DOUBLE AS score FROM x")
def word_scores(spark, d):
    x = table(spark, d, "embeddings").select("vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("i"))
    return x.select("vec_id", "i", ordered.score_by_ratio(F.col("embedding"), F.col("i"), F.lit(7)).cast("double").alias("score"))


def user_words(spark, d, shift=0.0):
    """Words of half a second each, one row for each user."""
    word = F.struct(F.col("event_type").alias("word"), F.col("i").alias("start"), (F.col("i") + 0.4).alias("end"))
    from pyspark.sql import Window

    i = (F.row_number().over(Window.partitionBy("user_id").orderBy("ts")) - 1) * 0.5 + shift
    e = table(spark, d, "events").withColumn("i", i)
    return e.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", word.alias("w")))).alias("x")).select("user_id", F.transform("x", lambda x: x["w"]).alias("words"))


USER_WORDS = "SELECT user_id, event_type w, (row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1) * 0.5::DOUBLE + {}::DOUBLE s FROM events"


@query("trimmed_words", f"""WITH w AS ({USER_WORDS.format(0)}), k AS (SELECT * FROM w WHERE s + 0.4::DOUBLE > 3.1 AND s < 9.3)
    SELECT u.user_id, count(k.w) AS num_words, coalesce(string_agg(k.w, ' ' ORDER BY s), 'none') AS "text", round(min(greatest(s, 3.1::DOUBLE) - 3.1::DOUBLE), 2) AS first_start, round(max(least(s + 0.4::DOUBLE, 9.3::DOUBLE) - 3.1::DOUBLE), 2) AS last_end
    FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN k ON u.user_id = k.user_id GROUP BY 1""")
def trimmed_words(spark, d):
    seg = user_words(spark, d).withColumns({"text": F.lit("none"), "low": F.lit(3.1), "high": F.lit(9.3)})
    out = ordered.trimmed(seg, "low", "high")
    return out.select("user_id", F.col("num_words").cast("long").alias("num_words"), "text", F.array_min(F.transform("words", lambda w: w["start"])).alias("first_start"), F.array_max(F.transform("words", lambda w: w["end"])).alias("last_end"))


@query("zero_based_words", f"""WITH w AS ({USER_WORDS.format(-1.25)}) SELECT user_id, min(s) AS shift, 0::DOUBLE AS first_start, min(s) AS restored, max(s) - min(s) AS last_start FROM w GROUP BY 1""")
def zero_based_words(spark, d):
    z = user_words(spark, d, -1.25).select("user_id", media.zero_based(F.col("words")).alias("z"))
    starts = lambda c: F.transform(c, lambda w: w["start"])
    return z.select("user_id", "z.shift", F.array_min(starts(F.col("z.words"))).alias("first_start"), F.array_min(starts(media.from_zero_based(F.col("z")))).alias("restored"), F.array_max(starts(F.col("z.words"))).alias("last_start"))


@query("merged_words", """SELECT o_orderkey AS k, 'row' AS side, count(l_partkey) AS n, string_agg(l_partkey::VARCHAR, ' ' ORDER BY l_partkey * 10 + l_linenumber) AS parts FROM (SELECT * FROM orders WHERE o_orderstatus <> 'P') o LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1
    UNION ALL SELECT DISTINCT l_orderkey, 'orphan', 0, NULL FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def merged_words(spark, d):
    """Rows with their words embedded in order, and the words that no row has."""
    words = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("i"), F.col("l_partkey").alias("word"))
    rows, orphans = catalog.merged(table(spark, d, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k")), words, "k", "i", ["word"])
    parts = F.array_join(F.transform("words", lambda w: w["word"].cast("string")), " ")
    held = rows.select("k", F.lit("row").alias("side"), F.coalesce(F.size("words"), F.lit(0)).cast("long").alias("n"), parts.alias("parts"))
    return held.unionByName(orphans.select("k", F.lit("orphan").alias("side"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("string").alias("parts")))


@query("word_positions", "SELECT l_orderkey AS k, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey * 10 + l_linenumber, l_suppkey) - 1)::INT AS word_index, l_partkey AS word FROM lineitem")
def word_positions(spark, d):
    words = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("i"), F.col("l_partkey").alias("word"), "l_suppkey")
    return catalog.word_rows(catalog.embed_words(words, "k", "i", ["word", "l_suppkey"]), "k").drop("l_suppkey")


@query("words_by_voice", r"""WITH w AS (SELECT conv_id, turn, unnest(string_split_regex(text, '\s+')) w FROM conversations) SELECT c.role AS voice, count(*) n, count(DISTINCT lower(w)) kinds FROM w JOIN conversations c USING (conv_id, turn) WHERE w <> '' GROUP BY 1""")
def words_by_voice(spark, d):
    turns = b.turns(spark, d)
    words = turns.select("conv_id", "turn", F.explode(text.words(F.col("text"))).alias("w"))
    words.createOrReplaceTempView("voice_words")
    turns.createOrReplaceTempView("voice_turns")
    return spark.sql("SELECT voice, count(*) n, count(DISTINCT lower(w)) kinds FROM voice_words JOIN voice_turns USING (conv_id, turn) GROUP BY voice")


DROPS = "SELECT o_custkey AS video_id, 'c' || o_orderkey AS clip_id, o_orderpriority AS reason, o_totalprice AS asd FROM orders"


def drops(spark, d):
    return table(spark, d, "orders").select(F.col("o_custkey").alias("video_id"), F.concat(F.lit("c"), F.col("o_orderkey").cast("string")).alias("clip_id"), F.col("o_orderpriority").alias("reason"), F.col("o_totalprice").alias("asd"))


def videos_with_drops(spark, d):
    """Customers with an even key, their urgent orders embedded as rejections under another reason."""
    old = drops(spark, d).filter("reason = '1-URGENT'").withColumn("reason", F.lit("old"))
    held = old.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("clip_id", "reason", "asd"))).alias("dropped_clips"))
    return table(spark, d, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("video_id")).join(held, "video_id", "left")


@query("recorded_drops", f"""WITH r AS ({DROPS}), n AS (SELECT * FROM r WHERE reason <> '5-LOW'), o AS (SELECT video_id, clip_id, 'old' AS reason, asd FROM r WHERE reason = '1-URGENT' AND video_id % 2 = 0)
    SELECT * FROM n UNION ALL SELECT * FROM o WHERE clip_id NOT IN (SELECT clip_id FROM n)""")
def recorded_drops(spark, d):
    """New rejections pushed into their videos, those of a clip replaced, and all read back as rows."""
    return changelog.drop_rows(changelog.record_drops(videos_with_drops(spark, d), drops(spark, d).filter("reason <> '5-LOW'")))


@query("drop_rows", f"SELECT video_id, clip_id, 'old' AS reason, asd FROM ({DROPS}) WHERE reason = '1-URGENT' AND video_id % 2 = 0")
def drop_rows(spark, d):
    return changelog.drop_rows(videos_with_drops(spark, d))


@query("array_counts", f"SELECT (SELECT count(*) FROM customer WHERE c_custkey % 2 = 0) AS documents, (SELECT count(*) FROM ({DROPS}) WHERE reason = '1-URGENT' AND video_id % 2 = 0)::BIGINT AS dropped_clips")
def array_counts(spark, d):
    return catalog.array_counts(videos_with_drops(spark, d), ["dropped_clips"])


@query("replaced_arrays", f"""WITH o AS (SELECT video_id, count(*) n FROM ({DROPS}) WHERE reason = '1-URGENT' GROUP BY 1) SELECT c_custkey AS video_id, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE n END AS items FROM customer LEFT JOIN o ON c_custkey = video_id WHERE c_custkey % 2 = 0""")
def replaced_arrays(spark, d):
    """A third of the arrays emptied, a third replaced, a third left."""
    v = videos_with_drops(spark, d)
    kind = v.schema["dropped_clips"].dataType.simpleString()
    new = F.when(F.col("video_id") % 3 == 0, F.array().cast(kind)).otherwise(F.array(F.struct(F.lit("n").alias("clip_id"), F.lit("r").alias("reason"), F.lit(0.0).alias("asd"))).cast(kind))
    out = changelog.replace_array(v, v.filter("video_id % 3 < 2").select("video_id", new.alias("dropped_clips")), "video_id", "dropped_clips")
    return out.select("video_id", F.when(F.col("dropped_clips").isNotNull(), F.size("dropped_clips")).cast("long").alias("items"))


@query("insert_absent", "SELECT c_custkey AS k, 'old' AS v FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT DISTINCT o_custkey, 'new' FROM orders WHERE o_custkey % 3 <> 0 OR o_custkey NOT IN (SELECT c_custkey FROM customer)")
def insert_absent(spark, d):
    current = table(spark, d, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.lit("old").alias("v"))
    new = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.lit("new").alias("v"))
    return current.unionByName(changelog.insert_absent(current, new, "k"))


@query("bulk_set", "SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN 'set' ELSE c_name END AS n, CASE WHEN c_custkey % 6 = 0 THEN 0 ELSE c_acctbal END AS b FROM customer")
def bulk_set(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("n"), F.col("c_acctbal").alias("b"))
    updates = c.filter("k % 2 = 0").select("k", F.when(F.col("k") % 4 == 0, "set").alias("n"), F.when(F.col("k") % 6 == 0, 0.0).alias("b"))
    return changelog.set_columns(c, updates, "k")


@query("editable_upsert", "SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'edited' ELSE c_name END AS n, c_acctbal AS b FROM customer WHERE c_custkey % 7 > 0 UNION ALL SELECT c_custkey, 'edited', NULL FROM customer WHERE c_custkey % 7 = 0")
def editable_upsert(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("n"), F.col("c_acctbal").alias("b"))
    new = c.filter("k % 5 = 0 OR k % 7 = 0").select("k", F.lit("edited").alias("n"), (F.col("b") * 0).alias("b"))
    return changelog.editable_upsert(c.filter("k % 7 > 0"), new, "k", ["n"])


@query("segment_rows", """SELECT 'v_' || o_custkey || '_' || o_orderkey AS segment_id, 'v_' || o_custkey AS clip_id, CASE WHEN o_orderstatus = 'P' THEN 'v' || o_custkey || '_spk_unknown' ELSE o_orderstatus END AS speaker_id,
    length(o_orderpriority) AS num_chars, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS conf_min, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN 1 ELSE 0 END AS mismatch, 0::DOUBLE AS wer FROM orders""")
def segment_rows(spark, d):
    status, key = F.col("o_orderstatus"), F.col("o_custkey").cast("string")
    results = table(spark, d, "orders").select(
        F.concat(F.lit("v_"), key, F.lit("_"), F.col("o_orderkey").cast("string")).alias("segment_id"), F.concat(F.lit("v"), key).alias("video_id"), F.when(status != "P", status).alias("speaker_id"), F.col("o_orderpriority").alias("text"),
        F.lit(2).alias("num_words"), F.when(status == "F", float("nan")).otherwise(F.col("o_totalprice")).alias("conf_min"), F.lit(0.123456).alias("visibility"), F.when(status != "P", status == "O").alias("mismatch"))
    return changelog.segment_rows(results).select("segment_id", "clip_id", "speaker_id", "num_chars", "conf_min", "mismatch", "wer")


@query("finished_videos", """WITH r AS (SELECT l_orderkey k, count(*) n, sum(CAST(l_quantity AS DECIMAL(20,6)))::DOUBLE s, sum(CAST(l_tax AS DECIMAL(20,6)))::DOUBLE / count(*) a FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
    SELECT o_orderkey AS video_id, CASE WHEN n > 0 THEN 'completed' ELSE o_orderstatus END AS status, CASE WHEN n > 0 THEN n ELSE 0 END AS total_segments, CASE WHEN n > 0 THEN s ELSE 0 END AS total_duration, CASE WHEN n > 0 THEN round(a, 6) ELSE 9 END AS avg_asd FROM orders LEFT JOIN r ON o_orderkey = k""")
def finished_videos(spark, d):
    v = table(spark, d, "orders").select(F.col("o_orderkey").alias("video_id"), F.col("o_orderstatus").alias("status"), F.lit("").alias("processed_date"), F.lit(0).cast("long").alias("total_segments"), F.lit(0.0).alias("total_duration"), F.lit(9.0).alias("avg_asd"))
    done = table(spark, d, "lineitem").filter("l_linestatus = 'F'").select(F.col("l_orderkey").alias("video_id"), F.col("l_quantity").alias("duration"), F.col("l_tax").alias("asd_score"))
    return changelog.finished_videos(v, done, "completed", "2024-01-01").select("video_id", "status", "total_segments", "total_duration", F.round("avg_asd", 6).alias("avg_asd"))


@query("synced_videos", """WITH v AS (SELECT o_orderkey k FROM orders WHERE o_orderstatus <> 'P'), l AS (SELECT l_orderkey k, count(*) n, sum(CAST(l_quantity AS DECIMAL(20,6)))::DOUBLE s FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
    f AS (SELECT l_orderkey k, count(*) n, sum(CAST(l_quantity AS DECIMAL(20,6)))::DOUBLE s FROM lineitem GROUP BY 1) SELECT v.k AS video_id, coalesce(l.n, f.n) AS total_segments, round(coalesce(l.s, f.s), 2) AS total_duration FROM v JOIN f ON v.k = f.k LEFT JOIN l ON v.k = l.k""")
def synced_videos(spark, d):
    v = table(spark, d, "orders").select(F.col("o_orderkey").alias("video_id"), F.when(F.col("o_orderstatus") == "P", 1).alias("total_segments"))
    line = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "video_id")
    sums = lambda rows: rows.groupBy("video_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(20,6)")).cast("double").alias("duration"), F.avg("l_tax").alias("asd"))
    return changelog.synced_videos(v, sums(line.filter("l_returnflag = 'A'")), sums(line)).select("video_id", "total_segments", "total_duration")


@query("corrections", """SELECT doc_id, CASE WHEN doc_id % 4 = 0 AND doc_id % 8 = 0 THEN 'studio' ELSE lang END AS environment, false AS missing FROM documents UNION ALL SELECT doc_id + 1000000, NULL, true FROM documents WHERE doc_id % 100 = 0""")
def corrections(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.col("lang").alias("environment"))
    line = lambda i, v: F.concat(i.cast("string"), F.lit(v)).alias("value")
    pairs = docs.filter("doc_id % 8 = 0").select(line(F.col("doc_id"), ": Studio ")).unionByName(docs.filter("doc_id % 8 = 4").select(line(F.col("doc_id"), ":cave"))) \
        .unionByName(docs.filter("doc_id % 100 = 0").select(line(F.col("doc_id") + 1000000, ":mixed"))).unionByName(docs.filter("doc_id % 8 = 1").select(line(F.col("doc_id"), " studio")))
    named = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    done, missing = changelog.corrections(named, pairs, "doc_id", "environment", ("indoor", "outdoor", "studio", "mixed", "unknown"))
    return done.withColumn("missing", F.lit(False)).unionByName(missing.withColumn("missing", F.lit(True)), allowMissingColumns=True).withColumn("doc_id", F.col("doc_id").cast("long"))


@query("stub_parents", "SELECT o_orderkey AS k, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT DISTINCT l_orderkey, NULL FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")
def stub_parents(spark, d):
    parents = table(spark, d, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    return changelog.with_stubs(parents, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")), "k")


@query("recovered_rows", "SELECT doc_id, lang, NULL::BIGINT AS size FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, NULL, n_chars FROM documents WHERE doc_id % 3 <> 0")
def recovered_rows(spark, d):
    docs = table(spark, d, "documents")
    return changelog.recovered(docs.filter("doc_id % 3 = 0").select("doc_id", "lang"), docs.select("doc_id", F.col("n_chars").alias("size")), "doc_id")


@query("none_pending", "SELECT l_orderkey AS video_id, count(*) AS total_segments, sum(CAST(l_quantity AS DECIMAL(20,6)))::DOUBLE AS total_duration, CASE WHEN bool_and(l_returnflag <> 'N') THEN 'validated' ELSE 'completed' END AS status FROM lineitem GROUP BY 1")
def none_pending(spark, d):
    """Totals rewritten, and the status of videos none of whose segments is pending."""
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("video_id"))
    done = F.every(F.col("l_returnflag") != "N")
    return rows.agg(F.count(F.lit(1)).alias("total_segments"), F.sum(F.col("l_quantity").cast("decimal(20,6)")).cast("double").alias("total_duration"), F.when(done, "validated").otherwise("completed").alias("status"))


@query("median_boxes", "SELECT l_orderkey AS k, floor(quantile_cont(l_quantity, 0.5)) AS x, floor(quantile_cont(l_partkey, 0.5)) AS y, floor(quantile_cont(l_suppkey, 0.5)) AS w, floor(quantile_cont(l_linenumber, 0.5)) AS h FROM lineitem GROUP BY 1")
def median_boxes(spark, d):
    boxes = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_quantity").alias("x"), F.col("l_partkey").alias("y"), F.col("l_suppkey").alias("w"), F.col("l_linenumber").alias("h"))
    return media.median_box(boxes, "k").select("k", *[F.col(c).cast("double").alias(c) for c in "xywh"])


@query("rounded_evidence", "SELECT vec_id AS id, (generate_subscripts(embedding, 1) - 1)::INT AS i, round(unnest(embedding)::DOUBLE, 4) + 0::DOUBLE AS x FROM embeddings")
def rounded_evidence(spark, d):
    return identity.evidence(vectors(spark, d)).select("id", F.posexplode("vec").alias("i", "x"))


@query("rematched", f"""WITH u AS ({UNIT}), k AS (SELECT id, v FROM u WHERE id % 3 < 2), f AS (SELECT id, v FROM u WHERE id % 3 > 0),
    e AS (SELECT id, generate_subscripts(v, 1) i, unnest(v) x FROM u), o AS (SELECT id, i, lead(x) OVER (PARTITION BY i ORDER BY id) y, x FROM e), h AS (SELECT id, i, CASE WHEN id % 3 = 1 AND y IS NOT NULL THEN (x + y) / 2 ELSE x END x FROM o),
    n AS (SELECT id, sqrt(sum(x * x)) n FROM h GROUP BY 1) SELECT h.id, (h.i - 1)::INT AS i, round(CASE WHEN h.id % 3 = 1 THEN x / n ELSE x END, 6) AS x FROM h JOIN n ON h.id = n.id""")
def rematched(spark, d):
    """Known centroids of two thirds of the ids; found ones of two thirds: those of both move half-way to the next vector."""
    from tallyloom.operators.joins import unit
    from tallyloom.operators.queues import numbered

    u = vectors(spark, d).select("id", unit(F.col("vec")).alias("centroid"))
    placed = numbered(u, ["id"])
    after = placed.join(placed.select((F.col("pos") - 1).alias("pos"), F.col("centroid").alias("after")), "pos", "left")
    found = after.filter("id % 3 > 0").select("id", F.when(F.col("id") % 3 == 1, F.coalesce("after", "centroid")).otherwise(F.col("centroid")).alias("centroid"))
    return identity.rematched(u.filter("id % 3 < 2"), found).select("id", F.posexplode("centroid").alias("i", "x")).select("id", "i", F.round("x", 6).alias("x"))


@query("outlier_labels", f"""WITH RECURSIVE u AS ({UNIT}), l AS (SELECT a.id a, b.id b FROM u a JOIN u b ON a.label = b.label AND a.id <> b.id WHERE list_inner_product(a.v, b.v) >= 0.3),
    r AS (SELECT id, id AS root FROM u UNION SELECT l.b, r.root FROM r JOIN l ON r.id = l.a), m AS (SELECT id, min(root) root, count(*) k FROM r GROUP BY 1),
    n AS (SELECT u.label, u.id, dense_rank() OVER (PARTITION BY u.label ORDER BY root) - 1 AS c FROM u JOIN m USING (id) WHERE k > 1)
    SELECT u.label AS key, u.id, coalesce(u.label || '_spk' || c, u.label || '_spkOUT_' || right(u.id::VARCHAR, 6)) AS label FROM u LEFT JOIN n ON u.id = n.id""")
def outlier_labels(spark, d):
    v = vectors(spark, d).withColumnRenamed("label", "key")
    return identity.outlier_labels(identity.clusters(v, "key", 0.30, 2), "key")


@query("nearest_landmarks", """WITH e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 i, value, event_type IN ('click', 'purchase') ok FROM events),
    n AS (SELECT a.user_id, a.i, b.value v, row_number() OVER (PARTITION BY a.user_id, a.i ORDER BY abs(a.i - b.i), b.i) r FROM e a JOIN e b ON a.user_id = b.user_id AND b.ok) SELECT user_id, i::INT AS frame, v AS cx FROM n WHERE r = 1""")
def nearest_landmarks(spark, d):
    return media.nearest_landmarks(landmarks(spark, d)).filter("width IS NOT NULL").select(F.col("clip").alias("user_id"), "frame", "cx")


def landmarks(spark, d):
    from pyspark.sql import Window

    e = table(spark, d, "events").withColumn("frame", (F.row_number().over(Window.partitionBy("user_id").orderBy("ts")) - 1).cast("int"))
    some = lambda c: F.when(F.col("event_type").isin("click", "purchase"), c)
    return e.select(F.col("user_id").alias("clip"), "frame", some(F.col("value")).alias("cx"), some(F.col("value") / 2).alias("cy"), some((F.col("event_id") % 90).cast("double")).alias("width"), some(F.lit(0.0)).alias("roll"))


@query("recomputed_wer", f"""SELECT w.conv_id * 1000 + w.turn AS segment_id, wer, len(r)::INT AS wer_words FROM ({ORACLE["wer_turns"]}) w JOIN (SELECT conv_id, turn, lag(h) OVER (PARTITION BY conv_id ORDER BY turn) r FROM ({TURN_TOKENS})) t
    ON w.conv_id = t.conv_id AND w.turn = t.turn WHERE r IS NOT NULL""")
def recomputed_wer(spark, d):
    """Each turn as an edit of the one before it; first turns have no original and are left alone."""
    from pyspark.sql import Window

    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    seg = b.turns(spark, d).select((F.col("conv_id") * 1000 + F.col("turn")).alias("segment_id"), before.alias("original_text"), "text")
    return changelog.recomputed_wer(seg)


@query("audio_tags")
def audio_tags(spark, d):
    """Loudness, flatness and noise class of the vectors taken as sound."""
    sound = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("samples"), F.lit(8000).alias("rate"))
    return media.noise_tags(sound, "vec_id")


@query("mouth_windows")
def mouth_windows(spark, d):
    """Both trajectories of the mouth: widest with nearest landmarks, and median with the One-Euro filter."""
    rows = landmarks(spark, d)
    return media.widest_mouth_trajectory(rows).withColumn("kind", F.lit("widest")).unionByName(media.mouth_trajectory(rows).drop("roll").withColumn("kind", F.lit("median")))


@query("kalman_boxes")
def kalman_boxes(spark, d):
    frame = (F.floor(F.col("at") / 7200) % 400).cast("int")
    boxes = events(spark, d).groupBy("user_id", frame.alias("frame")).agg((F.max("value") % 50).alias("x"), (F.max("value") % 30).alias("y"), F.lit(40.0).alias("w"), F.lit(40.0).alias("h"))
    return tracks.smooth_boxes(boxes, "user_id")


@query("turn_changes", """WITH t AS (SELECT conv_id, turn, list_filter(string_split_regex(lower(coalesce(text, '')), '\\s+'), lambda x: x <> '') AS h FROM conversations),
    u AS (SELECT conv_id, turn, h, coalesce(lag(h) OVER (PARTITION BY conv_id ORDER BY turn), []) AS r FROM t)
    SELECT conv_id, turn, len(h)::INT AS n, CASE WHEN len(r) = 0 OR len(h) = 0 THEN 0 ELSE list_reduce(list_transform(range(1, len(r) + 1), lambda i: [i]), lambda held, e: list_reduce(list_transform(range(1, len(h) + 1), lambda j: [j]),
    lambda cells, f: list_append(cells, CASE WHEN h[f[1]] = r[e[1]] THEN held[f[1]] + 1 ELSE greatest(cells[-1], held[f[1] + 1]) END), [0]), list_transform(range(0, len(h) + 1), lambda x: 0))[-1] END::INT AS same FROM u""")
def turn_changes(spark, d):
    """Of each turn the words that the one before it lacks, by a longest common subsequence."""
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    pairs = b.turns(spark, d).withColumn("before", F.lag("text").over(w))
    told = pairs.select("conv_id", "turn", word_changes(F.col("before"), F.col("text")).alias("x"))
    return told.select("conv_id", "turn", F.size("x").alias("n"), F.size(F.filter("x", lambda t: t["type"] == "same")).alias("same"))
