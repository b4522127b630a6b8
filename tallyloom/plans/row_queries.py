"""Queries of filters, joins, ordered streams, identity, text and change logs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.functions import rules, text
from tallyloom.functions.wer import wer
from tallyloom.operators import changelog, identity, joins, ordered, stats, tracks
from tallyloom.plans import binding as b
from tallyloom.plans.binding import SEG
from tallyloom.registry import query
from tallyloom.session import table

S = f"WITH s AS ({SEG})"


@query("review_flags", """SELECT l_orderkey, count(*) n FROM lineitem WHERE (CASE WHEN l_returnflag = 'R' THEN 'rejected' ELSE '' END) <> '' OR l_linenumber > 5
    OR l_quantity = 50 GROUP BY 1""")
def review_flags(spark, d):
    status = F.when(F.col("l_returnflag") == "R", "rejected").otherwise("")
    flag = rules.review_flagged(status, (F.col("l_linenumber") > 5).cast("int"), (F.col("l_quantity") == 50).cast("int"))
    return table(spark, d, "lineitem").filter(flag).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("batch_select", """SELECT o_orderkey, o_orderstatus FROM orders WHERE (o_orderkey IN (1, 2, 3, 4, 5) AND o_orderstatus <> 'F')
    OR (o_orderkey NOT IN (1, 2, 3, 4, 5) AND o_orderstatus IN ('P')) ORDER BY o_orderkey LIMIT 50""")
def batch_select(spark, d):
    picked = F.col("o_orderkey").isin(1, 2, 3, 4, 5)
    wanted = F.when(picked, F.col("o_orderstatus") != "F").otherwise(F.col("o_orderstatus").isin("P"))
    return table(spark, d, "orders").filter(wanted).select("o_orderkey", "o_orderstatus").orderBy("o_orderkey").limit(50)


@query("explorer_page", f"""{S}, f AS (SELECT video_id, segment_no, l_partkey, asd_score, created_at, row_number() OVER (ORDER BY asd_score DESC NULLS LAST, video_id, segment_no, l_partkey, created_at) AS pos
    FROM s WHERE tier = 'A' AND asd_score >= 5 AND whisper_conf >= 0.75 AND review_status <> 'rejected') SELECT video_id, segment_no, l_partkey, asd_score, pos FROM f WHERE pos BETWEEN 101 AND 150""")
def explorer_page(spark, d):
    hits = b.segments(spark, d).filter("tier = 'A' AND asd_score >= 5 AND whisper_conf >= 0.75").filter(rules.not_rejected(F.col("review_status")))
    order = [F.col("asd_score").desc_nulls_last(), "video_id", "segment_no", "l_partkey", "created_at"]
    page = hits.orderBy(*order).limit(150)  # sort and limit first: the window then numbers one page's rows
    return page.withColumn("pos", F.row_number().over(Window.orderBy(*order))).filter("pos > 100").select("video_id", "segment_no", "l_partkey", "asd_score", "pos")


@query("search", "SELECT doc_id, source, lang FROM documents WHERE lang = 'en' AND (contains(lower(text), 'tiontion') OR contains(lower(source), 'tiontion') OR contains(lower(lang), 'tiontion'))")
def search(spark, d):
    hit = F.lit(False)
    for c in ("text", "source", "lang"):
        hit = hit | F.lower(c).contains("tiontion")
    return table(spark, d, "documents").filter((F.col("lang") == "en") & hit).select("doc_id", "source", "lang")


@query("auto_tag_queue", """SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL
    AND d.source NOT IN (SELECT source FROM documents GROUP BY source HAVING count(*) > 60)""")
def auto_tag_queue(spark, d):
    docs = table(spark, d, "documents")
    done = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")).filter("n > 60").select("source")
    return docs.join(table(spark, d, "labels"), "doc_id", "left_anti").join(done, "source", "left_anti").select("doc_id")


@query("orphans_anti", """SELECT o_orderkey AS video_id, 'right' AS side FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT DISTINCT l_orderkey, 'left' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def orphans_anti(spark, d):
    return joins.orphans(b.segments(spark, d), b.videos(spark, d), "video_id")


@query("count_mismatch", """WITH n AS (SELECT l_orderkey, count(*) n FROM lineitem GROUP BY 1) SELECT o_orderkey, (o_orderkey % 7)::BIGINT AS stated, coalesce(n, 0) live
    FROM orders LEFT JOIN n ON l_orderkey = o_orderkey WHERE o_orderkey % 7 <> coalesce(n, 0)""")
def count_mismatch(spark, d):
    n = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    both = table(spark, d, "orders").join(n, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return both.select("o_orderkey", (F.col("o_orderkey") % 7).alias("stated"), F.coalesce("n", F.lit(0)).alias("live")).filter("stated <> live")


@query("fill_blanks_merge", """WITH c AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END env, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE source END noise FROM documents),
    p AS (SELECT doc_id, lang env, 'n' || quality noise FROM documents JOIN labels USING (doc_id))
    SELECT doc_id, 'env' AS "column", c.env AS old, p.env AS new FROM c JOIN p USING (doc_id) WHERE trim(coalesce(c.env, '')) = '' AND trim(p.env) <> ''
    UNION ALL SELECT doc_id, 'noise', c.noise, p.noise FROM c JOIN p USING (doc_id) WHERE trim(coalesce(c.noise, '')) = '' AND trim(p.noise) <> ''""")
def fill_blanks_merge(spark, d):
    docs = table(spark, d, "documents")
    current = docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang")).alias("env"), F.when(F.col("doc_id") % 5 != 0, F.col("source")).alias("noise"))
    proposed = docs.join(table(spark, d, "labels"), "doc_id").select("doc_id", F.col("lang").alias("env"), F.concat(F.lit("n"), F.col("quality")).alias("noise"))
    return joins.merge_proposals(current, proposed, "doc_id", ["env", "noise"])


@query("import_dedup", r"""WITH p AS (SELECT page_id, regexp_extract(url, '/(\d+)', 1) x FROM pages), k AS (SELECT DISTINCT x FROM p WHERE page_id < 50),
    r AS (SELECT *, row_number() OVER (PARTITION BY x ORDER BY page_id) n FROM p WHERE page_id >= 50 AND x <> '' AND x NOT IN (SELECT x FROM k)) SELECT page_id, x FROM r WHERE n = 1""")
def import_dedup(spark, d):
    own = table(spark, d, "pages").select("page_id", F.nullif(F.regexp_extract("url", r"/(\d+)", 1), F.lit("")).alias("x"))
    return joins.new_imports(own.filter("page_id >= 50"), own.filter("page_id < 50 AND x IS NOT NULL"), "x", "page_id").select("page_id", "x")


@query("renumber", """WITH r AS (SELECT o_orderkey, lower(o_orderpriority[3:5]) p, o_orderkey n FROM orders WHERE o_orderstatus <> 'P')
    SELECT o_orderkey, p || '_' || lpad((row_number() OVER (PARTITION BY p ORDER BY n))::VARCHAR, 7, '0') new_id FROM r""")
def renumber(spark, d):
    rows = table(spark, d, "orders").filter("o_orderstatus <> 'P'").select("o_orderkey", F.lower(F.substring("o_orderpriority", 3, 3)).alias("p"), F.col("o_orderkey").alias("n"), F.lit(7).alias("w"))
    return ordered.renumber(rows, "p", "n", "w").select("o_orderkey", "new_id")


@query("next_ids", r"""SELECT regexp_extract(c_name, '^([A-Za-z]+)', 1) prefix, max(regexp_extract(c_name, '(\d+)$', 1)::BIGINT) + 1 next_number FROM customer GROUP BY 1""")
def next_ids(spark, d):
    name = F.regexp_replace("c_name", r"^([A-Za-z]+)[^A-Za-z0-9]*", "$1_")
    return table(spark, d, "customer").groupBy(text.id_prefix(name).alias("prefix")).agg((F.max(text.id_number(name)) + 1).alias("next_number"))


EV = "SELECT event_id, user_id, event_type, value, epoch_us(ts) / 1e6 AS tm FROM events"


def events(spark, d):
    return table(spark, d, "events").select("event_id", "user_id", "event_type", "value", "props", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"))


@query("silence_islands", f"""WITH e AS ({EV}), g AS (SELECT *, CASE WHEN tm - lag(tm) OVER w >= 43200 THEN 1 ELSE 0 END n FROM e WINDOW w AS (PARTITION BY user_id ORDER BY tm)),
    i AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY tm) AS island FROM g) SELECT user_id, island::BIGINT AS island, count(*) n, max(tm) - min(tm) AS seconds FROM i GROUP BY 1, 2""")
def silence_islands(spark, d):
    marked = ordered.islands(events(spark, d), ["user_id"], "at", F.lit(43200))
    return marked.groupBy("user_id", "island").agg(F.count(F.lit(1)).alias("n"), (F.max("at") - F.min("at")).alias("seconds"))


@query("unit_boundaries", f"""WITH e AS ({EV}), t AS (SELECT *, CASE WHEN lead(tm) OVER w IS NULL THEN 'media' WHEN event_type = 'purchase' THEN 'punctuation'
    WHEN lead(value > 100) OVER w <> (value > 100) THEN 'speaker_change' WHEN lead(tm) OVER w - tm >= 36000 THEN 'silence' END k FROM e WINDOW w AS (PARTITION BY user_id ORDER BY tm))
    SELECT k, count(*) n FROM t WHERE k IS NOT NULL GROUP BY 1""")
def unit_boundaries(spark, d):
    words = events(spark, d).select("user_id", F.col("at").alias("start"), F.col("at").alias("end"),
        F.when(F.col("event_type") == "purchase", "x.").otherwise("x").alias("raw"), F.when(F.col("value") > 100, "S1").otherwise("S0").alias("speaker"))
    return ordered.boundaries(words, ["user_id"], ["start"], 36000).filter("end_type IS NOT NULL").groupBy(F.col("end_type").alias("k")).agg(F.count(F.lit(1)).alias("n"))


#: One step of splitting runs of over 6 seconds at their largest gap, and ten of them: x are all runs that come up.
SPLIT = """SELECT conv_id, CASE WHEN side = 0 THEN a ELSE -m.i + 1 END AS a, CASE WHEN side = 0 THEN -m.i ELSE z END AS z, CASE WHEN side = 0 THEN began ELSE 'word_gap' END AS began, CASE WHEN side = 0 THEN 'word_gap' ELSE ended END AS ended,
    CASE WHEN side = 0 THEN s ELSE m.gs END AS s, CASE WHEN side = 0 THEN m.ge ELSE e END AS e FROM (SELECT x.conv_id, x.a, x.z, x.began, x.ended, x.s, x.e, max({{'g': gap.gap, 'm': -abs(gap.p - x.a - (x.z - x.a) / 2::DOUBLE), 'i': -gap.p, 'ge': gap.e, 'gs': gap.s}}) AS m
    FROM x{n} x JOIN gap ON gap.conv_id = x.conv_id AND gap.p BETWEEN x.a AND x.z - 1 WHERE x.e - x.s > 6 AND x.z > x.a GROUP BY ALL), (VALUES (0), (1)) v(side)"""
SPLITS = "    x0 AS (SELECT conv_id, a, z, began, ended, s, e FROM g), " + " ".join(f"x{n + 1} AS MATERIALIZED ({SPLIT.format(n=n)})," for n in range(10)) + " x AS (" + " UNION ALL ".join(f"SELECT * FROM x{n}" for n in range(11)) + "),"


@query("sentence_windows", r"""WITH RECURSIVE w0 AS (SELECT conv_id, turn, role, unnest(string_split_regex(text, '\s+')) raw, generate_subscripts(string_split_regex(text, '\s+'), 1) - 1 AS i0 FROM conversations),
    w1 AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY i0) - 1 i, row_number() OVER (PARTITION BY conv_id ORDER BY turn, i0) - 1 p FROM w0 WHERE raw <> ''),
    w AS MATERIALIZED (SELECT *, turn * 400 + i * 0.4::DOUBLE s, turn * 400 + i * 0.4::DOUBLE + 0.35::DOUBLE e,
    regexp_replace(upper(replace(translate(nfc_normalize(raw), 'şŞţŢ', 'șȘțȚ'), 'ß', 'SS')), '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g') c FROM w1),
    b AS (SELECT *, CASE WHEN lead(s) OVER o IS NULL THEN 'media' WHEN right(rtrim(raw, '"''”„»’)]}'), 1) IN ('.', '?', '!', '…') THEN 'punctuation' WHEN lead(role) OVER o <> role THEN 'speaker_change'
    WHEN lead(s) OVER o - e >= 0.5 THEN 'silence' END k FROM w WINDOW o AS (PARTITION BY conv_id ORDER BY p)),
    n AS (SELECT *, coalesce(count(k) OVER (PARTITION BY conv_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) u FROM b),
    u AS (SELECT conv_id, u, min(p) a, max(p) z, min(s) s, max(e) e, any_value(role) role, max(k) k FROM n GROUP BY 1, 2),
    r AS (SELECT conv_id, u, u AS run, s AS rs, e AS re, role FROM u WHERE u = 0 UNION ALL
    SELECT conv_id, u, CASE WHEN m THEN run ELSE u END, CASE WHEN m THEN rs ELSE s END, e, role FROM (SELECT u.conv_id, u.u, u.s, u.e, u.role, r.run, r.rs, r.re - r.rs < 2 AND u.s - r.re <= 1 AND u.e - r.rs <= 12 AND u.role = r.role AS m
    FROM r JOIN u ON u.conv_id = r.conv_id AND u.u = r.u + 1)),
    g AS MATERIALIZED (SELECT u.conv_id, run, min(a) a, max(z) z, min(s) s, max(e) e, min_by(coalesce(q.k, 'media'), u.u) began, max_by(u.k, u.u) ended FROM r JOIN u USING (conv_id, u) LEFT JOIN (SELECT conv_id, u + 1 AS u, k FROM u) q ON q.conv_id = u.conv_id AND q.u = u.u GROUP BY 1, 2),
    gap AS MATERIALIZED (SELECT conv_id, p, e, lead(s) OVER o AS s, lead(s) OVER o - e AS gap FROM w WINDOW o AS (PARTITION BY conv_id ORDER BY p)),
""" + SPLITS + r"""
    y AS MATERIALIZED (SELECT * FROM x WHERE NOT (e - s > 6 AND z > a)),
    t AS (SELECT *, greatest(0, s - CASE WHEN lag(e) OVER o IS NULL THEN 0.15::DOUBLE ELSE least(0.15::DOUBLE, greatest(0, (s - lag(e) OVER o) / 2)) END) s2, e + CASE WHEN lead(s) OVER o IS NULL THEN 0.15::DOUBLE ELSE least(0.15::DOUBLE, greatest(0, (lead(s) OVER o - e) / 2)) END e2 FROM y WINDOW o AS (PARTITION BY conv_id ORDER BY a)),
    f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY a) - 1 AS num FROM t WHERE e2 - s2 >= 1)
    SELECT f.conv_id, num::INT AS number, round(s2, 6) AS starts, round(e2, 6) AS ends, count(*) AS n_words, coalesce(string_agg(c, ' ' ORDER BY p) FILTER (WHERE c <> ''), '') AS "text", any_value(role) AS voice, began, ended
    FROM f JOIN w ON w.conv_id = f.conv_id AND w.p BETWEEN f.a AND f.z GROUP BY f.conv_id, num, s2, e2, began, ended""")
def sentence_windows(spark, d):
    """Turns as words of about 0.4 s each; one recording for each conversation."""
    w = b.turns(spark, d).select("conv_id", "turn", "voice", F.posexplode(text.words(F.col("text"))).alias("i", "raw"))
    start = F.col("turn") * 400 + F.col("i") * 0.4
    words = w.select("conv_id", "turn", "i", start.alias("start"), (start + 0.35).alias("end"), "raw", text.clean_word(F.col("raw")).alias("clean"), F.col("voice").alias("speaker"))
    found = ordered.sentence_windows(words, "conv_id", ["turn", "i"], ordered.Segmentation(hard_max=6.0))
    return found.select("conv_id", F.col("window").alias("number"), F.round("start", 6).alias("starts"), F.round("end", 6).alias("ends"), F.col("n_words").cast("long").alias("n_words"), "text", "voice", F.col("start_type").alias("began"), F.col("end_type").alias("ended"))


@query("interval_max_overlap", f"""WITH e AS ({EV}), w AS (SELECT event_id, user_id, tm AS s, tm + value * 100 AS t FROM e), r AS (SELECT user_id, event_id AS no, tm AS s, tm + 40000 AS t, event_type FROM e WHERE event_type IN ('purchase', 'signup')),
    o AS (SELECT w.event_id, r.event_type, least(w.t, r.t) - greatest(w.s, r.s) o, r.no FROM w JOIN r ON w.user_id = r.user_id AND least(w.t, r.t) - greatest(w.s, r.s) > 0),
    b AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_id ORDER BY o DESC, no) n FROM o)
    SELECT w.event_id AS word_id, b.event_type AS label FROM w LEFT JOIN b ON w.event_id = b.event_id AND n = 1""")
def interval_max_overlap(spark, d):
    e = events(spark, d)
    words = e.select("user_id", F.col("event_id").alias("word_id"), F.col("at").alias("start"), (F.col("at") + F.col("value") * 100).alias("end"))
    turns = e.filter(F.col("event_type").isin("purchase", "signup")).select("user_id", F.col("event_id").alias("turn_no"), F.col("at").alias("r_start"), (F.col("at") + 40000).alias("r_end"), F.col("event_type").alias("label"))
    return joins.widest_overlap(words, turns, ["user_id"], 43200.0).select("word_id", "label")


@query("region_semijoin", f"""WITH e AS ({EV}), r AS (SELECT user_id, tm s, tm + 600 t FROM e WHERE event_type = 'error' AND user_id % 3 <> 0)
    SELECT event_id AS word_id FROM e WHERE EXISTS (SELECT 1 FROM r WHERE r.user_id = e.user_id AND e.tm + 60 > r.s - 3600 AND e.tm < r.t + 3600) OR user_id NOT IN (SELECT user_id FROM r)""")
def region_semijoin(spark, d):
    e = events(spark, d)
    words = e.select("user_id", F.col("event_id").alias("word_id"), F.col("at").alias("start"), (F.col("at") + 60).alias("end"))
    regions = e.filter("event_type = 'error' AND user_id % 3 <> 0").select("user_id", F.col("at").alias("r_start"), (F.col("at") + 600).alias("r_end"))
    return joins.inside_regions(words, regions, ["user_id"], 3600.0, 43200.0).select("word_id")


@query("track_overlap", f"""WITH e AS ({EV}) SELECT a.event_id a, b.event_id b FROM e a JOIN e b ON a.user_id = b.user_id WHERE a.event_type = 'click' AND b.event_type = 'view'
    AND least(a.tm + 900, b.tm + 1200) - greatest(a.tm, b.tm) >= 300""")
def track_overlap(spark, d):
    e = events(spark, d)
    left = e.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("a"), F.col("at").alias("start"), (F.col("at") + 900).alias("end"))
    right = e.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("b"), F.col("at").alias("r_start"), (F.col("at") + 1200).alias("r_end"))
    met = joins.interval_join(left, right, ["user_id"], 7200.0)
    return met.filter(joins.overlap(*map(F.col, ("start", "end", "r_start", "r_end"))) >= 300).select("a", "b")


@query("iou_pairs", """WITH x AS (SELECT l_orderkey k, l_linenumber n, l_quantity x, l_discount * 100 y, l_quantity + 5 w, l_tax * 100 + 5 h, l_partkey p FROM lineitem),
    j AS (SELECT a.k, a.p d, b.p t, greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) i, a.w * a.h + b.w * b.h u FROM x a JOIN x b ON a.k = b.k AND a.p < b.p)
    SELECT k, d, t, round(i / (u - i), 6) iou FROM j WHERE i / (u - i) >= 0.3""")
def iou_pairs(spark, d):
    box = F.struct(F.col("l_quantity").alias("x"), (F.col("l_discount") * 100).alias("y"), (F.col("l_quantity") + 5).alias("w"), (F.col("l_tax") * 100 + 5).alias("h"))
    x = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("d"), box.alias("box"))
    met = joins.box_pairs(x, x.select("k", F.col("d").alias("t"), F.col("box").alias("track_box")), ["k"], 0.3)
    return met.filter("d < t").select("k", "d", "t", F.round("iou", 6).alias("iou"))


@query("coverage", """WITH x AS (SELECT l_orderkey k, (l_partkey % 200)::BIGINT s, (l_partkey % 200 + l_quantity)::BIGINT t FROM lineitem), f AS (SELECT k, unnest(range(s, t + 1)) f FROM x)
    SELECT k, round(count(DISTINCT f) / (max(f) - min(f) + 1), 9) coverage FROM f GROUP BY 1""")
def coverage(spark, d):
    spans = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_partkey") % 200).alias("start"), (F.col("l_partkey") % 200 + F.col("l_quantity")).cast("long").alias("end"))
    return ordered.coverage(spans, ["k"]).select("k", F.round("coverage", 9).alias("coverage"))


@query("carry_forward", f"""WITH e AS ({EV}) SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY tm) v FROM e""")
def carry_forward(spark, d):
    rows = events(spark, d).withColumn("v", F.when(F.col("event_type") == "purchase", F.col("value")))
    return ordered.carry_forward(rows, ["user_id"], "at", "v").select("event_id", "v")


@query("linear_interp", f"""WITH e AS (SELECT *, CASE WHEN event_type IN ('purchase', 'view') THEN value END v FROM ({EV})),
    n AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN tm END IGNORE NULLS) OVER b ax, last_value(v IGNORE NULLS) OVER b ay,
    first_value(CASE WHEN v IS NOT NULL THEN tm END IGNORE NULLS) OVER f bx, first_value(v IGNORE NULLS) OVER f by_ FROM e
    WINDOW b AS (PARTITION BY user_id ORDER BY tm ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY user_id ORDER BY tm ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT event_id, round(CASE WHEN v IS NOT NULL THEN v ELSE ay + (by_ - ay) * (tm - ax) / (bx - ax) END, 6) v FROM n""")
def linear_interp(spark, d):
    rows = events(spark, d).withColumn("v", F.when(F.col("event_type").isin("purchase", "view"), F.col("value")))
    return ordered.interpolate(rows, ["user_id"], "at", "v").select("event_id", F.round("v", 6).alias("v"))


@query("rolling_corr", f"""WITH e AS ({EV}), r AS (SELECT *, (event_id % 17)::DOUBLE x FROM e) SELECT event_id, round(corr(value, x) OVER (PARTITION BY user_id ORDER BY tm ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING), 6) c FROM r""")
def rolling_corr(spark, d):
    rows = events(spark, d).withColumn("x", (F.col("event_id") % 17).cast("double"))
    return ordered.rolling_corr(rows, ["user_id"], "at", "value", "x", 10).select("event_id", F.round("corr", 6).alias("c"))


@query("best_lag", f"""WITH e AS (SELECT *, (event_id % 17)::DOUBLE x, row_number() OVER (PARTITION BY user_id ORDER BY tm) i FROM ({EV})),
    j AS (SELECT a.user_id, b.i - a.i AS lag, corr(a.value, b.x) c, count(*) n FROM e a JOIN e b ON a.user_id = b.user_id AND b.i - a.i BETWEEN -15 AND 15 GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(c, 9) DESC, abs(lag), lag) k FROM j WHERE n > 2 AND c IS NOT NULL AND NOT isnan(c)) SELECT user_id, lag, round(c, 6) AS corr FROM r WHERE k = 1""")
def best_lag(spark, d):
    rows = events(spark, d).withColumn("x", (F.col("event_id") % 17).cast("double"))
    return ordered.best_lag(rows, ["user_id"], "at", "value", "x", 15).select("user_id", "lag", F.round("corr", 6).alias("corr"))


@query("equal_chunks", """WITH x AS (SELECT l_orderkey k, l_partkey p, l_linenumber n, l_quantity q, greatest(1, ceil(l_quantity / 12))::INT c FROM lineitem),
    y AS (SELECT *, unnest(range(0, c)) i FROM x) SELECT k, p, i::INT part, round(q / c * i, 6) s, round(q / c * (i + 1), 6) t FROM y""")
def equal_chunks(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("p"), F.lit(0.0).alias("start"), F.col("l_quantity").alias("end"))
    return ordered.equal_chunks(x, 12.0).select("k", "p", "part", F.round("start", 6).alias("s"), F.round("end", 6).alias("t"))


VEC = "SELECT vec_id id, label, list_transform(embedding, lambda x: x::DOUBLE) v FROM embeddings"
UNIT = f"SELECT id, label, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) v FROM ({VEC})"


def vectors(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vec"))


@query("cosine_links", f"WITH u AS ({UNIT}) SELECT a.label, a.id a, b.id b, round(list_inner_product(a.v, b.v), 6) cosine FROM u a JOIN u b ON a.label = b.label AND a.id < b.id WHERE list_inner_product(a.v, b.v) >= 0.3")
def cosine_links(spark, d):
    return joins.cosine_links(vectors(spark, d), "label", 0.30).select("label", "a", "b", F.round("cosine", 6).alias("cosine"))


@query("cluster_components", f"""WITH RECURSIVE u AS ({UNIT}), l AS (SELECT a.id a, b.id b FROM u a JOIN u b ON a.label = b.label AND a.id <> b.id WHERE list_inner_product(a.v, b.v) >= 0.3),
    r AS (SELECT id, id AS root FROM u UNION SELECT l.b, r.root FROM r JOIN l ON r.id = l.a), m AS (SELECT id, min(root) root FROM r GROUP BY 1)
    SELECT u.label, u.id, (dense_rank() OVER (PARTITION BY u.label ORDER BY root) - 1)::INT AS "cluster" FROM u JOIN m USING (id)""")
def cluster_components(spark, d):
    return identity.clusters(vectors(spark, d), "label", 0.30)


@query("cosine_top1", f"""WITH u AS ({UNIT}), j AS (SELECT q.id, k.id k_id, list_inner_product(q.v, k.v) c FROM u q JOIN u k ON k.id % 10 = 0 AND q.id % 10 <> 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY c DESC, k_id) n FROM j) SELECT id, CASE WHEN c >= 0.3 THEN k_id END k_id, round(CASE WHEN c >= 0.3 THEN c END, 6) cosine FROM r WHERE n = 1""")
def cosine_top1(spark, d):
    v = vectors(spark, d)
    known = v.filter("id % 10 = 0").select(F.col("id").alias("k_id"), F.col("vec").alias("k_vec"))
    return joins.nearest_known(v.filter("id % 10 <> 0"), known, 0.30).select("id", "k_id", F.round("cosine", 6).alias("cosine"))


@query("centroids", f"""WITH u AS ({UNIT}), e AS (SELECT label, generate_subscripts(v, 1) i, unnest(v) x FROM u), m AS (SELECT label, i, avg(x) x FROM e GROUP BY 1, 2),
    n AS (SELECT label, sqrt(sum(x * x)) n FROM m GROUP BY 1) SELECT label, (i - 1)::INT i, round(x / n, 6) x FROM m JOIN n USING (label)""")
def centroids(spark, d):
    return identity.centroids(vectors(spark, d), ["label"]).select("label", F.posexplode("centroid").alias("i", "x")).select("label", "i", F.round("x", 6).alias("x"))


@query("av_consensus", """WITH x AS (SELECT l_orderkey % 500 AS k, l_returnflag voice, CASE WHEN l_linenumber = 7 THEN '' ELSE l_linestatus || (l_suppkey % 2) END face FROM lineitem),
    n AS (SELECT k, voice, face, count(*) n FROM x WHERE face <> '' GROUP BY 1, 2, 3), m AS (SELECT *, row_number() OVER (PARTITION BY k, voice ORDER BY n DESC, face) r FROM n)
    SELECT x.k, x.voice, CASE WHEN x.face <> '' THEN (x.face <> m.face)::INT END mismatch, count(*) n FROM x LEFT JOIN m ON x.k = m.k AND x.voice = m.voice AND r = 1 GROUP BY 1, 2, 3""")
def av_consensus(spark, d):
    face = F.when(F.col("l_linenumber") == 7, "").otherwise(F.concat("l_linestatus", (F.col("l_suppkey") % 2).cast("string")))
    rows = table(spark, d, "lineitem").select((F.col("l_orderkey") % 500).alias("k"), F.col("l_returnflag").alias("voice"), face.alias("face"))
    return identity.av_consensus(rows, ["k"]).groupBy("k", "voice", "mismatch").agg(F.count(F.lit(1)).alias("n"))


@query("speaker_profiles", """SELECT l_suppkey, CASE WHEN avg((l_linestatus = 'F')::INT) > 0.5 THEN 'M' ELSE 'F' END gender, round(greatest(avg((l_linestatus = 'F')::INT), 1 - avg((l_linestatus = 'F')::INT)), 3) confidence,
    round(quantile_cont(l_quantity + 18, 0.5), 1) age, round(stddev_pop(l_quantity + 18), 1) age_std, CASE WHEN quantile_cont(l_quantity + 18, 0.5) < 31 THEN '18-30' WHEN quantile_cont(l_quantity + 18, 0.5) < 51 THEN '31-50' ELSE '51+' END age_group
    FROM lineitem GROUP BY 1""")
def speaker_profiles(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", (F.col("l_linestatus") == "F").cast("int").alias("gender"), (F.col("l_quantity") + 18).alias("age"))
    return identity.profile(rows, "l_suppkey")


@query("majority_region", """WITH n AS (SELECT l_suppkey, l_returnflag, count(*) n FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) i FROM n) SELECT l_suppkey, l_returnflag FROM r WHERE i = 1""")
def majority_region(spark, d):
    return identity.majority(table(spark, d, "lineitem"), "l_suppkey", "l_returnflag")


@query("clean_words", r"""WITH w AS (SELECT unnest(string_split_regex(text, '\s+')) w FROM benchmark), m AS (SELECT unnest([w, '„' || w || 's' || chr(806) || 'i.', 'ş' || w || 'a' || chr(774) || '}']) w FROM w WHERE w <> '')
    SELECT regexp_replace(upper(replace(translate(nfc_normalize(w), 'şŞţŢ', 'șȘțȚ'), 'ß', 'SS')), '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g') c, count(*) n FROM m GROUP BY 1""")
def clean_words(spark, d):
    """Each word as it is, and between marks with letters that are written as two characters or with a cedilla."""
    w = table(spark, d, "benchmark").select(F.explode(text.words(F.col("text"))).alias("w"))
    marked = F.array("w", F.concat(F.lit("„"), "w", F.lit("s\u0326i.")), F.concat(F.lit("ş"), "w", F.lit("a\u0306}")))
    return w.select(F.explode(marked).alias("w")).groupBy(text.clean_word(F.col("w")).alias("c")).agg(F.count(F.lit(1)).alias("n"))


@query("sentence_ends", r"""WITH w AS (SELECT unnest(string_split_regex(text, '\s+')) w FROM documents), m AS (SELECT unnest([w, w || '}', w || '„', w || '’)]']) w FROM w WHERE w <> '')
    SELECT right(rtrim(w, '"''”„»’)]}'), 1) IN ('.', '?', '!', '…') e, count(*) n FROM m GROUP BY 1""")
def sentence_ends(spark, d):
    w = table(spark, d, "documents").select(F.explode(text.words(F.col("text"))).alias("w"))
    marked = F.array("w", *[F.concat("w", F.lit(mark)) for mark in ("}", "„", "’)]")])
    return w.select(F.explode(marked).alias("w")).groupBy(text.ends_sentence(F.col("w")).alias("e")).agg(F.count(F.lit(1)).alias("n"))


TURN_TOKENS = r"""SELECT conv_id, turn, list_filter(list_transform(string_split_regex(text, '\s+'), lambda x: upper(trim(replace(x, 'ß', 'SS'), '.,;:!?"''()[]'))), lambda x: x <> '') h FROM conversations"""


@query("wer_turns", f"""WITH t AS (SELECT *, lag(h) OVER (PARTITION BY conv_id ORDER BY turn) r FROM ({TURN_TOKENS})),
    x AS (SELECT *, list_reduce(list_transform(range(1, len(r) + 1), lambda i: [i]), lambda held, e: list_reduce(list_transform(range(1, len(h) + 1), lambda j: [j]),
    lambda cells, f: list_append(cells, least(cells[-1] + 1, held[f[1] + 1] + 1, held[f[1]] + (h[f[1]] <> r[e[1]])::INT)), [held[1] + 1]), range(0, len(h) + 1)) row_ FROM t WHERE r IS NOT NULL)
    SELECT t.conv_id, t.turn, CASE WHEN t.r IS NOT NULL THEN CASE WHEN len(t.r) = 0 THEN 0 ELSE round(x.row_[-1] / len(t.r), 4) END END AS wer FROM t LEFT JOIN x ON t.conv_id = x.conv_id AND t.turn = x.turn""")
def wer_turns(spark, d):
    """The error rate of each turn against the one before it in its conversation."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    return b.turns(spark, d).withColumn("before", F.lag("text").over(w)).select("conv_id", "turn", wer(F.col("before"), F.col("text")).alias("wer"))


@query("url_ids", r"""WITH u AS (SELECT page_id, substr(md5(url), 1, 11) x, url FROM pages), a AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN 'https://youtu.be/' || x || '?t=1'
    WHEN 2 THEN 'https://www.youtube.com/watch?v=' || x WHEN 3 THEN x ELSE 'https://youtube.com/embed/' || x END a FROM u)
    SELECT page_id, coalesce(nullif(regexp_extract(a, '(?:youtube\.com/watch\?v=|youtu\.be/|youtube\.com/embed/)([A-Za-z0-9_-]{11})', 1), ''), nullif(regexp_extract(a, '^([A-Za-z0-9_-]{11})$', 1), '')) id FROM a""")
def url_ids(spark, d):
    x = F.substring(F.md5("url"), 1, 11)
    form = F.col("page_id") % 5
    address = F.when(form == 0, F.col("url")).when(form == 1, F.concat(F.lit("https://youtu.be/"), x, F.lit("?t=1"))).when(form == 2, F.concat(F.lit("https://www.youtube.com/watch?v="), x)) \
        .when(form == 3, x).otherwise(F.concat(F.lit("https://youtube.com/embed/"), x))
    return table(spark, d, "pages").select("page_id", text.video_id(address).alias("id"))


@query("json_props", """SELECT event_id, (json_extract_string(props, '$.k'))::BIGINT k FROM events""")
def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.coalesce(F.from_json("props", "map<string,bigint>"), F.create_map().cast("map<string,bigint>"))["k"].alias("k"))


@query("log_kinds", """SELECT CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'purchase' THEN 'success' ELSE 'info' END kind, count(*) n, min(strftime(ts, '%H:%M:%S')) first_ts FROM events GROUP BY 1""")
def log_kinds(spark, d):
    says = F.when(F.col("event_type") == "purchase", "saved").otherwise(F.col("event_type"))
    line = F.concat(F.date_format("ts", "HH:mm:ss"), F.lit(" | INFO | "), says)
    parts = table(spark, d, "events").select(text.log_parts(line).alias("p"))
    return parts.groupBy(text.log_kind(F.col("p.msg")).alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.min("p.ts").alias("first_ts"))


@query("latest_wins", """WITH r AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) n FROM events) SELECT user_id, event_type, value FROM r WHERE n = 1""")
def latest_wins(spark, d):
    return changelog.latest(table(spark, d, "events").select("user_id", "ts", "event_type", "value"), "user_id", "ts").drop("ts")


@query("latest_columns", """SELECT user_id, arg_max(value, ts) FILTER (WHERE event_type = 'purchase') price, arg_max(event_id, ts) FILTER (WHERE event_type = 'view') viewed FROM events GROUP BY 1""")
def latest_columns(spark, d):
    log = table(spark, d, "events").select("user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("price"), F.when(F.col("event_type") == "view", F.col("event_id")).alias("viewed"))
    return changelog.latest_columns(log, "user_id", "ts", ["price", "viewed"])


@query("review_state", """WITH e AS (SELECT user_id, ts, CASE event_type WHEN 'click' THEN 'approve' WHEN 'error' THEN 'reject' WHEN 'signup' THEN 'revert' WHEN 'purchase' THEN 'save' END a, event_id::VARCHAR t FROM events WHERE event_type <> 'view'),
    s AS (SELECT user_id, max(ts) s FROM e WHERE a = 'revert' GROUP BY 1), l AS (SELECT e.* FROM e LEFT JOIN s USING (user_id) WHERE s IS NULL OR ts >= s)
    SELECT user_id, coalesce(CASE arg_max(a, ts) FILTER (WHERE a IN ('approve', 'reject')) WHEN 'approve' THEN 'approved' WHEN 'reject' THEN 'rejected' END, '') status,
    arg_max(t, ts) FILTER (WHERE a = 'save') AS "text", (count(*) FILTER (WHERE a = 'save') > 0)::INT edited FROM l GROUP BY 1""")
def review_state(spark, d):
    action = F.when(F.col("event_type") == "click", "approve").when(F.col("event_type") == "error", "reject").when(F.col("event_type") == "signup", "revert").otherwise("save")
    log = table(spark, d, "events").filter("event_type <> 'view'").select("user_id", "ts", action.alias("action"), F.col("event_id").cast("string").alias("text"))
    return changelog.review_state(log, "user_id", "ts")


@query("reassigned", """WITH r AS (SELECT user_id, ts, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) old FROM events) SELECT user_id, epoch_us(ts) ts, event_type, old FROM r WHERE old <> event_type""")
def reassigned(spark, d):
    log = table(spark, d, "events").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), "event_type")
    return changelog.reassigned(log, "user_id", "ts", "event_type")


@query("upsert_rows", """WITH c AS (SELECT c_custkey k, c_name n, c_acctbal b FROM customer WHERE c_custkey % 4 <> 0), i AS (SELECT c_custkey k, upper(c_name) n, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 1 END b FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 4 = 0)
    SELECT coalesce(c.k, i.k) k, coalesce(i.n, c.n) n, coalesce(i.b, c.b) b FROM c FULL JOIN i ON c.k = i.k""")
def upsert_rows(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("n"), F.col("c_acctbal").alias("b"))
    new = c.filter("k % 3 = 0 OR k % 4 = 0").select("k", F.upper("n").alias("n"), F.when(F.col("k") % 2 == 0, F.col("b") + 1).alias("b"))
    return changelog.upsert(c.filter("k % 4 <> 0"), new, "k", keep=["b"])


@query("curator_import", """WITH c AS (SELECT c_custkey k, c_name n, c_acctbal b FROM customer WHERE c_custkey % 4 <> 0), i AS (SELECT c_custkey k, upper(c_name) n, c_acctbal + 1 b FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 4 = 0)
    SELECT coalesce(c.k, i.k) k, coalesce(i.n, c.n) n, coalesce(c.b, i.b) b FROM c FULL JOIN i ON c.k = i.k""")
def curator_import(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("n"), F.col("c_acctbal").alias("b"))
    return changelog.curator_import(c.filter("k % 4 <> 0"), c.filter("k % 3 = 0 OR k % 4 = 0").select("k", F.upper("n").alias("n"), (F.col("b") + 1).alias("b")), "k", ["n"])


@query("cascade_delete", "SELECT o_orderkey k, 'parent' side FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT l_orderkey, 'child' FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'")
def cascade_delete(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    kept, child = changelog.delete_cascade(o, o.filter("o_orderstatus = 'P'").select("k"), "k", table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")))
    return kept.select("k", F.lit("parent").alias("side")).unionByName(child.select("k", F.lit("child").alias("side")))


@query("stale_jobs", """WITH l AS (SELECT user_id job_id, arg_max(event_type, ts) t, max(ts) s FROM events GROUP BY 1), r AS (SELECT job_id, s, CASE WHEN t = 'view' THEN 'running' WHEN t = 'signup' THEN 'pending' ELSE 'completed' END st FROM l)
    SELECT job_id, CASE WHEN st = 'running' AND s < TIMESTAMP '2024-01-29 00:00:00' - INTERVAL 60 SECOND THEN 'interrupted' ELSE st END status FROM r""")
def stale_jobs(spark, d):
    status = F.when(F.col("event_type") == "view", "running").when(F.col("event_type") == "signup", "pending").otherwise("completed")
    log = table(spark, d, "events").select(F.col("user_id").alias("job_id"), F.col("ts").alias("at"), status.alias("status"))
    return changelog.job_states(log, "2024-01-29 00:00:00", 60)


@query("content_hash", """WITH a AS (SELECT source, doc_id // 1024 k, sha256(string_agg(sha256(text), chr(10) ORDER BY doc_id)) h FROM documents GROUP BY 1, 2),
    b AS (SELECT source, k // 1024 k, sha256(string_agg(h, chr(10) ORDER BY a.k)) h FROM a GROUP BY 1, 2),
    c AS (SELECT source, k // 1024 k, sha256(string_agg(h, chr(10) ORDER BY b.k)) h FROM b GROUP BY 1, 2) SELECT source, sha256(string_agg(h, chr(10) ORDER BY k)) h FROM c GROUP BY 1""")
def content_hash(spark, d):
    each = table(spark, d, "documents").select("source", F.col("doc_id").alias("id"), F.sha2("text", 256).alias("h"))
    return stats.tree_hash(each, "source", "id", "h")


@query("tracker_greedy")
def tracker_greedy(spark, d):
    e = events(spark, d)
    frame = (F.floor(F.col("at") / 7200) % 400).cast("int")
    boxes = e.select("user_id", frame.alias("frame"), (F.col("event_id") % 1000000).cast("int").alias("det"), (F.col("value") % 50).alias("x"), (F.col("value") % 30).alias("y"), F.lit(40.0).alias("w"), F.lit(40.0).alias("h"))
    return tracks.track_boxes(boxes, "user_id")


@query("one_euro", f"""WITH RECURSIVE e AS (SELECT user_id, tm, value v, row_number() OVER (PARTITION BY user_id ORDER BY tm) i FROM ({EV})),
    o AS (SELECT user_id, tm, i, v AS y, 0::DOUBLE AS s FROM e WHERE i = 1 UNION ALL
    SELECT user_id, tm, i, y + (v - y) / (1 + 25 / (2 * pi() * (1 + 0.3::DOUBLE * abs(s)))), s FROM (SELECT e.user_id, e.tm, e.i, e.v, o.y, o.s + ((e.v - o.y) * 25 - o.s) / (1 + 25 / (2 * pi())) AS s
    FROM o JOIN e ON e.user_id = o.user_id AND e.i = o.i + 1)) SELECT user_id, tm AS moment, round(y, 6) AS smoothed FROM o""")
def one_euro(spark, d):
    return tracks.smooth(events(spark, d), "user_id", "at", "value").select("user_id", F.col("at").alias("moment"), F.round("smoothed", 6).alias("smoothed"))


def kernel_sql(sigma):
    """(o, k): offsets and weights of a Gaussian."""
    reach = int(4 * sigma + 0.5)
    return f"SELECT o, exp(-0.5::DOUBLE * (o / {sigma}::DOUBLE) ^ 2) / sum(exp(-0.5::DOUBLE * (o / {sigma}::DOUBLE) ^ 2)) OVER () AS k FROM range({-reach}, {reach + 1}) t(o)"


@query("gaussian_smooth", f"""WITH e AS (SELECT user_id, event_id, value v, row_number() OVER (PARTITION BY user_id ORDER BY tm) - 1 i, count(*) OVER (PARTITION BY user_id) n FROM ({EV})), k AS ({kernel_sql(2.5)}),
    j AS (SELECT user_id, event_id, k, (i + o + 8 * n) % (2 * n) AS m, n FROM e, k) SELECT j.user_id, j.event_id, round(sum(k * e.v), 6) AS smoothed FROM j JOIN e ON e.user_id = j.user_id AND e.i = CASE WHEN m < j.n THEN m ELSE 2 * j.n - 1 - m END GROUP BY 1, 2""")
def gaussian_smooth(spark, d):
    e = events(spark, d)
    out = tracks.smooth(e, "user_id", "at", "value", "gaussian", sigma=2.5)
    return e.select("event_id", "user_id", "at").join(out.drop("value"), ["user_id", "at"]).select("user_id", "event_id", F.round("smoothed", 6).alias("smoothed"))


@query("hold_edges", f"""WITH e AS (SELECT *, CASE WHEN event_type IN ('purchase', 'view') THEN value END v FROM ({EV})),
    n AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN tm END IGNORE NULLS) OVER b ax, last_value(v IGNORE NULLS) OVER b ay,
    first_value(CASE WHEN v IS NOT NULL THEN tm END IGNORE NULLS) OVER f bx, first_value(v IGNORE NULLS) OVER f by_ FROM e
    WINDOW b AS (PARTITION BY user_id ORDER BY tm ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY user_id ORDER BY tm ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT event_id, round(CASE WHEN v IS NOT NULL THEN v WHEN ay IS NULL OR by_ IS NULL THEN coalesce(ay, by_) ELSE ay + (by_ - ay) * (tm - ax) / (bx - ax) END, 6) v FROM n""")
def hold_edges(spark, d):
    rows = events(spark, d).withColumn("v", F.when(F.col("event_type").isin("purchase", "view"), F.col("value")))
    return ordered.interpolate(rows, ["user_id"], "at", "v", hold_edges=True).select("event_id", F.round("v", 6).alias("v"))


@query("active_speaker", """WITH c AS (SELECT l_orderkey k, l_linenumber t, l_quantity - 10 o, l_discount a, l_extendedprice z FROM lineitem),
    r AS (SELECT k, t, o * a * z s, row_number() OVER (PARTITION BY k ORDER BY o * a * z DESC, t) n FROM c WHERE o * a * z > 0) SELECT k, t track, round(s, 4) score FROM r WHERE n = 1""")
def active_speaker(spark, d):
    c = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("track"), (F.col("l_quantity") - 10).alias("overlap"), F.col("l_discount").alias("asd"), F.col("l_extendedprice").alias("size"))
    return tracks.winner(c, "k").select("k", "track", F.round("score", 4).alias("score"))
