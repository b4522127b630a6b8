"""Queries of event-time windows, streams, and plain relational coverage."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.operators import joins
from tallyloom.plans import binding as b
from tallyloom.registry import query
from tallyloom.session import fresh_path, table
from tallyloom.streaming import streams


def micros(c):
    return F.unix_micros(F.col(c).cast("timestamp"))


def events(spark, d):
    return table(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp"))


@query("tumbling_windows", "SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start, event_type, count(*) n, sum(CAST(value AS DECIMAL(20,6)))::DOUBLE total FROM events GROUP BY 1, 2")
def tumbling_windows(spark, d):
    return streams.tumbling(events(spark, d), "at", "1 hour", "event_type").select(micros("start").alias("start"), "event_type", "n", F.col("total").cast("double").alias("total"))


@query("sliding_windows", """WITH x AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS b, value FROM events), y AS (SELECT b - INTERVAL 30 MINUTE AS s, value FROM x UNION ALL SELECT b, value FROM x)
    SELECT epoch_us(s) AS start, count(*) n, sum(CAST(value AS DECIMAL(20,6)))::DOUBLE total FROM y GROUP BY 1""")
def sliding_windows(spark, d):
    return streams.tumbling(events(spark, d), "at", "1 hour", slide="30 minutes").select(micros("start").alias("start"), "n", F.col("total").cast("double").alias("total"))


@query("session_windows", """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    i AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM g) SELECT user_id, epoch_us(min(ts)) AS start, epoch_us(max(ts) + INTERVAL 6 HOUR) AS stop, count(*) n FROM i GROUP BY user_id, g""")
def session_windows(spark, d):
    return streams.sessions(events(spark, d), "at", "6 hours", "user_id").select("user_id", micros("start").alias("start"), micros("end").alias("stop"), "n")


@query("stream_windows", "SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start, event_type, count(*) n, sum(CAST(value AS DECIMAL(20,6)))::DOUBLE total FROM events GROUP BY 1, 2")
def stream_windows(spark, d):
    """The tumbling windows, by a stream in complete mode."""
    s = streams.source(spark, f"{d}/events.parquet").withColumn("at", F.col("ts").cast("timestamp"))
    out = streams.drained(streams.tumbling(s, "at", "1 hour", "event_type"), fresh_path(spark, "windows"), "complete")
    return out.select(micros("start").alias("start"), "event_type", "n", F.col("total").cast("double").alias("total"))


@query("stream_dedup", "SELECT count(*) n, count(DISTINCT user_id) users FROM (SELECT DISTINCT user_id, event_type FROM events)")
def stream_dedup(spark, d):
    """The first row of each user and event type, by a stream whose watermark outlasts the data."""
    s = streams.source(spark, f"{d}/events.parquet").withColumn("at", F.col("ts").cast("timestamp"))
    out = streams.drained(streams.once(s, "at", "60 days", "user_id", "event_type").select("user_id", "event_type"), fresh_path(spark, "once"))
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


@query("stream_jobs", """WITH e AS (SELECT user_id AS job_id, ts, CASE WHEN event_type = 'view' THEN 'running' ELSE 'completed' END st FROM events), c AS (SELECT *, coalesce(lag(st) OVER (PARTITION BY job_id ORDER BY ts), '') <> st AS n FROM e),
    l AS (SELECT job_id, arg_max(st, ts) AS status, max(ts) AS seen, count(*) FILTER (WHERE n) AS changes FROM c GROUP BY 1)
    SELECT job_id, status, epoch_us(seen) AS seen, changes::INT AS changes FROM l UNION ALL SELECT job_id, 'interrupted', epoch_us(seen), changes::INT + 1 FROM l, (SELECT max(ts) AS m FROM events) WHERE status = 'running' AND seen + INTERVAL 60 SECOND <= m - INTERVAL 60 SECOND""")
def stream_jobs(spark, d):
    """Job states by keyed state with a timeout: every job as it stands, and again those that fell silent."""
    s = streams.source(spark, f"{d}/events.parquet").select(F.col("user_id").alias("job_id"), F.col("ts").cast("timestamp").alias("at"), F.when(F.col("event_type") == "view", "running").otherwise("completed").alias("status"))
    return streams.drained(streams.job_states(s), fresh_path(spark, "jobs")).select("job_id", "status", micros("seen").alias("seen"), "changes")


@query("log_state", """WITH e AS (SELECT user_id, event_id, event_type t, CASE WHEN event_type = 'signup' THEN 'v' || (event_id % 20) END v, CASE event_type WHEN 'click' THEN 'vad' WHEN 'purchase' THEN 'face' END g FROM events)
    SELECT user_id, count(DISTINCT v) AS videos, arg_max(v, event_id) FILTER (WHERE v IS NOT NULL) AS current_video, CASE WHEN max(event_id) FILTER (WHERE g IS NOT NULL) >= coalesce(max(event_id) FILTER (WHERE v IS NOT NULL), -1)
    THEN arg_max(g, event_id) FILTER (WHERE g IS NOT NULL) END AS stage, coalesce(arg_max(event_id % 9 + 1, event_id) FILTER (WHERE v IS NOT NULL), 0)::INT AS "position", CASE WHEN count(v) > 0 THEN 9 ELSE 0 END AS total,
    count(*) FILTER (WHERE t = 'error') AS errors FROM e GROUP BY 1""")
def log_state(spark, d):
    e = table(spark, d, "events")
    msg = F.when(F.col("event_type") == "signup", F.concat(F.lit("Processing video "), (F.col("event_id") % 9 + 1).cast("string"), F.lit("/9: v"), (F.col("event_id") % 20).cast("string"))) \
        .when(F.col("event_type") == "click", "Step 2: splitting").when(F.col("event_type") == "purchase", "Step 3: faces").when(F.col("event_type") == "error", "error: no face").otherwise("frame done")
    return streams.log_state(e.select("user_id", "event_id", msg.alias("msg")), "user_id", "event_id")


@query("pricing_summary", """SELECT l_returnflag, l_linestatus, sum(CAST(l_quantity AS DECIMAL(20,6)))::DOUBLE sum_qty, sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(20,6)))::DOUBLE sum_disc,
    count(*) n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(spark, d):
    s = lambda c: F.sum(c.cast("decimal(20,6)")).cast("double")
    return table(spark, d, "lineitem").filter("l_shipdate <= timestamp_ntz'1998-09-02'").groupBy("l_returnflag", "l_linestatus").agg(
        s(F.col("l_quantity")).alias("sum_qty"), s(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("sum_disc"), F.count(F.lit(1)).alias("n"))


@query("star_join", """SELECT r_name, year(o_orderdate)::INT y, sum(CAST(l_extendedprice AS DECIMAL(20,6)))::DOUBLE revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def star_join(spark, d):
    t = lambda n: table(spark, d, n)
    joined = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")) \
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name", F.year("o_orderdate").alias("y")).agg(F.sum(F.col("l_extendedprice").cast("decimal(20,6)")).cast("double").alias("revenue"))


@query("semi_anti", """SELECT c_mktsegment, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')) AS with_pending,
    count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS without_orders FROM customer GROUP BY 1""")
def semi_anti(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    a = c.join(o.filter("o_orderstatus = 'P'"), "c_custkey", "left_semi").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("with_pending"))
    n = c.join(o, "c_custkey", "left_anti").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("without_orders"))
    return c.select("c_mktsegment").distinct().join(a, "c_mktsegment", "left").join(n, "c_mktsegment", "left").na.fill(0)


@query("grouping_sets", "SELECT l_returnflag, l_linestatus, count(*) n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")
def grouping_sets(spark, d):
    sets = [["l_returnflag"], ["l_linestatus"], []]
    return table(spark, d, "lineitem").groupingSets([[F.col(c) for c in s] for s in sets], F.col("l_returnflag"), F.col("l_linestatus")).agg(F.count(F.lit(1)).alias("n"))


@query("rankings", """SELECT o_orderkey, rank() OVER w r, dense_rank() OVER w dr, row_number() OVER w rn, ntile(4) OVER w nt, lag(o_totalprice) OVER w before, lead(o_totalprice) OVER w after
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def rankings(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    c = lambda f, n: f.over(w).alias(n)
    return table(spark, d, "orders").select("o_orderkey", c(F.rank(), "r"), c(F.dense_rank(), "dr"), c(F.row_number(), "rn"), c(F.ntile(4), "nt"), c(F.lag("o_totalprice"), "before"), c(F.lead("o_totalprice"), "after"))


@query("range_frames", """SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) n FROM events""")
def range_frames(spark, d):
    w = Window.partitionBy("user_id").orderBy("us").rangeBetween(-86400000000, 0)
    return table(spark, d, "events").withColumn("us", micros("ts")).select("event_id", F.count(F.lit(1)).over(w).alias("n"))


@query("set_ops", """SELECT 'intersect' op, count(*) n FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
    UNION ALL SELECT 'except', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)
    UNION ALL SELECT 'except_all', count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
    UNION ALL SELECT 'union', count(*) FROM (SELECT o_custkey FROM orders UNION SELECT c_custkey FROM customer)""")
def set_ops(spark, d):
    o = table(spark, d, "orders")
    f, p, k = o.filter("o_orderstatus = 'F'").select("o_custkey"), o.filter("o_orderstatus = 'O'").select("o_custkey"), table(spark, d, "customer").select("c_custkey")
    each = {"intersect": f.intersect(p), "except": k.subtract(o.select("o_custkey")), "except_all": f.exceptAll(p), "union": o.select("o_custkey").union(k).distinct()}
    out = None
    for name, rows in each.items():
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("op"), "n")
        out = one if out is None else out.unionAll(one)
    return out


@query("union_align", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS kind, NULL::VARCHAR AS brand FROM customer UNION ALL SELECT p_partkey, p_name, NULL, p_brand FROM part")
def union_align(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("kind"))
    return c.unionByName(table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand")), allowMissingColumns=True)


@query("pivot", "SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') f, count(*) FILTER (WHERE l_linestatus = 'O') o FROM lineitem GROUP BY 1")
def pivot(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).count().na.fill(0).select("l_returnflag", F.col("F").alias("f"), F.col("O").alias("o"))


@query("unpivot", "SELECT p_partkey, 'brand' AS kind, p_brand AS value FROM part UNION ALL SELECT p_partkey, 'type', p_type FROM part")
def unpivot(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_type").alias("type"))
    return p.unpivot("p_partkey", ["brand", "type"], "kind", "value")


@query("as_of", """SELECT a.event_id, b.value AS price FROM (SELECT * FROM events WHERE event_type = 'click') a ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') b ON a.user_id = b.user_id AND a.ts >= b.ts""")
def as_of(spark, d):
    e = table(spark, d, "events")
    right = e.filter("event_type = 'purchase'").select("user_id", "ts", F.col("value").alias("price"))
    return joins.as_of(e.filter("event_type = 'click'").select("event_id", "user_id", "ts"), right, "user_id", "ts", "price").select("event_id", "price")


@query("approx_distinct")
def approx_distinct(spark, d):
    return b.segments(spark, d).groupBy("tier").agg(F.approx_count_distinct("video_id").alias("videos"))
