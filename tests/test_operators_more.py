import math
import random
from itertools import pairwise

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import wer
from tallyloom.operators import changelog, joins, media, queues, stats, tracks
from tallyloom.plans import serving


def test_kalman_goes_on_where_a_piece_ended():
    r = np.random.default_rng(1)
    boxes = np.cumsum(r.normal(size=(60, 4)), 0) + 50
    boxes[[7, 8, 20]] = np.nan
    whole = tracks.kalman(boxes, 0.03, 0.1)
    state, parts = None, []
    for a, b in pairwise((0, 1, 9, 21, 60)):
        out, state = tracks.kalman_piece(boxes[a:b], state, 0.03, 0.1)
        parts.append(out)
    assert np.allclose(np.concatenate(parts), whole) and np.array_equal(whole[0], boxes[0])
    still = tracks.kalman(np.array([[1.0, 2, 3, 4]] * 5), 0.03, 0.1)
    assert np.allclose(still, [1, 2, 3, 4])


def test_boxes_are_filled_between_first_and_last(spark):
    rows = [("a", 3, 10, 10, 4, 4), ("a", 7, 18, 10, 4, 4), ("b", 0, 1, 1, 2, 2)]
    got = tracks.smooth_boxes(spark.createDataFrame(rows, "k string, frame int, x int, y int, w int, h int"), "k").orderBy("k", "frame").collect()
    assert [(r.k, r.frame) for r in got] == [("a", f) for f in range(3, 8)] + [("b", 0)]
    assert (got[0].x, got[0].y, got[0].w) == (10, 10, 4) and got[4].x > got[0].x


def test_filters_and_tracks_in_pieces(spark):
    """Batches of a few rows give what one batch gives."""
    r = random.Random(4)
    rows = [(k, f, i, 10.0 * i + r.random(), 5.0, 8.0, 8.0) for k in ("a", None, "b") for f in range(40) for i in range(r.randint(0, 3))]
    boxes = spark.createDataFrame(rows, "k string, frame int, det int, x double, y double, w double, h double")
    values = boxes.select("k", (F.col("frame") * 10 + F.col("det")).alias("at"), "x")
    got = {}
    for size in ("10000", "3"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        got[size] = [sorted(map(str, df.collect())) for df in (tracks.track_boxes(boxes, "k"), tracks.smooth(values, "k", "at", "x"))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert got["3"] == got["10000"] and len(got["3"][0]) > 50 and len(got["3"][1]) == len(rows)


def test_gaussian_window_is_the_filter(spark):
    r = np.random.default_rng(3)
    values = {k: r.normal(size=n) for k, n in (("a", 1), ("b", 5), ("c", 60))}
    rows = [(k, i, float(x)) for k, v in values.items() for i, x in enumerate(v)]
    got = tracks.smooth(spark.createDataFrame(rows, "k string, at int, x double"), "k", "at", "x", "gaussian", sigma=1.7).toPandas()
    for k, v in values.items():
        want = tracks.gaussian(v, 1.7)
        assert np.allclose(got[got.k == k].sort_values("at").smoothed, want)


def test_order_statistics(spark):
    r = random.Random(9)
    values = [round(r.gauss(0, 50), 2) for _ in range(3000)] + [7.0] * 500 + [float("nan"), None, -1e12, 1e12]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    known = sorted(v for v in values if v is not None and not math.isnan(v))
    n, found = stats.order_statistics(df, ["v"], lambda n: [0, 1, n // 3, n // 2, n - 2, n - 1])["v"]
    assert n == len(known) and found == {k: known[k] for k in found} and len(found) == 6
    q = stats.quantiles(df, "v").first()
    assert [q.p25, q.median, q.p75, q.p95] == [round(float(np.quantile(known, p)), 2) for p in (0.25, 0.5, 0.75, 0.95)]
    assert stats.quantiles(df.filter("false"), "v").first().median is None


WIDE = {
    "infinite": [1.0, 2.0, math.inf], "both ends": [-math.inf, 3.0, math.inf, -math.inf], "widest": [1.0, -1e308, 1e308], "subnormal": [5e-324, 1e-310, -1e-320, 2.2250738585072014e-308, 0.0, -0.0],
    "equal": [7.25] * 50, "powers": [2.0**e * f for e in range(-1074, 1024, 7) for f in (1, 1.9999999999999998, -1)], "neighbours": [1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0), math.nextafter(1024.0, 0)],
    "one": [3.5], "none": [None, math.nan],
}


@pytest.mark.parametrize("name", WIDE)
def test_order_statistics_end_on_any_doubles(spark, name):
    values = WIDE[name]
    df = spark.createDataFrame([(v, 1.0) for v in values], "v double, w double")
    known = sorted(v for v in values if v is not None and not math.isnan(v))
    told = stats.order_statistics(df, ["v", "w"], lambda n: range(n))
    assert told["v"] == (len(known), dict(enumerate(known))) and told["w"][1] == dict.fromkeys(range(len(values)), 1.0)
    keyed = stats.with_order_key(df.filter("v IS NOT NULL AND NOT isnan(v)"), "v", "k")
    back = keyed.select("v", "k", stats.key_value(F.col("k")).alias("b")).orderBy("v").collect()
    assert keyed.columns == ["v", "w", "k"] and all(r.v == r.b for r in back) and [r.k for r in back] == sorted(r.k for r in back)
    q = stats.quantiles(df, "v", digits=300).first()
    if known and math.isfinite(known[0]) and math.isfinite(known[-1]) and name not in ("widest", "subnormal"):
        assert [q.p25, q.median, q.p75, q.p95] == pytest.approx([float(np.quantile(known, p)) for p in (0.25, 0.5, 0.75, 0.95)], rel=1e-12, abs=1e-320)


def test_grouped_quantiles(spark):
    r = random.Random(3)
    rows = [(r.choice(["a", "b", None]), r.choice([1, 2]), r.choice([r.gauss(0, 5), float(r.randrange(5)), None, math.nan])) for _ in range(900)]
    rows += [("wide", 1, v) for v in (math.inf, 1.0, -1e308, 5e-324)] + [("none", 1, None), ("one", 1, 4.5)]
    df = spark.createDataFrame(rows, "k string, j int, v double")
    got = {(x.k, x.j): x for x in stats.grouped_quantiles(df, ["k", "j"], "v", digits=9).collect()}
    held: dict = {}
    for k, j, v in rows:
        held.setdefault((k, j), []).extend([v] if v is not None and not math.isnan(v) else [])
    assert set(got) == set(held)
    for key, values in held.items():
        x, finite = got[key], all(map(math.isfinite, values))
        assert x.n == len(values)
        if not values:
            assert x.median is None
        elif finite:
            assert [x.p25, x.median, x.p75, x.p95] == pytest.approx([float(np.quantile(values, p)) for p in (0.25, 0.5, 0.75, 0.95)], abs=1e-8)
    assert got["wide", 1].p95 == math.inf
    assert stats.grouped_quantiles(df.filter("false"), ["k"], "v").count() == 0


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_nearest_known_by_broadcast_and_by_blocks(spark, monkeypatch, limit):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(joins, "BLOCK", 7)
    r = np.random.default_rng(5)
    known, asked = r.normal(size=(40, 8)), r.normal(size=(30, 8))
    known[11] = known[3]
    asked[0] = known[3]
    k = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(known)], "k_id long, k_vec array<float>")
    q = spark.createDataFrame([*[(i, v.tolist()) for i, v in enumerate(asked)], (99, None), (98, [0.0] * 8)], "id long, vec array<float>")
    got = {x.id: (x.k_id, x.cosine) for x in joins.nearest_known(q, k, 0.4).collect()}
    unit = lambda m: (m := m.astype(np.float32).astype(float)) / np.linalg.norm(m, axis=1, keepdims=True)
    cosine = unit(asked) @ unit(known).T
    assert len(got) == 32 and got[99] == got[98] == (None, None) and got[0][0] == 3
    for i in range(30):
        best = round(cosine[i].max(), 9)
        assert got[i] == (None, None) if best < 0.4 else got[i][0] == int(cosine[i].round(9).argmax()) and math.isclose(got[i][1], best, abs_tol=1e-8)
    assert joins.nearest_known(q, k.filter("false"), 0.4).filter("k_id IS NOT NULL").count() == 0


def test_cosine_links_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(joins, "BLOCK", 4)
    r = np.random.default_rng(6)
    rows = [(i % 2, i, r.normal(size=4)) for i in range(41)]
    got = {(x.k, x.a, x.b) for x in joins.cosine_links(spark.createDataFrame([(k, i, v.tolist()) for k, i, v in rows], "k int, id long, vec array<double>"), "k", 0.5).collect()}
    cos = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    assert got == {(k, i, j) for k, i, v in rows for q, j, w in rows if k == q and i < j and cos(v, w) >= 0.5} and got


def clustered(n, seed, spread=0.08, dims=8, clusters=9):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, dims))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    return centres[r.integers(0, clusters, n)] + r.normal(size=(n, dims)) * spread


@pytest.mark.parametrize("least", [0.9, 0.6, 0.0])
def test_metric_cells_lose_no_link(spark, monkeypatch, least):
    monkeypatch.setattr(joins, "BLOCK", 16)
    n = 300
    rows = [(i % 2, i, v.tolist()) for i, v in enumerate(clustered(n, 3))] + [(0, 900, [0.0] * 8), (1, 901, None), (7, 902, [1.0] * 8)]
    df = spark.createDataFrame(rows, "k int, id long, vec array<double>")
    unit = np.array([np.array(v) / max(np.linalg.norm(v), 1e-300) if v else np.zeros(8) for _, _, v in rows])
    cos, key, known = unit @ unit.T, [r[0] for r in rows], [r[2] is not None for r in rows]
    want = {(key[i], rows[i][1], rows[j][1]) for i in range(len(rows)) for j in range(i + 1, len(rows)) if key[i] == key[j] and known[i] and known[j] and cos[i, j] >= least and abs(cos[i, j] - least) > 1e-12}
    got = {(x.k, x.a, x.b) for x in joins.cosine_links(df, "k", least).collect()}
    assert {g for g in got if 900 not in g or least > 0} == {w for w in want if 900 not in w or least > 0} and got
    if least == 0.9:
        compared = joins.metric_cells(df, "k", least)[1].agg(F.sum(F.col("n") * F.col("n2"))).first()[0]
        assert compared < 0.35 * 2 * 150 * 151 / 2, compared


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_nearest_known_leaves_cells_out(spark, monkeypatch, limit):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    known, asked = clustered(600, 4), np.concatenate([clustered(600, 4)[:40], np.random.default_rng(1).normal(size=(20, 8))])
    k = spark.createDataFrame([(f"k{i:03d}", v.tolist()) for i, v in enumerate(known)], "k_id string, k_vec array<double>")
    q = spark.createDataFrame([*[(i, v.tolist()) for i, v in enumerate(asked)], (98, [0.0] * 8)], "id long, vec array<double>")
    for least in (0.7, -1.0):
        got = {x.id: x for x in joins.nearest_known(q, k, least, with_products=True).collect()}
        unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
        cosine = unit(asked) @ unit(known).T
        assert len(got) == 61 and got[98].k_id == (None if least > 0 else "k000")
        for i in range(60):
            best = cosine[i].max()
            assert (got[i].k_id is None) if best < least else (got[i].k_id == f"k{cosine[i].round(11).argmax():03d}" and abs(got[i].cosine - best) < 1e-9)
        if least > 0:
            assert sum(x.products for x in got.values()) < 0.6 * 61 * 600


def lcs(a, b):
    if not a or not b:
        return 0
    return lcs(a[:-1], b[:-1]) + 1 if a[-1] == b[-1] else max(lcs(a[:-1], b), lcs(a, b[:-1]))


def test_word_changes(spark):
    r = random.Random(2)
    rows = [(" ".join(r.choices("abC", k=r.randint(0, 6))), " ".join(r.choices("Abc", k=r.randint(0, 6)))) for _ in range(40)] + [(None, "a b"), ("a", None)]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", wer.word_changes(F.col("a"), F.col("b")).alias("x")).collect()
    for row in got:
        assert [w.word for w in row.x] == (row.b or "").split()
        assert sum(w.type == "same" for w in row.x) == lcs((row.a or "").lower().split(), (row.b or "").lower().split())


def test_mouth_follows_the_nearest_landmarks(spark):
    rows = [("a", 0, None, None), ("a", 1, 10.0, 30.0), ("a", 2, None, None), ("a", 3, None, None), ("a", 4, 20.0, 60.0), ("a", 5, None, None)]
    df = spark.createDataFrame([(k, f, x, x, w, 0.0) for k, f, x, w in rows], "clip string, frame int, cx double, cy double, width double, roll double")
    near = [r.cx for r in media.nearest_landmarks(df).orderBy("frame").collect()]
    assert near == [10, 10, 10, 20, 20, 20]
    got = media.widest_mouth_trajectory(df, sigma=0.1).orderBy("frame").collect()
    assert [r.x for r in got] == [10, 10, 10, 20, 20, 20] and {r.half for r in got} == {54}


def test_queue_that_starts_at_an_unknown_video(spark):
    v = spark.createDataFrame([(i, "c", None if i % 2 else "x") for i in range(6)], "video_id int, channel string, env string")
    ids = lambda start: sorted(r.video_id for r in queues.tagging_queue(v, "video_id", ["env"], "c", start).collect())
    assert ids(3) == [3, 5] and ids(2) == ids(None) == [1, 3, 5]


def test_payloads_of_nothing(spark):
    empty = spark.createDataFrame([], "segment_id long, video_id string, region string, text string, num_chars long, duration double, num_words int, review_status string, transcript_edited int, trimmed int, wer double, wer_dialect double, asd_score double, syncnet_conf double, whisper_conf double, whisper_conf_min double, quality_tier string, speaker_id string")
    totals = {r.key: r.n for r in serving.segment_payload(empty).filter("part = 'totals' AND n IS NOT NULL").collect()}
    assert totals["total"] == 0 and totals["approved"] == 0
    assert serving.explorer_strip(empty).first().mean_s == 0
    json = serving.as_json(spark.createDataFrame([("p", "a", 1, None), ("p", "b", None, 2.5)], "part string, key string, n long, value double")).first().json
    assert json == '{"a":{"n":1},"b":{"value":2.5}}'


def test_corrections_and_drops(spark):
    p = spark.createDataFrame([("a:b", None)], "id string, env string")
    done, missing = changelog.corrections(p, spark.createDataFrame([("x:Studio",), ("bad",), ("y:cave",)], "value string"), "id", "env", ("studio",))
    assert done.first().env is None and [r.id for r in missing.collect()] == ["x"]
    assert pd.isna(stats.quantiles(p.select(F.lit(None).cast("double").alias("v")), "v").toPandas()).all(axis=None)


def test_places_by_ranges(spark):
    r = random.Random(2)
    rows = [(i, r.choice([None, 1.5, 2.5, r.random()])) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v double").repartition(5)
    order = [F.col("v").desc_nulls_last(), F.col("id")]
    want = {i: k + 1 for k, (i, _) in enumerate(sorted(rows, key=lambda x: (x[1] is None, -(x[1] or 0), x[0])))}
    got = queues.numbered(df, order)
    assert got.columns == ["id", "v", "pos"] and {x.id: x.pos for x in got.collect()} == want
    assert queues.numbered(df.filter("false"), order).count() == 0


def test_admissions_one_job_at_a_time(spark):
    r = random.Random(8)
    rows = [(q, i, r.choice(["request", "request", "end"]), r.choice([*changelog.JOB_TYPES, "other", None])) for q in range(3) for i in range(60)]
    want = {}
    for q in range(3):
        active, last = None, 0
        for _, i, kind, job in [x for x in rows if x[0] == q]:
            if kind == "end":
                active = None
            elif job not in changelog.JOB_TYPES:
                want[q, i] = (400, None)
            elif active is not None:
                want[q, i] = (409, active)
            else:
                last += 1
                active = last
                want[q, i] = (201, active)
    df = spark.createDataFrame(rows, "q int, i int, kind string, type string").repartition(3)
    got = {(x.q, x.i): (x.answer, x.job_id) for x in changelog.admissions(df, "q", "i", "kind", "type").collect()}
    assert got == want
