import math
import random

import numpy as np
from pyspark.sql import functions as F

from tallyloom.operators import identity, joins, ordered, tracks

WORDS = "video string, i int, start double, end double, raw string, clean string, speaker string"


def stream(spark, words):
    return spark.createDataFrame([("v", i, *w[:2], w[2], w[2].strip(".").upper(), w[3] if len(w) > 3 else None) for i, w in enumerate(words)], WORDS)


def windows(spark, words, **limits):
    return ordered.sentence_windows(stream(spark, words), "video", ["i"], ordered.Segmentation(**limits)).orderBy("window").collect()


def test_two_sentences_and_merge(spark):
    got = windows(spark, [(0.0, 1.2, "azi"), (1.2, 2.4, "plouă."), (2.6, 3.8, "mâine"), (3.8, 5.0, "ninge.")])
    assert [g.text for g in got] == ["AZI PLOUĂ", "MÂINE NINGE"] and got[0].end_type == "punctuation"
    assert got[0].end <= got[1].start
    merged = windows(spark, [(0.0, 0.4, "da."), (0.5, 0.9, "sigur."), (1.0, 1.6, "mergem.")])
    assert len(merged) == 1 and merged[0].text == "DA SIGUR MERGEM"


def test_speaker_change_and_split(spark):
    got = windows(spark, [(0.0, 1.5, "unu", "S0"), (1.5, 3.0, "doi", "S0"), (3.0, 5.0, "trei", "S1")])
    assert [(g.voice, g.end_type) for g in got] == [("S0", "speaker_change"), ("S1", "media")]
    long = [(i * 1.0, i * 1.0 + (0.6 if i == 4 else 0.9), f"w{i}") for i in range(10)]
    cut = windows(spark, long, hard_max=6.0)
    assert [g.n_words for g in cut] == [5, 5] and cut[0].end_type == "word_gap"


def test_overlaps(spark):
    words = spark.createDataFrame([("v", 1, 1.8, 2.6), ("v", 2, 9.0, 9.5)], "video string, word_id int, start double, end double")
    turns = spark.createDataFrame([("v", 0, 0.0, 2.0, "S0"), ("v", 1, 2.0, 5.0, "S1")], "video string, turn_no int, r_start double, r_end double, label string")
    assert {r.word_id: r.label for r in joins.widest_overlap(words, turns, ["video"], 1.0).collect()} == {1: "S1", 2: None}
    regions = spark.createDataFrame([("v", 9.8, 12.0)], "video string, r_start double, r_end double")
    assert [r.word_id for r in joins.inside_regions(words, regions, ["video"]).collect()] == [2]


def test_iou_and_tracks(spark):
    box = F.struct(*[F.lit(float(v)).alias(n) for n, v in zip("xywh", (0, 0, 100, 100))])
    other = lambda x: F.struct(*[F.lit(float(v)).alias(n) for n, v in zip("xywh", (x, 0, 100, 100))])
    row = spark.range(1).select(joins.iou(box, other(50)).alias("a"), joins.iou(box, other(100)).alias("b")).first()
    assert abs(row.a - 1 / 3) < 1e-9 and row.b == 0
    rows = [("c", f, d, 5.0 * f + 300 * d, 0.0, 100.0, 100.0) for f in range(3) for d in range(2)] + [("c", 1, 9, 900.0, 900.0, 10.0, 10.0)]
    got = tracks.track_boxes(spark.createDataFrame(rows, "clip string, frame int, det int, x double, y double, w double, h double"), "clip").collect()
    assert len(got) == 6 and len({r.track for r in got}) == 2


def test_fill_and_smooth(spark):
    rows = spark.createDataFrame([("t", 0, 1.0), ("t", 1, math.nan), ("t", 2, None), ("t", 3, 4.0), ("t", 4, None)], "k string, f int, v double")
    held = [r.v for r in ordered.interpolate(rows, ["k"], "f", "v", hold_edges=True).orderBy("f").collect()]
    assert held == [1.0, 2.0, 3.0, 4.0, 4.0]
    assert ordered.interpolate(rows, ["k"], "f", "v").orderBy("f").collect()[4].v is None
    assert np.allclose(tracks.one_euro(np.full(5, 3.0)), 3.0) and np.allclose(tracks.gaussian(np.full(9, 2.0), 1.5), 2.0)
    boxes = np.array([[float(i), 0, 10, 10] for i in range(30)])
    assert abs(tracks.kalman(boxes, 0.01, 0.1)[-1, 0] - 29) < 0.5


def test_coverage_renumber_trim(spark):
    spans = spark.createDataFrame([("a", 0, 4), ("a", 3, 6), ("a", 9, 9)], "k string, start int, end int")
    assert ordered.coverage(spans, ["k"]).first().coverage == 0.8
    rows = spark.createDataFrame([("md", 3, 3), ("md", 10, 3), ("ro", 2, 2)], "p string, n long, w int")
    assert [r.new_id for r in ordered.renumber(rows, "p", "n", "w").orderBy("p", "n").collect()] == ["md_001", "md_002", "ro_01"]
    w = spark.sql("SELECT array(named_struct('word','BUNA','start',0D,'end',.4D), named_struct('word','SEARA','start',.5D,'end',1D), named_struct('word','DRAGI','start',1.0D,'end',1.4D)) w")
    got = w.select(ordered.trim_words(F.col("w"), F.lit(0.5), F.lit(1.5)).alias("x")).first().x
    assert [(g.word, g.start, g.end) for g in got] == [("SEARA", 0.0, 0.5), ("DRAGI", 0.5, 0.9)]


def test_lag(spark):
    rows = [("k", i, math.sin(i / 3), math.sin((i - 4) / 3)) for i in range(80)]
    got = ordered.best_lag(spark.createDataFrame(rows, "k string, t int, a double, b double"), ["k"], "t", "a", "b", 8).first()
    assert got.lag == 4 and got["corr"] > 0.999


def test_consensus_and_identity(spark):
    rows = spark.createDataFrame([("v", "V0", f, i) for i, f in enumerate(["s0", "s0", "s1", "s0"])] + [("v", "V1", "b", 4), ("v", "V1", "a", 5), ("v", "", "a", 6)], "video string, voice string, face string, i int")
    assert {r.i: r.mismatch for r in identity.av_consensus(rows, ["video"]).collect()} == {0: 0, 1: 0, 2: 1, 3: 0, 4: 1, 5: 0, 6: None}
    vec = [("v", 0, [1.0, 0.0]), ("v", 1, [0.0, 1.0]), ("v", 2, [0.9, 0.1]), ("v", 3, [0.1, 0.9]), ("v", 4, [-1.0, 0.0])]
    frame = spark.createDataFrame(vec, "video string, id int, vec array<double>")
    assert {r.id: r.cluster for r in identity.clusters(frame, "video").collect()} == {0: 0, 1: 1, 2: 0, 3: 1, 4: 2}
    assert {r.id: r.cluster for r in identity.clusters(frame, "video", min_members=2).collect()} == {0: 0, 1: 1, 2: 0, 3: 1, 4: None}
    known = spark.createDataFrame([(10, [1.0, 0.05])], "k_id int, k_vec array<double>")
    assert {r.id: (r.speaker, r.match) for r in identity.identities(frame.select("id", "vec"), known).collect()}[0] == (10, "auto")


def test_cut_recordings_give_the_same_windows(spark):
    """Pieces between long silences, decided alone, against one group for the whole recording."""
    r = random.Random(11)
    words, at = [], 0.0
    for _ in range(700):
        at += r.choice([0.0, 0.05, 0.3, 0.6, 0.95, 1.0, 1.05, 3.0, 9.0])
        words.append((at, at + r.choice([0.1, 0.4, 1.5]), r.choice(["a", "b.", "c?"]), r.choice(["S0", "S0", "S1", None])))
        at = words[-1][1]
    rows = [(v, i, *w, w[2].upper()) for v in (1, 2) for i, w in enumerate(words)]
    df = spark.createDataFrame(rows, "video int, i int, start double, end double, raw string, speaker string, clean string")
    for limits in ({}, {"hard_max": 4.0}, {"pad": 2.0, "hard_min": 0.2}, {"merge_gap": 0.2}):
        told = [ordered.sentence_windows(df, "video", ["i"], ordered.Segmentation(**limits), pieces).filter("video = 1").orderBy("window").collect() for pieces in (True, False)]
        assert told[0] == told[1] and [x.window for x in told[0]] == list(range(len(told[0]))) and len(told[0]) > 50
