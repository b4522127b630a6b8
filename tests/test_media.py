import numpy as np
from pyspark.sql import functions as F

from tallyloom.operators import changelog, media
from tallyloom.plans import serving


def test_chunks(spark):
    plan = media.chunk_plan(spark.createDataFrame([("m", 250.0)], "media_id string, duration double"), 100.0, 10.0).orderBy("chunk").collect()
    assert len(plan) == 3 and plan[-1].clean_end == 250.0 and plan[1].audio_start == plan[1].clean_start - 10
    frame = spark.createDataFrame(plan)
    words = spark.createDataFrame([("m", 0, 80.0, 84.0), ("m", 1, 6.0, 9.0), ("m", 1, 10.5, 11.0)], "media_id string, chunk int, start double, end double")
    assert sorted(round(r.start, 2) for r in media.stitch(words, frame).collect()) == [80.0, 83.83]


def test_audio_and_codec(spark):
    t = np.arange(8000) / 8000
    tone, noise = np.sin(2 * np.pi * 1000 * t), np.random.default_rng(1).normal(size=8000)
    rows = [("tone", tone.tolist(), 8000), ("noise", noise.tolist(), 8000), ("none", [], 8000)]
    got = {r.k: r for r in media.noise_tags(spark.createDataFrame(rows, "k string, samples array<float>, rate int"), "k").collect()}
    assert set(got) == {"tone", "noise"} and got["tone"].noise == "none" and got["noise"].noise == "high" and got["tone"].voice_ratio > 0.99


def test_mouth(spark):
    rows = [("c", f, *((None,) * 4 if f % 5 == 4 else (100.0, 50.0, 120.0 if f == 7 else 40.0, 0.0))) for f in range(50)]
    marks = spark.createDataFrame(rows, "clip string, frame int, cx double, cy double, width double, roll double")
    got = media.mouth_trajectory(marks).collect()
    assert len(got) == 50 and {(g.x, g.y, g.half) for g in got} == {(100, 50, 36)}
    assert media.landmark_failures(marks).first().fail_rate == 0.2


def test_shift_and_slice(spark):
    w = spark.sql("SELECT array(named_struct('word','a','start',-0.5D,'end',0D)) w, sequence(1, 300) r").select(
        media.zero_based(F.col("w")).alias("z"), media.feature_rows(F.col("r"), F.lit(0.5), F.lit(9.0)).alias("r")).first()
    assert (w.z.shift, w.z.words[0].start, w.z.words[0].end) == (-0.5, 0.0, 0.5) and w.r == list(range(51, 301))


def test_ids(spark):
    rows = spark.createDataFrame([("md_001_1",), ("md_0010_1",), ("md_002",)], "id string")
    gone = spark.createDataFrame([("md_001",)], "p string")
    assert sorted(r.id for r in changelog.delete_prefixes(rows, gone, "id", "p").collect()) == ["md_0010_1", "md_002"]
    mapping = spark.createDataFrame([("md_001", "md_007")], "old string, new string")
    assert sorted(r.id for r in changelog.rewrite_ids(rows, mapping, "id").collect()) == ["md_0010_1", "md_002", "md_007_1"]
    assert changelog.next_index(spark.createDataFrame([("v_spk2",), ("v_spk10",)], "s string"), "s").first().next == 11
