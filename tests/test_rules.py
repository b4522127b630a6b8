import math

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import rules, text
from tallyloom.functions.wer import distance, wer, wer_native, word_diff

CLEAN = dict(whisper_conf=0.95, whisper_conf_min=0.8, face_visibility_ratio=0.99, mouth_landmark_fail_rate=0.01, duration=5.0,
             asd_method="", syncnet_method="", mouth_roi_method="", boundary_start_type="", boundary_end_type="")
SCHEMA = "whisper_conf double, whisper_conf_min double, face_visibility_ratio double, mouth_landmark_fail_rate double, duration double, asd_method string, syncnet_method string, mouth_roi_method string, boundary_start_type string, boundary_end_type string"


@pytest.mark.parametrize("change, tier", [
    ({}, "A"), ({"whisper_conf_min": 0.55}, "B"), ({"whisper_conf": 0.40, "whisper_conf_min": 0.20}, "C"), ({"asd_method": "fallback_motion"}, "B"),
    ({"duration": 14.5}, "B"), ({"whisper_conf": math.nan}, "C"), ({"whisper_conf": None}, "C"), ({"syncnet_method": "error"}, "B"), ({"boundary_end_type": "forced"}, "B"),
])
def test_quality_tier(spark, change, tier):
    row = CLEAN | change
    assert spark.createDataFrame([tuple(row.values())], SCHEMA).select(rules.quality_tier()).first()[0] == tier


@pytest.mark.parametrize("raw, word", [("«bine»,", "BINE"), ("s-a.", "S-A"), ("...", ""), ("aşa", "AȘA")])
def test_clean_word(spark, raw, word):
    assert spark.createDataFrame([(raw,)], "w string").select(text.clean_word(F.col("w"))).first()[0] == word


def test_normalize(spark):
    rows = spark.createDataFrame([("aşa şi ţara",), ("și",), (None,)], "w string").select(text.normalize_diacritics(F.col("w"))).collect()
    assert [r[0] for r in rows] == ["așa și țara", "și", None]


@pytest.mark.parametrize("raw, ends", [("da.", True), ("da.”", True), ("da", False), ("", False), (None, False), ("oare?", True), ("...\"", True)])
def test_ends_sentence(spark, raw, ends):
    assert spark.createDataFrame([(raw,)], "w string").select(text.ends_sentence(F.col("w"))).first()[0] is ends


def test_consensus(spark):
    rows = [(0.1, 0.1, 0.1), (0.5, 0.5, 0.1), (0.5, 0.1, 0.5), (0.1, 0.5, 0.5), (0.5, 0.5, 0.5), (None, 0.1, 0.1), (0.2, 0.2, 0.2)]
    got = spark.createDataFrame(rows, "a double, b double, c double").select(rules.consensus_label(F.col("a"), F.col("b"), F.col("c"))).collect()
    assert [r[0] for r in got] == ["all_agree", "dialectal_agree", "std_large_agree", "std_med_agree", "all_disagree", "insufficient", "all_disagree"]


def test_reason_round_trip(spark):
    rows = ["low_asd=0.25", "track_too_short=0.20s", "no_face", "x=-1.5", "n=3"]
    df = spark.createDataFrame([(r,) for r in rows], "r string").select("r", rules.reason_struct(F.col("r")).alias("s"))
    got = df.select("r", "s.*", rules.reason_text(F.col("s")).alias("back")).collect()
    assert [g.back for g in got] == rows
    assert (got[0].code, got[0].value, got[0].decimals) == ("low_asd", 0.25, 2)
    assert (got[1].code, got[1].value) == ("track_too_short=0.20s", None)


def test_wer_agrees_and_edges(spark):
    pairs = [("a b c", "a x c"), ("a b", ""), ("", "a"), (None, "a"), ("...", "a"), ("A, b!", "a b"), ("a b c d", "b c d e f")]
    df = spark.createDataFrame(pairs, "r string, h string").select(wer(F.col("r"), F.col("h")).alias("w"), wer_native(F.col("r"), F.col("h")).alias("n"), F.size(text.stat_tokens(F.col("r"))).alias("k"))
    got = df.collect()
    assert [g.w for g in got] == [0.3333, 1.0, None, None, 0.0, 0.0, 0.75]
    assert all(g.w is None or g.k == 0 or round(g.n / g.k, 4) == g.w for g in got)
    assert distance([], []) == 0 and distance(list("kitten"), list("sitting")) == 3
    assert word_diff("a b c", "A x c") == [("A", "same"), ("x", "changed"), ("c", "same")]


def test_small_text_functions(spark):
    def one(c, *v):
        return spark.createDataFrame([v], ", ".join(f"c{i} string" for i in range(len(v)))).select(c).first()[0]

    assert one(text.video_id(F.col("c0")), "https://youtu.be/abcdefghijk?t=1") == "abcdefghijk"
    assert one(text.video_id(F.col("c0")), "abcdefghij") is None
    assert one(text.rate_bytes(F.col("c0")), "5M") == 5 << 20 and one(text.rate_bytes(F.col("c0")), "x") == 5 << 20
    assert one(text.frame_rate(F.col("c0")), "25/1") == 25.0 and one(text.frame_rate(F.col("c0")), "25/0") == 25.0
    assert one(text.is_open_licence(F.col("c0"), F.col("c1")), "Creative Commons", "") is True
    assert one(text.duration_text(F.col("c0")), "7530") == "2h 5m 30s"
    assert one(text.log_parts(F.col("c0")), "12:00:01 | INFO | Step 1: Downloading video: md_001").msg == "Step 1: Downloading video: md_001"
    assert [one(text.log_kind(F.col("c0")), m) for m in ("it failed", "skipped", "done", "x")] == ["error", "warn", "success", "info"]


def test_bands_cover(spark):
    df = spark.range(0, 400).select((F.col("id") / 20).alias("v"))
    banded = df.groupBy(rules.band(F.col("v"), rules.DURATION_EDGES, rules.DURATION_BANDS)).count().collect()
    assert sum(r["count"] for r in banded) == 400
    bins = spark.createDataFrame([(0.0,), (0.05,), (1.0,), (1.01,), (None,), (0.15,)], "w double").select(rules.histogram_bin(F.col("w"), 0.0, 1.0, 20)).collect()
    assert [b[0] for b in bins] == [0, 1, 19, None, None, 3]
