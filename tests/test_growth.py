"""What keeps work in proportion to the input: no pairs where sums do, no frame or group for each key, no hot joins."""

import contextlib
import io

import numpy as np
from pyspark.sql import functions as F

from tallyloom.functions import text, wer
from tallyloom.operators import joins, media, ordered, stats, tracks


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("extended")
    return out.getvalue()


def test_tracker_takes_arrays_and_equals_all_pairs(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], "k string, at int")
    held = tracks.in_order(rows, "k", ["at"], lambda piece, state: ({"k": piece["k"], "n": [len(piece["k"])] * len(piece["k"])}, state), "k string, n int")
    assert sorted(map(tuple, held.collect())) == [("a", 2), ("a", 2), ("b", 1)]
    draw = np.random.default_rng(3)
    for n, m in ((1, 1), (2, 3), (5, 6), (9, 9)):
        for _ in range(20):
            found, old = (np.c_[draw.integers(0, 9, (k, 2)), draw.integers(5, 9, (k, 2))].astype(float) for k in (n, m))
            share, taken = tracks._overlaps(found, old), {}
            for s, i, j in sorted(((share[i, j], i, j) for i in range(n) for j in range(m)), reverse=True):
                if s >= 0.3 and i not in taken and j not in taken.values():
                    taken[i] = j
            assert tracks.assign(list(map(tuple, found.tolist())), list(map(tuple, old.tolist())), 0.3) == taken


def test_best_lag_forms_no_pairs(spark):
    rows = [("k", i, float(i * i % 7), float((i - 2) * (i - 2) % 7)) for i in range(40)] + [(None, i, 1.0 * i, 1.0 * i) for i in range(9)] + [("few", 0, 1.0, 2.0)]
    got = ordered.best_lag(spark.createDataFrame(rows, "k string, t int, a double, b double"), ["k"], "t", "a", "b", 5)
    assert [(r.k, r.lag, round(r.corr, 6)) for r in got.collect()] == [("k", 2, 1.0)]
    assert "Join" not in plan(got)


def test_orphans_are_one_aggregate(spark):
    a, b = (spark.createDataFrame(x, "k int") for x in ([(1,), (2,), (2,), (None,), (None,)], [(2,), (3,), (3,), (None,)]))
    got = joins.orphans(a, b, "k")
    assert sorted(map(str, got.collect())) == sorted(["Row(k=1, side='left')", "Row(k=3, side='right')", "Row(k=None, side='left')", "Row(k=None, side='right')"])
    assert "Join" not in plan(got)


def test_quantiles_of_few_large_groups_read_counts(spark, monkeypatch):
    kept, saved = [], stats.saved
    monkeypatch.setattr(stats, "saved", lambda df: kept.append(saved(df)) or kept[-1])
    rows = spark.range(3000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") % 10 > 0, (F.col("id") % 30) / 7).alias("v"))
    got = {r.k: (r.n, r.p25, r.median) for r in stats.grouped_quantiles(rows, ["k"], "v", digits=9).collect()}
    want = {k: sorted(i % 30 / 7 for i in range(3000) if i % 2 == k and i % 10) for k in (0, 1)}
    assert got == {k: (len(x), *(round(float(np.quantile(x, p)), 9) for p in (0.25, 0.5))) for k, x in want.items()}
    assert kept[0].count() == 28  # 27 values and the null of one group: not 3,000 rows


def test_digit_share_by_patterns(spark):
    texts = ["a1 b2 c", "", "  ", None, "12", "x y9　z \n7", "no digits here", "a" * 50000 + " 1"]
    share = [None if not (t or "").split() else sum(any("0" <= c <= "9" for c in w) for w in t.split()) / len(t.split()) for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    told = df.select("i", text.digit_share(F.col("t")).alias("s"))
    assert [r.s for r in told.orderBy("i").collect()] == share
    assert "lambda" not in plan(told)  # no array of words


def test_word_changes_are_built_as_columns(spark):
    import pyarrow as pa

    a, b = ["a b c", None, "x " * 40000], ["A x c", "y z", "x q " * 20000]
    df = spark.createDataFrame(list(zip(a, b, strict=True)), "a string, b string")
    got = [[(w["word"], w["type"]) for w in r[0]] for r in df.coalesce(1).select(wer.word_changes(F.col("a"), F.col("b"))).collect()]
    assert sorted(got) == sorted(wer.word_diff(x or "", y) for x, y in zip(a, b, strict=True))
    assert isinstance(wer.word_diff_udf.func(pa.array(a), pa.array(b)), pa.ListArray)


def test_sentences_and_mouths_take_no_group_each(spark):
    words = spark.sql("SELECT id % 3 AS v, CAST(id AS INT) AS i, 20 * id + 0D AS start, 20 * id + 1.5D AS end, 'A.' AS raw, 'A' AS clean, CAST(NULL AS STRING) AS speaker FROM range(30)")
    found = ordered.sentence_windows(words, "v", ["i"])
    assert found.count() == 30 and [r.window for r in found.filter("v = 1").orderBy("start").collect()] == list(range(10))
    marks = spark.sql("SELECT id % 2 AS clip, CAST(id DIV 2 AS INT) AS frame, 1D * id AS cx, 2D * id AS cy, 30D AS width, 0D AS roll FROM range(40)")
    for how, options in (("one_euro", {}), ("gaussian", {"sigma": 1.0})):
        got = media.mouth_trajectory(marks, smoothing=how, **options).filter("clip = 1").orderBy("frame").collect()
        work = {"one_euro": tracks.one_euro, "gaussian": tracks.gaussian}[how]
        assert [r.x for r in got] == np.rint(work(np.arange(1.0, 40, 2), **options)).astype(int).tolist()
        assert "FlatMapGroups" not in plan(media.mouth_trajectory(marks, smoothing=how, **options))
    assert "FlatMapGroups" not in plan(found)
