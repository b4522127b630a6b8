import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=4, entries=256, rounds=4):
    """Every part against every entry, with Python's integers."""
    kept = [(i, lab, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return {}, []
    d = len(kept[0][2])
    fit = [r for r in kept if len(r[2]) == d]
    edges = [k * d // parts for k in range(parts + 1)]
    cut = lambda x, k: x[edges[k] : edges[k + 1]]
    books = [[cut(r[2], k) for r in fit[:entries]] for k in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, z, strict=True)), i) for i, z in enumerate(book))
    for _ in range(rounds):
        for k in range(parts):
            got = defaultdict(list)
            for r in fit:
                got[near(cut(r[2], k), books[k])[1]].append(cut(r[2], k))
            for i, xs in got.items():
                books[k][i] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    out = []
    for i, lab, x in fit:
        found = [near(cut(x, k), books[k]) for k in range(parts)]
        out.append((i, lab, "".join(f"{e:02x}" for _, e in found), sum(e for e, _ in found)))
    return out, books


def vectors(n, d, seed, copies=0):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(d)] for _ in range(7)]
    rows = [(i, [c + rng.gauss(0, 0.15) for c in rng.choice(centres)], rng.choice([None, 1, 2, 3])) for i in range(n)]
    rows += [(n + i, rows[0][1], 1) for i in range(copies)]
    # coarse grids make ties between entries
    rows += [(2 * n + copies + i, [rng.randrange(-2, 3) / 1024 for _ in range(d)], 2) for i in range(n // 2)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("d", "copies"), [(16, 0), (8, 400), (12, 30)])
def test_codes_equal_brute_force(spark, d, copies, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 97)
    rows = vectors(300, d, d, copies)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({"code": F.lit("x"), "error": F.lit(0), "id": F.lit(1), "x": F.lit(2)})
    codes = vector_codes.encode_vectors(df, entries=40)
    want, books = brute(rows, entries=40)
    assert codes.codebooks == books
    got = vector_codes.with_label_errors(codes.coded).collect()
    assert sorted((r.id, r.code, r.error) for r in got) == sorted((i, c, e) for i, _, c, e in want)
    by_label = defaultdict(int)
    for _, lab, _, e in want:
        by_label[lab] += e
    assert all(r.label_error == by_label[r.label] for r in got)
    flat = ",".join(str(x) for b in books for z in b for x in z)
    assert codes.digest() == hashlib.sha256(flat.encode()).hexdigest()


def test_trees_assign_like_all_pairs():
    rng = np.random.default_rng(3)
    for n, width, k, span in [(1, 4, 5, 9), (9, 3, 1, 4), (500, 4, 60, 3), (1000, 16, 256, 300), (64, 0, 3, 2), (333, 2, 40, 1), (200, 4, 30, 1 << 27)]:
        points, book = rng.integers(-span, span + 1, (n, width)), rng.integers(-span, span + 1, (k, width))
        want = ((points[:, None] - book[None]) ** 2).sum(2).argmin(1)
        tree = vector_codes.build_tree(points)
        assert (vector_codes.nearest(tree, book) == want).all()
        sums, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        vector_codes.add_up(tree, book, sums, counts)
        assert (counts == np.bincount(want, minlength=k)).all()
        assert all((sums[i] == points[want == i].sum(0)).all() for i in range(k))


def test_whole_subtrees_go_at_once():
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.integers(-20, 20, (2000, 4)) + c for c in ([5000, 0, 0, 0], [0, 5000, 0, 0], [0, 0, 5000, 0])])
    singles, nodes = [], []
    vector_codes.filter_entries(vector_codes.build_tree(points), np.array([[5000, 0, 0, 0], [0, 5000, 0, 0], [0, 0, 5000, 0]]), lambda _, n, e: nodes.append(len(n)), lambda p, e: singles.append(len(p)))
    assert sum(singles) < 60 and sum(nodes) < 60


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (5, [1.0, 2.0, 3.0, 4.0], 1), (5, [1.0, 2.0, 3.0, 4.0], None), (None, [0.0, -0.5, 0.25, 1e30], None), (7, None, 1), (8, [1.0, None, 2.0, 3.0], 1),
        (9, [inf, 0.0, 0.0, 0.0], 2), (10, [nan, 0.0, 0.0, 0.0], 2), (11, [1.0, 2.0], 2), (12, [], None), (13, [-1e-9, 0.0, 0.0, 0.0], 4),
    ]
    codes = vector_codes.encode_vectors(spark.createDataFrame(rows, SCHEMA))
    got = vector_codes.with_label_errors(codes.coded).collect()
    assert sorted(r.id if r.id is not None else -1 for r in got) == [-1, 5, 5, 11, 12, 13]
    assert [r.code for r in got if r.id in (11, 12)] == [None, None]
    most = vector_codes.largest(4, 4)
    assert [b[-1] for b in codes.codebooks] == [[0], [-512], [256], [most]]
    assert all(r.error == 0 for r in got if r.id not in (11, 12))
    one = vector_codes.encode_vectors(spark.createDataFrame([(1, [0.5] * 7, None)], SCHEMA))
    assert [tuple(r) for r in one.coded.collect()] == [(1, None, "00000000", 0)]
    nothing = vector_codes.encode_vectors(spark.createDataFrame([], SCHEMA))
    assert nothing.coded.count() == 0 and nothing.codebooks == [[], [], [], []]
    none = vector_codes.encode_vectors(spark.createDataFrame([(1, [], 1)], SCHEMA))
    assert [tuple(r) for r in none.coded.collect()] == [(1, 1, "00000000", 0)]
    assert vector_codes.encode_vectors(spark.createDataFrame([(None, None, None)], SCHEMA)).coded.count() == 0
