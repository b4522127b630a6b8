import random

import numpy as np
import pytest

from tallyloom.llm import suffix_dedup
from test_operators import brute_suffix, prose


def brute_rows(rows):
    """(n_bytes, n_removed, n_spans, kept) of each row, in any order; rows alike in id and text share their place."""
    order = sorted({(i is None, i, suffix_hash(t), t) for i, t in rows}, key=lambda x: (x[0], x[1] or 0, x[2]))
    texts = dict(enumerate(t or "" for _, _, _, t in order))
    found = brute_suffix(texts)
    by = {(i, t or ""): found[n] for n, (_, i, _, t) in enumerate(order)}
    return sorted((str(i), *by[i, t or ""]) for i, t in rows)


def suffix_hash(text):
    return HASHES[text or ""]


HASHES = {}


def got(spark, rows, kind="long"):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, f"id {kind}, text string, doc string, gram int, raw int")
    for r in df.select(F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).distinct().collect():
        HASHES[r.t] = r.h
    return sorted((str(r.id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df, "id").collect())


def corpus(seed=3):
    r = random.Random(seed)
    base = [prose(40 + 9 * i, r) for i in range(8)]
    texts = [*base, base[0], base[1] + " tail", "lead " + base[2], None, "", "x" * 400, "ab" * 300, base[3][:150] + base[4][50:260] + base[3][10:170]]
    return [(t, "y", 1, 2) for t in texts]


@pytest.mark.parametrize("ids", [lambda i: i, lambda i: None if i % 5 == 4 else i // 2, lambda i: 10**15 * (20 - i), lambda i: -i])
def test_ids_of_any_kind(spark, ids):
    """Small numbers, missing and repeated ones, large ones and negative ones."""
    rows = [(ids(i), *x) for i, x in enumerate(corpus())]
    rows += rows[:3]
    assert got(spark, rows) == brute_rows([(i, t) for i, t, *_ in rows])


def test_text_ids(spark):
    rows = [(f"d{i:03}", *x) for i, x in enumerate(corpus(4))]
    texts = {i: t or "" for i, t, *_ in rows}
    assert got(spark, rows, "string") == sorted((i, *v) for i, v in brute_suffix(texts).items())


def test_text_of_over_a_million_bytes(spark):
    r = random.Random(6)
    block = prose(300, r)
    long = "".join(prose(150, r) + block[a : a + 180] for a in (r.randrange(0, 800) for _ in range(1100)))
    assert len(long.encode()) > 1 << 20
    rows = [(1, block, "y", 1, 2), (2, long, "y", 1, 2), (3, long[700_000:700_350], "y", 1, 2)]
    want = brute_suffix({1: block, 2: long, 3: rows[2][1]})
    assert got(spark, rows) == sorted((str(i), *v) for i, v in want.items())


def test_many_copies_of_a_passage(spark):
    r = random.Random(7)
    shared = prose(40, r)
    rows = [(i, f"{prose(12, r)} {shared if i % 3 else shared[5:-3]} {prose(10, r)}", "y", 1, 2) for i in range(300)]
    assert got(spark, rows) == sorted((str(i), *v) for i, v in brute_suffix({i: t for i, t, *_ in rows}).items())


def test_pairs():
    import pyarrow as pa

    owner, a, b = suffix_dedup.pairs_of(pa.array([[(5 << 32) + 7], [], [(1 << 32) + 2, (0 << 32) + 9]], pa.list_(pa.int64())))
    assert owner.tolist() == [0, 2, 2] and a.tolist() == [5, 1, 0] and b.tolist() == [7, 2, 9]
    assert np.array_equal(suffix_dedup._table(3, 4), np.array([1, 3, 9, 27], np.uint64))
