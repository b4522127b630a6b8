import random
from itertools import pairwise

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import minhash_dedup
from tallyloom.llm.common import cut
from test_operators import DOCS, WORDS, corpus, prose, texts_of


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(corpus(), DOCS)
    return cut(df.withColumns({"near_id": F.lit(1), "t": F.lit("x"), "band": F.lit(0), "node": F.lit(1), "id": F.lit(9), "near_own": F.lit("y")}), "test-docs")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


def shingles(text):
    w = minhash_dedup.normal(text).split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def classes(texts, least=0.8):
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = {k: shingles(t) for k, t in texts.items()}
    for a in texts:
        for b in texts:
            if a < b and (sets[a] == sets[b] == set() or sets[a] | sets[b] and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {k: find(k) for k in texts}


def test_minhash(docs, empty):
    got = {r.id: (r.class_id, r.class_size) for r in minhash_dedup.near_classes(docs).collect()}
    want = classes(texts_of(docs))
    assert {k: v[0] for k, v in got.items()} == want
    assert all(v[1] == sum(w == v[0] for w in want.values()) for v in got.values())
    assert minhash_dedup.near_classes(empty).count() == 0
    left = minhash_dedup.one_of_each(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == set(want.values())


def test_minhash_group_of_near_copies(spark):
    r = random.Random(8)
    base = prose(150, r).split()
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(r.randint(0, 12)):
            words[r.randrange(len(words))] = r.choice(WORDS) + "z"
        rows.append((i, " ".join(words)))
    got = {x.id: x.class_id for x in minhash_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == classes(dict(rows))


def families(r, n, size, edits):
    """n families of size documents, each a text of 150 to 400 words with so many words changed."""
    rows = []
    for _ in range(n):
        base = [r.choice(WORDS) + r.choice(WORDS) for _ in range(r.randint(150, 400))]
        for _ in range(size):
            words = list(base)
            for at in r.sample(range(len(words)), round(len(words) / 90 * edits)):
                words[at] = r.choice(WORDS) + "z"
            rows.append((len(rows), " ".join(words)))
    return rows


def test_minhash_borderline_families(spark):
    r = random.Random(21)
    rows = families(r, 24, 40, 1.3)
    want = {}
    for f in range(24):
        want |= classes(dict(rows[40 * f : 40 * f + 40]))
    got = {x.id: x.class_id for x in minhash_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert 24 < len(set(want.values())) < len(rows) and got == want


def test_minhash_repeated_lines(spark):
    r = random.Random(31)
    rows, want = [], {}
    for f in range(0, 160, 2):
        lines = [[r.choice(WORDS) + r.choice(WORDS) for _ in range(25)] for _ in range(20)]
        text = lambda n, own: "\n".join(" ".join(x) for i, x in enumerate(own) for _ in range(n if i < 6 else 1))
        changed = [list(x) for x in lines]
        for at in r.sample(range(150, 500), 10):
            changed[at // 25][at % 25] = "changed"
        pair = {f: text(100, lines), f + 1: text(2, changed)}
        want |= classes(pair)
        rows += pair.items()
    got = {x.id: x.class_id for x in minhash_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(set(want.values())) == 80 and got == want


def test_rows_are_known_by_id_and_text(spark):
    a, b, c = (prose(80, random.Random(i)) for i in (1, 2, 3))
    rows = [(1, a), (1, a), (1, b), (2, b), (None, c), (None, c), (3, c), (None, "own words only here"), (None, None), (4, ""), (4, "!! \u2014")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash_dedup.near_classes(docs).collect()
    assert len(got) == len(rows)
    assert sorted((x.id or 0, x.class_id or 0, x.class_size) for x in got) == [(0, 0, 1), (0, 3, 3), (0, 3, 3), (0, 4, 3), (1, 1, 2), (1, 1, 2), (1, 1, 2), (2, 1, 2), (3, 3, 3), (4, 4, 3), (4, 4, 3)]
    left = sorted((x.doc_id or 0, x.text or "") for x in minhash_dedup.one_of_each(docs).collect())
    assert left[1:] == sorted([(1, a), (1, b), (3, c), (4, left[-1][1])]) and left[0] == (0, "own words only here")


def test_closest_pair_fails_and_the_next_passes():
    """Of two components the pair with most equal registers isn't similar; the other is still found, and one link is enough."""
    import numpy as np
    import pyarrow as pa

    r = random.Random(41)
    words = [r.choice(WORDS) + str(i) for i in range(100)]
    text = lambda n: " ".join([*words[:n], *[f"own{n}x{i}" for i in range(100 - n)]])
    kind = pa.struct([("node", pa.int64()), ("root", pa.int64()), ("registers", pa.list_(pa.int32())), ("text", pa.string())])
    reg = np.arange(minhash_dedup.REGISTERS)
    near, far, late = np.where(reg < 120, reg, -1), np.where(reg < 100, reg, -2), np.where(reg >= 8, reg, -3)
    row = lambda node, root, registers, text: {"node": node, "root": root, "registers": registers.tolist(), "text": text}
    a = pa.array([row(1, 1, reg, text(100))], kind)
    b = pa.array([row(2, 2, near, text(50)), row(3, 2, far, text(95)), row(4, 1, reg, text(100)), row(5, 2, far, text(97)), row(6, 6, late, text(97))], kind)
    assert minhash_dedup.crossing(0, a, b, 0.8) == [(1, 3)]
    assert minhash_dedup.crossing(2, a, b, 0.8) == [(1, 6)] and minhash_dedup.crossing(5, a, b, 0.8) == []


def test_batches_by_bytes():
    sizes = [10, 20, 5, 300, 1, 1, 0, 90]
    runs = list(minhash_dedup.by_bytes(sizes, 40))
    assert runs[0] == (0, 3) and (3, 4) in runs and all(a[1] == b[0] for a, b in pairwise(runs)) and runs[-1][1] == len(sizes)
    assert all(sum(sizes[i:j]) <= 40 or j == i + 1 for i, j in runs) and list(minhash_dedup.by_bytes([])) == []


def test_very_long_and_unicode_texts(spark):
    r = random.Random(12)
    words = [r.choice(WORDS) + r.choice(WORDS) for _ in range(400_000)]
    other = list(words)
    for at in r.sample(range(len(words)), 4000):
        other[at] = "changed"
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(reversed(words))), (4, "a\u2014b c d e f"), (5, "A b, c\u00a0d e f")]
    got = {x.id: x.class_id for x in minhash_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}
