import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

TABLES = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(TABLES).exists(), reason="no tables")
def test_stages(spark):
    import corpus_pipeline as c
    from tallyloom.llm.common import cut
    from tallyloom.llm import minhash_dedup

    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in c.STAGES[:-1]:
        docs = cut(stage(spark, docs, TABLES), f"test-{name}")
        assert docs.columns == columns, name
        if name != "mixing":
            assert docs.count() <= n
            n = docs.count()
        if name == "minhash_dedup":
            assert minhash_dedup.near_classes(docs).filter("class_size > 1").count() == 0
    from tallyloom.llm import bpe

    own = bpe.encoder(bpe.default_ranks(), bpe.default_pattern())
    got = c.STAGES[-1][1](spark, docs, TABLES)
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = got.collect()
    assert len(rows) == docs.count() and all(list(r.ids) == own.encode_ordinary(text[r.doc_id]) for r in rows)
    assert 4 <= len(c.STAGES) <= 5 and os.path.exists(c.__file__)


@pytest.mark.skipif(not Path(TABLES).exists(), reason="no tables")
@pytest.mark.parametrize("name", ["op3_exact_dedup", "op9_mixing", "op10_line_dedup"])
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from tallyloom.llm import registry

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{TABLES}/documents.parquet'")
    got = registry.queries()[name](spark, TABLES)
    columns = sorted(got.columns)
    want = con.sql(f"select {', '.join(columns)} from ({registry.oracle_sql()[name]})").fetchall()
    show = lambda rows: sorted(repr([float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in r]) for r in rows)
    assert show(got.select(*[F.col(c) for c in columns]).collect()) == show(want)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def small_corpus():
    import random

    from test_more import labelled
    from test_operators import prose

    r = random.Random(15)
    rows = labelled(r, 40)
    passage = "\n".join(prose(30, r) for _ in range(3))
    extra = [f"{prose(20, r)}\n{passage}\n{prose(15, r)}".capitalize() + "." for _ in range(4)]
    near = rows[0][1].split()
    near[3] = "changed"
    texts = [t for _, t, _ in rows] + extra + [rows[0][1], " ".join(near), rows[2][1]]
    docs = [(i, t, "en", None if i % 9 == 4 else f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    return docs, [(i, y, 0) for i, _, y in rows]


def targets(sizes):
    """Target of each source: shares by weights 1, 2, 3 in code point order (null last), at most three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, out = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in out]
        left = total - sum(out.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return out | share
        out |= {s: 3 * sizes[s] for s in over}


def test_stages_against_brute_force(spark, tmp_path):
    import hashlib
    from collections import Counter, defaultdict

    import corpus_pipeline as c
    import numpy as np
    from tallyloom.llm import bpe, quality
    from tallyloom.llm.common import cut
    from test_lines import brute
    from test_minhash import classes

    rows, labels = small_corpus()
    docs = cut(spark.createDataFrame(rows, DOCS), "test-small")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    text = lambda df: {r.doc_id: r.text for r in df.collect()}
    model = quality.train(docs, marks)
    want = {i: t for i, t, *_ in rows if model.scores(np.array([quality.features(t)]))[0] >= quality.CUT}
    step = cut(c.quality_classifier(spark, docs, str(tmp_path)), "test-1")
    assert text(step) == want and 40 <= len(want) < len(rows)
    lines = dict(zip(sorted(want), brute([want[i] for i in sorted(want)]), strict=True))
    want = {i: k for i, (k, n) in lines.items() if not (n and n == len(want[i].split("\n")))}
    step = cut(c.line_deduplication(spark, step, str(tmp_path)), "test-2")
    assert text(step) == want and any(n for _, n in lines.values())
    want = {i: want[i] for i in set(classes(want).values())}
    step = cut(c.near_deduplication(spark, step, str(tmp_path)), "test-3")
    assert text(step) == want and len(want) < len(lines)
    source = {r[0]: r[3] for r in rows}
    size = {i: len(t.split()) for i, t in want.items()}
    sums = defaultdict(int)
    for i in want:
        sums[source[i]] += size[i]
    step = cut(c.source_mixing(spark, step, str(tmp_path)), "test-4")
    taken, got = Counter(r.doc_id for r in step.collect()), defaultdict(int)
    for i, n in taken.items():
        assert i in want and n <= 3
        got[source[i]] += n * size[i]
    for s, t in targets(sums).items():
        assert abs(got[s] - t) <= max(size[i] for i in want if source[i] == s)
    own = bpe.encoder(bpe.default_ranks(), bpe.default_pattern())
    last = c.bpe_encoding(spark, step, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in last) == taken
    assert all(list(r.ids) == own.encode_ordinary(want[r.doc_id]) and r.n_tokens == len(r.ids) and r.decoded_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest() for r in last)


def test_odd_rows_pass_all_stages(spark, tmp_path):
    """Nulls in any column, empty, repeated and long rows, columns with clashing names, and no rows at all."""
    import corpus_pipeline as c
    from tallyloom.llm.common import cut

    rows, labels = small_corpus()
    odd = [(None, rows[0][1], None, None, None), (None, None, None, None, None), (200, None, "en", "s0", None), (201, "", "en", "s0", 0), (201, "", "en", "s0", 0), rows[1], rows[1], rows[2], (202, "long text here, " * 30_000, "en", "s1", 1), (200, "another one.", None, "s1", 12)]
    names = ["row", "score", "kept_text", "near_id", "t", "size", "ids", "block", "_text", "_gone"]
    docs = spark.createDataFrame([*rows, *odd], DOCS)
    docs = docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    spark.createDataFrame([*labels, (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for start in (docs, docs.filter("false")):
        now = cut(start, "test-odd")
        for _, stage in c.STAGES[:-1]:
            now = cut(stage(spark, now, str(tmp_path)), "test-odd")
            assert now.columns == docs.columns
        last = c.STAGES[-1][1](spark, now, str(tmp_path))
        assert last.count() == now.count()
        if start is docs:
            assert now.select("doc_id", "text", "source").distinct().count() > 20 and now.filter("score <> 1 OR near_id <> 3").count() == 0
