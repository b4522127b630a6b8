import base64
import gzip
import hashlib
import io
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import bpe, exact_dedup, minhash_dedup, mixing, quality, suffix_dedup, url_filter, warc
from tallyloom.llm.common import cut, dealt_join, may_be_among
from tallyloom.llm.graph import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(5)
WORDS = [a + b + c for a in ("th", "er", "on", "in", "é") for b in ("a", "o", "le", "ß") for c in ("nd", "st", "x")]


def prose(n, r=rng):
    return " ".join(r.choice(WORDS) for _ in range(n))


def corpus():
    base, shared = [prose(60 + i) for i in range(12)], "\n".join(prose(9 + i) for i in range(16))
    texts = [*base, base[0], base[0], base[1].replace(" ", "  ", 3), None, "", None, "a", "a b", "x" * 3000, "ab" * 900, prose(5000), f"{prose(20)}\n{shared}\n{prose(9)}", f"{prose(15)}\n{shared}\n{prose(12)}", "🎉 ünï\r\n\tcode  " * 9]
    near = base[2].split()
    near[7] = "changed"
    return [(i, t, "en", None if i % 7 == 3 else f"s{i % 4}", len(t or "")) for i, t in enumerate([*texts, " ".join(near)])]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(corpus(), DOCS)
    # extra columns whose names clash with those of the operators
    return cut(df.withColumns({"size": F.lit(1), "target": F.lit("x"), "score": F.lit(0), "kept": F.lit(1), "id": F.lit(9), "_text": F.lit("y")}), "test-docs")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


def texts_of(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def test_bpe(docs, empty, spark):
    own = bpe.encoder(bpe.default_ranks(), bpe.default_pattern())
    want = texts_of(docs)
    got = bpe.decode_documents(bpe.encode_documents(docs, block_bytes=9000)).collect()
    assert len(got) == len(want)
    assert all(list(r.ids) == own.encode_ordinary(want[r.doc_id]) and bytes(r.decoded) == want[r.doc_id].encode() for r in got)
    assert bpe.decode_documents(bpe.encode_documents(empty)).count() == 0
    twice = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert bpe.encode_documents(twice).count() == 3


def brute_suffix(texts):
    seen, out = set(), {}
    for key in sorted(texts):
        raw = texts[key].encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 99):
            w = raw[p : p + 100]
            if w in seen:
                gone[p : p + 100] = True
            seen.add(w)
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out[key] = (len(raw), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) > 0).sum()), kept)
    return out


def test_suffix(docs, empty, spark):
    want = brute_suffix(texts_of(docs))
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == want
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_random_borders(spark):
    r = random.Random(11)
    block = bytes(r.choice(b"abcdefgh ") for _ in range(700)).decode()
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.randint(1, 4)):
            a = r.randint(0, 600)
            parts += [block[a : a + r.choice((90, 100, 101, 120, 150, 170, 300))], bytes(r.choice(b"abcdefgh ") for _ in range(r.randint(0, 80))).decode()]
        rows.append((i, "".join(parts)))
    got = {x.id: (x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_suffix(dict(rows))


def test_suffix_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 4096)
    raw = prose(3000, random.Random(3)).encode()
    parts = [suffix_dedup.anchors(c, p) for c, p in suffix_dedup.chunks([raw, b"", raw[:50]])]
    many = {(int(a), int(g)) for x in parts for a, g in zip(x["pos"], x["context"])}
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1 << 20)
    one = [suffix_dedup.anchors(c, p) for c, p in suffix_dedup.chunks([raw])]
    assert many == {(int(a), int(g)) for x in one for a, g in zip(x["pos"], x["context"])}


@pytest.mark.parametrize("weak", [False, True])
def test_exact(docs, spark, tmp_path, weak):
    path = str(tmp_path / "in.parquet")
    docs.repartition(3).write.parquet(path)
    digest = (lambda c: F.substring(F.sha2(c, 256), 1, 2)) if weak else exact_dedup.sha256
    got = exact_dedup.exact_groups(spark, path, digest=digest).collect()
    import re

    text = {k: re.sub(r"[\x20\x09-\x0D]+", " ", t) for k, t in texts_of(docs).items()}
    group = defaultdict(list)
    for k, t in text.items():
        group[t].append(k)
    assert len(got) == len(text)
    for r in got:
        own = group[text[r.id]]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (min(own), len(own), r.id == min(own), hashlib.sha256(text[r.id].encode()).hexdigest())


def test_exact_empty_long_hot_and_clashing(spark, tmp_path):
    path = str(tmp_path / "in.parquet")
    schema = "doc_id long, text string, _metadata string, _digest int, _place int, _text string"
    rows = [(i, "same  text" if i % 3 == 0 else "z" * 300_000 if i % 50 == 1 else f"t {i}", "m", 1, 2, "x") for i in range(9000)]
    spark.createDataFrame(rows, schema).write.parquet(path)
    got = {r.id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(spark, path).collect()}
    assert len(got) == 9000 and all(got[i] == (0, 3000, i == 0) for i in range(0, 9000, 3)) and got[4][1] == 1
    long = [i for i in range(9000) if i % 50 == 1 and i % 3]
    assert all(got[i] == (min(long), len(long), i == min(long)) for i in long)
    spark.createDataFrame([], schema).write.parquet(f"{path}2")
    assert exact_dedup.exact_groups(spark, f"{path}2").count() == 0


def test_dealt_join_keeps_all(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"), "id")
    keyed = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.col("k") * 2)
    got = dealt_join(rows, keyed.drop("n"), "k", keyed.select("k", "n"), ["id"])
    assert got.columns == ["k", "id", "v"] and got.filter("v = 2 * k").distinct().count() == 30_000 == got.count()
    left = dealt_join(rows, keyed.filter("k < 250").drop("n"), "k", keyed.select("k", "n"), ["id"], "left")
    assert left.count() == 30_000 and left.filter("v IS NULL").count() == rows.filter("k >= 250").count()


def test_exact_goes_on_where_it_stopped(spark, tmp_path):
    path, state, seen = (str(tmp_path / n) for n in ("in.parquet", "state", "seen"))
    write = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("append").parquet(path)
    write([(5, "a"), (None, "a")])
    assert {(r.id, r.keep_id) for r in exact_dedup.exact_groups(spark, path, state_dir=state, seen_dir=seen).collect()} == {(5, 5), (None, 5)}
    write([(2, "a"), (2, "a"), (9, "b")])
    got = exact_dedup.exact_groups(spark, path, state_dir=state, seen_dir=seen, max_files=1).collect()
    assert sorted((r.id or 0, r.keep_id, r.group_size) for r in got) == [(0, 2, 4), (2, 2, 4), (2, 2, 4), (5, 2, 4), (9, 9, 1)]
    assert sum(r.kept for r in got) == 2


def test_probability_jaccard():
    a, b = {i: 1 + i % 3 for i in range(60)}, {i: 1 + i % 2 for i in range(20, 80)}
    owner = np.array([0] * 60 + [1] * 60)
    value = minhash_dedup.mix(np.array([*a, *b], np.uint64) + np.uint64(77))
    found = minhash_dedup.prob_minhash(owner, value, np.array([*a.values(), *b.values()], float), 2, 4096)
    exact = sum(1 / sum(max(a.get(y, 0) / a[x], b.get(y, 0) / b[x]) for y in {*a, *b}) for x in {*a} & {*b})
    assert abs((found[0] == found[1]).mean() - exact) < 0.03


def test_components(spark):
    links = [(i, i + 1) for i in range(40) if i % 10] + [(3, 77), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got[9] == 1 and got[77] == 1 and got[20] == 11 and 1 not in got


def test_warc(spark, tmp_path):
    rows = [(1, "http://a/", "x"), (2, None, "x"), (3, "http://c/\n", None), (4, "d", ""), (5, "e", "é" * 5000), (None, "f", "x"), (6, "g", "a\r\n\r\nWARC/1.1\r\n\r\n"), (7, "h", "y"), (7, "h", "y")]
    index, folder = warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = warc.read_records(index, folder).collect()
    assert len(got) == len(rows) and sum(r.type == "revisit" for r in got) == 3
    by = {r.record_id: r for r in got}
    assert by["<urn:page:2>"].refers_to == "<urn:page:1>" and by["<urn:page:>"].refers_to == "<urn:page:1>" and by["<urn:page:4>"].refers_to == "<urn:page:3>"
    assert by["<urn:page:5>"].payload_bytes == 10000 and by["<urn:page:5>"].payload_digest == base64.b32encode(hashlib.sha1(("é" * 5000).encode()).digest()).decode()
    from pathlib import Path

    lines = [x for p in Path(folder.removeprefix("file://")).glob("*.idx") for x in p.read_text().splitlines()]
    assert sorted(lines) == sorted(f"{r.offset}\t{r.length}\t{r.record_id}\t{r.type}" for r in index.collect())
    for p in Path(folder.removeprefix("file://")).glob("*.warc.gz"):
        assert gzip.decompress(p.read_bytes()).startswith(b"WARC/1.1")
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string"))[0].count() == 0


def test_warc_stream_of_members_and_large_records():
    records = [warc.record(i, "u", bytes([65 + i]) * n, "D", None, False) for i, n in enumerate((0, 10, 3_000_000))]
    for data in (gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))):
        sink = io.BytesIO()
        rows = list(warc.normalise_file(io.BytesIO(data), sink))
        assert [gzip.decompress(sink.getvalue()[o : o + n]) for o, n, *_ in rows] == records
    with pytest.raises(ValueError):
        list(warc.normalise_file(io.BytesIO(gzip.compress(records[1][:-20])), io.BytesIO()))


def test_quality(docs, empty, spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(12)] + [(20 + i, 0, 0) for i in range(2)] + [(3, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.score(docs, labels, carry=["doc_id"]).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.score(docs, labels.filter("quality = 1"), carry=["doc_id"]).select("score").distinct().collect()[0][0] == 0.5
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and quality.accepted(empty, labels).count() == 0


def test_quality_held_out():
    r = random.Random(4)
    good = [prose(r.randint(30, 200), r).capitalize() + "." for _ in range(150)]
    bad = [" ".join(w.upper() + "!!" for w in prose(r.randint(30, 200), r).split()) for _ in range(75)] + [" ".join([r.choice(WORDS)] * 90) for _ in range(75)]
    f, y = np.array([quality.features(t) for t in good + bad]), np.array([1] * 150 + [0] * 150)
    train = np.arange(300) % 5 != 0
    model = quality.fit(f[train], y[train])
    assert ((model.scores(f[~train]) >= quality.CUT) == (y[~train] == 1)).mean() > 0.95


def test_mixing(docs, empty, spark):
    mixed = mixing.mix(docs, carry=["doc_id"]).collect()
    total = sum(r.size for r in mixed)
    size = {k: len(t.split()) for k, t in texts_of(docs).items()}
    assert len(mixed) == len(size) and all(r.taken <= 3 * r["size"] and r["size"] == size[r.row.doc_id] for r in mixed)
    by = defaultdict(list)
    for r in mixed:
        by[(r.source_size, r.target)].append(r)
    assert abs(sum(t for _, t in by) - total) < 1e-6
    for (s, t), rows in by.items():
        assert t <= 3 * s + 1e-9 and abs(sum(r.taken for r in rows) - t) <= max(r["size"] for r in rows)
    assert sorted(map(str, mixing.mix(docs.repartition(7), carry=["doc_id"]).collect())) == sorted(map(str, mixed))
    again = mixing.mixed_documents(docs)
    assert again.columns == docs.columns and again.count() == sum(r.copies for r in mixed)
    assert mixing.mix(empty).count() == 0 and mixing.mix(docs.filter("text IS NULL")).agg(F.sum("taken")).first()[0] == 0


def test_filter_loses_nothing(spark):
    rows = spark.range(2000).select(F.xxhash64("id").alias("k"), "id")
    keys = rows.filter("id % 97 = 0").select("k")
    got = may_be_among(rows, "k", keys)
    assert got.columns == rows.columns and got.filter("id % 97 = 0").count() == keys.count() and got.count() < 60


def test_urls(spark):
    html = "<p>red house blue garden river red house blue garden river</p><script>var spamword</script>"
    urls = [None, "no scheme", "http://RedHouse.example.net", "http://x.example.net/en/1", "https://a.net/", "https://example.com/de/1?x", "https://u.org/fr/2#y", "https://spam-bluegarden.org/en/7", "http://redhouse.com/en/8", "http://net/", "http://h.com?q=/", "ftp://example.org/fr"] + ["http://garden%d.com/en/%d" % (i % 3, i) for i in range(40)] + ["http://spamriver.com/en/1"] * 3
    pages = spark.createDataFrame([(i, u, html if i % 2 else None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert len(got) == len(urls)
    assert (got[0].host, got[0].path, got[0].rule) == ("", "", None) and got[1].host == ""
    assert (got[2].host, got[2].path, got[2].rule) == ("redhouse.example.net", "", None)
    assert [(got[i].rule, got[i].verdict) for i in (3, 4, 5, 6, 9)] == [("example.net/en/", "allow"), ("net/", "block"), ("example.com/de/", "block"), ("org/fr/", "allow"), ("net/", "block")]
    assert (got[10].host, got[10].path) == ("h.com", "") and got[11].rule is None
    assert got[7].verdict == "block" and got[8].verdict == "allow" and got[54].verdict == "block" and got[20].verdict == "allow"
    split = url_filter.segment(spark.createDataFrame([("redhouse",), ("bluegardenriver",), ("spamhouse",)], "name string"), url_filter.word_counts(pages, "html"))
    assert {r.name: r.words for r in split.collect()} == {"redhouse": ["red", "house"], "bluegardenriver": ["blue", "garden", "river"], "spamhouse": ["spam", "house"]}
    assert url_filter.judge(pages.filter("false")).count() == 0


def test_viterbi_is_best():
    import math
    from itertools import product

    counts, total = {"a": 5, "ab": 9, "b": 2, "bc": 7, "abc": 3}, 30

    def p(w):
        return math.log(counts[w] / total) if w in counts else math.log(10 / total) - len(w) * math.log(10)

    for name in ("abcab", "bcxab", "aabbcc"):
        known = {(i, j): counts[name[i:j]] for i in range(len(name)) for j in range(i + 1, len(name) + 1) if name[i:j] in counts}
        cuts = ([name[i:j] for i, j in zip([0, *c], [*c, len(name)])] for c in ([i for i, k in enumerate(m, 1) if k] for m in product((0, 1), repeat=len(name) - 1)))
        assert math.isclose(sum(map(p, url_filter.viterbi(name, known, total))), max(sum(map(p, w)) for w in cuts))
