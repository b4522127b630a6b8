import hashlib
import random

import pytest

from tallyloom.llm import line_dedup

WORDS = [a + b for a in ("th", "er", "on", "in", "é") for b in ("a", "o", "le", "ß", "nd", "st", "x")]
r = random.Random(17)


def line(n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def corpus():
    shared = [[line(r.randint(1, 40)) for _ in range(n)] for n in (1, 2, 2, 3, 3, 4, 6, 9, 14)] + [[line(70)], [line(60)]]
    short = [line(r.randint(1, 6)) for _ in range(8)]
    docs = [None, "", "", "a", "\n\n", line(5000)]
    for _ in range(120):
        lines = []
        for _ in range(r.randint(1, 5)):
            kind = r.random()
            lines += r.choice(shared) if kind < 0.4 else [r.choice(short)] if kind < 0.6 else [line(r.randint(1, 50)) for _ in range(r.randint(1, 3))]
        docs.append("\n".join(lines))
    docs += [docs[20], docs[20], "\n".join(["x y z"] * 300), "\n".join(line(2) for _ in range(2000))]
    return docs


def pieces(lines):
    """(first, last) of chunks of several lines, and of the shortest windows of over 50 words."""
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    roll = [sum(h[i - k] * pow(line_dedup.BASE, k, line_dedup.PRIME) for k in range(line_dedup.ROLL) if i >= k) % line_dedup.PRIME for i in range(len(h))]
    found, begin = set(), 0
    for i in range(len(lines)):
        if i == len(lines) - 1 or i > 0 and roll[i] < roll[i - 1] and roll[i] <= roll[i + 1]:
            if i > begin:
                found.add((begin, i))
            begin = i + 1
    for i in range(len(lines)):
        words = 0
        for j in range(i, len(lines)):
            words += lines[j].count(" ") + 1
            if words > 50:
                found.add((i, j))
                break
    return sorted(found)


def brute(texts):
    """(kept text, lines removed) of each text, in order of precedence."""
    seen, out = {}, []
    for d, text in enumerate(texts):
        lines, gone = (text or "").split("\n"), set()
        for i, j in pieces(lines):
            piece = "\n".join(lines[i : j + 1])
            if seen.setdefault(piece, (d, i)) != (d, i):
                gone |= set(range(i, j + 1))
        out.append(("\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", len(t or ""), "y", 1, "z") for i, t in enumerate(corpus())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, _text string, _line int, kept_text string").repartition(5)


def test_against_brute_force(docs):
    texts = [x.text for x in docs.orderBy("doc_id").collect()]
    want = brute(texts)
    got = {x.row.doc_id: x for x in line_dedup.dedup_lines(docs, carry=["doc_id"]).collect()}
    assert len(got) == len(texts) and sum(n > 0 for _, n in want) > 40
    for d, (kept, n) in enumerate(want):
        assert (got[d].kept_text, got[d].n_removed, got[d].n_lines) == (kept, n, len((texts[d] or "").split("\n"))), d


def test_every_long_run_that_stands_earlier_goes(docs):
    texts = [x.text or "" for x in docs.orderBy("doc_id").collect()]
    got = {x.row.doc_id: x.kept_text for x in line_dedup.dedup_lines(docs, carry=["doc_id"]).collect()}
    earlier, runs = "", 0
    for d, text in enumerate(texts):
        lines = text.split("\n")
        for i in range(len(lines)):
            for j in range(i, min(i + 4, len(lines))):
                run = "\n".join(lines[i : j + 1])
                if run.count(" ") + j - i >= 50 and f"\n{run}\n" in earlier:
                    runs += 1
                    assert f"\n{run}\n" not in f"\n{got[d]}\n"
        earlier += f"\n{text}\n"
    assert runs > 100


def test_cases(spark, docs):
    left = line_dedup.deduplicated(docs)
    assert left.columns == docs.columns and left.filter("n_chars <> length(text)").count() == 0
    assert line_dedup.deduplicated(docs.filter("false")).count() == 0
    twice = spark.createDataFrame([(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "a\nb\nc"), (None, "a\nb\nc"), (None, None)], "doc_id long, text string")
    got = sorted((x.row.doc_id or 0, x.n_removed, x.kept_text) for x in line_dedup.dedup_lines(twice).collect())
    assert got == [(0, 0, ""), (0, 3, ""), (0, 3, ""), (1, 0, "a\nb\nc"), (1, 0, "a\nb\nc")]
    hot = spark.range(9000).selectExpr("id AS doc_id", "concat('own ', id, '\n', repeat('word ', 60), '\nend ', id) AS text")
    assert {x.n_removed: x["count"] for x in line_dedup.dedup_lines(hot).groupBy("n_removed").count().collect()} == {0: 1, 1: 8999}
