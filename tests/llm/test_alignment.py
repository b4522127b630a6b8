import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import token_alignment

DOCS = "doc_id long, text string"


def own_sides():
    return token_alignment.sides(*token_alignment.default_paths())


def brute(texts):
    """Every text encoded whole by both libraries, links counted one by one."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path, _ = token_alignment.default_paths()
    side_a, side_b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    side_a.encode_special_tokens = True
    letters = {c: b for b, c in token_alignment.byte_letters().items()}
    docs, count = [], Counter()
    for text in texts:
        links, groups, a, b = Counter(), [], [], []
        if text:
            a = [(i, bytes(letters[c] for c in side_a.id_to_token(i))) for i in side_a.encode(f" {text}", add_special_tokens=False).ids]
            b = [(i, bytes([int(p[3:-1], 16)]) if side_b.is_byte(i) else p.replace("▁", " ").encode()) for i in side_b.encode(text) for p in [side_b.id_to_piece(i)]]
            raw = f" {text}".encode()
            if any(b"".join(x for _, x in side) != raw for side in (a, b)):
                a, b = [], []
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in (a, b)]
        common = sorted(set(ends[0]) & set(ends[1])) if a else []
        before = 0
        for end in common:
            own = [[i for (i, _), e in zip(side, es, strict=True) if before < e <= end] for side, es in zip((a, b), ends, strict=True)] if len(common) < 300 else None
            groups.append((before, end, own))
            before = end
        if groups and groups[0][2] is None:
            at, told = [0, 0], []
            for begin, end, _ in groups:
                own = []
                for k, side in enumerate((a, b)):
                    stop = at[k]
                    while stop < len(side) and ends[k][stop] <= end:
                        stop += 1
                    own.append([i for i, _ in side[at[k] : stop]])
                    at[k] = stop
                told.append((begin, end, own))
            groups = told
        for _, _, (x, y) in groups:
            for i in x:
                for j in y:
                    links[i, j] += 1
        count.update(links.keys())
        listed = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for _, _, (x, y) in groups)
        docs.append((len(a), len(b), len(groups), links, listed))
    most = defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    out = []
    for n_a, n_b, n_groups, links, listed in docs:
        best = sum(m for (i, j), m in links.items() if count[i, j] == most[i])
        total = sum(m * count[p] for p, m in links.items())
        out.append((n_a, n_b, n_groups, sum(links.values()), best, total, listed))
    return out, count


def corpus():
    rng = random.Random(8)
    parts = ["the", "thention,", "Aioè", "é", "ß-straße", "don't", "I'll", "x1y22", "2024", "…", "日本語の", "🎉🎉", "naïve", "a\nb", "end.\n", "\n\n", "\t", " ", "　", "", "", "  ", "<|endoftext|>", "<s>", "<unk>", "</s>", "<0x41>", "\u0085x", "é", "🇩🇪", "ǅ", "​", "Ⅷ", "½", "٣٤", "क्षि", "\x00", "\x1c", "\r\n", "﻿", "ɐ", "－"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    texts += ["".join(rng.choice(parts) for _ in range(30)) for _ in range(40)]
    texts += [None, "", " ", "  ", "\n", "a", " a", "a ", "a▁b", "▁", "x  y   z ", "ab" * 3000, "日本" * 2000, " " * 500, "🎉" * 700, "the of " * 3000, texts[0], texts[0]]
    return texts


def test_alignment_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK_CHARS", 4000)
    monkeypatch.setattr(token_alignment, "GROUP_POSTINGS", 60)
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3)
    df = df.withColumns({c: F.lit("z") for c in ("n_a", "block", "bucket", "groups", "id", "n_best")})
    own = token_alignment.Alignment(df)
    want, count = brute(texts)
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in own.documents().collect()}
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        assert got[i] == w, texts[i]
    assert {(r.a, r.b): r.docs for r in own.pairs().collect()} == dict(count)
    told = {r.doc_id: r.groups for r in token_alignment.Alignment(df, digest=True).documents().collect()}
    assert told == {i: hashlib.sha256(w[6].encode()).hexdigest() if w[0] else "" for i, w in enumerate(want)}
    whole = token_alignment.Alignment(df, a_path=token_alignment.default_paths()[0])  # without ranks
    assert {r.doc_id: r.groups for r in whole.documents().collect()} == {i: w[6] for i, w in enumerate(want)}


def test_bounds_of_a_task_change_nothing(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(corpus()[:120])), DOCS).coalesce(1)
    rows = lambda: sorted(map(tuple, token_alignment.Alignment(df).documents().collect()))
    want = rows()
    for name, value in [("MOST_KNOWN", 10), ("BLOCK_CHARS", 300), ("MOST_KNOWN_CHARS", 1), ("COUNTS_A_STEP", 5)]:
        monkeypatch.setattr(token_alignment, name, value)
    assert rows() == want


def test_steps_within_a_block_change_nothing(monkeypatch):
    own, texts = own_sides(), [t for t in corpus()[-20:] if t]

    def told():
        known = token_alignment.Known(own)
        codes = known.numbers(texts)
        listed = [";".join(known.texts[c] for c in x) for x in codes]
        key, links = token_alignment.document_pairs(known, codes, len(texts))
        return listed, key.tolist(), links.tolist()

    want = told()
    monkeypatch.setattr(token_alignment, "PIECES_A_STEP", 7)
    assert told() == want
    monkeypatch.setattr(token_alignment, "PLAIN_LINKS", 1)
    assert told() == want
    monkeypatch.setattr(own, "may_cut", False)
    assert told() == want


def test_both_byte_level_libraries_agree():
    own = own_sides()
    rng = random.Random(2)
    letters = [c for c in map(chr, range(0x250)) if token_alignment.PLAIN(c) and c != " "]
    pieces = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(4000)]
    slow = own.a.encode_batch([f" {p}" for p in pieces], add_special_tokens=False)
    assert own.encode(pieces)[0] == [e.ids for e in slow]


def test_odd_documents(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "a b"), (None, None), (2, "")]
    got = token_alignment.Alignment(spark.createDataFrame(rows, DOCS)).documents().collect()
    assert sorted((r.doc_id or 0, r.n_links, r.n_best, r.count_sum) for r in got) == [(0, 0, 0, 0), (0, 2, 2, 6), (1, 2, 2, 6), (1, 2, 2, 6), (2, 0, 0, 0)]
    empty = token_alignment.Alignment(spark.createDataFrame([], DOCS))
    assert empty.documents().count() == 0 and empty.pairs().count() == 0
    nothing = token_alignment.Alignment(spark.createDataFrame([(3, None), (4, "")], DOCS))
    assert sorted(tuple(r) for r in nothing.documents().collect()) == [(3, 0, 0, 0, 0, "", 0, 0), (4, 0, 0, 0, 0, "", 0, 0)]


@pytest.mark.parametrize("n", [40_000])
def test_long_text(spark, n):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("aeiounrst") for _ in range(rng.randrange(1, 9))) for _ in range(n))
    (row,) = token_alignment.Alignment(spark.createDataFrame([(1, text)], DOCS)).documents().collect()
    (want,), _ = brute([text])
    assert (row.n_a, row.n_b, row.n_groups, row.n_links, row.n_best, row.count_sum, row.groups) == want
