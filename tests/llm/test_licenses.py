import random
import re

from pyspark.sql import functions as F

from tallyloom.llm import license_scan
from tallyloom.llm.license_rules import BASE, rules_of

RULES = rules_of()
DOCS = "doc_id long, text string"


def sample(rng, items):
    """A random string that a parsed pattern matches."""
    out = ""
    for op, arg in items:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "NOT_LITERAL":
            out += rng.choice("abcxyz019")
        elif name == "IN":
            kinds = [a for a in arg if str(a[0]) in ("LITERAL", "RANGE", "CATEGORY")]
            kind, value = rng.choice(kinds)
            out += chr(value) if str(kind) == "LITERAL" else chr(rng.randint(*value)) if str(kind) == "RANGE" else rng.choice("0123456789")
            if any(str(a[0]) == "NEGATE" for a in arg):
                out = out[:-1] + rng.choice("abcxyz019")
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = arg
            for _ in range(rng.randint(low, min(high, low + 12))):
                out += sample(rng, inner)
        elif name == "SUBPATTERN":
            out += sample(rng, arg[3])
        elif name == "BRANCH":
            out += sample(rng, rng.choice(arg[1]))
        elif name == "CATEGORY":
            out += rng.choice("0123456789")
        else:
            raise ValueError(name)
    return out


def matches(n, seed):
    rng = random.Random(seed)
    return [(r, sample(rng, re._parser.parse(r.pattern))) for r in RULES for _ in range(n)]


def brute(text):
    """Every phrase and every rule at every word, without keywords, segments or sweeps."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    base = [(i, p) for p in BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    found = []
    for k, r in enumerate(RULES):
        own = re.compile(f"(?:{r.pattern})(?= )")
        for i in range(len(words)):
            m = own.match(" ".join(words[i : i + 80]) + " ")
            if m:
                found.append((i, i + m[0].count(" "), k))
    stronger = lambda e, d: (RULES[e[2]].priority, e[1] - e[0], -e[2]) > (RULES[d[2]].priority, d[1] - d[0], -d[2])
    kept = [d for d in found if not any(e[0] <= d[0] and e[1] >= d[1] and stronger(e, d) for e in found)]
    labels = {RULES[d[2]].label for d in kept} | {BASE[p] for _, p in base}
    doubt = {}
    for label, priority in [*((RULES[d[2]].label, RULES[d[2]].priority) for d in kept), *((BASE[p], 4) for _, p in base)]:
        doubt[label] = min(doubt.get(label, 1.0), 1 - priority / 10)
    left = 1.0
    for label in sorted(doubt):
        left *= doubt[label]
    starts = [i for i, _ in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({BASE[p] for _, p in base})), ",".join(sorted(labels)), 1 - left)


def test_rules_are_sound():
    assert len(RULES) > 250
    for r, text in matches(12, 1):
        assert re.fullmatch(r.pattern, text), r
        assert r.words <= set(text.encode().split()), (r, text)
        assert len(text.split()) <= license_scan.MOST_WORDS and "  " not in f" {text} ", (r, text)
        assert 0 < r.priority < 10


def corpus():
    rng = random.Random(6)
    filler = ["the", "Of", "license", "gpl", "public", "GNU", "version", "2", "3.0", "mit", "BSD", "é", "naïve", "_x_", "cc", "by", "…", "Apache", "under"]
    marks = [" ", ", ", " - ", "\n", ".\t", "_", "  "]
    samples = [t for _, t in matches(2, 3)]
    texts = []
    for _ in range(120):
        parts = [rng.choice(samples) if rng.random() < 0.3 else rng.choice(filler) for _ in range(rng.randrange(1, 40))]
        text = "".join(p + rng.choice(marks) for p in parts)
        texts.append(text.upper() if rng.random() < 0.2 else text)
    texts += [None, "", " ", "...", "MIT License", "mit licensed", "xmit license", "GNU GENERAL PUBLIC LICENSE", "İMIT License", "MIT’s License", "mit license " * 50, "CC BY CC BY-SA 4.0 CC-BY", "cc by", "CC by by", "\x00mit\x00license"]
    return [*texts, "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."]


def rows_of(df):
    out = license_scan.scan_licenses(df)
    base = lambda r: [f for f in r.found if f.base]
    told = {}
    for r in out.collect():
        starts = [f.first_word for f in base(r)]
        told[r.doc_id] = (r.n_words, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted({f.label for f in base(r)})), ",".join(sorted({f.label for f in r.found if f.kept})), r.score)
    return told


def test_scan_equals_brute_force(spark, tmp_path):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3).withColumns({c: F.lit("q") for c in ("id", "found", "labels", "n_words", "base")})
    want = {i: brute(t) for i, t in enumerate(texts)}
    got = rows_of(df)
    assert all(got[i] == want[i] for i in want), next((texts[i], got[i], want[i]) for i in want if got[i] != want[i])
    # the query's columns say the same
    df.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    told = license_scan.op13_license_scan(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in told} == want


def test_segments_change_nothing(monkeypatch):
    own = license_scan.scanner(tuple(RULES), tuple(BASE.items()))
    text = " ".join(t or "" for t in corpus()).encode()
    want = own.told(text)
    for size in (1, 40, 1000):
        monkeypatch.setattr(license_scan, "SEGMENT", size)
        assert own.told(text) == want


def test_odd_documents(spark):
    rows = [(1, "MIT license"), (1, "MIT license"), (None, "mit  LICENSE"), (2, None)]
    got = license_scan.scan_licenses(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id or 0, r.n_words, len(r.found)) for r in got) == [(0, 2, 1), (1, 2, 1), (1, 2, 1), (2, 0, 0)]
    assert license_scan.scan_licenses(spark.createDataFrame([], DOCS)).count() == 0
    long = "word " * 600_000 + "MIT License " + "x" * 3_000_000 + " apache license"
    (row,) = license_scan.scan_licenses(spark.createDataFrame([(1, long)], DOCS)).collect()
    assert row.n_words == 600_005 and [f.first_word for f in row.found if f.base] == [600_000, 600_003]


def test_specific_labels_win(spark):
    texts = ["licensed under the GNU General Public License version 2 or later", "Apache License, Version 2.0", "under the Foo Bar license", "licensed under the Foo Bar license"]
    got = {r.doc_id: sorted({f.label for f in r.found if f.kept and not f.base}) for r in license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    assert got == {0: ["gpl-2.0-or-later", "notice"], 1: ["apache-2.0"], 2: [], 3: ["notice"]}
