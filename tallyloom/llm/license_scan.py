"""License scans by ordered signature rules: hundreds of patterns, gated by keywords, with priorities and suppression.

A text's words, in lower case with one blank between them, are searched for the phrases of a base scan and by the rules
of license_rules. A rule's pattern runs only where all of its words occur. Every start at which a pattern matches is a
detection (its greedy match); one that lies within another of higher priority, or as high and longer, or as high, as
long and earlier in the table, is suppressed. Base phrases always count. Texts are read in segments of whole words with
the words behind them that a match may reach, so that long texts need no more memory than their bytes and a segment.

Defined cases: null counts as empty; empty texts have no words, no places and score 0; rows of one id are documents of
their own; equal texts give equal results; the same place may count for several phrases; very long texts are read whole;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import text_of
from tallyloom.llm.license_rules import BASE, Rule, rules_of
from tallyloom.session import ship, table

#: Bytes of text whose words are searched at a time.
SEGMENT = 1 << 20
#: No pattern matches more words than this.
MOST_WORDS = 64
#: Documents of a batch of results.
DOCS_A_STEP = 512
#: ASCII bytes that are no letter or digit part words; A to Z become small.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: A label is right with a tenth of its priority, base phrases as names (4); the score is that one of them is right.
BASE_PRIORITY = 4


class Scanner:
    """The rules compiled, by the word of each that stands first in their order of spelling."""

    def __init__(self, rules: Sequence[Rule], base: dict[str, str]):
        self.rules, self.base = rules, base
        self.patterns = [re.compile(rb" (?=((?:%b)) )" % r.pattern.encode()) for r in rules]
        self.by_word: dict[bytes, list[int]] = {}
        for i, r in enumerate(rules):
            self.by_word.setdefault(min(r.words, key=lambda w: (-len(w), w)), []).append(i)  # long words are rare
        self.gates = set(self.by_word)
        self.phrases = [(b" %b " % p.encode(), label, frozenset(p.encode().split())) for p, label in base.items()]

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, int]]]:
        """(number of words, detections): first and last word, and number of the rule; -1 - k stands for base phrase k."""
        low, at, n, found = text.translate(FOLD), 0, 0, []
        while at < len(low):
            end = low.find(b" ", at + SEGMENT)
            end = len(low) if end < 0 else end
            words = low[at:end].split()
            ahead = low[end:].split(None, MOST_WORDS)[:MOST_WORDS] if end < len(low) else []
            found += [(a + n, b + n, r) for a, b, r in self.detect(words, ahead)]
            n, at = n + len(words), end
        return n, found

    def detect(self, words: list[bytes], ahead: list[bytes]) -> list[tuple[int, int, int]]:
        have = set(words)
        have.update(ahead)
        rules = [i for w in self.gates & have for i in self.by_word[w] if self.rules[i].words <= have]
        phrases = [k for k, p in enumerate(self.phrases) if p[2] <= have]
        if not rules and not phrases:
            return []
        joined = b" %b " % b" ".join(words + ahead)
        blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        spans = []
        for k in phrases:
            phrase, at = self.phrases[k][0], -1
            while (at := joined.find(phrase, at + 1)) >= 0:
                spans.append((at, at + len(phrase) - 1, -1 - k))
        for i in rules:
            spans += [(m.start(), m.end(1), i) for m in self.patterns[i].finditer(joined)]
        if not spans:
            return []
        first, last = (np.searchsorted(blanks, [s[k] for s in spans]) for k in (0, 1))
        return [(a, b - 1, s[2]) for a, b, s in zip(first.tolist(), last.tolist(), spans, strict=True) if a < len(words)]

    def rank(self, found: tuple[int, int, int]) -> tuple[int, int, int]:
        return (self.rules[found[2]].priority, found[1] - found[0], -found[2])

    def kept(self, found: list[tuple[int, int, int]]) -> list[bool]:
        """Whether each detection is not suppressed; base phrases stay, and suppress nothing."""
        order = sorted((i for i, f in enumerate(found) if f[2] >= 0), key=lambda i: (found[i][0], -found[i][1]))
        out, active = [f[2] < 0 for f in found], []
        for place, i in enumerate(order):
            a, b, _ = found[i]
            active = [j for j in active if found[j][1] >= a]
            same = [j for j in order[place + 1 : place + 1 + len(self.rules)] if found[j][:2] == (a, b)]
            out[i] = not any(found[j][1] >= b and self.rank(found[j]) > self.rank(found[i]) for j in [*active, *same])
            active.append(i)
        return out

    def told(self, text: bytes) -> dict:
        """The row of one text: n_words, found and score."""
        n, found = self.scan(text)
        found.sort(key=lambda f: (f[0], f[1], f[2]))
        rows, doubt = [], {}
        for (a, b, r), kept in zip(found, self.kept(found), strict=True):
            label, priority = (self.rules[r].label, self.rules[r].priority) if r >= 0 else (self.phrases[-1 - r][1], BASE_PRIORITY)
            rows.append({"label": label, "priority": priority, "first_word": a, "last_word": b, "base": r < 0, "kept": kept})
            if kept:
                doubt[label] = min(doubt.get(label, 1.0), 1 - priority / 10)
        left = 1.0
        for label in sorted(doubt):
            left *= doubt[label]
        return {"n_words": n, "found": rows, "score": 1 - left}


FOUND = "array<struct<label: string, priority: int, first_word: bigint, last_word: bigint, base: boolean, kept: boolean>>"
FOUND_TYPE = pa.list_(pa.struct([("label", pa.string()), ("priority", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base", pa.bool_()), ("kept", pa.bool_())]))


@functools.lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...], base: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(rules, dict(base))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] | None = None, base: dict[str, str] | None = None) -> DataFrame:
    """(id_col, n_words, found, score): every detection with its words, and whether it is kept, one row for each document."""
    ship(docs.sparkSession)
    own = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    id_type = own.schema["id"].dataType.simpleString()
    held, phrases = tuple(rules_of() if rules is None else rules), tuple((BASE if base is None else base).items())

    def scan(batches):
        scan_one = scanner(held, phrases).told
        for whole in batches:
            for first in range(0, whole.num_rows, DOCS_A_STEP):
                batch = whole.slice(first, DOCS_A_STEP)
                rows = [scan_one(t.as_buffer().to_pybytes()) for t in batch.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array([r["n_words"] for r in rows], pa.int64()), pa.array([r["found"] for r in rows], FOUND_TYPE), pa.array([r["score"] for r in rows], pa.float64())],
                    names=["id", "n_words", "found", "score"],
                )

    return own.mapInArrow(scan, f"id {id_type}, n_words bigint, found {FOUND}, score double").withColumnRenamed("id", id_col)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda f: f["base"])
    listed = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda f: f["label"]))), ",")
    starts = F.transform(base, lambda f: f["first_word"])
    return out.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        listed(base).alias("base_labels"), listed(F.filter("found", lambda f: f["kept"])).alias("labels"), "score",
    )


QUERIES = {"op13_license_scan": op13_license_scan}
