"""Token error rate and word differences."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from tallyloom.functions.text import stat_tokens
from tallyloom.session import ship


def distance(a: list[str], b: list[str]) -> int:
    """Edits (insert, delete, substitute: 1) from a to b, by bit vectors.

    A column of the table is two numbers of len(a) bits, which say where it rises and falls by one from row to row; a word
    of b takes a dozen operations on them, each over 64 rows and more at a time.
    """
    if not a or not b:
        return len(a) + len(b)
    places: dict[str, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    whole, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, far = whole, 0, len(a)
    for word in b:
        equal = places.get(word, 0)
        across = ((equal & up) + up ^ up) | equal
        rises, falls = down | whole & ~(across | up), up & across
        far += bool(rises & last) - bool(falls & last)
        rises, falls, across = rises << 1 | 1, falls << 1, equal | down
        up, down = (falls | ~(across | rises)) & whole, rises & across & whole
    return far


@F.pandas_udf(IntegerType())
def distance_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else distance(list(x), list(y)) for x, y in zip(a, b, strict=True)], dtype="Int32")


def wer(reference: Column, hypothesis: Column) -> Column:
    """Edits per reference token, rounded to 4 digits; null without a reference, 0 if it has no tokens."""
    ship(SparkSession.active())
    r, h = stat_tokens(reference), stat_tokens(hypothesis)
    blank = F.coalesce(F.trim(reference), F.lit("")) == ""
    far = F.coalesce(distance_udf(F.when(r != h, r), h), F.lit(0))  # equal texts aren't handed to Python
    rate = F.when(F.size(r) == 0, 0.0).otherwise(far / F.size(r))
    return F.when(~blank, F.round(rate, 4))


def wer_native(reference: Column, hypothesis: Column) -> Column:
    """The same distance with array functions alone; slower, kept to check the other."""
    r, h = stat_tokens(reference), stat_tokens(hypothesis)
    first = F.transform(F.sequence(F.lit(0), F.size(h)), lambda i: i)

    def row(held: Column, word: Column) -> Column:
        def cell(acc: Column, j: Column) -> Column:
            cost = F.when(F.get(h, j - 1) == word, 0).otherwise(1)
            return F.concat(acc, F.array(F.least(F.element_at(acc, -1) + 1, F.get(held, j) + 1, F.get(held, j - 1) + cost)))

        steps = F.when(F.size(h) > 0, F.sequence(F.lit(1), F.size(h))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, F.array(F.get(held, F.lit(0)) + 1), cell)

    return F.element_at(F.aggregate(r, first, row), -1)


DIFF = ArrayType(StructType().add("word", StringType()).add("type", StringType()))


@F.arrow_udf(DIFF)
def word_diff_udf(a: pa.Array, b: pa.Array) -> pa.Array:
    """Built as Arrow columns some thousand words at a time: a batch's words are never Python objects all together."""
    parts, words, marks, offsets = [], [], [], [0]

    def close() -> None:
        parts.append((pa.array(words, pa.string()), pa.array(["changed", "same"]).take(pa.array(marks, pa.int8()))))
        words.clear()
        marks.clear()

    for x, y in zip(a, b, strict=True):
        told = word_diff(x.as_py() or "", y.as_py() or "")
        words += [w for w, _ in told]
        marks += [int(t == "same") for _, t in told]
        offsets.append(offsets[-1] + len(told))
        if len(words) >= 1 << 15:
            close()
    close()
    held = pa.StructArray.from_arrays([pa.concat_arrays([p[i] for p in parts]) for i in (0, 1)], names=["word", "type"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), held)


def word_changes(current: Column, suggested: Column) -> Column:
    """The words of the suggestion, each with type 'same' or 'changed' against the current text."""
    ship(SparkSession.active())
    return word_diff_udf(current, suggested)


def common_rows(a: list[str], b: list[str]) -> list[int]:
    """For each number i of a's last words a bit vector over b's words from the last: bit j is 0 where one word more of b
    makes the longest common subsequence longer by one."""
    places: dict[str, int] = {}
    for j, word in enumerate(reversed(b)):
        places[word] = places.get(word, 0) | 1 << j
    whole = row = (1 << len(b)) - 1
    rows = [row]
    for word in reversed(a):
        both = row & places.get(word, 0)
        row = (row + both | row - both) & whole
        rows.append(row)
    return rows


def word_diff(a: str, b: str) -> list[tuple[str, str]]:
    """Words of b, in order, as (word, 'same' or 'changed') by a longest common subsequence, case aside."""
    left, right = a.lower().split(), b.lower().split()
    rows = common_rows(left, right)

    def best(i: int, j: int) -> int:
        """Length of the longest common subsequence of left[i:] and right[j:]."""
        n = len(right) - j
        return n - (rows[len(left) - i] & (1 << n) - 1).bit_count()

    i, out = 0, []
    for j, word in enumerate(b.split()):
        while i < len(left) and left[i] != right[j] and best(i + 1, j) >= best(i, j + 1):
            i += 1
        same = i < len(left) and left[i] == right[j]
        i += same
        out.append((word, "same" if same else "changed"))
    return out
