"""Quality classifier: a Bradley-Terry ranking learnt from preference pairs.

Each document is described by shares and counts that don't depend on its language or source. Of the labelled training
rows, every preferred row is paired with others; weights w minimise the logistic loss of w . (f_preferred - f_other),
so that w . f is a document's worth. The threshold on the worth is its quantile, among the training rows, at the share
of rows labelled 0; scores are logistic in the distance from it and equal CUT there.

Defined cases: a null text is an empty text and gets a score like any other; without training rows of both labels all
scores are 0.5; rows with a null label are not trained on, and of several labels for a row the lowest counts; repeated
rows are scored alike; an empty table gives an empty result; other columns are carried along untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import free_name, text_of
from tallyloom.session import ship, table

#: Labelled rows that the model is fitted on, at most; the documents scored are never sampled.
MOST_TRAINING_ROWS = 6000
#: Preference pairs for each training row.
PAIRS_A_ROW = 24
CUT = 0.3
SYMBOLS = b"#$%&*!|^~@<>{}[]=+_\\/"
STOPS = b".,;:'\"?-()"


def features(text: str) -> list[float]:
    raw = text.encode()
    n = max(len(raw), 1)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = count / n
    letters = max(count[65:91].sum() + count[97:123].sum() + count[128:].sum() / 2, 1)
    words = text.split()
    m = max(len(words), 1)
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x]
    k = max(len(lines), 1)
    own = set(lines)
    triples = set(zip(words, words[1:], words[2:], strict=False))
    entropy = -float((share[share > 0] * np.log2(share[share > 0])).sum())
    symbols = float(share[list(SYMBOLS)].sum())
    upper = float(count[65:91].sum() / letters)
    return [
        upper, min(upper, 0.2), symbols, min(symbols, 0.03), float(share[list(STOPS)].sum()), float(share[48:58].sum()),
        float(share[[9, 10, 11, 12, 13, 32]].sum()), float(share[128:].sum()), np.log1p(len(words)), len(text) / m / 10,
        len(seen) / m, len(seen) / m**0.5 / 10, max(seen.values(), default=0) / m,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / m, len(triples) / m,
        1 - len(own) / k, 1 - sum(map(len, own)) / max(sum(map(len, lines)), 1),
        sum(x[-1] in ".!?" for x in lines) / k, entropy / 8, np.log1p(len(lines)) / 5, min(m / 10, 1.0),
    ]


N_FEATURES = len(features(""))


@dataclass(frozen=True)
class Ranking:
    """Worth of features f: ((f - mean) / spread) . weights; threshold: the worth whose score is CUT."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float

    def worth(self, f: np.ndarray) -> np.ndarray:
        return ((f - self.mean) / self.spread) @ self.weights

    def scores(self, f: np.ndarray) -> np.ndarray:
        if not self.weights.any():
            return np.full(len(f), 0.5)
        z = np.clip(self.worth(f) - self.threshold, -30, 30) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-z))


def fit(f: np.ndarray, label: np.ndarray, pairs_a_row: int = PAIRS_A_ROW, ridge: float = 1e-3) -> Ranking:
    """Newton's method on the pairs' logistic loss; pairs are fixed by a seed."""
    mean, spread = f.mean(0) if len(f) else np.zeros(N_FEATURES), f.std(0) + 1e-6 if len(f) else np.ones(N_FEATURES)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return Ranking(mean, spread, np.zeros(N_FEATURES), 0.0)
    rng, z = np.random.default_rng(7), (f - mean) / spread
    n = pairs_a_row * len(f)
    x = z[rng.choice(good, n)] - z[rng.choice(bad, n)]
    w = np.zeros(f.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(x @ w, -30, 30)))
        slope = ridge * w - x.T @ p / n
        bend = (x * (p * (1 - p))[:, None]).T @ x / n + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 4 / (np.abs(step).max() + 1e-9))
    return Ranking(mean, spread, w, float(np.quantile(z @ w, len(bad) / len(f))))


def with_features(docs: DataFrame, text_col: str, out: str, model: Ranking | None, carry: list[str]) -> DataFrame:
    """The carried columns and, under the name out, each text's features, or with a model its score."""
    ship(docs.sparkSession)
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)], text_of(text_col).alias("text"))
    kept = ", ".join(f"c{i} {rows.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(carry)))

    def work(batches):
        for batch in batches:
            f = np.array([features(t) for t in batch.column("text").to_pylist()]).reshape(-1, N_FEATURES)
            found = pa.array(model.scores(f)) if model else pa.array(list(f), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], [*batch.schema.names[:-1], "found"])

    done = rows.mapInArrow(work, f"{kept + ', ' if kept else ''}found {'double' if model else 'array<double>'}")
    return done.toDF(*carry, out)


def training_rows(labels: DataFrame, id_col: str, label_col: str, held_out: int = 5) -> DataFrame:
    """At most MOST_TRAINING_ROWS labelled rows outside the held-out fold, by the order of a hash of the id."""
    own = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    own = own.filter(F.crc32(F.col(id_col).cast("string")) % held_out != 0)
    own = own.groupBy(F.col(id_col).alias("_label_id")).agg(F.min(label_col).alias("_label"))
    return own.orderBy(F.xxhash64("_label_id"), "_label_id").limit(MOST_TRAINING_ROWS)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Ranking:
    known = F.broadcast(training_rows(labels, id_col, label_col))  # MOST_TRAINING_ROWS rows of two numbers
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(known, F.col("_id") == F.col("_label_id"))
    got = with_features(own, "_t", "_f", None, ["_id", "_label"]).orderBy("_id", "_f").limit(MOST_TRAINING_ROWS).collect()
    f = np.array([r["_f"] for r in got]).reshape(-1, N_FEATURES)
    return fit(f, np.array([r["_label"] for r in got], int))


def score(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None, **names) -> DataFrame:
    """The carried columns of docs with a column score."""
    carry = docs.columns if carry is None else carry
    return with_features(docs, names.get("text_col", "text"), free_name(carry, "score"), train(docs, labels, **names), carry)


def accepted(docs: DataFrame, labels: DataFrame, **names) -> DataFrame:
    """The documents whose score reaches CUT, with their own columns."""
    name = free_name(docs.columns, "score")
    return score(docs, labels, **names).filter(F.col(name) >= CUT).drop(name)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), carry=["doc_id"])
    return out.select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


QUERIES = {"op7_quality": op7_quality}
