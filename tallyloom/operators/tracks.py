"""Tracking and smoothing over frames, in order, with what a step needs of the past carried from piece to piece."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import ship


def _overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """IoU of all boxes of a (x, y, w, h) with all of b."""
    low = np.maximum(a[:, None, :2], b[None, :, :2])
    high = np.minimum((a[:, :2] + a[:, 2:])[:, None], (b[:, :2] + b[:, 2:])[None])
    common = np.clip(high - low, 0, None).prod(2)
    union = a[:, 2:].prod(1)[:, None] + b[:, 2:].prod(1)[None] - common
    return np.divide(common, union, out=np.zeros_like(common), where=union > 0)


def _share(a: tuple, b: tuple) -> float:
    """_overlaps of two boxes."""
    wide, high = min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0]), min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1])
    common = max(wide, 0.0) * max(high, 0.0)
    union = a[2] * a[3] + b[2] * b[3] - common
    return common / union if union > 0 else 0.0


def assign(found: Sequence, held: Sequence, least: float) -> dict[int, int]:
    """Which held box each found box continues: best overlap first, later indices first among equals, each once."""
    if not len(found) or not len(held):
        return {}
    if len(found) * len(held) <= 32 and not any(v != v for box in (*found, *held) for v in box):  # arrays don't pay for a few pairs
        pairs = sorted(((s, i, j) for i, x in enumerate(found) for j, y in enumerate(held) if (s := _share(x, y)) >= least), reverse=True)
    else:
        share = _overlaps(np.array(found, float), np.array(held, float))
        i, j = np.nonzero(~(share < least))
        order = np.lexsort((j, i, share[i, j]))[::-1]
        pairs = zip(order.tolist(), i[order].tolist(), j[order].tolist(), strict=True)
    taken: dict[int, int] = {}
    used = set()
    for _, i, j in pairs:
        if i not in taken and j not in used:
            taken[i] = j
            used.add(j)
    return taken


def in_order(rows: DataFrame, key: str | Sequence[str], order: Sequence[str], step: Callable, schema: str, finish: Callable | None = None) -> DataFrame:
    """step(piece, state) -> (columns, state) over the rows of each key in order, a piece at a time.

    A key's rows are never held together: what a step needs of those before is its state, None at first. finish(name,
    state) gives the rows that are left when a key has ended; with several keys its name is a tuple. Pieces and rows are
    arrays or lists by column: a batch holds many keys, and a frame for each would take longer than the steps.
    """
    ship(rows.sparkSession)
    keys = [key] if isinstance(key, str) else list(key)

    def joined(outs: list) -> pd.DataFrame:
        columns = outs[0] if outs else {}
        return pd.DataFrame({c: np.concatenate([np.asarray(o[c], object if isinstance(o[c], list) else None) for o in outs]) for c in columns})

    def work(pieces: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, state, begun = None, None, False
        for pdf in pieces:
            if pdf.empty:
                continue
            fresh = np.zeros(len(pdf), bool)
            for c in keys:
                k = pdf[c]
                fresh |= (k.ne(k.shift()) & ~(k.isna() & k.shift().isna())).to_numpy(bool)
            fresh[0] = True
            columns, outs = {c: pdf[c].to_numpy() for c in pdf.columns}, []
            for a, z in pairwise([*np.flatnonzero(fresh).tolist(), len(pdf)]):
                now = tuple(columns[c][a] for c in keys)
                if not (begun and all(x == y or pd.isna(x) and pd.isna(y) for x, y in zip(now, name, strict=True))):
                    if begun and finish:
                        outs.append(finish(name if len(keys) > 1 else name[0], state))
                    name, state, begun = now, None, True
                out, state = step({c: v[a:z] for c, v in columns.items()}, state)
                outs.append(out)
            outs = [o for o in outs if o]
            if outs:
                yield joined(outs)
        if begun and finish and (last := finish(name if len(keys) > 1 else name[0], state)):
            yield joined([last])

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(work, schema)


def track_boxes(detections: DataFrame, key: str, least: float = 0.3, max_age: int = 30, min_hits: int = 3) -> DataFrame:
    """(key, frame, det, track) of detections (key, frame, det, x, y, w, h) of tracks with enough hits.

    The state of a key is its live tracks, the next number, and the detections of the frame that may not be complete.
    A detection without a frame is in no track.
    """
    kind = dict(detections.dtypes)[key]

    def follow(frame: int, boxes: list, last: dict, fresh: int) -> tuple[list, dict, int]:
        last = {t: x for t, x in last.items() if frame - x[0] <= max_age}
        live = list(last)
        taken = assign(boxes, [last[t][1] for t in live], least)
        refreshed = {live[taken[i]]: (frame, boxes[i]) for i in sorted(taken)}
        refreshed |= {t: x for t, x in last.items() if t not in refreshed}
        ids = []
        for i in range(len(boxes)):
            if i in taken:
                ids.append(live[taken[i]])
            else:
                refreshed[fresh] = (frame, boxes[i])
                ids.append(fresh)
                fresh += 1
        return ids, refreshed, fresh

    def told(name, frames: list, dets: list, ids: list) -> dict:
        return {key: [name] * len(ids), "frame": frames[: len(ids)], "det": dets[: len(ids)], "track": ids}

    def step(piece: dict, state):
        frames, dets, boxes, last, fresh = state or ([], [], [], {}, 0)
        frames, dets = frames + piece["frame"].tolist(), dets + piece["det"].tolist()
        boxes, ids, a = boxes + list(zip(*(piece[c].astype(float).tolist() for c in "xywh"), strict=True)), [], 0
        for z in range(1, len(frames)):
            if frames[z] != frames[a]:
                more, last, fresh = follow(frames[a], boxes[a:z], last, fresh)
                ids += more
                a = z
        return told(piece[key][0], frames, dets, ids), (frames[a:], dets[a:], boxes[a:], last, fresh)

    def finish(name, state):
        frames, dets, boxes, last, fresh = state
        return told(name, frames, dets, follow(frames[0], boxes, last, fresh)[0])

    found = in_order(detections.filter("frame IS NOT NULL"), key, ["frame", "det"], step, f"{key} {kind}, frame int, det int, track int", finish)
    hits = F.count(F.lit(1)).over(Window.partitionBy(key, "track"))
    return found.withColumn("_hits", hits).filter(F.col("_hits") >= min_hits).drop("_hits")


def one_euro_piece(values: np.ndarray, state: tuple[float, float] | None, rate: float = 25.0, cutoff: float = 1.0, beta: float = 0.3, slope_cutoff: float = 1.0) -> tuple[np.ndarray, tuple]:
    """The One-Euro low-pass filter, whose cutoff rises with speed, from where state (last output, slope) left off."""
    turn = 2 * np.pi
    steady, values = 1 / (1 + rate / (turn * slope_cutoff)), np.asarray(values, float).tolist()
    last, slope = state or (values[0], 0.0)
    out = [] if state else values[:1]
    for v in values[len(out) :]:
        slope += steady * ((v - last) * rate - slope)
        last = last + 1 / (1 + rate / (turn * (cutoff + beta * abs(slope)))) * (v - last)
        out.append(last)
    return np.array(out), (last, slope)


def one_euro(values: np.ndarray, **options) -> np.ndarray:
    return one_euro_piece(values, None, **options)[0]


def gaussian(values: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing with mirrored edges, cut at four sigma."""
    reach = int(4 * sigma + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.pad(np.asarray(values, float), reach, mode="symmetric")
    return np.convolve(padded, kernel / kernel.sum(), "valid")


def kalman_piece(boxes: np.ndarray, state: tuple | None, process: float, measurement: float) -> tuple[np.ndarray, tuple]:
    """Constant-velocity filter over centre and size; rows of NaN are predicted only; state: where the last piece ended."""
    step = np.eye(8) + np.eye(8, k=4)
    seen = np.eye(4, 8)
    out = []
    for box in boxes:
        if state is None:
            state = (np.r_[box, np.zeros(4)], np.eye(8))
            out.append(box)
            continue
        at, spread = step @ state[0], step @ state[1] @ step.T + process * np.eye(8)
        if not np.isnan(box).any():
            gain = np.linalg.solve(seen @ spread @ seen.T + measurement * np.eye(4), seen @ spread).T
            at, spread = at + gain @ (box - seen @ at), (np.eye(8) - gain @ seen) @ spread
        state = (at, spread)
        out.append(at[:4])
    return np.array(out).reshape(-1, 4), state


def kalman(boxes: np.ndarray, process: float, measurement: float) -> np.ndarray:
    return kalman_piece(boxes, None, process, measurement)[0]


def smooth_boxes(boxes: DataFrame, key: str, process: float = 0.03, measurement: float = 0.1) -> DataFrame:
    """(key, frame, x, y, w, h) for every frame of a track from its first box to its last, by the Kalman filter.

    boxes: (key, frame, x, y, w, h) where something was found; frames between are predicted. The first box stays.
    """
    kind, names = dict(boxes.dtypes)[key], ["x", "y", "w", "h"]
    ends = boxes.groupBy(key).agg(F.min("frame").alias("a"), F.max("frame").alias("b"))
    frames = ends.select(key, F.explode(F.sequence("a", "b")).alias("frame"))
    whole = frames.join(boxes.select(key, "frame", *[F.col(c).cast("double").alias(c) for c in names]), [key, "frame"], "left")

    def step(piece: dict, state):
        x, y, w, h = (piece[c].astype(float) for c in names)
        out, after = kalman_piece(np.stack([x + w / 2, y + h / 2, w, h], 1), state, process, measurement)
        cx, cy, w, h = out.T
        found = {"x": np.rint(cx - w / 2), "y": np.rint(cy - h / 2), "w": np.rint(np.maximum(w, 1)), "h": np.rint(np.maximum(h, 1))}
        return {key: piece[key], "frame": piece["frame"]} | {c: v.astype(int) for c, v in found.items()}, after

    return in_order(whole, key, ["frame"], step, f"{key} {kind}, frame int, x int, y int, w int, h int")


def smooth(rows: DataFrame, key: str, at: str, column: str, how: str = "one_euro", **options) -> DataFrame:
    """rows (key, at, column) with `smoothed`, in order of `at` within a key.

    one_euro carries its state along; gaussian is a weighted sum over a window of rows, mirrored at the ends.
    """
    own, kinds = rows.select(key, at, column), dict(rows.dtypes)
    if how == "gaussian":
        return gaussian_window(own, key, at, column, **options)

    def step(piece: dict, state):
        out, after = one_euro_piece(piece[column].astype(float), state, **options)
        return piece | {"smoothed": out}, after

    return in_order(own, key, [at], step, f"{key} {kinds[key]}, {at} {kinds[at]}, {column} {kinds[column]}, smoothed double")


def gaussian_window(rows: DataFrame, key: str, at: str, column: str, sigma: float) -> DataFrame:
    """rows with `smoothed`: the same as gaussian(), by window functions."""
    reach = int(4 * sigma + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weights = F.array(*[F.lit(float(w)) for w in kernel / kernel.sum()])
    w = Window.partitionBy(key).orderBy(at)
    held = rows.withColumns({
        "_i": F.row_number().over(w) - 1, "_n": F.count(F.lit(1)).over(Window.partitionBy(key)),
        "_near": F.collect_list(F.col(column).cast("double")).over(w.rowsBetween(-reach, reach)),
    })
    j = lambda o: F.pmod(F.col("_i") + o - reach, 2 * F.col("_n"))
    mirrored = lambda o: F.when(j(o) < F.col("_n"), j(o)).otherwise(2 * F.col("_n") - 1 - j(o))
    low = F.greatest(F.col("_i") - reach, F.lit(0))
    sums = F.aggregate(F.transform(weights, lambda x, o: x * F.get(F.col("_near"), (mirrored(o) - low).cast("int"))), F.lit(0.0), lambda a, x: a + x)
    return held.withColumn("smoothed", sums).drop("_i", "_n", "_near")


def winner(candidates: DataFrame, key: str) -> DataFrame:
    """The candidate (track, overlap, asd, size) of the highest product; the first of equals; none if it isn't above 0."""
    score = F.col("overlap") * F.col("asd") * F.col("size")
    best = candidates.filter(score > 0).groupBy(key).agg(F.max_by(F.struct("track", score.alias("score")), F.struct(score.alias("s"), -F.col("track"))).alias("x"))
    return best.select(key, "x.track", "x.score")
