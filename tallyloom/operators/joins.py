"""Interval, overlap, similarity and anti joins, and merges of proposals."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import saved, ship


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return F.least(a_end, b_end) - F.greatest(a_start, b_start)


def bucketed(rows: DataFrame, start: Column, end: Column, width: float, name: str = "_bucket") -> DataFrame:
    """rows, once for each time bucket that start..end touches: intervals that meet share a bucket."""
    first, last = F.floor(start / width), F.floor(end / width)
    return rows.withColumn(name, F.explode(F.sequence(first, F.greatest(first, last))))


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], width: float, margin: float = 0.0) -> DataFrame:
    """Pairs of left (start, end) and right (r_start, r_end) of equal keys that overlap by more than -margin.

    The keys and a time bucket make it an equi-join, so that a key with very many intervals is dealt out by time. A
    pair counts in the first bucket that both touch.
    """
    a = bucketed(left, F.col("start") - margin, F.col("end") + margin, width)
    b = bucketed(right, F.col("r_start"), F.col("r_end"), width)
    first = F.greatest(F.floor((F.col("start") - margin) / width), F.floor(F.col("r_start") / width))
    meets = (F.col("end") > F.col("r_start") - margin) & (F.col("start") < F.col("r_end") + margin)
    return a.join(b, [*keys, "_bucket"]).filter(meets & (F.col("_bucket") == first)).drop("_bucket")


def inside_regions(words: DataFrame, regions: DataFrame, keys: Sequence[str], margin: float = 0.5, width: float = 60.0) -> DataFrame:
    """Words (word_id, start, end) that overlap a region of their keys by margin; keys without regions keep all."""
    hits = interval_join(words, regions, keys, width, margin).select(*keys, "word_id").distinct()
    silent = words.join(regions.select(*keys).distinct(), list(keys), "left_anti")
    return words.join(hits, [*keys, "word_id"], "left_semi").unionByName(silent)


def widest_overlap(words: DataFrame, turns: DataFrame, keys: Sequence[str], width: float = 60.0) -> DataFrame:
    """words with the label of the turn (turn_no, r_start, r_end, label) that overlaps most; the earliest of equals."""
    met = interval_join(words, turns, keys, width).withColumn("o", overlap(F.col("start"), F.col("end"), F.col("r_start"), F.col("r_end")))
    best = met.filter("o > 0").groupBy(*keys, "word_id").agg(F.max_by("label", F.struct("o", -F.col("turn_no"))).alias("label"))
    return words.join(best, [*keys, "word_id"], "left")


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of boxes (x, y, w, h); touching edges give 0."""
    w = F.greatest(F.lit(0.0), F.least(a["x"] + a["w"], b["x"] + b["w"]) - F.greatest(a["x"], b["x"]))
    h = F.greatest(F.lit(0.0), F.least(a["y"] + a["h"], b["y"] + b["h"]) - F.greatest(a["y"], b["y"]))
    union = a["w"] * a["h"] + b["w"] * b["h"] - w * h
    return F.when(union > 0, w * h / union).otherwise(0.0)


def box_pairs(detections: DataFrame, tracks: DataFrame, keys: Sequence[str], least: float) -> DataFrame:
    """Pairs of detections (d, box) and tracks (t, track_box) of a frame whose boxes overlap enough."""
    return detections.join(tracks, list(keys)).withColumn("iou", iou(F.col("box"), F.col("track_box"))).filter(F.col("iou") >= least)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n)).otherwise(F.transform(a, lambda x: x.cast("double")))


#: Known vectors of up to so many bytes are broadcast to the queries; more are dealt out in blocks of vectors.
BROADCAST_BYTES = 64 << 20
BLOCK = 1024


def matrix(vectors: pa.ListArray) -> np.ndarray:
    """Vectors of one length as rows of unit length; those of length zero stay zero."""
    rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1 if len(vectors) else 0)
    size = np.sqrt((rows * rows).sum(1, keepdims=True))
    return np.divide(rows, size, out=np.zeros_like(rows), where=size > 0)


#: Pivots of a key or of known vectors, at most (twice as many where a sample happens to be large).
MOST_PIVOTS = 256
#: What angles may be off by, in radians.
SLACK = 1e-6


def angles(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Angles between unit rows; they obey the triangle inequality, which cosines don't."""
    return np.arccos(np.clip(rows @ pivots.T, -1.0, 1.0))


def reach(least: float) -> float:
    """The largest angle at which a cosine is enough."""
    return float(np.arccos(np.clip(least, -1.0, 1.0))) + SLACK


class Cells:
    """Known unit rows (sorted by id) in cells around pivots, with the largest angle of each cell."""

    def __init__(self, rows: np.ndarray):
        n = len(rows)
        self.pivots = rows[np.linspace(0, n - 1, min(n, MOST_PIVOTS, int(np.ceil(np.sqrt(n))))).astype(int)] if n else rows
        near = [angles(rows[at : at + BLOCK], self.pivots) for at in range(0, n, BLOCK)]
        cell = np.concatenate([x.argmin(1) for x in near]) if near else np.zeros(0, int)
        angle = np.concatenate([x.min(1) for x in near]) if near else np.zeros(0)
        self.order = np.argsort(cell, kind="stable")
        self.rows, self.edges = rows[self.order], np.searchsorted(cell[self.order], np.arange(len(self.pivots) + 1))
        self.radius = np.array([angle[self.order[a:b]].max(initial=0.0) for a, b in zip(self.edges, self.edges[1:], strict=False)])

    def nearest(self, asked: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place or -1, cosine, products) of each asked row: the known row of highest cosine, the first of equals.

        A cell is left out where no row in it can reach the best found so far, or the least that counts: all angles to its
        rows are at least that to its pivot less its radius. Cells are looked at from the most promising on.
        """
        n = len(asked)
        best, place, products = np.full(n, -np.inf), np.full(n, -1), np.zeros(n, np.int64)
        if not n or not len(self.rows):
            return place, best, products
        far = angles(asked, self.pivots)
        products += len(self.pivots)
        bound = np.cos(np.clip(far - self.radius - SLACK, 0.0, np.pi))
        # a row without direction is at no angle to anything: it has cosine 0 with all
        flat = ~asked.any(1)
        bound[flat] = np.inf
        ranked = np.argsort(-bound, axis=1, kind="stable")
        active = np.arange(n)
        for step in range(len(self.pivots)):
            cell = ranked[active, step]
            hope = bound[active, cell]
            open_ = hope >= np.maximum(best[active], least) - 1e-9
            active, cell = active[open_], cell[open_]
            if not len(active):
                break
            for c in np.unique(cell):
                own, a, b = active[cell == c], self.edges[c], self.edges[c + 1]
                if a == b:
                    continue
                cosine = np.round(asked[own] @ self.rows[a:b].T, 12)
                at = cosine.argmax(1)  # rows of a cell are in order of their places
                value, where = cosine[np.arange(len(own)), at], self.order[a + at]
                better = (value > best[own]) | ((value == best[own]) & (where < place[own]))
                best[own[better]], place[own[better]] = value[better], where[better]
                products[own] += b - a
        place[best < least] = -1
        return place, best, products


def _told(ids: pa.Array, known_ids: pa.Array, place: np.ndarray, best: np.ndarray, products: np.ndarray) -> pa.RecordBatch:
    none = place < 0
    names = known_ids.take(pa.array(np.where(none, 0, place), mask=none)) if len(known_ids) else pa.nulls(len(ids), known_ids.type)
    return pa.RecordBatch.from_arrays([ids, names, pa.array(best, mask=none), pa.array(products)], ["id", "k_id", "cosine", "products"])


def packed(rows: DataFrame, keys: Sequence[str], blocks: Column, *columns: str) -> DataFrame:
    """(keys, block, held): the rows of each key dealt to so many blocks, a list of structs each."""
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(columns[0]), blocks).cast("int"))
    return dealt.groupBy(*keys, "block").agg(F.collect_list(F.struct(*columns)).alias("held"))


def nearest_known(queries: DataFrame, known: DataFrame, least: float, with_products: bool = False) -> DataFrame:
    """queries (id, vec) with the known (k_id, k_vec) of highest cosine, if it reaches least; smallest k_id of equals.

    An exact search of an inverted file: known vectors lie in cells around pivots, and a query meets only cells that can
    hold a better one by the triangle inequality of angles. Known vectors of up to BROADCAST_BYTES go to all tasks; more
    stay dealt out by cells, and a query goes to those cells that can reach least. with_products adds how many products of
    vectors each query took.
    """
    ship(queries.sparkSession)
    own = known.filter("k_vec IS NOT NULL").select("k_id", "k_vec")
    asked = queries.select("id", "vec")
    schema = f"id {dict(asked.dtypes)['id']}, k_id {dict(own.dtypes)['k_id']}, cosine double, products bigint"
    columns = ["id", "k_id", "cosine", *(["products"] if with_products else [])]
    n, dims = own.agg(F.count(F.lit(1)), F.max(F.size("k_vec"))).first()
    if n * (dims or 0) * 8 <= BROADCAST_BYTES:
        few = own.orderBy("k_id").toArrow().combine_chunks()
        ids = few.column("k_id").combine_chunks()
        held = queries.sparkSession.sparkContext.broadcast((ids, Cells(matrix(few.column("k_vec").combine_chunks()))))

        def search(batches):
            ids, cells = held.value
            for whole in batches:
                for at in range(0, whole.num_rows, BLOCK):
                    part = whole.slice(at, BLOCK)
                    some = part.filter(part.column("vec").is_valid())
                    yield _told(some.column("id"), ids, *cells.nearest(matrix(some.column("vec")), least))
                    bare = part.filter(part.column("vec").is_null()).column("id")
                    yield _told(bare, ids, np.full(len(bare), -1), np.zeros(len(bare)), np.zeros(len(bare), np.int64))

        return asked.mapInArrow(search, schema).select(*columns)
    return _nearest_by_cells(asked, own, n, least, schema).select(*columns)


def _nearest_by_cells(asked: DataFrame, own: DataFrame, n: int, least: float, schema: str) -> DataFrame:
    pivots = own.filter(F.pmod(F.xxhash64("k_id"), F.lit(n)) < min(MOST_PIVOTS, int(np.ceil(np.sqrt(n))))).orderBy("k_id").select("k_vec").limit(2 * MOST_PIVOTS).toArrow().combine_chunks()
    pivots = matrix(pivots.column("k_vec").combine_chunks()) if pivots.num_rows else np.zeros((1, 1))
    kinds = dict(own.dtypes)

    def assign(batches):
        for batch in batches:
            near = angles(rows := matrix(batch.column("k_vec")), pivots) if pivots.any() else np.zeros((batch.num_rows, 1))
            where = near.argmin(1)
            yield pa.RecordBatch.from_arrays([pa.array(where.astype(np.int32)), pa.array(near[np.arange(len(where)), where]), batch.column("k_id"), batch.column("k_vec")], ["cell", "angle", "k_id", "k_vec"])

    celled = saved(own.mapInArrow(assign, f"cell int, angle double, k_id {kinds['k_id']}, k_vec {kinds['k_vec']}"))
    sizes = {r.cell: (r.n, r.r) for r in celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("r")).collect()}  # a row a pivot
    radius = np.array([sizes.get(c, (0, -np.inf))[1] for c in range(len(pivots))])

    def send(batches):
        for batch in batches:
            rows = matrix(batch.column("vec"))
            near = angles(rows, pivots) - radius <= reach(least) if pivots.any() else np.ones((len(rows), 1), bool)
            near |= ~rows.any(1)[:, None]
            i, c = np.nonzero(near)
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), *(batch.column(x).take(pa.array(i)) for x in ("id", "vec"))], ["cell", "id", "vec"])

    some = asked.filter("vec IS NOT NULL")
    sent = some.mapInArrow(send, f"cell int, id {dict(asked.dtypes)['id']}, vec {dict(asked.dtypes)['vec']}").filter(F.col("cell").isin(sorted(sizes)))
    blocks = F.create_map(*[x for c, (m, _) in sorted(sizes.items()) for x in (F.lit(c), F.lit(-(-m // BLOCK)))])[F.col("cell")]
    here = packed(sent, ["cell"], F.lit(max(1, -(-some.count() // BLOCK))), "id", "vec")
    there = packed(celled, ["cell"], blocks, "k_id", "k_vec").withColumnRenamed("held", "held2")
    met = here.select("cell", "held", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block")).join(there, ["cell", "block"]).select("held", "held2")

    def compare(batches):
        for batch in batches:
            for a, b in zip(batch.column("held"), batch.column("held2"), strict=True):
                order = pc.sort_indices(b.values.field("k_id"))
                ids, asked_rows = b.values.field("k_id").take(order), matrix(a.values.field("vec"))
                cosine = np.round(asked_rows @ matrix(b.values.field("k_vec").take(order)).T, 12)
                at = cosine.argmax(1)
                best = cosine[np.arange(len(at)), at]
                yield _told(a.values.field("id"), ids, np.where(best >= least, at, -1), best, np.full(len(at), len(ids)))

    each = met.mapInArrow(compare, schema)
    found = F.when(F.col("k_id").isNotNull(), F.struct((-F.col("cosine")).alias("far"), "k_id"))
    best = each.groupBy("id").agg(F.min(found).alias("m"), F.sum("products").alias("products"))
    return asked.select("id").join(best, "id", "left").select("id", F.col("m.k_id").alias("k_id"), (-F.col("m.far")).alias("cosine"), F.coalesce("products", F.lit(0)).alias("products"))


def metric_cells(vectors: DataFrame, key: str, least: float) -> tuple[DataFrame, DataFrame]:
    """Vectors (key, id, vec) in cells, and the pairs of cells that can hold links.

    Pivots are a bounded sample of each key's vectors, a cell is what lies nearest to one of them. Two cells can hold a
    link only if the angle between their pivots is at most their radii and the angle that least allows. Returns (key, cell,
    n, id, vec) and (key, cell, other, n, n2), cell <= other.
    """
    own = vectors.filter("vec IS NOT NULL").select(key, "id", "vec")
    kinds = dict(own.dtypes)
    sizes = saved(own.groupBy(key).agg(F.count(F.lit(1)).alias("n")))
    if least <= 0 or (sizes.agg(F.max("n")).first()[0] or 0) <= BLOCK:  # a cell a key: nothing to leave out
        pairs = sizes.select(key, F.lit(0).alias("cell"), F.lit(0).alias("other"), "n", F.col("n").alias("n2"))
        return own.join(sizes, key).select(key, F.lit(0).alias("cell"), "n", "id", "vec"), pairs
    some = own.filter(F.exists("vec", lambda x: x != 0)).join(sizes, key)  # without a direction nothing reaches least
    wanted = F.least(F.lit(MOST_PIVOTS), F.ceil(F.col("n") * 2 / BLOCK))
    sample = some.filter(F.pmod(F.xxhash64("id"), F.col("n")) < wanted)
    pivots = saved(sample.groupBy(key).agg(F.slice(F.array_sort(F.collect_list("vec")), 1, 2 * MOST_PIVOTS).alias("pivots")))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    held = packed(some, [key, "n"], blocks, "id", "vec")
    # the pivots of a key go to each of its blocks, so that a large key stays dealt out
    copies = sizes.join(pivots, key, "left").select(key, "pivots", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))

    def assign(batches):
        for batch in batches:
            for i, (rows, pivot) in enumerate(zip(batch.column("held"), batch.column("pivots"), strict=True)):
                x = matrix(rows.values.field("vec"))
                near = angles(x, matrix(pivot.values)) if pivot.is_valid else np.full((len(x), 1), np.pi)
                where = near.argmin(1)
                name = batch.column("k").slice(i, 1).take(pa.array(np.zeros(len(x), int)))
                yield pa.RecordBatch.from_arrays([name, pa.array(where.astype(np.int32)), pa.array(near[np.arange(len(x)), where]), rows.values.field("id"), rows.values.field("vec")], [key, "cell", "angle", "id", "vec"])

    met = held.join(copies, [key, "block"]).select(F.col(key).alias("k"), "held", "pivots")
    celled = saved(met.mapInArrow(assign, f"`{key}` {kinds[key]}, cell int, angle double, id {kinds['id']}, vec {kinds['vec']}"))
    cells = saved(celled.groupBy(key, "cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("r")))
    each = cells.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("cell", "r", "n"))).alias("cells")).join(pivots, key, "left")
    allowed = reach(least)

    def meet(batches):
        for batch in batches:
            for i, (held, pivot) in enumerate(zip(batch.column("cells"), batch.column("pivots"), strict=True)):
                cell, r, n = (held.values.field(c).to_numpy() for c in ("cell", "r", "n"))
                between = angles(matrix(pivot.values), matrix(pivot.values))[np.ix_(cell, cell)] if pivot.is_valid else np.zeros((len(cell), len(cell)))
                a, b = np.nonzero(np.triu(between <= r[:, None] + r[None] + allowed + SLACK) | np.eye(len(cell), dtype=bool))
                name = batch.column("k").slice(i, 1).take(pa.array(np.zeros(len(a), int)))
                yield pa.RecordBatch.from_arrays([name, *map(pa.array, (cell[a], cell[b], n[a], n[b]))], [key, "cell", "other", "n", "n2"])

    pairs = each.select(F.col(key).alias("k"), "cells", "pivots").mapInArrow(meet, f"`{key}` {kinds[key]}, cell int, other int, n bigint, n2 bigint")
    return celled.join(cells.select(key, "cell", "n"), [key, "cell"]).select(key, "cell", "n", "id", "vec"), pairs


def cosine_links(vectors: DataFrame, key: str, least: float) -> DataFrame:
    """(key, a, b, cosine) of pairs a < b of vectors (id, vec) of equal key whose cosine reaches least.

    Only cells that can hold links meet (metric_cells). A cell's vectors are dealt to blocks, and each pair of blocks is one
    product of matrices in some task.
    """
    ship(vectors.sparkSession)
    celled, pairs = metric_cells(vectors, key, least)
    count = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    held = packed(celled, [key, "cell", "n"], count("n"), "id", "vec").drop("n")
    met = pairs.select(key, "cell", "other", F.explode(F.sequence(F.lit(0), count("n") - 1)).alias("block"), count("n2").alias("blocks"))
    first = F.when(F.col("cell") == F.col("other"), F.col("block")).otherwise(0)
    met = met.select(key, "cell", "block", "other", F.explode(F.sequence(first, F.col("blocks") - 1)).alias("block2"))
    met = met.join(held, [key, "cell", "block"]).join(held.select(key, F.col("cell").alias("other"), F.col("block").alias("block2"), F.col("held").alias("held2")), [key, "other", "block2"])

    def compare(batches):
        for batch in batches:
            for i, (own_block, a, b) in enumerate(zip(batch.column("same").to_pylist(), batch.column("held"), batch.column("held2"), strict=True)):
                cosine = matrix(a.values.field("vec")) @ matrix(b.values.field("vec")).T
                x_at, y_at = np.nonzero(cosine >= least)
                x, y = a.values.field("id").take(pa.array(x_at)), b.values.field("id").take(pa.array(y_at))
                less = pc.less(x, y)
                low, high = pc.if_else(less, x, y), pc.if_else(less, y, x)
                keep = less if own_block else pc.not_equal(x, y)
                names = batch.column("k").slice(i, 1).take(pa.array(np.zeros(len(x_at), int)))
                yield pa.RecordBatch.from_arrays([names, low, high, pa.array(cosine[x_at, y_at])], [key, "a", "b", "cosine"]).filter(keep)

    kinds = dict(vectors.dtypes)
    same = (F.col("cell") == F.col("other")) & (F.col("block") == F.col("block2"))
    return met.select(F.col(key).alias("k"), same.alias("same"), "held", "held2").mapInArrow(compare, f"`{key}` {kinds[key]}, a {kinds['id']}, b {kinds['id']}, cosine double")


def orphans(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side) of rows that only one side has."""
    seen = lambda rows, right: rows.select(key, F.lit(right).alias("r"))
    # one aggregate, partly before the shuffle: no side is sorted or held
    sides = seen(left, False).unionByName(seen(right, True)).groupBy(key).agg(F.min("r").alias("a"), F.max("r").alias("b"))
    none = F.col(key).isNull() | (F.col("a") == F.col("b"))  # a null equals none of the other side
    return sides.filter(none).select(key, F.explode(F.array_distinct(F.array("a", "b"))).alias("r")).select(key, F.when(F.col("r"), "right").otherwise("left").alias("side"))


def merge_proposals(current: DataFrame, proposed: DataFrame, key: str, columns: Sequence[str], overwrite: bool = False) -> DataFrame:
    """(key, column, old, new) of the changes that proposals make: blanks are filled, or all values replaced; no no-ops."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    both = current.join(proposed.select(key, *[F.col(c).alias(f"_{c}") for c in columns]), key)
    changes = [
        F.when(~blank(F.col(f"_{c}")) & (F.lit(overwrite) | blank(F.col(c))) & ~F.col(c).eqNullSafe(F.col(f"_{c}")),
               F.struct(F.lit(c).alias("column"), F.col(c).alias("old"), F.col(f"_{c}").alias("new"))) for c in columns
    ]
    return both.select(key, F.explode(F.filter(F.array(*changes), lambda x: x.isNotNull())).alias("x")).select(key, "x.*")


def new_imports(incoming: DataFrame, catalog: DataFrame, extracted: str, order: str) -> DataFrame:
    """Incoming rows whose extracted id neither the catalog nor an earlier row has."""
    first = F.row_number().over(Window.partitionBy(extracted).orderBy(order))
    fresh = incoming.filter(F.col(extracted).isNotNull()).join(catalog.select(extracted), extracted, "left_anti")
    return fresh.withColumn("_n", first).filter("_n = 1").drop("_n")


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """left with right's latest value of the key at or before the time `at`.

    Both are sorted together and the value carried forward, so that no pair of rows is formed.
    """
    own = left.select(key, at, F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"))
    other = right.select(key, at, F.col(value).alias("_v"), F.lit(0).alias("_side"), F.lit(None).cast(own.schema["_row"].dataType).alias("_row"))
    w = Window.partitionBy(key).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    return own.unionByName(other).withColumn(value, F.last("_v", ignorenulls=True).over(w)).filter("_side = 1").select("_row.*", value)
