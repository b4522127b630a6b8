"""Vector code compression: product codes fitted by the filtering form of Lloyd's algorithm.

Vectors are scaled to integers and cut into consecutive parts; each part position has a codebook of its own. Every
partition builds, once, kd-trees over its parts in blocks of BLOCK vectors; a node holds the bounding box and the cached
sum of its points, and its count follows from its place. Each round walks the trees from the root with the codebook's
entries: an entry goes when no point of the box can be nearer to it than to the entry nearest to the box's middle, and a
subtree that is left with one entry goes to it at once, by its cached sum and count. Spark adds up the tasks' sums, a row
for each entry and component; only codebooks (entries x length of a vector) reach the driver.

Defined cases: rows without a vector, or with null or non-finite components in it, are dropped; the codebooks begin with
the smallest ids, null ids after all others, rows of one id by their integers; repeated rows are separate vectors;
distances that tie go to the lower index; with fewer vectors than entries the codebooks are shorter; vectors whose
length isn't that of the first one kept stay in the result without a code (null), as nothing tells how to cut them;
where a length can't be cut equally, part k begins at k * length // parts; scaled components beyond 2^27 (for parts of up
to 16; less for longer ones) count as that, so that distances are exact in 64 bits; null labels are one label; very long
vectors make blocks of as many bytes, not of more; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import cut, dealt_join
from tallyloom.session import ship, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors of a block: fewer where they have more than BLOCK_LENGTH components.
BLOCK, BLOCK_LENGTH = 4096, 256
#: Points of a leaf, at most.
LEAF = 8


class Codes(NamedTuple):
    """coded: (id, label, code, error); codebooks: for each part a list of entries, each a list of integers."""

    coded: DataFrame
    codebooks: list[list[list[int]]]

    def digest(self) -> str:
        flat = ",".join(str(x) for book in self.codebooks for entry in book for x in entry)
        return hashlib.sha256(flat.encode()).hexdigest()


def part_edges(length: int, parts: int) -> list[int]:
    return [k * length // parts for k in range(parts + 1)]


def largest(length: int, parts: int) -> int:
    """The largest scaled component for which a part's doubled distances fit 63 bits."""
    longest = max(1, -(-length // parts))
    return 1 << ((62 - (longest - 1).bit_length()) // 2 - 2)


class Tree(NamedTuple):
    """A kd-tree over n points: order (of the rows given), points in tree order, and by node, root first, lo, hi and sums."""

    order: np.ndarray
    points: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    sums: np.ndarray

    def levels(self) -> int:
        return (len(self.lo) + 1).bit_length() - 1

    def starts(self, level: int) -> np.ndarray:
        """Where the nodes of a level begin among the points, and their end."""
        return (np.arange((1 << level) + 1) * len(self.points)) >> level


def build_tree(points: np.ndarray) -> Tree:
    """Every node is halved at the median of its box's widest side, level by level, down to LEAF points."""
    n, width = points.shape
    order, boxes = np.arange(n), []
    depth = max(0, (-(-n // LEAF) - 1).bit_length())
    for level in range(depth + 1):
        edges = (np.arange((1 << level) + 1) * n) >> level
        now = points[order]
        lo, hi = np.minimum.reduceat(now, edges[:-1]), np.maximum.reduceat(now, edges[:-1])
        boxes.append((lo, hi, np.add.reduceat(now, edges[:-1])))
        if level < depth and width:
            node = np.repeat(np.arange(1 << level), np.diff(edges))
            widest = (hi - lo).argmax(1)[node]
            order = order[np.lexsort((now[np.arange(n), widest], node))]
    return Tree(order, points[order], *(np.concatenate(x) for x in zip(*boxes, strict=True)))


def filter_entries(tree: Tree, book: np.ndarray, whole: Callable, single: Callable) -> None:
    """Walk the tree with the entries of book (k x width).

    whole(level, nodes, entries) is called for subtrees that go to one entry, single(points, entries) for points.
    """
    norm = (book * book).sum(1)
    cand, node = np.arange(len(book)), np.zeros(len(book), np.int64)
    for level in range(tree.levels()):
        at = (1 << level) - 1 + node
        far = ((2 * book[cand] - (tree.lo[at] + tree.hi[at])) ** 2).sum(1)
        first = np.flatnonzero(np.diff(node, prepend=-1))
        size = np.diff(first, append=len(node))
        best = np.repeat(cand[np.lexsort((cand, far, node))[first]], size)
        # the least of |p - z|^2 - |p - best|^2 over the box is taken at the corner furthest towards z
        side = book[cand] - book[best]
        gap = norm[cand] - norm[best] - 2 * (side * np.where(side > 0, tree.hi[at], tree.lo[at])).sum(1)
        stay = (gap < 0) | ((gap == 0) & (cand <= best))
        cand, node = cand[stay], node[stay]
        first = np.flatnonzero(np.diff(node, prepend=-1))
        size = np.diff(first, append=len(node))
        alone = size == 1
        whole(level, node[first[alone]], cand[first[alone]])
        open_ = np.repeat(~alone, size)
        cand, node = cand[open_], node[open_]
        if not len(node):
            return
        if level + 1 < tree.levels():
            both = np.concatenate([2 * node, 2 * node + 1])
            order = np.argsort(both, kind="stable")
            cand, node = np.concatenate([cand, cand])[order], both[order]
    edges, leaves = tree.starts(tree.levels() - 1), np.append(np.flatnonzero(np.diff(node, prepend=-1)), len(node))
    # products of this size are exact as doubles, which are multiplied much faster
    exact = book.shape[1] * np.abs(book).max(initial=0) * np.abs(tree.points).max(initial=0) < 1 << 51
    points, book = (x.astype(np.float64) if exact else x for x in (tree.points, book))
    found, entries = [], []
    for a, b in zip(leaves.tolist(), leaves[1:].tolist(), strict=False):
        begin, end, own = edges[node[a]], edges[node[a] + 1], cand[a:b]
        entries.append(own[(norm[own] - 2 * (points[begin:end] @ book[own].T)).argmin(1)])
        found.append(np.arange(begin, end))
    if found:
        single(np.concatenate(found), np.concatenate(entries))


def nearest(tree: Tree, book: np.ndarray) -> np.ndarray:
    """The index of the entry nearest to each point, in the order of the rows that the tree was built from."""
    owner = np.empty(len(tree.points), np.int64)

    def whole(level, nodes, entries):
        edges = tree.starts(level)
        for node, entry in zip(nodes.tolist(), entries.tolist(), strict=True):
            owner[edges[node] : edges[node + 1]] = entry

    def single(points, entries):
        owner[points] = entries

    filter_entries(tree, book, whole, single)
    out = np.empty_like(owner)
    out[tree.order] = owner
    return out


def add_up(tree: Tree, book: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
    """Add to sums and counts what each entry gets: cached sums of whole subtrees, and single points of leaves."""

    def whole(level, nodes, entries):
        np.add.at(sums, entries, tree.sums[(1 << level) - 1 + nodes])
        np.add.at(counts, entries, np.diff(tree.starts(level))[nodes])

    def single(points, entries):
        np.add.at(sums, entries, tree.points[points])
        np.add.at(counts, entries, 1)

    filter_entries(tree, book, whole, single)


TREE = "array<struct<order: array<int>, points: array<bigint>, lo: array<bigint>, hi: array<bigint>, sums: array<bigint>>>"


def trees_of(rows: DataFrame, length: int, parts: int) -> DataFrame:
    """(ids, labels, trees): a row for each block of (id, label, x), with a tree for each part."""
    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))
    edges, most = part_edges(length, parts), max(1, min(BLOCK, BLOCK * BLOCK_LENGTH // max(length, 1)))

    tree_type = pa.list_(pa.struct([pa.field(f, pa.list_(pa.int32() if f == "order" else pa.int64())) for f in Tree._fields]))

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ids, labels, lists = (pa.concat_arrays([b.column(name) for b in held]) for name in ("id", "label", "x"))
        x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(ids), length)
        trees = [build_tree(np.ascontiguousarray(x[:, a:b])) for a, b in zip(edges, edges[1:], strict=False)]
        told = pa.array([[{f: getattr(t, f).reshape(-1) for f in Tree._fields} for t in trees]], tree_type)
        one = pa.array([0, len(ids)], pa.int32())
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(one, ids), pa.ListArray.from_arrays(one, labels), told], names=["ids", "labels", "trees"])

    def build(batches):
        held, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, most - n)
                held.append(piece)
                at, n = at + piece.num_rows, n + piece.num_rows
                if n == most:
                    yield block(held)
                    held, n = [], 0
        if n:
            yield block(held)

    return rows.select("id", "label", "x").mapInArrow(build, f"ids array<{id_type}>, labels array<{label_type}>, trees {TREE}")


def read_tree(row: pa.Scalar, k: int, width: int) -> Tree:
    order, *boxes = (row[k][name].values.to_numpy(zero_copy_only=False) for name in Tree._fields)
    n = len(order)
    nodes = (2 << max(0, (-(-n // LEAF) - 1).bit_length())) - 1
    return Tree(order.astype(np.int64), *(x.reshape(size, width) for x, size in zip(boxes, [n, nodes, nodes, nodes], strict=True)))


def refitted(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: every part goes to its nearest entry, and every entry that got any becomes the floor of their mean."""

    def add(batches):
        sums, counts = [np.zeros(b.shape, np.int64) for b in books], [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for row in batch.column("trees"):
                for k, book in enumerate(books):
                    add_up(read_tree(row, k, book.shape[1]), book, sums[k], counts[k])
        for k, (s, n) in enumerate(zip(sums, counts, strict=True)):
            used = np.flatnonzero(n)
            wide = s.shape[1] + 1  # component -1 is the count
            flat = np.concatenate([n[used, None], s[used]], 1).reshape(-1)
            m = len(flat)
            yield pa.RecordBatch.from_pydict({"part": pa.array(np.full(m, k, np.int32)), "entry": pa.array(np.repeat(used, wide).astype(np.int32)), "at": pa.array(np.tile(np.arange(-1, wide - 1, dtype=np.int32), len(used))), "v": pa.array(flat)})

    told = trees.select("trees").mapInArrow(add, "part int, entry int, at int, v bigint")
    total = told.groupBy("part", "entry", "at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    found: dict[tuple[int, int], dict[int, int]] = {}
    for part, entry, at, v in total.collect():  # a row for each component of each entry, whatever the input
        found.setdefault((part, entry), {})[at] = int(v)
    new = [b.copy() for b in books]
    for (part, entry), held in found.items():
        n = held.pop(-1)
        for at, v in held.items():
            new[part][entry, at] = v // n
    return new


def coded(trees: DataFrame, books: list[np.ndarray], id_type: str, label_type: str) -> DataFrame:
    """(id, label, code, error) of every vector of the trees."""
    digits = max([2, *(len(f"{len(b) - 1:x}") for b in books if len(b))])

    def encode(batches):
        names = [np.array([f"{i:0{digits}x}" for i in range(len(b))], dtype=object) for b in books]
        for batch in batches:
            for i, row in enumerate(batch.column("trees")):
                code, error = None, 0
                for k, book in enumerate(books):
                    tree = read_tree(row, k, book.shape[1])
                    own = nearest(tree, book)
                    points = np.empty_like(tree.points)
                    points[tree.order] = tree.points
                    error = error + ((points - book[own]) ** 2).sum(1)
                    code = names[k][own] if code is None else code + names[k][own]
                yield pa.RecordBatch.from_pydict({"id": batch.column("ids")[i].values, "label": batch.column("labels")[i].values, "code": pa.array(code, pa.string()), "error": pa.array(error, pa.int64())})

    return trees.mapInArrow(encode, f"id {id_type}, label {label_type}, code string, error bigint")


def encode_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> Codes:
    """Fit the codebooks to all vectors and encode each."""
    ship(vectors.sparkSession)
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    kept = vectors.filter(v.isNotNull() & ~bad).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("x")
    )
    types = [kept.schema[c].dataType.simpleString() for c in ("id", "label")]
    order = [F.col("id").asc_nulls_last(), F.col("x")]
    begin = kept.orderBy(*order).select("x").limit(entries).collect()  # as many rows as the codebooks have entries
    length = len(begin[0].x) if begin else 0
    same = F.size("x") == length
    if any(len(r.x) != length for r in begin):
        begin = kept.filter(same).orderBy(*order).select("x").limit(entries).collect()
    most = largest(length, parts)
    first = np.array([np.clip(np.array(r.x, np.int64), -most, most) for r in begin], np.int64).reshape(len(begin), length)
    edges = part_edges(length, parts)
    books = [np.ascontiguousarray(first[:, a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    fit = kept.filter(same).withColumn("x", F.transform("x", lambda x: F.greatest(F.least(x, F.lit(most)), F.lit(-most))))
    trees = cut(trees_of(fit, length, parts), "code-trees")
    for _ in range(rounds if len(begin) else 0):
        books = refitted(trees, books)
    out = coded(trees, books, *types)
    other = kept.filter(~same).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    return Codes(out.unionAll(other), [b.tolist() for b in books])


def with_label_errors(codes: DataFrame) -> DataFrame:
    """codes with label_error, the sum of error over the rows of the same label; a label of very many rows is dealt out."""
    held = cut(codes.withColumn("_label", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))), "codes")
    sums = held.groupBy("_label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"), F.count(F.lit(1)).alias("n"))
    sums = cut(sums.select("_label", F.expr("try_cast(_sum AS bigint)").alias("label_error"), "n"), "code-labels")
    return dealt_join(held, sums.drop("n"), "_label", sums.select("_label", "n"), ["id", "code"]).drop("_label")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = encode_vectors(table(spark, sf_dir, "embeddings"))
    out = with_label_errors(codes.coded)
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


QUERIES = {"op11_vector_codes": op11_vector_codes}


def _sql() -> str:
    steps = [
        f"""v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT max(len(e)) // {PARTS} AS w FROM v),
p AS MATERIALIZED (SELECT vec_id, label, part, e[part * w + 1 : part * w + w] AS x FROM v, w, range({PARTS}) r(part)),
c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS z FROM p QUALIFY entry < {ENTRIES})"""
    ]
    for k in range(ROUNDS + 1):
        steps.append(
            f"""a{k} AS MATERIALIZED (SELECT vec_id, part, min({{'d': d, 'entry': entry}}) AS b FROM (SELECT vec_id, p.part, entry,
    list_sum(list_transform(list_zip(x, z), lambda q: (q[1] - q[2]) * (q[1] - q[2])))::BIGINT AS d FROM p JOIN c{k} c ON p.part = c.part) GROUP BY vec_id, part)"""
        )
        if k < ROUNDS:
            steps.append(
                f"""s{k} AS (SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS z FROM (SELECT p.part, b.entry AS entry, j, sum(x[j]) AS s,
    count(*) AS n FROM a{k} a JOIN p ON p.vec_id = a.vec_id AND p.part = a.part, w, range(1, 1 + w.w) r(j) GROUP BY p.part, b.entry, j) GROUP BY part, entry),
c{k + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(s.z, c.z) AS z FROM c{k} c LEFT JOIN s{k} s ON s.part = c.part AND s.entry = c.entry)"""
            )
    last = ROUNDS
    return (
        "WITH " + ",\n".join(steps) + f""",
o AS (SELECT a.vec_id, string_agg(printf('%02x', b.entry), '' ORDER BY part) AS code, sum(b.d)::BIGINT AS error FROM a{last} a GROUP BY a.vec_id),
h AS (SELECT sha256(string_agg(array_to_string(z, ','), ',' ORDER BY part, entry)) AS h FROM c{last})
SELECT o.vec_id, code, error, (sum(error) OVER (PARTITION BY v.label))::BIGINT AS label_error, h AS codebooks_sha256
FROM o JOIN v ON v.vec_id = o.vec_id, h"""
    )


ORACLE = {"op11_vector_codes": _sql()}
