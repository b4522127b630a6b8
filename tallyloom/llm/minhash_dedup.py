"""Near-duplicates by ProbMinHash, banding and verification.

A document is its set of five-word shingles, all of weight 1, as the criterion counts them: lines that repeat change
nothing. Each shingle is a Poisson process of its weight's rate whose arrivals fall into random registers; a register
keeps the shingle that arrives first, and a document's processes stop once they are later than all its registers. Two
registers agree with the Jaccard similarity of the sets. Bands of registers give buckets; at 0.8 two documents share
none with a probability of (1 - 0.8 ** 4) ** 32, i.e. 5e-8. Candidates are verified on the
texts: the shingle sets' Jaccard similarity must reach the threshold.

Equal texts are one node. In a bucket nodes are compared with its leaders, those that share most buckets with others,
so that a group of thousands costs a few comparisons a node. After components of these links, the nodes outside a
bucket's largest component meet all its nodes of other components, in blocks that carry the texts: pairs whose registers
agree enough are verified there and then unless they have been joined in the block already, each in the first bucket
that both share. So no candidate pair of two classes is left unverified, and what comes out of a block is a forest, not
its pairs. Heavy buckets, hubs and groups of copies are dealt out.

Defined cases: words are runs of letters and digits of the lower-cased text; a text of fewer than five words is one
shingle of all of them; null, empty and wordless texts are equal; rows may repeat, share an id or have none: each row is
known by id and text together, and null ids come after all others; very long texts are sketched and verified in batches
of bounded bytes; an empty table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import cut, dealt_join, free_name, may_be_among, text_of
from tallyloom.llm.graph import components
from tallyloom.session import ship, table

WORDS = 5
SIMILARITY = 0.8
REGISTERS = 128
BANDS = 32
#: Leaders that each node of a bucket is compared with.
LEADERS = 4
#: Nodes and bytes of text of a block of the second pass, and how far the registers' agreement may fall below the threshold
#: there (their deviation is 0.035, and a pair at 0.8 agrees in fewer than 0.6 with a probability below 1e-7).
BLOCK = 512
BLOCK_BYTES = 8 << 20
SLACK = 0.2
#: Bytes of text that a task sketches or compares at a time, unless a single text or pair has more.
BATCH_BYTES = 4 << 20
#: What is neither ASCII nor a letter, digit or mark.
_OTHER = re.compile(r"[^\x00-\x7f\w\u0300-\u036f]")

U = np.uint64
GOLD = U(0x9E3779B97F4A7C15)
ODD = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], U)
BASE = U(0x100000001B3)
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64 bits."""
    x = (x ^ (x >> U(30))) * ODD[0]
    x = (x ^ (x >> U(27))) * ODD[1]
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[:1] = 1
    return np.cumprod(out, dtype=U)


def plain(text: str) -> bytes:
    """The lower-cased text in UTF-8, where every byte from 128 on belongs to a letter or digit."""
    low = text.lower()
    return (low if low.isascii() else _OTHER.sub(" ", low)).encode()


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words: text number, hash, and start and end in the joined lower-cased bytes."""
    parts = [plain(t) + b" " for t in texts]
    raw = np.frombuffer(b"".join(parts), np.uint8)
    if not len(raw):
        return (np.zeros(0, np.int64), np.zeros(0, U), *[np.zeros(0, np.int64)] * 2)
    inside = _WORD[raw]
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edge[::2], edge[1::2]
    n = len(raw)
    up, down = _powers(int(BASE), n), _powers(pow(int(BASE), -1, 1 << 64), n)
    sums = np.concatenate([np.zeros(1, U), np.cumsum((raw.astype(U) + U(1)) * up, dtype=U)])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U) * GOLD)
    owner = np.searchsorted(np.cumsum([len(p) for p in parts]), starts, side="right")
    return owner, hashes, starts, ends


def shingles_of(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of the texts: text number, hash, count; sorted by neither."""
    owner, w, _, _ = words_of(texts)
    n = np.bincount(owner, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    value = np.zeros(len(w), U)
    for i in range(words):
        value[: len(w) - i] += w[i:] * ODD[i % len(ODD)] * U(2 * i + 1)
    at = np.arange(len(w)) - first[owner]
    whole = at + words <= n[owner]
    short = np.flatnonzero((n > 0) & (n < words))
    for s in short:  # fewer than `words` words: all of them are the one shingle
        own = w[first[s] : first[s] + n[s]]
        value[first[s]] = np.sum(own * ODD[: len(own)] * (2 * np.arange(len(own), dtype=U) + U(1)), dtype=U) + U(len(own))
        whole[first[s]] = True
    owner, value = owner[whole], mix(value[whole])
    if not len(owner):
        return owner, value, np.zeros(0, np.int64)
    own = mix(value + owner.astype(U) * GOLD)
    order = np.argsort(own)
    edges = np.flatnonzero(np.concatenate([[True], np.diff(own[order]) != 0]))
    return owner[order[edges]], value[order[edges]], np.diff(np.append(edges, len(order)))


def prob_minhash(owner: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """Registers (n by m, int32) of n weighted sets; sets without elements have all 0."""
    times, kept = np.full(n * m, np.inf), np.zeros(n * m, np.int32)
    live, t, step = np.arange(len(owner)), np.zeros(len(owner)), 0
    while len(live):
        u = mix(value[live] + np.full(1, step + 1, U) * GOLD)
        t[live] += -np.log(((u >> U(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight[live]
        at = owner[live] * m + (mix(u) % U(m)).astype(np.int64)
        near = t[live] < times[at]
        at, who = at[near], live[near]
        np.minimum.at(times, at, t[who])
        first = times[at] == t[who]
        kept[at[first]] = (mix(value[who[first]]) & U(0x7FFFFFFF)).astype(np.int32)
        latest = times.reshape(n, m).max(1)
        live, step = live[t[live] <= latest[owner[live]]], step + 1
    return kept.reshape(n, m)


def by_bytes(sizes: list[int], most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Runs (from, to) of rows of at most that many bytes together, or of one row."""
    begin = held = 0
    for i, n in enumerate(sizes):
        if held + n > most and i > begin:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield begin, len(sizes)


def _sizes(*columns: pa.Array) -> list[int]:
    return np.sum([np.nan_to_num(pc.binary_length(c).to_numpy(zero_copy_only=False)) for c in columns], axis=0).tolist()


def sketch(docs: DataFrame) -> DataFrame:
    """(id, t, key, size, registers) of docs (id, t, text): key tells equal word sequences."""
    ship(docs.sparkSession)

    def work(batches):
        import xxhash

        for batch in batches:
            for begin, end in by_bytes(_sizes(batch.column("text"))):
                part = batch.slice(begin, end - begin)
                texts = part.column("text").to_pylist()
                owner, value, _ = shingles_of(texts)
                found = prob_minhash(owner, value, np.ones(len(value)), len(texts))
                keys = [xxhash.xxh3_128_hexdigest(normal(t)) for t in texts]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(found.reshape(-1)), REGISTERS).cast(pa.list_(pa.int32()))
                size = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_pydict({"id": part.column("id"), "t": part.column("t"), "key": pa.array(keys), "size": size, "registers": lists})

    return docs.mapInArrow(work, f"id {docs.schema['id'].dataType.simpleString()}, t bigint, key string, size bigint, registers array<int>")


_NORMAL = bytes(b if _WORD[b] else 32 for b in range(256))


def normal(text: str) -> bytes:
    """The word sequence as bytes."""
    return b" ".join(plain(text).translate(_NORMAL).split())


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """pairs (a, b) with similar: whether the shingle sets of both texts are that similar."""
    pairs = cut(pairs, "near-pairs")

    def met(rows: DataFrame, end: str, name: str) -> DataFrame:
        sizes = cut(pairs.groupBy(end).agg(F.count(F.lit(1)).alias("n")), "near-sizes")
        return dealt_join(rows, texts.select(F.col("node").alias(end), F.col("text").alias(name)), end, sizes, ["a", "b"])

    both = met(met(pairs, "a", "left"), "b", "right").select("a", "b", "left", "right")

    def work(batches):
        for batch in batches:
            for begin, end in by_bytes(_sizes(batch.column("left"), batch.column("right"))):
                part = batch.slice(begin, end - begin)
                n = part.num_rows
                whose, value, _ = shingles_of([*part.column("left").to_pylist(), *part.column("right").to_pylist()])
                sizes = np.bincount(whose, minlength=2 * n)
                pair = mix(value + (whose % n).astype(U) * GOLD)
                order = np.argsort(pair)
                twice = order[:-1][np.diff(pair[order]) == 0] if len(order) else order
                common = np.bincount(whose[twice] % n, minlength=n)
                union = sizes[:n] + sizes[n:] - common
                yield pa.RecordBatch.from_pydict(
                    {"a": part.column("a"), "b": part.column("b"), "similar": pa.array(common >= least * np.maximum(union, 1) - 1e-9)}
                )

    return both.mapInArrow(work, "a bigint, b bigint, similar boolean")


def first_pass(buckets: DataFrame) -> DataFrame:
    """Pairs (a, b) of buckets (band, node): each node with the leaders of its buckets."""
    n = cut(buckets.groupBy("band").agg(F.count(F.lit(1)).alias("n")), "near-bands")
    told = dealt_join(buckets, n.withColumn("mates", F.col("n")).drop("n"), "band", n, ["node"])
    shared = told.groupBy("node").agg(F.sum("mates").alias("reach"))
    rank = F.row_number().over(Window.partitionBy("band").orderBy(F.desc("reach"), "node"))
    ranked = buckets.join(shared, "node").withColumn("rank", rank).filter(F.col("rank") <= LEADERS)
    leaders = cut(ranked.groupBy("band").agg(F.collect_list("node").alias("leaders")), "near-leaders")
    met = dealt_join(buckets, leaders, "band", n, ["node"]).select("node", F.explode("leaders").alias("leader")).filter("node <> leader")
    return met.select(F.greatest("node", "leader").alias("a"), F.least("node", "leader").alias("b")).distinct()


def cross_links(buckets: DataFrame, roots: DataFrame, nodes: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Similar pairs (a, b) that join the different components (roots) of nodes that share a bucket.

    buckets: (k, band, node, size). A bucket's largest component lies in main blocks, its other nodes in rest blocks;
    each rest block meets the main blocks and the rest blocks from itself on. Of buckets with the same nodes one counts.
    """
    known = cut(buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "near-known")
    sign = [F.bit_xor(F.xxhash64(F.lit(i), "node")).alias(f"x{i}") for i in (0, 1)]
    held = known.groupBy("k", "band", "root").agg(F.count(F.lit(1)).alias("c"), F.sum("size").alias("s"), *sign)
    each = held.groupBy("k", "band").agg(
        F.max_by(F.struct("root", "c", "s"), F.struct("c", "root")).alias("main"), F.sum("c").alias("n"), F.sum("s").alias("bytes"), F.count(F.lit(1)).alias("kinds"),
        F.bit_xor("x0").alias("x0"), F.bit_xor("x1").alias("x1"),
    )
    blocks = lambda n, size: F.greatest(F.lit(1), F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES)).cast("int")
    mixed = each.filter("kinds > 1").select(
        "k", "band", "n", "x0", "x1", F.col("main.root").alias("main"), blocks(F.col("main.c"), F.col("main.s")).alias("mains"),
        blocks(F.col("n") - F.col("main.c"), F.col("bytes") - F.col("main.s")).alias("rests"),
    )
    one = mixed.groupBy("n", "x0", "x1").agg(F.min(F.struct("k", "band", "main", "mains", "rests")).alias("m"))
    mixed = cut(one.select("n", "m.*"), "near-mixed")
    rows = dealt_join(known.drop("k", "size"), mixed.drop("n"), "band", mixed.select("band", "n"), ["node"])
    rows = rows.join(nodes.select("node", "registers"), "node").join(texts, "node")
    part = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    rows = rows.withColumn("block", F.when(F.col("root") == F.col("main"), part("mains")).otherwise(F.col("mains") + part("rests")))
    packed = rows.groupBy("k", "band", "mains", "rests", "block").agg(F.collect_list(F.struct("node", "root", "registers", "text")).alias("held"))
    others = F.concat(F.sequence(F.lit(0), F.col("mains") - 1), F.sequence(F.col("block"), F.col("mains") + F.col("rests") - 1))
    left = packed.filter("block >= mains").withColumn("other", F.explode(others)).select("k", "band", "other", "held")
    met = left.join(packed.select("band", F.col("block").alias("other"), F.col("held").alias("held2")), ["band", "other"])

    def work(batches):
        for batch in batches:
            for k, a, b in zip(batch.column("k").to_pylist(), batch.column("held"), batch.column("held2"), strict=True):
                pairs = crossing(k, a.values, b.values, least)
                yield pa.RecordBatch.from_pydict({"a": pa.array([max(p) for p in pairs], pa.int64()), "b": pa.array([min(p) for p in pairs], pa.int64())})

    return met.select("k", "held", "held2").mapInArrow(work, "a bigint, b bigint").distinct()


def crossing(k: int, a: pa.StructArray, b: pa.StructArray, least: float, slack: float = SLACK) -> list[tuple[int, int]]:
    """A forest of the similar pairs of nodes (node, root, registers, text) of a and b that first meet in bucket k."""
    node_a, node_b = (x.field("node").to_pylist() for x in (a, b))
    root_a, root_b = (x.field("root").to_numpy() for x in (a, b))
    reg_a, reg_b = (x.field("registers").flatten().to_numpy().reshape(len(x), REGISTERS) for x in (a, b))
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while x in above:
            above[x] = x = above.get(above[x], above[x])
        return x

    sets: dict[tuple, np.ndarray] = {}

    def shingles(side: str, texts: pa.Array, i: int) -> np.ndarray:
        if (side, i) not in sets:
            sets[side, i] = np.sort(shingles_of([texts[i].as_py()])[1])
        return sets[side, i]

    found, text_a, text_b = [], a.field("text"), b.field("text")
    for i, (row, root) in enumerate(zip(reg_a, root_a.tolist(), strict=True)):
        equal = reg_b == row
        share = equal.mean(1)
        near = np.flatnonzero((share >= least - slack) & (root_b != root))
        first = equal[near].reshape(len(near), BANDS, REGISTERS // BANDS).all(2).argmax(1)
        near = near[first == k]
        for j in near[np.argsort(-share[near], kind="stable")].tolist():
            x, y = top(root), top(int(root_b[j]))
            if x == y:
                continue
            p, q = shingles("a", text_a, i), shingles("b", text_b, j)
            common = int(np.count_nonzero(q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p)) if len(q) else 0
            if common >= least * max(len(p) + len(q) - common, 1) - 1e-9:
                above[max(x, y)] = min(x, y)
                found.append((node_a[i], node_b[j]))
    return found


def placed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """(id, t, first, class_size), one row for each row of docs; t: the text's hash, first: (no, id, t) of the class's first row."""
    spark = docs.sparkSession
    ship(spark)
    own = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("t", F.xxhash64("text"))
    sketches = cut(sketch(own.select("id", "t", "text")), "near-sketches")
    place = F.struct(F.col("id").isNull().alias("no"), "id", "t")
    nodes = sketches.groupBy("key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies"), F.max("size").alias("size"), F.any_value("registers").alias("registers"))
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    rows = REGISTERS // BANDS
    band = lambda i: F.xxhash64(i, F.slice("registers", i * rows + 1, F.lit(rows)))
    full = nodes.filter(F.exists("registers", lambda r: r != 0))
    banded = full.select("node", "size", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), band)).alias("k", "band"))
    many = cut(banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "near-many")
    buckets = cut(dealt_join(banded, many.select("band"), "band", many, ["node"]), "near-buckets")
    wanted = nodes.join(buckets.select("node").distinct(), "node").select("node", F.col("first.id").alias("_id"), F.col("first.t").alias("_t"))
    wanted = cut(wanted.withColumn("_key", F.xxhash64("_id", "_t")), "near-wanted")
    near = may_be_among(own.withColumn("_key", F.xxhash64("id", "t")), "_key", wanted).drop("_key")
    fits = F.col("id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t"))
    texts = cut(near.join(wanted.drop("_key"), fits).groupBy("node").agg(F.min("text").alias("text")), "near-texts")
    links = verified(first_pass(buckets.select("band", "node")), texts, least).filter("similar").select("a", "b")
    roots = cut(components(links), "near-roots")
    more = cut(cross_links(buckets, roots, nodes, texts, least), "near-links")
    if not more.isEmpty():
        roots = components(more.unionAll(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    placed = nodes.select("key", "node", "first", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = cut(placed, "near-placed")
    classes = placed.groupBy("root").agg(F.min("first").alias("class_first"), F.sum("copies").alias("class_size"), F.count(F.lit(1)).alias("n"))
    classes = cut(classes, "near-classes")
    told = dealt_join(placed.select("key", "root"), classes.drop("n"), "root", classes.select("root", "n"), ["key"])
    sizes = placed.select("key", F.col("copies").alias("n"))
    out = dealt_join(sketches.select("id", "t", "key"), told.select("key", "class_first", "class_size"), "key", sizes, ["id", "t"])
    return out.select("id", "t", F.col("class_first").alias("first"), "class_size")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """(id, class_id, class_size), one row for each row of docs; class_id: the smallest id of the class."""
    return placed_rows(docs, id_col, text_col, least).select("id", F.col("first.id").alias("class_id"), "class_size")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without near-duplicates: of each class one row stays, that with the smallest id (then hash of the text)."""
    placed = cut(placed_rows(docs, id_col, text_col), "near-rows")
    own = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("t") == F.col("first.t"))
    told = placed.groupBy("id", "t").agg(F.max(own).alias("stays"), F.count(F.lit(1)).alias("n"))
    names = {c: free_name(docs.columns, f"near_{c}") for c in ("id", "t", "n", "own")}
    kept = cut(told.filter("stays"), "near-kept").select(F.col("id").alias(names["id"]), F.col("t").alias(names["t"]), F.col("n").alias(names["n"]))
    rows = docs.withColumn(names["own"], F.xxhash64(text_of(text_col)))
    fits = F.col(id_col).eqNullSafe(F.col(names["id"])) & (F.col(names["own"]) == F.col(names["t"]))
    out = rows.join(kept, fits)
    if not kept.filter(F.col(names["n"]) > 1).isEmpty():  # rows that repeat in id and text: one of them stays
        once, many = out.filter(F.col(names["n"]) == 1), out.filter(F.col(names["n"]) > 1)
        out = once.unionAll(many.dropDuplicates([id_col, names["own"]]))
    return out.select([F.col(f"`{c}`") for c in docs.columns])


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_classes(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "class_id", "class_size", (F.col("id") == F.col("class_id")).alias("kept"))


QUERIES = {"op5_minhash_dedup": op5_minhash_dedup}
