"""Removal of repeated byte strings by content-chosen grams and shrinking runs of windows, in place of prefix doubling.

Every string of LENGTH bytes that also starts earlier is covered and removed. All positions of all texts take part, but
most of them drop out before anything is shuffled much:

1. Each window of LENGTH bytes names one of its grams of GRAM bytes, the one with the least hash (leftmost of equals).
   Equal windows name equal grams, so a window whose gram is unique is unique. Named grams, one in about thirty
   positions, are counted over the corpus, and unique ones drop out.
2. What is left grows: a gram with all bytes that any of its windows can reach is a context. All windows in a context
   that occurred before did so too; only the first occurrence of each context goes on, and of these only the ones that
   share GROW bytes more on one side with another context.
3. The windows of these go on in runs of 16, then 4, then 1: a run is
   named by all its bytes and by those that all its windows share. Spark sorts and groups the names with the positions;
   a run whose shared bytes are unique drops out, all windows of a run that occurred before are repeats, and what is left
   is split. So a border of a repeated passage takes a few rows instead of one for each window.

Names are 64-bit hashes; a decision to remove rests on two of them (gram and context, or two of the run).

Defined cases: a null text is an empty one; texts shorter than LENGTH stay whole; null ids come after all others, and
of rows with equal ids the hash of the text decides which is earlier; rows equal in id and text are alike and don't
count as earlier than each other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tallyloom.llm.common import cut, dealt_join, discard, may_be, may_be_among, shared_bitmap, text_of
from tallyloom.llm.minhash_dedup import BASE, GOLD, ODD, U, _powers, mix
from tallyloom.session import ship, table

LENGTH = 100
GRAM = 40
SIDE = LENGTH - GRAM
GROW = SIDE // 2
#: The codec of tables of hashes, which hardly shrink.
HASHES = "lz4_raw"
#: Bytes of text that numpy works on at a time; positions in them take 24 bits.
CHUNK = 1 << 17
LOW = U((1 << 24) - 1)
_INDEX = np.arange(CHUNK + 4 * LENGTH, dtype=U)


class Names:
    """Names of spans of a chunk of bytes, from prefix sums of a polynomial."""

    def __init__(self, raw: np.ndarray):
        n = len(raw)
        self.down = _table(pow(int(BASE), -1, 1 << 64), n)
        self.sums = np.concatenate([np.zeros(1, U), np.cumsum((raw.astype(U) + U(1)) * _table(int(BASE), n), dtype=U)])

    def __call__(self, start: np.ndarray, length) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.down[start] + np.asarray(length).astype(U) * GOLD)


_TABLES: dict[int, np.ndarray] = {}


def _table(base: int, n: int) -> np.ndarray:
    if len(_TABLES.get(base, ())) < n:
        _TABLES[base] = _powers(base, max(n, CHUNK + 4 * LENGTH))
    return _TABLES[base][:n]


def chunks(raws: list[bytes]):
    """Yield (bytes, pieces); a piece is (text number, its length, offset of the piece in it, place in the chunk, from,
    to): windows that start in from..to (in the text) are the piece's own."""
    held, pieces, size = [], [], 0
    for number, raw in enumerate(raws):
        for begin in range(0, max(len(raw) - LENGTH + 1, 0), CHUNK):
            end = min(begin + CHUNK, len(raw) - LENGTH + 1)
            offset = max(begin - LENGTH, 0)
            part = raw[offset : end + 2 * LENGTH]
            if held and size + len(part) > CHUNK:
                yield np.frombuffer(b"".join(held), np.uint8), pieces
                held, pieces, size = [], [], 0
            pieces.append((number, len(raw), offset, size, begin, end))
            held.append(part)
            size += len(part)
    if held:
        yield np.frombuffer(b"".join(held), np.uint8), pieces


def anchors(raw: np.ndarray, pieces: list[tuple], grams_only: bool = False) -> dict[str, np.ndarray]:
    """The named grams of a chunk: text number, position, bytes reachable left and right, gram, context, grown names."""
    names = Names(raw)
    n = len(raw) - GRAM + 1
    at = _INDEX[:n] if n <= len(_INDEX) else np.arange(n, dtype=U)
    # a gram's rank among its neighbours: the high bits of a product, then its position; its name mixes all bits
    least = ((names.sums[GRAM:] - names.sums[:-GRAM]) * names.down[:n] * ODD[0] & ~LOW) | at
    size = 1
    while size * 2 <= SIDE + 1:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    if rest := SIDE + 1 - size:
        least = np.minimum(least[:-rest], least[rest:])
    number, length, offset, place, begin, end = (np.array(x) for x in zip(*pieces, strict=True))
    inside = np.zeros(len(least) + 1, np.int8)
    np.add.at(inside, begin - offset + place, 1)
    np.add.at(inside, end - offset + place, -1)
    own = np.cumsum(inside[:-1], dtype=np.int8) > 0
    own[1:] &= (least[1:] != least[:-1]) | ~own[:-1]  # windows in a row that name one gram
    named = np.unique(least[own] & LOW).astype(np.int64)
    gram = names(named, GRAM)
    if grams_only:
        return {"gram": gram}
    piece = np.searchsorted(place, named, side="right") - 1
    pos = named - place[piece] + offset[piece]
    left, right = np.minimum(pos, SIDE), np.minimum(length[piece] - pos - GRAM, SIDE)
    context = names(named - left, left + GRAM + right) ^ mix((left * 1000 + right).astype(U))
    grown = [np.where(room >= GROW, names(np.where(room >= GROW, named + by, named), np.where(room >= GROW, GRAM + GROW, 0)), U(0)) for room, by in ((left, -GROW), (right, 0))]
    return {"number": number[piece], "pos": pos, "left": left, "right": right, "gram": gram, "context": context, "grown_left": grown[0], "grown_right": grown[1]}


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == U else x.astype(np.int64))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int | None]:
    """(doc, id, raw) and the bits of a position: doc sorts in order of precedence and tells rows apart.

    Where ids are whole numbers, none missing or twice, and id and position fit one number together, doc is the id and a
    place is such a number. Elsewhere (bits: None) doc is a struct of the id and the text's hash.
    """
    own = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    if isinstance(own.schema["id"].dataType, IntegralType):
        size = F.max(F.octet_length("text"))
        n, some, kinds, low, high, longest = own.agg(F.count(F.lit(1)), F.count("id"), F.count_distinct("id"), F.min("id"), F.max("id"), size).first()
        bits = (longest or 0).bit_length() + 1
        if n and n == some == kinds and low >= 0 and high < 1 << (62 - bits):
            return own.select(F.col("id").cast("bigint").alias("doc"), "id", F.col("text").cast("binary").alias("raw")), bits
    doc = F.struct(F.col("id").isNull().alias("no"), "id", F.xxhash64("text").alias("t"))
    return own.select(doc.alias("doc"), "id", F.col("text").cast("binary").alias("raw")), None


def place(bits: int | None, pos: str = "pos"):
    """Sorts in order of precedence."""
    return F.struct("doc", pos) if bits is None else F.shiftleft("doc", bits) + F.col(pos)


def doc_and_pos(bits: int | None, c: str = "place") -> list:
    if bits is None:
        return [F.col(f"{c}.doc").alias("doc"), F.col(f"{c}.pos").alias("pos")]
    return [F.shiftright(c, bits).alias("doc"), F.col(c).bitwiseAND((1 << bits) - 1).cast("int").alias("pos")]


def hash_of(doc: str = "doc"):
    return F.xxhash64(doc)


def gram_names(rows: DataFrame) -> DataFrame:
    """(gram) of every named gram."""

    def work(batches):
        for batch in batches:
            for raw, pieces in chunks(batch.column("raw").to_pylist()):
                yield pa.RecordBatch.from_pydict({"gram": _long(anchors(raw, pieces, True)["gram"])})

    return rows.select("raw").mapInArrow(work, "gram bigint")


def gram_rows(rows: DataFrame, twice: DataFrame) -> DataFrame:
    """(doc, pos, reach, gram, context, grown_left, grown_right) of the named grams that may be among twice (gram)."""
    numbers, wanted = ("gram", "context", "grown_left", "grown_right"), shared_bitmap(twice, "gram")

    def work(batches):
        bits, held = wanted.value if wanted else (0, b"\xff")
        bitmap = np.frombuffer(held, np.uint8)
        for batch in batches:
            for raw, pieces in chunks(batch.column("raw").to_pylist()):
                found = anchors(raw, pieces)
                at = found["gram"] & U((1 << bits) - 1)
                keep = (bitmap[(at >> U(3)).astype(np.int64)] >> (at & U(7)).astype(np.uint8)) & 1 == 1
                found = {n: v[keep] for n, v in found.items()}
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc": batch.column("doc").take(pa.array(found["number"])), "pos": pa.array(found["pos"].astype(np.int32)),
                        "reach": pa.array((found["left"] * 256 + found["right"]).astype(np.int32)),
                    } | {n: _long(found[n]) for n in numbers}
                )

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.select("doc", "raw").mapInArrow(work, f"doc {kind}, pos int, reach int, " + ", ".join(f"{n} bigint" for n in numbers))


def pair(a: str, b: str):
    """Two whole numbers from 0 to 2 ** 31 - 1 as one."""
    return F.shiftleft(F.col(a).cast("bigint"), 32) + F.col(b)


def pairs_of(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lists of pairs: the number of the list, and both parts."""
    flat = lists.flatten().to_numpy()
    return np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), flat >> 32, flat & 0xFFFFFFFF


def context_bytes(texts: DataFrame) -> DataFrame:
    """(doc, pos, left, right, bytes) of the contexts (pos, reach) listed with each text."""

    def work(batches):
        for batch in batches:
            owner, pos, reach = pairs_of(batch.column("spans"))
            begin, end = pos - reach // 256, pos + GRAM + reach % 256
            for first in range(0, len(owner), 1 << 16):
                part = slice(first, first + (1 << 16))
                raws = {i: batch.column("raw")[i].as_py() for i in np.unique(owner[part]).tolist()}
                held = [raws[i][a:b] for i, a, b in zip(owner[part].tolist(), begin[part].tolist(), end[part].tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc": batch.column("doc").take(pa.array(owner[part])), "pos": pa.array(pos[part], pa.int32()), "left": pa.array(reach[part] // 256, pa.int32()),
                        "right": pa.array(reach[part] % 256, pa.int32()), "bytes": pa.array(held, pa.binary()),
                    }
                )

    kind = texts.schema["doc"].dataType.simpleString()
    return texts.select("doc", "raw", "spans").mapInArrow(work, f"doc {kind}, pos int, left int, right int, bytes binary")


def joined_texts(rows: DataFrame, lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows (doc, ...) split into those that may be in lists (doc, ...), left-joined to it, and those surely not in it."""
    told = may_be(rows.withColumn("_key", hash_of()), "_key", lists.select(hash_of().alias("_key"))).drop("_key")
    return told.filter("_may").drop("_may").join(lists, "doc", "left"), told.filter("NOT _may").drop("_may")


def whole_copies(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows (doc, id, raw) split into first or only bearers of their text, and later ones.

    Equal digests (SHA-256) are equal texts. Only texts whose 64-bit hash repeats are digested and shuffled.
    """
    own = rows.withColumn("_key", F.xxhash64("raw"))
    twice = cut(own.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_key"), "suffix-twins")
    told = may_be(own, "_key", twice).drop("_key")
    near = told.filter("_may").drop("_may").withColumn("digest", F.unhex(F.sha2("raw", 256)))
    groups = cut(near.groupBy("digest").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n")), "suffix-copies")
    near = dealt_join(near, groups.drop("n"), "digest", groups.select("digest", "n"), ["doc"])
    near = cut(near.withColumn("later", F.col("doc") != F.col("first")).drop("digest", "first"), "suffix-bearers")
    return told.filter("NOT _may").drop("_may").unionAll(near.filter("NOT later").drop("later")), near.filter("later").drop("later")


#: Numbers of windows in a run, from one level to the next.
RUNS = (16, 4, 1)


def runs_of(held: DataFrame, width: int) -> DataFrame:
    """held (.., low, high) split into runs of width windows; a window is known by its bytes left of the gram, low..high.

    core names the bytes that all windows of the whole run share, so that runs with equal windows have equal cores; one
    names all bytes of those windows that the text has room for.
    """
    begin = F.explode(F.sequence(F.floor(F.col("low") / width).cast("int") * width, F.col("high"), F.lit(width)))
    some = held.withColumn("run", begin)
    some = some.withColumns({"low": F.greatest("low", "run"), "high": F.least(F.col("high"), F.col("run") + width - 1)})
    shared = LENGTH - (F.least(F.col("run") + width - 1, F.lit(SIDE)) - F.col("run"))
    core = F.substring("bytes", F.col("left") - F.col("run") + 1, shared)
    whole = F.substring("bytes", F.col("left") - F.col("high") + 1, LENGTH + F.col("high") - F.col("low"))
    return some.withColumn("start", F.col("pos") - F.col("high")).withColumns({"core": F.xxhash64("run", core), "one": F.xxhash64(F.lit(1), whole)}).drop("run")


def doubled(rows: DataFrame, contexts: DataFrame, bits: int | None) -> DataFrame:
    """(doc, low, high) of windows in contexts (doc, pos, reach) whose bytes start earlier too."""
    lists = cut(contexts.groupBy("doc").agg(F.collect_set(pair("pos", "reach")).alias("spans")), "suffix-lists")
    met, _ = joined_texts(rows, lists)
    texts = met.filter("spans IS NOT NULL").dropDuplicates(["doc"])
    held = context_bytes(texts).withColumns({"low": F.greatest(SIDE - F.col("right"), F.lit(0)), "high": F.least("left", F.lit(SIDE))}).filter("low <= high")
    held, found = cut(held, "suffix-bytes"), []
    source = held
    for width in RUNS:
        near = runs_of(held, width)
        if width > 1:  # a run of one window is its own core
            cores = cut(near.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core"), "suffix-cores")
            near = cut(may_be_among(near, "core", cores), "suffix-runs")
            discard(source)
            source = near
        at = place(bits, "start") if bits else F.struct("doc", F.col("start").alias("pos"))
        twice = near.groupBy("core", "one").agg(F.min(at).alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        twice = cut(twice, "suffix-firsts")
        told = may_be(near, "one", twice)
        same = told.filter("_may").drop("_may").join(twice, ["core", "one"], "left")
        again = F.col("kept").isNotNull() & (at != F.col("kept"))
        span = [F.col("start").alias("low"), (F.col("pos") - F.col("low") + LENGTH).alias("high")]
        found.append(cut(same.filter(again).select("doc", *span), "suffix-covered"))
        names = ["doc", "pos", "left", "right", "bytes", "low", "high"]
        held = told.filter("NOT _may").select(names).unionAll(same.filter(~again).select(names))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def repeated_spans(rows: DataFrame, bits: int | None) -> DataFrame:
    """(doc, low, high): spans of rows (doc, raw) that strings starting earlier cover; they may overlap."""
    twice = gram_names(rows).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    grams = cut(gram_rows(rows, cut(twice, "suffix-twice", HASHES)), "suffix-grams", HASHES)
    firsts = grams.groupBy("gram", "context").agg(F.min(place(bits)).alias("place"), F.count(F.lit(1)).alias("n"))
    firsts = cut(firsts, "suffix-contexts", HASHES)
    known = firsts.select("gram", "context", F.col("place").alias("kept"), "n")
    # the first occurrence of each context goes on, all later ones are covered as far as the context reaches
    met = grams.join(known, ["gram", "context"])
    first = place(bits) == F.col("kept")
    room = F.floor(F.col("reach") / 256) + GRAM + F.col("reach") % 256 >= LENGTH
    low = F.col("pos") - F.floor(F.col("reach") / 256)
    covered = met.filter("n > 1").filter(~first & room).select("doc", low.cast("int").alias("low"), (F.col("pos") + GRAM + F.col("reach") % 256).cast("int").alias("high"))
    side = lambda i, c: F.struct(F.lit(i).alias("s"), F.col(c).alias("v"))
    own = met.filter(first).select("doc", "pos", "reach", F.explode(F.array(side(0, "grown_left"), side(1, "grown_right"))).alias("x"))
    sides = cut(own.filter("x.v <> 0").select("doc", "pos", "reach", F.xxhash64("x.s", "x.v").alias("grown")), "suffix-sides", HASHES)
    shared = cut(sides.groupBy("grown").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("grown"), "suffix-grown")
    contexts = may_be_among(sides, "grown", shared).select("doc", "pos", "reach")
    return covered.unionAll(doubled(rows, contexts, bits))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept bytes), one row for each row of docs."""
    ship(docs.sparkSession)
    rows, bits = keyed(docs, id_col, text_col)
    rows, copies = whole_copies(rows)
    spans = repeated_spans(rows, bits).groupBy("doc").agg(F.collect_list(pair("low", "high")).alias("spans"))
    met, alone = joined_texts(rows, cut(spans, "suffix-removed"))

    def work(batches):
        for batch in batches:
            out, (owner, low, high) = [], pairs_of(batch.column("spans"))
            edges = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                raw = np.frombuffer(batch.column("raw")[i].as_buffer(), np.uint8)
                step = np.bincount(low[a:b], minlength=len(raw) + 1) - np.bincount(high[a:b], minlength=len(raw) + 1)
                gone = np.cumsum(step[:-1]) > 0
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(raw), int(gone.sum()), runs, raw[~gone].tobytes()))
            if out:
                n, removed, runs, kept = zip(*out, strict=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch.column("id"), "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                        "n_spans": pa.array(runs, pa.int64()), "kept": pa.array(kept, pa.binary()),
                    }
                )

    kind = rows.schema["id"].dataType.simpleString()
    cut_out = met.filter("spans IS NOT NULL").select("id", "raw", "spans").mapInArrow(work, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    size = F.length("raw").cast("bigint")
    row = lambda df, removed, kept: df.select("id", size.alias("n_bytes"), removed.alias("n_removed"), (removed > 0).cast("bigint").alias("n_spans"), kept.alias("kept"))
    gone = F.when(F.length("raw") >= LENGTH, size).otherwise(0).cast("bigint")
    zero, raw = F.lit(0).cast("bigint"), F.col("raw")
    whole = row(met.filter("spans IS NULL"), zero, raw).unionAll(row(alone, zero, raw))
    return cut_out.unionAll(whole).unionAll(row(copies, gone, F.when(gone == 0, raw).otherwise(F.lit(b""))))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
