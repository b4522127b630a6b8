"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Texts are split into pre-tokens. A block of documents lists its distinct pre-tokens, and for each position of each
document the number of the pre-token in this list. The distinct words of all blocks are dealt out by a hash of the word,
each is encoded once, its ids go back to the blocks that have it, and a join on the block's group puts every document
together by position. Decoding joins the ids to the token-byte table. Words, numbers and ids travel packed and compressed,
a row for each block and bucket of words; rows of single words took more than twice the disk.

Defined cases: a null or empty text has no ids and decodes to no bytes; rows with the same id stay separate rows;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import itertools
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import cut_in_buckets, text_of
from tallyloom.session import ship, table

#: Bytes of text whose documents share one list of distinct words; bounds the memory of every Python step.
BLOCK_BYTES = 12 << 20
#: Blocks of a task that are put together by one call; the table of blocks has a file for each such group. More of them, or
#: larger blocks, mean fewer files where executors have more than 3 GB.
BLOCKS_A_GROUP = 1
#: Buckets of distinct words for each shuffle partition.
BUCKETS_A_PARTITION = 2
#: Documents of a block that are put together at a time.
DOCS_A_STEP = 128


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@functools.lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.lru_cache(maxsize=4)
def encoder(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


def pack(arrays: list[np.ndarray], *texts: bytes) -> bytes:
    """Numbers as byte planes and raw bytes, compressed together."""
    import zstandard

    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a, "<u4")
        parts += [struct.pack("<q", len(a)), a.view(np.uint8).reshape(-1, 4).T.tobytes()]
    for t in texts:
        parts += [struct.pack("<q", len(t)), t]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unpack(blob: bytes, n_arrays: int) -> tuple:
    import zstandard

    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(raw):
        (n,) = struct.unpack_from("<q", raw, at)
        at += 8
        if len(out) < n_arrays:
            planes = np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n)
            out.append(np.ascontiguousarray(planes.T).view("<u4").reshape(-1))
            at += 4 * n
        else:
            out.append(raw[at : at + n])
            at += n
    return tuple(out)


def split_blocks(docs: DataFrame, pattern: str, buckets: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per block a row for each bucket of its distinct words, and one (bucket null) for its documents.

    A row of words holds their numbers in the block, lengths and bytes; the row of documents holds for each document
    (ids) its number of words, and the numbers of all these words in order of their positions.
    """
    id_type = docs.schema["id"].dataType.simpleString()

    def split(batches):
        import regex
        from pyspark import TaskContext

        cuts, seq, task = regex.compile(pattern), 0, TaskContext.get().partitionId()
        words: dict[str, int] = {}
        ids, codes, held, kind = [], [], 0, None

        def flush():
            nonlocal words, ids, codes, held, seq
            own = [w.encode() for w in words]
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in own), np.int64, len(own))
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            lists = np.split(order, edges[1:]) if len(order) else []
            blobs = [pack([x, [len(own[i]) for i in x]], b"".join([own[i] for i in x])) for x in lists]
            texts = pack([[len(c) for c in codes], np.concatenate(codes)])
            block, group = (task << 24) + seq, (task << 21) + seq // BLOCKS_A_GROUP
            n = len(blobs)
            yield pa.RecordBatch.from_pydict(
                {
                    "group": pa.array([group] * (n + 1), pa.int64()), "block": pa.array([block] * (n + 1), pa.int64()),
                    "bucket": pa.array([*(int(bucket[x[0]]) for x in lists), None], pa.int32()),
                    "blob": pa.array([*blobs, texts], pa.binary()),
                    "ids": pa.array([*[None] * n, ids], pa.list_(kind)),
                }
            )
            words, ids, codes, held, seq = {}, [], [], 0, seq + 1

        for batch in batches:
            kind = batch.schema.field("id").type
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                codes.append(np.array([words.setdefault(w, len(words)) for w in cuts.findall(text)], "<u4"))
                ids.append(key)
                held += len(text) + 16
                if held >= block_bytes:
                    yield from flush()
        if ids:
            yield from flush()

    return docs.mapInArrow(split, f"group bigint, block bigint, bucket int, blob binary, ids array<{id_type}>")


def encode_buckets(words: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(group, block, blob): the numbers of a block's words in one bucket, how many ids each has, and the ids.

    All blocks' rows of a bucket come to one task, which encodes each of the bucket's distinct words once.
    """

    def encode(batches):
        own, known, now = encoder(ranks_path, pattern), {}, None
        for batch in batches:
            blobs = []
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                if bucket != now:
                    known, now = {}, bucket
                number, size, text = unpack(blob, 2)
                ids, at = [], 0
                for n in size.tolist():
                    word = text[at : at + n]
                    at += n
                    if (found := known.get(word)) is None:
                        found = known[word] = own._encode_single_piece(word)
                    ids.append(found)
                flat = np.fromiter(itertools.chain.from_iterable(ids), np.int64)
                blobs.append(pack([number, [len(i) for i in ids], flat]))
            yield pa.RecordBatch.from_pydict({"group": batch.column("group"), "block": batch.column("block"), "blob": pa.array(blobs, pa.binary())})

    dealt = words.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(encode, "group bigint, block bigint, blob binary")


def decode_documents(encoded: DataFrame, ids_col: str = "ids", out_col: str = "decoded", ranks_path: str | None = None) -> DataFrame:
    """encoded with the bytes of its ids: every id is joined to its row of the token-byte table.

    The table has a row for each token of the vocabulary file, whatever the input, and goes to the tasks as one
    broadcast of two arrays (offsets and bytes), so that the join is a gather.
    """
    ranks = load_ranks(ranks_path or default_ranks())
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, token in ranks.items():
        pieces[token] = piece
    ends = np.cumsum([len(p) for p in pieces])
    held = encoded.sparkSession.sparkContext.broadcast((np.frombuffer(b"".join(pieces), np.uint8), ends))

    def decode(batches):
        bytes_, ends = held.value
        starts = np.concatenate([[0], ends])[:-1]
        for whole in batches:
            for first in range(0, whole.num_rows, DOCS_A_STEP):
                batch, out = whole.slice(first, DOCS_A_STEP), []
                for ids in batch.column(ids_col):
                    at = ids.values.to_numpy()
                    size = ends[at] - starts[at]
                    stop = np.cumsum(size)
                    take = np.arange(stop[-1] if len(stop) else 0) + np.repeat(starts[at] - (stop - size), size)
                    out.append(bytes_[take].tobytes())
                yield batch.append_column(out_col, pa.array(out, pa.binary()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(decode, f"{fields}, {out_col} binary")


def reassemble(words: DataFrame, docs: DataFrame, id_type: str) -> DataFrame:
    """Per block: words (number, ids) joined to the documents' positions, to (id, ids)."""

    def block_lists(blobs: list[bytes], docs_blob: bytes, keys: pa.Array) -> list[pa.Table]:
        held = [unpack(b, 3) for b in blobs]
        number, size, flat = (np.concatenate([np.zeros(0, "<u4"), *x]) for x in (zip(*held, strict=True) if held else [[], [], []]))
        count, start = np.zeros(len(number), np.int32), np.zeros(len(number), np.int32)
        count[number] = size
        start[number] = np.cumsum(size, dtype=np.int32) - size.astype(np.int32)
        flat, out = flat.astype(np.int32), []
        n_words, codes = unpack(docs_blob, 2)
        ends = np.concatenate([[0], np.cumsum(n_words, dtype=np.int64)])
        for at in range(0, len(n_words), DOCS_A_STEP):
            own = ends[at : at + DOCS_A_STEP + 1]
            word = codes[own[0] : own[-1]]
            n_ids = count[word]
            stop = np.cumsum(n_ids, dtype=np.int32)
            take = np.arange(stop[-1] if len(stop) else 0, dtype=np.int32) + np.repeat(start[word] - (stop - n_ids), n_ids)
            edges = np.concatenate([np.zeros(1, np.int32), stop])[own - own[0]]
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat[take]))
            out.append(pa.table({"id": keys.slice(at, len(own) - 1), "ids": lists}))
        return out

    def build(left: pa.Table, right: pa.Table) -> pa.Table:
        blobs: dict[int, list[bytes]] = {}
        for block, blob in zip(left.column("block").to_pylist(), left.column("blob"), strict=True):
            blobs.setdefault(block, []).append(blob.as_py())
        out = []
        for block, keys, blob in zip(right.column("block").to_pylist(), right.column("ids"), right.column("blob"), strict=True):
            out += block_lists(blobs.pop(block, []), blob.as_py(), keys.values)
        return pa.concat_tables(out) if out else pa.table({"id": pa.array([], right.schema.field("ids").type.value_type), "ids": pa.array([], pa.list_(pa.int32()))})

    return words.groupBy("group").cogroup(docs.groupBy("group")).applyInArrow(build, f"id {id_type}, ids array<int>")


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
    pattern: str | None = None, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id_col, ids array<int>), one row for each row of docs."""
    spark = docs.sparkSession
    ship(spark)
    ranks_path, pattern = ranks_path or default_ranks(), pattern or default_pattern()
    own = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    id_type = own.schema["id"].dataType.simpleString()
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) * BUCKETS_A_PARTITION
    blocks = cut_in_buckets(split_blocks(own, pattern, buckets, block_bytes), "bpe_blocks", "group")
    words = encode_buckets(blocks.filter("bucket IS NOT NULL").select("group", "block", "bucket", "blob"), ranks_path, pattern)
    texts = blocks.filter("bucket IS NULL").select(*[F.col(c).alias(c) for c in ("group", "block", "ids", "blob")])
    return reassemble(words, texts, id_type).withColumnRenamed("id", id_col)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decode_documents(encode_documents(table(spark, sf_dir, "documents")))
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.transform("ids", lambda i: i.cast("string")), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op8_bpe": op8_bpe}
