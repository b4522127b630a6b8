"""Cross-tokenizer alignment: postings of linked token pairs, brought together by the id of one side.

Every text is encoded by two tokenizers. Byte offsets at which tokens of both end cut it into groups, and all tokens of
side A are linked with all of side B in their group. A block of documents lists, sorted by pair, in which documents each
pair of ids occurs and how often (postings). They are shuffled by buckets of the A id, a bucket of very many postings by
salts too, as sorted streams that Spark spills: a first pass counts each pair's documents, and the counts of a bucket's
salts are added up. A cogroup of the postings with the counts of their bucket then finds the highest count of each A id
locally and emits what every document gets from this bucket; a last cogroup sums it by document. Postings and what they
contribute travel packed, a row for each block and bucket.

Texts are cut at blanks behind which both tokenizers begin anew, so that what a task has aligned once (up to a bound) is
looked up when it comes again; tokenizers for which no such cut is proved get whole texts.

Defined cases: texts that are null or empty, or whose tokens' bytes differ from blank and text on either side, have no
tokens: zeros and an empty list of groups; rows of the same id, and equal rows, are documents of their own; counts that
tie are all best; very long texts are aligned whole, in a block of their own; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.bpe import default_ranks, encoder, pack, unpack
from tallyloom.llm.common import cut, text_of
from tallyloom.session import ship, table

#: Characters of the texts of a block, and its documents, at most (but for a single longer text).
BLOCK_CHARS, BLOCK_DOCS = 2 << 20, 1 << 16
#: Buckets of A ids: the most rows that a block has for its postings.
BUCKETS = 128
#: Postings that one group of the cogroup reads; buckets with more are dealt out by salts.
GROUP_POSTINGS = 16 << 20
#: Pieces of text that a task keeps aligned, and their characters; with more it begins anew.
MOST_KNOWN, MOST_KNOWN_CHARS = 400_000, 16 << 20
#: Rows of (document, piece) that are expanded to pairs at a time.
PIECES_A_STEP = 1 << 19
#: Pairs of counts that are kept before they are added up.
COUNTS_A_STEP = 1 << 21
#: Where the classes of letters and digits are the same for both byte-level libraries, the faster one is used.
PLAIN = re.compile(r"[\n -~À-ɏ]*").fullmatch


def default_paths() -> tuple[str, str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), default_ranks()


class Sides:
    """Both tokenizers, the bytes of their tokens, and whether texts may be cut at blanks."""

    def __init__(self, a_path: str, b_path: str, a_ranks: str | None):
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.quick = encoder(a_ranks, public_tokenizers.PATTERN).encode_ordinary if a_ranks else None
        self.n_a, self.n_b = self.a.get_vocab_size(), self.b.get_piece_size()
        back = {c: b for b, c in byte_letters().items()}
        a_bytes, special = [b""] * self.n_a, {t.content for t in self.a.get_added_tokens_decoder().values()}
        for entry, i in self.a.get_vocab().items():
            a_bytes[i] = entry.encode() if entry in special else bytes(back[c] for c in entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes = [pa.array(x, pa.large_binary()) for x in (a_bytes, b_bytes)]
        self.sizes = [np.array([len(p) for p in x]) for x in (a_bytes, b_bytes)]
        # each id with what may follow it in a list of groups; '|' and ';' are n places further on
        self.texts = [pa.array([f"{i}{end}" for end in (",", close) for i in range(n)], pa.large_binary()) for n, close in ((self.n_a, "|"), (self.n_b, ";"))]
        told = json.loads(self.a.to_str())
        split = told["pre_tokenizer"] or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not told["normalizer"]
        # no piece holds a blank behind another character: no merge crosses such a place
        self.may_cut = bool(plain) and not any(re.search("[^▁]▁", p) for p in pieces)

    def encode(self, pieces: list[str]) -> tuple[list, list]:
        a: list = [None] * len(pieces)
        if self.quick:
            for i, p in enumerate(pieces):
                if PLAIN(p):
                    a[i] = self.quick(f" {p}")
        rest = [i for i, ids in enumerate(a) if ids is None]
        for i, e in zip(rest, self.a.encode_batch_fast([f" {pieces[i]}" for i in rest], add_special_tokens=False), strict=True):
            a[i] = e.ids
        return a, self.b.encode(pieces, num_threads=1)


def byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary file has for each byte: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def sides(a_path: str, b_path: str, a_ranks: str | None) -> Sides:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    return Sides(a_path, b_path, a_ranks)


def added(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the sum of the values of each."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=key[0] - 1)) if len(key) else np.zeros(0, np.int64)
    return key[first], (np.add.reduceat(value[order], first) if len(key) else value)


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one list behind the other."""
    stop = np.cumsum(size)
    return np.arange(stop[-1] if len(stop) else 0) + np.repeat(start - (stop - size), size)


class Aligned:
    """Per piece of text: numbers of tokens, groups and links, its groups as text, and pairs (a * n_b + b) with their links."""

    def __init__(self, own: Sides, pieces: list[str]):
        ids = list(own.encode(pieces))
        raw = [b" " + p.encode() for p in pieces]
        size = np.array([len(r) for r in raw], np.int64)
        n = [np.array([len(x) for x in side], np.int64) for side in ids]
        flat = [np.fromiter(itertools.chain.from_iterable(side), np.int64, int(m.sum())) for side, m in zip(ids, n, strict=True)]
        self.ok = np.ones(len(pieces), bool)
        whole = pa.py_buffer(b"".join(raw))
        for k in (0, 1):
            if not data_of(own.bytes[k], flat[k]).equals(whole):
                stop = np.cumsum(n[k])
                for i, r in enumerate(raw):
                    self.ok[i] &= bytes(data_of(own.bytes[k], flat[k][stop[i] - n[k][i] : stop[i]])) == r
        if not self.ok.all():
            flat = [f[np.repeat(self.ok, m)] for f, m in zip(flat, n, strict=True)]
            n = [np.where(self.ok, m, 0) for m in n]
            size = np.where(self.ok, size, 0)
        ends = [np.cumsum(own.sizes[k][flat[k]]) for k in (0, 1)]
        common = np.intersect1d(*ends, assume_unique=True)
        group = [np.searchsorted(common, e) for e in ends]
        held = [np.bincount(g, minlength=len(common)) for g in group]
        piece = np.searchsorted(np.cumsum(size), common)
        self.n_a, self.n_b = n
        self.n_groups = np.bincount(piece, minlength=len(pieces))
        self.n_links = np.zeros(len(pieces), np.int64)
        np.add.at(self.n_links, piece, held[0] * held[1])
        self.texts = group_texts(own, flat, group, held, size, piece, len(pieces))
        key, links = group_pairs(own, flat, group, held, len(common))
        at = piece[key // (own.n_a * own.n_b)]
        pair, self.links = added(at * (own.n_a * own.n_b) + key % (own.n_a * own.n_b), links)
        self.n_pairs = np.bincount(pair // (own.n_a * own.n_b), minlength=len(pieces))
        self.pairs = pair % (own.n_a * own.n_b)


def data_of(names: pa.Array, at: np.ndarray) -> pa.Buffer:
    """The bytes of names at these places, joined."""
    took = names.take(pa.array(at))
    edges = np.frombuffer(took.buffers()[1], np.int64)
    held = took.buffers()[2]
    return held.slice(0, int(edges[len(at)])) if held is not None and len(at) else pa.py_buffer(b"")


def group_texts(own: Sides, flat, group, held, size, piece, n: int) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` of each piece."""
    # an A token stands behind all B tokens of earlier groups, a B token behind all A tokens up to its own group
    place = [np.arange(len(flat[0])) + (np.cumsum(held[1]) - held[1])[group[0]], np.arange(len(flat[1])) + np.cumsum(held[0])[group[1]]]
    last = [np.diff(g, append=-1) != 0 for g in group]
    names = pa.concat_arrays(own.texts)
    code = np.empty(len(flat[0]) + len(flat[1]), np.int64)
    code[place[0]] = flat[0] + own.n_a * last[0]
    code[place[1]] = 2 * own.n_a + flat[1] + own.n_b * last[1]
    data = bytes(data_of(names, code)).decode()
    length = pc.binary_length(names).to_numpy(zero_copy_only=False)[code]
    tokens = np.zeros(n, np.int64)
    np.add.at(tokens, piece, held[0] + held[1])
    edges = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(tokens)])].tolist()
    return [data[a : b - 1] if b > a else "" for a, b in zip(edges, edges[1:], strict=False)]


#: Links of a group that are written out; of larger groups the distinct ids are counted before they are linked.
PLAIN_LINKS = 4096


def group_pairs(own: Sides, flat, group, held, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(group * n_a * n_b + a * n_b + b, links) of all groups, not summed."""
    small = held[0] * held[1] <= PLAIN_LINKS
    take = small[group[0]]
    a, g = flat[0][take], group[0][take]
    first = np.cumsum(held[1]) - held[1]
    b = flat[1][spread(first[g], held[1][g])]
    rep = np.repeat(g, held[1][g])
    keys, links = [rep * (own.n_a * own.n_b) + np.repeat(a, held[1][g]) * own.n_b + b], [np.ones(len(b), np.int64)]
    for one in np.flatnonzero(~small):
        (a, m), (b, k) = (np.unique(flat[s][np.searchsorted(group[s], one) : np.searchsorted(group[s], one, "right")], return_counts=True) for s in (0, 1))
        keys.append(((one * own.n_a + np.repeat(a, len(b))) * own.n_b) + np.tile(b, len(a)))
        links.append(np.repeat(m, len(b)) * np.tile(k, len(a)))
    return np.concatenate(keys), np.concatenate(links)


class Known:
    """Pieces that this task has aligned."""

    FIELDS = ("ok", "n_a", "n_b", "n_groups", "n_links", "n_pairs", "pairs", "links")

    def __init__(self, own: Sides):
        self.own, self.number, self.joined, self.chars, self.texts = own, {}, {}, 0, []
        self.held = Aligned(own, [])

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the numbers of its pieces."""
        out, fresh, number = [], [], self.number
        for text in texts:
            if not self.own.may_cut:
                out.append(np.array([self.numbered(text, self.joined, fresh)]))
                continue
            pieces = text.split(" ")
            for p in set(pieces).difference(number):
                # a piece that is empty or ends in white space is read together with the next one
                if p and not p[-1].isspace():
                    self.numbered(p, number, fresh)
                else:
                    number[p] = -1
            codes = np.fromiter(map(number.__getitem__, pieces), np.int64, len(pieces))
            out.append(self.rejoined(pieces, codes, fresh) if len(codes) and codes.min() < 0 else codes)
        if fresh:
            new = Aligned(self.own, fresh)
            for f in self.FIELDS:
                setattr(self.held, f, np.concatenate([getattr(self.held, f), getattr(new, f)]))
            self.texts += new.texts
        return out

    def numbered(self, piece: str, number: dict[str, int], fresh: list[str]) -> int:
        found = number.get(piece)
        if found is None:
            found = number[piece] = len(self.texts) + len(fresh)
            fresh.append(piece)
            self.chars += len(piece)
        return found

    def rejoined(self, pieces: list[str], codes: np.ndarray, fresh: list[str]) -> np.ndarray:
        out, waiting, before = [], [], None
        for p, c in zip(pieces, codes.tolist(), strict=True):
            if c >= 0 and not waiting:
                out.append(c)
                before = p
                continue
            waiting.append(p)
            if c >= 0:
                before, waiting = " ".join(waiting), []
                out.append(self.numbered(before, self.joined, fresh))
        if waiting == [""] and out:  # a blank alone is no text to side B: it stays with the piece before
            waiting = [before, ""]
            out.pop()
        if waiting:
            out.append(self.numbered(" ".join(waiting), self.joined, fresh))
        return np.array(out, np.int64)

    def full(self, most: int, most_chars: int) -> bool:
        return len(self.number) + len(self.joined) > most or self.chars > most_chars


def document_pairs(known: Known, codes: list[np.ndarray], n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(side order of the pair * BLOCK_DOCS + document, links), distinct and sorted; codes[i]: the pieces of document i."""
    own, held = known.own, known.held
    doc = np.repeat(np.arange(n_docs), [len(c) for c in codes])
    n_pieces = len(known.texts)
    key, times = np.unique(doc * n_pieces + np.concatenate([np.zeros(0, np.int64), *codes]), return_counts=True)
    begin = np.cumsum(held.n_pairs) - held.n_pairs
    keys, links = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(key), PIECES_A_STEP):
        step, n = key[at : at + PIECES_A_STEP], times[at : at + PIECES_A_STEP]
        piece = step % n_pieces
        took = spread(begin[piece], held.n_pairs[piece])
        a, b = held.pairs[took] // own.n_b, held.pairs[took] % own.n_b
        side = (a % BUCKETS) * bucket_width(own.n_a) + a // BUCKETS
        k, m = added((side * own.n_b + b) * BLOCK_DOCS + np.repeat(step // n_pieces, held.n_pairs[piece]), held.links[took] * np.repeat(n, held.n_pairs[piece]))
        keys.append(k)
        links.append(m)
    return added(np.concatenate(keys), np.concatenate(links)) if len(keys) > 2 else (keys[-1], links[-1])


def bucket_width(n_a: int) -> int:
    """A ids of a bucket: id a is number a // BUCKETS of bucket a % BUCKETS."""
    return -(-n_a // BUCKETS)


POSTINGS = "block bigint, bucket int, n bigint, blob binary"
COUNTS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint"


def halves(x: np.ndarray) -> list[np.ndarray]:
    return [x & 0xFFFFFFFF, x >> 32]


def whole(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.int64) | (high.astype(np.int64) << 32)


def postings(docs: DataFrame, paths: tuple, digest: bool) -> DataFrame:
    """Per block a row for each bucket with its packed postings, and one (bucket null) for its documents."""
    id_type = docs.schema["id"].dataType.simpleString()

    def split(batches):
        from pyspark import TaskContext

        own, task, seq = sides(*paths), TaskContext.get().partitionId(), 0
        known = Known(own)
        kind = schema = None

        def flush(ids: list, texts: list[str]):
            nonlocal known, seq
            codes, held = known.numbers([t for t in texts if t]), known.held
            codes = iter(codes)
            codes = [next(codes) if t else np.zeros(0, np.int64) for t in texts]
            codes = [c if held.ok[c].all() else c[:0] for c in codes]
            block, n = (task << 32) + seq, len(ids)
            sums = {f: np.array([int(getattr(held, f)[c].sum()) for c in codes], np.int64) for f in ("n_a", "n_b", "n_groups", "n_links")}
            listed = [";".join(map(known.texts.__getitem__, c.tolist())) for c in codes]
            if digest:
                listed = [hashlib.sha256(x.encode()).hexdigest() if len(c) else "" for x, c in zip(listed, codes, strict=True)]
            key, links = document_pairs(known, codes, n)
            pair, doc = key // BLOCK_DOCS, key % BLOCK_DOCS
            width = bucket_width(own.n_a) * own.n_b
            edges = np.searchsorted(pair, np.arange(BUCKETS + 1) * width)
            rows = []
            for k in np.flatnonzero(np.diff(edges)):
                p, d, m = (x[edges[k] : edges[k + 1]] for x in (pair, doc, links))
                first = np.flatnonzero(np.diff(p, prepend=-1))
                step = np.diff(d, prepend=0)
                step[first] = d[first]
                distinct = p[first] - k * width
                rows.append((int(k), len(p), pack([*halves(np.diff(distinct, prepend=0)), np.diff(first, append=len(p)), step, *halves(m)])))
            told = pa.StructArray.from_arrays([pa.array(ids, kind), *map(pa.array, sums.values()), pa.array(listed, pa.string())], fields=list(schema))
            lists = pa.ListArray.from_arrays(pa.array([0] * (len(rows) + 1) + [n], pa.int32()), told)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * (len(rows) + 1), pa.int64()), pa.array([*(r[0] for r in rows), None], pa.int32()), pa.array([*(r[1] for r in rows), 0], pa.int64()),
                 pa.array([*(r[2] for r in rows), None], pa.binary()), lists], names=["block", "bucket", "n", "blob", "docs"],
            )
            seq += 1
            if known.full(MOST_KNOWN, MOST_KNOWN_CHARS):
                known = Known(own)

        ids, texts, held = [], [], 0
        for batch in batches:
            kind = batch.schema.field("id").type
            schema = pa.schema([pa.field("id", kind), *(pa.field(f, pa.int64()) for f in ("n_a", "n_b", "n_groups", "n_links")), pa.field("groups", pa.string())])
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids.append(key)
                texts.append(text)
                held += len(text)
                if held >= BLOCK_CHARS or len(ids) == BLOCK_DOCS:
                    yield from flush(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield from flush(ids, texts)

    return docs.mapInArrow(split, f"{POSTINGS}, docs array<struct<id: {id_type}, {COUNTS.replace(' ', ': ')}, groups: string>>".replace(",:", ","))


def unpacked(blob: bytes) -> tuple[np.ndarray, ...]:
    """(pairs of the bucket, postings of each, document of each posting, its links)."""
    low, high, n, step, m_low, m_high = unpack(blob, 6)
    n, run = n.astype(np.int64), np.cumsum(step, dtype=np.int64)
    first = np.cumsum(n) - n
    doc = run - np.repeat(run[first] - step[first], n)
    return np.cumsum(whole(low, high)), n, doc, whole(m_low, m_high)


def counted(dealt: DataFrame) -> DataFrame:
    """(bucket, pair, docs) of each bucket and salt, from postings that come sorted by them."""

    def count(batches):
        now, pairs, numbers, held = None, [], [], 0

        def told():
            key, n = added(np.concatenate(pairs), np.concatenate(numbers))
            return pa.RecordBatch.from_pydict({"bucket": pa.array(np.full(len(key), now[0], np.int32)), "pair": pa.array(key), "docs": pa.array(n)})

        for batch in batches:
            for bucket, salt, blob in zip(batch.column("bucket").to_pylist(), batch.column("salt").to_pylist(), batch.column("blob"), strict=True):
                if (bucket, salt) != now:
                    if now is not None:
                        yield told()
                    now, pairs, numbers, held = (bucket, salt), [], [], 0
                pair, n, _, _ = unpacked(blob.as_py())
                pairs.append(pair)
                numbers.append(n)
                held += len(pair)
                if held > COUNTS_A_STEP:
                    key, n = added(np.concatenate(pairs), np.concatenate(numbers))
                    pairs, numbers, held = [key], [n], 0
        if now is not None:
            yield told()

    ordered = dealt.sortWithinPartitions("bucket", "salt")
    return ordered.mapInArrow(count, "bucket int, pair bigint, docs bigint").groupBy("bucket", "pair").agg(F.sum("docs").alias("docs"))


def contributions(dealt: DataFrame, counts: DataFrame, n_b: int) -> DataFrame:
    """(block, blob): what the documents of a block get from a bucket: links of best pairs, and the sum of links' counts."""

    def emit(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("pair").to_numpy())
        pair, docs = right.column("pair").to_numpy()[order], right.column("docs").to_numpy()[order]
        side = pair // n_b
        first = np.flatnonzero(np.diff(side, prepend=-1))
        best = docs == np.repeat(np.maximum.reduceat(docs, first), np.diff(first, append=len(side))) if len(first) else docs
        blobs = []
        for blob in left.column("blob"):
            own, n, doc, links = unpacked(blob.as_py())
            at = np.repeat(np.searchsorted(pair, own), n)
            got = np.zeros((2, int(doc.max()) + 1), np.int64)
            np.add.at(got[0], doc, links * best[at])
            np.add.at(got[1], doc, links * docs[at])
            some = np.flatnonzero(got[1])
            blobs.append(pack([np.diff(some, prepend=0), *halves(got[0][some]), *halves(got[1][some])]))
        return pa.table({"block": left.column("block"), "blob": pa.array(blobs, pa.binary())})

    return dealt.groupBy("bucket", "salt").cogroup(counts.groupBy("bucket", "salt")).applyInArrow(emit, "block bigint, blob binary")


def summed(told: DataFrame, docs: DataFrame, id_type: str) -> DataFrame:
    """A row for each document of the blocks, with the sum of its contributions."""

    def build(left: pa.Table, right: pa.Table) -> pa.Table:
        held = pa.concat_arrays(right.column("docs").chunks).flatten()
        got = np.zeros((2, len(held)), np.int64)
        for blob in left.column("blob"):
            step, *parts = unpack(blob.as_py(), 5)
            doc = np.cumsum(step, dtype=np.int64)
            got[0][doc] += whole(*parts[:2])
            got[1][doc] += whole(*parts[2:])
        names = [held.type.field(i).name for i in range(held.type.num_fields)]
        return pa.table({**dict(zip(names, held.flatten(), strict=True)), "n_best": got[0], "count_sum": got[1]})

    schema = f"id {id_type}, {COUNTS}, groups string, n_best bigint, count_sum bigint"
    return told.groupBy("block").cogroup(docs.groupBy("block")).applyInArrow(build, schema)


class Alignment:
    """The postings of a corpus, and what is made of them."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None, a_ranks: str | None = None, digest: bool = False):
        ship(docs.sparkSession)
        own = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
        default = default_paths()
        # ranks are those of the default vocabulary; another one goes without, or names its own
        paths = (a_path or default[0], b_path or default[1], a_ranks or (None if a_path else default[2]))
        self.id_col, self.id_type = id_col, own.schema["id"].dataType.simpleString()
        known = sides(*paths)
        self.n_a, self.n_b = known.n_a, known.n_b
        self.table = cut(postings(own, paths, digest), "alignment-postings")
        sizes = self.table.filter("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # BUCKETS rows at most
        salts = {r.bucket: -(-r.n // GROUP_POSTINGS) for r in sizes}
        self.salts = F.array(*[F.lit(salts.get(k, 1)) for k in range(BUCKETS)])

    def _salts(self) -> Column:
        return F.get(self.salts, F.col("bucket"))

    def dealt(self) -> DataFrame:
        rows = self.table.filter("bucket IS NOT NULL").select("block", "bucket", F.pmod(F.xxhash64("block"), self._salts()).cast("int").alias("salt"), "blob")
        return rows.repartition("bucket", "salt")

    def pair_counts(self) -> DataFrame:
        """(bucket, pair, docs): in how many documents each pair is linked."""
        return counted(self.dealt())

    def pairs(self) -> DataFrame:
        """(a, b, docs): linked ids of both sides, and the number of documents that hold them linked."""
        a = F.floor(F.col("pair") / self.n_b) * BUCKETS + F.col("bucket")
        return self.pair_counts().select(a.cast("int").alias("a"), (F.col("pair") % self.n_b).cast("int").alias("b"), "docs")

    def documents(self) -> DataFrame:
        """(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups), one row for each row of the documents."""
        counts = self.pair_counts().withColumn("salt", F.explode(F.sequence(F.lit(0), (self._salts() - 1).cast("int"))))
        told = contributions(self.dealt(), counts, self.n_b)
        docs = self.table.filter("bucket IS NULL").select("block", "docs")
        return summed(told, docs, self.id_type).withColumnRenamed("id", self.id_col)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = Alignment(table(spark, sf_dir, "documents"), digest=True).documents()
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


QUERIES = {"op12_token_alignment": op12_token_alignment}
