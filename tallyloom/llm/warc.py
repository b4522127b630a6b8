"""WARC: write archives, normalise monolithic gzip files, read records back by a sidecar index.

A monolithic archive is one gzip stream over all its records, which nothing can be read from without inflating all
before it. The normaliser inflates such a stream once, piece by piece, writes every record as a gzip member of its
own and keeps a line for each in a sidecar index: offset, length, record id, type. Records are then read by seeking.

Archives are files in the shared folder, written through the file system that its URI names. Each carries the number
of the task attempt that wrote it; only files named in the committed table of an attempt's rows count, so that tasks
may be repeated at any time.

Defined cases: a null html is an empty payload, a null url an empty target; rows equal in id and payload are all
responses; null ids come after all others and refer to the smallest id, or are all responses where a payload has no other;
a very long payload is one record, which the tasks that write and read it hold whole; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import cut, dealt_join, may_be, remove, scratch, text_of
from tallyloom.session import ship, table

#: Bytes of records after which a writer starts another archive.
ROLL_BYTES = 48 << 20
#: Bytes of a normalised archive that one reading task takes.
READ_BYTES = 8 << 20
LEVEL = 6
PIECE = 1 << 20
#: Payloads of fewer bytes are never revisits.
LEAST_REVISIT_BYTES = 0
END = b"\r\n\r\n"


def file_system(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def urn(page) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def head(**fields) -> bytes:
    lines = [f"{k.replace('_', '-')}: {str(v).replace(chr(13), '%0D').replace(chr(10), '%0A')}" for k, v in fields.items() if v is not None]
    return "\r\n".join(["WARC/1.1", *lines]).encode() + END


def record(page, url: str, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """A response record with its payload, or a revisit record with the response's HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None
    return head(
        WARC_Type="revisit" if revisit else "response", WARC_Record_ID=urn(page), WARC_Target_URI=url,
        WARC_Date="2024-01-01T00:00:00Z", WARC_Payload_Digest=f"sha1:{digest}", WARC_Profile=profile,
        WARC_Refers_To=urn(refers_to) if revisit else None, Content_Type="application/http; msgtype=response",
        Content_Length=len(block),
    ) + block + END


def fields_of(header: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in header.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


class Inflated:
    """Bytes of a gzip file (one member or several), inflated piece by piece."""

    def __init__(self, source):
        self.source, self.engine, self.held, self.raw = source, zlib.decompressobj(31), bytearray(), b""

    def more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.source.read(PIECE)
                if not self.raw:
                    return False
            if self.engine.eof:
                self.engine = zlib.decompressobj(31)
            found = self.engine.decompress(self.raw, PIECE)
            self.raw = self.engine.unused_data if self.engine.eof else self.engine.unconsumed_tail
            if found:
                self.held += found
                return True

    def until(self, mark: bytes) -> bytes | None:
        """All up to and with mark; None at the end."""
        at = 0
        while (end := self.held.find(mark, at)) < 0:
            at = max(len(self.held) - len(mark), 0)
            if not self.more():
                return None
        return self.take(end + len(mark))

    def take(self, n: int) -> bytes:
        found = bytes(self.held[:n])
        del self.held[:n]
        return found

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self.more():
                raise ValueError("archive ends within a record")
            found = self.take(min(n, len(self.held)))
            n -= len(found)
            yield found


def normalise_file(source, sink, level: int = LEVEL) -> Iterator[tuple[int, int, str, str]]:
    """Copy source's records to sink, each as its own member; yield (offset, length, record id, type) of each."""
    stream, at = Inflated(source), 0
    while (header := stream.until(END)) is not None:
        fields, begin = fields_of(header), at
        engine = zlib.compressobj(level, zlib.DEFLATED, 31)
        if not fields.get("content-length", "").isdigit():
            raise ValueError(f"record without a length: {fields.get('warc-record-id', '')}")
        n = int(fields["content-length"]) + len(END)
        at += sink.write(engine.compress(header))
        for part in stream.pieces(n):
            at += sink.write(engine.compress(part))
        at += sink.write(engine.flush())
        yield begin, at - begin, fields.get("warc-record-id", ""), fields.get("warc-type", "")


def write_archives(records: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """(archive, n_records): one monolithic gzip file for each partition or roll_bytes of records."""

    def write(batches):
        from pyspark import TaskContext

        task, n_files, count, size, out, engine, path = TaskContext.get(), 0, 0, 0, None, None, ""
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        done = []

        def close():
            out.write(engine.flush())
            out.close()
            done.append((path, count))

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{n_files}.warc.gz"
                    out, engine = fs.open_output_stream(f"{base}/{path}", compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    n_files, count, size = n_files + 1, 0, 0
                digest = base64.b32encode(row["sha1"]).decode()
                data = record(row["page_id"], row["url"], row["payload"], digest, row["first"], row["revisit"])
                out.write(engine.compress(data))
                count, size = count + 1, size + len(data)
                if size >= roll_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["archive", "n_records"])

    return records.mapInArrow(write, "archive string, n_records bigint")


def tasks(spark: SparkSession) -> int:
    """The number of tasks that rows naming much larger files are dealt to; Spark would merge so few bytes into one."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def normalise(archives: DataFrame, folder: str, target: str) -> DataFrame:
    """Normalise the files of folder that archives names; (archive, offset, length, record_id, type) of all records.

    Each normalised file gets a sidecar <file>.idx of tab-separated lines: offset, length, record id, type.
    """
    ship(archives.sparkSession)

    def work(batches):
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        (fs, base), (to, top) = file_system(folder), file_system(target)
        to.create_dir(top, recursive=True)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                own = f"{name.removesuffix('.warc.gz')}-n{attempt}.warc.gz"
                with (
                    fs.open_input_stream(f"{base}/{name}", compression=None) as source,
                    to.open_output_stream(f"{top}/{own}", compression=None) as sink,
                    to.open_output_stream(f"{top}/{own}.idx", compression=None) as index,
                ):
                    rows = []
                    for row in normalise_file(source, sink):
                        index.write("\t".join(map(str, row)).encode() + b"\n")
                        rows.append((own, *row))
                        if len(rows) >= 4096:
                            yield _batch(rows)
                            rows = []
                    if rows:
                        yield _batch(rows)

    # archives are large and each is one stream; a stated number of tasks, as their names alone would be merged into one
    dealt = archives.select("archive").repartition(tasks(archives.sparkSession), "archive")
    return dealt.mapInArrow(work, "archive string, offset bigint, length bigint, record_id string, type string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["archive", "offset", "length", "record_id", "type"])


def read_records(index: DataFrame, target: str) -> DataFrame:
    """(record_id, type, payload_bytes, payload_digest, refers_to) of the indexed records, each read at its offset.

    A response's payload is measured and its digest checked against the header's; a revisit's are those it states.
    """

    def read(batches):
        fs, top = file_system(target)
        name, held = None, None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["archive"] != name:
                    name, held = row["archive"], fs.open_input_file(f"{top}/{row['archive']}")
                data = zlib.decompress(held.read_at(row["length"], row["offset"]), 31)
                header, block = data.split(END, 1)
                http, payload = block.removesuffix(END).split(END, 1) if row["type"] == "response" else (block.split(END, 1)[0], b"")
                fields, sent = fields_of(header), fields_of(http)
                n, digest = int(sent["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
                if row["type"] == "response":
                    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if (len(payload), found) != (n, digest):
                        raise ValueError(f"{row['record_id']}: the payload isn't what the header says")
                rows.append((row["record_id"], row["type"], n, digest, fields.get("warc-refers-to")))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["record_id", "type", "payload_bytes", "payload_digest", "refers_to"],
            )

    part = F.floor(F.col("offset") / READ_BYTES)
    near = index.repartition(tasks(index.sparkSession), "archive", part).sortWithinPartitions("archive", "offset")
    return near.mapInArrow(read, "record_id string, type string, payload_bytes bigint, payload_digest string, refers_to string")


def revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """(page_id, url, payload, sha1, first, revisit); only payloads that may repeat are shuffled."""
    payload = text_of(html_col).cast("binary")
    rows = pages.select(
        F.col(id_col).alias("page_id"), text_of(url_col).alias("url"), payload.alias("payload"),
        F.unhex(F.sha1(payload)).alias("sha1"), F.xxhash64(F.sha1(payload)).alias("_key"),
    )
    firsts = rows.filter(F.octet_length("payload") >= least_bytes).groupBy("_key", "sha1").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("_n")
    )
    firsts = cut(firsts.filter("_n > 1"), "warc-firsts")
    told = may_be(rows, "_key", firsts)
    alone = told.filter("NOT _may").withColumn("first", F.lit(None).cast(rows.schema["page_id"].dataType)).withColumn("revisit", F.lit(False))
    # the payload that most pages share (an empty one, an error page) is dealt out over many tasks
    known = dealt_join(told.filter("_may"), firsts.select("sha1", "first"), "sha1", firsts.select("sha1", F.col("_n").alias("n")), ["page_id", "url"], "left")
    again = (F.octet_length("payload") >= least_bytes) & F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    names = ["page_id", "url", "payload", "sha1", "first", "revisit"]
    return alone.select(names).unionAll(known.withColumn("revisit", again).select(names))


def archive_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_bytes: int = LEAST_REVISIT_BYTES, keep_monolithic: bool = False,
) -> tuple[DataFrame, str]:
    """Write a record for each page, normalise the archives; the index of all records and the archives' folder."""
    spark = pages.sparkSession
    ship(spark)
    folder, target = scratch(spark, "warc-whole"), scratch(spark, "warc-members")
    archives = cut(write_archives(revisits(pages, id_col, url_col, html_col, least_bytes), folder), "warc-archives")
    index = cut(normalise(archives, folder, target), "warc-index")
    if not keep_monolithic:
        remove(spark, folder)
    return index, target


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    index, target = archive_pages(pages)
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    return read_records(index, target).select(
        F.nullif(page("record_id"), F.lit("")).cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), F.nullif(page("refers_to"), F.lit("")).cast("long").alias("refers_to"),
    )


QUERIES = {"op6_warc": op6_warc}
