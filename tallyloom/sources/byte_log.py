"""A Spark data source of growing log files whose position is a byte in each file.

Batch and stream read lines as (file, offset, line). A stream's offset names for each file the byte up to which it has
been read, always the end of a line: a file that has grown is read from there only, and a restart goes on from the
checkpoint's offset. What lies between two offsets is cut into ranges of at most range_bytes; a range reads the lines
that begin in it, so that large files are dealt out over many tasks. Tasks read ranges through the file system, in
steps, and never hold more than a step and a line.

Defined cases: a last line without its end is read once it has one (batch reads: at once); a file that has become shorter
was replaced and is read from its begin; files that vanish are forgotten; bytes that aren't UTF-8 become replacement
characters; an empty file has no lines.

Options: path (a file or a folder on any file system that pyarrow knows), suffix (of the files below a folder; default
any), range_bytes, offsets (batch only: JSON of file to byte where reading begins).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tallyloom.session import ship

#: Bytes that a task reads, and bytes of one read.
RANGE_BYTES, STEP_BYTES = 32 << 20, 1 << 20
SCHEMA = "file string, offset bigint, line string"


class Range(InputPartition):
    """The lines of a file that begin at first or behind it, and before last."""

    def __init__(self, file: str, first: int, last: int):
        self.file, self.first, self.last = file, first, last


class Store:
    """The files of a path."""

    def __init__(self, path: str, suffix: str = ""):
        from pyarrow import fs

        # Spark writes file:/x where others write file:///x
        uri = re.sub("^file:/+", "file:///", path)
        self.fs, self.path = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), path)
        self.suffix = suffix

    def sizes(self) -> dict[str, int]:
        from pyarrow import fs

        top = self.fs.get_file_info(self.path)
        if top.type == fs.FileType.NotFound:
            return {}
        held = [top] if top.type == fs.FileType.File else self.fs.get_file_info(fs.FileSelector(self.path, recursive=True))
        hidden = lambda p: any(x.startswith(("_", ".")) for x in p.removeprefix(self.path).split("/"))
        return {f.path: f.size for f in held if f.type == fs.FileType.File and f.path.endswith(self.suffix) and not hidden(f.path)}

    def line_end(self, file: str, first: int, last: int) -> int:
        """The end of the last whole line between two bytes, or first if no line ends there; read backwards in steps."""
        with self.fs.open_input_file(file) as f:
            while last > first:
                begin = max(first, last - STEP_BYTES)
                f.seek(begin)
                at = f.read(last - begin).rfind(b"\n")
                if at >= 0:
                    return begin + at + 1
                last = begin
        return first

    def lines(self, span: Range, whole: bool) -> Iterator[tuple[int, bytes]]:
        """(offset, line) of a range; whole: a last line needs no end."""
        with self.fs.open_input_file(span.file) as f:
            at, held = span.first, b""
            if at > 0:  # a line that begins before the range is another range's
                at -= 1
                f.seek(at)
            skip = at < span.first
            while True:
                step = f.read(STEP_BYTES)
                held += step
                begin = 0
                while (end := held.find(b"\n", begin)) >= 0:
                    if skip:
                        skip = False
                    elif at + begin >= span.last:
                        return
                    else:
                        yield at + begin, held[begin:end]
                    begin = end + 1
                at, held = at + begin, held[begin:]
                if (not skip and at >= span.last) or not step:
                    if not step and whole and held and not skip and at < span.last:
                        yield at, held
                    return


def ranges(spans: dict[str, tuple[int, int]], width: int) -> list[Range]:
    """Each file's bytes (first, last) in pieces of at most width."""
    return [Range(file, at, min(at + width, last)) for file, (first, last) in sorted(spans.items()) for at in range(first, last, width)]


def rows(store: Store, span: Range, whole: bool):
    """The lines of a range as batches of about a step."""
    import pyarrow as pa

    held: list[tuple[int, str]] = []
    size = 0

    def batch():
        return pa.RecordBatch.from_pydict({"file": pa.array([span.file] * len(held), pa.string()), "offset": pa.array([o for o, _ in held], pa.int64()), "line": pa.array([x for _, x in held], pa.string())})

    for at, line in store.lines(span, whole):
        held.append((at, line.removesuffix(b"\r").decode("utf-8", "replace")))
        size += len(line) + 64
        if size >= STEP_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


class ByteLogReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.suffix, self.width = options["path"], options.get("suffix", ""), int(options.get("range_bytes", RANGE_BYTES))
        self.offsets = json.loads(options.get("offsets", "{}"))

    def partitions(self) -> list[Range]:
        sizes = Store(self.path, self.suffix).sizes()
        begin = {f: self.offsets.get(f, 0) for f in sizes}
        return ranges({f: (begin[f] if begin[f] <= n else 0, n) for f, n in sizes.items()}, self.width) or [Range("", 0, 0)]

    def read(self, partition: Range):
        return rows(Store(self.path, self.suffix), partition, True) if partition.last else iter(())


class ByteLogStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.suffix, self.width = options["path"], options.get("suffix", ""), int(options.get("range_bytes", RANGE_BYTES))
        self.at: dict[str, int] = {}  # where the last batch that was planned ends

    def initialOffset(self) -> dict:
        return {"files": json.dumps({})}

    def latestOffset(self) -> dict:
        store, before = Store(self.path, self.suffix), self.at
        self.at = {f: store.line_end(f, before.get(f, 0) if before.get(f, 0) <= n else 0, n) for f, n in store.sizes().items()}
        return {"files": json.dumps(self.at, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        begin, ends = json.loads(start["files"]), json.loads(end["files"])
        spans = {f: (begin.get(f, 0) if begin.get(f, 0) <= n else 0, n) for f, n in ends.items()}
        return ranges({f: s for f, s in spans.items() if s[0] < s[1]}, self.width) or [Range("", 0, 0)]

    def read(self, partition: Range):
        return rows(Store(self.path, self.suffix), partition, False) if partition.last else iter(())

    def commit(self, end: dict) -> None:
        pass


class ByteLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "byte_log"

    def schema(self) -> str | StructType:
        return SCHEMA

    def reader(self, schema: StructType) -> ByteLogReader:
        return ByteLogReader(self.options)

    def streamReader(self, schema: StructType) -> ByteLogStream:
        return ByteLogStream(self.options)


def _options(path: str, suffix: str, range_bytes: int, **more) -> dict[str, str]:
    return {"path": path, "suffix": suffix, "range_bytes": str(range_bytes), **{k: str(v) for k, v in more.items() if v}}


def read_log(spark: SparkSession, path: str, offsets: dict[str, int] | None = None, suffix: str = "", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The lines of the files from each file's offset on."""
    ship(spark)
    spark.dataSource.register(ByteLog)
    return spark.read.format("byte_log").options(**_options(path, suffix, range_bytes, offsets=json.dumps(offsets or {}))).load()


def follow_log(spark: SparkSession, path: str, suffix: str = "", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The lines of the files as a stream."""
    ship(spark)
    spark.dataSource.register(ByteLog)
    return spark.readStream.format("byte_log").options(**_options(path, suffix, range_bytes)).load()


def read_chunks(files: DataFrame, max_bytes: int) -> DataFrame:
    """(path, chunk, offset) for rows (path, length, offset) of log files: the bytes from the offset on, at most max_bytes, and the new offset.

    Only these bytes are read. A chunk that doesn't reach the end of the file ends before a character that is cut.
    """

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for path, length, offset in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "offset")), strict=True):
                at = min(offset, length)
                store = Store(path)
                with store.fs.open_input_file(store.path) as f:
                    f.seek(at)
                    raw = f.read(min(max_bytes, length - at))
                keep = len(raw)
                if at + keep < length:
                    # a UTF-8 character has up to three bytes after its first: the longest prefix that is valid
                    keep = next((keep - n for n in range(min(4, keep + 1)) if valid(raw[: keep - n])), keep)
                yield pa.RecordBatch.from_pydict({"path": [path], "chunk": [raw[:keep].decode("utf-8", "replace")], "offset": pa.array([at + keep], pa.int64())})

    return files.select("path", F.col("length").cast("long").alias("length"), F.col("offset").cast("long").alias("offset")).mapInArrow(read, "path string, chunk string, offset bigint")


def valid(raw: bytes) -> bool:
    try:
        raw.decode()
    except UnicodeDecodeError:
        return False
    return True
