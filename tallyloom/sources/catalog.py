"""Catalog rows and documents, manifests, tables as files, listings, backups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.session import ship
from tallyloom.sources import byte_log

MANIFEST = """video_id string, version int, clips array<struct<clip_id:string, clip_index:int, start:double, end:double, content_start:double,
    boundary_start_type:string, boundary_end_type:string, audio_speaker_label:string,
    words:array<struct<raw:string, clean:string, start:double, end:double, conf:double, spk:string>>>>"""


def to_documents(rows: DataFrame, fields: Mapping[str, str], defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Flat rows to nested documents; fields: column to dotted path. Values equal to their default are left out."""
    tree: dict = {}
    for column, path in fields.items():
        *above, leaf = path.split(".")
        at = tree
        for name in above:
            at = at.setdefault(name, {})
        kept = F.col(column)
        if defaults and column in defaults:
            kept = F.when(~kept.eqNullSafe(F.lit(defaults[column])), kept)
        at[leaf] = kept

    def build(node, name):
        return F.struct(*[build(v, k) for k, v in node.items()]).alias(name) if isinstance(node, dict) else node.alias(name)

    return rows.select(*[build(v, k) for k, v in tree.items()])


def to_rows(documents: DataFrame, fields: Mapping[str, str], defaults: Mapping[str, object] | None = None) -> DataFrame:
    """The inverse: what is missing is its default."""
    value = lambda c, p: F.coalesce(F.col(p), F.lit(defaults[c])) if defaults and c in defaults else F.col(p)
    return documents.select(*[value(c, p).alias(c) for c, p in fields.items()])


def embed_words(words: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """(key, words): rows as an array in order."""
    each = words.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *columns))).alias("x"))
    return each.select(key, F.transform("x", lambda w: F.struct(*[w[c].alias(c) for c in columns])).alias("words"))


def word_rows(documents: DataFrame, key: str, words: str = "words") -> DataFrame:
    return documents.select(key, F.posexplode(words).alias("word_index", "w")).select(key, "word_index", "w.*")


def read_manifests(spark: SparkSession, path: str, video_id: str | None = None) -> DataFrame:
    """A row for each clip; words are null in version 1. Files that can't be read or name another video give none."""
    whole = spark.read.schema(MANIFEST).json(path, multiLine=True, mode="PERMISSIVE").filter("video_id IS NOT NULL AND clips IS NOT NULL")
    own = whole.filter(F.col("video_id") == video_id) if video_id else whole
    return own.select("video_id", F.explode("clips").alias("c")).select("video_id", "c.*")


def manifests(clips: DataFrame) -> DataFrame:
    """(video_id, version, clips) as read_manifests takes them; times rounded to three decimals."""
    words = F.transform("words", lambda w: F.struct(w["raw"].alias("raw"), w["clean"].alias("clean"), F.round(w["start"], 3).alias("start"), F.round(w["end"], 3).alias("end"), w["conf"].alias("conf"), w["spk"].alias("spk")))
    one = clips.withColumn("words", words)
    return one.groupBy("video_id").agg(F.lit(2).alias("version"), F.sort_array(F.collect_list(F.struct("clip_index", F.struct(*[c for c in one.columns if c != "video_id"]).alias("c")))).alias("x")).select(
        "video_id", "version", F.transform("x", lambda x: x["c"]).alias("clips"))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def export_csv(rows: DataFrame, path: str, flags: Sequence[str] = ()) -> None:
    """Flags 0, 1 and null become False, True and ''."""
    named = {c: F.when(F.col(c).isNull(), "").when(F.col(c) == 0, "False").otherwise("True") for c in flags}
    rows.withColumns(named).write.mode("overwrite").csv(path, header=True, emptyValue="")


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """(segment_id, status, transcript_edited, trimmed) of a JSON object by segment; unknown states are ''."""
    text = spark.read.text(path, wholetext=True)
    held = text.select(F.explode(F.from_json("value", "map<string,struct<status:string,transcript_edited:boolean,trimmed:boolean>>")).alias("segment_id", "v"))
    status = F.when(F.col("v.status").isin("approved", "rejected"), F.col("v.status")).otherwise("")
    return held.select("segment_id", status.alias("status"), F.coalesce("v.transcript_edited", F.lit(False)).cast("int").alias("transcript_edited"), F.coalesce("v.trimmed", F.lit(False)).cast("int").alias("trimmed"))


def import_verdicts(current: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Verdicts that change something: known segments without a status of their own."""
    return verdicts.filter("status <> ''").join(current.filter("coalesce(review_status, '') = ''").select("segment_id"), "segment_id", "left_semi")


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, modified) of the files below path; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select(
        "path", "length", F.col("modificationTime").alias("modified"))


def log_chunks(spark: SparkSession, path: str, offsets: DataFrame, max_bytes: int = 512 << 10) -> DataFrame:
    """(path, chunk, offset) of log files below path: the bytes from each file's offset on, at most max_bytes, and the new offset.

    offsets: (path, offset); a file that isn't named is read from its begin. Nothing before an offset is read.
    """
    ship(spark)
    files = listing(spark, path).select("path", "length")
    return byte_log.read_chunks(files.join(offsets.select("path", "offset"), "path", "left").withColumn("offset", F.coalesce("offset", F.lit(0))), max_bytes)


def merged(rows: DataFrame, words: DataFrame, key: str, order: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """rows with their words embedded in order (null without any), and the keys of words that no row has."""
    held = embed_words(words, key, order, columns)
    return rows.join(held, key, "left"), held.select(key).join(rows.select(key), key, "left_anti")


def array_counts(documents: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """One row: documents and, for each array, how many items all of them hold."""
    return documents.agg(F.count(F.lit(1)).alias("documents"), *[F.coalesce(F.sum(F.greatest(F.size(a), F.lit(0))), F.lit(0)).alias(a) for a in arrays])


def import_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """(video_id, url) of lines 'URL' or 'id URL', behind the other columns; blank lines and comments give none."""
    parts = F.split(F.trim(column), r"\s+")
    own = lines.filter(F.trim(column) != "").filter(~F.trim(column).startswith("#"))
    return own.select(*[c for c in lines.columns if c != column], F.when(F.size(parts) > 1, F.get(parts, F.lit(0))).alias("video_id"), F.element_at(parts, -1).alias("url"))


def backup(tables: Mapping[str, DataFrame], path: str) -> None:
    for name, rows in tables.items():
        rows.write.mode("overwrite").option("compression", "gzip").json(f"{path}/{name}", ignoreNullFields=False)


def restore(spark: SparkSession, path: str, schemas: Mapping[str, StructType]) -> dict[str, DataFrame]:
    return {name: spark.read.schema(schema).json(f"{path}/{name}") for name, schema in schemas.items()}


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either that the other lacks, counted; empty if both are equal as bags."""
    return a.exceptAll(b).withColumn("side", F.lit("first")).unionByName(b.exceptAll(a).withColumn("side", F.lit("second")))
