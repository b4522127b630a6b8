"""Exact deduplication as a stateful stream, with DataFrame operations only.

A Structured Streaming query keeps one state row for each digest, in RocksDB and without expiry: the smallest stable
identifier, the locator (file and row) of the content that bears it, and the number of rows seen. State and progress
lie in a folder of the caller's choice, so that later files continue where earlier ones ended. A row whose digest has
been seen is a hit; the bytes of every hit are compared with those at the locator, and rows whose digest only happens
to agree are grouped by their bytes instead.

Defined cases: a null text equals an empty one; of equal rows with equal ids the one with the smaller locator stays;
null ids come after all others; an empty table gives an empty result; very long texts are compared like others; other
columns are ignored, also one called _metadata. A digest that a third of all rows bear is dealt out over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import SPACES, cut, dealt_join, may_be_among, salt_count, scratch, text_of

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Members of a group for each salt that its byte comparison is dealt out by.
MEMBERS_A_SALT = 256


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def keyed(rows: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """(_place, _text, _digest): _place sorts in order of precedence and locates the content."""
    source = rows.metadataColumn("_metadata")  # also where the table has a column of that name
    place = F.struct(
        F.col(id_col).isNull().alias("no"), F.col(id_col).alias("id"), source["file_path"].alias("file"), source["row_index"].alias("row")
    )
    return rows.select(
        place.alias("_place"), F.regexp_replace(text_of(text_col), F.lit(f"{SPACES}+"), F.lit(" ")).alias("_text")
    ).withColumn("_digest", F.unhex(digest(F.col("_text"))))


#: Stores give their local disk and memory back once their state is committed to the shared folder, and don't
#: reserve disk ahead of use, so that many small stores cost what they hold.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def run_state(
    spark: SparkSession, path: str, state_dir: str, seen_dir: str, id_col: str = "doc_id", text_col: str = "text",
    digest: Callable[[Column], Column] = sha256, max_files: int | None = None,
) -> DataFrame:
    """Read all files at path that state_dir hasn't seen; (_digest, _first, _n) of every digest so far.

    Each micro-batch leaves the changed state rows below seen_dir under its epoch, so that a repeated batch overwrites.
    """
    schema = spark.read.parquet(path).schema
    source = spark.readStream.schema(schema)
    source = source.option("maxFilesPerTrigger", max_files) if max_files else source
    glob = f"{path[:-1]}[{path[-1]}]"  # the file source takes a single file only as a pattern
    rows = keyed(source.parquet(glob), id_col, text_col, digest).select("_place", "_digest")
    state = rows.groupBy("_digest").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))

    def keep(changed: DataFrame, epoch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{seen_dir}/epoch={epoch}")

    with rocksdb_state(spark):
        query = (
            state.writeStream.outputMode("update").foreachBatch(keep)
            .option("checkpointLocation", state_dir).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    if query.lastProgress is None and not query.recentProgress:
        spark.createDataFrame([], state.schema).write.mode("append").parquet(f"{seen_dir}/epoch=-1")
    seen = spark.read.schema(state.schema).parquet(f"{seen_dir}/epoch=*")
    return seen.groupBy("_digest").agg(F.min("_first").alias("_first"), F.max("_n").alias("_n"))


def collisions(rows: DataFrame, state: DataFrame) -> DataFrame:
    """(_digest, _place, _own, _own_n) of hits whose bytes differ from those at the locator, grouped by their bytes."""
    groups = cut(state.filter("_n > 1"), "exact-groups")
    near = rows.withColumn("_key", F.xxhash64("_digest"))
    near = may_be_among(near, "_key", groups.select(F.xxhash64("_digest").alias("_key"))).drop("_key")
    members = dealt_join(near, groups, "_digest", groups.select("_digest", F.col("_n").alias("n")), ["_place"])
    members = members.withColumn("_salts", salt_count(F.col("_n"), MEMBERS_A_SALT))
    kept = members.filter(F.col("_place") == F.col("_first")).select(
        "_digest", F.col("_text").alias("_kept"), F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt")
    )
    hits = members.filter(F.col("_place") != F.col("_first")).select(
        "_digest", "_place", "_text", F.pmod(F.xxhash64("_place"), F.col("_salts")).cast("int").alias("_salt")
    )
    other = hits.join(kept, ["_digest", "_salt"]).filter(F.col("_text") != F.col("_kept")).select("_digest", "_place", "_text")
    found = cut(other, "exact-collisions")
    own = found.groupBy("_digest", "_text").agg(F.min("_place").alias("_own"), F.count(F.lit(1)).alias("_own_n"))
    return found.join(own, ["_digest", "_text"]).select("_digest", "_place", "_own", "_own_n")


def exact_groups(
    spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
    digest: Callable[[Column], Column] = sha256, state_dir: str | None = None, seen_dir: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """(id, file, row, keep_id, group_size, kept, text_sha256) of every row at path."""
    state_dir, seen_dir = state_dir or scratch(spark, "exact-state"), seen_dir or scratch(spark, "exact-seen")
    state = cut(run_state(spark, path, state_dir, seen_dir, id_col, text_col, digest, max_files), "exact-firsts")
    rows = keyed(spark.read.parquet(path), id_col, text_col, digest)
    apart = collisions(rows, state)
    fewer = apart.groupBy("_digest").agg(F.count(F.lit(1)).alias("_fewer"))
    known, sizes = state.join(fewer, "_digest", "left"), state.select("_digest", F.col("_n").alias("n"))
    whole = rows.select("_digest", "_place", sha256(F.col("_text")).alias("text_sha256"))
    told = dealt_join(whole, known, "_digest", sizes, ["_place"]).join(apart.drop("_digest"), "_place", "left")
    first = F.coalesce("_own", "_first")
    size = F.coalesce(F.col("_own_n"), F.col("_n") - F.coalesce("_fewer", F.lit(0)))
    return told.select(
        F.col("_place.id").alias("id"), F.col("_place.file").alias("file"), F.col("_place.row").alias("row"),
        first["id"].alias("keep_id"), size.alias("group_size"), (first == F.col("_place")).alias("kept"), "text_sha256",
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_groups(spark, f"{sf_dir}/documents.parquet")
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


QUERIES = {"op3_exact_dedup": op3_exact_dedup}

ORACLE = {
    "op3_exact_dedup": rf"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACES}+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
    doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d"""
}
