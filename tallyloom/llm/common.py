"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import shared_dir

#: The white space of the contracts: blank and tab to carriage return.
SPACES = r"[\x20\x09-\x0D]"


#: Scratch paths and tables that this driver has made and not yet removed.
_MADE: dict[str, str] = {}


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark)}/tallyloom/{what}-{uuid.uuid4().hex}"
    _MADE[path] = "path"
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove all scratch tables and paths made so far, once the results that read them have been written."""
    n = len(_MADE)
    for name, kind in list(_MADE.items()):
        spark.sql(f"DROP TABLE IF EXISTS {name}") if kind == "table" else remove(spark, name)
        _MADE.pop(name, None)
    return n


def cut(df: DataFrame, what: str, codec: str = "zstd") -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there and survives lost executors."""
    path = scratch(df.sparkSession, what)
    df.write.option("compression", codec).parquet(path)
    held = df.sparkSession.read.schema(df.schema).parquet(path)
    held.scratch_path = path
    return held


def discard(held: DataFrame) -> None:
    """Remove a table of cut() that nothing reads any more."""
    remove(held.sparkSession, held.scratch_path)
    _MADE.pop(held.scratch_path, None)


def cut_in_buckets(df: DataFrame, what: str, key: str) -> DataFrame:
    """As cut, but as a table bucketed by key in the warehouse, so that a later grouping by key needs no shuffle of it."""
    spark, name = df.sparkSession, f"tallyloom_{what}_{uuid.uuid4().hex}"
    _MADE[name] = "table"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("compression", "zstd").bucketBy(n, key).saveAsTable(name, format="parquet")
    return spark.table(name)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that no later read needs."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def source_files(df: DataFrame) -> list[str]:
    return df.inputFiles()


def free_name(taken: list[str], name: str) -> str:
    """name, or name with underscores in front until it clashes with no column (case aside)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def text_of(column: str = "text"):
    """The text column; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def salt_count(members, per_salt: int):
    """How many salts a group of that many members gets."""
    return F.greatest(F.lit(1), F.ceil(members / F.lit(per_salt))).cast("int")


#: A key with more than one of so many rows is heavy; there are fewer heavy keys than that, whatever the input.
HEAVY = 4096


def dealt_join(
    rows: DataFrame, keyed: DataFrame, key: str, sizes: DataFrame, spread: list[str], how: str = "inner", total: int | None = None
) -> DataFrame:
    """rows joined to keyed (unique in key), with the rows of heavy keys dealt out by salts.

    sizes: (key, n), how many rows each key has; total: their sum, if it is known. Only the names of heavy keys and their
    numbers of salts are broadcast, fewer than HEAVY rows of two numbers, with fewer than 2 * HEAVY salts in all.
    spread: columns that tell the rows of a key apart.
    """
    if total is None:
        total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t")).first()["t"]
    share = max(total / HEAVY, 1.0)
    heavy = sizes.filter(F.col("n") > share).select(F.col(key).alias("_heavy"), F.ceil(F.col("n") / share).cast("int").alias("_salts"))
    heavy = F.broadcast(heavy)
    left = rows.join(heavy, F.col(key) == F.col("_heavy"), "left")
    left = left.withColumn("_salt", F.when(F.col("_salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread), F.col("_salts"))).cast("int"))
    right = keyed.join(heavy, F.col(key) == F.col("_heavy"), "left")
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
    return left.drop("_heavy", "_salts").join(right.drop("_heavy", "_salts"), [key, "_salt"], how).drop("_salt")


#: The filter of may_be has FILTER_SHARE bits a key, and 2 ** MOST_BITS (32 MB) at most; BITMAP_BITS of them are a row.
FILTER_SHARE = 16
LEAST_BITS, MOST_BITS = 18, 28
BITMAP_BITS = 32768


def words_of_map(bitmap: Column) -> Column:
    """A bitmap's bytes as numbers of 64 bits; bit i of the map is bit i % 64 of number i / 64."""
    byte = lambda i, k: F.hex(F.substring(bitmap, i * 8 + (8 - k), F.lit(1)))
    return F.transform(F.sequence(F.lit(0), F.lit(BITMAP_BITS // 64 - 1)), lambda i: F.conv(F.concat(*[byte(i, k) for k in range(8)]), 16, -10).cast("bigint"))


def key_bits(keys: DataFrame) -> int | None:
    """Bits of a bitmap for the keys, by their number up to a fixed bound; None if there are too many for it to tell much."""
    n = keys.count()
    return None if n > 1 << (MOST_BITS - 1) else min(max((FILTER_SHARE * n).bit_length(), LEAST_BITS), MOST_BITS)


def bitmap_rows(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(_part, _map): the bitmap of keys (64-bit hashes), 4 kB a row."""
    bit = F.pmod(F.col(key), F.lit(1 << bits))
    parts = keys.select(F.floor(bit / BITMAP_BITS).cast("int").alias("_part"), (bit % BITMAP_BITS).alias("_bit"))
    return parts.groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_map"))


def may_be(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """rows with _may: false only if the key (a 64-bit hash) is surely not among keys.

    The keys set bits of a bitmap, sized by their number up to a fixed bound, which is broadcast. With more keys than half
    of the bound's bits it would tell little and is left out: all rows then have a true _may, so that the join behind it
    has more to do but finds the same.
    """
    bits = key_bits(keys)
    if bits is None:
        return rows.withColumn("_may", F.lit(True))
    # each row of the bitmap as 512 numbers, so that a look-up is an index and a shift
    held = bitmap_rows(keys, key, bits).select("_part", words_of_map(F.col("_map")).alias("_words"))
    at = F.pmod(F.col(key), F.lit(BITMAP_BITS)).cast("int")
    part = F.shiftright(F.pmod(F.col(key), F.lit(1 << bits)), BITMAP_BITS.bit_length() - 1).cast("int")
    near = rows.join(F.broadcast(held), part == F.col("_part"), "left")
    hit = F.getbit(F.get("_words", F.shiftright(at, 6)), at.bitwiseAND(63)) == 1
    return near.withColumn("_may", F.coalesce(hit, F.lit(False))).drop("_part", "_words")


def shared_bitmap(keys: DataFrame, key: str):
    """The bitmap for Python tasks: a broadcast of (bits, bytes), at most 32 MB, or None if there are too many keys."""
    bits = key_bits(keys)
    if bits is None:
        return None
    whole = bytearray((1 << bits) // 8)
    for part, held in bitmap_rows(keys, key, bits).toLocalIterator():
        whole[part * BITMAP_BITS // 8 : (part + 1) * BITMAP_BITS // 8] = held
    return keys.sparkSession.sparkContext.broadcast((bits, bytes(whole)))


def may_be_among(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """rows without most of those whose key is not among keys; none of the others is lost."""
    return may_be(rows, key, keys).filter("_may").drop("_may")
