"""Annotation texts: labelled lines for the transcript, then a row for each word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = "array<struct<word:string,start:double,end:double,score:double>>"
#: Fixed value: the line above the words.
HEADER = "WORD START END ASDSCORE"


def read(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of whole annotation files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def field(content: Column, label: str) -> Column:
    """The text after the last line that begins with label; null without one."""
    hits = F.regexp_extract_all(content, F.lit(rf"(?m)^\s*{label}:[ \t]*(.*?)\s*$"), 1)
    return F.when(F.size(hits) > 0, F.element_at(hits, -1))


def parse(files: DataFrame, after_header: bool = False, default_conf: int = 0) -> DataFrame:
    """files with text, original, conf and words; after_header: only lines below the header are words."""
    below = F.when(F.instr("content", HEADER[:14]) > 0, F.regexp_replace("content", r"(?s)^.*?WORD START END[^\n]*", "")).otherwise(F.lit(""))
    lines = F.split(below if after_header else F.col("content"), r"\r?\n")
    parts = F.transform(lines, lambda x: F.split(F.trim(x), r"\s+"))
    own = F.filter(parts, lambda p: (F.size(p) >= 4) & ~F.element_at(p, 1).rlike("^(Original|Text|Conf):") & (F.array_join(F.slice(p, 1, 3), " ") != HEADER[:14]))
    words = F.transform(own, lambda p: F.struct(
        F.element_at(p, 1).alias("word"), *[F.element_at(p, i).try_cast("double").alias(n) for i, n in ((2, "start"), (3, "end"), (4, "score"))]))
    return files.select(
        *[c for c in files.columns if c != "content"], F.coalesce(field(F.col("content"), "Text"), F.lit("")).alias("text"),
        field(F.col("content"), "Original").alias("original"), F.coalesce(field(F.col("content"), "Conf").try_cast("int"), F.lit(default_conf)).alias("conf"),
        words.cast(WORDS).alias("words"),
    )


def render(missing_score: float = 8.0) -> Column:
    """The annotation of columns text, original, conf and words; times with two decimals, scores with one."""
    line = lambda w: F.format_string("%s %.2f %.2f %.1f", w["word"], w["start"], w["end"], F.coalesce(w["score"], F.lit(missing_score)))
    head = [F.concat(F.lit("Text:  "), "text"), F.when(F.col("original").isNotNull(), F.concat(F.lit("Original:  "), "original")), F.concat(F.lit("Conf:  "), F.col("conf").cast("string")), F.lit(HEADER)]
    return F.concat_ws("\n", *head, F.transform("words", line))


def write(rows: DataFrame, path: str, key: str) -> None:
    """One folder of text for each key: the content is a single row, so each file is a whole annotation."""
    rows.select(key, render().alias("value")).write.partitionBy(key).mode("overwrite").option("lineSep", "\n").text(path)
