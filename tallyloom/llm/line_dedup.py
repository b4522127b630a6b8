"""Line deduplication by content-defined chunks of lines, with DataFrame operations only.

Each line has a hash, and a polynomial hash rolls over the hashes of ROLL lines. Chunks end where it is a local minimum,
at about every third line, so that the same lines give the same chunks wherever a document holds them. A run too short to
hold two such ends still gives the same windows: every line begins one, which ends with the line that brings it over
LEAST_WORDS words. A chunk of several lines or a window that an earlier place (smaller id, or further up in the same
document) holds too is removed once the bytes of both are seen to agree. So every run of whole lines with more than
LEAST_WORDS words that repeats goes, and what is shorter goes only as a chunk of several lines.

Defined cases: a null text is an empty text with one empty line; a line's words are its blanks and one more; rows equal
in id and text count as one document and are treated alike; a piece's first place is the smallest (id, null ids last;
text hash; line); very long texts have more pieces, none longer than a chunk or 51 lines; an empty table gives an empty
result; other columns are carried along untouched. Pieces that very many documents hold are dealt out over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import cut, dealt_join, free_name, may_be_among, text_of
from tallyloom.session import table

#: Chunks of fewer lines are never removed.
LEAST_LINES = 2
#: Windows have more words than this.
LEAST_WORDS = 50
#: Lines that the rolling hash covers, its base and its modulus.
ROLL = 3
BASE = 1_000_003
PRIME = (1 << 31) - 1
#: A piece is one number: first line, then number of lines in the low bits.
LINES_BITS = 31


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def chunked(rows: DataFrame) -> DataFrame:
    """rows with _text, plus _lines and _chunks: (first line, number of lines) of each chunk."""
    at = lambda name, i: F.get(F.col(name), i)
    rolled = lambda i: sum((F.coalesce(at("_hashes", i - k), F.lit(0)) * F.lit(pow(BASE, k, PRIME)) for k in range(ROLL)), F.lit(0)) % PRIME
    last = F.size("_lines") - 1
    low = lambda i: (i > 0) & (at("_rolled", i) < at("_rolled", i - 1)) & (at("_rolled", i) <= at("_rolled", i + 1))
    start = lambda k: F.when(k == 0, F.lit(0)).otherwise(at("_ends", k - 1) + 1)
    return (
        rows.withColumn("_lines", F.split("_text", "\n"))
        .withColumn("_hashes", F.transform("_lines", line_hash))
        .withColumn("_rolled", F.transform("_hashes", lambda h, i: rolled(i)))
        .withColumn("_ends", F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | low(i)))
        .withColumn("_chunks", F.transform("_ends", lambda e, k: F.struct(start(k).alias("at"), (e - start(k) + 1).alias("n"))))
        .drop("_hashes", "_rolled", "_ends")
    )


def piece_number(c: Column) -> Column:
    return c["at"].cast("long") * (1 << LINES_BITS) + c["n"]


def windows(words: str, least: int) -> Column:
    """For each line the (first line, number of lines) of the window that it begins, where the text has words enough."""
    grow = lambda a, w: F.when(a["w"] > least, a).otherwise(F.struct((a["n"] + 1).alias("n"), (a["w"] + w).alias("w")))
    none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("w"))
    each = F.transform(words, lambda _, i: F.struct(i.alias("at"), F.aggregate(F.slice(words, i + 1, F.lit(least + 1)), none, grow).alias("x")))
    enough = F.filter(each, lambda e: e["x"]["w"] > least)
    return F.transform(enough, lambda e: F.struct(e["at"].alias("at"), e["x"]["n"].alias("n")))


def chunk_rows(docs: DataFrame, id_col: str, text_col: str, least_lines: int, least_words: int) -> DataFrame:
    """(_hash, _place, _n_lines, _piece) of every chunk of enough lines and every window; _place sorts in order of precedence."""
    rows = chunked(docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")))
    rows = rows.withColumn("_words", F.transform("_lines", lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1))
    chunks = F.transform(F.filter("_chunks", lambda c: c["n"] >= least_lines), piece_number)
    both = F.array_union(chunks, F.transform(windows("_words", least_words), piece_number))
    # one row for each piece holds its own lines only, taken from the text before the pieces part
    begin, n = (lambda p: F.shiftright(p, LINES_BITS).cast("int")), (lambda p: p.bitwiseAND((1 << LINES_BITS) - 1).cast("int"))
    piece = lambda p: F.struct(begin(p).alias("at"), n(p).alias("n"), F.array_join(F.slice("_lines", begin(p) + 1, n(p)), "\n").alias("piece"))
    pieces = rows.select("_id", F.xxhash64("_text").alias("_t"), F.explode(F.transform(both, piece)).alias("_c"))
    place = F.struct(F.col("_id").isNull().alias("no"), F.col("_id").alias("id"), F.col("_t").alias("t"), F.col("_c.at").alias("at"))
    return pieces.select(F.xxhash64("_c.piece").alias("_hash"), place.alias("_place"), F.col("_c.n").alias("_n_lines"), F.col("_c.piece").alias("_piece"))


def repeated_chunks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_lines: int = LEAST_LINES, least_words: int = LEAST_WORDS
) -> DataFrame:
    """(_place, _n_lines) of every chunk or window that an earlier place holds byte for byte."""
    rows = chunk_rows(docs, id_col, text_col, least_lines, least_words)
    counted = rows.groupBy("_hash").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    firsts = cut(counted.filter("_n > 1"), "line-firsts")
    near = may_be_among(rows, "_hash", firsts)
    sizes = firsts.select("_hash", F.col("_n").alias("n"))
    found = cut(dealt_join(near, firsts.drop("_n"), "_hash", sizes, ["_place"]), "line-found")
    here = found.filter(F.col("_place") == F.col("_first")).select("_hash", F.col("_piece").alias("_kept")).dropDuplicates(["_hash"])
    later = found.filter(F.col("_place") != F.col("_first")).select("_hash", "_place", "_n_lines", "_piece")
    same = F.col("_piece") == F.col("_kept")
    compared = dealt_join(later, here, "_hash", sizes, ["_place"]).select("_hash", "_place", "_n_lines", same.alias("_same"), F.when(~same, F.col("_piece")).alias("_piece"))
    told = cut(compared, "line-compared")
    # pieces whose hash only happens to agree with that of another piece: these few are grouped by their bytes
    other = told.filter("NOT _same").drop("_same")
    own = other.groupBy("_hash", "_piece").agg(F.min("_place").alias("_first"))
    again = other.join(own, ["_hash", "_piece"]).filter(F.col("_place") != F.col("_first"))
    return told.filter("_same").select("_place", "_n_lines").unionAll(again.select("_place", "_n_lines"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_lines: int = LEAST_LINES,
    carry: list[str] | None = None, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """(row struct of the carried columns, n_lines, n_removed, n_chunks, kept_text), one row for each document."""
    carry = docs.columns if carry is None else carry
    lines = F.sequence(F.col("_place.at"), F.col("_place.at") + F.col("_n_lines") - 1)
    gone = (
        repeated_chunks(docs, id_col, text_col, least_lines, least_words)
        .select(F.col("_place.id").alias("_gone_id"), F.col("_place.t").alias("_gone_t"), F.explode(lines).alias("_line"))
        .groupBy("_gone_id", "_gone_t").agg(F.collect_set("_line").alias("_gone"))
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(id_col).alias("_id"), text_of(text_col).alias("_text")
    ).withColumn("_t", F.xxhash64("_text"))
    fits = F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_t") == F.col("_gone_t"))
    held = chunked(rows.join(gone, fits, "left").drop("_gone_id", "_gone_t"))
    n = F.size("_lines")
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), n - 1), F.col("_gone")))
    held = held.withColumn("_stay", F.when(F.col("_gone").isNotNull(), stay))
    removed = F.when(F.col("_gone").isNull(), 0).otherwise(n - F.size("_stay"))
    text = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(F.transform("_stay", lambda i: F.get(F.col("_lines"), i)), "\n"))
    told = held.select(
        "row", n.cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"),
        F.size("_chunks").cast("long").alias("n_chunks"), text.alias("kept_text"),
    )
    # a generator keeps later filters from being pushed into the array functions, which would repeat them for each line
    return told.select(F.inline(F.array(F.struct(*told.columns))))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """docs with the kept lines as text (and their length, where docs has that column); emptied documents go."""
    text = free_name(docs.columns, "kept_text")
    out = dedup_lines(docs, id_col, text_col).filter("NOT (n_removed > 0 AND n_removed = n_lines)")
    out = out.select("row.*", F.col("kept_text").alias(text))
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.length(text).cast(docs.schema[length_col].dataType))
    return out.withColumn(text_col, F.when(F.col(text_col).isNotNull(), F.col(text))).select(docs.columns)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("row.doc_id", "n_lines", "n_removed", "n_chunks", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES = {"op10_line_dedup": op10_line_dedup}

ORACLE = {
    "op10_line_dedup": f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i, line, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h, length(line) - length(replace(line, ' ', '')) + 1 AS w
    FROM (SELECT doc_id, i, ls[i + 1] AS line FROM (SELECT doc_id, ls, unnest(range(0, len(ls))) AS i FROM d))),
r AS (SELECT *, (h + coalesce(lag(h) OVER o, 0) * {BASE} + coalesce(lag(h, 2) OVER o, 0) * {pow(BASE, 2, PRIME)}) % {PRIME} AS r,
    sum(w) OVER o AS upto FROM l WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
e AS (SELECT *, lead(i) OVER o IS NULL OR (r < lag(r) OVER o AND r <= lead(r) OVER o) AS ends FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
k AS (SELECT *, coalesce(sum(CASE WHEN ends THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM e),
c AS (SELECT doc_id, k, min(i) AS s, max(i) AS til FROM k GROUP BY doc_id, k),
w AS (SELECT a.doc_id, a.i AS s, min(b.i) AS til FROM r a JOIN r b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + {LEAST_WORDS}
    AND b.upto > a.upto - a.w + {LEAST_WORDS} GROUP BY a.doc_id, a.i),
p AS (SELECT doc_id, s, til FROM c WHERE til - s + 1 >= {LEAST_LINES} UNION SELECT doc_id, s, til FROM w),
t AS (SELECT p.doc_id, s, til, string_agg(line, chr(10) ORDER BY i) AS piece FROM p JOIN l ON p.doc_id = l.doc_id AND i BETWEEN s AND til
    GROUP BY p.doc_id, s, til),
g AS (SELECT doc_id, s, til FROM t QUALIFY row_number() OVER (PARTITION BY piece ORDER BY doc_id, s) > 1),
x AS (SELECT DISTINCT l.doc_id, l.i FROM l JOIN g ON l.doc_id = g.doc_id AND l.i BETWEEN s AND til)
SELECT l.doc_id, count(*) AS n_lines, count(x.i) AS n_removed, any_value(n.n) AS n_chunks,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE x.i IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN x ON l.doc_id = x.doc_id AND l.i = x.i JOIN (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id) n ON n.doc_id = l.doc_id
GROUP BY l.doc_id"""
}
