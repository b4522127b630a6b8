"""Text expressions: normalisation, tokenisers, identifiers and log lines. All are Column builders unless named _udf."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyloom.session import ship

#: Cedilla letters and the comma-below letters that replace them.
CEDILLAS, COMMAS = "şŞţŢ", "șȘțȚ"
#: The marks that the statistics tokeniser strips from both ends of a word.
STRIPPED = ".,;:!?\"'()[]"
#: Marks that may follow the end of a sentence, and those that end one.
CLOSING, SENTENCE_ENDS = "\"'”„»’)]}", (".", "?", "!", "…")
#: Python's white space, which words are split at.
SPACE = r"[\s\x1c-\x1f\x85\xa0  -     　]+"


@F.pandas_udf(StringType())
def nfc_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def normalize_diacritics(c: Column) -> Column:
    """NFC, then comma-below letters. Only texts with combining marks are handed to Python; for others it gets a null."""
    ship(SparkSession.active())
    whole = F.coalesce(nfc_udf(F.when(c.rlike(r"\p{M}"), c)), c)
    return F.translate(whole, CEDILLAS, COMMAS)


def clean_word(c: Column) -> Column:
    """Normalised, upper-cased, without marks at both ends; inner ones stay."""
    return F.regexp_replace(F.upper(normalize_diacritics(c)), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


def ends_sentence(c: Column, ends: tuple[str, ...] = SENTENCE_ENDS) -> Column:
    bare = F.rtrim(F.regexp_replace(c, r"\s+$", ""), F.lit(CLOSING))
    return F.coalesce(F.right(bare, F.lit(1)).isin(*ends) & (F.length(bare) > 0), F.lit(False))


def words(c: Column) -> Column:
    return F.filter(F.split(F.coalesce(c, F.lit("")), SPACE), lambda w: w != "")


def stat_token(w: Column) -> Column:
    return F.upper(F.btrim(w, F.lit(STRIPPED)))


def stat_tokens(c: Column) -> Column:
    """Words of the statistics tokeniser; words of marks alone stay as empty tokens' absence."""
    return F.filter(F.transform(words(c), stat_token), lambda w: w != "")


#: A word that the statistics tokeniser keeps: some of it is neither white space nor stripped.
KEPT_WORD = f"""[^{SPACE[1:-2]}.,;:!?"'()\\[\\]][^{SPACE[1:-2]}]*"""


def stat_token_count(c: Column) -> Column:
    """size(stat_tokens(c)), by one pass of a pattern."""
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(KEPT_WORD))


#: A word, and one with a digit: looked for where a word begins and without going back, so that long words take one pass.
WORD = f"[^{SPACE[1:-2]}]++"
DIGIT_WORD = f"(?<![^{SPACE[1:-2]}])[^{SPACE[1:-2]}0-9]*+[0-9][^{SPACE[1:-2]}]*+"


def digit_share(c: Column) -> Column:
    """Share of words with a digit; null without words. Words are counted by patterns, and only in texts with a digit."""
    some = F.regexp_count(c, F.lit(DIGIT_WORD)) / F.regexp_count(c, F.lit(WORD))
    return F.when(c.rlike("[0-9]"), some).when(c.rlike(WORD), 0.0)


#: Where an id stands in the known forms of a video's address.
VIDEO_URL = r"(?:youtube\.com/watch\?v=|youtu\.be/|youtube\.com/embed/)([A-Za-z0-9_-]{11})"
VIDEO_ID = r"^([A-Za-z0-9_-]{11})$"


def video_id(url: Column) -> Column:
    """The id in a watch, short or embed address, or the whole string if it is one; else null."""
    by = lambda p: F.nullif(F.regexp_extract(url, p, 1), F.lit(""))
    return F.coalesce(by(VIDEO_URL), by(VIDEO_ID))


def rate_bytes(c: Column, default: int = 5 << 20) -> Column:
    """'5M' as bytes; what can't be read is the default."""
    part = lambda i: F.regexp_extract(F.upper(c), r"^([0-9]+)([KMG]?)$", i)
    scale = F.when(part(2) == "K", 1 << 10).when(part(2) == "M", 1 << 20).when(part(2) == "G", 1 << 30).otherwise(1)
    return F.coalesce(part(1).try_cast("long") * scale, F.lit(default).cast("long"))


def frame_rate(c: Column, default: float = 25.0) -> Column:
    """'25/1' as 25.0; anything else, and a divisor of zero, is the default."""
    part = lambda i: F.get(F.split(c, "/"), i).try_cast("double")
    return F.coalesce(F.when(F.size(F.split(c, "/")) == 2, F.try_divide(part(0), part(1))), F.lit(default))


def best_resolution(formats: Column) -> Column:
    """(resolution, fps) of the highest (first of equals) of formats (vcodec, width, height, fps) that has a picture; 'unknown' and 25 without one."""
    seen = F.filter(formats, lambda f: ~f["vcodec"].eqNullSafe("none") & (F.coalesce(f["height"], F.lit(0)) > 0))
    best = F.element_at(F.array_sort(F.transform(seen, lambda f, i: F.struct(f["height"].alias("height"), (-i).alias("i"), f["width"].alias("width"), f["fps"].alias("fps")))), -1)
    size = F.concat(F.coalesce(best["width"].cast("string"), F.lit("?")), F.lit("x"), best["height"].cast("string"))
    some = F.size(seen) > 0
    return F.struct(F.when(some, size).otherwise("unknown").alias("resolution"), F.when(some & (best["fps"] > 0), best["fps"].cast("double")).otherwise(25.0).alias("fps"))


#: Signs of an open licence.
OPEN_LICENCE = ("creative commons", "cc-by", "cc by", "creativecommons.org")


def is_open_licence(licence: Column, description: Column) -> Column:
    held = lambda c, m: F.lower(F.coalesce(c, F.lit(""))).contains(m)
    out = F.lit(False)
    for mark in OPEN_LICENCE:
        out = out | held(licence, mark) | held(description, mark)
    return out


def duration_text(seconds: Column, short: bool = False) -> Column:
    """2h 5m 30s, 5m 30s or 30s; short: hours without seconds."""
    s = F.greatest(F.lit(0), F.floor(F.coalesce(F.nanvl(seconds.cast("double"), F.lit(0.0)), F.lit(0.0)) + 0.5)).cast("long")
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    hours = F.format_string("%dh %dm", h, m) if short else F.format_string("%dh %dm %ds", h, m, r)
    return F.when(h > 0, hours).when(m > 0, F.format_string("%dm %ds", m, r)).otherwise(F.format_string("%ds", r))


ID = r"^([A-Za-z]+)_(\d+)$"


def id_prefix(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, ID, 1), F.lit(""))


def id_number(c: Column) -> Column:
    return F.regexp_extract(c, ID, 2).try_cast("long")


def id_width(c: Column) -> Column:
    return F.length(F.regexp_extract(c, ID, 2))


def log_parts(line: Column) -> Column:
    """(ts, msg) of 'HH:MM:SS | LEVEL | msg' or '[HH:MM:SS] msg'; other lines are a message alone."""
    piped, boxed = r"^(\d{2}:\d{2}:\d{2})\s*\|\s*\w+\s*\|\s*(.*)", r"^\[(\d{2}:\d{2}:\d{2})\]\s*(.*)"
    part = lambda i, rest: F.when(line.rlike(piped), F.regexp_extract(line, piped, i)).when(line.rlike(boxed), F.regexp_extract(line, boxed, i)).otherwise(rest)
    return F.struct(part(1, F.lit("")).alias("ts"), part(2, line).alias("msg"))


#: Words that tell the kind of a log message; the first kind with one counts.
LOG_KINDS = (("error", "error|fail|exception|traceback"), ("warn", "skip|skipping|dropped"), ("success", "done|completed|success|saved|exported|finished|wrote"))


def log_kind(msg: Column) -> Column:
    out = None
    for kind, words_ in LOG_KINDS:
        hit = msg.rlike(f"(?i){words_}")
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("info")


def cell(c: Column) -> Column:
    """A cell as text: '' where it is missing."""
    return F.coalesce(c.cast("string"), F.lit(""))


def number_or_null(c: Column) -> Column:
    """NaN and the text 'nan' are missing."""
    return F.nanvl(F.nullif(F.lower(c.cast("string")), F.lit("nan")).try_cast("double"), F.lit(None).cast("double"))
