"""URL filters: host and path rules, and naive Bayes over words segmented from host and path.

Names in urls are often words written together. The counts of the corpus's own words give a unigram model; Viterbi
finds the likeliest split of each distinct name, with words of any length. Hosts with a seed word are examples to block;
the seeds themselves are no features of these examples but prior counts of the class, so that what else such urls share
is learned. All other urls are unlabelled: expectation maximisation starts them as allowed and judges them again after
each of ROUNDS fits of the multinomial naive Bayes over the words of host and path. Rules come first: of those whose host
fits (itself or a parent domain) and whose path starts the url's path, the longest decides.

Everything that doesn't depend on a single url is done once for each distinct host and path shape (numbers replaced by
a mark), and each distinct name is split once.

Defined cases: a null url, or one without ://, has an empty host and path, no rule and the verdict of no words at all;
a null html has no words; repeated rows are judged alike; a score of 0 allows; of equally likely splits the one with the
longer last word counts; very long names are split like others, from rows of one part each; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import cut, dealt_join, may_be_among, text_of
from tallyloom.session import ship, table

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Words that mark a host as an example to block. They count as words of the corpus, and so often as tokens of the class.
SEEDS = ("ads", "adult", "bet", "casino", "malware", "phishing", "poker", "porn", "spam", "tracker", "warez", "xxx")
SEED_COUNT = 1000
SEED_TOKENS = 50
#: Fits of naive Bayes; each but the first takes its labels from the one before.
ROUNDS = 3
NUMBER = "0"
SMOOTHING = 0.5
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; empty without ://."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, UPPER.lower()), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null if none does."""
    name = verdict = None
    for rule, says in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        domain, slash, below = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + below)
        name = F.when(fits, rule) if name is None else name.when(fits, rule)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def names_in(text: Column) -> Column:
    """Runs of letters, lower-cased, and a mark for each run of digits."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|\p{N}+)"), 1)
    return F.transform(runs, lambda r: F.when(r.rlike(r"^\p{N}"), F.lit(NUMBER)).otherwise(r))


def word_counts(pages: DataFrame, html_col: str) -> DataFrame:
    """(word, n): the visible words of all pages, counted in each batch before the shuffle."""
    ship(pages.sparkSession)

    def count(batches):
        import regex

        hidden = regex.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&\w+;")
        word = regex.compile(r"\p{L}+")
        for batch in batches:
            seen: dict[str, int] = {}
            for html in batch.column(0).to_pylist():
                for w in word.findall(hidden.sub(" ", html).lower()):
                    seen[w] = seen.get(w, 0) + 1
            yield pa.RecordBatch.from_pydict({"word": pa.array(seen.keys(), pa.string()), "n": pa.array(seen.values(), pa.int64())})

    return pages.select(text_of(html_col).alias("html")).mapInArrow(count, "word string, n bigint")


def viterbi(name: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The likeliest split of name; known: counts of its parts that are words. Ties: the longer last word.

    A part that isn't a word has the probability 10 / (total * 10 ** length), of which long parts soon have none. Its
    logarithm falls evenly with the length, so that one running maximum stands for all of them.
    """
    ends: dict[int, list[int]] = {}
    for start, end in sorted(known):
        ends.setdefault(end, []).append(start)
    letter = math.log(10)
    best, last = [0.0], [0]
    other, begin = 0.0, 0
    for end in range(1, len(name) + 1):
        top, at = other + math.log(10 / total) - end * letter, begin
        for start in ends.get(end, ()):
            p = best[start] + math.log(known[start, end] / total)
            if p > top + 1e-12 or abs(p - top) <= 1e-12 and start < at:
                top, at = p, start
        best.append(top)
        last.append(at)
        if top + end * letter > other:
            other, begin = top + end * letter, end
    words, end = [], len(name)
    while end:
        words.append(name[last[end] : end])
        end = last[end]
    return words[::-1]


def segment(names: DataFrame, counts: DataFrame, seeds: Sequence[str] = SEEDS) -> DataFrame:
    """(name, words) of each distinct name; counts: (word, n), may have a word more than once."""
    spark = names.sparkSession
    ship(spark)
    extra = spark.createDataFrame([(w, SEED_COUNT) for w in seeds], "word string, n bigint")
    lexicon = cut(counts.select("word", "n").unionAll(extra).groupBy("word").agg(F.sum("n").alias("count")), "url-lexicon")
    total, longest = lexicon.agg(F.coalesce(F.sum("count"), F.lit(1)), F.coalesce(F.max(F.length("word")), F.lit(1))).first()
    own = names.filter("name <> ''").distinct()
    at = own.select("name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("at"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(longest), F.length("name") - F.col("at") + 1))
    parts = at.select("name", "at", F.explode(sizes).alias("n")).select("name", "at", "n", F.substring("name", F.col("at"), F.col("n")).alias("word"))
    keyed = lexicon.withColumn("_key", F.xxhash64("word"))
    near = cut(may_be_among(parts.withColumn("_key", F.xxhash64("word")), "_key", keyed.select("_key")).drop("_key"), "url-parts")
    often = cut(near.groupBy("word").agg(F.count(F.lit(1)).alias("n")).join(lexicon, "word"), "url-words")
    met = dealt_join(near, often.select("word", "count"), "word", often.select("word", "n"), ["name", "at"])
    known = met.groupBy("name").agg(F.collect_list(F.struct("at", "n", "count")).alias("known"))
    found = own.join(known, "name", "left").select("name", F.coalesce("known", F.array().cast(known.schema["known"].dataType)).alias("known"))

    def split(batches):
        for batch in batches:
            out = []
            for name, known in zip(batch.column("name").to_pylist(), batch.column("known").to_pylist(), strict=True):
                held = {(k["at"] - 1, k["at"] - 1 + k["n"]): k["count"] for k in known}
                out.append(viterbi(name, held, total))
            yield pa.RecordBatch.from_pydict({"name": batch.column("name"), "words": pa.array(out, pa.list_(pa.string()))})

    return found.mapInArrow(split, "name string, words array<string>")


def token_weights(tokens: DataFrame, seeds: Sequence[str] = SEEDS) -> DataFrame:
    """(token, weight, n): log odds of block against allow by multinomial naive Bayes, and the rows of each token.

    tokens: (token, block, seeded, n). Seed tokens of seeded examples don't count; the class has SEED_TOKENS of each seed
    instead. Each class's total and the number of distinct tokens are three numbers, read here.
    """
    seed = F.col("token").isin([f"h:{w}" for w in seeds])
    counts = F.when(~(seed & F.col("seeded")), F.col("n")).otherwise(0)
    each = tokens.groupBy("token").agg(
        (F.sum(F.when(F.col("block"), counts).otherwise(0)) + F.when(seed, SEED_TOKENS).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("block"), 0).otherwise(counts)).alias("good"), F.count(F.lit(1)).alias("n"),
    )
    each = cut(each, "url-tokens")
    bad, good, kinds = each.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0)), F.count(F.lit(1))).first()
    share = lambda n, of: F.log((F.col(n) + SMOOTHING) / (of + SMOOTHING * max(kinds, 1)))
    return each.select("token", (share("bad", bad) - share("good", good)).alias("weight"), "n")


def url_kinds(urls: DataFrame, words_from: DataFrame, html_col: str, seeds: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(host, shape, n), and its tokens (host, shape, n, token, times): the words of the names in host and path."""
    kinds = cut(urls.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n")), "url-kinds")
    in_host = F.transform(names_in(F.col("host")), lambda x: F.struct(F.lit("h").alias("part"), x.alias("name")))
    in_path = F.transform(F.filter(F.split("shape", " "), lambda x: x != ""), lambda x: F.struct(F.lit("p").alias("part"), x.alias("name")))
    named = cut(kinds.select("host", "shape", "n", F.explode(F.concat(in_host, in_path)).alias("x")).select("host", "shape", "n", "x.*"), "url-named")
    often = cut(named.groupBy("name").agg(F.count(F.lit(1)).alias("n")), "url-often")
    words = cut(segment(often.select("name"), word_counts(words_from, html_col), seeds), "url-names")
    met = dealt_join(named, words, "name", often, ["host", "shape"])
    tokens = met.select("host", "shape", "n", "part", F.explode("words").alias("word")).select("host", "shape", "n", F.concat_ws(":", "part", "word").alias("token"))
    return kinds, cut(tokens.groupBy("host", "shape", "n", "token").agg(F.count(F.lit(1)).alias("times")), "url-held")


def judge(
    pages: DataFrame, words_from: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    rules: Sequence[tuple[str, str]] = RULES, seeds: Sequence[str] = SEEDS, rounds: int = ROUNDS,
) -> DataFrame:
    """(id, host, path, rule, verdict, score), one row for each page; score: log odds of block."""
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("shape", F.array_join(names_in(F.col("path")), " "))
    kinds, held = url_kinds(urls, words_from or pages, html_col, seeds)
    seeded = held.groupBy("host", "shape").agg(F.max(F.col("token").isin([f"h:{w}" for w in seeds])).alias("seeded"))
    labels = kinds.join(seeded, ["host", "shape"], "left").select("host", "shape", "n", F.coalesce("seeded", F.lit(False)).alias("seeded"))
    scored = cut(labels.withColumn("block", F.col("seeded")), "url-labels")
    for _ in range(rounds):
        known = held.drop("n").join(scored.select("host", "shape", "n", "seeded", "block"), ["host", "shape"])
        weights = cut(token_weights(known.select("token", "block", "seeded", (F.col("n") * F.col("times")).alias("n")), seeds), "url-weights")
        blocked, whole = scored.agg(F.coalesce(F.sum(F.when(F.col("block"), F.col("n"))), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
        prior = math.log((blocked + 1) / (whole - blocked + 1))
        sums = dealt_join(held, weights.drop("n"), "token", weights.select("token", "n"), ["host", "shape"])
        sums = sums.groupBy("host", "shape").agg(F.sum(F.col("weight") * F.col("times")).alias("_sum"))
        score = F.lit(prior) + F.coalesce("_sum", F.lit(0.0))
        scored = scored.drop("score", "block").join(sums, ["host", "shape"], "left").withColumn("score", score).drop("_sum")
        scored = cut(scored.withColumn("block", F.col("seeded") | (F.col("score") > 0)), "url-labels")
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    kind = F.xxhash64("host", "shape")
    keyed = scored.select(kind.alias("_kind"), F.col("host").alias("_host"), F.col("shape").alias("_shape"), "score", "n")
    met = dealt_join(urls.withColumn("_kind", kind), keyed.groupBy("_kind").agg(F.collect_list(F.struct("_host", "_shape", "score")).alias("_own")), "_kind", keyed.groupBy("_kind").agg(F.sum("n").alias("n")), [id_col, "path"])
    # kinds whose hashes only happen to agree are told apart by host and shape
    out = met.withColumn("score", F.element_at(F.filter("_own", lambda k: (k["_host"] == F.col("host")) & (k["_shape"] == F.col("shape"))), 1)["score"])
    own = F.when(F.col("score") > 0, "block").otherwise("allow")
    return out.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(says, own).alias("verdict"), "score")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


QUERIES = {"op1_url_filter": op1_url_filter}
