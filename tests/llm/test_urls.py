import math
import random
import re
from collections import Counter

import pytest

from tallyloom.llm import url_filter as u

LEXICON = ["red", "house", "blue", "garden", "river", "lucky", "spin", "jackpot", "free", "win", "news", "cake", "tree", "extraordinarilylongword"]
HTML = "<p>" + " ".join(LEXICON * 3) + "</p>"


def pages():
    r = random.Random(3)
    urls = [f"http://casino{w}.com/{p}/jackpot{i}" for i in range(8) for w, p in (("lucky", "spin"), ("free", "jackpot"))]
    urls += [f"http://{r.choice(['red', 'blue'])}{r.choice(['house', 'garden', 'river'])}.com/{r.choice(['news', 'cake', 'tree'])}/{i}" for i in range(120)]
    urls += ["http://luckyspin.com/jackpot/free", "http://extraordinarilylongwordhouse.com/cake", "http://" + "redhouse" * 60 + ".com/tree", None, "nothing", "http://casino.com", "http://casino.com"]
    return list(enumerate(urls))


def names(text):
    return ["0" if re.match(r"\d", x) else x for x in re.findall(r"[a-z]+|\d+", text.lower())]


def split(name, counts):
    """The best split by trying all, as the smallest of (-log probability, ...) with the longer last word first."""
    total, best = sum(counts.values()), [(0.0, [])]
    for end in range(1, len(name) + 1):
        found = None
        for start in range(end):
            w = name[start:end]
            p = math.log(counts[w] / total) if w in counts else math.log(10 / total) - len(w) * math.log(10)
            if found is None or best[start][0] + p > found[0] + 1e-9:
                found = (best[start][0] + p, [*best[start][1], w])
        best.append(found)
    return best[-1][1]


def brute(rows, html_counts, rounds):
    counts = Counter(html_counts)
    for s in u.SEEDS:
        counts[s] += u.SEED_COUNT
    kinds, tokens = Counter(), {}
    keys = []
    for _, url in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        key = (host, " ".join(names(path)))
        keys.append(key)
        kinds[key] += 1
        tokens[key] = Counter([f"h:{w}" for n in names(host) for w in split(n, counts)] + [f"p:{w}" for n in names(path) for w in split(n, counts)])
    seeds = {f"h:{s}" for s in u.SEEDS}
    seeded = {k: bool(seeds & set(t)) for k, t in tokens.items()}
    block, scores = dict(seeded), {}
    for _ in range(rounds):
        bad, good = Counter(), Counter()
        for k, t in tokens.items():
            for w, n in t.items():
                if not (w in seeds and seeded[k]):
                    (bad if block[k] else good)[w] += n * kinds[k]
        every = {w for t in tokens.values() for w in t}
        for w in every & seeds:
            bad[w] += u.SEED_TOKENS
        of_bad, of_good = (sum(c.values()) + u.SMOOTHING * len(every) for c in (bad, good))
        weight = {w: math.log((bad[w] + u.SMOOTHING) / of_bad) - math.log((good[w] + u.SMOOTHING) / of_good) for w in every}
        blocked, whole = sum(n for k, n in kinds.items() if block[k]), sum(kinds.values())
        scores = {k: math.log((blocked + 1) / (whole - blocked + 1)) + sum(weight[w] * n for w, n in t.items()) for k, t in tokens.items()}
        block = {k: seeded[k] or scores[k] > 0 for k in scores}
    return [scores[k] for k in keys]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, x, HTML if i == 0 else None, "y", 1, 2.0) for i, x in pages()]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, n int, score double")
    return {r.page_id: r for r in u.judge(df).collect()}


def test_scores_are_those_of_brute_force(judged):
    rows = pages()
    want = brute(rows, Counter(LEXICON * 3), u.ROUNDS)
    assert len(judged) == len(rows)
    for (i, _), score in zip(rows, want, strict=True):
        assert math.isclose(judged[i].score, score, abs_tol=1e-6), (i, judged[i], score)
        assert judged[i].verdict == ("block" if score > 0 else "allow")


def test_hosts_without_a_seed_are_learned(judged):
    by = {x: judged[i] for i, x in pages()}
    assert by["http://luckyspin.com/jackpot/free"].verdict == "block"
    assert all(r.verdict == "allow" for x, r in by.items() if x and re.match("http://(red|blue)", x))
    assert by[None].host == by["nothing"].path == "" and by[None].rule is None


def test_long_names_and_words_of_any_length(spark):
    counts = spark.createDataFrame([(w, 9) for w in LEXICON], "word string, n bigint")
    long = "redhouse" * 200
    got = {r.name: r.words for r in u.segment(spark.createDataFrame([("extraordinarilylongwordriver",), (long,), ("zzz",), ("",)], "name string"), counts).collect()}
    assert got == {"extraordinarilylongwordriver": ["extraordinarilylongword", "river"], long: ["red", "house"] * 200, "zzz": ["zzz"]}


def test_query_over_a_table(spark, tmp_path):
    spark.createDataFrame([(1, "http://a.net/x", None), (1, "http://a.net/x", "b"), (2, None, None)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((r.page_id, r.rule or "", r.verdict) for r in u.op1_url_filter(spark, str(tmp_path)).collect())
    assert got == [(1, "net/", "block"), (1, "net/", "block"), (2, "", "allow")]
