"""Speaker identity: clusters, centroids, consensus of voice and face, profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.rules import age_group
from tallyloom.operators.joins import cosine_links, nearest_known, unit
from tallyloom.session import saved

MOST_ROUNDS = 30


def components(nodes: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """(key, id, root) of nodes (key, id): the smallest id of the component that links (key, a, b) give.

    Labels move along links and are then looked up in the labels themselves, so that long chains shorten by half.
    """
    both = saved(links.select(key, "a", "b").unionByName(links.select(key, F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = saved(nodes.select(key, "id", F.col("id").alias("root")))
    for _ in range(MOST_ROUNDS):
        near = both.join(labels.select(key, F.col("id").alias("b"), "root"), [key, "b"]).groupBy(key, F.col("a").alias("id")).agg(F.min("root").alias("near"))
        moved = labels.join(near, [key, "id"], "left").select(key, "id", F.least("root", F.coalesce("near", "root")).alias("root"), F.col("root").alias("old"))
        moved = saved(moved)
        up = moved.select(key, F.col("id").alias("root"), F.col("root").alias("top"))
        labels = saved(moved.join(up, [key, "root"], "left").select(key, "id", F.coalesce("top", "root").alias("root"), (F.col("old") != F.coalesce("top", "root")).alias("changed")))
        if labels.filter("changed").isEmpty():
            return labels.select(key, "id", "root")
        labels = labels.drop("changed")
    raise RuntimeError("components did not settle")


def clusters(vectors: DataFrame, key: str, least: float = 0.60, min_members: int = 1) -> DataFrame:
    """(key, id, cluster): vectors within reach of each other, numbered within a key by their first member.

    With min_members above 1 only vectors with that many in reach (themselves included) pass reach on; those without
    such a neighbour have no cluster.
    """
    links = cosine_links(vectors, key, least)
    nodes = vectors.select(key, "id")
    if min_members > 1:
        ends = links.select(key, F.col("a").alias("id")).unionByName(links.select(key, F.col("b").alias("id")))
        core = ends.groupBy(key, "id").agg((F.count(F.lit(1)) + 1).alias("n")).filter(F.col("n") >= min_members).select(key, "id")
        a, b = core.withColumnRenamed("id", "a"), core.withColumnRenamed("id", "b")
        inner = links.join(a, [key, "a"], "left_semi").join(b, [key, "b"], "left_semi")
        roots = components(core, inner, key)
        one = links.select(key, F.col("a").alias("id"), F.col("b").alias("core")).unionByName(links.select(key, F.col("b").alias("id"), F.col("a").alias("core")))
        edge = one.join(core, [key, "id"], "left_anti").join(roots.withColumnRenamed("id", "core"), [key, "core"]).groupBy(key, "id").agg(F.min("root").alias("root"))
        found = roots.unionByName(edge)
    else:
        found = components(nodes, links, key)
    number = F.dense_rank().over(Window.partitionBy(key).orderBy("root")) - 1
    return nodes.join(found.select(key, "id", number.alias("cluster")), [key, "id"], "left")


def outlier_labels(clustered: DataFrame, key: str) -> DataFrame:
    """(key, id, label) of clusters: key_spk and the cluster, or key_spkOUT_ and the last six signs of an id without one."""
    alone = F.concat(F.col(key).cast("string"), F.lit("_spkOUT_"), F.right(F.col("id").cast("string"), F.lit(6)))
    named = F.concat(F.col(key).cast("string"), F.lit("_spk"), F.col("cluster").cast("string"))
    return clustered.select(key, "id", F.when(F.col("cluster").isNull(), alone).otherwise(named).alias("label"))


def centroids(vectors: DataFrame, keys: Sequence[str], vec: str = "vec") -> DataFrame:
    """(keys, centroid): the mean of unit vectors, scaled to unit length; sums are exact decimals of 12 digits."""
    each = vectors.select(*keys, F.posexplode(unit(F.col(vec))).alias("i", "v")).groupBy(*keys, "i").agg((F.sum(F.col("v").cast("decimal(20,12)")).cast("double") / F.count(F.lit(1))).alias("v"))
    whole = each.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("c"))
    return whole.select(*keys, unit(F.col("c")).alias("centroid"))


def evidence(rows: DataFrame, vec: str = "vec", ages: str | None = None) -> DataFrame:
    """rows with vectors to four decimals and ages to one, as a checkpoint keeps them."""
    out = rows.withColumn(vec, F.transform(vec, lambda x: F.round(x.cast("double"), 4)))
    return out if ages is None else out.withColumn(ages, F.transform(ages, lambda x: F.round(x.cast("double"), 1)))


def rematched(known: DataFrame, found: DataFrame) -> DataFrame:
    """known (id, centroid) moved half-way to found (id, centroid) and rescaled; new ids are taken as they are."""
    both = known.join(found.withColumnRenamed("centroid", "_new"), "id", "full")
    mean = unit(F.transform(F.zip_with("centroid", "_new", lambda x, y: x + y), lambda x: x / 2))
    return both.select("id", F.when(F.col("centroid").isNull(), F.col("_new")).when(F.col("_new").isNull(), F.col("centroid")).otherwise(mean).alias("centroid"))


def identities(clusters_: DataFrame, known: DataFrame, least: float = 0.60) -> DataFrame:
    """clusters_ (id, vec) with speaker and match: the nearest known speaker, or the cluster itself as a new one."""
    hit = nearest_known(clusters_, known, least)
    return hit.select("id", F.coalesce("k_id", "id").alias("speaker"), F.when(F.col("k_id").isNull(), "new").otherwise("auto").alias("match"), "cosine")


def av_consensus(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows (voice, face) with mismatch: 1 if the face isn't the voice's majority face, 0 if it is, null unjudged.

    The lexicographically first of equally frequent faces is the majority.
    """
    judged = (F.coalesce(F.trim("voice"), F.lit("")) != "") & (F.coalesce(F.trim("face"), F.lit("")) != "")
    n = rows.filter(judged).groupBy(*keys, "voice", "face").agg(F.count(F.lit(1)).alias("n"))
    # the smallest face of the largest count, without a window over a voice that may be hot
    top = n.groupBy(*keys, "voice").agg(F.min(F.struct(-F.col("n"), "face")).alias("m")).select(*keys, "voice", F.col("m.face").alias("majority"))
    return rows.join(top, [*keys, "voice"], "left").withColumn("mismatch", F.when(judged, (F.col("face") != F.col("majority")).cast("int"))).drop("majority")


def profile(evidence: DataFrame, key: str) -> DataFrame:
    """(key, gender, confidence, age, age_std, age_group) of observations (gender 0/1, age); over half must be 1 for M."""
    p = F.avg("gender")
    out = evidence.groupBy(key).agg(p.alias("p"), F.percentile("age", F.lit(0.5)).alias("a"), F.stddev_pop("age").alias("s"))
    return out.select(
        key, F.when(F.col("p") > 0.5, "M").otherwise("F").alias("gender"), F.round(F.greatest("p", 1 - F.col("p")), 3).alias("confidence"),
        F.round("a", 1).alias("age"), F.round("s", 1).alias("age_std"), age_group(F.col("a")).alias("age_group"),
    )


def majority(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) of the most frequent value; the smallest of equals."""
    n = rows.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(key).agg(F.min(F.struct(-F.col("n"), value)).alias("m")).select(key, f"m.{value}")
