"""Item clustering (K): co-occurrence features, basket-space distances,
k-means sweep and assignment (NumPy fits, each a row of a distributed range),
Euclidean silhouette."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.operators.mining import cooccurrence


def cooc_features(mc: DataFrame, index: DataFrame) -> DataFrame:
    """Co-occurrence rows (zero diagonal), each column standardised with the
    population std; zero-variance columns left unscaled (long form)."""
    c = cooccurrence(mc, index, diagonal=True).withColumn(
        "v", F.when(F.col("item_a") == F.col("item_b"), F.lit(0.0)).otherwise(F.col("baskets").cast("double")))
    w = Window.partitionBy("item_b")
    mu, sd = F.avg("v").over(w), F.stddev_pop("v").over(w)
    return c.select("item_a", "item_b", F.round(F.when(sd > 0, (F.col("v") - mu) / sd)
                                                .otherwise(F.col("v") - mu), 8).alias("value"))


def freq_distance(mc: DataFrame, index: DataFrame) -> DataFrame:
    """Euclidean distance between items in standardised basket space without
    building basket-sized vectors: a basket of share p of all items weighs
    w = 1 / (p (1 - p)) and d^2(a, b) = w_a + w_b - 2 w_ab, where w_a is the weight
    of the baskets that hold a, w_ab of those that hold both: one weighted
    co-occurrence pass (baskets with p in {0, 1} have zero variance and are skipped)."""
    k = index.agg(F.count(F.lit(1))).scalar()
    p = F.bit_count("mask") / k
    m = mc.withColumn("w", F.col("n") / (p * (1 - p))).filter((p > 0) & (p < 1))
    gram = cooccurrence(m, index, weight="w")
    own = gram.filter(F.col("item_a") == F.col("item_b"))
    both = gram.filter(F.col("item_a") < F.col("item_b"))
    d2 = (both.join(F.broadcast(own.select("item_a", F.col("baskets").alias("wa"))), "item_a")  # <= 63 rows
          .join(F.broadcast(own.select("item_b", F.col("baskets").alias("wb"))), "item_b")
          .withColumn("d2", F.greatest(F.col("wa") + F.col("wb") - 2 * F.col("baskets"), F.lit(0.0))))
    return d2.select("item_a", "item_b", F.round(F.sqrt("d2"), 6).alias("distance"))


def item_matrix(long_df: DataFrame, index: DataFrame):
    """(names, matrix) of a long (item_a, item_b, value) table over the bounded domain (at most 63 x 63)."""
    import numpy as np
    names = [r["item"] for r in index.orderBy("idx").collect()]
    at = {n: i for i, n in enumerate(names)}
    out = np.zeros((len(names), len(names)))
    for r in long_df.collect():
        out[at[r["item_a"]], at[r["item_b"]]] = r["value"]
    return names, out


def embedded(dist: DataFrame, index: DataFrame):
    """(names, points) with the given distances: k-means sees nothing of its points but
    their distances, so these stand for the items' rows over all baskets."""
    import numpy as np
    long = dist.select("item_a", "item_b", F.col("distance").alias("value"))
    names, d = item_matrix(long.unionByName(long.select(F.col("item_b").alias("item_a"), F.col("item_a").alias("item_b"), "value")), index)
    n = len(names)
    centre = np.eye(n) - 1 / n
    value, vector = np.linalg.eigh(-0.5 * centre @ (d ** 2) @ centre)
    return names, vector * np.sqrt(np.maximum(value, 0))


def kmeans_fits(spark, points, ks, restarts: int = 10, seed: int = 42) -> DataFrame:
    """(k, restart, inertia, silhouette, labels) of every fit; each is a row of a
    distributed range.  Starts are k-means++ draws, silhouettes Euclidean.

    ``points`` is the bounded item matrix.  Labels number clusters by their first
    item.
    """
    import numpy as np
    import pandas as pd
    x = np.asarray(points, float)
    ks = [k for k in ks if 1 <= k <= len(x)]

    def fit(k, restart):
        rng = np.random.default_rng([seed, k, restart])
        centre = x[[rng.integers(len(x))]]
        while len(centre) < k:
            d2 = ((x[:, None] - centre) ** 2).sum(axis=2).min(axis=1)
            p = d2 / d2.sum() if d2.sum() > 0 else np.full(len(x), 1 / len(x))
            centre = np.vstack([centre, x[rng.choice(len(x), p=p)]])
        label = None
        while True:
            d2 = ((x[:, None] - centre) ** 2).sum(axis=2)
            new = d2.argmin(axis=1)
            if label is not None and (new == label).all():
                break
            label = new
            centre = np.array([x[label == c].mean(axis=0) if (label == c).any() else centre[c] for c in range(k)])
        order = {c: i for i, c in enumerate(dict.fromkeys(label.tolist()))}
        return np.array([order[c] for c in label]), float(d2.min(axis=1).sum())

    def silhouette(label):
        d = np.sqrt(((x[:, None] - x) ** 2).sum(axis=2))
        out = []
        for i, c in enumerate(label):
            own = (label == c) & (np.arange(len(x)) != i)
            if not own.any() or len(set(label)) < 2:
                out.append(0.0)
                continue
            a, b = d[i, own].mean(), min(d[i, label == o].mean() for o in set(label) if o != c)
            out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
        return float(np.mean(out))

    def run(batches):
        for pdf in batches:
            rows = []
            for i in pdf["id"]:
                k, restart = ks[int(i) // restarts], int(i) % restarts
                label, inertia = fit(k, restart)
                rows.append((k, restart, inertia, silhouette(label), label.tolist()))
            yield pd.DataFrame(rows, columns=["k", "restart", "inertia", "silhouette", "labels"])

    n = len(ks) * restarts
    return spark.range(0, n, 1, max(1, min(n, 32))).mapInPandas(run, "k int, restart int, inertia double, silhouette double, labels array<int>")


def best_fits(fits: DataFrame) -> DataFrame:
    """Of each k the fit of least inertia (ties: the first restart); is_best_k marks the
    k of the largest silhouette."""
    w = Window.partitionBy("k").orderBy(F.round("inertia", 9), "restart")
    best = fits.withColumn("rk", F.row_number().over(w)).filter("rk = 1").drop("rk")
    top = F.max(F.struct(F.round("silhouette", 9), -F.col("k"))).over(Window.partitionBy())  # a row per k
    return best.withColumn("is_best_k", F.col("k") == -top["col2"])


def assignment(best: DataFrame, names: list, k: int) -> DataFrame:
    """(item, cluster) of the best fit with k clusters."""
    items = F.array(*map(F.lit, names))
    return (best.filter(F.col("k") == k).select(F.posexplode("labels").alias("i", "cluster"))
            .select(F.get(items, F.col("i")).alias("item"), F.col("cluster").cast("bigint").alias("cluster")))


def silhouette_euclidean(dist: DataFrame, assign: DataFrame) -> DataFrame:
    """Mean silhouette from a pairwise distance table (item_a < item_b) and
    an assignment (item, cluster); Euclidean, not squared."""
    d = dist.select("item_a", "item_b", "distance").unionByName(
        dist.select(F.col("item_b").alias("item_a"), F.col("item_a").alias("item_b"), "distance"))
    a = assign.select(F.col("item").alias("item_a"), F.col("cluster").alias("ca"))
    b = assign.select(F.col("item").alias("item_b"), F.col("cluster").alias("cb"))
    per = (d.join(a, "item_a").join(b, "item_b")
           .groupBy("item_a", "ca", "cb").agg(F.avg("distance").alias("md")))
    s = per.groupBy("item_a").agg(
        F.max(F.when(F.col("ca") == F.col("cb"), F.col("md"))).alias("ai"),
        F.min(F.when(F.col("ca") != F.col("cb"), F.col("md"))).alias("bi"))
    sil = F.when(F.col("ai").isNull(), F.lit(0.0)).otherwise(
        (F.col("bi") - F.col("ai")) / F.greatest("ai", "bi"))
    return s.agg(F.round(F.avg(sil), 6).alias("silhouette"), F.count(F.lit(1)).alias("items"))
