"""PCA, K-Means, cluster assignment, silhouettes and segment labels."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lodestat.operators.profile import group_means, value_counts
from lodestat.operators.sizing import lookup_join
from lodestat.session import attach_row

# Rounds of seeding, and candidates drawn in each for every centre wanted.
SEED_ROUNDS, OVERSAMPLING = 5, 2
# Of the exact silhouette: bytes of a block's vectors, blocks of a table that has larger ones
# than asked for, and distances that a task holds at once.
BLOCK_BYTES, LEAST_BLOCKS, TILE = 16 << 20, 16, 250_000


def with_array(df: DataFrame, cols: list[str], name: str = "x") -> DataFrame:
    return df.withColumn(name, F.array(*[F.col(c).cast("double") for c in cols]))


def pca_ratios(df: DataFrame, size: int, features: str = "x") -> DataFrame:
    """(component, ratio, cumulative) of the explained variance, all components."""
    found = PCA(k=size, inputCol="_v", outputCol="_pc").fit(df.select(array_to_vector(features).alias("_v")))
    ratios = found.explainedVariance.toArray()
    rows = [(i + 1, float(r), float(c)) for i, (r, c) in enumerate(zip(ratios, np.cumsum(ratios)))]
    return df.sparkSession.createDataFrame(rows, "component int, ratio double, cumulative double")


def pca_randomized(df: DataFrame, k: int, features: str = "x", oversampling: int = 10, passes: int = 2,
                   seed: int = 42) -> tuple[DataFrame, np.ndarray]:
    """(component, ratio, cumulative) and loadings of the first ``k`` components, for widths whose square no driver holds.

    A randomised range finder: every pass over the rows gives the product of the centred
    table's covariance with a thin matrix of ``k + oversampling`` columns, which is made
    orthogonal and goes into the next pass; the last pass also gives the covariance
    inside that span, whose eigenvectors are the components. Ratios are never above
    the true ones; each pass shrinks what is missing by the square of the ratio of the
    first left-out eigenvalue to the last one wanted.
    """
    spark = df.sparkSession
    data = df.select(F.col(features).alias("x"))
    stats = data.agg(Summarizer.metrics("mean", "variance", "count").summary(array_to_vector("x")).alias("s")).first()["s"]
    mean, total, n = stats["mean"].toArray(), float(stats["variance"].toArray().sum()), stats["count"]
    thin = min(len(mean), k + oversampling)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(mean), thin)))[0]
    for _ in range(passes):
        shared = spark.sparkContext.broadcast((mean, basis))

        def product(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            centre, q = shared.value
            wide, inner = np.zeros_like(q), np.zeros((q.shape[1], q.shape[1]))
            for batch in batches:
                x = np.stack(batch["x"]) - centre
                y = x @ q
                wide += x.T @ y
                inner += y.T @ y
            yield pd.DataFrame([{"row": i, "v": row} for i, row in enumerate(np.concatenate((wide, inner)))])

        sums = data.mapInPandas(product, "row int, v array<double>").groupBy("row").agg(
            vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v")).orderBy("row").collect()
        shared.destroy()
        table = np.array([r["v"] for r in sums])
        wide, inner = table[:len(mean)], table[len(mean):]
        values, vectors = np.linalg.eigh(inner)
        order = np.argsort(-values)[:k]
        found, loadings = values[order], basis @ vectors[:, order]
        basis = np.linalg.qr(wide)[0]
    ratios = found / max(n - 1, 1) / total if total > 0 else np.zeros(len(found))
    rows = [(i + 1, float(r), float(c)) for i, (r, c) in enumerate(zip(ratios, np.cumsum(ratios)))]
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), range(loadings.shape[1])])
    return spark.createDataFrame(rows, "component int, ratio double, cumulative double"), loadings * signs


def pca_project(df: DataFrame, k: int = 2, features: str = "x") -> DataFrame:
    """Add pc1..pck of centred features; the largest loading of each is positive."""
    df = df.withColumn("_v", array_to_vector(features))
    model = PCA(k=k, inputCol="_v", outputCol="_pc").fit(df.select("_v"))
    loadings = model.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), range(k)])
    out = model.transform(df).withColumn("_pc", vector_to_array("_pc"))
    return out.withColumns({
        f"pc{i + 1}": F.col("_pc")[i] * float(signs[i]) for i in range(k)}).drop("_pc", "_v")


@dataclass
class KMeansFit:
    """Centres of one fit and the cost of assigning every row to its nearest one."""

    k: int
    centres: np.ndarray
    cost: float = math.inf

    def predict(self, df: DataFrame, features: str = "x", name: str = "cluster") -> DataFrame:
        out = assign_nearest(df, centre_table(df.sparkSession, self.centres), features)
        return out.withColumnRenamed("cluster", name).drop("distance")


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, row by centre; rounding below zero is cut off."""
    d = (x * x).sum(axis=1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(axis=1)
    return np.maximum(d, 0.0)


def _seed_centres(data: DataFrame, jobs: dict[int, tuple[int, int]]) -> dict[int, np.ndarray]:
    """k-means|| for all the fits at once: a constant number of passes, whatever k.

    Each round draws ``OVERSAMPLING * k`` candidates per fit with probabilities in
    proportion to their squared distance from those drawn before; after the last
    one, every candidate weighs as many rows as are nearest to it, and weighted
    k-means++ on the candidates picks the centres. A row's draw is an exponential race:
    the smallest -log(u) / distance win, with u fixed by the row's hash and the seed.
    """
    chosen: dict[int, np.ndarray] = {}
    for step in range(SEED_ROUNDS + 1):
        wanted = {i: (seed, 1 if not step else OVERSAMPLING * k, chosen.get(i)) for i, (k, seed) in jobs.items()}
        shared = data.sparkSession.sparkContext.broadcast(wanted)

        def race(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best = {i: (np.empty(0), np.empty((0, 0))) for i in shared.value}
            for batch in batches:
                x, h = np.stack(batch["x"]), batch["h"].to_numpy()
                for i, (seed, n, centres) in shared.value.items():
                    weight = _distances(x, centres).min(axis=1) if centres is not None else np.ones(len(x))
                    with np.errstate(divide="ignore"):
                        time = -np.log(_uniform(h, seed, step)) / weight
                    times, rows = best[i]
                    at = np.argsort(time, kind="stable")[:n]
                    times, rows = np.concatenate((times, time[at])), np.concatenate((rows.reshape(-1, x.shape[1]), x[at]))
                    keep = np.argsort(times, kind="stable")[:n]
                    best[i] = times[keep], rows[keep]
            yield pd.DataFrame([{"model": i, "time": t, "x": row} for i, (times, rows) in best.items() for t, row in zip(times, rows) if np.isfinite(t)],
                               columns=["model", "time", "x"])

        drawn = data.mapInPandas(race, "model int, time double, x array<double>")
        place = F.row_number().over(Window.partitionBy("model").orderBy("time", "x"))
        most = F.element_at(F.create_map(*[F.lit(v) for i, (_, n, _) in wanted.items() for v in (i, n)]), F.col("model"))
        # Drawn rows only, no more than the tasks times a few per centre; Spark cuts them down before they move.
        rows = drawn.withColumn("place", place).where(F.col("place") <= max(n for _, n, _ in wanted.values())).where(
            F.col("place") <= most).orderBy("model", "place").collect()
        shared.destroy()
        for i in jobs:
            new = [r["x"] for r in rows if r["model"] == i]
            if new:
                chosen[i] = np.array(new) if i not in chosen else np.concatenate((chosen[i], new))
    weights = {i: np.zeros(len(c)) for i, c in chosen.items()}
    for i, near in _assign_all(data, chosen).items():
        for r in near:
            weights[i][r["cluster"]] = r["n"]
    return {i: _recluster(c, weights[i], *jobs[i]) for i, c in chosen.items()}


def _recluster(points: np.ndarray, weights: np.ndarray, k: int, seed: int, rounds: int = 20) -> np.ndarray:
    """Weighted k-means++ and a few weighted Lloyd steps on the candidates of one fit."""
    rng = np.random.default_rng(seed)
    centres = points[[int(rng.choice(len(points), p=weights / weights.sum()))]]
    while len(centres) < k:
        odds = weights * _distances(points, centres).min(axis=1)
        total = odds.sum()
        # Fewer different rows than centres: the rest repeats one of them.
        at = int(rng.choice(len(points), p=odds / total)) if total > 0 else 0
        centres = np.concatenate((centres, points[[at]]))
    for _ in range(rounds):
        near = _distances(points, centres).argmin(axis=1)
        for j in range(k):
            own = weights * (near == j)
            if own.sum() > 0:
                centres[j] = (own[:, None] * points).sum(axis=0) / own.sum()
    return centres


def _uniform(h: np.ndarray, seed: int, step: int) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit hashes, another stream for every seed and step."""
    with np.errstate(over="ignore"):
        z = h.astype(np.uint64) + np.uint64((seed * 1009 + step + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(11)).astype(float) + 0.5) / 2.0 ** 53


def _assign_all(data: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, list]:
    """(cluster, rows, mean vector, cost) per model, from one pass for all of them."""
    shared = data.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = {i: [np.zeros(len(c)), np.zeros_like(c), np.zeros(len(c))] for i, c in shared.value.items()}
        for batch in batches:
            x = np.stack(batch["x"])
            for i, c in shared.value.items():
                d = _distances(x, c)
                near = d.argmin(axis=1)
                member = np.eye(len(c))[near]
                n, sums, cost = totals[i]
                n += member.sum(axis=0)
                sums += member.T @ x
                cost += member.T @ d.min(axis=1)
        yield pd.DataFrame(
            [{"model": i, "cluster": j, "n": n[j], "mean": sums[j] / n[j], "cost": cost[j]}
             for i, (n, sums, cost) in totals.items() for j in range(len(n)) if n[j]],
            columns=["model", "cluster", "n", "mean", "cost"])

    parts = data.mapInPandas(assign, "model int, cluster int, n double, mean array<double>, cost double")
    rows = parts.groupBy("model", "cluster").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"),
        vector_to_array(Summarizer.mean(array_to_vector("mean"), F.col("n"))).alias("mean")).collect()
    shared.destroy()
    out: dict[int, list] = {i: [] for i in centres}
    for r in rows:
        out[r["model"]].append(r)
    return out


def kmeans_fits(df: DataFrame, key: str, features: str, ks, restarts: int = 10, seed: int = 42,
                max_iter: int = 300, tol: float = 1e-4) -> dict[int, KMeansFit]:
    """The best of several k-means++ restarts for every k.

    All (k, restart) fits advance in the same pass over the rows, so the number of
    passes is that of the slowest fit, not the sum over the fits.
    """
    data = df.select(F.xxhash64(key).alias("h"), F.col(features).alias("x")).persist()
    try:
        spread = data.agg(Summarizer.variance(array_to_vector("x"))).first()[0]
        limit = tol * float(np.mean(spread.toArray()))
        jobs = {n: job for n, job in enumerate((k, seed + r) for k in ks for r in range(restarts))}
        centres = _seed_centres(data, jobs)
        moving = set(centres)
        for _ in range(max_iter):
            found = _assign_all(data, {i: centres[i] for i in moving})
            for i in sorted(moving):
                new = centres[i].copy()
                for r in found[i]:
                    new[r["cluster"]] = r["mean"]
                shift = float(((new - centres[i]) ** 2).sum())
                centres[i] = new
                if shift <= limit:
                    moving.discard(i)
            if not moving:
                break
        fits = {i: KMeansFit(len(c), c) for i, c in centres.items()}
        for i, rows in _assign_all(data, centres).items():
            fits[i].cost = float(sum(r["cost"] for r in rows))
    finally:
        data.unpersist()
    return {k: min((f for i, f in fits.items() if jobs[i][0] == k), key=lambda f: f.cost) for k in ks}


def kmeans(df: DataFrame, key: str, features: str, k: int, **options) -> KMeansFit:
    return kmeans_fits(df, key, features, [k], **options)[k]


def elbow_table(df: DataFrame, features: str, fits: dict[int, KMeansFit]) -> DataFrame:
    """(k, inertia, silhouette_squared) of fitted cluster counts, from two passes for all of them."""
    found = silhouettes_squared(df, features, {k: f.centres for k, f in fits.items()})
    rows = [(k, float(f.cost), found[k]) for k, f in fits.items()]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette_squared double")


def silhouettes_squared(df: DataFrame, features: str, centres: dict[int, np.ndarray]) -> dict[int, float]:
    """The mean silhouette in squared Euclidean distance of several assignments to nearest centres.

    The mean squared distance from a row to a cluster follows from the cluster's size,
    mean and mean square, so one pass measures all clusters and a second one all rows.
    A row alone in its cluster scores 0.
    """
    data = df.select(F.col(features).alias("x"))
    shared = data.sparkSession.sparkContext.broadcast(centres)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = {i: (np.zeros(len(c)), np.zeros_like(c), np.zeros(len(c))) for i, c in shared.value.items()}
        for batch in batches:
            x = np.stack(batch["x"])
            for i, c in shared.value.items():
                member = np.eye(len(c))[_distances(x, c).argmin(axis=1)]
                n, sums, squares = totals[i]
                n += member.sum(axis=0)
                sums += member.T @ x
                squares += member.T @ (x * x).sum(axis=1)
        yield pd.DataFrame([{"model": i, "cluster": j, "n": n[j], "mean": sums[j] / n[j], "square": squares[j]}
                            for i, (n, sums, squares) in totals.items() for j in range(len(n)) if n[j]],
                           columns=["model", "cluster", "n", "mean", "square"])

    parts = data.mapInPandas(measure, "model int, cluster int, n double, mean array<double>, square double")
    found = parts.groupBy("model", "cluster").agg(
        F.sum("n").alias("n"), F.sum("square").alias("square"),
        vector_to_array(Summarizer.mean(array_to_vector("mean"), F.col("n"))).alias("mean")).collect()
    sizes = {i: (np.zeros(len(c)), np.array(c), np.zeros(len(c))) for i, c in centres.items()}
    for r in found:
        n, means, squares = sizes[r["model"]]
        n[r["cluster"]], means[r["cluster"]], squares[r["cluster"]] = r["n"], r["mean"], r["square"] / r["n"]
    measured = data.sparkSession.sparkContext.broadcast(sizes)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = {i: [0, 0.0] for i in shared.value}
        for batch in batches:
            x = np.stack(batch["x"])
            for i, c in shared.value.items():
                n, means, squares = measured.value[i]
                near, rows = _distances(x, c).argmin(axis=1), np.arange(len(x))
                mean = np.maximum((x * x).sum(axis=1)[:, None] + squares - 2 * (x @ means.T), 0.0)
                mean[:, n == 0] = np.inf
                own = mean[rows, near] * n[near] / np.maximum(n[near] - 1, 1)
                mean[rows, near] = np.inf
                other = mean.min(axis=1)
                with np.errstate(invalid="ignore", divide="ignore"):
                    s = (other - own) / np.maximum(other, own)
                usable = (n[near] > 1) & np.isfinite(other) & (np.maximum(other, own) > 0)
                totals[i][0] += len(x)
                totals[i][1] += float(s[usable].sum())
        yield pd.DataFrame([(i, float(n), t) for i, (n, t) in totals.items()], columns=["model", "n", "total"])

    rows = data.mapInPandas(score, "model int, n double, total double").groupBy("model").agg(
        (F.sum("total") / F.sum("n")).alias("s")).collect()
    shared.destroy()
    measured.destroy()
    return {r["model"]: r["s"] for r in rows}


def choose_k(elbow: DataFrame) -> int:
    """k with the best silhouette; the smallest one on ties."""
    return elbow.agg(F.max_by("k", F.struct("silhouette_squared", (-F.col("k")).alias("n")))).first()[0]


def squared_distance(x: Column, centre: Column) -> Column:
    return F.aggregate(F.zip_with(x, centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d)


def centre_table(spark: SparkSession, centres: np.ndarray) -> DataFrame:
    """(id, c): a row per centre, numbered from 0."""
    return spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centres)], "id int, c array<double>")


def group_centres(df: DataFrame, label: str, features: str) -> DataFrame:
    """(id, c): the mean vector of each labelled group."""
    return df.groupBy(F.col(label).alias("id")).agg(
        vector_to_array(Summarizer.mean(array_to_vector(features))).alias("c"))


def assign_nearest(df: DataFrame, centres: DataFrame, features: str) -> DataFrame:
    """Add ``cluster`` (smallest id on ties) and ``distance`` (squared) per row.

    The centres ``(id, c)`` reach the rows as one array value, through a scalar
    subquery; nothing is joined or collected, and their number isn't limited.
    """
    listed = centres.agg(F.array_sort(F.collect_list(F.struct("id", "c"))).alias("all"))
    nearest = F.array_min(F.transform(F.col("_p.all"), lambda c: F.struct(
        squared_distance(F.col(features), c["c"]).alias("d"), c["id"].alias("id"))))
    out = attach_row(df, listed).withColumn("_n", nearest)
    return out.select(*df.columns, F.col("_n.id").alias("cluster"), F.col("_n.d").alias("distance"))


def silhouette_squared(df: DataFrame, features: str = "x", cluster: str = "cluster") -> DataFrame:
    """Mean silhouette in squared Euclidean distance; linear in the rows."""
    rows = df.select(array_to_vector(features).alias("features"), cluster)
    score = ClusteringEvaluator(predictionCol=cluster).evaluate(rows)
    return df.sparkSession.createDataFrame([(float(score),)], "silhouette_squared double")


def _runs(rows: pd.DataFrame) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cluster names, different vectors ordered by cluster, their numbers of rows, the ends of the clusters' runs, and each row's vector."""
    names = sorted(rows["cluster"].unique())
    place = {name: i for i, name in enumerate(names)}
    code = np.array([place[name] for name in rows["cluster"]], float)
    seen, at, n = np.unique(np.column_stack((code, np.stack(rows["x"]))), axis=0, return_inverse=True, return_counts=True)
    return names, seen[:, 1:], n.astype(float), np.searchsorted(seen[:, 0], np.arange(len(names) + 1)), at.reshape(-1)


def _euclidean(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of every row of ``a`` from every row of ``b``, from one matrix product.

    Where it cancels more than six digits, or there are no finite numbers, the differences are taken.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        sa, sb = (a * a).sum(axis=1)[:, None], (b * b).sum(axis=1)
        square = (-2.0 * a) @ b.T
        square += sb
        square += sa
        # One bound for all pairs first, which most blocks keep.
        if not (square.min() > 1e-6 * (sa.max() + sb.max()) and square.max() < np.inf):
            i, j = np.nonzero(~((square > 1e-6 * (sa + sb)) & (square < np.inf)))
            for at in range(0, len(i), 100_000):
                x, y = i[at:at + 100_000], j[at:at + 100_000]
                square[x, y] = ((b[y] - a[x]) ** 2).sum(axis=1)
        return np.sqrt(square, out=square)


def _distance_sums(left: tuple, right: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Sums of distances from each vector of ``left`` to each cluster of ``right``, and the other way round."""
    (_, a, na, ea, _), (_, b, nb, eb, _) = left, right
    there, back = np.zeros((len(a), len(eb) - 1)), np.zeros((len(b), len(ea) - 1))
    slab = max(1, TILE // len(b))
    for at in range(0, len(a), slab):
        dist = _euclidean(a[at:at + slab], b)
        for k in range(len(eb) - 1):
            there[at:at + slab, k] = dist[:, eb[k]:eb[k + 1]] @ nb[eb[k]:eb[k + 1]]
        for k in range(len(ea) - 1):
            lo, hi = max(ea[k] - at, 0), min(ea[k + 1] - at, len(dist))
            if lo < hi:
                back[:, k] += na[at + lo:at + hi] @ dist[lo:hi]
    return there, back


def silhouette_exact(df: DataFrame, key: str, features: str, cluster: str,
                     block_rows: int = 2000) -> DataFrame:
    """Exact Euclidean silhouette per row: (key, cluster, a, b, silhouette).

    Quadratic by nature, so the rows are cut into blocks of a bounded size by a
    hash of the key (however large a cluster is), each unordered pair of blocks is one
    task group, and a group returns only distance sums per row and cluster. Rows and sums
    that move grow with the number of blocks, so a large table has larger blocks than
    ``block_rows``, of at most ``BLOCK_BYTES``. For large tables use ``silhouette_squared``.
    """
    n, width = df.agg(F.count(F.lit(1)), F.max(F.size(features))).first()
    most = max(block_rows, min(n // LEAST_BLOCKS, BLOCK_BYTES // (8 * max(1, width or 0))))
    blocks = max(1, math.ceil(n / most))
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
    rows = df.select(F.col(key).alias("key"), F.col(features).cast("array<double>").alias("x"),
                     F.col(cluster).cast("string").alias("cluster"), block.alias("mine"))

    def sums(place: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"key": [], "cluster": [], "near": [], "total": []})
        a, b = _runs(left), _runs(right)
        there, back = _distance_sums(a, b)
        sides = [(left, a, b[0], there)] + ([(right, b, a[0], back)] if place[0] != place[1] else [])
        return pd.concat([pd.DataFrame({"key": side["key"], "cluster": side["cluster"], "near": name, "total": total[own[4], k]})
                          for side, own, names, total in sides for k, name in enumerate(names)])

    later, earlier = F.sequence("mine", F.lit(blocks - 1)), F.sequence(F.lit(0), "mine")
    left = rows.select("*", F.col("mine").alias("bi"), F.explode(later).alias("bj")).groupBy("bi", "bj")
    right = rows.select("*", F.explode(earlier).alias("bi"), F.col("mine").alias("bj")).groupBy("bi", "bj")
    kind = dict(df.dtypes)[key]
    part = left.cogroup(right).applyInPandas(sums, f"key {kind}, cluster string, near string, total double")
    sizes = df.groupBy(F.col(cluster).cast("string").alias("near")).agg(F.count(F.lit(1)).alias("size"))
    totals = part.groupBy("key", "cluster", "near").agg(F.sum("total").alias("total"))
    totals = lookup_join(totals, sizes, "near", "inner")
    own = F.col("near") == F.col("cluster")
    means = totals.groupBy("key", "cluster").agg(
        F.max(F.when(own, F.try_divide("total", F.col("size") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("size"))).alias("b"))
    score = F.when(F.col("a").isNull() | F.col("b").isNull(), 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return means.select(F.col("key").alias(key), "cluster", "a", "b", score.alias("silhouette"))


# Segment names and the column whose above-median mean earns them, in order.
SEGMENT_RULES = [("Premium Central", "central_score"), ("High Value", "value_score"),
                 ("Large Group Premium", "accommodates")]
OTHER_SEGMENT = "Mid-Range"


def label_segments(profile: DataFrame) -> DataFrame:
    """Name each cluster by the first rule whose mean is above the median cluster.

    The profile holds one row per cluster, so a plain median is enough.
    """
    rules = [(name, c) for name, c in SEGMENT_RULES if c in profile.columns]
    if not rules:
        return profile.withColumn("segment", F.lit(OTHER_SEGMENT))
    mid = profile.agg(*[F.median(c).alias(c) for _, c in rules])
    label = F
    for name, c in rules:
        label = label.when(F.col(c) > F.col("_p")[c], name)
    return attach_row(profile, mid).withColumn("segment", label.otherwise(OTHER_SEGMENT)).drop("_p")


def segment_rows(df: DataFrame, cluster: str, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """(labelled cluster profile, rows with their segment)."""
    profile = label_segments(group_means(df, cluster, cols))
    return profile, lookup_join(df, profile.select(cluster, "segment"), cluster)


def segment_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, "segment")
