import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.operators import cluster


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(v) for v in rng.normal((i % 3) * 6, 1, 4)]) for i in range(240)]
    return spark.createDataFrame(rows, "id int, x array<double>").repartition(5).cache()


def test_pca_ratios_and_projection(spark, blobs):
    got = cluster.pca_ratios(blobs, 4).orderBy("component").collect()
    ratios = [r["ratio"] for r in got]
    assert sum(ratios) == pytest.approx(1) and ratios == sorted(ratios, reverse=True)
    x = np.array([r["x"] for r in blobs.collect()])
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert ratios == pytest.approx(list(values / values.sum()))
    centred = blobs.withColumn("x", F.zip_with("x", F.array(*[F.lit(float(v)) for v in x.mean(axis=0)]), lambda a, b: a - b))
    shown = cluster.pca_project(centred).agg(F.var_samp("pc1"), F.var_samp("pc2"), F.corr("pc1", "pc2")).first()
    assert shown[0] == pytest.approx(values[0]) and shown[1] == pytest.approx(values[1]) and abs(shown[2]) < 1e-9


def test_kmeans_finds_the_blobs_and_inertia_falls(spark, blobs):
    fits = cluster.kmeans_fits(blobs, "id", "x", [2, 3, 4, 5], restarts=4)
    costs = [fits[k].cost for k in (2, 3, 4, 5)]
    assert costs == sorted(costs, reverse=True)
    labels = fits[3].predict(blobs).groupBy((F.col("id") % 3).alias("b"), "cluster").count().collect()
    assert len(labels) == 3 and {r["count"] for r in labels} == {80}
    assert cluster.choose_k(cluster.elbow_table(blobs, "x", fits)) == 3
    x = np.array([r["x"] for r in blobs.collect()])
    d = ((x[:, None] - fits[3].centres) ** 2).sum(axis=2)
    assert fits[3].cost == pytest.approx(d.min(axis=1).sum())
    for j in range(3):
        assert np.allclose(fits[3].centres[j], x[d.argmin(axis=1) == j].mean(axis=0), atol=1e-6)


def test_kmeans_does_not_depend_on_the_partitioning(spark, blobs):
    a = cluster.kmeans(blobs.coalesce(1), "id", "x", 3, restarts=2)
    b = cluster.kmeans(blobs.repartition(7, "id"), "id", "x", 3, restarts=2)
    assert np.allclose(np.sort(a.centres, axis=0), np.sort(b.centres, axis=0))


def test_assignment_breaks_ties_by_id(spark):
    df = spark.createDataFrame([([0.0],), ([5.0],)], "x array<double>")
    out = cluster.assign_nearest(df, cluster.centre_table(spark, [[-1.0], [1.0], [5.0]]), "x").collect()
    assert [(r["cluster"], r["distance"]) for r in out] == [(0, 1.0), (2, 0.0)]


def test_assignment_to_many_centres(spark):
    centres = np.arange(3000.0)[:, None] * 2
    df = spark.createDataFrame([(i, [i + 0.25]) for i in range(0, 5990, 37)], "id int, x array<double>")
    for r in cluster.assign_nearest(df, cluster.centre_table(spark, centres), "x").collect():
        assert r["cluster"] == np.abs(centres[:, 0] - r["x"][0]).argmin()


def test_seeding_takes_as_many_passes_for_any_number_of_centres(spark, blobs, monkeypatch):
    passes = []
    real = cluster._assign_all
    monkeypatch.setattr(cluster, "_assign_all", lambda *a: passes.append(1) or real(*a))
    data = blobs.select(F.xxhash64("id").alias("h"), "x")
    found = cluster._seed_centres(data, {0: (3, 1), 1: (30, 1), 2: (300, 2)})
    assert len(passes) == 1 and {i: len(c) for i, c in found.items()} == {0: 3, 1: 30, 2: 300}
    x = np.array([r["x"] for r in blobs.collect()])
    cost = lambda c: cluster._distances(x, c).min(axis=1).sum()
    best = cost(np.array([x[i::3].mean(axis=0) for i in range(3)]))
    assert cost(found[0]) < 1.5 * best and cost(found[1]) < best


def test_seeding_of_fewer_rows_than_centres(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "id int, x array<double>")
    fit = cluster.kmeans(df, "id", "x", 3, restarts=2)
    assert fit.cost == 0 and len(fit.centres) == 3


def test_silhouettes_of_several_fits_equal_the_library_one(spark, blobs):
    fits = cluster.kmeans_fits(blobs, "id", "x", [2, 3, 4], restarts=2)
    found = cluster.silhouettes_squared(blobs, "x", {k: f.centres for k, f in fits.items()})
    for k, f in fits.items():
        want = cluster.silhouette_squared(f.predict(blobs)).first()[0]
        assert found[k] == pytest.approx(want, abs=1e-9)


def test_randomised_components_equal_the_exact_ones(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 40)) * (0.8 ** np.arange(40)) @ np.linalg.qr(rng.normal(size=(40, 40)))[0] + 5
    df = spark.createDataFrame([([float(v) for v in r],) for r in x], "x array<double>").repartition(4)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    table, loadings = cluster.pca_randomized(df, 5, passes=4)
    ratios = [r["ratio"] for r in table.orderBy("component").collect()]
    want = values[::-1][:5] / values.sum()
    assert np.allclose(ratios, want, rtol=1e-3) and all(r <= w * (1 + 1e-9) for r, w in zip(ratios, want))
    assert all(abs(loadings[:, i] @ vectors[:, -1 - i]) > 0.99 for i in range(3))


@pytest.mark.parametrize("block", [10, 50, 1000])
def test_exact_silhouette_equals_brute_force(spark, block):
    rng = np.random.default_rng(1)
    # One cluster holds most of the rows, one a single row.
    labels = [0] * 60 + [1] * 25 + [2]
    x = rng.normal(0, 1, (86, 3)) + np.array(labels)[:, None]
    df = spark.createDataFrame([(i, [float(v) for v in r], l) for i, (r, l) in enumerate(zip(x, labels))],
                               "id int, x array<double>, label int")
    got = {r["id"]: r["silhouette"] for r in cluster.silhouette_exact(df, "id", "x", "label", block).collect()}
    d, l = np.sqrt(((x[:, None] - x) ** 2).sum(axis=2)), np.array(labels)
    for i in range(86):
        own = (l == l[i]).sum()
        if own == 1:
            assert got[i] == 0
            continue
        a = d[i, l == l[i]].sum() / (own - 1)
        b = min(d[i, l == k].mean() for k in set(labels) if k != l[i])
        assert got[i] == pytest.approx((b - a) / max(a, b)) and -1 <= got[i] <= 1


def test_exact_silhouette_has_few_blocks(spark, capsys):
    """A larger table has larger blocks, since the rows and sums that move grow with their number."""
    df = spark.range(640).select("id", F.array(F.rand(3), F.rand(4)).alias("x"), (F.col("id") % 3).alias("label"))
    out = cluster.silhouette_exact(df, "id", "x", "label", 4)
    out.explain()
    blocks = {int(n) for n in re.findall(r"xxhash64\(id#\d+L, 42\), (\d+)\)", capsys.readouterr().out)}
    assert blocks and max(blocks) <= cluster.LEAST_BLOCKS + 1
    assert len(out.collect()) == 640


def test_distances_of_copies_and_odd_numbers():
    far = np.array([[1e8, 1.0], [1e8, 1.0], [1e8, 1.0 + 1e-6], [1e200, 0.0], [np.inf, 0.0], [np.nan, 0.0], [0.0, 0.0], [3.0, 4.0]])
    with np.errstate(over="ignore", invalid="ignore"):
        want = np.sqrt(((far[:, None] - far) ** 2).sum(axis=2))
    np.testing.assert_allclose(cluster._euclidean(far, far), want, rtol=1e-9)


def test_segment_rules_in_order(spark, rows):
    df = spark.createDataFrame([(0, 3.0, 1.0, 2.0), (1, 1.0, 5.0, 2.0), (2, 1.0, 1.0, 9.0), (3, 0.0, 1.0, 1.0)],
                               "cluster int, central_score double, value_score double, accommodates double")
    got = dict(rows(cluster.label_segments(df).select("cluster", "segment")))
    assert got == {0: "Premium Central", 1: "High Value", 2: "Large Group Premium", 3: "Mid-Range"}
    assert {r["segment"] for r in cluster.label_segments(df.select("cluster")).collect()} == {"Mid-Range"}
