"""Segmentation report: cleanse, derive, scale, PCA, K-Means, label."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestat.operators import cluster, profile
from lodestat.operators.clean import fill_median
from lodestat.operators.columns import drop_constant, numeric_columns
from lodestat.operators.encode import scale_array
from lodestat.plans.listings import cleanse_for_model, eda_features
from lodestat.session import settle_table


def segmentation_report(df: DataFrame, key: str = "id", k: int | str = 3, restarts: int = 10,
                        ks=range(2, 8), seed: int = 42) -> dict[str, DataFrame]:
    """All tables of the segmentation. ``clean`` is the model input: it carries
    neither segments nor price-derived columns. ``k="auto"`` takes the best silhouette."""
    clean = settle_table(cleanse_for_model(df))
    eda = eda_features(clean)
    cols = numeric_columns(eda, (key, "price_per_person"))
    # A column without any value has no median to fill it with.
    filled = eda.agg(*[F.count(c).alias(c) for c in cols]).first()
    cols = [c for c in cols if filled[c]]
    numbers = settle_table(fill_median(eda.select(key, *cols), cols))
    points = settle_table(scale_array(cluster.with_array(numbers, cols)).select(key, "x"))
    tried = {*ks} | (set() if k == "auto" else {k})
    fits = cluster.kmeans_fits(points, key, "x", sorted(tried), restarts=restarts, seed=seed)
    elbow = cluster.elbow_table(points, "x", {n: f for n, f in fits.items() if n in ks})
    chosen = cluster.choose_k(elbow) if k == "auto" else k
    assigned = fits[chosen].predict(points).select(key, "cluster")
    table, rows = cluster.segment_rows(numbers.join(assigned, key), "cluster", cols)
    segments = rows.select(key, "cluster", "segment")
    return {
        "clean": clean,
        "correlation": profile.correlation(numbers, drop_constant(numbers, cols).drop(key).columns),
        "pca": cluster.pca_ratios(points, len(cols)),
        "projection": cluster.pca_project(points).drop("x").join(segments, key),
        "elbow": elbow,
        "profile": table,
        "segmented": eda.join(segments.drop("cluster"), key),
        "segment_counts": cluster.segment_counts(segments),
    }
