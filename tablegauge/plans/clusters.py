"""Evaluation of k-means against DBSCAN on one table of points."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.operators import clustering, density
from tablegauge.session import checkpoint, spread
from tablegauge.sources import sinks

# Scores that stand in where DBSCAN found no clusters.
NO_SILHOUETTE = -1.0
NO_DAVIES_BOULDIN = float("inf")
NO_CALINSKI_HARABASZ = 0.0


@dataclass
class ClusterEvaluation:
    """Scores per k and setting, the metric and settings summary, and the chosen labels."""

    k_scores: DataFrame
    dbscan_scores: DataFrame
    metrics: DataFrame
    config: DataFrame
    labels: DataFrame
    projection: DataFrame


def evaluate(
    points: DataFrame,
    dataset: str = "dataset",
    ks: Iterable[int] = range(2, 11),
    eps_range: Sequence[float] = density.EPS_RANGE,
    min_samples_range: Sequence[int] = density.MIN_SAMPLES_RANGE,
    seed: int = 42,
    n_init: int = 10,
    max_noise: float | None = None,
    parallelism: int = 4,
) -> ClusterEvaluation:
    """Scale, sweep both methods, and keep k-means if its silhouette is strictly higher.

    Where neither method finds two clusters the best model is "no clustering" and all labels are 0.
    """
    spark = points.sparkSession
    scaled = checkpoint(spread(clustering.scale_points(points)))

    models = clustering.kmeans_models(scaled, ks, [seed], n_init, parallelism=parallelism)
    tried = [k for k, _ in models]
    runs = checkpoint(clustering.with_labels(scaled, list(models.values())))
    k_scores = checkpoint(clustering.score_ks(runs, tried))
    chosen = k_scores.where("is_best").first()
    if chosen is not None:
        k_labels = runs.select("id", F.col("labels")[tried.index(chosen["k"])].alias("label"))

    table, labelings = density.dbscan_sweep(scaled, eps_range, min_samples_range, max_noise)
    table = checkpoint(table)
    found = table.where("is_best").first()
    if found is None:
        d_labels = None
        d_scores = (NO_SILHOUETTE, NO_DAVIES_BOULDIN, NO_CALINSKI_HARABASZ, None)
    else:
        d_labels = labelings.where(F.col("setting") == found["setting"]).select("id", "label")
        d_scores = (
            found["silhouette"], found["davies_bouldin"], found["calinski_harabasz"], found["noise_ratio"],
        )

    if chosen is None:
        # No k gives two clusters, as when all points are alike.
        k_scored, kmeans_wins = (None, None, None), False
        k_labels = scaled.select("id", F.lit(0).alias("label"))
        best = "DBSCAN" if d_labels is not None else "no clustering"
        labels = d_labels if d_labels is not None else k_labels
    else:
        k_scored = (chosen["silhouette"], chosen["davies_bouldin"], chosen["calinski_harabasz"])
        kmeans_wins = d_labels is None or chosen["silhouette"] > d_scores[0]
        best = "KMeans" if kmeans_wins else "DBSCAN"
        labels = k_labels if kmeans_wins else d_labels
    metric_rows = [
        (dataset, "kmeans", *k_scored, None),
        (dataset, "dbscan", *d_scores),
    ]
    metrics = spark.createDataFrame(
        metric_rows,
        "dataset string, method string, silhouette double, davies_bouldin double, calinski_harabasz double, "
        "noise_ratio double",
    )
    config = spark.createDataFrame(
        [
            (
                dataset, best, chosen["k"] if chosen else None, found["eps"] if found else None,
                found["min_samples"] if found else None, "silhouette_score",
            )
        ],
        "dataset string, best_model string, n_clusters int, eps double, min_samples int, selection_criterion string",
    )
    projection = clustering.pca_points(scaled).join(labels, "id")
    return ClusterEvaluation(k_scores, table, metrics, config, labels, projection)


def write_evaluation(result: ClusterEvaluation, out_dir: str) -> None:
    sinks.write_records(result.metrics, f"{out_dir}/metrics_summary")
    sinks.write_records(result.config, f"{out_dir}/best_configs")
    sinks.write_labels(result.labels, f"{out_dir}/labels")
    sinks.write_table(result.k_scores, f"{out_dir}/metrics_vs_k", few_rows=True)
    sinks.write_table(result.projection, f"{out_dir}/projection")
