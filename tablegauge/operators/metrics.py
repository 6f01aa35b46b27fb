"""Classification metrics, ROC curves and clustering agreement as aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.operators.ranks import TASK_ROWS, running_totals, with_next
from tablegauge.session import checkpoint, if_small


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, count)`` for every pair of classes seen on either side.

    Counting goes first; filling in the zero cells works on classes only.
    """
    counts = (
        df.select(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction"))
        .groupBy("label", "prediction")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    marginals = counts.select(F.explode(F.array("label", "prediction")).alias("k"))
    classes = marginals.agg(F.array_sort(F.collect_set("k"))).scalar()
    seen = marginals.select(F.col("k").alias("label")).distinct()
    dense = seen.select("label", F.explode(classes).alias("prediction"))
    return dense.join(counts, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("count", F.lit(0).cast("bigint")).alias("count")
    )


def rank_area(scores: DataFrame, groups: list[str] | None = None, limit: int = TASK_ROWS) -> DataFrame:
    """ROC-AUC per group from ``(score, pos, neg)`` counts: ties count half.

    ``scores`` holds one row per distinct score, so the running total passes over scores,
    not over samples.
    """
    groups = groups or []
    ranked = running_totals(scores, "score", ["neg"], groups, limit=limit)
    wins = F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2)
    area = F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg"))
    return ranked.groupBy(*groups).agg(area.alias("roc_auc"))


def score_counts(df: DataFrame, label: str, score: str, groups: list[str] | None = None) -> DataFrame:
    positive = F.col(label).cast("int") == 1
    return df.groupBy(*(groups or []), F.col(score).cast("double").alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )


def roc_auc(
    df: DataFrame, label: str = "label", score: str = "score", groups: list[str] | None = None, limit: int = TASK_ROWS
) -> DataFrame:
    return rank_area(score_counts(df, label, score, groups), groups, limit)


def roc_curve(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    groups: list[str] | None = None,
    limit: int = TASK_ROWS,
    drop_collinear: bool = False,
) -> DataFrame:
    """``(threshold, fpr, tpr)`` at every distinct score, plus the (0, 0) start at infinity.

    ``drop_collinear`` leaves out points whose step is repeated by the next one; the first and the last stay.
    """
    groups = groups or []
    counts = score_counts(df, label, score, groups)
    ranked = running_totals(counts, "score", ["pos", "neg"], groups, descending=True, limit=limit)
    kept = None
    if drop_collinear:
        ahead = with_next(ranked, "score", ["pos", "neg"], groups, descending=True, limit=limit)
        turns = ~((F.col("next.pos") == F.col("pos")) & (F.col("next.neg") == F.col("neg")))
        # Before the first point nothing has been counted.
        first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
        kept = checkpoint(ahead.where(F.col("next").isNull() | turns | first).drop("next"))
    # The last running total is the whole.
    whole = checkpoint(ranked.groupBy(*groups).agg(F.max("cum_pos").alias("_p"), F.max("cum_neg").alias("_n")))
    points = ranked if kept is None else kept
    points = points.select(*groups, F.col("score").alias("threshold"), "cum_pos", "cum_neg")
    zero = F.lit(0).cast("bigint")
    start = whole.select(
        *groups, F.lit(float("inf")).alias("threshold"), zero.alias("cum_pos"), zero.alias("cum_neg")
    )
    if groups:
        joined = points.unionByName(start).join(if_small(whole), groups)
        all_pos, all_neg = F.col("_p"), F.col("_n")
    else:
        joined = points.unionByName(start)
        all_pos, all_neg = whole.select("_p").scalar(), whole.select("_n").scalar()
    return joined.select(
        *groups,
        "threshold",
        F.try_divide(F.col("cum_neg").cast("double"), all_neg.cast("double")).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), all_pos.cast("double")).alias("tpr"),
    )


def label_metrics(label: Column, prediction: Column) -> list[Column]:
    """Accuracy and F1 of class 1 (0 where undefined), as aggregate expressions."""
    label, prediction = label.cast("int"), prediction.cast("int")
    hit = F.count_if((label == 1) & (prediction == 1))
    wrong = F.count_if((label == 1) != (prediction == 1))
    return [
        F.avg((label == prediction).cast("int")).alias("accuracy"),
        F.coalesce(F.try_divide(2.0 * hit, 2.0 * hit + wrong), F.lit(0.0)).alias("f1"),
    ]


def classification_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "score",
    model: str | None = None,
    limit: int = TASK_ROWS,
) -> DataFrame:
    """``(model, accuracy, f1, roc_auc)``; one row per value of the ``model`` column if named."""
    groups = [model] if model else []
    basic = df.groupBy(*groups).agg(*label_metrics(F.col(label), F.col(prediction)))
    area = roc_auc(df, label, score, groups, limit)
    if groups:
        return basic.join(area, groups)
    return basic.select("accuracy", "f1", area.scalar().alias("roc_auc"))


def adjusted_rand(df: DataFrame, a: str, b: str, groups: list[str] | None = None) -> DataFrame:
    """Adjusted Rand index of two labelings, from their contingency counts."""
    groups = groups or []
    cells = df.groupBy(*groups, F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))

    def pairs(n: Column) -> Column:
        n = n.cast("double")
        return n * (n - 1) / 2

    rows = cells.groupBy(*groups, "a").agg(F.sum("n").alias("n"))
    cols = cells.groupBy(*groups, "b").agg(F.sum("n").alias("n"))
    parts = (
        cells.select(*groups, pairs(F.col("n")).alias("both"), F.lit(0.0).alias("ra"), F.lit(0.0).alias("rb"), "n")
        .unionByName(
            rows.select(
                *groups, F.lit(0.0).alias("both"), pairs(F.col("n")).alias("ra"), F.lit(0.0).alias("rb"),
                F.lit(0).cast("bigint").alias("n"),
            )
        )
        .unionByName(
            cols.select(
                *groups, F.lit(0.0).alias("both"), F.lit(0.0).alias("ra"), pairs(F.col("n")).alias("rb"),
                F.lit(0).cast("bigint").alias("n"),
            )
        )
    )
    sums = parts.groupBy(*groups).agg(*[F.sum(c).alias(c) for c in ("both", "ra", "rb", "n")])
    expected = F.try_divide(F.col("ra") * F.col("rb"), pairs(F.col("n")))
    ceiling = (F.col("ra") + F.col("rb")) / 2
    # Two trivial labelings agree fully.
    index = F.coalesce(F.try_divide(F.col("both") - expected, ceiling - expected), F.lit(1.0))
    return sums.select(*groups, index.alias("adjusted_rand"))


def mean_and_std(df: DataFrame, name: str) -> DataFrame:
    """Mean and population standard deviation of a metric column."""
    return df.agg(F.avg(name).alias("mean"), F.stddev_pop(name).alias("std"))
