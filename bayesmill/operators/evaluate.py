"""Evaluation over per-class score vectors ``(id, target, scores array<double>)``.

Classes are 0-based positions in the score array. All operators are per-row
array expressions followed by partial + final aggregates; nothing is sorted
globally and no group is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top1(scores: Column | str) -> Column:
    """Index of the best score (first of ties -> smallest class index)."""
    s = F.col(scores) if isinstance(scores, str) else scores
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


def target_rank(scores: Column | str, target: Column | str) -> Column:
    """1 + number of classes scoring strictly above the target (the target is best of its ties)."""
    s = F.col(scores) if isinstance(scores, str) else scores
    t = F.col(target) if isinstance(target, str) else target
    ts = F.element_at(s, t + 1)
    return (F.size(F.filter(s, lambda x: x > ts)) + 1).cast("int")


def top1_pred(df: DataFrame, id_col: str = "id") -> DataFrame:
    return df.select(id_col, "target", top1("scores").alias("pred"))


def save_predictions(df: DataFrame, path: str, id_col: str = "id") -> None:
    """One table of targets and predictions, ``(id, target, pred)``."""
    top1_pred(df, id_col).write.mode("overwrite").parquet(path)


def topk_error(df: DataFrame, k: int = 5) -> DataFrame:
    """``(n, top1_err, topk_err)`` in percent; k is capped at the number of classes."""
    r = df.select(target_rank("scores", "target").alias("rank"),
                  F.least(F.lit(k), F.size("scores")).alias("k"))
    return r.agg(
        F.count(F.lit(1)).alias("n"),
        (F.lit(100.0) * (F.lit(1.0) - F.avg((F.col("rank") <= 1).cast("double")))).alias("top1_err"),
        (F.lit(100.0) * (F.lit(1.0) - F.avg((F.col("rank") <= F.col("k")).cast("double")))).alias("top5_err"),
    )


def crop_sum(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Sum the score vectors of all crops of an image: ``(id, target, scores)``.

    Long form ``(id, class, score)`` is summed by a partial + final aggregate
    and folded back into an array per image (bounded by the class count).
    """
    e = df.select(id_col, "target", F.posexplode("scores").alias("cls", "score"))
    s = e.groupBy(id_col, "target", "cls").agg(F.sum("score").alias("score"))
    return s.groupBy(id_col, "target").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("cls", "score"))), lambda x: x["score"]).alias("scores"))


def batch_errors(df: DataFrame, batch_col: str = "batch", k: int = 5) -> DataFrame:
    """Per batch ``(batch, n, top1_err, top5_err)``."""
    r = df.select(batch_col, target_rank("scores", "target").alias("rank"),
                  F.least(F.lit(k), F.size("scores")).alias("k"))
    return r.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("n"),
        (F.lit(100.0) * (F.lit(1.0) - F.avg((F.col("rank") <= 1).cast("double")))).alias("top1_err"),
        (F.lit(100.0) * (F.lit(1.0) - F.avg((F.col("rank") <= F.col("k")).cast("double")))).alias("top5_err"),
    )


def weighted_mean(batches: DataFrame, weight_col: str = "n", value_cols=("top1_err", "top5_err")) -> DataFrame:
    """Mean of per-batch values weighted by batch size: ``sum(v * n) / sum(n)``."""
    return batches.agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.sum(weight_col).alias("n"),
        *[(F.sum(F.col(v) * F.col(weight_col)) / F.sum(weight_col)).alias(v) for v in value_cols],
    )
