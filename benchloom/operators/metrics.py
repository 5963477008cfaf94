"""Metrics as grouped aggregates.  ``by`` columns (model, fold, key, ...) score many runs in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from benchloom.functions.columns import col, ratio_or_zero, safe_div
from benchloom.operators.ordering import ROWS_PER_CHUNK, _same, ordered_scan

DEFAULT_AUC = 0.5


def _cols(names: Sequence[str]):
    return [col(n) for n in names]


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """(by, tp, fp, fn, tn) with 1 as the positive class."""
    y, p = col(label) == 1, col(pred) == 1
    return df.groupBy(*_cols(by)).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"),
        F.count_if(col(label) == col(pred)).alias("hits"), F.count("*").alias("n"),
    )


def _scores(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        *_cols(by),
        ratio_or_zero(F.col("hits"), F.col("n")).alias("accuracy"),
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """(by, label, pred, n) for every pair of occurring classes, zero counts included."""
    counts = df.groupBy(*_cols(by), col(label).cast("double").alias("label"), col(pred).cast("double").alias("pred")).agg(F.count("*").alias("n"))
    seen = counts.select(*_cols(by), F.explode(F.array("label", "pred")).alias("c")).groupBy(*_cols(by)).agg(F.array_sort(F.collect_set("c")).alias("cs"))
    grid = seen.select(*_cols(by), F.explode("cs").alias("label"), "cs").select(*_cols(by), "label", F.explode("cs").alias("pred"))
    out = _same(grid, counts, [*by, "label", "pred"], "left")
    return out.select(*_cols(by), "label", "pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def confusion_array(df: DataFrame, label: str = "label", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """(by, confusion_matrix ARRAY<ARRAY<BIGINT>>): rows are true classes, columns predictions, both sorted."""
    long = confusion_matrix(df, label, pred, by)
    rows = long.groupBy(*_cols(by), "label").agg(F.array_sort(F.collect_list(F.struct("pred", "n"))).alias("cells"))
    rows = rows.select(*_cols(by), F.struct("label", F.col("cells.n").alias("ns")).alias("r"))
    return rows.groupBy(*_cols(by)).agg(F.array_sort(F.collect_list("r")).alias("rs")).select(*_cols(by), F.col("rs.ns").alias("confusion_matrix"))


def score_groups(df: DataFrame, label: str, prob: str, by: Sequence[str]) -> DataFrame:
    """(by, score, p, n): positives and negatives per distinct score, combined map-side."""
    y = col(label) == 1
    return (
        df.filter(col(prob).isNotNull())
        .groupBy(*_cols(by), col(prob).cast("double").alias("score"))
        .agg(F.count_if(y).alias("p"), F.count_if(~y).alias("n"))
    )


def auc_roc(
    df: DataFrame, label: str = "label", prob: str = "prob", by: Sequence[str] = (), rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """(by, auc): the rank statistic with ties counted half; NULL when only one class is present."""
    groups = score_groups(df, label, prob, by)
    run = ordered_scan(groups, by, ["score"], sums={"cum_n": F.col("n")}, rows_per_chunk=rows_per_chunk)
    # DOUBLE keeps exact integers up to 2**53 pairs and avoids overflow beyond
    wins = F.sum(F.col("p").cast("double") * (F.col("cum_n") - F.col("n") + F.col("n") / F.lit(2.0)))
    pairs = F.sum("p").cast("double") * F.sum("n").cast("double")
    return run.groupBy(*_cols(by)).agg(safe_div(wins, pairs).alias("auc"))


def classification_metrics(
    df: DataFrame,
    label: str = "label",
    pred: str = "pred",
    prob: str | None = None,
    by: Sequence[str] = (),
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """(by, accuracy, precision, recall, f1, auc).  Ratios over zero are 0; an undefined AUC is 0.5; no probability, no AUC."""
    scores = _scores(confusion_counts(df, label, pred, by), by)
    if prob is None:
        return scores.withColumn("auc", F.lit(None).cast("double"))
    auc = auc_roc(df, label, prob, by, rows_per_chunk)
    if not by:
        return scores.withColumn("auc", F.coalesce(auc.scalar(), F.lit(DEFAULT_AUC)))
    # rows without any probability stay without AUC; one-class runs get the default
    has_prob = auc.withColumn("auc", F.coalesce("auc", F.lit(DEFAULT_AUC)))
    return _same(scores, has_prob, by, "left")


def auc_or_default(auc, legacy: bool = False):
    """Leaderboard AUC: missing counts as 0.5; ``legacy`` also replaces an AUC of exactly 0."""
    out = F.coalesce(auc, F.lit(DEFAULT_AUC))
    return F.when(auc == 0, F.lit(DEFAULT_AUC)).otherwise(out) if legacy else out


def _curve(df: DataFrame, label: str, prob: str, by: Sequence[str], rows_per_chunk: int, lead: Sequence[str] = ()) -> DataFrame:
    """Distinct scores from high to low with running positives/negatives and totals."""
    groups = score_groups(df, label, prob, by).withColumn("_down", -F.col("score"))
    run = ordered_scan(
        groups, by, ["_down"], sums={"tp": F.col("p"), "fp": F.col("n"), "at": F.lit(1).cast("bigint")}, lead=lead, rows_per_chunk=rows_per_chunk
    )
    totals = groups.groupBy(*_cols(by)).agg(F.sum("p").alias("pos"), F.sum("n").alias("neg"))
    if by:
        return _same(run, totals, by, "inner")
    packed = totals.select(F.struct("*")).scalar()
    return run.select("*", packed.getField("pos").alias("pos"), packed.getField("neg").alias("neg"))


def roc_curve(
    df: DataFrame, label: str = "label", prob: str = "prob", by: Sequence[str] = (), rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """(by, threshold, fpr, tpr): starts at (+inf, 0, 0); points on a straight line between neighbours are left out."""
    run = _curve(df, label, prob, by, rows_per_chunk, lead=["p", "n"])
    corner = (F.col("at") == 1) | F.col("next_p").isNull() | (F.col("next_p") != F.col("p")) | (F.col("next_n") != F.col("n"))
    points = run.filter(corner).select(
        *_cols(by), F.col("score").alias("threshold"), safe_div(F.col("fp"), F.col("neg")).alias("fpr"), safe_div(F.col("tp"), F.col("pos")).alias("tpr")
    )
    start = run.filter(F.col("at") == 1).select(
        *_cols(by), F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


def precision_recall_curve(
    df: DataFrame, label: str = "label", prob: str = "prob", by: Sequence[str] = (), rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """(by, threshold, precision, recall) for every distinct score, and the end point (NULL, 1, 0)."""
    run = _curve(df, label, prob, by, rows_per_chunk)
    points = run.select(
        *_cols(by),
        F.col("score").alias("threshold"),
        safe_div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        # without any positive the recall is 1 by convention
        F.coalesce(safe_div(F.col("tp"), F.col("pos")), F.lit(1.0)).alias("recall"),
    )
    end = run.filter(F.col("at") == 1).select(
        *_cols(by), F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def regression_metrics(df: DataFrame, label: str = "y", pred: str = "yhat", by: Sequence[str] = ()) -> DataFrame:
    """(by, mse, rmse, mae, r2) in one pass.  A constant actual gives r2 = 1 when predicted exactly, else 0."""
    y, e = col(label).cast("double"), col(label).cast("double") - col(pred).cast("double")
    row = df.groupBy(*_cols(by)).agg(
        F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.var_pop(F.when(e.isNotNull(), y)).alias("_var")
    )
    r2 = F.when(F.col("_var") == 0, F.when(F.col("mse") == 0, 1.0).otherwise(0.0)).otherwise(1.0 - safe_div(F.col("mse"), F.col("_var")))
    return row.select(*_cols(by), "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2"))


def forecast_metrics(df: DataFrame, label: str = "y", pred: str = "yhat", by: Sequence[str] = ()) -> DataFrame:
    """(by, mse, rmse, mae, mape); MAPE in percent over the non-zero actuals, NULL when there are none."""
    y, e = col(label).cast("double"), col(label).cast("double") - col(pred).cast("double")
    row = df.groupBy(*_cols(by)).agg(
        F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), (F.avg(F.abs(e / F.nullif(y, F.lit(0.0)))) * 100).alias("mape")
    )
    return row.select(*_cols(by), "mse", F.sqrt("mse").alias("rmse"), "mae", "mape")
