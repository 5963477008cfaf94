"""Metric and threshold queries on the scored documents and on simple predictors."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchloom.models.panel import seasonal_naive_forecast
from benchloom.operators import metrics, series, threshold, validate
from benchloom.operators.ordering import positions
from benchloom.operators.split import stratified_fold_assign
from benchloom.queries.catalog import SCORED_SQL, load, monthly_orders, query, rounded, scored_documents
from benchloom.queries.preparation import TIME_SPLIT_SQL

RATES = ["accuracy", "precision", "recall", "f1"]

CONFUSION_SQL = (
    f"SELECT count(*) FILTER (label = 1 AND pred = 1)::DOUBLE AS tp, count(*) FILTER (label = 0 AND pred = 1)::DOUBLE AS fp, "
    f"count(*) FILTER (label = 1 AND pred = 0)::DOUBLE AS fn, count(*) FILTER (label = 0 AND pred = 0)::DOUBLE AS tn FROM {SCORED_SQL} s"
)
AUC_SQL = (
    f"SELECT sum(p * (cum - n + n / 2.0::DOUBLE)) / (sum(p)::DOUBLE * sum(n)::DOUBLE) AS auc FROM (SELECT prob, p, n, sum(n) OVER (ORDER BY prob)::DOUBLE AS cum FROM "
    f"(SELECT prob, (count(*) FILTER (label = 1))::DOUBLE AS p, (count(*) FILTER (label = 0))::DOUBLE AS n FROM {SCORED_SQL} s GROUP BY 1) g) c"
)
RATES_SQL = (
    "round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, "
    "round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1"
)


@query(
    "confusion",
    f"WITH s AS (SELECT label::DOUBLE AS label, pred::DOUBLE AS pred FROM {SCORED_SQL} q), c AS (SELECT label AS v FROM s UNION SELECT pred FROM s) "
    "SELECT a.v AS label, b.v AS pred, (SELECT count(*) FROM s WHERE s.label = a.v AND s.pred = b.v) AS n FROM c a CROSS JOIN c b",
)
def confusion(spark, sf):
    return metrics.confusion_matrix(scored_documents(spark, sf))


@query("classification_metrics", f"SELECT {RATES_SQL}, (SELECT round(auc, 6) FROM ({AUC_SQL}) a) AS auc FROM ({CONFUSION_SQL}) c")
def classification_metrics(spark, sf):
    return rounded(metrics.classification_metrics(scored_documents(spark, sf), prob="prob"), [*RATES, "auc"])


@query("auc_roc", f"SELECT round(auc, 6) AS auc FROM ({AUC_SQL}) a")
def auc_roc(spark, sf):
    return rounded(metrics.auc_roc(scored_documents(spark, sf)), ["auc"])


@query("auc_roc_chunked", f"SELECT round(auc, 6) AS auc FROM ({AUC_SQL}) a")
def auc_roc_chunked(spark, sf):
    # the range-partitioned path, as for more distinct scores than one task may order
    return rounded(metrics.auc_roc(scored_documents(spark, sf), rows_per_chunk=20), ["auc"])


CURVE_SQL = (
    f"g AS (SELECT prob, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM {SCORED_SQL} s GROUP BY 1), "
    "c AS (SELECT prob, p, n, sum(p) OVER w AS tp, sum(n) OVER w AS fp, lead(p) OVER w AS np, lead(n) OVER w AS nn, row_number() OVER w AS nr, "
    "(SELECT sum(p) FROM g)::DOUBLE AS pos, (SELECT sum(n) FROM g)::DOUBLE AS neg FROM g WINDOW w AS (ORDER BY prob DESC))"
)
ROC_SQL = (
    f"WITH {CURVE_SQL} SELECT 'infinity'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr UNION ALL "
    "SELECT prob, round(fp / neg, 6), round(tp / pos, 6) FROM c WHERE nr = 1 OR np IS NULL OR np <> p OR nn <> n"
)


@query("roc_curve", ROC_SQL)
def roc_curve(spark, sf):
    return rounded(metrics.roc_curve(scored_documents(spark, sf)), ["fpr", "tpr"])


@query("roc_curve_chunked", ROC_SQL)
def roc_curve_chunked(spark, sf):
    return rounded(metrics.roc_curve(scored_documents(spark, sf), rows_per_chunk=20), ["fpr", "tpr"])


@query(
    "pr_curve",
    f"WITH {CURVE_SQL} SELECT prob AS threshold, round(tp / (tp + fp)::DOUBLE, 6) AS precision, round(tp / pos, 6) AS recall FROM c "
    "UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE",
)
def pr_curve(spark, sf):
    return rounded(metrics.precision_recall_curve(scored_documents(spark, sf)), ["precision", "recall"])


def _sweep_sql(start: float, step: float, points: int) -> str:
    return (
        f"SELECT threshold, {RATES_SQL} FROM (SELECT threshold, count(*) FILTER (label = 1 AND prob >= threshold)::DOUBLE AS tp, "
        "count(*) FILTER (label = 0 AND prob >= threshold)::DOUBLE AS fp, count(*) FILTER (label = 1 AND prob < threshold)::DOUBLE AS fn, "
        f"count(*) FILTER (label = 0 AND prob < threshold)::DOUBLE AS tn FROM {SCORED_SQL} s CROSS JOIN "
        f"(SELECT {start}::DOUBLE + {step}::DOUBLE * unnest(range({points})) AS threshold) t GROUP BY 1) c"
    )


@query("threshold_sweep", _sweep_sql(0.10, 0.05, 18))
def threshold_sweep(spark, sf):
    return rounded(threshold.threshold_sweep(scored_documents(spark, sf)), RATES)


@query("threshold_search", _sweep_sql(0.01, 0.01, 99))
def threshold_search(spark, sf):
    return rounded(threshold.threshold_sweep(scored_documents(spark, sf), thresholds=threshold.search_grid()), RATES)


@query(
    "optimal_threshold",
    " UNION ALL ".join(
        f"(SELECT '{m}' AS metric, threshold, {m} AS score FROM ({_sweep_sql(0.01, 0.01, 99)}) x ORDER BY {m} DESC, threshold LIMIT 1)" for m in threshold.METRICS
    ),
)
def optimal_threshold(spark, sf):
    sweep = threshold.threshold_sweep(scored_documents(spark, sf), thresholds=threshold.search_grid())
    return rounded(threshold.best_of_sweep(sweep), ["score"])


FOLDED_SQL = (
    f"SELECT *, ((row_number() OVER (ORDER BY label, md5('42|fold|' || row_id), row_id) - 1) % 5)::INTEGER AS fold FROM {SCORED_SQL} s"
)


@query(
    "manual_kfold_metrics",
    f"WITH f AS ({FOLDED_SQL}), c AS (SELECT fold, count(*) FILTER (label = 1 AND pred = 1)::DOUBLE AS tp, count(*) FILTER (label = 0 AND pred = 1)::DOUBLE AS fp, "
    "count(*) FILTER (label = 1 AND pred = 0)::DOUBLE AS fn, count(*) FILTER (label = 0 AND pred = 0)::DOUBLE AS tn FROM f GROUP BY 1), "
    "g AS (SELECT fold, prob, (count(*) FILTER (label = 1))::DOUBLE AS p, (count(*) FILTER (label = 0))::DOUBLE AS n FROM f GROUP BY 1, 2), "
    "u AS (SELECT fold, sum(p * (cum - n + n / 2)) / (sum(p) * sum(n)) AS auc FROM (SELECT *, sum(n) OVER (PARTITION BY fold ORDER BY prob) AS cum FROM g) h GROUP BY 1) "
    "SELECT fold, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round(auc, 6) AS auc FROM c JOIN u USING (fold)",
)
def manual_kfold_metrics(spark, sf):
    folds = stratified_fold_assign(scored_documents(spark, sf), "row_id", "label").withColumn("prediction", F.col("pred"))
    return rounded(validate.manual_kfold_metrics(folds), ["accuracy", "f1", "auc"])


@query(
    "regression_metrics",
    "SELECT l_returnflag, round(avg(e * e), 4) AS mse, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae, round(1 - sum(e * e) / (var_pop(l_extendedprice) * count(*)), 6) AS r2 "
    "FROM (SELECT l_returnflag, l_extendedprice, l_extendedprice - 2000.0::DOUBLE * l_quantity AS e FROM lineitem) x GROUP BY 1",
)
def regression_metrics(spark, sf):
    lines = load(spark, sf, "lineitem").withColumn("yhat", F.lit(2000.0) * F.col("l_quantity"))
    out = metrics.regression_metrics(lines, "l_extendedprice", "yhat", by=["l_returnflag"])
    return rounded(rounded(out, ["rmse", "mae", "r2"]), ["mse"], 4)


@query(
    "forecast_metrics",
    f"WITH {TIME_SPLIT_SQL}, tr AS (SELECT key, y, row_number() OVER (PARTITION BY key ORDER BY t DESC) AS r FROM p WHERE split = 'train'), "
    "te AS (SELECT key, y, row_number() OVER (PARTITION BY key ORDER BY t) AS step FROM p WHERE split = 'test') "
    "SELECT te.key, round(avg(pow(te.y - tr.y, 2)), 6) AS mse, round(sqrt(avg(pow(te.y - tr.y, 2))), 6) AS rmse, round(avg(abs(te.y - tr.y)), 6) AS mae, "
    "round(avg(abs((te.y - tr.y) / nullif(te.y, 0))) * 100, 6) AS mape FROM te JOIN tr ON te.key = tr.key AND tr.r = 12 - (te.step - 1) % 12 GROUP BY 1",
)
def forecast_metrics(spark, sf):
    parts = series.time_split(monthly_orders(spark, sf), ["key"], "t")
    test = positions(parts.filter(F.col("split") == "test"), ["key"], ["t"], "step")
    steps = test.agg(F.max("step")).first()[0]
    guess = seasonal_naive_forecast(parts.filter(F.col("split") == "train"), steps, 12)
    joined = test.join(guess, ["key", "step"])
    return rounded(metrics.forecast_metrics(joined, by=["key"]), ["mse", "rmse", "mae", "mape"])
