"""Leaderboard views.  The boards rate one simple predictor per group of rows (language, flag, priority)."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchloom.operators import metrics
from benchloom.operators.split import kfold_assign
from benchloom.plans import report
from benchloom.queries.catalog import load, query, rounded, scored_documents
from benchloom.queries.scoring import RATES_SQL

SCORED_LANG = (
    "(SELECT lang AS model, row_id, label, prob, pred FROM (SELECT l.doc_id AS row_id, d.lang, l.quality AS label, "
    "floor(200.0::DOUBLE * d.n_chars / (d.n_chars::DOUBLE + 2000.0::DOUBLE)) / 200.0::DOUBLE AS prob, "
    "CASE WHEN floor(200.0::DOUBLE * d.n_chars / (d.n_chars::DOUBLE + 2000.0::DOUBLE)) / 200.0::DOUBLE >= 0.5::DOUBLE THEN 1 ELSE 0 END AS pred "
    "FROM labels l JOIN documents d USING (doc_id)) x)"
)
BOARD_SQL = (
    f"SELECT c.model, {RATES_SQL}, round(coalesce(u.auc, 0.5), 6) AS auc FROM (SELECT model, count(*) FILTER (label = 1 AND pred = 1)::DOUBLE AS tp, "
    "count(*) FILTER (label = 0 AND pred = 1)::DOUBLE AS fp, count(*) FILTER (label = 1 AND pred = 0)::DOUBLE AS fn, "
    f"count(*) FILTER (label = 0 AND pred = 0)::DOUBLE AS tn FROM {SCORED_LANG} s GROUP BY 1) c JOIN "
    "(SELECT model, sum(p * (cum - n + n / 2)) / nullif(sum(p) * sum(n), 0) AS auc FROM (SELECT *, sum(n) OVER (PARTITION BY model ORDER BY prob) AS cum FROM "
    f"(SELECT model, prob, (count(*) FILTER (label = 1))::DOUBLE AS p, (count(*) FILTER (label = 0))::DOUBLE AS n FROM {SCORED_LANG} s GROUP BY 1, 2) g) h GROUP BY 1) u USING (model)"
)
VIEW = list(report.CLASSIFICATION_VIEW)


def language_board(spark, sf):
    docs = load(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("lang").alias("model"))
    scored = scored_documents(spark, sf).join(docs, "row_id")
    return rounded(metrics.classification_metrics(scored, prob="prob", by=["model"]), VIEW)


@query("rank_models", f"SELECT *, row_number() OVER (ORDER BY auc DESC NULLS LAST, model)::INTEGER AS rank FROM ({BOARD_SQL}) b")
def rank_models(spark, sf):
    return report.rank_models(language_board(spark, sf))


@query("compare_metric", f"SELECT model, 'f1' AS metric, f1 AS value FROM ({BOARD_SQL}) b")
def compare_metric(spark, sf):
    return report.compare_metric(language_board(spark, sf), "f1")


@query("leaderboard_long", " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS value FROM ({BOARD_SQL}) b" for m in VIEW))
def leaderboard_long(spark, sf):
    return report.leaderboard_long(language_board(spark, sf), VIEW)


@query(
    "top5_metrics",
    f"WITH r AS (SELECT *, row_number() OVER (ORDER BY auc DESC NULLS LAST, model)::INTEGER AS rank FROM ({BOARD_SQL}) b) "
    + " UNION ALL ".join(f"SELECT rank, model, '{m}' AS metric, coalesce({m}, 0) AS value FROM r WHERE rank <= 5" for m in VIEW),
)
def top5_metrics(spark, sf):
    return report.top_models(language_board(spark, sf))


@query(
    "recommendation",
    f"SELECT model, 'auc' AS metric, auc AS value, CASE WHEN auc >= 0.95 THEN 'excellent' WHEN auc >= 0.85 THEN 'good' ELSE 'weak' END AS tier "
    f"FROM ({BOARD_SQL}) b ORDER BY auc DESC NULLS LAST, model LIMIT 1",
)
def recommendation(spark, sf):
    return report.recommendation(language_board(spark, sf), "classification")


@query(
    "recommendation_regression",
    "SELECT l_linestatus AS model, 'r2' AS metric, round(1 - sum(e * e) / (var_pop(l_extendedprice) * count(*)), 6) AS value, "
    "CASE WHEN 1 - sum(e * e) / (var_pop(l_extendedprice) * count(*)) >= 0.85 THEN 'excellent' "
    "WHEN 1 - sum(e * e) / (var_pop(l_extendedprice) * count(*)) >= 0.70 THEN 'good' ELSE 'weak' END AS tier "
    "FROM (SELECT l_linestatus, l_extendedprice, l_extendedprice - 2000.0::DOUBLE * l_quantity AS e FROM lineitem) x GROUP BY 1 ORDER BY value DESC, model LIMIT 1",
)
def recommendation_regression(spark, sf):
    lines = load(spark, sf, "lineitem").select(F.col("l_linestatus").alias("model"), "l_extendedprice", (F.lit(2000.0) * F.col("l_quantity")).alias("yhat"))
    board = metrics.regression_metrics(lines, "l_extendedprice", "yhat", by=["model"])
    return rounded(report.recommendation(board, "regression"), ["value"])


@query(
    "cv_intervals",
    "WITH f AS (SELECT model, ((row_number() OVER (ORDER BY md5('42|fold|' || row_id), row_id) - 1) % 5)::INTEGER AS fold, (label = pred)::INTEGER AS hit FROM "
    f"{SCORED_LANG} s), a AS (SELECT model, fold, avg(hit) AS score FROM f GROUP BY 1, 2) "
    "SELECT model, round(avg(score), 6) AS cv_mean, round(avg(score) - stddev_pop(score), 6) AS cv_low, round(avg(score) + stddev_pop(score), 6) AS cv_high FROM a GROUP BY 1",
)
def cv_intervals(spark, sf):
    docs = load(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("lang").alias("model"))
    folds = kfold_assign(scored_documents(spark, sf).join(docs, "row_id"), "row_id")
    scores = metrics.classification_metrics(folds, by=["model", "fold"])
    board = scores.groupBy("model").agg(F.avg("accuracy").alias("cv_mean"), F.stddev_pop("accuracy").alias("cv_std"))
    return rounded(report.cv_intervals(board), ["cv_mean", "cv_low", "cv_high"])
