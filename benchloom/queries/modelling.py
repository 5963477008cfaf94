"""Model queries: closed-form models against SQL, Spark ML models by rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from benchloom.models import registry
from benchloom.models.base import assemble, predict_classification
from benchloom.models.histogram_trees import HistogramBoosting
from benchloom.models.knn import KNNClassifier, KNNRegressor
from benchloom.models.naive_bayes import GaussianNB
from benchloom.models.panel import Baseline, drift_forecast, naive_forecast, seasonal_naive_forecast
from benchloom.operators.split import kfold_assign, split_data
from benchloom.operators.validate import cv_predictions, fold_scores, stratified_kfold, kfold_validation
from benchloom.plans.benchmark import run_benchmark
from benchloom.queries.catalog import EMBEDDED_SQL, embedded, labelled_documents, load, monthly_orders, query, rounded, sql_plain_split, sql_split
from benchloom.queries.preparation import TIME_SPLIT_SQL


def _split_embedded(spark, sf) -> tuple[DataFrame, DataFrame]:
    return split_data(embedded(spark, sf), "row_id", "label")


NB_SQL = f"""WITH {sql_split(EMBEDDED_SQL, 'row_id', 'label')},
x AS (SELECT row_id, label, split, unnest(features) AS v, generate_subscripts(features, 1) AS j FROM parts),
eps AS (SELECT max(vp) * 1e-9::DOUBLE AS e FROM (SELECT j, var_pop(v) AS vp FROM x WHERE split = 'train' GROUP BY 1) a),
st AS (SELECT label AS c, j, avg(v) AS mu, var_pop(v) + (SELECT e FROM eps) AS va FROM x WHERE split = 'train' GROUP BY 1, 2),
pr AS (SELECT label AS c, count(*)::DOUBLE / (SELECT count(*) FROM parts WHERE split = 'train') AS p FROM parts WHERE split = 'train' GROUP BY 1),
ll AS (SELECT x.row_id, x.label, st.c, ln(any_value(pr.p)) - 0.5::DOUBLE * sum(ln(2 * pi() * va) + pow(v - mu, 2) / va) AS g
       FROM x JOIN st USING (j) JOIN pr ON pr.c = st.c WHERE x.split = 'test' GROUP BY 1, 2, 3),
top AS (SELECT row_id, max(g) AS m FROM ll GROUP BY 1)
SELECT row_id, label, round(sum(exp(g - m)) FILTER (c = 1) / sum(exp(g - m)), 6) AS prob, arg_max(c, g) AS prediction FROM ll JOIN top USING (row_id) GROUP BY 1, 2"""


@query("gaussian_nb", NB_SQL)
def gaussian_nb(spark, sf):
    train, test = _split_embedded(spark, sf)
    return rounded(GaussianNB().fit(train).transform(test).select("row_id", "label", "prob", "prediction"), ["prob"])


def _knn_sql(source: str, split: str, dist: str, agg: str, k: int = 5) -> str:
    return f"""WITH {split},
nn AS (SELECT a.row_id, a.label AS actual, b.label AS y, {dist} AS d, row_number() OVER (PARTITION BY a.row_id ORDER BY {dist}, b.row_id) AS r
       FROM parts a JOIN parts b ON a.split = 'test' AND b.split = 'train'),
kn AS (SELECT *, min(d) OVER (PARTITION BY row_id) AS best FROM nn WHERE r <= {k})
SELECT row_id, actual AS label, round({agg}, 6) AS {{out}} FROM kn GROUP BY 1, 2"""


WEIGHTED = (
    "sum(y * CASE WHEN best = 0 THEN (d = 0)::INTEGER ELSE 1 / nullif(d, 0) END) / sum(CASE WHEN best = 0 THEN (d = 0)::INTEGER ELSE 1 / nullif(d, 0) END)"
)
MANHATTAN = "list_sum([abs(v[1] - v[2]) for v in list_zip(a.features, b.features)])"


@query("knn_classify", _knn_sql(EMBEDDED_SQL, sql_split(EMBEDDED_SQL, "row_id", "label"), "list_distance(a.features, b.features)", "avg(y)").format(out="prob"))
def knn_classify(spark, sf):
    train, test = _split_embedded(spark, sf)
    return rounded(KNNClassifier(5).fit(train).transform(test).select("row_id", "label", "prob"), ["prob"])


@query("knn_classify_weighted", _knn_sql(EMBEDDED_SQL, sql_split(EMBEDDED_SQL, "row_id", "label"), MANHATTAN, WEIGHTED).format(out="prob"))
def knn_classify_weighted(spark, sf):
    train, test = _split_embedded(spark, sf)
    model = KNNClassifier(5, weights="distance", metric="manhattan").fit(train)
    return rounded(model.transform(test).select("row_id", "label", "prob"), ["prob"])


PARTS_SQL = "(SELECT p_partkey AS row_id, p_retailprice AS label, [p_size::DOUBLE, (p_partkey % 1000)::DOUBLE] AS features FROM part)"


def priced_parts(spark, sf) -> DataFrame:
    parts = load(spark, sf, "part").withColumn("series_no", F.col("p_partkey") % 1000)
    return assemble(parts, "p_retailprice", "p_partkey", ["p_size", "series_no"])


@query(
    "knn_regress",
    _knn_sql(PARTS_SQL, sql_plain_split(PARTS_SQL, "row_id"), "list_distance(a.features, b.features)", WEIGHTED).format(out="prediction"),
)
def knn_regress(spark, sf):
    train, test = split_data(priced_parts(spark, sf), "row_id")
    return rounded(KNNRegressor(5, weights="distance").fit(train).transform(test).select("row_id", "label", "prediction"), ["prediction"])


EVENT_LINE_SQL = f"""WITH {sql_plain_split('(SELECT event_id AS row_id, user_id::DOUBLE AS x, value AS label FROM events)', 'row_id')},
f AS (SELECT covar_pop(x, label) * count(*) / (var_pop(x) * count(*) + 1) AS slope, avg(x) AS mx, avg(label) AS my FROM parts WHERE split = 'train')
SELECT row_id, label, round(my + slope * (x - mx), 6) AS prediction FROM parts, f WHERE split = 'test'"""


def event_line(spark, sf) -> DataFrame:
    return assemble(load(spark, sf, "events"), "value", "event_id", ["user_id"])


@query("ridge_1d", EVENT_LINE_SQL)
def ridge_1d(spark, sf):
    train, test = split_data(event_line(spark, sf), "row_id")
    return rounded(registry.ridge(1.0).fit(train).transform(test).select("row_id", "label", "prediction"), ["prediction"])


@query(
    "ols_cv_r2",
    "WITH s AS (SELECT event_id AS row_id, user_id::DOUBLE AS x, value AS y, ((row_number() OVER (ORDER BY md5('42|fold|' || event_id), event_id) - 1) % 5)::INTEGER AS fold FROM events), "
    "f AS (SELECT k.fold, covar_pop(x, y) * count(*) / (var_pop(x) * count(*) + 1) AS slope, avg(x) AS mx, avg(y) AS my FROM s JOIN (SELECT DISTINCT fold FROM s) k ON s.fold <> k.fold GROUP BY 1) "
    "SELECT fold, round(1 - sum(pow(y - my - slope * (x - mx), 2)) / (var_pop(y) * count(*)), 6) AS score FROM s JOIN f USING (fold) GROUP BY 1",
)
def ols_cv_r2(spark, sf):
    folds = kfold_assign(event_line(spark, sf), "row_id")
    return rounded(fold_scores(cv_predictions(registry.ridge(1.0), folds, 5), "r2"), ["score"])


def _classified(spark, sf, estimator) -> DataFrame:
    train, test = _split_embedded(spark, sf)
    return predict_classification(estimator.fit(train), test).select("row_id", "label", "pred", F.round("prob", 6).alias("prob"))


def _regressed(spark, sf, estimator) -> DataFrame:
    train, test = split_data(priced_parts(spark, sf), "row_id")
    return estimator.fit(train).transform(test).select("row_id", "label", F.round("prediction", 4).alias("prediction"))


CLASSIFIER_QUERIES = {
    "logistic": lambda: registry.logistic_regression(),
    "random_forest": lambda: registry.random_forest_classifier(n_estimators=20, max_depth=8),
    "decision_tree": lambda: registry.decision_tree_classifier(max_depth=8),
    "gbt": lambda: registry.gradient_boosting_classifier(n_estimators=10),
    "gbt_stochastic": lambda: registry.stochastic_boosting_classifier(n_estimators=10, subsample=0.8),
    "svm_rff": lambda: registry.svm_classifier(),
    "svm_linear": lambda: registry.svm_classifier(kernel="linear"),
    "svm_poly": lambda: registry.svm_classifier(kernel="poly"),
}
REGRESSOR_QUERIES = {
    "lasso": lambda: registry.lasso(),
    "random_forest_regress": lambda: registry.random_forest_regressor(n_estimators=20, max_depth=8),
    "decision_tree_regress": lambda: registry.decision_tree_regressor(max_depth=8),
    "gbt_regress": lambda: registry.gradient_boosting_regressor(n_estimators=10),
    "gbt_stochastic_regress": lambda: registry.stochastic_boosting_regressor(n_estimators=10, subsample=0.8),
    "svr_rff": lambda: registry.svr(),
    "svr_linear": lambda: registry.svr(kernel="linear"),
    "svr_poly": lambda: registry.svr(kernel="poly"),
}

for _name, _make in CLASSIFIER_QUERIES.items():
    query(_name)(lambda spark, sf, make=_make: _classified(spark, sf, make()))
for _name, _make in REGRESSOR_QUERIES.items():
    query(_name)(lambda spark, sf, make=_make: _regressed(spark, sf, make()))


def _cv_frame(spark, cv: dict) -> DataFrame:
    return spark.createDataFrame([(cv["mean"], cv["std"], cv["scores"])], "mean double, std double, scores array<double>")


def _stump_sql(source: str, hessian: str, start: str, output: str) -> str:
    """One tree of depth 1 with penalty 1 and learning rate 1; source: x, y."""
    return f"""WITH s AS (SELECT * FROM {source} q), m AS (SELECT avg(y) AS p FROM s),
c AS (SELECT x, sum(p - y) AS g, count(*) * any_value({hessian}) AS h FROM s, m GROUP BY x),
t AS (SELECT x, sum(g) OVER (ORDER BY x) AS gl, sum(h) OVER (ORDER BY x) AS hl, sum(g) OVER () AS g, sum(h) OVER () AS h FROM c),
b AS (SELECT x AS cut, gl, hl, g, h FROM t WHERE hl >= 1 AND h - hl >= 1 ORDER BY gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) DESC, x LIMIT 1)
SELECT x, round({output}, 6) AS prediction FROM (SELECT DISTINCT x, {start} + CASE WHEN x <= cut THEN -gl / (hl + 1) ELSE -(g - gl) / (h - hl + 1) END AS raw FROM s, m, b) r"""


@query("boosted_stump_regress", _stump_sql("(SELECT p_size::DOUBLE AS x, p_retailprice AS y FROM part)", "1.0::DOUBLE", "p", "raw"))
def boosted_stump_regress(spark, sf):
    rows = assemble(load(spark, sf, "part"), "p_retailprice", "p_partkey", ["p_size"])
    return _stump(rows, HistogramBoosting(False, 1, 1.0, 1), "prediction")


@query(
    "boosted_stump",
    _stump_sql("(SELECT l_quantity AS x, (l_returnflag = 'R')::INTEGER AS y FROM lineitem)", "p * (1 - p)", "ln(p / (1 - p))", "1 / (1 + exp(-raw))"),
)
def boosted_stump(spark, sf):
    lines = load(spark, sf, "lineitem").withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    return _stump(assemble(lines, "returned", "l_orderkey", ["l_quantity"]), HistogramBoosting(True, 1, 1.0, 1), "prob")


def _stump(rows: DataFrame, estimator, out: str) -> DataFrame:
    found = estimator.fit(rows).transform(rows).select(F.col("features")[0].alias("x"), F.round(out, 6).alias("prediction"))
    return found.distinct()


CV_SUMMARY = "round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std, list(round(score, 6) ORDER BY fold) AS scores"

NB_CV_SQL = f"""WITH s AS (SELECT *, ((row_number() OVER (ORDER BY label, md5('42|fold|' || row_id), row_id) - 1) % 5)::INTEGER AS fold FROM {EMBEDDED_SQL} e),
x AS (SELECT row_id, label, fold, unnest(features) AS v, generate_subscripts(features, 1) AS j FROM s),
own AS (SELECT fold, label, j, count(*)::DOUBLE AS n, sum(v) AS sv, sum(v * v) AS sq FROM x GROUP BY 1, 2, 3),
rest AS (SELECT k.fold, label, j, sum(n) AS n, sum(sv) AS sv, sum(sq) AS sq FROM own JOIN (SELECT DISTINCT fold FROM s) k ON k.fold <> own.fold GROUP BY 1, 2, 3),
eps AS (SELECT fold, max(vp) * 1e-9::DOUBLE AS e FROM (SELECT fold, j, sum(sq) / sum(n) - pow(sum(sv) / sum(n), 2) AS vp FROM rest GROUP BY 1, 2) a GROUP BY 1),
st AS (SELECT fold, label AS c, j, n, sv / n AS mu, sq / n - pow(sv / n, 2) + e AS va FROM rest JOIN eps USING (fold)),
ll AS (SELECT x.row_id, x.label, x.fold, st.c, ln(any_value(st.n)) - 0.5::DOUBLE * sum(ln(va) + pow(v - mu, 2) / va) AS g
       FROM x JOIN st ON st.fold = x.fold AND st.j = x.j GROUP BY 1, 2, 3, 4),
p AS (SELECT row_id, label, fold, 1 / (1 + exp(sum(CASE WHEN c = 1 THEN -g ELSE g END))) AS prob FROM ll GROUP BY 1, 2, 3),
g AS (SELECT fold, prob, (count(*) FILTER (label = 1))::DOUBLE AS pos, (count(*) FILTER (label = 0))::DOUBLE AS neg FROM p GROUP BY 1, 2),
u AS (SELECT fold, sum(pos * (cum - neg + neg / 2)) / (sum(pos) * sum(neg)) AS score FROM (SELECT *, sum(neg) OVER (PARTITION BY fold ORDER BY prob) AS cum FROM g) h GROUP BY 1)
SELECT {CV_SUMMARY} FROM u"""


def _rounded_cv(spark, cv: dict) -> DataFrame:
    frame = _cv_frame(spark, cv)
    return rounded(frame, ["mean", "std"]).withColumn("scores", F.transform("scores", lambda s: F.round(s, 6)))


@query("stratified_cv_auc", NB_CV_SQL)
def stratified_cv_auc(spark, sf):
    return _rounded_cv(spark, stratified_kfold(GaussianNB(), embedded(spark, sf)))


RIDGE_CV_SQL = f"""WITH s AS (SELECT row_id, label AS y, features[1] AS u, features[2] AS v,
  ((row_number() OVER (ORDER BY md5('42|fold|' || row_id), row_id) - 1) % 5)::INTEGER AS fold FROM {PARTS_SQL} q),
t AS (SELECT k.fold, avg(y) AS my, avg(u) AS mu, avg(v) AS mv, var_pop(u) * count(*) + 1 AS uu, var_pop(v) * count(*) + 1 AS vv, covar_pop(u, v) * count(*) AS uv,
  covar_pop(u, y) * count(*) AS uy, covar_pop(v, y) * count(*) AS vy FROM s JOIN (SELECT DISTINCT fold FROM s) k ON s.fold <> k.fold GROUP BY 1),
w AS (SELECT *, (uy * vv - vy * uv) / (uu * vv - uv * uv) AS a, (vy * uu - uy * uv) / (uu * vv - uv * uv) AS b FROM t),
r AS (SELECT fold, 1 - avg(pow(y - my - a * (u - mu) - b * (v - mv), 2)) / var_pop(y) AS score FROM s JOIN w USING (fold) GROUP BY 1)
SELECT {CV_SUMMARY} FROM r"""


@query("kfold_cv_r2", RIDGE_CV_SQL)
def kfold_cv_r2(spark, sf):
    return _rounded_cv(spark, kfold_validation(registry.ridge(), priced_parts(spark, sf)))


@query(
    "correlation_wide",
    "WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS j FROM embeddings) "
    "SELECT 'd' || a.j AS a, 'd' || b.j AS b, round(corr(a.v, b.v), 6) AS r FROM x a JOIN x b USING (vec_id) GROUP BY 1, 2",
)
def correlation_wide(spark, sf):
    """Correlations of the 64 dimensions of the embeddings."""
    from benchloom.operators.profile import correlations

    vectors = load(spark, sf, "embeddings")
    return rounded(correlations(vectors.select(*[F.col("embedding")[j].alias(f"d{j + 1}") for j in range(64)])), ["r"])


@query("bench_classification")
def bench_classification(spark, sf):
    docs = labelled_documents(spark, sf).filter(F.col("quality").isNotNull()).select("doc_id", "lang", "source", "n_chars", "quality")
    models = registry.build_models("classification", ["Logistic Regression", "Naive Bayes", "Decision Tree"], {"Decision Tree": {"max_depth": 5}})
    return run_benchmark("classification", docs, "quality", "doc_id", models=models, cv_folds=3).results


@query("bench_regression")
def bench_regression(spark, sf):
    parts = load(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    models = registry.build_models("regression", ["Ridge Regression", "Lasso Regression", "Decision Tree"], {"Decision Tree": {"max_depth": 5}})
    return run_benchmark("regression", parts, "p_retailprice", "p_partkey", models=models, cv_folds=3).results


@query("bench_timeseries")
def bench_timeseries(spark, sf):
    from benchloom.models.series_registry import build_timeseries_models

    models = build_timeseries_models(["Holt-Winters", "ARIMA(1,1,1)", "LSTM"], seasonal_periods=12)
    return run_benchmark("timeseries", monthly_orders(spark, sf), "y", t="t", keys=["key"], models=models).results


BENCH_RIDGE_SQL = f"""WITH {sql_plain_split('(SELECT event_id AS row_id, user_id::DOUBLE AS x, value AS label FROM events)', 'row_id')},
sc AS (SELECT avg(x) AS m, stddev_pop(x) AS s FROM parts WHERE split = 'train'),
z AS (SELECT row_id, label, split, (x - m) / s AS x FROM parts, sc),
f AS (SELECT covar_pop(x, label) * count(*) / (var_pop(x) * count(*) + 1) AS w, avg(x) AS mx, avg(label) AS my FROM z WHERE split = 'train'),
e AS (SELECT label, label - my - w * (x - mx) AS e FROM z, f WHERE split = 'test'),
fo AS (SELECT x, label, (row_number() OVER (ORDER BY md5('42|fold|' || row_id), row_id) - 1) % 5 AS fold FROM z WHERE split = 'train'),
ff AS (SELECT k.fold, covar_pop(x, label) * count(*) / (var_pop(x) * count(*) + 1) AS w, avg(x) AS mx, avg(label) AS my
       FROM fo JOIN (SELECT DISTINCT fold FROM fo) k ON fo.fold <> k.fold GROUP BY 1),
sco AS (SELECT fold, 1 - avg(pow(label - my - w * (x - mx), 2)) / var_pop(label) AS score FROM fo JOIN ff USING (fold) GROUP BY 1)
SELECT 'Ridge Regression' AS model, round(avg(e * e), 4) AS mse, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae,
round(1 - avg(e * e) / var_pop(label), 6) AS r2, (SELECT round(avg(score), 6) FROM sco) AS cv_mean, (SELECT round(stddev_pop(score), 6) FROM sco) AS cv_std FROM e"""


@query("bench_ridge", BENCH_RIDGE_SQL)
def bench_ridge(spark, sf):
    events = load(spark, sf, "events").select("event_id", "user_id", "value")
    models = registry.build_models("regression", ["Ridge Regression"])
    board = run_benchmark("regression", events, "value", "event_id", models=models).results.drop("cv_scores", "error")
    return rounded(rounded(board, ["rmse", "mae", "r2", "cv_mean", "cv_std"]), ["mse"], 4)


BENCH_BASELINES_SQL = f"""WITH {TIME_SPLIT_SQL}, tr AS (SELECT key, t, y, row_number() OVER (PARTITION BY key ORDER BY t DESC) AS r FROM p WHERE split = 'train'),
te AS (SELECT key, y, row_number() OVER (PARTITION BY key ORDER BY t) AS step FROM p WHERE split = 'test'),
en AS (SELECT key, arg_max(y, t) AS b, arg_min(y, t) AS a, count(*) AS n FROM tr GROUP BY 1),
g AS (SELECT 'naive' AS model, key, y, b AS yhat FROM te LEFT JOIN en USING (key) UNION ALL SELECT 'drift', key, y, b + step * (b - a) / (n - 1) FROM te LEFT JOIN en USING (key)
      UNION ALL SELECT 'seasonal', te.key, te.y, tr.y FROM te LEFT JOIN tr ON te.key = tr.key AND tr.r = 12 - (te.step - 1) % 12)
SELECT model, round(avg(pow(y - yhat, 2)), 6) AS mse, round(sqrt(avg(pow(y - yhat, 2))), 6) AS rmse, round(avg(abs(y - yhat)), 6) AS mae,
round(avg(abs((y - yhat) / nullif(y, 0))) * 100, 6) AS mape,
count(DISTINCT key) AS n_series, count(DISTINCT key) FILTER (yhat IS NULL) AS n_failed FROM g GROUP BY 1"""


@query("bench_baselines", BENCH_BASELINES_SQL)
def bench_baselines(spark, sf):
    models = {"naive": Baseline(naive_forecast), "seasonal": Baseline(seasonal_naive_forecast, m=12), "drift": Baseline(drift_forecast)}
    board = run_benchmark("timeseries", monthly_orders(spark, sf), "y", t="t", keys=["key"], models=models).results.drop("error")
    return rounded(board, ["mse", "rmse", "mae", "mape"])
