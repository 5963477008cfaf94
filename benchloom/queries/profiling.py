"""Profiling and distribution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchloom.operators import distributions as dist, profile
from benchloom.queries.catalog import DOCS_SQL, LINES_SQL, MONTHLY_SQL, labelled_documents, load, monthly_orders, query, rounded, sparse_lines
from benchloom.sources.tables import split_target

DOC_TYPES = {"doc_id": "bigint", "lang": "string", "source": "string", "n_chars": "bigint", "quality": "int", "toxic": "int"}


def _types_sql(missing: bool) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", {'' if missing else chr(39) + t + chr(39) + ' AS type, count(' + c + ') AS non_null, '}"
        f"count(*) - count({c}) AS nulls, round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS null_pct FROM {DOCS_SQL} s"
        for c, t in DOC_TYPES.items()
    ]
    return " UNION ALL ".join(parts)


@query("profile_types_nulls", _types_sql(False))
def profile_types_nulls(spark, sf):
    return rounded(profile.types_and_nulls(labelled_documents(spark, sf)), ["null_pct"])


@query("profile_missing", f"SELECT * FROM ({_types_sql(True)}) t WHERE nulls > 0")
def profile_missing(spark, sf):
    return rounded(profile.missing_values(labelled_documents(spark, sf)), ["null_pct"])


@query(
    "dataset_kpis",
    "WITH s AS (SELECT l_quantity, l_returnflag, l_linestatus, nullif(l_tax, 0) AS tax FROM lineitem) "
    "SELECT (SELECT count(*) FROM s) AS rows, 4 AS columns, (SELECT count(*) FROM s) - (SELECT count(*) FROM (SELECT DISTINCT * FROM s) d) "
    "AS duplicate_rows, (SELECT count(*) - count(tax) FROM s) AS total_nulls",
)
def dataset_kpis(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_quantity", "l_returnflag", "l_linestatus", F.nullif("l_tax", F.lit(0.0)).alias("tax"))
    return profile.dataset_kpis(lines)


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _summary_sql(select: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {select.format(c=c)} FROM {LINES_SQL} s" for c in LINE_NUMBERS)


@query(
    "describe_numeric",
    _summary_sql(
        "count({c}) AS count, round(avg({c}), 6) AS mean, round(quantile_cont({c}, 0.5), 6) AS median, round(stddev_samp({c}), 6) AS std, "
        "min({c}) AS min, max({c}) AS max, round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.75), 6) AS q3"
    ),
)
def describe_numeric(spark, sf):
    return rounded(profile.summary(sparse_lines(spark, sf)), ["mean", "median", "std", "q1", "q3"])


@query(
    "describe_long",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{s}' AS statistic, round({e.format(c=c)}, 6) AS value FROM {LINES_SQL} s"
        for c in LINE_NUMBERS
        for s, e in {
            "count": "count({c})::DOUBLE", "mean": "avg({c})", "std": "stddev_samp({c})", "min": "min({c})", "25%": "quantile_cont({c}, 0.25)",
            "50%": "quantile_cont({c}, 0.5)", "75%": "quantile_cont({c}, 0.75)", "max": "max({c})",
        }.items()
    ),
)
def describe_long(spark, sf):
    return rounded(profile.describe(sparse_lines(spark, sf)), ["value"])


SINGLE = {"mean": "avg({c})", "std": "stddev_samp({c})", "max": "max({c})", "median": "quantile_cont({c}, 0.5)", "q75": "quantile_cont({c}, 0.75)"}


@query(
    "single_statistics",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{s}' AS statistic, round({e.format(c=c)}, 6) AS value FROM {LINES_SQL} s" for c in LINE_NUMBERS for s, e in SINGLE.items()
    ),
)
def single_statistics(spark, sf):
    lines, out = sparse_lines(spark, sf), None
    for name in SINGLE:
        part = profile.statistic(lines, name)
        out = part if out is None else out.unionByName(part)
    return rounded(out, ["value"])


@query(
    "exact_quantiles",
    _summary_sql("round(quantile_cont({c}, 0.1), 6) AS p10, round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.99), 6) AS p99"),
)
def exact_quantiles_query(spark, sf):
    # the range-narrowing path, which does not hold a column's values in one place
    from benchloom.operators.quantiles import exact_quantiles

    found = exact_quantiles(sparse_lines(spark, sf), LINE_NUMBERS, [0.1, 0.5, 0.99], small_rows=0)
    rows = [(c, *[float(v) for v in vals]) for c, vals in found.items()]
    return rounded(spark.createDataFrame(rows, "column string, p10 double, p50 double, p99 double"), ["p10", "p50", "p99"])


@query(
    "series_stats",
    f"SELECT count(y) AS n, round(avg(y), 6) AS mean, quantile_cont(y, 0.5) AS median, round(stddev_pop(y), 6) AS std, min(y) AS min, max(y) AS max, "
    f"quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.75) AS q3, quantile_cont(y, 0.75) - quantile_cont(y, 0.25) AS iqr FROM {MONTHLY_SQL} s",
)
def series_stats(spark, sf):
    return rounded(profile.series_statistics(monthly_orders(spark, sf), "y"), ["mean", "std"])


@query("value_counts", f"SELECT lang AS value, count(*) AS n FROM {DOCS_SQL} s WHERE lang IS NOT NULL GROUP BY 1")
def value_counts(spark, sf):
    return profile.value_counts(labelled_documents(spark, sf), "lang")


@query(
    "value_counts_pct",
    f"SELECT quality AS value, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM documents), 6) AS pct "
    f"FROM {DOCS_SQL} s WHERE quality IS NOT NULL GROUP BY 1",
)
def value_counts_pct(spark, sf):
    return rounded(profile.value_counts_share(labelled_documents(spark, sf), "quality"), ["pct"])


@query("unique_values", f"SELECT quality AS value, count(*) AS n FROM {DOCS_SQL} s GROUP BY 1")
def unique_values(spark, sf):
    return profile.unique_values(labelled_documents(spark, sf), "quality")


@query("unique_values_legacy", f"SELECT quality AS value, count(quality) AS n FROM {DOCS_SQL} s GROUP BY 1")
def unique_values_legacy(spark, sf):
    return profile.unique_values(labelled_documents(spark, sf), "quality", legacy_null_zero=True)


@query(
    "class_distribution",
    "SELECT o_orderstatus AS class, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM orders), 6) AS share FROM orders GROUP BY 1",
)
def class_distribution(spark, sf):
    return rounded(profile.class_distribution(load(spark, sf, "orders"), "o_orderstatus"), ["share"])


@query(
    "default_target",
    "SELECT toxic AS class, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM labels), 6) AS share FROM labels GROUP BY 1",
)
def default_target(spark, sf):
    labels = load(spark, sf, "labels")
    _, target = split_target(labels)
    return rounded(profile.class_distribution(labels, target), ["share"])


@query(
    "imbalance_report",
    "WITH c AS (SELECT toxic, count(*) AS n FROM labels WHERE toxic IS NOT NULL GROUP BY 1), "
    "r AS (SELECT count(*) AS n_classes, sum(n)::BIGINT AS total, min(n) AS min_count, max(n) AS max_count, min(n)::DOUBLE / max(n) AS ratio FROM c) "
    "SELECT n_classes, total, min_count, max_count, round(ratio, 6) AS ratio, ratio < 0.3 AS is_imbalanced, "
    "CASE WHEN ratio < 0.1 THEN 'Alto' WHEN ratio < 0.3 THEN 'Moderado' ELSE 'Bajo' END AS severity, "
    "(SELECT string_agg(toxic || ':' || n, ',' ORDER BY toxic) FROM c) AS classes FROM r",
)
def imbalance_report(spark, sf):
    out = profile.check_imbalance(load(spark, sf, "labels"), "toxic")
    listed = F.array_join(F.transform("classes", lambda c: F.concat_ws(":", c["class"].cast("string"), c["n"].cast("string"))), ",")
    return rounded(out.withColumn("classes", listed), ["ratio"])


def _corr_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM {table} s" for a in cols for b in cols)


@query("correlation_long", _corr_sql(LINES_SQL, LINE_NUMBERS))
def correlation_long(spark, sf):
    return rounded(profile.correlations(sparse_lines(spark, sf)), ["r"])


PART_NUMBERS = ["p_partkey", "p_size", "p_retailprice"]


@query(
    "correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS \"column\", " + ", ".join(f"round(corr({a}, {b}), 6) AS {b}" for b in PART_NUMBERS) + " FROM part" for a in PART_NUMBERS
    ),
)
def correlation_matrix(spark, sf):
    return rounded(profile.correlation_matrix(load(spark, sf, "part")), PART_NUMBERS)


def _hist_sql(table: str, cols: list[str], digits: int = 6) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS \"column\", g.bin::INTEGER AS bin, round(a + g.bin * (b - a) / 30, {digits}) AS lo, round(a + (g.bin + 1) * (b - a) / 30, {digits}) AS hi, "
            f"coalesce(h.n, 0)::BIGINT AS n, round(coalesce(h.n, 0)::DOUBLE / (total * ((b - a) / 30)), 6) AS density "
            f"FROM (SELECT unnest(range(30)) AS bin) g CROSS JOIN (SELECT min({c})::DOUBLE AS a, max({c})::DOUBLE AS b, count({c}) AS total FROM {table} t) m "
            f"LEFT JOIN (SELECT least(floor(({c}::DOUBLE - a) / (b - a) * 30), 29)::INTEGER AS bin, count(*) AS n FROM {table} t, "
            f"(SELECT min({c})::DOUBLE AS a, max({c})::DOUBLE AS b FROM {table} t2) mm WHERE {c} IS NOT NULL GROUP BY 1) h ON h.bin = g.bin"
        )
    return " UNION ALL ".join(parts)


@query("histogram_30", _hist_sql(LINES_SQL, LINE_NUMBERS))
def histogram_30(spark, sf):
    return rounded(dist.histogram(sparse_lines(spark, sf)), ["lo", "hi", "density"])


def _kde_sql(table: str, c: str, clip: bool) -> str:
    margin = "0.0::DOUBLE" if clip else "3 * bw"
    return (
        f"WITH v AS (SELECT {c}::DOUBLE AS x, count(*) AS w FROM {table} t WHERE {c} IS NOT NULL GROUP BY 1), "
        f"m AS (SELECT count({c}) AS n, min({c})::DOUBLE AS a, max({c})::DOUBLE AS b, stddev_samp({c}) * pow(count({c})::DOUBLE, -0.2::DOUBLE) AS bw FROM {table} t), "
        f"g AS (SELECT i, a - {margin} + i * ((b - a) + 2 * {margin}) / 199 AS x, bw, n FROM m, (SELECT unnest(range(200))::INTEGER AS i) r) "
        f"SELECT '{c}' AS \"column\", g.i, round(g.x, 6) AS x, round(sum(v.w * exp(-0.5::DOUBLE * pow((g.x - v.x) / g.bw, 2))) / (g.n * g.bw * sqrt(2 * pi())), 8) AS density "
        f"FROM g CROSS JOIN v GROUP BY g.i, g.x, g.bw, g.n"
    )


@query("kde_grid", _kde_sql("events", "value", False))
def kde_grid(spark, sf):
    return rounded(rounded(dist.kde(load(spark, sf, "events"), ["value"]), ["x"]), ["density"], 8)


@query(
    "histogram_kde",
    f"SELECT \"column\", 'bar' AS kind, bin AS i, round((lo + hi) / 2, 6) AS x, density AS y FROM ({_hist_sql('events', ['value'], 12)}) h "
    f"UNION ALL SELECT \"column\", 'curve' AS kind, i, x, round(density, 6) AS y FROM ({_kde_sql('events', 'value', True)}) k",
)
def histogram_kde(spark, sf):
    return rounded(dist.histogram_with_kde(load(spark, sf, "events"), ["value"]), ["x", "y"])


def _box_sql(table: str, c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3, "
        f"min({c}) FILTER ({c} BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1))::DOUBLE AS whisker_lo, "
        f"max({c}) FILTER ({c} BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1))::DOUBLE AS whisker_hi, "
        f"count(*) FILTER ({c} < q1 - 1.5::DOUBLE * (q3 - q1) OR {c} > q3 + 1.5::DOUBLE * (q3 - q1)) AS n_outliers FROM {table} t, "
        f"(SELECT quantile_cont({c}, 0.25)::DOUBLE AS q1, quantile_cont({c}, 0.5)::DOUBLE AS med, quantile_cont({c}, 0.75)::DOUBLE AS q3 FROM {table} t2) f "
        f"GROUP BY q1, med, q3"
    )


@query("boxplot_summary", _box_sql("documents", "n_chars") + " UNION ALL " + _box_sql("documents", "doc_id"))
def boxplot_summary(spark, sf):
    return rounded(dist.box_plot(load(spark, sf, "documents"), ["n_chars", "doc_id"]), ["q1", "median", "q3"])


@query(
    "boxplot_outliers",
    "SELECT 'value' AS \"column\", event_id AS row_id, value FROM events, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events) f "
    "WHERE value < q1 - 1.5::DOUBLE * (q3 - q1) OR value > q3 + 1.5::DOUBLE * (q3 - q1)",
)
def boxplot_outliers(spark, sf):
    return dist.outliers(load(spark, sf, "events"), "event_id", ["value"])


@query(
    "pair_sample",
    "WITH s AS (SELECT * FROM part ORDER BY md5('42|scatter|' || p_partkey), p_partkey LIMIT 500) "
    "SELECT p_partkey AS row_id, 'p_size' AS a, 'p_retailprice' AS b, p_size::DOUBLE AS x, p_retailprice AS y FROM s",
)
def pair_sample(spark, sf):
    return dist.pair_scatter(load(spark, sf, "part"), "p_partkey")
