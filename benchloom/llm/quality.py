"""Quality rules: statistics of each text, and robust outliers among them. DataFrame functions only.

Statistics: words (what white space separates), their characters, symbols, repeated lines, and words in 5-word windows that
occur twice in the text. A text fails the base rule with fewer than 10 words or with more than a fifth of its words in
repeated windows.

The rest is judged by minimum-covariance-determinant estimates for each language and source. Five transformed
statistics (length, mean word length, shares of symbols and repeats, repeated lines) start from group medians;
concentration steps then take mean and covariance of the COVERED share of rows that lie nearest and measure all distances
anew. A row is rejected when its squared Mahalanobis distance exceeds CUTOFF. FLOOR is added to the variances, so that a
statistic that is constant in good text does not reject on a single symbol. A group with fewer than MIN_ROWS rows takes the
estimate of its language, a small language that of all rows; all three levels are estimated in the same pass.

Rows are reduced to a few numbers each before anything is shuffled, and all groups are aggregated with map-side combine,
so one source may hold any share of the rows.

Defined cases: a null or empty text has no words and fails; null language or source is a group like any other; repeated
rows count each; words in windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchloom.llm.common import quoted, scratch, written

P = 5
FEATURES = [f"x{i}" for i in range(P)]
COVERED = 0.75
#: Makes the covariance of the nearest 75 % consistent for normal rows: 0.75 / P(chi2 with P + 2 <= 75 % quantile of chi2 with P).
CONSISTENCY = 1.41
STEPS = 3
CUTOFF = 30.86  # quantile 0.99999 of chi2 with P degrees
FLOOR = (1.5, 0.015, 0.09, 0.25, 0.25)
MIN_ROWS = 30
BROADCAST_GROUPS = 20_000  # rows of estimates of a few hundred bytes


def statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """The base columns of each row."""
    t = F.coalesce(quoted(text), F.lit(""))
    out = docs.select(*[quoted(c) for c in keep], t.alias("__t"))
    out = out.withColumn("__w", F.filter(F.split("__t", "[ \\t-\\r]+"), lambda w: w != ""))
    lines = F.filter(F.split("__t", "\n"), lambda line: line.rlike("[^ \\t-\\r]"))
    out = out.select(
        *[quoted(c) for c in keep], F.size("__w").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "__w")).cast("long").alias("word_chars"),
        (F.length("__t") - F.length(F.translate("__t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        lines.alias("__l"), F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"),
    )
    window = F.transform(
        F.sequence(F.lit(0), F.size("__h") - 5),
        lambda i: F.struct(F.xxhash64(*[F.get("__h", i + k) for k in range(5)]).alias("h"), i.alias("i")),
    )
    out = out.withColumn("__s", F.when(F.size("__h") >= 5, F.sort_array(window)))
    twice = F.filter("__s", lambda x, k: (x["h"] == F.get("__s", k - 1)["h"]) | (x["h"] == F.get("__s", k + 1)["h"]))
    out = out.withColumn("__r", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.transform("__r", lambda x, k: F.least(F.lit(5), F.coalesce(F.get("__r", k + 1) - x, F.lit(5))))
    return out.select(
        *[quoted(c) for c in keep], "n_words", "word_chars", "n_symbols",
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long").alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def transformed() -> list[Column]:
    """Statistics on scales where good text is roughly normal."""
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return [
        F.log(n), F.log(chars / n), F.log1p(100 * F.col("n_symbols") / chars), F.log1p(20 * F.col("n_repeat_words") / n),
        F.log1p(F.col("n_dup_lines")),
    ]


def _distance(df: DataFrame) -> DataFrame:
    """Add d2, the squared distance to the mean m* under the lower triangle l* of the covariance's Cholesky form."""
    for i in range(P):
        known = F.lit(0.0)
        for j in range(i):
            known = known + F.col(f"l{i}{j}") * F.col(f"z{j}")
        df = df.withColumn(f"z{i}", (F.col(f"x{i}") - F.col(f"m{i}") - known) / F.col(f"l{i}{i}"))
    total = F.lit(0.0)
    for i in range(P):
        total = total + F.col(f"z{i}") * F.col(f"z{i}")
    return df.withColumn("d2", total).drop(*[f"z{i}" for i in range(P)])


def _cholesky(df: DataFrame) -> DataFrame:
    """l* from the covariance s*."""
    for i in range(P):
        for j in range(i + 1):
            rest = F.col(f"s{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            df = df.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    return df


KEYS = ("level", "g_lang", "g_source")


def _with(rows: DataFrame, groups: DataFrame, small: bool) -> DataFrame:
    """Join per-group rows by keys where null equals null."""
    other = groups.select(*[F.col(k).alias(f"__{k}") for k in KEYS], *[c for c in groups.columns if c not in KEYS])
    cond = None
    for k in KEYS:
        part = F.col(k).eqNullSafe(F.col(f"__{k}"))
        cond = part if cond is None else cond & part
    return rows.join(F.broadcast(other) if small else other, cond).drop(*[f"__{k}" for k in KEYS])


def estimates(stats: DataFrame, lang: str, source: str, path: str) -> tuple[DataFrame, bool]:
    """Mean, Cholesky factor and number of rows for each language and source, each language, and all rows."""
    none = F.lit(None).cast("string")
    key = lambda level, a, b: F.struct(F.lit(level).alias("level"), a.alias("g_lang"), b.alias("g_source"))
    lang_, source_ = quoted(lang).cast("string"), quoted(source).cast("string")
    rows = (
        stats.where(~F.col("base_failed")).select(*FEATURES, lang_.alias("a"), source_.alias("b"))
        .withColumn("k", F.explode(F.array(key(0, F.col("a"), F.col("b")), key(1, F.col("a"), none), key(2, none, none))))
        .select("k.*", *FEATURES)
    )
    middle = [F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"q{i}") for i, x in enumerate(FEATURES)]
    start = rows.groupBy(*KEYS).agg(F.count("*").alias("n_rows"), *middle)
    spread = {
        f"s{i}{j}": F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2) + FLOOR[i] if i == j else F.lit(0.0)
        for i in range(P) for j in range(i + 1)
    }
    current = start.select(*KEYS, "n_rows", *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(P)], *[v.alias(k) for k, v in spread.items()])
    current = written(_cholesky(current), f"{path}/estimate0")
    small = current.count() <= BROADCAST_GROUPS
    for step in range(1, STEPS + 1):
        measured = _distance(_with(rows, current, small)).select(*KEYS, *FEATURES, "d2")
        edge = measured.groupBy(*KEYS).agg(F.percentile_approx("d2", COVERED, 1000).alias("edge"))
        edge = written(edge, f"{path}/edge{step}")
        near = _with(measured, edge, small).where("d2 <= edge")
        sums = [F.avg(x).alias(f"m{i}") for i, x in enumerate(FEATURES)]
        sums += [F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"c{i}{j}") for i in range(P) for j in range(i + 1)]
        moments = _with(near.groupBy(*KEYS).agg(*sums), current.select(*KEYS, "n_rows"), small)
        cov = [
            (CONSISTENCY * F.col(f"c{i}{j}") + (FLOOR[i] if i == j else 0.0)).alias(f"s{i}{j}") for i in range(P) for j in range(i + 1)
        ]
        moments = moments.select(*KEYS, "n_rows", *[f"m{i}" for i in range(P)], *cov)
        current = written(_cholesky(moments), f"{path}/estimate{step}")
    return current, small


def judge(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source", workspace: str | None = None,
) -> DataFrame:
    """Per row: id, language, source, the base columns, base_failed, distance (squared) and kept.

    `workspace`: a shared folder that the caller removes when the result has been used.
    """
    path = workspace or scratch(docs.sparkSession)
    keep = tuple(dict.fromkeys((doc_id, lang, source)))
    stats = statistics(docs, text, keep)
    stats = written(stats.select("*", *[x.alias(f"x{i}") for i, x in enumerate(transformed())]), f"{path}/statistics")
    found, small = estimates(stats, lang, source, path)
    enough = found.select(*KEYS, (F.col("n_rows") >= MIN_ROWS).alias("enough"))
    a, b = quoted(lang).cast("string"), quoted(source).cast("string")
    at = stats.withColumns({"__a": a, "__b": b})
    for level in (0, 1):
        own = enough.where((F.col("level") == level) & F.col("enough")).select(
            F.col("g_lang").alias("__ga"), F.col("g_source").alias("__gb"), F.lit(True).alias(f"__has{level}")
        )
        cond = F.col("__a").eqNullSafe(F.col("__ga"))
        if level == 0:
            cond = cond & F.col("__b").eqNullSafe(F.col("__gb"))
        at = at.join(F.broadcast(own) if small else own, cond, "left").drop("__ga", "__gb")
    at = at.withColumn("level", F.when(F.col("__has0"), 0).when(F.col("__has1"), 1).otherwise(2))
    at = at.withColumn("g_lang", F.when(F.col("level") < 2, F.col("__a"))).withColumn("g_source", F.when(F.col("level") < 1, F.col("__b")))
    other = found.drop("n_rows").select(*[F.col(k).alias(f"__{k}") for k in KEYS], *[c for c in found.columns if c not in (*KEYS, "n_rows")])
    cond = F.col("level") == F.col("__level")
    for k in KEYS[1:]:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__{k}"))
    measured = _distance(at.join(F.broadcast(other) if small else other, cond, "left"))
    kept = ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= CUTOFF)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return measured.select(*[quoted(c) for c in keep], *base, F.col("d2").alias("distance"), kept.alias("kept"))
