"""Holt-Winters (triple exponential smoothing) for panels of series.

Candidate parameters are evaluated side by side as numpy vectors.  Series of at most ``stretch_rows`` counted rows are
one group each; longer ones are cut into stretches that run at the same time.

Without a multiplicative part the recursion is linear, and stretches join exactly (see ``smoothing_scan``): one pass over
the values for each round of the search, however many stretches there are.

With a multiplicative part every stretch starts from a guessed state, hands its final state to the next one, and the
stretches whose start changed run again until nothing changes.  With a multiplicative season, level times c and season over c
is the same model: that direction is never forgotten, so states are handed over with mean season 1 and the factors are
multiplied up afterwards.  The rest of the state is forgotten geometrically, so few passes do where stretches are longer than
that memory; and since the first stretch is right from the beginning, the result is that of the plain recursion in any case.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from benchloom.models.panel import STRETCH_ROWS, packed_stretches, split_by_length
from benchloom.models.smoothing_scan import follow, scan_numbers
from benchloom.operators.ordering import BROADCAST_ROWS, positions
from benchloom.session import checkpointed, fan_out

FORMS = ("add", "mul", None)
# Fixed value: the order in which calibration tries (trend, seasonal); the first of equals wins.
CALIBRATION = (("add", "add"), ("add", "mul"), ("mul", "add"), ("mul", "mul"))
ROUNDS = 6
POINTS = 5
SHRINK = 0.45
SETTLED = 1e-12  # relative change of a handed-over state that counts as none


class Recursion:
    """State of one series under a vector of (alpha, beta, gamma) candidates."""

    def __init__(self, params: np.ndarray, trend: str | None, seasonal: str | None, m: int):
        self.a, self.b, self.g = params[:, 0], params[:, 1], params[:, 2]
        self.trend, self.seasonal, self.m = trend, seasonal, m if seasonal else 1
        self.head: list[float] = []  # the first two seasons, until the start values are known
        self.ready = False
        self.n, self.sse, self.pos = 0, np.zeros(len(params)), 0

    @property
    def needed(self) -> int:
        return 2 * self.m

    def _start(self) -> None:
        y, m, c = np.array(self.head, dtype=float), self.m, len(self.a)
        first, second = y[:m].mean(), y[m : 2 * m].mean()
        self.level = np.full(c, first)
        slope = (second / first) ** (1.0 / m) if self.trend == "mul" else (second - first) / m
        self.slope = np.full(c, slope if self.trend else 0.0)
        season = {None: np.zeros(m), "add": y[:m] - first, "mul": y[:m] / first}[self.seasonal]
        self.season = [np.full(c, s) for s in season]
        self.ready = True

    def feed(self, values: np.ndarray) -> None:
        with np.errstate(all="ignore"):
            if not self.ready:
                take = self.needed - len(self.head)
                self.head += list(values[:take])
                values = values[take:]
                if len(self.head) < self.needed:
                    return
                self._start()
                self._run(self.head)
            self._run(values)

    def _run(self, values: Sequence[float]) -> None:
        level, slope, season, pos = self.level, self.slope, self.season, self.pos
        a, b, g, m = self.a, self.b, self.g, self.m
        for y in values:
            old = season[pos]
            base = level * slope if self.trend == "mul" else level + slope
            if self.seasonal == "mul":
                error, clean = y - base * old, y / old
            else:
                error, clean = y - base - old, y - old
            self.sse = self.sse + error * error
            new = a * clean + (1 - a) * base
            if self.trend == "add":
                slope = b * (new - level) + (1 - b) * slope
            elif self.trend == "mul":
                slope = b * (new / level) + (1 - b) * slope
            if self.seasonal == "add":
                season[pos] = g * (y - base) + (1 - g) * old
            elif self.seasonal == "mul":
                season[pos] = g * (y / base) + (1 - g) * old
            level = new
            pos = pos + 1 if pos + 1 < m else 0
        self.level, self.slope, self.pos = level, slope, pos
        self.n += len(values)

    def dump(self) -> np.ndarray:
        return np.concatenate([self.level, self.slope, *self.season])

    def load(self, state: np.ndarray) -> None:
        """Take over a state; the next value is the first of a season."""
        level, slope, *season = np.asarray(state, dtype=float).reshape(self.m + 2, -1)
        self.level, self.slope, self.season, self.pos, self.ready = level, slope, list(season), 0, True

    def result(self, i: int) -> dict:
        """State of candidate i; the season starts with the next step's value."""
        season = [float(self.season[(self.pos + j) % self.m][i]) for j in range(self.m)]
        return {
            "n": self.n, "sse": float(self.sse[i]), "alpha": float(self.a[i]), "beta": float(self.b[i]), "gamma": float(self.g[i]),
            "level": float(self.level[i]), "slope": float(self.slope[i]), "season": season,
        }


STATE_SCHEMA = (
    "key string, trend string, seasonal string, n bigint, sse double, alpha double, beta double, gamma double, "
    "level double, slope double, season array<double>, error string"
)


def _candidates(center: Sequence[float], width: float) -> np.ndarray:
    if width == 0:
        return np.array([center], dtype=float)
    steps = np.linspace(-width, width, POINTS)
    grid = np.array(list(product(steps, steps, steps))) + np.asarray(center, dtype=float)
    return np.clip(grid, 1e-4, 1.0 - 1e-4)


def _best(run: Recursion) -> int | None:
    usable = np.isfinite(run.sse) & np.isfinite(run.level) & np.isfinite(run.slope)
    return int(np.argmin(np.where(usable, run.sse, np.inf))) if usable.any() else None


def _row(key, trend, seasonal, run: Recursion, i: int | None) -> dict:
    base = {"key": key, "trend": trend, "seasonal": seasonal}
    if not run.ready:
        return {**base, "error": f"needs at least {run.needed} values, has {len(run.head)}"}
    if i is None:
        return {**base, "error": "no parameters give a finite fit"}
    return {**base, **run.result(i), "error": None}


def _frame(rows: list[dict]) -> pd.DataFrame:
    names = [f.split()[0] for f in STATE_SCHEMA.split(", ")]
    return pd.DataFrame([{c: r.get(c) for c in names} for r in rows]).astype({"n": "Int64"})


def _config_of(forms: Sequence[tuple]):
    """The number of a row's (trend, seasonal) among the forms, -1 if it is none of them."""
    config = F.lit(-1)
    for i, (tr, se) in enumerate(forms):
        config = F.when(F.col("trend").eqNullSafe(F.lit(tr)) & F.col("seasonal").eqNullSafe(F.lit(se)), i).otherwise(config)
    return config


def _with_forms(train: DataFrame, forms: Sequence[tuple], choice: DataFrame | None) -> DataFrame:
    """Copies of the series, one for each configuration, or the chosen one (key, trend, seasonal) only: (key, config, t, y)."""
    if choice is None:
        return train.select("key", F.explode(F.array(*[F.lit(i) for i in range(len(forms))])).alias("config"), "t", "y")
    return train.join(choice.select("key", _config_of(forms).alias("config")), "key").select("key", "config", "t", "y")


def _search(pdf: pd.DataFrame, forms: Sequence[tuple], m: int, center: Sequence[float], width: float, rounds: int) -> dict:
    """Best state of one series under one configuration, the grid closing in on the best point round by round."""
    pdf = pdf.sort_values("t")
    key, form, y = pdf["key"].iloc[0], forms[int(pdf["config"].iloc[0])], pdf["y"].to_numpy()
    best, run = None, None
    for _ in range(rounds):
        run = Recursion(_candidates(center, width), *form, m)
        run.feed(y)
        i = _best(run) if run.ready else None
        if i is None:
            break
        if best is None or run.sse[i] < best[0].sse[best[1]]:
            best = (run, i)
        b, j = best
        center, width = [b.a[j], b.b[j], b.g[j]], width * SHRINK
    return _row(key, *form, *(best if best else (run, None)))


def _grouped(
    train: DataFrame, forms: Sequence[tuple], m: int, center: Sequence[float], width: float, rounds: int, choice: DataFrame | None,
) -> DataFrame:
    rows = _with_forms(train, forms, choice)
    spread = rows.repartition(fan_out(rows.sparkSession), "key", "config")
    return spread.groupBy("key", "config").applyInPandas(
        lambda pdf: _frame([_search(pdf, forms, m, center, width, rounds)]), STATE_SCHEMA
    )


# ------------------------------------------------------------------ long series

PASS_SCHEMA = "key string, config int, chunk bigint, n bigint, sse array<double>, state array<double>, scale array<double>"
_AT = ["key", "config", "chunk"]


def _level_out(state: np.ndarray, trend: str | None, seasonal: str | None, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(the state with mean season 1, logarithm of the factor that its level took); as it is without a multiplicative season."""
    level, slope, season = (x := np.asarray(state, dtype=float).reshape(size + 2, -1).copy())[0], x[1], x[2:]
    if seasonal != "mul":
        return x.reshape(-1), np.zeros(x.shape[1])
    with np.errstate(all="ignore"):
        factor = season.mean(axis=0)
        factor = np.where(np.isfinite(factor) & (factor > 0), factor, 1.0)
        level *= factor
        if trend == "add":
            slope *= factor
        season /= factor
        return x.reshape(-1), np.log(factor)


def _starts(first: DataFrame, forms: Sequence[tuple], m: int, copies: int) -> DataFrame:
    """(key, config, state): the start values from the first two seasons, for each of ``copies`` candidates."""

    def start(pdf: pd.DataFrame) -> pd.DataFrame:
        run = Recursion(np.full((copies, 3), 0.5), *forms[int(pdf["config"].iloc[0])], m)
        run.head = list(pdf.sort_values("t")["y"].to_numpy()[: run.needed])
        with np.errstate(all="ignore"):
            run._start()
        state, scale = _level_out(run.dump(), run.trend, run.seasonal, run.m)
        return pd.DataFrame([{"key": pdf["key"].iloc[0], "config": int(pdf["config"].iloc[0]), "state": state, "scale": scale}])

    return first.groupBy("key", "config").applyInPandas(start, "key string, config int, state array<double>, scale array<double>")


def _one_round(chunked: DataFrame, starts: DataFrame, centers: DataFrame, forms: Sequence[tuple], m: int, width: float) -> DataFrame:
    """Best candidate around the centers (key, config, ca, cb, cg), the stretches of a series run in parallel."""
    spark = chunked.sparkSession
    parts = fan_out(spark)

    def step(pdf: pd.DataFrame, init: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or init.empty:
            return pd.DataFrame({c: [] for c in ("key", "config", "chunk", "n", "sse", "state", "scale")}, dtype=object)
        at, config = init.iloc[0], int(init["config"].iloc[0])
        run = Recursion(_candidates([at["ca"], at["cb"], at["cg"]], width), *forms[config], m)
        run.load(at["state"])
        with np.errstate(all="ignore"):
            run._run(pdf.sort_values("t")["y"].to_numpy())
        state, scale = run.dump(), np.zeros(len(run.a))
        if run.pos == 0:  # what follows begins a season; the last stretch may end within one
            state, scale = _level_out(state, run.trend, run.seasonal, run.m)
        return pd.DataFrame([{
            "key": at["key"], "config": config, "chunk": at["chunk"], "n": run.n, "sse": run.sse, "state": state, "scale": scale,
        }])

    def run_pass(init: DataFrame) -> DataFrame:
        seeded = init.join(centers, ["key", "config"]).repartition(parts, *_AT)
        # only rows of stretches that have to run (again) travel
        rows = chunked.join(init.select(*_AT), _AT, "left_semi").repartition(parts, *_AT)
        return checkpointed(rows.groupBy(*_AT).cogroup(seeded.groupBy(*_AT)).applyInPandas(step, PASS_SCHEMA))

    last = chunked.groupBy("key", "config").agg(F.max("chunk").alias("last"))
    init = checkpointed(
        starts.join(last, ["key", "config"]).select("key", "config", F.explode(F.sequence(F.lit(0).cast("bigint"), "last")).alias("chunk"), "state")
    )
    done = run_pass(init)
    while True:
        handed = done.select("key", "config", (F.col("chunk") + 1).alias("chunk"), F.col("state").alias("new"))
        gap = F.zip_with("state", "new", lambda a, b: F.coalesce(F.nanvl(F.abs(a - b) / (1.0 + F.abs(b)), F.lit(0.0)), F.lit(0.0)))
        moved = init.join(handed, _AT).filter(F.array_max(gap) > SETTLED).select(*_AT, F.col("new").alias("state"))
        moved = checkpointed(moved)
        if moved.isEmpty():
            break
        init = checkpointed(init.join(moved.select(*_AT), _AT, "left_anti").unionByName(moved))
        done = checkpointed(done.join(moved.select(*_AT), _AT, "left_anti").unionByName(run_pass(moved)))
    errors = done.select("key", "config", F.posexplode("sse").alias("i", "e")).groupBy("key", "config", "i").agg(F.sum("e").alias("e"))
    finite = F.when(~F.isnan("e") & (F.abs("e") < float("inf")), F.col("e")).otherwise(float("inf"))
    best = errors.groupBy("key", "config").agg(F.min(F.struct(finite.alias("e"), "i")).alias("b"))
    sizes = done.groupBy("key", "config").agg(F.sum("n").alias("total"), F.max_by("state", "chunk").alias("state"))
    scales = done.select("key", "config", "scale").unionByName(starts.select("key", "config", "scale"))
    scales = scales.select("key", "config", F.posexplode("scale").alias("i", "s")).groupBy("key", "config", "i").agg(F.sum("s").alias("s"))
    best = best.join(scales.select("key", "config", F.col("i").alias("_i"), F.col("s").alias("scale")), ["key", "config"]).filter(F.col("_i") == F.col("b.i"))
    final = best.drop("_i").join(sizes, ["key", "config"]).join(centers, ["key", "config"])

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.to_dict("records"):
                trend, seasonal = forms[r["config"]]
                i, size = r["b"]["i"], m if seasonal else 1
                base = {"key": r["key"], "trend": trend, "seasonal": seasonal, "error": None}
                if not np.isfinite(r["b"]["e"]):
                    yield _frame([{**base, "error": "no parameters give a finite fit"}])
                    continue
                level, slope, *season = np.asarray(r["state"], dtype=float).reshape(size + 2, -1)[:, i]
                factor = float(np.exp(r["scale"])) if seasonal == "mul" else 1.0
                level, slope, season = level / factor, slope / factor if trend == "add" else slope, [v * factor for v in season]
                alpha, beta, gamma = _candidates([r["ca"], r["cb"], r["cg"]], width)[i]
                turn = int(r["total"]) % size
                yield _frame([{
                    **base, "n": r["total"], "sse": r["b"]["e"], "alpha": alpha, "beta": beta, "gamma": gamma,
                    "level": level, "slope": slope, "season": season[turn:] + season[:turn],
                }])

    return checkpointed(final.mapInPandas(finish, STATE_SCHEMA))


def _iterated(
    train: DataFrame, forms: Sequence[tuple], m: int, center: Sequence[float], width: float, rounds: int, rows: int, choice: DataFrame | None,
) -> DataFrame:
    """Forms with a multiplicative part: (key, config, state columns) of long series."""
    length = max(2 * m, rows - rows % m)  # whole seasons, so that every stretch starts one
    numbered = checkpointed(positions(train, ["key"], ["t"], "_pos", rows).select("key", F.col("_pos").alias("t"), "y"))
    tall = _with_forms(numbered, forms, choice).withColumn("chunk", F.floor((F.col("t") - 1) / length))
    centers = checkpointed(tall.select("key", "config").distinct()).withColumns(
        {c: F.lit(float(v)) for c, v in zip(("ca", "cb", "cg"), center, strict=True)}
    )
    starts = checkpointed(_starts(tall.filter(F.col("t") <= 2 * m), forms, m, len(_candidates(center, width))))
    return _rounds(lambda centers, width: _one_round(tall, starts, centers, forms, m, width), centers, forms, width, rounds)


def _scanned(
    train: DataFrame, forms: Sequence[tuple], m: int, center: Sequence[float], width: float, rounds: int, rows: int, choice: DataFrame | None,
) -> DataFrame:
    """Additive forms: one pass over the packed stretches for each round."""
    length = max(2 * m, rows - rows % m)
    packed = packed_stretches(train, 0, length)
    first = packed.filter(F.col("chunk") == 0).select("key", F.posexplode(F.slice("y", 1, 2 * m)).alias("t", "y"))
    starts = checkpointed(_starts(_with_forms(first, forms, choice), forms, m, 1).drop("scale"))
    centers = starts.select("key", "config").withColumns({c: F.lit(float(v)) for c, v in zip(("ca", "cb", "cg"), center, strict=True)})
    return _rounds(lambda centers, width: _one_scan(packed, starts, centers, forms, m, width), centers, forms, width, rounds)


SCAN_SCHEMA = "key string, config int, chunk bigint, n bigint, ca double, cb double, cg double, state array<double>, numbers array<double>"


def _one_scan(packed: DataFrame, starts: DataFrame, centers: DataFrame, forms: Sequence[tuple], m: int, width: float) -> DataFrame:
    """Best candidate around the centers (key, config, ca, cb, cg), from the joined forms of all stretches."""
    known = ["config", "ca", "cb", "cg", "state"]
    asked = starts.join(centers, ["key", "config"]).groupBy("key").agg(F.collect_list(F.struct(*known)).alias("s"))
    asked = asked.select("key", *[F.col(f"s.{c}").alias(c) for c in known])  # a row for each form
    asked = checkpointed(asked)
    asked = F.broadcast(asked) if asked.count() <= BROADCAST_ROWS else asked

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                y, rows = np.asarray(r.y, dtype=float), []
                for config, ca, cb, cg, state in zip(r.config, r.ca, r.cb, r.cg, r.state, strict=True):
                    # a constant taken off all values only shifts the level
                    numbers = scan_numbers(y - state[0], _candidates([ca, cb, cg], width), *forms[config], m)
                    rows.append({
                        "key": r.key, "config": config, "chunk": r.chunk, "n": len(y), "ca": ca, "cb": cb, "cg": cg, "state": state,
                        "numbers": numbers.reshape(-1),
                    })
                yield pd.DataFrame(rows)

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = list(pdf.sort_values("chunk").itertuples())
        at, total = rows[0], int(pdf["n"].sum())
        trend, seasonal = forms[int(at.config)]
        params, size = _candidates([at.ca, at.cb, at.cg], width), m if seasonal else 1
        start = np.array(at.state, dtype=float)
        shift, start[0] = start[0], 0.0
        numbers = [np.asarray(r.numbers).reshape(len(params), -1) for r in rows]
        states, sse = follow(start, numbers, [r.n for r in rows], params, trend, seasonal, m)
        base = {"key": at.key, "trend": trend, "seasonal": seasonal, "error": None}
        usable = np.isfinite(sse) & np.isfinite(states).all(axis=1)
        if not usable.any():
            return _frame([{**base, "error": "no parameters give a finite fit"}])
        i, turn = int(np.argmin(np.where(usable, sse, np.inf))), total % size
        level, slope, *season = states[i].tolist()
        return _frame([{
            **base, "n": total, "sse": float(sse[i]), "level": level + shift, "slope": slope, "season": season[turn:] + season[:turn],
            **dict(zip(("alpha", "beta", "gamma"), params[i].tolist(), strict=True)),
        }])

    numbers = packed.join(asked, "key").mapInPandas(scan, SCAN_SCHEMA)
    spread = numbers.repartition(fan_out(packed.sparkSession), "key", "config")
    return checkpointed(spread.groupBy("key", "config").applyInPandas(best, STATE_SCHEMA))


def _rounds(one_round, centers: DataFrame, forms: Sequence[tuple], width: float, rounds: int) -> DataFrame:
    """The best state of all rounds, the grid closing in on the best point of each series and form."""
    best = None
    for _ in range(rounds):
        found = one_round(centers, width)
        both = found if best is None else best.unionByName(found)
        pick = F.min_by(F.struct(*[F.col(c) for c in found.columns]), F.coalesce("sse", F.lit(float("inf"))))
        best = checkpointed(both.groupBy("key", "trend", "seasonal").agg(pick.alias("s")).select("s.*"))
        centers = best.filter(F.col("error").isNull()).select(
            "key", _config_of(forms).alias("config"), F.col("alpha").alias("ca"), F.col("beta").alias("cb"), F.col("gamma").alias("cg")
        )
        width *= SHRINK
    return best


def _states(
    train: DataFrame, forms: Sequence[tuple], m: int, center: Sequence[float], width: float, rounds: int, stretch_rows: int,
    choice: DataFrame | None = None,
) -> DataFrame:
    """Fitted states of all forms, or of the chosen one (key, trend, seasonal) of each series."""
    stretch_rows = max(stretch_rows, 2 * m)
    short, _, long = split_by_length(train, stretch_rows)
    out = _grouped(short, forms, m, center, width, rounds, choice)
    if long is None:
        return out
    for run, own in ((_scanned, [f for f in forms if "mul" not in f]), (_iterated, [f for f in forms if "mul" in f])):
        if own:
            picked = None if choice is None else choice.filter(_config_of(own) >= 0)
            out = out.unionByName(run(long, own, m, center, width, rounds, stretch_rows, picked))
    return out


def holt_winters_fixed(
    train: DataFrame, alpha: float, beta: float, gamma: float, trend: str | None = "add", seasonal: str | None = "add", m: int = 12,
    stretch_rows: int = STRETCH_ROWS,
) -> DataFrame:
    """Final state per key for given parameters (see STATE_SCHEMA)."""
    return _states(train, [(trend, seasonal)], m, [alpha, beta, gamma], 0.0, 1, stretch_rows)


def fit_states(
    train: DataFrame, forms: Sequence[tuple], m: int, stretch_rows: int = STRETCH_ROWS, choice: DataFrame | None = None,
) -> DataFrame:
    """Fitted state per (key, trend, seasonal): least squared one-step error over alpha, beta, gamma.

    `choice` (key, trend, seasonal): fit this one of the forms for each series, and only series that it names.
    """
    return _states(train, list(forms), m, [0.5, 0.5, 0.5], 0.49, ROUNDS, stretch_rows, choice)


def forecast_states(states: DataFrame, steps: int) -> DataFrame:
    """(key, trend, seasonal, step, yhat) from fitted states."""
    ok = states.filter(F.col("error").isNull())
    h = F.col("step")
    season = F.element_at("season", (h - 1) % F.size("season") + 1)
    base = (
        F.when(F.col("trend") == "mul", F.col("level") * F.pow("slope", h))
        .when(F.col("trend") == "add", F.col("level") + h * F.col("slope"))
        .otherwise(F.col("level"))
    )
    value = F.when(F.col("seasonal") == "mul", base * season).when(F.col("seasonal") == "add", base + season).otherwise(base)
    out = ok.select("*", F.explode(F.sequence(F.lit(1), F.lit(int(steps)))).alias("step"))
    return out.select("key", "trend", "seasonal", "step", value.alias("yhat"))


class HoltWinters:
    """Series model with one configuration."""

    def __init__(self, seasonal_periods: int = 12, trend: str | None = "add", seasonal: str | None = "add", stretch_rows: int = STRETCH_ROWS):
        if trend not in FORMS or seasonal not in FORMS:
            raise ValueError("trend and seasonal are 'add', 'mul' or None")
        self.m, self.trend, self.seasonal, self.stretch_rows = seasonal_periods, trend, seasonal, stretch_rows
        self.states: DataFrame | None = None

    def fit(self, train: DataFrame) -> "HoltWinters":
        out = type(self)(self.m, self.trend, self.seasonal, self.stretch_rows)
        out.states = fit_states(train, [(self.trend, self.seasonal)], self.m, self.stretch_rows)
        return out

    def forecast(self, steps: int) -> DataFrame:
        return forecast_states(self.states, steps).select("key", "step", "yhat")


def calibrate(train: DataFrame, m: int, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """(key, trend, seasonal, mse): the configuration with the least error on each series' last m values."""
    sizes = train.groupBy("key").agg(F.count("*").alias("_n"))
    pos = positions(train, ["key"], ["t"], "pos").join(sizes, "key")
    head = pos.filter(F.col("pos") <= F.col("_n") - m).select("key", "t", "y")
    tail = pos.filter(F.col("pos") > F.col("_n") - m).select("key", (F.col("pos") - F.col("_n") + m).cast("int").alias("step"), "y")
    predicted = forecast_states(fit_states(head, CALIBRATION, m, stretch_rows), m)
    scored = (
        predicted.join(tail, ["key", "step"]).groupBy("key", "trend", "seasonal")
        .agg(F.avg(F.pow(F.col("y") - F.col("yhat"), 2)).alias("mse")).filter(~F.isnan("mse"))
    )
    order = F.lit(len(CALIBRATION))
    for i, (tr, se) in enumerate(CALIBRATION):
        order = F.when((F.col("trend") == tr) & (F.col("seasonal") == se), i).otherwise(order)
    best = scored.groupBy("key").agg(F.min(F.struct(F.col("mse"), order.alias("order"), "trend", "seasonal")).alias("b"))
    return best.select("key", "b.trend", "b.seasonal", "b.mse")


class HoltWintersCalibrated:
    """Series model that picks the configuration on the last season, then refits on all values."""

    def __init__(self, seasonal_periods: int = 12, stretch_rows: int = STRETCH_ROWS):
        self.m, self.stretch_rows = seasonal_periods, stretch_rows
        self.states: DataFrame | None = None
        self.choice: DataFrame | None = None

    def fit(self, train: DataFrame) -> "HoltWintersCalibrated":
        out = type(self)(self.m, self.stretch_rows)
        out.choice = calibrate(train, self.m, self.stretch_rows)
        out.choice = checkpointed(out.choice)
        out.states = fit_states(train, CALIBRATION, self.m, self.stretch_rows, out.choice)
        return out

    def forecast(self, steps: int) -> DataFrame:
        return forecast_states(self.states, steps).select("key", "step", "yhat")
