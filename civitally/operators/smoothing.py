"""Exponential smoothing of many monthly series at once.

Model: multiplicative error, damped additive trend, multiplicative or additive season of
12 months, in the state-space form of Hyndman et al. (2008). Spark shuffles the training
rows by series and set-up; each group is one short series (months, not rows) and is fitted
in its task by trying every parameter combination of a grid at once with numpy, with simple
initial states; ``refine`` goes on from the best one and moves the initial states as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendars as cal
from ..functions import fixed_values as fv

SEASON = 12
MIN_MONTHS = 2 * SEASON
PATHS = 1000
ALPHAS = (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7)
BETAS = (0.0001, 0.01, 0.05, 0.1, 0.2)
GAMMAS = (0.0001, 0.05, 0.1, 0.2, 0.4)
PHIS = (0.8, 0.86, 0.92, 0.98)
#: Of the search from the best grid point: the least alpha, beta and gamma, and the steps at most.
LOWEST, MOST_STEPS = 0.0001, 400

SETUP = ("series", "train_start", "seasonal")
_SCHEMA = (
    "series string, train_start string, seasonal string, month_idx int, predicted double, "
    "lower double, upper double, alpha double, beta double, gamma double, phi double, "
    "objective double, sigma double"
)


def parameter_grid() -> list[tuple[float, float, float, float]]:
    """Combinations inside the usual region: beta < alpha and gamma <= 1 - alpha."""
    return [p for p in product(ALPHAS, BETAS, GAMMAS, PHIS) if p[1] < p[0] and p[2] <= 1 - p[0]]


def with_setups(
    series: DataFrame, starts: Sequence[str | None] = fv.TRAIN_STARTS,
    seasonals: Sequence[str] = fv.SEASONAL_TYPES,
) -> DataFrame:
    """Repeat every series for each training start and season type.

    A start of None means the first month of the data.
    """
    first = series.agg(F.min("month_idx").alias("first")).scalar()
    setups = F.array_distinct(F.array(*[
        F.struct(
            (first if start is None else F.lit(cal.index_of(start))).cast("int").alias("start"),
            F.lit(seasonal).alias("seasonal"),
        )
        for start, seasonal in product(starts, seasonals)
    ]))
    rows = series.withColumn("_setup", F.explode(setups))
    return rows.filter(F.col("month_idx") >= F.col("_setup.start")).select(
        "series",
        cal.label_of(F.col("_setup.start")).alias("train_start"),
        F.col("_setup.seasonal").alias("seasonal"),
        "month_idx",
        "value",
    )


def ets_forecast(
    train: DataFrame, horizon: int = fv.HORIZON, *, interval: float | None = 0.8,
    refine: int = 0, seed: int = 0,
) -> DataFrame:
    """Forecast ``horizon`` months after each training series.

    ``train`` comes from ``with_setups``. Series shorter than two seasons or with a value
    of 0 or below cannot be fitted and have no rows. ``interval=None`` leaves the bounds
    NULL; ``refine`` is the number of times the moves of the search are halved (0: the grid alone).
    """
    grid = np.array(parameter_grid())
    # Made here: workers get the numbers and need no cache of their own.
    draws = None if interval is None else _draws(seed, PATHS, horizon)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("month_idx")
        y = pdf["value"].to_numpy(dtype="float64")
        if len(y) < MIN_MONTHS or (y <= 0).any():
            return pd.DataFrame(columns=[c.split()[0] for c in _SCHEMA.split(", ")])
        seasonal = pdf["seasonal"].iloc[0]
        best = _best_point(y, grid, seasonal, refine)
        params, objective, sigma, state = best
        months = int(pdf["month_idx"].iloc[-1]) + np.arange(1, horizon + 1)
        lower = upper = np.full(horizon, np.nan)
        if interval is not None:
            shocks = sigma * draws
            paths = _continue(state, params, seasonal, horizon, shocks)
            tail = (1 - interval) / 2
            lower, upper = np.quantile(paths, [tail, 1 - tail], axis=1)
        point = _continue(state, params, seasonal, horizon, np.zeros((1, horizon)))[:, 0]
        head = {name: pdf[name].iloc[0] for name in SETUP}
        return pd.DataFrame({
            **head, "month_idx": months, "predicted": point, "lower": lower, "upper": upper,
            "alpha": params[0], "beta": params[1], "gamma": params[2], "phi": params[3],
            "objective": objective, "sigma": sigma,
        })

    spark = train.sparkSession
    # A fixed number keeps AQE from merging these small but compute-heavy partitions.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return train.repartition(tasks, *SETUP).groupBy(*SETUP).applyInPandas(fit, _SCHEMA)


def _best_point(y: np.ndarray, grid: np.ndarray, seasonal: str, refine: int):
    """Parameters, objective, sigma and last state of the best grid point, improved by ``_search``."""
    objective, _, _ = _filter(y, grid, _simple_start(y, seasonal, len(grid)), seasonal)
    i = int(np.argmin(objective))
    point = np.concatenate([grid[i], _simple_start(y, seasonal, 1)[:, 0]])
    if refine:
        point = _search(y, point, seasonal, refine)
    objective, sigma, (level, trend, season) = _filter(y, point[None, :4], point[4:, None], seasonal)
    return point[:4], float(objective[0]), float(sigma[0]), (level[0], trend[0], season[:, 0])


def _simple_start(y: np.ndarray, seasonal: str, count: int) -> np.ndarray:
    """Level, trend and season from the first two years, one column for each of ``count`` points."""
    first, second = y[:SEASON].mean(), y[SEASON:2 * SEASON].mean()
    season = y[:SEASON] / first if seasonal == "mul" else y[:SEASON] - first
    return np.repeat(np.concatenate([[first, (second - first) / SEASON], season])[:, None], count, axis=1)


def _search(y: np.ndarray, point: np.ndarray, seasonal: str, rounds: int) -> np.ndarray:
    """Descend from ``point`` (parameters, level, trend, season), all moves of a step tried at once.

    A step tries each coordinate both ways, then the improving moves together, best first. Without
    an improvement the moves are halved, ``rounds`` times. Parameters stay in the usual region (LOWEST, PHIS,
    beta < alpha, gamma <= 1 - alpha), not in the grid; the result is never worse than the start.
    """
    size = y[:SEASON].mean()
    moves = np.concatenate([[0.1, 0.05, 0.1, 0.05, 0.05 * size, 0.005 * size],
                            np.full(SEASON, 0.05 if seasonal == "mul" else 0.05 * size)])

    def judged(points: np.ndarray) -> np.ndarray:
        objective, _, _ = _filter(y, points[:, :4], points[:, 4:].T, seasonal)
        alpha, beta, gamma, phi = points[:, :4].T
        inside = (points[:, :3] >= LOWEST).all(axis=1) & (alpha <= 1 - LOWEST) & (beta < alpha) & (
            gamma <= 1 - alpha) & (phi >= PHIS[0]) & (phi <= PHIS[-1])
        return np.where(inside, objective, np.inf)

    best, steps = judged(point[None])[0], 0
    while rounds and steps < MOST_STEPS:
        steps += 1
        single = np.concatenate([np.diag(moves), -np.diag(moves)])
        found = judged(point + single)
        gains = np.argsort(found, kind="stable")[:np.count_nonzero(found < best)]
        if not len(gains):
            rounds, moves = rounds - 1, moves / 2
            continue
        together = point + np.cumsum(single[gains], axis=0)
        both = judged(together)
        k = int(np.argmin(both))
        point, best = (together[k], both[k]) if both[k] < found[gains[0]] else (point + single[gains[0]], found[gains[0]])
    return point


def _filter(y: np.ndarray, points: np.ndarray, start: np.ndarray, seasonal: str):
    """Run the recursion over the training months for every parameter point and its start at once."""
    alpha, beta, gamma, phi = points.T
    level, trend, season = start[0].copy(), start[1].copy(), start[2:].copy()
    squares = np.zeros(len(points))
    logs = np.zeros(len(points))
    with np.errstate(all="ignore"):
        for t, value in enumerate(y):
            slot = t % SEASON
            mean, update = _mean(level, trend, season[slot], phi, seasonal)
            error = value / mean - 1
            squares += error ** 2
            logs += np.log(np.where(mean > 0, mean, np.nan))
            level, trend, season[slot] = update(alpha, beta, gamma, error)
        objective = len(y) * np.log(squares) + 2 * logs
    objective = np.where(np.isfinite(objective), objective, np.inf)
    # Turn the season so that its first entry belongs to the month after training.
    season = np.roll(season, -(len(y) % SEASON), axis=0)
    return objective, np.sqrt(squares / len(y)), (level, trend, season)


def _mean(level, trend, season, phi, seasonal):
    """One-step mean and the state update that follows a relative error."""
    base = level + phi * trend
    if seasonal == "mul":
        mean = base * season

        def update(alpha, beta, gamma, error):
            return (base * (1 + alpha * error), phi * trend + beta * base * error,
                    season * (1 + gamma * error))
    else:
        mean = base + season

        def update(alpha, beta, gamma, error):
            return (base + alpha * mean * error, phi * trend + beta * mean * error,
                    season + gamma * mean * error)
    return mean, update


def _continue(state, params, seasonal, horizon, shocks):
    """Values of each path over the horizon; zero shocks give the point forecast."""
    alpha, beta, gamma, phi = params
    count = shocks.shape[0]
    level, trend = np.full(count, state[0]), np.full(count, state[1])
    season = np.repeat(state[2][:, None], count, axis=1)
    out = np.empty((horizon, count))
    for h in range(horizon):
        slot = h % SEASON
        mean, update = _mean(level, trend, season[slot], phi, seasonal)
        error = shocks[:, h]
        out[h] = mean * (1 + error)
        level, trend, season[slot] = update(alpha, beta, gamma, error)
    return out


@lru_cache(maxsize=4)
def _draws(seed: int, paths: int, horizon: int) -> np.ndarray:
    """Standard normal draws from hashes: the same on every machine and for every series."""
    digests = [
        hashlib.md5(f"{seed}|{path}|{step}".encode()).hexdigest()
        for path in range(paths) for step in range(1, horizon + 1)
    ]
    scale = float(2 ** 52)
    u = np.array([(int(d[:13], 16) + 1, int(d[13:26], 16)) for d in digests], dtype="float64")
    normal = np.sqrt(-2 * np.log(u[:, 0] / (scale + 1))) * np.cos(2 * np.pi * u[:, 1] / scale)
    return normal.reshape(paths, horizon)
