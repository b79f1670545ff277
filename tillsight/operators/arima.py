"""ARIMA(1,1,1) without constant, one small fit per series.

Spark groups the rows of each series into one task call.  A series holds one
row per calendar day, so a group is bounded by its calendar.  The first
differences follow w[t] = phi w[t-1] + e[t] + theta e[t-1]; phi and theta
maximise the exact Gaussian likelihood (innovations form, variance
concentrated out) on a grid that is narrowed around its best point.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

# Fixed value: two-sided 95 % point of the normal distribution.
Z95 = 1.959963984540054

_EDGE = 0.995


def _profile(w: np.ndarray, phi: np.ndarray, theta: np.ndarray):
    """Deviance, variance and one-step state for arrays of (phi, theta)."""
    r = (1 + 2 * phi * theta + theta**2) / (1 - phi**2)
    ahead, squares, logs = np.zeros_like(phi), np.zeros_like(phi), np.zeros_like(phi)
    for value in w:
        miss = value - ahead
        squares += miss**2 / r
        logs += np.log(r)
        ahead = phi * value + theta / r * miss
        r = 1 + theta**2 - theta**2 / r
    n = len(w)
    variance = np.maximum(squares / n, 1e-300)
    return np.log(variance) + logs / n, variance, ahead


def fit_arma11(w: np.ndarray, points: int = 21, rounds: int = 7) -> tuple[float, float, float, float]:
    """(phi, theta, variance, next value) of the differences ``w``."""
    center, reach = np.zeros(2), _EDGE
    for _ in range(rounds):
        steps = np.linspace(-reach, reach, points)
        phi, theta = np.meshgrid(np.clip(center[0] + steps, -_EDGE, _EDGE),
                                 np.clip(center[1] + steps, -_EDGE, _EDGE), indexing="ij")
        deviance, variance, ahead = _profile(w, phi.ravel(), theta.ravel())
        best = int(np.argmin(deviance))
        center = np.array([phi.ravel()[best], theta.ravel()[best]])
        reach *= 4 / (points - 1)
    return center[0], center[1], float(variance[best]), float(ahead[best])


def project(last: float, phi: float, theta: float, variance: float, ahead: float,
            horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and standard errors of the next ``horizon`` values."""
    j = np.arange(horizon)
    mean = last + np.cumsum(ahead * phi**j)
    # psi[0] = 1; later weights of the integrated process.
    psi = np.cumsum(np.concatenate([[1.0], (phi + theta) * phi ** np.arange(horizon - 1)]))
    return mean, np.sqrt(variance * np.cumsum(psi**2))


def total_forecast(found: DataFrame) -> DataFrame:
    """Sum over series that are forecast apart: means add up, and so do the variances of independent errors."""
    spread = (F.col("upper_ci") - F.col("predicted_value")) / Z95
    half = Z95 * F.sqrt(F.sum(spread * spread))
    total = found.groupBy("forecast_date", "model_type").agg(F.sum("predicted_value").alias("predicted_value"), half.alias("_half"))
    return total.select("forecast_date", "predicted_value", "model_type", (F.col("predicted_value") - F.col("_half")).alias("lower_ci"),
                        (F.col("predicted_value") + F.col("_half")).alias("upper_ci"))


def arima_forecast(series: DataFrame, column: str = "revenue", horizon: int = 30,
                   keys: Sequence[str] = ()) -> DataFrame:
    """Means and 95 % intervals for every series; none for one that cannot be fitted."""
    key_fields = [series.schema[k] for k in keys]
    schema = T.StructType(key_fields + T.StructType.fromDDL(
        "forecast_date DATE, predicted_value DOUBLE, model_type STRING, "
        "lower_ci DOUBLE, upper_ci DOUBLE").fields)
    names = schema.fieldNames()

    def forecast(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ds")
        y = rows["y"].to_numpy(dtype=float)
        w = np.diff(y)
        if len(w) < 3 or not np.any(w):
            return pd.DataFrame(columns=names)
        mean, error = project(y[-1], *fit_arma11(w), horizon)
        out = pd.DataFrame({
            "forecast_date": [d.date() for d in pd.date_range(
                pd.Timestamp(rows["ds"].iloc[-1]) + pd.Timedelta(days=1), periods=horizon)],
            "predicted_value": mean, "model_type": "ARIMA",
            "lower_ci": mean - Z95 * error, "upper_ci": mean + Z95 * error})
        for k in keys:
            out[k] = rows[k].iloc[0]
        return out[names]

    values = series.filter(F.col(column).isNotNull()).select(
        *keys, "ds", F.col(column).cast("double").alias("y"))
    return values.groupBy(*keys).applyInPandas(forecast, schema)
