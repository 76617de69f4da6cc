"""Daily count series, additive forecasts and before/after comparison.

Trend, weekly and yearly terms are fitted by least squares with a small ridge on
the trend changes. Point forecasts only: no intervals are estimated.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored


YEAR, WEEK = 365.25, 7.0


@dataclass(frozen=True)
class Design:
    """Terms of the model.

    The defaults follow the common additive model: 25 possible trend changes in the
    first 80 % of the history, ten yearly and three weekly harmonics.
    """

    changepoints: int = 25
    changepoint_range: float = 0.8
    yearly: int = 10
    weekly: int = 3
    ridge: float = 1.0


def daily_counts(df: DataFrame, cluster: str, date: str) -> DataFrame:
    """``(cluster, ds, y)`` for days that have rows."""
    return df.groupBy(F.col(cluster).alias("cluster"), F.to_date(date).alias("ds")).agg(
        F.count(F.lit(1)).alias("y")
    )


def zero_filled(series: DataFrame) -> DataFrame:
    """The series with a zero for every day missing between its first and last day."""
    span = series.groupBy("cluster").agg(F.min("ds").alias("_first"), F.max("ds").alias("_last"))
    days = span.select("cluster", F.explode(F.sequence("_first", "_last")).alias("ds"))
    return days.join(series, ["cluster", "ds"], "left").select(
        "cluster", "ds", F.coalesce("y", F.lit(0)).alias("y")
    )


# --- fitting -----------------------------------------------------------------


def _fourier(days: np.ndarray, period: float, order: int) -> list[np.ndarray]:
    return [f(2 * math.pi * k * days / period) for k in range(1, order + 1) for f in (np.sin, np.cos)]


def fit(series: DataFrame, design: Design = Design()) -> DataFrame:
    """Coefficients per cluster.

    A group is one cluster's daily series, at most one row per calendar day; the
    rows behind the counts were aggregated before.
    """
    kind = series.schema["cluster"].dataType.simpleString()
    schema = (
        f"cluster {kind}, start date, span double, offset double, slope double, "
        "knots array<double>, bends array<double>, yearly array<double>, weekly array<double>"
    )

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        dates = pd.to_datetime(pdf["ds"])
        # Days since 1970-01-01, a Thursday: seasonal phases do not depend on the sample.
        days = (dates - pd.Timestamp("1970-01-01")).dt.days.to_numpy(dtype=float)
        span = max(days[-1] - days[0], 1.0)
        t = (days - days[0]) / span
        y = pdf["y"].to_numpy(dtype=float)
        scale = np.abs(y).max() or 1.0
        history = int(len(t) * design.changepoint_range)
        count = max(min(design.changepoints, history - 1), 0)
        picks = np.linspace(0, max(history - 1, 0), count + 1).round().astype(int)[1:]
        knots = t[np.unique(picks)]
        hinges = [np.clip(t - k, 0.0, None) for k in knots]
        # A season needs two full periods, the weekly one also days closer than a week.
        has_weeks = span >= 2 * WEEK and len(days) > 1 and np.diff(days).min() < WEEK
        yearly = _fourier(days, YEAR, design.yearly) if span >= 730 else []
        weekly = _fourier(days, WEEK, design.weekly) if has_weeks else []
        x = np.column_stack([np.ones_like(t), t, *hinges, *yearly, *weekly])
        penalty = np.zeros(x.shape[1])
        penalty[2 : 2 + len(knots)] = design.ridge
        rows = np.vstack([x, np.diag(np.sqrt(penalty))])
        beta = np.linalg.lstsq(rows, np.concatenate([y / scale, np.zeros(x.shape[1])]), rcond=None)[0] * scale
        a, b = 2 + len(knots), 2 + len(knots) + len(yearly)
        return pd.DataFrame(
            {
                "cluster": [pdf["cluster"].iloc[0]],
                "start": [dates.iloc[0].date()],
                "span": [span],
                "offset": [beta[0]],
                "slope": [beta[1]],
                "knots": [list(knots)],
                "bends": [list(beta[2:a])],
                "yearly": [list(beta[a:b])],
                "weekly": [list(beta[b:])],
            }
        )

    return series.groupBy("cluster").applyInPandas(solve, schema)


# --- forecasting -------------------------------------------------------------


def future_days(series: DataFrame, periods: int | Column = 2000) -> DataFrame:
    """``(cluster, ds)``: the days of the history and ``periods`` days after its end."""
    last = series.groupBy("cluster").agg(F.max("ds").alias("_last"))
    length = periods if isinstance(periods, Column) else F.lit(periods)
    ahead = F.sequence(F.date_add("_last", F.lit(1)), F.date_add("_last", length.cast("int")))
    later = last.filter(length > 0).select("cluster", F.explode(ahead).alias("ds"))
    return series.select("cluster", "ds").unionByName(later)


def _season(weights: str, days: Column, period: float) -> Column:
    """Sum of weighted harmonics; even positions are sines, odd ones cosines."""

    def term(w: Column, i: Column) -> Column:
        angle = 2 * math.pi * (F.floor(i / 2) + 1) * days / period
        return w * F.when(i % 2 == 0, F.sin(angle)).otherwise(F.cos(angle))

    return F.aggregate(F.transform(weights, term), F.lit(0.0), lambda s, x: s + x)


def components(model: DataFrame, days: DataFrame) -> DataFrame:
    """``(cluster, ds, trend, weekly, yearly, yhat)`` for the given days."""
    joined = days.join(model, "cluster")
    day = F.date_diff("ds", F.lit("1970-01-01").cast("date"))
    t = F.date_diff("ds", "start") / F.col("span")
    bends = F.zip_with("knots", "bends", lambda k, d: d * F.greatest(t - k, F.lit(0.0)))
    trend = F.col("offset") + F.col("slope") * t + F.aggregate(bends, F.lit(0.0), lambda s, x: s + x)
    parts = joined.select(
        "cluster",
        "ds",
        trend.alias("trend"),
        _season("weekly", day, WEEK).alias("weekly"),
        _season("yearly", day, YEAR).alias("yearly"),
    )
    return parts.withColumn("yhat", F.col("trend") + F.col("weekly") + F.col("yearly"))


def forecast(series: DataFrame, periods: int = 2000, design: Design = Design()) -> DataFrame:
    """History and future with component values, from a fit to the whole series."""
    return components(fit(series, design), future_days(series, periods))


def residuals(series: DataFrame, model: DataFrame) -> DataFrame:
    """``(cluster, ds, y, yhat, residual)`` of the days a model was fitted to."""
    fitted = components(model, series.select("cluster", "ds")).select("cluster", "ds", "yhat")
    return series.join(fitted, ["cluster", "ds"]).select("cluster", "ds", "y", "yhat", (F.col("y") - F.col("yhat")).alias("residual"))


def forecast_intervals(series: DataFrame, periods: int = 2000, design: Design = Design(), coverage: float = 0.8) -> DataFrame:
    """``(cluster, ds, yhat, low, high)``: the forecast with the interval that holds ``coverage`` of the outcomes.

    After the history the trend may change as often per day as it could before, by Laplace
    distributed amounts as large on average as the changes found. The variance that
    simulated changes of this kind have is known: with ``s`` possible changes over the
    history and mean size ``d`` it is ``2 s d^2 (t - 1)^3 / 3`` at ``t`` histories from
    the start. It is added to that of the residuals, and no paths have to be drawn.
    """
    model = stored(fit(series, design), "series-model")
    noise = residuals(series, model).groupBy("cluster").agg(F.avg(F.col("residual") * F.col("residual")).alias("_noise"))
    size = F.aggregate("bends", F.lit(0.0), lambda s, x: s + F.abs(x)) / F.greatest(F.size("bends"), F.lit(1))
    spread = model.select("cluster", "start", "span", F.size("bends").alias("_s"), size.alias("_d")).join(noise, "cluster")
    ahead = F.greatest(F.date_diff("ds", "start") / F.col("span") - 1, F.lit(0.0))
    variance = F.col("_noise") + 2 * F.col("_s") * F.col("_d") * F.col("_d") * F.pow(ahead, 3) / 3
    half = NormalDist().inv_cdf((1 + coverage) / 2) * F.sqrt(variance)
    rows = components(model, future_days(series, periods)).select("cluster", "ds", "yhat").join(spread, "cluster")
    return rows.select("cluster", "ds", "yhat", (F.col("yhat") - half).alias("low"), (F.col("yhat") + half).alias("high"))


def normal_gaps(series: DataFrame, model: DataFrame, design: Design = Design()) -> DataFrame:
    """``(cluster, term, n, gap)``: how far each term is from its normal equation, as a share of the sum of all counts.

    At the least squares solution the residuals are orthogonal to every term, and to a possible trend change
    but for the ridge times its coefficient.
    """
    day = F.date_diff("ds", F.lit("1970-01-01").cast("date"))
    t = F.date_diff("ds", "start") / F.col("span")

    def term(name: str, number: Column, x: Column, due: Column) -> Column:
        return F.struct(F.concat(F.lit(name), number.cast("string")).alias("term"), x.cast("double").alias("x"), due.alias("due"))

    def season(name: str, period: float) -> Column:
        def harmonic(w: Column, i: Column) -> Column:
            angle = 2 * math.pi * (F.floor(i / 2) + 1) * day / period
            return term(f"{name} ", i + 1, F.when(i % 2 == 0, F.sin(angle)).otherwise(F.cos(angle)), F.lit(0.0))

        return F.transform(name, harmonic)

    bends = F.transform("knots", lambda k, i: term("bend ", i + 1, F.greatest(t - k, F.lit(0.0)), F.element_at("bends", i + 1) * design.ridge))
    fixed = F.array(term("offset", F.lit(""), F.lit(1.0), F.lit(0.0)), term("slope", F.lit(""), t, F.lit(0.0)))
    rows = residuals(series, model).join(model, "cluster")
    terms = rows.select("cluster", "y", "residual", F.explode(F.concat(fixed, bends, season("yearly", YEAR), season("weekly", WEEK))).alias("e"))
    sums = terms.groupBy("cluster", "e.term").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("e.x") * F.col("residual")).alias("_sum"), F.first("e.due").alias("_due"), F.sum(F.abs("y")).alias("_y")
    )
    return sums.select("cluster", "term", "n", (F.abs(F.col("_sum") - F.col("_due")) / F.greatest("_y", F.lit(1.0))).alias("gap"))


def counterfactual(series: DataFrame, cutoff: str, design: Design = Design()) -> DataFrame:
    """``(cluster, ds, yhat, y, difference)`` after the cutoff, from a fit up to it.

    The horizon is the number of observed days after the cutoff, counted in days
    from the end of the training series; forecasts are compared where a count exists.
    """
    day = F.lit(cutoff).cast("date")
    before, after = series.filter(F.col("ds") <= day), series.filter(F.col("ds") > day)
    horizon = after.groupBy("cluster").agg(F.count(F.lit(1)).alias("_h"))
    last = before.groupBy("cluster").agg(F.max("ds").alias("_last")).join(horizon, "cluster")
    ahead = last.select(
        "cluster", F.explode(F.sequence(F.date_add("_last", F.lit(1)), F.date_add("_last", F.col("_h").cast("int")))).alias("ds")
    ).filter(F.col("ds") > day)
    predicted = components(fit(before, design), ahead).select("cluster", "ds", "yhat")
    return predicted.join(after, ["cluster", "ds"]).select(
        "cluster", "ds", "yhat", "y", (F.col("y") - F.col("yhat")).alias("difference")
    )


def mean_absolute_error(comparison: DataFrame) -> DataFrame:
    return comparison.groupBy("cluster").agg(F.avg(F.abs("difference")).alias("mae"))
