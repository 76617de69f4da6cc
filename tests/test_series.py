import datetime
import math
import random

import pytest

from hemicycle.operators import series as S

DAY = datetime.timedelta(days=1)
START = datetime.date(2014, 1, 1)


def frame(spark, values, cluster=1, start=START):
    return spark.createDataFrame([(cluster, start + i * DAY, v) for i, v in values], "cluster int, ds date, y double")


def test_straight_line_has_no_difference_after_the_cutoff(spark):
    df = frame(spark, [(i, 3.0 + 0.5 * i) for i in range(1200)])
    out = S.counterfactual(df, "2016-10-02", S.Design(changepoints=0, yearly=0, weekly=0))
    assert out.count() == 1200 - 1006
    assert S.mean_absolute_error(out).first()["mae"] == pytest.approx(0, abs=1e-8)


def test_seasons_are_recovered(spark):
    def value(i):
        day = (START + i * DAY - datetime.date(1970, 1, 1)).days
        return 50 + 0.01 * i + 5 * math.sin(2 * math.pi * day / 365.25) + 2 * math.cos(2 * math.pi * day / 7)

    df = frame(spark, [(i, value(i)) for i in range(1500)])
    out = S.forecast(df, 400).orderBy("ds").collect()
    assert len(out) == 1900
    for i in (0, 700, 1499, 1600, 1899):
        assert out[i]["yhat"] == pytest.approx(value(i), abs=0.2)
        day = (START + i * DAY - datetime.date(1970, 1, 1)).days
        assert out[i]["weekly"] == pytest.approx(2 * math.cos(2 * math.pi * day / 7), abs=0.05)


def test_trend_change_is_followed(spark):
    df = frame(spark, [(i, 10.0 + (2.0 * (i - 300) if i > 300 else 0.0)) for i in range(600)])
    out = S.forecast(df, 10, S.Design(yearly=0, weekly=0, ridge=1e-6)).orderBy("ds").collect()
    assert out[-1]["yhat"] == pytest.approx(10 + 2 * (609 - 300), rel=0.02)


def test_short_series_and_future_days(spark):
    df = frame(spark, [(0, 4.0), (2, 4.0)])
    rows = S.forecast(df, 3).orderBy("ds").collect()
    assert [r["ds"] for r in rows] == [START, START + 2 * DAY, START + 3 * DAY, START + 4 * DAY, START + 5 * DAY]
    assert all(r["yhat"] == pytest.approx(4.0) for r in rows)


def test_counts_and_zero_fill(spark):
    stamps = [(1, "2020-01-01 10:00:00"), (1, "2020-01-01 23:00:00"), (1, "2020-01-03 00:00:00"), (2, "2020-01-05 00:00:00")]
    df = spark.createDataFrame(stamps, "c int, ts string")
    filled = S.zero_filled(S.daily_counts(df, "c", "ts")).orderBy("cluster", "ds").collect()
    assert [(r["cluster"], r["ds"].day, r["y"]) for r in filled] == [(1, 1, 2), (1, 2, 0), (1, 3, 1), (2, 5, 1)]


def test_intervals_are_as_wide_as_simulated_changes_make_them(spark):
    """Against paths with drawn changes; inside the history only the residuals count."""
    rng = random.Random(6)
    values = [(i, 20 + abs(i - 300) * 0.05 + rng.gauss(0, 1)) for i in range(600)]
    design = S.Design(changepoints=10, yearly=0, weekly=0, ridge=0.01)
    df = frame(spark, values)
    rows = {(r["ds"] - START).days: r for r in S.forecast_intervals(df, 300, design, 0.8).collect()}
    model = S.fit(df, design).first()
    half = {i: (r["high"] - r["low"]) / 2 for i, r in rows.items()}
    noise = half[0] / 1.2815515655446004
    assert 0.9 < noise < 1.2 and half[599] == pytest.approx(half[0]) and half[899] > half[700] > half[599]
    size = sum(map(abs, model["bends"])) / len(model["bends"])
    draws, t = [], 899 / model["span"]
    for _ in range(20000):
        path, at = 0.0, 1 + rng.expovariate(len(model["bends"]))
        while at < t:
            path += rng.choice((-1, 1)) * rng.expovariate(1 / size) * (t - at)
            at += rng.expovariate(len(model["bends"]))
        draws.append(path)
    simulated = math.sqrt(sum(x * x for x in draws) / len(draws))
    assert math.sqrt((half[899] / 1.2815515655446004) ** 2 - noise**2) == pytest.approx(simulated, rel=0.06)


def test_normal_equations_hold_at_the_fit_only(spark):
    rng = random.Random(7)
    df = frame(spark, [(i, 10 + 0.01 * i + rng.random() * 5) for i in range(900)])
    model = S.fit(df)
    gaps = S.normal_gaps(df, model).collect()
    assert len(gaps) == 2 + 25 + 20 + 6 and all(r["n"] == 900 and r["gap"] < 1e-9 for r in gaps)
    off = model.withColumn("slope", model["slope"] + 0.5)
    assert max(r["gap"] for r in S.normal_gaps(df, off).collect()) > 1e-3
