"""Count series, forecasts and the before/after comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series as S
from ..session import stored
from .registry import query
from .tables import table

LINE = S.Design(changepoints=0, yearly=0, weekly=0)
CUTOFF = "1999-10-02"

_DAILY = """
daily AS (SELECT o_orderpriority AS cluster, o_orderdate::DATE AS ds, count(*) AS y FROM orders GROUP BY ALL)
"""


def _orders(spark, d):
    return S.daily_counts(table(spark, d, "orders"), "o_orderpriority", "o_orderdate")


def _text_day(df):
    return df.withColumn("ds", F.col("ds").cast("string"))


@query("SELECT event_type AS cluster, ts::DATE::VARCHAR AS ds, count(*) AS y FROM events GROUP BY ALL")
def daily_counts(spark, d):
    return _text_day(S.daily_counts(table(spark, d, "events"), "event_type", "ts"))


@query(
    "WITH"
    + _DAILY
    + """,
span AS (SELECT cluster, min(ds) AS a, max(ds) AS b FROM daily GROUP BY cluster),
days AS (SELECT cluster, unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS ds FROM span)
SELECT cluster, ds::VARCHAR AS ds, coalesce(y, 0) AS y FROM days LEFT JOIN daily USING (cluster, ds)
"""
)
def zero_filled(spark, d):
    return _text_day(S.zero_filled(_orders(spark, d)))


@query(
    "WITH"
    + _DAILY
    + """,
span AS (SELECT cluster, max(ds) AS b FROM daily GROUP BY cluster)
SELECT cluster, ds::VARCHAR AS ds FROM daily
UNION ALL
SELECT cluster, unnest(generate_series(b + INTERVAL 1 DAY, b + INTERVAL 2000 DAY, INTERVAL 1 DAY))::DATE::VARCHAR FROM span
"""
)
def future_days(spark, d):
    return _text_day(S.future_days(_orders(spark, d), 2000))


_FIT = """
fit AS (
  SELECT cluster, regr_slope(y, date_diff('day', DATE '1990-01-01', ds)) AS b,
         regr_intercept(y, date_diff('day', DATE '1990-01-01', ds)) AS a
  FROM daily WHERE {where} GROUP BY cluster
)
"""


@query(
    "WITH"
    + _DAILY
    + ","
    + _FIT.format(where="true")
    + """,
span AS (SELECT cluster, max(ds) AS b FROM daily GROUP BY cluster),
days AS (
  SELECT cluster, ds FROM daily UNION ALL
  SELECT cluster, unnest(generate_series(b + INTERVAL 1 DAY, b + INTERVAL 2000 DAY, INTERVAL 1 DAY))::DATE FROM span
)
SELECT d.cluster, d.ds::VARCHAR AS ds, round(a + b * date_diff('day', DATE '1990-01-01', d.ds), 5) AS yhat
FROM days d JOIN fit USING (cluster)
"""
)
def linear_forecast(spark, d):
    """History and 2000 days ahead under a straight-line trend."""
    out = S.forecast(_orders(spark, d), 2000, LINE)
    return _text_day(out.select("cluster", "ds", F.round("yhat", 5).alias("yhat")))


@query(
    "WITH"
    + _DAILY
    + ","
    + _FIT.format(where="true")
    + """,
noise AS (SELECT cluster, sqrt(avg(pow(y - a - b * date_diff('day', DATE '1990-01-01', ds), 2))) AS s FROM daily JOIN fit USING (cluster) GROUP BY cluster),
span AS (SELECT cluster, max(ds) AS b FROM daily GROUP BY cluster),
days AS (
  SELECT cluster, ds FROM daily UNION ALL
  SELECT cluster, unnest(generate_series(b + INTERVAL 1 DAY, b + INTERVAL 2000 DAY, INTERVAL 1 DAY))::DATE FROM span
)
SELECT d.cluster, d.ds::VARCHAR AS ds, round(a + b * date_diff('day', DATE '1990-01-01', d.ds) - 1.2815515655446004 * s, 5) AS low,
  round(a + b * date_diff('day', DATE '1990-01-01', d.ds) + 1.2815515655446004 * s, 5) AS high
FROM days d JOIN fit USING (cluster) JOIN noise USING (cluster)
"""
)
def linear_intervals(spark, d):
    """Where four of five counts lie under a straight-line trend."""
    out = S.forecast_intervals(_orders(spark, d), 2000, LINE)
    return _text_day(out.select("cluster", "ds", F.round("low", 5).alias("low"), F.round("high", 5).alias("high")))


@query(
    "WITH"
    + _DAILY
    + """,
terms AS (
  SELECT 'offset' AS term UNION ALL SELECT 'slope' UNION ALL SELECT 'bend ' || k FROM range(1, 26) t(k)
  UNION ALL SELECT 'yearly ' || k FROM range(1, 21) t(k) UNION ALL SELECT 'weekly ' || k FROM range(1, 7) t(k)
)
SELECT cluster, term, count(*) AS n, 0.0::DOUBLE AS gap FROM daily, terms GROUP BY cluster, term
"""
)
def seasonal_normal_equations(spark, d):
    """Every term of the full model meets its normal equation over all days."""
    daily = stored(_orders(spark, d), "daily")
    gaps = S.normal_gaps(daily, S.fit(daily))
    return gaps.withColumn("gap", F.round("gap", 6))


@query()
def forecast_components(spark, d):
    """Trend, weekly and yearly parts under the full model."""
    out = S.forecast(_orders(spark, d), 2000)
    return _text_day(out.select("cluster", "ds", *[F.round(c, 4).alias(c) for c in ("trend", "weekly", "yearly", "yhat")]))


WEEKS = S.Design(changepoints=0, yearly=0, weekly=3)


@query(
    """
WITH daily AS (SELECT event_type AS cluster, ts::DATE AS ds, count(*) AS y FROM events GROUP BY ALL),
t AS (SELECT *, date_diff('day', DATE '1970-01-01', ds) AS t, isodow(ds) AS dow FROM daily),
m AS (SELECT cluster, dow, avg(t) AS mt, avg(y) AS my FROM t GROUP BY ALL),
slope AS (
  SELECT cluster, sum((t - mt) * (y - my)) / sum((t - mt) * (t - mt)) AS b
  FROM t JOIN m USING (cluster, dow) GROUP BY cluster
),
levels AS (SELECT cluster, dow, my - b * mt AS a, b FROM m JOIN slope USING (cluster)),
base AS (SELECT cluster, avg(a) AS a0 FROM levels GROUP BY cluster),
days AS (
  SELECT cluster, ds FROM daily UNION ALL
  SELECT cluster, unnest(generate_series(last + INTERVAL 1 DAY, last + INTERVAL 14 DAY, INTERVAL 1 DAY))::DATE
  FROM (SELECT cluster, max(ds) AS last FROM daily GROUP BY cluster)
)
SELECT d.cluster, d.ds::VARCHAR AS ds, round(a0 + b * date_diff('day', DATE '1970-01-01', d.ds), 5) AS trend,
       round(a - a0, 5) AS weekly, round(a + b * date_diff('day', DATE '1970-01-01', d.ds), 5) AS yhat
FROM days d JOIN levels l ON l.cluster = d.cluster AND l.dow = isodow(d.ds) JOIN base ON base.cluster = d.cluster
"""
)
def weekly_components(spark, d):
    """Trend and weekly parts; three weekly harmonics are as good as one level per weekday."""
    out = S.forecast(S.daily_counts(table(spark, d, "events"), "event_type", "ts"), 14, WEEKS)
    return _text_day(out.select("cluster", "ds", *[F.round(c, 5).alias(c) for c in ("trend", "weekly", "yhat")]))


_COMPARE = (
    _DAILY
    + ","
    + _FIT.format(where=f"ds <= DATE '{CUTOFF}'")
    + f""",
horizon AS (
  SELECT cluster, max(CASE WHEN ds <= DATE '{CUTOFF}' THEN ds END) AS last, count_if(ds > DATE '{CUTOFF}') AS h
  FROM daily GROUP BY cluster
),
compared AS (
  SELECT cluster, ds, a + b * date_diff('day', DATE '1990-01-01', ds) AS yhat, y
  FROM daily JOIN fit USING (cluster) JOIN horizon USING (cluster)
  WHERE ds > DATE '{CUTOFF}' AND ds <= last + h::INT
)
"""
)


@query(
    "WITH"
    + _COMPARE
    + "SELECT cluster, ds::VARCHAR AS ds, round(yhat, 5) AS yhat, y, round(y - yhat, 5) AS difference FROM compared"
)
def linear_counterfactual(spark, d):
    """Counts after a date against the trend fitted before it."""
    out = S.counterfactual(_orders(spark, d), CUTOFF, LINE)
    rounded = {c: F.round(c, 5) for c in ("yhat", "difference")}
    return _text_day(out.withColumns(rounded))


@query("WITH" + _COMPARE + "SELECT cluster, round(avg(abs(y - yhat)), 5) AS mae FROM compared GROUP BY cluster")
def linear_error(spark, d):
    errors = S.mean_absolute_error(S.counterfactual(_orders(spark, d), CUTOFF, LINE))
    return errors.select("cluster", F.round("mae", 5).alias("mae"))


@query()
def seasonal_error(spark, d):
    """Error of the full model after the cutoff."""
    errors = S.mean_absolute_error(S.counterfactual(_orders(spark, d), CUTOFF))
    return errors.select("cluster", F.round("mae", 4).alias("mae"))
