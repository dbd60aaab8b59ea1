"""Time series queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import timeseries as ts
from .common import register, rounded, table, union_sql

QUERIES: dict = {}
SQL: dict[str, str] = {}

_EVENT_DAYS = ("(SELECT event_type AS series, CAST(ts AS DATE) AS day, avg(value) AS y, "
               "row_number() OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE)) - 1 AS t FROM events GROUP BY 1, 2)")
_ORDER_DAYS = ("(SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS y, "
               "row_number() OVER (PARTITION BY o_orderpriority ORDER BY CAST(o_orderdate AS DATE)) - 1 AS t FROM orders GROUP BY 1, 2)")


def _event_days(spark, folder):
    return ts.daily_series(table(spark, folder, "events"), "ts", "value", ["event_type"])


def _order_days(spark, folder):
    return ts.daily_series(table(spark, folder, "orders"), "o_orderdate", "o_totalprice", ["o_orderpriority"])


@register(QUERIES, SQL, "daily_series",
          f"SELECT series, CAST(day AS VARCHAR) AS day, t, round(y, 6) AS y FROM {_EVENT_DAYS}")
def daily(spark, folder):
    return rounded(_event_days(spark, folder))


@register(QUERIES, SQL, "trend_r2", union_sql([
    f"SELECT series, count(*) AS n_obs, round(coalesce(regr_r2(y, t), 0), 6) AS trend_r2 FROM {d} GROUP BY series"
    for d in (_EVENT_DAYS, _ORDER_DAYS)]))
def trend(spark, folder):
    return rounded(ts.trend_r2(_event_days(spark, folder)).unionByName(ts.trend_r2(_order_days(spark, folder))))


@register(QUERIES, SQL, "acf", f"""
WITH s AS (SELECT * FROM {_EVENT_DAYS} UNION ALL SELECT * FROM {_ORDER_DAYS}),
m AS (SELECT series, avg(y) AS mean, count(*) AS n FROM s GROUP BY series),
d AS (SELECT series, t, y - mean AS dev, n FROM s JOIN m USING (series)),
v AS (SELECT series, sum(dev * dev) AS s0 FROM d GROUP BY series)
SELECT a.series, k::BIGINT AS lag, round(sum(a.dev * b.dev) / any_value(s0), 6) AS acf
FROM d a, generate_series(0, 24) AS g(k), d b, v
WHERE b.series = a.series AND b.t = a.t + k AND v.series = a.series AND k <= greatest(1, least(24, a.n // 2 - 1)) GROUP BY a.series, k""")
def autocorrelation(spark, folder):
    return rounded(ts.acf(_event_days(spark, folder)).unionByName(ts.acf(_order_days(spark, folder))))


@register(QUERIES, SQL, "pacf")
def partial(spark, folder):
    return rounded(ts.pacf(_order_days(spark, folder)))


@register(QUERIES, SQL, "adf")
def stationarity(spark, folder):
    return ts.adf(_order_days(spark, folder))


_FREQ_SQL = """CASE WHEN lo = hi AND lo = 1 THEN 'D' WHEN lo = hi AND lo = 7 THEN 'W' WHEN lo >= 28 AND hi <= 31 AND starts THEN 'MS'
  WHEN lo >= 28 AND hi <= 31 AND ends THEN 'ME' WHEN lo = hi THEN lo || 'D' ELSE 'D' END"""


def _calendar_sql(name: str, day: str) -> str:
    return f"""SELECT '{name}' AS series, max(day) AS last_day, {_FREQ_SQL} AS freq FROM (
 SELECT max(day) AS day, min(gap) AS lo, max(gap) AS hi, bool_and(day(day) = 1) AS starts, bool_and(day = last_day(day)) AS ends FROM (
  SELECT day, date_diff('day', lag(day) OVER (ORDER BY day), day) AS gap FROM (SELECT DISTINCT {day} AS day FROM orders))) GROUP BY lo, hi, starts, ends"""


_CALENDARS = {"daily": ("CAST(o_orderdate AS DATE)", lambda d: F.to_date(d)),
              "weekly": ("CAST(date_trunc('week', o_orderdate) AS DATE)", lambda d: F.trunc(F.to_date(d), "week")),
              "monthly": ("CAST(date_trunc('month', o_orderdate) AS DATE)", lambda d: F.trunc(F.to_date(d), "month")),
              "month_end": ("last_day(CAST(o_orderdate AS DATE))", lambda d: F.last_day(F.to_date(d)))}
_FREQS_SQL = union_sql([_calendar_sql(n, e) for n, (e, _) in _CALENDARS.items()])


def _calendars(spark, folder):
    out = None
    for name, (_, rule) in _CALENDARS.items():
        df = table(spark, folder, "orders").select(
            F.lit(name).alias("k"), rule(F.col("o_orderdate")).alias("d"), "o_totalprice")
        part = ts.daily_series(df, "d", "o_totalprice", ["k"])
        out = part if out is None else out.unionByName(part)
    return out


@register(QUERIES, SQL, "series_freq", f"SELECT series, freq, CAST(last_day AS VARCHAR) AS last_day FROM ({_FREQS_SQL})")
def freq(spark, folder):
    return rounded(ts.series_freq(_calendars(spark, folder)).select("series", "freq", "last_day"))


@register(QUERIES, SQL, "forecast_dates", f"""
SELECT series, step, CAST(CAST(CASE freq WHEN 'W' THEN last_day + INTERVAL (7 * step) DAY WHEN 'MS' THEN last_day + INTERVAL (step) MONTH
  WHEN 'ME' THEN last_day(last_day + INTERVAL (step) MONTH) ELSE last_day + INTERVAL (step) DAY END AS DATE) AS VARCHAR) AS day
FROM ({_FREQS_SQL}), generate_series(1, 12) AS g(step)""")
def future_days(spark, folder):
    return rounded(ts.forecast_dates(ts.series_freq(_calendars(spark, folder))))


@register(QUERIES, SQL, "arima_search")
def search(spark, folder):
    """Best order per event type, chosen among nine."""
    s = _event_days(spark, folder)
    return ts.best_candidate(ts.arima_candidates(s, ts.adf(s), ts.series_freq(s))).drop("forecast")


@register(QUERIES, SQL, "sarima_candidate")
def seasonal(spark, folder):
    s = _event_days(spark, folder)
    freqs = ts.series_freq(s)
    best = ts.best_candidate(ts.arima_candidates(s, ts.adf(s), freqs))
    return ts.seasonal_candidates(s, best, freqs).drop("forecast")


@register(QUERIES, SQL, "forecast")
def forecast(spark, folder):
    return ts.analyze_series(table(spark, folder, "events"), "ts", "value", ["event_type"])["ts_forecast"]


@register(QUERIES, SQL, "ts_summary")
def summary(spark, folder):
    return ts.analyze_series(table(spark, folder, "orders"), "o_orderdate", "o_totalprice", ["o_orderpriority"])["ts_summary"]


@register(QUERIES, SQL, "ts_chart")
def chart(spark, folder):
    return ts.analyze_series(table(spark, folder, "events"), "ts", "value")["ts_chart"]


@register(QUERIES, SQL, "holt_forecast")
def smoothing(spark, folder):
    return ts.holt_forecast(_order_days(spark, folder))


_CUT = date(2024, 1, 16)
_ALL_DAYS = ("(SELECT event_type AS series, CAST(ts AS DATE) AS day, avg(value) AS y, "
             "row_number() OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE)) - 1 AS t FROM events GROUP BY 1, 2)")
_MARKED = f"""(SELECT *, CASE WHEN post = 1 THEN t - min(CASE WHEN post = 1 THEN t END) OVER (PARTITION BY series) ELSE 0 END AS t_since,
  count(*) FILTER (WHERE post = 0) OVER (PARTITION BY series) AS n_pre, count(*) FILTER (WHERE post = 1) OVER (PARTITION BY series) AS n_post
  FROM (SELECT *, (day >= DATE '{_CUT}')::INT AS post FROM {_ALL_DAYS}))"""


@register(QUERIES, SQL, "intervention_prepost", f"""
SELECT series, CAST(day AS VARCHAR) AS day, t, round(y, 6) AS y, post::BIGINT AS post, t_since, n_pre, n_post FROM {_MARKED}""")
def prepost(spark, folder):
    return rounded(ts.intervention_columns(_event_days(spark, folder), _CUT))


@register(QUERIES, SQL, "intervention_fit", f"""
WITH s AS (SELECT series, post, regr_slope(y, t) AS b, regr_intercept(y, t) AS a, min(t) AS t0, count(*) AS n FROM {_MARKED} GROUP BY series, post)
SELECT p.series, '{_CUT}' AS intervention_date, p.n AS n_pre, q.n AS n_post,
  round((q.a + q.b * q.t0) - (p.a + p.b * q.t0), 5) AS level_shift, round(q.b - p.b, 5) AS slope_change
FROM s p JOIN s q ON p.series = q.series AND p.post = 0 AND q.post = 1 WHERE p.n >= 5 AND q.n >= 5""")
def fit(spark, folder):
    found = ts.intervention(table(spark, folder, "events"), "ts", "value", str(_CUT), ["event_type"])
    return rounded(found[0].select("series", "intervention_date", "n_pre", "n_post", "level_shift", "slope_change"), 5)
