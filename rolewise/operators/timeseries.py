"""Daily series: trend, stationarity, autocorrelation, forecast and intervention, many at once.

Rows are reduced to one value per series and day before any ordering, so a window or a grouped task
holds days, never raw rows.
"""

from __future__ import annotations

from datetime import date, datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import pvalues
from ..functions.arima import (Order, adf_test, fit_arima, forecast_arima, holt,
                               partial_autocorrelations)
from ..functions.columns import as_double, field_types, present, q
from ..functions.dates import parse_timestamp
from ..functions.tables import staged

HORIZON = 12
MIN_POINTS = 20
MAX_LAG = 24
ORDER_RANGE = (0, 1, 2)
SEASON = 7
MIN_POINTS_SEASONAL = 2 * SEASON
MIN_SIDE = 5
ALPHA = 0.05

CANDIDATE_SCHEMA = ("series string, p int, d int, q int, seasonal boolean, aic double, "
                    "forecast array<double>, status string")
SUMMARY = ("series", "n_obs", "first_day", "last_day", "freq", "trend_r2", "adf_stat", "adf_p",
           "is_stationary", "method", "p", "d", "q", "seasonal", "aic", "note")


def _key_text(name: str) -> Column:
    """Text of a key in which neither null nor the separator can be mistaken for another key."""
    text = F.replace(q(name).cast("string"), F.lit("\\"), F.lit("\\\\"))
    return F.coalesce(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\\N"))


def daily_series(df: DataFrame, date_col: str, value_col: str, keys: list[str] = (),
                 min_points: int = 0) -> DataFrame:
    """(series, day, t, y): the mean per calendar day, t counting the observed days from 0."""
    types = field_types(df)
    day = F.to_date(parse_timestamp(present(date_col, types[date_col]), types[date_col]))
    series = F.concat_ws("|", *[_key_text(k) for k in keys]) if keys else F.lit("all")
    daily = (df.select(series.alias("series"), day.alias("day"),
                       as_double(value_col, types[value_col]).alias("y"))
             .filter("day is not null and y is not null")
             .groupBy("series", "day").agg(F.avg("y").alias("y")))
    by = Window.partitionBy("series")
    out = daily.select("series", "day", (F.row_number().over(by.orderBy("day")) - 1).cast("long").alias("t"),
                       "y")
    if min_points:
        out = (out.withColumn("_n", F.count(F.lit(1)).over(by)).filter(F.col("_n") >= min_points).drop("_n"))
    return out


def trend_r2(series: DataFrame) -> DataFrame:
    """Share of variance explained by a straight line; 0 for a constant series."""
    return series.groupBy("series").agg(
        F.count(F.lit(1)).alias("n_obs"),
        F.coalesce(F.regr_r2("y", F.col("t").cast("double")) * (F.var_pop("y") > 0).cast("int"),
                   F.lit(0.0)).alias("trend_r2"))


def _lag_products(series: DataFrame, max_lag: int) -> DataFrame:
    by = Window.partitionBy("series")
    order = by.orderBy("t")
    base = series.select("series", "t", (F.col("y") - F.avg("y").over(by)).alias("dev"),
                         F.count(F.lit(1)).over(by).alias("n"))
    lagged = base.select("series", "n", "dev", *[F.lag("dev", k).over(order).alias(f"l{k}")
                                                for k in range(1, max_lag + 1)])
    sums = lagged.groupBy("series", "n").agg(
        F.sum(F.col("dev") * F.col("dev")).alias("s0"),
        *[F.sum(F.col("dev") * F.col(f"l{k}")).alias(f"s{k}") for k in range(1, max_lag + 1)])
    limit = F.greatest(F.lit(1), F.least(F.lit(max_lag), F.floor(F.col("n") / 2) - 1)).cast("int")
    products = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"s{k}").alias("s")) for k in range(max_lag + 1)])
    return (sums.select("series", "n", "s0", limit.alias("limit"), F.explode(products).alias("p"))
            .select("series", "n", "s0", "limit", "p.lag", "p.s").filter("lag <= limit"))


def acf(series: DataFrame, max_lag: int = MAX_LAG) -> DataFrame:
    """Autocorrelation per lag; all lags come from one ordered pass over each series."""
    return _lag_products(series, max_lag).select(
        "series", "lag", F.when(F.col("s0") > 0, F.coalesce("s", F.lit(0.0)) / F.col("s0")).alias("acf"))


def pacf(series: DataFrame, max_lag: int = MAX_LAG) -> DataFrame:
    """Partial autocorrelation per lag from autocovariances over n - lag."""
    products = _lag_products(series, max_lag).select(
        "series", "lag", (F.coalesce("s", F.lit(0.0)) / (F.col("n") - F.col("lag"))).alias("c"))

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("lag")
        return pd.DataFrame({"series": group["series"], "lag": group["lag"],
                             "pacf": partial_autocorrelations(group["c"].to_numpy(dtype=float))})

    return products.groupBy("series").applyInPandas(solve, "series string, lag int, pacf double")


def adf(series: DataFrame) -> DataFrame:
    def test(group: pd.DataFrame) -> pd.DataFrame:
        y = group.sort_values("t")["y"].to_numpy(dtype=float)
        stat, p = adf_test(y)
        return pd.DataFrame({"series": [group["series"].iloc[0]], "adf_stat": [stat], "adf_p": [p],
                             "is_stationary": [p < ALPHA]})

    return series.groupBy("series").applyInPandas(
        test, "series string, adf_stat double, adf_p double, is_stationary boolean")


def series_freq(series: DataFrame) -> DataFrame:
    """Calendar step of a regular series: D, B, W, a multiple of days, MS or ME; D if irregular."""
    order = Window.partitionBy("series").orderBy("day")
    gaps = series.select("series", "day", F.datediff("day", F.lag("day").over(order)).alias("gap"))
    stats = gaps.groupBy("series").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.min("gap").alias("low"),
        F.max("gap").alias("high"), F.bool_and(F.day("day") == 1).alias("starts"),
        F.bool_and(F.col("day") == F.last_day("day")).alias("ends"),
        F.bool_and(F.weekday("day") < 5).alias("weekdays"),
        F.bool_and(F.col("gap").isNull() | (F.col("gap") == F.when(F.weekday("day") == 0, 3).otherwise(1)))
        .alias("business"))
    regular = F.col("low") == F.col("high")
    monthly = (F.col("low") >= 28) & (F.col("high") <= 31)
    freq = (F.when(F.col("low").isNull() | (regular & (F.col("low") == 1)), "D")
            .when(regular & (F.col("low") == 7), "W")
            .when(monthly & F.col("starts"), "MS").when(monthly & F.col("ends"), "ME")
            .when(regular, F.concat(F.col("low").cast("string"), F.lit("D")))
            .when(F.col("weekdays") & F.col("business"), "B").otherwise("D"))
    return stats.select("series", "first_day", "last_day", freq.alias("freq"))


def forecast_dates(freqs: DataFrame, steps: int = HORIZON) -> DataFrame:
    """The days of the next steps after the last day, at the series' own step."""
    out = freqs.select("series", "last_day", "freq", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    last, step = F.col("last_day"), F.col("step")
    days = F.when(F.col("freq") == "W", 7).when(F.col("freq").rlike(r"^\d+D$"),
                                                F.regexp_extract("freq", r"^(\d+)", 1).try_cast("int")).otherwise(1)
    place = F.weekday(last) + step                       # business days from this week's Monday
    business = F.date_add(last, (F.floor(place / 5) * 7 + F.pmod(place, F.lit(5)) - F.weekday(last)).cast("int"))
    day = (F.when(F.col("freq") == "MS", F.add_months(last, step))
           .when(F.col("freq") == "ME", F.last_day(F.add_months(F.trunc(last, "month"), step)))
           .when(F.col("freq") == "B", business)
           .otherwise(F.date_add(last, (days * step).cast("int"))))
    return out.select("series", "step", day.alias("day"))


def _fit_rows(group: pd.DataFrame, steps: int) -> list[tuple]:
    """One candidate for one series as a result row; a failure is a status, never an error."""
    group = group.sort_values("t")
    first = group.iloc[0]
    name, y = str(first["series"]), group["y"].to_numpy(dtype=float)
    order = Order(int(first["p"]), int(first["d"]), int(first["q"]), bool(first["seasonal"]), SEASON)
    weekly = first["freq"] == "D" and len(y) >= MIN_POINTS_SEASONAL
    head = (name, order.p, order.d, order.q, order.seasonal)
    try:
        fit = fit_arima(y, order, order.d + (SEASON if weekly else 0))
        if fit is None:
            return [(*head, None, None, "not fitted")]
        values = forecast_arima(y, order, fit["theta"], steps)
        if not np.isfinite(values).all():
            return [(*head, float(fit["aic"]), None, "forecast failed")]
        return [(*head, float(fit["aic"]), [float(v) for v in values], "ok")]
    except (ArithmeticError, ValueError, np.linalg.LinAlgError) as problem:
        return [(*head, None, None, type(problem).__name__)]


def arima_candidates(series: DataFrame, tested: DataFrame, freqs: DataFrame, steps: int = HORIZON
                     ) -> DataFrame:
    """Fit every (p, d, q) of every series, each pair a task of its own; d follows the ADF test."""
    orders = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(r).alias("q")) for p in ORDER_RANGE
                       for r in ORDER_RANGE])
    facts = tested.select("series", F.when(F.col("is_stationary"), 0).otherwise(1).alias("d")).join(
        freqs.select("series", "freq"), "series")
    spread = (series.join(facts, "series").select("*", F.explode(orders).alias("o"))
              .select("series", "t", "y", "d", "freq", "o.p", "o.q", F.lit(False).alias("seasonal"))
              .filter("not (p = 0 and q = 0 and d = 0)"))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_fit_rows(group, steps), columns=_candidate_columns())

    return spread.groupBy("series", "p", "q").applyInPandas(fit, CANDIDATE_SCHEMA)


def _candidate_columns() -> list[str]:
    return [part.split()[0] for part in CANDIDATE_SCHEMA.split(", ")]


def best_candidate(candidates: DataFrame) -> DataFrame:
    """Lowest AIC per series; ties by the smaller order."""
    rank = F.struct("aic", "seasonal", "p", "q")
    return (candidates.filter("aic is not null").groupBy("series")
            .agg(F.min_by(F.struct("p", "d", "q", "seasonal", "aic", "forecast", "status"), rank).alias("b"))
            .select("series", "b.*"))


def seasonal_candidates(series: DataFrame, best: DataFrame, freqs: DataFrame, steps: int = HORIZON
                        ) -> DataFrame:
    """One weekly candidate per daily series, at the order that won without a season."""
    daily = freqs.filter("freq = 'D'").select("series", "freq")
    rows = (series.join(best.select("series", "p", "d", "q"), "series").join(daily, "series")
            .withColumn("seasonal", F.lit(True)))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        rows = _fit_rows(group, steps) if len(group) >= MIN_POINTS_SEASONAL else []
        return pd.DataFrame(rows, columns=_candidate_columns())

    return rows.groupBy("series").applyInPandas(fit, CANDIDATE_SCHEMA)


def holt_forecast(series: DataFrame, steps: int = HORIZON) -> DataFrame:
    """Additive-trend exponential smoothing per series: the fallback forecast."""
    def smooth(group: pd.DataFrame) -> pd.DataFrame:
        values = holt(group.sort_values("t")["y"].to_numpy(dtype=float), steps)
        return pd.DataFrame({"series": group["series"].iloc[0], "step": np.arange(1, steps + 1),
                             "value": values})

    return series.groupBy("series").applyInPandas(smooth, "series string, step int, value double")


def analyze_series(df: DataFrame, date_col: str, value_col: str, keys: list[str] = (),
                   min_points: int = MIN_POINTS) -> dict[str, DataFrame]:
    """All diagnostics and the forecast for every series with enough days.

    The daily table is small and read by every step, so it is kept; candidate fits are kept too,
    because the choice and the seasonal fit both read them.
    """
    series = daily_series(df, date_col, value_col, keys, min_points).persist()
    freqs, tested = series_freq(series), adf(series).persist()
    plain = arima_candidates(series, tested, freqs).persist()
    winner = best_candidate(plain)
    candidates = plain.unionByName(seasonal_candidates(series, winner, freqs)).persist()
    chosen = best_candidate(candidates)
    usable = chosen.filter("forecast is not null")
    modelled = usable.select("series", F.posexplode("forecast").alias("i", "value")).select(
        "series", (F.col("i") + 1).alias("step"), "value")
    left = series.join(usable.select("series"), "series", "left_anti")
    smoothed = holt_forecast(left)
    method = F.when(F.col("forecast").isNull(), "exponential_smoothing").when(
        F.col("seasonal"), "sarima").otherwise("arima")
    note = F.when(F.col("forecast").isNull(), F.lit("no ARIMA order could be used; exponential smoothing"))
    used = F.col("forecast").isNotNull()
    summary = (trend_r2(series).join(freqs, "series").join(tested, "series")
               .join(chosen, "series", "left").withColumn("method", method)
               .withColumn("note", note)
               .withColumns({c: F.when(used, F.col(c)) for c in ("p", "d", "q", "seasonal", "aic")})
               .select(*SUMMARY))
    forecast = (modelled.unionByName(smoothed)
                .join(forecast_dates(freqs), ["series", "step"]).select("series", "step", "day", "value"))
    correlogram = acf(series).join(pacf(series), ["series", "lag"])
    chart = series.select("series", "day", F.lit("observed").alias("kind"), F.col("y").alias("value")).unionByName(
        forecast.select("series", "day", F.lit("forecast").alias("kind"), "value"))
    return {"ts_series": series, "ts_summary": summary, "ts_acf": correlogram, "ts_forecast": forecast,
            "ts_candidates": candidates, "ts_chart": chart}


# --- intervention -------------------------------------------------------------------------------

def _cutoff(text: str | date) -> date | None:
    if isinstance(text, datetime):
        return text.date()
    if isinstance(text, date):
        return text
    stamp = pd.to_datetime(text, errors="coerce")
    return None if pd.isna(stamp) else stamp.date()


def intervention_columns(series: DataFrame, cutoff: date) -> DataFrame:
    """Adds post (0/1) and the days since the first post day, for series the date falls into."""
    by = Window.partitionBy("series")
    post = (F.col("day") >= F.lit(cutoff)).cast("int")
    marked = series.withColumn("post", post).withColumns({
        "_lo": F.min("day").over(by), "_hi": F.max("day").over(by), "_n": F.count(F.lit(1)).over(by),
        "n_post": F.sum(post).over(by), "_t0": F.min(F.when(post == 1, F.col("t"))).over(by)})
    inside = marked.filter((F.col("_lo") < F.lit(cutoff)) & (F.col("_hi") > F.lit(cutoff)))
    return inside.select("series", "day", "t", "y", "post",
                         F.when(F.col("post") == 1, F.col("t") - F.col("_t0")).otherwise(0).alias("t_since"),
                         (F.col("_n") - F.col("n_post")).alias("n_pre"), "n_post")


def intervention(df: DataFrame, date_col: str, value_col: str, when: str | date, keys: list[str] = ()
                 ) -> tuple[DataFrame, DataFrame] | None:
    """Segmented regression y ~ 1 + t + post + t_since: (summary, fitted days); None for a bad date.

    Series with under 20 days, a date outside their range or a side under 5 days give no row.
    """
    cutoff = _cutoff(when)
    if cutoff is None:
        return None
    series = daily_series(df, date_col, value_col, keys, MIN_POINTS)
    rows = staged(intervention_columns(series, cutoff).filter(f"n_pre >= {MIN_SIDE} and n_post >= {MIN_SIDE}"))
    solved = segment_lines(rows)
    dof = F.col("n_pre") + F.col("n_post") - 4
    noise = (F.col("rest0") + F.col("rest1")) / dof
    level_error = F.sqrt(noise * sum((1 / F.col(n) + F.pow(F.col("t0") - F.col(f"mean{i}"), 2) / F.col(f"sxx{i}"))
                                     for i, n in enumerate(("n_pre", "n_post"))))
    slope_error = F.sqrt(noise * (1 / F.col("sxx0") + 1 / F.col("sxx1")))

    @F.pandas_udf("double")
    def two_sided(estimate: pd.Series, error: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series([pvalues.t_two_sided(b / e, int(n)) if e > 0 else 0.0 for b, e, n in zip(estimate, error, dof)])

    summary = solved.withColumns({"level_shift_p": two_sided("level_shift", level_error, dof),
                                  "slope_change_p": two_sided("slope_change", slope_error, dof)}).select(
        "series", F.lit(str(cutoff)).alias("intervention_date"), "n_pre", "n_post", "level_shift", "level_shift_p",
        "slope_change", "slope_change_p", (F.col("level_shift_p") < ALPHA).alias("significant_level_shift"),
        (F.col("slope_change_p") < ALPHA).alias("significant_slope_change"))
    lines = solved.select("series", "a0", "b0", "a1", "b1")
    fitted = F.when(F.col("post") == 1, F.col("a1") + F.col("b1") * F.col("t")).otherwise(F.col("a0") + F.col("b0") * F.col("t"))
    return summary, rows.join(lines, "series").select("series", "day", "y", fitted.alias("fitted"))


def segment_lines(rows: DataFrame) -> DataFrame:
    """One row per series: the lines before (a0, b0) and from the date on (a1, b1), the shift between them at the first
    day after it, the change of slope, and the sums that their errors need.

    The four coefficients of y ~ 1 + t + post + t_since are those of two separate lines, so one grouped aggregate solves
    them: level shift = line 1 - line 0 at t0, slope change = b1 - b0, and the residual sum is that of both lines.
    """
    aggs = [F.first("n_pre").alias("n_pre"), F.first("n_post").alias("n_post"), F.min(F.when(F.col("post") == 1, F.col("t"))).alias("t0")]
    for i in (0, 1):
        t, y = (F.when(F.col("post") == i, F.col(c)).cast("double") for c in ("t", "y"))
        aggs += [F.regr_slope(y, t).alias(f"b{i}"), F.avg(t).alias(f"mean{i}"), F.avg(y).alias(f"level{i}"), F.regr_sxx(y, t).alias(f"sxx{i}"),
                 F.regr_syy(y, t).alias(f"syy{i}"), F.regr_sxy(y, t).alias(f"sxy{i}")]
    found = rows.groupBy("series").agg(*aggs)
    found = found.withColumns({f"a{i}": F.col(f"level{i}") - F.col(f"b{i}") * F.col(f"mean{i}") for i in (0, 1)} | {
        f"rest{i}": F.greatest(F.lit(0.0), F.col(f"syy{i}") - F.pow(F.col(f"sxy{i}"), 2) / F.col(f"sxx{i}")) for i in (0, 1)})
    return found.withColumns({"level_shift": F.col("a1") - F.col("a0") + (F.col("b1") - F.col("b0")) * F.col("t0"),
                              "slope_change": F.col("b1") - F.col("b0")})
