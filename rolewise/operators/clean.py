"""Cleaning: the decisions are a few aggregates, the cleaned table stays a lazy projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.columns import as_double, field_types, present, q, to_long
from ..functions.quantiles import exact_quantiles
from .profile import NumericProfile, fences, numeric_profiles
from .roles import Roles

STRATEGIES = ("median", "mean")
LOG_SCHEMA = "column string, action string, value string, lower double, upper double"


def most_frequent(df: DataFrame, names: list[str]) -> dict[str, str]:
    """Most frequent value per column, the smallest of ties; counts are combined before the pick."""
    if not names:
        return {}
    counts = (to_long(df, {n: q(n).cast("string") for n in names}).filter("value is not null")
              .groupBy("name", "value").agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("name").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("value"))
    return {r["name"]: r["value"] for r in best.collect()}       # one row per column


def clean(df: DataFrame, roles: Roles, profiles: dict[str, NumericProfile] | None = None,
          strategy: str = "median", cap_outliers: bool = False, add_logs: bool = True
          ) -> tuple[DataFrame, DataFrame]:
    """Impute, optionally cap, add log columns, fill categories and drop rows without a target."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if profiles is None:
        profiles = numeric_profiles(df, roles.numeric, roles.n_rows)
    types, log = field_types(df), []
    numbers = {n: as_double(n, types[n]) for n in roles.numeric}
    seen = {n: profiles[n].n if n in profiles else 0 for n in numbers}
    for n in numbers:
        if seen[n] < roles.n_rows:
            p = profiles.get(n)
            fill = 0.0 if p is None else (p.mean if strategy == "mean" else p.median)
            numbers[n] = F.coalesce(numbers[n], F.lit(fill))
            log.append((n, "impute", repr(fill), None, None))

    bounds = {}
    if cap_outliers and numbers:
        quartiles = exact_quantiles(df, numbers, [0.25, 0.75], roles.n_rows)
        found = {n: fences(*quartiles[n]) for n in numbers}
        found = {n: b for n, b in found.items() if b}
        if found:
            out = df.agg(*[F.count(F.when((numbers[n] < lo) | (numbers[n] > hi), 1)).alias(f"o{i}")
                           for i, (n, (lo, hi)) in enumerate(found.items())]).first()
            bounds = {n: b for i, (n, b) in enumerate(found.items()) if out[i]}
        for n, (lo, hi) in bounds.items():
            numbers[n] = F.greatest(F.lit(lo), F.least(F.lit(hi), numbers[n]))
            log.append((n, "cap", None, lo, hi))

    logs = {}
    for n in numbers if add_logs else ():
        p = profiles.get(n)
        if p is not None and p.is_skewed and _lowest(p, bounds.get(n)) >= 0:
            logs[f"{n}_log"] = F.log1p(numbers[n])
            log.append((n, "log1p", f"{n}_log", None, None))

    categories = roles.low + roles.high
    gaps = [n for n in categories if roles.stats[n].n_missing]
    modes = most_frequent(df, gaps)
    fills = {}
    for n in gaps:
        fills[n] = F.coalesce(q(n).cast("string"), F.lit(modes.get(n, "Unknown")))
        log.append((n, "mode", modes.get(n, "Unknown"), None, None))

    source = df
    if roles.target in types:
        source = df.filter(present(roles.target, types[roles.target]).isNotNull())
    projection = [(numbers.get(n) if n in numbers else fills.get(n, q(n))).alias(n) for n in df.columns]
    cleaned = source.select(*projection, *[e.alias(n) for n, e in logs.items()])
    return cleaned, df.sparkSession.createDataFrame(log, LOG_SCHEMA)


def _lowest(p: NumericProfile, bound) -> float:
    """Smallest cleaned value: imputed values lie inside the range, capping can only raise it."""
    return p.min if bound is None else max(p.min, bound[0])


def coerce_numeric(df: DataFrame, names: list[str]) -> DataFrame:
    types = field_types(df)
    return df.withColumns({n: as_double(n, types[n]) for n in names})


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    return df.filter(present(target, field_types(df)[target]).isNotNull())
