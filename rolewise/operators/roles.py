"""Column roles: what each column is, from two aggregate jobs over the whole table."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.columns import (DATETIME_TYPES, as_double, distinct_key, field_types, is_numeric,
                                 present, q)
from ..functions.dates import NAME_HINT, parse_timestamp
from ..functions.tables import in_parallel

# Fixed thresholds and name patterns of the role rules.
LOW_CARDINALITY_MAX = 20
HIGH_CARDINALITY_MAX_SHARE = 0.5
TEXT_MIN_MEAN_LENGTH = 25
IDENTIFIER_MIN_SHARE = 0.98
GEO_MIN_SHARE = 0.95
DATE_MIN_SHARE = 0.95
DATE_MIN_SHARE_WITH_NAME = 0.7
REGRESSION_MIN_DISTINCT = 16
LATITUDE_NAME = re.compile(r"^(lat|latitude)$", re.IGNORECASE)
LONGITUDE_NAME = re.compile(r"^(lon|lng|long|longitude)$", re.IGNORECASE)
IDENTIFIER_NAME = re.compile(r"(^id$|_id$|^id_|uuid|guid)", re.IGNORECASE)

NOT_FEATURES = ("target", "identifier", "constant", "datetime", "unsupported")
PROFILE_SCHEMA = ("position int, name string, role string, dtype string, n_missing long, "
                  "pct_missing double, n_unique long")
STATS_SCHEMA = ("name string, dtype string, n_rows long, n_missing long, pct_missing double, "
                "n_unique long")


@dataclass
class ColumnStats:
    name: str
    dtype: T.DataType
    n_rows: int
    n_missing: int
    n_unique: int
    mean_length: float | None = None
    date_share: float | None = None
    lat_share: float = 0.0
    lon_share: float = 0.0

    @property
    def pct_missing(self) -> float:
        return self.n_missing / self.n_rows if self.n_rows else 0.0

    @property
    def unique_share(self) -> float:
        return self.n_unique / self.n_rows if self.n_rows else 0.0


@dataclass
class Roles:
    """Names and roles only; no data of the table is held here."""

    n_rows: int
    stats: dict[str, ColumnStats]
    roles: dict[str, str]
    target: str | None = None
    task: str | None = None
    lat: str | None = None
    lon: str | None = None
    columns: list[str] = field(default_factory=list)

    def of(self, *roles: str) -> list[str]:
        return [n for n in self.columns if self.roles[n] in roles]

    @property
    def numeric(self) -> list[str]:
        return self.of("numeric")

    @property
    def low(self) -> list[str]:
        return self.of("categorical_low")

    @property
    def high(self) -> list[str]:
        return self.of("categorical_high")

    @property
    def datetimes(self) -> list[str]:
        return self.of("datetime")

    @property
    def texts(self) -> list[str]:
        return self.of("text")

    @property
    def has_geo(self) -> bool:
        return self.lat is not None and self.lon is not None

    @property
    def features(self) -> list[str]:
        return [n for n in self.columns if self.roles[n] not in NOT_FEATURES]

    def profile(self, spark: SparkSession) -> DataFrame:
        rows = [(i, n, self.roles[n], self.stats[n].dtype.simpleString(), self.stats[n].n_missing,
                 self.stats[n].pct_missing, self.stats[n].n_unique)
                for i, n in enumerate(self.columns)]
        return spark.createDataFrame(rows, PROFILE_SCHEMA)

    def table(self, spark: SparkSession) -> DataFrame:
        """The role table of a report: share of missing values in percent, one decimal."""
        return self.profile(spark).select(
            "name", "role", "dtype", F.round(F.col("pct_missing") * 100, 1).alias("pct_missing"),
            "n_unique")


def _supported(dtype: T.DataType) -> bool:
    return is_numeric(dtype) or isinstance(dtype, (*DATETIME_TYPES, T.StringType))


def column_stats(df: DataFrame, distinct: str = "exact") -> dict[str, ColumnStats]:
    """Missing and distinct counts, mean length, date, latitude and longitude shares per column.

    One job holds all plain aggregates.  Exact distinct counts are one job per column, a few at a
    time: each reads its own column only, while counting all in one job would repeat every row once
    per column.  ``distinct="triage"`` estimates them and counts exactly only columns whose estimate
    could change a role.
    """
    if distinct not in ("exact", "triage"):
        raise ValueError("distinct must be 'exact' or 'triage'")
    types = field_types(df)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, (name, dtype) in enumerate(types.items()):
        col = present(name, dtype)
        aggs.append(F.count(col).alias(f"c{i}"))
        if isinstance(dtype, T.StringType):
            aggs.append(F.avg(F.length(col)).alias(f"l{i}"))
            parsed = parse_timestamp(col, dtype).isNotNull()
            aggs.append(F.avg(F.when(col.isNotNull(), parsed.cast("int"))).alias(f"d{i}"))
        if is_numeric(dtype) and LATITUDE_NAME.match(name):
            aggs.append(_share_within(name, dtype, 90).alias(f"y{i}"))
        if is_numeric(dtype) and LONGITUDE_NAME.match(name):
            aggs.append(_share_within(name, dtype, 180).alias(f"x{i}"))
        if distinct == "triage" and _supported(dtype):
            aggs.append(F.approx_count_distinct(distinct_key(name, dtype), 0.02).alias(f"u{i}"))
    row = df.agg(*aggs).first().asDict()
    n = row["n"]
    names = list(types)
    counted = {name: row[f"u{i}"] for i, name in enumerate(names) if f"u{i}" in row}
    exact = [m for m in names if _supported(types[m])
             and (distinct == "exact" or _near_threshold(counted[m], n))]
    if exact:
        counted.update(zip(exact, in_parallel([partial(_distinct_count, df, m, types[m]) for m in exact])))
    return {name: ColumnStats(name, types[name], n, n - row[f"c{i}"], counted.get(name, 0),
                              row.get(f"l{i}"), row.get(f"d{i}"), row.get(f"y{i}") or 0.0,
                              row.get(f"x{i}") or 0.0)
            for i, name in enumerate(names)}


def _distinct_count(df: DataFrame, name: str, dtype: T.DataType) -> int:
    """Exact: values are folded per task, the distinct ones shuffled, and only counted then."""
    keys = df.select(distinct_key(name, dtype).alias("k"))
    return keys.filter("k is not null").distinct().count()


def stats_frame(spark: SparkSession, stats: dict[str, ColumnStats]) -> DataFrame:
    return spark.createDataFrame(
        [(s.name, s.dtype.simpleString(), s.n_rows, s.n_missing, s.pct_missing, s.n_unique)
         for s in stats.values()], STATS_SCHEMA)


def _share_within(name, dtype, limit):
    """Share of all rows, so missing values count against it."""
    return F.avg(F.coalesce(as_double(name, dtype).between(-limit, limit).cast("int"), F.lit(0)))


def _near_threshold(estimate: int, n: int) -> bool:
    marks = (1, LOW_CARDINALITY_MAX, REGRESSION_MIN_DISTINCT, HIGH_CARDINALITY_MAX_SHARE * n,
             IDENTIFIER_MIN_SHARE * n)
    return any(abs(estimate - m) <= max(3.0, 0.1 * m) for m in marks)


def infer_task(stats: ColumnStats) -> str:
    numeric = is_numeric(stats.dtype)
    return "regression" if numeric and stats.n_unique >= REGRESSION_MIN_DISTINCT else "classification"


def _role(s: ColumnStats) -> str:
    if not _supported(s.dtype):
        return "unsupported"
    if s.n_unique <= 1:
        return "constant"
    if isinstance(s.dtype, DATETIME_TYPES):
        return "datetime"
    if is_numeric(s.dtype):
        if LATITUDE_NAME.match(s.name) and s.lat_share > GEO_MIN_SHARE:
            return "geo_lat"
        if LONGITUDE_NAME.match(s.name) and s.lon_share > GEO_MIN_SHARE:
            return "geo_lon"
        named = IDENTIFIER_NAME.search(s.name)
        return "identifier" if named and s.unique_share >= IDENTIFIER_MIN_SHARE else "numeric"
    date_share = s.date_share or 0.0
    hinted = re.search(NAME_HINT, s.name) is not None
    if date_share >= DATE_MIN_SHARE or (hinted and date_share >= DATE_MIN_SHARE_WITH_NAME):
        return "datetime"
    short = s.mean_length < TEXT_MIN_MEAN_LENGTH
    if short and s.unique_share >= IDENTIFIER_MIN_SHARE:
        return "identifier"
    if s.n_unique <= LOW_CARDINALITY_MAX:
        return "categorical_low"
    return ("categorical_high" if short and s.unique_share < HIGH_CARDINALITY_MAX_SHARE else "text")


def infer_roles(df: DataFrame, target: str | None = None, overrides: dict[str, str] | None = None,
                distinct: str = "exact") -> Roles:
    """Role of every column, the task of the target and the latitude/longitude pair."""
    stats = column_stats(df, distinct)
    roles = {n: "target" if n == target else _role(s) for n, s in stats.items()}
    roles.update({n: r for n, r in (overrides or {}).items() if n in roles and n != target})
    out = Roles(next(iter(stats.values())).n_rows if stats else 0, stats, roles, target,
                columns=list(df.columns))
    if target in stats:
        out.task = infer_task(stats[target])
    for name in out.columns:            # the last matching column wins
        if roles[name] == "geo_lat":
            out.lat = name
        elif roles[name] == "geo_lon":
            out.lon = name
    return out


def datetime_shares(df: DataFrame) -> DataFrame:
    """Share of present values that read as a date, for string and date columns."""
    types = field_types(df)
    names = [n for n, t in types.items() if isinstance(t, (T.StringType, *DATETIME_TYPES))]
    shares = [F.avg(F.when(q(n).isNotNull(), parse_timestamp(q(n), types[n]).isNotNull().cast("int")))
              for n in names]
    row = df.agg(*[s.alias(f"s{i}") for i, s in enumerate(shares)]).first()
    rows = [(n, row[i], _is_date(n, types[n], row[i])) for i, n in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, "name string, parse_share double, is_datetime boolean")


def _is_date(name, dtype, share):
    if not isinstance(dtype, T.StringType):
        return True
    hinted = re.search(NAME_HINT, name) is not None
    return (share or 0.0) >= (DATE_MIN_SHARE_WITH_NAME if hinted else DATE_MIN_SHARE)


def geo_shares(df: DataFrame) -> DataFrame:
    """Share of all rows within the latitude and longitude ranges, by column, with the verdict."""
    stats = column_stats(df, "triage")
    rows = [(n, s.lat_share, s.lon_share, _role(s)) for n, s in stats.items()
            if LATITUDE_NAME.match(n) or LONGITUDE_NAME.match(n)]
    return df.sparkSession.createDataFrame(
        rows, "name string, lat_share double, lon_share double, role string")
