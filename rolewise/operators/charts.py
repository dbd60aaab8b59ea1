"""The numbers behind each chart; nothing is drawn."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import as_double, field_types, q, to_long
from ..functions.normal import normal_quantile_sql
from ..functions.pvalues import normal_quantile
from ..functions.quantiles import exact_quantiles, grouped_quantiles, grouped_ranks
from ..functions.ranks import running_counts, running_sums
from ..functions.tables import lookup, staged
from .linear import feature_grams, linear_expression, total
from .profile import FENCE_WIDTH, missing_shares
from .segments import standardise, usable_columns

BINS = 20
GRID = 50
QQ_POINTS = 99
DENSITY_POINTS = 200
DENSITY_CELLS = 16_384


def chart_missingness(df: DataFrame) -> DataFrame:
    """Percent missing per column, largest first."""
    return missing_shares(df).select("name", (F.col("pct_missing") * 100).alias("pct")).orderBy(
        F.desc("pct"), "name")


def _bin(value: Column, low: Column | float, high: Column | float, bins: int) -> Column:
    """Bin number 0..bins-1 of equal width, the largest value in the last bin."""
    low, high = F.lit(low), F.lit(high)
    place = F.floor((value - low) / (high - low) * F.lit(bins))
    return F.when(high > low, F.least(place, F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")


def _ranges(df: DataFrame, cols: dict[str, Column]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[a for i, c in enumerate(cols.values()) for a in (
        F.min(c).alias(f"a{i}"), F.max(c).alias(f"z{i}"))]).first()
    return {n: (row[f"a{i}"], row[f"z{i}"]) for i, n in enumerate(cols) if row[f"a{i}"] is not None}


def histogram(df: DataFrame, names: list[str], bins: int = BINS, columns: int | None = None) -> DataFrame:
    """Counts per column and equal-width bin, for the first `columns` names if given; empty bins have no row."""
    types = field_types(df)
    cols = {n: as_double(n, types[n]) for n in names[:columns]}
    found = _ranges(df, cols)
    if not found:
        return df.sparkSession.createDataFrame([], "name string, bin int, low double, high double, n long")
    placed = to_long(df, {n: F.when(cols[n].isNotNull(), _bin(cols[n], *found[n], bins)) for n in found},
                     value="bin").filter("bin is not null")
    counts = placed.groupBy("name", "bin").agg(F.count(F.lit(1)).alias("n"))
    edges = df.sparkSession.createDataFrame([(n, a, z) for n, (a, z) in found.items()],
                                            "name string, a double, z double")
    width = (F.col("z") - F.col("a")) / bins
    return counts.join(F.broadcast(edges), "name").select(          # one row per column
        "name", "bin", (F.col("a") + F.col("bin") * width).alias("low"),
        (F.col("a") + (F.col("bin") + 1) * width).alias("high"), "n")


def target_by_category(df: DataFrame, target: str, category: str) -> DataFrame:
    """Box-plot summary of the target per level, by median descending, for any number of levels.

    Values are counted per level and ranked in ranges that split a large level; quartiles and places are rows of tables,
    and fences go back to the counted values by a lookup that stands hot levels.  Rows without a level or a target are left out.
    """
    y = as_double(target, field_types(df)[target])
    ranked = grouped_ranks(df, q(category).cast("string"), y)
    quartiles = staged(grouped_quantiles(ranked, [0.25, 0.5, 0.75]))
    size = quartiles.agg(F.count(F.lit(1)).alias("k"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    reach = F.when(F.col("q2") == F.col("q0"), 0.0).otherwise(F.lit(FENCE_WIDTH) * (F.col("q2") - F.col("q0")))
    table = quartiles.select("group", F.col("n").alias("_n"), (F.col("q0") - reach).alias("_low"), (F.col("q2") + reach).alias("_high"))
    within = F.col("value").between(F.col("_low"), F.col("_high"))
    whiskers = (lookup(ranked.select("group", "value", F.col("n").alias("rows")), table, ["group"], "_n", size["k"], size["n"])
                .groupBy("group").agg(F.min(F.when(within, F.col("value"))).alias("whisker_low"),
                                      F.max(F.when(within, F.col("value"))).alias("whisker_high"),
                                      F.coalesce(F.sum(F.when(~within, F.col("rows"))), F.lit(0)).alias("n_outliers")))
    places = running_sums(quartiles.withColumns({"_down": -F.col("q1"), "_one": F.lit(1)}), [], ["_down", "group"], {"_one": "_before"}, size["k"])
    return places.join(whiskers, "group").select(
        (F.col("_before") + 1).cast("int").alias("position"), F.col("group").alias("category"), "n", F.col("q0").alias("q1"),
        F.col("q1").alias("median"), F.col("q2").alias("q3"), "whisker_low", "whisker_high", "n_outliers")


def geo_grid(df: DataFrame, lat: str, lon: str, cell: float = 1.0, cluster: str | None = None,
             target: str | None = None, target_is_class: bool = False) -> DataFrame:
    """Points per square cell, split by cluster or class, with the mean of a numeric target."""
    types = field_types(df)
    y, x = as_double(lat, types[lat]), as_double(lon, types[lon])
    by = [F.floor(y / cell).cast("long").alias("lat_cell"), F.floor(x / cell).cast("long").alias("lon_cell")]
    if cluster:
        by.append(q(cluster).cast("string").alias("cluster"))
    if target and target_is_class:
        by.append(q(target).cast("string").alias("class"))
    aggs = [F.count(F.lit(1)).alias("n")]
    if target and not target_is_class:
        aggs.append(F.avg(as_double(target, types[target])).alias("target_mean"))
    return df.filter(y.isNotNull() & x.isNotNull()).groupBy(*by).agg(*aggs)


def pca(df: DataFrame, names: list[str], keep: list[str] = ()) -> tuple[DataFrame, DataFrame] | None:
    """First two components of the standardised columns: (rows with pc1 and pc2, variance shares).

    One cross-product pass gives the correlation matrix; signs make the largest loading positive.
    """
    moments = usable_columns(df, names)
    if len(moments) < 2:
        return None
    scaled = standardise(df, moments, keep, "_z_").withColumn("_zero", F.lit(0.0))
    z = [f"_z_{n}" for n in moments]
    c = total(feature_grams(scaled, z, "_zero")).centred()
    values, vectors = np.linalg.eigh(c.zz / c.n)
    order = np.argsort(-values)[:2]
    shares = values[order] / values.sum()
    parts = []
    for i in order:
        v = vectors[:, i]
        v = v if v[np.argmax(np.abs(v))] > 0 else -v
        parts.append(linear_expression(z, 0.0, v))
    rows = scaled.select(*[q(k) for k in keep], parts[0].alias("pc1"), parts[1].alias("pc2"))
    variance = df.sparkSession.createDataFrame(
        [(i + 1, float(s)) for i, s in enumerate(shares)], "component int, explained_variance double")
    return rows, variance


def density(df: DataFrame, names: list[str], points: int = DENSITY_POINTS, cells: int = DENSITY_CELLS) -> DataFrame:
    """Gaussian kernel density per column at evenly spaced points from the least to the largest value.

    Bandwidth is Scott's: the sample deviation times n^(-1/5).  Each value is shared linearly between its two neighbours of
    a fine grid; the sums by cell are one aggregation, and only cells x columns numbers are smoothed on the driver.  Columns
    without two different values have no curve."""
    types, schema = field_types(df), "name string, point int, x double, density double"
    cols = {n: as_double(n, types[n]) for n in names}
    row = df.select([x for i, c in enumerate(cols.values()) for x in (
        F.min(c).alias(f"a{i}"), F.max(c).alias(f"z{i}"), F.stddev_samp(c).alias(f"s{i}"), F.count(c).alias(f"n{i}"))]).first()
    known = {n: tuple(row[f"{k}{i}"] for k in "azsn") for i, n in enumerate(cols) if row[f"n{i}"] > 1 and row[f"a{i}"] < row[f"z{i}"]}
    if not known:
        return df.sparkSession.createDataFrame([], schema)
    place = {n: (cols[n] - F.lit(a)) / F.lit(z - a) * F.lit(float(cells)) for n, (a, z, _, _) in known.items()}
    at = F.least(F.floor("place"), F.lit(cells - 1)).cast("int")
    shared = to_long(df, place, value="place").filter("place IS NOT NULL").select("name", F.inline(F.array(
        F.struct(at.alias("cell"), (1 - (F.col("place") - at)).alias("w")), F.struct((at + 1).alias("cell"), (F.col("place") - at).alias("w")))))
    sums = shared.groupBy("name", "cell").agg(F.sum("w").alias("w")).toPandas()
    out = []
    for name, part in sums.groupby("name"):
        a, z, deviation, n = known[name]
        width = deviation * n ** -0.2
        where = a + part["cell"].to_numpy() * (z - a) / cells
        for i, x in enumerate(np.linspace(a, z, points)):
            kernel = np.exp(-0.5 * ((x - where) / width) ** 2)
            out.append((name, i, float(x), float(kernel @ part["w"].to_numpy() / (n * width * np.sqrt(2 * np.pi)))))
    return df.sparkSession.createDataFrame(out, schema)


def residual_bins(residuals: DataFrame, bins: int = BINS, fitted: str = "fitted", residual: str = "residual"
                  ) -> DataFrame:
    """Counts on a grid of fitted value by residual."""
    cols = {"f": q(fitted).cast("double"), "r": q(residual).cast("double")}
    found = _ranges(residuals, cols)
    if len(found) < 2:
        return residuals.sparkSession.createDataFrame([], "fitted_bin int, residual_bin int, n long")
    return (residuals.filter(cols["f"].isNotNull() & cols["r"].isNotNull())
            .groupBy(_bin(cols["f"], *found["f"], bins).alias("fitted_bin"),
                     _bin(cols["r"], *found["r"], bins).alias("residual_bin"))
            .agg(F.count(F.lit(1)).alias("n")))


def qq_points(residuals: DataFrame, residual: str = "residual", points: int = QQ_POINTS,
              n_rows: int | None = None) -> DataFrame:
    """Residual quantiles against normal quantiles at evenly spaced probabilities."""
    probs = [(i + 1) / (points + 1) for i in range(points)]
    found = exact_quantiles(residuals, {"r": q(residual).cast("double")}, probs, n_rows)["r"]
    return residuals.sparkSession.createDataFrame(
        [(p, normal_quantile(p), v) for p, v in zip(probs, found)],
        "p double, theoretical double, observed double")


def qq_line(residuals: DataFrame, residual: str = "residual") -> DataFrame:
    """The line through the ordered values over normal scores: slope, intercept, r and n, from all rows.

    Row i of n stands at Filliben's median rank; equal values share the ranks that they take together.  Ranks come from
    counts of distinct values, so no window spans the column; the sums for the line are one aggregation."""
    value = q(residual).cast("double")
    counts = residuals.select(value.alias("v")).filter("v IS NOT NULL AND NOT isnan(v)").groupBy("v").agg(F.count(F.lit(1)).alias("k"))
    counts = counts.withColumn("one", F.lit(1))
    n = counts.agg(F.sum("k")).first()[0] or 0
    ranked = running_counts(counts.select("one", "v", "k"), ["one"], "v", {"k": "below"})
    rows = ranked.select("v", F.explode(F.sequence(F.col("below") + 1, F.col("below") + F.col("k"))).alias("i"))
    median = F.when(F.col("i") == n, F.lit(0.5 ** (1 / max(n, 1)))).when(F.col("i") == 1, F.lit(1 - 0.5 ** (1 / max(n, 1)))).otherwise(
        (F.col("i") - 0.3175) / F.lit(n + 0.365))
    scored = rows.select("v", median.alias("p")).select("v", F.expr(normal_quantile_sql("p")).alias("x"))
    return scored.agg(F.regr_slope("v", "x").alias("slope"), F.regr_intercept("v", "x").alias("intercept"), F.corr("v", "x").alias("r"),
                      F.count(F.lit(1)).alias("n"))
