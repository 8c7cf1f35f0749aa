"""How often a series is to be differenced, decided before any order is fitted.

The seasonal difference goes by the strength of the season: the part of the variance around a centred moving
average that the means of the season's days explain. First differences go by the KPSS test for a
constant level: partial sums of the deviations against their long-run variance with Bartlett weights.
Both work on packed series, inside the JVM and without a further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.schemas import SEASON

# The test's critical value at 5 %, the strength from which a season is differenced,
# and the most first differences.
LEVEL_CRITICAL = 0.463
STRONG_SEASON = 0.64
MOST_DIFFERENCES = 2
#: Seasons that a series has at least before its season is judged.
LEAST_SEASONS = 3


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def _deviations(values: Column) -> Column:
    mean = _sum(values) / F.nullif(F.size(values), F.lit(0))
    return F.transform(F.arrays_zip(values.alias("v"), F.array_repeat(mean, F.size(values)).alias("m")), lambda x: x["v"] - x["m"])


def differenced(values: Column, lag: int) -> Column:
    """``y[t] - y[t - lag]``, shorter by ``lag``."""
    rest = F.greatest(F.size(values) - lag, F.lit(0))
    return F.zip_with(F.slice(values, lag + 1, rest), F.slice(values, F.lit(1), rest), lambda a, b: a - b)


def with_level_statistic(rows: DataFrame, values: str, name: str) -> DataFrame:
    """Adds the KPSS statistic of an array column; null for a constant or empty series."""
    made = rows.withColumn("__e", _deviations(F.col(values))).withColumn("__n", F.size("__e"))
    made = made.withColumn("__lags", F.floor(3 * F.sqrt("__n") / 13).cast("int"))
    n, e = F.col("__n"), F.col("__e")

    def covariance(k: Column) -> Column:
        rest = n - k
        weight = F.when(k == 0, F.lit(1.0)).otherwise(2 * (1 - k / (F.col("__lags") + 1)))
        return weight * _sum(F.zip_with(F.slice(e, k + 1, rest), F.slice(e, F.lit(1), rest), lambda a, b: a * b)) / n

    long_run = F.when(n > 0, F.aggregate(F.sequence(F.lit(0), F.col("__lags")), F.lit(0.0), lambda total, k: total + covariance(k)))
    start = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))
    walked = F.aggregate(e, start, lambda at, v: F.struct((at["s"] + v).alias("s"), (at["q"] + (at["s"] + v) * (at["s"] + v)).alias("q")))
    statistic = walked["q"] / (n * n) / F.when(long_run > 1e-300, long_run)
    return made.withColumn(name, statistic).drop("__e", "__n", "__lags")


def with_seasonal_strength(rows: DataFrame, values: str, name: str, s: int = SEASON) -> DataFrame:
    """Adds the strength of the season, 0 to 1; null for series of fewer than ``LEAST_SEASONS`` seasons or without variance."""
    y, half = F.col(values), s // 2
    inner = F.sequence(F.lit(half), F.size(y) - half - 1)
    centred = F.transform(
        inner, lambda t: F.struct((t % s).alias("m"), (F.get(y, t) - _sum(F.slice(y, t - half + 1, F.lit(s))) / s).alias("v"))
    )
    made = rows.withColumn("__d", F.when(F.size(y) >= LEAST_SEASONS * s, centred))

    def mean(m: Column) -> Column:
        own = F.filter("__d", lambda x: x["m"] == m)
        return F.aggregate(own, F.lit(0.0), lambda total, x: total + x["v"]) / F.size(own)

    made = made.withColumn("__means", F.when(F.col("__d").isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(s - 1)), mean)))
    made = made.withColumns(
        {
            "__all": _deviations(F.transform("__d", lambda x: x["v"])),
            "__rest": _deviations(F.transform("__d", lambda x: x["v"] - F.get("__means", x["m"]))),
        }
    )
    squares = lambda c: _sum(F.transform(c, lambda v: v * v))
    variance = squares("__all")
    strength = F.greatest(F.lit(0.0), 1 - squares("__rest") / F.when(variance > 1e-300, variance))
    return made.withColumn(name, F.when(variance > 1e-300, strength)).drop("__d", "__means", "__all", "__rest")


def level_differences(packed: DataFrame, keys: list[str], values: str = "y") -> DataFrame:
    """Keys, kpss of the series, kpss_1 of its first difference, and d: how often to difference."""
    rows = packed.select(*keys, F.col(values).alias("z0")).withColumn("z1", differenced(F.col("z0"), 1))
    for k, name in enumerate(("kpss", "kpss_1")):
        rows = with_level_statistic(rows, f"z{k}", name)
    level = lambda c: F.coalesce(F.col(c) <= LEVEL_CRITICAL, F.lit(True))
    d = F.when(level("kpss"), 0).when(level("kpss_1"), 1).otherwise(MOST_DIFFERENCES)
    return rows.select(*keys, F.size("z0").alias("n_obs"), "kpss", "kpss_1", d.alias("d"))


def season_differences(packed: DataFrame, keys: list[str], values: str = "y", s: int = SEASON) -> DataFrame:
    """Keys, strength and seasonal_d: 1 for a strong season."""
    rows = with_seasonal_strength(packed.select(*keys, F.col(values).alias("y")), "y", "strength", s)
    return rows.select(*keys, "strength", F.when(F.col("strength") > STRONG_SEASON, 1).otherwise(0).alias("seasonal_d"))


def differences(packed: DataFrame, keys: list[str], s: int = SEASON) -> DataFrame:
    """Keys, d and seasonal_d: the season first, then the level of what its difference leaves."""
    rows = with_seasonal_strength(packed.select(*keys, "y"), "y", "strength", s)
    seasonal = F.when(F.col("strength") > STRONG_SEASON, 1).otherwise(0)
    left = rows.select(*keys, seasonal.alias("seasonal_d"), "y").withColumn(
        "y", F.when(F.col("seasonal_d") == 1, differenced(F.col("y"), s)).otherwise(F.col("y"))
    )
    return level_differences(left, [*keys, "seasonal_d"]).select(*keys, "d", "seasonal_d")
