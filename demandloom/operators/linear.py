"""Orders without moving averages, fitted by Spark alone, with regressions of any width.

An autoregression is a regression on lags. One window per series makes the lags of the target and of the
regressors, for every differencing; one aggregate their Gram matrices; and the sweep operator solves
any subset of columns from the same matrix, so each order is a list of pivots. Nothing leaves the
JVM, and a series moves once, however many orders are tried.

With regressors the lags stand beside them in one regression: ``z = lags + x``, both differenced alike.

Moving averages take two regressions (``two_stage_trials``): a long autoregression leaves residuals, and
their lags stand beside those of the series in the second one.
"""

from __future__ import annotations

from functools import reduce
from itertools import product
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandloom.schemas import SEASON

#: (p, seasonal_p) of the orders; both together are no regression on lags of the target alone.
LAG_ORDERS = [(0, 0), (1, 0), (2, 0), (0, 1)]
#: (d, seasonal_d), all of them with each of the above: 16 orders.
DIFFERENCES = [(0, 0), (1, 0), (0, 1), (1, 1)]
#: Days that every trial skips, so that all are scored on the same ones.
SKIPPED = 2 * SEASON + 1
#: (q, seasonal_q) of the orders with moving averages, in two regressions.
AVERAGE_ORDERS = [(0, 0), (1, 0), (2, 0), (0, 1), (1, 1), (2, 1)]
#: Lags of the long autoregression that stands for the unknown innovations.
LONG = SEASON + 1
#: A column counts as a combination of the others if less than this part of its squares is left.
SINGULAR = 1e-10


def difference_steps(d: int, seasonal_d: int) -> list[int]:
    """Lags of ``(1 - B)^d (1 - B^SEASON)^seasonal_d`` one after the other."""
    return [1] * d + [SEASON] * seasonal_d


def _weights(steps: list[int]) -> dict[int, int]:
    """Lag -> weight of a chain of differences."""
    out = {0: 1}
    for step in steps:
        moved = {lag + step: -w for lag, w in out.items()}
        out = {lag: out.get(lag, 0) + moved.get(lag, 0) for lag in sorted({*out, *moved})}
    return out


def grams(
    days: DataFrame, keys: list[str], target: str, exog: list[str], lags: list[int],
    differences: list[tuple[int, int]], skipped: int,
) -> DataFrame:
    """Keys, d, seasonal_d, n_obs and ``gram``: sums of products of the differenced target, its lags
    and the regressors, as one flat array by rows, over all days behind the ``skipped`` ones.

    ``days`` is at day grain; days with an unknown target are left out. Neither the lags nor the sums
    need a second shuffle: both go by the keys.
    """
    by_time = W.partitionBy(*keys).orderBy("date")
    value = {c: F.col(c).cast("double") for c in (target, *exog)}
    known = days.where(F.col(target).isNotNull()).select(*keys, "date", *(v.alias(f"v{i}") for i, v in enumerate(value.values())))
    weights = [_weights(difference_steps(*way)) for way in differences]
    needed = {0: {lag + back for w in weights for lag in w for back in (0, *lags)}}
    needed |= {i: {lag for w in weights for lag in w} for i in range(1, len(value))}
    shifted = {f"v{i}_{k}": F.lag(f"v{i}", k).over(by_time) if k else F.col(f"v{i}") for i, own in needed.items() for k in own}
    rows = known.withColumns({"at": F.row_number().over(by_time), **shifted}).where(F.col("at") > skipped)

    def differenced(i: int, back: int, w: dict[int, int]) -> Column:
        return reduce(lambda a, b: a + b, (F.col(f"v{i}_{lag + back}") * n for lag, n in w.items() if n))

    variants = [
        F.struct(
            F.lit(d).alias("d"), F.lit(seasonal_d).alias("seasonal_d"),
            F.array(*(differenced(0, back, w) for back in (0, *lags)), *(differenced(i, 0, w) for i in range(1, len(value)))).alias("v"),
        )
        for (d, seasonal_d), w in zip(differences, weights)
    ]
    spread = rows.select(*keys, F.explode(F.array(*variants)).alias("x")).select(*keys, "x.*")
    return _product_sums(spread, [*keys, "d", "seasonal_d"], 1 + len(lags) + len(exog))


def _product_sums(rows: DataFrame, by: list[str], m: int) -> DataFrame:
    """n_obs and ``gram`` of the arrays ``v`` of length m, by the given columns."""
    product_sums = {(i, j): F.sum(F.get("v", F.lit(i)) * F.get("v", F.lit(j))).alias(f"s{i}_{j}") for i, j in product(range(m), repeat=2) if i <= j}
    summed = rows.groupBy(*by).agg(F.count("*").alias("n_obs"), *product_sums.values())
    flat = F.array(*(F.col(f"s{min(i, j)}_{max(i, j)}") for i, j in product(range(m), repeat=2)))
    return summed.select(*by, "n_obs", flat.alias("gram"))


def swept(gram: Column, pivots: Column, m: int) -> Column:
    """The Gram matrix (m by m, flat) swept by the pivots, one after the other.

    Column 0 then holds the coefficients of the regression of variable 0 on the pivots, in the pivots' rows, and its sum
    of squares in row 0. A pivot that depends on those before it makes all of this null.
    """

    def sweep(a: Column, j: Column) -> Column:
        at = j * (m + 1)
        pivot = F.when(F.get(a, at) > SINGULAR * F.get(gram, at), F.get(a, at))

        def element(k: Column) -> Column:
            r, c = F.floor(k / m).cast("int"), k % m
            own = F.get(a, k)
            return (
                F.when((r == j) & (c == j), 1 / pivot)
                .when(r == j, own / pivot)
                .when(c == j, -own / pivot)
                .otherwise(own - F.get(a, r * m + j) * F.get(a, j * m + c) / pivot)
            )

        return F.transform(F.sequence(F.lit(0), F.lit(m * m - 1)), element)

    return F.aggregate(pivots, gram, sweep)


def _criteria(rows: DataFrame, m: int) -> DataFrame:
    """params, sse, k, aic and bic from ``gram``, ``pivots`` and ``n_obs``; null where they are not determined."""
    solved = rows.withColumn("s", swept(F.col("gram"), F.col("pivots"), m))
    n, k = F.col("n_obs"), F.size("pivots") + 1
    params = F.transform("pivots", lambda i: F.get(F.col("s"), i * m))
    full = solved.withColumns({"params": params, "sse": F.get("s", F.lit(0)), "k": k})
    usable = (n > F.col("k")) & (F.col("sse") > 0)
    deviance = n * (F.log(2 * pi * F.col("sse") / n) + 1)
    return full.withColumns(
        {"aic": F.when(usable, 2 * F.col("k") + deviance), "bic": F.when(usable, F.log(n) * F.col("k") + deviance)}
    ).drop("s", "gram", "pivots")


def linear_trials(days: DataFrame, keys: list[str], target: str = "sales", exog: list[str] = ()) -> DataFrame:
    """All 16 orders for every series: p, d, seasonal_p, seasonal_d, n_obs, params, sse and aic.

    ``params`` lists the regressors, then the lags. Orders that a series' days do not determine (too few of them, regressors that
    are constant or depend on one another) have a null aic. All orders of a series are scored on the same days.
    """
    lags = [1, 2, SEASON]
    sums = grams(days, keys, target, list(exog), lags, DIFFERENCES, SKIPPED)
    beside = [1 + len(lags) + i for i in range(len(exog))]
    orders = F.array(
        *(
            F.struct(
                F.lit(p).alias("p"), F.lit(seasonal_p).alias("seasonal_p"),
                F.array(*map(F.lit, [*beside, *range(1, p + 1), *[3] * seasonal_p])).cast("array<int>").alias("pivots"),
            )
            for p, seasonal_p in LAG_ORDERS
        )
    )
    spread = sums.select("*", F.explode(orders).alias("o")).select(*sums.columns, "o.*")
    return _criteria(spread, 1 + len(lags) + len(exog)).select(
        *keys, "p", "d", "seasonal_p", "seasonal_d", "n_obs", "params", "sse", "aic"
    )


def innovations(days: DataFrame, keys: list[str], target: str = "sales", d: int = 0, seasonal_d: int = 0) -> DataFrame:
    """Keys, date, z (the differenced target) and e: what an autoregression on the last ``LONG`` days leaves of z.

    The first days of a series, which have no such lags, are left out, and so are days with an unknown target. A
    series whose lags depend on one another (a constant one) has a null e. The model of a series is one row,
    joined by the keys that the lags are partitioned by already.
    """
    by_time = W.partitionBy(*keys).orderBy("date")
    weights = _weights(difference_steps(d, seasonal_d))
    value = F.col(target).cast("double")
    z = reduce(lambda a, b: a + b, (F.lag(value, k).over(by_time) * n if k else value * n for k, n in weights.items() if n))
    known = days.where(F.col(target).isNotNull()).select(*keys, "date", F.row_number().over(by_time).alias("at"), z.alias("z"))
    back = {f"z{k}": F.lag("z", k).over(by_time) for k in range(1, LONG + 1)}
    rows = known.withColumns(back).where(F.col("at") > max(weights) + LONG)
    lags = F.array(*back)
    sums = _product_sums(rows.select(*keys, F.concat(F.array("z"), lags).alias("v")), keys, 1 + LONG)
    pivots = F.sequence(F.lit(1), F.lit(LONG))
    solved = sums.select(*keys, swept(F.col("gram"), pivots, 1 + LONG).alias("s"))
    model = solved.select(*keys, F.transform(pivots, lambda i: F.get("s", i * (1 + LONG))).alias("phi"))
    explained = F.aggregate(F.zip_with("phi", lags, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return rows.join(model, keys).select(*keys, "date", "z", (F.col("z") - explained).alias("e"))


def two_stage_trials(
    days: DataFrame, keys: list[str], target: str = "sales", d: int = 0, seasonal_d: int = 0
) -> DataFrame:
    """All 24 orders with q up to 2 and one seasonal average, at one differencing: p, q, seasonal_p, seasonal_q, n_obs,
    params, sse and aic.

    Two regressions (Hannan and Rissanen): ``innovations``, then z on its own lags and those of the
    innovations. ``params`` lists the lags 1, 2 and ``SEASON`` of z, then of the innovations, as far as the order
    has them; with q and seasonal_q the product of both polynomials is left out. All orders of a series are
    scored on the same days. Orders that these do not determine have a null aic, and series of no more days
    than the lags of both regressions need have no rows.
    """
    shifts = [1, 2, SEASON]
    by_time = W.partitionBy(*keys).orderBy("date")
    own = [F.lag(c, k).over(by_time) for c in ("z", "e") for k in shifts]
    left = innovations(days, keys, target, d, seasonal_d)
    rows = left.select(*keys, F.row_number().over(by_time).alias("at"), F.array("z", *own).alias("v")).where(F.col("at") > SEASON)
    m = 1 + 2 * len(shifts)
    sums = _product_sums(rows, keys, m)

    def columns(short: int, seasonal: int, start: int) -> list[int]:
        return [*range(start, start + short), *[start + 2] * seasonal]

    orders = F.array(
        *(
            F.struct(
                F.lit(p).alias("p"), F.lit(q).alias("q"), F.lit(seasonal_p).alias("seasonal_p"), F.lit(seasonal_q).alias("seasonal_q"),
                F.array(*map(F.lit, [*columns(p, seasonal_p, 1), *columns(q, seasonal_q, 1 + len(shifts))])).cast("array<int>").alias("pivots"),
            )
            for (p, seasonal_p), (q, seasonal_q) in product(LAG_ORDERS, AVERAGE_ORDERS)
        )
    )
    spread = sums.select("*", F.explode(orders).alias("o")).select(*sums.columns, "o.*")
    return _criteria(spread, m).select(*keys, "p", "q", "seasonal_p", "seasonal_q", "n_obs", "params", "sse", "aic")


def linear_best(trials: DataFrame, keys: list[str], order: tuple[str, ...] = ("p", "d", "seasonal_p", "seasonal_d")) -> DataFrame:
    """The order with the lowest AIC of every series; ties go to the smaller order."""
    best = F.min_by(F.struct(*order, "aic"), F.when(F.col("aic").isNotNull(), F.struct("aic", *order)))
    return trials.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")


def fit_linear(
    days: DataFrame, keys: list[str], target: str = "sales", exog: list[str] = (), p: int = 0, d: int = 0,
    seasonal_p: int = 0, seasonal_d: int = 0,
) -> DataFrame:
    """One given order on all days of every series: a model row with the order columns, params (regressors,
    then lags), n_obs (days scored), sigma2, aic and bic."""
    if p and seasonal_p:
        raise ValueError("p and seasonal_p together are no regression on lags")
    lags = [*range(1, p + 1), *(SEASON * k for k in range(1, seasonal_p + 1))]
    skipped = sum(difference_steps(d, seasonal_d)) + max(lags, default=0)
    sums = grams(days, keys, target, list(exog), lags, [(d, seasonal_d)], skipped)
    pivots = [*(1 + len(lags) + i for i in range(len(exog))), *(1 + i for i in range(len(lags)))]
    out = _criteria(sums.withColumn("pivots", F.array(*map(F.lit, pivots)).cast("array<int>")), 1 + len(lags) + len(exog))
    order = {"p": p, "q": 0, "seasonal_p": seasonal_p, "seasonal_q": 0, "intercept": 0}
    return out.select(
        *keys, "d", "seasonal_d", *(F.lit(v).alias(c) for c, v in order.items()), "n_obs", "params",
        (F.col("sse") / F.col("n_obs")).alias("sigma2"), "aic", "bic",
    )
