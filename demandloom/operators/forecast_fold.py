"""Innovations and forecasts of any seasonal ARIMA model as folds over packed arrays, inside the JVM.

The autoregressive, seasonal and differencing factors are multiplied out to one polynomial, and so are the
moving averages. A fold over the days then carries the last values and the last innovations, as long as the
polynomials, and a second fold runs ahead with innovations of zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _factor(coefficients: Column, sign: float, step: int) -> Column:
    """``1 + sign * c1 B^step + sign * c2 B^(2 step) + ...`` as the array of its weights by lag."""
    return F.transform(
        F.sequence(F.lit(0), F.size(coefficients) * step),
        lambda k: F.when(k == 0, F.lit(1.0))
        .when(k % step == 0, sign * F.get(coefficients, (k / step).cast("int") - 1))
        .otherwise(F.lit(0.0)),
    )


def multiplied(a: Column, b: Column) -> Column:
    """Product of two polynomials."""

    def weight(k: Column) -> Column:
        first, last = F.greatest(F.lit(0), k - F.size(b) + 1), F.least(k, F.size(a) - 1)
        return F.aggregate(F.sequence(first, last), F.lit(0.0), lambda sum_, i: sum_ + F.get(a, i) * F.get(b, k - i))

    return F.transform(F.sequence(F.lit(0), F.size(a) + F.size(b) - 2), weight)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda sum_, x: sum_ + x)


def _zeros(n: Column) -> Column:
    return F.transform(F.array_repeat(F.lit(0.0), n), lambda x: x)


def with_polynomials(rows: DataFrame, n_exog: int, s: int) -> DataFrame:
    """Adds beta, const, ``ar`` and ``ma`` (weights from lag 1 on) and ``needed`` days, from ``orders`` and ``params``.

    ``orders`` is p, d, q, seasonal p, d, q and whether there is an intercept; ``params`` lists regressors,
    intercept, AR, seasonal AR, MA, seasonal MA.
    """
    o = [F.get("orders", F.lit(k)) for k in range(7)]
    counts = [F.lit(n_exog), o[6], o[0], o[3], o[2], o[5]]
    parts, start = [], F.lit(1)
    for n in counts:
        parts.append(F.slice("params", start, n))
        start = start + n
    names = ["beta", "icpt", "phi", "sphi", "theta", "stheta"]
    cut = rows.withColumns(dict(zip(names, parts)))
    unit = lambda lag: F.array(F.lit(1.0), *[F.lit(0.0)] * (lag - 1), F.lit(-1.0))
    steps = F.concat(F.array_repeat(unit(1), o[1]), F.array_repeat(unit(s), o[4]))
    made = cut.withColumns(
        {
            "const": F.coalesce(F.get("icpt", F.lit(0)), F.lit(0.0)),
            "ar": multiplied(_factor(F.col("phi"), -1.0, 1), _factor(F.col("sphi"), -1.0, s)),
            "ma": multiplied(_factor(F.col("theta"), 1.0, 1), _factor(F.col("stheta"), 1.0, s)),
            "needed": o[0] + o[1] + s * (o[3] + o[4]),
        }
    ).withColumn("ar", F.aggregate(steps, F.col("ar"), multiplied))
    tail = lambda c: F.slice(c, F.lit(2), F.size(c) - 1)
    return made.withColumns({"ar": tail(F.col("ar")), "ma": tail(F.col("ma"))}).drop(*names[1:])


def _ahead(state: Column) -> Column:
    """What the values and innovations so far say about the next day."""
    return F.col("const") - _dot(F.col("ar"), state["h"]) + _dot(F.col("ma"), state["e"])


def _moved(value: Column, before: Column, length: Column) -> Column:
    return F.slice(F.concat(F.array(value), before), F.lit(1), length)


def folded(rows: DataFrame, n_exog: int, s: int) -> DataFrame:
    """Adds ``f``, the forecast of every asked day, to rows with ``y, x`` (a history), ``orders, params`` (a model)
    and ``dates, x_future`` (what is asked). Without a model or a history it is null, and where a
    regressor of the asked day is unknown the day's forecast is."""
    made = with_polynomials(rows, n_exog, s)
    lengths = {"h": F.size("ar"), "e": F.size("ma")}

    def regressed(x: str, t: Column) -> Column:
        return sum((F.get("beta", F.lit(k)) * F.get(F.get(x, F.lit(k)), t) for k in range(n_exog)), F.lit(0.0))

    values = F.transform("y", lambda v, t: F.struct((v - regressed("x", t)).alias("v"), t.alias("t")))
    empty = F.struct(_zeros(lengths["h"]).alias("h"), _zeros(lengths["e"]).alias("e"))

    def past(state: Column, day: Column) -> Column:
        e = F.when(day["t"] < F.col("needed"), F.lit(0.0)).otherwise(day["v"] - _ahead(state))
        return F.struct(_moved(day["v"], state["h"], lengths["h"]).alias("h"), _moved(e, state["e"], lengths["e"]).alias("e"))

    def next_day(state: Column, k: Column) -> Column:
        value = _ahead(state)
        return F.struct(
            _moved(value, state["h"], lengths["h"]).alias("h"),
            _moved(F.lit(0.0), state["e"], lengths["e"]).alias("e"),
            F.concat(state["f"], F.array(value)).alias("f"),
        )

    walked = made.withColumn("values", values).withColumn("state", F.aggregate("values", empty, past))
    run = F.struct(F.col("state.h").alias("h"), F.col("state.e").alias("e"), F.array().cast("array<double>").alias("f"))
    ahead = walked.withColumn("f", F.aggregate("dates", run, next_day)["f"])
    known = F.col("params").isNotNull() & F.col("y").isNotNull()
    final = F.when(known, F.transform("f", lambda v, k: v + regressed("x_future", k)))
    return ahead.withColumn("f", final).drop("values", "state", "ar", "ma", "needed", "beta", "const")
