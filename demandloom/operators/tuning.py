"""Order search: a grid or a stepwise walk over every series at once, picked by AIC.

Spark packs each series into one row, spreads (series, block of orders) rows over the tasks
and selects among the returned trials with an aggregate. Only the fit of one block of orders
to one packed series runs in Python, on numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count, product
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions import css
from demandloom.functions.columns import is_finite
from demandloom.schemas import BOOLEAN, DOUBLE, INT, SEASON, struct

# The searched orders, and the order used when no trial succeeds.
SPACE = {
    "p": [0, 1, 2],
    "d": [0, 1],
    "q": [0, 1, 2],
    "seasonal_p": [0, 1],
    "seasonal_d": [0, 1],
    "seasonal_q": [0, 1],
}
FALLBACK = {"p": 1, "d": 1, "q": 1, "seasonal_p": 1, "seasonal_d": 1, "seasonal_q": 1}
MAX_ITER = 50

ORDER_COLS = list(SPACE)
LANE_CELLS = 150_000  # days x lanes one kernel call holds
RESULT = struct(
    trial_id=INT, **dict.fromkeys(ORDER_COLS, INT), intercept=INT, n_obs=INT, aic=DOUBLE,
    bic=DOUBLE, sigma2=DOUBLE, converged=BOOLEAN, at_iteration_limit=BOOLEAN,
    params=T.ArrayType(DOUBLE),
)


class Sample(NamedTuple):
    """Days a search may skip before the ones it scores, largest first, and the most parameters
    any of its orders has. The orders of one series are compared on the same days: those behind
    the largest number of skipped days that still leaves more days than parameters. Orders that
    need more days first than that are refused for that series."""

    warmups: tuple[int, ...]
    most_params: int

    def skipped(self, days: np.ndarray) -> np.ndarray:
        out = np.full(len(days), self.warmups[-1])
        for warmup in reversed(self.warmups):
            out = np.where(days - warmup > self.most_params, warmup, out)
        return out


def search_sample(space: dict[str, list[int]], n_exog: int, s: int = SEASON) -> Sample:
    lags = ("p", "d", "seasonal_p", "seasonal_d")
    warmups = {css.warmup(*values, s) for values in product(*(space[k] for k in lags))}
    width = sum(max(space[k]) for k in ("p", "q", "seasonal_p", "seasonal_q"))
    return Sample(tuple(sorted(warmups, reverse=True)), n_exog + width + max(space.get("intercept", [0])) + 1)


def grid_size(space: dict[str, list[int]] = SPACE) -> int:
    return int(np.prod([len(v) for v in space.values()]))


def order_columns(trial_id: Column, space: dict[str, list[int]] = SPACE) -> list[Column]:
    """Orders of a trial number; the last named order varies fastest."""
    out, stride = [], grid_size(space)
    for name, values in space.items():
        stride //= len(values)
        digit = F.floor(trial_id / stride) % len(values)
        out.append(F.get(F.array(*map(F.lit, values)), digit).cast("int").alias(name))
    return out


def plan_trials(series: DataFrame, space: dict[str, list[int]] = SPACE) -> DataFrame:
    """Every series with every order of the grid, in enumeration order."""
    ids = F.explode(F.sequence(F.lit(0), F.lit(grid_size(space) - 1)))
    return series.withColumn("trial_id", ids).select(
        "*", *order_columns(F.col("trial_id"), space)
    )


def _lane_blocks(pdf: pd.DataFrame) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Cut the (row, order) lanes of a batch into kernel-sized blocks."""
    block, longest = [], 0
    for i, (y, trials) in enumerate(zip(pdf["y"], pdf["trials"])):
        for trial in trials:
            longest = max(longest, len(y))
            if block and (len(block) + 1) * longest > LANE_CELLS:
                yield block
                block, longest = [], len(y)
            block.append((i, np.asarray(trial, dtype=int)))
    if block:
        yield block


def stack_lanes(ys, xs, n_exog: int):
    """Pad series to one length, aligned at their last day: ``y [T, L]``, ``x [T, L, k]``."""
    sizes = np.array([len(y) for y in ys])
    y = np.zeros((sizes.max(initial=0), len(ys)))
    x = np.zeros((*y.shape, n_exog))
    for lane, (yy, xx) in enumerate(zip(ys, xs)):
        if sizes[lane]:
            y[-sizes[lane] :, lane] = yy
        for k in range(n_exog if sizes[lane] else 0):
            x[-sizes[lane] :, lane, k] = xx[k]
    return y, x, len(y) - sizes


def _fit_block(pdf, block, n_exog, s, sample, max_iter) -> pd.DataFrame:
    rows = np.array([i for i, _ in block])
    trials = np.array([t for _, t in block])
    orders = trials[:, 1:]
    y, x, pad = stack_lanes(pdf["y"].iloc[rows], pdf["x"].iloc[rows], n_exog)
    usable = np.isfinite(y).all(axis=0) & np.isfinite(x).all(axis=(0, 2))
    own = css.warmup(*(orders[:, c] for c in (css.P_, css.D_, css.SP, css.SD)), s)
    skip = sample.skipped(len(y) - pad) if sample else own
    n = len(y) - pad - skip
    k = n_exog + orders[:, [css.P_, css.Q_, css.SP, css.SQ, css.CONST]].sum(axis=1) + 1
    usable &= (n > k) & (own <= skip)
    out = pdf.iloc[rows].drop(columns=["y", "x", "trials"]).reset_index(drop=True)
    out[RESULT.names[:8]] = trials
    out["n_obs"] = len(y) - pad
    out["aic"] = out["bic"] = out["sigma2"] = np.nan
    out["converged"] = out["at_iteration_limit"] = False
    out["params"] = None
    fit = np.flatnonzero(usable)
    if len(fit):
        params, sse, ok, running, lay = css.fit(
            y[:, fit], x[:, fit], orders[fit], (pad + skip)[fit], s, max_iter
        )
        aic, bic = css.information_criteria(sse, n[fit], k[fit])
        free = lay.free(orders[fit])
        for name, values in (("aic", aic), ("bic", bic), ("sigma2", sse / n[fit])):
            out.loc[fit, name] = np.where(ok, values, np.nan)
        out.loc[fit, "converged"] = ok
        out.loc[fit, "at_iteration_limit"] = running
        kept = [list(p[m]) if good else None for p, m, good in zip(params, free, ok)]
        out["params"] = pd.Series(kept, index=fit, dtype=object).reindex(out.index)
    for name in ("aic", "bic", "sigma2"):
        out[name] = out[name].astype(object).where(out[name].notna(), None)
    out["params"] = out["params"].where(out["params"].notna(), None)
    return out


def fit_trials(
    packed: DataFrame,
    n_exog: int,
    sample: Sample | None = None,
    s: int = SEASON,
    max_iter: int = MAX_ITER,
) -> DataFrame:
    """Fit each order in ``trials`` (``[trial_id, p, d, q, P, D, Q, intercept]``) of each row.

    A search passes the ``sample`` its orders share; without one, each order is fitted on all
    days but those that its own lags need. An order is refused only if no more days than
    parameters are left. ``converged`` says that the sum of squares is finite,
    ``at_iteration_limit`` that it was still falling after ``max_iter`` steps.
    ``packed`` has key columns, ``y``, ``x`` and ``trials``. ``params`` lists the estimated
    values in the order regressors, intercept, AR, seasonal AR, MA, seasonal MA.
    """
    keys = [f for f in packed.schema if f.name not in ("y", "x", "trials")]

    def run(batches):
        for pdf in batches:
            for block in _lane_blocks(pdf):
                yield _fit_block(pdf, block, n_exog, s, sample, max_iter)

    return packed.mapInPandas(run, T.StructType([*keys, *RESULT]))


def task_count(packed: DataFrame, blocks: int = 1, rows_per_task: int = 64) -> int:
    """Tasks for a fit: one per core at least, and short enough to be cheap to lose."""
    rows = packed.count() * blocks
    cores = packed.sparkSession.sparkContext.defaultParallelism
    return max(cores, min(-(-rows // rows_per_task), 100_000))


def grid_search(
    packed: DataFrame,
    keys: list[str],
    n_exog: int,
    space: dict[str, list[int]] = SPACE,
    blocks: int = 1,
    partitions: int | None = None,
    s: int = SEASON,
) -> DataFrame:
    """All trials of the grid for every packed series.

    With many series one block of orders per series moves each series once. With few, more
    blocks spread the grid over the cores at the price of as many copies of the series. An
    explicit partition count keeps tiny but slow rows from being merged into one task; left
    out, it comes from a count of ``packed``, which is then best persisted.
    """
    n = grid_size(space)
    blocks = min(blocks, n)
    parts = partitions or task_count(packed, blocks)
    trial = lambda t: F.array(
        t.cast("int"), *order_columns(t, space), F.lit(0)
    )
    spread = (
        packed.select(
            *keys, "y", "x", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
        )
        .withColumn("trials", F.sequence(F.col("block"), F.lit(n - 1), F.lit(blocks)))
        .withColumn("trials", F.transform("trials", trial))
        .drop("block")
        .repartition(parts)
    )
    return fit_trials(spread, n_exog, search_sample(space, n_exog, s), s)


def best_trials(trials: DataFrame, keys: list[str]) -> DataFrame:
    """Trial with the lowest finite AIC of each series; ties go to the earliest trial.

    A series without any finite trial gets the fallback order, marked not converged.
    Partial aggregation keeps one candidate per series before the shuffle.
    """
    named = [*ORDER_COLS, "intercept", "bic", "sigma2", "params"]
    pick = F.min_by(
        F.struct("trial_id", "aic", *named),
        F.when(is_finite(F.col("aic")), F.struct("aic", "trial_id")),
    )
    best = trials.groupBy(*keys).agg(
        pick.alias("b"),
        F.count(F.lit(1)).alias("total_trials"),
        F.count_if("converged").alias("successful_trials"),
    )
    orders = [F.coalesce(F.col(f"b.{c}"), F.lit(FALLBACK[c])).alias(c) for c in ORDER_COLS]
    return best.select(
        *keys,
        F.col("b.trial_id").alias("trial_id"),
        *orders,
        F.coalesce("b.intercept", F.lit(0)).alias("intercept"),
        F.col("b.aic").alias("aic"),
        F.col("b.bic").alias("bic"),
        F.col("b.sigma2").alias("sigma2"),
        F.col("b.params").alias("params"),
        F.col("b").isNotNull().alias("converged"),
        "total_trials",
        "successful_trials",
    )


def fit_orders(
    packed: DataFrame,
    orders: DataFrame | dict[str, int],
    keys: list[str],
    n_exog: int,
    s: int = SEASON,
) -> DataFrame:
    """Fit one given order per series: the same for all, or a table with the keys and the
    order columns. Tasks follow the number of series; ``packed`` is best written before."""
    series = packed.select(*keys, "y", "x")
    names = [*ORDER_COLS, "intercept"]
    if isinstance(orders, dict):
        values = [F.lit(orders.get(c, 0)) for c in names]
        rows = series.withColumn("trials", F.array(F.array(F.lit(0), *values)))
    else:
        values = [F.col(c).cast("int") if c in orders.columns else F.lit(0) for c in names]
        rows = series.join(orders.select(*keys, F.array(F.array(F.lit(0), *values)).alias("trials")), keys)
    return fit_trials(rows.repartition(task_count(series)), n_exog, None, s).drop("trial_id")


def refit_best(packed: DataFrame, best: DataFrame, keys: list[str], n_exog: int, s: int = SEASON) -> DataFrame:
    """The chosen order of every series, estimated on all its days.

    The sample that trials share only ranks them. Where the order cannot be fitted to the whole
    series, parameters stay null.
    """
    again = fit_orders(packed, best, keys, n_exog, s)
    own = ["n_obs", "sigma2", "params", "at_iteration_limit"]
    return best.drop(*own).join(again.select(*keys, *own), keys, "left")


# Bounds of the stepwise search, its four first orders
# (p, d, q, seasonal p, d, q, intercept), and its moves.
STEP_BOUNDS = {
    "p": 7, "d": 2, "q": 3, "seasonal_p": 2, "seasonal_d": 1, "seasonal_q": 2, "intercept": 1,
}
STEP_STARTS = [
    (2, 1, 2, 1, 1, 1, 1),
    (0, 1, 0, 0, 1, 0, 1),
    (1, 1, 0, 1, 1, 0, 1),
    (0, 1, 1, 0, 1, 1, 1),
]


def _moves() -> list[tuple[int, ...]]:
    """One order up or down, both orders of the same kind of lag together, or the intercept."""
    names = list(STEP_BOUNDS)
    single = [
        tuple(step if n == name else 0 for n in names)
        for name, step in product(names, (-1, 1))
    ]
    both = [
        tuple(step if n in pair else 0 for n in names)
        for pair, step in product((("p", "q"), ("seasonal_p", "seasonal_q")), (-1, 1))
    ]
    return single + both


def stepwise_search(
    packed: DataFrame,
    keys: list[str],
    n_exog: int,
    blocks: int = 1,
    s: int = SEASON,
    differences: DataFrame | None = None,
) -> DataFrame:
    """Walk from four first orders to the neighbour with the lowest AIC, all series at once.

    ``differences`` (keys, d, seasonal_d; a row per series) fixes how often each series is differenced, so that
    AIC only compares orders of one and the same differenced series; without it the walk moves d and seasonal_d too.
    ``blocks`` tasks share the orders of one series and round, worth it when series are few.

    One Spark round per step: expand the neighbours of the series that improved, drop those
    tried before with an anti join, fit the rest, update the incumbents. Rounds are cut by
    checkpoints of the small trial table; the packed series are persisted, not moved again
    once a series has settled. The walk ends when no series has an untried neighbour of a better
    order left; orders are finite, so it does. Returns all trials, numbered in the order they
    were made.
    """
    from demandloom.operators.runs import checkpointed  # runs builds on this module

    names = list(STEP_BOUNDS)
    order_struct = lambda t: F.struct(*[F.lit(v).alias(n) for n, v in zip(names, t)])
    sample = search_sample({n: list(range(top + 1)) for n, top in STEP_BOUNDS.items()}, n_exog, s)
    packed = checkpointed(packed.select(*keys, "y", "x"))
    parts = task_count(packed, blocks)

    def fit_round(orders: DataFrame, offset: int) -> DataFrame:
        row = F.array(F.col("trial_id"), *names)
        block = F.pmod("trial_id", F.lit(blocks)).alias("block")
        wanted = orders.groupBy(*keys, block).agg(F.collect_list(row).alias("trials"))
        spread = packed.join(wanted.drop("block"), keys).repartition(parts)
        fitted = fit_trials(spread, n_exog, sample, s)
        return checkpointed(fitted.withColumn("round", F.lit(offset)))

    first = F.posexplode(F.array(*[order_struct(t) for t in STEP_STARTS])).alias("trial_id", "o")
    starts = packed.select(*keys, first).select(*keys, "trial_id", "o.*")
    moves = _moves()
    if differences is not None:
        fixed = ("d", "seasonal_d")
        starts = starts.drop(*fixed).join(checkpointed(differences.select(*keys, *fixed)), keys)
        starts = starts.select(*keys, "trial_id", *names)
        moves = [m for m in moves if not any(m[names.index(n)] for n in fixed)]
    trials = fit_round(starts, 0)
    deltas = F.array(*[order_struct(t) for t in moves])
    for turn in count(1):
        finite = trials.where(is_finite(F.col("aic")))
        incumbent = finite.groupBy(*keys).agg(
            F.min_by(F.struct("round", *names), F.struct("aic", "trial_id")).alias("b")
        )
        improved = incumbent.where(F.col("b.round") == turn - 1)
        neighbours = improved.select(
            *keys, "b", F.posexplode(deltas).alias("move", "m")
        ).select(
            *keys,
            (F.lit(turn * 100) + F.col("move")).cast("int").alias("trial_id"),
            *[(F.col(f"b.{n}") + F.col(f"m.{n}")).alias(n) for n in names],
        )
        for n in names:
            neighbours = neighbours.where(F.col(n).between(0, STEP_BOUNDS[n]))
        fresh = neighbours.join(trials.select(*keys, *names), [*keys, *names], "left_anti")
        made = fit_round(fresh, turn)
        if made.isEmpty():
            return trials
        trials = trials.unionByName(made)
