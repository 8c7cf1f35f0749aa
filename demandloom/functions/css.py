"""Conditional-sum-of-squares estimation of regressions with seasonal ARMA errors.

A *lane* is one (series, order) pair. All arrays are time-major, ``[T, lanes, ...]``, so
one numpy operation advances every lane of an Arrow batch by one day. Lanes of different
length are aligned at their last day; ``start`` holds each lane's first scored day.

    phi(B) PHI(B^s) (1-B)^d (1-B^s)^D (y - X beta) = c + theta(B) THETA(B^s) e

Innovations before ``start`` are zero, and every order of a series is scored on the same
days, so AIC is comparable across d and D.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

P_, D_, Q_, SP, SD, SQ, CONST = range(7)  # columns of an order row


@dataclass
class Layout:
    """Where each kind of parameter sits in a lane's parameter vector."""

    n_exog: int
    p: int
    q: int
    sp: int
    sq: int
    s: int

    def __post_init__(self):
        bounds = np.cumsum([0, self.n_exog, 1, self.p, self.sp, self.q, self.sq])
        names = ("beta", "const", "ar", "sar", "ma", "sma")
        self.at = {n: slice(a, b) for n, a, b in zip(names, bounds, bounds[1:])}
        self.size = int(bounds[-1])

    def free(self, orders: np.ndarray) -> np.ndarray:
        """Mask ``[lanes, size]`` of the parameters each order estimates."""
        mask = np.zeros((len(orders), self.size), bool)
        mask[:, self.at["beta"]] = True
        mask[:, self.at["const"]] = orders[:, [CONST]] > 0
        for name, col in (("ar", P_), ("sar", SP), ("ma", Q_), ("sma", SQ)):
            width = self.at[name].stop - self.at[name].start
            mask[:, self.at[name]] = np.arange(width) < orders[:, [col]]
        return mask


def lag_polynomial(coef: np.ndarray, sign: float, step: int) -> np.ndarray:
    """``1 + sign * (coef_1 B^step + coef_2 B^(2 step) + ...)`` per lane."""
    out = np.zeros((len(coef), coef.shape[1] * step + 1))
    out[:, 0] = 1.0
    out[:, step::step] = sign * coef
    return out


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), a.shape[1] + b.shape[1] - 1))
    for k in range(b.shape[1]):
        out[:, k : k + a.shape[1]] += a * b[:, [k]]
    return out


def apply_polynomial(poly: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Lag polynomial of each lane applied along time."""
    out = np.zeros_like(x)
    tail = (1,) * (x.ndim - 2)
    for k in np.flatnonzero(np.any(poly != 0, axis=0)):
        out[k:] += poly[:, k].reshape(-1, *tail) * x[: max(len(x) - k, 0)]
    return out


def shift(x: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros_like(x)
    out[k:] = x[: max(len(x) - k, 0)]
    return out


def divide(coef: np.ndarray, step: int, x: np.ndarray) -> np.ndarray:
    """Divide by ``1 + coef_1 B^step + ...``: ``out_t = x_t - sum_j coef_j out_(t - j step)``.

    Time is cut into chunks that run side by side from zero; what each chunk inherits from
    the one before is added through the polynomial's response to its last values.
    """
    lanes = np.flatnonzero(np.any(coef != 0, axis=1))
    if not len(lanes):
        return x
    n, rest = coef.shape[1], (1,) * (x.ndim - 2)
    rows = -(-len(x) // step)
    size = max(n, int(rows**0.5))
    chunks = -(-rows // size)
    out = np.zeros((chunks * size * step, len(lanes), *x.shape[2:]))
    out[: len(x)] = x[:, lanes]
    y = out.reshape(chunks, size, step, *out.shape[1:])
    c = coef[lanes].T
    response = np.zeros((n, n + size, len(lanes)))  # [lag of the unit, time + n, lane]
    response[np.arange(n), n - 1 - np.arange(n)] = 1.0
    for b in range(size):
        for j in range(1, n + 1):
            response[:, n + b] -= c[j - 1] * response[:, n + b - j]
            if j <= b:
                y[:, b] -= c[j - 1].reshape(-1, *rest) * y[:, b - j]
    response = response[:, n:].reshape(n, size, len(lanes), *rest)
    inherited = np.zeros((chunks, n, *y.shape[2:]))
    for i in range(1, chunks):
        for j in range(1, n + 1):
            inherited[i, j - 1] = y[i - 1, size - j] + np.sum(
                response[:, size - j, None] * inherited[i - 1], axis=0
            )
    for j in range(n):
        y += response[j, None, :, None] * inherited[:, j, None]
    if len(lanes) == x.shape[1]:
        return out[: len(x)]
    x = x.copy()
    x[:, lanes] = out[: len(x)]
    return x


def invertible(coef: np.ndarray) -> np.ndarray:
    """Whether ``1 + coef_1 z + ...`` has all roots outside the unit circle, per lane."""
    a, ok = coef.copy(), np.ones(len(coef), bool)
    for k in range(coef.shape[1], 0, -1):
        last = a[:, [k - 1]]
        ok &= np.abs(last[:, 0]) < 1
        a = (a[:, : k - 1] - last * a[:, : k - 1][:, ::-1]) / np.where(last**2 < 1, 1 - last**2, 1)
    return ok


def difference(x: np.ndarray, orders: np.ndarray, s: int) -> np.ndarray:
    out = x.copy()
    for lag, col in ((1, D_), (s, SD)):
        for k in range(int(orders[:, col].max(initial=0))):
            lanes = orders[:, col] > k
            out[:, lanes] -= shift(out[:, lanes], lag)
    return out


def warmup(p, d, sp, sd, s):
    """Days an order needs before its first innovation. A search skips what its largest order
    needs for every trial, so that all are scored on the same sample."""
    return p + d + s * (sp + sd)


def _innovations(params, w, x, scored, lay):
    """Innovations of each lane and what the derivatives need."""
    theta, stheta = params[:, lay.at["ma"]], params[:, lay.at["sma"]]
    ar = lag_polynomial(params[:, lay.at["ar"]], -1.0, 1)
    sar = lag_polynomial(params[:, lay.at["sar"]], -1.0, lay.s)
    u = w - np.einsum("tlk,lk->tl", x, params[:, lay.at["beta"]])
    rhs = (apply_polynomial(multiply(ar, sar), u) - params[:, lay.at["const"]].T) * scored
    e = divide(theta, 1, divide(stheta, lay.s, rhs))
    return e, u, ar, sar, theta, stheta


def _jacobian(parts, x, scored, lay, used):
    """Derivatives of the innovations with respect to the ``used`` parameters.

    Innovations are zero before their first day, so those for the moving averages are lags of
    one series each. The others start from what lies before that day and are divided out.
    """
    e, u, ar, sar, theta, stheta = parts
    wide = [-apply_polynomial(multiply(ar, sar), x)]
    if used[lay.at["const"]].any():
        wide.append(-np.ones((*e.shape, 1)))
    for source, step, n in ((sar, 1, lay.p), (ar, lay.s, lay.sp)):
        lags = -apply_polynomial(source, u)
        wide += [shift(lags, step * j)[:, :, None] for j in range(1, n + 1)]
    wide = np.concatenate(wide, axis=2) * scored[:, :, None]
    cols = np.zeros((*e.shape, lay.size))
    before = np.flatnonzero(used[: lay.at["ma"].start])
    cols[:, :, before] = divide(theta, 1, divide(stheta, lay.s, wide))
    for name, coef, step in (("ma", theta, 1), ("sma", stheta, lay.s)):
        if lay.at[name].stop > lay.at[name].start:
            lags = -divide(coef, step, e)
            for j, col in enumerate(range(lay.at[name].start, lay.at[name].stop), 1):
                cols[:, :, col] = shift(lags, step * j)
    return cols[:, :, used]


def _least_squares(design, target):
    """Per-lane regression of ``target [T, lanes]`` on ``design [T, lanes, k]``."""
    a = np.ascontiguousarray(design.transpose(1, 0, 2))
    gram = a.transpose(0, 2, 1) @ a
    diag = np.einsum("lkk->lk", gram)
    gram += np.where(diag > 0, diag * 1e-12, 1.0)[:, :, None] * np.eye(gram.shape[1])
    return np.linalg.solve(gram, np.einsum("ltk,tl->lk", a, target)[:, :, None])[:, :, 0]


def _first_guess(w, x, scored, free, lay):
    """Hannan-Rissanen start: innovations of a long autoregression stand in for ``e``."""
    lags = [shift(w, k) for k in range(1, 2 * lay.s + 3)]
    design = np.concatenate([x, np.stack(lags, axis=2)], axis=2) * scored[:, :, None]
    long_ar = _least_squares(design, w * scored)
    e = w * scored - np.einsum("tlk,lk->tl", design, long_ar)
    cols = [x, np.ones((*w.shape, 1))]
    for source, step, n in ((w, 1, lay.p), (w, lay.s, lay.sp), (e, 1, lay.q), (e, lay.s, lay.sq)):
        cols += [shift(source, step * j)[:, :, None] for j in range(1, n + 1)]
    design = np.concatenate(cols, axis=2) * scored[:, :, None] * free
    guess = _least_squares(design, w * scored) * free
    return np.clip(guess, -0.95, 0.95, where=~_linear(lay), out=guess)


def _linear(lay):
    mask = np.zeros(lay.size, bool)
    mask[lay.at["beta"]] = mask[lay.at["const"]] = True
    return mask


def fit(y, x, orders, start, s=7, max_iter=50, tol=1e-7):
    """Levenberg-Marquardt on every lane at once; returns ``params, sse, ok, running, layout``,
    where ``running`` lanes had not settled after ``max_iter`` steps.

    Steps that leave the invertible region are refused: beyond it the conditional sum has no
    use, since innovations of another history would grow without bound. Stationarity is free.

    ``y [T, lanes]``, ``x [T, lanes, n_exog]``, ``orders [lanes, 7]``, ``start [lanes]``.
    """
    lay = Layout(x.shape[2], *(int(orders[:, c].max(initial=0)) for c in (P_, Q_, SP, SQ)), s)
    scored = (np.arange(len(y))[:, None] >= start).astype(float)
    y_unit = np.maximum(y.std(axis=0), 1e-12)
    x_unit = np.maximum(np.abs(x).max(axis=0), 1e-12)
    w = difference(y / y_unit, orders, s)
    xd = difference(x / x_unit, orders, s)

    free = lay.free(orders)
    used = np.ones(lay.size, bool)
    used[lay.at["const"]] = free[:, lay.at["const"]].any()
    width = int(used.sum())
    params = np.zeros((len(orders), lay.size))
    sse = np.full(len(orders), np.inf)
    damp = np.full(len(orders), 1e-3)
    gram = np.zeros((len(orders), width, width))
    grad = np.zeros((len(orders), width))
    eye = np.eye(width)
    active = np.arange(len(orders))
    step = np.zeros_like(params)
    opening = _first_guess(w, xd, scored, free, lay)
    with np.errstate(all="ignore"):
        for turn in range(max_iter):
            trial = params[active] + step[active]
            parts = _innovations(trial, w[:, active], xd[:, active], scored[:, active], lay)
            new = np.einsum("tl,tl->l", parts[0], parts[0])
            better = np.isfinite(new) & (new < sse[active])
            better &= invertible(trial[:, lay.at["ma"]]) & invertible(trial[:, lay.at["sma"]])
            gain = (sse[active] - new) / np.maximum(new, 1e-300)
            won = active[better]
            if len(won):
                params[won], sse[won] = trial[better], new[better]
                kept = [a[:, better] if i < 2 else a[better] for i, a in enumerate(parts)]
                jac = _jacobian(kept, xd[:, won], scored[:, won], lay, used)
                jac = np.ascontiguousarray(jac.transpose(1, 0, 2))
                jac *= free[won][:, None, used]
                gram[won] = jac.transpose(0, 2, 1) @ jac
                grad[won] = np.einsum("ltk,tl->lk", jac, kept[0])
            damp[active] = np.where(better, np.maximum(damp[active] / 10, 1e-9), damp[active] * 10)
            settled = (better & (gain < tol)) | (damp[active] > 1e6) | ~np.isfinite(sse[active])
            active = active[~settled]
            if not len(active):
                break
            if turn == 0:
                step[active] = opening[active]
                continue
            diag = np.einsum("lkk->lk", gram[active])
            ridge = np.where(diag > 0, diag * damp[active][:, None], 1.0)
            step[np.ix_(active, used)] = -np.linalg.solve(
                gram[active] + ridge[:, :, None] * eye, grad[active][:, :, None]
            )[:, :, 0]
    ok = np.isfinite(sse) & (sse > 0)
    running = np.isin(np.arange(len(orders)), active)
    params[:, lay.at["beta"]] *= (y_unit / x_unit.T).T
    params[:, lay.at["const"]] *= y_unit[:, None]
    return params, sse * y_unit**2, ok, running, lay


def information_criteria(sse, n, k):
    """Gaussian AIC and BIC at the sum-of-squares estimate of the variance."""
    with np.errstate(all="ignore"):
        llf = -n / 2 * (np.log(2 * np.pi * sse / n) + 1)
    return 2 * k - 2 * llf, k * np.log(n) - 2 * llf


def forecast(y, x, x_future, params, orders, start, lay):
    """Re-filter each lane's history with frozen parameters, then run ahead ``len(x_future)``
    days."""
    s = lay.s
    steps = len(x_future)
    beta = params[:, lay.at["beta"]]
    ar = multiply(
        lag_polynomial(params[:, lay.at["ar"]], -1.0, 1),
        lag_polynomial(params[:, lay.at["sar"]], -1.0, s),
    )
    ma = multiply(
        lag_polynomial(params[:, lay.at["ma"]], 1.0, 1),
        lag_polynomial(params[:, lay.at["sma"]], 1.0, s),
    )
    const = params[:, lay.at["const"]][:, 0]
    for lag, col in ((1, D_), (s, SD)):
        for k in range(int(orders[:, col].max(initial=0))):
            unit = np.zeros((len(orders), lag + 1))
            unit[:, 0], unit[:, lag] = 1.0, -1.0 * (orders[:, col] > k)
            ar = multiply(ar, unit)
    z = y - np.einsum("tlk,lk->tl", x, beta)
    scored = np.arange(len(y))[:, None] >= start
    e = (apply_polynomial(ar, z) - const) * scored
    e = divide(params[:, lay.at["ma"]], 1, divide(params[:, lay.at["sma"]], s, e))
    z = np.vstack([z, np.zeros((steps, z.shape[1]))])
    e = np.vstack([e, np.zeros((steps, e.shape[1]))])
    for t in range(len(y), len(z)):
        for k in range(1, min(ar.shape[1], t + 1)):
            z[t] -= ar[:, k] * z[t - k]
        for k in range(1, min(ma.shape[1], t + 1)):
            z[t] += ma[:, k] * e[t - k]
        z[t] += const
    return z[len(y) :] + np.einsum("tlk,lk->tl", x_future, beta)
