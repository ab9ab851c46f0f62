"""The negative binomial distribution by mean and dispersion: variance = mean + dispersion * mean^2."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Coefficients of Stirling's series for the logarithm of the gamma function.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)
#: Arguments are raised by this much before the series is used.
_RAISED = 7
#: Relative slack of a quantile, so that the quantile of a distribution's own value is its argument.
SLACK = 64 * np.finfo(float).eps


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function of a positive column, in built-in functions."""
    y = x + _RAISED
    series = sum((F.lit(c) / F.pow(y, F.lit(float(2 * k + 1))) for k, c in enumerate(_STIRLING)), F.lit(0.0))
    below = F.lit(0.0)
    for k in range(_RAISED):
        below = below + F.log(x + k)
    return (y - 0.5) * F.log(y) - y + F.lit(0.5 * np.log(2 * np.pi)) + series - below


def log_likelihood(n: Column, mu: Column, phi: Column) -> Column:
    """Log probability of a count; zero where the mean is zero and so is the count."""
    size = 1 / phi
    told = log_gamma(n + size) - log_gamma(size) - log_gamma(n + F.lit(1.0)) - (n + size) * F.log1p(phi * mu) + F.when(n > 0, n * F.log(phi * mu)).otherwise(0.0)
    return F.when(mu > 0, told).otherwise(0.0)


def _lgamma(x: np.ndarray) -> np.ndarray:
    y = x + _RAISED
    series = sum(c / y ** (2 * k + 1) for k, c in enumerate(_STIRLING))
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - sum(np.log(x + k) for k in range(_RAISED))


def _beta_fraction(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function, by the modified Lentz recurrence, all elements at once."""
    tiny = 1e-300
    sound = lambda v: np.where(np.abs(v) < tiny, tiny, v)
    c, d = np.ones_like(x), 1 / sound(1 - (a + b) * x / (a + 1))
    h, live = d.copy(), np.arange(len(x))
    for m in range(1, 20_000):
        xs, p, q = x[live], a[live], b[live]
        even = m * (q - m) * xs / ((p + 2 * m - 1) * (p + 2 * m))
        d[live] = 1 / sound(1 + even * d[live])
        c[live] = sound(1 + even / c[live])
        h[live] *= d[live] * c[live]
        odd = -(p + m) * (p + q + m) * xs / ((p + 2 * m) * (p + 2 * m + 1))
        d[live] = 1 / sound(1 + odd * d[live])
        c[live] = sound(1 + odd / c[live])
        step = d[live] * c[live]
        h[live] *= step
        live = live[np.abs(step - 1) > 1e-15]
        if not len(live):
            break
    return h


def incomplete_beta(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function; the side of the fraction that converges fast is taken."""
    turn = x > (a + 1) / (a + b + 2)
    x2, a2, b2 = np.where(turn, 1 - x, x), np.where(turn, b, a), np.where(turn, a, b)
    inner = (x2 > 0) & (x2 < 1)
    safe = np.where(inner, x2, 0.5)
    front = np.exp(_lgamma(a2 + b2) - _lgamma(a2) - _lgamma(b2) + a2 * np.log(safe) + b2 * np.log1p(-safe)) / a2
    part = np.where(inner, front * _beta_fraction(safe, a2, b2), np.where(x2 >= 1, 1.0, 0.0))
    return np.clip(np.where(turn, 1 - part, part), 0.0, 1.0)


def cdf(k: np.ndarray, mu: np.ndarray, phi: np.ndarray) -> np.ndarray:
    """Probability of at most ``k``."""
    k, mu, phi = (np.asarray(v, float) for v in np.broadcast_arrays(k, mu, phi))
    shape, k, mu, phi = k.shape, k.ravel(), mu.ravel(), phi.ravel()
    share = 1 / (1 + phi * mu)  # of a failure to come, in the urn picture
    inside = (k >= 0) & (mu > 0)
    told = incomplete_beta(np.where(inside, share, 0.5), 1 / phi, np.where(inside, np.floor(k), 0.0) + 1)
    return np.where(inside, told, np.where(k < 0, 0.0, 1.0)).reshape(shape)


def quantile(p: np.ndarray, mu: np.ndarray, phi: np.ndarray) -> np.ndarray:
    """The least count whose distribution function reaches ``p`` < 1: a doubled bracket, then halving, all elements at once."""
    p, mu, phi = (np.asarray(v, float).ravel() for v in np.broadcast_arrays(p, mu, phi))
    p = p * (1 - SLACK)
    low, high = np.full(len(p), -1.0), np.ceil(mu + 4 * np.sqrt(mu + phi * mu * mu)) + 1
    open_ = np.flatnonzero(cdf(high, mu, phi) < p)
    while len(open_):
        low[open_], high[open_] = high[open_], 2 * high[open_] + 1
        open_ = open_[(cdf(high[open_], mu[open_], phi[open_]) < p[open_]) & (high[open_] < 1e15)]
    live = np.flatnonzero(high - low > 1)
    while len(live):
        middle = np.floor((low[live] + high[live]) / 2)
        reached = cdf(middle, mu[live], phi[live]) >= p[live]
        high[live] = np.where(reached, middle, high[live])
        low[live] = np.where(reached, low[live], middle)
        live = live[high[live] - low[live] > 1]
    return high


def match(n: np.ndarray, old_mu: np.ndarray, old_phi: np.ndarray, new_mu: np.ndarray, new_phi: np.ndarray, keep_zero: bool) -> np.ndarray:
    """Counts of the new distribution at the quantiles of ``n`` in the old one; counts in the far tail stay as they are.

    With ``keep_zero`` counts of 0 and 1 stay too, and larger ones are placed by the quantile below them.
    """
    n = np.asarray(n, float)
    p = cdf(n - 1 if keep_zero else n, old_mu, old_phi)
    stays = np.abs(p - 1) < (1e-4 if keep_zero else 1e-6)
    stays |= keep_zero & (n <= 1)
    moved = quantile(np.where(stays, 0.5, p), new_mu, new_phi) + keep_zero
    return np.where(stays, n, moved).astype(np.int64)


def matched(n: Column, old_mu: Column, old_phi: Column, new_mu: Column, new_phi: Column, keep_zero: bool = False) -> Column:
    """``match`` over columns, in Arrow batches."""

    @pandas_udf("long")
    def told(n: pd.Series, old_mu: pd.Series, old_phi: pd.Series, new_mu: pd.Series, new_phi: pd.Series) -> pd.Series:
        return pd.Series(match(n.to_numpy(), old_mu.to_numpy(), old_phi.to_numpy(), new_mu.to_numpy(), new_phi.to_numpy(), keep_zero))

    return told(n, old_mu, old_phi, new_mu, new_phi)
