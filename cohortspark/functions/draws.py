"""Random draws from the hypergeometric distribution, for numbers up to 1e15."""

from __future__ import annotations

import math

import numpy as np


def _exact_remainders(n: int) -> np.ndarray:
    """What Stirling's formula leaves out of log(k!) for k below ``n``; 0 gets none."""
    k = np.arange(1, n)
    log_factorial = np.cumsum(np.log(k.astype(float)))
    return np.concatenate([[0.0], log_factorial - ((k + 0.5) * np.log(k) - k + 0.5 * math.log(2 * math.pi))])


_SMALL = _exact_remainders(16)


def stirling_remainder(n: np.ndarray) -> np.ndarray:
    """log(n!) without Stirling's formula, (n + 1/2) log n - n + log(2 pi) / 2: at most 0.1."""
    x = np.maximum(n, 16).astype(float)
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / x**2) / x**2) / x**2) / x
    return np.where(n < 16, _SMALL[np.clip(n, 0, 15)], series)


def deviance(k: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """k log(k / mean) + mean - k, without the loss of digits where k is near the mean."""
    k, mean = np.broadcast_arrays(np.asarray(k, float), np.asarray(mean, float))
    gap, both = k - mean, k + mean
    v = np.divide(gap, both, out=np.zeros(k.shape), where=both > 0)
    # k log((1 + v) / (1 - v)) = 2 k (v + v^3 / 3 + ...), of which the first term goes with mean - k
    tail, power = np.zeros(k.shape), v * v * v
    for j in range(1, 12):
        tail += power / (2 * j + 1)
        power = power * v * v
    near = gap * v + 2 * k * tail
    with np.errstate(divide="ignore", invalid="ignore"):
        far = np.where(k > 0, k * np.log(k / mean), 0.0) + mean - k
    return np.where(np.abs(v) < 0.1, near, far)


def log_binomial(k: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Logarithm of the binomial probability, by its saddle-point form, but for a constant.

    Both deviances are small numbers near the mean, where logarithms of factorials would be large ones
    that cancel. ``k`` must lie from 0 to ``n``. The constant depends on ``n`` alone.
    """
    k, n, p = np.broadcast_arrays(np.asarray(k, float), np.asarray(n, float), np.asarray(p, float))
    rest = n - k
    out = -stirling_remainder(k.astype(np.int64)) - stirling_remainder(rest.astype(np.int64))
    out = out - deviance(k, n * p) - deviance(rest, n * (1 - p))
    # the ends have no square root of k or of n - k
    return out - 0.5 * np.log(np.maximum(k, 1 / (2 * math.pi))) - 0.5 * np.log(np.maximum(rest, 1 / (2 * math.pi)))


def log_weight(k: np.ndarray, good: np.ndarray, bad: np.ndarray, sample: np.ndarray) -> np.ndarray:
    """Logarithm of the hypergeometric probability of ``k`` good ones, but for a constant."""
    share = sample / (good + bad).astype(float)
    return log_binomial(k, good, share) + log_binomial(sample - k, bad, share)


def hypergeometric(rng: np.random.Generator, good: np.ndarray, bad: np.ndarray, sample: np.ndarray) -> np.ndarray:
    """How many of ``sample`` drawn without replacement are among the ``good``, element by element.

    Ratio of uniforms around the mean with the probability relative to the mode, so the work does
    not depend on the numbers.
    """
    good, bad, sample = np.broadcast_arrays(*(np.asarray(a, np.int64) for a in (good, bad, sample)))
    low, high = np.maximum(0, sample - bad), np.minimum(sample, good)
    out = low.copy()
    todo = np.flatnonzero(high > low)
    if not len(todo):
        return out
    g, b, s = (a.ravel()[todo].astype(np.int64) for a in (good, bad, sample))
    lo, hi = low.ravel()[todo], high.ravel()[todo]
    total = (g + b).astype(float)
    mean = s * (g / total)
    spread = mean * (b / total) * ((total - s) / np.maximum(total - 1, 1))
    width = 2 * math.sqrt(2 / math.e) * np.sqrt(spread + 0.5) + 3 - 2 * math.sqrt(3 / math.e)

    def weight(k: np.ndarray, i: np.ndarray | slice) -> np.ndarray:
        return log_weight(k, g[i], b[i], s[i])

    mode = np.clip(np.floor((s + 1.0) * ((g + 1.0) / (total + 2))).astype(np.int64), lo, hi)
    peak = weight(mode, slice(None))
    flat = out.ravel()
    open_ = np.arange(len(todo))
    while len(open_):
        u = 1 - rng.random(len(open_))
        k = np.floor(mean[open_] + 0.5 + width[open_] * (rng.random(len(open_)) - 0.5) / u)
        inside = (k >= lo[open_]) & (k <= hi[open_])
        k = np.clip(k, lo[open_], hi[open_]).astype(np.int64)
        hit = inside & (2 * np.log(u) <= weight(k, open_) - peak[open_])
        flat[todo[open_[hit]]] = k[hit]
        open_ = open_[~hit]
    return flat.reshape(out.shape)


def dealt(rng: np.random.Generator, left: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Deals ``sizes[d]`` of draw d among levels of which ``left[d, level]`` remain, without replacement."""
    out = np.zeros_like(left)
    need, pool = sizes.astype(np.int64).copy(), left.sum(1)
    for level in range(left.shape[1]):
        own = left[:, level]
        out[:, level] = hypergeometric(rng, own, pool - own, need)
        need -= out[:, level]
        pool = pool - own
    return out
