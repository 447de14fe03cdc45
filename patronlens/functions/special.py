"""Gamma-family functions.

Spark has neither ``lgamma`` nor ``digamma`` nor the Gauss hypergeometric function. The hypergeometric series is column
arithmetic, for predictions; the gamma functions work on numpy arrays, for the sums that tasks make of likelihoods.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Bernoulli numbers B2, B4, ... B14 of the Stirling series.
BERNOULLI = [1 / 6, -1 / 30, 1 / 42, -1 / 30, 5 / 66, -691 / 2730, 7 / 6]
SHIFT = 8
HALF_LOG_TWO_PI = 0.5 * math.log(2.0 * math.pi)


def log_gamma(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ln Gamma, its slope and its curvature for positive numbers.

    The argument is shifted past 8, where the Stirling series is exact to double precision.
    """
    y = z + SHIFT
    steps = z[:, None] + np.arange(SHIFT)
    powers = [(b, k, y ** (-2.0 * k)) for k, b in enumerate(BERNOULLI, start=1)]
    value = (y - 0.5) * np.log(y) - y + HALF_LOG_TWO_PI + y * sum(b / (2 * k * (2 * k - 1)) * p for b, k, p in powers)
    slope = np.log(y) - 0.5 / y - sum(b / (2 * k) * p for b, k, p in powers)
    curvature = 1 / y + 0.5 / (y * y) + sum(b * p for b, _, p in powers) / y
    return (
        value - np.log(steps).sum(axis=1),
        slope - (1 / steps).sum(axis=1),
        curvature + (1 / (steps * steps)).sum(axis=1),
    )


def hyp2f1(a: Column, b: Column, c: Column, z: Column) -> Column:
    """Gauss series of 2F1(a, b; c; z) for 0 <= z < 1, with as many terms as double precision takes.

    The n-th term shrinks like z**n, so 40 / -ln(z) terms, and some for the growth of the other factors, are enough. For
    a c of 16 or more, large beside a and b, 4 * c terms are enough as well, however near to one z is.
    """
    needed = F.ceil(F.lit(12.0) - F.lit(40.0) / F.ln(F.greatest(z, F.lit(1e-12))))
    by_size = F.ceil(F.lit(40.0) + F.lit(4.0) * (c + F.abs(a) + F.abs(b)))
    terms = F.when(c >= F.lit(16.0), F.least(needed, by_size)).otherwise(needed).cast("int")

    def step(state: Column, n: Column) -> Column:
        term = state["term"]
        ratio = (a + n) * (b + n) / ((c + n) * (n + F.lit(1.0))) * z
        return F.struct((term * ratio).alias("term"), (state["total"] + term).alias("total"))

    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))
    index = F.transform(F.sequence(F.lit(0), terms), lambda n: n.cast("double"))
    return F.aggregate(index, start, step, lambda state: state["total"])


def signed_log_gamma(x: float) -> tuple[float, float]:
    """Sign of Gamma(x) and ln of its size; a pole has an infinite size."""
    if x <= 0 and x == math.floor(x):
        return 1.0, math.inf
    return (1.0 if x > 0 or math.floor(x) % 2 == 0 else -1.0), math.lgamma(x)


def gamma_quotient(over: list[float], under: list[float]) -> float:
    """Product of Gamma over ``over`` by product of Gamma over ``under``; zero at a pole below."""
    sign, size = 1.0, 0.0
    for values, way in ((over, 1.0), (under, -1.0)):
        for x in values:
            s, log = signed_log_gamma(x)
            sign, size = sign * s, size + way * log
    return sign * math.exp(size)


def hyp2f1_near_one(a: float, b: float, c_less: float, n: Column, z: Column, rest: Column, most: int) -> Column:
    """2F1(a, b; c_less + n; z) for z near one, by the connection formula in ``rest`` = 1 - z.

    ``n`` is a whole number from 0 to ``most``, so the gamma factors are a short list. ``c_less - a - b`` must not be whole.
    """
    gap = c_less - a - b
    first = [gamma_quotient([c_less + k, gap + k], [c_less + k - a, c_less + k - b]) for k in range(most + 1)]
    second = [gamma_quotient([c_less + k, -gap - k], [a, b]) for k in range(most + 1)]
    at = n.cast("int")
    c = F.lit(c_less) + n
    one = hyp2f1(F.lit(a), F.lit(b), F.lit(1.0 - gap) - n, rest)
    two = hyp2f1(c - F.lit(a), c - F.lit(b), F.lit(1.0 + gap) + n, rest)
    scale = F.pow(rest, F.lit(gap) + n)
    pick_first, pick_second = (F.get(F.array(*[F.lit(v) for v in values]), at) for values in (first, second))
    return pick_first * one + pick_second * scale * two
