"""Partition-independent random numbers as pure Column expressions.

``rand(seed)`` depends on partitioning, so a re-partitioned or re-run job
would see different values.  Here every draw is a hash of the row key and a
salt: the same key always gets the same value, on any executor, in any
partition layout, and DuckDB can reproduce it bit-for-bit.

Each helper returns a ``Column``; all work stays inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = 4503599627370496.0


def uniform(key: Column, salt: str) -> Column:
    """U[0,1) from the first 52 bits of md5(key || '|' || salt)."""
    digest = F.md5(F.concat(key.cast("string"), F.lit("|" + salt)))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
    return bits.cast("double") / F.lit(TWO_POW_52)


def uniforms(key: Column, salt: str, n: int) -> list[Column]:
    """n independent uniforms: salts ``salt.0 .. salt.(n-1)``."""
    return [uniform(key, f"{salt}.{i}") for i in range(n)]


def randint(u: Column, low: int, high: int) -> Column:
    """Integer in [low, high) from one uniform."""
    return F.floor(F.lit(float(low)) + F.lit(float(high - low)) * u).cast("int")


def normal(u1: Column, u2: Column, mean: float = 0.0, sd: float = 1.0) -> Column:
    """Box-Muller normal; ``ln(1-u)`` keeps the log finite since u < 1."""
    z = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
    return F.lit(float(mean)) + F.lit(float(sd)) * z


def exponential(u: Column, mean: float) -> Column:
    return F.lit(-float(mean)) * F.log(F.lit(1.0) - u)


def gamma_int_shape(us: Sequence[Column], scale: float) -> Column:
    """Gamma(k, scale) for integer k = len(us): sum of k exponentials."""
    acc = F.log(F.lit(1.0) - us[0])
    for u in us[1:]:
        acc = acc + F.log(F.lit(1.0) - u)
    return F.lit(-float(scale)) * acc


def beta_order_stat(us: Sequence[Column], k: int) -> Column:
    """Beta(k, n+1-k) as the k-th smallest of n uniforms (1-based k)."""
    return F.sort_array(F.array(*us))[k - 1]


def beta_half_int(z: Column, u_half: Column, us_b: Sequence[Column]) -> Column:
    """Beta(1.5, len(us_b)): G(1.5)/(G(1.5)+G(b)).

    G(1.5) = Exp(1) + z^2/2 with z standard normal; G(b) = sum of b Exp(1).
    """
    g1 = F.lit(-1.0) * F.log(F.lit(1.0) - u_half) + z * z / F.lit(2.0)
    g2 = gamma_int_shape(us_b, 1.0)
    return g1 / (g1 + g2)


def beta_one(u: Column, b: float) -> Column:
    """Beta(1, b) by inverse CDF: 1 - (1-u)^(1/b)."""
    return F.lit(1.0) - F.pow(F.lit(1.0) - u, F.lit(1.0 / b))


def weighted_choice(u: Column, choices: Sequence[tuple[str, float]]) -> Column:
    """Categorical draw: first label whose cumulative weight exceeds u."""
    expr = None
    acc = 0.0
    for label, weight in choices[:-1]:
        acc += weight
        cond = u < F.lit(acc)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    last = F.lit(choices[-1][0])
    return last if expr is None else expr.otherwise(last)


def bernoulli(u: Column, p: float | Column) -> Column:
    return u < (p if isinstance(p, Column) else F.lit(float(p)))


def clip(x: Column, lo: float, hi: float) -> Column:
    """Clamp to [lo, hi] (numpy ``clip``)."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), x))
