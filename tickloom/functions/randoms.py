"""Seeded random columns that depend only on the seed and the row's key.

A digest of (seed, key) gives two independent 52-bit uniforms. The value of a row is therefore the
same whatever the partitioning, and a task that runs again after an executor is lost repeats it.
Columns drawn with the same seed and keys are the same draw; give each its own ``stream``.
"""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALE = float(1 << 52)


def _digest(seed, keys, stream) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(str(stream)), *[k.cast("string") for k in keys]))


def _uniform_at(digest: Column, start: int) -> Column:
    return (F.conv(F.substring(digest, start, 13), 16, 10).cast("double") + 0.5) / _SCALE


def uniform(seed, *keys: Column, stream: int = 0) -> Column:
    """U(0, 1), never exactly 0 or 1."""
    return _uniform_at(_digest(seed, keys, stream), 1)


def gaussian(seed, *keys: Column, mean: float = 0.0, sd: float = 1.0, stream: int = 0) -> Column:
    """N(mean, sd) by the Box–Muller transform of the two uniforms of one digest."""
    digest = _digest(seed, keys, stream)
    radius = F.sqrt(-2.0 * F.ln(_uniform_at(digest, 1)))
    return mean + sd * radius * F.cos(2.0 * math.pi * _uniform_at(digest, 14))


def bernoulli(seed, *keys: Column, p: float, stream: int = 0) -> Column:
    return (uniform(seed, *keys, stream=stream) < p).cast("int")


def exponential(seed, *keys: Column, rate: float, stream: int = 0) -> Column:
    return -F.ln(1.0 - uniform(seed, *keys, stream=stream)) / rate


def binomial(seed, *keys: Column, trials: int, p: float) -> Column:
    """Successes in ``trials`` independent draws, each from its own stream."""
    draws = [bernoulli(seed, *keys, p=p, stream=i) for i in range(trials)]
    return sum(draws[1:], draws[0])


def normal_vector(seed, *keys: Column, width: int) -> Column:
    """Array of ``width`` standard normals."""
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda j: gaussian(seed, *keys, j))
