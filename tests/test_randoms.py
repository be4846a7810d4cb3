"""Moments of the random columns, and their independence of partitioning."""

import pytest
from pyspark.sql import functions as F

from tickloom.functions import randoms as rnd

N = 20_000


@pytest.mark.parametrize("draw, mean, var", [
    (lambda k: rnd.uniform(1, k), 0.5, 1 / 12),
    (lambda k: rnd.gaussian(1, k), 0.0, 1.0),
    (lambda k: rnd.gaussian(1, k, mean=52, sd=13), 52.0, 169.0),
    (lambda k: rnd.bernoulli(1, k, p=0.8), 0.8, 0.16),
    (lambda k: rnd.exponential(1, k, rate=0.4), 2.5, 6.25),
    (lambda k: rnd.binomial(1, k, trials=3, p=0.4), 1.2, 0.72),
])
def test_moments(spark, draw, mean, var):
    m, v = spark.range(N).select(draw(F.col("id")).cast("double").alias("x")).agg(F.avg("x"), F.var_samp("x")).head()
    assert m == pytest.approx(mean, abs=5 * (var / N) ** 0.5)
    assert v == pytest.approx(var, rel=0.1)


def test_values_do_not_depend_on_partitioning(spark):
    few, many = spark.range(500).repartition(2), spark.range(500).repartition(13)
    value = rnd.gaussian(3, F.col("id")).alias("x")
    assert sorted(r["x"] for r in few.select(value).collect()) == sorted(r["x"] for r in many.select(value).collect())


def test_seeds_and_streams_differ(spark):
    k = F.col("id")
    row = spark.range(1).select(rnd.uniform(1, k), rnd.uniform(2, k), rnd.uniform(1, k, stream=1)).head()
    assert len(set(row)) == 3


def test_vectors_have_independent_values(spark):
    v = spark.range(1).select(rnd.normal_vector(1, F.col("id"), width=10).alias("v")).head()["v"]
    assert len(set(v)) == 10
