"""Queries: seeded random columns, one draw per table row or matrix cell."""

from pyspark.sql import functions as F

from tickloom.functions import randoms as rnd
from tickloom.operators import matrix as mx
from tickloom.plans import base as b
from tickloom.plans.registry import query

SEED = 7


def _u(keys, start=1, stream=0, seed=SEED):
    text = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return (f"(CAST(CONCAT('0x', substr(md5('{seed}|{stream}|' || {text}), {start}, 13)) AS BIGINT) + 0.5::DOUBLE)"
            f" / 4503599627370496.0::DOUBLE")


def _n(keys, seed=SEED, stream=0):
    first, second = (_u(keys, at, stream, seed) for at in (1, 14))
    return f"sqrt(-2.0::DOUBLE * ln({first})) * cos(2.0::DOUBLE * pi() * ({second}))"


def _events(spark, d, **cols):
    return b.table(spark, d, "events").select("event_id", *[c.alias(n) for n, c in cols.items()])


KEY = ["event_id"]


@query("random_uniform", f"SELECT event_id, ROUND({_u(KEY)}, 9) AS u FROM events")
def random_uniform(spark, d):
    return _events(spark, d, u=F.round(rnd.uniform(SEED, F.col("event_id")), 9))


@query("random_normal", f"SELECT event_id, ROUND({_n(KEY)}, 6) AS x FROM events")
def random_normal(spark, d):
    return _events(spark, d, x=F.round(rnd.gaussian(SEED, F.col("event_id")), 6))


@query("random_gaussian", f"SELECT event_id, ROUND(52 + 13 * ({_n(KEY)}), 6) AS a, ROUND(60 + 12 * ({_n(KEY, stream=1)}), 6) AS b FROM events")
def random_gaussian(spark, d):
    key = F.col("event_id")
    return _events(spark, d, a=F.round(rnd.gaussian(SEED, key, mean=52, sd=13), 6),
                   b=F.round(rnd.gaussian(SEED, key, mean=60, sd=12, stream=1), 6))


@query("random_bernoulli", f"SELECT event_id, CAST({_u(KEY)} < 0.8 AS INTEGER) AS a, CAST({_u(KEY, stream=1)} < 0.4 AS INTEGER) AS b FROM events")
def random_bernoulli(spark, d):
    key = F.col("event_id")
    return _events(spark, d, a=rnd.bernoulli(SEED, key, p=0.8), b=rnd.bernoulli(SEED, key, p=0.4, stream=1))


@query("random_exponential", f"SELECT event_id, ROUND(-ln(1.0 - {_u(KEY)}) / 0.4, 6) AS a, ROUND(-ln(1.0 - {_u(KEY, stream=1)}) / 0.2, 6) AS b FROM events")
def random_exponential(spark, d):
    key = F.col("event_id")
    return _events(spark, d, a=F.round(rnd.exponential(SEED, key, rate=0.4), 6),
                   b=F.round(rnd.exponential(SEED, key, rate=0.2, stream=1), 6))


@query("random_binomial", "SELECT event_id, " + " + ".join(
    f"CAST({_u(KEY, 1, s)} < 0.4 AS INTEGER)" for s in range(3)) + " AS successes FROM events")
def random_binomial(spark, d):
    return _events(spark, d, successes=rnd.binomial(SEED, F.col("event_id"), trials=3, p=0.4))


@query("random_normal_vectors", f"""SELECT s_suppkey, CAST(j AS INTEGER) AS j, ROUND({_n(['s_suppkey', 'j'])}, 6) AS x
FROM (SELECT s_suppkey, unnest(range(0, 10)) AS j FROM supplier)""")
def random_normal_vectors(spark, d):
    vectors = b.table(spark, d, "supplier").select("s_suppkey", rnd.normal_vector(SEED, F.col("s_suppkey"), width=10).alias("v"))
    return b.rounded(vectors.select("s_suppkey", F.posexplode("v").alias("j", "x")), "x")


@query("random_matrix", f"""SELECT i, j, CAST({_u(['i', 'j'])} < 0.4 AS INTEGER) AS v
FROM (SELECT i, unnest(range(0, 10)) AS j FROM (SELECT unnest(range(0, (SELECT count(*) FROM embeddings))) AS i))""")
def random_matrix(spark, d):
    rows = b.table(spark, d, "embeddings").count()
    return mx.random_matrix(spark, (rows, 10), lambda *at: rnd.bernoulli(SEED, *at, p=0.4))


@query("random_ndarray", f"""SELECT i0, i1, i2, ROUND({_n(['i0', 'i1', 'i2'])}, 6) AS v
FROM (SELECT i0, i1, unnest(range(0, 3)) AS i2 FROM (SELECT i0, unnest(range(0, 4)) AS i1
FROM (SELECT unnest(range(0, (SELECT count(*) FROM supplier))) AS i0)))""")
def random_ndarray(spark, d):
    n = b.table(spark, d, "supplier").count()
    return b.rounded(mx.random_matrix(spark, (n, 4, 3), lambda *at: rnd.gaussian(SEED, *at)), "v")
