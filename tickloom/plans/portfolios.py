"""Queries: portfolio statistics."""

from pyspark.sql import functions as F

from tickloom.operators import portfolio as pf
from tickloom.plans import base as b
from tickloom.plans.registry import query

NORM = f"""WITH {b.FLAG_PX}, {b.PXA}, {b.ALLOC},
norm AS (SELECT p.date, p.t, p.symbol, p.price / NULLIF(f.price, 0) AS norm
  FROM pxa p LEFT JOIN (SELECT symbol, price FROM pxa WHERE t = 0) f USING (symbol))"""
VALUE = f"""{NORM},
val AS (SELECT a.portfolio_id, n.date, n.t, CASE WHEN count(n.norm) = count(*) THEN sum(n.norm * a.w) END AS port_value
  FROM norm n JOIN alloc a USING (symbol) GROUP BY ALL)"""
RETURNS = f"""{VALUE},
lagged AS (SELECT *, lag(port_value) OVER (PARTITION BY portfolio_id ORDER BY t) AS prev FROM val),
ret AS (SELECT portfolio_id, date, t, port_value, (port_value - prev) / NULLIF(prev, 0) AS daily_return FROM lagged)"""


def _returns(spark, d):
    prices = b.flag_prices(spark, d)
    return pf.portfolio_returns(pf.normalize_prices(prices), b.allocations(spark, d), pf.priced_symbols(prices))


def _values(spark, d):
    prices = b.flag_prices(spark, d)
    return pf.portfolio_value(pf.normalize_prices(prices), b.allocations(spark, d), pf.priced_symbols(prices))


@query("normalize_prices", f"{NORM} SELECT date, symbol, ROUND(norm, 6) AS norm FROM norm")
def normalize_prices(spark, d):
    return b.rounded(pf.normalize_prices(b.flag_prices(spark, d)).drop("t"), "norm")


@query("normalize_prices_gappy", f"{NORM} SELECT date, symbol, ROUND(norm, 6) AS norm FROM norm".replace(b.FLAG_PX, b.PX))
def normalize_prices_gappy(spark, d):
    return b.rounded(pf.normalize_prices(b.order_prices(spark, d)).drop("t"), "norm")


@query("portfolio_value", f"{VALUE} SELECT portfolio_id, date, ROUND(port_value, 6) AS port_value FROM val")
def portfolio_value(spark, d):
    return b.rounded(_values(spark, d).drop("t"), "port_value")


@query("portfolio_value_unknown_symbol", f"""{NORM},
held AS (SELECT portfolio_id, CASE WHEN portfolio_id % 3 = 0 AND symbol = 'A' OR portfolio_id % 5 = 0 THEN 'ZZ' ELSE symbol END AS symbol, w FROM alloc),
val AS (SELECT a.portfolio_id, d.date, CASE WHEN count(n.norm) = count(*) THEN sum(n.norm * a.w) END AS port_value
  FROM held a JOIN (SELECT DISTINCT date FROM norm) d ON TRUE LEFT JOIN norm n ON n.symbol = a.symbol AND n.date = d.date GROUP BY ALL)
SELECT portfolio_id, date, ROUND(port_value, 6) AS port_value FROM val""")
def portfolio_value_unknown_symbol(spark, d):
    """One holding, or all holdings, of some portfolios have no prices."""
    p = F.col("portfolio_id")
    lost = (p % 3 == 0) & (F.col("symbol") == "A") | (p % 5 == 0)
    alloc = b.allocations(spark, d).withColumn("symbol", F.when(lost, "ZZ").otherwise(F.col("symbol")))
    values = pf.portfolio_value(pf.normalize_prices(b.flag_prices(spark, d)), alloc)
    return b.rounded(values.drop("t"), "port_value")


@query("daily_returns", f"{RETURNS} SELECT portfolio_id, date, ROUND(daily_return, 6) AS daily_return FROM ret")
def daily_returns(spark, d):
    return b.rounded(_returns(spark, d).drop("t"), "daily_return")


@query("daily_returns_first_kept", f"""{RETURNS} SELECT portfolio_id, date,
  ROUND(CASE WHEN t = 0 THEN port_value ELSE daily_return END, 6) AS daily_return FROM ret""")
def daily_returns_first_kept(spark, d):
    return b.rounded(pf.daily_returns(_values(spark, d), keep_first=True).drop("t"), "daily_return")


@query("average_daily_return", f"""{RETURNS}
SELECT portfolio_id, ROUND(avg(daily_return), 6) AS average_daily_return FROM ret WHERE t > 0 GROUP BY 1""")
def average_daily_return(spark, d):
    return b.rounded(pf.average_daily_return(_returns(spark, d)), "average_daily_return")


@query("average_daily_return_strict", f"""{RETURNS}
SELECT portfolio_id, CASE WHEN count(*) = count(daily_return) THEN ROUND(avg(daily_return), 6) END AS average_daily_return
FROM ret WHERE t > 0 GROUP BY 1""")
def average_daily_return_strict(spark, d):
    out = pf.average_daily_return(_returns(spark, d), strict_nulls=True)
    return b.rounded(out, "average_daily_return")


@query("std_daily_return", f"""{RETURNS}
SELECT portfolio_id, ROUND(stddev_samp(daily_return), 6) AS std_daily_return FROM ret WHERE t > 0 GROUP BY 1""")
def std_daily_return(spark, d):
    return b.rounded(pf.std_daily_return(_returns(spark, d)), "std_daily_return")


@query("cumulative_return", f"""{VALUE}
SELECT portfolio_id, ROUND(arg_max_null(port_value, t) / NULLIF(arg_min_null(port_value, t), 0) - 1, 6) AS cumulative_return
FROM val GROUP BY 1""")
def cumulative_return(spark, d):
    return b.rounded(pf.cumulative_return(_values(spark, d)), "cumulative_return")


@query("cumulative_return_as_coded", f"""{VALUE}
SELECT portfolio_id, ROUND(arg_min_null(port_value, t) / NULLIF(arg_max_null(port_value, t), 0) - 1, 6) AS cumulative_return
FROM val GROUP BY 1""")
def cumulative_return_as_coded(spark, d):
    return b.rounded(pf.cumulative_return(_values(spark, d), as_coded=True), "cumulative_return")


@query("sharpe", f"""{RETURNS}
SELECT portfolio_id, ROUND(avg(daily_return) / NULLIF(stddev_samp(daily_return), 0) * sqrt(252), 6) AS sharpe
FROM ret WHERE t > 0 GROUP BY 1""")
def sharpe(spark, d):
    return b.rounded(pf.sharpe(b.flag_prices(spark, d), b.allocations(spark, d)), "sharpe")


@query("apply_columnwise", f"WITH {b.WIDE_PX} SELECT date, " + ", ".join(
    f"ROUND(ln(p{i}), 6) AS p{i}" for i in range(1, 6)) + " FROM wpx")
def apply_columnwise(spark, d):
    return pf.apply_columnwise(b.wide_prices(spark, d), lambda c: F.round(F.ln(c), 6))


@query("apply_series", f"""WITH {b.PX}, {b.PXA}
SELECT date, symbol, ROUND(price - lag(price) OVER (PARTITION BY symbol ORDER BY t), 6) AS value FROM pxa""")
def apply_series(spark, d):
    return b.rounded(pf.apply_series(b.order_prices(spark, d), lambda p: p.diff(), lookback=1), "value")


@query("cross_rank", f"""WITH {b.PX}, {b.PXA}
SELECT date, symbol, CASE WHEN price IS NOT NULL THEN CAST(rank() OVER (PARTITION BY date ORDER BY price DESC NULLS LAST) AS DOUBLE) END AS rank FROM pxa""")
def cross_rank(spark, d):
    """The place of every price among all symbols of its date, from panels of some dates and all symbols."""
    return pf.cross_rank(b.order_prices(spark, d), cells=1000).withColumn("rank", F.nanvl("rank", F.lit(None).cast("double")))


@query("rolling_covariance", f"""WITH {b.PX}, {b.PXA}
SELECT a.date, a.symbol, o.symbol AS other, ROUND(covar_samp(f.price, g.price) / 1e9, 4) AS covariance
FROM pxa a JOIN pxa o ON o.t = a.t JOIN pxa f ON f.symbol = a.symbol AND f.t BETWEEN a.t - 19 AND a.t
  JOIN pxa g ON g.symbol = o.symbol AND g.t = f.t WHERE a.t >= 19 GROUP BY a.date, a.t, a.symbol, o.symbol""")
def rolling_covariance(spark, d):
    """Covariances of all pairs of symbols over twenty dates, in billions."""
    found = pf.rolling_covariance(b.order_prices(spark, d), 20, cells=1000)
    return found.withColumn("covariance", F.round(F.nanvl("covariance", F.lit(None).cast("double")) / 1e9, 4))


@query("log_return", f"""WITH {b.PX}, {b.PXA}
SELECT date, symbol, ROUND(ln(price / NULLIF(lag(price) OVER (PARTITION BY symbol ORDER BY t), 0)), 6) AS log_return FROM pxa""")
def log_return(spark, d):
    return b.rounded(pf.log_return(b.order_prices(spark, d)), "log_return")


@query("zeros_like_keyed", f"WITH {b.WIDE_PX} SELECT date, " + ", ".join(
    f"0.0::DOUBLE AS p{i}" for i in range(1, 6)) + " FROM wpx")
def zeros_like_keyed(spark, d):
    return pf.zeros_like_keyed(b.wide_prices(spark, d))
