"""Queries: alignment, rolling statistics and indicators."""

from pyspark.sql import functions as F

from tickloom.operators import align as al
from tickloom.operators import indicators as ind
from tickloom.plans import base as b
from tickloom.plans.registry import query

PXA = f"WITH {b.PX}, {b.PXA}"
W = "OVER (PARTITION BY symbol ORDER BY t ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"


def _w(period):
    return W.format(period - 1)


@query("full_outer_align", f"""WITH {b.PX}
SELECT date, max(price) FILTER (symbol = '1-URGENT') AS p1, max(price) FILTER (symbol = '2-HIGH') AS p2,
  max(price) FILTER (symbol = '3-MEDIUM') AS p3, max(price) FILTER (symbol = '4-NOT SPECIFIED') AS p4,
  max(price) FILTER (symbol = '5-LOW') AS p5 FROM px GROUP BY date""")
def full_outer_align(spark, d):
    px = b.order_prices(spark, d)
    parts = [px.where(F.col("symbol") == p).select("date", F.col("price").alias(f"p{p[0]}")) for p in b.PRIORITIES]
    return al.full_outer_align(parts)


@query("calendar_densify", f"{PXA} SELECT date, symbol, price FROM pxa")
def calendar_densify(spark, d):
    return al.calendar_densify(b.order_prices(spark, d))


@query("positional_bind", f"""{PXA}, bands AS (
  SELECT date, symbol, CASE WHEN t >= 19 THEN avg(price) {_w(20)} END AS sma FROM pxa)
SELECT p.date, p.symbol, p.price, ROUND(b.sma, 6) AS sma FROM px p LEFT JOIN bands b USING (date, symbol)""")
def positional_bind(spark, d):
    px = b.order_prices(spark, d)
    bands = ind.bollinger_bands(px).select("date", "symbol", "sma")
    return b.rounded(al.positional_bind(px, bands, ["date", "symbol"]), "sma")


@query("pivot_wide", f"WITH {b.WIDE_PX} SELECT * FROM wpx")
def pivot_wide(spark, d):
    wide = al.pivot_wide(b.order_prices(spark, d), b.PRIORITIES)
    return wide.select("date", *[F.col(f"`{p}`").alias(f"p{p[0]}") for p in b.PRIORITIES])


ROLL_SQL = {"mean": "avg", "std": "stddev_samp", "max": "max", "min": "min"}
for _stat, _fn in ROLL_SQL.items():
    @query(f"rolling_{_stat}", f"""{PXA}
    SELECT date, symbol, price, ROUND(CASE WHEN t >= 9 THEN {_fn}(price) {_w(10)} END, 6) AS value FROM pxa""")
    def _rolling(spark, d, stat=_stat):
        return b.rounded(ind.rolling(b.order_prices(spark, d), stat, 10), "value")


LONG_PERIOD = 500
for _stat, _fn in ROLL_SQL.items():
    @query(f"rolling_{_stat}_long_period", f"""{PXA}
    SELECT date, symbol, price, ROUND(ln(CASE WHEN t >= {LONG_PERIOD - 1} THEN {_fn}(price) {_w(LONG_PERIOD)} END), 9) AS log_value FROM pxa""")
    def _rolling_long(spark, d, stat=_stat):
        """Frames that are put together from both borders of calendar chunks. Logarithms, whose digits never lie between two
        rounded numbers, as those of a mean of cents may."""
        out = ind.rolling(b.order_prices(spark, d), stat, LONG_PERIOD)
        return out.select("date", "symbol", "price", F.round(F.ln("value"), 9).alias("log_value"))


DIFF = f"""{PXA}, df AS (
  SELECT date, t, symbol, price, price - lag(price) OVER (PARTITION BY symbol ORDER BY t) AS diff FROM pxa)"""
GL = f"""{DIFF}, gl AS (
  SELECT date, t, symbol, price, CASE WHEN diff < 0 THEN 0.0 ELSE diff END AS gain,
         CASE WHEN diff < 0 THEN -diff ELSE 0.0 END AS loss FROM df)"""


@query("difference", f"{DIFF} SELECT date, symbol, price, ROUND(diff, 6) AS diff FROM df")
def difference(spark, d):
    return b.rounded(ind.difference(b.order_prices(spark, d)), "diff")


@query("gains_losses", f"{GL} SELECT date, symbol, ROUND(gain, 6) AS gain, ROUND(loss, 6) AS loss FROM gl")
def gains_losses(spark, d):
    return b.rounded(ind.gains_losses(b.order_prices(spark, d)), "gain", "loss")


def _rsi_sql(gl):
    return f"""{gl}, ud AS (
  SELECT date, t, symbol, price, CASE WHEN t >= 13 THEN avg(gain) {_w(14)} END AS up,
         CASE WHEN t >= 13 THEN avg(loss) {_w(14)} END AS down FROM gl),
rsi AS (SELECT date, t, symbol, price, 100 * up / NULLIF(up + down, 0) AS rsi FROM ud)"""


RSI = _rsi_sql(GL)


@query("rsi", f"{RSI} SELECT date, symbol, ROUND(rsi, 6) AS rsi FROM rsi")
def rsi(spark, d):
    return b.rounded(ind.rsi(b.order_prices(spark, d), 14), "rsi")


@query("rsi_wide", f"""{RSI} SELECT date, {', '.join(f"ROUND(max(rsi) FILTER (symbol = '{p}'), 6) AS p{p[0]}" for p in b.PRIORITIES)}
FROM rsi GROUP BY date""")
def rsi_wide(spark, d):
    wide = al.pivot_wide(ind.rsi(b.order_prices(spark, d), 14), b.PRIORITIES, value_col="rsi")
    return wide.select("date", *[F.round(f"`{p}`", 6).alias(f"p{p[0]}") for p in b.PRIORITIES])


BANDS_CTE = f"""mv AS (
  SELECT date, t, symbol, price, CASE WHEN t >= 19 THEN avg(price) {_w(20)} END AS sma,
         CASE WHEN t >= 19 THEN stddev_samp(price) {_w(20)} END AS sd FROM pxa),
bands AS (SELECT *, sma + 2 * sd AS top, sma - 2 * sd AS bottom FROM mv),
bbp AS (SELECT *, (price - bottom) / NULLIF(top - bottom, 0) AS bbp FROM bands)"""


@query("bollinger_bands", f"""{PXA}, {BANDS_CTE}
SELECT date, symbol, price AS adj_close, ROUND(top, 6) AS top, ROUND(bottom, 6) AS bottom, ROUND(sma, 6) AS sma FROM bands""")
def bollinger_bands(spark, d):
    return b.rounded(ind.bollinger_bands(b.order_prices(spark, d)), "top", "bottom", "sma")


@query("bollinger_pct", f"{PXA}, {BANDS_CTE} SELECT date, symbol, ROUND(bbp, 6) AS bbp FROM bbp")
def bollinger_pct(spark, d):
    return b.rounded(ind.bollinger_pct(b.order_prices(spark, d)), "bbp")


@query("bollinger_pct_multi", f"""{PXA}, {BANDS_CTE}
SELECT date, {', '.join(f"ROUND(max(bbp) FILTER (symbol = '{p}'), 6) AS p{p[0]}" for p in b.PRIORITIES)} FROM bbp GROUP BY date""")
def bollinger_pct_multi(spark, d):
    wide = al.pivot_wide(ind.bollinger_pct(b.order_prices(spark, d)), b.PRIORITIES, value_col="bbp")
    return wide.select("date", *[F.round(f"`{p}`", 6).alias(f"p{p[0]}") for p in b.PRIORITIES])


def _stochastic_sql(high="price", low="price"):
    return f"""kk AS (
  SELECT *, CASE WHEN t >= 13 THEN 100 * ((price - min({low}) {_w(14)})
    / NULLIF(max({high}) {_w(14)} - min({low}) {_w(14)}, 0)) END AS percent_k FROM pxa),
kd AS (SELECT *, CASE WHEN t >= 2 THEN avg(percent_k) {_w(3)} END AS percent_d FROM kk)"""


STOCH_OUT = "date, symbol, ROUND(percent_k, 6) AS percent_k, ROUND(percent_d, 6) AS percent_d, price AS prices"


@query("stochastic", f"""WITH all_px AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS symbol,
  arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY ALL),
px AS (SELECT * FROM all_px WHERE symbol = '1-URGENT'), {b.PXA}, {_stochastic_sql()} SELECT {STOCH_OUT} FROM kd""")
def stochastic(spark, d):
    one = b.order_prices(spark, d).where(F.col("symbol") == "1-URGENT")
    return b.rounded(ind.stochastic(one, 14, 3), "percent_k", "percent_d")


@query("stochastic_multi", f"{PXA}, {_stochastic_sql()} SELECT {STOCH_OUT} FROM kd")
def stochastic_multi(spark, d):
    return b.rounded(ind.stochastic(b.order_prices(spark, d), 14, 3), "percent_k", "percent_d")


@query("stochastic_high_low", f"""WITH {b.BARS}, px AS (SELECT date, symbol, close AS price, high, low FROM bars),
cal AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS t FROM (SELECT DISTINCT date FROM px)),
pxa AS (SELECT c.date, c.t, s.symbol, p.price, p.high, p.low FROM cal c CROSS JOIN (SELECT DISTINCT symbol FROM px) s
  LEFT JOIN px p ON p.date = c.date AND p.symbol = s.symbol), {_stochastic_sql("high", "low")} SELECT {STOCH_OUT} FROM kd""")
def stochastic_high_low(spark, d):
    prices = b.materialize(b.bars(spark, d).withColumnRenamed("close", "price"), "bars")
    out = ind.stochastic(prices, 14, 3, high_col="high", low_col="low")
    return b.rounded(out, "percent_k", "percent_d")


INDICATOR_SET = f"""{BANDS_CTE}, {_stochastic_sql()}
SELECT r.date, r.symbol, r.price, ROUND(r.rsi, 6) AS rsi, ROUND(x.sma, 6) AS sma, ROUND(x.top, 6) AS top,
  ROUND(x.bottom, 6) AS bottom, ROUND(x.bbp, 6) AS bbp, ROUND(k.percent_k, 6) AS percent_k, ROUND(k.percent_d, 6) AS percent_d
FROM rsi r JOIN bbp x USING (symbol, t) JOIN kd k USING (symbol, t)"""


def _indicator_set(px):
    out = ind.indicator_set(px, rsi_period=14, band_period=20, k=14, d=3)
    return b.rounded(out, "rsi", "sma", "top", "bottom", "bbp", "percent_k", "percent_d")


@query("indicator_set", f"{RSI}, {INDICATOR_SET}")
def indicator_set(spark, d):
    return _indicator_set(b.order_prices(spark, d))


@query("indicator_set_by_supplier", f"{RSI}, {INDICATOR_SET}".replace(b.PX, b.SUPPLIER_PX))
def indicator_set_by_supplier(spark, d):
    return _indicator_set(b.supplier_prices(spark, d))


@query("normalized_price", f"""WITH {b.BARS}, f AS (SELECT symbol, arg_min(close, date) AS first_close FROM bars GROUP BY 1)
SELECT b.date, b.symbol, b.open, b.high, b.low, b.close, b.volume, ROUND(b.close / NULLIF(first_close, 0), 6) AS normalized
FROM bars b JOIN f USING (symbol)""")
def normalized_price(spark, d):
    return b.rounded(ind.normalized_price(b.materialize(b.bars(spark, d), "bars")), "normalized")


@query("warmup_mask", f"{PXA} SELECT date, symbol, CASE WHEN t >= 19 THEN price END AS price FROM pxa")
def warmup_mask(spark, d):
    return ind.warmup_mask(b.order_prices(spark, d), 20)


@query("series_long", f"""{PXA}, {BANDS_CTE}
SELECT date, symbol, 'adj_close' AS series, price AS value FROM bands
UNION ALL SELECT date, symbol, 'top', ROUND(top, 6) FROM bands
UNION ALL SELECT date, symbol, 'bottom', ROUND(bottom, 6) FROM bands
UNION ALL SELECT date, symbol, 'sma', ROUND(sma, 6) FROM bands""")
def series_long(spark, d):
    bands = b.rounded(ind.bollinger_bands(b.order_prices(spark, d)), "top", "bottom", "sma")
    return ind.series_long(bands, ["adj_close", "top", "bottom", "sma"])


@query("series_long_stochastic", f"""{PXA}, {_stochastic_sql()}
SELECT date, symbol, 'prices' AS series, price AS value FROM kd
UNION ALL SELECT date, symbol, 'percent_k', ROUND(percent_k, 6) FROM kd
UNION ALL SELECT date, symbol, 'percent_d', ROUND(percent_d, 6) FROM kd""")
def series_long_stochastic(spark, d):
    """Price, %K and %D of all symbols as plot rows."""
    lines = b.rounded(ind.stochastic(b.order_prices(spark, d), 14, 3), "percent_k", "percent_d")
    return ind.series_long(lines, ["prices", "percent_k", "percent_d"])


@query("series_long_symbols", f"""{PXA}, nf AS (SELECT symbol, arg_min(price, date) AS first FROM px GROUP BY 1)
SELECT p.date, p.symbol AS series, ROUND(p.price / NULLIF(nf.first, 0), 6) AS value FROM px p JOIN nf USING (symbol)""")
def series_long_symbols(spark, d):
    """Normalised prices of several symbols, a series for each."""
    lines = ind.normalized_price(b.order_prices(spark, d), "price")
    return lines.select("date", F.col("symbol").alias("series"), F.round("normalized", 6).alias("value"))


@query("threshold_overlay", f"""{RSI} SELECT date, symbol, ROUND(rsi, 6) AS rsi,
  CASE WHEN t % 5 = 0 THEN 70.0::DOUBLE END AS overbought, CASE WHEN t % 5 = 0 THEN 30.0::DOUBLE END AS oversold FROM rsi""")
def threshold_overlay(spark, d):
    return b.rounded(ind.threshold_overlay(b.order_prices(spark, d), 14), "rsi")
