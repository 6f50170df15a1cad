"""Queries on price and score panels: scans, windows, cross-sections, factors, regressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as fd
from ..functions.pvalues import p_value_f, p_value_t
from ..operators import panel as op
from ..operators import portfolio as pf
from ..operators import ranks
from ..operators import regression as rg
from ..sources import panels as src
from ..streaming import ingest
from .registry import Panels, query, rounded


@query("SELECT ticker, date, round(adj_close, 9) AS adj_close, adj_volume FROM px WHERE ticker = 7 AND date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'")
def a1_price_scan(p: Panels):
    return rounded(src.date_range(p.prices.where("ticker = 7"), "1996-01-01", "1998-12-31"), "ticker", "date", "adj_close:9", "adj_volume")


@query("SELECT date, round(adj_close, 9) AS adj_close FROM mk WHERE date >= DATE '1996-01-01'")
def a2_market_scan(p: Panels):
    return rounded(src.date_range(p.market, "1996-01-01"), "date", "adj_close:9")


@query("""SELECT ticker, date, round(adj_close, 9) AS adj_close, adj_volume FROM px WHERE ticker IN (SELECT ticker FROM sect
WHERE sector = 'ASIA') AND date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'""")
def a3_price_panel(p: Panels):
    return rounded(
        src.panel_scan(p.prices, p.sectors.where("sector = 'ASIA'"), None, "1997-01-01", "1999-12-31"), "ticker", "date", "adj_close:9",
        "adj_volume"
    )


@query("""SELECT ticker, date, year(date) AS year, month(date) AS month, round(ESG, 6) AS ESG FROM sc
WHERE date IS NOT NULL AND year(date) BETWEEN 1996 AND 1998""", True)
def a5_score_scan(p: Panels):
    df = p.scores.withColumn("year", F.year("date").cast("long")).withColumn("month", F.month("date").cast("long")).where("year between 1996 and 1998")
    return rounded(df, "ticker", "date", "year", "month", "ESG:6")


@query("""SELECT ticker, date, round(ESG, 6) AS ESG, round(E, 6) AS E, round(S, 6) AS S, round(G, 6) AS G FROM sc WHERE ticker IN (SELECT ticker
FROM sect WHERE sector = 'EUROPE')""")
def a6_score_panel(p: Panels):
    return rounded(src.panel_scan(p.scores, p.sectors.where("sector = 'EUROPE'")), "ticker", "date", "ESG:6", "E:6", "S:6", "G:6")


@query("SELECT date, round(rate, 6) AS rate FROM rf WHERE date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'")
def a9_rate_scan(p: Panels):
    return rounded(src.date_range(p.rates, "1996-01-01", "1999-12-31"), "date", "rate:6")


@query("""SELECT ticker, date, round(ret, 6) AS ret, round(excess, 6) AS excess FROM exc WHERE ticker IN (SELECT ticker FROM exc GROUP BY ticker
HAVING count(*) >= 10)""")
def a12_returns_panel(p: Panels):
    df = p.excess.withColumn("n", F.expr("count(1) over (partition by ticker)")).where("n >= 10")
    return rounded(df, "ticker", "date", "ret:6", "excess:6")


@query("SELECT ticker, sector FROM sect WHERE ticker IN (SELECT ticker FROM px)")
def a13_sector_scan(p: Panels):
    return p.sectors.join(p.prices.select("ticker").distinct(), "ticker", "left_semi")


@query("""SELECT ticker, date, round(arg_max(adj_close, seq), 6) AS adj_close FROM (
SELECT ticker, date, adj_close, 0 AS seq FROM px WHERE date <= DATE '1999-06-30' UNION ALL SELECT ticker, date, adj_close * 1.01, 1 FROM px
WHERE date >= DATE '1999-01-01') GROUP BY ticker, date""")
def a15_price_upsert(p: Panels):
    old = p.prices.select("ticker", "date", "adj_close").where("date <= date'1999-06-30'")
    new = p.prices.select("ticker", "date", (F.col("adj_close") * 1.01).alias("adj_close")).where("date >= date'1999-01-01'")
    return rounded(src.upserted(p.spark, ingest.work_folder(p.spark), [old, new], ["ticker", "date"]), "ticker", "date", "adj_close:6")


@query("""SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS date, round(max(l_extendedprice / l_quantity), 9) AS high,
round(min(l_extendedprice / l_quantity), 9) AS low, CAST(sum(l_quantity) AS BIGINT) AS volume,
'us' AS exchange, 'USD' AS currency, 'daily' AS freq, CAST(year(min(CAST(l_shipdate AS DATE))) AS BIGINT) AS year FROM lineitem
GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""", False)
def a24_canonical_prices(p: Panels):
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    df = p.table("lineitem").groupBy(F.col("l_suppkey").cast("string").alias("ticker"), F.to_date("l_shipdate").alias("date")).agg(
        F.max(unit).alias("high"), F.min(unit).alias("low"), F.sum("l_quantity").cast("long").alias("volume")
    )
    df = df.withColumns({"exchange": F.lit("us"), "currency": F.lit("USD"), "freq": F.lit("daily"), "year": F.year("date").cast("long")})
    return rounded(df, "ticker", "date", "high:9", "low:9", "volume", "exchange", "currency", "freq", "year")


@query()
def a26_inventory(p: Panels):
    return src.inventory(p.table("lineitem")).withColumn("mb", F.round(F.col("bytes") / 1e6, 3)).drop("bytes")


@query("""SELECT ticker, date, round(adj_close, 9) AS adj_close FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS n FROM px)
WHERE n <= 12""")
def b9_last_rows(p: Panels):
    return rounded(pf.last_rows(p.prices, 12), "ticker", "date", "adj_close:9")


@query("""SELECT CAST(count(*) FILTER (WHERE adj_close < 0) AS BIGINT) AS negative_price,
CAST(count(*) FILTER (WHERE adj_volume < 0) AS BIGINT) AS negative_volume,
(SELECT CAST(count(*) FILTER (WHERE NOT (ESG BETWEEN 0 AND 100)) AS BIGINT)
FROM sc) AS score_range, (SELECT CAST(count(*) FILTER (WHERE ret NOT BETWEEN -1 AND 1) AS BIGINT) FROM ret) AS return_range FROM px""")
def b14_quality_rules(p: Panels):
    rules = p.prices.agg(F.count_if(F.col("adj_close") < 0).alias("negative_price"), F.count_if(F.col("adj_volume") < 0).alias("negative_volume"))
    return rules.crossJoin(p.scores.agg(F.count_if(~F.col("ESG").between(0, 100)).alias("score_range"))).crossJoin(p.returns.agg(F.count_if(~F.col("ret").between(-1, 1)).alias("return_range")))


@query("SELECT r.ticker, r.date, round(r.ret, 6) AS ret, round(m.ret, 6) AS mkt FROM ret r JOIN mret m ON r.date = m.date")
def c1_market_join(p: Panels):
    return rounded(p.returns.join(p.market_returns, "date"), "ticker", "date", "ret:6", "mkt:6")


@query("""SELECT e.ticker, e.date, round(e.excess, 6) AS excess, round(s.lagged, 6) AS lagged FROM exc e
JOIN (SELECT ticker, date, lag(ESG) OVER (PARTITION BY ticker ORDER BY date) AS lagged FROM sc) s ON e.ticker = s.ticker AND e.date = s.date
WHERE lagged IS NOT NULL""")
def c2_lagged_signal_join(p: Panels):
    lagged = op.lag_rows(p.scores.select("ticker", "date", F.col("ESG").alias("lagged")), ["lagged"], 1).where("lagged is not null")
    return rounded(p.excess.join(lagged, ["ticker", "date"]), "ticker", "date", "excess:6", "lagged:6")


@query("""SELECT d.date, round(last_value(f.rate IGNORE NULLS) OVER (ORDER BY d.date), 6) AS rate FROM (SELECT DISTINCT date FROM md) d LEFT
JOIN (SELECT * FROM rf WHERE rate < 4) f ON d.date = f.date""")
def c4_rate_forward_fill(p: Panels):
    return rounded(op.filled_rates(p.daily.select("date").distinct(), p.rates.where("rate < 4")), "date", "rate:6")


_ASOF = """SELECT p.ticker, p.date, round(s.ESG, 6) AS ESG FROM px p ASOF {}JOIN (SELECT ticker, date, ESG FROM sc
WHERE S > 50) s ON p.ticker = s.ticker AND p.date >= s.date"""


@query(_ASOF.format(""))
def c5_asof_backward(p: Panels):
    return rounded(op.backward_asof(p.prices.select("ticker", "date"), p.scores.where("S > 50"), "ESG"), "ticker", "date", "ESG:6")


@query(_ASOF.format("LEFT "))
def c6_asof_left(p: Panels):
    return rounded(op.backward_asof(p.prices.select("ticker", "date"), p.scores.where("S > 50"), "ESG", True), "ticker", "date", "ESG:6")


@query("""SELECT p.ticker, p.date, round(s.ESG, 6) AS ESG FROM px p ASOF JOIN (SELECT ticker, last_day(date + INTERVAL 1 MONTH) AS date, ESG FROM sc
WHERE month(date) = 12) s ON p.ticker = s.ticker AND p.date >= s.date""")
def c7_published_asof(p: Panels):
    out = p.scores.where("month(date) = 12").withColumn("date", F.last_day(F.add_months("date", 1)))
    return rounded(op.backward_asof(p.prices.select("ticker", "date"), out, "ESG"), "ticker", "date", "ESG:6")


@query("""SELECT b.ticker, f.date, round(f.rate / 1200 + b.beta * 0.005, 8) AS er_monthly FROM (SELECT ticker, regr_slope(excess, mkt_excess) AS beta
FROM exc GROUP BY ticker) b CROSS JOIN rf f""")
def c12_constant_beta(p: Panels):
    betas = rg.static_ols(p.excess, "excess", "mkt_excess", 2).select("ticker", "beta")
    rf = p.rates  # a row a month; Spark broadcasts whichever side its size allows
    return rounded(betas.crossJoin(rf).withColumn("er_monthly", F.col("rate") / 1200 + F.col("beta") * 0.005), "ticker", "date", "er_monthly:8")


@query("""SELECT coalesce(a.date, b.date) AS date, count(DISTINCT a.ticker) AS with_price, count(DISTINCT b.ticker) AS with_score,
count(DISTINCT CASE WHEN a.ticker = b.ticker THEN a.ticker END) AS common FROM px a FULL JOIN (SELECT * FROM sc
WHERE S > 50) b ON a.ticker = b.ticker AND a.date = b.date GROUP BY 1""")
def c18_alignment(p: Panels):
    a, b = p.prices.select("ticker", "date", F.lit(1).alias("a")), p.scores.where("S > 50").select("ticker", "date", F.lit(1).alias("b"))
    return a.join(b, ["ticker", "date"], "full").groupBy("date").agg(
        F.count("a").alias("with_price"), F.count("b").alias("with_score"),
        F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("common")
    )


@query("SELECT CAST(year(date) AS BIGINT) AS year, count(*) AS records, count(DISTINCT ticker) AS tickers FROM sc GROUP BY 1")
def d4_coverage_by_year(p: Panels):
    return p.scores.groupBy(F.year("date").cast("long").alias("year")).agg(F.count(F.lit(1)).alias("records"), F.count_distinct("ticker").alias("tickers"))


@query("SELECT DISTINCT ticker FROM sc WHERE year(date) = 1998")
def d5_tickers_of_year(p: Panels):
    return p.scores.where("year(date) = 1998").select("ticker").distinct()


@query("SELECT ticker, min(date) AS first_date, max(date) AS last_date FROM px GROUP BY ticker")
def d6_date_extent(p: Panels):
    return p.prices.groupBy("ticker").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


_LS = """, sg AS (SELECT ticker, date, unnest(['ESG', 'E', 'S', 'G']) AS signal, unnest([ESG, E, S, G]) AS value FROM sc),
lg AS (SELECT * FROM (SELECT signal, ticker, date, lag(value, {lag}) OVER (PARTITION BY signal, ticker ORDER BY date) AS value FROM sg)
WHERE value IS NOT NULL),
jn AS (SELECT l.signal, l.date, l.ticker, l.value, e.excess, {extra} FROM lg l JOIN exc e ON l.ticker = e.ticker AND l.date = e.date {join}),
rk AS (SELECT *, (rank() OVER (PARTITION BY {by}
ORDER BY value) + (count(*) OVER (PARTITION BY {by}, value) - 1) / 2.0) / count(*) OVER (PARTITION BY {by}) AS pct FROM jn),
lgs AS (SELECT signal, date, coalesce(sum(w * excess) FILTER (WHERE pct >= 0.8) / nullif(sum(w) FILTER (WHERE pct >= 0.8), 0),
avg(excess) FILTER (WHERE pct >= 0.8)) AS long_leg,
coalesce(sum(w * excess) FILTER (WHERE pct <= 0.2) / nullif(sum(w) FILTER (WHERE pct <= 0.2), 0),
avg(excess) FILTER (WHERE pct <= 0.2)) AS short_leg FROM rk GROUP BY signal, date)
SELECT signal, date, round(long_leg, 6) AS long_leg, round(short_leg, 6) AS short_leg, round(long_leg - short_leg, 6) AS factor FROM lgs
WHERE long_leg IS NOT NULL AND short_leg IS NOT NULL"""
_EQUAL = _LS.format(lag=1, extra="1.0 AS w, 0 AS sector", join="", by="signal, date")
_SIGNALS = ["ESG", "E", "S", "G"]


def _legs(df):
    return rounded(df, "signal", "date", "long_leg:6", "short_leg:6", "factor:6")


@query(_EQUAL)
def f1_long_short(p: Panels):
    return _legs(op.long_short(p.excess, op.long_signals(p.joint.scores, _SIGNALS)))


_W = """(SELECT ticker, date, lag(w) OVER (PARTITION BY ticker ORDER BY date) AS w
FROM (SELECT ticker, date, adj_close * adj_volume / sum(adj_close * adj_volume) OVER (PARTITION BY date) AS w FROM px))"""


@query(_LS.format(lag=1, extra="coalesce(v.w, 0) AS w, 0 AS sector", join=f"LEFT JOIN {_W} v ON v.ticker = l.ticker AND v.date = l.date", by="signal, date"))
def d3_value_weighted_legs(p: Panels):
    return _legs(op.long_short(p.excess, op.long_signals(p.joint.scores, _SIGNALS), weights=op.size_weights(p.joint.prices)))


@query(_LS.format(lag=1, extra="1.0 AS w, s.sector", join="LEFT JOIN sect s ON s.ticker = l.ticker", by="signal, date, sector"))
def e8_sector_neutral_legs(p: Panels):
    return _legs(op.long_short(p.excess, op.long_signals(p.joint.scores, _SIGNALS), sectors=p.sectors))


@query("""SELECT ticker, date, round((chg - avg(chg) OVER (PARTITION BY date)) / coalesce(nullif(stddev_pop(chg) OVER (PARTITION BY date), 0), 1),
6) AS value FROM (SELECT ticker, date, ESG - lag(ESG, 12) OVER (PARTITION BY ticker ORDER BY date) AS chg FROM sc) WHERE chg IS NOT NULL""")
def f2_momentum_signal(p: Panels):
    return rounded(op.momentum_signal(p.scores), "ticker", "date", "value:6")


_FIVE = """, l12 AS (SELECT * FROM (SELECT ticker, date, lag(ESG, 12) OVER w AS ESG, lag(E, 12) OVER w AS E, lag(S, 12) OVER w AS S, lag(G, 12) OVER w AS G
FROM sc WINDOW w AS (PARTITION BY ticker ORDER BY date)) WHERE ESG IS NOT NULL),
mom0 AS (SELECT ticker, date, ESG - lag(ESG, 12) OVER (PARTITION BY ticker ORDER BY date) AS chg FROM l12),
mom AS (SELECT ticker, date, (chg - avg(chg) OVER (PARTITION BY date)) / coalesce(nullif(stddev_pop(chg) OVER (PARTITION BY date), 0),
1) AS value FROM mom0 WHERE chg IS NOT NULL),
sg AS (SELECT ticker, date, unnest(['ESG', 'E', 'S', 'G']) AS signal, unnest([ESG, E, S, G]) AS value FROM l12
UNION ALL SELECT ticker, date, 'ESG_mom', value FROM mom),
lg AS (SELECT * FROM (SELECT signal, ticker, date, lag(value) OVER (PARTITION BY signal, ticker ORDER BY date) AS value FROM sg)
WHERE value IS NOT NULL),
jn AS (SELECT l.signal, l.date, l.ticker, l.value, e.excess FROM lg l JOIN exc e ON l.ticker = e.ticker AND l.date = e.date),
rk AS (SELECT *, (rank() OVER (PARTITION BY signal, date
ORDER BY value) + (count(*) OVER (PARTITION BY signal, date, value) - 1) / 2.0) / count(*) OVER (PARTITION BY signal, date) AS pct FROM jn),
fac AS (SELECT signal, date, avg(excess) FILTER (WHERE pct >= 0.8) AS long_leg, avg(excess) FILTER (WHERE pct <= 0.2) AS short_leg FROM rk
GROUP BY signal, date),
fct AS (SELECT signal, date, long_leg, short_leg, long_leg - short_leg AS factor FROM fac WHERE long_leg IS NOT NULL AND short_leg IS NOT NULL)
"""


@query(_FIVE + """SELECT * FROM (SELECT date, round(max(factor) FILTER (WHERE signal = 'ESG'), 6) AS ESG_factor, round(max(factor) FILTER (WHERE signal = 'E'),
6) AS E_factor, round(max(factor) FILTER (WHERE signal = 'S'), 6) AS S_factor,
round(max(factor) FILTER (WHERE signal = 'G'), 6) AS G_factor, round(max(factor) FILTER (WHERE signal = 'ESG_mom'), 6) AS ESG_mom_factor
FROM fct GROUP BY date)
WHERE ESG_factor IS NOT NULL AND E_factor IS NOT NULL AND S_factor IS NOT NULL AND G_factor IS NOT NULL AND ESG_mom_factor IS NOT NULL""")
def f3_five_factors(p: Panels):
    names = [*_SIGNALS, "ESG_mom"]
    return rounded(op.wide_factors(p.factors, names), "date", *(f"{n}_factor:6" for n in names))


@query(_FIVE + """SELECT signal, round(avg(factor) * 12, 6) AS ann_mean, round(stddev_samp(factor) * sqrt(12), 6) AS ann_std,
round(avg(factor) * 12 / nullif(stddev_samp(factor) * sqrt(12), 0), 6) AS sharpe, round(min(factor), 6) AS low, round(max(factor), 6) AS high,
count(factor) AS n FROM fct GROUP BY signal""")
def d9_factor_summary(p: Panels):
    return rounded(op.factor_summary(p.factors), "signal", "ann_mean:6", "ann_std:6", "sharpe:6", "low:6", "high:6", "n")


@query(_FIVE + """SELECT signal, round(avg(long_leg) * 100, 6) AS long_month, round(avg(short_leg) * 100, 6) AS short_month, round(avg(long_leg) * 1200,
6) AS long_year, round(stddev_samp(long_leg) * sqrt(12) * 100, 6) AS long_vol, round(stddev_samp(short_leg) * sqrt(12) * 100, 6) AS short_vol
FROM fct GROUP BY signal""")
def d10_leg_summary(p: Panels):
    df = p.factors.groupBy("signal").agg(
        (F.avg("long_leg") * 100).alias("long_month"), (F.avg("short_leg") * 100).alias("short_month"),
        (F.avg("long_leg") * 1200).alias("long_year"), (F.stddev_samp("long_leg") * F.sqrt(F.lit(12)) * 100).alias("long_vol"),
        (F.stddev_samp("short_leg") * F.sqrt(F.lit(12)) * 100).alias("short_vol")
    )
    return rounded(df, "signal", "long_month:6", "short_month:6", "long_year:6", "long_vol:6", "short_vol:6")


@query(_FIVE + "SELECT a.signal AS a, b.signal AS b, round(corr(a.factor, b.factor), 6) AS corr FROM fct a JOIN fct b ON a.date = b.date GROUP BY 1, 2")
def d11_factor_correlation(p: Panels):
    return rounded(op.correlations(p.factors), "a", "b", "corr:6")


@query("""SELECT date, count(*) AS n, round(avg(ret), 6) AS mean, round(stddev_samp(ret), 6) AS std, round(min(ret), 6) AS low, round(quantile_cont(ret, 0.25),
6) AS q25, round(quantile_cont(ret, 0.5), 6) AS median, round(quantile_cont(ret, 0.75), 6) AS q75, round(max(ret), 6) AS high FROM ret GROUP BY date""")
def d12_describe(p: Panels):
    df = p.returns.groupBy("date").agg(
        F.count("ret").alias("n"), F.avg("ret").alias("mean"), F.stddev_samp("ret").alias("std"), F.min("ret").alias("low"), F.max("ret").alias("high")
    )
    df = df.join(ranks.quantiles(p.returns, "ret", [0.25, 0.5, 0.75], out="q"), "date")
    return rounded(
        df.select("date", "n", "mean", "std", "low", F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q75"), "high"),
        "date", "n", "mean:6", "std:6", "low:6", "q25:6", "median:6", "q75:6", "high:6"
    )


_BETA = """, ro AS (SELECT ticker, date, mkt_excess, count(*) OVER w AS observations, regr_slope(excess, mkt_excess) OVER w AS beta, regr_intercept(excess,
mkt_excess) OVER w AS a, regr_sxx(excess, mkt_excess) OVER w AS sxx, regr_syy(excess, mkt_excess) OVER w AS syy, avg(mkt_excess) OVER w AS mx,
corr(excess, mkt_excess) OVER w AS correlation
FROM exc WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)),
r2 AS (SELECT *, greatest(syy - beta * beta * sxx, 0) / (observations - 2) AS s2 FROM ro WHERE observations = 60 AND sxx > 0),
betas AS (SELECT ticker, date, beta, a * 12 AS alpha, correlation * correlation AS r_squared, sqrt(s2 / sxx) AS std_error_beta,
sqrt(s2 * (1.0 / observations + mx * mx / sxx)) * 12 AS std_error_alpha, beta / nullif(sqrt(s2 / sxx), 0) AS t_stat_beta, observations,
correlation FROM r2)
"""


@query(_BETA + """SELECT ticker, date, round(beta, 6) AS beta, round(alpha, 6) AS alpha, round(r_squared, 6) AS r_squared, round(std_error_beta, 6) AS std_error_beta,
round(std_error_alpha, 6) AS std_error_alpha, round(t_stat_beta, 5) AS t_stat_beta, observations, round(correlation, 6) AS correlation FROM betas""")
def f4_rolling_beta(p: Panels):
    return rounded(
        rg.rolling_ols(p.excess, "excess", "mkt_excess"), "ticker", "date", "beta:6", "alpha:6", "r_squared:6", "std_error_beta:6",
        "std_error_alpha:6", "t_stat_beta:5", "observations", "correlation:6"
    )


@query()
def j1_beta_p_values(p: Panels):
    betas = rg.rolling_ols(p.excess, "excess", "mkt_excess")
    return betas.select(
        "ticker", "date", F.round(p_value_t(F.col("t_stat_beta"), F.col("observations") - 2), 8).alias("p_value_beta"),
        F.round(p_value_t(F.col("t_stat_alpha"), F.col("observations") - 2), 8).alias("p_value_alpha"),
        F.round(p_value_f(F.col("t_stat_beta") * F.col("t_stat_beta"), F.lit(1), F.col("observations") - 2), 8).alias("f_p_value")
    )


@query("""SELECT ticker, sum(m)::BIGINT AS n, round(sum(m * mean * mean / v), 4) AS wald, round(exp(-sum(m * mean * mean / v) / 2) * (1 + sum(m * mean * mean / v) / 2), 7) AS wald_p
FROM (SELECT ticker, quarter(date) AS q, count(*) AS m, avg(excess) AS mean, var_samp(excess) AS v FROM exc GROUP BY 1, 2) GROUP BY ticker
HAVING count(*) FILTER (WHERE v > 0) = 4""")
def j1_quarter_means(p: Panels):
    """Whether the mean excess returns of the four calendar quarters are all 0, of tickers that have all four."""
    return rounded(rg.zero_means(p.excess, "excess", "quarter(date)").where("groups = 4"), "ticker", "n", "wald:4", "wald_p:7")


@query()
def j1_mean_z(p: Panels):
    """Whether a ticker's mean excess return is 0, by the normal distribution."""
    return rounded(rg.zero_means(p.excess, "excess", "quarter(date)"), "ticker", "n", "z:5", "p_value:7")


@query(_BETA + """SELECT count(*) AS n, round(avg(beta), 6) AS mean, round(median(beta), 6) AS median, round(stddev_pop(beta), 6) AS std, round(quantile_cont(beta,
0.25), 6) AS q25, round(quantile_cont(beta, 0.75), 6) AS q75, count(*) FILTER (WHERE beta < 0.9) AS low_risk,
count(*) FILTER (WHERE beta BETWEEN 0.9 AND 1.1) AS market_like, count(*) FILTER (WHERE beta > 1.1) AS high_risk
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS n FROM betas) WHERE n = 1""")
def d13_beta_statistics(p: Panels):
    last = src.stored(pf.last_rows(rg.rolling_ols(p.excess, "excess", "mkt_excess"), 1).select("beta", F.lit("all").alias("of")))
    points = ranks.quantiles(last, "beta", [0.25, 0.5, 0.75], "of", "q").select("of", *(F.col("q")[i].alias(n) for i, n in enumerate(("q25", "median", "q75"))))
    df = last.join(points, "of").groupBy("of", "q25", "median", "q75").agg(
        F.count(F.lit(1)).alias("n"), F.avg("beta").alias("mean"), F.stddev_pop("beta").alias("std"),
        F.count_if(F.col("beta") < 0.9).alias("low_risk"), F.count_if(F.col("beta").between(0.9, 1.1)).alias("market_like"),
        F.count_if(F.col("beta") > 1.1).alias("high_risk")
    )
    return rounded(df, "n", "mean:6", "median:6", "std:6", "q25:6", "q75:6", "low_risk", "market_like", "high_risk")


@query(_BETA + """, ix AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) AS i, row_number() OVER (PARTITION BY ticker
ORDER BY date DESC) AS back FROM betas)
SELECT ticker, round(stddev_samp(beta) / nullif(abs(avg(beta)), 0), 6) AS variation, CASE WHEN stddev_samp(beta) / nullif(abs(avg(beta)),
0) < 0.1 THEN 'very stable' WHEN stddev_samp(beta) / nullif(abs(avg(beta)), 0) < 0.2 THEN 'stable' WHEN stddev_samp(beta) / nullif(abs(avg(beta)),
0) < 0.3 THEN 'moderate' WHEN stddev_samp(beta) / nullif(abs(avg(beta)), 0) IS NOT NULL THEN 'unstable' END AS band, arg_min(date, beta) AS low_date,
arg_max(date, beta) AS high_date, round(regr_slope(beta, i), 6) AS trend,
round(avg(beta) FILTER (WHERE back <= 12) - avg(beta) FILTER (WHERE back > 12), 6) AS recent_change,
round(count(*) FILTER (WHERE abs(t_stat_beta) > 1.96) / count(*), 6) AS significant FROM ix GROUP BY ticker HAVING count(*) > 12""")
def d14_beta_stability(p: Panels):
    df = rg.beta_stability(rg.rolling_ols(p.excess, "excess", "mkt_excess"))
    return rounded(df, "ticker", "variation:6", "band", "low_date", "high_date", "trend:6", "recent_change:6", "significant:6")


@query("""SELECT count(*) AS n, min(date) AS first_date, max(date) AS last_date, round(avg(rate), 6) AS mean, round(median(rate), 6) AS median,
round(stddev_samp(rate), 6) AS std, round(min(rate), 6) AS low, round(max(rate), 6) AS high FROM rf""")
def d15_rate_summary(p: Panels):
    df = p.rates.agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.avg("rate").alias("mean"),
        F.median("rate").alias("median"), F.stddev_samp("rate").alias("std"), F.min("rate").alias("low"), F.max("rate").alias("high")
    )
    return rounded(df, "n", "first_date", "last_date", "mean:6", "median:6", "std:6", "low:6", "high:6")


_COV = """SELECT a.ticker AS ticker_i, b.ticker AS ticker_j, covar_samp(a.ret, b.ret) AS cov, count(*) AS n FROM ret a
JOIN ret b ON a.date = b.date AND a.ticker <= b.ticker GROUP BY 1, 2"""


@query(f"SELECT ticker_i, ticker_j, round(cov, 8) AS cov, n FROM ({_COV})")
def d17_pairwise_covariance(p: Panels):
    return rounded(op.pairwise_covariance(p.returns), "ticker_i", "ticker_j", "cov:8", "n")


@query(f"SELECT ticker_i, ticker_j, round(CASE WHEN ticker_i = ticker_j THEN cov ELSE cov * 0.75 END, 8) AS cov FROM ({_COV})")
def d18_shrunk_covariance(p: Panels):
    return rounded(op.shrunk(op.pairwise_covariance(p.returns)), "ticker_i", "ticker_j", "cov:8")


@query("SELECT ticker, date, round(ret, 6) AS ret FROM ret")
def e1_simple_return(p: Panels):
    return rounded(p.returns, "ticker", "date", "ret:6")


@query("""SELECT * FROM (SELECT ticker, date, round(adj_close / lag(adj_close, 3) OVER w - 1, 6) AS r3, round(adj_close / lag(adj_close, 6) OVER w - 1,
6) AS r6, round(adj_close / lag(adj_close, 12) OVER w - 1, 6) AS r12 FROM px WINDOW w AS (PARTITION BY ticker ORDER BY date)) WHERE r12 IS NOT NULL""")
def e2_change_ratios(p: Panels):
    df = p.prices
    for k in (3, 6, 12):
        df = df.withColumn(f"r{k}", F.expr(f"adj_close / lag(adj_close, {k}) {op.OVER} - 1"))
    return rounded(df.where("r12 is not null"), "ticker", "date", "r3:6", "r6:6", "r12:6")


@query("SELECT * FROM (SELECT ticker, date, round(ESG - lag(ESG, 12) OVER (PARTITION BY ticker ORDER BY date), 6) AS change FROM sc) WHERE change IS NOT NULL")
def e3_difference(p: Panels):
    return rounded(p.scores.withColumn("change", F.expr(f"ESG - lag(ESG, 12) {op.OVER}")).where("change is not null"), "ticker", "date", "change:6")


@query("SELECT a.ticker, a.date, round(b.ESG, 6) AS ESG FROM sc a JOIN sc b ON a.ticker = b.ticker AND b.date = last_day(a.date - INTERVAL 12 MONTH)")
def e4_calendar_lag(p: Panels):
    return rounded(op.lag_months(p.scores.select("ticker", "date", "ESG"), ["ESG"], 12), "ticker", "date", "ESG:6")


@query("""SELECT ticker, date, round(lead(adj_close, 1) OVER w / adj_close - 1, 6) AS fwd_1, round(lead(adj_close, 3) OVER w / adj_close - 1, 6) AS fwd_3,
round(lead(adj_close, 6) OVER w / adj_close - 1, 6) AS fwd_6, round(lead(adj_close, 12) OVER w / adj_close - 1, 6) AS fwd_12 FROM px
WINDOW w AS (PARTITION BY ticker ORDER BY date)""")
def e5_forward_returns(p: Panels):
    return rounded(op.forward_returns(p.prices, [1, 3, 6, 12]), "ticker", "date", "fwd_1:6", "fwd_3:6", "fwd_6:6", "fwd_12:6")


@query("""SELECT ticker, date, round((rank() OVER (PARTITION BY date
ORDER BY ESG) + (count(*) OVER (PARTITION BY date, ESG) - 1) / 2.0) / count(*) OVER (PARTITION BY date), 8) AS pct FROM sc""")
def e7_percentile_rank(p: Panels):
    return rounded(op.percentile_rank(p.scores, "ESG"), "ticker", "date", "pct:8")


@query("""SELECT ticker, date, round((ESG - avg(ESG) OVER d) / coalesce(nullif(stddev_pop(ESG) OVER d, 0), 1), 6) AS z,
round(CASE WHEN stddev_samp(ESG) OVER d > 0 THEN (ESG - avg(ESG) OVER d) / stddev_samp(ESG) OVER d ELSE 0 END, 6) AS z_sample FROM sc
WINDOW d AS (PARTITION BY date)""")
def e9_zscores(p: Panels):
    return rounded(op.zscore(op.zscore(p.scores, "ESG"), "ESG", out="z_sample", sample=True), "ticker", "date", "z:6", "z_sample:6")


_DECILE = """, ed AS (SELECT date, quantile_cont(ESG, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM sc
GROUP BY date), dc AS (SELECT s.ticker, s.date, s.ESG, 1 + len(list_filter(edges, lambda e: e < ESG)) AS decile FROM sc s
JOIN ed ON s.date = ed.date) """


@query(_DECILE + """SELECT ticker, date, CAST(decile AS BIGINT) AS decile, CASE WHEN decile <= 2 THEN 'Q1' WHEN decile <= 8 THEN 'Q3' ELSE 'Q5' END AS quintile FROM dc""")
def e11_deciles(p: Panels):
    df = op.quantile_bucket(p.scores, "ESG", out="decile", fused=True)
    return df.select(
        "ticker", "date", F.col("decile").cast("long").alias("decile"),
        F.when(F.col("decile") <= 2, "Q1").when(F.col("decile") <= 8, "Q3").otherwise("Q5").alias("quintile")
    )


@query("SELECT ticker, date, round(adj_close * adj_volume / sum(adj_close * adj_volume) OVER (PARTITION BY date), 8) AS weight FROM px")
def e13_size_weights(p: Panels):
    return rounded(op.size_weights(p.prices), "ticker", "date", "weight:8")


_WEALTH = """, w AS (SELECT ticker, date, product(1 + ret) OVER (PARTITION BY ticker ORDER BY date) AS wealth
FROM ret), dd AS (SELECT *, max(wealth) OVER (PARTITION BY ticker ORDER BY date) AS peak FROM w) """


@query(_WEALTH + "SELECT ticker, date, round(wealth - 1, 5) AS cumulative, round(wealth / peak - 1, 6) AS drawdown FROM dd")
def e14_cumulative_drawdown(p: Panels):
    return rounded(op.drawdowns(p.returns), "ticker", "date", "cumulative:5", "drawdown:6")


@query(_WEALTH + "SELECT ticker, round(min(wealth / peak - 1), 6) AS max_drawdown FROM dd GROUP BY ticker")
def e15_max_drawdown(p: Panels):
    return rounded(op.drawdowns(p.returns).groupBy("ticker").agg(F.min("drawdown").alias("max_drawdown")), "ticker", "max_drawdown:6")


@query("""SELECT * FROM (SELECT ticker, date, CASE WHEN count(*) OVER w = 12 THEN round(avg(ret) OVER w, 6) END AS roll_mean,
CASE WHEN count(*) OVER w = 12 THEN round(stddev_samp(ret) OVER w, 6) END AS roll_std,
CASE WHEN count(*) OVER w = 12 THEN round(avg(ret) OVER w / stddev_samp(ret) OVER w * sqrt(12), 5) END AS roll_sharpe,
CASE WHEN count(*) OVER w = 12 THEN round(stddev_samp(ret) OVER w * sqrt(12), 6) END AS roll_vol FROM ret WINDOW w AS (PARTITION BY ticker
ORDER BY date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))""")
def e16_rolling_stats(p: Panels):
    return rounded(op.rolling_stats(p.returns), "ticker", "date", "roll_mean:6", "roll_std:6", "roll_sharpe:5", "roll_vol:6")


@query("""SELECT * FROM (SELECT ticker, date, CASE WHEN count(*) OVER w = 12 THEN round(regr_slope(ESG, n) OVER w, 6) END AS slope
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) AS n FROM sc) WINDOW w AS (PARTITION BY ticker
ORDER BY n ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)) WHERE slope IS NOT NULL""")
def e19_rolling_slope(p: Panels):
    numbered = p.scores.withColumn("n", F.expr(f"row_number() {op.OVER}"))
    w = "over (partition by ticker order by n rows between 12 preceding and 1 preceding)"
    return rounded(
        numbered.withColumn("slope", F.expr(f"if(count(1) {w} = 12, regr_slope(ESG, n) {w}, null)")).where("slope is not null"), "ticker",
        "date", "slope:6"
    )


@query("""SELECT ticker, round(sum(ret), 6) AS ytd_sum, round(product(1 + ret) - 1, 6) AS ytd_compound
FROM (SELECT *, max(date) OVER (PARTITION BY ticker) AS last_date FROM ret) WHERE year(date) = year(last_date) GROUP BY ticker""")
def e20_year_to_date(p: Panels):
    df = p.returns.withColumn("last_date", F.expr("max(date) over (partition by ticker)")).where("year(date) = year(last_date)")
    return rounded(
        df.groupBy("ticker").agg(F.sum("ret").alias("ytd_sum"), F.expr(f"{op.compounded('(1 + ret)')} - 1").alias("ytd_compound")), "ticker",
        "ytd_sum:6", "ytd_compound:6"
    )


@query(_BETA + """SELECT ticker, date, round(beta, 6) AS beta FROM (SELECT *, row_number() OVER (PARTITION BY ticker
ORDER BY date) AS i, count(*) OVER (PARTITION BY ticker) AS n FROM betas) WHERE i IN (1, n // 2 + 1, n)""")
def e23_first_middle_last(p: Panels):
    df = rg.rolling_ols(p.excess, "excess", "mkt_excess").withColumn("i", F.expr(f"row_number() {op.OVER}")).withColumn(
        "n", F.expr("count(1) over (partition by ticker)")
    )
    return rounded(df.where("i in (1, n div 2 + 1, n)"), "ticker", "date", "beta:6")


@query("SELECT max(date) AS date FROM sc GROUP BY date_trunc('quarter', date) ORDER BY 1 DESC LIMIT 4")
def e24_rebalance_dates(p: Panels):
    return p.scores.groupBy(F.trunc("date", "QUARTER").alias("q")).agg(F.max("date").alias("date")).orderBy(F.desc("date")).limit(4).select("date")


_TWO = """, tf AS (SELECT e.ticker, e.date, e.excess, e.mkt_excess, f.factor FROM exc e JOIN (SELECT * FROM fct WHERE signal = 'ESG') f ON e.date = f.date),
tm AS (SELECT ticker, count(*) AS n, avg(excess) AS my, avg(mkt_excess) AS m1, avg(factor) AS m2, var_pop(excess) AS vy, var_pop(mkt_excess) AS v1,
var_pop(factor) AS v2, covar_pop(mkt_excess, factor) AS c12, covar_pop(mkt_excess, excess) AS c1y, covar_pop(factor, excess) AS c2y FROM tf
GROUP BY ticker HAVING count(*) >= 24),
tb AS (SELECT *, (c1y * v2 - c2y * c12) / (v1 * v2 - c12 * c12) AS beta_1, (c2y * v1 - c1y * c12) / (v1 * v2 - c12 * c12) AS beta_2 FROM tm),
two AS (SELECT *, my - beta_1 * m1 - beta_2 * m2 AS alpha, (beta_1 * c1y + beta_2 * c2y) / vy AS r_squared FROM tb)
"""


def _two_frame(p: Panels):
    esg = p.factors.where("signal = 'ESG'").select("date", "factor")
    return p.excess.join(esg, "date")


@query(_FIVE + _TWO + """SELECT ticker, n, round(alpha, 6) AS alpha, round(beta_1, 5) AS beta_1, round(beta_2, 5) AS beta_2, round(r_squared, 6) AS r_squared,
round(1 - (1 - r_squared) * (n - 1) / (n - 3), 6) AS adj_r_squared FROM two""")
def f6_two_factor(p: Panels):
    return rounded(
        rg.two_factor(_two_frame(p), "excess", "mkt_excess", "factor"), "ticker", "n", "alpha:6", "beta_1:5", "beta_2:5", "r_squared:6",
        "adj_r_squared:6"
    )


@query()
def f6_two_factor_hac(p: Panels):
    return rounded(
        rg.regress_hac(_two_frame(p), "excess", ["mkt_excess", "factor"]), "ticker", "term", "coef:6", "std_error:6", "t:5", "p:6", "n",
        "r_squared:6", "adj_r_squared:6", "f:5", "f_p:6", "stars"
    )


@query(_FIVE + """, tf AS (SELECT e.ticker, e.date, e.excess AS y, e.mkt_excess AS x1, f.factor AS x2 FROM exc e JOIN (SELECT * FROM fct
WHERE signal = 'ESG') f ON e.date = f.date),
tm AS (SELECT ticker, date, count(*) OVER w AS n, covar_pop(x1, x2) OVER w AS c12, covar_pop(x1, y) OVER w AS c1y, covar_pop(x2, y) OVER w AS c2y,
var_pop(x1) OVER w AS v1, var_pop(x2) OVER w AS v2, var_pop(y) OVER w AS vy, avg(y) OVER w AS my, avg(x1) OVER w AS m1, avg(x2) OVER w AS m2
FROM tf WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 35 PRECEDING AND CURRENT ROW)),
bb AS (SELECT *, (c1y * v2 - c2y * c12) / (v1 * v2 - c12 * c12) AS b1, (c2y * v1 - c1y * c12) / (v1 * v2 - c12 * c12) AS b2 FROM tm WHERE n >= 36)
SELECT ticker, date, round(my - b1 * m1 - b2 * m2, 6) AS alpha, round(b1, 5) AS beta_1, round(b2, 5) AS beta_2,
round((b1 * c1y + b2 * c2y) / vy, 5) AS r_squared FROM bb""")
def f7_rolling_two_factor(p: Panels):
    return rounded(rg.two_factor(_two_frame(p), "excess", "mkt_excess", "factor", 36, 36), "ticker", "date", "alpha:6", "beta_1:5", "beta_2:5", "r_squared:5")


@query()
def f7_rolling_two_factor_hac(p: Panels):
    df = rg.rolling_hac(_two_frame(p), "excess", ["mkt_excess", "factor"], 36)
    return rounded(df, "ticker", "date", "term", "coef:6", "std_error:6", "t:5", "p:6", "n", "r_squared:6", "adj_r_squared:6", "f:5", "f_p:6", "stars")


@query()
def f8_multi_factor(p: Panels):
    wide = op.wide_factors(p.factors, ["E", "S", "G"])
    return rounded(
        rg.regress_hac(p.excess.join(wide, "date"), "excess", ["mkt_excess", "E_factor", "S_factor", "G_factor"]), "ticker", "term",
        "coef:6", "std_error:6", "t:5", "p:6", "n", "r_squared:6", "f:5", "f_p:6", "stars"
    )


@query("""SELECT ticker, n, CASE WHEN n >= 24 THEN round(beta, 6) END AS beta, CASE WHEN n >= 24 THEN round(alpha, 6) END AS alpha,
CASE WHEN n >= 24 THEN round(r2, 6) END AS r_squared
FROM (SELECT ticker, count(*) AS n, regr_slope(excess, mkt_excess) AS beta, regr_intercept(excess, mkt_excess) AS alpha, regr_r2(excess,
mkt_excess) AS r2 FROM exc GROUP BY ticker)""")
def f11_static_beta(p: Panels):
    return rounded(rg.static_ols(p.excess, "excess", "mkt_excess"), "ticker", "n", "beta:6", "alpha:6", "r_squared:6")


@query("""SELECT ticker, n, round(beta, 6) AS beta FROM (SELECT e.ticker, count(*) AS n, regr_slope(e.excess, s.chg) AS beta FROM exc e
JOIN (SELECT ticker, date, ESG / nullif(lag(ESG) OVER (PARTITION BY ticker ORDER BY date), 0) - 1 AS chg
FROM sc) s ON e.ticker = s.ticker AND e.date = s.date WHERE chg IS NOT NULL GROUP BY e.ticker) WHERE n >= 24""")
def f12_score_change_beta(p: Panels):
    return rounded(rg.static_ols(_score_change(p), "excess", "chg").where("n >= 24"), "ticker", "n", "beta:6")


_CHG = """, ch AS (SELECT e.ticker, e.date, e.excess, s.chg FROM exc e JOIN (SELECT ticker, date, ESG / nullif(lag(ESG) OVER (PARTITION BY ticker
ORDER BY date), 0) - 1 AS chg FROM sc) s ON e.ticker = s.ticker AND e.date = s.date WHERE chg IS NOT NULL)"""


def _score_change(p: Panels):
    change = op.simple_returns(p.joint.scores.select("ticker", "date", "ESG"), price="ESG", out="chg").select("ticker", "date", "chg")
    return p.excess.join(change, ["ticker", "date"])


@query(_CHG + """SELECT ticker, date, round(beta, 5) AS beta, round(r, 5) AS correlation, n AS observations FROM (SELECT ticker, date, count(*) OVER w AS n,
regr_slope(excess, chg) OVER w AS beta, corr(excess, chg) OVER w AS r FROM ch WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 35 PRECEDING AND CURRENT ROW))
WHERE n >= 24""")
def f12_rolling_change_beta(p: Panels):
    """The rolling form: windows of up to 36 rows, 24 at least."""
    return rounded(rg.rolling_ols(_score_change(p), "excess", "chg", 36, 24), "ticker", "date", "beta:5", "correlation:5", "observations")


@query(_CHG + """, st AS (SELECT ticker, n, beta, sign(beta) * sqrt(r2 * (n - 2) / (1 - r2)) AS t FROM (SELECT ticker, count(*) AS n, regr_slope(excess, chg) AS beta,
regr_r2(excess, chg) AS r2 FROM ch GROUP BY ticker HAVING count(*) >= 24)),
rk AS (SELECT *, row_number() OVER (ORDER BY beta DESC, ticker) AS up, row_number() OVER (ORDER BY beta, ticker) AS down,
row_number() OVER (ORDER BY abs(t) DESC, ticker) AS sure FROM st)
SELECT 'top' AS list, up AS place, ticker, round(beta, 5) AS beta, round(t, 4) AS t_stat FROM rk WHERE up <= 10 UNION ALL
SELECT 'bottom', down, ticker, round(beta, 5), round(t, 4) FROM rk WHERE down <= 10 UNION ALL SELECT 'largest_t', sure, ticker, round(beta, 5), round(t, 4) FROM rk WHERE sure <= 10""")
def f12_extremes(p: Panels):
    """The ten largest and smallest betas and the ten largest t statistics in size."""
    return rounded(rg.beta_extremes(rg.static_ols(_score_change(p), "excess", "chg")), "list", "place", "ticker", "beta:5", "t_stat:4")


@query()
def f12_lowest_p(p: Panels):
    """The ten betas of lowest p value, by Student's t with n - 2 degrees."""
    fit = rg.static_ols(_score_change(p), "excess", "chg").where("n >= 24")
    tested = fit.withColumn("p_value", p_value_t(F.col("t_stat"), F.col("n") - 2))
    return rounded(tested.orderBy("p_value", "ticker").limit(10), "ticker", "n", "beta:5", "t_stat:4", "p_value:8")


@query(_FIVE + """SELECT 'factor' AS kind, signal, date, round(factor, 6) AS value FROM fct WHERE date >= DATE '1999-01-01' UNION ALL
SELECT 'long_leg', signal, date, round(long_leg, 6) FROM fct WHERE date >= DATE '1999-01-01' UNION ALL
SELECT 'short_leg', signal, date, round(short_leg, 6) FROM fct WHERE date >= DATE '1999-01-01'""")
def a14_stored_factors(p: Panels):
    """Factors and legs saved as a result table and loaded from a date on."""
    path = f"{ingest.work_folder(p.spark)}/factors"
    src.save_table(p.factors, path)
    loaded = src.date_range(p.spark.read.parquet(path), "1999-01-01")
    return rounded(loaded.unpivot(["signal", "date"], ["factor", "long_leg", "short_leg"], "kind", "value"), "kind", "signal", "date", "value:6")


@query(_FIVE + _TWO + """, rs AS (SELECT t.ticker, t.date, t.mkt_excess, t.factor, t.excess - w.alpha - w.beta_1 * t.mkt_excess - w.beta_2 * t.factor AS e FROM tf t
JOIN two w ON t.ticker = w.ticker),
rl AS (SELECT *, e - lag(e) OVER (PARTITION BY ticker ORDER BY date) AS de FROM rs)
SELECT ticker, round(sum(de * de) / sum(e * e), 5) AS durbin_watson FROM rl GROUP BY ticker""")
def f10_durbin_watson(p: Panels):
    return rounded(rg.residual_diagnostics(_two_frame(p), "excess", "mkt_excess", "factor"), "ticker", "durbin_watson:5")


@query()
def f10_diagnostics(p: Panels):
    return rounded(
        rg.residual_diagnostics(_two_frame(p), "excess", "mkt_excess", "factor"), "ticker", "durbin_watson:5", "dw_flag", "jarque_bera:5",
        "jb_p:6", "breusch_pagan:5", "bp_p:6"
    )


@query(_FIVE + """, u AS (SELECT signal, date, factor, factor - avg(factor) OVER (PARTITION BY signal) AS u
FROM fct), pr AS (SELECT a.signal, a.u, a.factor, row_number() OVER (PARTITION BY signal ORDER BY date) AS i FROM u a),
lp AS (SELECT a.signal, sum(a.u * b.u * (CASE WHEN a.i = b.i THEN 1 ELSE 2 * (1 - (a.i - b.i) / 13.0) END)) AS s FROM pr a
JOIN pr b ON a.signal = b.signal AND a.i - b.i BETWEEN 0 AND 12 GROUP BY a.signal),
mn AS (SELECT signal, avg(factor) AS mean, count(*) AS n FROM fct GROUP BY signal)
SELECT m.signal, round(mean, 6) AS mean, n, round(sqrt(greatest(s, 0)) / n, 6) AS std_error FROM mn m JOIN lp ON m.signal = lp.signal""")
def d31_hac_mean(p: Panels):
    return rounded(rg.hac_mean(p.factors.select("signal", "date", "factor"), "signal", "factor"), "signal", "mean:6", "n", "std_error:6")


@query(_FIVE + "SELECT signal, round(0.5 * CASE WHEN signal = 'ESG' THEN 0.001 ELSE 0 END + 0.5 * avg(factor), 8) AS premium FROM fct GROUP BY signal")
def d32_premia(p: Panels):
    return rounded(pf.premia(p.factors, {"ESG": 0.001}, 0.5), "signal", "premium:8")


_ER = (
    _FIVE
    + """, tf AS (SELECT e.ticker, e.date, e.excess AS y, e.mkt_excess AS x1, f.factor AS x2 FROM exc e JOIN (SELECT * FROM fct
WHERE signal = 'ESG') f ON e.date = f.date),
tm AS (SELECT ticker, date, count(*) OVER w AS n, covar_pop(x1, x2) OVER w AS c12, covar_pop(x1, y) OVER w AS c1y, covar_pop(x2, y) OVER w AS c2y,
var_pop(x1) OVER w AS v1, var_pop(x2) OVER w AS v2
    FROM tf WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 35 PRECEDING AND CURRENT ROW)),
tb AS (SELECT ticker, date, (c1y * v2 - c2y * c12) / (v1 * v2 - c12 * c12) AS beta_market,
(c2y * v1 - c1y * c12) / (v1 * v2 - c12 * c12) AS beta_score FROM tm WHERE n >= 36),
fr AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY ticker) = 1 THEN DATE '0001-01-01' ELSE date END AS since FROM tb),
kd AS (SELECT t.ticker, f.date, f.rate / 1200 AS rf FROM (SELECT DISTINCT ticker FROM tb) t CROSS JOIN rf f),
bc AS (SELECT kd.ticker, kd.date, kd.rf, b.date AS beta_date, beta_market, beta_score, greatest(-3, least(3, beta_market)) AS bm, greatest(-5,
least(5, beta_score)) AS be
    FROM kd ASOF JOIN fr b ON b.ticker = kd.ticker AND kd.date >= b.since),
pm AS (SELECT {premia}),
er AS (SELECT *, rf + bm * market + be * score AS er_monthly, power(1 + rf + bm * market + be * score, 12) - 1 AS er_annual FROM bc CROSS JOIN pm)
"""
)
_FIXED = _ER.replace("{premia}", "0.005 AS market, -0.002 AS score")


def _two_betas(p: Panels):
    fit = rg.two_factor(_two_frame(p), "excess", "mkt_excess", "factor", 36, 36)
    return fit.select("ticker", "date", F.col("beta_1").alias("beta_market"), F.col("beta_2").alias("beta_score"))


def _premia(p: Panels):
    return p.spark.createDataFrame([(0.005, -0.002)], "market double, score double")


def _expected(p: Panels):
    return pf.expected_returns(_two_betas(p), p.joint.rates, _premia(p))


_ER_COLUMNS = "ticker, date, beta_date, round(beta_market, 5) AS beta_market, round(beta_score, 5) AS beta_score, round(bm, 5) AS beta_market_capped, round(be, 5) AS beta_score_capped, round(rf, 8) AS rf, round(er_monthly, 7) AS er_monthly, round(er_annual, 5) AS er_annual"
_ER_ROUNDED = (
    "ticker", "date", "beta_date", "beta_market:5", "beta_score:5", "beta_market_capped:5", "beta_score_capped:5", "rf:8", "er_monthly:7",
    "er_annual:5"
)


@query(_FIXED + f"SELECT {_ER_COLUMNS} FROM er")
def f13_expected_returns(p: Panels):
    return rounded(_expected(p), *_ER_ROUNDED)


@query(_FIXED.replace(
    "FROM tm WHERE n >= 36)", "FROM tm WHERE n >= 36 QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1)"
) + f"SELECT {_ER_COLUMNS} FROM er")
def f13_constant_expected_returns(p: Panels):
    return rounded(pf.expected_returns(_two_betas(p), p.joint.rates, _premia(p), constant=True), *_ER_ROUNDED)


@query(_ER.replace("{premia}", """0.5 * 0.005 + 0.5 * (SELECT avg(m.ret - f.rate / 1200) FROM mret m JOIN rf f ON m.date = f.date) AS market, 0.5 * (SELECT avg(factor) FROM fct
WHERE signal = 'ESG') AS score""") + f"SELECT {_ER_COLUMNS} FROM er")
def f14_expected_return_pipeline(p: Panels):
    """Premia from history and sample, betas from a stored result table, expected returns of every month."""
    path = f"{ingest.work_folder(p.spark)}/betas"
    src.save_table(_two_betas(p), path)
    market = p.joint.market_returns.join(p.joint.rates, "date").select(F.lit("mkt").alias("signal"), "date", (F.col("mkt") - F.col("rate") / 1200).alias("factor"))
    blended = pf.premia(market.unionByName(p.factors.where("signal = 'ESG'").select("signal", "date", "factor")), {"mkt": 0.005}, 0.5)
    one = blended.agg(F.expr("max(if(signal = 'mkt', premium, null))").alias("market"), F.expr("max(if(signal = 'ESG', premium, null))").alias("score"))
    return rounded(pf.expected_returns(p.spark.read.parquet(path), p.joint.rates, one), *_ER_ROUNDED)


@query(_FIXED + """SELECT ticker, count(*) AS n, round(avg(er_monthly), 7) AS mean, round(min(er_annual), 5) AS low, round(max(er_annual), 5) AS high,
count(*) FILTER (WHERE beta_market <> bm) AS capped_market, count(*) FILTER (WHERE beta_score <> be) AS capped_score FROM er GROUP BY ROLLUP (ticker)""")
def d16_expected_return_summary(p: Panels):
    """A row a ticker and one, of null ticker, over all."""
    by = _expected(p).rollup("ticker").agg(
        F.count(F.lit(1)).alias("n"), F.avg("er_monthly").alias("mean"), F.min("er_annual").alias("low"), F.max("er_annual").alias("high"),
        F.count_if(F.col("beta_market") != F.col("beta_market_capped")).alias("capped_market"), F.count_if(F.col("beta_score") != F.col("beta_score_capped")).alias("capped_score"),
    )
    return rounded(by, "ticker", "n", "mean:7", "low:5", "high:5", "capped_market", "capped_score")


@query(_FIXED + """SELECT ticker, date, round(rf * 12, 6) AS rf_part, round(bm * market * 12, 5) AS market_part, round(be * score * 12, 5) AS score_part FROM er
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1""")
def f15_contributions(p: Panels):
    return rounded(pf.contributions(_expected(p), _premia(p)), "ticker", "date", "rf_part:6", "market_part:5", "score_part:5")


@query(_FIXED + """SELECT ticker, date, round(er_monthly, 7) AS er_monthly, round(er_annual, 5) AS er_annual FROM er
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1""")
def a14_stored_expected_returns(p: Panels):
    """Expected returns saved as a result table; the latest of each ticker loaded."""
    path = f"{ingest.work_folder(p.spark)}/expected"
    src.save_table(_expected(p), path)
    return rounded(pf.latest(p.spark.read.parquet(path)), "ticker", "date", "er_monthly:7", "er_annual:5")
