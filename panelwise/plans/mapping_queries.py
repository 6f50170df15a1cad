"""Queries on identifier maps, upserts of other tables, scenarios, samples and fixed effects."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import mapping as mp
from ..operators import panel as op
from ..operators import portfolio as pf
from ..operators import reference as ref
from ..operators import regression as rg
from ..sources import panels as src
from ..streaming import ingest
from .panel_queries import _FIVE, _two_frame
from .reference_queries import _SUCC, _WTS, _portfolios
from .registry import PRELUDE, Panels, query, rounded

_RECURSIVE = "WITH RECURSIVE " + PRELUDE.removeprefix("WITH ")


def _pairs(p: Panels):
    """The raw map: customers' nations as keys, names in mixed case and with blanks."""
    return mp.clean_pairs(p.table("customer"), F.col("c_nationkey"), F.concat(F.lit(" cust"), F.col("c_custkey") % 40, F.lit(" ")), F.col("c_custkey"))


_PAIRS = """WITH pr AS (SELECT CAST(c_nationkey AS BIGINT) AS key, upper(trim(' cust' || (c_custkey % 40) || ' ')) AS ticker, min(c_custkey) AS first_row
FROM customer WHERE c_nationkey IS NOT NULL GROUP BY 1, 2) """
_FUNDAMENTALS = """fu AS (SELECT l_suppkey AS ticker, l_returnflag AS statement, l_linestatus || l_linenumber AS data_code,
CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_shipdate AS DATE) END AS date, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS quarter,
l_extendedprice AS value, l_orderkey AS seq FROM lineitem) """


def _fundamentals(p: Panels):
    """Statements that have a date in some rows, and in all the quarter."""
    return p.table("lineitem").select(
        F.col("l_suppkey").alias("ticker"), F.col("l_returnflag").alias("statement"), F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("data_code"),
        F.when(F.col("l_linenumber") % 2 == 0, F.to_date("l_shipdate")).alias("date"), F.trunc("l_shipdate", "quarter").alias("quarter"), F.col("l_extendedprice").alias("value"), F.col("l_orderkey").alias("seq"),
    )


@query("""SELECT date, upper(trim(t)) AS ticker FROM (SELECT try_cast(raw AS DATE) AS date, unnest(string_split(tickers, ',')) AS t
FROM (SELECT CASE WHEN month(date) = 2 THEN 'undated' ELSE CAST(date AS VARCHAR) END AS raw, string_agg('c' || ticker, ', ') AS tickers
FROM md GROUP BY date)) WHERE date >= DATE '1995-01-01'""")
def a7_raw_membership(p: Panels):
    raw = p.daily.groupBy("date").agg(F.array_join(F.collect_list(F.concat(F.lit("c"), "ticker")), ", ").alias("tickers"))
    return src.explode_members(raw.withColumn("date", F.when(F.month("date") == 2, "undated").otherwise(F.date_format("date", "yyyy-MM-dd"))), "1995-01-01")


@query(_PAIRS + "SELECT key, arg_min(ticker, first_row) AS ticker FROM pr GROUP BY key", False)
def a8_key_map(p: Panels):
    return mp.first_name(_pairs(p))


@query(
    f"WITH {_FUNDAMENTALS} SELECT ticker, data_code, coalesce(date, quarter) AS at, value FROM fu WHERE statement = 'R' AND coalesce(date, quarter) BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'",
    False
)
def a10_fundamentals_scan(p: Panels):
    rows = _fundamentals(p).where("statement = 'R'").withColumn("at", F.coalesce("date", "quarter"))
    return src.date_range(rows, "1995-01-01", "1996-12-31", "at").select("ticker", "data_code", "at", "value")


@query(
    f"WITH {_FUNDAMENTALS} SELECT ticker, statement, year(coalesce(date, quarter)) AS year, coalesce(date, quarter) AS at, data_code, round(max(struct_pack(s := seq, v := value)).v, 2) AS value FROM fu GROUP BY ALL",
    False
)
def a17_fundamentals_upsert(p: Panels):
    rows = _fundamentals(p).withColumn("at", F.coalesce("date", "quarter")).withColumn("year", F.year("at")).select(
        "ticker", "statement", "year", "at", "data_code", "value", "seq"
    )
    # The largest value of an order breaks the tie of its lines. Two loads, which overlap in the middle year.
    once = rows.groupBy("ticker", "statement", "year", "at", "data_code", "seq").agg(F.max("value").alias("value"))
    work = ingest.work_folder(p.spark)
    for i, part in enumerate(("seq <= 30000 or year < 1997", "seq > 30000 and year >= 1997")):
        src.upsert(p.spark, f"{work}/table", once.where(part), ["ticker", "statement", "at", "data_code"], ["statement", "year"], f"{work}/merge{i}")
    return rounded(
        p.spark.read.parquet(f"{work}/table").withColumn("year", F.col("year").cast("long")), "ticker", "statement", "year", "at",
        "data_code", "value:2"
    )


@query("""SELECT ticker, date, round(arg_max(ESG, seq), 6) AS ESG FROM (SELECT ticker, date, ESG, 0 AS seq FROM sc WHERE date <= DATE '1999-06-30'
UNION ALL SELECT ticker, date, ESG + 1, 1 FROM sc WHERE date >= DATE '1999-01-01') GROUP BY ticker, date""")
def a16_score_upsert(p: Panels):
    old, new = p.scores.where("date <= date'1999-06-30'"), p.scores.where("date >= date'1999-01-01'").withColumn("ESG", F.col("ESG") + 1)
    batches = [df.select("ticker", F.col("ticker").alias("gvkey"), "date", "ESG") for df in (old, new)]
    return rounded(src.upserted(p.spark, ingest.work_folder(p.spark), batches, ["ticker", "gvkey", "date"]), "ticker", "date", "ESG:6")


@query("""SELECT date, round(arg_max(rate, seq), 6) AS rate FROM (SELECT date, rate, 0 AS seq FROM rf WHERE date <= DATE '1996-12-31'
UNION ALL SELECT date, rate + 0.5, 1 FROM rf WHERE date >= DATE '1996-06-30') GROUP BY date""")
def a18_rate_upsert(p: Panels):
    new = p.rates.where("date >= date'1996-06-30'").select("date", (F.col("rate") + 0.5).alias("rate"))
    return rounded(src.upserted(p.spark, ingest.work_folder(p.spark), [p.rates.where("date <= date'1996-12-31'"), new], ["date"]), "date", "rate:6")


_MEMBERS = "SELECT count(*) AS rows, count(DISTINCT date) AS dates, count(DISTINCT ticker) AS tickers, min(date) AS first_date, max(date) AS last_date FROM md"


@query(_MEMBERS)
def a19_membership_merge(p: Panels):
    path = f"{ingest.work_folder(p.spark)}/members"
    src.build_membership(p.spark, path, p.daily.where("date <= date'1996-12-31'"))
    return src.build_membership(p.spark, path, p.daily.where("date >= date'1996-06-30'"))


@query(_MEMBERS + " WHERE date >= DATE '1996-06-30'")
def a19_membership_rebuild(p: Panels):
    path = f"{ingest.work_folder(p.spark)}/members"
    src.build_membership(p.spark, path, p.daily.where("date <= date'1996-12-31'"))
    return src.build_membership(p.spark, path, p.daily.where("date >= date'1996-06-30'"), rebuild=True)


@query("SELECT ticker, date, year(date) AS year, month(date) AS month, CASE WHEN ESG >= 45 THEN round(ESG, 6) END AS ESG, round(E, 6) AS E FROM sc")
def a4_raw_scores(p: Panels):
    """A vendor file with YYYYMM months and '.' for missing scores, made from the scores and read back."""
    path = f"{ingest.work_folder(p.spark)}/raw.csv"
    month = F.year("date") * 100 + F.month("date")
    names = dict(zip(src.RAW_SCORES[2:], ("ESG", "E", "S", "G"), strict=True))
    text = [F.when((F.col(c) >= 45) | F.lit(c != "ESG"), F.col(c).cast("string")).otherwise(".").alias(n) for n, c in names.items()]
    src.save_report(p.scores.select(F.col("ticker").alias("gvkey"), month.alias("YearMonth"), *text), path)
    df = src.read_raw_scores(p.spark, path)
    return rounded(
        df.select(F.col("gvkey").alias("ticker"), "date", F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"), "ESG", "E"),
        "ticker", "date", "year", "month", "ESG:6", "E:6"
    )


@query("SELECT DISTINCT CAST(ticker AS VARCHAR) AS ticker FROM md")
def a23_symbol_list(p: Panels):
    path = f"{ingest.work_folder(p.spark)}/symbols.csv"
    src.save_symbols(p.daily, path)
    return src.read_symbols(p.spark, path)


@query("""SELECT r.ticker, r.date, round(r.ret - f.rate / 100 / 52, 8) AS weekly, round(r.ret - f.rate / 100 / 252, 8) AS daily FROM ret r
JOIN rf f ON r.date = f.date""")
def d2_excess_by_period(p: Panels):
    weekly, daily = (op.excess_returns(p.returns, p.rates, k).select("ticker", "date", F.col("excess").alias(n)) for n, k in (("weekly", 52), ("daily", 252)))
    return rounded(weekly.join(daily, ["ticker", "date"]), "ticker", "date", "weekly:8", "daily:8")


@query("SELECT date, round(ret, 6) AS mkt FROM mret")
def b11_unit_check(p: Panels):
    return rounded(pf.check_units(p.market_returns, "mkt"), "date", "mkt:6")


@query("""SELECT ticker FROM (SELECT ticker FROM ret GROUP BY ticker HAVING count(*) >= 60 INTERSECT SELECT ticker FROM sc
WHERE ESG > 75 INTERSECT SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")
def c15_common_names(p: Panels):
    expected = p.returns.groupBy("ticker").agg(F.count(F.lit(1)).alias("n")).where("n >= 60")
    return pf.common_names(expected, p.scores.where("ESG > 75"), p.table("supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("ticker")))


@query("""SELECT ticker, CASE WHEN NOT ticker IN (SELECT ticker FROM exc) THEN 'no price' WHEN NOT ticker IN (SELECT ticker FROM sc
WHERE ESG > 70) THEN 'no score' WHEN coalesce(n, 0) < 24 THEN 'insufficient' ELSE 'success' END AS outcome, coalesce(n, 0) AS n, round(beta,
5) AS beta FROM (SELECT s_suppkey AS ticker FROM supplier)
LEFT JOIN (SELECT e.ticker, count(*) AS n, CASE WHEN count(*) >= 24 THEN regr_slope(e.excess, s.chg) END AS beta FROM exc e
JOIN (SELECT ticker, date, ESG / nullif(lag(ESG) OVER (PARTITION BY ticker ORDER BY date), 0) - 1 AS chg FROM sc
WHERE ESG > 70) s ON e.ticker = s.ticker AND e.date = s.date WHERE chg IS NOT NULL GROUP BY 1) USING (ticker)""")
def f12_outcomes(p: Panels):
    return rounded(_score_betas(p), "ticker", "outcome", "n", "beta:5")


def _score_betas(p: Panels):
    universe = p.table("supplier").select(F.col("s_suppkey").alias("ticker"))
    return rg.change_beta_outcomes(universe, p.excess, p.joint.scores.where("ESG > 70").select("ticker", "date", "ESG"), "ESG")


@query("""SELECT count(*) AS n, round(avg(b), 5) AS mean, round(avg(CASE WHEN b > 0 THEN 1.0 ELSE 0.0 END), 6) AS positive,
round(avg(CASE WHEN abs(r) * sqrt((n - 2) / (1 - r * r)) > 1.96 THEN 1.0 ELSE 0.0 END), 6) AS significant FROM (
    SELECT e.ticker, count(*) AS n, regr_slope(e.excess, s.chg) AS b, corr(e.excess, s.chg) AS r FROM exc e JOIN (
        SELECT ticker, date, ESG / nullif(lag(ESG) OVER (PARTITION BY ticker ORDER BY date), 0) - 1 AS chg FROM sc) s
    ON e.ticker = s.ticker AND e.date = s.date WHERE chg IS NOT NULL GROUP BY 1 HAVING count(*) >= 24)""")
def f12_beta_shares(p: Panels):
    universe = p.table("supplier").select(F.col("s_suppkey").alias("ticker"))
    return rounded(rg.beta_shares(rg.change_beta_outcomes(universe, p.excess, p.joint.scores.select("ticker", "date", "ESG"), "ESG")), "n", "mean:5", "positive:6", "significant:6")


@query("SELECT ticker, min(date) AS date, round(arg_min(adj_close, date), 6) AS adj_close FROM px GROUP BY ticker")
def h6_keep_first(p: Panels):
    return rounded(src.keep_first(p.prices, ["ticker"], "date"), "ticker", "date", "adj_close:6")


@query(_FIVE + """, w AS (SELECT e.ticker, e.date, count(*) OVER v AS n, regr_slope(e.excess, f.factor) OVER v AS beta, regr_intercept(e.excess,
f.factor) OVER v AS alpha, corr(e.excess, f.factor) OVER v AS r
FROM exc e JOIN (SELECT * FROM fct WHERE signal = 'ESG') f ON e.date = f.date WINDOW v AS (PARTITION BY e.ticker
ORDER BY e.date ROWS BETWEEN 35 PRECEDING AND CURRENT ROW))
SELECT ticker, date, n AS observations, round(beta, 5) AS beta, round(alpha * 12, 6) AS alpha, round(r * r, 6) AS r_squared FROM w WHERE n >= 24""")
def f9_rolling_factor(p: Panels):
    return rounded(rg.rolling_ols(_two_frame(p), "excess", "factor", 36, 24), "ticker", "date", "observations", "beta:5", "alpha:6", "r_squared:6")


@query()
def f29_batch_table(p: Panels):
    """A row a ticker, coefficients as text with stars, and one of null ticker with the means."""
    fit = rg.regress_hac(_two_frame(p), "excess", ["mkt_excess", "factor"])
    return rounded(
        rg.batch_table(fit), "ticker", "alpha:6", "alpha_stars", "beta_market:6", "beta_market_stars", "beta_score:6", "beta_score_stars",
        "r_squared:6", "n"
    )


@query(_PAIRS + """, fn AS (SELECT key, arg_min(ticker, first_row) AS ticker FROM pr
GROUP BY key), ex AS (SELECT DISTINCT lower(ticker) AS ticker, key + 1000 AS key FROM fn WHERE key > 12) SELECT ticker, key FROM fn
WHERE ticker NOT IN (SELECT upper(ticker) FROM ex) UNION ALL SELECT ticker, key FROM ex""", False)
def a20_key_upsert(p: Panels):
    names = mp.first_name(_pairs(p)).select("ticker", "key")
    return mp.put(names, names.where("key > 12").select(F.lower("ticker").alias("ticker"), (F.col("key") + 1000).alias("key")).distinct())


@query("""SELECT ticker, CAST(year(date) AS BIGINT) AS year, count(*) AS records, min(date) AS first_date, max(date) AS last_date, round(avg(ESG),
6) AS mean FROM sc WHERE ticker IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AND year(date) BETWEEN 1995 AND 1997 GROUP BY 1, 2""")
def a25_batch_export(p: Panels):
    asked = p.table("supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("ticker"))
    rows = mp.in_period(mp.fetched(asked, p.scores), start_year=1995, end_year=1997)
    by = rows.groupBy("ticker", F.year("date").cast("long").alias("year"))
    return rounded(
        by.agg(F.count(F.lit(1)).alias("records"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.avg("ESG").alias("mean")),
        "ticker", "year", "records", "first_date", "last_date", "mean:6"
    )


@query(_PAIRS + """SELECT 'Cust' || n AS ticker, (SELECT arg_min(key, first_row) FROM pr WHERE ticker = 'CUST' || n) AS key
FROM (SELECT DISTINCT c_custkey % 50 AS n FROM customer)""", False)
def b4_key_lookup(p: Panels):
    asked = p.table("customer").select(F.concat(F.lit("Cust"), F.col("c_custkey") % 50).alias("ticker")).distinct()
    return mp.key_of(asked, _pairs(p))


@query("SELECT ticker, date, round(ESG, 6) AS ESG FROM sc WHERE date BETWEEN DATE '1995-06-30' AND DATE '1996-12-31'")
def b5_entity_period(p: Panels):
    return rounded(mp.in_period(p.scores, start_date="1995-06-30", start_year=1993, end_year=1996), "ticker", "date", "ESG:6")


@query("""SELECT s_suppkey AS ticker, date, round(ESG, 6) AS ESG FROM supplier LEFT JOIN (SELECT * FROM sc WHERE ESG > 70) ON s_suppkey = ticker
WHERE s_acctbal > 0""")
def b6_many_entities(p: Panels):
    asked = p.table("supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("ticker"))
    return rounded(mp.fetched(asked, p.scores.where("ESG > 70"), skip_missing=False), "ticker", "date", "ESG:6")


@query("SELECT s_suppkey AS ticker FROM supplier WHERE s_suppkey NOT IN (SELECT ticker FROM px WHERE date >= DATE '2001-11-01')")
def b13_unfinished(p: Panels):
    return mp.unfinished(p.table("supplier").select(F.col("s_suppkey").alias("ticker")), p.prices.where("date >= date'2001-11-01'"))


@query("SELECT ticker, date, round(adj_close, 9) AS adj_close FROM px WHERE ticker IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)")
def c10_set_membership(p: Panels):
    rich = p.table("supplier").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("ticker"))
    return rounded(p.prices.join(rich, "ticker", "left_semi"), "ticker", "date", "adj_close:9")


@query("""SELECT date, round(a.ret, 6) AS mkt, round(f.rate, 6) AS rate, round(s.score, 6) AS score FROM mret a JOIN rf f USING (date)
JOIN (SELECT date, avg(ESG) AS score FROM sc WHERE ESG > 60 GROUP BY date HAVING avg(ESG) > 66) s USING (date)""")
def c14_complete_cases(p: Panels):
    series = p.market_returns.select("date", F.lit("mkt").alias("signal"), F.col("mkt").alias("factor"))
    series = series.unionByName(p.rates.select("date", F.lit("rate").alias("signal"), F.col("rate").alias("factor")))
    series = series.unionByName(p.scores.where("ESG > 60").groupBy("date").agg(
        F.lit("score").alias("signal"), F.avg("ESG").alias("factor")
    ).where("factor > 66"))
    wide = op.wide_factors(series, ["mkt", "rate", "score"])
    return wide.select("date", *(F.round(f"{c}_factor", 6).alias(c) for c in ("mkt", "rate", "score")))


@query("""SELECT ticker, round(avg(ret) * 12, 6) AS mean FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS n FROM ret)
WHERE n <= 36 GROUP BY ticker""")
def d26_historical_mean(p: Panels):
    return rounded(pf.historical_mean(p.returns, 36), "ticker", "mean:6")


@query("SELECT ticker, max(date) AS date, round(arg_max(ESG, date), 6) AS ESG FROM sc GROUP BY ticker")
def d30_latest(p: Panels):
    last = p.scores.groupBy("ticker").agg(F.max_by(F.struct("date", "ESG"), "date").alias("r"))
    return last.select("ticker", "r.date", F.round("r.ESG", 6).alias("ESG"))


_BOUNDS = [("none", None, None), ("within 5%", -0.05, 0.05), ("within 2%", -0.02, 0.02), ("positive", 0.0, 0.1), ("negative", -0.1, 0.0)]


@query(_WTS + """SELECT scenario, arg_max(portfolio, exp_return - 2.5 * variance) AS portfolio, round(max(exp_return - 2.5 * variance), 7) AS utility,
count(*) AS candidates FROM st
JOIN (VALUES ('none', -1e9, 1e9), ('within 5%', -0.05, 0.05), ('within 2%', -0.02, 0.02), ('positive', 0, 0.1), ('negative', -0.1, 0)) b(scenario,
low, high) ON exposure BETWEEN low AND high GROUP BY 1""")
def f24_score_scenarios(p: Panels):
    return rounded(pf.best_in_bounds(_portfolios(p)[1], _BOUNDS, 5.0), "scenario", "portfolio", "utility:7", "candidates")


_REQUIRED = """, rq AS (SELECT ticker, power(1 + avg(rf) + regr_slope(excess, mkt_excess) * 0.005, 12) - 1 AS required, avg(ret) * 12 AS historical
FROM exc GROUP BY ticker) """


def _required(p: Panels):
    return p.excess.groupBy("ticker").agg(
        F.expr("power(1 + avg(rf) + regr_slope(excess, mkt_excess) * 0.005D, 12) - 1").alias("required"),
        (F.avg("ret") * 12).alias("historical")
    )


@query(_REQUIRED + """SELECT ticker, round(required, 6) AS required, round(historical, 6) AS historical, round(required - historical, 6) AS gap,
CASE WHEN required - historical > 0.05 THEN 'underweight' WHEN required - historical > 0.02 THEN 'hold' WHEN required - historical > -0.02 THEN 'market perform' WHEN required - historical IS NOT NULL THEN 'overweight' END AS rating
FROM rq""")
def f27_expectation_gap(p: Panels):
    return rounded(pf.expectation_gap(_required(p)), "ticker", "required:6", "historical:6", "gap:6", "rating")


@query(_REQUIRED + """SELECT ticker, scenario, round(required - spread, 6) AS growth FROM rq CROSS
JOIN (VALUES ('bear', 0.08), ('base', 0.06), ('bull', 0.04)) s(scenario, spread)""")
def f27_implied_growth(p: Panels):
    return rounded(pf.implied_growth(_required(p), {"bear": 0.08, "base": 0.06, "bull": 0.04}), "ticker", "scenario", "growth:6")


_LAGS = [12, 15, 18, 24]


@query(", lg AS (" + " UNION ALL ".join(f"SELECT ticker, date, 'ESG_{k}' AS signal, lag(ESG, {k + 1}) OVER (PARTITION BY ticker ORDER BY date) AS value FROM sc" for k in _LAGS) + """),
pr AS (SELECT signal, date, excess, (rank() OVER (PARTITION BY signal, date
ORDER BY value) + (count(*) OVER (PARTITION BY signal, date, value) - 1) / 2.0) / count(*) OVER (PARTITION BY signal, date) AS pct FROM lg
JOIN exc USING (ticker, date) WHERE value IS NOT NULL),
fc AS (SELECT signal, date, avg(excess) FILTER (WHERE pct >= 0.8) - avg(excess) FILTER (WHERE pct <= 0.2) AS factor FROM pr GROUP BY 1, 2)
SELECT signal, count(factor) AS n, round(avg(factor) * 12, 6) AS ann_mean, round(stddev_samp(factor) * sqrt(12), 6) AS ann_std FROM fc
WHERE factor IS NOT NULL GROUP BY signal""")
def f28_lag_sensitivity(p: Panels):
    # All lags are one plan: each is a signal of its own.
    lagged = p.scores.select("ticker", "date", *(F.expr(f"lag(ESG, {k}) {op.OVER}").alias(f"ESG_{k}") for k in _LAGS))
    factors = op.long_short(p.excess, op.long_signals(lagged, [f"ESG_{k}" for k in _LAGS]))
    return rounded(op.factor_summary(factors), "signal", "n", "ann_mean:6", "ann_std:6")


@query()
def f30_fixed_effects(p: Panels):
    panel = p.excess.join(p.joint.scores.select("ticker", "date", "ESG"), ["ticker", "date"]).groupBy("ticker", F.year("date").alias("year")).agg(
        F.avg("excess").alias("excess"), F.avg("ESG").alias("ESG"), F.avg("mkt_excess").alias("mkt")
    )
    return rounded(rg.two_way_effects(panel, "excess", ["ESG"]), "term", "coef:8", "std_error:8", "n")


@query("""SELECT DISTINCT s.ticker, CAST(year(s.date) AS BIGINT) AS year, CAST(year(s.date) - first AS BIGINT) AS since, years,
years = (SELECT count(DISTINCT year(date)) FROM sc
WHERE ESG > 50 OR year(date) > 1996) AS balanced,
CASE WHEN first <= 1995 THEN 'early' WHEN first <= 1996 THEN 'middle' ELSE 'late' END AS cohort FROM (SELECT * FROM sc
WHERE ESG > 50 OR year(date) > 1996) s JOIN (SELECT ticker, min(year(date)) AS first, count(DISTINCT year(date)) AS years FROM sc
WHERE ESG > 50 OR year(date) > 1996 GROUP BY ticker) USING (ticker) WHERE years >= 4""")
def f31_sample_years(p: Panels):
    return mp.sample_years(p.scores.where("ESG > 50 or year(date) > 1996"), 4, 1995, 1996)


_FREQUENCIES = {
    "daily": ("CAST(l_shipdate AS DATE)", "start_date", 2),
    "weekly": ("CAST(l_shipdate AS DATE) + CAST((5 - isodow(l_shipdate) + 7) % 7 AS INTEGER)", "start_date + CAST((5 - isodow(start_date) + 7) % 7 AS INTEGER)", 6),
    "monthly": ("last_day(CAST(l_shipdate AS DATE))", "last_day(start_date)", 3)
}
_BY_FREQUENCY = " UNION ALL ".join(
    f"""SELECT '{name}' AS freq, r.ticker, r.start_date, r.end_date, min(p.date) AS a, max(p.date) AS b, CAST({want} AS DATE) AS want, {slack} AS slack
    FROM rq r LEFT JOIN (SELECT DISTINCT l_suppkey AS ticker, CAST({date} AS DATE) AS date FROM lineitem) p ON p.ticker = r.ticker AND p.date BETWEEN r.start_date AND r.end_date GROUP BY ALL"""
    for name, (date, want, slack) in _FREQUENCIES.items()
)


@query(f""", rq AS (SELECT ticker, CAST(date_trunc('month', start_date) AS DATE) AS start_date, end_date FROM iv), fq AS ({_BY_FREQUENCY}),
st AS (SELECT *, CASE WHEN a IS NULL THEN 'missing' WHEN greatest(a - want, 0) <= slack AND greatest(end_date - b, 0) <= slack THEN 'complete' ELSE 'partial' END AS status FROM fq),
cv AS (SELECT freq, ticker, count(*) AS periods, count(*) FILTER (WHERE status = 'complete') AS complete, count(*) FILTER (WHERE status = 'missing') AS missing FROM st GROUP BY 1, 2)
SELECT freq, ticker, periods, complete, missing, CASE WHEN complete = periods THEN 'complete' WHEN missing = periods THEN 'missing' ELSE 'partial' END AS status, score_records, score_years, score_start, score_end
FROM cv LEFT JOIN (SELECT ticker, count(*) AS score_records, count(DISTINCT year(date)) AS score_years, min(date) AS score_start, max(date) AS score_end FROM sc GROUP BY ticker) USING (ticker)""")
def g7_frequency_coverage(p: Panels):
    required = p.spans.select("ticker", F.trunc("start_date", "MM").alias("start_date"), "end_date")
    day = F.to_date("l_shipdate")
    dates = {"daily": day, "weekly": F.next_day(F.date_sub(day, 1), "FRI"), "monthly": F.last_day(day)}
    panels = {f: p.table("lineitem").select(F.col("l_suppkey").alias("ticker"), d.alias("date")).distinct() for f, d in dates.items()}
    scored = p.scores.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("score_records"), F.count_distinct(F.year("date")).alias("score_years"), F.min("date").alias("score_start"),
        F.max("date").alias("score_end")
    )
    return ref.frequency_coverage(required, panels).join(scored, "ticker", "left").select(
        "freq", "ticker", "periods", "complete", "missing", "status", *(c for c in scored.columns if c != "ticker")
    )


@query("""SELECT s_suppkey AS ticker, b AS actual_start, e AS actual_end,
CASE WHEN b IS NULL THEN 'missing' WHEN e >= DATE '2001-10-01' AND b <= DATE '2001-12-31' THEN 'complete' ELSE 'partial' END AS status
FROM supplier LEFT JOIN (SELECT ticker, min(date) AS b, max(date) AS e FROM px
WHERE adj_volume > 200 AND (adj_close > 1500 OR date < DATE '2001-01-01') GROUP BY ticker) ON s_suppkey = ticker""")
def g10_overlap_status(p: Panels):
    own = ref.extents(p.prices.where("adj_volume > 200 and (adj_close > 1500 or date < date'2001-01-01')")).drop("records")
    every = p.table("supplier").select(F.col("s_suppkey").alias("ticker")).join(own, "ticker", "left")
    return mp.overlap_status(every, "2001-10-01", "2001-12-31")


@query(
    f"WITH {_SUCC} SELECT old, CASE WHEN new IS NULL OR old IN (SELECT p_partkey FROM part WHERE p_size > 45) THEN 0 ELSE new END AS new FROM su UNION ALL SELECT p_partkey, 0 FROM part WHERE p_size > 45 AND p_partkey NOT IN (SELECT old FROM su)",
    False
)
def g14_overridden(p: Panels):
    own = src.successors(p.table("part"))
    extra = own.where("new is null").select("old").union(p.table("part").where("p_size > 45").select("p_partkey")).distinct()
    return ref.overridden(own, extra.withColumn("new", F.lit(0).cast(dict(own.dtypes)["new"])))


@query(_PAIRS + "SELECT key, ticker, first_row FROM pr", False)
def g16_key_pairs(p: Panels):
    return _pairs(p)


@query(_PAIRS + """SELECT count(*) AS rows, count(key) AS matched, round(count(key) * 1.0 / count(*), 6) AS rate FROM (SELECT (SELECT arg_min(key, first_row)
FROM pr WHERE ticker = 'CUST' || n) AS key FROM (SELECT o_custkey % 50 AS n FROM orders))""", False)
def g17_match_rate(p: Panels):
    members = p.table("orders").select(F.concat(F.lit("Cust"), F.col("o_custkey") % 50).alias("ticker"))
    return rounded(
        mp.key_of(members, _pairs(p)).agg(F.count(F.lit(1)).alias("rows"), F.count("key").alias("matched"), (F.count("key") / F.count(F.lit(1))).alias("rate")),
        "rows", "matched", "rate:6"
    )


_RESOLVED = _RECURSIVE + f", {_SUCC}, ch AS (SELECT old, new AS final, 1 AS hop FROM su UNION ALL SELECT c.old, s.new, c.hop + 1 FROM ch c JOIN su s ON c.final = s.old WHERE c.hop < 10), cl AS (SELECT old, arg_max(struct_pack(f := final), hop).f AS final FROM ch GROUP BY old), dt AS (SELECT DISTINCT ticker FROM sc WHERE ESG > 85), rs AS (SELECT s_suppkey AS ticker, CASE WHEN old IS NULL THEN s_suppkey ELSE final END AS resolved, old IS NOT NULL AND final IS NULL AS delisted FROM supplier LEFT JOIN cl ON s_suppkey = old), rz AS (SELECT *, ticker IN (SELECT ticker FROM dt) AS own, coalesce(resolved IN (SELECT ticker FROM dt), false) AS found FROM rs) "


def _resolution(p: Panels):
    universe = p.table("supplier").select(F.col("s_suppkey").alias("ticker"))
    return mp.resolution(universe, ref.closed_successors(src.successors(p.table("part"))), p.scores.where("ESG > 85"))


@query(_RESOLVED + """SELECT CASE WHEN delisted THEN 'skipped' WHEN own THEN 'processed' WHEN found THEN 'mapped' ELSE 'no data' END AS outcome, count(*) AS n
FROM rz GROUP BY 1""", False)
def g18_outcomes(p: Panels):
    return mp.outcome(_resolution(p)).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(
    _RESOLVED + """SELECT ticker, resolved, CASE WHEN own THEN 'fetched' WHEN found AND NOT delisted THEN 'resolved' ELSE 'skipped' END AS plan FROM rz""",
    False
)
def g20_refetch_plan(p: Panels):
    return mp.refetch(_resolution(p)).select("ticker", "resolved", "plan")


@query("SELECT user_id, event_type, max(ts) AS ts FROM events GROUP BY 1, 2", False)
def k1_stream_upsert(p: Panels):
    work = ingest.work_folder(p.spark)
    rows = ingest.read_events(p.spark, p.folder, "events.parquet").select("user_id", "event_type", "ts")
    ingest.upsert_stream(rows, f"{work}/table", ["user_id", "event_type"], ["event_type"], f"{work}/merge", f"{work}/state").awaitTermination()
    return p.spark.read.parquet(f"{work}/table").select("user_id", "event_type", "ts")


@query("""SELECT event_type, count(*) AS n FROM events WHERE event_id % 2 = 1 OR CAST(ts AS TIMESTAMP) > (SELECT max(CAST(ts AS TIMESTAMP)) FROM events
WHERE event_id % 2 = 1) - INTERVAL 5 DAY GROUP BY 1""", False)
def k2_late_rows(p: Panels):
    """Odd ids arrive first and set the watermark, even ids after; of those only what lies within the lookback is taken."""
    work = ingest.work_folder(p.spark)
    rows = p.table("events").select("event_id", "event_type", "ts")
    for rest in (1, 0):
        rows.where(f"event_id % 2 = {rest}").write.mode("append").parquet(f"{work}/in")
        taken = ingest.without_repeats(ingest.read_events(p.spark, f"{work}/in", files_a_batch=None), ["event_id"]).select("event_id", "event_type")
        taken.writeStream.format("parquet").option("path", f"{work}/taken").option("checkpointLocation", f"{work}/state").trigger(availableNow=True).start().awaitTermination()
    return p.spark.read.schema("event_id long, event_type string").parquet(f"{work}/taken").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT date, round(ret, 6) AS ret FROM mret")
def a11_portfolio_returns(p: Panels):
    path = f"{ingest.work_folder(p.spark)}/returns.csv"
    src.save_report(p.market_returns, path)
    return rounded(src.read_returns(p.spark, path), "date", "ret:6")


@query("SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY 1", False)
def k3_without_repeats(p: Panels):
    work = ingest.work_folder(p.spark)
    rows = ingest.read_events(p.spark, p.folder, "events.parquet").select("event_id", "event_type", "ts")
    once = ingest.without_repeats(rows.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))), ["event_id"])
    once.select("event_id", "event_type").writeStream.format("parquet").option("path", f"{work}/once").option("checkpointLocation", f"{work}/state").trigger(availableNow=True).start().awaitTermination()
    return p.spark.read.schema("event_id long, event_type string").parquet(f"{work}/once").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
