"""Queries on membership, identifiers, coverage, formation methods and portfolios."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as fd
from ..operators import panel as op
from ..operators import portfolio as pf
from ..operators import ranks
from ..operators import reference as ref
from ..operators import regression as rg
from ..sources import panels as src
from ..streaming import ingest
from .panel_queries import _DECILE
from .registry import Panels, query, rounded


@query("SELECT DISTINCT ticker FROM iv WHERE DATE '1997-06-30' BETWEEN start_date AND end_date")
def b2_members_on(p: Panels):
    return ref.members_on(p.spans, "1997-06-30")


@query("SELECT DISTINCT ticker FROM iv WHERE start_date <= DATE '1996-12-31' AND end_date >= DATE '1996-01-01'")
def b3_members_during(p: Panels):
    return ref.members_during(p.spans, "1996-01-01", "1996-12-31")


@query("SELECT ticker, start_date, end_date FROM iv")
def e22_membership_intervals(p: Panels):
    return p.spans.select("ticker", "start_date", "end_date")


@query("SELECT ticker, min(start_date) AS start_date, max(end_date) AS end_date, count(*) AS intervals FROM iv GROUP BY ticker")
def d7_membership_span(p: Panels):
    return ref.span(p.spans)


@query("SELECT ticker, count(*) AS intervals FROM iv GROUP BY ticker HAVING count(*) > 1")
def g23_re_entries(p: Panels):
    return p.spans.groupBy("ticker").agg(F.count(F.lit(1)).alias("intervals")).where("intervals > 1")


@query("SELECT ticker, date FROM md")
def g25_expanded_daily(p: Panels):
    return ref.expanded(p.spans, p.daily.select("date").distinct())


@query("""SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT start_date <= lag(end_date) OVER (PARTITION BY ticker ORDER BY start_date) AS bad
FROM iv) WHERE bad) AS overlapping,
(SELECT count(*) FROM (SELECT ticker, date FROM md EXCEPT ALL SELECT i.ticker, d.date FROM iv i JOIN (SELECT DISTINCT date FROM md) d
ON d.date BETWEEN i.start_date AND i.end_date)) AS missing,
(SELECT count(*) FROM (SELECT i.ticker, d.date FROM iv i JOIN (SELECT DISTINCT date FROM md) d ON d.date BETWEEN i.start_date AND i.end_date
EXCEPT ALL SELECT ticker, date FROM md)) AS extra FROM md""")
def g24_membership_validation(p: Panels):
    back = ref.expanded(p.spans, p.daily.select("date").distinct())
    own = p.daily.select("ticker", "date")
    over = p.spans.withColumn(
        "before", F.expr("lag(end_date) over (partition by ticker order by start_date)")
    ).agg(F.count_if(F.col("start_date") <= F.col("before")).alias("overlapping"))
    rows = own.agg(F.count(F.lit(1)).alias("rows"))
    return rows.crossJoin(over).crossJoin(own.exceptAll(back).agg(F.count(F.lit(1)).alias("missing"))).crossJoin(back.exceptAll(own).agg(F.count(F.lit(1)).alias("extra")))


@query("SELECT ticker, start_date, end_date, CAST(end_date - start_date + 1 AS BIGINT) AS days FROM iv ORDER BY days DESC, ticker, start_date LIMIT 10")
def g22_longest_tenures(p: Panels):
    return p.spans.select(
        "ticker", "start_date", "end_date", (F.datediff("end_date", "start_date") + 1).cast("long").alias("days")
    ).orderBy(F.desc("days"), "ticker", "start_date").limit(10)


@query("""SELECT ticker, 'added' AS change FROM (SELECT ticker FROM md WHERE date = DATE '1998-12-31' EXCEPT SELECT ticker FROM md
WHERE date = DATE '1997-12-31') UNION ALL SELECT ticker, 'removed' FROM (SELECT ticker FROM md
WHERE date = DATE '1997-12-31' EXCEPT SELECT ticker FROM md WHERE date = DATE '1998-12-31')""")
def g21_changes(p: Panels):
    a, b = (p.daily.where(F.col("date") == F.lit(d).cast("date")).select("ticker") for d in ("1997-12-31", "1998-12-31"))
    return b.subtract(a).withColumn("change", F.lit("added")).unionByName(a.subtract(b).withColumn("change", F.lit("removed")))


@query("""SELECT ticker, greatest(start_date, DATE '1996-01-01') AS start_date, least(end_date, DATE '1998-12-31') AS end_date FROM iv
WHERE start_date <= DATE '1998-12-31' AND end_date >= DATE '1996-01-01'""")
def g2_interval_overlap(p: Panels):
    return ref.overlaps(p.spans, "1996-01-01", "1998-12-31").select("ticker", "start_date", "end_date")


@query("SELECT p.ticker, p.date, round(p.adj_close, 9) AS adj_close FROM px p SEMI JOIN md ON p.ticker = md.ticker AND p.date = md.date")
def c8_point_in_time(p: Panels):
    return rounded(p.prices.join(p.daily, ["ticker", "date"], "left_semi"), "ticker", "date", "adj_close:9")


@query("""SELECT p.ticker, p.date, round(p.adj_close, 9) AS adj_close FROM px p WHERE EXISTS (SELECT 1 FROM iv
WHERE iv.ticker = p.ticker AND p.date BETWEEN iv.start_date AND iv.end_date)""")
def c9_interval_semi_join(p: Panels):
    return rounded(ref.while_member(p.prices, p.spans), "ticker", "date", "adj_close:9")


@query("SELECT DISTINCT md.ticker FROM md ANTI JOIN px ON md.ticker = px.ticker")
def c11_members_without_prices(p: Panels):
    return p.daily.select("ticker").distinct().join(p.prices.select("ticker").distinct(), "ticker", "left_anti")


_RAW = "SELECT date, string_agg(CASE WHEN ticker % 3 = 0 THEN ' \"cust' || ticker || '\"' ELSE ' Cust ' || ticker END, ',') AS tickers FROM md GROUP BY date"


@query(f"SELECT DISTINCT date, upper(replace(replace(trim(t), '\"', ''), ' ', '')) AS ticker FROM (SELECT date, unnest(string_split(tickers, ',')) AS t FROM ({_RAW}))")
def g1_explode_members(p: Panels):
    # The raw form has a list a date, as a membership file has; it is made here from the derived table.
    name = F.when(F.col("ticker") % 3 == 0, F.concat(F.lit(' "cust'), F.col("ticker"), F.lit('"'))).otherwise(F.concat(F.lit(" Cust "), F.col("ticker")))
    raw = p.daily.groupBy(F.date_format("date", "yyyy-MM-dd").alias("date")).agg(F.array_join(F.collect_list(name), ",").alias("tickers"))
    return src.explode_members(raw)


_SUCC = """su AS (SELECT p_partkey AS old, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_partkey + 1 END AS new FROM part
WHERE p_partkey % 7 IN (1, 2) OR p_partkey % 11 = 0)"""


@query(
    f"WITH RECURSIVE {_SUCC}, ch AS (SELECT old, new AS final, 1 AS hop, true AS open FROM su UNION ALL SELECT c.old, s.new, c.hop + 1, true FROM ch c JOIN su s ON c.final = s.old WHERE c.hop < 10) SELECT p.p_partkey AS key, CASE WHEN l.old IS NULL THEN p.p_partkey ELSE l.final END AS resolved, l.old IS NOT NULL AND l.final IS NULL AS delisted FROM part p LEFT JOIN (SELECT old, arg_max(struct_pack(f := final), hop).f AS final FROM ch GROUP BY old) l ON p.p_partkey = l.old",
    False
)
def g12_successors(p: Panels):
    closed = ref.closed_successors(src.successors(p.table("part")))
    return ref.resolved(p.table("part").select(F.col("p_partkey").alias("key")), closed, "key").select("key", "resolved", "delisted")


@query(
    f"WITH RECURSIVE {_SUCC}, ch AS (SELECT old, new AS final, 1 AS hop, CAST(old AS VARCHAR) || '>' || coalesce(CAST(new AS VARCHAR), 'none') AS chain FROM su UNION ALL SELECT c.old, s.new, c.hop + 1, c.chain || '>' || coalesce(CAST(s.new AS VARCHAR), 'none') FROM ch c JOIN su s ON c.final = s.old WHERE c.hop < 10) SELECT old, arg_max(chain, hop) AS chain FROM ch GROUP BY old",
    False
)
def g13_chains(p: Panels):
    closed = ref.closed_successors(src.successors(p.table("part")))
    return closed.select("old", F.array_join("chain", ">", "none").alias("chain"))


@query("""WITH nm AS (SELECT s_nationkey AS entity, s_suppkey AS ticker FROM supplier), ls AS (SELECT entity, list(ticker ORDER BY ticker) AS every
FROM nm GROUP BY entity
HAVING count(*) > 1) SELECT CAST(n.entity AS BIGINT) AS entity, n.ticker, array_to_string(list_filter(every, lambda x: x <> n.ticker),
',') AS others FROM nm n JOIN ls ON n.entity = ls.entity""", False)
def d8_alternative_tickers(p: Panels):
    names = p.table("supplier").select(
        F.col("s_nationkey").cast("long").alias("entity"), F.col("s_suppkey").alias("ticker"),
        F.lit("1995-01-01").cast("date").alias("start_date")
    )
    return ref.alternatives(names).select("entity", "ticker", F.array_join(F.transform("others", lambda x: x.cast("string")), ",").alias("others"))


@query("SELECT s_suppkey AS key, upper(trim(s_name)) || CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE '.B' END AS ticker FROM supplier", False)
def g15_clean_tickers(p: Panels):
    raw = F.concat(F.lit(" "), F.lower("s_name"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("."), F.col("s_suppkey"))).otherwise(".b"))
    return p.table("supplier").select(F.col("s_suppkey").alias("key"), fd.clean_ticker(raw).alias("ticker"))


_SIC = "CASE WHEN sic <= 999 THEN 'Agriculture' WHEN sic <= 1499 THEN 'Mining' WHEN sic <= 1799 THEN 'Construction' WHEN sic <= 3999 THEN 'Manufacturing' WHEN sic <= 4999 THEN 'Transportation & Utilities' WHEN sic <= 5199 THEN 'Wholesale Trade' WHEN sic <= 5999 THEN 'Retail Trade' WHEN sic <= 6799 THEN 'Finance & Real Estate' WHEN sic <= 8999 THEN 'Services' WHEN sic <= 9999 THEN 'Public Administration' END"


@query(
    f"SELECT ticker, {_SIC} AS sector FROM (SELECT l_suppkey AS ticker, max_by(l_partkey * 37 % 10000, l_shipdate * 1) AS sic FROM (SELECT l_suppkey, l_partkey, epoch_us(l_shipdate) * 1000 + l_partkey AS l_shipdate FROM lineitem) GROUP BY 1)".replace("max_by", "arg_max").replace("l_shipdate * 1", "l_shipdate"),
    False
)
def g19_sic_sectors(p: Panels):
    last = p.table("lineitem").groupBy(F.col("l_suppkey").alias("ticker")).agg(F.max_by(
        F.expr("l_partkey * 37 % 10000"), F.expr("unix_micros(cast(l_shipdate as timestamp)) * 1000 + l_partkey")
    ).alias("sic"))
    return last.select("ticker", fd.sic_division(F.col("sic")).alias("sector"))


_REQ = """, rq AS (SELECT ticker, date_trunc('month', start_date)::DATE AS start_date, end_date
FROM iv), pd AS (SELECT o_custkey AS ticker, last_day(CAST(o_orderdate AS DATE)) AS date FROM orders WHERE o_totalprice > 60000 GROUP BY 1, 2), """
_GAP = _REQ + """fd AS (SELECT r.ticker, r.start_date, r.end_date, min(p.date) AS actual_start, max(p.date) AS actual_end FROM rq r LEFT
JOIN pd p ON p.ticker = r.ticker AND p.date BETWEEN r.start_date AND r.end_date GROUP BY 1, 2, 3),
gp AS (SELECT *, greatest(actual_start - last_day(start_date), 0) AS missing_start_days, greatest(end_date - actual_end, 0) AS missing_end_days
FROM fd),
gs AS (SELECT *, CASE WHEN actual_start IS NULL THEN 'missing' WHEN missing_start_days <= 3 AND missing_end_days <= 3 THEN 'complete' ELSE 'partial' END AS status
FROM gp)
"""


def _checked(p: Panels):
    required = p.spans.select("ticker", F.trunc("start_date", "MM").alias("start_date"), "end_date")
    panel = src.membership_daily(p.table("orders").where("o_totalprice > 60000"))
    return ref.gap_check(required, panel)


@query(_GAP + """SELECT ticker, start_date, end_date, actual_start, actual_end,
CASE WHEN actual_start IS NOT NULL THEN CAST(missing_start_days AS BIGINT) END AS missing_start_days,
CASE WHEN actual_start IS NOT NULL THEN CAST(missing_end_days AS BIGINT) END AS missing_end_days, status FROM gs""")
def g3_gap_check(p: Panels):
    df = _checked(p)
    own = lambda c: F.when(F.col("actual_start").isNotNull(), F.col(c).cast("long")).alias(c)
    return df.select("ticker", "start_date", "end_date", "actual_start", "actual_end", own("missing_start_days"), own("missing_end_days"), "status")


_COVER = _GAP + """, cv AS (SELECT ticker, count(*) AS periods, count(*) FILTER (WHERE status = 'complete') AS complete,
count(*) FILTER (WHERE status = 'missing') AS missing,
CAST(sum(CASE WHEN actual_start IS NULL THEN end_date - start_date + 1 ELSE CASE WHEN missing_start_days > 3 THEN missing_start_days ELSE 0 END + CASE WHEN missing_end_days > 3 THEN missing_end_days ELSE 0 END END) AS BIGINT) AS total_missing_days
FROM gs GROUP BY ticker),
cs AS (SELECT *, CASE WHEN complete = periods THEN 'complete' WHEN missing = periods THEN 'missing' ELSE 'partial' END AS status FROM cv)
"""


@query(_COVER + "SELECT ticker, periods, complete, missing, total_missing_days, status FROM cs")
def g4_coverage(p: Panels):
    return ref.coverage(_checked(p)).select("ticker", "periods", "complete", "missing", "total_missing_days", "status")


@query(_COVER + "SELECT coalesce(status, 'total') AS status, count(*) AS n FROM cs GROUP BY ROLLUP (status)")
def d36_status_rollup(p: Panels):
    return ref.coverage(_checked(p)).rollup("status").agg(F.count(F.lit(1)).alias("n")).select(F.coalesce("status", F.lit("total")).alias("status"), "n")


@query(_GAP + """SELECT ticker, CASE WHEN missing_start_days > 3 OR actual_start IS NULL THEN start_date ELSE CAST(actual_end + 1 AS DATE) END AS fetch_start,
CASE WHEN missing_end_days > 3 OR actual_start IS NULL THEN end_date ELSE CAST(actual_start - 1 AS DATE) END AS fetch_end FROM gs
WHERE status <> 'complete'""")
def g6_refetch_list(p: Panels):
    return _checked(p).where("status <> 'complete'").select("ticker", "fetch_start", "fetch_end")


@query("""SELECT ticker, first_month, last_month, expected, present, expected - present AS missing, round((expected - present) * 100.0 / expected,
6) AS gap_percent, expected = present AS continuous, sample_gaps FROM (
SELECT ticker, CAST(min(m) AS DATE) AS first_month, CAST(max(m) AS DATE) AS last_month, count(*) AS present, date_diff('month', min(m),
max(m)) + 1 AS expected FROM (SELECT DISTINCT ticker, date_trunc('month', date) AS m FROM md) GROUP BY ticker) JOIN (
SELECT ticker, coalesce(string_agg(strftime(m, '%Y-%m'), ',' ORDER BY m) FILTER (WHERE lacking AND n <= 10), '') AS sample_gaps FROM (
    SELECT *, sum(CASE WHEN lacking THEN 1 ELSE 0 END) OVER (PARTITION BY ticker ORDER BY m) AS n FROM (
        SELECT r.ticker, r.m, h.m IS NULL AS lacking
FROM (SELECT ticker, unnest(generate_series(min(date_trunc('month', date)), max(date_trunc('month', date)), INTERVAL 1 MONTH)) AS m FROM md
GROUP BY ticker) r
        LEFT JOIN (SELECT DISTINCT ticker, date_trunc('month', date) AS m FROM md) h ON h.ticker = r.ticker AND h.m = r.m))
GROUP BY ticker) USING (ticker)""")
def g8_month_continuity(p: Panels):
    return rounded(
        ref.month_continuity(p.daily), "ticker", "first_month", "last_month", "expected", "present", "missing", "gap_percent:6",
        "continuous", "sample_gaps"
    )


@query("""SELECT ticker, round((expected - present) * 100.0 / expected, 6) AS gap_percent
FROM (SELECT ticker, count(*) AS present, date_diff('month', min(m), max(m)) + 1 AS expected
FROM (SELECT DISTINCT ticker, date_trunc('month', date) AS m FROM md) GROUP BY ticker) ORDER BY gap_percent DESC, ticker LIMIT 20""")
def g9_worst_gaps(p: Panels):
    return rounded(ref.month_continuity(p.daily), "ticker", "gap_percent:6").orderBy(F.desc("gap_percent"), "ticker").limit(20)


@query("""SELECT ticker, count(*) AS n, round(least(100, count(*) * 100.0 / (date_diff('month', min(date), max(date)) + 1)), 6) AS percent FROM px
GROUP BY ticker""")
def g11_completeness(p: Panels):
    df = p.prices.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"),
        F.least(F.lit(100.0), F.expr("count(1) * 100.0D / (months_between(max(date), min(date)) + 1)")).alias("percent")
    )
    return rounded(df, "ticker", "n", "percent:6")


@query("""SELECT name, last_date, CAST(DATE '2002-01-15' - last_date AS BIGINT) AS age_days, DATE '2002-01-15' - last_date > 7 AS stale
FROM (SELECT 'prices' AS name, max(date) AS last_date FROM px UNION ALL SELECT 'scores', max(date) FROM sc
UNION ALL SELECT 'membership', max(date) FROM md)""")
def g26_freshness(p: Panels):
    parts = [
        df.agg(F.max("date").alias("last_date")).withColumn("name", F.lit(n)) for n,
        df in (("prices", p.prices), ("scores", p.scores), ("membership", p.daily))
    ]
    age = F.datediff(F.lit("2002-01-15").cast("date"), F.col("last_date")).cast("long")
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("name", "last_date", age.alias("age_days"), (age > 7).alias("stale"))


@query("""SELECT concat_ws('+', CASE WHEN p THEN 'P' END, CASE WHEN s THEN 'E' END, CASE WHEN m THEN 'M' END) AS pattern, count(*) AS n
FROM (SELECT s_suppkey AS ticker, s_suppkey IN (SELECT ticker FROM px) AS p, s_suppkey IN (SELECT ticker FROM sc
WHERE ESG > 60 AND date >= DATE '2001-10-01') AS s, s_suppkey IN (SELECT ticker FROM md) AS m FROM supplier) GROUP BY 1""")
def d37_completeness_patterns(p: Panels):
    base = p.table("supplier").select(F.col("s_suppkey").alias("ticker"))
    for name, df in (("P", p.prices), ("E", p.scores.where("ESG > 60 and date >= date'2001-10-01'")), ("M", p.daily)):
        base = base.join(df.select("ticker").distinct().withColumn(name, F.lit(name)), "ticker", "left")
    return base.groupBy(F.concat_ws("+", "P", "E", "M").alias("pattern")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT max(n) AS most, min(n) AS least, round(median(n), 4) AS middle
FROM (SELECT CAST(date_diff('day', DATE '1990-01-01', max(date)) AS DOUBLE) AS n FROM px GROUP BY ticker)""")
def d33_last_date_spread(p: Panels):
    last = ref.extents(p.prices).select(F.lit("all").alias("of"), F.datediff("actual_end", F.lit("1990-01-01").cast("date")).cast("double").alias("n"))
    middle = ranks.quantiles(last, "n", [0.5], "of", "q").select("of", F.round(F.col("q")[0], 4).alias("middle"))
    return last.groupBy("of").agg(F.max("n").alias("most"), F.min("n").alias("least")).join(middle, "of").drop("of")


@query("""SELECT date, count(*) AS n, round(count(*) * 100.0 / (SELECT count(DISTINCT ticker) FROM px), 6) AS percent
FROM (SELECT ticker, max(date) AS date FROM px GROUP BY ticker) GROUP BY date ORDER BY date DESC LIMIT 10""")
def d33_last_date_distribution(p: Panels):
    return rounded(ref.last_date_distribution(p.prices, 10), "date", "n", "percent:6")


@query("""SELECT date, round(avg(ESG), 6) AS mean, round(median(ESG), 6) AS median, round(quantile_cont(ESG, 0.25), 6) AS q25, round(quantile_cont(ESG, 0.75),
6) AS q75 FROM sc GROUP BY date""")
def d21_dispersion(p: Panels):
    df = p.scores.groupBy("date").agg(F.avg("ESG").alias("mean")).join(ranks.quantiles(p.scores, "ESG", [0.25, 0.5, 0.75], out="q"), "date")
    return rounded(
        df.select("date", "mean", F.col("q")[1].alias("median"), F.col("q")[0].alias("q25"), F.col("q")[2].alias("q75")), "date", "mean:6",
        "median:6", "q25:6", "q75:6"
    )


@query("""SELECT date, count(*) FILTER (WHERE chg > 0) AS improvers, count(*) FILTER (WHERE chg < 0) AS decliners, count(DISTINCT ticker) AS covered
FROM (SELECT ticker, date, ESG - lag(ESG, 12) OVER (PARTITION BY ticker ORDER BY date) AS chg FROM sc) GROUP BY date""")
def d22_improvers(p: Panels):
    df = p.scores.withColumn("chg", F.expr(f"ESG - lag(ESG, 12) {op.OVER}"))
    return df.groupBy("date").agg(
        F.count_if(F.col("chg") > 0).alias("improvers"), F.count_if(F.col("chg") < 0).alias("decliners"),
        F.count_distinct("ticker").alias("covered")
    )


@query("""SELECT round(count(lagged) * 1.0 / count(*), 8) AS lagged_rate, round(count(ESG) * 1.0 / count(*), 8) AS score_rate
FROM (SELECT ESG, lag(ESG, 12) OVER (PARTITION BY ticker ORDER BY date) AS lagged FROM sc)""")
def d23_column_coverage(p: Panels):
    df = p.scores.withColumn("lagged", F.expr(f"lag(ESG, 12) {op.OVER}"))
    return rounded(
        df.agg((F.count("lagged") / F.count(F.lit(1))).alias("lagged_rate"), (F.count("ESG") / F.count(F.lit(1))).alias("score_rate")),
        "lagged_rate:8", "score_rate:8"
    )


_NEXT = ", nx AS (SELECT ticker, date, lead(ret) OVER (PARTITION BY ticker ORDER BY date) AS nxt FROM ret) "


def _decile_returns(p: Panels):
    deciles = op.quantile_bucket(p.scores, "ESG", out="decile", fused=True).select("ticker", "date", "decile")
    nxt = p.returns.withColumn("nxt", F.expr(f"lead(ret) {op.OVER}")).where("nxt is not null").select("ticker", "date", "nxt")
    return deciles.join(nxt, ["ticker", "date"])


@query(_DECILE.rstrip() + _NEXT + "SELECT date, " + ", ".join(f"round(avg(nxt) FILTER (WHERE decile = {d}), 6) AS d{d}" for d in range(1, 11)) + " FROM dc JOIN nx USING (ticker, date) WHERE nxt IS NOT NULL GROUP BY date")
def d19_decile_pivot(p: Panels):
    wide = _decile_returns(p).groupBy("date").pivot("decile", list(range(1, 11))).agg(F.avg("nxt"))
    return wide.select("date", *(F.round(F.col(str(d)), 6).alias(f"d{d}") for d in range(1, 11)))


@query(_DECILE.rstrip() + _NEXT + """SELECT * FROM (SELECT date, count(*) AS n, round(avg(nxt) FILTER (WHERE decile = 10) - avg(nxt) FILTER (WHERE decile = 1), 6) AS spread FROM dc
JOIN nx USING (ticker, date) WHERE nxt IS NOT NULL GROUP BY date) WHERE n >= 10 AND spread IS NOT NULL""")
def f20_decile_spread(p: Panels):
    df = _decile_returns(p).groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), F.expr("avg(if(decile = 10, nxt, null)) - avg(if(decile = 1, nxt, null))").alias("spread")
    )
    return rounded(df.where("n >= 10 and spread is not null"), "date", "n", "spread:6")


_HORIZONS = (1, 3, 6, 12)
_SPREADS = (
    _DECILE.rstrip()
    + ", fw AS (SELECT ticker, date, "
    + ", ".join(f"lead(adj_close, {h}) OVER (PARTITION BY ticker ORDER BY date) / adj_close - 1 AS fwd_{h}" for h in _HORIZONS)
    + " FROM px), ls AS ("
    + " UNION ALL ".join(
        f"""SELECT date, {h} AS horizon, avg(fwd_{h}) FILTER (WHERE decile = 10) AS decile_long, avg(fwd_{h}) FILTER (WHERE decile = 1) AS decile_short,
    avg(fwd_{h}) FILTER (WHERE decile > 8) - avg(fwd_{h}) FILTER (WHERE decile <= 2) AS quintile_spread FROM dc JOIN fw USING (ticker, date) GROUP BY date"""
        for h in _HORIZONS
    )
    + ") "
)


def _spreads(p: Panels):
    deciles = op.quantile_bucket(p.scores, "ESG", out="decile", fused=True).select("ticker", "date", "decile")
    return op.horizon_spreads(deciles, op.forward_returns(p.prices, list(_HORIZONS)), list(_HORIZONS))


@query(_SPREADS + """SELECT date, CAST(horizon AS INTEGER) AS horizon, round(decile_long, 6) AS decile_long, round(decile_short, 6) AS decile_short,
round(decile_long - decile_short, 6) AS decile_spread, round(quintile_spread, 6) AS quintile_spread FROM ls""")
def f19_horizon_spreads(p: Panels):
    return rounded(_spreads(p), "date", "horizon", "decile_long:6", "decile_short:6", "decile_spread:6", "quintile_spread:6")


@query(_SPREADS + """SELECT CAST(horizon AS INTEGER) AS horizon, count(*) AS n, round(avg(s), 6) AS mean, round(stddev_samp(s), 6) AS std,
round(avg(s) / nullif(stddev_samp(s), 0) * sqrt(12.0 / horizon), 5) AS sharpe, round(avg(CASE WHEN s > 0 THEN 1.0 ELSE 0.0 END), 6) AS win_rate
FROM (SELECT horizon, decile_long - decile_short AS s FROM ls) WHERE s IS NOT NULL GROUP BY horizon""")
def d20_holding_summary(p: Panels):
    return rounded(op.holding_summary(_spreads(p)), "horizon", "n", "mean:6", "std:6", "sharpe:5", "win_rate:6")


@query("SELECT ticker, date, round(0.5 * E + 0.3 * S + 0.2 * G, 6) AS composite FROM sc")
def f16_pillar_weighted(p: Panels):
    return rounded(p.scores.withColumn("composite", F.expr("0.5D * E + 0.3D * S + 0.2D * G")), "ticker", "date", "composite:6")


def _ranked_sql(rows: str) -> str:
    """z, percentile rank of 100 and decile of `score` within (method, date) of a table of method, ticker, date, score."""
    return f""", fm AS ({rows}), fe AS (SELECT method, date, quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges, avg(score) AS m, stddev_samp(score) AS s FROM fm GROUP BY 1, 2)
SELECT method, ticker, date, round(score, 6) AS score, round(CASE WHEN s > 0 THEN (score - m) / s ELSE 0 END, 6) AS z, 1 + len(list_filter(edges, lambda e: e < score)) AS decile,
round((rank() OVER (PARTITION BY method, date ORDER BY score) + (count(*) OVER (PARTITION BY method, date, score) - 1) / 2.0) / count(*) OVER (PARTITION BY method, date) * 100, 6) AS pctrank FROM fm JOIN fe USING (method, date)"""


_COMPOSITE = """SELECT 'quality_momentum' AS method, ticker, date, (z + coalesce(mom, 0) / 10) / 2 AS score
FROM (SELECT ticker, date, CASE WHEN stddev_samp(ESG) OVER d > 0 THEN (ESG - avg(ESG) OVER d) / stddev_samp(ESG) OVER d ELSE 0 END AS z,
ESG - lag(ESG, 12) OVER (PARTITION BY ticker ORDER BY date) AS mom FROM sc WINDOW d AS (PARTITION BY date))"""
_RANKED = ("method", "ticker", "date", "score:6", "z:6", "decile", "pctrank:6")


def _ranked(df):
    return rounded(df.withColumn("decile", F.col("decile").cast("long")), *_RANKED)


@query(_ranked_sql(_COMPOSITE))
def f17_quality_momentum(p: Panels):
    return _ranked(op.formation_ranks(op.quality_momentum(p.scores)))


@query(_ranked_sql("""SELECT method, ticker, date, round(score, 9) AS score FROM (SELECT 'esg_score' AS method, ticker, date, ESG AS score FROM sc
UNION ALL SELECT 'pillar_weighted', ticker, date, 0.5 * E + 0.3 * S + 0.2 * G FROM sc UNION ALL SELECT *
FROM (SELECT 'momentum', ticker, date, ESG / nullif(lag(ESG, 12) OVER (PARTITION BY ticker ORDER BY date), 0) - 1 AS score FROM sc)
WHERE score IS NOT NULL)"""))
def f18_formation_methods(p: Panels):
    scored = op.formation_scores(p.scores, {"E": 0.5, "S": 0.3, "G": 0.2}).withColumn("score", F.round("score", 9))  # else sums that are equal differ in their last bits
    return _ranked(op.formation_ranks(scored))


@query(_DECILE + """SELECT a.ticker, a.date, CAST(a.decile - b.decile AS BIGINT) AS change FROM dc a
JOIN (SELECT s.ticker, s.date, 1 + len(list_filter(edges, lambda e: e < E)) AS decile FROM sc s
JOIN (SELECT date, quantile_cont(E, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM sc
GROUP BY date) ed2 ON s.date = ed2.date) b ON a.ticker = b.ticker AND a.date = b.date""")
def c16_rank_change(p: Panels):
    a, b = op.quantile_bucket(p.scores, "ESG", out="a", fused=True).select("ticker", "date", "a"), op.quantile_bucket(p.scores, "E", out="b", fused=True).select("ticker", "date", "b")
    return a.join(b, ["ticker", "date"]).select("ticker", "date", (F.col("a") - F.col("b")).cast("long").alias("change"))


@query(_DECILE + """SELECT ticker, date, CAST(decile AS BIGINT) AS decile FROM (SELECT dc.*, ESG - lag(ESG, 12) OVER (PARTITION BY ticker ORDER BY date) AS mom
FROM dc) WHERE decile >= 9 AND mom > 0""")
def b10_screens(p: Panels):
    df = op.quantile_bucket(p.scores, "ESG", out="decile", fused=True).withColumn("mom", F.expr(f"ESG - lag(ESG, 12) {op.OVER}"))
    return df.where("decile >= 9 and mom > 0").select("ticker", "date", F.col("decile").cast("long").alias("decile"))


@query("""SELECT ticker, date FROM (SELECT ticker, date, ESG - lag(ESG, 3) OVER w AS c3, ESG - lag(ESG, 6) OVER w AS c6, ESG - lag(ESG, 12) OVER w AS c12
FROM sc WINDOW w AS (PARTITION BY ticker ORDER BY date)) WHERE c3 > 0 AND c6 > 0 AND c12 > 0""")
def b10_consistent_improvers(p: Panels):
    return op.consistent_improvers(p.scores, "ESG", [3, 6, 12]).select("ticker", "date")


@query("SELECT ticker, round(ESG, 6) AS ESG FROM sc WHERE date = (SELECT max(date) FROM sc WHERE date <= DATE '1999-12-31') ORDER BY ESG DESC, ticker LIMIT 10")
def h3_top_k(p: Panels):
    df = p.scores.where("date = date'1999-12-31'")
    return rounded(df.orderBy(F.desc("ESG"), "ticker").limit(10), "ticker", "ESG:6")


@query("SELECT date, ticker, round(ESG, 6) AS ESG FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY ESG DESC, ticker) AS n FROM sc) WHERE n <= 3")
def h4_top_k_per_date(p: Panels):
    df = p.scores.withColumn("n", F.expr("row_number() over (partition by date order by ESG desc, ticker)")).where("n <= 3")
    return rounded(df, "date", "ticker", "ESG:6")


@query("""SELECT s_suppkey AS key, last_day(d) AS monthly, CAST(d + CAST((5 - isodow(d) + 7) % 7 AS INTEGER) AS DATE) AS weekly
FROM (SELECT s_suppkey, CAST(DATE '2014-01-01' + CAST(s_suppkey % 400 AS INTEGER) AS DATE) AS d FROM supplier)""", False)
def i2_aligned_start(p: Panels):
    d = F.expr("date_add(date'2014-01-01', cast(s_suppkey % 400 as int))")
    return p.table("supplier").select(
        F.col("s_suppkey").alias("key"), fd.aligned_start(d, F.lit("monthly")).alias("monthly"),
        fd.aligned_start(d, F.lit("weekly")).alias("weekly")
    )


@query("""SELECT date, round(rate / 100 / 12, 9) AS monthly, round(rate / 100 / 52, 9) AS weekly, round(rate / 100 / 252, 9) AS daily,
round(power(1 + rate / 1200, 12) - 1, 9) AS compounded, round(rate / 1200, 9) AS back FROM rf""")
def i9_periodic_rates(p: Panels):
    r = F.col("rate")
    df = p.rates.select(
        "date", fd.periodic(r, 12).alias("monthly"), fd.periodic(r, 52).alias("weekly"), fd.periodic(r, 252).alias("daily"),
        fd.compounded(fd.periodic(r, 12)).alias("compounded")
    )
    return rounded(df.withColumn("back", fd.monthly_from_annual(F.col("compounded"))), "date", "monthly:9", "weekly:9", "daily:9", "compounded:9", "back:9")


_LAST60 = ", l60 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) - 1 AS age FROM ret) WHERE age < 60) "


@query(_LAST60 + """, mn AS (SELECT ticker, avg(ret) * 12 AS mean FROM l60
GROUP BY ticker) SELECT ticker, round(mean, 6) AS mean, round(0.7 * mean + 0.3 * (SELECT avg(mean) FROM mn), 6) AS bayes FROM mn""")
def d25_bayes_means(p: Panels):
    return rounded(pf.to_grand_mean(pf.historical_mean(p.returns)), "ticker", "mean:6", "bayes:6")


@query("""SELECT ticker, round(sum(ret * power(1 - 1.0 / 36, age)) / sum(power(1 - 1.0 / 36, age)) * 12, 6) AS ewma
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) - 1 AS age FROM ret) GROUP BY ticker HAVING count(*) >= 36""")
def d27_ewma(p: Panels):
    return rounded(pf.ewma(p.returns), "ticker", "ewma:6")


def _mixed_sql(h: str) -> str:
    step = lambda x: f"((xor({x}, {x} >> 16) * 73244475) % 2147483648)"
    return step(step(h))


@query(f""", hs AS (SELECT ticker, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS i, count(*) OVER (PARTITION BY ticker) AS n, ret FROM ret),
dr AS (SELECT ticker, n, b, {_mixed_sql(f"xor({_mixed_sql('((b * 7919 + ticker * 104729 + 5) % 2147483648)')}, (i * 1103515245) % 2147483648)")} % n AS i FROM hs CROSS JOIN (SELECT unnest(range(0, 1000)) AS b)),
bm AS (SELECT d.ticker, d.b, sum(h.ret) / any_value(d.n) * 12 AS m FROM dr d JOIN hs h ON h.ticker = d.ticker AND h.i = d.i GROUP BY 1, 2)
SELECT ticker, round(avg(m), 6) AS mean, round(stddev_samp(m), 6) AS std_error, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high FROM bm GROUP BY ticker""")
def d28_bootstrap(p: Panels):
    return rounded(pf.bootstrap(p.returns), "ticker", "mean:6", "std_error:6", "low:6", "high:6")


@query()
def d24_james_stein(p: Panels):
    universe = p.returns.join(p.sectors, "ticker")
    return rounded(rg.james_stein(universe.select("sector", "ticker", "date", "ret"), "sector"), "sector", "ticker", "mean:6", "shrunk:6", "intensity:6")


_TRAIN = """, tr AS (SELECT ticker, avg(ret) * 12 AS mean FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS n FROM ret
WHERE date <= DATE '1999-12-31') WHERE n <= 60 GROUP BY ticker),
ew AS (SELECT ticker, sum(ret * power(1 - 1.0 / 36, age)) / sum(power(1 - 1.0 / 36, age)) * 12 AS ewma
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) - 1 AS age FROM ret WHERE date <= DATE '1999-12-31')
GROUP BY ticker HAVING count(*) >= 36),
te AS (SELECT ticker, avg(ret) * 12 AS real FROM ret WHERE date > DATE '1999-12-31' GROUP BY ticker),
er AS (SELECT 'mean' AS method, mean - real AS e FROM tr JOIN te USING (ticker) UNION ALL SELECT 'bayes', 0.7 * mean + 0.3 * (SELECT avg(mean)
FROM tr) - real FROM tr JOIN te USING (ticker) UNION ALL SELECT 'ewma', ewma - real FROM ew JOIN te USING (ticker))
"""


def _estimates(train):
    """method, ticker, value of the plain, the shrunk and the weighted mean on the training rows."""
    means = pf.to_grand_mean(pf.historical_mean(train)).unpivot(["ticker"], ["mean", "bayes"], "method", "value")
    return means.unionByName(pf.ewma(train).select("ticker", F.lit("ewma").alias("method"), F.col("ewma").alias("value")))


@query(_TRAIN + """SELECT method, count(*) AS n, round(avg(e * e), 6) AS mse, round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse FROM er GROUP BY method""")
def d29_out_of_sample(p: Panels):
    train, test = p.returns.where("date <= date'1999-12-31'"), p.returns.where("date > date'1999-12-31'")
    return rounded(pf.out_of_sample(_estimates(train), test), "method", "n", "mse:6", "mae:6", "rmse:6")


@query()
def d29_out_of_sample_james_stein(p: Panels):
    """As above with James-Stein means by sector, which need a solve that SQL lacks."""
    train, test = p.returns.where("date <= date'1999-12-31'"), p.returns.where("date > date'1999-12-31'")
    shrunk = rg.james_stein(train.join(p.sectors, "ticker").select("sector", "ticker", "date", "ret"), "sector")
    every = _estimates(train).unionByName(shrunk.select("ticker", F.lit("james_stein").alias("method"), F.col("shrunk").alias("value")))
    return rounded(pf.out_of_sample(every, test), "method", "n", "mse:6", "mae:6", "rmse:6")


@query("""SELECT ticker, date, round(avg(ret) OVER w * 12, 6) AS estimate FROM ret WINDOW w AS (PARTITION BY ticker
ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) QUALIFY count(*) OVER w = 60""")
def e18_rolling_mean(p: Panels):
    return rounded(pf.rolling_mean_returns(p.returns), "ticker", "date", "estimate:6")


@query(""", ix AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) AS i FROM ret)
SELECT a.ticker, a.date, round(sum(b.ret * power(1 - 2.0 / 31, a.i - b.i)) / sum(power(1 - 2.0 / 31, a.i - b.i)) * 12, 6) AS estimate FROM ix a
JOIN ix b ON a.ticker = b.ticker AND a.i - b.i BETWEEN 0 AND 59 WHERE a.i >= 60 GROUP BY 1, 2""")
def e18_rolling_ewma(p: Panels):
    return rounded(pf.rolling_mean_returns(p.returns, 60, "ewma"), "ticker", "date", "estimate:6")


@query("""SELECT ticker, round(power(1 + m, 12) - 1, 6) AS ann_return, round(s * sqrt(12), 6) AS ann_vol, round((m - f) / s * sqrt(12), 5) AS sharpe,
round((m - f) * 12 / beta, 4) AS treynor, round(active / te * sqrt(12), 5) AS information, round((m - f) / down * sqrt(12), 5) AS sortino,
round(abs(beta) * sm * sqrt(12), 6) AS systematic, round(CASE WHEN n > 2 THEN sqrt(greatest(syy - beta * beta * sxx, 0) / (n - 1)) * sqrt(12) END, 5) AS residual
FROM (SELECT ticker, avg(ret) AS m, stddev_samp(ret) AS s, avg(rf) AS f, regr_slope(ret, mkt) AS beta, stddev_samp(mkt) AS sm,
count(*) AS n, regr_syy(ret, mkt) AS syy, regr_sxx(ret, mkt) AS sxx, stddev_samp(ret) FILTER (WHERE ret < rf) AS down, avg(ret - mkt) AS active, stddev_samp(ret - mkt) AS te FROM exc GROUP BY ticker)""")
def d34_performance(p: Panels):
    return rounded(pf.performance(p.excess), "ticker", "ann_return:6", "ann_vol:6", "sharpe:5", "treynor:4", "information:5", "sortino:5", "systematic:6", "residual:5")


# Candidate portfolios: suppliers of a residue class, weights in unequal steps. The SQL's variance is over pairs of names, on the dates that all names have.
_WTS = """, w0 AS (SELECT 'p' || (ticker % 5) AS portfolio, ticker, 1 + ticker % 7 AS size FROM (SELECT DISTINCT ticker
FROM px)), wt AS (SELECT portfolio, ticker, size * 1.0 / sum(size) OVER (PARTITION BY portfolio) AS weight FROM w0),
bw AS (SELECT ticker, 1.0 / count(*) OVER () AS weight FROM (SELECT DISTINCT ticker FROM px)), mo AS (SELECT ticker, avg(ret) AS mean
FROM ret GROUP BY ticker), xp AS (SELECT ticker, (avg(ESG) - (SELECT avg(ESG) FROM sc)) / 10 AS exposure FROM sc GROUP BY ticker),
fd AS (SELECT portfolio, date FROM wt JOIN ret USING (ticker) GROUP BY 1, 2 HAVING count(*) = (SELECT count(*) FROM wt w
WHERE w.portfolio = wt.portfolio)),
fr AS (SELECT portfolio, ticker, date, ret FROM wt JOIN ret USING (ticker) SEMI JOIN fd USING (portfolio, date)),
cv AS (SELECT portfolio, a.ticker AS i, b.ticker AS j, covar_samp(a.ret, b.ret) AS cov FROM fr a JOIN fr b USING (portfolio, date) GROUP BY 1, 2, 3),
rk AS (SELECT portfolio, sum(a.weight * b.weight * cov) AS variance,
sqrt(sum((a.weight - c.weight) * (b.weight - d.weight) * cov)) AS tracking_error FROM cv JOIN wt a USING (portfolio) JOIN wt b USING (portfolio)
JOIN bw c ON c.ticker = i JOIN bw d ON d.ticker = j WHERE a.ticker = i AND b.ticker = j GROUP BY 1),
st AS (SELECT * FROM (SELECT portfolio, sum(wt.weight * mean) AS exp_return, sum(wt.weight * coalesce(exposure, 0)) AS exposure,
sum((wt.weight - bw.weight) * mean) AS active_return FROM wt JOIN mo USING (ticker) JOIN bw USING (ticker) LEFT JOIN xp USING (ticker)
GROUP BY 1) JOIN rk USING (portfolio)) """
_BAND, _NAME_CAP, _SECTOR_CAP = (-0.15, 0.15), 0.2, 0.35
_RULES = f""", sx AS (SELECT portfolio, count(*) FILTER (WHERE w > {_SECTOR_CAP} + 1e-9) AS sectors_over FROM (SELECT portfolio, sector, sum(weight) AS w FROM wt LEFT JOIN sect USING (ticker) GROUP BY 1, 2) GROUP BY 1),
nm AS (SELECT portfolio, sum(weight) AS total, count(*) FILTER (WHERE weight < -1e-9) AS negative, count(*) FILTER (WHERE weight > {_NAME_CAP} + 1e-9) AS names_over, count(*) FILTER (WHERE abs(weight) > 1e-6) AS active FROM wt GROUP BY 1),
ru AS (SELECT *, NOT exposure BETWEEN {_BAND[0]} - 1e-9 AND {_BAND[1]} + 1e-9 AS outside_band FROM nm JOIN sx USING (portfolio) JOIN (SELECT portfolio, exposure FROM st) USING (portfolio)),
fe AS (SELECT *, abs(total - 1) < 1e-6 AND negative = 0 AND names_over = 0 AND sectors_over = 0 AND NOT outside_band AS feasible FROM ru) """


def _weights(p: Panels):
    names = p.prices.select("ticker").distinct()
    weights = names.select(F.concat(F.lit("p"), F.col("ticker") % 5).alias("portfolio"), "ticker", (1 + F.col("ticker") % 7).cast("double").alias("size"))
    return weights.withColumn("weight", F.expr("size / sum(size) over (partition by portfolio)")).drop("size")


def _benchmark(p: Panels):
    names = p.prices.select("ticker").distinct()
    return names.crossJoin(names.agg(F.count(F.lit(1)).alias("n"))).select("ticker", (1.0 / F.col("n")).alias("weight"))  # one row


def _exposures(p: Panels):
    own = p.scores.groupBy("ticker").agg(F.avg("ESG").alias("e"))
    return own.crossJoin(p.scores.agg(F.avg("ESG").alias("g"))).select("ticker", ((F.col("e") - F.col("g")) / 10).alias("exposure"))  # one row


def _portfolios(p: Panels):
    weights = _weights(p)
    return weights, pf.evaluate(weights, p.returns, 0.002, _exposures(p), _benchmark(p))


def _feasible(p: Panels):
    return pf.constraints(_weights(p), p.sectors, _NAME_CAP, _SECTOR_CAP, _exposures(p), _BAND)


@query(_WTS + """SELECT portfolio, round(exp_return, 6) AS exp_return, round(variance, 8) AS variance, round((exp_return - 0.002) / sqrt(variance), 5) AS sharpe,
round(exposure, 6) AS exposure, round(tracking_error, 7) AS tracking_error, round(active_return, 7) AS active_return FROM st""")
def f21_portfolio_evaluation(p: Panels):
    return rounded(_portfolios(p)[1], "portfolio", "exp_return:6", "variance:8", "sharpe:5", "exposure:6", "tracking_error:7", "active_return:7")


@query(_WTS + _RULES + "SELECT portfolio, round(total, 8) AS total, negative, names_over, active, sectors_over, outside_band, feasible FROM fe")
def f22_constraints(p: Panels):
    return rounded(_feasible(p), "portfolio", "total:8", "negative", "names_over", "active", "sectors_over", "outside_band", "feasible")


@query(_WTS + _RULES + """, tn AS (SELECT p.portfolio, sum(abs(coalesce(w.weight, 0) - b.weight)) AS turnover FROM (SELECT DISTINCT portfolio FROM wt) p CROSS
JOIN bw b LEFT JOIN wt w ON w.portfolio = p.portfolio AND w.ticker = b.ticker
GROUP BY 1) SELECT gamma, arg_max(portfolio, exp_return - gamma / 2 * variance - 0.001 * turnover) AS portfolio,
round(max(exp_return - gamma / 2 * variance - 0.001 * turnover), 7) AS utility FROM st JOIN tn USING (portfolio) SEMI JOIN (SELECT * FROM fe
WHERE feasible) f USING (portfolio) CROSS JOIN (SELECT unnest([1.0, 5.0, 20.0]::DOUBLE[]) AS gamma) GROUP BY gamma""")
def f23_frontier(p: Panels):
    weights, stats = _portfolios(p)
    return rounded(pf.frontier(stats, _feasible(p), [1.0, 5.0, 20.0], pf.turnover(weights, _benchmark(p)), 0.001), "gamma", "portfolio", "utility:7")


@query(_WTS + """SELECT portfolio, round(sum(weight) FILTER (WHERE n <= 5), 6) AS top_5, round(sum(weight) FILTER (WHERE n <= 10), 6) AS top_10,
round(sum(weight) FILTER (WHERE n <= 20), 6) AS top_20 FROM (SELECT *, row_number() OVER (PARTITION BY portfolio
ORDER BY weight DESC, ticker) AS n FROM wt) GROUP BY 1""")
def f26_concentration(p: Panels):
    return rounded(pf.concentration(_portfolios(p)[0]), "portfolio", "top_5:6", "top_10:6", "top_20:6")


@query("""SELECT ticker, round(best.w, 4) AS weight, round(sh, 5) AS sharpe, round(best.w * sqrt(v) + (1 - best.w) * sqrt(vm) - best.risk, 6) AS benefit
FROM (SELECT ticker, any_value(v) AS v, any_value(vm) AS vm, arg_max({'w': w, 'risk': risk}, (w * m + (1 - w) * mm - f) / risk) AS best,
max((w * m + (1 - w) * mm - f) / risk) AS sh FROM (
SELECT *, sqrt(w * w * v + (1 - w) * (1 - w) * vm + 2 * w * (1 - w) * c) AS risk
FROM (SELECT ticker, avg(ret) AS m, avg(mkt) AS mm, avg(rf) AS f, var_samp(ret) AS v, var_samp(mkt) AS vm, covar_samp(ret, mkt) AS c
FROM exc GROUP BY ticker) CROSS JOIN (SELECT unnest(range(0, 1000)) / 999.0 AS w)) GROUP BY ticker)""")
def f25_two_asset_grid(p: Panels):
    return rounded(pf.two_asset_grid(p.excess), "ticker", "weight:4", "sharpe:5", "benefit:6")


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2", False)
def k4_daily_event_counts(p: Panels):
    return p.table("events").groupBy(F.date_trunc("day", "ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT user_id, date, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY date) AS value FROM (SELECT s.user_id, s.date, b.value
FROM (SELECT user_id, CAST(unnest(generate_series(min(fri), max(fri), INTERVAL 7 DAY)) AS DATE) AS date
FROM (SELECT user_id, CAST(CAST(ts AS DATE) + CAST((5 - isodow(ts) + 7) % 7 AS INTEGER) AS DATE) AS fri FROM events) GROUP BY user_id) s LEFT
JOIN (SELECT user_id, CAST(CAST(ts AS DATE) + CAST((5 - isodow(ts) + 7) % 7 AS INTEGER) AS DATE) AS date, arg_max(value,
CAST(epoch_us(ts) AS HUGEINT) * 1000000 + event_id) AS value FROM events GROUP BY 1, 2) b ON s.user_id = b.user_id AND s.date = b.date)""", False)
def k4_weekly_bars(p: Panels):
    return ref.period_bars(p.table("events"), "user_id", "value")


@query("""SELECT s.event_type, s.date, last_value(b.value IGNORE NULLS) OVER (PARTITION BY s.event_type ORDER BY s.date) AS value
FROM (SELECT event_type, last_day(CAST(unnest(generate_series(date_trunc('month', min(ts)), date_trunc('month', max(ts)), INTERVAL 1 MONTH)) AS DATE)) AS date
FROM events GROUP BY event_type) s LEFT JOIN (SELECT event_type, last_day(CAST(ts AS DATE)) AS date,
arg_max(value, CAST(epoch_us(ts) AS HUGEINT) * 1000000 + event_id) AS value FROM events GROUP BY 1, 2) b ON s.event_type = b.event_type AND s.date = b.date""", False)
def k4_monthly_bars(p: Panels):
    return ref.period_bars(p.table("events"), "event_type", "value", "month")


@query("""SELECT event_type, ts AS start, n FROM (SELECT event_type, time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS ts, count(*) AS n
FROM events GROUP BY 1, 2)""", False)
def k4_tumbling_bars(p: Panels):
    return ingest.bars(p.table("events")).select("event_type", "start", "n")


@query("""SELECT event_type, start, count(*) AS n, count(DISTINCT user_id) AS users
FROM (SELECT event_type, user_id, date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS start FROM events CROSS
JOIN (SELECT unnest(range(0, 7)) AS k)) GROUP BY 1, 2""", False)
def k5_window_counts(p: Panels):
    return ingest.rolling_coverage(p.table("events")).select("event_type", "start", "n", "users")


@query("""SELECT event_type, start, count(*) AS n, count(DISTINCT user_id) AS users
FROM (SELECT event_type, user_id, date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS start FROM events CROSS
JOIN (SELECT unnest(range(0, 7)) AS k)) WHERE start + INTERVAL 7 DAY <= (SELECT max(ts) FROM events) - INTERVAL 5 DAY GROUP BY 1, 2""", False)
def k5_stream_windows(p: Panels):
    """The windows that a stream of all events has closed: those that end before the watermark, 5 days behind the newest event."""
    work = ingest.work_folder(p.spark)
    stream = ingest.rolling_coverage(ingest.read_events(p.spark, p.folder, "events.parquet"))
    stream.writeStream.format("parquet").option("path", f"{work}/windows").option("checkpointLocation", f"{work}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return p.spark.read.schema(stream.schema).parquet(f"{work}/windows").select("event_type", "start", "n", "users")


@query("""SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 1 DAY AS "end", count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id
ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id
ORDER BY ts) + INTERVAL 1 DAY > ts THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, g""", False)
def k6_spells(p: Panels):
    return ingest.spells(p.table("events")).select("user_id", "start", "end", "n")


@query("SELECT CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, count(*) AS n FROM events GROUP BY 1", False)
def i15_json_payload(p: Panels):
    return p.table("events").select(F.from_json("props", "k string").alias("j")).groupBy(F.col("j.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT date, CASE WHEN rate >= 4 THEN round(rate, 6) END AS value FROM rf")
def i15_observations(p: Panels):
    """A vendor payload a year, observations[] of date and value with '.' for none, made from the rates and read back."""
    value = F.when(F.col("rate") >= 4, F.col("rate").cast("string")).otherwise(".")
    each = F.struct(F.col("date").cast("string").alias("date"), value.alias("value"))
    payload = p.rates.groupBy(F.year("date").alias("year")).agg(F.to_json(F.struct(F.lit("rate").alias("series"), F.collect_list(each).alias("observations"))).alias("body"))
    return rounded(src.observations(payload, "body"), "date", "value:6")


@query("""SELECT ticker, start_date, end_date FROM iv JOIN (SELECT date, lead(date) OVER (ORDER BY date) AS next FROM (SELECT DISTINCT date FROM md)) n
ON n.date = iv.end_date WHERE next < (SELECT max(date) FROM md) - INTERVAL 5 DAY""")
def k6_recorded_spells(p: Panels):
    """Membership spells over recorded dates, from a stream of the order rows: those that the watermark has closed."""
    work = ingest.work_folder(p.spark)
    src.save_table(p.daily.select("date").distinct(), f"{work}/dates")
    rows = ingest.read_events(p.spark, p.folder, "orders.parquet").select(F.col("o_custkey").alias("ticker"), F.last_day("o_orderdate").alias("date"))
    spells = ingest.recorded_spells(rows, p.spark.read.parquet(f"{work}/dates"))
    spells.writeStream.format("parquet").option("path", f"{work}/spells").option("checkpointLocation", f"{work}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return p.spark.read.schema(spells.schema).parquet(f"{work}/spells")
