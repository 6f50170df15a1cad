"""Registered queries with their SQL, and the panels they start from."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import panel as op
from ..operators import reference as ref
from ..sources import panels as src

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

PRELUDE = """WITH px AS (SELECT l_suppkey AS ticker, last_day(CAST(l_shipdate AS DATE)) AS date, sum(l_extendedprice) / sum(l_quantity) AS adj_close,
sum(l_quantity) AS adj_volume FROM lineitem GROUP BY 1, 2),
mk AS (SELECT last_day(CAST(l_shipdate AS DATE)) AS date, sum(l_extendedprice) / sum(l_quantity) AS adj_close FROM lineitem GROUP BY 1),
rf AS (SELECT last_day(CAST(l_shipdate AS DATE)) AS date, 100 * avg(l_tax) AS rate FROM lineitem GROUP BY 1),
sc0 AS (SELECT l_suppkey AS ticker, last_day(CAST(l_shipdate AS DATE)) AS date, 1000 * avg(l_discount) AS E,
100 * avg(CASE WHEN l_returnflag = 'N' THEN 1.0 ELSE 0.0 END) AS S, 100 * avg(CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END) AS G
FROM lineitem GROUP BY 1, 2),
sc AS (SELECT *, (E + S + G) / 3 AS ESG FROM sc0),
sect AS (SELECT s_suppkey AS ticker, r_name AS sector FROM supplier JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey),
ret AS (SELECT * FROM (SELECT ticker, date, adj_close, adj_volume, adj_close / nullif(lag(adj_close) OVER (PARTITION BY ticker
ORDER BY date), 0) - 1 AS ret FROM px) WHERE ret IS NOT NULL),
mret AS (SELECT * FROM (SELECT date, adj_close / nullif(lag(adj_close) OVER (ORDER BY date), 0) - 1 AS ret FROM mk) WHERE ret IS NOT NULL),
exc AS (SELECT r.ticker, r.date, r.ret, m.ret AS mkt, f.rate / 1200 AS rf, r.ret - f.rate / 100 / 12 AS excess,
m.ret - f.rate / 100 / 12 AS mkt_excess FROM ret r JOIN mret m ON r.date = m.date JOIN rf f ON r.date = f.date),
md AS (SELECT DISTINCT o_custkey AS ticker, last_day(CAST(o_orderdate AS DATE)) AS date FROM orders),
mdn AS (SELECT date, row_number() OVER (ORDER BY date) AS d FROM (SELECT DISTINCT date FROM md)),
iv AS (SELECT ticker, min(date) AS start_date, max(date) AS end_date FROM (SELECT ticker, date, d - row_number() OVER (PARTITION BY ticker
ORDER BY date) AS g FROM md JOIN mdn USING (date)) GROUP BY ticker, g)
"""


class Panels:
    """The derived panels of one folder.

    prices, market, rates, scores and returns are lazy scans of the fact table, which
    filters and columns reach. Those of `joint` are ratios of one stored table of
    sums, for queries that need several panels; excess and factors are stored
    themselves, as later steps read them more than once.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return src.table(self.spark, self.folder, name)

    prices = cached_property(lambda s: src.prices(s.table("lineitem")))
    market = cached_property(lambda s: src.market(s.table("lineitem")))
    rates = cached_property(lambda s: src.rates(s.table("lineitem")))
    scores = cached_property(lambda s: src.scores(s.table("lineitem")))
    sectors = cached_property(lambda s: src.sectors(s.table("supplier"), s.table("nation"), s.table("region")))
    returns = cached_property(lambda s: op.simple_returns(s.prices))
    daily = cached_property(lambda s: src.membership_daily(s.table("orders")))
    spans = cached_property(lambda s: ref.intervals(s.daily))

    @cached_property
    def joint(self) -> Panels:
        """These panels, read from one pass over the fact table."""
        sums, out = src.stored(src.panel_sums(self.table("lineitem"))), Panels(self.spark, self.folder)
        for name, made in (("prices", src.prices_of), ("market", src.market_of), ("rates", src.rates_of), ("scores", src.scores_of)):
            out.__dict__[name] = made(sums)
        out.__dict__["joint"] = out
        return out

    @cached_property
    def market_returns(self) -> DataFrame:
        # One row a month, so the unpartitioned window is small.
        return self.market.withColumn("mkt", F.expr("adj_close / nullif(lag(adj_close) over (order by date), 0) - 1")).where("mkt is not null").select("date", "mkt")

    @cached_property
    def excess(self) -> DataFrame:
        """ticker, date, ret, mkt, rf, excess, mkt_excess."""
        own = self.joint
        df = op.excess_returns(own.returns.join(own.market_returns, "date"), own.rates)
        return src.stored(df.withColumn("rf", F.col("rate") / 1200).withColumn("mkt_excess", F.col("mkt") - F.col("rate") / 100 / 12).drop("rate"))

    @cached_property
    def factors(self) -> DataFrame:
        return src.stored(op.five_factors(self.excess, self.joint.scores))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Columns by name; name:k is rounded to k places."""
    return df.select(*(F.round(F.col(c.split(":")[0]), int(c.split(":")[1])).alias(c.split(":")[0]) if ":" in c else F.col(c) for c in columns))


def query(sql: str | None = None, prelude: bool = True):
    """Register a function of Panels under its name."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, folder: f(Panels(spark, folder))
        if sql:
            SQL[f.__name__] = (PRELUDE + sql) if prelude else sql
        return f

    return add
