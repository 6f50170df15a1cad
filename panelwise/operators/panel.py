"""Operators over (ticker, date) panels: returns, windows, cross-sections, factor portfolios."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.dates import month_end
from ..sources.panels import stored
from .ranks import back, keys_of, percentile_rank, quantile_bucket

OVER = "over (partition by ticker order by date)"
#: Least and most names, and most numbers, of one block of the pairwise covariance; names that meet another block at once.
NAMES, MOST_NAMES, CELLS, SLICE = 64, 1024, 1 << 19, 256


def simple_returns(prices: DataFrame, k: int = 1, price: str = "adj_close", out: str = "ret") -> DataFrame:
    """Change to the k-th row before; the first k rows of a ticker go."""
    df = prices.withColumn(out, F.expr(f"{price} / nullif(lag({price}, {k}) {OVER}, 0) - 1"))
    return df.where(F.col(out).isNotNull())


def excess_returns(returns: DataFrame, rates: DataFrame, periods: int = 12) -> DataFrame:
    """Returns minus the rate of their date as a decimal per period; dates without a rate go. Rates have a row a date, so Spark broadcasts them where they are small."""
    return returns.join(rates, "date").withColumn("excess", F.col("ret") - F.col("rate") / 100 / periods)


def filled_rates(dates: DataFrame, rates: DataFrame) -> DataFrame:
    """The rate of each date, or the last one before."""
    known = dates.join(rates, "date", "left")
    return known.withColumn("rate", F.expr("last_value(rate) ignore nulls over (order by date)"))


def lag_rows(df: DataFrame, columns: list[str], k: int, by: str = "ticker") -> DataFrame:
    """Columns as of k rows before."""
    return df.withColumns({c: F.expr(f"lag({c}, {k}) over (partition by {by} order by date)") for c in columns})


def lag_months(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    """Columns as of k calendar months before, by a self join on the shifted month end."""
    past = df.select("ticker", month_end(F.add_months("date", k)).alias("date"), *columns)
    return df.drop(*columns).join(past, ["ticker", "date"])


def forward_returns(prices: DataFrame, horizons: list[int]) -> DataFrame:
    return prices.withColumns({f"fwd_{h}": F.expr(f"lead(adj_close, {h}) {OVER} / adj_close - 1") for h in horizons})


def horizon_spreads(deciles: DataFrame, forward: DataFrame, horizons: list[int]) -> DataFrame:
    """date, horizon, decile_long (10), decile_short (1), decile_spread, quintile_spread (9 and 10 less 1 and 2): means of fwd_<horizon> by date."""
    rows = deciles.join(forward.select("ticker", "date", *(f"fwd_{h}" for h in horizons)), ["ticker", "date"])
    long = rows.unpivot(["date", "decile"], [f"fwd_{h}" for h in horizons], "name", "ret").withColumn("horizon", F.expr("cast(substring(name, 5) as int)"))
    mean = lambda rule: f"avg(if({rule}, ret, null))"
    out = long.groupBy("date", "horizon").agg(
        F.expr(mean("decile = 10")).alias("decile_long"), F.expr(mean("decile = 1")).alias("decile_short"),
        F.expr(f"{mean('decile > 8')} - {mean('decile <= 2')}").alias("quintile_spread")
    )
    return out.withColumn("decile_spread", F.col("decile_long") - F.col("decile_short"))


def holding_summary(spreads: DataFrame, column: str = "decile_spread") -> DataFrame:
    """horizon, n, mean, std, sharpe times sqrt(12 / horizon), win_rate of the dates that have a spread."""
    by = spreads.where(F.col(column).isNotNull()).groupBy("horizon")
    out = by.agg(
        F.count(F.lit(1)).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
        F.avg((F.col(column) > 0).cast("double")).alias("win_rate")
    )
    return out.withColumn("sharpe", F.expr("mean / nullif(std, 0) * sqrt(12.0D / horizon)"))


def consistent_improvers(scores: DataFrame, column: str, rows: list[int]) -> DataFrame:
    """Rows whose column is above what it was each of so many rows before."""
    marked = scores.withColumns({f"_c{k}": F.expr(f"{column} - lag({column}, {k}) {OVER}") for k in rows})
    return marked.where(" and ".join(f"_c{k} > 0" for k in rows)).drop(*(f"_c{k}" for k in rows))


def formation_scores(scores: DataFrame, pillars: dict[str, float], k: int = 12) -> DataFrame:
    """method, ticker, date, score: the score itself, the weighted pillars and the change ratio over k rows."""
    weighted = " + ".join(f"{w!r}D * {c}" for c, w in pillars.items())
    wide = scores.withColumns({
        "esg_score": F.col("ESG"), "pillar_weighted": F.expr(weighted), "momentum": F.expr(f"ESG / nullif(lag(ESG, {k}) {OVER}, 0) - 1")
    })
    return wide.unpivot(["ticker", "date"], ["esg_score", "pillar_weighted", "momentum"], "method", "score").where("score is not null")


def quality_momentum(scores: DataFrame, column: str = "ESG", k: int = 12) -> DataFrame:
    """method, ticker, date, score: half the sample z-score plus a twentieth of the change over k rows, 0 where there is none."""
    df = zscore(scores, column, sample=True).withColumn("mom", F.expr(f"{column} - lag({column}, {k}) {OVER}"))
    return df.select(F.lit("quality_momentum").alias("method"), "ticker", "date", F.expr("(z + coalesce(mom, 0) / 10) / 2").alias("score"))


def formation_ranks(scored: DataFrame) -> DataFrame:
    """Rows of method, ticker, date, score with sample z, percentile rank of 100 and decile within method and date."""
    by = "method, date"
    ranked = quantile_bucket(percentile_rank(zscore(scored, "score", by, sample=True), "score", by), "score", 10, by, "decile")
    return ranked.withColumn("pctrank", F.col("pct") * 100).drop("pct")


def compounded(factor: str, over: str = "") -> str:
    """SQL of the product of a factor over a group or window: logarithms of sizes, the count of negative ones and whether one is 0."""
    sign = f"if(count_if({factor} < 0) {over} % 2 = 1, -1, 1)"
    return f"if(count_if({factor} = 0) {over} > 0, 0.0D, {sign} * exp(coalesce(sum(ln(nullif(abs({factor}), 0))) {over}, 0.0D)))"


def drawdowns(returns: DataFrame) -> DataFrame:
    """Cumulative return, running maximum of wealth and drawdown of each row; a return of -1 loses all for good, and a drawdown from a peak of 0 is null."""
    grown = returns.withColumn("wealth", F.expr(compounded("(1 + ret)", OVER)))
    grown = grown.withColumn("peak", F.expr(f"max(wealth) {OVER}"))
    return grown.withColumn("cumulative", F.col("wealth") - 1).withColumn("drawdown", F.expr("wealth / nullif(peak, 0) - 1"))


def rolling_stats(returns: DataFrame, window: int = 12) -> DataFrame:
    """Rolling mean, standard deviation and annualised ratio; null until the window is full."""
    frame = f"over (partition by ticker order by date rows between {window - 1} preceding and current row)"
    full = f"count(ret) {frame} = {window}"
    df = returns.withColumn("roll_mean", F.expr(f"if({full}, avg(ret) {frame}, null)")).withColumn(
        "roll_std", F.expr(f"if({full}, stddev_samp(ret) {frame}, null)")
    )
    return df.withColumn("roll_sharpe", F.expr("roll_mean / nullif(roll_std, 0) * sqrt(12)")).withColumn("roll_vol", F.expr("roll_std * sqrt(12)"))


def zscore(df: DataFrame, column: str, by: str = "date", out: str = "z", sample: bool = False) -> DataFrame:
    """Population form divides by 1 where the deviation is 0; the sample form is 0 there."""
    keys = keys_of(by)
    stats = df.groupBy(*keys).agg(F.avg(column).alias("_mean"), F.expr(f"stddev_{'samp' if sample else 'pop'}({column})").alias("_dev"))
    formula = f"if(coalesce(_dev, 0) > 0, ({column} - _mean) / nullif(_dev, 0), 0.0D)" if sample else f"({column} - _mean) / coalesce(nullif(_dev, 0), 1)"
    return back(df, stats, keys).withColumn(out, F.expr(formula)).drop("_mean", "_dev")


def size_weights(prices: DataFrame) -> DataFrame:
    """price * volume over its date's sum; equal weights where the sum is 0."""
    df = prices.withColumn("_v", F.expr("greatest(coalesce(nullif(adj_close * adj_volume, 0), 0), 0)"))
    sums = df.groupBy("date").agg(F.sum("_v").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    return back(df, sums, ["date"]).withColumn("weight", F.expr("if(_sum > 0, _v / nullif(_sum, 0), 1.0D / _n)")).drop("_v", "_sum", "_n")


def long_signals(scores: DataFrame, columns: list[str]) -> DataFrame:
    """ticker, date, signal, value from a column a signal."""
    return scores.unpivot(["ticker", "date"], columns, "signal", "value")


def momentum_signal(scores: DataFrame, column: str = "ESG", k: int = 12) -> DataFrame:
    """Change over k rows as a population z-score within its date."""
    moved = scores.withColumn("change", F.expr(f"{column} - lag({column}, {k}) {OVER}")).where("change is not null")
    return zscore(moved, "change").select("ticker", "date", F.lit("ESG_mom").alias("signal"), F.col("z").alias("value"))


def long_short(
    excess: DataFrame, signals: DataFrame, lag: int = 1, quantile: float = 0.2, weights: DataFrame | None = None,
    sectors: DataFrame | None = None
) -> DataFrame:
    """signal, date, long_leg, short_leg, factor: means of the top and bottom quantile of the lagged signal, ranked within date (and sector).

    All signals and dates are one plan: lags are dealt by ticker, ranks by
    (signal, date). Null weights count 0; a leg without weight falls back to the
    plain mean; dates that lack a leg go.
    """
    lagged = signals.withColumn("value", F.expr(f"lag(value, {lag}) over (partition by signal, ticker order by date)")).where("value is not null")
    if weights is None:
        lagged = lagged.withColumn("weight", F.lit(1.0))
    else:
        past = weights.select("ticker", "date", F.expr(f"lag(weight, {lag}) {OVER}").alias("weight"))
        lagged = lagged.join(past, ["ticker", "date"], "left")
    rows = excess.select("ticker", "date", "excess").join(lagged, ["ticker", "date"])
    by = "signal, date"
    if sectors is not None:
        rows, by = rows.join(sectors, "ticker", "left"), "signal, date, sector"
    ranked = percentile_rank(rows, "value", by)
    leg = F.expr(f"case when pct >= {1 - quantile} then 'long' when pct <= {quantile} then 'short' end")
    mean = lambda side: F.expr(f"coalesce(sum(if(leg = '{side}', coalesce(weight, 0) * excess, null)) / nullif(sum(if(leg = '{side}', coalesce(weight, 0), null)), 0), avg(if(leg = '{side}', excess, null)))")
    out = ranked.withColumn("leg", leg).where("leg is not null").groupBy("signal", "date").agg(mean("long").alias("long_leg"), mean("short").alias("short_leg"))
    return out.where("long_leg is not null and short_leg is not null").withColumn("factor", F.col("long_leg") - F.col("short_leg"))


def five_factors(excess: DataFrame, scores: DataFrame, annual_lag: int = 12, lag: int = 1) -> DataFrame:
    """The long-short factors of ESG, E, S, G and ESG momentum, scores lagged annual_lag rows before the one-row lag."""
    lagged = lag_rows(scores, ["ESG", "E", "S", "G"], annual_lag).where("ESG is not null")
    return long_short(excess, long_signals(lagged, ["ESG", "E", "S", "G"]).unionByName(momentum_signal(lagged)), lag)


def wide_factors(factors: DataFrame, names: list[str]) -> DataFrame:
    """A column a factor, dates with all of them only."""
    wide = factors.groupBy("date").agg(*(F.max(F.when(F.col("signal") == n, F.col("factor"))).alias(f"{n}_factor") for n in names))
    return wide.na.drop()


def factor_summary(factors: DataFrame) -> DataFrame:
    out = factors.groupBy("signal").agg(
        (F.avg("factor") * 12).alias("ann_mean"), (F.stddev_samp("factor") * F.sqrt(F.lit(12))).alias("ann_std"),
        F.min("factor").alias("low"), F.max("factor").alias("high"), F.count("factor").alias("n")
    )
    return out.withColumn("sharpe", F.expr("ann_mean / nullif(ann_std, 0)"))


def correlations(factors: DataFrame) -> DataFrame:
    """Pairwise correlation in long form; the series are few, dates are the join key."""
    a, b = factors.select(
        "date", F.col("signal").alias("a"), F.col("factor").alias("x")
    ), factors.select("date", F.col("signal").alias("b"), F.col("factor").alias("y"))
    return a.join(b, "date").groupBy("a", "b").agg(F.corr("x", "y").alias("corr"))


def backward_asof(left: DataFrame, right: DataFrame, value: str, keep_unmatched: bool = False) -> DataFrame:
    """left (ticker, date, ...) with the latest right value (ticker, date, value) at or before its date.

    Both sides are united and scanned once in date order within the ticker, so
    the cost is one shuffle by key, whatever the dates are.
    """
    cols = [c for c in left.columns if c not in ("ticker", "date")]
    tagged = left.withColumn("_side", F.lit(1)).withColumn("_v", F.lit(None).cast(dict(right.dtypes)[value]))
    other = right.select("ticker", "date", F.lit(0).alias("_side"), F.col(value).alias("_v"))
    both = tagged.unionByName(other, allowMissingColumns=True)
    both = both.withColumn(
        value,
        F.expr("last_value(_v) ignore nulls over (partition by ticker order by date, _side rows between unbounded preceding and current row)")
    )
    out = both.where("_side = 1").select("ticker", "date", *cols, value)
    return out if keep_unmatched else out.where(F.col(value).isNotNull())


def complete_dates(panel: DataFrame) -> DataFrame:
    """Rows of the dates on which every ticker of the panel has one."""
    names = panel.agg(F.count_distinct("ticker").alias("_names"))  # one row
    full = panel.groupBy("date").agg(F.count_distinct("ticker").alias("_n")).crossJoin(names).where("_n = _names").select("date")
    return panel.join(full, "date", "left_semi")


def _packed(kind: pa.DataType):
    """Rows (block, ticker, place, x) of a block to one row: its names, its places in order and the matrix of x, missing ones NaN."""

    def run(table: pa.Table) -> pa.Table:
        names, i = np.unique(table.column("ticker").to_numpy(), return_inverse=True)
        places, j = np.unique(table.column("place").to_numpy(), return_inverse=True)
        x = np.full((len(names), len(places)), np.nan)
        x[i, j] = table.column("x").to_numpy()
        if np.count_nonzero(~np.isnan(x)) < table.num_rows:
            raise ValueError("more than one row of a ticker and date")
        lists = [pa.array([v.tolist()], pa.list_(k)) for v, k in ((names, kind), (places, pa.int32()))]
        return pa.table({"block": table.column("block")[:1], "names": lists[0], "places": lists[1], "x": pa.array([x.tobytes()], pa.binary())})

    return run


def _block_covariances(names: tuple, places: tuple, x: tuple, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, cov, n) of the pairs of two blocks' names with a common date, i <= j, SLICE names of the first at a time."""
    _, own, other = np.intersect1d(*places, assume_unique=True, return_indices=True)

    def centred(m: np.ndarray, of: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:  # so that nothing cancels
        m = m.reshape(len(names[of]), -1)
        m = (m - np.nanmean(m, axis=1, keepdims=True))[:, at]
        here = ~np.isnan(m)
        return np.where(here, m, 0.0), here.astype(float)

    (a, at_a), (b, at_b) = centred(x[0], 0, own), centred(x[1], 1, other)
    for first in range(0, len(a), SLICE):
        part, here = a[first : first + SLICE], at_a[first : first + SLICE]
        n = here @ at_b.T
        with np.errstate(divide="ignore", invalid="ignore"):
            cov = np.where(n > 1, (part @ b.T - (part @ at_b.T) * (here @ b.T) / n) / (n - 1), np.nan)
        i, j = np.nonzero(np.triu(n > 0, first) if same else n > 0)
        left, right = names[0][first + i], names[1][j]
        swap = left > right
        yield np.where(swap, right, left), np.where(swap, left, right), cov[i, j], n[i, j].astype(np.int64)


def _covariances(kind: pa.DataType):
    """Pairs of packed blocks to rows of ticker_i, ticker_j, cov, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                at = lambda c, row=row: batch.column(c)[row]  # noqa: B023, E731
                names, places = (tuple(at(f"{c}{s}").values.to_numpy(zero_copy_only=False) for s in "ab") for c in ("names", "places"))
                x = tuple(np.frombuffer(at(f"x{s}").as_buffer(), float) for s in "ab")
                for i, j, cov, n in _block_covariances(names, places, x, at("blocka") == at("blockb")):
                    yield pa.RecordBatch.from_arrays([pa.array(i, kind), pa.array(j, kind), pa.array(cov, mask=np.isnan(cov)), pa.array(n)], ["ticker_i", "ticker_j", "cov", "n"])

    return run


def pairwise_covariance(panel: DataFrame, value: str = "ret") -> DataFrame:
    """ticker_i, ticker_j, cov, n for i <= j over their common dates; pairs without a common date are left out. A ticker has one row a date.

    Tickers are dealt to blocks, and a block is one row of a stored table: a
    matrix of at most CELLS numbers. All pairs of blocks are joined from that
    table without a shuffle, and each is two matrix products in one task, so what
    is shuffled and stored grows with the panel; only reads and results grow with
    the pairs.
    """
    rows = stored(panel.select("ticker", "date", F.col(value).cast("double").alias("x")).where("ticker is not null and date is not null and x is not null and not isnan(x)"))
    numbers = rows.select("date").distinct().withColumn("place", F.expr("int(row_number() over (order by date))"))
    names, dates = (rows.select(c).distinct().count() for c in ("ticker", "date"))
    each = max(min(int(np.clip(-(-names // 16), NAMES, MOST_NAMES)), CELLS // max(dates, 1)), 1)
    blocks = -(-names // each) or 1
    kind = dict(rows.dtypes)["ticker"]
    arrow = pa.string() if kind == "string" else to_arrow_type(rows.schema["ticker"].dataType)
    dealt = rows.join(numbers, "date").select(F.pmod(F.xxhash64("ticker"), F.lit(blocks)).cast("int").alias("block"), "ticker", "place", "x")
    packed = dealt.groupBy("block").applyInArrow(_packed(arrow), f"block int, names array<{kind}>, places array<int>, x binary")
    packed = stored(packed.repartition(min(blocks, 64), "block"))
    a, b = (packed.select(*(F.col(c).alias(f"{c}{s}") for c in packed.columns)) for s in "ab")
    return a.join(b, F.col("blocka") <= F.col("blockb")).mapInArrow(_covariances(arrow), f"ticker_i {kind}, ticker_j {kind}, cov double, n long")


def shrunk(cov: DataFrame, share: float = 0.25) -> DataFrame:
    """Off-diagonal covariances times 1 - share."""
    return cov.withColumn("cov", F.when(F.col("ticker_i") == F.col("ticker_j"), F.col("cov")).otherwise(F.col("cov") * (1 - share)))
