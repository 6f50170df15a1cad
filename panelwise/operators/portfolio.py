"""Expected returns, premia and portfolio statistics."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .panel import backward_asof


def capped(df: DataFrame, column: str, cap: float) -> DataFrame:
    return df.withColumn(f"{column}_capped", F.greatest(F.lit(-cap), F.least(F.lit(cap), F.col(column))))


def premia(factors: DataFrame, history: dict[str, float], weight: float) -> DataFrame:
    """signal, premium: weight on the historical monthly premium, the rest on the sample mean. 1 is history only."""
    means = factors.groupBy("signal").agg(F.avg("factor").alias("sample"))
    past = F.coalesce(*(F.when(F.col("signal") == k, F.lit(v)) for k, v in history.items()), F.lit(0.0))
    return means.withColumn("premium", weight * past + (1 - weight) * F.col("sample"))


def latest(df: DataFrame, by: str = "ticker") -> DataFrame:
    """The row of the last date of each series."""
    rest = [c for c in df.columns if c != by]
    return df.groupBy(by).agg(F.max_by(F.struct(*rest), "date").alias("_r")).select(by, "_r.*")


def expected_returns(betas: DataFrame, rates: DataFrame, premia: DataFrame, caps: tuple[float, float] | None = (3.0, 5.0), constant: bool = False) -> DataFrame:
    """ticker, date, beta_date, both betas as they are and capped, rf, er_monthly, er_annual (compounded) for every date of rates.

    betas has ticker, date, beta_market, beta_score; rates date and rate in
    annual percent; premia one row of market and score, monthly. A date takes the
    last betas at or before it and is left out before a ticker's first, but a
    ticker of one row, and every ticker if `constant` (then by its last row), has
    the same betas at all dates. caps None leaves betas as they are.
    """
    betas = latest(betas) if constant else betas
    one = betas.groupBy("ticker").agg(F.count(F.lit(1)).alias("_n"))
    value = F.struct(
        F.col("date").alias("beta_date"), F.col("beta_market").cast("double").alias("beta_market"),
        F.col("beta_score").cast("double").alias("beta_score")
    )
    since = F.when(F.col("_n") == 1, F.lit("0001-01-01").cast("date")).otherwise(F.col("date"))
    known = betas.join(one, "ticker").select("ticker", since.alias("date"), value.alias("_b"))
    asked = one.select("ticker").crossJoin(rates.select("date", (F.col("rate") / 1200).alias("rf")).crossJoin(F.broadcast(premia.select(F.col("market").alias("_lm"), F.col("score").alias("_le")))))  # one row of premia
    rows = backward_asof(asked, known, "_b").select("ticker", "date", "rf", "_lm", "_le", "_b.*")
    for column, cap in zip(("beta_market", "beta_score"), caps or (None, None), strict=True):
        rows = rows.withColumn(f"{column}_capped", F.col(column)) if cap is None else capped(rows, column, cap)
    rows = rows.withColumn("er_monthly", F.expr("rf + beta_market_capped * _lm + beta_score_capped * _le")).drop("_lm", "_le")
    return rows.withColumn("er_annual", F.pow(1 + F.col("er_monthly"), 12) - 1)


def contributions(er: DataFrame, premia: DataFrame) -> DataFrame:
    """ticker, date, rf_part, market_part, score_part: twelve times the parts of the latest expected return."""
    last = latest(er).crossJoin(F.broadcast(premia.select("market", "score")))  # one row
    return last.select(
        "ticker", "date", (F.col("rf") * 12).alias("rf_part"), F.expr("beta_market_capped * market * 12").alias("market_part"),
        F.expr("beta_score_capped * score * 12").alias("score_part")
    )


def ewma(returns: DataFrame, center: int = 36, least: int | None = None) -> DataFrame:
    """Exponentially weighted mean at each ticker's last date, span 2 * center - 1."""
    a = 2 / (2 * center)
    aged = returns.withColumn("age", F.expr("row_number() over (partition by ticker order by date desc) - 1"))
    out = aged.groupBy("ticker").agg(
        (F.sum(F.col("ret") * F.pow(F.lit(1 - a), F.col("age"))) / F.sum(F.pow(F.lit(1 - a), F.col("age")))).alias("ewma"),
        F.count(F.lit(1)).alias("n")
    )
    return out.where(F.col("n") >= (center if least is None else least)).withColumn("ewma", F.col("ewma") * 12)


def last_rows(df: DataFrame, k: int) -> DataFrame:
    return df.withColumn("_n", F.expr("row_number() over (partition by ticker order by date desc)")).where(F.col("_n") <= k).drop("_n")


def historical_mean(returns: DataFrame, lookback: int = 60) -> DataFrame:
    return last_rows(returns, lookback).groupBy("ticker").agg((F.avg("ret") * 12).alias("mean"))


def to_grand_mean(means: DataFrame, strength: float = 0.3) -> DataFrame:
    return means.crossJoin(means.agg(F.avg("mean").alias("_g"))).withColumn("bayes", (1 - strength) * F.col("mean") + strength * F.col("_g")).drop("_g")


def _rolling_ewma(returns: DataFrame, window: int, keep: float) -> DataFrame:
    """Weighted means of full windows by differences of scaled running sums.

    A series is cut into blocks of `window` rows and its sums start anew in each,
    weighted by keep to the power of minus the place, so that weights stay within
    keep ** -window. A window is the end of one block and the start of the next:
    a row costs the same whatever the window is.
    """
    by = "partition by ticker order by date"
    rows = returns.where("ret is not null").select("ticker", "date", "ret").withColumn("_at", F.expr(f"row_number() over ({by}) - 1"))
    rows = rows.withColumns({"_block": F.expr(f"_at div {window}"), "_place": F.expr(f"_at % {window}")}).withColumn("_x", F.expr(f"ret * pow({keep!r}D, -_place)"))
    rows = rows.withColumns({
        "_sum": F.expr("sum(_x) over (partition by ticker, _block order by date rows unbounded preceding)"), "_whole": F.expr("sum(_x) over (partition by ticker, _block)")
    })
    before = f"coalesce(lag(_whole, {window}) over ({by}) - lag(_sum, {window}) over ({by}), 0)"
    weights = (1 - keep**window) / (1 - keep)
    rows = rows.withColumn("estimate", F.expr(f"pow({keep!r}D, _place) * (_sum + {keep**window!r}D * {before}) / {weights!r}D * 12"))
    return rows.where(F.col("_at") >= window - 1).select("ticker", "date", "estimate")


def rolling_mean_returns(returns: DataFrame, window: int = 60, method: str = "historical") -> DataFrame:
    """ticker, date, estimate (annual) of each full window: the plain mean, or the exponentially weighted one of span window // 2."""
    over = f"over (partition by ticker order by date rows between {window - 1} preceding and current row)"
    if method == "historical":
        estimate = f"avg(ret) {over}"
    elif method == "ewma":
        return _rolling_ewma(returns, window, 1 - 2 / (window // 2 + 1))
    else:
        raise ValueError(f"neither historical nor ewma: {method}")
    rows = returns.where("ret is not null").withColumn("_n", F.expr(f"count(1) {over}")).withColumn("estimate", F.expr(f"{estimate}") * 12)
    return rows.where(F.col("_n") == window).select("ticker", "date", "estimate")


def _mixed(h: np.ndarray) -> np.ndarray:
    """31-bit integers mixed by shifts and products, in arithmetic that SQL can repeat."""
    for _ in range(2):
        h = ((h ^ (h >> 16)) * 73244475) % (1 << 31)
    return h


def draws(ticker: int, resamples: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The rows, of n, that each resample (a column of numbers) draws."""
    key = _mixed((resamples * 7919 + ticker * 104729 + seed) % (1 << 31))
    return _mixed(key ^ (np.arange(n, dtype=np.int64) * 1103515245 % (1 << 31))) % n


def bootstrap(returns: DataFrame, resamples: int = 1000, confidence: float = 0.95, lookback: int | None = None, seed: int = 5) -> DataFrame:
    """ticker, mean, std_error, low, high (annual) over resamples of each ticker's rows; draws are a seeded hash, so reruns agree.

    The draw of a row is a mix of its own place and of a key mixed from ticker
    and resample, so resamples share no draws, however long a history is. A
    ticker's history, or its last `lookback` rows, is one group and is drawn from
    where it lies; null returns are left out.
    """
    rows = (returns if lookback is None else last_rows(returns, lookback)).where("ret is not null")
    kind = dict(rows.dtypes)["ticker"]
    number = F.col("ticker").cast("long") if kind in ("int", "bigint", "smallint", "tinyint") else F.pmod(F.xxhash64("ticker"), F.lit(1 << 31))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        rets = pdf.sort_values("date")["ret"].to_numpy(float)
        n, own, means = len(rets), int(pdf["_h"].iloc[0]), []
        step = max(1, (1 << 22) // n)
        for first in range(0, resamples, step):
            b = np.arange(first, min(first + step, resamples), dtype=np.int64)[:, None]
            means.append(rets[draws(own, b, n, seed)].mean(axis=1) * 12)
        m, tail = np.concatenate(means), (1 - confidence) / 2
        low, high = np.quantile(m, [tail, 1 - tail])
        return pd.DataFrame({"ticker": pdf["ticker"].iloc[:1], "mean": m.mean(), "std_error": m.std(ddof=1), "low": low, "high": high})

    dealt = rows.select("ticker", "date", "ret", number.alias("_h")).repartition(returns.sparkSession.sparkContext.defaultParallelism, "ticker")  # small rows, much work
    return dealt.groupBy("ticker").applyInPandas(one, f"ticker {kind}, mean double, std_error double, low double, high double")


def out_of_sample(estimates: DataFrame, test: DataFrame) -> DataFrame:
    """method, n, mse, mae, rmse of annual estimates (method, ticker, value) against the realised means of test rows."""
    err = estimates.join(test.groupBy("ticker").agg((F.avg("ret") * 12).alias("real")), "ticker").withColumn("e", F.col("value") - F.col("real"))
    return err.groupBy("method").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("e") * F.col("e")).alias("mse"), F.avg(F.abs("e")).alias("mae"),
        F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse")
    )


def common_names(*tables: DataFrame) -> DataFrame:
    """Tickers that all tables have."""
    first, *rest = (t.select("ticker").distinct() for t in tables)
    for other in rest:
        first = first.join(other, "ticker", "left_semi")
    return first


def check_units(df: DataFrame, column: str, most: float = 1.0) -> DataFrame:
    """df; reading it raises where a monthly value lies outside [-most, most]."""
    ok = F.col(column).isNull() | F.col(column).between(-most, most)
    return df.withColumn(
        column,
        F.when(ok, F.col(column)).otherwise(F.raise_error(F.concat(F.lit(f"{column} is not a monthly decimal: "), F.col(column).cast("string"))).cast("double"))
    )


def evaluate(weights: DataFrame, returns: DataFrame, rf: float, exposures: DataFrame | None = None, benchmark: DataFrame | None = None) -> DataFrame:
    """portfolio, exp_return, variance, sharpe, exposure, tracking_error, active_return (monthly) of all portfolios at once.

    weights (portfolio, ticker, weight) meet returns (ticker, date, ret) once:
    w'Sw is the variance of the portfolio's own return, over the dates on which
    all its names have one. exposures has ticker, exposure, 0 where absent;
    benchmark ticker, weight, of which a portfolio's own names count.
    """
    spark = weights.sparkSession
    exposures = spark.createDataFrame([], "ticker long, exposure double") if exposures is None else exposures
    bench = spark.createDataFrame([], "ticker long, weight double") if benchmark is None else benchmark
    own = weights.join(exposures, "ticker", "left").join(bench.select("ticker", F.col("weight").alias("b")), "ticker", "left").na.fill(0.0, ["exposure", "b"])
    own = own.withColumn("names", F.expr("count(1) over (partition by portfolio)")).join(returns.groupBy("ticker").agg(F.avg("ret").alias("mu")), "ticker")
    of_names = own.groupBy("portfolio").agg(
        F.expr("sum(weight * mu)").alias("exp_return"), F.expr("sum(weight * exposure)").alias("exposure"),
        F.expr("sum((weight - b) * mu)").alias("active_return")
    )
    by_date = own.join(returns.select("ticker", "date", "ret"), "ticker").groupBy("portfolio", "date").agg(
        F.count("ret").alias("n"), F.first("names").alias("names"), F.expr("sum(weight * ret)").alias("r"),
        F.expr("sum((weight - b) * ret)").alias("d")
    )
    risk = by_date.where("n = names").groupBy("portfolio").agg(F.var_samp("r").alias("variance"), F.stddev_samp("d").alias("tracking_error"))
    out = of_names.join(risk, "portfolio").withColumn("sharpe", F.expr(f"(exp_return - {rf!r}D) / nullif(sqrt(variance), 0)"))
    return out.select("portfolio", "exp_return", "variance", "sharpe", "exposure", "tracking_error", "active_return")


def constraints(
    weights: DataFrame, sectors: DataFrame, name_cap: float, sector_cap: float, exposures: DataFrame | None = None,
    band: tuple[float, float] | None = None
) -> DataFrame:
    """Per portfolio: sum of weights, negative weights, names and sectors above their caps, active names, exposure outside its band, and whether all hold.

    exposures has ticker, exposure, 0 where absent; without a band it is not looked at.
    """
    by_sector = weights.join(sectors, "ticker", "left").groupBy("portfolio", "sector").agg(F.sum("weight").alias("w"))
    over = by_sector.groupBy("portfolio").agg(F.count_if(F.col("w") > sector_cap + 1e-9).alias("sectors_over"))
    exposed = weights.withColumn("exposure", F.lit(0.0)) if exposures is None else weights.join(exposures, "ticker", "left")
    low, high = band or (float("-inf"), float("inf"))
    total = F.coalesce(F.sum(F.col("weight") * F.col("exposure")), F.lit(0.0))
    own = exposed.groupBy("portfolio").agg(
        F.sum("weight").alias("total"), F.count_if(F.col("weight") < -1e-9).alias("negative"), F.count_if(F.col("weight") > name_cap + 1e-9).alias("names_over"),
        F.count_if(F.abs("weight") > 1e-6).alias("active"), (~total.between(low - 1e-9, high + 1e-9)).alias("outside_band"),
    )
    return own.join(over, "portfolio").withColumn(
        "feasible", F.expr("abs(total - 1) < 1e-6 and negative = 0 and names_over = 0 and sectors_over = 0 and not outside_band")
    )


def turnover(weights: DataFrame, previous: DataFrame) -> DataFrame:
    """portfolio, turnover: the sum of |w - previous| over all names of either; previous has ticker, weight."""
    before = previous.select("ticker", F.col("weight").alias("p"))
    all_before = before.agg(F.coalesce(F.sum(F.abs("p")), F.lit(0.0)).alias("all"))  # one row
    moved = weights.join(before, "ticker", "left").groupBy("portfolio").agg(F.expr("sum(abs(weight - coalesce(p, 0)) - abs(coalesce(p, 0)))").alias("moved"))
    return moved.crossJoin(all_before).select("portfolio", F.expr("moved + all").alias("turnover"))


def frontier(stats: DataFrame, feasible: DataFrame, gammas: list[float], costs: DataFrame | None = None, cost: float = 0.0) -> DataFrame:
    """The feasible portfolio of largest mean - gamma / 2 * variance - cost * turnover, for each gamma; costs has portfolio, turnover."""
    grid = stats.join(feasible.where("feasible").select("portfolio"), "portfolio").crossJoin(F.broadcast(stats.sparkSession.createDataFrame([(g,) for g in gammas], "gamma double")))
    grid = grid.withColumn("turnover", F.lit(0.0)) if costs is None else grid.join(costs, "portfolio")
    scored = grid.withColumn("utility", F.expr(f"exp_return - gamma / 2 * variance - {cost!r}D * turnover"))
    return scored.groupBy("gamma").agg(F.max_by("portfolio", F.struct("utility", "portfolio")).alias("portfolio"), F.max("utility").alias("utility"))


def two_asset_grid(df: DataFrame, ret: str = "ret", market: str = "mkt", rf: str = "rf", points: int = 1000) -> DataFrame:
    """Per ticker: of `points` weights from 0 to 1 on it, the rest on the market, the one of best Sharpe ratio, and what diversification gains.

    benefit is the weighted mean of both deviations less the mix's own, at that weight.
    """
    stats = df.groupBy("ticker").agg(
        F.avg(ret).alias("m"), F.avg(market).alias("mm"), F.avg(rf).alias("f"), F.var_samp(ret).alias("v"), F.var_samp(market).alias("vm"),
        F.covar_samp(ret, market).alias("c")
    )
    risk = "sqrt(w * w * v + (1 - w) * (1 - w) * vm + 2 * w * (1 - w) * c)"
    grid = stats.withColumn("w", F.explode(F.expr(f"transform(sequence(0, {points - 1}), x -> x / {float(points - 1)!r}D)"))).withColumn("risk", F.expr(risk))
    grid = grid.withColumn(
        "sh", F.expr("(w * m + (1 - w) * mm - f) / nullif(risk, 0)")
    ).withColumn("benefit", F.expr("w * sqrt(v) + (1 - w) * sqrt(vm) - risk"))
    return grid.groupBy("ticker").agg(
        F.max_by(F.struct("w", "benefit"), F.struct("sh", "w")).alias("best"), F.max("sh").alias("sharpe")
    ).select("ticker", F.col("best.w").alias("weight"), "sharpe", "best.benefit")


def concentration(weights: DataFrame) -> DataFrame:
    ranked = weights.withColumn("_n", F.expr("row_number() over (partition by portfolio order by weight desc, ticker)"))
    return ranked.groupBy("portfolio").agg(*(F.sum(F.when(F.col("_n") <= k, F.col("weight"))).alias(f"top_{k}") for k in (5, 10, 20)))


def performance(df: DataFrame, ret: str = "ret", market: str = "mkt", rf: str = "rf") -> DataFrame:
    """Per ticker: annual return and volatility, Sharpe, Treynor, information and Sortino ratios, systematic and residual risk."""
    by = df.groupBy("ticker").agg(
        F.avg(ret).alias("m"), F.stddev_samp(ret).alias("s"), F.avg(rf).alias("f"), F.expr(f"regr_slope({ret}, {market})").alias("beta"), F.stddev_samp(market).alias("sm"),
        F.expr(f"stddev_samp(if({ret} < {rf}, {ret}, null))").alias("down"), F.expr(f"avg({ret} - {market})").alias("active"), F.expr(f"stddev_samp({ret} - {market})").alias("te"),
    )
    return by.select(
        "ticker", F.expr("power(1 + m, 12) - 1").alias("ann_return"), F.expr("s * sqrt(12)").alias("ann_vol"), F.expr("(m - f) / nullif(s, 0) * sqrt(12)").alias("sharpe"), F.expr("(m - f) * 12 / nullif(beta, 0)").alias("treynor"),
        F.expr("active / nullif(te, 0) * sqrt(12)").alias("information"), F.expr("(m - f) / nullif(down, 0) * sqrt(12)").alias("sortino"), F.expr("abs(beta) * sm * sqrt(12)").alias("systematic"), F.expr("sqrt(greatest(s * s - beta * beta * sm * sm, 0)) * sqrt(12)").alias("residual"),
    )


def best_in_bounds(stats: DataFrame, scenarios: list[tuple[str, float | None, float | None]], gamma: float) -> DataFrame:
    """scenario, portfolio, utility, candidates: the best of the portfolios whose exposure lies in each scenario's bounds; None is open."""
    bounds = stats.sparkSession.createDataFrame(scenarios, "scenario string, low double, high double")
    rows = stats.crossJoin(F.broadcast(bounds)).where("exposure >= coalesce(low, exposure) and exposure <= coalesce(high, exposure)")
    rows = rows.withColumn("utility", F.col("exp_return") - gamma / 2 * F.col("variance"))
    return rows.groupBy("scenario").agg(
        F.max_by("portfolio", F.struct("utility", "portfolio")).alias("portfolio"), F.max("utility").alias("utility"),
        F.count(F.lit(1)).alias("candidates")
    )


def expectation_gap(required: DataFrame) -> DataFrame:
    """ticker, required, historical with gap and rating by bands of 5%, 2% and -2%."""
    gap = F.col("required") - F.col("historical")
    rating = F.when(gap > 0.05, "underweight").when(gap > 0.02, "hold").when(gap > -0.02, "market perform").when(gap.isNotNull(), "overweight")
    return required.withColumn("gap", gap).withColumn("rating", rating)


def implied_growth(required: DataFrame, spreads: dict[str, float]) -> DataFrame:
    """Growth that each scenario's spread below the required return implies, one row a ticker and scenario."""
    cases = F.explode(F.array(*(F.struct(F.lit(k).alias("scenario"), F.lit(v).alias("spread")) for k, v in spreads.items()))).alias("c")
    return required.select("ticker", "required", cases).select(
        "ticker", F.col("c.scenario").alias("scenario"), (F.col("required") - F.col("c.spread")).alias("growth")
    )
