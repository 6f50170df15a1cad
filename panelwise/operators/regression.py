"""Regressions: closed forms over windows and groups; robust errors in grouped tasks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.dates import stars
from ..functions.pvalues import incomplete_beta, p_value_chi2, p_value_norm
from ..sources.panels import stored
from .ranks import back

#: Rows of whole series that are solved together.
ROWS = 1 << 16


def rolling_sums(df: DataFrame, sums: dict[str, str], window: int, by: str = "ticker") -> DataFrame:
    """df with n rows in the window and the sums of SQL expressions over them, for the last `window` rows of each series.

    Differences of running sums: a row costs the same whatever the window is.
    Expressions should be centred, as what lies before the window cancels.
    """
    over = f"over (partition by {by} order by date"
    running = df.withColumns({"_at": F.expr(f"row_number() {over})")} | {
        f"_run_{c}": F.expr(f"sum({e}) {over} rows between unbounded preceding and current row)") for c, e in sums.items()
    })
    cut = {c: F.expr(f"_run_{c} - coalesce(lag(_run_{c}, {window}) {over}), 0)") for c in sums}
    return running.withColumns({"n": F.least("_at", F.lit(window)).cast("long")} | cut).drop("_at", *(f"_run_{c}" for c in sums))


def _centred(df: DataFrame, columns: dict[str, str], by: str = "ticker") -> DataFrame:
    """df with each column less its mean over the series, and that mean as m_<name>."""
    df = df.withColumns({f"m_{c}": F.expr(f"avg({e}) over (partition by {by})") for c, e in columns.items()})
    return df.withColumns({c: F.expr(f"{e} - m_{c}") for c, e in columns.items()})


def rolling_ols(df: DataFrame, y: str, x: str, window: int = 60, least: int | None = None) -> DataFrame:
    """ticker, date, beta, alpha (annual), r_squared, errors, t statistics, observations, correlation.

    Windows of fewer than `least` rows, all but full ones if it is None, give no
    row, nor do windows in which x does not vary.
    """
    rows = _centred(df.where(f"{y} is not null and {x} is not null").select("ticker", "date", y, x), {"_y": y, "_x": x})
    rows = rolling_sums(rows, {"_sy": "_y", "_sx": "_x", "_qy": "_y * _y", "_qx": "_x * _x", "_p": "_x * _y"}, window)
    rows = rows.withColumns({"_sxx": F.expr("_qx - _sx * _sx / n"), "_syy": F.expr("greatest(_qy - _sy * _sy / n, 0)"), "_sxy": F.expr("_p - _sx * _sy / n")})
    rows = rows.where(f"n >= {window if least is None else least} and _sxx > 1e-12 * _qx").withColumn("beta", F.expr("_sxy / _sxx"))
    rows = rows.withColumns({
        "_mx": F.expr("m__x + _sx / n"), "_a": F.expr("m__y + _sy / n - beta * (m__x + _sx / n)"),
        "correlation": F.expr("_sxy / nullif(sqrt(_sxx * _syy), 0)")
    })
    rows = rows.withColumn("_s2", F.expr("greatest(_syy - beta * beta * _sxx, 0) / (n - 2)"))
    rows = rows.withColumn("std_error_beta", F.expr("sqrt(_s2 / _sxx)")).withColumn("_sea", F.expr("sqrt(_s2 * (1.0D / n + _mx * _mx / _sxx))"))
    return rows.select(
        "ticker", "date", "beta", (F.col("_a") * 12).alias("alpha"), F.expr("correlation * correlation").alias("r_squared"), "std_error_beta", (F.col("_sea") * 12).alias("std_error_alpha"),
        F.expr("beta / nullif(std_error_beta, 0)").alias("t_stat_beta"), F.expr("_a / nullif(_sea, 0)").alias("t_stat_alpha"), F.col("n").alias("observations"), "correlation",
    )


def beta_stability(betas: DataFrame) -> DataFrame:
    """ticker, variation (deviation over mean), its band, dates of the extremes, trend a row, last 12 against earlier rows, share significant; more than 12 rows."""
    over = "over (partition by ticker order by date{})"
    ix = betas.withColumns({"i": F.expr(f"row_number() {over.format('')}"), "back": F.expr(f"row_number() {over.format(' desc')}")})
    out = ix.groupBy("ticker").agg(
        F.expr("stddev_samp(beta) / nullif(abs(avg(beta)), 0)").alias("variation"), F.min_by("date", "beta").alias("low_date"), F.max_by("date", "beta").alias("high_date"),
        F.expr("regr_slope(beta, i)").alias("trend"), F.expr("avg(if(back <= 12, beta, null)) - avg(if(back > 12, beta, null))").alias("recent_change"),
        F.expr("count_if(abs(t_stat_beta) > 1.96) / count(1)").alias("significant"), F.count(F.lit(1)).alias("n"),
    )
    band = F.when(F.col("variation") < 0.1, "very stable").when(F.col("variation") < 0.2, "stable").when(F.col("variation") < 0.3, "moderate").when(
        F.col("variation").isNotNull(), "unstable"
    )
    return out.where("n > 12").withColumn("band", band)


def static_ols(df: DataFrame, y: str, x: str, least: int = 24) -> DataFrame:
    """ticker, n, beta, alpha, r_squared and the slope's t; all but n are null with fewer than `least` rows."""
    fit = {"beta": f"regr_slope({y}, {x})", "alpha": f"regr_intercept({y}, {x})", "r_squared": f"regr_r2({y}, {x})"}
    by = df.where(f"{y} is not null and {x} is not null").groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), *(F.expr(e).alias(c) for c, e in fit.items()))
    by = by.withColumns({c: F.when(F.col("n") >= least, F.col(c)) for c in fit})
    return by.withColumn("t_stat", F.expr("sign(beta) * sqrt(r_squared * (n - 2) / nullif(1 - r_squared, 0))"))


def change_beta_outcomes(universe: DataFrame, excess: DataFrame, scores: DataFrame, column: str, least: int = 24) -> DataFrame:
    """ticker, outcome, n, beta, t_stat of every name: excess returns on the score's change ratio to the row before.

    outcome is no price, no score, insufficient (fewer than `least` common rows) or success.
    """
    change = scores.withColumn("chg", F.expr(f"{column} / nullif(lag({column}) over (partition by ticker order by date), 0) - 1"))
    fit = static_ols(excess.join(change.where("chg is not null").select("ticker", "date", "chg"), ["ticker", "date"]), "excess", "chg", least)
    has = lambda df, name: df.select("ticker").distinct().withColumn(name, F.lit(True))
    rows = universe.join(has(excess, "priced"), "ticker", "left").join(has(scores, "scored"), "ticker", "left")
    rows = rows.join(fit.select("ticker", "n", "beta", "t_stat"), "ticker", "left").na.fill(0, ["n"])
    outcome = F.when(F.col("priced").isNull(), "no price").when(F.col("scored").isNull(), "no score").when(F.col("n") < least, "insufficient").otherwise("success")
    return rows.select("ticker", outcome.alias("outcome"), "n", "beta", "t_stat")


def beta_shares(outcomes: DataFrame) -> DataFrame:
    """One row: successes, mean beta, shares that are positive and significant at 5%, of the outcomes that succeeded."""
    done = outcomes.where("outcome = 'success'")
    return done.agg(F.count(F.lit(1)).alias("n"), F.avg("beta").alias("mean"), F.expr("avg(if(beta > 0, 1.0D, 0.0D))").alias("positive"), F.expr("avg(if(abs(t_stat) > 1.96, 1.0D, 0.0D))").alias("significant"))


def beta_extremes(fit: DataFrame, k: int = 10) -> DataFrame:
    """list, place, ticker, beta, t_stat: the k largest and smallest betas and the k largest t statistics in size, ties to the smaller ticker. Rows without a beta go."""
    out = None
    known = fit.where("beta is not null")
    for name, order in (("top", F.desc("beta")), ("bottom", F.asc("beta")), ("largest_t", F.desc_nulls_last(F.abs("t_stat")))):
        best = known.orderBy(order, "ticker").limit(k)  # k rows, so that numbering them needs no partition
        own = best.select(F.lit(name).alias("list"), F.row_number().over(Window.orderBy(order, "ticker")).alias("place"), "ticker", "beta", "t_stat")
        out = own if out is None else out.unionByName(own)
    return out


def two_factor(df: DataFrame, y: str, x1: str, x2: str, window: int | None = None, least: int = 24) -> DataFrame:
    """ticker (and date, over a window of rows), n, alpha, beta_1, beta_2, r_squared, adj_r_squared by covariances."""
    df = df.where(f"{y} is not null and {x1} is not null and {x2} is not null")
    if window is None:
        parts = {"my": f"avg({y})", "m1": f"avg({x1})", "m2": f"avg({x2})", "vy": f"var_pop({y})", "v1": f"var_pop({x1})", "v2": f"var_pop({x2})"}
        parts |= {"c12": f"covar_pop({x1}, {x2})", "c1y": f"covar_pop({x1}, {y})", "c2y": f"covar_pop({x2}, {y})"}
        out = df.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), *(F.expr(e).alias(c) for c, e in parts.items()))
    else:
        names = {"y": "_y", "1": "_x1", "2": "_x2"}
        rows = _centred(df.select("ticker", "date", y, x1, x2), dict(zip(names.values(), (y, x1, x2), strict=True)))
        pairs = {f"q{i}{j}": f"{names[i]} * {names[j]}" for i, j in ("yy", "11", "22", "12", "1y", "2y")}
        out = rolling_sums(rows, {f"s{i}": c for i, c in names.items()} | pairs, window)
        out = out.withColumns({
            f"{v}{k}": F.expr(f"q{i}{j} / n - s{i} * s{j} / n / n") for v, k, i,
            j in (("v", "y", "y", "y"), ("v", "1", "1", "1"), ("v", "2", "2", "2"), ("c", "12", "1", "2"), ("c", "1y", "1", "y"), ("c", "2y", "2", "y"))
        })
        out = out.withColumns({f"m{i}": F.expr(f"m_{c} + s{i} / n") for i, c in names.items()})
    out = out.where(f"n >= {least}").withColumn("d", F.expr("nullif(v1 * v2 - c12 * c12, 0)"))
    out = out.withColumn("beta_1", F.expr("(c1y * v2 - c2y * c12) / d")).withColumn("beta_2", F.expr("(c2y * v1 - c1y * c12) / d"))
    out = out.withColumn("alpha", F.expr("my - beta_1 * m1 - beta_2 * m2")).withColumn("r_squared", F.expr("(beta_1 * c1y + beta_2 * c2y) / nullif(vy, 0)"))
    keys = ["ticker"] if window is None else ["ticker", "date"]
    return out.select(
        *keys, F.col("n").cast("long").alias("n"), "alpha", "beta_1", "beta_2", "r_squared",
        F.expr("1 - (1 - r_squared) * (n - 1) / (n - 3)").alias("adj_r_squared")
    )


def ols_windows(y: np.ndarray, x: np.ndarray, lags: int | None = 12) -> dict[str, np.ndarray]:
    """Regressions of many windows at once: y is (windows, rows), x is (windows, rows, factors); the constant comes first.

    coef, error (windows, terms), rest, r_squared, adj_r_squared, f. Errors are
    Newey-West's with Bartlett weights and no small-sample factor, or the plain
    ones if lags is None; f tests all factors by the same covariance.
    """
    w, n = y.shape
    design = np.concatenate([np.ones((w, n, 1)), x], axis=2)
    k = design.shape[2]
    inverse = np.linalg.pinv(np.einsum("wni,wnj->wij", design, design))
    coef = np.einsum("wij,wnj,wn->wi", inverse, design, y, optimize=True)
    rest = y - np.einsum("wni,wi->wn", design, coef)
    squares, total = (rest**2).sum(axis=1), ((y - y.mean(axis=1, keepdims=True)) ** 2).sum(axis=1)
    if lags is None:
        covariance = inverse * (squares / max(n - k, 1))[:, None, None]
    else:
        score = design * rest[:, :, None]
        middle = np.einsum("wni,wnj->wij", score, score)
        for lag in range(1, min(lags, n - 1) + 1):
            shifted = np.einsum("wni,wnj->wij", score[:, lag:], score[:, :-lag])
            middle += (1 - lag / (lags + 1)) * (shifted + shifted.transpose(0, 2, 1))
        covariance = inverse @ middle @ inverse
    slope = coef[:, 1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        r_squared = np.where(total > 0, 1 - squares / total, np.nan)
        f = np.einsum("wi,wij,wj->w", slope, np.linalg.pinv(covariance[:, 1:, 1:]), slope) / (k - 1)
        adjusted = 1 - (1 - r_squared) * (n - 1) / (n - k)
    error = np.sqrt(np.maximum(np.diagonal(covariance, axis1=1, axis2=2), 0))
    return {"coef": coef, "error": error, "rest": rest, "r_squared": r_squared, "adj_r_squared": adjusted, "f": f}


def hac_ols(y: np.ndarray, x: np.ndarray, lags: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(coefficients with the constant first, Newey-West errors, residuals) of one regression."""
    fit = ols_windows(y[None], x[None], lags)
    return fit["coef"][0], fit["error"][0], fit["rest"][0]


_TERMS = "coef double, std_error double, t double, p double, n long, r_squared double, adj_r_squared double, f double, f_p double"


def _terms(fit: dict[str, np.ndarray], n: int, names: list[str], lags: int | None) -> pd.DataFrame:
    """A row a window and term: normal p-values with robust errors, Student's without."""
    windows, k = fit["coef"].shape
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(fit["error"] > 0, fit["coef"] / fit["error"], np.nan).ravel()
    free = max(n - k, 1)
    plain = lags is None
    p = incomplete_beta(
        free / 2, 0.5, free / (free + np.nan_to_num(t) ** 2)
    ) if plain else np.vectorize(math.erfc, otypes=[float])(np.abs(np.nan_to_num(t)) / math.sqrt(2))
    f_p = incomplete_beta(free / 2, (k - 1) / 2, free / (free + (k - 1) * np.maximum(np.nan_to_num(fit["f"]), 0)))
    each = {c: np.repeat(fit[c], k) for c in ("r_squared", "adj_r_squared", "f")} | {"f_p": np.repeat(f_p, k)}
    return pd.DataFrame({
        "term": names * windows, "coef": fit["coef"].ravel(), "std_error": fit["error"].ravel(), "t": t,
        "p": np.where(np.isnan(t), np.nan, p), "n": n
    } | each)


def _whole_series(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Tables of whole tickers, of `least` rows or more but for the last, from rows in the order of their tickers."""
    held, size, enough = [], 0, least
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= enough:
            table = pa.Table.from_batches(held)
            names = table.column("ticker").to_numpy()
            cut = int(np.append(-1, np.flatnonzero(names != names[-1]))[-1]) + 1
            if cut:
                yield table.slice(0, cut)
            held, size = table.slice(cut).to_batches(), table.num_rows - cut
            enough = max(least, 2 * size)
    if size:
        yield pa.Table.from_batches(held)


def regress_hac(df: DataFrame, y: str, factors: list[str], lags: int | None = 12, least: int = 24) -> DataFrame:
    """ticker, term, coef, std_error, t, p, n, r_squared, adj_r_squared, f, f_p, stars of each ticker's regression; lags None: plain errors.

    Rows come in the order of their tickers, and tickers of one length are solved
    together, some ROWS rows at a time; a ticker's history lies in one task. Rows
    with a null are left out, tickers with fewer than `least` rows as well.
    """
    names = ["alpha", *factors]
    rows = df.select("ticker", "date", *(F.col(c).cast("double").alias(c) for c in dict.fromkeys([y, *factors])))
    rows = rows.na.drop()  # takes NaN as well
    kind, own = dict(df.dtypes)["ticker"], to_arrow_type(df.schema["ticker"].dataType)
    columns = [c.split()[0] for c in f"term string, {_TERMS}".split(", ")]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_series(batches, ROWS):
            of = table.column("ticker").to_numpy()
            starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            sizes = np.diff(np.append(starts, len(of)))
            own_y, x = table.column(y).to_numpy(), np.column_stack([table.column(c).to_numpy() for c in factors])
            for n in np.unique(sizes[sizes >= max(least, len(factors) + 2)]).tolist():
                first = starts[sizes == n]
                at = first[:, None] + np.arange(n)
                out = _terms(ols_windows(own_y[at], x[at], lags), n, names, lags)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(of[first], len(names)), own), *(pa.array(out[c]) for c in columns)], ["ticker", *columns])

    ordered = rows.repartition("ticker").sortWithinPartitions("ticker", "date")
    return _no_nan(ordered.mapInArrow(solve, f"ticker {kind}, term string, {_TERMS}")).withColumn("stars", stars(F.col("p")))


def rolling_hac(df: DataFrame, y: str, factors: list[str], window: int = 36, lags: int | None = 12, least: int | None = None) -> DataFrame:
    """ticker, date and the columns of regress_hac for the window of rows that ends at each date; a ticker's windows are solved together."""
    names = ["alpha", *factors]
    least = max(window if least is None else least, len(factors) + 2)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna().sort_values("date").reset_index(drop=True)
        own, x, out = pdf[y].to_numpy(float), pdf[factors].to_numpy(float), []
        for n in range(least, min(window, len(pdf) + 1)):  # windows that are not full yet
            out.append(_terms(ols_windows(own[None, :n], x[None, :n], lags), n, names, lags).assign(date=pdf["date"][n - 1]))
        if len(pdf) >= max(window, least):
            view = np.lib.stride_tricks.sliding_window_view
            fit = ols_windows(view(own, window), view(x, window, axis=0).transpose(0, 2, 1), lags)
            out.append(_terms(fit, window, names, lags).assign(date=np.repeat(pdf["date"].to_numpy()[window - 1 :], len(names))))
        return pd.concat(out).assign(ticker=pdf["ticker"].iloc[0]) if out else pd.DataFrame(columns=["ticker", "date", "term"])

    schema = f"ticker {dict(df.dtypes)['ticker']}, date date, term string, {_TERMS}"
    return _no_nan(df.select("ticker", "date", y, *factors).groupBy("ticker").applyInPandas(_ordered(one, schema), schema)).withColumn("stars", stars(F.col("p")))


def batch_table(fit: DataFrame) -> DataFrame:
    """A row a ticker of regress_hac's rows on (mkt_excess, factor), with stars, and one of null ticker with the mean coefficients; alpha is annual."""
    names = {"alpha": "alpha", "mkt_excess": "beta_market", "factor": "beta_score"}
    scaled = fit.withColumn("coef", F.when(F.col("term") == "alpha", F.col("coef") * 12).otherwise(F.col("coef")))
    pick = lambda column, term: F.max(F.when(F.col("term") == term, F.col(column)))
    wide = scaled.groupBy("ticker").agg(
        *(pick("coef", t).alias(n) for t, n in names.items()), *(pick("stars", t).alias(f"{n}_stars") for t, n in names.items()),
        F.max("r_squared").alias("r_squared"), F.max("n").alias("n")
    )
    wide = stored(wide)  # read twice, solved once
    means = wide.agg(*(F.avg(n).alias(n) for n in names.values()), F.avg("r_squared").alias("r_squared"), F.sum("n").alias("n"))
    return wide.unionByName(means, allowMissingColumns=True)


def _ordered(one, schema: str):
    """one(), its columns in the schema's order; missing ones are null."""
    return lambda pdf: one(pdf).reindex(columns=[c.split()[0] for c in schema.split(", ")])


def _no_nan(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, kind in df.dtypes if kind == "double"})


def hac_mean(df: DataFrame, by: str, value: str, lags: int = 12) -> DataFrame:
    """mean, std_error (Newey-West) and t of each series, by lag products."""
    centred = df.where(f"{value} is not null").withColumn("_u", F.expr(f"{value} - avg({value}) over (partition by {by})"))
    over = f"over (partition by {by} order by date)"
    centred = centred.withColumns({f"_p{k}": F.expr(f"_u * lag(_u, {k}) {over}") for k in range(1, lags + 1)})
    total = F.expr("sum(_u * _u) + " + " + ".join(f"2 * {1 - k / (lags + 1)!r}D * coalesce(sum(_p{k}), 0)" for k in range(1, lags + 1)))
    out = centred.groupBy(by).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"), total.alias("_s"))
    return out.withColumn("std_error", F.expr("sqrt(greatest(_s, 0)) / n")).withColumn("t", F.expr("mean / nullif(std_error, 0)")).drop("_s")


def residual_diagnostics(df: DataFrame, y: str, x1: str, x2: str) -> DataFrame:
    """Durbin-Watson, Jarque-Bera and Breusch-Pagan of each ticker's two-factor residuals; the p of both is chi-square's with 2 degrees, exp(-x / 2)."""
    fit = two_factor(df, y, x1, x2).select("ticker", "alpha", "beta_1", "beta_2")
    rest = df.where(f"{y} is not null and {x1} is not null and {x2} is not null").join(fit, "ticker").withColumn("e", F.expr(f"{y} - alpha - beta_1 * {x1} - beta_2 * {x2}"))
    rest = rest.withColumn("before", F.expr("lag(e) over (partition by ticker order by date)")).withColumn("e2", F.col("e") * F.col("e"))
    bp = two_factor(rest.select("ticker", "date", "e2", x1, x2), "e2", x1, x2).select("ticker", (F.col("n") * F.col("r_squared")).alias("breusch_pagan"))
    out = rest.groupBy("ticker").agg(
        F.expr("sum((e - before) * (e - before)) / nullif(sum(e2), 0)").alias("durbin_watson"), F.count(F.lit(1)).alias("n"),
        F.skewness("e").alias("s"), F.kurtosis("e").alias("k")
    )
    out = out.withColumn("jarque_bera", F.expr("n / 6.0D * (s * s + k * k / 4)")).withColumn("jb_p", F.expr("exp(-jarque_bera / 2)"))
    out = out.join(bp, "ticker").withColumn("bp_p", F.expr("exp(-breusch_pagan / 2)"))
    return out.select("ticker", "durbin_watson", (~F.col("durbin_watson").between(1.5, 2.5)).alias("dw_flag"), "jarque_bera", "jb_p", "breusch_pagan", "bp_p")


def zero_means(df: DataFrame, value: str, group: str) -> DataFrame:
    """ticker, n, z, p_value, groups, wald, wald_p: whether a ticker's mean is 0, and whether the means of all its groups are.

    z is normal and wald, the sum of the groups' squared z, chi-square with a degree
    a group, for large samples. Groups of one row or without variance take no part
    in wald. Nulls of value are ignored; one shuffle by ticker and group after partial sums, one by ticker.
    """
    cells = df.where(F.col(value).isNotNull()).groupBy("ticker", F.expr(group).alias("cell")).agg(
        F.count(F.lit(1)).alias("m"), F.avg(value).alias("mean"), F.var_samp(value).alias("v")
    )
    out = cells.groupBy("ticker").agg(
        F.sum("m").alias("n"), F.expr("sum(m * mean) / sum(m)").alias("centre"), F.sum(F.expr("m * mean * mean")).alias("squares"),
        F.sum(F.expr("coalesce((m - 1) * v, 0)")).alias("within"), F.count_if(F.expr("v > 0")).alias("groups"),
        F.sum(F.expr("if(v > 0, m * mean * mean / v, null)")).alias("wald")
    )
    out = out.withColumn("z", F.expr("centre / nullif(sqrt((within + greatest(squares - n * centre * centre, 0)) / nullif(n - 1, 0) / n), 0)"))
    return out.select(
        "ticker", "n", "z", p_value_norm("z").alias("p_value"), "groups", "wald", p_value_chi2("wald", F.col("groups").cast("double")).alias("wald_p")
    )


def js_intensity(x: np.ndarray) -> float:
    """Share by which the means of x (names, dates) are drawn to their grand mean: (N - 2) / (T d'S^-1 d) within [0, 1]; 0.5 where S is singular."""
    n, t = x.shape
    if n >= t:  # S has rank T - 1 at most
        return 0.5
    mean = x.mean(axis=1)
    d, rest = mean - mean.mean(), x - mean[:, None]
    s = rest @ rest.T / (t - 1)
    try:
        lower = np.linalg.cholesky(s)
    except np.linalg.LinAlgError:
        return 0.5
    pivots = np.diagonal(lower)
    if pivots.min() <= 1e-8 * pivots.max():
        return 0.5
    half = np.linalg.solve(lower, d)
    below = t * half @ half
    return 0.0 if below <= 0 else float(max(min((n - 2) / below, 1.0), 0.0))


def james_stein(panel: DataFrame, by: str) -> DataFrame:
    """by, ticker, mean, shrunk (annual), intensity: each universe's means drawn to their grand mean, over dates that all its names have.

    Names (N) and complete dates (T) of a universe are counted first. With N >= T
    the covariance is singular whatever the returns are, and nothing is solved;
    else the universe's N x T returns are solved in one task, N being less than
    its number of dates. Pairs of names are never formed. Universes without a
    complete date give no rows; a ticker has one row a date.
    """
    rows = stored(panel.where("ret is not null").select(by, "ticker", "date", "ret"))
    names = rows.groupBy(by).agg(F.count_distinct("ticker").alias("_names"))
    full = back(rows.groupBy(by, "date").agg(F.count(F.lit(1)).alias("_here")), names, [by]).where("_here = _names").select(by, "date", "_names")
    size = full.groupBy(by).agg(F.count(F.lit(1)).alias("_dates"), F.first("_names").alias("_names"))
    kept = back(rows, full.select(by, "date"), [by, "date"])
    means = kept.groupBy(by, "ticker").agg(F.avg("ret").alias("mean"))
    small = back(kept, size.where("_names < _dates").select(by), [by])
    kind = dict(panel.dtypes)[by]

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.pivot(index="ticker", columns="date", values="ret").to_numpy()
        return pd.DataFrame({by: pdf[by].iloc[:1], "intensity": js_intensity(x)})

    solved = small.groupBy(by).applyInPandas(solve, f"{by} {kind}, intensity double")
    share = solved.unionByName(size.where("_names >= _dates").select(by, F.lit(0.5).alias("intensity")))
    whole = back(means, means.groupBy(by).agg(F.avg("mean").alias("_grand")), [by])
    out = back(whole, share, [by])
    return out.select(by, "ticker", (F.col("mean") * 12).alias("mean"), F.expr("((1 - intensity) * mean + intensity * _grand) * 12").alias("shrunk"), "intensity")


def _period_grams(periods: int):
    """Rows (entity, place of the period, count), each entity's together, to the sum over entities of counts counts' / rows: a row a period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, chunk, now, at = np.zeros((periods, periods)), np.zeros((256, periods)), None, -1

        def close() -> None:
            nonlocal at
            own = chunk[: at + 1]
            np.add(total, (own / np.maximum(own.sum(axis=1, keepdims=True), 1)).T @ own, out=total)
            chunk[:], at = 0.0, -1

        some = False
        for batch in batches:
            for entity, place, count in zip(*(batch.column(c).to_pylist() for c in ("entity", "place", "n")), strict=True):
                if not some or entity != now:
                    if at == len(chunk) - 1:
                        close()
                    some, now, at = True, entity, at + 1
                chunk[at, place] += count
        if some:
            close()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(periods), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["place", "row"]
            )

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the rows of each place."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for place, row in zip(batch.column("place").to_pylist(), batch.column("row"), strict=True):
            own = row.values.to_numpy()
            total[place] = total[place] + own if place in total else own
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], names=["place", "row"])


def two_way_effects(panel: DataFrame, y: str, xs: list[str], entity: str = "ticker", period: str = "year") -> DataFrame:
    """term, coef, std_error, n: y on xs with effects of entity and period, exact on unbalanced panels.

    Entities are taken out by their means. Cross products of the regressors, and
    their sums by period, are aggregates; those of the period indicators with each
    other, less the entities' means, are one matrix product a partition, added up
    by rows. The driver takes one number for each pair of periods and regressors,
    8 MB for 1,000 periods, however many rows there are, and runs two small
    aggregations while the plan is built. Rows with a null go; an empty panel
    gives no rows.
    """
    spark, schema = panel.sparkSession, "term string, coef double, std_error double, n long"
    rows = stored(panel.select(F.col(entity).alias("entity"), F.col(period).alias("period"), F.col(y).alias("_z0"), *(F.col(x).alias(f"_z{i}") for i, x in enumerate(xs, 1))).na.drop())
    z = [f"_z{i}" for i in range(len(xs) + 1)]
    periods = [r[0] for r in rows.select("period").distinct().orderBy("period").collect()]
    if not periods:
        return spark.createDataFrame([], schema)
    places = spark.createDataFrame([(p, i) for i, p in enumerate(periods)], f"period {dict(rows.dtypes)['period']}, place int")  # a row a period
    within = back(rows, rows.groupBy("entity").agg(*(F.avg(c).alias(f"_m{c}") for c in z)), ["entity"]).select("period", *((F.col(c) - F.col(f"_m{c}")).alias(c) for c in z))
    sums = within.groupBy("period").agg(F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(c) for c in z), *(F.expr(f"sum({a} * {b})").alias(f"{a}{b}") for i, a in enumerate(z) for b in z[i:]))
    by = {r["period"]: r for r in sums.collect()}
    counts = rows.groupBy("entity", "period").agg(F.count(F.lit(1)).alias("n")).join(places, "period").select("entity", "place", "n")
    grams = counts.repartition("entity").sortWithinPartitions("entity").mapInArrow(_period_grams(len(periods)), "place int, row array<double>")
    added = grams.repartition("place").mapInArrow(_added, "place int, row array<double>")
    shared = np.zeros((len(periods), len(periods)))
    for r in added.collect():
        shared[r.place] = r.row
    n = sum(r["n"] for r in by.values())
    entities = rows.select("entity").distinct().count()
    own = np.diag([float(by[p]["n"]) for p in periods]) - shared
    cross = np.array([[by[p][c] for c in z] for p in periods])
    gram = np.array([[sum(r[z[min(i, j)] + z[max(i, j)]] for r in by.values()) for j in range(len(z))] for i in range(len(z))])
    values, vectors = np.linalg.eigh(own)
    open_ = values > 1e-9 * max(values.max(), 1.0)
    turned = vectors[:, open_].T @ cross
    left = gram - (turned / values[open_, None]).T @ turned
    inverse = np.linalg.pinv(left[1:, 1:])
    coef = inverse @ left[1:, 0]
    free = n - entities - int(open_.sum()) - np.linalg.matrix_rank(left[1:, 1:], tol=1e-9 * max(gram.diagonal().max(), 1e-300))
    variance = max(left[0, 0] - coef @ left[1:, 0], 0.0) / free if free > 0 else float("nan")
    errors = np.sqrt(variance * np.diag(inverse))
    return spark.createDataFrame([(x, float(coef[i]), None if np.isnan(errors[i]) else float(errors[i]), n) for i, x in enumerate(xs)], schema)
