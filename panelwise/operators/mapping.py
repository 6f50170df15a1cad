"""Identifier maps, lookups through them, and what becomes of each identifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reference import resolved


def clean_pairs(raw: DataFrame, key: Column, name: Column, order: Column) -> DataFrame:
    """key (long), ticker (trimmed, upper case), first_row of each distinct pair; rows that lack either go."""
    pairs = raw.select(key.cast("long").alias("key"), F.upper(F.trim(name)).alias("ticker"), order.alias("_o")).where("key is not null and ticker <> ''")
    return pairs.groupBy("key", "ticker").agg(F.min("_o").alias("first_row"))


def first_name(pairs: DataFrame) -> DataFrame:
    """key, ticker: each key's name that was loaded first."""
    return pairs.groupBy("key").agg(F.min_by("ticker", F.struct("first_row", "ticker")).alias("ticker"))


def key_of(asked: DataFrame, pairs: DataFrame) -> DataFrame:
    """asked with key: that of its ticker in any case, the one loaded first; null where there is none."""
    by_name = pairs.groupBy(F.upper("ticker").alias("_u")).agg(F.min_by("key", F.struct("first_row", "key")).alias("key"))
    return asked.join(by_name, F.upper(asked["ticker"]) == by_name["_u"], "left").drop("_u")


def put(mapping: DataFrame, extra: DataFrame) -> DataFrame:
    """mapping (ticker, key) with extra's rows in place of those of the same ticker in any case."""
    names = extra.select(F.upper("ticker").alias("_u")).distinct()
    return mapping.join(names, F.upper(mapping["ticker"]) == names["_u"], "left_anti").unionByName(extra)


def in_period(df: DataFrame, start_date=None, end_date=None, start_year: int | None = None, end_year: int | None = None) -> DataFrame:
    """Rows of a period; on each side a date counts before a year, and neither leaves it open."""
    low = start_date or (start_year and f"{start_year}-01-01")
    high = end_date or (end_year and f"{end_year}-12-31")
    if low:
        df = df.where(F.col("date") >= F.lit(low).cast("date"))
    return df.where(F.col("date") <= F.lit(high).cast("date")) if high else df


def fetched(asked: DataFrame, panel: DataFrame, skip_missing: bool = True) -> DataFrame:
    """The panel's rows of the asked tickers; without skip_missing, one row of nulls for a ticker that has none."""
    return asked.select("ticker").distinct().join(panel, "ticker", "inner" if skip_missing else "left")


def unfinished(asked: DataFrame, done: DataFrame) -> DataFrame:
    """What has no result yet, so that a run that stopped goes on from there."""
    return asked.join(done.select("ticker").distinct(), "ticker", "left_anti")


def resolution(universe: DataFrame, closed: DataFrame, data: DataFrame) -> DataFrame:
    """ticker, resolved, delisted, own, found: whether the ticker itself, and what it resolves to, has rows in data."""
    have = data.select(F.col("ticker").alias("_t")).distinct()
    out = resolved(universe.select("ticker").distinct(), closed, "ticker")
    for name, key in (("own", "ticker"), ("found", "resolved")):
        out = out.join(have.withColumn(name, F.lit(True)), F.col(key) == F.col("_t"), "left").drop("_t").withColumn(name, F.coalesce(name, F.lit(False)))
    return out


def outcome(resolution: DataFrame) -> DataFrame:
    """skipped (delisted), processed (own rows), mapped (its successor's rows) or no data."""
    case = F.when(F.col("delisted"), "skipped").when(F.col("own"), "processed").when(F.col("found"), "mapped").otherwise("no data")
    return resolution.withColumn("outcome", case)


def refetch(resolution: DataFrame) -> DataFrame:
    """fetched under its own name, resolved to a successor that has rows, or skipped."""
    return resolution.withColumn("plan", F.when(F.col("own"), "fetched").when(F.col("found") & ~F.col("delisted"), "resolved").otherwise("skipped"))


def overlap_status(extents: DataFrame, start: str, end: str) -> DataFrame:
    """complete if first and last date meet the period, partial if they do not, missing without dates."""
    meets = (F.col("actual_end") >= F.lit(start).cast("date")) & (F.col("actual_start") <= F.lit(end).cast("date"))
    return extents.withColumn("status", F.when(F.col("actual_start").isNull(), "missing").when(meets, "complete").otherwise("partial"))


def sample_years(panel: DataFrame, least: int, early: int, late: int) -> DataFrame:
    """ticker, year, since, years, balanced, cohort of every year of tickers with `least` years or more.

    since counts from the first year; the cohort is early up to `early`, middle up
    to `late`, late beyond; balanced means a row in every year of the panel.
    """
    years = panel.select("ticker", F.year("date").cast("long").alias("year")).distinct()
    by = years.groupBy("ticker").agg(F.count(F.lit(1)).alias("years"), F.min("year").alias("first_year")).where(F.col("years") >= least)
    every = years.agg(F.count_distinct("year").alias("_all"))
    cohort = F.when(F.col("first_year") <= early, "early").when(F.col("first_year") <= late, "middle").otherwise("late")
    out = years.join(by, "ticker").crossJoin(every)
    return out.select(
        "ticker", "year", (F.col("year") - F.col("first_year")).alias("since"), "years",
        (F.col("years") == F.col("_all")).alias("balanced"), cohort.alias("cohort")
    )
