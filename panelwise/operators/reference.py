"""Membership, identifiers, coverage and gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import aligned_start, tolerance
from ..sources.panels import keep_last


def intervals(daily: DataFrame) -> DataFrame:
    """ticker, start_date, end_date (both inclusive): runs over the recorded dates.

    Dates are numbered on their distinct list, which is small, so no window spans the panel.
    """
    numbers = daily.select("date").distinct().withColumn("_d", F.expr("row_number() over (order by date)"))
    runs = daily.join(numbers, "date").withColumn("_g", F.expr("_d - row_number() over (partition by ticker order by date)"))
    return runs.groupBy("ticker", "_g").agg(F.min("date").alias("start_date"), F.max("date").alias("end_date")).drop("_g")


def expanded(spans: DataFrame, dates: DataFrame) -> DataFrame:
    """ticker, date of every recorded date inside an interval: months are the join key, so the range test runs within a month."""
    months = F.explode(F.sequence(F.trunc("start_date", "MM"), F.trunc("end_date", "MM"), F.expr("interval 1 month"))).alias("_m")
    keyed = spans.select("ticker", "start_date", "end_date", months)
    return keyed.join(
        dates.select("date", F.trunc("date", "MM").alias("_m")).distinct(), "_m"
    ).where("date between start_date and end_date").select("ticker", "date")


def members_on(spans: DataFrame, day: str) -> DataFrame:
    return spans.where(F.lit(day).cast("date").between(F.col("start_date"), F.col("end_date"))).select("ticker").distinct()


def members_during(spans: DataFrame, start: str, end: str) -> DataFrame:
    """Everyone who was a member at any time of the period."""
    return spans.where((F.col("start_date") <= F.lit(end).cast("date")) & (F.col("end_date") >= F.lit(start).cast("date"))).select("ticker").distinct()


def span(spans: DataFrame) -> DataFrame:
    return spans.groupBy("ticker").agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"), F.count(F.lit(1)).alias("intervals"))


def while_member(panel: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows of the panel whose date lies in an interval of their ticker."""
    inside = (panel["ticker"] == spans["ticker"]) & panel["date"].between(spans["start_date"], spans["end_date"])
    return panel.join(spans, inside, "left_semi")


def overlaps(spans: DataFrame, start: str, end: str) -> DataFrame:
    cut = spans.withColumn(
        "start_date", F.greatest("start_date", F.lit(start).cast("date"))
    ).withColumn("end_date", F.least("end_date", F.lit(end).cast("date")))
    return cut.where("start_date <= end_date")


def closed_successors(mapping: DataFrame, hops: int = 10) -> DataFrame:
    """old, final, chain: each key's chain followed up to `hops` steps; final is null where it ends delisted. A cycle raises when read.

    Each hop is a join of the still open chains only.
    """
    step = mapping.select(F.col("old").alias("_at"), F.col("new").alias("_to"), F.lit(True).alias("_known"))
    out = mapping.select("old", F.col("new").alias("final"), F.array("old", "new").alias("chain"))
    for _ in range(hops - 1):
        joined = out.join(step, out["final"] == step["_at"], "left")
        moved = F.coalesce("_known", F.lit(False))
        out = joined.select(
            "old", F.when(moved, F.col("_to")).otherwise(F.col("final")).alias("final"),
            F.when(moved, F.concat("chain", F.array("_to"))).otherwise(F.col("chain")).alias("chain")
        )
    # A repeated key in a chain is a cycle.
    return out.where(F.when(F.size(F.array_distinct(F.filter("chain", lambda x: x.isNotNull()))) == F.size(F.filter("chain", lambda x: x.isNotNull())), True).otherwise(F.raise_error(F.lit("successor cycle")).isNull()))


def resolved(df: DataFrame, closed: DataFrame, key: str) -> DataFrame:
    """df with resolved and delisted: a key without a successor resolves to itself."""
    known = closed.select(F.col("old").alias("_old"), "final", F.lit(True).alias("_known"))
    joined = df.join(known, df[key] == known["_old"], "left")
    return joined.withColumn(
        "resolved", F.when(F.col("_known"), F.col("final")).otherwise(F.col(key))
    ).withColumn("delisted", F.coalesce("_known", F.lit(False)) & F.col("final").isNull()).drop("_old", "final", "_known")


def overridden(mapping: DataFrame, extra: DataFrame) -> DataFrame:
    """mapping with rows of extra put in place of those of the same key."""
    both = mapping.withColumn("_o", F.lit(0)).unionByName(extra.withColumn("_o", F.lit(1)))
    return keep_last(both, ["old"], "_o").drop("_o")


def alternatives(names: DataFrame) -> DataFrame:
    """entity, ticker, others: for entities with several tickers, the other ones in order of start."""
    lists = names.groupBy("entity").agg(F.sort_array(F.collect_set(F.struct("start_date", "ticker"))).alias("all")).where("size(all) > 1")
    rows = lists.select("entity", F.explode("all.ticker").alias("ticker"), F.col("all.ticker").alias("every"))
    return rows.select("entity", "ticker", F.array_remove("every", F.col("ticker")).alias("others"))


def extents(panel: DataFrame) -> DataFrame:
    return panel.groupBy("ticker").agg(F.min("date").alias("actual_start"), F.max("date").alias("actual_end"), F.count(F.lit(1)).alias("records"))


def last_date_distribution(panel: DataFrame, k: int = 10) -> DataFrame:
    """date, n, percent: how many tickers end on each of the k latest of their last dates."""
    ends = extents(panel).groupBy(F.col("actual_end").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    every = ends.agg(F.sum("n").alias("_all"))  # one row
    return ends.crossJoin(every).select("date", "n", (F.col("n") * 100 / F.col("_all")).alias("percent")).orderBy(F.desc("date")).limit(k)


def gap_check(required: DataFrame, panel: DataFrame, freq: str = "monthly") -> DataFrame:
    """Coverage of each required period (ticker, start_date, end_date): status, missing days at both ends and what to fetch.

    complete if both ends are missing no more than the frequency's tolerance,
    missing without any row inside the period, partial otherwise.
    """
    inside = panel.select("ticker", "date").join(required, "ticker").where("date between start_date and end_date")
    found = inside.groupBy("ticker", "start_date", "end_date").agg(F.min("date").alias("actual_start"), F.max("date").alias("actual_end"))
    df = required.join(found, ["ticker", "start_date", "end_date"], "left").withColumn("want", aligned_start(F.col("start_date"), F.lit(freq)))
    df = df.withColumn(
        "missing_start_days", F.greatest(F.datediff("actual_start", "want"), F.lit(0))
    ).withColumn("missing_end_days", F.greatest(F.datediff("end_date", "actual_end"), F.lit(0)))
    slack = tolerance(F.lit(freq))
    status = F.when(F.col("actual_start").isNull(), "missing").when(
        (F.col("missing_start_days") <= slack) & (F.col("missing_end_days") <= slack), "complete"
    ).otherwise("partial")
    df = df.withColumn("status", status)
    fetch = F.col("status") != "complete"
    return df.withColumn(
        "fetch_start",
        F.when(fetch, F.when((F.col("missing_start_days") > slack) | F.col("actual_start").isNull(), F.col("start_date")).otherwise(F.date_add("actual_end", 1)))
    ).withColumn("fetch_end", F.when(fetch, F.when((F.col("missing_end_days") > slack) | F.col("actual_start").isNull(), F.col("end_date")).otherwise(F.date_sub("actual_start", 1)))).drop("want")


def coverage(checked: DataFrame, slack: int = 3) -> DataFrame:
    """One row a ticker: complete or missing if all its periods are, else partial; missing days beyond the tolerance."""
    beyond = F.when(F.col("actual_start").isNull(), F.datediff("end_date", "start_date") + 1).otherwise(F.when(
        F.col("missing_start_days") > slack, F.col("missing_start_days")
    ).otherwise(0) + F.when(F.col("missing_end_days") > slack, F.col("missing_end_days")).otherwise(0))
    out = checked.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("periods"), F.count_if(F.col("status") == "complete").alias("complete"),
        F.count_if(F.col("status") == "missing").alias("missing"), F.sum(beyond).cast("long").alias("total_missing_days")
    )
    return out.withColumn(
        "status",
        F.when(F.col("complete") == F.col("periods"), "complete").when(F.col("missing") == F.col("periods"), "missing").otherwise("partial")
    )


def frequency_coverage(required: DataFrame, panels: dict[str, DataFrame]) -> DataFrame:
    """coverage() of the required periods by each frequency's own panel, with its tolerance, as rows of freq."""
    each = [coverage(gap_check(required, panel, freq)).withColumn("freq", F.lit(freq)) for freq, panel in panels.items()]
    out = each[0]
    for other in each[1:]:
        out = out.unionByName(other)
    return out


def month_continuity(panel: DataFrame, start: str | None = None) -> DataFrame:
    """Expected and present months between each ticker's first and last, gap percent and the first ten missing months."""
    months = panel.select("ticker", F.trunc("date", "MM").alias("month")).distinct()
    months = months if start is None else months.where(F.col("month") >= F.trunc(F.lit(start).cast("date"), "MM"))
    by = months.groupBy("ticker").agg(
        F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.count(F.lit(1)).alias("present"),
        F.collect_set("month").alias("have")
    )
    by = by.withColumn("lack", F.array_sort(F.array_except(F.sequence("first_month", "last_month", F.expr("interval 1 month")), "have")))
    by = by.withColumn("expected", (F.months_between("last_month", "first_month") + 1).cast("long")).withColumn("missing", F.size("lack").cast("long"))
    sample = F.array_join(F.transform(F.slice("lack", 1, 10), lambda d: F.date_format(d, "yyyy-MM")), ",")
    return by.select(
        "ticker", "first_month", "last_month", "expected", "present", "missing",
        (F.col("missing") / F.col("expected") * 100).alias("gap_percent"), (F.col("missing") == 0).alias("continuous"),
        sample.alias("sample_gaps")
    )


def period_bars(events: DataFrame, key: str, value: str, period: str = "week") -> DataFrame:
    """Last value of each period, carried over empty ones: week ends on Friday, month on its last day."""
    end = F.last_day("ts") if period == "month" else F.next_day(F.date_sub(F.to_date("ts"), 1), "FRI")
    bars = events.select(key, end.alias("date"), "ts", "event_id", value).groupBy(key, "date").agg(F.max_by(value, F.struct("ts", "event_id")).alias(value))
    ends = bars.groupBy(key).agg(F.min("date").alias("a"), F.max("date").alias("b"))
    spine = ends.select(
        key,
        F.explode(F.expr("sequence(a, b, interval 7 day)" if period == "week" else "transform(sequence(trunc(a, 'MM'), trunc(b, 'MM'), interval 1 month), d -> last_day(d))")).alias("date")
    )
    return spine.join(bars, [key, "date"], "left").withColumn(value, F.expr(f"last_value({value}) ignore nulls over (partition by {key} order by date)"))
