"""Incremental ingest with Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from ..sources.panels import upsert, work_folder  # noqa: F401


def read_events(spark: SparkSession, folder: str, pattern: str = "*.parquet", files_a_batch: int | None = 1) -> DataFrame:
    """Files of a folder as a stream, None: all new ones in one batch; the schema is that of what is there now."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return (reader.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else reader).parquet(folder)


def on_time(events: DataFrame, lookback_days: int = 5) -> DataFrame:
    """Late rows are taken for lookback_days behind the newest; older ones are dropped by the watermark downstream."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", f"{lookback_days} days")


def without_repeats(events: DataFrame, key: list[str], lookback_days: int = 5) -> DataFrame:
    return on_time(events, lookback_days).dropDuplicatesWithinWatermark(key)


def bars(events: DataFrame, key: str = "event_type", value: str = "value", every: str = "7 days", lookback_days: int = 5) -> DataFrame:
    """Last value of each tumbling window; works on streams and tables."""
    df = on_time(events, lookback_days) if events.isStreaming else events
    out = df.groupBy(F.window("ts", every).alias("w"), key).agg(F.max_by(value, F.struct("ts", "event_id")).alias("last_value"), F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "last_value", "n")


def rolling_coverage(events: DataFrame, key: str = "event_type", length: str = "7 days", step: str = "1 day", lookback_days: int = 5) -> DataFrame:
    """start, end, key, users, n of each sliding window, users being distinct and exact.

    A stream counts in two stateful steps: events of each window, key and user,
    then, as the watermark closes a window, its users and their events. Such a
    stream is written in append mode and gives each window once, when no event
    can change it any more; a table gives all windows.
    """
    df = on_time(events, lookback_days) if events.isStreaming else events
    window = F.window("ts", length, step).alias("w")
    if events.isStreaming:
        seen = df.groupBy(window, key, "user_id").agg(F.count(F.lit(1)).alias("n"))
        out = seen.groupBy("w", key).agg(F.count("user_id").alias("users"), F.sum("n").alias("n"))
    else:
        out = df.groupBy(window, key).agg(F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "users", "n")


def spells(events: DataFrame, key: str = "user_id", gap: str = "1 day", lookback_days: int = 5) -> DataFrame:
    """Sessions: runs of events of a key with no gap of `gap` or more."""
    df = on_time(events, lookback_days) if events.isStreaming else events
    out = df.groupBy(F.session_window("ts", gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def upsert_stream(events: DataFrame, path: str, key: list[str], partition_by: list[str], scratch: str, checkpoint: str, order: str = "ts") -> StreamingQuery:
    """Merge each micro-batch into a table; a batch that runs again changes nothing, as the later row of a key wins again."""

    def merge(batch: DataFrame, number: int) -> None:
        upsert(
            batch.sparkSession, path,
            batch.withColumn("seq", F.unix_micros(F.col(order).cast("timestamp")) if order == "ts" else F.col(order)), key, partition_by,
            f"{scratch}/{number}"
        )

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: Groups that keys of recorded spells are dealt to, and milliseconds of a day.
BUCKETS, _DAY = 1024, 86_400_000
#: Numbers and days of open runs in a bucket's state; days are those of unix_date.
_RUNS = ("first", "start", "last", "end", "next")
#: The day of a next recorded date that is not known.
_UNKNOWN = -(1 << 31)


def _closed_runs(watermark: int | None, names: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names and runs after runs of one name that touch are joined, which of them are closed).

    runs has a column a run: first, start, last, end, next, as numbers of recorded
    dates and as days. A run is closed once the watermark's day is past its next
    recorded date.
    """
    names, code = np.unique(names, return_inverse=True)
    order = np.lexsort((runs[0], code))
    code, runs = code[order], runs[:, order]
    reach = np.maximum.accumulate((code << 32) + runs[2])
    starts = np.flatnonzero(np.append(True, (code << 32)[1:] + runs[0][1:] > reach[:-1] + 1)) if len(code) else np.zeros(0, np.int64)
    ends = np.maximum.reduceat((runs[2] << 33) + (runs[4] - _UNKNOWN), starts) if len(code) else np.zeros(0, np.int64)
    after = (ends & ((1 << 33) - 1)) + _UNKNOWN
    last = np.maximum.reduceat(runs[3], starts) if len(code) else ends
    joined = np.stack([runs[0][starts], runs[1][starts], ends >> 33, last, after])
    return names[code[starts]], joined, (after > _UNKNOWN) & (after < (_UNKNOWN if watermark is None else watermark))


def recorded_spells(rows: DataFrame, dates: DataFrame, key: str = "ticker", lookback_days: int = 5) -> DataFrame:
    """key, start_date, end_date (inclusive) of each closed spell of a stream of (key, date): runs over the recorded dates, however far apart these are.

    dates is the table of recorded dates, read anew in each micro-batch, so it may
    grow as the feed does; rows of other dates are left out. Keys are dealt to
    BUCKETS groups, so that a micro-batch is a call a bucket, not a key; a bucket's
    state is its keys' runs that are still open. A spell is given once, in append mode, when
    the watermark, lookback_days behind the newest row, is past the recorded date
    that follows it; rows may come in any order within that time. Null keys and
    dates are left out.
    """
    kind = dict(rows.dtypes)[key]
    numbered = dates.select("date").distinct().select("date", F.expr("int(row_number() over (order by date))").alias("number"), F.expr("lead(date) over (order by date)").alias("next"))
    feed = rows.where(f"{key} is not null and date is not null").withColumn("at", F.col("date").cast("timestamp")).withWatermark("at", f"{lookback_days} days")
    known = feed.join(numbered, "date").select(
        F.pmod(F.xxhash64(key), F.lit(BUCKETS)).alias("bucket"), key, "at", "number", F.unix_date("date").alias("day"),
        F.coalesce(F.unix_date("next"), F.lit(_UNKNOWN)).alias("after")
    )

    def close(own: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names, runs = [], []
        if state.exists:
            held = state.get
            names.append(np.array(held[0]))
            runs.append(np.array(held[1:], dtype=np.int64))
        for pdf in batches:
            new = pdf[["number", "day", "number", "day", "after"]].to_numpy(np.int64).T
            names.append(pdf[key].to_numpy())
            runs.append(new)
        if not names:
            return
        now = state.getCurrentWatermarkMs()
        name, run, closed = _closed_runs(now // _DAY if now > 0 else None, np.concatenate(names), np.concatenate(runs, axis=1))
        stay = run[:, ~closed]
        if stay.shape[1]:
            state.update((name[~closed].tolist(), *stay.tolist()))
            ends = stay[4][stay[4] > _UNKNOWN]
            if len(ends):
                state.setTimeoutTimestamp(max((int(ends.min()) + 1) * _DAY, now + 1))
        else:
            state.remove()
        if closed.any():
            yield pd.DataFrame({key: name[closed], "start": run[1][closed], "end": run[3][closed]})

    held = f"names array<{kind}>, " + ", ".join(f"{c} array<int>" for c in _RUNS)
    out = known.groupBy("bucket").applyInPandasWithState(close, f"{key} {kind}, start int, end int", held, "append", "EventTimeTimeout")
    return out.select(key, F.date_from_unix_date("start").alias("start_date"), F.date_from_unix_date("end").alias("end_date"))
