"""Panels derived from the star-schema tables, and readers and writers of panel tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def work_folder(spark: SparkSession) -> str:
    """A new folder in the cluster's spark.checkpoint.dir; where that is unset, as in tests, a local one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{shared}/{uuid.uuid4().hex}" if shared else "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def stored(df: DataFrame) -> DataFrame:
    """df written to a work folder and read again, for a panel that later steps read more than once; a lost executor costs no earlier work."""
    path = f"{work_folder(df.sparkSession)}/panel"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def no_nan(c: Column) -> Column:
    """NaN means missing at a source and is null from there on."""
    return F.when(F.isnan(c), None).otherwise(c)


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df


def prices(lineitem: DataFrame) -> DataFrame:
    """ticker, date (month end), adj_close, adj_volume."""
    by = lineitem.groupBy(F.col("l_suppkey").alias("ticker"), F.last_day("l_shipdate").alias("date"))
    return by.agg((F.sum("l_extendedprice") / F.sum("l_quantity")).alias("adj_close"), F.sum("l_quantity").alias("adj_volume"))


def market(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy(F.last_day("l_shipdate").alias("date")).agg((F.sum("l_extendedprice") / F.sum("l_quantity")).alias("adj_close"))


def rates(lineitem: DataFrame) -> DataFrame:
    """date, rate in annual percent."""
    return lineitem.groupBy(F.last_day("l_shipdate").alias("date")).agg((100 * F.avg("l_tax")).alias("rate"))


def scores(lineitem: DataFrame) -> DataFrame:
    """ticker, date, E, S, G, ESG."""
    by = lineitem.groupBy(F.col("l_suppkey").alias("ticker"), F.last_day("l_shipdate").alias("date"))
    e, s, g = 1000 * F.avg("l_discount"), F.expr("100 * avg(if(l_returnflag = 'N', 1.0D, 0.0D))"), F.expr("100 * avg(if(l_linestatus = 'O', 1.0D, 0.0D))")
    return by.agg(e.alias("E"), s.alias("S"), g.alias("G")).withColumn("ESG", (F.col("E") + F.col("S") + F.col("G")) / 3)


def panel_sums(lineitem: DataFrame) -> DataFrame:
    """ticker, date and the sums of which prices, scores, market and rates are ratios: one pass over the fact table for all panels."""
    by = lineitem.groupBy(F.col("l_suppkey").alias("ticker"), F.last_day("l_shipdate").alias("date"))
    return by.agg(
        F.sum("l_extendedprice").alias("paid"), F.sum("l_quantity").alias("quantity"), F.sum("l_tax").alias("tax"), F.count("l_tax").alias("taxed"),
        F.sum("l_discount").alias("discount"), F.count("l_discount").alias("discounted"), F.count_if(F.col("l_returnflag") == "N").alias("kept"),
        F.count_if(F.col("l_linestatus") == "O").alias("open"), F.count(F.lit(1)).alias("rows"),
    )


def prices_of(sums: DataFrame) -> DataFrame:
    return sums.select("ticker", "date", (F.col("paid") / F.col("quantity")).alias("adj_close"), F.col("quantity").alias("adj_volume"))


def market_of(sums: DataFrame) -> DataFrame:
    return sums.groupBy("date").agg((F.sum("paid") / F.sum("quantity")).alias("adj_close"))


def rates_of(sums: DataFrame) -> DataFrame:
    return sums.groupBy("date").agg((100 * (F.sum("tax") / F.sum("taxed"))).alias("rate"))


def scores_of(sums: DataFrame) -> DataFrame:
    e, s, g = F.expr("1000 * (discount / nullif(discounted, 0))"), F.expr("100 * (double(kept) / rows)"), F.expr("100 * (double(open) / rows)")
    return sums.select("ticker", "date", e.alias("E"), s.alias("S"), g.alias("G")).withColumn("ESG", (F.col("E") + F.col("S") + F.col("G")) / 3)


def sectors(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    joined = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).join(region, nation["n_regionkey"] == region["r_regionkey"])
    return joined.select(F.col("s_suppkey").alias("ticker"), F.col("r_name").alias("sector"))


def membership_daily(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_custkey").alias("ticker"), F.last_day("o_orderdate").alias("date")).distinct()


def successors(part: DataFrame) -> DataFrame:
    """old, new: a key's successor is the next key, or none where it is delisted."""
    k = F.col("p_partkey")
    return part.where("p_partkey % 7 in (1, 2) or p_partkey % 11 = 0").select(k.alias("old"), F.when(k % 11 == 0, None).otherwise(k + 1).alias("new"))


def date_range(df: DataFrame, start=None, end=None, date: str = "date") -> DataFrame:
    """Rows of an inclusive range; an open side is not filtered. The predicate reaches the scan."""
    if start is not None:
        df = df.where(F.col(date) >= F.lit(start).cast("date"))
    return df if end is None else df.where(F.col(date) <= F.lit(end).cast("date"))


def panel_scan(df: DataFrame, entities: DataFrame | None = None, columns: list[str] | None = None, start=None, end=None, key: str = "ticker") -> DataFrame:
    """A panel cut to a set of entities, columns and dates; entities without rows are absent."""
    out = date_range(df, start, end)
    out = out if entities is None else out.join(entities.select(key).distinct(), key, "left_semi")
    return out.select(*columns) if columns else out


def keep_last(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """One row a key: the one of largest order."""
    ranked = df.withColumn("_n", F.expr(f"row_number() over (partition by {', '.join(key)} order by {order} desc)"))
    return ranked.where("_n = 1").drop("_n")


def keep_first(df: DataFrame, key: list[str], order: str) -> DataFrame:
    ranked = df.withColumn("_n", F.expr(f"row_number() over (partition by {', '.join(key)} order by {order})"))
    return ranked.where("_n = 1").drop("_n")


def merged(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Union in which a new row replaces the stored one of its key, and a later row of `new`, by column seq, an earlier one."""
    both = old.withColumn("seq", F.lit(-1).cast("long")).unionByName(new.withColumn("seq", F.col("seq").cast("long")), allowMissingColumns=True)
    return keep_last(both, key, "seq").drop("seq")


def upsert(spark: SparkSession, path: str, new: DataFrame, key: list[str], partition_by: list[str], scratch: str) -> None:
    """Merge rows (with their order in column seq) into a Parquet table, rewriting only the partitions that they touch.

    The merge is written to scratch first, as a table cannot be read and overwritten in one job.
    """
    if spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(path)):
        touched = new.select(*partition_by).distinct()
        old = spark.read.parquet(path).join(touched, partition_by, "left_semi")
        out = merged(old, new, key)
    else:
        out = keep_last(new, key, "seq").drop("seq")
    out.write.mode("overwrite").parquet(scratch)
    done = spark.read.parquet(scratch).repartition(*partition_by).sortWithinPartitions(*key)
    done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def upserted(spark: SparkSession, folder: str, batches: list[DataFrame], key: list[str], date: str = "date") -> DataFrame:
    """The table in `folder` after each batch is merged into it in turn; it has a partition a year of `date`, later rows of a key win."""
    for i, batch in enumerate(batches):
        upsert(spark, f"{folder}/table", batch.withColumns({"year": F.year(date), "seq": F.lit(i).cast("long")}), key, ["year"], f"{folder}/merge{i}")
    return spark.read.parquet(f"{folder}/table")


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def save_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_returns(spark: SparkSession, path: str) -> DataFrame:
    """date, ret of a portfolio's Parquet or CSV file; the date is the column of that name, or else the first, and ret the first other one."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind not in ("parquet", "csv"):
        raise ValueError(f"neither .parquet nor .csv: {path}")
    df = spark.read.parquet(path) if kind == "parquet" else spark.read.csv(path, header=True, inferSchema=True)
    date = "date" if "date" in df.columns else df.columns[0]
    value = next(c for c in df.columns if c != date)
    return df.select(F.col(f"`{date}`").cast("date").alias("date"), no_nan(F.col(f"`{value}`").cast("double")).alias("ret"))


def inventory(files: DataFrame) -> DataFrame:
    """path, files, bytes of what a scan with _metadata reads."""
    each = files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).distinct()
    return each.groupBy(F.regexp_extract("file", "([^/]+)/[^/]*$", 1).alias("kind")).agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


def explode_members(raw: DataFrame, min_date=None) -> DataFrame:
    """date, ticker from rows of a date and a comma-separated list: trimmed, unquoted, upper-cased, empties and bad dates dropped, distinct."""
    rows = raw.select(F.try_to_date("date").alias("date"), F.explode(F.split("tickers", ",")).alias("ticker"))
    rows = rows.withColumn("ticker", F.upper(F.regexp_replace("ticker", "[\\s\"']", ""))).where("date is not null and ticker <> ''")
    return date_range(rows, min_date).distinct()


def number(text: Column) -> Column:
    """A number written as text; null where it is not one, such as '.'."""
    return no_nan(text.try_cast("double"))


def observations(payload: DataFrame, body: str) -> DataFrame:
    """date, value of every element of a JSON body's observations[]; a value that is no number is null, undated ones are dropped."""
    parsed = F.from_json(F.col(body), "observations array<struct<date: string, value: string>>")
    rows = payload.select(F.explode(parsed["observations"]).alias("o"))
    return rows.select(F.try_to_date("o.date").alias("date"), number(F.col("o.value")).alias("value")).where("date is not null")


RAW_SCORES = ["gvkey", "YearMonth", "ESG Score", "Environmental Pillar Score", "Social Pillar Score", "Governance Pillar Score"]


def raw_scores(raw: DataFrame) -> DataFrame:
    """gvkey, date (month end), year, month, ESG, E, S, G of rows with YearMonth as YYYYMM and scores as text; rows without a valid month are dropped."""
    ym = require_columns(raw, RAW_SCORES).withColumn("_ym", F.col("YearMonth").try_cast("int"))
    made = F.expr("try_make_timestamp(_ym div 100, _ym % 100, 1, 0, 0, 0)").cast("date")
    dated = ym.withColumn("date", F.last_day(made)).where("date is not null")
    names = dict(zip(RAW_SCORES[2:], ("ESG", "E", "S", "G"), strict=True))
    return dated.select(
        F.col("gvkey").cast("long").alias("gvkey"), "date", F.year("date").alias("year"), F.month("date").alias("month"),
        *(number(F.col(f"`{c}`")).alias(n) for c, n in names.items())
    )


def read_raw_scores(spark: SparkSession, path: str) -> DataFrame:
    """raw_scores of a CSV file with a header, or of a Parquet table."""
    return raw_scores(spark.read.csv(path, header=True) if path.rstrip("/").lower().endswith(".csv") else spark.read.parquet(path))


def build_membership(spark: SparkSession, path: str, new: DataFrame, rebuild: bool = False, scratch: str | None = None) -> DataFrame:
    """One row of statistics (rows, dates, tickers, first_date, last_date) of the daily membership table at path after new (date, ticker) is merged in, or put in its place."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs)
    own = new.select("date", "ticker")
    merged_rows = (own if rebuild or not there else spark.read.parquet(path).select("date", "ticker").unionByName(own)).dropDuplicates(["date", "ticker"])
    if there and not rebuild:  # a table cannot be read and overwritten in one job
        merged_rows.write.mode("overwrite").parquet(scratch or f"{path}_merge")
        merged_rows = spark.read.parquet(scratch or f"{path}_merge")
    save_table(merged_rows, path)
    return spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("date").alias("dates"), F.count_distinct("ticker").alias("tickers"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


def save_symbols(df: DataFrame, path: str, key: str = "ticker") -> None:
    """The distinct symbols as CSV with a header."""
    save_report(df.select(key).distinct(), path)


def read_symbols(spark: SparkSession, path: str, key: str = "ticker") -> DataFrame:
    return spark.read.csv(path, header=True).select(F.col(key)).where(F.col(key).isNotNull()).distinct()
