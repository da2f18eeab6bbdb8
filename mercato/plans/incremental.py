"""Incremental refresh of the date-keyed summaries (SURVEY §4 "full recompute" -> M6).

At warehouse scale the daily and monthly sales summaries should not be
recomputed from the whole fact on every run. Facts are laid out by purchase
month (``order_purchase_month`` = ``yyyyMM``), the summaries are written
partitioned by the same month, and a refresh:

1. takes the set of months touched: those of the new or changed rows, and those
   in which the changed or deleted rows were before (only keys are read for it),
2. reads only those month partitions of the fact (a list of month numbers,
   pushed down as a partition filter),
3. recomputes the daily rows of those months and overwrites just those
   partitions (``partitionOverwriteMode=dynamic``); a month left without rows
   loses its partition; other months' files are not rewritten. Monthly rows are
   rolled up from the refreshed days.

Because a day's summary depends only on the facts of that day, the result is
identical to a full recompute, also for rows that move to another month, for
deleted rows and for months that become empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .aggregates import agg_sales_daily, agg_sales_monthly

MONTH = "order_purchase_month"


def with_month(fact: DataFrame) -> DataFrame:
    """Add the month partition column derived from the smart date key."""
    return fact.withColumn(MONTH, (F.col("order_purchase_date_key") / 100).cast("int"))


def write_fact_by_month(fact: DataFrame, path: str, only_present_months: bool = False) -> None:
    """Month-partitioned fact; files sorted by date key inside for tight min/max statistics.

    Rows are rebalanced by month: small months come together in one task, and a
    month holding a third of the data is split into tasks of the advisory size, so
    the number of files follows the bytes, not tasks x months (adaptive execution).
    ``only_present_months`` replaces just the months present in ``fact``;
    otherwise the whole table is replaced.
    """
    mode = "dynamic" if only_present_months else "static"
    (with_month(fact).hint("rebalance", MONTH).sortWithinPartitions(MONTH, "order_purchase_date_key").write.mode("overwrite")
     .option("partitionOverwriteMode", mode).partitionBy(MONTH).parquet(path))


def touched_months(delta: DataFrame) -> DataFrame:
    """Distinct months present in new or changed fact rows (map-side distinct)."""
    return with_month(delta).select(MONTH).distinct()


def _daily_by_month(daily: DataFrame) -> DataFrame:
    return daily.withColumn(MONTH, (F.year("full_date") * 100 + F.month("full_date")).cast("int"))


def _drop_months(spark: SparkSession, path: str, months: set[int]) -> None:
    """Deletes the partitions of months that have no rows any more."""
    jvm = spark.sparkContext._jvm
    for month in sorted(months):
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MONTH}={month}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _months(df: DataFrame) -> set[int]:
    return {r[0] for r in df.select(MONTH).distinct().collect()}  # a row for each month


def refresh_daily(spark: SparkSession, fact_path: str, dim_date: DataFrame, months: DataFrame,
                  daily_path: str) -> None:
    """Recompute and overwrite only the touched months of the month-partitioned daily summary."""
    touched = _months(months)
    fact = spark.read.parquet(fact_path).where(F.col(MONTH).isin(sorted(touched)))
    daily = _daily_by_month(agg_sales_daily(fact, dim_date))
    (daily.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(MONTH).parquet(daily_path))
    _drop_months(spark, daily_path, touched - _months(fact))


def refresh_monthly(spark: SparkSession, daily_path: str, monthly_path: str) -> None:
    """Monthly rows are a roll-up of the (small) daily table; rewritten whole."""
    daily = spark.read.parquet(daily_path).drop(MONTH)
    agg_sales_monthly(daily).write.mode("overwrite").parquet(monthly_path)


def apply_fact_delta(spark: SparkSession, fact_path: str, delta: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """Puts ``delta``'s rows in place of those with the same key, takes out the keys of ``deleted``,
    and returns the touched-months table for the summary refresh.

    Rows are matched on the fact's primary key (order_id, order_item_id), in
    whatever month they were. The delta is written once before it is used.
    """
    key = ["order_id", "order_item_id"]
    root = fact_path.rstrip("/")
    fact = spark.read.parquet(root)
    columns = [c for c in fact.columns if c != MONTH]
    typed = [F.col(c).cast(fact.schema[c].dataType).alias(c) for c in columns]
    delta.select(*typed).write.mode("overwrite").parquet(f"{root}__delta")
    new = spark.read.schema(fact.select(*columns).schema).parquet(f"{root}__delta")
    keys = new.select(*key)
    if deleted is not None:
        keys = keys.unionByName(deleted.select(*key))
    moved = fact.select(MONTH, *key).join(keys, on=key, how="left_semi")
    touched = _months(touched_months(new)) | _months(moved)
    old = fact.where(F.col(MONTH).isin(sorted(touched))).select(*columns)
    merged = old.join(keys, on=key, how="left_anti").unionByName(new)
    # the new month partitions are staged first: overwriting a partition while reading it is unsafe
    merged.write.mode("overwrite").parquet(f"{root}__staged")
    staged = spark.read.schema(merged.schema).parquet(f"{root}__staged")
    write_fact_by_month(staged, root, only_present_months=True)
    _drop_months(spark, root, touched - _months(with_month(staged)))
    return spark.createDataFrame([(m,) for m in sorted(touched)], f"{MONTH} int")
