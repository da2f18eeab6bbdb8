"""Join-shaped operators (B10, B13, C12, C13, C16, K3) and dense numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent. NULL keys are orphans (they never match)."""
    parent_key = parent_key or child_key
    p = parent.select(F.col(parent_key).alias("__pk"))
    return child.join(p, F.col(child_key) == F.col("__pk"), "left_anti")


def fk_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Foreign-key violations: like ``orphans`` but NULL keys are allowed (a nullable FK)."""
    return orphans(child.filter(F.col(child_key).isNotNull()), parent, child_key, parent_key)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (primary-key check)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def with_seed_rows(df: DataFrame, seeds: DataFrame, key: str) -> DataFrame:
    """Append literal rows whose key is not present yet (INSERT ... skip conflicts)."""
    fresh = seeds.join(df.select(key), on=key, how="left_anti")
    return df.unionByName(fresh.select(*df.columns))


def lookup_left(df: DataFrame, lookup: DataFrame, on: str, value: str, default: str | None = None) -> DataFrame:
    """Left join on a lookup that must already be unique by ``on``; optional default for misses."""
    out = df.join(lookup.select(on, value), on=on, how="left")
    if default is not None:
        out = out.withColumn(value, F.coalesce(F.col(value), F.lit(default)))
    return out


def dense_index(df: DataFrame, order: Sequence[str], alias: str = "idx") -> DataFrame:
    """Number the rows 1..n in ``order`` (ascending, NULLs first) without a one-partition sort.

    A global ``row_number()`` puts every row in one task. Instead: range
    partition by ``order`` (balanced, sampled boundaries) and sort inside each
    partition; ``monotonically_increasing_id`` then carries the partition
    index (upper bits) and the row's position in its partition (lower 33
    bits). Rows per partition are counted (one row per partition), turned
    into offsets, and added back with a broadcast join of that table, whose
    size is the number of partitions. ``order`` must be unique per row.
    """
    sort = [F.col(c).asc_nulls_first() for c in order]
    local = (df.repartitionByRange(*sort).sortWithinPartitions(*sort)
             .withColumn("__mid", F.monotonically_increasing_id())
             .withColumn("__pid", F.shiftright("__mid", 33))
             .withColumn("__pos", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))))
    counts = local.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn(
        "__off", F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0))).select("__pid", "__off")
    return (local.join(F.broadcast(offsets), on="__pid")
            .withColumn(alias, (F.col("__off") + F.col("__pos") + 1).cast("bigint"))
            .drop("__pid", "__pos", "__mid", "__off"))
