"""Lasting ids: a stored map from keys to dense numbers, extended by new keys only.

The map is a published table (``sources.publishing``): rows that are there are
never rewritten, so an id stays with its key however much data comes later. New
keys are found by an anti-join with the map and numbered from the next free
number in the order of the key, each range partition by itself with the counts
of the partitions before it (``dense_index``): no global sort in one task. Only
the new rows are written, as a further folder of the table; publishing is one
rename, so of two loads that allocate at once the second fails and may repeat.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.publishing import Run, resolve
from .relational import dense_index


def _same(columns: Sequence[str], prefix: str):
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in columns])


def allocate(spark: SparkSession, root: str, keys: DataFrame, id_column: str = "id", first: int = 1) -> DataFrame:
    """Gives every distinct row of ``keys`` an id, and returns the whole map (``keys``' columns and ``id_column``).

    Keys that the map under ``root`` holds keep theirs; the others follow on,
    without gaps. NULLs in a key are equal to each other. Calling it again with
    the same keys changes nothing and publishes nothing.
    """
    columns = keys.columns
    run = Run(spark, root)
    new = keys.distinct()
    used = int(run.base.notes["ids"]) if run.base else 0
    if run.base:
        known = run.base.read(spark, "ids").select(*[F.col(c).alias(f"_known_{c}") for c in columns])
        new = new.join(known, _same(columns, "_known_"), "left_anti")
    new = run.write("new", new)  # numbered from files, so that positions and counts see the same rows
    n = new.count()
    if run.base and not n:
        run.discard("new")
        return run.base.read(spark, "ids")
    numbered = dense_index(new, columns, id_column).withColumn(id_column, F.col(id_column) + F.lit(first + used - 1))
    added = run.write("added", numbered.select(*columns, F.col(id_column).cast("bigint").alias(id_column)))
    run.discard("new")
    old = run.base.tables["ids"].paths if run.base else ()
    paths = run.tables.pop("added").paths
    ids = run.adopt("ids", [*old, *paths], added.schema)
    run.publish(notes={"ids": used + n})
    return ids


def allocated(spark: SparkSession, root: str) -> DataFrame:
    """The map as it stands."""
    version = resolve(spark, root)
    if version is None:
        raise FileNotFoundError(f"no ids under {root}")
    return version.read(spark, "ids")


def with_ids(rows: DataFrame, ids: DataFrame, columns: Sequence[str], id_column: str = "id") -> DataFrame:
    """``rows`` with the ids of their keys."""
    known = ids.select(*[F.col(c).alias(f"_known_{c}") for c in columns], id_column)
    return rows.join(known, _same(columns, "_known_"), "left").drop(*[f"_known_{c}" for c in columns])
