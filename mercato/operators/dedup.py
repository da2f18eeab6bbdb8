"""Keep-one-row-per-key and duplicate counting.

``keep_first`` is ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ...) = 1``.
Catalyst turns the filter into a *partial* ``WindowGroupLimit`` that runs
before the shuffle, so every map task forwards at most one row per key: a key
holding a third of all rows (e.g. the NULL key left by blank ids) costs one
row per map partition in the exchange, not a third of the data in one task.

The winner is made deterministic: after the requested order come all
remaining columns ascending, NULLs first, so any two engines that apply the
same rule pick the same row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def _order_names(order: Sequence) -> set[str]:
    names = set()
    for o in order:
        if isinstance(o, str):
            names.add(o.split()[0])
        elif isinstance(o, tuple):
            names.add(o[0])
    return names


def _sort_col(o) -> Column:
    """``"c"`` -> c ASC NULLS FIRST; ``("c", "desc")`` -> c DESC NULLS LAST; Column as given."""
    if isinstance(o, Column):
        return o
    if isinstance(o, tuple):
        name, direction = o
        return F.col(name).desc_nulls_last() if direction == "desc" else F.col(name).asc_nulls_first()
    return F.col(o).asc_nulls_first()


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence = ()) -> DataFrame:
    """One row per ``keys``: the first by ``order``, then by every other column."""
    keys = list(keys)
    taken = set(keys) | _order_names(order)
    tiebreak = [F.col(c).asc_nulls_first() for c in df.columns if c not in taken]
    sort = [_sort_col(o) for o in order] + tiebreak
    if not sort:  # every column is a key: rows of a group are identical
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*sort)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Newest row per key: ``by`` columns descending (NULLs last), then the tie-break rule."""
    return keep_first(df, keys, [(c, "desc") for c in by])


def excess_rows(df: DataFrame, keys: Sequence[str] | None = None) -> Column:
    """Aggregate expression: rows beyond the first per key (or per whole row).

    ``struct`` makes NULL keys compare equal, as a dataframe library's
    ``duplicated()`` does.
    """
    cols = list(keys) if keys else df.columns
    return (F.count(F.lit(1)) - F.count_distinct(F.struct(*cols))).cast("bigint")


def excess_rows_by(df: DataFrame, by: Sequence[str], keys: Sequence[str] | None = None,
                   alias: str = "excess_rows") -> DataFrame:
    """Per-group excess rows without a distinct aggregate: count per (group, key), then sum(n - 1).

    Both steps are partial (map-side combined) aggregations, so a hot group is
    pre-reduced before any shuffle.
    """
    cols = list(keys) if keys else [c for c in df.columns if c not in by]
    per_key = df.groupBy(*by, *cols).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.groupBy(*by).agg(F.sum(F.col("__n") - 1).cast("bigint").alias(alias))
