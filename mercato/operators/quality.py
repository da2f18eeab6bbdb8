"""Data-quality checks.

Each check is one aggregate pass per table returning a small DataFrame of
counters (one row per check), so the checks of a table share a scan and only
a handful of rows ever reach the driver. ``assert_quality`` is the gate that
stops a run before summaries are built from bad facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FOREIGN_KEYS, PRIMARY_KEYS
from .relational import orphans


def _rows(df: DataFrame, specs: Sequence[tuple[str, str]], label: str = "check") -> DataFrame:
    """Turn the one-row aggregate ``df`` into rows ``(label, value)`` via ``stack``."""
    args = ", ".join(f"'{name}', CAST(`{col}` AS BIGINT)" for name, col in specs)
    return df.selectExpr(f"stack({len(specs)}, {args}) AS ({label}, value)")


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def quality_checks(fact: DataFrame, customers: DataFrame, products: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Seven post-load checks -> ``(check, value, passed)``.

    Row counts must be positive; null ids and negative prices must be zero.
    """
    f = fact.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("order_id").isNull()).alias("null_order"),
        F.count_if(F.col("product_id").isNull()).alias("null_product"),
        F.count_if(F.col("price") < 0).alias("neg_price"),
    )
    # one branch for each table: the fact's four counters come from a single stack
    checks = _union([
        _rows(f, [("fact_order_items rows", "n"), ("null order_id", "null_order"), ("null product_id", "null_product"),
                  ("negative price", "neg_price")]),
        _rows(customers.agg(F.count("*").alias("n")), [("dim_customers rows", "n")]),
        _rows(products.agg(F.count("*").alias("n")), [("dim_products rows", "n")]),
        _rows(dim_date.agg(F.count("*").alias("n")), [("dim_date rows", "n")]),
    ])
    counts_rows = F.col("check").endswith(" rows")
    return checks.withColumn("passed", F.when(counts_rows, F.col("value") > 0).otherwise(F.col("value") == 0))


class QualityError(ValueError):
    pass


def assert_quality(checks: DataFrame) -> None:
    """Raise listing every failed check (the checks frame has one row per check)."""
    failed = checks.filter(~F.col("passed")).collect()
    if failed:
        raise QualityError("Quality checks failed:\n" + "\n".join(f"FAILED: {r['check']} = {r['value']}" for r in failed))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row, one ``<name>_rows`` column per table."""
    parts = [df.agg(F.count("*").alias(f"{name}_rows")) for name, df in tables.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(f"{name}_rows").alias(f"{name}_rows") for name in tables])


def pk_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: keys seen more than once and the rows beyond the first (K3)."""
    frames = []
    for name, df in tables.items():
        keys = PRIMARY_KEYS[name]
        per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
        frames.append(per_key.agg(
            F.count_if(F.col("n") > 1).cast("bigint").alias("duplicate_keys"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("excess_rows"),
        ).select(F.lit(name).alias("table_name"), "duplicate_keys", "excess_rows"))
    return _union(frames)


def fk_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Foreign-key violations of the facts (non-NULL keys without a dimension row).

    Each fact is read once: its key columns become (column, key) rows, counted
    before the shuffle, so that only distinct keys meet the dimensions' keys.
    """
    specs = [s for s in FOREIGN_KEYS if s[0] in tables and s[2] in tables]
    used, known = [], []
    for fact in dict.fromkeys(s[0] for s in specs):
        cols = [col for f, col, _, _ in specs if f == fact]
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("key")) for c in cols]))
        used.append(tables[fact].select(pairs.alias("p")).select(F.lit(fact).alias("fact_table"), "p.column_name", "p.key")
                    .groupBy("fact_table", "column_name", "key").agg(F.count("*").alias("n")))
    for dim, key in dict.fromkeys((s[2], s[3]) for s in specs):
        cols = sorted({col for _, col, d, k in specs if (d, k) == (dim, key)})
        known.append(tables[dim].select(F.explode(F.array(*map(F.lit, cols))).alias("column_name"), F.col(key).cast("string").alias("key")))
    missing = _union(used).where("key IS NOT NULL").join(_union(known).distinct(), ["column_name", "key"], "left_anti")
    every = tables[specs[0][0]].sparkSession.createDataFrame([(f, c) for f, c, _, _ in specs], "fact_table string, column_name string")
    counted = missing.groupBy("fact_table", "column_name").agg(F.sum("n").alias("n"))
    return every.join(counted, ["fact_table", "column_name"], "left").select(
        "fact_table", "column_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("orphans"))


def duplicate_key_examples(df: DataFrame, table: str, most: int = 3) -> list[tuple]:
    """A few keys of ``table`` that occur more than once, for a message."""
    keys = PRIMARY_KEYS[table]
    return [tuple(r[k] for k in keys) for r in df.groupBy(*keys).count().where("count > 1").orderBy(*keys).limit(most).collect()]


def orphan_key_examples(tables: Mapping[str, DataFrame], fact: str, column: str, most: int = 3) -> list:
    """A few non-NULL values of a fact's foreign key that its dimension lacks, for a message."""
    dim, key = next((d, k) for f, c, d, k in FOREIGN_KEYS if (f, c) == (fact, column))
    known = tables[dim].select(F.col(key).alias(column))
    lost = tables[fact].select(column).where(F.col(column).isNotNull()).join(known, column, "left_anti")
    return [r[0] for r in lost.distinct().orderBy(column).limit(most).collect()]


def broken_primary_keys(tables: Mapping[str, DataFrame]) -> list[str]:
    """A message for each table whose primary key is not unique (K3): its rows and a few values."""
    found = []
    for r in pk_checks({t: df for t, df in tables.items() if t in PRIMARY_KEYS}).where("excess_rows > 0").collect():
        name = r["table_name"]
        found.append(f"primary key {name}({', '.join(PRIMARY_KEYS[name])}): {r['duplicate_keys']} keys occur more than once, "
                     f"{r['excess_rows']} rows too many, such as {duplicate_key_examples(tables[name], name)}")
    return found


def broken_foreign_keys(tables: Mapping[str, DataFrame]) -> list[str]:
    """A message for each foreign key with values that its dimension lacks (C16): its rows and a few values."""
    if not any(f in tables and d in tables for f, _, d, _ in FOREIGN_KEYS):
        return []
    return [f"foreign key {r['fact_table']}.{r['column_name']}: {r['orphans']} rows without their dimension row, "
            f"such as {orphan_key_examples(tables, r['fact_table'], r['column_name'])}"
            for r in fk_checks(tables).where("orphans > 0").collect()]


def assert_keys(tables: Mapping[str, DataFrame], orphans: str = "fail") -> dict[str, list[str]]:
    """Raises naming each broken key; with ``orphans="report"`` foreign keys are only returned."""
    if orphans not in ("fail", "report"):
        raise ValueError(f"orphans must be fail or report, not {orphans!r}")
    broken, lost = broken_primary_keys(tables), broken_foreign_keys(tables)
    if broken or (lost and orphans == "fail"):
        raise QualityError("Key checks failed:\n" + "\n".join(broken + lost))
    return {"orphans": lost}


def orphan_checks(orders: DataFrame, items: DataFrame, customers: DataFrame, products: DataFrame,
                  sellers: DataFrame) -> DataFrame:
    """Reference-key checks: child rows without a parent; NULL keys count as orphans."""
    specs = [
        ("order_items_order_id", items, orders, "order_id"),
        ("orders_customer_id", orders, customers, "customer_id"),
        ("order_items_product_id", items, products, "product_id"),
        ("order_items_seller_id", items, sellers, "seller_id"),
    ]
    return _union([
        orphans(child.select(key), parent, key).agg(F.count("*").cast("bigint").alias("orphans"))
        .select(F.lit(name).alias("check"), "orphans")
        for name, child, parent, key in specs
    ])


def null_cell_count(df: DataFrame) -> F.Column:
    """Aggregate expression: NULL cells over all columns of ``df``."""
    per_row = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in df.columns])
    return F.coalesce(F.sum(per_row), F.lit(0)).cast("bigint")


def null_cells(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: NULL cells over all columns, in one pass."""
    return _union([df.agg(null_cell_count(df).alias("null_cells")).select(F.lit(n).alias("table_name"), "null_cells")
                   for n, df in tables.items()])


def duplicate_counts(specs: Sequence[tuple[str, DataFrame, Sequence[str] | None]]) -> DataFrame:
    """Per (table, basis): rows beyond the first per key, or per whole row when keys is None.

    Counted as ``sum(n - 1)`` over ``groupBy(key)``: NULL keys form one group,
    as in a dataframe library's ``duplicated()``.
    """
    frames = []
    for name, df, keys in specs:
        cols = list(keys) if keys else df.columns
        per_key = df.groupBy(*cols).agg(F.count("*").alias("n"))
        frames.append(per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("excess_rows"))
                      .select(F.lit(name).alias("table_name"),
                              F.lit(",".join(keys) if keys else "*").alias("basis"), "excess_rows"))
    return _union(frames)


def violation_counts(items: DataFrame) -> DataFrame:
    """Negative price and freight counts."""
    return items.agg(F.count_if(F.col("price") < 0).cast("bigint").alias("invalid_price_count"),
                     F.count_if(F.col("freight_value") < 0).cast("bigint").alias("invalid_freight_count"))


def time_bounds(orders: DataFrame, ts: str = "order_purchase_timestamp") -> DataFrame:
    """Rows, first and last purchase time in one job."""
    return orders.agg(F.count("*").alias("orders"), F.count(ts).alias("timestamped_orders"),
                      F.min(ts).alias("first_purchase"), F.max(ts).alias("last_purchase"))
