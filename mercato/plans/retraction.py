"""Summaries kept up to date from signed changes: counted state with retractions.

A change of a fact is a set of signed rows: +1 for a row that is there afterwards,
-1 for one that was there before. A summary's state has two tables:

* ``sums``: one row a group: how many rows, and the sums of its measures. Signed
  rows add to them, so that a row that goes is subtracted exactly.
* ``members``: (group, member, n), how many of the group's rows belong to a
  member (an order). A distinct count changes only where n leaves or reaches 0,
  so it falls again when an order's last row goes, without a recount.

Both are stored in parts by a hash (of the group, of the member) as a published
version (``sources.publishing``). A refresh reads and rewrites the parts that its
change touches; the others are named again by the new version. Changes are added
up per group, and per (group, member), before any shuffle, so a hot group costs
one row a task. A killed refresh leaves the old version; a repeated one would
count twice, so each refresh carries the number of its change, and the state
knows which it holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money, ratio
from ..sources.publishing import Run, Version, resolve
from .aggregates import SCORES, inventory_from, reviews_from

SIGN, PART, ROWS = "_sign", "_part", "_rows"


@dataclass(frozen=True)
class Summary:
    """What a summary keeps of its fact: group columns, measures to add up (SQL), and the member whose distinct number it needs."""

    name: str
    groups: Sequence[str]
    measures: Mapping[str, str]
    member: str | None = None
    where: str | None = None
    distinct: str = "total_orders"
    parts: int = 16

    @property
    def sums(self) -> str:
        return f"{self.name}_sums"

    @property
    def members(self) -> str:
        return f"{self.name}_members"


def _wide(c: str, scale: int = 2) -> str:
    return f"CAST({c} AS DECIMAL(28,{scale}))"


def _counted(c: str) -> str:
    return f"IF({c} IS NULL, 0, 1)"


INVENTORY = Summary("inventory", ["product_id"], {
    "revenue": _wide("total_amount"), "revenue_n": _counted("total_amount"), "price_sum": _wide("price"), "price_n": _counted("price")}, "order_id")
PAYMENTS = Summary("payments", ["payment_type"], {
    "revenue": _wide("payment_value"), "installments_sum": _wide("payment_installments", 0),
    "installments_n": _counted("payment_installments")}, "order_id", "payment_value > 0")
REVIEWS = Summary("reviews", ["order_purchase_date_key"], {
    "score_sum": _wide("review_score", 0), "score_n": _counted("review_score"),
    **{f"score_{s}": f"IF(review_score = {s}, 1, 0)" for s in SCORES}})
DAILY = Summary("daily", ["order_purchase_date_key"], {"revenue": _wide("total_amount"), "revenue_n": _counted("total_amount")}, "order_id")


# ------------------------------------------------------------------ changes of a fact
def signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.withColumn(SIGN, F.lit(sign))


def changes(fact: DataFrame, key: Sequence[str], new: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """Signed rows of a change: ``new`` rows (inserted, or in place of those with their key) and the keys of ``deleted``.

    A key in both is replaced, not lost. NULLs in a key are equal to each other.
    """
    keys = new.select(*key)
    if deleted is not None:
        keys = keys.unionByName(deleted.select(*key))
    keys = keys.distinct().withColumnsRenamed({k: f"_{k}" for k in key})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    return signed(fact.join(keys, same, "left_semi"), -1).unionByName(signed(new.select(*fact.columns), 1))


def apply_changes(fact: DataFrame, key: Sequence[str], change: DataFrame) -> DataFrame:
    """The fact after signed changes, by key (what ``changes`` removes goes, what it adds comes)."""
    gone = change.where(F.col(SIGN) < 0).select(*[F.col(k).alias(f"_{k}") for k in key]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    return fact.join(gone, same, "left_anti").unionByName(change.where(F.col(SIGN) > 0).drop(SIGN))


# ------------------------------------------------------------------ state
def _part(columns: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int")


def _added(rows: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sums with their column types kept."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    return rows.groupBy(*by).agg(*[F.sum(c).cast(types[c]).alias(c) for c in columns])


def _measured(spec: Summary, change: DataFrame) -> DataFrame:
    """Net change of each group's row count and sums, taken per (group, member) where the summary has a member."""
    rows = change if spec.where is None else change.where(spec.where)
    kinds = {m: "bigint" for m in spec.measures}
    kinds |= {f.name: f.dataType.simpleString() for f in rows.select(*[F.expr(c).alias(m) for m, c in spec.measures.items()]).schema.fields
              if f.dataType.typeName() == "decimal"}
    by = [*spec.groups, *([F.col(spec.member).alias("_member")] if spec.member else [])]
    return rows.groupBy(*by).agg(
        F.sum(F.col(SIGN).cast("bigint")).alias(ROWS),
        *[F.coalesce(F.sum(F.expr(c) * F.col(SIGN)), F.lit(0)).cast(kinds[m]).alias(m) for m, c in spec.measures.items()])


def _parts_of(rows: DataFrame) -> list[int]:
    return sorted(r[0] for r in rows.select(PART).distinct().collect())  # at most the number of parts


def _stored(base: Version | None, spark: SparkSession, name: str, parts: Sequence[int], like: DataFrame) -> DataFrame:
    """The rows of these parts of a stored table."""
    if base is None or name not in base.tables:
        return like.where(F.lit(False))
    ends = {f"{PART}={p}" for p in parts}
    table = base.tables[name]
    paths = tuple(p for p in table.paths if p.rsplit("/", 1)[1] in ends)
    return type(table)(paths, table.schema).read(spark)


def refresh(spark: SparkSession, root: str, specs: Sequence[Summary], change: DataFrame, number: int) -> Version:
    """Applies change ``number`` (of one fact) to the states of ``specs`` under ``root`` and publishes them together.

    Changes are numbered from 1; one that the state holds already is not applied
    again, and one that would leave a gap is an error.
    """
    run = Run(spark, root)
    held = int(run.base.notes["change"]) if run.base else 0
    if number <= held:
        return run.base
    if number != held + 1:
        raise ValueError(f"the state holds change {held}; change {number} would leave a gap")
    if len(specs) > 1:
        change = run.write("_change", change)
    for spec in specs:
        by, measured = list(spec.groups), _measured(spec, change)
        if spec.member:
            # one pass over the change: its (group, member) rows give both the members and, added up, the sums
            delta = run.write(f"{spec.members}__delta", measured.withColumn(PART, _part(["_member"], spec.parts)))
            net = delta.where(f"{ROWS} <> 0").select(*by, "_member", PART, F.col(ROWS).alias("n"), F.lit(0).cast("bigint").alias("before"))
            touched = _parts_of(net)
            if run.base and spec.members in run.base.tables:
                old = _stored(run.base, spark, spec.members, touched, net.select(*by, "_member", "n"))
                both = old.withColumns({"before": F.col("n"), PART: _part(["_member"], spec.parts)}).unionByName(net)
                net = run.write(f"{spec.members}__net", _added(both, [*by, "_member", PART], ["n", "before"]))
            bad = net.where("n < 0").limit(1).collect()
            if bad:
                raise ValueError(f"{spec.name}: a change takes away rows that are not there: {bad[0].asDict()}")
            run.write_parts(spec.members, net.where("n > 0").drop("before"), PART, touched)
            columns = [ROWS, *spec.measures]
            risen = net.select(*by, *[F.lit(0).cast(delta.schema[c].dataType).alias(c) for c in columns],
                               ((F.col("n") > 0).cast("bigint") - (F.col("before") > 0).cast("bigint")).alias(spec.distinct))
            sums = delta.select(*by, *columns, F.lit(0).cast("bigint").alias(spec.distinct)).unionByName(risen)
            measured = _added(sums, by, [*columns, spec.distinct])
        delta = run.write(f"{spec.sums}__delta", measured.withColumn(PART, _part(by, spec.parts)))
        touched = _parts_of(delta)
        old = _stored(run.base, spark, spec.sums, touched, delta.drop(PART)).withColumn(PART, _part(by, spec.parts))
        columns = [c for c in delta.columns if c not in (*by, PART)]
        merged = _added(old.unionByName(delta), [*by, PART], columns)
        run.write_parts(spec.sums, merged.where(F.col(ROWS) > 0), PART, touched)
        run.discard(f"{spec.members}__delta", f"{spec.members}__net", f"{spec.sums}__delta")
    run.discard("_change")
    if run.base:
        run.keep(*(t for t in run.base.tables if t not in run.tables))
    return run.publish(notes={"change": number})


def state(spark: SparkSession, root: str, spec: Summary) -> DataFrame:
    """The current sums of a summary."""
    version = resolve(spark, root)
    if version is None:
        raise FileNotFoundError(f"no state under {root}")
    return version.read(spark, spec.sums)


def _or_null(c: str, n: str) -> Column:
    """A sum over no non-NULL value is NULL."""
    return F.when(F.col(n) > 0, F.col(c))


# ------------------------------------------------------------------ the summaries
def refreshed_inventory(spark: SparkSession, root: str, products: DataFrame, hash_fn: str = "crc32") -> DataFrame:
    """D3 from its state."""
    sums = state(spark, root, INVENTORY).withColumns({"revenue": _or_null("revenue", "revenue_n"), "price_sum": _or_null("price_sum", "price_n")})
    return inventory_from(sums.withColumnRenamed(ROWS, "total_units_sold"), products, hash_fn)


def refreshed_payments(spark: SparkSession, root: str) -> DataFrame:
    """D4 from its state."""
    from ..schemas import conform
    out = state(spark, root, PAYMENTS).select(
        "payment_type", F.col(ROWS).alias("total_transactions"), "total_orders", money("revenue").alias("total_revenue"),
        ratio(F.col("installments_sum"), F.col("installments_n"), 2, 5).alias("avg_installments"),
        ratio(F.col("revenue"), F.col(ROWS), 2, 10).alias("avg_payment_value"))
    return conform(out, "agg_payment_methods")


def refreshed_reviews(spark: SparkSession, root: str, dim_date: DataFrame) -> DataFrame:
    """D5 from its state."""
    return reviews_from(state(spark, root, REVIEWS).withColumnRenamed(ROWS, "n"), dim_date)


def refreshed_daily(spark: SparkSession, root: str, dim_date: DataFrame) -> DataFrame:
    """D1 from its state (``agg_sales_monthly`` rolls it up to D2)."""
    from ..schemas import conform
    days = dim_date.select(F.col("date_key").alias("order_purchase_date_key"), "full_date")
    revenue = _or_null("revenue", "revenue_n")
    out = state(spark, root, DAILY).join(days, "order_purchase_date_key").select(
        "full_date", "total_orders", F.col(ROWS).alias("total_items_sold"), money(revenue).alias("total_revenue"),
        ratio(revenue, F.col("total_orders")).alias("avg_order_value"))
    return conform(out, "agg_sales_daily")
