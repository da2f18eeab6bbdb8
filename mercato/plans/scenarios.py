"""Whole runs with a history, over the warehouse's own tables: what the registered queries of versions, changes and ids return.

Each builds its history from the facts by rules on their columns (which rows come
first, which come later, move, or go), runs the library's writers over it in a
fresh shared folder, and returns what a reader then sees.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.allocator import allocate
from ..operators.quality import QualityError, assert_keys
from ..sources.ledger import Ledger
from ..sources.publishing import Run, history, resolve
from ..sources.rejects import load_with_rejects
from ..sources.scratch import scratch_path
from . import retraction as RT
from .aggregates import agg_sales_daily, agg_sales_monthly
from .build import WarehouseBuild
from .warehouse import item_flow, payment_flow


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a fresh shared folder, for a run that reads it many times."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def published_version(spark: SparkSession, b: WarehouseBuild) -> DataFrame:
    """A warehouse published twice (orders of status F, then all), and a third run that its gate stops: totals by version."""
    root = scratch_path(spark, "versions")

    def run(fact: DataFrame) -> None:
        writer = Run(spark, root)
        fact = writer.write("fact_order_items", fact)
        writer.write("agg_sales_daily", agg_sales_daily(fact, b.dim_date))
        writer.publish(lambda t: assert_keys({"fact_order_items": t["fact_order_items"]}))

    fact = _stored(spark, b.fact_order_items, "fact")  # each of the runs reads it
    run(fact.where("order_status = 'F'"))
    run(fact)
    try:
        run(fact.unionByName(fact))  # every key twice
        raise AssertionError("a fact with repeated keys was published")
    except QualityError:
        pass
    current = resolve(spark, root).number
    rows = []
    for number in history(spark, root):
        version = resolve(spark, root, number)
        items = version.read(spark, "fact_order_items").agg(F.count("*").alias("fact_rows"), F.sum("total_amount").cast("decimal(28,2)").alias("fact_revenue"))
        days = version.read(spark, "agg_sales_daily").agg(F.count("*").alias("days"), F.sum("total_revenue").cast("decimal(28,2)").alias("daily_revenue"))
        rows.append(items.crossJoin(days).select(F.lit(number).alias("version"), F.lit(number == current).alias("is_current"), "*"))  # 1 x 1 row
    return reduce(DataFrame.unionByName, rows)


# ------------------------------------------------------------------ changes
ITEM_KEY, PAYMENT_KEY, REVIEW_KEY = ["order_id", "order_item_id"], ["order_id", "payment_sequential"], ["review_id"]


def _history(spark: SparkSession, name: str, specs, fact: DataFrame, key: list[str], first, moved: DataFrame, later, gone) -> str:
    """Loads the rows of ``first``, then in one change inserts those of ``later``, puts ``moved`` in place of theirs and deletes ``gone``."""
    root = scratch_path(spark, name)
    start = fact.where(first)
    RT.refresh(spark, root, specs, RT.signed(start, 1), 1)
    new = fact.where(later).unionByName(moved.select(*fact.columns))
    change = RT.changes(start, key, new, fact.where(gone).select(*key))
    RT.refresh(spark, root, specs, change, 2)
    RT.refresh(spark, root, specs, change, 2)  # a repeated change is not applied again
    return root


def _items_history(spark: SparkSession, b: WarehouseBuild, specs) -> str:
    """Second items move to the least product and day, third and later ones are inserted, first items of orders of status P go."""
    fact = _stored(spark, b.fact_order_items, "fact")
    least = fact.agg(F.min("product_id").alias("_p"), F.min("order_purchase_date_key").alias("_d"))
    second = fact.where("order_item_id = 2").crossJoin(F.broadcast(least))  # one row
    moved = second.withColumns({"product_id": F.col("_p"), "order_purchase_date_key": F.col("_d")})
    return _history(spark, "items", specs, fact, ITEM_KEY, F.col("order_item_id") <= 2, moved, F.col("order_item_id") > 2,
                    (F.col("order_item_id") == 1) & F.col("order_status").eqNullSafe("P"))


def refresh_inventory(spark: SparkSession, b: WarehouseBuild, hash_fn: str = "md5") -> DataFrame:
    return RT.refreshed_inventory(spark, _items_history(spark, b, [RT.INVENTORY]), b.dim_products, hash_fn)


def refresh_daily_sales(spark: SparkSession, b: WarehouseBuild) -> DataFrame:
    return RT.refreshed_daily(spark, _items_history(spark, b, [RT.DAILY]), b.dim_date)


def refresh_monthly_sales(spark: SparkSession, b: WarehouseBuild) -> DataFrame:
    """An order whose items lie in two months counts in each, as in the daily summary."""
    return agg_sales_monthly(refresh_daily_sales(spark, b))


def refresh_payments(spark: SparkSession, b: WarehouseBuild) -> DataFrame:
    """Payments of one instalment are inserted later, urgent ones become low, those of nine instalments or more go."""
    fact = _stored(spark, b.fact_order_payments, "fact")
    later = F.col("payment_installments").eqNullSafe(1)
    gone = F.coalesce(F.col("payment_installments") >= 9, F.lit(False))
    moved = fact.where((F.col("payment_type") == "urgent") & ~gone & ~later).withColumn("payment_type", F.lit("low"))
    root = _history(spark, "payments", [RT.PAYMENTS], fact, PAYMENT_KEY, ~later, moved, later, gone)
    return RT.refreshed_payments(spark, root)


def refresh_reviews(spark: SparkSession, b: WarehouseBuild) -> DataFrame:
    """Reviews with five stars move to the first day, those of three are inserted later, those of one star go."""
    fact = _stored(spark, b.fact_order_reviews, "fact")
    least = fact.agg(F.min("order_purchase_date_key").alias("_d"))
    moved = fact.where("review_score = 5").crossJoin(F.broadcast(least)).withColumn("order_purchase_date_key", F.col("_d"))  # one row
    root = _history(spark, "reviews", [RT.REVIEWS], fact, REVIEW_KEY, ~F.col("review_score").eqNullSafe(3), moved, F.col("review_score") == 3, F.col("review_score") == 1)
    return RT.refreshed_reviews(spark, root, b.dim_date)


# ------------------------------------------------------------------ ids
def lasting_ids(spark: SparkSession, b: WarehouseBuild) -> DataFrame:
    """Inventory ids of (product, seller) after two loads: pairs of first items, then all pairs."""
    root = scratch_path(spark, "ids")
    pairs = ["product_id", "seller_id"]
    fact = b.fact_order_items
    allocate(spark, root, fact.where("order_item_id = 1").select(*pairs), "inventory_id")
    return allocate(spark, root, fact.select(*pairs), "inventory_id")


# ------------------------------------------------------------------ rejects
def csv_rejects(spark: SparkSession, b: WarehouseBuild, files: int = 4) -> DataFrame:
    """The payments as CSV files in which urgent ones lost their last field, those of eight instalments have one too many and low ones
    of three an open quote: what the load accepts and rejects, by reason."""
    root = scratch_path(spark, "payments_csv")
    raw = b.raw["order_payments_raw"]
    fields = [F.coalesce(F.col(c), F.lit("")) for c in raw.columns]
    whole = F.concat_ws(",", *fields)
    line = (F.when(F.col("payment_type") == "urgent", F.concat_ws(",", *fields[:-1]))
            .when(F.col("payment_installments") == "8", F.concat(whole, F.lit(",more")))
            .when((F.col("payment_type") == "low") & (F.col("payment_installments") == "3"), F.concat(whole, F.lit('"'))).otherwise(whole))
    lines = raw.select(F.pmod(F.xxhash64("order_id"), F.lit(files)).alias("p"), F.lit(1).alias("o"), line.alias("value"))
    heads = spark.range(files).select(F.col("id").alias("p"), F.lit(0).alias("o"), F.lit(",".join(raw.columns)).alias("value"))
    (lines.unionByName(heads).repartition("p").sortWithinPartitions("p", "o").drop("o").write.partitionBy("p").text(f"{root}/csv"))
    got = load_with_rejects(spark, f"{root}/csv/p=*", "order_payments", f"{root}/loaded", max_share=None)
    one = got.rows.agg(F.count("*").alias("rows"), F.count_distinct("order_id").alias("orders")).select(F.lit("accepted").alias("outcome"), "*")
    bad = got.rejects.groupBy(F.col("reason").alias("outcome")).agg(
        F.count("*").alias("rows"), F.count_distinct(F.split("raw", ",")[0]).alias("orders"))
    return one.unionByName(bad)


# ------------------------------------------------------------------ run ledger
def run_ledger(spark: SparkSession, b: WarehouseBuild) -> DataFrame:
    """Control totals of staged items and payments and of their facts, taken while these are written; orders of status P are
    not loaded, so that their rows are kept out. The totals balance."""
    from .pipeline import MADE_OF, TOTALS
    root = scratch_path(spark, "ledger")
    ledger = Ledger()
    for name, df in {"order_items": b.order_items, "payments": b.payments}.items():
        ledger.write(df, f"{root}/{name}", name, TOTALS[name])
    staged = {n: spark.read.parquet(f"{root}/{n}") for n in ("order_items", "payments")}
    orders = b.orders.where("NOT order_status <=> 'P'")
    for name, flow in {"fact_order_items": item_flow(staged["order_items"], orders),
                       "fact_order_payments": payment_flow(staged["payments"], orders)}.items():
        rows, rules, finish = flow
        ledger.write(rows, f"{root}/{name}", name, TOTALS[name], rules, finish)
    ledger.balance(MADE_OF)
    return ledger.frame(spark)
