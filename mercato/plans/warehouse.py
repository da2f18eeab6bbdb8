"""Star schema: dimensions and facts.

Facts carry the order's customer, status and smart purchase-date key, so the
read layer never joins back to orders. Facts are big-big joins (items x
orders): sort-merge on ``order_id`` with AQE's skew handling; nothing here is
broadcast by hand.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_key, day_name, fill_text, is_weekend, iso_dow, month_name, normalise_payment_type
from ..operators.dedup import keep_first, latest_per_key
from ..schemas import conform


# --------------------------------------------------------------------------- dimensions

def _one_per(df: DataFrame, key: str, unique: bool) -> DataFrame:
    """One row per key (a plain DISTINCT could keep two); ``unique``: the input, such as cleaned staging, has that already."""
    return df if unique else keep_first(df, [key])


def dim_customers(customers: DataFrame, unique: bool = False) -> DataFrame:
    return conform(_one_per(customers, "customer_id", unique), "dim_customers")


def dim_sellers(sellers: DataFrame, unique: bool = False) -> DataFrame:
    return conform(_one_per(sellers, "seller_id", unique), "dim_sellers")


def dim_products(products: DataFrame, unique: bool = False) -> DataFrame:
    """Products with the misspelt ``*_lenght`` columns renamed; sizes as DECIMAL(10,2)."""
    renamed = products.withColumnsRenamed({
        "product_name_lenght": "product_name_length",
        "product_description_lenght": "product_description_length",
    })
    return conform(_one_per(renamed, "product_id", unique), "dim_products")


def _date_rows(d: Column) -> list[Column]:
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"),
        month_name(d).alias("month_name"),
        F.dayofmonth(d).cast("int").alias("day"),
        iso_dow(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
        is_weekend(d).alias("is_weekend"),
    ]


def dim_date_calendar(spark: SparkSession, start, end) -> DataFrame:
    """Fixed calendar ``start``..``end`` inclusive (dates or ISO strings), one row per day.

    The days come from ``spark.range`` so they are generated in parallel; the
    row count is the calendar length, independent of the data size.
    """
    start = dt.date.fromisoformat(str(start))
    end = dt.date.fromisoformat(str(end))
    n = (end - start).days + 1
    days = spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    return days.select(*_date_rows(F.col("d")))


def dim_date_spanning(orders: DataFrame, ts: str = "order_purchase_timestamp") -> DataFrame:
    """Calendar of whole years covering every purchase date (bounds derived from the data)."""
    b = orders.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    days = b.select(F.explode(F.sequence(
        F.trunc(F.to_date("lo"), "year"),
        F.date_add(F.add_months(F.trunc(F.to_date("hi"), "year"), 12), -1),
    )).alias("d"))
    return days.select(*_date_rows(F.col("d")))


def dim_date_observed(orders: DataFrame, ts: str = "order_purchase_timestamp") -> DataFrame:
    """One row per distinct purchase date (partial distinct: a hot day costs one row per task)."""
    days = orders.filter(F.col(ts).isNotNull()).select(F.to_date(ts).alias("d")).distinct()
    return days.select(*_date_rows(F.col("d")))


# --------------------------------------------------------------------------- facts

def _order_side(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id", "customer_id", "order_status",
        date_key("order_purchase_timestamp").alias("order_purchase_date_key"),
    )


def fact_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    f = items.join(_order_side(orders), on="order_id", how="inner")
    return conform(f, "fact_order_items")


def fact_order_payments(payments: DataFrame, orders: DataFrame, min_value: float | None = 0,
                        not_defined_as: str = "other") -> DataFrame:
    """Payments of known orders; ``payment_value > min_value`` (``None`` keeps zero payments)."""
    p = payments
    if min_value is not None:
        p = p.filter(F.col("payment_value") > F.lit(min_value))
    p = p.withColumn("payment_type", normalise_payment_type("payment_type", not_defined_as))
    f = p.join(_order_side(orders).select("order_id", "order_purchase_date_key"), on="order_id", how="inner")
    return conform(f, "fact_order_payments")


def fact_order_reviews(reviews: DataFrame, orders: DataFrame, dedup: str = "after_join") -> DataFrame:
    """Reviews of known orders, newest copy per review id, NULL comments as ''.

    ``after_join`` (default) drops orphan copies first, so an older copy of a
    review survives when its newest copy is an orphan; ``before_join`` keeps
    the newest copy and loses the review in that case.
    """
    order_keys = _order_side(orders).select("order_id", "order_purchase_date_key")
    by = ["review_creation_date", "review_answer_timestamp"]
    if dedup == "before_join":
        f = latest_per_key(reviews, ["review_id"], by).join(order_keys, on="order_id", how="inner")
    elif dedup == "after_join":
        f = latest_per_key(reviews.join(order_keys, on="order_id", how="inner"), ["review_id"], by)
    else:
        raise ValueError(f"dedup must be after_join or before_join, not {dedup!r}")
    f = f.withColumns({"review_comment_title": fill_text("review_comment_title"),
                       "review_comment_message": fill_text("review_comment_message")})
    return conform(f, "fact_order_reviews")


# Facts with what they leave out: every row of staging beside its order, the rules that keep rows out, and the fact of the rest.
# The rules stand after the join, so that a ledger counts them while the fact is written.
NO_ORDER = "no order"


def _beside_orders(rows: DataFrame, orders: DataFrame, *columns: str) -> tuple[DataFrame, Column]:
    """``rows`` left-joined with their orders, and the condition of those without one."""
    side = _order_side(orders).select("order_id", *columns).withColumn("_known", F.lit(True))
    return rows.join(side, on="order_id", how="left"), F.col("_known").isNull()


def item_flow(items: DataFrame, orders: DataFrame) -> tuple[DataFrame, dict[str, Column], Callable[[DataFrame], DataFrame]]:
    """``fact_order_items`` as (rows, rules, finish) for ``Ledger.write``."""
    rows, unknown = _beside_orders(items, orders, "customer_id", "order_status", "order_purchase_date_key")
    return rows, {NO_ORDER: unknown}, lambda df: conform(df, "fact_order_items")


def payment_flow(payments: DataFrame, orders: DataFrame, min_value: float | None = 0, not_defined_as: str = "other",
                 ) -> tuple[DataFrame, dict[str, Column], Callable[[DataFrame], DataFrame]]:
    """``fact_order_payments`` as (rows, rules, finish) for ``Ledger.write``."""
    rows, unknown = _beside_orders(payments, orders, "order_purchase_date_key")
    rules = {NO_ORDER: unknown}
    if min_value is not None:
        rules = {"value not above the least": ~F.coalesce(F.col("payment_value") > F.lit(min_value), F.lit(False)), **rules}
    return rows, rules, lambda df: conform(df.withColumn("payment_type", normalise_payment_type("payment_type", not_defined_as)),
                                           "fact_order_payments")
