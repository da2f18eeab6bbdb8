"""Summary tables.

Every summary first aggregates the fact by the join key (map-side partial
aggregation, so a hot day or product is reduced inside each task), and only
then joins the dimension. The joined relation is as large as the dimension's
key range, never as large as the fact. This is exact because each dimension
is unique by its key and each order has one purchase date:
``COUNT(DISTINCT order_id)`` per day adds up to the monthly count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import mean, money, pseudo_stock, ratio, stock_status
from ..schemas import conform



def agg_sales_daily(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Per day: distinct orders, items, revenue, revenue / distinct orders (price + freight)."""
    per_key = fact.groupBy("order_purchase_date_key").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count("*").alias("total_items_sold"),
        F.sum("total_amount").alias("revenue"),
    )
    days = dim_date.select(F.col("date_key").alias("order_purchase_date_key"), "full_date")
    out = per_key.join(days, on="order_purchase_date_key", how="inner").select(
        "full_date", "total_orders", "total_items_sold",
        money("revenue").alias("total_revenue"),
        ratio(F.col("revenue"), F.col("total_orders")).alias("avg_order_value"),
    )
    return conform(out, "agg_sales_daily")


def agg_sales_monthly(daily: DataFrame) -> DataFrame:
    """Per (year, month), rolled up from the daily summary (orders never span two days)."""
    out = daily.groupBy(F.year("full_date").cast("int").alias("year"),
                        F.month("full_date").cast("int").alias("month")).agg(
        F.trim(F.min(F.date_format("full_date", "MMMM"))).alias("month_name"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_items_sold").alias("total_items_sold"),
        F.sum("total_revenue").cast("decimal(28,2)").alias("revenue"),  # a wider sum would lose digits in the ratio
    )
    out = out.select("year", "month", "month_name", "total_orders", "total_items_sold",
                     money("revenue").alias("total_revenue"),
                     ratio(F.col("revenue"), F.col("total_orders")).alias("avg_order_value"))
    return conform(out, "agg_sales_monthly")


def inventory_sums(fact: DataFrame) -> DataFrame:
    """Per product: what ``inventory_from`` needs, as counts and sums.

    Nearly every (product, order) is a group of its own, so a distinct count would
    hold two hash maps with an entry a row in each task. Instead one row of each
    pair is marked, by a sort of narrow rows, and the marks are added up; a fact
    that comes joined by order is not shuffled for it.
    """
    first = F.row_number().over(Window.partitionBy("order_id", "product_id").orderBy("order_id")) == 1
    rows = fact.select("order_id", "product_id", "price", "total_amount").withColumn("_first", first & F.col("order_id").isNotNull())
    return rows.groupBy("product_id").agg(
        F.count("*").alias("total_units_sold"),
        F.count_if("_first").alias("total_orders"),
        F.sum("total_amount").alias("revenue"),
        F.sum("price").alias("price_sum"),
        F.count("price").alias("price_n"),
    )


def inventory_from(per_product: DataFrame, products: DataFrame, hash_fn: str = "crc32",
                   fallback: str = "Uncategorized") -> DataFrame:
    """Product performance plus simulated stock, from a product's sums.

    The stock is a pure function of the product id (hash mod 500, hash mod 80
    + 20), so it is a projection; no second pass over the product table.
    """
    names = products.select("product_id", "product_category_name_english")
    qty, reorder = pseudo_stock(F.col("product_id"), hash_fn)
    out = per_product.join(names, on="product_id", how="inner").select(
        "product_id",
        F.coalesce("product_category_name_english", F.lit(fallback)).alias("product_category_name_english"),
        "total_units_sold", "total_orders",
        money("revenue").alias("total_revenue"),
        ratio(F.col("price_sum"), F.col("price_n"), 2, 10).alias("avg_price"),
        qty.alias("stock_qty"), reorder.alias("reorder_level"),
    ).withColumn("stock_status", stock_status("stock_qty", "reorder_level", null_qty_in_stock=True))
    return conform(out, "agg_inventory")


def agg_inventory(fact: DataFrame, products: DataFrame, hash_fn: str = "crc32",
                  fallback: str = "Uncategorized") -> DataFrame:
    """Product performance plus simulated stock."""
    return inventory_from(inventory_sums(fact), products, hash_fn, fallback)


def agg_payment_methods(payments: DataFrame, min_value: float = 0) -> DataFrame:
    out = payments.filter(F.col("payment_value") > F.lit(min_value)).groupBy("payment_type").agg(
        F.count("*").alias("total_transactions"),
        F.count_distinct("order_id").alias("total_orders"),
        money(F.sum("payment_value")).alias("total_revenue"),
        mean("payment_installments", 2, 5, integral=True).alias("avg_installments"),
        mean("payment_value", 2, 10).alias("avg_payment_value"),
    )
    return conform(out, "agg_payment_methods")


SCORES = (5, 4, 3, 2, 1)


def reviews_from(per_key: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Monthly review scores from the sums of each date key."""
    days = dim_date.select(F.col("date_key").alias("order_purchase_date_key"), "year", "month")
    out = per_key.join(days, on="order_purchase_date_key", how="inner").groupBy("year", "month").agg(
        F.sum("n").alias("total_reviews"),
        ratio(F.sum("score_sum"), F.sum("score_n"), 2, 3).alias("avg_score"),
        *[F.sum(f"score_{s}").alias(f"score_{s}") for s in SCORES],
    )
    return conform(out, "agg_reviews_monthly")


def agg_reviews_monthly(reviews: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_key = reviews.groupBy("order_purchase_date_key").agg(
        F.count("*").alias("n"),
        F.sum(F.col("review_score").cast("decimal(20,0)")).alias("score_sum"),
        F.count("review_score").alias("score_n"),
        *[F.count_if(F.col("review_score") == s).alias(f"score_{s}") for s in SCORES],
    )
    return reviews_from(per_key, dim_date)
