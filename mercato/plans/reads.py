"""Read layer: one function per endpoint of the serving API.

Row limits here are the feature (first-N listings, top-k reports). Each one
orders by a total key first, so the N rows are the same on every run, and
Spark plans it as a distributed ``TakeOrderedAndProject``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fill_text, mean, money, percentage, ratio



def list_sales(fact: DataFrame, n: int = 100) -> DataFrame:
    return (fact.orderBy("order_id", "order_item_id").limit(n)
            .select("order_id", "customer_id", "product_id", "seller_id", "order_status", "price",
                    "freight_value", "total_amount", "order_purchase_date_key"))


def list_products(products: DataFrame, n: int = 100) -> DataFrame:
    return (products.orderBy("product_id").limit(n)
            .select("product_id", "product_category_name", "product_category_name_english",
                    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"))


def monthly_sales(monthly: DataFrame) -> DataFrame:
    return monthly.select("year", "month", "month_name", "total_orders", "total_items_sold",
                          "total_revenue", "avg_order_value").orderBy("year", "month")


def top_products(inventory: DataFrame, n: int = 20) -> DataFrame:
    return (inventory.orderBy(F.col("total_revenue").desc_nulls_last(), "product_id").limit(n)
            .select("product_id", "product_category_name_english", "total_units_sold", "total_orders",
                    "total_revenue", "avg_price", "stock_status"))


def daily_sales(daily: DataFrame) -> DataFrame:
    return daily.select("full_date", "total_orders", "total_items_sold", "total_revenue",
                        "avg_order_value").orderBy("full_date")


def _per_key(fact: DataFrame, key: str) -> DataFrame:
    """Fact reduced to one row per key before the dimension join (map-side combined)."""
    return fact.groupBy(key).agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count("*").alias("total_items"),
        F.sum("total_amount").alias("revenue"),
    )


def top_sellers(fact: DataFrame, sellers: DataFrame, n: int = 20) -> DataFrame:
    """Seller totals (the seller dimension is unique by id, so aggregating first is exact)."""
    s = sellers.select("seller_id", "seller_city", "seller_state")
    out = _per_key(fact, "seller_id").join(s, on="seller_id", how="inner").select(
        "seller_id", "seller_city", "seller_state", "total_orders", "total_items",
        money("revenue").alias("total_revenue"))
    return out.orderBy(F.col("total_revenue").desc_nulls_last(), "seller_id").limit(n)


def sales_by_state(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """State totals. An order has one customer, so distinct orders per customer add up per state."""
    c = customers.select("customer_id", "customer_state")
    out = _per_key(fact, "customer_id").join(c, on="customer_id", how="inner").groupBy("customer_state").agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_items").alias("total_items"),
        money(F.sum("revenue")).alias("total_revenue"),
    )
    return out.orderBy(F.col("total_revenue").desc_nulls_last(), "customer_state")


def payments_breakdown(payment_methods: DataFrame, weighted: bool = False) -> DataFrame:
    """Payment summary regrouped by a computed label.

    Default: unweighted mean of the per-type means, and per-type distinct
    order counts summed, as the serving API does. ``weighted=True`` weights
    the means by transactions instead.
    """
    label = F.when(F.col("payment_type") == F.lit("not_defined"), F.lit("unknown")).otherwise(F.col("payment_type"))
    g = payment_methods.groupBy(label.alias("payment_type"))
    if weighted:
        w = F.col("total_transactions").cast("decimal(20,0)")
        avg_inst = ratio(F.sum(F.col("avg_installments") * w), F.sum(w), 2, 12)
        avg_val = ratio(F.sum(F.col("avg_payment_value") * w), F.sum(w), 2, 12)
    else:
        avg_inst = mean("avg_installments", 2, 12)
        avg_val = mean("avg_payment_value", 2, 12)
    out = g.agg(
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("total_orders").alias("total_orders"),
        money(F.sum("total_revenue")).alias("total_revenue"),
        avg_inst.alias("avg_installments"),
        avg_val.alias("avg_payment_value"),
    )
    return out.orderBy(F.col("total_revenue").desc_nulls_last(), "payment_type")


def installment_distribution(payments: DataFrame) -> DataFrame:
    out = payments.groupBy("payment_installments").agg(
        F.count("*").alias("total_transactions"),
        money(F.sum("payment_value")).alias("total_revenue"),
        mean("payment_value", 2, 12).alias("avg_value"),
    )
    return out.orderBy("payment_installments")


def monthly_reviews(reviews_monthly: DataFrame) -> DataFrame:
    return reviews_monthly.select("year", "month", "total_reviews", "avg_score", "score_5", "score_4",
                                  "score_3", "score_2", "score_1").orderBy("year", "month")


def score_distribution(reviews: DataFrame) -> DataFrame:
    """Count per score and its share of all reviews.

    The share's denominator is a window over the *aggregated* rows (one per
    distinct score), so the single window partition holds a handful of rows.
    """
    per_score = reviews.groupBy("review_score").agg(F.count("*").alias("total"))
    whole = F.sum("total").over(Window.partitionBy())
    return per_score.select("review_score", "total", percentage(F.col("total"), whole).alias("percentage")) \
        .orderBy(F.col("review_score").desc_nulls_last())


def recent_comments(reviews: DataFrame, n: int = 100) -> DataFrame:
    return (reviews.orderBy(F.col("review_creation_date").desc_nulls_last(), "review_id").limit(n)
            .select("review_id", "order_id", "review_score",
                    fill_text("review_comment_title").alias("review_comment_title"),
                    fill_text("review_comment_message").alias("review_comment_message"),
                    "review_creation_date"))
