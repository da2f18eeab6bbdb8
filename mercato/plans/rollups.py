"""Daily, monthly and whole-run roll-ups of the batch KPIs.

Inputs are the per-batch tables, whose size is the number of non-empty
5-minute windows; only ``batch_inventory_details`` is item-sized and it is
reduced by (day, product, seller) before anything else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import LOW_STOCK, OUT_OF_STOCK, money, ratio

INVENTORY_KPIS = ["daily_low_stock_order_items", "daily_out_of_stock_order_items",
                  "daily_low_stock_items", "daily_out_of_stock_items"]


def daily_summary(batch_summary: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """Per day of the window start: sums of the batch KPIs, batches, AOV and stock counters.

    Without ``details`` the four stock counters are zero so the schema stays fixed.
    """
    d = batch_summary.groupBy(F.to_date("window_start").alias("date")).agg(
        F.sum("total_orders").cast("bigint").alias("daily_orders"),
        F.sum("sales_revenue").cast("decimal(22,2)").alias("daily_sales_revenue"),
        F.sum("shipping_revenue").cast("decimal(22,2)").alias("daily_shipping_revenue"),
        F.sum("total_paid_amount").cast("decimal(22,2)").alias("daily_total_paid"),
        F.count("batch_id").cast("bigint").alias("processed_batches"),
    ).withColumn("daily_average_order_value", ratio(F.col("daily_sales_revenue"), F.col("daily_orders"), 2, 18))
    if details is None:
        return d.select("*", *[F.lit(0).cast("bigint").alias(c) for c in INVENTORY_KPIS])
    st = F.col("stock_status")
    per_pair = details.groupBy(F.to_date("window_start").alias("date"), "product_id", "seller_id").agg(
        F.count("*").alias("n"), F.max("stock_status").alias("stock_status"))
    inv = per_pair.groupBy("date").agg(
        F.sum(F.when(st == LOW_STOCK, F.col("n")).otherwise(0)).alias("daily_low_stock_order_items"),
        F.sum(F.when(st == OUT_OF_STOCK, F.col("n")).otherwise(0)).alias("daily_out_of_stock_order_items"),
        F.count_if(st == LOW_STOCK).alias("daily_low_stock_items"),
        F.count_if(st == OUT_OF_STOCK).alias("daily_out_of_stock_items"),
    )
    out = d.join(inv, on="date", how="left")
    return out.select(*d.columns, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in INVENTORY_KPIS])


def complete_months(monthly: DataFrame, col: str = "month_date") -> DataFrame:
    """Every month between the first and the last present, left-joined to ``monthly``.

    The spine is generated from one (min, max) row, so its size is the number
    of months spanned, not the data size.
    """
    spine = monthly.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias(col))
    return spine.join(monthly, on=col, how="left")


def monthly_summary(daily: DataFrame) -> DataFrame:
    """Per calendar month, every month between the first and last present (gaps zero-filled).

    AOV is NULL for a month without orders.
    """
    m = daily.groupBy(F.trunc("date", "month").alias("month_date")).agg(
        F.sum("daily_orders").alias("monthly_orders"),
        F.sum("daily_sales_revenue").alias("monthly_sales_revenue"),
        F.sum("daily_shipping_revenue").alias("monthly_shipping_revenue"),
        F.sum("daily_total_paid").alias("monthly_total_paid"),
        F.count_distinct("date").alias("processed_days"),
    )
    out = complete_months(m)
    money_cols = ["monthly_sales_revenue", "monthly_shipping_revenue", "monthly_total_paid"]
    return out.select(
        "month_date",
        F.date_format("month_date", "yyyy-MM").alias("month"),
        F.coalesce("monthly_orders", F.lit(0)).cast("bigint").alias("monthly_orders"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("decimal(22,2)").alias(c) for c in money_cols],
        F.coalesce("processed_days", F.lit(0)).cast("bigint").alias("processed_days"),
        ratio(F.col("monthly_sales_revenue"), F.col("monthly_orders"), 2, 18).alias("monthly_average_order_value"),
    )


def run_summary(batch_summary: DataFrame) -> DataFrame:
    """Whole run in one row: batches, orders, revenue, paid, passed / needs review, overall AOV."""
    s = batch_summary.agg(
        F.count("*").cast("bigint").alias("total_batches"),
        F.coalesce(F.sum("total_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
        money(F.coalesce(F.sum("sales_revenue"), F.lit(0)), 22, 2).alias("total_revenue"),
        money(F.coalesce(F.sum("total_paid_amount"), F.lit(0)), 22, 2).alias("total_paid"),
        F.count_if(F.col("batch_quality_status") == "Passed").cast("bigint").alias("passed_batches"),
        F.count_if(F.col("batch_quality_status") == "Needs Review").cast("bigint").alias("needs_review_batches"),
    )
    return s.withColumn("average_order_value",
                        F.coalesce(ratio(F.col("total_revenue"), F.col("total_orders"), 2, 18),
                                   F.lit(0).cast("decimal(18,2)")))


def recent_batches(batch_summary: DataFrame, n: int = 10) -> DataFrame:
    """Monitoring view: the last ``n`` batches."""
    return (batch_summary.orderBy(F.col("batch_id").desc()).limit(n)
            .select("batch_id", "window_start", "window_end", "total_orders", "batch_quality_status"))
