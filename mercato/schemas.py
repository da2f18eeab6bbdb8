"""Table contracts: declared column types, keys and foreign keys.

``conform(df, table)`` selects the declared columns *by name* in declared
order and casts them, so a write never depends on the column order of the
producing plan (the positional-insert trap).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, L, B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
TS, D = T.TimestampNTZType(), T.DateType()


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_COLUMNS: dict[str, list[str]] = {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"],
    "products": ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
                 "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
                    "freight_value"],
    "order_payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "order_reviews": ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
                      "review_creation_date", "review_answer_timestamp"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
                    "geolocation_state"],
    "product_category_name_translation": ["product_category_name", "product_category_name_english"],
}


def raw_schema(table: str) -> T.StructType:
    """All-text schema of a raw table: text keeps leading zeros of zip prefixes."""
    return _st(*[(c, S) for c in RAW_COLUMNS[table]])


SCHEMAS: dict[str, T.StructType] = {
    "dim_customers": _st(("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
                         ("customer_city", S), ("customer_state", S)),
    "dim_products": _st(("product_id", S), ("product_category_name", S), ("product_category_name_english", S),
                        ("product_name_length", I), ("product_description_length", I), ("product_photos_qty", I),
                        ("product_weight_g", dec(10, 2)), ("product_length_cm", dec(10, 2)),
                        ("product_height_cm", dec(10, 2)), ("product_width_cm", dec(10, 2))),
    "dim_sellers": _st(("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S)),
    "dim_date": _st(("date_key", I), ("full_date", D), ("year", I), ("quarter", I), ("month", I),
                    ("month_name", S), ("day", I), ("day_of_week", I), ("day_name", S), ("is_weekend", B)),
    "fact_order_items": _st(("order_id", S), ("order_item_id", I), ("customer_id", S), ("product_id", S),
                            ("seller_id", S), ("order_purchase_date_key", I), ("order_status", S),
                            ("shipping_limit_date", TS), ("price", dec(10, 2)), ("freight_value", dec(10, 2)),
                            ("total_amount", dec(10, 2))),
    "fact_order_payments": _st(("order_id", S), ("payment_sequential", I), ("order_purchase_date_key", I),
                               ("payment_type", S), ("payment_installments", I), ("payment_value", dec(10, 2))),
    "fact_order_reviews": _st(("review_id", S), ("order_id", S), ("order_purchase_date_key", I),
                              ("review_score", I), ("review_comment_title", S), ("review_comment_message", S),
                              ("review_creation_date", TS), ("review_answer_timestamp", TS)),
    "agg_sales_daily": _st(("full_date", D), ("total_orders", L), ("total_items_sold", L),
                           ("total_revenue", dec(28, 2)), ("avg_order_value", dec(12, 2))),
    "agg_sales_monthly": _st(("year", I), ("month", I), ("month_name", S), ("total_orders", L),
                             ("total_items_sold", L), ("total_revenue", dec(28, 2)), ("avg_order_value", dec(12, 2))),
    "agg_inventory": _st(("product_id", S), ("product_category_name_english", S), ("total_units_sold", L),
                         ("total_orders", L), ("total_revenue", dec(28, 2)), ("avg_price", dec(10, 2)),
                         ("stock_qty", I), ("reorder_level", I), ("stock_status", S)),
    "agg_payment_methods": _st(("payment_type", S), ("total_transactions", L), ("total_orders", L),
                               ("total_revenue", dec(28, 2)), ("avg_installments", dec(5, 2)),
                               ("avg_payment_value", dec(10, 2))),
    "agg_reviews_monthly": _st(("year", I), ("month", I), ("total_reviews", L), ("avg_score", dec(3, 2)),
                               ("score_5", L), ("score_4", L), ("score_3", L), ("score_2", L), ("score_1", L)),
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "dim_customers": ["customer_id"],
    "dim_products": ["product_id"],
    "dim_sellers": ["seller_id"],
    "dim_date": ["date_key"],
    "fact_order_items": ["order_id", "order_item_id"],
    "fact_order_payments": ["order_id", "payment_sequential"],
    "fact_order_reviews": ["review_id"],
    "agg_sales_daily": ["full_date"],
    "agg_sales_monthly": ["year", "month"],
    "agg_inventory": ["product_id"],
    "agg_payment_methods": ["payment_type"],
    "agg_reviews_monthly": ["year", "month"],
}

# (fact, column, dimension, dimension key)
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("fact_order_items", "customer_id", "dim_customers", "customer_id"),
    ("fact_order_items", "product_id", "dim_products", "product_id"),
    ("fact_order_items", "seller_id", "dim_sellers", "seller_id"),
    ("fact_order_items", "order_purchase_date_key", "dim_date", "date_key"),
    ("fact_order_payments", "order_purchase_date_key", "dim_date", "date_key"),
    ("fact_order_reviews", "order_purchase_date_key", "dim_date", "date_key"),
]


def conform(df: DataFrame, table: str) -> DataFrame:
    """Declared columns, declared order, declared types (missing columns fail loudly)."""
    schema = SCHEMAS[table]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
