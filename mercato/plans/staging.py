"""Staging cleaners: raw all-text tables -> typed, trimmed, deduplicated tables.

Two families, because the warehouse is fed by two staging paths that differ:

* the *text* path (default): every raw column is text; blanks become NULL
  after trimming, values are cast with ``try_cast``, rows missing required
  values are dropped and one row per key is kept;
* the *typed* path (``*_pg``): the loader kept the source values as they were
  (an empty field is missing, nothing is trimmed), and the cleaning runs as
  in-place fixes: first row per order, then drop rows without a purchase time,
  category translation with two seed rows and ``Uncategorized`` defaults.

All functions are DataFrame -> DataFrame; nothing runs until a sink writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    blank_to_null, clean_text, date_parts, normalise_payment_type, to_decimal, to_int, to_timestamp,
)
from ..operators.dedup import keep_first, latest_per_key
from ..operators.relational import lookup_left, with_seed_rows


def require_raw(df: DataFrame, cols) -> DataFrame:
    """``IS NOT NULL`` on raw text (B2): blank strings pass (they turn into NULL later)."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


def require_clean(df: DataFrame, cols) -> DataFrame:
    """``IS NOT NULL`` after cleaning (B3): blank strings fail."""
    return df.dropna(how="any", subset=list(cols))


def fix_negative(df: DataFrame, *cols: str) -> DataFrame:
    """``SET c = ABS(c) WHERE c < 0`` for each column."""
    return df.withColumns({c: F.abs(c) for c in cols})


def add_total_amount(df: DataFrame) -> DataFrame:
    """``total_amount = price + freight_value`` as DECIMAL(15,2)."""
    total = F.round((F.col("price") + F.col("freight_value")).cast("decimal(15,2)"), 2)
    return df.withColumn("total_amount", total.cast("decimal(15,2)"))  # round() widens the precision by one


def translate_category(products: DataFrame, translation: DataFrame, fallback: str | None = "unknown") -> DataFrame:
    """English category by a left lookup on a translation unique by category."""
    return lookup_left(products, translation, "product_category_name", "product_category_name_english", fallback)




# --------------------------------------------------------------------------- text path

def clean_translation(raw: DataFrame) -> DataFrame:
    df = require_raw(raw, ["product_category_name", "product_category_name_english"])
    df = df.select(clean_text("product_category_name").alias("product_category_name"),
                   clean_text("product_category_name_english").alias("product_category_name_english"))
    return keep_first(df, ["product_category_name"])


def clean_customers(raw: DataFrame) -> DataFrame:
    cols = ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]
    df = require_raw(raw, ["customer_id"]).select(*[clean_text(c).alias(c) for c in cols])
    return keep_first(df, ["customer_id"])


def clean_sellers(raw: DataFrame) -> DataFrame:
    cols = ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]
    df = require_raw(raw, ["seller_id"]).select(*[clean_text(c).alias(c) for c in cols])
    return keep_first(df, ["seller_id"])


ORDER_TS = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date"]


def typed_orders(raw: DataFrame) -> DataFrame:
    """Trim/blank->NULL the ids, parse the five timestamps, add purchase date parts."""
    df = raw.select(
        *[clean_text(c).alias(c) for c in ["order_id", "customer_id", "order_status"]],
        *[to_timestamp(c).alias(c) for c in ORDER_TS],
    )
    return df.select("*", *[v.alias(k) for k, v in date_parts("order_purchase_timestamp").items()])


def clean_orders(raw: DataFrame) -> DataFrame:
    """Drop orders missing id, customer, status or purchase time; keep the latest purchase per id."""
    df = require_clean(typed_orders(raw), ["order_id", "customer_id", "order_status", "order_purchase_timestamp"])
    return latest_per_key(df, ["order_id"], ["order_purchase_timestamp"])


PRODUCT_INT = ["product_name_lenght", "product_description_lenght", "product_photos_qty"]
PRODUCT_DEC = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]


def clean_products(raw: DataFrame, translation: DataFrame, fallback: str = "unknown") -> DataFrame:
    """Typed products + English category (left lookup on the cleaned translation, ``fallback`` on a miss)."""
    df = raw.select(
        clean_text("product_id").alias("product_id"),
        clean_text("product_category_name").alias("product_category_name"),
        *[to_int(c).alias(c) for c in PRODUCT_INT],
        *[to_decimal(c, 15, 4).alias(c) for c in PRODUCT_DEC],
    )
    df = translate_category(df, translation, fallback)
    df = df.filter(F.col("product_id").isNotNull())
    df = df.select("product_id", "product_category_name", *PRODUCT_INT, *PRODUCT_DEC, "product_category_name_english")
    return keep_first(df, ["product_id"])


def typed_order_items(raw: DataFrame) -> DataFrame:
    """Typed items before any fix (negative prices still negative)."""
    return raw.select(
        clean_text("order_id").alias("order_id"),
        to_int("order_item_id").alias("order_item_id"),
        clean_text("product_id").alias("product_id"),
        clean_text("seller_id").alias("seller_id"),
        to_timestamp("shipping_limit_date").alias("shipping_limit_date"),
        to_decimal("price").alias("price"),
        to_decimal("freight_value").alias("freight_value"),
    )


def clean_order_items(raw: DataFrame) -> DataFrame:
    """ABS on money, drop incomplete rows, ``total_amount = price + freight``, one row per (order, item)."""
    df = fix_negative(typed_order_items(raw), "price", "freight_value")
    df = require_clean(df, ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
                             "price", "freight_value"])
    return keep_first(add_total_amount(df), ["order_id", "order_item_id"])


def clean_payments(raw: DataFrame, not_defined_as: str = "unknown") -> DataFrame:
    df = require_raw(raw, ["order_id", "payment_sequential", "payment_installments", "payment_value"])
    df = df.select(
        clean_text("order_id").alias("order_id"),
        to_int("payment_sequential").alias("payment_sequential"),
        normalise_payment_type("payment_type", not_defined_as).alias("payment_type"),
        to_int("payment_installments").alias("payment_installments"),
        to_decimal("payment_value").alias("payment_value"),
    )
    return keep_first(df, ["order_id", "payment_sequential"])


def typed_reviews(raw: DataFrame) -> DataFrame:
    """Reviews typed and filtered on the raw required columns, *not yet* deduplicated."""
    df = require_raw(raw, ["review_id", "order_id", "review_score", "review_creation_date"])
    return df.select(
        clean_text("review_id").alias("review_id"),
        clean_text("order_id").alias("order_id"),
        to_int("review_score").alias("review_score"),
        clean_text("review_comment_title").alias("review_comment_title"),
        clean_text("review_comment_message").alias("review_comment_message"),
        to_timestamp("review_creation_date").alias("review_creation_date"),
        to_timestamp("review_answer_timestamp").alias("review_answer_timestamp"),
    )


def clean_reviews(raw: DataFrame) -> DataFrame:
    """Latest copy per review id (creation time, then answer time, descending)."""
    return latest_per_key(typed_reviews(raw), ["review_id"], ["review_creation_date", "review_answer_timestamp"])


def clean_geolocation(raw: DataFrame) -> DataFrame:
    cols = ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"]
    df = require_raw(raw, cols).select(
        clean_text("geolocation_zip_code_prefix").alias("geolocation_zip_code_prefix"),
        to_decimal("geolocation_lat", 10, 7).alias("geolocation_lat"),
        to_decimal("geolocation_lng", 10, 7).alias("geolocation_lng"),
        clean_text("geolocation_city").alias("geolocation_city"),
        clean_text("geolocation_state").alias("geolocation_state"),
    )
    return df.distinct()


# --------------------------------------------------------------------------- typed path

def clean_orders_pg(raw: DataFrame) -> DataFrame:
    """First row per order id (total order of all columns), *then* drop rows without a purchase time.

    Dedup first: when the winning copy has no purchase time, the order disappears.
    """
    df = raw.select(
        *[blank_to_null(c).alias(c) for c in ["order_id", "customer_id", "order_status"]],
        *[blank_to_null(c).try_cast("timestamp_ntz").alias(c) for c in ORDER_TS],
    )
    df = keep_first(df, ["order_id"])
    return df.filter(F.col("order_purchase_timestamp").isNotNull())


# Translation rows the typed path adds before translating.
SEED_TRANSLATIONS = (
    ("pc_gamer", "Gaming PC"),
    ("portateis_cozinha_e_preparadores_de_alimentos", "Kitchen Appliances"),
)


def category_lookup(translation_raw: DataFrame) -> DataFrame:
    """Typed-path translation table: source rows + seed rows whose key is new, one row per category."""
    tr = translation_raw.select(
        blank_to_null("product_category_name").alias("product_category_name"),
        blank_to_null("product_category_name_english").alias("product_category_name_english"),
    )
    seeds = tr.sparkSession.createDataFrame(list(SEED_TRANSLATIONS), tr.schema)
    return keep_first(with_seed_rows(tr, seeds, "product_category_name"), ["product_category_name"])


def clean_products_pg(raw: DataFrame, translation_raw: DataFrame) -> DataFrame:
    """Typed products, ``*_lenght`` copied to ``*_length``, English category with defaults."""
    df = raw.select(
        blank_to_null("product_id").alias("product_id"),
        blank_to_null("product_category_name").alias("product_category_name"),
        *[blank_to_null(c).try_cast("int").alias(c.replace("lenght", "length")) for c in PRODUCT_INT],
        *[blank_to_null(c).try_cast("decimal(15,4)").alias(c) for c in PRODUCT_DEC],
    )
    df = translate_category(df, category_lookup(translation_raw), fallback=None)
    return df.withColumns({
        "product_category_name_english": F.coalesce("product_category_name_english", F.lit("Uncategorized")),
        "product_category_name": F.coalesce("product_category_name", F.lit("uncategorized")),
    }).select("product_id", "product_category_name", "product_category_name_english",
              "product_name_length", "product_description_length", "product_photos_qty", *PRODUCT_DEC)
