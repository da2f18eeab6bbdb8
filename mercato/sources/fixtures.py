"""Raw commerce tables derived from the driver's TPC-H-style parquet tables.

The warehouse code reads all-text raw tables (customers_raw, orders_raw, ...).
Offline, those tables are *derived* from the driver tables with the views
below. Each view is one portable SQL text: Spark runs it with the parquet
DataFrames bound as parameters (``{orders}`` etc.), DuckDB runs the same text
with the placeholders replaced by the plain view names. The views only
select, cast and concatenate, so Catalyst prunes columns down to the parquet
scan.

The micro-batch tables (stream_*) are derived from ``events``. Payments and
reviews are not in the driver data for the stream, so ``purchase`` events act
as payments and ``view`` events as reviews; only their per-batch row counts
enter the KPIs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

RAW_VIEWS: dict[str, str] = {
    "customers_raw": """
SELECT CASE WHEN c_custkey % 97 = 96 THEN '  ' ELSE concat(' ', CAST(c_custkey AS STRING), ' ') END AS customer_id,
       c_name AS customer_unique_id, lpad(CAST(c_nationkey AS STRING), 5, '0') AS customer_zip_code_prefix,
       lower(c_mktsegment) AS customer_city, n_name AS customer_state
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL
SELECT CAST(c_custkey AS STRING), upper(c_name), '99999', 'duplicate', 'ZZ' FROM {customer} WHERE c_custkey % 50 = 0""",
    "sellers_raw": """
SELECT CAST(s_suppkey AS STRING) AS seller_id, lpad(CAST(s_nationkey AS STRING), 5, '0') AS seller_zip_code_prefix,
       lower(s_name) AS seller_city, n_name AS seller_state
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "products_raw": """
SELECT CAST(p_partkey AS STRING) AS product_id, CASE WHEN p_partkey % 23 = 0 THEN '' ELSE lower(p_type) END AS product_category_name,
       CAST(length(p_name) AS STRING) AS product_name_lenght, CAST(p_size * 10 AS STRING) AS product_description_lenght,
       CAST(p_size % 6 AS STRING) AS product_photos_qty, CAST(CAST(p_retailprice AS DECIMAL(15,4)) AS STRING) AS product_weight_g,
       CAST(p_size AS STRING) AS product_length_cm, CAST(p_size + 1 AS STRING) AS product_height_cm, ' ' AS product_width_cm
FROM {part}""",
    "product_category_name_translation_raw": """
SELECT DISTINCT lower(p_type) AS product_category_name, concat('en_', lower(p_type)) AS product_category_name_english
FROM {part} WHERE p_type <> 'MEDIUM'""",
    "orders_raw": """
SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id, o_orderstatus AS order_status,
       CASE WHEN o_orderkey % 101 = 0 THEN '' ELSE CAST(o_orderdate AS STRING) END AS order_purchase_timestamp,
       CAST(o_orderdate AS STRING) AS order_approved_at, '' AS order_delivered_carrier_date,
       '' AS order_delivered_customer_date, CAST(o_orderdate AS STRING) AS order_estimated_delivery_date
FROM {orders}""",
    "order_items_raw": """
SELECT CAST(l_orderkey AS STRING) AS order_id, CAST(l_linenumber AS STRING) AS order_item_id,
       CAST(l_partkey AS STRING) AS product_id, CAST(l_suppkey AS STRING) AS seller_id, CAST(l_shipdate AS STRING) AS shipping_limit_date,
       CAST(CASE WHEN l_linenumber = 7 THEN -CAST(l_extendedprice AS DECIMAL(15,2)) ELSE CAST(l_extendedprice AS DECIMAL(15,2)) END AS STRING) AS price,
       CAST(CAST(round(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(15,2)) AS STRING) AS freight_value
FROM {lineitem}""",
    "order_payments_raw": """
SELECT CAST(o_orderkey AS STRING) AS order_id, '1' AS payment_sequential,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Not_Defined' ELSE lower(substr(o_orderpriority, 3)) END AS payment_type,
       CAST(1 + o_orderkey % 10 AS STRING) AS payment_installments,
       CASE WHEN o_orderkey % 37 = 0 THEN '0.00' ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) END AS payment_value
FROM {orders}""",
    "order_reviews_raw": """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS review_id, CAST(l_orderkey AS STRING) AS order_id,
       CAST(1 + CAST(l_quantity AS INT) % 5 AS STRING) AS review_score, CASE WHEN l_linestatus = 'F' THEN ' ' ELSE l_returnflag END AS review_comment_title,
       CASE WHEN l_linenumber = 3 THEN '' ELSE concat('part ', CAST(l_partkey AS STRING)) END AS review_comment_message,
       CAST(l_shipdate AS STRING) AS review_creation_date, CAST(l_shipdate + INTERVAL 1 DAY AS STRING) AS review_answer_timestamp
FROM {lineitem}""",
    "geolocation_raw": """
SELECT lpad(CAST(c_nationkey AS STRING), 5, '0') AS geolocation_zip_code_prefix, concat(CAST(c_nationkey - 12 AS STRING), '.5') AS geolocation_lat,
       concat('-', CAST(c_nationkey + 30 AS STRING), '.25') AS geolocation_lng, concat(' ', n_name) AS geolocation_city, n_name AS geolocation_state
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "stream_orders": """
SELECT event_id AS order_id, user_id AS customer_id, event_type AS order_status, ts AS order_purchase_timestamp FROM {events}""",
    "stream_order_items": """
SELECT event_id AS order_id, event_id % 211 AS product_id, event_id % 53 AS seller_id, CAST(value AS DECIMAL(15,2)) AS price,
       CAST(round(CAST(value AS DECIMAL(15,2)) * CAST(0.10 AS DECIMAL(4,2)), 2) AS DECIMAL(15,2)) AS freight_value
FROM {events} WHERE event_type <> 'error'""",
    "stream_order_payments": """
SELECT event_id AS order_id, 1 AS payment_sequential, CAST(value AS DECIMAL(15,2)) AS payment_value
FROM {events} WHERE event_type = 'purchase'""",
    "stream_order_reviews": """
SELECT event_id AS order_id, CAST(1 + event_id % 5 AS INT) AS review_score
FROM {events} WHERE event_type = 'view'""",
    # Reference-key sets the micro-batch validation checks against.
    "ref_customers": "SELECT c_custkey AS customer_id FROM {customer}",
    "ref_products": "SELECT p_partkey AS product_id FROM {part}",
    "ref_sellers": "SELECT s_suppkey AS seller_id FROM {supplier}",
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def tables_of(view: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(RAW_VIEWS[view])))


def duckdb_view_sql(view: str) -> str:
    """The view text with placeholders replaced by the DuckDB view names."""
    return _PLACEHOLDER.sub(lambda m: m.group(1), RAW_VIEWS[view]).strip()


class Fixtures:
    """Lazy access to the driver parquet tables and the derived raw tables.

    Nothing is read until a DataFrame is asked for; every DataFrame is a lazy
    plan over the parquet files so each query keeps predicate pushdown and
    column pruning down to the scan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, partitions: dict[str, int] | None = None):
        """``partitions``: for a table, over how many partitions its rows are spread (a file of one row group is one task)."""
        self.spark = spark
        self.partitions = partitions or {}
        self.sf_dir = sf_dir.rstrip("/")
        self._base: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._base:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            self._base[name] = df.repartition(self.partitions[name]) if name in self.partitions else df
        return self._base[name]

    def raw(self, view: str) -> DataFrame:
        params = {t: self.table(t) for t in tables_of(view)}
        return self.spark.sql(RAW_VIEWS[view], **params)

    __getitem__ = raw
