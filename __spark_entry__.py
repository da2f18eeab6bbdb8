"""

Every query builds its inputs from the driver's parquet tables through the
fixture views (``mercato.sources.fixtures``) and runs over the whole tables.
Row limits appear only where the limit is the feature (top-k reports,
first-N listings).
"""

from __future__ import annotations

import importlib.util
import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle as _oracle  # noqa: E402
from mercato.plans import reads as R  # noqa: E402
from mercato.plans import staging as S  # noqa: E402
from mercato.plans import warehouse as W  # noqa: E402
from mercato.plans import aggregates as A  # noqa: E402
from mercato.plans import microbatch as M  # noqa: E402
from mercato.plans import rollups as RU  # noqa: E402
from mercato.plans import scenarios as SC  # noqa: E402
from mercato.operators import quality as Q  # noqa: E402
from mercato.plans.build import MicroBatchBuild, WarehouseBuild  # noqa: E402
from mercato.sources.fixtures import Fixtures  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Callable[[WarehouseBuild], DataFrame]] = {}


def _q(name: str, select: str | None = None):
    """Register a query over a ``WarehouseBuild`` and (optionally) its oracle SELECT."""
    def deco(fn):
        _QUERIES[name] = fn
        if select is not None:
            _oracle.register(name, select)
        return fn
    return deco


def _build(spark: SparkSession, sf_dir: str, **kw) -> WarehouseBuild:
    return WarehouseBuild(Fixtures(spark, sf_dir), **kw)


# ------------------------------------------------------------------ staging cleaners (§2 cleaners, B, E, H)
_q("clean_translation", "SELECT * FROM clean_translation")(lambda b: b.translation)
_q("clean_customers", "SELECT * FROM clean_customers")(lambda b: b.customers)
_q("clean_sellers", "SELECT * FROM clean_sellers")(lambda b: b.sellers)
_q("clean_orders", "SELECT * FROM clean_orders")(lambda b: b.orders)
_q("clean_products", "SELECT * FROM clean_products")(lambda b: b.products)
_q("clean_order_items", "SELECT * FROM clean_order_items")(lambda b: b.order_items)
_q("clean_payments", "SELECT * FROM clean_payments")(lambda b: b.payments)
_q("clean_reviews", "SELECT * FROM clean_reviews")(lambda b: b.reviews)
_q("clean_geolocation", "SELECT * FROM clean_geolocation")(lambda b: b.geolocation)
_q("clean_orders_pg", "SELECT * FROM clean_orders_pg")(lambda b: S.clean_orders_pg(b.raw["orders_raw"]))
_q("category_lookup", "SELECT * FROM category_lookup")(
    lambda b: S.category_lookup(b.raw["product_category_name_translation_raw"]))
_q("clean_products_pg", "SELECT * FROM clean_products_pg")(
    lambda b: S.clean_products_pg(b.raw["products_raw"], b.raw["product_category_name_translation_raw"]))

# ------------------------------------------------------------------ dimensions and facts
_q("dim_customers", "SELECT * FROM dim_customers")(lambda b: b.dim_customers)
_q("dim_sellers", "SELECT * FROM dim_sellers")(lambda b: b.dim_sellers)
_q("dim_products", "SELECT * FROM dim_products")(lambda b: b.dim_products)
_q("dim_date_observed", "SELECT * FROM dim_date_observed")(lambda b: b.dim_date)
_q("dim_date_calendar", "SELECT * FROM dim_date_calendar")(lambda b: W.dim_date_spanning(b.orders))
_q("fact_order_items", "SELECT * FROM fact_order_items")(lambda b: b.fact_order_items)
_q("fact_order_payments", "SELECT * FROM fact_order_payments")(lambda b: b.fact_order_payments)
_q("fact_order_reviews", "SELECT * FROM fact_order_reviews")(lambda b: b.fact_order_reviews)
_q("fact_order_reviews_before_join",
   "SELECT r.review_id, r.order_id, CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INTEGER) AS order_purchase_date_key, "
   "r.review_score, COALESCE(r.review_comment_title, '') AS review_comment_title, "
   "COALESCE(r.review_comment_message, '') AS review_comment_message, r.review_creation_date, r.review_answer_timestamp "
   "FROM clean_reviews r JOIN clean_orders o ON r.order_id = o.order_id")(
    lambda b: W.fact_order_reviews(b.reviews_typed, b.orders, dedup="before_join"))
_q("fact_order_payments_keep_zero",
   "SELECT p.order_id, p.payment_sequential, CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INTEGER) "
   "AS order_purchase_date_key, CASE WHEN lower(p.payment_type) = 'not_defined' THEN 'other' ELSE p.payment_type END "
   "AS payment_type, p.payment_installments, CAST(p.payment_value AS DECIMAL(10,2)) AS payment_value "
   "FROM clean_payments p JOIN clean_orders o ON p.order_id = o.order_id")(
    lambda b: W.fact_order_payments(b.payments, b.orders, min_value=None))

# ------------------------------------------------------------------ summaries
_q("agg_sales_daily", "SELECT * FROM agg_sales_daily")(lambda b: b.agg_sales_daily)
_q("agg_sales_monthly", "SELECT * FROM agg_sales_monthly")(lambda b: b.agg_sales_monthly)
_q("product_inventory", "SELECT * FROM product_inventory")(
    lambda b: A.agg_inventory(b.fact_order_items, b.dim_products, hash_fn="md5"))
_q("agg_inventory_crc32", "SELECT * FROM agg_inventory_crc32")(lambda b: b.agg_inventory)
_q("agg_payment_methods", "SELECT * FROM agg_payment_methods")(lambda b: b.agg_payment_methods)
_q("agg_reviews_monthly", "SELECT * FROM agg_reviews_monthly")(lambda b: b.agg_reviews_monthly)


# ------------------------------------------------------------------ read layer
_q("list_sales", "SELECT order_id, customer_id, product_id, seller_id, order_status, price, freight_value, total_amount, "
                 "order_purchase_date_key FROM fact_order_items ORDER BY order_id, order_item_id LIMIT 100")(
    lambda b: R.list_sales(b.fact_order_items))
_q("list_products", "SELECT product_id, product_category_name, product_category_name_english, product_weight_g, "
                    "product_length_cm, product_height_cm, product_width_cm FROM dim_products ORDER BY product_id LIMIT 100")(
    lambda b: R.list_products(b.dim_products))
_q("monthly_sales", "SELECT * FROM agg_sales_monthly")(lambda b: R.monthly_sales(b.agg_sales_monthly))
_q("top_products", "SELECT product_id, product_category_name_english, total_units_sold, total_orders, total_revenue, "
                   "avg_price, stock_status FROM product_inventory ORDER BY total_revenue DESC, product_id LIMIT 20")(
    lambda b: R.top_products(A.agg_inventory(b.fact_order_items, b.dim_products, hash_fn="md5")))
_q("daily_sales", "SELECT * FROM agg_sales_daily")(lambda b: R.daily_sales(b.agg_sales_daily))
_PER_ORDER = "(SELECT {0}, order_id, COUNT(*) AS n, SUM(total_amount) AS amount FROM fact_order_items GROUP BY ALL)"
_q("top_sellers",
   "SELECT seller_id, seller_city, seller_state, orders AS total_orders, items AS total_items, revenue AS total_revenue "
   "FROM dim_sellers JOIN (SELECT seller_id, COUNT(*) AS orders, CAST(SUM(n) AS BIGINT) AS items, "
   f"CAST(SUM(amount) AS DECIMAL(28,2)) AS revenue FROM {_PER_ORDER.format('seller_id')} GROUP BY seller_id) USING (seller_id) "
   "ORDER BY revenue DESC, seller_id LIMIT 20")(
    lambda b: R.top_sellers(b.fact_order_items, b.dim_sellers))
_q("sales_by_state",
   "SELECT customer_state, COUNT(*) AS total_orders, CAST(SUM(n) AS BIGINT) AS total_items, "
   f"CAST(SUM(amount) AS DECIMAL(28,2)) AS total_revenue FROM dim_customers JOIN {_PER_ORDER.format('customer_id')} "
   "USING (customer_id) GROUP BY customer_state")(
    lambda b: R.sales_by_state(b.fact_order_items, b.dim_customers))
_RELABELLED = "(SELECT * REPLACE (IF(payment_type = 'not_defined', 'unknown', payment_type) AS payment_type) FROM agg_payment_methods)"
_PAYMENT_TOTALS = ("payment_type, CAST(SUM(total_transactions) AS BIGINT) AS total_transactions, "
                   "CAST(SUM(total_orders) AS BIGINT) AS total_orders, CAST(SUM(total_revenue) AS DECIMAL(28,2)) AS total_revenue")
_q("payments_breakdown",
   f"SELECT {_PAYMENT_TOTALS}, {_oracle.hu('SUM(avg_installments * 100)', 'COUNT(avg_installments)')} AS avg_installments, "
   f"{_oracle.hu('SUM(avg_payment_value * 100)', 'COUNT(avg_payment_value)')} AS avg_payment_value "
   f"FROM {_RELABELLED} GROUP BY payment_type")(lambda b: R.payments_breakdown(b.agg_payment_methods))
_q("payments_breakdown_weighted",
   f"SELECT {_PAYMENT_TOTALS}, "
   f"{_oracle.hu('SUM(avg_installments * 100 * total_transactions)', 'SUM(total_transactions)')} AS avg_installments, "
   f"{_oracle.hu('SUM(avg_payment_value * 100 * total_transactions)', 'SUM(total_transactions)')} AS avg_payment_value "
   f"FROM {_RELABELLED} GROUP BY payment_type")(lambda b: R.payments_breakdown(b.agg_payment_methods, weighted=True))
_q("installment_distribution",
   "SELECT payment_installments, n AS total_transactions, CAST(paid AS DECIMAL(28,2)) AS total_revenue, "
   f"{_oracle.hu(_oracle.cents('paid'), 'known')} AS avg_value FROM (SELECT payment_installments, COUNT(*) AS n, "
   "COUNT(payment_value) AS known, SUM(payment_value) AS paid FROM fact_order_payments GROUP BY ALL)")(
    lambda b: R.installment_distribution(b.fact_order_payments))
_q("monthly_reviews", "SELECT * FROM agg_reviews_monthly")(lambda b: R.monthly_reviews(b.agg_reviews_monthly))
_q("score_distribution",
   f"SELECT review_score, total, {_oracle.hu('total * 10000', 'whole', 2, 5)} AS percentage "
   "FROM (SELECT review_score, COUNT(*) AS total FROM fact_order_reviews GROUP BY ALL), "
   "(SELECT COUNT(*) AS whole FROM fact_order_reviews)")(lambda b: R.score_distribution(b.fact_order_reviews))
_q("recent_comments",
   "SELECT review_id, order_id, review_score, COALESCE(review_comment_title, '') AS review_comment_title, "
   "COALESCE(review_comment_message, '') AS review_comment_message, review_creation_date FROM fact_order_reviews "
   "ORDER BY review_creation_date DESC NULLS LAST, review_id LIMIT 100")(lambda b: R.recent_comments(b.fact_order_reviews))

# ------------------------------------------------------------------ data quality
_q("quality_checks",
   """SELECT 'fact_order_items rows' AS "check", COUNT(*) AS value, COUNT(*) > 0 AS passed FROM fact_order_items
      UNION ALL SELECT 'dim_customers rows', COUNT(*), COUNT(*) > 0 FROM dim_customers
      UNION ALL SELECT 'dim_products rows', COUNT(*), COUNT(*) > 0 FROM dim_products
      UNION ALL SELECT 'dim_date rows', COUNT(*), COUNT(*) > 0 FROM dim_date_observed
      UNION ALL SELECT 'null order_id', COUNT(*) FILTER (WHERE order_id IS NULL), COUNT(*) FILTER (WHERE order_id IS NULL) = 0
                FROM fact_order_items
      UNION ALL SELECT 'null product_id', COUNT(*) FILTER (WHERE product_id IS NULL),
                COUNT(*) FILTER (WHERE product_id IS NULL) = 0 FROM fact_order_items
      UNION ALL SELECT 'negative price', COUNT(*) FILTER (WHERE price < 0), COUNT(*) FILTER (WHERE price < 0) = 0
                FROM fact_order_items""")(
    lambda b: Q.quality_checks(b.fact_order_items, b.dim_customers, b.dim_products, b.dim_date))
_q("row_counts", "SELECT (SELECT COUNT(*) FROM agg_sales_daily) AS daily_rows, "
                 "(SELECT COUNT(*) FROM agg_sales_monthly) AS monthly_rows, "
                 "(SELECT COUNT(*) FROM product_inventory) AS inventory_rows")(
    lambda b: Q.row_counts({"daily": b.agg_sales_daily, "monthly": b.agg_sales_monthly, "inventory": b.agg_inventory}))

_PK = {"dim_customers": ("dim_customers", "customer_id"), "dim_products": ("dim_products", "product_id"),
       "dim_sellers": ("dim_sellers", "seller_id"), "dim_date": ("dim_date_observed", "date_key"),
       "fact_order_items": ("fact_order_items", "order_id, order_item_id"),
       "fact_order_payments": ("fact_order_payments", "order_id, payment_sequential"),
       "fact_order_reviews": ("fact_order_reviews", "review_id")}
_q("pk_checks", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(COUNT(*) FILTER (WHERE n > 1) AS BIGINT) AS duplicate_keys, "
    f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS excess_rows FROM (SELECT COUNT(*) AS n FROM {cte} GROUP BY {keys})"
    for t, (cte, keys) in _PK.items()))(
    lambda b: Q.pk_checks({"dim_customers": b.dim_customers, "dim_products": b.dim_products,
                           "dim_sellers": b.dim_sellers, "dim_date": b.dim_date,
                           "fact_order_items": b.fact_order_items, "fact_order_payments": b.fact_order_payments,
                           "fact_order_reviews": b.fact_order_reviews}))
_FK = [("fact_order_items", "customer_id", "dim_customers", "customer_id"),
       ("fact_order_items", "product_id", "dim_products", "product_id"),
       ("fact_order_items", "seller_id", "dim_sellers", "seller_id"),
       ("fact_order_items", "order_purchase_date_key", "dim_date_observed", "date_key"),
       ("fact_order_payments", "order_purchase_date_key", "dim_date_observed", "date_key"),
       ("fact_order_reviews", "order_purchase_date_key", "dim_date_observed", "date_key")]
_q("fk_checks", " UNION ALL ".join(
    f"SELECT '{f}' AS fact_table, '{c}' AS column_name, COUNT(*) AS orphans FROM {f} x "
    f"WHERE x.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {d} y WHERE y.{k} = x.{c})" for f, c, d, k in _FK))(
    lambda b: Q.fk_checks({"fact_order_items": b.fact_order_items, "fact_order_payments": b.fact_order_payments,
                           "fact_order_reviews": b.fact_order_reviews, "dim_customers": b.dim_customers,
                           "dim_products": b.dim_products, "dim_sellers": b.dim_sellers, "dim_date": b.dim_date}))
_NULL_TABLES = {"clean_orders": _oracle.ORDER_COLS + ["year", "month", "day", "isodow", "is_weekend"],
                "clean_order_items": _oracle.ITEM_COLS, "clean_products": _oracle.PRODUCT_COLS,
                "clean_reviews": _oracle.REVIEW_COLS}
_q("null_cells", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(COALESCE(SUM({' + '.join(f'CAST({c} IS NULL AS BIGINT)' for c in cols)}), 0) AS BIGINT) "
    f"AS null_cells FROM {t}" for t, cols in _NULL_TABLES.items()))(
    lambda b: Q.null_cells({"clean_orders": b.orders, "clean_order_items": b.order_items,
                            "clean_products": b.products, "clean_reviews": b.reviews}))
_DUPS = [("orders", "typed_orders", "order_id"), ("order_items", "typed_order_items", "order_id,order_item_id"),
         ("order_items", "typed_order_items", None), ("order_reviews", "typed_reviews", "review_id")]
_q("duplicate_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{keys or '*'}' AS basis, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS excess_rows "
    f"FROM (SELECT COUNT(*) AS n FROM {cte} GROUP BY {keys or 'ALL'})" for t, cte, keys in _DUPS).replace(
        "GROUP BY ALL)", "GROUP BY order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value)"))(
    lambda b: Q.duplicate_counts([
        ("orders", S.typed_orders(b.raw["orders_raw"]).select(*_oracle.ORDER_COLS), ["order_id"]),
        ("order_items", S.typed_order_items(b.raw["order_items_raw"]), ["order_id", "order_item_id"]),
        ("order_items", S.typed_order_items(b.raw["order_items_raw"]), None),
        ("order_reviews", S.typed_reviews(b.raw["order_reviews_raw"]), ["review_id"])]))
_q("violation_counts", "SELECT COUNT(*) FILTER (WHERE price < 0) AS invalid_price_count, "
                       "COUNT(*) FILTER (WHERE freight_value < 0) AS invalid_freight_count FROM typed_order_items")(
    lambda b: Q.violation_counts(S.typed_order_items(b.raw["order_items_raw"])))
_q("time_bounds", "SELECT COUNT(*) AS orders, COUNT(order_purchase_timestamp) AS timestamped_orders, "
                  "MIN(order_purchase_timestamp) AS first_purchase, MAX(order_purchase_timestamp) AS last_purchase "
                  "FROM typed_orders")(lambda b: Q.time_bounds(S.typed_orders(b.raw["orders_raw"])))
_q("orphan_checks",
   "SELECT 'order_items_order_id' AS \"check\", COUNT(*) AS orphans FROM stream_order_items i "
   "WHERE NOT EXISTS (SELECT 1 FROM stream_orders o WHERE o.order_id = i.order_id) "
   "UNION ALL SELECT 'orders_customer_id', COUNT(*) FROM stream_orders o "
   "WHERE NOT EXISTS (SELECT 1 FROM ref_customers r WHERE r.customer_id = o.customer_id) "
   "UNION ALL SELECT 'order_items_product_id', COUNT(*) FROM stream_order_items i "
   "WHERE NOT EXISTS (SELECT 1 FROM ref_products r WHERE r.product_id = i.product_id) "
   "UNION ALL SELECT 'order_items_seller_id', COUNT(*) FROM stream_order_items i "
   "WHERE NOT EXISTS (SELECT 1 FROM ref_sellers r WHERE r.seller_id = i.seller_id)")(
    lambda b: Q.orphan_checks(b.raw["stream_orders"], b.raw["stream_order_items"], b.raw["ref_customers"],
                              b.raw["ref_products"], b.raw["ref_sellers"]))


# ------------------------------------------------------------------ micro-batch formulation
def _mb(b: WarehouseBuild) -> MicroBatchBuild:
    return MicroBatchBuild(b.raw)


def _stream_kpis(orders: DataFrame) -> DataFrame:
    """The watermarked window KPIs of the stream consumer, run over the whole static table."""
    from mercato.streaming.microbatch_stream import anchor_micros_of, window_kpis
    return window_kpis(orders, anchor_micros_of(orders))


_q("window_counts", "SELECT window_start, window_end, COUNT(*) AS orders FROM mb_orders_w GROUP BY 1, 2")(
    lambda b: M.window_counts(_mb(b).orders_windowed))
_q("batch_ids", "SELECT DISTINCT batch_id, window_start, window_end FROM mb_orders")(
    lambda b: _mb(b).batches["orders"].select("batch_id", "window_start", "window_end").distinct())
_q("window_slice", "SELECT o.* FROM stream_orders o, mb_anchor m "
                   "WHERE o.order_purchase_timestamp >= m.a AND o.order_purchase_timestamp < m.a + INTERVAL 7 DAY")(
    lambda b: M.slice_window(_mb(b).orders, M.window_anchor(_mb(b).orders),
                             M.window_anchor(_mb(b).orders) + F.expr("INTERVAL 7 DAYS")))
_q("stream_window_kpis",
   "SELECT window_start, window_end, COUNT(*) AS orders, COUNT(DISTINCT customer_id) AS unique_customers "
   "FROM mb_orders_w GROUP BY 1, 2")(
    lambda b: _stream_kpis(b.raw["stream_orders"]))
_q("related_rows", "SELECT * FROM mb_items")(lambda b: _mb(b).batches["order_items"])
_q("inventory_snapshot", "SELECT * FROM inventory_snapshot")(lambda b: M.inventory_snapshot(b.order_items))
_q("items_with_inventory",
   f"SELECT i.*, v.stock_qty, v.reorder_level, v.stock_status FROM stream_order_items i LEFT JOIN mb_inventory v "
   f"ON i.product_id IS NOT DISTINCT FROM v.product_id AND i.seller_id IS NOT DISTINCT FROM v.seller_id")(
    lambda b: M.items_with_inventory(_mb(b).items, _mb(b).inventory))
_q("batch_summary", "SELECT * FROM batch_summary")(lambda b: _mb(b).batch_summary)
_q("batch_inventory_details", "SELECT * FROM mb_details")(lambda b: _mb(b).batch_inventory_details)
_q("daily_summary", "SELECT * FROM daily_summary")(lambda b: _mb(b).daily_summary)
_q("monthly_summary", "SELECT * FROM monthly_summary")(lambda b: _mb(b).monthly_summary)
_q("run_summary",
   "SELECT COUNT(*) AS total_batches, CAST(COALESCE(SUM(total_orders), 0) AS BIGINT) AS total_orders, "
   "CAST(COALESCE(SUM(sales_revenue), 0) AS DECIMAL(22,2)) AS total_revenue, "
   "CAST(COALESCE(SUM(total_paid_amount), 0) AS DECIMAL(22,2)) AS total_paid, "
   "COUNT(*) FILTER (WHERE batch_quality_status = 'Passed') AS passed_batches, "
   "COUNT(*) FILTER (WHERE batch_quality_status = 'Needs Review') AS needs_review_batches, "
   f"COALESCE({_oracle.hu(_oracle.cents('SUM(sales_revenue)'), 'SUM(total_orders)', 2, 18)}, CAST(0 AS DECIMAL(18,2))) "
   "AS average_order_value FROM batch_summary")(lambda b: _mb(b).run_summary)
_q("recent_batches", "SELECT batch_id, window_start, window_end, total_orders, batch_quality_status FROM batch_summary "
                     "ORDER BY batch_id DESC LIMIT 10")(lambda b: RU.recent_batches(_mb(b).batch_summary))


# ------------------------------------------------------------------ versions, changes and lasting ids
_q("published_version", "SELECT * FROM published_version")(lambda b: SC.published_version(b.dim_date.sparkSession, b))
_q("refresh_inventory", "SELECT * FROM changed_inventory")(lambda b: SC.refresh_inventory(b.dim_date.sparkSession, b))
_q("refresh_daily_sales", "SELECT * FROM changed_sales_daily")(lambda b: SC.refresh_daily_sales(b.dim_date.sparkSession, b))
_q("refresh_monthly_sales", "SELECT * FROM changed_sales_monthly")(lambda b: SC.refresh_monthly_sales(b.dim_date.sparkSession, b))
_q("refresh_payments", "SELECT * FROM changed_payment_methods")(lambda b: SC.refresh_payments(b.dim_date.sparkSession, b))
_q("refresh_reviews", "SELECT * FROM changed_reviews_monthly")(lambda b: SC.refresh_reviews(b.dim_date.sparkSession, b))
_q("lasting_ids", "SELECT * FROM lasting_ids")(lambda b: SC.lasting_ids(b.dim_date.sparkSession, b))

_q("csv_rejects", "SELECT * FROM csv_rejects")(lambda b: SC.csv_rejects(b.dim_date.sparkSession, b))
_q("run_ledger", _oracle.run_ledger())(lambda b: SC.run_ledger(b.dim_date.sparkSession, b))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: daily sales summary (clean items -> item fact -> daily aggregate) at sf0.001."""
    return _build(spark, SMOKE_DIR).agg_sales_daily


# The training-data operators and their pipeline are optional: without them everything above still works.
_HAS_LLM = importlib.util.find_spec("mercato.llm") is not None and importlib.util.find_spec("mercato.llm.queries") is not None
_HAS_PIPELINE = _HAS_LLM and importlib.util.find_spec("corpus_pipeline") is not None


def queries() -> dict[str, Query]:
    found = {name: (lambda fn: (lambda spark, sf_dir: fn(_build(spark, sf_dir))))(fn) for name, fn in _QUERIES.items()}
    if _HAS_LLM:
        from mercato.llm.queries import QUERIES
        found |= QUERIES
    if _HAS_PIPELINE:
        import corpus_pipeline
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = _oracle.oracle_sql()
    if _HAS_LLM:
        from mercato.llm.queries import ORACLE_SQL
        found |= ORACLE_SQL
    if _HAS_PIPELINE:
        import corpus_pipeline
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
