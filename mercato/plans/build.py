"""Lazy wiring of the whole batch warehouse over a set of raw tables.

``WarehouseBuild(raw)`` takes a mapping ``{"orders_raw": DataFrame, ...}``
(from CSV files, from the fixture views, or from tables already written) and
exposes every staging table, dimension, fact and summary as a property. The
properties only compose DataFrame plans; ``pipeline.run_pipeline`` decides
what is written and when.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from . import aggregates as A
from . import microbatch as M
from . import rollups as RU
from . import staging as S
from . import warehouse as W


class WarehouseBuild:
    def __init__(self, raw: Mapping[str, DataFrame], *, dim_date_mode: str = "observed",
                 calendar: tuple[str, str] | None = None, payment_min_value: float | None = 0,
                 review_dedup: str = "after_join", stock_hash: str = "crc32"):
        self.raw = raw
        self.dim_date_mode = dim_date_mode
        self.calendar = calendar
        self.payment_min_value = payment_min_value
        self.review_dedup = review_dedup
        self.stock_hash = stock_hash

    # staging ------------------------------------------------------------
    @cached_property
    def translation(self) -> DataFrame:
        return S.clean_translation(self.raw["product_category_name_translation_raw"])

    @cached_property
    def customers(self) -> DataFrame:
        return S.clean_customers(self.raw["customers_raw"])

    @cached_property
    def sellers(self) -> DataFrame:
        return S.clean_sellers(self.raw["sellers_raw"])

    @cached_property
    def orders(self) -> DataFrame:
        return S.clean_orders(self.raw["orders_raw"])

    @cached_property
    def products(self) -> DataFrame:
        return S.clean_products(self.raw["products_raw"], self.translation)

    @cached_property
    def order_items(self) -> DataFrame:
        return S.clean_order_items(self.raw["order_items_raw"])

    @cached_property
    def payments(self) -> DataFrame:
        return S.clean_payments(self.raw["order_payments_raw"])

    @cached_property
    def reviews_typed(self) -> DataFrame:
        return S.typed_reviews(self.raw["order_reviews_raw"])

    @cached_property
    def reviews(self) -> DataFrame:
        return S.clean_reviews(self.raw["order_reviews_raw"])

    @cached_property
    def geolocation(self) -> DataFrame:
        return S.clean_geolocation(self.raw["geolocation_raw"])

    # dimensions ---------------------------------------------------------
    @cached_property
    def dim_customers(self) -> DataFrame:
        return W.dim_customers(self.customers, unique=True)  # staging keeps one row per key

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return W.dim_sellers(self.sellers, unique=True)

    @cached_property
    def dim_products(self) -> DataFrame:
        return W.dim_products(self.products, unique=True)

    @cached_property
    def dim_date(self) -> DataFrame:
        if self.dim_date_mode == "observed":
            return W.dim_date_observed(self.orders)
        if self.dim_date_mode == "calendar":
            if self.calendar:
                return W.dim_date_calendar(self.orders.sparkSession, *self.calendar)
            return W.dim_date_spanning(self.orders)
        raise ValueError(self.dim_date_mode)

    # facts --------------------------------------------------------------
    @cached_property
    def fact_order_items(self) -> DataFrame:
        return W.fact_order_items(self.order_items, self.orders)

    @cached_property
    def fact_order_payments(self) -> DataFrame:
        return W.fact_order_payments(self.payments, self.orders, self.payment_min_value)

    @cached_property
    def fact_order_reviews(self) -> DataFrame:
        return W.fact_order_reviews(self.reviews_typed, self.orders, self.review_dedup)

    _flows = {"fact_order_items": (fact_order_items, lambda b: W.item_flow(b.order_items, b.orders)),
              "fact_order_payments": (fact_order_payments, lambda b: W.payment_flow(b.payments, b.orders, b.payment_min_value))}

    def flow(self, fact: str):
        """(rows, rules, finish) of a fact whose left-out rows a ledger counts; None for others, and for a fact that a
        subclass builds in its own way."""
        made_by, flow = self._flows.get(fact, (None, None))
        return flow(self) if made_by is not None and getattr(type(self), fact) is made_by else None

    # summaries ----------------------------------------------------------
    @cached_property
    def agg_sales_daily(self) -> DataFrame:
        return A.agg_sales_daily(self.fact_order_items, self.dim_date)

    @cached_property
    def agg_sales_monthly(self) -> DataFrame:
        return A.agg_sales_monthly(self.agg_sales_daily)

    @cached_property
    def agg_inventory(self) -> DataFrame:
        return A.agg_inventory(self.fact_order_items, self.dim_products, self.stock_hash)

    @cached_property
    def agg_payment_methods(self) -> DataFrame:
        return A.agg_payment_methods(self.fact_order_payments)

    @cached_property
    def agg_reviews_monthly(self) -> DataFrame:
        return A.agg_reviews_monthly(self.fact_order_reviews, self.dim_date)


class MicroBatchBuild:
    """Lazy wiring of the micro-batch formulation over the stream tables.

    ``raw`` must provide ``stream_orders``, ``stream_order_items``,
    ``stream_order_payments``, ``stream_order_reviews`` and the reference-key
    tables ``ref_customers``, ``ref_products``, ``ref_sellers``.
    """

    def __init__(self, raw: Mapping[str, DataFrame], minutes: int = 5, anchor=None):
        self.raw = raw
        self.minutes = minutes
        self._anchor = anchor

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw["stream_orders"]

    @cached_property
    def anchor(self):
        """Window anchor: given, or the first purchase time (computed once)."""
        return self._anchor if self._anchor is not None else M.first_purchase(self.orders)

    @cached_property
    def items(self) -> DataFrame:
        return self.raw["stream_order_items"]

    @cached_property
    def inventory(self) -> DataFrame:
        return M.inventory_snapshot(self.items)

    @cached_property
    def orders_windowed(self) -> DataFrame:
        return M.assign_windows(self.orders, minutes=self.minutes, anchor=self.anchor)

    @cached_property
    def batches(self) -> dict[str, DataFrame]:
        return M.release_batches(self.orders, self.items, self.raw["stream_order_payments"],
                                 self.raw["stream_order_reviews"], minutes=self.minutes, anchor=self.anchor)

    @cached_property
    def batch_summary(self) -> DataFrame:
        return M.batch_summary(self.batches, self.inventory, self.raw["ref_customers"], self.raw["ref_products"],
                               self.raw["ref_sellers"])

    @cached_property
    def batch_inventory_details(self) -> DataFrame:
        return M.batch_inventory_details(self.batches["order_items"], self.inventory)

    @cached_property
    def daily_summary(self) -> DataFrame:
        return RU.daily_summary(self.batch_summary, self.batch_inventory_details)

    @cached_property
    def monthly_summary(self) -> DataFrame:
        return RU.monthly_summary(self.daily_summary)

    @cached_property
    def run_summary(self) -> DataFrame:
        return RU.run_summary(self.batch_summary)
