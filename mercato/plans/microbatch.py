"""Five-minute event-time micro-batches as one batch job.

The reference releases one 5-minute window of orders at a time (plus the
items, payments and reviews of those orders), validates each batch and
appends a KPI row. Here every window is computed at once:

* ``assign_windows``: tumbling windows anchored at the first purchase time,
  ``floor((ts - anchor) / 5 min)``, exact in zone-less microseconds;
* ``assign_batch_ids``: empty windows get no id; ids are dense 1..n in
  window order, numbered without a one-partition sort;
* ``release``: children travel with their order's window (semi-join);
* ``batch_summary``: the 30 KPI / validation columns per batch.

Raw rows never go through an aggregate with several ``COUNT(DISTINCT)``
(Catalyst would ``Expand`` every row once per distinct column). Items are
first reduced to one row per (batch, order) and per (batch, product,
seller); the inventory lookup and the reference checks join those reduced
rows, and the two distinct counts (products, sellers) run on the reduced
pair rows. A batch holding a third of the data is reduced inside each task
before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import LOW_STOCK, OUT_OF_STOCK, money, ratio, snapshot_stock, stock_status
from ..operators.dedup import excess_rows_by
from ..operators.relational import dense_index

BATCH = ["batch_id", "window_start", "window_end"]
WINDOW_MINUTES = 5
# Fixed value: snapshot date stamped on every simulated inventory row.
INVENTORY_DATE = "2018-10-01 00:00:00"


# --------------------------------------------------------------------------- windows and ids

def window_anchor(orders: DataFrame, ts: str = "order_purchase_timestamp") -> Column:
    """First purchase time as a scalar subquery (one tiny aggregate, no collect)."""
    return orders.select(F.min(ts)).scalar()


def first_purchase(orders: DataFrame, ts: str = "order_purchase_timestamp"):
    """First purchase time as a Python value: one aggregated scalar, computed once per run so the
    window plans carry a literal instead of re-evaluating a subquery at every use."""
    return orders.agg(F.min(ts)).first()[0]


def ntz_micros(c) -> Column:
    """Microseconds since 1970-01-01 of a zone-less timestamp, without any time-zone conversion."""
    c = F.col(c) if isinstance(c, str) else c
    day = F.unix_date(F.to_date(c)).cast("bigint")
    return (day * 86_400_000_000 + F.hour(c).cast("bigint") * 3_600_000_000
            + F.minute(c).cast("bigint") * 60_000_000
            + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint"))


def assign_windows(orders: DataFrame, ts: str = "order_purchase_timestamp", minutes: int = WINDOW_MINUTES,
                   anchor=None) -> DataFrame:
    """Add ``window_index``, ``window_start``, ``window_end`` (half-open, anchored windows).

    ``anchor`` defaults to the first purchase time; rows without a time get no window.
    """
    width = minutes * 60 * 1_000_000
    if anchor is None:
        a = window_anchor(orders, ts)
    elif isinstance(anchor, Column):
        a = anchor
    else:  # a Python datetime or ISO text; via text so no time zone is applied to the zone-less value
        text = anchor.isoformat(sep=" ") if hasattr(anchor, "isoformat") else str(anchor)
        a = F.lit(text).cast("timestamp_ntz")
    diff = ntz_micros(F.col(ts)) - ntz_micros(a)
    idx = F.floor(diff.cast("decimal(20,0)") / F.lit(width)).cast("bigint")
    out = orders.filter(F.col(ts).isNotNull()).withColumn("window_index", idx)
    return out.withColumns({
        "window_start": F.timestamp_add("MICROSECOND", F.col("window_index") * width, a),
        "window_end": F.timestamp_add("MICROSECOND", (F.col("window_index") + 1) * width, a),
    })


def assign_batch_ids(orders_w: DataFrame) -> DataFrame:
    """Dense ids 1..n over the non-empty windows, in time order."""
    windows = orders_w.select("window_index").distinct()
    ids = dense_index(windows, ["window_index"], "batch_id")
    return orders_w.join(ids, on="window_index", how="inner")


five_minute_windows = assign_windows


def window_counts(orders_w: DataFrame) -> DataFrame:
    return orders_w.groupBy("window_start", "window_end").agg(F.count("*").alias("orders"))


def slice_window(df: DataFrame, start, end, ts: str = "order_purchase_timestamp") -> DataFrame:
    """Half-open time slice ``start <= ts < end`` (pushed down to the scan)."""
    return df.filter((F.col(ts) >= start) & (F.col(ts) < end))


def release_batches(orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame,
                    ts: str = "order_purchase_timestamp", minutes: int = WINDOW_MINUTES,
                    anchor=None) -> dict[str, DataFrame]:
    """Tag every order with its batch and release children with their order's batch.

    A child goes to every batch its order id appears in (an id duplicated
    across windows releases its children twice, as an ``isin`` per batch does).
    """
    orders_b = batch_orders(orders, ts, minutes, anchor)
    return {"orders": orders_b, **release_children(orders_b, {"order_items": items, "order_payments": payments,
                                                              "order_reviews": reviews})}


def batch_orders(orders: DataFrame, ts: str = "order_purchase_timestamp", minutes: int = WINDOW_MINUTES,
                 anchor=None) -> DataFrame:
    """Orders with their batch id and window bounds in front."""
    return assign_batch_ids(assign_windows(orders, ts, minutes, anchor)).select(*BATCH, *orders.columns)


def release_children(orders_b: DataFrame, children: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Each child row tagged with the batch(es) of its order (inner join on the distinct keys)."""
    keys = orders_b.select("order_id", *BATCH).distinct()
    return {name: child.join(keys, on="order_id", how="inner").select(*BATCH, *child.columns)
            for name, child in children.items()}


# --------------------------------------------------------------------------- inventory

def inventory_snapshot(items: DataFrame, snapshot: str = INVENTORY_DATE) -> DataFrame:
    """One row per distinct (product, seller): id 1..n in pair order, deterministic stock draw."""
    pairs = items.select("product_id", "seller_id").distinct()
    pairs = dense_index(pairs, ["product_id", "seller_id"], "inventory_id")
    qty, reorder = snapshot_stock("product_id", "seller_id")
    return pairs.select(
        "inventory_id", "product_id", "seller_id",
        F.lit(snapshot).cast("timestamp_ntz").alias("inventory_date"),
        qty.alias("stock_qty"), reorder.alias("reorder_level"),
    ).withColumn("stock_status", stock_status("stock_qty", "reorder_level"))


def _with_stock(df: DataFrame, inventory: DataFrame) -> DataFrame:
    """Left lookup of stock by (product, seller); NULL keys match NULL keys, as in a dataframe merge."""
    inv = inventory.select(F.col("product_id").alias("__p"), F.col("seller_id").alias("__s"),
                           "stock_qty", "reorder_level", "stock_status")
    cond = F.col("product_id").eqNullSafe(F.col("__p")) & F.col("seller_id").eqNullSafe(F.col("__s"))
    return df.join(inv, cond, "left").drop("__p", "__s")


def items_with_inventory(items: DataFrame, inventory: DataFrame) -> DataFrame:
    return _with_stock(items, inventory)


def batch_inventory_details(items_b: DataFrame, inventory: DataFrame) -> DataFrame:
    return _with_stock(items_b, inventory).select(
        *BATCH, "order_id", "product_id", "seller_id", "stock_qty", "reorder_level", "stock_status")


# --------------------------------------------------------------------------- KPIs

def _nulls(cols: Sequence[str]) -> Column:
    per_row = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in cols])
    return F.coalesce(F.sum(per_row), F.lit(0)).cast("bigint")


def _count_per_batch(df: DataFrame, alias: str) -> DataFrame:
    return df.groupBy("batch_id").agg(F.count("*").cast("bigint").alias(alias))


# Validation counters that must all be zero for a batch to pass (missing-value counts are reported only).
STATUS_COUNTERS = ("duplicate_orders", "duplicate_order_items", "invalid_price_count", "invalid_freight_count",
                   "order_items_order_id_valid", "orders_customer_id_valid", "order_items_product_id_valid",
                   "order_items_seller_id_valid")


def batch_status() -> Column:
    """``Passed`` when every validation counter is zero and all items matched inventory."""
    passed = reduce(lambda a, b: a & b, [F.col(c) == 0 for c in STATUS_COUNTERS]) & F.col("inventory_match_valid")
    return F.when(passed, F.lit("Passed")).otherwise(F.lit("Needs Review"))


def _flag(keys: DataFrame, cols: Sequence[str], flag: str) -> DataFrame:
    """Distinct key table with a TRUE marker, for "does the key exist" left joins."""
    return keys.select(*cols).distinct().withColumn(flag, F.lit(True))


def batch_summary(batches: dict[str, DataFrame], inventory: DataFrame, customers: DataFrame,
                  products: DataFrame, sellers: DataFrame) -> DataFrame:
    """One KPI + validation row per batch (30 columns; ``*_valid`` columns count *invalid* rows).

    Shape of the plan: each input is first reduced to one row per
    (batch, key) with map-side partial aggregation, existence checks are left
    joins of those reduced rows against distinct key tables, and every
    per-batch partial result is stacked (``unionByName``) and reduced by a
    single ``groupBy(batch_id)``, instead of joining a dozen per-batch frames.
    """
    o, i = batches["orders"], batches["order_items"]
    o_cols = [c for c in o.columns if c not in BATCH]
    i_cols = [c for c in i.columns if c not in BATCH]
    n = F.col("n")

    # orders: one row per (batch, customer); customer existence by a flag join
    per_customer = (o.groupBy(*BATCH, "customer_id").agg(F.count("*").alias("n"), _nulls(o_cols).alias("nulls"))
                    .join(_flag(customers, ["customer_id"], "__hit"), on="customer_id", how="left"))
    p_orders = per_customer.groupBy("batch_id").agg(
        F.first("window_start").alias("window_start"), F.first("window_end").alias("window_end"),
        F.sum(n).cast("bigint").alias("total_orders"),
        F.count("customer_id").cast("bigint").alias("unique_customers"),
        F.sum("nulls").cast("bigint").alias("missing_values_orders"),
        F.sum(F.when(F.col("__hit").isNull(), n).otherwise(0)).cast("bigint").alias("orders_customer_id_valid"),
    )
    # orders: one row per (batch, order id) -> duplicates; also the released-order key set
    per_order_id = o.groupBy("batch_id", "order_id").agg(F.count("*").alias("n"))
    p_dup_orders = per_order_id.groupBy("batch_id").agg(F.sum(n - 1).cast("bigint").alias("duplicate_orders"))

    # items per (batch, order): AOV and items whose order is not in the batch
    released = per_order_id.select("batch_id", "order_id").withColumn("__rel", F.lit(True))
    per_item_order = (i.groupBy("batch_id", "order_id").agg(F.count("*").alias("n"), F.sum("price").alias("s"))
                      .join(released, on=["batch_id", "order_id"], how="left"))
    p_orders_items = per_item_order.groupBy("batch_id").agg(
        F.count("order_id").alias("orders_with_items"),
        F.sum(F.when(F.col("order_id").isNotNull(), F.coalesce("s", F.lit(0)))).alias("order_price_sum"),
        F.sum(F.when(F.col("__rel").isNull(), n).otherwise(0)).cast("bigint").alias("order_items_order_id_valid"),
    )
    # items per (batch, product, seller): counters, reference checks and stock, on reduced rows
    per_pair = i.groupBy("batch_id", "product_id", "seller_id").agg(
        F.count("*").alias("n"), _nulls(i_cols).alias("nulls"),
        F.sum("price").alias("price_sum"), F.sum("freight_value").alias("freight_sum"),
        F.count_if(F.col("price") < 0).alias("neg_price"), F.count_if(F.col("freight_value") < 0).alias("neg_freight"),
    )
    per_pair = (_with_stock(per_pair, inventory)
                .join(_flag(products, ["product_id"], "__prod"), on="product_id", how="left")
                .join(_flag(sellers, ["seller_id"], "__sell"), on="seller_id", how="left"))
    st = F.col("stock_status")
    p_items = per_pair.groupBy("batch_id").agg(
        F.sum(n).cast("bigint").alias("total_order_items"),
        F.sum("nulls").cast("bigint").alias("missing_values_order_items"),
        F.sum("price_sum").alias("price_sum"), F.sum("freight_sum").alias("freight_sum"),
        F.sum("neg_price").cast("bigint").alias("invalid_price_count"),
        F.sum("neg_freight").cast("bigint").alias("invalid_freight_count"),
        F.count_distinct("product_id").cast("bigint").alias("unique_products"),
        F.count_distinct("seller_id").cast("bigint").alias("unique_sellers"),
        F.sum(F.when(F.col("__prod").isNull(), n).otherwise(0)).cast("bigint").alias("order_items_product_id_valid"),
        F.sum(F.when(F.col("__sell").isNull(), n).otherwise(0)).cast("bigint").alias("order_items_seller_id_valid"),
        F.bool_and(st.isNotNull()).alias("inventory_match_valid"),
        F.count_if(st == LOW_STOCK).cast("bigint").alias("low_stock_items"),
        F.count_if(st == OUT_OF_STOCK).cast("bigint").alias("out_of_stock_items"),
        F.sum(F.when(st == LOW_STOCK, n).otherwise(0)).cast("bigint").alias("low_stock_order_items"),
        F.sum(F.when(st == OUT_OF_STOCK, n).otherwise(0)).cast("bigint").alias("out_of_stock_order_items"),
    )
    p_dup_items = excess_rows_by(i, ["batch_id"], i_cols, "duplicate_order_items")
    p_pays = _count_per_batch(batches["order_payments"], "total_payments")
    p_revs = _count_per_batch(batches["order_reviews"], "total_reviews")

    parts = [p_orders, p_dup_orders, p_orders_items, p_items, p_dup_items, p_pays, p_revs]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    value_cols = [c for p in parts for c in p.columns if c != "batch_id"]
    # every part has at most one row per batch, so max() just picks that row's value
    s = stacked.groupBy("batch_id").agg(*[F.max(c).alias(c) for c in value_cols]).filter(
        F.col("total_orders").isNotNull())

    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    sales = money(F.coalesce(F.col("price_sum"), F.lit(0)), 18, 2)
    ship = money(F.coalesce(F.col("freight_sum"), F.lit(0)), 18, 2)
    out = s.select(
        *BATCH, z("total_orders").alias("total_orders"), z("total_order_items").alias("total_order_items"),
        z("total_payments").alias("total_payments"), z("total_reviews").alias("total_reviews"),
        z("unique_customers").alias("unique_customers"), z("unique_products").alias("unique_products"),
        z("unique_sellers").alias("unique_sellers"),
        sales.alias("sales_revenue"), ship.alias("shipping_revenue"),
        money(sales + ship, 18, 2).alias("total_paid_amount"),
        F.coalesce(ratio(F.col("order_price_sum"), F.col("orders_with_items"), 2, 18),
                   F.lit(0).cast("decimal(18,2)")).alias("average_order_value"),
        z("missing_values_orders").alias("missing_values_orders"),
        z("missing_values_order_items").alias("missing_values_order_items"),
        z("duplicate_orders").alias("duplicate_orders"), z("duplicate_order_items").alias("duplicate_order_items"),
        z("invalid_price_count").alias("invalid_price_count"), z("invalid_freight_count").alias("invalid_freight_count"),
        z("order_items_order_id_valid").alias("order_items_order_id_valid"),
        z("orders_customer_id_valid").alias("orders_customer_id_valid"),
        z("order_items_product_id_valid").alias("order_items_product_id_valid"),
        z("order_items_seller_id_valid").alias("order_items_seller_id_valid"),
        F.coalesce(F.col("inventory_match_valid"), F.lit(True)).alias("inventory_match_valid"),
        z("low_stock_items").alias("low_stock_items"), z("out_of_stock_items").alias("out_of_stock_items"),
        z("low_stock_order_items").alias("low_stock_order_items"),
        z("out_of_stock_order_items").alias("out_of_stock_order_items"),
    )
    status = batch_status().alias("batch_quality_status")
    cols = list(out.columns)
    cols.insert(cols.index("inventory_match_valid"), status)
    return out.select(*cols)
