import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from mercato.plans import microbatch as M
from mercato.plans import rollups as RU

from conftest import rows

T0 = dt.datetime(2024, 1, 1, 0, 0, 7)


def orders(spark, data):
    return spark.createDataFrame(data, "order_id bigint, customer_id bigint, order_status string, "
                                       "order_purchase_timestamp timestamp_ntz")


def items(spark, data):
    return spark.createDataFrame(data, "order_id bigint, product_id bigint, seller_id bigint, "
                                       "price decimal(15,2), freight_value decimal(15,2)")


def test_windows_anchor_boundaries_and_dense_ids(spark):
    o = orders(spark, [
        (1, 1, "x", T0),                                    # anchor, window 0
        (2, 1, "x", T0 + dt.timedelta(minutes=4, seconds=59)),
        (3, 2, "x", T0 + dt.timedelta(minutes=5)),          # exactly on the boundary: window 1
        (4, 2, "x", T0 + dt.timedelta(minutes=31)),         # windows 2..5 empty: skipped
        (5, 3, "x", None),                                   # no time: never released
    ])
    b = M.batch_orders(o)
    got = rows(b, "order_id", "batch_id", "window_start")
    assert got == [(1, 1, T0), (2, 1, T0), (3, 2, T0 + dt.timedelta(minutes=5)),
                   (4, 3, T0 + dt.timedelta(minutes=30))]


def test_batch_summary_edge_cases(spark):
    o = orders(spark, [(1, 1, "x", T0), (1, 1, "x", T0), (2, 99, "x", T0 + dt.timedelta(minutes=6))])
    i = items(spark, [
        (1, 10, 20, Decimal("10.00"), Decimal("1.00")),
        (1, 10, 20, Decimal("10.00"), Decimal("1.00")),     # same pair twice (and a duplicate row)
        (1, 11, 21, Decimal("-5.00"), Decimal("0.50")),    # negative price, pair missing in inventory
    ])
    inv = spark.createDataFrame([(10, 20, 0, 5, "Out of Stock")],
                                "product_id bigint, seller_id bigint, stock_qty int, reorder_level int, stock_status string")
    ref_c = spark.createDataFrame([(1,)], "customer_id bigint")
    ref_p = spark.createDataFrame([(10,), (11,)], "product_id bigint")
    ref_s = spark.createDataFrame([(20,)], "seller_id bigint")
    pay = spark.createDataFrame([(1, 1, Decimal("1.00"))], "order_id bigint, payment_sequential int, payment_value decimal(15,2)")
    rev = spark.createDataFrame([], "order_id bigint, review_score int")
    batches = M.release_batches(o, i, pay, rev)
    s = {r["batch_id"]: r for r in M.batch_summary(batches, inv, ref_c, ref_p, ref_s).collect()}
    b1, b2 = s[1], s[2]
    assert len(M.batch_summary(batches, inv, ref_c, ref_p, ref_s).columns) == 30
    # batch 1: the duplicated order counts once for release (distinct keys), twice in total_orders
    assert b1["total_orders"] == 2 and b1["duplicate_orders"] == 1
    assert b1["total_order_items"] == 3 and b1["duplicate_order_items"] == 1
    assert b1["invalid_price_count"] == 1 and b1["order_items_seller_id_valid"] == 1
    assert b1["sales_revenue"] == Decimal("15.00") and b1["average_order_value"] == Decimal("15.00")
    assert b1["inventory_match_valid"] is False and b1["batch_quality_status"] == "Needs Review"
    assert b1["out_of_stock_items"] == 1 and b1["out_of_stock_order_items"] == 2
    assert b1["total_payments"] == 1 and b1["total_reviews"] == 0
    # batch 2: orders but no items; unknown customer
    assert b2["total_order_items"] == 0 and b2["sales_revenue"] == Decimal("0.00")
    assert b2["average_order_value"] == Decimal("0.00") and b2["inventory_match_valid"] is True
    assert b2["orders_customer_id_valid"] == 1 and b2["batch_quality_status"] == "Needs Review"


def test_rollups_zero_fill_and_null_aov(spark):
    bs = spark.createDataFrame([
        (1, dt.datetime(2024, 1, 31, 23, 58), dt.datetime(2024, 2, 1, 0, 3), 2, Decimal("10.00"), Decimal("1.00"),
         Decimal("11.00"), "Passed"),
        (2, dt.datetime(2024, 4, 1, 0, 0), dt.datetime(2024, 4, 1, 0, 5), 1, Decimal("5.00"), Decimal("0.00"),
         Decimal("5.00"), "Needs Review"),
    ], "batch_id bigint, window_start timestamp_ntz, window_end timestamp_ntz, total_orders bigint, "
       "sales_revenue decimal(18,2), "
       "shipping_revenue decimal(18,2), total_paid_amount decimal(18,2), batch_quality_status string")
    daily = RU.daily_summary(bs)
    assert daily.count() == 2 and {r["daily_low_stock_items"] for r in daily.collect()} == {0}
    monthly = {r["month"]: r for r in RU.monthly_summary(daily).collect()}
    assert list(sorted(monthly)) == ["2024-01", "2024-02", "2024-03", "2024-04"]
    assert monthly["2024-02"]["monthly_orders"] == 0 and monthly["2024-02"]["monthly_average_order_value"] is None
    assert monthly["2024-01"]["monthly_average_order_value"] == Decimal("5.00")
    run = RU.run_summary(bs).collect()[0]
    assert (run["total_batches"], run["passed_batches"], run["needs_review_batches"]) == (2, 1, 1)
    assert run["average_order_value"] == Decimal("5.00")
    assert [r["batch_id"] for r in RU.recent_batches(bs, 1).collect()] == [2]


def test_inventory_snapshot_unique_pairs(fx):
    inv = M.inventory_snapshot(fx["stream_order_items"])
    n = inv.count()
    assert inv.select("product_id", "seller_id").distinct().count() == n
    assert inv.agg(F.min("inventory_id"), F.max("inventory_id")).collect()[0] == (1, n)
