from decimal import Decimal

import pytest

from mercato.operators import quality as Q
from mercato.plans.build import WarehouseBuild
from mercato.schemas import SCHEMAS


def test_gate_passes_on_clean_fixture(fx):
    b = WarehouseBuild(fx)
    checks = Q.quality_checks(b.fact_order_items, b.dim_customers, b.dim_products, b.dim_date)
    assert checks.count() == 7
    Q.assert_quality(checks)  # nothing found on clean data


def test_gate_finds_injected_faults(spark, fx):
    b = WarehouseBuild(fx)
    bad = b.fact_order_items.limit(3).unionByName(
        spark.createDataFrame([(None, 1, "c", None, "s", 20180101, "ok", None, Decimal("-1.00"), Decimal("0"),
                                Decimal("0"))], SCHEMAS["fact_order_items"]))
    empty_dim = b.dim_products.limit(0)
    with pytest.raises(Q.QualityError) as e:
        Q.assert_quality(Q.quality_checks(bad, b.dim_customers, empty_dim, b.dim_date))
    msg = str(e.value)
    for failure in ["null order_id = 1", "null product_id = 1", "negative price = 1", "dim_products rows = 0"]:
        assert failure in msg


def test_pk_fk_and_counters(spark, fx):
    b = WarehouseBuild(fx)
    pk = {r["table_name"]: r for r in Q.pk_checks({"fact_order_items": b.fact_order_items,
                                                   "dim_customers": b.dim_customers}).collect()}
    assert pk["fact_order_items"]["duplicate_keys"] == 0
    typed = b.raw["order_items_raw"]
    dups = Q.duplicate_counts([("order_items", typed, ["order_id", "order_item_id"])]).collect()[0]
    assert dups["excess_rows"] > 0  # the fixture plants duplicate keys
    fk = {r["column_name"]: r["orphans"] for r in Q.fk_checks({
        "fact_order_items": b.fact_order_items, "dim_customers": b.dim_customers, "dim_products": b.dim_products,
        "dim_sellers": b.dim_sellers, "dim_date": b.dim_date}).collect()}
    assert fk["product_id"] == 0 and fk["order_purchase_date_key"] == 0
    assert fk["customer_id"] > 0  # customers with blank ids leave orphans behind
    child = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    from mercato.operators.relational import fk_orphans, orphans
    assert orphans(child, parent, "k").count() == 2  # NULL key counts as orphan
    assert fk_orphans(child, parent, "k").count() == 1  # nullable FK: NULL allowed
