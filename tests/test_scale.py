"""Work that must be done once, and state that must stay small, whatever the size of the input."""

from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from mercato.plans import aggregates as A
from mercato.plans import retraction as RT
from mercato.plans import scenarios as SC
from mercato.plans.warehouse import dim_date_calendar
from mercato.schemas import SCHEMAS


def _fact(spark, rows):
    """(order, item, product, day, status, price) as ``fact_order_items``."""
    full = [(o, n, "c", p, "s", d, t, None, v, Decimal(1), None if v is None else v + 1) for o, n, p, d, t, v in rows]
    return spark.createDataFrame(full, SCHEMAS["fact_order_items"])


def _items():
    return [(f"o{k}", n, f"p{(k * n) % 3}", 20200101 + k % 4, "FOP"[k % 3], Decimal(k * n)) for k in range(12) for n in (1, 2, 3)]


def _counted(spark, df):
    """``df`` and a counter of how often its rows are made."""
    made = spark.sparkContext.accumulator(0)

    def seen(v):
        made.add(1)
        return v
    return df.withColumn("order_id", F.udf(seen, "string").asNondeterministic()("order_id")), made


def test_inventory_counts_orders_without_a_distinct_count(spark):
    rows = [("o1", 1, "p1", 1, "F", Decimal(2)), ("o1", 2, "p1", 1, "F", None), ("o2", 1, "p1", 1, "F", Decimal(4)),
            (None, 1, "p1", 1, "F", Decimal(1)), (None, 2, "p2", 1, "F", Decimal(1)), ("o2", 2, None, 1, "F", Decimal(8)), ("o2", 3, None, 1, "F", Decimal(8))]
    sums = A.inventory_sums(_fact(spark, rows))
    got = {r["product_id"]: (r["total_units_sold"], r["total_orders"], r["price_sum"], r["price_n"]) for r in sums.collect()}
    assert got == {"p1": (4, 2, Decimal(7), 3), "p2": (1, 0, Decimal(1), 1), None: (2, 1, Decimal(16), 2)}
    plan = sums._jdf.queryExecution().optimizedPlan().toString()
    assert "distinct" not in plan  # it would keep two hash maps of all pairs in a task


@pytest.mark.parametrize("specs", [[RT.INVENTORY], [RT.INVENTORY, RT.DAILY]])
def test_a_refresh_makes_its_change_once(spark, tmp_path, specs):
    change, made = _counted(spark, _fact(spark, _items()))
    RT.refresh(spark, str(tmp_path / "s"), specs, RT.signed(change, 1), 1)
    assert made.value == len(_items())


def test_a_refresh_counts_rows_whose_sums_change_but_not_their_number(spark, tmp_path):
    root, fact = str(tmp_path / "s"), _fact(spark, _items())
    dearer = fact.where("order_id = 'o3'").withColumn("total_amount", (F.col("total_amount") + 5).cast("decimal(10,2)"))
    RT.refresh(spark, root, [RT.DAILY], RT.signed(fact, 1), 1)
    RT.refresh(spark, root, [RT.DAILY], RT.changes(fact, SC.ITEM_KEY, dearer), 2)
    after = fact.where("order_id <> 'o3'").unionByName(dearer)
    days = dim_date_calendar(spark, "2020-01-01", "2020-01-31")
    assert sorted(map(str, RT.refreshed_daily(spark, root, days).collect())) == sorted(map(str, A.agg_sales_daily(after, days).collect()))


def test_histories_make_their_fact_once(spark):
    days = dim_date_calendar(spark, "2020-01-01", "2020-01-31")
    for run in (SC.published_version, SC.refresh_daily_sales):
        fact, made = _counted(spark, _fact(spark, _items()))
        assert run(spark, SimpleNamespace(fact_order_items=fact, dim_date=days)).count() > 0
        assert made.value == len(_items())
