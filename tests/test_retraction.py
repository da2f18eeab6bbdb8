"""Summaries from signed changes equal a full recompute, after inserts, moves and deletes."""

import random
from decimal import Decimal

import pytest

from mercato.operators.allocator import allocate, allocated, with_ids
from mercato.plans import aggregates as A
from mercato.plans import retraction as RT
from mercato.plans import scenarios as SC
from mercato.plans.warehouse import dim_date_calendar
from mercato.schemas import SCHEMAS
from mercato.sources.publishing import history, resolve

DAYS = ("2020-01-01", "2020-03-31")


def _days(rng):
    return 20200000 + rng.choice([101, 102, 131, 201, 215, 301, 331])


def _item(rng, order, n):
    price = None if rng.random() < 0.05 else Decimal(rng.randint(0, 9999)).scaleb(-2)
    return (order, n, "c", rng.choice(["p1", "p2", "p3", "p4", None]), "s", None if rng.random() < 0.05 else _days(rng), "x", None, price,
            Decimal(1), None if price is None else price + 1)


def _payment(rng, order, n):
    return (order, n, _days(rng), rng.choice(["card", "boleto", "voucher", None]), rng.choice([1, 2, 10, None]), Decimal(rng.randint(0, 999)).scaleb(-2))


def _review(rng, review, _):
    return (review, "o", _days(rng), rng.choice([1, 2, 3, 4, 5, None]), "", "", None, None)


def _products(spark):
    rows = [(f"p{k}", None, "cat" if k != 2 else None, None, None, None, None, None, None, None) for k in (1, 2, 3, 5)]
    return spark.createDataFrame(rows, SCHEMAS["dim_products"])


def _equal(a, b):
    assert a.dtypes == b.dtypes
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("seed", [1])
def test_random_changes_equal_a_full_recompute(spark, tmp_path, seed):
    rng = random.Random(seed)
    dim_date, products = dim_date_calendar(spark, *DAYS), _products(spark)
    kinds = {  # fact: key, a random row, summaries
        "fact_order_items": (SC.ITEM_KEY, _item, [RT.INVENTORY, RT.DAILY]),
        "fact_order_payments": (SC.PAYMENT_KEY, _payment, [RT.PAYMENTS]),
        "fact_order_reviews": (SC.REVIEW_KEY, _review, [RT.REVIEWS])}
    for table, (key, make, specs) in kinds.items():
        schema, root = SCHEMAS[table], str(tmp_path / table)
        rows: dict = {}
        for number in range(1, 3):
            some = {(f"o{rng.randint(1, 25)}", rng.randint(1, 3)) if len(key) == 2 else (f"r{rng.randint(1, 40)}",) for _ in range(40 if number == 1 else 12)}
            new = {k: make(rng, k[0], k[1] if len(k) > 1 else None) for k in some}
            gone = [k for k in sorted(rows) if rng.random() < 0.25]
            fact = spark.createDataFrame(list(rows.values()), schema)
            deleted = spark.createDataFrame([k for k in gone], [f"{c}" for c in key]) if gone else None
            if deleted is not None and len(key) == 2:
                deleted = deleted.withColumn(key[1], deleted[key[1]].cast("int"))
            change = RT.changes(fact, key, spark.createDataFrame(list(new.values()), schema), deleted)
            want = {k: v for k, v in rows.items() if k not in gone} | new
            _equal(RT.apply_changes(fact, key, change), spark.createDataFrame(list(want.values()), schema))
            RT.refresh(spark, root, specs, change, number)
            rows = want
            fact = spark.createDataFrame(list(rows.values()), schema)
            if table == "fact_order_items":
                _equal(RT.refreshed_inventory(spark, root, products), A.agg_inventory(fact, products))
                _equal(RT.refreshed_daily(spark, root, dim_date), A.agg_sales_daily(fact, dim_date))
            elif table == "fact_order_payments":
                _equal(RT.refreshed_payments(spark, root), A.agg_payment_methods(fact))
            else:
                _equal(RT.refreshed_reviews(spark, root, dim_date), A.agg_reviews_monthly(fact, dim_date))


def test_distinct_orders_fall_and_untouched_parts_stay(spark, tmp_path):
    root = str(tmp_path / "s")
    rng = random.Random(3)
    rows = [_payment(rng, f"o{k}", n) for k in range(200) for n in (1, 2)]
    fact = spark.createDataFrame([(o, n, d, "card", i, Decimal("1.00")) for o, n, d, _, i, _ in rows], SCHEMAS["fact_order_payments"])
    one = RT.refresh(spark, root, [RT.PAYMENTS], RT.signed(fact, 1), 1)
    change = RT.changes(fact, SC.PAYMENT_KEY, fact.limit(0), fact.where("order_id = 'o7' OR (order_id = 'o8' AND payment_sequential = 2)"))
    two = RT.refresh(spark, root, [RT.PAYMENTS], change, 2)
    got = RT.refreshed_payments(spark, root).first()
    assert (got["total_transactions"], got["total_orders"]) == (397, 199)
    shared = set(one.tables[RT.PAYMENTS.members].paths) & set(two.tables[RT.PAYMENTS.members].paths)
    assert len(one.tables[RT.PAYMENTS.members].paths) - len(shared) <= 2  # the parts of two orders
    # the same change again, a gap, and taking away what is not there
    assert RT.refresh(spark, root, [RT.PAYMENTS], change, 2).number == 2 and history(spark, root) == [1, 2]
    with pytest.raises(ValueError, match="gap"):
        RT.refresh(spark, root, [RT.PAYMENTS], change, 4)
    with pytest.raises(ValueError, match="not there"):
        RT.refresh(spark, root, [RT.PAYMENTS], RT.signed(fact.where("order_id = 'o7'"), -1), 3)
    assert resolve(spark, root).number == 2 and RT.refreshed_payments(spark, root).first() == got
    RT.refresh(spark, root, [RT.PAYMENTS], RT.signed(fact.where("order_id <> 'o7' AND NOT (order_id = 'o8' AND payment_sequential = 2)"), -1), 3)
    assert RT.refreshed_payments(spark, root).count() == 0


def test_ids_last_and_stay_dense(spark, tmp_path):
    root = str(tmp_path / "ids")

    def keys(values):
        return spark.createDataFrame([(v, w) for v, w in values], "p string, s string").repartition(3)
    first = {(r["p"], r["s"]): r["id"] for r in allocate(spark, root, keys([("b", "x"), ("a", "y"), (None, "x"), ("b", "x")])).collect()}
    assert first == {(None, "x"): 1, ("a", "y"): 2, ("b", "x"): 3}
    more = [("a", "a"), ("z", None), (None, "x"), ("a", "y"), (None, None)]
    second = {(r["p"], r["s"]): r["id"] for r in allocate(spark, root, keys(more)).collect()}
    assert {k: second[k] for k in first} == first and sorted(second.values()) == [1, 2, 3, 4, 5, 6]
    assert (second[None, None], second["a", "a"], second["z", None]) == (4, 5, 6)
    before = history(spark, root)
    assert allocate(spark, root, keys(more)).count() == 6 and history(spark, root) == before
    assert allocate(spark, root, keys([("q", "q")]).where("false")).count() == 6
    many = spark.range(5000).selectExpr("cast(id % 1000 as string) p", "cast(id % 7 as string) s")
    third = {(r["p"], r["s"]): r["id"] for r in allocate(spark, root, many).collect()}
    assert {k: third[k] for k in second} == second and sorted(third.values()) == list(range(1, len(third) + 1))
    got = with_ids(keys([("a", "y"), (None, None), ("never", "seen")]), allocated(spark, root), ["p", "s"]).collect()
    assert {(r["p"], r["s"]): r["id"] for r in got} == {("a", "y"): 2, (None, None): 4, ("never", "seen"): None}
