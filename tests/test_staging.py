import datetime as dt
from decimal import Decimal

from mercato.plans import staging as S
from mercato.plans import warehouse as W
from mercato.schemas import raw_schema

from conftest import rows


def raw(spark, table, data):
    return spark.createDataFrame(data, raw_schema(table))


def test_clean_customers_blank_padded_duplicate(spark):
    df = raw(spark, "customers", [
        (" 7 ", "u7", "01037", "city", "SP"),
        ("7", "U7", "99999", "duplicate", "ZZ"),
        ("  ", "blank", "1", "c", "s"),   # blank id passes the raw NOT NULL, becomes a NULL key
        (None, "null", "1", "c", "s"),    # raw NULL id is dropped
    ])
    got = rows(S.clean_customers(df))
    assert got == [("7", "U7", "99999", "duplicate", "ZZ"), (None, "blank", "1", "c", "s")]
    assert got[0][2] == "99999" and rows(S.clean_customers(df))[0][0] == "7"


def test_clean_orders_latest_and_null_stamped(spark):
    df = raw(spark, "orders", [
        ("1", "c", "ok", "2018-01-01 10:00:00", "", "", "", ""),
        ("1", "c", "ok", "2018-01-02 10:00:00", "", "", "", ""),
        ("2", "c", "ok", "", "", "", "", ""),
        ("3", "c", "ok", "2018-02-30 00:00:00", "", "", "", ""),
    ])
    mysql = S.clean_orders(df)
    got = rows(mysql, "order_id", "order_purchase_timestamp", "isodow", "is_weekend")
    assert got == [("1", dt.datetime(2018, 1, 2, 10, 0), 2, False)]
    # typed path: dedup first (the first copy by total order), then drop rows without purchase time
    pg_src = raw(spark, "orders", [("9", "a", "x", None, None, None, None, None),
                                   ("9", "b", "x", "2018-01-01 00:00:00", None, None, None, None)])
    assert S.clean_orders_pg(pg_src).count() == 0  # winning copy ('a') has no purchase time: the order is gone
    pg_src2 = raw(spark, "orders", [("9", "b", "x", None, None, None, None, None),
                                    ("9", "a", "x", "2018-01-01 00:00:00", None, None, None, None)])
    assert S.clean_orders_pg(pg_src2).count() == 1  # winner 'a' has a time: kept


def test_clean_order_items_abs_total_dedup(spark):
    df = raw(spark, "order_items", [
        ("o1", "1", "p", "s", "2018-01-01 00:00:00", "-10.00", "1.50"),
        ("o1", "1", "p", "s", "2018-01-01 00:00:00", "-10.00", "1.50"),
        ("o1", "2", "p", "s", "", "5.00", "1.00"),      # no shipping date: dropped
        ("o2", "x", "p", "s", "2018-01-01 00:00:00", "5.00", "1.00"),  # bad item id: dropped
    ])
    got = rows(S.clean_order_items(df), "order_id", "order_item_id", "price", "total_amount")
    assert got == [("o1", 1, Decimal("10.00"), Decimal("11.50"))]


def test_payments_and_reviews(spark):
    p = raw(spark, "order_payments", [("o", "1", "NOT_DEFINED", "2", "0.00"), ("o", "1", "voucher", "1", "3.00"),
                                      ("o", "2", "boleto", None, "1.00")])
    got = rows(S.clean_payments(p), "payment_sequential", "payment_type", "payment_value")
    assert got == [(1, "unknown", Decimal("0.00"))]  # tie-break: 'unknown' row sorts first by installments
    r = raw(spark, "order_reviews", [
        ("r1", "o1", "5", "t", "m", "2018-01-01 00:00:00", "2018-01-02 00:00:00"),
        ("r1", "o1", "4", "t", "m", "2018-01-01 00:00:00", "2018-01-03 00:00:00"),
        ("r2", "o1", "3", " ", "", "2018-01-01 00:00:00", None),
    ])
    got = rows(S.clean_reviews(r), "review_id", "review_score", "review_comment_title")
    assert got == [("r1", 4, "t"), ("r2", 3, None)]


def test_reviews_dedup_around_join(spark):
    """Newest copy is an orphan: after-join keeps the older copy, before-join loses the review."""
    r = raw(spark, "order_reviews", [
        ("r1", "o-known", "5", None, None, "2018-01-01 00:00:00", None),
        ("r1", "o-missing", "1", None, None, "2018-01-05 00:00:00", None),
    ])
    o = S.clean_orders(raw(spark, "orders", [("o-known", "c", "ok", "2018-01-01 00:00:00", "", "", "", "")]))
    typed = S.typed_reviews(r)
    after = W.fact_order_reviews(typed, o, "after_join")
    before = W.fact_order_reviews(typed, o, "before_join")
    assert rows(after, "review_id", "review_score", "review_comment_title") == [("r1", 5, "")]
    assert before.count() == 0


def test_products_translation_paths(spark):
    prod = raw(spark, "products", [("p1", "pc_gamer", "10", "20", "1", "1.5", "1", "2", " "),
                                   ("p2", "", "10", "20", "1", "1.5", "1", "2", "3"),
                                   ("p3", "casa", "x", "20", "1", "1.5", "1", "2", "3")])
    tr = raw(spark, "product_category_name_translation", [("casa", "home"), ("casa", "house"), ("pc_gamer", "PC")])
    text_path = rows(S.clean_products(prod, S.clean_translation(tr)), "product_id", "product_category_name_english",
                     "product_name_lenght")
    assert text_path == [("p1", "PC", 10), ("p2", "unknown", 10), ("p3", "home", None)]
    typed_path = rows(S.clean_products_pg(prod, tr), "product_id", "product_category_name",
                      "product_category_name_english", "product_width_cm")
    assert typed_path == [("p1", "pc_gamer", "PC", None), ("p2", "uncategorized", "Uncategorized", Decimal("3.0000")),
                          ("p3", "casa", "home", Decimal("3.0000"))]
    seeds = rows(S.category_lookup(tr.limit(0)))
    assert ("pc_gamer", "Gaming PC") in seeds and len(seeds) == 2


def test_cleaners_are_idempotent(fx):
    cust = S.clean_customers(fx["customers_raw"])
    again = S.clean_customers(cust.fillna(" "))  # a NULL id re-enters as blank text
    assert again.count() == cust.count()
    items = S.clean_order_items(fx["order_items_raw"])
    re_raw = items.drop("total_amount").selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in items.columns
                                                     if c != "total_amount"])
    assert S.clean_order_items(re_raw).exceptAll(items).count() == 0


def test_geolocation_distinct(fx):
    g = S.clean_geolocation(fx["geolocation_raw"])
    assert g.count() == g.distinct().count() == 25
    assert all(not r["geolocation_city"].startswith(" ") for r in g.collect())
