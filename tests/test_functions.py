import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from mercato import functions as X


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).collect()[0]["r"]


def test_clean_text_blank_and_padding(spark):
    df = spark.createDataFrame([("",), ("   ",), (None,), (" x ",), ("\tx\t",)], "v string")
    got = [r["r"] for r in df.select(X.clean_text("v").alias("r")).collect()]
    assert got == [None, None, None, "x", "\tx\t"]  # only spaces are trimmed


def test_typed_casts_never_fail(spark):
    assert one(spark, X.to_int("v"), "x") is None
    assert one(spark, X.to_int("v"), " 12 ") == 12
    assert one(spark, X.to_int("v"), "12.5") is None
    assert one(spark, X.to_decimal("v"), "-3.456") == Decimal("-3.46")
    assert one(spark, X.to_timestamp("v"), "2018-02-30 00:00:00") is None
    assert one(spark, X.to_timestamp("v"), "2018-02-28 10:11:12") == dt.datetime(2018, 2, 28, 10, 11, 12)
    assert one(spark, X.to_timestamp("v"), " ") is None


def test_payment_type_normalisation(spark):
    df = spark.createDataFrame([("not_defined",), ("NOT_DEFINED",), (None,), ("voucher",), (" Not_Defined ",)], "v string")
    got = [r["r"] for r in df.select(X.normalise_payment_type("v").alias("r")).collect()]
    assert got == ["unknown", "unknown", None, "voucher", "unknown"]
    other = [r["r"] for r in df.select(X.normalise_payment_type("v", "other").alias("r")).collect()]
    assert other[0] == "other"


def test_stock_status_buckets(spark):
    df = spark.createDataFrame([(0, 10), (5, 10), (10, 10), (None, 10)], "q int, r int")
    sql = [r["s"] for r in df.select(X.stock_status("q", "r", null_qty_in_stock=True).alias("s")).collect()]
    mb = [r["s"] for r in df.select(X.stock_status("q", "r").alias("s")).collect()]
    assert sql == ["Out of Stock", "Low Stock", "In Stock", "In Stock"]
    assert mb == ["Out of Stock", "Low Stock", "In Stock", None]


def test_hashes_known_values(spark):
    assert one(spark, X.crc32_hash("v"), "abc") == 891568578
    assert one(spark, X.md5_prefix("v"), "abc") == 2416005272
    qty, reorder = X.pseudo_stock(F.col("v"))
    assert one(spark, qty, "abc") == 891568578 % 500
    assert one(spark, reorder, "abc") == 891568578 % 80 + 20


def test_snapshot_stock_draws_from_lists(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("p"), F.lit("s").alias("s"))
    qty, reorder = X.snapshot_stock("p", "s")
    got = df.select(qty.alias("q"), reorder.alias("r")).collect()
    assert {r["q"] for r in got} <= set(X.hashing.STOCK_CHOICES)
    assert {r["r"] for r in got} <= set(X.hashing.REORDER_CHOICES)
    zero_share = sum(r["q"] == 0 for r in got) / len(got)
    assert 0.2 < zero_share < 0.35  # 3 of 11 choices are 0


def test_date_helpers(spark):
    days = [dt.date(2018, 9, 2), dt.date(2018, 9, 1), dt.date(2018, 9, 3), dt.date(2016, 2, 29), dt.date(2017, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(X.date_key("d").alias("k"), X.iso_dow("d").alias("w"), X.is_weekend("d").alias("e"),
                    X.month_name("d").alias("m"), X.day_name("d").alias("n")).collect()
    assert [r["k"] for r in got] == [20180902, 20180901, 20180903, 20160229, 20171231]
    assert [r["w"] for r in got] == [7, 6, 1, 1, 7]
    assert [r["e"] for r in got] == [True, True, False, False, True]
    assert got[3]["m"] == "February" and got[0]["n"] == "Sunday"


def test_exact_rounding(spark):
    from mercato.functions import mean, percentage, ratio
    df = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),)], "v decimal(10,2)")
    assert df.agg(mean("v").alias("m")).collect()[0]["m"] == Decimal("0.02")  # 0.015 -> half-up
    ints = spark.createDataFrame([(1,), (2,)], "v int")
    assert ints.agg(mean("v", integral=True).alias("m")).collect()[0]["m"] == Decimal("1.50")
    z = spark.createDataFrame([(Decimal("5"), 0)], "n decimal(10,2), d bigint")
    assert z.select(ratio(F.col("n"), F.col("d")).alias("r")).collect()[0]["r"] is None
    p = spark.createDataFrame([(1, 3)], "a bigint, b bigint")
    assert p.select(percentage(F.col("a"), F.col("b")).alias("p")).collect()[0]["p"] == Decimal("33.33")


def test_batch_labels(spark):
    from mercato.functions import batch_id_from_path, batch_label
    df = spark.createDataFrame([(7, "landing/orders_batch_0007.csv"), (12345, "x/other.csv")], "b int, p string")
    got = df.select(batch_label("b").alias("l"), batch_id_from_path("p").alias("i")).collect()
    assert [(r["l"], r["i"]) for r in got] == [("0007", 7), ("12345", None)]
