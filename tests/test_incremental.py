import os
from decimal import Decimal

from pyspark.sql import functions as F

from mercato.plans.aggregates import agg_sales_daily
from mercato.plans.build import WarehouseBuild
from mercato.plans.incremental import (
    MONTH, apply_fact_delta, refresh_daily, refresh_monthly, write_fact_by_month,
)


def _mtimes(path):
    return {os.path.join(r, f): os.path.getmtime(os.path.join(r, f))
            for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_incremental_refresh_equals_full_recompute(spark, fx, tmp_path):
    b = WarehouseBuild(fx)
    fact_path, daily_path, monthly_path = (str(tmp_path / n) for n in ("fact", "daily", "monthly"))
    write_fact_by_month(b.fact_order_items, fact_path)
    dim_date = spark.createDataFrame(b.dim_date.collect(), b.dim_date.schema)
    all_months = spark.read.parquet(fact_path).select(MONTH).distinct()
    refresh_daily(spark, fact_path, dim_date, all_months, daily_path)
    before = _mtimes(daily_path)

    fact = spark.read.parquet(fact_path).drop(MONTH)
    month = fact.agg(F.min("order_purchase_date_key")).collect()[0][0] // 100
    changed = (fact.filter((F.col("order_purchase_date_key") / 100).cast("int") == month).limit(3)
               .withColumn("price", F.col("price") + F.lit(Decimal("1.00")))
               .withColumn("total_amount", F.col("total_amount") + F.lit(Decimal("1.00"))))
    delta = spark.createDataFrame(changed.collect(), changed.schema)
    months = apply_fact_delta(spark, fact_path, delta)
    refresh_daily(spark, fact_path, dim_date, months, daily_path)
    refresh_monthly(spark, daily_path, monthly_path)

    after = _mtimes(daily_path)
    untouched = [p for p in before if f"{MONTH}={month}" not in p]
    assert untouched and all(after.get(p) == before[p] for p in untouched)  # other months not rewritten

    new_fact = spark.read.parquet(fact_path).drop(MONTH)
    assert new_fact.count() == b.fact_order_items.count()
    full = agg_sales_daily(new_fact, dim_date)
    incremental = spark.read.parquet(daily_path).drop(MONTH).select(*full.columns)
    assert incremental.exceptAll(full).count() == 0 and full.exceptAll(incremental).count() == 0
    assert spark.read.parquet(monthly_path).agg(F.sum("total_items_sold")).collect()[0][0] == new_fact.count()


def _fact(spark, rows):
    """(order, item, date key, amount) rows as an item fact."""
    data = [(o, i, "c", "p", "s", d, "delivered", None, Decimal(a), Decimal(0), Decimal(a)) for o, i, d, a in rows]
    from mercato.schemas import SCHEMAS
    return spark.createDataFrame(data, SCHEMAS["fact_order_items"])


def test_moved_deleted_and_emptied_months(spark, tmp_path):
    from mercato.plans.warehouse import dim_date_calendar
    fact_path, daily_path = (str(tmp_path / n) for n in ("fact", "daily"))
    dim_date = dim_date_calendar(spark, "2018-01-01", "2018-04-30")
    write_fact_by_month(_fact(spark, [("o1", 1, 20180105, 10), ("o2", 1, 20180106, 20), ("o3", 1, 20180201, 5), ("o4", 1, 20180301, 7)]), fact_path)
    refresh_daily(spark, fact_path, dim_date, spark.read.parquet(fact_path).select(MONTH).distinct(), daily_path)

    def step(delta, deleted=None):
        months = apply_fact_delta(spark, fact_path, _fact(spark, delta), deleted)
        refresh_daily(spark, fact_path, dim_date, months, daily_path)
        fact = spark.read.parquet(fact_path).drop(MONTH)
        full = agg_sales_daily(fact, dim_date)
        got = spark.read.parquet(daily_path).drop(MONTH).select(*full.columns)
        assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
        return sorted((r["order_id"], r["order_purchase_date_key"]) for r in fact.collect())

    # o1 moves from January to February; o3's month loses its only other row
    assert step([("o1", 1, 20180202, 11)]) == [("o1", 20180202), ("o2", 20180106), ("o3", 20180201), ("o4", 20180301)]
    # the last row of January is deleted, March's moves to April
    gone = spark.createDataFrame([("o2", 1)], "order_id string, order_item_id int")
    assert step([("o4", 1, 20180401, 8)], gone) == [("o1", 20180202), ("o3", 20180201), ("o4", 20180401)]
    left = {r[0] for r in spark.read.parquet(daily_path).select(MONTH).distinct().collect()}
    assert left == {201802, 201804}


def test_months_are_few_files_however_many_tasks(spark, tmp_path):
    rows = [(f"o{k}", 1, 20180100 + 100 * (k % 3) + 1, 1) for k in range(600)]
    path = str(tmp_path / "fact")
    write_fact_by_month(_fact(spark, rows).repartition(40), path)
    assert len(_mtimes(path)) == 3 and spark.read.parquet(path).count() == 600
    # a hot month is split by size, not funnelled into one file
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")}
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
        write_fact_by_month(_fact(spark, [(f"o{k}", 1, 20180101, 1) for k in range(5000)]).repartition(40), path)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert 3 < len(_mtimes(path)) <= 40 and spark.read.parquet(path).count() == 5000


def test_sums_pass_a_trillion(spark):
    from mercato.plans.aggregates import agg_payment_methods, agg_sales_monthly
    from mercato.plans.reads import installment_distribution, payments_breakdown
    pay = spark.range(20_000).selectExpr("cast(id as string) order_id", "1 payment_sequential", "20180101 order_purchase_date_key",
                                         "'card' payment_type", "2 payment_installments", "cast(60000000.01 as decimal(10,2)) payment_value")
    got = agg_payment_methods(pay)
    assert got.collect()[0]["total_revenue"] == Decimal("1200000000200.00")
    assert payments_breakdown(got).collect()[0]["total_revenue"] == Decimal("1200000000200.00")
    assert installment_distribution(pay).collect()[0]["avg_value"] == Decimal("60000000.01")
    days = spark.createDataFrame([(d, 3_000_000, 3, Decimal("900000000000.05"), Decimal("1.00")) for d in range(1, 4)],
                                 "d int, total_orders long, total_items_sold long, total_revenue decimal(28,2), avg_order_value decimal(12,2)")
    days = days.withColumn("full_date", F.expr("make_date(2018, 1, d)"))
    row = agg_sales_monthly(days).collect()[0]
    assert row["total_revenue"] == Decimal("2700000000000.15") and row["avg_order_value"] == Decimal("300000.00")
