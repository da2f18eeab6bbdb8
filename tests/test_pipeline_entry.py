from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from mercato.plans.pipeline import read_warehouse, run_microbatch, run_pipeline

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def warehouse(spark, fx, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wh"))
    log = run_pipeline(spark, fx, root)
    return log, read_warehouse(spark, root)


def test_pipeline_writes_every_layer(warehouse):
    log, wh = warehouse
    assert log.rows["dw.fact_order_items"] == wh["fact_order_items"].count() > 0
    assert set(wh) >= {"agg_sales_daily", "agg_sales_monthly", "agg_inventory", "agg_payment_methods",
                       "agg_reviews_monthly"}


def test_invariants(warehouse):
    _, wh = warehouse
    daily, monthly = wh["agg_sales_daily"], wh["agg_sales_monthly"]
    fact = wh["fact_order_items"]
    d = daily.agg(F.sum("total_items_sold"), F.sum("total_revenue")).collect()[0]
    m = monthly.agg(F.sum("total_items_sold"), F.sum("total_revenue")).collect()[0]
    assert d[0] == fact.count() == m[0]
    assert d[1] == m[1]
    r = wh["agg_reviews_monthly"]
    assert r.filter("score_1 + score_2 + score_3 + score_4 + score_5 > total_reviews").count() == 0
    from mercato.plans.reads import score_distribution
    total_pct = score_distribution(wh["fact_order_reviews"]).agg(F.sum("percentage")).collect()[0][0]
    assert abs(total_pct - Decimal("100")) <= Decimal("0.05")


def test_pipeline_rerun_is_idempotent(spark, fx, tmp_path):
    root = str(tmp_path)
    run_pipeline(spark, fx, root, parallel=1)
    first = read_warehouse(spark, root)["agg_sales_daily"].collect()
    run_pipeline(spark, fx, root)
    assert sorted(read_warehouse(spark, root)["agg_sales_daily"].collect()) == sorted(first)


def test_microbatch_run(spark, fx, tmp_path):
    log = run_microbatch(spark, fx, str(tmp_path))
    orders = fx["stream_orders"]
    assert log.rows["batches/orders"] == orders.filter("order_purchase_timestamp IS NOT NULL").count()
    summary = spark.read.parquet(str(tmp_path / "batch_summary"))
    assert log.rows["batch_summary"] == summary.count() == summary.select("batch_id").distinct().count() > 0
    assert summary.agg(F.sum("total_orders")).collect()[0][0] == log.rows["batches/orders"]
    assert log.rows["daily_summary"] > 0 and log.rows["run_summary"] == 1


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "avg_order_value" in df.columns


def _duck(sf_dir):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_commerce_query_has_an_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql()) and set(E._QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", ["agg_sales_daily", "batch_summary", "score_distribution", "fk_checks",
                                  "clean_products_pg", "monthly_summary", "top_sellers", "inventory_snapshot"])
def test_oracle_agrees_at_smallest_scale(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = _duck(SF_SMALL).execute(E.oracle_sql()[name])
    dcols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(dcols)

    def bag(cols, data):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        return Counter(tuple(repr(r[i]) for i in order) for r in data)

    assert bag(df.columns, df.collect()) == bag(dcols, res.fetchall())


def test_command_line_run(spark, tmp_path, capsys):
    from mercato.__main__ import main
    assert main(["run", "--fixtures", SF_SMALL, "--out", str(tmp_path / "wh"), "--parallel", "2", "--orphans", "report"]) == 0
    out = capsys.readouterr().out
    assert '"dw.agg_sales_daily"' in out
    assert '"version": 1' in out
    assert read_warehouse(spark, str(tmp_path / "wh"))["agg_sales_monthly"].count() > 0
