"""Control totals: taken while writing, balanced rule by rule and from table to table."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercato.operators.quality import QualityError, quality_checks
from mercato.plans import pipeline as P
from mercato.plans.warehouse import item_flow, payment_flow
from mercato.sources.ledger import Ledger, LedgerError, Totals

SCHEMA = "id string, v decimal(10,2), rule string"
TOTALS = Totals(["v"], ["id"], ["v"])


def _write(spark, path, rows, **kw):
    ledger, rules = Ledger(), {"negative": F.col("v") < 0, "no id": F.col("id").isNull()}
    kept = ledger.write(spark.createDataFrame(rows, SCHEMA), str(path), "t", TOTALS, rules, **kw)
    return ledger, kept


def test_totals_by_rule(spark, tmp_path):
    rows = [("a", Decimal("1.50"), "x"), ("b", Decimal(-2), None), (None, Decimal(-3), None), (None, Decimal(4), ""), ("c", None, "y")]
    ledger, kept = _write(spark, tmp_path / "t", rows)
    assert kept == 2 and {r["id"] for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {"a", "c"}
    assert spark.read.parquet(str(tmp_path / "t")).columns == ["id", "v", "rule"]
    got = {(f, r, t): v for _, f, r, t, v in ledger.entries}
    assert got["in", "", "rows"] == 5 and got["in", "", "sum v"] == Decimal("0.50") and got["in", "", "null id"] == 2
    assert got["kept out", "negative", "rows"] == 2 and got["kept out", "negative", "sum v"] == -5  # the first rule that holds
    assert got["kept out", "no id", "rows"] == 1 and got["kept out", "no id", "sum v"] == 4
    assert got["out", "", "rows"] == 2 and got["out", "", "sum v"] == Decimal("1.50") and got["out", "", "negative v"] == 0
    ledger.balance()
    assert ledger.frame(spark).count() == len(ledger.entries) == 16
    assert all(passed for *_, passed in ledger.checks(["t"]))


def test_an_empty_table_has_zeros(spark, tmp_path):
    ledger, kept = _write(spark, tmp_path / "t", [])
    assert kept == 0 and len(ledger.entries) == 16 and {e[-1] for e in ledger.entries} == {0}
    ledger.balance()
    assert ledger.checks(["t"])[0] == ("t rows", 0, False)


def test_a_loss_while_finishing_does_not_balance(spark, tmp_path):
    ledger, _ = _write(spark, tmp_path / "t", [("a", Decimal(1), "x"), ("b", Decimal(2), "x")], finish=lambda df: df.where("id <> 'b'"))
    with pytest.raises(LedgerError, match="t: rows: 2.00 in, 1.00 out, 0.00 kept out"):
        ledger.balance()


def test_flows_equal_the_facts(spark, fx, tmp_path):
    from mercato.plans.build import WarehouseBuild
    b = WarehouseBuild(fx)
    for name, staged, flow in (("fact_order_items", b.order_items, item_flow(b.order_items, b.orders)),
                               ("fact_order_payments", b.payments, payment_flow(b.payments, b.orders))):
        ledger = Ledger()
        rows, rules, finish = flow
        n = ledger.write(rows, str(tmp_path / name), name, P.TOTALS[name], rules, finish)
        got, want = spark.read.parquet(str(tmp_path / name)), getattr(b, name)
        assert got.columns == want.columns and n == want.count() > 0
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
        assert ledger.value(name, "in", "rows") == staged.count()


def test_repeated_orders_are_noticed(spark, fx, tmp_path):
    """A join that multiplies rows balances in itself, but not with its source."""
    from mercato.plans.build import WarehouseBuild
    b, ledger = WarehouseBuild(fx), Ledger()
    ledger.write(b.order_items, str(tmp_path / "s"), "order_items", P.TOTALS["order_items"])
    rows, rules, finish = item_flow(spark.read.parquet(str(tmp_path / "s")), b.orders.unionByName(b.orders.limit(1)))
    ledger.write(rows, str(tmp_path / "f"), "fact_order_items", P.TOTALS["fact_order_items"], rules, finish)
    ledger.balance()
    with pytest.raises(LedgerError, match="out of order_items"):
        ledger.balance(P.MADE_OF)


def test_the_pipeline_keeps_its_ledger(spark, fx, tmp_path):
    log = P.run_pipeline(spark, fx, str(tmp_path))
    kept = spark.read.parquet(str(tmp_path / "ledger"))
    assert {tuple(r) for r in kept.collect()} == set(log.ledger.entries)
    for name, wh in P.read_warehouse(spark, str(tmp_path)).items():
        assert log.ledger.value(name, "out", "rows") == wh.count()
    # the gate's values are those of the checks that read the tables
    wh = P.read_warehouse(spark, str(tmp_path))
    plain = {(r["check"], r["value"], r["passed"]) for r in quality_checks(
        wh["fact_order_items"], wh["dim_customers"], wh["dim_products"], wh["dim_date"]).collect()}
    ours = {(c.removeprefix("fact_order_items ") if not c.endswith(" rows") else c, v, ok) for c, v, ok in log.ledger.checks(P.FILLED)}
    assert plain <= ours


def test_a_fact_built_in_another_way_is_written_as_it_is(fx):
    from mercato.plans.build import WarehouseBuild

    class Other(WarehouseBuild):
        @property
        def fact_order_items(self):
            return None
    assert Other(fx).flow("fact_order_items") is None and Other(fx).flow("dim_date") is None
    assert Other(fx).flow("fact_order_payments") and WarehouseBuild(fx).flow("fact_order_items")


def test_the_gate_stops_on_bad_totals():
    ledger = Ledger([(n, "out", "", "rows", Decimal(1)) for n in P.FILLED] + [("fact_order_items", "out", "", "negative price", Decimal(2))])
    with pytest.raises(QualityError, match="fact_order_items negative price = 2"):
        P.assert_ledger(ledger)
