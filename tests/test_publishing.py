"""Published versions, and the gate before them: readers see whole versions or the one before."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mercato.operators.quality import QualityError
from mercato.plans import pipeline as P
from mercato.sources.publishing import PublishConflict, Run, history, prune, read_published, resolve

ROOT = Path(__file__).resolve().parents[1]


def _publish(spark, root, value, gate=None):
    run = Run(spark, root)
    run.write("a", spark.createDataFrame([(value,)], "x int"))
    run.write("b", spark.createDataFrame([(value,), (value,)], "x int"))
    return run.publish(gate)


def _values(tables):
    return {n: sorted(r[0] for r in df.collect()) for n, df in tables.items()}


def test_versions_are_whole_and_older_ones_stay(spark, tmp_path):
    root = str(tmp_path / "w")
    assert resolve(spark, root) is None and history(spark, root) == []
    with pytest.raises(FileNotFoundError):
        read_published(spark, root)
    assert _publish(spark, root, 1).number == 1 and _publish(spark, root, 2).number == 2
    assert _values(read_published(spark, root)) == {"a": [2], "b": [2, 2]}
    assert _values(read_published(spark, root, 1)) == {"a": [1], "b": [1, 1]}
    with pytest.raises(KeyError):
        resolve(spark, root, 9)


def test_a_reader_keeps_its_version_while_the_next_is_published(spark, tmp_path):
    root = str(tmp_path / "w")
    _publish(spark, root, 1)
    held = read_published(spark, root)
    _publish(spark, root, 2)
    assert _values(held) == {"a": [1], "b": [1, 1]}


def test_a_failing_gate_publishes_nothing(spark, tmp_path):
    root = str(tmp_path / "w")
    _publish(spark, root, 1)

    def gate(tables):
        if tables["a"].first()[0] == 2:
            raise QualityError("two")
    with pytest.raises(QualityError):
        _publish(spark, root, 2, gate)
    assert history(spark, root) == [1] and _values(read_published(spark, root))["a"] == [1]
    assert _publish(spark, root, 3, gate).number == 2


def test_of_two_runs_at_once_the_second_fails(spark, tmp_path):
    root = str(tmp_path / "w")
    one, two = Run(spark, root), Run(spark, root)
    for run, value in ((one, 1), (two, 2)):
        run.write("a", spark.createDataFrame([(value,)], "x int"))
    one.publish()
    with pytest.raises(PublishConflict):
        two.publish()
    assert _values(read_published(spark, root)) == {"a": [1]}
    assert [p.name for p in (tmp_path / "w" / "published").iterdir() if "draft" in p.name] == []


def test_parts_and_kept_tables_are_shared(spark, tmp_path):
    root = str(tmp_path / "w")

    def rows(values):
        return spark.createDataFrame([(v, v % 4) for v in values], "x int, p int")
    run = Run(spark, root)
    run.write_parts("t", rows(range(40)), "p", range(4))
    run.write("other", rows([7]))
    first = run.publish()
    run = Run(spark, root)
    run.write_parts("t", rows([41]).where("p = 1"), "p", [1, 3])  # part 3 becomes empty
    run.keep("other")
    second = run.publish()
    assert sorted(r[0] for r in second.read(spark, "t").collect()) == sorted([x for x in range(40) if x % 4 in (0, 2)] + [41])
    assert len(set(first.tables["t"].paths) & set(second.tables["t"].paths)) == 2 and second.tables["other"] == first.tables["other"]
    assert second.read(spark, "t").columns == ["x"]
    with pytest.raises(ValueError, match="not replaced"):
        Run(spark, root).write_parts("t", rows([1]), "p", [0])
    # pruning the first version leaves the folders that the second names
    assert prune(spark, root, keep=1) == [1] and history(spark, root) == [2]
    assert second.read(spark, "t").count() == 21 and second.read(spark, "other").count() == 1


def test_prune_keeps_runs_that_may_still_be_writing(spark, tmp_path):
    root = str(tmp_path / "w")
    for k in range(4):
        _publish(spark, root, k)
    busy = Run(spark, root)
    busy.write("a", spark.createDataFrame([(9,)], "x int"))
    assert prune(spark, root, keep=2) == [1, 2]
    assert (tmp_path / "w" / "versions" / busy.id).exists() and len(list((tmp_path / "w" / "versions").iterdir())) == 3
    prune(spark, root, keep=2, abandoned_after=-1)
    assert not (tmp_path / "w" / "versions" / busy.id).exists() and _values(read_published(spark, root))["a"] == [3]


CHILD = """
import os, sys
sys.path.insert(0, {repo!r})
from mercato.session import get_session
from mercato.sources.publishing import Run
spark = get_session("local[2]", 2)
run = Run(spark, {root!r})
run.write("a", spark.createDataFrame([(2,)], "x int"))
if {late}:
    run.write("b", spark.createDataFrame([(2,), (2,)], "x int"))
    import mercato.sources.publishing as P
    P._Files.rename_new = lambda *a: os._exit(9)  # the pointer's draft is there, its name is not
    run.publish()
os._exit(9)
"""


@pytest.mark.parametrize("late", [False, True])
def test_a_killed_run_leaves_readers_on_the_old_version(spark, tmp_path, late):
    """Killed between two tables, and killed just before the rename."""
    root = str(tmp_path / "w")
    _publish(spark, root, 1)
    done = subprocess.run([sys.executable, "-c", CHILD.format(repo=str(ROOT), root=root, late=late)], capture_output=True, text=True, timeout=300)
    assert done.returncode == 9, done.stderr[-2000:]
    assert history(spark, root) == [1] and _values(read_published(spark, root)) == {"a": [1], "b": [1, 1]}
    assert _publish(spark, root, 3).number == 2 and _values(read_published(spark, root))["b"] == [3, 3]


def test_pipeline_publishes_after_its_gates(spark, fx, tmp_path, monkeypatch):
    root = str(tmp_path / "w")
    version, log = P.publish_pipeline(spark, fx, root, orphans="report")
    assert version.number == 1 and "wall.publish" in log.seconds
    assert all(m.startswith("foreign key fact_order_items.customer_id: ") for m in version.notes["orphans"])
    before = P.read_warehouse(spark, root)["agg_sales_daily"].collect()
    # a run whose facts hold a key twice: the gate names it, and readers stay
    from mercato.plans.build import WarehouseBuild
    good = WarehouseBuild.fact_order_payments.func
    monkeypatch.setattr(WarehouseBuild, "fact_order_payments", property(lambda self: good(self).unionByName(good(self).limit(1))))
    with pytest.raises(QualityError, match=r"primary key fact_order_payments\(order_id, payment_sequential\): 1 keys .* 1 rows too many"):
        P.publish_pipeline(spark, fx, root, orphans="report")
    assert history(spark, root) == [1] and P.read_warehouse(spark, root)["agg_sales_daily"].collect() == before


def test_gate_names_orphans(spark):
    from mercato.operators.quality import assert_keys
    from mercato.schemas import SCHEMAS
    dates = spark.createDataFrame([(20200101,)], "date_key int").select("date_key", *[F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMAS["dim_date"].fields[1:]])
    pay = spark.createDataFrame([("o", 1, 20200101, "x", 1, None), ("p", 1, 20200102, "x", 1, None), ("q", 1, None, "x", 1, None)], SCHEMAS["fact_order_payments"])
    with pytest.raises(QualityError, match=r"foreign key fact_order_payments.order_purchase_date_key: 1 rows .*\[20200102\]"):
        assert_keys({"fact_order_payments": pay, "dim_date": dates})
    assert assert_keys({"fact_order_payments": pay.where("order_id <> 'p'"), "dim_date": dates}) == {"orphans": []}
    assert len(assert_keys({"fact_order_payments": pay, "dim_date": dates}, "report")["orphans"]) == 1
