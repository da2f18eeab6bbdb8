from mercato.operators.dedup import excess_rows, excess_rows_by, keep_first, latest_per_key
from mercato.operators.relational import dense_index

from conftest import rows


def test_keep_first_tie_break_is_total(spark):
    df = spark.createDataFrame([("k", "b", 2), ("k", "a", 9), ("k", None, 5), ("j", "z", 1)], "k string, v string, n int")
    got = rows(keep_first(df, ["k"]))
    assert got == [("j", "z", 1), ("k", None, 5)]  # NULLs first in the tie-break


def test_latest_per_key_nulls_last(spark):
    df = spark.createDataFrame([("r", None, 1), ("r", 5, 2), ("r", 7, 3), ("s", None, 4)], "k string, t int, x int")
    got = rows(latest_per_key(df, ["k"], ["t"]))
    assert got == [("r", 7, 3), ("s", None, 4)]


def test_keep_first_null_key_is_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert rows(keep_first(df, ["k"])) == [("a", 3), (None, 1)]


def test_keep_first_plans_partial_group_limit(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = keep_first(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_excess_rows_null_safe(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1), ("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    assert df.agg(excess_rows(df, ["k"]).alias("e")).collect()[0]["e"] == 3  # NULL dup 1 + triplicate 2
    assert df.agg(excess_rows(df).alias("e")).collect()[0]["e"] == 3
    by = excess_rows_by(df.withColumn("g", df.v), ["g"], ["k"])
    assert rows(by) == [(1, 3), (2, 0)]


def test_dense_index_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, 7).selectExpr("CAST(id AS STRING) AS s")
    got = dense_index(df, ["s"], "i").collect()
    ordered = sorted(r["s"] for r in got)
    assert sorted(r["i"] for r in got) == list(range(1, len(ordered) + 1))
    assert {r["s"]: r["i"] for r in got} == {s: i + 1 for i, s in enumerate(ordered)}
