"""Property tests: dedup and duplicate counting against plain-Python models on random small tables."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from mercato.operators.dedup import excess_rows, keep_first, latest_per_key

from conftest import rows

KEYS = st.sampled_from(["a", "b", "c", None])
VALS = st.one_of(st.none(), st.integers(min_value=-3, max_value=3))
TABLE = st.lists(st.tuples(KEYS, VALS, VALS), min_size=0, max_size=25)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _sort_key(v, nulls_first=True):
    return (0, 0) if v is None and nulls_first else (2, 0) if v is None else (1, v)


@SETTINGS
@given(TABLE)
def test_keep_first_matches_model(spark, data):
    df = spark.createDataFrame(data, "k string, x int, y int")
    got = rows(keep_first(df, ["k"], ["x"]))
    best = {}
    for r in data:
        key = (_sort_key(r[1]), _sort_key(r[2]))
        if r[0] not in best or key < best[r[0]][0]:
            best[r[0]] = (key, r)
    assert got == sorted((v[1] for v in best.values()), key=repr)


@SETTINGS
@given(TABLE)
def test_latest_per_key_matches_model(spark, data):
    df = spark.createDataFrame(data, "k string, x int, y int")
    got = rows(latest_per_key(df, ["k"], ["x"]))
    best = {}
    for r in data:
        # x descending with NULLs last, then y ascending with NULLs first
        key = ((0, -r[1]) if r[1] is not None else (1, 0), _sort_key(r[2]))
        if r[0] not in best or key < best[r[0]][0]:
            best[r[0]] = (key, r)
    assert got == sorted((v[1] for v in best.values()), key=repr)


@SETTINGS
@given(TABLE)
def test_excess_rows_matches_pandas_duplicated(spark, data):
    df = spark.createDataFrame(data, "k string, x int, y int")
    pdf = pd.DataFrame(data, columns=["k", "x", "y"], dtype=object)
    by_key = df.agg(excess_rows(df, ["k"]).alias("e")).collect()[0]["e"]
    whole = df.agg(excess_rows(df).alias("e")).collect()[0]["e"]
    assert by_key == int(pdf.duplicated(subset=["k"]).sum())
    assert whole == int(pdf.duplicated().sum())
