import json

import pytest

from mercato.sources.readers import read_dir, read_every, read_raw_csv, require_sources
from mercato.sources.sinks import append_batch, export_csv, refresh, to_json_rows, write_counted


def test_raw_csv_keeps_text_quotes_newlines(spark, tmp_path):
    p = tmp_path / "order_reviews.csv"
    p.write_text(' Review_ID ,ORDER_ID,review_score,review_comment_title,review_comment_message,'
                 'review_creation_date,review_answer_timestamp\n'
                 'r1,o1,5,"say ""hi""","line one\nline two",2018-01-01 00:00:00,\n'
                 'r2,o2,4,,,2018-01-02 00:00:00,\n')
    df = read_raw_csv(spark, str(p), multi_line=True)  # header-driven columns, trimmed and lower-cased
    assert df.columns[:2] == ["review_id", "order_id"]
    assert read_raw_csv(spark, str(p), "order_reviews").count() == 2  # the review table is multi-line by default
    got = {r["review_id"]: r for r in df.collect()}
    assert len(got) == 2
    assert got["r1"]["review_comment_title"] == 'say "hi"'
    assert got["r1"]["review_comment_message"] == "line one\nline two"
    assert all(f.dataType.typeName() == "string" for f in df.schema.fields)


def test_leading_zero_zip_stays_text(spark, tmp_path):
    p = tmp_path / "customers.csv"
    p.write_text("customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
                 "c1,u1,01037,sp,SP\n")
    assert read_raw_csv(spark, str(p), "customers").collect()[0]["customer_zip_code_prefix"] == "01037"


def test_require_sources_and_read_dir(spark, tmp_path):
    (tmp_path / "orders.csv").write_text("order_id\n1\n")
    (tmp_path / "notes.csv").write_text('id, Note\n1,"two\nlines"\n')
    with pytest.raises(FileNotFoundError):
        require_sources(spark, str(tmp_path), ["orders", "customers"])
    with pytest.raises(FileNotFoundError):
        require_sources(spark, str(tmp_path / "nope"), ["orders"])
    with pytest.raises(FileNotFoundError, match="customers"):  # no other mode when a file is missing
        read_dir(spark, str(tmp_path))
    every = read_every(spark, str(tmp_path))
    assert sorted(every) == ["notes_raw", "orders_raw"] and every["orders_raw"].count() == 1
    assert every["notes_raw"].columns == ["id", "note"] and every["notes_raw"].collect()[0]["note"] == "two\nlines"


def test_columns_are_bound_by_header(spark, tmp_path):
    (tmp_path / "people.csv").write_text("Customer_State,customer_id, customer_unique_id,customer_zip_code_prefix,customer_city,extra\n"
                                         "SP,c1,u1,01037,sao paulo,x\n")
    got = read_raw_csv(spark, str(tmp_path / "people.csv"), "customers", partitions=2)
    assert got.columns[0] == "customer_id" and "extra" not in got.columns
    assert got.collect()[0].asDict() == {"customer_id": "c1", "customer_unique_id": "u1", "customer_zip_code_prefix": "01037",
                                         "customer_city": "sao paulo", "customer_state": "SP"}
    assert got.rdd.getNumPartitions() == 2
    (tmp_path / "short.csv").write_text("customer_id,customer_state\nc1,SP\n")
    with pytest.raises(ValueError, match="customer_city"):
        read_raw_csv(spark, str(tmp_path / "short.csv"), "customers")


def test_renamed_files(spark, tmp_path):
    from mercato.schemas import RAW_COLUMNS
    for table, columns in RAW_COLUMNS.items():
        (tmp_path / f"olist_{table}_x.csv").write_text(",".join(columns) + "\n" + ",".join(f'"{c}\nx"' if table == "order_reviews" else c for c in columns) + "\n")
    got = read_dir(spark, str(tmp_path), {t: f"olist_{t}_x" for t in RAW_COLUMNS})
    assert sorted(got) == sorted(f"{t}_raw" for t in RAW_COLUMNS) and all(df.count() == 1 for df in got.values())
    with pytest.raises(ValueError, match="unknown"):
        read_dir(spark, str(tmp_path), {"nothing": "x"})


def test_refresh_twice_equals_once(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 3 AS g")
    refresh(df, str(tmp_path / "t"))
    refresh(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10


def test_append_batch_is_replay_safe(spark, tmp_path):
    path = str(tmp_path / "kpi")
    b1 = spark.createDataFrame([(1, 10), (2, 20)], "batch_id int, v int")
    append_batch(b1, path)
    append_batch(spark.createDataFrame([(2, 21)], "batch_id int, v int"), path)  # batch 2 replayed
    append_batch(spark.createDataFrame([(3, 30)], "batch_id int, v int"), path)
    got = sorted((r["batch_id"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, 10), (2, 21), (3, 30)]


def test_counted_write_and_exports(spark, tmp_path):
    df = spark.range(7).selectExpr("id", "current_date() AS d")
    assert write_counted(df, str(tmp_path / "c")) == 7
    j = [json.loads(r["value"]) for r in to_json_rows(df).collect()]
    assert isinstance(j[0]["d"], str) and len(j) == 7
    export_csv(df, str(tmp_path / "csv"), single_file=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 7


def test_save_table_creates_database(spark):
    from mercato.sources.sinks import save_table
    save_table(spark.range(3), "mercato_test_db.t3")
    assert spark.table("mercato_test_db.t3").count() == 3
    save_table(spark.range(5).selectExpr("id", "id AS x"), "mercato_test_db.t3")  # drop-and-create semantics
    assert spark.table("mercato_test_db.t3").columns == ["id", "x"]


def test_read_typed_keeps_values_untrimmed(spark, tmp_path):
    from mercato.sources.readers import read_typed
    p = tmp_path / "order_payments.csv"
    p.write_text("order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
                 'o1,1," credit_card ",,10.5\n')
    r = read_typed(spark, str(p), "order_payments").collect()[0]
    assert r["payment_type"] == " credit_card " and r["payment_installments"] is None and r["payment_value"] == "10.5"


def test_partitioned_refresh_replaces_only_present_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    refresh(spark.range(9).selectExpr("id", "id % 3 AS g"), path, partition_by=["g"], sort_within=["id"])
    refresh(spark.createDataFrame([(100, 1)], "id bigint, g bigint"), path, partition_by=["g"])
    got = sorted((r["g"], r["id"]) for r in spark.read.parquet(path).collect())
    assert got == [(0, 0), (0, 3), (0, 6), (1, 100), (2, 2), (2, 5), (2, 8)]
