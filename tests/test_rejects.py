"""The rejects channel: every line is kept or rejected, once, with its place and reason."""

import pytest

from mercato.sources.readers import read_raw_csv
from mercato.sources.rejects import RejectsError, load_dir_with_rejects, load_with_rejects

PAY = "order_id,payment_sequential,payment_type,payment_installments,payment_value"


def _file(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_broken_lines_appear_once_with_line_and_reason(spark, tmp_path):
    lines = [PAY, "o1,1,card,2,10.50", 'o2,1,"a, b",1,1.00', "o3,1,card", "o4,1,card,1,5,6", '"o5,1,card,1,2', "", "o6,1,card,x,2", " ,1,card,1,2", "o8,,,,", "o9,1,,,", 'o"7"']
    path = _file(tmp_path, "order_payments.csv", "\n".join(lines) + "\n")
    got = load_with_rejects(spark, path, "order_payments", str(tmp_path / "out"), max_share=None)
    assert got.n_rows == 3 and sorted(r["order_id"] for r in got.rows.collect()) == ["o1", "o2", "o9"]
    assert {r["payment_type"] for r in got.rows.collect()} == {"card", "a, b", None}
    found = {(r["line"], r["reason"], r["raw"]) for r in got.rejects.collect()}
    assert found == {(4, "fields: 3 of 5", "o3,1,card"), (5, "fields: 6 of 5", "o4,1,card,1,5,6"), (6, "unclosed quote", '"o5,1,card,1,2'),
                     (8, "not int: payment_installments", "o6,1,card,x,2"), (9, "blank: order_id", " ,1,card,1,2"),
                     (10, "blank: payment_sequential", "o8,,,,"), (12, "fields: 1 of 5", 'o"7"')}
    assert got.n_rejects == got.rejects.count() == 7 and all(r["file"].endswith("order_payments.csv") for r in got.rejects.collect())
    assert got.n_rows + got.n_rejects == len([x for x in lines[1:] if x])
    loose = load_with_rejects(spark, path, "order_payments", str(tmp_path / "loose"), strict=False, max_share=None)
    assert loose.n_rejects == 4 and loose.n_rows == 6


def test_accepted_rows_equal_the_plain_reader(spark, tmp_path):
    text = "\r\n".join(["Payment_Value, order_id ,payment_sequential,payment_type,payment_installments", '1.0," o1 ",1,"say ""hi""",2', ',o2,1,"",3', "007,o3,2,x,"]) + "\r\n"
    path = _file(tmp_path, "order_payments.csv", text)
    got = load_with_rejects(spark, path, "order_payments", str(tmp_path / "out"))
    plain = read_raw_csv(spark, path, "order_payments")
    assert sorted(map(str, got.rows.collect())) == sorted(map(str, plain.collect())) and got.n_rejects == 0


def test_line_numbers_over_many_blocks(spark, tmp_path):
    rows = [PAY] + [f"o{k},1,card,1,{k}.00" if k % 97 else f"o{k},1" for k in range(20_000)]
    path = _file(tmp_path, "order_payments.csv", "\n".join(rows))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30k")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 8
        got = load_with_rejects(spark, path, "order_payments", str(tmp_path / "out"), max_share=0.02)
        assert {(r["line"], r["raw"]) for r in got.rejects.collect()} == {(k + 1, r) for k, r in enumerate(rows) if r.count(",") == 1}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got.n_rows == 20_000 - 207


def test_too_many_rejects_fail_the_load(spark, tmp_path):
    path = _file(tmp_path, "order_payments.csv", PAY + "\n" + "o1,1,card,1,1\n" * 9 + "broken\n")
    with pytest.raises(RejectsError, match=r"1 of 10 rows rejected \(1 fields: 1 of 5\)"):
        load_with_rejects(spark, path, "order_payments", str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).where("kind = 'rejects'").count() == 1
    load_with_rejects(spark, path, "order_payments", str(tmp_path / "b"), max_share=0.1)
    with pytest.raises(RejectsError):
        load_with_rejects(spark, path, "order_payments", str(tmp_path / "c"), max_share=None, max_rejects=0)
    empty = load_with_rejects(spark, _file(tmp_path, "e.csv", PAY + "\n"), "order_payments", str(tmp_path / "d"))
    assert empty.n_rows == empty.n_rejects == 0 and empty.rejects.count() == 0


def test_records_with_line_breaks(spark, tmp_path):
    head = "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp"
    rows = [head, 'r1,o1,5,t,"two\nlines, and a comma",2018-01-01 00:00:00,2018-01-02 00:00:00', "r2,o2,4", "r3,o3,bad,,,,", "r4,o4,1,,,,"]
    got = load_with_rejects(spark, _file(tmp_path, "order_reviews.csv", "\n".join(rows)), "order_reviews", str(tmp_path / "o"), max_share=None)
    assert sorted((r["review_id"], r["review_comment_message"]) for r in got.rows.collect()) == [("r1", "two\nlines, and a comma"), ("r4", None)]
    assert sorted((r["line"], r["reason"]) for r in got.rejects.collect()) == [(2, "fields"), (3, "not int: review_score")]


def test_a_directory_of_exports(spark, tmp_path):
    from mercato.schemas import RAW_COLUMNS
    for table, columns in RAW_COLUMNS.items():
        _file(tmp_path, f"{table}.csv", ",".join(columns) + "\n" + ("x\n" if table == "sellers" else ""))
    rows, rejects = load_dir_with_rejects(spark, str(tmp_path), str(tmp_path / "out"), max_share=None)
    assert set(rows) == {f"{t}_raw" for t in RAW_COLUMNS} and all(df.count() == 0 for df in rows.values())
    assert [(r["table_name"], r["line"], r["reason"]) for r in rejects.collect()] == [("sellers", 2, "fields: 1 of 4")]
