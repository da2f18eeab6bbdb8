"""Reading CSV with a rejects channel: broken lines are kept with file, line and reason instead of becoming NULLs (A1-A3, K4).

One pass over the files parses every line and writes it once, split by whether
it was accepted; readers of either side read only their folder. A line is
rejected when it has too few or too many fields or an unclosed quote, or when a
rule of its table fails (a required field is blank, a number or time cannot be
read). The load fails when the rejects pass a threshold, before anything is
published.

Line numbers cost no sort and no single task: lines carry the block of the file
that they were read from and their place in it; the blocks' line counts (one row
a block) are added up per file and joined back to the rejects only.

Text of tables that may hold line breaks inside quotes is read by records, one
task a file, as multi-line CSV cannot be split; ``line`` is then the record's
number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_COLUMNS
from .readers import MULTILINE_TABLES, header_of

REJECT_SCHEMA = "file string, line bigint, reason string, raw string"

#: Fields that a row needs, and the types in which fields are read later.
REQUIRED: dict[str, list[str]] = {
    "customers": ["customer_id"], "sellers": ["seller_id"], "orders": ["order_id"], "products": ["product_id"],
    "order_items": ["order_id", "order_item_id", "product_id"], "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id", "order_id"], "geolocation": ["geolocation_zip_code_prefix"],
    "product_category_name_translation": ["product_category_name"],
}
TYPED: dict[str, dict[str, str]] = {
    "orders": {c: "timestamp_ntz" for c in RAW_COLUMNS["orders"] if c.startswith("order_") and c.endswith(("timestamp", "_at", "_date"))},
    "order_items": {"order_item_id": "int", "price": "decimal(15,4)", "freight_value": "decimal(15,4)", "shipping_limit_date": "timestamp_ntz"},
    "order_payments": {"payment_sequential": "int", "payment_installments": "int", "payment_value": "decimal(15,4)"},
    "order_reviews": {"review_score": "int", "review_creation_date": "timestamp_ntz", "review_answer_timestamp": "timestamp_ntz"},
}


class RejectsError(ValueError):
    """Too many rejected lines."""


@dataclass(frozen=True)
class Loaded:
    rows: DataFrame
    rejects: DataFrame
    n_rows: int
    n_rejects: int
    reasons: Mapping[str, int]


def _blank(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c), F.lit(""))) == ""


def reject_reason(table: str, strict: bool = True) -> Column:
    """The first reason to reject a parsed row of ``table``, or NULL. Without ``strict`` only its shape counts."""
    reasons = [F.when(F.col("_open_quote"), F.lit("unclosed quote")),
               F.when(F.col("_fields") != F.col("_wanted"), F.concat(F.lit("fields: "), F.col("_fields"), F.lit(" of "), F.col("_wanted")))]
    if strict:
        reasons += [F.when(_blank(c), F.lit(f"blank: {c}")) for c in REQUIRED.get(table, ())]
        reasons += [F.when(~_blank(c) & F.trim(F.col(c)).try_cast(kind).isNull(), F.lit(f"not {kind.split('(')[0]}: {c}"))
                    for c, kind in TYPED.get(table, {}).items()]
    return F.coalesce(*reasons)


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """value, file, block and place in the block of every line but the header and blank ones; ``_mid`` orders a block's lines."""
    raw = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
                                              F.monotonically_increasing_id().alias("_mid"))
    return raw.withColumn("value", F.regexp_replace("value", "\r$", ""))


def _by_lines(spark: SparkSession, path: str, header: list[str], schema: T.StructType) -> DataFrame:
    lines = _lines(spark, [path])
    title = ",".join(c.strip().lower() for c in header)
    first = (F.col("_block") == 0) & (F.lower(F.regexp_replace("value", '[ "\ufeff]', "")) == title.replace(" ", ""))
    fields = F.regexp_count(F.regexp_replace("value", '"(?:[^"]|"")*"', ""), F.lit(",")) + 1  # commas outside quotes
    parsed = lines.withColumns({
        "_row": F.from_csv("value", ", ".join(f"`{c}` string" for c in schema.names), {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}),
        "_fields": fields, "_open_quote": F.pmod(F.regexp_count("value", F.lit('"')), F.lit(2)) == 1,
        "_header": first, "_empty": F.trim("value") == ""})
    return parsed.select(*[F.col("_row")[c].alias(c) for c in schema.names], F.col("value").alias("raw"), "file", "_block", "_mid",
                         "_fields", "_open_quote", "_header", "_empty")


def _by_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    wide = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    rows = (spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
            .option("enforceSchema", True).option("columnNameOfCorruptRecord", "_corrupt").schema(wide).csv(path))
    n = len(schema.names)
    return rows.select(*schema.names, F.col("_corrupt").alias("raw"), F.col("_metadata.file_path").alias("file"),
                       F.lit(0).cast("bigint").alias("_block"), F.monotonically_increasing_id().alias("_mid"),
                       F.when(F.col("_corrupt").isNull(), F.lit(n)).otherwise(F.lit(-1)).alias("_fields"),
                       F.lit(False).alias("_open_quote"), F.lit(False).alias("_header"), F.lit(False).alias("_empty"))


def load_with_rejects(spark: SparkSession, path: str, table: str, out: str, *, strict: bool = True, max_rejects: int | None = None,
                      max_share: float | None = 0.01) -> Loaded:
    """Reads one CSV export and writes ``out`` once, as accepted and rejected rows.

    Rows in (lines without header and blank ones) are rows kept plus rejects.
    More than ``max_rejects`` of them, or a share above ``max_share``, raises
    ``RejectsError`` with the reasons; the rejects stay readable under ``out``.
    """
    header = header_of(spark, path)
    names = [c.strip().lower() for c in header]
    missing = [c for c in RAW_COLUMNS[table] if c not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(names) or 'empty'}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    parsed = _by_records(spark, path, schema) if table in MULTILINE_TABLES else _by_lines(spark, path, header, schema)
    checked = parsed.withColumn("_wanted", F.lit(len(names))).withColumn("reason", reject_reason(table, strict))
    if table in MULTILINE_TABLES:
        checked = checked.withColumn("reason", F.when(F.col("_fields") < 0, F.lit("fields")).otherwise(F.col("reason")))
        checked = checked.withColumn("raw", F.when(F.col("raw").isNotNull(), F.col("raw")).when(F.col("reason").isNotNull(), F.to_csv(F.struct(*names))))
    kind = F.when(F.col("_header") | F.col("_empty"), F.lit("skipped")).when(F.col("reason").isNull(), F.lit("rows")).otherwise(F.lit("rejects"))
    columns = RAW_COLUMNS[table]
    (checked.withColumn("kind", kind).select(*columns, "file", "_block", "_mid", "reason", F.when(F.col("kind") == "rejects", F.col("raw")).alias("raw"), "kind")
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("kind").parquet(out))
    back = spark.read.schema(T.StructType([*[T.StructField(c, T.StringType()) for c in columns], T.StructField("file", T.StringType()),
                                           T.StructField("_block", T.LongType()), T.StructField("_mid", T.LongType()),
                                           T.StructField("reason", T.StringType()), T.StructField("raw", T.StringType()),
                                           T.StructField("kind", T.StringType())])).parquet(out)
    blocks = back.groupBy("file", "_block").agg(F.min("_mid").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = blocks.withColumn("_before", before).select(F.col("file").alias("_f"), F.col("_block").alias("_b"), "_first", "_before")
    bad = back.where("kind = 'rejects'")
    rejects = (bad.join(offsets, (F.col("file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
               .select("file", (F.col("_before") + F.col("_mid") - F.col("_first") + 1).cast("bigint").alias("line"), "reason", "raw"))
    counts = {(r["kind"], r["reason"]): r["n"] for r in back.groupBy("kind", "reason").agg(F.count("*").alias("n")).collect()}  # a row a reason
    n_rows = sum(n for (k, _), n in counts.items() if k == "rows")
    reasons = {r: n for (k, r), n in sorted(counts.items(), key=str) if k == "rejects"}
    n_rejects = sum(reasons.values())
    rows = back.where("kind = 'rows'").select(*columns)
    if (max_rejects is not None and n_rejects > max_rejects) or (max_share is not None and n_rejects > max_share * (n_rows + n_rejects)):
        raise RejectsError(f"{path}: {n_rejects} of {n_rows + n_rejects} rows rejected ({', '.join(f'{n} {r}' for r, n in reasons.items())}); see {out}/kind=rejects")
    return Loaded(rows, rejects, n_rows, n_rejects, reasons)


def load_dir_with_rejects(spark: SparkSession, directory: str, out: str, files: Mapping[str, str] | None = None, **limits) -> tuple[dict[str, DataFrame], DataFrame]:
    """All registry tables of a directory, and one rejects table (``table_name`` and ``REJECT_SCHEMA``)."""
    from .readers import DEFAULT_FILES, require_sources
    stems = DEFAULT_FILES | dict(files or {})
    require_sources(spark, directory, stems.values())
    rows, rejects = {}, None
    for table, stem in stems.items():
        got = load_with_rejects(spark, f"{directory}/{stem}.csv", table, f"{out}/{table}", **limits)
        rows[f"{table}_raw"] = got.rows
        one = got.rejects.select(F.lit(table).alias("table_name"), "*")
        rejects = one if rejects is None else rejects.unionByName(one)
    return rows, rejects
