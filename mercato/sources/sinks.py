"""Sinks: full refresh, replay-safe per-batch append, CSV export, JSON rows, counted writes.

* ``write_table``: overwrite by name. With ``partition_by`` and the session's
  dynamic partition-overwrite mode only the partitions present in the new
  data are replaced, so a refresh of some days leaves the other days alone.
* ``append_batch``: a KPI append that is safe to replay: rows are written
  under ``batch_id=<n>`` and a re-run of batch n replaces its own partition.
* ``observed_count``: counts rows *while* writing (``DataFrame.observe``),
  no second job over the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import SCHEMAS, conform


def write_table(df: DataFrame, path: str, table: str | None = None, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, sort_within: Sequence[str] | None = None,
                fmt: str = "parquet") -> None:
    """Write by column name (``conform`` when ``table`` has a contract) as Parquet.

    ``sort_within`` orders rows inside each output file, which tightens the
    Parquet min/max statistics the readers' pushed-down filters use.
    """
    if table is not None and table in SCHEMAS:
        df = conform(df, table)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def refresh(df: DataFrame, path: str, table: str | None = None, **kw) -> None:
    """Truncate-and-insert: the table equals ``df`` afterwards; running it twice is the same as once."""
    write_table(df, path, table, mode="overwrite", **kw)


def observed_count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that fills in when the DataFrame is written (``obs.get['rows']``)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_counted(df: DataFrame, path: str, table: str | None = None, **kw) -> int:
    """Write and return the row count measured during the write."""
    counted, obs = observed_count(df, table or "rows")
    write_table(counted, path, table, **kw)
    return int(obs.get["rows"])


def append_batch(df: DataFrame, path: str, batch_col: str = "batch_id") -> None:
    """Replay-safe append of per-batch rows: each batch owns the partition ``batch_id=<n>``.

    Needs ``spark.sql.sources.partitionOverwriteMode=dynamic`` (pinned by
    ``mercato.session``); it is also set on the writer so it holds for any session.
    Rows are rebalanced by batch, so a batch is as many files as its bytes need.
    """
    (df.hint("rebalance", batch_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(batch_col).parquet(path))


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite a CSV export with a header.

    ``single_file`` is only for small summaries (the batch / daily / monthly
    outputs, bounded by the number of windows or days): it coalesces to one
    writer task.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def to_json_rows(df: DataFrame) -> DataFrame:
    """One JSON object per row (column -> value); dates and timestamps as strings."""
    cols = []
    for f in df.schema.fields:
        name = f.dataType.typeName()
        c = F.col(f.name)
        cols.append(c.cast("string").alias(f.name) if name in ("date", "timestamp", "timestamp_ntz") else c)
    return df.select(F.to_json(F.struct(*cols)).alias("value"))


def save_table(df: DataFrame, name: str, table: str | None = None, mode: str = "overwrite",
               partition_by: Sequence[str] | None = None) -> None:
    """Catalog table variant of ``write_table``: ``CREATE DATABASE IF NOT EXISTS`` for the
    qualifier, then ``saveAsTable`` by name; overwrite replaces data and schema (drop-and-create)."""
    if "." in name:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    if table is not None and table in SCHEMAS:
        df = conform(df, table)
    w = df.write.mode(mode).option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, dbtable: str, properties: dict | None = None, mode: str = "overwrite",
               batchsize: int = 5000, truncate: bool = True) -> None:
    """Relational-database sink: multi-row batched inserts (``batchsize``); with ``truncate``
    an overwrite keeps the target table and its definition (truncate-and-insert)."""
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", dbtable)
         .option("batchsize", batchsize).option("truncate", str(truncate).lower()))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
