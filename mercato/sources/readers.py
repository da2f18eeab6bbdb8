"""CSV / Parquet readers for the raw exports.

Raw CSV is read with an explicit all-text schema: no type inference (zip
prefixes keep their leading zeros), ``multiLine`` and doubled-quote escaping
(review comments hold newlines and quotes). Header names are trimmed and
lower-cased. The schema is given, so Spark does not scan the files twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_COLUMNS

# Logical raw table -> file stem. Default: the file is named after the table
# (``orders.csv``); pass another mapping for other export names.
DEFAULT_FILES: dict[str, str] = {t: t for t in RAW_COLUMNS}


# Tables whose free-text columns may hold line breaks inside quotes. Multi-line
# CSV cannot be split, so every other table is read line by line (splittable).
MULTILINE_TABLES = {"order_reviews"}


def _csv(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    return (spark.read.option("header", True).option("multiLine", multi_line)
            .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE").option("enforceSchema", False))


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Header of a CSV file (reads only its first line)."""
    first = spark.read.option("header", False).option("multiLine", False).option("escape", '"').csv(path).limit(1).collect()
    return [str(c) for c in first[0]] if first else []


def read_raw_csv(spark: SparkSession, path: str, table: str | None = None,
                 columns: Iterable[str] | None = None, multi_line: bool | None = None,
                 partitions: int | None = None) -> DataFrame:
    """All-text read of one raw export, its columns bound by the names in the header.

    Header names are trimmed and lower-cased. The result has ``columns``, or
    those of ``table``'s registry entry, or all of the header, in that order
    whatever the file's; a column that the file lacks is an error.

    ``multi_line`` defaults to True where free text may hold line breaks: in
    the registry's ``MULTILINE_TABLES``, and in files of no known table. Such a
    file is read by one task; ``partitions`` spreads its rows afterwards.
    """
    names = header_of(spark, path)
    header = [c.strip().lower() for c in names]
    wanted = list(columns) if columns is not None else RAW_COLUMNS[table] if table else header
    missing = [c for c in wanted if c not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(header) or 'empty'}")
    if multi_line is None:
        multi_line = table is None or table in MULTILINE_TABLES
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in names])
    df = _csv(spark, multi_line).schema(schema).csv(path).toDF(*header).select(*wanted)
    return df.repartition(partitions) if partitions else df


def read_typed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """What a type-inferring loader leaves: empty field -> NULL, values untrimmed, text kept as text.

    The typed-path cleaners cast the columns they need; nothing is inferred.
    """
    df = read_raw_csv(spark, path, table)
    return df.select(*[F.when(F.col(c) == "", None).otherwise(F.col(c)).alias(c) for c in df.columns])


def list_files(spark: SparkSession, directory: str, suffix: str = ".csv") -> list[str]:
    """File names in ``directory`` through the Hadoop FileSystem API (works for any cluster store)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(directory)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        raise FileNotFoundError(f"directory does not exist: {directory}")
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().endswith(suffix))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def require_sources(spark: SparkSession, directory: str, names: Iterable[str], suffix: str = ".csv") -> None:
    """Fail before any job runs when the directory or a required file is missing (A4, K5)."""
    present = set(list_files(spark, directory, suffix))
    missing = [n for n in names if f"{n}{suffix}" not in present]
    if missing:
        raise FileNotFoundError(f"missing required source files in {directory}: {', '.join(missing)}")


def read_dir(spark: SparkSession, directory: str, files: Mapping[str, str] | None = None,
             partitions: Mapping[str, int] | None = None) -> dict[str, DataFrame]:
    """The registry's raw tables from a directory of CSV exports, keyed ``<table>_raw``.

    ``files`` names the file stem of tables whose file is not named after the
    table. A missing file fails before anything is read. ``partitions``: for a
    table, over how many partitions its rows are spread (see ``read_raw_csv``).
    """
    stems = DEFAULT_FILES | dict(files or {})
    unknown = sorted(set(stems) - set(RAW_COLUMNS))
    if unknown:
        raise ValueError(f"unknown tables: {', '.join(unknown)}")
    require_sources(spark, directory, stems.values())
    return {f"{table}_raw": read_raw_csv(spark, f"{directory}/{stem}.csv", table, partitions=(partitions or {}).get(table))
            for table, stem in stems.items()}


def read_every(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """Every ``*.csv`` of a directory, with the columns of its own header, keyed ``<stem>_raw``."""
    return {f"{f[:-4]}_raw": read_raw_csv(spark, f"{directory}/{f}") for f in list_files(spark, directory)}
