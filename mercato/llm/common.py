"""Helpers shared by the operators: columns, sessions, hashed words of Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rule ``[^\x20\x09-\x0D]+`` (fixed values).
SPACE = " \t\n\x0b\x0c\r"
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(BASE), -1, 1 << 64))


# ------------------------------------------------------------------ sessions and tables
def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder of ``spark.checkpoint.dir``; a local one only where it is unset (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="mercato-llm-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage is cut, a lost executor loses nothing."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apart(docs: DataFrame, *names: str):
    """``docs`` with its columns of these (an operator's working) names renamed, and the function that names them back."""
    away = {c: f"{c}_{uuid.uuid4().hex}" for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(away), lambda df: df.withColumnsRenamed({v: k for k, v in away.items()})


def words_column(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; empty for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod``; a NULL id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


# ------------------------------------------------------------------ Arrow batches as bytes
def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string array and the row offsets (rows + 1); NULL counts as empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_binary(column.type) else column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    off = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset:]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def row_slices(off: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer text is a range of its own."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^0..B^n and B^-0..B^-n modulo 2^64; not kept, so that no worker holds them after its task."""
    out = []
    for base in (BASE, _INV):
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        with np.errstate(over="ignore"):
            out.append(np.multiply.accumulate(p, out=p))
    return tuple(out)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values (xor, shift, multiply)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of byte polynomials and the inverse powers: see ``span_hash``."""
    pw, inverse = powers(len(data))
    with np.errstate(over="ignore"):
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * pw[:len(data)], out=out[1:])
    return out, inverse


def span_hash(prefix: tuple[np.ndarray, np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of the bytes lo..hi of the data behind ``prefix``, independent of where they stand."""
    sums, inverse = prefix
    with np.errstate(over="ignore"):
        return mix64((sums[hi] - sums[lo]) * inverse[lo] + (hi - lo).astype(np.uint64))


def lower_table() -> np.ndarray:
    """Byte table that lower-cases A-Z."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def space_table() -> np.ndarray:
    """Byte table: is white space of the word rule."""
    t = np.zeros(256, bool)
    t[[32, 9, 10, 11, 12, 13]] = True
    return t


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and for each row the index of its first word (rows + 1)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~space_table()[data]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


# ------------------------------------------------------------------ Arrow maps over documents
def with_arrow_columns(docs: DataFrame, make, fields: str) -> DataFrame:
    """``docs`` plus the columns that ``make(record batch) -> [arrays]`` gives; clashing input columns are replaced."""
    from pyspark.sql import types as T
    new = T.StructType.fromDDL(fields)
    docs = docs.drop(*new.names)
    schema = T.StructType(docs.schema.fields + new.fields)
    names = schema.names

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *make(batch)], names=names)
    return docs.mapInArrow(run, schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, balance: bool = False) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled documents, those with the smallest id hashes.

    Rows without id or label are left out; an id labelled twice takes the larger
    label; of rows that share an id one is taken, that of the least text hash, so
    ``most`` bounds the rows too. ``balance``: half of the sample for each label,
    as far as there are so many. The ids are broadcast: ``most`` bounds them.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id")
             .agg(F.max(F.col(label).cast("int")).alias("_label")))
    order = [F.xxhash64("doc_id"), "doc_id"]
    if balance:
        ids = (known.where("_label = 1").orderBy(*order).limit(most // 2)
               .unionByName(known.where("_label = 0").orderBy(*order).limit(most // 2)))
    else:
        ids = known.orderBy(*order).limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return (rows.groupBy("doc_id").agg(F.min_by(F.struct("text", "_label"), F.struct(F.xxhash64("text"), "text")).alias("r"))
            .select("doc_id", "r.text", "r._label"))


# ------------------------------------------------------------------ connected components
def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (a, b); a component is named by its smallest node.

    Large-star and small-star rounds over a written edge table: minima are
    aggregated before the shuffle, and a hub's edges are joined, not grouped.
    An edge always points from its larger node ``a`` to its smaller ``b``.
    """
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        view = both(e) if large else e
        least = view.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # a node's larger neighbours (large star) or its smaller ones (small star) go to the least
        moved = (e.select(F.col("b").alias("a"), F.col("a").alias("b")) if large else e).join(least, "a")
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def mark(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = mark(e)
    for _ in range(rounds):
        e = written(star(star(e, True), False), "edges")
        now = mark(e)
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = now
    raise RuntimeError("components did not settle")


def _named(labels: DataFrame, node: str, name: str) -> DataFrame:
    return labels.select(F.col("node").alias(node), F.col("component").alias(name))


def between(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``edges`` whose ends are in different components of ``labels`` (a node without a label is its own), with these as ca, cb."""
    known = edges.join(_named(labels, "a", "_ca"), "a", "left").join(_named(labels, "b", "_cb"), "b", "left")
    return known.withColumn("ca", F.coalesce("_ca", "a")).withColumn("cb", F.coalesce("_cb", "b")).drop("_ca", "_cb").where("ca <> cb")


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` after further links: only components, contracted to one node each, are linked anew."""
    top = components(between(edges, labels).select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    mapped = labels.join(_named(top, "component", "_top"), "component", "left").select("node", F.coalesce("_top", "component").alias("component"))
    alone = top.join(labels.select(F.col("component").alias("node")), "node", "left_anti")
    return written(mapped.unionByName(alone), "labels")
