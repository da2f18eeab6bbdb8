"""Exact top-k search: incremental multi-index hashing of binary codes.

A code is the signs of a vector's elements, cut into segments of
``segment_bits``. The index maps each segment's value to the codes that have it.
Round r looks up, for every unfinished query and segment, all values at exactly
r flipped bits; after it every code within m (r + 1) - 1 bits of the query (m
segments) has been met, since one of its segments must differ by r bits at most.
A query is finished when its kth verified distance is within that bound, so the
result is exact. Choose ``segment_bits`` near log2 of the number of codes.

Equal codes are one entry with the k + 1 smallest ids (no other of them can be
among the k nearest); the others never reach a join.

Defined results: rows with a NULL id or vector are neither queries nor found.
NULL, NaN, zero or missing elements are bit 0, elements beyond ``bits`` are left
out. A query does not find itself. Ties go to the smaller id. With fewer than k
other rows all of them are returned; an empty table gives no row. Ids are taken
to be unique; a repeated id is found once for each of its codes. Only the id and
the vector are read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import written


def code_segments(vector: Column, bits: int, segment_bits: int) -> Column:
    """Array of segment values of a vector's signs."""
    def value(first: int) -> Column:
        width = min(segment_bits, bits - first)
        return sum((F.when(F.get(vector, first + k) > 0, F.lit(1 << k)).otherwise(F.lit(0)) for k in range(width)), F.lit(0)).cast("int")
    # NaN compares as larger than any number in Spark
    return F.array(*[value(first) for first in range(0, bits, segment_bits)])


def distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _flips(width: int, radius: int) -> Column:
    """Literal array of the masks with ``radius`` of ``width`` bits set."""
    masks = [sum(1 << k for k in chosen) for chosen in combinations(range(width), radius)]
    return F.split(F.lit(",".join(map(str, masks))), ",").cast("array<int>")


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, bits: int = 64, segment_bits: int = 16) -> DataFrame:
    """(query_id, rank, id, distance) of the ``k`` rows nearest to each query; both frames have ``vec_id`` and ``embedding``."""
    def coded(df: DataFrame) -> DataFrame:
        vector = F.transform("embedding", lambda x: F.when(F.isnan(x), F.lit(0.0)).otherwise(x))
        return (df.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select("vec_id", vector.alias("_v"))
                .select(F.col("vec_id").alias("id"), code_segments(F.col("_v"), bits, segment_bits).alias("code")))

    base = written(coded(rows), "codes")
    total = base.count()
    number = -(-bits // segment_bits)
    smallest = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    entries = (base.withColumn("_r", smallest).where(F.col("_r") <= k + 1).groupBy("code")
               .agg(F.sort_array(F.collect_list("id")).alias("ids")))
    index = written(entries.select(F.posexplode("code").alias("segment", "value"), "code", "ids"), "index")
    asked = written(coded(queries).withColumnsRenamed({"id": "query_id", "code": "query"}), "queries")
    enough = min(k, total - 1)
    by_rank = Window.partitionBy("query_id").orderBy("distance", "id")

    best, left = None, asked
    for radius in range(segment_bits + 1 if enough > 0 else 0):
        probes = left.select("query_id", "query", F.posexplode("query").alias("segment", "_value"))
        probes = probes.withColumn("_flip", F.explode(_flips(segment_bits, radius)))
        probes = probes.select("query_id", "query", "segment", F.col("_value").bitwiseXOR(F.col("_flip")).alias("value"))
        # probes are many times what Spark estimates from the queries: both sides are shuffled, none is broadcast
        met = (probes.hint("merge").join(index.hint("merge"), ["segment", "value"])
               .select("query_id", distance(F.col("query"), F.col("code")).alias("distance"), F.explode("ids").alias("id"))
               .where("id <> query_id"))
        found = met if best is None else met.unionByName(best.select("query_id", "distance", "id"))
        best = written(found.distinct().withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k), "best")
        covered = number * (radius + 1) - 1
        done = best.where((F.col("rank") == enough) & (F.col("distance") <= covered)).select("query_id")
        left = written(left.join(done, "query_id", "left_anti"), "left")
        if left.isEmpty():
            break
    if best is None:
        best = asked.select("query_id", F.lit(0).alias("distance"), F.col("query_id").alias("id"), F.lit(0).alias("rank")).where("false")
    return best.select("query_id", "rank", "id", "distance")
