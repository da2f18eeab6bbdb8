"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree over source blocks.

A document's place in its source is a hash of its id and text, so that source blocks
(ranges of places) are random samples. Target weights, capped at ``most_repeats``
times a source's size, say how often a source is drawn: whole passes over all
its blocks, then the documents up to a threshold place, found by three ever
finer sums (1/1024 of a source, 1/1024 of that, its documents), and of the next
256 documents those that fill the remainder. The drawn
blocks are the quotas that the tree splits among the output shards, exactly and
without replacement: each node deals a multivariate-hypergeometric sample to
its left half. A shard takes its quota as the next blocks of each source's
permutation and shuffles its rows by a hash. Only block sums and assignments
(at most 1024 x passes for a source) reach the driver; sources are taken to be
few enough for that.

Defined results: NULL, empty and blank texts have size 0 and are drawn like
others of their source. A NULL source is a source, the last. Places are by id
and text, so rows of a NULL or repeated id are drawn each by itself; rows equal
in both share a place and are drawn alike. An empty table gives an empty mix. Other columns are carried along;
those named as a result are replaced. Reruns agree (``seed``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import apart, word_count, written

FINE = 10  # bits of a block number; two levels of blocks
KEY_BITS = 63


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int
    target: float
    passes: int  # whole passes over the source
    extra: float  # units still to draw after them


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = (5, 2, 1), most_repeats: int = 3) -> list[Source]:
    """Targets by weight that share the total size, none above ``most_repeats`` times its source's size."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free = {s: 0.0 for s in names}, {s for s in names if sizes[s]}
    left = float(sum(sizes.values()))
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * unit > most_repeats * sizes[s]}
        for s in over or free:
            target[s] = float(most_repeats * sizes[s]) if over else weight[s] * unit
        if not over:
            break
        left -= sum(target[s] for s in over)
        free -= over
    out = []
    for s in names:
        passes = min(most_repeats, int(target[s] // sizes[s])) if sizes[s] else 0
        out.append(Source(s, sizes[s], target[s], passes, max(0.0, target[s] - passes * sizes[s])))
    return out


def split_tree(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Quota of each shard and source (shards x sources); the columns sum to ``quotas``."""
    out = np.zeros((shards, len(quotas)), np.int64)
    todo = [(0, shards, np.asarray(quotas, np.int64))]
    while todo:
        lo, hi, have = todo.pop()
        if hi - lo == 1:
            out[lo] = have
            continue
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        share = int(have.sum()) * (mid - lo) // (hi - lo)
        left = rng.multivariate_hypergeometric(have, share, method="marginals") if have.sum() else have
        todo += [(lo, mid, left), (mid, hi, have - left)]
    return out


def _placed(docs: DataFrame, seed: int, place_by: tuple[str, ...]) -> DataFrame:
    """``docs`` with ``_key``, the place in its source, and the number of its block."""
    key = F.xxhash64(F.lit(seed), *place_by)
    key = F.shiftrightunsigned(key, 64 - KEY_BITS)
    return docs.withColumn("_key", key).withColumn("_block", F.shiftrightunsigned("_key", KEY_BITS - FINE).cast("int"))


def _thresholds(placed: DataFrame, sources: list[Source], sums: dict, few: str) -> list[int]:
    """For each source the largest place that its last, partial pass draws (-1: none)."""
    spark, schema = placed.sparkSession, f"source {few}, _block int, _left double"
    result = [-1] * len(sources)

    def walk(cells: dict[int, int], need: float) -> tuple[int, float]:
        """The cell where the running sum passes ``need`` (1 << FINE: none), and what is then still needed."""
        for cell in sorted(cells):
            if cells[cell] > need:
                return cell, need
            need -= cells[cell]
        return 1 << FINE, 0.0

    first = {k: walk(sums.get(s.name, {}), s.extra) for k, s in enumerate(sources) if s.extra > 0}
    for k, (cell, _) in first.items():
        result[k] = (cell << (KEY_BITS - FINE)) - 1
    at = {k: v for k, v in first.items() if v[0] < 1 << FINE}
    if not at:
        return result

    def near(rows: DataFrame, cells: dict[int, tuple[int, float]], column: str) -> DataFrame:
        table = spark.createDataFrame([(sources[k].name, c, left) for k, (c, left) in cells.items()], schema)
        table = table.withColumnsRenamed({"source": "_source", "_block": "_cell"})
        return rows.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("_source")) & (F.col(column) == F.col("_cell")))

    number = {s.name: k for k, s in enumerate(sources)}
    second = F.shiftrightunsigned("_key", KEY_BITS - 2 * FINE).bitwiseAND((1 << FINE) - 1).cast("int")
    inner = near(placed, at, "_block").select("source", "_key", "size", second.alias("_inner"), F.col("_cell").alias("_outer"))
    sums2: dict[int, dict[int, int]] = {}
    for r in inner.groupBy("source", "_inner").agg(F.sum("size").alias("n")).collect():
        sums2.setdefault(number[r["source"]], {})[r["_inner"]] = r["n"]
    deep = {k: walk(sums2.get(k, {}), at[k][1]) for k in at}
    for k, (cell, _) in deep.items():
        result[k] = (at[k][0] << (KEY_BITS - FINE)) + (cell << (KEY_BITS - 2 * FINE)) - 1
    deep = {k: v for k, v in deep.items() if v[0] < 1 << FINE}
    if deep:
        rows = near(inner, deep, "_inner")
        run = F.sum("size").over(Window.partitionBy("source").orderBy("_key"))  # a millionth of a source
        rows = rows.withColumn("_run", run).where(F.col("_run") <= F.col("_left"))
        for r in rows.groupBy("source").agg(F.max("_key").alias("k")).collect():
            result[number[r["source"]]] = r["k"]
    return result


def _fillers(placed: DataFrame, sources: list[Source], limits: list[int], few: str, most: int = 256) -> dict[int, set[int]]:
    """For each source, places beyond its limit whose documents fill what the limit leaves of its target.

    Of the next ``most`` documents (which bounds what the driver gets) those that
    still fit are taken in order of place; then one more, if it brings the sum nearer.
    """
    table = placed.sparkSession.createDataFrame(
        [(s.name, k, limit) for k, (s, limit) in enumerate(zip(sources, limits)) if s.extra > 0], f"_source {few}, _number int, _limit long")
    rows = placed.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("_source")))
    drawn = {r["_number"]: r["n"] for r in rows.where("_key <= _limit").groupBy("_number").agg(F.sum("size").alias("n")).collect()}
    order = F.row_number().over(Window.partitionBy("_number").orderBy("_key"))
    found: dict[int, dict[int, int]] = {}
    for r in (rows.where("_key > _limit AND size > 0").select("_number", "_key", "size", order.alias("_r")).where(F.col("_r") <= most)
              .orderBy("_number", "_key").collect()):
        cells = found.setdefault(r["_number"], {})
        cells[r["_key"]] = cells.get(r["_key"], 0) + r["size"]
    out: dict[int, set[int]] = {}
    for k, cells in found.items():
        if len(cells) == most:
            cells.popitem()  # rows that share the last place may be missing
        need, taken = sources[k].extra - drawn.get(k, 0), set()
        for key, size in cells.items():
            if size <= need:
                taken.add(key)
                need -= size
        rest = {key: size for key, size in cells.items() if key not in taken and abs(need - size) < need}
        if rest:
            taken.add(min(rest, key=lambda key: abs(need - rest[key])))
        out[k] = taken
    return out


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most_repeats: int = 3, shards: int = 32,
        seed: int = 20, place_by: tuple[str, ...] = ("doc_id", "text")) -> tuple[DataFrame, DataFrame]:
    """The mix, and the table of its sources (``source``, ``source_size``, ``target``).

    The mix has a row for each time a document is drawn: its columns, ``size``
    (words; a column of that name is taken as it is), ``copy``, ``shard`` and
    ``place``; it lies in shards, each in the order of ``place``. Places are a
    hash of the columns ``place_by``. Without ``size`` the documents are written
    with it once, so that later passes read no texts.
    """
    spark = docs.sparkSession
    docs, named_back = apart(docs.drop("copy", "shard", "place"), "_key", "_block", "_source", "_number", "_passes", "_limit", "_filler")
    sized = "size" in docs.columns
    docs = docs if sized else docs.withColumn("size", word_count(F.col("text")))
    placed = _placed(docs, seed, place_by) if sized else written(_placed(docs, seed, place_by), "sized")
    few = docs.schema["source"].dataType.simpleString()
    sums: dict = {}
    for r in placed.groupBy("source", "_block").agg(F.sum("size").alias("n")).collect():  # 1024 rows a source at most
        sums.setdefault(r["source"], {})[r["_block"]] = r["n"]
    sources = targets({s: sum(cells.values()) for s, cells in sums.items()}, weights, most_repeats)
    limits = _thresholds(placed, sources, sums, few)
    fillers = _fillers(placed, sources, limits, few)

    # every drawn block of a source is one unit of its quota; the last pass ends within a block
    units = []
    for k, (s, limit) in enumerate(zip(sources, limits)):
        blocks = sorted(sums[s.name])
        beyond = {key >> (KEY_BITS - FINE) for key in fillers.get(k, ())}
        units.append([(c, b) for c in range(s.passes) for b in blocks]
                     + [(s.passes, b) for b in blocks if (b << (KEY_BITS - FINE)) <= limit or b in beyond])
    quota = split_tree(np.array([len(u) for u in units], np.int64), shards, seed) if units else np.zeros((shards, 0), np.int64)
    dealt = []
    for k, u in enumerate(units):
        order = np.random.default_rng([seed, 1, k]).permutation(len(u))
        owner = np.repeat(np.arange(shards), quota[:, k])
        dealt += [(k, *u[i], int(o)) for i, o in zip(order, owner)]

    table = spark.createDataFrame(
        [(s.name, k, s.size, s.target, s.passes, limit) for k, (s, limit) in enumerate(zip(sources, limits))],
        f"source {few}, _number int, source_size long, target double, _passes int, _limit long")
    owners = spark.createDataFrame(dealt, "_number int, copy int, _block int, shard int")
    known = table.select(F.col("source").alias("_source"), "_number", "_passes", "_limit")
    rows = placed.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("_source")))  # a row for each source
    extra = spark.createDataFrame([(k, key) for k, keys in fillers.items() for key in keys], "_number int, _key long")
    rows = rows.join(F.broadcast(extra.withColumn("_filler", F.lit(True))), ["_number", "_key"], "left")  # 256 rows a source at most
    times = F.col("_passes") + ((F.col("_key") <= F.col("_limit")) | F.col("_filler").isNotNull()).cast("int")
    rows = rows.where(times > 0).withColumn("copy", F.explode(F.sequence(F.lit(0), times - 1)))
    if len(dealt) <= 1_000_000:  # else both sides are shuffled
        owners = F.broadcast(owners)
    rows = rows.join(owners, ["_number", "copy", "_block"])
    rows = rows.withColumn("place", F.xxhash64(F.lit(seed + 1), "_key", "copy"))
    mixed = rows.repartition(shards, "shard").sortWithinPartitions("shard", "place")
    return named_back(mixed.select(*docs.columns, "copy", "shard", "place")), table.select("source", "source_size", "target")
