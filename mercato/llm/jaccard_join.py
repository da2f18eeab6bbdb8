"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures, then exact intersections.

Sets of word shingles, hashed to 64 bits. Equal sets form a class; one document
stands for it. Two classes whose Jaccard similarity reaches the threshold share
a shingle among the first (1 - threshold) of each set in any common order, so a
tile is such a shingle; its members stand in order of size, and only those of
sizes within the threshold meet. The order puts shingles that a sample finds
frequent last; the sample decides the cost, never the result. Every meeting
pair is bounded from above: a parity bitmap as wide as the set is large gives at
least popcount(xor) shingles in which the sets differ. Pairs that the bound lets
through are verified by intersecting the sorted shingle arrays of the texts.

A first round over eight minimum hashes links most members of large groups of
near copies: rows of one minimum hash meet a few neighbours of like size whose
bitmaps allow a link; one verified link for each row, then the other such pairs
that are still in different components. Tiles need only
pairs between different components, so a group of m near copies does not cost m^2.

Defined results: NULL, empty and blank texts have 0 shingles and link with
nothing; fewer words than a shingle give one shingle, the whole sequence. A
repeated row is a copy. Rows without an id keep their count, but have no
component (NULL) and link nothing. Empty tables give empty results. Only the id
and the text are read, so that other columns never clash.
"""

from __future__ import annotations

import uuid
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import (between, components, lower_table, merged, mix64, prefix_hash, row_slices, shared_path, span_hash,
                                text_bytes, word_spans, written)

WORDS = 5


def shingle_sets(data: np.ndarray, off: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    data = lower_table()[data]
    starts, ends, at = word_spans(data, off)
    h = span_hash(prefix_hash(data), starts, ends)
    with np.errstate(over="ignore"):
        roll = np.zeros(max(0, len(h) - words + 1), np.uint64)
        for k in range(words):
            roll = roll * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - words + 1 + k] if len(roll) else roll
        roll = mix64(roll)
        out = []
        for lo, hi in zip(at[:-1], at[1:]):
            if hi - lo >= words:
                out.append(np.unique(roll[lo:hi - words + 1]))
            elif hi > lo:
                x = np.uint64(hi - lo)
                for w in h[lo:hi]:
                    x = x * np.uint64(0xC2B2AE3D27D4EB4F) + w
                out.append(mix64(np.array([x])))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def need(a, b, percent: int):
    """Least overlap at which sets of sizes a and b reach ``percent``."""
    return -((-percent * (a + b)) // (100 + percent))


def parity_bits(s: np.ndarray) -> bytes:
    """Parity bitmap, as wide as the next power of two from the set's size (64 at least)."""
    width = max(64, 1 << (len(s) - 1).bit_length())
    bits = np.bincount((s >> np.uint64(32)).astype(np.int64) & (width - 1), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def parity(bits: bytes) -> tuple[int, int]:
    """(bitmap as a number, its width in bits)."""
    return int.from_bytes(bits, "little"), 8 * len(bits)


def overlap_bound(a: tuple[int, int], b: tuple[int, int], n: int, m: int) -> int:
    """Upper bound of the overlap of sets of sizes n and m with parities a and b: the wider is folded to the narrower."""
    (x, width), (y, wide) = sorted((a, b), key=lambda v: v[1])
    while wide > width:
        wide //= 2
        y = (y >> wide) ^ (y & ((1 << wide) - 1))
    return (n + m - (x ^ y).bit_count()) // 2


def _rows(batch) -> tuple[pa.Array, list[np.ndarray]]:
    """Ids and shingle sets of a batch (doc_id, text)."""
    data, off = text_bytes(batch.column(1))
    sets = []
    for lo, hi in row_slices(off, 1 << 19):  # a slice's working arrays are about 40 times its bytes
        sets += shingle_sets(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
    return batch.column(0), sets


def _digests(batches):
    for batch in batches:
        ids, sets = _rows(batch)
        with np.errstate(over="ignore"):
            one = [int(mix64(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
            two = [int(mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
        yield pa.RecordBatch.from_arrays([ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(one, pa.int64()),
                                          pa.array(two, pa.int64())], names=["doc_id", "n", "d1", "d2"])


def _shingles(batches):
    for batch in batches:
        _, sets = _rows(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).astype(np.int64))], names=["s"])


def _signatures(batches):
    seeds = (np.arange(8, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x51_7C_C1_B7_27_22_0A_95)
    for batch in batches:
        ids, sets = _rows(batch)
        keys = [[int(mix64(s ^ seed).min().astype(np.int64)) for seed in seeds] for s in sets]
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([len(s) for s in sets], pa.int32()), pa.array([parity_bits(s) for s in sets], pa.binary()),
             pa.array(keys, pa.list_(pa.int64()))], names=["rep", "n", "bits", "keys"])


def _near(percent: int, back: int = 16, pairs: int = 3):
    """Sorted (key, n, rep, bits) -> pairs that the bound allows (v: how close, 1 more with the key's first).

    A row meets the key's first row and the ``back`` rows before it, nearest in
    size first, until ``pairs`` of them are allowed. What stays unlinked by
    this is left to the tiles, which meet all pairs.
    """
    def run(batches):
        key, first, before = None, None, deque(maxlen=back)
        for batch in batches:
            found = []
            for k, n, rep, bits in zip(*(c.to_pylist() for c in batch.columns)):
                row = (n, rep, parity(bits))
                if k != key:
                    key, first = k, row
                    before.clear()
                left = pairs
                for other in (first, *reversed(before)):
                    least = need(other[0], n, percent)
                    if other[0] < least and other is not first:
                        break  # sizes ascend: earlier ones do not fit either
                    if other[1] == rep or other[0] < least:
                        continue
                    most = overlap_bound(other[2], row[2], other[0], n)
                    if most >= least:
                        found.append((other[1], rep, (other is first) + most / (2 * (other[0] + n))))
                        left -= 1
                        if not left:
                            break
                if row is not first:
                    before.append(row)
            a, b, v = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(v, pa.float64())], names=["a", "b", "v"])
    return run


def _prefixes(percent: int, frequent):
    """(doc_id, text, component) -> the prefix of each set in the order (sample count, hash)."""
    def run(batches):
        hashes, counts = frequent.value
        for batch in batches:
            ids, sets = _rows(batch)
            ids, comp = ids.to_numpy(), batch.column(2).to_numpy()
            token, size, at = [], [], []
            for s in sets:
                n = len(s)
                p = n + (-percent * n) // 100 + 1
                if len(hashes) and n:
                    spot = np.minimum(np.searchsorted(hashes, s), len(hashes) - 1)
                    often = np.where(hashes[spot] == s, counts[spot], 0)
                    if often.any():
                        s = s[np.argsort(often, kind="stable")]
                token.append(s[:p])
                size.append(n)
                at.append(np.arange(len(token[-1])))
            reps = np.array([len(t) for t in token])
            yield pa.RecordBatch.from_arrays(
                [pa.array((np.concatenate(token) >> np.uint64(16)).astype(np.int64)), pa.array(np.repeat(ids, reps)),
                 pa.array(np.repeat(np.array(size, np.int32), reps)), pa.array(np.concatenate(at).astype(np.int32)),
                 pa.array(np.repeat(comp, reps))], names=["token", "rep", "n", "at", "comp"])
    return run


def _tiles(percent: int):
    """Sorted (token, n, rep, at, comp) -> pairs of different components that size and place allow."""
    def meet(t, n, rep, at, comp):
        edge = np.append(np.flatnonzero(np.append(True, t[1:] != t[:-1])), len(t))
        lo, hi = edge[:-1], edge[1:]
        mixed = np.minimum.reduceat(comp, lo) != np.maximum.reduceat(comp, lo)
        group = np.repeat(np.arange(len(lo)), hi - lo)
        i = np.flatnonzero(mixed[group])
        end = hi[group[i]]
        k = 1
        while True:
            ok = i + k < end
            i, end = i[ok], end[ok]
            fits = n[i] >= need(n[i], n[i + k], percent)  # sizes ascend: later ones do not fit either
            i, end = i[fits], end[fits]
            if not len(i):
                return
            j = i + k
            least = need(n[i], n[j], percent)
            good = (comp[i] != comp[j]) & (n[i] - at[i] >= least) & (n[j] - at[j] >= least)
            if good.any():
                yield np.stack([np.minimum(rep[i[good]], rep[j[good]]), np.maximum(rep[i[good]], rep[j[good]])])
            k += 1

    def run(batches):
        rest = None
        for batch in batches:
            cols = [c.to_numpy().astype(np.int64) for c in batch.columns]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            cut = int(np.searchsorted(cols[0], cols[0][-1])) if len(cols[0]) else 0  # the last token may go on
            rest, cols = [c[cut:] for c in cols], [c[:cut] for c in cols]
            if cut:
                yield from emit(cols)
        if rest is not None and len(rest[0]):
            yield from emit(rest)

    def emit(cols):
        waiting, held = [], 0
        for pairs in meet(*cols):
            waiting.append(pairs)
            held += pairs.shape[1]
            if held > 1 << 20:
                yield out(waiting)
                waiting, held = [], 0
        if waiting:
            yield out(waiting)

    def out(waiting):
        pairs = np.unique(np.concatenate(waiting, axis=1), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])
    return run


def _bounded(percent: int):
    """(a, b, n, bits, m, more) -> pairs whose bitmaps allow the overlap."""
    def run(batches):
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            keep = [overlap_bound(parity(x), parity(y), n, m) >= need(n, m, percent) for n, x, m, y in zip(*cols[2:])]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])
    return run


def _verified(percent: int):
    """(a, b, text of a, text of b) -> pairs whose sorted shingle arrays reach the threshold."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                sets = []
                for k in (2, 3):
                    data, off = text_bytes(part.column(k))
                    sets.append([s for x, y in row_slices(off) for s in shingle_sets(data[off[x]:off[y]], off[x:y + 1] - off[x])])
                keep = [100 * (o := len(np.intersect1d(x, y, assume_unique=True))) >= percent * (len(x) + len(y) - o)
                        for x, y in zip(*sets)]
                yield pa.RecordBatch.from_arrays([part.column(k).filter(pa.array(keep, pa.bool_())) for k in (0, 1)], names=["a", "b"])
    return run


def jaccard_components(docs: DataFrame, percent: int = 75, sample_percent: int = 4, frequent_at: int = 3,
                       most_frequent: int = 1 << 18) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    The order of shingles uses at most ``most_frequent`` of those found
    ``frequent_at`` times in the sample (broadcast: 4 MB at that default).
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = written(docs.mapInArrow(_digests, "doc_id long, n long, d1 long, d2 long"), "digests")
    classes = known.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"))
    ids = written(classes, "classes")

    # the classes' texts, bucketed by id: joined often, shuffled once
    name = f"reps_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    one = docs.join(ids.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    (one.repartition(buckets, "doc_id").write.bucketBy(buckets, "doc_id").sortBy("doc_id")
     .option("path", shared_path(spark, name)).saveAsTable(name))
    reps = spark.table(name)

    signed = written(reps.mapInArrow(_signatures, "rep long, n int, bits binary, keys array<long>"), "signatures")

    def verify(pairs: DataFrame) -> DataFrame:
        a = reps.select(F.col("doc_id").alias("a"), F.col("text").alias("_ta"))
        b = reps.select(F.col("doc_id").alias("b"), F.col("text").alias("_tb"))
        both = pairs.join(a, "a").join(b, "b").select("a", "b", "_ta", "_tb")
        return both.mapInArrow(_verified(percent), "a long, b long")

    # first round: one link for each class that a minimum hash brings next to a similar one
    near = written(signed.select(F.explode("keys").alias("key"), "n", "rep", "bits").repartition("key")
            .sortWithinPartitions("key", "n", "rep").mapInArrow(_near(percent), "a long, b long, v double").groupBy("a", "b").agg(F.max("v").alias("v")), "near")
    best = near.groupBy("b").agg(F.max_by("a", F.struct("v", -F.col("a"))).alias("a")).select("a", "b")
    labels = components(verify(best))
    labels = merged(labels, written(verify(between(near, labels).select("a", "b")), "links"))  # the other pairs, if still apart

    # second round: tiles of prefix shingles, pairs between components only
    sampled = reps.where(F.pmod(F.xxhash64("doc_id"), F.lit(100)) < sample_percent)
    often = (sampled.mapInArrow(_shingles, "s long").groupBy("s").count().where(F.col("count") >= frequent_at)
             .orderBy(F.desc("count"), "s").limit(most_frequent).toArrow())
    hashes, counts = often.column("s").to_numpy().astype(np.uint64), often.column("count").to_numpy()
    order = np.argsort(hashes)
    frequent = spark.sparkContext.broadcast((hashes[order], counts[order]))
    labelled = reps.join(labels, reps["doc_id"] == labels["node"], "left").select(
        "doc_id", "text", F.coalesce("component", "doc_id").alias("component"))
    tiles = (labelled.mapInArrow(_prefixes(percent, frequent), "token long, rep long, n int, at int, comp long")
             .repartition("token").sortWithinPartitions("token", "n", "rep").select("token", "n", "rep", "at", "comp"))
    pairs = tiles.mapInArrow(_tiles(percent), "a long, b long").distinct()
    sig = signed.select("rep", "n", "bits")
    bounded = (pairs.join(sig.withColumnsRenamed({"rep": "a"}), "a")
               .join(sig.withColumnsRenamed({"rep": "b", "n": "m", "bits": "more"}), "b")
               .select("a", "b", "n", "bits", "m", "more").mapInArrow(_bounded(percent), "a long, b long"))
    final = merged(labels, written(verify(written(bounded, "pairs")), "links"))
    spark.sql(f"DROP TABLE {name}")  # its files stay in the shared folder

    named = ids.join(final, ids["rep"] == final["node"], "left").select(
        "n", "d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    joined = known.join(named, ["n", "d1", "d2"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
