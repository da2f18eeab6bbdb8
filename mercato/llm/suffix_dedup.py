"""Suffix-array dedup: bytes of strings of ``length`` that start anywhere else too are removed.

A window (a string of ``length`` bytes) is anchored at the place within its
first positions (``REACH`` at most) whose following core of bytes has the least
hash. Equal windows have equal anchors, and consecutive windows with one anchor
form a run, so the corpus becomes a sparse set of suffixes, about one for 100
bytes at a length of 400 and one for 75 at 240.
Runs are grouped by core hash. Runs that agree in all their bytes are counted
before they are shuffled, and are repeats as a whole; of each different one in
a core's group a single representative is suffix-sorted by deep-shallow sorting:

* shallow: multikey quicksort over 8-byte symbols to a depth of 16 bytes;
* deep: blind tries order the groups whose common prefix is longer.

The trie's inner nodes are the common prefixes R of the suffixes right of the
anchor. Walking them from the deepest up, members are merged, small into large,
in the order of their reversed left contexts; neighbours there have the longest
common left part L. L + R >= ``length`` says that a window repeats, and a run's
removed bytes reach from its largest such L to its largest such R.

A core with more than ``most`` different runs is not given to one task: all its
windows are hashed (128 bits) and counted by a grouping instead, which gives the
same reach.

Defined results: NULL and empty texts have no bytes and lose none; texts shorter
than ``length`` neither. Matches never cross documents. Copies of a document
lose everything that is ``length`` or longer, in each copy. Rows are told apart
by two 64-bit hashes of id and text, so NULL and repeated ids are rows like
others; rows equal in both are copies and share their spans. Extra columns are
carried along by ``remove_repeats``, those named as a result are replaced. Texts are read whole, in pieces of 1 MB.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import apart, mix64, prefix_hash, row_slices, span_hash, text_bytes, with_arrow_columns, written

REACH = 201
CORE = 70
SHALLOW = 16


# ------------------------------------------------------------------ anchors and runs
def _sliding_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value in each window of ``width``."""
    bits = np.uint64(max(1, len(h) - 1).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    n = len(h) - width + 1
    whole = -(-len(h) // width) * width
    key = np.concatenate([key, np.full(whole - len(h), np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(key, axis=1).ravel()
    back = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(back[:n], ahead[width - 1:width - 1 + n]) & low).astype(np.int64)


def runs(data: np.ndarray, off: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Runs of the windows of all rows: row, core hash, context hash, and places in the row: first window, anchor, last window."""
    reach = min(REACH, max(length // 2 + 1, length - CORE))
    core = length - reach + 1
    none = {k: np.zeros(0, np.int64) for k in ("row", "core", "context", "first", "anchor", "last")}
    if len(data) < length:
        return none
    prefix = prefix_hash(data)
    spots = np.arange(len(data) - core + 1)
    h = span_hash(prefix, spots, spots + core)
    at = _sliding_argmin(h, reach)
    end = np.repeat(off[1:], np.diff(off))[:len(at)]
    valid = np.flatnonzero(np.arange(len(at)) + length <= end)
    if not len(valid):
        return none
    a = at[valid]
    begin = np.append(True, (a[1:] != a[:-1]) | (valid[1:] != valid[:-1] + 1))
    lo = valid[begin]
    hi = valid[np.append(np.flatnonzero(begin)[1:] - 1, len(valid) - 1)]
    a = a[begin]
    with np.errstate(over="ignore"):
        context = mix64(span_hash(prefix, lo, hi + length) * np.uint64(31) + (a - lo).astype(np.uint64))
    row = np.searchsorted(off, lo, "right") - 1
    return {"row": row, "core": h[a].astype(np.int64), "context": context.astype(np.int64),
            "first": lo - off[row], "anchor": a - off[row], "last": hi - off[row]}


def _runs(length: int, piece: int = 1 << 20):
    names = ["row", "core", "context", "first", "anchor", "last"]

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            data, off = text_bytes(batch.column(1))
            for lo, hi in row_slices(off, piece):
                part, rows = data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
                # a long text is read in overlapping pieces; a run cut in two is two runs
                for s in range(0, max(1, len(part)), 4 * piece) if hi - lo == 1 else (0,):
                    sub = part[s:s + 4 * piece + length - 1] if hi - lo == 1 else part
                    found = runs(sub, np.array([0, len(sub)]) if hi - lo == 1 else rows, length)
                    if len(found["row"]):
                        places = [pa.array((found[k] + s).astype(np.int32)) for k in names[3:]]
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array(found["row"] + lo)), pa.array(found["core"]), pa.array(found["context"]), *places], names=names)
    return run


# ------------------------------------------------------------------ deep-shallow sorting
def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the longest common prefix, known to be ``start`` at least."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    lo, step = start, 16
    while a[lo:lo + step] == b[lo:lo + step]:
        lo += step
        step *= 2
    hi = min(lo + step, n)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class BlindTrie:
    """Trie of strings that keeps branching depths and first bytes only; a search is checked against one leaf."""

    def __init__(self, strings: list[bytes], members: list[int]):
        self.strings = strings
        self.root = ["leaf", [members[0]]]
        for m in members[1:]:
            self._insert(m)

    def _byte(self, s: bytes, d: int) -> int:
        return s[d] if d < len(s) else -1  # the end sorts before every byte

    def _insert(self, m: int) -> None:
        s = self.strings[m]
        node, path = self.root, []
        while node[0] == "node":
            path.append(node)
            child = node[2].get(self._byte(s, node[1]))
            node = child if child is not None else next(iter(node[2].values()))
        other = self.strings[node[1][0]]
        depth = common_prefix(s, other)
        if depth == len(s) == len(other):
            node[1].append(m)
            return
        up = None
        here = self.root
        while here[0] == "node" and here[1] < depth:
            up, here = here, here[2][self._byte(s, here[1])]
        if here[0] == "node" and here[1] == depth:
            here[2][self._byte(s, depth)] = ["leaf", [m]]
            return
        new = ["node", depth, {self._byte(other, depth): here, self._byte(s, depth): ["leaf", [m]]}]
        if up is None:
            self.root = new
        else:
            up[2][self._byte(s, up[1])] = new

    def walk(self):
        """Post-order: ("leaf", members) and ("node", depth, number of children), children in byte order."""
        stack = [(self.root, False)]
        while stack:
            node, done = stack.pop()
            if node[0] == "leaf":
                yield "leaf", node[1], 0
            elif done:
                yield "node", node[1], len(node[2])
            else:
                stack.append((node, True))
                stack.extend((node[2][k], False) for k in sorted(node[2], reverse=True))


def deep_shallow(strings: list[bytes]):
    """Sorts strings; yields a blind trie for each group that shares its first ``SHALLOW`` bytes, in order.

    Multikey quicksort: a group is split in three around the median symbol (8
    bytes, big-endian) at its depth; the equal part goes on a symbol deeper.
    """
    symbols = np.frombuffer(b"".join(s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings), ">u8").reshape(len(strings), -1).astype(np.uint64)
    stack = [(np.arange(len(strings)), 0)] if strings else []
    while stack:
        group, depth = stack.pop()
        if len(group) == 1 or depth == symbols.shape[1]:
            yield BlindTrie(strings, group.tolist())
            continue
        key = symbols[group, depth]
        pivot = np.partition(key, len(key) // 2)[len(key) // 2]
        less, more = key < pivot, key > pivot
        for part, d in ((group[more], depth), (group[~less & ~more], depth + 1), (group[less], depth)):
            if len(part):
                stack.append((part, d))


def reaches(lefts: list[bytes], rights: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each run the largest left and right reach of a window that another run repeats (0, 0: none).

    ``lefts`` are the bytes before the anchors, reversed.
    """
    far_left, far_right = np.zeros(len(lefts), np.int64), np.zeros(len(lefts), np.int64)

    def join(big: list, small: list, depth: int) -> list:
        if len(big) < len(small):
            big, small = small, big
        for x in small:
            k = bisect.bisect_left(big, x)
            for y in big[max(0, k - 1):k + 1]:
                left = common_prefix(x[0], y[0])
                if left + depth >= length:
                    for m in (x[1], y[1]):
                        far_left[m], far_right[m] = max(far_left[m], left), max(far_right[m], depth)
            big.insert(k, x)
        return big

    for trie in deep_shallow(rights):
        stack: list[list] = []
        for kind, value, children in trie.walk():
            if kind == "leaf":
                own = [(lefts[value[0]], value[0])]
                for m in value[1:]:
                    own = join(own, [(lefts[m], m)], len(rights[m]))
                stack.append(own)
            else:
                parts = [stack.pop() for _ in range(children)]
                parts.sort(key=len)
                own = parts.pop()
                for part in parts:
                    own = join(own, part, value)
                stack.append(own)
    return far_left, far_right


def _contexts(length: int):
    """(row, text, list of runs) -> core, context, reversed left bytes, right bytes."""
    def run(batches):
        for batch in batches:
            for text, found in zip(batch.column(1), batch.column(2)):
                data = text.as_buffer().to_pybytes()
                rows = found.as_py()
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["core"] for r in rows], pa.int64()), pa.array([r["context"] for r in rows], pa.int64()),
                    pa.array([r["many"] for r in rows], pa.bool_()),
                    pa.array([data[r["first"]:r["anchor"]][::-1] for r in rows], pa.binary()),
                    pa.array([data[r["anchor"]:r["last"] + length] for r in rows], pa.binary())],
                    names=["core", "context", "many", "left", "right"])
    return run


def _sorted_reaches(length: int, hold: int = 50_000):
    """(core, context, left, right) sorted by core -> reaches; whole cores are gathered up to about ``hold`` runs."""
    def run(batches):
        rest: list[tuple] = []
        for batch in batches:
            rest += zip(*(c.to_pylist() for c in batch.columns))
            if len(rest) > hold and rest[0][0] != rest[-1][0]:
                cut = next(k for k in range(len(rest) - 1, -1, -1) if rest[k][0] != rest[-1][0]) + 1
                yield out(rest[:cut])
                rest = rest[cut:]
        if rest:
            yield out(rest)

    def out(rows):
        core, context, left, right = zip(*rows)
        far_left, far_right = reaches(list(left), list(right), length)
        return pa.RecordBatch.from_arrays([pa.array(core, pa.int64()), pa.array(context, pa.int64()), pa.array(far_left),
                                           pa.array(far_right)], names=["core", "context", "far_left", "far_right"])
    return run


def _windows(length: int):
    """(core, context, left, right) -> a hash pair of each window of the run, with its left reach."""
    def run(batches):
        for batch in batches:
            for core, context, left, right in zip(*(c.to_pylist() for c in batch.columns)):
                data = left[::-1] + right
                found = [hashlib.blake2b(data[k:k + length], digest_size=16).digest() for k in range(len(data) - length + 1)]
                n = len(found)
                yield pa.RecordBatch.from_arrays([
                    pa.array([core] * n, pa.int64()), pa.array([context] * n, pa.int64()), pa.array(found, pa.binary()),
                    pa.array(len(left) - np.arange(n))], names=["core", "context", "window", "reach"])
    return run


# ------------------------------------------------------------------ the operator
def row_key():
    """128 bits that tell rows of different id or text apart."""
    return F.struct(*(F.xxhash64(F.lit(seed), "doc_id", "text").alias(name) for seed, name in ((1, "a"), (2, "b"))))


def repeated_spans(docs: DataFrame, length: int = 400, most: int = 20_000) -> DataFrame:
    """(row, spans): for each row with repeats, its key (``row_key``) and byte ranges (start, stop), which may overlap."""
    docs = docs.where("octet_length(text) >= " + str(length)).select(row_key().alias("row"), "text")
    kind = docs.schema["row"].dataType.simpleString()
    found = written(docs.mapInArrow(_runs(length), f"row {kind}, core long, context long, first int, anchor int, last int"), "runs")
    same = found.groupBy("core", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "anchor")).alias("at"),
        F.min(F.col("anchor") - F.col("first")).alias("before"), F.min(F.col("last") - F.col("anchor")).alias("after"))
    by_core = Window.partitionBy("core")
    groups = same.withColumns({"kinds": F.count(F.lit(1)).over(by_core), "total": F.sum("n").over(by_core)})
    groups = written(groups.where("total > 1").select("*", "at.row", "at.anchor").drop("at", "total"), "cores")

    mixed = groups.where("kinds > 1").groupBy("row").agg(F.collect_list(F.struct(
        "core", "context", (F.col("kinds") > most).alias("many"), (F.col("anchor") - F.col("before")).alias("first"), "anchor",
        (F.col("anchor") + F.col("after")).alias("last"))).alias("runs"))
    one = docs.join(mixed, "row").groupBy("row").agg(F.first("text").alias("text"), F.first("runs").alias("runs"))  # of copies, one
    contexts = written(one.select("row", "text", "runs").mapInArrow(
        _contexts(length), "core long, context long, many boolean, left binary, right binary"), "contexts")
    reach = "core long, context long, far_left long, far_right long"
    few = (contexts.where("NOT many").drop("many").repartition("core").sortWithinPartitions("core", "context")
           .mapInArrow(_sorted_reaches(length), reach).where("far_right > 0"))
    windows = contexts.where("many").drop("many").mapInArrow(_windows(length), "core long, context long, window binary, reach long")
    twice = windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    many = (windows.join(twice, "window", "left_semi").groupBy("core", "context")
            .agg(F.max("reach").alias("far_left"), (length - F.min("reach")).alias("far_right")))
    copies = groups.where("n > 1").select("core", "context", F.col("before").cast("long").alias("far_left"),
                                          (F.col("after") + length).cast("long").alias("far_right"))
    all_reaches = (few.unionByName(many).unionByName(copies).groupBy("core", "context")
                   .agg(F.max("far_left").alias("far_left"), F.max("far_right").alias("far_right")))
    all_reaches = written(all_reaches, "reaches")  # both sides of the join are dealt anew, so a hot context is split
    return (found.join(all_reaches, ["core", "context"])
            .groupBy("row").agg(F.array_sort(F.collect_set(F.struct(
                (F.col("anchor") - F.col("far_left")).alias("start"), (F.col("anchor") + F.col("far_right")).alias("stop")))).alias("spans")))


def remove_repeats(docs: DataFrame, length: int = 400, most: int = 20_000, as_text: bool = False, min_words: int = 0,
                   min_bytes: int = 0) -> DataFrame:
    """``docs`` plus ``spans`` (maximal removed byte ranges), ``n_bytes``, ``n_removed``, ``kept`` (the bytes left) and their sha256.

    ``as_text``: ``kept`` is a string; characters that a cut has left in part are left out.
    With ``min_words``, a maximal range is removed if it has that many words (parts of words count), or ``min_bytes`` bytes.
    """
    docs = docs.drop("spans", "n_bytes", "n_removed", "kept", "kept_sha256")
    docs, named_back = apart(docs, "_row", "_own", "_found")
    spans = repeated_spans(docs, length, most).withColumnsRenamed({"row": "_row", "spans": "_found"})
    marked = docs.withColumn("_own", row_key()).join(spans, F.col("_own") == F.col("_row"), "left").drop("_own", "_row")

    def make(batch):
        texts, spans = (batch.column(batch.schema.get_field_index(k)) for k in ("text", "_found"))
        out = []
        for text, found in zip(texts, spans):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            merged: list[list[int]] = []
            for x in found.as_py() or ():
                if merged and x["start"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x["stop"])
                else:
                    merged.append([x["start"], x["stop"]])
            if min_words:
                merged = [[a, b] for a, b in merged if b - a >= min_bytes or len(data[a:b].split()) >= min_words]
            ends = [0, *(e for span in merged for e in span), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2]))
            out.append((len(data), len(data) - len(kept), merged, kept, hashlib.sha256(kept).hexdigest()))
        n, removed, merged, kept, sha = zip(*out) if out else ((),) * 5
        return [pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(merged, pa.list_(pa.list_(pa.int64()))),
                pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary()),
                pa.array(sha, pa.string())]
    return named_back(with_arrow_columns(
        marked, make, "n_bytes long, n_removed long, spans array<array<long>>, "
        f"kept {'string' if as_text else 'binary'}, kept_sha256 string").drop("_found"))
