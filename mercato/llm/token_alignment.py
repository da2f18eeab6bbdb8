"""Cross-tokenizer alignment: token groups of two vocabularies over the same bytes, and how often their ids meet.

A text is tokenised whole by both vocabularies: ``A`` (byte-level BPE) reads a
space and the text, ``B`` (pieces) reads the text and adds the space itself.
Byte offsets where tokens of both end cut the tokens into groups. Of these ends,
those before a space-marked token of both sides are anchors, checked against the
bytes of both; they split a document into small windows of token ids. What a
window's groups and links are depends on its ids alone, so alignments are kept
by the pair of id tuples, for as long as a task runs and within ``memo_bytes``.

Links are counted in bundles: the documents of a few megabytes share a list of
their distinct id pairs, with how many of these documents hold each. A document
has one row: its counts, and the places of its own pairs in that list with how
often each is linked. Bundles are read in slices, so neither a task nor a row
holds a bundle's documents at once. Only (pair, documents) rows are added up
over the corpus; then a bundle asks for the counts of its own pairs, once each,
and these come, in the order of their places, right before its documents. No
step holds the pair table whole.

Defined results: NULL and empty texts, and texts whose tokens do not spell the
space and the text, have no tokens: all counts are 0 and the digest is ''.
Repeated rows are separate documents, also for the counts; a NULL id is kept.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import mix64, row_slices, text_bytes, written
from mercato.llm.vocabularies import ByteBpe, Pieces, in_process

COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (size[0] of them), first[1], ..."""
    stop = np.cumsum(size)
    return np.repeat(first - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)


def _order(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that sort 64-bit values by their high bits, and which of these differ from the one before; places ride in the low bits."""
    bits = np.uint64(max(1, len(x) - 1).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    key = np.sort((x & ~low) | np.arange(len(x), dtype=np.uint64))
    high = key >> bits
    return (key & low).astype(np.int64), np.append(True, high[1:] != high[:-1])


def _by_value(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """``_order`` of numbers from 0 to ``most``, by all their bits: they are shifted where that leaves room for their places."""
    bits = len(x).bit_length()
    if most.bit_length() + bits <= 64:
        return _order(x.astype(np.uint64) << np.uint64(bits))
    order = np.argsort(x, kind="stable")
    x = x[order]
    return order, np.append(True, x[1:] != x[:-1])


def _distinct_pairs(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` with its inverse, of pairs of ids; those of common vocabularies leave room for their places in 64 bits."""
    if not len(pairs):
        return pairs, np.zeros(0, np.int64)
    one, two = pairs >> 32, pairs & 0xFFFFFFFF
    wide = int(two.max()).bit_length()
    order, begin = _by_value((one << wide) | two, (int(one.max()) + 1 << wide) - 1)
    place = np.empty(len(pairs), np.int64)
    place[order] = np.cumsum(begin) - 1
    return pairs[order[begin]], place


def distinct_slices(sides: list[np.ndarray], cuts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Slices (the same number on each side, none empty) that are the first of their ids, and for each slice which of these it equals.

    Equal hashes (their high bits) are checked by comparing the ids; a slice that only shares a hash stands for itself.
    """
    n = len(cuts[0]) - 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k, (ids, cut) in enumerate(zip(sides, cuts)):
            place = np.arange(len(ids)) - np.repeat(cut[:-1], np.diff(cut))
            total = mix64(total) + np.add.reduceat(mix64((ids.astype(np.uint64) << np.uint64(32)) + place.astype(np.uint64) + np.uint64(k + 1)), cut[:-1])
    order, begin = _order(total)
    first, which = order[begin], np.empty(n, np.int64)
    which[order] = np.cumsum(begin) - 1
    model, same = first[which], np.ones(n, bool)
    for ids, cut in zip(sides, cuts):
        size = np.diff(cut)
        same &= size == size[model]
        kept = np.repeat(same, size)
        shift = np.repeat(np.where(same, cut[:-1][model] - cut[:-1], 0), size)
        differs = kept & (ids != ids[np.arange(len(ids)) + shift])
        same &= np.add.reduceat(differs, cut[:-1], dtype=np.int64) == 0
    alone = np.flatnonzero(~same)
    which[alone] = len(first) + np.arange(len(alone))
    return np.append(first, alone), which


class Aligner:
    """Aligns documents of two vocabularies; groups of tokens are kept for the task, by the bytes of their id tuples.

    A group has its text and its linked id pairs (``A`` id in the high half) with their number of links.
    """

    def __init__(self, tokens_a: list[bytes], tokens_b: list[bytes], memo_bytes: int):
        self.tokens = tuple(pa.array(side, pa.large_binary()) for side in (tokens_a, tokens_b))
        self.length = tuple(np.array([len(t) for t in side], np.int64) for side in (tokens_a, tokens_b))
        self.marked = tuple(np.array([t[:1] == b" " for t in side]) for side in (tokens_a, tokens_b))
        self.memo_bytes, self.held = memo_bytes, memo_bytes + 1

    def _group(self, key: tuple[bytes, bytes]) -> int:
        if (k := self.number.get(key)) is not None:
            return k
        one, two = (np.frombuffer(x, np.uint32).tolist() for x in key)
        pairs = {x << 32 | y: n * m for x, n in Counter(one).items() for y, m in Counter(two).items()}
        self.number[key] = k = len(self.pairs)
        self.text.append(",".join(map(str, one)) + "|" + ",".join(map(str, two)))
        self.pairs.append(list(pairs))
        self.times.append(list(pairs.values()))
        self.held += 500 + 12 * (len(one) + len(two)) + 80 * len(pairs)
        return k

    def spelt(self, side: int, flat: np.ndarray, sizes: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Which texts are spelt by their ids, ``sizes`` of ``flat`` in turn."""
        got = self.tokens[side].take(pa.array(flat))
        at = np.frombuffer(got.buffers()[1], np.int64, len(got) + 1)[np.append(0, np.cumsum(sizes))]
        data = got.buffers()[2].to_pybytes() if len(flat) else b""
        return np.array([data[a:b] == t for a, b, t in zip(at[:-1].tolist(), at[1:].tolist(), texts)], bool)

    def windows(self, flat: list[np.ndarray], doc_ends: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Windows of documents whose ids stand in turn; both sides spell the same bytes.

        ``which``: the distinct window of each window; ``begin``: each document's
        first window (documents + 1); ``n_groups`` and ``groups``: the alignment
        of each distinct window, made once, as numbers of groups.
        """
        if self.held > self.memo_bytes:
            self.number, self.text, self.pairs, self.times, self.held = {}, [], [], [], 0
        none = np.zeros(0, np.int64)
        if not len(flat[0]):
            return {"which": none, "begin": np.zeros(len(doc_ends[0]) + 1, np.int64), "n_groups": none, "groups": none}
        ends, size = [], 0
        common = anchor = None
        for side, (ids, last) in enumerate(zip(flat, doc_ends)):
            ends.append(np.cumsum(self.length[side][ids]))
            marked = np.append(self.marked[side][ids], True)
            marked[last] = True  # a document's end is an anchor
            size = size or int(ends[0][-1]) + 1
            here = np.zeros(size, bool)
            here[ends[side]] = True
            common = here if common is None else common & here
            here = here.copy()
            here[ends[side][~marked[1:]]] = False
            anchor = here if anchor is None else anchor & here
        cuts = [np.append(0, np.flatnonzero(common[e] & np.append(True, e[1:] != e[:-1])) + 1) for e in ends]  # of tokens without bytes, the first
        at = np.append(0, np.flatnonzero(anchor[np.flatnonzero(common)]) + 1)  # windows in groups
        first, which = distinct_slices(flat, [c[at] for c in cuts])
        n_groups = at[first + 1] - at[first]
        chosen = _ranges(at[first], n_groups)
        sides, slices = [], []
        for ids, cut in zip(flat, cuts):
            long = cut[chosen + 1] - cut[chosen]
            sides.append(ids[_ranges(cut[chosen], long)])
            slices.append(np.append(0, np.cumsum(long)))
        model, same = distinct_slices(sides, slices)
        raw = [x.tobytes() for x in sides]
        (i, j), (k, m) = (((4 * c[model]).tolist(), (4 * c[model + 1]).tolist()) for c in slices)
        number = np.array([self._group((raw[0][a:b], raw[1][c:d])) for a, b, c, d in zip(i, j, k, m)], np.int64)
        begin = np.searchsorted(cuts[0][at], np.append(0, doc_ends[0]))
        return {"which": which, "begin": begin, "n_groups": n_groups, "groups": number[same]}

    def digests(self, found: dict[str, np.ndarray]) -> list[str]:
        """sha256 of each document's groups as text; '' without windows."""
        text, out = self.text.__getitem__, []
        n, groups = found["n_groups"], found["groups"]
        first = np.cumsum(n) - n
        for lo, hi in zip(found["begin"][:-1].tolist(), found["begin"][1:].tolist()):
            w = found["which"][lo:hi]
            listed = groups[_ranges(first[w], n[w])].tolist()
            out.append(hashlib.sha256(";".join(map(text, listed)).encode()).hexdigest() if listed else "")
        return out

    def links(self, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of these groups: number of pair rows, and the rows' pairs and times."""
        chosen, local = np.unique(groups, return_inverse=True)
        chosen = chosen.tolist()
        size = np.array([len(self.pairs[g]) for g in chosen], np.int64)
        spread = _ranges((np.cumsum(size) - size)[local], size[local])
        pairs, times = (np.fromiter(chain.from_iterable(x[g] for g in chosen), np.int64)[spread] for x in (self.pairs, self.times))
        return size[local], pairs, times


#: Of a bundle: rows with some of its pairs, from place ``base`` on, and in how many of its documents they are; a row for each document.
BUNDLE = ("bundle long, base int, keys array<long>, docs array<int>, doc struct<doc_id: {id}, n_a: long, n_b: long, n_groups: long, "
          "n_links: long, groups_sha256: string, n_pairs: int, places: binary, times: binary>")
#: Pairs in a row.
KEYS = 1 << 14


def _packed(x: np.ndarray) -> bytes:
    """Numbers as unsigned ones of the least width that holds them all."""
    return x.astype(np.min_scalar_type(int(x.max()))).tobytes() if len(x) else b""


def _unpacked(column: pa.Array, n: np.ndarray) -> np.ndarray:
    """The numbers of all rows of ``_packed`` ones in turn, ``n`` in each row."""
    data, off = text_bytes(column)
    width, begin = np.diff(off) // np.maximum(n, 1), np.cumsum(n) - n
    out = np.zeros(int(n.sum()), np.int64)
    for w in np.unique(width[n > 0]).tolist():
        rows = np.flatnonzero((width == w) & (n > 0))
        out[_ranges(begin[rows], n[rows])] = data[_ranges(off[rows], w * n[rows])].view(f"u{w}")
    return out


class PairList:
    """The distinct pairs of a bundle in the order in which they came, and how many documents hold each."""

    def __init__(self):
        self.sorted, self.place, self.docs = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Places of these (sorted, distinct) pairs, which ``docs`` further documents hold."""
        at = np.searchsorted(self.sorted, keys)
        new = np.append(self.sorted, -1)[at] != keys
        place = np.empty(len(keys), np.int64)
        place[~new] = self.place[at[~new]]
        place[new] = len(self.place) + np.arange(np.count_nonzero(new))
        self.sorted, self.place = np.insert(self.sorted, at[new], keys[new]), np.insert(self.place, at[new], place[new])
        self.docs = np.append(self.docs, np.zeros(len(self.place) - len(self.docs), np.int64))
        self.docs[place] += docs
        return place

    def keys(self) -> np.ndarray:
        out = np.empty(len(self.sorted), np.int64)
        out[self.place] = self.sorted
        return out


def _bundles(vocabulary_a: str, vocabulary_b: str, ranks_a: str | None, bundle_bytes: int, memo_bytes: int, slice_bytes: int,
             chunk: int = 1 << 19):
    def run(batches):
        one, two = in_process(ByteBpe, vocabulary_a, ranks_a), in_process(Pieces, vocabulary_b)
        known = Aligner(one.token_bytes(), two.token_bytes(), memo_bytes)
        number, held, pairs, kind = TaskContext.get().partitionId() << 32, 0, PairList(), None
        for size, table in pieces(batches):
            if held and held + size > bundle_bytes:
                yield from listed(number, pairs, kind)
                number, held, pairs = number + 1, 0, PairList()
            docs = documents(table, one, two, known, pairs)
            held, kind = held + size, docs.type
            yield rows(np.full(len(docs), number), None, None, None, docs)
        if held:
            yield from listed(number, pairs, kind)

    def pieces(batches):
        """Batches of about ``slice_bytes`` of text, and their size; small ones are put together."""
        most, waiting, held = min(slice_bytes, bundle_bytes), [], 0
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for lo, hi in row_slices(off, most):
                part, n = batch.slice(lo, hi - lo), int(off[hi] - off[lo]) + 64 * (hi - lo)
                if waiting and held + n > most:
                    yield held, pa.Table.from_batches(waiting).combine_chunks()
                    waiting, held = [], 0
                # a copy: a slice would hold its whole batch
                waiting.append(pa.RecordBatch.from_arrays([c.take(pa.array(np.arange(len(c)))) for c in part.columns], schema=part.schema))
                held += n
        if waiting:
            yield held, pa.Table.from_batches(waiting).combine_chunks()

    def rows(number, base, keys, held_by, docs):
        """A batch of ``BUNDLE`` rows; None: NULL in all."""
        n, kinds = len(number), (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays(
            [pa.array(number, pa.int64()), *(pa.nulls(n, kind) if x is None else pa.array(x, kind) for x, kind in zip((base, keys, held_by), kinds)),
             docs], names=["bundle", "base", "keys", "docs", "doc"])

    def listed(number, pairs, kind):
        keys = pairs.keys()
        for lo in range(0, len(keys), KEYS):
            yield rows([number], [lo], [keys[lo:lo + KEYS]], [pairs.docs[lo:lo + KEYS]], pa.nulls(1, kind))

    def encode(texts, one, two, known):
        """For both sides the ids, and how many each text has; none of a text that they do not spell."""
        spaced = [" " + t for t in texts]
        data = [t.encode() for t in spaced]
        good = np.array([len(t) > 1 for t in data])
        sides = []
        for side, ids in enumerate((one(spaced), two(texts))):
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))
            good &= known.spelt(side, flat, sizes, data)
            sides.append((flat, sizes))
        return [(flat[np.repeat(good, sizes)], np.where(good, sizes, 0)) for flat, sizes in sides]

    def documents(table, one, two, known, listed_pairs):
        """The documents of a table, as structs; their pairs go to the list."""
        doc_ids, texts = table.column(0).combine_chunks(), table.column(1).to_pylist()
        n = len(texts)
        flat, counts, lo, held = ([], []), ([], []), 0, 0
        for k in range(n):
            held += len(texts[k] or "")
            if held > chunk or k == n - 1:  # few texts' token lists at a time
                for side, (ids, sizes) in enumerate(encode([t or "" for t in texts[lo:k + 1]], one, two, known)):
                    flat[side].append(ids)
                    counts[side].extend(sizes.tolist())
                lo, held = k + 1, 0
        found = known.windows([np.concatenate(f) for f in flat], [np.cumsum(c) for c in counts])
        sha, windows, n_windows = known.digests(found), found["which"], np.diff(found["begin"])
        groups, doc, n_kinds = found["n_groups"], np.repeat(np.arange(n), n_windows), max(1, len(found["n_groups"]))
        n_rows, pairs, times = known.links(found["groups"])
        size = np.bincount(np.repeat(np.arange(len(groups)), groups), n_rows, len(groups)).astype(np.int64)
        n_groups = np.bincount(doc, groups[windows], n).astype(np.int64)
        keys, place = _distinct_pairs(pairs)
        once = np.sort(doc * n_kinds + windows)  # each window of a document once, then each pair of it once
        first = np.flatnonzero(np.append(True, once[1:] != once[:-1])) if len(once) else once
        often, once = np.diff(np.append(first, len(once))), once[first]
        doc, local = once // n_kinds, once % n_kinds
        spread = _ranges((np.cumsum(size) - size)[local], size[local])
        held_by = np.repeat(doc, size[local]) * max(1, len(keys)) + place[spread]
        times = np.repeat(often, size[local]) * times[spread]
        if len(held_by):
            order, begin = _by_value(held_by, n * len(keys) - 1)
            held_by, times = held_by[order[begin]], np.add.reduceat(times[order], np.flatnonzero(begin))
        doc, local = held_by // max(1, len(keys)), held_by % max(1, len(keys))
        at = np.searchsorted(doc, np.arange(n + 1))
        total = np.append(0, np.cumsum(times))[at]
        place = listed_pairs.add(keys, np.bincount(local, minlength=len(keys)))[local]
        return pa.StructArray.from_arrays(
            [doc_ids, *(pa.array(x, pa.int64()) for x in (*counts, n_groups, np.diff(total))), pa.array(sha, pa.string()), pa.array(np.diff(at), pa.int32()),
             *(pa.array([_packed(x[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary()) for x in (place, times))],
            names=["doc_id", *COUNTS, "groups_sha256", "n_pairs", "places", "times"])
    return run


def _sums(docs: pa.StructArray, best: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    """Documents with their sums over links, by what each pair of their bundle has."""
    n = docs.field("n_pairs").to_numpy().astype(np.int64)
    places, times = (_unpacked(docs.field(c), n) for c in ("places", "times"))
    at = np.append(0, np.cumsum(n))
    sums = [np.diff(np.append(0, np.cumsum(times * value[places]))[at]) for value in (best, count)]
    return pa.RecordBatch.from_arrays([docs.field("doc_id"), *(docs.field(c) for c in COUNTS), *map(pa.array, sums), docs.field("groups_sha256")],
                                      names=["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"])


def _summed(batches):
    """Bundles in turn, each with the values of its pairs in order and then its documents -> the documents with their sums."""
    at, got = None, []
    for batch in batches:
        bundle = batch.column("bundle").to_numpy()
        cuts = np.append(np.flatnonzero(np.append(True, bundle[1:] != bundle[:-1])), len(bundle)) if len(bundle) else bundle
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if bundle[lo] != at:
                at, got = bundle[lo], []
            value, docs = (batch.column(c).slice(lo, hi - lo) for c in ("value", "doc"))
            n = len(value) - value.null_count
            if n:
                got.append(value.slice(0, n).to_numpy().copy())
            docs = docs.slice(n)
            if len(docs):
                got = [np.concatenate(got)] if got else [np.zeros(0, np.int64)]
                off = np.append(0, np.cumsum(docs.field("n_pairs").to_numpy().astype(np.int64)))
                for a, b in row_slices(off, 1 << 20):
                    yield _sums(docs.slice(a, b - a), got[0] & 1, got[0] >> 1)


def link_bundles(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, ranks_a: str | None = None, bundle_bytes: int = 1 << 23,
                 memo_bytes: int = 96 << 20, slice_bytes: int = 1 << 21) -> DataFrame:
    """The documents' aligned bundles, written: see ``BUNDLE``. The vocabularies are paths on the workers."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    run = _bundles(vocabulary_a, vocabulary_b, ranks_a, bundle_bytes, memo_bytes, slice_bytes)
    return written(docs.select("doc_id", "text").mapInArrow(run, BUNDLE.format(id=kind)), "bundles")


def pair_counts(bundles: DataFrame) -> DataFrame:
    """(key, a, b, n, best): in how many documents a pair of ids is linked, and whether that is the most of its ``A`` id; written."""
    counts = (bundles.where("keys is not null").select(F.explode(F.arrays_zip("keys", "docs")).alias("p")).groupBy(F.col("p.keys").alias("key"))
              .agg(F.sum(F.col("p.docs").cast("long")).alias("n"))
              .select("key", F.shiftright("key", 32).alias("a"), F.col("key").bitwiseAND((1 << 32) - 1).alias("b"), "n"))
    counts = written(counts, "counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return written(counts.join(most, "a").select("key", "a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def align_documents(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, ranks_a: str | None = None, **sizes) -> tuple[DataFrame, DataFrame]:
    """Per document its tokens, groups, links and their sums, and the table of all id pairs (``pair_counts``)."""
    bundles = link_bundles(docs, vocabulary_a, vocabulary_b, ranks_a, **sizes)
    pairs = pair_counts(bundles)
    asked = bundles.where("keys is not null").select("bundle", "base", F.posexplode("keys").alias("k", "key"))
    wanted = asked.join(pairs.select("key", "n", "best"), "key").select(
        "bundle", (F.col("base") + F.col("k")).alias("place"), (F.col("n") * 2 + F.col("best").cast("long")).alias("value"))
    rows = bundles.where("doc is not null").select("bundle", "doc")
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = (wanted.unionByName(rows, allowMissingColumns=True).repartition("bundle")
           .sortWithinPartitions("bundle", F.col("place").asc_nulls_last())
           .mapInArrow(_summed, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                       "groups_sha256 string"))
    return out, pairs
