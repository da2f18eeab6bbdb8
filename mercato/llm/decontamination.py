"""Benchmark decontamination: an FM-index of words for each training shard, searched backwards for test phrases.

Documents are gathered into shards of a few megabytes. A shard's words, numbered
by its own vocabulary, and an end mark after each document are suffix-sorted
(prefix doubling; only suffixes still tied are sorted again) and kept as their
Burrows-Wheeler transform in a wavelet tree, laid out by levels, with every
16th suffix position. The index is written once, one row a shard; any number of
test sets can be searched in it.

A test item's phrases are its windows of ``width`` words (an item of fewer words
is one phrase). Distinct phrases are searched in blocks of a fixed number of
words: each block goes to all shards, where backward search narrows a suffix
range by one word after the other, with two wavelet-tree ranks a word, for all
phrases at once. Occurrences are located by walking back to the nearest sampled
position. Spans that overlap or touch are merged in the shard, and once more
over blocks and the pieces of a long text; phrases lead to items by a join.

Defined results: NULL, empty and wordless texts have no words and are clean;
items without words have no phrase. A repeated document row is judged by itself,
a NULL id is kept. Repeated items, and items that share an id, count once; an
item without an id marks words but is not listed. Empty tables give empty or
clean results. Only ids and texts are read, so that other columns never clash.
Texts are read whole: one longer than a shard is indexed in pieces that overlap
by ``width - 1`` words. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import lower_table, mix64, row_slices, text_bytes, written

SAMPLE = 16


# ------------------------------------------------------------------ words
def word_table() -> np.ndarray:
    """Byte table: belongs to a word of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` (after A-Z became a-z)."""
    t = np.zeros(256, bool)
    t[48:58] = t[97:123] = t[128:] = True
    return t


def hashed_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of all rows: hashes, starts and ends in ``data``; and for each row the index of its first word (rows + 1)."""
    data = lower_table()[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = word_table()[data]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends, np.zeros(len(off), np.int64)
    size = ends - starts
    place = np.arange(len(data) + 1) - np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [len(data) + 1]])))
    with np.errstate(over="ignore"):
        letters = mix64((np.append(data, 0).astype(np.uint64) << np.uint64(32)) + place.astype(np.uint64))
        hashes = mix64(np.add.reduceat(letters, np.stack([starts, ends], 1).ravel())[::2] + size.astype(np.uint64))
    return hashes, starts, ends, np.searchsorted(starts, off)


def long_text_words(data: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Word hashes of one long text, in pieces of about ``most`` bytes that end between words."""
    lo, inside = 0, word_table()
    while lo < len(data):
        hi = lo + most
        while hi < len(data):
            outside = np.flatnonzero(~inside[lower_table()[data[hi:hi + 4096]]])
            if len(outside):
                hi += int(outside[0])
                break
            hi += 4096
        part = data[lo:hi]
        yield hashed_words(part, np.array([0, len(part)]))[0]
        lo = hi


# ------------------------------------------------------------------ the index
def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes; symbol 0 ends a document, and such ends differ by their place, so none is compared beyond."""
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    rank = symbols.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    order = np.argsort(rank, kind="stable")
    value = rank[order]
    begin = np.append(True, value[1:] != value[:-1])
    rank[order] = np.maximum.accumulate(np.where(begin, np.arange(n), 0))
    step = 1
    while True:
        tied = np.flatnonzero(~(begin & np.append(begin[1:], True)))  # places in groups of two or more
        if not len(tied):
            return order
        here = order[tied]
        key = (rank[here] << 32) | rank[here + step]  # a tied suffix holds no end in its first ``step`` words
        by = np.argsort(key)
        key, here = key[by], here[by]
        order[tied] = here
        new = np.append(True, key[1:] != key[:-1])
        begin[tied] = new
        rank[here] = np.maximum.accumulate(np.where(new, tied, 0))
        step *= 2


def wavelet_levels(symbols: np.ndarray, bits: int) -> np.ndarray:
    """Bits of the symbols, highest first; after each level the symbols stand in order of the bits so far read. Packed, a row a level."""
    words = len(symbols) // 64 + 1
    out = np.zeros((bits, words * 8), np.uint8)
    for level in range(bits):
        bit = (symbols >> (bits - 1 - level)) & 1 == 1
        packed = np.packbits(bit, bitorder="little")
        out[level, :len(packed)] = packed
        symbols = np.concatenate([symbols[~bit], symbols[bit]])
    return out.view(np.uint64)


class Bits:
    """Bit rows with ranks."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        count = np.bitwise_count(rows).astype(np.int64)
        self.before = np.concatenate([np.zeros((len(rows), 1), np.int64), np.cumsum(count, axis=1)], axis=1)

    def rank(self, row: int, at: np.ndarray) -> np.ndarray:
        """Number of ones before ``at``."""
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << rest) - np.uint64(1)
        return self.before[row, word] + np.bitwise_count(self.rows[row, word] & mask)

    def get(self, row: int, at: np.ndarray) -> np.ndarray:
        return (self.rows[row, at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def build(hashes: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """The index of documents with these numbers of words, as arrays: sorted vocabulary, numbers of smaller symbols, wavelet
    levels, marks of sampled suffixes and their positions."""
    vocabulary, word = np.unique(hashes, return_inverse=True)
    n = len(hashes) + len(sizes)
    symbols = np.zeros(n, np.int64)
    stops = np.cumsum(sizes + 1) - 1
    text = np.ones(n, bool)
    text[stops] = False
    symbols[text] = word + 1
    order = suffix_array(symbols)
    before = symbols[order - 1]  # place -1 is the last end mark
    bits = max(1, int(len(vocabulary)).bit_length())
    known = (order % SAMPLE == 0) | (before == 0)  # a walk back never leaves a document
    marks = np.zeros((n // 64 + 1) * 8, np.uint8)
    packed = np.packbits(known, bitorder="little")
    marks[:len(packed)] = packed
    smaller = np.append(0, np.cumsum(np.bincount(symbols, minlength=len(vocabulary) + 1)))
    return {"vocabulary": vocabulary, "smaller": smaller.astype(np.int32), "levels": wavelet_levels(before, bits).ravel(),
            "marks": marks.view(np.uint64), "samples": order[known].astype(np.int32)}


class FmIndex:
    """Search in the arrays of ``build``."""

    def __init__(self, vocabulary, smaller, levels, marks, samples):
        self.vocabulary, self.smaller, self.samples = vocabulary, smaller.astype(np.int64), samples
        self.bits = max(1, int(len(vocabulary)).bit_length())
        self.tree, self.marks = Bits(levels.reshape(self.bits, -1)), Bits(marks.reshape(1, -1))
        self.n = int(self.smaller[-1])
        self.zeros = [self.n - int(self.tree.rank(k, np.array([self.n]))[0]) for k in range(self.bits)]

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of words, 0 for those that the shard does not have."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` entries are ``symbol``."""
        begin = np.zeros_like(at)
        for k in range(self.bits):
            one = (symbol >> (self.bits - 1 - k)) & 1 == 1
            both = self.tree.rank(k, np.concatenate([begin, at]))
            ones_begin, ones_at = both[:len(at)], both[len(at):]
            begin = np.where(one, self.zeros[k] + ones_begin, begin - ones_begin)
            at = np.where(one, self.zeros[k] + ones_at, at - ones_at)
        return at - begin

    def back(self, at: np.ndarray) -> np.ndarray:
        """Place of the suffix that is one word longer."""
        symbol, here, begin = np.zeros_like(at), at, np.zeros_like(at)
        for k in range(self.bits):
            one = self.tree.get(k, here)
            both = self.tree.rank(k, np.concatenate([begin, here]))
            ones_begin, ones_here = both[:len(at)], both[len(at):]
            begin = np.where(one, self.zeros[k] + ones_begin, begin - ones_begin)
            here = np.where(one, self.zeros[k] + ones_here, here - ones_here)
            symbol = symbol * 2 + one
        return self.smaller[symbol] + here - begin

    def search(self, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases, given as rows of symbols that end in the last column; (0, 0) where there is none."""
        lo, hi = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        width = words.shape[1]
        whole = (words > 0) | (np.arange(width) < (width - sizes)[:, None])
        live = np.flatnonzero(whole.all(axis=1) & (sizes > 0))
        if len(live):
            last = words[live, -1]
            lo[live], hi[live] = self.smaller[last], self.smaller[last + 1]
        for k in range(2, width + 1):
            live = live[hi[live] > lo[live]]
            step = live[sizes[live] >= k]
            if not len(step):
                break
            symbol = words[step, width - k]
            found = self.rank(np.concatenate([symbol, symbol]), np.concatenate([lo[step], hi[step]]))
            lo[step], hi[step] = self.smaller[symbol] + found[:len(step)], self.smaller[symbol] + found[len(step):]
        return lo, hi

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Positions of the suffixes at these places."""
        out, steps, todo = np.zeros(len(at), np.int64), 0, np.arange(len(at))
        while len(todo):
            here = at[todo]
            known = self.marks.get(0, here)
            out[todo[known]] = self.samples[self.marks.rank(0, here[known])] + steps
            todo, here = todo[~known], here[~known]
            at = at.copy()
            at[todo] = self.back(here)
            steps += 1
        return out


def merged_spans(group: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each group, those that overlap or touch as one, in order."""
    if not len(start):
        return group, start, stop
    order = np.lexsort((start, group))
    group, start, stop = group[order], start[order], stop[order]
    far = int(stop.max()) + 2
    reach = np.maximum.accumulate(stop + group * far) - group * far  # a group's reach hides the ones before
    begin = np.append(True, (group[1:] != group[:-1]) | (start[1:] > reach[:-1]))
    return group[begin], start[begin], np.maximum.reduceat(stop, np.flatnonzero(begin))


# ------------------------------------------------------------------ Spark jobs
SHARD = ("shard long, row array<long>, doc_id array<{id}>, n_words array<long>, skipped array<long>, sizes array<int>, vocabulary binary, "
         "smaller binary, levels binary, marks binary, samples binary")


def _index(shard_bytes: int, width: int, names: list[str]):
    def run(batches):
        task, number, row = TaskContext.get().partitionId() << 32, 0, 0
        for ids, data, off in gathered(batches):
            for lo, hi in row_slices(off, shard_bytes):
                if off[hi] - off[lo] <= 2 * shard_bytes or hi - lo > 1:
                    hashes, _, _, at = hashed_words(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                    sizes = np.diff(at)
                    yield shard(task + number, task + row + np.arange(hi - lo), ids.slice(lo, hi - lo), sizes, np.zeros(hi - lo, np.int64), sizes, hashes)
                    number += 1
                else:
                    total = sum(len(h) for h in long_text_words(data[off[lo]:off[hi]], shard_bytes))
                    last, done = np.zeros(0, np.uint64), 0
                    for h in long_text_words(data[off[lo]:off[hi]], shard_bytes):
                        h = np.concatenate([last, h])
                        yield shard(task + number, [task + row], ids.slice(lo, 1), [total], [done], np.array([len(h)]), h)
                        number, total = number + 1, -1  # the words are told once
                        last = h[max(0, len(h) - width + 1):]
                        done += len(h) - len(last)
                row += hi - lo

    def gathered(batches):
        """Ids, bytes and offsets of about a shard's texts; Arrow batches have a fixed number of rows, whatever their length."""
        ids, texts, held = [], [], 0
        for batch in batches:
            ids.append(batch.column(0))
            texts.append(batch.column(1))
            held += batch.nbytes
            if held >= shard_bytes:
                yield pa.chunked_array(ids).combine_chunks(), *text_bytes(joined(texts))
                ids, texts, held = [], [], 0
        if ids:
            yield pa.chunked_array(ids).combine_chunks(), *text_bytes(joined(texts))

    def joined(texts):
        return pa.chunked_array([t.cast(pa.large_string()) for t in texts]).combine_chunks()

    def shard(number, row, ids, n_words, skipped, sizes, hashes):
        made = build(hashes, sizes)
        one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), one(row, pa.int64()), one(ids, ids.type), one(n_words, pa.int64()), one(skipped, pa.int64()),
             one(sizes, pa.int32()), *(pa.array([made[k].tobytes()], pa.binary()) for k in names[6:])], names=names)
    return run


def index_shards(docs: DataFrame, width: int = 10, shard_bytes: int = 1 << 22) -> DataFrame:
    """The index, written: one row a shard (see ``SHARD``), with its documents' numbers (``row``), ids and words."""
    ddl = SHARD.format(id=docs.schema["doc_id"].dataType.simpleString())
    names = [part.split()[0] for part in ddl.split(", ")]
    return written(docs.select("doc_id", "text").mapInArrow(_index(shard_bytes, width, names), ddl), "index")


def _phrases(width: int):
    def run(batches):
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for lo, hi in row_slices(off):
                hashes, _, _, at = hashed_words(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                words = hashes.view(np.int64)
                ids, found = [], []
                for k, (a, b) in enumerate(zip(at[:-1], at[1:])):
                    size = min(width, int(b - a))
                    windows = range(int(b - a) - size + 1) if size else ()
                    found += [words[a + w:a + w + size] for w in windows]
                    ids += [k] * len(windows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).take(pa.array(ids, pa.int64())), pa.array(found, pa.list_(pa.int64()))], names=["item_id", "words"])
    return run


def test_phrases(items: DataFrame, width: int = 10) -> tuple[DataFrame, DataFrame]:
    """Distinct phrases (phrase, words), numbered, and which items hold them (phrase, item_id); both written."""
    kind = items.schema["item_id"].dataType.simpleString()
    found = written(items.select("item_id", "text").mapInArrow(_phrases(width), f"item_id {kind}, words array<long>").distinct(), "windows")
    phrases = written(found.select("words").distinct().withColumn("phrase", F.monotonically_increasing_id()), "phrases")
    return phrases, written(found.where("item_id IS NOT NULL").join(phrases, "words").select("phrase", "item_id"), "items")


def _searched(block, width: int):
    def run(batches):
        phrase, sizes, distinct, which = block.value  # words by their numbers, rows end in the last column
        for batch in batches:
            part = {c: batch.column(k) for k, c in enumerate(batch.schema.names)}
            for k in range(batch.num_rows):
                kinds = {"vocabulary": np.uint64, "smaller": np.int32, "levels": np.uint64, "marks": np.uint64, "samples": np.int32}
                index = FmIndex(**{c: np.frombuffer(part[c][k].as_buffer(), t) for c, t in kinds.items()})
                symbols = np.append(index.symbols(distinct), 0)
                lo, hi = index.search(symbols[which], sizes)
                times = hi - lo
                hit = np.flatnonzero(times)
                if not len(hit):
                    continue
                stop = np.cumsum(times[hit])
                at = np.repeat(lo[hit] - (stop - times[hit]), times[hit]) + np.arange(stop[-1])
                found, p = index.locate(at), np.repeat(hit, times[hit])
                size = part["sizes"][k].values.to_numpy().astype(np.int64)
                first = np.cumsum(size + 1) - (size + 1)
                doc = np.searchsorted(first, found, "right") - 1
                begin = found - first[doc] + part["skipped"][k].values.to_numpy()[doc]
                group, start, end = merged_spans(doc, begin, begin + sizes[p])
                once = np.unique(np.stack([doc, p]), axis=1)
                docs, cut = np.unique(group, return_index=True)
                lists = lambda x, at: pa.ListArray.from_arrays(pa.array(np.append(at, len(x)), pa.int32()), x)
                spans = pa.StructArray.from_arrays([pa.array(start), pa.array(end)], ["start", "stop"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part["row"][k].values.to_numpy()[docs]), lists(spans, cut),
                     lists(pa.array(phrase[once[1]]), np.searchsorted(once[0], docs))], names=["row", "spans", "phrases"])
    return run


def occurrences(index: DataFrame, phrases: DataFrame, width: int = 10, block_words: int = 1 << 21) -> DataFrame:
    """(row, spans, phrases): for a document, a shard and a block of phrases, merged spans in words and the phrases that occur; written.

    A block has about ``block_words`` words (8 bytes each on the driver and in the
    broadcast); there are as many blocks as the phrases need, and each is searched in all shards.
    """
    spark, found = index.sparkSession, None
    total = phrases.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    ddl = "row long, spans array<struct<start:long,stop:long>>, phrases array<long>"
    held = []
    for b in range(blocks):
        rows = phrases.where(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == b).select("phrase", "words").toArrow()
        lists = rows.column("words").combine_chunks()
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        flat = lists.flatten().to_numpy().view(np.uint64)
        sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        distinct, at = np.unique(flat, return_inverse=True)
        which = np.full((len(sizes), width), len(distinct), np.int32)  # beyond the distinct words: none
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        which[np.repeat(np.arange(len(sizes)), sizes), np.repeat(width - sizes, sizes) + place] = at
        block = spark.sparkContext.broadcast((rows.column("phrase").to_numpy(), sizes, distinct, which))
        one = written(index.drop("doc_id", "n_words", "shard").mapInArrow(_searched(block, width), ddl), "found")
        held.append(block)
        found = one if found is None else found.unionByName(one)
    for block in held:
        block.unpersist()
    return found


def _joined_spans(spans: Column) -> Column:
    """Sorted spans, those that overlap or touch as one."""
    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))
        return (F.when(F.size(done) == 0, F.array(x)).when(x["start"] > last["stop"], F.array_append(done, x))
                .otherwise(F.array_append(F.slice(done, 1, F.size(done) - 1), grown)))
    return F.aggregate(F.array_sort(spans), empty, add)


def contaminated(docs: DataFrame, items: DataFrame, width: int = 10, shard_bytes: int = 1 << 22, block_words: int = 1 << 21) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``spans`` (merged word ranges that occur in test items), ``n_hit`` words in
    them, and ``items``, the ids of the items whose phrases occur, sorted as strings."""
    index = index_shards(docs, width, shard_bytes)
    phrases, held_by = test_phrases(items, width)
    found = occurrences(index, phrases, width, block_words)
    spans = (found.select("row", F.explode("spans").alias("s")).groupBy("row")
             .agg(_joined_spans(F.collect_list("s")).alias("spans")))
    named = (found.select("row", F.explode("phrases").alias("phrase")).join(held_by, "phrase")
             .select("row", F.col("item_id").cast("string").alias("item")).distinct()
             .groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items")))
    known = (index.select(F.explode(F.arrays_zip("row", "doc_id", "n_words")).alias("d")).where("d.n_words >= 0")
             .select("d.row", "d.doc_id", "d.n_words"))
    hits = written(spans.join(named, "row", "left"), "hits")
    no_spans, no_items = F.array().cast("array<struct<start:bigint,stop:bigint>>"), F.array().cast("array<string>")
    out = known.join(hits, "row", "left").withColumns({"spans": F.coalesce("spans", no_spans), "items": F.coalesce("items", no_items)})
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return out.select("doc_id", "n_words", "spans", n_hit.alias("n_hit"), "items")
