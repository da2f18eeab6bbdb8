"""Packing: bounded-space online packing of tokenised documents into sequences of a fixed size.

Each task keeps ``space`` open sequences. A document's ids fill whole sequences
as long as they can; the rest goes where it fits best. When it fits nowhere and
all open sequences are in use, the fullest is filled up with the document's
head (documents may be cut), emitted without padding, and the rest placed anew.
The open sequences left at a task's end are merged by the same packer, those of
``merge`` tasks together, and at its end laid end to end, so that one sequence
in ``merge`` tasks is padded. Pieces are written once to the shared folder.

Defined results: a NULL or empty text is the single end id. Repeated rows are
packed row by row, NULL ids too; ties go to the sequence opened first. An empty
table gives no piece. Other columns are not carried (pieces have their own).
A text is tokenised whole, however long, and cut into pieces of ``size``. The
vocabulary's added tokens keep their ids where a text holds their strings.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import row_slices, text_bytes, written
from mercato.llm.vocabularies import ByteBpe, in_process

PIECES = ("doc_id {id}, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, open boolean")
#: Sequences of merged leftovers are numbered from here.
MERGED = 1 << 62


class Packer:
    """Open sequences of one task, and the pieces that are ready."""

    def __init__(self, size: int, space: int, first: int):
        self.size, self.space, self.next = size, space, first
        self.open: list[list] = []  # [number, ids used, pieces]
        self.ready: list[tuple] = []
        self.tokens = 0

    def _start(self) -> list:
        self.open.append([self.next, 0, []])
        self.next += 1
        return self.open[-1]

    def _put(self, window: list, doc, start: int, ids: np.ndarray, total: int) -> None:
        window[2].append((doc, start, ids, total, window[0], window[1]))
        window[1] += len(ids)
        if window[1] == self.size:
            self._emit(window)

    def _emit(self, window: list) -> None:
        self.ready.extend(window[2])
        self.tokens += window[1]
        self.open.remove(window)

    def place(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        at = 0
        while len(ids) - at >= self.size:
            self.ready.append((doc, start + at, ids[at:at + self.size], total, self.next, 0))
            self.tokens += self.size
            self.next += 1
            at += self.size
        while at < len(ids):
            rest = len(ids) - at
            fits = [w for w in self.open if self.size - w[1] >= rest]
            if fits:
                self._put(max(fits, key=lambda w: w[1]), doc, start + at, ids[at:], total)
                return
            if len(self.open) < self.space:
                self._put(self._start(), doc, start + at, ids[at:], total)
                return
            fullest = max(self.open, key=lambda w: w[1])
            free = self.size - fullest[1]
            self._put(fullest, doc, start + at, ids[at:at + free], total)
            at += free

    def lay_out(self) -> None:
        """Lays the open sequences' pieces end to end; the last is left as long as it is."""
        rest = [p for w in sorted(self.open, key=lambda w: -w[1]) for p in w[2]]
        self.open, self.space = [], 1
        for doc, start, ids, total, _, _ in rest:
            self.place(doc, start, ids, total)
        for w in list(self.open):
            self._emit(w)

    def take(self, names: list[str], kind: pa.DataType, leftover: bool = False) -> pa.RecordBatch:
        rows = [p for w in self.open for p in w[2]] if leftover else self.ready
        doc, start, ids, total, seq, offset = zip(*rows) if rows else ((),) * 6
        if not leftover:
            self.ready, self.tokens = [], 0
        lengths = [len(x) for x in ids]
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        return pa.RecordBatch.from_arrays([
            pa.array(doc, kind), pa.array(start, pa.int64()), pa.array(lengths, pa.int64()),
            pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.array(flat.astype(np.int32))),
            pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()), pa.array(total, pa.int64()),
            pa.array(seq, pa.int64()), pa.array(offset, pa.int64()), pa.array([leftover] * len(rows), pa.bool_())], names=names)


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, space: int = 16, end: int = 1, merge: int = 64,
         flush: int = 1 << 20, ranks: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` and ``length`` in its document's ids, ``ids`` and their crc32,
    ``doc_tokens``, ``sequence_id`` and ``offset`` there. ``tokenizer`` is the path of a vocabulary file on the workers;
    ``ranks``, of the same vocabulary in the form that is read faster (the ids are the same)."""
    kind = docs.schema["doc_id"].dataType
    ddl = PIECES.format(id=kind.simpleString())
    names = [part.split()[0] for part in ddl.split(", ")]

    def first_round(batches):
        encode = in_process(ByteBpe, tokenizer, ranks, False)
        packer = Packer(size, space, TaskContext.get().partitionId() << 32)
        id_type = None
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            id_type = ids.type
            _, off = text_bytes(texts)
            for lo, hi in row_slices(off, 1 << 20):
                found = encode([t or "" for t in texts.slice(lo, hi - lo).to_pylist()])
                for doc, x in zip(ids.slice(lo, hi - lo).to_pylist(), found):
                    x = np.array([*x, end], np.int32)
                    packer.place(doc, 0, x, len(x))
                if packer.tokens > flush:
                    yield packer.take(names, id_type)
        if id_type is not None:
            yield packer.take(names, id_type)
            yield packer.take(names, id_type, leftover=True)

    def merge_round(batches):
        packer = Packer(size, space, MERGED + (TaskContext.get().partitionId() << 32))
        id_type = None
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "start", "ids", "doc_tokens")]
            id_type = cols[0].type
            for doc, start, ids, total in zip(cols[0].to_pylist(), cols[1].to_pylist(), cols[2], cols[3].to_pylist()):
                packer.place(doc, start, ids.values.to_numpy().astype(np.int32), total)
        if id_type is not None:
            packer.lay_out()
            yield packer.take(names, id_type)

    pieces = written(docs.select("doc_id", "text").mapInArrow(first_round, ddl), "pieces")
    task = F.shiftright("sequence_id", 32)
    left = pieces.where("open")
    tasks = left.agg(F.countDistinct(task)).first()[0]
    merged = (left.withColumn("_task", task).repartition(max(1, -(-tasks // merge)), "_task")
              .sortWithinPartitions("sequence_id", "offset").drop("_task").mapInArrow(merge_round, ddl))
    return pieces.where("NOT open").unionByName(merged).drop("open")
