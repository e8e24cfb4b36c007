"""Bounded-space online packing of token sequences.

Documents become token ids plus an end id.  Each task takes its documents as they come and keeps a
fixed number of open windows.  A document goes, best fit, into the window that it leaves the least
room in.  Where it fits none and no further window may be opened, the fullest window is emitted; if
that leaves more than SLACK tokens empty, the document's head fills it first, and its tail is placed
anew.  So at most one document a sequence is cut, and no sequence but the last has more than SLACK
tokens of padding.  Of documents longer than a window, whole windows are cut first.

At the end each task has at most WINDOWS windows left.  These, of FAN_IN tasks at a time, are packed the
same way, longest pieces first, and so on in a tree.  The last windows are emitted if they are nearly
full, else run together; the tail left is cut into powers of two, which need no padding.

Rows: a null or empty text is the end id alone.  Every row is packed, repeated rows and null ids
included.  Further columns are ignored.
"""
from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldops.llm import common as C
from fieldops.llm.packing import Encoder

CAPACITY = 2048
END_ID = 1
#: open windows of a task
WINDOWS = 64
#: empty tokens with which a window may be emitted
SLACK = 8
#: tasks whose last windows are packed together
FAN_IN = 8
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: rows of open windows carry their ids; ``owner`` is the task or group that they are left from
OPEN = PIECES + ", owner long, ids binary"


class Piece(NamedTuple):
    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int


class Packer:
    """Open windows of one task; emitted ones are numbered from first_id on."""

    def __init__(self, first_id: int, capacity: int = CAPACITY, windows: int = WINDOWS, slack: int = SLACK):
        self.capacity, self.windows, self.slack = capacity, windows, slack
        self.next_id = first_id
        self.rooms: list[tuple[int, int]] = []  # (room, window) in order: the fullest first
        self.open: dict[int, list[Piece]] = {}
        self.opened = 0
        self.rows: list[tuple] = []

    def add(self, piece: Piece) -> None:
        while len(piece.ids):
            if len(piece.ids) >= self.capacity:
                head, piece = _split(piece, self.capacity)
                self.emit([head])
                continue
            need = len(piece.ids)
            at = bisect_left(self.rooms, (need, -1))
            if at == len(self.rooms):
                if len(self.rooms) < self.windows:
                    self.open[self.opened] = [piece]
                    insort(self.rooms, (self.capacity - need, self.opened))
                    self.opened += 1
                    return
                room, window = self.rooms.pop(0)  # none fits: the fullest goes
                pieces = self.open.pop(window)
                if room > self.slack:
                    head, piece = _split(piece, room)
                    pieces.append(head)
                self.emit(pieces)
                continue
            room, window = self.rooms.pop(at)
            self.open[window].append(piece)
            if room == need:
                self.emit(self.open.pop(window))
            else:
                insort(self.rooms, (room - need, window))
            return

    def emit(self, pieces: list[Piece]) -> None:
        offset = 0
        for p in pieces:
            self.rows.append((p.doc_id, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.doc_tokens, self.next_id, offset, None, None))
            offset += len(p.ids)
        self.next_id += 1

    def leave(self, owner: int) -> None:
        """The open windows as rows that carry their ids."""
        for pieces in self.open.values():
            self.rows += [(p.doc_id, p.start, len(p.ids), None, p.doc_tokens, None, None, owner, p.ids.tobytes()) for p in pieces]

    def finish(self) -> None:
        """Emit all: nearly full windows as they are, the others run together, the tail in powers of two."""
        rest = []
        for room, window in self.rooms:
            if room <= self.slack:
                self.emit(self.open[window])
            else:
                rest += self.open[window]
        self.rooms, self.open = [], {}
        left = sum(len(p.ids) for p in rest)
        sizes = [self.capacity] * (left // self.capacity)
        left %= self.capacity
        sizes += [1 << bit for bit in reversed(range(left.bit_length())) if left >> bit & 1]
        rest.reverse()
        for size in sizes:
            pieces = []
            while size:
                head, tail = _split(rest.pop(), size)
                pieces.append(head)
                size -= len(head.ids)
                if len(tail.ids):
                    rest.append(tail)
            self.emit(pieces)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[]] * 9
        self.rows = []
        kinds = [pa.int64()] * 8 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=[f.split()[0] for f in OPEN.split(", ")])


def _split(piece: Piece, size: int) -> tuple[Piece, Piece]:
    return piece._replace(ids=piece.ids[:size]), piece._replace(start=piece.start + size, ids=piece.ids[size:])


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, windows: int = WINDOWS,
         slack: int = SLACK, fan_in: int = FAN_IN) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece of docs (doc_id, text)."""

    def online(batches):
        encoder, task = Encoder(tokenizer_path), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4")
        packer = Packer(task << 24, capacity, windows, slack)
        for b in C.steps(batches):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.concatenate((encoder.encode(text.as_py() or ""), end))
                packer.add(Piece(doc_id, 0, ids, len(ids)))
            yield packer.batch()
        packer.leave(task)
        yield packer.batch()

    source = docs.select(F.col("doc_id").cast("long"), "text")
    done = C.staged(source.mapInArrow(online, OPEN), "windows")
    owners, level = source.rdd.getNumPartitions(), 0
    out = done.where("ids is null")
    while True:
        level, last = level + 1, owners <= fan_in
        merged = C.staged(done.where("ids is not null").withColumn("g", F.expr(f"owner div {fan_in}")).groupBy("g").applyInArrow(
            _merge(level, last, capacity, windows, slack), OPEN), "windows")
        out = out.unionByName(merged.where("ids is null"))
        if last:
            return out.drop("owner", "ids")
        done, owners = merged, -(-owners // fan_in)


def _merge(level: int, last: bool, capacity: int, windows: int, slack: int):
    def run(rows: pa.Table) -> pa.Table:
        group = rows.column("g")[0].as_py()
        packer = Packer((level << 56) + (group << 24), capacity, windows, slack)
        taken = rows.select(["doc_id", "start", "ids", "doc_tokens"]).sort_by(
            [("doc_tokens", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        pieces = [Piece(d, s, np.frombuffer(x, "<u4"), n) for d, s, x, n in zip(*[c.to_pylist() for c in taken.columns])]
        for p in sorted(pieces, key=lambda p: -len(p.ids)):
            packer.add(p)
        if last:
            packer.finish()
        else:
            packer.leave(group)
        return pa.Table.from_batches([packer.batch()])

    return run
