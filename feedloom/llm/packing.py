"""Sum-of-squares online packing of documents into fixed windows.

Each task packs its own documents as they come, with no shuffle.  A document's
whole windows stand alone; what is left over goes, as one piece, to the fill
level that makes the sum of squared counts of partially filled windows
smallest.  A level array holds those counts.  When the documents end, the open
windows stay as the rule built them, fullest first: only the emptiest are cut
up, to fill the others' gaps, and the one left over is laid out in windows of
falling powers of two, which need no padding.

What is open is bounded by what a run holds: after ``RUN_IDS`` ids a run ends
as if its documents had, and the next begins with no open window.

A task that is lost is run again as a whole, so each id keeps exactly one
piece.  ``sequence_id`` is the task's number shifted by 33 bits plus a running
number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.tokens import VOCABULARY, encoder

WINDOW = 2048
#: Ids of a run: 32 MiB x 4 bytes in memory at most.
RUN_IDS = 1 << 25
END_ID = 1

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, padded_length long, ids binary"

#: doc_id, start, ids, doc_tokens
Piece = tuple[int | None, int, np.ndarray, int]


class Packer:
    """Places pieces into windows; ``closed`` collects the finished ones."""

    def __init__(self, size: int = WINDOW):
        self.size = size
        self.count = np.zeros(size + 1, dtype=np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(size + 1)]
        self.closed: list[list[Piece]] = []
        #: Ids given to a window by the rule, and those that :meth:`finish` moved to another one.
        self.placed = self.moved = 0

    def level_for(self, s: int) -> int:
        """The level whose choice makes the sum of squares smallest; 0 opens a window.  Ties go to the fullest level."""
        size, n = self.size, self.count
        levels = np.nonzero(n[1 : size - s + 1])[0] + 1
        least = 2 * n[s] + 1
        if len(levels):
            to = levels + s
            cost = np.where(to < size, 2 * (n[np.minimum(to, size - 1)] - n[levels]) + 2, 1 - 2 * n[levels])
            at = len(cost) - 1 - int(np.argmin(cost[::-1]))
            if cost[at] <= least:
                return int(levels[at])
        return 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        self.placed += total
        while total - at >= self.size:
            self.closed.append([(doc_id, at, ids[at : at + self.size], total)])
            at += self.size
        s = total - at
        if not s:
            return
        level = self.level_for(s)
        window: list[Piece] = []
        if level:
            self.count[level] -= 1
            window = self.open[level].pop()
        window.append((doc_id, at, ids[at:], total))
        if level + s == self.size:
            self.closed.append(window)
        else:
            self.count[level + s] += 1
            self.open[level + s].append(window)

    def finish(self) -> None:
        """End a run: the emptiest windows fill the gaps of the others; the last one goes in powers of two."""
        windows = [[level, w] for level in range(self.size - 1, 0, -1) for w in self.open[level]]
        first, last = 0, len(windows) - 1
        while first < last:
            room, (_, pieces) = self.size - windows[first][0], windows[last]
            doc_id, start, ids, total = pieces.pop()
            n = min(room, len(ids))
            windows[first][1].append((doc_id, start, ids[:n], total))
            windows[first][0] += n
            windows[last][0] -= n
            self.moved += n
            if n < len(ids):
                pieces.append((doc_id, start + n, ids[n:], total))
            if windows[first][0] == self.size:
                self.closed.append(windows[first][1])
                first += 1
            if not windows[last][0]:
                last -= 1
        if first == last:
            left, room, window = windows[first][0], 0, []
            for doc_id, start, ids, total in windows[first][1]:
                at = 0
                while at < len(ids):
                    if not room:
                        room, window = 1 << (left.bit_length() - 1), []
                        self.closed.append(window)
                    n = min(len(ids) - at, room)
                    window.append((doc_id, start + at, ids[at : at + n], total))
                    at, room, left = at + n, room - n, left - n
        self.open = [[] for _ in range(self.size + 1)]
        self.count[:] = 0


def _rows(windows: list[list[Piece]], first: int, size: int) -> pa.RecordBatch:
    cols: list[list] = [[] for _ in range(8)]
    for i, window in enumerate(windows):
        offset, fill = 0, sum(len(p[2]) for p in window)
        padded = fill if fill & (fill - 1) == 0 else size
        for doc_id, start, ids, total in window:
            for c, v in zip(cols, (doc_id, start, len(ids), total, first + i, offset, padded, ids.tobytes()), strict=True):
                c.append(v)
            offset += len(ids)
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "padded_length", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(cols[7], pa.binary())], names=names)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW, vocabulary: str = VOCABULARY, end_id: int = END_ID, run_ids: int = RUN_IDS) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, doc_tokens, sequence_id, offset, padded_length, ids``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers.
    The id column is cast to long, so ids must be integers.  Defined cases: a null or empty text is the end id alone; null and repeated
    ids are packed like any other and stay apart by their pieces; an empty
    table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, packer = encoder(vocabulary), Packer(size)
        end = np.array([end_id], dtype="<u4")
        at = TaskContext.get().partitionId() << 33

        def closed(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal at
            if len(packer.closed) >= least:
                for i in range(0, len(packer.closed), 512):
                    part = packer.closed[i : i + 512]
                    yield _rows(part, at, size)
                    at += len(part)
                packer.closed = []

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                packer.add(doc_id, np.concatenate([ids(text.as_py()), end]))
                if packer.placed >= run_ids:
                    packer.finish()
                    packer.placed = 0
                yield from closed(512)
        packer.finish()
        yield from closed(1)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)
