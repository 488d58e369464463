"""Sum-of-squares online packing of token ids into windows.

Each Spark task packs the documents of its partition in one pass. A document's ids (with
its end id) are cut into whole windows and a rest; the rest goes to the fill level h
(0: a new window) that minimises the sum of squares of the numbers of open windows per
fill level, as kept in the level array. Equal costs go to the fullest level.

Open windows are bounded: beyond ``max_open``, and at the end of the task, the fullest
windows are filled up with ids cut from the emptiest, until as many are closed as needed.
So the places found for documents stay, and only the emptiest windows are taken apart. The
last, partly filled window of a task is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quiver.llm.common import bounded_batches, column, id_text, text_steps
from quiver.llm.tokens import Encoder, default_vocabulary

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long")


class SumOfSquares:
    """Packs (doc, start, ids, doc_tokens) pieces into windows of ``size`` ids."""

    def __init__(self, size: int, first_sequence: int, max_open: int):
        self.size, self.next, self.max_open = size, first_sequence, max_open
        self.levels = np.zeros(size + 1, np.int64)  # open windows per fill level
        self.open: dict[int, list[list]] = {}       # level -> windows; a window is a list of pieces
        self.n_open = 0
        self.recut = 0  # ids of windows that were taken apart
        self.done: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        n, size = len(ids), self.size
        whole = n - n % size
        for start in range(0, whole, size):
            self._close([(doc, start, ids[start: start + size], n)])
        if n > whole:
            self._place((doc, whole, ids[whole:].copy(), n))
            if self.n_open > self.max_open:
                self._fill(self.max_open // 2)

    def _place(self, piece) -> None:
        s, levels, size = len(piece[2]), self.levels, self.size
        reach = size - s
        cost = 1 - 2 * levels[: reach + 1]
        cost[levels[: reach + 1] == 0] = np.iinfo(np.int64).max // 2
        cost[0] = 0
        after = 2 * levels[s: size + 1] + 1
        after[-1] = 0  # a full window is closed, no longer counted
        cost = cost + after
        h = reach - int(np.argmin(cost[::-1]))
        if h:
            window = self.open[h].pop()
            levels[h] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append(piece)
        if h + s == size:
            self._close(window)
        else:
            self._keep(window, h + s)

    def _keep(self, window, level) -> None:
        self.open.setdefault(level, []).append(window)
        self.levels[level] += 1
        self.n_open += 1

    def _close(self, window) -> None:
        offset = 0
        for doc, start, ids, total in window:
            self.done.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4", copy=False).tobytes()), total,
                              self.next, offset))
            offset += len(ids)
        self.next += 1

    def _fill(self, keep: int) -> None:
        """Close windows, the fullest first, with ids cut from the emptiest, until at most
        ``keep`` windows are open."""
        levels = sorted(self.open)
        windows = [(level, w) for level in levels for w in self.open[level]]  # emptiest first
        source, n_source = [], 0  # pieces of the windows taken apart, and their ids
        while len(windows) + (n_source > 0) > max(keep, 1):
            level, window = windows.pop() if windows else (0, [])
            while level < self.size:
                if not source:
                    if not windows:
                        break
                    n_source, source = windows.pop(0)
                    self.recut += n_source
                doc, start, ids, total = source.pop()
                part = ids[: self.size - level]
                window.append((doc, start, part, total))
                level, n_source = level + len(part), n_source - len(part)
                if len(part) < len(ids):
                    source.append((doc, start + len(part), ids[len(part):], total))
            if level < self.size:
                windows.append((level, window))
                break
            self._close(window)
        if source:
            windows.append((n_source, source))
        self.open, self.n_open = {}, 0
        self.levels[:] = 0
        for level, window in windows:
            self._keep(window, level)

    def _close_in_powers(self, pieces, total: int) -> None:
        queue = list(pieces)
        for bit in range(total.bit_length() - 1, -1, -1):
            room, window = total & (1 << bit), []
            while room:
                doc, start, ids, n = queue.pop(0)
                if len(ids) > room:
                    queue.insert(0, (doc, start + room, ids[room:], n))
                    ids = ids[:room]
                window.append((doc, start, ids, n))
                room -= len(ids)
            if window:
                self._close(window)

    def finish(self) -> None:
        """Close every window; at most one is partly filled, and cut at powers of two."""
        self._fill(1)
        for level in list(self.open):
            for window in self.open.pop(level):
                self._close_in_powers(window, level)
        self.levels[:], self.n_open = 0, 0

    def rows(self) -> list[tuple]:
        rows, self.done = self.done, []
        return rows


def pack(docs: DataFrame, size: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
         vocabulary: str | None = None, max_open: int = 4096) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is one piece holding the end id alone. Rows that repeat an id are
    packed like any others; an id may be null. An empty table gives no rows. Other columns
    are ignored. Sequence ids are unique, not gapless: task number times 2**33 plus a
    counter. Packing follows the order of a partition's rows, so a retried task repeats it
    when its input does (a scan or a pinned table).
    """
    path = vocabulary or default_vocabulary()
    bounded_batches(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        encoder = Encoder.of(path)
        packer = SumOfSquares(size, TaskContext.get().partitionId() << 33, max_open)
        end = np.array([end_id], np.uint32)
        for step in text_steps(batches):
            ids, offsets = encoder.encode(column(step, "text"))
            for i, doc in enumerate(column(step, "doc_id").to_pylist()):
                packer.add(doc, np.concatenate([ids[offsets[i]: offsets[i + 1]], end]))
            yield _batch(packer.rows())
        packer.finish()
        yield _batch(packer.rows())

    return id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


_ARROW = pa.schema([(f.split()[0], pa.int64()) for f in SCHEMA.split(", ")])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=_ARROW)
