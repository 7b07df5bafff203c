"""Sum-of-squares online packing of tokenised documents into sequences.

Every task packs the stream of its own documents. An array holds, for each fill level, how many open windows stand at
it; a document goes where the sum of the squared counts grows least. Levels that many windows share are left first, so
windows keep reaching the full length instead of piling up at levels nothing fits on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cohortloom.llm.text import bounded_batches
from cohortloom.llm.tokens import tokenizer

CAPACITY = 4096
OPEN_WINDOWS = 1024
ADDED = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")


@dataclass(frozen=True)
class Piece:
    """``ids`` of a document from ``start`` on; ``row`` are the carried values of the document."""

    row: tuple
    start: int
    ids: bytes
    doc_tokens: int

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.row, self.start, self.ids[: 4 * at], self.doc_tokens),
            Piece(self.row, self.start + at, self.ids[4 * at :], self.doc_tokens),
        )


@dataclass
class SumOfSquares:
    """Open windows by fill level, and the rule that picks the level for the next document."""

    capacity: int
    counts: np.ndarray = field(init=False)
    windows: list[list[list[Piece]]] = field(init=False)
    n_open: int = 0

    def __post_init__(self):
        self.counts = np.zeros(self.capacity + 1, np.int64)
        self.windows = [[] for _ in range(self.capacity + 1)]

    def level(self, size: int) -> int:
        """The level to leave, 0 for a new window. Full windows do not count; ties go to the fullest window."""
        rest = self.capacity - size
        gain = self.counts[size:].copy()
        gain[-1] = 0
        # leaving level h and reaching h + size changes the sum by 2 (N[h + size] - N[h]) + 2, one less at the ends
        change = 2 * (gain - self.counts[: rest + 1]) + 2
        change[-1] -= 1
        change[0] = 2 * gain[0] + 1 if rest else 0
        change[1:][self.counts[1 : rest + 1] == 0] = np.iinfo(np.int64).max
        return rest - int(np.argmin(change[::-1]))

    def place(self, piece: Piece) -> list[Piece] | None:
        """Put a piece into a window; the window if that fills it."""
        at = self.level(piece.length)
        if at:
            window = self.windows[at].pop()
            self.counts[at] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append(piece)
        reached = at + piece.length
        if reached == self.capacity:
            return window
        self.windows[reached].append(window)
        self.counts[reached] += 1
        self.n_open += 1
        return None

    def drain(self, whole: bool) -> Iterator[list[Piece]]:
        """Lay the open windows' documents end to end, fullest first, and cut them into full windows.

        With ``whole`` the rest is cut into sequences whose lengths are powers of two, so nothing is padded;
        otherwise the rest stays open.
        """
        left = [p for level in reversed(self.windows) for window in level for p in window]
        self.__post_init__()
        self.n_open = 0
        window, room = [], self.capacity
        left.reverse()
        total = sum(p.length for p in left)
        while left:
            if not window:
                if total < self.capacity and not whole:
                    break
                room = self.capacity if total >= self.capacity else 1 << (total.bit_length() - 1)
            piece = left.pop()
            if piece.length > room:
                piece, rest = piece.cut(room)
                left.append(rest)
            window.append(piece)
            room -= piece.length
            total -= piece.length
            if not room:
                yield window
                window = []
        for piece in reversed(left):
            self.place(piece)


def pack_stream(pieces: Iterator[Piece], capacity: int, open_windows: int) -> Iterator[list[Piece]]:
    """Sequences of the pieces, each once all of it is known; at most ``open_windows`` + 1 windows are held."""
    levels = SumOfSquares(capacity)
    for piece in pieces:
        while piece.length >= capacity:
            full, piece = piece.cut(capacity)
            yield [full]
        if piece.length:
            if filled := levels.place(piece):
                yield filled
            if levels.n_open > open_windows:
                yield from levels.drain(whole=False)
    yield from levels.drain(whole=True)


def pack_documents(
    df: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    text_col: str = "text",
    carry: Sequence[str] = ("doc_id",),
    capacity: int = CAPACITY,
    open_windows: int = OPEN_WINDOWS,
) -> DataFrame:
    """One row per piece of a document: the carried columns, ``start``, ``length``, ``ids`` (little-endian unsigned
    32-bit), ``doc_tokens``, ``sequence_id`` and ``offset``.

    A document's ids are those of its text and then ``end_id``. Documents of more than ``capacity`` ids fill windows of
    their own and only their rest is placed. Windows still open at the end of a task, or when more than
    ``open_windows`` are open, are drained: their documents are laid end to end and cut at the capacity; the last few
    ids of a task form sequences whose lengths are powers of two. No sequence is padded.

    Nothing is shuffled and a task holds at most ``open_windows`` windows. Sequence ids are unique over all tasks. A
    null or empty text is a document of ``end_id`` alone; repeated rows are packed each; an empty table gives no rows.
    Columns of ``df`` beyond the carried ones do not matter; carried columns named like an added one are refused.
    """
    if clash := {c.lower() for c in carry} & set(ADDED):
        raise ValueError(f"carried columns clash with the result: {sorted(clash)}")
    bounded_batches(df.sparkSession)
    base = df.select(*dict.fromkeys([*[f"`{c}`" for c in carry], f"`{text_col}`"]))
    names, carried = base.columns, list(carry)
    kinds = base.select(*[f"`{c}`" for c in carried]).schema.fields
    end = end_id.to_bytes(4, "little")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(tokenizer_path).ids
        first = TaskContext.get().partitionId() << 33
        schema: list[pa.DataType] = []

        def pieces() -> Iterator[Piece]:
            for batch in batches:
                schema[:] = [batch.schema.field(names.index(c)).type for c in carried]
                rows = zip(*[batch.column(names.index(c)).to_pylist() for c in carried])
                for row, text in zip(rows, batch.column(names.index(text_col)).to_pylist()):
                    ids = encode(text or "") + end
                    yield Piece(row, 0, ids, len(ids) // 4)

        out: list[tuple[Piece, int, int]] = []
        size = 0
        for number, window in enumerate(pack_stream(pieces(), capacity, open_windows)):
            offset = 0
            for piece in window:
                out.append((piece, first + number, offset))
                offset += piece.length
            size += 4 * offset
            if size >= 4 << 20:
                yield _rows(out, carried, schema)
                out, size = [], 0
        if out:
            yield _rows(out, carried, schema)

    added = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return base.mapInArrow(packed, T.StructType([*kinds, *T._parse_datatype_string(added).fields]))


def _rows(out: list[tuple[Piece, int, int]], carried: list[str], schema: list[pa.DataType]) -> pa.RecordBatch:
    arrays = [pa.array([p.row[i] for p, _, _ in out], kind) for i, kind in enumerate(schema)]
    for values in (
        [p.start for p, _, _ in out],
        [p.length for p, _, _ in out],
        [p.ids for p, _, _ in out],
        [p.doc_tokens for p, _, _ in out],
        [s for _, s, _ in out],
        [o for _, _, o in out],
    ):
        arrays.append(pa.array(values, pa.binary() if isinstance(values[0], bytes) else pa.int64()))
    return pa.RecordBatch.from_arrays(arrays, [*carried, *ADDED])
