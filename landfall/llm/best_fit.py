"""Bounded-space online best-fit: whole documents into sequences of at most so many tokens.

Each task keeps a fixed number of open sequences. A bitset holds a bit for every amount of
free space that some open sequence has, so the tightest place for a document is the lowest
set bit at or above its length. A document that fits nowhere opens a sequence; if all are
open already, the fullest closes first, as it has least to lose. Documents are taken as they
come, but for a short lookahead within which the longest go first; that leaves a tenth of the
padding. A task holds the ids of its lookahead and no more, and nothing is shuffled.

Only documents longer than a sequence are cut, into full sequences and a rest.

Defined results: a NULL or empty text is the terminator alone. Repeated rows are packed one
by one. A NULL id stays NULL. Extra columns are ignored, whatever their names. An empty
table gives no rows. Of several places that are equally tight, the one opened last is taken.
The same partition always gives the same sequences; `sequence_id` holds the partition's
number, so a repeated task repeats its ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import text_of
from landfall.llm.word_tokens import word_encoder


class OpenBins:
    """A fixed number of open bins, found by their free space."""

    def __init__(self, capacity: int, limit: int, first: int = 0):
        self.capacity, self.limit = capacity, limit
        self._spaces = 0  # bit f is set if some open bin has f free
        self._bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self._open = 0
        self._next = first

    def _take(self, free: int) -> int:
        bins = self._bins[free]
        chosen = bins.pop()
        if not bins:
            self._spaces &= ~(1 << free)
        self._open -= 1
        return chosen

    def place(self, size: int) -> tuple[int, int]:
        """The bin for an item and the place in it."""
        fitting = self._spaces >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            chosen = self._take(free)
        else:
            if self._open == self.limit:
                self._take((self._spaces & -self._spaces).bit_length() - 1)
            free, chosen = self.capacity, self._next
            self._next += 1
        if rest := free - size:
            self._bins[rest].append(chosen)
            self._spaces |= 1 << rest
            self._open += 1
        return chosen, self.capacity - free


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.binary()),
    ]
)
_DDL = (
    "doc_id long, piece int, start long, length long, sequence_id long, offset long, ids binary"
)


def _cut(parts: Iterator[np.ndarray], terminator: int, size: int) -> Iterator[np.ndarray]:
    """The ids of one document in runs of `size`; the last run may be shorter."""
    held = np.zeros(0, np.uint32)
    for part in parts:
        held = np.concatenate([held, part])
        whole = len(held) - len(held) % size
        for at in range(0, whole, size):
            yield held[at : at + size]
        held = held[whole:]
    yield np.append(held, np.uint32(terminator))


def pack_best_fit(
    docs: DataFrame,
    tokens: int = 2048,
    open_sequences: int = 1024,
    lookahead: int = 1024,
    terminator: int = 0,
    tokenizer: str | None = None,
) -> DataFrame:
    """Pieces of all documents (doc_id, text), each with its sequence and its place there.

    `ids` holds a piece's ids as little-endian 32-bit numbers; `terminator` ends each
    document. A task keeps at most `open_sequences` sequences open, and orders `lookahead`
    pieces at a time before it places them; 1 takes them strictly as they come. `tokenizer`
    is the path of a tokenizer file, by default that of the public word vocabulary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        bins = OpenBins(tokens, open_sequences, TaskContext.get().partitionId() << 40)
        waiting: list[tuple] = []

        def placed() -> pa.RecordBatch:
            waiting.sort(key=lambda row: -len(row[-1]))
            rows = []
            for doc, piece, start, ids in waiting:
                sequence, offset = bins.place(len(ids))
                data = ids.astype("<u4", copy=False).tobytes()
                rows.append((doc, piece, start, len(ids), sequence, offset, data))
            waiting.clear()
            columns = zip(zip(*rows, strict=True), _OUT, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=_OUT)

        for batch in batches:
            texts = (text.as_py() for text in batch.column("text"))
            docs_here = batch.column("doc_id").to_pylist()
            for doc, parts in zip(docs_here, encoder.encode(texts), strict=True):
                start = 0
                for piece, ids in enumerate(_cut(parts, terminator, tokens)):
                    waiting.append((doc, piece, start, ids))
                    start += len(ids)
                    if len(waiting) >= lookahead:
                        yield placed()
        if waiting:
            yield placed()

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, _DDL)

