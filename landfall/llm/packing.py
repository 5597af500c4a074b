"""Vector bin packing: whole documents into sequences of at most so many tokens.

Each task packs what its partition holds, so nothing is shuffled and memory is bounded by
the open items. A document is cut into full sequences and a rest; the rests are items with
three sizes: tokens, one segment, and tokens that bear loss. A sequence is filled greedily
by the dot-product heuristic: of all items that still fit in every dimension, the one whose
size vector has the largest dot product with the free capacity goes in. When none fits, the
item with the most tokens is cut to fill the gap. A sequence that a limit other than tokens
closes, and the last one of a task, is cut at powers of two, which need no padding.

Defined results: a NULL or empty text is the terminator alone. Repeated rows are packed one
by one. A NULL id stays NULL. Extra columns are ignored, whatever their names. An empty
table gives no rows. The same partition always gives the same sequences; `sequence_id`
holds the partition's number, so a repeated task repeats its ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import text_of
from landfall.llm.tokens import encoder


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 512
    loss_tokens: int = 2048


@dataclass
class _Item:
    """A run of one document's ids: `ids` starts at `start`; loss begins at `loss_from`."""

    doc: object
    ids: np.ndarray
    start: int
    doc_tokens: int
    loss_from: int

    def loss(self, length: int | None = None) -> int:
        """Ids that bear loss: beyond the prompt, and not the first of the piece."""
        end = self.start + (len(self.ids) if length is None else length)
        return max(0, end - max(self.start + 1, self.loss_from))

    def split(self, at: int) -> tuple[_Item, _Item]:
        head = _Item(self.doc, self.ids[:at], self.start, self.doc_tokens, self.loss_from)
        tail = _Item(self.doc, self.ids[at:], self.start + at, self.doc_tokens, self.loss_from)
        return head, tail


class _Packer:
    """Open items of one task; `done` collects (sequence, items) that are closed."""

    def __init__(self, limits: Limits, keep: int):
        self.limits, self.keep = limits, keep
        self.capacity = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.items: list[_Item] = []
        self.done: list[list[_Item]] = []

    def add(self, item: _Item) -> None:
        width = self.limits.tokens
        while len(item.ids) >= width and item.loss(width) <= self.limits.loss_tokens:
            if len(item.ids) == width:
                self.done.append([item])
                return
            head, item = item.split(width)
            self.done.append([head])
        while len(item.ids) > width or item.loss() > self.limits.loss_tokens:
            head, item = item.split(self._largest_cut(item, self.capacity))
            self.items.append(head)
        self.items.append(item)
        if len(self.items) >= 2 * self.keep:
            self.fill(self.keep)

    def _largest_cut(self, item: _Item, free: np.ndarray) -> int:
        """Most leading ids of an item that fit: loss grows by at most one per id."""
        most = int(min(free[0], len(item.ids)))
        return most - max(0, item.loss(most) - int(free[2]))

    def fill(self, keep: int) -> None:
        """Close sequences until at most `keep` items are open."""
        items = self.items
        sizes = np.array([[len(i.ids), 1, i.loss()] for i in items], float).reshape(-1, 3)
        alive = np.ones(len(items), bool)
        left = len(items)
        while left > keep:
            free, chosen = self.capacity.copy(), []
            while left:
                fits = alive & (sizes <= free).all(axis=1)
                if not fits.any():
                    break
                weight = free / self.capacity**2
                best = int(np.argmax(np.where(fits, sizes @ weight, -1.0)))
                chosen.append(items[best])
                free -= sizes[best]
                alive[best] = False
                left -= 1
            if left and free[0] > 0 and free[1] > 0:
                best = int(np.argmax(np.where(alive, sizes[:, 0], -1.0)))
                if (cut := self._largest_cut(items[best], free)) > 0:
                    head, items[best] = items[best].split(cut)
                    chosen.append(head)
                    free -= np.array([cut, 1, head.loss()])
                    sizes[best] = [len(items[best].ids), 1, items[best].loss()]
            self._close(chosen)
        self.items = [item for item, stays in zip(items, alive, strict=True) if stays]

    def _close(self, chosen: list[_Item]) -> None:
        """One full sequence, or as many as its length has binary digits set."""
        total = sum(len(item.ids) for item in chosen)
        if total == self.limits.tokens:
            self.done.append(chosen)
            return
        queue = chosen[::-1]
        while total:
            room = 1 << (total.bit_length() - 1)
            total -= room
            sequence = []
            while room:
                item = queue.pop()
                if len(item.ids) > room:
                    item, rest = item.split(room)
                    queue.append(rest)
                sequence.append(item)
                room -= len(item.ids)
            self.done.append(sequence)


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("segment", pa.int32()),
        ("offset", pa.int64()),
        ("loss_tokens", pa.int64()),
        ("ids", pa.binary()),
    ]
)
_DDL = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long,"
    " segment int, offset long, loss_tokens long, ids binary"
)


def _rows(sequences: list[list[_Item]], first: int) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in _OUT]
    for number, sequence in enumerate(sequences, first):
        offset = 0
        for segment, item in enumerate(sequence):
            values = (
                item.doc, item.start, len(item.ids), item.doc_tokens, number, segment, offset,
                item.loss(), item.ids.astype("<u4", copy=False).tobytes(),
            )
            for column, value in zip(columns, values, strict=True):
                column.append(value)
            offset += len(item.ids)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _OUT, strict=True)], schema=_OUT
    )


def pack(
    docs: DataFrame,
    limits: Limits | None = None,
    terminator: int = 1,
    prompt_tokens: str | None = None,
    open_items: int = 512,
) -> DataFrame:
    """Pieces of all documents (doc_id, text), each with its place in a sequence.

    `ids` holds a piece's ids as little-endian 32-bit numbers; `terminator` ends each
    document. `prompt_tokens` names a column with the number of leading ids that bear no
    loss. `open_items` bounds the items a task keeps open, at most twice as many rests.
    """
    limits = limits or Limits()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        packer = _Packer(limits, open_items)
        number = TaskContext.get().partitionId() << 40
        end = np.array([terminator], np.uint32)
        for batch in batches:
            for doc, text, prompt in zip(*batch.columns, strict=True):
                ids = np.concatenate([encode(text.as_py()), end])
                packer.add(_Item(doc.as_py(), ids, 0, len(ids), prompt.as_py()))
                if len(packer.done) >= 256:
                    yield _rows(packer.done, number)
                    number, packer.done = number + len(packer.done), []
        packer.fill(0)
        if packer.done:
            yield _rows(packer.done, number)

    prompt = F.coalesce(F.col(prompt_tokens), F.lit(0)) if prompt_tokens else F.lit(0)
    return docs.select(
        F.col("doc_id").cast("long"), text_of(), prompt.cast("long").alias("prompt")
    ).mapInArrow(run, _DDL)
