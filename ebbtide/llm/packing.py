"""Packing of token sequences into windows by minimum bin slack."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ebbtide.llm.common import narrow
from ebbtide.llm.pretokens import WordIds, of_worker

BUFFER_DOCS = 8192
BUFFER_TOKENS = 1 << 22
#: Tokens handed on at a time.
READY_TOKENS = 1 << 18


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length of the multiset ``counts`` come closest to ``room`` without exceeding it.

    Subset sums as the bits of one integer: a length that is there c times is added in portions of
    1, 2, 4, ... up to c, each one shift; longest first, until ``room`` itself is reached. The sums
    before each portion are kept, and going back through them tells which portions make up the best.
    """
    mask, reached, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        left, portion = min(counts[length], room // length), 1
        while left > 0:
            take = min(portion, left)
            steps.append((length, take, reached))
            reached |= (reached << (length * take)) & mask
            left -= take
            portion *= 2
        if reached >> room & 1:
            break
    best, used = reached.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            best -= length * take
            used[length] = used.get(length, 0) + take
    return used


def plan(lengths: list[int], capacity: int) -> tuple[list[list[int]], list[int]]:
    """Windows of items (by index) that fill ``capacity`` exactly, and the items of no such window.

    Each window takes the longest length left and the multiset of the others that leaves the least
    slack; a pattern of lengths is used as often as the counts allow before the next one is sought.
    """
    held: dict[int, list[int]] = {}
    for i, n in enumerate(lengths):
        held.setdefault(n, []).append(i)
    counts = Counter(lengths)
    windows, rest = [], []
    while counts:
        longest = max(counts)
        others = dict(counts)
        others[longest] -= 1
        used = Counter(fill({n: c for n, c in others.items() if c}, capacity - longest))
        used[longest] += 1
        times = min(counts[n] // k for n, k in used.items())
        exact = sum(n * k for n, k in used.items()) == capacity
        for _ in range(times):
            items = [held[n].pop() for n, k in used.items() for _ in range(k)]
            if exact:
                windows.append(items)
            else:
                rest += items
        for n, k in used.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
    return windows, rest


class _Packer:
    """Packs what is added; holds at most a buffer of documents, and the pieces not yet taken."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next = capacity, first
        self.items: list[tuple] = []  # document, start in it, ids, its tokens
        self.held = self.ready = 0
        self.out: list[tuple] = []

    def _emit(self, pieces) -> None:
        """A sequence of (document, start, ids, tokens)."""
        offset = 0
        for doc, start, ids, tokens in pieces:
            self.out.append((doc, start, len(ids), tokens, self.next, offset, ids.astype("<u4").tobytes()))
            offset += len(ids)
        self.ready += offset
        self.next += 1

    def add(self, doc, ids: np.ndarray) -> None:
        whole = len(ids) - len(ids) % self.capacity
        for start in range(0, whole, self.capacity):
            self._emit([(doc, start, ids[start : start + self.capacity], len(ids))])
        if whole < len(ids):
            self.items.append((doc, whole, ids[whole:], len(ids)))
            self.held += len(ids) - whole
            if len(self.items) >= BUFFER_DOCS or self.held >= BUFFER_TOKENS:
                self.pack()

    def pack(self) -> None:
        """Emits all full windows; at most one window's tokens stay."""
        windows, rest = plan([len(x[2]) for x in self.items], self.capacity)
        for window in windows:
            self._emit([self.items[i] for i in window])
        self.items = self._chain([self.items[i] for i in rest], lambda left: self.capacity)
        self.held = sum(len(x[2]) for x in self.items)

    def close(self) -> None:
        """Emits the rest; the last tokens go into sequences of powers of two, which need no padding."""
        self.pack()
        self._chain(self.items, lambda left: 1 << (left.bit_length() - 1))
        self.items, self.held = [], 0

    def _chain(self, items: list[tuple], size) -> list[tuple]:
        """Emits ``items`` one after another, cut to sequences of ``size(tokens left)``; returns what is too short."""
        left, at = sum(len(x[2]) for x in items), 0
        while left and size(left) <= left:
            room, pieces = size(left), []
            left -= room
            while room:
                doc, start, ids, tokens = items[at]
                pieces.append((doc, start, ids[:room], tokens))
                room -= len(pieces[-1][2])
                if len(pieces[-1][2]) == len(ids):
                    at += 1
                else:
                    cut = len(pieces[-1][2])
                    items[at] = (doc, start + cut, ids[cut:], tokens)
            self._emit(pieces)
        return items[at:]


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    end_id: int = 2,
) -> DataFrame:
    """``doc_id, start, length, doc_tokens, sequence_id, offset, ids``: one row per piece of a document.

    A document's ids are those of the tokenizer and ``end_id``. Whole windows of a long document are
    sequences of their own; what remains of each document goes into a buffer of at most 8,192
    documents, packed by minimum bin slack. Items of windows that can't be filled exactly are put
    end to end and cut at the capacity, and the last tokens of a partition are cut into sequences
    of powers of two. So every sequence is full or a power of two long and needs no padding.

    Each partition packs its own rows in one pass: no shuffle, bounded memory, and ``sequence_id``
    (partition in the upper bits) stays unique however often a task is repeated. A null or empty
    text is ``end_id`` alone; null ids stay null; repeated rows are packed each; an empty table
    gives no rows. ``ids`` holds little-endian unsigned 32-bit numbers.
    """

    def run(batches):
        words = of_worker(WordIds, tokenizer_file)
        end = np.array([end_id], "<u2")
        packer = _Packer(capacity, TaskContext.get().partitionId() << 40)

        def taken():
            pieces, packer.out, packer.ready = packer.out, [], 0
            while pieces:
                n = tokens = 0
                while n < len(pieces) and tokens < READY_TOKENS:
                    tokens += pieces[n][2]
                    n += 1
                columns, pieces = list(zip(*pieces[:n])), pieces[n:]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            kind = batch.schema.field(0).type
            types = [kind, *[pa.int64()] * 5, pa.binary()]
            names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc, np.concatenate([words.ids(text.as_py() or ""), end]))
                if packer.ready >= READY_TOKENS:
                    yield from taken()
        packer.close()
        yield from taken()

    kind = docs.schema[id_col].dataType.simpleString()
    return narrow(docs, doc_id=id_col, text=text_col).mapInArrow(
        run, f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    )
