"""Cost-balanced packing of documents into sequences (operator 13).

A piece of n tokens costs ``linear * n + n * n``: the work of the weights and that of
attention within the piece. Documents, longest first, go to the sequence of lowest cost
that has room for them; those that no sequence can take whole are cut and fill what
room is left, lowest cost first again.

A task packs its own partition, window by window, while it reads it: nothing is
shuffled, memory is that of a window, and a task that is run again gives the same
sequences as long as its input is the same. What is over after the full sequences of a
window waits for the next one; after the last, it goes into sequences whose lengths are
the powers of two that it consists of. Sequences of a power of two need no padding, and
4096 is one, so there is none.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.wordbpe import packer_of

#: Twelve times a model width of 1024: the linear cost of a token, in units of one attended pair.
LINEAR = 12 * 1024
#: Tokens that are packed together in a task, about.
WINDOW_TOKENS = 4_000_000
#: Bits of a sequence's number within its partition.
SEQUENCE_BITS = 40

Piece = tuple[int, int, int, int, int]  # document, start, length, sequence, offset


def cost(length: int, linear: int = LINEAR) -> int:
    """What a piece of so many tokens costs, in whole numbers."""
    return linear * length + length * length


def balanced(lengths: list[int], capacities: list[int], linear: int = LINEAR) -> tuple[list[Piece], list[tuple[int, int]]]:
    """Pieces of documents of these ``lengths`` in sequences of these ``capacities``, and the rest (document, start).

    No sequence has room left if there is a rest. Ties: the document, or sequence, of the
    smaller number first.
    """
    placed: list[Piece] = []
    rest: list[tuple[int, int]] = []
    room, spent = list(capacities), [0] * len(capacities)
    open_ = [(0, s) for s in range(len(room))]
    # Sequences without room for the present length, by their room.
    waiting: list[tuple[int, int]] = []

    def put(doc: int, start: int, length: int, s: int) -> None:
        placed.append((doc, start, length, s, capacities[s] - room[s]))
        room[s] -= length
        spent[s] += cost(length, linear)

    for doc in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        length = lengths[doc]
        while waiting and -waiting[0][0] >= length:
            s = heapq.heappop(waiting)[1]
            heapq.heappush(open_, (spent[s], s))
        while open_ and room[open_[0][1]] < length:
            s = heapq.heappop(open_)[1]
            if room[s]:
                heapq.heappush(waiting, (-room[s], s))
        if open_:
            s = heapq.heappop(open_)[1]
            put(doc, 0, length, s)
            if room[s]:
                heapq.heappush(open_, (spent[s], s))
        else:
            rest.append((doc, 0))
    open_ = sorted((spent[s], s) for s in range(len(room)) if room[s])
    over: list[tuple[int, int]] = []
    for doc, start in rest:
        while start < lengths[doc] and open_:
            s = heapq.heappop(open_)[1]
            length = min(room[s], lengths[doc] - start)
            put(doc, start, length, s)
            start += length
            if room[s]:
                heapq.heappush(open_, (spent[s], s))
        if start < lengths[doc]:
            over.append((doc, start))
    return placed, over


def powers(n: int) -> list[int]:
    """The powers of two that n consists of, largest first."""
    return [1 << bit for bit in range(n.bit_length() - 1, -1, -1) if n >> bit & 1]


def pack_balanced(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, linear: int = LINEAR, window: int = WINDOW_TOKENS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece.

    ``capacity`` is a power of two. Each document ends with ``end_id``; a null text counts
    as empty, an empty one is the end id alone. A document of more than ``capacity``
    tokens is cut there first. Repeated rows, null ids and ids that are there twice are
    documents of their own; equal lengths go in the order of the rows. Other columns of
    ``docs`` don't matter; no rows give no rows. Every token is in exactly one piece,
    and sequences are filled without gaps; besides those of ``capacity`` a partition has
    at most one of each smaller power of two.
    """
    if capacity < 1 or capacity & capacity - 1:
        raise ValueError("capacity must be a power of two")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = packer_of(tokenizer), end_id.to_bytes(4, "little")
        sequences = TaskContext.get().partitionId() << SEQUENCE_BITS
        held: list[tuple[int | None, int, int, bytes]] = []  # document, start and tokens there, packed ids
        tokens = 0

        def rows_of(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        def window_of(last: bool) -> list[tuple]:
            nonlocal held, tokens, sequences
            full, more = divmod(tokens, capacity)
            capacities = [capacity] * full + (powers(more) if last else [])
            placed, over = balanced([len(ids) // 4 for *_, ids in held], capacities, linear)
            out = []
            for at, start, length, s, offset in placed:
                doc, before, whole, ids = held[at]
                out.append((doc, before + start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), whole, sequences + s, offset))
            sequences += len(capacities)
            held = [(held[at][0], held[at][1] + start, held[at][2], held[at][3][4 * start :]) for at, start in over]
            tokens = sum(len(ids) // 4 for *_, ids in held)
            return out

        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = bpe.pack(text or "") + end
                whole, start = len(ids) // 4, 0
                while whole - start >= capacity:
                    out.append((doc, start, capacity, zlib.crc32(ids[4 * start : 4 * (start + capacity)]), whole, sequences, 0))
                    sequences += 1
                    start += capacity
                if start < whole:
                    held.append((doc, start, whole, ids[4 * start :]))
                    tokens += whole - start
                if tokens >= window:
                    out += window_of(last=False)
            yield rows_of(out)
        yield rows_of(window_of(last=True))

    schema = ", ".join(f"{n} long" for n in names)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
