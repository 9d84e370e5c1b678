"""Best-fit packing of token pieces after dominance reduction (operator 6).

The lengths alone decide a packing, and there are at most ``capacity`` of them, so
the instance that is solved is a histogram of bounded size, whatever the corpus:

1. dominance reduction fixes sets that some optimal packing contains, as Martello and
   Toth do: a piece that nothing else fits beside; a pair that fills a sequence
   exactly, or that is the best where only one more piece fits; a pair or triple that
   dominates where only two more fit. Equal sets are fixed together;
2. what remains is packed best-fit, longest first, equal lengths together.

The plan is a list of runs ``(length, first rank, sequence, offset, per sequence)``:
the n-th piece of a length finds its place by its rank. Ranks are dealt out in Spark
by (length, chunk), so that no length, however frequent, meets in one task.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, parts_for
from tidemark.llm.wordbpe import packer_of

#: Pieces of one length and chunk that meet in one sort, about.
CHUNK_ROWS = 1_000_000


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, by: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document, and its ``by`` (an int) if named.

    A null text counts as empty; an empty one is the end id alone. Repeated rows each
    give their own pieces.
    """

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *([by] if by else [])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = packer_of(tokenizer), end_id.to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            for doc, text, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = bpe.pack(text or "") + end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, n, at // 4, len(part) // 4, zlib.crc32(part), *rest))
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())[: len(names)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (f", `{by}` int" if by else "")
    more = [F.col(by).cast("int")] if by else []
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *more).mapInArrow(cut, schema)


class _Plan:
    """Runs of equal placements over the ranks of each length."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.copy()
        self.next_rank = np.zeros_like(counts)
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int, int]] = []

    def place(self, length: int, n: int, sequence: int, offset: int, per: int = 1) -> None:
        self.runs.append((length, int(self.next_rank[length]), sequence, offset, per))
        self.next_rank[length] += n
        self.left[length] -= n

    def fix(self, lengths: list[int], n: int) -> None:
        """n new sequences, each holding these lengths."""
        at = 0
        for length in lengths:
            self.place(length, n, self.sequences, at)
            at += length
        self.sequences += n


def _smallest(left: np.ndarray, n: int, without: int, above: int = 0) -> list[int]:
    """The n shortest remaining pieces longer than ``above``, one of ``without`` set aside."""
    found: list[int] = []
    for length in np.flatnonzero(left[above + 1 :]) + above + 1:
        found += [int(length)] * min(n, int(left[length]) - (length == without))
        if len(found) >= n:
            break
    return found[:n]


def _largest(left: np.ndarray, room: int, without: list[int]) -> int:
    """The longest remaining piece of at most ``room``; 0 if none."""
    for length in np.flatnonzero(left[: room + 1])[::-1]:
        if left[length] > without.count(int(length)):
            return int(length)
    return 0


def _dominating(left: np.ndarray, length: int, capacity: int) -> list[int] | None:
    """A set with this length that dominates all others, if a rule proves one."""
    room = capacity - length
    small = _smallest(left, 3, length)
    if not small or small[0] > room:
        return [length]
    best = _largest(left, room, [length])
    if best == room or len(small) < 2 or small[0] + small[1] > room:
        return [length, best]
    if len(small) == 3 and sum(small) <= room:
        return None
    # Two more fit at most, each no longer than ``best``.
    beside = _largest(left, room - best, [length, best])
    if not beside:
        pair = max((a + _largest(left, min(a, room - a), [length, a]) for a in map(int, np.flatnonzero(left[: room + 1]))), default=0)
        return [length, best] if pair <= best else None
    longer = _smallest(left, 2, length, above=beside)
    if len(longer) < 2 or sum(longer) > room:
        return [length, best, beside]  # any other pair has one of at most ``beside``
    return None


def plan(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Runs (length, first rank, sequence, offset, per sequence) and the number of sequences."""
    p = _Plan(counts)
    if p.left[capacity]:
        p.fix([capacity], int(p.left[capacity]))
    for length in range(capacity - 1, capacity // 2, -1):
        if n := int(min(p.left[length], p.left[capacity - length])):
            p.fix([length, capacity - length], n)
    if capacity % 2 == 0 and (n := int(p.left[capacity // 2]) // 2):
        p.place(capacity // 2, 2 * n, p.sequences, 0, 2)
        p.sequences += n
    for length in range(capacity, 0, -1):
        while p.left[length] and (found := _dominating(p.left, length, capacity)):
            p.fix(found, min(int(p.left[x]) // found.count(x) for x in found))
    bins: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []

    def add(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in bins:
                bins[room] = []
                bisect.insort(rooms, room)
            bins[room].append((first, n))

    for length in range(capacity, 0, -1):
        while n := int(p.left[length]):
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, there = bins[room].pop()
                if not bins[room]:
                    del bins[room]
                    rooms.pop(at)
            else:
                room, first, there = capacity, p.sequences, -(-n // (capacity // length))
                p.sequences += there
            per = room // length
            full = min(there, n // per)
            if full:
                p.place(length, full * per, first, capacity - room, per)
                add(room - per * length, first, full)
            rest = int(p.left[length]) if full < there else 0
            if 0 < rest < per:
                p.place(length, rest, first + full, capacity - room, per)
                add(room - rest * length, first + full, 1)
                full += 1
            add(room, first + full, there - full)
    return np.array(p.runs, dtype=np.int64).reshape(-1, 5), p.sequences


def pack(pieces: DataFrame, capacity: int = 2048, by: str | None = None) -> DataFrame:
    """Give every piece (length 1 to ``capacity``) its ``sequence_id`` and ``offset``.

    ``pieces`` is read twice, so pass a written table. Equal pieces are interchangeable;
    no rows give no rows. Columns of ``pieces`` stay, also such as are named like ours.
    With ``by``, an int column of few values, each value's pieces are packed by themselves
    and the sequences are numbered in its order.
    """
    chunks = parts_for(pieces.count(), CHUNK_ROWS, 64)
    key, part = "__chunk", "__part"
    dealt = pieces.withColumn(key, F.pmod(F.xxhash64("doc_id", "piece"), F.lit(chunks)).cast("int")).withColumn(part, F.col(by).cast("long") if by else F.lit(0).cast("long"))
    counted = dealt.groupBy(part, "length", key).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(part, "length").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    first = counted.select(part, "length", key, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    counts: dict[int, np.ndarray] = {}
    for row in counted.groupBy(part, "length").agg(F.sum("__n").alias("n")).collect():  # capacity rows a part at most
        counts.setdefault(row[part], np.zeros(capacity + 1, dtype=np.int64))[row["length"]] = row["n"]
    wide, before_it, plans = capacity + 1, 0, [np.empty((0, 5), dtype=np.int64)]
    for at in sorted(counts):
        own, n = plan(counts[at], capacity)
        plans.append(own + np.array([at * wide, 0, before_it, 0, 0]))
        before_it += n
    runs = np.concatenate(plans)
    order = np.lexsort((runs[:, 1], runs[:, 0]))
    runs = runs[order]
    starts = (runs[:, 0] << 40) + runs[:, 1]

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank, at = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("length", "__rank", part))
            run = runs[np.searchsorted(starts, (at * wide + length << 40) + rank, side="right") - 1]
            place = rank - run[:, 1]
            kept = [i for i, name in enumerate(batch.schema.names) if name not in ("__rank", part)]
            columns = [batch.column(i) for i in kept]
            columns += [pa.array(run[:, 2] + place // run[:, 4]), pa.array(run[:, 3] + place % run[:, 4] * length)]
            yield pa.RecordBatch.from_arrays(columns, [*(batch.schema.names[i] for i in kept), "sequence_id", "offset"])

    rank = F.row_number().over(Window.partitionBy(part, "length", key).orderBy("doc_id", "piece")) - 1
    ranked = (
        dealt.withColumn("__local", rank)
        .join(first, [part, "length", key])
        .select(*(F.col(c) for c in pieces.columns), (F.col("__local") + F.col("__first")).cast("long").alias("__rank"), part)
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return ranked.mapInArrow(seat, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, by: str | None = None) -> DataFrame:
    """Pack the documents' tokens into as few sequences of ``capacity`` as the method finds."""
    pieces = materialize(token_pieces(docs, tokenizer, capacity, by=by), "pieces")
    return pack(pieces, capacity, by)
