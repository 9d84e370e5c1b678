"""Repair of the role structure of conversations by cheapest edits (operator 11).

A repaired conversation is empty, or an optional system row and then pairs of a user and
an assistant row. Rows are kept, given another role or deleted, and empty rows are
inserted; the cheapest such edits are found over the four states of that pattern
(nothing yet, after the system row, after a user row, after an assistant row).

Four-Russians: what is left to pay from each state is a vector of four costs. Less their
least, few different vectors exist, so for every block of rows (``BLOCK`` symbols of a
small alphabet) and every vector after it, the vector before it and what is added are
worked out beforehand. A conversation is run through from its end by one lookup a block.
The edits are then read from its start: each block is expanded backward from the vector
after it, and of all edits that lead to the least cost the letter that sorts first is
taken, so ties give the audit that is least in ASCII order. Expanded blocks are remembered.

In Spark: damage and faults are SQL functions. Narrow rows (no texts but their first
characters and digests) are dealt by conversation, sorted and streamed through the tables;
a task holds a byte a row of one conversation. Then texts follow in the same order and are
hashed as they come, next to the audit. SHA-256 has to see a conversation's text in
order, so the rows of one conversation pass through one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The costs of edits, and what a truncated row that isn't deleted adds.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: White space that makes a row blank.
SPACE = " \t\n\x0b\f\r"
#: Rows in a block of the tables.
BLOCK = 4
#: Characters of a text by which rows of one turn are ordered before their digests are.
TIE_CHARS = 32

#: States: nothing yet, after system, after user, after assistant; the state after the next row of the pattern.
NEXT = (2, 2, 3, 2)
#: By state: the state after keeping a row of this initial.
KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
INITIALS = "sua"
#: Symbols: 0 has to be deleted; then by initial (s, u, a, any other) whether the row is truncated.
SYMBOLS = 1 + 2 * (len(INITIALS) + 1)
FAR = 10**6


def _closed(costs: list[int]) -> tuple[int, ...]:
    """Costs where empty rows may be inserted first; two in a row reach every state that has use of them."""
    for _ in range(2):
        costs = [min(costs[q], INSERT + costs[NEXT[q]]) for q in range(4)]
    return tuple(costs)


def _row_cost(symbol: int) -> tuple[bool, str, int]:
    """(has to go, initial, what keeping adds) of a symbol."""
    if not symbol:
        return True, "", 0
    return False, (INITIALS + "-")[(symbol - 1) // 2], TRUNCATED * ((symbol - 1) % 2)


def _before(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """The costs before a row of this symbol, from those after it."""
    gone, initial, more = _row_cost(symbol)
    costs = []
    for q in range(4):
        options = [DELETE + after[q]]
        if not gone:
            options.append(REROLE + more + after[NEXT[q]])
            if initial in KEEP[q]:
                options.append(more + after[KEEP[q][initial]])
        costs.append(min(options))
    return _closed(costs)


class Tables:
    """All cost vectors, less their least, and where a block of up to ``BLOCK`` symbols leads from each.

    ``to[k][v, code]`` is the vector before a block of k symbols with vector v after it,
    ``added[k]`` what its least is more; the code's digits, first row first, are the symbols.
    """

    def __init__(self):
        self.vectors: list[tuple[int, ...]] = []
        known: dict[tuple[int, ...], int] = {}

        def number(costs: tuple[int, ...]) -> tuple[int, int]:
            least = min(costs)
            vector = tuple(c - least for c in costs)
            if vector not in known:
                known[vector] = len(self.vectors)
                self.vectors.append(vector)
            return known[vector], least

        self.end, _ = number(_closed([0, FAR, FAR, 0]))
        to, added, at = [], [], 0
        while at < len(self.vectors):
            found = [number(_before(self.vectors[at], s)) for s in range(SYMBOLS)]
            to.append([v for v, _ in found])
            added.append([least for _, least in found])
            at += 1
        one, plus = np.array(to, dtype=np.int32), np.array(added, dtype=np.int32)
        self.to = [np.arange(len(one), dtype=np.int32)[:, None], one]
        self.added = [np.zeros((len(one), 1), dtype=np.int32), plus]
        for _ in range(BLOCK - 1):
            inner, cost = self.to[-1], self.added[-1]
            # A row more at the front: its digit is the highest.
            self.to.append(np.stack([one[inner, s] for s in range(SYMBOLS)], axis=1).reshape(len(one), -1))
            self.added.append(np.stack([cost + plus[inner, s] for s in range(SYMBOLS)], axis=1).reshape(len(one), -1))
        self.expanded: dict[tuple[bytes, int, int], tuple[str, int]] = {}

    def expand(self, symbols: bytes, after: int, state: int) -> tuple[str, int]:
        """The least of the cheapest edits of a block's rows from ``state``, and the state they lead to."""
        key = (symbols, after, state)
        if key not in self.expanded:
            behind, costs = [after], []
            for s in reversed(symbols):
                plus = int(self.added[1][behind[-1], s])
                behind.append(int(self.to[1][behind[-1], s]))
                costs.append([c + plus for c in self.vectors[behind[-1]]])
            letters = []
            for i, s in enumerate(symbols):
                # Costs before the row and after it, both from the same least.
                here, then = costs[-1 - i], self.vectors[behind[-2 - i]]
                gone, initial, more = _row_cost(s)
                while True:
                    if DELETE + then[state] == here[state]:
                        letters.append("D")
                        break
                    if INSERT + here[NEXT[state]] == here[state]:
                        letters.append("I")
                        state = NEXT[state]
                        continue
                    if not gone and initial in KEEP[state] and more + then[KEEP[state][initial]] == here[state]:
                        letters.append("K")
                        state = KEEP[state][initial]
                    else:
                        letters.append("R")
                        state = NEXT[state]
                    break
            if len(self.expanded) >= 200_000:
                self.expanded.clear()
            self.expanded[key] = "".join(letters), state
        return self.expanded[key]

    def audit(self, symbols: bytes) -> tuple[int, str]:
        """(cost, audit) of a conversation of these symbols."""
        blocks = [symbols[i : i + BLOCK] for i in range(0, len(symbols), BLOCK)]
        after, total = [self.end], 0
        for block in reversed(blocks):
            code = 0
            for s in block:
                code = code * SYMBOLS + s
            total += int(self.added[len(block)][after[-1], code])
            after.append(int(self.to[len(block)][after[-1], code]))
        total += self.vectors[after[-1]][0]
        letters, state = [], 0
        for i, block in enumerate(blocks):
            found, state = self.expand(block, after[-2 - i], state)
            letters.append(found)
        while state in (1, 2):
            letters.append("I")
            state = NEXT[state]
        return total, "".join(letters)


@lru_cache(1)
def tables() -> Tables:
    """The tables of this worker process; made from the rules in well under a second."""
    return Tables()


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped, copy): every row as it is after damage, dropped ones marked and repeated ones twice.

    Nulls count as one space. What happens to a row depends on its conversation and turn alone.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    found = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    gone = F.col("kind") == 0
    return found.select("conv_id", "turn", role.alias("role"), F.when(gone, "").otherwise(changed).alias("text"), gone.alias("dropped"), copies)


def _order() -> list[Column]:
    """The order of a conversation's rows: by turn; those of one turn by role, first characters and digest, so equal ones are neighbours."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("tie"), F.col("digest"), F.col("copy")]


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds what rows are ordered and told apart by."""
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return rows.withColumn("tie", F.left("text", F.lit(TIE_CHARS))).withColumn("digest", digest)


def _narrow(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, tie, digest, copy, dropped, fault, initial): rows without their texts, first fault named."""
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    marked = _keyed(rows).select(
        "conv_id", "turn", "role", "tie", "digest", "copy", "dropped", (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"), F.left("role", F.lit(1)).alias("initial")
    )
    # Dealt by conversation alone, so that windows and sorting need no other shuffle.
    seen = Window.partitionBy("conv_id", "dropped", "digest").orderBy(F.col("turn").asc_nulls_first(), "copy")
    nth = F.row_number().over(seen)
    fault = F.when(F.col("blank"), "b").when(nth > 1, "d").when(F.col("cut"), "t").otherwise("")
    return marked.repartition("conv_id").withColumn("fault", fault)


def repair_plans(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation of damaged ``rows``."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    arrow = [None, *[pa.int64()] * 6, pa.string()]
    symbol_of = {i: 1 + 2 * INITIALS.index(i) for i in INITIALS}
    other = 1 + 2 * len(INITIALS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, begun, conv = tables(), False, None
        symbols, faults, turns, pairs, before = bytearray(), {}, [], 0, ""

        def close() -> tuple:
            cost, audit = table.audit(bytes(symbols))
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
            return conv, gaps, faults.get("b", 0), faults.get("d", 0), faults.get("t", 0), pairs, cost, audit

        def out(found: list[tuple], type_: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t or type_) for c, t in zip(columns, arrow, strict=True)], names)

        type_ = None
        for batch in batches:
            type_, found = batch.column(0).type, []
            for id_, turn, initial, dropped, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not begun or id_ != conv:
                    if begun:
                        found.append(close())
                    begun, conv = True, id_
                    symbols, faults, turns, pairs, before = bytearray(), {}, [], 0, ""
                if dropped:
                    continue
                if symbols and before + initial not in ("su", "ua", "au"):
                    pairs += 1
                before = initial
                symbols.append(0 if fault in ("b", "d") else symbol_of.get(initial, other) + (fault == "t"))
                if fault:
                    faults[fault] = faults.get(fault, 0) + 1
                if turn is not None:
                    if not turns:
                        turns = [turn, turn, 1]
                    elif turn != turns[1]:
                        turns[1:] = [turn, turns[2] + 1]
            if found:
                yield out(found, type_)
        if begun:
            yield out([close()], type_)

    ordered = _narrow(rows).sortWithinPartitions("conv_id", *_order()).select("conv_id", "turn", "initial", "dropped", "fault")
    return ordered.mapInArrow(run, f"conv_id {id_type}, {', '.join(f'{n} long' for n in names[1:-1])}, audit string")


class _Writer:
    """Applies an audit to rows as they come, and hashes what is left of them."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.digest, self.some = audit, 0, 0, hashlib.sha256(), False

    def _write(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.some else "") + role + ":" + text).encode())
        self.some = True

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = NEXT[self.state]
            self._write("user" if self.state == 2 else "assistant", "")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self._inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = KEEP[self.state][role[0]]
            self._write(role, text)
        elif letter == "R":
            self.state = NEXT[self.state]
            self._write("user" if self.state == 2 else "assistant", text)

    def done(self) -> str:
        self._inserted()
        return self.digest.hexdigest()


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256): every conversation, damaged and repaired.

    Nulls in any column count as one space, and those of ``turn`` come first; a null
    ``conv_id`` is a conversation of its own. Rows of one turn are taken by role, first
    characters and digest of their text; repeated rows are neighbours, so all but the
    first are duplicates. A role with another initial than s, u and a, or with none, can't
    be kept as it is. A conversation without rows after damage has zeros, an empty audit
    and the empty text's digest; no rows give no rows. Other columns don't matter.
    """
    rows = damaged(conversations)
    id_type = rows.schema["conv_id"].dataType.simpleString()
    plans = repair_plans(rows)
    figures = [c for c in plans.columns if c != "conv_id"]
    head = plans.select("conv_id", F.struct(*figures).alias("plan"), *(F.lit(None).cast(t).alias(n) for n, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("tie", "string"), ("digest", "binary"), ("copy", "int"))))
    body = _keyed(rows.filter(~F.col("dropped"))).select("conv_id", F.lit(None).cast(head.schema["plan"].dataType).alias("plan"), "turn", "role", "text", "tie", "digest", "copy")
    names = ["conv_id", *figures, "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, plan = None, ()
        for batch in batches:
            found = []
            for id_, own, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own is not None:
                    if writer:
                        found.append((*plan, writer.done()))
                    writer, plan = _Writer(own["audit"]), (id_, *(own[f] for f in figures))
                else:
                    writer.add(role, text)
            type_ = batch.column(0).type
            if found:
                yield out(found, type_)
        if writer:
            yield out([(*plan, writer.done())], type_)

    def out(found: list[tuple], type_: pa.DataType) -> pa.RecordBatch:
        types = [type_, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names)

    ordered = head.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", F.col("plan").isNull(), *_order()).select("conv_id", "plan", "role", "text")
    return ordered.mapInArrow(run, f"conv_id {id_type}, {', '.join(f'{f} long' for f in figures[:-1])}, audit string, repaired_sha256 string")
