"""Repair of conversations by weighted parsing of the edits of their turns.

A repaired conversation is empty, or has pairs of user and assistant after a system turn or
none. Its grammar in Chomsky normal form has a symbol ``(p, q)`` for whatever leads from
state p to state q of the turns read so far: ``(p, q) -> (p, r) (r, q)``, and ``(p, q)`` for
one row with an edit that leads there. Insertions read no row, so every cell of one row is
closed under them before and after. Cells hold the least (cost, edits) of a symbol over a
span of rows and are combined bottom-up by the span's length (CYK), over all places to cut.

A span can be cut anywhere in this grammar. So conversations of any length are parsed in
blocks of ``BLOCK`` rows, each with a chart of its own, and the blocks' cells are combined
from left to right, with the digest of the repaired text kept for each state. A task holds a
block, not a conversation.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resultlake.llm import batches as B

#: Rows of a block, and bytes of its texts after which it ends, at most.
BLOCK, BLOCK_BYTES = 16, 4 << 20
#: Fixed costs of edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing read, after system, after user, after assistant; the first and last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
NAMES = {"u": "user", "a": "assistant"}

#: Class of a row: its role's initial (o: another), capital if it is truncated; x must be deleted.
Cell = dict[tuple[int, int], tuple[int, str]]


def _better(cell: Cell, key: tuple[int, int], value: tuple[int, str]) -> None:
    if key not in cell or value < cell[key]:
        cell[key] = value


def combine(left: Cell, right: Cell) -> Cell:
    """The least (cost, edits) of ``(p, q) -> (p, r) (r, q)``."""
    out: Cell = {}
    for (p, r), (cost, edits) in left.items():
        for q in range(4):
            other = right.get((r, q))
            if other:
                _better(out, (p, q), (cost + other[0], edits + other[1]))
    return out


def insertions() -> Cell:
    """What insertions alone lead to: nothing, one turn, or two."""
    cell: Cell = {(p, p): (0, "") for p in range(4)}
    one = {(p, q): (INSERT, "I") for (p, role), q in STEPS.items() if role in NAMES}
    for _ in range(2):
        for key, value in combine(cell, one).items():
            _better(cell, key, value)
    return cell


INSERTED = insertions()


@lru_cache(1 << 10)
def row_cell(kind: str) -> Cell:
    """The edits of one row, with insertions before and after it."""
    cell: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if kind != "x":
        more = TRUNCATED if kind.isupper() else 0
        for (p, role), q in STEPS.items():
            if role == kind.lower():
                _better(cell, (p, q), (KEEP + more, "K"))
            if role in NAMES:
                _better(cell, (p, q), (REROLE + more, "R"))
    return combine(combine(INSERTED, cell), INSERTED)


@lru_cache(1 << 12)
def parse(kinds: str) -> Cell:
    """The cell of a whole block: CYK by span length over all cuts."""
    n = len(kinds)
    chart = {(i, 1): row_cell(k) for i, k in enumerate(kinds)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            cell: Cell = {}
            for cut in range(1, size):
                for key, value in combine(chart[i, cut], chart[i + cut, size - cut]).items():
                    _better(cell, key, value)
            chart[i, size] = cell
    return chart[0, n]


class Path:
    """The best way to a state: cost, edits since those that all states share, and the text's digest."""

    def __init__(self, cost: int, edits: str, digest, begun: bool) -> None:  # noqa: ANN001
        self.cost, self.edits, self.digest, self.begun = cost, edits, digest, begun

    def after(self, state: int, cost: int, edits: str, rows: list[tuple[str, str]]) -> Path:
        """With the edits of the next rows (role, text), from ``state`` on."""
        digest, begun, at = self.digest.copy(), self.begun, 0
        for e in edits:
            if e == "I":
                role, text = NAMES["a" if state == USER else "u"], ""
            else:
                role, text = rows[at]
                at += 1
                if e == "D":
                    continue
                if e == "R":
                    role = NAMES["a" if state == USER else "u"]
            state = STEPS[state, role[0]]
            digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
            begun = True
        return Path(self.cost + cost, self.edits + edits, digest, begun)


class Repair:
    """One conversation, row by row in its order."""

    def __init__(self) -> None:
        self.paths = {START: Path(0, "", hashlib.sha256(), False)}
        self.shared: list[str] = []  # edits that all paths begin with
        self.rows: list[tuple[str, str]] = []
        self.kinds, self.bytes = "", 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.before = None

    def add(self, turn: int | None, role: str, text: str, fault: str, kind: str) -> None:
        if len(self.rows) >= BLOCK or self.bytes >= BLOCK_BYTES:
            self._close(range(4))
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        self.illegal += self.before is not None and self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        if turn is not None and turn != self.last:  # turns come in order
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        self.rows.append((role, text))
        self.kinds += kind
        self.bytes += len(text)

    def _close(self, states: Iterable[int]) -> None:
        """Combine the paths with the cell of the block."""
        cell = parse(self.kinds) if self.kinds else INSERTED
        new = {}
        for q in states:
            ways = [((path.cost + cell[p, q][0], path.edits + cell[p, q][1]), p) for p, path in self.paths.items() if (p, q) in cell]
            if ways:
                _, p = min(ways)
                new[q] = self.paths[p].after(p, *cell[p, q], self.rows)
        shared = os.path.commonprefix([p.edits for p in new.values()])
        self.shared.append(shared)
        for p in new.values():
            p.edits = p.edits[len(shared) :]
        self.paths, self.rows, self.kinds, self.bytes = new, [], "", 0

    def result(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        cell = parse(self.kinds) if self.kinds else INSERTED
        best = min(((path.cost + cell[p, q][0], path.edits + cell[p, q][1]), q) for p, path in self.paths.items() for q in (START, ASSISTANT) if (p, q) in cell)[1]
        self._close([best])
        path = self.paths[best]
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, path.cost, "".join(self.shared) + path.edits, path.digest.hexdigest()


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): every row of ``conversations`` damaged by a digest of its key; nulls are one blank.

    By the remainder by 20 of the CRC-32 of ``conv_id:turn``: 0 the row is gone, 1 its text
    is empty, 2 its text has no ``[.!?]``, 3 it comes twice, 4 its role is user. Of a row
    that is gone one row stays that tells so.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    base = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), how.alias("how"))
    body = F.when(F.col("how").isin(0, 1), "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("how") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("how") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return base.select("conv_id", "turn", role.alias("role"), body.alias("text"), (F.col("how") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, gone) with ``fault``, the first of blank, duplicate and truncated, and ``kind``, the class for the parser.

    Rows of a conversation are in the order of turn, nulls first; rows of one turn in that
    of role and text. A row is a duplicate if an earlier one has its role and text.
    """
    nth = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "text").orderBy("turn"))
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank").when(F.col("__nth") > 1, "duplicate").when(~ended, "truncated").otherwise("")
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    kind = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    return rows.withColumn("__nth", nth).withColumn("fault", fault).withColumn("kind", kind).drop("__nth")


def repair(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id, turn, role, text, gone): its faults and its cheapest repair.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. Rows with a null conv_id are one conversation. A conversation of which
    all rows are gone has zeros, an empty audit and the digest of an empty text; so has an
    empty table no rows at all. Of repairs of one cost the least audit by its letters is
    taken. A conversation goes through one task, as its text's digest needs, in the order of
    its turns; the task holds ``BLOCK`` rows of it and its audit. Other columns are ignored.
    """
    B.small_batches(rows.sparkSession)
    near = faults(rows.select("conv_id", "turn", "role", "text", "gone").repartition("conv_id"))  # serves the window as well
    kept = near.withColumn("turn", F.col("turn").cast("long")).sortWithinPartitions("conv_id", "turn", "role", "text")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kind = rows.schema["conv_id"].dataType.simpleString()

    def each(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last, done, ids = None, None, [], None

        def flush(ids: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*done))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], ids), *[pa.array(c, pa.int64()) for c in columns[1:7]], *[pa.array(c, pa.string()) for c in columns[7:]]], ["conv_id", *counts, "audit", "repaired_sha256"])

        for b in B.pieces(it, "text"):
            ids = b.schema.field("conv_id").type
            for conv, turn, role, text, gone, fault, how in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone", "fault", "kind"))):
                if now is None or conv != last:
                    if now is not None:
                        done.append((last, *now.result()))
                    now, last = Repair(), conv
                if not gone:
                    now.add(turn, role, text, fault, how)
            if done:
                yield flush(ids)
        if now is not None:
            done.append((last, *now.result()))
            yield flush(ids)

    return kept.mapInArrow(each, f"conv_id {kind}, " + ", ".join(f"{c} long" for c in counts) + ", audit string, repaired_sha256 string")
