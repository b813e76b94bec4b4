"""Repair of the order of roles in conversations, by alignment with a grammar.

The roles of a sound conversation start with `s?(ua)+` (their initials), or it has no turns. Edits: Keep
a row at no cost, Rerole it to user or assistant at 1, Delete it at 2, Insert a turn without text at 5; a
truncated row that is not deleted costs 5 more, blank and duplicate rows must be deleted. The cheapest
edits count; of these the ones whose initials, in order, are ASCII-least.

The grammar has two strings, `uaua...` and `suaua...`, and a target is a feasible prefix of one. A matrix
of Wagner and Fischer for rows against the string, filled from the end, holds all targets at once: each feasible length ends in a
column of its own, and a cell has the cost from there to the best of them. Cells are left out by Ukkonen's bound: being i - j
deletions or j - i insertions off the diagonal costs 2 or 5 each, and that may not exceed the incumbent, which is a greedy plan at
first and then the cost of the other string. The audit is traced from the matrix by the least letter that keeps the cost, and the
strings' audits are compared.

A band that grows with the conversation would make long ones quadratic. Beyond FOLD_ROWS rows the columns are folded:
since every length of the right parity is feasible, the cost to the end depends on a column's place only through what the grammar
expects there, one of four states. The costs and audits are the same; time and memory are linear.

On Spark: a first pass over sorted rows without their texts (a digest stands for a text) decides the edits, a second one
merges edits and texts, both sorted alike, and emits or digests what is left. Neither holds the texts of
a conversation: what is held is a few numbers for each row of the conversation at hand.
"""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlemill.llm.common import bytes_of, extended, pieces

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: What a row is, besides its initial.
SOUND, CUT, GONE = "k", "t", "d"
#: Rows from which on the columns of the matrix are folded.
FOLD_ROWS = 1000
#: Rows up to which the outcome for a sequence of rows is remembered, and how many are.
MEMO_ROWS, MEMO = 16, 100_000
NEVER = 1 << 60
ROLES = {"u": "user", "a": "assistant"}
BLANKS = " \t\n\x0b\f\r"
OUT_ROWS = 10_000

Row = tuple[str, str]  # the initial of its role, and SOUND, CUT or GONE


def expected(j: int, start: bool) -> str:
    """The j-th letter of a grammar string."""
    return "s" if start and j == 0 else "ua"[(j - start) % 2]


def is_length(m: int, start: bool) -> bool:
    return m >= 3 and m % 2 == 1 if start else m % 2 == 0


def step_cost(row: Row, letter: str) -> tuple[int, str]:
    """What it costs to let a row stand for a letter, and the edit."""
    initial, kind = row
    if kind == GONE or (letter == "s" and initial != "s"):
        return NEVER, ""
    more = TRUNCATED if kind == CUT else 0
    return (KEEP + more, "K") if initial == letter else (REROLE + more, "R")


def plan_cost(rows: list[Row], start: bool) -> int:
    """The cost of a plain plan: delete what is faulty or of another role, rerole what does not alternate."""
    cost, j = 0, 0
    for initial, kind in rows:
        letter = expected(j, start)
        if kind != SOUND or (letter == "s") != (initial == "s") or initial not in "sua":
            cost += DELETE
        else:
            cost += KEEP if initial == letter else REROLE
            j += 1
    if start and j == 0:
        return NEVER
    while not is_length(j, start):
        cost, j = cost + INSERT, j + 1
    return cost


def banded(rows: list[Row], start: bool, incumbent: int) -> tuple[int, str] | None:
    """The least cost and its audit for one grammar string, if the cost does not exceed the incumbent."""
    n, deep, high = len(rows), incumbent // DELETE, incumbent // INSERT
    letters = [expected(j, start) for j in range(n + high + 1)]
    matrix: list[list[int]] = [[]] * (n + 1)
    lows = [max(0, i - deep) for i in range(n + 1)]

    def at(i: int, j: int) -> int:
        k = j - lows[i]
        return matrix[i][k] if 0 <= k < len(matrix[i]) else NEVER

    def edits(i: int, j: int) -> Iterator[tuple[str, int, int, int]]:
        """From a cell, in the order of letters: the edit, its cost, the next cell."""
        if i < n:
            yield "D", DELETE, i + 1, j
        if letters[j] != "s" and j < i + high:
            yield "I", INSERT, i, j + 1
        if i < n:
            cost, edit = step_cost(rows[i], letters[j])
            if edit:
                yield edit, cost, i + 1, j + 1

    for i in range(n, -1, -1):
        row = matrix[i] = [NEVER] * (i + high + 1 - lows[i])
        for j in range(i + high, lows[i] - 1, -1):
            least = 0 if i == n and is_length(j, start) else NEVER
            for _, cost, x, y in edits(i, j):
                least = min(least, cost + at(x, y))
            row[j - lows[i]] = least
    total = at(0, 0)
    if total > incumbent:
        return None
    audit, i, j = [], 0, 0
    while i < n or not is_length(j, start):
        edit, _, i, j = next(e for e in edits(i, j) if e[1] + at(e[2], e[3]) == at(i, j))
        audit.append(edit)
    return total, "".join(audit)


#: What the grammar expects in each folded column, and the column after it: the start, the first u after it, a, and u where a conversation may end.
FOLDED = (("s", 1), ("u", 2), ("a", 3), ("u", 2))


def folded(rows: list[Row]) -> tuple[int, str, bool]:
    """The least cost, its audit and its grammar string, with columns folded to what the grammar expects."""
    n = len(rows)
    costs = [array("q", [NEVER]) * (n + 1) for _ in FOLDED]
    for i in range(n, -1, -1):
        for x, (letter, after) in enumerate(FOLDED):
            least = 0 if i == n and x == 3 else NEVER
            if i < n:
                least = min(DELETE + costs[x][i + 1], step_cost(rows[i], letter)[0] + costs[after][i + 1])
            costs[x][i] = min(least, NEVER)
        a, u = costs[2][i], costs[3][i]
        costs[2][i], costs[3][i] = min(a, INSERT + u), min(u, INSERT + a)
        costs[1][i] = min(costs[1][i], INSERT + costs[2][i])
    least = min(costs[0][0], costs[3][0])
    traced = []
    for x in (3, 0):
        if costs[x][0] != least:
            continue
        start, audit, i = x == 0, [], 0
        while i < n or x != 3:
            letter, after = FOLDED[x]
            now = costs[x][i]
            cost, edit = step_cost(rows[i], letter) if i < n else (NEVER, "")
            if i < n and DELETE + costs[x][i + 1] == now:
                edit, i = "D", i + 1
            elif letter != "s" and INSERT + costs[after][i] == now:
                edit, x = "I", after
            else:
                x, i = after, i + 1
            audit.append(edit)
        traced.append((least, "".join(audit), start))
    return min(traced)


def aligned(rows: list[Row]) -> tuple[int, str, bool]:
    """The least cost, the least audit of that cost, and whether it is of the string with a start."""
    if len(rows) > FOLD_ROWS:
        return folded(rows)
    incumbent, best = min(plan_cost(rows, False), plan_cost(rows, True)), None
    for start in (False, True):
        found = banded(rows, start, incumbent)
        if found and (best is None or found < best[:2]):
            best, incumbent = (*found, start), found[0]
    return best


@functools.lru_cache(maxsize=MEMO)
def remembered(rows: tuple[Row, ...]) -> tuple[int, str, bool]:
    return aligned(list(rows))


def row_edits(audit: str, start: bool) -> Iterator[str]:
    """For each row, and then for the end: the letters of turns inserted before it, and K, D, or the letter of its new role."""
    before, j = "", 0
    for edit in audit:
        if edit == "I":
            before += expected(j, start)
        else:
            yield before + (expected(j, start) if edit == "R" else edit)
            before = ""
        j += edit != "D"
    yield before


class Conversation:
    """What the first pass keeps of the conversation at hand."""

    def __init__(self):
        self.rows: list[Row] = []
        self.keys: list[tuple] = []
        self.seen: set[tuple] = set()
        self.turns: set = set()
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

    def add(self, turn, role: str, digest: bytes, blank: bool, cut: bool) -> None:
        fault = "blank" if blank else "duplicate" if (role, digest) in self.seen else "truncated" if cut else ""
        self.seen.add((role, digest))
        if fault:
            self.counts[fault] += 1
        initial = role[:1] if role[:1] in "sua" else "x"
        if self.rows:
            self.counts["illegal"] += self.rows[-1][0] + initial not in ("su", "ua", "au")
        self.rows.append((initial or "x", SOUND if not fault else CUT if fault == "truncated" else GONE))
        self.keys.append((turn, role, digest))
        if turn is not None:
            self.turns.add(turn)

    def edits(self) -> Iterator[tuple]:
        """`(last, turn, role, digest, edit, gaps, blank, duplicate, truncated, illegal, cost, audit)` of each row, then of the whole."""
        cost, audit, start = remembered(tuple(self.rows)) if len(self.rows) <= MEMO_ROWS else aligned(self.rows)
        gaps = max(self.turns) - min(self.turns) + 1 - len(self.turns) if self.turns else 0
        steps = row_edits(audit, start)
        for key in self.keys:
            yield (False, *key, next(steps), *[None] * 7)
        yield (True, None, None, None, next(steps), gaps, *self.counts.values(), cost, audit)


SUMMARY = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def prepared(df: DataFrame, conv: str, turn: str, role: str, text: str, absent: str | None) -> DataFrame:
    """The columns in use, under names of our own. Null roles and texts are one blank."""
    there = ~F.coalesce(F.col(f"`{absent}`"), F.lit(False)) if absent else F.lit(True)
    words = F.when(there, F.coalesce(F.col(f"`{text}`"), F.lit(" ")))
    return df.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.when(there, F.coalesce(F.col(f"`{role}`"), F.lit(" "))).alias("role"), words.alias("text"), F.unhex(F.sha2(words, 256)).alias("digest"),
    )


def sorted_rows(df: DataFrame, *keys: Column | str) -> DataFrame:
    return df.repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), *keys)


def in_batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def arrow_schema(df_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df_schema)


def decided(rows: DataFrame) -> DataFrame:
    """The first pass: the edit of each prepared row, and at the end of each conversation its figures."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    small = rows.select("conv", "turn", "role", "digest", (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    out = extended(small.select("conv"), "last boolean, turn bigint, role string, digest binary, edit string, " + SUMMARY)
    schema = arrow_schema(out)

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, key = None, None
        for batch in batches:
            for conv, turn, role, digest, blank, cut in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now is None or conv != key:
                    if now is not None:
                        yield from ((key, *e) for e in now.edits())
                    now, key = Conversation(), conv
                if digest is not None:
                    now.add(turn, role, digest, blank, cut)
        if now is not None:
            yield from ((key, *e) for e in now.edits())

    order = (F.asc_nulls_first("turn"), "role", "digest")
    return sorted_rows(small, *order).mapInArrow(lambda batches: in_batches(edits(batches), schema), out)


def merged(rows: DataFrame) -> DataFrame:
    """Edits and texts side by side: those of equal rows first the edits, then the texts."""
    edits = decided(rows).withColumn("text", F.lit(None).cast("string")).withColumn("is_text", F.lit(False))
    texts = rows.filter("digest IS NOT NULL").withColumn("is_text", F.lit(True)).withColumn("last", F.lit(False))
    both = edits.unionByName(texts, allowMissingColumns=True)
    return sorted_rows(both, "last", F.asc_nulls_first("turn"), "role", "digest", "is_text")


def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of merged rows: `(conv, turn, edit, role, text)` of each repaired turn, and `(conv, figures)` at the end of a conversation."""
    waiting: deque[str] = deque()
    for piece in pieces(batches):
        column = {name: piece.column(i) for i, name in enumerate(piece.schema.names)}
        texts = bytes_of(piece)
        names = ("conv", "turn", "role", "edit", "last", "is_text")
        for i, (conv, turn, role, edit, last, is_text) in enumerate(zip(*[column[c].to_pylist() for c in names], strict=True)):
            if not is_text and not last:
                waiting.append(edit)
                continue
            steps = edit if last else waiting.popleft()
            own = "" if last else steps[-1]
            for letter in steps[: len(steps) - len(own)]:
                yield conv, None, "I", ROLES[letter], b""
            if last:
                yield conv, [column[c][i].as_py() for c in FIGURES]
            elif own == "K":
                yield conv, turn, "K", role, texts[i]
            elif own != "D":
                yield conv, turn, "R", ROLES[own], texts[i]


FIGURES = [part.split()[0] for part in SUMMARY.split(", ")]


def repaired_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """`(conv, place, turn, role, text, edit)`: the turns of every conversation after its repair.

    Places count from 0; `edit` is K, R or I. Inserted turns have a null turn number and empty text.
    Rows are taken by turn, null turns first, equal turns by role and then by the digest of their text. Equal rows are
    duplicates. A null role or text counts as one blank, so the row is deleted or of another role; a null conversation is one like
    others. A conversation of which nothing is left has no rows; an empty table gives an empty one. Further columns are ignored.
    """
    rows = prepared(df, conv, turn, role, text, None)
    out = extended(rows.select("conv"), "place bigint, turn bigint, role string, text string, edit string")
    schema = arrow_schema(out)

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        place = 0
        for key, *rest in repaired(batches):
            if len(rest) == 1:
                place = 0
            else:
                number, edit, name, words = rest
                yield key, place, number, name, words.decode(), edit
                place += 1

    found = merged(rows).mapInArrow(lambda batches: in_batches(turns(batches), schema), out)
    return found.withColumnsRenamed({"conv": conv})


def repair_report(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", absent: str | None = None,
) -> DataFrame:
    """One row per conversation: `gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`.

    Faults are counted before the repair, the first fault of a row only. `gaps` are turn numbers that are
    missing between the least and the greatest. The digest is of the repaired `role:text` lines. `absent` may name a boolean column: such rows
    only name their conversation. Without other rows its figures are 0, its audit and its text empty.
    Odd input is treated as by `repaired_turns`.
    """
    rows = prepared(df, conv, turn, role, text, absent)
    out = extended(rows.select("conv"), SUMMARY + ", repaired_sha256 string")
    schema = arrow_schema(out)

    def reports(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        digest, parted = hashlib.sha256(), b""
        for key, *rest in repaired(batches):
            if len(rest) == 1:
                yield key, *rest[0], digest.hexdigest()
                digest, parted = hashlib.sha256(), b""
            else:
                _, _, name, words = rest
                digest.update(parted + name.encode() + b":")
                digest.update(words)
                parted = b"\n"

    found = merged(rows).mapInArrow(lambda batches: in_batches(reports(batches), schema), out)
    return found.withColumnsRenamed({"conv": conv})
