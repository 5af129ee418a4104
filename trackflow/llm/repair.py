"""Repair of the structure of conversations: the cheapest edits to ``(s?(ua)+)?``.

The initials of the roles must be one system turn at most, then user and assistant in turns. A
row is kept (``K``, 0), given the role that fits (``R``, 2) or deleted (``D``, 3); empty user or
assistant turns are inserted (``I``, 2). Blank and repeated rows must be deleted; a truncated row
that stays adds 1. Of the cheapest edits those whose initials come first in ASCII are taken.

The edits are found by iterative deepening A*: a depth-first search tries ``D I K R`` in this
order under a bound on cost plus a lower bound of the rest, and the bound grows to the least
value that was cut off. What failed leaves its better lower bound in a table of states, so no
state is searched again in vain. The first accepted path is the answer.

A conversation may hold any share of the rows. Its rows, without their texts, are dealt by ranges
of (conversation, turn, role, text), so a long one lies over many tasks. Each task cuts the
rows of a conversation into pieces of ``PIECE`` and searches every way through a piece, from each
state to each state; ways through neighbours join to ways through both. Two ways through the same
rows at equal cost never are one the start of the other, so least ways join to least ways. Then
one task follows the edits of a conversation along its texts, row by row, to hash or write
them: a running hash needs this, but no text is held longer than its batch.

Defined results. A null role or text is one space; a null conversation is one; null turns come
first. Rows of equal turn are ordered by role, then by the hash of their text; equal rows are
neighbours. An empty table gives no rows. A conversation without rows has no edits. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from math import inf

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 48

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

BLANK = r"^[\x20\x09-\x0D]*$"
CUT_OFF = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*$"

# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FITTING = (USER, USER, ASSISTANT, USER)  # the state that an inserted or rerolled turn leads to
KEPT = {(NOTHING, "s"): SYSTEM} | {
    (state, "ua"[FITTING[state] - USER]): FITTING[state] for state in range(4)
}
WAYS = [(a, b) for a in range(4) for b in range(4) if a == b or b >= USER or (a, b) == (0, 1)]
ACCEPTED = (NOTHING, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}


@lru_cache(maxsize=20_000)
def least_edits(rows: str, begin: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and initials of the cheapest edits of a piece from a state to one of some states.

    ``rows`` has two letters a row: the initial of its role, then ``k`` (may stay), ``t``
    (truncated) or ``d`` (must go).
    """
    n = len(rows) // 2
    rest = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        kind = rows[2 * i + 1]
        rest[i] = rest[i + 1] + (DELETE if kind == "d" else TRUNCATED if kind == "t" else 0)
    bound_of: dict[tuple[int, int], float] = {}  # lower bounds that a failed search has proved
    turns = max(ends) >= USER  # after a user or assistant turn no other state comes again

    def steps(i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        if i < n:
            yield "D", DELETE, i + 1, state
        if turns:
            yield "I", INSERT, i, FITTING[state]
        if i < n and rows[2 * i + 1] != "d":
            extra = TRUNCATED if rows[2 * i + 1] == "t" else 0
            kept = KEPT.get((state, rows[2 * i]))
            if kept is not None and (turns or kept <= max(ends)):
                yield "K", extra, i + 1, kept
            if turns:
                yield "R", REROLE + extra, i + 1, FITTING[state]

    def search(i: int, state: int, left: float) -> str | None:
        if i == n and state in ends:
            return ""
        least = inf
        for edit, cost, j, after in steps(i, state):
            if cost + bound_of.get((j, after), rest[j]) <= left:
                found = search(j, after, left - cost)
                if found is not None:
                    return edit + found
            least = min(least, cost + bound_of.get((j, after), rest[j]))
        bound_of[i, state] = max(least, bound_of.get((i, state), rest[i]))
        return None

    bound: float = rest[0]
    while bound < inf:
        path = search(0, begin, bound)
        if path is not None:
            return int(bound), path
        bound = bound_of[0, begin]
    return None


Ways = dict[tuple[int, int], tuple[int, str]]


def ways_through(rows: str) -> Ways:
    """The cheapest edits of a piece for each state before and each state after it."""
    found = {(a, b): least_edits(rows, a, (b,)) for a, b in WAYS}
    return {way: edits for way, edits in found.items() if edits is not None}


def joined(first: Ways, second: Ways) -> Ways:
    """The cheapest edits of two neighbours."""
    out: Ways = {}
    for (a, b), (cost, edits) in first.items():
        for (c, d), (more, others) in second.items():
            if b == c:
                total = cost + more
                if (a, d) not in out or out[a, d][0] >= total:
                    both = (total, edits + others)
                    out[a, d] = min(out.get((a, d), both), both)
    return out


def all_joined(parts: list[Ways]) -> Ways:
    """Neighbours joined two by two, so that long edits are copied seldom."""
    while len(parts) > 1:
        pairs = [joined(*parts[i : i + 2]) for i in range(0, len(parts) - 1, 2)]
        parts = pairs + parts[len(pairs) * 2 :]
    return parts[0] if parts else {(state, state): (0, "") for state in range(4)}


def accepted(ways: Ways) -> tuple[int, str]:
    """The cheapest edits of a whole conversation."""
    return min(ways[NOTHING, end] for end in ACCEPTED if (NOTHING, end) in ways)


def illegal_pairs(initials: str) -> int:
    return sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


def conversation_key(conv: Column) -> Column:
    """A text without nulls for each conversation."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def rows_of(turns: DataFrame, gone: Column | None = None) -> DataFrame:
    """``conv, key, turn, role, text, hash, gone``; ``gone`` rows only name their conversation."""
    space = F.lit(" ")
    named = turns.select(
        F.col("conv_id").alias("conv"),
        conversation_key(F.col("conv_id")).alias("key"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.lit(False) if gone is None else gone).alias("gone"),
    )
    return named.withColumn("hash", F.sha2("text", 256))


def faults(rows: DataFrame) -> DataFrame:
    """Equal rows as one: ``key, turn, role, hash``, ``copies``, ``fault`` and ``first``.

    ``fault`` is ``blank``, ``truncated`` or null; ``first`` tells that the first of the copies
    is the first of its role and text in the conversation. The others are repeated.
    """
    present = rows.where("NOT gone")
    fault = F.when(F.col("text").rlike(BLANK), "blank").when(
        F.col("text").rlike(CUT_OFF), "truncated"
    )
    groups = (
        present.select("key", "turn", "role", "hash", fault.alias("fault"))
        .groupBy("key", "turn", "role", "hash")
        .agg(F.count("*").alias("copies"), F.first("fault").alias("fault"))
    )
    # Null turns come first, so a text seen without a turn is seen there first.
    seen = groups.groupBy("key", "role", "hash").agg(
        F.min("turn").alias("seen_turn"), F.bool_or(F.col("turn").isNull()).alias("seen_null")
    )
    first = F.when(F.col("seen_null"), F.col("turn").isNull()).otherwise(
        F.col("turn") == F.col("seen_turn")
    )
    return groups.join(seen, ["key", "role", "hash"]).select(
        "key", "turn", "role", "hash", "copies", "fault", first.alias("first")
    )


RUN = (
    "key string, part int, blank long, duplicate long, truncated long, illegal long,"
    " first_initial string, last_initial string, low long, high long, turns long,"
    " ways array<struct<begin: int, end: int, cost: long, edits: string>>"
)


class _Run:
    """The rows of one conversation that lie in one task."""

    def __init__(self, key: str):
        self.key = key
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.turns = 0, 0
        self.first = self.last = self.low = self.high = None
        self.parts: list[Ways] = []
        self.open = ""

    def _initials(self, initial: str, copies: int) -> None:
        if self.last is None:
            self.first = initial
        else:
            self.illegal += illegal_pairs(self.last + initial)
        self.illegal += (copies - 1) * illegal_pairs(initial * 2)
        self.last = initial

    def _rows(self, letters: str, count: int) -> None:
        while count:
            taken = min(count, PIECE - len(self.open) // 2)
            self.open += letters * taken
            count -= taken
            if len(self.open) == 2 * PIECE:
                self.parts.append(ways_through(self.open))
                self.open = ""

    def add(self, turn: int | None, role: str, copies: int, fault: str | None, first: bool) -> None:
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        initial = role[:1] or "-"
        self._initials(initial, copies)
        letter = initial if initial in "sua" else "-"
        if fault == "blank":
            self.counts["blank"] += copies
            self._rows(letter + "d", copies)
            return
        if first:
            self.counts["truncated"] += fault == "truncated"
            self._rows(letter + ("t" if fault == "truncated" else "k"), 1)
        self.counts["duplicate"] += copies - first
        self._rows(letter + "d", copies - first)

    def row(self, part: int, whole: bool) -> dict:
        if whole and not self.parts:  # all of the conversation: one search is enough
            cost, edits = least_edits(self.open, NOTHING, ACCEPTED)
            state = NOTHING if edits.count("D") == len(edits) else ASSISTANT
            ways: Ways = {(NOTHING, state): (cost, edits)}
        else:
            ways = all_joined(self.parts + ([ways_through(self.open)] if self.open else []))
        return {
            "key": self.key, "part": part, **self.counts, "illegal": self.illegal,
            "first_initial": self.first, "last_initial": self.last,
            "low": self.low, "high": self.high, "turns": self.turns,
            "ways": [
                {"begin": a, "end": b, "cost": cost, "edits": edits}
                for (a, b), (cost, edits) in ways.items()
            ],
        }


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def runs(found: DataFrame) -> DataFrame:
    """For each conversation and task: counts, and the cheapest edits for each way through."""
    by = ["key", "turn", "role", "hash"]
    sorted_rows = found.repartitionByRange(*by).sortWithinPartitions(*by)
    numbered = sorted_rows.select(
        F.spark_partition_id().alias("part"), "key", "turn", "role", "copies", "fault", "first"
    )
    schema = _arrow(RUN)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: _Run | None = None
        inner, part, out = False, 0, []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                part = row[0]
                if run is None or run.key != row[1]:
                    if run is not None:
                        out.append(run.row(part, whole=inner))
                        inner = True
                    run = _Run(row[1])
                run.add(*row[2:])
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if run is not None:  # the first and the last one may go on in other tasks
            out.append(run.row(part, whole=False))
            yield pa.RecordBatch.from_pylist(out, schema)

    return numbered.mapInArrow(search, RUN)


REPORT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
    " audit string, repaired_sha256 string"
)
TURNS = "place long, edit string, role string, text string"


class _Told:
    """Runs of one conversation put together."""

    def __init__(self, runs: list[dict]):
        self.counts = {
            name: sum(run[name] for run in runs) for name in ("blank", "duplicate", "truncated")
        }
        self.illegal = sum(run["illegal"] for run in runs)
        for a, b in zip(runs, runs[1:]):
            self.illegal += illegal_pairs(a["last_initial"] + b["first_initial"])
        timed = [run for run in runs if run["low"] is not None]
        turns = sum(run["turns"] for run in timed)
        turns -= sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
        self.gaps = timed[-1]["high"] - timed[0]["low"] + 1 - turns if timed else 0
        ways = [
            {(w["begin"], w["end"]): (w["cost"], w["edits"]) for w in run["ways"]} for run in runs
        ]
        self.cost, self.audit = accepted(all_joined(ways))


class _Edited:
    """The edits of one conversation, followed along its rows."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, NOTHING

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = FITTING[self.state]
            yield "I", ROLES[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """What comes out when a row goes in; inserted turns before it first."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEPT[self.state, role[:1]]
            yield edit, role, text
        elif edit == "R":
            self.state = FITTING[self.state]
            yield edit, ROLES[self.state], text


def _followed(turns: DataFrame, gone: Column | None, schema: str, follower) -> DataFrame:
    """Each conversation's runs, then its rows in order, given to a follower of edits."""
    rows = rows_of(turns, gone)
    conv_type = rows.schema["conv"].dataType.simpleString()
    found = runs(faults(rows))
    run_type = found.select(F.struct(*found.columns).alias("run")).schema["run"].dataType
    no_run = F.lit(None).cast(run_type)
    texts = rows.select(
        "key",
        F.when(F.col("gone"), 2).otherwise(1).alias("kind"),
        F.lit(0).alias("part"),
        *(F.when(~F.col("gone"), F.col(name)).alias(name) for name in ("turn", "role", "hash")),
        F.when(~F.col("gone"), F.col("text")).alias("text"),
        "conv",
        no_run.alias("run"),
    )
    told = found.select(
        "key",
        F.lit(0).alias("kind"),
        "part",
        F.lit(None).cast("long").alias("turn"),
        *(F.lit(None).cast("string").alias(name) for name in ("role", "hash", "text")),
        F.lit(None).cast(conv_type).alias("conv"),
        F.struct(*found.columns).alias("run"),
    )
    by = ["key", "kind", "part", "turn", "role", "hash"]
    both = texts.unionByName(told).repartition("key").sortWithinPartitions(*by)
    full = f"conv_id {conv_type}, {schema}"
    arrow = _arrow(full)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in _chunks(_stream(batches), follower):
            yield pa.RecordBatch.from_pylist(out, arrow)

    columns = ("key", "kind", "conv", "role", "text", "run")
    return both.select(*columns).mapInArrow(follow, full)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(column[i].as_py() for column in batch.columns)


def _chunks(rows: Iterator[tuple], follower) -> Iterator[list[dict]]:
    out, size = [], 0
    for _, conversation in groupby(rows, key=lambda row: row[0]):
        for row in follower(conversation):
            out.append(row)
            size += len(row.get("text") or "") + len(row.get("audit") or "")
            if len(out) >= 1000 or size > 4_000_000:
                yield out
                out, size = [], 0
    if out:
        yield out


def _begun(conversation: Iterator[tuple]) -> tuple[_Told, Iterator[tuple]]:
    """What the runs tell, and the rows that follow them."""
    told: list[dict] = []
    for row in conversation:
        if row[1] != 0:
            return _Told(told), _after(row, conversation)
        told.append(row[5])
    raise ValueError("a conversation without rows")


def _after(row: tuple, rest: Iterator[tuple]) -> Iterator[tuple]:
    yield row
    yield from rest


def _reported(conversation: Iterator[tuple]) -> Iterator[dict]:
    told, rows = _begun(conversation)
    edited, text, begun, conv = _Edited(told.audit), hashlib.sha256(), False, None

    def write(turns: Iterator[tuple[str, str, str]]) -> None:
        nonlocal begun
        for _, role, words in turns:
            text.update(f"{chr(10) if begun else ''}{role}:{words}".encode())
            begun = True

    for _, kind, conv, role, words, _ in rows:
        if kind == 1:
            write(edited.row(role, words))
    write(edited.inserted())
    yield {
        "conv_id": conv, "gaps": told.gaps, **told.counts, "illegal": told.illegal,
        "cost": told.cost, "audit": told.audit, "repaired_sha256": text.hexdigest(),
    }


def _repaired(conversation: Iterator[tuple]) -> Iterator[dict]:
    told, rows = _begun(conversation)
    edited, place, conv = _Edited(told.audit), 0, None

    def out(turns: Iterator[tuple[str, str, str]]) -> Iterator[dict]:
        nonlocal place
        for edit, role, words in turns:
            yield {"conv_id": conv, "place": place, "edit": edit, "role": role, "text": words}
            place += 1

    for _, kind, conv, role, words, _ in rows:
        if kind == 1:
            yield from out(edited.row(role, words))
    yield from out(edited.inserted())


def repair_report(turns: DataFrame, gone: Column | None = None) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits and the hash of what they give.

    ``gone`` marks rows that only name their conversation.
    """
    return _followed(turns, gone, REPORT, _reported)


def repaired_turns(turns: DataFrame, gone: Column | None = None) -> DataFrame:
    """The turns after repair, in ``place`` order, each with the edit that let it in."""
    return _followed(turns, gone, TURNS, _repaired)


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``: rows damaged by the check sum of their place."""
    space = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    damage = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), space)
    role = F.coalesce(F.col("role").cast("string"), space)
    changed = (
        F.when(damage == 1, F.lit(""))
        .when(damage == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
    )
    copies = F.when(damage == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.select(
        "conv_id",
        "turn",
        F.when(damage == 4, F.lit("user")).otherwise(role).alias("role"),
        changed.alias("text"),
        (damage == 0).alias("gone"),
        F.explode(copies).alias("copy"),
    ).drop("copy")
