"""Repair of conversations whose turns are blank, repeated, cut off or out of order.

A conversation should read as an optional system turn followed by pairs of user and assistant
turns. The cheapest edits that make it so come from a dynamic programme over (turns done, role read
last). Its backward cost vectors are kept only at checkpoints, about a square root of the turns
apart; the walk forward works out one block's vectors again at a time and emits at every step the
ASCII-least edit that is still on a cheapest way.

Spark finds the faults, shuffles one byte per turn to the programme and merges the edits with the
texts afterwards. Both steps read a conversation as a stream of sorted rows; the programme's memory is a
byte per turn of the longest conversation and one block of vectors, whatever its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emisplit.llm.common import SPACES, stored
from emisplit.session import tune

REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1

#: Role read last: nothing yet, system, user, assistant. A conversation may end after nothing or an assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: State after a turn whose role starts with s, u, a or anything else, or None where it can't stand.
_NEXT = (
    (_SYSTEM, _USER, None, None),
    (None, _USER, None, None),
    (None, None, _ASSISTANT, None),
    (None, _USER, None, None),
)
#: The only state that a turn put in, or given another role, can lead to.
_GIVEN = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
#: A turn's byte is its role initial (0-3) plus its first fault.
_FINE, _BLANK, _CUT, _COPY = 0, 4, 8, 12
#: Cost of ending in each state: an assistant's turn, or a user's one too, must be put in first.
_END = (0, 2 * INSERT, INSERT, 0)


@cache
def _turn(code: int, after: tuple[int, ...]) -> tuple[tuple[int, ...], int, tuple[tuple[str, int], ...]]:
    """One turn, given the costs ``after`` it: (costs before it less the smallest, that one, moves per state).

    A move is the edits up to and with the turn's own, and the state they lead to. Costs are
    differences of a few units, so few different turns exist and each is worked out once.
    """
    initial, fault = code & 3, code & 12
    ways: list[list[tuple[str, int, int]]] = []
    for state in range(4):
        own = [("D", DELETE + after[state], state)]
        if fault in (_FINE, _CUT):
            extra = CUT_OFF if fault == _CUT else 0
            to = _NEXT[state][initial]
            if to is not None:
                own.append(("K", extra + after[to], to))
            own.append(("R", extra + REROLE + after[_GIVEN[state]], _GIVEN[state]))
        ways.append(own)
    costs = [min(c for _, c, _ in own) for own in ways]
    costs = [min(c, INSERT + costs[_GIVEN[s]], 2 * INSERT + costs[_GIVEN[_GIVEN[s]]]) for s, c in enumerate(costs)]
    moves = []
    for state in range(4):
        edits, at, edit = "", state, "I"
        while edit == "I":
            put_in = ("I", INSERT + costs[_GIVEN[at]], _GIVEN[at])
            edit, _, to = min(w for w in [*ways[at], put_in] if w[1] == costs[at])
            edits, at = edits + edit, to
        moves.append((edits, at))
    least = min(costs)
    return tuple(c - least for c in costs), least, tuple(moves)


def cheapest_edits(codes: bytes, every: int | None = None) -> tuple[int, str]:
    """(cost, edits) of the turns ``codes``: D, I, K, R for delete, insert, keep, other role.

    Of the cheapest edits the ASCII-least. Vectors are kept every ``every`` turns, by default about a
    square root of their number apart.
    """
    n = len(codes)
    every = every or max(16, int(n**0.5))
    kept, costs, total = {n: _END}, _END, 0
    for i in range(n - 1, -1, -1):
        costs, least, _ = _turn(codes[i], costs)
        total += least
        if i % every == 0:
            kept[i] = costs
    total += costs[_START]
    state, edits = _START, []
    for first in range(0, n, every):
        last = min(first + every, n)
        after, moves = kept[last], []
        for i in range(last - 1, first - 1, -1):
            after, _, move = _turn(codes[i], after)
            moves.append(move)
        block = []
        for move in reversed(moves):
            edit, state = move[state]
            block.append(edit)
        edits.append("".join(block))
    while state not in (_START, _ASSISTANT):
        edits.append("I")
        state = _GIVEN[state]
    return total, "".join(edits)


# ---------------------------------------------------------------- faults


def ordered(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with ``place``, ``code`` and two hashes of role and text.

    ``place`` counts a conversation's rows from 1 on by turn (NULL first), then role, then text. ``code`` doesn't know of
    copies yet. The rows are stored.
    """
    by_turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    initial = F.array_position(F.array(F.lit("s"), F.lit("u"), F.lit("a")), F.substring("role", 1, 1))
    fault = (
        F.when(~F.col("text").rlike(rf"[^{SPACES}]"), _BLANK)
        .when(F.col("text").rlike(rf"[.!?][{SPACES}]*\z"), _FINE)
        .otherwise(_CUT)
    )
    code = F.when(initial > 0, initial - 1).otherwise(3) + fault
    rows = turns.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.row_number().over(by_turn).cast("long").alias("place"),
        code.cast("int").alias("code"),
        F.xxhash64("role", "text").alias("copy1"),
        F.xxhash64(F.lit(1), "role", "text").alias("copy2"),
    )
    return stored(rows, "turns")


def _coded(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``conv_id, place, turn, code`` sorted by conversation within tasks, each led by a row without code."""
    earlier = F.row_number().over(Window.partitionBy("conv_id", "copy1", "copy2").orderBy("place")) > 1
    fault = F.col("code").bitwiseAND(12)
    code = F.when(earlier & (fault != _BLANK), F.col("code").bitwiseAND(3) + _COPY).otherwise(F.col("code"))
    coded = rows.select("conv_id", "place", "turn", code.alias("code"))
    every = ids.select("conv_id").distinct().select("conv_id", F.lit(0).cast("long"), F.lit(None).cast("long"), F.lit(-1))
    return _by_conversation(every.toDF(*coded.columns).union(coded))


def _by_conversation(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "place")


_REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_REPORT_ARROW = pa.schema([(n, pa.string() if n == "audit" else pa.int64()) for n in [f.split()[0] for f in _REPORT.split(", ")]])
_LEGAL = np.zeros(16, bool)
_LEGAL[[0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1]] = True  # su, ua, au


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int | None, int, int]]:
    """(conversation, first row, row after its last) of each run of equal ids in a batch."""
    column = batch.column("conv_id")
    empty = column.is_null().to_numpy(zero_copy_only=False)
    ids = column.fill_null(0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((ids[1:] != ids[:-1]) | (empty[1:] != empty[:-1])) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for first, last in zip(edges, edges[1:]):
        if last > first:
            yield None if empty[first] else int(ids[first]), first, last


class _Faults:
    """What the report says of one conversation, fed piece by piece: a byte a turn, and counts."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.codes = conv_id, bytearray()
        self.low = self.high = None
        self.distinct = self.illegal = 0

    def feed(self, codes: np.ndarray, turns: pa.Array) -> None:
        roles = codes & 3
        if self.codes and len(roles):
            roles = np.concatenate([[self.codes[-1] & 3], roles])
        self.illegal += int((~_LEGAL[roles[:-1] * 4 + roles[1:]]).sum()) if len(roles) > 1 else 0
        self.codes += codes.astype(np.uint8).tobytes()
        known = turns.drop_null().to_numpy(zero_copy_only=False)
        if len(known):
            self.distinct += int((known[1:] != known[:-1]).sum()) + (self.high is None or int(known[0]) != self.high)
            self.low = int(known[0]) if self.low is None else self.low
            self.high = int(known[-1])

    def row(self) -> tuple:
        cost, audit = cheapest_edits(bytes(self.codes))
        counts = np.bincount(np.frombuffer(self.codes, np.uint8) >> 2, minlength=4)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv_id, gaps, int(counts[1]), int(counts[3]), int(counts[2]), self.illegal, cost, audit)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[tuple] = []
    now: _Faults | None = None

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done)) or [()] * len(_REPORT_ARROW)
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _REPORT_ARROW)], schema=_REPORT_ARROW)

    for batch in batches:
        codes = batch.column("code").to_numpy(zero_copy_only=False)
        for conv_id, first, last in _pieces(batch):
            if codes[first] < 0:  # a conversation begins
                if now is not None:
                    done.append(now.row())
                now = _Faults(conv_id)
                first += 1
            now.feed(codes[first:last], batch.column("turn").slice(first, last - first))
        yield flush()
    if now is not None:
        done.append(now.row())
    yield flush()


def report(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``ids``: its faults in ``ordered`` rows, cheapest cost and edits. Stored."""
    return stored(_coded(rows, ids).mapInArrow(_report, _REPORT), "edits")


# ---------------------------------------------------------------- repair


def _with_edits(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Texts of each conversation in order, led by a row that has its report."""
    texts = rows.select("conv_id", "place", "role", "text")
    led = reports.withColumn("place", F.lit(0).cast("long"))
    return _by_conversation(led.unionByName(texts, allowMissingColumns=True))


class _Edits:
    """Applies a conversation's edits to its turns as they come by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, _START

    def _put_in(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at, self.state = self.at + 1, _GIVEN[self.state]
            yield _ROLE[self.state], ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._put_in()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.state = _NEXT[self.state]["sua".find(role[:1])]
            yield role, text
        elif edit == "R":
            self.state = _GIVEN[self.state]
            yield _ROLE[self.state], text

    def end(self) -> Iterator[tuple[str, str]]:
        return self._put_in()


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict | None, Iterator[tuple[str, str]]]]:
    """(report of a conversation that begins or None, repaired turns that come next)."""
    edits = _Edits("")
    for batch in batches:
        names = _REPORT_ARROW.names
        audits, roles, texts = (batch.column(batch.schema.get_field_index(n)) for n in ("audit", "role", "text"))
        leads = audits.is_valid().to_numpy(zero_copy_only=False)
        for i in range(batch.num_rows):
            if leads[i]:
                yield None, edits.end()
                begun = {n: batch.column(batch.schema.get_field_index(n))[i].as_py() for n in names}
                edits = _Edits(begun["audit"])
                yield begun, iter(())
            else:
                yield None, edits.turn(roles[i].as_py(), texts[i].as_py())
    yield None, edits.end()


_DIGEST = _REPORT + ", repaired_sha256 string"
_DIGEST_ARROW = _REPORT_ARROW.append(pa.field("repaired_sha256", pa.string()))
_TURNS = "conv_id long, place long, role string, text string"
_TURNS_ARROW = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
#: Rows and bytes after which a batch of results goes out.
_ROWS, _BYTES = 4096, 1 << 24


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[dict] = []
    now, digest, between = None, hashlib.sha256(), b""
    for begun, turns in _walk(batches):
        for role, text in turns:
            digest.update(between + f"{role}:{text}".encode())
            between = b"\n"
        if begun is not None:
            if now is not None:
                done.append(now | {"repaired_sha256": digest.hexdigest()})
            now, digest, between = begun, hashlib.sha256(), b""
            if len(done) >= _ROWS:
                yield pa.RecordBatch.from_pylist(done, _DIGEST_ARROW)
                done = []
    if now is not None:
        done.append(now | {"repaired_sha256": digest.hexdigest()})
    yield pa.RecordBatch.from_pylist(done, _DIGEST_ARROW)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[tuple] = []
    conv_id, place, size = None, 0, 0

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done)) or [()] * len(_TURNS_ARROW)
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TURNS_ARROW)], schema=_TURNS_ARROW)

    for begun, turns in _walk(batches):
        for role, text in turns:
            place += 1
            size += len(text)
            done.append((conv_id, place, role, text))
        if begun is not None:
            conv_id, place = begun["conv_id"], 0
        if len(done) >= _ROWS or size >= _BYTES:
            yield flush()
            size = 0
    yield flush()


def repaired_turns(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """``conv_id, place, role, text`` of every repaired conversation of ``ordered`` rows."""
    return _with_edits(rows, reports).mapInArrow(_turns, _TURNS)


def digests(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The reports plus ``repaired_sha256``: SHA-256 of the repaired ``role:text`` lines joined by LF.

    A digest runs over a conversation from its first byte to its last, so one task reads all of it, as a stream.
    """
    return _with_edits(rows, reports).mapInArrow(_digests, _DIGEST)


# ---------------------------------------------------------------- damage


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with planted faults, by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its closing marks, 3 repeats it, 4 makes it a
    user's. A NULL role or text is one blank, as is a NULL id or turn in the text that is hashed.
    """
    shown = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn"))) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    role = F.when(fate == 4, "user").otherwise(shown("role"))
    rows = turns.where(fate != 0)
    copy = F.explode(F.sequence(F.lit(1), F.when(fate == 3, 2).otherwise(1)))
    columns = [F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn")]
    return rows.select(*columns, role.alias("role"), text.alias("text"), copy.alias("copy")).drop("copy")


def repair(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of each ``conv_id`` of ``ids``.

    ``turns`` are conversation rows. Faults are judged in the order of ``turn`` (NULL first), then role, then
    text; each row's first one counts. Repeated rows are rows: all but the first are duplicates. NULL roles and texts
    count as one blank (so the text is blank), rows with a NULL id are a conversation of their own, and an
    id without turns, or an empty table, has nothing to repair: zeros, no edits, the digest of no text. A role
    that starts with none of s, u and a can't stand. Equal role and text are taken by two 64-bit hashes. Extra columns are
    not looked at.
    """
    tune(turns.sparkSession)
    filled = [F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = ordered(turns.select(*[F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")], *filled))
    ids = ids.select(F.col("conv_id").cast("long").alias("conv_id"))
    return digests(rows, report(rows, ids))
