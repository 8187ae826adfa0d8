"""Conversation repair: edits against an exhaustive search, the whole operator against a plain version, odd rows."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from emisplit.llm import conversation_repair as repair
from emisplit.llm.common import SPACES

TURNS = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?")


def _cheapest(rows):
    """(cost, edits, repaired rows) of [(role, text, fault)] by a best-first search over edit sequences."""
    heap, done = [(0, "", 0, ())], set()
    while heap:
        cost, edits, at, out = heapq.heappop(heap)
        initials = "".join(r[:1] or "?" for r, _ in out)
        if at == len(rows) and GOOD.fullmatch(initials):
            return cost, edits, out
        if not any(GOOD.fullmatch(initials + rest) for rest in ("", "ua", "a")):
            continue
        # What follows depends on the rows left and on how the initials go on.
        state = (at, initials if len(initials) < 2 else initials[-1])
        if state in done:
            continue
        done.add(state)
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 2, edits + "I", at, (*out, (role, ""))))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 3, edits + "D", at + 1, out))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                heapq.heappush(heap, (cost + extra, edits + "K", at + 1, (*out, (role, text))))
                for other in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 2 + extra, edits + "R", at + 1, (*out, (other, text))))
    raise AssertionError


def _plain(turns):
    """What the query returns for damaged ``[(conv_id, turn, role, text)]`` per conversation that has rows."""
    out = {}
    for conv_id in {t[0] for t in turns}:
        own = sorted([t for t in turns if t[0] == conv_id], key=lambda t: (t[1] is not None, t[1] or 0, t[2].encode(), t[3].encode()))
        rows, seen = [], set()
        for _, _, role, text in own:
            shown = re.sub(f"[{SPACES}]", "", text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated"
            seen.add((role, text))
            rows.append((role, text, fault))
        known = [t[1] for t in own if t[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(rows, rows[1:])]
        cost, edits, kept = _cheapest(rows)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        faults = [sum(r[2] == f for r in rows) for f in ("blank", "duplicate", "truncated")]
        out[conv_id] = (gaps, *faults, sum(p not in ("su", "ua", "au") for p in pairs), cost, edits, digest)
    return out


def _code(role, fault):
    initial = "sua".find(role[:1]) if role[:1] else -1
    kind = {"": repair._FINE, "blank": repair._BLANK, "truncated": repair._CUT, "duplicate": repair._COPY}[fault]
    return (initial if initial >= 0 else 3) + kind


@pytest.mark.parametrize("every", [None, 1, 2, 5, 1000])
def test_edits_match_an_exhaustive_search(every):
    rng = random.Random(every or 0)
    for _ in range(400):
        n = rng.randrange(0, 9)
        rows = [(rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), "t", rng.choice(["", "", "", "blank", "truncated", "duplicate"])) for _ in range(n)]
        cost, edits, _ = _cheapest(rows)
        assert repair.cheapest_edits(bytes(_code(r, f) for r, _, f in rows), every) == (cost, edits), rows


def test_long_conversations_keep_few_vectors():
    rng = random.Random(3)
    codes = bytes(rng.choice([0, 1, 2, 3]) + rng.choice([0, 0, 4, 8, 12]) for _ in range(200_000))
    repair._turn.cache_clear()
    cost, edits = repair.cheapest_edits(codes)
    assert (cost, edits) == repair.cheapest_edits(codes, 64)
    assert sum(e != "I" for e in edits) == len(codes)
    assert repair._turn.cache_info().currsize < 2000


def _rows(spark, turns):
    return spark.createDataFrame(turns, TURNS)


def _repaired(spark, turns, ids=None):
    ids = _rows(spark, turns) if ids is None else spark.createDataFrame([(i,) for i in ids], "conv_id long")
    return {r["conv_id"]: tuple(r)[1:] for r in repair.repair(_rows(spark, turns), ids).collect()}


def _random_turns(seed, n=60):
    rng = random.Random(seed)
    out = []
    for conv in range(n):
        for turn in range(rng.randrange(0, 7)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "", "tool"])
            text = rng.choice(["Yes.", "No!  \n", "maybe", "", " \t", "é?", "a\nb.", "Yes.", "...x"])
            out.append((conv if conv else None, rng.choice([turn, turn, turn * 3, None, 2]), role, text))
    return out + out[:10]


def test_repair_matches_a_plain_version(spark):
    turns = _random_turns(1)
    want = _plain(turns)
    assert _repaired(spark, turns) == want
    rows = repair.ordered(_rows(spark, turns))
    reports = repair.report(rows, _rows(spark, turns))
    got = {}
    for r in repair.repaired_turns(rows, reports).orderBy("conv_id", "place").collect():
        got.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv_id, values in want.items():
        assert hashlib.sha256("\n".join(got.get(conv_id, [])).encode()).hexdigest() == values[-1]


def test_damage_follows_the_checksum(spark):
    turns = [(c, t, "assistant", "One. Two! Three? four") for c in range(40) for t in range(6)] + [(None, None, None, None), (3, None, None, "x.")]
    want = []
    for conv, turn, role, text in turns:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate:
            row = (conv, turn, "user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text)
            want += [row] * (2 if fate == 3 else 1)
    got = [tuple(r) for r in repair.damaged(_rows(spark, turns)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert len({r[3] for r in want}) > 3


def test_ids_without_turns_and_odd_rows(spark):
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert _repaired(spark, [], [7, None, 7]) == {7: nothing, None: nothing}
    assert _repaired(spark, []) == {}
    turns = [(1, None, None, None), (1, 5, "user", "x" * 100_000 + "."), (1, 5, "user", "x" * 100_000 + "."), (1, 2, "assistant", None)]
    filled = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in turns]
    assert _repaired(spark, turns) == _plain(filled)
    clashing = _rows(spark, turns).selectExpr("*", "1 as place", "2 as code", "'x' as audit", "map(1, 2) as copy1")
    got = repair.repair(clashing, clashing).collect()
    assert [tuple(r)[1:] for r in got] == [_plain(filled)[1]]


def test_a_conversation_over_many_batches(spark):
    rng = random.Random(5)
    turns = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "cut", f"{t}."])) for t in range(300)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = _repaired(spark, turns)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == _plain(turns)
