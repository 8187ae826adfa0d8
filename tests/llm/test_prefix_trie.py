"""Prefix tree of conversations: the trie alone, the whole operator against a plain version, odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from emisplit.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string"


def test_fattest_number_of_an_interval():
    for low in range(40):
        for high in range(low + 1, 60):
            want = max(range(low + 1, high + 1), key=lambda x: x & -x)
            assert prefix_trie.fattest(low, high) == want


def _path(conv_id, steps):
    """Digests that tell prefixes apart, as the operator's do."""
    keys = [(0, 0)] + [tuple(np.frombuffer(hashlib.md5(repr(steps[:d]).encode()).digest(), np.int64)) for d in range(1, len(steps) + 1)]
    return prefix_trie.Path(conv_id, np.array(keys, np.int64).reshape(-1, 2), np.ones(len(steps), np.int64), True)


@pytest.mark.parametrize("seed", range(6))
def test_trie_finds_exits_and_counts_prefixes(seed):
    rng = random.Random(seed)
    trie, texts = prefix_trie.ZFastTrie(), []
    for _ in range(8):
        batch = []
        for _ in range(rng.randrange(1, 60)):
            old = rng.choice(texts) if texts and rng.random() < 0.7 else ()
            text = (*old[: rng.randrange(len(old) + 1)], *[rng.randrange(3) for _ in range(rng.randrange(0, 40))])
            texts.append(text)
            batch.append(_path(len(texts) * 7 % 1000, list(text)))
        trie.insert(batch)
        # The exit of a path is the deepest branching or end that it passes, found without walking down.
        extents = {t[: n.high] for t in texts for n in [trie.locate(_path(0, list(t)))]}
        assert extents == {t for t in texts}
    for text in texts[:50]:
        longer = _path(0, [*text, 9, 9])
        node = trie.locate(longer)
        best = max(len(t) for t in texts if text[: len(t)] == t)
        assert node.high >= best and node.high <= len(text)
    want = defaultdict(list)
    for i, text in enumerate(texts):
        for d in range(1, len(text) + 1):
            want[_path(0, list(text[:d])).key(d)].append((i + 1) * 7 % 1000)
    got = {}
    for depths, digests, before, sizes, smallest, passed in trie.expanded():
        assert len(depths) == len(digests) == len(before) == len(sizes)
        for d in digests:
            assert d.tobytes() not in got
            got[d.tobytes()] = (smallest, passed)
    assert got == {k: (min(v), len(v)) for k, v in want.items()}


def _plain(rows):
    """What the query returns, from dictionaries of whole prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    built = {}
    for conv, turns in own.items():
        turns.sort()
        h = zlib.crc32(str(conv).encode()) % 9
        base = sorted(own.get(conv - int(np.fmod(conv, 5)), []))
        built[conv] = tuple(t[2:] for t in base[:h] + turns[h:])
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for conv, turns in built.items():
        ends[turns].append(conv)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
            if d:
                children[turns[: d - 1]].add(turns[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, convs in members.items():
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def _random_turns(seed, n=80):
    rng = random.Random(seed)
    stock = [[(rng.choice("us"), f"é{rng.randrange(4)}" * rng.randrange(3)) for _ in range(9)] for _ in range(3)]
    rows = []
    for conv in rng.sample(range(200), n):
        turns = rng.choice(stock)[: rng.randrange(1, 10)] + [(None, rng.choice(["x", "y", None]))] * rng.randrange(3)
        rows += [(conv, i if rng.random() < 0.9 else None, r, t) for i, (r, t) in enumerate(turns)]
    return rows


def _table(spark, rows):
    return spark.createDataFrame(rows, TURNS)


def _tree(spark, rows):
    return sorted([tuple(r) for r in prefix_trie.rebuilt_tree(_table(spark, rows)).collect()], key=repr)


def test_tree_matches_a_plain_version(spark):
    rows = _random_turns(2)
    got = _tree(spark, rows)
    assert got == _plain(rows)
    assert max(r[3] for r in got if r[1]) > 5


def test_tries_of_any_size_and_parts_of_any_length_give_the_same_tree(spark):
    rows = _random_turns(3, 40) + [(300 + c, t, "u", f"t{t}" if t < 40 + c else f"c{c}") for c in range(3) for t in range(70)]
    steps, ids = prefix_trie.rebuilt(prefix_trie.hashed_turns(_table(spark, rows)))
    want = _plain(rows)
    for segment, most in ((4, 10**6), (7, 30), (1 << 16, 1)):
        assert sorted([tuple(r) for r in prefix_trie.tree(steps, ids, segment, most).collect()], key=repr) == want


def test_odd_rows(spark):
    assert _tree(spark, []) == []
    assert _tree(spark, [(None, 1, "user", "x")]) == []
    rows = [(1, None, None, None), (1, None, None, None), (2, 0, "user", "x" * 50_000), (-3, 1, "a", ""), (-3, 1, "a", ""), (None, 2, "b", "c")]
    rows += [(10, 0, "u", "same"), (11, 0, "u", "same"), (12, 0, "u", "same")]
    assert _tree(spark, rows) == _plain(rows)
    clashing = _table(spark, rows).selectExpr("*", "1 as place", "2 as depth", "map(1, 2) as p1", "'x' as base")
    assert sorted([tuple(r) for r in prefix_trie.rebuilt_tree(clashing).collect()], key=repr) == _plain(rows)
