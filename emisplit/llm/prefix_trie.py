"""Prefix trie of conversations: z-fast tries in the tasks, merged by prefix digest.

A turn is known by two 64-bit hashes, a prefix by the exclusive or of its turns' hashes taken
with their depths, 128 bits in all, so that a running aggregate gives the digests of all prefixes and no
text goes further. Each task builds compacted tries over its conversations. A node's handle, the
digest of its path at the two-fattest depth of its edge, leads to it in a hash table, and a fat binary search over
handles finds where a conversation leaves the trie in logarithmically many probes. Batches of
conversations are located together and put in one after the other from there. A trie of bounded size is
expanded edge by edge and handed to Spark, where equal prefixes of all tasks meet by digest.

Subtree totals follow from pointer doubling: every round adds to each node what hangs twice as
far below it, so a trie of depth d takes log d rounds, each a join and an aggregate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emisplit.llm.common import forget, stored
from emisplit.session import tune

#: Turns in the tries of a task before they are expanded.
TRIE_TURNS = 1 << 19
#: Conversations located together.
BATCH = 1024
#: A longer conversation is cut into parts of so many turns, each in a trie that starts at its depth.
SEGMENT = 1 << 16


def fattest(low: int, high: int) -> int:
    """The number in (low, high] that is divisible by the largest power of two."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class Path:
    """Digests of a conversation's prefixes from some depth on; row 0 of ``digests`` is the prefix before."""

    __slots__ = ("conv_id", "digests", "keys", "sizes", "ends")

    def __init__(self, conv_id: int, digests: np.ndarray, sizes: np.ndarray, ends: bool):
        self.conv_id, self.digests, self.sizes, self.ends = conv_id, digests, sizes, ends
        self.keys = digests.tobytes()

    def __len__(self) -> int:
        return len(self.sizes)

    def key(self, depth: int) -> bytes:
        return self.keys[16 * depth : 16 * depth + 16]


class Node:
    """An edge (low, high] of ``path`` and what hangs below; ``passed`` and ``smallest`` are of conversations that stop here."""

    __slots__ = ("path", "low", "high", "kids", "passed", "smallest")

    def __init__(self, path: Path | None, low: int, high: int):
        self.path, self.low, self.high = path, low, high
        self.kids: dict[bytes, Node] = {}
        self.passed, self.smallest = 0, None

    def stop(self, conv_id: int) -> None:
        self.passed += 1
        self.smallest = conv_id if self.smallest is None else min(self.smallest, conv_id)


class ZFastTrie:
    def __init__(self) -> None:
        self.root = Node(None, 0, 0)
        self.handles: dict[bytes, Node] = {}
        self.turns = 0

    def locate(self, path: Path, start: Node | None = None) -> Node:
        """The deepest node all of whose path ``path`` begins with, by fat binary search below ``start``."""
        node = start or self.root
        low, high = node.high, len(path)
        while low < high:
            depth = fattest(low, high)
            found = self.handles.get(path.key(depth))
            if found is not None and found.high <= len(path) and found.path.key(found.high) == path.key(found.high):
                node, low = found, found.high
            else:
                high = depth - 1
        return node

    def insert(self, batch: list[Path]) -> None:
        """Put in paths: all exits are located first, later ones go on from there through what the batch added."""
        for path, exit_node in zip(batch, [self.locate(path) for path in batch]):
            self._put(path, self.locate(path, exit_node))
            self.turns += len(path)

    def _put(self, path: Path, node: Node) -> None:
        if len(path) > node.high:
            first = path.key(node.high + 1)
            child = node.kids.get(first)
            if child is not None:
                upper = node.kids[first] = self._split(child, self._common(path, child))
                node = upper
        if len(path) > node.high:
            leaf = self._linked(Node(path, node.high, len(path)))
            node.kids[path.key(node.high + 1)] = leaf
            node = leaf
        node.stop(path.conv_id)

    def _common(self, path: Path, child: Node) -> int:
        """Depth to which ``path`` follows the edge of ``child``; its first step is known to agree."""
        low, high = child.low + 1, min(child.high, len(path))
        while low < high:
            middle = (low + high + 1) // 2
            if path.key(middle) == child.path.key(middle):
                low = middle
            else:
                high = middle - 1
        return low

    def _linked(self, node: Node) -> Node:
        self.handles[node.path.key(fattest(node.low, node.high))] = node
        return node

    def _split(self, child: Node, depth: int) -> Node:
        """Cut the edge of ``child`` at ``depth``; the upper part is returned."""
        upper = Node(child.path, child.low, depth)
        child.low = depth
        upper.kids[child.path.key(depth + 1)] = child
        self._linked(child)
        return self._linked(upper)

    def expanded(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int, int]]:
        """Per edge: depths, digests, digests one turn before, bytes of the turns, smallest conversation, conversations."""
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            order.append(node)
            stack.extend(node.kids.values())
        for node in reversed(order):
            for kid in node.kids.values():
                node.passed += kid.passed
                node.smallest = kid.smallest if node.smallest is None else min(node.smallest, kid.smallest)
        for node in order:
            if node.path is not None:
                a, b, path = node.low, node.high, node.path
                yield np.arange(a + 1, b + 1), path.digests[a + 1 : b + 1], path.digests[a:b], path.sizes[a:b], node.smallest, node.passed


# ---------------------------------------------------------------- prefixes of all conversations


_PARTS = "depth long, p1 long, p2 long, q1 long, q2 long, size long, conv_id long, n long"
_PARTS_ARROW = pa.schema([(f.split()[0], pa.int64()) for f in _PARTS.split(", ")])
_ROWS = 1 << 16


class _Forest:
    """Tries of a task, one for each part of long conversations."""

    def __init__(self, segment: int, most: int):
        self.segment, self.most = segment, most
        self.clear()

    def clear(self) -> None:
        self.tries: dict[int, ZFastTrie] = {}
        self.waiting: dict[int, list[Path]] = {}
        self.ends: list[tuple[int, int, int, int]] = []
        self.turns = 0

    def add(self, part: int, path: Path) -> Iterator[pa.RecordBatch]:
        batch = self.waiting.setdefault(part, [])
        batch.append(path)
        self.turns += len(path) + 8
        if path.ends:
            last = path.digests[-1]
            self.ends.append((part * self.segment + len(path), int(last[0]), int(last[1]), path.conv_id))
        if len(batch) >= BATCH:
            self.tries.setdefault(part, ZFastTrie()).insert(batch)
            self.waiting[part] = []
        if self.turns >= self.most:
            yield from self.expand()

    def expand(self) -> Iterator[pa.RecordBatch]:
        for part, batch in self.waiting.items():
            self.tries.setdefault(part, ZFastTrie()).insert(batch)
        edges = [(part * self.segment, edge) for part, trie in self.tries.items() for edge in trie.expanded()]
        columns: list[np.ndarray] = []
        if edges:
            long = [len(e[0]) for _, e in edges]
            stack = lambda i: np.concatenate([e[i] for _, e in edges])
            repeat = lambda values: np.repeat(np.array(values, np.int64), long)
            digests, before = stack(1), stack(2)
            columns = [stack(0) + repeat([at for at, _ in edges]), digests[:, 0], digests[:, 1], before[:, 0], before[:, 1], stack(3)]
            columns += [repeat([e[4] for _, e in edges]), repeat([e[5] for _, e in edges])]
            yield from _cut(columns)
        if self.ends:
            depth, p1, p2, conv = (np.array(c, np.int64) for c in zip(*self.ends))
            none = np.zeros(len(depth), np.int64)
            yield from _cut([depth, p1, p2, none, none, none, conv, none])
        self.clear()


def _cut(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for first in range(0, len(columns[0]), _ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c[first : first + _ROWS])) for c in columns], schema=_PARTS_ARROW)


def _tries(segment: int, most: int):
    """Map function: partial counts of every prefix of a task's conversations, and where each ends (``n`` 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest(segment, most)
        pieces: list[tuple[np.ndarray, np.ndarray]] = []
        before, part, held = np.zeros((1, 2), np.int64), 0, 0
        for batch in batches:
            ids, depth, p1, p2, size, last = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            digests = np.column_stack([p1, p2])
            first = 0
            # A path ends with its conversation or at a multiple of ``segment``.
            for end in np.flatnonzero((last == 1) | (depth % segment == 0)) + 1:
                pieces.append((digests[first:end], size[first:end]))
                whole = np.concatenate([before, *[d for d, _ in pieces]])
                path = Path(int(ids[end - 1]), whole, np.concatenate([s for _, s in pieces]), bool(last[end - 1]))
                yield from forest.add((int(depth[end - 1]) - 1) // segment, path)
                before = np.zeros((1, 2), np.int64) if last[end - 1] else whole[-1:].copy()
                pieces, first = [], end
            if first < batch.num_rows:
                pieces.append((digests[first:].copy(), size[first:].copy()))
        yield from forest.expand()

    return run


def prefixes(steps: DataFrame, segment: int = SEGMENT, most: int = TRIE_TURNS) -> DataFrame:
    """Partial rows ``depth, p1, p2, q1, q2, size, conv_id, n`` of ``conv_id, depth, t1, t2, size`` steps. Stored.

    A row with ``n`` > 0 says that ``n`` conversations of a task pass the prefix (p1, p2), which extends (q1, q2) by a
    turn of ``size`` bytes, the smallest being ``conv_id``; one with ``n`` 0 that ``conv_id`` ends there.
    """
    by_depth = Window.partitionBy("conv_id").orderBy("depth")
    so_far = by_depth.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    digests = steps.select(
        "conv_id",
        "depth",
        F.bit_xor(F.xxhash64("depth", "t1", "t2")).over(so_far).alias("p1"),
        F.bit_xor(F.xxhash64("t2", "t1", "depth")).over(so_far).alias("p2"),
        "size",
        F.when(F.lead("depth").over(by_depth).isNull(), 1).otherwise(0).alias("last"),
    )
    return stored(digests.sortWithinPartitions("conv_id", "depth").mapInArrow(_tries(segment, most), _PARTS), "prefixes")


# ---------------------------------------------------------------- nodes


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ascending ids of each prefix, joined by commas."""
    names = ["p1", "p2", "ends_sha256"]
    now, digest, done = None, hashlib.sha256(), []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done)) or [()] * 3
        done.clear()
        kinds = [pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for batch in batches:
        p1, p2, ids = (batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in ("p1", "p2", "conv_id"))
        cuts = np.flatnonzero((p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])) + 1
        edges = [0, *cuts.tolist(), len(ids)]
        for first, last in zip(edges, edges[1:]):
            if first == last:
                continue
            key, text = (int(p1[first]), int(p2[first])), ",".join(map(str, ids[first:last].tolist()))
            if key == now:
                digest.update(f",{text}".encode())
                continue
            if now is not None:
                done.append((*now, digest.hexdigest()))
            now, digest = key, hashlib.sha256(text.encode())
        yield flush()
    if now is not None:
        done.append((*now, digest.hexdigest()))
    yield flush()


def _subtree_sums(nodes: DataFrame, *values: str) -> DataFrame:
    """``p1, p2`` and the sums of ``values`` over each node's subtree, of ``nodes`` with a parent ``q1, q2`` (root: NULL)."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = nodes.select("p1", "p2", *values)
    jumps = nodes.where("depth > 0").select("p1", "p2", "q1", "q2")
    for turn in range(deepest.bit_length()):
        # Sums reach a distance below their node; add those of the nodes that far below it.
        below = jumps.join(sums, ["p1", "p2"]).groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2"))
        below = below.agg(*[F.sum(v).alias(f"more_{v}") for v in values])
        added = [(F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values]
        more = stored(sums.join(below, ["p1", "p2"], "left").select("p1", "p2", *added), "sums")
        over = jumps.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("q1").alias("r1"), F.col("q2").alias("r2"))
        further = stored(jumps.join(over, ["q1", "q2"]).select("p1", "p2", F.col("r1").alias("q1"), F.col("r2").alias("q2")), "jumps")
        if turn:
            forget(sums)
            forget(jumps)
        sums, jumps = more, further
    return sums


def tree(steps: DataFrame, ids: DataFrame, segment: int = SEGMENT, most: int = TRIE_TURNS) -> DataFrame:
    """Every distinct prefix of conversations given as ``conv_id, depth, t1, t2, size`` steps, depths from 1 on.

    ``ids`` has each ``conv_id`` once with its number of turns ``total``, those without a step too. Returns ``conv_id``
    (smallest member; with ``depth`` it names the prefix), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``. Without conversations there is no root.
    """
    parts = prefixes(steps, segment, most)
    found = parts.where("n > 0").groupBy("depth", "p1", "p2")
    found = found.agg(F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.max("size").alias("size"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"))
    none = F.lit(0).cast("long")
    parent = F.lit(None).cast("long")
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(none.alias("depth"), none.alias("p1"), none.alias("p2"), parent.alias("q1"), parent.alias("q2"), none.alias("size"), "conv_id", "n_convs")
    nodes = stored(found.unionByName(root), "nodes")
    kids = nodes.groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    over = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    placed = nodes.join(kids, ["p1", "p2"], "left").join(over, ["q1", "q2"], "left")
    saved = (F.col("n_convs") - 1) * F.col("size")
    placed = stored(placed.withColumn("n_leaves", F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long")).withColumn("saved_tokens", saved), "placed")
    sums = _subtree_sums(placed, "n_leaves", "saved_tokens")
    ends = parts.where("n = 0").select("p1", "p2", "conv_id").unionByName(ids.where("total = 0").select(none.alias("p1"), none.alias("p2"), "conv_id"))
    ends = ends.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "conv_id").mapInArrow(_ids, "p1 long, p2 long, ends_sha256 string")
    rows = placed.drop("n_leaves", "saved_tokens").join(sums, ["p1", "p2"]).join(ends, ["p1", "p2"], "left")
    return rows.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", none).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


# ---------------------------------------------------------------- conversations


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, t1, t2, size`` of each turn, places from 0 on by turn (NULL first), then role, then text. Stored.

    A NULL role or text is empty. Rows with a NULL id belong to no conversation and are left out.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")],
    ).where("conv_id is not null")
    by_turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    place = (F.row_number().over(by_turn) - 1).cast("long").alias("place")
    hashes = [F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit(1), "role", "text").alias("t2")]
    return stored(rows.select("conv_id", place, *hashes, F.octet_length("text").cast("long").alias("size")), "turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(steps, ids) of conversations that begin with the first turns of another one.

    Conversation c takes the first h turns of conversation c - c % 5, or all it has, and then its own
    from its place h on; h is the CRC-32 of c's digits modulo 9.
    """
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("long")
    convs = counts.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    others = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    head = F.least("h", F.coalesce("base_n", F.lit(0).cast("long")))
    convs = convs.join(others, "base", "left").withColumn("head", head)
    convs = stored(convs.withColumn("total", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))), "conversations")
    # A first turn is taken by five conversations at most, their own included.
    first = turns.where("place < 8").withColumnRenamed("conv_id", "base")
    heads = convs.where("head > 0").join(first, "base").where("place < head").select("conv_id", (F.col("place") + 1).alias("depth"), "t1", "t2", "size")
    tails = turns.join(convs.select("conv_id", "h", "head"), "conv_id").where("place >= h")
    tails = tails.select("conv_id", (F.col("head") + F.col("place") - F.col("h") + 1).alias("depth"), "t1", "t2", "size")
    return heads.unionByName(tails), convs.select("conv_id", "total")


def rebuilt_tree(conversations: DataFrame) -> DataFrame:
    """``tree`` of ``rebuilt`` conversations.

    Repeated rows are turns of their own. Empty texts are turns of no bytes. No rows give no rows. Extra columns
    are not looked at. Equal turns and prefixes are taken by 128 bits of hashes. A conversation's turns
    are put in order by one task, as a sorted stream, and the digest of the ids that end at one node is one stream too.
    """
    tune(conversations.sparkSession)
    return tree(*rebuilt(hashed_turns(conversations)))
