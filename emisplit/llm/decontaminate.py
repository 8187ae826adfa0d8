"""Benchmark decontamination: a prefix-filtered join of item windows with whole documents.

Every benchmark item is cut into windows of ten consecutive words (an item with
fewer words is one window). Containment of a window needs all of its shingles,
so its rarest shingle alone is a sufficient prefix: shingles are ordered by how
often they occur in all documents, and only the rarest one of each window is
looked up. A hit's position in the window gives the only place where the window can
start; places before the document's start or too close to its end are out (positional and length
bounds), and the rest is verified word by word.

The benchmark side is dealt into blocks of bounded size, each of which is sent to the
executors and met by all documents in turn; documents are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emisplit.llm.common import buffer, shielded, slices
from emisplit.llm.words import ALNUM, hashed_words, shingles

WINDOW = 10
SHINGLE = 3
#: Words of benchmark items per block; a block takes about 300 bytes per word.
BLOCK_WORDS = 100_000


@dataclass
class Block:
    """Windows of some items as arrays.

    ``words`` holds the windows' words end to end, ``first`` where each begins. ``items`` are the
    item ids and ``pairs`` the (window, item) pairs sorted by window. ``parts[width]`` lists the
    windows' shingles of that width: (hashes sorted, window, offset in it, row of ``counts``).
    """

    words: np.ndarray
    first: np.ndarray
    items: list[str]
    pairs: np.ndarray
    parts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def make_block(items: list[tuple[str, str]], window: int = WINDOW, width: int = SHINGLE) -> Block:
    """Distinct windows of ``(item id, text)`` rows with every shingle of each."""
    texts = [t.encode() for _, t in items]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    words, first = hashed_words(data, offsets, ALNUM)
    names = sorted({i for i, _ in items})
    index = {n: k for k, n in enumerate(names)}
    known: dict[bytes, int] = {}
    pairs: set[tuple[int, int]] = set()
    kept: list[np.ndarray] = []
    for k, (item, _) in enumerate(items):
        own = words[first[k] : first[k + 1]]
        for i in range(max(1, len(own) - window + 1) if len(own) else 0):
            part = own[i : i + window]
            number = known.setdefault(part.tobytes(), len(known))
            if number == len(kept):
                kept.append(part)
            pairs.add((number, index[item]))
    lengths = [len(w) for w in kept]
    rows: dict[int, list[tuple[int, int, int]]] = {}
    for number, part in enumerate(kept):
        size = min(width, len(part))
        rows.setdefault(size, []).extend((int(h), number, i) for i, h in enumerate(shingles(part, size)))
    parts = {}
    for size, found in rows.items():
        hashes = np.array([f[0] for f in found], np.uint64)
        rest = np.array([f[1:] for f in found], np.int64).reshape(-1, 2)
        order = np.argsort(hashes, kind="stable")
        parts[size] = (hashes[order], rest[order, 0], rest[order, 1])
    return Block(
        np.concatenate(kept) if kept else np.zeros(0, np.uint64),
        np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
        names,
        np.array(sorted(pairs), np.int64).reshape(-1, 2),
        parts,
    )


def _lookup(hashes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For hashes that occur in the sorted ``table``: their position, and first and last row of the table."""
    if not len(table):
        return (np.zeros(0, np.int64),) * 3
    small = np.zeros(1 << 16, bool)
    small[table >> np.uint64(48)] = True
    maybe = np.flatnonzero(small[hashes >> np.uint64(48)])
    low = np.searchsorted(table, hashes[maybe])
    hit = table[np.minimum(low, len(table) - 1)] == hashes[maybe]
    maybe, low = maybe[hit], low[hit]
    return maybe, low, np.searchsorted(table, hashes[maybe], "right")


def _inside(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of ``size`` over all rows; those across two rows are masked out."""
    found = shingles(words, size)
    valid = np.ones(len(found), bool)
    for back in range(1, size):
        edge = first[1:-1] - back
        valid[edge[(edge >= 0) & (edge < len(found))]] = False
    return found, valid


def _counted(block: Block):
    """Map function: how often each shingle of the block occurs in the texts of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {size: np.zeros(len(p[0]), np.int64) for size, p in block.value.parts.items()}
        for batch in (s for b in batches for s in slices(b, "text")):
            words, first = hashed_words(*buffer(batch.column("text")), ALNUM)
            for size, (table, _, _) in block.value.parts.items():
                found, valid = _inside(words, first, size)
                _, low, _ = _lookup(found[valid], table)
                np.add.at(sums[size], low, 1)
        for size, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), size, np.int32)), pa.array(at.astype(np.int32)), pa.array(total[at])], names=["size", "place", "n"]
            )

    return run


def with_prefixes(block: Block, counts: dict[int, np.ndarray]) -> Block:
    """Only the rarest shingle of each window stays (ties: the first in the window)."""
    parts = {}
    for size, (table, window, offset) in block.parts.items():
        # A hash that several windows share is counted at its first row.
        n = counts[size][np.searchsorted(table, table)]
        order = np.lexsort((offset, n, window))
        best = order[np.unique(window[order], return_index=True)[1]]
        best = np.sort(best)
        parts[size] = (table[best], window[best], offset[best])
    return Block(block.words, block.first, block.items, block.pairs, parts)


def matches(block: Block, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start word in the buffer, window) of every occurrence of a window in a row."""
    rows, starts, windows = [], [], []
    for size, (table, window, offset) in block.parts.items():
        found, valid = _inside(words, first, size)
        at, low, high = _lookup(found, table)
        ok = valid[at]
        at, low, high = at[ok], low[ok], high[ok]
        many = high - low
        entry = np.repeat(low, many) + (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
        w, start = window[entry], np.repeat(at, many) - offset[entry]
        row = np.searchsorted(first, np.repeat(at, many), "right") - 1
        length = block.first[w + 1] - block.first[w]
        fits = (start >= first[row]) & (start + length <= first[row + 1])
        w, start, row, length = w[fits], start[fits], row[fits], length[fits]
        same = np.ones(len(w), bool)
        for i in range(int(length.max()) if len(length) else 0):
            live = np.flatnonzero(same & (i < length))
            same[live] = words[start[live] + i] == block.words[block.first[w[live]] + i]
        rows.append(row[same])
        starts.append(start[same])
        windows.append(w[same])
    if not rows:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(rows), np.concatenate(starts), np.concatenate(windows)


_HITS = "doc_id long, digest long, n_words long, n_hit long, hits array<struct<s:int,e:int>>, items array<string>"
_HITS_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("digest", pa.int64()),
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("hits", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def _joined(block):
    """Map function: hit words as ranges, and the items found, of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        length = np.diff(b.first)
        for batch in (s for x in batches for s in slices(x, "text")):
            words, first = hashed_words(*buffer(batch.column("text")), ALNUM)
            row, start, window = matches(b, words, first)
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, start, 1)
            np.add.at(change, start + length[window], -1)
            covered = np.cumsum(change[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(covered)])
            hits: list[list] = [[] for _ in range(batch.num_rows)]
            items: list[list] = [[] for _ in range(batch.num_rows)]
            order = np.argsort(row, kind="stable")
            for i in np.unique(row):
                mine = order[np.searchsorted(row[order], i) : np.searchsorted(row[order], i, "right")]
                own = np.concatenate([[False], covered[first[i] : first[i + 1]], [False]]).astype(np.int8)
                edge = np.flatnonzero(np.diff(own)).reshape(-1, 2)
                hits[i] = [{"s": int(s), "e": int(e)} for s, e in edge]
                wanted = np.unique(window[mine])
                lows, highs = np.searchsorted(b.pairs[:, 0], wanted), np.searchsorted(b.pairs[:, 0], wanted, "right")
                ids = {int(x) for lo, hi in zip(lows, highs, strict=True) for x in b.pairs[lo:hi, 1]}
                items[i] = [b.items[x] for x in sorted(ids)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("digest"),
                    pa.array(np.diff(first)),
                    pa.array(total[first[1:]] - total[first[:-1]]),
                    pa.array(hits, _HITS_ARROW.field("hits").type),
                    pa.array(items, _HITS_ARROW.field("items").type),
                ],
                schema=_HITS_ARROW,
            )

    return run


def blocks(benchmark: DataFrame, words: int = BLOCK_WORDS, window: int = WINDOW) -> Iterator[Block]:
    """The benchmark in blocks of about ``words`` words, read by the driver one after the other."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").where("text is not null")
    rows = rows.distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-total // (5 * words)))
    for part in range(parts):
        mine = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        yield make_block([(r["item_id"], r["text"]) for r in sorted(mine)], window)


def hit_words(docs: DataFrame, benchmark: DataFrame, words: int = BLOCK_WORDS, window: int = WINDOW) -> DataFrame:
    """Words of each row of ``docs`` that lie in an occurrence of a benchmark window.

    Returns ``doc_id, n_words, n_hit, hits, items``: ``hits`` are ranges of word
    numbers, ``items`` the sorted ids of the items with an occurring window. NULL
    and empty texts have no words. Rows with equal or NULL ids are looked at
    one by one. An item without words has no window; a NULL item id counts as ''.
    Items with the same id count once. Without items nothing is hit. Extra columns are not looked at.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), "text")
    results = []
    for block in blocks(benchmark, words, window):
        counts = {size: np.zeros(len(p[0]), np.int64) for size, p in block.parts.items()}
        if block.parts:
            found = rows.mapInArrow(_counted(context.broadcast(block)), "size int, place int, n long")
            for r in found.groupBy("size", "place").agg(F.sum("n").alias("n")).collect():
                counts[r["size"]][r["place"]] = r["n"]
        results.append(rows.mapInArrow(_joined(context.broadcast(with_prefixes(block, counts))), _HITS))
    if len(results) == 1:
        return results[0].drop("digest")
    return _united(results)


def _united(results: list[DataFrame]) -> DataFrame:
    """Results of several blocks as one row per row of the documents."""
    every = results[0]
    for more in results[1:]:
        every = every.unionByName(more)
    keys = ["doc_id", "digest", "n_words"]
    rows = every.groupBy(*keys).agg(
        F.count("*").alias("copies"), F.flatten(F.collect_set("hits")).alias("hits"), F.collect_set("items").alias("items")
    )
    # Fold the sorted ranges: a range that touches the last one extends it.
    kind = "array<struct<s:int,e:int>>"

    def join(done, x):
        last = F.element_at(done, -1)
        longer = F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))
        extended = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        return F.when((F.size(done) > 0) & (x["s"] <= F.try_element_at(done, F.lit(-1))["e"]), extended).otherwise(F.concat(done, F.array(x)))

    rows = rows.withColumn("hits", F.aggregate(F.array_sort("hits"), F.array().cast(kind), join))
    rows = rows.withColumn("items", F.array_sort(F.array_distinct(F.flatten("items"))))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda t, x: t + x["e"] - x["s"])
    rows = rows.withColumn("n_hit", n_hit)
    again = F.explode(F.sequence(F.lit(1), (F.col("copies") / len(results)).cast("int")))
    return rows.select("doc_id", "n_words", "n_hit", "hits", "items", again.alias("copy")).drop("copy")


@shielded
def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit word, with the columns of ``docs``.

    A row goes if a row with its id and text has a hit.
    """
    marked = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    hit = hit_words(marked.select(F.col("__row").alias("doc_id"), "text"), benchmark)
    hit = hit.where("n_hit > 0").select(F.col("doc_id").alias("__row")).distinct()
    return marked.join(hit, "__row", "left_anti").select(*docs.columns)
