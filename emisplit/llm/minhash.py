"""Near-duplicate documents by MinHash with tensored banding, verified on full shingle sets.

Two small collections of ``TABLES`` sub-keys are computed per document, each
sub-key from ``ROWS`` minhashes. The keys of all ``TABLES ** 2`` tables are the
pairs of a sub-key of one collection with one of the other, so
``2 * TABLES * ROWS`` minhashes do the work of ``2 * TABLES ** 2 * ROWS``. A pair at
the threshold is missed with probability ``2 * (1 - s ** ROWS) ** TABLES``, 3.5e-5 for s = 0.75.

Documents with equal sets are one node. A sub-key that only one node has can't
take part in a match, so only shared ones are paired up. In each table bucket
every node is compared with the bucket's first node; then nodes of one bucket
that are still in different components are compared with each other, in large
buckets chunk by chunk, so no candidate pair that could join two components is
left out. Pairs whose set sizes rule the threshold out are not compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emisplit.llm.common import buffer, ordered_by, shielded, slices, stored
from emisplit.llm.components import components, nearest_roots
from emisplit.llm.words import SPACED, hashed_words, mixed, seeds, shingles
from emisplit.session import tune

WORDS = 5
#: Two sets are linked if 100 * intersection >= PERCENT * union.
PERCENT = 75
ROWS = 3
TABLES = 20
#: Nodes of a bucket up to which they are compared pair by pair, and shingles and nodes in a chunk beyond.
LIGHT = 32
CHUNK_ITEMS = 1 << 17
CHUNK_NODES = 1 << 11
#: Items that a comparison of two chunks takes at once.
_COLUMNS = 512

_SEEDS = seeds(2 * TABLES * ROWS, 4242)
_FACTORS = seeds(2 * TABLES * ROWS, 2424)


def shingle_sets(batch: pa.RecordBatch, width: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    words, first = hashed_words(*buffer(batch.column("text")), SPACED)
    every = shingles(words, width)
    for low, high in zip(first[:-1], first[1:], strict=True):
        if high - low >= width:
            yield np.unique(every[low : high - width + 1])
        else:
            yield shingles(words[low:high], int(high - low)) if high > low else np.zeros(0, np.uint64)


def minhashes(items: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over a set, in pieces that stay in the cache."""
    lowest = np.full(len(_SEEDS), ~np.uint64(0))
    for i in range(0, len(items), 1024):
        hashed = (items[None, i : i + 1024] ^ _SEEDS[:, None]) * _FACTORS[:, None]
        np.minimum(lowest, hashed.min(axis=1), out=lowest)
    return lowest


def sub_keys(items: np.ndarray) -> np.ndarray:
    """``2 * TABLES`` sub-keys; the lowest bit says which collection one belongs to."""
    low = minhashes(items).reshape(2 * TABLES, ROWS)
    keys = mixed((low * seeds(ROWS, 99)).sum(axis=1, dtype=np.uint64) + seeds(2 * TABLES, 98))
    side = np.arange(2 * TABLES, dtype=np.uint64) // np.uint64(TABLES)
    return keys & ~np.uint64(1) | side


_SIGNED = "doc_id long, row long, n long, d1 long, d2 long, subs array<long>"
_SIGNED_ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "row", "n", "d1", "d2")] + [("subs", pa.list_(pa.int64()))])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (s for b in batches for s in slices(b, "text")):
        n, d1, d2, subs = [], [], [], []
        for items in shingle_sets(batch):
            n.append(len(items))
            d1.append(mixed(items ^ _SEEDS[0]).sum(dtype=np.uint64))
            d2.append(mixed(items ^ _SEEDS[1]).sum(dtype=np.uint64))
            subs.append(sub_keys(items).view(np.int64) if len(items) else np.zeros(0, np.int64))
        digests = [pa.array(np.array(d, np.uint64).view(np.int64)) for d in (d1, d2)]
        keys = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum([len(s) for s in subs])]).astype(np.int32)), pa.array(np.concatenate(subs))
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row"), pa.array(n, pa.int64()), *digests, keys], schema=_SIGNED_ARROW
        )


_SETS_ARROW = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("items", pa.list_(pa.int64()))])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (s for b in batches for s in slices(b, "text")):
        items = [s.view(np.int64) for s in shingle_sets(batch)]
        edges = np.concatenate([[0], np.cumsum([len(s) for s in items])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(items)))
        yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("n"), lists], schema=_SETS_ARROW)


_LINK_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _enough(both: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return 100 * both >= PERCENT * (left + right - both)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep pairs whose full sets reach the threshold."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        left, right = batch.column("items_a"), batch.column("items_b")
        for i in range(batch.num_rows):
            a, b = left[i].values.to_numpy().view(np.uint64), right[i].values.to_numpy().view(np.uint64)
            if len(b) > len(a):
                a, b = b, a
            place = np.minimum(np.searchsorted(a, b), len(a) - 1)
            keep[i] = _enough((a[place] == b).sum(), len(a), len(b))
        pairs = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], schema=_LINK_ARROW)
        yield pairs.filter(pa.array(keep))


def _shared_items(left: pa.ListArray, right: pa.ListArray) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right.

    Shared items are taken ``_COLUMNS`` at a time, so beside the result only narrow strips are held.
    """
    counts = [np.diff(x.offsets.to_numpy()) for x in (left, right)]
    items = np.concatenate([left.flatten().to_numpy(), right.flatten().to_numpy()])
    _, place, many = np.unique(items, return_inverse=True, return_counts=True)
    column = np.where(many > 1, np.cumsum(many > 1) - 1, -1)[place]
    row = np.repeat(np.arange(len(left) + len(right)), np.concatenate(counts))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    # Sizes of sets in a chunk are far below 2 ** 24 or the chunk is one set: whole numbers that float32 has.
    total = np.zeros((len(left), len(right)), np.float32 if len(items) < 1 << 24 else np.float64)
    shared = int(column.max(initial=-1)) + 1
    for low in range(0, shared, _COLUMNS):
        first, last = np.searchsorted(column, (low, low + _COLUMNS))
        grid = np.zeros((len(left) + len(right), min(_COLUMNS, shared - low)), np.float32)
        grid[row[first:last], column[first:last] - low] = 1
        total += grid[: len(left)] @ grid[len(left) :].T
    return total


def _similar(left: pa.StructArray, right: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of sets in different components that reach the threshold, worked out strip by strip."""
    sizes = [np.diff(x.field("items").offsets.to_numpy()) for x in (left, right)]
    roots = [x.field("root").to_numpy() for x in (left, right)]
    both = _shared_items(left.field("items"), right.field("items"))
    found = []
    for low in range(0, len(left), 128):
        strip = slice(low, low + 128)
        ok = _enough(both[strip].astype(np.float64), sizes[0][strip, None], sizes[1][None, :])
        x, y = np.nonzero(ok & (roots[0][strip, None] != roots[1][None, :]))
        # One pair for each two components is enough.
        pairs = np.stack([np.minimum(roots[0][x + low], roots[1][y]), np.maximum(roots[0][x + low], roots[1][y])])
        one = np.unique(pairs, axis=1, return_index=True)[1]
        found.append((x[one] + low, y[one]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between two chunks of sets, one for each two components that they join."""
    for batch in batches:
        for i in range(batch.num_rows):
            left, right = batch.column("left")[i].values, batch.column("right")[i].values
            roots = [x.field("root").to_numpy() for x in (left, right)]
            x, y = _similar(left, right)
            pairs = np.stack([np.minimum(roots[0][x], roots[1][y]), np.maximum(roots[0][x], roots[1][y])])
            x, y = (v[np.unique(pairs, axis=1, return_index=True)[1]] for v in (x, y))
            nodes = [c.field("node").to_numpy()[v] for c, v in ((left, x), (right, y))]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in nodes], schema=_LINK_ARROW)


def _close(a: str, b: str):
    """Set sizes that allow the threshold."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def full_sets(members: DataFrame, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, n, items``: the sets of all nodes that share a bucket, from the whole texts anew."""
    wanted = stored(nodes.select("node", "n", "row").join(members.select("node").distinct(), "node"), "wanted")
    # The list grows with the documents, so it is never broadcast.
    texts = rows.select("row", "text").join(wanted.hint("merge"), "row").dropDuplicates(["node"]).select("node", "n", "text")
    return stored(texts.mapInArrow(_sets, "node long, n long, items array<long>"), "sets")


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the distinct ``a, b`` whose sets are similar enough."""
    with_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("items").alias("items_b")), "b")
    full = with_b.join(sets.select(F.col("node").alias("a"), F.col("items").alias("items_a")), "a")
    return stored(full.select("a", "b", "items_a", "items_b").mapInArrow(_linked, "a long, b long"), "links")


def light_pairs(placed: DataFrame) -> DataFrame:
    """Pairs of nodes in different components from buckets of at most ``LIGHT`` nodes.

    Of buckets with the same nodes one is used, so a pair seldom comes twice.
    """
    alike = placed.groupBy("key").agg(F.sum(F.xxhash64("node") % (1 << 50)).alias("sum"), F.max("many").alias("many"), F.min("node").alias("least"))
    chosen = stored(alike.groupBy("sum", "many", "least").agg(F.min("key").alias("key")).select("key"), "chosen")
    rows = stored(placed.join(chosen, "key").select("key", "node", "n", "root"), "light")
    left, right = rows.alias("l"), rows.alias("r")
    pairs = left.join(right, "key").where((F.col("l.root") < F.col("r.root")) & _close("l.n", "r.n"))
    return stored(pairs.select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")).distinct(), "apart")


def dealt(nodes: DataFrame, place: list[str]) -> DataFrame:
    """``nodes`` with ``chunk``: the nodes of a ``place`` dealt by a hash into chunks.

    A chunk has about ``CHUNK_ITEMS`` shingles and ``CHUNK_NODES`` nodes at most, so the grid of
    two chunks is bounded for sets of any size.
    """
    most = F.greatest(F.sum("n") / CHUNK_ITEMS, F.count("*") / CHUNK_NODES)
    chunks = nodes.groupBy(*place).agg(F.ceil(most).alias("chunks"))
    return nodes.join(stored(chunks, "chunks"), place).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))


def heavy_links(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between different components among nodes that buckets of more than ``LIGHT`` nodes connect.

    The nodes of a group of overlapping buckets are dealt into chunks, apart by set size and by whether they belong to the group's largest
    component. Chunks meet in pairs where sizes allow a link, except two of the
    largest component; a pair of chunks is compared at once and gives links only, so no pairs of
    nodes are written.
    """
    grouped = components(placed.select(F.col("node").alias("a"), F.col("first.node").alias("b")))
    nodes = stored(placed.select("node", "n", "root").distinct().join(grouped.withColumnRenamed("root", "group"), "node"), "grouped")
    largest = nodes.groupBy("group", "root").count().groupBy("group").agg(F.max(F.struct("count", "root")).alias("top"))
    largest = stored(largest.select("group", F.col("top.root").alias("top")), "largest")
    # Sets that may be linked differ by one step of this scale at most.
    step = F.floor(F.log("n") / F.log(F.lit(100 / PERCENT)) + 1e-9)
    nodes = nodes.join(largest, "group").select("node", "n", "root", "group", (F.col("root") == F.col("top")).alias("main"), step.alias("step"))
    place = ["group", "main", "step"]
    chunked = dealt(nodes, place)
    place.append("chunk")
    payload = chunked.join(sets.select("node", "items"), "node").groupBy(*place).agg(F.collect_list(F.struct("node", "root", "items")).alias("sets"))
    payload = stored(payload, "payload")
    names = payload.select(*place).withColumn("id", F.xxhash64(*place))
    left, right = names.alias("l"), names.alias("r")
    fits = (F.abs(F.col("l.step") - F.col("r.step")) <= 1) & (F.col("l.id") <= F.col("r.id")) & ~(F.col("l.main") & F.col("r.main"))
    meet = left.join(right, "group").where(fits)
    meet = stored(meet.select("group", *[F.col(f"{x}.{c}").alias(f"{x}_{c}") for x in "lr" for c in place[1:]]), "meet")
    full = meet
    for x, name in (("r", "right"), ("l", "left")):
        side = payload.select("group", *[F.col(c).alias(f"{x}_{c}") for c in place[1:]], F.col("sets").alias(name))
        full = full.join(side, ["group", *[f"{x}_{c}" for c in place[1:]]])
    return stored(full.select("left", "right").mapInArrow(_block_links, "a long, b long"), "heavy")


def buckets(nodes: DataFrame) -> DataFrame:
    """``key, node, n`` of every table bucket with several nodes."""
    subs = nodes.select("node", "n", F.explode("subs").alias("sub"))
    shared = stored(subs.groupBy("sub").count().where("count > 1").select("sub"), "shared")
    mine = subs.join(shared, "sub").groupBy("node", "n").agg(F.collect_list("sub").alias("subs"))
    side = lambda bit: F.filter("subs", lambda s: s.bitwiseAND(F.lit(1).cast("long")) == bit)
    pairs = F.flatten(F.transform(side(0), lambda x: F.transform(side(1), lambda y: F.xxhash64(x, y))))
    keyed = stored(mine.select("node", "n", F.explode(pairs).alias("key")), "keyed")
    several = stored(keyed.groupBy("key").agg(F.min(F.struct("node", "n")).alias("first"), F.count("*").alias("many")).where("many > 1"), "several")
    return stored(keyed.join(several, "key").select("key", "node", "n", "first"), "buckets")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row of ``docs``.

    Linked documents and what they are linked with in turn share the smallest
    id among them; ``kept`` is true where that is the row's own id. NULL and empty
    texts, and texts of blanks, have no shingles and are linked with nothing. Rows with equal ids are
    compared like any others. A NULL id is never the smallest; a component without
    any id has none, and rows without an id are kept only there. No rows give no rows. Other columns are
    not looked at.
    """
    tune(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row"), "text")
    signed = stored(rows.mapInArrow(_signed, _SIGNED), "signed")
    sets = signed.where("n > 0").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("least_id"), F.min("row").alias("row"), F.first("n").alias("n"), F.first("subs").alias("subs")
    )
    nodes = stored(sets.withColumn("node", F.monotonically_increasing_id()), "nodes")

    members = buckets(nodes)
    sets = full_sets(members, rows, nodes)
    stars = members.where((F.col("node") != F.col("first.node")) & _close("n", "first.n"))
    stars = stored(stars.select(F.col("first.node").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    found = links(stars, sets)
    roots = nearest_roots(found)

    # What shares a bucket but no root yet: no two of them were linked through a first node.
    placed = members.join(roots, "node", "left").select("key", "node", "n", "first", F.coalesce("root", "node").alias("root"))
    apart = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("many"))
    apart = stored(apart.where("low != high").select("key", "many"), "mixed")
    placed = stored(placed.join(apart, "key"), "placed")
    light = light_pairs(placed.where(F.col("many") <= LIGHT)).join(stars, ["a", "b"], "left_anti")
    heavy = placed.where(F.col("many") > LIGHT)
    more = links(light, sets).unionByName(heavy_links(heavy, sets))
    roots = components(found.unionByName(more))

    labelled = nodes.join(roots, "node", "left").select("d1", "d2", "least_id", F.coalesce("root", "node").alias("root"))
    lowest = labelled.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labelled = stored(labelled.join(lowest, "root").select("d1", "d2", "component_id"), "labelled")
    out = signed.drop("subs").join(labelled, ["d1", "d2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


@shielded
def representatives(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, with the columns of ``docs``: the one with the smallest id.

    Of rows that share that id one stays, as does one of rows that are equal in id and text: the
    smallest in the other columns. Documents without an id go with their group if it has an id; else
    one of them stays. Rows without shingles are groups of their own, but for equal ones. No rows give no rows.
    """
    marked = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    judged = near_duplicates(marked.select(F.col("__row").alias("doc_id"), "text"))
    # Rows are judged under a hash of id and text; the group's smallest true id stays.
    groups = judged.select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group")).distinct()
    placed = stored(marked.select("__row", F.col("doc_id").alias("__id")).distinct().join(groups, "__row"), "groups")
    first = placed.groupBy("__group").agg(F.min_by("__row", F.struct(F.col("__id").isNull(), "__id", "__row")).alias("__row"))
    chosen = marked.join(first.select("__row"), "__row", "left_semi")
    # Copies of a row meet as one row per task, as the smallest is taken before the shuffle.
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    whole = F.struct(*docs.columns)
    smallest = F.min_by(whole, ordered_by(docs, *others)) if others else F.first(whole)
    one = chosen.groupBy("__row").agg(smallest.alias("__one"))
    return one.select(*[F.col("__one")[c].alias(c) for c in docs.columns])
