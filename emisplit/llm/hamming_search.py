"""Exact top-k search of binary codes by incremental multi-index hashing.

Vectors become codes, a bit per dimension: its sign. A code is cut into
segments, each with a table from segment value to codes. By the pigeonhole
principle every code within distance ``m * (r + 1) - 1`` of a query differs by
at most ``r`` bits in one of the ``m`` segments. All tables are probed with growing radius ``r``;
every code found is verified by its full distance. A query is done once its
k-th verified distance is covered; only the others go on to the next radius.

Equal codes are one entry of the index with its smallest ids, so groups of
copies cost nothing. The codes are dealt into blocks of bounded size by a hash;
each block holds its part of the tables, and the queries of a round visit all
blocks in bounded chunks. A block returns the k best codes per query, no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emisplit.llm.common import stored

#: Codes in a block and queries in a chunk, on average.
BLOCK = 1 << 16
CHUNK = 1 << 12
#: Ids of every this many are queries.
EVERY = 50

_FOUND = "query long, code long, distance int"
_FOUND_ARROW = pa.schema([("query", pa.int64()), ("code", pa.int64()), ("distance", pa.int32())])


def sign_code(vector: Column, bits: int = 64) -> Column:
    """The signs of up to ``bits`` dimensions as a long: bit i is set if dimension i is positive.

    Missing and NULL dimensions count as not positive; a NULL vector has no code. A vector of more dimensions
    raises, as a part of it would give other neighbours.
    """
    doubles = vector.cast("array<double>")
    wide = F.concat(F.lit(f"a code holds {bits} dimensions, a vector has "), F.size(doubles).cast("string"))
    doubles = F.when(F.size(doubles) > bits, F.raise_error(wide)).otherwise(doubles)
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    bit = lambda x, i: F.when((i < bits) & (x > 0) & ~F.isnan(x), F.call_function("shiftleft", one, i)).otherwise(zero)
    return F.aggregate(F.transform(doubles, bit), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def segments(bits: int, codes: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment; a segment has about as many values as a block has codes."""
    width = max(4, min(16, int(np.log2(max(codes, 16)))))
    count = -(-bits // width)
    edges = [bits * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _masks(width: int, radius: int) -> np.ndarray:
    return np.array([sum(1 << i for i in c) for c in combinations(range(width), radius)], np.uint64)


class Tables:
    """The part of the segment tables that a block of codes has."""

    def __init__(self, codes: np.ndarray, parts: list[tuple[int, int]]):
        self.codes, self.parts, self.tables = codes, parts, []
        for shift, width in parts:
            value = (codes >> np.uint64(shift)) & np.uint64((1 << width) - 1)
            order = np.argsort(value, kind="stable")
            self.tables.append((order, np.searchsorted(value[order], np.arange((1 << width) + 1, dtype=np.uint64))))

    def at_radius(self, query: np.uint64, radius: int) -> np.ndarray:
        """Places of the codes that differ from ``query`` by ``radius`` bits in some segment."""
        found = []
        for (shift, width), (order, first) in zip(self.parts, self.tables, strict=True):
            if radius > width:
                continue
            value = ((query >> np.uint64(shift)) & np.uint64((1 << width) - 1)) ^ _cached(width, radius)
            low, high = first[value], first[value + np.uint64(1)]
            some = high > low
            low, many = low[some], (high - low)[some]
            # Rows low..high of each probed value, one after the other.
            found.append(order[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


_MASKS: dict[tuple[int, int], np.ndarray] = {}


def _cached(width: int, radius: int) -> np.ndarray:
    if (width, radius) not in _MASKS:
        _MASKS[width, radius] = _masks(width, radius)
    return _MASKS[width, radius]


def _probe(parts: list[tuple[int, int]], radii: tuple[int, ...], k: int):
    """Map function over (codes of a block, queries of a chunk): the k best codes per query at these radii."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, chunks = batch.column("codes"), batch.column("queries")
            for i in range(batch.num_rows):
                entries = blocks[i].values
                codes = entries.field("code").to_numpy().astype(np.uint64)
                lowest = entries.field("lowest").to_numpy()
                queries = chunks[i].values.to_numpy().astype(np.uint64)
                tables, out = Tables(codes, parts), []
                for q in queries:
                    near = np.unique(np.concatenate([tables.at_radius(q, r) for r in radii]))
                    distance = np.bitwise_count(codes[near] ^ q).astype(np.int32)
                    if len(near) > k:
                        close = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
                        close = close[np.lexsort((lowest[near[close]], distance[close]))[:k]]
                        near, distance = near[close], distance[close]
                    out.append((np.full(len(near), q), codes[near], distance))
                columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0].astype(np.int64)), pa.array(columns[1].astype(np.int64)), pa.array(columns[2])], schema=_FOUND_ARROW
                )

    return run


def search(vectors: DataFrame, k: int = 10, every: int = EVERY, bits: int = 64) -> DataFrame:
    """The ``k`` nearest other rows of each query, by Hamming distance, then id.

    Queries are the rows whose ``vec_id`` is divisible by ``every``. Returns
    ``query_id, rank, neighbor_id, distance``; ranks start at 1. A query has fewer rows only if the table
    has fewer other ids. NULL ids are neither found nor queries, NULL
    embeddings have no code; both take no part. Rows with equal id and code
    are one; an id with several codes is found under each. Ties go by id.
    No rows give no rows. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), sign_code(F.col("embedding"), bits).alias("code"))
    rows = stored(rows.where("id is not null and code is not null").distinct(), "codes")
    # k + 1 smallest ids of each code: enough for any query, which may find itself. The first
    # aggregate is per hash part, so a code that very many rows share is not gathered in one task.
    part = F.pmod(F.xxhash64("id"), F.lit(64))
    ids = lambda values: F.slice(F.array_sort(values), 1, k + 1)
    ranked = rows.groupBy("code", part.alias("part")).agg(ids(F.collect_list("id")).alias("ids"))
    entries = stored(ranked.groupBy("code").agg(ids(F.flatten(F.collect_list("ids"))).alias("ids")), "entries")
    n = entries.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, neighbor_id long, distance int")
    blocks = -(-n // BLOCK)
    parts = segments(bits, -(-n // blocks))
    index = entries.groupBy(F.pmod(F.xxhash64("code"), F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("code", F.col("ids")[0].alias("lowest"))).alias("codes"))
    index = stored(index, "index")

    asked = rows.where(F.col("id") % every == 0)
    active = stored(asked.select(F.col("code").alias("query")).distinct(), "queries")
    best = spark.createDataFrame([], f"{_FOUND}, ids array<long>")
    done, radius = best, -1
    while True:
        # The first round covers small distances at once; later ones go one radius further.
        radii = tuple(range(min(3, parts[0][1] + 1))) if radius < 0 else (radius + 1,)
        radius = radii[-1]
        chunks = max(1, -(-active.count() // CHUNK))
        dealt = active.groupBy(F.pmod(F.xxhash64("query", F.lit(3)), F.lit(chunks)).alias("chunk")).agg(F.collect_list("query").alias("queries"))
        visits = dealt.select("queries", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
        found = visits.join(index, "block").select("codes", "queries").repartition(max(1, min(chunks * blocks, 2000)))
        found = found.mapInArrow(_probe(parts, radii, k + 1), _FOUND).join(entries, "code").select("query", "code", "distance", "ids")
        found = best.join(active, "query", "left_semi").unionByName(found)
        merged = stored(_kept(found, k + 1), f"round{radius}")
        # ``reach`` is the distance below which no code is missing; a query is done when k others lie within.
        reach = len(parts) * (radius + 1) - 1
        kth = merged.groupBy("query").agg(F.sum(F.when(F.col("distance") <= reach, F.size("ids")).otherwise(0)).alias("n"))
        more = kth.where(F.col("n") < k + 1).select("query")
        left = active.join(kth.where(F.col("n") >= k + 1), "query", "left_anti")
        if radius >= max(w for _, w in parts):
            left = more.limit(0)
        left = stored(left, "active")
        done = done.unionByName(merged.join(left, "query", "left_anti"))
        if left.isEmpty():
            break
        best, active = merged, left
    nearest = done.select("query", "distance", F.explode("ids").alias("neighbor_id"))
    queries = asked.select(F.col("id").alias("query_id"), F.col("code").alias("query"))
    return _ranked(queries, nearest, k)


def _kept(found: DataFrame, k: int) -> DataFrame:
    """Each query's ``k`` best codes by distance and smallest id; they hold its ``k`` best rows.

    A block gives at most ``k`` codes per query, so the groups are small.
    """
    ordered = F.struct("distance", F.col("ids")[0].alias("lowest"), "code", "ids")
    best = found.groupBy("query").agg(F.slice(F.array_sort(F.collect_set(ordered)), 1, k).alias("best"))
    return best.select("query", F.explode("best").alias("b")).select("query", "b.code", "b.distance", "b.ids")


def _ranked(queries: DataFrame, nearest: DataFrame, k: int) -> DataFrame:
    """Ids per query code in order of distance and id, without the query itself, the first k."""
    listed = nearest.groupBy("query").agg(F.array_sort(F.collect_set(F.struct("distance", "neighbor_id"))).alias("near"))
    own = F.filter("near", lambda x: x["neighbor_id"] != F.col("query_id"))
    rows = queries.join(listed, "query").select("query_id", F.posexplode(F.slice(own, 1, k)).alias("place", "x"))
    return rows.select("query_id", (F.col("place") + 1).alias("rank"), "x.neighbor_id", "x.distance")
