"""Mix sources to target weights with a multivariate-hypergeometric splitting tree.

Each source's documents are dealt into blocks by a hash of their id, or of the text
where they have none, and the blocks are permuted. A source's target is met by whole passes over its blocks
plus a run of the permuted blocks, so quotas are exact numbers of blocks. The
quotas of all sources are split among output shards by a binary tree: every
node draws its left child's share from a multivariate hypergeometric
distribution, so each shard is a fair sample of the mixture and no block is
drawn twice in a pass. Inside a shard documents are shuffled by a seeded hash.

The plan holds one row per source (bounded by the number of sources, not of
documents) and is worked out on the driver; documents only meet it through joins.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emisplit.llm.common import SPACES, same, shielded, stored

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (1, 2, 3)

_PLAN = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("source_size", T.LongType()),
        T.StructField("target", T.DoubleType()),
        T.StructField("passes", T.IntegerType()),
        T.StructField("part", T.DoubleType()),
    ]
)


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACES}]+")), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], most: float = 3.0) -> list[float]:
    """Shares of the total by weight; what exceeds ``most`` sizes goes to the others by weight."""
    left, free, out = float(sum(sizes)), list(range(len(sizes))), [0.0] * len(sizes)
    while free:
        unit = left / sum(weights[i] for i in free)
        above = [i for i in free if weights[i] * unit > most * sizes[i]]
        if not above:
            for i in free:
                out[i] = weights[i] * unit
            break
        for i in above:
            out[i] = most * sizes[i]
            left -= out[i]
        full = set(above)
        free = [i for i in free if i not in full]
    return out


def split(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Quotas per source (rows) and shard (columns), drawn down a binary tree."""
    out = np.zeros((len(quotas), shards), np.int64)

    def descend(have: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            out[:, low] = have
            return
        middle = (low + high) // 2
        total = int(have.sum())
        draw = total * (middle - low) // (high - low)
        rng = np.random.default_rng([seed, low, high])
        left = rng.multivariate_hypergeometric(have, draw, method="marginals") if total else have * 0
        descend(have - left, middle, high)
        descend(left, low, middle)

    descend(np.asarray(quotas, np.int64), 0, shards)
    return out


def _block(id_column: str, blocks: int, seed: int) -> Column:
    """Block of a document by its id; of one without an id by its text."""
    by_text = F.xxhash64(F.col(id_column), F.col("text"), F.lit(seed))
    hashed = F.when(F.col(id_column).isNull(), by_text).otherwise(F.xxhash64(F.col(id_column), F.lit(seed)))
    return F.pmod(hashed, F.lit(blocks)).cast("int")


def _placed(sized: DataFrame, weights: tuple[float, ...], shards: int, seed: int) -> DataFrame:
    """``source, block, source_size, target, copies, draws`` of every block of ``sized``."""
    spark = sized.sparkSession
    by_block = sized.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    found = sized.groupBy("source").agg(F.sum("size").alias("source_size")).collect()
    found.sort(key=lambda r: (r.source is None, (r.source or "").encode()))
    sizes = [r.source_size for r in found]
    goals = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))])
    rows = []
    for row, size, goal in zip(found, sizes, goals, strict=True):
        passes = int(goal // size) if size else 0
        rows.append((row.source, size, goal, passes, goal - passes * size))
    plan = spark.createDataFrame(rows, _PLAN)

    by_source = Window.partitionBy("source")
    permuted = by_source.orderBy(F.xxhash64("block", "source", F.lit(seed + 1)), "block")
    b = by_block.withColumns(
        {
            "place": F.row_number().over(permuted) - 1,
            "before": F.sum("block_size").over(permuted.rowsBetween(Window.unboundedPreceding, -1)),
            "n_blocks": F.count("*").over(by_source),
        }
    )
    b = b.join(plan, same(b, plan, "source")).drop(plan["source"])
    drawn = F.coalesce("before", F.lit(0)) + F.col("block_size") / 2 <= F.col("part")
    b = stored(b.withColumn("copies", F.col("passes") + (drawn & (F.col("part") > 0)).cast("int")), "blocks")

    quotas = {r.source: r.quota for r in b.groupBy("source").agg(F.sum("copies").alias("quota")).collect()}
    dealt = split(np.array([quotas.get(r.source, 0) for r in found], np.int64), shards, seed)
    bounds = [(r.source, [int(x) for x in np.cumsum(q)]) for r, q in zip(found, dealt, strict=True)]
    bounds = spark.createDataFrame(bounds, "source string, bounds array<bigint>")
    placed = b.join(bounds, same(b, bounds, "source")).drop(bounds["source"])
    shard = F.transform(
        F.sequence(F.lit(0), F.col("copies") - 1),
        lambda c: F.size(F.filter("bounds", lambda x: x <= c * F.col("n_blocks") + F.col("place"))),
    )
    none = F.array().cast("array<int>")
    return placed.select(
        "source", "block", "source_size", "target", "copies", F.when(F.col("copies") > 0, shard).otherwise(none).alias("draws")
    )


def _sized(docs: DataFrame, id_column: str, blocks: int, seed: int) -> DataFrame:
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        _block(id_column, blocks, seed).alias("block"),
        word_count(F.col("text")).alias("size"),
    )
    return stored(rows, "sizes")


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    weights: tuple[float, ...] = WEIGHTS,
    shards: int = 16,
    blocks: int = 1024,
    seed: int = 11,
) -> DataFrame:
    """What the mixture takes of each document.

    Returns ``doc_id, size, source_size, target, taken, draws``, a row per row
    of ``docs``. ``draws`` lists the shard of every copy taken. ``blocks`` is
    the number of blocks per source: the taken words of a source differ from its target
    by about a block at most. Results depend on the rows and ``seed`` alone.

    NULL sources are one source, the last; NULL or empty texts have size 0 and
    take no words, though their blocks are drawn; a source without words has
    target 0. Rows with equal ids share a block, as do rows without an id that have
    equal texts. No rows give no rows. Other columns of ``docs`` are not looked at.
    """
    sized = _sized(docs, id_column, blocks, seed)
    placed = _placed(sized, weights, shards, seed)
    joined = sized.join(placed, same(sized, placed, "source", "block"))
    return joined.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "draws"
    )


@shielded
def mixture(
    docs: DataFrame,
    id_column: str = "doc_id",
    weights: tuple[float, ...] = WEIGHTS,
    shards: int = 16,
    blocks: int = 1024,
    seed: int = 11,
) -> DataFrame:
    """The mixture itself: ``docs`` with a row per copy taken, plus ``mix_shard`` and ``mix_order``.

    Rows come ordered by shard and, inside a shard, by a seeded hash; a shard
    may span several partitions. Every row is taken as often as ``mix`` says of it, whether
    or not it has an id or shares it with others.
    """
    placed = _placed(_sized(docs, id_column, blocks, seed), weights, shards, seed).where("copies > 0")
    drawn = placed.select(F.col("source").alias("__source"), F.col("block").alias("__block"), F.posexplode("draws").alias("__copy", "mix_shard"))
    hashed = F.xxhash64(F.col(id_column), F.col("text"), F.lit(seed + 2))
    rows = docs.withColumns({"__from": F.col("source").cast("string"), "__in": _block(id_column, blocks, seed), "__hash": hashed})
    rows = rows.join(drawn, F.col("__from").eqNullSafe(F.col("__source")) & (F.col("__in") == F.col("__block")))
    rows = rows.select(*docs.columns, "mix_shard", F.xxhash64("__hash", "__copy").alias("mix_order"))
    return rows.repartitionByRange("mix_shard", "mix_order").sortWithinPartitions("mix_shard", "mix_order")
