"""Attach a per-group total to every row of the group, at any group size.

Percent-of-total arithmetic needs the sum of a group next to each of its rows.
For groups of up to ``WHOLE`` rows that is a window over the group, and a chain of totals over the same
group or parts of it takes one shuffle. A group may hold any part of all rows, so no task may have to hold a larger one. Its rows
carry a ``salt``, a hash that cuts their group into up to ``SALTS`` shares, and
``totals`` works on shares:

1. a window over each share adds up the share; one of its rows leads it;
2. the leaders of a group meet, at most ``SALTS`` rows, and add up the shares;
3. the leaders return to their shares and hand the total to the other rows.

Either plan reads its input once. A chain on shares grows by the same three windows with every total, and the
first window of a total reuses the partitioning the one before it left. ``emisplit.staging`` tells the groups apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Shares a group is cut into: the largest number of rows of a group that meet
#: in one task, and the factor by which a task's part of it is smaller.
SALTS = 4096

#: Largest group that a window takes whole.
WHOLE = 100_000

#: An aggregate that also combines its own partial results, and what it is of.
Total = tuple[Callable[[Column], Column], Column]


def salted(rows: DataFrame, column: str) -> DataFrame:
    """Add the ``salt``; ``column`` should tell apart the rows of a group."""
    return rows.withColumn("salt", F.pmod(F.xxhash64(column), F.lit(SALTS)).cast("int"))


def totals(rows: DataFrame, keys: list[str], **aggregates: Total) -> DataFrame:
    """Add to each row the aggregates over all rows with the same ``keys``.

    ``rows`` with a ``salt`` are taken share by share. A share is led by the row with the smallest hash, which a
    recomputed task finds again; rows that are equal in all columns can take
    each other's place.
    """
    if "salt" not in rows.columns:
        group = Window.partitionBy(*keys)
        return rows.select("*", *[combine(of).over(group).alias(name) for name, (combine, of) in aggregates.items()])
    others = [c for c in rows.columns if c not in (*keys, "salt")]
    ordered = Window.partitionBy(*keys, "salt").orderBy(F.xxhash64(*others))
    share = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shares = rows.select(
        "*",
        *[combine(of).over(share).alias(name) for name, (combine, of) in aggregates.items()],
        F.when(F.row_number().over(ordered) > 1, F.col("salt")).alias("place"),
    )
    leaders, leads = Window.partitionBy(*keys, "place"), F.col("place").isNull()
    combined = shares.withColumns(
        {
            name: F.when(leads, combine(F.col(name)).over(leaders).cast(shares.schema[name].dataType))
            for name, (combine, _) in aggregates.items()
        }
    )
    back = Window.partitionBy(*keys, "salt")
    return combined.select(*rows.columns, *[F.max(name).over(back).alias(name) for name in aggregates])


def carried(rows: DataFrame, *columns: str) -> list[str]:
    """``columns``, and the salt of rows that have one."""
    return [*columns, *(["salt"] if "salt" in rows.columns else [])]


def splittable(rows: DataFrame, key: str) -> DataFrame:
    """Give an aggregated join side a shuffle of its own.

    Adaptive execution splits a skewed partition only between two shuffles. A
    side that comes straight from an aggregate on the join key has none left;
    computing the key anew makes the join shuffle it once more.
    """
    return rows.withColumn(key, F.concat(F.col(key), F.lit("")))
