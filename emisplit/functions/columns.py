"""Column helpers: fixed-point rounding and small literal tables."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def store(value: Column | str, precision: int, scale: int) -> Column:
    """Round half away from zero to ``decimal(precision, scale)``.

    Every quantity that the data model keeps as a fixed-point number passes
    through here. Sums of such values are then exact and do not depend on the
    order in which tasks deliver their rows. An overflow raises.
    """
    col = F.col(value) if isinstance(value, str) else value
    return col.cast(T.DecimalType(precision, scale))


def double(value: Column | str) -> Column:
    """The operand of a division or product, as a double."""
    col = F.col(value) if isinstance(value, str) else value
    return col.cast("double")


def null_as(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def inline_table(spark: SparkSession, rows: Iterable[Sequence], ddl: str) -> DataFrame:
    """A small driver-side list as a DataFrame, without any Python worker.

    The rows become one literal of the plan, so the table is bounded by the
    list the caller wrote.
    """
    names = T.StructType.fromDDL(ddl).names
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    parsed = F.from_json(F.lit(text), f"array<struct<{ddl}>>", {"mode": "FAILFAST"})
    return spark.range(0, 1, 1, 1).select(F.inline(parsed))
