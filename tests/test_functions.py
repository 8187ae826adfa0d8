from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from emisplit.functions import grouping, inline_table, salted, store, totals


def test_store_rounds_half_away_from_zero(table):
    rows = table([(0.123456785,), (-0.123456785,), (0.000000004,)], "x double")
    got = [r[0] for r in rows.select(store("x", 15, 8)).collect()]
    assert got == [Decimal("0.12345679"), Decimal("-0.12345679"), Decimal("0E-8")]


def test_store_overflow_raises(table):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        table([(12345.6,)], "x double").select(store("x", 12, 8)).collect()


def test_inline_table_keeps_types(spark):
    rows = inline_table(spark, [("0001", True, 1.5), (None, None, None)], "a string, b boolean, c decimal(10,6)")
    assert [tuple(r) for r in rows.collect()] == [("0001", True, Decimal("1.500000")), (None, None, None)]
    assert inline_table(spark, [], "a string").count() == 0


@pytest.mark.parametrize("salts", [None, 1, 2, 4096])
def test_totals_agree_at_any_number_of_shares(table, salts, monkeypatch):
    """Repeated rows, a NULL key, NULL values and groups without a value included; None is a window over the group."""
    monkeypatch.setattr(grouping, "SALTS", salts)
    cut = lambda rows: salted(rows, "v") if salts else rows
    data = [("a", i % 4) for i in range(9)] + [("b", 7), ("c", 1), ("c", 2), (None, 5), (None, 6), ("d", None)]
    rows = table(data, "k string, v int")
    got = totals(cut(rows), ["k"], total=(F.sum, F.col("v")), low=(F.min, F.col("v")), top=(F.max, F.struct("v")))
    again = totals(got.withColumn("w", F.col("v") * F.col("total")), ["k"], again=(F.sum, F.col("w")))
    want = []
    for key, value in data:
        group = [v for k, v in data if k == key and v is not None]
        total = sum(group) if group else None
        want.append((key, value, total, min(group, default=None), total * total if group else None))
    rows = [tuple(r) for r in again.select("k", "v", "total", "low", "again").collect()]
    assert sorted(rows, key=str) == sorted(want, key=str)
    assert totals(cut(table([], "k string, v int")), ["k"], n=(F.sum, F.col("v"))).count() == 0


def test_totals_keep_the_decimal_type(table):
    rows = salted(table([("a", "1.5")], "k string, v decimal(15,8)"), "v")
    assert totals(rows, ["k"], t=(F.sum, F.col("v"))).schema["t"].dataType.simpleString() == "decimal(25,8)"
