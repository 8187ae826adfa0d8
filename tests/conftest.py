import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from emisplit.functions import inline_table  # noqa: E402
from emisplit.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tables of a few rows: compiling each plan would take most of the time.
    # The contract tests switch compilation on again.
    settings = {"spark.sql.shuffle.partitions": "2", "spark.sql.codegen.wholeStage": "false"}
    session = local_session("tests", "4", **settings)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Small table from rows and a column list."""
    return lambda rows, ddl: inline_table(spark, rows, ddl)


def values(rows, *columns):
    """Sorted tuples of a result, decimals as floats."""
    from decimal import Decimal

    def plain(v):
        return float(v) if isinstance(v, Decimal) else v

    return sorted(tuple(plain(v) for v in r) for r in rows.select(*columns).collect())
