"""Queries of this subpackage that SQL can express, against DuckDB."""

import pytest

from railpulse.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import connect, duck_rows, spark_rows
from tests.conftest import SF


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    ours = spark_rows(QUERIES[name](spark, SF))
    assert ours == duck_rows(connect(SF), ORACLE_SQL[name]) and ours[1]


def test_names():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
