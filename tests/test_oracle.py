"""Every catalogue query against its SQL at the smallest scale."""

from __future__ import annotations

import pytest
from oracle import connect, difference

from catalog import ORACLE, QUERIES


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, connection, folder, name):
    assert difference(spark, connection, name, QUERIES[name], ORACLE[name], folder) is None


def test_entry_gives_instruction_rows(spark):
    import __spark_entry__ as contract

    frame = contract.entry(spark)
    assert frame.columns == ["INSTRUCTION", "RESPONSE", "SOURCE", "METADATA"]
    assert frame.count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
