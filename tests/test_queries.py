"""Every market query against its SQL on the small tables."""

from __future__ import annotations

import duckdb
import pytest

from sluice.plans.oracle import oracle_sql
from sluice.plans.queries import queries
from tests.oracle import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    assert difference(queries()[name](spark, SF), oracle_sql()[name], con) == ""


@pytest.mark.parametrize("name", ["ob_window_stats_1d", "ob_window_stats_1h"])
def test_books_of_one_instant(spark, tmp_path, name):
    """Orders a whole day of seconds apart are books of one instant, as in tables of more than 86,400 orders."""
    keys = "r // 4 * 7 + r % 4 * 86400 + 1"
    tables = {
        "orders": f"SELECT {keys} AS o_orderkey, TIMESTAMP '2024-01-03' AS o_orderdate FROM range(40) t(r)",
        "lineitem": f"SELECT {keys} AS l_orderkey, r % 5 + 1 AS l_partkey, 1 AS l_suppkey, l::INT AS l_linenumber, 1.0::DOUBLE * l AS l_quantity, (r * 7919 % 101 + l)::DOUBLE AS l_extendedprice, CASE WHEN l % 2 = 0 THEN 'O' ELSE 'F' END AS l_linestatus FROM range(40) t(r), range(1, 5) u(l)",
    }
    for table, sql in tables.items():
        duckdb.execute(f"COPY ({sql}) TO '{tmp_path}/{table}.parquet'")
    assert difference(queries()[name](spark, str(tmp_path)), oracle_sql()[name], connect(tmp_path)) == ""
