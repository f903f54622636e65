"""Every registered query against its SQL, on the smallest scale."""

import pytest

from __spark_entry__ import oracle_sql, queries
from granary.catalogue import QUERIES
from oracle import SQL as OWN_SQL
from tests.oracle_check import compare, connect

SQL = oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(OWN_SQL)
    assert set(queries()) >= set(QUERIES) and set(queries()) >= set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, folder, name):
    pytest.importorskip("duckdb")
    assert compare(spark, connect(folder), folder, queries()[name], SQL[name]) == ""


def test_order_grain_revenue_at_the_next_scale(spark, folder):
    """Known total: each order that has a line, counted once."""
    row = queries()["executive_summary_by_order"](spark, folder.replace("sf0.001", "sf0.01")).first()
    assert (row["total_transacoes"], row["receita_total_periodo"]) == (14743, 3693002448.96)
