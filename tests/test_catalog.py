"""Every query with a statement gives the statement's rows on the smallest tables."""

import pytest

from groundmill import catalog

from .compare import assert_same
from .conftest import DATA


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_statement(spark, name):
    assert_same(catalog.QUERIES[name](spark, DATA), catalog.ORACLE_SQL[name], DATA)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_other_queries_give_rows(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["item_id", "doc_id", "chunk_ord", "chunk_id", "shared", "n_tokens"]
