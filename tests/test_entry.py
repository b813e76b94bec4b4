import os

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SMALL = "/root/testdata/sf0.001"
#: Queries that apply a fitted model; tests of their operators hold them against plain models.
NO_SQL = {
    "multinomial_predict", "tokens_learned", "tokens_learned_agreement", "sentences_learned", "token_tags_by_context",
    "entity_probabilities", "entity_ensemble_heaviest",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")


@pytest.fixture(scope="module")
def tables():
    return connect(SMALL)


QUERIES = {name: query for family in entry.FAMILIES for name, query in family.QUERIES.items()}


def test_every_query_has_sql(spark):
    assert set(QUERIES) - set(entry.oracle_sql()) == NO_SQL
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "cnt"]
    assert df.count() == 1000


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, tables, name):
    query = QUERIES[name]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert query(spark, SMALL).count() > 0
        return
    ok, note = compare(spark, tables, SMALL, name, query, sql)
    assert ok, note
