import pytest

import __spark_entry__ as entry
from talus.plans import queries as persona
from tests.compare import rows, views
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def db():
    return views(SMALL)


@pytest.mark.parametrize("name", sorted(persona.ORACLES))
def test_query_equals_its_sql(spark, db, name):
    found, told = persona.QUERIES[name](spark, SMALL).toPandas(), db.sql(persona.ORACLES[name]).df()
    assert sorted(found.columns) == sorted(told.columns)
    assert rows(found) == rows(told)


def test_stub_extraction_gives_every_dimension(spark):
    found = persona.QUERIES["llm_extract_stub"](spark, SMALL).collect()
    assert len(found) == 200 and {r["fields"] for r in found} == {8}


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
