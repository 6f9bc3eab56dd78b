"""Every registered query against its SQL, and the driver's entry point."""

import pytest

import __spark_entry__ as entry
from tests.check_queries import compare, database


@pytest.fixture(scope="module")
def db(sf):
    return database(sf)


def test_keys_agree():
    assert set(entry.own_queries()) == set(entry.own_sql())


@pytest.mark.parametrize("name", list(entry.own_queries()))
def test_query_matches_sql(spark, sf, db, name):
    assert compare(spark, db, sf, name, entry.own_queries()[name], entry.own_sql()[name]) is None


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["fila", "Folio_Key", "comisaria", "Grupo_ID", "Tamano_Grupo", "apartado"]
    assert frame.count() == 1350
