"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
import oracle
from vigilspark import catalog

catalog.load_all()

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_sql():
    assert set(catalog.ORACLES) == set(catalog.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, con, name):
    _, difference = oracle.compare(spark, con, name, SF)
    assert difference is None, difference


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "prr" in df.columns


def test_a_registered_query_casts_strictly(spark, monkeypatch):
    from vigilspark.catalog import scalars

    monkeypatch.setattr(scalars, "table", lambda *_: spark.sql("SELECT 1L AS o_orderkey, make_date(12345, 1, 1) AS o_orderdate"))
    with pytest.raises(Exception, match="does not fit date"):
        catalog.QUERIES["cast_date_strict_raises"](spark, SF).collect()
