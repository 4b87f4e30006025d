"""Every registered query that has SQL gives the same rows as DuckDB on the smallest tables."""

import os
from collections import Counter

import pytest

duckdb = pytest.importorskip("duckdb")


def _plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    if hasattr(v, "tzinfo") and hasattr(v, "hour"):
        return v.replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for f in os.listdir(sf):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    return con


def _names():
    from folioscope.plans import catalog

    return sorted(catalog.oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_same_rows(spark, sf, db, name):
    from folioscope.plans import catalog

    df = catalog.queries()[name](spark, sf)
    columns = sorted(df.columns)
    ours = Counter(repr(tuple(_plain(r[c]) for c in columns)) for r in df.collect())
    found = db.sql(catalog.oracle_sql()[name])
    assert sorted(found.columns) == columns
    places = [found.columns.index(c) for c in columns]
    theirs = Counter(repr(tuple(_plain(r[i]) for i in places)) for r in found.fetchall())
    assert ours == theirs


def test_queries_without_sql_run(spark, sf):
    from folioscope.plans import catalog

    for name in set(catalog.queries()) - set(catalog.oracle_sql()):
        assert catalog.queries()[name](spark, sf).schema is not None


def test_entry_works_without_the_subpackage():
    import importlib.util

    import __spark_entry__ as entry

    assert "keywords_tfidf_documents" in entry.queries()
    assert any(n.startswith("p1_") for n in entry.queries()) == (importlib.util.find_spec("folioscope.llm") is not None)
