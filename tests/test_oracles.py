"""Every query with SQL against DuckDB on the smallest tables; every other one runs with its schema."""

import pytest

from corpusloom.plans import cases, general, reference

CORE = general.QUERIES | reference.QUERIES | cases.QUERIES
SQL = general.ORACLES | reference.ORACLES | cases.ORACLES


def normal(frame):
    columns = sorted(frame.columns)
    return columns, sorted(repr([None if v is None or v != v else round(v, 9) if isinstance(v, float) else str(v) for v in row]) for row in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, sf_dir, duck, name):
    found = CORE[name](spark, sf_dir).toPandas()
    if name in SQL:
        assert normal(found) == normal(duck.sql(SQL[name]).df())
    else:
        assert len(found.columns) > 0


def test_entry_and_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(CORE) <= set(entry.queries())
