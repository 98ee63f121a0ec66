"""Every query with an SQL twin gives the same rows, names and values in DuckDB."""

import pytest
from conftest import SF_DIR, plain

from tidemill.plans import load_all
from tidemill.plans.registry import QUERIES, TWINS

load_all()


@pytest.mark.parametrize("name", sorted(TWINS))
def test_matches_twin(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    result = duck.execute(TWINS[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    theirs = sorted(tuple(plain(row[i]) for i in at) for row in result.fetchall())
    assert ours == theirs


def test_contract():
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) >= 190
