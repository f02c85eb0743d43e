"""Every bound query equals its DuckDB SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from panelflow.queries import ORACLE_SQL as SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.oracle import FORBIDDEN, compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in SQL, f"{name} has no oracle SQL"
    plans = {}
    problems, _, _ = compare(spark, name, QUERIES[name], SQL[name], SF_SMALL, con, plans)
    assert not problems, problems
    bad = [n for n in FORBIDDEN if n in plans[name]]
    assert not bad, f"{name} plan contains {bad}"


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["ref_date", "count_df", "count_raw", "matched"]
    assert rows and all(r.matched for r in rows)
