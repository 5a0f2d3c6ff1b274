"""Every registered query with an oracle equals its DuckDB SQL (small scale)."""

import pytest

from credlake.plans import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

CHECKED = sorted(ORACLES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, SF_SMALL, name, QUERIES[name], ORACLES[name], tol=0.0)
    assert r.get("ok"), r
    assert "type_diff" not in r, r


def test_every_query_has_an_oracle_or_is_a_model():
    # Rows-only by design: models (no SQL equivalent).
    missing = set(QUERIES) - set(ORACLES)
    assert all(n.startswith("ml_") for n in missing), missing


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0
    assert set(e.oracle_sql()) <= set(e.queries())
