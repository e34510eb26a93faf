"""Every registered query against its DuckDB oracle on the smallest tables."""
import pytest

from survey_helpers import SF_SMALL

import __spark_entry__ as E
from tools.compare import duck_con, norm

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_con(SF_SMALL)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    scols = df.columns
    srows = df.collect()
    rel = con.execute(ORACLE[key])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(scols) == sorted(dcols)
    order = sorted(range(len(scols)), key=lambda i: scols[i])
    dorder = [dcols.index(scols[i]) for i in order]
    s = sorted((tuple(norm(r[i]) for i in order) for r in srows), key=repr)
    d = sorted((tuple(norm(r[i]) for i in dorder) for r in drows), key=repr)
    assert s == d


def test_every_query_has_a_builder():
    assert set(ORACLE) <= set(QUERIES)
    from parcelspark.plans.registry import all_queries

    missing = set(all_queries()) - set(ORACLE)
    assert not missing, missing
