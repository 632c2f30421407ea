import re

import pytest
from checks.compare import duck, rows_of
from posgraph.llm.queries import ORACLE, QUERIES

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def test_one_query_per_operator_and_the_pipeline():
    names = list(E.queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_its_sql(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    rel = duck(SF_SMALL).sql(ORACLE[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())
