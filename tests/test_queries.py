"""Every query of the sales library against its SQL counterpart, and what its plan may not hold."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from checks.oracle import oracle
from checks.queries import QUERIES
from helpers import plan_of
from salesprep.functions import months

DATA = "/root/testdata/sf0.001"
ORACLE = oracle()

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.sql(f"create view {file.stem} as select * from '{file}'")
    return connection


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= entry_points.queries().items() and ORACLE.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, duck, name):
    ours = QUERIES[name](spark, DATA)
    plan = plan_of(ours)
    for unwanted in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert unwanted not in plan
    theirs = duck.sql(ORACLE[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    rows = Counter(tuple(row[c] for c in columns) for row in ours.collect())
    picked = theirs.select(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert rows == Counter(map(tuple, picked))
    assert rows


def test_entry(spark):
    assert entry_points.entry(spark).columns == [f"V{n}" for n in range(1, 18)]


def test_month_shape_is_anchored():
    assert months.MONTH_SHAPE.startswith("^") and months.MONTH_SHAPE.endswith("$")
