"""Each query of the operators: against its SQL, or against the brute-force test that is named here."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from salesprep.llm.oracle import ORACLE
from salesprep.llm.queries import QUERIES

#: Queries that SQL cannot express, and the module that holds their results against a plain version.
PLAIN = {
    "op2_decontamination": "test_text_operators",
    "op3_quality_rules": "test_text_operators",
    "op4_simhash": "test_simhash",
    "op5_best_fit_packing": "test_packing",
    "op6_suffix_dedup": "test_suffix_dedup",
    "op7_language_id": "test_text_operators",
    "op9_html_extraction": "test_text_operators",
    "op10_quality_classifier": "test_text_operators",
    "op11_minimum_slack_packing": "test_slack_packing",
}


def test_every_query_is_held_against_something():
    assert QUERIES.keys() == ORACLE.keys() | PLAIN.keys() and not ORACLE.keys() & PLAIN.keys()
    here = Path(__file__).parent
    assert all((here / f"{module}.py").exists() for module in PLAIN.values())


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        connection.sql(f"create view {file.stem} as select * from '{file}'")
    return connection


@pytest.mark.parametrize("name", ORACLE)
def test_same_rows_as_sql(spark, duck, sf, name):
    ours, theirs = QUERIES[name](spark, sf), duck.sql(ORACLE[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    rows = Counter(tuple(row[c] for c in columns) for row in ours.collect())
    assert rows == Counter(map(tuple, theirs.select(", ".join(f'"{c}"' for c in columns)).fetchall())) and rows
