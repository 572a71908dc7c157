"""The registered queries: names, and those that SQL can express against their texts."""

import pytest

import __spark_entry__ as entry_module
from compare import duck, duck_rows, spark_rows
from tidemark.llm import queries

QUERIES, TEXTS = queries.all_queries(), queries.oracle_sql()


def test_all_operators_and_the_pipeline():
    numbered = sorted(int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op"))
    assert numbered == list(range(1, 14)) and "pipeline" in QUERIES
    assert QUERIES.keys() <= entry_module.queries().keys()


@pytest.mark.parametrize("name", TEXTS)
def test_equals_the_sql_text(spark, small, name):
    df = QUERIES[name](spark, small)
    expected, columns = duck_rows(duck(small), TEXTS[name])
    assert sorted(df.columns) == columns and expected
    assert spark_rows(df) == expected


@pytest.mark.parametrize("name", QUERIES)
def test_runs_on_the_smallest_tables(spark, smallest, name):
    assert QUERIES[name](spark, smallest).count() > 0
