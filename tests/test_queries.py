"""Every registered query against its SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as entry_module
from tests.oracle import compare
from vectrail.plans import ORACLES, QUERIES
from vectrail.plans import lexing_sql
from vectrail.functions import text

# Queries that rightly give no rows on these tables.
EMPTY = {"j3_hybrid_search_no_hit"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, folder, duck, name):
    df = QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name in ORACLES:
        _, fault = compare(df, duck, ORACLES[name])
        assert fault is None
    else:
        assert df.count() > 0


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 10 and rows[0]["vec_id"] == 7


def test_registry_and_checks_agree():
    queries, checks = entry_module.queries(), entry_module.oracle_sql()
    assert set(checks) <= set(queries)
    assert len(queries) > 150


@pytest.mark.parametrize("language", list(text.STEM_RULES))
def test_stop_words_of_check_and_library(spark, language):
    assert set(lexing_sql.stop_words(language)) == set(text.stop_words(language))
