"""Every query of the core beside its SQL on the smallest tables, and the driver's contract."""

import pytest
from oracle import DATA, compare

import __spark_entry__ as e
from caseloom.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()
SLOW = {"gbt_scores", "permutation_importance"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, name):
    assert compare(spark, name, QUERIES[name], SQL.get(name), f"{DATA}/sf0.001")[2] is None


def test_contract(spark):
    assert set(catalogue.queries()) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["p3_found", "p5_found", "p6_found", "fact_daily", "bm25_topk"])
def test_plans_have_no_cross_join(spark, name):
    plan = QUERIES[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_a_missing_library_costs_only_the_queries_on_texts(monkeypatch):
    import builtins
    import sys

    real = builtins.__import__

    def broken(name, *a, **k):
        if name.startswith("caseloom.llm"):
            raise ImportError("no zstandard here")
        return real(name, *a, **k)

    for m in [m for m in sys.modules if m.startswith("caseloom.llm")]:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.setattr(builtins, "__import__", broken)
    assert set(e.queries()) == set(catalogue.queries()) and set(e.oracle_sql()) == set(catalogue.oracle_sql())
