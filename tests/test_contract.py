"""Driver contract and registry hygiene."""

import re

import __spark_entry__ as E
from cuenca.plans.registry import load_all


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["order_month", "category", "total_revenue", "num_orders"]
    assert df.count() > 0


def test_keys_and_oracles():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    for k in load_all():
        assert k in q and re.match(r"^[a-z]{2,3}\d{2}_[a-z0-9_]+$", k), k
    assert len(q) >= 200
