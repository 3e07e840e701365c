"""Quality rules, report, gate and quarantine on inline rows with the bad
cases of the course's negative-insert exercise."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cuenca.operators import quality as Q
from cuenca.operators.quality import Rule

ROWS = [("O1", "C1", 10.0, "2025-01-01"), ("O2", None, -5.0, "2025-13-01"),
        ("O2", "C3", None, "2025-01-03"), (None, "", 7.0, None)]
SCHEMA = "order_id string, customer_id string, amount double, d string"


def rules():
    return [Rule("nn_order", "not_null", ["order_id"]),
            Rule("nn_customer", "not_null_or_empty", ["customer_id"]),
            Rule("amount_ok", "check", expr=F.col("amount").isNotNull() & (F.col("amount") >= 0)),
            Rule("date_ok", "date_format", ["d"]),
            Rule("unique_order", "unique", ["order_id"])]


def test_evaluate_counts_each_rule(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {r.rule: r.violations for r in Q.evaluate(df, "orders", rules()).collect()}
    assert got == {"nn_order": 1, "nn_customer": 2, "amount_ok": 2, "date_ok": 1, "unique_order": 1}


def test_gate_writes_report_then_fails(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    path = os.path.join(tempfile.mkdtemp(), "report")
    with pytest.raises(Q.QualityGateError):
        Q.gate(Q.report(df, "orders", rules()), path)
    files = [f for f in os.listdir(path) if f.endswith(".json")]
    rep = json.loads(open(os.path.join(path, files[0])).readline())
    assert rep["row_count"] == 4 and rep["violations_total"] == 7


def test_gate_passes_clean_data(spark):
    df = spark.createDataFrame(ROWS[:1], SCHEMA)
    assert Q.gate(Q.report(df, "orders", rules()))["orders"]["violations_total"] == 0


def test_quarantine_gives_reasons(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    good, bad = Q.quarantine(df, rules())
    assert good.count() == 1
    reasons = sorted(sorted(r.reasons) for r in bad.collect() if r.order_id == "O2")
    assert reasons == [["amount_ok"], ["amount_ok", "date_ok", "nn_customer"]]


def test_foreign_key_ignores_null_keys(spark):
    child = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, p string")
    parent = spark.createDataFrame([("a",)], "pk string")
    r = Q.evaluate(child, "c", [Rule("fk", "foreign_key", ["p"], parent=parent, parent_columns=["pk"])])
    assert r.first().violations == 1


def test_foreign_keys_read_each_table_once(spark):
    from pyspark.sql import functions as F

    from cuenca.operators import quality as Q
    items = spark.createDataFrame([(1, 1, "a")] * 5 + [(2, 9, "a"), (None, 1, "b"), (3, None, "b"), (9, 1, None)], "o int, p int, s string")
    orders = spark.createDataFrame([(1, 7), (2, 8), (2, 8), (3, None)], "o int, c int")
    parts, customers = spark.createDataFrame([(1,)], "p int"), spark.createDataFrame([(7,), (None,)], "c int")
    rel = [Q.Relation("io", "items", "items", ["o"], "orders", ["o"]), Q.Relation("ip", "items", "items", ["p"], "parts", ["p"]),
           Q.Relation("oc", "orders", "orders", ["c"], "customers", ["c"]), Q.Relation("self", "items", "items", ["o", "p"], "items", ["o", "p"]),
           Q.Relation("two", "items", "items", ["o", "s"], "orders", ["o", "c"])]
    tables = {"items": items, "orders": orders, "parts": parts, "customers": customers}
    got = {r["rule"]: r["violations"] for r in Q.foreign_keys(tables, rel).collect()}
    assert got == {"io": 1, "ip": 1, "oc": 2, "self": 0, "two": 7}
    empty = {k: df.limit(0) for k, df in tables.items()}
    assert {r["violations"] for r in Q.foreign_keys(empty, rel).collect()} == {0}


def test_dq08_scans_each_table_once(spark):
    from cuenca.plans.registry import load_all

    from conftest import SF_SMALL
    plan = load_all()["dq08_foreign_keys"].build(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 6
