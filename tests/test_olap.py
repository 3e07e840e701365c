"""Cube operators on inline rows: pivot fill semantics, EXCEPT distinct,
ROLLUP markers, grouping sets in one pass."""

from pyspark.sql import functions as F

from cuenca.operators import olap


def _fact(spark):
    return spark.createDataFrame(
        [("A", "x", "F", 10), ("A", "x", "F", 10), ("A", "y", "O", 5), ("B", None, "F", 7)],
        "state string, cat string, status string, v int")


def test_pivot_zero_fill_vs_null_form(spark):
    f = _fact(spark)
    zero = {r.state: (r.F, r.O) for r in olap.pivot(f, ["state"], "status", ["F", "O"],
                                                     F.count(F.lit(1))).collect()}
    null = {r.state: (r.F, r.O) for r in olap.pivot(f, ["state"], "status", ["F", "O"],
                                                     F.count(F.lit(1)), fill=None).collect()}
    assert zero["B"] == (1, 0) and null["B"] == (1, None)


def test_difference_is_distinct(spark):
    f = _fact(spark).select("state", "cat", "v")
    d = olap.difference(f, f.where("state = 'B'"))
    assert sorted(tuple(r) for r in d.collect()) == [("A", "x", 10), ("A", "y", 5)]


def test_rollup_marks_subtotals_apart_from_null_keys(spark):
    f = _fact(spark)
    r = olap.rollup_levels(f, ["state", "cat"], {"v": F.sum("v")}, level_col="lvl").collect()
    rows = {(x.state, x.cat, x.lvl): x.v for x in r}
    assert rows[("B", None, 0)] == 7          # a real NULL category
    assert rows[("B", None, 1)] == 7          # the subtotal of state B
    assert rows[(None, None, 3)] == 32        # grand total


def test_grouping_sets_single_pass(spark):
    f = _fact(spark)
    g = olap.grouping_sets(f, [["state"], ["status"], []], {"v": F.sum("v")})
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan
    assert sorted((r.state, r.status, r.v) for r in g.collect() if r.gid == 3) == [(None, None, 32)]


def test_drill_across_is_key_unique(spark):
    f = _fact(spark)
    a = olap.roll_up(f, ["state"], {"v": F.sum("v")})
    b = olap.roll_up(f, ["state"], {"n": F.count(F.lit(1))})
    assert olap.drill_across(a, b, ["state"]).count() == 2
