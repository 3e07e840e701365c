"""Scratch tables of a step go when its result is written."""

import os

from cuenca.session import delete_table, materialize, scratch_path, scratch_scope


def tables(spark):
    base = scratch_path(spark, "")
    return {d for d in os.listdir(base) if d.startswith("mat-")}


def test_scope_deletes_what_it_does_not_keep(spark):
    outside = materialize(spark.range(2))
    before = tables(spark)
    with scratch_scope(spark) as scope:
        a = materialize(spark.range(5))
        out = materialize(a.where("id > 1"))
        kept = scope.keep_last()
    assert out.count() == 3 and outside.count() == 2
    assert {os.path.basename(kept)} == tables(spark) - before
    delete_table(spark, kept)
    assert tables(spark) == before


def test_scope_deletes_after_a_failure_too(spark):
    before = tables(spark)
    try:
        with scratch_scope(spark):
            materialize(spark.range(5))
            raise RuntimeError("step failed")
    except RuntimeError:
        pass
    assert tables(spark) == before
