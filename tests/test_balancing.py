"""Stock balancing against the course's golden transfer-order file."""

import os

import pandas as pd
from pyspark.sql import functions as F

from cuenca.operators import balancing as B
from cuenca.sources.files import check_separator, read_csv, require_columns

from conftest import FIXTURES

D = os.path.join(FIXTURES, "balanceo")


def _inputs(spark):
    v = read_csv(spark, f"{D}/ventas.csv")
    s = read_csv(spark, f"{D}/stock.csv")
    p = read_csv(spark, f"{D}/prioridades.csv")
    for df, name in ((v, "ventas"), (s, "stock"), (p, "prioridades")):
        check_separator(df, name, ",")
    require_columns(v, ["Fecha", "Sucursal", "ID interno", "Temporada", "Cantidad Vendida"], "ventas")
    return v, s, p


def test_greedy_matches_golden_file(spark):
    v, s, p = _inputs(spark)
    out = B.balance(v, s, p, "2026-01-14", 15, mode="greedy", run_ts="20260114_000000")
    got = out.orderBy("seq").drop("seq").toPandas()
    gold = pd.read_csv(f"{D}/gold_ordenes_traslado.csv", sep=";", dtype=str, encoding="utf-8-sig")
    gold["CANTIDAD"] = gold["CANTIDAD"].astype(int)
    got["CANTIDAD"] = got["CANTIDAD"].astype(int)
    assert list(got.columns) == list(gold.columns)
    assert len(got) == len(gold) == 52
    pd.testing.assert_frame_equal(got.reset_index(drop=True), gold.reset_index(drop=True))


def _pairwise(rows):
    """The all-pairs overlap formula over entries given as dicts."""
    out = []
    first = lambda x: (x is not None, x or "")  # noqa: E731  NULLs sort first
    for sku in sorted({r["sku"] for r in rows}):
        side = {k: sorted((r for r in rows if r["sku"] == sku and r["side"] == k),
                          key=lambda r: (r["priority"], first(r["store"]), first(r["season"]))) for k in ("need", "source")}
        spans = {}
        for k in side:
            hi = 0
            for r in side[k]:
                spans[id(r)] = (hi, hi + r["qty"])
                hi += r["qty"]
        for n in side["need"]:
            for s in side["source"]:
                q = min(spans[id(n)][1], spans[id(s)][1]) - max(spans[id(n)][0], spans[id(s)][0])
                if q > 0:
                    out.append((sku, s["store"], s["code"], n["store"], n["season"], n["code"], q))
    return sorted(out, key=repr)


def _swept(alloc):
    return sorted(((r[B.SKU], r["DESDE"], r["orig_corto"], r["HACIA"], r["Temporada"], r["dest_corto"], r["CANTIDAD"])
                   for r in alloc.collect()), key=repr)


def test_interval_variant_equals_pairwise_formula(spark):
    """The sweep gives the same allocations as the all-pairs overlap formula."""
    rows = B.entries(*_inputs(spark), "2026-01-14", 15)
    assert _swept(B.allocate_interval(rows, keep_self=True)) == _pairwise([r.asDict() for r in rows.collect()])


def test_interval_keeps_each_entry_s_own_nulls(spark):
    """Stores without a priorities row, a NULL store and a NULL season."""
    v = spark.createDataFrame([("2026-01-10", s, "1", t, q) for s, t, q in (
        ("S1", "A", 5.0), ("S9", "A", 4.0), ("S2", None, 3.0), (None, "B", 2.0), ("S2", "T", 6.0))],
        "Fecha string, Sucursal string, `ID interno` string, Temporada string, `Cantidad Vendida` double")
    st = spark.createDataFrame([("S1", "1", 4.0), ("S8", "1", 7.0), (None, "1", 3.0), ("S2", "1", 5.0)],
                               "Sucursal string, `ID interno` string, `Stock disponible para la venta` double")
    p = spark.createDataFrame([("S1", "AAA", 1, 2), ("S2", "BBB", 2, 1)],
                              "Sucursal string, codigo_corto string, prioridad_reposicion int, prioridad_retiro int")
    rows = B.entries(v, st, p, "2026-01-14", 15)
    assert {(r["store"], r["code"]) for r in rows.collect() if r["priority"] == 9999} == {("S9", None), ("S8", None), (None, None)}
    want = _pairwise([r.asDict() for r in rows.collect()])
    assert _swept(B.allocate_interval(rows, keep_self=True)) == want
    ids = [r["ID EXT OT"] for r in B.balance(v, st, p, "2026-01-14", mode="interval").collect() if r["DESDE"] == "S8" and r["HACIA"] == "S9"]
    assert all(i.startswith("OT-XXX-YYY-") for i in ids)


def test_job_from_files_to_one_file(spark, tmp_path):
    out = B.balance_files(spark, f"{D}/ventas.csv", f"{D}/stock.csv", f"{D}/prioridades.csv", str(tmp_path), "2026-01-14", "20260114_000000")
    gold = open(f"{D}/gold_ordenes_traslado.csv", encoding="utf-8-sig").read().split()
    got = open(out.removeprefix("file:"), encoding="utf-8-sig").read().split()
    assert got == gold


def test_interval_drops_self_transfers_after_matching(spark):
    v, s, p = _inputs(spark)
    out = B.balance(v, s, p, "2026-01-14", 15, mode="interval", run_ts="20260114_000000")
    assert out.where(F.col("DESDE") == F.col("HACIA")).count() == 0
    ids = [r[0] for r in out.select("ID EXT OT").collect()]
    assert len(ids) == len(set(ids))


def test_greedy_never_over_allocates(spark):
    v, s, p = _inputs(spark)
    rows = B.entries(v, s, p, "2026-01-14", 15)
    alloc = B.allocate_greedy(rows)
    took = alloc.groupBy(F.col(B.SKU).alias("sku"), F.col("DESDE").alias("store")).agg(F.sum("CANTIDAD").alias("t"))
    j = took.join(rows.where("side = 'source'"), ["sku", "store"])
    assert j.count() and j.where(F.col("t") > F.col("qty")).count() == 0
    got = alloc.groupBy(F.col(B.SKU).alias("sku"), F.col("HACIA").alias("store"), F.col("Temporada").alias("season")).agg(
        F.sum("CANTIDAD").alias("g"))
    j2 = got.join(rows.where("side = 'need'"), ["sku", "store", "season"])
    assert j2.count() and j2.where(F.col("g") > F.col("qty")).count() == 0


def _walk(rows):
    """The greedy rule step by step."""
    first = lambda x: (x is not None, x or "")
    out = []
    for sku in {r["sku"] for r in rows}:
        side = {k: sorted((r for r in rows if r["sku"] == sku and r["side"] == k and r["store"] is not None),
                          key=lambda r: (r["priority"], first(r["store"]), first(r["season"]))) for k in ("need", "source")}
        left = [s["qty"] for s in side["source"]]
        for i, n in enumerate(side["need"]):
            want = n["qty"]
            for k, s in enumerate(side["source"]):
                take = 0 if s["store"] == n["store"] else min(want, left[k])
                if take > 0:
                    left[k] -= take
                    want -= take
                    out.append((sku, i, k, n["season"], n["store"], s["store"], n["code"], s["code"], take))
    return sorted(out, key=repr)


def test_native_greedy_equals_the_walk(spark):
    import random
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "a", "b", "only needs"]), side, rng.choice(["S1", "S2", "S3", None]), season, float(rng.randint(1, 9)))
            for season in ("x", "y", None) for side in ("need", "source") for _ in range(40)]
    rows = list({(r[0], r[1], r[2], r[3] if r[1] == "need" else None): r for r in rows if r[0] != "only needs" or r[1] == "need"}.values())
    rows = [(s, side, st, se if side == "need" else None, q, st and st[0] + st[-1], {"S1": 1, "S2": 2}.get(st, 9999)) for s, side, st, se, q in rows]
    df = spark.createDataFrame(rows, "sku string, side string, store string, season string, qty double, code string, priority int")
    out = B.allocate_greedy(df)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((tuple(r) for r in out.collect()), key=repr) == _walk([r.asDict() for r in df.collect()])
    assert B.allocate_greedy(df.limit(0)).count() == 0


def test_dirty_numbers_are_counted_not_fatal(spark):
    v = spark.createDataFrame([("2026-01-10", "S1", "1", "A", "5"), ("2026-01-10", "S1", "1", "A", "abc"), ("2026-01-10", "S2", "1", "A", None)],
                              "Fecha string, Sucursal string, `ID interno` string, Temporada string, `Cantidad Vendida` string")
    st = spark.createDataFrame([("S2", "1", "9"), ("S3", "1", "n/a")], "Sucursal string, `ID interno` string, `Stock disponible para la venta` string")
    p = spark.createDataFrame([("S1", "AAA", "1", "x"), ("S2", "BBB", "2", "1")],
                              "Sucursal string, codigo_corto string, prioridad_reposicion string, prioridad_retiro string")
    for mode in ("greedy", "interval"):
        got = B.balance(v, st, p, "2026-01-14", mode=mode).collect()
        assert [(r["DESDE"], r["HACIA"], r["CANTIDAD"]) for r in got] == [("S2", "S1", 5)]
    assert {(r["input"], r["rejected"]) for r in B.rejects(v, st).collect()} == {("ventas", 1), ("stock", 1)}


def test_interval_shuffles_its_entries_once(spark):
    rows = spark.createDataFrame([("1", "need", "S1", "A", 5.0, "a", 1), ("1", "source", "S2", None, 5.0, "b", 1)],
                                 "sku string, side string, store string, season string, qty double, code string, priority int")
    plan = B.allocate_interval(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange") == 1
