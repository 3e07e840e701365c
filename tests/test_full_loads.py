"""Landings that hold all rows, also those that an oracle does not name."""

from pyspark.sql import functions as F

from cuenca.plans import sinks, sources
from cuenca.sinks.manifest import read_table
from cuenca.sources.tables import Tables

from conftest import SF_SMALL


def test_snk02_lands_the_orders_of_every_year(spark, tmp_path):
    orders = Tables(spark, SF_SMALL).orders
    sinks.land_orders(orders, str(tmp_path / "o"))
    got = {str(r["dt"]): r["n"] for r in read_table(spark, str(tmp_path / "o")).groupBy("dt").agg(F.count(F.lit(1)).alias("n")).collect()}
    kept = orders.where((F.year("o_orderdate") != 1998) | (F.col("o_orderstatus") != "P"))
    want = {f"2026-01-{14 - 1998 + r['y']:02d}": r["n"] for r in kept.groupBy(F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == want and len(want) > 2


def test_src16_loads_every_relational_table(spark, tmp_path):
    t = Tables(spark, SF_SMALL)
    sources.full_load(t, str(tmp_path))
    assert {p.name for p in tmp_path.iterdir()} == {f"parquet_{n}" for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")}
    for p in tmp_path.iterdir():
        assert spark.read.parquet(str(p)).count() == getattr(t, p.name.removeprefix("parquet_")).count()
