"""Sources, guards and the course's sales-cleaning golden files."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cuenca.operators import documents as D
from cuenca.operators.ingest import clean_sales, to_silver
from cuenca.sources import files as S

from conftest import FIXTURES

SALES = os.path.join(FIXTURES, "sales")


def test_sales_clean_matches_golden_output(spark):
    df = S.read_csv(spark, f"{SALES}/sales.csv")
    out = clean_sales(df, 0, inclusive=False).select("order_id", "customer_id", "amount", "order_date")
    gold = S.read_csv(spark, f"{SALES}/sales_clean.csv")
    got = sorted((int(r.order_id), r.customer_id, r.amount, str(r.order_date)) for r in out.collect())
    exp = sorted((int(r.order_id), r.customer_id, float(r.amount), r.order_date) for r in gold.collect())
    assert got == exp


def test_daily_clean_keeps_zero_drops_negative(spark):
    df = S.read_csv(spark, f"{SALES}/sales_2025-01-01.csv", schema=S.all_string_schema(
        ["order_id", "customer_id", "amount", "order_date"]))
    out = clean_sales(df, 0, inclusive=True)
    assert sorted(r.amount for r in out.collect()) == [0.0, 100.0, 250.5, 300.0]


def test_wrong_separator_is_detected(spark, tmp_path):
    p = str(tmp_path / "taxi")
    spark.createDataFrame([(1, 2.5)], "VendorID int, total double").write.option("header", True) \
        .option("sep", "|").csv(p)
    wrong = S.read_csv(spark, p, sep=",")
    with pytest.raises(S.InputContractError):
        S.check_separator(wrong, "taxi", ",")
    assert S.detect_separator(spark, p) == "|"


def test_required_columns_and_exact_header(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    S.require_columns(df, ["a"], "x")
    with pytest.raises(S.InputContractError):
        S.require_columns(df, ["a", "c"], "x")
    with pytest.raises(S.InputContractError):
        S.require_columns(df, ["b", "a"], "x", exact=True)


def test_all_string_read_then_try_cast(spark):
    raw = spark.createDataFrame([("O1", "C1", "2026-01-10T10:12:00", "ok", "12.50", "COP"),
                                 ("O2", "C1", "not a time", "ok", "n/a", "COP")],
                                "order_id string, customer_id string, order_ts string, status string, "
                                "total_amount string, currency string")
    s = {r.order_id: r for r in to_silver(raw, "orders").collect()}
    assert str(s["O1"].total_amount) == "12.50" and s["O2"].total_amount is None
    assert s["O2"].order_ts is None


def test_payload_shapes_and_flatten(spark):
    schema = "id long, meta struct<region: string, valor: double>"
    raw = spark.createDataFrame([('{"data": [{"id": 1, "meta": {"region": "A", "valor": 1.5}}]}',),
                                 ('{"result": [{"id": 2, "meta": {"region": "B", "valor": 2.0}}]}',),
                                 ('[{"id": 3, "meta": {"region": "C", "valor": 3.0}}]',)], "body string")
    from pyspark.sql.types import _parse_datatype_string
    out = D.flatten(D.unwrap_payload(raw, "body", _parse_datatype_string(schema)))
    assert out.columns == ["id", "meta.region", "meta.valor"]
    assert sorted(r[0] for r in out.collect()) == [1, 2, 3]


def test_harmonise_monthly_files(spark):
    a = spark.createDataFrame([("1", "10,50", "2025-01-01")], "ID string, monto string, fecha string")
    b = spark.createDataFrame([("2", "3.25")], "order_id string, amount string")
    out = S.harmonise([a, b], {"id": "order_id", "monto": "amount", "fecha": "order_date"},
                      decimal_comma=["amount"], casts={"amount": "decimal(18,2)"})
    got = sorted((r.order_id, str(r.amount), r.order_date) for r in out.collect())
    assert got == [("1", "10.50", "2025-01-01"), ("2", "3.25", None)]


def test_find_time_column(spark):
    df = spark.createDataFrame([(1, "x")], "Fecha int, region string")
    assert S.find_time_column(df) == "Fecha"
    assert S.find_time_column(spark.createDataFrame([(1,)], "v int")) is None


def test_raw_to_silver_gate_blocks_write(spark, tmp_path):
    """Quality gate: the report is written, the job fails, silver is not written."""
    from cuenca.operators.ingest import raw_to_silver
    from cuenca.operators.quality import QualityGateError
    raw = str(tmp_path / "raw")
    spark.createDataFrame([("O1", "C1", "2026-01-10T10:12:00", "ok", "12.50", "COP"),
                           ("O1", "C2", "2026-01-10T11:00:00", "ok", "-3.00", "COP")],
                          "order_id string, customer_id string, order_ts string, status string, "
                          "total_amount string, currency string").write.option("header", True).csv(raw)
    out, rep = str(tmp_path / "silver"), str(tmp_path / "report")
    with pytest.raises(QualityGateError):
        raw_to_silver(spark, "orders", raw, out, "erp", "2026-01-14", quality_path=rep)
    assert os.path.exists(rep) and not os.path.exists(out)


def test_native_parser_equals_pandas_udf(spark):
    """The positional line parser in native columns gives the same rows as a
    vectorised pandas UDF doing the same parse (the UDF is only a reference)."""
    import pandas as pd

    from cuenca.plans.scalars import parse_lines
    lines = spark.createDataFrame([("order_id,line,product_id,qty,flag,ship_date",),
                                   ("1,2,3,4,A,2025-01-02",), ("5,6,x,8,N,2025-13-01",)], "value string")

    @F.pandas_udf("order_id long, line int, product_id long, qty int, flag string, ship_date date")
    def parse(s: pd.Series) -> pd.DataFrame:
        f = s.str.split(",", expand=True)
        return pd.DataFrame({
            "order_id": pd.to_numeric(f[0], errors="coerce").astype("Int64"),
            "line": pd.to_numeric(f[1], errors="coerce").astype("Int32"),
            "product_id": pd.to_numeric(f[2], errors="coerce").astype("Int64"),
            "qty": pd.to_numeric(f[3], errors="coerce").astype("Int32"),
            "flag": f[4],
            "ship_date": pd.to_datetime(f[5], errors="coerce", format="%Y-%m-%d").dt.date})

    body = lines.where(~F.col("value").startswith("order_id,"))
    via_udf = body.select(parse("value").alias("r")).select("r.*")
    native = parse_lines(lines)
    norm = lambda df: sorted(tuple(str(x) for x in r) for r in df.collect())
    assert norm(native) == norm(via_udf)


def test_empty_payload_is_an_error(spark):
    from pyspark.sql.types import _parse_datatype_string

    from cuenca.operators.ingest import EmptyPayloadError, load_payload
    raw = spark.createDataFrame([('{"data": []}',), ('{"result": []}',)], "body string")
    with pytest.raises(EmptyPayloadError):
        load_payload(raw, "body", _parse_datatype_string("fecha string, valor double"))
    ok = spark.createDataFrame([('{"data": [{"fecha": "2024-01-01 10:00:00", "valor": 1.5}]}',)], "body string")
    r = load_payload(ok, "body", _parse_datatype_string("fecha string, valor double")).first()
    assert str(r.fecha) == "2024-01-01 10:00:00" and r.valor == 1.5


def test_harmonise_thousands_points(spark):
    from cuenca.sources.files import harmonise
    df = spark.createDataFrame([("1.234,56",), ("12,5",), ("1.234.567,00",), ("99.5",), ("x",), (None,), (" 7 ",)], "monto string")
    out = harmonise([df], {"monto": "amount"}, decimal_comma=["amount"], casts={"amount": "decimal(18,2)"})
    assert [None if r.amount is None else float(r.amount) for r in out.collect()] == [1234.56, 12.5, 1234567.0, 99.5, None, None, 7.0]


def test_month_files_are_in_time_order(spark, tmp_path):
    import glob
    import pyarrow.parquet as pq
    from cuenca.sinks.writers import write_by_month
    df = spark.range(5000).selectExpr("id", "timestamp'2024-01-01' + make_interval(0,0,0,0,0,0, pmod(id * 7919, 8000000)) AS ts")
    write_by_month(df, str(tmp_path / "m"), "ts")
    files = glob.glob(str(tmp_path / "m/**/*.parquet"), recursive=True)
    assert files
    for f in files:
        ts = pq.ParquetFile(f).read(columns=["ts"]).column("ts").to_pylist()
        assert ts == sorted(ts)


def test_payloads_with_empty_data_and_rejects(spark):
    from cuenca.operators.documents import rejected_payloads, unwrap_payload
    df = spark.createDataFrame([('{"data": [], "result": [{"id": 1}, {"id": 2}]}',), ('{"data": [{"id": 3}], "result": [{"id": 9}]}',),
                                ('[{"id": 4}]',), ("not json",), ('{"data": []}',), (None,)], "body string")
    from pyspark.sql.types import LongType, StructField, StructType
    rec = StructType([StructField("id", LongType())])
    assert sorted(r.id for r in unwrap_payload(df, "body", rec).collect()) == [1, 2, 3, 4]
    assert rejected_payloads(df, "body", rec).count() == 3


def test_inferred_whole_numbers_are_bigint(spark, tmp_path):
    for name, ids in (("small", [1, 2]), ("large", [1, 3_000_000_000])):
        spark.createDataFrame([(i, 1.5, "x") for i in ids], "`a id` long, b double, c string").write.option("header", True).csv(str(tmp_path / name))
        assert S.read_csv(spark, str(tmp_path / name), infer=True).dtypes == [("a id", "bigint"), ("b", "double"), ("c", "string")]


def test_a_rewritten_table_is_read_with_its_own_schema(spark, tmp_path):
    import time

    from cuenca.sources.tables import read_table
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "region.parquet"))
    assert read_table(spark, str(tmp_path), "region").columns == ["a"]
    time.sleep(1.1)
    spark.createDataFrame([("x", 2)], "b string, c int").write.mode("overwrite").parquet(str(tmp_path / "region.parquet"))
    assert [tuple(r) for r in read_table(spark, str(tmp_path), "region").collect()] == [("x", 2)]
