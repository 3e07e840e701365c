"""Streaming: late data, duplicates, and the record transform."""

import base64
import datetime
import json

from pyspark.sql import functions as F

from cuenca.plans.registry import load_all
from cuenca.streaming import operators as ST

from conftest import SF_SMALL

REG = load_all()


def test_late_rows_are_in_no_window(spark):
    rows = REG["str06_late_data_watermark"].build(spark, SF_SMALL).collect()
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    lo, hi = events.select(F.min("ts"), F.max("ts")).first()
    late = events.where(F.col("ts") < F.lit(lo + (hi - lo) / 3)).count()
    assert late > 0 and {r.late_rows for r in rows} == {late}
    assert min(r.window_start for r in rows) >= (lo + (hi - lo) / 3).replace(minute=0, second=0, microsecond=0)
    assert sum(r.n for r in rows) <= events.count() - late


def test_exactly_once_rerun(spark):
    df = REG["str08_exactly_once_landing"].build(spark, SF_SMALL)
    assert df.count() == df.select("event_id").distinct().count()


def test_records_keep_types_and_never_fail(spark):
    b64 = lambda b: base64.b64encode(b).decode()
    good = {"a": '{"n": 12.5, "t": true, "o": {"x": [1, "2", null]}, "z": null, "s": "q\\"uote \u00e9", "big": 12345678901234}',
            "b": '{"source": "old", "id": 7}', "c": "{}"}
    bad = {"d": b64(b"\xff\xfe{}"), "e": "%%not base64%%", "f": b64(b"[1,2]"), "g": b64(b"{broken"), "h": None, "i": b64(b"")}
    rows = [(k, b64(v.encode())) for k, v in good.items()] + list(bad.items())
    out = {r.recordId: r for r in ST.enrich_records(spark.createDataFrame(rows, "recordId string, data string"), "NEW").collect()}
    for k, v in good.items():
        assert out[k].result == "Ok"
        assert json.loads(base64.b64decode(out[k].data)) == json.loads(v) | {"source": "NEW"}
    for k, v in bad.items():
        assert (out[k].result, out[k].data) == ("ProcessingFailed", v)


def test_late_rows_come_from_the_run(spark):
    """Three cuts against the plain rule: the third file is judged by the
    watermark of the first (latest event - 1 hour) and late by its window's end."""
    from cuenca.plans.streams import reversed_deliveries
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    lo, hi = e.select(F.min("ts"), F.max("ts")).first()
    span, closes = hi - lo, hi - datetime.timedelta(hours=1)
    for cuts in ([lo + span * 0.9, lo + span * 0.1, lo], [hi - datetime.timedelta(minutes=20), hi - datetime.timedelta(minutes=50), lo],
                 [lo + span / 2, lo + span / 2 - datetime.timedelta(hours=9), lo]):
        closed, late = reversed_deliveries(spark, e, cuts)
        end = F.date_trunc("hour", "ts").cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR")
        want = e.where((F.col("ts") < F.lit(cuts[1])) & (end <= F.lit(closes))).count()
        assert late == want > 0
        assert (closed.agg(F.sum("n")).first()[0] or 0) <= e.count() - want


def _readings(spark, folder, files, schema="user_id long, event_id long, ts timestamp, value double"):
    import time
    at = lambda minute: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute)
    for k, rows in enumerate(files):
        spark.createDataFrame([(u, i, at(m), v) for u, i, m, v in rows], schema).coalesce(1).write.parquet(f"{folder}/f{k}")
        time.sleep(0.02)
    return ST.file_stream(spark, folder, schema, max_files=1, recursiveFileLookup=True)


def _jumps(spark, tmp_path, files, **options):
    s = _readings(spark, str(tmp_path / "in"), files)
    ST.run_available(ST.flag_jumps(s, 10.0, **options), str(tmp_path / "ck"), str(tmp_path / "out"), conf=ST.STATE_CONF)
    return {r["event_id"]: (r["prev_value"], r["jump"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}


def test_jumps_follow_time_not_arrival(spark, tmp_path):
    """Three batches, readings out of order within the lateness, a device that
    holds a third of them."""
    import random
    rng = random.Random(1)
    # the time of a reading is unique per device; device 7 has many
    rows = [(7 if i % 3 == 0 else rng.randrange(5), i, i * 2, float(rng.randrange(40))) for i in range(240)]
    arrived = sorted(rows, key=lambda r: r[2] + rng.uniform(0, 40))
    beat = [(-1, -1, 10_000, 0.0)]
    got = _jumps(spark, tmp_path, [arrived[:80], arrived[80:160], arrived[160:], beat], lateness="2 hours", hold="7 minutes")
    before, want = {}, {}
    for u, i, _, v in rows:
        p = before.get(u)
        want[i] = (p, p is not None and abs(v - p) > 10)
        before[u] = v
    assert got == want


def test_jumps_of_a_device_with_more_readings_than_one_value_holds(spark, tmp_path):
    import random
    rng = random.Random(2)
    rows = [(i % 2, i, i, float(rng.randrange(40))) for i in range(120)]
    arrived = sorted(rows, key=lambda r: r[2] + rng.uniform(0, 30))
    files = [arrived[:50], arrived[50:], [(-1, -1, 10_000, 0.0)]]
    few, many = (_jumps(spark, tmp_path / str(n), files, lateness="2 hours", hold="7 minutes", open_readings=n) for n in (4, 1000))
    assert few == many and len(few) == 120 and few[119][0] == rows[117][3]


def test_state_calls_do_not_grow_with_the_slots():
    """A device's readings of one batch, each in a slot of its own."""
    from types import SimpleNamespace
    calls = []

    class Value:
        now = None

        def get(self):
            calls.append("get")
            return self.now

        def update(self, v):
            calls.append("update")
            self.now = v

        def clear(self):
            calls.append("clear")
            self.now = None

    handle = SimpleNamespace(getValueState=lambda *a: Value(), getMapState=lambda *a: None,
                             registerTimer=lambda t: calls.append("timer"), deleteTimer=lambda t: calls.append("no timer"))
    p = ST._jump_processor(10.0, 60_000, 10**9, 1000)
    p.init(handle)
    at = lambda wm: SimpleNamespace(getCurrentWatermarkInMs=lambda: wm)
    rows = [{"us": i * 60_000_000, "event_id": i, "value": float(i % 3 * 20)} for i in range(500)]
    assert list(p.handleInputRows((1,), iter(rows[::-1]), at(0))) == []
    out = list(p.handleExpiredTimer((1,), at(10**8), None))
    assert [r["event_id"] for r in out] == list(range(500)) and out[4]["prev_value"] == 0.0 and out[4]["jump"]
    assert len(calls) < 10


def test_gps_feed_of_many_files_loses_no_reading(spark, tmp_path):
    """The events' own files follow no order of time; no part of the feed is cut by its files."""
    import datetime as dt
    from pyspark.sql import Row
    import __spark_entry__ as E
    day = dt.datetime(2024, 1, 1)
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    for k in range(8):
        rows = [Row(event_id=i, ts=day + dt.timedelta(hours=i), user_id=i % 3, event_type="view", value=float(i * 37 % 500),
                    props='{"k": 1}') for i in range(k, 160, 8)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    got = {r["event_id"]: r["prev_value"] for r in E.queries()["str10_gps_jump_filter"](spark, str(tmp_path)).collect()}
    assert got == {i: float((i - 3) * 37 % 500) if i > 2 else None for i in range(160)}


def test_silent_device_state_expires(spark, tmp_path):
    files = [[(1, 10, 0, 5.0), (2, 20, 0, 5.0)], [(2, 21, 30, 50.0)], [(2, 22, 300, 50.0)],
             [(1, 11, 310, 90.0), (2, 23, 310, 90.0)], [(-1, -1, 10_000, 0.0)]]
    got = _jumps(spark, tmp_path, files, lateness="10 minutes", keep="1 hour", hold="5 minutes")
    # device 1 was silent for five hours: its reading is a first one again
    assert got[11] == (None, False) and got[10] == (None, False)
    assert got[21] == (5.0, True) and got[23] == (50.0, True)


def test_counters_and_settings_of_a_run(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    s = ST.event_time(_readings(spark, str(tmp_path / "in"), [[(1, k, k, 1.0)] for k in range(3)]))
    run = ST.run_available(ST.dedup_events(s, "event_id", "10 minutes"), str(tmp_path / "ck"), str(tmp_path / "out"),
                           conf=ST.STATE_CONF, counted=True)
    assert spark.conf.get(key) == before
    assert sum(b["input_rows"] for b in run["batches"]) == 3 and [b["batch"] for b in run["batches"]] == sorted(b["batch"] for b in run["batches"])
