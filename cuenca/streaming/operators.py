"""Structured Streaming operators.

Sources in this repository are file streams (a folder that receives files);
a Kafka or Kinesis reader is the same ``readStream`` with another format.
Every stateful operator runs with a watermark so its state is bounded by the
allowed lateness, and every query writes through a checkpoint so a restart
(or a lost executor) resumes exactly once.
"""

from __future__ import annotations

import threading

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType


def file_stream(spark: SparkSession, folder: str, schema: StructType | str, fmt: str = "parquet",
                glob: str | None = None, max_files: int | None = None, **options) -> DataFrame:
    """A streaming DataFrame over files arriving in ``folder``."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(folder)


def kafka_stream(spark: SparkSession, servers: str, topic: str, schema: StructType | str,
                 starting: str = "latest", max_offsets: int | None = None) -> DataFrame:
    """A broker topic as a stream of parsed JSON records (value → columns).
    ``max_offsets`` bounds each micro-batch (maxOffsetsPerTrigger). Needs the
    Kafka connector on the classpath; the repository's tests use file
    streams instead."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", max_offsets)
    raw = r.load()
    return raw.select(F.col("key").cast("string").alias("key"), F.col("timestamp").alias("broker_ts"),
                      F.from_json(F.col("value").cast("string"), schema).alias("r")).select(
        "key", "broker_ts", "r.*")


def event_time(df: DataFrame, col: str = "ts", out: str = "event_time") -> DataFrame:
    """Watermarks need TIMESTAMP (with zone); project timestamps are zone
    agnostic (NTZ), read as UTC."""
    return df.withColumn(out, F.col(col).cast("timestamp"))


# --- stateless record transform (the stream's enrich function) -------------

def enrich_records(records: DataFrame, source: str, id_col: str = "recordId",
                   data_col: str = "data") -> DataFrame:
    """Decode the base64 JSON object, set its ``source``, re-encode; result is
    'Ok', or 'ProcessingFailed' (payload kept as it came) when the payload is
    not base64, not UTF-8 or no JSON object. Other fields keep their JSON
    types (numbers, booleans, nested values); a ``source`` that is there is replaced."""
    text = F.try_to_binary(F.col(data_col), F.lit("base64")).cast("string")
    text = F.when(F.is_valid_utf8(text) & F.try_parse_json(text).isNotNull() & text.rlike(r"^\s*\{"), text)
    fields = F.map_filter(F.from_json(text, "MAP<STRING, VARIANT>"), lambda k, v: k != "source")
    # variants go back to JSON one by one, so their types stay
    parts = F.transform(F.map_entries(fields), lambda e: F.concat(
        F.regexp_extract(F.to_json(F.create_map(e["key"], F.lit(1))), r"^\{(.*):1\}$", 1), F.lit(":"),
        F.coalesce(F.to_json(e["value"]), F.lit("null"))))
    own = F.regexp_extract(F.to_json(F.create_map(F.lit("source"), F.lit(source))), r"^\{(.*)\}$", 1)
    enriched = F.concat(F.lit("{"), F.array_join(F.concat(parts, F.array(own)), ","), F.lit("}"))
    ok = fields.isNotNull()
    return records.select(
        F.col(id_col),
        F.when(ok, F.lit("Ok")).otherwise(F.lit("ProcessingFailed")).alias("result"),
        F.when(ok, F.base64(F.encode(enriched, "UTF-8"))).otherwise(F.col(data_col)).alias(data_col))


# --- windowed aggregates -----------------------------------------------------

def tumbling_counts(events: DataFrame, key: str, value: str, width: str, lateness: str,
                    ts: str = "event_time") -> DataFrame:
    """Count and sum per (tumbling window, key) with a watermark."""
    return (events.withWatermark(ts, lateness)
            .groupBy(F.window(ts, width).alias("w"), key)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")))


def sliding_counts(events: DataFrame, key: str, width: str, slide: str, lateness: str,
                   ts: str = "event_time") -> DataFrame:
    return (events.withWatermark(ts, lateness)
            .groupBy(F.window(ts, width, slide).alias("w"), key)
            .agg(F.count(F.lit(1)).alias("n")))


def session_counts(events: DataFrame, key: str, gap: str, lateness: str,
                   ts: str = "event_time") -> DataFrame:
    return (events.withWatermark(ts, lateness)
            .groupBy(F.session_window(ts, gap).alias("s"), key)
            .agg(F.count(F.lit(1)).alias("n")))


def tumbling_counts_once(events: DataFrame, id_col: str, key: str, value: str, width: str, lateness: str,
                         ts: str = "event_time") -> DataFrame:
    """``tumbling_counts`` over events that may be delivered twice: an id counts
    once per window. The first stateful operator sees single rows, so its
    dropped-by-watermark counter (the first of a batch's ``late_rows`` in
    ``run_available``) is the number of late events, not of partial aggregates."""
    rows = (events.withWatermark(ts, lateness)
            .select(F.col(id_col).alias("_id"), F.window(ts, width).alias("w"), key, value)
            .dropDuplicates(["_id", "w"]))
    return rows.groupBy("w", key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))


def late_rows(run: dict) -> int:
    """Events that came too late for their window, over all micro-batches of a
    counted run of ``tumbling_counts_once``."""
    return sum(b["late_rows"][-1] for b in run["batches"] if b["late_rows"])


def dedup_events(events: DataFrame, id_col: str, lateness: str, ts: str = "event_time") -> DataFrame:
    """Drop repeated event ids arriving within the allowed lateness."""
    return events.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([id_col])


def interval_join(left: DataFrame, right: DataFrame, key: str, lt: str, rt: str,
                  before: str, after: str, lateness: str) -> DataFrame:
    """Stream-stream inner join of events of the same key within a time bound
    (right.time between left.time - before and left.time + after). The
    watermarks let Spark drop state older than the bound."""
    lw = left.withWatermark(lt, lateness).alias("l")
    rw = right.withWatermark(rt, lateness).alias("r")
    cond = ((F.col(f"l.{key}") == F.col(f"r.{key}"))
            & (F.col(f"r.{rt}") >= F.col(f"l.{lt}") - F.expr(f"INTERVAL {before}"))
            & (F.col(f"r.{rt}") <= F.col(f"l.{lt}") + F.expr(f"INTERVAL {after}")))
    return lw.join(rw, cond, "inner")


# --- custom per-key state ----------------------------------------------------

JUMP_OUT = "user_id long, event_id long, us long, value double, prev_value double, jump boolean"


#: open readings of a device that its state holds in one value; more go to slots
OPEN_READINGS = 10_000


def _jump_processor(threshold: float, hold_ms: int, keep_ms: int, open_readings: int):
    from pyspark.sql.streaming import StatefulProcessor

    class Jumps(StatefulProcessor):
        """Readings wait in state until the watermark has passed the slot of
        ``hold_ms`` of their time; then they are emitted in order of time. A device
        has one value (its open readings, last reading and timer), so a batch
        costs a few state calls per device, however many slots its readings are
        in. Beyond ``open_readings`` they move to a map, in pieces by slot. The
        last reading stays until ``keep_ms`` after it."""

        def init(self, handle) -> None:
            self.handle = handle
            self.device = handle.getValueState(
                "device", "readings string, pieces long, timer long, us long, value double, expires long")
            self.slots = handle.getMapState("slots", "slot long, piece long", "readings string")

        def handleInputRows(self, key, rows, timerValues):
            import json
            text, pieces, timer, *last = self.device.get() or ("[]", 0, None, None, None, None)
            waiting = json.loads(text)
            for r in rows:
                waiting.append((r["us"], r["event_id"], r["value"]))
                if len(waiting) >= open_readings:    # a device's rows are never all in memory
                    for k, xs in self._by_slot(waiting).items():
                        self.slots.updateValue((k, pieces), (json.dumps(xs),))
                    waiting, pieces = [], pieces + 1
            yield from self._advance(key, waiting, pieces, timer, *last, timerValues.getCurrentWatermarkInMs())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            import json
            text, pieces, _, *last = self.device.get()
            yield from self._advance(key, json.loads(text), pieces, None, *last, timerValues.getCurrentWatermarkInMs())

        def _by_slot(self, readings):
            out = {}
            for x in readings:
                out.setdefault(x[0] // (hold_ms * 1000), []).append(x)
            return out

        def _advance(self, key, waiting, pieces, timer, seen, before, expires, now):
            """Emit the slots that the watermark has passed and write the device's
            value; ``timer`` is the one that is set."""
            import json
            open_slots, stored = self._by_slot(waiting), {}
            if pieces:
                for slot, piece in self.slots.keys():
                    stored.setdefault(slot, []).append(piece)
            due = sorted(k for k in open_slots.keys() | stored.keys() if (k + 1) * hold_ms <= now)
            if expires is not None and expires <= now and (not due or expires < (due[0] + 1) * hold_ms):
                seen, before, expires = None, None, None     # a silent device: its reading goes
            for slot in due:
                xs = open_slots.pop(slot, [])
                for piece in stored.pop(slot, []):
                    xs += json.loads(self.slots.getValue((slot, piece))[0])
                    self.slots.removeKey((slot, piece))
                yield from self._flagged(key, xs, before)
                seen, _, before = xs[-1]
            if due:
                expires = seen // 1000 + keep_ms
            rest = open_slots.keys() | stored.keys()
            wake = (min(rest) + 1) * hold_ms if rest else expires
            if not rest and (expires is None or expires <= now):
                wake = None
            if timer != wake and timer is not None:          # a device has one timer
                self.handle.deleteTimer(timer)
            if wake is None:
                self.device.clear()
                return
            if timer != wake:
                self.handle.registerTimer(wake)
            waiting = [x for xs in open_slots.values() for x in xs]
            self.device.update((json.dumps(waiting), pieces if stored else 0, wake, seen, before, expires))

        def _flagged(self, key, readings, before):
            from pyspark.sql import Row
            readings.sort()
            for us, event_id, value in readings:
                jump = before is not None and value is not None and abs(value - before) > threshold
                yield Row(user_id=key[0], event_id=event_id, us=us, value=value, prev_value=before, jump=jump)
                before = value

        def close(self) -> None:
            pass

    return Jumps()


#: custom state lives in RocksDB, outside the heap
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass":
              "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def flag_jumps(events: DataFrame, threshold: float, lateness: str = "1 hour", keep: str = "30 days",
               hold: str = "10 minutes", open_readings: int = OPEN_READINGS) -> DataFrame:
    """Per device, flag a reading that jumps more than ``threshold`` from the
    device's previous reading in order of (ts, event_id), whatever the order
    of arrival within ``lateness``.

    ``transformWithState`` on event time: a reading is emitted when the
    watermark passes its slot of ``hold``; state holds the readings of the open
    slots and one last reading per device, dropped when the watermark is
    ``keep`` past it. Readings behind the watermark are dropped and counted.
    Run it with ``STATE_CONF``."""
    ms = lambda text: int(pd.Timedelta(text).total_seconds() * 1000)
    rows = events.withWatermark("ts", lateness).withColumn("us", F.unix_micros("ts"))
    out = rows.groupBy("user_id").transformWithState(
        _jump_processor(threshold, ms(hold), ms(keep), open_readings), JUMP_OUT, "Append", "EventTime")
    return out.withColumn("ts", F.timestamp_micros("us")).select(
        "user_id", "event_id", "ts", "value", "prev_value", "jump")


# --- running a stream --------------------------------------------------------

class RunCounters(StreamingQueryListener):
    """Figures of every micro-batch of the streams that run while it is
    registered, by run id: the query's own ``recentProgress`` forgets old ones."""

    def __init__(self):
        self.batches: dict[str, list] = {}
        self.ended: dict[str, threading.Event] = {}

    def end_of(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches.setdefault(str(p.runId), []).append({
            "batch": p.batchId, "input_rows": p.numInputRows, "watermark": dict(p.eventTime).get("watermark"),
            "late_rows": [op.numRowsDroppedByWatermark for op in p.stateOperators]})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.end_of(str(event.runId)).set()


def run_available(stream_df: DataFrame, checkpoint: str, sink_path: str | None = None,
                  mode: str = "append", partition_by: list[str] | None = None,
                  batch_writer=None, conf: dict[str, str] | None = None, counted: bool = False) -> dict:
    """Process everything available now, exactly once, then stop. Output
    goes to a parquet folder (file sink, or ``batch_writer`` via foreachBatch
    for complete/update modes). ``conf`` holds for this query only. Returns the
    last progress and, if ``counted``, the figures of every micro-batch."""
    spark = stream_df.sparkSession
    w = stream_df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if batch_writer is not None:
        w = w.foreachBatch(batch_writer)
    else:
        w = w.format("parquet").option("path", sink_path)
        if partition_by:
            w = w.partitionBy(*partition_by)
    before = {k: spark.conf.get(k, None) for k in conf or {}}
    counters = RunCounters() if counted else None
    if counters:
        spark.streams.addListener(counters)
    try:
        for k, v in (conf or {}).items():
            spark.conf.set(k, v)
        try:
            q = w.trigger(availableNow=True).start()   # takes a copy of the session's settings
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        q.awaitTermination()
        out = {"progress": q.recentProgress}
        if counters:
            counters.end_of(str(q.runId)).wait(60)     # listeners hear of batches in order, the end last
            out["batches"] = sorted(counters.batches.get(str(q.runId), []), key=lambda b: b["batch"])
        return out
    finally:
        if counters:
            spark.streams.removeListener(counters)


def overwrite_to(path: str):
    """foreachBatch writer for complete mode: the batch holds the whole
    result table, so each batch replaces the folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)
    return write


def asof_batches(path: str, states: DataFrame, **options):
    """foreachBatch writer of an as-of join: each micro-batch meets ``states``
    (a batch table) by ``asof_join`` and lands in its own folder ``batch=<id>``, which
    a repeated batch replaces: exactly once."""
    from cuenca.operators.temporal import asof_join

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            asof_join(batch, states, **options).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()
    return write


def enrich(stream: DataFrame, source: str) -> DataFrame:
    """The record transform of the delivery stream (``enrich_records``)."""
    return enrich_records(stream, source)
