"""Structured Streaming jobs: the batch functions on unbounded input, plus watermarked state."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from bazaarlake import constants as C
from bazaarlake import schemas
from bazaarlake.functions.timeline import gap_sessions
from bazaarlake.operators import ml
from bazaarlake.operators import payments as P
from bazaarlake.sources.bronze import parse_json

# Trigger interval per stream.
TRIGGERS = {"clickstream-raw": "30 seconds", "payments-raw": "10 seconds", "logistics-raw": "60 seconds",
            "fraud-scores": "10 seconds"}


def to_bronze(messages: DataFrame, topic: str) -> DataFrame:
    return parse_json(messages, schemas.STREAMS[topic], topic)


def start_append(df: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                 partition: tuple[str, ...] = ("year", "month", "day"), name: str | None = None) -> StreamingQuery:
    """Checkpointed append. Without a trigger all available input is processed and the query ends."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    return writer.partitionBy(*partition).format("parquet").start(path) if partition else writer.format(
        "parquet").start(path)


def start_bronze(sources: dict[str, DataFrame], base: str, checkpoints: str, once: bool = False) -> list[StreamingQuery]:
    """One query per topic, each with its own checkpoint and trigger."""
    return [
        start_append(to_bronze(df, topic), f"{base}/bronze/{topic.removesuffix('-raw')}", f"{checkpoints}/{topic}",
                     None if once else TRIGGERS[topic], name=topic)
        for topic, df in sources.items()
    ]


def typed_payments(messages: DataFrame, topic: str = "payments-raw") -> DataFrame:
    """Valid payments from raw messages: row-wise rules only, so they hold on a stream."""
    bronze = to_bronze(messages, topic)
    return P.judge(P.clean(bronze)).filter(F.col("reject_reason").isNull())


def deduplicated(events: DataFrame, key: str, at: str, watermark: str = "7 days") -> DataFrame:
    """One row per key. A repeat within the watermark of its first delivery is dropped; state ends with it."""
    return events.withWatermark(at, watermark).dropDuplicatesWithinWatermark([key])


def sliding_velocity(events: DataFrame, key: str, at: str, width: str = "5 minutes", step: str = "1 minute",
                     watermark: str = "10 minutes") -> DataFrame:
    """Events per key in sliding windows. Counts are combined before the shuffle, so a heavy key is one row per
    window and task."""
    return events.withWatermark(at, watermark).groupBy(F.window(at, width, step), key).agg(
        F.count(F.lit(1)).alias("events")
    ).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key, "events")


def exact_velocity(events: DataFrame, key: str, at: str, id_column: str, seconds: int = 300,
                   watermark: str = "10 minutes", bucket_seconds: int = 86_400, slots: int = 1_024) -> DataFrame:
    """Each event with the number of events of its key in the last `seconds`, itself included.

    State is held by (slot of keys, time bucket): keys share `slots` hashed slots, and all keys of a state are counted
    at once, so the calls do not grow with the keys. A replay spreads a heavy key over as many tasks as it has buckets.
    An event near the end of its bucket is also history of the next one. A state holds the times that a later event
    may still count, those within `seconds` of the watermark, and ends with its bucket. Within a micro-batch all
    events are seen before counting, so their order does not matter; an event that comes in a later batch than its
    successors does not change what was already emitted.
    """
    width, length = seconds * 1_000_000, bucket_seconds * 1_000_000
    if length < width:
        raise ValueError("a bucket must be at least as long as the counted period")
    kind = events.schema[key].dataType
    out = T.StructType([T.StructField(key, kind), T.StructField(id_column, events.schema[
        id_column].dataType), T.StructField("velocity", T.LongType())])
    held = T.StructType([T.StructField("keys", T.ArrayType(kind)), T.StructField("times", T.ArrayType(T.LongType()))])

    def count(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        old_keys, old_times = state.get if state.exists else ([], [])
        rows = pd.concat(list(batches), ignore_index=True)
        keys = pd.Series([*old_keys, *rows[key].tolist()], dtype=object)
        code = pd.factorize(keys, use_na_sentinel=False)[0].astype("int64")
        times = np.concatenate([np.array(old_times, dtype="int64"), rows["_micros"].to_numpy(dtype="int64")])
        # Key and rank of the time in one number: a key's events between two times are a range of the sorted numbers.
        known, rank = np.unique(times, return_inverse=True)
        line = np.sort(code * (len(known) + 1) + rank)
        own = rows["_own"].to_numpy(dtype=bool)
        first, at = code[len(old_times):][own] * (len(known) + 1), times[len(old_times):][own]
        inside = (np.searchsorted(line, first + np.searchsorted(known, at, "right"), "left")
                  - np.searchsorted(line, first + np.searchsorted(known, at - width, "left"), "left"))
        end_ms, seen_ms = (int(group[1]) + 1) * length // 1_000, state.getCurrentWatermarkMs()
        if end_ms > seen_ms:
            stay = times >= seen_ms * 1_000 - width
            state.update((keys[stay].tolist(), times[stay].tolist()))
            state.setTimeoutTimestamp(end_ms)
        elif state.exists:
            state.remove()
        yield pd.DataFrame({key: rows[key][own], id_column: rows[id_column][own], "velocity": inside.astype("int64")})

    timed = events.withWatermark(at, watermark).withColumn("_micros", F.unix_micros(at))
    bucket = F.floor(F.col("_micros") / F.lit(length))
    carried = (bucket + 1) * F.lit(length) - F.col("_micros") <= width
    copies = F.inline(F.array_compact(F.array(
        F.struct(bucket.alias("_bucket"), F.lit(True).alias("_own")),
        F.when(carried, F.struct((bucket + 1).alias("_bucket"), F.lit(False).alias("_own"))))))
    # Events without a key are counted together, apart from all keys.
    slot = F.when(F.col(key).isNull(), -1).otherwise(F.pmod(F.xxhash64(key), F.lit(slots))).alias("_slot")
    return timed.select(key, at, id_column, "_micros", slot, copies).groupBy("_slot", "_bucket").applyInPandasWithState(
        count, out, held, "append", GroupStateTimeout.EventTimeTimeout)


def session_stream(events: DataFrame, key: str, at: str, gap: str = "30 minutes",
                   watermark: str = "1 hour") -> DataFrame:
    """Sessions by inactivity, emitted when the watermark closes them; a session may cross midnight."""
    return events.withWatermark(at, watermark).groupBy(F.session_window(at, gap), key).agg(
        F.count(F.lit(1)).alias("total_events"), F.min(at).alias("session_start"), F.max(at).alias("session_end"),
    ).drop("session_window")


def complete_windows(closed: DataFrame, rows: DataFrame, at: str, width: str, watermark: object,
                     compute: Callable[[DataFrame], DataFrame], end: Column) -> DataFrame:
    """All windows of `rows`: those that the stream has emitted (`closed`), and those its last watermark left open.

    A window is emitted when its `end` is at or before the watermark. `compute` is the function of the stream, here on
    stored rows that can lie in an open window; `watermark` comes from the progress ledger (None: nothing was emitted).
    """
    if watermark is None:
        return compute(rows)
    limit = F.lit(watermark).cast("timestamp")
    near = rows.filter(F.col(at) > limit - F.expr(f"INTERVAL {width}"))
    return closed.unionByName(compute(near).filter(end > limit))


def complete_sessions(closed: DataFrame, rows: DataFrame, key: str, at: str, gap_seconds: int = 1_800, **routing) -> DataFrame:
    """All sessions of `rows`: the emitted ones, and those of the rows after each key's last emitted session.

    Sessions of one key end in order, so whatever comes after the last emitted one is open, however far it reaches
    back. Open sessions take the batch route, which also splits a heavy key by time.
    """
    last = closed.groupBy(F.col(key).alias("_of")).agg(F.max("session_end").alias("_closed"))
    rest = rows.select(key, at).join(last, F.col(key) == F.col("_of"), "left").filter(
        F.col("_closed").isNull() | (F.col(at) > F.col("_closed"))).select(key, at, F.unix_micros(at).alias("_micros"))
    # A pause of exactly the gap ends a session of the stream, a longer one that of the timeline.
    opened = gap_sessions(rest, key, "_micros", gap_seconds * 1_000_000 - 1, **routing)
    sessions = opened.groupBy(key, "session_open").agg(
        F.count(F.lit(1)).alias("total_events"), F.min(at).alias("session_start"), F.max(at).alias("session_end"))
    return closed.unionByName(sessions.drop("session_open"))


def score(model: PipelineModel, features: DataFrame, version: str) -> DataFrame:
    """Scored stream with decision, audit and partition columns."""
    return ml.score(model, features, None, version).withColumns({
        "year": F.year("scored_at"), "month": F.month("scored_at"), "day": F.dayofmonth("scored_at")})


def alerts(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("fraud_probability") >= C.ALERT_AT)


def blocked_hourly(scored: DataFrame, at: str = "event_timestamp", limit: int = C.BLOCKED_PER_HOUR,
                   watermark: str = "1 hour") -> DataFrame:
    """Hours with more blocked payments than the limit."""
    blocked = scored.filter(F.col("fraud_decision") == "BLOCK").withWatermark(at, watermark)
    return blocked.groupBy(F.window(at, "1 hour")).agg(F.count(F.lit(1)).alias("blocked")).filter(
        F.col("blocked") > limit).select(F.col("window.start").alias("hour"), "blocked")


def matched_deliveries(payments: DataFrame, parcels: DataFrame, watermark: str = "1 hour",
                       within: str = "7 days") -> DataFrame:
    """Payments and parcel events of the same order in different countries, joined within a bounded time.

    Both sides carry a watermark, so the state of old rows is dropped.
    """
    p = payments.select(F.col("order_id"), "billing_country_iso", F.col("event_timestamp").alias("paid_at")
                        ).withWatermark("paid_at", watermark)
    s = parcels.select(F.col("order_id").alias("_order"), "delivery_country", "event_id",
                       F.col("event_timestamp").alias("seen_at")).withWatermark("seen_at", watermark)
    near = (F.col("seen_at") >= F.col("paid_at")) & (F.col("seen_at") <= F.col("paid_at") + F.expr(f"INTERVAL {within}"))
    return p.join(s, (F.col("order_id") == F.col("_order")) & near).filter(
        F.col("billing_country_iso") != F.col("delivery_country")).drop("_order")


def route_late(at: str, watermark_seconds: int, on_time: Callable[[DataFrame, int], None],
               late: Callable[[DataFrame, int], None], newest_seen: Callable[[], object]) -> Callable:
    """A foreachBatch writer that sends rows older than the newest stored row minus the watermark to a side table.

    `newest_seen` reads the newest event time already stored (None at first), so a restart keeps the rule.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = newest_seen()
        if newest is None:
            on_time(batch, batch_id)
            return
        limit = F.lit(newest).cast("timestamp") - F.make_interval(secs=F.lit(watermark_seconds))
        is_late = F.coalesce(F.col(at) < limit, F.lit(False))
        on_time(batch.filter(~is_late), batch_id)
        late(batch.filter(is_late), batch_id)

    return write


LEDGER = ("query string, batch_id bigint, run_id string, rows_in bigint, rows_out bigint, watermark timestamp, "
          "rows_per_second double, observed string, ended_at timestamp")


def _ledger_row(p) -> tuple:
    """One progress report as a row: counts, the watermark that the batch ran with, and the metrics it observed."""
    moment = (p.get("eventTime") or {}).get("watermark")
    out = (p.get("sink") or {}).get("numOutputRows", -1)
    return (p.get("name") or p["id"], p["batchId"], p["runId"], p["numInputRows"], None if out < 0 else out,
            _moment(moment), p.get("processedRowsPerSecond"), json.dumps(p.get("observedMetrics") or {}, default=str),
            _moment(p["timestamp"]))


def _moment(text: str | None) -> datetime | None:
    return None if not text or text.startswith("1970-01-01") else datetime.fromisoformat(text.replace("Z", "+00:00"))


def write_ledger(spark: SparkSession, reports: list[dict], path: str) -> None:
    """Append progress reports as a table. A report that is written again replaces itself."""
    if reports:
        rows = spark.createDataFrame([_ledger_row(p) for p in reports], LEDGER)
        rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "query", "batch_id").parquet(path)


def record(spark: SparkSession, query: StreamingQuery, path: str) -> None:
    """Put the recent progress of a query into the ledger."""
    write_ledger(spark, [json.loads(p.json) if hasattr(p, "json") else dict(p) for p in query.recentProgress], path)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path)


def last_watermark(spark: SparkSession, path: str, query: str) -> datetime | None:
    """The watermark of the newest recorded batch, up to which the query has emitted its windows."""
    return ledger(spark, path).filter(F.col("query") == query).agg(F.max("watermark")).first()[0]


class LedgerListener(StreamingQueryListener):
    """Puts every progress report of a session's streams into the ledger as it comes."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        write_ledger(self.spark, [json.loads(event.progress.json)], self.path)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


class ProgressLog(StreamingQueryListener):
    """Keeps the last progress per query: batch, rows in, rate, and why a query ended."""

    def __init__(self):
        self.progress: dict[str, dict] = {}
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.progress[p.name or str(p.id)] = {
            "batch_id": p.batchId, "rows_in": p.numInputRows, "rows_per_second": p.processedRowsPerSecond,
            "sink_rows": p.sink.numOutputRows, "watermark": (p.eventTime or {}).get("watermark"),
        }

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended[str(event.id)] = event.exception


def progress_table(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """One row per query from its last progress."""
    rows = [(q.name or str(q.id), (q.lastProgress or {}).get("batchId"), (q.lastProgress or {}).get("numInputRows"),
             q.isActive) for q in queries]
    return spark.createDataFrame(rows, "query string, batch_id bigint, rows_in bigint, is_active boolean")
