"""Signals from the live stream: velocity with arbitrary state (N1), and landing with daily signals in one query (N3).

Velocity. Per account the state maps event times to their number of events. The
count of a time t, events in ``[t - window, t]``, changes when an event at or before
t arrives within the window; a micro-batch emits the new counts of the times it
touched, so a late event corrects what was emitted. Counts only grow, so the largest
emitted for a time is the current one and a replayed micro-batch changes nothing.
Times further back than the window before the watermark can neither change nor be
counted again: they leave the state with each batch, and a timer clears accounts
that have gone quiet. An account's state is bounded by its events of one window and
the watermark's delay.

Landing. ``foreachBatch`` writes a micro-batch to partitions of its own number
(dynamic overwrite), then rebuilds the signals of the event days it touched. Both
replace what they wrote before, so a micro-batch that is replayed after a crash
changes nothing; a fence file with the last finished number skips finished ones.

Re-sent events. State within a watermark forgets, and drops what is older. ``start_landing_once``
keeps no state: a micro-batch lands its first copies less those that earlier micro-batches
landed, found by an anti join with the ids in the ingestion partitions whose zone holds
the batch's event days. However late, an event lands once and no first copy is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from riskweave.operators.signals import MICROS_PER_HOUR, event_micros
from riskweave.plans.pipelines import build_fraud_signals
from riskweave.settings import DEFAULT_SETTINGS, RiskSettings, Zones
from riskweave.sources.schema import load_json, save_json
from riskweave.sources.tables import table_exists
from riskweave.sources.zone_map import update_zones
from riskweave.streaming.events import EVENT_TIME, note_schema, read_landed, use_rocksdb_state, with_event_watermark

FENCE_FILE = "_fence.json"
COUNTS = "account_number string, ref long, velocity_count long"


def _updates(account: str | None, ref: np.ndarray, count: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"account_number": pd.Series([account] * len(ref), dtype=object), "ref": ref, "velocity_count": count})


class Velocity(StatefulProcessor):
    """Counts of the account's events in the window up to each event time."""

    def __init__(self, window_micros: int):
        self.window = window_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.times = handle.getMapState("times", "t long", "n long")

    def _held(self, watermark_ms: int) -> dict[int, int]:
        """The times that still matter; others leave the state."""
        oldest, held = watermark_ms * 1000 - self.window, {}
        for (t,), (n,) in list(self.times.iterator()):
            if t < oldest:
                self.times.removeKey((t,))
            else:
                held[t] = n
        return held

    def _wake(self, held: dict[int, int]) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if held:
            self.handle.registerTimer((max(held) + self.window) // 1000 + 1)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held = self._held(timerValues.getCurrentWatermarkInMs())
        new, n = np.unique(np.concatenate([pdf["ref"].to_numpy(np.int64) for pdf in rows]), return_counts=True)
        for t, k in zip(new.tolist(), n.tolist()):
            held[t] = held.get(t, 0) + k
            self.times.updateValue((t,), (held[t],))
        self._wake(held)
        times = np.array(sorted(held), np.int64)
        total = np.concatenate([[0], np.cumsum([held[t] for t in times.tolist()])])
        # A time changes if the latest new event at or before it is within the window.
        last = np.searchsorted(new, times, "right") - 1
        touched = times[(last >= 0) & (times - new[np.maximum(last, 0)] <= self.window)]
        count = total[np.searchsorted(times, touched, "right")] - total[np.searchsorted(times, touched - self.window, "left")]
        yield _updates(key[0], touched, count)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        held = self._held(timerValues.getCurrentWatermarkInMs())
        if held:
            self.handle.registerTimer((max(held) + self.window) // 1000 + 1)
        else:
            self.times.clear()
        yield _updates(None, np.zeros(0, np.int64), np.zeros(0, np.int64))

    def close(self) -> None:
        pass


def live_velocity(events: DataFrame, hours: int = DEFAULT_SETTINGS.velocity_window_hours, delay: str = "10 minutes") -> DataFrame:
    """N1 on a stream: updates (account_number, ref, velocity_count), ``ref`` the event time in micros. Events without
    an account or a time have no count."""
    use_rocksdb_state(events.sparkSession)
    timed = with_event_watermark(events.withColumn("ref", event_micros(events, "transaction_datetime")), delay)
    kept = [EVENT_TIME if EVENT_TIME in timed.columns else "transaction_datetime"]
    keyed = timed.filter(F.col("account_number").isNotNull() & F.col("ref").isNotNull()).select("account_number", "ref", *kept)
    return keyed.groupBy("account_number").transformWithStateInPandas(
        statefulProcessor=Velocity(hours * MICROS_PER_HOUR), outputStructType=T.StructType.fromDDL(COUNTS), outputMode="Update", timeMode="EventTime")


def _once(spark: SparkSession, path: str, step: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``step`` for the micro-batches beyond the fence, which then moves."""
    def run(batch: DataFrame, number: int) -> None:
        done = load_json(spark, path, FENCE_FILE)
        if done is None or number > done:
            step(batch, number)
            save_json(spark, path, FENCE_FILE, number)

    return run


def _write_batch(batch: DataFrame, number: int, path: str, *partition_by: str) -> None:
    batch.withColumn("landing_batch", F.lit(number).cast("long")).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by, "landing_batch").parquet(path)


def start_velocity(events: DataFrame, path: str, checkpoint: str, hours: int = DEFAULT_SETTINGS.velocity_window_hours,
                   delay: str = "10 minutes", available_now: bool = False, trigger: str = "10 seconds") -> StreamingQuery:
    """Store the updates of ``live_velocity``, a partition a micro-batch; ``velocity_counts`` reads the current ones."""
    def step(batch: DataFrame, number: int) -> None:
        _write_batch(batch, number, path)

    writer = live_velocity(events, hours, delay).writeStream.outputMode("update").option("checkpointLocation", checkpoint) \
        .foreachBatch(_once(events.sparkSession, path, step))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)).start()


def velocity_counts(spark: SparkSession, path: str) -> DataFrame:
    """(account_number, ref, velocity_count): the current counts of a table of updates."""
    updates = spark.read.schema(f"{COUNTS}, landing_batch long").parquet(path)
    return updates.groupBy("account_number", "ref").agg(F.max("velocity_count").alias("velocity_count"))


def start_signals(events: DataFrame, zones: Zones, checkpoint: str, settings: RiskSettings = DEFAULT_SETTINGS,
                  available_now: bool = False, trigger: str = "10 seconds") -> StreamingQuery:
    """N3 from the stream: land parsed and pre-screened events and rebuild the signals of the days they touch, batch by batch."""
    spark, path = events.sparkSession, zones.transactions_stream
    events = events.withColumn("ingestion_date", F.to_date("_event_ingested_at"))
    note_schema(events.withColumn("landing_batch", F.lit(0).cast("long")), path)

    def step(batch: DataFrame, number: int) -> None:
        _write_batch(batch, number, path, "ingestion_date")
        own = spark.read.schema(batch.schema.add("landing_batch", "long")).parquet(path).filter(F.col("landing_batch") == number)
        days = [r["d"] for r in own.select(F.col("ingestion_date").cast("string").alias("d")).distinct().collect()]
        if days:
            build_fraud_signals(spark, zones, days, settings)

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(_once(spark, path, step))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)).start()


def first_copies(batch: DataFrame, key: str = "transaction_id", day_of: str = "transaction_datetime") -> DataFrame:
    """One row per id and event day, the one enqueued first; rows without an id are no copies of each other and all stay."""
    order = Window.partitionBy(key, F.to_date(day_of)).orderBy(
        F.col("_event_ingested_at").asc_nulls_last(), F.xxhash64(*[F.col(c) for c in batch.columns]))
    first = batch.filter(F.col(key).isNotNull()).withColumn("_copy", F.row_number().over(order)).filter("_copy = 1").drop("_copy")
    return first.unionByName(batch.filter(F.col(key).isNull()))


def not_landed(batch: DataFrame, landed: DataFrame, held: Iterable[str | None], key: str = "transaction_id",
               day_of: str = "transaction_datetime") -> DataFrame:
    """Rows of ``batch`` whose id and event day no row of ``landed`` in the ingestion partitions ``held`` has."""
    part, held = F.col("ingestion_date").cast("string"), set(held)
    near = part.isin(sorted(v for v in held if v is not None)) | (part.isNull() if None in held else F.lit(False))
    there = landed.filter(near & F.col(key).isNotNull()).select(F.col(key).alias("_id"), F.to_date(day_of).alias("_day"))
    return batch.join(there, (F.col(key) == F.col("_id")) & F.to_date(day_of).eqNullSafe(F.col("_day")), "left_anti")


def start_landing_once(events: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                       trigger: str = "10 seconds") -> StreamingQuery:
    """I6 beyond any watermark: land each event (its id within its event day) once, however late it is sent again.

    Events without an id land with every delivery; events without a time are a day of their own. A replayed
    micro-batch is compared with what others landed, not with its own former write, which it replaces. The driver
    holds one line an ingestion partition and the event days of a micro-batch.
    """
    spark = events.sparkSession
    events = events.drop(EVENT_TIME).withColumn("ingestion_date", F.to_date("_event_ingested_at"))
    note_schema(events.withColumn("landing_batch", F.lit(0).cast("long")), path)

    def step(batch: DataFrame, number: int) -> None:
        fresh, day = first_copies(batch), F.to_date("transaction_datetime")
        if table_exists(spark, path) and (zones := update_zones(spark, path, landed := read_landed(spark, path), day)):
            days = {r["d"] for r in batch.select(day.alias("d")).distinct().collect()}
            held = [v for v, zone in zones.items() if zone.holds(days - {None}, None in days)]
            fresh = not_landed(fresh, landed.filter(F.col("landing_batch") != number), held)
        _write_batch(fresh, number, path, "ingestion_date")

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(_once(spark, path, step))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)).start()
