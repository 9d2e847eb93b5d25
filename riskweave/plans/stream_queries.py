"""Registered queries for the stream landing and fraud-signal operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators.features import account_features
from riskweave.operators.signals import event_micros, fraud_signals, route_by_score, velocity_breach
from riskweave.plans.oracle import FEATURE_DATE
from riskweave.plans.pipelines import build_fraud_signals
from riskweave.plans.queries import lookback
from riskweave.schemas import EVENT_PAYLOAD_SCHEMA, with_timestamp_type
from riskweave.session import scratch_path
from riskweave.settings import RiskSettings, Zones
from riskweave.sources import adapters
from riskweave.sources.tables import stored_schema
from riskweave.streaming.events import event_source, land_events, parse_events, prescreen, read_landed, use_rocksdb_state
from riskweave.streaming.live import start_landing_once, start_signals, start_velocity, velocity_counts

# The driver's event times carry no zone, so the payload is parsed as TIMESTAMP_NTZ.
PAYLOAD_NTZ = with_timestamp_type(EVENT_PAYLOAD_SCHEMA, T.TimestampNTZType())
FEED_RANGES = 4
VELOCITY_MAX = 5


def q_event_parse_flags(spark: SparkSession, sf: str) -> DataFrame:
    """H18 + I1-I3 on the whole event table, as a batch (same functions as the stream)."""
    return prescreen(parse_events(adapters.event_envelopes(spark, sf), PAYLOAD_NTZ))


def write_feed(envelopes: DataFrame, path: str, ranges: int = FEED_RANGES) -> int:
    """Envelopes appended as sequence-number ranges, one write after the other; returns the files.

    The file source replays files in modification-time order, so the ranges are
    written in order (like a bus delivering events roughly in time order). Each
    write is parallel; ranges are equal parts between the smallest and largest
    number, and envelopes without a number come first.
    """
    seq = F.col("sequenceNumber")
    lo, hi = envelopes.agg(F.min(seq), F.max(seq)).first()
    at = F.lit(0) if lo is None else F.coalesce(F.floor((seq - lo) * ranges / (hi - lo + 1)).cast("int"), F.lit(0))
    for k in range(ranges):
        envelopes.filter(at == k).write.mode("append").parquet(path)
    return len(envelopes.sparkSession.read.parquet(path).inputFiles())


def _land(spark: SparkSession, envelopes: DataFrame, deliveries: int, dedup: bool) -> DataFrame:
    root = scratch_path(spark, "stream")
    files = write_feed(envelopes, f"{root}/feed")
    for _ in range(deliveries - 1):  # a consumer restarted from an old offset gets every event again
        write_feed(envelopes, f"{root}/feed")
    if dedup:
        use_rocksdb_state(spark)
    per_trigger = str(files) if deliveries > 1 else "1"  # one micro-batch a delivery
    raw = event_source(spark, "parquet", {"maxFilesPerTrigger": per_trigger}, envelopes.schema, f"{root}/feed")
    query = land_events(raw, f"{root}/sink", f"{root}/checkpoint", payload_schema=PAYLOAD_NTZ,
                        dedup=dedup, available_now=True)
    query.awaitTermination()
    return read_landed(spark, f"{root}/sink")


def q_stream_landing(spark: SparkSession, sf: str) -> DataFrame:
    """M4 with an available-now trigger over a feed in four ranges, then the landed table."""
    return _land(spark, adapters.event_envelopes(spark, sf), deliveries=1, dedup=False)


def q_stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """I6: a feed with corrupt and id-less events delivered three times; the watermark dedup lands
    each event with an id once, and every delivery of the others."""
    return _land(spark, adapters.faulty_envelopes(spark, sf), deliveries=3, dedup=True)


def q_stream_landing_once(spark: SparkSession, sf: str) -> DataFrame:
    """I6 beyond the watermark: a feed with corrupt and id-less events delivered three times, each by a restarted query
    of its own; what comes again is years behind the newest event landed by then."""
    root = scratch_path(spark, "once")
    envelopes = adapters.faulty_envelopes(spark, sf)
    for _ in range(3):
        write_feed(envelopes, f"{root}/feed", ranges=2)
        raw = event_source(spark, "parquet", {}, envelopes.schema, f"{root}/feed")
        start_landing_once(prescreen(parse_events(raw, PAYLOAD_NTZ)), f"{root}/sink", f"{root}/checkpoint", available_now=True).awaitTermination()
    return read_landed(spark, f"{root}/sink").drop("landing_batch")


def q_fraud_signals_job(spark: SparkSession, sf: str) -> DataFrame:
    """N3 job in three runs over a landed stream: every tenth event lands three days late, another tenth four days early."""
    zones = Zones(scratch_path(spark, "fraud"))
    landed = prescreen(adapters.event_transactions(spark, sf))
    day, turn = F.to_date("transaction_datetime"), F.col("event_sequence_num") % 10
    late, early = landed.filter(turn == 0), landed.filter(turn == 1)
    for rows, ingested in ((landed.filter(turn > 1), day), (early, F.date_sub(day, 4)), (late, F.date_add(day, 3))):
        batch = rows.withColumn("ingestion_date", ingested)
        batch.write.mode("append").partitionBy("ingestion_date").parquet(zones.transactions_stream)
        days = [r["d"] for r in batch.select(F.col("ingestion_date").cast("string").alias("d")).distinct().collect()]
        build_fraud_signals(spark, zones, days, RiskSettings(velocity_max_count=VELOCITY_MAX))
    return spark.read.schema(stored_schema(spark, zones.fraud_signals, T.StructType())).parquet(zones.fraud_signals)


def q_velocity_breach(spark: SparkSession, sf: str) -> DataFrame:
    ev = adapters.event_transactions(spark, sf)
    out = velocity_breach(ev, hours=24, max_count=VELOCITY_MAX)
    return out.select("transaction_id", "account_number", "transaction_datetime", "velocity_count",
                      "_flag_velocity_breach")


def _feed(spark: SparkSession, sf: str, root: str, parts: int, part: int) -> DataFrame:
    """A stream over the envelopes, of which this call adds the ``part``-th of ``parts`` shares; shares interleave in
    time, so all but the first bring late events."""
    envelopes = adapters.event_envelopes(spark, sf)
    envelopes.filter(F.pmod("sequenceNumber", F.lit(parts)) == part).write.mode("append").parquet(f"{root}/feed")
    raw = event_source(spark, "parquet", {}, envelopes.schema, f"{root}/feed")
    return prescreen(parse_events(raw, PAYLOAD_NTZ))


def q_velocity_stream(spark: SparkSession, sf: str) -> DataFrame:
    """N1 live: three deliveries, each a restarted query that corrects earlier counts; equals the batch."""
    root = scratch_path(spark, "velocity")
    for part in range(3):
        events = _feed(spark, sf, root, 3, part)
        start_velocity(events, f"{root}/counts", f"{root}/checkpoint", delay="3650 days", available_now=True).awaitTermination()
    ev = adapters.event_transactions(spark, sf)
    timed = ev.withColumn("ref", event_micros(ev, "transaction_datetime"))
    out = timed.join(velocity_counts(spark, f"{root}/counts"), ["account_number", "ref"], "left")
    return out.select("transaction_id", "account_number", "transaction_datetime", "velocity_count",
                      F.coalesce(F.col("velocity_count") > VELOCITY_MAX, F.lit(False)).alias("_flag_velocity_breach"))


def q_fraud_signals_stream(spark: SparkSession, sf: str) -> DataFrame:
    """N3 live: landing and signals in one query, restarted between two deliveries; equals the batch."""
    root = scratch_path(spark, "signals")
    zones = Zones(root)
    for part in range(2):
        start_signals(_feed(spark, sf, root, 2, part), zones, f"{root}/checkpoint", RiskSettings(velocity_max_count=VELOCITY_MAX),
                      available_now=True).awaitTermination()
    return spark.read.schema(stored_schema(spark, zones.fraud_signals, T.StructType())).parquet(zones.fraud_signals)


def q_route_by_score(spark: SparkSession, sf: str) -> DataFrame:
    feats = account_features(lookback(spark, sf), FEATURE_DATE)
    routed, _ = route_by_score(feats, "online_txn_ratio_30d", 0.75)
    return routed.select("account_number", "customer_id", "online_txn_ratio_30d", "feature_date")


def q_fraud_signals(spark: SparkSession, sf: str) -> DataFrame:
    ev = prescreen(adapters.event_transactions(spark, sf))
    return fraud_signals(velocity_breach(ev, hours=24, max_count=VELOCITY_MAX))


STREAM_QUERIES = {
    "event_parse_flags": q_event_parse_flags,
    "stream_landing": q_stream_landing,
    "stream_dedup": q_stream_dedup,
    "stream_landing_once": q_stream_landing_once,
    "velocity_breach": q_velocity_breach,
    "route_by_score": q_route_by_score,
    "fraud_signals": q_fraud_signals,
    "fraud_signals_job": q_fraud_signals_job,
    "velocity_stream": q_velocity_stream,
    "fraud_signals_stream": q_fraud_signals_stream,
}
