"""Transaction-shaped inputs derived from the driver's tables.

The pipeline's inputs are bank transactions and transaction events; the test
tables are a TPC-H-like star schema and an event log. These adapters map every
row of ``lineitem`` / ``events`` to a transaction (nothing is dropped or
sampled), planting nulls, negative amounts, raw codes and duplicate keys
through deterministic rules on the row's own columns.

Each adapter is one SQL text used twice: by Spark (the table is passed as a
DataFrame argument) and by the DuckDB oracle (the table is a view). ``{S}`` is
the string type name of the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskweave.operators.dedup import with_position

TXN_SQL = """
SELECT
  concat('T', cast(l_orderkey as {S}), '-', cast(l_linenumber as {S})) AS transaction_id,
  CASE WHEN l_partkey % 89 = 0 THEN NULL
       ELSE concat('A', cast(l_orderkey % 500 as {S})) END AS account_number,
  concat('C', cast(l_suppkey % 37 as {S})) AS customer_id,
  l_shipdate + INTERVAL 1 HOUR * (l_partkey % 24) AS transaction_datetime,
  cast(l_shipdate as date) AS transaction_date,
  CASE l_returnflag WHEN 'A' THEN ' debit' WHEN 'N' THEN 'Credit '
       ELSE CASE WHEN l_partkey % 50 = 0 THEN 'ADJ' ELSE 'TRANSFER' END END AS transaction_type,
  CASE l_linenumber WHEN 1 THEN 'web' WHEN 2 THEN ' App' WHEN 3 THEN 'TLR ' WHEN 4 THEN 'ATM'
       WHEN 5 THEN 'internet' WHEN 6 THEN 'PHONE' ELSE NULL END AS transaction_channel,
  CASE WHEN l_partkey % 101 = 0 THEN NULL WHEN l_partkey % 97 = 0 THEN -l_extendedprice
       WHEN l_partkey % 20 = 0 THEN floor(l_extendedprice / 1000) * 1000
       ELSE l_extendedprice END AS amount_usd,
  CASE l_partkey % 8 WHEN 0 THEN NULL WHEN 1 THEN ' eur' WHEN 2 THEN 'BRL' ELSE 'usd ' END AS currency_code,
  CASE l_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'gb' ELSE 'US' END AS originating_country,
  CASE l_partkey % 6 WHEN 0 THEN '6011' WHEN 1 THEN '7995' WHEN 2 THEN NULL ELSE '5411' END AS merchant_category_code,
  concat('MERCHANT-', cast(l_suppkey as {S})) AS merchant_name,
  CASE l_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN true ELSE false END AS is_international,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_extendedprice * l_quantity END AS account_balance_usd,
  concat('BR', cast(l_suppkey % 10 as {S})) AS branch_code,
  'CBS' AS source_system,
  concat('cbs_export_', l_linestatus, '.parquet') AS batch_file_name,
  l_partkey AS load_seq, l_suppkey AS load_tie, l_extendedprice AS load_tie2
FROM {lineitem}
"""

EVENT_TXN_SQL = """
SELECT concat('E', cast(event_id as {S})) AS transaction_id,
  concat('A', cast(user_id as {S})) AS account_number,
  concat('C', cast(user_id % 37 as {S})) AS customer_id,
  ts AS transaction_datetime,
  CASE event_type WHEN 'purchase' THEN 'DEBIT' WHEN 'signup' THEN 'CREDIT' ELSE 'TRANSFER' END AS transaction_type,
  CASE event_type WHEN 'click' THEN 'ONLINE' WHEN 'view' THEN 'ONLINE' WHEN 'error' THEN 'ATM'
       WHEN 'signup' THEN NULL ELSE 'MOBILE' END AS transaction_channel,
  value * 100 AS amount_usd,
  CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'GB' ELSE 'US' END AS originating_country,
  CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'FR' ELSE 'US' END AS ip_country,
  CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END AS is_international,
  event_id AS event_sequence_num
FROM {events}
"""

# Order that makes the keep-latest winner a total order in every engine.
TXN_LOAD_ORDER = ("load_seq", "load_tie", "load_tie2")


def duck(sql: str) -> str:
    """The adapter text for DuckDB (tables are pre-registered views)."""
    return sql.replace("{S}", "varchar").replace("{lineitem}", "lineitem").replace("{events}", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, placed: bool = False) -> DataFrame:
    """Adapter A: one raw batch transaction per ``lineitem`` row (F1 + load order columns); ``placed``: with the row's
    position in the files (``dedup.with_position``)."""
    text, rows = TXN_SQL.replace("{S}", "string"), table(spark, sf_dir, "lineitem")
    if placed:
        text, rows = text.replace("SELECT", "SELECT _file, _row,", 1), with_position(rows)
    return spark.sql(text, lineitem=rows)


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter B: one stream payload per ``events`` row."""
    return spark.sql(EVENT_TXN_SQL.replace("{S}", "string"), events=table(spark, sf_dir, "events"))


# Six fraction digits keep TIMESTAMP_NTZ values exact through the JSON round trip.
JSON_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter B packed as message-bus envelopes: JSON ``body`` bytes, enqueue time
    (event time + 5 s), sequence number and offset; one envelope per ``events`` row."""
    from pyspark.sql import functions as F

    ev = event_transactions(spark, sf_dir)
    body = F.to_json(F.struct(*[F.col(c) for c in ev.columns]), {"timestampNTZFormat": JSON_NTZ_FORMAT})
    return ev.select(
        body.cast("binary").alias("body"),
        (F.col("transaction_datetime") + F.expr("INTERVAL 5 SECONDS")).alias("enqueuedTime"),
        F.col("event_sequence_num").alias("sequenceNumber"),
        F.col("event_sequence_num").cast("string").alias("offset"),
    )


def faulty_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The envelopes with a body that is no JSON (every 53rd) or has no transaction id (every 59th)."""
    from pyspark.sql import functions as F

    whole, seq = event_envelopes(spark, sf_dir), F.col("sequenceNumber")
    no_id = F.regexp_replace(F.col("body").cast("string"), '"transaction_id":"[^"]*",', "").cast("binary")
    body = F.when(seq % 53 == 0, F.lit("corrupt").cast("binary")).when(seq % 59 == 0, no_id).otherwise(F.col("body"))
    return whole.withColumn("body", body)
