"""Deterministic inputs made from the test tables, as DataFrames and as SQL of the same meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.hashing import record_hash
from sluice.operators.keys import latest_per_key
from sluice.operators.merge import MergeSpec
from sluice.session import table

ORDER = "o_orderdate desc,o_orderkey desc"
MERGE = MergeSpec(keys=("o_custkey",), freshness="o_orderdate", tie_breakers=("o_orderkey",))


#: Which orders arrive and which are there already; every order is one or the other. Customers of one segment are new, those of another are left alone.
ARRIVES = "coalesce(c_mktsegment = 'BUILDING' OR (c_mktsegment <> 'MACHINERY' AND o_orderpriority IN ('1-URGENT', '2-HIGH')), false)"


def _by_role(spark: SparkSession, root: str, arrives: bool) -> DataFrame:
    orders = table(spark, root, "orders")
    segments = table(spark, root, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return orders.join(segments, "o_custkey", "left").filter(ARRIVES if arrives else f"NOT {ARRIVES}").select(*orders.columns)


def arriving_orders(spark: SparkSession, root: str) -> DataFrame:
    """All orders that arrive, several of a customer."""
    return _by_role(spark, root, True)


def incoming_orders(spark: SparkSession, root: str) -> DataFrame:
    """The latest arriving order of each customer."""
    return latest_per_key(arriving_orders(spark, root), ["o_custkey"], ORDER)


def target_orders(spark: SparkSession, root: str) -> DataFrame:
    """The latest of each customer among the orders that are there already."""
    return latest_per_key(_by_role(spark, root, False), ["o_custkey"], ORDER)


_LATEST = "SELECT * FROM {t} QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) = 1"
DECK = f"""roles AS (SELECT o.*, {ARRIVES} AS arrives FROM orders o LEFT JOIN customer ON c_custkey = o_custkey),
 arriving AS (SELECT * EXCLUDE (arrives) FROM roles WHERE arrives), there AS (SELECT * EXCLUDE (arrives) FROM roles WHERE NOT arrives),
 inc AS ({_LATEST.format(t='arriving')}), tgt AS ({_LATEST.format(t='there')})"""


def audited(df: DataFrame, created: str, op: str) -> DataFrame:
    """Orders as curated rows with audit columns, a hash of two columns and a delete flag."""
    return df.select(
        "o_custkey",
        "o_orderkey",
        "o_orderdate",
        "o_orderstatus",
        "o_orderpriority",
        F.lit(created).cast("timestamp_ntz").alias("create_timestamp"),
        F.lit(op).alias("last_modified_op"),
        F.lit(False).alias("is_deleted"),
    )


CURATED = "SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_orderpriority, TIMESTAMP '{created}' AS create_timestamp, '{op}' AS last_modified_op, false AS is_deleted FROM {t}"


def hashed(df: DataFrame) -> DataFrame:
    """Orders with a hash over status and priority only, so that many versions are no change."""
    slim = df.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    return slim.withColumn("record_hash", record_hash(["o_orderstatus", "o_orderpriority"]))


HASHED = "SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_orderpriority, sha256(concat_ws(chr(1), o_orderpriority, o_orderstatus)) AS record_hash FROM {t}"


def keyed_orders(spark: SparkSession, root: str) -> DataFrame:
    """Orders whose customer is missing or blank now and then."""
    key = F.when(F.col("o_orderkey") % 17 == 0, F.lit(None)).when(F.col("o_orderkey") % 19 == 0, F.lit("  ")).otherwise(F.col("o_custkey").cast("string"))
    return table(spark, root, "orders").select("o_orderkey", key.alias("cust"), "o_orderdate", "o_orderstatus")


KEYED = "keyed AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN '  ' ELSE cast(o_custkey AS varchar) END AS cust, o_orderdate, o_orderstatus FROM orders)"


def landed_events(spark: SparkSession, root: str) -> DataFrame:
    """Events as landed rows: a file per remainder of four, a window per day."""
    day = F.date_format("ts", "yyyy-MM-dd")
    return table(spark, root, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").alias("modified_ts"), F.concat(F.lit("file_"), (F.col("event_id") % 4).cast("string")).alias("source_file"), F.concat(F.lit("run_"), day).alias("run_id"), day.alias("ingest_dt")
    )


LANDED = "landed AS (SELECT event_id, user_id, event_type, ts AS modified_ts, 'file_' || cast(event_id % 4 AS varchar) AS source_file, 'run_' || strftime(ts, '%Y-%m-%d') AS run_id, strftime(ts, '%Y-%m-%d') AS ingest_dt FROM events)"
