"""Queries of the ingestion and curation operators, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.hashing import file_id, record_hash
from sluice.functions.text import canonical_id, normalized_header
from sluice.operators import keys, ledger, merge, rejects, retention, stamps, validate, watermark
from sluice.operators.contract import Contract, ContractColumn, apply_contract, resolve_header
from sluice.plans import decks
from sluice.plans.decks import CURATED, DECK, HASHED, KEYED, LANDED
from sluice.session import table
from sluice.sources import kafka, raw, sqltext

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its own name, with the SQL that must give the same rows."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


# latest row per key, blank keys, duplicates


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1")
def dedup_latest_by_key(spark, root):
    return keys.latest_per_key(table(spark, root, "orders"), ["o_custkey"], decks.ORDER).select("o_custkey", "o_orderkey", "o_orderdate")


@query("""WITH d AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END AS version FROM orders)
 SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY version ASC NULLS FIRST, o_orderkey ASC) = 1""")
def dedup_asc_nulls_first(spark, root):
    d = table(spark, root, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate")).alias("version"))
    return keys.latest_per_key(d, ["o_custkey"], "version asc nulls_first,o_orderkey asc")


@query("""WITH d AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE cast(o_orderkey AS varchar) END AS seq FROM orders)
 SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY try_cast(seq AS bigint) DESC NULLS LAST, o_orderkey DESC) = 1""")
def dedup_typed_order(spark, root):
    d = table(spark, root, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.col("o_orderkey").cast("string")).alias("seq"))
    return keys.latest_per_key(d, ["o_custkey"], "seq as bigint,o_orderkey")


@query("SELECT DISTINCT o_custkey, true AS was_there FROM orders")
def dedup_unordered_keys(spark, root):
    """One row per key, no order given: which one is open, but it is one of the table's."""
    orders = table(spark, root, "orders")
    kept = keys.latest_per_key(orders, ["o_custkey"], "").select("o_custkey", "o_orderkey")
    own = orders.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"))
    met = kept.join(own, (F.col("o_orderkey") == F.col("k")) & F.col("o_custkey").eqNullSafe(F.col("c")), "left")
    return met.select("o_custkey", F.col("k").isNotNull().alias("was_there"))


@query(f"WITH {KEYED} SELECT * FROM keyed WHERE NOT (cust IS NULL OR trim(cust) = '')")
def null_key_split_valid(spark, root):
    return keys.split_blank_keys(decks.keyed_orders(spark, root), ["cust"])[0]


@query(f"WITH {KEYED} SELECT * FROM keyed WHERE cust IS NULL OR trim(cust) = ''")
def null_key_split_dropped(spark, root):
    return keys.split_blank_keys(decks.keyed_orders(spark, root), ["cust"])[1]


@query(f"WITH {KEYED} SELECT o_orderkey, lpad(trim(cust), 8, '0') AS cust FROM keyed")
def key_normalize(spark, root):
    return keys.normalize_keys(decks.keyed_orders(spark, root), {"cust": "lpad(trim(cust), 8, '0')"}).select("o_orderkey", "cust")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY ALL HAVING count(*) > 1")
def duplicate_business_keys(spark, root):
    return keys.duplicate_keys(table(spark, root, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT record_hash, count(*) AS n_rows FROM (SELECT sha256(concat_ws(chr(1), coalesce(entity, chr(0)), coalesce(text, chr(0)))) AS record_hash FROM documents) GROUP BY 1 HAVING count(*) > 1")
def keyless_duplicate_content(spark, root):
    d = table(spark, root, "documents").select(record_hash(["text", "entity"]).alias("record_hash"))
    return keys.duplicate_keys(d, ["record_hash"])


@query(f"WITH {KEYED} SELECT o_orderkey, cust FROM keyed WHERE cust IS NOT NULL AND try_cast(cust AS int) IS NULL")
def freshness_parse_honesty(spark, root):
    from sluice.functions.order import parse_terms

    return keys.unchecked_casts(decks.keyed_orders(spark, root), parse_terms("cust as int")).select("o_orderkey", "cust")


# merges

_SIDES = "FROM tgt t FULL JOIN inc i ON t.o_custkey IS NOT DISTINCT FROM i.o_custkey"
_FRESH = "(i.o_orderdate > t.o_orderdate OR (i.o_orderdate = t.o_orderdate AND i.o_orderkey > t.o_orderkey))"
_OUTCOME = f"CASE WHEN i.o_custkey IS NULL THEN 'unchanged' WHEN t.o_custkey IS NULL THEN 'inserted' WHEN {_FRESH} THEN 'updated' ELSE 'ignored' END"
MERGED_SQL = f"""{DECK}, merged AS (SELECT CASE WHEN t.o_custkey IS NULL OR coalesce({_FRESH}, false) THEN i.o_custkey ELSE t.o_custkey END AS o_custkey,
 CASE WHEN t.o_custkey IS NULL OR coalesce({_FRESH}, false) THEN i.o_orderkey ELSE t.o_orderkey END AS o_orderkey,
 CASE WHEN t.o_custkey IS NULL OR coalesce({_FRESH}, false) THEN i.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
 CASE WHEN t.o_custkey IS NULL OR coalesce({_FRESH}, false) THEN i.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority, {_OUTCOME} AS outcome {_SIDES})"""


def _merged(spark, root, small=None):
    m = merge.merge(decks.incoming_orders(spark, root), decks.target_orders(spark, root), decks.MERGE, small)
    return m.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority", F.col(merge.OUTCOME).alias("outcome"))


@query(f"WITH {MERGED_SQL} SELECT * FROM merged")
def merge_freshness_rows(spark, root):
    return _merged(spark, root)


@query(f"WITH {MERGED_SQL} SELECT * FROM merged")
def merge_freshness_rows_shuffled(spark, root):
    """The same merge by the plan for batches too large to broadcast."""
    return _merged(spark, root, small=False)


@query(f"WITH {MERGED_SQL} SELECT count(*) FILTER (outcome = 'inserted') AS inserted, count(*) FILTER (outcome = 'updated') AS updated, cast(0 AS bigint) AS deleted, count(*) FILTER (outcome = 'ignored') AS ignored FROM merged")
def merge_freshness_counts(spark, root):
    return merge.outcome_counts(merge.merge(decks.incoming_orders(spark, root), decks.target_orders(spark, root), decks.MERGE))


@query(f"WITH {DECK} SELECT t.o_custkey, t.o_orderkey FROM tgt t WHERE EXISTS (SELECT 1 FROM inc i WHERE i.o_custkey IS NOT DISTINCT FROM t.o_custkey)")
def join_contested(spark, root):
    m = merge.merge(decks.incoming_orders(spark, root), decks.target_orders(spark, root), replace(decks.MERGE, freshness="o_orderdate"))
    t = decks.target_orders(spark, root)
    met = m.filter(F.col(merge.OUTCOME).isin("updated", "ignored")).select(F.col("o_custkey").alias("k"))
    return t.join(met, t["o_custkey"].eqNullSafe(F.col("k")), "left_semi").select("o_custkey", "o_orderkey")


@query(f"WITH {DECK} SELECT t.o_custkey, t.o_orderkey FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM inc i WHERE i.o_custkey IS NOT DISTINCT FROM t.o_custkey)")
def join_unchanged(spark, root):
    m = merge.merge(decks.incoming_orders(spark, root), decks.target_orders(spark, root), decks.MERGE)
    return m.filter(F.col(merge.OUTCOME) == "unchanged").select("o_custkey", "o_orderkey")


_HASH_DECK = f"{DECK}, hi AS ({HASHED.format(t='inc')}), ht AS ({HASHED.format(t='tgt')}), j AS (SELECT t.o_custkey AS tk, i.o_custkey AS ik, t.o_orderkey AS to_, i.o_orderkey AS io, t.o_orderdate AS td, i.o_orderdate AS id, t.record_hash AS th, i.record_hash AS ih FROM ht t FULL JOIN hi i ON t.o_custkey IS NOT DISTINCT FROM i.o_custkey)"
_NEWER = "(id > td OR (id = td AND io > to_))"


@query(f"""WITH {_HASH_DECK} SELECT coalesce(ik, tk) AS o_custkey, CASE WHEN tk IS NULL OR (ik IS NOT NULL AND ih <> th AND {_NEWER}) THEN ih ELSE th END AS record_hash,
 CASE WHEN ik IS NULL THEN 'unchanged' WHEN tk IS NULL THEN 'inserted' WHEN ih = th THEN 'ignored' WHEN {_NEWER} THEN 'updated' ELSE 'ignored' END AS outcome FROM j""")
def merge_no_change_filter(spark, root):
    m = merge.merge(decks.hashed(decks.incoming_orders(spark, root)), decks.hashed(decks.target_orders(spark, root)), decks.MERGE)
    return m.select("o_custkey", "record_hash", F.col(merge.OUTCOME).alias("outcome"))


@query(f"""WITH {_HASH_DECK} SELECT coalesce(ik, tk) AS o_custkey, CASE WHEN tk IS NULL OR coalesce(ih = th AND id > td, false) OR coalesce(ih <> th AND {_NEWER}, false) THEN io ELSE to_ END AS o_orderkey,
 CASE WHEN tk IS NULL OR coalesce(ih = th AND id > td, false) OR coalesce(ih <> th AND {_NEWER}, false) THEN id ELSE td END AS o_orderdate FROM j""")
def merge_version_advance(spark, root):
    m = merge.merge(decks.hashed(decks.incoming_orders(spark, root)), decks.hashed(decks.target_orders(spark, root)), decks.MERGE)
    return m.select("o_custkey", "o_orderkey", "o_orderdate")


_AUDIT_DECK = f"{DECK}, ci AS ({CURATED.format(created='2024-02-02', op='I', t='inc')}), ct AS ({CURATED.format(created='2020-01-01', op='I', t='tgt')})"


def _audited(spark, root, spec):
    return merge.merge(decks.audited(decks.incoming_orders(spark, root), "2024-02-02", "I"), decks.audited(decks.target_orders(spark, root), "2020-01-01", "I"), spec)


@query(f"""WITH {_AUDIT_DECK} SELECT coalesce(i.o_custkey, t.o_custkey) AS o_custkey, coalesce(t.create_timestamp, i.create_timestamp) AS create_timestamp,
 CASE WHEN t.o_custkey IS NULL THEN 'I' WHEN coalesce({_FRESH}, false) THEN 'U' ELSE t.last_modified_op END AS last_modified_op FROM ct t FULL JOIN ci i ON t.o_custkey = i.o_custkey""")
def merge_update_audit(spark, root):
    return _audited(spark, root, decks.MERGE).select("o_custkey", "create_timestamp", "last_modified_op")


@query(f"""WITH {_AUDIT_DECK}, m AS (SELECT *, t.o_custkey IS NULL OR coalesce({_FRESH}, false) AS wins, i.o_orderstatus = 'P' AS dead, t.o_custkey AS tk, i.o_custkey AS ik FROM ct t FULL JOIN ci i ON t.o_custkey = i.o_custkey)
 SELECT coalesce(ik, tk) AS o_custkey, wins AND dead AS is_deleted, CASE WHEN NOT wins THEN 'I' WHEN dead THEN 'D' WHEN tk IS NOT NULL THEN 'U' ELSE 'I' END AS last_modified_op,
 CASE WHEN ik IS NULL THEN 'unchanged' WHEN NOT wins THEN 'ignored' WHEN dead THEN 'deleted' WHEN tk IS NULL THEN 'inserted' ELSE 'updated' END AS outcome FROM m""".replace("SELECT *, t.o_custkey IS NULL", "SELECT t.o_custkey IS NULL"))
def merge_soft_delete(spark, root):
    spec = replace(decks.MERGE, deletes="SOFT", indicator="o_orderstatus", indicator_values=("p",))
    return _audited(spark, root, spec).select("o_custkey", "is_deleted", "last_modified_op", F.col(merge.OUTCOME).alias("outcome"))


_SOFT = f"m AS (SELECT t.o_custkey IS NULL OR coalesce({_FRESH}, false) AS wins, i.o_orderstatus = 'P' AS dead, t.o_custkey AS tk, i.o_custkey AS ik FROM ct t FULL JOIN ci i ON t.o_custkey = i.o_custkey)"


@query(f"WITH {_AUDIT_DECK}, {_SOFT} SELECT count(*) FILTER (ik IS NOT NULL AND wins AND NOT dead AND tk IS NULL) AS inserted, count(*) FILTER (ik IS NOT NULL AND wins AND NOT dead AND tk IS NOT NULL) AS updated, count(*) FILTER (wins AND dead) AS deleted, count(*) FILTER (ik IS NOT NULL AND NOT wins) AS ignored FROM m")
def merge_delete_counts(spark, root):
    """Counters with tombstones: each key is exactly one of inserted, updated, deleted, ignored."""
    return merge.outcome_counts(_audited(spark, root, replace(decks.MERGE, deletes="SOFT", indicator="o_orderstatus", indicator_values=("p",))))


@query(f"""WITH {MERGED_SQL}, k AS (SELECT CASE WHEN o_orderkey % 17 <> 0 THEN o_custkey END AS o_custkey, o_orderkey FROM arriving)
 SELECT count(*) FILTER (o_custkey IS NOT NULL) AS keyed, count(*) FILTER (o_custkey IS NULL) AS keyless, cast(sum(o_orderkey) FILTER (o_custkey IS NULL) AS bigint) AS keyless_sum FROM (SELECT o_custkey, o_orderkey FROM merged UNION ALL SELECT o_custkey, o_orderkey FROM k WHERE o_custkey IS NULL)""")
def merge_passthrough_keyless(spark, root):
    batch = decks.arriving_orders(spark, root).withColumn("o_custkey", F.when(F.col("o_orderkey") % 17 != 0, F.col("o_custkey")))
    keyless = keys.split_blank_keys(batch, ["o_custkey"])[1]
    target = decks.target_orders(spark, root)
    m = merge.with_passthrough(merge.merge(decks.incoming_orders(spark, root), target, decks.MERGE), keyless, target.columns)
    passed = F.col(merge.OUTCOME) == merge.PASSED
    return m.agg(F.sum((~passed).cast("int")).alias("keyed"), F.sum(passed.cast("int")).alias("keyless"), F.sum(F.when(passed, F.col("o_orderkey"))).alias("keyless_sum"))


@query(f"WITH {DECK} SELECT o_custkey, o_orderkey FROM inc UNION ALL SELECT o_custkey, o_orderkey FROM tgt WHERE o_custkey NOT IN (SELECT o_custkey FROM inc)")
def merge_last_write_wins(spark, root):
    spec = merge.MergeSpec(keys=("o_custkey",), strategy="LAST_WRITE_WINS", allow_last_write_wins=True)
    return merge.merge(decks.incoming_orders(spark, root), decks.target_orders(spark, root), spec).select("o_custkey", "o_orderkey")


@query(f"""WITH {_AUDIT_DECK} SELECT o_custkey, last_modified_op, is_deleted FROM ci UNION ALL SELECT o_custkey, 'D', true FROM ct WHERE o_custkey NOT IN (SELECT o_custkey FROM ci)""")
def full_absence_tombstones(spark, root):
    spec = merge.MergeSpec(keys=("o_custkey",), deletes="FULL_SNAPSHOT_ABSENCE", confirm_complete_extract=True)
    m = merge.full_publish(decks.audited(decks.incoming_orders(spark, root), "2024-02-02", "I"), decks.audited(decks.target_orders(spark, root), "2020-01-01", "I"), spec)
    return m.select("o_custkey", "last_modified_op", "is_deleted")


_SCOPED = replace(decks.MERGE, partition_columns=("o_orderpriority",))
_HEAD = "inc2 AS (SELECT * FROM inc WHERE o_orderpriority = '1-URGENT'), parts AS (SELECT o_orderpriority FROM inc2 UNION SELECT t.o_orderpriority FROM tgt t JOIN inc2 i ON t.o_custkey = i.o_custkey)"


def _scoped_inputs(spark, root):
    return decks.incoming_orders(spark, root).filter("o_orderpriority = '1-URGENT'"), decks.target_orders(spark, root)


@query(f"WITH {DECK}, {_HEAD} SELECT * FROM parts")
def partition_affected(spark, root):
    return merge.affected_partitions(*_scoped_inputs(spark, root), _SCOPED)


@query(f"""WITH {DECK}, {_HEAD}, slice AS (SELECT * FROM tgt WHERE o_orderpriority IN (SELECT o_orderpriority FROM parts))
 SELECT CASE WHEN t.o_custkey IS NULL OR coalesce({_FRESH}, false) THEN i.o_custkey ELSE t.o_custkey END AS o_custkey, CASE WHEN t.o_custkey IS NULL OR coalesce({_FRESH}, false) THEN i.o_orderkey ELSE t.o_orderkey END AS o_orderkey, CASE WHEN t.o_custkey IS NULL OR coalesce({_FRESH}, false) THEN i.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority FROM slice t FULL JOIN inc2 i ON t.o_custkey = i.o_custkey""")
def partition_scoped_merge(spark, root):
    return merge.scoped_merge(*_scoped_inputs(spark, root), _SCOPED)[0].select("o_custkey", "o_orderkey", "o_orderpriority")


@query("SELECT o_orderpriority FROM (SELECT DISTINCT o_orderpriority FROM orders EXCEPT SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority <> '2-HIGH')")
def partition_emptied(spark, root):
    orders = table(spark, root, "orders")
    return merge.emptied_partitions(orders.select("o_orderpriority").distinct(), orders.filter("o_orderpriority <> '2-HIGH'"))


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END, 'NONE') AS o_orderpriority FROM orders")
def partition_null_default(spark, root):
    d = table(spark, root, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    return merge.null_partitions(d, ["o_orderpriority"], "DEFAULT", {"o_orderpriority": "NONE"})


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS o_orderpriority, true AS refused FROM orders")
def partition_null_policies(spark, root):
    """HIVE leaves null partition values as they are, REJECT refuses a batch that has some."""
    d = table(spark, root, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    try:
        merge.null_partitions(d, ["o_orderpriority"], "REJECT")
        refused = False
    except merge.MergeError:
        refused = True
    return merge.null_partitions(d, ["o_orderpriority"], "HIVE").withColumn("refused", F.lit(refused))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS order_month, 'orders' AS feed FROM orders")
def partition_derive(spark, root):
    return stamps.derive_partitions(table(spark, root, "orders"), {"order_month": "date_format(o_orderdate, 'yyyy-MM')", "feed": {"literal": "orders"}}).select("o_orderkey", "order_month", "feed")


@query(f"WITH {MERGED_SQL} SELECT o_custkey, o_orderkey, CASE WHEN outcome = 'unchanged' THEN 'unchanged' ELSE 'ignored' END AS outcome FROM merged")
def merge_replayed_batch(spark, root):
    """A batch that is delivered again changes nothing: its rows tie with what they wrote."""
    batch = decks.incoming_orders(spark, root)
    once = merge.merge(batch, decks.target_orders(spark, root), decks.MERGE).drop(merge.OUTCOME)
    return merge.merge(batch, once, decks.MERGE).select("o_custkey", "o_orderkey", F.col(merge.OUTCOME).alias("outcome"))


@query(f"WITH {MERGED_SQL} SELECT o_custkey, cast(o_orderkey AS varchar) AS o_orderkey, outcome FROM merged")
def merge_logical_version(spark, root):
    """Versions kept as text, compared as what they stand for."""
    spec = merge.MergeSpec(keys=("o_custkey",), freshness="version", compare_as="timestamp_ntz", tie_breakers=("o_orderkey as bigint",))
    text = lambda df: df.select("o_custkey", F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_orderdate").cast("string").alias("version"))
    m = merge.merge(text(decks.incoming_orders(spark, root)), text(decks.target_orders(spark, root)), spec)
    return m.select("o_custkey", "o_orderkey", F.col(merge.OUTCOME).alias("outcome"))


@query(f"WITH {DECK} SELECT o_custkey, o_orderkey, o_orderpriority FROM tgt WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def partition_slice_literals(spark, root):
    parts = spark.createDataFrame([("1-URGENT",), ("5-LOW",)], "o_orderpriority string")
    return merge.partition_slice(decks.target_orders(spark, root), parts).select("o_custkey", "o_orderkey", "o_orderpriority")


# landing


@query(f"WITH {LANDED}, batch AS (SELECT * FROM landed WHERE modified_ts >= TIMESTAMP '2024-01-10'), old AS (SELECT * FROM landed WHERE modified_ts < TIMESTAMP '2024-01-20') SELECT b.* FROM batch b ANTI JOIN old o ON b.event_id IS NOT DISTINCT FROM o.event_id AND b.modified_ts IS NOT DISTINCT FROM o.modified_ts")
def raw_dedup_append(spark, root):
    """An extract that overlaps what has landed."""
    landed = decks.landed_events(spark, root)
    return raw.not_landed(landed.filter("modified_ts >= TIMESTAMP_NTZ '2024-01-10 00:00:00'"), landed.filter("modified_ts < TIMESTAMP_NTZ '2024-01-20 00:00:00'"), ["event_id", "modified_ts"])


@query(f"WITH {LANDED}, b AS (SELECT *, sha256(source_file) AS file_id FROM landed) SELECT event_id, source_file, file_id FROM b WHERE file_id NOT IN (SELECT file_id FROM b WHERE source_file = 'file_1')")
def raw_exclude_loaded_files(spark, root):
    landed = decks.landed_events(spark, root).withColumn("file_id", file_id(F.col("source_file")))
    return raw.without_loaded_files(landed, landed.filter("source_file = 'file_1'"))[0].select("event_id", "source_file", "file_id")


@query(f"WITH {LANDED} SELECT user_id, date_trunc('day', modified_ts) AS version, count(*) AS n_rows FROM landed GROUP BY ALL HAVING count(*) > 1")
def raw_duplicate_versions(spark, root):
    d = decks.landed_events(spark, root).withColumn("version", F.date_trunc("day", F.col("modified_ts")).cast("timestamp_ntz"))
    return keys.duplicate_keys(d, ["user_id", "version"], with_blank=True)


@query(f"WITH {LANDED} SELECT event_id, run_id FROM landed WHERE run_id = 'run_2024-01-05'")
def raw_slice_by_run(spark, root):
    return raw.slice_of(decks.landed_events(spark, root), run_id="run_2024-01-05").select("event_id", "run_id")


@query(f"WITH {LANDED} SELECT run_id, count(*) AS n_rows FROM landed GROUP BY 1")
def raw_counts_by_run(spark, root):
    return raw.counts_by_run(decks.landed_events(spark, root))


@query(f"WITH {LANDED} SELECT DISTINCT sha256(source_file) AS file_id FROM landed WHERE source_file = 'file_1'")
def raw_loaded_file_ids(spark, root):
    landed = decks.landed_events(spark, root).withColumn("file_id", file_id(F.col("source_file")))
    return raw.without_loaded_files(landed, landed.filter("source_file = 'file_1'"))[1]


@query("SELECT s_suppkey, sha256(concat_ws(chr(1), cast(s_name AS varchar), cast(s_nationkey AS varchar), cast(s_suppkey AS varchar))) AS record_hash FROM supplier")
def record_hash_stamp(spark, root):
    return stamps.stamp_hash(table(spark, root, "supplier").drop("s_acctbal")).select("s_suppkey", "record_hash")


@query("""SELECT n_nationkey, 'v1:' || sha256('{"n_nationkey":' || cast(n_nationkey AS varchar) || ',"n_name":"' || n_name || '"}') AS source_primary_key, CASE WHEN n_regionkey = 1 THEN 'D' ELSE 'UPSERT' END AS source_operation FROM nation""")
def source_key_hash(spark, root):
    return stamps.stamp_extended(table(spark, root, "nation"), ["n_nationkey", "n_name"], delete_indicator="n_regionkey").select("n_nationkey", "source_primary_key", "source_operation")


@query("SELECT r_regionkey, 'region.csv' AS source_file, sha256('region.csv') AS file_id, 'csv' AS file_type, 'r1' AS run_id, 'TPC' AS source_system, '' AS extract_start_ts FROM region")
def raw_metadata_stamp(spark, root):
    d = stamps.stamp_raw(table(spark, root, "region"), "csv", stamps.Lineage("r1", source_system="TPC"), source_file=F.lit("region.csv"))
    return d.select("r_regionkey", "source_file", "file_id", "file_type", "run_id", "source_system", "extract_start_ts")


# rejects and checks

_RULES = [
    rejects.RejectRule("status", "o_orderstatus = 'P'", "R_STATUS", "open order", "BUSINESS"),
    rejects.RejectRule("price", "o_totalprice < 1000 AND cust <> ''", "R_PRICE", "price too low"),
    rejects.required_rule("cust", "R_KEY"),
]
_REJECT_CASE = "CASE WHEN o_orderstatus = 'P' THEN 'R_STATUS' WHEN coalesce(o_totalprice < 1000 AND cust <> '', false) THEN 'R_PRICE' WHEN cust IS NULL OR trim(cust) = '' THEN 'R_KEY' END"
_REJECT_DECK = f"{KEYED}, rows AS (SELECT k.*, o.o_totalprice FROM keyed k JOIN orders o USING (o_orderkey)), c AS (SELECT o_orderkey, {_REJECT_CASE} AS error_code FROM rows)"


def _reject_input(spark, root):
    price = table(spark, root, "orders")
    key = F.when(F.col("o_orderkey") % 17 == 0, F.lit(None)).when(F.col("o_orderkey") % 19 == 0, F.lit("  ")).otherwise(F.col("o_custkey").cast("string"))
    return price.withColumn("cust", key)


@query(f"WITH {_REJECT_DECK} SELECT o_orderkey FROM c WHERE error_code IS NULL")
def reject_split_accepted(spark, root):
    return rejects.split(_reject_input(spark, root), _RULES)[0].select("o_orderkey")


@query(f"WITH {_REJECT_DECK} SELECT o_orderkey, error_code FROM c WHERE error_code IS NOT NULL")
def reject_split_rejected(spark, root):
    return rejects.split(_reject_input(spark, root), _RULES)[1].select("o_orderkey", "error_code")


@query(f"WITH {_REJECT_DECK} SELECT error_code, CASE error_code WHEN 'R_STATUS' THEN 'BUSINESS' WHEN 'R_PRICE' THEN 'CONTENT' ELSE 'NULLABILITY' END AS reject_category, count(*) AS n_rows FROM c WHERE error_code IS NOT NULL GROUP BY 1, 2")
def reject_summary_by_code(spark, root):
    return rejects.summary(rejects.split(_reject_input(spark, root), _RULES)[1])


@query("""SELECT s_suppkey, '{"s_suppkey":' || s_suppkey || ',"s_name":"' || sha256(s_name) || '"}' AS masked, '{"s_suppkey":"' || sha256(cast(s_suppkey AS varchar)) || '","s_name":"' || sha256(s_name) || '"}' AS hashed,
 '{"s_suppkey":' || s_suppkey || '}' AS keys_only, '{"s_name":"' || sha256(s_name) || '"}' AS secret_key, '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '"}' AS whole FROM supplier""")
def reject_payload_modes(spark, root):
    cols, hide = ["s_suppkey", "s_name"], ["s_name"]
    shown = {
        "masked": rejects.payload(cols, "MASKED", sensitive=hide),
        "hashed": rejects.payload(cols, "HASHED"),
        "keys_only": rejects.payload(cols, "KEYS_ONLY", keys=["s_suppkey"], sensitive=hide),
        "secret_key": rejects.payload(cols, "KEYS_ONLY", keys=["s_name"], sensitive=hide),
        "whole": rejects.payload(cols, "FULL"),
    }
    return table(spark, root, "supplier").select("s_suppkey", *[c.alias(n) for n, c in shown.items()])


@query(f"WITH {_REJECT_DECK}, old AS (SELECT o_orderkey, error_code, CASE WHEN o_orderkey % 2 = 0 THEN 'r1' ELSE 'r2' END AS run_id FROM c WHERE error_code IS NOT NULL) SELECT * FROM old WHERE run_id <> 'r1' UNION ALL SELECT o_orderkey, 'R_NEW', 'r1' FROM old WHERE run_id = 'r1'")
def reject_slice_replace(spark, root):
    """A stage that runs again replaces its own slice of the reject table, if it differs."""
    bad = rejects.split(_reject_input(spark, root), _RULES)[1]
    old = bad.select("o_orderkey", "error_code", F.when(F.col("o_orderkey") % 2 == 0, "r1").otherwise("r2").alias("run_id"))
    return rejects.replaced_slice(old, old.filter("run_id = 'r1'").withColumn("error_code", F.lit("R_NEW")), {"run_id": "r1"})


_CONTENT = {
    "c_name": validate.ContentRule(regex=r"^Customer#0*[1-9][0-9]*[02468]$"),
    "c_mktsegment": validate.ContentRule(allowed_values=("BUILDING", "MACHINERY"), max_length=9),
    "c_nationkey": validate.ContentRule(numeric=True, min_length=2),
}


@query(r"""WITH s AS (SELECT count(*) AS n, cast(sum((c_name IS NULL)::int) AS bigint) AS z0, sum((NOT coalesce(regexp_matches(trim(c_name), '^Customer#0*[1-9][0-9]*[02468]$'), false))::int) AS f0,
 cast(sum((c_mktsegment IS NULL)::int) AS bigint) AS z1, sum((NOT coalesce(trim(c_mktsegment) IN ('BUILDING','MACHINERY') AND length(trim(c_mktsegment)) <= 9, false))::int) AS f1,
 cast(sum((c_nationkey IS NULL)::int) AS bigint) AS z2, sum((NOT coalesce(length(cast(c_nationkey AS varchar)) >= 2, false))::int) AS f2 FROM customer)
 SELECT 'c_name' AS column_name, n AS n_rows, z0 AS n_null, cast(f0 AS bigint) AS n_failed FROM s UNION ALL SELECT 'c_mktsegment', n, z1, cast(f1 AS bigint) FROM s UNION ALL SELECT 'c_nationkey', n, z2, cast(f2 AS bigint) FROM s""")
def content_rule_failures(spark, root):
    return validate.content_failures(table(spark, root, "customer"), _CONTENT)


@query(f"WITH {KEYED} SELECT 'cust' AS column_name, 'int' AS type, count(*) FILTER (cust IS NOT NULL AND try_cast(cust AS int) IS NULL) AS n_lost FROM keyed UNION ALL SELECT 'o_orderstatus', 'int', count(*) FILTER (o_orderstatus IS NOT NULL) FROM keyed")
def cast_loss_counts(spark, root):
    return validate.cast_losses(decks.keyed_orders(spark, root), {"cust": "int", "o_orderstatus": "int"})


@query(f"WITH {KEYED} SELECT 'cust' AS column_name, count(*) AS n_rows, count(*) FILTER (cust IS NULL) AS n_null FROM keyed UNION ALL SELECT 'o_orderdate', count(*), count(*) FILTER (o_orderdate IS NULL) FROM keyed")
def nullability_counts(spark, root):
    return validate.null_counts(decks.keyed_orders(spark, root), ["cust", "o_orderdate"])


@query("SELECT cast(sum(cast(l_quantity AS decimal(18,2))) AS varchar) AS control_total FROM lineitem")
def control_total(spark, root):
    return validate.control_total(table(spark, root, "lineitem"), "sum(cast(l_quantity AS decimal(18,2)))")


@query()
def content_sample(spark, root):
    """The sampling operator for cheap content checks: about 100 customers."""
    return validate.sample_rows(table(spark, root, "customer"), 100)


@query()
def partition_skew(spark, root):
    return validate.partition_skew(table(spark, root, "lineitem"))


# projections


@query("SELECT s_suppkey, TIMESTAMP '2024-01-01' AS create_timestamp, TIMESTAMP '2024-01-01' AS last_modified_ts, 'I' AS last_modified_op FROM supplier")
def audit_stamp(spark, root):
    return stamps.stamp_audit(table(spark, root, "supplier").select("s_suppkey"), F.lit("2024-01-01").cast("timestamp_ntz"))


@query("SELECT s_suppkey AS supplier, s_name AS label, 'none' AS note FROM supplier")
def contract_rename_defaults(spark, root):
    """Headers under their contract names, an absent optional column with its default."""
    c = Contract((ContractColumn("supplier", aliases=("s suppkey",)), ContractColumn("label", aliases=("S_NAME",)), ContractColumn("note", required=False, default="none")))
    d = table(spark, root, "supplier").select("s_suppkey", "s_name")
    return apply_contract(d, c, resolve_header(c, d.columns))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey >= 100 AND c_name LIKE '%7%'")
def structured_filter(spark, root):
    spark_sql = sqltext.Dialect("spark", "`", "`")
    filters = (sqltext.Filter("c_mktsegment", "IN", ["BUILDING", "MACHINERY"]), sqltext.Filter("c_custkey", ">=", 100, "NUMBER"), sqltext.Filter("c_name", "LIKE", "%7%"))
    d = table(spark, root, "customer")
    for f in filters:
        d = d.filter(F.expr(f.render(spark_sql)))
    return d.select("c_custkey", "c_mktsegment")


@query("SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND user_id <> 3 GROUP BY 1")
def sql_template(spark, root):
    """A template with typed parameters, checked to be one SELECT."""
    text = sqltext.render_template("SELECT event_type, count(*) AS n FROM {e} WHERE ts >= cast(:since AS timestamp_ntz) AND user_id <> :u GROUP BY event_type", sqltext.resolve_parameters({"since": {"value": "2024-01-10 00:00:00", "type": "TIMESTAMP"}, "u": {"value": 3, "type": "NUMBER"}}, {}, {}))
    return spark.sql(sqltext.single_select(text), e=table(spark, root, "events"))


@query("SELECT cast(c_custkey AS varchar) AS c_custkey, c_name, cast(NULL AS date) AS first_seen, 'NEW' AS segment_state, try_cast(c_name AS int) AS name_number FROM (SELECT c_custkey, c_name FROM customer)")
def align_to_target(spark, root):
    from pyspark.sql import types as T

    d = table(spark, root, "customer").select("c_custkey", F.col("c_name").alias("C_NAME"), F.col("c_name").alias("name_number"))
    schema = T.StructType([T.StructField("c_custkey", T.StringType()), T.StructField("c_name", T.StringType()), T.StructField("first_seen", T.DateType()), T.StructField("segment_state", T.StringType()), T.StructField("name_number", T.IntegerType())])
    return merge.align(d, schema, defaults={"segment_state": "NEW"})


@query("SELECT c_custkey, upper(c_name) AS c_name, nullif(trim(lower(c_mktsegment)), 'building') AS c_mktsegment FROM customer")
def contract_transforms(spark, root):
    d = table(spark, root, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return stamps.contract_transforms(d, {"c_name": "UPPER", "c_mktsegment": "nullif(trim(lower({col})), 'building')", "absent": "TRIM"})


@query("SELECT p_partkey, p_size + 1 AS size_next, (p_size + 1) * 2 AS size_double FROM part")
def derived_columns(spark, root):
    return stamps.derive(table(spark, root, "part"), [("size_next", "p_size + 1"), ("size_double", "size_next * 2")]).select("p_partkey", "size_next", "size_double")


@query("SELECT p_partkey, cast(p_size AS varchar) AS p_size, try_cast(p_brand AS int) AS p_brand FROM part")
def configured_casts(spark, root):
    return stamps.cast_columns(table(spark, root, "part").select("p_partkey", "p_size", "p_brand"), {"P_SIZE": "string", "p_brand": "int", "absent": "int"})


@query(r"SELECT header_id, pos, trim(regexp_replace(lower(h), '[^a-z0-9]+', '_', 'g'), '_') AS normalized FROM (SELECT header_id, unnest(string_split(actual_source_headers, ',')) AS h, unnest(range(len(string_split(actual_source_headers, ',')))) AS pos FROM ingest_header_audit)")
def header_normalize(spark, root):
    """Each header of each recorded file."""
    each = table(spark, root, "ingest_header_audit").select("header_id", F.posexplode(F.split("actual_source_headers", ",")).alias("pos", "h"))
    return each.select("header_id", F.col("pos").cast("bigint").alias("pos"), normalized_header(F.col("h")).alias("normalized"))


@query("SELECT s_suppkey AS id, s_name AS name, cast(NULL AS varchar) AS brand FROM supplier UNION ALL SELECT p_partkey, p_name, p_brand FROM part")
def union_by_name_missing(spark, root):
    s = table(spark, root, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    p = table(spark, root, "part").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"))
    from sluice.sources.files import union_groups

    return union_groups([s, p])


@query("SELECT n_nationkey AS k, n_name AS v FROM nation WHERE lower(trim(n_name)) <> 'n_name'")
def repeated_header_drop(spark, root):
    from sluice.sources.files import without_repeated_headers

    n = table(spark, root, "nation").select(F.col("n_nationkey").cast("string").alias("k"), F.col("n_name").alias("v"))
    again = spark.createDataFrame([("K ", "v")], "k string, v string")
    return without_repeated_headers(n.unionByName(again)).select(F.col("k").cast("bigint").alias("k"), "v")


@query("SELECT event_id, event_type FROM events WHERE NOT starts_with(lower(trim(event_type)), 'c')")
def trailer_marker_drop(spark, root):
    from sluice.sources.files import without_trailer

    return without_trailer(table(spark, root, "events").select("event_type", "event_id"), "C").select("event_id", "event_type")


# windows and watermarks

_TS = watermark.WatermarkSpec(("ts",), ("TIMESTAMP",))
_LO, _HI = ("2024-01-05 00:00:00",), ("2024-01-12 12:00:00",)


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-05' AND NOT ts > TIMESTAMP '2024-01-12 12:00:00'")
def window_bounded_legacy(spark, root):
    return watermark.window(table(spark, root, "events"), _TS, _LO, _HI).select("event_id", "ts")


@query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND NOT ts >= TIMESTAMP '2024-01-12 12:00:00'")
def window_bounded_half_open(spark, root):
    return watermark.window(table(spark, root, "events"), replace(_TS, convention=watermark.HALF_OPEN), _LO, _HI).select("event_id", "ts")


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-05' - INTERVAL 5400 SECOND AND NOT ts > TIMESTAMP '2024-01-12 12:00:00'")
def window_overlap(spark, root):
    return watermark.window(table(spark, root, "events"), replace(_TS, overlap=Decimal(5400)), _LO, _HI).select("event_id", "ts")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE (o_orderdate > TIMESTAMP '1996-03-01' OR (o_orderdate = TIMESTAMP '1996-03-01' AND o_orderkey > 500)) AND NOT (o_orderdate > TIMESTAMP '1997-03-01' OR (o_orderdate = TIMESTAMP '1997-03-01' AND o_orderkey > 900))")
def window_composite(spark, root):
    spec = watermark.WatermarkSpec(("o_orderdate", "o_orderkey"), ("TIMESTAMP", "NUMERIC"))
    return watermark.window(table(spark, root, "orders"), spec, ("1996-03-01 00:00:00", "500"), ("1997-03-01 00:00:00", "900")).select("o_orderkey", "o_orderdate")


@query("SELECT o_orderdate, o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def watermark_next_value(spark, root):
    return watermark.highest(table(spark, root, "orders"), watermark.WatermarkSpec(("o_orderdate", "o_orderkey"), ("TIMESTAMP", "NUMERIC")))


@query("SELECT min(l_orderkey) AS lower, max(l_orderkey) AS upper FROM lineitem")
def minmax_bounds(spark, root):
    return watermark.bounds(table(spark, root, "lineitem"), "l_orderkey")


@query("SELECT count(*) AS n_rows, count(*) - count(last_modified_ts) AS n_null FROM health_sherpa_member")
def null_watermark_guard(spark, root):
    return watermark.null_watermarks(table(spark, root, "health_sherpa_member"), watermark.WatermarkSpec(("last_modified_ts",), ("TIMESTAMP",)))


_HISTORY_SQL = "h AS (SELECT event_type AS entity, cast(value AS varchar) AS watermark_value, event_id // 4 AS watermark_version, ts AS updated_ts, event_id FROM events)"


def _history(spark, root):
    return table(spark, root, "events").select(F.col("event_type").alias("entity"), F.floor(F.col("event_id") / 4).alias("watermark_version"), F.col("ts").alias("updated_ts"), F.col("event_id").cast("string").alias("watermark_value"), "event_id")


@query(f"WITH {_HISTORY_SQL}, top AS (SELECT entity, max(watermark_version) AS watermark_version FROM h GROUP BY 1) SELECT h.entity, h.watermark_version, arg_max(cast(event_id AS varchar), (updated_ts, cast(event_id AS varchar))) AS watermark_value, count(*) AS n_writers FROM h JOIN top USING (entity, watermark_version) GROUP BY ALL")
def watermark_latest_version(spark, root):
    return watermark.latest_version(_history(spark, root))


@query(f"WITH {_HISTORY_SQL} SELECT entity, event_id FROM h QUALIFY row_number() OVER (PARTITION BY entity ORDER BY watermark_version DESC, updated_ts DESC) <= 3")
def watermark_keep_last_n(spark, root):
    return retention.keep_watermarks(_history(spark, root), 3).select("entity", "event_id")


# ledger

_RUNS = "SELECT run_id, entity, min((event_ts, run_mode, window_start, window_end)) AS f FROM ingest_run_audit WHERE stage = 'raw' AND status = 'SUCCESS' AND coalesce(message, '') <> 'dry-run' GROUP BY 1, 2"
_LEDGER = f"b AS (SELECT run_id, entity, f[1] AS raw_success_ts, f[2] AS run_mode, f[3] AS window_start, f[4] AS window_end FROM ({_RUNS.replace('min((event_ts, run_mode, window_start, window_end))', 'min(row(event_ts, run_mode, window_start, window_end))')})), done AS (SELECT DISTINCT run_id, entity FROM ingest_run_audit WHERE stage = 'curated' AND status = 'SUCCESS' AND coalesce(message, '') <> 'dry-run')"


@query(f"WITH {_LEDGER} SELECT * FROM b")
def ledger_raw_batches(spark, root):
    return ledger.batches(table(spark, root, "ingest_run_audit"))


@query(f"WITH {_LEDGER} SELECT b.* FROM b ANTI JOIN done USING (run_id, entity)")
def ledger_pending_batches(spark, root):
    return ledger.pending(table(spark, root, "ingest_run_audit"))


@query(f"WITH {_LEDGER} SELECT b.* FROM b ANTI JOIN done USING (run_id, entity) SEMI JOIN (SELECT run_id, entity FROM ingest_run_audit WHERE stage = 'curated' AND status = 'FAILED') f USING (run_id, entity)")
def ledger_failed_pending(spark, root):
    return ledger.failed_pending(table(spark, root, "ingest_run_audit"))


@query(f"WITH {_LEDGER} SELECT * FROM b WHERE entity = 'health_sherpa_member' AND cast(raw_success_ts AS date) BETWEEN DATE '2026-05-15' AND DATE '2026-05-20'")
def ledger_batches_between(spark, root):
    return ledger.batches_between(table(spark, root, "ingest_run_audit"), "health_sherpa_member", "2026-05-15", "2026-05-20")


@query(f"WITH {_LEDGER} SELECT * FROM b WHERE entity = 'health_sherpa_member' ORDER BY raw_success_ts DESC, run_id DESC LIMIT 5")
def ledger_last_batches(spark, root):
    return ledger.last_batches(table(spark, root, "ingest_run_audit"), "health_sherpa_member", 5)


@query("SELECT run_id, entity, stage, arg_max(status, row(event_ts, (status <> 'STARTED')::int, status)) AS status FROM ingest_run_audit GROUP BY ALL")
def latest_stage_status(spark, root):
    return ledger.latest_status(table(spark, root, "ingest_run_audit"))


_LATEST = "arg_max({v}, row(event_ts, (status <> 'STARTED')::int, {v})) FILTER (stage = '{s}')"
_FIRST = "arg_min({v}, row(event_ts, {v})) FILTER (stage = 'raw' AND status = 'SUCCESS' AND coalesce(message, '') <> 'dry-run')"


@query(f"""SELECT run_id AS batch_id, entity, {_FIRST.format(v='run_mode')} AS run_mode, {_FIRST.format(v='window_start')} AS extract_window_start, {_FIRST.format(v='window_end')} AS extract_window_end,
 {_LATEST.format(v='status', s='raw')} AS raw_status, {_LATEST.format(v='status', s='curated')} AS curated_status,
 bool_or(stage = 'curated' AND status = 'SUCCESS' AND coalesce(message, '') <> 'dry-run') AS curated_done, max(raw_count) FILTER (stage = 'raw') AS raw_count, max(accepted_count) FILTER (stage = 'raw') AS accepted_count,
 max(rejected_count) FILTER (stage = 'raw') AS rejected_count, {_LATEST.format(v='insert_count', s='curated')} AS insert_count, {_LATEST.format(v='update_count', s='curated')} AS update_count, {_LATEST.format(v='delete_count', s='curated')} AS delete_count,
 cast(sum((status = 'FAILED')::int) AS bigint) AS retry_count, min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts FROM ingest_run_audit GROUP BY run_id, entity""")
def ledger_batch_control(spark, root):
    return ledger.batch_control(table(spark, root, "ingest_run_audit"))


@query("SELECT entity, arg_max(run_id, row(event_ts, run_id, window_start, window_end)) AS run_id, arg_max(window_start, row(event_ts, run_id, window_start, window_end)) AS window_start, arg_max(window_end, row(event_ts, run_id, window_start, window_end)) AS window_end FROM ingest_run_audit WHERE stage = 'raw' AND status = 'SUCCESS' AND window_start <> '' GROUP BY 1")
def ledger_last_raw_window(spark, root):
    return ledger.last_raw_window(table(spark, root, "ingest_run_audit"))


@query("""WITH f AS (SELECT entity, run_id, min(event_ts) AS event_ts, arg_min(window_start, row(event_ts, window_start, window_end)) AS window_start, arg_min(window_end, row(event_ts, window_start, window_end)) AS window_end FROM ingest_run_audit WHERE stage = 'raw' AND status = 'SUCCESS' AND window_start <> '' GROUP BY 1, 2),
 l AS (SELECT *, lag(window_start) OVER w AS ps, lag(window_end) OVER w AS pe FROM f WINDOW w AS (PARTITION BY entity ORDER BY event_ts, run_id)) SELECT entity, run_id, window_start, window_end, pe AS prev_end, pe IS NULL OR window_start = pe OR window_start = ps AS continuous FROM l""")
def ledger_window_continuity(spark, root):
    return ledger.window_continuity(table(spark, root, "ingest_run_audit"))


@query("SELECT event_id, ts FROM events WHERE ts IS NULL OR ts >= TIMESTAMP '2024-01-15'")
def retention_survivors(spark, root):
    return retention.survivors_since(table(spark, root, "events"), "ts", F.lit("2024-01-15").cast("timestamp_ntz")).select("event_id", "ts")


@query(f"WITH {LANDED} SELECT DISTINCT ingest_dt FROM landed WHERE ingest_dt < '2024-01-10'")
def retention_expired_partitions(spark, root):
    return retention.expired_partitions(decks.landed_events(spark, root).select("ingest_dt").distinct(), "ingest_dt", "2024-01-10")


# topic-shaped input


@query("SELECT event_type AS topic, cast(user_id % 3 AS int) AS partition, max(event_id) + 1 AS until_offset FROM events GROUP BY ALL")
def kafka_offsets_committed(spark, root):
    e = table(spark, root, "events")
    ranges = e.select(F.lit("feed").alias("entity"), F.col("event_type").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"), F.col("event_id").alias("from_offset"), (F.col("event_id") + 1).alias("until_offset"))
    return kafka.committed(ranges).select("topic", "partition", "until_offset")


@query("SELECT event_id AS kafka_offset, event_id % 13 = 0 AS kafka_tombstone, CASE WHEN event_id % 13 <> 0 THEN cast(json_extract(props, '$.k') AS bigint) END AS k FROM events")
def kafka_decode_json(spark, root):
    e = table(spark, root, "events")
    records = e.select(
        F.col("user_id").cast("string").cast("binary").alias("key"), F.when(F.col("event_id") % 13 != 0, F.col("props")).cast("binary").alias("value"), F.col("event_type").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").alias("timestamp")
    )
    return kafka.decode(records, "json", "k bigint").select("kafka_offset", "kafka_tombstone", "k")


@query("SELECT rec_id, nullif(upper(regexp_replace(subscriber_id, '[^\\p{L}\\p{N}]', '', 'g')), '') AS subscriber_id FROM health_sherpa_member")
def canonical_subscriber_ids(spark, root):
    return table(spark, root, "health_sherpa_member").select("rec_id", canonical_id(F.col("subscriber_id")).alias("subscriber_id"))
