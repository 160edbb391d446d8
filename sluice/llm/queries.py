"""Queries of the training-data problems and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.instants import micros_of
from sluice.functions.text import CANONICAL_ID_SQL, canonical_id, checksum_key
from sluice.llm import history, leakage, mojibake, survivor, tokens
from sluice.session import table

SURVIVOR_FIELDS = ["first_name", "middle_name", "last_name", "birth_date", "email", "phone", "hios_id"]


def _survivors(spark: SparkSession, root: str) -> DataFrame:
    records = table(spark, root, "health_sherpa_member_curated")
    rank = survivor.freshness_rank(records, table(spark, root, "freshness_spec"), "entity", "curated_id")
    return survivor.survivors(records, canonical_id(F.col("subscriber_id")), rank, "curated_id", SURVIVOR_FIELDS)


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return _survivors(spark, root).select(F.col("key").alias("subscriber_id"), "field_name", "curated_id")


def p3_survivor(spark: SparkSession, root: str) -> DataFrame:
    """The surviving record of each subscriber with two or more records, built field by field."""
    values = [F.max(F.when(F.col("field_name") == f, F.col("value"))).alias(f) for f in SURVIVOR_FIELDS]
    return _survivors(spark, root).groupBy(F.col("key").alias("subscriber_id")).agg(*values)


def p3_currency(spark: SparkSession, root: str) -> DataFrame:
    """The most current value per subscriber and field where missing timestamps are replaced by learnt precedence."""
    records = table(spark, root, "health_sherpa_member_curated")
    return survivor.latest_values(records, canonical_id(F.col("subscriber_id")), "last_modified_ts", "curated_id", SURVIVOR_FIELDS)


def _state(c: str):
    """A status without surrounding white space, in upper case."""
    return F.upper(F.regexp_replace(c, r"^\s+|\s+$", ""))


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    audit = table(spark, root, "ingest_file_audit")
    deliveries = audit.filter(_state("status") == "VALIDATED").select(
        F.col("audit_id").alias("id"), micros_of(F.col("event_ts"), audit.schema["event_ts"].dataType).alias("ts"), checksum_key(F.col("checksum")).alias("checksum"), F.col("file_path").alias("path")
    )
    accepted = table(spark, root, "ingest_file_registry").filter(_state("status") == "PROCESSED").select(checksum_key(F.col("checksum")).alias("checksum"), F.col("file_path").alias("path"))
    samples = table(spark, root, "file_sample").select(F.col("file_path").alias("path"), "content")
    return history.repeated_deliveries(deliveries, accepted, samples).select(F.col("id").alias("audit_id"), "match_kind")


def p7_ids(spark: SparkSession, root: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, root, "documents"))


def p8_found(spark: SparkSession, root: str) -> DataFrame:
    return leakage.leaks(table(spark, root, "documents"), table(spark, root, "eval_item"))


def p8_clean(spark: SparkSession, root: str) -> DataFrame:
    """Every document with the leaked words removed."""
    return leakage.without_leaks(table(spark, root, "documents"), table(spark, root, "eval_item"))


def p8_leaked_words(spark: SparkSession, root: str) -> DataFrame:
    """How many words of each document are leaked."""
    return p8_clean(spark, root).filter("n_leaked_words > 0").select("doc_id", "n_leaked_words")


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents")
    return mojibake.garbled_records(documents, mojibake.train(documents)).select("doc_id")


def p9_restored(spark: SparkSession, root: str) -> DataFrame:
    """Every document, garbled passages restored where that is possible."""
    documents = table(spark, root, "documents")
    return mojibake.repair_corpus(documents, mojibake.train(documents))


QUERIES = {f.__name__: f for f in (p3_found, p3_survivor, p3_currency, p4_found, p7_ids, p8_found, p8_clean, p8_leaked_words, p9_found, p9_restored)}

_KEY = CANONICAL_ID_SQL.format(c="subscriber_id")
_PLACEHOLDERS = ", ".join(f"'{v}'" for v in survivor.NO_VALUE)
_BARE = r"regexp_replace(lower({f}), '^[\s(<\[{{]+|[\s)>\]}}]+$', '', 'g')"
_CELLS = " UNION ALL ".join(f"SELECT k, '{f}' AS field_name, curated_id, rank, {f} AS value FROM ranked WHERE regexp_matches({_BARE.format(f=f)}, '[\\p{{L}}\\p{{N}}]') AND {_BARE.format(f=f)} NOT IN ({_PLACEHOLDERS})" for f in SURVIVOR_FIELDS)
_ENTITY_ORDER = """row_number() OVER (PARTITION BY k ORDER BY last_modified_ts DESC NULLS LAST,
 CASE entity WHEN 'health_sherpa_member' THEN -coalesce(try_cast(src_seq AS int), -1e12) WHEN 'claims_data' THEN coalesce(source_rank, 1e12) WHEN 'broker_roster' THEN coalesce(epoch_us(create_timestamp), -1e18) ELSE coalesce(try_cast(src_seq AS int), 1e12) END,
 CASE entity WHEN 'health_sherpa_member' THEN coalesce(source_rank, 1e12) WHEN 'claims_data' THEN -coalesce(try_cast(src_seq AS int), -1e12) WHEN 'broker_roster' THEN coalesce(source_rank, 1e12) ELSE 0 END, curated_id)"""
_RANKED = f"""keyed AS (SELECT *, {_KEY} AS k FROM health_sherpa_member_curated WHERE {_KEY} IS NOT NULL),
 ranked AS (SELECT *, {_ENTITY_ORDER} AS rank FROM keyed WHERE k IN (SELECT k FROM keyed GROUP BY k HAVING count(*) >= 2)),
 cells AS ({_CELLS}), chosen AS (SELECT k, field_name, arg_min(curated_id, rank) AS curated_id, arg_min(value, rank) AS value FROM cells GROUP BY ALL)"""

_WORDS = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
_PLACED = "SELECT doc_id, i, array_to_string(w[i:i + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS i FROM (SELECT doc_id, {words} AS w FROM documents WHERE text IS NOT NULL))"
_GRAMS = "SELECT {id}, array_to_string(w[i:i + 11], ' ') AS g FROM (SELECT {id}, w, unnest(range(1, len(w) - 10)) AS i FROM (SELECT {id}, {words} AS w FROM {t} WHERE text IS NOT NULL))"

SQL = {
    "p3_found": f"WITH {_RANKED} SELECT k AS subscriber_id, field_name, curated_id FROM chosen",
    "p3_survivor": f"WITH {_RANKED} SELECT k AS subscriber_id, {', '.join(f"max(value) FILTER (field_name = '{f}') AS {f}" for f in SURVIVOR_FIELDS)} FROM chosen GROUP BY k",
    "p8_leaked_words": f"""SELECT doc_id, count(DISTINCT word) AS n_leaked_words FROM (SELECT doc_id, unnest(range(i, i + 12)) AS word FROM ({_PLACED.format(words=_WORDS)})
 WHERE g IN (SELECT g FROM ({_GRAMS.format(id='item_id', t='eval_item', words=_WORDS)}))) GROUP BY 1""",
    "p8_found": f"SELECT DISTINCT doc_id, item_id FROM ({_GRAMS.format(id='doc_id', t='documents', words=_WORDS)}) JOIN ({_GRAMS.format(id='item_id', t='eval_item', words=_WORDS)}) USING (g)",
}
