"""Queries of the general table problems: change feeds, parse failures, increments, drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.instants import INSTANT_TEXT_SQL, instant_text_micros
from sluice.functions.text import CANONICAL_ID_SQL, CHANGE_KIND_SQL, canonical_id, is_blank, quoted
from sluice.operators import changefeed, drift, manifest, parsefail
from sluice.session import shared_folder, table

MEMBER_FEED = changefeed.ChangeFeed("subscriber_id", "last_modified_ts", "source_sequence_number", "last_modified_op", "rec_id", ("hios_id", "middle_name", "amount"))


def p1_state(spark: SparkSession, root: str) -> DataFrame:
    """Current row of every live subscriber after replaying the whole feed."""
    return changefeed.live(changefeed.apply_changes(table(spark, root, "health_sherpa_member"), MEMBER_FEED), MEMBER_FEED)


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return p1_state(spark, root).select("subscriber_id", "source_sequence_number")


def p1_batches(spark: SparkSession, root: str) -> DataFrame:
    """The same state when the feed comes in two batches, the second applied to what the first has left."""
    feed = table(spark, root, "health_sherpa_member")
    later = F.pmod(F.col("rec_id"), F.lit(2)) == 0
    state = changefeed.apply_changes(feed.filter(~later), MEMBER_FEED)
    return changefeed.live(changefeed.apply_changes(feed.filter(later), MEMBER_FEED, state), MEMBER_FEED)


def _classified_lines(spark: SparkSession, root: str) -> DataFrame:
    lines = table(spark, root, "raw_member_line")
    parsed = parsefail.parse_lines(lines, "raw_line", "field_delimiter", parsefail.MEMBER_READ_AS)
    return parsefail.classify(parsed, parsefail.ordered_rules(table(spark, root, "reject_rule")))


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return _classified_lines(spark, root).filter(F.col("error_code").isNotNull()).select("line_id", "error_code")


def p2_valid(spark: SparkSession, root: str) -> DataFrame:
    """The valid records with typed columns."""
    return parsefail.typed_fields(_classified_lines(spark, root), ["line_id"])


def p2_by_file(spark: SparkSession, root: str) -> DataFrame:
    """Per file and reason the failed records, as a file audit would state them."""
    bad = _classified_lines(spark, root).filter(F.col("error_code").isNotNull())
    return bad.groupBy("source_file", "error_code").agg(F.count(F.lit(1)).alias("n_records"), F.min("row_idx").alias("first_row_idx"))


FEED_ENTITY = "health_sherpa_member"
INCREMENT = T.StructType([T.StructField("source_sequence_number", T.LongType()), T.StructField("subscriber_id", T.StringType())])


def complete_windows(runs: DataFrame, entity: str = FEED_ENTITY) -> DataFrame:
    """Windows of runs with a SUCCESS of stage curated that was no dry run; rows without a window end carry none."""
    own = runs.filter(F.trim("entity") == entity)
    done = (F.lower(F.trim("stage")) == "curated") & (F.upper(F.trim("status")) == "SUCCESS") & ~F.coalesce(F.lower(F.trim("message")) == "dry-run", F.lit(False))
    complete = own.filter(F.coalesce(done, F.lit(False))).select("run_id").distinct()
    stated = own.filter(~is_blank(F.col("window_end"))).select("run_id", instant_text_micros(F.col("window_start")).alias("w_start"), instant_text_micros(F.col("window_end")).alias("w_end")).distinct()
    return stated.join(complete, "run_id", "left_semi").filter(F.col("w_end").isNotNull()).select("w_start", "w_end").distinct()


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    """The increment a run over all landed windows commits, as saved in its output."""
    rows = table(spark, root, "health_sherpa_member").filter(F.col("source_sequence_number").isNotNull()).select(
        canonical_id(F.col("subscriber_id")).alias("subscriber_id"),
        "source_sequence_number",
        instant_text_micros(F.col("extract_start_ts")).alias("w_start"),
        instant_text_micros(F.col("extract_end_ts")).alias("w_end"),
    )
    out = manifest.VersionedTable(spark, shared_folder(spark, "increments"))
    newest = [F.max("subscriber_id").alias("subscriber_id")]
    manifest.process_units(rows, complete_windows(table(spark, root, "ingest_run_audit")), ["w_start", "w_end"], ["source_sequence_number"], newest, out, FEED_ENTITY)
    return out.read(INCREMENT).filter(F.col("subscriber_id").isNotNull()).select("subscriber_id", "source_sequence_number")


def p5_units(spark: SparkSession, root: str) -> DataFrame:
    """The manifest diff behind p5_found: every window, added, kept or removed."""
    rows = table(spark, root, "health_sherpa_member").select(instant_text_micros(F.col("extract_start_ts")).alias("w_start"), instant_text_micros(F.col("extract_end_ts")).alias("w_end"))
    return manifest.diff(manifest.manifest(rows, ["w_start", "w_end"]), complete_windows(table(spark, root, "ingest_run_audit")), ["w_start", "w_end"])


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return drift.header_changes(table(spark, root, "ingest_header_audit"), table(spark, root, "contract_column"))


def _header_columns(spark: SparkSession, root: str) -> DataFrame:
    return drift.header_columns(table(spark, root, "ingest_header_audit"), table(spark, root, "contract_column"))


def p6_table(spark: SparkSession, root: str) -> DataFrame:
    """Rows of every file in one consistent table with typed branches where types conflict."""
    return drift.consistent_table(table(spark, root, "member_file_row"), _header_columns(spark, root))


def p6_table_filled(spark: SparkSession, root: str) -> DataFrame:
    """Each column and branch of the consistent table with its number of values."""
    t = p6_table(spark, root).drop("file_row_id", "header_id", "entity", "row_idx")
    counts = t.agg(*[F.count(quoted(c)).alias(c) for c in t.columns])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), quoted(c).alias("n_values")) for c in t.columns])).alias("c")).select("c.*")


def p6_schema(spark: SparkSession, root: str) -> DataFrame:
    """The fused schema, one row per alternative type of a column."""
    fused = drift.fused_schema(_header_columns(spark, root))
    each = fused.select("entity", F.col("col").alias("column_name"), "canonical_type", F.explode("alternatives").alias("a"))
    return each.select("entity", "column_name", "canonical_type", "a.type", "a.since_header_id", "a.files")


def p6_cells(spark: SparkSession, root: str) -> DataFrame:
    """Every delivered cell with its column and the type its file declared."""
    return drift.tagged_cells(table(spark, root, "member_file_row"), _header_columns(spark, root))


def header_resolve(spark: SparkSession, root: str) -> DataFrame:
    """Every header with the column it means, by name or alias of the entity's contract."""
    each = _header_columns(spark, root).select("header_id", F.explode("cols").alias("c"))
    return each.select("header_id", F.col("c.col").alias("column_name"), F.col("c.name").alias("normalized"), F.col("c.type").alias("type"))


QUERIES = {f.__name__: f for f in (header_resolve, p1_found, p1_state, p1_batches, p2_found, p2_valid, p2_by_file, p5_found, p5_units, p6_found, p6_table, p6_table_filled, p6_cells, p6_schema)}

_KEY = CANONICAL_ID_SQL.format(c="subscriber_id")
_KIND = CHANGE_KIND_SQL.format(c="last_modified_op")
_FEED = f"""feed AS (SELECT {_KEY} AS k, coalesce(last_modified_ts, TIMESTAMP '0001-01-01') AS t, source_sequence_number AS s, {_KIND} AS kind, -rec_id AS landing,
 hios_id, middle_name, amount FROM health_sherpa_member WHERE {_KEY} IS NOT NULL AND source_sequence_number IS NOT NULL),
 last_change AS (SELECT k, arg_max(s, (t, s, kind)) AS s, arg_max(kind, (t, s, kind)) AS kind, max((t, s)) FILTER (kind > 0) AS reset FROM feed GROUP BY k)"""
_COLUMN = "arg_max({c}, (t, f.s, landing)) FILTER (f.kind <> 2 AND {c} IS NOT NULL AND (l.reset IS NULL OR (t, f.s) >= l.reset)) AS {c}"

_SEP = "chr(64976)"
_LINE = f"replace(replace(coalesce(raw_line, ''), {_SEP}, chr(65533)), coalesce(field_delimiter, ','), {_SEP})"
_Q = r"""[ \t]*"([^"]|"")*"[ \t]*"""
_PARSE = rf"""marked AS (SELECT *, {_LINE} AS line FROM raw_member_line),
 shaped AS (SELECT *, regexp_full_match(line, '(?s)({_Q}|[^"' || {_SEP} || ']*)(' || {_SEP} || '({_Q}|[^"' || {_SEP} || ']*))*') AS ok,
   regexp_extract_all({_SEP} || line, '(?s)(' || {_SEP} || ')((?:{_Q.replace("(", "(?:")})|[^"' || {_SEP} || ']*)', 2) AS pieces FROM marked),
 bare AS (SELECT *, list_transform(CASE WHEN ok THEN pieces END, lambda p: replace(trim(CASE WHEN starts_with(trim(p, ' ' || chr(9)), '"') THEN replace(regexp_replace(trim(p, ' ' || chr(9)), '^"|"$', '', 'g'), '""', '"') ELSE p END, ' ' || chr(9)), {_SEP}, coalesce(field_delimiter, ','))) AS v FROM shaped),
 broken AS (SELECT *, CASE
   WHEN NOT ok THEN 'quoting' WHEN len(v) <> 8 THEN 'column_count'
   WHEN NOT regexp_full_match(v[1], 'S[0-9]{{10}}') THEN 'subscriber_id'
   WHEN NOT regexp_full_match(v[2], '[0-9]{{5}}[A-Z][0-9]{{4}}') THEN 'hios_id'
   WHEN v[5] <> '' AND NOT (regexp_full_match(v[5], '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND try_cast(v[5] AS date) IS NOT NULL) THEN 'birth_date'
   WHEN v[6] <> '' AND NOT regexp_full_match(v[6], '-?[0-9]+(\.[0-9]{{1,2}})?') THEN 'amount'
   WHEN NOT (regexp_full_match(v[7], '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}') AND try_cast(v[7] AS timestamp) IS NOT NULL AND substr(v[7], 12, 2) <> '24') THEN 'modified_ts' END AS rule FROM bare)"""

_WIN = lambda c: INSTANT_TEXT_SQL.format(c=c)
_WINDOWS = f"""complete AS (SELECT run_id FROM ingest_run_audit WHERE entity = 'health_sherpa_member' AND stage = 'curated' AND status = 'SUCCESS' AND coalesce(message, '') <> 'dry-run'),
 windows AS (SELECT DISTINCT {_WIN("window_start")} AS w_start, {_WIN("window_end")} AS w_end FROM ingest_run_audit
   WHERE entity = 'health_sherpa_member' AND run_id IN (SELECT run_id FROM complete) AND trim(coalesce(window_end, '')) <> ''),
 landed AS (SELECT {_KEY} AS subscriber_id, source_sequence_number, {_WIN("extract_start_ts")} AS w_start, {_WIN("extract_end_ts")} AS w_end FROM health_sherpa_member)"""

_NORM = r"trim(regexp_replace(lower({c}), '[^a-z0-9]+', '_', 'g'), '_')"
_TYPE = r"""CASE WHEN regexp_matches({t}, '^varchar') THEN 'string' WHEN {t} = 'integer' THEN 'int' WHEN {t} = 'long' THEN 'bigint' WHEN starts_with({t}, 'numeric') THEN replace({t}, 'numeric', 'decimal') ELSE {t} END""".replace(
    "{t}", r"lower(regexp_replace(t, '\s+', '', 'g'))"
)
_HEADERS = f"""known AS (SELECT entity, n, min(column_name) AS column_name FROM (SELECT entity, column_name, {_NORM.format(c="unnest(list_append(string_split(aliases, '|'), column_name))")} AS n FROM contract_column) GROUP BY ALL),
 h AS (SELECT header_id, entity, event_ts, lag(header_id) OVER (PARTITION BY entity ORDER BY event_ts, header_id) AS before FROM ingest_header_audit WHERE trim(actual_source_headers) <> ''),
 parts AS (SELECT header_id, entity, event_ts, unnest(string_split(actual_source_headers, ',')) AS n, unnest(string_split(actual_source_types, '|')) AS t, unnest(range(len(string_split(actual_source_headers, ',')))) AS pos FROM ingest_header_audit WHERE trim(actual_source_headers) <> ''),
 named AS (SELECT header_id, entity, event_ts, {_NORM.format(c="n")} AS n, {_TYPE} AS t, pos FROM parts),
 c AS (SELECT header_id, named.entity, event_ts, coalesce(column_name, named.n) AS col, arg_min(named.n, pos) AS n, arg_min(t, pos) AS t FROM named LEFT JOIN known ON known.entity = named.entity AND known.n = named.n GROUP BY 1, 2, 3, 4)"""

SQL = {
    "header_resolve": f"WITH {_HEADERS} SELECT header_id, col AS column_name, n AS normalized, t AS type FROM c WHERE n <> ''",
    "p1_found": f"WITH {_FEED} SELECT k AS subscriber_id, s AS source_sequence_number FROM last_change WHERE kind <> 2",
    "p1_state": f"WITH {_FEED} SELECT l.k AS subscriber_id, any_value(l.s) AS source_sequence_number, {', '.join(_COLUMN.format(c=c) for c in MEMBER_FEED.columns)} FROM last_change l JOIN feed f ON f.k = l.k WHERE l.kind <> 2 GROUP BY l.k",
    "p2_found": f"WITH {_PARSE} SELECT line_id, error_code FROM broken JOIN reject_rule ON rule = rule_name",
    "p2_valid": f"""WITH {_PARSE} SELECT line_id, v[1] AS subscriber_id, v[2] AS hios_id, nullif(v[3], '') AS first_name, nullif(v[4], '') AS last_name, try_cast(nullif(v[5], '') AS date) AS birth_date,
 try_cast(nullif(v[6], '') AS decimal(18,2)) AS amount, try_cast(v[7] AS timestamp) AS modified_ts, nullif(v[8], '') AS note FROM broken WHERE rule IS NULL""",
    "p2_by_file": f"WITH {_PARSE} SELECT source_file, error_code, count(*) AS n_records, min(row_idx) AS first_row_idx FROM broken JOIN reject_rule ON rule = rule_name GROUP BY ALL",
    "p5_found": f"""WITH {_WINDOWS} SELECT max(subscriber_id) AS subscriber_id, source_sequence_number FROM landed l
 LEFT JOIN windows w ON l.w_start IS NOT DISTINCT FROM w.w_start AND l.w_end IS NOT DISTINCT FROM w.w_end GROUP BY source_sequence_number HAVING count(w.w_end) = 0 AND max(subscriber_id) IS NOT NULL""",
    "p5_units": f"""WITH {_WINDOWS}, u AS (SELECT w_start, w_end, 1 AS c, 0 AS p FROM landed UNION ALL SELECT w_start, w_end, 0, 1 FROM windows)
 SELECT w_start, w_end, CASE WHEN max(p) = 0 THEN 'added' WHEN max(c) = 0 THEN 'removed' ELSE 'kept' END AS change FROM u GROUP BY ALL""",
    "p6_found": f"""WITH {_HEADERS}, now AS (SELECT h.header_id, c.col, c.n, c.t, h.before FROM h JOIN c USING (header_id) WHERE before IS NOT NULL)
 SELECT now.header_id, now.col AS column_name, 'added' AS change_kind FROM now LEFT JOIN c ON c.header_id = now.before AND c.col = now.col WHERE c.col IS NULL
 UNION ALL SELECT h.header_id, c.col, 'removed' FROM h JOIN c ON c.header_id = h.before LEFT JOIN c d ON d.header_id = h.header_id AND d.col = c.col WHERE d.col IS NULL
 UNION ALL SELECT now.header_id, now.col, 'renamed' FROM now JOIN c ON c.header_id = now.before AND c.col = now.col WHERE c.n <> now.n
 UNION ALL SELECT now.header_id, now.col, 'retyped' FROM now JOIN c ON c.header_id = now.before AND c.col = now.col WHERE c.t <> now.t""",
    "p6_schema": f"""WITH {_HEADERS}, each AS (SELECT entity, col, coalesce(t, 'string') AS type, arg_min(header_id, row(event_ts, header_id)) AS since_header_id, count(*) AS files FROM c GROUP BY 1, 2, 3),
 canon AS (SELECT entity, col, CASE WHEN count(*) = 1 THEN min(type) WHEN bool_and(type IN ('tinyint','smallint','int')) THEN 'int' WHEN bool_and(type IN ('tinyint','smallint','int','bigint')) THEN 'bigint'
   WHEN bool_and(type IN ('tinyint','smallint','int','bigint') OR starts_with(type, 'decimal')) THEN 'decimal(38,10)' WHEN bool_and(type IN ('tinyint','smallint','int','bigint','float','double') OR starts_with(type, 'decimal')) THEN 'double'
   WHEN bool_and(type IN ('date','timestamp','timestamp_ntz')) THEN 'timestamp' ELSE 'string' END AS canonical_type FROM each GROUP BY 1, 2)
 SELECT entity, col AS column_name, canonical_type, type, since_header_id, files FROM each JOIN canon USING (entity, col)""",
    "p6_cells": f"""WITH {_HEADERS}, placed AS (SELECT header_id, named.entity, coalesce(column_name, named.n) AS col, min(pos) AS pos, arg_min(t, pos) AS t FROM named LEFT JOIN known ON known.entity = named.entity AND known.n = named.n WHERE named.n <> '' GROUP BY 1, 2, 3)
 SELECT file_row_id, header_id, entity, row_idx, col AS column_name, coalesce(t, 'string') AS tag, trim(cell_values[pos + 1]) AS value FROM member_file_row JOIN placed USING (header_id) WHERE trim(cell_values[pos + 1]) <> ''""",
}
SQL["p1_batches"] = SQL["p1_state"]
_PLACED = "placed AS (SELECT header_id, coalesce(column_name, named.n) AS col, min(pos) AS pos, coalesce(arg_min(t, pos), 'string') AS t FROM named LEFT JOIN known ON known.entity = named.entity AND known.n = named.n WHERE named.n <> '' GROUP BY 1, 2)"
_CONVERTS = r"""CASE WHEN {k} = 'string' THEN true WHEN {k} IN ('tinyint', 'smallint', 'int', 'bigint') THEN regexp_full_match(v, '[+-]?[0-9]+') AND try_cast(v AS bigint) IS NOT NULL WHEN {k} IN ('float', 'double') THEN try_cast(v AS double) IS NOT NULL
 WHEN starts_with({k}, 'decimal') THEN try_cast(v AS decimal(38, 10)) IS NOT NULL WHEN {k} = 'date' THEN try_cast(v AS date) IS NOT NULL WHEN {k} IN ('timestamp', 'timestamp_ntz') THEN try_cast(v AS timestamp) IS NOT NULL END"""
SQL["p6_table_filled"] = f"""WITH {_HEADERS}, {_PLACED}, alternatives AS (SELECT DISTINCT col, t FROM placed),
 canon AS (SELECT col, count(*) AS k, CASE WHEN count(*) = 1 THEN min(t) WHEN bool_and(t IN ('tinyint','smallint','int')) THEN 'int' WHEN bool_and(t IN ('tinyint','smallint','int','bigint')) THEN 'bigint'
   WHEN bool_and(t IN ('tinyint','smallint','int','bigint') OR starts_with(t, 'decimal')) THEN 'decimal(38,10)' WHEN bool_and(t IN ('tinyint','smallint','int','bigint','float','double') OR starts_with(t, 'decimal')) THEN 'double'
   WHEN bool_and(t IN ('date','timestamp','timestamp_ntz')) THEN 'timestamp' ELSE 'string' END AS canonical FROM alternatives GROUP BY 1),
 cells AS (SELECT col, t, trim(cell_values[pos + 1]) AS v FROM member_file_row JOIN placed USING (header_id) WHERE trim(cell_values[pos + 1]) <> '')
 SELECT canon.col AS column_name, count(v) FILTER ({_CONVERTS.format(k="canonical")}) AS n_values FROM canon LEFT JOIN cells USING (col) GROUP BY 1
 UNION ALL SELECT a.col || '__' || replace(replace(replace(a.t, '(', '_'), ',', '_'), ')', ''), count(v) FILTER ({_CONVERTS.format(k="a.t")}) FROM alternatives a JOIN canon ON canon.col = a.col AND canon.k > 1 LEFT JOIN cells ON cells.col = a.col AND cells.t = a.t GROUP BY 1, a.col, a.t"""
