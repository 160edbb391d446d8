"""Identifiers, blanks, header names, operation codes, type names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """The column of exactly this name; dots and slashes are literal."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_blank(c: Column) -> Column:
    """Null, empty, or nothing but white space."""
    return c.isNull() | (F.trim(c.cast("string")) == "")


def canonical_id(c: Column) -> Column:
    """Upper case, only letters and digits; null for null and for what has neither."""
    kept = F.upper(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))
    return F.when(kept != "", kept)


CANONICAL_ID_SQL = r"nullif(upper(regexp_replace({c}, '[^\p{{L}}\p{{N}}]', '', 'g')), '')"


def change_kind(c: Column) -> Column:
    """0 upsert, 1 insert, 2 delete; null and unknown codes count as upserts."""
    op = F.upper(F.regexp_replace(c, r"\s+", ""))
    return F.when(op.isin("D", "DELETE"), F.lit(2)).when(op.isin("I", "INSERT"), F.lit(1)).otherwise(F.lit(0))


CHANGE_KIND_SQL = r"CASE WHEN upper(regexp_replace({c}, '\s+', '', 'g')) IN ('D','DELETE') THEN 2 WHEN upper(regexp_replace({c}, '\s+', '', 'g')) IN ('I','INSERT') THEN 1 ELSE 0 END"


def normalize_header(name: str) -> str:
    """Trimmed, lower case, runs of other characters as one underscore, none at the edges."""
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def normalized_header(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


#: Further names of Spark's types.
TYPE_SYNONYMS = {
    "integer": "int",
    "long": "bigint",
    "short": "smallint",
    "byte": "tinyint",
    "real": "float",
    "bool": "boolean",
    "text": "string",
    "numeric": "decimal",
    "dec": "decimal",
    "timestamp_ltz": "timestamp",
    "datetime": "timestamp",
}


def _type_name(base: Column, args: Column) -> Column:
    known = F.coalesce(*[F.when(base == a, F.lit(b)) for a, b in TYPE_SYNONYMS.items()], base)
    scaled = F.when(args == "", F.lit("(10,0)")).when(args.rlike(r"^\(\d+\)$"), F.regexp_replace(args, r"\)", ",0)")).otherwise(args)
    return F.when(base.isin("varchar", "char", "character", "nvarchar"), F.lit("string")).when(known == "decimal", F.concat(F.lit("decimal"), scaled)).otherwise(F.concat(known, args))


def spark_type_names(types: Column) -> Column:
    """An array of type names in one spelling each: synonyms merged, char and varchar of any length are string, decimal without arguments is decimal(10,0).

    In steps over the whole array, so that each pattern is matched once an element.
    """
    bare = F.transform(types, lambda c: F.lower(F.regexp_replace(c, r"\s+", "")))
    parts = F.transform(bare, lambda t: F.struct(F.regexp_extract(t, r"^([a-z_]+)", 1).alias("base"), F.regexp_extract(t, r"(\(.*\))$", 1).alias("args")))
    return F.transform(parts, lambda p: _type_name(p["base"], p["args"]))


def spark_type_name(c: Column) -> Column:
    """One spelling per Spark type, as ``spark_type_names`` has it."""
    return F.element_at(spark_type_names(F.array(c)), 1)


def checksum_key(c: Column) -> Column:
    """Checksum without blanks, case and algorithm prefix; null for null and blank."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(c, r"\s+", "")), r"^[a-z][a-z0-9_-]*[:=]", "")
    return F.when(bare != "", bare)
