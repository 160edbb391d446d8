"""Headers that drift: one table from all files, and a report of each change.

Every file's header is a schema: columns with a type each. The schemas of an entity
are fused into a tagged union that keeps the alternative types of every column. A
column with one type stays plain; one with several gets a branch per type plus a
canonical value, converted to the narrowest type that holds all alternatives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import normalized_header, spark_type_names
from sluice.operators.ordered import previous_row
from sluice.session import cut, lookup_join

#: Most columns one fused table may have.
MAX_COLUMNS = 5_000


def header_columns(headers: DataFrame, contract: DataFrame) -> DataFrame:
    """Adds ``cols``: for each header of a row its column, normalized name and type.

    Rows whose headers are null or blank are left out. A column is the contract's name
    if the normalized header is that name or an alias of the entity, else the
    normalized header itself; of two headers for one column the first counts, and a
    header without letters or digits is no column. Missing types are null.
    """
    names = F.transform(F.split("actual_source_headers", ","), normalized_header)
    types = spark_type_names(F.split("actual_source_types", r"\|"))
    c = contract.filter(F.col("column_name").isNotNull())
    known = c.select("entity", F.explode(F.concat(F.array(F.lower("column_name")), F.coalesce(F.split("aliases", r"\|"), F.array()))).alias("n"), "column_name")
    known = known.select("entity", normalized_header(F.col("n")).alias("n"), "column_name").filter("n <> ''").groupBy("entity", "n").agg(F.min("column_name").alias("column_name"))
    known = known.groupBy("entity").agg(F.map_from_entries(F.collect_list(F.struct("n", "column_name"))).alias("__known"))
    rows = headers.filter(F.trim("actual_source_headers") != "").drop("cols")
    rows = lookup_join(rows, known, ["entity"], "left")

    def entry(n: Column, i: Column) -> Column:
        found = F.element_at(F.col("__known"), n)
        return F.struct(F.coalesce(found, n).alias("col"), n.alias("name"), F.get(F.col("__types"), i).alias("type"), i.alias("pos"))

    # behind generators, so that what is used for each element isn't computed for each element
    for name, c in (("__names", names), ("__types", types), ("cols", F.filter(F.transform("__names", entry), lambda e: e["col"] != "")), ("__ids", F.transform("cols", lambda e: e["col"]))):
        rows = rows.withColumn(name, F.explode(F.array(c)))
    first = F.filter("cols", lambda e, i: F.array_position("__ids", e["col"]) == i + 1)
    return rows.withColumn("cols", first).drop("__names", "__types", "__known", "__ids")


def branches(columns: DataFrame) -> DataFrame:
    """The tagged union, one row per header and path: the path's name and type there. ``columns`` is what ``header_columns`` gives."""
    return columns.select("entity", "header_id", "event_ts", F.explode("cols").alias("c")).select("entity", "header_id", "event_ts", "c.col", "c.name", "c.type")


def fused_pairs(union: DataFrame, pairs: DataFrame) -> DataFrame:
    """Fuses two headers' schemas each: one row per path of either, with the alternative of the new and of the old one.

    ``pairs`` has header_id and ``was``, the header before it. Every header takes part in its
    own pair and in the next one's, so the shuffle is by pair and path and no entity, however
    large, meets in one task.
    """
    sides = F.explode(F.array(F.struct(F.col("header_id").alias("member"), F.lit(True).alias("new")), F.struct(F.col("was").alias("member"), F.lit(False).alias("new"))))
    members = pairs.select("header_id", sides.alias("s")).select("header_id", "s.member", "s.new")
    each = union.select(F.col("header_id").alias("member"), "col", F.struct("name", "type").alias("tag")).join(members, "member")
    return each.groupBy("header_id", "col").agg(F.max(F.when(F.col("new"), F.col("tag"))).alias("now"), F.max(F.when(~F.col("new"), F.col("tag"))).alias("was"))


def header_changes(headers: DataFrame, contract: DataFrame) -> DataFrame:
    """Changes of each header row against the row with headers before it in its entity.

    Both schemas are fused; a path with an alternative on one side only was added or
    removed, one whose alternatives differ in name or type was renamed or retyped. Order is
    event_ts (null first), then header_id. The first row of an entity has no changes. Types
    that are missing on either side are no change of type. Repeated rows count once.
    """
    union = cut(branches(header_columns(headers, contract)))
    order = headers.filter(F.trim("actual_source_headers") != "").select("entity", "event_ts", "header_id").distinct()
    before = previous_row(order, ["entity"], ["event_ts", "header_id"], ["header_id"], "before").filter(F.col("before").isNotNull())
    fused = fused_pairs(union, before.select("header_id", F.col("before.header_id").alias("was")))
    kinds = F.array(
        F.when(F.col("was").isNull(), "added"),
        F.when(F.col("now").isNull(), "removed"),
        F.when(F.col("now.name") != F.col("was.name"), "renamed"),
        F.when(F.col("now.type") != F.col("was.type"), "retyped"),
    )
    return fused.select("header_id", F.col("col").alias("column_name"), F.explode(F.array_compact(kinds)).alias("change_kind"))


#: Types from narrow to wide within each family.
_NUMERIC = ("tinyint", "smallint", "int", "bigint")


def canonical_type(types: Column) -> Column:
    """The narrowest type holding every alternative: integers widen, decimals and integers give decimal(38,10), any with floating point give double, dates and timestamps give timestamp, all else string."""
    within = lambda *names: F.forall(types, lambda t: t.isin(*names))
    decimalish = F.forall(types, lambda t: t.isin(*_NUMERIC) | t.startswith("decimal"))
    floating = F.forall(types, lambda t: t.isin(*_NUMERIC, "float", "double") | t.startswith("decimal"))
    return (
        F.when(F.size(types) == 0, F.lit("string"))
        .when(F.size(types) == 1, F.element_at(types, 1))
        .when(within("tinyint", "smallint", "int"), F.lit("int"))
        .when(within(*_NUMERIC), F.lit("bigint"))
        .when(decimalish, F.lit("decimal(38,10)"))
        .when(floating, F.lit("double"))
        .when(within("date", "timestamp", "timestamp_ntz"), F.lit("timestamp"))
        .otherwise(F.lit("string"))
    )


def fused_schema(columns: DataFrame) -> DataFrame:
    """Per entity and column: its alternatives with the header each first appeared in, and the canonical type."""
    each = branches(columns).withColumn("type", F.coalesce("type", F.lit("string")))
    first = each.groupBy("entity", "col", "type").agg(F.min(F.struct("event_ts", "header_id")).alias("since"), F.count(F.lit(1)).alias("files"))
    fused = first.groupBy("entity", "col").agg(F.array_sort(F.collect_list(F.struct("type", F.col("since.header_id").alias("since_header_id"), "files"))).alias("alternatives"))
    return fused.withColumn("canonical_type", canonical_type(F.transform("alternatives", lambda a: a["type"])))


def tagged_cells(rows: DataFrame, columns: DataFrame) -> DataFrame:
    """One row per cell: its column, the type its file declared (the tag) and the trimmed text.

    Cells beyond the header, rows without a header and empty cells give no row.
    """
    h = columns.select("header_id", "entity", "cols")
    joined = lookup_join(rows, h, ["header_id"], "inner")
    each = joined.select("file_row_id", "header_id", "entity", "row_idx", "cell_values", F.explode("cols").alias("c"))
    value = F.trim(F.get(F.col("cell_values"), F.col("c.pos")))
    return each.select("file_row_id", "header_id", "entity", "row_idx", F.col("c.col").alias("column_name"), F.coalesce("c.type", F.lit("string")).alias("tag"), F.when(value != "", value).alias("value")).filter(F.col("value").isNotNull())


def consistent_table(rows: DataFrame, columns: DataFrame) -> DataFrame:
    """All rows of all files in one table, whatever their header looked like.

    For each column of any entity: its value in the canonical type over all entities
    (null where the text doesn't convert), and, where types conflict, one branch
    ``<column>__<type>`` per alternative holding what files of that type delivered. The list
    of columns is read by the driver; it is as long as the table is wide and refused
    beyond ``MAX_COLUMNS``. Null and empty cells are null; a row without known header
    keeps its ids.
    """
    overall = fused_schema(columns.withColumn("entity", F.lit("*"))).select("col", F.transform("alternatives", lambda a: a["type"]).alias("types"), "canonical_type")
    width = overall.orderBy("col").limit(MAX_COLUMNS + 1).collect()
    if len(width) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} columns")
    # once per header: where each column of the table stands in it, and with which type
    place = F.map_from_entries(F.transform("cols", lambda e: F.struct(e["col"], F.struct(e["pos"].alias("pos"), F.coalesce(e["type"], F.lit("string")).alias("type")))))
    at = F.transform(F.array(*[F.lit(w.col) for w in width]), lambda name: F.element_at(F.col("__map"), name)) if width else F.array().cast("array<struct<pos:int,type:string>>")
    h = columns.select("header_id", "entity", place.alias("__map")).select("header_id", "entity", at.alias("__at"))
    joined = lookup_join(rows.select("file_row_id", "header_id", "row_idx", "cell_values"), h, ["header_id"], "left")
    read = lambda p: F.trim(F.get(F.col("cell_values"), p["pos"]))
    cells = F.transform("__at", lambda p: F.struct(F.when(read(p) != "", read(p)).alias("text"), p["type"].alias("type")))
    out = []
    for i, w in enumerate(width):
        value = F.col("__cells")[i]
        out.append(_convert(value["text"], w.canonical_type).alias(w.col))
        if len(w.types) > 1:
            out += [_convert(F.when(value["type"] == t, value["text"]), t).alias(f"{w.col}__{_tag(t)}") for t in w.types]
    return joined.withColumn("__cells", F.explode(F.array(cells))).select("file_row_id", "header_id", "entity", "row_idx", *out)


def _tag(kind: str) -> str:
    return kind.replace("(", "_").replace(",", "_").replace(")", "")


def _convert(text: Column, kind: str) -> Column:
    return text if kind == "string" else text.try_cast("timestamp_ntz" if kind == "timestamp" else kind)
