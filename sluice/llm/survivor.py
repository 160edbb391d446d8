"""One surviving record per group of duplicates, chosen field by field.

Inside a group the records form a partial order: dated records by their freshness
column, then by the tie-breakers of their entity. For each field the first record in
that order that holds a value supplies it. Undated records come last under a
freshness specification; ``latest_values`` places them by currency reasoning instead:
from groups with timestamps it learns which value tends to follow which, builds the
group's precedence of values and takes what no other value follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.instants import micros_of
from sluice.functions.order import OrderTerm, parse_terms
from sluice.operators.ordered import previous_row
from sluice.session import cut

#: Texts that stand for "no value", in lower case. Values without any letter or digit stand for it too.
NO_VALUE = (
    "n/a", "na", "n.a.", "null", "none", "nil", "nan", "unknown", "tbd", "tba", "blank", "not provided", "not available",
    "not applicable", "not specified", "undefined", "missing", "empty",
)


def has_value(c: Column) -> Column:
    """False for null, blank, and placeholders in any case, with or without brackets."""
    bare = F.regexp_replace(F.lower(c.cast("string")), r"^[\s(<\[{]+|[\s)>\]}]+$", "")
    return F.coalesce(bare.rlike(r"[\p{L}\p{N}]") & ~bare.isin(*NO_VALUE), F.lit(False))


def _sortable(df: DataFrame, term: OrderTerm) -> list[Column]:
    """Three columns that sort ascending as the term demands: null rank, number, text as code points."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    if term.column not in fields:
        raise ValueError(f"order column {term.column!r} is missing")
    c, kind = F.col(term.column), fields[term.column]
    if term.pattern:
        c, kind = F.try_to_timestamp(c.cast("string"), F.lit(term.pattern)), T.TimestampType()
    elif term.kind:
        c, kind = c.try_cast(term.kind), T.DataType.fromDDL(term.kind)
    sign = 1 if term.ascending else -1
    number, text = F.lit(None).cast("decimal(38,9)"), F.array().cast("array<int>")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType | T.DateType):
        number = micros_of(c, kind).cast("decimal(38,9)") * sign
    elif isinstance(kind, T.NumericType):
        number = c.try_cast("decimal(38,9)") * sign
    elif isinstance(kind, T.BooleanType):
        number = c.cast("int").cast("decimal(38,9)") * sign
    elif isinstance(kind, T.StringType):
        points = F.transform(F.split(c, ""), lambda x: F.ascii(x) * sign)
        text = F.concat(F.coalesce(points, F.array()), F.array(F.lit(-sign * 0x200000 if term.ascending else 0x200000)))
    else:
        raise ValueError(f"{term.column} of type {kind.simpleString()} can't be ordered")
    null_rank = F.when(c.isNull(), F.lit(0 if term.nulls_first else 2)).otherwise(F.lit(1))
    return [null_rank, number.cast("decimal(38,9)"), text]


def freshness_rank(df: DataFrame, specs: DataFrame, entity: str, identity: str, cap: int = 10_000) -> Column:
    """A struct that sorts ascending from the first record to the last.

    ``specs`` has a freshness column and tie-breakers per entity (configuration, refused
    beyond ``cap`` rows). Records of an entity without specification order by
    ``identity`` alone. Fresh values are newest first and null last; the tie-breakers
    follow, then the smallest identity.
    """
    pattern = "compare_format" if "compare_format" in specs.columns else "CAST(NULL AS STRING) AS compare_format"
    got = specs.selectExpr("entity", "freshness_column", "tie_breakers", "compare_as", pattern).orderBy("entity").limit(cap + 1).collect()
    if len(got) > cap:
        raise ValueError(f"more than {cap} freshness specifications")
    per = {r.entity: [OrderTerm(r.freshness_column, kind=None if r.compare_format else r.compare_as, pattern=r.compare_format), *parse_terms(r.tie_breakers)] for r in got if r.entity and r.freshness_column}
    parts: list[Column] = []
    for i in range(max(map(len, per.values()), default=0)):
        for j, empty in enumerate(("int", "decimal(38,9)", "array<int>")):
            c = F.lit(None).cast(empty)
            for name, terms in per.items():
                if i < len(terms):
                    c = F.when(F.col(entity) == name, _sortable(df, terms[i])[j].cast(empty)).otherwise(c)
            parts.append(c.alias(f"r{i}_{j}"))
    return F.struct(*parts, F.col(identity).alias("identity"))


def survivors(df: DataFrame, key: Column, rank: Column, identity: str, fields: list[str], least: int = 2) -> DataFrame:
    """Per key with at least ``least`` records and field: the first record with a value, and that value.

    One aggregation with partial results, so a group of any size never meets in one
    task before it is reduced. Records without key are left out; a field no record
    holds gives no row; repeated records count as records.
    """
    # behind a generator, so that the rank is computed once a row rather than once a field
    keyed = df.withColumn("__key", key).filter(F.col("__key").isNotNull()).withColumn("__rank", F.explode(F.array(rank)))
    first = [F.min(F.when(has_value(F.col(f)), F.struct(F.col("__rank").alias("rank"), F.col(identity).alias("id"), F.col(f).cast("string").alias("value")))).alias(f"f_{i}") for i, f in enumerate(fields)]
    groups = keyed.groupBy("__key").agg(F.count(F.lit(1)).alias("n"), *first).filter(F.col("n") >= least)
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"f_{i}.id").alias("id"), F.col(f"f_{i}.value").alias("value")) for i, f in enumerate(fields)]))
    return groups.select(F.col("__key").alias("key"), each.alias("e")).filter(F.col("e.id").isNotNull()).select("key", "e.field_name", F.col("e.id").alias(identity), "e.value")


def _long(df: DataFrame, key: Column, time: str, identity: str, fields: list[str]) -> DataFrame:
    """Distinct (key, field, value) with the newest time it was seen at, null if never dated."""
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.trim(F.col(f).cast("string")).alias("value"), has_value(F.col(f)).alias("ok")) for f in fields]))
    rows = df.select(key.alias("key"), F.col(time).alias("t"), F.col(identity).alias("id"), cells.alias("c")).filter(F.col("key").isNotNull() & F.col("c.ok"))
    return rows.groupBy("key", F.col("c.field_name").alias("field_name"), F.col("c.value").alias("value")).agg(F.max("t").alias("t"), F.min("id").alias("id"))


def value_shape(c: Column) -> Column:
    """The class of a value: digits as 9, letters as a; lets precedence learnt on one value hold for others like it."""
    return F.regexp_replace(F.regexp_replace(c, r"\p{L}+", "a"), r"\d+", "9")


def learn_precedence(values: DataFrame) -> DataFrame:
    """How often, over all groups, one value or shape is next followed by another, as a net share.

    Dated values of a (key, field) are ordered by time; each neighbouring pair is a
    transition. Kept are directions seen more often than their reverse. ``values`` should be cut.
    """
    dated = values.filter(F.col("t").isNotNull())
    step = previous_row(dated, ["key", "field_name"], ["t", "id", "value"], ["value"], "last", written=True).filter(F.col("last").isNotNull()).withColumn("before", F.col("last.value"))
    levels = F.explode(F.array(F.struct(F.lit("value").alias("level"), F.col("before").alias("a"), F.col("value").alias("b")), F.struct(F.lit("shape").alias("level"), value_shape(F.col("before")).alias("a"), value_shape(F.col("value")).alias("b"))))
    n = step.select("field_name", levels.alias("l")).filter(F.col("l.a") != F.col("l.b"))
    low, high = F.least("l.a", "l.b"), F.greatest("l.a", "l.b")
    net = n.groupBy("field_name", "l.level", low.alias("low"), high.alias("high")).agg(F.sum(F.when(F.col("l.a") == low, 1).otherwise(-1)).alias("net"), F.count(F.lit(1)).alias("seen"))
    net = net.filter(F.col("net") != 0)
    return net.select("field_name", "level", F.when(F.col("net") > 0, F.col("low")).otherwise(F.col("high")).alias("older"), F.when(F.col("net") > 0, F.col("high")).otherwise(F.col("low")).alias("newer"), (F.abs("net") / F.col("seen")).alias("share"), "seen")


def group_edges(nodes: DataFrame, learnt: DataFrame) -> DataFrame:
    """(key, field_name, older, newer) between values of one group, as learnt of the values, else of their shapes."""
    group = ["key", "field_name"]
    shaped = nodes.select(*group, "value", value_shape(F.col("value")).alias("shape"))

    def within(level: str) -> DataFrame:
        own = shaped.select(*group, F.col(level).alias("older")).distinct()
        after = own.join(learnt.filter(F.col("level") == level).select("field_name", "older", "newer"), ["field_name", "older"])
        return after.join(own.withColumnRenamed("older", "newer"), [*group, "newer"]).select(*group, "older", "newer")

    exact = cut(within("value"))
    sides = [shaped.select(*group, F.col("shape").alias(f"{side}_shape"), F.col("value").alias(side)) for side in ("older", "newer")]
    shapes = within("shape").withColumnsRenamed({"older": "older_shape", "newer": "newer_shape"})
    by_shape = shapes.join(sides[0], [*group, "older_shape"]).join(sides[1], [*group, "newer_shape"]).select(*group, "older", "newer")
    settled = exact.select(*group, F.explode(F.array(F.struct("older", "newer"), F.struct(F.col("newer").alias("older"), F.col("older").alias("newer")))).alias("e")).select(*group, "e.*")
    return exact.unionByName(by_shape.join(settled, [*group, "older", "newer"], "left_anti"))


def closure(edges: DataFrame) -> DataFrame:
    """All (key, field_name, older, newer) joined by a path of edges; the length covered doubles with each round."""
    group, pair = ["key", "field_name"], ["key", "field_name", "older", "newer"]
    # distinct stands on an exchange of its own, never on the union itself
    reach = cut(edges.repartition(*[F.col(c) for c in pair]).distinct())
    n, before = reach.count(), 0
    while n > before:
        on = reach.select(*group, F.col("older").alias("via"), "newer")
        longer = reach.withColumnRenamed("newer", "via").join(on, [*group, "via"]).select(*pair)
        reach = cut(reach.unionByName(longer).repartition(*[F.col(c) for c in pair]).distinct())
        n, before = reach.count(), n
    return reach


def latest_values(df: DataFrame, key: Column, time: str, identity: str, fields: list[str]) -> DataFrame:
    """Per key and field the most current value by timestamps and, where those are missing, by learnt precedence.

    The newest dated value is the group's anchor. An undated value is more current than
    the anchor only if the learnt precedence (of the values, else of their shapes) puts
    it after, over other undated values if need be; without any dated value all undated
    values compete. Among the values that compete, the one that most others precede,
    directly or not, is taken (latest in the topological order), then the newest, then
    the smallest identity; values of a cycle precede each other. Pairs of a group are
    formed only where the precedence has one.
    """
    group = ["key", "field_name"]
    values = cut(_long(df, key, time, identity, fields))
    learnt = cut(learn_precedence(values))
    at = F.struct(F.col("t").isNotNull(), F.col("t"), -F.col("id"))
    anchors = cut(values.groupBy(*group).agg(F.max_by(F.struct("value", "t", "id"), at).alias("anchor"), F.count(F.lit(1)).alias("n_values"), F.count_if(F.col("t").isNull()).alias("undated")))
    dated = F.col("anchor.t").isNotNull()
    open_groups = anchors.filter(F.col("undated") + dated.cast("int") >= 2).select(*group, F.col("anchor.value").alias("first"), dated.alias("dated"))
    nodes = cut(values.join(open_groups, group).filter(F.col("t").isNull() | (F.col("value") == F.col("first"))))
    reach = closure(group_edges(nodes, learnt))
    after = reach.select(*group, F.col("older").alias("first"), F.col("newer").alias("value"), F.lit(True).alias("after"))
    competing = cut(nodes.join(after, [*group, "first", "value"], "left").filter(~F.col("dated") | (F.col("value") == F.col("first")) | F.col("after")))
    names = competing.select(*group, "value")
    inside = reach.filter(F.col("older") != F.col("newer")).join(names.withColumnRenamed("value", "older"), [*group, "older"], "left_semi")
    before = inside.groupBy(*group, F.col("newer").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked = competing.join(before, [*group, "value"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    order = F.struct("n", F.col("t").isNotNull().alias("has_t"), (-F.col("id")).alias("order"), "value")
    best = ranked.groupBy(*group).agg(F.max_by(F.struct("value", "n", "t"), order).alias("next"))
    out = anchors.join(best.filter((F.col("next.n") > 0) & F.col("next.t").isNull()), group, "left")
    value = F.coalesce(F.col("next.value"), F.col("anchor.value"))
    return out.select(*group, value.alias("value"), F.when(F.col("next").isNotNull(), "precedence").when(dated, "timestamp").otherwise("identity").alias("decided_by"), "n_values")
