"""The row before each row, for groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import cut


def previous_row(df: DataFrame, group: list[str], order: list[str], carry: list[str], name: str, written: bool = False) -> DataFrame:
    """Adds ``name``, a struct of ``carry`` from the row before in the same group, or null.

    A window over the group would put a group with most of the rows in one task. Rows
    are range-partitioned by (group, order) instead, the window runs inside each range,
    and only the last row of each range is handed to the next one. The rows are written
    once before, so that sampling the ranges doesn't evaluate them a second time, unless
    they are ``written`` already. Nulls order first; ``order`` must be total within a group.
    """
    struct = F.struct(*carry)
    ranged = cut((df if written else cut(df)).repartitionByRange(*group, *order).withColumn("__range", F.spark_partition_id()))
    inside = Window.partitionBy(*group, "__range").orderBy(*order)
    lagged = ranged.withColumns({"__lag": F.lag(struct).over(inside), "__first": F.row_number().over(inside) == 1})
    key = F.struct(*order)
    ends = ranged.groupBy(*group, "__range").agg(F.max_by(struct, key).alias("__end"))
    ends = ends.withColumn("__end", F.lag("__end").over(Window.partitionBy(*group).orderBy("__range")))
    aliased = ends.select(*[F.col(g).alias(f"__g_{g}") for g in group], F.col("__range").alias("__r"), "__end")
    on = F.col("__range") == F.col("__r")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    joined = lagged.join(aliased, on, "left")
    return joined.withColumn(name, F.when(F.col("__first"), F.col("__end")).otherwise(F.col("__lag"))).drop(
        "__range", "__r", "__lag", "__first", "__end", *[f"__g_{g}" for g in group]
    )
