"""Session settings, lineage cuts and size-checked joins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Distinct keys up to which a join side may be broadcast.
BROADCAST_KEY_CAP = 1_000_000
#: Bytes up to which a join side may be broadcast.
BROADCAST_BYTE_CAP = 64 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every plan of this package relies on.

    ``spark.sql.unionOutputPartitioning`` must stay off while actions run: with it
    on, a keyed operator above nested unions skips a needed exchange.
    """
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    return spark


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{root}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the cluster's shared folder; a private folder only where none is named and Spark runs locally."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isEmpty():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="sluice-checkpoint-")
    sc.setCheckpointDir(shared)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which every executor can read and write."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Writes ``df`` once to the shared checkpoint folder; later uses read those files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored_copy(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once as a table in a shared folder; later uses read only the columns they need."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, path: str) -> None:
    """Deletes a folder made by ``stored_copy`` that no plan reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _width(df: DataFrame) -> Column:
    """Bytes of a row: 8 for values of fixed width, 8 and their length for texts, the length of their JSON for nested ones."""
    nested = T.ArrayType | T.MapType | T.StructType
    out, deep = F.lit(8 * len(df.columns)), []
    for f in df.schema.fields:
        name = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            out = out + F.coalesce(F.octet_length(name), F.lit(0))
        elif isinstance(f.dataType, nested):
            deep.append(F.col(name))
    return out + F.octet_length(F.to_json(F.struct(*deep))) if deep else out


def small_enough(df: DataFrame, row_bytes: int | None = None) -> bool:
    """Whether ``df`` is within the broadcast caps; reads at most one row more than the key cap.

    Rows are measured, or counted at ``row_bytes`` each if that is given.
    """
    if row_bytes is not None:
        cap = min(BROADCAST_KEY_CAP, BROADCAST_BYTE_CAP // max(1, row_bytes))
        return df.limit(cap + 1).count() <= cap
    n = df.select(_width(df).cast("bigint").alias("w")).limit(BROADCAST_KEY_CAP + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("w"), F.lit(0)).alias("bytes")).first()
    return n.n <= BROADCAST_KEY_CAP and n.bytes <= BROADCAST_BYTE_CAP


def stored_bytes(df: DataFrame) -> int:
    """Size of the stored table ``df`` selects from, by the catalog or its files; 0 for anything that has to be computed first."""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.children().size() == 1 and node.nodeName() in ("Project", "Filter", "SubqueryAlias", "View"):
        node = node.children().apply(0)
    stored = node.children().size() == 0 and node.nodeName() not in ("LogicalRDD", "LocalRelation", "Range", "OneRowRelation", "LogicalQueryStage")
    return int(str(node.stats().sizeInBytes())) if stored else 0


def lookup_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "left", row_bytes: int | None = None, salts: int = 16) -> DataFrame:
    """Joins a lookup table on null-safe keys without ever gathering a hot key in one task.

    The lookup side is broadcast if a count proves it small. Otherwise it is copied
    once per salt and the other side's rows are spread over the salts, so that a key
    with a third of all rows is read by ``salts`` tasks. ``small`` must have no other
    column in common with ``big`` than the keys.
    """
    aliased = small.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    drop = [f"__k_{k}" for k in keys]
    if small_enough(small, row_bytes):
        on = same[0]
        for s in same[1:]:
            on = on & s
        return big.join(F.broadcast(aliased), on, how).drop(*drop)
    spread = [c for c in big.columns if c not in keys] or keys
    salted = big.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    copies = aliased.withColumn("__salt_r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    on = F.col("__salt") == F.col("__salt_r")
    for s in same:
        on = on & s
    return salted.join(copies, on, how).drop("__salt", "__salt_r", *drop)


#: Rows of one key that one task joins; the rows of a key with more are spread over several.
HOT_ROWS = 100_000


def spread_join(big: DataFrame, other: DataFrame, keys: list[str], how: str = "inner", counted: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """An equi-join (inner or left) whose hot keys are salted, and only those.

    Keys are counted with partial results; a key with more than ``hot_rows`` rows in ``big``
    is cut into as many parts as it needs, the rows of ``other`` for it are copied to each.
    All other rows are shuffled once as they are. Keys are counted in ``counted``, which
    should be cut, or else in ``big``. Null keys match nothing. No other column may be in both.
    """
    hot = (big if counted is None else counted).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows).select(*keys, F.ceil(F.col("__n") / hot_rows).cast("int").alias("__parts"))
    hot = cut(hot)
    if hot.isEmpty():
        return big.join(other, keys, how)
    few = small_enough(hot)
    near = lambda df: df.join(F.broadcast(hot) if few else hot, keys, "left")
    rest = [c for c in big.columns if c not in keys] or keys
    left = near(big).withColumn("__salt", F.pmod(F.xxhash64(*rest), F.coalesce("__parts", F.lit(1))).cast("int")).drop("__parts")
    right = near(other).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts")
    return left.join(right, [*keys, "__salt"], how).drop("__salt")
