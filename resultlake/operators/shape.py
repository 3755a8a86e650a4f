"""Projection, filter and typing of tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resultlake.functions.columns import tolerant_cast


def select_matching(df: DataFrame, patterns: list[str]) -> DataFrame:
    """Columns whose name begins with a match of one of the patterns; others are never read."""
    return df.select(*[c for c in df.columns if any(re.match(p, c) for p in patterns)])


def drop_matching(df: DataFrame, patterns: list[str]) -> DataFrame:
    """Columns but those that match."""
    return df.select(*[c for c in df.columns if not any(re.match(p, c) for p in patterns)])


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, for typing later."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def rename_existing(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that are there."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def suffix_pairs(df: DataFrame, a: str = "_ns", b: str = "_ew") -> DataFrame:
    """``x`` becomes ``x + a`` wherever ``x + b`` is a column."""
    return df.withColumnsRenamed({c: c + a for c in df.columns if c + b in df.columns})


def restore_types(df: DataFrame, ints: list[str], floats: list[str]) -> DataFrame:
    """Text columns as numbers where the registry says so; text that is none is null."""
    kinds = dict.fromkeys(ints, "bigint") | dict.fromkeys(floats, "double")
    return df.select(*[tolerant_cast(c, kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without null in the columns."""
    return df.dropna(subset=columns)


def any_of(conditions: list[Column]) -> Column:
    """Whether one holds (P10)."""
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: list[Column]) -> Column:
    """Whether all hold (P10)."""
    return reduce(lambda a, b: a & b, conditions)


def keep_in(df: DataFrame, column: str, values: list, nulls: bool = False) -> DataFrame:
    """Rows whose value is one of some, with null rows if asked."""
    c = F.col(column)
    return df.filter(c.isin(*values) | c.isNull() if nulls else c.isin(*values))


def keep_between(df: DataFrame, column: str, lo, hi, nulls: bool = False) -> DataFrame:  # noqa: ANN001
    """Rows whose value is in an inclusive range, with null rows if asked."""
    c = F.col(column)
    return df.filter(c.between(lo, hi) | c.isNull() if nulls else c.between(lo, hi))


def remap(df: DataFrame, column: str, mapping: dict, strict: bool = True) -> DataFrame:
    """Values by a dictionary; null stays. An unknown value is an error if ``strict``, else null."""
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    c = F.col(column)
    out = F.try_element_at(table, c)
    if strict:
        unknown = F.raise_error(F.concat(F.lit(f"unknown value of {column}: "), c.cast("string")))
        out = F.when(c.isNull() | out.isNotNull(), out).otherwise(unknown.cast(T._infer_type(next(iter(mapping.values())))))
    return df.withColumn(column, out)


def downcast_floats(df: DataFrame) -> DataFrame:
    """Doubles as floats."""
    return df.select(*[F.col(f.name).cast("float").alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema])


def drop_types(df: DataFrame, kinds: tuple[type, ...] = (T.ArrayType, T.MapType, T.StructType)) -> DataFrame:
    """Columns but those of some types."""
    return df.select(*[f.name for f in df.schema if not isinstance(f.dataType, kinds)])


def drop_text(df: DataFrame, patterns: list[str], keep: list[str]) -> DataFrame:
    """Without text columns that match a pattern, but for those kept."""
    return df.select(*[f.name for f in df.schema if f.name in keep or not (isinstance(f.dataType, T.StringType) and any(re.match(p, f.name) for p in patterns))])


def ensure_column(df: DataFrame, column: str, value, kind: str) -> DataFrame:  # noqa: ANN001
    """Add a literal column if it is absent."""
    return df if column in df.columns else df.withColumn(column, F.lit(value).cast(kind))


def _default(kind: T.DataType):  # noqa: ANN202
    if isinstance(kind, T.BooleanType):
        return False
    return 0 if isinstance(kind, T.NumericType) else None


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema in its order: absent ones by a default of their type (0, false, null), extras dropped."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(_default(f.dataType))).cast(f.dataType).alias(f.name) for f in schema])


def prefer_raw(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """For (raw, typed) twins the raw value where it casts to the type, else the typed one; raw ones are dropped.

    Names may differ in case only, so columns are picked by position.
    """
    fields = {f.name: f.dataType for f in df.schema}
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    at = {name: F.col(f"c{i}") for i, name in enumerate(df.columns)}
    twins = {typed: raw for raw, typed in pairs if raw in fields and typed in fields}
    drop = set(twins.values())
    return plain.select(*[(F.coalesce(at[twins[c]].try_cast(fields[c]), at[c]) if c in twins else at[c]).alias(c) for c in df.columns if c not in drop])


def attach(df: DataFrame, one: DataFrame) -> DataFrame:
    """``df`` with the columns of a frame of one row, as scalar subqueries: nothing is joined."""
    return df.withColumns({c: one.select(c).scalar() for c in one.columns})


def scale_percent(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fractions as 0 to 100: a column is multiplied only if none of its values is above 1.

    The greatest values are one row.
    """
    most = df.agg(*[F.max(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(f"__m{i}") for i, c in enumerate(columns)])
    joined = attach(df, most)
    at = {c: i for i, c in enumerate(columns)}
    return joined.select(*[(F.when(F.col(f"__m{at[c]}") <= 1, F.col(c) * 100).otherwise(F.col(c)).alias(c) if c in at else F.col(c)) for c in df.columns])


def add_split(df: DataFrame, date: str, cutoff: str) -> DataFrame:
    """Indicator columns of training (before the cutoff) and test rows; a row without a date is neither."""
    d = F.col(date).cast("date")
    at = F.lit(cutoff).cast("date")
    return df.withColumns({date: d, "is_train": F.coalesce(d < at, F.lit(False)), "is_test": F.coalesce(d >= at, F.lit(False))})


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, ``spark.checkpoint.dir``; a temporary one only in a local session that names none."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="resultlake-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new place for a table in the folder that all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the folder that all executors share."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


#: Rows that :func:`parts_of` counts on in a task.
ROWS_OF_TASK = 250_000


def parts_of(df: DataFrame) -> int:
    """Partitions for the rows of a table, so that a task's share stays the same as the table grows; a core has one at least."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_OF_TASK))


def ranges(df: DataFrame) -> int:
    """Ranges that an order is cut into: as many as the session's shuffles have partitions, 64 at least."""
    return max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_row_id(df: DataFrame, order: list[str], name: str = "row_id", parts: int | None = None) -> DataFrame:
    """Numbers from 0 in an order, without one task for all rows (P20).

    Rows are range-partitioned by the order; the sizes of the ranges, as many as partitions,
    give each range its start. The ranges come from a sample that differs from run to run,
    so they are written down before they are counted.
    """
    ranged = df.repartitionByRange(parts or ranges(df), *order).sortWithinPartitions(*order)
    local = ranged.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()})
    local = checkpointed(local.withColumn("__at", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = local.groupBy("__part").agg(F.count("*").alias("__n"))
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__start"))
    return local.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.col("__at")).drop("__part", "__at", "__start")
