"""Window functions over partitions of an entity or group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resultlake.functions.columns import clip
from resultlake.operators.shape import checkpointed, ranges


def partition_median(df: DataFrame, by: list[str], column: str, name: str) -> DataFrame:
    """``df`` with the exact median of the row's group, which no task holds."""
    middle = quantiles(df, by, column, [0.5], "__m").select(*[F.col(c).alias(f"__{c}") for c in by], F.get("__m", F.lit(0)).alias(name))
    on = reduce(lambda a, b: a & b, [df[c].eqNullSafe(middle[f"__{c}"]) for c in by])
    return df.join(middle, on, "left").drop(*[f"__{c}" for c in by])


def sequence(key: list[str], order: list[str]) -> Column:
    """Number of the row among its key's, from 0, in an order."""
    return F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1


def center(column: str, by: list[str], around: float = 0.5) -> Column:
    """x - mean of its group + 0.5, within [0, 1]."""
    return clip(F.col(column) - F.avg(column).over(Window.partitionBy(*by)) + around, 0.0, 1.0)


def entity_mean(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """The mean over all of an entity's rows on each of them: one aggregation, joined back."""
    mean = df.groupBy(key).agg(F.avg(value).alias(name))
    return df.join(mean, key, "left")


def avg_rank(by: list[str], column: str) -> Column:
    """Rank from 1 in the group, ties by their mean."""
    order = Window.partitionBy(*by).orderBy(column)
    peers = Window.partitionBy(*by, column)
    return F.rank().over(order) + (F.count("*").over(peers) - 1) / F.lit(2.0)


def ranked(df: DataFrame, by: list[str], column: str, name: str, parts: int | None = None) -> DataFrame:
    """``df`` with the mean rank of a column in its group, for groups of any size.

    Values are counted, dealt out by ranges of (group, value) and numbered in each range; the
    totals of a group's ranges, as many as there are ranges, give each range its start. No
    task sorts a whole group. Null values have no rank. The rows are written down first:
    computed again, a mean may differ in its last place and would miss its own rank.
    """
    df = checkpointed(df)
    values = df.filter(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("__n"))
    dealt = checkpointed(values.repartitionByRange(parts or ranges(df), *by, column).withColumn("__part", F.spark_partition_id()))
    here = Window.partitionBy(*by, "__part").orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*by, "__part").agg(F.sum("__n").alias("__t")).withColumn("__start", F.coalesce(F.sum("__t").over(ahead), F.lit(0))).drop("__t")
    keys = [*by, "__part"]
    on = reduce(lambda a, b: a & b, [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in keys])
    local = dealt.withColumn("__before", F.coalesce(F.sum("__n").over(here), F.lit(0)))
    placed = local.alias("x").join(totals.alias("y"), on).select(*[F.col(f"x.{k}") for k in [*by, column]], (F.col("__start") + F.col("__before") + (F.col("__n") + 1) / F.lit(2.0)).alias(name))
    both = reduce(lambda a, b: a & b, [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in [*by, column]])
    return df.alias("x").join(placed.alias("y"), both, "left").select("x.*", name)


def quantiles(df: DataFrame, by: list[str], column: str, at: list[float], name: str = "p") -> DataFrame:
    """(by, name): exact quantiles of the values that are not null, as an array, for groups of any size.

    Values are counted and numbered as in :func:`ranked`; the rows that hold the wanted ranks
    are picked and interpolated. No task sees all values of a group.
    """
    values = df.filter(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("__v"))
    counts = values.groupBy(*by, "__v").agg(F.count("*").alias("__n"))
    placed = _numbered(counts, by)
    size = counts.groupBy(*by).agg(F.sum("__n").alias("__all"))
    wanted = size.select(*by, F.explode(F.array(*[F.struct(F.lit(k).alias("k"), (F.lit(float(q)) * (F.col("__all") - 1)).alias("pos")) for k, q in enumerate(at)])).alias("w")).select(*by, "w.k", "w.pos")
    wanted = wanted.groupBy(*by).agg(F.collect_list(F.struct("k", "pos")).alias("__w"))
    both = reduce(lambda a, b: a & b, [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in by], F.lit(True))
    near = placed.alias("x").join(wanted.alias("y"), both).select(*[F.col(f"x.{c}") for c in by], "__v", "__start", "__n", F.explode("__w").alias("w"))
    first, step = F.floor("w.pos"), F.col("w.pos") - F.floor("w.pos")
    inside = lambda r: (F.col("__start") <= r) & (r < F.col("__start") + F.col("__n"))
    near = near.filter(inside(first) | inside(first + 1))
    part = F.when(inside(first), (1 - step) * F.col("__v")).otherwise(0.0) + F.when(inside(first + 1), step * F.col("__v")).otherwise(0.0)
    each = near.groupBy(*by, F.col("w.k").alias("k")).agg(F.sum(part).alias("v"))
    return each.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]).alias(name))


def _numbered(counts: DataFrame, by: list[str], parts: int | None = None) -> DataFrame:
    """``counts`` (by, __v, __n) with ``__start``, the rows of the group with smaller values."""
    dealt = checkpointed(counts.repartitionByRange(parts or ranges(counts), *by, "__v").withColumn("__part", F.spark_partition_id()))
    here = Window.partitionBy(*by, "__part").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*by, "__part").agg(F.sum("__n").alias("__t")).withColumn("__before", F.coalesce(F.sum("__t").over(ahead), F.lit(0)))
    on = reduce(lambda a, b: a & b, [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in [*by, "__part"]])
    local = dealt.withColumn("__here", F.coalesce(F.sum("__n").over(here), F.lit(0)))
    return local.alias("x").join(totals.alias("y"), on).select(*[F.col(f"x.{k}") for k in [*by, "__v", "__n"]], (F.col("__here") + F.col("__before")).alias("__start"))


def rank_percentile(by: list[str], column: str) -> Column:
    """Mean rank by the size of the group."""
    return avg_rank(by, column) / F.count("*").over(Window.partitionBy(*by))


def first_of(key: list[str], order: list[str]) -> Column:
    """Whether the row is the first of its key."""
    return F.row_number().over(Window.partitionBy(*key).orderBy(*order)) == 1


def duplicate_flag(key: list[str]) -> Column:
    """Whether the key has several rows."""
    return F.count("*").over(Window.partitionBy(*key)) > 1


def contiguous(df: DataFrame, key: list[str], position: str) -> DataFrame:
    """For each key whether its rows are adjacent by a position that numbers all rows."""
    g = df.groupBy(*key).agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count("*").alias("n"))
    return g.withColumn("contiguous", F.col("last") - F.col("first") + 1 == F.col("n"))
