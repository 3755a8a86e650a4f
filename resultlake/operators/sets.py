"""Unions, distinct rows and comparisons of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stack_roles(df: DataFrame, roles: dict[str, dict[str, str]], keep: list[str]) -> DataFrame:
    """One row for each role: {role: {new column: column of the row}}; the row is read once."""
    names = list(next(iter(roles.values())))
    items = [F.struct(F.lit(role).alias("role"), *[F.col(m[n]).alias(n) for n in names]) for role, m in roles.items()]
    return df.select(*keep, F.explode(F.array(*items)).alias("__r")).select(*keep, "__r.*")


#: Kinds from narrow to wide.
_WIDTH = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    if type(a) in _WIDTH and type(b) in _WIDTH:
        return max(a, b, key=lambda t: _WIDTH.index(type(t)))
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    return T.StringType()


def union_relaxed(dfs: list[DataFrame]) -> DataFrame:
    """Union of tables with different columns: absent ones are null, kinds become the wider one or text."""
    kinds: dict[str, T.DataType] = {}
    for df in dfs:
        for f in df.schema:
            kinds[f.name] = _wider(kinds.get(f.name, f.dataType), f.dataType)
    same = [df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()]) for df in dfs]
    return reduce(DataFrame.unionByName, same)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Each row once."""
    return df.distinct()


def unique_by(df: DataFrame, key: list[str], order: list[str], keep: str = "first") -> DataFrame:
    """One row for each key, the first or last by an order and then by all columns.

    Taken before the shuffle too, so a key with many rows is no task's burden.
    """
    rest = [c for c in df.columns if c not in key]
    place = F.struct(*order, *[c for c in rest if c not in order])
    pick = F.min_by if keep == "first" else F.max_by
    if not rest:
        return df.distinct()
    return df.groupBy(*key).agg(pick(F.struct(*rest), place).alias("__v")).select(*key, "__v.*").select(*df.columns)


def row_counts(df: DataFrame) -> DataFrame:
    """Distinct rows with how often each occurs."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("__n"))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables have the same rows as often (U05): each row counts for a and against b in one aggregation."""
    b = b.select(*a.columns)
    both = a.withColumn("__s", F.lit(1)).unionByName(b.withColumn("__s", F.lit(-1)))
    return both.groupBy(*a.columns).agg(F.sum("__s").alias("d")).filter("d != 0").limit(1).count() == 0


def key_diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are in one table only, with ``side`` a or b; null keys equal null keys."""
    both = a.select(*keys, F.lit(1).alias("__a"), F.lit(0).alias("__b")).unionByName(b.select(*keys, F.lit(0).alias("__a"), F.lit(1).alias("__b")))
    per = both.groupBy(*keys).agg(F.max("__a").alias("__a"), F.max("__b").alias("__b")).filter("__a != __b")
    return per.select(*keys, F.when(F.col("__a") == 1, "a").otherwise("b").alias("side"))
