"""Sorting, limits, top-k and seeded samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resultlake.operators.shape import attach, with_row_id


def sort_by(df: DataFrame, keys: list[tuple[str, bool]]) -> DataFrame:
    """Sort by (column, descending)."""
    return df.orderBy(*[F.desc(c) if down else F.asc(c) for c, down in keys])


def total_sort(df: DataFrame, lead: list[str]) -> DataFrame:
    """Sort by some columns and then by all others, so equal input in any order gives equal output."""
    return df.orderBy(*lead, *[c for c in df.columns if c not in lead])


def sort_in_blocks(df: DataFrame, block: str, keys: list[str]) -> DataFrame:
    """Rows of a block together, sorted by the keys that exist."""
    own = [k for k in keys if k in df.columns]
    return df.repartitionByRange(block).sortWithinPartitions(block, *own)


def tail(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The last ``n`` rows of an order, the last first."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def capped(df: DataFrame, limit: int = 200, most: int = 2000) -> tuple[DataFrame, Column]:
    """At most ``limit`` rows with the flag ``truncated``, which tells whether there were more.

    One more row than the limit is read, not the whole result.
    """
    n = max(1, min(limit, most))
    some = df.limit(n + 1)
    size = some.agg((F.count("*") > n).alias("truncated"))
    return attach(some.limit(n), size), F.col("truncated")


def top_duplicates(df: DataFrame, key: list[str], k: int = 5) -> DataFrame:
    """The ``k`` keys with the most rows among those with several."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").orderBy(F.desc("n"), *key).limit(k)


def seeded(key: list[str], seed: int) -> Column:
    """The place of a row in a seeded order, which any engine with MD5 can tell."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]).cast("binary"))


#: Hex digits of the seeded order that make a bucket: 65,536 buckets.
DIGITS = 4


def seeded_place(df: DataFrame, by: list[str], key: list[str], seed: int, most: Column | int) -> DataFrame:
    """The first ``most`` rows of each group in the seeded order, with ``__p``, their place from 1.

    The order's first digits are buckets. Rows of buckets are counted; a group's buckets,
    65,536 at most, give each its start, and only rows of buckets that begin before ``most``
    are sorted, each bucket for itself. ``most`` may be a column of ``df`` that is one for
    each group.
    """
    order = seeded(key, seed)
    bucketed = df.withColumn("__bucket", F.substring(order, 1, DIGITS))
    ahead = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = bucketed.groupBy(*by, "__bucket").agg(F.count("*").alias("__n")).withColumn("__start", F.coalesce(F.sum("__n").over(ahead), F.lit(0)))
    keys = [*by, "__bucket"]
    starts = starts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__start")
    on = reduce(lambda a, b: a & b, [bucketed[k].eqNullSafe(starts[f"__k{i}"]) for i, k in enumerate(keys)])
    near = bucketed.join(starts, on).drop(*[f"__k{i}" for i in range(len(keys))]).filter(F.col("__start") < most)
    placed = near.withColumn("__p", F.col("__start") + F.row_number().over(Window.partitionBy(*keys).orderBy(order, *key)))
    return placed.filter(F.col("__p") <= most).drop("__bucket", "__start")


def sample_n(df: DataFrame, key: list[str], n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows, or all if there are fewer: the first of a seeded order (T07); no task gathers them."""
    return seeded_place(df, [], key, seed, n).drop("__p")


def every_kth(df: DataFrame, order: list[str], k: int) -> DataFrame:
    """Every k-th row of an order, numbered without one task for all rows."""
    return with_row_id(df, order, "__n").filter(F.col("__n") % k == 0).drop("__n")


def allocation(counts: DataFrame, stratum: str, n: int) -> DataFrame:
    """(stratum, n, take): ``n`` rows shared in proportion to the sizes of strata, by largest remainders.

    ``counts`` has one row for each stratum.
    """
    total = counts.agg(F.sum("n").alias("total"))
    c = attach(counts, total)
    want = F.least(F.lit(n), F.col("total"))
    c = c.withColumn("base", F.floor(want * F.col("n") / F.col("total")))
    c = c.withColumn("rest", F.pmod(want * F.col("n"), F.col("total")))
    spare = F.first(want).over(Window.partitionBy()) - F.sum("base").over(Window.partitionBy())
    rank = F.row_number().over(Window.orderBy(F.desc("rest"), stratum))
    return c.withColumn("take", F.col("base") + (rank <= spare).cast("int")).select(stratum, "n", F.col("take").cast("long").alias("take"))


def proportional_sample(df: DataFrame, stratum: str, key: list[str], n: int, seed: int) -> DataFrame:
    """A seeded sample of ``n`` rows with every stratum in proportion (T09); no task sorts a stratum."""
    take = allocation(df.groupBy(stratum).agg(F.count("*").alias("n")), stratum, n).select(F.col(stratum).alias("__s"), F.col("take").alias("__take"))
    wanted = df.join(take, df[stratum].eqNullSafe(take["__s"])).drop("__s")
    return seeded_place(wanted, [stratum], key, seed, F.col("__take")).drop("__p", "__take")


def nested_sample(df: DataFrame, key: list[str], sizes: list[int], seed: int) -> DataFrame:
    """Rows of the largest sample with ``sample``, the smallest size whose sample holds them: each is within the next."""
    out = F.lit(max(sizes))
    for s in sorted(sizes, reverse=True):
        out = F.when(F.col("__p") <= s, s).otherwise(out)
    return seeded_place(df, [], key, seed, max(sizes)).withColumn("sample", out).drop("__p")


def shuffle_keep_tail(df: DataFrame, key: list[str], newest: Column, seed: int) -> DataFrame:
    """A seeded shuffle in which rows of the newest block stay last."""
    return df.orderBy(newest, seeded(key, seed), *key)
