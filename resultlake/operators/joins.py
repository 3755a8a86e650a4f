"""Joins of facts with dimensions, roles, overlays and key sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    """Keys equal, nulls equal to nulls."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def join_dims(fact: DataFrame, dims: list[tuple[DataFrame, str | list[str]]]) -> DataFrame:
    """Left equi-joins of a fact with one dimension after another; Spark picks the strategy by size."""
    return reduce(lambda df, d: df.join(d[0], d[1], "left"), dims, fact)


def join_role(df: DataFrame, dim: DataFrame, keys: dict[str, str], role: str) -> DataFrame:
    """Left join to a dimension on {fact column: dimension column}; its other columns get the role as suffix."""
    used = list(keys.values())
    side = dim.select(*[F.col(c).alias(f"__{c}") for c in used], *[F.col(c).alias(f"{c}_{role}") for c in dim.columns if c not in used])
    on = reduce(lambda a, b: a & b, [df[f] == side[f"__{d}"] for f, d in keys.items()])
    return df.join(side, on, "left").drop(*[f"__{c}" for c in used])


def join_lookup(df: DataFrame, dim: DataFrame, key: str, prefix: str) -> DataFrame:
    """Left join by key with prefixed payload, never by position."""
    side = dim.select(F.col(key), *[F.col(c).alias(prefix + c) for c in dim.columns if c != key])
    return df.join(side, key, "left")


def pair_views(df: DataFrame, keys: list[str], crossed: tuple[str, str], a: str = "_ns", b: str = "_ew") -> DataFrame:
    """Two views of a table joined where each names the other: a.self = b.opponent and back."""
    own, other = crossed
    left = df.select(*[F.col(c).alias(c if c in keys else c + a) for c in df.columns])
    right = df.select(*[F.col(c).alias(c if c in keys else c + b) for c in df.columns])
    both = left.join(right, keys)
    return both.filter((F.col(own + a) == F.col(other + b)) & (F.col(other + a) == F.col(own + b)))


def pair_totals(df: DataFrame, keys: list[str], crossed: tuple[str, str], sides: tuple[str, str, str], counts: dict[str, str], sums: dict[str, str], tops: dict[str, str], a: str = "_ns", b: str = "_ew") -> DataFrame:
    """Totals of the pairs of :func:`pair_views` at each meeting, without making the pairs.

    ``sides``: the column that tells the sides, and its values on either. Where n rows of one
    side meet m of the other, each row is in as many pairs as the other side has rows, so the
    rows of both are grouped once, and totals of a side are multiplied by the other's rows.
    ``counts``, ``sums`` and ``tops`` (maxima) give a name to a column of the pairs, with its suffix.
    """
    (own, other), (side, *values) = crossed, sides
    of = {a: F.col(side) == values[0], b: F.col(side) == values[1]}

    def mine(column: str) -> Column:
        end = a if column.endswith(a) else b
        return F.when(of[end], F.col(column.removesuffix(end)))

    def times(column: str) -> Column:
        return F.col("__b" if column.endswith(a) else "__a")

    met = {own + a: F.when(of[a], F.col(own)).otherwise(F.col(other)), other + a: F.when(of[a], F.col(other)).otherwise(F.col(own))}
    rows = df.filter(of[a] | of[b]).withColumns(met).dropna(subset=[*keys, *met])
    measures = [F.count(mine(c)).alias(n) for n, c in counts.items()] + [F.sum(mine(c)).alias(n) for n, c in sums.items()] + [F.max(mine(c)).alias(n) for n, c in tops.items()]
    one = rows.groupBy(*keys, *met).agg(F.count_if(of[a]).alias("__a"), F.count_if(of[b]).alias("__b"), *measures).filter("__a > 0 AND __b > 0")
    return one.select(*keys, *met, (F.col("__a") * F.col("__b")).alias("n"), *[(F.col(n) * times(c)).alias(n) for n, c in (counts | sums).items()], *tops)


def path_join(frames: list[DataFrame], links: list[tuple[str, str]], where: Column | None = None) -> DataFrame:
    """Inner joins along a path, the first frame filtered before."""
    out = frames[0].filter(where) if where is not None else frames[0]
    for frame, (left, right) in zip(frames[1:], links):
        side = frame.withColumnRenamed(right, "__key")
        out = out.join(side, out[left] == side["__key"]).drop("__key")
    return out


def broadcast_lookup(df: DataFrame, dim: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Left join after reducing the dimension to one row for each key, the first in an order.

    What is left is small where keys are few; Spark broadcasts it if its size allows.
    """
    rest = [c for c in dim.columns if c not in keys]
    one = dim.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__d")).select(*keys, "__d.*")
    return df.join(one, keys, "left")


def join_roles(df: DataFrame, dim: DataFrame, key: str, roles: dict[str, str], payload: list[str]) -> DataFrame:
    """The same dimension joined once for each role: {role: fact column}; payload becomes ``name_role``.

    Keys are compared as text, so numbers in one table meet text in the other.
    """
    for role, column in roles.items():
        side = dim.select(F.col(key).cast("string").alias("__key"), *[F.col(c).alias(f"{c}_{role}") for c in payload])
        df = df.join(side, df[column].cast("string") == side["__key"], "left").drop("__key")
    return df


def null_safe_left(df: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on which null keys match; the dimension must be unique by the keys, else rows would multiply.

    That is found out by the same job: a repeated key is an error of the task that meets it.
    """
    rest = [c for c in dim.columns if c not in keys]
    one = dim.groupBy(*keys).agg(F.count("*").alias("__n"), F.first(F.struct(F.lit(True), *rest)).alias("__v"))
    wrong = F.raise_error(F.lit(f"the dimension is not unique by {keys}"))
    one = one.withColumn("__v", F.when(F.col("__n") == 1, F.col("__v")).otherwise(wrong.cast(one.schema["__v"].dataType)))
    return null_equal_join(df, one.select(*keys, *[F.col(f"__v.{c}").alias(c) for c in rest]), keys, "left")


def null_equal_join(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on which nulls match nulls; keys of the left side stay."""
    right = b.select(*[F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in b.columns])
    on = reduce(lambda x, y: x & y, [a[k].eqNullSafe(right[f"__{k}"]) for k in keys])
    return a.join(right, on, how).drop(*[f"__{k}" for k in keys])


def keep_keys(df: DataFrame, keys_df: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in another frame."""
    return df.join(keys_df.select(*on), on, "left_semi")


def drop_keys(df: DataFrame, keys_df: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not in another frame; null keys stay."""
    return df.join(keys_df.select(*on), on, "left_anti")


def cascade(tables: dict[str, DataFrame], root: DataFrame, links: list[tuple[str, str, str, str]]) -> dict[str, DataFrame]:
    """Filter tables hop by hop by the keys of the hop before: (from, its column, to, its column).

    ``root`` is the filtered table of the first hop's ``from``.
    """
    kept = {links[0][0]: root}
    for source, left, target, right in links:
        keys = kept[source].select(F.col(left).alias("__key")).distinct()
        t = kept.get(target, tables[target])
        kept[target] = t.join(keys, t[right] == keys["__key"], "left_semi")
    return kept


def block_join(fact: DataFrame, dim: DataFrame, keys: list[str], block: str) -> DataFrame:
    """Equi-join of two tables that share a block column, one of the keys.

    Of tables that :func:`~resultlake.sources.tables.write_bucketed` dealt by these keys,
    block first, into as many buckets, no row moves: each bucket is joined where it lies.
    Others are dealt by the keys, which hold the block, so no block is one task's.
    """
    return fact.join(dim, [block, *[k for k in keys if k != block]], "left")


def overlay(base: DataFrame, recent: DataFrame, key: str) -> DataFrame:
    """Recent rows in place of base rows with the same key, and all others."""
    return base.join(recent.select(key), key, "left_anti").unionByName(recent, allowMissingColumns=True)


def override_merge(base: DataFrame, official: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Full outer join in which official values win, with ``source`` telling where a row is from."""
    o = official.select(*key, *[F.col(c).alias(f"__o_{c}") for c in columns], F.lit(True).alias("__official"))
    b = base.withColumn("__base", F.lit(True))
    both = b.join(o, key, "full_outer")
    source = F.when(F.col("__official") & F.col("__base"), "both").when(F.col("__official"), "official").otherwise("base")
    return both.withColumns({c: F.coalesce(f"__o_{c}", c) for c in columns} | {"source": source}).drop("__official", "__base", *[f"__o_{c}" for c in columns])


def fresh_first(fresh: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Fresh rows, then history rows that they don't cover; ``rank`` 0 and 1 orders them."""
    rest = history.join(fresh.select(key), key, "left_anti")
    return fresh.withColumn("rank", F.lit(0)).unionByName(rest.withColumn("rank", F.lit(1)), allowMissingColumns=True)
