"""Data-quality operators: each check is a table (check, passed, detail, n)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resultlake.functions.columns import coerce_key
from resultlake.operators.aggs import conditional_counts
from resultlake.operators.sets import key_diff
from resultlake.operators.shape import attach


def _report(df: DataFrame, name: str, passed: Column, detail: Column, n: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check"), passed.alias("passed"), detail.alias("detail"), n.cast("long").alias("n"))


def _unpivot(one: DataFrame, names: list[str], prefix: str) -> DataFrame:
    """A row of counts as one check for each; a check passes at zero."""
    items = [F.struct(F.lit(f"{prefix}{n}").alias("check"), (F.col(n) == 0).alias("passed"), F.lit("").alias("detail"), F.col(n).cast("long").alias("n")) for n in names]
    return one.select(F.explode(F.array(*items)).alias("c")).select("c.*")


def collisions(df: DataFrame, keys: list[str], numeric: bool = False, nullable: bool = False) -> DataFrame:
    """Keys, after coercion, that several rows have, with their number (Q01)."""
    coerced = df.select(*[coerce_key(k, numeric).alias(k) for k in keys])
    if nullable:
        coerced = coerced.dropna(subset=keys)
    return coerced.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def check_unique(df: DataFrame, keys: list[str], numeric: bool = False, nullable: bool = False, k: int = 5) -> DataFrame:
    """Whether a key is unique, with the number of keys that are not and the worst ``k`` of them (Q01).

    ``nullable``: keys with null are not compared. Otherwise null is a violation too.
    """
    absent = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys])
    coerced = df.select(*[coerce_key(k, numeric).alias(k) for k in keys], absent.alias("__null"))
    if nullable:
        coerced = coerced.dropna(subset=keys)
    per = coerced.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if("__null").alias("__nulls"))  # read twice, shuffled once
    bad = per.filter("n > 1")
    worst = bad.orderBy(F.desc("n"), *keys).limit(k).agg(F.concat_ws("; ", F.sort_array(F.collect_list(F.concat(F.lpad(F.col("n").cast("string"), 12, " "), F.lit(" x "), F.concat_ws(",", *keys))), asc=False)).alias("worst"))
    total = per.agg(F.count_if(F.col("n") > 1).alias("n"), F.coalesce(F.sum("__nulls"), F.lit(0)).alias("nulls"))
    one = attach(total, worst)
    nulls = F.lit(0) if nullable else F.col("nulls")
    return _report(one, f"unique {','.join(keys)}", (F.col("n") == 0) & (nulls == 0), F.col("worst"), F.col("n") + nulls)


def reject_documents(tables: dict[str, DataFrame], required: dict[str, list[str]], doc: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables without the documents of which a row, in any table, lacks a required value; and those documents (Q02).

    A required column that a table lacks is an error.
    """
    bad = []
    for name, columns in required.items():
        unknown = [c for c in columns if c not in tables[name].columns]
        if unknown:
            raise ValueError(f"{name} has no column {', '.join(unknown)}")
        bad.append(tables[name].filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])).select(doc, F.lit(name).alias("table")))
    rejected = reduce(DataFrame.unionByName, bad).groupBy(doc).agg(F.array_sort(F.collect_set("table")).alias("tables"))
    return {n: t.join(rejected.select(doc), doc, "left_anti") for n, t in tables.items()}, rejected


def conflicting(df: DataFrame, key: list[str], value: list[str]) -> DataFrame:
    """Keys with more than one combination of values (Q03)."""
    return df.groupBy(*key).agg(F.count_distinct(F.struct(*value)).alias("n_values")).filter("n_values > 1")


def check_dependency(df: DataFrame, key: list[str], value: list[str]) -> DataFrame:
    """Whether each key has one value (Q03)."""
    return _report(conflicting(df, key, value).agg(F.count("*").alias("n")), f"{','.join(key)} -> {','.join(value)}", F.col("n") == 0, F.lit(""), F.col("n"))


def drop_conflicting(df: DataFrame, key: list[str], value: list[str]) -> DataFrame:
    """Rows but those of conflicting keys (Q03)."""
    return df.join(conflicting(df, key, value).select(*key), key, "left_anti")


def check_ranges(df: DataFrame, columns: list[str], lo: float, hi: float) -> DataFrame:
    """Values out of a range in each of many columns, in one pass; absent columns fail (Q04)."""
    there = [c for c in columns if c in df.columns]
    spark = df.sparkSession
    absent = spark.createDataFrame([(f"range {c}", False, "missing", 0) for c in columns if c not in there], "check string, passed boolean, detail string, n long")
    if not there:
        return absent
    return _unpivot(conditional_counts(df, {c: ~F.col(c).between(lo, hi) for c in there}), there, "range ").unionByName(absent)


def drop_out_of_range(df: DataFrame, columns: list[str], lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """Rows whose values are all within the range or null (Q05)."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNull() | F.col(c).between(lo, hi) for c in columns]))


def check_identity(df: DataFrame, name: str, holds: Column) -> DataFrame:
    """Rows that break an identity between columns; null on either side breaks nothing (Q06)."""
    return _report(df.agg(F.count_if(~holds).alias("n")), name, F.col("n") == 0, F.lit(""), F.col("n"))


def check_share(df: DataFrame, name: str, num: Column, den: Column, lo: float, hi: float) -> DataFrame:
    """Whether the share of rows is within a range (Q07)."""
    one = df.agg(F.count_if(num & den).alias("a"), F.count_if(den).alias("b")).withColumn("share", F.try_divide("a", "b"))
    return _report(one, name, F.coalesce(F.col("share").between(lo, hi), F.lit(False)), F.coalesce(F.round("share", 6).cast("string"), F.lit("none")), F.col("a"))


def check_ids(df: DataFrame, ids: list[str], pairs: list[str] = (), ratings: dict[str, str] | None = None) -> DataFrame:
    """Zero and null ids, pairs of one player, unordered pairs, ids without a rating and ratings without an id (Q08)."""
    cond = {}
    for c in ids:
        cond[f"zero {c}"] = F.col(c).cast("string").rlike("^0+$")
        cond[f"null {c}"] = F.col(c).isNull()
    for c in pairs:
        a, b = F.split_part(F.col(c), F.lit("-"), F.lit(1)), F.split_part(F.col(c), F.lit("-"), F.lit(2))
        cond[f"self {c}"] = a == b
        cond[f"unordered {c}"] = a > b
    for c, r in (ratings or {}).items():
        cond[f"unrated {c}"] = F.col(c).isNotNull() & F.col(r).isNull()
        cond[f"rated null {c}"] = F.col(c).isNull() & F.col(r).isNotNull()
    return _unpivot(conditional_counts(df, cond), list(cond), "")


def compare(a: DataFrame, b: DataFrame, keys: list[str], examples: int = 3) -> DataFrame:
    """Two versions of a table: schema, counts, keys on one side, and mismatches of each column with examples (Q09)."""
    spark = a.sparkSession
    only_a, only_b = sorted(set(a.columns) - set(b.columns)), sorted(set(b.columns) - set(a.columns))
    schema = spark.createDataFrame([("schema", not only_a and not only_b, ",".join(only_a + only_b), len(only_a) + len(only_b))], "check string, passed boolean, detail string, n long")
    sizes = attach(a.agg(F.count("*").alias("x")), b.agg(F.count("*").alias("y")))
    count = _report(sizes, "count", F.col("x") == F.col("y"), F.concat_ws(" ", "x", "y"), F.abs(F.col("x") - F.col("y")))
    sides = key_diff(a, b, keys).agg(F.count_if(F.col("side") == "a").alias("only in a"), F.count_if(F.col("side") == "b").alias("only in b"))
    shared = [c for c in a.columns if c in b.columns and c not in keys]
    x = a.select(*keys, *[F.col(c).alias(f"__a_{c}") for c in shared]).alias("x")
    y = b.select(*keys, *[F.col(c).alias(f"__b_{c}") for c in shared]).alias("y")
    both = x.join(y, reduce(lambda p, q: p & q, [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in keys]))
    diff = {c: ~F.col(f"__a_{c}").eqNullSafe(F.col(f"__b_{c}")) for c in shared}
    key_text = F.concat_ws(",", *[F.coalesce(F.col(f"x.{k}").cast("string"), F.lit("null")) for k in keys])
    long = both.select(key_text.alias("k"), F.explode(F.array(*[F.struct(F.lit(c).alias("column"), d.alias("bad")) for c, d in diff.items()])).alias("m")).select("k", "m.*")
    per = long.groupBy("column").agg(F.count_if("bad").alias("n"), F.min(F.when(F.col("bad"), F.col("k"))).alias("example"))
    columns = _report(per, "", F.col("n") == 0, F.coalesce("example", F.lit("")), F.col("n")).drop("check").withColumn("check", F.lit("")) if not shared else per.select(F.concat(F.lit("column "), "column").alias("check"), (F.col("n") == 0).alias("passed"), F.coalesce("example", F.lit("")).alias("detail"), F.col("n").cast("long").alias("n"))
    return schema.unionByName(count).unionByName(_unpivot(sides, ["only in a", "only in b"], "keys ")).unionByName(columns)


def drop_insane(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows but those with a negative score or scores that add up to zero; null is kept (Q10)."""
    wrong = (F.col(a) < 0) | (F.col(b) < 0) | (F.col(a) + F.col(b) == 0)
    return df.filter(~F.coalesce(wrong, F.lit(False)))


def audit(expected: DataFrame, done: DataFrame, unavailable: DataFrame, key: str) -> DataFrame:
    """Expected, complete, missing, unavailable and unresolved keys (Q11); each key counts once."""
    e = expected.select(key).distinct()
    d = done.select(key, F.lit(True).alias("__done")).distinct()
    u = unavailable.select(key, F.lit(True).alias("__gone")).distinct()
    j = e.join(d, key, "left").join(u, key, "left")
    has, gone = F.coalesce("__done", F.lit(False)), F.coalesce("__gone", F.lit(False))
    return j.agg(F.count("*").alias("expected"), F.count_if(has).alias("complete"), F.count_if(~has).alias("missing"), F.count_if(~has & gone).alias("unavailable"), F.count_if(~has & ~gone).alias("unresolved"))


def check_aligned(a: DataFrame, b: DataFrame, key: str, column: str) -> DataFrame:
    """Whether two tables agree on a column, row by row of a key; a key on one side disagrees (Q12)."""
    x, y = a.select(key, F.col(column).alias("__x"), F.lit(1).alias("__a")), b.select(key, F.col(column).alias("__y"), F.lit(1).alias("__b"))
    j = x.join(y, key, "full_outer")
    bad = F.col("__a").isNull() | F.col("__b").isNull() | ~F.col("__x").eqNullSafe(F.col("__y"))
    return _report(j.agg(F.count_if(bad).alias("n")), f"aligned {column}", F.col("n") == 0, F.lit(""), F.col("n"))
