"""Approximate text matching: blocking by 3-grams, then similarity."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from resultlake.functions.columns import fold_text
from resultlake.operators.shape import checkpointed


def ratio(a: Column, b: Column) -> Column:
    """1 - edits by the longer length; 1 for two empty texts."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1.0 - F.levenshtein(a, b) / longest)


def fuzzy_score(text: Column, query: str) -> Column:
    """1 if the folded query is within the folded text, else the best ratio to the whole text or to as many of its words in a row."""
    q = F.lit(" ".join(query.lower().split()))
    q = fold_text(q)
    t = fold_text(text)
    n = max(1, len(query.split()))
    words = F.split(t, " ")
    parts = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, n), " "))
    best = F.array_max(F.transform(parts, lambda p: ratio(p, q)))
    return F.when(F.contains(t, q), 1.0).otherwise(F.greatest(ratio(t, q), best))


def trigrams(c: Column) -> Column:
    """Distinct 3-grams of a folded text with two blanks around it."""
    padded = F.concat(F.lit("  "), fold_text(c), F.lit("  "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3))))


def fuzzy_lookup(df: DataFrame, column: str, query: str, least: float = 0.55, k: int = 20, share: float = 0.3) -> DataFrame:
    """The ``k`` rows nearest to a query among those that have ``share`` of its 3-grams."""
    grams = trigrams(F.lit(query))
    common = F.size(F.array_intersect(trigrams(F.col(column)), grams))
    some = df.filter(common >= F.ceil(F.size(grams) * share)).withColumn("score", fuzzy_score(F.col(column), query))
    return some.filter(F.col("score") >= least).orderBy(F.desc("score"), column).limit(k)


def write_gram_index(df: DataFrame, column: str, where: str) -> None:
    """A table (gram, text) of the 3-grams of distinct texts, sorted by gram.

    A lookup reads the files' row groups of its own 3-grams only. A frequent 3-gram takes
    several files, as ranges are cut by text too.
    """
    texts = df.select(F.col(column).alias("text")).dropna().distinct()
    grams = texts.select(F.explode(trigrams(F.col("text"))).alias("gram"), "text")
    grams.repartitionByRange("gram", "text").sortWithinPartitions("gram", "text").write.mode("overwrite").parquet(where)


def index_lookup(index: DataFrame, query: str, least: float = 0.55, k: int = 20, share: float = 0.3) -> DataFrame:
    """(text, score): what :func:`fuzzy_lookup` finds among the distinct texts of a 3-gram index, without a scan of the texts."""
    folded = query_trigrams(query)
    some = index.filter(F.col("gram").isin(*folded)).groupBy("text").agg(F.count("*").alias("common"))
    near = some.filter(F.col("common") >= math.ceil(len(folded) * share)).select("text", fuzzy_score(F.col("text"), query).alias("score"))
    return near.filter(F.col("score") >= least).orderBy(F.desc("score"), "text").limit(k)


def query_trigrams(query: str) -> list[str]:
    """The distinct 3-grams of a query, found as :func:`trigrams` finds those of texts."""
    spark = SparkSession.active()
    return list(spark.range(1).select(trigrams(F.lit(query)).alias("g")).first()["g"])  # of one short text


def fuzzy_join(left: DataFrame, right: DataFrame, a: str, b: str, least: float = 0.6, block: int = 1000) -> DataFrame:
    """For each distinct text of ``left`` its nearest text of ``right``, by shared 3-grams and then ratio.

    An edit changes three 3-grams at most, so of a pair within d edits one of any 3 d + 1
    3-grams of the query is shared: each query is looked up by its rarest. Near texts are
    looked for first, the others for what is left. Texts of a frequent 3-gram are dealt out
    in blocks of about ``block``; none is left out.
    """
    x = left.select(F.col(a).alias("query")).dropna().distinct()
    y = right.select(F.col(b).alias("match")).dropna().distinct()
    grams = y.select("match", F.explode(trigrams(F.col("match"))).alias("gram"))
    counts = grams.groupBy("gram").agg(F.count("*").alias("n"))
    x = x.select("query", F.explode(trigrams(F.col("query"))).alias("gram")).join(counts, "gram", "left")
    x = checkpointed(x.groupBy("query").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))).alias("g")))
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    y = grams.join(counts, "gram").select("match", "gram", F.pmod(F.xxhash64("match"), blocks.cast("long")).cast("int").alias("block"))
    out = None
    for level in sorted({max(least, 0.8), least}, reverse=True):
        size = F.length(fold_text(F.col("query")))
        edits = F.floor(size * ((1 - level) / level) + 1e-9) if level > 0 else size + F.size("g")
        q = x.select("query", F.explode(F.slice("g", F.lit(1), F.least(F.size("g"), edits * 3 + 1).cast("int"))).alias("r")).select("query", "r.gram", "r.n").filter("n > 0")
        q = q.select("query", "gram", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
        one, two = fold_text(F.col("query")), fold_text(F.col("match"))
        close = F.least(F.length(one), F.length(two)) >= F.greatest(F.length(one), F.length(two)) * level - 1e-9
        scored = q.join(y, ["gram", "block"]).filter(close).withColumn("score", ratio(one, two)).filter(F.col("score") >= level)
        best = scored.groupBy("query").agg(F.min(F.struct((-F.col("score")).alias("s"), "match")).alias("m")).select("query", "m.match", (-F.col("m.s")).alias("score"))
        best = checkpointed(best)
        out = best if out is None else out.unionByName(best)
        x = x.join(best.select("query"), "query", "left_anti")
    return out


def map_distinct(df: DataFrame, column: str, fn: Callable[[Column], Column], name: str) -> DataFrame:
    """A costly function evaluated once for each distinct value and joined back; null is a value."""
    values = df.select(F.col(column).alias("__v")).distinct().withColumn(name, fn(F.col("__v")))
    return df.join(values, df[column].eqNullSafe(values["__v"]), "left").drop("__v")
