"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resultlake.llm.scratch import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a source that one bucket of its seeded order holds, about.
BUCKET_ROWS = 5000


def word_count(text: Column) -> Column:
    """Number of runs of anything but the white space of ASCII; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycle_weights(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Give the sources, in order of code points with null last, the weights in turn.

    ``sources`` has one row for each source; its window is over sources, not documents.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    table = F.array(*[F.lit(w).cast("long") for w in weights])
    return sources.withColumn("weight", F.get(table, (nth % len(weights)).cast("int")))


def water_fill(sources: DataFrame, share: float, epochs: int) -> DataFrame:
    """sources (source, source_size, weight) with a target for each.

    The targets share ``share`` times all sizes by weight, none above ``epochs`` times its
    source's size; what is cut off goes to the others by weight, again and again until no
    source is above. Only the level, one number, moves between the rounds.
    """
    sources = stored(sources, "sources")
    cap = F.col("source_size") * epochs
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    left, by = total * share, sources.agg(F.sum("weight")).first()[0] or 0
    seen = -1
    while True:
        above = (cap * by < F.lit(left) * F.col("weight")) if by else F.lit(True)
        n, used, free = sources.agg(F.coalesce(F.sum(F.when(above, 1)), F.lit(0)), F.coalesce(F.sum(F.when(above, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if n == seen or not free:
            break
        seen, left, by = n, total * share - used, free
    level = F.lit(float(left)) * F.col("weight") / F.lit(float(by)) if by else cap.cast("double")
    return sources.withColumn("target", F.least(level, cap.cast("double")))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: int = 2, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, repeats for each row of ``docs``.

    ``repeats`` is how often the mix takes the document, ``taken`` its words times that.
    A source takes each document as often as its target holds the whole source, and once
    more those that come first in a seeded order until the rest is nearest to the target.
    That order is cut into buckets, so no task holds a whole source. Null and empty texts
    have size 0 and are taken only in whole repetitions; a null source is a source of its
    own; rows that share a doc_id are ordered by size, then by ``row_col``, a unique key of the
    rows that is returned as the last column; without one they share their place. An empty
    table gives an empty result. Other columns, whatever their names, are ignored.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), *([F.col(row_col)] if row_col else []))
    own = [row_col] if row_col else []
    slim = slim.withColumn("key", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    slim = stored(slim, "sizes")
    facts = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    most = facts.agg(F.max("n")).first()[0] or 0
    digits = 1  # of the key, in base 16, that name a bucket
    while digits < 8 and most > BUCKET_ROWS * 16**digits:
        digits += 1
    targets = water_fill(cycle_weights(facts.drop("n"), weights), share, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = stored(targets.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "targets")

    slim = slim.withColumn("bucket", F.substring("key", 1, digits))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = slim.groupBy("source", "bucket").agg(F.sum("size").alias("inside")).withColumn("start", F.coalesce(F.sum("inside").over(ahead), F.lit(0)))
    starts = starts.alias("a").join(targets.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.source", "bucket", "start", "inside", "source_size", "target", "whole", "rest")
    rows = slim.alias("a").join(starts.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.bucket") == F.col("b.bucket"))).select("a.doc_id", "a.source", "a.bucket", "a.key", "a.size", *(f"a.{c}" for c in own), "start", "inside", "source_size", "target", "whole", "rest")
    clear = F.col("start") + F.col("inside") <= F.col("rest")
    beyond = F.col("start") >= F.col("rest")
    open_ = rows.filter(~clear & ~beyond)
    row = Window.partitionBy("source", "bucket").orderBy("key", "size", *own).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("size").over(row), F.lit(0))
    decided = rows.filter(clear | beyond).withColumn("once", (F.col("size") > 0) & clear)
    edge = open_.withColumn("once", (F.col("size") > 0) & (before * 2 + F.col("size") <= F.col("rest") * 2))
    repeats = F.col("whole") + F.col("once").cast("long")
    return decided.unionByName(edge).select("doc_id", "size", "source_size", "target", (F.col("size") * repeats).alias("taken"), repeats.alias("repeats"), *own)
