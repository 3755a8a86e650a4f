"""Joins whose keys may have very many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a key from which on it is dealt over several tasks, at least; keys that are, at most.
HOT_ROWS, HOT_KEYS = 2_000, 10_000


def facts_join(rows: DataFrame, facts: DataFrame, keys: list[str], sizes: DataFrame) -> DataFrame:
    """``rows`` with the facts of their key; no column may be named ``__salt`` or ``__salts``.

    ``facts`` has one row for each key, ``sizes`` the rows ``n`` of each. A key of more than
    ``HOT_ROWS`` rows, or a ten-thousandth of all if that is more, is dealt over as many
    tasks as it is larger; its facts are sent to each. So few keys can be that large that
    their list is sent to every task. Rows with a null key, and keys without facts, go.
    """
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]  # one number
    limit = max(HOT_ROWS, -(-total // HOT_KEYS))
    hot = sizes.filter(F.col("n") > limit).select(*keys, F.ceil(F.col("n") / F.lit(limit)).alias("__salts"))
    salted = rows.join(F.broadcast(hot), keys, "left").withColumn("__salt", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("__salts")), F.lit(0).cast("long"))).drop("__salts")
    spread = facts.join(F.broadcast(hot), keys, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("__salts") - 1, F.lit(0).cast("long"))))).drop("__salts")
    return salted.join(spread, [*keys, "__salt"]).drop("__salt")
