"""Incremental upkeep: keyed micro-batches, high-water marks, fingerprints and caches."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date as Date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from resultlake.operators.joins import cascade, overlay
from resultlake.operators.sets import unique_by
from resultlake.sources.versions import PartedTable, key_part

#: Buckets of a table that is kept by key; a batch rewrites those that it has keys of.
BUCKETS = 64


def stamp(df: DataFrame, key: Column, day: Column) -> DataFrame:
    """Every row with the id and the date of its event."""
    return df.withColumns({"event_id": key, "event_date": day.cast("date")})


def drop_absorbed(df: DataFrame, date: str, cutoff: str | Date | None) -> DataFrame:
    """Rows later than what the history has absorbed; unknown dates stay."""
    if cutoff is None:
        return df
    d = F.col(date).cast("date")
    return df.filter(d.isNull() | (d > F.lit(str(cutoff)).cast("date")))


def _merge(batch: DataFrame, target: str, key: list[str], merged: Callable[[DataFrame | None, DataFrame], DataFrame], properties: dict | None, buckets: int) -> int:
    """Put ``merged(old rows, batch)`` in place of the buckets that the batch has keys of; other buckets' files stay."""
    spark = batch.sparkSession
    table = PartedTable(spark, target)
    before = table.entry()
    if before:
        buckets = before["properties"]["buckets"]
    touched = [r[0] for r in batch.select(key_part(key, buckets)).distinct().collect()]  # ``buckets`` at most
    old = table._rows(before, touched) if before else None
    now = {"buckets": buckets} | (before["properties"] if before else {}) | (properties or {})
    return table.rewrite(merged(old, batch), key_part(key, buckets), touched, now, before)


def upsert_batch(batch: DataFrame, target: str, key: str, date: str, cutoff: str | Date | None = None, buckets: int = BUCKETS) -> int:
    """Rows of a batch in place of all rows of their keys, without what the cutoff absorbs (I02); returns the version.

    The target is kept in buckets of the key, and only those with keys of the batch are
    rewritten. The cutoff is a property of the table that :func:`upserted` applies to all
    rows, so a later one leaves nothing old in buckets that no batch touches. Running the
    same batch again changes nothing, so a batch that was lost half-way may be repeated.
    """
    def merged(old: DataFrame | None, new: DataFrame) -> DataFrame:
        return drop_absorbed(overlay(old, new, key).select(old.columns) if old is not None else new, date, cutoff)

    absorbed = {"date": date, "cutoff": None if cutoff is None else str(cutoff)}
    return _merge(batch, target, [key], merged, absorbed, buckets)


def upserted(spark: SparkSession, target: str) -> DataFrame | None:
    """The table that :func:`upsert_batch` keeps, without what the newest cutoff absorbs."""
    entry = (table := PartedTable(spark, target)).entry()
    if entry is None:
        return None
    return drop_absorbed(table._rows(entry), entry["properties"]["date"], entry["properties"]["cutoff"])


def upsert_stream(stream: DataFrame, target: str, key: str, date: str, checkpoint: str, cutoff: str | Date | None = None) -> StreamingQuery:
    """All that has arrived, batch by batch, into a table."""
    def each(batch: DataFrame, _: int) -> None:
        upsert_batch(batch, target, key, date, cutoff)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def replay(df: DataFrame, key: str, batch: str, date: str, cutoff: str) -> DataFrame:
    """What upserts of all batches in order leave: for each key the rows of its last batch, less what is absorbed."""
    last = df.groupBy(key).agg(F.max(batch).alias("__last"))
    kept = df.join(last, key).filter(F.col(batch) == F.col("__last")).drop("__last")
    return drop_absorbed(kept, date, cutoff)


def backfill(tables: dict[str, DataFrame], target: DataFrame, root: str, key: str, date: str, cutoff: str, links: list[tuple[str, str, str, str]]) -> dict[str, DataFrame]:
    """Rows of the root that are newer than the cutoff and not in the target, and what hangs on them."""
    d = F.col(date).cast("date")
    new = tables[root].filter(d > F.lit(cutoff).cast("date")).join(target.select(key), key, "left_anti")
    return cascade(tables, new, links)


def high_water(df: DataFrame, date: str) -> DataFrame:
    """One row with the newest date."""
    return df.agg(F.max(F.col(date).cast("date")).alias("high_water"))


def coverage_start(newest: Column, unit: str, today: Column) -> Column:
    """Where a look-back begins: the day after the newest date for ``hour``, at the start of the month before last for ``quarter``, never in the future."""
    if unit == "quarter":
        return F.trunc(F.add_months(today, -3), "month").cast("date")
    return F.least(F.date_add(newest, 1), today)


def pending(expected: DataFrame, done: DataFrame, checked: DataFrame, key: str, today: str, settled_days: int = 30) -> DataFrame:
    """Expected keys that are not done, but for misses settled when last checked.

    ``checked`` (key, event_date, checked_date): a miss is settled if it was checked at least
    ``settled_days`` after its event.
    """
    settled = checked.filter(F.datediff("checked_date", "event_date") >= settled_days).select(key)
    open_ = expected.select(key).distinct().join(done.select(key), key, "left_anti")
    return open_.join(settled, key, "left_anti")


def fingerprints(df: DataFrame, block: Column, columns: list[str] | None = None) -> DataFrame:
    """(block, rows, content): the content of a block whatever the order of its rows.

    Sums of two row hashes; copies count, so they do not cancel each other as in an exclusive or.
    """
    cols = columns or df.columns
    h = F.xxhash64(*cols)
    low, high = F.pmod(h, F.lit(1 << 31)), F.pmod(F.shiftright(h, 31), F.lit(1 << 31))
    return df.groupBy(block.alias("block")).agg(F.count("*").alias("rows"), F.sum(low).alias("content_a"), F.sum(high).alias("content_b"))


def changed_blocks(now: DataFrame, before: DataFrame) -> DataFrame:
    """Blocks with a ``status``: new, changed or vanished since the fingerprints before; equal ones are left out."""
    a = now.select("block", F.struct(*[c for c in now.columns if c != "block"]).alias("a"))
    b = before.select("block", F.struct(*[c for c in before.columns if c != "block"]).alias("b"))
    j = a.join(b, a["block"].eqNullSafe(b["block"]), "full_outer")
    status = F.when(F.col("b").isNull(), "new").when(F.col("a").isNull(), "vanished").when(F.col("a") != F.col("b"), "changed")
    return j.select(F.coalesce(a["block"], b["block"]).alias("block"), status.alias("status")).filter("status IS NOT NULL")


def rebuild_blocks(df: DataFrame, block: str, where: str, fn: Callable[[DataFrame], DataFrame]) -> dict[str, str]:
    """Bring ``fn`` of a table up to date block by block (I07); returns {block: new, changed or vanished}.

    Blocks are compared by the fingerprints of their source rows, which lie beside the
    result. New and changed ones are computed, all others stay where they lie, and vanished
    ones go; all of that, and the fingerprints, at one moment, so a run that dies changes
    nothing and the next one does the same work. ``fn`` keeps the block column, which is
    text in the result.
    """
    spark = df.sparkSession
    table, seen = PartedTable(spark, f"{where}/rows"), PartedTable(spark, f"{where}/fingerprints")
    before = table.entry()
    name = F.coalesce(F.col(block).cast("string"), F.lit("null"))
    now = fingerprints(df, name)
    known = seen.read(before["properties"]["fingerprints"]) if before else spark.createDataFrame([], now.schema)
    version = seen.replace(now)
    status = {r["block"]: r["status"] for r in changed_blocks(seen.read(version), known).collect()}  # one for each block
    if before and not status:
        return {}
    some = [b for b, s in status.items() if s != "vanished"]
    rows = fn(df.filter(name.isin(some)))
    rows = rows.withColumn(block, F.coalesce(F.col(block).cast("string"), F.lit("null")))
    table.rewrite(rows, F.col(block), list(status), {"fingerprints": version}, before)
    return status


def stale_windows(source: DataFrame, manifest: DataFrame) -> DataFrame:
    """Windows whose rows or newest date differ from the manifest, or that it lacks."""
    m = manifest.select("window", F.col("rows").alias("__rows"), F.col("last_date").alias("__last"))
    j = source.join(m, "window", "left")
    same = (F.col("rows") == F.col("__rows")) & F.col("last_date").eqNullSafe(F.col("__last"))
    return j.filter(~F.coalesce(same, F.lit(False))).select("window", "rows", "last_date")


def fill_cache(keys: DataFrame, key: str, cache: str, fn: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS) -> DataFrame:
    """Values of keys from a cache table: distinct misses are computed, put into the cache and joined.

    The cache is kept in buckets of the key: only those of the keys asked for are read.
    """
    spark = keys.sparkSession
    wanted = keys.select(key).distinct()
    table = PartedTable(spark, cache)
    entry = table.entry()
    if entry:
        buckets = entry["properties"]["buckets"]
        asked = [r[0] for r in wanted.select(key_part([key], buckets)).distinct().collect()]  # ``buckets`` at most
        wanted = wanted.join(table._rows(entry, asked).select(key), key, "left_anti")
    if entry is None or not wanted.isEmpty():
        _merge(fn(wanted), cache, [key], lambda old, new: new if old is None else old.unionByName(new), None, buckets)
    known = table.read()
    return keys.join(unique_by(known, [key], [key]), key, "left")


def stream_unique(stream: DataFrame, key: str, ts: str, target: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """The last row of each key of all that has arrived, in a table of buckets of which a batch rewrites its own."""
    def merged(old: DataFrame | None, new: DataFrame) -> DataFrame:
        return unique_by(new if old is None else old.unionByName(new), [key], [ts], keep="last")

    def each(batch: DataFrame, _: int) -> None:
        _merge(batch, target, [key], merged, None, buckets)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_within(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """The first row of each key within a delay, with state that the watermark bounds."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
