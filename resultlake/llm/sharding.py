"""Size-tiered compaction of immutable shards under a versioned manifest.

A table is a folder of shards, Parquet files that never change, and of manifests, one for
each version, that list the live shards. Arrivals are appended as they are partitioned, one
small shard for each task. Compaction puts shards of similar size (one tier: a power of two
of bytes) in a row, cuts the row into runs of about the target size, and writes each run of
several shards as one file. A version comes into being when its commit file, written whole
under another name, is put in its place, which fails if another writer has been first; until
then nothing refers to what was written, so a writer may die at any moment. A file that is
no whole commit is no version. All rows move as DataFrames.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from resultlake.sources.versions import file_system, names, publish, read_text

MANIFEST = "path string, rows long, bytes long, tier int, written long, shards long"
#: Shards of a tier are dealt into so many stretches; totals of stretches are added up first, so no task orders a whole tier.
STRETCHES = 256
#: Runs merged by one job; more are merged by several, before one commit.
WAVE = 4096


class CommitConflict(Exception):
    """Another writer has committed the version."""


def tier_of(size: Column, unit: int) -> Column:
    """0 below ``unit`` bytes, then one more for each doubling."""
    return F.when(size < unit, 0).otherwise(F.length(F.bin(F.floor(size / F.lit(unit)).cast("long")))).cast("int")


def free_name(taken: list[str], name: str) -> str:
    """``name``, with as many underscores in front as it needs to be none of ``taken``."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name


class ShardedTable:
    """A table of shards at ``root``. Shards below ``target`` bytes are merged; tiers start at ``unit`` bytes.

    Rows may hold nulls, repeats and columns of any name. All arrivals have the columns of
    the first, in any order. An append without rows makes a version without new shards, and
    a version without shards is read as an empty table with those columns.
    """

    def __init__(self, spark: SparkSession, root: str, unit: int = 256 << 10, target: int = 128 << 20):
        self.spark, self.root, self.unit, self.target = spark, root.rstrip("/"), unit, target

    def _versions(self) -> list[int]:
        """Numbers of the files that are commits or may have been, in order."""
        return sorted(int(n) for n in names(self.spark, f"{self.root}/commits") if n.isdigit())

    def versions(self) -> Iterator[int]:
        """Committed versions, the newest first."""
        return (v for v in reversed(self._versions()) if self._committed(v))

    def version(self) -> int:
        """The newest committed version; 0 before the first."""
        return next(self.versions(), 0)

    def _next(self) -> int:
        return max(self._versions(), default=0) + 1

    def _committed(self, version: int) -> tuple[str, StructType] | None:
        """(token, schema of the rows) of a version; None if its file is no whole commit."""
        try:
            entry = json.loads(read_text(self.spark, f"{self.root}/commits/{version:08d}"))
            return entry["token"], StructType.fromJson(entry["schema"])
        except (ValueError, KeyError, TypeError):
            return None

    def manifest(self, version: int | None = None) -> DataFrame:
        """Live shards of a version: path under the root, rows, bytes, tier, the version that wrote it and the shards of that write."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifests/{self._committed(version)[0]}")

    def _commit(self, version: int, shards: DataFrame, token: str, schema: StructType) -> int:
        shards.write.parquet(f"{self.root}/manifests/{token}")
        text = json.dumps({"token": token, "schema": schema.jsonValue()})
        if not publish(self.spark, text, f"{self.root}/commits/{version:08d}"):  # the one atomic step
            raise CommitConflict(f"version {version} of {self.root}")
        return version

    def _rows(self, folders: list[str], schema: StructType, path_col: str) -> DataFrame:
        """Rows of write folders with the path of their shard."""
        df = self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*[f"{self.root}/shards/{f}" for f in folders])
        return df.withColumn(path_col, F.regexp_extract(df.metadataColumn("_metadata")["file_path"], r"/shards/([^/]+/.*)$", 1))

    def _folders(self, shards: DataFrame) -> list[tuple[str, bool]]:
        """(folder, whether all its shards are among ``shards``) of the writes that these come from: as many as live writes, not shards."""
        by = shards.groupBy(F.substring_index("path", "/", 1).alias("folder")).agg((F.count("*") == F.max("shards")).alias("whole"))
        return sorted((r["folder"], r["whole"]) for r in by.collect())

    def _facts(self, token: str, version: int, schema: StructType) -> DataFrame:
        """The shards of one write, from a scan that reads no column."""
        df = self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.root}/shards/{token}")
        file = df.metadataColumn("_metadata")
        facts = df.select(F.regexp_extract(file["file_path"], r"/shards/([^/]+/.*)$", 1).alias("path"), file["file_size"].alias("bytes")).groupBy("path").agg(F.count("*").alias("rows"), F.max("bytes").alias("bytes"))
        shards = facts.agg(F.count("*")).scalar().alias("shards")
        return facts.select("path", "rows", "bytes", tier_of(F.col("bytes"), self.unit).alias("tier"), F.lit(version).cast("long").alias("written"), shards)

    def append(self, arrivals: DataFrame) -> int:
        """Write arrivals as they lie, one small shard for each partition; returns the new version.

        Arrivals whose columns are not those of the table raise a ValueError.
        """
        before, version, token = self.version(), self._next(), f"a-{uuid.uuid4().hex}"
        schema = StructType([StructField(f.name, f.dataType) for f in arrivals.schema])
        if before:
            known = self._committed(before)[1]
            if sorted((f.name, f.dataType.json()) for f in known) != sorted((f.name, f.dataType.json()) for f in schema):
                raise ValueError(f"arrivals of {schema.simpleString()} for a table of {known.simpleString()}")
            schema = known
        arrivals.write.option("compression", "zstd").parquet(f"{self.root}/shards/{token}")
        return self._commit(version, self.manifest(before).unionByName(self._facts(token, version, schema)), token, schema)

    def plan(self, least: int = 2) -> DataFrame:
        """(path, run): small live shards and the number of the run, of ``least`` shards at least, that each is merged into."""
        small = self.manifest().filter(F.col("bytes") < self.target).withColumn("stretch", F.pmod(F.xxhash64("path"), F.lit(STRETCHES)))
        ahead = Window.partitionBy("tier").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
        inside = Window.partitionBy("tier", "stretch").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
        sums = small.groupBy("tier", "stretch").agg(F.sum("bytes").alias("sum")).withColumn("start", F.coalesce(F.sum("sum").over(ahead), F.lit(0)))
        # runs of a tier are numbered from where those of the tiers below it end; there are a few dozen tiers
        tiers = sums.groupBy("tier").agg(F.sum("sum").alias("sum")).select("tier", (F.floor(F.col("sum") / F.lit(self.target)) + 1).alias("runs"))
        first = tiers.select("tier", F.coalesce(F.sum("runs").over(Window.orderBy("tier").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
        placed = small.join(sums.drop("sum"), ["tier", "stretch"]).join(F.broadcast(first), "tier")
        before = F.col("start") + F.coalesce(F.sum("bytes").over(inside), F.lit(0))
        placed = placed.withColumn("run", F.col("first") + F.floor(before / F.lit(self.target)))
        runs = placed.groupBy("run").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
        return placed.join(runs, "run").select("path", "run", "shards")

    def compact(self, least: int = 2) -> int:
        """Merge each run of the plan into one file and commit; returns the version, new if anything merged.

        A task holds the rows of one run, which are of about the target size, and writes
        them as one file. Of more than ``WAVE`` runs so many are merged at a time.
        """
        before, version, token = self.version(), self._next(), f"c-{uuid.uuid4().hex}"
        where = f"{self.root}/plans/{token}"
        self.plan(least).write.parquet(where)
        plan = self.spark.read.schema("path string, run long, shards long").parquet(where)
        lo, hi = plan.agg(F.min("run"), F.max("run")).first()
        if lo is None:
            return before
        schema = self._committed(before)[1]
        path, run = free_name(schema.names, "__path"), free_name(schema.names, "__run")
        for start in range(lo, hi + 1, WAVE):
            wave = plan.filter(F.col("run").between(start, start + WAVE - 1))
            folders = [f for f, _ in self._folders(wave)]
            if not folders:
                continue
            rows = self._rows(folders, schema, path).join(wave.select(F.col("path").alias(path), (F.col("run") - start).cast("int").alias(run)), path).drop(path)
            many = min(WAVE, hi + 1 - start)
            rows.repartitionById(many, F.col(run)).drop(run).write.mode("append").option("compression", "zstd").parquet(f"{self.root}/shards/{token}")
        rest = self.manifest(before).join(plan, "path", "left_anti")
        return self._commit(version, rest.unionByName(self._facts(token, version, schema)), token, schema)

    def read(self, version: int | None = None, shard_col: str | None = None) -> DataFrame:
        """Rows of a version; no rows with the table's columns where it has no shards.

        ``shard_col``, which must be none of the columns, gets rows, bytes, tier and writing
        version of each row's shard. Writes of which every shard is live are read as they
        are; of others the rows of dead shards are filtered out.
        """
        version = self.version() if version is None else version
        if not version:
            raise ValueError(f"{self.root} has no version")
        schema = self._committed(version)[1]
        if shard_col and free_name(schema.names, shard_col) != shard_col:
            raise ValueError(f"the table has a column {shard_col}")
        live = self.manifest(version)
        facts = F.struct("path", "rows", "bytes", "tier", "written")
        folders = self._folders(live)
        if not folders:
            none = self.spark.createDataFrame([], schema)
            return none.withColumn(shard_col, F.lit(None).cast("struct<path:string,rows:bigint,bytes:bigint,tier:int,written:bigint>")) if shard_col else none
        path = free_name([*schema.names, shard_col or ""], "__path")
        shard = live.select(F.col("path").alias(path), *([facts.alias(shard_col)] if shard_col else []))
        parts = []
        for whole in (True, False):
            own = [f for f, w in folders if w == whole]
            if own:
                rows = self._rows(own, schema, path)
                parts.append((rows if whole and not shard_col else rows.join(shard, path)).drop(path))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def vacuum(self, keep: int = 1) -> None:
        """Delete writes that none of the newest ``keep`` versions refers to; nothing where there is no table."""
        live = {f for v in islice(self.versions(), keep) for f, _ in self._folders(self.manifest(v))}
        fs, _ = file_system(self.spark, self.root)
        for name in names(self.spark, f"{self.root}/shards"):
            if name not in live:
                fs.delete(file_system(self.spark, f"{self.root}/shards/{name}")[1], True)
