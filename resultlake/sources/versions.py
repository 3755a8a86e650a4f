"""Tables of parts whose newest version is one small file: replaced, in whole or part by part, at one moment.

A table is a folder. Data lies under ``data/<token>/part=<p>`` and never changes; a version
is a file under ``versions`` that says for each part where it lies. A version is written
beside and then put in its place under a name that must be free, so readers see whole
versions only, a writer that dies leaves the old one, and of two writers of one version one
fails. Parts are buckets of a key's hash or the values of a block column, so there are as
many entries as parts, whatever the rows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The column that tells a row's part in the files; it is not among a table's columns.
PART = "__part"


class Conflict(RuntimeError):
    """Another writer has committed since this one read the table."""


def file_system(spark: SparkSession, where: str):  # noqa: ANN201
    """(file system, path) of a location, whatever store holds it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def read_text(spark: SparkSession, where: str) -> str:
    """A small file."""
    fs, path = file_system(spark, where)
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish(spark: SparkSession, text: str, where: str) -> bool:
    """Put a small whole file at a place; false, and no change, if there is one already.

    It is written under a name of its own, closed, and then moved: by a hard link on a local
    disk, where a move would overwrite, by a rename that does not overwrite elsewhere.
    """
    fs, path = file_system(spark, where)
    jvm = spark.sparkContext._jvm
    fs.mkdirs(path.getParent())
    beside = jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(beside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            local = jvm.java.io.File(path.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(local, jvm.java.io.File(beside.toUri().getPath()).toPath())
        else:
            gateway = spark.sparkContext._gateway
            options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(beside, path, options)
    except Exception:
        if fs.exists(path):
            return False
        raise
    finally:
        fs.delete(beside, False)
    return True


def names(spark: SparkSession, where: str) -> list[str]:
    """Names of what lies in a folder, without hidden files; none if there is no folder."""
    fs, path = file_system(spark, where)
    found = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return [n for n in found if not n.startswith((".", "_"))]


class PartedTable:
    """A table at ``where``; see the module."""

    def __init__(self, spark: SparkSession, where: str) -> None:
        self.spark, self.where = spark, where.rstrip("/")

    # ---- versions

    def versions(self) -> list[int]:
        return sorted(int(n) for n in names(self.spark, f"{self.where}/versions") if n.isdigit())

    def entry(self, version: int | None = None) -> dict | None:
        """What a version says, or the newest: ``schema``, ``parts`` {part: folder}, ``properties``; None without one."""
        known = self.versions()
        if not known:
            return None
        return json.loads(read_text(self.spark, f"{self.where}/versions/{version or known[-1]:012d}")) | {"version": version or known[-1]}

    def _commit(self, before: dict | None, schema: T.StructType, parts: dict[str, str], properties: dict) -> int:
        version = (before["version"] if before else 0) + 1
        text = json.dumps({"schema": schema.jsonValue(), "parts": parts, "properties": properties})
        if not publish(self.spark, text, f"{self.where}/versions/{version:012d}"):
            raise Conflict(f"version {version} of {self.where}")
        return version

    # ---- reading

    def read(self, version: int | None = None, parts: list[str] | None = None) -> DataFrame | None:
        """The rows of a version, or of some of its parts; None if there is no version.

        The frame stays what it is when newer versions come, until :meth:`vacuum`.
        """
        entry = self.entry(version)
        return None if entry is None else self._rows(entry, parts)

    def _rows(self, entry: dict, parts: list[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        wanted = [folder for part, folder in entry["parts"].items() if parts is None or part in parts]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.where}/{w}" for w in wanted])

    # ---- writing

    def _write(self, df: DataFrame, part: Column | None) -> dict[str, str]:
        """{part: folder} of rows written anew; rows of a null part are of part ``null``.

        Rows are dealt by part, and a part with much of the table is split over tasks again.
        A folder's name begins with a letter of its own, as an empty one would be null.
        """
        token = f"data/{uuid.uuid4().hex}"
        if part is None:
            out = df.withColumn(PART, F.lit("pall"))
        else:
            out = df.withColumn(PART, F.concat(F.lit("p"), F.coalesce(part.cast("string"), F.lit("null"))))
            out = self.spark.sql(f"SELECT /*+ REBALANCE({PART}) */ * FROM {{rows}}", rows=out)
        out.write.option("compression", "zstd").partitionBy(PART).parquet(f"{self.where}/{token}")
        return {_unescaped(n.split("=", 1)[1])[1:]: f"{token}/{n}" for n in names_of_parts(self.spark, f"{self.where}/{token}")}

    def replace(self, df: DataFrame, part: Column | None = None, properties: dict | None = None) -> int:
        """All rows anew; ``df`` may read the table itself. Returns the version."""
        before = self.entry()
        return self._commit(before, df.schema, self._write(df, part), properties or {})

    def rewrite(self, df: DataFrame, part: Column, parts: list[str], properties: dict | None = None, before: dict | None = None) -> int:
        """The rows of ``df`` in place of all rows of ``parts``; other parts stay where they lie.

        A part among ``parts`` without rows in ``df`` is gone. ``before`` is the entry that
        the rows were made from (default: the newest); a table without one is begun.
        """
        before = before or self.entry()
        made = self._write(df, part)
        strange = set(made) - set(parts)
        if strange:
            raise ValueError(f"rows of parts {sorted(strange)} that are not rewritten")
        kept = {p: f for p, f in (before["parts"] if before else {}).items() if p not in parts}
        schema = T.StructType.fromJson(before["schema"]) if before else df.schema
        if [(f.name, f.dataType) for f in schema] != [(f.name, f.dataType) for f in df.schema]:
            raise ValueError(f"columns {df.schema.simpleString()} are not those of the table, {schema.simpleString()}")
        return self._commit(before, schema, kept | made, properties if properties is not None else (before or {}).get("properties", {}))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete what the last ``keep`` versions don't name; returns the folders. No writer may be at work."""
        known = self.versions()
        fs, _ = file_system(self.spark, self.where)
        used = {f.split("/")[1] for v in known[-keep:] for f in self.entry(v)["parts"].values()}
        gone = [n for n in names(self.spark, f"{self.where}/data") if n not in used]
        for v in known[:-keep]:
            fs.delete(file_system(self.spark, f"{self.where}/versions/{v:012d}")[1], False)
        for n in gone:
            fs.delete(file_system(self.spark, f"{self.where}/data/{n}")[1], True)
        return gone


def names_of_parts(spark: SparkSession, where: str) -> list[str]:
    """Folders that a partitioned write made; their names begin with an underscore, as the column's does."""
    fs, path = file_system(spark, where)
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName().startswith(f"{PART}="))


def _unescaped(name: str) -> str:
    """A part as a partition folder's name spells it."""
    out, rest = "", name
    while "%" in rest:
        head, _, rest = rest.partition("%")
        out, rest = out + head + chr(int(rest[:2], 16)), rest[2:]
    return out + rest


def key_part(key: list[str], parts: int) -> Column:
    """The bucket of a key by its hash."""
    return F.pmod(F.xxhash64(*key), F.lit(parts)).cast("string")
