"""Reading, normalizing and writing tables."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from resultlake.operators.sets import union_relaxed
from resultlake.operators.shape import checkpointed
from resultlake.sources.versions import PartedTable, file_system, key_part


def exists(spark: SparkSession, where: str) -> bool:
    fs, path = file_system(spark, where)
    return fs.exists(path)


def read_table(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A Parquet table; only the named columns are read."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def normalize_documents(df: DataFrame, column: str, schema: str | T.DataType | None, paths: dict[str, list[str]], keys: dict[str, str], carry: list[str] = ()) -> dict[str, DataFrame]:
    """Nested JSON documents as one table for each entity, all values text, with parents' keys.

    ``paths`` gives for each table the fields of arrays that lead to it; ``keys`` gives for
    each table the name under which its ``id`` goes to the tables below. Without a schema
    the column is parsed already; ``carry``: columns of the document that go with its rows.
    """
    root = df.select(*carry, (F.from_json(column, schema) if schema else F.col(column)).alias("__v"))
    out = {}
    for table, path in paths.items():
        now, kept = root, list(carry)
        walked: list[str] = []
        for step in path:
            parent = next((t for t, p in paths.items() if p == walked), None)
            if parent in keys:
                now = now.withColumn(keys[parent], F.col("__v.id").cast("string"))
                kept.append(keys[parent])
            now = now.select(*kept, F.explode(F.col(f"__v.{step}")).alias("__v"))
            walked = [*walked, step]
        kind = now.schema["__v"].dataType
        scalars = [f.name for f in kind.fields if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
        out[table] = now.select(*kept, *[F.col(f"__v.{s}").cast("string").alias(s) for s in scalars])
    return out


def doc_members(df: DataFrame, keys: list[str], column: str, path: list[str], members: list[str], parents: dict[str, str] | None = None) -> DataFrame:
    """Distinct nested members of documents, along arrays of structs, with attributes of what is above them.

    ``parents``: {new column: field of the last array's parent}.
    """
    now = df.select(*keys, F.explode(F.col(f"{column}.{path[0]}")).alias("__v"))
    held: list[str] = []
    for i, step in enumerate(path[1:], 1):
        if i == len(path) - 1 and parents:
            now = now.withColumns({n: F.col(f"__v.{f}") for n, f in parents.items()})
            held = list(parents)
        now = now.select(*keys, *held, F.explode(F.col(f"__v.{step}")).alias("__v"))
    return now.select(*keys, *held, *[F.col(f"__v.{m}").alias(m) for m in members]).dropDuplicates()


#: Files that changed since the last run up to which they are named to the reader; more are read with their folder.
FEW_FILES = 10_000


def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size, time) of the files of a folder and those below it; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("time"))


def sync_documents(spark: SparkSession, folder: str, cache: str, schema: str | T.StructType, buckets: int = 64) -> DataFrame:
    """Parsed JSON documents of a folder, one a file, from a cache that is brought up to date.

    Returns (path, size, time, run, doc): ``doc`` is the document as ``schema`` says, null
    where the file is none, and ``run`` the number of the run that parsed it. A file is
    parsed again only if its size or time has changed; files that are gone are dropped.
    The cache is in buckets of the path, and only those with a change are written again.
    """
    table = PartedTable(spark, cache)
    entry = table.entry()
    buckets = entry["properties"]["buckets"] if entry else buckets
    run = entry["properties"]["run"] + 1 if entry else 1
    now = listed_files(spark, folder)
    kind = T.StructType.fromJson(json.loads(spark.createDataFrame([], schema).schema.json())) if isinstance(schema, str) else schema
    if entry:
        old = table._rows(entry)
        known = old.select(*[F.col(c).alias(f"__{c}") for c in ("path", "size", "time")])
        both = now.join(known, F.col("path") == F.col("__path"), "full_outer")
        same = (F.col("size") == F.col("__size")) & (F.col("time") == F.col("__time"))
        moved = both.filter(~F.coalesce(same, F.lit(False))).select(F.col("path").isNotNull().alias("there"), F.coalesce("path", "__path").alias("path"))
        moved = checkpointed(moved)
        touched = [r[0] for r in moved.select(key_part(["path"], buckets)).distinct().collect()]  # ``buckets`` at most
        if not touched:
            return old
        new = moved.filter("there").select("path")
        some = [r["path"] for r in new.limit(FEW_FILES + 1).collect()]
        text = _whole_texts(spark, some) if len(some) <= FEW_FILES else _whole_texts(spark, [folder]).join(new, "path", "left_semi")
        stay = table._rows(entry, touched).join(moved.select("path"), "path", "left_anti")
    else:
        touched = [str(i) for i in range(buckets)]
        text, stay = _whole_texts(spark, [folder]), None
    doc = F.from_json(F.decode("content", "UTF-8"), kind).alias("doc")
    parsed = text.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("time"), F.lit(run).alias("run"), doc)
    rows = parsed if stay is None else stay.unionByName(parsed)
    table.rewrite(rows, key_part(["path"], buckets), touched, {"buckets": buckets, "run": run}, entry)
    return table.read()


def _whole_texts(spark: SparkSession, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)


def file_schemas(spark: SparkSession, paths: list[str], per_task: int = 64) -> DataFrame:
    """(path, schema) of Parquet files as Spark's JSON, read from their footers in tasks."""

    def footers(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            found = [_footer(p) for p in b.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(found, pa.string())], ["path", "schema"])

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, -(-len(paths) // per_task)))
    return listed.mapInArrow(footers, "path string, schema string")


def _footer(path: str) -> str:
    """The schema of a Parquet file, or of the first file of a folder, in Spark's JSON."""
    fs, inside = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    if fs.get_file_info(inside).type == pafs.FileType.Directory:
        inside = min(f.path for f in fs.get_file_info(pafs.FileSelector(inside, recursive=True)) if f.type == pafs.FileType.File and not f.base_name.startswith(("_", ".")))
    schema = pq.read_schema(inside, filesystem=fs)
    own = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    return own.decode() if own else from_arrow_schema(schema).json()


def scan_evolving(spark: SparkSession, paths: list[str], columns: list[str] | None = None, text_ids: list[str] = ()) -> DataFrame:
    """Files of different schemas as one table: absent columns are null, ids are text.

    Footers are read in tasks, and files of one schema are one scan with that schema, so
    Spark reads none of them again to plan. A store that only Spark's readers reach
    (``viewfs``, say) has its footers read by those, a file at a time.
    """
    try:
        pafs.FileSystem.from_uri(paths[0]) if "://" in paths[0] else None
        groups = {r["schema"]: r["paths"] for r in file_schemas(spark, paths).groupBy("schema").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()}  # the paths given
    except pa.ArrowInvalid:  # no such store for pyarrow
        groups = {}
        for p in paths:
            groups.setdefault(spark.read.parquet(p).schema.json(), []).append(p)
    parts = []
    for schema, same in sorted(groups.items()):
        df = spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*same)
        if columns:
            df = df.select(*[c for c in columns if c in df.columns])
        parts.append(df.withColumns({c: F.col(c).cast("string") for c in text_ids if c in df.columns}))
    out = union_relaxed(parts)
    return out.select(*[c for c in columns if c in out.columns]) if columns else out


def write_bucketed(df: DataFrame, table: str, where: str, keys: list[str], buckets: int) -> None:
    """Write a table dealt and sorted by keys into buckets, under a name of the session's catalog.

    Joins and aggregations by the keys with tables of as many buckets move no rows.
    """
    first, *rest = keys
    df.repartition(buckets, *keys).write.mode("overwrite").option("path", where).bucketBy(buckets, first, *rest).sortBy(first, *rest).saveAsTable(table)


def resolve_source(spark: SparkSession, folder: str, manifest: DataFrame) -> list[str]:
    """Paths of shards, checked against the manifest's ``path``: missing and unlisted files are errors."""
    fs, path = file_system(spark, folder)
    there = {s.getPath().getName() for s in fs.listStatus(path) if not s.getPath().getName().startswith(("_", "."))}
    listed = {r["path"] for r in manifest.select("path").distinct().collect()}  # one for each file
    if there != listed:
        raise ValueError(f"missing {sorted(listed - there)}, unlisted {sorted(there - listed)}")
    return [f"{folder}/{p}" for p in sorted(listed)]


def write_table(df: DataFrame, where: str, rows_per_file: int = 5_000_000, mode: str = "error") -> None:
    """Write Parquet with zstd and a bounded number of rows for each file."""
    df.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(where)


def window_column(date: str, unit: str = "month") -> Column:
    """The start of the month or year of a date; null dates are of the window ``unknown``."""
    return F.coalesce(F.date_format(F.trunc(F.col(date).cast("date"), unit), "yyyy-MM-dd"), F.lit("unknown"))


def write_windows(df: DataFrame, where: str, date: str, unit: str = "month", mode: str = "error") -> None:
    """Write a table partitioned by time windows (S09); readers that filter by ``window`` read only those."""
    out = df.withColumn("window", window_column(date, unit))
    # rows are dealt by window, and a window that holds much of the table is split over tasks again
    out = df.sparkSession.sql("SELECT /*+ REBALANCE(window) */ * FROM {rows}", rows=out)
    out.write.mode(mode).option("compression", "zstd").partitionBy("window").parquet(where)


def write_manifest(spark: SparkSession, table: str, where: str, date: str) -> DataFrame:
    """Rows and last date of each written window, itself a table."""
    df = spark.read.parquet(table)
    found = df.groupBy(F.col("window").cast("string").alias("window")).agg(F.count("*").alias("rows"), F.max(F.col(date).cast("date")).alias("last_date"))
    found.write.mode("overwrite").parquet(where)
    return spark.read.parquet(where)


def replace_table(df: DataFrame, where: str) -> int:
    """Replace a table that ``df`` itself may read, at one moment (S11); returns its version.

    The rows are written beside and then named by the table's next version
    (:class:`~resultlake.sources.versions.PartedTable`). Readers (:func:`current_table`)
    resolve the newest version, so there is always a table, old or new.
    """
    return PartedTable(df.sparkSession, where).replace(df)


def current_table(spark: SparkSession, where: str) -> DataFrame | None:
    """What :func:`replace_table` wrote last (S11); None before."""
    return PartedTable(spark, where).read()


def merge_windows(spark: SparkSession, paths: list[str], where: str, order: list[str]) -> None:
    """Window shards as one table in an order."""
    scan_evolving(spark, paths).repartitionByRange(*order).sortWithinPartitions(*order).write.option("compression", "zstd").parquet(where)


def attach_global_columns(df: DataFrame, key: str, measures: dict[str, Column]) -> DataFrame:
    """Columns that are computed over all blocks, on every row: one aggregation joined back."""
    return df.join(df.groupBy(key).agg(*[c.alias(n) for n, c in measures.items()]), key, "left")


def write_variants(df: DataFrame, where: str, key: list[str], n: int, exclude: list[str], seed: int = 0) -> None:
    """The full table, a seeded sample of ``n`` rows, and the table without some columns."""
    from resultlake.operators.pick import sample_n
    from resultlake.operators.shape import drop_matching

    write_table(df, f"{where}/full")
    write_table(sample_n(df, key, n, seed), f"{where}/sample")
    write_table(drop_matching(df, exclude), f"{where}/narrow")


def html_links(df: DataFrame, keys: list[str], html: str, pattern: str = r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']""") -> DataFrame:
    """One row for each link of a page, by an expression whose first group is the target."""
    found = F.regexp_extract_all(F.col(html), F.lit(pattern), 1)
    return df.select(*keys, F.posexplode(found).alias("position", "href"))


def html_rows(df: DataFrame, keys: list[str], html: str) -> DataFrame:
    """Cells of table rows, without markup."""
    rows = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)
    cells = F.transform(F.regexp_extract_all(F.col("__row"), F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), 1), lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), r"\s+", " ")))
    return df.select(*keys, F.posexplode(rows).alias("row", "__row")).select(*keys, "row", cells.alias("cells"))


def html_json_var(df: DataFrame, html: str, name: str, schema: str) -> Column:
    """A JSON value that a script of the page assigns to a variable."""
    text = F.regexp_extract(F.col(html), rf"(?s)\b{name}\s*=\s*(\[.*?\]|\{{.*?\}})\s*;", 1)
    return F.when(text != "", F.from_json(text, schema))


def max_page(html: str) -> Column:
    """The largest ``data-page`` number of a page, 1 without one."""
    found = F.transform(F.regexp_extract_all(F.col(html), F.lit(r'data-page\s*=\s*"?(\d+)'), 1), lambda t: t.try_cast("int"))
    return F.coalesce(F.array_max(found), F.lit(1))


def expand_ids(df: DataFrame, key: str, n: str) -> DataFrame:
    """``id-1`` to ``id-n`` for each parent, each once."""
    some = df.filter(F.col(n) >= 1).select(F.col(key).cast("string").alias("__id"), F.explode(F.sequence(F.lit(1), F.col(n).cast("int"))).alias("__i"))
    return some.select(F.concat_ws("-", "__id", "__i").alias("child_id")).distinct()
