"""Stored tables: overwrite with metrics taken from the write itself, publish
after the checks pass, read-back and commit-marker verification."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType
from pyspark.sql import functions as F

from tessera.schemas import SchemaMismatch, schema_problems
from tessera.session import checkpoint_dir

# Formats whose overwrite is one atomic commit to the table, and
# those that Spark writes as files with a ``_SUCCESS`` marker.  ``verify_commit``
# knows these; a table in any other format is refused before it is written.
TRANSACTIONAL = ("delta",)
FILE_FORMATS = ("parquet", "orc", "csv", "json", "avro")


class UnsupportedFormat(ValueError):
    pass


def check_format(table_format: str) -> str:
    """``table_format`` when its commits can be verified, else ``UnsupportedFormat``."""
    if table_format not in TRANSACTIONAL + FILE_FORMATS:
        raise UnsupportedFormat(f"{table_format}: commits of this format cannot be verified, "
                                f"use one of {', '.join(FILE_FORMATS + TRANSACTIONAL)}")
    return table_format


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def modification_times(spark: SparkSession, paths: Sequence[str]) -> list[int]:
    """Modification time of each path, in milliseconds."""
    out = []
    for path in paths:
        fs, p = _fs(spark, path)
        out.append(int(fs.getFileStatus(p).getModificationTime()))
    return out


def write_table(df: DataFrame, path: str, *, table_format: str = "parquet",
                replace_schema: bool = True, metrics: Sequence[Column] = ()) -> dict:
    """Overwrite the table at ``path`` and return metrics observed *during* the
    write: ``rows`` plus each aggregate in ``metrics`` (e.g. violation counts),
    and the ``schema`` written (for reading it back without inference).
    No second pass over the data is needed to know what was written.

    ``replace_schema=False`` refuses to overwrite a table whose stored schema
    differs (Delta does this itself; for Parquet the stored footer schema is
    compared first)."""
    spark = df.sparkSession
    if not replace_schema and path_exists(spark, path):
        stored = spark.read.format(table_format).load(path)
        problems = schema_problems(df, stored.schema)
        if problems:
            raise SchemaMismatch(f"{path}: " + "; ".join(problems))
    obs = Observation(f"write_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics)
    writer = observed.write.format(table_format).mode("overwrite")
    if table_format == "delta":
        writer = writer.option("overwriteSchema", "true" if replace_schema else "false")
    writer.save(path)
    out = {k: (int(v) if isinstance(v, int) else v) for k, v in obs.get.items()}
    out["schema"] = df.schema
    return out


def staging_path(path: str, run_id: str) -> str:
    return f"{path.rstrip('/')}.__staging_{run_id}"


def staging_format(table_format: str) -> str:
    """Format of a staged table: Parquet ahead of a transactional target."""
    return "parquet" if table_format in TRANSACTIONAL else table_format


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder; it goes with all in it
    when the session's file system closes."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    fs, p = _fs(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared checkpoint folder and read
    back: cuts the lineage, and later scans read the columns they need."""
    path = f"{scratch_path(df.sparkSession, name)}/data"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish(spark: SparkSession, staged: str, path: str, *, table_format: str = "parquet",
            schema: StructType | None = None, check: Callable[[str, str], object] | None = None) -> None:
    """Make a staged table the current one.  ``check(path, format)`` raises when
    a table is not as it should be; it sees the staged table first, then the
    published one.

    A transactional format gets one overwrite commit on the target: nothing is
    renamed or deleted, so readers see the old or the new version.  When the
    check of the target raises, the commit is made already, and the version
    before it is in the table's history.

    A folder of plain files is swapped by two renames, which suits file
    systems that rename without copying; between them there is no table for a
    moment.  The old table is kept until ``check`` has passed on the new one,
    and comes back when it fails.  On object stores use a transactional format,
    a catalog table (``switch_location``) or a pointer (``point_to``)."""
    check_format(table_format)
    if check:
        check(staged, staging_format(table_format))
    if table_format in TRANSACTIONAL:
        write_table(read_back(spark, staged, schema), path, table_format=table_format)
        if check:
            check(path, table_format)
        discard(spark, staged)
        return
    fs, target = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    src = jvm.org.apache.hadoop.fs.Path(staged)
    parent = target.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    old = None
    if fs.exists(target):
        old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.__old_{uuid.uuid4().hex[:8]}")
        if not fs.rename(target, old):
            raise OSError(f"could not move {path} aside")
    try:
        if not fs.rename(src, target):
            raise OSError(f"could not publish {staged} to {path}")
        if check:
            check(path, table_format)
    except Exception:
        if old is not None:
            fs.delete(target, True)
            fs.rename(old, target)
        raise
    if old is not None:
        fs.delete(old, True)


# Fixed value: the file that names the current run of a set of tables.
POINTER = "_current"


def point_to(spark: SparkSession, root: str, run: str) -> None:
    """Make ``run`` the current one of ``root``: the one-line pointer file is
    written beside its place and renamed over it, so that a reader sees the old
    name or the new one (on HDFS and local disks the rename is atomic)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, beside = _fs(spark, f"{root.rstrip('/')}/{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(beside)
    try:
        out.write(bytearray(run.encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    target = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{POINTER}")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(beside, target, how)


def pointed_to(spark: SparkSession, root: str) -> str | None:
    """The current run of ``root``, None before the first."""
    fs, p = _fs(spark, f"{root.rstrip('/')}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def folders(spark: SparkSession, root: str) -> list[tuple[str, float]]:
    """``(name, seconds since the last change)`` of each folder in ``root``, newest first."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    now = time.time()
    found = [(st.getPath().getName(), now - st.getModificationTime() / 1000)
             for st in fs.listStatus(p) if st.isDirectory()]
    return sorted(found, key=lambda f: f[1])


def location(spark: SparkSession, table: str) -> str:
    """Folder that catalog table ``table`` reads."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else ""


def bucket_count(spark: SparkSession, table: str) -> int | None:
    """Number of buckets of catalog table ``table``, None without buckets."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"]) if rows else None


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int, *,
                   table_format: str = "parquet", metrics: Sequence[Column] = ()) -> dict:
    """As ``write_table``, but a catalog table over ``path`` whose rows are
    bucketed and sorted by ``key``: grouping or joining it by the key needs no
    shuffle.

    Rows that a shuffle by ``key`` has just dealt to the session's number of
    partitions are in their buckets already, if there are as many; otherwise
    they are dealt once more, so that every bucket is one file."""
    spark = df.sparkSession
    if buckets != int(spark.conf.get("spark.sql.shuffle.partitions")):
        df = df.repartition(buckets, key)
    obs = Observation(f"write_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics)
    (observed.write.format(table_format).mode("overwrite").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return {**{k: (int(v) if isinstance(v, int) else v) for k, v in obs.get.items()}, "schema": df.schema}


def switch_location(spark: SparkSession, table: str, path: str, schema: StructType, *,
                    table_format: str = "parquet", like: str | None = None) -> None:
    """Point catalog table ``table`` (made on first use) to the folder ``path``:
    one metadata change, no file moves.  Folders of earlier runs stay, for
    queries still on them.  A new table is made like catalog table ``like``,
    buckets and all, where one is named."""
    escaped = path.replace("\\", "\\\\").replace("'", "\\'")
    if not spark.catalog.tableExists(table):
        if like:
            spark.sql(f"CREATE TABLE {table} LIKE {like} LOCATION '{escaped}'")
        else:
            spark.catalog.createTable(table, path=path, source=table_format, schema=schema)
        return
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{escaped}'")
    spark.catalog.refreshTable(table)


def discard(spark: SparkSession, staged: str) -> None:
    fs, p = _fs(spark, staged)
    if fs.exists(p):
        fs.delete(p, True)


class VerificationError(RuntimeError):
    pass


def read_back(spark: SparkSession, path: str, schema: StructType | None = None, *,
              table_format: str = "parquet") -> DataFrame:
    """A table this run has just written.  Passing the schema it was written
    with skips schema inference (a footer-reading job per read)."""
    reader = spark.read.format(table_format)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def verify_table(spark: SparkSession, path: str, expected_rows: int, *,
                 table_format: str = "parquet", schema: StructType | None = None) -> int:
    """Re-read the stored table; its row count must equal ``expected_rows``."""
    got = read_back(spark, path, schema, table_format=table_format).count()
    if got != expected_rows:
        raise VerificationError(f"{path}: {got} rows stored, {expected_rows} written")
    return got


def verify_commit(spark: SparkSession, path: str, *, table_format: str = "parquet") -> bool:
    """The table's commit marker must exist: ``_delta_log`` with at least one
    ``.json`` commit for Delta, ``_SUCCESS`` for Parquet/ORC/CSV."""
    fs, _ = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    if table_format == "delta":
        log = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_delta_log")
        if not fs.exists(log):
            raise VerificationError(f"{path}: no _delta_log")
        commits = [s for s in fs.listStatus(log) if s.getPath().getName().endswith(".json")]
        if not commits:
            raise VerificationError(f"{path}: _delta_log holds no commit")
        return True
    marker = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    if not fs.exists(marker):
        raise VerificationError(f"{path}: no _SUCCESS marker")
    return True


def describe_table(df: DataFrame) -> DataFrame:
    """``(column_name, data_type, nullable)`` of a table: schema only, no job."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string, nullable boolean")
