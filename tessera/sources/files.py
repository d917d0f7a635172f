"""File sources of the raw layer: CSV drops and the newest-drop lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.schemas import SALES_SCHEMA

# The drop layout, ``<root>/ingestion_date=YYYY-MM-DD/sales_YYYYMMDD_HHMMSS.csv``
DROP_PARTITION = "ingestion_date"
DROP_PREFIX = "sales_"
DROP_SUFFIX = ".csv"
#: The files of drops, plain and compressed.
DROP_FILES = f"*{{{DROP_SUFFIX},{DROP_SUFFIX}.gz}}"
#: Column of the unparsable record, where it is asked for.
CORRUPT = "_corrupt"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


class NoDropFound(FileNotFoundError):
    pass


class IncompleteDrop(RuntimeError):
    """The newest drop is still being written (a folder without ``_SUCCESS``)."""


def csv_options(*, multiline: bool = True, enforce_header: bool = False) -> dict:
    """Reader options that read what a standard CSV writer produces.

    ``escape='"'`` reads doubled quotes inside a quoted field; ``multiLine``
    also keeps embedded newlines in one field (each drop file then goes to one
    task, which is why drops are written as many part files; ``multiline=False``
    gives split reads of files known to have no embedded newline).  ``enforceSchema=false`` makes Spark compare
    the header to the schema instead of silently matching by position."""
    opts = {"header": "true", "mode": "PERMISSIVE", "timestampFormat": TIMESTAMP_FORMAT,
            "timestampNTZFormat": TIMESTAMP_FORMAT, "quote": '"', "escape": '"'}
    if multiline:
        opts["multiLine"] = "true"
    if enforce_header:
        opts["enforceSchema"] = "false"
    return opts


def read_bronze(spark: SparkSession, path: str | list[str], schema: StructType | None = SALES_SCHEMA,
                **options) -> DataFrame:
    """Typed CSV scan of a drop (file, folder, or list of them).

    With a ``schema`` (the default) types are fixed and ``PERMISSIVE`` turns an
    unparsable field into NULL while keeping the rest of the row; with
    ``schema=None`` the types are inferred, at the cost of one extra pass."""
    opts = {**csv_options(**{k: options.pop(k) for k in ("multiline", "enforce_header")
                             if k in options}), **options}
    reader = spark.read.options(**opts)
    if schema is None:
        reader = reader.option("inferSchema", "true")
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_with_corrupt(spark: SparkSession, path: str | list[str], schema: StructType = SALES_SCHEMA,
                      **options) -> DataFrame:
    """``read_bronze`` with one column more, ``CORRUPT``: the whole record of a
    row in which a field could not be parsed, or that has too few or too many
    fields; NULL for sound rows."""
    return read_bronze(spark, path, schema=StructType([*schema.fields, StructField(CORRUPT, StringType(), True)]),
                       columnNameOfCorruptRecord=CORRUPT, **options)


def with_reasons(rows: DataFrame, schema: StructType = SALES_SCHEMA) -> DataFrame:
    """Rows of ``read_with_corrupt`` whose record is corrupt, with ``reasons``:
    ``bad_<column>`` for each field that holds text but no value of its type,
    ``extra_fields`` for a record longer than the schema, and ``short_row`` for
    one that is corrupt for neither."""
    fields = ", ".join(f"`f{i}` string" for i in range(len(schema.fields) + 1))
    same = {k: v for k, v in csv_options().items() if k in ("quote", "escape", "mode")}
    raw = F.from_csv(CORRUPT, F.lit(fields), same)
    bad = [F.when(F.col(f.name).isNull() & (F.trim(F.col("_raw")[f"f{i}"]) != ""), F.lit(f"bad_{f.name}"))
           for i, f in enumerate(schema.fields)]
    extra = F.when(F.col("_raw")[f"f{len(schema.fields)}"].isNotNull(), F.lit("extra_fields"))
    found = F.array_compact(F.array(*bad, extra))
    return (rows.where(F.col(CORRUPT).isNotNull()).withColumn("_raw", raw)
            .withColumn("reasons", F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("short_row")))).drop("_raw"))


def list_drops(spark: SparkSession, root: str, date: str = "*") -> DataFrame:
    """``(path, modificationTime, length)`` of every drop file under ``root``,
    or of one ``date`` folder.

    Uses the ``binaryFile`` source only for its listing: the ``content``
    column is never selected, so no file is read."""
    pattern = f"{root.rstrip('/')}/{DROP_PARTITION}={date}/{DROP_PREFIX}*"
    return (spark.read.format("binaryFile").option("pathGlobFilter", DROP_FILES)
                 .load(pattern).select("path", "modificationTime", "length"))


def _newest(spark: SparkSession, root: str, date: str = "*"):
    try:
        files = list_drops(spark, root, date)
        return files.orderBy(F.col("modificationTime").desc(), F.col("path")).select("path").first()
    except Exception as exc:  # the glob matched nothing at all
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return None
        raise


def latest_drop(spark: SparkSession, root: str, *, require_complete: bool = True, by_date: bool = False) -> str:
    """Path of the newest drop (latest modification time; ties → smallest
    path).  A drop written by Spark is a folder of part files: the newest part
    names the folder that is returned, and with ``require_complete`` a folder
    without its ``_SUCCESS`` marker (still being committed) raises
    ``IncompleteDrop`` rather than being read half-written.

    Every drop file of the history is listed, unless ``by_date`` says that drops
    are never back-dated: then date folders are walked from the newest to the
    first that holds a drop, and no older one is listed."""
    days = reversed(drop_dates(spark, root)) if by_date else ["*"]
    newest = next((found for day in days if (found := _newest(spark, root, day)) is not None), None)
    if newest is None:
        raise NoDropFound(f"no drop under {root}")
    path = newest["path"]
    parent = path.rsplit("/", 1)[0]
    # A run folder of part files (``sales_<stamp>.csv/part-*.csv``) is one drop.
    if not parent.rsplit("/", 1)[-1].startswith(DROP_PREFIX):
        return path
    if require_complete:
        jvm = spark.sparkContext._jvm
        marker = jvm.org.apache.hadoop.fs.Path(f"{parent}/_SUCCESS")
        if not marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker):
            raise IncompleteDrop(f"{parent} has no _SUCCESS marker yet")
    return parent


def drop_dates(spark: SparkSession, root: str) -> list[str]:
    """The ``ingestion_date`` folder values under ``root`` (names only: one
    directory listing, no file is opened)."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    prefix = f"{DROP_PARTITION}="
    return sorted(st.getPath().getName()[len(prefix):] for st in fs.listStatus(base)
                  if st.isDirectory() and st.getPath().getName().startswith(prefix))


def read_drops(spark: SparkSession, root: str, *, schema: StructType | None = SALES_SCHEMA,
               since: str | None = None, until: str | None = None, **options) -> DataFrame:
    """Every drop under ``root`` whose ``ingestion_date`` lies in
    ``[since, until]``, with that date as a column.  Only the selected date
    folders are listed and read (pruning by folder, before any file is
    opened); the date itself comes from each row's file path."""
    dates = [d for d in drop_dates(spark, root)
             if (since is None or d >= since) and (until is None or d <= until)]
    if not dates:
        raise NoDropFound(f"no drop under {root} in [{since}, {until}]")
    paths = [f"{root.rstrip('/')}/{DROP_PARTITION}={d}" for d in dates]
    df = read_bronze(spark, paths, schema=schema, recursiveFileLookup="true",
                     pathGlobFilter=DROP_FILES, **options)
    date = F.regexp_extract(F.col("_metadata.file_path"), rf"{DROP_PARTITION}=([0-9-]+)", 1)
    return df.withColumn(DROP_PARTITION, date.cast("date"))


def drops(spark: SparkSession, root: str) -> list[tuple[str, str, bool]]:
    """``(name, path, complete)`` of every drop, oldest first by name (names
    carry the UTC time of the drop) -- a report; the newest drop is what
    ``latest_drop`` says.  A single file is complete (it appears
    at once); a folder of part files is complete once ``_SUCCESS`` exists.
    Metadata only: one listing per date folder, no file is opened."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for day in drop_dates(spark, root):
        folder = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{DROP_PARTITION}={day}")
        for st in fs.listStatus(folder):
            name = st.getPath().getName()
            if not name.startswith(DROP_PREFIX):
                continue
            path = st.getPath().toString()
            done = (not st.isDirectory()) or fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"))
            out.append((name, path, bool(done)))
    return sorted(out)
