"""Raw-layer sink: timestamped CSV drops."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.sources.files import DROP_PARTITION, DROP_PREFIX, DROP_SUFFIX, TIMESTAMP_FORMAT


class EmptySource(RuntimeError):
    pass


def drop_path(root: str, now: datetime | None = None) -> str:
    """``<root>/ingestion_date=YYYY-MM-DD/sales_YYYYMMDD_HHMMSS.csv`` (UTC clock)."""
    now = now or datetime.now(timezone.utc)
    return (f"{root.rstrip('/')}/{DROP_PARTITION}={now:%Y-%m-%d}/"
            f"{DROP_PREFIX}{now:%Y%m%d_%H%M%S}{DROP_SUFFIX}")


# Rows per CSV part file: a drop is read with ``multiLine`` (one task per
# file), so this bounds the work of one task -- about 100-200 MB of CSV.
DEFAULT_ROWS_PER_FILE = 1_000_000


def write_drop(df: DataFrame, root: str, *, now: datetime | None = None,
               allow_empty: bool = False, min_files: int | None = None,
               max_rows_per_file: int = DEFAULT_ROWS_PER_FILE, compression: str | None = None) -> str:
    """Write ``df`` as one drop and return its path.

    The drop is a folder of CSV part files written by the executors in
    parallel (one file per partition), with a header line, UTF-8, and quoting
    that round-trips commas, quotes and newlines.  Values keep their leading
    and trailing spaces (the raw layer must not be cleaned on the way in).
    Drops are read with ``multiLine``, one task per file, so the file layout
    is the read parallelism of the next job: ``min_files`` spreads a source
    that comes in few partitions over so many (by default it is written as it
    comes, without a shuffle), and no file holds more than ``max_rows_per_file`` rows, so the number of
    files grows with the data and no reading task grows with it.
    ``compression="gzip"`` writes the same text in about a quarter of the bytes;
    such files cannot be split between tasks, as plain ones without line breaks
    in fields can (``multiline=False``).
    The row count is observed during the write (the source is read once --
    a JDBC source is not queried twice); an empty source raises
    ``EmptySource`` and its empty drop folder is removed, so no run sees it."""
    path = drop_path(root, now)
    seen = Observation()
    out = (df.repartition(min_files) if min_files else df).observe(seen, F.count(F.lit(1)).alias("rows"))
    (out.write.mode("errorifexists").option("maxRecordsPerFile", str(max_rows_per_file))
       .option("compression", compression or "none")
       .option("header", "true").option("encoding", "UTF-8")
       .option("quote", '"').option("escape", '"').option("quoteAll", "false")
       .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
       .option("timestampFormat", TIMESTAMP_FORMAT).option("timestampNTZFormat", TIMESTAMP_FORMAT)
       .csv(path))
    if not allow_empty and seen.get["rows"] == 0:
        from tessera.sinks.tables import discard
        discard(df.sparkSession, path)
        raise EmptySource("source returned no rows; nothing written")
    return path
