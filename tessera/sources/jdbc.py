"""JDBC sources: partitioned table extract and pushed-down SQL."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# The nine source columns the raw layer is extracted from.
SOURCE_COLUMNS = ("id", "sale_date", "product_id", "product_name", "customer_id", "region",
                  "quantity", "unit_price", "created_at")

# Parallel cursors by default: what a small source database bears.
SOURCE_READERS = 8


@dataclass
class JdbcConfig:
    """Connection settings.  Secrets come from the caller (options or the
    environment), are passed to the driver as properties, and never printed."""
    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    schema: str | None = None          # table prefix, e.g. ``public``
    probe_sql: str = "SELECT 1 AS ok"  # Derby: ``SELECT 1 AS ok FROM SYSIBM.SYSDUMMY1``
    rename_sql: str = "ALTER TABLE {old} RENAME TO {new}"   # Derby: ``RENAME TABLE {old} TO {new}``
    properties: dict = field(default_factory=dict, repr=False)

    def options(self) -> dict:
        opts = {"url": self.url, **self.properties}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        if self.driver:
            opts["driver"] = self.driver
        return opts

    def qualified(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema else table


def jdbc_query(spark: SparkSession, cfg: JdbcConfig, sql: str) -> DataFrame:
    """Run ``sql`` inside the database and read its result (aggregates,
    probes and filters execute there; only the result crosses the wire)."""
    return spark.read.format("jdbc").options(**cfg.options()).option("query", sql).load()


def probe(spark: SparkSession, cfg: JdbcConfig) -> bool:
    """Fail fast if the database is unreachable (``SELECT 1``-style query)."""
    return jdbc_query(spark, cfg, cfg.probe_sql).first() is not None


# Fixed value: bins of one histogram query on the partition column.
HISTOGRAM_BINS = 1024


def _histogram(spark: SparkSession, cfg: JdbcConfig, name: str, column: str, low: int, high: int) -> list[tuple]:
    """``(first, last, rows)`` of the non-empty bins of equal width in
    ``[low, high]``, counted by the database (integer division of BIGINTs)."""
    width = -(-(high - low + 1) // HISTOGRAM_BINS)
    rows = jdbc_query(spark, cfg, f"SELECT b, COUNT(*) AS n FROM (SELECT (CAST({column} AS BIGINT) - ({low})) / {width} "
                                  f"AS b FROM {name} WHERE {column} BETWEEN {low} AND {high}) x GROUP BY b").collect()
    found = sorted((int(b), int(n)) for b, n in rows)
    return [(low + b * width, min(high, low + (b + 1) * width - 1), n) for b, n in found]


def measured_ranges(spark: SparkSession, cfg: JdbcConfig, table: str, column: str, low: int, high: int,
                    parts: int) -> list[int]:
    """Ends of ranges of ``column`` that hold about equal numbers of rows.

    The database counts bins of equal width; bins with more than a part's share
    are counted again in smaller ones (at most seven times for any 64-bit
    range).  Bins are then joined in order until they reach the share, so no
    range holds twice of it, unless one single value does."""
    name = cfg.qualified(table)
    # A difference of two values has to be a BIGINT too.
    spans = [(low, high)] if high - low < 1 << 63 else [(low, -1), (0, high)]
    bins = [b for first, last in spans for b in _histogram(spark, cfg, name, column, first, last)]
    share = sum(n for *_, n in bins) / parts
    while any(n > share and last > first for first, last, n in bins):
        bins = [small for first, last, n in bins for small in (
            _histogram(spark, cfg, name, column, first, last) if n > share and last > first else [(first, last, n)])]
    ends, held = [], 0
    for first, last, n in bins:
        # A bin that would take the range to twice the share begins the next one.
        if held and held + n >= 2 * share:
            ends.append(first - 1)
            held = 0
        held += n
        if held >= share:
            ends.append(last)
            held = 0
    return ends if held else ends[:-1]


def extract_source(spark: SparkSession, cfg: JdbcConfig, table: str, *,
                   columns: Sequence[str] = SOURCE_COLUMNS, partition_column: str = "id",
                   num_partitions: int = SOURCE_READERS, fetch_size: int = 10_000, quote: str = "",
                   measured: bool = True) -> DataFrame:
    """Full snapshot of ``table`` read by ``num_partitions`` parallel cursors.

    The id range comes from one pushed-down ``min/max`` query.  Integer ids are
    read in ranges that the database has counted (``measured_ranges``), so a
    gap or a cluster of ids gives no reader twice its share; with
    ``measured=False``, or for other types, the range is split into equal
    strides.  Rows outside the bounds, and without an id, land in the first or
    last range, so nothing is lost.  ``quote`` wraps column names for databases
    that keep their case (``'"'``)."""
    name = cfg.qualified(table)
    q = lambda c: f"{quote}{c}{quote}"
    key = q(partition_column)
    bounds = jdbc_query(spark, cfg, f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {name}").first()
    source = f"(SELECT {', '.join(q(c) for c in columns)} FROM {name}) src"
    lo, hi = (bounds[0], bounds[1]) if bounds is not None else (None, None)
    spread = lo is not None and hi is not None and hi > lo and num_partitions > 1
    if spread and measured and isinstance(lo, int):
        ends = measured_ranges(spark, cfg, table, key, lo, hi, num_partitions)
        if ends:
            wheres = [f"{key} <= {ends[0]} OR {key} IS NULL"]
            wheres += [f"{key} > {a} AND {key} <= {b}" for a, b in zip(ends, ends[1:])]
            wheres += [f"{key} > {ends[-1]}"]
            options = {k: v for k, v in cfg.options().items() if k != "url"}
            return spark.read.jdbc(cfg.url, source, predicates=wheres,
                                   properties={**options, "fetchsize": str(fetch_size)})
    reader = (spark.read.format("jdbc").options(**cfg.options()).option("dbtable", source)
              .option("fetchsize", str(fetch_size)))
    if spread:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lo)).option("upperBound", str(hi + 1))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()


# Prefixes of the environment variables describing the source
# and the BI databases (``<PREFIX>_HOST``, ``_PORT``, ``_NAME``, ``_USER``, ``_PASSWORD``).
SOURCE_ENV_PREFIX = "SOURCE_DB"
BI_ENV_PREFIX = "BI_DB"


def postgres_from_env(env=None, *, prefix: str = BI_ENV_PREFIX, schema: str | None = "public") -> JdbcConfig:
    """PostgreSQL connection from ``<prefix>_*`` variables (port defaults to
    5432); every missing variable is named in one error, no value is shown."""
    import os

    env = os.environ if env is None else env
    names = {k: f"{prefix}_{k}" for k in ("HOST", "PORT", "NAME", "USER", "PASSWORD")}
    missing = [v for k, v in names.items() if k != "PORT" and not env.get(v)]
    if missing:
        raise ValueError(f"missing environment variables: {', '.join(missing)}")
    url = f"jdbc:postgresql://{env[names['HOST']]}:{env.get(names['PORT']) or '5432'}/{env[names['NAME']]}"
    return JdbcConfig(url=url, user=env[names["USER"]], password=env[names["PASSWORD"]],
                      driver="org.postgresql.Driver", schema=schema)
