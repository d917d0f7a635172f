"""BI sink: the star schema loaded into a SQL database over JDBC, recounted
inside the database, and reconciled against what was written."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.jdbc import JdbcConfig, jdbc_query

log = logging.getLogger(__name__)

# Rows per insert batch and concurrent writers of the BI load.
BI_BATCH_SIZE = 5000
BI_WRITERS = 2


def load_table(df: DataFrame, cfg: JdbcConfig, table: str, *, batch_size: int = BI_BATCH_SIZE,
               num_partitions: int = BI_WRITERS, truncate: bool = False) -> None:
    """Overwrite ``table``: drop + create + insert by default (``truncate``
    keeps the table definition).  ``num_partitions`` caps the concurrent
    connections the database receives."""
    (df.write.format("jdbc").options(**cfg.options())
       .option("dbtable", cfg.qualified(table))
       .option("batchsize", str(batch_size))
       .option("numPartitions", str(num_partitions))
       .option("truncate", "true" if truncate else "false")
       .mode("overwrite").save())


def table_count(spark: SparkSession, cfg: JdbcConfig, table: str) -> int:
    """``COUNT(*)`` computed by the database (one row comes back; read by
    position, since some databases upper-case unquoted aliases)."""
    return int(jdbc_query(spark, cfg, f"SELECT COUNT(*) AS n FROM {cfg.qualified(table)}").first()[0])


class BIMismatch(RuntimeError):
    pass


def reconcile_counts(expected: dict[str, int], loaded: dict[str, int]) -> dict[str, tuple[int, int]]:
    """Tables whose database count differs from the stored count."""
    return {t: (expected[t], loaded.get(t, -1)) for t in expected if loaded.get(t) != expected[t]}


# Names beside a live table, of its successor and its predecessor.
NEW, OLD = "__new", "__old"


@contextmanager
def transaction(spark: SparkSession, cfg: JdbcConfig):
    """A connection from the driver whose statements are committed together, or
    rolled back when the block raises."""
    jvm = spark.sparkContext._jvm
    if cfg.driver:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(cfg.driver)
    properties = jvm.java.util.Properties()
    for key, value in cfg.options().items():
        if key not in ("url", "driver"):
            properties.setProperty(key, str(value))
    connection = jvm.java.sql.DriverManager.getConnection(cfg.url, properties)
    try:
        connection.setAutoCommit(False)
        yield connection
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def _execute(connection, sql: str) -> None:
    statement = connection.createStatement()
    try:
        statement.execute(sql)
    finally:
        statement.close()


def _present(connection, cfg: JdbcConfig) -> set[str]:
    """Lower-cased names of the tables in the configured (else the current) schema."""
    schema = cfg.schema or connection.getSchema()
    found, names = connection.getMetaData().getTables(None, None, None, None), set()
    while found.next():
        if schema is None or str(found.getString("TABLE_SCHEM")).lower() == str(schema).lower():
            names.add(found.getString("TABLE_NAME").lower())
    found.close()
    return names


def swap_in(spark: SparkSession, cfg: JdbcConfig, tables: Sequence[str]) -> None:
    """Put ``<table>__new`` in the place of each table, all in one transaction:
    readers see the old tables or the new ones.  The database must roll back
    renames (PostgreSQL and Derby do)."""
    with transaction(spark, cfg) as connection:
        present = _present(connection, cfg)
        for name in tables:
            if name.lower() in present:
                _execute(connection, cfg.rename_sql.format(old=cfg.qualified(name), new=name + OLD))
            _execute(connection, cfg.rename_sql.format(old=cfg.qualified(name + NEW), new=name))
            if name.lower() in present:
                _execute(connection, f"DROP TABLE {cfg.qualified(name + OLD)}")


def drop_new(spark: SparkSession, cfg: JdbcConfig, tables: Sequence[str]) -> None:
    """Drop what a failed load has left beside the live tables."""
    with transaction(spark, cfg) as connection:
        present = _present(connection, cfg)
        for name in tables:
            if (name + NEW).lower() in present:
                _execute(connection, f"DROP TABLE {cfg.qualified(name + NEW)}")


def load_star(spark: SparkSession, tables: dict[str, DataFrame], cfg: JdbcConfig,
              expected: dict[str, int], *, batch_size: int = BI_BATCH_SIZE,
              num_partitions: int = BI_WRITERS, staged: bool = True) -> dict:
    """Load dimensions first, then the fact, beside the live tables; recount
    each in the database, and swap all in at once (``swap_in``).  If any count
    differs, ``BIMismatch`` is raised and the live tables are as they were.  An
    empty table is loaded and reported with a warning, not an error.

    ``staged=False`` overwrites the live tables one by one, for databases that
    cannot rename in a transaction: readers then see dropped and half-filled
    tables, and a mismatch is found after the old rows are gone."""
    order = [t for t in tables if t.startswith("dim_")] + [t for t in tables if not t.startswith("dim_")]
    beside = NEW if staged else ""
    loaded = {}
    try:
        for name in order:
            if expected.get(name, 0) == 0:
                log.warning("table %s is empty", name)
            load_table(tables[name], cfg, name + beside, batch_size=batch_size, num_partitions=num_partitions)
            loaded[name] = table_count(spark, cfg, name + beside)
        bad = reconcile_counts(expected, loaded)
        if bad:
            raise BIMismatch(f"row counts differ (stored, database): {bad}")
        if staged:
            swap_in(spark, cfg, order)
    except Exception:
        if staged:
            drop_new(spark, cfg, order)
        raise
    return {"tables": loaded, "total_rows": sum(loaded.values())}
