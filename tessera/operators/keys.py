"""Dense surrogate keys (1..N in natural-key order) without a one-task window.

``row_number() OVER (ORDER BY k)`` has no PARTITION BY, so Spark moves every
row into a single partition.  Here the distinct keys are range-partitioned
(Spark samples the bounds), sorted inside each partition, and numbered with
``monotonically_increasing_id`` (partition id in the upper 31 bits, position in
the lower 33).  The per-partition sizes form a table with one row per range
partition -- at most the shuffle partition count, not a number that grows
with the data -- whose running sum gives each partition's offset.

The numbered keys are checkpointed into the cluster's checkpoint folder before
the offsets are taken, so a recomputed task can never renumber a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def checked_int(value: Column, name: str) -> Column:
    """``value`` as an int; above 2^31 - 1 the query fails, with ANSI off too,
    where a cast would wrap to another, negative key."""
    fits = value.isNull() | value.between(-(1 << 31), (1 << 31) - 1)
    return F.when(fits, value.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit(f"{name} does not fit an int: "), value.cast("string"))).cast("int"))


def dense_key(df: DataFrame, key: str, out: str, *, partitions: int | None = None,
              checkpoint: bool = True) -> DataFrame:
    """Add ``out`` = rank of ``key`` among the distinct keys (1-based, int; more
    than 2^31 - 1 of them raise an error).

    ``df`` must hold each key once (a dimension base); its other columns are
    carried along.  Order is ascending with NULL first, as ``ORDER BY key``.

    Without ``partitions`` the range shuffle uses the session's partition count
    and AQE may merge small neighbouring partitions (a six-row dimension ends
    up in one task, not thousands); merged partitions are contiguous ranges,
    so the numbering stays in key order.  ``partitions`` fixes the count.
    """
    order = F.col(key).asc_nulls_first()
    ranged = (df.repartitionByRange(int(partitions), order) if partitions
              else df.repartitionByRange(order))
    numbered = (ranged.sortWithinPartitions(order)
                  .withColumn("_mid", F.monotonically_increasing_id()))
    if checkpoint:
        checkpoint_dir(df.sparkSession)
        numbered = numbered.checkpoint(eager=True)
    numbered = numbered.withColumns({
        "_part": F.shiftright(F.col("_mid"), _POS_BITS).cast("int"),
        "_pos": F.col("_mid").bitwiseAND(F.lit(_POS_MASK)),
    })
    # One row per range partition (at most the shuffle partition count, not a
    # quantity that grows with the data), so broadcasting it is safe.
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    cols = [c for c in df.columns]
    return (numbered.join(F.broadcast(offsets), "_part")
                    .select(*cols, checked_int(F.col("_offset") + F.col("_pos") + 1, out).alias(out)))


def dense_key_single_task(df: DataFrame, key: str, out: str) -> DataFrame:
    """The textbook form, one global window: fine for a few thousand keys, kept
    as the reference form the tests compare against."""
    return df.withColumn(out, F.row_number().over(Window.orderBy(F.col(key).asc_nulls_first()))
                         .cast("int"))
