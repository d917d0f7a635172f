"""Data-quality checks as operators.

A check is a named row predicate ("this row violates"); every row-level check
of a table is evaluated in **one** aggregation pass.  Key-level checks
(uniqueness, one value per key) are one grouped aggregation each, partially
aggregated on the map side, so a hot key costs one shuffled row per map task.
Results are small DataFrames -- one row per check -- that a job turns into a
pass/fail decision with ``enforce``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateFailure(RuntimeError):
    """Raised when one or more gates see violations."""

    def __init__(self, failures: Mapping[str, int]):
        self.failures = dict(failures)
        detail = ", ".join(f"{k}={v}" for k, v in self.failures.items())
        super().__init__(f"quality gate failed: {detail}")


@dataclass(frozen=True)
class Check:
    name: str
    violates: Column          # boolean per row: TRUE = violation (NULL = pass)


def invalid_quantity() -> Check:
    return Check("invalid_quantity", F.col("quantity") <= 0)


def invalid_price() -> Check:
    return Check("invalid_price", F.col("unit_price") < 0)


def negative_amount() -> Check:
    """A NULL amount passes, as it did in the original gate."""
    return Check("negative_amount", F.col("total_amount") < 0)


def null_amount() -> Check:
    """Optional: an amount that could not be computed (NaN price, overflow)."""
    return Check("null_amount", F.col("total_amount").isNull())


def null_key(column: str) -> Check:
    return Check(f"null_{column}", F.col(column).isNull())


SALES_ROW_CHECKS = (invalid_quantity, invalid_price)
FACT_KEY_COLUMNS = ("date_key", "product_key", "customer_key", "region_key")


def count_violations(df: DataFrame, checks: Sequence[Check], *, rows: str | None = "rows") -> DataFrame:
    """One row: ``rows`` (total) plus one violation count per check, all from a
    single scan."""
    aggs = [F.count(F.lit(1)).alias(rows)] if rows else []
    aggs += [F.count_if(c.violates).alias(c.name) for c in checks]
    return df.agg(*aggs)


def duplicate_keys(df: DataFrame, key: str | Sequence[str], alias: str = "duplicate_keys") -> DataFrame:
    """One row: number of key values that occur more than once (a NULL key
    counts as one value, as in ``GROUP BY``)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
              .agg(F.count_if(F.col("_n") > 1).alias(alias)))


def inconsistent_mappings(df: DataFrame, key: str, value: str,
                          alias: str = "inconsistent_keys") -> DataFrame:
    """One row: number of ``key`` values mapped to more than one distinct
    non-NULL ``value``.

    The distinct pairs are hashed on the map side, then counted per key.
    ``min(value) < max(value)`` needs one shuffle less, but a ``min`` of strings
    is a sort of all rows by key."""
    pairs = df.where(F.col(value).isNotNull()).select(key, value).distinct()
    return (pairs.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
                 .agg(F.count_if(F.col("_n") > 1).alias(alias)))


def null_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``(column_name, null_count)`` for every column, from one pass."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "null_count")


def mapping_report(df: DataFrame, key: str, value: str, *, count_alias: str = "name_count",
                   rows_alias: str = "rows") -> DataFrame:
    """Every key with more than one distinct non-NULL value, in long form:
    ``(key, count_alias, value, rows_alias)`` -- one row per (key, value), worst
    keys first.  Long form rather than one collected array per key, so a key
    with very many values never becomes a single in-memory list."""
    pairs = (df.where(F.col(value).isNotNull())
               .groupBy(key, value).agg(F.count(F.lit(1)).alias(rows_alias)))
    # Reading the row counts on this side too keeps both sides the same plan,
    # so the scan and shuffle of the pairs run once and are reused.
    bad = (pairs.groupBy(key).agg(F.count(F.lit(1)).alias(count_alias), F.min(rows_alias).alias("_least"))
                .where((F.col(count_alias) > 1) & (F.col("_least") > 0)).drop("_least"))
    return (pairs.join(bad, key)
                 .select(key, count_alias, value, rows_alias)
                 .orderBy(F.col(count_alias).desc(), F.col(key), F.col(value)))


def mapping_report_max(df: DataFrame, key: str, value: str, alias: str = "max_names") -> DataFrame:
    """One row: the largest number of distinct values of one key among the
    inconsistent keys (NULL when there are none)."""
    per_key = df.groupBy(key).agg(F.count_distinct(value).alias("_n"))
    return per_key.where(F.col("_n") > 1).agg(F.max("_n").cast("long").alias(alias))


def reconcile(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows of ``left`` missing from ``right`` and rows of ``right``
    not in ``left``, as multisets over ``columns`` -- the sizes of ``EXCEPT
    ALL`` in both directions, from one shuffle: both sides are tagged,
    unioned, counted per distinct row (map-side combined), then summed."""
    tagged = (left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
              .unionByName(right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))))
    per_row = tagged.groupBy(*columns).agg(F.sum("_l").alias("_nl"), F.sum("_r").alias("_nr"))
    return per_row.agg(
        F.coalesce(F.sum(F.greatest(F.col("_nl") - F.col("_nr"), F.lit(0))), F.lit(0))
         .cast("long").alias("missing_rows"),
        F.coalesce(F.sum(F.greatest(F.col("_nr") - F.col("_nl"), F.lit(0))), F.lit(0))
         .cast("long").alias("extra_rows"))


# Fixed value: hash buckets of a table's fingerprint, at 40 bytes each.
FINGERPRINT_BUCKETS = 4096


def _row_hash(df: DataFrame, columns: Sequence[str], seed: int) -> Column:
    """64-bit hash of a row's values; nulls count by their place, as values
    equal in a ``GROUP BY`` (0.0 and -0.0, all NaN) have equal hashes."""
    parts: list[Column] = [F.lit(seed)]
    for c in columns:
        value = F.col(c) + 0.0 if df.schema[c].dataType.typeName() in ("float", "double") else F.col(c)
        parts += [F.col(c).isNull(), value]
    return F.xxhash64(*parts)


def fingerprint(df: DataFrame, columns: Sequence[str], *, buckets: int = FINGERPRINT_BUCKETS) -> DataFrame:
    """``(bucket, rows, low1, high1, low2, high2)``: for each hash bucket of
    rows its size and the order-free sums of two row hashes, by halves of 32
    bits, which leave a long only beyond 2^31 rows a bucket.  Combined on the
    map side: a task ships one row per bucket."""
    halves = [part.alias(f"{name}{i}")
              for i, h in enumerate((_row_hash(df, columns, 1), _row_hash(df, columns, 2)), 1)
              for name, part in (("low", F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))),
                                 ("high", F.sum(F.shiftrightunsigned(h, 32))))]
    bucket = F.pmod(_row_hash(df, columns, 0), F.lit(buckets)).alias("bucket")
    return df.groupBy(bucket).agg(F.count(F.lit(1)).alias("rows"), *halves)


def differing_buckets(left: DataFrame, right: DataFrame, columns: Sequence[str], *,
                      buckets: int = FINGERPRINT_BUCKETS) -> DataFrame:
    """``bucket`` of every hash bucket whose fingerprints differ."""
    sides = fingerprint(left, columns, buckets=buckets).withColumn("_side", F.lit(1)).unionByName(
        fingerprint(right, columns, buckets=buckets).withColumn("_side", F.lit(-1)))
    sums = [c for c in sides.columns if c not in ("bucket", "_side")]
    gaps = sides.groupBy("bucket").agg(*[F.sum(F.col(c) * F.col("_side")).alias(c) for c in sums])
    return gaps.where(" or ".join(f"{c} <> 0" for c in sums)).select("bucket")


def reconcile_by_fingerprint(left: DataFrame, right: DataFrame, columns: Sequence[str], *,
                             buckets: int = FINGERPRINT_BUCKETS) -> DataFrame:
    """``reconcile``, with whole rows shuffled only where they may differ.

    Both tables are scanned for their fingerprints, of at most ``buckets``
    rows; only rows of buckets that differ go on to the exact comparison, and
    for equal tables no row does (the list of differing buckets is broadcast,
    so adaptive execution skips that scan when it is empty).  Both tables must
    give the same rows when read twice: use stored ones.

    Different multisets pass unseen only if the size and both 64-bit hash sums
    of their bucket agree by chance (about 2^-128 for each differing bucket);
    rows that a differing bucket holds are compared by value."""
    changed = F.broadcast(differing_buckets(left, right, columns, buckets=buckets))

    def suspects(df: DataFrame) -> DataFrame:
        bucket = F.pmod(_row_hash(df, columns, 0), F.lit(buckets))
        return df.select(*columns).withColumn("bucket", bucket).join(changed, "bucket", "left_semi").drop("bucket")

    return reconcile(suspects(left), suspects(right), columns)


def side_by_side(values: Mapping[str, DataFrame]) -> DataFrame:
    """Several one-row, one-column results (counts, gate values) as one row
    with a column per name: the values are tagged and unioned, then pivoted
    back by a single global aggregate -- one job for all of them, no join."""
    parts = None
    for name, df in values.items():
        tagged = df.select(F.lit(name).alias("_name"), F.col(df.columns[0]).cast("long").alias("_v"))
        parts = tagged if parts is None else parts.unionByName(tagged)
    return parts.agg(*[F.max(F.when(F.col("_name") == n, F.col("_v"))).alias(n) for n in values])


def failures(result: DataFrame | Mapping[str, int], gates: Iterable[str]) -> dict[str, int]:
    """Gates among ``gates`` with a non-zero count.  Collects one row."""
    values = result if isinstance(result, Mapping) else result.first().asDict()
    return {g: int(values[g]) for g in gates if values.get(g)}


def enforce(result: DataFrame | Mapping[str, int], gates: Iterable[str]) -> dict:
    """Raise ``GateFailure`` listing every failed gate at once; return the values."""
    values = result if isinstance(result, Mapping) else result.first().asDict()
    bad = failures(values, gates)
    if bad:
        raise GateFailure(bad)
    return dict(values)
