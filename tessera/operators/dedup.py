"""Deterministic de-duplication by key, written as an aggregation.

Keeping the *largest* row per key is an ordinary ``max`` over a struct, which
Spark aggregates partially on the map side: each map task ships at most one
row per key into the shuffle, whatever the skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def desc(c: str | Column) -> str | Column:
    """Rank term: larger value wins; NULL loses (``DESC NULLS LAST``).  A
    column name stays a name, so ``keep_best`` can reuse its value instead of
    carrying the column twice."""
    return c


class asc:  # noqa: N801 -- reads as a function at the call site: asc("quantity")
    """Rank term: smaller value wins; NULL loses (``ASC NULLS LAST``).

    Resolved against the DataFrame's schema by ``keep_best``: integers are
    widened to ``long`` then negated (no value overflows), floating-point and
    decimal values are negated (NaN ranks last of all values, as in an
    ascending sort), dates and timestamps through their day / microsecond
    counts, without a time zone for ``timestamp_ntz``.  Other types have no order-reversing negation
    and are refused."""

    def __init__(self, column: str):
        self.column = column

    def resolve(self, df: DataFrame) -> Column:
        c = F.col(self.column)
        kind = df.schema[self.column].dataType.typeName()
        if kind in ("byte", "short", "integer", "long"):
            return -(c.cast("long"))
        if kind == "decimal":
            return -c
        if kind in ("float", "double"):
            return F.when(c.isNotNull(), F.struct(~F.isnan(c), -c))
        if kind == "date":
            return -F.unix_date(c)
        if kind == "timestamp":
            return -F.unix_micros(c)
        if kind == "timestamp_ntz":
            seconds = F.unix_date(c.cast("date")).cast("long") * 86_400 + F.hour(c) * 3600 + F.minute(c) * 60
            return -(seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long"))
        raise TypeError(f"asc({self.column!r}): no ascending rank for type {kind}")

    def restore(self, df: DataFrame, rank: Column) -> Column | None:
        """The column's value from its ``rank``, None for types whose rank does
        not hold it exactly."""
        data_type = df.schema[self.column].dataType
        kind = data_type.typeName()
        if kind in ("byte", "short", "integer", "long"):
            return (-rank).cast(data_type)
        if kind == "decimal":
            return -rank
        if kind == "date":
            return F.date_from_unix_date(-rank)
        return None


def keep_best(df: DataFrame, key: str | Sequence[str], rank_by: Sequence[str | Column | asc]) -> DataFrame:
    """One row per ``key``: the row with the largest ``rank_by`` tuple.

    Terms compare left to right; a NULL term ranks below any value.  A term
    given as a column name (``desc("created_at")``) ranks that column
    descending and is not repeated in the payload; neither is one whose value
    its ascending rank gives back.  All other columns follow
    as descending tie-breaks, so two rows only tie when they are equal, and
    the result does not depend on input order or partitioning.  A NULL key
    forms one group of its own, as ``dropDuplicates`` does.
    """
    keys = [key] if isinstance(key, str) else list(key)
    terms, reused, restored = [], {}, {}
    for i, t in enumerate(rank_by):
        name = f"_rank{i}"
        if isinstance(t, str):
            terms.append(F.col(t).alias(name))
            reused.setdefault(t, name)
        elif isinstance(t, asc):
            terms.append(t.resolve(df).alias(name))
            value = t.restore(df, F.col("_best").getField(name))
            if value is not None:
                restored.setdefault(t.column, value)
        else:
            terms.append(t.alias(name))
    rest = [c for c in df.columns if c not in keys and c not in reused and c not in restored]
    best = F.max(F.struct(*terms, *[F.col(c) for c in rest])).alias("_best")

    def value(c: str) -> Column:
        if c in restored and c not in reused:
            return restored[c]
        return F.col("_best").getField(reused.get(c, c))

    picked = [value(c).alias(c) for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(best).select(*keys, *picked).select(*df.columns)
