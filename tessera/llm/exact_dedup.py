"""Exact de-duplication by content-defined chunk recipes (native).

A text is cut where its own characters say so, equal chunks get one verified
identifier, and texts are equal when their ordered identifier lists are.  Each
distinct chunk crosses the network once; documents move only as short lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import store

#: A chunk ends after a line break, or after a space behind two letters of
#: fixed classes; 512 to 8192 characters, shorter only at the end of a text.
CHUNK = r"(?s).{512,8191}?(?<=\n|[a-m][n-z] )|.{1,8192}"


def chunks(text: Column) -> Column:
    """The ordered chunks of a text; joined they give the text again."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def _fingerprint(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def clashes(docs: DataFrame, fingerprint=_fingerprint) -> DataFrame:
    """Fingerprints that two different chunks have, found by comparing the
    chunks themselves; normally none.  Equal chunks meet before the shuffle."""
    distinct = (docs.select(F.explode(chunks(F.col("text"))).alias("chunk"))
                .select(fingerprint(F.col("chunk")).alias("h"), "chunk").distinct())
    return distinct.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")


def recipes(docs: DataFrame, fingerprint=_fingerprint) -> DataFrame:
    """``docs`` (row, text) with ``recipe``: the ordered identifiers of its
    chunks.  An identifier is the chunk's fingerprint when verified to belong
    to one chunk only, else its fingerprint and its SHA-256 value."""
    bad = store(clashes(docs.select("text"), fingerprint))
    if bad.isEmpty():
        return docs.withColumn("recipe", F.transform(chunks(F.col("text")), lambda c: F.struct(
            fingerprint(c).alias("h"), F.lit(None).cast("string").alias("more"))))
    h = F.transform(chunks(F.col("text")), fingerprint)
    hit = (docs.select("row", F.explode(F.array_distinct(h)).alias("h")).join(bad, "h", "left_semi")
           .groupBy("row").agg(F.collect_set("h").alias("clashing")))
    return (docs.join(hit, "row", "left")
            .withColumn("recipe", F.transform(chunks(F.col("text")), lambda c: F.struct(
                fingerprint(c).alias("h"),
                F.when(F.array_contains(F.col("clashing"), fingerprint(c)), F.sha2(c, 256)).alias("more"))))
            .drop("clashing"))


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                fingerprint=_fingerprint) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the largest id stays.  A null text counts as
    empty, and empty texts are equal.  A null id ranks below every other; a
    group of null ids only keeps null.  Repeated rows (same id, same text) are
    members of their group each, and every copy of the kept id is ``kept``.
    An empty table gives an empty result; other columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumn("row", F.struct("doc_id", F.sha2("text", 256).alias("sha")))
    rows = store(recipes(base, fingerprint)
                 .select("doc_id", F.col("row.sha").alias("text_sha256"), "recipe"))
    # Stored, so that the join may split a recipe that many rows share.
    groups = store(rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
                   .where("group_size > 1"))
    alone = F.col("group_size").isNull()
    return (rows.join(groups, "recipe", "left")
            .withColumn("keep_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")))
            .select("doc_id", "keep_id", F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))
