"""A training corpus from raw documents: filter, de-duplicate, mix, pack.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir) and
works on all rows its predecessor kept.  ``run`` writes every stage as Parquet
in the shared folder and reads it again for the next.

A row is known by its id and the SHA-256 value of its text, so rows without an
id and different texts that share one are documents of their own in every
stage.  A null text counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import n_words, store, table
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.mixing import mix
from tessera.llm.near_dup import near_dup
from tessera.llm.packing import pack
from tessera.llm.quality import fit_quality, quality_scores
from tessera.llm.queries import WEIGHTS, tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _identity(*more: str) -> Column:
    """What a row is known by; rows without an id rank after all others."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id",
                    F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"), *more)


def _known(docs: DataFrame, *more: str) -> DataFrame:
    """``docs`` with the identity in place of the id."""
    return docs.withColumn("doc_id", _identity(*more))


def _only(docs: DataFrame, kept: DataFrame, *more: str) -> DataFrame:
    """The rows of ``docs`` whose identity is in ``kept``."""
    kept = kept.select(F.col("doc_id").alias("kept_id")).distinct()
    return (docs.withColumn("identity", _identity(*more))
            .join(kept, F.col("identity") == F.col("kept_id"), "left_semi").select(*COLUMNS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    labels = table(spark, sf_dir, "labels")
    seen = ["lang", "source", "n_chars"]  # by the score, besides the text
    scores = quality_scores(_known(docs, *seen), labels, model=fit_quality(docs, labels))
    return _only(docs, scores.where("kept"), *seen)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that of the largest id, and
    of its repeated rows the one with the smallest metadata."""
    kept = exact_dedup(docs).where("kept").select(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("text_sha256").alias("sha")).alias("doc_id"))
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")] + ["text"]
    return (_only(docs, kept).groupBy(_identity().alias("identity")).agg(F.min(F.struct(*rest)).alias("row"))
            .select("identity.doc_id", "row.*").select(*COLUMNS))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id;
    one without an id only where no other has one."""
    return _only(docs, near_dup(_known(docs)).where("kept"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, repeated as often as it takes them; a row's id
    and text are its own here, as ``exact`` leaves them."""
    sized = store(_known(docs).select("doc_id", n_words(F.col("text")).alias("size"), F.array("source").alias("sources")))
    words = F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    uses = mix(sized, WEIGHTS).withColumn("words", words).where("words > 0").select(
        F.col("doc_id").alias("used_id"), F.expr("cast(words div size as int)").alias("uses"))
    return (docs.withColumn("identity", _identity()).join(uses, F.col("identity") == F.col("used_id"))
            .withColumn("use", F.explode(F.sequence(F.lit(1), F.col("uses")))).select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of the mixed documents."""
    return pack(docs, tokenizer_path())


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dup", near), ("mixing", mixture), ("packing", packed)]

#: No SQL for the trained and the hashed stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir))
    return docs
