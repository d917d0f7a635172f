"""Secret findings and a random forest that removes false positives (native)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fold, store

#: Words that announce a secret, and provider formats.
ANNOUNCE = r"(?i:key|token|secret|passw(?:or)?d|pwd|credential)s?"
PROVIDERS = (r"AKIA[0-9A-Z]{16}", r"gh[pousr]_[A-Za-z0-9]{36}", r"sk_live_[0-9A-Za-z]{24,}", r"AIza[0-9A-Za-z_-]{35}",
             r"xox[abp]-[0-9A-Za-z-]{10,}", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+")
#: What announces a value: a name that holds such a word at or near its end and is
#: followed by a colon or an equals sign, or the word ``bearer``.  Runs are
#: possessive and start once, so the time is linear in the text.
NAMED = (r"(?<![\w.-])(?:[\w.-]++(?=[\"'\]]{0,2}[ \t]*+[:=])(?<=" + ANNOUNCE + r"[\w-]{0,16})[\"'\]]{0,2}[ \t]*+"
         r"(?:=>|:=|(?<=[ \t])==(?=[ \t])|=(?!=)|:(?!:|//))[ \t]*+"
         r"|(?i:bearer)[ \t]++(?![\w.-]++[\"'\]]{0,2}[ \t]*+[:=]))")
#: An announced value, whatever its length and marks: up to its closing quote or white space.
VALUE = r"(?![\w.-]++:(?:\s|$))(?:\"[^\"\r\n]++|'[^'\r\n]++|[^\s\"',;]++)"
#: Any run of 12 characters of keys and encodings that holds a digit or a capital after a small letter.
TOKEN = r"(?<![A-Za-z0-9+/_.-])(?=[A-Za-z0-9+/_.-]*?(?:[0-9]|[a-z][A-Z]))[A-Za-z0-9+/_.-]{12,}+={0,2}"
CANDIDATE = f"{NAMED}{VALUE}|{TOKEN}"
#: Whole words kept on the left (besides what touches the candidate) and on the right.
LEFT_WORDS, RIGHT_WORDS = 3, 2
#: Pieces of a candidate that the dictionary is asked for, and the share of the
#: distinct texts a word must be in to count as one, ``DICTIONARY_DOCS`` at least.
PIECE, DICTIONARY_SHARE, DICTIONARY_DOCS = r"[a-z]{3,}", 1e-4, 3

#: The forest's inputs, besides ``context``, hashed into ``HASHED`` columns.
FEATURES = ["length", "digits", "uppers", "lowers", "marks", "transitions", "letter_digit", "case_changes", "distinct",
            "hex_only", "digits_only", "coverage", "quoted", "in_path", "left_length", "right_length", "left_digits"]
HASHED = 256


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, source, finding, candidate, announced, left, right): every
    candidate of every whole text with the whole words around it; ``finding``
    counts from 0 within a text.

    A candidate is the value that an announcing name, a colon or an equals sign
    and an optional quote (or ``bearer``) stand before, of any length and make-up;
    or a run of at least 12 of ``A-Za-z0-9+/_.-`` with a digit or a capital after
    a small letter, without the dots at its ends.  Other strings, such as an
    unannounced password of 11 characters, are none.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    between = F.split(text, CANDIDATE, -1)
    rows = (docs.select("doc_id", "source", found.alias("found"), between.alias("between"))
            .where(F.size("found") > 0)
            .select("doc_id", "source", F.posexplode(F.arrays_zip(
                "found", F.slice("between", 1, F.size("found")).alias("before"),
                F.slice("between", 2, F.size("found")).alias("after")))))
    name = F.regexp_extract("match", rf"^{NAMED}[\"']?(?=(?s:.))", 0)
    rows = (rows.select("doc_id", "source", F.col("pos").alias("finding"), F.col("col.found").alias("match"),
                        F.col("col.before").alias("before"), F.col("col.after").alias("after"), name.alias("name"))
            .withColumn("announced", F.col("name") != "")
            .withColumn("lead", F.when(F.col("announced"), F.col("name"))
                        .otherwise(F.regexp_extract("match", r"^\.*", 0)))
            .withColumn("rest", F.col("match").substr(F.length("lead") + 1, F.length("match")))
            .withColumn("candidate", F.when(F.col("announced"), F.col("rest"))
                        .otherwise(F.rtrim("rest", F.lit(".")))))
    ending = F.col("rest").substr(F.length("candidate") + 1, F.length("rest"))
    # From the end backwards, so that the pattern is tried at one place only.
    left = F.reverse(F.regexp_extract(F.reverse(F.concat("before", "lead")),
                                      rf"^\s*+\S*+(?:\s++\S++){{0,{LEFT_WORDS}}}", 0))
    right = F.regexp_extract(F.concat(ending, "after"), rf"^\S*+(?:\s++\S++){{0,{RIGHT_WORDS}}}", 0)
    return rows.select("doc_id", "source", "finding", "candidate", "announced", left.alias("left"),
                       right.alias("right"))


def _number(pattern: str, of: str = "candidate") -> Column:
    return F.regexp_count(F.col(of), F.lit(pattern)).cast("double")


def _matches(pattern: str, of: str) -> Column:
    return F.coalesce(F.col(of).rlike(pattern).cast("double"), F.lit(0.0))


def coverage(found: DataFrame, docs: DataFrame) -> DataFrame:
    """(candidate, covered): characters of the candidate's lower-case pieces
    that are words: found outside all candidates in at least
    ``DICTIONARY_SHARE`` of the distinct texts, so neither a candidate's own
    pieces nor copies of a text make a word."""
    pieces = found.select("candidate").distinct().select("candidate", F.explode(F.regexp_extract_all(
        F.lower("candidate"), F.lit(PIECE), F.lit(0))).alias("word"))
    wanted = pieces.select("word").distinct()
    texts = docs.where("text is not null").select(F.sha2("text", 256).alias("sha"), "text")
    least = max(DICTIONARY_DOCS, math.ceil(DICTIONARY_SHARE * texts.select("sha").distinct().count()))
    outside = F.lower(F.regexp_replace("text", CANDIDATE, " "))
    words = texts.select("sha", F.array_distinct(F.regexp_extract_all(outside, F.lit(PIECE), F.lit(0))).alias("words"))
    known = (words.dropDuplicates(["sha"]).select(F.explode("words").alias("word")).groupBy("word").count()
             .where(F.col("count") >= least).join(wanted, "word", "left_semi").select("word"))
    # Stored ahead of the joins, so that AQE can split a word or candidate that
    # a large share of the rows has.
    known = store(known)
    return store(pieces.join(known, "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("covered")))


def with_features(found: DataFrame, covered: DataFrame) -> DataFrame:
    """The forest's inputs: length, make-up and character transitions, share of
    dictionary words, and ``context``, the neighbouring words and the parts of
    the path as words; besides, ``provider``, which only the rules know."""
    size = F.length("candidate").cast("double")
    rows = found.join(covered, "candidate", "left")
    letters = F.lit(r"\p{L}+")
    before = F.slice(F.reverse(F.regexp_extract_all(F.lower("left"), letters, F.lit(0))), 1, LEFT_WORDS)
    after = F.slice(F.regexp_extract_all(F.lower("right"), letters, F.lit(0)), 1, RIGHT_WORDS)
    parts = F.regexp_extract_all(F.lower(F.coalesce("source", F.lit(""))), F.lit(r"[^/\\.:_\s-]+"), F.lit(0))
    last = F.regexp_extract(F.reverse("left"), r"^\S*+", 0)
    return rows.withColumns({
        "length": size,
        "digits": _number("[0-9]") / size, "uppers": _number("[A-Z]") / size, "lowers": _number("[a-z]") / size,
        "marks": _number("[^A-Za-z0-9]") / size,
        "transitions": (_number("[a-z](?=[^a-z])") + _number("[A-Z](?=[^A-Z])") + _number("[0-9](?=[^0-9])")) / size,
        "letter_digit": _number("[A-Za-z](?=[0-9])") / size, "case_changes": _number("[a-z](?=[A-Z])") / size,
        "distinct": F.size(F.array_distinct(F.split("candidate", ""))) / size,
        "hex_only": _matches("^[0-9a-f]+$", "candidate"), "digits_only": _matches("^[0-9]+$", "candidate"),
        "coverage": F.coalesce("covered", F.lit(0)) / size,
        "quoted": _matches("[\"']$", "left"), "in_path": last.rlike("[/.@]").cast("double"),
        "left_length": F.length(F.regexp_extract("left", r"(\S*+)\s*+$", 1)).cast("double"),
        "right_length": F.length(F.regexp_extract("right", r"^\S*+\s*+(\S*+)", 1)).cast("double"),
        "left_digits": _number("[0-9]", "left") / F.greatest(F.length("left"), F.lit(1)),
        "context": F.concat(*(F.transform(words, lambda w, kind=kind: F.concat(F.lit(kind), w))
                              for kind, words in (("l:", before), ("r:", after), ("p:", parts)))),
        "provider": reduce(lambda a, b: a | b, (F.col("candidate").rlike(p) for p in PROVIDERS)),
    }).drop("covered")


def label_findings(found: DataFrame) -> DataFrame:
    """Labelled findings where no reviewed ones are at hand: 1 for a provider's
    format or an announced value with letters and digits, 0 for numbers, address
    parts and values mostly made of words; others are left out.  Whether a value
    is announced or has a provider's format is no input of the forest, which has
    to tell by make-up and neighbouring words."""
    mixed = (F.col("digits_only") == 0) & (F.col("digits") >= 0.1) & (F.col("coverage") < 0.4)
    bad = (F.col("digits_only") == 1) | (F.col("coverage") >= 0.5) | ((F.col("in_path") == 1) & ~F.col("announced"))
    label = F.when(F.col("provider") | (F.col("announced") & mixed), 1.0).when(bad, 0.0)
    return found.withColumn("label", label).where("label is not null")


def reviewed_findings(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """The findings whose document and candidate a reviewer has labelled; a
    candidate labelled both ways counts as a secret, a label without an id or
    candidate counts for nothing."""
    labels = store(labelled.where("label is not null").groupBy("doc_id", "candidate")
                   .agg(F.max(F.col("label").cast("double")).alias("label")))
    return rows.join(labels, ["doc_id", "candidate"])


def _vectors(rows: DataFrame) -> DataFrame:
    hashed = HashingTF(inputCol="context", outputCol="hashed", numFeatures=HASHED, binary=True).transform(rows)
    return VectorAssembler(inputCols=[*FEATURES, "hashed"], outputCol="features").transform(hashed)


def fit_forest(labelled: DataFrame, *, max_labelled: int = 20_000, trees: int = 20, depth: int = 6,
               seed: int = 17) -> RandomForestClassificationModel | None:
    """A forest on the ``max_labelled`` labelled findings with the smallest
    seeded hash; None when they do not hold both labels."""
    picked = store(labelled.select(*FEATURES, "context", "label", F.xxhash64(F.lit(seed), "candidate", "doc_id", "finding")
                                   .alias("order")).orderBy("order").limit(max_labelled).drop("order"))
    if picked.select("label").distinct().count() < 2:
        return None
    model = (RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed)
             .fit(_vectors(picked).select("features", "label")))
    # A copy has no training summary, which holds the session and so cannot be
    # sent to tasks once the session has observed metrics.
    return model.copy()


def secret_scan(docs: DataFrame, labelled: DataFrame | None = None, *, folds: int = 5, keep: float = 0.5,
                **options) -> DataFrame:
    """One row per candidate: ``doc_id, finding, candidate, left, right, score,
    held_out, kept``.

    ``docs`` has doc_id, source (its path) and text.  The forest learns from the
    reviewed findings ``labelled`` (doc_id, candidate, label: 1 a secret, 0 none),
    or without any from ``label_findings``, of the rows whose fold (crc32 of the
    id) is not 0.  Every candidate (see ``candidates``) of every whole text is
    scored; ``kept`` marks those that the forest takes for secrets.

    Null and empty texts have no findings; texts of any length are read whole, in
    linear time; a null source or id counts as empty; repeated rows are findings
    of their own; without labels of both kinds every
    score is 1 if the labels are all 1 or missing, else 0, so nothing is
    removed unseen; an empty table gives an empty result; other columns are
    ignored.
    """
    docs = docs.select("doc_id", "source", "text")
    found = store(candidates(docs))
    rows = store(with_features(found, coverage(found, docs)))
    learnt = rows.where(fold(F.col("doc_id"), folds) != 0)
    labelled = label_findings(learnt) if labelled is None else reviewed_findings(learnt, labelled)
    model = fit_forest(labelled, **options)
    if model is None:
        only = labelled.agg(F.coalesce(F.max("label"), F.lit(1.0))).first()[0]
        scored = rows.withColumn("score", F.lit(float(only)))
    else:
        scored = model.transform(_vectors(rows)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "finding", "candidate", "left", "right", "score",
                         (fold(F.col("doc_id"), folds) == 0).alias("held_out"),
                         (F.col("score") >= keep).alias("kept"))
