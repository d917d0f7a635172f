"""Toxicity by weak supervision: voters, a generative label model, a linear
classifier on its posterior labels."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import fold, store
from tessera.llm.learners import Logistic, fit_whole, sigmoid, summed

#: Fixed lexicon: common insults (English, German, Spanish, French).
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown",
           "dumb", "imbecile", "bastard", "retard", "fool",
           "dumm", "trottel", "abschaum", "widerlich", "versager", "arschloch",
           "estúpido", "basura", "asqueroso", "imbécil", "idiota", "patético", "inútil",
           "stupide", "ordure", "dégoûtant", "imbécile", "minable", "crétin", "pathétique", "débile")
WORDS = re.compile(r"[^\W\d_]+")
#: Pattern voters: shouting, repeated marks, marks run together, direct address.
PATTERNS = (re.compile(r"\b[A-Z]{3,}\b(?:\W+[A-Z]{3,}\b){3}"), re.compile(r"[!?]{2,}"),
            re.compile(r"[*#$%&@]{3,}"), re.compile(r"\b[Yy]ou(?:'re| are)\b"))


def _counts(text: str | None, place: dict[str, int]) -> tuple[np.ndarray, int]:
    """How often each lexicon word occurs, and the number of words."""
    found = WORDS.findall((text or "").lower())
    out = np.zeros(len(place), dtype=np.float32)
    for w in found:
        at = place.get(w)
        if at is not None:
            out[at] += 1
    return out, len(found)


def features(text: str | None, place: dict[str, int]) -> np.ndarray:
    """Inputs of the linear classifier, from the text alone: lexicon words,
    their number and share, patterns, length."""
    count, n = _counts(text, place)
    hit = np.minimum(count, 3)
    total = count.sum()
    tail = [np.log1p(total), float(total > 0), min(1.0, 50.0 * total / max(n, 1)), np.log1p(n),
            *(float(bool(p.search(text or ""))) for p in PATTERNS)]
    return np.concatenate([hit, np.array(tail, dtype=np.float32)])


def votes(x: np.ndarray, n_words: int) -> np.ndarray:
    """The voters' answers for rows of features: every lexicon word votes for
    toxic where it occurs, two words and their density vote again, the absence
    of any votes against, and each pattern votes where it matches."""
    words, tail = x[:, :n_words] > 0, x[:, n_words:]
    several = words.sum(axis=1)
    return np.hstack([words, (several >= 2)[:, None], (several >= 3)[:, None], (tail[:, 2] >= 0.5)[:, None],
                      (several == 0)[:, None], tail[:, 4:] > 0]).astype(np.float64)


class Posterior:
    """Posterior probability of toxic for rows of votes; ``known`` holds 0, 1 or
    nan.  Known rows lean it but may be overruled.  Without weights it is the
    share ``prior``, or what the known rows say where there are two classes."""

    def __init__(self, prior: float, *, lean: bool = True):
        self.prior, self.lean, self.weight, self.bias = float(prior), lean, None, 0.0

    def __call__(self, v: np.ndarray, known: np.ndarray) -> np.ndarray:
        if not self.lean:
            return np.full(len(v), self.prior)
        lean = np.where(np.isnan(known), 0.5, np.where(known == 1, 0.95, 0.05))
        if self.weight is None:
            return np.where(np.isnan(known), self.prior, lean)
        return sigmoid(v @ self.weight + self.bias + np.log(lean / (1 - lean)))


def read_patterns(batch: pa.RecordBatch, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Votes, known labels (nan for none) and row counts of a batch of patterns."""
    packed = np.frombuffer(b"".join(batch.column("votes").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
    known = np.array([np.nan if y is None else y for y in batch.column("label").to_pylist()])
    return np.unpackbits(packed, axis=1)[:, :d].astype(np.float64), known, np.array(batch.column("n").to_pylist(), float)


def label_model(patterns: DataFrame, d: int, rounds: int = 20) -> Posterior:
    """Generative model of two classes over all rows of ``patterns`` (``votes``:
    ``d`` bits packed, ``label``, ``n`` rows that voted so).

    Each voter has a rate (its accuracy) per class, and the voters one
    covariance within classes (their correlations), found by
    expectation-maximisation.  A round is one pass: within classes, the squares
    follow from those of all rows, so only weights and sums by class leave a
    task.  Known rows alone start the model.  With one known class only, or
    none, the posterior is the smoothed share.
    """
    def squares(batch):
        v, known, n = read_patterns(batch, d)
        marked = n * ~np.isnan(known)
        return np.concatenate([[marked.sum(), (marked * (known == 1)).sum()],
                               ((v * marked[:, None]).T @ v).ravel(), ((v * n[:, None]).T @ v).ravel()])

    got = summed(patterns, squares, 2 + 2 * d * d)
    marked, toxic = got[:2]
    if not 0 < toxic < marked:
        return Posterior(np.clip(toxic / marked if marked else 0.5, 0.01, 0.99), lean=False)
    of_known, of_all = got[2:].reshape(2, d, d)
    model, old = Posterior(toxic / marked), None
    for turn in range(rounds + 1):
        def by_class(batch, model=model, old=old):
            v, known, n = read_patterns(batch, d)
            post = model(v, known)
            fit = n if old else n * ~np.isnan(known)
            moved = np.abs(post - old(v, known)) if old else np.ones(len(v))
            return np.concatenate([[n.sum(), n @ moved, fit @ (1 - post), fit @ post],
                                   (fit * (1 - post)) @ v, (fit * post) @ v])

        got = summed(patterns, by_class, 4 + 2 * d)
        if turn == rounds or got[1] < 1e-5 * got[0]:
            break
        size, mean = got[2:4], got[4:].reshape(2, d) / got[2:4, None]
        spread = ((of_all if old else of_known) - (mean.T * size) @ mean) / size.sum() + np.eye(d) * 1e-2
        old, model = model, Posterior(model.prior)
        model.weight = np.linalg.solve(spread, mean[1] - mean[0])
        model.bias = float(np.log(size[1] / size[0]) - model.weight @ (mean[0] + mean[1]) / 2)
    return model


class Toxic:
    """The lexicon and the linear classifier."""

    def __init__(self, lexicon: list[str], linear: Logistic):
        self.lexicon, self.linear = lexicon, linear

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.linear.logit(x))


def _read(batch: pa.RecordBatch) -> np.ndarray:
    """The feature rows of a batch."""
    data = b"".join(batch.column("x").to_pylist())
    return np.frombuffer(data, np.float32).reshape(batch.num_rows, -1).astype(np.float64)


def _featured(docs: DataFrame, lexicon: list[str]) -> DataFrame:
    """``doc_id, x``: the features of every row of ``docs``, as bytes."""
    place = {w: i for i, w in enumerate(lexicon)}

    def run(batches):
        for batch in batches:
            x = [features(t, place).astype(np.float32).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], names=["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, x binary")


def mine_lexicon(docs: DataFrame, known: DataFrame, *, folds: int, max_labelled: int, lexicon_size: int,
                 seed: int) -> list[str]:
    """``INSULTS`` and up to ``lexicon_size`` words that labelled rows show to be
    telling, by the weight of evidence of the documents that hold them: of the
    ``max_labelled`` labelled ids of the smallest seeded hash, the smallest text."""
    ids = docs.where(fold(F.col("doc_id"), folds) != 0).select("doc_id").distinct().join(known, "doc_id")
    picked = ids.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(max_labelled)
    marked = store(docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
                   .select("text", "label"))

    def distinct_words(batches):
        for batch in batches:
            out = [(w, y) for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                   for w in set(WORDS.findall((t or "").lower())) if len(w) > 2]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in out], pa.string()),
                                              pa.array([y for _, y in out], pa.float64())], names=["word", "label"])

    n, bad = marked.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not (n and 0 < bad < n):
        return list(INSULTS)
    # Share of toxic documents among those with the word, shrunk to the
    # overall share, and how far that is from chance.
    count, toxic = F.col("n"), F.col("toxic")
    share = bad / n
    sure = (toxic - count * share) / F.sqrt(count * share * (1 - share) + 1)
    mined = (marked.mapInArrow(distinct_words, "word string, label double").groupBy("word")
             .agg(F.count("*").alias("n"), F.sum("label").alias("toxic"))
             .where((count >= 4) & (toxic / count >= 0.6) & (sure >= 4))
             .orderBy(F.desc(sure), "word").limit(lexicon_size).collect())
    return [*INSULTS, *(r.word for r in mined if r.word not in INSULTS)]


def _fit(docs: DataFrame, labels: DataFrame, *, folds: int = 5, max_labelled: int = 12_000,
         lexicon_size: int = 150, seed: int = 3) -> tuple[Toxic, DataFrame]:
    """The model of ``fit_toxicity`` and the stored features of all rows."""
    docs = docs.select("doc_id", "text")
    known = store(labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("double").alias("label")))
    lexicon = mine_lexicon(docs, known, folds=folds, max_labelled=max_labelled, lexicon_size=lexicon_size, seed=seed)
    featured = store(_featured(docs, lexicon))
    width, n_words = len(features("", {w: i for i, w in enumerate(lexicon)})), len(lexicon)
    d = votes(np.zeros((1, width)), n_words).shape[1]
    train = store(featured.where(F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != 0))
                  .join(known, "doc_id", "left").select("label", "x"))

    def vote(batches):
        for batch in batches:
            if batch.num_rows:
                bits = np.packbits(votes(_read(batch), n_words).astype(bool), axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array([b.tobytes() for b in bits], pa.binary())],
                                                 names=["label", "votes"])

    patterns = store(train.mapInArrow(vote, "label double, votes binary").groupBy("votes", "label")
                     .agg(F.count("*").alias("n")))
    posterior = label_model(patterns, d)

    def read(batch):
        x = _read(batch)
        known = np.array([np.nan if y is None else y for y in batch.column("label").to_pylist()])
        return x, posterior(votes(x, n_words), known)

    return Toxic(lexicon, fit_whole(train, read, width, ridge=2.0)), featured


def fit_toxicity(docs: DataFrame, labels: DataFrame, **options) -> Toxic:
    """Fit on the rows whose fold is not 0, labelled or not.

    Only the lexicon is mined from a bounded sample, of ``max_labelled``
    labelled rows.  The label model and the classifier sum over every row of
    those folds; the driver gets the sums.
    """
    return _fit(docs, labels, **options)[0]


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, folds: int = 5, model: Toxic | None = None,
                    **options) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, held_out, score,
    predicted``.

    The score (0 to 1) comes from the text alone; rows of fold 0 are held out
    of all fitting.  Null and empty texts get the score of a text without
    words; very long ones are read whole; a null id counts as empty text for
    its fold and is never fitted on; repeated rows are scored and counted each;
    every text of a shared id has its label; conflicting labels of an id count
    as toxic.  Without usable labels the fixed lexicon and the overall share
    remain.  An empty table gives an empty result; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    if model is None:
        model, featured = _fit(docs, labels, folds=folds, **options)
    else:
        featured = _featured(docs, model.lexicon)
    id_type = docs.schema["doc_id"].dataType
    arrow = pa.schema([("doc_id", to_arrow_type(id_type)), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(_read(batch)))], schema=arrow)

    scored = store(featured.mapInArrow(run, f"doc_id {id_type.simpleString()}, score double"))
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
