"""Quality scores by co-training a text view and a page-metadata view."""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import store, worker_cache
from tessera.llm.learners import Logistic, platt, sigmoid

#: Buckets of the text view's byte pairs; of languages and sources.
PAIRS, LANGS, SOURCES = 512, 16, 64
#: Byte classes of the text view: ranges of code, as text.
CLASSES = (rb"[A-Z]", rb"[a-z]", rb"[0-9]", rb"\s", rb"[!-/:-@\[-`{-~]", rb"[\x80-\xff]")


def text_view(text: str | None) -> np.ndarray:
    """What the words look like: profile of byte pairs and of byte classes.

    A byte pair is counted in a bucket of its product with a fixed odd number;
    logarithms of shares make the view independent of the length.
    """
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    out = np.zeros(PAIRS + len(CLASSES) + 3, dtype=np.float32)
    if not len(data):
        return out
    pair = (data[:-1].astype(np.uint32) << np.uint32(8)) | data[1:]
    bucket = (pair * np.uint32(2654435761)) >> np.uint32(23)
    out[:PAIRS] = np.log1p(1000.0 * np.bincount(bucket, minlength=PAIRS) / len(data))
    count = np.bincount(data, minlength=256)
    for i, lookup in enumerate(_CLASS_OF):
        out[PAIRS + i] = np.log1p(100.0 * count[lookup].sum() / len(data))
    found = text.split()
    some = len(found) or 1
    out[-3] = len(set(found)) / some
    out[-2] = math.log1p(len(data) / some)
    out[-1] = math.log1p(max((len(w) for w in found), default=0))
    return out


_CLASS_OF = [np.array([bool(re.match(c, bytes([b]))) for b in range(256)]) for c in CLASSES]


def meta_view(lang: str | None, source: str | None, n_chars: int | None, text: str | None) -> np.ndarray:
    """What a page is rather than says: language, source, recorded length, and
    the layout of its lines."""
    out = np.zeros(LANGS + SOURCES + 5, dtype=np.float32)
    out[zlib.crc32((lang or "").encode("utf-8", "surrogatepass")) % LANGS] = 1
    out[LANGS + zlib.crc32((source or "").encode("utf-8", "surrogatepass")) % SOURCES] = 1
    text = text or ""
    lines = text.split("\n")
    out[-5] = math.log1p(max(n_chars or 0, 0))
    out[-4] = math.log1p(len(text))
    out[-3] = math.log1p(len(lines))
    out[-2] = math.log1p(len(text) / len(lines))
    out[-1] = len(set(lines)) / len(lines)
    return out


WIDTH = {"a": PAIRS + len(CLASSES) + 3, "b": LANGS + SOURCES + 5}


def _views(docs: DataFrame) -> DataFrame:
    """``doc_id, of, a, b``: both views of every row of ``docs``, as bytes, and
    the fingerprint (64 bits) of its text, null as empty."""
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("of"), "text", "lang", "source", "n_chars")

    def run(batches):
        worker_cache("quality")
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(2, 6)]
            a = [text_view(t).astype(np.float16).tobytes() for t in cols[0]]
            b = [meta_view(*x).astype(np.float16).tobytes() for x in zip(*cols[1:], cols[0])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(a, pa.binary()),
                                              pa.array(b, pa.binary())], names=["doc_id", "of", "a", "b"])

    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, of long, a binary, b binary")


def _matrix(values: list, view: str) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float16).reshape(-1, WIDTH[view]).astype(np.float64)


class CoTrained:
    """Two views, their calibrations and the combination of both."""

    def __init__(self, a, b, cal_a, cal_b, joint):
        self.a, self.b, self.cal_a, self.cal_b, self.joint = a, b, cal_a, cal_b, joint

    def scores(self, xa: np.ndarray, xb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of the combination and of either view."""
        za = self.cal_a.logit(self.a.logit(xa)[:, None])
        zb = self.cal_b.logit(self.b.logit(xb)[:, None])
        return sigmoid(self.joint.logit(np.stack([za, zb], axis=1))), sigmoid(za), sigmoid(zb)


def sure_enough(sure: np.ndarray, right: np.ndarray, precise: float) -> float | None:
    """The lowest confidence from which on measured rows are right often enough:
    the Wilson lower bound (one standard error) of their share is at least
    ``precise``.  None where no confidence is."""
    order = np.argsort(-sure, kind="stable")
    n, k = np.arange(1, len(sure) + 1), np.cumsum(right[order])
    share = k / n
    low = (share + 1 / (2 * n) - np.sqrt(share * (1 - share) / n + 1 / (4 * n * n))) / (1 + 1 / n)
    ends = np.append(np.diff(sure[order]) != 0, True)[: len(n)]   # equal confidences go together
    good = np.flatnonzero(ends & (low >= precise))
    return float(sure[order][good[-1]]) if len(good) else None


def most_sure(views: DataFrame, labelled: DataFrame, models: list, cals: list, bars: dict, given: list,
              quota: dict) -> list:
    """Of all unlabelled texts, those that view 0 or 1 (``me``) is surest to be of
    a class: ``me, label, of, a, b``, at most ``quota`` per view and class.

    Every row is scored in its task; a text counts once, with its greatest
    confidence, and only texts at or above their bar leave the task, without
    their views.  Views of the chosen are fetched afterwards.
    """
    wanted = sorted((m, c) for (m, c), bar in bars.items() if bar is not None)
    taken = [np.array(sorted(g), dtype=np.int64) for g in given]

    def candidates(batches):
        worker_cache("quality")
        for batch in batches:
            of = batch.column("of").to_numpy()
            out = []
            for m, view in enumerate("ab"):
                p = sigmoid(cals[m].logit(models[m].logit(_matrix(batch.column(view).to_pylist(), view))[:, None]))
                fresh = ~np.isin(of, taken[1 - m])
                for label, sure in ((0, 1 - p), (1, p)):
                    if (m, label) in wanted:
                        at = np.flatnonzero(fresh & (sure >= bars[m, label]))
                        out += [(m, label, of[i], sure[i]) for i in at]
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.float64()))],
                                             names=["me", "label", "of", "sure"])

    found = store(views.select("of", "a", "b").mapInArrow(candidates, "me int, label int, of long, sure double")
                  .groupBy("me", "label", "of").agg(F.max("sure").alias("sure")).join(labelled, "of", "left_anti"))
    top = None
    for m, c in wanted:
        best = found.where((F.col("me") == m) & (F.col("label") == c)).orderBy(F.desc("sure"), "of").limit(quota[c])
        top = best if top is None else top.union(best)
    # At most one quota per view and class is broadcast and returned.
    return sorted(views.join(F.broadcast(top), "of").groupBy("me", "label", "of").agg(F.min("a").alias("a"), F.min("b").alias("b"))
                  .collect(), key=lambda r: (r.me, r.label, r.of))


def co_train(xa, xb, y, propose=None, *, rounds: int = 4, precise: float = 0.99, per_round: int = 500) -> CoTrained:
    """Each round either view labels the unlabelled texts it is most sure of and
    hands them to the other view, while ``propose`` finds any.

    Of the labelled rows, every sixth calibrates and every sixth measures; none
    of these is trained on until the last calibration, of both views together.
    A view hands over a class only from the confidence at which its measured
    precision is ``precise``, at most ``per_round`` texts a view and class on
    average, in the ratio of the labels.
    """
    part = np.arange(len(y)) % 6
    train, tune, test = (part != 2) & (part != 5), part == 2, part == 5
    share = float(y[train].mean()) if train.any() else 0.5
    quota = {1: max(1, round(2 * per_round * share)), 0: max(1, round(2 * per_round * (1 - share)))}
    sets = [[x[train], y[train].astype(float)] for x in (xa, xb)]
    given = [set(), set()]                      # by the view that received them
    for turn in range(rounds + 1):
        models = [Logistic(ridge=3.0).fit(*s) for s in sets]
        cals = [platt(v.logit(x[tune]), y[tune]) for v, x in zip(models, (xa, xb))]
        if turn == rounds or propose is None or not test.any():
            break
        bars = {}
        for m, x in enumerate((xa, xb)):
            p = sigmoid(cals[m].logit(models[m].logit(x[test])[:, None]))
            bars |= {(m, 1): sure_enough(p, y[test] == 1, precise), (m, 0): sure_enough(1 - p, y[test] == 0, precise)}
        if all(b is None for b in bars.values()):
            break
        rows = propose(models, cals, bars, given, quota)
        if not rows:
            break
        for m, view in enumerate("ab"):
            mine = [r for r in rows if r.me == 1 - m]
            given[m].update(r.of for r in mine)
            sets[m][0] = np.vstack([sets[m][0], _matrix([r[view] for r in mine], view)])
            sets[m][1] = np.concatenate([sets[m][1], [float(r.label) for r in mine]])
    z = np.stack([c.logit(v.logit(x[tune | test])[:, None]) for c, v, x in zip(cals, models, (xa, xb))], axis=1)
    return CoTrained(*models, *cals, platt(z, y[tune | test]))


def _fit(docs: DataFrame, labels: DataFrame, *, max_labelled: int = 9000, seed: int = 5,
         **options) -> tuple[CoTrained, DataFrame]:
    """The model of ``fit_quality`` and the stored views of all rows."""
    known = store(labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.max("quality").cast("double").alias("label")))
    views = store(_views(docs))
    labelled = store(views.select("doc_id", "of").join(known, "doc_id").groupBy("of").agg(F.max("label").alias("label")))
    picked = labelled.orderBy(F.xxhash64(F.lit(seed), "of"), "of").limit(max_labelled)
    # A text is fitted on once; of its metadata the smallest counts.
    rows = (views.join(F.broadcast(picked), "of").groupBy("of", "label").agg(F.min("a").alias("a"), F.min("b").alias("b"))
            .withColumn("place", F.xxhash64(F.lit(seed), "of")).collect())
    rows = sorted(rows, key=lambda r: (r.place, r.of))
    seen = labelled.select("of")

    def propose(*args):
        return most_sure(views, seen, *args)

    return co_train(_matrix([r.a for r in rows], "a"), _matrix([r.b for r in rows], "b"),
                    np.array([r.label for r in rows]), propose, **options), views


def fit_quality(docs: DataFrame, labels: DataFrame, **options) -> CoTrained:
    """Fit on the ``max_labelled`` labelled texts with the smallest seeded hash
    and on pseudo-labels from all unlabelled texts.  The driver gets the views
    of the former and of the texts handed over in a round, nothing else."""
    return _fit(docs, labels, **options)[0]


def quality_scores(docs: DataFrame, labels: DataFrame, *, keep: float = 0.5, model: CoTrained | None = None,
                   **options) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang, source, n_chars):
    ``doc_id, score, text_score, meta_score, kept``.

    The score is the probability of good quality from both calibrated views;
    documents with at least ``keep`` are kept.  Null and empty texts have an
    all-zero text view; very long ones are read whole; null metadata counts as
    empty; a null id is scored and may be given a pseudo-label, but has no label
    of its own; repeated rows are scored each; rows of equal text are fitted on
    once and share a label, and conflicting labels count as good.  Without
    labels, or with one class only, the scores are that class's smoothed share
    or one half.  An empty table gives an empty result; other columns are
    ignored.
    """
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    if model is None:
        model, views = _fit(docs, labels, **options)
    else:
        views = _views(docs)
    id_type = docs.schema["doc_id"].dataType
    arrow = pa.schema([("doc_id", to_arrow_type(id_type)), *((n, pa.float64()) for n in
                                                             ("score", "text_score", "meta_score"))])

    def run(batches):
        worker_cache("quality")
        for batch in batches:
            if batch.num_rows:
                found = model.scores(*(_matrix(batch.column(v).to_pylist(), v) for v in "ab"))
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in found)], schema=arrow)

    scored = views.mapInArrow(run, f"doc_id {id_type.simpleString()}, score double, text_score double, meta_score double")
    return store(scored).withColumn("kept", F.col("score") >= keep)
