"""Whitening, phrase collocations and graph search against brute force on
small tables that hold nulls, empty rows, ties, repeated rows and clashing
column names."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import collocations as phrases
from tessera.llm.collocations import collocations
from tessera.llm.graph_search import graph_search
from tessera.llm.queries import QUERIES
from tessera.llm.whitening import leading_axes, whiten

VECTORS = "vec_id long, embedding array<float>, label int, shard long, score double, n long"
TEXTS = "doc_id long, text string, lang string, w1 string, bucket int"


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3.0, 4) for i, v in rows], VECTORS)


@pytest.fixture(scope="module")
def odd_rows():
    """Vectors of four dimensions: ties, repeated rows, unusable ones."""
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(4).astype(np.float32)]) for i in range(40)]
    rows += [(100 + i, rows[3][1]) for i in range(9)]          # ties
    rows += [(200, [2 * x for x in rows[3][1]]), rows[5], rows[5]]
    rows += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0]), (303, [float("nan")] * 4),
             (304, [float("inf"), 0.0, 0.0, 0.0]), (305, [0.0] * 4), (None, [1.0, 2.0, 3.0, 4.0])]
    return rows


# --------------------------------------------------------------- whitening ---

def plain_axes(x, k=8):
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    value, axes = np.linalg.eigh(c.T @ c / n)
    value, axes = value[::-1][:k], axes[:, ::-1][:, :k]
    return c @ axes / np.sqrt(value), value / (c ** 2).sum() * n, ((n * x - s) ** 2).sum(axis=1)


def test_whitening_equals_a_plain_decomposition(spark, sf001):
    rows = spark.read.parquet(f"{sf001}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(1024 * np.array([r.embedding for r in rows], dtype=float)).astype(np.int64) + 100_000
    z, explained, deviation = plain_axes(x)
    got = QUERIES["op11_whitening"](spark, sf001).toPandas().sort_values(["vec_id", "component"])
    assert list(got.columns[:7]) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    mine = got.whitened.to_numpy().reshape(len(rows), 8)
    assert np.abs(mine * np.sign((mine * z).sum(axis=0)) - z).max() < 1e-9
    assert (got.deviation.to_numpy().reshape(len(rows), 8) == deviation[:, None]).all()
    assert np.allclose(got.explained[:8], explained, rtol=1e-10)
    assert (got.n == len(rows)).all() and got.identity_error.max() < 1e-9 and got.identity_error.nunique() == 1


def test_whitening_of_odd_rows(spark, odd_rows):
    usable = [(i, v) for i, v in odd_rows if v and all(x is not None and np.isfinite(x) for x in v)]
    got = whiten(vector_table(spark, odd_rows)).toPandas()
    assert Counter(got[got.component == 1].vec_id.fillna(-1)) == Counter(-1 if i is None else i for i, _ in usable)
    x = np.floor(1024 * np.array([v for _, v in usable], dtype=np.float32).astype(float)).astype(np.int64) + 100_000
    z, explained, deviation = plain_axes(x)
    assert sorted(got.component.unique()) == [1, 2, 3, 4]
    assert np.allclose(np.sort(np.abs(got[got.component == 1].whitened)), np.sort(np.abs(z[:, 0])))
    assert sorted(int(d) for d in got[got.component == 2].deviation) == sorted(deviation)


def test_whitening_without_variance_or_rows(spark):
    assert whiten(vector_table(spark, [])).count() == 0
    assert whiten(vector_table(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whiten(vector_table(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    flat = whiten(vector_table(spark, [(i, [1.0, float(i)]) for i in range(5)])).toPandas()
    assert set(flat.component) == {1} and np.allclose(flat.explained, 1)
    mixed = whiten(vector_table(spark, [(i, [float(i), float(i * i)]) for i in range(5)]
                                + [(10 + i, [float(i)] * 3) for i in range(4)])).toPandas()
    assert dict(mixed.groupby("n").vec_id.nunique()) == {5: 5, 4: 4}


def test_whitening_refuses_what_longs_cannot_hold(spark):
    with pytest.raises(Exception, match="too large"):
        whiten(vector_table(spark, [(1, [1e30, 0.0]), (2, [0.0, 1.0])])).count()


@pytest.mark.parametrize("spectrum", [[9.0] * 3 + [1.0] * 57, list(np.linspace(1, 1.2, 60)), [1.0] * 60,
                                      [1e6] + [1.0 + i / 100 for i in range(59)], [5.0, 4.0] + [0.0] * 58])
def test_leading_axes_are_certified(spectrum):
    rng = np.random.default_rng(2)
    turn = np.linalg.qr(rng.standard_normal((60, 60)))[0]
    v = (turn * np.array(spectrum)) @ turn.T
    value, axes = leading_axes(lambda q: v @ q, 60, 8)
    want = np.sort(spectrum)[::-1][:8]
    assert np.allclose(value, want, rtol=1e-9, atol=1e-9 * want[0])
    assert np.abs(v @ axes - axes * value).max() < 1e-9 * want[0]
    assert np.abs(axes.T @ axes - np.eye(8)).max() < 1e-10


# ------------------------------------------------------------- collocations ---

def plain_phrases(rows, least=10, share=50, top=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(words[i: i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for g, v in c.items() if len(g) == 1)
        good = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        scored = []
        for g, a in good.items():
            inside = [h for h in good if len(h) > len(g) and any(h[i: i + len(g)] == g for i in range(len(h)))]
            if any(100 * good[h] >= share * a for h in inside):
                continue
            cuts = [(1_000_000 * a * a // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        out += [(lang, r, p.decode(), -a, x, y, n, -s) for r, (s, a, p, x, y) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(4)
    vocabulary = ["The", "cat", "sat", "ON", "a", "mat", "é日", "x.y", "end!", "semi;", "\t", "new\nline", "don't", "<|e|>"]
    rows = [(" ".join(rng.choice(vocabulary, int(rng.integers(0, 60)))), lang)
            for lang in ("en", "de", None, "und") for _ in range(60)]
    rows += [(None, "en"), ("", "fr"), (" \t ", None), ("a a a a a a a a a a a a a a", "en")] + [rows[0]] * 12
    return rows


def check_phrases(spark, rows, **more):
    docs = spark.createDataFrame([(i, t, lang, "w", 7) for i, (t, lang) in enumerate(rows)], TEXTS).repartition(3)
    got = collocations(docs, **more)
    assert got.columns[:8] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    more.pop("bucket_bytes", None)
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, **more)


def test_collocations_equal_brute_force(spark, texts):
    check_phrases(spark, texts)
    check_phrases(spark, texts, least=3, share=80, top=7)


def test_collocations_over_many_flushes_and_cuts(spark, texts, monkeypatch):
    """Stripes of short runs and buckets of few texts add up to the same."""
    import functools

    short = functools.partial(phrases._count)
    long_text = " ".join(t for t, _ in texts if t) + " tail"

    def tight(buckets):
        run = short(buckets)

        def limited(batches):
            phrases.TOKENS, phrases.CUT = 50, 64
            yield from run(batches)
        return limited

    monkeypatch.setattr(phrases, "_count", tight)
    check_phrases(spark, [*texts, (long_text, "en"), (long_text, "de")], least=5, bucket_bytes=1000)


def test_collocations_of_no_texts(spark):
    check_phrases(spark, [])
    check_phrases(spark, [(None, None), ("", "en")])


# ------------------------------------------------------------- graph search ---

def plain_nearest(rows, asks, k):
    items = defaultdict(list)
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            items[i].append(np.array(v, dtype=np.float32).astype(float))
    out = {}
    for q in (i for i in items if asks(i)):
        scores = {}
        for i in items:
            for a in items[q]:
                for b in items[i]:
                    if i != q and len(a) == len(b):
                        s = (a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))
                        scores[i] = max(s, scores.get(i, -2))
        out[q] = sorted(((-s, i) for i, s in scores.items()))[:k]
    return out


def nearest(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out[r.query_id].append((-r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_graph_search_of_odd_rows_is_exact(spark, odd_rows):
    rows = [*odd_rows, (400, [1.0, 2.0]), (0, [5.0, 1.0]), (401, [-1.0, 2.0]), (300, [1e-30, 1e-30, 0.0, 1e-30])]
    got = nearest(graph_search(vector_table(spark, rows), F.col("vec_id") % 10 == 0))
    want = plain_nearest(rows, lambda i: i % 10 == 0, 5)
    assert {q: [i for _, i in v] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items() if v}
    for q in got:
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], atol=1e-14)


def test_graph_search_of_few_or_no_rows(spark):
    few = vector_table(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])])
    assert nearest(graph_search(few, F.col("vec_id") == 0)).keys() == {0}
    assert [r.vec_id for r in graph_search(few, F.col("vec_id") == 0).orderBy("rank").collect()] == [1, 2]
    assert graph_search(few, F.col("vec_id") > 5).count() == 0
    assert graph_search(vector_table(spark, []), F.lit(True)).count() == 0


def test_graph_search_recall(spark, sf001):
    """At least 0.9 of the true neighbours over shards of 125 vectors, searched
    by a narrow beam, and every score exact."""
    table = spark.read.parquet(f"{sf001}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    want = plain_nearest(rows, lambda i: i % 50 == 0, 5)
    got = nearest(graph_search(table, F.col("vec_id") % 50 == 0, shard_bytes=8 * 64 * 125, search_width=32))
    hit = [len({i for _, i in got[q]} & {i for _, i in want[q]}) / 5 for q in want]
    assert got.keys() == want.keys() and np.mean(hit) >= 0.9
    full = nearest(QUERIES["op13_graph_search"](spark, sf001))
    assert np.mean([len({i for _, i in full[q]} & {i for _, i in want[q]}) / 5 for q in want]) >= 0.9
    true = {(q, i): -s for q, v in plain_nearest(rows, lambda i: i % 50 == 0, 500).items() for s, i in v}
    assert all(abs(-s - true[q, i]) < 1e-14 for q, v in full.items() for s, i in v)
