"""The whole pipeline on a small table with planted groups, nulls, shared ids
and repeated rows: every stage's rows against plain Python."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm.queries import WEIGHTS, tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = corpus_pipeline.COLUMNS
GOOD = ("river stone market letter garden window morning teacher village harvest mountain history science "
        "library music friend kitchen journey winter summer bridge forest painter doctor captain").split()
BAD = "buy now click free $$$ winner xxx casino offer cheap!!! pills deal".split()


def row(i, text, source):
    return (i, text, "en", source, None if text is None else len(text))


def planted():
    rng = np.random.default_rng(8)
    good = [" ".join(rng.choice(GOOD, 60)) for _ in range(120)]
    bad = [" ".join(rng.choice(BAD, 60)) for _ in range(60)]
    rows = [row(i, t, ("a", "b", "c", None)[i % 4]) for i, t in enumerate(good)]
    rows += [row(1000 + i, t, "spam") for i, t in enumerate(bad)]
    rows += [row(2000 + i, good[3], "a") for i in range(8)]                                  # exact copies
    rows += [row(3000 + i, good[5] + f" tail{i}", "b") for i in range(8)]                    # near copies
    rows += [row(7, good[8] + " twin", "c"), rows[10], rows[10], row(None, good[9] + " no id at all", "a"),
             row(None, " ".join(rng.choice(GOOD, 50)), "b")]
    labels = [(i, 1, 0) for i in range(0, 120, 2)] + [(1000 + i, 0, 0) for i in range(0, 60, 2)]
    return rows, labels


def words(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def plain_exact(rows):
    """One row of each text: the largest id, then the smallest metadata."""
    best = {}
    for r in rows:
        rank = (r[0] is not None, r[0] or 0)
        if (r[1] or "") not in best or rank > best[r[1] or ""][0]:
            best[r[1] or ""] = rank, r
    return [r for _, r in best.values()]


def plain_near(rows):
    """The row of the smallest id of each component of the similarity graph."""
    sets, low = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                low[max(root(i), root(j))] = min(root(i), root(j))
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[root(i)].append(r)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    rows, labels = planted()
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), [rows]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.store(stage(spark, docs, folder))
        if name != "packing":
            assert docs.columns == COLUMNS
            out.append([tuple(r) for r in docs.collect()])
    return folder, out, docs.collect()


def same(got, want):
    assert Counter(got) == Counter(want)


def test_quality_keeps_clean_documents(run):
    _, (rows, kept, *_), _ = run
    assert not Counter(kept) - Counter(rows)
    clean = [r for r in rows if r[3] != "spam"]
    assert sum(1 for r in kept if r[3] != "spam") >= 0.95 * len(clean)
    assert sum(1 for r in kept if r[3] == "spam") <= 0.1 * 60


def test_exact_keeps_one_of_each_text(run):
    _, out, _ = run
    same(out[2], plain_exact(out[1]))


def test_near_keeps_one_of_each_group(run):
    _, out, _ = run
    same(out[3], plain_near(out[2]))
    assert len(out[3]) < len(out[2])


def test_mixture_is_of_whole_documents_near_their_targets(run):
    _, out, _ = run
    sizes, taken = Counter(), Counter()
    for r in out[3]:
        sizes[r[3]] += len(words(r[1]))
    for r, n in Counter(out[4]).items():
        assert r in out[3] and n <= 3
        taken[r[3]] += n * len(words(r[1]))
    total = sum(sizes.values())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[k % 3] for k, s in enumerate(order)}
    target, open_ = {}, set(order)
    rest = float(total)
    while open_:                              # reshare what full sources cannot take
        share = {s: rest * weight[s] / sum(weight[t] for t in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
        open_ -= full
    longest = max(len(words(r[1])) for r in out[3])
    for s in order:
        assert abs(taken[s] - target[s]) <= 3 * longest


def test_pieces_hold_every_id_of_every_document_once(run):
    _, out, pieces = run
    plain = Tokenizer.from_file(tokenizer_path())
    want, starts = Counter(), defaultdict(Counter)
    for r in out[4]:
        ids = np.array([*plain.encode(r[1] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want[r[0], len(ids)] += len(ids)
        starts[r[0]][ids.tobytes()] += 1
    got, windows = Counter(), defaultdict(list)
    for p in pieces:
        got[p.doc_id, p.doc_tokens] += p.length
        windows[p.sequence_id].append((p.offset, p.length))
        assert any(zlib.crc32(ids[4 * p.start: 4 * (p.start + p.length)]) == p.ids_crc32 for ids in starts[p.doc_id])
    assert got == want
    for w in windows.values():
        ends = np.cumsum([0] + [n for _, n in sorted(w)])
        assert [o for o, _ in sorted(w)] == list(ends[:-1]) and ends[-1] <= 1024


def test_run_is_all_stages(spark, run):
    folder, _, pieces = run
    got = corpus_pipeline.run(spark, folder).collect()
    key = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    same([tuple(r[k] for k in key) for r in got], [tuple(r[k] for k in key) for r in pieces])


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_an_empty_table(spark, run, name, stage):
    got = stage(spark, spark.createDataFrame([], DOCS), run[0])
    assert got.count() == 0
    if name != "packing":
        assert got.columns == COLUMNS


def test_stages_take_nulls(spark, run):
    """Null texts count as empty; one empty document stays of all of them."""
    docs = spark.createDataFrame([row(1, None, None), row(2, "", None), row(None, None, "a"), row(3, "one word", None)], DOCS)
    assert sorted((r.doc_id or -1) for r in corpus_pipeline.exact(spark, docs, "").collect()) == [2, 3]
    assert corpus_pipeline.near(spark, docs, "").count() == 4
    assert {r.doc_id for r in corpus_pipeline.mixture(spark, docs, "").collect()} == {3}
    assert sum(r.length for r in corpus_pipeline.packed(spark, docs, "").collect()) == 3 + 1 + 2
