"""The training-data operators against brute force on small tables that hold
nulls, empty texts, repeated rows and clashing column names."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tessera.llm.embedding_dedup import embedding_dedup
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.lm_scoring import learn_weights, lm_score
from tessera.llm.mixing import MAX_USES, mix, route, targets
from tessera.llm.near_dup import near_dup, super_minhash
from tessera.llm.packing import pack
from tessera.llm.quality import quality_scores
from tessera.llm.queries import RULES, WEIGHTS, mix_documents, tokenizer_path
from tessera.llm.secret_scan import secret_scan
from tessera.llm.toxicity import toxicity_scores
from tessera.llm.url_filter import url_filter

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, kept string, component string, h int"


def words(text):
    return (text or "").encode().lower().split()


def make_texts():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(200)]
    base = [" ".join(rng.choice(vocabulary, n)) for n in (3, 5, 40, 80, 120, 300)]
    near = [base[3] + " tail", base[4].replace("w1 ", "x ", 1), base[4].upper(), "  " + base[5] + "\n"]
    return [None, "", " \t\n", "one", *base, *near, base[2], "é 日本 <|endoftext|> don't  stop", "a" * 20_000]


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, "en", None if i % 5 == 0 else f"s{i % 3}", len(t or ""), "x", "y", 1)
           for i, t in enumerate(make_texts())]
    return [*out, out[6], out[6], (None, "no id", None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SHAPE).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.fixture(scope="module")
def labels(spark, rows):
    return spark.createDataFrame([(r[0], r[0] % 2, int(r[0] % 3 == 0)) for r in rows if r[0] is not None],
                                 "doc_id long, quality int, toxic int")


def stored(df, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "t")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def expect_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    return sorted((str(r[0]), max((x for x in groups[r[1] or ""] if x is not None), default=None),
                   len(groups[r[1] or ""])) for r in rows)


@pytest.mark.parametrize("clash", [False, True])
def test_exact_dedup(docs, rows, clash):
    # With a fingerprint of one bit, different chunks clash and must be told apart.
    option = {"fingerprint": lambda c: F.pmod(F.xxhash64(c), F.lit(2))} if clash else {}
    got = exact_dedup(docs, **option).collect()
    assert sorted((str(r.doc_id), r.keep_id, r.group_size) for r in got) == expect_exact(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_url_filter(spark):
    urls = ["http://A.example.com/en/1?x=/fr/", "https://www.example.com/en/", "http://b.net/es/x", "http://b.net/es",
            "b.net/es/x", "http://com", "http://xcom/", "ftp://com/x#y", None, "", "http://example.com/en/../", "a://b.net//fr/"]
    table = [(i, u, "h") for i, u in enumerate(urls)] + [(0, urls[0], "h"), (None, urls[2], None)]
    got = url_filter(spark.createDataFrame(table, "page_id long, url string, host string"),
                     spark.createDataFrame(RULES, "host string, path string, verdict string"))

    def judge(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        best = max(((len(h + p), h + p, v) for h, p, v in RULES
                    if (host == h or host.endswith("." + h)) and path.startswith(p)), default=(0, None, "allow"))
        return host, path, best[1], best[2]

    want = sorted(map(repr, ((i, *judge(u)) for i, u, _ in table)))
    assert sorted(repr(tuple(r)) for r in got.collect()) == want
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_filter(spark.createDataFrame(table, "page_id long, url string, host string"),
                                          none).collect()} == {"allow"}


def test_mixing(docs, rows):
    got = mix_documents(docs.select("doc_id", "text", "source")).collect()
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(r[0]), len(words(r[1]))) for r in rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = targets(sizes, {s: WEIGHTS[i % 3] for i, s in enumerate(names)}, sum(sizes.values()))
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert all(r.taken <= MAX_USES * r.size for r in got)
    taken = Counter()
    for r in got:
        taken[r.target] += r.taken
    assert all(abs(taken[t] - t) <= 300 for t in want.values())  # half a longest text at either end
    again = mix_documents(docs.select("doc_id", "text", "source")).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_mixing_flow_routes_shared_documents():
    # b's quota needs the shared documents, which a alone would use up too.
    flow = route({("a",): 10, ("a", "b"): 10, ("b",): 0}, {"a": 15, "b": 10})
    into, out = Counter(), Counter()
    for (p, s), n in flow.items():
        into[s] += n
        out[p] += n
    assert into == {"a": 15, "b": 10} and max(out.values()) <= 15
    assert sum(route({("a",): 10}, {"a": 99}).values()) == 30


def test_mixing_of_overlapping_sources(spark):
    table = spark.createDataFrame([(i, 10, ["a", "b"] if i % 2 else ["a"]) for i in range(40)],
                                  "doc_id long, size long, sources array<string>")
    got = mix(table, {"a": 1.0, "b": 1.0}).collect()
    taken = Counter()
    for r in got:
        assert sum(p["words"] for p in r.parts) <= 3 * r["size"]
        for p in r.parts:
            taken[p.source] += p["words"]
    assert abs(taken["a"] - 200) <= 20 and abs(taken["b"] - 200) <= 20


def test_packing_round_trip(docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in rows:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want[r[0], len(ids)] += len(ids)
    got = pack(docs.select("doc_id", "text", "lang"), tokenizer_path(), open_windows=2).collect()
    seen = Counter()
    for r in got:
        seen[r.doc_id, r.doc_tokens] += r.length
    assert seen == want
    texts = {r[0]: r[1] or "" for r in rows}
    for r in got:
        ids = np.array([*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 0], dtype="<u4")
        assert zlib.crc32(ids[r.start: r.start + r.length].tobytes()) == r.ids_crc32
    windows = defaultdict(list)
    for r in got:
        windows[r.sequence_id].append((r.offset, r.length))
    for w in windows.values():
        w.sort()
        assert [o for o, _ in w] == list(np.cumsum([0] + [n for _, n in w])[:-1])
        total = sum(n for _, n in w)
        assert total == 1024 or total & (total - 1) == 0


def test_near_dup(docs, rows):
    def shingles(text):
        w = words(text)
        return frozenset(tuple(w[k: k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()

    sets = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    root = {i: i for i in sets}
    for _ in sets:
        for a, x in sets.items():
            for b, y in sets.items():
                if x and 100 * len(x & y) >= 75 * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
    got = near_dup(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root[r.doc_id])
            assert r.kept == (r.doc_id == r.component_id)


def test_near_dup_finds_every_link_in_large_buckets(spark):
    # One passage in all texts; a third of them are near copies of each other.
    rng = np.random.default_rng(5)
    passage = " ".join(f"p{i}" for i in range(60))
    copy = " ".join(f"c{i}" for i in range(60))
    texts = [passage + " " + " ".join(f"r{rng.integers(1e9)}" for _ in range(30)) for _ in range(80)]
    texts += [passage + " " + copy + f" z{i}" for i in range(40)]
    got = near_dup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: min(i, 80) for i in range(120)}


def test_near_dup_links_across_blocks(spark, monkeypatch):
    # A chain of texts that differ in more and more words: most pairs are under the threshold, all are linked.
    base = [f"b{i}" for i in range(200)]
    texts = [" ".join([f"x{i}" for i in range(k)] + base[k:]) for k in range(0, 150, 10)]
    texts += [" ".join(f"y{i}" if i < 90 else w for i, w in enumerate(base))]  # alone: 0.37 with its nearest
    rows = [(i, t) for i, t in enumerate(texts)]
    monkeypatch.setattr("tessera.llm.near_dup.BLOCK_WEIGHT", 600)
    got = near_dup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {**dict.fromkeys(range(15), 0), 15: 15}


def test_super_minhash_estimates_jaccard():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 900).astype(np.uint64)
    x, y = np.unique(a[:800]), np.unique(a[100:])
    errors = []
    for k in range(30):
        s = super_minhash([x + np.uint64(k), y + np.uint64(k)])
        errors.append((s[0] == s[1]).mean() - 700 / 900)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.045


def test_embedding_dedup(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    vectors = [*base, *(base[:20] + 0.12 * rng.normal(size=(20, 16))), base[0], base[0] * 3]
    table = [(i, [float(v) for v in np.float32(x)], 0) for i, x in enumerate(vectors)]
    odd = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, [1.0, 2.0], 0),
           (904, [None] * 16, 0), (905, [], 0), (None, table[0][1], 0)]
    got = embedding_dedup(spark.createDataFrame(table + odd, "vec_id long, embedding array<float>, links int"),
                          slice_rows=16).collect()
    x = np.array([v for _, v, _ in table], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    root = np.arange(len(x))
    for _ in x:
        for a, b in zip(*np.nonzero(near)):
            root[a] = root[b] = min(root[a], root[b])
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert len(got) == len(table) + len(odd)
    for i in range(len(x)):
        assert found[i] == (near[i].sum(), root[i], root[i] == i)
    for i, _, _ in odd:
        assert found[i] == (0, i, True)


def test_lm_score(docs, rows, tmp_path_factory):
    got = lm_score(stored(docs, tmp_path_factory)).collect()
    assert len(got) == len(rows)
    fold = {r[0]: zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 10 for r in rows}
    count = Counter()
    for r in rows:
        if fold[r[0]]:
            count.update([*words(r[1]), None])
    n, v = sum(count.values()), len(count)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        tokens = [*words(texts[r.doc_id]), None]
        base = sum(math.log10((count[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            fold[r.doc_id] == 0, len(tokens), sum(count[t] > 0 for t in tokens), n)
        assert r.base_score == pytest.approx(base) and r.score < 0


def test_learned_weights_raise_the_likelihood():
    events = [(3, 40, 20, 90), (3, -999, 20, 10), (1, -999, -999, 5)]
    w = learn_weights(events)
    assert w[3][0] > 0.5 and w[1][2] == pytest.approx(1, abs=1e-5)
    assert all(x.sum() == pytest.approx(1) for x in w.values())


def test_trained_scores_cover_every_row(docs, rows, labels):
    for got in (quality_scores(docs, labels), toxicity_scores(docs, labels)):
        found = got.collect()
        assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows)
        assert all(0 <= r.score <= 1 for r in found)


def test_trained_scores_without_labels(docs, labels):
    for got in (quality_scores(docs, labels.limit(0)), toxicity_scores(docs, labels.limit(0))):
        assert all(r.score == pytest.approx(0.5) for r in got.collect())


def test_secret_scan(spark):
    seen = Observation()  # a session that has observed metrics
    assert spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).count() == 3 and seen.get["n"] == 3
    texts = [f'the value token = "{"%040x" % (i * 7919 ** 9)}" and number 4{i:015d} is here' for i in range(1, 61)]
    table = [(i, "a/b.txt", t) for i, t in enumerate(texts)] + [(900, None, None), (901, "x", ""), (None, "x", texts[0])]
    got = secret_scan(spark.createDataFrame(table, "doc_id long, source string, text string"), trees=5).collect()
    kept = Counter((r.held_out, r.kept, len(r.candidate)) for r in got)
    assert len(got) == 2 * 61
    assert all((length == 40) == keep for _, keep, length in kept)


def test_empty_tables(spark, empty, labels):
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for df in (exact_dedup(empty), near_dup(empty), lm_score(empty), pack(empty, tokenizer_path()),
               mix_documents(empty), quality_scores(empty, labels), toxicity_scores(empty, labels),
               secret_scan(empty), embedding_dedup(vectors)):
        assert df.count() == 0


def test_packing_ids_are_those_of_the_plain_call(monkeypatch, sf001):
    """Also for texts that hold an added token, and over caches that fill up
    again and again."""
    import pyarrow.dataset
    from tokenizers import Tokenizer

    from tessera.llm import packing

    monkeypatch.setattr(packing, "CACHE", 500)
    encoder, plain = packing.Encoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    texts = [t for t in pyarrow.dataset.dataset(f"{sf001}/documents.parquet").to_table()["text"].to_pylist() if t]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "a<|endoftext|>", "<|endoftext|><|endoftext|> x\n", "<|endoftext", "",
              " lead", "trail ", "two  gaps", "a\n\nb", "don't stop", "é日本 x", "tab\tx", "1234 5", "end.\nStart"]
    assert plain.encode(texts[-15], add_special_tokens=False).ids.count(50256) == 1
    for text, ids in zip(texts, encoder.ids(texts)):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
    assert max(len(c) for r in (encoder.parts, encoder.words) for c in (r.young, r.old)) < 500 + max(map(len, texts))
