"""Rows without an id and different texts of one id are documents of their own."""

import corpus_pipeline
from tessera.llm.near_dup import near_dup

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def text(word, n=40):
    return " ".join(f"{word}{i}" for i in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SHAPE).repartition(3)


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


ROWS = [(None, text("a")), (None, text("b")), (None, text("b")), (None, text("c")), (5, text("d")), (5, text("e")),
        (7, text("d")), (5, text("f")), (5, text("f")), (8, text("c"))]
ONCE = [(None, text("a")), (None, text("b")), (8, text("c")), (7, text("d")), (5, text("e")), (5, text("f"))]


def test_exact_stage(spark):
    assert kept(corpus_pipeline.exact(spark, frame(spark, ROWS), "")) == sorted(ONCE, key=repr)


def test_near_stage(spark):
    # 3 comes before one text of 5, another text of 5 before 9; a row without an id gives way to 8.
    rows = [*ONCE, (3, text("e") + " z"), (9, text("f") + " z"), (None, text("c") + " z"), (None, text("b") + " z")]
    want = [(None, text("a")), (8, text("c")), (7, text("d")), (3, text("e") + " z"), (5, text("f"))]
    got = kept(corpus_pipeline.near(spark, frame(spark, rows), ""))
    of_b = [r for r in got if r[1].startswith("b0")]
    assert len(of_b) == 1 and of_b[0][0] is None
    assert [r for r in got if r not in of_b] == sorted(want, key=repr)


def test_quality_stage(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: None)
    monkeypatch.setattr(corpus_pipeline, "fit_quality", lambda *_: None, raising=False)
    monkeypatch.setattr(corpus_pipeline, "quality_scores", lambda docs, *_, **__: docs.selectExpr(
        "doc_id", "text not like 'a%' and text not like 'd%' as kept"))
    got = kept(corpus_pipeline.quality(spark, frame(spark, ROWS), ""))
    assert got == sorted((r for r in ROWS if r[1][0] not in "ad"), key=repr)


def test_mixture_stage(spark):
    # One source: every document once, none once per row that shares its id.
    assert kept(corpus_pipeline.mixture(spark, frame(spark, ONCE), "")) == sorted(ONCE, key=repr)


def test_near_dup_keeps_the_links_of_every_text_of_an_id(spark):
    rows = [(1, text("x")), (1, text("y")), (2, text("x") + " z"), (3, text("y") + " z"), (0, text("y") + " v"),
            (4, text("w")), (4, text("w") + " z")]
    got = near_dup(frame(spark, rows).select("doc_id", "text")).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [
        (0, 0, True), (1, 0, False), (1, 1, True), (2, 1, False), (3, 0, False), (4, 4, True), (4, 4, True)]
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
