"""The registered queries on sf0.001 against their SQL, and the pipeline."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm import queries
from tessera.llm.common import table


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, sf001, name):
    got = queries.QUERIES[name](spark, sf001).toPandas()
    db = duckdb.connect()
    for t in ("documents", "pages"):
        db.execute(f"create view {t} as select * from '{sf001}/{t}.parquet'")
    want = db.execute(queries.SQL[name]).fetchdf()
    order = list(want.columns[:2])
    got, want = (x.sort_values(order).reset_index(drop=True).astype(object).where(x.notna(), None)[list(want.columns)]
                 for x in (got.sort_values(order), want.sort_values(order)))
    assert got.equals(want)


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_pipeline(spark, sf001):
    docs = table(spark, sf001, "documents")
    columns, kept = docs.columns, docs
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dup", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES[:3]:
        before, kept = kept, corpus_pipeline.store(stage(spark, kept, sf001))
        assert kept.columns == columns
        assert kept.join(before, "doc_id", "left_anti").count() == 0
    texts = [r.text for r in kept.collect()]
    assert len(texts) == len(set(texts))
