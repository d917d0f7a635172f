"""Dense surrogate keys: exactly 1..N in natural-key order, whatever the
number of range partitions, with no single-partition window over the keys."""
import pytest
from pyspark.sql import functions as F

from tessera.operators.keys import dense_key, dense_key_single_task


@pytest.mark.parametrize("parts", [1, 3, 8, 64])
def test_int_keys(spark, parts):
    base = spark.range(0, 3000, 7).select((F.col("id") * 13 % 10007).cast("int").alias("k"),
                                          F.lit("v").alias("payload")).distinct()
    got = dense_key(base, "k", "key", partitions=parts)
    want = dense_key_single_task(base, "k", "key")
    assert got.columns == ["k", "payload", "key"]
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    keys = sorted(r["key"] for r in got.select("key").collect())
    assert keys == list(range(1, base.count() + 1))


def test_string_and_null_keys(spark):
    vals = ["b", "a", None, "UNKNOWN", "c", "ASIA"]
    base = spark.createDataFrame([(v,) for v in vals], "name string")
    got = {r["name"]: r["key"] for r in dense_key(base, "name", "key", partitions=4).collect()}
    assert got == {None: 1, "ASIA": 2, "UNKNOWN": 3, "a": 4, "b": 5, "c": 6}


def test_empty_input(spark):
    base = spark.createDataFrame([], "k int")
    assert dense_key(base, "k", "key", partitions=4).count() == 0


def test_plan_range_partitions_keys(spark):
    base = spark.range(1000).select(F.col("id").cast("int").alias("k"))
    plan = dense_key(base, "k", "key", partitions=8, checkpoint=False) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan.lower()
    # The only window left is the running sum over the per-partition sizes.
    assert "row_number" not in plan.lower()


def test_default_partitions_are_coalesced_and_ordered(spark):
    """No fixed count: AQE merges the range partitions of a small key set and
    the keys stay 1..N in order."""
    base = spark.range(0, 500).select((F.col("id") * 7919 % 500).cast("int").alias("k"))
    got = dense_key(base, "k", "key")
    assert sorted((r["k"], r["key"]) for r in got.collect()) == [(i, i + 1) for i in range(500)]


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None)
@given(st.sets(st.integers(-10**9, 10**9), max_size=60), st.integers(1, 12))
def test_dense_key_property(spark, keys, parts):
    base = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r["k"]: r["key"] for r in dense_key(base, "k", "key", partitions=parts).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_beyond_an_int_raise(spark, ansi):
    from tessera.operators.keys import checked_int

    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        low, high = -(1 << 31), (1 << 31) - 1
        fine = spark.createDataFrame([(low,), (high,), (None,)], "v long").select(checked_int(F.col("v"), "key").alias("k"))
        assert [r.k for r in fine.collect()] == [low, high, None] and dict(fine.dtypes)["k"] == "int"
        for v in (low - 1, high + 1):
            with pytest.raises(Exception, match="key does not fit an int"):
                spark.createDataFrame([(v,)], "v long").select(checked_int(F.col("v"), "key")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
