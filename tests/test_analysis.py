"""Report operators against plain Python on random fact rows."""
from decimal import Decimal

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tessera.operators import analysis

fact_rows = st.lists(st.tuples(st.integers(1, 6), st.integers(1, 4),
                               st.sampled_from(["1.00", "2.50", "0.01", "100.00", "3.33"])),
                     min_size=1, max_size=40)
FACT = "product_key int, quantity int, total_amount decimal(18,2)"


@settings(max_examples=10, deadline=None)
@given(fact_rows)
def test_reports_match_python(spark, rows):
    data = [(k, q, Decimal(a)) for k, q, a in rows]
    fact = spark.createDataFrame(data, FACT)
    dim = spark.createDataFrame([(k, f"p{k}") for k in range(1, 7)], "product_key int, product_name string")

    k = analysis.kpis(fact).first()
    revenue = sum(a for _, _, a in data)
    assert (k["sales"], k["units"], k["revenue"]) == (len(data), sum(q for _, q, _ in data), revenue)
    assert k["avg_basket"] == (revenue / len(data)).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")

    per = {}
    for key, q, a in data:
        s, u, r = per.get(key, (0, 0, Decimal(0)))
        per[key] = (s + 1, u + q, r + a)
    got = {r["product_key"]: (r["sales"], r["units"], r["revenue"]) for r in
           analysis.by_key(fact, dim, "product_key").collect()}
    assert got == per

    top = [r["product_key"] for r in analysis.top_by_revenue(fact, dim, "product_key", n=3).collect()]
    want = sorted(per, key=lambda key: (-per[key][2], key))[:3]
    assert sorted(top) == sorted(want)


def test_sales_without_a_known_date_stay_in_the_totals(spark):
    fact = spark.createDataFrame(
        [(1, 20240101, 1, 2, "3.00"), (2, None, 1, 1, "5.00"), (3, 20990101, 1, 1, "7.00")],
        "sale_id int, date_key int, region_key int, quantity int, total_amount string").withColumn(
        "total_amount", F.col("total_amount").cast("decimal(18,2)"))
    dates = spark.createDataFrame([(20240101, 2024, 1, 1)], "date_key int, year int, quarter int, month int")
    regions = spark.createDataFrame([(1, "NORTH")], "region_key int, region_name string")
    total = analysis.kpis(fact).first().revenue
    assert sum(r.revenue for r in analysis.by_month(fact, dates).collect()) == total
    cube = analysis.region_year_cube(fact, regions, dates).where("grouping_level = 3").first()
    assert cube.revenue == total and cube.sales == 3
