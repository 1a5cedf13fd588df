"""Plan shapes: what must be pushed down, shared or pruned (products and Python workers are refused in ``suite.check``)."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from regionlake.operators import quantiles
from regionlake.operators.spatial import cell_index, within_radius
from regionlake.operators.windows import latest_per_key, rolling_mean
from regionlake.plans import silver
from suite import domain as D
from suite.joins import shapes

SF = "/root/testdata/sf0.001"
def plan(df, executed=False):
    if executed:
        df.write.format("noop").mode("overwrite").save()
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def long_scan_lines(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def final_plan(df):
    return plan(df, executed=True).split("== Initial Plan ==")[0]


def test_second_median_pass_scans_once(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    medians = {"m": "l_extendedprice", "q": "l_quantity"}
    bounds = spark.createDataFrame([("A", (9, 1.0, 1e6), (9, 0.0, 60.0))], "l_returnflag string, _b_m struct<n: long, lo: double, hi: double>, _b_q struct<n: long, lo: double, hi: double>")
    text = final_plan(quantiles.bracketed(df, bounds, ["l_returnflag"], medians, 4))
    assert "ReusedExchange" in text and text.count("FileScan") == 1


def test_medians_evaluate_their_rows_once_or_twice(spark):
    """No count before, one pass for small groups, one more for large ones."""
    seen = spark.sparkContext.accumulator(0)
    rows = spark.sparkContext.parallelize([(i % 2, float(i)) for i in range(2000)], 2).map(lambda r: (seen.add(1), r)[1])
    df = spark.createDataFrame(rows, "k int, v double")
    for group_rows, passes in ((quantiles.EXACT_ROWS, 1), (10, 2)):
        before = seen.value
        assert sorted(tuple(r) for r in quantiles.group_medians(df, ["k"], {"m": "v"}, group_rows=group_rows).collect()) == [(0, 999.0), (1, 1000.0)]
        assert seen.value - before == passes * 2000


def test_latest_rows_are_not_sorted(spark):
    text = final_plan(latest_per_key(D.readings(spark, SF), ["arrondissement"], ["ingested_at", "event_id"]))
    assert "SortAggregate" not in text
    for name in ("w03_latest_reading", "route_air_readings", "route_air_alerts"):
        if name in entry.queries():
            assert "SortAggregate" not in final_plan(entry.queries()[name](spark, SF)), name


def test_no_polygon_is_grouped_whole(spark):
    index, _ = cell_index(shapes(spark, SF))
    assert re.findall(r"hashpartitioning\((\w+)#\w+, (\w+)#", plan(index)) == [("_cx", "_cy"), ("arrondissement", "_cy")]



def test_rolling_changes_are_shared(spark):
    df = D.readings(spark, SF).select("event_id", "arrondissement", "iqa", "ingested_at")
    text = final_plan(rolling_mean(df, "arrondissement", "ingested_at", "iqa", "m"))
    assert "ReusedExchange" in text and text.count("FileScan") == 2  # the rows and their changes


def test_cleaning_predicates_reach_the_scan(spark, tmp_path):
    D.landed_sales(spark, SF).write.parquet(str(tmp_path / "landed"))
    df = silver.sales(spark.read.parquet(str(tmp_path / "landed")))
    text = plan(df)
    assert "EqualTo(nature_mutation,Vente)" in text and "StringStartsWith(code_postal,750)" in text
    df.write.parquet(str(tmp_path / "silver"))
    stored = spark.read.parquet(str(tmp_path / "silver")).withColumn("id", F.lit(1))
    near = plan(within_radius(stored, 48.86, 2.34, 500))
    assert "GreaterThanOrEqual(latitude" in near and "TakeOrderedAndProject" in near


@pytest.mark.parametrize("name,columns", [
    ("a04_class_counts", "struct<c_nationkey:int,c_mktsegment:string>"), ("a10_source_summary", "struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>"),
])
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: {columns}" in plan(entry.queries()[name](spark, SF))
