"""What the physical plans must look like."""

import re

from conftest import DATA
from pyspark.sql import functions as F

from epitide.operators import merge, repair
from epitide.plans import Tables, inputs


def physical(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_merge_shuffles_once_for_many_sources(spark):
    base = spark.range(100).select(F.col("id").alias("entity"), F.lit(1.0).alias("value"))
    plan = physical(merge.priority_merge(merge.stack_sources(*[base] * 6), ["entity"]))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_repair_chain_shuffles_once(spark):
    panel = spark.createDataFrame([("a", 1)], "entity string, n int").select(
        "entity", F.current_date().alias("date"), F.col("n").cast("double").alias("value"))
    plan = physical(repair.cumulative_to_daily(panel, ["entity"]))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert len(re.findall(r"\bSort \[", plan)) == 1


def test_filters_and_columns_reach_the_scan(spark):
    t = Tables(spark, DATA)
    plan = inputs.placed_orders(t).filter("status = 'F'").groupBy("entity").agg(F.sum("amount"))._jdf.queryExecution().toString()
    scan = [line for line in plan.split("\n") if "FileScan parquet" in line and "o_totalprice" in line][-1]
    assert "EqualTo(o_orderstatus,F)" in scan
    assert "o_orderkey" not in scan and "o_orderpriority" not in scan
