"""Shape of the physical plans on the driver tables."""

from __future__ import annotations

import re

import pytest

from casario.operators import shares
from casario.plans import layers, report
from casario.plans.warehouse import bucketed_silver
from workload import inputs
from workload.queries import queries

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def whole_plan(spark):
    """Plan without adaptive execution, which shows reuse before anything runs."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield plan
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def exchanges(text: str) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", text))


def test_gold(spark):
    text = plan(inputs.gold_listings(spark, SF))
    assert text.count("WindowGroupLimit") == 4  # before and after each of two shuffles
    assert exchanges(text) == 2
    assert "BroadcastHashJoin [lower(localizacao" in text


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(queries()[name](spark, SF))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "RoundRobinPartitioning"):
        assert operator not in text, operator


def test_silver_is_shuffled_once(spark):
    text = plan(bucketed_silver(layers.bronze(inputs.listings_raw(spark, SF)), 16))
    assert "hashpartitioning(id" in text and len(re.findall(r"Exchange hashpartitioning\(id#\d+, 16\)", text)) == 1
    assert exchanges(text) == exchanges(plan(inputs.listings_raw(spark, SF))) * 2 + 2  # the second: one row per task and month


def test_nameless_listings_are_found_by_the_scan(spark, tmp_path):
    inputs.listings_raw(spark, SF).write.parquet(str(tmp_path / "raw"))
    text = bucketed_silver(layers.bronze(spark.read.parquet(str(tmp_path / "raw"))), 16)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", text)
    assert len(scans) == 2 and "Or(" in scans[1] and "IsNull(preco)" in scans[1] and "IsNotNull(preco)" in scans[0]
    assert text.count("sha2") == 2


def test_scans_read_only_needed_columns(spark):
    text = plan(queries()["extract_listings"](spark, SF))
    assert "c_acctbal" not in text and "p_name" not in text


def test_mart_reads_its_input_once(spark, whole_plan):
    text = whole_plan(layers.mart_tipo(inputs.gold_listings(spark, SF)))
    assert text.count("FileScan parquet [l_orderkey") == 1
    assert text.count("ReusedExchange") >= 2
    assert "ObjectHashAggregate" not in text


def test_mart_shuffles_its_listings_once_and_unstacked(spark, tmp_path, whole_plan):
    inputs.gold_listings(spark, SF).write.parquet(str(tmp_path / "gold"))
    text = whole_plan(layers.mart_tipo(spark.read.parquet(str(tmp_path / "gold"))))
    # The first exchange has a row per listing at most; the measures are parted after it.
    first = text[: text.rindex("FileScan parquet")]
    below = first[first.rindex("Exchange hashpartitioning") :]
    assert "preco#" in below and "m2#" in below and "Generate" not in below and "partial_count" in below


def test_description_reads_its_input_once(spark, whole_plan):
    text = whole_plan(report.describe_price(inputs.gold_listings(spark, SF)))
    assert text.count("FileScan parquet [l_orderkey") == 1


def test_shares_read_their_input_once(spark, whole_plan):
    text = whole_plan(shares(inputs.gold_listings(spark, SF), "tipo"))
    assert text.count("FileScan parquet [l_orderkey") == 1


def test_month_filter_reaches_the_mart_scan(spark, tmp_path):
    layers.mart_localizacao(inputs.gold_listings(spark, SF), min_listings=0).write.parquet(str(tmp_path / "m"))
    mart = spark.read.parquet(str(tmp_path / "m"))
    text = plan(report.movers(mart, "1997-05"))
    assert "EqualTo(date_ref,1997-05)" in text and "TakeOrderedAndProject" in text


def test_lines_are_shuffled_for_orders_and_parts_only(spark, whole_plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = whole_plan(inputs.listings_raw(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Below an exchange by customer there are orders only.
    above = text[: text.index("FileScan parquet [l_orderkey")]
    assert above.count("Exchange hashpartitioning") == 2 and "hashpartitioning(o_custkey" not in above
