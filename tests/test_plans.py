"""Plans: what reaches the scans, what is shuffled, and what happens when nothing may be broadcast."""

import os
from contextlib import contextmanager

import pytest

from catalog import queries
from catalog.adapter import AS_OF, Feed
from catalog.compare import compare, connect
from returnsmith.operators.lookup import lookup
from returnsmith.plans import reports
from returnsmith.plans.positions import enrich_positions
from returnsmith.session import scratch_path
from returnsmith.sources import warehouse

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@contextmanager
def setting(spark, **conf):
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_enrichment_shuffles_nothing(spark):
    feed = Feed(spark, FOLDER)
    path = scratch_path(spark, "positions")
    feed.table("positions").write.parquet(path)
    shown = plan(enrich_positions(spark.read.parquet(path), feed.dims()))
    assert "Exchange hashpartitioning" not in shown and "SortMergeJoin" not in shown
    assert "CartesianProduct" not in shown and "NestedLoop" not in shown and "Python" not in shown


def test_dates_and_columns_reach_the_scan(spark):
    path = scratch_path(spark, "customers")
    Feed(spark, FOLDER).table("wh_customer").write.parquet(path)
    shown = warehouse.valid_at(spark.read.parquet(path), AS_OF).select("customer_nr")
    text = shown._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "LessThanOrEqual(start_validity_date" in text and "GreaterThanOrEqual(end_validity_date" in text
    assert "domicile" not in text


def test_reports_scan_their_columns_and_combine_before_the_shuffle(spark):
    path = scratch_path(spark, "enriched")
    feed = Feed(spark, FOLDER)
    enrich_positions(feed.table("positions"), feed.dims()).write.parquet(path)
    shown = plan(reports.asset_lines(spark.read.parquet(path)))
    assert "customer_legal_name" not in shown and shown.count("HashAggregate") == 2 and "SortAggregate" not in shown


@pytest.mark.parametrize("name", ["map_chain", "jn_position_trn", "pos_risk_transfer", "facility_enriched", "rec_gl_full"])
def test_same_results_without_any_broadcast(spark, name):
    with setting(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        assert "BroadcastHashJoin" not in plan(queries.runnable(queries.QUERIES["map_chain"])(spark, FOLDER))
        count, differences = compare(spark, connect(FOLDER), FOLDER, name)
    assert count > 0 and not differences


@pytest.mark.parametrize("null_safe", [True, False])
def test_a_hot_key_is_split(spark, null_safe):
    key = "CASE WHEN id % {} = 0 THEN 'hot' ELSE CAST(id AS string) END AS k"
    data = spark.range(300000, numPartitions=8).selectExpr("id", key.format(3), "uuid() AS filler")
    dim = spark.range(600000).selectExpr("id AS seq", key.format(600000), "id AS v")
    with setting(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
                 spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200KB",
                 spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
                 spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB"):
        found = lookup(data, dim, {"k": "k"}, {"v": "v"}, match_flag="hit", null_safe=null_safe)
        table = found.toArrow()
        assert "skew=true" in plan(found)
    hot = [v for k, v in zip(table.column("k").to_pylist(), table.column("v").to_pylist()) if k == "hot"]
    assert table.num_rows == 300000 and len(hot) == 100000 and set(hot) == {0}
