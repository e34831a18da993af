"""Queries over own small tables: whole results, and plans that move large tables as little as possible."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from replenish.fixtures import adapters as fx
from replenish.fixtures.queries import QUERIES, Frames
from replenish.operators import backtest, scale

FIRST = datetime(2000, 1, 1)
PAIR = ["article_id", "branch_id"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """420 days of sales of two parts from two suppliers, and the orders they belong to."""
    at = str(tmp_path_factory.mktemp("tables"))
    lines = [
        (day // 3, 1 + day % 2, 1 + day % 3 % 2, 1 + day % 3, 3.0 + day % 5, 30.0 + day % 7, 0.01 * (day % 11),
         "R" if day % 9 == 0 else "N", "F" if day % 2 else "O", FIRST + timedelta(days=day))
        for day in range(420)
    ]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, "
                     "l_shipdate timestamp_ntz"),
        "part": ([(1, "Brand#1", 5), (2, "Brand#2", 9)], "p_partkey long, p_brand string, p_size int"),
        "supplier": ([(1, 3), (2, 4)], "s_suppkey long, s_nationkey int"),
        "nation": ([(n,) for n in range(5)], "n_nationkey int"),
        "orders": ([(n, "OFP"[n % 3], ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")[n % 4], FIRST + timedelta(days=3 * n))
                    for n in range(140)],
                   "o_orderkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    return at


@pytest.fixture
def no_automatic_broadcast(spark):
    """Plans as for tables whose files are beyond the size that Spark broadcasts by itself."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_rolling_backtest_returns_every_case(spark, folder):
    frames = Frames.of(spark, folder)
    cases = backtest.rolling(frames.history_panel, frames.pairs, frames.every_date)
    keys = ["business_date", "evaluation_date", *PAIR]
    found = QUERIES["backtest_rolling"](spark, folder).select(*keys, "status", "squared_error").collect()
    wanted = cases.select(*keys, "status", F.round(F.col("squared_error").cast("double"), 8)).collect()
    assert len(found) > 20 and sorted(map(tuple, found)) == sorted(map(tuple, wanted))


@pytest.mark.usefixtures("no_automatic_broadcast")
def test_sales_meet_their_masters_without_a_move(spark, folder):
    found = plan(fx.raw_sales(spark, folder))
    assert "SortMergeJoin" not in found and found.count("BroadcastHashJoin") == 2
    assert found.count("Exchange hashpartitioning") <= 1  # the spreading of a small file


@pytest.mark.usefixtures("no_automatic_broadcast")
def test_directed_needs_move_the_lines_once(spark, folder):
    found = plan(fx.directed_needs(spark, folder))
    # The lines, and the orders that they meet.
    assert found.count("Exchange hashpartitioning") == 2


@pytest.mark.usefixtures("no_automatic_broadcast")
@pytest.mark.parametrize("source", [fx.raw_sales, fx.enriched_sales, fx.directed_needs])
def test_masters_beyond_a_broadcast_give_the_same_sales(spark, folder, source, monkeypatch):
    wanted = sorted(map(str, source(spark, folder).collect()))
    monkeypatch.setattr(fx, "is_bounded", lambda rows: False)
    moved = source(spark, folder)
    assert "BroadcastHashJoin" not in plan(moved)
    assert wanted and sorted(map(str, moved.collect())) == wanted


@pytest.mark.usefixtures("no_automatic_broadcast")
def test_lines_are_not_sorted_to_meet_parts_beyond_a_broadcast(spark, folder, monkeypatch):
    monkeypatch.setattr(fx, "is_bounded", lambda rows: rows.columns[0] != "p_partkey")
    found = plan(fx.raw_sales(spark, folder))
    assert "ShuffledHashJoin" in found and "Sort " not in found
    monkeypatch.setattr(scale, "is_bounded", lambda *_: False)
    assert "SortMergeJoin" in plan(fx.raw_sales(spark, folder))


def test_tasks_of_the_directed_lines_are_bounded_in_rows(spark, folder, monkeypatch):
    wanted = sorted(map(str, fx.directed_needs(spark, folder).collect()))
    monkeypatch.setattr(scale, "TASK_ROWS", 10)
    found = fx.directed_needs(spark, folder)
    assert "hashpartitioning(l_orderkey" in plan(found) and ", 42), REPARTITION_BY_NUM" in plan(found)
    assert wanted and sorted(map(str, found.collect())) == wanted


def test_lines_of_one_row_group_are_spread_whatever_the_splits(spark, folder, tmp_path, monkeypatch):
    """One row group is read by one task, though the scan of its file has a split for every core."""
    rows, cores = 160_000, spark.sparkContext.defaultParallelism
    lines = spark.range(rows).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.xxhash64("id").alias("l_partkey")
    )
    for files in (1, 2 * cores):
        lines.repartition(files).write.parquet(f"{tmp_path}/{files}/lineitem.parquet")
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "32k")
    try:
        one, many = (fx.table(spark, f"{tmp_path}/{files}", "lineitem") for files in (1, 2 * cores))
        assert one.rdd.getNumPartitions() >= cores
        assert not scale.is_even(one) and scale.is_even(many)
        monkeypatch.setattr(scale, "TASK_ROWS", 4_000)
        spread = fx._lines(spark, f"{tmp_path}/1")
        held = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(held) == rows and len(held) == rows // 4_000 and max(held) < 8_000
        assert "Exchange" not in plan(fx._lines(spark, f"{tmp_path}/{2 * cores}"))
    finally:
        spark.conf.set(name, before)
    assert scale.is_even(lines.limit(0))
