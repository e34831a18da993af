"""Estimate and backtest on hand-made panels."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from replenish.functions import windows
from replenish.operators import backtest, demand
from replenish.operators.demand import RunIds
from replenish.params import DemandParams

T = date(2026, 8, 3)
W = windows.build(T)
IDS = RunIds("run", "model", "scope")
PANEL = (
    "sales_date date, article_id int, branch_id int, basal_units decimal(18,6), "
    "observed_units decimal(18,6), eligible boolean, source_row_count bigint, "
    "promo_adjustment_method string, source_hash string"
)


def days(article, span, units, count=None, eligible=True):
    """Panel rows from the end of a span backwards."""
    count = span.days if count is None else count
    return [
        (span.end - timedelta(days=n), article, 5, Decimal(units), Decimal(units), eligible, 1,
         "NO_ADJUSTMENT", f"h{n}")
        for n in range(count)
    ]


@pytest.fixture(scope="module")
def rows():
    return [
        *days(1, W.recent, 2), *days(1, W.previous, 3), *days(1, W.seasonal, 1),
        *days(2, W.recent, 2), *days(2, W.seasonal, 1),
        *days(3, W.recent, 2), *days(3, W.previous, 3),
        *days(4, W.recent, 2),
        *days(5, W.recent, 2, 6), *days(5, W.previous, 3),
        *days(6, W.recent, 0), *days(6, W.previous, 0), *days(6, W.seasonal, 0),
        *days(7, W.recent, 4, 14), *days(7, W.previous, 4, 14, eligible=False),
        *days(7, W.seasonal, 4),
    ]


@pytest.fixture(scope="module")
def panel(spark, rows):
    return spark.createDataFrame(rows, PANEL)


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(
        [(a, 5, 70) for a in range(1, 9)], "article_id int, branch_id int, supplier_id int"
    )


def by_article(frame):
    return {r["article_id"]: r for r in frame.collect()}


def test_golden_estimates(panel, pairs):
    got = by_article(demand.estimate(panel, pairs, W, IDS))
    shown = {
        a: (r["basal_daily_demand"], r["status"], r["method_code"], r["fallback_level"])
        for a, r in got.items()
    }
    assert shown[1] == (Decimal("2.1"), "OK", "SKU_BRANCH_WEIGHTED", 0)
    assert shown[2] == (Decimal("1.8"), "WARN", "SKU_BRANCH_WEIGHTED", 0)
    assert shown[3] == (Decimal("2.294118"), "WARN", "SKU_BRANCH_WEIGHTED", 1)
    assert shown[4] == (Decimal("2"), "WARN", "SKU_BRANCH_RECENT", 2)
    assert shown[5] == (None, "BLOCKED", "INSUFFICIENT_DATA", 9)
    assert shown[6] == (Decimal(0), "ZERO_VALID", "SKU_BRANCH_WEIGHTED", 0)
    # A pair without any panel row is blocked with zero coverage.
    assert shown[8] == (None, "BLOCKED", "INSUFFICIENT_DATA", 9)
    assert got[8]["active_days"] == 0 and got[8]["confidence_score"] == 0
    assert (got[3]["recent_weight"], got[3]["previous_weight"]) == (
        Decimal("0.705882"), Decimal("0.294118"),
    )
    assert got[7]["eligible_days"] == 42 and got[7]["active_days"] == 56
    assert got[7]["availability_coverage"] == Decimal("0.75")


def test_diagnostics(spark, pairs):
    units = [1, 2, 3, 0] * 7
    rows = [
        (W.recent.end - timedelta(days=n), 1, 5, Decimal(u), Decimal(u), True, 1, "ENRICHED", "h")
        for n, u in enumerate(units)
    ]
    got = by_article(demand.estimate(spark.createDataFrame(rows, PANEL), pairs, W, IDS))[1]
    assert got["adi"] == Decimal("1.333333") and got["promo_coverage"] == 1
    # 21 nonzero days of 1, 2, 3: variance 0.7, mean 2.
    assert got["cv2"] == Decimal("0.175")


def test_checksum_depends_on_the_features(panel, pairs):
    one = by_article(demand.estimate(panel, pairs, W, IDS))
    changed = panel.withColumn(
        "source_hash", F.when(F.col("article_id") == 1, "other").otherwise(F.col("source_hash"))
    )
    two = by_article(demand.estimate(changed, pairs, W, IDS))
    assert one[1]["input_checksum"] != two[1]["input_checksum"]
    assert one[2]["input_checksum"] == two[2]["input_checksum"]


def test_rolling_equals_single_estimates_on_a_sparse_panel(spark, panel, pairs):
    sparse = panel.filter(F.dayofmonth("sales_date") % 5 != 0)
    dates = [T, T - timedelta(days=1), T - timedelta(days=17)]
    rolled = demand.rolling(sparse, pairs, dates)
    columns = [
        "article_id", "recent_mean", "previous_mean", "seasonal_mean", "basal_daily_demand",
        "status", "method_code", "active_days", "eligible_days", "nonzero_days", "cv2", "adi",
        "promo_coverage", "recent_weight",
    ]
    for day in dates:
        single = demand.score(demand.window_stats(sparse, pairs, windows.build(day)))
        a = sorted(map(tuple, single.select(*columns).collect()))
        b = sorted(map(tuple, rolled.filter(F.col("business_date") == day).select(*columns).collect()))
        assert a == b


def test_rolling_sees_nothing_after_the_cutoff(spark, panel, pairs):
    future = spark.createDataFrame(
        [(T + timedelta(days=n), 1, 5, Decimal(999), Decimal(999), True, 1, "ENRICHED", "f")
         for n in range(3)], PANEL,
    )
    before = by_article(demand.rolling(panel, pairs, [T]))[1]["basal_daily_demand"]
    after = by_article(demand.rolling(panel.unionByName(future), pairs, [T]))[1]
    assert after["basal_daily_demand"] == before


def test_parameters_are_checked():
    with pytest.raises(ValueError):
        DemandParams(recent_weight=Decimal(0), previous_weight=Decimal(0), seasonal_weight=Decimal(0))
    with pytest.raises(ValueError):
        DemandParams(recent_days=0)


def test_network_fallback_needs_enough_peers(spark):
    rows = [(T, "run", 1, b, "OK", Decimal(b)) for b in (1, 2, 3)] + [
        (T, "run", 1, 9, "BLOCKED", None), (T, "run", 2, 9, "BLOCKED", None),
    ]
    frame = spark.createDataFrame(
        rows, "business_date date, run_id string, article_id int, branch_id int, status string, "
        "basal_daily_demand decimal(18,6)",
    ).withColumns({
        "raw_demand": F.col("basal_daily_demand"), "method_code": F.lit("x"),
        "fallback_level": F.lit(9).cast("smallint"),
    })
    got = {(r["article_id"], r["branch_id"]): r for r in demand.network_fallback(frame).collect()}
    assert got[1, 9]["basal_daily_demand"] == 2 and got[1, 9]["status"] == "WARN"
    assert got[2, 9]["status"] == "BLOCKED"


def shrunk(spark, peers, blocked):
    """Estimates of an article from the daily units of its branches: value and status by branch."""
    frame = spark.createDataFrame(
        [(T, "run", a, b, status, None) for a, b, status, _ in peers + blocked],
        "business_date date, run_id string, article_id int, branch_id int, status string, "
        "basal_daily_demand decimal(18,6)",
    ).withColumns({
        "raw_demand": F.col("basal_daily_demand"), "method_code": F.lit("x"),
        "fallback_level": F.lit(9).cast("smallint"),
    })
    rows = [
        (W.recent.end - timedelta(days=n), a, b, Decimal(u), Decimal(u), True, 1, "ENRICHED", "h")
        for a, b, _, units in peers + blocked for n, u in enumerate(units)
    ]
    evidence = demand.window_evidence(spark.createDataFrame(rows, PANEL), W)
    found = demand.network_shrinkage(frame, evidence).collect()
    return {(r.article_id, r.branch_id): r for r in found}


def test_shrinkage_by_hand(spark):
    """Branch means 2, 4 and 9 over four days each: within 2/3, between (104/2 - 2/3) / 4."""
    peers = [(1, 1, "OK", (1, 3, 2, 2)), (1, 2, "WARN", (4, 4, 3, 5)), (1, 3, "OK", (9, 8, 10, 9)),
             (2, 1, "OK", (5, 5)), (2, 2, "OK", (5, 5)), (2, 3, "OK", (5, 5)),
             (3, 1, "OK", (1, 2)), (3, 2, "OK", (1, 3))]
    blocked = [(1, 8, "BLOCKED", (10, 12)), (1, 9, "BLOCKED", ()), (2, 9, "BLOCKED", (50,)), (3, 9, "BLOCKED", (1,))]
    got = shrunk(spark, peers, blocked)
    between, within = (104 / 2 - 2 / 3) / 4, 2 / 3
    weight = between / (between + within / 2)
    assert float(got[1, 8].basal_daily_demand) == pytest.approx(weight * 11 + (1 - weight) * 5, abs=1e-6)
    assert got[1, 9].basal_daily_demand == 5 and got[1, 9].method_code == "SKU_NETWORK_SHRINKAGE"
    assert got[2, 9].basal_daily_demand == 5  # branches are alike: nothing of its own
    assert got[3, 9].status == "BLOCKED" and got[3, 9].basal_daily_demand is None  # too few branches
    assert got[1, 8].status == "WARN" and got[1, 1].status == "OK" and got[1, 8].fallback_level == 3


def test_backtest_scores_newest_estimate(spark, panel, pairs):
    old = demand.estimate(panel, pairs, W, IDS, created_at=datetime(2026, 8, 3, 1))
    new = demand.estimate(
        panel, pairs, W, RunIds("later", "model", "scope"), created_at=datetime(2026, 8, 3, 2)
    ).withColumn("basal_daily_demand", (F.col("basal_daily_demand") + 1).cast("decimal(18,6)"))
    actual = spark.createDataFrame(
        [
            (T + timedelta(days=1), 1, 5, Decimal(5), Decimal(5), True, 1, "ENRICHED", "a1"),
            (T + timedelta(days=1), 2, 5, Decimal(0), Decimal(0), False, 0, "NOT_APPLICABLE", "a2"),
        ], PANEL,
    )
    day = T + timedelta(days=1)
    detail = backtest.detail(old.unionByName(new), actual, day, day, IDS, 1)
    got = by_article(detail)
    assert 5 not in got and 8 not in got
    assert got[1]["predicted_demand"] == Decimal("3.1") and got[1]["error_units"] == Decimal("1.9")
    assert got[1]["squared_error"] == Decimal("3.61") and got[1]["status"] == "VALID"
    assert got[2]["status"] == "EXCLUDED" and got[4]["actual_basal_units"] == 0
    assert got[2]["exclusion_codes"] == ["ACTUAL_NOT_SERVICEABLE"]
    metrics = {
        (r["segment_type"], r["metric_code"]): r["metric_value"]
        for r in backtest.metrics(detail, day, day).collect()
    }
    assert metrics["ALL", "MAE"] == pytest.approx(1.9)
    assert metrics["ALL", "WAPE"] == pytest.approx(0.38)
    with pytest.raises(ValueError):
        backtest.detail(old, actual, day, day, IDS, 0)


def test_wape_has_no_row_without_actual_demand(spark):
    frame = spark.createDataFrame(
        [(1, 5, "VALID", Decimal(-2), Decimal(2), Decimal(4), Decimal(0))],
        "article_id int, branch_id int, status string, error_units decimal(18,6), "
        "absolute_error_units decimal(18,6), squared_error decimal(24,8), "
        "actual_basal_units decimal(18,6)",
    )
    codes = {r["metric_code"] for r in backtest.metric_table(frame).collect()}
    assert codes == {"MAE", "BIAS", "RMSE"}


def test_estimates_of_many_dates_equal_those_of_one(spark, panel, pairs):
    """Leap days, dates side by side, days that are missing from the panel, pairs without any."""
    dates = [T + timedelta(days=n) for n in (-40, -1, 0, 1, 2, 30)] + [date(2028, 2, 29), date(2028, 3, 1)]
    made = datetime(2026, 1, 1)
    together = demand.estimates(panel, pairs, dates, IDS, created_at=made)
    found = {(r.business_date, r.article_id): r for r in together.collect()}
    assert len(found) == len(dates) * pairs.count()
    for day in dates:
        for one in demand.estimate(panel, pairs, windows.build(day), IDS, created_at=made).collect():
            assert found[day, one.article_id] == one
    plan = demand.dated_checksums(panel, pairs, dates, IDS)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and plan.count("LocalRelation") + plan.count("LogicalRDD") <= 2
