"""Positions, needs, backlog, execution, publication, quality and audit."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from replenish import schemas
from replenish.operators import (
    audit,
    backlog,
    execution,
    logistics,
    needs,
    position,
    publish,
    quality,
    reconcile,
)
from replenish.params import ORIGIN_ID

T = date(2026, 8, 3)


def estimates(spark, rows):
    """rows: (business_date, run, article, status, demand, created)"""
    frame = spark.createDataFrame(
        rows, "business_date date, run_id string, article_id int, status string, "
        "basal_daily_demand decimal(18,6), created_at timestamp_ntz",
    )
    return frame.withColumn("branch_id", F.lit(5))


def inputs(spark, rows):
    """rows: (article, physical, inbound, transit, committed, pending)"""
    full = [
        (T, 5, a, 7, *[Decimal(x) if x is not None else None for x in rest], None, "b")
        for a, *rest in rows
    ]
    return spark.createDataFrame(full, schemas.POSITION_INPUTS)


def parameters(spark, rows):
    full = [(a, b, *map(Decimal, (lt, ts, os)), start, end) for a, b, lt, ts, os, start, end in rows]
    return spark.createDataFrame(full, schemas.PARAMETERS)


@pytest.fixture(scope="module")
def positions(spark):
    made = datetime(2026, 8, 1)
    return position.branch(
        inputs(spark, [
            (1, 20, 15, 0, 5, None), (2, -20, None, None, None, None), (3, 8, 0, 0, 0, 0),
            (4, None, 0, 0, 0, 0), (5, 10, 0, 0, 0, 0), (6, 10, 0, 0, 0, 0), (7, 70, 0, 0, 0, 0),
        ]),
        estimates(spark, [
            (T, "r", 1, "OK", Decimal(10), made), (T, "r", 2, "OK", Decimal(10), made),
            (T, "r", 3, "ZERO_VALID", Decimal(0), made), (T, "r", 4, "OK", Decimal(1), made),
            (T, "r", 5, "BLOCKED", None, made), (T, "r", 6, "OK", Decimal(1), made),
            (date(2026, 7, 30), "r", 7, "OK", Decimal(5), made),
            (date(2026, 8, 1), "r", 7, "WARN", Decimal(10), made),
            (date(2026, 8, 1), "q", 7, "OK", Decimal(99), datetime(2026, 7, 1)),
            (date(2026, 8, 9), "r", 7, "OK", Decimal(77), made),
        ]),
        parameters(spark, [
            *[(a, None, 2, 7, 2, date(2026, 1, 1), None) for a in (1, 3, 4, 5, 7)],
            (2, None, 1, 7, 3, date(2026, 1, 1), None),
            (1, 5, 9, 9, 9, date(2026, 1, 1), date(2026, 7, 31)),
            (7, 5, 3, 7, 2, date(2026, 1, 1), None),
            (7, 5, 4, 7, 2, date(2026, 6, 1), None),
        ]),
    ).cache()


def by(frame, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in frame.collect()}


def test_positions(positions):
    got = by(positions, "article_id")
    one = got[1]
    assert one["net_stock"] == 30 and one["coverage_days"] == 3
    assert one["parameter_level"] == "ARTICLE" and one["lead_time_days"] == 2
    assert (one["critical_stock"], one["minimum_stock"], one["maximum_stock"],
            one["overstock_quantity"]) == (20, 40, 70, 20)
    status = {a: r["calculation_status"] for a, r in got.items()}
    assert status == {1: "OK", 2: "OK", 3: "ZERO_PDVB", 4: "BLOCKED", 5: "BLOCKED", 6: "BLOCKED",
                      7: "WARN"}
    assert got[3]["coverage_days"] is None
    assert got[6]["alert_codes"] == ["MISSING_PARAMETERS"]
    assert got[4]["alert_codes"] == ["MISSING_STOCK"]
    # The newest estimate on or before the date, of its newest run; the later parameter version.
    assert got[7]["estimate_date"] == date(2026, 8, 1) and got[7]["basal_daily_demand"] == 10
    assert got[7]["lead_time_days"] == 4 and got[7]["parameter_level"] == "PAIR"


def test_needs_and_risk(positions):
    got = by(needs.automatic(positions), "article_id", "need_type")
    quantity = {k: r["calculated_quantity"] for k, r in got.items()}
    assert (quantity[1, "D"], quantity[1, "S"], got[1, "D"]["risk_score"]) == (40, 20, 50)
    assert (quantity[2, "D"], quantity[2, "S"], got[2, "D"]["risk_score"]) == (90, 10, 100)
    assert quantity[3, "D"] == quantity[3, "S"] == 0 and got[3, "D"]["risk_score"] is None
    assert got[3, "D"]["calculation_status"] == "ZERO"
    assert got[3, "D"]["alert_codes"] == ["ZERO_PDVB"]
    assert quantity[5, "D"] is None and got[5, "D"]["calculation_status"] == "BLOCKED"
    # Stock covers the target: no demand need, only overstock.
    assert (quantity[7, "D"], quantity[7, "S"]) == (0, 20)
    assert got[1, "D"]["is_mandatory"] and not got[1, "S"]["is_mandatory"]
    assert quality.violations(
        needs.automatic(positions), quality.need_rules(), "need", ["article_id"]
    ).filter("severity = 'ERROR'").count() == 0


def test_rounding_keeps_the_quantity(spark, positions):
    units = spark.createDataFrame([(1, Decimal(12))], "article_id int, units_per_package decimal(18,6)")
    got = by(needs.automatic(positions, units), "article_id", "need_type")
    assert got[1, "D"]["calculated_quantity"] == 40 and got[1, "D"]["rounded_quantity"] == 48
    assert got[2, "D"]["rounded_quantity"] == 90
    pipeline = spark.createDataFrame([(1, 5, Decimal(50))],
                                     "article_id int, branch_id int, pipeline_quantity decimal(18,6)")
    left = by(needs.automatic_balance(needs.automatic(positions, units), pipeline),
              "article_id", "need_type")
    # 50 under way: 48 serve D, the other 2 serve S (24 after rounding).
    assert left[1, "D"]["open_quantity"] == 0 and left[1, "S"]["open_quantity"] == 22
    assert left[2, "D"]["open_quantity"] == 90 and left[5, "D"]["open_quantity"] is None


def directed(spark, rows):
    """rows: (id, type, reference, from, to, original, prepared, cancelled)"""
    full = [
        (n, f"L{n}", kind, ref, None, start, end, "ACTIVE", 1, 5, 1, Decimal(o), Decimal(p),
         Decimal(c), None, None)
        for n, kind, ref, start, end, o, p, c in rows
    ]
    return spark.createDataFrame(full, schemas.DIRECTED_NEEDS)


def test_directed_balance_and_duplicates(spark):
    d = date
    rows = directed(spark, [
        (1, "E", "a", d(2026, 1, 1), d(2026, 2, 1), 10, 0, 0),
        (2, "E", "a", d(2026, 1, 5), d(2026, 1, 9), 10, 4, 0),
        (3, "E", "a", d(2026, 1, 20), None, 10, 10, 0),
        (4, "E", "b", d(2026, 1, 1), d(2026, 1, 2), 10, 4, 6),
        (5, "E", "b", d(2026, 1, 3), d(2026, 1, 4), 10, 0, 0),
    ])
    got = by(needs.directed_balance(rows, T), "line_id")
    assert [got[f"L{n}"]["line_status"] for n in range(1, 6)] == [
        "OPEN", "PARTIAL", "FULFILLED", "CANCELLED", "OPEN",
    ]
    assert got["L2"]["open_quantity"] == 6 and got["L1"]["is_expired"]
    assert not got["L3"]["is_expired"]
    flagged = by(needs.duplicate_candidates(rows), "line_id")
    assert set(flagged) == {"L1", "L2", "L3"}
    assert flagged["L3"]["conflicts_with"] == "L1" and not flagged["L1"]["overlaps_earlier"]


def test_validation_splits_lines(spark):
    rows = directed(spark, [
        (1, "E", "a", T, None, 10, 0, 0), (2, "E", "b", T, None, 0, 0, 0),
        (3, "E", "c", T, date(2026, 1, 1), 5, 0, 0),
    ])
    articles = spark.createDataFrame([(1,)], "article_id int")
    branches = spark.createDataFrame([(5,)], "branch_id int")
    good, bad = needs.split_valid(needs.validate(rows, articles, branches, ["need_id"]))
    assert [r["line_id"] for r in good.collect()] == ["L1"]
    codes = {r["line_id"]: r["reject_codes"] for r in bad.collect()}
    assert codes == {"L2": ["INVALID_QUANTITY"], "L3": ["INVALID_VALIDITY"]}


SOURCE = (
    "business_date date, origin_id int, branch_id int, article_id int, supplier_id int, "
    "need_type string, source_id string, open_quantity decimal(18,6), need_date date, "
    "target_date date, risk_score int"
)


def source(kind, key, quantity, target=None, article=1, need=date(2026, 7, 1), risk=None,
           supplier=7):
    return (T, ORIGIN_ID, 5, article, supplier, kind, key, Decimal(quantity), need, target, risk)


def sources(spark, *rows):
    return backlog.all_sources(spark.createDataFrame(list(rows), SOURCE))


def test_attribution_waterfall(spark):
    rows = sources(
        spark, source("D", "d", 60), source("S", "s", 10), source("C", "c", 10),
        source("E", "e", 20, date(2026, 8, 1)),
    )
    prepared = rows.select(*backlog.LINE).distinct().withColumn(
        "prepared_quantity", F.lit(50).cast("decimal(18,6)")
    )
    got = by(backlog.attribute(rows, prepared, T), "source_id")
    assert [int(got[k]["allocated_quantity"]) for k in "ecds"] == [20, 10, 20, 0]


def test_attribution_conserves_quantity_for_a_heavy_line(spark):
    rows = sources(spark, *[source("DECAS"[n % 5], f"{n:04d}", n % 7 + 1) for n in range(700)])
    total = sum(n % 7 + 1 for n in range(700))
    keys = rows.select(*backlog.LINE).distinct()
    for amount in (0, 1234, total + 5):
        prepared = keys.withColumn("prepared_quantity", F.lit(amount).cast("decimal(18,6)"))
        got = backlog.attribute(rows, prepared, T)
        assert got.agg(F.sum("allocated_quantity")).first()[0] == min(amount, total)
        assert quality.violations(got, quality.allocation_rules(), "a", ["source_id"]).count() == 0


def test_consolidation_and_priority(spark):
    rows = sources(
        spark,
        source("D", "1", 60, risk=50), source("E", "2", 20, date(2026, 8, 20)),
        source("S", "3", 20),
        source("E", "4", 5, date(2026, 8, 1), article=2),
        source("C", "5", 5, date(2026, 8, 5), article=3),
        source("A", "6", 5, date(2026, 8, 1), article=4, supplier=None),
        source("D", "7", 5, article=5, risk=100),
        source("D", "8", 5, article=6, risk=50, need=date(2026, 6, 1)),
    )
    lines = backlog.consolidate(rows)
    one = by(lines, "article_id")[1]
    assert (one["mandatory_open_quantity"], one["optional_open_quantity"],
            one["total_open_quantity"]) == (80, 20, 100)
    assert by(lines, "article_id")[4]["supplier_key"] == backlog.NO_SUPPLIER
    ranked = backlog.prioritize(lines, T)
    order = [r["article_id"] for r in ranked.orderBy("priority_rank").collect()]
    assert order == [2, 3, 5, 6, 1, 4]
    mandatory = backlog.Search(mandatory_only=True)
    pages = [backlog.search(ranked, mandatory, p, 2).collect() for p in (1, 2, 3)]
    assert [[r["article_id"] for r in sorted(p, key=lambda r: r["position"])] for p in pages] == [
        [2, 3], [5, 6], [1],
    ]
    assert [r["article_id"] for r in backlog.top_priorities(ranked, 2).collect()] == [2, 3]
    with pytest.raises(ValueError):
        backlog.search(ranked, mandatory, 0)


def test_missing_logistics_keep_the_line(spark):
    items = spark.createDataFrame(
        [(1, "UN", Decimal(10), Decimal(4), Decimal("0.5"), Decimal("0.01"), None),
         (2, "UN", Decimal(10), None, Decimal("0.5"), None, None)], schemas.ITEM_LOGISTICS,
    )
    lines = spark.createDataFrame(
        [(1, Decimal(100)), (2, Decimal(100)), (3, Decimal(100))], "article_id int, q decimal(18,6)"
    )
    got = by(logistics.estimate(lines, items, "q"), "article_id")
    assert (got[1]["estimated_packages"], got[1]["estimated_pallets"]) == (10, Decimal("2.5"))
    assert got[2]["estimated_packages"] == 10 and got[2]["estimated_pallets"] is None
    assert [got[n]["logistics_status"] for n in (1, 2, 3)] == ["COMPLETE", "PARTIAL", "MISSING"]


def test_center_position(spark):
    center = spark.createDataFrame([(T, 1, Decimal(50), None, None), (T, 9, Decimal(1), None, None)],
                                   schemas.CENTER_INPUTS)
    orders = spark.createDataFrame(
        [(1, 1, Decimal(10), date(2026, 8, 3)), (2, 1, Decimal(7), date(2026, 8, 2))],
        schemas.PURCHASE_ORDERS,
    )
    lines = backlog.consolidate(sources(spark, source("D", "1", 90), source("S", "2", 30)))
    got = by(position.center(center, orders, lines, T), "article_id")
    assert (got[1]["open_po_on_time"], got[1]["open_po_overdue"]) == (10, 7)
    assert got[1]["coverage_index"] == Decimal("0.5") and got[1]["status"] == "WARN"
    assert got[9]["coverage_index"] is None


def event(key, line, kind, mode, quantity, minute, status="TER", received=None):
    at = datetime(2026, 8, 3, 10, minute)
    return (key, "I", line, kind, status, mode,
            None if quantity is None else Decimal(quantity), None, at, received or at, "v1")


def events(spark, *rows):
    return execution.normalize(
        execution.dedup(spark.createDataFrame(list(rows), schemas.EXECUTION_EVENTS))
    )


def test_partial_execution(spark):
    state = execution.fold(events(
        spark,
        event("1", "A", "IMPORTED", "DELTA", 80, 1, "GEN"),
        event("2", "A", "PREPARED", "CUMULATIVE", 30, 2),
        event("3", "A", "PREPARED", "CUMULATIVE", 50, 3),
        event("3", "A", "PREPARED", "CUMULATIVE", 50, 3, received=datetime(2026, 8, 4)),
        event("4", "B", "IMPORTED", "DELTA", 5, 1, "GEN"),
        event("5", "B", "UNKNOWN", "DELTA", 0, 9, "??"),
    ))
    need = state.withColumn("need_quantity", F.lit(100).cast("decimal(18,6)"))
    got = by(execution.remaining(need), "line_id")
    assert (got["A"]["open_quantity"], got["A"]["import_unprepared"]) == (50, 30)
    assert got["A"]["event_count"] == 3 and got["A"]["last_status"] == "PREPARED"
    # An unknown state closes nothing.
    assert got["B"]["last_status"] == "UNKNOWN" and got["B"]["open_quantity"] == 100
    idle = execution.idle(state, date(2026, 8, 9), 3)
    assert {r["line_id"] for r in idle.collect()} == {"A", "B"}


def test_decreasing_cumulative_is_a_correction(spark):
    rows = events(
        spark,
        event("1", "A", "PREPARED", "CUMULATIVE", 30, 1),
        event("2", "A", "PREPARED", "CUMULATIVE", 20, 5),
        event("3", "A", "PREPARED", "CUMULATIVE", 45, 9),
        event("4", "A", "PREPARED", "DELTA", 7, 7),
    )
    got = by(execution.to_delta(rows), "dedup_key")
    assert [int(got[k]["delta_quantity"]) for k in "1234"] == [30, 0, 15, 7]
    assert got["2"]["record_type"] == "CORRECTED"
    total = execution.fold(rows).first()["prepared_quantity"]
    assert total == sum(r["delta_quantity"] for r in got.values())


def test_quarantine(spark):
    lines = spark.createDataFrame([("A",), ("B",)], "line_id string")
    clean, isolated = execution.quarantine(events(
        spark,
        event("1", "A", "IMPORTED", "DELTA", 10, 1, "GEN"),
        event("2", "A", "PREPARED", "DELTA", 11, 2),
        event("3", "X", "IMPORTED", "DELTA", 10, 1, "GEN"),
        event("4", "B", "IMPORTED", "DELTA", None, 1, "GEN"),
        event("5", "B", "IMPORTED", "?", 5, 1, "GEN"),
    ), lines)
    assert {r["dedup_key"] for r in clean.collect()} == {"1"}
    codes = {r["dedup_key"]: r["isolation_codes"] for r in isolated.collect()}
    assert codes == {
        "2": ["PREPARED_EXCEEDS_IMPORTED"], "3": ["UNKNOWN_REFERENCE"], "4": ["INVALID_DATA"],
        "5": ["INVALID_DATA"],
    }


def test_import_outcomes(spark):
    def request(key, line, version, quantity, minute=0):
        return (key, "a", "s", "o", line, version, Decimal(quantity), datetime(2026, 8, 3, 9, minute))

    requests = spark.createDataFrame([
        request("k1", "L1", 4, 80), request("k1", "L1", 4, 80, 5), request("k2", "L1", 3, 80),
        request("k3", "L1", 4, 101), request("k4", "L9", 1, 1), request("k5", "L1", 4, 0),
        request("k6", "L1", 4, 80),
    ], schemas.IMPORT_REQUESTS)
    lines = spark.createDataFrame([("L1", 4, Decimal(100))],
                                  "line_id string, line_version int, open_quantity decimal(18,6)")
    accepted = spark.createDataFrame([("a", "k6", "L1")],
                                     "adapter string, idempotency_key string, line_id string")
    got = by(execution.confirm_imports(requests, lines, accepted), "idempotency_key")
    assert {k: r["outcome"] for k, r in got.items()} == {
        "k1": "ACCEPTED", "k2": "STALE_VERSION", "k3": "QUANTITY_EXCEEDS_OPEN", "k4": "NOT_FOUND",
        "k5": "INVALID", "k6": "ALREADY_ACCEPTED",
    }
    assert got["k1"]["replays"] == 1


def test_publication(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "pub")

    def batch(*rows):
        return spark.createDataFrame(
            [(T, a, 5, s, None if v is None else Decimal(v)) for a, s, v in rows],
            "business_date date, article_id int, branch_id int, status string, "
            "basal_daily_demand decimal(18,6)",
        ).select("*", *[
            F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.DEMAND_ESTIMATE
            if f.name not in ("business_date", "article_id", "branch_id", "status",
                              "basal_daily_demand")
        ])

    def scope_of(*articles):
        return spark.createDataFrame([(a, 5) for a in articles], "article_id int, branch_id int")

    def now():
        return {r["article_id"]: r["basal_daily_demand"] for r in publish.current(spark, root).collect()}

    publish.publish(spark, root, batch((1, "OK", 1), (2, "OK", 2), (3, "BLOCKED", None)),
                    scope_of(1, 2, 3), "b1")
    assert now() == {1: 1, 2: 2}
    done = publish.publish(spark, root, batch((1, "BLOCKED", None), (3, "WARN", 9)),
                           scope_of(1, 3), "b2")
    assert now() == {1: 1, 3: 9} and done["retired"] == 1
    with pytest.raises(publish.PublicationRejected):
        publish.publish(spark, root, batch((1, "OK", 5), (1, "OK", 6)), scope_of(1, 3), "b3")
    with pytest.raises(publish.PublicationRejected):
        publish.publish(spark, root, batch((8, "OK", 5)), scope_of(1, 3), "b4")
    assert now() == {1: 1, 3: 9}
    publish.publish(spark, root, batch((1, "BLOCKED", None), (3, "WARN", 9)), scope_of(1, 3), "b2")
    assert now() == {1: 1, 3: 9}
    assert publish.history(spark, root).count() == 2
    publish.publish(spark, root, batch((1, "OK", 4), (3, "WARN", 9)), scope_of(1, 3), "b2")
    assert now() == {1: 4, 3: 9}
    states = [(r["batch_id"], r["status"]) for r in publish.history(spark, root).orderBy("sequence").collect()]
    assert states == [("b1", "SUPERSEDED"), ("b2", "SUPERSEDED"), ("b2", "PUBLISHED")]
    failed = publish.publications(spark, root).filter("status = 'FAILED'").collect()
    assert [r["batch_id"] for r in failed] == ["b3", "b4"]
    reached = publish.publications(spark, root).filter("batch_id = 'b1'").orderBy("sequence").collect()
    assert tuple(r["status"] for r in reached) == publish.STATES
    # An older date does not replace a newer row, and breaking off before the switch changes nothing.
    older = batch((1, "OK", 7), (3, "OK", 7)).withColumn("business_date", F.lit(date(2026, 8, 1)))
    with monkeypatch.context() as broken:
        kept = publish._record

        def stop(spark, root, **values):
            if values["status"] == "PUBLISHED":
                raise RuntimeError("lost")
            kept(spark, root, **values)

        broken.setattr(publish, "_record", stop)
        with pytest.raises(RuntimeError):
            publish.publish(spark, root, older, scope_of(1, 3), "b5")
    assert now() == {1: 4, 3: 9}
    publish.publish(spark, root, older, scope_of(1, 3), "b5")
    assert now() == {1: 4, 3: 9}
    assert {r["article_id"] for r in publish.published_rows(spark, root, "b5").collect()} == {1, 3}


def test_run_registry(spark, tmp_path):
    root = str(tmp_path / "runs")
    common = {"run_type": "ESTIMATE", "business_date": T, "cutoff_date": date(2026, 8, 2),
              "scope_id": "41"}
    for number, status in enumerate(["SUCCEEDED", "SUCCEEDED", "FAILED"], start=1):
        publish.register_run(spark, root, run_id=f"r{number}", attempt_no=number, status=status,
                             **common)
    runs = publish.runs(spark, root)
    assert publish.current_runs(runs).first()["run_id"] == "r2"
    assert publish.next_attempt(runs, "ESTIMATE", T, "41") == 4
    with pytest.raises(ValueError):
        publish.register_run(spark, root, **{**common, "cutoff_date": T})


def test_quality_reports_broken_rows(spark):
    rows = spark.createDataFrame(
        [(T, 1, 5, Decimal(5), Decimal(3), Decimal(1), "UNKNOWN", None, True, True)],
        "sales_date date, article_id int, branch_id int, observed_units decimal(18,6), "
        "basal_units decimal(18,6), promo_units decimal(18,6), availability_status string, "
        "stock_source_hash string, eligible boolean, assortment_active boolean",
    )
    found = quality.violations(rows, quality.sales_rules(), "sales", ["article_id"], "sales_date")
    assert {r["issue_code"] for r in found.collect()} == {
        "UNITS_CONSERVATION", "ELIGIBLE_AVAILABLE", "STOCK_UNKNOWN",
    }
    twice = quality.duplicates(rows.unionByName(rows), ["article_id", "branch_id"], "sales")
    assert twice.first()["entity_key"] == '{"article_id":1,"branch_id":5}'


def test_audit_and_reconciliation(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d")], "id int, v string")
    got = by(audit.diff(before, after, ["id"], "thing", "c-1"), "entity_id")
    assert {k: r["event_type"] for k, r in got.items()} == {
        "2": "CHANGED", "3": "REMOVED", "4": "CREATED",
    }
    assert got["2"]["before_state"] == '{"v":"b"}' and got["4"]["before_state"] is None
    gaps = by(reconcile.differences(before, after, ["id"], ["v"]), "id")
    assert {k: r["difference"] for k, r in gaps.items()} == {
        2: "DIFFERENT", 3: "MISSING_IN_STAGE", 4: "MISSING_IN_SOURCE",
    }


def test_only_rows_of_differing_leaves_are_put_side_by_side(spark):
    rows = spark.range(200_000).selectExpr("id", "id % 7 as v", "cast(id as string) as t")
    other = rows.filter("id <> 5").selectExpr("id", "if(id = 77, 100, v) as v", "t").union(
        spark.createDataFrame([(-1, 0, "x")], "id bigint, v bigint, t string")
    )
    levels = reconcile.levels_for(rows.count())
    trees = [reconcile.tree(side, ["id"], ["v", "t"], levels) for side in (rows, other)]
    leaves = reconcile.differing_leaves(*trees)
    assert leaves.count() <= 3
    assert reconcile.suspects(rows, ["id"], levels, leaves).count() < 200_000 // 100
    gaps = by(reconcile.differences(rows, other, ["id"], ["v", "t"]), "id")
    assert {k: r["difference"] for k, r in gaps.items()} == {
        5: "MISSING_IN_STAGE", 77: "DIFFERENT", -1: "MISSING_IN_SOURCE",
    }
    assert gaps[77]["stage"]["v"] == 100 and gaps[5]["stage"] is None
    assert reconcile.differences(rows, rows, ["id"], ["v", "t"]).isEmpty()


def test_reconciliation_of_null_keys_repeats_and_empty_sides(spark):
    schema = "k int, j string, v string"
    source = spark.createDataFrame(
        [(None, "a", "1"), (1, None, ""), (2, "b", None), (3, "c", "x"), (3, "c", "x"), (4, "d", "a|b")],
        schema,
    )
    stage = spark.createDataFrame(
        [(None, "a", "1"), (1, None, None), (2, "b", None), (3, "c", "x"), (4, "d", "a|b"), (None, None, "n")],
        schema,
    )
    found = reconcile.differences(source, stage, ["k", "j"], ["v"]).collect()
    assert {(r["k"], r["j"]): (r["difference"], r["source_rows"], r["stage_rows"]) for r in found} == {
        (1, None): ("DIFFERENT", 1, 1), (3, "c"): ("DIFFERENT", 2, 1),
        (None, None): ("MISSING_IN_SOURCE", 0, 1),
    }
    empty = source.limit(0)
    assert reconcile.differences(empty, empty, ["k", "j"], ["v"]).isEmpty()
    assert reconcile.differences(source, empty, ["k", "j"], ["v"]).count() == 5


def test_a_projection_without_a_source_is_found(spark):
    schema = "article_id int, branch_id int, business_date date, status string, " \
        "basal_daily_demand decimal(18,6), input_checksum string"

    def rows(*given):
        return spark.createDataFrame([(a, 5, T, s, Decimal(v), "c") for a, s, v in given], schema)

    before, stage = rows((1, "OK", 1), (2, "OK", 2)), rows((1, "OK", 3), (2, "BLOCKED", 0))
    assert publish.unexplained(before, stage, rows((1, "OK", 3), (2, "OK", 2))).isEmpty()
    wrong = publish.unexplained(before, stage, rows((1, "OK", 4), (2, "OK", 2), (3, "OK", 1)))
    assert {r["article_id"] for r in wrong.collect()} == {1, 3}


def test_version_history(spark):
    rows = spark.createDataFrame(
        [(1, 1, datetime(2026, 1, 1), "a"), (1, 2, datetime(2026, 2, 1), "b")],
        "need_id int, version int, changed_at timestamp_ntz, status string",
    )
    got = by(needs.versions_with_validity(rows, "need_id", ["status"]), "version")
    assert got[1]["superseded_at"] == datetime(2026, 2, 1) and got[1]["before_state"] is None
    assert got[2]["before_state"] == '{"status":"a"}' and got[2]["superseded_at"] is None


def test_the_interval_join_knows_no_days_and_equals_a_plain_comparison(spark):
    import random

    rng = random.Random(2)
    start = date(2020, 1, 1)
    versions = []
    for article in range(6):
        for n in range(5):
            low = start + timedelta(days=rng.randrange(900))
            high = None if n == 4 else low + timedelta(days=rng.randrange(-3, 400))
            versions.append((article, 5, n + 1, 7, 2, low, high))
    days = [start + timedelta(days=rng.randrange(-50, 1400)) for _ in range(300)]
    asked = [(rng.randrange(7), 5, day) for day in days]
    frame = spark.createDataFrame(asked, "article_id int, branch_id int, business_date date")
    found = position.valid_on(
        parameters(spark, versions), ["article_id", "branch_id"], frame, ["lead_time_days"]
    )
    wanted = set()
    for article, branch, day in set(asked):
        own = [v for v in versions if v[0] == article and v[5] <= day and (v[6] is None or day <= v[6])]
        if own:
            best = max(own, key=lambda v: (v[5], v[6] is not None, v[6] or day))
            wanted.add((day, article, branch, best[2]))
    rows = found.collect()
    assert {(r[0], r[1], r[2], int(r[3])) for r in rows} == wanted and len(rows) == len(wanted)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "2020-" not in plan and "2021-" not in plan


def one_estimate(spark, value):
    return spark.createDataFrame(
        [(date(2026, 8, 2), "r", 1, 5, "OK", Decimal(value), "x")],
        "business_date date, run_id string, article_id int, branch_id int, status string, "
        "basal_daily_demand decimal(18,6), input_checksum string",
    ).select(
        *[
            (F.col(f.name) if f.name in ("business_date", "run_id", "article_id", "branch_id", "status",
                                         "basal_daily_demand", "input_checksum")
             else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.DEMAND_ESTIMATE
        ]
    )


def test_of_two_publishers_one_switches(spark, tmp_path, monkeypatch):
    root, pairs = str(tmp_path), spark.createDataFrame([(1, 5)], "article_id int, branch_id int")
    publish.publish(spark, root, one_estimate(spark, 1), pairs, "b1")
    plain = publish.retired

    def meanwhile(before, scope_pairs):
        monkeypatch.setattr(publish, "retired", plain)
        publish.publish(spark, root, one_estimate(spark, 2), pairs, "b2")
        return plain(before, scope_pairs)

    monkeypatch.setattr(publish, "retired", meanwhile)
    with pytest.raises(publish.PublicationRejected, match="another attempt"):
        publish.publish(spark, root, one_estimate(spark, 3), pairs, "b3")
    assert [int(r["basal_daily_demand"]) for r in publish.current(spark, root).collect()] == [2]
    assert [r["batch_id"] for r in publish.history(spark, root).orderBy("sequence").collect()] == ["b1", "b2"]
    # A record that its writer left empty stops publications until it is settled.
    (tmp_path / "publications" / "published-0000000003.json").write_text("")
    with pytest.raises(publish.PublicationRejected, match="being written"):
        publish.publish(spark, root, one_estimate(spark, 4), pairs, "b4")


SCOPE_ROWS = (
    "article_id int, branch_id int, route_code string, supply_mode int, enabled int, "
    "active_for_sale int, active_on_mix int"
)


def test_scope_gates(spark):
    def rows(*pairs, route="41CD"):
        return spark.createDataFrame([(a, b, route, 0, 1, 1, 1) for a, b in pairs], SCOPE_ROWS)

    def codes_of(candidate, now):
        found = quality.scope_gates(candidate, now).collect()
        return sorted((r["issue_code"], r["entity_key"]) for r in found)

    now = rows(*[(a, b) for a in range(10) for b in (1, 2)])
    assert codes_of(now, now) == []
    assert codes_of(now.limit(0), now) == [
        ("BRANCH_VARIATION", '{"branch_id":1}'), ("BRANCH_VARIATION", '{"branch_id":2}'),
        ("SCOPE_EMPTY", '{"scope":"scope"}'), ("SCOPE_VARIATION", '{"scope":"scope"}'),
    ]
    # Two of twenty pairs are within a tenth of the scope but not of their branch; branch 3 is new.
    fewer = now.filter("branch_id = 2 or article_id > 0").unionByName(rows((1, 3)))
    assert codes_of(fewer, now) == [("NEW_BRANCH", '{"branch_id":3}')]
    fewer = now.filter("branch_id = 2 or article_id > 1")
    assert codes_of(fewer, now) == [("BRANCH_VARIATION", '{"branch_id":1}')]
    wrong = now.filter("article_id > 0 or branch_id = 2").unionByName(rows((0, 1), route=None))
    assert codes_of(wrong, now) == [("INVALID_ROUTE", '{"article_id":0,"branch_id":1}')]
    assert codes_of(now.unionByName(rows((4, 2))), now) == [
        ("DUPLICATE_KEY", '{"article_id":4,"branch_id":2}')
    ]
    assert codes_of(now.limit(0), now.limit(0)) == [("SCOPE_EMPTY", '{"scope":"scope"}')]


def test_version_history_of_a_key_with_many_versions(spark):
    rows = spark.range(20_000).select(
        F.lit(1).alias("customer"), (F.col("id") * 3).alias("version"),
        F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 900).cast("int")).alias("changed_at"),
        F.col("id").alias("state"),
    )
    found = needs.versions_with_validity(rows, "customer", ["state"])
    wrong = found.filter(
        (F.col("version") > 0)
        & ~F.col("before_state").eqNullSafe(F.to_json(F.struct((F.col("version") / 3 - 1).cast("bigint").alias("state"))))
    )
    assert found.count() == 20_000 and wrong.isEmpty()
    assert found.filter("superseded_at is null").count() == 1
    assert found.filter("before_state is null").count() == 1
