"""Stored tables, pipelines, file sources and streams."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from replenish import schemas, sources
from replenish.fixtures import adapters as fx
from replenish.functions.windows import Span
from replenish.operators import execution, freshness
from replenish.operators.demand import RunIds
from replenish.plans import pipelines
from replenish.sources.store import ConcurrentWrite, MonthlyStore
from replenish.streaming import events as streams
from replenish.streaming import lines

DATA = "/root/testdata/sf0.001"


def shelf(spark, rows):
    return spark.createDataFrame(
        [(d, a, 5, Decimal(q), h) for d, a, q, h in rows],
        "stock_date date, article_id int, branch_id int, stock_quantity decimal(18,6), "
        "source_row_hash string",
    )


def test_upsert_touches_only_changed_months(spark, tmp_path):
    root = str(tmp_path)
    store = MonthlyStore(spark, root)
    july, august = date(2026, 7, 31), date(2026, 8, 1)
    span = Span(july, august)
    first = shelf(spark, [(july, 1, 1, "a"), (july, 2, 1, "b"), (august, 1, 1, "c")])
    assert store.upsert("stock_daily", first, span).rows == 3
    before = store.folders("stock_daily")
    assert store.upsert("stock_daily", first, span).rows == 0
    second = shelf(spark, [(august, 1, 7, "d"), (august, 3, 1, "e"), (july, 1, 99, "a")])
    result = store.upsert("stock_daily", second, span)
    assert (result.inserted, result.updated, result.months) == (1, 1, ("2026-08",))
    assert store.folders("stock_daily")["2026-07"] == before["2026-07"]
    assert store.commits("stock_daily") == [1, 2]
    assert store.read("stock_daily", commit=1).count() == 3
    with pytest.raises(ValueError, match="same key"):
        store.upsert("stock_daily", shelf(spark, [(august, 1, 8, "z"), (august, 1, 9, "y")]), span)
    rows = {(r["stock_date"], r["article_id"]): int(r["stock_quantity"])
            for r in store.read("stock_daily").collect()}
    # Nothing is deleted, and an equal hash updates nothing.
    assert rows == {(july, 1): 1, (july, 2): 1, (august, 1): 7, (august, 3): 1}


def test_reads_prune_months(spark, tmp_path):
    store = MonthlyStore(spark, str(tmp_path))
    days = [date(2026, m, 1) for m in (1, 2, 3)]
    store.upsert("stock_daily", shelf(spark, [(d, 1, 1, "x") for d in days]), Span(days[0], days[2]))
    one = store.read("stock_daily", Span(days[1], days[1]))
    assert {f.split("month=")[1][:7] for f in one.inputFiles()} == {"2026-02"}
    assert one.count() == 1
    assert store.prune("stock_daily", 2, date(2026, 3, 15)) == ["2026-01"]
    assert store.months("stock_daily") == ["2026-02", "2026-03"]
    with pytest.raises(ValueError):
        store.read("other")


def test_commits_are_atomic(spark, tmp_path, monkeypatch):
    store, day = MonthlyStore(spark, str(tmp_path)), date(2026, 1, 1)
    span = Span(day, day)
    store.upsert("stock_daily", shelf(spark, [(day, 1, 1, "a")]), span)
    with monkeypatch.context() as broken:
        broken.setattr(store, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.upsert("stock_daily", shelf(spark, [(day, 1, 2, "b")]), span)
    assert [int(r["stock_quantity"]) for r in store.read("stock_daily").collect()] == [1]
    with monkeypatch.context() as slow:  # another writer commits first
        slow.setattr(store, "commits", lambda table: [])
        with pytest.raises(ConcurrentWrite):
            store.upsert("stock_daily", shelf(spark, [(day, 1, 3, "c")]), span)
    old = store.read("stock_daily")
    store.upsert("stock_daily", shelf(spark, [(day, 1, 4, "d")]), span)
    assert [int(r["stock_quantity"]) for r in old.collect()] == [1]
    assert len(store.vacuum("stock_daily", 1)) == 3
    assert [int(r["stock_quantity"]) for r in store.read("stock_daily").collect()] == [4]


def test_append_never_changes_stored_rows(spark, tmp_path):
    store = MonthlyStore(spark, str(tmp_path))
    day = date(2026, 8, 3)
    rows = spark.createDataFrame(
        [(day, "r", 1, 5, Decimal(2)), (day, "r", 2, 5, Decimal(3))],
        "business_date date, run_id string, article_id int, branch_id int, "
        "basal_daily_demand decimal(18,6)",
    )
    assert store.append_new("demand_estimate", rows, Span(day, day)).inserted == 2
    changed = rows.withColumn("basal_daily_demand", F.lit(9).cast("decimal(18,6)"))
    more = changed.unionByName(changed.withColumn("run_id", F.lit("r2")))
    assert store.append_new("demand_estimate", more, Span(day, day)).inserted == 2
    got = {(r["run_id"], r["article_id"]): int(r["basal_daily_demand"])
           for r in store.read("demand_estimate").collect()}
    assert got == {("r", 1): 2, ("r", 2): 3, ("r2", 1): 9, ("r2", 2): 9}


@pytest.fixture(scope="module")
def inputs(spark):
    return pipelines.Inputs(
        fx.catalog(spark, DATA), fx.raw_sales(spark, DATA), fx.enriched_sales(spark, DATA),
        fx.wide_stock(spark, DATA),
    )


def test_daily_run_is_idempotent_and_gated(spark, tmp_path, inputs):
    store = MonthlyStore(spark, str(tmp_path))
    ids = RunIds("run-1", "m", "s")
    day = date(2001, 7, 20)
    first = pipelines.daily(store, inputs, day, ids)
    assert first["estimate"].inserted == 392 and first["features"]["sales"].inserted == 392
    again = pipelines.daily(store, inputs, day, ids)
    assert again["features"]["stock"].rows == again["features"]["sales"].rows == 0
    assert again["estimate"].rows == 0
    # A new scope version re-stamps the rows although their hash is unchanged.
    moved = pipelines.features(store, inputs, date(2001, 7, 19), date(2001, 7, 19), "s2")
    assert moved["sales"].updated == 392
    result = pipelines.run_backtest(store, date(2001, 7, 21), date(2001, 7, 21), ids)
    assert result.rows == 0  # one day of evidence blocks every pair
    with pytest.raises(freshness.SourceNotClosed):
        pipelines.features(store, inputs, date(2001, 12, 20), date(2001, 12, 20), "s")
    # Stock is loaded before the gate, sales are not.
    assert store.read("sales_daily", Span(date(2001, 12, 1), date(2001, 12, 31))).count() == 0


def test_close_day_twice_gives_the_same_snapshot(spark, inputs):
    from replenish.fixtures.queries import Frames

    frames = Frames.of(spark, DATA)
    events = fx.execution_events(spark, DATA)
    pairs = frames.pairs
    lines = events.select("line_id").distinct().select(
        "line_id", (F.col("line_id").cast("int") % 23 + 1).alias("article_id"),
        (F.col("line_id").cast("int") % 25).alias("branch_id"),
    )
    day = pipelines.DayInputs(
        fx.position_inputs(frames.stock, pairs), fx.parameters(spark, DATA),
        fx.directed_needs(spark, DATA), fx.item_logistics(spark, DATA), events, lines,
    )
    one = pipelines.close_day(frames.estimates, pairs, day, fx.BUSINESS_DATE)
    two = pipelines.close_day(frames.estimates, pairs, day, fx.BUSINESS_DATE)
    keep = ["line_id", "total_open_quantity", "priority_rank", "imported_quantity"]
    a = sorted(map(tuple, one["backlog"].select(*keep).collect()))
    assert a and a == sorted(map(tuple, two["backlog"].select(*keep).collect()))


def test_bulk_upload_keeps_and_flags_bad_lines(spark, tmp_path):
    names = schemas.DIRECTED_NEEDS.names
    good = dict.fromkeys(names, "")
    good.update(need_id="1", line_id="a", need_type="C", branch_id="5", article_id="1",
                original_quantity="10", valid_from="2026-08-01", valid_to="2026-08-31")
    bad = {**good, "need_type": "Z", "original_quantity": "-1", "article_id": ""}
    broken = {**good, "need_id": "not a number"}
    path = tmp_path / "needs.csv"
    path.write_text("\n".join(
        [",".join(names)] + [",".join(r[n] for n in names) for r in (good, bad, broken)]
    ))
    rows = sources.directed_needs(spark, str(path)).cache()
    codes = [r["reject_codes"] for r in rows.collect()]
    assert codes[0] == []
    assert codes[1] == ["MISSING_ARTICLE", "INVALID_TYPE", "INVALID_QUANTITY"]
    assert codes[2] == ["UNREADABLE_LINE"]


def test_exchange_file_reaches_the_same_operator(spark, tmp_path):
    path = tmp_path / "requests.json"
    path.write_text(
        '{"idempotency_key":"k","adapter":"file","line_id":"L","line_version":1,"quantity":5,'
        '"requested_at":"2026-08-03T10:00:00"}\n'
    )
    requests = sources.exchange_file(spark, str(path), "import_requests")
    lines = spark.createDataFrame([("L", 1, Decimal(9))],
                                  "line_id string, line_version int, open_quantity decimal(18,6)")
    none = spark.createDataFrame([], "adapter string, idempotency_key string, line_id string")
    assert execution.confirm_imports(requests, lines, none).first()["outcome"] == "ACCEPTED"
    with pytest.raises(ValueError):
        sources.exchange_file(spark, str(path), "catalog")


def event(key, line, kind, mode, quantity, minute):
    at = datetime(2026, 8, 3, 10) + timedelta(minutes=minute)
    return (key, "I", line, kind, "TER", mode, Decimal(quantity), None, at, at, "v1")


def put(spark, folder, number, *rows):
    spark.createDataFrame(list(rows), schemas.EXECUTION_EVENTS).coalesce(1).write.parquet(
        f"{folder}/part{number}"
    )


def read_stream(spark, folder):
    return spark.readStream.schema(schemas.EXECUTION_EVENTS).parquet(f"{folder}/*")


def test_stream_equals_batch_under_late_repeated_and_unordered_events(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    day = 60 * 24
    triggers = [
        [event("1", "A", "IMPORTED", "DELTA", 80, 1), event("2", "A", "PREPARED", "CUMULATIVE", 30, 2),
         event("3", "B", "PREPARED", "CUMULATIVE", 9, 3), event("7", "D", "PREPARED", "CUMULATIVE", 40, 50)],
        [event("4", "A", "PREPARED", "CUMULATIVE", 20, 60), event("5", "A", "PREPARED", "CUMULATIVE", 50, 61),
         event("6", "C", "IMPORTED", "DELTA", 1, 20 * day)],
        # Ten days late, out of order below a later quantity, and one that makes "7" a correction.
        [event("8", "A", "IMPORTED", "DELTA", 7, -10 * day), event("9", "D", "PREPARED", "CUMULATIVE", 10, 5),
         event("10", "D", "PREPARED", "CUMULATIVE", 45, 6)],
    ]
    again = event("1", "A", "IMPORTED", "DELTA", 80, 5 * day)  # a copy with another external time
    seen = []
    for number, rows in enumerate(triggers):
        seen += rows
        put(spark, inbox, number, *rows, rows[0], *([again, triggers[0][1]] if number else []))
        streams.ingest(read_stream(spark, inbox), out, f"{out}/checkpoint").awaitTermination()
        events = execution.dedup(spark.createDataFrame(seen, schemas.EXECUTION_EVENTS))
        batch = execution.fold(execution.normalize(events))
        streamed = streams.read_state(spark, out).select(*batch.columns)
        assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
        keys = sorted(r["dedup_key"] for r in streams.read_log(spark, out).collect())
        assert keys == sorted(r[0] for r in seen)
        wanted = execution.to_delta(events).filter("record_type = 'CORRECTED'").collect()
        fixes = streams.read_corrections(spark, out).collect()
        assert sorted(r["dedup_key"] for r in fixes) == sorted(r["dedup_key"] for r in wanted)
        daily = execution.daily_counts(events)
        assert sorted(map(tuple, streams.read_daily(spark, out).select(*daily.columns).collect())) == sorted(
            map(tuple, daily.collect())
        )
    assert sorted(r["dedup_key"] for r in fixes) == ["4", "7"]
    idle = streams.idle(spark, out, date(2026, 8, 30), 5).collect()
    assert sorted(r["line_id"] for r in idle) == ["A", "C"]


def test_a_repeated_trigger_replaces_itself(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, inbox, 1, event("1", "A", "IMPORTED", "DELTA", 2, 1))
    for checkpoint in ("c1", "c2"):  # a lost checkpoint starts again with trigger 0
        streams.ingest(read_stream(spark, inbox), out, f"{out}/{checkpoint}").awaitTermination()
    assert streams.read_log(spark, out).count() == 1
    assert streams.read_state(spark, out, f"{out}/{checkpoint}").first()["event_count"] == 1


def test_climbing_quantities_equal_the_batch_judgement():
    rng = random.Random(4)
    for _ in range(200):
        events = [(rng.randrange(8), str(n), Decimal(rng.randrange(-1, 6))) for n in range(rng.randrange(1, 9))]
        stairs, lower = [], []
        for at, key, quantity in events:
            lower += lines.climb(stairs, at, key, quantity)
        highest, wanted = Decimal(0), []
        for event in sorted(events):
            if event[2] < highest:
                wanted.append(event)
            highest = max(highest, event[2])
        assert sorted(lower) == wanted and sorted(lower + stairs) == sorted(events)


def test_idle_reports_equal_the_batch_detector_at_every_trigger(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    day = 60 * 24
    triggers = [  # days after 3 August of the clock, events
        (0, [event("1", "A", "IMPORTED", "DELTA", 8, 0), event("2", "B", "IMPORTED", "DELTA", 5, 0),
             event("3", "C", "IMPORTED", "DELTA", 5, -9 * day), event("4", "C", "PREPARED", "DELTA", 5, -8 * day)]),
        (3, [event("5", "D", "IMPORTED", "CUMULATIVE", 2, 3 * day)]),  # A and B become idle
        (4, [event("6", "A", "PREPARED", "DELTA", 3, 4 * day), event("7", "B", "PREPARED", "DELTA", 1, 1 * day)]),
        (9, [event("8", "B", "PREPARED", "DELTA", 4, 9 * day), event("9", "C", "IMPORTED", "DELTA", 1, -7 * day)]),
        (9, [event("11", "D", "IMPORTED", "DELTA", 1, 4 * day)]),  # late, and idle as before
        (9, [event("10", "A", "CANCELLED", "DELTA", 1, 9 * day)]),
    ]
    seen, reports = [], []
    for number, (later, rows) in enumerate(triggers):
        seen += rows
        clock = datetime(2026, 8, 3, 12) + timedelta(days=later)
        put(spark, inbox, number, *rows, rows[0])
        arrived = read_stream(spark, inbox)
        streams.ingest(
            arrived, out, clock=F.lit(clock.isoformat()).cast("timestamp"), idle_days=2
        ).awaitTermination()
        state = execution.fold(execution.normalize(spark.createDataFrame(seen, schemas.EXECUTION_EVENTS)))
        wanted = execution.idle(state, clock.date(), 2).select("line_id", "last_activity").collect()
        found = streams.read_idle(spark, out).select("line_id", "last_activity").collect()
        assert sorted(map(tuple, found)) == sorted(map(tuple, wanted))
        reports.append(sorted(r.line_id for r in found))
    assert reports == [[], ["A", "B"], ["B"], ["A", "C", "D"], ["A", "C", "D"], ["C", "D"]]


def test_the_work_of_a_trigger_does_not_grow_with_the_history(spark, tmp_path):
    """Twenty triggers in one query: every one reads its own rows and writes its own changes."""
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    rng = random.Random(9)
    seen = []
    for number in range(20):
        rows = [
            event(f"{number}-{n}", f"L{rng.randrange(6)}", "PREPARED", "CUMULATIVE", rng.randrange(50), rng.randrange(9000))
            for n in range(10)
        ]
        put(spark, inbox, number, *rows, *rng.sample(seen, min(3, len(seen))))
        seen += rows
    arrived = spark.readStream.schema(schemas.EXECUTION_EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{inbox}/*")
    run = streams.ingest(arrived, out)
    run.awaitTermination()
    read = [p.numInputRows for p in run.recentProgress if p.numInputRows]
    assert len(read) == 20 and max(read) <= 13
    written = streams.read_changes(spark, out).filter("kind = 'EVENT'").groupBy("batch").count().collect()
    assert [r["count"] for r in written] == [10] * 20
    events = spark.createDataFrame(seen, schemas.EXECUTION_EVENTS)
    batch = execution.fold(execution.normalize(events))
    assert sorted(map(tuple, streams.read_state(spark, out).select(*batch.columns).collect())) == sorted(
        map(tuple, batch.collect())
    )
    wanted = execution.to_delta(events).filter("record_type = 'CORRECTED'").collect()
    fixes = streams.read_corrections(spark, out).collect()
    assert sorted(r.dedup_key for r in fixes) == sorted(r.dedup_key for r in wanted)


def test_bounds_come_from_the_footers(spark, tmp_path):
    store = MonthlyStore(spark, str(tmp_path))
    assert tuple(store.bounds("stock_daily").first()) == (None, None, 0)
    days = [date(2026, 7, 30), date(2026, 7, 31), date(2026, 8, 4)]
    store.upsert("stock_daily", shelf(spark, [(d, 1, 1, "a") for d in days]), Span(days[0], days[-1]))
    found = store.bounds("stock_daily")
    assert tuple(found.first()) == (days[0], days[-1], 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(stock_date), MAX(stock_date), COUNT(*)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
