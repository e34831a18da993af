"""Windows, helpers for heavy keys, scope, stock, panel and freshness."""

from __future__ import annotations

import random
import statistics
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from replenish import schemas
from replenish.functions import windows
from replenish.functions.windows import Span
from replenish.operators import freshness, panel, promo, scale, scope, stock
from replenish.params import ScopeRule
from replenish.sources import files


def test_windows_follow_each_other_and_repeat_a_year_before():
    """Across a year end, after a leap day, and with unequal lengths."""
    for day in (date(2021, 1, 14), date(2028, 3, 1), date(2029, 2, 28), date(2025, 12, 31)):
        w = windows.build(day, recent_days=10, previous_days=33, seasonal_days=5)
        assert w.cutoff == w.recent.end == day - timedelta(days=1)
        assert w.previous.end == w.recent.start - timedelta(days=1)
        assert [w.spans[r].days for r in ("recent", "previous", "seasonal")] == [10, 33, 5]
        assert (w.seasonal.end.month, w.seasonal.end.year) == (w.cutoff.month, w.cutoff.year - 1)
        assert w.feature_start == w.seasonal.start
    assert windows.build(date(2028, 3, 1)).seasonal.end == date(2027, 2, 28)
    for name in ("recent_days", "previous_days", "seasonal_days"):
        with pytest.raises(ValueError):
            windows.build(date(2021, 1, 14), **{name: 0})


def test_months_cover_a_range_without_gaps():
    bounds = list(windows.months(date(2023, 11, 30), date(2024, 3, 1)))
    assert [b[0].month for b in bounds] == [11, 12, 1, 2, 3]
    assert all(left[1] == right[0] for left, right in zip(bounds, bounds[1:]))
    assert (bounds[3][1] - bounds[3][0]).days == 29
    with pytest.raises(ValueError):
        list(windows.months(date(2024, 3, 1), date(2024, 2, 29)))


@pytest.fixture
def many_chunks(spark):
    """Keep small data in several chunks, as large data is."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture
def heavy(spark):
    """2000 rows; one key has two thirds of them."""
    random.seed(7)
    rows = [
        ("hot" if random.random() < 0.66 else f"k{random.randint(0, 9)}", random.randint(0, 50), n,
         random.randint(-5, 20))
        for n in range(2000)
    ]
    return spark.createDataFrame(rows, "k string, t int, id int, v int")


def test_running_aggregates_match_a_plain_window(spark, many_chunks, heavy):
    order = [F.col("t"), F.col("id")]
    got = scale.running_before(
        heavy, ["k"], order, {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}
    )
    plain = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    expected = heavy.select("*", F.sum("v").over(plain).alias("s"), F.max("v").over(plain).alias("m"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        map(tuple, expected.collect()), key=str
    )


def test_heavy_key_spreads_over_chunks(spark, many_chunks, heavy):
    chunked = heavy.repartitionByRange("k", "t", "id").withColumn("c", F.spark_partition_id())
    spread = chunked.filter("k = 'hot'").select("c").distinct().count()
    assert spread >= 4


def test_global_rank_is_gap_free(spark, many_chunks, heavy):
    ranked = scale.global_rank(heavy, [F.col("v").desc(), F.col("id")], "r")
    rows = sorted((r["r"], -r["v"], r["id"]) for r in ranked.collect())
    assert [r[0] for r in rows] == list(range(1, 2001))
    assert [r[1:] for r in rows] == sorted(r[1:] for r in rows)


def test_exact_median(spark, many_chunks, heavy):
    rows = heavy.select("k", F.col("v").cast("decimal(18,6)").alias("value"))
    got = {r["k"]: float(r["median"]) for r in promo.exact_median(rows, ["k"]).collect()}
    values: dict[str, list[int]] = {}
    for r in heavy.collect():
        values.setdefault(r["k"], []).append(r["v"])
    assert got == {k: float(statistics.median(v)) for k, v in values.items()}


def test_semi_join_has_a_way_beyond_the_bound(spark, heavy):
    keys = spark.createDataFrame([("hot",), ("k1",)], "k string")
    small = scale.keep_matching(heavy, keys, ["k"])
    large = scale.keep_matching(heavy, keys, ["k"], limit=1)
    assert "Broadcast" in small._jdf.queryExecution().executedPlan().toString()
    assert small.count() == large.count() == heavy.filter("k in ('hot','k1')").count()


def test_bloom_filter_keeps_every_key_and_few_others(spark):
    keys = spark.range(0, 40_000, 4).selectExpr("cast(id as int) as a", "cast(id % 9 as int) as b")
    rows = spark.range(40_000).selectExpr("id as a", "id % 9 as b", "id as v")
    found = scale.bloom(keys, ["a", "b"])
    kept = found.keep(rows)
    assert kept.join(keys, ["a", "b"], "left_semi").count() == 10_000
    assert kept.count() < 10_000 + 0.02 * 30_000
    assert scale.bloom(keys.limit(0), ["a", "b"]).keep(rows).count() == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan.split("Subquery")[0]


def test_bloom_filter_gives_way_beyond_its_size(spark, monkeypatch):
    monkeypatch.setattr(scale, "BLOOM_WORDS", 16)
    keys = spark.range(200).selectExpr("id as a")
    assert scale.bloom(keys, ["a"]).keep(keys).count() == 200
    assert scale.bloom(spark.range(1000).selectExpr("id as a"), ["a"]) is None


CATALOG = [
    # article, branch, supplier, purchase, route, mode, enabled, sale, mix, extracted
    (1, 41, 10, 1, None, 0, 1, 1, 1, datetime(2026, 1, 1)),
    (2, 41, 20, 0, None, 0, 1, 1, 1, datetime(2026, 1, 1)),
    (1, 5, None, 1, "41CD", 0, 1, 1, 1, datetime(2026, 1, 1)),
    (1, 5, 99, 1, "41CD", 0, 1, 1, 1, None),
    (1, 6, 11, 1, "41CD", 1, 1, 1, 1, datetime(2026, 1, 1)),
    (1, 7, 12, 1, "DIRECT", 0, 1, 1, 1, datetime(2026, 1, 1)),
    (1, 8, 13, 1, "41CD", 0, 1, 1, 1, datetime(2026, 1, 1)),
    (1, 8, 14, 1, "41CD", 0, 1, 1, 1, datetime(2026, 1, 2)),
    (1, 9, 15, 1, "41CD", 0, 0, 1, 1, datetime(2026, 1, 1)),
    (2, 5, 21, 1, "41CD", 0, 1, 1, 1, datetime(2026, 1, 1)),
]


@pytest.fixture
def catalog(spark):
    return spark.createDataFrame(CATALOG, schemas.CATALOG)


def test_scope_takes_newest_row_and_inherits_supplier(catalog):
    got = {tuple(r) for r in scope.pairs(catalog).collect()}
    assert got == {(1, 5, 10), (1, 8, 14)}
    assert {tuple(r) for r in scope.stock_scope(catalog).collect()} == {(1, 5), (1, 8), (1, 41)}


def test_scope_checksum_golden(spark):
    row = spark.range(1).select(
        scope.scope_checksum(
            F.lit("38a30408a71e5ca607ae0646257e092ca992d76a0a81cf7895389db15d5d3a49"),
            F.lit("a6202b0b33353e491f0d8611627db0e2ef609e8432a077051998d89f16255cb9"),
        )
    )
    assert row.first()[0] == "7f85e68802278f26236740d5d133c6406b614c34c2455c9be388c8f0e92ee991"


def test_manifest_takes_the_newest_origin_supplier_and_has_one_checksum_form(spark, catalog):
    older = spark.createDataFrame(
        [(1, 41, 4, 1, None, 0, 1, 1, 1, datetime(2025, 12, 1))], schemas.CATALOG
    )
    before = scope.manifest(catalog).first()
    assert before["pair_count"] == 2
    assert scope.manifest(catalog.unionByName(older)).first() == before
    assert {tuple(r) for r in scope.pairs(catalog.unionByName(older)).collect()} == {
        (1, 5, 10), (1, 8, 14),
    }
    newer = older.withColumn("extracted_at", F.lit(datetime(2026, 2, 1)).cast("timestamp_ntz"))
    after = scope.manifest(catalog.unionByName(newer)).first()
    assert after["pair_count"] == 2 and after["pair_checksum"] != before["pair_checksum"]
    assert (1, 5, 4) in {tuple(r) for r in scope.pairs(catalog.unionByName(newer)).collect()}


def test_scope_version_is_reused_while_nothing_changes():
    rule = ScopeRule()
    first = scope.resolve_version(None, {"scope_checksum": "a"}, rule)
    same = scope.resolve_version(first, {"scope_checksum": "a"}, rule)
    other = scope.resolve_version(first, {"scope_checksum": "b"}, rule)
    moved = scope.resolve_version(first, {"scope_checksum": "a"}, ScopeRule(origin_id=42))
    assert same["scope_version_id"] == first["scope_version_id"] and not same["is_new"]
    assert other["is_new"] and other["version_no"] == 2 and moved["is_new"]


def wide(spark, year, month, quantities, processed=None):
    days = [Decimal(q) if q is not None else None for q in quantities] + [Decimal(9)] * (
        31 - len(quantities)
    )
    return spark.createDataFrame(
        [(year, month, 5, 1, *days, processed, False, "x")], schemas.WIDE_STOCK
    )


@pytest.fixture
def one_pair(spark):
    return spark.createDataFrame([(1, 5)], "article_id int, branch_id int")


def test_days_a_month_lacks_are_dropped(spark, one_pair):
    rows = stock.normalize(
        wide(spark, 2026, 2, [1]), one_pair, date(2026, 1, 1), date(2026, 3, 31)
    ).collect()
    assert len(rows) == 28 and max(r["stock_date"] for r in rows) == date(2026, 2, 28)


def test_closed_days_signs_and_unknown_quantities(spark, one_pair):
    source = wide(spark, 2026, 8, [-2, 0, None, 3], datetime(2026, 8, 5, 4))
    span = (date(2026, 8, 1), date(2026, 8, 31))
    rows = {r["stock_date"].day: r for r in stock.normalize(source, one_pair, *span).collect()}
    assert sorted(rows) == [1, 2, 4]
    assert [rows[d]["stock_sign_status"] for d in (1, 2, 4)] == ["NEGATIVE", "ZERO", "POSITIVE"]
    assert [rows[d]["is_serviceable"] for d in (1, 2, 4)] == [False, False, True]
    assert rows[1]["closed_day_rule"] == "PROCESS_DATE_MINUS_1"
    assert stock.unknown_quantities(source, one_pair, *span).count() == 1


def test_one_day_reads_one_day_column(spark, one_pair, tmp_path):
    wide(spark, 2026, 8, [1, 2, 3]).write.parquet(str(tmp_path / "w"))
    source = spark.read.schema(schemas.WIDE_STOCK).parquet(str(tmp_path / "w"))
    rows = stock.normalize(source, one_pair, date(2026, 8, 3), date(2026, 8, 3))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "q_day3" in plan and "q_day4" not in plan
    assert rows.first()["stock_quantity"] == Decimal(3)


DAY = datetime(2026, 7, 1)


def sale(article, units, price="10", promo=None, day=DAY):
    return (day, article, 5, Decimal(price), Decimal(units), Decimal("1.5"), None, promo, None, 1,
            2, 3, 7, day)


def build(spark, raw=(), enriched=(), shelf=()):
    pairs = spark.createDataFrame(
        [(a, 5, 70) for a in (1, 2, 3, 4, 5, 6)], "article_id int, branch_id int, supplier_id int"
    )
    stocks = spark.createDataFrame(
        [(DAY.date(), a, 5, Decimal(q), q > 0, f"hash{a}") for a, q in shelf],
        "stock_date date, article_id int, branch_id int, stock_quantity decimal(18,6), "
        "is_serviceable boolean, source_row_hash string",
    )
    rows = panel.build(
        pairs,
        spark.createDataFrame(list(raw), schemas.RAW_SALES),
        spark.createDataFrame(list(enriched), schemas.ENRICHED_SALES),
        stocks,
        Span(DAY.date(), DAY.date()),
    )
    return {r["article_id"]: r for r in rows.collect()}


def test_availability_matrix(spark):
    rows = build(
        spark,
        raw=[sale(1, 3), sale(2, -2)],
        shelf=[(1, 0), (3, 4), (4, 0), (5, -1)],
    )
    status = {a: r["availability_status"] for a, r in rows.items()}
    assert status == {
        1: "INFERRED_FROM_SALE", 2: "UNKNOWN", 3: "IN_STOCK", 4: "OUT_OF_STOCK",
        5: "OUT_OF_STOCK", 6: "UNKNOWN",
    }
    assert {a for a, r in rows.items() if r["eligible"]} == {1, 3}
    assert rows[2]["return_units"] == 2 and rows[2]["observed_units"] == 0
    assert rows[4]["exclusion_codes"] == ["OUT_OF_STOCK"] and rows[3]["exclusion_codes"] == []
    assert rows[3]["supplier_id"] == 70 and rows[1]["supplier_id"] == 7


def test_promotion_treatment(spark):
    rows = build(
        spark,
        raw=[sale(1, 4, promo=True), sale(2, 4, promo=True), sale(3, 4), sale(3, 2, "20")],
        enriched=[
            (DAY, 2, 5, Decimal(10), Decimal(4), Decimal(3), Decimal(1), Decimal(70), None, DAY),
            (DAY, 4, 5, Decimal(10), Decimal(5), Decimal(5), Decimal(0), Decimal(0), True, DAY),
        ],
    )
    assert rows[1]["promo_adjustment_method"] == "RAW_FLAGS" and rows[1]["basal_units"] == 0
    assert rows[1]["promo_units"] == 4 and not rows[1]["eligible"]
    assert rows[1]["exclusion_codes"] == ["PROMO_WITHOUT_ENRICHMENT"]
    assert rows[2]["promo_adjustment_method"] == "ENRICHED" and rows[2]["basal_units"] == 3
    assert rows[2]["eligible"]
    assert rows[3]["promo_adjustment_method"] == "NO_ADJUSTMENT"
    assert rows[3]["effective_unit_price"] == Decimal("13.333333")
    assert (rows[3]["min_price"], rows[3]["max_price"]) == (10, 20)
    # Enriched rows count even without a raw sale.
    assert rows[4]["basal_units"] == 5 and rows[4]["strong_promo_flag"]
    assert rows[5]["promo_adjustment_method"] == "NOT_APPLICABLE"


def test_a_run_removes_its_intermediate_tables(spark):
    with scale.run_folder(spark) as folder:
        kept = scale.materialise(spark.range(5))
        assert kept.count() == 5 and len(files.subfolders(spark, folder)) == 1
        with scale.run_folder(spark) as inner:
            assert inner.startswith(folder)
            scale.materialise(spark.range(2))
        assert not files.exists(spark, inner) and kept.count() == 5
    assert not files.exists(spark, folder)
    assert not scale.scratch(spark, "x").startswith(folder)


def test_freshness_gate(spark):
    raw = spark.createDataFrame([sale(1, 1)], schemas.RAW_SALES)
    enriched = spark.createDataFrame(
        [(DAY + timedelta(days=2), 1, 5, *[Decimal(1)] * 5, True, DAY)], schemas.ENRICHED_SALES
    )
    shelf = spark.createDataFrame([(date(2026, 7, 3),)], "stock_date date")
    months = wide(spark, 2026, 7, [1], datetime(2026, 7, 9))
    row = freshness.read(raw, enriched, months, shelf)
    found = freshness.require(row, date(2026, 7, 1))
    assert found.stock_source_date == date(2026, 7, 8)
    assert found.common_closed_date == date(2026, 7, 1)
    with pytest.raises(freshness.SourceNotClosed):
        freshness.require(row, date(2026, 7, 2))
    with pytest.raises(freshness.SourceNotClosed):
        freshness.require(freshness.read(raw, enriched, months, shelf.limit(0)), date(2026, 7, 1))
    assert freshness.gate(raw, enriched, months, shelf, date(2026, 7, 1)).common_closed_date is not None
    for end in (date(2026, 7, 2), date(2027, 1, 1)):
        with pytest.raises(freshness.SourceNotClosed, match="common closed date|no closed date"):
            freshness.gate(raw, enriched, months, shelf, end)
    # A month without a processing time counts as closed to its end.
    assert freshness.read(raw, enriched, wide(spark, 2026, 2, [1]), shelf).first()[
        "stock_source_date"
    ] == date(2026, 2, 28)


def test_promo_split_conserves_units(spark):
    rows = [sale(1, u, p) for u, p in ((2, "10"), (2, "10"), (9, "7"), (-1, "10"), (4, "8.9"))]
    raw = spark.createDataFrame(rows, schemas.RAW_SALES)
    split = promo.split(raw, promo.monthly_baseline(raw)).collect()
    by_units = {int(r["units"]): r for r in split}
    assert by_units[9]["promo_score"] == 100 and by_units[9]["basal_units"] == 2
    assert by_units[4]["promo_score"] == 70 and by_units[4]["promo_units"] == 2
    assert by_units[-1]["basal_units"] == -1
    assert all(r["units"] == r["basal_units"] + r["promo_units"] for r in split)


def test_the_ordered_manifest_refuses_a_scope_that_is_too_large(spark):
    from replenish.fixtures import adapters

    catalog = adapters.catalog(spark, "/root/testdata/sf0.001")
    assert scope.ordered_manifest(catalog).first()["pair_count"] > 0
    with pytest.raises(ValueError, match="too many"):
        scope.ordered_manifest(catalog, most_rows=10)
