"""The registered queries: every operator over the shared test tables."""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replenish import schemas, sources
from replenish.fixtures import adapters as fx
from replenish.functions import windows
from replenish.functions.exprs import checksum, dec, num
from replenish.functions.windows import Span
from replenish.operators import (
    audit,
    backlog,
    backtest,
    demand,
    execution,
    freshness,
    logistics,
    needs,
    panel,
    position,
    promo,
    publish,
    quality,
    reconcile,
    scope,
    stock,
)
from replenish.operators.demand import RunIds
from replenish.operators.scale import materialise, scratch
from replenish.params import ORIGIN_ID, ScopeRule
from replenish.plans import pipelines
from replenish.sources.store import MonthlyStore
from replenish.streaming import events as stream_events

T = fx.BUSINESS_DATE
W = fx.WINDOWS
IDS = RunIds("run-1", "model-1", "scope-1", ORIGIN_ID)
AS_OF_EVENTS = date(2024, 1, 31)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


class Frames:
    """The input relations and the stored tables of one session and data folder.

    Scope, daily stock, panel, estimates and positions are written once, as a run does, and the
    queries downstream read the written tables. Queries about these steps themselves build them
    anew (`build_panel`, `normalized`).
    """

    _open: dict[tuple[str, str], Frames] = {}

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Frames:
        key = (spark.sparkContext.applicationId, folder)
        if key not in cls._open:
            cls._open[key] = cls(spark, folder)
        return cls._open[key]

    @cached_property
    def catalog(self) -> DataFrame:
        return fx.catalog(self.spark, self.folder)

    @cached_property
    def pairs(self) -> DataFrame:
        return materialise(scope.pairs(self.catalog))

    @cached_property
    def later_pairs(self) -> DataFrame:
        return scope.pairs(fx.later_catalog(self.spark, self.folder))

    @cached_property
    def raw(self) -> DataFrame:
        return fx.raw_sales(self.spark, self.folder)

    @cached_property
    def enriched(self) -> DataFrame:
        return fx.enriched_sales(self.spark, self.folder)

    @cached_property
    def history(self) -> Span:
        return fx.history(self.spark, self.folder)

    @cached_property
    def wide(self) -> DataFrame:
        return fx.wide_stock(self.spark, self.folder, self.history)

    @cached_property
    def stock_scope(self) -> DataFrame:
        return materialise(scope.stock_scope(self.catalog))

    def normalized(self, start: date, end: date) -> DataFrame:
        return stock.normalize(self.wide, self.stock_scope, start, end)

    @cached_property
    def stock(self) -> DataFrame:
        return materialise(self.normalized(self.history.start, self.history.end))

    def build_panel(self, spans: list[Span]) -> DataFrame:
        return panel.build(self.pairs, self.raw, self.enriched, self.stock, spans)

    @cached_property
    def history_panel(self) -> DataFrame:
        return materialise(self.build_panel([self.history]))

    @cached_property
    def panel(self) -> DataFrame:
        """Panel rows of the three windows of the business date."""
        return self.history_panel.filter(W.holds(F.col("sales_date")))

    def estimate(self, day: date) -> DataFrame:
        return demand.estimate(self.history_panel, self.pairs, windows.build(day), IDS)

    @cached_property
    def estimates(self) -> DataFrame:
        return materialise(self.estimate(T))

    @cached_property
    def every_date(self) -> list[date]:
        """Every day of the history that has a year before it and a day after it."""
        first = self.history.start + timedelta(days=394)
        return [first + timedelta(days=n) for n in range((self.history.end - first).days)]

    @cached_property
    def backtest(self) -> DataFrame:
        """The estimates of every day of the history, scored one day ahead."""
        dates, one = self.every_date, timedelta(days=1)
        estimates = demand.estimates(self.history_panel, self.pairs, dates, IDS)
        return materialise(
            backtest.detail(
                estimates, self.history_panel, dates[0] + one, dates[-1] + one, IDS, 1
            )
        )

    @cached_property
    def positions(self) -> DataFrame:
        return materialise(self.build_positions())

    def build_positions(self) -> DataFrame:
        inputs = fx.position_inputs(self.stock, self.pairs)
        return position.branch(inputs, self.estimates, fx.parameters(self.spark, self.folder))

    @cached_property
    def items(self) -> DataFrame:
        return fx.item_logistics(self.spark, self.folder)

    @cached_property
    def needs(self) -> DataFrame:
        return needs.automatic(self.positions, self.items)

    @cached_property
    def open_needs(self) -> DataFrame:
        """Automatic needs after a pipeline that covers part of them."""
        pipeline = self.pairs.select(
            "article_id", "branch_id",
            dec((F.col("article_id") + F.col("branch_id")) % 4).alias("pipeline_quantity"),
        )
        return needs.automatic_balance(self.needs, pipeline)

    @cached_property
    def directed(self) -> DataFrame:
        return needs.directed_balance(fx.directed_needs(self.spark, self.folder), T)

    @cached_property
    def sources(self) -> DataFrame:
        return materialise(
            backlog.all_sources(
                backlog.automatic_sources(self.open_needs),
                backlog.directed_sources(self.directed, T, self.pairs),
            )
        )

    @cached_property
    def line_execution(self) -> DataFrame:
        """What was imported and prepared per pair so far."""
        a, b = F.col("article_id"), F.col("branch_id")
        return self.pairs.select(
            "article_id", "branch_id",
            dec((a * 3 + b) % 40).alias("imported_quantity"),
            dec(F.when(a % 3 == 0, (a * 3 + b) % 40).when(a % 3 == 1, (a + b) % 10).otherwise(0))
            .alias("prepared_quantity"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        return materialise(self.build_lines())

    def build_lines(self) -> DataFrame:
        return backlog.consolidate(self.sources, self.line_execution, self.items, self.positions)

    @cached_property
    def ranked(self) -> DataFrame:
        return materialise(backlog.prioritize(self.lines, T))

    @cached_property
    def events(self) -> DataFrame:
        return execution.normalize(
            execution.dedup(fx.execution_events(self.spark, self.folder))
        )

    @cached_property
    def stream_folder(self) -> str:
        """The events through the stream, one trigger per delivery; the folder of its tables."""
        folder, files = scratch(self.spark, "stream"), 4
        for number, rows in enumerate(fx.deliveries(self.spark, self.folder)):
            rows.repartition(files).write.parquet(f"{folder}/in/d{number}")
        arrived = (
            self.spark.readStream.schema(rows.schema)
            .option("maxFilesPerTrigger", files)
            .parquet(f"{folder}/in/*")
        )
        clock = F.lit(AS_OF_EVENTS.isoformat()).cast("timestamp")
        stream_events.ingest(arrived, f"{folder}/out", clock=clock).awaitTermination()
        return f"{folder}/out"

    @cached_property
    def import_lines(self) -> DataFrame:
        return fx.import_lines(self.spark, self.folder)


def query(build: Callable[[Frames], DataFrame]) -> Callable[[Frames], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Frames.of(spark, folder))
    return build


def d(name: str | Column, alias: str | None = None, places: int = 6) -> Column:
    """A numeric output column: double, rounded alike in both engines."""
    column = F.col(name) if isinstance(name, str) else name
    return F.round(column.cast("double"), places).alias(alias or str(name))


def joined(name: str) -> Column:
    return F.array_join(F.array_sort(name), ",").alias(name)


PAIR = ["article_id", "branch_id"]


@query
def scope_pairs(f: Frames) -> DataFrame:
    return scope.pairs(f.catalog)


@query
def stock_scope(f: Frames) -> DataFrame:
    return scope.stock_scope(f.catalog)


@query
def scope_manifest(f: Frames) -> DataFrame:
    return scope.manifest(f.catalog).withColumn(
        "source_as_of_ts", F.col("source_as_of_ts").cast("string")
    )


@query
def scope_snapshot(f: Frames) -> DataFrame:
    return scope.pair_snapshot(f.catalog, "scope-1").select(
        "branch_id", "article_id", "supplier_id", "route_code", "supply_mode", "enabled",
        "active_for_sale", "active_on_mix",
    )


@query
def scope_diff(f: Frames) -> DataFrame:
    return scope.diff(f.pairs, f.later_pairs)


@query
def scope_variation(f: Frames) -> DataFrame:
    return scope.variation(f.pairs, f.later_pairs)


@query
def stock_unpivot(f: Frames) -> DataFrame:
    span = f.history
    days = stock.unpivot_days(f.wide, span.start, span.end)
    return days.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("days"),
        d(F.sum("quantity"), "quantity"),
        F.min("stock_date").alias("first_day"),
        F.max("stock_date").alias("last_day"),
    )


def _condensed_stock(rows: DataFrame, *by: str) -> DataFrame:
    """Every row counts: days, quantity and a checksum of the row digests."""
    return rows.groupBy(*PAIR, *by).agg(
        F.count(F.lit(1)).alias("days"),
        d(F.sum("stock_quantity"), "stock_quantity"),
        checksum("source_row_hash").cast("string").alias("rows_checksum"),
    )


@query
def stock_daily(f: Frames) -> DataFrame:
    span = f.history
    rows = f.normalized(span.start, span.end).filter(
        F.col("source_day") == F.day("stock_date")
    )
    return _condensed_stock(rows, "stock_sign_status", "is_serviceable", "closed_day_rule")


@query
def stock_upsert(f: Frames) -> DataFrame:
    """Load the history, then load it again with some quantities corrected; read the table back."""
    span = f.history
    store = MonthlyStore(f.spark, scratch(f.spark, "store"))
    store.upsert("stock_daily", f.normalized(span.start, span.end), span)
    column = schemas.DAY_COLUMNS[9]
    corrected = f.wide.withColumn(
        column, F.when(F.col("article_id") % 4 == 0, F.col(column) + 1).otherwise(F.col(column))
    )
    store.upsert(
        "stock_daily", stock.normalize(corrected, f.stock_scope, span.start, span.end), span
    )
    return _condensed_stock(store.read("stock_daily", span))


@query
def stock_coverage(f: Frames) -> DataFrame:
    span = f.history
    daily = stock.coverage(f.stock, f.pairs, span.start, span.end)
    return stock.coverage_alerts(daily).select(
        "stock_date", "expected_pairs", "known_pairs", "positive_pairs", "low_coverage",
        "sharp_drop",
    )


@query
def calendar_panel(f: Frames) -> DataFrame:
    span = f.history
    return (
        panel.calendar_panel(f.pairs, span.start, span.end)
        .groupBy(*PAIR)
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.min("sales_date").alias("first_day"),
            F.max("sales_date").alias("last_day"),
        )
    )


@query
def raw_daily_rollup(f: Frames) -> DataFrame:
    span = f.history
    return panel.raw_daily(f.raw, span.start, span.end).select(
        "sales_date", *PAIR, "source_row_count", d("observed_units"), d("return_units"),
        d("sold_amount", places=2), d("effective_unit_price"), d("min_price"),
        d("max_price"),
        "special_sale_flag", "normal_promo_flag", "strong_promo_flag", "family_id", "category_id",
        "subcategory_id", "sales_supplier_id",
        F.to_date("source_max_processed_at").alias("processed_day"),
    )


@query
def enriched_daily_rollup(f: Frames) -> DataFrame:
    span = f.history
    return panel.enriched_daily(f.enriched, span.start, span.end).select(
        "sales_date", *PAIR, "enriched_row_count", d("enriched_basal_units"),
        d("enriched_promo_units"), d("promo_score_max"), "strong_promo_detected",
    )


@query
def sales_panel(f: Frames) -> DataFrame:
    return f.build_panel(W.load_ranges()).select(
        "sales_date", *PAIR, "supplier_id", "family_id", "category_id", "source_row_count",
        d("observed_units"), d("return_units"), d("basal_units"), d("promo_units"),
        d("sold_amount", places=2), d("effective_unit_price"), "assortment_active",
        "availability_status", d("stock_quantity_snapshot"), "special_sale_flag",
        "normal_promo_flag", "strong_promo_flag", d("promo_score_max"),
        "promo_adjustment_method", "eligible",
        F.array_join("exclusion_codes", ",").alias("exclusion_codes"), "source_hash",
    )


def _condensed_panel(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if("eligible").alias("eligible_days"),
        d(F.sum("observed_units"), "observed_units"),
        d(F.sum("return_units"), "return_units"),
        d(F.sum("basal_units"), "basal_units"),
        d(F.sum("promo_units"), "promo_units"),
        checksum("source_hash").cast("string").alias("panel_checksum"),
    )


@query
def panel_history(f: Frames) -> DataFrame:
    """The whole dense panel, condensed per pair."""
    return _condensed_panel(f.build_panel([f.history]))


@query
def panel_by_bloom(f: Frames) -> DataFrame:
    """The same panel as for a scope that is too large to broadcast."""
    return _condensed_panel(
        panel.build(f.pairs, f.raw, f.enriched, f.stock, f.history, limit=0)
    )


@query
def availability_matrix(f: Frames) -> DataFrame:
    stock_state = (
        F.when(F.col("stock_quantity_snapshot").isNull(), "ABSENT")
        .when(F.col("stock_quantity_snapshot") > 0, "POSITIVE")
        .when(F.col("stock_quantity_snapshot") == 0, "ZERO")
        .otherwise("NEGATIVE")
    )
    return f.history_panel.groupBy(
        (F.col("observed_units") > 0).alias("has_sale"),
        stock_state.alias("stock_state"),
        "availability_status", "promo_adjustment_method", "eligible",
    ).agg(F.count(F.lit(1)).alias("days"))


@query
def demand_stats(f: Frames) -> DataFrame:
    stats = demand.window_stats(f.panel, f.pairs, W)
    roles = ("recent", "previous", "seasonal")
    return stats.select(
        *PAIR, "supplier_id", "active_days", "eligible_days", "nonzero_days",
        "promo_reliable_days",
        *[f"{r}_active_days" for r in roles], *[f"{r}_eligible_days" for r in roles],
        *[d(f"{r}_basal_units") for r in roles], *[d(f"{r}_mean") for r in roles],
        F.sha2(F.coalesce("feature_hashes", F.lit("")), 256).alias("features_digest"),
    )


@query
def demand_weights(f: Frames) -> DataFrame:
    scored = demand.score(demand.window_stats(f.panel, f.pairs, W, with_hashes=False))
    return scored.select(
        *PAIR, d("available_weight"), "total_window_eligible_days", "is_blocked",
        d("recent_weight"), d("previous_weight"), d("seasonal_weight"),
    )


@query
def demand_estimate(f: Frames) -> DataFrame:
    return f.estimate(T).select(
        "business_date", *PAIR, "supplier_id", "method_code",
        F.col("fallback_level").cast("int").alias("fallback_level"), "status",
        d("confidence_score"), "lookback_start", "lookback_end", "active_days", "eligible_days",
        "nonzero_days", d("availability_coverage"), d("promo_coverage"), d("adi"),
        d("cv2"), d("raw_demand"), d("basal_daily_demand"), "input_checksum",
        F.col("explanation.cutoff_date").alias("cutoff_date"),
        d(F.col("explanation.available_weight"), "available_weight"),
    )


@query
def demand_status_counts(f: Frames) -> DataFrame:
    return demand.status_counts(f.estimates).select(
        "status", "method_code", F.col("fallback_level").cast("int").alias("fallback_level"),
        "pairs", d("total_daily_demand"),
    )


@query
def network_fallback(f: Frames) -> DataFrame:
    return demand.network_fallback(f.estimates).select(
        *PAIR, "status", "method_code", F.col("fallback_level").cast("int").alias("fallback_level"),
        d("basal_daily_demand"),
    )


@query
def network_shrinkage(f: Frames) -> DataFrame:
    return demand.network_shrinkage(f.estimates, demand.window_evidence(f.panel, W)).select(
        *PAIR, "status", "method_code", F.col("fallback_level").cast("int").alias("fallback_level"),
        d("basal_daily_demand"),
    )


@query
def freshness_gate(f: Frames) -> DataFrame:
    return freshness.read(f.raw, f.enriched, f.wide, f.stock)


@query
def source_profile(f: Frames) -> DataFrame:
    relations = {
        "raw_sales": (f.raw, "sales_ts", ["article_id", "branch_id", "special_sale"], "processed_at"),
        "enriched_sales": (f.enriched, "sales_ts", ["article_id", "branch_id"], None),
        "directed_needs": (
            fx.directed_needs(f.spark, f.folder), "valid_from", ["line_id", "need_type"], None
        ),
        "stock": (f.stock, "stock_date", ["article_id", "branch_id"], None),
        "events": (f.events, "occurred_at", ["dedup_key"], "received_at"),
        "catalog": (f.catalog, "extracted_at", ["article_id", "branch_id"], None),
    }
    merged = None
    for code, (rows, day, columns, as_of) in relations.items():
        one = freshness.profile(
            rows, code, day, W.cutoff, columns, as_of, code != "events", f"batch-{code}"
        )
        merged = one if merged is None else merged.unionByName(one)
    return merged.withColumns(
        {"checksum": F.col("checksum").cast("string"), "as_of_ts": F.col("as_of_ts").cast("string")}
    )


def _condensed_errors(rows: DataFrame, day: str, *more: str) -> DataFrame:
    """Every row counts: sums by pair and status, and a checksum of the rows without an order."""
    fields = [day, "evaluation_date", "predicted_demand", "actual_basal_units", "error_units", "status", *more]
    return rows.groupBy(*PAIR, "status").agg(
        F.count(F.lit(1)).alias("cases"),
        d(F.sum("predicted_demand"), "predicted_demand"),
        d(F.sum("actual_basal_units"), "actual_basal_units"),
        d(F.sum("error_units"), "error_units"),
        d(F.sum("absolute_error_units"), "absolute_error_units"),
        d(F.sum("squared_error"), "squared_error", places=8),
        checksum(F.concat_ws("|", *[F.col(c).cast("string") for c in fields])).cast("string").alias("rows_checksum"),
    )


@query
def backtest_detail(f: Frames) -> DataFrame:
    rows = f.backtest.withColumn("codes", F.array_join("exclusion_codes", ","))
    return _condensed_errors(
        rows, "origin_date", "horizon_days", "eligible_actual", "codes", "input_checksum"
    )


@query
def backtest_metrics(f: Frames) -> DataFrame:
    rows = f.backtest
    return backtest.metrics(rows, f.history.start, f.history.end).select(
        "model_version_id", "horizon_days", "segment_type", "segment_id", "metric_code",
        d("metric_value"), "sample_size", "zero_actual_count",
    )


@query
def backtest_rolling(f: Frames) -> DataFrame:
    """One row per case: every date of every pair that is not blocked."""
    return backtest.rolling(f.history_panel, f.pairs, f.every_date).select(
        "business_date", "evaluation_date", *PAIR, d("predicted_demand"), d("actual_basal_units"),
        d("error_units"), d("absolute_error_units"), d("squared_error", places=8), "status",
    )


@query
def model_compare(f: Frames) -> DataFrame:
    return backtest.compare(f.history_panel, f.pairs, f.every_date).select(
        "variant", "segment_type", "segment_id", "metric_code", d("metric_value"), "sample_size",
        "zero_actual_count",
    )


@query
def model_acceptance(f: Frames) -> DataFrame:
    two = {"ESTIMATE": backtest.VARIANTS["ESTIMATE"]}
    return backtest.acceptance(
        backtest.compare(f.history_panel, f.pairs, f.every_date, variants=two)
    ).select("segment_type", "segment_id", "metric_code", d("candidate"), d("baseline"), "accepted")


@query
def trailing_mean28(f: Frames) -> DataFrame:
    return (
        demand.trailing_mean(f.history_panel)
        .groupBy(*PAIR)
        .agg(
            F.count("trailing_mean").alias("days"),
            d(F.sum("trailing_mean"), "sum_of_means"),
            d(F.max("trailing_mean"), "highest_mean"),
        )
    )


@query
def monthly_median_baseline(f: Frames) -> DataFrame:
    return promo.monthly_baseline(f.raw).select(
        "month", *PAIR, d("median_units"), d("median_price"), "records"
    )


@query
def promo_split(f: Frames) -> DataFrame:
    split = promo.split(f.raw, materialise(promo.monthly_baseline(f.raw)))
    return split.groupBy(*PAIR, "promo_score").agg(
        F.count(F.lit(1)).alias("records"),
        d(F.sum("units"), "units"),
        d(F.sum("basal_units"), "basal_units"),
        d(F.sum("promo_units"), "promo_units"),
    )


@query
def reconciliation_profile(f: Frames) -> DataFrame:
    return promo.reconciliation(f.enriched).select(
        "month", "row_count", "null_rows", "conservation_breaks", "scored_rows", "strong_rows",
        d("units"), d("basal_units"), d("promo_units"),
    )


def _every_position(f: Frames, later: int = 0) -> DataFrame:
    """A position of every pair on every day that has estimates, and some days beyond."""
    days = F.sequence(F.lit(f.every_date[0]), F.lit(f.every_date[-1] + timedelta(days=later)))
    return f.pairs.select(*PAIR, "supplier_id", F.explode(days).alias("business_date"))


@query
def asof_estimate(f: Frames) -> DataFrame:
    """The newest estimate before the position of every day; some days have no estimate."""
    estimates = demand.rolling(f.history_panel, f.pairs, f.every_date).withColumns(
        {"run_id": F.lit("run-1"), "created_at": F.lit("2001-01-01").cast("timestamp_ntz")}
    )
    left = F.pmod(F.unix_date("business_date") + F.col("article_id"), F.lit(5)) != 0
    found = position.asof_estimate(_every_position(f, 11), estimates.filter(left))
    fields = ["business_date", "estimate_date", "estimate_status"]
    return found.groupBy(*PAIR, "estimate_status").agg(
        F.count(F.lit(1)).alias("positions"),
        d(F.sum("basal_daily_demand"), "basal_daily_demand"),
        checksum(F.concat_ws("|", *[F.col(c).cast("string") for c in fields])).cast("string").alias("rows_checksum"),
    )


@query
def interval_params(f: Frames) -> DataFrame:
    """The parameters of every pair on every day."""
    found = position.with_parameters(_every_position(f), fx.parameters(f.spark, f.folder))
    return found.groupBy(*PAIR, "parameter_level").agg(
        F.min("business_date").alias("first_date"),
        F.max("business_date").alias("last_date"),
        F.count(F.lit(1)).alias("positions"),
        *[d(F.sum(v), v) for v in position.PARAMETER_VALUES],
    )


@query
def net_stock(f: Frames) -> DataFrame:
    return f.build_positions().select(
        "business_date", *PAIR, "supplier_id", d("physical_stock"), d("direct_po_inbound"),
        d("cd_in_transit"), d("special_sale_committed"), d("net_stock"), "calculation_status",
        joined("alert_codes"),
    )


@query
def thresholds(f: Frames) -> DataFrame:
    return f.positions.select(
        *PAIR, d("basal_daily_demand"), d("critical_stock"), d("minimum_stock"),
        d("maximum_stock"), d("overstock_quantity"), d("coverage_days"),
    )


@query
def needs_ds(f: Frames) -> DataFrame:
    return f.needs.select(
        *PAIR, "need_type", "is_mandatory", d("calculated_quantity"), d("rounding_unit"),
        d("rounded_quantity"), "calculation_status", "risk_score",
    )


@query
def run_summary(f: Frames) -> DataFrame:
    return needs.summary(f.needs).select(
        "need_type", "is_mandatory", "calculation_status", "rows", d("quantity"), "warnings"
    )


@query
def run_controls(f: Frames) -> DataFrame:
    """Controls of the run against a later scope and the previous estimate."""
    issues = quality.run_controls(f.estimates, f.later_pairs, _current(f))
    return quality.issue_counts(issues)


@query
def import_versions(f: Frames) -> DataFrame:
    checked = execution.version_check(fx.import_requests(f.spark, f.folder), f.import_lines)
    return checked.groupBy("line_id", "version_status").agg(F.count(F.lit(1)).alias("requests"))


@query
def stockout_risk(f: Frames) -> DataFrame:
    return f.needs.filter(F.col("need_type") == "D").groupBy("risk_score").agg(
        F.count(F.lit(1)).alias("pairs"), d(F.sum("calculated_quantity"), "needed")
    )


@query
def automatic_balance(f: Frames) -> DataFrame:
    return f.open_needs.select(*PAIR, "need_type", d("rounded_quantity"), d("open_quantity"))


@query
def rounding_logistics(f: Frames) -> DataFrame:
    return logistics.estimate(f.needs, f.items, "rounded_quantity").select(
        *PAIR, "need_type", d("rounded_quantity"), d("estimated_packages", places=4),
        d("estimated_pallets", places=4), d("estimated_weight_kg", places=4),
        d("estimated_volume_m3", places=4), "logistics_status", "logistics_data_missing",
    )


@query
def directed_balance(f: Frames) -> DataFrame:
    return f.directed.select(
        "line_id", "need_type", "is_mandatory", d("original_quantity"), d("open_quantity"),
        "line_status", "is_expired",
    )


@query
def need_validation(f: Frames) -> DataFrame:
    """Directed lines checked against masters that lack one article and one branch."""
    lines = fx.directed_needs(f.spark, f.folder)
    articles = f.catalog.filter(F.col("article_id") != 9).select("article_id")
    branches = f.catalog.filter(F.col("branch_id") != 3).select("branch_id")
    checked = needs.validate(lines, articles, branches, ["reference", "article_id", "branch_id"])
    return checked.groupBy(joined("reject_codes")).agg(
        F.count(F.lit(1)).alias("lines"), d(F.sum("original_quantity"), "quantity")
    )


@query
def need_masters(f: Frames) -> DataFrame:
    """Directed lines with suppliers and units, some of which no master knows."""
    a, b = F.col("article_id"), F.col("branch_id")
    lines = fx.directed_needs(f.spark, f.folder).withColumns(
        {
            "supplier_id": F.when(a % 2 == 0, a * 10).cast("int"),
            "unit": F.when(b % 6 == 0, "KG").otherwise("UN"),
        }
    )
    suppliers = f.catalog.filter(a % 4 != 0).select((a * 10).alias("supplier_id"))
    masters = f.catalog.select("article_id").distinct(), f.catalog.select("branch_id").distinct()
    checked = needs.validate(lines, *masters, ["line_id"], suppliers, f.items)
    return checked.groupBy(joined("reject_codes")).agg(F.count(F.lit(1)).alias("lines"))


@query
def reference_alerts(f: Frames) -> DataFrame:
    found = needs.duplicate_candidates(fx.directed_needs(f.spark, f.folder))
    return backlog.reference_alerts(found)


@query
def duplicate_needs(f: Frames) -> DataFrame:
    return needs.duplicate_candidates(fx.directed_needs(f.spark, f.folder)).select(
        "line_id", "need_type", "reference", *PAIR, "valid_from", "valid_to", "overlaps_earlier",
        "overlaps_later",
    )


@query
def backlog_consolidated(f: Frames) -> DataFrame:
    return f.build_lines().select(
        "line_id", "origin_id", *PAIR, "supplier_key",
        *[d(f"{k}_open_quantity") for k in "decas"],
        d("mandatory_open_quantity"), d("optional_open_quantity"), d("total_open_quantity"),
        "risk_score", "oldest_need_date", "target_date", "commitment_date", "source_count",
        d("imported_quantity"), d("prepared_quantity"), d("in_transit_quantity"),
        "logistics_status",
    )


@query
def backlog_priority(f: Frames) -> DataFrame:
    return backlog.prioritize(f.lines, T).select("line_id", "priority_class", "risk_score", "priority_rank")


@query
def top_priorities(f: Frames) -> DataFrame:
    return backlog.top_priorities(f.ranked, 5).select(
        "line_id", "priority_rank", d("total_open_quantity")
    )


WANTED = backlog.Search(
    origin_id=ORIGIN_ID, need_types=("D", "C"), mandatory_only=True,
    complete_logistics_only=True,
)


@query
def backlog_page(f: Frames) -> DataFrame:
    return backlog.search(f.ranked, WANTED, page=2, page_size=25).select(
        "position", "line_id", "priority_rank"
    )


def _snapshots(f: Frames) -> backlog.Snapshots:
    """The backlog as version v1, and a later one without some articles as v2."""
    kept = backlog.Snapshots(f.spark, scratch(f.spark, "snapshots"))
    kept.add("v1", f.ranked)
    kept.add("v2", f.ranked.filter(F.col("article_id") % 7 != 0))
    return kept


@query
def backlog_snapshot_page(f: Frames) -> DataFrame:
    """Two pages of the first version, asked for after the second was written."""
    kept = _snapshots(f)
    pages = [kept.search("v1", WANTED, page=n, page_size=25) for n in (1, 2)]
    return pages[0].unionByName(pages[1]).select(
        "snapshot_version", "position", "line_id", "priority_rank"
    )


@query
def backlog_snapshot_totals(f: Frames) -> DataFrame:
    kept = _snapshots(f)
    return kept.totals("v1", WANTED).unionByName(kept.totals("v2", WANTED)).select(
        "snapshot_version", "lines", d("units", places=3), d("mandatory_units", places=3)
    )


@query
def backlog_search_totals(f: Frames) -> DataFrame:
    return backlog.search_totals(f.ranked, WANTED).select(
        "lines", d("units", places=3), d("mandatory_units", places=3),
        d("optional_units", places=3), d("kg", places=2), d("packages", places=2),
        d("pallets", places=2),
    )


@query
def attribution(f: Frames) -> DataFrame:
    """Prepared quantity of each pair over all its open sources."""
    sources = f.sources.withColumn("supplier_key", F.lit(backlog.NO_SUPPLIER))
    prepared = f.line_execution.select(
        *PAIR, dec(F.col("prepared_quantity") * 20).alias("prepared_quantity")
    )
    return backlog.attribute(sources, prepared, T, PAIR).select(
        *PAIR, "need_type", "source_id", "attribution_step", d("open_quantity"),
        d("allocated_quantity"),
    )


@query
def cd_coverage(f: Frames) -> DataFrame:
    return position.center(
        fx.center_inputs(f.spark, f.folder), fx.purchase_orders(f.spark, f.folder), f.lines, T
    ).select(
        "business_date", "article_id", d("physical_stock"), d("open_po_on_time"),
        d("open_po_overdue"), d("mandatory_backlog"), d("optional_backlog"),
        d("coverage_index"), "status",
    )


def _watched(f: Frames) -> DataFrame:
    """Backlog lines with what their execution last reported."""
    a, b = F.col("article_id"), F.col("branch_id")
    return f.lines.withColumns(
        {
            "freshness_status": backlog.freshness_status(
                F.when(a % 8 != 7, F.date_sub(F.lit(T), F.when(b % 9 == 0, 3).otherwise(1))),
                W.cutoff,
            ),
            "last_activity": F.date_sub(F.lit(T), b % 5).cast("timestamp_ntz"),
            "last_status": F.when(a % 11 == 0, "UNKNOWN").otherwise("IMPORTED"),
        }
    )


@query
def backlog_alerts(f: Frames) -> DataFrame:
    return backlog.alerts(_watched(f), T).select("line_id", "alert_code", "freshness_status")


@query
def panel_kpis(f: Frames) -> DataFrame:
    return backlog.panel_kpis(f.lines, T)


@query
def run_difference(f: Frames) -> DataFrame:
    """Needs of the run against a run whose demand grew for some pairs."""
    grown = f.positions.withColumn(
        "net_stock",
        F.when(F.col("branch_id") % 4 == 0, dec(F.col("net_stock") - 2)).otherwise(
            F.col("net_stock")
        ),
    ).filter(F.col("article_id") != 7)
    after = needs.automatic(grown, f.items)
    return backlog.run_difference(
        f.needs, after, [*PAIR, "need_type"], ["calculated_quantity", "risk_score"]
    ).select(
        *PAIR, "need_type", "change",
        F.array_join("changed_columns", ",").alias("changed_columns"),
    )


@query
def import_outcomes(f: Frames) -> DataFrame:
    return execution.confirm_imports(
        fx.import_requests(f.spark, f.folder), f.import_lines,
        fx.accepted_imports(f.spark, f.folder),
    ).select(
        "idempotency_key", "line_id", "line_version", d("quantity"), "outcome", "replays"
    )


@query
def import_header_totals(f: Frames) -> DataFrame:
    state = execution.fold(f.events)
    lines = state.withColumn(
        "import_id", F.concat(F.lit("IMP-"), F.col("line_id").cast("bigint") % 50)
    )
    return execution.import_totals(lines).select(
        "import_id", "line_count", d("total_imported_quantity", places=3),
        d("total_prepared_quantity", places=3),
    )


@query
def events_dedup_fold(f: Frames) -> DataFrame:
    return _state(execution.fold(f.events))


def _state(state: DataFrame) -> DataFrame:
    return state.select(
        "line_id", *[d(f"{k.lower()}_quantity", places=3) for k in execution.QUANTITY_KINDS],
        "last_status", F.to_date("last_activity").alias("last_day"), "event_count",
        "unknown_events",
    )


@query
def cumulative_to_delta(f: Frames) -> DataFrame:
    return execution.to_delta(f.events).select(
        "dedup_key", "line_id", "event_type", "quantity_mode", d("quantity"),
        d("delta_quantity"), "record_type", joined("correction_alert"),
    )


@query
def status_normalized(f: Frames) -> DataFrame:
    return f.events.select(
        "dedup_key", "external_status", "normalized_status", joined("alert_codes")
    )


@query
def events_quarantine(f: Frames) -> DataFrame:
    _, isolated = execution.quarantine(f.events, f.import_lines)
    return isolated.select("dedup_key", "line_id", joined("isolation_codes"))


@query
def events_orphans(f: Frames) -> DataFrame:
    return execution.orphans(f.events, f.import_lines).select("dedup_key", "line_id")


@query
def execution_remaining(f: Frames) -> DataFrame:
    state = execution.fold(f.events).withColumn("need_quantity", num(2000))
    return execution.remaining(state).select(
        "line_id", d("open_quantity", places=3), d("import_unprepared", places=3)
    )


@query
def idle_imports(f: Frames) -> DataFrame:
    return execution.idle(execution.fold(f.events), AS_OF_EVENTS, 1).select(
        "line_id", "idle_days", d("imported_quantity", places=3)
    )


@query
def events_daily_counts(f: Frames) -> DataFrame:
    return execution.daily_counts(f.events).select(
        "day", "event_type", "events", d("quantity", places=3), "max_lag_seconds"
    )


def _current(f: Frames) -> DataFrame:
    """An older projection: the estimate of 28 days before the business date."""
    day = T - timedelta(days=28)
    older = f.estimate(day)
    return older.filter(F.col("status") != "BLOCKED")


def _shown_current(rows: DataFrame) -> DataFrame:
    return rows.select("business_date", *PAIR, "status", d("basal_daily_demand"))


@query
def publish_current(f: Frames) -> DataFrame:
    return _shown_current(publish.next_current(_current(f), f.estimates, f.later_pairs))


@query
def publish_staged(f: Frames) -> DataFrame:
    """Two publications through stage, checks and switch; the projection in force."""
    root = scratch(f.spark, "publication")
    first = f.estimate(T - timedelta(days=28))
    publish.publish(f.spark, root, first, f.pairs, "batch-1")
    publish.publish(f.spark, root, f.estimates, f.pairs, "batch-2")
    return _shown_current(publish.current(f.spark, root))


@query
def reconcile_versions(f: Frames) -> DataFrame:
    """The whole panel against a version that lacks some rows and has others changed or added."""
    a, b, day = F.col("article_id"), F.col("branch_id"), F.dayofmonth("sales_date")
    rows = f.history_panel.select("sales_date", *PAIR, "observed_units", "availability_status")
    later = rows.filter(~((a % 7 == 0) & (day == 11))).withColumn(
        "observed_units", F.when((a % 5 == 0) & (day == 3), F.col("observed_units") + 1)
        .otherwise(F.col("observed_units")),
    )
    added = rows.filter((a % 9 == 0) & (day == 20)).withColumn("branch_id", b + 100)
    found = reconcile.differences(
        rows, materialise(later.unionByName(added)), ["sales_date", *PAIR],
        ["observed_units", "availability_status"],
    )
    return found.select(
        "sales_date", *PAIR, "difference", "source_rows", "stage_rows",
        d(F.col("source.observed_units"), "source_units"),
        d(F.col("stage.observed_units"), "stage_units"),
    )


@query
def retire_pairs(f: Frames) -> DataFrame:
    return publish.retired(_current(f), f.later_pairs).select(*PAIR, "status")


@query
def quality_violations(f: Frames) -> DataFrame:
    issues = [
        quality.violations(
            f.stock, quality.stock_rules(), "stock", ["stock_date", *PAIR], "stock_date"
        ),
        quality.violations(
            f.history_panel, quality.sales_rules(), "sales", ["sales_date", *PAIR], "sales_date"
        ),
        quality.violations(
            f.estimates, quality.estimate_rules(), "estimate", PAIR, "business_date"
        ),
        quality.violations(f.needs, quality.need_rules(), "need", [*PAIR, "need_type"],
                           "business_date"),
        quality.violations(f.directed, quality.directed_rules(), "directed", ["line_id"],
                           "valid_from"),
    ]
    merged = issues[0]
    for part in issues[1:]:
        merged = merged.unionByName(part)
    return quality.issue_counts(merged)


def _when(condition: Column, value: object, name: str) -> Column:
    """Column `name` with another value where the condition holds."""
    return F.when(condition, value).otherwise(F.col(name))


@query
def quality_broken(f: Frames) -> DataFrame:
    """Sound rows broken on purpose, each rule by some articles, so that every rule fires."""
    a = F.col("article_id")
    stock_rows = f.stock.withColumns(
        {
            "is_serviceable": _when(a % 5 == 0, ~F.col("is_serviceable"), "is_serviceable"),
            "source_day": _when(F.col("branch_id") % 7 == 0, F.col("source_day") + 1, "source_day"),
        }
    )
    unknown = F.col("availability_status") == "UNKNOWN"
    absent = F.col("availability_status").isin("UNKNOWN", "OUT_OF_STOCK")
    counted = F.col("availability_status").isin("IN_STOCK", "OUT_OF_STOCK")
    sales_rows = f.history_panel.withColumns(
        {
            "basal_units": _when(a % 4 == 0, F.col("basal_units") + 1, "basal_units"),
            "eligible": _when((a % 4 == 1) & absent, F.lit(True), "eligible"),
            "stock_source_hash": F.when((a % 4 == 2) & counted, F.lit(None))
            .when((a % 4 == 3) & unknown, "x")
            .otherwise(F.col("stock_source_hash")),
        }
    )
    usable = F.col("status") != "BLOCKED"
    value = F.col("basal_daily_demand")
    estimate_rows = f.estimates.withColumns(
        {
            "lookback_end": _when(a % 6 == 0, F.col("business_date"), "lookback_end"),
            "nonzero_days": _when(a % 6 == 1, F.col("eligible_days") + 1, "nonzero_days"),
            "basal_daily_demand": F.when((a % 6 == 2) & usable, F.lit(None))
            .when((a % 6 == 3) & usable, num(-1))
            .otherwise(value),
            "recent_weight": _when((a % 6 == 4) & usable, F.col("recent_weight") + num("0.5"), "recent_weight"),
            "availability_coverage": _when(a % 6 == 5, num(2), "availability_coverage"),
            "published_batch_id": F.lit("b"),
            "published_at": F.when(a % 2 == 1, F.col("created_at")),
        }
    )
    open_need = F.col("calculation_status") != "BLOCKED"
    need_rows = f.needs.withColumns(
        {
            "is_mandatory": _when(a % 3 == 0, ~F.col("is_mandatory"), "is_mandatory"),
            "calculated_quantity": _when((a % 3 == 1) & open_need, num(-1), "calculated_quantity"),
            "rounded_quantity": _when(
                (a % 3 == 2) & (F.col("calculation_status") == "ZERO"), num(5), "rounded_quantity"
            ),
        }
    )
    directed_rows = f.directed.withColumns(
        {
            "prepared_quantity": _when(a % 2 == 0, F.col("original_quantity") + 1, "prepared_quantity"),
            "line_status": _when(a % 2 == 1, F.lit("PARTIAL"), "line_status"),
        }
    )
    backtest_rows = f.backtest.withColumns(
        {
            "evaluation_date": _when(a % 4 == 0, F.date_add("evaluation_date", 1), "evaluation_date"),
            "horizon_days": _when(a % 4 == 1, F.lit(0), "horizon_days"),
            "absolute_error_units": _when(a % 4 == 2, num(-1), "absolute_error_units"),
            "eligible_actual": _when(a % 4 == 3, ~F.col("eligible_actual"), "eligible_actual"),
        }
    )
    position_rows = f.positions.withColumns(
        {
            "maximum_stock": _when(a % 2 == 0, F.col("maximum_stock") + 1, "maximum_stock"),
            "estimate_date": F.when(a % 2 == 1, F.date_add("business_date", 1)).otherwise(
                F.col("business_date")
            ),
        }
    )
    import_rows = f.line_execution.withColumn(
        "prepared_quantity", _when(a % 2 == 0, F.col("imported_quantity") + 1, "prepared_quantity")
    )
    sets = [
        (stock_rows, quality.stock_rules(), "stock", ["stock_date", *PAIR]),
        (sales_rows, quality.sales_rules(), "sales", ["sales_date", *PAIR]),
        (estimate_rows, quality.estimate_rules() + quality.publication_rules(), "estimate", PAIR),
        (need_rows, quality.need_rules(), "need", [*PAIR, "need_type"]),
        (directed_rows, quality.directed_rules(), "directed", ["line_id"]),
        (backtest_rows, quality.backtest_rules(), "backtest", ["origin_date", *PAIR]),
        (position_rows, quality.position_rules(), "position", PAIR),
        (import_rows, quality.import_rules(), "import", PAIR),
    ]
    found = [quality.violations(rows, rules, name, keys) for rows, rules, name, keys in sets]
    merged = found[0]
    for part in found[1:]:
        merged = merged.unionByName(part)
    return quality.issue_counts(merged)


@query
def declared_duplicates(f: Frames) -> DataFrame:
    """The keys of the four stored tables, over rows of which some articles are there twice."""
    rows = {
        "stock_daily": f.stock,
        "sales_daily": f.history_panel.withColumn("scope_version_id", F.lit("scope-1")),
        "demand_estimate": f.estimates,
        "backtest_detail": f.backtest,
    }
    found = None
    for spec, frame in zip(schemas.TABLES.values(), rows.values()):
        keys = [k for k in spec.keys if k in frame.columns]
        twice = frame.unionByName(frame.filter(F.col("article_id") % 5 == 0))
        one = quality.issue_counts(quality.duplicates(twice, keys, spec.name))
        found = one if found is None else found.unionByName(one)
    return found


@query
def input_controls(f: Frames) -> DataFrame:
    """Every branch as a source of sales: those that end early, and days after the cutoff."""
    closed = f.raw.groupBy(F.concat(F.lit("branch-"), "branch_id").alias("source")).agg(
        F.max(F.to_date("sales_ts")).alias("closed_through")
    )
    issues = quality.input_controls(
        closed, {"raw_sales": (f.raw, "sales_ts")}, f.history.end - timedelta(days=5)
    )
    return quality.issue_counts(issues)


@query
def output_controls(f: Frames) -> DataFrame:
    return quality.output_controls(f.estimates, f.later_pairs, 0.95).select(
        "entity_type", "severity", "issue_code",
        F.get_json_object("entity_key", "$.branch_id").cast("int").alias("branch_id"),
    )


@query
def resolved_issues(f: Frames) -> DataFrame:
    """Negative stock, of which every third article is settled."""
    issues = quality.violations(
        f.stock, quality.stock_rules(), "stock", ["stock_date", *PAIR], "stock_date"
    )
    decisions = issues.filter(F.col("article_id") % 3 == 0).select(
        "entity_type", "entity_key", "issue_code",
        F.col("business_date").cast("timestamp_ntz").alias("resolved_at"),
        F.lit("planner").alias("resolved_by"),
    )
    return quality.resolve(issues, decisions).groupBy("issue_code", "resolved_by").agg(
        F.count(F.lit(1)).alias("issues")
    )


@query
def reader_round_trip(f: Frames) -> DataFrame:
    """The input relations written as files and read by their readers."""
    root = scratch(f.spark, "files")
    frames = {"catalog": f.catalog, "raw_sales": f.raw, "enriched_sales": f.enriched, "wide_stock": f.wide}
    found = None
    for name, rows in frames.items():
        rows.write.parquet(f"{root}/{name}")
        back = getattr(sources, name)(f.spark, f"{root}/{name}")
        one = back.agg(
            F.lit(name).alias("relation"),
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.col("article_id").cast("bigint") * F.col("branch_id")).alias("key_sum"),
        )
        found = one if found is None else found.unionByName(one)
    return found


@query
def sales_upsert(f: Frames) -> DataFrame:
    """The history loaded into the stored panel, then loaded again with corrected sales."""
    store = MonthlyStore(f.spark, scratch(f.spark, "store"))
    span = f.history
    inputs = pipelines.Inputs(f.catalog, f.raw, f.enriched, f.wide)
    pipelines.load_stock(store, inputs, span.start, span.end)
    pipelines.load_sales(store, inputs, span.start, span.end, "scope-1")
    corrected = f.raw.withColumn(
        "units", F.when(F.col("article_id") % 4 == 0, dec(F.col("units") + 1)).otherwise(F.col("units"))
    )
    again = pipelines.Inputs(f.catalog, corrected, f.enriched, f.wide)
    pipelines.load_sales(store, again, span.start, span.end, "scope-1")
    return store.read("sales_daily", span).groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("days"), d(F.sum("observed_units"), "observed_units")
    )


@query
def store_retention(f: Frames) -> DataFrame:
    """Daily stock of the whole history, then pruned to twelve months."""
    store = MonthlyStore(f.spark, scratch(f.spark, "store"))
    store.upsert("stock_daily", f.stock, f.history)
    store.prune("stock_daily", 12, T)
    return store.read("stock_daily").groupBy(
        F.date_format("stock_date", "yyyy-MM").alias("month")
    ).agg(F.count(F.lit(1)).alias("rows"))


@query
def scope_manifest_file(f: Frames) -> DataFrame:
    path = f"{scratch(f.spark, 'manifest')}/manifest"
    scope.write_manifest(f.catalog, path)
    return f.spark.read.json(path).select(
        "article_count", "pair_count", "destination_count", "scope_checksum"
    )


@query
def duplicate_keys(f: Frames) -> DataFrame:
    """Line items have no unique key: the keys that repeat."""
    lines = fx.table(f.spark, f.folder, "lineitem")
    return quality.duplicates(lines, ["l_orderkey", "l_linenumber"], "lineitem").select(
        "severity", "issue_code", "entity_key"
    )


@query
def scope_gate(f: Frames) -> DataFrame:
    variation = scope.variation(f.pairs, f.later_pairs)
    return quality.scope_gate(variation).select(
        "added", "removed", "changed", "same", d("variation"), "passes"
    )


@query
def scoped_blocking(f: Frames) -> DataFrame:
    """Pairs without any stock in the recent window stay blocked; the others run."""
    known = f.stock.filter(W.recent.holds(F.col("stock_date")))
    ready, blocked = freshness.split_scope(f.pairs, known, PAIR)
    return ready.select(*PAIR, F.lit("READY").alias("state")).unionByName(
        blocked.select(*PAIR, F.lit("BLOCKED").alias("state"))
    )


@query
def audit_diff(f: Frames) -> DataFrame:
    return audit.diff(f.pairs, f.later_pairs, PAIR, "scope_pair", "correlation-1").select(
        "entity_id", "event_type", "before_state", "after_state"
    )


@query
def explain_needs(f: Frames) -> DataFrame:
    return audit.explain_needs(f.needs, f.positions, "run-1").select(
        *PAIR, "need_type", "formula", d(F.col("inputs.net_stock"), "net_stock"),
        F.col("inputs.batch_id").alias("batch_id"),
        d(F.col("parameters.target_stock_days"), "target_stock_days"),
        F.col("estimate.estimate_date").alias("estimate_date"),
        d(F.col("thresholds.maximum_stock"), "maximum_stock"),
    )


@query
def backfill_run(f: Frames) -> DataFrame:
    """Both window ranges loaded into stored tables, then the estimate, read back."""
    store = MonthlyStore(f.spark, scratch(f.spark, "store"))
    inputs = pipelines.Inputs(f.catalog, f.raw, f.enriched, f.wide)
    pipelines.backfill(store, inputs, T, IDS)
    return store.read("demand_estimate", Span(T, T)).select(
        "business_date", *PAIR, "status", d("basal_daily_demand"), "input_checksum"
    )


@query
def stream_fold(f: Frames) -> DataFrame:
    return _state(stream_events.read_state(f.spark, f.stream_folder))


@query
def stream_log(f: Frames) -> DataFrame:
    return stream_events.read_log(f.spark, f.stream_folder).select(
        "dedup_key", "line_id", "event_type", d("quantity")
    )


@query
def stream_corrections(f: Frames) -> DataFrame:
    return stream_events.read_corrections(f.spark, f.stream_folder).select(
        "dedup_key", "line_id", "event_type", d("quantity"), joined("correction_alert")
    )


@query
def stream_daily(f: Frames) -> DataFrame:
    return stream_events.read_daily(f.spark, f.stream_folder).select(
        "day", "event_type", "events", d("quantity", places=3)
    )


@query
def stream_idle(f: Frames) -> DataFrame:
    """Lines that the timers of the stream report, with their state."""
    reported = stream_events.read_idle(f.spark, f.stream_folder).select("line_id", "last_activity")
    state = stream_events.read_state(f.spark, f.stream_folder).drop("last_activity")
    return reported.join(state, "line_id").select(
        "line_id", F.datediff(F.lit(AS_OF_EVENTS), F.to_date("last_activity")).alias("idle_days"),
        d("imported_quantity", places=3),
    )


@query
def version_history(f: Frames) -> DataFrame:
    """Orders as versions of their customer; the numbers have gaps."""
    history = fx.table(f.spark, f.folder, "orders").select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderkey").alias("version"),
        F.to_date("o_orderdate").alias("changed_at"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )
    return needs.versions_with_validity(history, "customer", ["status", "priority"]).select(
        "customer", "version", F.col("changed_at").alias("changed_on"), "after_state",
        "before_state", F.col("superseded_at").alias("superseded_on"),
    )


@query
def publish_replay(f: Frames) -> DataFrame:
    """Publications that are repeated, rejected and late; the projection in force."""
    root = scratch(f.spark, "replay")
    older = f.estimate(T - timedelta(days=28))
    publish.publish(f.spark, root, older, f.pairs, "batch-1")
    publish.publish(f.spark, root, f.estimates, f.pairs, "batch-2")
    publish.publish(f.spark, root, f.estimates, f.pairs, "batch-2")
    doubled = f.estimates.unionByName(f.estimates)
    with contextlib.suppress(publish.PublicationRejected):
        publish.publish(f.spark, root, doubled, f.pairs, "batch-3")
    publish.publish(f.spark, root, older, f.pairs, "batch-4")
    return _shown_current(publish.current(f.spark, root))


@query
def scope_manifest_ordered(f: Frames) -> DataFrame:
    return scope.ordered_manifest(f.catalog).withColumn(
        "source_as_of_ts", F.col("source_as_of_ts").cast("string")
    )


@query
def scope_gates(f: Frames) -> DataFrame:
    """A later scope with pairs that are there twice and pairs of another route."""
    a, b = F.col("article_id"), F.col("branch_id")
    rows = scope.pair_details(fx.later_catalog(f.spark, f.folder)).withColumn(
        "route_code", _when(b % 6 == 0, "DIRECT", "route_code")
    )
    issues = quality.scope_gates(rows.unionByName(rows.filter(a % 5 == 0)), f.pairs)
    branch = F.get_json_object("entity_key", "$.branch_id").cast("int").alias("branch_id")
    return issues.groupBy("entity_type", "severity", "issue_code", branch).agg(
        F.count(F.lit(1)).alias("issues")
    )


@query
def scope_versions(f: Frames) -> DataFrame:
    """The same scope twice, then a later one: the version of each."""
    steps = {"first": f.catalog, "again": f.catalog, "later": fx.later_catalog(f.spark, f.folder)}
    version, rows = None, []
    for step, catalog in steps.items():
        found = scope.manifest(catalog).first().asDict()
        version = scope.resolve_version(version, found, ScopeRule())
        rows.append((step, version["version_no"], version["is_new"], version["scope_checksum"]))
    return f.spark.createDataFrame(
        rows, "step string, version_no int, is_new boolean, scope_checksum string"
    )


@query
def value_controls(f: Frames) -> DataFrame:
    """Estimates of which some are no number, infinite or negative."""
    a, value = F.col("article_id"), F.col("basal_daily_demand").cast("double")
    broken = f.estimates.withColumn(
        "basal_daily_demand",
        F.when(a % 6 == 1, float("nan")).when(a % 6 == 2, float("inf")).when(a % 6 == 3, -1.0)
        .otherwise(value),
    )
    return quality.issue_counts(quality.output_controls(broken, f.pairs, 0.0))


@query
def allocation_controls(f: Frames) -> DataFrame:
    """Attributed quantities of which some exceed what is open and some are negative."""
    a, allocated = F.col("article_id"), F.col("allocated_quantity")
    prepared = f.line_execution.select(
        *PAIR, dec(F.col("prepared_quantity") * 20).alias("prepared_quantity")
    )
    sources = f.sources.withColumn("supplier_key", F.lit(backlog.NO_SUPPLIER))
    rows = backlog.attribute(sources, prepared, T, PAIR).withColumn(
        "allocated_quantity",
        F.when(a % 4 == 0, dec(F.col("open_quantity") + 1)).when(a % 4 == 1, num(-1)).otherwise(allocated),
    )
    return quality.violations(
        rows, quality.allocation_rules(), "allocation", ["need_type", "source_id"]
    ).groupBy("severity", "issue_code", "article_id").agg(F.count(F.lit(1)).alias("issues"))


def _inputs(f: Frames) -> pipelines.Inputs:
    return pipelines.Inputs(f.catalog, f.raw, f.enriched, f.wide)


@query
def daily_run(f: Frames) -> DataFrame:
    """The windows but for their last day were loaded before; the daily run loads that day and
    estimates."""
    store = MonthlyStore(f.spark, scratch(f.spark, "store"))
    seasonal, current = pipelines.window_spans(T).load_ranges()
    for span in (seasonal, Span(current.start, current.end - timedelta(days=1))):
        pipelines.features(store, _inputs(f), span.start, span.end, IDS.scope_version_id)
    pipelines.daily(store, _inputs(f), T, IDS)
    return store.read("demand_estimate", Span(T, T)).select(
        "business_date", *PAIR, "status", d("basal_daily_demand"), "input_checksum"
    )


@query
def backtest_stored(f: Frames) -> DataFrame:
    """Stored estimates of every day scored against the stored panel, the last four weeks again;
    the stored rows."""
    store = MonthlyStore(f.spark, scratch(f.spark, "store"))
    dates, one = f.every_date, timedelta(days=1)
    store.upsert("sales_daily", f.history_panel.withColumn("scope_version_id", F.lit("scope-1")), f.history)
    store.append_new(
        "demand_estimate", demand.estimates(f.history_panel, f.pairs, dates, IDS),
        Span(dates[0], dates[-1]),
    )
    for first in (dates[0], dates[-28]):
        pipelines.run_backtest(store, first + one, dates[-1] + one, IDS)
    rows = store.read("backtest_detail").withColumn("codes", F.array_join("exclusion_codes", ","))
    return _condensed_errors(
        rows, "origin_date", "horizon_days", "eligible_actual", "codes", "input_checksum"
    )


@query
def day_close(f: Frames) -> DataFrame:
    """The backlog of a day closed from its events; lines without a reference stay aside."""
    user = F.col("line_id").cast("bigint")
    lines = f.import_lines.select(
        "line_id", (user % 25 + 1).cast("int").alias("article_id"),
        (F.floor(user / 25) % 25).cast("int").alias("branch_id"),
    )
    closed = pipelines.close_day(
        f.estimates, f.pairs,
        pipelines.DayInputs(
            fx.position_inputs(f.stock, f.pairs), fx.parameters(f.spark, f.folder),
            fx.directed_needs(f.spark, f.folder), f.items,
            fx.execution_events(f.spark, f.folder), lines,
        ),
        T,
    )
    return closed["backlog"].select(
        "line_id", "priority_class", "risk_score", "priority_rank", d("total_open_quantity"),
        d("imported_quantity"), d("prepared_quantity"),
    )


@query
def runs_in_force(f: Frames) -> DataFrame:
    """Orders as attempts of runs: the newest one that succeeded per type, date and scope."""
    orders = fx.table(f.spark, f.folder, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "SUCCEEDED").when(
        F.col("o_orderstatus") == "P", "RUNNING"
    ).otherwise("FAILED")
    attempts = orders.select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("run_type"),
        F.trunc("o_orderdate", "month").alias("business_date"),
        F.concat(F.lit("scope-"), F.col("o_custkey") % 3).alias("scope_id"),
        F.col("o_orderkey").cast("int").alias("attempt_no"),
        status.alias("status"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("recorded_at"),
    )
    every = [F.lit(None).cast(x.dataType).alias(x.name) for x in publish.RUN if x.name not in attempts.columns]
    return publish.current_runs(attempts.select("*", *every)).select(
        "run_type", "business_date", "scope_id", "run_id", "attempt_no"
    )


@query
def publish_log(f: Frames) -> DataFrame:
    """A publication, one with rows outside its scope, and their runs: every state reached."""
    root = scratch(f.spark, "log")
    run = {"run_type": "PUBLICATION", "business_date": T, "scope_id": "scope-1"}
    for batch, pairs in (("batch-1", f.pairs), ("batch-2", f.later_pairs)):
        attempt = publish.next_attempt(publish.runs(f.spark, root), *run.values())
        try:
            publish.publish(f.spark, root, f.estimates, pairs, batch)
            status = "SUCCEEDED"
        except publish.PublicationRejected:
            status = "FAILED"
        publish.register_run(f.spark, root, **run, attempt_no=attempt, status=status)
    states = publish.publications(f.spark, root).select("batch_id", "status", "rows")
    outside = publish.outside_scope(f.estimates, f.later_pairs).agg(
        F.lit("batch-2").alias("batch_id"), F.lit("OUTSIDE").alias("status"),
        F.count(F.lit(1)).alias("rows"),
    )
    tried = publish.runs(f.spark, root).select(
        F.lit("run").alias("batch_id"), "status", F.col("attempt_no").cast("bigint").alias("rows")
    )
    return states.unionByName(outside).unionByName(tried)


@query
def import_files(f: Frames) -> DataFrame:
    """Import requests exchanged as files, JSON for even line versions and CSV for the others."""
    root = scratch(f.spark, "exchange")
    requests = fx.import_requests(f.spark, f.folder)
    even = F.col("line_version") % 2 == 0
    requests.filter(even).write.json(f"{root}/json")
    requests.filter(~even).write.option("header", "true").csv(f"{root}/csv")
    read = [sources.exchange_file(f.spark, f"{root}/{fmt}", "import_requests", fmt) for fmt in ("json", "csv")]
    return execution.confirm_imports(
        read[0].unionByName(read[1]).filter(F.col("bad_line").isNull()).drop("bad_line"),
        f.import_lines, fx.accepted_imports(f.spark, f.folder),
    ).select("idempotency_key", "line_id", "line_version", d("quantity"), "outcome", "replays")


@query
def directed_upload(f: Frames) -> DataFrame:
    """Directed needs uploaded as CSV, with lines that cannot be read or break a rule."""
    path, key = scratch(f.spark, "upload"), F.col("need_id")
    quantity = F.col("original_quantity").cast("string")
    fx.directed_needs(f.spark, f.folder).withColumns(
        {
            "original_quantity": F.when(key % 7 == 0, "many").when(key % 7 == 1, "-1").otherwise(quantity),
            "need_type": F.when(key % 5 == 0, "X").otherwise(F.col("need_type")),
            "branch_id": F.when(key % 11 != 0, F.col("branch_id")),
            "article_id": F.when(key % 13 != 0, F.col("article_id")),
            "valid_to": F.when(key % 3 == 0, F.date_sub("valid_from", 1)).otherwise(F.col("valid_to")),
        }
    ).write.option("header", "true").csv(path)
    codes = joined("reject_codes")
    return sources.directed_needs(f.spark, path).groupBy(codes).agg(
        F.count(F.lit(1)).alias("lines"), d(F.sum("original_quantity"), "quantity")
    )


@query
def positions_from_files(f: Frames) -> DataFrame:
    """Positions from the operational inputs of a day, written as files and read by their readers."""
    root = scratch(f.spark, "files")
    fx.position_inputs(f.stock, f.pairs).write.parquet(f"{root}/inputs")
    fx.parameters(f.spark, f.folder).write.parquet(f"{root}/parameters")
    return position.branch(
        sources.daily_inputs(f.spark, f"{root}/inputs"), f.estimates,
        sources.parameters(f.spark, f"{root}/parameters"),
    ).select(
        "business_date", *PAIR, "supplier_id", d("physical_stock"), d("direct_po_inbound"),
        d("cd_in_transit"), d("special_sale_committed"), d("net_stock"), "calculation_status",
        joined("alert_codes"),
    )


@query
def job_results(f: Frames) -> DataFrame:
    """What three loads changed, and the dates of the table from its files' statistics."""
    store = MonthlyStore(f.spark, scratch(f.spark, "store"))
    changed = F.col("article_id") % 4 == 0
    corrected = f.stock.withColumns(
        {
            "stock_quantity": _when(changed, dec(F.col("stock_quantity") + 1), "stock_quantity"),
            "source_row_hash": _when(changed, F.sha2("source_row_hash", 256), "source_row_hash"),
        }
    )
    results = [store.upsert("stock_daily", rows, f.history) for rows in (f.stock, corrected, corrected)]
    loads = f.spark.createDataFrame(
        [(n, r.job, r.start, r.end, r.inserted, r.updated, len(r.months)) for n, r in enumerate(results, 1)],
        "load int, job string, first_day date, last_day date, inserted bigint, updated bigint, months int",
    )
    stored = store.bounds("stock_daily").first()
    return loads.withColumns(
        {
            "stored_first": F.lit(stored["first_day"]), "stored_last": F.lit(stored["last_day"]),
            "stored_rows": F.lit(stored["rows"]),
        }
    )
