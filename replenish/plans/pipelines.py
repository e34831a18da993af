"""Feature, estimate, backtest and day-close runs."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replenish.functions import windows
from replenish.functions.windows import Span, Windows, check_range
from replenish.operators import (
    backlog,
    backtest,
    demand,
    execution,
    freshness,
    needs,
    panel,
    position,
    scope,
    stock,
)
from replenish.operators.demand import RunIds
from replenish.operators.scale import materialise
from replenish.params import DemandParams, ScopeRule
from replenish.schemas import BACKTEST_TABLE, ESTIMATE_TABLE, SALES_TABLE, STOCK_TABLE
from replenish.sources.store import JobResult, MonthlyStore


@dataclass(frozen=True)
class Inputs:
    """The four source relations of the analytical path."""

    catalog: DataFrame
    raw_sales: DataFrame
    enriched_sales: DataFrame
    wide_stock: DataFrame
    rule: ScopeRule = ScopeRule()


def load_stock(store: MonthlyStore, inputs: Inputs, start: date, end: date) -> JobResult:
    check_range(start, end)
    wanted = materialise(scope.stock_scope(inputs.catalog, inputs.rule))
    rows = stock.normalize(inputs.wide_stock, wanted, start, end)
    stamped = rows.withColumn("normalized_at", F.lit(datetime.now()).cast("timestamp_ntz"))
    return store.upsert(STOCK_TABLE, stamped, Span(start, end))


def load_sales(
    store: MonthlyStore, inputs: Inputs, start: date, end: date, scope_version_id: str
) -> JobResult:
    span = Span(start, end)
    check_range(start, end)
    rows = panel.build(
        materialise(scope.pairs(inputs.catalog, inputs.rule)),
        inputs.raw_sales,
        inputs.enriched_sales,
        store.read(STOCK_TABLE, span),
        span,
    ).withColumns(
        {
            "scope_version_id": F.lit(scope_version_id),
            "feature_run_id": F.lit(str(uuid.uuid4())),
            "feature_calculated_at": F.lit(datetime.now()).cast("timestamp_ntz"),
        }
    )
    return store.upsert(SALES_TABLE, rows, span)


def features(
    store: MonthlyStore, inputs: Inputs, start: date, end: date, scope_version_id: str
) -> dict[str, object]:
    """Stock, then the freshness gate, then sales."""
    stock_result = load_stock(store, inputs, start, end)
    # The newest stored month holds the last stock date.
    newest = store.newest(STOCK_TABLE)
    closed = freshness.gate(
        inputs.raw_sales, inputs.enriched_sales, inputs.wide_stock, newest, end
    )
    sales_result = load_sales(store, inputs, start, end, scope_version_id)
    return {"stock": stock_result, "freshness": closed, "sales": sales_result}


def estimate(
    store: MonthlyStore,
    inputs: Inputs,
    business_date: date,
    ids: RunIds,
    params: DemandParams = DemandParams(),
) -> JobResult:
    """Estimate one business date from the stored panel; an existing run is never changed."""
    spans = window_spans(business_date, params)
    rows = demand.estimate(
        store.read(SALES_TABLE, *spans.load_ranges()),
        scope.pairs(inputs.catalog, inputs.rule),
        spans, ids, params,
    )
    return store.append_new(ESTIMATE_TABLE, rows, Span(business_date, business_date))


def window_spans(business_date: date, params: DemandParams = DemandParams()) -> Windows:
    return windows.build(business_date, **{f"{r}_days": n for r, n in params.lengths.items()})


def backfill(
    store: MonthlyStore,
    inputs: Inputs,
    business_date: date,
    ids: RunIds,
    params: DemandParams = DemandParams(),
) -> dict[str, object]:
    """Load the seasonal window and the current windows, skip what lies between, and estimate."""
    seasonal, current = window_spans(business_date, params).load_ranges()
    return {
        "seasonal": features(store, inputs, seasonal.start, seasonal.end, ids.scope_version_id),
        "current": features(store, inputs, current.start, current.end, ids.scope_version_id),
        "estimate": estimate(store, inputs, business_date, ids, params),
    }


def daily(
    store: MonthlyStore,
    inputs: Inputs,
    business_date: date,
    ids: RunIds,
    params: DemandParams = DemandParams(),
) -> dict[str, object]:
    """Load the one day that closed and estimate the business date."""
    cutoff = window_spans(business_date, params).cutoff
    return {
        "features": features(store, inputs, cutoff, cutoff, ids.scope_version_id),
        "estimate": estimate(store, inputs, business_date, ids, params),
    }


def run_backtest(
    store: MonthlyStore,
    evaluation_from: date,
    evaluation_to: date,
    ids: RunIds,
    horizon_days: int = 1,
) -> JobResult:
    """Score the stored estimates of the range against the stored panel."""
    check_range(evaluation_from, evaluation_to)
    span = Span(evaluation_from, evaluation_to)
    origins = Span(
        date.fromordinal(evaluation_from.toordinal() - horizon_days),
        date.fromordinal(evaluation_to.toordinal() - horizon_days),
    )
    rows = backtest.detail(
        store.read(ESTIMATE_TABLE, origins), store.read(SALES_TABLE, span),
        evaluation_from, evaluation_to, ids, horizon_days,
    )
    return store.append_new(BACKTEST_TABLE, rows, span)


@dataclass(frozen=True)
class DayInputs:
    """What a day close needs besides the estimates."""

    position_inputs: DataFrame
    parameters: DataFrame
    directed_lines: DataFrame
    items: DataFrame
    events: DataFrame
    line_of_event: DataFrame


def close_day(
    estimates: DataFrame,
    scope_pairs: DataFrame,
    inputs: DayInputs,
    business_date: date,
    due_soon_days: int = 3,
) -> dict[str, DataFrame]:
    """Fold the day's events and build the next snapshot from scratch.

    Nothing of an earlier snapshot is read, so running it again gives the same result. Automatic
    needs are replaced, directed needs keep their identity and balance. `line_of_event` maps
    `line_id` of the events to pairs (`article_id`, `branch_id`).
    """
    events = execution.normalize(execution.dedup(inputs.events))
    accepted, isolated = execution.quarantine(events, inputs.line_of_event)
    state = materialise(execution.fold(accepted))
    per_pair = (
        state.join(inputs.line_of_event, "line_id")
        .groupBy("article_id", "branch_id")
        .agg(
            F.sum("imported_quantity").cast("decimal(18,6)").alias("imported_quantity"),
            F.sum("prepared_quantity").cast("decimal(18,6)").alias("prepared_quantity"),
        )
    )
    positions = materialise(
        position.branch(inputs.position_inputs, estimates, inputs.parameters)
    )
    rounded = needs.automatic(positions, inputs.items)
    under_way = per_pair.select(
        "article_id", "branch_id", F.col("prepared_quantity").alias("pipeline_quantity")
    )
    automatic = needs.automatic_balance(rounded, under_way)
    directed = needs.directed_balance(inputs.directed_lines, business_date)
    sources = materialise(
        backlog.all_sources(
            backlog.automatic_sources(automatic),
            backlog.directed_sources(directed, business_date, scope_pairs),
        )
    )
    lines = backlog.consolidate(sources, per_pair, inputs.items, positions)
    return {
        "state": state,
        "isolated": isolated,
        "positions": positions,
        "needs": automatic,
        "sources": sources,
        "backlog": backlog.prioritize(lines, business_date, due_soon_days),
    }
