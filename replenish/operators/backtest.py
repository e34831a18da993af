"""Rolling-origin backtest of the demand estimate."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenish.functions.exprs import bar_hash, dec, latest, num, text, text_or_blank
from replenish.functions.windows import check_range
from replenish.operators import demand
from replenish.operators.demand import RunIds
from replenish.params import DemandParams
from replenish.schemas import BACKTEST_DETAIL

PAIR = ["article_id", "branch_id"]


def _check(start: date, end: date, horizon_days: int) -> None:
    check_range(start, end)
    if horizon_days < 1:
        raise ValueError("the horizon must be at least one day")


def observe(predictions: DataFrame, panel: DataFrame, horizon_days: int) -> DataFrame:
    """Predictions next to the actual of `business_date + horizon`, with signed errors.

    A positive error means the demand was under-forecast. A missing or non-serviceable actual
    counts as excluded, not as zero demand.
    """
    actual = panel.select(
        F.col("sales_date").alias("evaluation_date"),
        *PAIR,
        F.col("basal_units").alias("panel_units"),
        F.col("eligible").alias("panel_eligible"),
        F.col("source_hash").alias("actual_checksum"),
    )
    joined = predictions.withColumn(
        "evaluation_date", F.date_add("business_date", horizon_days)
    ).join(actual, ["evaluation_date", *PAIR], "left")
    with_actual = joined.withColumns(
        {
            "actual_basal_units": dec(F.coalesce("panel_units", num(0))),
            "eligible_actual": F.coalesce("panel_eligible", F.lit(False)),
        }
    ).drop("panel_units", "panel_eligible")
    error = dec(F.col("actual_basal_units") - F.col("predicted_demand"))
    return with_actual.withColumns(
        {
            "error_units": error,
            "absolute_error_units": F.abs(error),
            "squared_error": dec(error * error, 24, 8),
            "status": F.when(F.col("eligible_actual"), "VALID").otherwise("EXCLUDED"),
            "exclusion_codes": F.when(
                F.col("eligible_actual"), F.array().cast("array<string>")
            ).otherwise(F.array(F.lit("ACTUAL_NOT_SERVICEABLE"))),
        }
    )


def detail(
    estimates: DataFrame,
    panel: DataFrame,
    evaluation_from: date,
    evaluation_to: date,
    ids: RunIds,
    horizon_days: int = 1,
) -> DataFrame:
    """Error rows of all published, not blocked estimates whose evaluation date is in range."""
    _check(evaluation_from, evaluation_to, horizon_days)
    chosen = estimates.filter(
        (F.col("model_version_id") == ids.model_version_id)
        & (F.col("scope_version_id") == ids.scope_version_id)
        & (F.col("origin_id") == ids.origin_id)
        & (F.col("status") != "BLOCKED")
        & F.date_add("business_date", horizon_days).between(
            F.lit(evaluation_from), F.lit(evaluation_to)
        )
    )
    newest = (
        chosen.groupBy("business_date", *PAIR)
        .agg(
            latest(F.struct("basal_daily_demand", "input_checksum"), "created_at", "run_id")
            .alias("row")
        )
        .select(
            "business_date", *PAIR,
            F.col("row.basal_daily_demand").alias("predicted_demand"),
            F.col("row.input_checksum").alias("estimate_checksum"),
        )
    )
    days = panel.filter(F.col("sales_date").between(F.lit(evaluation_from), F.lit(evaluation_to)))
    observed = observe(newest, days, horizon_days).withColumns(
        {
            "run_id": F.lit(ids.run_id),
            "model_version_id": F.lit(ids.model_version_id),
            "scope_version_id": F.lit(ids.scope_version_id),
            "origin_id": F.lit(ids.origin_id),
            "origin_date": F.col("business_date"),
            "horizon_days": F.lit(horizon_days),
            "input_checksum": bar_hash(
                F.col("estimate_checksum"), text_or_blank("actual_checksum"),
                text("evaluation_date"), F.lit(str(horizon_days)),
            ),
        }
    )
    return observed.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in BACKTEST_DETAIL]
    )


def segments(**ids: Column | str) -> Column:
    """Segments a row belongs to: the whole, and one per named attribute."""
    named = [("ALL", F.lit("ALL"))] + [
        (name.upper(), text(value)) for name, value in ids.items()
    ]
    return F.array(
        *[
            F.struct(F.lit(kind).alias("segment_type"), value.alias("segment_id"))
            for kind, value in named
        ]
    )


def metric_table(
    rows: DataFrame,
    by: list[str] | None = None,
    segment: Column | None = None,
) -> DataFrame:
    """MAE, WAPE, BIAS and RMSE per segment over the valid rows, one row per metric.

    WAPE has no value, and therefore no row, where the actual total is zero.
    """
    by = by or []
    segment = segment if segment is not None else segments(
        article="article_id", branch="branch_id"
    )
    valid = rows.filter(F.col("status") == "VALID").select(
        *by, F.explode(segment).alias("segment"), "error_units", "absolute_error_units",
        "squared_error", "actual_basal_units",
    )
    sums = valid.groupBy(*by, "segment.segment_type", "segment.segment_id").agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.count_if(F.col("actual_basal_units") == 0).alias("zero_actual_count"),
        F.sum("error_units").cast("double").alias("error"),
        F.sum("absolute_error_units").cast("double").alias("absolute_error"),
        F.sum("squared_error").cast("double").alias("squared"),
        F.sum("actual_basal_units").cast("double").alias("actual"),
    )
    size = F.col("sample_size")
    wide = sums.select(
        *by, "segment_type", "segment_id", "sample_size", "zero_actual_count",
        (F.col("absolute_error") / size).alias("MAE"),
        F.try_divide(F.col("absolute_error"), F.col("actual")).alias("WAPE"),
        (F.col("error") / size).alias("BIAS"),
        F.sqrt(F.col("squared") / size).alias("RMSE"),
    )
    return wide.unpivot(
        [*by, "segment_type", "segment_id", "sample_size", "zero_actual_count"],
        ["MAE", "WAPE", "BIAS", "RMSE"], "metric_code", "metric_value",
    ).filter(F.col("metric_value").isNotNull())


def metrics(detail_rows: DataFrame, evaluation_from: date, evaluation_to: date) -> DataFrame:
    """Metric rows of a stored backtest, per model and horizon."""
    period = detail_rows.filter(
        F.col("evaluation_date").between(F.lit(evaluation_from), F.lit(evaluation_to))
    )
    return metric_table(period, ["model_version_id", "horizon_days"]).withColumns(
        {
            "evaluation_from": F.lit(evaluation_from),
            "evaluation_to": F.lit(evaluation_to),
        }
    )


def rolling(
    panel: DataFrame,
    scope_pairs: DataFrame,
    dates: list[date],
    horizon_days: int = 1,
    params: DemandParams = DemandParams(),
) -> DataFrame:
    """Estimate every date from earlier days only and set it against the actual."""
    _check(min(dates), max(dates), horizon_days)
    predicted = demand.rolling(panel, scope_pairs, dates, params).filter(
        F.col("status") != "BLOCKED"
    )
    return observe(
        predicted.select(
            "business_date", *PAIR, F.col("basal_daily_demand").alias("predicted_demand")
        ),
        _evaluated(panel, dates, horizon_days),
        horizon_days,
    )


def _evaluated(panel: DataFrame, dates: list[date], horizon_days: int) -> DataFrame:
    """The panel on the days that are evaluated: a range for the scan, then the days themselves."""
    days = sorted({day + timedelta(days=horizon_days) for day in dates})
    return panel.filter(
        F.col("sales_date").between(F.lit(days[0]), F.lit(days[-1])) & F.col("sales_date").isin(*days)
    )


# The models an estimate is compared with, by their window weights.
VARIANTS = {
    "ESTIMATE": DemandParams(),
    "RECENT_ONLY": DemandParams(
        recent_weight=Decimal(1), previous_weight=Decimal(0), seasonal_weight=Decimal(0)
    ),
    "OTHER_WEIGHTS": DemandParams(
        recent_weight=Decimal("0.8"), previous_weight=Decimal("0.1"),
        seasonal_weight=Decimal("0.2"),
    ),
    "NO_PROMO_ADJUSTMENT": DemandParams(units_column="observed_units"),
}
BASELINE = "MEAN_28"
OBSERVED = "observed_units"


def compare(
    panel: DataFrame,
    scope_pairs: DataFrame,
    dates: list[date],
    horizon_days: int = 1,
    variants: dict[str, DemandParams] | None = None,
) -> DataFrame:
    """Metrics of every variant and of the plain mean of the recent window over the same cases.

    All variants are scored from one pass of running totals, side by side in one row per date and
    pair. Only cases that every variant can predict are compared.
    """
    _check(min(dates), max(dates), horizon_days)
    variants = VARIANTS if variants is None else variants
    lengths = {tuple(sorted(p.lengths.items())) for p in variants.values()}
    if len(lengths) != 1:
        raise ValueError("the variants need windows of the same lengths")
    columns = sorted({OBSERVED, *(p.units_column for p in variants.values())})
    totals = demand.rolling_totals(
        panel, scope_pairs, dates, columns, next(iter(variants.values()))
    )
    given = totals.columns
    row = totals.withColumn(
        BASELINE,
        dec(
            F.try_divide(
                dec(F.col(f"{OBSERVED}__recent_all_units"), 20, 6),
                F.when(F.col("recent_active_days") > 0, F.col("recent_active_days")).cast(
                    "decimal(10,0)"
                ),
            )
        ),
    )
    for done, (name, params) in enumerate(variants.items(), start=1):
        scored = demand.score(demand.of_units(row, params.units_column), params)
        kept = [*given, BASELINE, *list(variants)[: done - 1]]
        row = scored.select(*kept, F.col("basal_daily_demand").alias(name))
    keys = ["business_date", *PAIR]
    complete = row.select(*keys, BASELINE, *variants).dropna(subset=[BASELINE, *variants])
    days = _evaluated(panel, dates, horizon_days)
    long = complete.unpivot(keys, [BASELINE, *variants], "variant", "predicted_demand")
    return metric_table(
        observe(long, days, horizon_days), ["variant"], segments(branch="branch_id")
    )


def acceptance(compared: DataFrame, candidate: str = "ESTIMATE") -> DataFrame:
    """Per segment and metric: is the candidate no worse than the plain mean?"""
    keys = ["segment_type", "segment_id", "metric_code"]
    size = F.abs(F.col("metric_value"))
    return (
        compared.filter(F.col("variant").isin(candidate, BASELINE))
        .groupBy(*keys)
        .agg(
            F.max(F.when(F.col("variant") == candidate, size)).alias("candidate"),
            F.max(F.when(F.col("variant") == BASELINE, size)).alias("baseline"),
        )
        .withColumn("accepted", F.col("candidate") <= F.col("baseline"))
    )
