"""Net stock of branches and of the origin, thresholds and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from replenish.functions.exprs import codes, dec, latest, num
from replenish.operators.demand import newest_estimates
from replenish.params import MANDATORY_TYPES, NEED_TYPES, OPTIONAL_TYPES

PAIR = ["article_id", "branch_id"]


def asof_estimate(positions: DataFrame, estimates: DataFrame) -> DataFrame:
    """The newest estimate dated on or before the business date of each position.

    Both sides are merged in date order per pair and the last estimate is carried forward: every
    row is touched once, and a pair has at most one row per day and side.
    """
    newest = newest_estimates(estimates).select(
        *PAIR,
        F.col("business_date").alias("day"),
        F.lit(0).alias("is_position"),
        F.struct(
            F.col("business_date").alias("estimate_date"),
            F.col("run_id").alias("estimate_run_id"),
            F.col("status").alias("estimate_status"),
            F.col("basal_daily_demand"),
        ).alias("estimate"),
    )
    asked = positions.select(
        *PAIR,
        F.col("business_date").alias("day"),
        F.lit(1).alias("is_position"),
        F.struct(*[c for c in positions.columns if c not in (*PAIR, "business_date")]).alias(
            "position"
        ),
    )
    in_time = (
        Window.partitionBy(*PAIR)
        .orderBy("day", "is_position")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    merged = newest.unionByName(asked, allowMissingColumns=True).withColumn(
        "estimate", F.last("estimate", ignorenulls=True).over(in_time)
    )
    return merged.filter(F.col("is_position") == 1).select(
        F.col("day").alias("business_date"), *PAIR, "position.*", "estimate.*"
    )


# Days of a bin of the interval join.
BIN_DAYS = 64


def _bin(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BIN_DAYS).cast("int")


def valid_on(
    versions: DataFrame, keys: list[str], asked: DataFrame, values: list[str]
) -> DataFrame:
    """The version valid on the day of each asked (business_date, keys); the latest start wins.

    An interval join: a version goes into the coarse bins that it covers inside the asked range,
    and meets the days of a bin there. Versions are not multiplied by days, and neither the plan
    nor the driver knows the days.
    """
    range_ = asked.agg(F.min("business_date").alias("low"), F.max("business_date").alias("high"))
    clipped = (
        versions.select(*keys, *values, "valid_from", "valid_to")
        .join(F.broadcast(range_))
        .withColumn("first", F.greatest("valid_from", "low"))
        .withColumn("last", F.least("valid_to", "high"))
        .filter("first <= last")
    )
    binned = clipped.withColumn("bin", F.explode(F.sequence(_bin(F.col("first")), _bin(F.col("last")))))
    met = asked.select("business_date", *keys).distinct().withColumn("bin", _bin(F.col("business_date")))
    inside = met.join(binned.drop("low", "high"), [*keys, "bin"]).filter(
        F.col("business_date").between(F.col("first"), F.col("last"))
    )
    return (
        inside.groupBy("business_date", *keys)
        .agg(latest(F.struct(*values), "valid_from", "valid_to").alias("v"))
        .select("business_date", *keys, "v.*")
    )


PARAMETER_VALUES = ["lead_time_days", "target_stock_days", "overstock_days"]


def with_parameters(positions: DataFrame, parameters: DataFrame) -> DataFrame:
    """Parameters valid on the business date: those of the pair, else those of the article."""
    exact = valid_on(
        parameters.filter(F.col("branch_id").isNotNull()), PAIR, positions, PARAMETER_VALUES
    )
    wide = valid_on(
        parameters.filter(F.col("branch_id").isNull()), ["article_id"], positions, PARAMETER_VALUES
    )
    renamed = wide.withColumnsRenamed({v: f"article_{v}" for v in PARAMETER_VALUES})
    pair_level = F.col("lead_time_days").isNotNull()
    joined = positions.join(exact, ["business_date", *PAIR], "left").join(
        renamed, ["business_date", "article_id"], "left"
    )
    return joined.withColumn(
        "parameter_level",
        F.when(pair_level, "PAIR").when(F.col("article_lead_time_days").isNotNull(), "ARTICLE"),
    ).withColumns(
        {v: F.coalesce(F.col(v), F.col(f"article_{v}")) for v in PARAMETER_VALUES}
    ).drop(*[f"article_{v}" for v in PARAMETER_VALUES])


def net_stock() -> Column:
    """Physical stock plus what is on its way, minus what is promised; only physical is required."""
    def optional(name: str) -> Column:
        return F.coalesce(F.col(name), num(0))

    return dec(
        F.col("physical_stock") + optional("direct_po_inbound") + optional("cd_in_transit")
        - optional("special_sale_committed") - optional("confirmed_transfer_pending")
    )


def thresholds(rows: DataFrame) -> DataFrame:
    """Critical, minimum, maximum and overstock quantities and the days of coverage."""
    demand = F.col("basal_daily_demand")
    return rows.withColumns(
        {
            "critical_stock": dec(demand * F.col("lead_time_days")),
            "minimum_stock": dec(demand * F.col("lead_time_days") * 2),
            "maximum_stock": dec(demand * F.col("target_stock_days")),
            "overstock_quantity": dec(demand * F.col("overstock_days")),
            "coverage_days": dec(F.try_divide(F.col("net_stock"), F.nullif(demand, num(0)))),
        }
    )


def branch(inputs: DataFrame, estimates: DataFrame, parameters: DataFrame) -> DataFrame:
    """Position of every pair and business date, with its status and the reasons for it.

    A missing required value blocks the line alone.
    """
    joined = with_parameters(asof_estimate(inputs, estimates), parameters)
    valued = thresholds(joined.withColumn("net_stock", net_stock()))
    no_estimate = F.col("basal_daily_demand").isNull()
    invalid = (F.col("lead_time_days") <= 0) | (F.col("target_stock_days") < 0)
    no_parameters = F.col("lead_time_days").isNull() | F.col("target_stock_days").isNull()
    blocked = (
        no_estimate | F.col("physical_stock").isNull() | no_parameters
        | F.coalesce(invalid, F.lit(False)) | (F.coalesce("basal_daily_demand", num(0)) < 0)
    )
    return valued.withColumns(
        {
            "calculation_status": F.when(blocked, "BLOCKED")
            .when(F.col("basal_daily_demand") == 0, "ZERO_PDVB")
            .when(F.col("estimate_status") == "WARN", "WARN")
            .otherwise("OK"),
            "alert_codes": codes(
                (no_estimate, "MISSING_DEMAND"),
                (F.col("physical_stock").isNull(), "MISSING_STOCK"),
                (no_parameters, "MISSING_PARAMETERS"),
                (invalid, "INVALID_PARAMETERS"),
                (F.col("basal_daily_demand") < 0, "NEGATIVE_DEMAND"),
            ),
        }
    )


def purchase_order_class(due: Column, as_of: date) -> Column:
    return F.when(due < F.lit(as_of), "OVERDUE").otherwise("ON_TIME")


def center(
    center_inputs: DataFrame, purchase_orders: DataFrame, backlog: DataFrame, as_of: date
) -> DataFrame:
    """Origin stock next to the backlog it faces. A reference figure, not a reservation.

    The coverage index sets physical stock and on-time orders against the whole backlog; it has
    no value where nothing is open.
    """
    overdue = purchase_order_class(F.col("due_date"), as_of) == "OVERDUE"
    incoming = purchase_orders.groupBy("article_id").agg(
        dec(F.sum(F.when(~overdue, F.col("open_quantity")))).alias("open_po_on_time"),
        dec(F.sum(F.when(overdue, F.col("open_quantity")))).alias("open_po_overdue"),
    )

    def total(kinds: tuple[str, ...]) -> Column:
        parts = [F.col(f"{k.lower()}_open_quantity") for k in NEED_TYPES if k in kinds]
        return dec(F.sum(sum(parts[1:], parts[0])))

    demanded = backlog.groupBy("article_id").agg(
        total(MANDATORY_TYPES).alias("mandatory_backlog"),
        total(OPTIONAL_TYPES).alias("optional_backlog"),
    )
    joined = (
        center_inputs.select("business_date", "article_id", "physical_stock")
        .join(incoming, "article_id", "left")
        .join(demanded, "article_id", "left")
    )
    filled = joined.withColumns(
        {
            c: F.coalesce(F.col(c), num(0))
            for c in ("open_po_on_time", "open_po_overdue", "mandatory_backlog", "optional_backlog")
        }
    )
    open_total = F.col("mandatory_backlog") + F.col("optional_backlog")
    return filled.withColumns(
        {
            "coverage_index": dec(
                F.try_divide(
                    dec(F.col("physical_stock") + F.col("open_po_on_time")),
                    dec(F.nullif(open_total, F.lit(0).cast("decimal(19,6)"))),
                )
            ),
            "status": F.when(F.col("physical_stock").isNull(), "BLOCKED")
            .when(F.col("open_po_overdue") > 0, "WARN")
            .otherwise("OK"),
        }
    )
