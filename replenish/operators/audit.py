"""Append-only change trail and line-level explanation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The formulas shown with every explained line.
FORMULAS = {
    "net_stock": "physical + inbound + transit - committed - pending",
    "D": "max(demand * target_days - net_stock, 0)",
    "S": "max(maximum + overstock - max(net_stock, 0) - D, 0)",
}


def diff(
    before: DataFrame, after: DataFrame, keys: list[str], entity: str, correlation_id: str,
    actor: str = "SYSTEM",
) -> DataFrame:
    """One event per created, removed or changed entity, with its state before and after."""
    values = [c for c in after.columns if c not in keys]
    old = before.select(*keys, F.struct(*values).alias("old"))
    new = after.select(*keys, F.struct(*values).alias("new"))
    joined = old.join(new, keys, "full_outer").withColumn(
        "event_type",
        F.when(F.col("old").isNull(), "CREATED")
        .when(F.col("new").isNull(), "REMOVED")
        .when(~F.col("old").eqNullSafe(F.col("new")), "CHANGED"),
    )
    return joined.filter(F.col("event_type").isNotNull()).select(
        F.lit(entity).alias("entity_type"),
        F.concat_ws("|", *keys).alias("entity_id"),
        "event_type",
        F.lit("SYSTEM").alias("actor_type"),
        F.lit(actor).alias("actor_id"),
        F.lit(correlation_id).alias("correlation_id"),
        F.to_json("old").alias("before_state"),
        F.to_json("new").alias("after_state"),
    )


def explain_needs(needs: DataFrame, positions: DataFrame, run_id: str) -> DataFrame:
    """Formula, inputs, parameters, estimate and alerts behind every automatic need."""
    reasons = positions.select(
        "business_date", "article_id", "branch_id",
        F.struct(
            "physical_stock", "direct_po_inbound", "cd_in_transit", "special_sale_committed",
            "confirmed_transfer_pending", "net_stock", "batch_id", "as_of_ts",
        ).alias("inputs"),
        F.struct("lead_time_days", "target_stock_days", "overstock_days", "parameter_level").alias(
            "parameters"
        ),
        F.struct("estimate_date", "estimate_run_id", "estimate_status", "basal_daily_demand").alias(
            "estimate"
        ),
        F.struct(
            "critical_stock", "minimum_stock", "maximum_stock", "overstock_quantity",
            "coverage_days",
        ).alias("thresholds"),
    )
    formulas = F.create_map(*[F.lit(x) for item in FORMULAS.items() for x in item])
    return needs.join(reasons, ["business_date", "article_id", "branch_id"], "left").withColumns(
        {
            "run_id": F.lit(run_id),
            "formula": F.try_element_at(formulas, F.col("need_type")),
        }
    )
