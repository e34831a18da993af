"""Informative logistic estimates; a missing factor never hides a line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replenish.functions.exprs import dec

FACTORS = ["units_per_package", "packages_per_pallet", "unit_weight_kg", "unit_volume_m3"]


def quality(items: DataFrame) -> DataFrame:
    """COMPLETE, PARTIAL, MISSING or INVALID per article."""
    present = sum((F.col(c).isNotNull().cast("int") for c in FACTORS[1:]),
                  F.col(FACTORS[0]).isNotNull().cast("int"))
    invalid = (
        (F.col("units_per_package") <= 0) | (F.col("packages_per_pallet") <= 0)
        | (F.col("unit_weight_kg") < 0) | (F.col("unit_volume_m3") < 0)
    )
    return items.withColumn(
        "quality_status",
        F.when(F.coalesce(invalid, F.lit(False)), "INVALID")
        .when(present == len(FACTORS), "COMPLETE")
        .when(present == 0, "MISSING")
        .otherwise("PARTIAL"),
    )


def estimate(lines: DataFrame, items: DataFrame, quantity: str) -> DataFrame:
    """Packages, pallets, weight and volume of `quantity`; NULL where a factor is missing."""
    factors = quality(items).select("article_id", *FACTORS, "quality_status")
    joined = lines.join(factors, "article_id", "left")
    usable = F.coalesce(F.col("quality_status") != "INVALID", F.lit(False))
    amount = F.when(usable, F.col(quantity))
    packages = F.try_divide(amount, F.col("units_per_package"))
    return joined.withColumns(
        {
            "estimated_packages": dec(packages),
            "estimated_pallets": dec(F.try_divide(dec(packages, 28, 10), F.col("packages_per_pallet"))),
            "estimated_weight_kg": dec(amount * F.col("unit_weight_kg")),
            "estimated_volume_m3": dec(amount * F.col("unit_volume_m3"), 18, 9),
            "logistics_status": F.coalesce("quality_status", F.lit("MISSING")),
            "logistics_data_missing": F.coalesce(
                F.col("quality_status") != "COMPLETE", F.lit(True)
            ),
        }
    ).drop(*FACTORS, "quality_status")
