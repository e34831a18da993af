"""Monthly medians and the split of raw sales into basal and promotional units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenish.functions.exprs import dec, num
from replenish.operators.scale import look_up, running_around
from replenish.params import PromoParams

MONTH_PAIR = ["month", "article_id", "branch_id"]


def exact_median(rows: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Exact median per key, without gathering a key in one task.

    Equal values are counted first; the middle position is then found among the distinct values
    by running counts that spread over many tasks.
    """
    counted = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("copies"))
    copies = ("sum", F.col("copies"))
    placed = running_around(
        counted, keys, [F.col(value)], before={"before": copies}, after={"after": copies}
    ).fillna(0, ["before", "after"])
    placed = placed.withColumn("total", F.col("before") + F.col("copies") + F.col("after"))
    # Positions of the two middle rows; the same one for an odd total.
    low = F.expr("(total + 1) div 2")
    high = F.expr("(total + 2) div 2")
    first, last = F.col("before"), F.col("before") + F.col("copies")
    middle = placed.filter(
        ((first < low) & (low <= last)) | ((first < high) & (high <= last))
    )
    return middle.groupBy(*keys).agg(
        dec((F.min(value) + F.max(value)) / F.lit(2)).alias("median"),
        F.max("total").alias("records"),
    )


def monthly_baseline(raw_sales: DataFrame) -> DataFrame:
    """Median units and price of the records of each pair and month."""
    rows = raw_sales.select(
        F.trunc(F.to_date("sales_ts"), "MM").alias("month"), "article_id", "branch_id",
        "units", "price",
    ).unpivot(MONTH_PAIR, ["units", "price"], "measure", "value")
    medians = exact_median(rows.filter(F.col("value").isNotNull()), [*MONTH_PAIR, "measure"])

    def of(measure: str, column: str) -> Column:
        return F.max(F.when(F.col("measure") == measure, F.col(column)))

    return medians.groupBy(*MONTH_PAIR).agg(
        of("units", "median").alias("median_units"),
        of("price", "median").alias("median_price"),
        of("units", "records").alias("records"),
    )


def split(
    raw_sales: DataFrame, baseline: DataFrame, params: PromoParams = PromoParams()
) -> DataFrame:
    """Score every record against its monthly medians and split its units.

    From `split_from` on, units above the median are promotional. Basal and promotional units
    always add up to the units sold; returns stay whole.
    """
    priced = look_up(
        raw_sales.withColumn("month", F.trunc(F.to_date("sales_ts"), "MM")),
        baseline.select(*MONTH_PAIR, "median_units", "median_price"),
        MONTH_PAIR,
    )
    score = F.lit(0)
    for band, price_share, units_multiple in reversed(params.bands):
        met = (F.col("price") <= F.col("median_price") * num(price_share)) & (
            F.col("units") >= F.col("median_units") * num(units_multiple)
        )
        score = F.when(met, F.lit(band)).otherwise(score)
    scored = priced.withColumn("promo_score", score)
    capped = (F.col("promo_score") >= params.split_from) & (F.col("units") > 0)
    basal = F.when(
        capped, F.least(F.col("units"), F.greatest(F.col("median_units"), num(0)))
    ).otherwise(F.col("units"))
    return scored.withColumns(
        {
            "basal_units": dec(basal),
            "promo_units": dec(F.col("units") - basal),
            "strong_promo_detected": F.col("promo_score") >= params.bands[0][0],
        }
    ).drop("month")


def reconciliation(enriched: DataFrame, tolerance: str = "0.001") -> DataFrame:
    """Control totals of promotion-split sales, per month."""
    gap = F.abs(F.col("units") - F.col("basal_units") - F.col("promo_units"))
    return enriched.groupBy(F.trunc(F.to_date("sales_ts"), "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("basal_units").isNull() | F.col("promo_units").isNull()).alias(
            "null_rows"
        ),
        F.count_if(gap > num(tolerance)).alias("conservation_breaks"),
        F.count_if(F.col("promo_score") >= 70).alias("scored_rows"),
        F.count_if(F.col("strong_promo_detected")).alias("strong_rows"),
        F.sum("units").alias("units"),
        F.sum("basal_units").alias("basal_units"),
        F.sum("promo_units").alias("promo_units"),
    )
