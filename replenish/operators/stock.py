"""Canonical daily stock from wide monthly rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from replenish.functions.exprs import bar_hash, dec, text, text_or_blank
from replenish.functions.windows import calendar, check_range
from replenish.operators.scale import keep_matching
from replenish.schemas import DAY_COLUMNS


def _days_needed(start: date, end: date) -> list[str]:
    """Day columns that can hold a date of the range; a range inside a month reads only those."""
    if (start.year, start.month) == (end.year, end.month):
        return DAY_COLUMNS[start.day - 1 : end.day]
    return DAY_COLUMNS


def _month_start() -> Column:
    return F.make_date("year", "month", F.lit(1))


def unpivot_days(
    wide: DataFrame, start: date, end: date, keep: list[str] | None = None
) -> DataFrame:
    """One row per real calendar day of the months between `start` and `end`, range-filtered.

    Months are filtered before the rows multiply, and days that a month does not have are dropped
    before a date is built from them.
    """
    check_range(start, end)
    carried = keep if keep is not None else [
        c for c in ("processed_at", "processed_ok", "origin") if c in wide.columns
    ]
    months = wide.filter(
        (F.col("year").between(start.year, end.year))
        & _month_start().between(F.lit(start.replace(day=1)), F.lit(end.replace(day=1)))
    )
    days = months.unpivot(
        ["year", "month", "branch_id", "article_id", *carried],
        _days_needed(start, end),
        "day_label",
        "quantity",
    ).withColumn("day_no", F.expr("cast(substr(day_label, 6) as int)"))
    real = days.filter(F.col("day_no") <= F.day(F.last_day(_month_start())))
    dated = real.withColumn("stock_date", F.date_add(_month_start(), F.col("day_no") - 1))
    return dated.filter(F.col("stock_date").between(F.lit(start), F.lit(end))).drop("day_label")


def closed_day(day: Column, processed_at: Column) -> Column:
    """A day counts once it is over: up to the day before processing, or always if unknown."""
    return processed_at.isNull() | (day <= F.date_sub(F.to_date(processed_at), 1))


def normalize(wide: DataFrame, scope: DataFrame, start: date, end: date) -> DataFrame:
    """Daily stock rows of the scope. A missing row means unknown, never zero.

    A NULL quantity is unknown as well and yields no row (see `unknown_quantities`).
    """
    in_scope = keep_matching(wide, scope, ["article_id", "branch_id"])
    closed = unpivot_days(in_scope, start, end).filter(
        closed_day(F.col("stock_date"), F.col("processed_at")) & F.col("quantity").isNotNull()
    )
    quantity = dec("quantity")
    return closed.select(
        "stock_date",
        F.col("article_id").cast("int").alias("article_id"),
        F.col("branch_id").cast("int").alias("branch_id"),
        quantity.alias("stock_quantity"),
        sign_status(quantity).alias("stock_sign_status"),
        (quantity > 0).alias("is_serviceable"),
        F.col("year").cast("smallint").alias("source_year"),
        F.col("month").cast("smallint").alias("source_month"),
        F.col("day_no").cast("smallint").alias("source_day"),
        F.col("processed_at").alias("source_processed_at"),
        F.col("processed_ok").alias("source_processed_ok"),
        F.col("origin").alias("source_origin"),
        F.when(F.col("processed_at").isNotNull(), "PROCESS_DATE_MINUS_1")
        .otherwise("EXPLICIT_CUTOFF")
        .alias("closed_day_rule"),
        bar_hash(
            text("stock_date"), text("article_id"), text("branch_id"), text(quantity),
            text_or_blank("processed_at"), text_or_blank("processed_ok"), text_or_blank("origin"),
        ).alias("source_row_hash"),
    )


def sign_status(quantity: Column) -> Column:
    return (
        F.when(quantity > 0, "POSITIVE").when(quantity == 0, "ZERO").otherwise("NEGATIVE")
    )


def unknown_quantities(wide: DataFrame, scope: DataFrame, start: date, end: date) -> DataFrame:
    """Days whose quantity is NULL in the source, reported instead of stored."""
    in_scope = keep_matching(wide, scope, ["article_id", "branch_id"])
    return (
        unpivot_days(in_scope, start, end, keep=[])
        .filter(F.col("quantity").isNull())
        .select("stock_date", "article_id", "branch_id")
    )


def coverage(stock: DataFrame, scope_pairs: DataFrame, start: date, end: date) -> DataFrame:
    """Per day: how many pairs are expected, how many have stock rows, how many positive stock.

    The expected number is the pair count times one; no pair-by-day frame has to be built.
    """
    expected = scope_pairs.select("article_id", "branch_id")
    found = (
        keep_matching(
            stock.filter(F.col("stock_date").between(F.lit(start), F.lit(end))),
            expected, ["article_id", "branch_id"],
        )
        .groupBy("stock_date")
        .agg(
            F.count(F.lit(1)).alias("known_pairs"),
            F.count_if("is_serviceable").alias("positive_pairs"),
        )
    )
    pairs = expected.count()
    days = calendar(expected.sparkSession, start, end, "stock_date")
    none = F.lit(0).cast("bigint")
    return days.join(found, "stock_date", "left").select(
        "stock_date",
        F.lit(pairs).cast("bigint").alias("expected_pairs"),
        F.coalesce("known_pairs", none).alias("known_pairs"),
        F.coalesce("positive_pairs", none).alias("positive_pairs"),
    )


def coverage_alerts(
    daily: DataFrame, minimum_known: float = 0.9, maximum_drop: float = 0.2
) -> DataFrame:
    """Days with too little known stock, or whose positive share fell sharply from the day before."""
    # One row per day: the whole calendar is a bounded frame.
    by_day = Window.orderBy("stock_date")
    known = F.try_divide(F.col("known_pairs"), F.col("expected_pairs"))
    positive = F.try_divide(F.col("positive_pairs"), F.col("known_pairs"))
    shares = daily.withColumns({"known_share": known, "positive_share": positive}).withColumn(
        "previous_positive_share", F.lag("positive_share").over(by_day)
    )
    return shares.withColumns(
        {
            "low_coverage": F.coalesce(F.col("known_share") < minimum_known, F.lit(True)),
            "sharp_drop": F.coalesce(
                F.col("previous_positive_share") - F.col("positive_share") > maximum_drop,
                F.lit(False),
            ),
        }
    )
