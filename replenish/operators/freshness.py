"""How far each source is closed, and the gate that keeps a run behind the common closed date."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenish.functions.exprs import checksum

SOURCES = ("raw_sales", "enriched_sales", "stock_source", "canonical_stock")


class SourceNotClosed(RuntimeError):
    """The requested end lies beyond what all sources have closed."""


def month_closed_through(year: Column, month: Column, processed_at: Column) -> Column:
    """Last closed day of a monthly stock row; without a processing time the whole month counts."""
    month_end = F.last_day(F.make_date(year, month, F.lit(1)))
    return F.least(
        month_end, F.coalesce(F.date_sub(F.to_date(processed_at), 1), month_end)
    )


def read(
    raw_sales: DataFrame,
    enriched: DataFrame,
    wide_stock: DataFrame,
    stock_daily: DataFrame,
    since: date | None = None,
) -> DataFrame:
    """One row: the last date of every source and the common closed date.

    The common date is NULL as soon as one source has none. With `since` only rows from that day
    on are read, which prunes the scans; a source that ends before it then has no date.
    """
    if since is not None:
        raw_sales = raw_sales.filter(F.col("sales_ts") >= F.lit(since))
        enriched = enriched.filter(F.col("sales_ts") >= F.lit(since))
        wide_stock = wide_stock.filter(
            (F.col("year") > since.year) | ((F.col("year") == since.year) & (F.col("month") >= since.month))
        )
        stock_daily = stock_daily.filter(F.col("stock_date") >= F.lit(since))
    closed = month_closed_through(F.col("year"), F.col("month"), F.col("processed_at"))
    last = {
        "raw_sales": raw_sales.agg(F.to_date(F.max("sales_ts")).alias("day")),
        "enriched_sales": enriched.agg(F.to_date(F.max("sales_ts")).alias("day")),
        "stock_source": wide_stock.agg(F.max(closed).alias("day")),
        "canonical_stock": stock_daily.agg(F.max("stock_date").alias("day")),
    }
    stacked = None
    for name, frame in last.items():
        labelled = frame.withColumn("source", F.lit(name))
        stacked = labelled if stacked is None else stacked.unionByName(labelled)
    row = stacked.agg(
        *[F.max(F.when(F.col("source") == s, F.col("day"))).alias(f"{s}_date") for s in SOURCES]
    )
    dates = [F.col(f"{s}_date") for s in SOURCES]
    missing = dates[0].isNull()
    for d in dates[1:]:
        missing = missing | d.isNull()
    return row.withColumn("common_closed_date", F.when(~missing, F.least(*dates)))


@dataclass(frozen=True)
class Freshness:
    raw_sales_date: date | None
    enriched_sales_date: date | None
    stock_source_date: date | None
    canonical_stock_date: date | None
    common_closed_date: date | None


def gate(
    raw_sales: DataFrame,
    enriched: DataFrame,
    wide_stock: DataFrame,
    stock_daily: DataFrame,
    requested_end: date,
) -> Freshness:
    """Fail unless every source is closed through `requested_end`. A source that is has rows from
    that day on; only if one has none, the whole history is asked for its last date."""
    sources = (raw_sales, enriched, wide_stock, stock_daily)
    near = read(*sources, since=requested_end)
    if near.first()["common_closed_date"] is not None:
        return require(near, requested_end)
    return require(read(*sources), requested_end)


def require(row: DataFrame, requested_end: date) -> Freshness:
    """Fail unless every source is closed through `requested_end`; reads a single row."""
    found = Freshness(**row.first().asDict())
    if found.common_closed_date is None:
        raise SourceNotClosed(f"a source has no closed date: {found}")
    if requested_end > found.common_closed_date:
        raise SourceNotClosed(
            f"{requested_end} lies after the common closed date {found.common_closed_date}"
        )
    return found


def profile(
    source: DataFrame,
    code: str,
    date_column: str,
    expected_through: date,
    columns: list[str],
    as_of_column: str | None = None,
    required: bool = True,
    batch_id: str | None = None,
) -> DataFrame:
    """Snapshot of a source: date range, rows, checksum, lag and status, how recent its newest row
    is, whether a run needs it, and the batch it came with."""
    as_of = F.max(as_of_column) if as_of_column else F.lit(None)
    day = F.to_date(F.col(date_column))
    found = source.agg(
        F.min(day).alias("min_business_date"),
        F.max(day).alias("max_business_date"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(date_column).isNull()).alias("undated_rows"),
        checksum(*columns).alias("checksum"),
        as_of.cast("timestamp_ntz").alias("as_of_ts"),
    )
    lag = F.datediff(F.lit(expected_through), F.col("max_business_date"))
    return found.select(
        F.lit(code).alias("source_code"),
        "min_business_date",
        "max_business_date",
        "row_count",
        "checksum",
        (F.greatest(lag, F.lit(0)) * 86400).cast("bigint").alias("freshness_seconds"),
        F.when(F.col("row_count") == 0, "MISSING")
        .when(F.col("undated_rows") > 0, "INVALID")
        .when(lag > 0, "STALE")
        .otherwise("VALID")
        .alias("status"),
        "as_of_ts",
        F.lit(required).alias("is_required"),
        F.lit(batch_id).cast("string").alias("batch_id"),
    )


def split_scope(
    scope_pairs: DataFrame, available: DataFrame, on: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Pairs whose required source is there, and pairs that stay blocked until it arrives."""
    keys = available.select(*on).distinct()
    return (
        scope_pairs.join(keys, on, "left_semi"),
        scope_pairs.join(keys, on, "left_anti"),
    )
