"""Dense daily sales panel per pair, with availability and demand eligibility."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenish.functions.exprs import any_of, bar_hash, codes, dec, num, text, text_or_blank
from replenish.functions.windows import Span, check_range, days_between
from replenish.operators.scale import BROADCAST_ROWS, Bloom, bloom, is_bounded, spread

KEY = ["sales_date", "article_id", "branch_id"]
PAIR = ["article_id", "branch_id"]


def in_days(stamp: str, start: date, end: date) -> Column:
    """Half-open range on the raw timestamp, so that the filter reaches the scan."""
    return (F.col(stamp) >= F.lit(start)) & (F.col(stamp) < F.lit(end + timedelta(days=1)))


def scope_filter(scope_pairs: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame | Bloom | None:
    """What keeps the sales of a scope on the map side: the pair keys, or their Bloom filter where
    they are too many to broadcast.

    The Bloom filter lets a few other pairs through, which the panel's own join drops. None is for
    a scope beyond that as well; a shuffle of raw rows by pair would be the costlier way.
    """
    keys = scope_pairs.select(*PAIR)
    return F.broadcast(keys) if is_bounded(keys, limit) else bloom(keys, PAIR)


def _of_scope(sales: DataFrame, keys: DataFrame | Bloom | None) -> DataFrame:
    if isinstance(keys, Bloom):
        return keys.keep(sales)
    return sales if keys is None else sales.join(keys, PAIR, "left_semi")


def _flag(name: str) -> Column:
    return F.bool_or(F.coalesce(F.col(name), F.lit(False)))


def raw_daily(
    raw_sales: DataFrame, start: date, end: date, keys: DataFrame | Bloom | None = None
) -> DataFrame:
    """Price-grain sales rolled up to a day; returns are kept apart from demand."""
    check_range(start, end)
    rows = _of_scope(raw_sales.filter(in_days("sales_ts", start, end)), keys)
    sold = F.greatest(F.col("units"), F.lit(0).cast("decimal(18,6)"))
    returned = F.abs(F.least(F.col("units"), F.lit(0).cast("decimal(18,6)")))
    paid = F.when(F.col("units") > 0, F.col("price") * F.col("units")).otherwise(
        F.lit(0).cast("decimal(37,12)")
    )
    daily = rows.groupBy(F.to_date("sales_ts").alias("sales_date"), *PAIR).agg(
        F.count(F.lit(1)).alias("source_row_count"),
        F.sum(sold).alias("sold"),
        F.sum(returned).alias("returned"),
        F.sum("amount").alias("amount"),
        F.sum(paid).alias("paid"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        _flag("special_sale").alias("special_sale_flag"),
        _flag("normal_promo").alias("normal_promo_flag"),
        _flag("strong_promo").alias("strong_promo_flag"),
        F.max("family_id").alias("family_id"),
        F.max("category_id").alias("category_id"),
        F.max("subcategory_id").alias("subcategory_id"),
        F.max("supplier_id").alias("sales_supplier_id"),
        F.max("processed_at").alias("source_max_processed_at"),
    )
    return daily.withColumns(
        {
            "observed_units": dec("sold"),
            "return_units": dec("returned"),
            "sold_amount": dec("amount", 20, 4),
            "effective_unit_price": dec(
                F.try_divide(F.col("paid").cast("decimal(38,12)"), F.col("sold"))
            ),
            "min_price": dec("min_price"),
            "max_price": dec("max_price"),
        }
    ).drop("sold", "returned", "amount", "paid")


def enriched_daily(
    enriched: DataFrame, start: date, end: date, keys: DataFrame | Bloom | None = None
) -> DataFrame:
    """Promotion-split sales rolled up to a day."""
    check_range(start, end)
    rows = _of_scope(enriched.filter(in_days("sales_ts", start, end)), keys)
    zero = F.lit(0).cast("decimal(18,6)")
    return rows.groupBy(F.to_date("sales_ts").alias("sales_date"), *PAIR).agg(
        F.count(F.lit(1)).alias("enriched_row_count"),
        dec(F.sum(F.greatest(F.col("basal_units"), zero))).alias("enriched_basal_units"),
        dec(F.sum(F.greatest(F.col("promo_units"), zero))).alias("enriched_promo_units"),
        dec(F.max("promo_score"), 8, 4).alias("promo_score_max"),
        _flag("strong_promo_detected").alias("strong_promo_detected"),
        F.max("calculated_at").alias("enriched_max_calculated_at"),
    )


def skeleton(scope_pairs: DataFrame, spans: list[Span]) -> DataFrame:
    """Every pair on every day of the spans, generated in place instead of cross-joined."""
    days = F.concat(
        *[F.sequence(F.lit(s.start), F.lit(s.end), F.expr("interval 1 day")) for s in spans]
    )
    # A day in two overlapping spans appears once.
    return spread(scope_pairs, *PAIR).select(
        F.explode(F.array_distinct(days)).alias("sales_date"), *PAIR, "supplier_id"
    )


def availability(observed: Column, stock_hash: Column, serviceable: Column) -> Column:
    return (
        F.when(observed > 0, "INFERRED_FROM_SALE")
        .when(stock_hash.isNull(), "UNKNOWN")
        .when(serviceable, "IN_STOCK")
        .otherwise("OUT_OF_STOCK")
    )


def classify(panel: DataFrame) -> DataFrame:
    """Availability, promotion treatment, eligibility, exclusion codes and row hash.

    Expects the defaults of `build` to be filled in: a NULL flag would make a condition NULL.
    """
    observed = F.col("observed_units")
    enriched = F.coalesce(F.col("enriched_row_count") > 0, F.lit(False))
    flagged = (F.col("source_row_count") > 0) & any_of(
        F.col("special_sale_flag"), F.col("normal_promo_flag"), F.col("strong_promo_flag")
    )
    split = panel.withColumns(
        {
            "availability_status": availability(
                observed, F.col("stock_source_hash"), F.col("is_serviceable")
            ),
            "basal_units": F.when(enriched, F.col("enriched_basal_units"))
            .when(flagged, num(0))
            .otherwise(observed),
            "promo_units": F.when(enriched, F.col("enriched_promo_units"))
            .when(flagged, observed)
            .otherwise(num(0)),
            "promo_adjustment_method": F.when(enriched, "ENRICHED")
            .when(flagged, "RAW_FLAGS")
            .when(F.col("source_row_count") > 0, "NO_ADJUSTMENT")
            .otherwise("NOT_APPLICABLE"),
        }
    )
    status = F.col("availability_status")
    unsplit_promo = (F.col("promo_adjustment_method") == "RAW_FLAGS") & (observed > 0)
    return split.withColumns(
        {
            "eligible": status.isin("IN_STOCK", "INFERRED_FROM_SALE") & ~unsplit_promo,
            "exclusion_codes": codes(
                (status == "UNKNOWN", "STOCK_UNKNOWN"),
                (status == "OUT_OF_STOCK", "OUT_OF_STOCK"),
                (unsplit_promo, "PROMO_WITHOUT_ENRICHMENT"),
            ),
            "source_hash": bar_hash(
                *[
                    text(c)
                    for c in (
                        "sales_date", "article_id", "branch_id", "observed_units", "return_units",
                        "basal_units", "promo_units", "availability_status",
                        "promo_adjustment_method",
                    )
                ],
                text_or_blank("stock_source_hash"),
            ),
        }
    )


def build(
    scope_pairs: DataFrame,
    raw_sales: DataFrame,
    enriched: DataFrame,
    stock: DataFrame,
    spans: list[Span] | Span,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """One classified row per pair and day of the spans, days without a sale included.

    Sales are aggregated to the day before any join, by the very key the joins use: the joins
    then meet unique keys and reuse the partitioning of the aggregates. A scope of more than `limit`
    pairs filters the sales by its Bloom filter.
    """
    spans = [spans] if isinstance(spans, Span) else spans
    start, end = min(s.start for s in spans), max(s.end for s in spans)

    def wanted(day: Column) -> Column:
        return any_of(*[s.holds(day) for s in spans])

    def in_spans(rows: DataFrame, stamp: str) -> DataFrame:
        return rows.filter(any_of(*[in_days(stamp, s.start, s.end) for s in spans]))

    keys = scope_filter(scope_pairs, limit)
    raw = raw_daily(in_spans(raw_sales, "sales_ts"), start, end, keys)
    extra = enriched_daily(in_spans(enriched, "sales_ts"), start, end, keys)
    shelf = stock.filter(wanted(F.col("stock_date"))).select(
        F.col("stock_date").alias("sales_date"),
        *PAIR,
        F.col("stock_quantity").alias("stock_quantity_snapshot"),
        "is_serviceable",
        F.col("source_row_hash").alias("stock_source_hash"),
    )
    joined = (
        skeleton(scope_pairs, spans)
        .join(raw, KEY, "left")
        .join(extra, KEY, "left")
        .join(shelf, KEY, "left")
    )
    no = F.lit(False)
    filled = joined.withColumns(
        {
            "supplier_id": F.coalesce("sales_supplier_id", "supplier_id"),
            "source_row_count": F.coalesce("source_row_count", F.lit(0).cast("bigint")),
            "observed_units": dec(F.coalesce("observed_units", num(0))),
            "return_units": dec(F.coalesce("return_units", num(0))),
            "special_sale_flag": F.coalesce("special_sale_flag", no),
            "normal_promo_flag": F.coalesce("normal_promo_flag", no),
            "strong_promo_flag": F.coalesce("strong_promo_flag", no),
            "strong_promo_detected": F.coalesce("strong_promo_detected", no),
        }
    )
    done = classify(filled)
    return done.withColumns(
        {
            "assortment_active": F.lit(True),
            "strong_promo_flag": F.col("strong_promo_flag") | F.col("strong_promo_detected"),
        }
    ).drop(
        "sales_supplier_id", "strong_promo_detected", "enriched_row_count",
        "enriched_basal_units", "enriched_promo_units", "is_serviceable",
    )


def calendar_panel(scope_pairs: DataFrame, start: date, end: date) -> DataFrame:
    """Bare pair-by-day frame."""
    check_range(start, end)
    return scope_pairs.select(days_between(start, end).alias("sales_date"), *PAIR)
