"""Declared schemas of the inputs and of the stored tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

INT, LONG, SHORT, TEXT = IntegerType(), LongType(), ShortType(), StringType()
FLAG, DAY, STAMP, TEXTS = BooleanType(), DateType(), TimestampNTZType(), ArrayType(StringType())
UNITS = DecimalType(18, 6)


def _row(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


CATALOG = _row(
    article_id=INT, branch_id=INT, supplier_id=INT, active_for_purchase=INT, route_code=TEXT,
    supply_mode=INT, enabled=INT, active_for_sale=INT, active_on_mix=INT, extracted_at=STAMP,
)

RAW_SALES = _row(
    sales_ts=STAMP, article_id=INT, branch_id=INT, price=UNITS, units=UNITS,
    amount=DecimalType(20, 4), special_sale=FLAG, normal_promo=FLAG, strong_promo=FLAG,
    family_id=INT, category_id=INT, subcategory_id=INT, supplier_id=INT, processed_at=STAMP,
)

ENRICHED_SALES = _row(
    sales_ts=STAMP, article_id=INT, branch_id=INT, price=UNITS, units=UNITS, basal_units=UNITS,
    promo_units=UNITS, promo_score=DecimalType(8, 4), strong_promo_detected=FLAG,
    calculated_at=STAMP,
)

DAY_COLUMNS = [f"q_day{n}" for n in range(1, 32)]

WIDE_STOCK = _row(
    year=INT, month=INT, branch_id=INT, article_id=INT,
    **{c: UNITS for c in DAY_COLUMNS},
    processed_at=STAMP, processed_ok=FLAG, origin=TEXT,
)

POSITION_INPUTS = _row(
    business_date=DAY, branch_id=INT, article_id=INT, supplier_id=INT, physical_stock=UNITS,
    direct_po_inbound=UNITS, cd_in_transit=UNITS, special_sale_committed=UNITS,
    confirmed_transfer_pending=UNITS, as_of_ts=STAMP, batch_id=TEXT,
)

PARAMETERS = _row(
    article_id=INT, branch_id=INT, lead_time_days=DecimalType(10, 4),
    target_stock_days=DecimalType(10, 4), overstock_days=DecimalType(10, 4), valid_from=DAY,
    valid_to=DAY,
)

CENTER_INPUTS = _row(
    business_date=DAY, article_id=INT, physical_stock=UNITS, open_po_on_time=UNITS,
    open_po_overdue=UNITS,
)

PURCHASE_ORDERS = _row(
    order_id=LONG, article_id=INT, open_quantity=UNITS, due_date=DAY,
)

ITEM_LOGISTICS = _row(
    article_id=INT, base_unit=TEXT, units_per_package=UNITS, packages_per_pallet=UNITS,
    unit_weight_kg=UNITS, unit_volume_m3=DecimalType(18, 9), as_of_ts=STAMP,
)

DIRECTED_NEEDS = _row(
    need_id=LONG, line_id=TEXT, need_type=TEXT, reference=TEXT, supplier_id=INT,
    valid_from=DAY, valid_to=DAY, status=TEXT, version=INT, branch_id=INT, article_id=INT,
    original_quantity=UNITS, prepared_quantity=UNITS, cancelled_quantity=UNITS,
    target_date=DAY, sla_at=STAMP,
)

IMPORT_REQUESTS = _row(
    idempotency_key=TEXT, adapter=TEXT, snapshot_version=TEXT, operator=TEXT, line_id=TEXT,
    line_version=INT, quantity=UNITS, requested_at=STAMP,
)

EXECUTION_EVENTS = _row(
    dedup_key=TEXT, import_id=TEXT, line_id=TEXT, event_type=TEXT, external_status=TEXT,
    quantity_mode=TEXT, quantity=UNITS, document=TEXT, occurred_at=STAMP, received_at=STAMP,
    mapping_version=TEXT,
)

STOCK_DAILY = _row(
    stock_date=DAY, article_id=INT, branch_id=INT, stock_quantity=UNITS,
    stock_sign_status=TEXT, is_serviceable=FLAG, source_year=SHORT, source_month=SHORT,
    source_day=SHORT, source_processed_at=STAMP, source_processed_ok=FLAG, source_origin=TEXT,
    closed_day_rule=TEXT, source_row_hash=TEXT, normalized_at=STAMP,
)

SALES_DAILY = _row(
    sales_date=DAY, article_id=INT, branch_id=INT, scope_version_id=TEXT, feature_run_id=TEXT,
    supplier_id=INT, family_id=INT, category_id=INT, subcategory_id=INT, source_row_count=LONG,
    observed_units=UNITS, return_units=UNITS, basal_units=UNITS, promo_units=UNITS,
    sold_amount=DecimalType(20, 4), effective_unit_price=UNITS, min_price=UNITS,
    max_price=UNITS, assortment_active=FLAG, availability_status=TEXT,
    stock_quantity_snapshot=UNITS, stock_source_hash=TEXT, special_sale_flag=FLAG,
    normal_promo_flag=FLAG, strong_promo_flag=FLAG, promo_score_max=DecimalType(8, 4),
    promo_adjustment_method=TEXT, eligible=FLAG, exclusion_codes=TEXTS,
    source_max_processed_at=STAMP, enriched_max_calculated_at=STAMP,
    feature_calculated_at=STAMP, source_hash=TEXT,
)

_WINDOWS = {
    f"{window}_{name}": kind
    for window in ("recent", "previous", "seasonal")
    for name, kind in {
        "start": DAY, "end": DAY, "basal_units": DecimalType(20, 6), "eligible_days": LONG,
        "mean": UNITS, "weight": DecimalType(8, 6),
    }.items()
}

DEMAND_ESTIMATE = _row(
    business_date=DAY, run_id=TEXT, model_version_id=TEXT, scope_version_id=TEXT, origin_id=INT,
    article_id=INT, branch_id=INT, supplier_id=INT, method_code=TEXT, fallback_level=SHORT,
    status=TEXT, confidence_score=DecimalType(5, 2), lookback_start=DAY, lookback_end=DAY,
    **_WINDOWS,
    active_days=LONG, eligible_days=LONG, nonzero_days=LONG,
    availability_coverage=DecimalType(8, 6), promo_coverage=DecimalType(8, 6), adi=UNITS,
    cv2=UNITS, raw_demand=UNITS, basal_daily_demand=UNITS,
    explanation=_row(
        cutoff_date=DAY, available_weight=UNITS, minimum_recent_eligible_days=INT,
        minimum_total_eligible_days=INT,
    ),
    input_checksum=TEXT, created_at=STAMP,
)

BACKTEST_DETAIL = _row(
    evaluation_date=DAY, run_id=TEXT, model_version_id=TEXT, scope_version_id=TEXT,
    origin_id=INT, article_id=INT, branch_id=INT, origin_date=DAY, horizon_days=INT,
    predicted_demand=UNITS, actual_basal_units=UNITS, eligible_actual=FLAG, error_units=UNITS,
    absolute_error_units=UNITS, squared_error=DecimalType(24, 8), status=TEXT,
    exclusion_codes=TEXTS, input_checksum=TEXT,
)


@dataclass(frozen=True)
class TableSpec:
    """A month-partitioned table: its business date, key and the columns that signal a change."""

    name: str
    schema: StructType
    date_column: str
    keys: tuple[str, ...]
    change_columns: tuple[str, ...] = ()


STOCK_TABLE = TableSpec(
    "stock_daily", STOCK_DAILY, "stock_date",
    ("stock_date", "article_id", "branch_id"), ("source_row_hash",),
)
SALES_TABLE = TableSpec(
    "sales_daily", SALES_DAILY, "sales_date",
    ("sales_date", "article_id", "branch_id"), ("source_hash", "scope_version_id"),
)
ESTIMATE_TABLE = TableSpec(
    "demand_estimate", DEMAND_ESTIMATE, "business_date",
    ("business_date", "run_id", "article_id", "branch_id"),
)
BACKTEST_TABLE = TableSpec(
    "backtest_detail", BACKTEST_DETAIL, "evaluation_date",
    ("evaluation_date", "run_id", "article_id", "branch_id", "origin_date", "horizon_days"),
)
TABLES = {t.name: t for t in (STOCK_TABLE, SALES_TABLE, ESTIMATE_TABLE, BACKTEST_TABLE)}
