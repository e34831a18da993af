"""Readers of the input relations; schemas are declared, never inferred."""

from replenish.sources.readers import (  # noqa: F401
    SOURCES,
    catalog,
    center_inputs,
    daily_inputs,
    directed_needs,
    enriched_sales,
    exchange_file,
    execution_events,
    item_logistics,
    parameters,
    purchase_orders,
    raw_sales,
    read_jdbc,
    read_table,
    wide_stock,
)
