"""Derive every input relation from the test tables.

Article = part brand, branch = nation of the supplier, sale = line item. The tables supply the
rows; flags that they lack come from arithmetic on the ids.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from replenish.functions import windows
from replenish.functions.exprs import dec, num
from replenish.functions.windows import Span
from replenish.operators.scale import hashed, is_bounded, is_even, spread
from replenish.params import ORIGIN_ID
from replenish.schemas import DAY_COLUMNS

BUSINESS_DATE = date(2001, 8, 2)
WINDOWS = windows.build(BUSINESS_DATE)
EXTRACTED = "2001-08-01 03:00:00"


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _stamp(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def _article() -> Column:
    return F.expr("cast(substr(p_brand, 7) as int)")


def branch_ids(spark: SparkSession, folder: str) -> list[int]:
    """The 25 rows of `nation`."""
    rows = table(spark, folder, "nation").select("n_nationkey").collect()
    return sorted(int(r[0]) for r in rows)


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Origin rows and two versions of every pair; the second version has no extraction time."""
    articles = table(spark, folder, "part").select(_article().alias("article_id")).distinct()
    at_origin = articles.select(
        "article_id",
        F.lit(ORIGIN_ID).alias("branch_id"),
        (F.col("article_id") * 10).alias("supplier_id"),
        F.when(F.col("article_id") % 10 == 0, 0).otherwise(1).alias("active_for_purchase"),
        F.lit(None).cast("string").alias("route_code"),
        F.lit(0).alias("supply_mode"),
        F.lit(1).alias("enabled"),
        F.lit(1).alias("active_for_sale"),
        F.lit(1).alias("active_on_mix"),
        _stamp(EXTRACTED).alias("extracted_at"),
    )
    # An older extraction of some articles names a lower supplier; the newest one counts.
    older = at_origin.filter(F.col("article_id") % 3 == 0).withColumns(
        {"supplier_id": F.col("supplier_id") - 5, "extracted_at": _stamp("2001-07-01 03:00:00")}
    )
    a, b = F.col("article_id"), F.col("branch_id")
    versions = articles.select(
        "article_id", F.explode(F.lit(branch_ids(spark, folder))).alias("branch_id")
    ).select("article_id", "branch_id", F.explode(F.lit([0, 1])).alias("ver"))

    def off_when(condition: Column) -> Column:
        return F.when(condition, 0).otherwise(1)

    at_branches = versions.select(
        "article_id",
        "branch_id",
        F.when((a + b) % 5 != 0, a * 10 + 1 + F.col("ver")).alias("supplier_id"),
        F.lit(1).alias("active_for_purchase"),
        F.when((a + b) % 7 == 0, "DIRECT").otherwise("41CD").alias("route_code"),
        F.when((a * 3 + b) % 11 == 0, 1).otherwise(0).alias("supply_mode"),
        off_when((a + b * 2) % 13 == 0).alias("enabled"),
        F.lit(1).alias("active_for_sale"),
        off_when((a * b) % 17 == 1).alias("active_on_mix"),
        F.when(F.col("ver") == 0, _stamp(EXTRACTED)).alias("extracted_at"),
    )
    return at_origin.unionByName(older).unionByName(at_branches)


def later_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """A later state: some pairs are disabled, some re-routed, some handed to another supplier."""
    a, b = F.col("article_id"), F.col("branch_id")
    at_branch = b != ORIGIN_ID
    return catalog(spark, folder).withColumns(
        {
            "enabled": F.when(at_branch & ((a + b) % 19 == 0), 0).otherwise(F.col("enabled")),
            "route_code": F.when(at_branch & ((a + b) % 21 == 0), "41CD").otherwise(
                F.col("route_code")
            ),
            "supplier_id": F.when(at_branch & ((a + b) % 23 == 0), 7).otherwise(
                F.col("supplier_id")
            ),
        }
    )


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items; ones that lie in a few tasks of their scan (few row groups) are spread over the
    cluster first, into tasks that are bounded in rows."""
    lines = table(spark, folder, "lineitem")
    if is_even(lines):
        return lines
    return spread(lines, "l_orderkey", "l_linenumber", rows=lines.count())


def _sold(spark: SparkSession, folder: str, spreading: bool = True) -> DataFrame:
    """Line items with their part's article and size and their supplier's nation.

    Masters within the bound of a broadcast leave the lines where they are. Parts beyond it move
    them once, by part, which spreads them as well, and are hashed there, so the lines are not sorted.
    """
    parts = table(spark, folder, "part").select("p_partkey", _article().alias("article_id"), "p_size")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    few = is_bounded(parts)
    lines = _lines(spark, folder) if few and spreading else table(spark, folder, "lineitem")
    here = F.broadcast(suppliers) if is_bounded(suppliers) else suppliers
    joined = lines.join(here, lines.l_suppkey == suppliers.s_suppkey)
    return joined.join(F.broadcast(parts) if few else hashed(parts), lines.l_partkey == parts.p_partkey)


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    joined = _sold(spark, folder)
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    return joined.select(
        F.col("l_shipdate").cast("timestamp_ntz").alias("sales_ts"),
        "article_id",
        F.col("s_nationkey").cast("int").alias("branch_id"),
        dec(F.try_divide("l_extendedprice", "l_quantity")).alias("price"),
        dec(F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity"))).alias("units"),
        dec("l_extendedprice", 20, 4).alias("amount"),
        (F.col("l_orderkey") % 50 == 0).alias("special_sale"),
        (F.col("l_discount") >= 0.08).alias("normal_promo"),
        (F.col("l_discount") >= 0.1).alias("strong_promo"),
        (F.col("article_id") % 5).alias("family_id"),
        F.col("p_size").alias("category_id"),
        F.lit(None).cast("int").alias("subcategory_id"),
        (F.col("article_id") * 10).alias("supplier_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("processed_at"),
    )


def enriched_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Odd months of two thirds of the articles stay without a promotion split."""
    rows = raw_sales(spark, folder).filter(
        (F.month("sales_ts") % 2 == 0) | (F.col("article_id") % 3 == 0)
    )
    sold = F.greatest(F.col("units"), num(0))
    half = dec(F.floor(sold * num("0.5")))
    return rows.select(
        "sales_ts", "article_id", "branch_id", "price", "units",
        F.when(F.col("normal_promo"), half).otherwise(sold).alias("basal_units"),
        dec(F.when(F.col("normal_promo"), sold - half).otherwise(num(0))).alias("promo_units"),
        F.when(F.col("strong_promo"), 100)
        .when(F.col("normal_promo"), 70)
        .otherwise(0)
        .cast("decimal(8,4)")
        .alias("promo_score"),
        F.col("strong_promo").alias("strong_promo_detected"),
        _stamp("2001-08-01 05:00:00").alias("calculated_at"),
    )


def history(spark: SparkSession, folder: str) -> Span:
    """First and last sales day; one row read."""
    row = (
        table(spark, folder, "lineitem")
        .agg(F.min("l_shipdate").cast("date"), F.max("l_shipdate").cast("date"))
        .first()
    )
    return Span(row[0], row[1])


def wide_stock(spark: SparkSession, folder: str, span: Span | None = None) -> DataFrame:
    """All 31 day columns are filled, also in short months; some pairs lack two months."""
    span = span or history(spark, folder)
    pairs = spread(
        catalog(spark, folder).select("article_id", "branch_id").distinct(),
        "article_id", "branch_id",
    )
    months = F.sequence(
        F.lit(span.start.replace(day=1)), F.lit(span.end.replace(day=1)), F.expr("interval 1 month")
    )
    rows = pairs.select("article_id", "branch_id", F.explode(months).alias("first"))
    keyed = rows.selectExpr(
        "year(first) as year", "month(first) as month", "branch_id", "article_id",
        "article_id * 7 + branch_id * 13 + month(first) * 5 as base",
    ).filter("not ((article_id + branch_id) % 6 = 0 and year = 2001 and month in (7, 8))")
    return keyed.selectExpr(
        "year", "month", "branch_id", "article_id",
        *[
            f"cast((base + {3 * n}) % 11 - 2 as decimal(18,6)) as {c}"
            for n, c in enumerate(DAY_COLUMNS, start=1)
        ],
        "case when year = 2001 and month = 8 "
        "then cast('2001-08-02 04:00:00' as timestamp_ntz) end as processed_at",
        "true as processed_ok",
        "'LEGACY' as origin",
    )


def position_inputs(stock_daily: DataFrame, scope_pairs: DataFrame) -> DataFrame:
    """Stock at the cutoff of every pair with the day's confirmed movements."""
    at_cutoff = stock_daily.filter(F.col("stock_date") == F.lit(WINDOWS.cutoff)).select(
        "article_id", "branch_id", (F.col("stock_quantity") * 5).alias("physical")
    )
    a, b = F.col("article_id"), F.col("branch_id")
    return scope_pairs.join(at_cutoff, ["article_id", "branch_id"], "left").select(
        F.lit(BUSINESS_DATE).alias("business_date"),
        "branch_id",
        "article_id",
        "supplier_id",
        dec("physical").alias("physical_stock"),
        dec(a % 4).alias("direct_po_inbound"),
        dec(b % 3).alias("cd_in_transit"),
        dec(a % 2).alias("special_sale_committed"),
        F.lit(None).cast("decimal(18,6)").alias("confirmed_transfer_pending"),
        _stamp("2001-08-02 02:00:00").alias("as_of_ts"),
        F.lit("batch-1").alias("batch_id"),
    )


def parameters(spark: SparkSession, folder: str) -> DataFrame:
    """Article-wide parameters, overridden for some pairs; one override has run out."""
    articles = table(spark, folder, "part").select(_article().alias("article_id")).distinct()
    a = F.col("article_id")
    wide = articles.filter(a != 13).select(
        "article_id", F.lit(None).cast("int").alias("branch_id"),
        dec(F.lit(2), 10, 4).alias("lead_time_days"),
        dec(F.lit(7), 10, 4).alias("target_stock_days"),
        dec(F.lit(3), 10, 4).alias("overstock_days"),
        F.lit(date(1995, 1, 1)).alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
    )
    branch = F.col("branch_id")
    pairs = articles.select(
        "article_id", F.explode(F.lit(branch_ids(spark, folder))).alias("branch_id")
    ).filter((a + branch) % 2 == 0)
    exact = pairs.select(
        "article_id", "branch_id",
        dec(1 + branch % 3, 10, 4).alias("lead_time_days"),
        dec(7 + a % 3, 10, 4).alias("target_stock_days"),
        dec(F.lit(3), 10, 4).alias("overstock_days"),
        F.lit(date(2000, 1, 1)).alias("valid_from"),
        F.when((a + branch) % 8 == 0, F.lit(date(2001, 6, 30))).alias("valid_to"),
    )
    return wide.unionByName(exact)


def item_logistics(spark: SparkSession, folder: str) -> DataFrame:
    """Factors from the parts of a brand; some articles lack one."""
    parts = table(spark, folder, "part").groupBy(_article().alias("article_id")).agg(
        F.max("p_size").alias("size")
    )
    a = F.col("article_id")
    return parts.select(
        "article_id", F.lit("UN").alias("base_unit"),
        dec(F.when(a % 6 != 5, 4 + a % 5)).alias("units_per_package"),
        dec(F.when(a % 7 != 6, 10 + a % 4)).alias("packages_per_pallet"),
        dec(F.col("size") / F.lit(10)).alias("unit_weight_kg"),
        dec(F.when(a != 24, F.col("size") / F.lit(1000)), 18, 9).alias("unit_volume_m3"),
        _stamp(EXTRACTED).alias("as_of_ts"),
    )


def directed_needs(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of the three upper priorities become special sales, campaigns and stockpiles."""
    kinds = {"1-URGENT": "E", "2-HIGH": "C", "3-MEDIUM": "A"}
    need_type = F.lit(None).cast("string")
    for priority, kind in kinds.items():
        need_type = F.when(F.col("o_orderpriority") == priority, kind).otherwise(need_type)
    orders = (
        table(spark, folder, "orders")
        .filter(F.col("o_orderpriority").isin(*kinds))
        .select(
            "o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("valid_from"),
            need_type.alias("need_type"),
        )
    )
    lines = _sold(spark, folder, spreading=False).filter(F.col("l_orderkey").isNotNull()).select(
        "l_orderkey", "article_id", F.col("s_nationkey").cast("int").alias("branch_id"), "l_quantity"
    )
    # Moved once, by order: the totals and the join with the orders both find them in place.
    sold = table(spark, folder, "lineitem").count()
    quantities = (
        spread(lines, "l_orderkey", rows=sold)
        .groupBy("l_orderkey", "article_id", "branch_id")
        .agg(dec(F.sum("l_quantity")).alias("original_quantity"))
    )
    joined = quantities.join(orders, quantities.l_orderkey == orders.o_orderkey)
    original = F.col("original_quantity")
    prepared = (
        F.when(F.col("o_orderstatus") == "F", original)
        .when(F.col("o_orderstatus") == "P", dec(F.floor(original * num("0.5"))))
        .otherwise(num(0))
    )
    return joined.select(
        F.col("o_orderkey").alias("need_id"),
        F.concat_ws("-", "o_orderkey", "article_id", "branch_id").alias("line_id"),
        "need_type",
        F.concat(F.lit("REF-"), F.col("o_orderkey") % 100).alias("reference"),
        F.lit(None).cast("int").alias("supplier_id"),
        "valid_from",
        F.when(F.col("need_type") == "E", F.date_add("valid_from", 2000))
        .when(F.col("need_type") == "C", F.date_add("valid_from", 400))
        .alias("valid_to"),
        F.lit("ACTIVE").alias("status"),
        F.lit(1).alias("version"),
        "branch_id",
        "article_id",
        "original_quantity",
        dec(prepared).alias("prepared_quantity"),
        dec(F.when(F.col("o_orderkey") % 20 == 0, original - prepared).otherwise(num(0))).alias(
            "cancelled_quantity"
        ),
        F.date_add("valid_from", 10).alias("target_date"),
        F.lit(None).cast("timestamp_ntz").alias("sla_at"),
    )


def center_inputs(spark: SparkSession, folder: str) -> DataFrame:
    """Origin stock per article."""
    parts = table(spark, folder, "part").groupBy(_article().alias("article_id")).agg(
        F.count(F.lit(1)).alias("parts")
    )
    return parts.select(
        F.lit(BUSINESS_DATE).alias("business_date"), "article_id",
        dec(F.col("parts") * 10).alias("physical_stock"),
    )


def purchase_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Open order lines stand in for supplier orders of the origin."""
    lines = table(spark, folder, "lineitem").filter(F.col("l_linestatus") == "O")
    parts = table(spark, folder, "part").select("p_partkey", _article().alias("article_id"))
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        F.col("l_orderkey").alias("order_id"), "article_id",
        dec("l_quantity").alias("open_quantity"),
        F.to_date("l_shipdate").alias("due_date"),
    )


# The external state each event type stands for.
EVENT_STATES = {
    "view": ("GEN", "IMPORTED"),
    "click": ("ACO", "UNKNOWN"),
    "signup": ("AGR", "UNKNOWN"),
    "purchase": ("TER", "PREPARED"),
    "error": ("ZZZ", "UNKNOWN"),
}
# Clicks of these users (number modulo 5) mean something else.
CLICK_STATES = {0: ("ANU", "CANCELLED"), 1: ("EXP", "DISPATCHED")}


def as_execution_events(events: DataFrame) -> DataFrame:
    """Rows of `events` in the event contract; every tenth arrives twice."""
    state = F.lit(None).cast("string")
    kind = F.lit(None).cast("string")
    plain = [(F.col("event_type") == name, meaning) for name, meaning in EVENT_STATES.items()]
    special = [
        ((F.col("event_type") == "click") & (F.col("user_id") % 5 == rest), meaning)
        for rest, meaning in CLICK_STATES.items()
    ]
    for here, (external, meaning) in plain + special:
        state = F.when(here, external).otherwise(state)
        kind = F.when(here, meaning).otherwise(kind)
    copies = F.when(F.col("event_id") % 10 == 0, 2).otherwise(1)
    received = F.col("ts").cast("timestamp_ntz") + F.expr("interval 5 minutes")
    return events.select(
        F.concat(F.lit("EV-"), F.col("event_id")).alias("dedup_key"),
        F.concat(F.lit("IMP-"), F.col("user_id") % 50).alias("import_id"),
        F.col("user_id").cast("string").alias("line_id"),
        kind.alias("event_type"),
        state.alias("external_status"),
        F.when(F.col("user_id") % 2 == 0, "CUMULATIVE").otherwise("DELTA").alias("quantity_mode"),
        dec("value").alias("quantity"),
        F.lit(None).cast("string").alias("document"),
        F.col("ts").cast("timestamp_ntz").alias("occurred_at"),
        received.alias("received_at"),
        F.lit("v1").alias("mapping_version"),
        F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
    ).drop("copy")


def execution_events(spark: SparkSession, folder: str) -> DataFrame:
    return as_execution_events(table(spark, folder, "events"))


def deliveries(spark: SparkSession, folder: str, count: int = 4) -> list[DataFrame]:
    """The events in `count` deliveries, in no order of time. Each delivery after the first repeats
    part of the one before; the last also repeats some events with another external time. Copies
    are received later than their originals."""
    events = execution_events(spark, folder)
    turn = F.pmod(F.crc32(F.col("dedup_key").cast("binary")), F.lit(count))
    marked = events.withColumn("turn", turn)
    later = F.col("received_at") + F.expr("interval 10 days")
    copies = marked.filter(F.pmod(F.crc32(F.col("dedup_key").cast("binary")), F.lit(7)) == 3)
    copies = copies.withColumns(
        {"received_at": later, "turn": F.least(F.col("turn") + 1, F.lit(count - 1))}
    )
    moved = copies.withColumns(
        {"occurred_at": F.col("occurred_at") - F.expr("interval 3 days"), "turn": F.lit(count - 1)}
    )
    whole = marked.unionByName(copies).unionByName(moved)
    return [whole.filter(F.col("turn") == n).drop("turn") for n in range(count)]


def import_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request per `view`; the key repeats within a user and day, which makes retries."""
    views = table(spark, folder, "events").filter(F.col("event_type") == "view")
    user = F.col("user_id")
    return views.select(
        F.concat_ws("-", F.lit("K"), user, F.date_format("ts", "yyyyMMdd")).alias(
            "idempotency_key"
        ),
        F.lit("file").alias("adapter"),
        F.lit("snapshot-1").alias("snapshot_version"),
        F.lit("operator").alias("operator"),
        user.cast("string").alias("line_id"),
        (1 + user % 3 - F.when(user % 11 == 0, 1).otherwise(0)).cast("int").alias("line_version"),
        dec(F.when(user % 13 == 0, F.col("value") + 1000).otherwise(F.floor("value"))).alias(
            "quantity"
        ),
        F.col("ts").cast("timestamp_ntz").alias("requested_at"),
    )


def import_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The backlog lines that the requests refer to; some users have none."""
    users = table(spark, folder, "events").select("user_id").distinct()
    return users.filter(F.col("user_id") % 17 != 0).select(
        F.col("user_id").cast("string").alias("line_id"),
        (1 + F.col("user_id") % 3).cast("int").alias("line_version"),
        dec(50 + F.col("user_id") % 100).alias("open_quantity"),
    )


def accepted_imports(spark: SparkSession, folder: str) -> DataFrame:
    """Requests of the first three days were accepted earlier."""
    return (
        import_requests(spark, folder)
        .filter(F.col("requested_at") < F.lit(date(2024, 1, 1) + timedelta(days=3)))
        .select("adapter", "idempotency_key", "line_id")
        .distinct()
    )
