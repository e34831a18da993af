"""Automatic and directed needs, stock-out risk and rounding."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenish.functions.exprs import codes, dec, num
from replenish.operators.scale import running_around
from replenish.params import MANDATORY_TYPES, ORIGIN_ID, RiskParams


def risk(params: RiskParams = RiskParams()) -> Column:
    """Stock-out risk 0..100 from net stock, coverage and the pair's own parameters."""
    cover = F.col("coverage_days")
    return (
        F.when(F.col("net_stock") <= 0, params.no_stock)
        .when(cover < F.col("lead_time_days"), params.below_lead_time)
        .when(cover <= F.col("lead_time_days") * 2, params.below_twice_lead_time)
        .when(cover < F.col("target_stock_days"), params.below_target)
        .when(cover.isNotNull(), params.covered)
    )


def round_up(quantity: Column, unit: Column) -> Column:
    """Next whole multiple of the logistic unit; the quantity itself where there is no unit."""
    usable = F.when(unit > 0, unit)
    return F.coalesce(dec(F.ceil(F.try_divide(quantity, usable)) * usable), dec(quantity))


def automatic(
    positions: DataFrame,
    rounding: DataFrame | None = None,
    risk_params: RiskParams = RiskParams(),
    origin_id: int = ORIGIN_ID,
) -> DataFrame:
    """Demand need (D, mandatory) and overstock need (S, optional) of every position.

    Zero demand yields zero needs, a blocked position yields rows without quantities.
    `rounding` may hold `article_id` and `units_per_package`; the calculated quantity is kept.
    """
    rows = positions
    if rounding is not None:
        rows = rows.join(
            rounding.select("article_id", F.col("units_per_package").alias("rounding_unit")),
            "article_id", "left",
        )
    else:
        rows = rows.withColumn("rounding_unit", F.lit(None).cast("decimal(18,6)"))
    blocked = F.col("calculation_status") == "BLOCKED"
    zero_demand = F.col("calculation_status") == "ZERO_PDVB"
    net = F.col("net_stock")
    d = F.when(zero_demand, num(0)).when(
        ~blocked, dec(F.greatest(F.col("maximum_stock") - net, num(0, 19, 6)))
    )
    room = F.col("maximum_stock") + F.col("overstock_quantity") - F.greatest(net, num(0))
    with_d = rows.withColumns({"risk_score": F.when(~blocked & ~zero_demand, risk(risk_params)),
                               "d_quantity": d})
    s = F.when(zero_demand, num(0)).when(
        ~blocked, dec(F.greatest(room - F.col("d_quantity"), num(0, 21, 6)))
    )
    lines = with_d.withColumn(
        "need",
        F.explode(
            F.array(
                F.struct(F.lit("D").alias("need_type"), F.lit(True).alias("is_mandatory"),
                         F.col("d_quantity").alias("calculated_quantity")),
                F.struct(F.lit("S").alias("need_type"), F.lit(False).alias("is_mandatory"),
                         s.alias("calculated_quantity")),
            )
        ),
    )
    shown = lines.select(
        "business_date", F.lit(origin_id).alias("origin_id"), "branch_id", "article_id",
        "supplier_id", "need.*", "rounding_unit", "risk_score",
        F.col("calculation_status").alias("position_status"), "alert_codes",
    )
    calculated = F.col("calculated_quantity")
    return shown.withColumns(
        {
            "rounded_quantity": round_up(calculated, F.col("rounding_unit")),
            "calculation_status": F.when(F.col("position_status") == "BLOCKED", "BLOCKED")
            .when(calculated == 0, "ZERO")
            .otherwise("CALCULATED"),
            "alert_codes": F.array_union(
                "alert_codes", codes((F.col("position_status") == "ZERO_PDVB", "ZERO_PDVB"))
            ),
        }
    ).drop("position_status")


def summary(needs: DataFrame) -> DataFrame:
    """Totals of a run by need type and status, with its warnings."""
    return needs.groupBy("need_type", "is_mandatory", "calculation_status").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("calculated_quantity").alias("quantity"),
        F.count_if(F.size("alert_codes") > 0).alias("warnings"),
    )


def automatic_balance(needs: DataFrame, pipeline: DataFrame) -> DataFrame:
    """Open automatic quantity: the rounded need minus what is already under way, subtracted once.

    `pipeline` has one row per pair with `pipeline_quantity`. D is served before S.
    """
    joined = needs.join(
        pipeline.select("article_id", "branch_id", "pipeline_quantity"),
        ["article_id", "branch_id"], "left",
    )
    under_way = F.coalesce("pipeline_quantity", num(0))
    d_size = F.coalesce("d_rounded", num(0))
    rest = F.when(F.col("need_type") == "D", under_way).otherwise(
        F.greatest(under_way - d_size, num(0, 19, 6))
    )
    # The D row of the pair, two rows per pair and date in all.
    d_rows = needs.filter(F.col("need_type") == "D").select(
        "business_date", "article_id", "branch_id", F.col("rounded_quantity").alias("d_rounded")
    )
    return joined.join(d_rows, ["business_date", "article_id", "branch_id"], "left").withColumn(
        "open_quantity",
        F.when(
            F.col("calculation_status") != "BLOCKED",
            dec(F.greatest(F.col("rounded_quantity") - rest, num(0, 20, 6))),
        ),
    ).drop("pipeline_quantity", "d_rounded")


def directed_balance(lines: DataFrame, as_of: date | None = None) -> DataFrame:
    """Open quantity and status of directed lines; past validity an open line counts as expired."""
    original, prepared, cancelled = (
        F.col("original_quantity"), F.col("prepared_quantity"), F.col("cancelled_quantity")
    )
    open_quantity = dec(F.greatest(original - prepared - cancelled, num(0, 20, 6)))
    balanced = lines.withColumn("open_quantity", open_quantity)
    status = (
        F.when((F.col("open_quantity") == 0) & (cancelled > 0), "CANCELLED")
        .when(F.col("open_quantity") == 0, "FULFILLED")
        .when(F.col("open_quantity") < original, "PARTIAL")
        .otherwise("OPEN")
    )
    balanced = balanced.withColumns(
        {
            "line_status": status,
            "is_mandatory": F.col("need_type").isin(*MANDATORY_TYPES),
        }
    )
    if as_of is None:
        return balanced
    return balanced.withColumn(
        "is_expired",
        F.coalesce(F.col("valid_to") < F.lit(as_of), F.lit(False)) & (F.col("open_quantity") > 0),
    )


def commitment_class(target: Column, as_of: date, due_soon_days: int = 3) -> Column:
    days = F.datediff(target, F.lit(as_of))
    return (
        F.when(days < 0, "OVERDUE").when(days <= due_soon_days, "DUE_SOON").when(
            days.isNotNull(), "LATER"
        )
    )


def validate(
    lines: DataFrame,
    articles: DataFrame,
    branches: DataFrame,
    key: list[str],
    suppliers: DataFrame | None = None,
    items: DataFrame | None = None,
) -> DataFrame:
    """Directed lines with the reasons to reject them; an accepted line has none.

    Duplicates are counted per key and flagged, whichever row came first. With `suppliers` a named
    supplier has to be known; with `items` the `unit` of a line has to be the base unit of its article.
    """
    known_articles = articles.select("article_id").distinct().withColumn("known_article", F.lit(1))
    known_branches = branches.select("branch_id").distinct().withColumn("known_branch", F.lit(1))
    copies = lines.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    checked = (
        lines.join(known_articles, "article_id", "left")
        .join(known_branches, "branch_id", "left")
        .join(copies, key, "left")
    )
    none = F.lit(False)
    unknown_supplier, other_unit = none, none
    if suppliers is not None:
        known = suppliers.select("supplier_id").distinct().withColumn("known_supplier", F.lit(1))
        checked = checked.join(known, "supplier_id", "left")
        unknown_supplier = F.col("supplier_id").isNotNull() & F.col("known_supplier").isNull()
    if items is not None:
        checked = checked.join(items.select("article_id", "base_unit").distinct(), "article_id", "left")
        other_unit = F.col("base_unit").isNotNull() & ~F.col("unit").eqNullSafe(F.col("base_unit"))
    return checked.withColumn(
        "reject_codes",
        codes(
            (F.col("known_article").isNull(), "UNKNOWN_ARTICLE"),
            (F.col("known_branch").isNull(), "UNKNOWN_BRANCH"),
            (~F.coalesce(F.col("original_quantity") > 0, F.lit(False)), "INVALID_QUANTITY"),
            (F.col("valid_to") < F.col("valid_from"), "INVALID_VALIDITY"),
            (F.col("copies") > 1, "SOURCE_DUPLICATE"),
            (unknown_supplier, "UNKNOWN_SUPPLIER"),
            (other_unit, "INVALID_UNIT"),
        ),
    ).drop("known_article", "known_branch", "copies", "known_supplier", "base_unit")


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    clean = F.size("reject_codes") == 0
    return checked.filter(clean), checked.filter(~clean)


def duplicate_candidates(lines: DataFrame) -> DataFrame:
    """Lines that overlap in time with another line of the same type, reference and pair.

    In order of start a line is compared with the furthest end before it and the next start after
    it; no pairs are formed, so a reference with very many lines stays cheap. Lines are only
    flagged, never merged. `conflicts_with` names one earlier overlapping line.
    """
    group = ["need_type", "reference", "branch_id", "article_id"]
    far = F.lit(date(9999, 12, 31))
    dated = lines.withColumn("until", F.coalesce("valid_to", far))
    both = running_around(
        dated,
        group,
        [F.col("valid_from"), F.col("line_id")],
        before={"reach": ("max", F.struct("until", "line_id"))},
        after={"next_start": ("min", F.col("valid_from"))},
    )
    overlaps_earlier = F.coalesce(F.col("reach.until") >= F.col("valid_from"), F.lit(False))
    overlaps_later = F.coalesce(F.col("next_start") <= F.col("until"), F.lit(False))
    return (
        both.withColumns(
            {
                "overlaps_earlier": overlaps_earlier,
                "overlaps_later": overlaps_later,
                "conflicts_with": F.when(overlaps_earlier, F.col("reach.line_id")),
            }
        )
        .filter(F.col("overlaps_earlier") | F.col("overlaps_later"))
        .drop("until", "reach", "next_start")
    )


def versions_with_validity(history: DataFrame, key: str, state: list[str]) -> DataFrame:
    """Version history with the end of validity and the state before each change.

    The next and the previous version of a key are the neighbours in the order of their numbers;
    the numbers need not be consecutive, but are unique within a key. A key of many versions spreads
    over many tasks.
    """
    told = history.select(
        key, "version", "changed_at", F.to_json(F.struct(*state)).alias("after_state")
    )
    # The neighbours are the largest earlier and the smallest later number with their values.
    near = running_around(
        told, [key], [F.col("version")],
        {"earlier": ("max", F.struct("version", "after_state"))},
        {"later": ("min", F.struct("version", "changed_at"))},
    )
    return near.withColumns(
        {"before_state": F.col("earlier.after_state"), "superseded_at": F.col("later.changed_at")}
    ).drop("earlier", "later")
