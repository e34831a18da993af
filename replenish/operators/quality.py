"""Row invariants, scope gates and run controls, all reported in one issue layout."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenish.functions.exprs import num
from replenish.operators.scale import duplicate_keys
from replenish.params import ScopeRule

# Severities from the least to the most serious.
SEVERITIES = ("INFO", "WARN", "ERROR", "BLOCKER")


@dataclass(frozen=True)
class Rule:
    """An invariant: `holds` is true (or unknown) for a sound row; `shows` names the columns that
    an issue quotes as evidence."""

    code: str
    severity: str
    holds: Column
    shows: tuple[str, ...] = ()


def violations(
    rows: DataFrame, rules: list[Rule], entity: str, keys: list[str], day: str | None = None
) -> DataFrame:
    """One issue per broken rule and row; all rules are checked in a single pass."""
    def told(rule: Rule) -> Column:
        shown = [n for n in rule.shows if n in rows.columns]
        evidence = F.to_json(F.struct(*shown)) if shown else F.lit("{}")
        return F.struct(
            F.lit(rule.severity).alias("severity"),
            F.lit(rule.code).alias("code"),
            F.lit(rule.code.replace("_", " ").capitalize()).alias("detail"),
            evidence.alias("evidence"),
        )

    found = F.array_compact(
        F.array(*[F.when(~F.coalesce(r.holds, F.lit(True)), told(r)) for r in rules])
    )

    def or_null(name: str, kind: str) -> Column:
        return (F.col(name) if name in rows.columns else F.lit(None)).cast(kind).alias(name)

    business_date = F.col(day).cast("date") if day else F.lit(None).cast("date")
    return rows.withColumn("issue", F.explode(found)).select(
        business_date.alias("business_date"),
        or_null("article_id", "int"),
        or_null("branch_id", "int"),
        F.col("issue.severity").alias("severity"),
        F.col("issue.code").alias("issue_code"),
        F.lit(entity).alias("entity_type"),
        F.to_json(F.struct(*keys)).alias("entity_key"),
        F.col("issue.detail").alias("detail"),
        F.col("issue.evidence").alias("evidence"),
        *_unresolved(),
    )


def _unresolved() -> list[Column]:
    return [
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.lit(None).cast("string").alias("resolved_by"),
    ]


def resolve(issues: DataFrame, decisions: DataFrame) -> DataFrame:
    """Issues with who settled them and when. `decisions` has entity_type, entity_key, issue_code,
    resolved_at and resolved_by, one row per issue; issues without one stay open."""
    key = ["entity_type", "entity_key", "issue_code"]
    return (
        issues.drop("resolved_at", "resolved_by")
        .join(decisions.select(*key, "resolved_at", "resolved_by"), key, "left")
        .select(*issues.columns)
    )


def _near(a: Column, b: Column, tolerance: str = "0.001") -> Column:
    return F.abs(a - b) <= num(tolerance)


def stock_rules() -> list[Rule]:
    quantity, sign = F.col("stock_quantity"), F.col("stock_sign_status")
    return [
        Rule(
            "STOCK_SIGN", "ERROR",
            ((sign == "POSITIVE") & (quantity > 0) & F.col("is_serviceable"))
            | ((sign == "ZERO") & (quantity == 0) & ~F.col("is_serviceable"))
            | ((sign == "NEGATIVE") & (quantity < 0) & ~F.col("is_serviceable")),
        ),
        Rule(
            "STOCK_DATE_PARTS", "ERROR",
            (F.year("stock_date") == F.col("source_year"))
            & (F.month("stock_date") == F.col("source_month"))
            & (F.day("stock_date") == F.col("source_day")),
        ),
        Rule("STOCK_NEGATIVE", "INFO", quantity >= 0),
    ]


def sales_rules() -> list[Rule]:
    status = F.col("availability_status")
    available = status.isin("IN_STOCK", "INFERRED_FROM_SALE")
    no_stock = F.col("stock_source_hash").isNull()
    return [
        Rule(
            "UNITS_CONSERVATION", "ERROR",
            _near(
                F.greatest(F.col("observed_units"), num(0)),
                F.col("basal_units") + F.col("promo_units"),
            ),
            ("observed_units", "basal_units", "promo_units"),
        ),
        Rule(
            "ELIGIBLE_AVAILABLE", "ERROR",
            ~F.col("eligible") | (F.col("assortment_active") & available),
        ),
        Rule("STOCK_LINEAGE", "ERROR", ~status.isin("IN_STOCK", "OUT_OF_STOCK") | ~no_stock),
        Rule("UNKNOWN_WITHOUT_STOCK", "ERROR", (status != "UNKNOWN") | no_stock),
        Rule("STOCK_UNKNOWN", "INFO", status != "UNKNOWN"),
    ]


def estimate_rules() -> list[Rule]:
    status, value = F.col("status"), F.col("basal_daily_demand")
    blocked = status == "BLOCKED"
    weights = F.col("recent_weight") + F.col("previous_weight") + F.col("seasonal_weight")

    def share(name: str) -> Column:
        return F.col(name).between(0, 1)

    return [
        Rule(
            "LOOKBACK", "BLOCKER", F.col("lookback_end") < F.col("business_date"),
            ("lookback_end", "business_date"),
        ),
        Rule(
            "DAY_COUNTS", "ERROR",
            (F.col("nonzero_days") <= F.col("eligible_days"))
            & (F.col("eligible_days") <= F.col("active_days")),
        ),
        Rule("BLOCKED_WITHOUT_VALUE", "BLOCKER", blocked == value.isNull()),
        Rule("VALUE_NOT_NEGATIVE", "BLOCKER", value >= 0, ("basal_daily_demand",)),
        Rule("ZERO_VALID", "ERROR", (status != "ZERO_VALID") | (value == 0)),
        Rule("WEIGHTS_SUM", "ERROR", blocked | (F.abs(weights - num(1)) <= num("0.00001"))),
        Rule(
            "COVERAGE_RANGE", "ERROR", share("availability_coverage") & share("promo_coverage")
        ),
        Rule("INSUFFICIENT_DATA", "WARN", ~blocked),
    ]


def backtest_rules() -> list[Rule]:
    return [
        Rule(
            "EVALUATION_DATE", "ERROR",
            F.col("evaluation_date") == F.date_add("origin_date", F.col("horizon_days")),
        ),
        Rule("HORIZON", "ERROR", F.col("horizon_days") > 0),
        Rule(
            "NOT_NEGATIVE", "ERROR",
            (F.col("absolute_error_units") >= 0) & (F.col("squared_error") >= 0)
            & (F.col("predicted_demand") >= 0),
        ),
        Rule(
            "STATUS", "ERROR", (F.col("status") == "VALID") == F.col("eligible_actual")
        ),
    ]


def need_rules() -> list[Rule]:
    kind, status = F.col("need_type"), F.col("calculation_status")
    quantities = [F.col("calculated_quantity"), F.col("rounded_quantity")]
    missing = quantities[0].isNull() & quantities[1].isNull()
    sound = (quantities[0] >= 0) & (quantities[1] >= 0)
    return [
        Rule(
            "NEED_CLASS", "ERROR",
            ((kind == "D") & F.col("is_mandatory")) | ((kind == "S") & ~F.col("is_mandatory")),
        ),
        Rule(
            "NEED_QUANTITIES", "ERROR",
            F.when(status == "BLOCKED", missing).otherwise(F.coalesce(sound, F.lit(False))),
        ),
        Rule(
            "NEED_ZERO", "ERROR",
            (status != "ZERO") | ((quantities[0] == 0) & (quantities[1] == 0)),
        ),
        Rule("NEED_BLOCKED", "WARN", status != "BLOCKED"),
    ]


def directed_rules() -> list[Rule]:
    original, prepared, cancelled, left = (
        F.col("original_quantity"), F.col("prepared_quantity"), F.col("cancelled_quantity"),
        F.col("open_quantity"),
    )
    status = F.col("line_status")
    return [
        Rule("LINE_BALANCE", "ERROR", prepared + cancelled <= original),
        Rule(
            "LINE_STATUS", "ERROR",
            ((status == "OPEN") & (left == original))
            | ((status == "PARTIAL") & (left > 0) & (left < original))
            | (status.isin("FULFILLED", "CANCELLED") & (left == 0)),
        ),
    ]


def publication_rules() -> list[Rule]:
    """A published row has its batch and its time, or neither."""
    batch, at = F.col("published_batch_id"), F.col("published_at")
    return [Rule("PUBLICATION_PAIR", "ERROR", batch.isNull() == at.isNull(), ("published_batch_id", "published_at"))]


def position_rules() -> list[Rule]:
    demand = F.col("basal_daily_demand")
    return [
        Rule(
            "POSITION_FORMULAS", "ERROR",
            _near(F.col("critical_stock"), demand * F.col("lead_time_days"))
            & _near(F.col("minimum_stock"), demand * F.col("lead_time_days") * 2)
            & _near(F.col("maximum_stock"), demand * F.col("target_stock_days"))
            & _near(F.col("overstock_quantity"), demand * F.col("overstock_days")),
        ),
        Rule("ESTIMATE_DATE", "ERROR", F.col("estimate_date") <= F.col("business_date")),
        Rule("POSITION_BLOCKED", "WARN", F.col("calculation_status") != "BLOCKED"),
    ]


def allocation_rules() -> list[Rule]:
    return [
        Rule(
            "ALLOCATION", "ERROR",
            F.col("allocated_quantity").between(num(0), F.col("open_quantity")),
        )
    ]


def import_rules() -> list[Rule]:
    return [
        Rule("IMPORT_PREPARED", "ERROR", F.col("prepared_quantity") <= F.col("imported_quantity"))
    ]


def duplicates(rows: DataFrame, keys: list[str], entity: str) -> DataFrame:
    """Keys that occur more than once, as issues."""
    return duplicate_keys(rows, keys).select(
        F.lit(None).cast("date").alias("business_date"),
        (F.col("article_id") if "article_id" in keys else F.lit(None)).cast("int").alias("article_id"),
        (F.col("branch_id") if "branch_id" in keys else F.lit(None)).cast("int").alias("branch_id"),
        F.lit("BLOCKER").alias("severity"),
        F.lit("DUPLICATE_KEY").alias("issue_code"),
        F.lit(entity).alias("entity_type"),
        F.to_json(F.struct(*keys)).alias("entity_key"),
        F.lit("Duplicate key").alias("detail"),
        F.to_json(F.struct("copies")).alias("evidence"),
        *_unresolved(),
    )


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("entity_type", "severity", "issue_code").agg(
        F.count(F.lit(1)).alias("issues")
    )


def scope_gate(variation: DataFrame, maximum_change: float = 0.1) -> DataFrame:
    """Share of pairs that a new scope adds, removes or changes, against the allowed variation."""
    counted = variation.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("change") == c, F.col("pairs"))), F.lit(0)).alias(
                c.lower()
            )
            for c in ("ADDED", "REMOVED", "CHANGED", "SAME")
        ]
    )
    old = F.col("removed") + F.col("changed") + F.col("same")
    moved = F.try_divide((F.col("added") + F.col("removed")).cast("double"), old.cast("double"))
    return counted.withColumns(
        {
            "variation": moved,
            "passes": (F.col("added") + F.col("changed") + F.col("same") > 0)
            & F.coalesce(moved <= maximum_change, F.lit(True)),
        }
    )


def scope_gates(
    candidate: DataFrame,
    in_force: DataFrame,
    rule: ScopeRule = ScopeRule(),
    maximum_change: float = 0.1,
) -> DataFrame:
    """Issues of a scope before it comes into force; it may not while one is an ERROR or worse.

    `candidate` has pair rows with route_code, supply_mode, enabled, active_for_sale and
    active_on_mix; `in_force` has the pairs of the scope now. The scope must have pairs, each once,
    each by the route of the rule, and may gain or lose at most a share of the pairs, as a whole
    (SCOPE_VARIATION) and in every branch (BRANCH_VARIATION, a warning). A branch that is new has
    no share and is reported as NEW_BRANCH.
    """
    pair = ["article_id", "branch_id"]
    routed = (
        (F.col("route_code") == rule.route_code)
        & (F.col("supply_mode") == rule.supply_mode)
        & (F.col("enabled") == 1) & (F.col("active_for_sale") == 1) & (F.col("active_on_mix") == 1)
        & (F.col("branch_id") != rule.origin_id)
    )
    route = violations(
        candidate,
        [Rule("INVALID_ROUTE", "ERROR", F.coalesce(routed, F.lit(False)), ("route_code", "supply_mode"))],
        "scope", pair,
    )
    twice = duplicates(candidate, pair, "scope")
    # Which pairs come and go, once for the branches and once for their total.
    sides = in_force.select(*pair, F.lit(1).alias("before"), F.lit(0).alias("after")).unionByName(
        candidate.select(*pair, F.lit(0).alias("before"), F.lit(1).alias("after"))
    )
    per_branch = (
        sides.groupBy(*pair).agg(F.max("before").alias("before"), F.max("after").alias("after"))
        .groupBy("branch_id")
        .agg(
            F.sum("before").alias("before"), F.sum("after").alias("after"),
            F.count_if(F.col("before") != F.col("after")).alias("moved"),
        )
    )
    whole = per_branch.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("before", "after", "moved")]
    ).withColumn("scope", F.lit("scope"))
    within = F.col("moved") <= F.col("before") * maximum_change
    told = ("before", "after", "moved")
    total = violations(
        whole,
        [
            Rule("SCOPE_EMPTY", "BLOCKER", F.col("after") > 0, told),
            Rule("SCOPE_VARIATION", "ERROR", (F.col("before") == 0) | within, told),
        ],
        "scope", ["scope"],
    )
    branches = violations(
        per_branch,
        [
            Rule("NEW_BRANCH", "WARN", F.col("before") > 0, told),
            Rule("BRANCH_VARIATION", "WARN", (F.col("before") == 0) | within, told),
        ],
        "branch", ["branch_id"],
    )
    return route.unionByName(twice).unionByName(total).unionByName(branches)


def run_controls(
    estimates: DataFrame, scope_pairs: DataFrame, previous: DataFrame | None = None,
    maximum_jump: str = "3",
) -> DataFrame:
    """Controls after a run: pairs without an estimate and estimates that jumped."""
    pair = ["article_id", "branch_id"]
    missing = violations(
        scope_pairs.join(estimates.select(*pair), pair, "left_anti"),
        [Rule("PAIR_WITHOUT_ESTIMATE", "ERROR", F.lit(False))], "estimate", pair,
    )
    if previous is None:
        return missing
    both = estimates.select("business_date", *pair, "basal_daily_demand").join(
        previous.select(*pair, F.col("basal_daily_demand").alias("previous_demand")), pair
    )
    jump = F.col("basal_daily_demand") > F.col("previous_demand") * num(maximum_jump)
    fall = F.col("basal_daily_demand") * num(maximum_jump) < F.col("previous_demand")
    return missing.unionByName(
        violations(
            both, [Rule("DEMAND_JUMP", "WARN", ~(jump | fall))], "estimate", pair, "business_date"
        )
    )


def input_controls(
    closed: DataFrame, observed: dict[str, tuple[DataFrame, str]], cutoff: date
) -> DataFrame:
    """Controls before a run: every source reaches the cutoff and none lies after it.

    `closed` has one row per source (`source`, `closed_through`); `observed` names the rows of a
    source and their date column. Days after the cutoff are counted per source and day.
    """
    late = violations(
        closed,
        [Rule("SOURCE_BEHIND_CUTOFF", "BLOCKER",
              F.coalesce(F.col("closed_through") >= F.lit(cutoff), F.lit(False)), ("closed_through",))],
        "source", ["source"], "closed_through",
    )
    for name, (rows, day) in observed.items():
        future = (
            rows.filter(F.to_date(day) > F.lit(cutoff))
            .groupBy(F.to_date(day).alias("day"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("source", F.lit(name))
        )
        late = late.unionByName(
            violations(
                future, [Rule("FUTURE_OBSERVATION", "ERROR", F.lit(False), ("rows",))],
                "source", ["source", "day"], "day",
            )
        )
    return late


def output_controls(
    estimates: DataFrame, scope_pairs: DataFrame, minimum_coverage: float = 0.9
) -> DataFrame:
    """Controls after a run: values are finite and not negative, and enough of the assortment of
    each branch has a usable estimate."""
    pair = ["article_id", "branch_id"]
    value = F.col("basal_daily_demand").cast("double")
    finite = value.isNull() | (~F.isnan(value) & (value >= 0) & (value < float("inf")))
    values = violations(
        estimates, [Rule("VALUE_NOT_FINITE", "BLOCKER", finite, ("basal_daily_demand",))],
        "estimate", pair, "business_date",
    )
    usable = estimates.filter(F.col("status") != "BLOCKED").select(*pair, F.lit(1).alias("usable"))
    share = (
        scope_pairs.select(*pair).join(usable, pair, "left").groupBy("branch_id")
        .agg((F.count("usable") / F.count(F.lit(1))).alias("coverage"))
    )
    thin = violations(
        share,
        [Rule("ASSORTMENT_COVERAGE", "WARN", F.col("coverage") >= minimum_coverage, ("coverage",))],
        "branch", ["branch_id"],
    )
    return values.unionByName(thin)
