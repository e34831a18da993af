"""Basal daily demand per pair from weighted recent, previous and seasonal windows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from replenish.functions.exprs import (
    any_of,
    bar_hash,
    count_ratio,
    dec,
    latest,
    num,
    text,
)
from replenish.functions.windows import Windows, build
from replenish.operators.scale import spread
from replenish.params import ORIGIN_ID, DemandParams
from replenish.schemas import DEMAND_ESTIMATE

PAIR = ["article_id", "branch_id"]
ROLES = ("recent", "previous", "seasonal")


@dataclass(frozen=True)
class RunIds:
    """Identity of a run; created once on the driver, never per row."""

    run_id: str
    model_version_id: str
    scope_version_id: str
    origin_id: int = ORIGIN_ID


def _reliable() -> Column:
    return (F.col("source_row_count") == 0) | (F.col("promo_adjustment_method") == "ENRICHED")


def window_stats(
    panel: DataFrame,
    scope_pairs: DataFrame,
    windows: Windows,
    params: DemandParams = DemandParams(),
    with_hashes: bool = True,
) -> DataFrame:
    """Evidence per pair: days, units and means of each window, in one pass over the panel.

    The panel is aggregated by pair first and then meets the scope; the join reuses the
    partitioning of the aggregate. A pair without panel rows keeps zero counts.
    """
    rows = panel.filter(windows.holds(F.col("sales_date")))
    units = F.col(params.units_column)
    usable = F.col("eligible")
    nonzero = usable & (units > 0)
    measures = [
        F.count(F.lit(1)).alias("active_days"),
        F.count_if(usable).alias("eligible_days"),
        F.count_if(nonzero).alias("nonzero_days"),
        F.count_if(usable & _reliable()).alias("promo_reliable_days"),
        F.sum(F.when(nonzero, units)).alias("nonzero_units"),
        F.sum(F.when(nonzero, units * units)).alias("nonzero_squares"),
    ]
    for role, span in windows.spans.items():
        inside = span.holds(F.col("sales_date"))
        measures += [
            F.count_if(inside).alias(f"{role}_active_days"),
            F.count_if(inside & usable).alias(f"{role}_eligible_days"),
            F.sum(F.when(inside & usable, units)).alias(f"{role}_units"),
        ]
    if with_hashes:
        # One row per pair and day: the list is bounded by the window lengths.
        ordered = F.array_sort(F.collect_list(F.struct("sales_date", "source_hash")))
        measures.append(
            F.array_join(F.transform(ordered, lambda r: r["source_hash"]), "").alias(
                "feature_hashes"
            )
        )
    per_pair = rows.groupBy(*PAIR).agg(*measures)
    return _fill(scope_pairs.select(*PAIR, "supplier_id").join(per_pair, PAIR, "left"))


# Characters of the hash of a panel row (hexadecimal SHA-256).
HASH_WIDTH = 64


def dated_checksums(
    panel: DataFrame,
    scope_pairs: DataFrame,
    dates: list[date],
    ids: RunIds,
    params: DemandParams = DemandParams(),
) -> DataFrame:
    """The input checksum of every pair and business date: business_date, pair, input_checksum.

    Each pair holds its daily hashes as one run of bytes, HASH_WIDTH a day and blank where there is
    none; the windows of a date are two ranges of it, digested in place. No panel row is copied per
    date, and nothing but the checksums leaves the pair.
    """
    lengths = params.lengths
    first, last = min(dates), max(dates)
    start = build(first, **{f"{r}_days": n for r, n in lengths.items()}).seasonal.start
    total = (last - start).days
    day = F.datediff("sales_date", F.lit(start)).cast("int")
    # The dates multiply the work of a pair after this shuffle, so small partitions stay apart.
    used = panel.filter((F.col("sales_date") >= F.lit(start)) & (F.col("sales_date") < F.lit(last)))
    listed = (
        spread(used.select(*PAIR, "sales_date", "source_hash"), *PAIR)
        .groupBy(*PAIR)
        .agg(F.array_sort(F.collect_list(F.struct(day.alias("n"), F.col("source_hash").alias("h")))).alias("days"))
    )

    def gap(length: Column) -> Column:
        return F.array_repeat(F.lit(None).cast("string"), length)

    end = F.array(F.struct(F.lit(total).alias("n"), F.lit(None).cast("string").alias("h")))
    following = F.concat(F.slice("days", F.lit(2), F.size("days")), end)
    filled = F.zip_with(
        "days", following, lambda x, y: F.concat(F.array(x["h"]), gap(y["n"] - x["n"] - 1))
    )
    dense = F.concat(gap(F.col("days")[0]["n"]), F.flatten(filled))
    wide = F.transform(dense, lambda h: F.rpad(F.coalesce(h, F.lit("")), HASH_WIDTH, " "))
    listed = listed.select(*PAIR, F.array_join(wide, "").cast("binary").alias("hashes"))
    hashes = scope_pairs.select(*PAIR).join(listed, PAIR, "left")

    def checked(asked: Column) -> Column:
        spans = _dated_spans(asked, lengths)

        def part(name: str, days: int) -> Column:
            place = F.datediff(spans[name], F.lit(start)).cast("int") * HASH_WIDTH + 1
            return F.substring("hashes", place, F.lit(days * HASH_WIDTH))

        used = F.concat(
            part("seasonal_start", lengths["seasonal"]),
            part("previous_start", lengths["previous"] + lengths["recent"]),
        )
        plain = F.replace(F.coalesce(used.cast("string"), F.lit("")), F.lit(" "), F.lit(""))
        digest = bar_hash(
            F.lit(ids.scope_version_id), text("article_id"), text("branch_id"), text(asked), plain
        )
        return F.struct(asked.alias("business_date"), digest.alias("input_checksum"))

    return hashes.select(*PAIR, F.inline(F.transform(F.lit(sorted(set(dates))), checked)))


def _dated_spans(day: Column, lengths: dict[str, int]) -> dict[str, Column]:
    """The bounds of the windows of a business date; see `windows.build`."""
    cutoff = F.date_sub(day, 1)
    ends = {"recent": cutoff, "seasonal": F.add_months(cutoff, -12)}
    ends["previous"] = F.date_sub(cutoff, lengths["recent"])
    return {
        "cutoff": cutoff,
        **{f"{r}_start": F.date_sub(ends[r], lengths[r] - 1) for r in ROLES},
        **{f"{r}_end": ends[r] for r in ROLES},
    }


def _fill(stats: DataFrame) -> DataFrame:
    """Zero counts for missing evidence; sums and means in their stored precision."""
    zero = F.lit(0).cast("bigint")
    counts = [c for c in stats.columns if c.endswith("_days")]
    filled = stats.withColumns({c: F.coalesce(F.col(c), zero) for c in counts})
    return filled.withColumns(
        {
            **{
                f"{r}_basal_units": dec(F.coalesce(F.col(f"{r}_units"), num(0)), 20, 6)
                for r in ROLES
            },
            **{
                f"{r}_mean": dec(
                    F.try_divide(
                        dec(f"{r}_units", 20, 6), F.col(f"{r}_eligible_days").cast("decimal(10,0)")
                    )
                )
                for r in ROLES
            },
        }
    ).drop(*[f"{r}_units" for r in ROLES])


def score(stats: DataFrame, params: DemandParams = DemandParams()) -> DataFrame:
    """Weights, evidence gate, estimate, diagnostics, status and confidence from the evidence."""
    weights = params.weights

    def has(role: str) -> Column:
        return F.col(f"{role}_eligible_days") > 0

    available = sum(
        (F.when(has(r), num(weights[r])).otherwise(num(0)) for r in ROLES[1:]),
        F.when(has("recent"), num(weights["recent"])).otherwise(num(0)),
    )
    counted = stats.withColumns(
        {
            "available_weight": dec(available),
            "total_window_eligible_days": sum(
                (F.col(f"{r}_eligible_days") for r in ROLES[1:]), F.col("recent_eligible_days")
            ),
        }
    )
    gated = counted.withColumn(
        "is_blocked",
        any_of(
            F.col("recent_eligible_days") < params.minimum_recent_eligible_days,
            F.col("total_window_eligible_days") < params.minimum_total_eligible_days,
            F.col("available_weight") == 0,
        ),
    )
    weighted = gated.withColumns(
        {
            f"{r}_weight": F.when(
                ~F.col("is_blocked") & has(r),
                dec(F.try_divide(num(weights[r]), F.col("available_weight")), 8, 6),
            ).otherwise(num(0, 8, 6))
            for r in ROLES
        }
    )

    def part(role: str) -> Column:
        return F.coalesce(F.col(f"{role}_mean"), num(0)) * F.col(f"{role}_weight")

    n = F.col("nonzero_days").cast("double")
    total = F.col("nonzero_units").cast("double")
    squares = F.col("nonzero_squares").cast("double")
    estimated = weighted.withColumns(
        {
            "coverage": count_ratio(F.col("eligible_days"), F.col("active_days")),
            "promo_coverage": dec(
                count_ratio(F.col("promo_reliable_days"), F.col("eligible_days")), 8, 6
            ),
            "raw_demand": F.when(
                ~F.col("is_blocked"), dec(part("recent") + part("previous") + part("seasonal"))
            ),
            "adi": F.when(
                F.col("nonzero_days") > 0,
                dec(count_ratio(F.col("eligible_days"), F.col("nonzero_days"))),
            ),
            # (sample deviation / mean)^2 over the nonzero days, from their sums.
            "cv2": F.when(
                F.col("nonzero_days") > 1,
                dec(n * (n * squares - total * total) / ((n - 1) * total * total)),
            ),
        }
    )
    no_previous = F.col("previous_eligible_days") == 0
    no_seasonal = F.col("seasonal_eligible_days") == 0
    blocked = F.col("is_blocked")
    return estimated.withColumns(
        {
            "availability_coverage": dec("coverage", 8, 6),
            "status": F.when(blocked, "BLOCKED")
            .when(F.col("raw_demand") == 0, "ZERO_VALID")
            .when(
                (F.col("coverage") < num(params.warning_coverage)) | no_previous | no_seasonal,
                "WARN",
            )
            .otherwise("OK"),
            "method_code": F.when(blocked, "INSUFFICIENT_DATA")
            .when(no_previous & no_seasonal, "SKU_BRANCH_RECENT")
            .otherwise("SKU_BRANCH_WEIGHTED"),
            "fallback_level": F.when(blocked, 9)
            .when(no_previous & no_seasonal, 2)
            .when(no_seasonal, 1)
            .otherwise(0)
            .cast("smallint"),
            "confidence_score": dec(
                F.least(num(100), F.greatest(num(0), F.col("coverage") * 100)), 5, 2
            ),
            "basal_daily_demand": F.col("raw_demand"),
        }
    ).drop("coverage", "nonzero_units", "nonzero_squares")


def input_checksum(ids: RunIds, business_date: Column) -> Column:
    return bar_hash(
        F.lit(ids.scope_version_id), text("article_id"), text("branch_id"),
        text(business_date), F.coalesce("feature_hashes", F.lit("")),
    )


def estimate(
    panel: DataFrame,
    scope_pairs: DataFrame,
    windows: Windows,
    ids: RunIds,
    params: DemandParams = DemandParams(),
    created_at: datetime | None = None,
) -> DataFrame:
    """The estimate of one business date in the stored layout; blocked pairs included."""
    stats = window_stats(panel, scope_pairs, windows, params)
    dated = stats.withColumns(_spans({windows.business_date: windows}, F.lit(windows.business_date)))
    return _stored(dated, ids, params, created_at)


def estimates(
    panel: DataFrame,
    scope_pairs: DataFrame,
    dates: list[date],
    ids: RunIds,
    params: DemandParams = DemandParams(),
    created_at: datetime | None = None,
) -> DataFrame:
    """The estimates of many business dates, each as `estimate` gives it.

    Evidence comes from running totals, checksums from slices of one array a pair.
    """
    totals = rolling_totals(panel, scope_pairs, dates, [params.units_column], params)
    stats = (
        of_units(totals, params.units_column)
        .join(dated_checksums(panel, scope_pairs, dates, ids, params), ["business_date", *PAIR])
        .join(scope_pairs.select(*PAIR, "supplier_id"), PAIR)
    )
    spans = _dated_spans(F.col("business_date"), params.lengths)
    return _stored(stats.withColumns(spans), ids, params, created_at)


def _spans(windows: dict[date, Windows], day: Column) -> dict[str, Column]:
    """The bounds of the windows of a business date, looked up by it."""

    def of(value: Callable[[Windows], date]) -> Column:
        pairs = [F.lit(x) for d, w in windows.items() for x in (d, value(w))]
        return F.create_map(*pairs)[day]

    return {
        "business_date": day,
        "cutoff": of(lambda w: w.cutoff),
        **{f"{r}_start": of(lambda w, r=r: w.spans[r].start) for r in ROLES},
        **{f"{r}_end": of(lambda w, r=r: w.spans[r].end) for r in ROLES},
    }


def _stored(
    stats: DataFrame, ids: RunIds, params: DemandParams, created_at: datetime | None
) -> DataFrame:
    if "input_checksum" not in stats.columns:
        stats = stats.withColumn("input_checksum", input_checksum(ids, F.col("business_date")))
    ready = score(stats, params).withColumns(
        {
            "run_id": F.lit(ids.run_id),
            "model_version_id": F.lit(ids.model_version_id),
            "scope_version_id": F.lit(ids.scope_version_id),
            "origin_id": F.lit(ids.origin_id),
            "lookback_start": F.col("seasonal_start"),
            "lookback_end": F.col("cutoff"),
            "explanation": F.struct(
                F.col("cutoff").alias("cutoff_date"),
                F.col("available_weight"),
                F.lit(params.minimum_recent_eligible_days).alias("minimum_recent_eligible_days"),
                F.lit(params.minimum_total_eligible_days).alias("minimum_total_eligible_days"),
            ),
            "created_at": F.lit(created_at or datetime.now()).cast("timestamp_ntz"),
        }
    )
    return ready.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DEMAND_ESTIMATE])


def status_counts(estimates: DataFrame) -> DataFrame:
    return estimates.groupBy("status", "method_code", "fallback_level").agg(
        F.count(F.lit(1)).alias("pairs"),
        F.sum(F.coalesce("basal_daily_demand", num(0))).alias("total_daily_demand"),
    )


def rolling_totals(
    panel: DataFrame,
    scope_pairs: DataFrame,
    dates: list[date],
    unit_columns: list[str],
    params: DemandParams = DemandParams(),
) -> DataFrame:
    """Evidence of every pair and business date, each seeing only days before it.

    Running totals per pair are read off at the window edges: a window is the difference of two
    running totals. The panel is shuffled once by pair and is not repeated per date or per unit
    column; the work per date is six edge values per pair. A pair has one panel row per day, which
    bounds its group. Measures of a unit column are named `<column>__<measure>`.
    """
    spark = panel.sparkSession
    edges = []
    for day in dates:
        windows = build(day, **{f"{r}_days": n for r, n in params.lengths.items()})
        if windows.seasonal.end >= windows.previous.start:
            raise ValueError("the seasonal window overlaps the recent ones")
        for role, span in windows.spans.items():
            edges.append((span.start - timedelta(days=1), day, role, -1))
            edges.append((span.end, day, role, 1))
    edge_days = sorted({e[0] for e in edges})
    usable = F.col("eligible")
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    measures = {
        "active_days": one,
        "eligible_days": F.when(usable, one).otherwise(none),
        "promo_reliable_days": F.when(usable & _reliable(), one).otherwise(none),
    }
    for name in unit_columns:
        units = F.col(name)
        nonzero = usable & (units > 0)
        measures |= {
            f"{name}__nonzero_days": F.when(nonzero, one).otherwise(none),
            f"{name}__units": F.when(usable, units).otherwise(num(0)),
            f"{name}__all_units": F.coalesce(units, num(0)),
            f"{name}__squares": F.when(nonzero, dec(units * units, 28, 6)).otherwise(
                dec(F.lit(0), 28, 6)
            ),
        }
    rows = panel.filter(
        F.col("sales_date").between(F.lit(edge_days[0]), F.lit(edge_days[-1]))
    ).select(*PAIR, "sales_date", F.lit(0).alias("is_edge"),
             *[m.alias(n) for n, m in measures.items()])
    marks = scope_pairs.select(*PAIR, F.explode(F.lit(edge_days)).alias("sales_date")).select(
        *PAIR, "sales_date", F.lit(1).alias("is_edge"),
        *[F.lit(0).cast(rows.schema[n].dataType).alias(n) for n in measures],
    )
    so_far = (
        Window.partitionBy(*PAIR)
        .orderBy("sales_date", "is_edge")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = (
        rows.unionByName(marks)
        .select(*PAIR, "sales_date", "is_edge", *[F.sum(n).over(so_far).alias(n) for n in measures])
        .filter(F.col("is_edge") == 1)
    )
    # Six rows per requested date.
    edge_frame = F.broadcast(
        spark.createDataFrame(edges, "sales_date date, business_date date, role string, sign int")
    )
    signed = totals.join(edge_frame, "sales_date")

    def window_sum(name: str, role: str | None = None) -> Column:
        value = F.col(name) * F.col("sign")
        return F.sum(value if role is None else F.when(F.col("role") == role, value))

    sums = [window_sum(n).alias(n) for n in ("active_days", "eligible_days", "promo_reliable_days")]
    for role in ROLES:
        sums += [
            window_sum(n, role).alias(f"{role}_{n}") for n in ("active_days", "eligible_days")
        ]
    for name in unit_columns:
        own = f"{name}__"
        sums += [
            window_sum(own + "nonzero_days").alias(own + "nonzero_days"),
            window_sum(own + "units").alias(own + "nonzero_units"),
            window_sum(own + "squares").alias(own + "nonzero_squares"),
            window_sum(own + "all_units", "recent").alias(own + "recent_all_units"),
            *[window_sum(own + "units", r).alias(f"{own}{r}_units") for r in ROLES],
        ]
    return signed.groupBy(*PAIR, "business_date").agg(*sums)


def of_units(totals: DataFrame, name: str) -> DataFrame:
    """Evidence by one unit column of `rolling_totals`, as `score` takes it."""
    own = f"{name}__"
    return _fill(
        totals.withColumns({c.removeprefix(own): F.col(c) for c in totals.columns if c.startswith(own)})
    )


def rolling(
    panel: DataFrame,
    scope_pairs: DataFrame,
    dates: list[date],
    params: DemandParams = DemandParams(),
) -> DataFrame:
    """Estimates for many business dates in one pass; see `rolling_totals`."""
    totals = rolling_totals(panel, scope_pairs, dates, [params.units_column], params)
    return score(of_units(totals, params.units_column), params)


def trailing_mean(panel: DataFrame, days: int = 28, units: str = "observed_units") -> DataFrame:
    """Comparator: plain mean of the `days` panel rows before each day, eligible or not."""
    before = (
        Window.partitionBy(*PAIR).orderBy("sales_date").rowsBetween(-days, -1)
    )
    return panel.select(
        "sales_date",
        *PAIR,
        dec(
            F.try_divide(
                dec(F.sum(units).over(before), 20, 6),
                F.count(F.lit(1)).over(before).cast("decimal(10,0)"),
            )
        ).alias("trailing_mean"),
    )


def network_fallback(estimates: DataFrame, minimum_branches: int = 3) -> DataFrame:
    """Optional and plainer than `network_shrinkage`: give a blocked pair the mean estimate of the
    same article in other branches.

    Not part of the default run. Pairs whose article has fewer than `minimum_branches` usable
    estimates stay blocked. A borrowed estimate is always a warning.
    """
    peers = (
        estimates.filter(F.col("status").isin("OK", "WARN"))
        .groupBy("business_date", "run_id", "article_id")
        .agg(
            F.count(F.lit(1)).alias("peer_branches"),
            F.sum("basal_daily_demand").alias("peer_total"),
        )
        .filter(F.col("peer_branches") >= minimum_branches)
    )
    joined = estimates.join(peers, ["business_date", "run_id", "article_id"], "left")
    borrow = (F.col("status") == "BLOCKED") & F.col("peer_branches").isNotNull()
    mean = dec(F.try_divide(F.col("peer_total"), F.col("peer_branches").cast("decimal(10,0)")))
    changed = {
        "raw_demand": F.when(borrow, mean).otherwise(F.col("raw_demand")),
        "basal_daily_demand": F.when(borrow, mean).otherwise(F.col("basal_daily_demand")),
        "method_code": F.when(borrow, "SKU_NETWORK_MEAN").otherwise(F.col("method_code")),
        "fallback_level": F.when(borrow, F.lit(3).cast("smallint")).otherwise(
            F.col("fallback_level")
        ),
        "status": F.when(borrow, "WARN").otherwise(F.col("status")),
    }
    return joined.withColumns(changed).select(*estimates.columns)


def window_evidence(
    panel: DataFrame, windows: Windows, params: DemandParams = DemandParams()
) -> DataFrame:
    """Eligible days of the windows with their units and squares, per pair that has any."""
    units = F.col(params.units_column)
    return (
        panel.filter(windows.holds(F.col("sales_date")) & F.col("eligible"))
        .groupBy(*PAIR)
        .agg(
            F.count(F.lit(1)).alias("evidence_days"),
            F.sum(units).cast("double").alias("evidence_units"),
            F.sum(units * units).cast("double").alias("evidence_squares"),
        )
    )


def network_shrinkage(
    estimates: DataFrame, evidence: DataFrame, minimum_branches: int = 3
) -> DataFrame:
    """Optional: give a blocked pair its own daily mean, shrunk towards that of its article.

    The usable branches of an article give its mean, the variance of days within a branch and, by
    the sums of squares of an analysis of variance, the variance between branches. The own mean
    counts with between / (between + within / days): little where there are few days or where
    branches are alike, and nothing without a day. One pass of sums per article; not part of the
    default run. Pairs whose article has fewer than `minimum_branches` usable branches stay blocked.
    A shrunk estimate is always a warning.
    """
    keys = ["business_date", "run_id", "article_id"]
    known = estimates.join(evidence, PAIR, "left")
    n, s, q = (F.col(f"evidence_{x}") for x in ("days", "units", "squares"))
    peers = (
        known.filter(F.col("status").isin("OK", "WARN") & (n > 0))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("peers"),
            F.sum(n).cast("double").alias("n"),
            F.sum(n * n).cast("double").alias("n2"),
            F.sum(s).alias("s"),
            F.sum(q).alias("q"),
            F.sum(s * s / n).alias("r"),
        )
        .filter(F.col("peers") >= max(minimum_branches, 2))
    )
    apart = F.col("peers") - 1
    within = F.coalesce(
        F.greatest(F.try_divide(F.col("q") - F.col("r"), F.col("n") - F.col("peers")), F.lit(0.0)), F.lit(0.0)
    )
    spread_ = (F.col("r") - F.col("s") * F.col("s") / F.col("n")) / apart - F.col("within")
    between = F.greatest(spread_ / ((F.col("n") - F.col("n2") / F.col("n")) / apart), F.lit(0.0))
    articles = peers.withColumn("within", within).select(
        *keys, (F.col("s") / F.col("n")).alias("article_mean"), "within", between.alias("between")
    )
    joined = known.join(articles, keys, "left")
    own = F.when(
        (n > 0) & (F.col("between") > 0), F.col("between") / (F.col("between") + F.col("within") / n)
    ).otherwise(F.lit(0.0))
    value = dec(own * F.coalesce(s / n, F.lit(0.0)) + (F.lit(1.0) - own) * F.col("article_mean"))
    borrow = (F.col("status") == "BLOCKED") & F.col("article_mean").isNotNull()
    changed = {
        "raw_demand": F.when(borrow, value).otherwise(F.col("raw_demand")),
        "basal_daily_demand": F.when(borrow, value).otherwise(F.col("basal_daily_demand")),
        "method_code": F.when(borrow, "SKU_NETWORK_SHRINKAGE").otherwise(F.col("method_code")),
        "fallback_level": F.when(borrow, F.lit(3).cast("smallint")).otherwise(
            F.col("fallback_level")
        ),
        "status": F.when(borrow, "WARN").otherwise(F.col("status")),
    }
    return joined.withColumns(changed).select(*estimates.columns)


def newest_estimates(estimates: DataFrame) -> DataFrame:
    """One estimate per date and pair: the newest by creation time, then by run id."""
    kept = [c for c in estimates.columns if c not in ("business_date", *PAIR)]
    return (
        estimates.groupBy("business_date", *PAIR)
        .agg(latest(F.struct(*kept), "created_at", "run_id").alias("row"))
        .select("business_date", *PAIR, "row.*")
        .select(*estimates.columns)
    )
