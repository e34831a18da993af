"""Consolidated backlog: lines per pair, priority, attribution and search."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replenish.functions.exprs import bar_hash, codes, dec, num, text, text_or_blank
from replenish.operators import logistics
from replenish.operators.needs import commitment_class
from replenish.operators.scale import global_rank, look_up, running_before
from replenish.params import MANDATORY_TYPES, NEED_TYPES, OPTIONAL_TYPES, ORIGIN_ID
from replenish.sources import files

LINE = ["business_date", "origin_id", "branch_id", "article_id", "supplier_key"]
NO_SUPPLIER = -1


def automatic_sources(needs: DataFrame) -> DataFrame:
    """Open D and S needs in the common source layout."""
    return needs.filter(F.col("open_quantity") > 0).select(
        "business_date", "origin_id", "branch_id", "article_id", "supplier_id", "need_type",
        F.concat_ws("-", "need_type", "article_id", "branch_id").alias("source_id"),
        "open_quantity",
        F.col("business_date").alias("need_date"),
        F.lit(None).cast("date").alias("target_date"),
        F.col("risk_score").cast("int").alias("risk_score"),
    )


def directed_sources(
    balanced: DataFrame, business_date: date, scope_pairs: DataFrame, origin_id: int = ORIGIN_ID
) -> DataFrame:
    """Open E, C and A lines valid on the date; the pair's supplier stands in for a missing one."""
    live = balanced.filter(
        (F.col("status") == "ACTIVE")
        & (F.col("open_quantity") > 0)
        & (F.col("valid_from") <= F.lit(business_date))
        & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.lit(business_date)))
    )
    suppliers = scope_pairs.select(
        "article_id", "branch_id", F.col("supplier_id").alias("pair_supplier_id")
    )
    return live.join(suppliers, ["article_id", "branch_id"], "left").select(
        F.lit(business_date).alias("business_date"),
        F.lit(origin_id).alias("origin_id"),
        "branch_id", "article_id",
        F.coalesce("supplier_id", "pair_supplier_id").alias("supplier_id"),
        "need_type",
        F.col("line_id").alias("source_id"),
        "open_quantity",
        F.col("valid_from").alias("need_date"),
        "target_date",
        F.lit(None).cast("int").alias("risk_score"),
    )


def all_sources(*parts: DataFrame) -> DataFrame:
    """All need sources together, with the key that treats a missing supplier as one value."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.withColumn("supplier_key", F.coalesce("supplier_id", F.lit(NO_SUPPLIER)))


def _open(kind: str) -> str:
    return f"{kind.lower()}_open_quantity"


def _total(kinds: tuple[str, ...]) -> Column:
    parts = [F.col(_open(k)) for k in kinds]
    return dec(sum(parts[1:], parts[0]))


def totals(lines: DataFrame) -> DataFrame:
    return lines.withColumns(
        {
            "mandatory_open_quantity": _total(MANDATORY_TYPES),
            "optional_open_quantity": _total(OPTIONAL_TYPES),
            "total_open_quantity": _total(NEED_TYPES),
        }
    )


def consolidate(
    sources: DataFrame,
    execution: DataFrame | None = None,
    items: DataFrame | None = None,
    positions: DataFrame | None = None,
) -> DataFrame:
    """One line per date, origin, branch, article and supplier with the five open quantities.

    `execution` holds imported and prepared totals per line key, `positions` the quantity in
    transit per pair. Lines with nothing open are left out.
    """
    committed = F.col("need_type").isin("E", "C")
    grouped = sources.groupBy(*LINE).agg(
        *[
            dec(F.coalesce(
                F.sum(F.when(F.col("need_type") == k, F.col("open_quantity"))), num(0, 28, 6)
            )).alias(_open(k))
            for k in NEED_TYPES
        ],
        F.max("risk_score").alias("risk_score"),
        F.min("need_date").alias("oldest_need_date"),
        F.min("target_date").alias("target_date"),
        F.min(F.when(committed, F.col("target_date"))).alias("commitment_date"),
        F.count(F.lit(1)).alias("source_count"),
    )
    lines = totals(grouped).filter(F.col("total_open_quantity") > 0)
    if execution is not None:
        lines = lines.join(execution, [k for k in LINE if k in execution.columns], "left")
    else:
        lines = lines.withColumns(
            {"imported_quantity": num(0), "prepared_quantity": num(0)}
        )
    if positions is not None:
        transit = positions.select(
            "business_date", "article_id", "branch_id",
            F.col("cd_in_transit").alias("in_transit_quantity"),
        )
        lines = lines.join(transit, ["business_date", "article_id", "branch_id"], "left")
    else:
        lines = lines.withColumn("in_transit_quantity", num(0))
    if items is not None:
        lines = logistics.estimate(lines, items, "total_open_quantity")
    return lines.withColumns(
        {
            **{
                c: dec(F.coalesce(F.col(c), num(0)))
                for c in ("imported_quantity", "prepared_quantity", "in_transit_quantity")
            },
            "line_id": F.concat_ws("-", "origin_id", "branch_id", "article_id", "supplier_key"),
            "input_checksum": bar_hash(
                *[text(k) for k in LINE], *[text(_open(k)) for k in NEED_TYPES],
                text_or_blank("risk_score"),
            ),
        }
    )


def freshness_status(as_of: Column, cutoff: date) -> Column:
    return (
        F.when(as_of.isNull(), "INCOMPLETE")
        .when(F.to_date(as_of) < F.lit(cutoff), "STALE")
        .otherwise("CURRENT")
    )


def priority_class(as_of: date, due_soon_days: int) -> Column:
    """1 overdue commitment, 2 commitment due soon, 3 everything else."""
    band = commitment_class(F.col("commitment_date"), as_of, due_soon_days)
    return F.when(band == "OVERDUE", 1).when(band == "DUE_SOON", 2).otherwise(3)


def prioritize(lines: DataFrame, as_of: date, due_soon_days: int = 3) -> DataFrame:
    """Position 1..n of every line of an origin, in the agreed order and without ties.

    One origin may own the whole backlog, so the ranking is spread over the ordered data. The
    priority orders the lines; it assigns no stock.
    """
    classed = lines.withColumn("priority_class", priority_class(as_of, due_soon_days))
    order = [
        F.col("priority_class"),
        F.col("risk_score").desc_nulls_last(),
        F.col("oldest_need_date").asc_nulls_last(),
        F.col("target_date").asc_nulls_last(),
        F.col("branch_id"),
        F.col("article_id"),
        F.col("supplier_key"),
        F.col("business_date"),
    ]
    return global_rank(classed, order, "priority_rank", ["origin_id"])


# The order in which prepared quantity is attributed to need sources.
ATTRIBUTION_RULE = "1"


def attribution_step(as_of: date) -> Column:
    overdue = F.coalesce(F.col("target_date") < F.lit(as_of), F.lit(False))
    kind = F.col("need_type")
    return (
        F.when((kind == "E") & overdue, 1)
        .when(kind == "E", 2)
        .when(kind == "C", 3)
        .when(kind == "D", 4)
        .when(kind == "A", 5)
        .otherwise(6)
    )


def attribute(
    sources: DataFrame, prepared: DataFrame, as_of: date, keys: list[str] | None = None
) -> DataFrame:
    """Share out the prepared quantity of each line over its sources, first come first served.

    `prepared` has one `prepared_quantity` per line key. The attributed total of a line is the
    smaller of what was prepared and what its sources hold. A line may have any number of
    sources: the running total is spread over the ordered data.
    """
    keys = keys or LINE
    ordered = sources.withColumns(
        {
            "attribution_step": attribution_step(as_of),
            "order_target": F.coalesce("target_date", F.lit(date(9999, 12, 31))),
        }
    )
    order = [F.col(c) for c in ("attribution_step", "order_target", "need_date", "source_id")]
    running = running_before(
        ordered, keys, order, {"before": ("sum", dec("open_quantity", 38, 6))}
    ).drop("order_target")
    joined = look_up(running, prepared.select(*keys, "prepared_quantity"), keys)
    left_over = F.coalesce("prepared_quantity", num(0)) - F.coalesce("before", num(0, 38, 6))
    share = F.greatest(num(0, 38, 6), F.least(F.col("open_quantity"), left_over))
    return joined.withColumns(
        {
            "allocated_quantity": dec(share),
            "attribution_rule": F.lit(ATTRIBUTION_RULE),
        }
    ).drop("before", "prepared_quantity")


@dataclass(frozen=True)
class Search:
    """Filter of the open backlog; empty fields do not restrict."""

    origin_id: int | None = None
    branches: tuple[int, ...] = ()
    suppliers: tuple[int, ...] = ()
    articles: tuple[int, ...] = ()
    need_types: tuple[str, ...] = ()
    mandatory_only: bool = False
    optional_only: bool = False
    best_rank: int | None = None
    minimum_risk: int | None = None
    target_until: date | None = None
    maximum_kg: float | None = None
    maximum_m3: float | None = None
    maximum_packages: float | None = None
    maximum_pallets: float | None = None
    complete_logistics_only: bool = False

    def condition(self) -> Column:
        keep = F.lit(True)
        if self.origin_id is not None:
            keep &= F.col("origin_id") == self.origin_id
        for column, wanted in (
            ("branch_id", self.branches), ("supplier_key", self.suppliers),
            ("article_id", self.articles),
        ):
            if wanted:
                keep &= F.col(column).isin(*wanted)
        if self.need_types:
            any_type = F.lit(False)
            for kind in self.need_types:
                any_type |= F.col(_open(kind)) > 0
            keep &= any_type
        if self.mandatory_only:
            keep &= F.col("mandatory_open_quantity") > 0
        if self.optional_only:
            keep &= F.col("optional_open_quantity") > 0
        if self.best_rank is not None:
            keep &= F.col("priority_rank") <= self.best_rank
        if self.minimum_risk is not None:
            keep &= F.col("risk_score") >= self.minimum_risk
        if self.target_until is not None:
            keep &= F.col("target_date") <= F.lit(self.target_until)
        for column, limit in (
            ("estimated_weight_kg", self.maximum_kg), ("estimated_volume_m3", self.maximum_m3),
            ("estimated_packages", self.maximum_packages),
            ("estimated_pallets", self.maximum_pallets),
        ):
            if limit is not None:
                keep &= F.col(column) <= limit
        if self.complete_logistics_only:
            keep &= ~F.col("logistics_data_missing")
        return keep


def numbered(ranked: DataFrame, wanted: Search) -> DataFrame:
    """The matching lines with their position among the matches, in priority order."""
    matching = ranked.filter(wanted.condition())
    return global_rank(matching, [F.col("priority_rank"), F.col("line_id")], "position")


def page_of(positions: DataFrame, page: int, page_size: int) -> DataFrame:
    if page < 1 or page_size < 1:
        raise ValueError("page and page size start at 1")
    first = (page - 1) * page_size + 1
    return positions.filter(F.col("position").between(first, first + page_size - 1))


def search(ranked: DataFrame, wanted: Search, page: int = 1, page_size: int = 100) -> DataFrame:
    """One page of the matching lines in priority order."""
    return page_of(numbered(ranked, wanted), page, page_size)


class Snapshots:
    """Backlogs kept by version under one folder, so that all pages and totals of a search see the
    same lines. The matches of a filter are numbered when its first page is asked for; other pages
    read their range, which the file statistics narrow down to few row groups."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def add(self, version: str, ranked: DataFrame) -> None:
        """A version is written once and never changed."""
        ranked.write.parquet(f"{self.root}/{version}/lines")

    def lines(self, version: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{version}/lines")

    def _positions(self, version: str, wanted: Search) -> DataFrame:
        name = hashlib.sha256(repr(wanted).encode()).hexdigest()[:16]
        path = f"{self.root}/{version}/search-{name}"
        if not files.exists(self.spark, f"{path}/_SUCCESS"):
            found = numbered(self.lines(version), wanted)
            found.repartitionByRange("position").sortWithinPartitions("position").write.mode(
                "overwrite"
            ).parquet(path)
        return self.spark.read.parquet(path)

    def search(
        self, version: str, wanted: Search, page: int = 1, page_size: int = 100
    ) -> DataFrame:
        found = page_of(self._positions(version, wanted), page, page_size)
        return found.withColumn("snapshot_version", F.lit(version))

    def totals(self, version: str, wanted: Search) -> DataFrame:
        return search_totals(self.lines(version), wanted).withColumn(
            "snapshot_version", F.lit(version)
        )


def search_totals(ranked: DataFrame, wanted: Search) -> DataFrame:
    """Informative totals of the matching lines."""
    return ranked.filter(wanted.condition()).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("total_open_quantity").alias("units"),
        F.sum("mandatory_open_quantity").alias("mandatory_units"),
        F.sum("optional_open_quantity").alias("optional_units"),
        F.sum("estimated_packages").alias("packages"),
        F.sum("estimated_pallets").alias("pallets"),
        F.sum("estimated_weight_kg").alias("kg"),
        F.sum("estimated_volume_m3").alias("m3"),
    )


def top_priorities(ranked: DataFrame, k: int = 5) -> DataFrame:
    return ranked.orderBy("priority_rank").limit(k)


def run_difference(before: DataFrame, after: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Lines that differ between two runs, with the names of the changed columns."""
    old = before.select(*keys, F.struct(*values).alias("old"))
    new = after.select(*keys, F.struct(*values).alias("new"))
    joined = old.join(new, keys, "full_outer")
    changed = codes(*[(~F.col(f"old.{v}").eqNullSafe(F.col(f"new.{v}")), v) for v in values])
    return (
        joined.withColumns(
            {
                "change": F.when(F.col("old").isNull(), "ADDED")
                .when(F.col("new").isNull(), "REMOVED")
                .otherwise("CHANGED"),
                "changed_columns": changed,
            }
        )
        .filter((F.col("change") != "CHANGED") | (F.size("changed_columns") > 0))
    )


def alerts(lines: DataFrame, as_of: date, due_soon_days: int = 3, idle_days: int = 2) -> DataFrame:
    """Alert codes of every line; lines without an alert drop out."""
    band = commitment_class(F.col("commitment_date"), as_of, due_soon_days)
    idle = F.datediff(F.lit(as_of), F.to_date("last_activity")) >= idle_days
    found = codes(
        (F.col("risk_score") >= 100, "STOCKOUT"),
        ((F.col("risk_score") >= 90) & (F.col("risk_score") < 100), "CRITICAL_COVERAGE"),
        (band == "OVERDUE", "COMMITMENT_OVERDUE"),
        (band == "DUE_SOON", "COMMITMENT_DUE"),
        (F.col("freshness_status") != "CURRENT", "STALE_DATA"),
        (
            (F.col("imported_quantity") > 0) & (F.col("prepared_quantity") == 0) & idle,
            "IMPORT_WITHOUT_PROGRESS",
        ),
        (
            (F.col("prepared_quantity") > 0)
            & (F.col("prepared_quantity") < F.col("imported_quantity")),
            "PARTIAL_PREPARATION",
        ),
        (F.col("last_status") == "UNKNOWN", "UNKNOWN_EXTERNAL_STATUS"),
        (F.col("prepared_quantity") > F.col("imported_quantity"), "INVALID_DIFFERENCE"),
    )
    return lines.withColumn("alert_code", F.explode(found))


def reference_alerts(duplicates: DataFrame) -> DataFrame:
    """An alert for every line that `needs.duplicate_candidates` found."""
    return duplicates.select("line_id", F.lit("DUPLICATE_REFERENCE").alias("alert_code"))


def panel_kpis(lines: DataFrame, as_of: date, due_soon_days: int = 3) -> DataFrame:
    """Key figures of the operating panel."""
    band = commitment_class(F.col("commitment_date"), as_of, due_soon_days)
    return lines.groupBy("origin_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("risk_score") >= 100).alias("lines_at_risk"),
        F.count_if(band == "OVERDUE").alias("overdue_commitments"),
        F.count_if(band == "DUE_SOON").alias("due_commitments"),
        F.count_if(
            (F.col("prepared_quantity") > 0)
            & (F.col("prepared_quantity") < F.col("imported_quantity"))
        ).alias("partial_lines"),
        F.count_if((F.col("imported_quantity") > 0) & (F.col("prepared_quantity") == 0)).alias(
            "lines_without_progress"
        ),
        F.count_if(F.col("logistics_data_missing")).alias("missing_logistics"),
    )
