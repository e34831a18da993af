"""The distributable universe: origin articles, destination pairs, manifest and versions."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenish.functions.exprs import (
    all_of,
    bar_hash,
    bar_text,
    latest,
    text,
    text_or_blank,
)
from replenish.operators.scale import materialise
from replenish.params import ScopeRule

# Groups of the scope checksum: a task digests one group, never the whole scope.
DIGEST_GROUPS = 4096
# Rows of a scope whose ordered text may be digested as a whole (about 40 bytes a row).
ORDERED_ROWS = 1_000_000


def _origin_rows(rule: ScopeRule) -> Column:
    return (F.col("branch_id") == rule.origin_id) & (F.col("active_for_purchase") == 1)


def _pair_rows(rule: ScopeRule) -> Column:
    return all_of(
        F.col("route_code") == rule.route_code,
        F.col("supply_mode") == rule.supply_mode,
        F.col("enabled") == 1,
        F.col("active_for_sale") == 1,
        F.col("active_on_mix") == 1,
        F.col("branch_id") != rule.origin_id,
    )


def origin_articles(catalog: DataFrame, rule: ScopeRule = ScopeRule()) -> DataFrame:
    """Articles the origin may buy, one row each, with the supplier of the newest extraction.

    Of extractions at the same time the lowest supplier counts, so that the choice does not depend
    on row order.
    """
    return latest_origin_articles(catalog, rule).select(
        "article_id", F.col("supplier_id").alias("origin_supplier_id")
    )


def latest_origin_articles(catalog: DataFrame, rule: ScopeRule = ScopeRule()) -> DataFrame:
    """The newest extraction row of every origin article."""
    kept = ["supplier_id", "active_for_purchase", "enabled", "active_for_sale", "active_on_mix",
            "extracted_at"]
    return (
        catalog.filter(_origin_rows(rule))
        .groupBy("article_id")
        .agg(latest(F.struct(*kept), "extracted_at", -F.col("supplier_id")).alias("row"))
        .select("article_id", "row.*")
    )


def pair_details(catalog: DataFrame, rule: ScopeRule = ScopeRule()) -> DataFrame:
    """The newest qualifying catalog row of every pair, with the supplier inherited if missing."""
    kept = ["supplier_id", "route_code", "supply_mode", "enabled", "active_for_sale",
            "active_on_mix", "extracted_at"]
    newest = (
        catalog.filter(_pair_rows(rule))
        .groupBy("article_id", "branch_id")
        .agg(latest(F.struct(*kept), "extracted_at", -F.col("supplier_id")).alias("row"))
        .select("article_id", "branch_id", "row.*")
    )
    # Both sides are small aggregates of unique keys by now; adaptive execution picks the join.
    return newest.join(origin_articles(catalog, rule), "article_id").select(
        "article_id",
        "branch_id",
        F.coalesce("supplier_id", "origin_supplier_id").alias("supplier_id"),
        *[c for c in kept if c != "supplier_id"],
    )


def pairs(catalog: DataFrame, rule: ScopeRule = ScopeRule()) -> DataFrame:
    """Distributable (article, branch) pairs with their supplier."""
    return pair_details(catalog, rule).select("article_id", "branch_id", "supplier_id")


def stock_scope(catalog: DataFrame, rule: ScopeRule = ScopeRule()) -> DataFrame:
    """Pairs whose stock is normalised: all destinations and the origin itself."""
    articles = origin_articles(catalog, rule).select("article_id")
    destinations = (
        catalog.filter(_pair_rows(rule))
        .select("article_id", "branch_id")
        .distinct()
        .join(articles, "article_id", "left_semi")
    )
    at_origin = articles.withColumn("branch_id", F.lit(rule.origin_id))
    # The two parts cannot overlap (the origin is no destination) and each is distinct.
    return destinations.unionByName(at_origin)


def _article_line() -> Column:
    return bar_text(
        text("article_id"), text_or_blank("supplier_id"), text("active_for_purchase"),
        text_or_blank("enabled"), text_or_blank("active_for_sale"), text_or_blank("active_on_mix"),
    )


def _pair_line() -> Column:
    return bar_text(
        text("branch_id"), text("article_id"), text_or_blank("supplier_id"), text("route_code"),
        text("supply_mode"), text("enabled"), text("active_for_sale"), text("active_on_mix"),
    )


def ordered_digest(order: list[str], line: Column) -> Column:
    """Aggregate: SHA-256 of the lines joined with LF in `order`."""
    rows = F.array_sort(F.collect_list(F.struct(*order, line.alias("line"))))
    return F.sha2(F.array_join(F.transform(rows, lambda r: r["line"]), "\n"), 256)


def grouped_digest(rows: DataFrame, key: list[str], line: Column) -> DataFrame:
    """SHA-256 over the digests of `DIGEST_GROUPS` groups of lines, at every size the same way.

    The group is a number from the MD5 of the key, so other systems can repeat it; a group is
    ordered by key, the groups by their number.
    """
    named = F.md5(bar_text(*[text(c) for c in key]))
    group = (F.conv(F.substring(named, 1, 4), 16, 10).cast("int") % DIGEST_GROUPS).alias("part")
    grouped = rows.groupBy(group).agg(ordered_digest(key, line).alias("digest"))
    return grouped.agg(ordered_digest(["part"], F.col("digest")).alias("digest"))


def whole_digest(rows: DataFrame, key: list[str], line: Column) -> DataFrame:
    """SHA-256 of all lines in the order of the key, joined with LF."""
    return rows.agg(ordered_digest(key, line).alias("digest"))


def manifest(catalog: DataFrame, rule: ScopeRule = ScopeRule()) -> DataFrame:
    """One row of counts and checksums that identify a scope."""
    return _manifest(latest_origin_articles(catalog, rule), pair_details(catalog, rule), grouped_digest)


def ordered_manifest(
    catalog: DataFrame, rule: ScopeRule = ScopeRule(), most_rows: int = ORDERED_ROWS
) -> DataFrame:
    """The manifest with checksums over one ordered text, as stored manifests have them.

    SHA-256 reads its text from front to back, so one task holds it; a scope of more than
    `most_rows` rows is refused and has `manifest` only.
    """
    articles = materialise(latest_origin_articles(catalog, rule))
    details = materialise(pair_details(catalog, rule))
    rows = max(articles.count(), details.count())
    if rows > most_rows:
        raise ValueError(f"{rows} rows are too many for one ordered text; use manifest")
    return _manifest(articles, details, whole_digest)


def _manifest(
    articles: DataFrame, details: DataFrame, digest: Callable[[DataFrame, list[str], Column], DataFrame]
) -> DataFrame:

    def branch(rows: DataFrame, **values: Column) -> DataFrame:
        empty = {
            "article_count": "bigint", "pair_count": "bigint", "destination_count": "bigint",
            "routed_article_count": "bigint", "source_as_of_ts": "timestamp_ntz",
            "article_checksum": "string", "pair_checksum": "string",
        }
        return rows.select(
            *[values.get(n, F.lit(None)).cast(t).alias(n) for n, t in empty.items()]
        )

    article_counts = articles.agg(
        F.count(F.lit(1)).alias("rows"), F.max("extracted_at").alias("as_of")
    )
    pair_counts = details.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("branch_id").alias("branches"),
        F.count_distinct("article_id").alias("articles"),
        F.max("extracted_at").alias("as_of"),
    )
    parts = [
        branch(article_counts, article_count=F.col("rows"), source_as_of_ts=F.col("as_of")),
        branch(
            pair_counts, pair_count=F.col("rows"), destination_count=F.col("branches"),
            routed_article_count=F.col("articles"), source_as_of_ts=F.col("as_of"),
        ),
        branch(digest(articles, ["article_id"], _article_line()),
               article_checksum=F.col("digest")),
        branch(digest(details, ["branch_id", "article_id"], _pair_line()),
               pair_checksum=F.col("digest")),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    merged = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    return merged.withColumn(
        "scope_checksum", scope_checksum(F.col("article_checksum"), F.col("pair_checksum"))
    )


def scope_checksum(article_checksum: Column, pair_checksum: Column) -> Column:
    return F.sha2(
        F.concat(F.lit("articles:"), article_checksum, F.lit("|pairs:"), pair_checksum), 256
    )


def write_manifest(catalog: DataFrame, path: str, rule: ScopeRule = ScopeRule()) -> None:
    """The manifest as one JSON document with sorted field names."""
    row = manifest(catalog, rule)
    row.select(*sorted(row.columns)).coalesce(1).write.mode("overwrite").json(path)


def resolve_version(
    previous: Mapping[str, object] | None, current: Mapping[str, object], rule: ScopeRule
) -> dict[str, object]:
    """Keep the version id while checksum, rule and origin stay the same; else issue a new one."""
    rule_key = f"{rule.origin_id}|{rule.route_code}|{rule.supply_mode}"
    same = (
        previous is not None
        and previous["scope_checksum"] == current["scope_checksum"]
        and previous["rule"] == rule_key
    )
    return {
        "scope_version_id": previous["scope_version_id"] if same else str(uuid.uuid4()),
        "version_no": previous["version_no"] if same
        else (1 if previous is None else int(previous["version_no"]) + 1),
        "scope_checksum": current["scope_checksum"],
        "rule": rule_key,
        "is_new": not same,
    }


def article_snapshot(
    catalog: DataFrame, scope_version_id: str, rule: ScopeRule = ScopeRule()
) -> DataFrame:
    """Immutable article rows of a scope version."""
    return latest_origin_articles(catalog, rule).select(
        F.lit(scope_version_id).alias("scope_version_id"),
        "article_id",
        "supplier_id",
        (F.col("active_for_purchase") == 1).alias("active_for_purchase"),
        (F.col("enabled") == 1).alias("enabled"),
        (F.col("active_for_sale") == 1).alias("active_for_sale"),
        (F.col("active_on_mix") == 1).alias("active_on_mix"),
        F.sha2(_article_line(), 256).alias("source_row_hash"),
    )


def pair_snapshot(
    catalog: DataFrame, scope_version_id: str, rule: ScopeRule = ScopeRule()
) -> DataFrame:
    """Immutable pair rows of a scope version."""
    return pair_details(catalog, rule).select(
        F.lit(scope_version_id).alias("scope_version_id"),
        F.lit(rule.origin_id).alias("origin_id"),
        "branch_id",
        "article_id",
        "supplier_id",
        "route_code",
        "supply_mode",
        (F.col("enabled") == 1).alias("enabled"),
        (F.col("active_for_sale") == 1).alias("active_for_sale"),
        (F.col("active_on_mix") == 1).alias("active_on_mix"),
        bar_hash(_pair_line()).alias("source_row_hash"),
    )


def diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Pairs with how they changed between two scopes: ADDED, REMOVED, CHANGED or SAME."""
    old = before.select("article_id", "branch_id", F.col("supplier_id").alias("old_supplier"),
                        F.lit(True).alias("in_old"))
    new = after.select("article_id", "branch_id", F.col("supplier_id").alias("new_supplier"),
                       F.lit(True).alias("in_new"))
    return old.join(new, ["article_id", "branch_id"], "full_outer").select(
        "article_id",
        "branch_id",
        "old_supplier",
        "new_supplier",
        F.when(F.col("in_old").isNull(), "ADDED")
        .when(F.col("in_new").isNull(), "REMOVED")
        .when(~F.col("old_supplier").eqNullSafe(F.col("new_supplier")), "CHANGED")
        .otherwise("SAME")
        .alias("change"),
    )


def variation(before: DataFrame, after: DataFrame) -> DataFrame:
    """How many pairs, articles and branches each kind of change touches."""
    return diff(before, after).groupBy("change").agg(
        F.count(F.lit(1)).alias("pairs"),
        F.count_distinct("article_id").alias("articles"),
        F.count_distinct("branch_id").alias("branches"),
    )
