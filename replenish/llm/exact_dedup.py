"""Exact deduplication in three steps: inside each input partition, per salt of a digest, globally.

Two texts are equal when they agree after all white space of `SPACES` is removed; null counts as
empty. Groups are keyed by digest and full content, so every step compares whole contents. The
salt, a hash of the key, spreads the copies of one text over many tasks; what leaves a salt is one
row. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenish.llm.common import SPACES, col, fresh
from replenish.operators.scale import materialise

SALTS = 32


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), SPACES, "")


def _preference(points: Column, key: Column) -> Column:
    """Larger for more code points, then for the smaller key; a null key comes last.

    One fixed-width number, so that the aggregation stays a hash aggregation.
    """
    from_key = F.lit(str(2**63)).cast("decimal(20,0)") - key.cast("decimal(20,0)")
    weight = F.lit(str(2**65)).cast("decimal(20,0)") * points.cast("decimal(10,0)")
    return (weight + F.coalesce(from_key, F.lit(0))).cast("decimal(38,0)")


def winners(docs: DataFrame, key: str, text: str, salts: int = SALTS) -> DataFrame:
    """One row per distinct content: text_sha256, keep_id, keep_points (code points of the text that
    stays), group_size."""
    content = docs.select(
        col(key).cast("bigint").alias("id"),
        normalised(col(text)).alias("content"),
        F.length(F.coalesce(col(text).cast("string"), F.lit(""))).alias("points"),
    )
    rows = content.select(
        F.sha2("content", 256).alias("text_sha256"),
        F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"),
        "content",
        "id",
        "points",
        _preference(F.col("points"), F.col("id")).alias("preference"),
    )
    salted = rows.groupBy("text_sha256", "salt", "content").agg(
        F.max_by("id", "preference").alias("id"),
        F.max("points").alias("points"),
        F.max("preference").alias("preference"),
        F.count(F.lit(1)).alias("copies"),
    )
    merged = salted.groupBy("text_sha256", "content").agg(
        F.max_by("id", "preference").alias("keep_id"),
        F.max("points").alias("keep_points"),
        F.sum("copies").alias("group_size"),
    )
    return merged.select("text_sha256", "keep_id", "keep_points", "group_size")


def _checked(found: DataFrame) -> DataFrame:
    """Rows go back to their group by digest, which is right as long as no two contents share one;
    should that ever happen, the job fails instead of merging different texts."""
    clash = F.raise_error(F.lit("two different texts share a SHA-256 digest"))
    return (
        found.groupBy("text_sha256")
        .agg(
            F.count(F.lit(1)).alias("contents"),
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
        )
        .withColumn("group_size", F.when(F.col("contents") > 1, clash).otherwise(F.col("group_size")))
        .drop("contents")
    )


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in its original text stays, then the one with
    the smallest key; null keys come last. Rows that repeat the key and the text of the winner are
    dropped but for one. An empty table gives no rows.
    """
    # Written, so that both sides of the join below are plain and its hot digests can be split.
    found = materialise(_checked(winners(docs, key, text, salts)))
    rows = (
        docs.select(
            col(key).cast("bigint").alias("doc_id"),
            F.sha2(normalised(col(text)), 256).alias("text_sha256"),
        )
        # Repeated rows of one key travel as a count.
        .groupBy("doc_id", "text_sha256")
        .agg(F.count(F.lit(1)).alias("repeats"))
    )
    placed = rows.join(found, "text_sha256")
    return placed.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.explode(F.sequence(F.lit(1).cast("bigint"), "repeats")).alias("repeat"),
        "text_sha256",
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("repeat") == 1)).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of `docs` that stay, with the columns of `docs`; see `groups`.

    The join back is by key and digest, so a text with many copies is no hot key.
    """
    digest, points = fresh(docs, "text_sha256"), fresh(docs, "keep_points")
    keep, own = fresh(docs, "keep_key"), fresh(docs, "own_key")
    # Written first: the shuffled contents behind it go before whole rows are shuffled.
    kept = materialise(
        winners(docs, key, text, salts).select(
            F.col("text_sha256").alias(digest),
            F.col("keep_id").alias(keep),
            F.col("keep_points").alias(points),
        )
    )
    tagged = docs.withColumn(digest, F.sha2(normalised(col(text)), 256)).withColumn(
        own, col(key).cast("bigint")
    )
    same = (
        (tagged[digest] == kept[digest])
        & tagged[own].eqNullSafe(kept[keep])
        & (F.length(F.coalesce(col(text).cast("string"), F.lit(""))) == kept[points])
    )
    return (
        tagged.join(kept, same, "left_semi").dropDuplicates([own, digest]).select(*map(col, docs.columns))
    )
