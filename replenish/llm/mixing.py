"""Mixing sources to target weights by Pareto order sampling.

Targets. The sources, by code point with null last, weigh 1, 2, 3, repeating, and share all words.
A target stops at `MAX_COPIES` times the words of its source; the excess goes to the others by
weight. That is one common level: target = min(cap, level * weight).

Copies. Inside a source a document of length class c is expected min(MAX_COPIES, level * 2**c)
times, with the level at which the expected words are the target; a class spans a factor of 16 in
words, so longer documents are preferred mildly. The whole part of the expectation is certain. For
the rest p, documents are ranked by the odds of a random number over the odds of p, and the first
ones are taken until the words that are missing are reached. The size is fixed in words, not in
documents: the prefix that fits is taken, then at most `CLOSING` documents of a source get one copy
more or less, each the one that brings the words nearest to the target.

Random numbers are hashes of the key, so reruns agree. Only words and keys move; the order inside
a source is built from range partitions, so a large source is no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from replenish.llm.common import col, fresh, word_count
from replenish.operators.scale import global_rank, look_up, materialise, running_before

MAX_COPIES = 3
WEIGHTS = 3
SEED = "mix"
CLOSING = 3


def _narrow(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    size = word_count(col(text).cast("string"))
    return materialise(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            col(key).cast("bigint").alias("doc_id"),
            col(source).isNull().alias("unnamed"),
            F.coalesce(col(source).cast("string"), F.lit("")).alias("source"),
            F.md5(F.coalesce(col(text).cast("string"), F.lit("")).cast("binary")).alias("text_key"),
            size.alias("size"),
            # Number of binary digits of the size, four to a class.
            F.floor((F.length(F.bin(size)) - 1) / 4).cast("int").alias("length_class"),
        )
    )


def source_targets(sizes: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """`sizes` (unnamed, source, source_size) with place (1..n by code point) and target added."""
    named = global_rank(sizes, [F.col("unnamed"), F.col("source")], "place")
    weighed = named.withColumn("weight", (F.col("place") - 1) % WEIGHTS + 1).withColumn(
        "cap", F.col("source_size") * max_copies
    )
    # By the level at which a source reaches its cap.
    order = [F.col("cap").cast("double") / F.col("weight"), F.col("place")]
    stood = materialise(
        running_before(
            weighed,
            [],
            order,
            {"caps_before": ("sum", F.col("cap")), "weights_before": ("sum", F.col("weight"))},
        ).fillna(0, ["caps_before", "weights_before"])
    )
    words, weights = stood.agg(F.sum("source_size"), F.sum("weight")).first()
    if not words:
        return stood.select("unnamed", "source", "source_size", "place", F.lit(0.0).alias("target"))
    level = (F.lit(words) - F.col("caps_before")).cast("double") / (
        F.lit(weights) - F.col("weights_before")
    )
    judged = stood.withColumn("capped", F.col("cap") <= level * F.col("weight"))
    caps, free = judged.agg(
        F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)),
        F.sum(F.when(~F.col("capped"), F.col("weight")).otherwise(0)),
    ).first()
    shared = F.lit(float(words - caps) / free if free else 0.0) * F.col("weight")
    return judged.select(
        "unnamed",
        "source",
        "source_size",
        "place",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(shared).alias("target"),
    )


def _expected(narrow: DataFrame, max_copies: int) -> DataFrame:
    """Per source and length class: certain copies, chance of one more, and of its source the
    target, its size, place and the words that chance has to fill."""
    by = ["unnamed", "source"]
    classes = materialise(narrow.groupBy(*by, "length_class").agg(F.sum("size").alias("words")))
    targets = source_targets(
        classes.groupBy(*by).agg(F.sum("words").alias("source_size")), max_copies
    )
    rows = classes.join(targets, by).withColumn(
        "preference", F.expr("shiftleft(1L, length_class)")
    )
    from_largest = Window.partitionBy("place").orderBy(F.col("length_class").desc())
    larger = from_largest.rowsBetween(Window.unboundedPreceding, -1)
    rest = from_largest.rowsBetween(0, Window.unboundedFollowing)
    missing = F.col("target") - F.col("full_before") * max_copies
    rows = (
        rows.withColumn("full_before", F.coalesce(F.sum("words").over(larger), F.lit(0)))
        .withColumn("share", F.sum(F.col("words") * F.col("preference")).over(rest))
        .withColumn("level", F.when(F.col("share") > 0, missing / F.col("share")).otherwise(0.0))
        .withColumn("full", F.col("level") * F.col("preference") >= max_copies)
    )
    # The level of the largest class that is not full holds for all below it.
    whole = Window.partitionBy("place")
    first = F.max_by("level", F.when(~F.col("full"), F.col("length_class"))).over(whole)
    rows = rows.withColumn(
        "copies",
        F.when(F.col("full"), F.lit(float(max_copies))).otherwise(
            F.least(first * F.col("preference"), F.lit(float(max_copies)))
        ),
    ).withColumn("certain", F.floor("copies").cast("bigint"))
    return rows.withColumn("chance", F.col("copies") - F.col("certain")).withColumn(
        "missing", F.col("target") - F.sum(F.col("certain") * F.col("words")).over(whole)
    ).select(
        *by, "length_class", "place", "source_size", "target", "certain", "chance", "missing"
    )


def _uniform(key: Column, text_key: Column) -> Column:
    """A number inside (0, 1) from 48 bits of a hash."""
    name = F.concat_ws("|", F.lit(SEED), F.coalesce(key.cast("string"), F.lit("")), text_key)
    bits = F.conv(F.substring(F.md5(name.cast("binary")), 1, 12), 16, 10).cast("bigint")
    return (bits + 0.5) / float(1 << 48)


def _closer(rows: DataFrame, max_copies: int) -> DataFrame:
    """Gives the one document per source one copy more or less that brings the words of the source
    nearest to its target, if that is nearer than they are. The rows stay the same."""
    gaps = rows.groupBy("place").agg(
        (F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap")
    )
    open_ = look_up(rows, materialise(gaps), ["place"])
    more = F.when(F.col("gap") > 0, 1).otherwise(-1)
    off = F.abs(F.col("gap") - more * F.col("size"))
    best = (
        open_.filter((F.col("copies") + more).between(0, max_copies) & (off < F.abs("gap")))
        .groupBy("place")
        .agg(
            F.min(
                F.struct(off.alias("off"), "u", "doc_id", "text_key", "row", more.alias("more"))
            ).alias("best")
        )
        .select("place", F.col("best.row").alias("turned"), F.col("best.more").alias("more"))
    )
    moved = look_up(rows, materialise(best), ["place"])
    turned = F.when(F.col("row") == F.col("turned"), F.col("more")).otherwise(0)
    return materialise(
        moved.withColumn("copies", F.col("copies") + turned).drop("turned", "more")
    )


def _sampled(
    docs: DataFrame, key: str, source: str, text: str, max_copies: int
) -> DataFrame:
    narrow = _narrow(docs, key, source, text)
    table = materialise(_expected(narrow, max_copies))
    rows = look_up(narrow, table, ["unnamed", "source", "length_class"])
    u = _uniform(F.col("doc_id"), F.col("text_key"))
    rows = materialise(rows.drop("length_class").withColumn("u", u))
    chosen = (F.col("chance") > 0) & (F.col("size") > 0)
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("chance") / (1 - F.col("chance")))
    ranked = running_before(
        rows.filter(chosen).withColumn("odds", odds),
        ["place"],
        [F.col("odds"), F.col("doc_id"), F.col("text_key"), F.col("row")],
        {"before": ("sum", F.col("size"))},
    ).fillna(0, ["before"])
    fits = (F.col("before") + F.col("size") <= F.col("missing")).cast("bigint")
    kept = ["row", "u", "doc_id", "text_key", "place", "unnamed", "source", "size", "source_size", "target"]
    drawn = ranked.select(*kept, (F.col("certain") + fits).alias("copies"))
    others = rows.filter(~chosen).select(*kept, F.col("certain").alias("copies"))
    found = materialise(drawn.union(others))
    for _ in range(CLOSING):
        found = _closer(found, max_copies)
    return found


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """One row per row of `docs`: doc_id, size, source_size, target, taken (words, repeats counted)
    and copies.

    A null text has size 0 and is taken 0 words; null sources are one source of their own. Rows
    that repeat a key and a text share their random number and follow each other. An empty table
    gives no rows.
    """
    return _sampled(docs, key, source, text, max_copies).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def mixed_documents(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """The rows of the mix with the columns of `docs`: a document that is taken n times is there n
    times. Rows that repeat key, source and text are the same document with its copies added up.
    Documents without words are not part of a mix."""
    found = _sampled(docs, key, source, text, max_copies).filter("copies > 0 and size > 0")
    by = ["doc_id", "text_key", "unnamed", "source"]
    names = {n: fresh(docs, f"mix_{n}") for n in [*by, "copies", "turn"]}
    per = found.groupBy(*[F.col(n).alias(names[n]) for n in by]).agg(
        F.sum("copies").alias(names["copies"])
    )
    tagged = docs.withColumns(
        {
            names["doc_id"]: col(key).cast("bigint"),
            names["text_key"]: F.md5(F.coalesce(col(text).cast("string"), F.lit("")).cast("binary")),
            names["unnamed"]: col(source).isNull(),
            names["source"]: F.coalesce(col(source).cast("string"), F.lit("")),
        }
    )
    once = tagged.dropDuplicates([names[n] for n in by])
    same = once[names["doc_id"]].eqNullSafe(per[names["doc_id"]])
    for n in by[1:]:
        same &= once[names[n]] == per[names[n]]
    repeated = once.join(per, same).withColumn(
        names["turn"], F.explode(F.sequence(F.lit(1).cast("bigint"), col(names["copies"])))
    )
    return repeated.select(*map(col, docs.columns))
