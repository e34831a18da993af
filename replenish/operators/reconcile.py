"""Row by row comparison of two versions of a table through trees of digests.

A row's leaf is a prefix of the hash of its keys, and a node of the tree holds the number and the
sum of the digests of the rows under it. Two trees are compared from the top: only the children of
nodes that differ are looked at, and only rows of leaves that differ are put side by side. Equal
rows are therefore read once, for their digest, and never leave their task. A tree that is written
with its version can be compared again without reading the rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenish.functions.exprs import col, digest_number
from replenish.operators.scale import keep_matching, materialise

# A leaf has about so many rows; every level of the tree has so many bits more than the one above.
LEAF_ROWS = 1_000
FAN_BITS = 6
MAX_LEVELS = 7


def _prefix(keys: list[str], bits: int) -> Column:
    """The first `bits` bits (1 to 63) of the hash of the keys. NULL keys have a place, too."""
    return F.shiftrightunsigned(F.xxhash64(*[col(k) for k in keys]), 64 - bits)


def _digest(columns: list[str]) -> Column:
    """A number for a whole row. The names of the fields tell NULL from an empty text, and a bar in
    a text from the end of it."""
    return digest_number(F.to_json(F.struct(*[col(c) for c in columns])))


@dataclass(frozen=True)
class Tree:
    """`nodes` is a written table: level, prefix, rows, digest. Leaves have level `levels`."""

    nodes: DataFrame
    levels: int

    def at(self, level: int) -> DataFrame:
        return self.nodes.filter(F.col("level") == level).drop("level")


def levels_for(rows: int) -> int:
    """The levels of a tree whose leaves have about LEAF_ROWS rows."""
    bits = math.log2(max(rows / LEAF_ROWS, 1))
    return min(max(math.ceil(bits / FAN_BITS), 1), MAX_LEVELS)


def tree(rows: DataFrame, keys: list[str], values: list[str], levels: int) -> Tree:
    """One aggregate that combines on the map side; what is shuffled are nodes, not rows."""
    depth = levels * FAN_BITS
    leaves = materialise(
        rows.select(_prefix(keys, depth).alias("leaf"), _digest([*keys, *values]).alias("digest"))
        .groupBy("leaf")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("digest").alias("digest"))
    )
    nodes = (
        leaves.withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(levels))))
        .groupBy(
            "level", F.expr(f"shiftrightunsigned(leaf, {FAN_BITS} * ({levels} - level))").alias("prefix")
        )
        .agg(F.sum("rows").alias("rows"), F.sum("digest").alias("digest"))
    )
    return Tree(materialise(nodes), levels)


def differing_leaves(one: Tree, other: Tree) -> DataFrame:
    """The prefixes of the leaves that differ. Below an equal node nothing is compared."""
    if one.levels != other.levels:
        raise ValueError("the trees have different levels")
    open_ = None
    for level in range(1, one.levels + 1):
        sides = [one.at(level), other.at(level)]
        if open_ is not None:
            parent = F.shiftrightunsigned("prefix", FAN_BITS).alias("parent")
            sides = [
                keep_matching(s.select("*", parent), open_, ["parent"]).drop("parent") for s in sides
            ]
        # A node that only one side has, or has otherwise, is not there twice with equal totals.
        found = (
            reduce(DataFrame.unionByName, sides)
            .groupBy("prefix", "rows", "digest")
            .agg(F.count(F.lit(1)).alias("sides"))
            .filter("sides < 2")
        )
        open_ = materialise(found.select(F.col("prefix").alias("parent")).distinct())
        if open_.isEmpty():
            break
    return open_.select(F.col("parent").alias("leaf"))


def suspects(rows: DataFrame, keys: list[str], levels: int, leaves: DataFrame) -> DataFrame:
    """The rows of `rows` in the given leaves: a map-side filter while these are few."""
    tagged = rows.withColumn("_leaf", _prefix(keys, levels * FAN_BITS))
    return keep_matching(tagged, leaves.select(F.col("leaf").alias("_leaf")), ["_leaf"]).drop("_leaf")


def differences(
    source: DataFrame, stage: DataFrame, keys: list[str], values: list[str]
) -> DataFrame:
    """Keys that are missing on one side or differ in a value or in their number of rows: the keys,
    source and stage (structs of the values; of the least row where a key repeats), source_rows,
    stage_rows and difference.

    NULL keys are compared like others, and repeated keys by all their rows. Both sides are read
    twice at most: pass written tables. Columns of `stage` are cast to the types of `source`.
    """
    types = dict(source.dtypes)
    source = source.select(*keys, *values)
    stage = stage.select(*[F.col(c).cast(types[c]).alias(c) for c in [*keys, *values]])
    levels = levels_for(source.count())
    trees = [tree(side, keys, values, levels) for side in (source, stage)]
    leaves = differing_leaves(*trees)
    sides = [
        suspects(side, keys, levels, leaves).select(
            *keys,
            F.lit(name).alias("side"),
            F.struct(*values).alias("row"),
            _digest([*keys, *values]).alias("digest"),
        )
        for name, side in (("source", source), ("stage", stage))
    ]

    def of(name: str, value: str) -> Column:
        return F.when(F.col("side") == name, F.col(value))

    both = sides[0].unionByName(sides[1]).groupBy(*keys).agg(
        F.min(of("source", "row")).alias("source"),
        F.min(of("stage", "row")).alias("stage"),
        F.count(of("source", "digest")).alias("source_rows"),
        F.count(of("stage", "digest")).alias("stage_rows"),
        F.sum(of("source", "digest")).alias("source_digest"),
        F.sum(of("stage", "digest")).alias("stage_digest"),
    )
    return (
        both.withColumn(
            "difference",
            F.when(F.col("stage_rows") == 0, "MISSING_IN_STAGE")
            .when(F.col("source_rows") == 0, "MISSING_IN_SOURCE")
            .when(
                (F.col("source_rows") != F.col("stage_rows"))
                | (F.col("source_digest") != F.col("stage_digest")),
                "DIFFERENT",
            ),
        )
        .filter(F.col("difference").isNotNull())
        .drop("source_digest", "stage_digest")
    )
