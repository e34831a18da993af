"""Helpers that keep plans sound when one key holds a large share of the rows."""

from __future__ import annotations

import contextlib
import math
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from replenish.functions.exprs import col
from replenish.sources import files

# A broadcast side has at most so many rows and, by the width of its columns, so many bytes.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 100_000_000


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only a session on one machine may go without."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="replenish-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder, or below the folder of the run."""
    root = spark.conf.get(_RUN, None) or checkpoint_dir(spark)
    return f"{root}/replenish-{name}-{uuid.uuid4().hex}"


_RUN = "replenish.run.folder"


@contextlib.contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables of one run below one folder, which is removed when the run ends. Write
    the results of the run elsewhere before that."""
    folder = scratch(spark, "run")
    before = spark.conf.get(_RUN, None)
    spark.conf.set(_RUN, folder)
    try:
        yield folder
    finally:
        if before is None:
            spark.conf.unset(_RUN)
        else:
            spark.conf.set(_RUN, before)
        files.remove(spark, folder)


# Lets Spark remove the shuffle files of a statement when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs nothing that is already written, and every later
    step sees the same rows. Reads of the table are columnar, pruned and have true sizes, from
    which the optimizer picks its joins. The shuffle files behind the table go at once.
    """
    session, path = df.sparkSession, scratch(df.sparkSession, "table")
    before = session.conf.get(_CLEANUP, "false")
    session.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        session.conf.set(_CLEANUP, before)
    return session.read.schema(df.schema).parquet(path)


# A task that groups or sorts what was spread to it holds about so many rows.
TASK_ROWS = 2_000_000


def spread(df: DataFrame, *keys: str, rows: int = 0) -> DataFrame:
    """Spread a narrow frame over the cluster by its keys before its rows multiply. The partition
    count is fixed, so adaptive execution does not merge it back; it grows with `rows`, the rows of
    a large frame, so that no task has to spill."""
    session = df.sparkSession
    wanted = max(
        session.sparkContext.defaultParallelism,
        int(session.conf.get("spark.sql.shuffle.partitions")),
        math.ceil(rows / TASK_ROWS),
    )
    return df.repartition(wanted, *keys)


def is_even(scan: DataFrame) -> bool:
    """Whether no task that reads `scan` has more than twice the share of a core. Splits without a row
    count for nothing: a row group is read whole by one task, however many splits its file has. The
    rows are counted without a column, for Parquet from the footers."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    per_task = scan.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("rows"))
    most, total = per_task.agg(F.max("rows"), F.sum("rows")).first()
    return (most or 0) * cores <= 2 * (total or 0)


def row_bytes(df: DataFrame) -> int:
    """Bytes of a row by its column types, with Spark's own defaults for text."""
    return df._jdf.schema().defaultSize()


def is_bounded(df: DataFrame, limit: int = BROADCAST_ROWS, parts: int = 1) -> bool:
    """Whether `df`, or one of its `parts`, is small enough to broadcast. Counts all rows, one number
    per task; pass a written table, or its plan runs for the count as well."""
    return df.count() <= parts * min(limit, BROADCAST_BYTES // max(row_bytes(df), 1))


def hashed(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The side of a shuffled join that is hashed, so that the other side is not sorted and spills
    nothing. It is shuffled into partitions that are as bounded as a broadcast; beyond this the join
    is left to Spark, which sorts both sides."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.hint("shuffle_hash") if is_bounded(df, limit, partitions) else df


def keep_matching(
    large: DataFrame, keys: DataFrame, on: list[str], limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Semi-join that is a map-side filter while the key set is provably small.

    Beyond the bound the join goes through a shuffle, where adaptive execution splits skewed keys.
    """
    wanted = keys.select(*on)
    if is_bounded(wanted, limit):
        wanted = F.broadcast(wanted)
    return large.join(wanted, on, "left_semi")


# A Bloom filter has 16 bits a key in words of 64 bits, up to 16 MB; a key sets 4 bits of one word.
BLOOM_BITS_PER_KEY = 16
BLOOM_WORDS = 1 << 21
_BLOOM_PROBES = 4


@dataclass(frozen=True)
class Bloom:
    """A key set in so few bytes that every task can hold it: one row with an array of words.

    It keeps all rows whose keys are in the set and a few others, so an exact join has to follow.
    """

    words: DataFrame
    size: int
    types: dict[str, str]

    def keep(self, rows: DataFrame) -> DataFrame:
        """A filter right above the scan: one array access a row, in generated code."""
        place, mask = _bloom_bits(self.types, self.size)
        return rows.filter(F.get(self.words.scalar(), place).bitwiseAND(mask) == mask)


def _bloom_bits(types: dict[str, str], size: int) -> tuple[Column, Column]:
    """The word of a key and the bits it sets there."""
    keys = [col(k).cast(t) for k, t in types.items()]
    place = F.pmod(F.xxhash64(F.lit("word"), *keys), F.lit(size)).cast("int")
    bits, mask = F.xxhash64(F.lit("bits"), *keys), None
    for n in range(_BLOOM_PROBES):
        at = F.shiftrightunsigned(bits, 6 * n).bitwiseAND(F.lit(63)).cast("int")
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), at)
        mask = one if mask is None else mask.bitwiseOR(one)
    return place, mask


def bloom(keys: DataFrame, on: list[str]) -> Bloom | None:
    """The filter of a key set, or None for so many keys that it would keep nearly every row.

    It is built by one aggregate, map-side combined; the only task that holds it whole holds
    BLOOM_WORDS words at most.
    """
    types = {k: dict(keys.dtypes)[k] for k in on}
    wanted = max(math.ceil(keys.count() * BLOOM_BITS_PER_KEY / 64), 1)
    if wanted > 4 * BLOOM_WORDS:
        return None
    size = min(1 << (wanted - 1).bit_length(), BLOOM_WORDS)
    place, mask = _bloom_bits(types, size)
    used = keys.select(place.cast("bigint").alias("id"), mask.alias("mask")).groupBy("id").agg(
        F.bit_or("mask").alias("mask")
    )
    every = keys.sparkSession.range(size).join(used, "id", "left")
    pair = F.struct("id", F.coalesce("mask", F.lit(0).cast("bigint")).alias("mask"))
    words = every.agg(F.array_sort(F.collect_list(pair)).alias("pairs")).select(
        F.col("pairs.mask").alias("words")
    )
    return Bloom(materialise(words), size, types)


def look_up(
    large: DataFrame, table: DataFrame, on: list[str], limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Left join to a table with one row per key, without moving the large side if it can be helped.

    A table within the bound is broadcast, so the skew of the large side does not matter. Beyond
    it the join is shuffled and, being the only operation on its partitions, open to the skew
    splitting of adaptive execution. Counting reads the table once: pass a written one if it is
    costly to compute.
    """
    if is_bounded(table, limit):
        table = F.broadcast(table)
    return large.join(table, on, "left")


_FUNCTIONS = {"sum": F.sum, "max": F.max, "min": F.min}


def _combine(kind: str, left: Column, right: Column) -> Column:
    if kind == "sum":
        return F.when(left.isNull(), right).when(right.isNull(), left).otherwise(left + right)
    return {"max": F.greatest, "min": F.least}[kind](left, right)


Aggregates = dict[str, tuple[str, Column]]


def running_around(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    before: Aggregates,
    after: Aggregates,
) -> DataFrame:
    """Aggregates over all earlier and over all later rows of the same key, in `order`; NULL where
    there are none.

    A plain window would put a whole key into one task. Here the rows are range-partitioned by key
    and order, so that a heavy key spreads over many chunks; each chunk is scanned on its own and
    combined with the totals of the chunks before or after it (one row per key and chunk). One
    partitioning serves both directions. `order` has to be total within a key and the keys must
    not be NULL. `keys` may be empty: the order is then global.
    """
    given, both = df.columns, {**before, **after}
    inputs = {f"_in_{name}": value for name, (_, value) in both.items()}
    chunked = materialise(
        df.withColumns(inputs)
        .repartitionByRange(*[F.col(k) for k in keys], *order)
        .withColumn("_chunk", F.spark_partition_id())
    )
    per_chunk = chunked.groupBy(*keys, "_chunk").agg(
        *[_FUNCTIONS[kind](f"_in_{n}").alias(f"_all_{n}") for n, (kind, _) in both.items()]
    )
    chunks = Window.partitionBy(*keys).orderBy("_chunk")
    within = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    start, end = Window.unboundedPreceding, Window.unboundedFollowing
    frames = {n: (start, -1) for n in before} | {n: (1, end) for n in after}
    carried = per_chunk.select(
        *keys,
        "_chunk",
        *[
            _FUNCTIONS[kind](f"_all_{n}").over(chunks.rowsBetween(*frames[n])).alias(f"_carry_{n}")
            for n, (kind, _) in both.items()
        ],
    )
    joined = chunked.join(carried, [*keys, "_chunk"], "left")
    return joined.select(
        *given,
        *[
            _combine(
                kind,
                F.col(f"_carry_{n}"),
                _FUNCTIONS[kind](f"_in_{n}").over(within.rowsBetween(*frames[n])),
            ).alias(n)
            for n, (kind, _) in both.items()
        ],
    )


def running_before(
    df: DataFrame, keys: list[str], order: list[Column], aggregates: Aggregates
) -> DataFrame:
    """Aggregates over all earlier rows of the same key; see `running_around`."""
    return running_around(df, keys, order, aggregates, {})


def global_rank(
    df: DataFrame, order: list[Column], name: str = "rank", keys: list[str] | None = None
) -> DataFrame:
    """Gap-free position 1..n in a total order, without one task holding all rows."""
    before = running_before(df, keys or [], order, {name: ("sum", F.lit(1).cast("bigint"))})
    return before.withColumn(name, F.coalesce(col(name), F.lit(0)) + 1)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
