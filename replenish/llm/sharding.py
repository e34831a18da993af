"""Sharding by extendible hashing.

A document's place is the prefix of a 60-bit hash. A bucket that exceeds the byte limit is split on
the next bit, and only such a bucket; the leaves are the shards, and the bits of a leaf its name in
the directory. A bucket whose documents all have the same hash cannot be split: one document that
is larger than the limit is a shard by itself, and rows that repeat a document go to overflow pages
that fit.

Texts are read once, for their length and hash. Buckets are added up from cells, which are prefixes
so long that they are far smaller than a shard; only cells that still are too large are split
further, so deep splits do not touch the other documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenish.llm.common import col, fresh
from replenish.operators.scale import look_up, materialise, running_before, scratch

HASH_BITS = 60
LIMIT_BYTES = 128 << 20
# Bits that cells have more than shards of average size, and that are added when cells are split.
CELL_BITS = 6


def place(key: Column, text: Column) -> Column:
    """The hash of a document, 60 bits of an MD5 over its key and text."""
    named = F.concat_ws(
        "|",
        F.coalesce(key.cast("string"), F.lit("")),
        F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")),
    )
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _grown(rows: DataFrame, above: int, depth: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Splits buckets of depth `above` down to `depth` bits. Leaves (prefix, depth, shard_bytes,
    shard_rows), and the prefixes of `depth` bits that have to be split further."""
    cells = (
        rows.groupBy(F.expr(f"shiftright(hash, {HASH_BITS - depth})").alias("cell"))
        .agg(
            F.sum("bytes").alias("bytes"),
            F.count(F.lit(1)).alias("rows"),
            F.min("hash").alias("low"),
            F.max("hash").alias("high"),
        )
    )
    levels = F.sequence(F.lit(above), F.lit(depth))
    nodes = cells.withColumn("depth", F.explode(levels)).groupBy(
        "depth", F.expr(f"shiftright(cell, {depth} - depth)").alias("prefix")
    ).agg(
        F.sum("bytes").alias("shard_bytes"),
        F.sum("rows").alias("shard_rows"),
        ((F.sum("bytes") <= limit) | (F.min("low") == F.max("high"))).alias("whole"),
    )
    nodes = materialise(nodes)
    parents = nodes.filter("not whole").select(
        (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")
    )
    below = nodes.withColumn("parent", F.expr("shiftright(prefix, 1)")).join(
        parents, ["depth", "parent"], "left_semi"
    )
    reached = nodes.filter(F.col("depth") == above).select(*nodes.columns).union(
        below.filter(F.col("depth") > above).select(*nodes.columns)
    )
    leaves = reached.filter("whole").select("prefix", "depth", "shard_bytes", "shard_rows")
    open_ = reached.filter(~F.col("whole") & (F.col("depth") == depth)).select("prefix")
    return leaves, open_


def _leaf_of(rows: DataFrame, leaves: DataFrame, above: int, depth: int) -> DataFrame:
    """`rows` with the leaf over them, for those that have one."""
    # A leaf stands for all its cells, so the join has one fixed key that the hash spreads evenly.
    cells = leaves.select(
        "prefix",
        F.col("depth").cast("int").alias("depth"),
        "shard_bytes",
        "shard_rows",
        F.explode(
            F.sequence(
                F.expr(f"shiftleft(prefix, int({depth} - depth))"),
                F.expr(f"shiftleft(prefix + 1, int({depth} - depth)) - 1"),
            )
        ).alias("cell"),
    )
    tagged = rows.withColumn("cell", F.expr(f"shiftright(hash, {HASH_BITS - depth})"))
    return look_up(tagged, materialise(cells), ["cell"]).drop("cell")


def assigned(rows: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """`rows` (row, hash, bytes) with prefix, depth, shard_bytes and shard_rows of their leaf."""
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    average = max(math.ceil(math.log2(max(total, 1) / limit)), 0)
    above, depth = 0, min(average + CELL_BITS, HASH_BITS)
    done = None
    while True:
        leaves, open_ = _grown(rows, above, depth, limit)
        placed = materialise(_leaf_of(rows, leaves, above, depth))
        found = placed.filter("prefix is not null")
        done = found if done is None else done.union(found)
        if depth == HASH_BITS or open_.isEmpty():
            return done
        rows = placed.filter("prefix is null").select("row", "hash", "bytes")
        above, depth = depth + 1, min(depth + CELL_BITS, HASH_BITS)


def shards(
    docs: DataFrame, limit: int = LIMIT_BYTES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of `docs`: doc_id, bytes (UTF-8 length of the text), shard (the bits of its
    bucket, empty if one bucket holds all), page, depth, shard_bytes, shard_rows (of all pages).

    Null texts have 0 bytes. Rows that repeat a key and a text cannot be told apart by a hash; when
    they exceed the limit together, as many as fit go to a page, at least one. An empty table gives
    no rows.
    """
    rows = materialise(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            col(key).alias("doc_id"),
            place(col(key), col(text)).alias("hash"),
            F.coalesce(F.octet_length(col(text).cast("string")), F.lit(0)).cast("bigint").alias("bytes"),
        )
    )
    found = assigned(rows.select("row", "hash", "bytes"), limit)
    crowded = (F.col("shard_bytes") > limit) & (F.col("shard_rows") > 1)
    full = found.filter(crowded)
    plain = found.filter(~crowded).withColumn("page", F.lit(0).cast("bigint"))
    if not full.isEmpty():
        counted = running_before(full, ["hash"], [F.col("row")], {"before": ("sum", F.lit(1).cast("bigint"))})
        per_page = F.greatest(F.floor(F.lit(limit) / F.col("bytes")), F.lit(1))
        paged = counted.withColumn(
            "page", F.floor(F.coalesce("before", F.lit(0)) / per_page).cast("bigint")
        )
        plain = plain.unionByName(paged.drop("before"))
    named = F.when(F.col("depth") == 0, "").otherwise(
        F.expr("right(lpad(bin(prefix), 64, '0'), int(depth))")
    )
    return rows.select("row", "doc_id", "bytes").join(
        plain.select(
            "row", named.alias("shard"), "page", "depth", "shard_bytes", "shard_rows"
        ),
        "row",
    ).drop("row")


def directory(found: DataFrame) -> DataFrame:
    """The directory of `shards`: shard, depth, pages, row_bytes (of the longest row), bytes, rows. A
    hash belongs to the one shard whose bits it begins with."""
    return found.groupBy("shard", "depth").agg(
        (F.max("page") + 1).alias("pages"),
        F.max("bytes").alias("row_bytes"),
        F.max("shard_bytes").alias("bytes"),
        F.max("shard_rows").alias("rows"),
    )


def _placed(docs: DataFrame, found: DataFrame, names: tuple[str, str], key: str, text: str, limit: int) -> DataFrame:
    """`docs` with the shard and page of each row. The leaves of one depth are looked up at a time,
    by as many bits of the hash; there are a few depths, and rows are never multiplied."""
    shard, page = names
    bits, many = fresh(docs, "bits"), fresh(docs, "per_page")
    placed = docs.withColumn(bits, F.lpad(F.bin(place(col(key), col(text))), HASH_BITS, "0"))
    per_page = F.when(
        (F.col("bytes") > limit) & (F.col("rows") > 1),
        F.greatest(F.floor(F.lit(limit) / F.col("row_bytes")), F.lit(1)),
    )
    leaves = found.select(
        "depth", F.col("shard").alias(shard), per_page.cast("bigint").alias(many)
    )
    depths = sorted(r[0] for r in leaves.select("depth").distinct().collect())
    hits = []
    for depth in depths:
        at, hit = fresh(placed, f"at{depth}"), fresh(placed, f"hit{depth}")
        of_depth = leaves.filter(F.col("depth") == depth).select(
            F.col(shard).alias(at), F.struct(shard, many).alias(hit)
        )
        placed = look_up(placed.withColumn(at, F.substring(col(bits), 1, depth)), of_depth, [at])
        hits.append(hit)
    leaf = F.coalesce(*[col(h) for h in hits])
    named = placed.select(
        *map(col, docs.columns), col(bits), leaf[shard].alias(shard), leaf[many].alias(many)
    )
    plain = named.filter(col(many).isNull()).withColumn(page, F.lit(0).cast("bigint"))
    wanted = [*map(col, docs.columns), col(shard), col(page)]
    if found.filter((F.col("bytes") > limit) & (F.col("rows") > 1)).isEmpty():
        return plain.select(*wanted)
    # Rows that repeat a key and a text, counted through in chunks. They are packed, so that their
    # names do not meet those of the helper.
    full = materialise(
        named.filter(col(many).isNotNull()).select(
            F.struct(*map(col, docs.columns)).alias("given"),
            col(bits).alias("hash"),
            col(shard).alias("leaf"),
            col(many).alias("per_page"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    counted = running_before(full, ["hash"], [F.col("row")], {"before": ("sum", F.lit(1).cast("bigint"))})
    paged = counted.select(
        *[F.col("given").getField(c).alias(c) for c in docs.columns],
        F.col("leaf").alias(shard),
        F.floor(F.coalesce("before", F.lit(0)) / F.col("per_page")).cast("bigint").alias(page),
    )
    return plain.select(*wanted).unionByName(paged)


def write(
    docs: DataFrame, path: str, limit: int = LIMIT_BYTES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Writes `docs`, with their columns, as one Parquet folder per shard (`s` and its bits) and
    page, each by one task, and returns the directory. The texts of a folder fit the limit, but for
    a single row that is larger by itself. Null keys and texts are hashed like empty ones; an empty
    table is written as a table without rows. Underscores are added to the names shard and page if
    `docs` has such columns."""
    found = materialise(directory(shards(docs, limit, key, text)))
    shard = fresh(docs, "shard")
    page = fresh(docs, "page")
    if found.isEmpty():
        empty = docs.withColumns({shard: F.lit(""), page: F.lit(0).cast("bigint")}).limit(0)
        empty.write.parquet(path)
        return found
    placed = _placed(docs, found, (shard, page), key, text, limit)
    named = placed.withColumn(shard, F.concat(F.lit("s"), col(shard)))  # an empty name is no folder
    named.repartition(col(shard), col(page)).write.partitionBy(shard, page).parquet(path)
    return found


def written(
    docs: DataFrame, limit: int = LIMIT_BYTES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The columns of `shards`, from shards that are written to the shared folder and read back:
    shard and page are those of the file that a row is in."""
    spark, path = docs.sparkSession, scratch(docs.sparkSession, "shards")
    found = write(docs, path, limit, key, text)
    shard, page = fresh(docs, "shard"), fresh(docs, "page")
    back = spark.read.parquet(path).select(
        col(key).alias("doc_id"),
        F.coalesce(F.octet_length(col(text).cast("string")), F.lit(0)).cast("bigint").alias("bytes"),
        F.expr(f"substring(`{shard}`, 2)").alias("shard"),
        col(page).cast("bigint").alias("page"),
    )
    sizes = found.select(
        "shard", "depth", F.col("bytes").alias("shard_bytes"), F.col("rows").alias("shard_rows")
    )
    return look_up(back, sizes, ["shard"]).select(
        "doc_id", "bytes", "shard", "page", "depth", "shard_bytes", "shard_rows"
    )
