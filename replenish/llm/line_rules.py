"""Quality rules: repeated content inside a document, and lines that many documents of a host share.

Lines are normalised (lower case, one space between words) and hashed. A line is boilerplate on a
host if it stands in more documents of the host than a limit: `share` of the documents, but no less
than `least` and never more than `most`, which holds on a host of any size.
Such lines are removed; a document that loses at least half of its words is depleted and rejected.

Lines of one document are added up before they leave it, counts are combined before the shuffle,
and boilerplate lines go back to documents by a join whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenish.llm.common import SPACES, col, fresh, prepare_python
from replenish.operators.scale import look_up, materialise

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50


@dataclass(frozen=True)
class Limits:
    """When a line is boilerplate, and the share of words in per cent that must be left. As long as
    `most` is no more than `least`, the limit is one number of documents, whatever the host's size."""

    share: float = 0.02
    least: int = 20
    left_percent: int = 50
    most: int = 20


_FEATURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, line array<bigint>, line_words array<int>"
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of WINDOW words that occur at least twice."""
    first: dict[tuple, int] = {}
    covered = None
    for i, window in enumerate(zip(*(words[k:] for k in range(WINDOW)))):
        before = first.setdefault(window, i)
        if before != i:
            if covered is None:
                covered = bytearray(len(words))
            covered[i : i + WINDOW] = covered[before : before + WINDOW] = b"\1" * WINDOW
    return covered.count(1) if covered else 0


def line_key(words: list[bytes]) -> int:
    """Key of a line by its lower-case words."""
    return xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)


def described(text: str) -> tuple:
    """The columns of _FEATURES for one text."""
    words = text.encode().split()  # ASCII white space: \x20 and \x09-\x0D
    lines: dict[int, int] = {}
    seen: set[str] = set()
    duplicates = 0
    for line in text.split("\n"):
        normal = line.lower().encode().split()
        if not normal:
            continue
        duplicates += line in seen
        seen.add(line)
        key = line_key(normal)
        lines[key] = lines.get(key, 0) + len(normal)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        duplicates,
        repeated_words(words),
        list(lines),
        list(lines.values()),
    )


def features(text: Column) -> Column:
    """Struct of _FEATURES; null counts as the empty text. The line arrays hold every distinct
    normalised line with its words."""
    types = [pa.int64()] * 5 + [pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = [part.split()[0] for part in _FEATURES.split(", ")]

    @F.arrow_udf(_FEATURES)
    def describe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [described(t.as_py() or "") for t in batch]
            yield pa.StructArray.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(types)], names
            )

    return describe(text.cast("string"))


def without(text: str, keys: set[int]) -> str:
    """`text` without the lines that have one of the keys; lines without words stay."""
    kept = []
    for line in text.split("\n"):
        normal = line.lower().encode().split()
        if not normal or line_key(normal) not in keys:
            kept.append(line)
    return "\n".join(kept)


def _dropped(text: Column, keys: Column) -> Column:
    @F.arrow_udf("string")
    def drop(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for values, keys in batches:
            yield pa.array(
                [
                    without(v.as_py() or "", set(k.as_py())) if k.is_valid else v.as_py()
                    for v, k in zip(values, keys)
                ],
                pa.string(),
            )

    return drop(text.cast("string"), keys)


def _host(host: str) -> Column:
    """A host by one number; rows without host are a host of their own."""
    return F.xxhash64(col(host).isNull(), col(host).cast("string"))


def _text_key(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(col(text).cast("string"), F.lit("")).cast("binary")))


def _found(docs: DataFrame, limits: Limits, key: str, host: str, text: str) -> DataFrame:
    """The columns of `judged`, with host, text_key and the keys of the boilerplate lines in each
    row (`drop`, null if there are none)."""
    prepare_python(docs.sparkSession)
    rows = materialise(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            col(key).alias("doc_id"),
            _host(host).alias("host"),
            _text_key(text).alias("text_key"),
            features(col(text)).alias("f"),
        ).select("row", "doc_id", "host", "text_key", "f.*")
    )
    hosts = materialise(
        rows.groupBy("host").agg(
            F.least(
                F.greatest(F.floor(F.count(F.lit(1)) * F.lit(limits.share)), F.lit(limits.least)),
                F.lit(max(limits.most, limits.least)),
            ).alias("most")
        )
    )
    # A line of a host by one number; the lines array has every line of a document once.
    lines = look_up(
        rows.select("row", "host", F.explode(F.arrays_zip("line", "line_words")).alias("l")), hosts, ["host"]
    ).select("row", F.xxhash64("host", "l.line").alias("at"), "l.line", F.col("l.line_words").alias("words"), "most")
    boilerplate = materialise(
        lines.groupBy("at")
        .agg(F.count(F.lit(1)).alias("documents"), F.max("most").alias("most"))
        .filter("documents > most")
        .select("at")
    )
    removed = (
        lines.join(boilerplate, "at")
        .groupBy("row")
        .agg(F.sum("words").alias("removed_words"), F.collect_list("line").alias("drop"))
    )
    found = rows.drop("line", "line_words").join(removed, "row", "left")
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT
    )
    left = F.col("n_words") - F.col("removed_words")
    depleted = left * 100 <= F.col("n_words") * (100 - limits.left_percent)
    return (
        found.withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("bigint"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~depleted)
        .drop("row")
    )


def judged(
    docs: DataFrame,
    limits: Limits = Limits(),
    key: str = "doc_id",
    host: str = "source",
    text: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, removed_words (in the lines that `cleaned` drops), kept (whether
    `cleaned` has the row).

    Every row counts as a document, also one that repeats another; rows without host are a host of
    their own. A text without words fails the base rules. An empty table gives no rows.
    """
    return _found(docs, limits, key, host, text).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "removed_words", "base_failed", "kept",
    )


def cleaned(
    docs: DataFrame,
    limits: Limits = Limits(),
    key: str = "doc_id",
    host: str = "source",
    text: str = "text",
) -> DataFrame:
    """The rows of `docs` that `judged` keeps, with the columns of `docs`: boilerplate lines are
    dropped from the text, all other lines stay as they are and in order.

    Rows of one host with one text have the same lines, so the verdict goes back by host and text.
    """
    found = _found(docs, limits, key, host, text)
    verdicts = materialise(
        found.filter("kept").groupBy("host", "text_key").agg(F.first("drop").alias("drop"))
    )
    verdict, own_host, own_key = fresh(docs, "verdict"), fresh(docs, "host"), fresh(docs, "text_key")
    table = verdicts.select(
        F.col("host").alias(own_host), F.col("text_key").alias(own_key), F.struct("drop").alias(verdict)
    )
    keyed = docs.withColumns({own_host: _host(host), own_key: _text_key(text)})
    rows = look_up(keyed, table, [own_host, own_key]).filter(col(verdict).isNotNull())
    new = _dropped(col(text), col(verdict)["drop"]).alias(text)
    return rows.select(*(new if c == text else col(c) for c in docs.columns))
