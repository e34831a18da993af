"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed n-grams of its lower-case letters (`BITS`, `SIZES`), weighted by
(1 + ln count) * idf and normalised to length 1. Per language the vectors of a sample are clustered
by spherical k-means; a text gets the language of the centroid with the largest cosine. It is
rejected if that centroid is farther away than all but QUANTILE of the labelled texts of that
language and about that length are from centroids that were learned without them.

The classifier is fitted on a sample of about `per_language` rows of each language, chosen by a
hash, and on the `max_languages` most frequent labels; these bounds are its documented parameters.
The centroids are at most max_languages * clusters vectors of 2**BITS numbers, whatever the size
of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenish.llm import ngrams
from replenish.llm.common import col, fresh, held_out, prepare_python
from replenish.operators.scale import materialise

BITS = 13
SIZES = (1, 2, 3, 4)
CLUSTERS = 4
PER_LANGUAGE = 600
MAX_LANGUAGES = 500
# Part of the labelled texts that may be farther away than the limit, the least number of texts
# behind a limit, the least number of a language that is judged by its own texts alone, and the
# parts in which the sample is clustered without one and compared with it.
QUANTILE = 0.001
CALIBRATION_ROWS = 200
OWN_ROWS = 500
FOLDS = 4
UNKNOWN = "und"

_ROWS_AT_ONCE = 128
_BUCKETS = 40


@dataclass
class Centroids:
    """What `fit` learns. `floor` is the least similarity that is accepted, by row of `vectors` and
    log2 of length."""

    languages: list[str] = field(default_factory=list)
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 1 << BITS), np.float32))
    idf: np.ndarray = field(default_factory=lambda: np.ones(1 << BITS, np.float32))
    floor: np.ndarray = field(default_factory=lambda: np.zeros((0, _BUCKETS), np.float32))


def has_letter(text: str) -> bool:
    return ngrams.LETTER.search(text) is not None


def _bucket(length: int) -> int:
    return min(int(length).bit_length(), _BUCKETS - 1)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of counts -> unit vectors."""
    rows = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0).astype(np.float32) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def _counted(batch: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of rows: their n-gram counts and their lengths; length 0 if there is no letter."""
    counts, lengths = [], []
    for text in ngrams.texts(batch):
        data = ngrams.folded(text) if has_letter(text) else b""
        counts.append(ngrams.counts(data, SIZES, BITS))
        lengths.append(len(data))
        if len(counts) == _ROWS_AT_ONCE:
            yield np.array(counts), np.array(lengths)
            counts, lengths = [], []
    if counts:
        yield np.array(counts), np.array(lengths)


def _sparse(text: Column) -> Column:
    """Struct of length, features and their counts; length 0 if there is no letter."""

    @F.arrow_udf("length bigint, features array<int>, counts array<float>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            lengths, features, counts = [], [], []
            for block, sizes in _counted(batch):
                for row, size in zip(block, sizes):
                    used = np.flatnonzero(row)
                    lengths.append(int(size))
                    features.append(used.astype(np.int32))
                    counts.append(row[used])
            yield pa.StructArray.from_arrays(
                [
                    pa.array(lengths, pa.int64()),
                    pa.array(features, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.float32())),
                ],
                ["length", "features", "counts"],
            )

    return vectors(text)


def training_sample(
    docs: DataFrame, key: str, text: str, label: str, per_language: int, max_languages: int
) -> DataFrame:
    """About `per_language` rows of each language outside the held-out quarter: lang, text. Of more
    than `max_languages` languages those with the most rows are learned, ties by code point."""
    eligible = docs.filter(
        ~held_out(key) & col(label).isNotNull() & (col(label) != UNKNOWN) & col(text).isNotNull()
    ).select(col(key).alias("key"), col(text).cast("string").alias("text"), col(label).alias("lang"))
    sizes = eligible.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    common = sizes.orderBy(F.desc("rows"), "lang").limit(max_languages).collect()
    per = {r["lang"]: per_language / r["rows"] for r in common}
    if not per:
        return eligible.select("lang", "text")
    # A language that is not learned has no share.
    share = F.create_map(*[F.lit(x) for pair in per.items() for x in pair])[F.col("lang")]
    chance = F.pmod(F.xxhash64(F.lit("sample"), "key"), F.lit(1 << 30)) / float(1 << 30)
    return eligible.filter(chance < share).select("lang", "text")


def _cluster(rows: np.ndarray, clusters: int) -> np.ndarray:
    """Spherical k-means; starts from the row nearest the mean, then from the farthest ones."""
    mean = rows.mean(axis=0)
    centres = [rows[np.argmax(rows @ mean)]]
    nearest = rows @ centres[0]
    while len(centres) < min(clusters, len(rows)):
        centres.append(rows[np.argmin(nearest)])
        nearest = np.maximum(nearest, rows @ centres[-1])
    found = np.array(centres)
    for _ in range(10):
        own = np.argmax(rows @ found.T, axis=1)
        sums = np.array([rows[own == k].sum(axis=0) for k in range(len(found))])
        used = np.linalg.norm(sums, axis=1) > 0
        found = sums[used] / np.linalg.norm(sums[used], axis=1, keepdims=True)
    return found.astype(np.float32)


def _unseen(rows: np.ndarray, clusters: int) -> np.ndarray:
    """Cosine of each row to the nearest centroid of the other folds; of a single row, to itself."""
    nearest = np.ones(len(rows), np.float32)
    fold = np.arange(len(rows)) % min(FOLDS, len(rows))
    for k in range(fold.max() + 1 if len(rows) > 1 else 0):
        centres = _cluster(rows[fold != k], clusters)
        nearest[fold == k] = (rows[fold == k] @ centres.T).max(axis=1)
    return nearest


def _floor(buckets: np.ndarray, nearest: np.ndarray) -> np.ndarray:
    """The least similarity that is accepted, by bucket of length: the quantile of the texts in the
    bucket, or with them as many of the nearest lengths as make CALIBRATION_ROWS. Shorter texts are
    never held to more than longer ones; below the shortest seen all pass."""
    floor = np.zeros(_BUCKETS, np.float32)
    for b in range(_BUCKETS):
        away = np.abs(buckets - b)
        reach = np.sort(away)[min(CALIBRATION_ROWS, len(away)) - 1]
        floor[b] = np.quantile(nearest[away <= reach], QUANTILE, method="lower")
    floor = np.minimum.accumulate(floor[::-1])[::-1]
    floor[: buckets.min()] = 0
    return floor


def fit(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    clusters: int = CLUSTERS,
    per_language: int = PER_LANGUAGE,
    max_languages: int = MAX_LANGUAGES,
) -> Centroids:
    """Learn centroids from rows outside the held-out quarter that have a label and a letter.

    With no such row the model is empty and every text is unknown. Labels beyond the
    `max_languages` most frequent ones are not learned: their texts are judged by the others.
    """
    prepare_python(docs.sparkSession)
    sample = training_sample(docs, key, text, label, per_language, max_languages)
    # The sample is small, its texts are not: a task may take few of them.
    spread = sample.repartition(docs.sparkSession.sparkContext.defaultParallelism)
    vectors = spread.select("lang", _sparse(F.col("text")).alias("v")).select("lang", "v.*")
    vectors = materialise(vectors.filter("length > 0"))
    frequency = vectors.select(F.explode("features").alias("f")).groupBy("f").count().collect()
    n = vectors.count()
    if not n:
        return Centroids()
    idf = np.full(1 << BITS, np.log(n + 1.0) + 1, dtype=np.float32)
    for row in frequency:
        idf[row["f"]] = np.log((n + 1.0) / (row["count"] + 1.0)) + 1

    def per_group(rows: pd.DataFrame) -> pd.DataFrame:
        order = sorted(range(len(rows)), key=lambda i: (rows.length[i], rows.counts[i].tobytes()))
        dense = np.zeros((len(rows), 1 << BITS), dtype=np.float32)
        for to, i in enumerate(order):
            dense[to, rows.features[i]] = rows.counts[i]
        unit = _weighted(dense, idf)
        centres = _cluster(unit, clusters)
        buckets = np.array([_bucket(rows.length[i]) for i in order], np.int32)
        return pd.DataFrame(
            {
                "lang": rows.lang[0],
                "vector": [c.tobytes() for c in centres],
                "buckets": [buckets.tobytes()] * len(centres),
                "nearest": [_unseen(unit, clusters).tobytes()] * len(centres),
            }
        )

    found = (
        vectors.groupBy("lang").applyInPandas(per_group, "lang string, vector binary, buckets binary, nearest binary")
    ).collect()
    found.sort(key=lambda r: (r["lang"], bytes(r["vector"])))
    # At most per_language numbers of each language; one with too few texts is judged by all.
    own = {
        r["lang"]: (np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["nearest"], np.float32))
        for r in found
    }
    everything = tuple(np.concatenate(part) for part in zip(*own.values()))
    floors = {
        lang: _floor(*(seen if len(seen[0]) >= OWN_ROWS else everything)) for lang, seen in own.items()
    }
    return Centroids(
        [r["lang"] for r in found],
        np.array([np.frombuffer(r["vector"], np.float32) for r in found]),
        idf,
        np.array([floors[r["lang"]] for r in found]),
    )


def predict(text: Column, model: Centroids) -> Column:
    """Struct of lang_pred, score (cosine to the nearest centroid) and rejected.

    lang_pred is `und`, with score 0, for null and for a text without letters, which are rejected,
    and for every text if the model is empty, which rejects no other.
    """

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            picked, scores, rejected = [], [], []
            for counts, lengths in _counted(batch):
                near = _weighted(counts, model.idf) @ model.vectors.T
                known = (lengths > 0) & (len(model.languages) > 0)
                best = near.argmax(axis=1) if near.shape[1] else np.zeros(len(lengths), int)
                top = near.max(axis=1) if near.shape[1] else np.zeros(len(lengths))
                picked.append(np.where(known, best, len(names) - 1))
                scores.append(np.where(known, np.clip(top, 0, 1), 0))
                buckets = [_bucket(n) for n in lengths]
                least = model.floor[best, buckets] if near.shape[1] else np.zeros(len(lengths))
                rejected.append((lengths == 0) | (known & (top < least)))
            if not picked:
                empty = pa.array([], pa.string()), pa.array([], pa.float64()), pa.array([], pa.bool_())
                yield pa.StructArray.from_arrays([*empty], ["lang_pred", "score", "rejected"])
                continue
            yield pa.StructArray.from_arrays(
                [
                    pa.array(names[np.concatenate(picked)], pa.string()),
                    pa.array(np.concatenate(scores).astype(np.float64)),
                    pa.array(np.concatenate(rejected)),
                ],
                ["lang_pred", "score", "rejected"],
            )

    return nearest(text.cast("string"))


def identify(docs: DataFrame, model: Centroids, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred, score, rejected. Null keys count as
    not held out, repeated rows are judged alike, and an empty table gives no rows."""
    prepare_python(docs.sparkSession)
    return docs.select(
        col(key).alias("doc_id"),
        held_out(key).alias("held_out"),
        predict(col(text), model).alias("found"),
    ).select("doc_id", "held_out", "found.*")


def keep_known(docs: DataFrame, model: Centroids, text: str = "text") -> DataFrame:
    """The rows of `docs` that are not rejected, with the columns of `docs`."""
    prepare_python(docs.sparkSession)
    found = fresh(docs, "found")
    judged = docs.withColumn(found, predict(col(text), model))
    return judged.filter(~col(found)["rejected"]).select(*map(col, docs.columns))
