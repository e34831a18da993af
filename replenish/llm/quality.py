"""Quality classifier: naive Bayes support vectors.

A text is the set of its hashed byte n-grams (`SIZES`, `BITS`). Every indicator is scaled by the
log-count ratio of the classes, the vector is brought to length 1, and a linear hinge-loss model is
fitted by dual coordinate descent. The margin becomes a probability by a logistic curve fitted on
labelled rows that the descent did not see.

The classifier is fitted on a sample of about `TRAIN_ROWS` labelled rows, chosen by a hash; this
bound is its documented parameter. It is fitted in one task, which the bound keeps small.
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
from replenish.llm.common import col, held_out, prepare_python
from replenish.operators.scale import materialise

BITS = 17
SIZES = (1, 2, 3, 4, 6)
TRAIN_ROWS = 5_000
THRESHOLD = 0.7
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
# Every so manieth labelled row calibrates instead of training.
CALIBRATE_EVERY = 4


@dataclass
class Model:
    """`ratios` scales indicators, `weights` is the linear model times the ratios; `slope` and
    `shift` turn a margin into a probability."""

    ratios: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    bias: float = 0.0
    slope: float = 0.0
    shift: float = 0.0


def indicators(text: str, seen: np.ndarray) -> np.ndarray:
    """Numbers of the n-grams of a text; `seen` is a cleared table of 2**BITS flags."""
    for part in ngrams.codes(text.encode(), SIZES, BITS):
        seen[part] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """ln of the share of an n-gram among those of class 1 over its share in class 0."""
    shares = []
    for label in (1, 0):
        picked = [r for r, y in zip(rows, labels) if y == label]
        count = np.bincount(np.concatenate(picked), minlength=1 << BITS) + SMOOTHING
        shares.append(count / count.sum())
    return np.log(shares[0] / shares[1]).astype(np.float32)


def _scaled(rows: list[np.ndarray], ratios: np.ndarray) -> list[np.ndarray]:
    return [ratios[r] / max(float(np.linalg.norm(ratios[r])), 1e-9) for r in rows]


def dual_descent(
    rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray
) -> tuple[np.ndarray, float]:
    """Hinge-loss model with a bias: one dual variable at a time, in a random order per epoch.
    The classes have the same total cost."""
    signs = np.where(labels == 1, 1.0, -1.0)
    cost = COST * np.where(labels == 1, 0.5 / (labels == 1).mean(), 0.5 / (labels == 0).mean())
    weights, bias = np.zeros(1 << BITS), 0.0
    dual = np.zeros(len(rows))
    squares = np.array([v @ v + 1.0 for v in values])
    order = np.random.default_rng(11)
    for _ in range(EPOCHS):
        largest = 0.0
        for i in order.permutation(len(rows)):
            gradient = signs[i] * (weights[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(dual[i] - gradient / squares[i], 0.0), cost[i])
            step = (new - dual[i]) * signs[i]
            if step:
                weights[rows[i]] += step * values[i]
                bias += step
                dual[i] = new
                largest = max(largest, abs(step))
        if largest < 1e-4:
            break
    return weights, bias


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of P(1) = 1 / (1 + exp(-(slope * margin + shift))), by Newton steps on
    smoothed targets."""
    ones, zeros = (labels == 1).sum(), (labels == 0).sum()
    wanted = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    at = np.array([1.0, np.log((ones + 1) / (zeros + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(bend, x.T @ (wanted - p) - 1e-6 * at)
        at = at + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(at[0], 0.0)), float(at[1])


def learned(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """The model of labelled rows. With one class only it is the smoothed share of class 1."""
    ones, zeros = int((labels == 1).sum()), int((labels == 0).sum())
    prior = Model(shift=float(np.log((ones + 1) / (zeros + 1))))
    if min(ones, zeros) < 2 * CALIBRATE_EVERY:
        return prior
    held = np.zeros(len(rows), dtype=bool)
    for label in (0, 1):
        held[np.flatnonzero(labels == label)[::CALIBRATE_EVERY]] = True
    train = np.flatnonzero(~held)
    ratios = log_count_ratios([rows[i] for i in train], labels[train])
    values = _scaled(rows, ratios)
    weights, bias = dual_descent(
        [rows[i] for i in train], [values[i] for i in train], labels[train]
    )
    margins = np.array([weights[rows[i]] @ values[i] + bias for i in np.flatnonzero(held)])
    slope, shift = logistic(margins, labels[held])
    return Model(ratios, (weights * ratios).astype(np.float32), bias, slope, shift)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    train_rows: int = TRAIN_ROWS,
) -> Model:
    """Learn from labelled rows outside the held-out quarter; labels other than 0 and 1 are left
    out. Without such rows every text scores 0.5."""
    prepare_python(docs.sparkSession)
    usable = labels.filter(~held_out(key) & col(label).isin(0, 1) & col(key).isNotNull())
    usable = usable.select(col(key).alias("key"), col(label).cast("int").alias("label"))
    chance = F.pmod(F.xxhash64(F.lit("quality"), "key"), F.lit(1 << 30)) / float(1 << 30)
    share = train_rows / max(usable.count(), 1)
    # About train_rows keys, by the parameter: small enough to broadcast.
    picked = F.broadcast(usable.filter(chance < min(share, 1.0)))
    texts = docs.select(col(key).alias("key"), col(text).cast("string").alias("text"))

    @F.arrow_udf("array<int>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seen = np.zeros(1 << BITS, dtype=bool)
        for batch in batches:
            rows = [indicators(t, seen).astype(np.int32) for t in ngrams.texts(batch)]
            yield pa.array(rows, pa.list_(pa.int32()))

    rows = materialise(
        texts.join(picked, "key")
        .repartition(docs.sparkSession.sparkContext.defaultParallelism, "key")
        .select("key", "label", found("text").alias("features"))
    )

    # One group: the sample as a whole, bounded by train_rows.
    def descend(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["key", "label"], kind="stable").reset_index(drop=True)
        model = learned(list(part.features), part.label.to_numpy())
        return pd.DataFrame(
            {
                "ratios": [model.ratios.tobytes()],
                "weights": [model.weights.tobytes()],
                "rest": [[model.bias, model.slope, model.shift]],
            }
        )

    made = (
        rows.withColumn("model", F.lit(0))
        .groupBy("model")
        .applyInPandas(descend, "ratios binary, weights binary, rest array<double>")
    ).collect()
    if not made:
        return Model()
    ratios, weights = (np.frombuffer(made[0][c], np.float32) for c in ("ratios", "weights"))
    return Model(ratios, weights, *made[0]["rest"])


def score(text: Column, model: Model) -> Column:
    """Probability of class 1 of a text column; null counts as empty, which has no n-grams and
    gets what the bias alone gives."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seen = np.zeros(1 << BITS, dtype=bool)
        for batch in batches:
            margins = np.zeros(len(batch))
            for i, t in enumerate(ngrams.texts(batch)):
                found = indicators(t, seen)
                norm = max(float(np.linalg.norm(model.ratios[found])), 1e-9)
                margins[i] = float(model.weights[found].sum(dtype=np.float64)) / norm + model.bias
            z = np.clip(model.slope * margins + model.shift, -700, 700)
            yield pa.array(1 / (1 + np.exp(-z)))

    return scored(text.cast("string"))


def judged(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted. Keys may repeat or be null;
    an empty table gives no rows."""
    prepare_python(docs.sparkSession)
    return docs.select(
        col(key).alias("doc_id"),
        held_out(key).alias("held_out"),
        score(col(text), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
