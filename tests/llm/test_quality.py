from __future__ import annotations

import math
import zlib

import numpy as np
import pytest

from replenish.llm import quality

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    model = quality.fit(docs, labels, train_rows=2500)
    rows = quality.judged(docs, model).join(labels, "doc_id").filter("held_out").collect()
    good = np.array([r.score for r in rows if r.quality == 1])
    bad = np.array([r.score for r in rows if r.quality == 0])
    assert len(bad) > 50
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.94
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_held_out_labels_do_not_matter(tables):
    docs, labels = tables
    small = docs.filter("doc_id < 1500")
    turned = labels.selectExpr(
        "doc_id", "if(pmod(crc32(cast(doc_id as string)), 4) = 2, 1 - quality, quality) as quality"
    )
    one, other = quality.fit(small, labels), quality.fit(small, turned)
    assert (one.weights == other.weights).all() and one.slope == other.slope and one.slope > 0


def test_dual_descent_separates_and_respects_the_box():
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 2, 200)
    rows = [np.unique(rng.integers(0, 50, 12) + 50 * y) for y in labels]
    ratios = quality.log_count_ratios(rows, labels)
    values = quality._scaled(rows, ratios)
    weights, bias = quality.dual_descent(rows, values, labels)
    margins = np.array([weights[r] @ v + bias for r, v in zip(rows, values)])
    assert ((margins > 0) == (labels == 1)).all()
    assert (ratios[:50] < 0).all() and (ratios[50:100] > 0).all()


def test_edge_rows(spark, tables):
    docs, labels = tables
    model = quality.fit(docs.filter("doc_id < 1500"), labels)
    rows = [(1, None), (2, ""), (None, "text"), (3, "x"), (3, "x"), (4, "The long text of it. " * 50000), (5, "\x00\n | |")]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as score", "0 as label")
    got = quality.judged(odd, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[1] == by[2]
    assert quality.judged(docs.limit(0), model).count() == 0
    assert quality.fit(docs.limit(0), labels).slope == 0
    unlabelled = quality.fit(docs, labels.selectExpr("doc_id", "cast(null as int) as quality"))
    assert {r.score for r in quality.judged(odd, unlabelled).collect()} == {0.5}
    ones = quality.fit(docs.limit(200), labels.selectExpr("doc_id", "1 as quality"))
    assert all(r.score > 0.9 for r in quality.judged(odd, ones).collect())


def naive_indicators(text):
    data, found = text.encode(), set()
    for n in (1, 2, 3, 4, 6):
        for i in range(len(data) - n + 1):
            mixed = ((int.from_bytes(data[i : i + n], "big") + 1) * 8 + n) * 0x9E3779B97F4A7C15
            found.add((mixed % 2**64) >> (64 - quality.BITS))
    return found


def test_every_score_equals_the_naive_classifier(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = {r.doc_id: r.score for r in quality.judged(docs, quality.fit(docs, labels)).collect()}
    sets = {r.doc_id: naive_indicators(r.text or "") for r in docs.collect()}
    marked = sorted(
        (r.doc_id, r.quality) for r in labels.collect()
        if r.quality in (0, 1) and r.doc_id in sets and zlib.crc32(str(r.doc_id).encode()) % 4 != 2
    )
    classes = {y: [d for d, label in marked if label == y] for y in (0, 1)}
    assert min(map(len, classes.values())) >= 2 * quality.CALIBRATE_EVERY
    held = {d for group in classes.values() for d in group[:: quality.CALIBRATE_EVERY]}
    train = [(d, y) for d, y in marked if d not in held]

    size = 1 << quality.BITS
    counts = {0: [1.0] * size, 1: [1.0] * size}
    for d, y in train:
        for feature in sets[d]:
            counts[y][feature] += 1
    totals = {y: sum(counts[y]) for y in counts}
    ratio = [math.log(counts[1][f] / totals[1] / (counts[0][f] / totals[0])) for f in range(size)]

    def vector(d):
        norm = math.sqrt(sum(ratio[f] ** 2 for f in sets[d])) or 1e-9
        return {f: ratio[f] / norm for f in sets[d]}

    vectors = [vector(d) for d, _ in train]
    share = {y: sum(label == y for _, label in train) / len(train) for y in (0, 1)}
    weights, bias, dual = [0.0] * size, 0.0, [0.0] * len(train)
    draw = np.random.default_rng(11)
    for _ in range(quality.EPOCHS):
        largest = 0.0
        for i in draw.permutation(len(train)):
            y = 1 if train[i][1] else -1
            margin = sum(weights[f] * v for f, v in vectors[i].items()) + bias
            square = 1 + sum(v * v for v in vectors[i].values())
            new = min(max(dual[i] - (y * margin - 1) / square, 0), quality.COST * 0.5 / share[train[i][1]])
            step, dual[i] = (new - dual[i]) * y, new
            for f, v in vectors[i].items():
                weights[f] += step * v
            bias += step
            largest = max(largest, abs(step))
        if largest < 1e-4:
            break

    def margin_of(d):
        return sum(weights[f] * v for f, v in vector(d).items()) + bias

    ones, zeros = (sum(dict(marked)[d] == y for d in held) for y in (1, 0))
    points = [(margin_of(d), (ones + 1) / (ones + 2) if dict(marked)[d] else 1 / (zeros + 2)) for d in held]

    def loss(slope, shift):
        total = 5e-7 * (slope**2 + shift**2)
        for x, wanted in points:
            z = slope * x + shift
            total += max(z, 0) + math.log1p(math.exp(-abs(z))) - wanted * z
        return total

    # The curve: no neighbour of the fitted one has a smaller loss.
    model = quality.fit(docs, labels)
    best = loss(model.slope, model.shift)
    for a, b in ((1e-2, 0), (-1e-2, 0), (0, 1e-2), (0, -1e-2)):
        assert loss(model.slope + a, model.shift + b) > best
    assert abs(model.bias - bias) < 1e-3
    for d in sets:
        z = model.slope * margin_of(d) + model.shift
        assert abs(got[d] - 1 / (1 + math.exp(-z))) < 2e-3
