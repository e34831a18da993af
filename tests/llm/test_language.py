from __future__ import annotations

import math
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import pytest

from replenish.llm import language

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return language.fit(documents)


def test_held_out_accuracy(documents, model):
    truth = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    rows = language.identify(documents, model).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert 0.15 < len(held) / len(rows) < 0.35
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in held) / len(held) < 0.01


def test_held_out_rows_and_labels_do_not_matter(spark, documents, model):
    changed = documents.selectExpr(
        "doc_id", "if(pmod(crc32(cast(doc_id as string)), 4) = 2, 'xx', lang) as lang", "text"
    )
    again = language.fit(changed)
    assert again.languages == model.languages
    assert (again.vectors == model.vectors).all()


def test_edge_rows(spark, documents, model):
    prose = " ".join(r.text for r in documents.filter("lang = 'en'").orderBy("doc_id").limit(60).collect())
    rows = [
        (1, None), (2, ""), (3, "1234 !!! ²"), (4, "漢字" * 40), (None, "the and of with this is that"),
        (5, "zzxqkw " * 3000), (6, prose * 8), (6, prose * 8),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as found", "2 as held_out")
    got = {(r.doc_id, i): r for i, r in enumerate(language.identify(docs, model).collect())}
    by = {k: [r for (d, _), r in got.items() if d == k] for k in (1, 2, 3, 4, 5, 6, None)}
    for k in (1, 2, 3):
        assert by[k][0].lang_pred == "und" and by[k][0].score == 0 and by[k][0].rejected
    assert by[4][0].rejected and by[4][0].lang_pred in model.languages
    assert by[None][0].lang_pred == "en" and not by[None][0].held_out
    assert [r.lang_pred for r in by[6]] == ["en", "en"]
    kept = language.keep_known(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {6, None} and 4 not in {r.doc_id for r in kept.collect()}


def test_without_training_rows_all_is_unknown(spark, documents):
    nothing = documents.limit(0)
    model = language.fit(nothing)
    assert language.identify(nothing, model).count() == 0
    assert {r.lang_pred for r in language.identify(documents.limit(5), model).collect()} == {"und"}
    nameless = documents.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert language.fit(nameless).languages == []


def test_other_latin_languages_and_random_letters_are_rejected(spark, documents, model):
    import random

    italian = "La mattina dopo la pioggia il vecchio mercato si riempie di gente che cerca il pane, la frutta e le notizie del paese. "
    polish = "Rano po deszczu stary rynek wypełnia się ludźmi, którzy szukają chleba, owoców i wiadomości z całej okolicy. "
    draw = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    noise = " ".join("".join(draw.choices(letters, k=draw.randint(2, 9))) for _ in range(400))
    texts = [italian * 3, italian * 10, polish * 3, polish * 10, noise[:300], noise[:1000], noise]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert all(r.rejected for r in language.identify(docs, model).collect())
    held = language.identify(documents, model).filter("held_out").collect()
    assert sum(r.rejected for r in held) / len(held) < 0.01


def naive_features(text):
    """Length of the folded text and the count of each n-gram number, one n-gram at a time."""
    kept = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower())
    if not any(unicodedata.category(c)[0] == "L" for c in text):
        return 0, {}
    data = f" {' '.join(kept.split())} ".encode()
    counts = defaultdict(int)
    for n in (1, 2, 3, 4):
        for i in range(len(data) - n + 1):
            mixed = (((int.from_bytes(data[i : i + n], "big") + 1) * 8 + n) * 0x9E3779B97F4A7C15) % 2**64
            counts[mixed >> (64 - language.BITS)] += 1
    return len(data), dict(counts)


def naive_unit(counts, idf):
    row = np.zeros(1 << language.BITS)
    for feature, count in counts.items():
        row[feature] = (1 + math.log(count)) * idf[feature]
    return row / math.sqrt((row * row).sum())


def naive_clusters(rows, k):
    centres = [max(rows, key=lambda r: r @ np.mean(rows, axis=0))]
    while len(centres) < min(k, len(rows)):
        centres.append(min(rows, key=lambda r: max(r @ c for c in centres)))
    for _ in range(10):
        groups = defaultdict(list)
        for r in rows:
            groups[int(np.argmax([r @ c for c in centres]))].append(r)
        means = [np.sum(groups[i], axis=0) for i in sorted(groups)]
        centres = [m / np.linalg.norm(m) for m in means]
    return centres


def test_every_score_equals_the_naive_classifier(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {r.doc_id: r for r in language.identify(docs, language.fit(docs)).collect()}
    rows = docs.select("doc_id", "text", "lang").collect()
    features = {r.doc_id: naive_features(r.text or "") for r in rows}
    learned = [
        r for r in rows
        if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang not in (None, "und")
        and features[r.doc_id][0]
    ]
    frequency = defaultdict(int)
    for r in learned:
        for feature in features[r.doc_id][1]:
            frequency[feature] += 1
    n = len(learned)
    idf = [math.log((n + 1) / (frequency[f] + 1)) + 1 for f in range(1 << language.BITS)]
    groups = defaultdict(list)
    for r in learned:
        groups[r.lang].append(r.doc_id)
    centroids = []
    for lang, members in groups.items():
        members.sort(key=lambda d: (features[d][0], np.array(
            [c for _, c in sorted(features[d][1].items())], np.float32).tobytes()))
        units = [naive_unit(features[d][1], idf) for d in members]
        centroids += [(lang, c) for c in naive_clusters(units, language.CLUSTERS)]
    assert {g for g in groups} == {lang for lang, _ in centroids}
    for r in rows:
        length, counts = features[r.doc_id]
        got = found[r.doc_id]
        if not length:
            assert (got.lang_pred, got.score, got.rejected) == ("und", 0, True)
            continue
        unit = naive_unit(counts, idf)
        scores = sorted(((unit @ c, lang) for lang, c in centroids), reverse=True)
        assert abs(got.score - min(scores[0][0], 1)) < 1e-4
        near = {lang for value, lang in scores if value > scores[0][0] - 1e-4}
        assert got.lang_pred in near


def test_the_limit_is_the_quantile_of_unseen_rows():
    """By definition: few rows, so that every text stands behind each limit."""
    rng = np.random.default_rng(5)
    rows = np.abs(rng.normal(size=(9, 1 << language.BITS))).astype(np.float32)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    nearest = language._unseen(rows, 2)
    for i, row in enumerate(rows):
        others = [r for j, r in enumerate(rows) if j % language.FOLDS != i % language.FOLDS]
        assert abs(nearest[i] - max(row @ c for c in naive_clusters(others, 2))) < 1e-4
    floor = language._floor(np.full(9, 6), nearest)
    assert (floor[:6] == 0).all() and (floor[6:] == nearest.min()).all()


def test_more_labels_than_are_learned(spark):
    rows = [(i, f"wort{chr(97 + i % 7)} text hier " * 3, f"l{i % 7}") for i in range(140)]
    rows += [(1000 + i, "another one", "l0") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(docs, max_languages=2)
    assert len(set(model.languages)) == 2 and "l0" in model.languages
    assert {r.lang_pred for r in language.identify(docs, model).collect()} <= set(model.languages)
    many = docs.selectExpr("doc_id", "text", "concat(lang, '-', doc_id) as lang")
    assert len(set(language.fit(many, max_languages=100).languages)) == 100
