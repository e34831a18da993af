from __future__ import annotations

from collections import Counter

import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from replenish.llm import language

from test_exact_dedup import brute as exact
from test_mixing import WORD, targets
from test_near_dedup import brute as near

DATA = "/root/testdata/sf0.01"
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def staged(spark, docs):
    """The rows before each stage and after the last."""
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.materialise(stage(spark, out[-1], DATA)))
    return out


def check(spark, docs):
    frames = staged(spark, docs)
    for frame in frames[:-1]:
        assert frame.columns == docs.columns
    every, known, unique, distinct, mixed, coded = (f.collect() for f in frames)
    letters = [r for r in every if r.text and any(c.isalpha() for c in r.text)]
    assert Counter(known) <= Counter(letters)

    groups = exact([(r.doc_id, r.text) for r in known])
    assert sorted(str(r.doc_id) for r in unique) == sorted(str(g[0]) for g in groups if g[3])

    groups = near([(r.doc_id, r.text) for r in unique], corpus_pipeline.NEAR)
    assert len(distinct) == len({g[2] for g in groups if g[1]}) + sum(not g[1] for g in groups)
    assert {r.doc_id for r in distinct if r.doc_id is not None} <= {g[0] for g in groups if g[3]}

    sizes, taken = Counter(), Counter()
    for rows, into in ((distinct, sizes), (mixed, taken)):
        for r in rows:
            into[r.source] += len(WORD.findall(r.text))
    copies = Counter(mixed)
    assert copies.keys() <= set(distinct) and max(copies.values(), default=0) <= 3
    for source, target in targets(sizes).items() if sizes else ():
        smallest = min(len(WORD.findall(r.text)) for r in distinct if r.source == source)
        assert abs(taken[source] - target) <= max(0.05 * sizes[source], smallest)

    assert Counter(r[: len(docs.columns)] for r in coded) == Counter(map(tuple, mixed))
    for r in coded:
        assert r.token_ids == LIBRARY.encode(r.text, add_special_tokens=False).ids
    return frames


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    frames = check(spark, docs)
    model = language.fit(docs)
    rejected = language.identify(docs, model).filter("rejected").count()
    assert frames[1].count() == docs.count() - rejected
    assert rejected < 0.01 * docs.count()


def test_run_equals_the_stages(spark):
    docs = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    again = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert docs.count() > 0 and docs.exceptAll(again).count() == again.exceptAll(docs).count() == 0


@pytest.mark.parametrize("labelled", [True, False])
def test_edge_rows(spark, labelled):
    prose = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").filter("lang = 'en'").limit(40).collect()]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(prose)]
    rows += [(100, None, "en", "s0"), (101, "", None, "s0"), (102, " \n", "en", None), (103, "12 34 !!", "en", "s1"),
             (None, prose[0], "en", "s1"), (None, prose[1] + " more", None, None), (104, prose[2].replace(" ", "\t"), "en", "s2"),
             (105, prose[3] * 400, "en", "s2"), (3, prose[3], "en", "s0"), (3, prose[3], "en", "s0")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").selectExpr(
        "doc_id", "text", "if(%s, lang, null) as lang" % str(labelled).lower(), "source", "1 as `odd.name`",
        "'x' as text_sha256", "2 as text_key", "3 as n_tokens", "4 as own_key", "5 as copies", "6 as mix_turn",
    )
    check(spark, docs)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    assert [f.count() for f in staged(spark, docs)] == [0] * 6
