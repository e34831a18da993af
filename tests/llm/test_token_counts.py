from __future__ import annotations

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from replenish.llm.token_counts import Counter, count_tokens, documents_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
SMALL = Counter(PATH, chunk=48, overlap=2)

TEXTS = [
    "", " ", "plain words in a row " * 40, "a" * 700, "aaaa bbbb" * 90, " " * 400 + "x" + " " * 300,
    "漢字かな交じり文" * 60, "😀x😀😀" * 80, "naïve ﬁ ﬀ ① \x00 end\n\n" * 30, "<s></s><unk><0x41>" * 20,
    "thereuponwithoutaspace" * 40, "▁▁ ▁a" * 60, "\n" * 300, "123456789" * 60, "é" * 300 + " z" * 100,
]


def library(text: str) -> int:
    return len(SMALL.model.encode(text))


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_spliced_counts_equal_the_library(text):
    assert SMALL.counts([text]) == [library(text)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("abthe  .\n漢é😀1▁<s>"), max_size=400))
def test_random_texts(text):
    assert SMALL.counts([text]) == [library(text)]


def test_default_chunks_on_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    long = docs.unionByName(docs.limit(0)).selectExpr(
        "doc_id", "text", "repeat(text, 6) as n_tokens", "1 as n_bytes"
    )
    rows = documents_counts(long, PATH).collect()
    texts = {r.doc_id: r for r in long.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id].text
        assert r.n_tokens == library(text) and r.n_bytes == len(text.encode())
        assert r.over_limit == (r.n_tokens > 4096)
    big = long.select(count_tokens(long.n_tokens, PATH).alias("n"), "n_tokens").limit(200).collect()
    assert all(r.n == library(r.n_tokens) for r in big)


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "a b"), (2, "x"), (2, "x")], "doc_id bigint, text string")
    rows = sorted(documents_counts(docs, PATH).collect(), key=str)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == [
        ("1", 0, 0), ("1", 0, 0), ("2", 1, 1), ("2", 1, 1), ("None", 3, 2),
    ]
    assert documents_counts(docs.limit(0), PATH).count() == 0
