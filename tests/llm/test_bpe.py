from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from replenish.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
MERGES, WORDS = bpe.tokenizer(PATH)
LIBRARY = Tokenizer.from_file(PATH)

TEXTS = [
    "", " ", "\n\n", "a  b", "it's we'll 'll 'l ' 've", "x<|endoftext|>  <|endoftext|> y <|endo",
    "1234567 ½ ² Ⅻ", "tab\t\tnew\r\n  ", "naïve café — 漢字かな 😀😀👩‍👩‍👧", "a" * 5000, " " * 3001 + "x",
    "ab" * 4000 + "!?" * 3000, "\x00\x1c\x1d\x85\xa0 　z", "é" * 2500, "'" * 999 + "ll",
]


def ids_of(blocks) -> list[int]:
    return np.frombuffer(b"".join(blocks), dtype="<u4").tolist()


def library(text: str) -> list[int]:
    return LIBRARY.encode(text, add_special_tokens=False).ids


def in_chunks(text: str, size: int) -> list[int]:
    encoder = bpe.Encoder(MERGES, WORDS)
    blocks = [b for i in range(0, len(text), size) for b in encoder.push(text[i : i + size])]
    return ids_of([*blocks, *encoder.finish()])


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_tokens_equal_the_library_and_decode_back(text):
    assert ids_of(bpe.token_blocks(text, MERGES, WORDS)) == library(text)
    for size in (1, 2, 7):
        if len(text) < 700 * size:
            assert in_chunks(text, size) == library(text)
    decoder = bpe.Decoder(MERGES)
    assert "".join([decoder.push([i]) for i in library(text)]) + decoder.push((), True) == text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab 'lsvre1½\n\t é漢😀<|endoftext>!"), max_size=60), st.integers(1, 9))
def test_any_cut_of_the_text_gives_the_same_tokens(text, size):
    assert in_chunks(text, size) == library(text)


@pytest.mark.parametrize("run", ["ab", " ", "\n ", "7", "?!", "the", "é"])
def test_words_longer_than_a_block_are_streamed(monkeypatch, run):
    monkeypatch.setattr(bpe, "BLOCK", 64)
    monkeypatch.setattr(bpe, "WINDOW", 32)
    text = "start " + run * 1200 + " end" + run * 700
    assert ids_of(bpe.token_blocks(text, MERGES, bpe.Remembered(MERGES))) == library(text)


def test_lookahead_is_sufficient_on_adversarial_tails():
    rng = np.random.default_rng(5)
    tokens = [t for t in MERGES.bytes_of.values() if t.isalpha()]
    for _ in range(150):
        word = b"".join(tokens[i] for i in rng.integers(0, len(tokens), 40))
        cut = int(rng.integers(1, len(word)))
        known, whole = MERGES.encode_bytes(word[:cut]), MERGES.encode_bytes(word)
        end = 0
        for a, b in zip(known, whole):
            end += len(MERGES.bytes_of[a])
            if end > cut - MERGES.lookahead:
                break
            assert a == b


def test_memory_of_a_stream_is_the_window():
    stream = bpe.WordStream(MERGES)
    for _ in range(300):
        stream.push(b"thereupon" * 40)
        assert len(stream.rest) < stream.window


def test_decoder_replaces_cut_sequences_like_the_library():
    for ids in ([MERGES.first[0xE6]], [MERGES.first[0xE6], MERGES.first[0xBC], MERGES.first[65]], [50256, 0]):
        assert bpe.Decoder(MERGES).push(ids, True) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_documents(spark):
    rows = [(i, t) for i, t in enumerate([*TEXTS[:12], None, "", "same", "same"])] + [(None, "no id"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as n_tokens", "'x' as coded")
    got = {(r.doc_id, r.ids_sha256): r for r in bpe.documents_digest(docs, PATH).collect()}
    assert len(got) == len(rows)
    for key, text in rows:
        ids = np.array(library(text or ""), dtype="<u4")
        row = got[key, hashlib.sha256(ids.tobytes()).hexdigest()]
        assert row.n_tokens == len(ids)
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    coded = bpe.encoded_documents(docs, PATH)
    assert coded.columns == [*docs.columns, "token_ids", "n_tokens_", "ids_sha256", "decoded_sha256"]
    back = coded.select("*", bpe.decode(coded.token_ids, PATH).alias("back")).collect()
    assert all((r.text or "") == r.back and r.n_tokens_ == len(r.token_ids) for r in back)
    assert all(r.token_ids == library(r.text or "") for r in back)
    plain = docs.select("text", bpe.encode(docs.text, PATH).alias("ids")).collect()
    assert all(r.ids == library(r.text or "") for r in plain)
    assert bpe.documents_digest(docs.limit(0), PATH).count() == 0
    assert bpe.encoded_documents(docs.limit(0), PATH).count() == 0


def test_every_character_is_of_the_same_class_as_in_the_library():
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    for start in range(0, len(points), 2000):
        text = "".join(f"a{chr(p)}1{chr(p)}{chr(p)}!" for p in points[start : start + 2000])
        assert ids_of(bpe.token_blocks(text, MERGES, WORDS)) == library(text)
