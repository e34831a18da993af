from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from replenish.llm import alignment
from replenish.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES

PAIR = alignment.Pair(BYTE_BPE, PIECE_BPE)
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
LIBRARY.encode_special_tokens = True

TEXTS = [
    "", " ", "  ", "a ", " a  b ", "plain words, in a row.\nNext line " * 30, "a" * 1500 + " b",
    "word " * 3 + " " * 1200 + "x", "漢字 かな交じり文 " * 20, "😀x😀 😀", "naïve ﬁ ﬀ ① \x00 end\n\n", "\x1c a\x1d b",
    "<s></s><unk> <0x41><|endoftext|> <|endoftext|>x", "has ▁ a sign", "▁", "don't we'll I'M", "\t\ttab \u00a0 x",
]


def tokens(text: str) -> tuple[list[int], list[int]]:
    """Whole-text encodings by the libraries."""
    return LIBRARY.encode(" " + text, add_special_tokens=False).ids, PAIR.model.encode(text)


def brute(text: str | None) -> list[tuple[list[int], list[int]]]:
    """Groups by comparing the ends of all tokens."""
    if not text:
        return []
    a, b = tokens(text)
    of_a, of_b = [PAIR.a.bytes_of[i] for i in a], [PAIR.bytes_b[i] for i in b]
    if b"".join(of_a) != (" " + text).encode() or b"".join(of_b) != (" " + text).encode():
        return []
    out, i, j = [], 0, 0
    for p in range(1, len(a) + 1):
        for q in range(j + 1, len(b) + 1):
            if sum(map(len, of_a[:p])) == sum(map(len, of_b[:q])):
                out.append((a[i:p], b[j:q]))
                i, j = p, q
                break
    return out


def plain(text: str) -> list[tuple[list[int], list[int]]]:
    """As `brute`, for long texts."""
    a, b = tokens(text)
    ends = [[], []]
    for side, names in enumerate((([PAIR.a.bytes_of[i] for i in a]), [PAIR.bytes_b[i] for i in b])):
        end = 0
        for name in names:
            end += len(name)
            ends[side].append(end)
        if b"".join(names) != (" " + text).encode():
            return []
    out, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        p, q = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
        out.append((a[i:p], b[j:q]))
        i, j = p, q
    return out


def written(groups) -> str:
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def expected(rows: list[tuple[int | None, list]]) -> list[tuple]:
    counts = Counter((a[-1], b[-1]) for _, groups in rows for a, b in groups)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for key, groups in rows:
        own = [counts[a[-1], b[-1]] for a, b in groups]
        top = sum(counts[a[-1], b[-1]] == best[b[-1]] for a, b in groups)
        digest = hashlib.sha256(written(groups).encode()).hexdigest() if groups else ""
        n_a, n_b = (sum(len(g[side]) for g in groups) for side in (0, 1))
        out.append((key, n_a, n_b, len(groups), len(groups), top, sum(own), digest))
    return sorted(out, key=str)


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_groups_equal_brute_force(text):
    wanted = brute(text) if len(text) < 500 else plain(text)
    assert PAIR.groups(text) == wanted
    assert next(alignment.Aligner(PAIR).digests([text]))[3] == (
        hashlib.sha256(written(wanted).encode()).hexdigest() if wanted else ""
    )


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abthe   .,'s\n\t漢é😀1▁<|>"), max_size=120), max_size=6))
def test_random_texts(texts):
    own = alignment.Aligner(PAIR, size=20)
    for text, found in zip(texts, own.digests(texts)):
        groups = plain(text) if text else []
        assert found[2] == len(groups)
        assert found[3] == (hashlib.sha256(written(groups).encode()).hexdigest() if groups else "")


def test_long_texts_in_blocks(monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 64)
    text = "Some words are here, and others  follow.\n" * 40
    assert PAIR.groups(text) == plain(text)
    *_, digest, pairs, times = next(alignment.Aligner(PAIR).digests([text]))
    groups = plain(text)
    assert digest == hashlib.sha256(written(groups).encode()).hexdigest()
    links = Counter(a[-1] * len(PAIR.bytes_b) + b[-1] for a, b in groups)
    assert dict(zip(pairs.tolist(), times.tolist())) == links


def test_every_linked_pair_is_possible():
    assert PAIR.possible() < 400_000
    for text in TEXTS:
        for a, b in PAIR.groups(text):
            one, other = PAIR.a.bytes_of[a[-1]], PAIR.bytes_b[b[-1]]
            assert one.endswith(other) or other.endswith(one)


def test_every_token_is_its_own_encoding():
    """With this, merging by the rank of the joined bytes gives what merging by rules gives."""
    assert all(PAIR.a.encode_bytes(t) == [i] for i, t in list(PAIR.a.bytes_of.items())[:50256:7])


def test_query_equals_brute_force(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").collect()
    wanted = expected([(d.doc_id, plain(d.text) if d.text else []) for d in docs])
    rows = QUERIES["op12_alignment"](spark, path).collect()
    assert sorted((tuple(r) for r in rows), key=str) == wanted


def test_edge_rows(spark):
    rows = [(1, None, 5), (1, "", 5), (None, "a b", 6), (2, "a b", 7), (2, "a b", 7), (3, "x ▁", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, groups int")
    found = alignment.documents_digest(docs, BYTE_BPE, PIECE_BPE).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected([(k, brute(t)) for k, t, _ in rows])
    empty = alignment.documents_digest(docs.limit(0), BYTE_BPE, PIECE_BPE)
    assert empty.collect() == [] and empty.columns[0] == "doc_id"
    out = alignment.aligned(docs, BYTE_BPE, PIECE_BPE).collect()
    assert [[(g.a, g.b) for g in r.groups_] for r in out] == [brute(r.text) for r in out]
    counts = alignment.pair_counts(docs, BYTE_BPE, PIECE_BPE).collect()
    assert sum(r.total for r in counts) == 6 and all(r.best for r in counts)
