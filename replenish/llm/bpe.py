"""Byte-pair encoding as a streaming transducer with a proven lookahead, and the decoder for it.

A merge list decides how far the tokens of a text can still change when more text follows. Let a
rule r = (u, v) be applied at the edge of the text that is known so far. It makes the token u, up
to which two continuations agreed, belong to a token of only one of them, so the agreed part ends
|u| bytes earlier. The next rule that moves the edge, r' = (u', v'), comes later in the list and
its v' starts where u started, so u is a prefix of v'. The longest such chain, measured by the sum
of |u|, bounds the bytes at the end that may change: `MergeList.lookahead`. Tokens that end before
them are final and are emitted at once. The rest is encoded again together with the next bytes,
since the encoding from a final token boundary on does not depend on what stands before it.

Memory per text is the window, whatever the length of the text or of its words.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenish.llm.common import col, fresh, prepare_python

# The split of a text into words that the vocabulary was made with.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RUNS = (r"\s+", r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+")

# Characters read at a time, and bytes encoded beyond the lookahead in a window.
BLOCK = 1 << 16
WINDOW = 1 << 10
# Words whose tokens are remembered: two generations of at most so many.
REMEMBERED = 100_000

_NONE = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file: printable ones for
    themselves, the others by order from code point 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeList:
    """Vocabulary and ranked merge rules of one tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        alphabet = byte_alphabet()
        vocabulary: dict[str, int] = model["vocab"]
        self.bytes_of: dict[int, bytes] = {
            i: bytes(alphabet[c] for c in token) for token, i in vocabulary.items()
        }
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: text.encode() for text, i in self.special.items()}
        self.first = [vocabulary[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])]
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for rule in model["merges"]:
            left, right = rule.split(" ") if isinstance(rule, str) else rule
            self.rank[vocabulary[left], vocabulary[right]] = len(self.merged)
            self.merged.append(vocabulary[left + right])
        self.longest = max(map(len, self.bytes_of.values()))
        self.lookahead = self._sufficient_lookahead()

    def _sufficient_lookahead(self) -> int:
        """Length of the longest chain of rules that can move the edge of the agreed text.

        Needs a proper list: every token is made by one rule, after its two parts.
        """
        made = set(self.first)
        reach: dict[bytes, int] = {}  # left part -> longest chain that ends in a rule with it
        for (left, right), rank in self.rank.items():
            if left not in made or right not in made or self.merged[rank] in made:
                raise ValueError("the merge list is not proper; no lookahead can be given")
            made.add(self.merged[rank])
            u, v = self.bytes_of[left], self.bytes_of[right]
            before = max((reach.get(v[:n], 0) for n in range(1, len(v) + 1)), default=0)
            reach[u] = max(reach.get(u, 0), before + len(u))
        return max(reach.values(), default=0)

    def encode_bytes(self, data: bytes) -> list[int]:
        """Tokens of one word: the best-ranked pair is merged, leftmost first, until none is left."""
        merged, get = self.merged, self.rank.get
        ids = list(map(self.first.__getitem__, data))
        ranks = list(map(get, zip(ids, ids[1:]), repeat(_NONE)))
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            k = ranks.index(best)
            ids[k] = merged[best]
            del ids[k + 1], ranks[k]
            if k:
                ranks[k - 1] = get((ids[k - 1], ids[k]), _NONE)
            if k < len(ranks):
                ranks[k] = get((ids[k], ids[k + 1]), _NONE)
        return ids


class Remembered(dict):
    """Word -> its tokens as little-endian 32-bit integers. Frequent words survive the turnover."""

    def __init__(self, merges: MergeList, size: int = REMEMBERED) -> None:
        super().__init__()
        self.merges, self.size, self.older = merges, size, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            if len(word) > WINDOW:
                return self._long(word)
            ids = self.merges.encode_bytes(word.encode())
            found = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found

    def _long(self, word: str) -> bytes:
        stream = WordStream(self.merges)
        parts = [stream.push(word[i : i + WINDOW].encode()) for i in range(0, len(word), WINDOW)]
        return b"".join([*parts, stream.finish()])


class WordStream:
    """Encodes one word of any length from its bytes, in a window."""

    def __init__(self, merges: MergeList) -> None:
        self.merges, self.rest = merges, b""
        self.window = merges.lookahead + max(WINDOW, 2 * merges.longest)

    def push(self, data: bytes) -> bytes:
        """Takes more bytes, gives the tokens that are final by now."""
        self.rest += data
        out = []
        while len(self.rest) >= self.window:
            out.append(self._emit(self.rest[: self.window], self.merges.lookahead))
        return b"".join(out)

    def finish(self) -> bytes:
        return self._emit(self.rest, 0) if self.rest else b""

    def _emit(self, data: bytes, open_bytes: int) -> bytes:
        ids, length, end = self.merges.encode_bytes(data), self.merges.bytes_of, 0
        for n, token in enumerate(ids):
            if end + len(length[token]) > len(data) - open_bytes:
                ids = ids[:n]
                break
            end += len(length[token])
        self.rest = self.rest[end:]
        return np.array(ids, dtype="<u4").tobytes()


class Encoder:
    """Text in chunks -> tokens in chunks. Holds back only what later text can still change."""

    pieces = regex.compile(PIECES)
    runs = [regex.compile(r) for r in RUNS]

    def __init__(self, merges: MergeList, words: Remembered) -> None:
        self.merges, self.words = merges, words
        self.text = ""  # not yet split
        self.stream: WordStream | None = None  # of a word that is longer than a block
        self.run = self.runs[0]
        specials = sorted(merges.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.held = max(map(len, specials), default=1) - 1

    def push(self, chunk: str) -> Iterator[bytes]:
        self.text += chunk
        yield from self._segments(last=False)

    def finish(self) -> Iterator[bytes]:
        yield from self._segments(last=True)

    def _segments(self, last: bool) -> Iterator[bytes]:
        """Special tokens end the text before them; what may become one waits."""
        while self.special and (found := self.special.search(self.text)):
            after = self.text[found.end() :]
            self.text = self.text[: found.start()]
            yield from self._split(last=True)
            self.text = after
            yield np.array([self.merges.special[found[0]]], dtype="<u4").tobytes()
        if last:
            yield from self._split(last=True)
            return
        keep = next(
            (n for n in range(min(self.held, len(self.text)), 0, -1) if self._may_begin(n)), 0
        )
        waiting = self.text[len(self.text) - keep :]
        self.text = self.text[: len(self.text) - keep]
        yield from self._split(last=False)
        self.text += waiting

    def _may_begin(self, n: int) -> bool:
        return any(s.startswith(self.text[-n:]) for s in self.merges.special)

    def _split(self, last: bool) -> Iterator[bytes]:
        if self.stream is not None:
            yield self._continue(last)
            if self.stream is not None:
                return
        if last:
            words, self.text = self.pieces.findall(self.text), ""
            yield b"".join(map(self.words.__getitem__, words))
            return
        # Later text changes at most the last two words: "'" + "l" may become "'ll".
        words = self.pieces.findall(self.text)
        open_words = words[-2:]
        yield b"".join(map(self.words.__getitem__, words[:-2]))
        self.text = "".join(open_words)
        if open_words and len(open_words[-1]) >= BLOCK:
            yield b"".join(map(self.words.__getitem__, open_words[:-1]))
            self.text = open_words[-1]
            self.run = next(r for r in self.runs if r.fullmatch(self.text, pos=1))
            self.stream = WordStream(self.merges)
            head, self.text = self.text[0], self.text[1:]
            yield self.stream.push(head.encode()) + self._continue(False)

    def _continue(self, last: bool) -> bytes:
        """Feeds the open word. The last character of a white-space run belongs to the next word
        unless the text ends, so it waits."""
        found = self.run.match(self.text)
        end = found.end() if found else 0
        over = last or end < len(self.text)
        if self.run is self.runs[0] and end and not (last and end == len(self.text)):
            end -= 1
        out = self.stream.push(self.text[:end].encode())
        self.text = self.text[end:]
        if over:
            out += self.stream.finish()
            self.stream = None
        return out


class Decoder:
    """Tokens in chunks -> text in chunks; a byte sequence that is cut waits for its rest, and an
    invalid one becomes U+FFFD."""

    def __init__(self, merges: MergeList) -> None:
        self.bytes_of = merges.bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def push(self, ids: Iterable[int], last: bool = False) -> str:
        return self.state.decode(b"".join(map(self.bytes_of.__getitem__, ids)), last)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> tuple[MergeList, Remembered]:
    merges = MergeList(path)
    return merges, Remembered(merges)


def token_blocks(text: str, merges: MergeList, words: Remembered) -> Iterator[bytes]:
    encoder = Encoder(merges, words)
    for start in range(0, len(text), BLOCK):
        yield from encoder.push(text[start : start + BLOCK])
    yield from encoder.finish()


def _id_lists(blocks: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0, *(len(b) // 4 for b in blocks)], dtype=np.int32)
    values = np.frombuffer(b"".join(blocks), dtype="<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def encode(text: Column, path: str) -> Column:
    """Tokens of a text column, as array<int>; null is encoded as the empty text."""

    @F.arrow_udf("array<int>")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merges, words = tokenizer(path)
        for batch in batches:
            yield _id_lists(
                [b"".join(token_blocks(t.as_py() or "", merges, words)) for t in batch]
            )

    return tokens(text.cast("string"))


def decode(ids: Column, path: str) -> Column:
    """Text of a column of token arrays; null gives the empty text."""

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merges, _ = tokenizer(path)
        for batch in batches:
            yield pa.array(
                [Decoder(merges).push(t.as_py() or (), last=True) for t in batch], pa.string()
            )

    return texts(ids)


def round_trip(text: Column, path: str) -> Column:
    """Struct of n_tokens, ids_sha256 and decoded_sha256 of a text column.

    Tokens go from the encoder to the decoder block by block; neither the token list nor the
    decoded text is ever held whole.
    """

    @F.arrow_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merges, words = tokenizer(path)
        for batch in batches:
            rows = [_digest(token_blocks(t.as_py() or "", merges, words), merges) for t in batch]
            yield pa.StructArray.from_arrays(
                _columns(rows), ["n_tokens", "ids_sha256", "decoded_sha256"]
            )

    return digests(text.cast("string"))


def _digest(blocks: Iterable[bytes], merges: MergeList) -> tuple[int, str, str]:
    ids, decoded, n = hashlib.sha256(), hashlib.sha256(), 0
    decoder = Decoder(merges)
    for block in blocks:
        ids.update(block)
        n += len(block) // 4
        decoded.update(decoder.push(np.frombuffer(block, dtype="<u4").tolist()).encode())
    decoded.update(decoder.push((), last=True).encode())
    return n, ids.hexdigest(), decoded.hexdigest()


def _columns(rows: list[tuple[int, str, str]]) -> list[pa.Array]:
    kinds = (pa.int64(), pa.string(), pa.string())
    return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]


def encoded_documents(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`docs` with token_ids (array<int>), n_tokens, ids_sha256 and decoded_sha256 added.

    A null text has no tokens. Columns of `docs` that already have these names keep them; the new
    ones then get underscores at the end.
    """
    prepare_python(docs.sparkSession)

    @F.arrow_udf(
        "token_ids array<int>, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merges, words = tokenizer(path)
        for batch in batches:
            blocks = [list(token_blocks(t.as_py() or "", merges, words)) for t in batch]
            rows = [_digest(b, merges) for b in blocks]
            yield pa.StructArray.from_arrays(
                [_id_lists([b"".join(b) for b in blocks]), *_columns(rows)],
                ["token_ids", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    found = fresh(docs, "coded")
    names = ["token_ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    return docs.withColumn(found, coded(col(text).cast("string"))).select(
        *map(col, docs.columns), *[col(found)[n].alias(fresh(docs, n)) for n in names]
    )


def documents_digest(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: its key, and the digests of its tokens and of the text decoded
    from them. Keys may repeat or be null; null text counts as empty."""
    prepare_python(docs.sparkSession)
    coded = docs.select(col(key).alias("doc_id"), round_trip(col(text), path).alias("coded"))
    return coded.select("doc_id", "coded.*")
