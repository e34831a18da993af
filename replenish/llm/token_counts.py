"""Exact token counts; huge texts are encoded in overlapping chunks that are spliced.

Where two characters meet that stand side by side in no piece of the vocabulary, no token can span
the place: it is a token boundary in every text and in every chunk. The encoding of a text from a
boundary on does not depend on what stands before. So two overlapping chunks may be spliced at a
place of this kind that is a boundary in both encodings (offsets come from the library): tokens
before it are taken from the left chunk, tokens after it from the right one. An overlap that holds
no such place is doubled, and the right chunk is encoded again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from replenish.llm.common import col, prepare_python

# Characters of a chunk, and of the first overlap tried.
CHUNK = 1 << 14
OVERLAP = 1 << 7

_SPACE = "▁"  # stands for a space in pieces


class Counter:
    """Counts the tokens of texts with one sentencepiece model.

    The model has to leave characters as they are (identity normalisation) and to spell unknown
    ones in bytes.
    """

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        self.model = SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk, min(overlap, chunk // 2)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.adjacent = {pair for piece in pieces for pair in zip(piece, piece[1:])}
        sample = "ﬁ ①Ａ  é"
        if self.model.normalize(sample).lstrip(_SPACE) != sample.replace(" ", _SPACE):
            raise ValueError("the model changes characters; offsets would not be those of the text")
        if not any(self.model.IsByte(i) for i in range(len(pieces))):
            raise ValueError("the model merges unknown characters; their borders are not stable")

    def counts(self, texts: list[str]) -> list[int]:
        short = [t if len(t) <= self.chunk else "" for t in texts]
        found = [len(ids) for ids in self.model.encode(short, return_type=int, num_threads=1)]
        return [n if len(t) <= self.chunk else self.spliced(t) for n, t in zip(found, texts)]

    def stable(self, text: str, at: int) -> bool:
        pair = text[at - 1 : at + 1].replace(" ", _SPACE)
        return (pair[0], pair[1]) not in self.adjacent

    def boundaries(self, text: str, start: int, end: int, low: int, high: int) -> dict[int, int]:
        """Token boundaries of text[start:end] in [low, high]: position in the text -> tokens of
        the chunk before it. The end of the chunk comes with all its tokens."""
        part = text[start:end]
        pieces = self.model.encode(part, return_type="proto").pieces
        begins = np.fromiter((p.begin for p in pieces), dtype=np.int64, count=len(pieces))
        # Tokens that spell one character in bytes share its offset; only the first begins there.
        first = np.flatnonzero(np.diff(begins, prepend=-1) > 0)
        raw = np.frombuffer(part.encode(), dtype=np.uint8)
        characters = np.cumsum((raw & 0xC0) != 0x80)  # offsets are in bytes
        at = {start + int(characters[begins[i]]) - 1: int(i) for i in first}
        return {p: n for p, n in at.items() if low <= p <= high} | {end: len(pieces)}

    def spliced(self, text: str) -> int:
        """Tokens of a text longer than a chunk."""
        total, base, start, end = 0, 0, 0, self.chunk
        left = self.boundaries(text, base, end, base, end)
        before = 0  # tokens of the left chunk that lie before the last splice
        while end < len(text):
            far, overlap, joined = min(end + self.chunk, len(text)), self.overlap, None
            while joined is None:
                again = max(start, end - overlap)
                right = self.boundaries(text, again, far, again, far)
                joined = next(
                    (
                        p
                        for p in range(end - 1, again, -1)
                        if p in left and p in right and self.stable(text, p)
                    ),
                    None,
                )
                if joined is None and again == start:
                    break
                overlap *= 2
            if joined is None:
                # No safe place since the last splice: the left chunk itself grows, to double size.
                end = min(end + (end - base), len(text))
                left = self.boundaries(text, base, end, start, end)
                before = left[start] if start > base else 0
            else:
                total += left[joined] - before
                left, before = right, right[joined]
                base, start, end = again, joined, far
        return total + left[end] - before


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(text: Column, path: str) -> Column:
    """Tokens of a text column without begin, end or other added tokens; null counts as empty."""

    @F.arrow_udf("bigint")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(path)
        for batch in batches:
            yield pa.array(own.counts([t or "" for t in batch.to_pylist()]), pa.int64())

    return counted(text.cast("string"))


def documents_counts(
    docs: DataFrame, path: str, limit: int = 4096, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, over_limit. Keys may repeat or be
    null; an empty table gives no rows."""
    prepare_python(docs.sparkSession)
    return docs.select(
        col(key).alias("doc_id"),
        F.coalesce(F.octet_length(col(text).cast("string")), F.lit(0)).cast("bigint").alias("n_bytes"),
        count_tokens(col(text), path).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
