"""Hashed n-gram features of whole texts, computed on the bytes of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex

LETTER = regex.compile(r"\p{L}")
# Bytes hashed at once; a longer text is counted in such steps.
STEP = 1 << 16

_MIX = np.uint64(0x9E3779B97F4A7C15)


def folded(text: str) -> bytes:
    """Lower-case letters with one space between words; everything else is a space."""
    return b" " + _NOT_LETTER.sub(" ", text.lower()).strip().encode() + b" "


_NOT_LETTER = regex.compile(r"[^\p{L}\p{M}]+")


def texts(batch: pa.Array) -> Iterator[str]:
    for value in batch:
        yield value.as_py() or ""


def codes(data: bytes, sizes: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """Feature numbers below 2**bits of all byte n-grams, step by step; the first size + 1 values
    of a number depend on the size, so n-grams of different sizes do not share a feature by rule."""
    raw = np.frombuffer(data, dtype=np.uint8)
    shift = np.uint64(64 - bits)
    longest = max(sizes)
    for start in range(0, max(len(raw), 1), STEP):
        part = raw[start : start + STEP + longest - 1].astype(np.uint64)
        gram = np.zeros(len(part), dtype=np.uint64)
        for n in range(1, longest + 1):
            if len(part) < n:
                break
            gram = (gram[: len(part) - n + 1] << np.uint64(8)) | part[n - 1 :]
            if n in sizes:
                own = gram[: min(STEP, len(raw) - start)]
                yield ((((own + np.uint64(1)) << np.uint64(3)) + np.uint64(n)) * _MIX) >> shift


def counts(data: bytes, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    total = np.zeros(1 << bits, dtype=np.float32)
    for part in codes(data, sizes, bits):
        total += np.bincount(part.astype(np.int64), minlength=1 << bits)
    return total
