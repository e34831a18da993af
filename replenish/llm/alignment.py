"""Alignment of two tokenizers: groups of tokens that end together, and how often ids are linked.

Both tokenizers read a space and the text. The cumulative byte ends of either token list go into a
dictionary from end to index; the intersection of the key sets are the ends they share. In sorted
order these keys slice both lists into groups; the last tokens of a group end together, which links
them (tokens are never empty, so nothing else ends there).

A text is cut into units, at every space that follows a character which is neither white space nor
the sign for a space: no word of the byte tokenizer spans such a place, and no piece of the other
vocabulary holds that sign after another character (`Pair` looks for them). So either encoding of a
text is that of its units, each with its space in front, one after the other, and a cut is an end
in both. Units that a worker has not met are encoded and sliced together, as one text; what they
add to a text is remembered. A text needs memory for a block of units and for its distinct pairs; a
stretch without any cut is one unit of any length.

Two tokens that end together are suffixes of one another. That bounds the pairs of ids by the
vocabularies (`Pair.possible`), whatever the size of the corpus, and so the table of their counts.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from replenish.llm import bpe
from replenish.llm.common import col, fresh, prepare_python
from replenish.operators.scale import BROADCAST_ROWS, materialise

# Characters of a block; units remembered (two generations of so many), and the longest of them.
BLOCK = 1 << 16
REMEMBERED = 100_000
SHORT = 64

_SPACE = "▁"  # stands for a space in pieces
# Words from this length on are encoded in a window: the library's time grows with their square.
_LONG = 1000

class Pair:
    """Tokenizer A (byte-level merge list) and tokenizer B (sentencepiece with byte fallback)."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a = bpe.MergeList(a_path)
        self.words = bpe.Remembered(self.a)
        plain = {t: i for i, t in self.a.bytes_of.items() if i not in self.a.special.values()}
        if self.a.merged != sorted(self.a.merged):
            raise ValueError("ids are not in the order of the merges")
        self.library = tiktoken.Encoding(
            "a", pat_str=bpe.PIECES, mergeable_ranks=plain, special_tokens={}
        )
        self.model = SentencePieceProcessor(model_file=b_path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.model.IsByte(i) else p.replace(_SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.bytes_a = [self.a.bytes_of.get(i, b"") for i in range(max(self.a.bytes_of) + 1)]
        self.sizes = [np.array([len(t) for t in own]) for own in (self.bytes_a, self.bytes_b)]
        # Ids in decimal, with the sign inside a group and the one at the end of their side of it.
        self.names = [
            np.array([[f"{i}{sign}" for i in range(len(own))] for sign in signs], dtype=object)
            for own, signs in ((self.bytes_a, ",|"), (self.bytes_b, ",;"))
        ]
        before = {c for p in pieces for c, d in zip(p, p[1:]) if d == _SPACE} | {_SPACE}
        held = "".join(map(re.escape, sorted(before)))
        self.cut = re.compile(rf"(?<=[^\s{held}]) (?=[\s\S])")
        self.open_end = re.compile(rf"[\s{held}]\Z")

    def possible(self) -> int:
        """The most pairs of ids that can ever be linked: one token is a suffix of the other."""
        spelled, own = Counter(self.bytes_b), set(self.bytes_a)
        found = sum(spelled[t[i:]] for t in self.bytes_a for i in range(len(t)))
        return found + sum(t[i:] in own for t in self.bytes_b for i in range(1, len(t)))

    def blocks(self, text: str) -> Iterator[list[str]]:
        """The units of a text, in blocks."""
        start = 0
        while start < len(text):
            found = self.cut.search(text, start + BLOCK) if len(text) - start > BLOCK else None
            end = found.start() if found else len(text)
            yield self.cut.split(text[start:end])
            start = end + 1

    def encoded(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """The tokens of a text by A and by B, None where B does not spell it. Byte-level tokens
        always do."""
        spaced = " " + text
        b = self.model.encode(text, return_type=int)
        if b"".join(map(self.bytes_b.__getitem__, b)) != spaced.encode():
            return None
        if self._has_long_word(text):
            words = bpe.Encoder.pieces.findall(spaced)
            a = np.frombuffer(b"".join(map(self.words.__getitem__, words)), dtype="<u4")
        else:
            a = self.library.encode_to_numpy(spaced, disallowed_special=())
        return a.astype(np.int64), np.array(b, dtype=np.int64)

    @staticmethod
    def _has_long_word(text: str) -> bool:
        """May be true without one, never false with one."""
        if len(text) < _LONG:
            return False
        lengths = list(map(len, text.split()))
        return len(text) - sum(lengths) - len(lengths) >= _LONG - 1 or max(lengths, default=0) >= _LONG

    def slices(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the groups of two token lists end: in bytes, and as indices in `a` and in `b`."""
        index_a, index_b = (
            dict(zip(sizes[ids].cumsum().tolist(), range(1, len(ids) + 1)))
            for sizes, ids in zip(self.sizes, (a, b))
        )
        shared = sorted(index_a.keys() & index_b.keys())
        return (
            np.array(shared, dtype=np.int64),
            *(
                np.fromiter(map(index.__getitem__, shared), dtype=np.int64, count=len(shared))
                for index in (index_a, index_b)
            ),
        )

    def groups(self, text: str) -> list[tuple[list[int], list[int]]]:
        """The groups of a text, none where a tokenizer does not spell it."""
        out = []
        for units in self.blocks(text):
            if (tokens := self.encoded(" ".join(units))) is None:
                return []
            _, *ends = self.slices(*tokens)
            out += zip(*([p.tolist() for p in np.split(t, e[:-1])] for t, e in zip(tokens, ends)))
        return out

    def signed(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> list[str]:
        """All ids in decimal, in the order `a1,a2|b1;a3|b2,b3;`, each with the sign that follows."""
        out = np.empty(len(a) + len(b), dtype=object)
        starts_a, starts_b = (np.concatenate([[0], e[:-1]]) for e in (ends_a, ends_b))
        for ids, ends, starts, shift, names in (
            (a, ends_a, starts_a, starts_b, self.names[0]),
            (b, ends_b, starts_b, ends_a, self.names[1]),
        ):
            last = np.zeros(len(ids), dtype=np.int64)
            last[ends - 1] = 1
            out[np.arange(len(ids)) + shift.repeat(ends - starts)] = names[last, ids]
        return out.tolist()

    def described(self, units: list[str]) -> list[Unit | None]:
        """What each unit adds to a text. All but the last have to end where a cut can follow."""
        if (tokens := self.encoded(" ".join(units))) is None:
            return [None] if len(units) == 1 else [x for u in units for x in self.described([u])]
        a, b = tokens
        bytes_, ends_a, ends_b = self.slices(a, b)
        own = np.cumsum([len(u.encode()) + 1 for u in units])
        group = np.searchsorted(bytes_, own) + 1  # groups up to the end of each unit
        to_a, to_b = ends_a[group - 1], ends_b[group - 1]
        written = self.signed(a, b, ends_a, ends_b)
        links = (a[ends_a - 1] * len(self.bytes_b) + b[ends_b - 1]).tobytes()
        bounds = [np.concatenate([[0], x]).tolist() for x in (to_a, to_b, group)]
        return [
            (j - i, l - k, n - m, "".join(written[i + k : j + l])[:-1], links[8 * m : 8 * n])
            for i, j, k, l, m, n in zip(*(x for own in bounds for x in (own, own[1:])))
        ]


# Tokens by A and by B, groups, the groups in decimal, the linked pairs as 64-bit integers.
Unit = tuple[int, int, int, str, bytes]
_NONE = np.zeros(0, dtype=np.int64)
_NOTHING = (0, 0, 0, "", _NONE, _NONE)


class Aligner:
    """Aligns texts and remembers frequent units."""

    def __init__(self, pair: Pair, size: int = REMEMBERED) -> None:
        self.pair, self.size = pair, size
        self.known: dict[str, Unit | None] = {}
        self.older: dict[str, Unit | None] = {}

    def digests(self, texts: list[str]) -> Iterator[tuple]:
        """The digest of each text; short ones meet their new units together."""
        few, size = [], 0
        for text in texts:
            few.append(text)
            size += len(text)
            if size >= BLOCK:
                yield from self._digests(few)
                few, size = [], 0
        yield from self._digests(few)

    def _digests(self, texts: list[str]) -> Iterator[tuple]:
        short = [next(self.pair.blocks(t), []) if len(t) <= BLOCK else None for t in texts]
        self._learn([u for units in short for u in units or ()])
        found = [
            None if units is None else self._sum(map(self.known.__getitem__, units))
            for units in short
        ]
        self._forget()
        for text, own in zip(texts, found):
            yield self._long(text) if own is None else own

    def _learn(self, units: list[str]) -> None:
        new, last = [], []
        for unit in set(units).difference(self.known):
            if unit in self.older:
                self.known[unit] = self.older[unit]
            else:
                (last if self.pair.open_end.search(unit) else new).append(unit)
        if new:
            self.known.update(zip(new, self.pair.described(new)))
        for unit in last:
            self.known[unit] = self.pair.described([unit])[0]

    def _forget(self) -> None:
        if len(self.known) >= self.size:
            self.older = {u: x for u, x in self.known.items() if len(u) <= SHORT}
            self.known = {}

    @staticmethod
    def _sum(units: Iterator[Unit | None]) -> tuple:
        """n_a, n_b, n_groups, groups_sha256, pairs and how often each is linked."""
        units = list(units)
        if not units or None in units:
            return _NOTHING
        n_a, n_b, n_groups, written, links = zip(*units)
        pairs, times = np.unique(np.frombuffer(b"".join(links), dtype=np.int64), return_counts=True)
        digest = hashlib.sha256(";".join(written).encode()).hexdigest()
        return sum(n_a), sum(n_b), sum(n_groups), digest, pairs, times

    def _long(self, text: str) -> tuple:
        """The digest of a text of several blocks."""
        n_a = n_b = n_groups = 0
        hashed, pairs, times = hashlib.sha256(), _NONE, _NONE
        for number, units in enumerate(self.pair.blocks(text)):
            self._learn(units)
            found = [self.known[u] for u in units]
            self._forget()
            own = self._sum(found)
            if own is _NOTHING:
                return _NOTHING
            n_a, n_b, n_groups = n_a + own[0], n_b + own[1], n_groups + own[2]
            hashed.update((";" if number else "").encode() + ";".join(u[3] for u in found).encode())
            joined, at = np.unique(np.concatenate([pairs, own[4]]), return_inverse=True)
            total = np.zeros(len(joined), dtype=np.int64)
            np.add.at(total, at, np.concatenate([times, own[5]]))
            pairs, times = joined, total
        return n_a, n_b, n_groups, hashed.hexdigest(), pairs, times


@lru_cache(maxsize=1)
def pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(pair(a_path, b_path))


def aligned(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """`docs` with their groups added: array<struct<a: array<int>, b: array<int>>>, in order.

    Null and empty texts, and texts that a tokenizer does not spell as they are, have none. A column of
    that name stays; the new one then gets an underscore.
    """
    prepare_python(docs.sparkSession)

    @F.arrow_udf("array<struct<a: array<int>, b: array<int>>>")
    def grouped(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = pair(a_path, b_path)
        kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        for batch in batches:
            rows = [
                [{"a": a, "b": b} for a, b in own.groups(value.as_py() or "")] for value in batch
            ]
            yield pa.array(rows, kind)

    return docs.withColumn(fresh(docs, "groups"), grouped(col(text).cast("string")))


def _digests(text: Column, a_path: str, b_path: str) -> Column:
    names = ["n_a", "n_b", "n_groups", "groups_sha256", "pairs"]

    @F.arrow_udf(
        "n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string,"
        " pairs array<struct<pair: bigint, times: bigint>>"
    )
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = aligner(a_path, b_path)
        for batch in batches:
            rows = list(own.digests([value or "" for value in batch.to_pylist()]))
            offsets = np.cumsum([0, *(len(r[4]) for r in rows)], dtype=np.int32)
            pairs, times = (
                pa.array(np.concatenate([_NONE, *(r[i] for r in rows)])) for i in (4, 5)
            )
            counted = pa.StructArray.from_arrays([pairs, times], ["pair", "times"])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            plain = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.StructArray.from_arrays(
                [*plain, pa.ListArray.from_arrays(pa.array(offsets), counted)], names
            )

    return digests(text.cast("string"))


def _counted(pairs: DataFrame, size_b: int) -> DataFrame:
    """pair, total (its links in the whole corpus), best (no A id is linked more often with its B id)."""
    totals = materialise(pairs.groupBy("pair").agg(F.sum("times").alias("total")))
    id_b = (F.col("pair") % size_b).alias("id_b")
    most = totals.groupBy(id_b).agg(F.max("total").alias("most"))
    return totals.withColumn("id_b", id_b).join(most, "id_b").select(
        "pair", "total", (F.col("total") == F.col("most")).alias("best")
    )


def pair_counts(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """id_a, id_b, total, best of every pair of ids that is linked somewhere in `docs`."""
    prepare_python(docs.sparkSession)
    pairs = docs.select(_digests(col(text), a_path, b_path)["pairs"].alias("pairs"))
    size_b = len(pair(a_path, b_path).bytes_b)
    return _counted(pairs.select(F.inline("pairs")), size_b).select(
        F.floor(F.col("pair") / size_b).cast("int").alias("id_a"),
        (F.col("pair") % size_b).cast("int").alias("id_b"),
        "total",
        "best",
    )


def documents_digest(
    docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256. Keys may repeat or be null: every row counts for itself, in the counts of pairs
    too. Texts without tokens (see `aligned`) have zeros and an empty digest; an empty table gives
    no rows. Other columns are not read.
    """
    prepare_python(docs.sparkSession)
    found = docs.select(
        F.monotonically_increasing_id().alias("row"),
        col(key).cast("bigint").alias("doc_id"),
        _digests(col(text), a_path, b_path).alias("found"),
    )
    table = materialise(found.select("row", "doc_id", "found.*"))
    links = table.select("row", F.inline("pairs"))
    own = pair(a_path, b_path)
    counts = materialise(_counted(links.select("pair", "times"), len(own.bytes_b)))
    if own.possible() <= BROADCAST_ROWS:
        counts = F.broadcast(counts)
    scored = (
        links.join(counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("total")).alias("count_sum"),
        )
    )
    none = F.lit(0).cast("bigint")
    return table.drop("pairs").join(scored, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"),
        "groups_sha256",
    )
