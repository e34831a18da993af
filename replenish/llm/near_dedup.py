"""Near-duplicates by MinHash bands, sequential Bayesian pruning and exact verification.

1. A text is the set of its word shingles (64-bit hashes). Texts with the same set become one node,
   so copies cost nothing below; a node has a signature of `HASHES` minima and one key per band.
2. Nodes that share a band are candidates. A bucket is not expanded into pairs: its members are
   compared with two pivots, the smallest node and a random one.
3. A candidate pair is read in batches of the signature. After each batch the posterior probability
   that its similarity reaches the threshold (uniform prior) decides: below `MISS` it is dropped.
   Survivors are verified on their full sets.
4. What is left of a bucket are the members outside its largest component. They are compared with
   each other, and their components with that one, until a link is found. A bucket with very many of
   them is split by further, narrower bands first. Many members meet in cells of two blocks, so no
   task holds a whole bucket or component: a cell first names the members with a probable partner
   (no more rows than it reads), then verifies these on their sets and returns a forest, at most
   one link less than it has members. After that no two components that share a bucket have a link
   between them: the components are exact for all candidate pairs, though not every pair inside a
   component was looked at.

Every step writes a table to the shared folder; a lost executor repeats tasks, not steps.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from replenish.llm.common import col, fresh, prepare_python
from replenish.operators.scale import is_bounded, materialise

HASHES = 160
BATCH = 16
MISS = 1e-6
# Bands are as wide as they can be while a pair at the threshold is missed with less than this.
BAND_MISS = 1e-5
# Nodes and bytes of sets of a block where many meet; numbers of pairs of members, and of members,
# that need none.
BLOCK = 512
BLOCK_BYTES = 16 << 20
FEW_PAIRS = 64
FEW = 16
# Members from which a bucket is split by bands of SPLIT_ROWS minima, at most SPLITS times.
CROWD = 4096
SPLIT_ROWS = 4
SPLITS = 3
# Keys of texts (two of 16 bytes) up to which a list is broadcast; beyond, texts are shuffled.
BROADCAST_ROWS = 500_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_NODE = "decimal(38,0)"


@dataclass(frozen=True)
class Rule:
    """Words of a shingle, and the least similarity of a link in per cent."""

    words: int = 5
    percent: int = 80

    @property
    def band_rows(self) -> int:
        """The widest band whose miss probability at the threshold is small enough."""
        t = self.percent / 100
        fit = [r for r in range(1, 17) if (1 - t**r) ** (HASHES // r) <= BAND_MISS]
        return max(fit, default=1)


# --- sets, signatures, bands ------------------------------------------------------------------


class WordHashes(dict):
    """Word -> 64-bit hash; forgets all when full. Made per task, so nothing stays in a worker."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles. A text with fewer words is one shingle of all its
    words; a text without words has none. Only A-Z are lower-cased."""
    found = text.lower().split()  # ASCII white space: \x20 and \x09-\x0D
    if not found:
        return np.zeros(0, dtype=np.uint64)
    own = np.fromiter(map(hashes.__getitem__, found), dtype=np.uint64, count=len(found))
    span = min(words, len(own))
    mixed = np.full(len(own) - span + 1, span, dtype=np.uint64)
    for i in range(span):
        mixed = (mixed ^ own[i : len(own) - span + 1 + i]) * _ODD
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


@lru_cache(maxsize=1)
def _multipliers() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of HASHES hash functions over a set, 32 bits each."""
    factors, least = _multipliers()[:, None], None
    for start in range(0, len(shingles), 2048):
        part = (factors * shingles[None, start : start + 2048]).min(axis=1)
        least = part if least is None else np.minimum(least, part)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(minima: np.ndarray, rows: int) -> np.ndarray:
    bands = HASHES // rows
    grid = minima[: bands * rows].reshape(bands, rows).astype(np.uint64)
    keys = np.arange(1, bands + 1, dtype=np.uint64) * _ODD
    for i in range(rows):
        keys = (keys ^ grid[:, i]) * _ODD
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


def described(text: Column, rule: Rule) -> Column:
    """Struct of a text: n_shingles, node (a 126-bit hash of its set, 0 without words), its
    signature (16 bits of each minimum) and its band keys."""
    rows = rule.band_rows

    @F.arrow_udf(f"n_shingles bigint, node {_NODE}, signature binary, bands array<bigint>")
    def describe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = WordHashes()
        for batch in batches:
            sizes, nodes, signatures, bands = [], [], [], []
            for value in batch:
                shingles = shingle_set(value.as_py() or b"", rule.words, hashes)
                sizes.append(len(shingles))
                if not len(shingles):
                    nodes.append(bytes(16))
                    signatures.append(None)
                    bands.append(np.zeros(0, dtype=np.int64))
                    continue
                minima = signature(shingles)
                nodes.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                signatures.append(minima.astype(np.uint16).tobytes())
                bands.append(band_keys(minima, rows))
            raw = np.frombuffer(b"".join(nodes), dtype=np.uint64).reshape(-1, 2).copy()
            raw[:, 1] &= np.uint64((1 << 62) - 1)
            offsets = np.cumsum([0, *map(len, bands)], dtype=np.int32)
            values = np.concatenate([np.zeros(0, np.int64), *bands])
            yield pa.StructArray.from_arrays(
                [
                    pa.array(sizes, pa.int64()),
                    pa.Array.from_buffers(
                        pa.decimal128(38, 0), len(raw), [None, pa.py_buffer(raw.tobytes())]
                    ),
                    pa.array(signatures, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                ],
                ["n_shingles", "node", "signature", "bands"],
            )

    return describe(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


# --- verification -----------------------------------------------------------------------------


@lru_cache(maxsize=8)
def least_matches(percent: int) -> tuple[int, ...]:
    """Per batch: the fewest matches in the signature so far with which a pair goes on.

    With m of k matches and a uniform prior the similarity has the posterior Beta(m+1, k-m+1), and
    P(similarity >= t) = P(Binomial(k+1, t) <= m). MISS is shared out among the batches.
    """
    t, need = percent / 100, []
    for k in range(BATCH, HASHES + 1, BATCH):
        below = 0.0
        for m in range(k + 1):
            below += math.comb(k + 1, m) * t**m * (1 - t) ** (k + 1 - m)
            if below >= MISS * BATCH / HASHES:
                need.append(m)
                break
    return tuple(need)


def likely(one: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Positions of the rows of two signature tables that may reach the threshold."""
    alive = np.arange(len(one))
    matches = np.zeros(len(one), dtype=np.int64)
    for step, need in enumerate(least_matches(percent)):
        part = slice(step * BATCH, (step + 1) * BATCH)
        matches = matches + (one[alive, part] == other[alive, part]).sum(axis=1)
        ok = matches >= need
        alive, matches = alive[ok], matches[ok]
    return alive


def linked(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """The exact rule on full sets."""
    small, large = sorted((one, other), key=len)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    shared = int((large[at] == small).sum())
    return 100 * shared >= percent * (len(one) + len(other) - shared)


def _table(signatures: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), dtype=np.uint16).reshape(-1, HASHES)


def _may_link(one: Column, other: Column, percent: int) -> Column:
    @F.arrow_udf("boolean")
    def prune(a: pa.Array, b: pa.Array) -> pa.Array:
        keep = np.zeros(len(a), dtype=bool)
        if len(a):
            keep[likely(_table(a.to_pylist()), _table(b.to_pylist()), percent)] = True
        return pa.array(keep)

    return prune(one, other)


def _linked(one: Column, other: Column, percent: int) -> Column:
    @F.arrow_udf("boolean")
    def verify(a: pa.Array, b: pa.Array) -> pa.Array:
        sets = zip(a.to_pylist(), b.to_pylist())
        return pa.array(
            [
                linked(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), percent)
                for x, y in sets
            ],
            pa.bool_(),
        )

    return verify(one, other)


@dataclass
class Corpus:
    """The nodes of a table of texts: `rows` (doc_id, text_key, n_shingles, node), `nodes` (node,
    n_shingles, signature, text_key, bands)."""

    texts: DataFrame  # text_key, text
    rows: DataFrame
    nodes: DataFrame
    rule: Rule

    @classmethod
    def of(cls, docs: DataFrame, key: str, text: str, rule: Rule) -> Corpus:
        prepare_python(docs.sparkSession)
        named = docs.select(
            col(key).cast("bigint").alias("doc_id"),
            _text_key(col(text)).alias("text_key"),
            col(text).cast("string").alias("text"),
        )
        found = named.select("doc_id", "text_key", described(F.col("text"), rule).alias("d"))
        rows = materialise(found.select("doc_id", "text_key", "d.*"))
        nodes = rows.filter("n_shingles > 0").drop("doc_id").dropDuplicates(["node"])
        return cls(
            named.select("text_key", "text"),
            rows.drop("signature", "bands"),
            materialise(nodes),
            rule,
        )

    def with_sets(self, wanted: DataFrame) -> DataFrame:
        """`wanted` (node) as a table with n_shingles, signature and shingles."""
        list_ = materialise(
            self.nodes.join(wanted.distinct(), "node", "left_semi").drop("bands")
        )
        keys = list_.select("node", "text_key")
        picked = F.broadcast(keys) if is_bounded(keys, BROADCAST_ROWS) else keys
        words = self.rule.words

        @F.arrow_udf("binary")
        def shingles(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            hashes = WordHashes()
            for texts in batches:
                yield pa.array(
                    [shingle_set(t.as_py() or b"", words, hashes).tobytes() for t in texts],
                    pa.binary(),
                )

        texts = self.texts.join(picked, "text_key").drop("text_key").dropDuplicates(["node"])
        sets = texts.select("node", shingles(F.coalesce("text", F.lit("")).cast("binary")).alias("shingles"))
        return materialise(list_.drop("text_key").join(sets, "node"))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links: pruned by signatures, then verified on full sets."""
        percent = self.rule.percent
        one = self.nodes.select(
            F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("signature").alias("s_a")
        )
        other = self.nodes.select(
            F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("signature").alias("s_b")
        )
        sized = pairs.join(one, "a").join(other, "b")
        near = sized.filter(
            F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * F.lit(percent)
        )
        left = materialise(
            near.withColumn("ok", _may_link(F.col("s_a"), F.col("s_b"), percent)).filter("ok").select("a", "b")
        )
        sets = self.with_sets(left.select(F.explode(F.array("a", "b")).alias("node")))
        both = left.join(
            sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a"
        ).join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
        return materialise(
            both.withColumn("ok", _linked(F.col("set_a"), F.col("set_b"), percent))
            .filter("ok")
            .select("a", "b")
        )


# --- components -------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): node, component (its smallest node), for every node
    that has a link. Alternates stars around larger and smaller neighbours until nothing changes;
    the number of edges never grows."""

    def written(df: DataFrame) -> tuple[DataFrame, tuple]:
        """The edges as a table, with their number and a checksum."""
        seen = Observation()
        size, sum_ = F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")
        table = materialise(df.distinct().observe(seen, size, sum_))
        return table, (seen.get["n"], seen.get["x"])

    hi, lo = F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    edges, now = written(links.filter("a <> b").select(hi, lo))
    before = None
    while now != before and now[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            edges.select(F.col("lo"), F.col("hi"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        ).distinct()
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(root, "hi")
        stars = small.select("hi", F.col("m").alias("lo")).union(
            small.filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        )
        before = now
        edges, now = written(stars)
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return materialise(
        edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
    )


def _labelled(rows: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """`rows` with the component of a node column; a node without link is its own."""
    own = labels.select(F.col("node").alias(node), F.col("component").alias(name))
    return rows.join(own, node, "left").withColumn(name, F.coalesce(name, node))


def _buckets(corpus: Corpus) -> DataFrame:
    """Members of buckets with more than one node: bucket, node, pivot (the smallest node), other
    (a random one), members."""
    placed = corpus.nodes.select("node", F.explode("bands").alias("bucket"))
    shared = (
        placed.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.min("node").alias("pivot"),
            F.min_by("node", F.xxhash64("node", "bucket")).alias("other"),
        )
        .filter("members > 1")
    )
    return materialise(placed.join(shared, "bucket"))


def _pairs(rows: DataFrame, pivot: str) -> DataFrame:
    return (
        rows.filter(F.col("node") != F.col(pivot))
        .select(F.least("node", pivot).alias("a"), F.greatest("node", pivot).alias("b"))
        .distinct()
    )


def linked_components(corpus: Corpus) -> DataFrame:
    """node, component for every node that has a link: the components of all links between nodes
    that share a bucket."""
    buckets = _buckets(corpus)
    crowded = buckets.filter("members > 2")
    tested = materialise(_pairs(buckets, "pivot").union(_pairs(crowded, "other")).distinct())
    found = corpus.verified(tested)
    labels = components(found)
    rest = _rest(crowded.select("bucket", "node"), labels)
    if rest.isEmpty():
        return labels
    more = _between(corpus, rest, labels, tested)
    return labels if more.isEmpty() else components(found.union(more))


def _rest(crowded: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that are not of the component with the most members there: bucket, node,
    component, top (that component). Links inside a component are not looked for any more."""
    present = _labelled(crowded, labels, "node", "component")
    most = (
        present.groupBy("bucket", "component")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("several"), F.max_by("component", "n").alias("top"))
        .filter("several > 1")
        .select("bucket", "top")
    )
    return materialise(present.join(materialise(most), "bucket").filter("component <> top"))


def _with_signatures(corpus: Corpus, rows: DataFrame) -> DataFrame:
    return rows.join(corpus.nodes.select("node", "n_shingles", "signature"), "node")


def _split_miss(percent: int, bands: int) -> float:
    """Chance that a pair at the threshold agrees in none of so many bands of SPLIT_ROWS minima."""
    return (1 - (percent / 100) ** SPLIT_ROWS) ** bands


def split_crowds(members: DataFrame, percent: int, crowd: int | None = None) -> DataFrame:
    """`members` (bucket, node, component, n_shingles, signature) with crowded buckets replaced by
    the buckets of further bands inside them.

    A band in which all members agree tells nothing and is left out. A bucket stays whole if the
    others are too few: a pair at the threshold has to agree in one of them but for BAND_MISS.
    """
    crowd, bands = crowd or CROWD, HASHES // SPLIT_ROWS
    keys = [F.substring("signature", i * SPLIT_ROWS * 2 + 1, SPLIT_ROWS * 2) for i in range(bands)]
    done, left = [], members
    for _ in range(SPLITS):
        sizes = materialise(left.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))
        crowded = sizes.filter(F.col("n") > crowd)
        if crowded.isEmpty():
            break
        parted = (
            left.join(crowded, "bucket")
            .select("*", F.posexplode(F.array(*keys)).alias("band", "part"))
        )
        parts = parted.groupBy("bucket", "n", "band", "part").agg(
            F.count(F.lit(1)).alias("m"), F.count_distinct("component").alias("several")
        )
        telling = parts.groupBy("bucket", "n", "band").agg(F.max("m").alias("most")).filter("most < n")
        enough = telling.groupBy("bucket").agg(F.count(F.lit(1)).alias("bands"))
        fit = next(k for k in range(bands + 2) if k > bands or _split_miss(percent, k) <= BAND_MISS)
        split = materialise(enough.filter(F.col("bands") >= fit).select("bucket"))
        kept = materialise(
            parts.filter("several > 1 and m < n").join(split, "bucket").select("bucket", "band", "part")
        )
        done.append(left.join(split, "bucket", "left_anti"))
        left = materialise(
            parted.join(kept, ["bucket", "band", "part"])
            .withColumn("bucket", F.xxhash64("bucket", "band", "part"))
            .select(*members.columns)
        )
    for part in done:
        left = left.unionByName(part)
    return left


def _roots(names: Iterable) -> tuple[dict, object]:
    """A union-find over names: its parents, and the function that finds a root."""
    parent = {name: name for name in names}

    def root(name):
        while parent[name] != name:
            parent[name] = parent[parent[name]]
            name = parent[name]
        return name

    return parent, root


def _similar(sizes: np.ndarray, table: np.ndarray, n: int, own: bytes, percent: int) -> np.ndarray:
    """Rows of a table of signatures that may be linked with one text."""
    fit = np.flatnonzero(np.minimum(sizes, n) * 100 >= np.maximum(sizes, n) * percent)
    return fit[likely(table[fit], _table([own]).repeat(len(fit), 0), percent)]


def _probable(one: pd.DataFrame, other: pd.DataFrame, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of either frame (node, component, n_shingles, signature) have a probable partner
    of another component in the other."""
    hit, met = np.zeros(len(one), dtype=bool), np.zeros(len(other), dtype=bool)
    if len(one) and len(other):
        sizes, table = other.n_shingles.to_numpy(), _table(other.signature)
        components_ = other.component.to_numpy()
        for i, row in enumerate(one.itertuples()):
            near = _similar(sizes, table, row.n_shingles, row.signature, percent)
            near = near[components_[near] != row.component]
            hit[i] = len(near) > 0
            met[near] = True
    return hit, met


def _forest(one: pd.DataFrame, other: pd.DataFrame, percent: int) -> list[tuple]:
    """Links (node, node) between rows of two frames, verified on their sets (shingles), that join
    components; after them no two components of the frames with a link are apart."""
    out: list[tuple] = []
    if not len(one) or not len(other):
        return out
    parent, root = _roots({*one.component, *other.component})
    sizes, table = other.n_shingles.to_numpy(), _table(other.signature)
    components_, nodes = other.component.tolist(), other.node.tolist()
    sets = [np.frombuffer(x, np.uint64) for x in other.shingles]
    for row in one.itertuples():
        mine = np.frombuffer(row.shingles, np.uint64)
        for i in _similar(sizes, table, row.n_shingles, row.signature, percent):
            a, b = root(row.component), root(components_[i])
            if a != b and linked(mine, sets[i], percent):
                parent[a] = b
                out.append((row.node, nodes[i]))
    return out


def _among(corpus: Corpus, rest: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Pairs (a, b) of different components among the rest of buckets with few members, and links
    (a, b) that join the components of the rest of buckets with many."""
    counts = rest.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("component").alias("several")
    )
    counts = materialise(counts.filter("several > 1").select("bucket", "n"))
    few = rest.join(counts.filter(F.col("n") <= FEW), "bucket").select("bucket", "node", "component")
    a = few.select("bucket", F.col("node").alias("a"), F.col("component").alias("c_a"))
    b = few.select("bucket", F.col("node").alias("b"), F.col("component").alias("c_b"))
    pairs = a.join(b, "bucket").filter("a < b and c_a <> c_b").select("a", "b")

    crowds = counts.filter(F.col("n") > FEW)
    if crowds.isEmpty():
        return pairs, None
    percent = corpus.rule.percent
    members = _with_signatures(
        corpus, rest.join(crowds.select("bucket"), "bucket").select("bucket", "node", "component")
    )
    members = materialise(split_crowds(materialise(members), percent))
    sizes = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), (F.sum("n_shingles") * 8).alias("bytes")
    )
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    cells = (
        members.join(sizes.select("bucket", blocks.alias("blocks")), "bucket")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "with"))
        .withColumn("high", F.greatest("own", "with"))
        .drop("with", "blocks")
    )

    def sides(cell: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        return (
            cell[cell.own == side.iloc[0]].reset_index(drop=True) for side in (cell.low, cell.high)
        )

    def name(cell: pd.DataFrame) -> pd.DataFrame:
        one, other = sides(cell)
        hit, met = _probable(one, other, percent)
        found = pd.concat([one[hit], other[met]]).drop_duplicates("node")
        return found[["bucket", "low", "high", "own", "node", "component"]]

    named = materialise(
        cells.groupBy("bucket", "low", "high").applyInPandas(
            name, f"bucket bigint, low int, high int, own int, node {_NODE}, component {_NODE}"
        )
    )

    def meet(cell: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_forest(*sides(cell), percent), columns=["a", "b"])

    met = (
        named.join(corpus.with_sets(named.select("node")), "node")
        .groupBy("bucket", "low", "high")
        .applyInPandas(meet, f"a {_NODE}, b {_NODE}")
    )
    return pairs, materialise(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def _between(
    corpus: Corpus, rest: DataFrame, labels: DataFrame, tested: DataFrame
) -> DataFrame:
    """At least one link (a, b) for every pair of components that share a bucket and have one."""
    sizes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    of = lambda name: sizes.select(F.col("component").alias(name), F.col("size").alias(f"n_{name}"))
    sized = (
        rest.select("component", "top")
        .distinct()
        .join(of("component"), "component", "left")
        .join(of("top"), "top", "left")
        .fillna(1, ["n_component", "n_top"])
    )
    # Two components can be top of each other in different buckets.
    turn = F.col("n_component") > F.col("n_top")
    pairs = materialise(
        sized.select(
            F.when(turn, F.col("top")).otherwise(F.col("component")).alias("few"),
            F.when(turn, F.col("component")).otherwise(F.col("top")).alias("many"),
            F.least("n_component", "n_top").alias("n_few"),
            F.greatest("n_component", "n_top").alias("n_many"),
        ).distinct()
    )
    alone = pairs.select(F.explode(F.array("few", "many")).alias("component")).distinct()
    members = labels.join(alone, "component", "left_semi").select("component", "node")
    # A component without links is one node.
    single = alone.join(labels.select("component").distinct(), "component", "left_anti")
    members = materialise(members.union(single.select("component", F.col("component").alias("node"))))
    few = members.select(F.col("component").alias("few"), F.col("node").alias("x"))
    many = members.select(F.col("component").alias("many"), F.col("node").alias("y"))

    small = pairs.filter(F.col("n_few") * F.col("n_many") <= FEW_PAIRS).select("few", "many")
    expanded = small.join(few, "few").join(many, "many").select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
    )
    among, joined = _among(corpus, rest)
    plain = corpus.verified(
        expanded.union(among).distinct().join(tested, ["a", "b"], "left_anti")
    )
    if joined is not None:
        plain = plain.union(joined)
    large = pairs.filter(F.col("n_few") * F.col("n_many") > FEW_PAIRS)
    return plain if large.isEmpty() else plain.union(_met(corpus, large, members, few, many))


def _met(
    corpus: Corpus, large: DataFrame, members: DataFrame, few: DataFrame, many: DataFrame
) -> DataFrame:
    """At least one link for every pair of components that has one; members meet in blocks."""
    sizes = corpus.nodes.select("node", "n_shingles", "signature")
    # The members of the larger component fall into blocks, those of all smaller ones too.
    targets = large.groupBy("many").agg(
        F.max("n_many").alias("n_many"), F.sum("n_few").alias("n_few")
    )
    targets = targets.select(
        "many",
        F.ceil(F.col("n_many") / BLOCK).cast("int").alias("m_blocks"),
        F.ceil(F.col("n_few") / BLOCK).cast("int").alias("f_blocks"),
    )
    asked = (
        large.select("few", "many")
        .join(targets, "many")
        .join(few, "few")
        .withColumn("f_block", F.pmod(F.xxhash64("x"), F.col("f_blocks")).cast("int"))
        .withColumn("m_block", F.explode(F.sequence(F.lit(0), F.col("m_blocks") - 1)))
        .select("many", "m_block", "f_block", F.col("few").alias("component"), F.col("x").alias("node"))
        .join(sizes, "node")
    )
    offered = (
        targets.join(many, "many")
        .withColumn("m_block", F.pmod(F.xxhash64("y"), F.col("m_blocks")).cast("int"))
        .withColumn("f_block", F.explode(F.sequence(F.lit(0), F.col("f_blocks") - 1)))
        .select("many", "m_block", "f_block", F.col("many").alias("component"), F.col("y").alias("node"))
        .join(sizes, "node")
    )
    percent, cell = corpus.rule.percent, ["many", "m_block", "f_block"]

    def sides(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        offering = rows.component == rows.many
        return rows[~offering].reset_index(drop=True), rows[offering].reset_index(drop=True)

    def name(rows: pd.DataFrame) -> pd.DataFrame:
        asking, offering = sides(rows)
        hit, met = _probable(asking, offering, percent)
        return pd.concat([asking[hit], offering[met]])[[*cell, "component", "node"]]

    named = materialise(
        asked.unionByName(offered)
        .groupBy(*cell)
        .applyInPandas(
            name, f"many {_NODE}, m_block int, f_block int, component {_NODE}, node {_NODE}"
        )
    )
    found = named.join(corpus.with_sets(named.select("node")), "node")
    # Sets are long: what is left of a cell is dealt out again by their bytes.
    bytes_ = named.join(sizes.select("node", "n_shingles"), "node").groupBy(*cell).agg(
        F.ceil(F.sum(F.col("n_shingles") * 8) / BLOCK_BYTES).cast("int").alias("parts")
    )
    asking = F.col("component") != F.col("many")
    dealt = (
        found.join(bytes_, cell)
        .withColumn("own", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("of_x", F.when(asking, F.col("own")).otherwise(F.col("other")))
        .withColumn("of_y", F.when(asking, F.col("other")).otherwise(F.col("own")))
        .drop("own", "other", "parts")
    )

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        links = _forest(*sides(rows), percent)
        return pd.DataFrame(links, columns=["a", "b"])

    return materialise(
        dealt.groupBy(*cell, "of_x", "of_y").applyInPandas(meet, f"a {_NODE}, b {_NODE}")
    )


# --- results ----------------------------------------------------------------------------------


def _classes(corpus: Corpus) -> DataFrame:
    """node, component_id (smallest doc_id of the component), text_key of the row that stays."""
    labels = linked_components(corpus)
    best = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    per_node = corpus.rows.filter("n_shingles > 0").groupBy("node").agg(F.min(best).alias("best"))
    per_node = materialise(_labelled(per_node, labels, "node", "component"))
    per_component = materialise(per_node.groupBy("component").agg(F.min("best").alias("first")))
    return per_node.join(per_component, "component").select(
        "node", F.col("first.doc_id").alias("component_id"), F.col("first.text_key").alias("keep_key")
    )


def groups(docs: DataFrame, rule: Rule, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    component_id is the smallest key of all documents that can be reached by links, the document
    itself included; null keys only count where there is no other. Documents without words or text
    have no shingles and are linked with nothing. An empty table gives no rows.
    """
    corpus = Corpus.of(docs, key, text, rule)
    found = corpus.rows.join(_classes(corpus), "node", "left")
    alone = F.col("n_shingles") == 0
    return found.select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, rule: Rule, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, one of each group, with the columns of `docs`. Documents
    without words stay; rows that repeat a key and a text count as one."""
    corpus = Corpus.of(docs, key, text, rule)
    own, text_key = fresh(docs, "own_key"), fresh(docs, "text_key")
    best = _classes(corpus).select(
        F.col("component_id").alias("keep_id"), F.col("keep_key").alias("keep_text")
    )
    wordless = corpus.rows.filter("n_shingles = 0").select("doc_id", "text_key")
    kept = materialise(best.union(wordless).distinct())
    tagged = docs.withColumn(own, col(key).cast("bigint")).withColumn(text_key, _text_key(col(text)))
    same = tagged[own].eqNullSafe(kept["keep_id"]) & (tagged[text_key] == kept["keep_text"])
    stay = tagged.join(kept, same, "left_semi").dropDuplicates([own, text_key])
    return stay.select(*map(col, docs.columns))
