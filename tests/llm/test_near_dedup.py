from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from replenish.llm import near_dedup
from replenish.llm.near_dedup import Rule

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    words = WORD.findall((text or "").translate(UPPER))
    return frozenset(zip(*(words[i:] for i in range(k)))) if len(words) >= k else frozenset([tuple(words)] if words else [])


def brute(rows, rule):
    """Size, component and decision per row, from all pairs that share a shingle."""
    sets = [shingles(t, rule.words) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    distinct = defaultdict(list)
    for i, s in enumerate(sets):
        if s:
            distinct[s].append(i)
    for same in distinct.values():
        for i in same:
            parent[root(i)] = root(same[0])
    postings = defaultdict(list)
    for s, same in distinct.items():
        shared = defaultdict(int)
        for g in s:
            for j in postings[g]:
                shared[j] += 1
            postings[g].append(same[0])
        for j, n in shared.items():
            if 100 * n >= rule.percent * (len(s) + len(sets[j]) - n):
                parent[root(same[0])] = root(j)
    members = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        members[root(i)].append(key)
    out = []
    for i, (key, _) in enumerate(rows):
        known = [k for k in members[root(i)] if k is not None]
        best = (min(known) if known else None) if sets[i] else key
        out.append((key, len(sets[i]), best, key == best))
    return sorted(out, key=str)


def edited(rng, words, share):
    return " ".join(f"e{rng.random():.9f}" if rng.random() < share else w for w in words)


@pytest.mark.parametrize("rule", [Rule(3, 85), Rule()], ids=["3-85", "5-80"])
def test_components_equal_brute_force_on_documents(spark, rule):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in near_dedup.groups(docs, rule).collect()), key=str)
    assert got == brute(rows, rule)


def test_groups_of_near_copies_around_the_threshold(spark, monkeypatch):
    """Chains, members far from every pivot, two components in one bucket, and edge rows."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "FEW_PAIRS", 4)
    rng = random.Random(3)
    rows = []
    for group in range(3):
        base = [f"w{group}x{i}" for i in range(90)]
        for _ in range(120):
            rows.append((len(rows), edited(rng, base, rng.choice([0.0, 0.01, 0.02, 0.04, 0.06, 0.09]))))
    chain = [f"c{i}" for i in range(200)]
    for step in range(25):
        rows.append((len(rows), " ".join(chain[step * 4 : step * 4 + 100])))
    rows += [(None, rows[0][1]), (None, "only null"), (None, "only  NULL"), (5000, None), (5001, ""), (5002, " \n"),
             (5003, "One two"), (5004, "one TWO"), (5004, "one TWO"), (5005, "É x"), (5006, "é x"),
             (5007, "long " * 50000), (5008, "long " * 40000), (3, "another text under a used key")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as node", "'c' as text_key")
    rule = Rule(3, 85)
    got = sorted((tuple(r) for r in near_dedup.groups(docs, rule).collect()), key=str)
    assert got == brute(rows, rule)
    kept = near_dedup.deduplicate(docs, rule)
    assert kept.columns == docs.columns
    wordless = [r for r in rows if not shingles(r[1], 3)]
    components = {(r[2], r[1] if r[2] is None else 0) for r in got if r[1]}
    assert kept.count() == len(components) + len(wordless)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_dedup.groups(docs, Rule()).count() == 0
    assert near_dedup.deduplicate(docs, Rule()).count() == 0


def test_pruning_keeps_pairs_above_the_threshold():
    rng = np.random.default_rng(1)
    dropped = 0
    for _ in range(400):
        pool = rng.integers(0, 1 << 63, 1100, dtype=np.uint64)
        one, other = np.unique(pool[:1000]), np.unique(pool[80:1080])
        assert near_dedup.linked(one, other, 85)
        a, b = (near_dedup.signature(s).astype(np.uint16)[None, :] for s in (one, other))
        dropped += not len(near_dedup.likely(a, b, 85))
    assert dropped == 0
    far = near_dedup.signature(np.unique(pool[900:])).astype(np.uint16)[None, :]
    assert not len(near_dedup.likely(a, far, 85))


def test_bands_follow_from_the_miss_probability():
    for percent in (80, 85, 95):
        rows = Rule(3, percent).band_rows
        assert (1 - (percent / 100) ** rows) ** (near_dedup.HASHES // rows) <= near_dedup.BAND_MISS


def test_a_hot_bucket_of_members_without_links(spark):
    """5,000 texts share a passage that makes them candidates but no links; every fifth has a
    partner that shares its own words too. Members meet in cells, and are named first."""
    passage = " ".join(f"p{i}" for i in range(72))
    rows = []
    for n in range(5000):
        own = n - 1 if n % 5 == 1 else n
        tail = " ".join(f"t{own}x{i}" for i in range(24))
        rows.append((n, f"{passage} {tail} end{n}"))
    sets = [shingles(rows[i][1], 3) for i in (0, 1, 2)]
    similarity = [100 * len(sets[0] & s) / len(sets[0] | s) for s in sets[1:]]
    assert similarity[0] >= 85 > 65 > similarity[1] > 50
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    found = near_dedup.groups(docs, Rule(3, 85)).collect()
    assert {r.doc_id: r.component_id for r in found} == {
        n: n - 1 if n % 5 == 1 else n for n in range(5000)
    }


def test_a_split_keeps_pairs_and_leaves_small_buckets(spark):
    """Bands in which all members agree do not split; pairs that agree elsewhere stay together."""
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 16, near_dedup.HASHES, dtype=np.uint16)
    rows = []
    for n in range(60):
        own = base.copy()
        own[12:] = rng.integers(0, 1 << 16, near_dedup.HASHES - 12, dtype=np.uint16)
        rows.append((1, n, n, 100, own.tobytes()))
    twin = np.frombuffer(rows[7][4], np.uint16).copy()
    twin[20:40] = 1
    rows.append((1, 60, 60, 100, twin.tobytes()))
    rows += [(2, n, n, 100, base.tobytes()) for n in range(100, 150)]  # nothing tells these apart
    rows += [(3, 200, 200, 100, base.tobytes()), (3, 201, 201, 100, twin.tobytes())]
    members = spark.createDataFrame(
        rows, "bucket bigint, node long, component long, n_shingles bigint, signature binary"
    )
    found = near_dedup.split_crowds(members, 85, crowd=40).groupBy("bucket").agg({"node": "collect_set"}).collect()
    groups_ = [frozenset(r[1]) for r in found]
    assert frozenset(range(100, 150)) in groups_ and frozenset([200, 201]) in groups_
    assert {g for g in groups_ if g & set(range(61))} == {frozenset([7, 60])}
    assert near_dedup._split_miss(85, 24) <= near_dedup.BAND_MISS


def test_cells_return_forests():
    import pandas as pd

    rng = np.random.default_rng(4)
    pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    sets = [np.unique(pool[i : i + 200]) for i in range(0, 40, 4)]
    cell = pd.DataFrame(
        [(i, i, len(s), near_dedup.signature(s).astype(np.uint16).tobytes(), s.tobytes()) for i, s in enumerate(sets)],
        columns=["node", "component", "n_shingles", "signature", "shingles"],
    )
    links = near_dedup._forest(cell, cell, 85)
    assert len(links) == len(sets) - 1
    hit, met = near_dedup._probable(cell, cell, 85)
    assert hit.all() and met.all()
