from __future__ import annotations

import re
from collections import defaultdict

import pytest

from replenish.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes: dict) -> dict:
    """The rule as stated: share by weight, stop at three times the size, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free, rest = dict.fromkeys(sizes, 0.0), set(sizes), float(sum(sizes.values()))
    while free:
        level = rest / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 3.0 * sizes[s] for s in full}
        rest -= sum(target[s] for s in full)
        free -= full
    return target


def verify(rows, texts, slack):
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    wanted = targets({s: sum(r.size for r in group) for s, group in by.items()})
    for s, group in by.items():
        size = sum(r.size for r in group)
        assert all(r.source_size == size for r in group)
        assert all(r.target == pytest.approx(wanted[s], rel=1e-9, abs=1e-6) for r in group)
        assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 3 for r in group)
        smallest = min((r.size for r in group if r.size), default=0)
        assert abs(sum(r.taken for r in group) - wanted[s]) <= max(slack * size, smallest)


def named(mixed, docs):
    """Results with the source of their row, for keys that are unique."""
    return mixed.join(docs.select("doc_id", "source", "text"), "doc_id").collect()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_documents(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    mixed = mixing.mix(docs)
    rows = named(mixed, docs)
    assert len(rows) == docs.count()
    assert all(r.size == len(WORD.findall(r.text or "")) for r in rows)
    verify(rows, docs, 0.02 if sf == "sf0.001" else 0.002)
    again = {(r.doc_id, r.taken) for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_caps_nulls_ties_and_empty_texts(spark):
    rows = [(i, "a", "one two three " * (i % 7 + 1)) for i in range(200)]
    rows += [(1000 + i, "B", "w " * 5) for i in range(4)] + [(2000 + i, None, "x y") for i in range(3)]
    rows += [(3000, "empty", None), (3001, "empty", ""), (3002, "é", " \t"), (3003, "é", "long " * 30000)]
    rows += [(4000 + i, "dots", "same words here") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").selectExpr("*", "1 as size", "2 as place")
    verify(named(mixing.mix(docs).drop("source"), docs), docs, 0.02)
    kept = mixing.mixed_documents(docs)
    assert kept.columns == docs.columns
    taken = {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.size and r.copies}
    counts = {r["doc_id"]: r["count"] for r in kept.groupBy("doc_id").count().collect()}
    assert counts == taken


def test_repeated_rows_null_keys_and_empty_tables(spark):
    rows = [(1, "a", "b c d")] * 5 + [(None, "a", "e f")] * 3 + [(2, "z", "g h i j")] * 4 + [(1, "z", "other words")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == len(rows)
    assert abs(sum(r.taken for r in mixed) - sum(r.size for r in mixed)) <= 4
    assert mixing.mixed_documents(docs).count() == sum(r.copies for r in mixed)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_longer_documents_and_whole_copies(spark):
    """Expectations above 1 give certain copies; higher classes are expected more often."""
    docs = spark.createDataFrame(
        [(i, "s1" if i % 2 else "s2", "w " * (5 if i % 4 < 2 else 400)) for i in range(4000)],
        "doc_id bigint, source string, text string",
    )
    rows = named(mixing.mix(docs), docs)
    mean = defaultdict(list)
    for r in rows:
        mean[r.source, r.size].append(r.copies)
    mean = {k: sum(v) / len(v) for k, v in mean.items()}
    for s in ("s1", "s2"):
        assert mean[s, 400] > mean[s, 5]
    assert min(r.copies for r in rows if (r.source, r.size) == ("s2", 400)) >= 1
