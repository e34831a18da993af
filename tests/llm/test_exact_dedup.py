from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from replenish.llm import exact_dedup

ROWS = [
    (5, "a b"), (3, "a\tb "), (9, "ab"), (1, "ab "), (1, None), (2, ""), (None, " "), (None, "q"),
    (7, "zz"), (7, "zz"), (7, "z z"), (8, "Zz"), (4, "é x"), (6, "é x"), (10, "w" * 300_000), (11, "w" * 300_000),
    (None, "long one"), (12, "long one"), (13, "m  m"), (None, "mm"), (-3, "n n"), (-2, "n n"),
]


def brute(rows):
    members = defaultdict(list)
    for key, text in rows:
        members[re.sub(r"[\x20\x09-\x0d]", "", text or "")].append((key, text or ""))
    out = []
    for content, group in members.items():
        best = min(group, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))[0]
        digest, free = hashlib.sha256(content.encode()).hexdigest(), True
        for key, _ in group:
            kept, free = key == best and free, free and key != best
            out.append((key, best, len(group), kept, digest))
    return sorted(out, key=str)


def test_groups_equal_brute_force(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    clashing = docs.selectExpr("*", "1 as content", "'s' as text_sha256", "2 as keep_id", "3 as salt")
    got = sorted((tuple(r) for r in exact_dedup.groups(clashing).collect()), key=str)
    assert got == brute(ROWS)
    assert exact_dedup.groups(docs.limit(0)).count() == 0


def test_deduplicate_keeps_one_row_and_all_columns(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").selectExpr("*", "'x' as keep_key", "'y' as text_sha256")
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    wanted = sorted(str(key) for key, _, _, stays, _ in brute(ROWS) if stays)
    assert sorted(str(r.doc_id) for r in kept.collect()) == wanted
    assert kept.filter("doc_id = 7").collect()[0].text == "z z"


def test_a_text_with_many_copies_is_spread_over_salts(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot copy', concat('t', id)) as text")
    rows = exact_dedup.groups(docs)
    assert rows.filter("group_size = 1000").count() == 1000
    assert rows.filter("kept").count() == 2001
    assert rows.filter("kept and keep_id = 0").count() == 1
    plan = exact_dedup.winners(docs, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
