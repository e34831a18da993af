from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest

from replenish.llm import sharding


def bits(key, text):
    inner = hashlib.md5((text or "").encode()).hexdigest()
    named = f"{'' if key is None else key}|{inner}"
    return bin(int(hashlib.md5(named.encode()).hexdigest()[:15], 16))[2:].zfill(60)


def brute(rows, limit):
    """Splits buckets one by one on the next bit."""
    out, todo = {}, [("", [(bits(k, t), len((t or "").encode())) for k, t in rows])]
    while todo:
        name, inside = todo.pop()
        if not inside:
            continue
        if sum(b for _, b in inside) <= limit or len({h for h, _ in inside}) == 1:
            out[name] = (sum(b for _, b in inside), len(inside))
            continue
        for bit in "01":
            todo.append((name + bit, [x for x in inside if x[0].startswith(name + bit)]))
    return out


def verify(rows, found, limit):
    wanted = brute(rows, limit)
    assert len(found) == len(rows)
    inside = defaultdict(list)
    for r in found:
        inside[r.shard].append(r)
    assert {s: (g[0].shard_bytes, g[0].shard_rows) for s, g in inside.items()} == wanted
    for s, group in inside.items():
        assert (sum(r.bytes for r in group), len(group)) == wanted[s]
        assert all(r.depth == len(s) for r in group)
        pages = Counter()
        for r in group:
            pages[r.page] += r.bytes
        assert all(b <= limit or sum(r.page == p for r in group) == 1 for p, b in pages.items())
    expected = Counter((k, next(s for s in wanted if bits(k, t).startswith(s))) for k, t in rows)
    assert Counter((r.doc_id, r.shard) for r in found) == expected


@pytest.mark.parametrize("limit", [4000, 200_000, 1 << 30])
def test_documents(spark, limit):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    verify(rows, sharding.shards(docs, limit).collect(), limit)


def test_edge_rows(spark):
    rows = [(i, "x" * (i % 50)) for i in range(300)] + [(7, "same row " * 30)] * 40 + [(8, None)] * 3
    rows += [(None, "no key"), (None, None), (9, "huge " * 30000), (9, "other text"), (10, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as hash", "2 as bytes", "3 as shard")
    for limit in (100, 1000, 5000):
        verify(rows, sharding.shards(docs, limit).collect(), limit)
    assert sharding.shards(docs.limit(0)).count() == 0


def test_written_shards(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = sharding.write(docs, str(tmp_path / "out"), 60_000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count()
    sizes = back.selectExpr("shard", "octet_length(text) as b").groupBy("shard").sum("b").collect()
    known = {"s" + r.shard: r.bytes for r in found.collect()}
    assert {str(r[0]): r[1] for r in sizes} == known
    assert back.select(*docs.columns).exceptAll(docs).count() == 0
    files = list((tmp_path / "out").glob("shard=*/page=*/*.parquet"))
    assert len(files) == len(known)


EDGES = [(i, "x" * (i % 50)) for i in range(300)] + [(7, "same row " * 30)] * 40 + [(8, None)] * 3
EDGES += [(None, "no key")] * 60 + [(None, None), (9, "huge " * 3000), (9, "other text"), (10, "")]


def test_every_written_folder_fits(spark, tmp_path):
    docs = spark.createDataFrame(EDGES, "doc_id bigint, text string").selectExpr(
        "*", "1 as hash", "2 as `per.page`", "'x' as Shard", "4 as page"
    )
    for limit in (200, 1000, 5000):
        path = tmp_path / f"out{limit}"
        sharding.write(docs, str(path), limit)
        back = spark.read.parquet(str(path))
        assert back.select("doc_id", "text", "hash", "`per.page`", "Shard", "page").exceptAll(docs).isEmpty()
        assert back.count() == len(EDGES)
        folders = back.selectExpr("shard_", "page_", "coalesce(octet_length(text), 0) as b")
        sizes = folders.groupBy("shard_", "page_").agg({"b": "sum", "*": "count"}).collect()
        assert all(r["sum(b)"] <= limit or r["count(1)"] == 1 for r in sizes)
        verify(EDGES, sharding.written(docs, limit).collect(), limit)


def test_an_empty_table_is_written_and_read(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    sharding.write(docs, str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "none")).columns == ["doc_id", "text", "shard", "page"]
    assert sharding.written(docs).count() == 0
