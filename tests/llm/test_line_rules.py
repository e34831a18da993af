from __future__ import annotations

import re
from collections import Counter, defaultdict

from replenish.llm import line_rules
from replenish.llm.line_rules import Limits

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, limits):
    """doc_id, host, text -> the result rows, from the rules as stated."""
    hosts, documents = Counter(h for _, h, _ in rows), defaultdict(set)
    normal = lambda line: " ".join(WORD.findall(line.lower()))
    for i, (_, host, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            if WORD.search(line):
                documents[host, normal(line)].add(i)
    out = []
    for key, host, text in rows:
        text = text or ""
        words, seen, dups, removed = WORD.findall(text), set(), 0, 0
        most = max(int(hosts[host] * limits.share), limits.least)
        for line in text.split("\n"):
            if WORD.search(line):
                dups += line in seen
                seen.add(line)
                if len(documents[host, normal(line)]) > most:
                    removed += len(WORD.findall(line))
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        count = Counter(windows)
        covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 3)}
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        depleted = 100 * (len(words) - removed) <= (100 - limits.left_percent) * len(words)
        out.append((key, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups,
                    len(covered), removed, failed, not failed and not depleted))
    return sorted(out, key=str)


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "text").collect()]
    for limits in (Limits(), Limits(share=0.0, least=1, left_percent=90)):
        got = sorted((tuple(r) for r in line_rules.judged(docs, limits).collect()), key=str)
        assert got == brute(rows, limits)


def test_edge_rows(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, "h", f"{good} {i}\nSame  footer LINE " + "f " * 70) for i in range(30)]
    rows += [(100 + i, None, f"{good}{i}\nsame footer line") for i in range(25)]
    rows += [(200, None, None), (201, "h", ""), (202, "h", "\n \n\t\n"), (None, "h", good), (203, "", "a b a b a b " * 30)]
    rows += [(204, "h", "x # * $ % & | < >\r\nx # * $\r\n" * 3), (205, "h", "long word é " * 40000), (206, "h", good)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    clashing = docs.selectExpr("*", "1 as row", "'x' as host", "2 as n_words")
    limits = Limits(share=0.1, least=5)
    got = sorted((tuple(r) for r in line_rules.judged(clashing, limits).collect()), key=str)
    assert got == brute(rows, limits)
    assert not any(r[-1] for r in got if r[0] is not None and r[0] < 30)
    assert line_rules.judged(docs.limit(0)).count() == 0


def brute_cleaned(rows, limits):
    """doc_id, host, text -> the kept rows without their boilerplate lines."""
    hosts, documents = Counter(h for _, h, _ in rows), defaultdict(set)
    normal = lambda line: " ".join(WORD.findall(line.lower()))
    for i, (_, host, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            documents[host, normal(line)].add(i)
    out = []
    for row in rows:
        key, host, text = row
        most = max(int(hosts[host] * limits.share), limits.least)
        lines = [x for x in (text or "").split("\n") if not normal(x) or len(documents[host, normal(x)]) <= most]
        words, left = len(WORD.findall(text or "")), len(WORD.findall("\n".join(lines)))
        repeats = WORD.findall(text or "")
        windows = [tuple(repeats[i : i + 3]) for i in range(len(repeats) - 2)]
        count = Counter(windows)
        covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 3)}
        if words >= 50 and 2 * len(covered) <= words and 100 * left > (100 - limits.left_percent) * words:
            out.append((key, host, "\n".join(lines)))
    return sorted(out, key=str)


def test_cleaned_texts_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", "text")
    good = " ".join(f"word{i}" for i in range(60))
    extra = [(9000 + i, s, f"{good} {i}\n\nSame  footer LINE\n{good[::-1]} x{i}") for i in range(30) for s in ("h", None)]
    extra += [(9100, "h", f"{good}\nsame footer line\r\n é\n"), (None, "h", None), (9101, "z", f"{good}\nsame footer line")]
    extra += [(9102, "h", f"{good}\n" + "Same footer line\n" * 40), (9100, "h", good)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    rows = [tuple(r) for r in docs.collect()]
    for limits in (Limits(), Limits(share=0.0, least=1, left_percent=90)):
        got = sorted((tuple(r) for r in line_rules.cleaned(docs, limits).collect()), key=str)
        assert got == brute_cleaned(rows, limits)
    got = line_rules.cleaned(docs)
    texts = {(r.doc_id, r.source): r.text for r in got.collect()}
    assert texts[9000, "h"] == f"{good} 0\n\n{good[::-1]} x0" and "same footer" in texts[9101, "z"]
    assert (9102, "h") not in texts
    clashing = docs.selectExpr("*", "1 as verdict", "'x' as host", "2 as text_key")
    assert line_rules.cleaned(clashing).columns == clashing.columns
    assert line_rules.cleaned(docs.limit(0)).count() == 0
    judged = line_rules.judged(docs)
    assert judged.filter("kept").count() == got.count()


def test_a_line_has_the_same_limit_on_a_hot_and_a_small_host(spark):
    good = " ".join(f"word{i}" for i in range(60))
    sizes = {"hot": 5000, "small": 30}
    rows = [(i, h, f"{good} {h}{i}" + ("\nshared footer" if i < 25 else "\nfew" if i < 45 else "")[: 15])
            for h, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    removed = {(r.source, r.doc_id): r.text.endswith("footer") for r in line_rules.cleaned(docs).select("doc_id", "source", "text").collect()}
    assert len(removed) == len(rows) and not any(removed.values())
    counted = line_rules.judged(docs).filter("removed_words = 2").count()
    assert counted == 50
    # 20 documents of the hot host and 5 of the small one are no more than the limit.
    assert line_rules.cleaned(docs).filter("text like '%few'").count() == 25
