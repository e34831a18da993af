from __future__ import annotations

import pytest
import regex

from replenish.llm import licenses

APART = regex.compile(r"[^\p{L}\p{N}]+")


def pairs(text):
    words = APART.sub(" ", text.lower()).split()
    return set(zip(words, words[1:]))


KNOWN = [(name, pairs(text)) for name, text in licenses.TEMPLATES]


def brute(text, percent=licenses.PERCENT):
    found = []
    text = text or ""
    for line, unit in [(0, text), *enumerate(text.split("\n"), 1)]:
        own = pairs(unit)
        for i, (name, known) in enumerate(KNOWN):
            if 200 * len(own & known) >= percent * (len(own) + len(known)):
                found.append((-2 * len(own & known) / (len(own) + len(known)), i, name, line))
    if not found:
        return None, None, 0, ""
    best = min(found)
    return best[2], -best[0], len({f[3] for f in found}), ",".join(sorted({f[2] for f in found}))


def same(got, text):
    name, dice, units, names = brute(text)
    assert (got.licence, got.n_units, got.licences) == (name, units, names)
    assert got.dice == (None if dice is None else pytest.approx(dice))


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = licenses.scanned(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        same(r, texts[r.doc_id])
        assert ("icense" in texts[r.doc_id]) == (r.licence is not None)


def test_edited_notices_and_edge_rows(spark):
    full = licenses.TEMPLATES[-3][1]
    texts = [None, "", "word", " \n\n", full, full.replace(",", "").upper(), full.replace("hereby", "now"),
             full.replace("software", "work").replace("Software", "Work"), "released under the mit license",
             "x y z\nReleased under the  MIT-License!\nLicensed under CC BY-NC 4.0.", "under the", "license " * 200,
             "Licenſed under the Apache License, Version 2.0.\n" * 3, "long words " * 60000,
             "LİCENSED under the Apache License, Version 2.0.", "released under the MİT LICENSE", "Wor\u212a released under the MIT license",
             "a b\n" * 5000 + "Licensed under the BSD 2-Clause License."]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[8]), (8, texts[8]), (8, texts[8])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as line", "'x' as pair")
    got = licenses.scanned(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        same(r, texts[8 if r.doc_id is None else r.doc_id])
    assert licenses.scanned(docs.limit(0)).count() == 0
    assert licenses.scanned(docs, templates=[]).filter("licence is not null").count() == 0


def test_anchors_are_in_every_match():
    for (name, known), (_, text) in zip(KNOWN, licenses.TEMPLATES):
        own = [" ".join(p) for p in known]
        words = licenses.anchors(own, licenses.PERCENT)
        without = [p for p in own if not set(p.split()) & set(words)]
        best = 200 * len(without) / (len(own) + len(without))
        assert words and best < licenses.PERCENT


def test_only_native_operators(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    plan = licenses.matches(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


ALL = [(name, pairs(text)) for name, text in licenses.TEMPLATES + licenses.FULL_TEXTS]


def brute_windows(text, percent=licenses.PERCENT):
    """licence, dice, start and words of the best window and all licences, over every window."""
    words = APART.sub(" ", (text or "").lower()).split()
    own, best = list(zip(words, words[1:])), {}
    for t, (name, known) in enumerate(ALL):
        most, m = len(known) * (200 - percent) // percent, len(known)
        for a in (i for i, p in enumerate(own) if p in known):
            seen, foreign = set(), 0
            for k, p in enumerate(own[a : a + most]):
                if p in known:
                    seen.add(p)
                    both = len(seen) + foreign + m
                    if 200 * len(seen) >= percent * both:
                        window = (2 * len(seen) / both, -a - 1, k + 2, len(seen), name)
                        best[t] = max(best.get(t, window), window)
                else:
                    foreign += 1
    if not best:
        return None, None, None, None, ""
    dice, start, n, _, name = min((-w[3], -w[0], t, w) for t, w in best.items())[3]
    return name, dice, -start, n, ",".join(sorted({w[4] for w in best.values()}))


def test_notices_in_wrapped_text_and_paragraphs(spark):
    import textwrap

    filler = "some prose that says nothing about anything of note . " * 40
    long = [(n, t) for n, t in licenses.TEMPLATES + licenses.FULL_TEXTS if len(t) > 150]
    comment = lambda t, mark: "\n".join(mark + x for x in textwrap.wrap(t, 60))
    planted = [(n, f"#!/bin/x\n{comment(t, mark)}\n\n{filler}") for n, t in long for mark in ("# ", " * ", "")]
    planted += [(n, f"{filler} {t} {filler}") for n, t in licenses.TEMPLATES + licenses.FULL_TEXTS]
    planted += [("MIT", f"{filler}\nCopyright (c) 2020 A\n{comment(licenses.FULL_TEXTS[0][1].replace('AUTHORS', 'WRITERS'), '// ')}\n{filler}"),
                (None, filler + "the license of this software is not known to the author"), (None, ""), (None, None),
                (None, "license license software of the " * 3000)]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(planted)] * 2, "doc_id bigint, text string")
    got = licenses.noticed(docs.selectExpr("*", "1 as start", "'x' as pair")).collect()
    assert len(got) == 2 * len(planted)
    for r in got:
        name, text = planted[r.doc_id]
        best, dice, start, n, names = brute_windows(text)
        assert (r.licence, r.start, r.n_words, r.licences) == (best, start, n, names)
        assert r.dice == (None if dice is None else pytest.approx(dice))
        assert name == r.licence
    assert licenses.noticed(docs.limit(0)).count() == 0
    assert licenses.noticed(docs, templates=[]).filter("licence is not null").count() == 0
    plan = licenses.windows(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
