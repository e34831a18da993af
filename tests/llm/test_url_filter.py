from __future__ import annotations

import re
from collections import Counter, defaultdict
from math import ceil

import pytest

from replenish.llm import url_filter
from replenish.llm.queries import QUERIES, URL_RULES


def parsed(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at])
    rest = rest[at:]
    at = next((i for i, c in enumerate(rest) if c in "?#"), len(rest))
    return host, rest[:at]


def ruled(host: str, path: str, rules) -> url_filter.Rule | None:
    fit = []
    for rule in rules:
        own, rest = rule.pattern[: rule.pattern.index("/")], rule.pattern[rule.pattern.index("/") :]
        if (host == own or host.endswith("." + own)) and path.startswith(rest):
            fit.append(rule)
    return max(fit, key=lambda r: len(r.pattern), default=None)


def typed(path: str) -> tuple[str, ...]:
    names = re.sub("^/", "", path).split("/")
    out = []
    for name in names[: url_filter.DEPTH]:
        end = re.search(r"(\.[A-Za-z][A-Za-z0-9]{0,4})?\Z", name)[0]
        stem = name[: len(name) - len(end)]
        if re.fullmatch(r"[0-9]+([-_.][0-9]+)*", stem):
            out.append("#" + end)
        elif re.fullmatch(r"[0-9a-fA-F-]{16,}", stem):
            out.append("@" + end)
        else:
            out.append("=" + name)
    return (*out, "...") if len(names) > url_filter.DEPTH else tuple(out)


def brute(urls: list[str | None], rules) -> list[tuple]:
    """host, path, rule, verdict; counts and trees in plain Python, host by host."""
    found = [(*parsed(u), ruled(*parsed(u), rules)) for u in urls]
    hosts = defaultdict(list)
    for i, (host, path, _) in enumerate(found):
        hosts[host].append((i, typed(path)))
    bad = set()
    for rows in hosts.values():
        least = max(url_filter.LEAST_PAGES, ceil(len(rows) * url_filter.LEAST_SHARE))
        place = {i: () for i, _ in rows}
        for level in range(url_filter.DEPTH + 1):
            counts = Counter((place[i], t[level]) for i, t in rows if level < len(t))
            for i, t in rows:
                if level < len(t):
                    kept = counts[place[i], t[level]] >= least
                    place[i] = (*place[i], t[level] if kept else "*")
        table = defaultdict(lambda: [0, 0, 0])
        for i, _ in rows:
            rule = found[i][2]
            for n, add in enumerate((True, rule and rule.verdict == "block", rule and rule.verdict == "allow")):
                table[place[i]][n] += bool(add)
        root, names = url_filter.Node(), sorted(table)
        for number, name in enumerate(names):
            root.add(name, number, *table[name])
        url_filter.merge(root)
        todo = [root]
        while todo:
            node = todo.pop()
            todo += node.branches.values()
            sums = [sum(table[names[m]][n] for m in node.members) for n in (1, 2)]
            if node.members and url_filter.purity(*sums) >= url_filter.PURITY:
                bad |= {(id(rows), names[m]) for m in node.members}
        bad |= {i for i, _ in rows if (id(rows), place[i]) in bad}
    return [
        (h, p, r and r.pattern, r.verdict if r else "block" if i in bad else "allow")
        for i, (h, p, r) in enumerate(found)
    ]


def run(spark, urls, rules):
    rows = [(i, u, "x", "y") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, verdict string")
    found = sorted(url_filter.judged(pages.repartition(4), rules).collect())
    assert [r.page_id for r in found] == list(range(len(urls)))
    return [tuple(r)[1:] for r in found]


def test_query_equals_brute_force(spark):
    for sf in ("0.01", "0.1"):
        path = f"/root/testdata/sf{sf}"
        pages = {r.page_id: r.url for r in spark.read.parquet(f"{path}/pages.parquet").collect()}
        rows = sorted(QUERIES["op13_url_filter"](spark, path).collect())
        assert [tuple(r)[1:] for r in rows] == brute([pages[r.page_id] for r in rows], URL_RULES)
        assert len(rows) == len(pages)


EDGES = [
    None, "", "no scheme", "http://", "http://A.Example.NET", "HTTP://x.NET/", "a://b://c.net/x", "ftp://É.net/q?x#y",
    "http://net/en/", "http://planet/en/", "http://h?x://y.net/", "http://example.com/de/1", "http://example.com/de",
    "http://my.example.com/de/a/b/c/d/e/f/g/h", "http://x.org/fr/#", "http://x.org:80/fr/", "http://e.net/\nx",
    "http://w.example.net/en/1", "http://w.example.net/en/1", "http://w/.../a/b/c/d/e/f/.../g",
]


def test_hosts_paths_and_rules(spark):
    assert run(spark, EDGES, URL_RULES) == brute(EDGES, URL_RULES)
    assert url_filter.judged(
        spark.createDataFrame([], "page_id bigint, url string"), URL_RULES
    ).collect() == []


# Rules that label part of the pages of a template.
PARTLY = (
    url_filter.Rule("shop.test/tag/a", "block"),
    url_filter.Rule("shop.test/item/1", "allow"),
    url_filter.Rule("shop.test/old/1", "block"),
)


def shop() -> list[str]:
    tags = [f"http://shop.test/tag/{c}{n}x" for c in "ab" for n in range(60)]
    items = [f"http://shop.test/item/{n}" for n in range(1, 200)]
    return tags + items + [f"http://shop.test/new/{n}" for n in range(80)] + ["http://shop.test/x"]


def test_templates_carry_labels_to_unlabelled_pages(spark):
    urls = shop()
    found = run(spark, urls, PARTLY)
    assert found == brute(urls, PARTLY)
    verdicts = dict(zip(urls, found))
    # Names of tags are variable: half are labelled, all of these blocked.
    assert verdicts["http://shop.test/tag/b7x"] == ("shop.test", "/tag/b7x", None, "block")
    assert verdicts["http://shop.test/item/77"][2:] == (None, "allow")
    assert verdicts["http://shop.test/new/7"][2:] == (None, "allow")


def test_similar_branches_are_merged_and_different_ones_are_not(spark):
    rules = (url_filter.Rule("s.test/a/1", "block"), url_filter.Rule("s.test/b/1", "block"))
    similar = [f"http://s.test/{b}/{d}{n}" for b in "ab" for d in "12" for n in range(40)]
    other = [f"http://s.test/c/2{n}" for n in range(80)] + ["http://s.test/d/1"] * 3
    found = run(spark, similar + other, rules)
    assert found == brute(similar + other, rules)
    assert {v for *_, r, v in found[: len(similar)]} == {"block"}
    assert {v for *_, r, v in found[len(similar) :]} == {"allow"}


@pytest.mark.parametrize("pages, apart", [((100, 95), False), ((100, 10), True), ((4, 4), True)])
def test_distance_needs_evidence(pages, apart):
    one, other = url_filter.Node(), url_filter.Node()
    one.add(("#",), 0, 100, pages[0], 0)
    other.add(("#",), 1, 100, pages[1], 0)
    few = url_filter.Node()
    few.add(("#",), 2, 4, 4, 0)
    if pages[0] < 10:
        assert url_filter.distance(one, few) is None
    else:
        assert (url_filter.distance(one, other) is None) == apart


def test_a_hot_host_keeps_a_bounded_tree(spark):
    urls = [f"http://hot.test/{n:05d}x/{n % 7}" for n in range(6000)] + ["http://cold.test/1"] * 2
    rows = [(i, u) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    placed = pages.select(
        url_filter.host_of(pages.url).alias("host"),
        url_filter.typed_segments(url_filter.path_of(pages.url)).alias("typed"),
    ).selectExpr("*", "cast(null as string) as label")
    grown = url_filter.templates(url_filter.counted_paths(placed))
    assert {tuple(r.template) for r in grown.filter("host = 'hot.test'").collect()} == {("*", "#")}
