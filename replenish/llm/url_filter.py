"""URL verdicts by rules, and by a path-template tree per host where no rule fits.

1. Paths are split at `/`. Numbers and long hexadecimal names are variable by their form; what
   follows their last dot stays. Equal paths of a host are counted together, with
   the number of pages that a label blocks or allows.
2. From the first segment on, a segment stays as it is where enough pages of its host pass it; the
   others at the same place become the wildcard `*`. Since the least number is a share of the host, the
   tree of a host is bounded whatever its size. Segments beyond `DEPTH` are one variable tail.
3. Branches of a place are merged where their pages do not differ statistically: Hoeffding bounds on the
   shares of blocked, allowed and ending pages, and on the shares of their own branches, all the way
   down. Branches too small to tell apart stay alone.
4. A template (a set of merged branches) is rejected if the share of blocked among its labelled
   pages, smoothed towards one half, reaches `PURITY`.

Pages never gather by host; only the bounded trees do.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replenish.llm.common import col, prepare_python
from replenish.operators.scale import look_up, materialise

# Segments of a template; what follows is one variable tail.
DEPTH = 6
# A segment is kept if so many pages pass it, and this share of the pages of its host.
LEAST_PAGES = 5
LEAST_SHARE = 0.001
# Chance of calling two equal branches different, and the widest bound that still tells anything.
ALPHA = 0.05
WIDEST = 0.5
# Pages by which the share of blocked pages is drawn to one half; the share that rejects.
SMOOTHING = 4.0
PURITY = 0.9

BLOCK, ALLOW = "block", "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """`pattern` is a host, then a path that starts with a slash."""

    pattern: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        own, slash, rest = self.pattern.partition("/")
        same = (host == own) | host.endswith("." + own)
        return same & path.startswith(slash + rest)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), _URL, 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), _URL, 2)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The pattern of the longest rule that fits, null without one. Of rules of the same length that
    fit, the first in the list counts."""
    longest = sorted(rules, key=lambda r: -len(r.pattern))
    return F.coalesce(
        *[F.when(r.fits(host, path), F.lit(r.pattern)) for r in longest], F.lit(None).cast("string")
    )


def _verdict_of(rule: Column, rules: Sequence[Rule]) -> Column:
    known = [F.when(rule == r.pattern, F.lit(r.verdict)) for r in rules]
    return F.coalesce(*known, F.lit(None).cast("string"))


# --- templates --------------------------------------------------------------------------------


def typed_segments(path: Column) -> Column:
    """The segments of a path, variable ones by their form: `#` for a number, `@` for a long
    hexadecimal name. Other segments get a sign in front, so none reads like these."""
    names = F.split(F.regexp_replace(path, "^/", ""), "/")

    def typed(name: Column) -> Column:
        end = F.regexp_extract(name, r"(\.[A-Za-z][A-Za-z0-9]{0,4})?$", 1)
        stem = F.regexp_replace(name, r"\.[A-Za-z][A-Za-z0-9]{0,4}$", "")
        return (
            F.when(stem.rlike(r"^[0-9]+([-_.][0-9]+)*$"), F.concat(F.lit("#"), end))
            .when(stem.rlike(r"^[0-9a-fA-F-]{16,}$"), F.concat(F.lit("@"), end))
            .otherwise(F.concat(F.lit("="), name))
        )

    tail = F.when(F.size(names) > DEPTH, F.array(F.lit("..."))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.transform(F.slice(names, 1, DEPTH), typed), tail)


def counted_paths(urls: DataFrame) -> DataFrame:
    """host, typed, pages, blocked, allowed of a table (host, typed, label)."""
    return materialise(
        urls.groupBy("host", "typed").agg(
            F.count(F.lit(1)).alias("pages"),
            F.count_if(F.col("label") == BLOCK).alias("blocked"),
            F.count_if(F.col("label") == ALLOW).alias("allowed"),
        )
    )


def templates(paths: DataFrame) -> DataFrame:
    """`paths` with their template: an array of segments, rare ones replaced by `*`."""
    hosts = paths.groupBy("host").agg(F.sum("pages").alias("n"))
    least = materialise(
        hosts.select("host", F.greatest(F.lit(LEAST_PAGES), F.ceil(F.col("n") * LEAST_SHARE)).alias("least"))
    )
    deepest = paths.agg(F.max(F.size("typed"))).first()[0] or 0
    grown = paths.withColumn("template", F.array().cast("array<string>"))
    for level in range(deepest):
        placed = grown.withColumn("segment", F.get("typed", F.lit(level)))
        passed = placed.filter("segment is not null").groupBy("host", "template", "segment")
        kept = (
            look_up(passed.agg(F.sum("pages").alias("n")), least, ["host"])
            .filter("n >= least")
            .select("host", "template", "segment", F.lit(True).alias("kept"))
        )
        found = look_up(placed, materialise(kept), ["host", "template", "segment"])
        own = F.when(F.col("kept"), F.col("segment")).otherwise(F.lit("*"))
        grown = materialise(
            found.withColumn(
                "template",
                F.when(F.col("segment").isNull(), F.col("template")).otherwise(
                    F.concat("template", F.array(own))
                ),
            ).drop("segment", "kept")
        )
    return grown


# --- the tree of one host ---------------------------------------------------------------------


@dataclass
class Node:
    """Pages that pass a place of the tree: all, blocked, allowed, ending here; branches by segment.
    `members` are the templates that end here."""

    pages: int = 0
    blocked: int = 0
    allowed: int = 0
    ending: int = 0
    branches: dict[str, Node] = field(default_factory=dict)
    members: list[int] = field(default_factory=list)

    def add(self, segments: Sequence[str], row: int, pages: int, blocked: int, allowed: int) -> None:
        node = self
        for segment in (None, *segments):
            if segment is not None:
                node = node.branches.setdefault(segment, Node())
            node.pages += pages
            node.blocked += blocked
            node.allowed += allowed
        node.ending += pages
        node.members.append(row)

    def absorb(self, other: Node) -> None:
        self.pages += other.pages
        self.blocked += other.blocked
        self.allowed += other.allowed
        self.ending += other.ending
        self.members += other.members
        for segment, branch in other.branches.items():
            if segment in self.branches:
                self.branches[segment].absorb(branch)
            else:
                self.branches[segment] = branch


def bound(one: int, other: int) -> float:
    """How far two shares of so many pages may be apart by chance."""
    return float(np.sqrt(np.log(2 / ALPHA) / 2) * (one**-0.5 + other**-0.5))


def distance(one: Node, other: Node) -> float | None:
    """The greatest difference of shares of two branches, None where they differ beyond chance at
    any place, or are too small to tell. Only places that both have are compared further down."""
    limit = bound(one.pages, other.pages)
    if limit > WIDEST:
        return None
    names = one.branches.keys() | other.branches.keys()
    shares = [
        (n.blocked, n.allowed, n.ending, *(n.branches[s].pages if s in n.branches else 0 for s in names))
        for n in (one, other)
    ]
    apart = np.abs(np.array(shares[0]) / one.pages - np.array(shares[1]) / other.pages).max()
    if apart > limit:
        return None
    for name in one.branches.keys() & other.branches.keys():
        a, b = one.branches[name], other.branches[name]
        if bound(a.pages, b.pages) <= WIDEST:
            below = distance(a, b)
            if below is None:
                return None
            apart = max(apart, below)
    return float(apart)


def merge(node: Node) -> None:
    """Merges the similar branches of a place, the most frequent first, each into the nearest; then
    goes down. A merged branch stands under the name of its first."""
    merged: dict[str, Node] = {}
    for name, branch in sorted(node.branches.items(), key=lambda x: (-x[1].pages, x[0])):
        near = [(d, i, n) for i, n in enumerate(merged) if (d := distance(merged[n], branch)) is not None]
        if near:
            merged[min(near)[2]].absorb(branch)
        else:
            merged[name] = branch
    node.branches = merged
    for branch in merged.values():
        merge(branch)


def purity(blocked: int, allowed: int) -> float:
    return (blocked + SMOOTHING / 2) / (blocked + allowed + SMOOTHING)


def judged_templates(rows: pd.DataFrame) -> np.ndarray:
    """The purity of each template (template, pages, blocked, allowed) of one host."""
    root, out = Node(), np.zeros(len(rows))
    ordered = rows.assign(key=rows.template.map(tuple)).sort_values("key")
    for row in ordered.itertuples():
        root.add(row.key, row.Index, int(row.pages), int(row.blocked), int(row.allowed))
    merge(root)
    counts = rows[["blocked", "allowed"]].to_numpy()

    def visit(node: Node) -> None:
        if node.members:
            out[node.members] = purity(*counts[node.members].sum(axis=0))
        for branch in node.branches.values():
            visit(branch)

    visit(root)
    return out


def rejected_paths(paths: DataFrame) -> DataFrame:
    """host, typed of the paths whose template is rejected, from counted paths."""
    prepare_python(paths.sparkSession)
    grown = templates(paths)
    counts = grown.groupBy("host", "template").agg(
        *[F.sum(c).alias(c) for c in ("pages", "blocked", "allowed")]
    )

    def judge(tree: pd.DataFrame) -> pd.DataFrame:
        tree = tree.reset_index(drop=True)
        return tree.assign(purity=judged_templates(tree))[["host", "template", "purity"]]

    judged = counts.groupBy("host").applyInPandas(
        judge, "host string, template array<string>, purity double"
    )
    bad = materialise(judged.filter(F.col("purity") >= PURITY).select("host", "template"))
    return materialise(grown.join(bad, ["host", "template"], "left_semi").select("host", "typed"))


def judged(
    pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row per row of `pages`: page_id, host, path, rule, verdict.

    Pages that a rule decides are the labelled ones; the others are blocked where their template is
    rejected, else allowed. A null url, or one without `://`, has an empty host and path, which
    make a template of their own that no rule labels. Keys may repeat or be null: every row
    counts; an empty table gives no rows. Other columns are not read.
    """
    host, path = host_of(col(url)), path_of(col(url))
    found = pages.select(
        col(key).alias("page_id"),
        host.alias("host"),
        path.alias("path"),
    ).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    typed = F.array_join(typed_segments(F.col("path")), "/")
    placed = found.withColumn("typed", typed).withColumn("label", _verdict_of(F.col("rule"), rules))
    counts = counted_paths(placed.select("host", typed_segments(F.col("path")).alias("typed"), "label"))
    bad = rejected_paths(counts).select(
        "host", F.array_join("typed", "/").alias("typed"), F.lit(BLOCK).alias("learned")
    )
    decided = look_up(placed, materialise(bad), ["host", "typed"])
    return decided.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("label", "learned", F.lit(ALLOW)).alias("verdict"),
    )
