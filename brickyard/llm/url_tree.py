"""URL filter: rules, and a path-template tree for what no rule decides.

Labels are the urls that a rule decides. The tree of a host is grown from its
root, a level a path segment. At every node a branch (the urls that share the
next segment) stays on its own if its labelled block rate differs from its
siblings', by a two-sample test on their counts of labels; all other branches,
statistically alike or without labels, merge into one wildcard branch. A
node's purity is its labelled block rate, shrunk to its parent's purity (the
host's to the share of all labels), so a branch without labels has its
parent's purity, all of the parent's labels counted. A url is rejected if the
purity of the template it falls to reaches the threshold.

Whole paths are read: the last of ``LEVELS`` levels takes all segments that are
left as one. DataFrame functions only. Only labelled urls grow the tree. Its
nodes are plain rows (host, node, branch); urls find their way down by one
equi-join a level, with the rows broadcast where their counted bytes allow
it, so urls are not shuffled; beyond that the join splits hot hosts.

Null urls and urls without ``://`` have an empty host and path, and form a
host of their own. A host without labels is not rejected. A segment that is a
star reads as the wildcard. Very long urls are read whole. Repeated rows count
each. Other columns are ignored, whatever their names; an empty table gives no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

LEVELS = 6
#: Bytes (counted) up to which a level's nodes are broadcast.
BROADCAST_BYTES = 32 << 20
#: Width of the test for different block rates; weight of the prior; purity that rejects.
Z, PRIOR, REJECT = 1.96, 4.0, 0.5

RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    part = [F.coalesce(F.regexp_extract(url, _URL, i), F.lit("")) for i in (1, 2)]
    return F.translate(part[0], _UPPER, _LOWER), part[1]


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule as host + path, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _segments(path: Column) -> Column:
    """The path's segments; the last level's holds the rest."""
    segs = F.filter(F.split(path, "/"), lambda s: s != "")
    rest = F.slice(segs, LEVELS, F.greatest(F.size(segs), F.lit(1)))
    return F.when(F.size(segs) > LEVELS, F.concat(F.slice(segs, 1, LEVELS - 1), F.array(F.array_join(rest, "/")))).otherwise(segs)


def _shrunk(blocked: str, labelled: str, parent: Column) -> Column:
    return (F.col(blocked) + PRIOR * parent) / (F.col(labelled) + PRIOR)


def _level(at: DataFrame, d: int) -> DataFrame:
    """The branches of level ``d`` that labelled paths ``at`` (host, node, segs,
    l, b, p) take: (host, node, seg, next, p), with seg null for the wildcard."""
    kids = (at.filter(F.size("segs") >= d).groupBy("host", "node", F.get("segs", F.lit(d - 1)).alias("seg"))
            .agg(F.sum("l").alias("l"), F.sum("b").alias("b"), F.first("p").alias("p")))
    all_of = kids.groupBy("host", "node").agg(F.sum("l").alias("all_l"), F.sum("b").alias("all_b"))
    rest, rate = F.col("all_l") - F.col("l"), F.col("all_b").cast("double") / F.col("all_l")
    apart = F.abs(F.col("b").cast("double") / F.col("l") - (F.col("all_b") - F.col("b")).cast("double") / rest)
    unlike = (rest > 0) & (apart > Z * F.sqrt(rate * (1 - rate) * (F.lit(1.0) / F.col("l") + F.lit(1.0) / rest)))
    branch = kids.join(all_of, ["host", "node"]).withColumn("own", F.when(F.when(rest > 0, unlike).otherwise(F.lit(False)), F.col("seg")))
    return (branch.groupBy("host", "node", F.col("own").alias("seg")).agg(F.sum("l").alias("l"), F.sum("b").alias("b"), F.first("p").alias("up"))
            .select("host", "node", "seg", F.concat("node", F.lit("/"), F.coalesce("seg", F.lit("*"))).alias("next"), _shrunk("b", "l", F.col("up")).alias("p")))


def _small(nodes: DataFrame) -> bool | None:
    """Whether counted bytes allow a broadcast; None if there are no nodes."""
    size = F.sum(F.lit(64) + F.length("host") + F.length("node") + F.coalesce(F.length("seg"), F.lit(0)) + F.length("next"))
    total = nodes.agg(size).first()[0]
    return None if total is None else 4 * total <= BROADCAST_BYTES


def _down(rows: DataFrame, nodes: DataFrame, small: bool, d: int) -> DataFrame:
    """``rows`` (host, node, segs, p, ...) moved on by one level where their path has it."""
    hint = F.broadcast if small else (lambda df: df)
    own = nodes.filter("seg is not null").select("host", "node", F.col("seg").alias("_seg"), F.col("next").alias("_next"), F.col("p").alias("_p"))
    wild = nodes.filter("seg is null").select("host", "node", F.col("p").alias("_wild"))
    j = (rows.withColumn("_seg", F.get("segs", F.lit(d - 1))).join(hint(own), ["host", "node", "_seg"], "left")
         .join(hint(wild), ["host", "node"], "left"))
    here, branch = F.size("segs") >= d, F.col("_next").isNotNull()
    return j.select(*(c for c in rows.columns if c not in ("node", "p")),
                    F.when(here, F.coalesce("_next", F.concat("node", F.lit("/*")))).otherwise(F.col("node")).alias("node"),
                    F.when(here & branch, F.col("_p")).when(here, F.coalesce("_wild", "p")).otherwise(F.col("p")).alias("p"))


def grow(labelled: DataFrame) -> tuple[DataFrame, list[tuple[DataFrame, bool]], float]:
    """From (host, path, l, b): each host's purity (host, p), the branches of
    every level with whether they may be broadcast, and the share of all labels."""
    paths = written(labelled.withColumn("segs", _segments(F.col("path"))).drop("path"), "labelled")
    all_l, all_b = paths.agg(F.sum("l"), F.sum("b")).first()
    prior = all_b / all_l if all_l else 0.0
    hosts = written(paths.groupBy("host").agg(F.sum("l").alias("l"), F.sum("b").alias("b"))
                    .select("host", _shrunk("b", "l", F.lit(prior)).alias("p")), "hosts")
    at, levels = written(paths.join(hosts, "host").withColumn("node", F.lit("")), "paths"), []
    for d in range(1, LEVELS + 1):
        nodes = written(_level(at, d), "nodes")
        small = _small(nodes)
        if small is None:
            break
        levels.append((nodes, small))
        at = _down(at, nodes, small, d)
        at = at if small else written(at, "paths")
    return hosts, levels, prior


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) per row of ``pages`` (page_id, url)."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = rows.withColumn("rule", rule).withColumn("ruled", verdict)
    hosts, levels, prior = grow(ruled.filter("ruled is not null").groupBy("host", "path").agg(
        F.count("*").alias("l"), F.sum(F.when(F.col("ruled") == "block", 1).otherwise(0)).alias("b")))
    size = hosts.agg(F.sum(F.lit(64) + F.length("host"))).first()[0] or 0
    known = hosts.select("host", F.col("p").alias("_root"))
    at = (ruled.withColumn("segs", _segments(F.col("path"))).withColumn("node", F.lit(""))
          .join(F.broadcast(known) if 4 * size <= BROADCAST_BYTES else known, "host", "left")
          .withColumn("p", F.coalesce("_root", F.lit(0 + PRIOR * prior) / F.lit(PRIOR))))
    for d, (nodes, small) in enumerate(levels, 1):
        at = _down(at, nodes, small, d)
    below = F.concat("node", F.repeat(F.lit("/*"), F.greatest(F.size("segs") - len(levels), F.lit(0))))
    reject = F.col("_root").isNotNull() & (F.col("p") >= REJECT)
    return at.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(reject, "block").otherwise("allow")).alias("verdict"),
                     F.when(below == "", "/").otherwise(below).alias("template"), F.col("p").alias("purity"))
