"""URL filters: declared rules, then a learned path-template tree (DataFrame
operations only).

A url is judged by the longest declared rule that fits it.  All others are
judged by the template of their path in a tree that is grown per host:

* a path is cut into segments, and runs of digits become ``#``, so that
  numbered pages share a path from the start; urls are aggregated by host and
  such path before anything else is done;
* level by level from the host down, the children of a node merge into one
  wildcard ``*`` if their labelled share of bad urls does not differ
  significantly from that of the other children (two-proportion z test); a child
  that differs stays a branch of its own, however many children there are;
* a template is rejected if its purity, the share of good labelled urls, is
  below ``min_purity`` after smoothing: a template is drawn towards its host,
  and a host towards the whole table, by pseudo-counts.

Scale: counts are hash aggregations with map-side combine; a host with a third
of all urls shrinks to its distinct digit-free paths before any join, and
joins are plain equi-joins that AQE can split.  The number of levels is the
parameter ``depth``; deeper segments are the last level's children as a whole.

Defined results: a null url, or one without ``://``, has empty host and path;
a null label is no label; repeated rows are judged alike; an empty table gives
an empty result; further columns are ignored by ``judge``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class TemplateTree:
    depth: int = 6
    max_children: int = 64        # without effect: the test below holds for nodes of any width
    z: float = 2.576              # significance of a branch of its own (1 %)
    host_weight: float = 20.0     # pseudo-labels of the table in a host
    template_weight: float = 10.0  # pseudo-labels of the host in a template
    min_purity: float = 0.5


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def longest_rule(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest of ``rules`` (``host/path`` -> verdict) that fits, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r), r)):      # the last fitting one stays
        h, slash, p = r.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule = F.when(fits, r).otherwise(rule)
        verdict = F.when(fits, rules[r]).otherwise(verdict)
    return rule, verdict


def _shape(path: Column) -> Column:
    return F.regexp_replace(path, "[0-9]+", "#")


def _segment(level: int, depth: int) -> Column:
    """The shape's segment at a level; at the last level, all that is left."""
    segments = F.split("shape", "/")
    if level < depth - 1:
        return F.get(segments, F.lit(level + 1))
    return F.when(F.size(segments) > depth, F.array_join(F.slice(segments, depth + 1, 1 << 30), "/"))


def _significant(bad: str, n: str, all_bad: str, all_n: str, z: float) -> Column:
    """Whether bad/n differs from the rate of the other children."""
    rest_bad, rest_n = F.col(all_bad) - F.col(bad), F.col(all_n) - F.col(n)
    p = F.col(all_bad) / F.col(all_n)
    spread = p * (1 - p) * (1 / F.col(n) + 1 / rest_n)
    gap = F.col(bad) / F.col(n) - rest_bad / rest_n
    return F.when((F.col(n) > 0) & (rest_n > 0) & (F.col(all_bad) > 0) & (F.col(all_bad) < F.col(all_n)),
                  gap * gap > z * z * spread).otherwise(False)


def grow(paths: DataFrame, how: TemplateTree) -> DataFrame:
    """Adds ``template`` to (host, shape, labelled, bad)."""
    tree = paths.withColumn("template", F.lit(""))
    for level in range(how.depth):
        tree = tree.withColumn("seg", _segment(level, how.depth))
        children = (tree.where(F.col("seg").isNotNull())
                    .groupBy("host", "template", "seg").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b")))
        nodes = children.groupBy("host", "template").agg(
            F.sum("n").alias("all_n"), F.sum("b").alias("all_b"))
        own = _significant("b", "n", "all_b", "all_n", how.z)
        branches = (children.join(nodes, ["host", "template"]).where(own).select(
            "host", "template", "seg", F.col("seg").alias("own")))
        grown = tree.join(branches, ["host", "template", "seg"], "left")
        tree = written(grown.select(
            "host", "shape", "labelled", "bad",
            F.when(F.col("seg").isNull(), F.col("template")).otherwise(
                F.concat("template", F.lit("/"), F.coalesce("own", F.lit("*")))).alias("template")),
            f"url-tree-{level}")
    return tree


def templates(tree: DataFrame, how: TemplateTree) -> DataFrame:
    """(host, template, purity): smoothed share of good labelled urls."""
    whole = tree.agg(F.sum("bad").alias("table_bad"), F.sum("labelled").alias("table_n"))
    rate = F.when(F.col("table_n") > 0, F.col("table_bad") / F.col("table_n")).otherwise(0.0)
    whole = whole.select(rate.alias("rate")).scalar()
    hosts = tree.groupBy("host").agg(F.sum("bad").alias("hb"), F.sum("labelled").alias("hn"))
    hosts = hosts.select("host", ((F.col("hb") + how.host_weight * whole)
                                  / (F.col("hn") + how.host_weight)).alias("host_rate"))
    by_template = tree.groupBy("host", "template").agg(F.sum("bad").alias("b"), F.sum("labelled").alias("n"))
    return by_template.join(hosts, "host").select(
        "host", "template", (1 - (F.col("b") + how.template_weight * F.col("host_rate"))
                             / (F.col("n") + how.template_weight)).alias("purity"))


def judge(urls: DataFrame, url_id: str, rules: dict[str, str], url: str = "url", bad: str = "bad",
          how: TemplateTree = TemplateTree()) -> DataFrame:
    """One row per row of ``urls``: url_id, host, path, rule, verdict,
    template, purity.  ``bad`` is 1, 0 or null (no label)."""
    host, path = parts(F.col(f"`{url}`"))
    rows = urls.select(F.col(f"`{url_id}`").alias(url_id), host.alias("host"), path.alias("path"),
                       F.col(f"`{bad}`").cast("long").alias("bad")).withColumn("shape", _shape(F.col("path")))
    paths = rows.groupBy("host", "shape").agg(
        F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    tree = grow(paths, how)
    verdicts = tree.select("host", "shape", "template").join(templates(tree, how), ["host", "template"])
    rule, ruled = longest_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("purity") < how.min_purity, "block").otherwise("allow")
    return rows.join(verdicts, ["host", "shape"]).select(
        url_id, "host", "path", rule.alias("rule"), F.coalesce(ruled, learned).alias("verdict"),
        "template", "purity")
