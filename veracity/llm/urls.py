"""URL filters: rules first, then a path-template tree judged by smoothed labelled purity.

Rules have a host and a path. A rule fits its host and all subdomains when the url's path starts
with the rule's; the longest one wins. The urls that a rule decides are the labelled ones.

The method judges the rest. Per host, paths form a tree of segments:

* generalise: digits become ``#``, long mixed identifiers ``{id}``, and what lies beyond ``depth``
  segments one ``**``.
* merge: level by level from the leaves to the root, the branches under one parent are compared by their
  labels. A branch with at least ``least`` labels whose blocked share differs from that of its
  siblings together by more than chance (a two-proportion z-test at ``z``) stays itself, however many
  siblings it has; the others, unlabelled ones included, become one wildcard ``*`` where there are two or
  more. Their sub-branches of the same form are then one branch, so ``/de/#`` and ``/fr/#`` meet as ``/*/#``.
* judge: the blocked share of the merged template is smoothed by that of its host, and the host's by
  that of all labels (``weight`` pseudo-labels each); from ``reject`` on, its urls are blocked.

How it runs: urls are parsed and generalised where they are read, and counted by (host, shape) with
partial sums, so a host that holds a third of all pages is a few rows per task. The tree works on
these distinct shapes. Templates return to the pages by a join on (host, shape), which AQE may
split. The rules are a short list inside the expression.

Defined cases: a null url or one without ``://`` has an empty host and path and is judged like any
other; an empty host is a host; rows that repeat are judged each; without any label the blocked
share is 0; an empty table gives no rows. Only the id and the url are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.llm.common import cut_lineage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: str) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/``, ``?``, ``#`` or the end; then up to ``?``, ``#``."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_column(host: str, path: str, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule ``struct<rule, verdict>`` of ``(host, path, verdict)`` rules, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    chosen = F.lit(None)
    for h, p, verdict in reversed(ordered):
        fits = ((F.col(host) == h) | F.endswith(F.col(host), F.lit("." + h))) & F.startswith(F.col(path), F.lit(p))
        chosen = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen.cast("struct<rule:string,verdict:string>")


def path_shape(path: str, depth: int) -> Column:
    """The path's segments with digits and identifiers generalised, at most ``depth`` of them."""
    parts = F.array_remove(F.split(path, "/"), "")
    whole = F.transform(parts, lambda s: F.when(
        s.rlike(r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_-]{16,}$"), F.lit("{id}")).otherwise(
        F.regexp_replace(s, "[0-9]+", "#")))
    return F.when(F.size(whole) > depth, F.concat(F.slice(whole, 1, depth), F.array(F.lit("**")))).otherwise(whole)


def _merged(shapes: DataFrame, depth: int, z: float, least: int) -> DataFrame:
    """Adds ``template``: the shape with similar branches of each level merged, leaves first."""
    shapes = shapes.withColumn("template", F.col("shape"))
    parent_key = ["host", "parent"]
    for level in range(depth, 0, -1):
        reaches = F.size("template") >= level
        shapes = shapes.withColumn("parent", F.slice("template", 1, level - 1)).withColumn(
            "child", F.when(reaches, F.get("template", F.lit(level - 1))))
        kids = shapes.where(reaches).groupBy(*parent_key, "child").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        above = kids.groupBy(*parent_key).agg(F.sum("n").alias("pn"), F.sum("k").alias("pk"))
        rest, pooled = F.col("pn") - F.col("n"), F.col("pk") / F.col("pn")
        spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("n") + 1 / rest))
        gap = F.abs(F.col("k") / F.col("n") - (F.col("pk") - F.col("k")) / rest)
        alone = F.when((F.col("n") < least) | (F.col("n") == 0) | (rest == 0), False).otherwise(gap > z * spread)
        alike = kids.join(above, parent_key).where(~alone).select(*parent_key, "child")
        several = alike.groupBy(*parent_key).agg(F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
        star = alike.join(several, parent_key).withColumn("star", F.lit(True))
        open_ = F.concat("parent", F.array(F.lit("*")), F.slice("template", level + 1, depth + 1))
        shapes = shapes.join(star, [*parent_key, "child"], "left").withColumn(
            "template", F.when(F.col("star"), open_).otherwise(F.col("template"))).drop("star", "parent", "child")
        shapes = cut_lineage(shapes)
    return shapes


def template_verdicts(pages: DataFrame, depth: int = 6, z: float = 2.0, least: int = 5, weight: float = 10.0,
                      reject: float = 0.6) -> DataFrame:
    """``pages(host, shape, label)`` (label: block, allow or null) -> ``(host, shape, template, purity,
    blocked)`` for each distinct host and shape."""
    block = F.count_if(F.col("label") == "block")
    shapes = cut_lineage(pages.groupBy("host", "shape").agg(F.count("label").alias("n"), block.alias("k")))
    deepest = shapes.agg(F.max(F.size("shape"))).first()[0] or 0         # at most depth + 1
    shapes = _merged(shapes, deepest, z, least)
    leaf = shapes.groupBy("host", F.col("template").alias("merged")).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    hosts = leaf.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("k").alias("hk"))
    every = leaf.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    prior = every["k"] / every["n"] if every["n"] else 0.0
    host_share = (F.col("hk") + weight * prior) / (F.col("hn") + weight)
    purity = (F.col("k") + weight * host_share) / (F.col("n") + weight)
    judged = leaf.join(hosts, "host").select("host", "merged", purity.alias("purity"))
    return (shapes.withColumnRenamed("template", "merged").join(judged, ["host", "merged"])
            .select("host", "shape", F.concat(F.lit("/"), F.array_join("merged", "/")).alias("template"), "purity",
                    (F.col("purity") >= reject).alias("blocked")))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
                depth: int = 6, **tree) -> DataFrame:
    """One row per row of ``pages``: ``id_col, host, path, rule, verdict, template, purity``."""
    host, path = url_parts(url_col)
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.select("*", rule_column("host", "path", rules).alias("r"), path_shape("path", depth).alias("shape"))
    verdicts = template_verdicts(rows.select("host", "shape", F.col("r.verdict").alias("label")), depth, **tree)
    out = rows.join(verdicts, ["host", "shape"])
    return out.select(
        F.col("id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce("r.verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
        "template", "purity")
