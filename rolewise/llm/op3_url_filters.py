"""URL filters: explicit rules first, then a path-template tree that is judged by labelled purity.

A host is what follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; the path goes on up to `?`, `#` or
the end; without `://` both are empty.  A rule (host, path) fits its host and all subdomains if the path starts with its
path; the longest rule wins.

Urls that a rule decides are the labelled ones.  Per host, the segments of the paths make a tree, level by level.  Under
each node a segment stays literal if it has support and its share of blocked labels differs from that of its siblings
(two-proportion test), or if it alone is labelled; variable segments (with a digit, or below the support)
and branches that the labels don't tell apart merge into the wildcard `*`.  A template is rejected if its smoothed share of
blocked labels, (blocked + PRIOR * WEIGHT) / (labelled + WEIGHT), reaches REJECT; so a template without labels is allowed.

All steps are aggregations and joins by (host, template, segment), pre-aggregated before they are shuffled.  Paths are
walked to their last segment, whatever their length; one that is alone at its node ends in wildcards.  Null urls have empty host and path;
repeated rows count as often as they come; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .stage import discard, staged, table

SUPPORT = 5
DIFFERENT = 1.96
PRIOR, WEIGHT, REJECT = 0.5, 2.0, 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Host, path, verdict.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def parts(url: Column) -> tuple[Column, Column]:
    pattern = r"://([^/?#]*)([^?#]*)"
    url = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER), F.regexp_extract(url, pattern, 2)


def ruled(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null without one."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, verdict = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, rule_verdict).otherwise(verdict)
    return name, verdict


def templates(labelled: DataFrame) -> DataFrame:
    """host, path, template for the distinct (host, path) of a table that has the counts n, allowed and blocked.

    A level is one step for all hosts.  Paths without a further segment leave, and so do those that are alone at their
    node: nothing tells their segments apart, so the rest are wildcards.  The walk ends when none is left."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    nodes = staged(labelled.select("host", "path", "n", "allowed", "blocked", segments.alias("segments"), F.size(segments).alias("rest"), F.lit("").alias("template")))
    done, level = [nodes.filter("rest = 0")], 0
    while nodes.filter("rest > 0").limit(1).count():
        nodes = nodes.filter("rest > 0").withColumn("segment", F.element_at("segments", level + 1))
        sums = [F.sum(c).alias(c) for c in ("n", "allowed", "blocked")]
        branches = staged(nodes.groupBy("host", "template", "segment").agg(*sums, F.count(F.lit(1)).alias("paths")))
        whole = branches.groupBy("host", "template").agg(*[F.sum(c).alias(f"all_{c}") for c in ("n", "allowed", "blocked", "paths")])
        mine, all_ = F.col("allowed") + F.col("blocked"), F.col("all_allowed") + F.col("all_blocked")
        rest, rest_blocked = all_ - mine, F.col("all_blocked") - F.col("blocked")
        pooled = F.col("all_blocked") / F.greatest(all_, F.lit(1))
        error = F.sqrt(pooled * (1 - pooled) * (1 / F.greatest(mine, F.lit(1)) + 1 / F.greatest(rest, F.lit(1))))
        gap = F.abs(F.col("blocked") / F.greatest(mine, F.lit(1)) - rest_blocked / F.greatest(rest, F.lit(1)))
        apart = F.when((mine > 0) & (rest > 0), gap > DIFFERENT * error).otherwise((mine > 0) & (F.col("all_n") > F.col("n")))
        known = (F.col("n") >= SUPPORT) | ((mine > 0) & (rest == 0))
        literal = known & ~F.col("segment").rlike("[0-9]") & apart
        chosen = branches.join(whole, ["host", "template"]).select(
            "host", "template", "segment", F.concat("template", F.lit("/"), F.when(literal, F.col("segment")).otherwise("*")).alias("next"),
            (F.col("all_paths") == 1).alias("alone"))
        nodes = staged(nodes.join(chosen, ["host", "template", "segment"]).select(
            "host", "path", "n", "allowed", "blocked", "segments", F.when(F.col("alone"), 0).otherwise(F.col("rest") - 1).alias("rest"),
            F.concat("next", F.when(F.col("alone"), F.repeat(F.lit("/*"), F.col("rest") - 1)).otherwise("")).alias("template")))
        discard(branches)
        done.append(nodes.filter("rest = 0"))
        level += 1
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return found.select("host", "path", "n", "allowed", "blocked", "template")


def judge(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template and purity for each row of pages."""
    host, path = parts(F.col("url"))
    rows = staged(pages.select("page_id", host.alias("host"), path.alias("path")))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    counts = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).withColumn("v", verdict).select(
        "host", "path", "n", *[F.when(F.col("v") == v, F.col("n")).otherwise(0).alias(a) for v, a in (("allow", "allowed"), ("block", "blocked"))])
    known = staged(templates(counts))
    purity = (F.sum("blocked") + PRIOR * WEIGHT) / (F.sum("allowed") + F.sum("blocked") + WEIGHT)
    judged = known.select("host", "path", "template").join(known.groupBy("host", "template").agg(purity.alias("purity")), ["host", "template"])
    return rows.join(judged, ["host", "path"], "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("purity") >= REJECT, "block").otherwise("allow")).alias("verdict"), "template", "purity")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages", "page_id", "url"))
