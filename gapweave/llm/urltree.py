"""URL filter: rules, and a path-template tree for what no rule fits.

Paths become shapes: variable-looking segments (numbers, long hexadecimal ids) turn into
'*' row by row, and equal shapes of a host are counted together. From there the tree of
each host is built level by level on the counts: below a node with many children, rare
ones turn into '*'. The labelled ones of the others, in the order of their blocked rates, are compared branch with
branch: neighbours whose rates do not differ significantly merge into '#' and the first of their names ('#' is in no path). A
branch without labels is like no other and stays apart. A template is rejected if the smoothed share of its labelled
rows that are blocked reaches the limit; smoothing leans on the host, and the host on all rows.
Every step is an aggregation or a join on counts, so no host is gathered in one task.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gapweave.llm.shared import discard, materialise

#: (verdict, rule): host and its subdomains, from the slash on the start of the path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Levels of the tree, or more where a rule is deeper; what lies deeper is one '**'.
DEPTH = 8
#: A node with more children generalises those that have less than this share of its rows.
MAX_CHILDREN, MIN_SHARE = 20, 0.05
#: Standard errors by which the labelled rates of two branches must differ for them to stay apart.
SIGNIFICANT = 1.96
#: Pseudo-rows of smoothing, and the smoothed blocked share from which a template is rejected.
SMOOTH, LIMIT = 4.0, 0.8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url or one without '://'."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), ascii_uppercase, ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null."""
    found = []
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        at = rule.index("/")
        own = (host == rule[:at]) | host.endswith("." + rule[:at])
        found.append(F.when(own & path.startswith(rule[at:]), F.lit(rule)))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def shape(path: Column, depth: int = DEPTH) -> Column:
    """Segments of a path with variable-looking ones as '*' and file endings left out."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    bare = F.transform(parts, lambda x: F.regexp_replace(x, r"(?<=.)\.[A-Za-z0-9]{1,5}$", ""))
    starred = F.transform(bare, lambda x: F.when(x.rlike(r"^[0-9]+$|^(?=[^0-9]*[0-9])[0-9A-Fa-f-]{8,}$"), "*").otherwise(x))
    return F.when(F.size(starred) > depth, F.concat(F.slice(starred, 1, depth), F.array(F.lit("**")))).otherwise(starred)


def _level(shapes: DataFrame, i: int) -> DataFrame:
    """shapes with segment i generalised and added to the template."""
    rows = shapes.withColumn("segment", F.coalesce(F.get("shape", F.lit(i)), F.lit("")))
    nodes = rows.groupBy("host", "template", "segment").agg(F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("blocked").alias("blocked"))
    above = nodes.groupBy("host", "template").agg(F.count("*").alias("children"), F.sum("n").alias("n_all"))
    special = F.col("segment").isin("", "*", "**")
    branch = F.when(~special & (F.col("children") > MAX_CHILDREN) & (F.col("n") < MIN_SHARE * F.col("n_all")), "*").otherwise(F.col("segment"))
    nodes = nodes.join(above, ["host", "template"]).select("host", "template", "segment", branch.alias("branch"), "known", "blocked")
    # what is left below a node: its frequent children, MAX_CHILDREN or 1 / MIN_SHARE at most
    branches = nodes.filter(~F.col("branch").isin("", "*", "**")).groupBy("host", "template", "branch").agg(F.sum("known").alias("k"), F.sum("blocked").alias("b")).filter("k > 0")
    order = W.partitionBy("host", "template").orderBy(F.col("b") / F.col("k"), "branch")
    k, b, k0, b0 = F.col("k"), F.col("b"), F.lag("k").over(order), F.lag("b").over(order)
    rate = (b + b0) / (k + k0)
    differs = F.abs(b / k - b0 / k0) > F.lit(SIGNIFICANT) * F.sqrt(rate * (1 - rate) * (1 / k + 1 / k0)) + F.lit(1e-9)
    branches = branches.withColumn("differs", F.coalesce(differs.cast("int"), F.lit(0))).withColumn("kind", F.sum("differs").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    alike = W.partitionBy("host", "template", "kind")
    branches = branches.select("host", "template", "branch", F.when(F.count("*").over(alike) > 1, F.concat(F.lit("#"), F.min("branch").over(alike))).otherwise(F.col("branch")).alias("merged"))
    named = nodes.join(branches, ["host", "template", "branch"], "left").select("host", "template", "segment", F.coalesce("merged", "branch").alias("symbol"))
    grown = F.when(F.col("symbol") == "", F.col("template")).otherwise(F.concat("template", F.lit("/"), "symbol"))
    return rows.join(named, ["host", "template", "segment"]).select("host", "shape", "n", "known", "blocked", grown.alias("template"))


def templates(rows: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(host, shape, template, purity) from rows (host, shape, blocked: 1, 0 or null).

    purity is the smoothed share of blocked among the template's labelled rows; that of a template without any is its
    host's.
    """
    shapes = rows.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("blocked").alias("known"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("blocked"))
    shapes = materialise(shapes.withColumn("template", F.lit("")), "url-shapes")
    deepest = shapes.agg(F.max(F.size("shape"))).first()[0] or 0
    for i in range(min(deepest, depth + 1)):
        above, shapes = shapes, materialise(_level(shapes, i), f"url-level-{i}")
        discard(above)
    total = shapes.agg(F.sum("blocked"), F.sum("known")).first()
    base = float(((total[0] or 0) + 1) / ((total[1] or 0) + 2))
    hosts = shapes.groupBy("host").agg(((F.sum("blocked") + SMOOTH * base) / (F.sum("known") + SMOOTH)).alias("host_rate"))
    leaves = shapes.groupBy("host", "template").agg(F.sum("blocked").alias("b"), F.sum("known").alias("k")).join(hosts, "host")
    leaves = leaves.select("host", "template", F.round((F.col("b") + SMOOTH * F.col("host_rate")) / (F.col("k") + SMOOTH), 9).alias("purity"))
    return shapes.select("host", "shape", "template").join(leaves, ["host", "template"])


def judge(pages: DataFrame, rules=RULES, limit: float = LIMIT, depth: int | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every row; rows that a rule fits are the labels.

    Columns read: page_id, url; others are ignored. A null or malformed url has empty host and path,
    fits no rule and is judged like any other host. Rows that repeat a page_id are judged one by
    one. With no rule that fits anywhere, all rows are allowed. An empty table gives an empty table.
    Labels depend on no more segments than the deepest rule has, so the tree has as many levels, and DEPTH at least,
    unless depth is given.
    """
    depth = depth or max([DEPTH, *(sum(x != "" for x in rule.split("/")[1:]) for _, rule in rules)])
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("shape", shape(F.col("path"), depth))
    blocked = F.lit(None).cast("long")
    for verdict, rule in rules:
        blocked = F.when(F.col("rule") == rule, F.lit(int(verdict == "block"))).otherwise(blocked)
    rows = rows.withColumn("blocked", blocked.cast("long"))
    found = templates(rows.select("host", "shape", "blocked"), depth)
    verdict = F.when(F.coalesce(F.col("blocked") == 1, F.col("purity") >= limit), "block").otherwise("allow")
    return rows.join(found, ["host", "shape"]).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
