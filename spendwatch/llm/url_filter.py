"""URL filter by a path-template tree, in DataFrame functions only.

Rules decide first (the longest that fits), and the urls that a rule judges are the
labelled examples for the others.  Each host's paths form a tree of segments:

1. A segment that is variable by its form (digits, hex ids, very long words) is a
   wildcard, and so are the children of a node where more than ``MANY`` different
   ones occur with fewer than ``REPEATS`` urls each on average.
2. Siblings are merged when the templates below them are distributed alike: a
   sibling whose counts do not differ from those of all siblings together, by a
   chi-squared test at ``SIMILAR_Z``, joins one branch named after its least member.
3. A node's purity is its smoothed share of blocked examples.  A url takes the
   purity of the deepest node on its way that has an example, below the host itself;
   it is blocked from ``PURITY`` on, and allowed otherwise or without examples.

Rows are aggregated to (host, template) before anything is joined; the counts of a
node are grouped sums, and the small tables that go back to the templates are
salted, so a host with many templates is no hot key.

Defined cases: a null url, or one without ``://``, has an empty host and path
and is allowed; repeated rows are judged alike; nodes end at ``DEPTH`` segments (what
lies deeper shares their purity; the given tables have two); other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.common import stage, trimmed

# (verdict, host, path)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
DEPTH, MANY, REPEATS = 8, 16, 4
WILD = "*"
PURITY, SMOOTHING = 0.8, 1.0
SIMILAR_Z = 2.326
SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules) -> Column:
    """Name and verdict of the longest rule that fits, or null."""
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
                   F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in ranked]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def template(path: Column) -> Column:
    """The path's segments, with those that are variable by their form as wildcards."""
    stem = F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), lambda s: F.regexp_replace(s, r"\.[A-Za-z]{2,5}$", ""))
    parts = F.transform(stem, lambda s: F.when(
        F.regexp_like(s, F.lit("[0-9]|^[0-9a-fA-F-]{16,}$|^.{40,}$")), F.lit(WILD)).otherwise(s))
    return F.slice(parts, 1, DEPTH)


def _with_node(shapes: DataFrame, node: DataFrame, keys: list[str]) -> DataFrame:
    """``shapes`` left joined with at most one row per key, salted by template."""
    spread = node.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return shapes.withColumn("salt", F.pmod(F.xxhash64("form"), F.lit(SALTS)).cast("int")).join(spread, [*keys, "salt"], "left").drop("salt")


def _placed(shapes: DataFrame, depth: int) -> DataFrame:
    parent = F.slice("shape", 1, depth) if depth else F.array().cast("array<string>")
    return shapes.withColumn("parent", parent).withColumn("child", F.get("shape", F.lit(depth)))


def _replaced(depth: int, value: Column) -> Column:
    return F.transform("shape", lambda s, i: F.when(i == depth, value).otherwise(s))


def _generalised(shapes: DataFrame, depth: int) -> DataFrame:
    """Children that are many and seldom repeated become one wildcard."""
    placed = _placed(shapes, depth)
    children = placed.where("child is not null").groupBy("host", "parent", "child").agg(F.sum("n").alias("n"))
    wide = children.groupBy("host", "parent").agg(F.count("*").alias("kinds"), F.sum("n").alias("urls")).where(
        f"kinds > {MANY} and kinds * {REPEATS} > urls").select("host", "parent", F.lit(True).alias("wide"))
    out = _with_node(placed, wide, ["host", "parent"])
    return out.withColumn("shape", F.when(F.col("wide"), _replaced(depth, F.lit(WILD))).otherwise(F.col("shape"))).drop("wide", "parent", "child")


def critical(df: Column, z: float = SIMILAR_Z) -> Column:
    """The chi-squared value exceeded with the probability of ``z`` (Wilson and Hilferty)."""
    return F.when(df > 0, df * F.pow(1 - 2 / (9 * df) + z * F.sqrt(2 / (9 * df)), F.lit(3))).otherwise(F.lit(0.0))


def _merged(shapes: DataFrame, depth: int) -> DataFrame:
    """Siblings whose subtrees look alike become one branch."""
    placed = _placed(shapes, depth)
    tail = F.array_join(F.slice("shape", depth + 2, DEPTH), "/")
    cells = placed.where(F.col("child").isNotNull() & (F.col("child") != WILD)).groupBy("host", "parent", "child", tail.alias("tail")).agg(
        F.sum("n").alias("n"))
    pool = cells.groupBy("host", "parent", "tail").agg(F.sum("n").alias("pool"))
    whole = pool.groupBy("host", "parent").agg(F.sum("pool").alias("total"), (F.count("*") - 1).alias("df"))
    own = cells.groupBy("host", "parent", "child").agg(F.sum("n").alias("own"))
    # sum (o - e)^2 / e over all tails is sum o^2 / e over the observed ones, less the count.
    terms = cells.join(pool, ["host", "parent", "tail"]).groupBy("host", "parent", "child").agg(
        F.sum(F.col("n").cast("double") * F.col("n") / F.col("pool")).alias("terms"))
    tested = terms.join(own, ["host", "parent", "child"]).join(whole, ["host", "parent"])
    chi = F.col("terms") * F.col("total") / F.col("own") - F.col("own")
    alike = tested.where(chi <= critical(F.col("df")) + 1e-6).select("host", "parent", "child")
    branch = alike.groupBy("host", "parent").agg(F.min("child").alias("least"), F.count("*").alias("members")).where("members > 1")
    branch = alike.join(branch, ["host", "parent"]).select("host", "parent", "child", F.concat("least", F.lit("+")).alias("branch"))
    out = _with_node(placed, branch, ["host", "parent", "child"])
    return out.withColumn("shape", F.when(F.col("branch").isNotNull(), _replaced(depth, F.col("branch"))).otherwise(F.col("shape"))).drop(
        "branch", "parent", "child")


def templates(shapes: DataFrame) -> DataFrame:
    """``shapes`` (host, form, n, blocked, allowed) with the generalised and merged form as ``shape``."""
    shapes = shapes.withColumn("shape", F.col("form"))
    deepest = min(DEPTH, shapes.agg(F.max(F.size("form"))).first()[0] or 0)
    for depth in range(deepest):
        shapes = stage(_generalised(shapes, depth), "url-generalised")
    for depth in range(deepest):
        shapes = stage(_merged(shapes, depth), "url-merged")
    return shapes


def judge_nodes(shapes: DataFrame) -> DataFrame:
    """host, shape, purity of the deepest node with examples on the way to each template that has one."""
    whole = shapes.groupBy("host", "shape").agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a"))
    prefixes = F.transform(F.sequence(F.lit(1), F.size("shape")), lambda i: F.slice("shape", F.lit(1), i))
    ways = whole.where("size(shape) > 0").select("host", "shape", "b", "a", F.explode(prefixes).alias("node"))
    nodes = ways.groupBy("host", "node").agg(F.sum("b").alias("b"), F.sum("a").alias("a")).where("a + b > 0").select(
        "host", "node", ((F.col("b") + SMOOTHING) / (F.col("a") + F.col("b") + 2 * SMOOTHING)).alias("purity"))
    return ways.select("host", "shape", "node").join(nodes, ["host", "node"]).groupBy("host", "shape").agg(
        F.max_by("purity", F.size("node")).alias("purity"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and the template and its purity."""
    host, path = split_url(F.col("url"))
    rows = trimmed(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", "r.rule", F.col("r.verdict").alias("ruled"), template(F.col("path")).alias("form"))
    marked = lambda v: F.count(F.when(F.col("ruled") == v, 1))
    shapes = stage(rows.groupBy("host", "form").agg(F.count("*").alias("n"), marked("block").alias("blocked"),
                                                    marked("allow").alias("allowed")), "url-shapes")
    shapes = templates(shapes)
    verdicts = _with_node(shapes, judge_nodes(shapes), ["host", "shape"]).select(
        "host", "form", F.concat(F.lit("/"), F.array_join("shape", "/")).alias("template"), "purity")
    out = rows.join(verdicts, ["host", "form"], "left")
    verdict = F.coalesce(F.col("ruled"), F.when(F.col("purity") >= PURITY, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
