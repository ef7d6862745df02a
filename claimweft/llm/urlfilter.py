"""URL verdicts: host and path rules first, else the purity of the path's template.

The template tree of a host is grown level by level over distinct path shapes, not over pages:

* digits become ``#`` and long hexadecimal names ``{hex}``, so numbered pages share a shape;
* a branch stays by itself only if it has ``min_support`` pages and its share of blocked labels
  differs significantly from that of the branches beside it; all others merge into ``*``;
* for verdicts, a branch that isn't shown to be like those beside it doesn't merge with them either:
  one without labels, and, where half of the labels or more are blocked, one whose own labels are
  mostly allowed or, with enough pages, no more often blocked than the prior has it. With enough
  pages it keeps its name, else it goes to ``?``, which has no majority of blocked labels;
* a template's purity is (blocked + m * prior) / (labelled + m), and pages of templates with a
  purity of a half or more are blocked. The prior is low: without labels nothing is blocked.

Labels are the pages that a rule decides. Pages with a null url, or one without ``://``, have an
empty host and path and are allowed. Repeated pages each get a row and count each as a label.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweft.llm.common import stage_table

#: (verdict, host, path prefix)
Rule = tuple[str, str, str]
MIN_SUPPORT = 20
#: Chi-square of one degree of freedom at 1 %.
SIGNIFICANT = 6.635
MERGED, UNLIKE = "*", "?"
PRIOR, PRIOR_WEIGHT, THRESHOLD = 0.1, 10.0, 0.5
#: Segments of a template; what follows is one more, ``**``.
DEPTH = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_name(rule: Rule) -> str:
    return f"{rule[1]}{rule[2]}"


def match_rules(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. Of equally long ones, the first."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(rule_name(r))) if rules else []:
        fits = ((host == r[1]) | F.endswith(host, F.lit(f".{r[1]}"))) & F.startswith(path, F.lit(r[2]))
        rule = F.when(fits, F.lit(rule_name(r))).otherwise(rule)
        verdict = F.when(fits, F.lit(r[0])).otherwise(verdict)
    return rule, verdict


def shape(path: Column) -> Column:
    """Segments of a path with its variable parts generalised, as one text."""
    hexed = F.regexp_replace(path, r"(?<=[/_.-])(?=[0-9a-fA-F-]*[0-9])[0-9a-fA-F][0-9a-fA-F-]{11,}(?=[/_.-]|$)", "{hex}")
    numbered = F.regexp_replace(hexed, r"[0-9]+", "#")
    deep = F.slice(F.split(numbered, "/"), 2, DEPTH)
    return F.concat_ws("/", deep, F.when(F.size(F.split(numbered, "/")) > DEPTH + 1, F.array(F.lit("**"))).otherwise(F.array()))


def _differs(n: str, bad: str, all_n: str, all_bad: str) -> Column:
    """Whether a branch's share of blocked labels differs from that of the rest of its node."""
    a, b = F.col(bad), F.col(n) - F.col(bad)
    c = F.col(all_bad) - F.col(bad)
    d = F.col(all_n) - F.col(n) - c
    total = F.col(all_n).cast("double")
    product = (a + b).cast("double") * (c + d) * (a + c) * (b + d)
    chi = F.when(product > 0, total * (a * d - b * c).cast("double") ** 2 / product).otherwise(F.lit(0.0))
    return chi > SIGNIFICANT


def _unlike(min_support: int) -> Column:
    """Whether nothing shows that a branch is like the others of its node, which have labels."""
    n, labelled, bad = F.col("n"), F.col("labelled"), F.col("bad")
    blocked = F.col("all_bad") * 2 >= F.col("all_labelled")
    over = bad - labelled * PRIOR - 0.5  # chi-square against the prior, with Yates's correction
    above_prior = (over > 0) & (over * over > labelled * (SIGNIFICANT * PRIOR * (1 - PRIOR)))
    doubtful = (bad * 2 < labelled) | ((n >= min_support) & ~above_prior)
    return (F.col("all_labelled") > 0) & ((labelled == 0) | (blocked & doubtful))


def template_tree(shapes: DataFrame, min_support: int = MIN_SUPPORT, unlike_apart: bool = False) -> DataFrame:
    """(host, shape, template) from (host, shape, n, labelled, bad), one row per distinct shape.

    One level at a time: branch counts, node counts, the branches that stay, the longer template.
    ``unlike_apart``, which verdicts need, keeps branches not shown to be alike out of ``*``.
    """
    tree = shapes.withColumns({"segments": F.split("shape", "/"), "template": F.lit("")})
    depth = shapes.agg(F.max(F.size(F.split("shape", "/")))).first()[0] or 0
    for level in range(depth):
        tree = tree.withColumn("branch", F.get("segments", F.lit(level)))
        node = ["host", "template"]
        sums = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
        branches = tree.filter("branch is not null").groupBy(*node, "branch").agg(*sums)
        nodes = branches.groupBy(*node).agg(F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad"))
        stays = _differs("labelled", "bad", "all_labelled", "all_bad")
        unlike = _unlike(min_support) if unlike_apart else F.lit(False)
        name = F.when((F.col("n") >= min_support) & (stays | unlike), F.col("branch")).when(unlike, F.lit(UNLIKE))
        apart = branches.join(nodes, node).select(*node, "branch", name.alias("name")).filter("name is not null")
        longer = F.concat("template", F.lit("/"), F.coalesce("name", F.lit(MERGED)))
        tree = stage_table(
            tree.join(apart, [*node, "branch"], "left")
            .withColumn("template", F.when(F.col("branch").isNull(), F.col("template")).otherwise(longer))
            .drop("branch", "name"),
            "url-tree",
        )
    return tree.drop("segments")


def template_purity(tree: DataFrame) -> DataFrame:
    """(host, template, purity) of every template."""
    sums = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    purity = (F.col("bad") + F.lit(PRIOR * PRIOR_WEIGHT)) / (F.col("labelled") + F.lit(PRIOR_WEIGHT))
    return sums.select("host", "template", purity.alias("purity"))


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every page."""
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, ruled = match_rules(F.col("host"), F.col("path"), rules)
    known = split.select("page_id", "host", "path", rule.alias("rule"), ruled.alias("ruled"), shape(F.col("path")).alias("shape"))
    shapes = stage_table(
        known.groupBy("host", "shape").agg(
            F.count("*").alias("n"), F.count("ruled").alias("labelled"), F.count_if(F.col("ruled") == "block").alias("bad")
        ),
        "url-shapes",
    )
    tree = template_tree(shapes, unlike_apart=True)
    verdicts = stage_table(
        tree.select("host", "shape", "template").join(template_purity(tree), ["host", "template"]), "url-verdicts"
    )
    verdict = F.coalesce("ruled", F.when(F.col("purity") >= THRESHOLD, F.lit("block")).otherwise(F.lit("allow")))
    return known.join(verdicts, ["host", "shape"], "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity"
    )
