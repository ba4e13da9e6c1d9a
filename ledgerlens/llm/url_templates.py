"""URL filters: a few given rules first, then a tree of path templates for each host.

All segments of a path count; a segment with a digit is a variable and becomes ``*``. The tree of a host is walked from
the root: below a node, a child is merged into ``*`` if its labelled share of bad pages does not differ from that of its
siblings (two-proportion test), however many there are. A path that has ended has the child ``''``. After the third
level only nodes with good and bad pages go on, as long as a labelled path of theirs goes deeper: in others no child can
differ. Each template that is left has a smoothed share of bad pages, which leans on the share of all labelled pages,
and is blocked above a limit. All of it is joins and grouped sums over template counts, a written table a level; the
rows of a hot host are summed in the map tasks before anything is shuffled.

A template has three segments at least; after those, ``*`` at its end are left out.

Defined results: a null URL or one without ``://`` has an empty host and path, and is judged like any other template;
repeated rows get a row each; pages without label only add to a template's size; with no labelled page at all nothing
but a rule blocks; an empty table gives an empty table; other columns of the pages are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import ascii_lower
from ledgerlens.operators.small import one_row, settled

MAX_CHILDREN = 32  # only the SQL of op9 still has this limit
Z_SQUARED = 3.84
PRIOR_WEIGHT = 10.0
BLOCK_SHARE = 0.5
LEAST_LEVELS = 3


def url_parts(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    text = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.locate("://", text) > 0, F.substr(text, F.locate("://", text) + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return ascii_lower(host), path


def rule_for(host: str, path: str, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct (length, rule, verdict), or null. A rule is a host and a path prefix."""
    fitting = []
    for rule, verdict in rules:
        domain, _, prefix = rule.partition("/")
        inside = (F.col(host) == domain) | F.col(host).endswith(f".{domain}")
        found = F.struct(F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        fitting.append(F.when(inside & F.col(path).startswith(f"/{prefix}"), found))
    if not fitting:
        return F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    return F.array_max(F.array(*fitting))


def segments(path: str) -> Column:
    """All segments of a path, without empty ones at its end; those with a digit are ``*``."""
    parts = F.split(F.regexp_replace(F.col(path), "/+$", ""), "/", -1)
    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda s: F.when(s.rlike("[0-9]"), "*").otherwise(s))


def _named(tree: DataFrame, level: int, z_squared: float) -> DataFrame:
    """Lengthen ``node``, the name so far, by the child at one level."""
    placed = tree.withColumn("child", F.coalesce(F.get("segments", F.lit(level)), F.lit("")))
    children = placed.groupBy("host", "node", "child").agg(F.sum("labelled").alias("nc"), F.sum("bad").alias("bc"))
    whole = children.groupBy("host", "node").agg(F.sum("nc").alias("np"), F.sum("bc").alias("bp"))
    nc, bc, np_, bp = (F.col(c).cast("double") for c in ("nc", "bc", "np", "bp"))
    gap = bc * (np_ - nc) - (bp - bc) * nc
    differs = gap * gap * np_ > F.lit(z_squared) * nc * (np_ - nc) * bp * (np_ - bp)
    own = children.join(whole, ["host", "node"]).where(differs).select("host", "node", "child", F.lit(True).alias("own"))
    name = F.concat("node", F.lit("/"), F.when(F.col("own"), F.col("child")).otherwise("*"))
    return placed.join(own, ["host", "node", "child"], "left").select(
        "host", "segments", "labelled", "bad", name.alias("node")
    )


def template_tree(pages: DataFrame, z_squared: float = Z_SQUARED, prior_weight: float = PRIOR_WEIGHT) -> DataFrame:
    """host, segments (as in the URLs), their template, and its smoothed bad share ``purity``.

    ``pages`` has host, segments and ``bad`` (0, 1 or null for pages without label).
    """
    counts = [F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")]
    tree = settled(pages.groupBy("host", "segments").agg(*counts))
    total = one_row(tree.agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b")))
    tree = tree.withColumn("node", F.lit(""))
    depth = F.max(F.when(F.col("labelled") > 0, F.size("segments")))
    deepest = tree.agg(depth).first()[0] or 0
    parts, level = [], 0
    while True:
        tree = settled(_named(tree, level, z_squared))
        level += 1
        if level >= max(LEAST_LEVELS, deepest):
            break
        if level < LEAST_LEVELS:
            continue
        nodes = tree.groupBy("host", "node").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"), depth.alias("depth"))
        live = settled(nodes.where((F.col("b") > 0) & (F.col("b") < F.col("n")) & (F.col("depth") > level)))
        deepest = live.agg(F.max("depth")).first()[0] or 0
        if not deepest:
            break
        parts.append(tree.join(live, ["host", "node"], "left_anti"))
        tree = tree.join(live, ["host", "node"], "left_semi")
    for part in parts:
        tree = tree.unionByName(part)
    template = F.regexp_replace("node", rf"^((?:/[^/]*){{{LEAST_LEVELS}}}.*?)(?:/\*)*$", "$1")
    judged = settled(tree.withColumn("template", template)) if parts else tree.withColumn("template", template)
    shares = judged.groupBy("host", "template").agg(F.sum("labelled").alias("tn"), F.sum("bad").alias("tb"))
    prior = F.coalesce(total["b"] / F.when(total["n"] > 0, total["n"]), F.lit(0.0))
    purity = (F.col("tb") + F.lit(prior_weight) * prior) / (F.col("tn") + F.lit(prior_weight))
    return judged.join(shares, ["host", "template"]).select("host", "segments", "template", purity.alias("purity"))


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[tuple[str, str]],
    block_share: float = BLOCK_SHARE,
    **options,
) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity for each page.

    ``labels`` has page_id and ``bad``; a page with several labels is bad if one of them is.
    """
    host, path = url_parts()
    known = labels.groupBy("page_id").agg(F.max("bad").alias("bad"))
    split = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("segments", segments("path"))
    tree = settled(template_tree(split.join(known, "page_id", "left").select("host", "segments", "bad"), **options))
    rule = rule_for("host", "path", rules)
    by_template = F.when(F.col("purity") > block_share, "block").otherwise("allow")
    return split.join(tree, ["host", "segments"]).select(
        "page_id",
        "host",
        "path",
        rule["rule"].alias("rule"),
        F.coalesce(rule["verdict"], by_template).alias("verdict"),
        "template",
        F.round("purity", 9).alias("purity"),
    )
