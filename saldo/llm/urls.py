"""URL filter: explicit rules first, then path templates judged by what the rules say of them.

Paths of a host form a tree of templates. Segments that vary (numbers, hashes, and any
rare values of a position with many) become wildcards. What rules or labels say of some pages
is counted for their template and all nodes above it; branches of a node that do not differ
significantly are merged with all that lies below them, and a template is rejected if its
smoothed share of allowed pages is below one half.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import ascii_lower, bounded
from saldo.sources.scratch import settle


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Of a position with at least this many values, those with less than their even share of 1 / MANY_VALUES vary.
MANY_VALUES = 20
#: Strength of the prior, in pages, and the z below which two branches count as alike.
PRIOR, ALIKE = 4.0, 1.96


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, _URL, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _fits(rule: UrlRule) -> Column:
    host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
    return host & F.col("path").startswith(rule.path)


def _longest(rules: Sequence[UrlRule]) -> list[UrlRule]:
    return sorted(rules, key=lambda r: (-len(r.name), r.name))


def by_rules(pages: DataFrame, rules: Sequence[UrlRule], id_col: str, url_col: str) -> DataFrame:
    """(page_id, host, path, url_hash, rule, ruled): the longest rule that fits, and its verdict."""
    url = F.col(f"`{url_col}`").cast("string")
    read = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("page_id"),
                        host_of(url).alias("host"), path_of(url).alias("path"),
                        F.xxhash64(F.coalesce(url, F.lit(""))).alias("url_hash"))
    none = F.lit(None).cast("string")
    ordered = _longest(rules)
    name = F.coalesce(*[F.when(_fits(r), F.lit(r.name)) for r in ordered], none)
    verdict = F.coalesce(*[F.when(_fits(r), F.lit(r.verdict)) for r in ordered], none)
    return read.withColumns({"rule": name, "ruled": verdict})


def typed_segments(path: Column) -> Column:
    """Segments of a path by kind: numbers, hashes, other values with digits, or as they are."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: (
        F.when(s.rlike(r"^[0-9]+$"), "{n}")
        .when(s.rlike(r"^[0-9]+\.[a-z]+$"), F.concat(F.lit("{n}"), F.regexp_extract(s, r"(\.[a-z]+)$", 1)))
        .when(s.rlike(r"^[0-9a-fA-F-]{8,}$"), "{h}")
        .when(s.rlike(r"[0-9]"), "{v}").otherwise(s)))


def path_counts(ruled: DataFrame) -> DataFrame:
    """(host, typed, n, labelled, allowed) for each typed path of a host, settled.

    A url that is listed again counts once, so repeated rows change no verdict.
    """
    typed = ruled.select("host", typed_segments(F.col("path")).alias("typed"), "url_hash", "ruled").distinct()
    return settle(typed.groupBy("host", "typed").agg(
        F.count("*").alias("n"), F.count("ruled").alias("labelled"),
        F.count_if(F.col("ruled") == "allow").alias("allowed")), "typed-paths")


def generalised(paths: DataFrame) -> DataFrame:
    """Adds `template`: position by position, the rare ones of many values become `*`.

    A position is that of all paths of the host with the same template before it. It keeps
    at most MANY_VALUES values besides `*`, however many pages each value has. Level by level,
    without a fixed depth: paths leave when they have ended, or when so few share their template
    that no position after it can have many values; the rest of their segments stays.
    """
    current = paths.withColumn("template", F.array().cast("array<string>"))
    ended = []
    place = 0
    while True:
        here = current.withColumn("segment", F.get("typed", F.lit(place)))
        values = settle(here.filter("segment is not null").groupBy("host", "template", "segment").agg(
            F.sum("n").alias("n"), F.count("*").alias("paths")), "path-values")
        shared = settle(values.groupBy("host", "template").agg(
            F.count("*").alias("values"), F.sum("n").alias("total"), F.sum("paths").alias("paths")).filter(
            F.col("paths") >= MANY_VALUES), "shared-positions")
        rest = F.concat("template", F.slice("typed", place + 1, F.greatest(F.size("typed") - place, F.lit(0))))
        if shared.isEmpty():
            ended.append(current.withColumn("template", rest))
            break
        rare = settle(values.join(bounded(shared.filter(F.col("values") >= MANY_VALUES)), ["host", "template"]).filter(
            F.col("n") * MANY_VALUES < F.col("total")).select("host", "template", "segment", F.lit(True).alias("rare")), "rare-values")
        open_at = bounded(shared.select("host", "template", F.lit(True).alias("open")))
        joined = here.join(open_at, ["host", "template"], "left").join(
            bounded(rare), ["host", "template", "segment"], "left").withColumn(
            "open", F.col("open").isNotNull() & F.col("segment").isNotNull())
        step = F.when(~F.col("open"), rest).when(
            F.col("rare"), F.concat("template", F.array(F.lit("*")))
        ).otherwise(F.concat("template", F.array("segment")))
        level = settle(joined.withColumn("template", step).drop("segment", "rare"), "path-level")
        ended.append(level.filter(~F.col("open")).drop("open").select(*paths.columns, "template"))
        current = level.filter("open").drop("open").select(*paths.columns, "template")
        place += 1
    every = ended[0].select(*paths.columns, "template")
    for one in ended[1:]:
        every = every.unionByName(one)
    return every


def _chain(host: Column, template: Column) -> Column:
    """Nodes of the tree from the host down to the end of the template: (depth, node, parent).

    A node is named by a digest of its host and segments. Templates that end at a node have
    a node below it, beside its branches.
    """
    size = F.size(template)

    def name(depth: Column) -> Column:
        inner = F.concat_ws("/", F.array(host), F.slice(template, 1, F.least(depth, size)))
        return F.md5(F.when(depth > size, F.concat(inner, F.lit("//"))).otherwise(inner))

    names = F.transform(F.sequence(F.lit(0), size + 1), name)
    return F.transform(names, lambda node, depth: F.struct(
        depth.alias("depth"), node.alias("node"), F.get(names, depth - 1).alias("parent")))


_GROUPS = "array<struct<n:double,k:double,nodes:array<string>>>"


def _merged(branches: Column) -> Column:
    """Groups of alike branches, from (share, node, n, k) in ascending order of share.

    A branch joins the group before it unless their shares differ significantly.
    """

    def step(groups: Column, one: Column) -> Column:
        last = F.get(groups, F.size(groups) - 1)
        n, k = last["n"] + one["n"], last["k"] + one["k"]
        error = F.sqrt(k / n * (1 - k / n) * (1 / last["n"] + 1 / one["n"]))
        alike = F.coalesce(F.abs(last["k"] / last["n"] - one["share"]) <= ALIKE * error, F.lit(False))
        group = lambda n, k, nodes: F.array(F.struct(n.alias("n"), k.alias("k"), nodes.alias("nodes")))
        own = F.array(one["node"])
        before = F.slice(groups, 1, F.greatest(F.size(groups) - 1, F.lit(0)))
        return F.when(alike, F.concat(before, group(n, k, F.concat(last["nodes"], own)))).otherwise(
            F.concat(groups, group(one["n"], one["k"], own)))

    return F.aggregate(branches, F.array().cast(_GROUPS), step)


def merged_branches(known: DataFrame) -> DataFrame:
    """(node, use_n, use_k): labelled and allowed pages below each node and the siblings it merges with.

    `known` has host, template, labelled, allowed, with labelled above 0. A position keeps fewer than
    2 * MANY_VALUES values (`generalised`), so a node has few branches, each counted with all
    that lies below it.
    """
    nodes = known.select(F.explode(_chain(F.col("host"), F.col("template"))).alias("at"), "labelled", "allowed").groupBy(
        "at.node", "at.parent").agg(F.sum("labelled").cast("double").alias("n"), F.sum("allowed").cast("double").alias("k"))
    # A host has no siblings; its node alone stands for its parent.
    branches = nodes.groupBy(F.coalesce("parent", "node").alias("parent"), F.isnull("parent").alias("top")).agg(
        F.array_sort(F.collect_list(F.struct((F.col("k") / F.col("n")).alias("share"), "node", "n", "k"))).alias("branches"))
    groups = branches.select(F.explode(_merged(F.col("branches"))).alias("g"))
    return groups.select(F.explode("g.nodes").alias("node"), F.col("g.n").alias("use_n"), F.col("g.k").alias("use_k"))


def judged_templates(paths: DataFrame) -> DataFrame:
    """(host, template, purity): smoothed share of allowed pages of each template.

    Branches of a node, each with its whole subtree, are merged where their shares do not differ
    significantly. From the host down, the share of a node's merged group is smoothed by
    the purity of its parent; a branch without labels has that of its parent. The prior of a host
    is the same template's share over all hosts, itself smoothed by the share over all pages, or
    1 without labels.
    """
    grouped = settle(paths.groupBy("host", "template").agg(
        F.sum("labelled").alias("labelled"), F.sum("allowed").alias("allowed")), "templates-of-hosts")
    # One row for each template of a host: far fewer than pages.
    known = grouped.filter("labelled > 0")
    overall = known.agg(((F.sum("allowed") + 1) / (F.sum("labelled") + 1)).alias("share")).first().share
    everywhere = known.groupBy("template").agg(F.sum("labelled").alias("all_n"), F.sum("allowed").alias("all_k"))
    root = F.lit(1.0 if overall is None else overall)
    prior = (F.coalesce("all_k", F.lit(0)) + PRIOR * root) / (F.coalesce("all_n", F.lit(0)) + PRIOR)
    nodes = grouped.select("host", "template", F.explode(_chain(F.col("host"), F.col("template"))).alias("at"))
    steps = nodes.select("host", "template", "at.depth", "at.node").join(merged_branches(known), "node").groupBy(
        "host", "template").agg(F.array_sort(F.collect_list(F.struct("depth", "use_n", "use_k"))).alias("steps"))
    every = grouped.join(steps, ["host", "template"], "left").join(everywhere, "template", "left")
    none = F.array().cast("array<struct<depth:int,use_n:double,use_k:double>>")
    purity = F.aggregate(F.coalesce("steps", none), prior.cast("double"), lambda above, at: (
        (at["use_k"] + PRIOR * above) / (at["use_n"] + PRIOR)))
    return every.select("host", "template", purity.alias("purity"))


def judge(pages: DataFrame, rules: Sequence[UrlRule] = RULES, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity), one row for each row of `pages`.

    Null urls and urls without `://` have an empty host and path and are judged like others;
    repeated rows are judged each, but a url counts once. Without any label everything is allowed. No rows give no rows; other
    columns are not read. Only paths of a kind, not pages, enter the tree.
    """
    ruled = by_rules(pages, rules, id_col, url_col)
    paths = settle(generalised(path_counts(ruled)), "templates")
    purity = settle(judged_templates(paths), "purity")
    per_path = settle(paths.join(purity, ["host", "template"]).select("host", "typed", "template", "purity"),
                      "judged-paths")
    typed = ruled.withColumn("typed", typed_segments(F.col("path")))
    own = F.when(F.col("purity") < 0.5, "block").otherwise("allow")
    return typed.join(per_path, ["host", "typed"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "purity")
