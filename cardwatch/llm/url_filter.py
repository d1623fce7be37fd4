"""Allow and block rules over URLs; hosts without a rule are judged by their place in the graph of links.

Trust starts at hosts whose pages are mostly allowed and flows along links; distrust starts at hosts whose pages are mostly blocked
and flows against them, since a host that links to bad hosts is suspect. Both are personalised PageRank. A host on which more
distrust than trust settles is blocked.

All values are whole numbers of a fixed unit, so that sums do not depend on their order and a run can be repeated exactly.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.shared import LOWER, UPPER, copied, dealt, hot_keys, join_by_key, write_once


class Rule(NamedTuple):
    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)

#: All trust there is, and all distrust.
UNIT = 10**15
#: Per cent of a host's value that its links pass on.
PASSED_ON = 85
ROUNDS = 12
#: The lineage is cut after so many rounds.
_WRITE_EVERY = 4


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """(rule, action) of the longest rule that fits a host or a domain above it and begins the path; null if none does."""
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"))).otherwise(found)
    return found


def links(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(source, target, n): links from one host to another. Relative ones stay on their host and are not listed."""
    hrefs = F.regexp_extract_all(
        F.coalesce(html_col, F.lit("")), F.lit(r"""(?i)<a\b[^>]*?\shref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""), 1
    )
    # A link without a scheme takes the page's.
    target = host_of(F.regexp_replace("href", "^//", "http://"))
    found = pages.select(host_of(F.col(url_col)).alias("source"), F.explode(hrefs).alias("href")).select("source", target.alias("target"))
    return found.filter("source <> target AND source <> '' AND target <> ''").groupBy("source", "target").agg(F.count("*").alias("n"))


def _arcs(edges: DataFrame) -> DataFrame:
    """(at, to, n, trust_links, distrust_links): what moves, and among how many links the value at a host is divided."""
    along = edges.join(edges.groupBy("source").agg(F.sum("n").alias("out")), "source")
    against = edges.join(edges.groupBy("target").agg(F.sum("n").alias("into")), "target")
    none = F.lit(None).cast("long")
    forth = along.select(F.col("source").alias("at"), F.col("target").alias("to"), "n", F.col("out").alias("trust_links"), none.alias("distrust_links"))
    back = against.select(F.col("target").alias("at"), F.col("source").alias("to"), "n", none.alias("trust_links"), F.col("into").alias("distrust_links"))
    return forth.unionAll(back)


def propagate(hosts: DataFrame, edges: DataFrame, *, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) after ``rounds`` rounds.

    ``hosts`` (host, trusted, blocked) names every host with two flags; ``edges`` (source, target, n) may name more. Each seed
    starts with an equal part of the unit, of which it is given again in every round what is not passed on. What a host without
    links would pass on is lost. A hub's arcs are dealt over several tasks.
    """
    kinds = {"trust": "trusted", "distrust": "blocked"}
    seeds = hosts.agg(*[F.count_if(flag).alias(flag) for flag in kinds.values()]).first()
    part = {k: F.when(F.col(flag), UNIT // max(seeds[flag], 1)).otherwise(0).cast("long") for k, flag in kinds.items()}
    seeded = write_once(hosts.select("host", *[part[k].alias(k) for k in kinds]), "seeds")
    arcs = write_once(_arcs(edges), "arcs")
    hot = write_once(hot_keys(arcs.groupBy("at").agg(F.count("*").alias("n")), "at"), "hubs")
    arcs = write_once(dealt(arcs, hot, "at", "to"), "dealt-arcs")
    share = {k: F.coalesce(F.expr(f"{k} * {PASSED_ON} div (100 * {k}_links) * n"), F.lit(0).cast("long")).alias(k) for k in kinds}
    given = [F.expr(f"{k} * {100 - PASSED_ON} div 100").alias(k) for k in kinds]

    held = seeded
    for done in range(1, rounds + 1):
        values = copied(held.filter("trust > 0 OR distrust > 0").withColumnRenamed("host", "at"), hot, "at")
        passed = arcs.join(values, ["at", "__slice"]).select(F.col("to").alias("host"), *share.values())
        held = passed.unionAll(seeded.select("host", *given)).groupBy("host").agg(*[F.sum(k).alias(k) for k in kinds])
        if done % _WRITE_EVERY == 0:
            held = write_once(held, "propagated")
    return held


def judge_urls(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    rules: tuple[Rule, ...] = RULES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Every page with its host, path, the rule that decides it, and a verdict.

    Returns one row per input row: page_id, host, path, rule (null: none fits), trust, distrust (of the host), verdict (``allow``
    or ``block``). A page without a rule is blocked if its host has more distrust than trust. A host is a seed of trust if more
    than half of its pages are allowed by rules, of distrust if more than half are blocked by rules.

    A null url, or one without ``://``, has an empty host and path; it fits no rule, is in no link, and is allowed. A null html has
    no links. Repeated rows are judged alike, and each counts as a page of its host. Other columns are ignored, whatever their
    names; an empty table gives an empty result.
    """
    split = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    ruled = split.withColumn("fit", fit).select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.action").alias("action"))
    by_host = write_once(
        ruled.groupBy("host").agg(
            F.count("*").alias("n"), *[F.count_if(F.col("action") == a).alias(a) for a in ("allow", "block")]
        ),
        "hosts",
    )
    hosts = by_host.select("host", (2 * F.col("allow") > F.col("n")).alias("trusted"), (2 * F.col("block") > F.col("n")).alias("blocked"))
    standing = propagate(hosts.filter("host <> ''"), links(pages, url_col, html_col), rounds=rounds)
    met = join_by_key(ruled, standing, "host", by_host.select("host", "n"), spread_by="page_id", how="left")
    zero = F.lit(0).cast("long")
    known = met.withColumns({k: F.coalesce(k, zero) for k in ("trust", "distrust")})
    by_graph = F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow")
    return known.select("page_id", "host", "path", "rule", "trust", "distrust", F.coalesce("action", by_graph).alias("verdict"))
