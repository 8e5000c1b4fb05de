"""URL filters by link-graph propagation (operator 8).

Rules judge the urls that they fit. For all others their host is judged: trust
flows from trusted hosts along host links (personalised PageRank), distrust flows
from blocked hosts against the links (a page that links to blocked hosts is
suspect), and a host is blocked where more distrust than trust reaches it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismcube.llm.common import saved, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Share of a walk that goes on at each step, steps, steps between written states, share of pages that makes a host a seed.
DAMPING, STEPS, WRITTEN, SEED_SHARE = 0.85, 20, 5, 2 / 3


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The contract's rules.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, a question mark, a number sign or the end; empty without it."""
    return F.translate(F.regexp_extract(text_of(url), r"(?s)\A.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(text_of(url), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def fits(rule: Rule) -> Column:
    host = F.col("host")
    return ((host == rule.host) | host.endswith("." + rule.host)) & F.col("path").startswith(rule.path)


def ruled(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, url, host, path, rule (its text) and verdict of the longest rule that fits; both null where none does.

    rules is a parameter of the job, not data: the expression has one branch for each.
    """
    out = pages.select("page_id", F.col("url"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    which = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):  # the longest is tried first
        which = F.when(fits(rule), rule.text).otherwise(which)
        verdict = F.when(fits(rule), rule.verdict).otherwise(verdict)
    return out.withColumns({"rule": which, "verdict": verdict})


def host_links(pages: DataFrame) -> DataFrame:
    """src, dst, n: links between different hosts, from the absolute references in the tags of each page, whatever their attribute
    (href, src, action, data, cite); relative ones stay on the host."""
    found = F.regexp_extract_all(text_of("html"), F.lit(r"""(?i)\s(?:href|src|action|data|cite)\s*=\s*["']?(?:https?:)?(//[^\s"'>]+)"""), F.lit(1))
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.array_distinct(found)).alias("to"))
    links = links.select("src", host_of(F.concat(F.lit("x:"), F.col("to"))).alias("dst")).filter("src <> '' and dst <> '' and src <> dst")
    return links.groupBy("src", "dst").agg(F.count("*").alias("n"))


def spread(edges: DataFrame, seeds: DataFrame, steps: int = STEPS, damping: float = DAMPING) -> DataFrame:
    """kind, host, score: personalised PageRank of each kind over edges (kind, src, dst, share) from seeds (kind, host, start).

    A state of one row for each kind and host that the walk has reached; each step is a join on the source and a sum by
    the target. What reaches a host without links is not handed on. The state is written every few steps.
    """
    edges = saved(edges, "edges")
    seeds = saved(seeds, "seeds")
    base = seeds.select("kind", "host", (F.col("start") * (1 - damping)).alias("score"))
    state = base
    if not edges.head(1):
        return base
    for step in range(1, steps + 1):
        moved = state.join(edges, (state["kind"] == edges["kind"]) & (state["host"] == edges["src"])).select(state["kind"], F.col("dst").alias("host"), (F.col("score") * F.col("share") * damping).alias("score"))
        state = base.unionByName(moved).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if step % WRITTEN == 0:
            state = saved(state, "ranks")
    return state


def judged_hosts(judged: DataFrame, links: DataFrame) -> DataFrame:
    """host, trust, distrust, host_verdict of every host that trust or distrust reaches.

    Seeds: a host of whose rule-judged pages at least two thirds are allowed (trusted) or blocked (blocked); a seed's
    weight is its share of such pages, so that both kinds sum to one.
    """
    n = judged.filter("verdict is not null and host <> ''").groupBy("host").agg(F.count("*").alias("n"), F.count_if(F.col("verdict") == "allow").alias("good"))
    kind = F.when(F.col("good") >= SEED_SHARE * F.col("n"), "trust").when(F.col("n") - F.col("good") >= SEED_SHARE * F.col("n"), "distrust")
    seeds = n.withColumn("kind", kind).filter("kind is not null")
    total = seeds.groupBy("kind").agg(F.sum("n").alias("total"))  # two rows
    seeds = seeds.join(F.broadcast(total), "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("start"))
    out = links.groupBy("src").agg(F.sum("n").alias("all"))
    into = links.groupBy("dst").agg(F.sum("n").alias("all"))
    ahead = links.join(out, "src").select(F.lit("trust").alias("kind"), "src", "dst", (F.col("n") / F.col("all")).alias("share"))
    back = links.join(into, "dst").select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), (F.col("n") / F.col("all")).alias("share"))
    ranks = spread(ahead.unionByName(back), seeds)
    score = lambda k: F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)).alias(k)
    scores = ranks.groupBy("host").agg(score("trust"), score("distrust"))
    return scores.withColumn("host_verdict", F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow"))


def filtered(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every row.

    verdict is the rule's, else the host's; hosts that nothing reaches, and urls without a host, are allowed. A null url
    has an empty host and path. Repeated rows repeat; an empty table gives no rows.
    """
    judged = ruled(pages, rules)
    hosts = judged_hosts(judged, saved(host_links(pages), "links"))
    out = judged.join(hosts, "host", "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", "host_verdict", F.lit("allow")).alias("verdict"), zero("trust"), zero("distrust"))
