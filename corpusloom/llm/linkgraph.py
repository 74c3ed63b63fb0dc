"""URL filtering: rules first, then trust and distrust that spread over links between hosts.

A page links to the hosts of the addresses in its href and src attributes; a relative address is
a link to its own host. Hosts are nodes without user info and port. Trust is a personalised PageRank that
restarts at hosts with allowed pages; distrust is one over the reversed links that restarts at hosts
with blocked pages, so whoever links to blocked hosts is distrusted. Links are summed by host before
anything is joined; each iteration joins ranks with links and sums by host, until the ranks stay
as they are. Optionally, a host is also tied to its parent domain both ways, as is that to its own,
up to two labels; these ties are no links, so they are off by default.

A url that fits a rule gets its verdict. Of others, a host is blocked if its distrust, relative to
an even share, passes the threshold and exceeds its trust; else it is allowed. A null url or one
without ``://`` has an empty host and path, and is allowed. Repeated pages count each; a null
html has no links.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import stored, table


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
DAMPING = 0.85
#: Iterations end when all ranks together have changed by less than this since they were last stored, in even shares (1 / hosts).
#: What still moves shrinks by DAMPING an iteration, so they do end, after a number that grows with the logarithm of the hosts.
RESIDUAL = 0.01
#: Changes of all ranks together that may be rounding of doubles.
ROUNDING = 1e-13
#: Iterations from one stored table of ranks to the next.
STORED_EVERY = 5
#: Distrust above so many times an even share blocks a host, if its trust is less.
THRESHOLD = 1.0


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after(url: Column) -> Column:
    """What follows the first ://; null without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.lit(2**31 - 1)))


def host_of(url: Column) -> Column:
    return F.coalesce(_ascii_lower(F.regexp_extract(_after(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))


def apply_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(name of the longest rule that fits, its verdict); nulls if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = _fits(r, host, path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def node_of(host: Column) -> Column:
    """The host without user info and port."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")


def links_of(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): links between hosts, and of a host to itself, summed; pages has node and html."""
    value = F.explode(F.regexp_extract_all("html", F.lit(r"""(?i)\b(?:href|src)\s*=\s*["']?\s*([^"'\s<>]+)"""), 1))
    links = pages.where("html IS NOT NULL AND node <> ''").select(F.col("node").alias("src"), value.alias("value"))
    absolute = F.regexp_extract("value", r"(?i)^(?:https?:)?//([^/?#]+)", 1)
    own = ~F.col("value").rlike(r"^(#|//|[A-Za-z][A-Za-z0-9+.-]*:)")
    links = links.select("src", F.when(absolute != "", node_of(_ascii_lower(absolute))).when(own, F.col("src")).alias("dst")).where("dst <> ''")
    return links.groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def domain_ties(hosts: DataFrame) -> DataFrame:
    """(src, dst, weight): hosts and all their ancestor domains, each tied to the next, both ways.

    Ancestors have two labels at least. IPv4 addresses have no parents; what is longer than a domain name
    can be is tied to its parent only.
    """
    labels = hosts.where(~F.col("host").rlike(r"^\d+(\.\d+){3}$")).select("host", F.split("host", r"\.", -1).alias("labels")).where("size(labels) > 2")
    steps = F.when(F.length("host") <= 253, F.size("labels") - 2).otherwise(1)
    tail = lambda k: F.array_join(F.slice("labels", k, F.size("labels") - k + 1), ".")
    chain = labels.select("labels", F.posexplode(F.slice("labels", F.lit(1), steps)).alias("at", "label"))
    parent = chain.select(tail(F.col("at") + 1).alias("host"), tail(F.col("at") + 2).alias("parent")).distinct()
    parent = parent.where(F.col("host").rlike(r"^[^.]+\..+\..+$"))
    return parent.select(F.col("host").alias("src"), F.col("parent").alias("dst"), F.lit(1.0).alias("weight")).union(parent.select("parent", "host", F.lit(1.0)))


def personalised_pagerank(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, residual: float = RESIDUAL, hosts: int = 1) -> DataFrame:
    """(host, rank): edges are src, dst and weight; seeds are host and mass, in any scale. Ranks are as exact as residual / hosts.

    What hosts without links hold goes back to the seeds. That only scales the ranks, so it is
    left out of the iterations, and the ranks are scaled to sum to 1 at the end. Ranks begin as
    the seeds' masses; every fifth iteration is stored, which cuts the lineage, and compared with the one stored before.
    """
    total = seeds.agg(F.sum("mass")).first()[0]
    if not total:
        return seeds.select("host", F.lit(0.0).alias("rank"))
    start = stored(seeds.groupBy("host").agg((F.sum("mass") / total).alias("restart")), "seeds")
    out = edges.groupBy("src").agg(F.sum("weight").alias("out"))
    shares = stored(edges.join(out, "src").select("src", F.col("dst").alias("host"), (damping * F.col("weight") / F.col("out")).alias("share")), "shares")
    again = start.select("host", ((1 - damping) * F.col("restart")).alias("rank"))
    ranks = before = start.select("host", F.col("restart").alias("rank"))
    for k in itertools.count(1):
        moved = ranks.select(F.col("host").alias("src"), "rank").join(shares, "src").select("host", (F.col("rank") * F.col("share")).alias("rank"))
        ranks = moved.union(again).groupBy("host").agg(F.sum("rank").alias("rank"))
        if k % STORED_EVERY == 0:
            ranks = stored(ranks, "ranks")
            change = ranks.union(before.select("host", -F.col("rank"))).groupBy("host").agg(F.sum("rank").alias("change"))
            if change.agg(F.sum(F.abs("change"))).first()[0] < max(residual / max(1, hosts), ROUNDING):
                break
            before = ranks
    whole = ranks.agg(F.sum("rank")).first()[0]
    return ranks.select("host", (F.col("rank") / whole).alias("rank"))


def judge(pages: DataFrame, rules=RULES, url: str = "url", html: str = "html", key: str = "page_id", ties: bool = False) -> DataFrame:
    """key, host, path, rule, verdict, decided_by, and the trust and distrust of the host (1: an even share).

    decided_by is rule; links, where the host has links to or from another (or ties, if asked for); pages, where
    the only evidence is that rules judge other pages of the host; or none.
    """
    host, path = host_of(F.col(f"`{url}`")), path_of(F.col(f"`{url}`"))
    rows = pages.select(F.col(f"`{key}`").alias("key"), host.alias("host"), path.alias("path"), F.col(f"`{html}`").alias("html")).withColumn("node", node_of(F.col("host")))
    name, verdict = apply_rules(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", name).withColumn("ruled", verdict)
    edges = stored(links_of(rows.select("node", "html")), "host-links")
    judged = rows.where("node <> ''").groupBy("node").agg(F.count_if(F.col("ruled") == "allow").cast("double").alias("allow"), F.count_if(F.col("ruled") == "block").cast("double").alias("block"), F.count("*").cast("double").alias("n"))
    seeds = stored(judged.withColumnRenamed("node", "host"), "host-pages")
    hosts = edges.select(F.col("src").alias("host")).union(edges.select("dst")).union(seeds.select("host")).distinct()
    if ties:
        edges = stored(edges.union(domain_ties(hosts)).groupBy("src", "dst").agg(F.sum("weight").alias("weight")), "host-edges")
        hosts = hosts.union(edges.select("src")).distinct()
    n_hosts = hosts.count()
    reversed_ = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    # a host's mass is the share of its pages that the rules judge, so a large host is no larger seed
    trust = personalised_pagerank(edges, seeds.where("allow > 0").select("host", (F.col("allow") / F.col("n")).alias("mass")), hosts=n_hosts)
    distrust = personalised_pagerank(reversed_, seeds.where("block > 0").select("host", (F.col("block") / F.col("n")).alias("mass")), hosts=n_hosts)
    scale = lambda c: (F.coalesce(c, F.lit(0.0)) * n_hosts)
    linked = edges.where("src <> dst").select(F.explode(F.array("src", "dst")).alias("host")).distinct().withColumn("linked", F.lit(True))
    scores = seeds.select("host").join(trust.withColumnRenamed("rank", "t"), "host", "left").join(distrust.withColumnRenamed("rank", "d"), "host", "left").join(linked, "host", "left")
    scores = stored(scores.select(F.col("host").alias("node"), scale(F.col("t")).alias("trust"), scale(F.col("d")).alias("distrust"), F.coalesce("linked", F.lit(False)).alias("linked")), "host-scores")
    method = F.when((F.col("distrust") >= THRESHOLD) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")
    known = (F.col("trust") > 0) | (F.col("distrust") > 0)
    by = F.when(F.col("rule").isNotNull(), "rule").when(known & F.col("linked"), "links").when(known, "pages").otherwise("none")
    out = rows.drop("html").join(scores, "node", "left")
    return out.select(F.col("key").alias(key), "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), by.alias("decided_by"), "trust", "distrust")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "decided_by")
