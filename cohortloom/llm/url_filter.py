"""URL filter: rules first, then trust and distrust propagated over the host graph.

The page links of each host give weighted host edges. Trust is a personalised PageRank from
hosts with allowed pages along the edges; distrust is one from hosts with blocked pages
against them, since a host is answerable for what it links to. Seeds weigh as much as the
share of a host's pages that rules decide.

Rank is mass that all linking hosts share, so it isn't compared with the threshold itself. A
host's blame is the larger of its own share of blocked less allowed pages and the damped mean
blame of the hosts that its links lead to, times distrust / (trust + distrust); neither falls
with the number of hosts or of links to a target. A host whose blame reaches the threshold is
blocked.

Everything runs on DataFrame functions. Per round only a few numbers reach the driver.

Defined results: a null url, or one without ``://``, has empty host and path, no rule and is
allowed; of rules that fit and are of equal length the first by name holds; hosts without links and rules have neither trust nor distrust and are allowed; links
of a host to itself and relative links carry nothing; repeated pages count as often as they
occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import settled

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.85
#: Rounds end once the ranks move by less than this share of the seeds in sum; a round moves them
#: by at most ``DAMPING`` times what the one before did, so this takes 72 rounds at most.
TOLERANCE = 1e-5
#: Blame moves by less than this per host in the last round.
BLAME_TOLERANCE = 1e-3
#: Blame at which a host is blocked; 1 is a host whose every page is blocked.
THRESHOLD = 0.5
#: Absolute and protocol-relative link targets.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def host_of(url: str) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(rules: list[Rule], host: str = "host", path: str = "path") -> Column:
    """The longest rule that fits, as struct(rule, verdict), or null.

    Rules are plan input: one branch each, longest first.
    """
    found = F
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((F.col(host) == rule.host) | F.col(host).endswith("." + rule.host)) & F.col(path).startswith(rule.path)
        found = found.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict")))
    return found if rules else F.lit(None).cast("struct<rule:string,verdict:string>")


def host_edges(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(src, dst, weight): share of the links of a host that lead to each other host."""
    targets = F.explode(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(LINK), F.lit(1)))
    links = (
        pages.select(F.col("host").alias("src"), targets.alias("dst")).withColumn("dst", lower_ascii(F.col("dst")))
        .where("src <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("links"))
    )
    return links


def _flows(edges: DataFrame) -> DataFrame:
    """(kind, src, dst, share): trust along the edges, distrust against them."""
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links"))
    out = both.groupBy("kind", "src").agg(F.sum("links").alias("all"))
    return both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("links") / F.col("all")).alias("share"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING) -> DataFrame:
    """(kind, host, rank): personalised PageRank of each kind, on the scale of its seeds.

    ``seeds`` has (kind, host, seed). What hosts without outgoing edges hold goes back to the
    seeds in proportion, so a graph without edges leaves every seed with its own weight.
    """
    mass = {r["kind"]: r["mass"] for r in seeds.groupBy("kind").agg(F.sum("seed").alias("mass")).collect()}
    flows = settled(_flows(edges))
    ranks = settled(seeds.select("kind", "host", "seed", F.col("seed").alias("rank")))
    while mass:
        moved = (
            flows.join(ranks.where("rank > 0").select("kind", F.col("host").alias("src"), "rank"), ["kind", "src"])
            .groupBy("kind", F.col("dst").alias("host")).agg(F.sum(F.col("rank") * F.col("share")).alias("got"))
        )
        joined = settled(
            ranks.join(moved, ["kind", "host"], "full").select(
                "kind", "host", F.coalesce("seed", F.lit(0.0)).alias("seed"), F.coalesce("rank", F.lit(0.0)).alias("old"),
                F.coalesce("got", F.lit(0.0)).alias("got"))
        )
        arrived = {r["kind"]: r["got"] for r in joined.groupBy("kind").agg(F.sum("got").alias("got")).collect()}
        back = F.lit(0.0)
        for kind, whole in mass.items():  # two kinds
            lost = max(0.0, whole - arrived.get(kind, 0.0)) / whole
            back = F.when(F.col("kind") == kind, F.lit(lost)).otherwise(back)
        rank = (1 - damping) * F.col("seed") + damping * (F.col("got") + back * F.col("seed"))
        ranks = settled(joined.select("kind", "host", "seed", "old", rank.alias("rank")))
        change = ranks.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0] or 0.0
        if change < TOLERANCE * sum(mass.values()):
            break
    return ranks.select("kind", "host", "rank")


def blames(hosts: DataFrame, edges: DataFrame, damping: float = DAMPING) -> DataFrame:
    """(host, blame) from (host, own, ratio): own, or the damped mean blame of link targets times ratio."""
    out = edges.groupBy("src").agg(F.sum("links").alias("all"))
    shares = settled(
        edges.join(out, "src").join(hosts.select(F.col("host").alias("src"), "ratio").where("ratio > 0"), "src")
        .select("src", "dst", (F.lit(damping) * F.col("ratio") * F.col("links") / F.col("all")).alias("share")))
    now = hosts.select("host", "own", F.col("own").alias("blame"))
    while True:
        passed = (
            shares.join(now.where("blame > 0").select(F.col("host").alias("dst"), "blame"), "dst")
            .groupBy(F.col("src").alias("host")).agg(F.sum(F.col("share") * F.col("blame")).alias("got"))
        )
        now = settled(now.join(passed, "host", "left").select(
            "host", "own", F.col("blame").alias("old"), F.greatest("own", F.coalesce("got", F.lit(0.0))).alias("blame")))
        if (now.agg(F.max(F.abs(F.col("blame") - F.col("old")))).first()[0] or 0.0) < BLAME_TOLERANCE:
            return now.select("host", "blame")


def judge_urls(
    pages: DataFrame, rules: list[Rule], threshold: float = THRESHOLD, id_col: str = "page_id",
    url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust) per page."""
    ruled = pages.select(
        F.col(id_col).alias("id"), host_of(url_col).alias("host"), path_of(url_col).alias("path"),
        F.col(html_col).alias("html"),
    ).withColumn("fit", matching_rule(rules))
    slim = settled(ruled.select("id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("by_rule")))
    share = lambda verdict: F.avg(F.when(F.col("by_rule") == verdict, 1.0).otherwise(0.0))
    hosts = slim.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    seeds = settled(
        hosts.select("host", F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias("kind", "seed"))
        .where("seed > 0"))
    edges = settled(host_edges(ruled.select("host", "html")))
    ranks = propagate(seeds, edges)
    of_kind = lambda kind, c: F.sum(F.when(F.col("kind") == kind, F.col(c)).otherwise(0.0))
    both = ranks.join(seeds, ["kind", "host"], "left").withColumn("seed", F.coalesce("seed", F.lit(0.0)))
    both = both.withColumn("least", F.greatest("rank", "seed"))  # a host's own pages count in full, whatever links to it
    known = settled(both.groupBy("host").agg(
        of_kind("trust", "rank").alias("trust"), of_kind("distrust", "rank").alias("distrust"),
        of_kind("trust", "least").alias("t"), of_kind("distrust", "least").alias("d"),
        F.greatest(of_kind("distrust", "seed") - of_kind("trust", "seed"), F.lit(0.0)).alias("own")))
    ratio = F.when(F.col("d") > 0, F.col("d") / (F.col("t") + F.col("d"))).otherwise(0.0)
    scores = known.select("host", "trust", "distrust").join(blames(known.select("host", "own", ratio.alias("ratio")), edges), "host")
    by_graph = F.when(F.col("blame") >= threshold, "block").otherwise("allow")
    return (
        slim.join(scores, "host", "left").fillna(0.0, ["trust", "distrust"])
        .select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", by_graph).alias("verdict"), "trust", "distrust")
    )
