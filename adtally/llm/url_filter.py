"""URL verdicts by rules and by trust that spreads over links between hosts, in DataFrame functions only.

Rules decide the pages they fit. The pages they allow make their hosts trusted seeds,
those they block make them distrusted seeds, each by its number of pages. Trust spreads
along host edges and distrust against them, both as personalised PageRank. Edges are
links in the html that lead to another host, weighted by their number, and the ties
of a site: a host and the domain above it point at each other, with little weight. A page without
a rule is blocked if its host's distrust exceeds ``threshold`` times its trust.

Pages only enter as counts per host and edge, summed before each shuffle; the iterations
handle one row per host and edge, and each is written to the shared folder.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.decontamination import lower_ascii
from adtally.llm.store import written

LINK = r"""(?is)\bhref\s*=\s*["']\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""
SITE_WEIGHT = 0.1


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains and all paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(verdict, host, slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_for(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; of equally long ones the blocking one."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block")):
        fits = r.fits(host, path)
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def host_edges(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``src``, ``dst`` and ``weight`` from pages with their host: links to other hosts, and site ties."""
    targets = F.regexp_extract_all(F.coalesce(html_column, F.lit("")), F.lit(LINK), F.lit(1))
    links = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(targets).alias("url"))
    full = F.when(F.col("url").startswith("//"), F.concat(F.lit("http:"), "url")).otherwise(F.col("url"))
    links = links.select("src", host_of(full).alias("dst"), F.lit(1.0).alias("weight")).where("dst <> '' and src <> dst")
    parent = F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1)
    hosts = pages.where("host <> ''").groupBy("host").agg((F.count("*") * SITE_WEIGHT).alias("weight"))
    ties = hosts.select(F.col("host").alias("src"), parent.alias("dst"), "weight").where("dst <> ''")
    both = ties.union(ties.select(F.col("dst"), F.col("src"), F.col("weight")))
    return links.union(both).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-4, rounds: int | None = None) -> DataFrame:
    """Rank of each (kind, node) by personalised PageRank, for several kinds of graph at once.

    ``edges``: kind, src, dst, weight; ``seeds``: kind, node, amount. Each kind's ranks add up to 1
    where it has seeds; what reaches a node without edges returns to the seeds. Rounds end when no
    rank moves by more than ``tolerance`` times itself. A node that is reached for the first time
    moves by all of its rank, so every node that a seed can reach gets one, however many seeds share
    the 1. Moves shrink by ``damping`` a round and a rank once reached has a floor, so the rounds end
    without a limit; ``rounds`` can set one.
    """
    total = edges.groupBy("kind", "src").agg(F.sum("weight").alias("out"))
    shares = written(edges.join(total, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("out")).alias("share")), "shares")
    amounts = seeds.groupBy("kind").agg(F.sum("amount").alias("all"))
    start = seeds.join(amounts, "kind").where("`all` > 0").select("kind", "node", (F.col("amount") / F.col("all")).alias("seed"), F.lit(False).alias("sends"))
    senders = shares.select("kind", F.col("src").alias("node"), F.lit(0.0).alias("seed"), F.lit(True).alias("sends"))
    base = written(start.union(senders.distinct()).groupBy("kind", "node").agg(F.sum("seed").alias("seed"), F.max("sends").alias("sends")), "seeds")
    ranks = base.where("seed > 0").select("kind", "node", F.col("seed").alias("rank"), F.lit(0.0).alias("old"), "sends")
    moved = F.abs(F.col("rank") - F.col("old")) > tolerance * F.col("rank")
    for _ in itertools.count() if rounds is None else range(rounds):
        # One row per kind: what its edges carry on, and whether a rank still moves.
        state = ranks.groupBy("kind").agg((F.sum(F.when(F.col("sends"), F.col("rank")).otherwise(0.0)) * damping).alias("kept"), F.max(moved).alias("moved")).collect()
        if not any(r["moved"] for r in state):
            break
        back = F.lit(1.0)
        for r in state:
            back = F.when(F.col("kind") == r["kind"], 1.0 - r["kept"]).otherwise(back)
        no, none = F.lit(False).alias("sends"), F.lit(0.0)
        sent = shares.join(ranks, (shares["kind"] == ranks["kind"]) & (shares["src"] == ranks["node"])).select(shares["kind"], F.col("dst").alias("node"), (F.col("share") * F.col("rank") * damping).alias("got"), none.alias("old"), no)
        fixed = base.select("kind", "node", (F.col("seed") * back).alias("got"), none.alias("old"), "sends")
        now = ranks.select("kind", "node", none.alias("got"), F.col("rank").alias("old"), no)
        fresh = sent.union(fixed).union(now).groupBy("kind", "node").agg(F.sum("got").alias("rank"), F.sum("old").alias("old"), F.max("sends").alias("sends"))
        ranks = written(fresh.where("rank > 0 or old > 0"), "ranks")
    return ranks.select("kind", "node", "rank")


def judge(
    pages: DataFrame, rules: list[Rule], threshold: float = 1.0, damping: float = 0.85, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """``host``, ``path``, ``rule``, ``verdict``, ``trust`` and ``distrust`` of every page.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up
    to ``?``, ``#`` or the end. Defined cases: a null url or one without ``://`` has neither, fits no
    rule and is allowed; null or odd html has no links; hosts that no seed reaches are allowed, and so
    are ties; repeated rows and null ids stay one row each and count each; an empty table gives no rows.
    """
    url = F.col(url_column)
    read = pages.select(F.col(id_column).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"), F.col(html_column).alias("html"))
    rule, verdict = rule_for(rules, F.col("host"), F.col("path"))
    judged = read.withColumns({"rule": rule, "given": verdict})

    seeds = judged.where("host <> '' and given is not null").groupBy(F.when(F.col("given") == "allow", "trust").otherwise("distrust").alias("kind"), F.col("host").alias("node")).agg(F.count("*").cast("double").alias("amount"))
    forward = written(host_edges(read.select("host", "html"), "html"), "edges")
    edges = forward.select(F.lit("trust").alias("kind"), "src", "dst", "weight").union(forward.select(F.lit("distrust"), F.col("dst"), F.col("src"), F.col("weight")))
    ranks = spread(edges, seeds, damping)
    # Rounded to nine digits of their own, so that equal amounts that were added up in another order stay equal and small ones stay above 0.
    amount = lambda kind: F.format_string("%.8e", F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0))).cast("double").alias(kind)
    hosts = written(ranks.groupBy(F.col("node").alias("host")).agg(amount("trust"), amount("distrust")), "hosts")
    out = judged.select("id", "host", "path", "rule", "given").join(hosts, "host", "left")
    spoiled = F.coalesce(F.col("distrust") > threshold * F.col("trust"), F.lit(False))
    return out.select(
        F.col("id").alias(id_column), "host", "path", "rule", F.coalesce("given", F.when(spoiled, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
