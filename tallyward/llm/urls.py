"""URL filters: rules first, then trust and distrust spread over the graph of hosts.

Hosts are linked by the absolute links of their pages and to the domain above them. Personalised
PageRank carries trust from the hosts of allowed pages along the links, and distrust from the
hosts of blocked pages against them. A host with more distrust than trust is blocked.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.session import materialise

MAX_RULES = 1_000  # rules are part of the plan
DAMPING = 0.85
TOLERANCE = 1e-7  # rounds end when none gives a host more than this part of its score
ROUNDS = 100  # DAMPING to this power is below the tolerance: rounds that a graph without longer ways needs
MAX_DISTRUST = 0.5  # of a host's trust and distrust together
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str  # this host and all below it
    path: str  # how the path begins

    @property
    def text(self) -> str:
        return self.host + self.path


def lower(c: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(c, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty if it is null or has no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return lower(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


def matching_rule(host: Column, path: Column, rules: Iterable[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else NULL; of equal ones the first."""
    rules = sorted(rules, key=lambda r: -len(r.text))
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    text = verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def host_links(judged: DataFrame, html: str) -> DataFrame:
    """``(source, target, weight)``: absolute links between hosts, and links to the domain above."""
    targets = F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(_LINK), F.lit(1)))
    links = judged.select(F.col("host").alias("source"), F.explode(targets).alias("target"))
    links = links.select("source", lower(F.col("target")).alias("target"), F.lit(1.0).alias("weight"))
    links = links.filter("source <> '' and source <> target").groupBy("source", "target").agg(F.sum("weight").alias("weight"))
    hosts = judged.select("host").union(links.select("target")).filter("host <> ''").distinct()
    labels = F.split("host", r"\.", -1)
    # Longer names are no domain names and have none above them.
    above = hosts.filter(F.length("host") <= 253).select("host", F.explode(F.sequence(F.lit(1), F.greatest(F.size(labels) - 2, F.lit(1)))).alias("k"))
    names = above.filter(F.size(labels) > 2).select(
        F.array_join(F.slice(labels, F.col("k"), F.size(labels)), ".").alias("source"),
        F.array_join(F.slice(labels, F.col("k") + 1, F.size(labels)), ".").alias("target"),
    )
    names = names.distinct().withColumn("weight", F.lit(1.0))
    return links.union(names).union(names.select("target", "source", "weight"))


def spread(links: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``(host, trust, distrust)`` from ``seeds`` of ``(host, trust, distrust)``, each summing to 1.

    Trust follows the links and distrust goes against them; a host passes on the damped part of
    what it has in proportion to the weights. What reaches a host without links ends there. A round
    passes on what came in the round before; rounds go on until what came is no more than
    ``tolerance`` of any host's score, so that no host is left that scores have yet to reach.
    """
    ways = links.select("source", "target", "weight", F.lit(True).alias("forward")).union(
        links.select(F.col("target"), F.col("source"), F.col("weight"), F.lit(False))
    )
    ways = ways.groupBy("source", "target", "forward").agg(F.sum("weight").alias("weight"))
    out = ways.groupBy("source", "forward").agg(F.sum("weight").alias("total"))
    ways = materialise(
        ways.join(out, ["source", "forward"]).select(
            "source", F.col("target").alias("host"), "forward", (F.col("weight") / F.col("total")).alias("share")
        ),
        "host-links",
    )
    seeds = materialise(seeds, "seeds")
    start = [((1 - DAMPING) * F.col(kind)) for kind in ("trust", "distrust")]
    scores = seeds.select(
        "host", *[c.alias(n) for c, n in zip(start * 2, ("trust", "distrust", "new_trust", "new_distrust"))]
    )
    while True:
        have = scores.select(F.col("host").alias("source"), "new_trust", "new_distrust").filter("new_trust + new_distrust > 0")
        given = ways.join(have, "source").select(
            "host",
            F.when(F.col("forward"), DAMPING * F.col("share") * F.col("new_trust")).otherwise(0.0).alias("trust"),
            F.when(F.col("forward"), 0.0).otherwise(DAMPING * F.col("share") * F.col("new_distrust")).alias("distrust"),
        )
        given = given.filter("trust + distrust > 0").withColumns({"new_trust": F.col("trust"), "new_distrust": F.col("distrust")})
        none = F.lit(0.0)
        known = scores.withColumns({"new_trust": none, "new_distrust": none})
        scores = known.union(given).groupBy("host").agg(
            *[F.sum(c).alias(c) for c in ("trust", "distrust", "new_trust", "new_distrust")]
        )
        scores = materialise(scores, "scores")
        moving = (F.col("new_trust") > tolerance * F.col("trust")) | (F.col("new_distrust") > tolerance * F.col("distrust"))
        if scores.filter(moving).isEmpty():
            return scores.select("host", "trust", "distrust")


def judge(
    pages: DataFrame, rules: Iterable[Rule], page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of each page.

    The longest rule that fits decides. Otherwise the host's share of distrust does: it is blocked
    above ``MAX_DISTRUST``; hosts that neither trust nor distrust reaches are allowed, as are pages
    whose URL is null or has no host. Null pages have no links. Every row has its own result, so
    repeated rows stay; other columns are not used.
    """
    host, path = host_and_path(F.col(url))
    placed = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), F.col(html).alias("html"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), list(rules))
    ruled = placed.withColumn("rule", rule).withColumn("ruled", verdict)
    kinds = ruled.filter("host <> ''").groupBy("host").agg(
        F.count_if(F.col("ruled") == "allow").cast("double").alias("trust"),
        F.count_if(F.col("ruled") == "block").cast("double").alias("distrust"),
    )
    kinds = materialise(kinds, "hosts")
    totals = kinds.agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d")).first()
    seeds = kinds.filter("trust + distrust > 0").select(
        "host", (F.col("trust") / (totals.t or 1.0)).alias("trust"), (F.col("distrust") / (totals.d or 1.0)).alias("distrust")
    )
    scores = spread(materialise(host_links(placed, "html"), "links"), seeds)
    bad = F.col("distrust") > MAX_DISTRUST * (F.col("trust") + F.col("distrust"))
    blocked = materialise(scores.filter(bad).select("host", F.lit(True).alias("blocked")), "blocked")
    return (
        ruled.drop("html")
        .join(blocked, "host", "left")
        .select(
            F.col("page_id").alias(page_id),
            "host",
            "path",
            "rule",
            F.coalesce("ruled", F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        )
    )
