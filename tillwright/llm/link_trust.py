"""Verdicts on urls by rules and, beyond them, by trust and distrust on the graph of hosts.

Rules name a host and the beginning of a path.  A host most of whose pages the rules allow is a
trusted seed, one most of whose pages they block a blocked seed.  Trust flows from trusted seeds
along links (personalised PageRank); distrust flows from blocked seeds against them, to those that
link to bad hosts.  A host without a rule is blocked if it got more distrust than trust, and more
than a share of what a seed begins with.

Ranks are whole numbers: a seed's part of ``MASS``, divided with remainders dropped.  So they do not
depend on the order of additions, and any rerun or other engine finds the same verdicts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm.common import stored

MASS = 10**18
ROUNDS = 10
#: Per cent of a rank that is passed on in a round; the rest comes from the seeds.
PASSED = 85
#: A host is blocked from this per cent of a seed's first distrust on.
LEAST_PERCENT = 5

#: A link with a host of its own.  Relative links stay on their host and make no edge.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\s"'<>]+)"""


@dataclass(frozen=True)
class Rule:
    """``text`` is a host, a slash and the beginning of a path, like ``example.net/en/``."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


RULES = [
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case; else empty."""
    host = F.regexp_extract(_behind_scheme(url), "^([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower())


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_behind_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _behind_scheme(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _by_rule(rules: list[Rule], field: str) -> Column:
    """``field`` of the longest rule that fits, else NULL."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda rule: len(rule.text)):
        chosen = F.when(rule.fits(F.col("host"), F.col("path")), F.lit(getattr(rule, field))).otherwise(chosen)
    return chosen


def by_rules(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id, host, path, rule`` and ``ruled``, the rule's verdict."""
    url = pages["url"].cast("string")
    placed = pages.select(pages["page_id"].cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    return placed.withColumns({"rule": _by_rule(rules, "text"), "ruled": _by_rule(rules, "verdict")})


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct links between different hosts, ``src`` and ``dst``, combined before their shuffle."""
    links = F.regexp_extract_all(pages["html"].cast("string"), F.lit(LINK), F.lit(1))
    found = pages.select(host_of(pages["url"].cast("string")).alias("src"), F.explode(links).alias("link"))
    # A link may leave the scheme out.
    dst = host_of(F.concat(F.lit("x:"), F.substring("link", F.instr("link", "//"), F.length("link"))))
    return found.select("src", dst.alias("dst")).where("src != '' AND dst != '' AND src != dst").distinct()


def seeds(judged: DataFrame) -> DataFrame:
    """``host, trust, distrust``: the equal parts of ``MASS`` that seeds of either kind begin with."""
    hosts = judged.where("host != ''").groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("ruled") == "allow").alias("allowed"),
        F.count_if(F.col("ruled") == "block").alias("blocked"),
    )
    kinds = hosts.select(
        "host", (2 * F.col("allowed") > F.col("pages")).alias("good"), (2 * F.col("blocked") > F.col("pages")).alias("bad")
    ).where("good OR bad")
    totals = kinds.agg(F.count_if("good").alias("goods"), F.count_if("bad").alias("bads"))  # one row
    part = lambda kind: F.when(F.col(kind), F.expr(f"{MASS} div greatest({kind}s, 1)")).otherwise(F.lit(0))
    return kinds.crossJoin(F.broadcast(totals)).select("host", part("good").alias("trust"), part("bad").alias("distrust"))


def propagate(spark: SparkSession, edges: DataFrame, seeded: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``host, trust, distrust`` after ``rounds``; ``edges`` and ``seeded`` are stored tables.

    A round joins the ranks to the edges once in each direction and adds up per host, combined
    before the shuffle; AQE splits hosts with very many links.  Every round is stored.
    """
    if edges.isEmpty():  # then every round ends as it began
        return _first(seeded)
    degrees = edges.join(edges.groupBy("src").agg(F.count("*").alias("links_out")), "src")
    degrees = stored(spark, degrees.join(edges.groupBy("dst").agg(F.count("*").alias("links_in")), "dst"), "edges")
    ranks = stored(spark, _first(seeded), "ranks")
    passed = f"div 100 * {PASSED}"
    for _ in range(rounds):
        forward = degrees.join(ranks.where("trust > 0"), degrees["src"] == ranks["host"]).selectExpr(
            "dst AS host", f"trust div links_out {passed} AS trust", "0L AS distrust"
        )
        backward = degrees.join(ranks.where("distrust > 0"), degrees["dst"] == ranks["host"]).selectExpr(
            "src AS host", "0L AS trust", f"distrust div links_in {passed} AS distrust"
        )
        total = _first(seeded).union(forward).union(backward).groupBy("host")
        ranks = stored(spark, total.agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")), "ranks")
    return ranks


def _first(seeded: DataFrame) -> DataFrame:
    return seeded.selectExpr("host", *(f"{c} div 100 * {100 - PASSED} AS {c}" for c in ("trust", "distrust")))


def blocked_hosts(ranks: DataFrame, seeded: DataFrame) -> DataFrame:
    """Hosts that distrust decides against."""
    least = _first(seeded).agg(F.expr(f"max(distrust) div 100 * {LEAST_PERCENT}").alias("least"))  # one row
    return ranks.crossJoin(F.broadcast(least)).where("distrust > trust AND distrust >= least").select("host")


def judge(spark: SparkSession, pages: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    Without a host (NULL url, or one without ``://``) no rule fits and nothing speaks against the
    page, so it is allowed, as is a host nobody links to or from.  NULL pages have no links.
    Repeated rows are judged each.  An empty table gives no rows; other columns are not read.
    The final join is by host, and AQE splits a host with most pages.
    """
    judged = by_rules(pages, rules)
    edges = stored(spark, host_edges(pages), "links")
    seeded = stored(spark, seeds(judged), "seeds")
    bad = blocked_hosts(propagate(spark, edges, seeded), seeded).withColumn("bad", F.lit(True))
    verdict = F.coalesce(F.col("ruled"), F.when(F.col("bad"), "block").otherwise("allow"))
    return judged.join(bad, "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
