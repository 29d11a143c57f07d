"""Trust and distrust of hosts over the link graph, for pages that no url rule judges.

Hosts are linked by the absolute and protocol-relative references in their pages; links within a host do not count, and
a host without links to (from) others passes its trust (distrust) to itself. Trust starts at hosts in proportion to the
share of their pages that a rule allows and follows the links; distrust starts in proportion to the share that a rule
blocks and runs against them. They are personalised PageRank, left unscaled, so that 1 is the score of a
host all of whose pages are seeds and which links only to itself.

Distrust is a mass that all hosts with links to a blocked one divide among themselves, so alone it orders hosts but says
little of any single one. Regard runs against the links in the same way from the hosts that rules allow. The verdict goes
by the share of what a host received that came from blocked hosts, distrust / (distrust + regard): it is between 0 and 1,
linear in the seeds, and however many others link to the same blocked host, a host that reaches blocked seeds only has
the share 1, at any distance. A host is blocked if its share is at least ``least_share`` and above its trust. All three
scores are iterated until none changes by more than the tolerance.

NULL urls and urls without ``://`` have an empty host and path; no rule fits them and they are allowed, as they are of
no host. NULL pages hold no links. NULL ids and repeated rows are judged as any other. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stage

# Fixed values: (verdict, host, path) of the rules.
RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)
LINK = r"""(?i)\b(?:href|src|action)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/"'?#\s>\\]+)"""
#: Changes shrink by DAMPING in a round, so the tolerance is reached long before ROUNDS, for any number of hosts.
DAMPING, ROUNDS, TOLERANCE, LEAST_SHARE = 0.85, 250, 1e-6, 0.5
KINDS = ("trust", "distrust", "regard")
#: Links of a host beyond this number are dealt out over several keys.
SPREAD = 100_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else NULL; of rules of one length the first listed."""
    rule = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(reversed(list(rules)), key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def judged_by_rules(pages: DataFrame, id: str, url: str, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.withColumns({"rule": rule, "ruled": verdict})


def links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(src, dst, n): n pages of src link to dst, another host."""
    to = F.array_distinct(F.transform(F.regexp_extract_all(html, F.lit(LINK), F.lit(1)), ascii_lower))
    rows = pages.filter(F.col(html).isNotNull()).select(host_and_path(F.col(url))[0].alias("src"), F.explode(to).alias("dst"))
    return rows.filter("src != dst AND src != ''").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def flows(edges: DataFrame, hosts: DataFrame) -> DataFrame:
    """(kind, giver, taker, share, part): the share of its score that a host gives to another; those of a giver sum to 1.

    ``part`` deals the links of a host with very many out over several join keys.
    """
    along = lambda kind, giver, taker: F.struct(
        F.lit(kind).alias("kind"), F.col(giver).alias("giver"), F.col(taker).alias("taker"), F.col("n").cast("double").alias("n"))
    every = edges.select(F.inline(F.array(along("trust", "src", "dst"), along("distrust", "dst", "src"), along("regard", "dst", "src"))))
    sums = every.groupBy("kind", "giver").agg(F.sum("n").alias("given"), F.ceil(F.count(F.lit(1)) / SPREAD).cast("int").alias("parts"))
    return every.join(sums, ["kind", "giver"]).select(
        "kind", "giver", "taker", (F.col("n") / F.col("given")).alias("share"), "parts",
        F.pmod(F.xxhash64("taker"), F.col("parts")).cast("int").alias("part"))


def host_scores(ruled: DataFrame, edges: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING,
                tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust, regard) of every host that has pages; hosts that are only linked to take part but are not returned."""
    share = lambda kind: F.avg(F.when(F.col("ruled") == kind, 1.0).otherwise(0.0))
    seeds = ruled.filter("host != ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    edges = stage(edges, "host-links")
    linked = edges.select(F.explode(F.array("src", "dst")).alias("host")).distinct()
    seeds = seeds.join(linked, "host", "full").na.fill(0.0)
    seeds = seeds.withColumn("regard", F.col("trust"))
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("seed")) for k in KINDS))).alias("k")
    seeds = seeds.select("host", kinds).select("host", "k.kind", "k.seed")
    flow = stage(flows(edges, seeds), "host-flows")
    givers = flow.groupBy("kind", F.col("giver").alias("host")).agg(F.max("parts").alias("parts"))
    state = stage(seeds.join(givers, ["kind", "host"], "left").withColumn("score", F.col("seed")), "host-scores")
    for _ in range(rounds):
        sent = state.filter("parts IS NOT NULL").select(
            "kind", F.col("host").alias("giver"), "score", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        got = flow.join(sent, ["kind", "giver", "part"]).groupBy("kind", F.col("taker").alias("host")).agg(
            F.sum(F.col("share") * F.col("score")).alias("got"))
        kept = F.when(F.col("parts").isNull(), F.col("score")).otherwise(0.0)  # no links: to itself
        got_any = F.coalesce("got", F.lit(0.0))
        new = (1 - damping) * F.col("seed") + damping * (got_any + kept)
        after = state.join(got, ["kind", "host"], "left").select(
            "kind", "host", "seed", "parts", new.alias("score"), F.abs(new - F.col("score")).alias("change"))
        after = stage(after, "host-scores")
        state = after.drop("change")
        if (after.agg(F.max("change")).first()[0] or 0.0) <= tolerance:
            break
    of = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("score")))
    return state.groupBy("host").agg(*(of(k).alias(k) for k in KINDS))


def judge(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html",
          rules: Sequence[tuple[str, str, str]] = RULES, least_share: float = LEAST_SHARE, rounds: int = ROUNDS) -> DataFrame:
    """Every page with host, path, rule, verdict, and its host's trust, distrust, regard and share.

    The rules are a configured list and are compiled into one expression.
    """
    ruled = judged_by_rules(pages, id, url, rules)
    scores = host_scores(ruled, links(pages, url, html), rounds)
    scores = scores.withColumn("share", F.coalesce(F.try_divide("distrust", F.col("distrust") + F.col("regard")), F.lit(0.0)))
    blocked = (F.col("share") >= least_share) & (F.col("share") > F.col("trust"))
    verdict = F.coalesce("ruled", F.when(blocked, "block").otherwise("allow"))
    return ruled.join(scores, "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), *KINDS, "share")
