"""URL verdicts from rules and from trust and distrust that spread over the host graph.

Rules are (verdict, host + path prefix).  A rule fits a url on its host or a
subdomain whose path starts with the rule's path; the longest rule wins and
gives the verdict.  Other pages get their host's verdict: trust is a
personalised PageRank from the hosts with an allow rule along the links between
hosts, distrust one from the hosts that are blocked as a whole against the
links.  Hosts that are only linked to, without a page of their own, are
hosts of the graph and seeds as well.  Both are measured in multiples of an even
share of all hosts; a host is blocked when its distrust exceeds its trust by
more than ``margin``.

Links are the absolute and scheme-relative ``href``s of the pages' html.  The
iteration stops at a change below ``tolerance``, which damping guarantees.

A null url or one without ``://`` has an empty host and path, which no rule
fits and which is allowed.  Null html has no links.  Repeated rows are judged
one by one.  Only page_id, url and html are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklens.llm.shared import written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HREF = r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s<>]+)"""


def _after_scheme(url: Column) -> Column:
    """What stands after the first ``://``; '' if there is none."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _rules(rules: Sequence[tuple[str, str]]) -> Column:
    """The rules as an array of (rule_host, rule_path, rule, verdict)."""
    parts = []
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        host = "".join(_LOWER[_UPPER.index(c)] if c in _UPPER else c for c in host)
        parts.append(F.struct(F.lit(host).alias("rule_host"), F.lit(slash + path).alias("path"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
    return F.array(*parts)


def hosts_with_rules(pages: DataFrame, edges: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(host, rules): every host of the pages and of the links with the rules of its domains, longest first."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host <> ''")
    hosts = hosts.unionByName(edges.select(F.col("src").alias("host"))).unionByName(edges.select(F.col("dst").alias("host"))).distinct()
    if not rules:
        return hosts.withColumn("rules", F.lit(None).cast("array<struct<len:int,rule:string,path:string,verdict:string>>"))
    given = pages.sparkSession.range(1).select(F.explode(_rules(rules)).alias("r")).select("r.*")
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = hosts.select("host", F.explode(suffixes).alias("rule_host")).join(given, "rule_host")
    entry = F.struct(F.length("rule").alias("len"), "rule", "path", "verdict")
    return hosts.join(fitting.groupBy("host").agg(F.sort_array(F.collect_set(entry), False).alias("rules")), "host", "left")


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): links between different hosts, counted."""
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all("html", F.lit(_HREF), 1)).alias("link"))
    links = links.select("src", host_of(F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))).alias("dst"))
    return links.where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def personalised_rank(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """(host, rank): PageRank of (src, dst, weight) edges with restarts at (host, seed); seeds sum to 1, and hosts without links restart.

    Every round is one join and one sum, written to the shared folder; only its
    total change comes to the driver.
    """
    total = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    steps = written(edges.join(total, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("share")), "steps")
    rank = seeds.select("host", F.col("seed").alias("rank"))
    if steps.isEmpty():
        return rank
    change = 1.0
    while change > tolerance:
        moved = rank.join(steps, F.col("host") == F.col("src")).groupBy(F.col("dst").alias("host")).agg((damping * F.sum(F.col("rank") * F.col("share"))).alias("in"))
        lost = 1 - (moved.agg(F.sum("in")).first()[0] or 0.0)  # restarts, and what hosts without links hold
        new = moved.join(seeds, "host", "full").select("host", (F.coalesce("in", F.lit(0.0)) + lost * F.coalesce("seed", F.lit(0.0))).alias("rank"))
        new = written(new, "rank")
        change = new.join(rank.withColumnRenamed("rank", "old"), "host", "full").agg(F.sum(F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))))).first()[0] or 0.0
        rank = new
    return rank


def _seeds(hosts: DataFrame, wanted: Column) -> DataFrame:
    """(host, seed): an even share for each wanted host."""
    chosen = hosts.where(wanted).select("host")
    return chosen.withColumn("seed", F.lit(1.0 / max(1, chosen.count())))


def host_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str]], margin: float = 0.1, damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """(host, rules, trust, distrust, blocked) of every host of the pages and of their links."""
    edges = written(host_edges(pages), "edges")
    hosts = written(hosts_with_rules(pages, edges, rules), "hosts")
    root = F.filter("rules", lambda r: F.lit("/").startswith(r["path"]))
    blocked = F.coalesce(F.get(root, F.lit(0))["verdict"] == "block", F.lit(False))
    allowed = F.coalesce(F.exists("rules", lambda r: r["verdict"] == "allow"), F.lit(False)) & ~blocked
    n = hosts.count()
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    trust = personalised_rank(edges, _seeds(hosts, allowed), damping, tolerance).select("host", (F.col("rank") * n).alias("trust"))
    distrust = personalised_rank(back, _seeds(hosts, blocked), damping, tolerance).select("host", (F.col("rank") * n).alias("distrust"))
    out = hosts.join(trust, "host", "left").join(distrust, "host", "left").fillna(0.0, ["trust", "distrust"])
    return out.withColumn("blocked", F.col("distrust") - F.col("trust") > margin)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], margin: float = 0.1) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    verdicts = host_verdicts(pages, rules, margin).select("host", "rules", "blocked")
    judged = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).join(verdicts, "host", "left")
    first = F.get(F.filter("rules", lambda r: F.col("path").startswith(r["path"])), F.lit(0))
    own = F.when(F.col("blocked"), "block").otherwise("allow")
    return judged.withColumn("r", first).select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce(F.col("r.verdict"), own).alias("verdict"))
