"""URL filters: rules on host and path, and link-graph propagation for the rest.

A rule such as ``example.com/de/`` fits its host and every subdomain where the
url's path starts with the rule's; the longest fitting rule decides.  Urls without
a rule get their host's verdict from the link graph:

* host edges are the pages' links, counted per (host, host) pair before any
  shuffle of pages, plus edges between a host and its parent host where both occur;
* a host is a trusted (blocked) seed if at least ``seed_share`` of its pages fall
  under an allow (block) rule;
* trust is personalised PageRank from the trusted seeds along links, distrust the
  same from the blocked seeds along reversed links, both in one iteration;
* a host is blocked if distrust makes up more than ``threshold`` of both.  Scores add
  up to 1 over all hosts and shrink as seeds grow in number, so only the ratio of the
  two decides and no score is too small.  Hosts that nothing reaches are allowed.

Null urls and urls without ``://`` have empty host and path, fit no rule and are
allowed.  Null html has no links.  An empty table gives an empty result.  Repeated
pages count as often as they occur and give repeated results.  Only the id, url
and html columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumisort.llm.common import ascii_lower, shared_checkpoint, stored

HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return (F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))
            .otherwise(F.lit("")))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits, else nulls.  ``rules``: (action, rule)."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        rule_host, slash, rule_path = text.partition("/")
        fits = (((host == F.lit(rule_host)) | F.endswith(host, F.lit("." + rule_host)))
                & F.startswith(path, F.lit(slash + rule_path)))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        action = F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts."""
    link = F.explode(F.regexp_extract_all(F.col(html_col), F.lit(HREF), F.lit(1)))
    links = pages.select(url_host(F.col(url_col)).alias("src"), link.alias("link"))
    full = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    return (links.select("src", url_host(full).alias("dst"))
            .where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
            .groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("n")))


def parent_links(hosts: DataFrame) -> DataFrame:
    """Edges both ways between a host and the host without its first label."""
    up = hosts.select(F.col("host").alias("src"), F.regexp_extract("host", r"^[^.]+\.(.+)$", 1).alias("dst"))
    up = up.where(F.col("dst") != "").join(hosts.select(F.col("host").alias("dst")), "dst", "left_semi")
    down = up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return up.select("src", "dst").unionByName(down).withColumn("n", F.lit(1.0))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, steps: int = 20,
              cut_every: int = 5) -> DataFrame:
    """Personalised PageRank for every ``kind``: edges (kind, src, dst, n), seeds
    (kind, host, seed) with seeds adding up to 1 per kind.  Result (kind, host,
    score) after all ``steps``; scores are checkpointed every ``cut_every`` steps."""
    total = edges.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    share = stored(edges.join(total, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("total"))
                                                            .alias("share")), "host-edges")
    start = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("score"))
    scores = seeds.select("kind", "host", F.col("seed").alias("score"))
    for step in range(1, steps + 1):
        sent = (share.join(scores.withColumnRenamed("host", "src"), ["kind", "src"])
                .select("kind", F.col("dst").alias("host"), (F.col("share") * F.col("score") * damping).alias("score")))
        scores = sent.unionByName(start).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if step % cut_every == 0 or step == steps:
            scores = shared_checkpoint(scores)
    return scores


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html", seed_share: float = 0.5, threshold: float = 0.5,
                 damping: float = 0.85, steps: int = 20) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, trust, distrust."""
    url = F.col(url_col)
    judged = pages.select(F.col(id_col), url_host(url).alias("host"), url_path(url).alias("path"))
    rule, action = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = judged.select(id_col, "host", "path", rule.alias("rule"), action.alias("_action"))
    hosts = stored(judged.where(F.col("host") != "").groupBy("host")
                   .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_action") == "allow").alias("n_allow"),
                        F.count_if(F.col("_action") == "block").alias("n_block")), "hosts")
    links = host_links(pages, url_col, html_col).unionByName(parent_links(hosts))
    links = links.groupBy("src", "dst").agg(F.sum("n").alias("n"))
    edges = (links.select(F.lit("trust").alias("kind"), "src", "dst", "n")
             .unionByName(links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"),
                                       F.col("src").alias("dst"), "n")))
    seeds = reduce(DataFrame.unionByName, [
        hosts.where(F.col(c) >= seed_share * F.col("n")).select(F.lit(kind).alias("kind"), "host",
                                                                F.col(c).cast("double").alias("w"))
        for kind, c in (("trust", "n_allow"), ("distrust", "n_block"))]).where(F.col("w") > 0)
    whole = seeds.groupBy("kind").agg(F.sum("w").alias("whole"))
    seeds = seeds.join(F.broadcast(whole), "kind").select("kind", "host", (F.col("w") / F.col("whole")).alias("seed"))
    scores = propagate(edges, seeds, damping, steps)
    by_host = scores.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("score"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("score"))), F.lit(0.0)).alias("distrust"))
    blocked = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))
    out = judged.join(by_host, "host", "left")
    verdict = F.coalesce(F.col("_action"), F.when(blocked, F.lit("block")).otherwise(F.lit("allow")))
    return out.select(id_col, "host", "path", "rule", verdict.alias("verdict"),
                      F.coalesce("trust", F.lit(0.0)).alias("trust"),
                      F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
