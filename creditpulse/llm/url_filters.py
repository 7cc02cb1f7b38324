"""URL filters: rules by host and path, and link-graph propagation for the rest.

Method: the pages' links give a graph of hosts. Personalised PageRank spreads
trust from hosts with allowed pages along links; distrust spreads from hosts
with blocked pages against the links (who links to bad hosts is suspect). Both
run as one iteration of joins and sums.

A host starts with its share of allowed or blocked pages times its links in the
direction of the walk, so every link carries the same weight wherever it starts.
Beside it runs the walk that all hosts start whole. What a host receives is the
part of the second that the first makes up: near the share of its links that
lead to blocked hosts (or come from trusted ones), whatever the number of pages,
links or fellow linkers. A host's own pages speak for themselves: ``distrust``
is its blocked share plus, for the share of its pages without a rule, the
received part; ``trust`` likewise, and just so much of all that a host holds is
passed on: a blocked host does not get better by its own links. A host is blocked if distrust exceeds trust
by the threshold, so links never clear a host that is blocked in the main.

Edges are summed per pair of hosts before any shuffle of them, so a hot host
sends no more edges than it has neighbours.

Only DataFrame functions run here. Defined results: a null url, or one without
``://``, has empty host and path, no rule and the verdict of the empty host,
which has no links; null html has no links; repeated pages count as pages each;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditpulse.llm.common import ascii_lower, cut

#: (verdict, host, path): a rule fits its host and all subdomains where the path starts so.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""
ITERATIONS, DAMPING, THRESHOLD = 10, 0.85, 0.5


def host_of(rest: Column) -> Column:
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def split_urls(pages: DataFrame, url: str) -> DataFrame:
    """Adds ``host`` and ``path``."""
    rest = F.when(F.instr(F.col(url), "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    return pages.withColumn("__rest", rest).withColumns({"host": host_of(F.col("__rest")), "path": path_of(F.col("__rest"))}).drop("__rest")


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest fitting rule, else null."""
    text = verdict = None
    for kind, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)) if text is None else text.when(fits, F.lit(h + p))
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    return text, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, n``: links between different hosts. Links without a host of
    their own stay on the page's host and make no edge."""
    link = F.explode(F.regexp_extract_all(F.col("html"), F.lit(HREF), F.lit(1)))
    target = F.regexp_extract(F.col("link"), r"^(?i:https?:)?//([^/?#]+)", 1)
    return (pages.where(F.col("html").contains("//") & (F.col("host") != "")).select("host", link.alias("link"))
            .select(F.col("host").alias("src"), ascii_lower(target).alias("dst"))
            .where("dst <> '' and dst <> src").groupBy("src", "dst").agg(F.count("*").alias("n")))


def host_scores(pages: DataFrame, iterations: int = ITERATIONS, damping: float = DAMPING) -> DataFrame:
    """``host, pages, trust, distrust``, the last two from 0 to 1, from ``pages (host, verdict, html)``."""
    counts = cut(pages.groupBy("host").agg(F.count("*").alias("pages"),
                                           (F.count_if(F.col("verdict") == "allow") / F.count("*")).alias("allowed"),
                                           (F.count_if(F.col("verdict") == "block") / F.count("*")).alias("blocked")), "url-hosts")
    links = cut(host_edges(pages), "url-links")
    if links.isEmpty():  # nothing to spread: a host is what its own pages are
        return counts.select("host", "pages", F.col("allowed").alias("trust"), F.col("blocked").alias("distrust"))
    # kind, from, to, weight: trust follows links, distrust goes against them.
    both = links.select(F.explode(F.array(F.struct(F.lit("t").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "n"),
                                          F.struct(F.lit("d").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), "n"))).alias("e")).select("e.*")
    outs = both.groupBy("kind", "a").agg(F.sum("n").cast("double").alias("whole"))
    edges = cut(both.join(outs, ["kind", "a"]).select("kind", "a", "b", (F.col("n") / F.col("whole")).alias("w")), "url-edges")
    own = F.coalesce(F.when(F.col("kind") == "t", F.col("allowed")).otherwise(F.col("blocked")), F.lit(0.0))
    unruled = 1 - F.col("allowed") - F.col("blocked")
    seeds = cut(outs.join(counts.withColumnRenamed("host", "a"), "a", "left").select(
        "kind", "a", F.col("whole").alias("start"), own.alias("own"), F.coalesce(unruled, F.lit(1.0)).alias("open")), "url-seeds")
    score = seeds.select("kind", "a", (F.col("own") * F.col("start")).alias("part"), F.col("start").alias("whole"))
    for i in range(iterations):
        received = (score.join(edges, ["kind", "a"]).groupBy("kind", F.col("b").alias("a"))
                    .agg(*(F.sum(F.col(c) * F.col("w") * damping).alias(c) for c in ("part", "whole"))))
        if i % 5 == 4:
            received = cut(received, "url-received")
        whole = F.col("start") + F.coalesce("whole", F.lit(0.0))
        score = seeds.join(received, ["kind", "a"], "left").select(
            "kind", "a", (F.col("own") * whole + F.col("open") * F.coalesce("part", F.lit(0.0))).alias("part"), whole.alias("whole"))
    part = F.col("part") / F.col("whole")
    wide = received.groupBy(F.col("a").alias("host")).agg(F.max(F.when(F.col("kind") == "t", part)).alias("t"),
                                                          F.max(F.when(F.col("kind") == "d", part)).alias("d"))
    return counts.join(wide, "host", "left").select(
        "host", "pages", (F.col("allowed") + unruled * F.coalesce("t", F.lit(0.0))).alias("trust"),
        (F.col("blocked") + unruled * F.coalesce("d", F.lit(0.0))).alias("distrust"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """id, ``host``, ``path``, ``rule``, ``verdict`` and the host's ``trust`` and ``distrust`` of every row."""
    named = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("__url"), F.col(html_col).cast("string").alias("html"))
    split = split_urls(named, "__url").drop("__url")
    text, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = split.withColumns({"rule": text, "verdict": verdict})
    scores = cut(host_scores(ruled).withColumnRenamed("host", "of_host"), "url-verdicts")
    judged = ruled.drop("html").join(scores, F.col("host") == F.col("of_host"), "left")
    bad = F.col("distrust") - F.col("trust") > threshold
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule",
                         F.coalesce("verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
                         "trust", "distrust")
