"""URL filter by rules and link-graph propagation (operator 1, native).

A rule is a host and a path prefix; it fits its host and all subdomains, the
longest fitting rule decides. For urls without a rule the host decides:
personalised PageRank spreads trust from hosts with allowed pages along the
host links, and distrust from hosts with blocked pages along the reversed
links; a host whose share of trust is below ``threshold`` is blocked. Ranks are
iterated until their summed change falls below ``tolerance``, whatever number of
rounds that takes: each round shrinks it by the damping at least.

Scale: html is read once for its links, which are reduced to distinct host
pairs before any shuffle; an iteration moves one row per host pair. Ranks are
checkpointed each round, only their summed change comes to the driver, pages are
joined by host with their ids and urls only.

Defined cases: a null url or one without ``://`` has empty host and path, no
rule, and is allowed; repeated rows are judged each; null html has no links;
links to the own host don't count; hosts without trust and distrust are
allowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import cut, lower_ascii

LINK = r"(?i)href\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'<>\s]+)"
DAMPING, TOLERANCE, THRESHOLD = 0.85, 1e-6, 1 / 3


def host_of(url):
    at = F.instr(url, F.lit("://"))
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))
    return F.coalesce(lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url):
    at = F.instr(url, F.lit("://"))
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host, path, rules: list[tuple[str, str]]):
    """Longest fitting rule and its verdict, as two columns."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):  # the longest ends up outermost
        h, _, p = text.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit("/" + p))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Distinct pairs (src, dst) of different linked hosts."""
    found = pages.select(host_of(F.col(url)).alias("src"),
                         F.array_distinct(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1))).alias("to"))
    return (found.where("src <> '' and size(to) > 0").select("src", F.explode("to").alias("dst"))
            .select("src", lower_ascii(F.col("dst")).alias("dst")).where("src <> dst").distinct())


def propagate(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """``(kind, host, rank)`` from ``seeds(kind, host, seed)``: kind ``allow``
    along the links, ``block`` against them."""
    step = links.select(F.lit("allow").alias("kind"), "src", "dst").union(
        links.select(F.lit("block").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst")))
    degree = step.groupBy("kind", "src").agg(F.count("*").alias("degree"))
    step = cut(step.join(degree, ["kind", "src"]).withColumn("w", F.lit(damping) / F.col("degree")).drop("degree"))
    seeds = cut(seeds)
    base = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("rank"), F.lit(0.0).alias("old"))
    rank = seeds.select("kind", "host", F.col("seed").alias("rank"))
    while True:
        moved = (rank.withColumnRenamed("host", "src").join(step, ["kind", "src"])
                 .select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("w")).alias("rank"), F.lit(0.0).alias("old")))
        before = rank.select("kind", "host", F.lit(0.0).alias("rank"), F.col("rank").alias("old"))
        new = cut(moved.union(base).union(before).groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.sum("old").alias("old")))
        change = new.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0] or 0.0
        rank = new.drop("old")
        if change < tolerance:
            return rank


def judge(pages: DataFrame, rules: list[tuple[str, str]], *, page_id: str = "page_id", url: str = "url",
          html: str = "html", damping: float = DAMPING, tolerance: float = TOLERANCE,
          threshold: float = THRESHOLD) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every page."""
    parsed = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    parsed = parsed.select("page_id", "host", "path", rule.alias("rule"), says.alias("says"))
    counts = parsed.where("says is not null and host <> ''").groupBy(F.col("says").alias("kind"), "host").agg(F.count("*").alias("n"))
    total = counts.groupBy("kind").agg(F.sum("n").alias("total"))  # two rows
    seeds = counts.join(F.broadcast(total), "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("seed"))
    rank = propagate(host_links(pages, url, html), seeds, damping, tolerance)
    hosts = rank.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "allow", F.col("rank")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "block", F.col("rank")).otherwise(0.0)).alias("distrust"))
    blocked = hosts.where(F.col("trust") < threshold * (F.col("trust") + F.col("distrust"))).select("host", F.lit("block").alias("by_host"))
    return (parsed.join(blocked, "host", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("says", "by_host", F.lit("allow")).alias("verdict")))
