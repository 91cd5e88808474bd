"""URL filter with rules and a link graph, in DataFrame operations only.

A rule names a host and a path prefix and fits that host and its subdomains; of the rules that fit, the longest decides.
Pages without a rule are judged by their host: trust is a personalised PageRank from hosts with allowed pages, distrust a
personalised PageRank over the reversed edges from hosts with blocked pages, and a host is blocked where distrust is over
``BLOCK_RATIO`` times trust. A host with neither is allowed.

Edges run from a page's host to the hosts that its links name (links without a host stay inside and are no edge), and
both ways between a host and its parent domain, so that subdomains hear of each other. They are summed per host pair before
anything is shuffled. A host's seed is the share of its pages with that verdict.

Null urls and urls without ``://`` have an empty host and path, which no rule fits; they take part in no edge and are
allowed. Null html has no links. Repeated pages count as often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadtally.llm.common import ascii_lower, written

DAMPING = 0.85
ROUNDS = 12
BLOCK_RATIO = 2.0
LINKS = r"""(?i)(?:href|src)\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""

# (verdict, rule)
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest fitting rule as ``struct(rule, verdict)``, or null; of equally long ones the first given."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """``(src, dst, weight)`` between different hosts: links of ``pages(host, html)`` and parent domains of ``hosts(host)``."""
    links = (
        pages.where("host != ''")
        .select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINKS), 1)).alias("dst"))
        .select("src", ascii_lower(F.col("dst")).alias("dst"))
        .where("src != dst")
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("weight"))
    )
    parent = F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1)
    kin = hosts.select(F.col("host").alias("src"), parent.alias("dst")).where("dst != ''")
    kin = kin.union(kin.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    return links.union(kin.withColumn("weight", F.lit(1.0))).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def personalised_rank(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """``(host, rank)`` from ``edges(src, dst, weight)`` and ``seeds(host, seed)``.

    Each round sends rank along the edges, pre-aggregated per task, and is a written table. Ranks are linear in the seeds, whose
    sum need not be 1; what reaches a host without out-edges goes no further.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    shares = written(edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("share")), "shares")
    base = written(seeds.select("host", ((1 - damping) * F.col("seed")).alias("part")), "seeds")
    ranks = seeds.select("host", F.col("seed").alias("rank"))
    for _ in range(rounds):
        moved = shares.join(ranks, shares["src"] == ranks["host"]).select(
            F.col("dst").alias("host"), (damping * F.col("rank") * F.col("share")).alias("part")
        )
        ranks = written(moved.union(base).groupBy("host").agg(F.sum("part").alias("rank")), "ranks")
    return ranks


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    rounds: int = ROUNDS,
    block_ratio: float = BLOCK_RATIO,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, trust, distrust)`` for every row of ``pages(page_id, url, html)``."""
    url = F.col("url")
    located = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), "html")
    ruled = located.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    per_host = written(
        ruled.where("host != ''")
        .groupBy("host")
        .agg(
            F.count("*").alias("pages"),
            F.count(F.when(F.col("found.verdict") == "allow", 1)).alias("allowed"),
            F.count(F.when(F.col("found.verdict") == "block", 1)).alias("blocked"),
        ),
        "hosts",
    )
    edges = written(host_edges(located.select("host", "html"), per_host.select("host")), "edges")

    def seeds(column: str) -> DataFrame:
        return per_host.where(F.col(column) > 0).select("host", (F.col(column) / F.col("pages")).alias("seed"))

    trust = personalised_rank(edges, seeds("allowed"), rounds)
    reverse = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    distrust = personalised_rank(reverse, seeds("blocked"), rounds)
    judged = written(
        per_host.select("host")
        .join(trust.withColumnRenamed("rank", "trust"), "host", "left")
        .join(distrust.withColumnRenamed("rank", "distrust"), "host", "left")
        .fillna(0.0, ["trust", "distrust"]),
        "judged",
    )
    own = F.when(F.col("distrust") > block_ratio * F.col("trust"), "block").otherwise("allow")
    return (
        ruled.drop("html")
        .join(judged, "host", "left")
        .select(
            "page_id",
            "host",
            "path",
            F.col("found.rule").alias("rule"),
            F.coalesce(F.col("found.verdict"), own).alias("verdict"),
            F.coalesce("trust", F.lit(0.0)).alias("trust"),
            F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
        )
    )
