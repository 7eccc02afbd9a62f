"""Allow and block rules on urls, carried over links between hosts where no rule fits.

Trust starts at hosts with allowed pages and follows links; distrust starts at hosts
with blocked pages and follows links backwards: who links to a bad host is suspect. Both
are personalised PageRanks over host edges, repeated until every host that can be reached
has a score and no score changes by more than a stated share of itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmix.session import materialize

DAMPING = 0.85
TOLERANCE = 1e-7  # the largest change of a score in the last round, as a share of the score
MAX_DISTRUST = 0.75
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    return F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as ``rule, verdict``; of equally long ones a block, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(
            path, F.lit(rule.path)
        )
        line = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, line).otherwise(found)
    return found


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``src, dst, links`` between different hosts; relative links stay within a host."""
    href = "(?i)\\bhref\\s*=\\s*[\"']?((?:[a-z][a-z0-9+.-]*:)?//[^\"'\\s>]+)"
    links = pages.select(
        host_of(F.col(url)).alias("src"),
        F.explode(F.regexp_extract_all(F.col(html), F.lit(href), F.lit(1))).alias("link"),
    )
    absolute = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), "link")).otherwise(
        F.col("link")
    )
    ends = links.select("src", host_of(absolute).alias("dst"))
    real = ends.where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
    return real.groupBy("src", "dst").agg(F.count("*").alias("links"))


def spread_trust(
    seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE
) -> DataFrame:
    """``host, trust, distrust`` from ``seeds`` (``host, good, bad``) over ``edges``.

    Rounds go on until none changes a score by more than ``tolerance`` of itself, so a first score
    always brings another round: a share of distrust is as large far from the seeds as near them. There are
    about as many rounds as links on the longest way from a seed that is the shortest to its end, and
    then as many as cycles need for the damping to fall below the tolerance.

    Each round joins the hosts' scores with the edges and sums per host, and is written,
    so a lost executor costs only its own tasks. Sums combine before the shuffle.
    """
    out = edges.groupBy(F.col("src").alias("_s")).agg(F.sum("links").alias("_out"))
    into = edges.groupBy(F.col("dst").alias("_d")).agg(F.sum("links").alias("_in"))
    weighted = materialize(
        edges.join(out, F.col("src") == F.col("_s"))
        .join(into, F.col("dst") == F.col("_d"))
        .select(
            "src",
            "dst",
            (F.col("links") / F.col("_out")).alias("forward"),
            (F.col("links") / F.col("_in")).alias("backward"),
        ),
        "host_edges",
    )
    linked = weighted.select(F.explode(F.array("src", "dst")).alias("host")).distinct()
    start = materialize(
        linked.join(seeds, "host", "full").select(
            "host",
            F.coalesce("good", F.lit(0.0)).alias("good"),
            F.coalesce("bad", F.lit(0.0)).alias("bad"),
        ),
        "host_seeds",
    )
    share = F.lit(1 - damping)
    scores = start.select(
        "host", (share * F.col("good")).alias("trust"), (share * F.col("bad")).alias("distrust")
    )
    if weighted.isEmpty():
        return scores
    while True:
        forward = weighted.join(scores, F.col("src") == F.col("host")).select(
            F.col("dst").alias("host"),
            (F.col("forward") * F.col("trust")).alias("_t"),
            F.lit(0.0).alias("_d"),
        )
        backward = weighted.join(scores, F.col("dst") == F.col("host")).select(
            F.col("src").alias("host"),
            F.lit(0.0).alias("_t"),
            (F.col("backward") * F.col("distrust")).alias("_d"),
        )
        pushed = forward.unionByName(backward).groupBy("host").agg(
            F.sum("_t").alias("_t"), F.sum("_d").alias("_d")
        )
        new = start.join(pushed, "host", "left").select(
            "host",
            (share * F.col("good") + damping * F.coalesce("_t", F.lit(0.0))).alias("trust"),
            (share * F.col("bad") + damping * F.coalesce("_d", F.lit(0.0))).alias("distrust"),
        )
        # The scores of the round before are carried along, so that one look finds the change.
        old = scores.select("host", F.col("trust").alias("_trust"), F.col("distrust").alias("_distrust"))
        both = materialize(new.join(old, "host"), "host_scores")
        scores = both.select("host", "trust", "distrust")
        moving = (F.abs(F.col("trust") - F.col("_trust")) > tolerance * F.col("trust")) | (
            F.abs(F.col("distrust") - F.col("_distrust")) > tolerance * F.col("distrust")
        )
        if both.where(moving).isEmpty():
            return scores


def judge_pages(
    pages: DataFrame, rules: Sequence[Rule], max_distrust: float = MAX_DISTRUST, tolerance: float = TOLERANCE
) -> DataFrame:
    """``page_id, host, path, rule, verdict, distrust_share``, one row per row of ``pages``.

    A null url, or one without ``://``, has an empty host and path and is allowed unless a
    rule fits. A host's seeds are the shares of its pages that rules allow and block; a page
    without a rule is blocked if distrust is ``max_distrust`` or more of its host's scores.
    """
    ruled = pages.select(
        "page_id", host_of(F.col("url")).alias("_h"), path_of(F.col("url")).alias("_p")
    ).select(
        "page_id",
        F.coalesce("_h", F.lit("")).alias("host"),
        F.coalesce("_p", F.lit("")).alias("path"),
    )
    ruled = ruled.withColumn("_rule", longest_rule(F.col("host"), F.col("path"), rules))
    seeds = (
        ruled.where(F.col("host") != "")
        .groupBy("host")
        .agg(
            (F.count_if(F.col("_rule.verdict") == "allow") / F.count("*")).alias("good"),
            (F.count_if(F.col("_rule.verdict") == "block") / F.count("*")).alias("bad"),
        )
    )
    scores = spread_trust(seeds, host_edges(pages), tolerance=tolerance)
    both = F.col("trust") + F.col("distrust")
    share = scores.select("host", F.when(both > 0, F.round(F.col("distrust") / both, 9)).alias("_share"))
    verdict = F.when(F.col("_share") >= max_distrust, F.lit("block")).otherwise(F.lit("allow"))
    return ruled.join(share, "host", "left").select(
        "page_id",
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), verdict).alias("verdict"),
        F.coalesce("_share", F.lit(0.0)).alias("distrust_share"),
    )
