"""URL filters: rules for hosts and paths, and trust propagated along links for all other pages.

Pages that a rule allows or blocks make their hosts seeds. Two walks with restart run
over the host graph at once: trust follows edges from trusted seeds (personalised
PageRank), distrust follows them backwards from blocked seeds, to those that link to
blocked hosts. Edges are hyperlinks between hosts, by their number, and the ties
between a host and its parent domain, down to two labels. Seeds count pages, so a host
that nothing links to keeps 1 - FOLLOW for each of its seed pages. A host is blocked
if its distrust exceeds its trust and is no less than it would be if a given share of
its pages were blocked and nothing came in.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkvec.llm.common import A_TO_Z
from walkvec.stage import stage


class UrlRule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed values of the query's contract.
RULES = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)
FOLLOW = 0.85
ROUNDS = 16
ROUNDS_PER_TABLE = 4
BLOCKED_SHARE = 0.5
_LINK = r"""[hH][rR][eE][fF]\s*=\s*["']?(?:[hH][tT][tT][pP][sS]?:)?//([^/?#"'\s>]+)"""


def _lower(c: Column) -> Column:
    return F.translate(c, A_TO_Z, A_TO_Z.lower())


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty for a null url and one without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.concat(F.lit("x"), url), "://", 1))
    after = F.substr(url, F.length(rest) - 1 + F.lit(4))
    after = F.coalesce(F.when(rest.isNotNull(), after), F.lit(""))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(after, F.length(host) + 1), r"^[^?#]*", 0)
    return _lower(host), path


def suffixes(host: Column) -> Column:
    """A host and the domains above it: a.b.c, b.c, c."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels)))
    )


def fitting_rule(host: str, path: str, rules: Sequence[UrlRule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls; ties go to the lesser text."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Later conditions are tested first, so go from short to long.
    for rule in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):
        fits = (F.col(host) == rule.host) | F.endswith(F.col(host), F.lit("." + rule.host))
        fits = fits & F.startswith(F.col(path), F.lit(rule.path))
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, weight): hyperlinks between hosts, and ties of hosts to their parents both ways.

    ``pages`` has host and html, ``hosts`` has host.
    """
    links = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("dst"))
    links = links.select("src", _lower(F.col("dst")).alias("dst")).where("src <> '' and dst <> '' and src <> dst")
    links = links.groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    known = hosts.select("host").unionByName(links.select(F.col("dst").alias("host"))).distinct()
    chain = F.filter(suffixes(F.col("host")), lambda s: F.instr(s, ".") > 0)
    ties = (
        known.where(F.size(chain) > 1)
        .select(F.explode(F.arrays_zip(F.slice(chain, F.lit(1), F.size(chain) - 1).alias("src"), F.slice(chain, F.lit(2), F.size(chain) - 1).alias("dst"))).alias("t"))
        .select("t.src", "t.dst")
        .distinct()
    )
    both = ties.unionByName(ties.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    all_edges = links.unionByName(both.withColumn("weight", F.lit(1.0)))
    return all_edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, follow: float = FOLLOW, rounds: int = ROUNDS) -> DataFrame:
    """(kind, node, score) after ``rounds`` steps: trust along edges, distrust against them.

    ``seeds`` has kind (trust or distrust), node and score. A step passes ``follow`` of
    a node's score on, by weight, and gives the rest back to the seeds; what is left
    after r steps is below follow^r of the seeds. Each step is one join and one
    aggregation; every few steps the scores are written out.
    """
    ways = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    sums = ways.groupBy("kind", "src").agg(F.sum("weight").alias("all"))
    moves = stage(
        ways.join(sums, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("all")).alias("part")),
        "moves",
    )
    restart = stage(seeds.select("kind", "node", (F.col("score") * F.lit(1 - follow)).alias("score")), "seeds")
    scores = seeds.select("kind", "node", "score")
    for step in range(rounds):
        passed = scores.select("kind", F.col("node").alias("src"), "score").join(moves, ["kind", "src"])
        passed = passed.select("kind", F.col("dst").alias("node"), (F.col("score") * F.col("part") * F.lit(follow)).alias("score"))
        scores = passed.unionByName(restart).groupBy("kind", "node").agg(F.sum("score").alias("score"))
        if step % ROUNDS_PER_TABLE == ROUNDS_PER_TABLE - 1 or step == rounds - 1:
            scores = stage(scores, "scores")
    return scores


def judged_pages(pages: DataFrame, rules: Sequence[UrlRule] = RULES, share: float = BLOCKED_SHARE) -> DataFrame:
    """Every page with host, path, the rule that fits, and a verdict: the rule's, else its host's.

    ``pages`` has page_id, url and html; other columns are ignored. A page without a
    host, or on a host that no seed reaches, is allowed. Null html has no links.
    Repeated rows count as pages of their own; an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    named = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    text, verdict = fitting_rule("host", "path", rules)
    ruled = stage(named.select("page_id", "host", "path", text.alias("rule"), verdict.alias("ruled")), "ruled")

    hosts = stage(
        ruled.where("host <> ''")
        .groupBy("host")
        .agg(
            F.count("*").alias("pages"),
            F.count(F.when(F.col("ruled") == "allow", 1)).cast("double").alias("trust"),
            F.count(F.when(F.col("ruled") == "block", 1)).cast("double").alias("distrust"),
        ),
        "hosts",
    )
    edges = stage(host_edges(named, hosts), "edges")
    each = F.explode(
        F.array(
            F.struct(F.lit("trust").alias("kind"), F.col("trust").alias("score")),
            F.struct(F.lit("distrust").alias("kind"), F.col("distrust").alias("score")),
        )
    )
    seeds = hosts.select(F.col("host").alias("node"), each.alias("s")).select("s.kind", "node", "s.score").where("score > 0")
    scores = propagate(edges, seeds)
    by_host = scores.groupBy(F.col("node").alias("_host")).agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(F.lit(0.0))).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(F.lit(0.0))).alias("distrust"),
    )
    sizes = hosts.select(F.col("host").alias("_host"), "pages")
    # Rounded, so that sums in another order give the same verdicts.
    judged = stage(
        sizes.join(by_host, "_host", "left").select(
            "_host",
            F.round(F.coalesce("trust", F.lit(0.0)), 9).alias("trust"),
            F.round(F.coalesce("distrust", F.lit(0.0)), 9).alias("distrust"),
            "pages",
        ),
        "judged",
    )
    bad = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= F.lit(share * (1 - FOLLOW)) * F.col("pages"))
    own = F.when(F.coalesce(bad, F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return ruled.join(judged, F.col("host") == F.col("_host"), "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", own).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
