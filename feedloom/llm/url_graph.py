"""URL filters: rules first, then trust and distrust that spread over the links between hosts."""

from __future__ import annotations

import math
import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.session import written

DAMPING = 0.85
#: Propagation ends when less than this share of the mass moves in a round.
TOLERANCE = 1e-3
#: A host is blocked when distrust makes up more than this share of all that speaks for and against it.
THRESHOLD = 0.5

#: Hosts of URLs in pages, with their ports and whatever else :func:`host_of` takes as part of a host.
URL_HOST = r"//([^/?#\s\"'<>&,;()|\\`{}]+)"
#: Names of hosts elsewhere in pages.
HOST_NAME = r"(?i)\b((?:[a-z0-9-]+\.)+[a-z]{2,})\b"


@dataclass(frozen=True)
class Rule:
    """``host`` and all its subdomains, for paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, A-Z as a-z; empty for null and without ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``rule`` and ``verdict`` of the longest rule that fits, null without one. Of equally long ones the first counts."""
    out = F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("verdict")))
    for r in sorted(rules, key=lambda r: -len(str(r))):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        out = out.when(fits, F.struct(F.lit(str(r)).alias("rule"), F.lit(r.verdict).alias("verdict")))
    return out


def host_links(pages: DataFrame) -> DataFrame:
    """``src``, ``dst`` and ``weight``: how many pages of one host name another host that has pages itself.

    ``pages`` has ``host`` and ``html``; a page counts once however often it names the host. Hosts in URLs are cut as
    :func:`host_of` does, and also without a mark that ends a sentence; in the rest of the page ASCII names count.
    """
    html = lower_ascii(F.col("html"))
    urls = F.regexp_extract_all(html, F.lit(URL_HOST), F.lit(1))
    ended = F.transform(urls, lambda u: F.regexp_replace(u, r"[.:!*]+$", ""))
    bare = F.regexp_extract_all(F.regexp_replace(html, URL_HOST, " "), F.lit(HOST_NAME), F.lit(1))
    names = F.array_distinct(F.concat(urls, ended, bare))
    named = pages.where("host != ''").select(F.col("host").alias("src"), F.explode(F.filter(names, lambda n: n != F.col("host"))).alias("dst"))
    known = pages.select(F.col("host").alias("dst")).distinct()
    return named.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight")).join(known, "dst", "left_semi")


def propagate(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int | None = None) -> DataFrame:
    """Personalised PageRank: ``host`` and ``rank`` from ``seeds`` (``host``, ``mass``) along ``src`` to ``dst``.

    In every round a host passes on ``damping`` of its rank by weight of its links; what is not passed on returns to
    the seeds, also from hosts without links. The total stays the mass of the seeds. Ranks are written to the shared
    folder each round; the driver sees two sums. Without seeds nobody has a rank.

    Rounds end when less than ``TOLERANCE`` of the mass moves. The mass that moves falls by ``damping`` in each, so at
    most 48 are needed at the default. With a number of ``rounds`` that is too small for that, it is an error.
    """
    if rounds is None:
        rounds = math.ceil(math.log(TOLERANCE / 2) / math.log(damping)) + 1
    total = seeds.agg(F.sum("mass")).first()[0]
    ranks = written(seeds.select("host", F.col("mass").cast("double").alias("rank")), "ranks")
    if not total:
        return ranks
    out = links.groupBy("src").agg(F.sum("weight").alias("out"))
    shares = written(links.join(out, "src").select("src", "dst", (F.col("weight") * damping / F.col("out")).alias("share")), "shares")
    for _ in range(rounds):
        moved = ranks.join(shares, ranks["host"] == shares["src"]).groupBy("dst").agg(F.sum(F.col("rank") * F.col("share")).alias("rank"))
        moved = written(moved.select(F.col("dst").alias("host"), "rank"), "moved")
        back = 1 - (moved.agg(F.sum("rank")).first()[0] or 0.0) / total
        new = moved.union(seeds.select("host", F.col("mass") * back)).groupBy("host").agg(F.sum("rank").alias("rank"))
        new = written(new, "ranks")
        change = new.union(ranks.select("host", -F.col("rank"))).groupBy("host").agg(F.abs(F.sum("rank")).alias("d"))
        ranks = new
        if change.agg(F.sum("d")).first()[0] <= TOLERANCE * total:
            return ranks
    raise RuntimeError(f"ranks still move by more than {TOLERANCE:g} of their mass after {rounds} rounds")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], threshold: float = THRESHOLD) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``trust`` and ``distrust`` for every row of ``pages``.

    A page that a rule fits has the rule's verdict. Hosts with allowed pages are trusted seeds, hosts with blocked
    ones blocked seeds, each by the number of such pages. Trust spreads along links, distrust against them: who names
    a blocked host is distrusted. Neither counts less than the host's own allowed or blocked pages. A host is blocked
    when its distrust is more than ``threshold`` of its trust, its distrust and the pages it has that no rule fits;
    all other pages are allowed, also those without a host.

    Null pages name nobody, repeated rows count and are judged each, other columns are not read. A table without rows
    gives none.
    """
    read = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    ruled = read.withColumn("m", matched_rule(F.col("host"), F.col("path"), rules))
    short = written(ruled.select("page_id", "host", "path", "m.rule", "m.verdict"), "urls")
    links = written(host_links(read), "links")
    counted = short.where("host != ''").groupBy("host").agg(
        *[F.count_if(F.col("verdict").eqNullSafe(v)).alias(n) for v, n in (("allow", "allowed"), ("block", "blocked"), (None, "open"))]
    )
    hosts = written(counted, "hosts")
    trust = propagate(links, hosts.where("allowed > 0").select("host", F.col("allowed").alias("mass")))
    against = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    distrust = propagate(against, hosts.where("blocked > 0").select("host", F.col("blocked").alias("mass")))
    scored = hosts.join(trust.withColumnRenamed("rank", "trust"), "host", "left")
    scored = scored.join(distrust.withColumnRenamed("rank", "distrust"), "host", "left").fillna(0.0, ["trust", "distrust"])
    # What a host's own pages say is not lost by passing it on.
    good, bad = F.greatest("trust", F.col("allowed").cast("double")), F.greatest("distrust", F.col("blocked").cast("double"))
    bad = bad > threshold * (good + bad + F.col("open"))
    scored = written(scored.select("host", "trust", "distrust", F.when(bad, "block").otherwise("allow").alias("of_host")), "scores")
    judged = short.join(scored, "host", "left")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "of_host", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
