"""URL filter: empirical-Bayes reputation of hosts, with rules that come first.

Labelled page outcomes (1 good, 0 bad) are counted by host, registered domain and public
suffix. Each level's rate is shrunk towards that of the level above by a beta-binomial
prior: the suffix towards all pages, the domain towards its suffix, the host towards its
domain. How strong a prior is follows from how much the rates at that level really differ,
by the method of moments. A host is blocked if the upper bound of its rate's posterior is under the
rate of all pages: little evidence leaves the bound high, so a host is blocked for what is known of it.

DataFrame functions only. Counts shrink before the shuffle, so a host with a third of all
pages is one row per task; three single aggregate rows go to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.session import cut_lineage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Second-level names under which registries sell names, below two-letter suffixes.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


class Rule(NamedTuple):
    """Allows or blocks a host with its subdomains where the url's path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


class Bound(NamedTuple):
    """Block where mean + ``z`` deviations of the posterior is under ``share`` of the rate of all pages; a prior counts for so many pages."""

    share: float = 1.0
    z: float = 1.645
    weakest: float = 1.0
    strongest: float = 20.0


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def registered_domain(host: Column) -> Column:
    """The last two labels, or three under a registry's second level; an address of digits is its own domain."""
    name = F.regexp_replace(host, r"^.*@|\.?:[0-9]*$|\.$", "")
    third = r"([^.]+\.(?:" + "|".join(SECOND_LEVEL) + r")\.[a-z]{2})$"
    longer = F.regexp_extract(name, third, 1)
    shorter = F.substring_index(name, ".", -2)
    return F.when(name.rlike(r"^[0-9.]+$"), name).when(longer != "", longer).otherwise(shorter)


def public_suffix(domain: Column) -> Column:
    """The registered domain without its first label; itself if it has one label or is an address."""
    rest = F.regexp_extract(domain, r"^[^.]+\.(.+)$", 1)
    return F.when(domain.rlike(r"^[0-9.]+$") | (rest == ""), domain).otherwise(rest)


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``; null if none does.

    Of two rules with the same length that with the longer host wins, and a repeated rule counts as
    its blocking form. Rules are a list given by hand: they are part of the plan.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.verdict == "block")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _strength(level: DataFrame, bound: Bound) -> float:
    """The prior's weight in pages, from rows (n, good, prior): the spread of rates beyond that of counting."""
    p, m, n = F.col("good") / F.col("n"), F.col("prior"), F.col("n")
    noise = m * (1 - m)
    row = level.agg(
        F.sum(n * (p - m) * (p - m) - noise).alias("extra"), F.sum((n - 1) * noise).alias("scale")
    ).first()
    if not row["scale"] or row["extra"] is None:
        return bound.strongest
    spread = min(max(row["extra"] / row["scale"], 1 / (1 + bound.strongest)), 1 / (1 + bound.weakest))
    return 1 / spread - 1


def host_reputation(outcomes: DataFrame, hosts: DataFrame, bound: Bound = Bound()) -> DataFrame:
    """The posterior of each host: ``host, domain, suffix, n, good, mean, upper, blocked``.

    A host is blocked if even the upper bound of its rate is under that of all pages.

    ``outcomes`` has a ``host`` and an ``outcome`` of 0 or 1 per labelled page (null: not counted) and
    ``hosts`` the hosts to judge, without repeats. A host without outcomes has its domain's rate, a domain
    without any its suffix's, a suffix without any that of all pages, which is 1/2 if there are none at all.
    """
    spark = outcomes.sparkSession
    counted = (
        outcomes.where(F.col("outcome").isNotNull()).groupBy("host")
        .agg(F.count("*").alias("n"), F.sum((F.col("outcome") > 0).cast("bigint")).alias("good"))
    )
    zero = F.lit(0).cast("bigint")
    by_host = cut_lineage(
        spark,
        hosts.select("host").join(counted, "host", "left")
        .select("host", F.coalesce("n", zero).alias("n"), F.coalesce("good", zero).alias("good"))
        .withColumn("domain", registered_domain(F.col("host")))
        .withColumn("suffix", public_suffix(F.col("domain"))),
        "reputation",
    )

    def above(*keys: str) -> DataFrame:
        return by_host.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))

    def strength(level: DataFrame) -> Column:
        return F.lit(_strength(level.where("n > 0"), bound))

    def others(kappa: Column) -> Column:
        """The rate above, without the pages of the one below: its own are counted once, in its own row."""
        return (F.col("all_good") - F.col("good") + kappa * F.col("prior")) / (F.col("all_n") - F.col("n") + kappa)

    def whole(level: DataFrame) -> DataFrame:
        return level.withColumnsRenamed({"n": "all_n", "good": "all_good"})

    total = by_host.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = ((total["good"] or 0) + 1) / ((total["n"] or 0) + 2)
    suffixes = above("suffix").withColumn("prior", F.lit(overall))
    domains = above("suffix", "domain").join(whole(suffixes), "suffix").withColumn("prior", others(strength(suffixes)))
    domains = domains.select("domain", "n", "good", "prior")
    judged = by_host.join(whole(domains), "domain").withColumn("prior", others(strength(domains)))
    kappa = strength(judged)
    hosts_left = judged.withColumns({"mean": (F.col("good") + kappa * F.col("prior")) / (F.col("n") + kappa), "kappa": kappa})
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("kappa") + 1))
    upper = F.col("mean") + F.lit(bound.z) * deviation
    return hosts_left.select(
        "host", "domain", "suffix", "n", "good", "mean", upper.alias("upper"), (upper < F.lit(bound.share * overall)).alias("blocked")
    )


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = (), id_column: str = "page_id", url: str = "url",
    label_id: str = "doc_id", label: str = "quality", bound: Bound = Bound(),
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, and its host's n, mean and upper bound.

    ``labels`` has outcomes by page id; several for one page all count, those without a page do not, nor do
    null ids or labels. A null url, or one without ``://``, has an empty host, which is judged as one host.
    Repeated pages are judged, and their outcomes counted, one by one. Only the named columns are read.
    """
    parts = pages.select(F.col(id_column), url_host(F.col(url)).alias("_host"), url_path(F.col(url)).alias("_path"))
    outcome = labels.where(F.col(label_id).isNotNull() & F.col(label).isNotNull()).select(
        F.col(label_id).alias("_id"), F.col(label).alias("outcome")
    )
    outcomes = parts.join(outcome, F.col(id_column) == F.col("_id")).select(F.col("_host").alias("host"), "outcome")
    known = host_reputation(outcomes, parts.select(F.col("_host").alias("host")).distinct(), bound)
    rule = best_rule(F.col("_host"), F.col("_path"), rules)
    by_method = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return (
        parts.withColumn("_rule", rule)
        .join(known.select("host", "n", "mean", "upper", "blocked"), F.col("_host") == F.col("host"))
        .select(
            F.col(id_column), "host", F.col("_path").alias("path"), F.col("_rule.rule").alias("rule"),
            F.coalesce(F.col("_rule.verdict"), by_method).alias("verdict"), "n", "mean", "upper",
        )
    )
