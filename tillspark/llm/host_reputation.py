"""Host reputation by empirical Bayes: shrunken rates of bad pages, and rules for hosts and paths.

Labelled page outcomes (good or bad) are summed per host.  A host's rate of bad
pages is shrunk towards that of its registered domain, a domain's towards that
of its suffix, a suffix's towards the overall rate, each through a beta-binomial
prior.  The strength of a level's prior, the number of pages it weighs as much
as, is estimated from how much the rates of that level differ from their
parents' beyond what chance explains (method of moments).  A page is blocked if
the lower bound of its host's posterior rate exceeds a limit.

A missing host has the empty text as host, domain and suffix.  Hosts without a
label take their domain's posterior, or the next level's that has labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.llm.tables import stored

#: Suffixes of two labels under which domains are registered.
TWO_LABEL_SUFFIXES = ["ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "org.au", "org.uk"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The share of bad pages over which a host is blocked, and the width of the bound in standard deviations.
LIMIT, WIDTH = 0.5, 1.645
#: Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 1000.0


def host(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix(host: Column) -> Column:
    """Public suffix: the last label, or the last two where those are a registered pair."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain(host: Column) -> Column:
    """Registered domain: the suffix and the label before it."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def _strength(level: DataFrame, rate: str) -> float:
    """Prior strength for one level: ``n`` pages and ``bad`` of them per group, expected ``rate`` from the parent.

    Over groups, the squared error of the rate is p(1-p) (1/n + (1 - 1/n) r) for
    a share r of variance between groups; strength is 1/r - 1.  Without
    labels, or without variance, the prior is as strong as allowed.
    """
    p, n = F.col(rate), F.col("n")
    row = level.filter(n > 1).agg(
        F.sum(n * F.pow(F.col("bad") / n - p, 2)).alias("error"),
        F.sum(p * (1 - p)).alias("chance"),
        F.sum((n - 1) * p * (1 - p)).alias("between"),
    ).first()
    if not row["between"]:
        return STRONGEST
    share = (row["error"] - row["chance"]) / row["between"]
    return min(STRONGEST, max(WEAKEST, 1 / share - 1)) if share > 0 else STRONGEST


def reputations(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row per host of ``pages`` (page_id, url): posterior of the rate of bad pages and its lower bound.

    ``outcomes`` has page_id and bad (0 or 1); rows with a null in either, and
    outcomes of pages that are not there, count for nothing.  A page_id that
    comes several times, in either table, counts with each pair.
    """
    known = outcomes.select(F.col("page_id").alias("_id"), F.col("bad").cast("double").alias("_bad")).dropna()
    known = known.groupBy("_id").agg(F.count(F.lit(1)).alias("_n"), F.sum("_bad").alias("_bad"))
    judged = pages.select("page_id", host(F.col("url")).alias("host")).join(known, F.col("page_id") == F.col("_id"), "left")
    hosts = judged.groupBy("host").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("double").alias("n"), F.coalesce(F.sum("_bad"), F.lit(0.0)).alias("bad")
    )
    # Every level is summed from the hosts, several times over: the pages are read once.
    hosts = stored(hosts.withColumns({"domain": domain(F.col("host")), "suffix": suffix(F.col("host"))}), "hosts")

    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    total = hosts.agg(*sums).first()
    overall = ((total["bad"] or 0.0) + 1) / ((total["n"] or 0.0) + 2)

    def level(rows: DataFrame, strength: float, name: str) -> DataFrame:
        shrunk = (F.col("bad") + strength * F.col("prior")) / (F.col("n") + strength)
        return rows.withColumns({name: shrunk, f"{name}_weight": F.col("n") + strength})

    suffixes = hosts.groupBy("suffix").agg(*sums).withColumn("prior", F.lit(overall))
    suffixes = level(suffixes, _strength(suffixes, "prior"), "suffix_rate").select("suffix", F.col("suffix_rate").alias("prior"))
    domains = hosts.groupBy("suffix", "domain").agg(*sums).join(suffixes, "suffix")
    domains = level(domains, _strength(domains, "prior"), "domain_rate").select("domain", F.col("domain_rate").alias("prior"))
    hosts = hosts.join(domains, "domain")
    rated = level(hosts, _strength(hosts, "prior"), "rate")
    rate, weight = F.col("rate"), F.col("rate_weight")
    return rated.select(
        "host", "domain", "suffix", "n", "bad", "rate",
        F.greatest(rate - WIDTH * F.sqrt(rate * (1 - rate) / (weight + 1)), F.lit(0.0)).alias("lower"),
    )


def rules_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Per host the rules (rule, verdict) that fit it or a domain above it, as ``rules`` array.

    A rule is a host and a path in one text, divided at its first ``/``.
    """
    parts = F.split(F.col("host"), r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))
    given = rules.select(
        F.substring_index("rule", "/", 1).alias("_at"),
        F.struct(
            F.length("rule").alias("length"), F.col("rule"), F.expr("substr(rule, instr(rule, '/'))").alias("path"), F.col("verdict")
        ).alias("_rule"),
    )
    fits = hosts.select("host", F.explode(above).alias("_at")).join(given, "_at")
    return fits.groupBy("host").agg(F.sort_array(F.collect_list("_rule"), asc=False).alias("rules"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: DataFrame, limit: float = LIMIT) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, the host's rate and its bound.

    The longest rule that fits decides; without one, a page is blocked if the
    bound of its host's rate exceeds ``limit``.
    """
    rated = reputations(pages, outcomes)
    by_host = rated.join(rules_by_host(rated.select("host"), rules), "host", "left").select("host", "rate", "lower", "rules")
    # Written, so that pages meet it in a join of its own, whose hot hosts the adaptive planner can split.
    by_host = stored(by_host, "host-reputations")
    rows = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    fit = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    return (
        rows.join(by_host, "host")
        .withColumn("_fit", F.get(fit, F.lit(0)))
        .select(
            "page_id", "host", "path", F.col("_fit.rule").alias("rule"),
            F.coalesce(F.col("_fit.verdict"), F.when(F.col("lower") > limit, "block").otherwise("allow")).alias("verdict"),
            "rate", "lower",
        )
    )
