"""URL filters: fixed rules, and host reputation by empirical Bayes for pages no rule decides.

Pages with a known outcome (good or bad) are counted per host. A host's rate of bad pages is shrunk
towards that of its registered domain, the domain's towards that of its suffix, the suffix's towards
that of all pages: each level has a beta prior whose mean is the parent's posterior mean and whose
strength is fitted to the level's own spread by the method of moments of the beta-binomial. A page
is blocked if the lower bound of its host's posterior reaches MAX_BAD. Only built-in functions are used.

The bound is the posterior mean less Z posterior standard deviations. In ``judged_pages`` the pages
that a rule decides are the labelled ones; ``host_reputation`` takes any outcomes.

Defined cases: a missing url or one without ``://`` has an empty host and path, fits no rule and is
judged by the reputation of the empty host; without any outcome every page is allowed; repeated rows
are judged alike; other columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.joins import lookup_join
from tidemark.llm.common import lower_ascii, stored

# Host, start of the path, verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
# Suffixes of more than one label under which names are registered; any other is the last label.
SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "gov.uk", "org.uk")
MAX_BAD = 0.5
Z = 1.645
LEAST_SPREAD, MOST_SPREAD = 0.01, 0.9  # of the correlation within a group; its strength is 1 / rho - 1


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) as the contract cuts them."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, F.lit("://"))
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return lower_ascii(raw), path


def _by_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], value) -> Column:  # noqa: ANN001
    """``value`` of the longest rule that fits, else null."""
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = lambda h, p: ((host == h) | host.endswith("." + h)) & path.startswith(p)
    return F.coalesce(*(F.when(fits(h, p), F.lit(value(h, p, v))) for h, p, v in ordered), F.lit(None).cast("string"))


def parsed_pages(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict); the last two are null where no rule fits."""
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    return parts.select(
        "page_id", "host", "path",
        _by_rule(F.col("host"), F.col("path"), rules, lambda h, p, v: h + p).alias("rule"),
        _by_rule(F.col("host"), F.col("path"), rules, lambda h, p, v: v).alias("verdict"),
    )


def bare_host(host: Column) -> Column:
    """The name a host has in the hierarchy: without user part, port and dots at its end."""
    named = F.regexp_replace(host, "^.*@", "")
    return F.regexp_replace(F.regexp_replace(named, ":[0-9]*$", ""), r"\.+$", "")


def with_levels(hosts: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Adds ``domain`` (registered) and ``suffix`` of ``host``; an address is its own domain and suffix.

    ``suffixes`` are those of several labels, as a list of public suffixes has them.
    """
    bare = bare_host(F.col("host"))
    two = F.substring_index(bare, ".", -2)
    address = bare.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$") | bare.startswith("[")
    long = two.isin(list(suffixes)) & (F.size(F.split(bare, r"\.")) > 2) if suffixes else F.lit(False)
    return hosts.withColumns({
        "suffix": F.when(address, bare).when(long, two).otherwise(F.substring_index(bare, ".", -1)),
        "domain": F.when(address, bare).when(long, F.substring_index(bare, ".", -3)).otherwise(two),
    })


def _strength(groups: DataFrame, mean: str) -> float:
    """Pseudo-counts of the level's prior: spread beyond the binomial, by the method of moments."""
    n, k, m = F.col("n"), F.col("bad"), F.col(mean)
    row = groups.agg(
        F.sum((k - n * m) * (k - n * m)).alias("seen"),
        F.sum(n * m * (1 - m)).alias("binomial"),
        F.sum(n * (n - 1) * m * (1 - m)).alias("pairs"),
    ).first()
    rho = (row["seen"] - row["binomial"]) / row["pairs"] if row["pairs"] else LEAST_SPREAD
    return 1 / min(max(rho, LEAST_SPREAD), MOST_SPREAD) - 1


def _posterior(groups: DataFrame, prior: str, strength: float, name: str) -> DataFrame:
    return groups.withColumn(name, (F.col("bad") + strength * F.col(prior)) / (F.col("n") + strength))


def host_reputation(hosts: DataFrame, suffixes: Sequence[str] = SUFFIXES, z: float = Z) -> DataFrame:
    """(host, n, bad, rate, bound) from counts per host (host, n, bad); ``n`` may be 0."""
    hosts = with_levels(hosts, suffixes)
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    total = hosts.agg(*sums).first()
    overall = ((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2)
    by_domain = hosts.groupBy("suffix", "domain").agg(*sums)
    by_suffix = by_domain.groupBy("suffix").agg(*sums).withColumn("overall", F.lit(overall))
    by_suffix = _posterior(by_suffix, "overall", _strength(by_suffix, "overall"), "suffix_rate")
    domains = lookup_join(by_domain, by_suffix.select("suffix", "suffix_rate"), "suffix")
    domains = _posterior(domains, "suffix_rate", _strength(domains, "suffix_rate"), "domain_rate")
    placed = lookup_join(hosts.drop("suffix"), domains.select("domain", "domain_rate"), "domain")
    strength = _strength(placed, "domain_rate")
    rated = _posterior(placed, "domain_rate", strength, "rate")
    rate, size = F.col("rate"), F.col("n") + strength
    return rated.select("host", "n", "bad", "rate", (rate - z * F.sqrt(rate * (1 - rate) / (size + 1))).alias("bound"))


def judged_pages(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    suffixes: Sequence[str] = SUFFIXES,
    max_bad: float = MAX_BAD,
    z: float = Z,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, host_outcomes, host_blocked): one row per page."""
    parsed = parsed_pages(pages, rules)
    hosts = stored(
        parsed.groupBy("host").agg(
            F.count("verdict").alias("n"), F.count_if(F.col("verdict") == "block").alias("bad")),
        "url-hosts",
    )
    known = host_reputation(hosts, suffixes, z).select(
        "host", F.col("n").alias("host_outcomes"), F.col("bad").alias("host_blocked"),
        F.when(F.col("bound") >= max_bad, "block").otherwise("allow").alias("opinion"),
    )
    return lookup_join(parsed, known, "host").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "opinion").alias("verdict"),
        "host_outcomes", "host_blocked")
