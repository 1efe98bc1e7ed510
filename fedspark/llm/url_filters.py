"""URL filters: listed rules first, then an empirical-Bayes reputation of the host."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased; path: from there up to ?, # or
    the end. Both are empty for a null url and for one without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def suffix_and_domain(host: Column) -> tuple[Column, Column]:
    """Public suffix and registered domain of a host; a host of a suffix alone is its own domain."""
    two = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    suffix = F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.regexp_extract(host, r"([^.]*)$", 1))
    three = F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    domain = F.when(two.isin(*TWO_LABEL_SUFFIXES), F.when(three != "", three).otherwise(host)).otherwise(F.when(two != "", two).otherwise(host))
    return suffix, domain


def _fits(rule: str, host: Column, path: Column) -> Column:
    name, slash, rest = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def _strength(level: DataFrame, least: float, most: float) -> tuple[float, float]:
    """Mean and prior strength of the rates of a level's groups (columns n, bad) by moments. Sums over one
    row a group; one row of four numbers comes back."""
    s = level.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("bb")).first()
    if not s["n"]:
        return 0.0, most
    n, k = float(s["n"]), s["k"]
    mean = s["bad"] / n
    spread = s["bb"] - n * mean * mean
    room = n - s["nn"] / n - (k - 1)
    if mean in (0.0, 1.0) or room <= 0:
        return mean, most
    share = (spread / (mean * (1 - mean)) - (k - 1)) / room
    return mean, most if share <= 0 else min(most, max(least, 1 / share - 1))


def reputation(outcomes: DataFrame, least: float = 1.0, most: float = 1000.0) -> DataFrame:
    """host, mean, sd of the posterior rate of bad pages, for hosts with labelled pages and, with a null
    host, for each domain and suffix that has any. outcomes: host, bad (0 or 1) for each labelled page.

    The rate of a suffix is shrunk to the rate of all pages, that of a domain to its suffix's, that of a
    host to its domain's, each by a beta prior whose strength comes from the spread at that level.
    """
    suffix, domain = suffix_and_domain(F.col("host"))
    hosts = outcomes.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")).select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    mean, s1 = _strength(suffixes, least, most)
    _, s2 = _strength(domains, least, most)
    _, s3 = _strength(hosts, least, most)

    def shrunk(n: str, bad: str, prior: Column, strength: float) -> Column:
        return (F.col(bad) + prior * strength) / (F.col(n) + strength)

    def sd(rate: Column, n: Column, strength: float) -> Column:
        return F.sqrt(rate * (1 - rate) / (n + strength + 1))

    a = suffixes.select("suffix", shrunk("n", "bad", F.lit(mean), s1).alias("a_mean"), F.col("n").alias("a_n"))
    b = domains.join(a, "suffix").select("suffix", "domain", "a_mean", shrunk("n", "bad", F.col("a_mean"), s2).alias("b_mean"), F.col("n").alias("b_n"))
    c = hosts.join(b.select("domain", "b_mean"), "domain").select("suffix", "domain", "host", shrunk("n", "bad", F.col("b_mean"), s3).alias("mean"), "n")
    none = F.lit(None).cast("string")
    out = c.select("suffix", "domain", "host", "mean", sd(F.col("mean"), F.col("n"), s3).alias("sd"))
    out = out.union(b.select("suffix", "domain", none, "b_mean", sd(F.col("b_mean"), F.col("b_n"), s2)))
    return out.union(a.select("suffix", none, none, "a_mean", sd(F.col("a_mean"), F.col("a_n"), s1)))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]], z: float = 1.645, max_bad: float = 0.5, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict for each page.

    rules: (allow or block, host with path prefix); the longest rule that fits decides. Else a page is
    blocked if the posterior mean less z deviations of its host's bad rate is over max_bad; a host
    without labelled pages is judged by its domain, then its suffix, then allowed. outcomes: page_id, bad
    (0 or 1); null ids or outcomes are ignored, of several for a page the worst counts. A null url has an
    empty host and path and is judged like any host; repeated rows come out repeated.
    """
    host, path = host_and_path(F.col(url))
    seen = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    suffix, domain = suffix_and_domain(F.col("host"))
    seen = seen.select("*", suffix.alias("suffix"), domain.alias("domain"))
    labelled = outcomes.select(F.col(page_id).alias("__id"), F.col("bad").alias("bad")).dropna().groupBy("__id").agg(F.max("bad").alias("bad"))
    rates = reputation(seen.join(labelled, F.col("page_id") == F.col("__id")).select("host", "bad"))
    bound = F.col("mean") - z * F.col("sd") > max_bad
    by_host = rates.where("host is not null").select(F.col("host").alias("h"), bound.alias("h_bad"))
    by_domain = rates.where("host is null and domain is not null").select(F.col("domain").alias("d"), bound.alias("d_bad"))
    by_suffix = rates.where("domain is null").select(F.col("suffix").alias("s"), bound.alias("s_bad"))
    hosts = seen.select("host", "domain", "suffix").distinct()
    judged = hosts.join(by_host, F.col("host") == F.col("h"), "left").join(by_domain, F.col("domain") == F.col("d"), "left").join(by_suffix, F.col("suffix") == F.col("s"), "left")
    judged = judged.select(F.col("host").alias("__host"), F.coalesce("h_bad", "d_bad", "s_bad", F.lit(False)).alias("__bad"))
    rule = kind = F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda x: (len(x[1]), x[1])):
        fits = _fits(text, F.col("host"), F.col("path"))
        rule, kind = F.when(fits, text).otherwise(rule), F.when(fits, verdict).otherwise(kind)
    out = seen.join(judged, F.col("host") == F.col("__host"), "left")
    verdict = F.coalesce(kind, F.when(F.col("__bad"), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
