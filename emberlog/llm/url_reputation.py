"""URL filter by empirical-Bayes host reputation.

Labelled page outcomes are counted per host, registered domain and public suffix. Each level shrinks
its counts towards the posterior mean of the level above through a beta-binomial prior: the overall
rate is the prior of suffixes, a suffix's posterior that of its domains, a domain's posterior that of
its hosts. The strength of each level's prior is fitted to the labelled groups of that level by the
method of moments. A URL is blocked if the lower posterior bound of its host's bad rate is above a limit.

Explicit rules (host, path prefix) come first: a rule fits its host and all subdomains where the path
starts with the rule's path; the longest fitting rule wins.

Defined cases: a null URL, or one without ``://``, has an empty host and path and is judged by the
reputation of the empty host. Unlabelled hosts get their domain's reputation, unknown suffixes the
overall one. Without any label the prior rate is ``PRIOR_RATE``. Null labels do not count. Repeated
rows are judged one by one; a page with several label rows counts once per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.session import stored

# Rules as (host, path prefix, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# Public suffixes of two labels; every other suffix is the last label.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "org.uk")

PRIOR_RATE = 0.15
MIN_STRENGTH, MAX_STRENGTH = 2.0, 1000.0
MAX_BAD_RATE = 0.12
BOUND_SIGMAS = 1.64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column) -> Column:
    """Last label, or the last two where those are a known suffix; empty for a host without a dot and for addresses."""
    two = F.substring_index(host, ".", -2)
    last = F.when(host.contains(".") & ~host.rlike(r"^[0-9.:]+$|^\["), F.substring_index(host, ".", -1)).otherwise("")
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(last)


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix and one label more; the host itself where it has no suffix."""
    labels = F.when(suffix.contains("."), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))
    return F.when(suffix == "", host).otherwise(labels)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for h, p, _ in ordered]
    found = [F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")) for h, p, v in ordered]
    return reduce(lambda rest, pair: F.when(*pair).otherwise(rest), reversed(list(zip(fits, found))), F.lit(None).cast("struct<rule:string,verdict:string>"))


def _strength(groups: DataFrame, n: str, bad: str, prior: str) -> float:
    """Prior strength by moments: how far groups' counts scatter beyond binomial noise around their prior mean."""
    m, k = F.col(prior), F.col(n)
    scatter = F.sum((F.col(bad) - k * m) * (F.col(bad) - k * m) / (m * (1 - m)))
    found = groups.filter(k > 1).agg(scatter.alias("s"), F.sum(k).alias("n"), F.sum(k * (k - 1)).alias("pairs")).first()
    if not found["pairs"]:
        return MAX_STRENGTH
    correlation = (found["s"] - found["n"]) / found["pairs"]
    if correlation <= 1 / (MAX_STRENGTH + 1):
        return MAX_STRENGTH
    return round(max(MIN_STRENGTH, 1 / correlation - 1), 6)


def _shrunk(bad: Column, n: Column, prior: Column, strength: float) -> Column:
    return (bad + strength * prior) / (n + strength)


def reputations(outcomes: DataFrame) -> DataFrame:
    """``outcomes`` (host, bad: boolean or null) to one row per labelled host: counts, posterior mean and lower bound.

    One shuffle counts hosts; domains and suffixes are counted from host rows, so no key gathers more
    than its distinct hosts, summed on the map side.
    """
    hosts = outcomes.filter("bad IS NOT NULL").groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("k"))
    hosts = hosts.withColumn("suffix", suffix_of(F.col("host"))).withColumn("domain", domain_of(F.col("host"), F.col("suffix")))
    hosts = stored(hosts)
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("domain_n"), F.sum("k").alias("domain_k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("domain_n").alias("suffix_n"), F.sum("domain_k").alias("suffix_k"))
    rate = overall_rate(hosts)

    suffixes = suffixes.withColumn("root", F.lit(rate))
    suffixes = suffixes.withColumn("suffix_mean", _shrunk(F.col("suffix_k"), F.col("suffix_n"), F.col("root"), _strength(suffixes, "suffix_n", "suffix_k", "root")))
    domains = domains.join(suffixes, "suffix")
    domains = domains.withColumn("domain_mean", _shrunk(F.col("domain_k"), F.col("domain_n"), F.col("suffix_mean"), _strength(domains, "domain_n", "domain_k", "suffix_mean")))
    hosts = hosts.join(domains, ["suffix", "domain"])
    strength = _strength(hosts, "n", "k", "domain_mean")
    return hosts.withColumns({"host_mean": _shrunk(F.col("k"), F.col("n"), F.col("domain_mean"), strength), "strength": F.lit(strength)})


def overall_rate(hosts: DataFrame) -> float:
    """Bad rate over all labels, drawn a little towards ``PRIOR_RATE`` so that it is never 0 or 1."""
    n, k = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0))).first()
    return (k + 2 * PRIOR_RATE) / (n + 2)


def lower_bound(mean: Column, weight: Column, sigmas: float = BOUND_SIGMAS) -> Column:
    """Posterior mean less ``sigmas`` posterior standard deviations of a beta with that mean and total weight."""
    return mean - sigmas * F.sqrt(mean * (1 - mean) / (weight + 1))


def judge(pages: DataFrame, outcomes: DataFrame, url: str = "url", rules=RULES, max_bad_rate: float = MAX_BAD_RATE, sigmas: float = BOUND_SIGMAS) -> DataFrame:
    """``pages`` plus ``host, path, rule, verdict, bad_rate, bad_rate_low``; ``outcomes`` has (host, bad).

    Reputations are joined level by level from the narrow tables above; Spark broadcasts them where
    they are small and splits a hot host where they are not.
    """
    added = ["host", "path", "rule", "verdict", "bad_rate", "bad_rate_low"]
    if clash := set(added + ["url_suffix", "url_domain"]) & set(pages.columns):
        raise ValueError(f"reserved column names: {sorted(clash)}")
    known = stored(reputations(outcomes))
    rate = overall_rate(known)
    own = known.select(F.col("host").alias("h"), "host_mean", (F.col("n") + F.col("strength")).alias("weight"))
    by_domain = known.groupBy("suffix", "domain").agg(F.first("domain_mean").alias("domain_mean"), F.first("strength").alias("strength"))
    by_domain = by_domain.select(F.col("domain").alias("d"), F.col("suffix").alias("ds"), "domain_mean", "strength")
    by_suffix = known.groupBy("suffix").agg(F.first("suffix_mean").alias("suffix_mean")).withColumnRenamed("suffix", "s")

    hosts = pages.select(host_of(F.col(url)).alias("host")).distinct()
    hosts = hosts.withColumn("suffix", suffix_of(F.col("host"))).withColumn("domain", domain_of(F.col("host"), F.col("suffix")))
    hosts = hosts.join(own, F.col("host") == F.col("h"), "left").join(by_domain, (F.col("domain") == F.col("d")) & (F.col("suffix") == F.col("ds")), "left")
    hosts = hosts.join(by_suffix, F.col("suffix") == F.col("s"), "left")
    mean = F.coalesce("host_mean", "domain_mean", "suffix_mean", F.lit(rate))
    weight = F.coalesce("weight", "strength", F.lit(MIN_STRENGTH))
    # stored, so that the join below deals its rows anew and Spark can split a very common host
    scores = stored(hosts.select(F.col("host").alias("scored"), mean.alias("bad_rate"), lower_bound(mean, weight, sigmas).alias("bad_rate_low")))

    read = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    joined = read.join(scores, F.col("host") == F.col("scored"), "left").drop("scored")
    ruled = joined.withColumn("ruled", rule_for(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("ruled.verdict"), F.when(F.col("bad_rate_low") > max_bad_rate, "block").otherwise("allow"))
    return ruled.withColumns({"rule": F.col("ruled.rule"), "verdict": verdict}).select(*pages.columns, *added)
