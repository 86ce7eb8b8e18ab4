"""URL filter by explicit rules and by an empirical-Bayes reputation of hosts.

Labelled page outcomes (good or bad) are counted by host. A host's rate is shrunk towards the rate of its
registered domain, that one towards its suffix, that one towards the rate of all pages: each level is a
beta-binomial whose prior mean is the posterior mean of the level above and whose prior strength is fitted by
moments to the units of the level. A host passes if the lower bound of its posterior rate reaches a threshold.
Everything is DataFrame expressions; counts are combined before each shuffle, so a hot host sends one row a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import lower_ascii

#: Public suffixes of two labels, of countries and of hosting services; every other suffix is taken as
#: one label. The default of a parameter, and what the query's SQL reads too.
LONG_SUFFIXES = (
    "ac.jp", "ac.uk", "blogspot.com", "co.id", "co.il", "co.in", "co.jp", "co.kr", "co.nz", "co.th", "co.uk", "co.za",
    "com.ar", "com.au", "com.bd", "com.br", "com.cn", "com.co", "com.eg", "com.hk", "com.mx", "com.my", "com.ng", "com.pe",
    "com.ph", "com.pk", "com.pl", "com.sa", "com.sg", "com.tr", "com.tw", "com.ua", "com.ve", "com.vn", "edu.au", "edu.cn",
    "github.io", "gitlab.io", "go.jp", "gob.mx", "gov.au", "gov.br", "gov.cn", "gov.in", "gov.uk", "herokuapp.com", "ne.jp",
    "net.au", "net.br", "net.cn", "netlify.app", "nhs.uk", "or.jp", "or.kr", "org.au", "org.br", "org.cn", "org.mx", "org.uk",
    "org.za", "pages.dev", "sch.uk", "vercel.app", "web.app", "wordpress.com",
)


@dataclass(frozen=True)
class Rule:
    """`verdict` for the host and its subdomains where the path starts with `path`."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Settings:
    #: Least lower bound of a host's good rate.
    threshold: float = 0.6
    #: Standard deviations between the posterior mean and its bound.
    z: float = 1.645
    #: Bounds of the fitted share of variance between units; its inverse is the prior's strength.
    least_rho: float = 0.001
    most_rho: float = 0.9
    long_suffixes: Sequence[str] = field(default=LONG_SUFFIXES)


def host_of(url) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    return lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def first_rule(rules: Sequence[Rule], host: Column, path: Column, value) -> Column:
    """`value(rule)` of the longest rule that fits, else null. The rules become part of the plan, so they are a
    list of some hundreds at most. Of two of one length the one with the longer host wins."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host))):
        on_host = (host == rule.host) | host.endswith("." + rule.host)
        found = F.when(on_host & path.startswith(rule.path), F.lit(value(rule))).otherwise(found)
    return found


def levels(host: Column, settings: Settings) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, without user and port. An IPv4 address is its own domain."""
    bare = F.regexp_extract(host, r"^(?:[^@]*@)?([^:]*)", 1)
    two = F.substring_index(bare, ".", -2)
    long = two.isin(*settings.long_suffixes)
    suffix = F.when(long, two).otherwise(F.substring_index(bare, ".", -1))
    domain = F.when(bare.rlike(r"^[0-9]+(\.[0-9]+){3}$"), bare).when(long, F.substring_index(bare, ".", -3))
    return domain.otherwise(two), suffix


def _strength(counts: DataFrame, settings: Settings) -> DataFrame:
    """One row: the pooled rate and the prior strength that moments give for these units (good, n)."""
    y, n = F.col("good").cast("double"), F.col("n").cast("double")
    sums = counts.where("n > 0").agg(
        F.sum("good").cast("double").alias("y"),
        F.sum("n").cast("double").alias("m"),
        F.count(F.lit(1)).cast("double").alias("k"),
        F.sum(F.col("n") * F.col("n")).cast("double").alias("nn"),
        F.sum(y * y / n).alias("yy"),
    )
    rate = F.coalesce(F.try_divide("y", "m"), F.lit(0.5))
    p, between = F.col("rate"), F.col("yy") - F.col("rate") * F.col("y")
    spread = p * (1 - p)
    rho = F.try_divide(
        between - spread * (F.col("k") - 1), spread * (F.col("m") - F.col("nn") / F.col("m") - F.col("k") + 1)
    )
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(0.0)), F.lit(settings.least_rho)), F.lit(settings.most_rho))
    return sums.select("*", rate.alias("rate")).select("rate", rho.alias("rho")).select(
        "rate", ((1 - F.col("rho")) / F.col("rho")).alias("strength")
    )


def _posterior(mean, strength, good="good", n="n") -> Column:
    return (F.col(good) + mean * strength) / (F.col(n) + strength)


def reputation(outcomes: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Of every host in `outcomes` (host, good 0/1 or null): its counts, posterior mean, bound and verdict.

    A host without a labelled page gets its domain's estimate with the prior's width. An empty or null host is
    a host of its own. No labelled page at all: every mean is 0.5. An empty table gives no rows.
    """
    settings = settings or Settings()
    host = F.coalesce("host", F.lit(""))
    by_host = outcomes.groupBy(host.alias("host")).agg(
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.count("good").alias("n")
    )
    domain, suffix = levels(F.col("host"), settings)
    by_host = by_host.withColumns({"domain": domain, "suffix": suffix})
    totals = [F.sum("good").alias("good"), F.sum("n").alias("n")]
    by_domain = by_host.groupBy("domain", "suffix").agg(*totals)
    by_suffix = by_domain.groupBy("suffix").agg(*totals)

    def fitted(units: DataFrame, column: str) -> Column:
        return _strength(units, settings).select(column).scalar()

    suffixes = by_suffix.select(
        "suffix", _posterior(fitted(by_suffix, "rate"), fitted(by_suffix, "strength")).alias("suffix_mean")
    )
    domains = by_domain.join(suffixes, "suffix").select(
        "domain", "suffix", _posterior(F.col("suffix_mean"), fitted(by_domain, "strength")).alias("domain_mean")
    )
    strength = fitted(by_host, "strength")
    hosts = by_host.join(domains, ["domain", "suffix"]).select(
        "host", "good", "n",
        _posterior(F.col("domain_mean"), strength).alias("mean"),
        (F.col("n") + strength).alias("weight"),
    )
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    hosts = hosts.select("host", "good", "n", "mean", (F.col("mean") - settings.z * deviation).alias("bound"))
    passes = F.col("bound") >= settings.threshold
    return hosts.withColumn("verdict", F.when(passes, "allow").otherwise("block"))


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule] = (),
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    settings: Settings | None = None,
) -> DataFrame:
    """One row per page row: id, host, path, the rule that fits (or null), verdict allow or block.

    `outcomes` has (id_col, good): 1, 0 or null. Several outcomes of a page all count, as do repeated page rows.
    Other columns of either table are not read. A null url has an empty host and path.
    """
    settings = settings or Settings()
    parts = pages.select(
        F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    ).fillna("", ["host", "path"])
    labelled = parts.join(
        outcomes.select(F.col(id_col).alias("page_id"), F.col("good").cast("long").alias("good")), "page_id", "left"
    )
    by_host = reputation(labelled.select("host", "good"), settings).select("host", F.col("verdict").alias("of_host"))
    host, path = F.col("host"), F.col("path")
    ruled = first_rule(rules, host, path, lambda r: r.verdict)
    return parts.join(by_host, "host", "left").select(
        F.col("page_id").alias(id_col), "host", "path",
        first_rule(rules, host, path, lambda r: r.name).alias("rule"),
        F.coalesce(ruled, "of_host").alias("verdict"),
    )
