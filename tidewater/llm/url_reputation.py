"""URL filter: explicit rules first, then empirical-Bayes host reputation; DataFrame functions only.

Outcomes of labelled pages are counted by host and shrunk through beta-binomial priors: the suffix towards all pages,
the registered domain towards its suffix, the host towards its domain. The strength of each level's prior is estimated
from the counts themselves (method of moments for the overdispersion of groups around their parents). A page is
allowed if the lower bound of its host's posterior, the quantile of its beta distribution at ``level``, is not under ``cutoff``.

The quantile is found by adding up the density over ``CELLS`` cells of an angle t with x = sin(t) ** 2, in which it is even enough for few and for many
labels, from 8 standard deviations under the mean to 8 above.

Pages are combined by host before anything is exchanged, so a host with a third of all pages is one row; reputations
join back to pages as the small, unique side.

Defined cases: null urls, and urls without ``://``, have an empty host and path, which share one reputation; hosts without a
labelled page have their domain's; without any label the prior is even. A page labelled more than once counts as its
best label; repeated pages count each; pages with a null id have no label; other columns, whatever their names, are left out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import lower_ascii

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Public suffixes of two labels; all others are taken to be of one.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "gov.uk", "net.au", "org.au", "org.uk")
CUTOFF, LEVEL = 0.5, 0.05
CELLS = 256
#: Bounds of the overdispersion: priors are worth between 1 and 9,999 pages.
LOOSEST, TIGHTEST = 0.5, 1e-4


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.char_length(host) + 1, F.char_length(rest)), r"^[^?#]*", 0)
    return lower_ascii(host), path


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # later ones are longer and win
        domain, _, rest = text.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit("/" + rest))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    last, two, three = (F.substring_index(host, ".", -n) for n in (1, 2, 3))
    double = two.isin(*TWO_LABEL_SUFFIXES)
    return F.when(double, three).otherwise(two), F.when(double, two).otherwise(last)


def _strength(groups: DataFrame) -> float:
    """What a prior is worth in pages, from groups of n pages, k good, around a parent mean m: one row of sums."""
    spread = F.col("m") * (1 - F.col("m"))
    row = groups.where("n > 0").agg(
        F.sum((F.col("k") - F.col("n") * F.col("m")) * (F.col("k") - F.col("n") * F.col("m")) / spread).alias("chi"), F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1)).alias("nn")
    ).first()
    rho = (row["chi"] - row["n"]) / row["nn"] if row["nn"] else LOOSEST
    return 1 / min(max(rho, TIGHTEST), LOOSEST) - 1


def _shrunk(groups: DataFrame, strength: float) -> Column:
    return (F.col("m") * strength + F.col("k")) / (F.col("n") + strength)


def beta_quantile(good: Column, bad: Column, level: float) -> Column:
    """The quantile at ``level`` of the beta distribution with these two parameters."""
    middle, sd = F.asin(F.sqrt(good / (good + bad))), 0.5 / F.sqrt(good + bad)
    low = F.greatest(middle - 8 * sd, F.lit(0.0))
    step = (F.least(middle + 8 * sd, F.lit(math.pi / 2)) - low) / CELLS
    log_density = lambda t: (2 * good - 1) * F.log(F.sin(t)) + (2 * bad - 1) * F.log(F.cos(t))
    weight = lambda i: F.exp(log_density(low + (i + 0.5) * step) - log_density(middle))

    def place(sums: Column) -> Column:
        """How many cells, and what part of one, hold the share."""
        target = F.element_at(sums, -1) * level
        k = F.size(F.filter(sums, lambda c: c <= target))
        return k - 1 + (target - F.element_at(sums, k)) / (F.element_at(sums, k + 1) - F.element_at(sums, k))

    cells = F.aggregate(F.sequence(F.lit(0), F.lit(CELLS - 1)), F.array(F.lit(0.0)), lambda sums, i: F.concat(sums, F.array(F.element_at(sums, -1) + weight(i))), place)
    return F.pow(F.sin(low + cells * step), F.lit(2.0))


def host_reputations(pages: DataFrame, outcomes: DataFrame, page_col: str = "page_id", url_col: str = "url", level: float = LEVEL) -> DataFrame:
    """host, n_labelled, n_good, mean, bound for every host of ``pages``. ``outcomes``: page (id), good (0 or 1)."""
    best = outcomes.where("page IS NOT NULL AND good IS NOT NULL").groupBy("page").agg(F.max("good").alias("good"))
    seen = pages.select(pages[page_col].alias("id"), host_and_path(pages[url_col])[0].alias("host"))
    joined = seen.join(best, F.col("id") == F.col("page"), "left")
    hosts = joined.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum((F.col("good") > 0).cast("long")), F.lit(0)).alias("k"))
    domain, suffix = domain_and_suffix(F.col("host"))
    scratch = Scratch(pages.sparkSession, "hosts")
    hosts = scratch.write(hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "k"), "hosts")
    domains = scratch.write(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "domains")
    suffixes = scratch.write(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "suffixes")
    whole = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    m = ((whole["k"] or 0) + 1) / ((whole["n"] or 0) + 2)
    suffixes = suffixes.withColumn("m", F.lit(m))
    priors = suffixes.select("suffix", _shrunk(suffixes, _strength(suffixes)).alias("m"))
    domains = domains.join(priors, "suffix")
    priors = domains.select("domain", _shrunk(domains, _strength(domains)).alias("m"))
    hosts = hosts.join(priors, "domain")
    strength = _strength(hosts)
    mean = _shrunk(hosts, strength)
    out = scratch.write(hosts.select("host", "n", "k", mean.alias("mean")).distinct(), "posteriors")
    bound = beta_quantile(F.col("mean") * (F.col("n") + strength), (1 - F.col("mean")) * (F.col("n") + strength), level)
    return out.select("host", F.col("n").alias("n_labelled"), F.col("k").alias("n_good"), "mean", bound.alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, page_col: str = "page_id", url_col: str = "url", rules: Sequence[tuple[str, str]] = RULES, cutoff: float = CUTOFF, level: float = LEVEL) -> DataFrame:
    """One row a page: id, host, path, rule, verdict, n_labelled and bound of its host."""
    host, path = host_and_path(pages[url_col])
    seen = pages.select(pages[page_col].alias("id"), host.alias("page_host"), path.alias("path"))
    rule, verdict = rule_for(F.col("page_host"), F.col("path"), rules)
    marked = seen.select("id", "page_host", "path", rule.alias("rule"), verdict.alias("ruled"))
    out = marked.join(host_reputations(pages, outcomes, page_col, url_col, level), F.col("page_host") == F.col("host"), "left")
    method = F.when(F.col("bound") >= cutoff, "allow").otherwise("block")
    return out.select(F.col("id").alias(page_col), F.col("page_host").alias("host"), "path", "rule", F.coalesce("ruled", method).alias("verdict"), "n_labelled", "bound")
