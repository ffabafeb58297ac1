"""URL filter: allow and block rules first, then an empirical-Bayes reputation of the host.

Pages that a rule decides are the labelled outcomes (block 1, allow 0; or give a 0/1
column of your own).  Outcome rates are shrunk from the top down through
beta-binomial priors: suffix towards the corpus, registered domain (last two host
labels) towards its suffix, host towards its domain.  The strength of each prior
is the moment estimate of the beta-binomial at that level.  A page without a rule
is blocked when the lower posterior bound of its host's block rate (normal approximation)
exceeds ``BLOCK_ABOVE``.

Counts are partial aggregates per host, so a hot host sends one row per task; domains
and suffixes are summed from host rows.  The page side joins its host's row, an
equi-join that adaptive execution broadcasts or splits by actual size.

Edge cases: a null url, or one without ``://``, has an empty host and path, fits
no rule and shares the reputation of the empty host; with no labelled page at all nothing is
blocked; repeated pages count each time; an empty table gives an empty result; extra
columns are ignored, columns named like the added ones do not clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (rule, host, path, verdict); fixed values of the task.
RULES = (("org/", "org", "/", "allow"), ("example.org/es/", "example.org", "/es/", "block"),
         ("example.org/en/1", "example.org", "/en/1", "block"), ("com/fr/", "com", "/fr/", "allow"),
         ("com/de/", "com", "/de/", "block"))
BLOCK_ABOVE = 0.5
Z = 1.645


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, h, p, v in sorted(rules, key=lambda r: len(r[0])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _strength(groups: DataFrame) -> DataFrame:
    """One row: corpus block rate m and the prior strength k of groups with columns n and b (labelled, blocked)."""
    total = groups.filter("n > 0").agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b"), F.count(F.lit(1)).alias("g"),
                                       F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("b") * F.col("b") / F.col("n")).alias("bbn"))
    n, b, g = F.col("all_n"), F.col("all_b"), F.col("g")
    m = b / n
    between = F.col("bbn") - b * m  # sum of n (rate - m)^2
    room = n - F.col("nn") / n - (g - 1)
    rho = F.when((b > 0) & (b < n) & (room > 0), (between / (m * (1 - m)) - (g - 1)) / room).otherwise(0.5)
    rho = F.greatest(F.lit(0.001), F.least(F.lit(0.999), F.coalesce(rho, F.lit(0.5))))
    return total.select((1 / rho - 1).alias("k"))


def reputations(outcomes: DataFrame) -> DataFrame:
    """host, alpha, beta of the posterior block rate; outcomes has host and a 0/1 or null column outcome."""
    hosts = (outcomes.groupBy("host").agg(F.count("outcome").alias("n"), F.coalesce(F.sum("outcome"), F.lit(0)).alias("b"))
             .select("host", "n", "b", F.substring_index("host", ".", -2).alias("domain"), F.substring_index("host", ".", -1).alias("suffix"))
             .checkpoint())
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    corpus = suffixes.agg(((F.coalesce(F.sum("b"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("m")).scalar()

    def k(groups: DataFrame) -> Column:
        return _strength(groups).scalar()

    suffixes = suffixes.select("suffix", ((F.col("b") + k(suffixes) * corpus) / (F.col("n") + k(suffixes))).alias("m_suffix"))
    domains = (domains.withColumn("k", k(domains)).join(suffixes, "suffix")
               .select("domain", ((F.col("b") + F.col("k") * F.col("m_suffix")) / (F.col("n") + F.col("k"))).alias("m_domain")))
    return (hosts.withColumn("k", k(hosts)).join(domains, "domain")
            .select("host", (F.col("b") + F.col("k") * F.col("m_domain")).alias("alpha"),
                    (F.col("n") - F.col("b") + F.col("k") * (1 - F.col("m_domain"))).alias("beta")))


def lower_bound(alpha: Column, beta: Column) -> Column:
    """Lower posterior bound of the block rate."""
    mean = alpha / (alpha + beta)
    return mean - Z * F.sqrt(mean * (1 - mean) / (alpha + beta + 1))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    host, path = parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = split.select("*", rule.alias("rule"), verdict.alias("given"))
    outcome = F.when(F.col("given") == "block", 1).when(F.col("given") == "allow", 0)
    known = reputations(ruled.select("host", outcome.alias("outcome"))).select(
        F.col("host").alias("host_"), (lower_bound(F.col("alpha"), F.col("beta")) > BLOCK_ABOVE).alias("bad"))
    return (ruled.join(known, F.col("host") == F.col("host_"), "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("given", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict")))
