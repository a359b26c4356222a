"""Empirical-Bayes host reputation for URL filtering.

Labelled page outcomes are counted per host, registered domain and suffix.  Each level's bad
rate gets a beta prior centred on the posterior mean of the level above (host <- registered
domain <- suffix <- all pages); the prior's strength is estimated per level by moments of the
beta-binomial.  A host is blocked when the lower posterior bound of its bad rate (mean less
``z`` standard deviations of the beta posterior) exceeds ``max_bad_rate``.  Fixed rules on
host and path come first.

A null URL or one without '://' has empty host and path; the empty host is judged like any
other host.  Pages without outcome, hosts without labelled page and an empty outcome table
are judged by the prior alone.  Null outcomes and outcomes of unknown pages are ignored,
repeated outcome rows count as often as they occur, repeated pages give repeated rows.  An
empty page table gives an empty table.  Other columns of ``pages`` are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

# Second-level suffixes under which names are registered.
SECOND_LEVEL = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.in", "co.jp",
                "co.kr", "co.nz", "co.za", "com.br", "com.cn", "com.mx", "com.tr")
STRENGTH = (0.5, 10000.0)


def host_of(url):
    """After the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; '' without '://'."""
    host = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url):
    """After the host up to '?', '#' or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url):
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host, path, rules):
    """The longest rule 'host/path' that fits, else null.  ``rules``: {'example.net/en/': 'allow'}."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _levels(hosts: DataFrame) -> DataFrame:
    name = F.regexp_replace(F.regexp_replace("host", "^.*@", ""), ":[0-9]*$", "")
    two = F.substring_index(name, ".", -2)
    suffix = F.when(two.isin(*SECOND_LEVEL), two).otherwise(F.substring_index(name, ".", -1))
    domain = F.when(two.isin(*SECOND_LEVEL), F.substring_index(name, ".", -3)).otherwise(two)
    return hosts.withColumns({"domain": domain, "suffix": suffix})


def _strength(level: DataFrame) -> float:
    """Prior strength a + b of children (n, bad) around their prior means m, by moments."""
    v = F.col("m") * (1 - F.col("m"))
    off = F.col("bad") / F.col("n") - F.col("m")
    row = level.where("n > 0").agg(
        F.sum(F.col("n") * off * off - v).alias("over"), F.sum(v * (F.col("n") - 1)).alias("room")).first()
    if not row["room"]:
        return STRENGTH[1]
    rho = min(max(row["over"] / row["room"], 1e-9), 1 - 1e-9)
    return min(max((1 - rho) / rho, STRENGTH[0]), STRENGTH[1])


def reputation(pages: DataFrame, outcomes: DataFrame, z: float = 1.645, max_bad_rate: float = 0.5) -> DataFrame:
    """One row per host of ``pages`` (page_id, host): counts, posterior mean, lower bound, blocked.

    ``outcomes``: (page_id, bad 0/1).
    """
    labelled = pages.join(outcomes.where("bad is not null and page_id is not null"), "page_id").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).join(labelled, "host", "left")
    hosts = cut(_levels(hosts.fillna(0, ["n", "bad"])))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = (float(total["bad"] or 0) + 0.5) / (float(total["n"] or 0) + 1.0)

    def shrunk(level):
        s = _strength(level)
        return level.withColumn("mean", (s * F.col("m") + F.col("bad")) / (s + F.col("n")))

    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    suffixes = cut(hosts.groupBy("suffix").agg(*counts).withColumn("m", F.lit(mean)))
    suffixes = shrunk(suffixes).select("suffix", F.col("mean").alias("m"))
    domains = cut(hosts.groupBy("suffix", "domain").agg(*counts).join(suffixes, "suffix"))
    domains = shrunk(domains).select("suffix", "domain", F.col("mean").alias("m"))
    hosts = cut(hosts.join(domains, ["suffix", "domain"]))
    s = _strength(hosts)
    a, b = s * F.col("m") + F.col("bad"), s * (1 - F.col("m")) + F.col("n") - F.col("bad")
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.withColumns({"mean": a / (a + b), "bound": a / (a + b) - z * sd}).select(
        "host", "pages", "n", "bad", "mean", "bound", (F.col("bound") > max_bad_rate).alias("blocked"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: dict[str, str], z: float = 1.645,
          max_bad_rate: float = 0.5) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and the host's bound."""
    url = F.col("url")
    parts = pages.select("page_id", host_of(F.coalesce(url, F.lit(""))).alias("host"),
                         path_of(F.coalesce(url, F.lit(""))).alias("path"))
    # Written, so that the join below is between two plain shuffles and a hot host can be split.
    rep = cut(reputation(parts.select("page_id", "host"), outcomes, z, max_bad_rate).select("host", "bound", "blocked"))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(*[F.when(F.col("rule") == r, F.lit(v)) for r, v in rules.items()],
                         F.when(F.col("blocked"), "block").otherwise("allow"))
    return parts.join(rep, "host", "left").withColumn("rule", rule).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), F.col("bound").alias("bad_rate_bound"))
