"""Host reputation by empirical Bayes, and url rules.

Outcomes of labelled pages are counted by host. The share of bad pages of a suffix shrinks
towards the overall share, that of a registered domain towards its suffix, and that of a
host towards its domain; how strongly, the spread between the groups of a level tells
(method of moments for the beta-binomial). A host is blocked when the lower bound of its
posterior share of bad pages exceeds the limit.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.workspace import write_down

#: Pages of one host are dealt over so many tasks.
SALTS = 16
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0


def host_and_path(url: str):
    """Host (A-Z lower-cased) and path of a url column; both empty for a null or one without ``://``."""
    mark = F.instr(F.col(url), "://")
    rest = F.when(mark > 0, F.col(url).substr(mark + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    fixed = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(fixed, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(rules: Sequence[tuple[str, str]]):
    """Rule and verdict by the longest (verdict, ``host/path``) rule that fits columns ``host`` and ``path``; else null."""
    rule = verdict = F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(slash + path))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def prior_strength(n: float, bad: float, groups: int, squares: float, spread: float) -> float:
    """Strength of the beta prior of a level by moments: ``squares`` is the sum of n * n, ``spread`` of bad * bad / n."""
    if not n:
        return MAX_STRENGTH
    within = bad / n * (1 - bad / n)
    room = within * (n - squares / n - groups + 1)
    rho = (spread - bad * bad / n - within * (groups - 1)) / room if room > 0 else 0.0
    return max(MIN_STRENGTH, min(MAX_STRENGTH, 1 / rho - 1)) if rho > 0 else MAX_STRENGTH


def _shrunk(groups: DataFrame) -> DataFrame:
    """``groups`` (n, bad and a prior share) with the level's ``strength`` and posterior ``share``."""
    n = F.col("n").cast("double")
    sums = groups.where(F.col("n") > 0).agg(
        F.coalesce(F.sum(n), F.lit(0.0)), F.coalesce(F.sum("bad").cast("double"), F.lit(0.0)), F.count("*"), F.sum(n * n), F.sum(F.col("bad") * F.col("bad") / n)
    ).first()
    strength = F.lit(prior_strength(*sums))
    return groups.withColumns({"strength": strength, "share": (F.col("bad") + strength * F.col("prior")) / (F.col("n") + strength)})


def host_reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """``host, n, bad, share, bound`` from rows ``host, outcome`` (1 good, 0 bad, else unknown).

    Every host of the rows is returned; one without known outcomes has its domain's share.
    The registered domain is the last two labels, the suffix the last. Without any known
    outcome the overall share is a half.
    """
    known = F.col("outcome").isin(0, 1)
    label = lambda n: F.substring_index("host", ".", n)
    hosts = outcomes.groupBy("host").agg(
        F.coalesce(F.sum(F.when(known, 1)), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("outcome") == 0, 1)), F.lit(0)).alias("bad")
    ).withColumns({"domain": label(-2), "suffix": label(-1)})
    total = lambda df, *keys: df.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    hosts = write_down(hosts, "hosts").table
    domains = total(hosts, "domain", "suffix")
    suffixes = total(domains, "suffix")
    n, bad = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    suffix = _shrunk(suffixes.withColumn("prior", F.lit((bad + 0.5) / (n + 1)))).select("suffix", F.col("share").alias("prior"))
    domain = _shrunk(domains.join(suffix, "suffix")).select("domain", F.col("share").alias("prior"))
    host = _shrunk(hosts.join(domain, "domain"))
    spread = F.sqrt(F.col("share") * (1 - F.col("share")) / (F.col("n") + F.col("strength") + 1))
    return host.select("host", "n", "bad", "share", (F.col("share") - z * spread).alias("bound"))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]], limit: float = 0.15, z: float = 1.645,
    page_id: str = "page_id", url: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``outcomes`` has ``page_id`` and ``outcome``: 1 for a good page, 0 for a bad one. The
    longest fitting rule decides; without one the host is blocked when the lower bound of
    its share of bad pages exceeds ``limit``. Null urls have an empty host and path, which
    is judged as a host. Repeated rows are judged alike, and so often count.
    """
    host, path = host_and_path(url)
    split = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(rules)
    split = split.withColumns({"rule": rule, "verdict": verdict})
    told = split.select("page_id", "host").join(outcomes.select("page_id", "outcome"), "page_id", "left").select("host", "outcome")
    known = host_reputation(told, z).select("host", "bound").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int")
    open_ = split.where(F.col("rule").isNull()).withColumn("salt", salt).join(known, ["host", "salt"])
    judged = open_.withColumn("verdict", F.when(F.col("bound") > limit, "block").otherwise("allow")).select(split.columns)
    return split.where(F.col("rule").isNotNull()).union(judged)
