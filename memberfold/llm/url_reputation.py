"""URL filter: path rules first, then an empirical-Bayes reputation of the host.

The share of good outcomes of a host is a beta-binomial rate whose prior is that of
its registered domain, whose prior is that of its suffix, whose prior is that of all
labelled pages. A host is blocked if even the upper posterior bound of its rate of
good pages stays below a floor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from memberfold.llm.common import ascii_lower, written

# Suffixes of two labels under which names are registered; any other suffix is one label.
# Fixed values, a short list to be replaced by the caller's.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz")
# A host is blocked if its upper posterior bound is below this.
FLOOR = 0.5
# Standard deviations from posterior mean to bound.
WIDTH = 1.645
# A prior counts as many outcomes as its level's spread tells, within these.
LEAST_PRIOR, MOST_PRIOR = 2.0, 1000.0
# Pieces that the pages of one host are dealt to in the join with verdicts.
SALTS = 32

_AFTER_SCHEME = r"(?s)^.*?://(.*)$"


def host_of(url: Column) -> Column:
    """From the first `://` up to `/`, `?`, `#` or the end, A-Z lowered; else empty."""
    rest = F.regexp_extract(url, _AFTER_SCHEME, 1)
    return F.coalesce(ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    rest = F.regexp_extract(url, _AFTER_SCHEME, 1)
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """The longest rule `host/path` that fits; null if none does."""
    found = F.lit(None).cast("string")
    for rule in sorted(set(rules), key=lambda r: (len(r), r)):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def suffix_of(host: Column) -> Column:
    last, two = F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(last)


def domain_of(host: Column) -> Column:
    """The suffix and one label more."""
    long = F.substring_index(host, ".", -2).isin(*TWO_LABEL_SUFFIXES)
    return F.when(long, F.substring_index(host, ".", -3)).otherwise(
        F.substring_index(host, ".", -2)
    )


def _strength(level: DataFrame, mean: str) -> float:
    """How many outcomes a prior is worth: method of moments over one level's members.

    ``level`` has ``n`` and ``good`` of each member and the prior mean it shrinks to.
    The spread of the counts around the means beyond what chance adds gives the
    correlation r of two outcomes of a member; the prior is worth 1 / r - 1 outcomes.
    """
    spread = F.sum(F.pow(F.col("good") - F.col("n") * F.col(mean), 2))
    one = F.col("n") * F.col(mean) * (1 - F.col(mean))
    row = level.agg(spread, F.sum(one), F.sum(one * (F.col("n") - 1))).first()
    total, chance, pairs = (x or 0.0 for x in row)
    if pairs <= 0 or total <= chance:
        return MOST_PRIOR
    return min(MOST_PRIOR, max(LEAST_PRIOR, pairs / (total - chance) - 1))


def _shrunk(level: DataFrame, mean: str, out: str) -> tuple[DataFrame, float]:
    worth = _strength(level, mean)
    rate = (F.col("good") + worth * F.col(mean)) / (F.col("n") + worth)
    return level.withColumn(out, rate), worth


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """``host, mean, lower, upper`` from ``host, good`` (boolean, null: not labelled).

    Every host gets a row. Without any label the mean is a half.
    """
    hosts = outcomes.groupBy("host").agg(
        F.count("good").alias("n"),
        F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0)).alias("good"),
    )
    hosts = written(
        hosts.withColumn("domain", domain_of(F.col("host"))).withColumn(
            "suffix", suffix_of(F.col("host"))
        ),
        "hosts",
    )
    sums = (F.sum("n").alias("n"), F.sum("good").alias("good"))
    domains = hosts.groupBy("suffix", "domain").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    n, good = (x or 0 for x in hosts.agg(F.sum("n"), F.sum("good")).first())
    suffixes = suffixes.withColumn("top_mean", F.lit((good + 1) / (n + 2)))
    suffixes, _ = _shrunk(suffixes, "top_mean", "suffix_mean")
    domains, _ = _shrunk(
        domains.join(suffixes.select("suffix", "suffix_mean"), "suffix"),
        "suffix_mean",
        "domain_mean",
    )
    domains = domains.select("suffix", "domain", "domain_mean")
    hosts, worth = _shrunk(hosts.join(domains, ["suffix", "domain"]), "domain_mean", "mean")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + worth + 1))
    return hosts.select(
        "host",
        "mean",
        F.greatest(F.lit(0.0), F.col("mean") - WIDTH * deviation).alias("lower"),
        F.least(F.lit(1.0), F.col("mean") + WIDTH * deviation).alias("upper"),
    )


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    block: Sequence[str],
    allow: Sequence[str],
    floor: float = FLOOR,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, reputation`` of every row of ``page_id, url``.

    ``outcomes`` has ``page_id, good``. A page that it names more than once is good if
    any of its rows says so, and every row of a page that comes more than once counts.
    A url that is null or has no `://` has an empty host and path, is judged as the
    host `` like any other, and fits no rule. Rules are few (they become one
    expression); a rule in both lists blocks.
    """
    pages = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    labels = outcomes.groupBy(F.col("page_id").alias("labelled")).agg(
        F.max(F.col("good").cast("boolean")).alias("good")
    )
    labelled = pages.join(labels, F.col("page_id") == F.col("labelled"), "left")
    salt = F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS))
    spread = host_reputation(labelled.select("host", "good")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    spread = spread.withColumn("salt", F.col("salt").cast("long"))
    rule = longest_rule(F.col("host"), F.col("path"), [*block, *allow])
    judged = pages.withColumn("salt", salt).join(spread, ["host", "salt"])
    verdict = (
        F.when(F.col("rule").isin(*block), "block")
        .when(F.col("rule").isNotNull(), "allow")
        .when(F.col("upper") < floor, "block")
        .otherwise("allow")
    )
    return judged.withColumn("rule", rule).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), F.col("mean").alias("reputation")
    )
