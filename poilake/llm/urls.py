"""URL filters: explicit rules, then empirical-Bayes host reputation."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poilake.llm.scratch import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Public suffixes of two labels; all others have one.
TWO_LABELS = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "gov.uk", "org.uk")
#: A host is blocked when its rate of bad pages is at least ``LIMIT`` even at the lower bound
#: ``Z`` standard deviations below the posterior mean.
LIMIT, Z = 0.3, 1.645
#: Copies of a host's verdict, so that a host with a third of all pages is spread over tasks.
SALTS = 16


class Rule(NamedTuple):
    """``verdict`` for all urls on ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """From the first :// to the next / ? # or the end, with A-Z lowered; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host to the next ? # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def _name(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(host, r"^.*@|:[0-9]*$", "")


def suffix_of(host: Column) -> Column:
    """The public suffix; a numeric address is its own."""
    name = _name(host)
    two = F.substring_index(name, ".", -2)
    return (
        F.when(name.rlike(r"^[0-9.]+$"), name)
        .when(two.isin(*TWO_LABELS), two)
        .otherwise(F.substring_index(name, ".", -1))
    )


def domain_of(host: Column) -> Column:
    """The registered domain: one label more than the suffix, or all of a shorter name."""
    name = _name(host)
    two = F.substring_index(name, ".", -2)
    return (
        F.when(name.rlike(r"^[0-9.]+$"), name)
        .when(two.isin(*TWO_LABELS), F.substring_index(name, ".", -3))
        .otherwise(two)
    )


def matched(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls. The rules are a short list."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), r)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.host + rule.path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def _strength(children: DataFrame) -> float:
    """Prior strength s of beta-binomial counts (n, k) around their parents' means m, by moments.

    With rho = 1 / (s + 1), the expected (k - n m)^2 is n m (1 - m) (1 + (n - 1) rho).
    """
    spread = F.col("m") * (1 - F.col("m"))
    square = F.col("k") - F.col("n") * F.col("m")
    over = F.sum(square * square - F.col("n") * spread)
    rho = F.try_divide(over, F.sum(F.col("n") * (F.col("n") - 1) * spread))
    found = children.agg(F.round(rho, 9)).first()[0]
    return 1 / min(max(found or 0.0, 0.001), 0.999) - 1


def reputation(outcomes: DataFrame, hosts: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, mean, bound) for each row of ``hosts``: posterior rate of bad pages and lower bound.

    ``outcomes`` has (host, bad): labelled pages, bad 0 or 1. Rates of suffixes are shrunk to
    the overall rate, of domains to their suffix's, of hosts to their domain's, by the prior
    strength that each level's own spread suggests. Unlabelled hosts have their prior.
    """
    counts = (
        outcomes.where("bad is not null")
        .groupBy("host")
        .agg(F.count("*").alias("n"), F.sum("bad").alias("k"))
    )
    tree = (
        hosts.join(counts, "host", "left")
        .fillna(0, ["n", "k"])
        .withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    )
    tree = scratch.store(tree, "hosts")
    total = tree.agg(F.sum("k"), F.sum("n")).first()
    overall = (total[0] + 1) / (total[1] + 2) if total[1] else 0.0  # unknown is not bad
    level = tree.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("m", F.lit(overall))
    for key, below in (("suffix", "domain"), ("domain", "host")):
        s = F.lit(_strength(level))
        shrunk = level.select(key, ((F.col("k") + s * F.col("m")) / (F.col("n") + s)).alias("m"))
        names = tree.groupBy("suffix", "domain") if below == "domain" else tree.groupBy("domain", "host")
        level = names.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).join(shrunk, key)
    s = F.lit(_strength(level))
    a, b = F.col("k") + s * F.col("m"), F.col("n") - F.col("k") + s * (1 - F.col("m"))
    mean = a / (a + b)
    return level.select(
        "host",
        F.round(mean, 6).alias("mean"),
        F.round(F.greatest(F.lit(0.0), mean - Z * F.sqrt(mean * (1 - mean) / (a + b + 1))), 6).alias("bound"),
    )


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """(id, host, path, rule, verdict, mean, bound) for every row of ``pages``.

    The longest fitting rule decides; other urls are blocked by their host's ``bound``
    (``reputation``). ``outcomes`` has (url, bad). Null urls and urls without :// have an empty
    host and path, and that host's reputation. Repeated rows are judged alike and all returned;
    labelled rows count as often as they occur. Without outcomes nothing but rules blocks.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    known = outcomes.select(host_of(F.col("url")).alias("host"), F.col("bad").cast("long").alias("bad"))
    marks = reputation(known, rows.select("host").distinct(), scratch)
    marks = scratch.store(
        marks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "reputation"
    )
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") >= LIMIT, F.lit("block")).otherwise(F.lit("allow"))
    salt = F.pmod(F.xxhash64("id", "path"), F.lit(SALTS)).cast("int")
    return rows.withColumn("salt", salt).join(marks, ["host", "salt"]).select(
        "id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "mean", "bound"
    )
