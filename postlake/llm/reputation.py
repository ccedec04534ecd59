"""Verdicts on page addresses: explicit rules first, then the reputation of the host.

The reputation of a host is the share of bad outcomes among its labelled pages, shrunk by
empirical Bayes: the Beta prior of a host has the mean of its registered domain, that of a domain
the mean of its suffix, that of a suffix the mean of all; how strongly each level is pulled comes
from the spread of its own counts (method of moments of the beta-binomial).  A host is blocked
when the lower bound of its posterior is above a threshold.
"""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import stored

RULES_MAX = 500  # rules are expressions of one plan; longer lists are refused, not cut
HOT = 1000  # a host with a thousandth of all pages is joined apart: there are a thousand such hosts at most
THRESHOLD, DEVIATIONS = 0.5, 1.645
LEAST_SPREAD, MOST_SPREAD = 1e-3, 0.999  # of the intra-class correlation; prior weights from 1,000 pages to 0.001
LEVELS = ("suffix", "domain", "host")
Rule = tuple[str, str]  # verdict, host/path


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path: what follows the first ``://``, A-Z of the host lower-cased; empty where there is none."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: Iterable[Rule]) -> tuple[Column, Column]:
    """The rule that fits and its verdict, null where none does.

    A rule fits its host and all subdomains where the path starts with the rule's; the longest
    wins, of equally long ones the first in alphabetical order.
    """
    rules = sorted(rules, key=lambda rule: (-len(rule[1]), rule[1]))
    if len(rules) > RULES_MAX:
        raise ValueError(f"{len(rules)} rules; at most {RULES_MAX} are expressions of one plan")
    name = verdict = F.lit(None).cast("string")
    for said, rule in reversed(rules):
        where, slash, rest = rule.partition("/")
        fits = ((host == where) | host.endswith("." + where)) & path.startswith(slash + rest)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def registered(host: Column, suffixes: Iterable[str] = ()) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, without user and port.

    The suffix is the last label, or one of ``suffixes`` of two labels such as ``co.uk``; the
    domain has one label more.  An address of numbers is its own domain, under the empty suffix.
    """
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    numbers = bare.rlike(r"^\d+(\.\d+){3}$") | bare.startswith("[")
    two = F.substring_index(bare, ".", -2)
    long = two.isin(*suffixes) if suffixes else F.lit(False)
    suffix = F.when(long, two).otherwise(F.substring_index(bare, ".", -1))
    domain = F.when(long, F.substring_index(bare, ".", -3)).otherwise(two)
    return F.when(numbers, bare).otherwise(domain), F.when(numbers, F.lit("")).otherwise(suffix)


def reputations(outcomes: DataFrame, suffixes: Iterable[str] = (), deviations: float = DEVIATIONS) -> DataFrame:
    """``host, pages, labelled, bad, mean, bound`` of every host of ``outcomes``.

    ``outcomes`` has ``host`` and ``bad`` (true, false, or null without a label).  ``mean`` is the
    shrunk share of bad pages, ``bound`` its lower bound (``deviations`` standard deviations of
    the posterior below).  A host without labelled pages has the prior of its domain; without any
    label at all the mean is one half everywhere.  A null host counts as the empty one; an empty
    table gives no rows.
    """
    host = F.coalesce("host", F.lit(""))
    domain, suffix = registered(host, suffixes)
    hosts = stored(outcomes.groupBy(host.alias("host")).agg(
        F.count("*").alias("pages"), F.count("bad").alias("n"), F.count(F.when(F.col("bad"), 1)).alias("k"))
        .withColumn("domain", domain).withColumn("suffix", suffix), "hosts")
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    ends = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    whole = ends.agg(((F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("prior"))  # one row
    ends = shrunk(ends.withColumn("prior", F.lit(whole.first()["prior"])))
    domains = shrunk(domains.join(ends.select("suffix", F.col("mean").alias("prior")), "suffix"))
    made = shrunk(hosts.join(domains.select("suffix", "domain", F.col("mean").alias("prior")), ["suffix", "domain"]))
    a, b = F.col("a"), F.col("b")
    spread = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return made.select("host", "pages", F.col("n").alias("labelled"), F.col("k").alias("bad"), "mean", (F.col("mean") - deviations * spread).alias("bound"))


def shrunk(level: DataFrame) -> DataFrame:
    """``level`` (``n, k, prior``) with the posterior ``a, b`` and its ``mean``; the prior's weight is one number per level."""
    level = stored(level, "level")
    n, prior = F.col("n"), F.col("prior")
    own = prior * (1 - prior)
    off = F.col("k") / n - prior
    seen = level.where("n > 0").agg(
        F.sum(n * off * off - own).alias("beyond"), F.sum(own * (n - 1)).alias("room")).first()
    beyond, room = seen["beyond"] or 0.0, seen["room"] or 0.0
    spread = min(max(beyond / room, LEAST_SPREAD), MOST_SPREAD) if room > 0 else MOST_SPREAD
    weight = 1 / spread - 1
    a, b = prior * weight + F.col("k"), (1 - prior) * weight + n - F.col("k")
    return level.withColumn("a", a).withColumn("b", b).withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))


def judge(pages: DataFrame, rules: Iterable[Rule], outcomes: DataFrame | None = None, suffixes: Iterable[str] = (),
          threshold: float = THRESHOLD, deviations: float = DEVIATIONS) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page, with ``mean`` and ``bound`` of its host.

    ``outcomes`` (``url, bad``) are labelled pages; without it the pages that a rule decides are
    the labelled ones (blocked means bad).  Null urls and urls without ``://`` have an empty host
    and path; repeated rows are judged each; other columns are ignored; an empty table gives no rows.
    """
    rules = list(rules)
    host, path = split_url(F.col("url"))
    cut = pages.select("page_id", host.alias("host"), path.alias("path"))
    name, said = ruled(F.col("host"), F.col("path"), rules)
    cut = stored(cut.withColumn("rule", name).withColumn("said", said), "pages")
    known = cut.select("host", (F.col("said") == "block").alias("bad"))
    if outcomes is not None:  # hosts without an outcome stay in, as children without labels
        known = cut.select("host", F.lit(None).cast("boolean").alias("bad")).unionByName(
            outcomes.select(split_url(F.col("url"))[0].alias("host"), F.col("bad").cast("boolean").alias("bad")))
    by_host = stored(reputations(known, suffixes, deviations), "reputations")
    total = by_host.agg(F.sum("pages")).first()[0] or 0
    of_host = by_host.withColumn("hot", F.col("pages") * HOT >= total).select("host", "hot", "mean", "bound")
    hot = of_host.where("hot").drop("hot")  # HOT rows at most
    warm = cut.join(F.broadcast(hot), "host")
    cold = cut.join(F.broadcast(hot.select("host")), "host", "left_anti").join(of_host.where("not hot").drop("hot"), "host")
    method = F.when(F.col("bound") > threshold, "block").otherwise("allow")
    return warm.unionByName(cold).select("page_id", "host", "path", "rule", F.coalesce("said", method).alias("verdict"), "mean", "bound")
