"""URL verdicts from rules and, where no rule fits, from the reputation of the host.

Labelled page outcomes (bad or not) are counted per host, registered domain and suffix. A host with few labels says little
by itself, so its share of bad pages is shrunk: every level has a beta prior whose mean is the posterior mean of the level
above and whose strength is estimated from how far the groups of that level scatter around their parents (method of
moments for beta-binomial counts). A host is blocked when the lower bound of its posterior share of bad pages is at or above
a limit. Everything is DataFrame code; the tables of hosts, domains and suffixes are joined on keys whose frequent values
are known from counts, see ``frames.looked_up``.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import looked_up, stored

# Suffixes of two labels under which names are registered.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "co.in", "com.br", "co.za", "com.cn", "com.mx")
LIMIT = 0.25  # a host goes when its share of bad pages is at least this
Z = 1.645  # with a certainty of 95 %
WEAKEST, STRONGEST = 1.0, 1e6  # bounds of a prior's strength, in pages
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """``where`` is a host, then a path from its first slash on; it fits the host and all its subdomains."""

    verdict: str
    where: str


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _levels(host: Column, suffixes: Sequence[str]) -> dict[str, Column]:
    """Registered domain and suffix of a host, without user and port; an IPv4 address is its own domain."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    labels = F.split(name, r"\.")
    two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    n = F.when(name.rlike(r"^[0-9.]+$"), F.size(labels)).when(two.isin(*suffixes), F.lit(2)).otherwise(F.lit(1))
    tail = lambda k: F.array_join(F.slice(labels, F.greatest(F.size(labels) - k + 1, F.lit(1)), F.size(labels)), ".")
    return {"suffix": tail(n), "domain": tail(n + 1)}


def _strength(level: DataFrame) -> float:
    """Strength of the beta prior of a level of (n, bad, prior): from the excess of the squared deviations of its counts.

    For counts of a beta-binomial, E (bad - n m)^2 = n m (1 - m) (1 + (n - 1) / (strength + 1)).
    """
    m, n = F.col("prior"), F.col("n").cast("double")
    plain = n * m * (1 - m)
    excess = F.sum((F.col("bad") - n * m) * (F.col("bad") - n * m) - plain)
    share = level.select(F.try_divide(excess, F.sum(plain * (n - 1)))).first()[0]
    return min(max(1 / share - 1, WEAKEST), STRONGEST) if share is not None and share > 0 else STRONGEST


def _posterior(level: DataFrame) -> DataFrame:
    """The rows with ``a`` and ``b`` of their beta posteriors."""
    s = F.lit(_strength(level))
    return level.withColumns({"a": s * F.col("prior") + F.col("bad"), "b": s * (1 - F.col("prior")) + F.col("n") - F.col("bad")})


def host_reputation(outcomes: DataFrame, suffixes: Sequence[str] = SUFFIXES, z: float = Z) -> DataFrame:
    """host, n_labelled, n_bad, bad_share (posterior mean) and bad_bound (its lower bound, a normal approximation).

    ``outcomes`` has host, n_labelled and n_bad, one row per host; hosts without labels get their domain's share. Without
    any label the share is one half everywhere.
    """
    hosts = outcomes.withColumns(_levels(F.col("host"), suffixes)).withColumns({"n": F.col("n_labelled"), "bad": F.col("n_bad")})
    hosts = stored(hosts, "host-levels")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count("*").alias("children"))
    tops = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count("*").alias("children"))
    n, bad = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    mean = (F.col("a") / (F.col("a") + F.col("b"))).alias("prior")
    tops = stored(tops.withColumn("prior", F.lit((bad + 0.5) / (n + 1))), "suffixes")
    tops = stored(_posterior(tops).select("suffix", mean, "children"), "suffixes")
    domains = stored(looked_up(domains, tops, ["suffix"], "children"), "domains")
    domains = stored(_posterior(domains).select("domain", mean, "children"), "domains")
    hosts = _posterior(stored(looked_up(hosts, domains, ["domain"], "children"), "hosts"))
    total = F.col("a") + F.col("b")
    spread = F.sqrt(F.col("a") * F.col("b") / (total * total * (total + 1)))
    bound = F.greatest(F.col("a") / total - F.lit(float(z)) * spread, F.lit(0.0))
    return hosts.select("host", "n_labelled", "n_bad", (F.col("a") / total).alias("bad_share"), bound.alias("bad_bound"))


def _fitting(hosts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """host and the rules of its name and of all parent names, longest first."""
    if not rules:
        return hosts.select("host", F.lit(None).cast("array<struct<path string, verdict string, rule string>>").alias("rules"))
    table = [(where.partition("/")[0], where[where.find("/") :] if "/" in where else "", verdict, where) for verdict, where in rules]
    known = hosts.sparkSession.createDataFrame(table, "name string, path string, verdict string, rule string")
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    named = hosts.select("host", F.explode(parents).alias("name")).join(F.broadcast(known), "name")
    order = F.struct(-F.length("rule"), -F.length("name"), F.when(F.col("verdict") == "block", 0).otherwise(1), "path", "verdict", "rule")
    ordered = F.sort_array(F.collect_set(order))
    # A host has few parents, and a parent few rules; the list of a host stays as short as the rules of its own names.
    return named.groupBy("host").agg(F.transform(ordered, lambda r: F.struct(r["path"], r["verdict"], r["rule"])).alias("rules"))


def judged_urls(
    pages: DataFrame,
    labelled: DataFrame,
    rules: Sequence[Rule] = (),
    id_column: str = "page_id",
    url_column: str = "url",
    limit: float = LIMIT,
    z: float = Z,
    suffixes: Sequence[str] = SUFFIXES,
) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block), n_labelled, n_bad and bad_bound of every page.

    ``labelled`` has host, n_labelled and n_bad: outcomes of labelled pages, any number of rows per host; hosts that no page
    has count too. The longest rule that fits a url's host and path decides (of equally long ones that of the longer host,
    then a block); without one the host's reputation does. A missing url, or one without ``://``, has an empty host, which
    is judged like any other. Repeated pages and pages without a key are judged alike, each in its own row.
    """
    url = F.col(f"`{url_column}`").cast("string")
    rows = pages.select(F.col(f"`{id_column}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    seen = rows.groupBy("host").agg(F.count("*").alias("n_pages"))
    seen = seen.select("host", "n_pages", F.lit(0).cast("long").alias("n_labelled"), F.lit(0).cast("long").alias("n_bad"))
    told = labelled.where("host is not null").select("host", F.lit(0).cast("long").alias("n_pages"), F.col("n_labelled").cast("long"), F.col("n_bad").cast("long"))
    hosts = seen.unionByName(told).groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n_pages", "n_labelled", "n_bad")])
    hosts = stored(hosts, "hosts")
    reputation = stored(host_reputation(hosts, suffixes, z), "reputation").join(hosts.select("host", "n_pages"), "host")
    table = reputation.join(_fitting(hosts, rules), "host", "left").where("n_pages > 0")
    table = stored(table.select("host", "n_pages", "n_labelled", "n_bad", "bad_bound", "rules"), "judged-hosts")
    out = looked_up(rows, table, ["host"], "n_pages")
    hit = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    own = F.when(F.col("bad_bound") >= limit, "block").otherwise("allow")
    return out.withColumn("hit", hit).select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", own).alias("verdict"), "n_labelled", "n_bad", F.round("bad_bound", 6).alias("bad_bound")
    )
