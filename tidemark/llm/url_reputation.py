"""URL filters by rules and empirical-Bayes host reputation. DataFrame functions only.

Labelled page outcomes are counted by host. Bad rates are shrunk level by level, suffix to registered domain
to host: the posterior mean of a level is the prior mean of the next, and the prior's strength at a level is
the beta-binomial method-of-moments estimate over that level's members. A host is blocked if the lower
posterior bound of its bad rate, mean less z standard deviations of the beta posterior, is above `block_at`.
A host without labelled pages is judged by what its domain and suffix lend it. A suffix is the longest of `suffixes`
(a public-suffix list) that the host ends with, else its last label; the registered domain has one label more.

Rules come first: a rule "host/path" fits its host and all subdomains where the url's path starts with the
rule's path; the longest fitting rule wins, of equally long ones that with the longer host. Rules of any number are
joined to the distinct hosts by the ends of their names.

Defined results: a url that is null or has no "://" has an empty host and path, fits no rule and is judged as
the host ""; hosts made of digits and dots are their own domain and suffix; a page without outcome (null)
counts as unlabelled; with no labelled page at all everything outside the rules is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import inner, lower_ascii, materialize

# Suffixes of several labels that are taken where no list is given
SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "com.br", "com.cn", "co.in", "co.jp", "ne.jp", "or.jp", "co.kr", "com.mx", "co.nz", "com.tr", "co.za")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    raw = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(url)), "^([^?#]*)", 1)
    return F.coalesce(lower_ascii(raw), F.lit("")), F.coalesce(path, F.lit(""))


def name_ends(host: Column) -> Column:
    """The host and all it is a subdomain of."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def rules_by_host(hosts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """host, rules: those that fit the host, the winning ones first. rules: (verdict, "host/path")."""
    table = hosts.sparkSession.createDataFrame([(r.partition("/")[0], "/" + r.partition("/")[2], r, v) for v, r in rules], "end string, path string, rule string, verdict string")
    ends = hosts.select("host", F.explode(name_ends(F.col("host"))).alias("end"))
    rank = F.struct((-F.length("rule")).alias("less"), (-F.length("end")).alias("shorter"), "rule", "path", "verdict")
    return ends.join(table, "end").groupBy("host").agg(F.sort_array(F.collect_list(rank)).alias("rules"))


def with_domains(hosts: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """hosts with domain and suffix of each (distinct) host, without port."""
    bare = F.regexp_replace("host", ":[0-9]*$", "")
    numeric = bare.rlike("^[0-9.]+$")
    table = hosts.sparkSession.createDataFrame([(s,) for s in suffixes], "end string")
    known = hosts.select("host", F.explode(name_ends(bare)).alias("end")).join(table, "end").groupBy("host").agg(F.max(F.struct(F.length("end").alias("n"), "end"))["end"].alias("known"))
    last = F.coalesce("known", F.substring_index(bare, ".", -1))
    labels = F.size(F.split(last, r"\."))
    own = F.split(bare, r"\.")
    domain = F.array_join(F.slice(own, F.greatest(F.size(own) - labels, F.lit(1)), F.size(own)), ".")
    return hosts.join(known, "host", "left").withColumns({"domain": F.when(numeric, bare).otherwise(domain), "suffix": F.when(numeric, bare).otherwise(last)}).drop("known")


def strength(rows: DataFrame, n: str, bad: str, mean: str) -> float:
    """Prior strength (alpha + beta) of a level by the method of moments, 1e-3 to 1e4. rows: members with their parent's mean."""
    m = F.col(mean)
    noise = m * (1 - m)
    got = rows.where(F.col(n) > 0).agg(
        F.sum(F.col(n) * F.pow(F.col(bad) / F.col(n) - m, 2)).alias("s"), F.sum(noise).alias("v"), F.sum(noise * (F.col(n) - 1)).alias("w")
    ).first()
    if not got["w"]:
        return 1.0
    rho = min(0.999, max(1e-4, (got["s"] - got["v"]) / got["w"]))
    return 1 / rho - 1


def host_reputation(counted: DataFrame, z: float, block_at: float, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """One row a host: n labelled, n bad, prior mean, posterior mean, bound, blocked. counted: host, n (labelled pages), bad_n (bad ones)."""
    hosts = materialize(with_domains(counted, suffixes), "hosts").withColumns({"n": F.col("n").cast("double"), "bad_n": F.col("bad_n").cast("double")})
    domains = materialize(hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("dn"), F.sum("bad_n").alias("db")), "domains")
    ends = materialize(domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("db").alias("sb")), "suffixes")
    whole = ends.agg(F.sum("sn").alias("n"), F.sum("sb").alias("b")).first()
    rate = ((whole["b"] or 0.0) + 0.5) / ((whole["n"] or 0.0) + 1.0)

    ends = ends.withColumn("m0", F.lit(rate))
    k = strength(ends, "sn", "sb", "m0")
    ends = ends.select("suffix", ((F.col("sb") + k * F.col("m0")) / (F.col("sn") + k)).alias("m1"))
    domains = domains.join(ends, "suffix")
    k = strength(domains, "dn", "db", "m1")
    domains = domains.select("suffix", "domain", ((F.col("db") + k * F.col("m1")) / (F.col("dn") + k)).alias("m2"))
    hosts = hosts.join(domains, ["suffix", "domain"])
    k = strength(hosts, "n", "bad_n", "m2")
    a, b = F.col("bad_n") + k * F.col("m2"), F.col("n") - F.col("bad_n") + k * (1 - F.col("m2"))
    mean = a / (a + b)
    bound = mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1))
    blocked = (bound > block_at) if whole["n"] else F.lit(False)
    return hosts.select("host", "domain", "suffix", "n", "bad_n", F.col("m2").alias("prior"), mean.alias("bad_rate"), bound.alias("bound"), blocked.alias("blocked"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], outcome: str, z: float = 1.645, block_at: float = 0.5, url_col: str = "url", suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """pages with host, path, rule, bad_rate, bound and verdict ("allow" or "block"). outcome: a column of 1 (bad), 0 or null.

    Columns of pages that have one of those names are replaced.
    """
    of_url, of_path, known = inner("host"), inner("path"), inner("known")
    host, path = url_parts(F.col(url_col))
    rows = pages.withColumns({of_url: host, of_path: path})
    counted = rows.groupBy(F.col(of_url).alias("host")).agg(F.count(outcome).alias("n"), F.coalesce(F.sum(F.col(outcome)), F.lit(0)).alias("bad_n"))
    counted = materialize(counted, "host-outcomes")
    hosts = host_reputation(counted, z, block_at, suffixes).join(rules_by_host(counted, rules), "host", "left")
    hosts = materialize(hosts.select(F.col("host").alias(of_url), F.struct("bad_rate", "bound", "blocked", "rules").alias(known)), "host-verdicts")
    judged = rows.join(hosts, of_url, "left")
    first = F.get(F.filter(F.col(known)["rules"], lambda r: F.col(of_path).startswith(r["path"])), F.lit(0))
    own = F.when(F.col(known)["blocked"], "block").otherwise("allow")
    return judged.withColumns(
        {"host": F.col(of_url), "path": F.col(of_path), "rule": first["rule"], "bad_rate": F.col(known)["bad_rate"], "bound": F.col(known)["bound"], "verdict": F.coalesce(first["verdict"], own)}
    ).drop(of_url, of_path, known)
