"""URL filters: fixed rules first, then the reputation of the host.

A host's share of bad pages is a beta-binomial posterior. Its prior is the
posterior of its registered domain, whose prior is that of the suffix, whose
prior is the share over all labelled pages. How strongly each level is drawn to
the one above is fitted from how much the groups of that level differ. A host is
blocked when the lower bound of its posterior exceeds a limit, so a host with
few labelled pages is not blocked for one bad page.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.text import once
from tallybrook.llm.shared import settled

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Suffixes of two labels under which domains are registered, as a default.
# Callers pass a longer list, such as a public one; suffixes of three labels may be in it.
DEEP_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")
# User names before a host, and a port after it.
BESIDE_NAME = r"^.*@|:[0-9]*$"
ADDRESS = r"^([0-9]{1,3}(\.[0-9]{1,3}){3}|\[.*\])$"
# The lower bound lies so many standard deviations under the middle (95 percent, one side).
DEVIATIONS = 1.645
MAX_BAD_SHARE = 0.5
# The strength of a prior, in pages, lies between these.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0


class UrlRule(NamedTuple):
    host: str
    path: str
    verdict: str

    def __str__(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
)


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """`row`, the given row, with `host` and `path` of its url; both empty without `://`."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(F.col(url), F.lit(""))
    found = F.struct(
        F.translate(F.regexp_extract(text, parts, 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(text, parts, 2).alias("path"),
    )
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns])
    return pages.select(row.alias("row"), once(found).alias("found")).select("row", "found.*")


def rule_found(rules: tuple[UrlRule, ...], host: Column, path: Column) -> Column:
    """(rule, verdict) of the longest rule that fits; null when none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(str(r))):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        said = F.struct(F.lit(str(rule)).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, said).otherwise(found)
    return found


def _tail(host: Column, suffixes: Collection[str], more: int) -> Column:
    """A host's longest known suffix, or its last label, with `more` labels before it.

    Users and ports are no part of it; an address is its own suffix and domain.
    """
    name = F.regexp_replace(host, BESIDE_NAME, "")
    out = F.substring_index(name, ".", -1 - more)
    for labels in (2, 3):
        known = [s for s in suffixes if s.count(".") == labels - 1]
        if known:
            out = F.when(F.substring_index(name, ".", -labels).isin(*known), F.substring_index(name, ".", -labels - more)).otherwise(out)
    return F.when(name.rlike(ADDRESS), name).otherwise(out)


def suffix_of(host: Column, suffixes: Collection[str] = DEEP_SUFFIXES) -> Column:
    return _tail(host, suffixes, 0)


def domain_of(host: Column, suffixes: Collection[str] = DEEP_SUFFIXES) -> Column:
    """The suffix and one label more; a host without one is its own domain."""
    return _tail(host, suffixes, 1)


def _strength(groups: DataFrame) -> float:
    """The prior's weight in pages, by moments, from (n, bad, prior) per group."""
    p, n = F.col("prior"), F.col("n")
    sums = groups.agg(
        F.sum(F.pow(F.col("bad") - n * p, 2)).alias("seen"),
        F.sum(n * p * (1 - p)).alias("least"),
        F.sum(n * (n - 1) * p * (1 - p)).alias("most"),
    ).first()
    if not sums["most"]:
        return LEAST_STRENGTH
    alike = (sums["seen"] - sums["least"]) / sums["most"]
    return MOST_STRENGTH if alike <= 0 else min(MOST_STRENGTH, max(LEAST_STRENGTH, 1 / alike - 1))


def reputations(
    hosts: DataFrame, deviations: float = DEVIATIONS, suffixes: Collection[str] = DEEP_SUFFIXES
) -> DataFrame:
    """(host, n, bad, alpha, beta, mean, lower) from (host, n, bad), one row per host.

    Groups are summed from the level below, so each level costs no more than the
    hosts do. Without a labelled page anywhere every mean is 0.
    """
    whole = hosts.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).first()
    base = (whole["bad"] or 0) / whole["n"] if whole["n"] else 0.0
    domains = hosts.groupBy(domain_of(F.col("host"), suffixes).alias("domain")).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    of_all = domains.groupBy(suffix_of(F.col("domain"), suffixes).alias("suffix"))
    of_all = of_all.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def shrunk(groups: DataFrame, name: str) -> DataFrame:
        weight = F.lit(_strength(groups))
        mean = (F.col("bad") + weight * F.col("prior")) / (F.col("n") + weight)
        return groups.select(F.col(name).alias(f"_{name}"), mean.alias("prior"))

    of_suffix = shrunk(of_all.withColumn("prior", F.lit(base)), "suffix")
    under = domains.withColumn("_suffix", suffix_of(F.col("domain"), suffixes)).join(of_suffix, "_suffix")
    of_domain = shrunk(under, "domain")
    under = hosts.withColumn("_domain", domain_of(F.col("host"), suffixes)).join(of_domain, "_domain")
    weight = F.lit(_strength(under))
    alpha = F.col("bad") + weight * F.col("prior")
    beta = F.col("n") - F.col("bad") + weight * (1 - F.col("prior"))
    # The bound is taken of the log odds, whose posterior is nearer to normal for few pages.
    log_odds = F.log(F.col("alpha") / F.col("beta")) - deviations * F.sqrt(1 / F.col("alpha") + 1 / F.col("beta"))
    lower = F.when(F.col("alpha") <= 0, 0.0).when(F.col("beta") <= 0, 1.0).otherwise(1 / (1 + F.exp(-log_odds)))
    return (
        under.select("host", "n", "bad", alpha.alias("alpha"), beta.alias("beta"))
        .withColumn("mean", F.col("alpha") / (F.col("alpha") + F.col("beta")))
        .withColumn("lower", lower)
    )


def judged(
    pages: DataFrame,
    rules: tuple[UrlRule, ...] = RULES,
    url: str = "url",
    bad: str = "bad",
    max_bad_share: float = MAX_BAD_SHARE,
    suffixes: Collection[str] = DEEP_SUFFIXES,
) -> DataFrame:
    """`row` (without `bad`), `host`, `path`, `rule`, `verdict`, `lower` for every page.

    `bad` is a page's label: true, false, or null where there is none. The rule
    decides where one fits; elsewhere a page is blocked when the posterior bound
    of its host exceeds `max_bad_share`. Null urls and urls without `://` have
    the empty host, which is a host like others; a host of any length, or with a
    port, or an address, is one too. Repeated rows are judged and counted each, an empty
    table gives none, and columns of the page named like the added ones stay in `row`.
    `suffixes` are those of more than one label. Pages are counted per host with
    map-side combine; the join that brings the verdict back sees one row per
    host, and a hot host's pages are split by adaptive execution.
    """
    parsed = with_host_and_path(pages, url)
    hosts = settled(
        parsed.groupBy("host").agg(
            F.count(F.col("row")[bad]).alias("n"),
            F.coalesce(F.sum(F.col("row")[bad].cast("int")), F.lit(0)).alias("bad"),
        ),
        "hosts",
    )
    known = reputations(hosts, suffixes=suffixes).select(F.col("host").alias("_host"), "lower")
    joined = parsed.join(known, F.col("host") == F.col("_host"), "left")
    lower = F.coalesce(F.col("lower"), F.lit(0.0))
    method = F.when(lower > max_bad_share, "block").otherwise("allow")
    ruled = joined.withColumn("_ruled", rule_found(rules, F.col("host"), F.col("path")))
    kept = [F.col("row")[c].alias(c) for c in pages.columns if c != bad]
    return ruled.select(
        F.struct(*kept).alias("row"),
        "host",
        "path",
        F.col("_ruled.rule").alias("rule"),
        F.coalesce(F.col("_ruled.verdict"), method).alias("verdict"),
        lower.alias("lower"),
    )


def _tail_sql(host: str, more: int) -> str:
    """`_tail` in SQL, for suffixes of two labels."""
    name = f"regexp_replace({host}, '{BESIDE_NAME}', '', 'g')"
    last = lambda n: f"array_to_string(list_slice(string_split({name}, '.'), -{n}, -1), '.')"
    listed = ", ".join(f"'{s}'" for s in DEEP_SUFFIXES)
    return (
        f"CASE WHEN regexp_matches({name}, '{ADDRESS}') THEN {name} "
        f"WHEN {last(2)} IN ({listed}) THEN {last(2 + more)} ELSE {last(1 + more)} END"
    )


# The same in SQL.
_LEVELS = reduce(
    lambda sql, level: f"""{sql},
  {level[0]}_in AS (SELECT g.*, {level[2]} AS prior FROM {level[0]} g {level[3]}),
  {level[0]}_k AS (
    SELECT CASE WHEN coalesce(m, 0) = 0 THEN 1.0 WHEN s - l <= 0 THEN 1000.0
                ELSE least(1000.0, greatest(1.0, m / (s - l) - 1)) END AS k
    FROM (SELECT sum((bad - n * prior) ** 2) AS s, sum(n * prior * (1 - prior)) AS l,
                 sum(n * (n - 1) * prior * (1 - prior)) AS m FROM {level[0]}_in)),
  {level[0]}_out AS (
    SELECT {level[1]}, n, bad, bad + k * prior AS alpha, n - bad + k * (1 - prior) AS beta,
           alpha / (alpha + beta) AS mean FROM {level[0]}_in, {level[0]}_k)""",
    [
        ("suffixes", "suffix", "base", ", base"),
        ("domains", "domain", "u.mean", "JOIN suffixes_out u ON u.suffix = g.suffix"),
        ("hosts", "host", "u.mean", "JOIN domains_out u ON u.domain = g.domain"),
    ],
    "",
)
SQL = rf"""
WITH parsed AS (
  SELECT page_id, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(u, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM (SELECT page_id, coalesce(url, '') AS u FROM pages)),
known AS (SELECT doc_id, min(quality) = 0 AS bad FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad::INT), 0) AS bad,
         {_tail_sql("host", 1)} AS domain
  FROM parsed LEFT JOIN known ON doc_id = TRY_CAST(regexp_extract(path, '/([0-9]+)', 1) AS BIGINT)
  GROUP BY host),
domains AS (
  SELECT domain, sum(n) AS n, sum(bad) AS bad, {_tail_sql("domain", 0)} AS suffix FROM hosts GROUP BY domain),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
base AS (SELECT CASE WHEN sum(n) > 0 THEN sum(bad) / sum(n) ELSE 0 END AS base FROM hosts){_LEVELS},
ruled AS (
  SELECT p.*, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parsed p)
SELECT r.page_id, r.host, r.path, r.rule,
       CASE WHEN r.rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN r.rule IS NOT NULL THEN 'block'
            WHEN alpha <= 0 THEN 'allow' WHEN beta <= 0 THEN 'block'
            WHEN 1 / (1 + exp({DEVIATIONS} * sqrt(1 / alpha + 1 / beta) - ln(alpha / beta))) > {MAX_BAD_SHARE}
            THEN 'block' ELSE 'allow' END AS verdict
FROM ruled r JOIN hosts_out USING (host)
"""
