"""URL filter: a rule list first, then the reputation of the host.

Reputation is empirical Bayes. The labelled pages of a host are few, so its rate of bad pages is
shrunk to that of its registered domain, that to its public suffix, and that to all pages. Each
level is beta-binomial: the prior's mean is the parent's posterior mean, its strength is
estimated from how much the groups of that level differ (method of moments). A page is blocked
if the lower posterior bound of its host's rate is above ``max_bad_rate``.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm.common import ascii_lower, materialize, table


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


#: The contract's rules, and the suffixes of more than one label in its pages.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
SUFFIXES = ("example.com", "example.net", "example.org")

MAX_BAD_RATE = 0.3
#: Standard deviations below the posterior mean: one-sided 95 %.
BOUND_Z = 1.645
#: Range of the estimated correlation within a group; strength is 1 / correlation - 1.
LEAST_CORRELATION, MOST_CORRELATION = 1e-4, 0.99

LEVELS = ("suffix", "domain", "host")
MAX_RULES = 1_000


def url_host(url: Column) -> Column:
    """What is between the first ``://`` and the next of ``/?#``; empty without one."""
    return ascii_lower(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", 2), F.lit(""))


def public_suffix(host: Column, suffixes: Sequence[str] = ()) -> Column:
    """The longest listed suffix of ``host``, else its last label."""
    out = F.substring_index(host, ".", -1)
    for suffix in sorted(suffixes, key=len):
        out = F.when((host == suffix) | host.endswith("." + suffix), F.lit(suffix)).otherwise(out)
    return out


def registered_domain(host: Column, suffix: Column) -> Column:
    """The suffix and one label before it; the host itself if it has none."""
    before = F.substring(host, F.lit(1), F.length(host) - F.length(suffix) - 1)
    return F.when(host == suffix, host).otherwise(F.concat_ws(".", F.substring_index(before, ".", -1), suffix))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (of equal ones, that of the longest host)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules: join them by host instead")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host) + len(r.path), len(r.host))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.host + rule.path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def _correlation(groups: DataFrame) -> float:
    """Correlation of two pages of a group beyond the prior mean ``m``; one number per level."""
    spread = F.col("m") * (1 - F.col("m"))
    excess = F.pow(F.col("k") - F.col("n") * F.col("m"), 2.0) - F.col("n") * spread
    pairs = F.col("n") * (F.col("n") - 1) * spread
    row = groups.agg(F.sum(excess).alias("excess"), F.sum(pairs).alias("pairs")).first()
    if not row.pairs:
        return LEAST_CORRELATION
    return min(max(row.excess / row.pairs, LEAST_CORRELATION), MOST_CORRELATION)


def reputation(outcomes: DataFrame, suffixes: Sequence[str] = (), z: float = BOUND_Z) -> DataFrame:
    """``host, suffix, domain, n, k, rate, low`` for each host of ``outcomes`` (host, bad).

    ``bad`` is 1, 0 or null (not labelled); a host without labels has its domain's rate. The
    rows are counted per host before anything else, so a host with a third of all pages is one
    row of each task; later steps work on hosts.
    """
    counted = outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("bigint").alias("k")
    )
    suffix = public_suffix(F.col("host"), suffixes)
    hosts = materialize(
        counted.withColumn("suffix", suffix).withColumn("domain", registered_domain(F.col("host"), F.col("suffix")))
    )
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    mean = total.k / total.n if total.n else 0.0
    parent, above = None, None
    for level in LEVELS:
        keys = list(LEVELS[: LEVELS.index(level) + 1])
        groups = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        if parent is None:
            groups = groups.withColumn("m", F.lit(mean))
        else:
            groups = groups.join(parent, above)
        groups = materialize(groups)
        strength = 1.0 / _correlation(groups) - 1.0
        a = F.col("m") * strength + F.col("k")
        size = F.lit(strength) + F.col("n")
        posterior = groups.withColumn("rate", a / size)
        parent, above = posterior.select(*keys, F.col("rate").alias("m")), keys
    variance = F.col("rate") * (1 - F.col("rate")) / (F.lit(strength) + F.col("n") + 1)
    return posterior.select(
        "host", "suffix", "domain", "n", "k", "rate", (F.col("rate") - z * F.sqrt(variance)).alias("low")
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule] = RULES,
    suffixes: Sequence[str] = (),
    max_bad_rate: float = MAX_BAD_RATE,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, by`` for each row of ``pages``.

    ``outcomes``: (host, bad), see ``reputation``. A null url or one without ``://`` has an
    empty host and path and is judged like any host; repeated rows are judged each; an empty
    table gives no rows; other columns are not read. Only blocked hosts are joined to the
    pages, and only to those that no rule fits; a hot host among them is a skewed join that
    adaptive execution splits.
    """
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.withColumns({"rule": name, "ruled": verdict})
    blocked = reputation(outcomes, suffixes).filter(F.col("low") > max_bad_rate)
    blocked = blocked.select(F.col("host").alias("blocked_host"))
    on = (F.col("host") == F.col("blocked_host")) & F.col("rule").isNull()
    by_host = F.when(F.col("blocked_host").isNotNull(), "block").otherwise("allow")
    return ruled.join(blocked, on, "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_host).alias("verdict"),
        F.when(F.col("rule").isNotNull(), "rule").otherwise("reputation").alias("by"),
    )


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad) of each page: bad if the document that its path numbers is toxic or poor."""
    number = F.regexp_extract(url_path(F.col("url")), "/([0-9]{1,18})", 1)
    bad = F.max(((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int")).alias("bad")
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(bad)
    numbered = pages.select(
        url_host(F.col("url")).alias("host"), F.when(number != "", number.cast("bigint")).alias("number")
    )
    return numbered.join(known, F.col("number") == F.col("doc_id"), "left").select("host", "bad")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    outcomes = page_outcomes(pages, table(spark, sf_dir, "labels"))
    return judge(pages, outcomes, suffixes=SUFFIXES)


def _sql_rules() -> tuple[str, str]:
    name = verdict = "CAST(NULL AS VARCHAR)"
    for r in sorted(RULES, key=lambda r: (len(r.host) + len(r.path), len(r.host))):
        fits = f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        name = f"CASE WHEN {fits} THEN '{r.host}{r.path}' ELSE {name} END"
        verdict = f"CASE WHEN {fits} THEN '{r.verdict}' ELSE {verdict} END"
    return name, verdict


def _sql_level(level: str, keys: str, prior: str) -> str:
    """Groups of a level, its strength, and its posterior, as common table expressions."""
    return f"""
    {level}_g AS (SELECT {keys}, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY {keys}),
    {level}_m AS ({prior}),
    {level}_s AS (
        SELECT 1 / coalesce(least(greatest(
            sum(pow(k - n * m, 2) - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0),
            {LEAST_CORRELATION}), {MOST_CORRELATION}), {LEAST_CORRELATION}) - 1 AS s FROM {level}_m),
    {level}_p AS (SELECT x.*, (m * s + k) / (s + n) AS rate, s FROM {level}_m x CROSS JOIN {level}_s)"""


ORACLE_SQL = f"""
WITH parsed AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
                     '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
           coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages),
known AS (SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY 1),
outcomes AS (
    SELECT host, bad FROM parsed
    LEFT JOIN known ON TRY_CAST(regexp_extract(path, '/([0-9]{{1,18}})', 1) AS BIGINT) = doc_id),
counted AS (
    SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k,
           coalesce(nullif(regexp_extract(host, '(^|[.])(example[.](com|net|org))$', 2), ''),
                    split_part(host, '.', -1)) AS suffix
    FROM outcomes GROUP BY host),
hosts AS (
    SELECT *, CASE WHEN host = suffix THEN host
              ELSE split_part(left(host, length(host) - length(suffix) - 1), '.', -1) || '.' || suffix END AS domain
    FROM counted),
{_sql_level('suffix', 'suffix', 'SELECT *, (SELECT sum(k) / sum(n) FROM hosts) AS m FROM suffix_g')},
{_sql_level('domain', 'suffix, domain', 'SELECT d.*, p.rate AS m FROM domain_g d JOIN suffix_p p USING (suffix)')},
{_sql_level('host', 'suffix, domain, host',
            'SELECT h.*, p.rate AS m FROM host_g h JOIN domain_p p USING (suffix, domain)')},
blocked AS (
    SELECT host FROM host_p WHERE rate - {BOUND_Z} * sqrt(rate * (1 - rate) / (s + n + 1)) > {MAX_BAD_RATE}),
ruled AS (SELECT *, {_sql_rules()[0]} AS rule, {_sql_rules()[1]} AS ruled FROM parsed)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN rule IS NOT NULL THEN 'rule' ELSE 'reputation' END AS by
FROM ruled
"""
