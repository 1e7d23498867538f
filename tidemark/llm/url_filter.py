"""URL filters: fixed rules, then the reputation of hosts by empirical Bayes.

Labelled pages are counted per host. Each level of suffix, registered domain and host has a beta-binomial prior whose mean is the
posterior mean of the level above and whose strength is estimated from the counts of its own level, so a host with few
labelled pages is judged by its domain and one with many by itself. A host is blocked if even the lower bound of its posterior
share of bad pages is above what is allowed. Every step is a DataFrame expression; the driver sees one row per level.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import query, table
from tidemark.session import stage

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
MOST_BAD = 0.15  # share of bad pages that a host may have
DEVIATIONS = 1.645  # the bound lies so many standard deviations below the mean: 95 %, one-sided
STRENGTH = 10.0  # of a prior, in pages, where the counts say nothing about it
LEAST_SPREAD = 1e-4  # of siblings around their parent (intra-class correlation): a prior counts as 9,999 pages at most
HOT_SHARE = 0.001  # of all pages: hosts beyond it, fewer than 1,000, are joined by broadcast


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` and ``path`` of a URL; both are empty without a URL or without ``://``."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return pages.withColumns({"host": _lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)), "path": F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)})


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits, else nulls. A rule is a host, subdomains included, and a start of the path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def with_levels(df: DataFrame, suffixes: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``name`` (the host without user and port), ``domain`` and ``suffix``.

    The suffix is the last label, or the longest of ``suffixes`` (such as ``co.uk``) that ends the name; the registered domain has one label
    more. Numeric addresses are their own domain, under the suffix ``ip``.
    """
    name = F.regexp_replace(F.regexp_replace("host", r"(?s)^.*@", ""), r":[0-9]*$", "")
    df = df.withColumn("name", name)
    suffix, domain = F.substring_index("name", ".", -1), F.substring_index("name", ".", -2)
    for s in sorted(suffixes, key=len):
        ends = F.col("name").endswith("." + s) | (F.col("name") == s)
        suffix, domain = F.when(ends, s).otherwise(suffix), F.when(ends, F.substring_index("name", ".", -(s.count(".") + 2))).otherwise(domain)
    numeric = F.col("name").rlike(r"^([0-9]+\.){3}[0-9]+$|^\[")
    return df.withColumns({"domain": F.when(numeric, F.col("name")).otherwise(domain), "suffix": F.when(numeric, F.lit("ip")).otherwise(suffix)})


def strength(groups: DataFrame) -> float:
    """How many pages the prior of a level counts as, by the moments of its groups (``n, k`` and ``prior``, the mean expected).

    Bad pages of a beta-binomial group vary by ``n p (1 - p) (1 + (n - 1) r)``; ``r`` is estimated over all groups, and the prior
    counts as ``1 / r - 1`` pages.
    """
    p, n, k = F.col("prior"), F.col("n").cast("double"), F.col("k").cast("double")
    row = groups.agg(F.sum((k - n * p) ** 2 - n * p * (1 - p)).alias("over"), F.sum(n * (n - 1) * p * (1 - p)).alias("scale")).first()
    if not row["scale"]:
        return STRENGTH
    return 1 / min(max(row["over"] / row["scale"], LEAST_SPREAD), 0.99) - 1


def reputations(hosts: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """``hosts`` (``name, domain, suffix, n, k``: labelled and bad pages) with ``bad_share``, the posterior mean, and ``bound``.

    Without any labelled page every host has the share 0.5 of a flat prior.
    """
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    known = F.lit((total["k"] + 0.5) / (total["n"] + 1.0))
    for level in ("suffix", "domain"):
        above = ["suffix"] if level == "domain" else []
        sums = hosts.groupBy(level, *above).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        sums = sums.withColumn("prior", known) if not above else sums.join(parents, above)
        sums = stage(sums, f"url-{level}")
        s = strength(sums)
        parents = sums.select(*above, level, ((F.col("k") + F.lit(s) * F.col("prior")) / (F.col("n") + F.lit(s))).alias("prior"))
    hosts = stage(hosts.join(parents, ["suffix", "domain"]), "url-hosts")
    s = strength(hosts)
    a, b = F.col("k") + F.lit(s) * F.col("prior"), F.col("n") - F.col("k") + F.lit(s) * (1 - F.col("prior"))
    mean = a / (a + b)
    bound = F.greatest(F.lit(0.0), mean - F.lit(deviations) * F.sqrt(mean * (1 - mean) / (a + b + 1)))
    return hosts.withColumns({"bad_share": mean, "bound": bound}).drop("prior")


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, *, rules: Sequence[tuple[str, str]] = RULES, suffixes: Sequence[str] = (),
    most_bad: float = MOST_BAD, deviations: float = DEVIATIONS,
) -> DataFrame:
    """Per row of ``pages`` (``page_id, url``): ``page_id, host, path, rule, verdict, bad_share, bound``.

    ``outcomes`` (``page_id, bad``: 0 or 1) labels some pages; several rows of one page count once, as bad if any is; nulls and
    labels of no page are ignored. ``rules`` are (verdict, host and start of the path); the longest that fits decides, of rules equally
    long the later one. Else a host is blocked if the lower bound of its share of bad pages is above ``most_bad``. Null URLs and URLs without
    ``://`` share the empty host, which has a reputation like any other. Repeated rows are judged, and counted, each. Other columns are
    ignored. Without rows the result is empty.
    """
    parts = with_levels(with_parts(pages.select("page_id", "url")), suffixes).select("page_id", "host", "path", "name", "domain", "suffix")
    labelled = outcomes.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.max("bad").cast("long").alias("bad"))
    counted = parts.select("page_id", "name").join(labelled, "page_id").groupBy("name").agg(F.count("*").alias("n"), F.sum("bad").alias("k"))
    hosts = parts.groupBy("name", "domain", "suffix").agg(F.count("*").alias("pages")).join(counted, "name", "left").fillna(0, ["n", "k"])
    known = stage(reputations(stage(hosts, "url-counts"), deviations).select("name", "pages", "bad_share", "bound"), "url-reputations")
    total = known.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0]
    # A frequent host would fill one task of the join: those hosts, by their share fewer than 1,000, are broadcast.
    hot, rest = known.where(F.col("pages") > total * HOT_SHARE), known.where(F.col("pages") <= total * HOT_SHARE)
    hot, rest = hot.drop("pages"), rest.drop("pages")
    judged = parts.join(F.broadcast(hot), "name").unionByName(parts.join(F.broadcast(hot), "name", "left_anti").join(rest, "name"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.col("bound") > most_bad, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_host).alias("verdict"), "bad_share", "bound")


def _level_sql(level: str, above: str, source: str) -> str:
    """CTEs of one level's strength and posterior means, for the SQL check."""
    return f"""
s_{level} AS (SELECT CASE WHEN scale IS NULL OR scale = 0 THEN {STRENGTH} ELSE 1 / least(greatest(over_ / scale, {LEAST_SPREAD}), 0.99) - 1 END AS s FROM (
  SELECT sum((k - n * prior) * (k - n * prior) - n * prior * (1 - prior)) AS over_, sum(n * (n - 1.0) * prior * (1 - prior)) AS scale FROM {source})),
p_{level} AS (SELECT {above}{level}, (k + s * prior) / (n + s) AS prior FROM {source}, s_{level})"""


SQL = rf"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
named AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM parts),
labelled AS (SELECT doc_id, max(1 - quality) AS bad FROM labels GROUP BY doc_id),
hosts AS (
  SELECT name, regexp_extract(name, '([^.]*[.])?[^.]*$', 0) AS domain, regexp_extract(name, '[^.]*$', 0) AS suffix, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS k
  FROM named LEFT JOIN labelled ON page_id = doc_id GROUP BY ALL),
g_suffix AS (SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT (sum(k) + 0.5) / (sum(n) + 1.0) FROM hosts) AS prior FROM hosts GROUP BY suffix),{_level_sql("suffix", "", "g_suffix")},
g_domain AS (SELECT hosts.suffix, domain, sum(n) AS n, sum(k) AS k, any_value(prior) AS prior FROM hosts JOIN p_suffix ON hosts.suffix = p_suffix.suffix GROUP BY hosts.suffix, domain),{_level_sql("domain", "suffix, ", "g_domain")},
g_host AS (SELECT name, n, k, prior FROM hosts JOIN p_domain ON hosts.suffix = p_domain.suffix AND hosts.domain = p_domain.domain),{_level_sql("host", "name, ", "g_host").replace("name, host", "name")},
beta AS (SELECT g_host.name, k + s * g_host.prior AS a, n - k + s * (1 - g_host.prior) AS b, p_host.prior AS mean FROM g_host JOIN p_host ON g_host.name = p_host.name, s_host),
known AS (SELECT name, greatest(0.0, mean - {DEVIATIONS} * sqrt(mean * (1 - mean) / (a + b + 1))) AS bound FROM beta),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM named)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN bound > {MOST_BAD} THEN 'block' ELSE 'allow' END AS verdict,
  round(bound + 3.1e-8, 6) AS bound
FROM ruled JOIN known ON ruled.name = known.name
"""


@query("op12_url_filter", SQL)
def op12(spark, sf_dir):
    """Outcomes are the quality labels of the same ids: a page is bad if its quality is 0."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    judged = judge_urls(table(spark, sf_dir, "pages"), outcomes)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round(F.col("bound") + 3.1e-8, 6).alias("bound"))
