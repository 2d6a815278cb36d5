"""Judge page URLs: list rules first, else an empirical-Bayes reputation of the host.

Labelled pages give each host, registered domain and public suffix a number of
outcomes and of bad ones.  Each level's rate is shrunk towards the rate of the
level above by a beta-binomial prior, whose strength is estimated from the
spread of the level's own rates (method of moments on the intraclass
correlation).  A page without a rule is blocked when the lower posterior bound
of its host's bad rate is above a limit.

Cases: a null url or one without ``://`` has empty host and path and is judged
as one host; a host without a labelled page takes the rate of its domain, else
of its suffix, else the overall one; a page label counts if quality or toxic is
known; repeated labels of a page count each; with no labels nothing is known
(allow); an empty table gives an empty result; other columns are not read.  A host with very
many pages is one row of the reputation table, joined on the host, and its
pages are summed before the shuffle.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_checked, stage

#: (pattern as host + path, verdict)
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

#: Suffixes of two labels below which names are registered; others are one label long.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp", "ne.jp", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr", "co.za")

#: A page is blocked when the bad rate of its host is above LIMIT with Z standard deviations to spare.
LIMIT, Z = 0.4, 1.645


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) as text after the first ``://``; both empty without one."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(pattern, verdict) of the longest rule that fits, or nulls: its host or a subdomain, and its path as a prefix."""
    pattern = verdict = F.lit(None).cast("string")
    for text, v in sorted(rules, key=lambda r: len(r[0])):
        h, p = text[: text.index("/")], text[text.index("/") :]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        pattern, verdict = F.when(fits, F.lit(text)).otherwise(pattern), F.when(fits, F.lit(v)).otherwise(verdict)
    return pattern, verdict


def levels(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host; user names and ports are left off."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    two = F.substring_index(name, ".", -2)
    is_two = two.isin(*TWO_LABEL_SUFFIXES)
    return F.when(is_two, F.substring_index(name, ".", -3)).otherwise(two), F.when(is_two, two).otherwise(F.substring_index(name, ".", -1))


def _strength(children: DataFrame) -> float:
    """The prior's strength 1/rho - 1 for a level with labelled rows (n, bad, parent mean m).

    rho, the correlation of outcomes within a row, is by the method of moments.
    """
    v = F.col("m") * (1 - F.col("m"))
    gap = F.col("bad") / F.col("n") - F.col("m")
    rho = (F.sum(F.col("n") * gap * gap) - F.sum(v)) / F.nullif(F.sum(v * (F.col("n") - 1)), F.lit(0.0))
    return children.agg((1 / F.least(F.greatest(F.coalesce(rho, F.lit(0.001)), F.lit(0.001)), F.lit(0.9)) - 1).alias("k")).first().k


def _shrink(children: DataFrame, k: float) -> DataFrame:
    """Rows (n, bad, parent mean m) with posterior ``mean`` and ``weight``."""
    mean = (F.col("bad") + k * F.col("m")) / (F.col("n") + k)
    return children.withColumn("mean", mean).withColumn("weight", F.col("n") + k)


def reputation(hosts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, lower): lower posterior bound of the bad rate of each of ``hosts``, from rows (host, bad) of labelled pages.

    A host without a labelled page has n = 0 and the prior of its domain, else of
    its suffix, else the overall rate; without any label the bound is null.
    """
    domain, suffix = levels(F.col("host"))
    seen = outcomes.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    host = hosts.select("host").distinct().join(seen, "host", "left").fillna(0, ["n", "bad"])
    host = stage(host.withColumn("domain", domain).withColumn("suffix", suffix), "hosts")
    up = lambda keys, df: df.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    dom = up(["domain", "suffix"], host.where("n > 0"))
    suf = up(["suffix"], dom)
    m = suf.agg(((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("m")).first().m
    if m is None:
        return host.select("host", F.lit(None).cast("double").alias("lower"))
    suf = suf.withColumn("m", F.lit(m))
    suf = stage(_shrink(suf, _strength(suf)).select("suffix", F.col("mean").alias("m")), "suffixes")
    suf = broadcast_checked(suf, suf.count())
    dom = dom.join(suf, "suffix")
    dom = _shrink(dom, _strength(dom)).select("domain", F.col("mean").alias("of_domain"))
    host = host.join(dom, "domain", "left").join(suf, "suffix", "left").withColumn("m", F.coalesce("of_domain", "m", F.lit(m)))
    host = _shrink(host, _strength(host.where("n > 0")))
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return host.select("host", (F.col("mean") - Z * sd).alias("lower"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, limit: float = LIMIT) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``."""
    url = pages.select("page_id", "url")
    host, path = split_url(F.col("url"))
    rows = url.select("page_id", host.alias("host"), path.alias("path"))
    known = labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").select(
        F.col("doc_id").alias("page_id"), F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0).alias("bad")
    )
    lower = reputation(rows, rows.join(known, "page_id").select("host", "bad"))
    pattern, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("lower") > limit, "block").otherwise("allow")
    return rows.join(lower, "host", "left").select("page_id", "host", "path", pattern.alias("rule"), F.coalesce(verdict, method).alias("verdict"))


def op6(spark, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return judge(read("pages"), read("labels"))


_TWO = ", ".join(f"'{x}'" for x in TWO_LABEL_SUFFIXES)
_RULE = "CASE {} END".format(
    " ".join(
        f"WHEN (host = '{t[: t.index('/')]}' OR ends_with(host, '.{t[: t.index('/')]}')) AND starts_with(path, '{t[t.index('/') :]}') THEN '{{{i}}}'"
        for i, (t, _) in sorted(enumerate(RULES), key=lambda x: -len(x[1][0]))
    )
)
_K = "1 / least(greatest(coalesce((sum(n * (bad / n - m) * (bad / n - m)) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0), 0.001), 0.001), 0.9) - 1"
SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
b AS (
  SELECT host, CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END AS bad
  FROM p JOIN labels ON page_id = doc_id WHERE quality IS NOT NULL OR toxic IS NOT NULL),
c AS (SELECT host, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM b GROUP BY host),
h0 AS (SELECT host, coalesce(n, 0) AS n, coalesce(bad, 0) AS bad, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS parts
       FROM (SELECT DISTINCT host FROM p) LEFT JOIN c USING (host)),
h1 AS (SELECT *, array_to_string(parts[-2:], '.') AS two FROM h0),
h AS (
  SELECT host, n, bad, CASE WHEN two IN ({_TWO}) THEN array_to_string(parts[-3:], '.') ELSE two END AS domain,
         CASE WHEN two IN ({_TWO}) THEN two ELSE parts[-1] END AS suffix FROM h1),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h WHERE n > 0 GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
g AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS m FROM s),
s1 AS (SELECT s.*, m FROM s, g), sk AS (SELECT {_K} AS k FROM s1),
s2 AS (SELECT suffix, (bad + k * m) / (n + k) AS m FROM s1, sk),
d1 AS (SELECT d.*, m FROM d JOIN s2 USING (suffix)), dk AS (SELECT {_K} AS k FROM d1),
d2 AS (SELECT domain, (bad + k * m) / (n + k) AS m FROM d1, dk),
h2 AS (SELECT h.*, coalesce(d2.m, s2.m, g.m) AS m FROM h LEFT JOIN d2 USING (domain) LEFT JOIN s2 USING (suffix), g WHERE EXISTS (FROM s)),
hk AS (SELECT {_K} AS k FROM h2 WHERE n > 0),
h3 AS (SELECT host, (bad + k * m) / (n + k) AS mean, n + k AS weight FROM h2, hk),
r AS (SELECT host, mean - {Z} * sqrt(mean * (1 - mean) / (weight + 1)) AS lower FROM h3)
SELECT page_id, host, path, {_RULE.format(*(t for t, _ in RULES))} AS rule,
       coalesce({_RULE.format(*(v for _, v in RULES))}, CASE WHEN lower > {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN r USING (host)
"""
