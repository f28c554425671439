"""URL filters: fixed rules first, then host reputation by empirical Bayes.

Page outcomes (good or bad) are counted per host, registered domain (the last
two labels) and suffix (the last label). The share of good pages of each level
is shrunk towards that of the level above with a beta-binomial prior whose
strength is estimated from the data by moments, one strength per level. A page
is blocked where even the upper posterior bound of its host's share of good
pages is below a threshold; hosts nobody has labelled stay near their domain's
share and are allowed unless that is surely bad.

Everything is DataFrame operations. Outcomes are summed before each shuffle, so
a host with a third of all pages is one row per task; the join that brings the
reputation back to the pages is on the host and can be split by adaptive
execution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmill.scratch import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The rules of the registered query, longest wins.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; otherwise empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; otherwise empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none fits.

    The rules become one CASE expression; they are a parameter of tens of
    entries, not a table.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _strength(children: DataFrame, low: float = 1.0, high: float = 1000.0) -> float:
    """Prior strength (pseudo-pages) of one level by moments.

    ``children`` has n, good and the prior share ``base`` of each group. The
    excess of the squared deviations over binomial noise gives the correlation
    rho within groups; the strength is 1 / rho - 1, held between the bounds. A
    level without spread or without data gets the upper bound. One row of four
    sums reaches the driver.
    """
    share = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("base")))
    spread = F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - share, 2) / (share * (1 - share)))
    found = children.filter("n > 0").agg(spread.alias("s"), F.count(F.lit(1)).alias("g"), F.sum("n").alias("n")).first()
    room = (found["n"] or 0) - found["g"]
    rho = (found["s"] - found["g"]) / room if room > 0 else 0.0
    return high if rho <= 0 else min(high, max(low, 1 / min(rho, 1.0) - 1))


def host_reputation(hosts: DataFrame) -> DataFrame:
    """From one row per host (host, n, good) to (host, n, alpha, beta), the posterior of its share of good pages.

    ``n`` outcomes, ``good`` of them good; hosts without outcomes take the
    prior of their domain.
    """
    mean = (F.col("good") + F.col("m") * F.col("base")) / (F.col("n") + F.col("m"))
    sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    by_domain = hosts.groupBy(F.substring_index("host", ".", -2).alias("domain")).agg(*sums)
    by_suffix = by_domain.groupBy(F.substring_index("domain", ".", -1).alias("suffix")).agg(*sums)
    total = by_suffix.agg(*sums).first()
    top = ((total["good"] or 0.0) + 1) / ((total["n"] or 0) + 2)

    suffixes = by_suffix.withColumn("base", F.lit(top))
    suffixes = suffixes.withColumn("m", F.lit(_strength(suffixes))).select("suffix", mean.alias("base"))
    domains = by_domain.withColumn("suffix", F.substring_index("domain", ".", -1)).join(suffixes, "suffix")
    domains = domains.withColumn("m", F.lit(_strength(domains))).select("domain", mean.alias("base"))
    own = hosts.withColumn("domain", F.substring_index("host", ".", -2)).join(domains, "domain")
    m = F.lit(_strength(own))
    return own.select("host", "n", (F.col("good") + m * F.col("base")).alias("alpha"), (F.col("n") - F.col("good") + m * (1 - F.col("base"))).alias("beta"))


def url_verdicts(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    url: str = "url",
    key: str = "page_id",
    outcome_key: str = "doc_id",
    outcome: str = "quality",
    least_good: float = 0.5,
    z: float = 1.645,
) -> DataFrame:
    """Return per row of ``pages``: key, host, path, rule, verdict, n_labelled, good_upper.

    ``outcomes`` has (outcome_key, outcome 0/1); several of one key count once
    with their mean, null keys and outcomes do not count. ``good_upper`` is the
    upper posterior bound (mean plus ``z`` standard deviations of the beta
    posterior, at most 1) of the host's share of good pages; without a fitting
    rule the verdict is block where it is below ``least_good``. A null url, or
    one without ``://``, has an empty host and path; such pages share one
    reputation. Repeated rows each get their row and count each. Other columns
    are not read. Without any outcome every page without a rule is allowed.
    """
    judged = outcomes.select(F.col(outcome_key).alias("key"), F.col(outcome).cast("double").alias("good")).dropna()
    judged = judged.groupBy("key").agg(F.avg("good").alias("good"))
    located = pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    sums = [F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0.0)).alias("good")]
    hosts = cut(located.select("key", "host").join(judged, "key", "left").groupBy("host").agg(*sums), "hosts")
    a, b = F.col("alpha"), F.col("beta")
    upper = a / (a + b) + z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    reputation = host_reputation(hosts).select("host", F.col("n").alias("n_labelled"), F.round(F.least(F.lit(1.0), upper), 6).alias("good_upper"))
    rule, fixed = rule_of(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("good_upper") < least_good, F.lit("block")).otherwise(F.lit("allow"))
    return located.join(reputation, "host").select(F.col("key").alias(key), "host", "path", rule.alias("rule"), F.coalesce(fixed, learned).alias("verdict"), "n_labelled", "good_upper")


_LEVEL = """
SELECT {name}, n, good, base, coalesce(CASE WHEN room > 0 AND s > g THEN least(1000.0, greatest(1.0, 1 / least((s - g) / room, 1.0) - 1)) END, 1000.0) AS m
FROM {table}, (
    SELECT sum(CASE WHEN n > 0 THEN n * pow(good / n - p, 2) / (p * (1 - p)) END) AS s,
           count(CASE WHEN n > 0 THEN 1 END) AS g, sum(n) - count(CASE WHEN n > 0 THEN 1 END) AS room
    FROM (SELECT *, greatest(1e-6, least(1 - 1e-6, base)) AS p FROM {table})
)"""

SQL = f"""
WITH located AS (
    SELECT page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}'), '') AS host,
           coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
    FROM pages
), judged AS (
    SELECT doc_id, avg(CAST(quality AS DOUBLE)) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1
), hosts AS (
    SELECT host, count(good) AS n, coalesce(sum(good), 0.0) AS good, array_to_string(string_split(host, '.')[-2:], '.') AS domain
    FROM located LEFT JOIN judged ON page_id = doc_id GROUP BY host
), by_domain AS (
    SELECT domain, string_split(domain, '.')[-1] AS suffix, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY domain
), s0 AS (
    SELECT *, (sum(good) OVER () + 1) / (sum(n) OVER () + 2) AS base
    FROM (SELECT suffix, sum(n) AS n, sum(good) AS good FROM by_domain GROUP BY suffix)
), s1 AS ({_LEVEL.format(name="suffix", table="s0")}
), d0 AS (
    SELECT d.domain, d.n, d.good, (s1.good + m * s1.base) / (s1.n + m) AS base FROM by_domain d JOIN s1 ON d.suffix = s1.suffix
), d1 AS ({_LEVEL.format(name="domain", table="d0")}
), h0 AS (
    SELECT h.host, h.n, h.good, (d1.good + m * d1.base) / (d1.n + m) AS base FROM hosts h JOIN d1 ON h.domain = d1.domain
), h1 AS ({_LEVEL.format(name="host", table="h0")}
), r AS (
    SELECT host, n, good + m * base AS a, n - good + m * (1 - base) AS b FROM h1
), bound AS (
    SELECT host, n, round(least(1.0, a / (a + b) + 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))), 6) AS good_upper FROM r
), fit AS (
    SELECT l.*, b.n, b.good_upper,
        CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
             WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
             WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
             WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
             WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
    FROM located l JOIN bound b USING (host)
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN good_upper < 0.5 THEN 'block' ELSE 'allow' END AS verdict,
       CAST(n AS BIGINT) AS n_labelled, good_upper
FROM fit
"""
