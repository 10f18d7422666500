"""URL rules, then empirical-Bayes host reputation where no rule fits.

Labelled page outcomes are counted per host. A host's share of good pages is
shrunk to its registered domain's, that to its suffix's, and that to the overall
share, each through a beta-binomial prior around the parent's mean. A prior's
strength is estimated from how far children with outcomes lie from their own
parent (moments, closed form), over parents with two such children or more. A
host is blocked if the upper bound of its posterior lies under the least share of
good pages that is accepted: only hosts that are surely bad go, and those without
outcomes get their parents' reputation.

Outcomes are summed per host before they are shuffled, so a host with a third of
all pages is one row; its verdict is joined back without hint, so that Spark
broadcasts a table of hosts only if its measured size allows and splits skewed
keys otherwise. Only three strengths and the overall share reach the driver.

User and port are no part of a domain. The suffix is the last label, or the last
two where a two-letter country code follows one of ``SECOND_LEVEL``; the registered
domain has one label more. An address of numbers, or in brackets, is its own
domain and suffix.

Defined results: a null URL, or one without ``://``, has an empty host and path,
fits no rule and gets the reputation of the empty host; repeated rows are judged
each; outcomes that are null or not 0/1 are not counted, and of several for one
page the least counts; without any outcome all hosts are allowed; a bound equal to
the least share is allowed; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scratch

#: The stated rules, each as verdict, host and path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
LEAST_GOOD = 0.5
#: Standard deviations between the posterior mean and its bound (95 %, one-sided).
BOUND = 1.645
STRENGTHS = (1.0, 1000.0)
#: Labels under which country codes register names.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gob", "gov", "gouv", "ltd", "ne", "net", "or", "org", "plc", "sch")
_ADDRESS, _SECOND = r"^([0-9.]+|\[.*)$", rf"(^|[.])({'|'.join(SECOND_LEVEL)})[.][a-z][a-z]$"
#: The last one, two or three labels of a name.
_LABELS = {1: r"[^.]*$", 2: r"([^.]*[.])?[^.]*$", 3: r"([^.]*[.])?([^.]*[.])?[^.]*$"}


def parsed(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z lower-cased, and path of a URL."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, of, start in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(of + start)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def registered(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), "[.]*(:[0-9]*)?$", "")
    last = {k: F.regexp_extract(bare, p, 0) for k, p in _LABELS.items()}

    def either(plain: Column, second: Column) -> Column:
        return F.when(bare.rlike(_ADDRESS), bare).when(bare.rlike(_SECOND), second).otherwise(plain)

    return either(last[2], last[3]), either(last[1], last[2])


def _strength(children: DataFrame) -> float:
    """Prior strength of children ``(n, g, prior, siblings)`` around their parents' means, from their spread."""
    n, m = F.col("n").cast("double"), F.col("prior")
    told = children.filter("n > 0 AND siblings > 1")
    found = told.agg(F.sum(n * (F.col("g") / n - m) * (F.col("g") / n - m)).alias("spread"), F.sum(m * (1 - m)).alias("chance"), F.sum(m * (1 - m) * (n - 1)).alias("room")).first()
    room, excess = found["room"] or 0.0, (found["spread"] or 0.0) - (found["chance"] or 0.0)
    return STRENGTHS[1] if room <= 0 or excess <= 0 else min(STRENGTHS[1], max(STRENGTHS[0], room / excess - 1))


def _totals(frame: DataFrame, *keys: str) -> DataFrame:
    """Outcomes by ``keys``, and how many children of each have some."""
    return frame.groupBy(*keys).agg(F.count_if(F.col("n") > 0).alias("siblings_below"), F.sum("n").alias("n"), F.sum("g").alias("g"))


def _shrunk(strength: float) -> Column:
    return (F.col("g") + strength * F.col("prior")) / (F.col("n") + strength)


def reputation(outcomes: DataFrame) -> DataFrame:
    """``host, posterior_mean, bound`` from ``outcomes (host, good)``; a null ``good`` only names the host."""
    domain, suffix = registered(F.col("host"))
    counts = outcomes.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("g"))
    hosts = scratch.table(counts.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    domains = scratch.table(_totals(hosts, "domain", "suffix"), "domains")
    suffixes = scratch.table(_totals(domains, "suffix"), "suffixes")
    whole = suffixes.agg(F.sum("n").alias("n"), F.sum("g").alias("g"), F.count_if(F.col("n") > 0).alias("k")).first()
    share = ((whole["g"] or 0) + 1) / ((whole["n"] or 0) + 2)

    def below(parents: DataFrame, strength: float, key: str) -> DataFrame:
        """What children need of their parents: mean and number of siblings."""
        return parents.select(key, _shrunk(strength).alias("prior"), F.col("siblings_below").alias("siblings"))

    top = suffixes.withColumns({"prior": F.lit(share), "siblings": F.lit(whole["k"])})
    middle = scratch.table(domains.join(below(top, _strength(top), "suffix"), "suffix"), "domain-priors")
    low = scratch.table(hosts.join(below(middle, _strength(middle), "domain"), "domain"), "host-priors")
    strength = _strength(low)
    mean = _shrunk(strength)
    spread = F.sqrt(mean * (1 - mean) / (F.col("n") + strength + 1))
    return low.select("host", mean.alias("posterior_mean"), (mean + BOUND * spread).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, *, url: str = "url", id: str = "page_id", rules: list[tuple[str, str, str]] | None = None, least_good: float = LEAST_GOOD) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page; ``outcomes (page_id, good)`` are labelled results of pages."""
    host, path = parsed(pages[url])
    rows = pages.select(pages[id].alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = fitting(F.col("host"), F.col("path"), RULES if rules is None else rules)
    rows = rows.withColumn("rule", rule).withColumn("by_rule", verdict)
    known = outcomes.filter(F.col("good").isin(0, 1)).groupBy("page_id").agg(F.min("good").alias("good"))
    trusted = reputation(rows.select("page_id", "host").join(known, "page_id", "left").select("host", "good"))
    by_host = trusted.select("host", F.when(F.col("bound") < least_good, "block").otherwise("allow").alias("by_host"))
    return rows.join(by_host, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("by_rule", "by_host").alias("verdict"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of pages are read from ``labels``: the quality under the page's id."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), labels.select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good")))


def _rule_sql(rules: list[tuple[str, str, str]]) -> tuple[str, str]:
    tests = [(f"(host = '{of}' OR ends_with(host, '.{of}')) AND starts_with(path, '{start}')", of + start, kind) for kind, of, start in sorted(rules, key=lambda r: -len(r[1]) - len(r[2]))]
    return tuple("CASE " + " ".join(f"WHEN {t[0]} THEN '{t[k]}'" for t in tests) + " END" for k in (1, 2))


def _strength_sql(children: str) -> str:
    low, high = STRENGTHS
    return f"""(SELECT CASE WHEN coalesce(room, 0) <= 0 OR spread - chance <= 0 THEN {high} ELSE least({high}, greatest({low}, room / (spread - chance) - 1)) END
        FROM (SELECT sum(n * (g / n::DOUBLE - prior) * (g / n::DOUBLE - prior)) AS spread, sum(prior * (1 - prior)) AS chance, sum(prior * (1 - prior) * (n - 1)) AS room FROM {children} WHERE n > 0 AND siblings > 1))"""


def _registered_sql(plain: int, second: int) -> str:
    return f"CASE WHEN regexp_matches(bare, '{_ADDRESS}') THEN bare WHEN regexp_matches(bare, '{_SECOND}') THEN regexp_extract(bare, '{_LABELS[second]}') ELSE regexp_extract(bare, '{_LABELS[plain]}') END"


def _totals_sql(children: str, keys: str) -> str:
    return f"SELECT {keys}, count(*) FILTER (WHERE n > 0) AS siblings_below, sum(n)::BIGINT AS n, sum(g)::BIGINT AS g FROM {children} GROUP BY {keys}"


#: Common table expressions ending in ``verdicts (host, mean, bound, by_host)``, one row per host.
VERDICTS_SQL = f"""cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
known AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
counts AS (SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), '[.]*(:[0-9]*)?$', '') AS bare, count(good) AS n, coalesce(sum(good), 0)::BIGINT AS g FROM named LEFT JOIN known ON page_id = doc_id GROUP BY host),
hosts AS (SELECT host, n, g, {_registered_sql(2, 3)} AS domain, {_registered_sql(1, 2)} AS suffix FROM counts),
domains AS ({_totals_sql("hosts", "domain, suffix")}),
suffixes AS ({_totals_sql("domains", "suffix")}),
whole AS (SELECT (sum(g) + 1) / (sum(n) + 2)::DOUBLE AS share, count(*) FILTER (WHERE n > 0) AS k FROM suffixes),
high AS (SELECT suffix, siblings_below, n, g, share AS prior, k AS siblings FROM suffixes, whole),
ss AS (SELECT {_strength_sql("high")} AS s),
middle AS (SELECT d.*, (h.g + s * prior) / (h.n + s) AS prior, h.siblings_below AS siblings FROM domains d JOIN high h USING (suffix), ss),
sd AS (SELECT {_strength_sql("middle")} AS s),
low AS (SELECT h.host, h.n, h.g, (m.g + s * prior) / (m.n + s) AS prior, m.siblings_below AS siblings FROM hosts h JOIN middle m USING (domain), sd),
sh AS (SELECT {_strength_sql("low")} AS s),
means AS (SELECT host, (g + s * prior) / (n + s) AS mean, n + s AS weight FROM low, sh),
bounds AS (SELECT host, mean, mean + {BOUND} * sqrt(mean * (1 - mean) / (weight + 1)) AS bound FROM means),
verdicts AS (SELECT *, CASE WHEN bound < {LEAST_GOOD} THEN 'block' ELSE 'allow' END AS by_host FROM bounds)"""

ORACLE_SQL = f"""WITH {VERDICTS_SQL},
ruled AS (SELECT *, {_rule_sql(RULES)[0]} AS rule, {_rule_sql(RULES)[1]} AS by_rule FROM named)
SELECT page_id, host, path, rule, coalesce(by_rule, by_host) AS verdict FROM ruled LEFT JOIN verdicts USING (host)"""
