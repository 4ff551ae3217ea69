"""URL filter by rules and by empirical-Bayes host reputation, in DataFrame functions only.

Labelled page outcomes are counted per host, registered domain and suffix. The rate of
each level is shrunk towards the level above it (host to domain, domain to suffix, suffix
to the whole) with a beta prior whose strength is estimated from the spread of the
groups of that level (the moments of the beta-binomial). A host is blocked when the lower
posterior bound of its rate of bad pages exceeds a threshold, so a few bad pages on a
little-known host do not condemn it.

Pages are counted with map-side sums. Everything per host (rules that may fit, posterior)
is one row, so the pages meet it in one equi-join whose hot side adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import lower_ascii, stored, table

#: (verdict, host, path): fits the host and its subdomains where the path starts so.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
BOUND = 0.5  # blocked when the lower bound of the rate of bad pages exceeds this
Z = 1.645  # one-sided 95 % bound
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.in")
WEAKEST, STRONGEST = 1.0, 1e4  # limits of a prior's strength, in pages


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty where the url is null or has no ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def suffix(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def registered_domain(host: Column) -> Column:
    three = F.substring_index(host, ".", -3)
    return F.when(F.substring_index(host, ".", -2).isin(*TWO_LABEL_SUFFIXES), three).otherwise(
        F.substring_index(host, ".", -2)
    )


def prior_strength(groups: DataFrame) -> DataFrame:
    """One row: the beta prior's strength k, from the groups' n and bad (method of moments).

    Var(bad/n) = m(1-m)/n * (1 + (n-1)/(k+1)). No spread beyond the binomial gives STRONGEST,
    no usable group WEAKEST.
    """
    mean = F.sum("bad") / F.sum("n")
    total = groups.agg(
        F.count("*").alias("g"),
        F.sum("n").alias("n"),
        mean.alias("m"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("pp"),
    )
    binomial = F.col("m") * (1 - F.col("m"))
    spread = F.col("pp") - F.col("n") * F.col("m") * F.col("m")  # sum of n (p - m)^2
    excess = spread - binomial * (F.col("g") - 1)
    room = binomial * (F.col("n") - F.col("nn") / F.col("n") - (F.col("g") - 1))
    share = F.when((room > 0) & (excess > 0), F.least(excess / room, F.lit(1.0)))
    k = F.when(share.isNotNull(), 1 / share - 1).when(F.col("g") > 1, F.lit(STRONGEST)).otherwise(F.lit(WEAKEST))
    return total.select(F.greatest(F.lit(WEAKEST), F.least(F.lit(STRONGEST), k)).alias("k"))


def reputation(hosts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Posterior per host: host, n, bad, rate, bound.

    hosts: distinct ``host``. outcomes: host and bad (0 or 1), one row per labelled page;
    null outcomes count for nothing. A host without a labelled page has the posterior of
    its domain; without any label the rate is 0.5 with little weight.
    """
    counts = (
        outcomes.where("bad is not null and host <> ''")
        .groupBy("host")
        .agg(F.count("*").cast("double").alias("n"), F.sum("bad").cast("double").alias("bad"))
        .withColumns({"domain": registered_domain(F.col("host")), "suffix": suffix(F.col("host"))})
    )
    # One row per labelled host, written once: every level and every prior reads it.
    counted = stored(hosts.sparkSession, counts, "host-counts")
    add = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = counted.groupBy("domain", "suffix").agg(*add)
    suffixes = domains.groupBy("suffix").agg(*add)
    whole = suffixes.agg(
        ((F.coalesce(F.sum("bad"), F.lit(0.0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0.0)) + 2)).alias("m")
    )

    def level(below: DataFrame, name: str, above: Column) -> DataFrame:
        """The group's rate shrunk towards the rate above it."""
        k = prior_strength(below).scalar()
        return below.select(name, ((F.col("bad") + k * above) / (F.col("n") + k)).alias(f"{name}_rate"))

    top = whole.scalar()
    suffix_rate = level(suffixes, "suffix", top)
    above_domain = domains.join(suffix_rate, "suffix")
    k_domain = prior_strength(domains).scalar()
    domain_rate = above_domain.select(
        "domain", ((F.col("bad") + k_domain * F.col("suffix_rate")) / (F.col("n") + k_domain)).alias("domain_rate")
    )
    named = hosts.select(
        "host", registered_domain(F.col("host")).alias("domain"), suffix(F.col("host")).alias("suffix")
    )
    prior = F.coalesce("domain_rate", "suffix_rate", top)
    k = prior_strength(counted).scalar()
    a = F.col("bad") + k * F.col("prior")
    b = F.col("n") - F.col("bad") + k * (1 - F.col("prior"))
    rate = a / (a + b)
    return (
        named.join(domain_rate, "domain", "left")
        .join(suffix_rate, "suffix", "left")
        .join(counted.select("host", "n", "bad"), "host", "left")
        .withColumn("prior", prior)
        .fillna(0.0, ["n", "bad"])
        .select(
            "host",
            "n",
            "bad",
            rate.alias("rate"),
            F.greatest(F.lit(0.0), rate - Z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))).alias("bound"),
        )
    )


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. rules is a bounded list."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    rule = verdict = None
    for judged, at, start in ordered:
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(start)
        rule = F.when(fits, at + start) if rule is None else rule.when(fits, at + start)
        verdict = F.when(fits, judged) if verdict is None else verdict.when(fits, judged)
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, bound: float = BOUND) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_rate and bad_bound of every page.

    pages: page_id and url; outcomes: url and bad (0 or 1) of labelled pages. Other columns
    are ignored, whatever their names. A null url, or one without ``://``, has an empty
    host and path and is allowed: there is no host to judge. Repeated rows each give a
    row; an empty table gives none; without outcomes only the rules block.
    """
    host, path = split_url(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    judged = outcomes.select(host.alias("host"), F.col("bad").cast("int").alias("bad"))
    known = reputation(parts.select("host").where("host <> ''").distinct(), judged)
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    return (
        parts.join(known.select("host", "rate", F.col("bound").alias("bad_bound")), "host", "left")
        .withColumns({"rule": rule, "ruled": verdict})
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("ruled", F.when(F.col("bad_bound") > bound, "block").otherwise("allow")).alias("verdict"),
            F.col("rate").alias("bad_rate"),
            "bad_bound",
        )
    )


def labelled_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """url and bad: a page shows the document its path names; low quality or toxic is bad."""
    doc_id = F.regexp_extract("url", r"://[^/]*/[^/]*/(\d{1,18})", 1).try_cast("long")
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    return pages.select("url", doc_id.alias("doc_id")).join(
        labels.select("doc_id", bad.alias("bad")), "doc_id"
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    outcomes = labelled_outcomes(pages, table(spark, sf_dir, "labels"))
    return filter_urls(pages, outcomes).drop("bad_rate", "bad_bound")


def _strength_sql(groups: str) -> str:
    return f"""
    select greatest({WEAKEST}, least({STRONGEST}, case
        when room > 0 and excess > 0 then 1 / least(excess / room, 1.0) - 1
        when g > 1 then {STRONGEST} else {WEAKEST} end)) as k
    from (select g, pp - n * m * m - m * (1 - m) * (g - 1) as excess, m * (1 - m) * (n - nn / n - (g - 1)) as room
          from (select count(*) as g, sum(n) as n, sum(bad) / sum(n) as m, sum(n * n) as nn, sum(bad * bad / n) as pp
                from {groups}))"""


_TWO = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
_LAST = "array_to_string(string_split(host, '.')[-{}:], '.')".format
_RULED = " ".join(
    f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{h}{p} {v}'"
    for v, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
)
ORACLE = rf"""
with parts as (
    select page_id, url,
           case when strpos(url, '://') > 0 then translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
           case when strpos(url, '://') > 0 then regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) else '' end as path,
           try_cast(regexp_extract(url, '://[^/]*/[^/]*/(\d{{1,18}})', 1) as bigint) as doc_id
    from pages
), counted as (
    select host, cast(count(*) as double) as n,
           cast(sum(case when quality = 0 or toxic = 1 then 1 else 0 end) as double) as bad
    from parts join labels using (doc_id) where host <> '' group by host
), hosts as (
    select host, case when {_LAST(2)} in ({_TWO}) then {_LAST(3)} else {_LAST(2)} end as domain,
           case when {_LAST(2)} in ({_TWO}) then {_LAST(2)} else {_LAST(1)} end as suffix
    from (select distinct host from parts where host <> '')
), domains as (
    select domain, suffix, sum(n) as n, sum(bad) as bad from counted join hosts using (host) group by all
), suffixes as (
    select suffix, sum(n) as n, sum(bad) as bad from domains group by all
), whole as (
    select (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) as m from suffixes
), ks as ({_strength_sql("suffixes")}), kd as ({_strength_sql("domains")}), kh as ({_strength_sql("counted")}),
suffix_rate as (
    select suffix, (bad + (select k from ks) * (select m from whole)) / (n + (select k from ks)) as sr from suffixes
), domain_rate as (
    select domain, (bad + (select k from kd) * sr) / (n + (select k from kd)) as dr
    from domains join suffix_rate using (suffix)
), posterior as (
    select host, coalesce(bad, 0) + k * prior as a, coalesce(n, 0) - coalesce(bad, 0) + k * (1 - prior) as b
    from (select hosts.host, n, bad, coalesce(dr, sr, (select m from whole)) as prior, (select k from kh) as k
          from hosts left join domain_rate using (domain) left join suffix_rate using (suffix)
          left join counted on counted.host = hosts.host)
), ruled as (
    select page_id, host, path, case {_RULED} end as found from parts
)
select page_id, ruled.host as host, path, split_part(found, ' ', 1) as rule,
       coalesce(split_part(found, ' ', 2), case
           when a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > {BOUND} then 'block'
           else 'allow' end) as verdict
from ruled left join posterior on posterior.host = ruled.host
"""
