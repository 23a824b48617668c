"""URL filters: fixed rules first, else the reputation of a host, shrunk towards what stands above it.

Columns and joins only. A host's share of bad pages has a beta prior around the estimate for its
registered domain, that one around the estimate for the suffix, and that one around the share of
all pages. How strong each prior is comes from the data: the spread of the children around their
parents beyond what counting alone gives (method of moments of the beta-binomial).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchbook.llm.common import stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Weakest and strongest correlation of pages under one parent that is believed.
LEAST_RHO, MOST_RHO = 1e-4, 0.9


def _rest(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _name(host: Column) -> Column:
    """Host without user and port; an address with digits only stays whole."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")


def _labels_of(host: Column, suffixes: Sequence[str], more: int) -> Column:
    """The suffix and ``more`` labels before it; the longest of ``suffixes`` that fits, else one label."""
    name = _name(host)
    found = F.substring_index(name, ".", -1 - more)
    for suffix in sorted(suffixes, key=lambda s: s.count(".")):  # the longest is asked first
        fits = (name == suffix) | name.endswith(f".{suffix}")
        own = F.substring_index(name, ".", -1 - suffix.count(".") - more)
        found = F.when(fits, own).otherwise(found)
    return F.when(name.rlike(r"^[0-9.]*$"), name).otherwise(found)


def suffix_of(host: Column, suffixes: Sequence[str] = ()) -> Column:
    return _labels_of(host, suffixes, 0)


def domain_of(host: Column, suffixes: Sequence[str] = ()) -> Column:
    """Registered domain: the suffix (the last label, or one of ``suffixes``) and a label before it."""
    return _labels_of(host, suffixes, 1)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule ``host/path`` that fits a host or one of its subdomains; else null."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        name, slash, start = rule.partition("/")
        on_host = (host == name) | host.endswith(f".{name}")
        found = F.when(on_host & path.startswith(slash + start), rule).otherwise(found)
    return found


def _digamma(x: Column) -> Column:
    y = x + 6
    series = F.ln(y) - 1 / (2 * y) - 1 / (12 * y * y) + 1 / (120 * F.pow(y, F.lit(4)))
    return series - reduce(lambda a, b: a + b, [1 / (x + i) for i in range(6)])


def _trigamma(x: Column) -> Column:
    y = x + 6
    series = 1 / y + 1 / (2 * y * y) + 1 / (6 * F.pow(y, F.lit(3))) - 1 / (30 * F.pow(y, F.lit(5)))
    return series + reduce(lambda a, b: a + b, [1 / ((x + i) * (x + i)) for i in range(6)])


def lower_bound(a: Column, b: Column, z: float) -> Column:
    """Lower credible bound of a beta(a, b) share, by the normal form of its logit."""
    logit = _digamma(a) - _digamma(b) - z * F.sqrt(_trigamma(a) + _trigamma(b))
    return 1 / (1 + F.exp(-logit))


def _strength(children: DataFrame) -> float:
    """Prior strength for rows ``n, bad, prior``: the one number that comes to the driver."""
    free = F.col("n") * F.col("prior") * (1 - F.col("prior"))
    row = children.agg(
        F.sum(F.pow(F.col("bad") - F.col("n") * F.col("prior"), F.lit(2))).alias("seen"),
        F.sum(free).alias("least"),
        F.sum(free * (F.col("n") - 1)).alias("most"),
    ).first()
    rho = (row["seen"] - row["least"]) / row["most"] if row["most"] else LEAST_RHO
    return 1 / min(max(rho, LEAST_RHO), MOST_RHO) - 1


def host_reputation(
    outcomes: DataFrame, z: float = 1.6448536269514722, suffixes: Sequence[str] = ()
) -> DataFrame:
    """Per host of ``host, bad`` (0 or 1, a row per labelled page): counts, estimate, bound.

    Returns ``host, n, n_bad, bad_rate, bad_bound`` and ``domain, suffix``: the posterior mean of
    the share of bad pages and its one-sided lower bound. Null outcomes do not count, but their
    hosts have rows: without outcomes a host has what its domain, else its suffix, else all pages
    say, and changes nothing for others. Counts are combined before each shuffle, so one host
    with a third of all pages is one row a task.
    """
    hosts = stage(
        outcomes.groupBy("host")
        .agg(
            F.count("bad").alias("n"),
            F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad"),
        )
        .withColumns({
            "domain": domain_of(F.col("host"), suffixes),
            "suffix": suffix_of(F.col("host"), suffixes),
        }),
        "hosts",
    )
    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    total = hosts.agg(*counts).first()
    share = ((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2)

    def estimated(level: DataFrame, name: str) -> tuple[DataFrame, float]:
        k = _strength(level)
        mean = (k * F.col("prior") + F.col("bad")) / (k + F.col("n"))
        return level.withColumn(name, mean), k

    suffixes, _ = estimated(
        hosts.groupBy("suffix").agg(*counts).withColumn("prior", F.lit(share)), "suffix_rate"
    )
    above = suffixes.select("suffix", F.col("suffix_rate").alias("prior"))
    domains, _ = estimated(
        hosts.groupBy("domain", "suffix").agg(*counts).join(above, "suffix"), "domain_rate"
    )
    above = domains.select("domain", "suffix", F.col("domain_rate").alias("prior"))
    rated, k = estimated(hosts.join(above, ["domain", "suffix"]), "bad_rate")
    a = k * F.col("prior") + F.col("bad")
    b = k * (1 - F.col("prior")) + F.col("n") - F.col("bad")
    return rated.select(
        "host", "domain", "suffix", "n", F.col("bad").alias("n_bad"), "bad_rate",
        lower_bound(a, b, z).alias("bad_bound"),
    )


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[tuple[str, str]],
    most_bad: float = 0.5,
    page_id: str = "page_id",
    url: str = "url",
    suffixes: Sequence[str] = (),
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict`` and what is known of the host.

    ``outcomes`` has ``page_id, bad`` (0 or 1) for some pages; a page with several outcomes is
    bad if one of them is, and outcomes without id, value or page do not count. ``rules`` are
    ``(verdict, "host/path")``, a short list the caller writes: the longest that fits decides.
    Else a page is blocked if the lower bound of its host's share of bad pages is above
    ``most_bad``; for a host without outcomes that is the bound of its registered domain, else of
    its suffix, else of all pages. A suffix is the last label of a name, or the longest of
    ``suffixes`` (like ``co.uk``, lower case, a short list the caller writes) that ends it. A null url, or one without ``://``, has an
    empty host and path. Repeated pages are judged each, null ids too; an empty table gives no rows.
    """
    parts = pages.select(
        F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    known = (
        outcomes.filter(F.col("bad").isin(0, 1) & F.col("page_id").isNotNull())
        .groupBy("page_id").agg(F.max("bad").alias("bad"))
    )
    named = parts.select("page_id", "host")
    # pages without an id have no outcome: past the join, where they would all meet in one task
    nameless = named.filter(F.col("page_id").isNull()).withColumn("bad", F.lit(None))
    outcome = named.filter(F.col("page_id").isNotNull()).join(known, "page_id", "left").union(nameless)
    found = host_reputation(outcome, suffixes=suffixes).select("host", "n", "n_bad", "bad_bound")
    rule = rule_for(F.col("host"), F.col("path"), rules)
    verdicts = [F.when(F.col("rule") == text, verdict) for verdict, text in rules]
    method = F.when(F.col("bad_bound") > most_bad, "block").otherwise("allow")
    return parts.withColumn("rule", rule).join(found, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce(*verdicts, method).alias("verdict"),
        F.coalesce("n", F.lit(0)).alias("host_labelled"),
        F.coalesce("n_bad", F.lit(0)).alias("host_bad"),
    )


def check_sql(rules: list[tuple[str, str]], most_bad: float, z: float = 1.6448536269514722) -> str:
    """The registered query as plain SQL over ``pages`` and ``labels``."""
    fits = "\n".join(
        f"WHEN (host = '{name}' OR host LIKE '%.{name}') AND starts_with(path, '/{start}') "
        f"THEN '{name}/{start}'"
        for name, _, start in (r.partition("/") for _, r in sorted(rules, key=lambda r: -len(r[1])))
    )
    verdicts = "\n".join(f"WHEN rule = '{text}' THEN '{verdict}'" for verdict, text in rules)

    def digamma(x: str) -> str:
        y = f"({x} + 6)"
        less = " - ".join(f"1 / ({x} + {i})" for i in range(6))
        return f"(ln({y}) - 1/(2*{y}) - 1/(12*{y}*{y}) + 1/(120*pow({y}, 4)) - {less})"

    def trigamma(x: str) -> str:
        y = f"({x} + 6)"
        more = " + ".join(f"1 / pow({x} + {i}, 2)" for i in range(6))
        return f"(1/{y} + 1/(2*{y}*{y}) + 1/(6*pow({y}, 3)) - 1/(30*pow({y}, 5)) + {more})"

    def strength(level: str) -> str:
        free = "n * prior * (1 - prior)"
        rho = f"(sum(pow(bad - n * prior, 2)) - sum({free})) / nullif(sum({free} * (n - 1)), 0)"
        return (f"(SELECT 1 / least(greatest(coalesce({rho}, {LEAST_RHO}), {LEAST_RHO}), {MOST_RHO})"
                f" - 1 AS k FROM {level})")

    return f"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3)
                       ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
known AS (
  SELECT doc_id AS page_id, max(1 - quality) AS bad FROM labels
  WHERE quality IN (0, 1) AND doc_id IS NOT NULL GROUP BY doc_id),
named AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad,
         regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name
  FROM parts LEFT JOIN known USING (page_id) GROUP BY host),
hosts AS (
  SELECT host, n, bad,
    CASE WHEN regexp_matches(name, '^[0-9.]*$') THEN name
         ELSE list_extract(string_split(name, '.'), -1) END AS suffix,
    CASE WHEN regexp_matches(name, '^[0-9.]*$') THEN name
         ELSE array_to_string(list_slice(string_split(name, '.'), -2, -1), '.') END AS domain
  FROM named),
suffixes AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad,
    (SELECT (coalesce(sum(bad), 0) + 1.0) / (coalesce(sum(n), 0) + 2.0) FROM hosts) AS prior
  FROM hosts GROUP BY suffix),
suffix_rates AS (
  SELECT suffix, (k * prior + bad) / (k + n) AS rate FROM suffixes, {strength("suffixes")}),
domains AS (
  SELECT domain, d.suffix, n, bad, rate AS prior
  FROM (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL) d
  JOIN suffix_rates s ON d.suffix = s.suffix),
domain_rates AS (
  SELECT domain, suffix, (k * prior + bad) / (k + n) AS rate FROM domains, {strength("domains")}),
priors AS (
  SELECT host, n, bad, rate AS prior FROM hosts h
  JOIN domain_rates d ON h.domain = d.domain AND h.suffix = d.suffix),
shapes AS (
  SELECT host, n, bad, k * prior + bad AS a, k * (1 - prior) + n - bad AS b
  FROM priors, {strength("priors")}),
bounds AS (
  SELECT host, n, bad, 1 / (1 + exp(-({digamma("a")} - {digamma("b")}
    - {z} * sqrt({trigamma("a")} + {trigamma("b")})))) AS bound FROM shapes),
ruled AS (SELECT *, CASE {fits} END AS rule FROM parts)
SELECT page_id, r.host, path, rule,
  CASE {verdicts} WHEN bound > {most_bad} THEN 'block' ELSE 'allow' END AS verdict,
  coalesce(n, 0)::BIGINT AS host_labelled, coalesce(bad, 0)::BIGINT AS host_bad
FROM ruled r LEFT JOIN bounds ON r.host = bounds.host"""
