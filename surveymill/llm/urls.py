"""URL filter: listed rules, and for all other pages the reputation of their host by empirical Bayes.

Labelled pages are counted by host, registered domain and suffix. The share of bad pages of each is drawn
towards that of its parent by a beta-binomial prior: host to domain, domain to suffix, suffix to all pages. How
strong a level's prior is follows from the spread of its members' shares (method of moments), within limits. What is left is
a beta posterior of the host's share of bad pages, and the host is blocked when its lower bound exceeds a threshold, a
multiple of the share among all labelled pages: when the posterior's mass above the threshold is CERTAINTY or more.

The mass is a quotient of two sums over the log-odds scale, where the density is smooth for any counts: POINTS points on
either side of its peak, STEP standard deviations apart, so that no special function is needed.

All of it is DataFrame expressions. Only three sums for each level (a row) come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveymill.llm.common import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The rules of the list, and suffixes of two labels.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
# Second-level registries below country codes, and suffixes under which anybody may have a host.
REGISTRIES = ("ac", "co", "com", "edu", "gov", "govt", "id", "ltd", "mil", "ne", "net", "nom", "or", "org", "plc", "sch")
SHARED_SUFFIXES = (
    "appspot.com", "blogspot.com", "cloudfront.net", "fly.dev", "github.io", "gitlab.io", "herokuapp.com", "netlify.app",
    "neocities.org", "pages.dev", "substack.com", "tumblr.com", "vercel.app", "web.app", "weebly.com", "wixsite.com", "wordpress.com",
)

BAD_MULTIPLE = 1.0  # a host is blocked if its share of bad pages is beyond so many times that of all pages,
CERTAINTY = 0.75  # with so much of its posterior
WEAKEST, STRONGEST = 1.0, 10.0  # limits of a prior's strength, in pages: ten labels of its own always weigh as much
POINTS, STEP = 240, 0.05


@dataclass(frozen=True)
class Level:
    """What the members of a level say about its prior: labelled pages, bad ones, and how the shares spread."""

    n: int
    bad: int
    strength: float


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def has_two_labels(last_two: Column, shared=SHARED_SUFFIXES) -> Column:
    """Whether the last two labels of a host are a suffix: a registry of a country code, or a shared one."""
    return last_two.rlike(rf"^({'|'.join(REGISTRIES)})\.[a-z]{{2}}$") | last_two.isin(*shared)


def suffix_of(host: Column, shared=SHARED_SUFFIXES) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return F.when(has_two_labels(last_two, shared), last_two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, shared=SHARED_SUFFIXES) -> Column:
    """The suffix and one label more."""
    last_two = F.substring_index(host, ".", -2)
    return F.when(has_two_labels(last_two, shared), F.substring_index(host, ".", -3)).otherwise(last_two)


def mass_above(bad: Column, good: Column, threshold: Column) -> Column:
    """Share of the beta distribution of ``bad`` and ``good`` (above 0) that lies above a threshold."""
    peak, width = F.ln(bad / good), F.sqrt(1 / bad + 1 / good)
    top = bad * F.ln(bad / (bad + good)) + good * F.ln(good / (bad + good))

    def add(sums: Column, k: Column) -> Column:
        odds = peak + width * (k * F.lit(STEP))
        density = F.exp(-bad * F.ln(1 + F.exp(-odds)) - good * F.ln(1 + F.exp(odds)) - top)
        above = F.when(1 / (1 + F.exp(-odds)) > threshold, density).otherwise(0.0)
        return F.struct((sums["all"] + density).alias("all"), (sums["above"] + above).alias("above"))

    start = F.struct(F.lit(0.0).alias("all"), F.lit(0.0).alias("above"))
    return F.aggregate(F.sequence(F.lit(-POINTS), F.lit(POINTS)), start, add, lambda sums: sums["above"] / sums["all"])


def rule_fits(rule: str, host: Column, path: Column) -> Column:
    of_host, slash, of_path = rule.partition("/")
    return ((host == of_host) | F.endswith(host, F.lit(f".{of_host}"))) & F.startswith(path, F.lit(slash + of_path))


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null."""
    choice = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        choice = F.when(rule_fits(rule, host, path), F.lit(rule)).otherwise(choice)
    return choice


def _level(members: DataFrame) -> Level:
    """Prior strength by the method of moments over the labelled members ``(n, bad)`` of a level.

    With the shares' weighted sum of squares S about the overall share p, m members and N pages, the
    correlation within members is (S - p(1-p)(m-1)) / (p(1-p)(N - sum n^2 / N - (m-1))); the strength is
    1 / correlation - 1.
    """
    sums = members.filter("n > 0").agg(
        F.count("*"), F.sum("n"), F.sum("bad"), F.sum(F.col("n") * F.col("n")), F.sum(F.col("bad") * F.col("bad") / F.col("n"))
    ).first()
    m, n, bad, squares, shares = (x or 0 for x in sums)
    if not n:
        return Level(0, 0, STRONGEST)
    p = bad / n
    spread = p * (1 - p)
    room = spread * (n - squares / n - (m - 1))
    correlation = (shares - n * p * p - spread * (m - 1)) / room if room > 0 else 0.0
    strength = 1 / correlation - 1 if correlation > 1 / (STRONGEST + 1) else STRONGEST
    return Level(n, bad, max(WEAKEST, strength))


def reputations(pages: DataFrame, bad_pages: DataFrame, multiple: float = BAD_MULTIPLE, shared=SHARED_SUFFIXES) -> DataFrame:
    """``(host, n, bad, share, above)`` of every host: labelled and bad pages, posterior share of bad ones, and how
    much of the posterior lies above ``multiple`` times the share of all pages.

    pages: ``(page_id, host)``; bad_pages: ``(page_id, bad)`` for labelled pages. Rows are counted by host
    before they move; what is left is a row for each host, domain and suffix.
    """
    labels = bad_pages.groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    seen = pages.join(labels, "page_id", "left")
    hosts = seen.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    hosts = hosts.withColumns({"domain": domain_of(F.col("host"), shared), "suffix": suffix_of(F.col("host"), shared)})
    hosts = stage(hosts, "url-hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("d_n"), F.sum("bad").alias("d_bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("d_n").alias("s_n"), F.sum("d_bad").alias("s_bad"))
    of_hosts = _level(hosts)
    of_domains = _level(domains.select(F.col("d_n").alias("n"), F.col("d_bad").alias("bad")))
    of_suffixes = _level(suffixes.select(F.col("s_n").alias("n"), F.col("s_bad").alias("bad")))
    overall = (of_hosts.bad + 1) / (of_hosts.n + 2)

    def drawn(bad: str, n: str, level: Level, parent: Column) -> Column:
        return (F.col(bad) + F.lit(level.strength) * parent) / (F.col(n) + F.lit(level.strength))

    suffixes = suffixes.select("suffix", drawn("s_bad", "s_n", of_suffixes, F.lit(overall)).alias("s_share"))
    domains = domains.join(suffixes, "suffix").select(
        "domain", "suffix", drawn("d_bad", "d_n", of_domains, F.col("s_share")).alias("d_share")
    )
    judged = hosts.join(domains, ["domain", "suffix"]).withColumn("share", drawn("bad", "n", of_hosts, F.col("d_share")))
    # counts of bad and good pages, the prior's among them
    bad = F.col("bad") + F.lit(of_hosts.strength) * F.col("d_share")
    good = F.col("n") - F.col("bad") + F.lit(of_hosts.strength) * (1 - F.col("d_share"))
    return judged.select("host", "n", "bad", "share", mass_above(bad, good, F.lit(multiple * overall)).alias("above"))


def judge_urls(
    pages: DataFrame,
    bad_pages: DataFrame,
    rules=RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    multiple: float = BAD_MULTIPLE,
    certainty: float = CERTAINTY,
    shared=SHARED_SUFFIXES,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, n_labelled, n_bad, share, above)`` of every row.

    The longest rule that fits decides; without one the host's reputation does: block if ``above``, the posterior's mass
    beyond ``multiple`` times the overall share of bad pages, is ``certainty`` or more (both rounded to six digits). Defined cases: a url that is
    null or holds no ``://`` has the empty host, which has a reputation like any other; a host without labelled pages
    has its domain's; rows without id, or that repeat one, are judged each, and a label counts for each row of its page;
    a page with several labels is bad if one of them is; no labels at all block nothing; an empty table has
    no verdicts; other columns are not read. The table of hosts is staged: Spark broadcasts it if it is small, and
    else splits the rows of a large host.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = stage(reputations(rows.select("page_id", "host"), bad_pages, multiple, shared), "url-reputations")
    judged = rows.join(known, "host", "left").withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    said = F.create_map(*[F.lit(x) for rule in [("", ""), *rules] for x in rule])
    above = F.round("above", 6)
    method = F.when(above >= F.lit(certainty), "block").otherwise("allow")
    verdict = F.when(F.col("rule").isNull(), method).otherwise(F.try_element_at(said, F.col("rule")))
    return judged.select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"),
        F.col("n").alias("n_labelled"), F.col("bad").cast("long").alias("n_bad"), F.round("share", 6).alias("share"), above.alias("above"),
    )
