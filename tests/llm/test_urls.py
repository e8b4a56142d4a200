"""URL verdicts: parsing and rules by hand, reputations against the same formulas in Python."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from surveymill.llm import urls
from surveymill.llm.queries import QUERIES


def split(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    return ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")


def test_parsing_and_rules(spark):
    cases = [
        None, "", "no scheme", "http://Example.ORG/es/1", "https://example.org/en/12?x#y", "http://a.example.org/en/2", "ftp://x.com/de/",
        "http://x.com/fr/a", "http://com/fr/", "http://xcom/fr/", "x://y://z/w", "http://É.Org/", "http://org", "http://org?x/", "://h/p\nq",
        "http://example.org/es", "http://badexample.org/es/1", "http://k.com#/de/", "http://user@h.com:80/de/x?y#z",
    ]
    pages = spark.createDataFrame(list(enumerate(cases)) + [(None, cases[3]), (3, cases[3])], "page_id long, url string")
    pages = pages.withColumns({"host": F.lit(1), "n": F.lit("x"), "bad": F.lit(True), "rule": F.lit(0)})
    none = spark.createDataFrame([], "page_id long, bad boolean")
    got = urls.judge_urls(pages, none).collect()
    assert len(got) == len(cases) + 2
    for r in got:
        host, path = split(cases[3 if r.page_id is None else r.page_id])
        assert (r.host, r.path) == (host, path)
        fits = [
            (len(rule), rule, verdict) for rule, verdict in urls.RULES
            if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0])) and path.startswith(rule[rule.index("/") :])
        ]
        assert (r.rule, r.verdict) == (max(fits)[1:] if fits else (None, "allow"))


def mass_above(a, b, threshold):
    """P(X > threshold) of a beta distribution, by a fine sum over the log-odds."""
    odds = np.linspace(-60, 60, 2_000_001)
    logs = -a * np.logaddexp(0, -odds) - b * np.logaddexp(0, odds)
    density = np.exp(logs - logs.max())
    return density[odds > math.log(threshold / (1 - threshold))].sum() / density.sum()


def test_posterior_mass(spark):
    cases = [(0.7, 3.0, 0.2), (1.0, 1.0, 0.25), (30.5, 2.5, 0.9), (400.0, 600.0, 0.41), (2.0, 0.5, 0.5), (5.0, 5.0, 0.5)]
    frame = spark.createDataFrame(cases, "a double, b double, t double")
    got = frame.select("a", "b", "t", urls.mass_above(F.col("a"), F.col("b"), F.col("t")).alias("above")).collect()
    assert all(abs(r.above - mass_above(r.a, r.b, r.t)) < 0.02 for r in got)  # a step of the sum lies on the threshold
    assert abs(got[1].above - 0.75) < 0.01


def test_both_verdicts_occur_on_the_given_pages(spark):
    for sf in ("sf0.01", "sf0.1"):
        rows = QUERIES["op2_host_reputation"](spark, f"/root/testdata/{sf}").filter("rule IS NULL").collect()
        verdicts = Counter(r.verdict for r in rows)
        assert min(verdicts["allow"], verdicts["block"]) > 5
        assert all((r.verdict == "block") == (r.above >= urls.CERTAINTY) for r in rows)


def test_suffixes(spark):
    cases = {"a.b.co.uk": "b.co.uk", "x.com.cn": "x.com.cn", "shop.com.mx": "shop.com.mx", "me.github.io": "me.github.io", "a.me.github.io": "me.github.io",
             "www.example.org": "example.org", "t.co": "t.co", "a.t.co": "t.co", "localhost": "localhost", "": "", "x.com.info": "com.info"}
    frame = spark.createDataFrame([(h,) for h in cases], "host string").select("host", urls.domain_of(F.col("host")).alias("domain"))
    assert {r.host: r.domain for r in frame.collect()} == cases


def test_reputations(spark):
    pages, labels, expected = [], [], Counter()
    plan = {"bad.x.net": (40, 38), "good.x.net": (40, 2), "few.x.net": (2, 2), "new.x.net": (0, 0), "a.y.co.uk": (30, 29), "b.y.co.uk": (30, 30), "z.co.uk": (20, 1)}
    for host, (n, bad) in plan.items():
        for i in range(n + 3):
            pages.append((len(pages), host))
            if i < n:
                labels.append((len(pages) - 1, i < bad))
    labels += [(labels[0][0], labels[0][1]), (10**6, True), (None, True), (1, None)]
    frame = spark.createDataFrame(pages, "page_id long, host string")
    marks = spark.createDataFrame(labels, "page_id long, bad boolean")
    got = {r.host: r for r in urls.reputations(frame, marks).collect()}
    assert {h: (r.n, r.bad) for h, r in got.items()} == plan

    def level(members):
        members = [(n, b) for n, b in members if n]
        n, bad, m = sum(n for n, _ in members), sum(b for _, b in members), len(members)
        p = bad / n
        s = sum(k * (b / k - p) ** 2 for k, b in members)
        room = p * (1 - p) * (n - sum(k * k for k, _ in members) / n - (m - 1))
        rho = (s - p * (1 - p) * (m - 1)) / room if room > 0 else 0
        return min(urls.STRONGEST, max(urls.WEAKEST, 1 / rho - 1)) if rho > 0 else urls.STRONGEST, n, bad

    domain = {h: ".".join(h.split(".")[-3 if h.endswith("co.uk") else -2 :]) for h in plan}
    suffix = {h: "co.uk" if h.endswith("co.uk") else "net" for h in plan}

    def summed(of):
        out = {}
        for h, (n, b) in plan.items():
            a = out.get(of[h], (0, 0))
            out[of[h]] = (a[0] + n, a[1] + b)
        return out

    by_domain, by_suffix = summed(domain), summed(suffix)
    s_host, n, bad = level(plan.values())
    s_domain, s_suffix = level(by_domain.values())[0], level(by_suffix.values())[0]
    for h, (k, b) in plan.items():
        share = (by_suffix[suffix[h]][1] + s_suffix * (bad + 1) / (n + 2)) / (by_suffix[suffix[h]][0] + s_suffix)
        share = (by_domain[domain[h]][1] + s_domain * share) / (by_domain[domain[h]][0] + s_domain)
        share = (b + s_host * share) / (k + s_host)
        parent = (share * (k + s_host) - b) / s_host
        above = mass_above(b + s_host * parent, k - b + s_host * (1 - parent), (bad + 1) / (n + 2))
        assert abs(got[h].share - share) < 1e-9 and abs(got[h].above - above) < 0.02
        expected[h] = above >= urls.CERTAINTY
        assert abs(above - urls.CERTAINTY) > 0.02
    judged = urls.judge_urls(frame.selectExpr("page_id", "concat('http://', host, '/') AS url"), marks, rules=())
    verdicts = {r.host: r.verdict for r in judged.collect()}
    assert {h for h, v in verdicts.items() if v == "block"} == {h for h in plan if expected[h]} >= {"bad.x.net", "a.y.co.uk", "b.y.co.uk"}


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    bad = spark.createDataFrame([(1, True)], "page_id long, bad boolean")
    assert urls.judge_urls(pages, bad).collect() == []


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    bad = spark.createDataFrame([(1, True)], "page_id long, bad boolean")
    plan = urls.judge_urls(pages, bad)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
