"""Header resolution against a brute-force reading of the rules."""

from __future__ import annotations

import random

import pytest

from checks.fixture import CATALOG_HEADERS, DECOY_HEADERS, EDITION_HEADERS
from surveymill.fixed_values import HEADER_RULES
from surveymill.functions.text import header_token
from surveymill.operators import headers as by_table
from surveymill.operators.headers import RESOLVED_FIELDS, find_column, find_first, find_powerbi, resolve_schema


def _catalog(spark, editions):
    rows = [(year, pos, h) for year, headers in editions.items() for pos, h in enumerate(headers)]
    return spark.createDataFrame(rows, "survey_year int, pos int, header string")


def _occurs(token, name):
    if token and " " not in token and "." not in token:
        return token in name.split(" ")
    return token in name


def _rank(headers, steps):
    """Position of the best header: every header is scored for every step, the least score wins."""
    scores = [
        (step, len(header_token(h)), len(h), pos)
        for step, (include, exclude) in enumerate(steps)
        for pos, h in enumerate(headers)
        if all(_occurs(header_token(t), header_token(h)) for t in include)
        and not any(_occurs(header_token(t), header_token(h)) for t in exclude)
    ]
    return min(scores)[-1] if scores else None


def _powerbi(headers):
    names = [header_token(h) for h in headers]
    hits = [
        pos
        for pos, name in enumerate(names)
        if "powerbi" in name.replace(" ", "") and "dashboard" not in name and "ferramenta" not in name
    ]
    coded = [
        pos
        for pos in hits
        if names[pos][:6] in ("4.j.1 ", "4.g.1 ") or any(f"p4 {x} 1 " in names[pos] for x in "jig")
    ]
    return next(iter(coded + hits), None)


def test_random_catalogs(spark):
    rng = random.Random(7)
    pool = [f"('{q} ', '{label}')" for q, _, label in CATALOG_HEADERS]
    pool += [f"{d}_{label.replace(' ', '_')}" for _, d, label in CATALOG_HEADERS]
    pool += [label.upper() for *_, label in CATALOG_HEADERS]
    editions = {year: [rng.choice(pool) for _ in range(rng.choice([1, 8, 40, 120]))] for year in range(120)}
    found = {(r["survey_year"], r["field"]): r for r in resolve_schema(_catalog(spark, editions)).collect()}
    assert len(found) == len(editions) * 33
    for year, headers in editions.items():
        for field in RESOLVED_FIELDS:
            best = _powerbi(headers) if field == "uses_powerbi" else _rank(headers, HEADER_RULES[field])
            row = found[year, field]
            assert row["pos"] == best, (year, field)
            assert row["source_header"] == (None if best is None else headers[best])


def test_fixture_editions_resolve_as_labelled(spark):
    editions = {y: [DECOY_HEADERS[y], *EDITION_HEADERS[y].values()] for y in EDITION_HEADERS}
    for row in resolve_schema(_catalog(spark, editions)).collect():
        assert row["source_header"] == EDITION_HEADERS[row["survey_year"]].get(row["field"]), row


@pytest.mark.parametrize("prefer_shortest, expected", [(True, "SQL"), (False, "Linguagem de consulta SQL")])
def test_shortest_or_first(spark, prefer_shortest, expected):
    catalog = _catalog(spark, {2025: ["Outra", "Linguagem de consulta SQL", "SQL", "sql"]})
    assert find_column(catalog, ["sql"], prefer_shortest=prefer_shortest).first()["source_header"] == expected


def test_no_hit_is_a_null_row(spark):
    row = find_first(_catalog(spark, {2025: ["Idade"]}), [(["setor"], []), (["cargo"], [])]).first()
    assert (row["survey_year"], row["source_header"], row["pos"]) == (2025, None, None)


def test_coded_powerbi_wins_over_an_earlier_one(spark):
    catalog = _catalog(spark, {1: ["PowerBI", "4.j.1_Microsoft PowerBI"], 2: ["Power BI a", "PowerBI"], 3: ["Dashboards PowerBI"]})
    assert {r["survey_year"]: r["pos"] for r in find_powerbi(catalog).collect()} == {1: 1, 2: 0, 3: None}


def test_the_headers_are_never_joined_with_the_rules(spark):
    plan = resolve_schema(_catalog(spark, {1: ["Idade"]}))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "SortAggregate" not in plan
    assert plan.count("Join [") == 1 and "[survey_year" in plan.split("Join ", 1)[1]  # the texts of the best headers


def test_rules_as_a_table_find_what_compiled_rules_find(spark):
    rng = random.Random(6)
    words = ["sql", "python", "nivel", "de", "faixa", "4.d.1", "p4", "d", "1", "ai", "generativa", "nosql", "a", "x.y"]
    rows = [(year, pos, " ".join(rng.choices(words, k=rng.randrange(0, 6)))) for year in range(40) for pos in range(rng.randrange(1, 12))]
    catalog = spark.createDataFrame(rows, "survey_year int, pos int, header string")
    rules = {}
    for n in range(60):
        step = lambda: (tuple(" ".join(rng.choices(words, k=rng.choice([1, 1, 2]))) for _ in range(rng.randrange(0, 3))), tuple(rng.choices(words, k=rng.randrange(0, 2))))
        rules[f"f{n}"] = tuple(step() for _ in range(rng.randrange(1, 4)))
    found = by_table.resolve_by_rules(catalog, by_table.rules_table(spark, rules))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    expected = by_table.best_headers(catalog, {field: by_table.chain(steps) for field, steps in rules.items()})
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))


def test_no_catalog_is_broadcast(spark):
    """However well its headers compress: editions by the thousand would pass through the driver."""
    texts = [quoted for quoted, _, _ in CATALOG_HEADERS]
    catalog = spark.range(0, 30_000, 1, 4).selectExpr(
        "CAST(id DIV 48 AS INT) AS survey_year", "CAST(id % 48 AS INT) AS pos",
        f"element_at(array({', '.join(repr(t) for t in texts)}), CAST(id * 7 % {len(texts)} AS INT) + 1) AS header",
    )
    rules = by_table.rules_table(spark, {"sector": HEADER_RULES["sector"], "gender": HEADER_RULES["gender"]})
    for found in (by_table.resolve_by_rules(catalog, rules), find_powerbi(catalog)):
        assert len(found.collect()) >= 625
        final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        joins = [line for line in final.splitlines() if "BroadcastHashJoin" in line]
        assert not [line for line in joins if "survey_year" in line or "header" in line]
