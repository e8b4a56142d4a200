"""Header resolution: which source column of an edition answers which canonical field.

Input is a header catalog ``(<edition key>, pos, header)`` with one row per source column. Each
header is tested against the rules in place (a projection, no join of headers with rules), and
one aggregation per edition keeps the best header of every field. The state per edition is one
candidate per field, so editions with any number of columns, and any number of editions, are
reduced before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveymill.fixed_values import (
    HEADER_RULES,
    INPUT_FIELDS,
    POWERBI_BARRED,
    POWERBI_CODE_STARTS,
    POWERBI_CODES_INSIDE,
    POWERBI_PHRASE,
)
from surveymill.functions.text import contains_any, header_name, header_token, literal, matches
from surveymill.sources.lake import is_small

_PLACES = "10000000000BD"  # beyond any length or position; four numbers below it fit one decimal
RESOLVED_FIELDS = INPUT_FIELDS[2:]  # survey_year and edition come from the registry


def chain(steps, prefer_shortest: bool = True) -> tuple[str, bool]:
    """First step of (include, exclude) a header fits, null when none, and whether short ones go first."""
    fits = " ".join(f"WHEN {matches('name', include, exclude)} THEN {n}" for n, (include, exclude) in enumerate(steps))
    return f"CASE {fits} END", prefer_shortest


def powerbi() -> tuple[str, bool]:
    """Power BI as a chain: headers with a question code first, then survey order."""
    fits = f"contains(replace(name, ' ', ''), {literal(POWERBI_PHRASE)}) AND NOT {contains_any('name', POWERBI_BARRED)}"
    starts = " OR ".join(f"startswith(name, {literal(code)})" for code in POWERBI_CODE_STARTS)
    coded = f"({starts} OR {contains_any('name', POWERBI_CODES_INSIDE)})"
    return f"CASE WHEN {fits} THEN IF({coded}, 0, 1) END", False


def _rank(step: str, shortest: bool) -> str:
    """Step, lengths and position as one number, the best header's being the least: a minimum over numbers is
    taken in hash tables on the map side, one over structs or text only after a sort."""
    name, header = ("name_length", "header_length") if shortest else ("0", "0")
    return f"(({step} * {_PLACES} + {name}) * {_PLACES} + {header}) * {_PLACES} + pos"


def best_headers(headers: DataFrame, rules: dict[str, tuple[str, bool]], by: str = "survey_year") -> DataFrame:
    """``(by, field, source_header, pos)``: one row per edition and field, null where nothing fits.

    ``rules`` maps a field to its rule, see :func:`chain`. The best header has the earliest step,
    then the shortest name, the shortest header and the first position.
    """
    named = headers.select(by, "pos", "header", header_name(F.col("header")).alias("name"))
    steps = named.selectExpr(
        by,
        "pos",
        "header",
        "length(name) AS name_length",
        "length(header) AS header_length",
        *[f"{step} AS {field}" for field, (step, _) in rules.items()],
    )
    best = [
        f"min(IF({field} IS NULL, NULL, {_rank(field, shortest)})) AS {field}"
        for field, (_, shortest) in rules.items()
    ]
    answers = ", ".join(f"struct({literal(field)} AS field, {field} AS rank)" for field in rules)
    found = steps.groupBy(by).agg(*map(F.expr, best)).selectExpr(by, f"inline(array({answers}))")
    return _with_headers(found, headers, by)


def _with_headers(found: DataFrame, headers: DataFrame, by: str) -> DataFrame:
    """``(by, field, rank)`` as ``(by, field, source_header, pos)``. Merged: a catalog compresses so well that Spark would take
    it for small and send it through the driver."""
    places = found.selectExpr(by, "field", f"CAST(rank % {_PLACES} AS INT) AS pos")
    texts = headers.select(by, "pos", F.col("header").alias("source_header"))
    return places.join(texts.hint("merge"), [by, "pos"], "left").select(by, "field", "source_header", "pos")


def find_column(
    headers: DataFrame,
    include,
    exclude=(),
    prefer_shortest: bool = True,
    field: str = "column",
    by: str = "survey_year",
) -> DataFrame:
    """Best header per edition with all ``include`` and no ``exclude`` tokens."""
    return find_first(headers, [(include, exclude)], prefer_shortest, field, by)


def find_first(
    headers: DataFrame, steps, prefer_shortest: bool = True, field: str = "column", by: str = "survey_year"
) -> DataFrame:
    """Like :func:`find_column`, over a chain of steps: the first step with a hit decides."""
    return best_headers(headers, {field: chain(steps, prefer_shortest)}, by)


def find_powerbi(headers: DataFrame, by: str = "survey_year") -> DataFrame:
    return best_headers(headers, {"uses_powerbi": powerbi()}, by)


def resolve_schema(headers: DataFrame, by: str = "survey_year") -> DataFrame:
    """All canonical fields of every edition in the catalog; a header may serve several fields."""
    return best_headers(
        headers,
        {
            field: powerbi() if field == "uses_powerbi" else chain(HEADER_RULES[field])
            for field in RESOLVED_FIELDS
        },
        by,
    )


# --- rules as a table ----------------------------------------------------------------------------

RULES = "field string, step int, include array<string>, exclude array<string>, shortest boolean"


def _needle(token: str) -> str:
    """What a header name between two blanks must hold for a rule word: the word between blanks, or a phrase or code as it is."""
    word = header_token(token)
    return word if " " in word or "." in word or not word else f" {word} "


def rules_table(spark: SparkSession, rules: Mapping[str, Sequence], shortest: bool = True) -> DataFrame:
    """Chains of (include, exclude) steps by field as a table, words in the form in which names are searched."""
    rows = [
        (field, step, [n for n in map(_needle, include) if n], [n for n in map(_needle, exclude) if n], shortest)
        for field, steps in rules.items()
        for step, (include, exclude) in enumerate(steps)
    ]
    return spark.createDataFrame(rows, RULES)


def _grams(text: Column) -> Column:
    """The distinct pieces of three characters of a text."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - 2)), lambda i: F.substring(text, i, F.lit(3))))


def resolve_by_rules(headers: DataFrame, rules: DataFrame, by: str = "survey_year") -> DataFrame:
    """:func:`best_headers` for any number of rules, given as a table (RULES).

    Headers and rules meet through an inverted index: a header fits a rule only if it holds every piece of three characters of
    the rule's words, so each rule is looked up under the one that fewest headers hold. Rule words are then tested on the
    headers found. A rule without a word of that length is tested on every header. Each distinct header is looked up once.
    Only a table of few rules is broadcast: the sides that grow with the catalog are merged, however well they compress.
    """
    few = is_small(rules)

    def of_rules(frame: DataFrame) -> DataFrame:
        return F.broadcast(frame) if few else frame.hint("merge")

    names = headers.select("header").distinct().withColumn("name", header_name(F.col("header")))
    names = names.withColumn("padded", F.concat(F.lit(" "), "name", F.lit(" ")))
    pieces = names.select("header", F.explode(_grams(F.col("padded"))).alias("gram"))
    long = F.filter("include", lambda n: F.length(n) >= 3)
    every = rules.filter(F.size(long) == 0)
    wanted = rules.select("field", "step", F.explode(F.array_distinct(F.flatten(F.transform(long, _grams)))).alias("gram"))
    held = pieces.join(of_rules(wanted.select("gram").distinct()), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    rarest = wanted.join(held, "gram", "left").groupBy("field", "step").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("key"))
    keyed = rules.join(rarest.select("field", "step", F.col("key.gram").alias("gram")), ["field", "step"])
    if not every.isEmpty():
        keyed = keyed.unionByName(every.withColumn("gram", F.lit("")))
        pieces = pieces.unionByName(names.select("header", F.lit("").alias("gram")))
    found = pieces.join(of_rules(keyed), "gram").drop("gram").hint("merge").join(names.hint("merge"), "header")
    fits = F.forall("include", lambda n: F.contains(F.col("padded"), n)) & ~F.exists("exclude", lambda n: F.contains(F.col("padded"), n))
    lengths = found.filter(fits).select("header", "field", "step", F.expr("IF(shortest, length(name), 0)").alias("name_length"), F.expr("IF(shortest, length(header), 0)").alias("header_length"))
    places = headers.select(by, "pos", "header")
    ranked = lengths.hint("merge").join(places.hint("merge"), "header").select(by, "field", F.expr(_rank("step", True)).alias("rank"))
    fields = F.array(*[F.lit(row["field"]) for row in rules.select("field").distinct().collect()])  # a row for each field
    asked = headers.select(by).distinct().select(by, F.explode(fields).alias("field"), F.lit(None).cast(ranked.schema["rank"].dataType).alias("rank"))
    best = asked.unionByName(ranked).groupBy(by, "field").agg(F.min("rank").alias("rank"))
    return _with_headers(best, headers, by)
