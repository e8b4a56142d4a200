"""Quality rules as a bitmask ledger: measured once, judged as often as wanted.

The ledger has a row per document with its measurements and one bit for each rule it fails. A policy is
a versioned set of rules (a mask): a document is kept if it fails none of them. Policies and ablations
are bitwise work on the ledger; the texts are not read again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveymill.llm.common import per_text

WORD = re.compile("[^\x20\x09-\x0d]+")
# The characters that count as symbols, and the words of a window.
SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 5

MEASURES = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "n_lines": "long",  # lines with a word
    "n_upper": "long",  # letters in upper case, A-Z
    "n_letters": "long",  # letters, A-Z and a-z
}
_ADDED = ", ".join(f"{name} {kind}" for name, kind in MEASURES.items())

#: Rules in the order of their bits: name and the test, over the measurements, that a document fails.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "5 * n_symbols > n_words"),
    ("duplicate_lines", "n_lines >= 6 AND 2 * n_dup_lines > n_lines"),
    ("word_length", "word_chars > 40 * n_words"),
    ("upper_case", "n_letters >= 40 AND 5 * n_upper > 4 * n_letters"),
)


@dataclass(frozen=True)
class Policy:
    """A version of what rejects a document."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = [name for name, _ in RULES]
        return sum(1 << names.index(rule) for rule in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
POLICY = Policy("2", tuple(name for name, _ in RULES))


def measure(text: str) -> dict[str, int]:
    """The measurements of one whole text."""
    words = WORD.findall(text)
    n = len(words)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    covered = 0
    if n > WINDOW_WORDS:
        # a window of five words costs a lookup; which words repeated windows cover is found only where one repeats
        windows = list(zip(*(words[i:] for i in range(WINDOW_WORDS)), strict=False))
        if len(set(windows)) < len(windows):
            count: dict[tuple, int] = {}
            for window in windows:
                count[window] = count.get(window, 0) + 1
            reach = 0
            for start, window in enumerate(windows):
                if count[window] > 1:
                    covered += start + WINDOW_WORDS - max(reach, start)
                    reach = start + WINDOW_WORDS
    upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": covered,
        "n_lines": len(lines),
        "n_upper": upper,
        "n_letters": upper + sum(map(text.count, "abcdefghijklmnopqrstuvwxyz")),
    }


def _measure_all(texts: list[str]) -> dict[str, list[int]]:
    rows = [measure(text) for text in texts]
    return {name: [row[name] for row in rows] for name in MEASURES}


def failed_mask(rules=RULES) -> Column:
    """One bit for each rule, set where the measurements fail it."""
    bits = [F.when(F.expr(test), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, (_, test) in enumerate(rules)]
    mask = F.lit(0)
    for bit in bits:
        mask = mask.bitwiseOR(bit)
    return mask.cast("long")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, the measurements, failed)`` of every row, by one reading of the whole text.

    Defined cases: a null text has no words; an empty text fails the rules on few words; rows without
    id, or that repeat one, have a row each; an empty table has none; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return per_text(rows, ["doc_id"], "text", _measure_all, _ADDED).withColumn("failed", failed_mask())


def passes(policy: Policy, failed: Column) -> Column:
    return failed.bitwiseAND(F.lit(policy.mask)) == 0


def judge(entries: DataFrame, policies: list[Policy]) -> DataFrame:
    """The ledger with a verdict ``kept_<version>`` for each policy."""
    return entries.withColumns({f"kept_{policy.version}": passes(policy, F.col("failed")) for policy in policies})


def ablations(entries: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """What each rule does: documents it fails, those it alone rejects, those kept without it, and kept in all.

    The ledger is counted by mask first, which leaves at most 2^rules rows whatever its size.
    """
    masks = entries.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask)).alias("m")).agg(F.count("*").alias("n"))
    bits = [(name, 1 << bit) for bit, (name, _) in enumerate(RULES) if name in policy.rules]
    rules = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in bits]))
    rows = masks.select("m", "n", rules.alias("r")).select("m", "n", "r.rule", "r.bit")

    def total(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))

    others = F.col("m").bitwiseAND(F.bitwise_not(F.col("bit")))
    return rows.groupBy("rule").agg(
        total(F.col("m").bitwiseAND(F.col("bit")) != 0).alias("fails"),
        total(F.col("m") == F.col("bit")).alias("rejects_alone"),
        total(others == 0).alias("kept_without"),
        total(F.col("m") == 0).alias("kept"),
    )


def keep_good(docs: DataFrame, policy: Policy = POLICY, text_col: str = "text") -> DataFrame:
    """The rows that pass a policy, with all their columns; rows are neither moved nor joined."""
    names = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))])
    entries = per_text(numbered, numbered.columns, f"c{names.index(text_col)}", _measure_all, _ADDED)
    good = entries.filter(passes(policy, failed_mask()))
    return good.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(names)])
