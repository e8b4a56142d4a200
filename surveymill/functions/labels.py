"""Rule expressions as SQL: first matching label, exact lookup."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from surveymill.functions.text import contains_any, literal


def first_label(text: str, rules: Iterable[tuple[str, tuple[str, ...]]], *rest: tuple[str, str], default: str) -> str:
    """Label of the first rule with a phrase in ``text``, else of the first of the ``rest``
    conditions that holds, else the default expression."""
    cases = [(contains_any(text, phrases), label) for label, phrases in rules] + list(rest)
    branches = " ".join(f"WHEN {condition} THEN {literal(label)}" for condition, label in cases)
    return f"CASE {branches} ELSE {default} END"


def lookup(key: str, table: Mapping[str, float]) -> str:
    """Value of an exactly matching key as a double, else null."""
    entries = ", ".join(f"{literal(text)}, {value}D" for text, value in table.items())
    return f"try_element_at(map({entries}), {key})"
