"""Text expressions: accent folding, header names, null tokens, flags, word tests.

Functions that take and return ``str`` work on SQL expressions: rules are long, and one parsed
expression is far cheaper to build than a tree of Column calls. They are kept short on purpose:
a projection whose generated method outgrows the JIT limit runs several times slower.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveymill.fixed_values import FLAG_NO, FLAG_NO_ANSWER, FLAG_YES, NULL_TOKENS

# What str.strip() removes; Spark's trim() alone removes only the space.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_ZERO = "^[-+]?(0+[.]?0*|[.]0+)(e[-+]?[0-9]+)?$"
_HANGUL = range(0xAC00, 0xD7A4)
# Letters of composed syllables in the order their numbers count: initials, vowels, finals.
_INITIALS = "".join(map(chr, range(0x1100, 0x1113)))
_VOWELS = "".join(map(chr, range(0x1161, 0x1176)))
_FINALS = "".join(map(chr, range(0x11A8, 0x11C3)))
_SURROGATES = range(0xD800, 0xE000)
_LAST_DECOMPOSING = 0x2FA1D  # no character beyond it decomposes or combines
_PAIR, _GAP = "\x02", "\x03"


def literal(text: str) -> str:
    """A SQL string literal (``${`` would otherwise be read as a variable)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("${", "\\u0024{") + "'"


def literals(texts) -> str:
    return ", ".join(map(literal, texts))


def _plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@cache
def _folds() -> tuple[str, str, str, str]:
    """Compatibility decomposition without combining marks, generated from ``unicodedata``.

    Returns the two translate() strings (a character missing in the second is deleted), and the
    characters that expand to several: as a str_to_map() text, and by themselves. Composed Hangul
    syllables are left out, they decompose by arithmetic.
    """
    single, deleted, several = {}, [], {}
    for point in range(0x80, _LAST_DECOMPOSING + 1):
        if point in _HANGUL or point in _SURROGATES:
            continue
        char = chr(point)
        plain = _plain(char)
        if plain == char:
            continue
        if not plain:
            deleted.append(char)
        elif len(plain) == 1:
            single[char] = plain
        else:
            several[char] = plain
    return (
        "".join(single) + "".join(deleted),
        "".join(single.values()),
        _PAIR.join(f"{char}{_GAP}{plain}" for char, plain in several.items()),
        "".join(several),
    )


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def _hangul(char: Column) -> Column:
    """The two or three letters of a composed syllable, by their order in the syllable's number."""
    number = F.ascii(char) - _HANGUL.start
    finals = len(_FINALS) + 1

    def letter(letters: str, place: Column) -> Column:
        return F.substr(F.lit(letters), place.cast("int"), F.lit(1))

    return F.concat(
        letter(_INITIALS, F.floor(number / (len(_VOWELS) * finals)) + 1),
        letter(_VOWELS, F.floor(number / finals) % len(_VOWELS) + 1),
        F.when(number % finals == 0, "").otherwise(letter(_FINALS, number % finals)),
    )


def _once(value: Column, work) -> Column:
    """``work`` of a value that is computed once however often the result names it."""
    return F.get(F.transform(F.array(value), work), F.lit(0))


def strip_accents(text: Column) -> Column:
    """NFKD without combining marks.

    ASCII text passes untouched. Of other text, only what still holds a character with an expansion to
    several after the one-to-one translation is looked at by word, and of the words only those that do,
    character by character.
    """
    source, target, expansions, expanding = _folds()
    table = F.str_to_map(F.lit(expansions), F.lit(_PAIR), F.lit(_GAP))
    first, last = chr(_HANGUL.start), chr(_HANGUL.stop - 1)

    def expands(part: Column) -> Column:
        special = F.length(F.translate(part, expanding, "")) != F.length(part)
        return ~_is_ascii(part) & (special | part.rlike(f"[{first}-{last}]"))

    def letters(char: Column) -> Column:
        return F.when(char.between(first, last), _hangul(char)).otherwise(F.coalesce(F.try_element_at(table, char), char))

    def expand(word: Column) -> Column:
        return F.when(expands(word), F.array_join(F.transform(F.split(word, ""), letters), "")).otherwise(word)

    def fold(plain: Column) -> Column:
        return F.when(expands(plain), F.array_join(F.transform(F.split(plain, " "), expand), " ")).otherwise(plain)

    def plain(lowered: Column) -> Column:
        return F.when(_is_ascii(lowered), lowered).otherwise(_once(F.translate(lowered, source, target), fold))

    return _once(text, plain)


def header_name(text: Column) -> Column:
    """Comparable form of a header: lower-case ASCII words and dotted codes, single-spaced."""
    return F.array_join(F.regexp_extract_all(strip_accents(F.lower(text)), F.lit("[a-z0-9.]+"), 0), " ")


def fold_text(text: Column) -> Column:
    """Trimmed, lowered, accent-free text; null becomes the empty string."""
    return F.coalesce(strip_accents(F.lower(F.btrim(text, F.lit(WHITESPACE)))), F.lit(""))


def header_token(token: str) -> str:
    """Rule words go through the same normal form as the headers they are matched with."""
    return " ".join(re.findall("[a-z0-9.]+", _plain(token.lower())))


def has_token(name: str, token: str) -> str:
    """Whole-word test on a header name; a token with a space or dot is a substring test."""
    if not token:
        return "true"
    if " " in token or "." in token:
        return f"contains({name}, {literal(token)})"
    return f"contains(concat(' ', {name}, ' '), {literal(f' {token} ')})"


def matches(name: str, include=(), exclude=()) -> str:
    """All include tokens and none of the exclude tokens occur in a header name."""
    wanted = [has_token(name, header_token(token)) for token in include]
    barred = [f"NOT {has_token(name, header_token(token))}" for token in exclude]
    return " AND ".join(wanted + barred) or "true"


def contains_any(text: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({text}, {literal(phrase)})" for phrase in phrases) + ")"


def null_tokens(cell: str) -> str:
    """Cells that spell a missing value become null."""
    return f"IF({cell} IN ({literals(NULL_TOKENS)}), NULL, {cell})"


def to_flag(cell: str) -> str:
    """0/1/null from a yes/no answer; text that is neither is a chosen option, so 1.

    Answers in plain spelling are looked up as they are; the others are trimmed and lowered first.
    """
    known = ", ".join([f"{literal(yes)}, 1" for yes in FLAG_YES] + [f"{literal(no)}, 0" for no in FLAG_NO])
    answer = f"lower(btrim({cell}, {literal(WHITESPACE)}))"
    no_answer = f"{cell} IS NULL OR {answer} IN ({literals(FLAG_NO_ANSWER)})"
    no = f"{answer} IN ({literals(FLAG_NO)}) OR {answer} RLIKE {literal(_ZERO)}"
    return f"coalesce(try_element_at(map({known}), {cell}), IF({no_answer}, NULL, IF({no}, 0, 1)))"
