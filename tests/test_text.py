"""Text expressions against plain Python definitions."""

from __future__ import annotations

import re
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from surveymill.fixed_values import NULL_TOKENS
from surveymill.functions.text import (
    contains_any,
    fold_text,
    has_token,
    header_name,
    header_token,
    literal,
    matches,
    null_tokens,
    strip_accents,
    to_flag,
)


def _plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def _every_character(width: int = 61):
    chars = [chr(p) for p in range(1, sys.maxunicode + 1) if not 0xD800 <= p < 0xE000]
    return ["".join(chars[i : i + width]) for i in range(0, len(chars), width)]


def test_strip_accents_agrees_on_every_character(spark):
    texts = _every_character()
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", strip_accents(F.col("text"))).collect()
    wrong = [(t, s) for t, s in rows if s != _plain(t)]
    assert len(rows) == len(texts) and not wrong, wrong[:3]


def test_fold_text_of_many_scripts(spark):
    texts = ["  한국어 설문 ", "Ação ½ e ﬁm", "Прочее Ёлка", "ὮΔΉ", "日本 ゲーム", "가각힣", "a 한 b ½", "É", "plain", None]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", fold_text(F.col("text"))).collect()
    assert [s for _, s in rows] == [_plain((t or "").strip().lower()) for t in texts]


@pytest.mark.parametrize(
    "header, name",
    [
        ("('P1_a ', 'Idade')", "p1 a idade"),
        ("('P1_a_1 ', 'Faixa idade')", "p1 a 1 faixa idade"),
        ("('P4_d_1 ', 'SQL')", "p4 d 1 sql"),
        ("4.d.1_SQL", "4.d.1 sql"),
        ("2.f_cargo_atual", "2.f cargo atual"),
        ("1.l_nível_de_ensino", "1.l nivel de ensino"),
        ("Região onde\tmora?\n", "regiao onde mora"),
        ("½ ﬁm…", "1 2 fim..."),
        ("  --  ", ""),
    ],
)
def test_header_name(spark, header, name):
    row = spark.createDataFrame([(header,)], "h string").select(header_name(F.col("h"))).first()
    assert row[0] == name == header_token(header)


def test_fold_text(spark):
    cases = {" \tÁRVORE  ": "arvore", "": "", None: "", "Negócios\n": "negocios", "a b": "a b"}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", fold_text(F.col("t"))).collect()
    assert {t: f for t, f in rows} == cases


@pytest.mark.parametrize("token", ["", "idade", "p3 e", "4.c", "a+b", "de", "cidade onde"])
def test_has_token_is_a_word_or_substring_test(spark, token):
    names = ["idade", "faixa idade", "cidade", "p3 e 1 algo", "4.c.1 sql", "cidade onde mora", "", "a b", "4xc", "de"]

    def expected(name):
        if token == "" or " " in token or "." in token:
            return token in name
        return re.search(rf"(^| ){re.escape(token)}( |$)", name) is not None

    rows = spark.createDataFrame([(n,) for n in names], "name string").selectExpr("name", has_token("name", token))
    assert {n: f for n, f in rows.collect()} == {n: expected(n) for n in names}


def test_an_empty_barred_token_bars_everything(spark):
    frame = spark.createDataFrame([("idade",)], "name string")
    assert frame.selectExpr(matches("name", ["idade"], [""])).first()[0] is False
    assert frame.selectExpr(matches("name", [], [])).first()[0] is True
    assert frame.selectExpr(matches("name", ["IDÁDE"])).first()[0] is True


@pytest.mark.parametrize(
    "answer, flag",
    [
        (None, None), ("", None), ("  ", None), ("nan", None), ("NaN ", None), ("<NA>", None), (" \t", None),
        ("1", 1), ("1.0", 1), ("true", 1), (" TRUE ", 1), ("Sim", 1), ("\tYES\n", 1), (" sim ", 1),
        ("0", 0), ("0.0", 0), ("False", 0), ("nao", 0), ("NÃO", 0), ("não ", 0), ("No", 0), ("00", 0), ("0e0", 0), (".0", 0),
        ("Python", 1), ("2", 1), ("-1", 1), ("0d", 1), ("none", 1), ("0 0", 1), (".", 1), ("não", 1),
    ],
)
def test_to_flag(spark, answer, flag):
    frame = spark.createDataFrame([(answer,)], "answer string").selectExpr(f"{to_flag('answer')} AS flag")
    assert frame.first()[0] == flag
    assert dict(frame.dtypes)["flag"] == "int"


def test_null_tokens(spark):
    cells = [*NULL_TOKENS, None, "Null", " NA", "none", "0", "-"]
    rows = spark.createDataFrame([(c,) for c in cells], "cell string").selectExpr("cell", null_tokens("cell")).collect()
    assert [value for _, value in rows] == [None if c in NULL_TOKENS else c for c in cells]


def test_literals_are_taken_literally(spark):
    text = "it's \\ \"50%\" \\n ${x}"
    assert spark.range(1).selectExpr(literal(text)).first()[0] == text
    assert spark.range(1).selectExpr(contains_any(literal(text), ["'s \\"])).first()[0] is True
