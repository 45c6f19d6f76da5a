from __future__ import annotations

import math
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fojas.functions import text as T


def test_normalize_text(one):
    assert one(T.normalize_text, "Factura Nº 5, año") == "FACTURA NO S ANO"
    assert one(T.normalize_text, None, "") == ["", ""]


def test_ngrams(one):
    assert one(lambda c: T.ngrams(F.split(c, " "), 2), "a b c", "a") == [["a b", "b c"], []]


def test_clean_value(one):
    # the .0 rule comes before hyphens are taken off
    assert one(T.clean_value, "--12.0--", ": abc :", "12.0", "x!!", "ab...", None, "  ") == ["12.0", "abc", "12", "x", "ab", "", ""]


def test_header_and_body(one):
    early = "FACTURA\nRUT 1\nDETALLE\n" + "cosa\n" * 10
    late = "cosa\n" * 10 + "DETALLE\nfin"
    pick = lambda c: T.header_and_body(c)
    a, b = one(pick, early, late)
    assert a["cabecera"].strip() == "FACTURA\nRUT 1" and a["cuerpo"].strip().startswith("DETALLE")
    assert b["cabecera"] == b["cuerpo"] == late
    assert one(pick, None)["cabecera"] == ""


def test_footer(one):
    assert one(T.footer, "a\n[SEGMENTO_TOTALES]\nTOTAL 1 ", " a ") == ["[SEGMENTO_TOTALES]\nTOTAL 1", "a"]


def test_number_words(one):
    assert one(T.number_words, "SON: CIENTO DIECINUEVE MIL", "SON: DOS MILLONES TRESCIENTOS MIL", "nada", None) == [119000, 2300000, None, None]
    assert one(lambda c: T.number_words(c, more=True), "SON: VEINTICINCO MIL") == 25000


def test_line_numbers(one):
    assert one(T.numbered_lines, "a\r\nb") == "0001: a\n0002: b"


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="abñ €\n", max_size=40))
def test_entropy_is_shannon(one, s):
    n = len(s)
    want = -sum(k / n * math.log2(k / n) for k in Counter(s).values()) if n else 0.0
    assert math.isclose(one(T.entropy, s), want, abs_tol=1e-9)
