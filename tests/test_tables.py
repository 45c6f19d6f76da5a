"""Relational operators, on rows with nulls, ties, repeats, empty tables and columns of clashing names."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fojas.operators import agreement, audit, consolidate, dictionary, eav, register, state

COLS = "id long, documento_id long, metodo string, campo string, valor string, score double, deleted_at timestamp"


def campos(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_consolidate(spark):
    rows = [
        (1, 1, "paddleocr", "marca", "A", 0.5, None), (2, 1, "easyocr", "marca", "B", 0.5, None), (3, 1, "doctr", "marca", "C", 0.5, None),
        (4, 1, "doctr", "color", "", 1.0, None), (5, 1, "doctr", "color", "x", 0.3, None), (6, 1, "doctr", "anio", "9", None, None),
        (7, 2, "doctr", "marca", "Z", 1.0, datetime(2024, 1, 1)), (8, 2, None, "marca", None, 1.0, None), (9, None, "doctr", "marca", "N", 1.0, None),
    ]
    got = {(r["documento_id"], r["campo"]): r["valor"] for r in consolidate.consolidate(campos(spark, rows)).collect()}
    assert got == {(1, "marca"): "B", (1, "color"): "x", (1, "anio"): "9", (None, "marca"): "N"}
    assert consolidate.consolidate(campos(spark, [])).count() == 0
    assert consolidate.consolidate(campos(spark, rows), include_deleted=True).where("documento_id = 2").count() == 1
    extra = campos(spark, rows).withColumn("x", F.lit(1)).withColumn("top", F.lit("a"))
    assert consolidate.consolidate(extra).count() == 4


@settings(max_examples=10, deadline=None)
@given(st.permutations(list(range(6))))
def test_consolidation_ignores_order(spark, order):
    rows = [(i, 1, m, "marca", v, s, None) for i, (m, v, s) in enumerate([("a", "x", 0.5), ("b", "y", 0.5), ("easyocr", "z", 0.4), ("doctr", "w", None), ("a", "x", 0.5), ("c", "", 1.0)])]
    assert consolidate.consolidate(campos(spark, [rows[i] for i in order])).first()["valor"] == "x"


def test_pivot_and_back(spark):
    df = spark.createDataFrame([(1, "marca", "A"), (1, "color", "B"), (2, "marca", "C"), (2, "raro", "D")], "documento_id long, campo string, valor string")
    wide = consolidate.publish_wide(df, fields=["marca", "color"])
    assert {r["documento_id"]: (r["marca"], r["color"]) for r in wide.collect()} == {1: ("A", "B"), 2: ("C", None)}
    back = eav.wide_to_eav(wide, ["documento_id"], ["marca", "color"])
    assert {tuple(r) for r in back.collect()} == {(1, "marca", "A"), (1, "color", "B"), (2, "marca", "C")}


@pytest.mark.parametrize(("values", "want"), [(["a"], [0.2]), (["a", "b"], [0.2, 0.2]), (["a", "a", "b"], [1, 1, 0.3]), (["a", "a", " "], [1, 1, 0]), (["a", "a", "b", "b"], [1, 1, 0.3, 0.3]), ([None, " "], [])])
def test_agreement(spark, values, want):
    rows = [(i, 1, f"m{i}", "marca", v, None, None) for i, v in enumerate(values)]
    got = [r["score"] for r in agreement.score_by_agreement(campos(spark, rows)).orderBy("id").collect()]
    assert got == want


def test_wide_typed(spark):
    rows = [
        (1, 5, "a", "Anio", "2O20", 0.1, None), (2, 5, "b", "AÑO", "2020", 0.9, None), (3, 5, "c", "fechaDocumento", "3 de marzo de 2024", 0.1, None), (4, 5, "c", "MONTO-NETO", "$ 1.234.567.-", 0.1, None),
        (5, 5, "c", "asientos", "CINCO", 0.1, None), (6, 5, "c", "puertas", "S/I", 0.1, None), (7, 6, "c", "color", None, None, None), (8, 6, "c", "anio", "1999", None, datetime(2024, 1, 1)),
        (9, None, "c", "color", "x", None, None), (10, 5, "b", "AÑO", "2020", 0.9, None), (11, 5, "c", "monto_total", "8.665.281,00", None, None), (12, 5, "c", None, "x", None, None),
    ]
    got = {r["documento_id"]: r for r in eav.eav_to_wide(campos(spark, rows).withColumn("pos", F.lit(3)).withColumn("v", F.lit("k"))).collect()}
    assert set(got) == {5, 6}
    r = got[5]
    assert (r["anio"], str(r["fecha_documento"]), r["monto_neto"], r["asientos"], r["puertas"], r["monto_total"]) == (2020, "2024-03-03", 1234567, 5, None, 8665281)
    assert got[6]["anio"] is None and got[6]["color"] is None
    assert eav.eav_to_wide(campos(spark, [])).count() == 0


def test_read_dates(one):
    from fojas.functions.reading import read_date

    got = one(read_date, "18.04.24", "2024-05-07", "14-JUL-2024", "29/4/2023", "25/03/202S", "FECHA 10-08-2023", "30/02/2024", "S/I", None)
    assert [str(x) if x else None for x in got] == ["2024-04-18", "2024-05-07", "2024-07-14", "2023-04-29", "2025-03-25".replace("2025", "2025"), "2023-08-10", None, None, None]


def test_register(spark):
    new = spark.createDataFrame([("h1", "a.pdf"), ("h1", "a.pdf"), ("h2", "b.pdf")], "hash_archivo string, nombre_archivo string")
    old = spark.createDataFrame([("h2", "b.pdf")], "hash_archivo string, nombre_archivo string")
    first = register.register(new, old)
    assert [tuple(r) for r in first.collect()] == [("h1", "a.pdf")]
    # registering once more changes nothing
    assert register.register(new, old.union(first)).count() == 0
    pages = spark.createDataFrame([("a.PDF", ["x", "y"]), ("b.pdf", ["z"]), ("c.pdf", [])], "n string, p array<string>")
    got = {(r["nombre_pagina"], r["pagina"], r["texto_pagina"]) for r in register.explode_pages(pages, "p", "n").collect()}
    assert got == {("a_1.pdf", 1, "x"), ("a_2.pdf", 2, "y"), ("b.pdf", 1, "z")}
    manifest = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", "4")], "nombre_archivo string, md5 string")
    files = spark.createDataFrame([("a", "1"), ("b", "x"), ("d", "4")], "nombre_archivo string, md5 string")
    out = register.compare_manifest(files, manifest, files.where("nombre_archivo = 'd'"))
    assert {tuple(r) for r in out.collect()} == {("a", "OK"), ("b", "MD5 MISMATCH"), ("c", "ERROR"), ("d", "SKIP")}
    blocks = spark.createDataFrame([([(5.0, 1.0, "b"), (1.0, 1.0, "a"), (0.0, 9.0, "c")],)], "b array<struct<x:double,y:double,texto:string>>")
    assert blocks.select(register.blocks_in_reading_order(F.col("b"))).first()[0] == "a\nb\nc"


def test_state(spark):
    docs = spark.createDataFrame([(1, 2, None), (2, 2, None), (3, 3, None)], "id long, estado int, deleted_at timestamp")
    out = state.advance(docs, spark.createDataFrame([(1,), (1,), (3,), (None,)], "documento_id long"), 3, 2)
    assert {r["id"]: r["estado"] for r in out.collect()} == {1: 3, 2: 2, 3: 3}
    gone = state.soft_delete(spark.createDataFrame([(1, None), (2, None)], "documento_id long, deleted_at timestamp"), spark.createDataFrame([(1,)], "documento_id long"), "2024-01-01")
    assert {r["documento_id"]: r["deleted_at"] is None for r in gone.collect()} == {1: False, 2: True}


def test_upsert_and_overrides(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 5)], "k long, v string, t long")
    b = spark.createDataFrame([(1, "n", 1), (3, "z", 0)], "k long, v string, t long")
    assert {tuple(r) for r in consolidate.upsert(a, b, ["k"], "t").select("k", "v").collect()} == {(1, "n"), (2, "y"), (3, "z")}
    best = spark.createDataFrame([(1, "marca", "A")], "documento_id long, campo string, valor string")
    over = spark.createDataFrame([(1, "marca", "B"), (1, "color", "C")], "documento_id long, campo string, valor string")
    assert {(r["campo"], r["valor"]) for r in consolidate.override_merge(best, over).collect()} == {("marca", "B"), ("color", "C")}


def test_neighbours(spark):
    ids = [1, 2, 9, 40, 41, 100]
    docs = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r["id"]: (r["anterior"], r["siguiente"]) for r in consolidate.neighbours(docs).collect()}
    assert got == {x: (ids[max(i - 1, 0)], ids[min(i + 1, len(ids) - 1)]) for i, x in enumerate(ids)}


def test_dictionary(spark):
    codes = spark.createDataFrame([("A", "ABX1"), ("A", "ZZZ"), ("B", "ABX1")], "g string, c string")
    prefixes = spark.createDataFrame([("A", "AB"), ("A", "ABX"), ("B", "Q")], "g string, p string")
    assert [tuple(r) for r in dictionary.prefix_lookup(codes, prefixes, "g", "c", "p").collect()] == [("A", "ABX1", "ABX")]
    terms = dictionary.terms_of(spark.createDataFrame([(" rojo",), ("ROJO",), ("rojo italiano",), (None,), ("",)], "color string"), "color")
    assert terms == ["ROJO ITALIANO", "ROJO"]


def test_audit(spark):
    lines = spark.createDataFrame([("2024-01-01 10:00:00 | INFO | a.py:1 | x",), ("2024-01-01 11:00:00,5 - ERROR - y",), ("ruido",), (None,)], "value string")
    parsed = audit.parse_log(lines)
    row = audit.level_per_day(parsed).first()
    assert (row["INFO"], row["WARNING"], row["ERROR"]) == (1, 0, 1)
    assert audit.retained(parsed, "2024-03-01", 5).count() == 2
    assert audit.day_summary(audit.level_per_day(parsed)).first()["linea"].split() == ["2024-01-01", "1", "0", "1"]
    pairs = spark.createDataFrame([("marca", "", "t1"), ("marca", "x", "t2"), ("color", None, "t3")], "campo string, valor string, texto string")
    got = {r["campo"]: (r["total"], r["vacios"], r["pct_vacios"], r["muestras"]) for r in audit.fill_rate(pairs).collect()}
    assert got == {"marca": (2, 1, 50.0, ["t1"]), "color": (1, 1, 100.0, ["t3"])}
    assert Counter(r["estado"] for r in register.status_counts(spark.createDataFrame([("OK",), ("ERROR x",)], "resultado string")).collect()) == {"OK": 1, "ERROR": 1}
