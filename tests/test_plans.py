"""Shapes of plans that have to hold at any size, and what stands in for literals where lists are long."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from fojas import session
from fojas.functions import extract as X
from fojas.functions.fixed import BODY_KINDS
from fojas.operators import agreement, consolidate, dictionary, units
from fojas.operators.extraction import Dictionaries, extract_wide


def test_a_cluster_must_name_a_shared_folder():
    unset = SimpleNamespace(isDefined=lambda: False)
    sc = SimpleNamespace(master="spark://host:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: unset)))
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d: d)))


def test_long_lists_are_joined(spark):
    texts = spark.createDataFrame([("AZUL MARINO",), ("ROJO",), (None,), ("",), ("GRIS AZULADO",), ("ROJO",)], "v string")
    words = [" azul", "AZUL", "rojo", "gris", "marino", "", None, "azul marino"]
    lists = spark.createDataFrame([(w,) for w in words], "c string")
    terms = dictionary.terms_of(lists, "c")
    got = {r["v"]: (r["n"], r["mas_largo"]) for r in dictionary.contained_in(texts, "v", lists, "c").collect()}
    want = {r["v"]: (r["n"], r["m"]) for r in texts.where("v is not null").distinct().select("v", F.size(dictionary.contained_terms(F.col("v"), terms)).alias("n"), dictionary.longest_contained(F.col("v"), terms).alias("m")).collect()}
    assert got == want and got["AZUL MARINO"] == (3, "AZUL MARINO") and got[""] == (0, "")
    assert dictionary.contained_in(texts, "v", lists.where("c is null"), "c").where("n > 0").count() == 0


def test_neighbours_of_sparse_and_repeated_ids(spark):
    ids = sorted({x * x * 1_000_003 - 5 for x in range(-40, 300)})
    docs = spark.createDataFrame([(i,) for i in [*ids, ids[3], None]], "id long").withColumn("b", F.lit("clash"))
    got = {r["id"]: (r["anterior"], r["siguiente"]) for r in consolidate.neighbours(docs).collect()}
    assert got == {x: (ids[max(i - 1, 0)], ids[min(i + 1, len(ids) - 1)]) for i, x in enumerate(ids)}
    assert consolidate.neighbours(docs.where("id is null")).count() == 0


def test_agreement_totals_against_brute_force(spark):
    rows = [(i, d, c, "m", v, None) for i, (d, c, v) in enumerate([(1, "a", "x"), (1, "a", " x"), (1, "a", "y"), (1, "b", ""), (1, "b", None), (2, "a", "q"), (2, "a", "p"), (None, "a", "z")])]
    df = spark.createDataFrame(rows, "id long, documento_id long, campo string, metodo string, valor string, deleted_at timestamp").withColumn("top", F.lit(7)).drop("top")
    got = {(r["documento_id"], r["campo"]): (r["n_valid"], r["n_distinct"], r["top_k"], r["top"]) for r in agreement.agreement_totals(df).collect()}
    assert got == {(1, "a"): (3, 2, 2, "x"), (2, "a"): (2, 2, 1, "p"), (None, "a"): (1, 1, 1, "z")}


def test_lists_by_default(spark, one):
    own = Dictionaries(communes=["LIMACHE"])
    assert own.bodies == BODY_KINDS
    texts = spark.createDataFrame([(1, "CIUDAD: LIMACHE\nDETALLE\nCARROCERIA: GRUA PLATAFORMA"), (2, "CIUDAD: OTRA\nDETALLE\nTOLVA 12"), (3, None)], "id long, texto_extraccion string")
    got = {r["id"]: (r["ciudad_comprador"], r["tipo_carroceria"]) for r in extract_wide(texts, own, fields=["ciudad_comprador", "tipo_carroceria"]).collect()}
    assert got == {1: ("LIMACHE", "GRUA PLATAFORMA"), 2: ("", "TOLVA"), 3: ("", "")}
    assert one(lambda c: X.locality(c, ["MAIPU", "TALCA"]), "S.I.I. - MAIPU", "5II TALCA:", "SLL TALCAHUANO", "TALCA") == ["MAIPU", "TALCA", "TALCA", ""]


def test_amounts_are_those_read_alone(one):
    text = "NETO 100.000\nIVA 19.000\nTOTAL 119.000"
    assert one(lambda c: F.to_json(X.amounts(c)), text, "SON: CIENTO DIECINUEVE MIL", "nada", None) == ['{"neto":100000,"iva":19000,"total":119000}', '{"total":119000}', "{}", "{}"]
    assert one(lambda c: X.amount_text(X.total_amount(c)), text) == "119000" and one(lambda c: X.amount_text(X.net_amount(c)), "AFECTO 5.000\nMONTO NETO 700") == "700"


def test_hidden_units(spark):
    """Units told by magnitude are assigned, and rightly; with one unit only nothing is."""
    rows = [(i, i, "doctr", "pbv", f"{i % 40 + 5}.{i % 9}{'' if i % 2 else '00'} {'TON' if i % 2 else 'KG'}", None, None) for i in range(2, 900)]
    docs = spark.createDataFrame([(i, "nativo") for i in range(2, 900)], "id long, tipo_documento string")
    df = spark.createDataFrame(rows, "id long, documento_id long, metodo string, campo string, valor string, score double, deleted_at timestamp").withColumn("features", F.lit("clash"))
    got = {r["unidad"]: r for r in units.hidden_units(df, docs).collect()}
    assert set(got) == {"kg", "ton"} and all(r["asignadas"] > 0.8 * r["n"] and r["correctas"] == r["asignadas"] for r in got.values())
    assert all(r["asignadas"] == 0 for r in units.hidden_units(df.where("id % 2 = 0"), docs).collect())
    assert units.hidden_units(df.where("id < 0"), docs).count() == 0
