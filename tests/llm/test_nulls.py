"""Nulls in any column, ties and repeated rows, over all operators that read documents: a defined result and no crash."""

from __future__ import annotations

from pyspark.sql import functions as F

from fojas.llm import canonical, consensus, leakage, names, packing, scanned, subjects

BODY = "El servidor central guarda la respuesta en formato estructurado.\nPágina 1 de 1"


def test_null_ids_of_texts(spark):
    df = spark.createDataFrame([(1, BODY), (None, BODY), (None, None), (2, ""), (1, BODY)], "id long, texto_extraccion string")
    got = sorted((r["texto_id"] or 0, r["linea"], r["tipo"]) for r in scanned.marked_lines(df).collect())
    assert got == [(0, 2, "pagina"), (1, 2, "pagina"), (1, 2, "pagina")]
    assert scanned.repaired(df).count() == 5


def test_null_ids_of_documents(spark):
    item = " ".join(f"palabra{i}" for i in range(40))
    docs = spark.createDataFrame([(1, item), (None, item), (None, None), (2, "nada")], "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (None, None), (8, item)], "item_id long, texto string")
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in leakage.leaked_items(docs, items).collect()) == [(0, 7), (0, 8), (1, 7), (1, 8)]
    labels = spark.createDataFrame([(1, "a"), (None, "a"), (2, None)], "doc_id long, tema string")
    assert subjects.document_subjects(docs, labels, spark.createDataFrame([("a",), (None,)], "tema string")).count() >= 0
    assert packing.token_counts(docs).where("tokens > 0").count() == 3
    sizes = spark.createDataFrame([(1, 5), (None, 7), (2, None)], "doc_id long, tokens long")
    caps = spark.createDataFrame([(None, 10), ("x", None)], "perfil string, capacidad_tokens int")
    rows = packing.containers(sizes, caps).collect()
    assert sorted((r["doc_id"] or 0, r["tokens"]) for r in rows) == [(0, 7), (1, 5)] and {r["perfil"] for r in rows} == {None}


def test_null_values(spark):
    rows = spark.createDataFrame([(1, "color", None), (None, "color", "rojo"), (2, None, "rojo")], "campo_id long, campo string, valor string")
    got = {(r["campo_id"], r["campo"]): r["termino"] for r in canonical.map_values(rows, {"color": ["ROJO"]}, ["campo_id"]).collect()}
    assert got == {(None, "color"): "ROJO", (2, None): ""}
    assert canonical.map_values(rows, {"color": ["ROJO"]}, []).count() == 2
    readings = spark.createDataFrame([(None, 2, "m", "traccion", "4X2", None, None, None), (1, 2, None, "traccion", "4X4", 0.5, None, None), (2, 3, "n", None, "x", float("nan"), None, None)], "id long, documento_id long, metodo string, campo string, valor string, score double, created_at timestamp, deleted_at timestamp")
    items, annotators = consensus.consensus(readings)
    assert [(r["documento_id"], r["valor"]) for r in items.collect()] == [(2, "4X2")] and annotators.select("metodo").distinct().count() == 1
    people = spark.createDataFrame([(None,), ("",), (",",), (". .",), ("S.A.",), ("Ñ",), ("ANA ROJAS",), ("ANA ROJAS",)], "nombre string").withColumn("h", F.lit(1))
    got = {r["nombre"] for r in names.link_names(people).collect()}
    assert got == {",", ". .", "S.A.", "Ñ", "ANA ROJAS"}
