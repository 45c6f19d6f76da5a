"""The whole way from texts to wide rows, at once and as files arrive, and publication."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fojas.operators.extraction import Dictionaries
from fojas.plans.pipeline import publish, run_pipeline, to_publish

TEXT = "FACTURA ELECTRONICA\nFOLIO: 123456\nRUT 11.111.111-1\nRUT 22.222.222-2\nCIUDAD: LIMACHE\nDETALLE\nMARCA: VOLVO COLOR: ROJO\nCARROCERIA: TOLVA\nNETO 100.000\nIVA 19.000\nTOTAL 119.000"
OWN = Dictionaries(communes=["LIMACHE"], makes=["VOLVO"], colours=["ROJO"])


def rows(spark, ids):
    return spark.createDataFrame([(i, i, "doctr", TEXT if i != 9 else None) for i in ids], "id long, documento_id long, metodo string, texto_extraccion string")


def test_batch_and_stream_give_the_same(spark, tmp_path):
    rows(spark, [1, 2]).coalesce(1).write.parquet(f"{tmp_path}/in")
    rows(spark, [3, 9]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    assert run_pipeline(spark, f"{tmp_path}/in", f"{tmp_path}/a", 2025, dictionaries=OWN) is None
    run_pipeline(spark, f"{tmp_path}/in", f"{tmp_path}/b", 2025, "stream", OWN).awaitTermination()
    read = lambda x: sorted(map(str, spark.read.parquet(f"{tmp_path}/{x}/wide").drop("batch").collect()))
    assert read("a") == read("b") and len(read("a")) == 4
    wide = spark.read.parquet(f"{tmp_path}/a/wide").where("documento_id = 1").first()
    assert (wide["marca"], wide["tipo_carroceria"], wide["ciudad_comprador"], wide["monto_total"], wide["rut_comprador"]) == ("VOLVO", "TOLVA", "LIMACHE", "119000", "22222222-2")
    with pytest.raises(ValueError):
        run_pipeline(spark, f"{tmp_path}/in", f"{tmp_path}/c", 2025, "otro")


def test_publish(spark, tmp_path):
    t = datetime(2024, 1, 1)
    docs = spark.createDataFrame(
        [(1, "a.pdf", None, 1, 10, 5, None, None), (2, "b.pdf", "p.pdf", 1, 10, 5, True, None), (3, "c.pdf", None, 1, 10, 4, None, None), (4, "d.pdf", None, 1, 10, 5, None, t), (5, "e.pdf", None, 1, 10, 6, True, None), (6, "f.pdf", None, 1, 10, 500, None, None)],
        "id long, nombre_archivo string, archivo_padre string, numero_paginas int, tamano_bytes long, estado int, copiado_remoto boolean, deleted_at timestamp",
    )
    values = spark.createDataFrame([(i, "marca", "A", None) for i in range(1, 7)] + [(1, "color", "B", t)], "documento_id long, campo string, valor string, deleted_at timestamp").withColumn("_id", F.lit(3))
    ids = lambda df, c="id": sorted(r[c] for r in df.collect())
    assert ids(to_publish(docs)) == [1] and ids(to_publish(docs, force=True)) == [1, 2, 5] and ids(to_publish(docs, every=True)) == [1] and ids(to_publish(docs, "b.pdf", force=True)) == [2]
    wide, after = publish(docs, values)
    assert [(r["documento_id"], r["marca"], r["color"]) for r in wide.collect()] == [(1, "A", None)] and after.columns == docs.columns
    assert {r["id"]: r["estado"] for r in after.collect()} == {1: 6, 2: 5, 3: 4, 4: 5, 5: 6, 6: 500}
    publish(docs, values, path=f"{tmp_path}/w")
    publish(docs, values, "e.pdf", force=True, path=f"{tmp_path}/w")
    assert ids(spark.read.parquet(f"{tmp_path}/w"), "documento_id") == [1, 5]
    assert publish(docs.where("id < 0"), values)[0].count() == 0
