from __future__ import annotations

import random
from datetime import datetime

from pyspark.sql import functions as F

from fojas.operators import units

COLS = "id long, documento_id long, metodo string, campo string, valor string, score double, deleted_at timestamp"
DOCS = "id long, tipo_documento string"


def test_quantities(spark):
    rows = [
        (1, 1, "a", "pbv", "12,51 T0N", None, None), (2, 2, "a", "pbv", "48.485L8S", None, None), (3, 3, "a", "pbv", "27,27 MIL KG", None, None), (4, 4, "a", "pbv", "1.360", None, None),
        (5, 4, "b", "unidad_pbv", "K6", None, None), (6, 5, "a", "pbv", "1.8", None, None), (7, 5, "a", "unidad_pbv", "Ton.", None, None), (8, 6, "a", "potencia_motor", "209HF", None, None),
        (9, 7, "a", "potencia_motor", "136,4 K.W.", None, None), (10, 8, "a", "pbv", "5 000 KG", None, datetime(2024, 1, 1)), (11, 9, "a", "pbv", "S/I", None, None), (12, 10, "a", "pbv", "2.000", None, None),
        (13, None, "a", "pbv", "2.000 KG", None, None), (14, 11, "a", "pbv", None, None, None), (15, 12, "a", "potencia_motor", "70 KCAL/S", None, None), (16, 12, "b", "potencia_motor", "70 KCAL/S", None, None),
    ]
    docs = spark.createDataFrame([(i, "nativo") for i in range(1, 13)], DOCS)
    got = {r["documento_id"]: r for r in units.common_units(spark.createDataFrame(rows, COLS).withColumn("unit", F.lit("x")).withColumn("base", F.lit(1)), docs).collect()}
    base = {k: round(r["base"]) for k, r in got.items() if r["destino"] == "declarada"}
    assert base == {1: 12510, 2: 21992, 3: 27270, 4: 1360, 5: 1800, 6: 156, 7: 136, 12: 293}
    assert got[10]["destino"] == "revisar" and set(got) == {1, 2, 3, 4, 5, 6, 7, 10, 12}


def test_empty(spark):
    assert units.common_units(spark.createDataFrame([], COLS), spark.createDataFrame([], DOCS)).count() == 0


def test_missing_units_are_predicted(spark):
    """Held-out: the units of a tenth of the rows are hidden; confident assignments must be right."""
    rng = random.Random(3)
    rows, truth = [], {}
    for i in range(2, 700):
        ton = rng.random() < 0.5
        kg = rng.randint(10, 400) * 100
        text = f"{kg / 1000:.1f}" if ton else str(kg)
        hidden = i % 10 == 0
        rows.append((i, i, "doctr", "pbv", text if hidden else text + (" TON" if ton else " KG"), None, None))
        if hidden:
            truth[i] = float(f"{kg / 1000:.1f}") * 1000 if ton else kg
    out = units.common_units(spark.createDataFrame(rows, COLS), spark.createDataFrame([(i, "nativo") for i in range(2, 700)], DOCS))
    sure = {r["documento_id"]: r["base"] for r in out.where("destino = 'asignada'").collect()}
    assert len(sure) > 0.8 * len(truth) and all(abs(sure[k] - truth[k]) < 1 for k in sure)


def test_collecting_record_is_read_whole(spark, tmp_path):
    """Every number on documento_id 1 comes out, with the unit within it only: the record's unit rows speak for no sheet. Documents are as without it."""
    rows = [
        (1, 1, "a", "pbv", "12,51 T0N", None, None), (2, 1, "b", "pbv", "12,51 TON", None, None), (3, 1, "a", "pbv", "5.000 KG", None, None), (4, 1, "a", "pbv", "7.200", None, None),
        (5, 1, "a", "unidad_pbv", "KG", None, None), (6, 1, "a", "potencia_motor", "209 HP", None, None), (7, 1, "a", "pbv", "9.000 KG", None, datetime(2024, 1, 1)),
        (8, 4, "a", "pbv", "1.360", None, None), (9, 4, "b", "unidad_pbv", "KG", None, None), (10, 4, "b", "pbv", "1.900", None, None), (11, 4, "c", "pbv", "1.360", None, None),
    ]
    spark.createDataFrame(rows, COLS).write.parquet(f"{tmp_path}/campos.parquet")
    spark.createDataFrame([(1, "nativo"), (4, "nativo")], DOCS).write.parquet(f"{tmp_path}/documentos.parquet")
    got = sorted((r["documento_id"], r["campo"], r["num"], r["destino"] == "declarada", r["destino"] == "declarada" and r["unidad"]) for r in units.p5_common_units(spark, str(tmp_path)).collect())
    assert got == [(1, "pbv", "12,51", True, "ton"), (1, "pbv", "5.000", True, "kg"), (1, "pbv", "7.200", False, False), (1, "potencia_motor", "209", True, "hp"), (4, "pbv", "1.360", True, "kg")]
    assert [tuple(r) for r in units.p5_found(spark, str(tmp_path)).collect()] == [(4, "pbv", 1360)]
