from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from fojas.plans import catalog
from fojas.plans.pipeline import below_minimum, run_batch, score_fields
from fojas.sources import readers, sinks
from fojas.sources.extractors import extract_texts
from fojas.streaming import intake


def fake_engine():
    class Fake:
        name = "falso"

        def pages(self, content: bytes) -> list[str]:
            if content == b"bad":
                raise ValueError("cannot read")
            return content.decode().split("|")

    return Fake


def test_files_and_extractors(spark, tmp_path):
    (tmp_path / "a.PDF").write_bytes(b"x|y")
    (tmp_path / "b.pdf").write_bytes(b"bad")
    (tmp_path / "c.txt").write_bytes(b"no")
    files = readers.pdf_files(spark, str(tmp_path))
    assert {r["nombre_archivo"] for r in files.collect()} == {"a.PDF", "b.pdf"}
    good, bad = sinks.split_errors(extract_texts(files, {"falso": fake_engine()}))
    assert {(r["pagina"], r["texto"]) for r in good.collect()} == {(1, "x"), (2, "y")}
    assert [r["error"] for r in bad.collect()] == ["ValueError: cannot read"]


def test_readers(spark, tmp_path):
    (tmp_path / "ocr_datos_1.json").write_text(json.dumps([{"archivo": "viejo", "texto": "v"}]))
    (tmp_path / "ocr_datos_2.json").write_text(json.dumps([{"archivo_pdf": "a", "texto_ocr": "t", "pagina": 1}, {"archivo": "b", "texto": "u"}]))
    assert {(r["archivo"], r["texto"]) for r in readers.ocr_json(spark, str(tmp_path)).collect()} == {("a", "t"), ("b", "u")}
    (tmp_path / "c.csv").write_text("﻿color\n rojo\nROJO\n\n\"azul marino\"\n", encoding="utf-8")
    assert {r[0] for r in readers.dictionary_csv(spark, str(tmp_path / "c.csv"), "color").collect()} == {"ROJO", "AZUL MARINO"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.dictionary_csv(spark, str(tmp_path / "none.csv"), "color")
    (tmp_path / "x.jsonl").write_text('{"prompt": "p", "response": "{\\"marca\\": \\"A\\"}"}\n{"prompt": "q", "response": "roto"}\n')
    got = {r["prompt"]: r["campos"] for r in readers.jsonl_pairs(spark, str(tmp_path / "x.jsonl")).collect()}
    assert got["p"] == {"marca": "A"} and not got["q"]
    (tmp_path / "s.ini").write_text("[pipeline]\nmax_archivos_por_tanda = 5\n[metodos]\ndoctr = true\neasyocr = 0\n")
    s = readers.read_settings(str(tmp_path / "s.ini"))
    assert (s.batch_files, s.delay_seconds, s.methods) == (5, 5, ("doctr",))
    texts = spark.createDataFrame([("doctr", "x"), ("doctr", " \n"), ("easyocr", "y"), ("doctr", None)], "metodo string, texto_extraccion string")
    assert readers.enabled_texts(texts, s).count() == 1


def test_sinks(spark, tmp_path):
    wide = spark.createDataFrame([("a", "t", "X", None, "")], "archivo string, texto string, marca string, color string, anio string")
    assert sinks.entities(wide, ["marca", "color", "anio"]).first()["entidades"] == {"marca": "X"}
    sinks.write_csv(wide, str(tmp_path / "out"), excel=True)
    assert next((tmp_path / "out").glob("*.csv")).read_text(encoding="utf-8").startswith("﻿archivo,")
    rows = spark.createDataFrame([(1, "marca", "á b"), (1, "anio", "02020"), (1, "raro", "z")], "documento_id long, campo string, valor string")
    pair = sinks.prompt_pairs(spark.createDataFrame([(1, "texto")], "documento_id long, texto_extraccion string"), rows, ["marca", "anio", "color"]).first()
    assert json.loads(pair["response"]) == {"marca": "A B", "anio": "2020", "color": ""} and pair["prompt"] == "texto"
    html = sinks.html_reports(rows.union(spark.createDataFrame([(1, "b", "<&>")], rows.schema))).first()["html"]
    assert "&lt;&amp;&gt;" in html and html.index("anio") < html.index("marca")


def test_export_prompt_pairs(spark, tmp_path):
    """The answer has the thirty target fields, no others, with the document's values."""
    have = {"cilindrada": "1600", "transmision": "MANUAL", "ejes": "S2-D4", "traccion": "4X2", "potencia_motor": "120", "marca": "HINO", "localidad": "ARICA", "placa_patente": "ABCD12", "tipo_doc": "FACTURA ELECTRONICA"}
    rows = [(i, 1, "doctr", "a", f, v, 0.9) for i, (f, v) in enumerate(have.items())]
    rows.append((99, 2, "doctr", "a", "tipo_doc", "FACTURA ELECTRONICA", 0.9))
    fields = spark.createDataFrame(rows, "id long, documento_id long, metodo string, archivo_origen string, campo string, valor string, score double").selectExpr("*", "timestamp'2025-01-01' AS created_at", "timestamp'2025-01-01' AS updated_at", "CAST(NULL AS timestamp) AS deleted_at")
    fields.write.parquet(str(tmp_path / "campos.parquet"))
    texts = spark.createDataFrame([(1, 1, "doctr", "texto"), (2, 2, "doctr", "otro")], "id long, documento_id long, metodo string, texto_extraccion string").selectExpr("*", "CAST(NULL AS timestamp) AS deleted_at")
    texts.write.parquet(str(tmp_path / "textos.parquet"))
    pairs = {r["documento_id"]: json.loads(r["response"]) for r in catalog.queries()["export_prompt_pairs"](spark, str(tmp_path)).collect()}
    got = pairs[1]
    assert set(pairs[2]) == set(got) and not any(pairs[2].values())
    assert " ".join(got) == (
        "numero_documento fecha_documento rut_proveedor rut_comprador nombre_proveedor nombre_comprador tipo_vehiculo marca modelo color anio n_motor n_chasis vin serie "
        "pbv unidad_pbv carga unidad_carga asientos puertas potencia_motor unidad_potencia traccion cilindrada transmision tipo_carroceria combustible cit ejes"
    )
    assert {f: v for f, v in got.items() if v} == {f: v for f, v in have.items() if f not in ("localidad", "placa_patente", "tipo_doc")}


def test_pipeline(spark):
    text = "FACTURA ELECTRONICA\nRUT 11.111.111-1\nN° 123456\nRUT 22.222.222-2\nPATENTE: ABCD12"
    texts = spark.createDataFrame([(1, "doctr", text), (1, "easyocr", text)], "documento_id long, metodo string, texto_extraccion string")
    for agreement_first in (False, True):
        out = run_batch(texts, 2025, agreement_first=agreement_first)
        row = out["wide"].first()
        assert (row["numero_documento"], row["rut_comprador"], row["placa_patente"]) == ("123456", "22222222-2", "ABCD12")
    scores = spark.createDataFrame([(1, "marca", "AB", "x", None), (1, "marca", "AB", "x", 0.7), (1, "marca", "1", "x", 0.0)], "documento_id long, campo string, valor string, metodo string, score double")
    done = score_fields(scores, 2025)
    assert sorted(r["score"] for r in done.collect()) == [0.1, 0.7, 1.0] and below_minimum(done).count() == 1


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i in range(3):
        (src / f"d{i}.pdf").write_bytes(b"x")
    (src / ".tmp.pdf").write_bytes(b"x")
    seen: list[list[str]] = []
    q = intake.run_stream(intake.file_stream(spark, str(src), 2), lambda df, n: seen.append(sorted(r["nombre_archivo"] for r in df.collect())), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert sorted(x for b in seen for x in b) == ["d0.pdf", "d1.pdf", "d2.pdf"] and len([b for b in seen if b]) == 2


def test_sessions(spark):
    base = time.mktime((2024, 1, 1, 0, 0, 0, 0, 0, 0))
    rows = [(1, base), (1, base + 3), (1, base + 60), (2, base), (2, None)]
    df = spark.createDataFrame(rows, "k int, s double").withColumn("ts", F.timestamp_seconds("s"))
    assert sorted(r["n"] for r in intake.intake_sessions(df, "k", "ts").collect()) == [1, 1, 2]


def test_repeats_within_the_watermark(spark, tmp_path):
    rows = [("h1", "a", "2024-01-01"), ("h1", "a", "2024-01-02"), ("h2", "b", "2024-01-01"), (None, "c", "2024-01-01"), (None, "c", "2024-01-01")]
    df = spark.createDataFrame(rows, "hash_archivo string, nombre_archivo string, d string").select("hash_archivo", "nombre_archivo", F.to_timestamp("d").alias("created_at"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = intake.new_readings(stream).writeStream.format("memory").queryName("leidos").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(180)
    assert sorted(r["nombre_archivo"] for r in spark.table("leidos").collect()) == ["a", "b", "c"]
