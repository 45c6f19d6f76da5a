"""Plain PDF files made here, read back: pages, order of text, tables of characters, images, broken files."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fojas.operators.register import native_text, upload_result, valid_text
from fojas.sources import images as I
from fojas.sources.extractors import extract_texts
from fojas.sources.pdf import NativeText, Pdf, pdf_metadata


def made(pages: list[bytes], flate: bool = True, image: tuple[int, int] | None = None, table: bytes | None = None) -> bytes:
    """A PDF of content streams."""
    out = [b"<< /Type /Catalog /Pages 2 0 R >>", b""]
    kids = []
    font = b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica" + (b" /ToUnicode 4 0 R" if table else b"") + b" >>"
    out += [font, b"<< /Length %d >>\nstream\n%s\nendstream" % (len(table or b""), table or b"")]
    out.append(b"<< /Type /XObject /Subtype /Image /Width %d /Height %d >>\nstream\n\nendstream" % (image or (0, 0)))
    for content in pages:
        body = zlib.compress(content) if flate else content
        out.append(b"<< /Length %d%s >>\nstream\n%s\nendstream" % (len(body), b" /Filter /FlateDecode" if flate else b"", body))
        n = len(out)
        extra = b" /XObject << /Im1 5 0 R >>" if image else b""
        out.append(b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R /Resources << /Font << /F1 3 0 R >>%s >> >>" % (n, extra))
        kids.append(n + 1)
    out[1] = b"<< /Type /Pages /MediaBox [0 0 612 792] /Count %d /Kids [%s] >>" % (len(kids), b" ".join(b"%d 0 R" % k for k in kids))
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (i + 1, b) for i, b in enumerate(out)) + b"trailer << /Root 1 0 R >>\n%%EOF"


PAGE = b"BT /F1 12 Tf 300 700 Td (derecha \\(a\\)) Tj ET BT /F1 12 Tf 50 700 Td (izquierda) Tj 0 -40 Td [(PA) -20 (GO) -400 (\\311XITO)] TJ ET"


@pytest.mark.parametrize("flate", [True, False])
def test_text(flate):
    page = Pdf(made([PAGE], flate)).pages()[0]
    assert page.text("plain") == "derecha (a) izquierda\nPAGO ÉXITO" and page.text("blocks") == "izquierda derecha (a)\nPAGO ÉXITO"
    assert page.text("layout") == "derecha (a)\nizquierda\nPAGO ÉXITO"
    with pytest.raises(ValueError):
        page.text("otro")


def test_pages_in_order_and_tables():
    table = b"2 beginbfchar <0001> <0041> <0002> <00D1> endbfchar 1 beginbfrange <0100> <0102> <0061> endbfrange"
    pdf = Pdf(made([b"BT /F1 9 Tf 10 10 Td <000100020100> Tj ET", b"BT /F1 9 Tf 10 10 Td <01010102> Tj T* <0001> ' ET"], table=table))
    assert [p.text() for p in pdf.pages()] == ["AÑa", "bcA".replace("cA", "c A")]


def test_object_streams():
    inner = b"<< /Type /Catalog /Pages 2 0 R >>"
    packed = zlib.compress(b"1 0 " + inner)
    body = made([PAGE]).replace(b"1 0 obj\n" + inner + b"\nendobj\n", b"90 0 obj\n<< /Type /ObjStm /N 1 /First 4 /Filter /FlateDecode /Length %d >>\nstream\n%s\nendstream\nendobj\n" % (len(packed), packed))
    assert len(Pdf(body).pages()) == 1


def test_metadata(spark):
    long = b"BT 10 10 Td (" + b"palabra " * 80 + b") Tj ET"
    files = [("a.pdf", made([PAGE, PAGE], image=(2550, 3300))), ("b.pdf", made([long])), ("c.pdf", b"nada"), ("d.pdf", None), ("e.pdf", b""), ("f.pdf", made([PAGE], image=(1700, 2200)))]
    df = spark.createDataFrame([(n, c if c is None else bytearray(c)) for n, c in files], "nombre_archivo string, content binary").withColumn("error", F.lit("clash"))
    got = {r["nombre_archivo"]: r for r in pdf_metadata(df).collect()}
    a = got["a.pdf"]
    assert (a["numero_paginas"], a["tipo_documento"], round(a["resolucion_ppi"]), a["calidad_estimativa"]) == (2, "escaneado", 300, 90)
    assert (got["b.pdf"]["tipo_documento"], got["b.pdf"]["resolucion_ppi"], got["b.pdf"]["calidad_estimativa"]) == ("nativo", 0.0, 40)
    assert got["f.pdf"]["calidad_estimativa"] == 70 and got["a.pdf"]["tamano_bytes"] == len(files[0][1])
    assert all(got[k]["error"] and got[k]["numero_paginas"] is None for k in ("c.pdf", "d.pdf", "e.pdf"))
    assert pdf_metadata(df.where("nombre_archivo = 'x'")).count() == 0


def test_native_extractor(spark):
    df = spark.createDataFrame([("a.pdf", bytearray(made([PAGE, b""]))), ("c.pdf", bytearray(b"%PDF /Encrypt 3 0 R"))], "nombre_archivo string, content binary")
    rows = {(r["nombre_archivo"], r["pagina"]): r for r in extract_texts(df, {"nativo": NativeText}).collect()}
    assert rows["a.pdf", 1]["texto"].startswith("izquierda") and rows["a.pdf", 2]["texto"] == "" and rows["c.pdf", 0]["error"].startswith("ValueError")


def test_native_text(spark):
    df = spark.createDataFrame([(1, ["  uno ", None, "tres"]), (2, []), (3, None)], "i int, p array<string>").select("i", native_text(F.col("p")).alias("t"))
    got = {r["i"]: r["t"] for r in df.collect()}
    assert got[1] == "--- Página 1 ---\nuno\n\n--- Página 2 ---\n\n\n--- Página 3 ---\ntres" and got[2] == "" and got[3] is None
    bad = spark.createDataFrame([(bytearray(b"a\xffb\xc3\xa9"),)], "c binary").select(valid_text(F.col("c")).alias("t")).first()["t"]
    assert bad == "abé"


def test_upload_result(spark):
    df = spark.createDataFrame([(5, True), (5, False), (None, True), (None, False)], "n long, t boolean")
    assert [r[0] for r in df.select(upload_result(F.col("n"), F.col("t"))).collect()] == [0, 5, -1, -1]
    assert [r[0] for r in df.select(upload_result(F.col("n"), F.col("t"), True)).collect()] == [5, 5, -1, -1]


def test_images():
    rng = np.random.default_rng(1)
    page = np.full((120, 90), 230, np.uint8)
    page[40:44, 20:70] = 30
    noisy = np.clip(page + rng.integers(-8, 9, page.shape), 0, 255).astype(np.uint8)
    assert set(np.unique(I.otsu(noisy))) == {0, 255} and (I.otsu(noisy)[40:44, 20:70] == 0).all() and (I.otsu(noisy)[60:, :] == 255).all()
    marks = I.prepared(page, "tesseract")
    assert marks[41:43, 25:65].mean() > 200 and marks[80:110, 10:80].mean() < 60
    assert I.grey(np.dstack([page, page, page])).tolist() == page.tolist() and I.prepared(page, "paddleocr") is page
    assert np.ptp(I.equalised(np.tile(np.arange(100, 110, dtype=np.uint8), (10, 1)))) == 255
    dots = np.zeros((9, 9), np.uint8)
    dots[4, 4] = 255
    assert I.median(dots).max() == 0


def test_straightened():
    page = np.zeros((200, 200), np.uint8)
    page[70:130, 30:170] = 255
    tilted = I.turned(page, 7.0)
    assert abs(abs(I.skew(tilted)) - 7.0) < 0.7 and abs(I.skew(I.turned(tilted, I.skew(tilted)))) < 1.0
    assert I.skew(np.zeros((5, 5), np.uint8)) == 0.0


def test_second_look():
    page = np.arange(400).reshape(20, 20)
    assert I.lower_right(page).tolist() == page[10:, 10:].tolist() and I.lower_right(np.zeros((9, 30))) is None and I.lower_right(None) is None
    seen = lambda a: ["todo"] if a.shape == (20, 20) else ["TOTAL 5"]
    assert I.with_totals(seen, [page]) == "todo\n\n[SEGMENTO_TOTALES]\nTOTAL 5"
    assert I.with_totals(lambda a: ["todo"] if a.shape == (20, 20) else [], [page]).endswith(I.NO_TOTALS)
    assert I.with_totals(lambda a: None, [page]) == "" and I.with_totals(seen, []) == ""
