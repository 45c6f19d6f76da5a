"""One invented text per branch, expectations worked out by hand."""

from __future__ import annotations

from fojas.functions import extract as X
from fojas.functions.fuzzy import axles_of, document_type_of, plain_phrase
from fojas.operators.extraction import Dictionaries, extract_rows, extract_wide
from fojas.plans import catalog

RUTS = "RUT 11.111.111-1\nRUT 22.222.222-2\n"


def test_document_number(one):
    assert one(X.document_number, "FOLIO: 123456", "N 1234", "N° 55555", None) == ["123456", "", "55555", ""]


def test_id_numbers(one):
    assert one(X.supplier_id, RUTS, "RUT 11.111.111-1", "x") == ["11111111-1", "11111111-1", ""]
    assert one(X.buyer_id, RUTS, "RUT 11.111.111-1") == ["22222222-2", ""]


def test_dates(one):
    texts = ["FECHA 03-02-2024", "FECHA\n03-02-2024", "FECHA VENC 05-05-2024", "x\n3 DE MARZO DE 2024", "FECHA EMISION\nx\ny\n1-ENE-24"]
    assert one(X.document_date, *texts) == ["03-02-2024", "03-02-2024", "", "3 DE MARZO DE 2024", "1-ENE-24"]


def test_year_seats_doors(one):
    assert one(X.year, "ANO 1979", "ANO: 2020") == ["", "2020"]
    assert one(X.seats, "ASIENTOS: 61", "7 ASIENTOS") == ["", "7"]
    assert one(X.doors, "5 PUERTAS", "PUERTAS 12") == ["5", ""]


def test_plate(one):
    assert one(X.plate, "PATENTE: ABCD12", "PLACA AB1234", "PPU ABCD.12-3") == ["ABCD12", "AB1234", "ABCD.12-3"]


def test_weight(one):
    assert one(X.gross_weight, "PBV 1.500\n2.300", "nada") == ["2300", ""]
    assert one(X.weight_unit, "PBV 1.500 KG", "x 3 TON", "x") == ["KG", "TON", ""]


def test_power(one):
    assert one(X.power, "POTENCIA MOTOR: 120 HP", "x\n150 CV", "UNIDAD KW") == ["120", "150", ""]
    assert one(X.power_unit, "POTENCIA 120 HP", "UNIDAD KW") == ["HP", ""]


def test_amounts(one):
    text = "NETO 100.000\nIVA 19.000\nTOTAL 119.000"
    assert one(X.net_amount, text, "x") == [100000, None]
    assert one(X.tax_amount, text, "IVA 1900") == [19000, None]
    assert one(X.total_amount, text, "SON: CIENTO DIECINUEVE MIL", "x") == [119000, 119000, None]


def test_supplier_name(one):
    before = "ACME SPA\nRUT 11.111.111-1\nOTRA LTDA"
    after = "X\nRUT 11.111.111-1\nOTRA S A"
    assert one(X.supplier_name, before, after, "SANTIAGO SA\nRUT 11.111.111-1", "ACME SPA") == ["ACME SPA", "OTRA S A", "", ""]


def test_buyer_name(one):
    beside = "N° 123456\nSEÑOR(ES): JUAN PEREZ\nRUT: 1"
    below = "N° 123456\nCLIENTE\nGIRO X\nMARIA SOTO"
    assert one(X.buyer_name, beside, below, "SEÑOR: X Y Z") == ["JUAN PEREZ", "MARIA SOTO", ""]


def test_buyer_address_phone(one):
    assert one(lambda c: X.buyer_address(c, ["LIMACHE"]), "RUT 11.111.111-1\nDIRECCION: Calle 12 Limache") == "CALLE 12"
    assert one(X.buyer_phone, RUTS + "TELEFONO: +56 912345678", RUTS + "TELEFONO\n1234 5678", RUTS + "TELEFONO 12") == ["+56912345678", "12345678", ""]


def test_places(one):
    assert one(lambda c: X.buyer_commune(c, ["LOS", "LOS ANDES"]), "COMUNA: LOS ANDES") == "LOS ANDES"
    assert one(lambda c: X.locality(c, ["MAIPU"]), "S.I.I. - MAIPU") == "MAIPU"


def test_vehicle_fields(one):
    assert one(X.vehicle_type, "TIPO DE VEHICULO : CAMIONETA", "un MINIBUS rojo") == ["CAMIONETA", "MINIBUS"]
    assert one(X.model, "MODELO: HILUX 2.4 COLOR ROJO") == "HILUX 2.4"
    assert one(X.engine_number, "NRO MOTOR: AB1234567 COLOR ROJO", "ABCDEFG1") == ["AB1234567", "ABCDEFG1"]
    assert one(X.chassis_number, "CHASIS: ABC123456789DEF") == "ABC123456789DEF"
    assert one(X.vehicle_number, "V.I.N.: 1HGCM82633A004352") == "1HGCM82633A004352"
    assert one(lambda c: X.colour(c, ["ROJO", "AZUL MARINO", "BLANCO"]), "COLOR: AZUL MARINO / BLANCO 3") == "AZUL MARINO BLANCO"
    assert one(X.fuel, "TIPO COMBUSTIBLE: DIESEL", "x\nBENCINA") == ["DIESEL", "BENCINA"]
    assert one(X.drive, "TRACCION: 4X2") == "4X2"
    assert one(X.displacement, "CILINDRADA: 1.600 CC", "CILINDRADA 1600") == ["1.600 CC", "1600"]
    assert one(X.gearbox, "TRANSMISION: M/T", "AUTOMATICA o MANUAL") == ["MANUAL", "MANUAL"]
    assert one(X.load, "CARGA UTIL: 1.200") == "1200"
    assert one(X.contract_number, "CONTRATO N° 123456", "texto", "OPERACION:\n9988") == ["123456", "", "9988"]


def test_make_and_code(one):
    makes = ["HINO", "MERCEDES BENZ"]
    assert one(lambda c: X.make(c, makes), "MARCA: HINO", "un MERCEDES BENZ nuevo", "HINOS") == ["HINO", "MERCEDES BENZ", ""]
    from pyspark.sql import functions as F

    assert one(lambda c: X.report_code(c, F.lit("BMW")), "CIT: AB123456", "x BM12345-A y") == ["AB123456", "BM12345-A"]


def test_report_codes(spark, tmp_path):
    """A code off a report-code line is given by the make read from the same text."""
    texts = {1: "MARCA: HINO\nx HO12345-A y", 2: "MARCA: HYUNDIA\nBM12345-A HY12345-B", 3: "un BMW nuevo\nBM12345-A", 4: "BM12345-A", 5: "CIT: AB123456", 6: None}
    spark.createDataFrame(list(texts.items()), "id long, texto_extraccion string").write.parquet(str(tmp_path / "textos.parquet"))
    spark.createDataFrame([("HINO",), ("BMW",), ("HYUNDAI",)], "marca string").write.parquet(str(tmp_path / "diccionario_marcas.parquet"))
    got = {r["id"]: r["valor"] for r in catalog.queries()["report_codes"](spark, str(tmp_path)).collect()}
    assert got == {1: "HO12345-A", 2: "HY12345-B", 3: "BM12345-A", 4: "", 5: "AB123456", 6: ""}


def test_similar():
    assert document_type_of(plain_phrase("FACTVRA ELECTRONICA N 5")) == "FACTURA ELECTRONICA"
    assert document_type_of("NADA QUE VER AQUI") == "DESCONOCIDO"
    assert axles_of(["S2-D4"]) == "S2-D4" and axles_of(["S2-D5"]) in ("S2-D4", "S2-D6", "S2-D8") and axles_of(["ZZZZZZ"]) == ""


def test_extract_wide_and_rows(spark):
    text = "FACTURA ELECTRONICA\nACME SPA\nRUT 11.111.111-1\nN° 123456\nSEÑOR(ES): JUAN PEREZ\nRUT 22.222.222-2\nDETALLE\nMARCA: HINO\nCOLOR: ROJO\nPATENTE: ABCD12\n" + "x\n" * 60 + "[SEGMENTO_TOTALES]\nNETO 100.000\nIVA 19.000\nTOTAL 119.000"
    df = spark.createDataFrame([(7, "doctr", text), (8, "doctr", None), (9, None, "")], "documento_id long, metodo string, texto_extraccion string")
    rows = {r["documento_id"]: r for r in extract_wide(df, Dictionaries(makes=["HINO"], colours=["ROJO"])).collect()}
    assert rows[7]["tipo_doc"] == "FACTURA ELECTRONICA" and rows[7]["marca"] == "HINO" and rows[7]["color"] == "ROJO"
    assert rows[7]["nombre_comprador"] == "JUAN PEREZ" and rows[7]["monto_total"] == "119000" and rows[8]["marca"] == ""
    eav = extract_rows(df.where("documento_id = 7"), Dictionaries(makes=["HINO"])).collect()
    assert {r["archivo_origen"] for r in eav} == {"BD_doc_7_metodo_doctr"} and all(r["valor"] for r in eav) and all(r["score"] is None for r in eav)
