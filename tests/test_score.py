from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fojas.functions import normalize as N
from fojas.functions import score as S


def digit(body: str) -> str:
    total = sum(int(c) * (2 + i % 6) for i, c in enumerate(reversed(body)))
    r = 11 - total % 11
    return {10: "K", 11: "0"}.get(r, str(r))


def scored(spark, rows, rules="effective"):
    df = spark.createDataFrame(rows, "campo string, valor string, metodo string")
    return [r["s"] for r in df.select(S.score_reading(F.col("campo"), F.col("valor"), F.col("metodo"), 2025, rules).alias("s")).collect()]


@settings(max_examples=20, deadline=None)
@given(st.integers(1, 99_999_999))
def test_check_digit(one, n):
    assert one(S.check_digit, str(n)) == digit(str(n))


def test_check_digit_of_other_text(one):
    assert one(S.check_digit, "12a", "", None) == [None, None, None]


def test_effective_rules(spark):
    rows = [
        ("rut_proveedor", "11111111-1", "x"), ("rut_proveedor", "11111111-2", "x"), ("rut_proveedor", "111111111", "x"), ("tipo_doc", "FACTURA ELECTRONICA", "paddleocr"),
        ("tipo_doc", "FACTURA ELECTRONICA", "doctr"), ("fecha_documento", "31/02/2024", "x"), ("fecha_documento", "03/02/2024", "x"), ("fecha_documento", "03-02-2024", "x"),
        ("anio", "2026", "x"), ("anio", "1800", "x"), ("anio", "abc", "x"), ("vin", "1HGCM826334004352", "x"), ("vin", "corto", "x"), ("monto_total", "1.000", "x"),
        ("tipo_vehiculo", "AUTOMOVIL", "x"), ("tipo_vehiculo", "CAMION", "x"), ("marca", "ALFA ROMEO", "x"), ("nombre_proveedor", "ab", "x"), ("nombre_proveedor", "abc", "x"),
        ("color", None, "x"), ("color", "", "x"), (None, "abc", None),
    ]
    assert scored(spark, rows) == [1.0, 0.6, 0.3, 0.3, 0.1, 0.0, 1.0, 0.0, 1.0, 0.1, 0.0, 1.0, 0.3, 1.0, 0.2, 1.0, 0.1, 0.1, 0.6, 0.0, 0.0, 0.6]


def test_strict_rules(spark):
    rows = [("placa_patente", "ABCD12", "x"), ("fecha_documento", "2024-02-03", "x"), ("color", "ROJO", "x"), ("color", "ROJIZO", "x"), ("unidad_pbv", "KG", "x"), ("marca", "TOYOTA", "x")]
    assert scored(spark, rows, "strict") == [1.0, 1.0, 1.0, 0.3, 1.0, 1.0]


def test_normal_forms(one):
    assert one(N.date_form, "3-2-2024", "2024-02-03", "29 DE ABRIL DE 2025", "03/02/2024", "5 ENE 2024", "2024", "31-02-2024", "x", None) == [
        "2024-02-03", "2024-02-03", "2025-04-29", "2024-02-03", "2024-01-05", "2024", "2024-02-31", "", ""]
    assert one(N.id_number_form, "RUT: 12.345.678-k", "1234567-8", "abc") == ["12.345.678-K", "1.234.567-8", "ABC"]
    assert one(N.unit_form, "kilos", "cv", "xyz") == ["KG", "HP", "XYZ"]
    assert one(N.number_form, "1.200", "007", "0", "-5", "x", None) == ["1200", "7", "", "", "", ""]
    assert one(N.displacement_form, "1.600", "30", "20000") == ["1600", "", ""]
    assert one(N.power_form, "120 HP", "10") == ["120", ""]
    assert one(N.gearbox_form, "Automática", "cvt x", "otra") == ["AUTOMATICA", "CVT", "OTRA"]
    assert one(N.fuel_form, "Bencina 95", "eléctrico", "gas") == ["GASOLINA", "ELECTRICO", "GAS"]
    assert one(N.vehicle_number_form, "1hgcm82633a00435 2", "x") == ["1HGCM82633A004352", ""]
    assert one(N.publish_date, "03-02-2024", "2024-02-03", None) == ["2024-02-03", "2024-02-03", None]
    assert one(N.gearbox_synonym, "m/t", "autom", "x") == ["MANUAL", "AUTOMATICA", ""]
