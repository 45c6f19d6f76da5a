"""Names and types of the data model."""

from __future__ import annotations

# Field names in display and publish order.
FIELDS = [
    "tipo_doc", "numero_documento", "localidad", "fecha_documento", "rut_proveedor", "nombre_proveedor", "rut_comprador",
    "nombre_comprador", "direccion_comprador", "telefono_comprador", "comuna_comprador", "ciudad_comprador", "placa_patente",
    "tipo_vehiculo", "marca", "modelo", "n_motor", "n_chasis", "vin", "serie", "color", "anio", "unidad_pbv", "pbv", "cit",
    "combustible", "unidad_carga", "carga", "asientos", "puertas", "unidad_potencia", "potencia_motor", "ejes", "traccion",
    "tipo_carroceria", "cilindrada", "transmision", "monto_neto", "monto_iva", "monto_total", "num_contrato",
]

# Fields asked for in training pairs, in the order of the answer.
TARGET_FIELDS = [
    "numero_documento", "fecha_documento", "rut_proveedor", "rut_comprador", "nombre_proveedor", "nombre_comprador", "tipo_vehiculo", "marca",
    "modelo", "color", "anio", "n_motor", "n_chasis", "vin", "serie", "pbv", "unidad_pbv", "carga", "unidad_carga", "asientos", "puertas",
    "potencia_motor", "unidad_potencia", "traccion", "cilindrada", "transmision", "tipo_carroceria", "combustible", "cit", "ejes",
]

# Recognition methods.
METHODS = ["paddleocr", "easyocr", "tesseract4", "tesseract6", "doctr", "nativo"]

# Document states.
STATES = {"registered": 1, "text": 2, "fields": 3, "scored": 4, "consolidated": 5, "published": 6, "error": 500}

#: Kind of each field that isn't free text; the rest are strings.
FIELD_KINDS = {
    "anio": "int", "asientos": "int", "puertas": "int", "cilindrada": "int", "fecha_documento": "date",
    "monto_neto": "int", "monto_iva": "int", "monto_total": "int", "pbv": "double", "potencia_motor": "double", "carga": "double",
}
