"""All fields of recognised texts at once, as wide rows or as attribute-value rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fojas.functions import extract as X
from fojas.functions.fixed import BODY_KINDS, COMMON_COLOURS, COMMON_MAKES
from fojas.functions.fuzzy import fuzzy_fields
from fojas.functions.reading import let
from fojas.functions.text import clean_value, first_filled, footer, header_and_body, longest_first, normalize_text
from fojas.operators.eav import wide_to_eav
from fojas.schema import FIELDS
from fojas.session import spread


@dataclass
class Dictionaries:
    """Lists of terms the extractors look up; all are inputs. Without cities the communes are looked for."""

    communes: list[str] = field(default_factory=list)
    cities: list[str] = field(default_factory=list)
    makes: list[str] = field(default_factory=lambda: list(COMMON_MAKES))
    colours: list[str] = field(default_factory=lambda: list(COMMON_COLOURS))
    bodies: list[str] = field(default_factory=lambda: list(BODY_KINDS))
    prefixes: list[tuple[str, str]] | None = None


#: Registry: field -> (segment it is read from, builder(text, dictionaries), whether its value is cleaned). Add or replace entries to extend.
EXTRACTORS: dict[str, tuple[str, object, bool]] = {
    "numero_documento": ("cabecera", lambda t, d: X.document_number(t), True), "localidad": ("cabecera", lambda t, d: X.locality(t, d.communes), False),
    "fecha_documento": ("cabecera", lambda t, d: X.document_date(t), False), "rut_proveedor": ("cabecera", lambda t, d: X.supplier_id(t), False),
    "nombre_proveedor": ("cabecera", lambda t, d: X.supplier_name(t), True), "rut_comprador": ("cabecera", lambda t, d: X.buyer_id(t), False),
    "nombre_comprador": ("cabecera", lambda t, d: X.buyer_name(t), True), "direccion_comprador": ("cabecera", lambda t, d: X.buyer_address(t, d.communes), True),
    "telefono_comprador": ("cabecera", lambda t, d: X.buyer_phone(t), False), "comuna_comprador": ("cabecera", lambda t, d: X.buyer_commune(t, d.communes), False),
    "ciudad_comprador": ("cabecera", lambda t, d: X.buyer_city(t, d.cities or d.communes), False), "placa_patente": ("cuerpo", lambda t, d: X.plate(t), False),
    "tipo_vehiculo": ("cuerpo", lambda t, d: X.vehicle_type(t), False), "modelo": ("cuerpo", lambda t, d: X.model(t), False), "n_motor": ("cuerpo", lambda t, d: X.engine_number(t), False),
    "n_chasis": ("cuerpo", lambda t, d: X.chassis_number(t), False), "vin": ("cuerpo", lambda t, d: X.vehicle_number(t), False), "serie": ("cuerpo", lambda t, d: X.series(t), False),
    "color": ("cuerpo", lambda t, d: X.colour(t, d.colours), False), "anio": ("cuerpo", lambda t, d: X.year(t), True), "unidad_pbv": ("cuerpo", lambda t, d: X.weight_unit(t), False),
    "pbv": ("cuerpo", lambda t, d: X.gross_weight(t), False), "combustible": ("cuerpo", lambda t, d: X.fuel(t), True), "unidad_carga": ("cuerpo", lambda t, d: X.load_unit(t), False),
    "carga": ("cuerpo", lambda t, d: X.load(t), True), "asientos": ("cuerpo", lambda t, d: X.seats(t), True), "puertas": ("cuerpo", lambda t, d: X.doors(t), True),
    "unidad_potencia": ("cuerpo", lambda t, d: X.power_unit(t), False), "potencia_motor": ("cuerpo", lambda t, d: X.power(t), False), "traccion": ("cuerpo", lambda t, d: X.drive(t), False),
    "cilindrada": ("cuerpo", lambda t, d: X.displacement(t), False), "monto_neto": ("montos", lambda t, d: X.amount_text(t["neto"]), True),
    "monto_iva": ("montos", lambda t, d: X.amount_text(t["iva"]), True), "monto_total": ("montos", lambda t, d: X.amount_text(t["total"]), True),
    "num_contrato": ("texto", lambda t, d: X.contract_number(t), True),
}
#: Fields completed by the similarity pass.
FUZZY = ["tipo_doc", "marca", "ejes", "tipo_carroceria", "transmision", "cit"]


def extract_wide(texts: DataFrame, dictionaries: Dictionaries | None = None, column: str = "texto_extraccion", fields: list[str] | None = None) -> DataFrame:
    """texts plus a column per field, '' where nothing was found (STR9). One narrow stage with one Arrow round trip; null text counts as empty.

    Header, body and totals are parted once; party fields read the header, vehicle fields the body, amounts the totals.
    """
    d = dictionaries or Dictionaries()
    fields = fields or FIELDS
    parts = header_and_body(F.col(column))
    framed = spread(texts).withColumn("_p", parts).withColumns({"_cabecera": F.col("_p.cabecera"), "_cuerpo": F.col("_p.cuerpo"), "_pie": footer(F.col(column)), "_texto": F.coalesce(F.col(column), F.lit(""))})
    if any(EXTRACTORS[f][0] == "montos" for f in fields if f in EXTRACTORS):
        # the total needs net and tax, so the three are read together
        framed = framed.withColumn("_montos", X.amounts(F.col("_pie")))

    def value(name: str) -> Column:
        segment, build, cleaned = EXTRACTORS[name]
        v = build(F.col(f"_{segment}"), d)
        return clean_value(v) if cleaned else v

    native = [f for f in fields if f in EXTRACTORS]
    out = framed.withColumns({f: value(f) for f in native})
    if any(f in FUZZY for f in fields):
        kinds, makes = longest_first(d.bodies), longest_first(d.makes)
        body = F.col("_cuerpo")
        words = F.array_join(F.regexp_extract_all(F.upper(body), F.lit(r"[A-ZÁÉÍÓÚÑ]{4,}"), F.lit(0)), " ")
        out = out.withColumn("_f", fuzzy_fields(normalize_text(F.substring("_texto", 1, 415)), X.make_candidates(body), X.axle_candidates(body), words, makes, kinds))
        out = out.withColumn("_marca", X.make(body, d.makes, F.col("_f.marca")))
        late = {
            "tipo_doc": F.col("_f.tipo_doc"), "marca": F.col("_marca"), "ejes": F.col("_f.ejes"), "cit": let(F.col("_marca"), lambda m: X.report_code(body, m, d.prefixes)),
            "tipo_carroceria": first_filled(F.array(X.bodywork(body, d.bodies), F.col("_f.tipo_carroceria"))), "transmision": first_filled(F.array(X.gearbox(body), F.col("_f.transmision"))),
        }
        out = out.withColumns({k: v for k, v in late.items() if k in fields})
    return out.select(*texts.columns, *[f for f in FIELDS if f in fields])


def extract_rows(texts: DataFrame, dictionaries: Dictionaries | None = None, fields: list[str] | None = None) -> DataFrame:
    """(documento_id, metodo, archivo_origen, campo, valor, score): a row per filled field, unscored (SNK3, PRJ1)."""
    wide = extract_wide(texts, dictionaries, fields=fields).withColumn("archivo_origen", F.format_string("BD_doc_%d_metodo_%s", "documento_id", "metodo"))
    return wide_to_eav(wide, ["documento_id", "metodo", "archivo_origen"], fields or FIELDS).withColumn("score", F.lit(None).cast("double"))
