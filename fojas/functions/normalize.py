"""Normal forms of field values for training exports. Null and blank give ''."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fojas.functions.reading import let, literal_map
from fojas.functions.text import rx, strip

# Month names and their short forms.
MONTH_NUMBERS = {
    "ENE": "01", "FEB": "02", "MAR": "03", "ABR": "04", "MAY": "05", "JUN": "06", "JUL": "07", "AGO": "08", "SEP": "09", "OCT": "10", "NOV": "11", "DIC": "12",
    "ENERO": "01", "FEBRERO": "02", "MARZO": "03", "ABRIL": "04", "MAYO": "05", "JUNIO": "06", "JULIO": "07", "AGOSTO": "08", "SEPTIEMBRE": "09",
    "OCTUBRE": "10", "NOVIEMBRE": "11", "DICIEMBRE": "12",
}
# Units and what is written for them.
UNIT_FORMS = {
    "KG": "KG", "KGS": "KG", "KILOS": "KG", "KILO": "KG", "HP": "HP", "CV": "HP", "HORSEPOWER": "HP", "CC": "CC", "CM3": "CC", "CILINDRADA": "CC", "L": "L",
    "LITRO": "L", "LITROS": "L", "KM": "KM", "KILOMETRO": "KM", "KILOMETROS": "KM",
}


def date_form(c: Column) -> Column:
    """YYYY-MM-DD of six written forms with years 1900-2100; a bare year stays; only the ISO form is checked against the calendar (NRM1)."""

    def of(v: Column) -> Column:
        def part(pattern: str, k: int) -> Column:
            return F.regexp_extract(v, pattern, k)

        def dated(pattern: str, month: Column) -> tuple[Column, Column]:
            y = part(pattern, 3)
            ok = v.rlike(pattern) & y.try_cast("int").between(1900, 2100) & month.isNotNull()
            return ok, F.concat_ws("-", y, F.lpad(month, 2, "0"), F.lpad(part(pattern, 1), 2, "0"))

        iso = F.regexp_extract(v, r"^(\d{4}-\d{1,2}-\d{1,2})$", 1).try_cast("date")
        dash, slash = r"^(\d{1,2})-(\d{1,2})-(\d{4})$", r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
        short, long = r"^(\d{1,2})[-\s]?([A-Z]+)[-\s]?(\d{4})$", r"^(\d{1,2})\s*(?:DE\s*)?([A-Z]+?)\s*(?:DE\s*)?(\d{4})$"
        months = literal_map(MONTH_NUMBERS)
        out = F.when(F.year(iso).between(1900, 2100), F.date_format(iso, "yyyy-MM-dd"))
        for pattern, month in ((dash, part(dash, 2)), (short, F.element_at(months, part(short, 2))), (slash, part(slash, 2)), (long, F.element_at(months, part(long, 2)))):
            ok, text = dated(pattern, month)
            out = out.when(ok, text)
        return out.when(v.rlike(r"^\d{4}$") & v.try_cast("int").between(1900, 2100), v).otherwise("")

    u = F.regexp_replace(F.upper(strip(F.coalesce(c, F.lit("")))), rx(r"[^\w\s/-]"), "")
    return let(F.trim(F.regexp_replace(u, rx(r"\s+"), " ")), of)


def id_number_form(c: Column) -> Column:
    """12.345.678-K; what is no such number stays, without blanks, dots, hyphens and label (NRM2)."""
    u = F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), r"[ .:-]|RUT|R\.U\.T\.?", "")

    def of(v: Column) -> Column:
        body = F.regexp_extract(v, r"^(\d{7,8})([0-9K])$", 1).try_cast("long")
        return F.when(body.isNotNull(), F.concat(F.translate(F.format_number(body, 0), ",", "."), F.lit("-"), F.regexp_extract(v, r"^(\d{7,8})([0-9K])$", 2))).otherwise(v)

    return let(u, of)


def unit_form(c: Column) -> Column:
    u = F.upper(F.coalesce(c, F.lit("")))
    return F.coalesce(F.element_at(literal_map(UNIT_FORMS), u), u)


def simple_text(c: Column) -> Column:
    """Trimmed, upper case, single blanks, no accents, only word signs, blanks, hyphens and dots (NRM4)."""
    u = F.regexp_replace(F.upper(strip(F.coalesce(c, F.lit("")))), rx(r"\s+"), " ")
    return F.regexp_replace(F.translate(u, "ÁÉÍÓÚÑ", "AEIOUN"), rx(r"[^\w\s\-.]"), "")


def bare_number(c: Column) -> Column:
    return F.trim(F.translate(F.coalesce(c, F.lit("")), ".,", ""))


def number_form(c: Column) -> Column:
    """Positive whole number without separators and leading zeros, else ''."""
    return let(bare_number(c).try_cast("decimal(38,0)"), lambda n: F.when((n > 0) & bare_number(c).rlike(r"^\d+$"), n.cast("string")).otherwise(""))


def displacement_form(c: Column) -> Column:
    b = bare_number(c)
    return F.when(b.rlike(r"^\d{1,9}$") & b.try_cast("long").between(51, 19999), b).otherwise("")


def power_form(c: Column) -> Column:
    n = F.regexp_extract(F.coalesce(c, F.lit("")), r"(\d+)", 1).try_cast("long")
    return F.when(n.between(21, 1999), n.cast("string")).otherwise("")


def gearbox_form(c: Column) -> Column:
    u = F.translate(F.upper(F.coalesce(c, F.lit(""))), "ÁÉÍÓÚ", "AEIOU")
    return F.when(F.contains(u, F.lit("MANUAL")), "MANUAL").when(u.rlike("AUTOMATIC[AO]"), "AUTOMATICA").when(F.contains(u, F.lit("CVT")), "CVT").otherwise(simple_text(c))


def fuel_form(c: Column) -> Column:
    u = F.translate(F.upper(F.coalesce(c, F.lit(""))), "ÁÉÍÓÚ", "AEIOU")
    return (
        F.when(F.contains(u, F.lit("DIESEL")), "DIESEL").when(u.rlike("GASOLINA|BENCINA"), "GASOLINA").when(F.contains(u, F.lit("ELECTRICO")), "ELECTRICO")
        .when(F.contains(u, F.lit("HIBRIDO")), "HIBRIDO").otherwise(simple_text(c))
    )


def vehicle_number_form(c: Column) -> Column:
    u = F.translate(F.upper(strip(F.coalesce(c, F.lit("")))), " ", "")
    return F.when(u.rlike("^[A-Z0-9]{17}$"), u).otherwise("")


def gearbox_synonym(c: Column) -> Column:
    """MANUAL or AUTOMATICA for their synonyms, else '' (STR6)."""
    # Words for the two gearboxes.
    table = {"MANUAL": "MANUAL", "AUTOMATICA": "AUTOMATICA", "MECANICA": "MANUAL", "MECANIKO": "MANUAL", "MECANICO": "MANUAL", "MAN": "MANUAL", "M/T": "MANUAL", "AUTOM": "AUTOMATICA", "AUTOMATICO": "AUTOMATICA", "AUTOMATIKO": "AUTOMATICA", "A/T": "AUTOMATICA"}
    return F.coalesce(F.element_at(literal_map(table), F.upper(c)), F.lit(""))


def normalize_field(campo: Column, valor: Column) -> Column:
    """The normal form of a field's value; fields without rule are trimmed (NRM8)."""
    return (
        F.when(campo.isin("rut_proveedor", "rut_comprador"), id_number_form(valor)).when(campo == "fecha_documento", date_form(valor))
        .when(campo.isin("unidad_pbv", "unidad_carga", "unidad_potencia"), unit_form(valor))
        .when(campo.isin("pbv", "carga", "asientos", "puertas", "anio"), number_form(valor)).when(campo == "cilindrada", displacement_form(valor))
        .when(campo == "potencia_motor", power_form(valor)).when(campo == "transmision", gearbox_form(valor)).when(campo == "combustible", fuel_form(valor))
        .when(campo == "vin", vehicle_number_form(valor))
        .when(campo.isin("marca", "modelo", "color", "tipo_vehiculo", "tipo_carroceria", "nombre_proveedor", "nombre_comprador", "traccion", "n_motor", "n_chasis", "serie", "cit", "ejes"), simple_text(valor))
        .otherwise(strip(F.coalesce(valor, F.lit(""))))
    )


def publish_date(c: Column) -> Column:
    """DD-MM-YYYY turned to YYYY-MM-DD if it has three parts and ends in a year; anything else stays (NRM9)."""
    return F.regexp_replace(c, r"^([^-]*)-([^-]*)-([^-]{4})$", "$3-$2-$1")
