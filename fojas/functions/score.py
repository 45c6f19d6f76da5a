"""Score of a value by the rules of its field. Rules 'effective' are those in force, 'strict' the stricter checks that they replaced."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fojas.functions.fixed import COMMON_MAKES, VALID_COLOURS, VALID_DOCUMENT_TYPES, VALID_UNITS, YEAR_SIGNS
from fojas.functions.reading import let
from fojas.functions.text import strip

DIGITS = ["tipo_doc", "numero_documento", "asientos", "puertas", "potencia_motor", "ejes", "cilindrada", "cit", "serie", "pbv", "n_motor"]
LETTERS = {"marca": 2, "transmision": 2, "combustible": 2, "tipo_carroceria": 2, "traccion": 2, "color": 3, "placa_patente": 3, "unidad_pbv": 1}
AMOUNTS = ["monto_total", "monto_neto", "monto_iva"]


def check_digit(body: Column) -> Column:
    """Modulo-11 check digit of a string of digits: weights 2 to 7 from the right, 10 is K, 11 is 0; null for other strings."""
    digits = F.filter(F.split(F.reverse(body), ""), lambda d: d != "")
    total = F.aggregate(F.transform(digits, lambda d, i: d.try_cast("int") * (F.pmod(i, F.lit(6)) + 2)), F.lit(0), lambda a, x: a + x)
    digit = let(11 - total % 11, lambda r: F.when(r == 10, "K").when(r == 11, "0").otherwise(r.cast("string")))
    return F.when(body.rlike(r"^\d+$"), digit)


def id_number_valid(c: Column) -> Column:
    """Whether a number with check digit, with or without dots, holds."""
    u = F.upper(F.regexp_replace(c, r"[.\s]", ""))
    return F.coalesce(check_digit(F.regexp_extract(u, r"^(\d+)-([0-9K])$", 1)) == F.regexp_extract(u, r"^(\d+)-([0-9K])$", 2), F.lit(False))


def score_id_number(v: Column) -> Column:
    """0.1, +0.2 with seven digits, +0.3 for the form, +0.4 for the check digit, at most 1.0."""
    bare = F.upper(F.regexp_replace(v, r"\.", ""))
    form = bare.rlike(r"^\d{7,8}-[0-9K]$")
    s = F.lit(0.1) + F.when(F.length(F.regexp_replace(bare, r"\D", "")) >= 7, 0.2).otherwise(0.0) + F.when(form, 0.3).otherwise(0.0) + F.when(form & id_number_valid(bare), 0.4).otherwise(0.0)
    return F.round(F.least(s, F.lit(1.0)), 2)


def one_or(good: Column, other: float = 0.1) -> Column:
    return F.when(good, 1.0).otherwise(other)


def all_digits(v: Column, least: int = 1) -> Column:
    return v.rlike(rf"^\p{{Nd}}{{{least},}}$")


def all_letters(v: Column, least: int = 1) -> Column:
    return v.rlike(rf"^\p{{L}}{{{least},}}$")


def score_year(v: Column, year: int) -> Column:
    n = v.try_cast("int")
    return F.when(n.isNull(), 0.0).otherwise(one_or(n.between(1900, year + 1)))


def score_date(v: Column, year: int) -> Column:
    """dd/mm/yyyy only; a date that the calendar hasn't scores nothing."""
    part = lambda k: F.regexp_extract(v, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", k)
    date = F.concat_ws("-", part(3), part(2), part(1)).try_cast("date")
    return F.when(date.isNull(), 0.0).otherwise(one_or(F.year(date).between(1900, year)))


def score_vehicle_number(v: Column) -> Column:
    return F.when(F.length(v) != 17, 0.3).otherwise(one_or(F.instr(F.lit(YEAR_SIGNS), F.upper(F.substring(v, 10, 1))) > 0))


def score_vehicle_type(v: Column) -> Column:
    u = F.upper(v)
    return F.when(u.rlike("AUTO|VEHICULO"), 0.2).otherwise(one_or(all_letters(u, 3)))


def score_value(campo: Column, valor: Column, year: int, rules: str = "effective") -> Column:
    """Score of a field's value; null and empty score 0.0. year is the current year, a parameter so that results repeat."""

    def of(v: Column) -> Column:
        s = (
            F.when(campo.isin("rut_proveedor", "rut_comprador"), score_id_number(v))
            .when(campo == "anio", score_year(v, year)).when(campo == "fecha_documento", score_date(v, year))
            .when(campo.isin("vin", "n_chasis"), score_vehicle_number(v)).when(campo.isin(AMOUNTS), one_or(all_digits(F.regexp_replace(v, r"\.", ""))))
            .when(campo == "tipo_vehiculo", score_vehicle_type(v)).when(campo == "carga", one_or(all_digits(v, 2))).when(campo.isin(DIGITS), one_or(all_digits(v)))
        )
        for field, least in LETTERS.items():
            s = s.when(campo == field, one_or(all_letters(v, least)))
        return s.otherwise(F.when(F.length(strip(v)) >= 3, 0.6).otherwise(0.1))

    def strict(v: Column) -> Column:
        u = F.upper(v)
        iso = F.coalesce(F.concat_ws("-", *[F.regexp_extract(v, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", k) for k in (3, 2, 1)]).try_cast("date"), F.regexp_extract(v, r"^(\d{4}-\d{1,2}-\d{1,2})$", 1).try_cast("date"))
        number = v.try_cast("int")
        return (
            F.when(campo == "anio", F.when(~all_digits(v), 0.0).otherwise(one_or(number.between(1900, year + 1))))
            .when(campo == "fecha_documento", F.when(iso.isNull(), 0.0).otherwise(one_or(F.year(iso).between(2000, year), 0.3)))
            .when(campo == "placa_patente", one_or(u.rlike(r"^[A-Z]{2,4}\d{2,4}$"), 0.3)).when(campo == "marca", one_or(u.isin(COMMON_MAKES)))
            .when(campo == "vin", F.when((F.length(v) == 17) & ~u.rlike("[IOQ]"), one_or(F.instr(F.lit(YEAR_SIGNS), F.substring(u, 10, 1)) > 0, 0.5)).otherwise(0.3))
            .when(campo == "color", one_or(u.isin(VALID_COLOURS), 0.3)).when(campo == "tipo_doc", one_or(u.isin(VALID_DOCUMENT_TYPES)))
            .when(campo.isin("unidad_pbv", "unidad_carga", "unidad_potencia"), one_or(u.isin(VALID_UNITS), 0.3)).otherwise(of(v))
        )

    body = strict if rules == "strict" else of
    return F.when(F.coalesce(valor, F.lit("")) == "", 0.0).otherwise(let(strip(valor), body))


def score_reading(campo: Column, valor: Column, metodo: Column, year: int, rules: str = "effective") -> Column:
    """Score with the bonus of 0.20 for document types read by paddleocr, at most 1.0."""
    s = score_value(campo, valor, year, rules)
    return F.round(F.when((campo == "tipo_doc") & (metodo == "paddleocr"), F.least(s + 0.2, F.lit(1.0))).otherwise(s), 2)
