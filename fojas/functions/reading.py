"""Column expressions that undo the ways in which recognised values are written or misread."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ACCENTED, PLAIN = "ÁÀÄÂÃÉÈËÊÍÌÏÎÓÒÖÔÕÚÙÜÛÑÇáàäâãéèëêíìïîóòöôõúùüûñç", "AAAAAEEEEIIIIOOOOOUUUUNCaaaaaeeeeiiiiooooouuuunc"

# Characters that recognition confuses, letter side and digit side.
LETTERS_READ_AS_DIGITS, THEIR_DIGITS = "OQDILSBZG|", "0001158261"
DIGITS_READ_AS_LETTERS, THEIR_LETTERS = "0134568", "OIEASGB"

# Spanish number words up to twenty and the tens.
NUMBER_WORDS = {
    "CERO": 0, "UN": 1, "UNO": 1, "UNA": 1, "DOS": 2, "TRES": 3, "CUATRO": 4, "CINCO": 5, "SEIS": 6, "SIETE": 7, "OCHO": 8,
    "NUEVE": 9, "DIEZ": 10, "ONCE": 11, "DOCE": 12, "TRECE": 13, "CATORCE": 14, "QUINCE": 15, "DIECISEIS": 16,
    "DIECISIETE": 17, "DIECIOCHO": 18, "DIECINUEVE": 19, "VEINTE": 20, "TREINTA": 30, "CUARENTA": 40, "CINCUENTA": 50,
    "SESENTA": 60,
}

# Month names by their first three letters.
MONTHS = {
    "ENE": 1, "FEB": 2, "MAR": 3, "ABR": 4, "MAY": 5, "JUN": 6, "JUL": 7, "AGO": 8, "SEP": 9, "SET": 9, "OCT": 10,
    "NOV": 11, "DIC": 12,
}


def let(value: Column, body) -> Column:
    """body(value) with value computed once: repeating a long expression would outgrow one compiled method."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def strip_space(c: Column) -> Column:
    """Trim all white space, not blanks only."""
    return F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")


def fold_accents(c: Column) -> Column:
    return F.translate(c, ACCENTED, PLAIN)


def plain_upper(c: Column) -> Column:
    return fold_accents(F.upper(strip_space(c)))


def blank_to_null(c: Column) -> Column:
    t = strip_space(c)
    return F.when(t != "", t)


def canonical_field(c: Column) -> Column:
    """A field's name however it is written: 'fechaDocumento', 'MONTO-NETO', 'Monto Neto', 'año' -> listed form."""
    snake = F.regexp_replace(strip_space(c), r"(\p{Ll})(\p{Lu})", "$1_$2")
    snake = F.regexp_replace(F.lower(snake), r"[\s\-_.]+", "_")
    return F.when(snake.isin("año", "ano", "anio"), F.lit("anio")).otherwise(fold_accents(snake))


def to_digits(c: Column) -> Column:
    return F.translate(c, LETTERS_READ_AS_DIGITS, THEIR_DIGITS)


def read_integer(c: Column) -> Column:
    """Whole number of a reading as decimal(20,0), or null.

    Labels, currency and unit words fall away, separators of thousands too; decimals of one or two places are dropped;
    letters that stand for digits are read as such if at least one true digit is there; number words are read.
    Null, blank and placeholders give null.
    """
    u = plain_upper(c)
    u = F.regexp_replace(u, r"^(?:ANIO|ANO|CLP|MONTO|NETO|IVA|TOTAL|ASIENTOS|PUERTAS|CILINDRADA)?[:\s]*\$?\s*", "")
    u = F.regexp_replace(u, r"\s*(?:CC|C\.C\.|CM3|CMS|ASIENTOS?|PUERTAS?|PESOS)?[.\s]*$", "")
    u = F.regexp_replace(u, r"[.,]?-$", "")

    def of(u: Column) -> Column:
        shaped = u.rlike(r"^(?=.*[0-9])[0-9OQDILSBZG|][0-9OQDILSBZG|., ]*$")
        number = F.regexp_replace(to_digits(F.regexp_replace(u, r"[.,][0-9OQDILSBZG|]{1,2}$", "")), "[^0-9]", "")
        return F.when(shaped, number.try_cast("decimal(20,0)")).otherwise(F.element_at(literal_map(NUMBER_WORDS), u).cast("decimal(20,0)"))

    return let(u, of)


def read_date(c: Column) -> Column:
    """Date of a reading (day before month, or year first), or null; two-digit years belong to 2000-2099."""
    g = r"[0-9OQDILSBZG|]"
    ymd = rf"^({g}{{4}})[-/. ]({g}{{1,2}})[-/. ]({g}{{1,2}})$"
    dmy = rf"^({g}{{1,2}})[-/. ]+(?:DE[L]? )?({g}{{1,2}}|[A-Z0-9]{{3,10}})[-/. ]+(?:DE[L]? )?({g}{{4}}|{g}{{2}})$"

    def made(y: Column, m: Column, d: Column) -> Column:
        return F.concat_ws("-", F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y), m, d).try_cast("date")

    def of(u: Column) -> Column:
        middle = F.regexp_extract(u, dmy, 2)
        name = F.element_at(literal_map({k: str(v) for k, v in MONTHS.items()}), F.substring(F.translate(middle, DIGITS_READ_AS_LETTERS, THEIR_LETTERS), 1, 3))
        month = F.when(F.length(middle) <= 2, to_digits(middle)).otherwise(name)
        first = made(to_digits(F.regexp_extract(u, ymd, 1)), to_digits(F.regexp_extract(u, ymd, 2)), to_digits(F.regexp_extract(u, ymd, 3)))
        last = made(to_digits(F.regexp_extract(u, dmy, 3)), month, to_digits(F.regexp_extract(u, dmy, 1)))
        return F.when(u.rlike(r"^\D*$"), None).when(u.rlike(ymd), first).when(u.rlike(dmy) & month.isNotNull(), last)

    return let(F.regexp_replace(plain_upper(c), r"^(?:FECHA)?[:\s]*", ""), of)
