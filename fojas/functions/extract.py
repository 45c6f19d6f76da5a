"""One field of a recognised sheet from its text, as column expressions: '' on a miss.

The patterns are fixed values. Dictionaries are lists of terms given by the caller. Each extractor works inside one
bound variable, so that Catalyst need not generate code for every pattern of every field in one method.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from fojas.functions.fixed import AXLES, REPORT_CODE_PREFIXES, VEHICLE_TYPES
from fojas.functions.normalize import gearbox_synonym
from fojas.functions.reading import ACCENTED, PLAIN, let
from fojas.functions.text import (
    clean_value,
    first_contained,
    first_filled,
    footer,
    found,
    full_lines,
    header_and_body,
    lines_of,
    literal_rows,
    longest_first,
    number_words,
    rx,
    strip,
    terms_array,
    text_of,
)

# Patterns of numbers and labels.
DOC_NUMBER = r"(?<!\w)(?:N[º°9*]?\s*[:\-]?\s*|N\s*[Oo]\s*[:\-]?\s*|FOLIO\s*[:\-]?\s*|NO\s*[:\-]?\s*)(\d{5,})(?!\w)"
BUYER_ANCHOR = r"(?<!\w)(?:N[º°9]?\s*[:\-]?\s*|N\s*[Oo]\s*[:\-]?\s*|FOLIO\s*[:\-]?\s*|NO\s*[:\-]?\s*)(\d{5,})(?!\w)"
ID_NUMBER = r"(?<!\d)(?:\d{1,3}(?:\.\d{3}){1,2}|\d{7,8})-[\dkK](?!\d)"
TAX_OFFICE = [
    r"\bS[\.\s\-]*I[\.\s\-]*I[\.\s\-]*",
    r"\bS[\.\s\-]*1[\.\s\-]*1[\.\s\-]*",
    r"\b5[\.\s\-]*I[\.\s\-]*I[\.\s\-]*",
    r"\bS[\.\s\-]*L[\.\s\-]*L[\.\s\-]*",
    r"\bS[\.\s\-]*I[\.\s\-]*1[\.\s\-]*",
    r"\bS[\.\s\-]*1[\.\s\-]*I[\.\s\-]*",
    r"\bS[\.\s\-]*L[\.\s\-]*I[\.\s\-]*",
    r"\bS[\.\s\-]*I[\.\s\-]*1[\.\s\-]*",
]
MONTHS_LONG = "(?:ENERO|FEBRERO|MARZO|ABRIL|MAYO|JUNIO|JULIO|AGOSTO|SEPTIEMBRE|OCTUBRE|NOVIEMBRE|DICIEMBRE)"
MONTHS_SHORT = "(?:ENE|FEB|MAR|ABR|MAY|JUN|JUL|AGO|SEP|OCT|NOV|DIC)"
DATES = [
    r"(\d{1,2}[\/\-\.\s]\d{1,2}[\/\-\.\s]\d{4})", rf"(\d{{1,2}}\s+DE\s+{MONTHS_LONG}\s+DE(?:L)?\s+\d{{4}})", rf"(\d{{1,2}}[-]\s*{MONTHS_LONG}\s*[-]\s*\d{{2,4}})",
    rf"(\d{{1,2}}\s+{MONTHS_LONG}\s+\d{{4}})", rf"(\d{{1,2}}[-]\s*{MONTHS_SHORT}\s*[-]\s*\d{{2,4}})", rf"(\d{{1,2}}\s+{MONTHS_SHORT}\s+\d{{2,4}})",
]
DATE_LABEL = r"FECHA\s*EMISIÓN?\.?|EMITIDO|SANTIAGO,|SANTLAGO,|FECHA\b|FECHA\s*EMISI[ÓO]N"
DUE_DATE = "FECHA VENC|VENCIMIENTO|FECHA VCTO|VCTO"
LEGAL_FORMS = ["SA", "SPA", "LTDA", "EIRL", "SOCIEDAD", "LIMITADA", "EMPRESA", "INVERSIONES", "BANCO"]
NOT_A_SUPPLIER = ["SANTIAGO", "ESPAÑA"]
BUYER_LABELS = [r"\bNOMBRE\b", r"\bSE[ÑN]OR(?:\(ES\))?\b\s*[:\-–]?", r"\bCLIENTE\b", r"\bRAZ[ÓO]N\b", r"\bSR\.?\b"]
NOT_A_BUYER = r"VENDEDOR|VENDEDORA|DIRECCION|RUT|FIRMA|REPRESENTANTE|SUCURSAL|GIRO|TELEFONO|CONTACTO|CODIGO|ORDEN DE COMPRA|COMUNA|CIUDAD|NOTAI DE VENTA|NOTA DE VENTA|CONDICIONES|R\.U\.T"
ADDRESS_LABELS = [r"DIRECCI[ÓO]N", r"\bDIR\b", r"\bDIR\.", r"\bAV(?:ENIDA)?\b"]
PHONE = r"(?:\+?56)?[\s\-\.]?(?:\(?\d{1,3}\)?[\s\-\.]?)?\d{3}[\s\-\.]?\d{4}"
PLATE = r"(?:P(?:\.?P\.?U\.?)|PATENTE|PLACA)[\s:]*([A-Z]{2,4}\.?\d{2,4}(?:-\d{1,2})?)"
PLATE_FORMS = r"^(?:[A-Z]{2}\d{4}|[A-Z]{4}\d{2}|[A-Z]{3}\d{2}|[A-Z]{3}0\d{2})$"
MAKE_LABEL = r"M[\s\-:.]*A[\s\-:.]*R[\s\-:.]*C[\s\-:.]*A[\s\-:.]*[:\-.\s]*([A-Z0-9 ]{2,40}?)(?=\s*(?:MODELO|COLOR|AÑO|FABRICACIÓN|PBV|$))"
MODEL_ENDS = ["CILINDRADA", "COLOR", "PESO", "TRACCION", "MOTOR", "NRO.", "CODIGO", "CIT", "VIN", "CARROCERIA", "COMBUSTIBLE", "AFECTO", "AÑO", "ANO", "FABRICACION", "PBV"]
ENGINE_LABEL = "MOTOR|NRO MOTOR|NO MOTOR|MOTCR|MOT0R"
ENGINE_ENDS = ["COLOR", "CHASIS", "PESO", "TRANSMISION", "TRACCION", "CILINDRADA", "PATENTE", "TIPO VEHICULO", "ANO", "MODELO", "LLAVES", "PUERTAS", "ASIENTOS", "CODIGO", "CIT", "PBV", "N/A"]
CHASSIS = r"(?:CHASIS|CHASSIS|CHASI|CHASSI|N CHASSIS|NO\. CHASIS|N° CHASIS|NUMERO CH|NRO\. CHASIS)[\s:\-]*([A-Z0-9\- ]{7,30}?)(?:\s+(?:CILINDRADA|COLOR|PESO|TRACCION|MOTOR|CODIGO|CIT|VIN|CARROCERIA|COMBUSTIBLE|AFECTO|AÑO)|\b)"
NOT_A_CHASSIS = "SANTIAGO|CARGA|DIESEL|GASOLINA|COLOR|CHILE|MOTOR|SERIE|VALOR|PLATAFORMA"
VEHICLE_NUMBER = r"(?:V\.?\s*I\.?\s*N\.?)\s*[:\-]?\s*([A-Z0-9]{12,17})"
SERIES = r"(?:SERIE[\s:\-]*)([A-Z0-9\-]{8,20})"
COLOUR = r"(?:COLOR|COIOR|COLOR EXTERIOR)[\s:\-]*([A-ZÁÉÍÓÚÑ\s\/\.\,\-]+)"
YEAR = r"(?:A[ÑN\?]O COMERCIAL|A[ÑN\?]O)[\s:\-]*([1-2][0-9]{3})"
WEIGHT_LABEL_FOR_UNIT = r"PBV|P\.B\.V\.|PESO BRUTO|PESO BRUTO VEHICULAR|PESO VEHICULAR"
WEIGHT_UNIT = r"\b(KG|TON|KGS|KILOS)\b"
WEIGHT_LABEL = r"P(?:\.?\s*)?B(?:\.?\s*)?V(?:\s*\(KGS\.?\))?|PESO\s+BRUTO\s+VEHICULAR(?:\s*\(KGS\.?\))?|PESO\s+BRUTO(?:\s*\(KGS\.?\))?|PESO\s+VEHICULAR"
REPORT_LABEL = r"C\.?\s*I\.?\s*T\.?|\bCIT\b|\bSIT\b|\bGIT\b|\bINFORME[\s\W]*TECNICO\b|\bHOMOLOGACION\b|\bCODIGO\s+INFORME\s+TECNICO\b|CODIGO\s+HOMOLOGACION\b"
FUELS = r"DUAL\s*\(\s*ELECTRICO\s*,\s*GASOLINA\s*\)|DUAL\s*\(\s*ELECTRICO\s*,\s*DIESEL\s*\)|GASOLINA|DIESEL|ELECTRICO|HIBRIDO|GAS LICUADO|GLP|ELECTRICA|PETROLEO|PETROLERO|BENCINA"
FUEL_WORDS = ["GASOLINA", "DIESEL", "ELECTRICO", "HIBRIDO", "GAS LICUADO", "GLP", "ELECTRICA", "PETROLEO", "PETROLERO", "BENCINA"]
LOAD = r"(?:CARGA[\s\-]*UTIL(?:[\s\-]*ADMISIBLE)?|CARGA[\s\-]*UTIL[\s\-]*VEHICULAR|CARGAUTILADMISIBLE|CARGAUTILVEHICULAR|C/CARGA|CAPACIDAD[\s\-]*DE[\s\-]*CARGA)[\s:\-]*([\d\.,]+)"
POWER = [r"POTENCIA(?:\s+MOTOR)?[\s:\-.\t]*([\d]{2,4})\s*(?:HP|CV)?", r"POT\.?\s*MÁXIMA[\s:\-.\t]*([\d]{2,4})\s*(?:HP|CV)?", r"([\d]{2,4})\s*(?:HP|CV)\b"]
AXLE = r"(?:(?:DISP(?:OSICION)?(?:\s+DE)?\s+EJES)|EJES)[\s:\-]*[({\[]?\s*([A-Z0-9]+)(?:\s*\W+\s*([A-Z0-9]+))?\s*[)}\]]?"
DRIVE = r"TRACCI[ÓO06CLN]{1,2}[\s:\-]*((?:10X4|4X(?:2|4)|6X(?:2|4|6)|8X(?:2|4|6|8)))"
BODYWORK = r"(?:TIPO\s+CARROCERIA|CARROCERIA)[\s:\-]*([A-Z\s\(\)]{4,50})"
GEARBOX_LABELS = [r"TRANSMISI[ÓOÕÒ´`']N", "TRANSMICION", "TRANSMISON", "TRANSMICIÓN", "TRANSMSION"]
GEARBOX = "(MANUAL|AUTOMATICA|MECANICA|MECANIKO|AUTOMATIKO|MAN|AUTOM|M/T|A/T)"
NET_FIRST = r"TOTAL[\s\-\.]*NETO|MONTO[\s\-\.]*NETO|\bNETO\b|\b0NETO\b|\bONETO\b"
NET_SECOND = r"SUB[\s\-\.]?TOTAL|\bAFECTO\b|\bALECTO\b"
TAX_LABELS = [
    r"MONTO\s+[\.]?V\.?A\.?\s*%?", r"MONTO\s+I\.?V\.?A\.?\s*%?", r"MONTO\s+L\.?V\.?A\.?\s*%?", r"I\.?V\.?A\.?\s*%?", r"IVA\s*[:\-]?\s*19(?:[.,]0{1,2})?\s*%?",
    r"IVA\s*:?[\s\-]?", r"19\s*%\s*IVA", r"19\s*%\s*I\.?V\.?A\.?\s*\$?", r"19%1\.V\.A\.", r"\b19%1\.V\.A\.\b", r"\bTVA\s*19\s*%", r"\bVA19%", r"\b19%VA\b", "VA19%", r"1\.V\.A\.19%",
]
TOTAL_LABEL = r"TOTAL\s+BRUTO|TOTAL\s+FACTURA|MONTO\s+TOTAL|\bTOTAL\b"
CONTRACTS = [
    r"(?:CONTRATO|CONTRAT[ÓO]|CONTRAT0)\s*(?:N[°º\.\:]?\s*|NUM(?:ERO)?\.?\s*|NUM\.?\s*|:?\s*)?([A-Z0-9\-\/]{4,})",
    r"(?:(?:NRO\.?|NRO|N°|Nº|NUM(?:ERO)?\.?)\s*)?(?:OPERACI[ÓO6]N|OPERAC1[ÓO6]N|OPERACION|OPERAC16N)(?:\s+LEASING)?[\s:\-]*([A-Z0-9\-\/]{4,})",
]


#: A term with its pattern or spelling.
PAIR = "struct<t: string, p: string>"


def upper(c: Column) -> Column:
    return F.upper(text_of(c))


def has(c: Column, pattern: str) -> Column:
    return c.rlike(rx(pattern))


def all_of(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(c, F.lit(rx(pattern)), F.lit(group))


def at(a: Column, i) -> Column:
    """Element or ''."""
    return F.coalesce(F.get(a, i if isinstance(i, Column) else F.lit(i)), F.lit(""))


def first_of(*values: Column) -> Column:
    """The first of the values that isn't ''; later ones are computed only if those before them are."""
    return F.coalesce(*[let(v, lambda x: F.when(x != "", x)) for v in values], F.lit(""))


def with_next(rows: Column) -> Column:
    """Each line joined with the one after it."""
    return F.transform(rows, lambda x, i: F.when(i + 1 < F.size(rows), F.concat(strip(x), F.lit(" "), strip(at(rows, i + 1)))).otherwise(strip(x)))


def cut_at(c: Column, words: list[str]) -> Column:
    """Text before the first of the words, in list order, that it holds."""
    out = F.lit(None).cast("string")
    for w in reversed(words):
        pos = F.instr(c, w)
        out = F.when(pos > 0, F.substring(c, F.lit(1), pos - 1)).otherwise(F.coalesce(out, c) if out is not None else c)
    return out


def document_number(c: Column) -> Column:
    return let(upper(c), lambda u: found(u, DOC_NUMBER))


def locality(c: Column, communes: list[str]) -> Column:
    """The first commune named after the tax office's initials, longest term first."""
    terms = longest_first(communes)

    def of(u: Column) -> Column:
        # no spelling of the initials fits a text without a letter of each
        near = F.when(u.rlike(r"[S5][.\s\-]*[I1L][.\s\-]*[I1L]"), F.array(*[F.regexp_replace(found(u, v + r"[-:\s]*([A-Z\s]{3,30})"), r"(?s)[\n\r:.,].*$", "") for v in TAX_OFFICE])).otherwise(F.array().cast("array<string>"))
        return first_filled(F.transform(F.filter(near, lambda x: x != ""), lambda x: first_contained(x, terms)))

    return let(upper(c), of)


def document_date(c: Column) -> Column:
    """Raw date: on a labelled line or the three after it, else on any line; due dates aside."""

    def of(rows: Column) -> Column:
        dates = F.transform(rows, lambda x: F.when(~x.rlike(r"\d.*\d{2}") | x.rlike(DUE_DATE), "").otherwise(first_filled(F.array(*[found(x, p) for p in DATES]))))

        def pick(dates: Column) -> Column:
            labelled = F.transform(rows, lambda x, i: F.when(has(x, DATE_LABEL) & ~has(x, DUE_DATE), first_filled(F.slice(dates, i + 1, 4))).otherwise(""))
            return first_filled(F.concat(labelled, dates))

        return let(dates, pick)

    return let(F.transform(F.split(upper(c), "\n"), strip), of)


def id_numbers(c: Column) -> Column:
    """All numbers with check digit, without dots, in order."""
    return F.transform(all_of(upper(c), ID_NUMBER, 0), lambda x: F.translate(x, ".", ""))


def supplier_id(c: Column) -> Column:
    return let(id_numbers(c), lambda a: at(a, 0))


def buyer_id(c: Column) -> Column:
    return let(id_numbers(c), lambda a: at(a, 1))


def supplier_name(c: Column) -> Column:
    """The line with a legal form nearest before the first id number, else the first after it, else one whose run-together text holds a legal form."""

    def names_firm(x: Column) -> Column:
        def of(words: Column) -> Column:
            pairs = F.transform(words, lambda w, i: F.concat(w, at(words, i + 1)))
            return ~F.exists(words, lambda w: w.isin(NOT_A_SUPPLIER)) & (F.exists(words, lambda w: w.isin(LEGAL_FORMS)) | F.exists(pairs, lambda w: w.isin(LEGAL_FORMS)))

        # a form or two words that make one stand in the run-together line
        hopeful = F.upper(F.regexp_replace(x, "[^A-Za-z]", "")).rlike("|".join(LEGAL_FORMS))
        return hopeful & let(F.transform(F.split(x, rx(r"\s+")), lambda w: F.upper(F.regexp_replace(w, rx(r"\W"), ""))), of)

    def of(rows: Column) -> Column:
        where = F.array_position(F.transform(rows, lambda x: has(F.upper(x), ID_NUMBER)), True)

        def pick(k: Column) -> Column:
            k = k.cast("int")
            before = F.reverse(F.slice(rows, 1, F.greatest(k - 1, F.lit(0))))
            after = F.slice(rows, k + 1, F.size(rows))
            joined = F.filter(rows, lambda x: let(F.upper(F.regexp_replace(x, rx(r"\W"), "")), lambda j: ~j.rlike("|".join(NOT_A_SUPPLIER)) & j.rlike("|".join(LEGAL_FORMS))))
            return F.when(k > 0, first_of(first_filled(F.filter(before, names_firm)), first_filled(F.filter(after, names_firm)), first_filled(joined))).otherwise("")

        return let(where, pick)

    return let(full_lines(c), of)


def buyer_name(c: Column) -> Column:
    """The value beside or up to three lines below a buyer label, within twenty lines after the document number."""

    def usable(v: Column) -> Column:
        u = F.upper(v)
        return F.when((v != "") & ~has(u, NOT_A_BUYER) & (F.length(F.regexp_replace(u, "[^A-Z0-9]", "")) >= 3) & u.rlike("[A-Z]"), v).otherwise("")

    def of(rows: Column) -> Column:
        anchor = F.array_position(F.transform(rows, lambda x: has(F.upper(x), BUYER_ANCHOR)), True).cast("int")

        def pick(k: Column) -> Column:
            near = F.slice(rows, k + 1, 23)

            def beside(x: Column, i: Column) -> Column:
                # the first label of the list that the line has; what stands after it
                rest = F.lit(None).cast("string")
                for label in reversed(BUYER_LABELS):
                    rest = F.when(has(F.upper(x), label), F.regexp_replace(x, rx(f"(?is)^.*?(?:{label})"), "")).otherwise(rest)
                value = F.regexp_replace(F.regexp_replace(rest, r"(?i)[\(\[\{]\s*[EA]S\s*[\)\]\}]", ""), r"^[ :.\-\t]+", "")
                below = F.transform(F.slice(rows, k + i + 2, 3), usable)
                return F.when(rest.isNotNull() & (i < 20), first_filled(F.concat(F.array(usable(strip(value))), below))).otherwise("")

            return F.when(k > 0, first_filled(F.transform(near, beside))).otherwise("")

        return let(anchor, pick)

    return let(full_lines(c), of)


def buyer_address(c: Column, communes: list[str]) -> Column:
    """Up to 50 characters beside or below an address label after the first id number, cut where a commune follows a digit or sign."""
    terms = longest_first(communes)

    def of(rows: Column) -> Column:
        def raw(x: Column, i: Column) -> Column:
            u = F.upper(x)
            value = F.lit(None).cast("string")
            for label in reversed(ADDRESS_LABELS):
                beside = found(u, label + r"\s*[:\-]?\s*(.+)")
                value = F.when(has(u, label), F.when(beside != "", beside).otherwise(strip(at(rows, i + 1)))).otherwise(value)
            return value

        hits = F.filter(F.transform(rows, raw), lambda v: v.isNotNull())

        def cut(v: Column) -> Column:
            v = F.regexp_replace(v, r"(?iu)^[^A-ZÁÉÍÓÚÑ0-9 ]+", "")
            # a term that isn't contained needs no pattern of its own
            held = F.filter(terms_array(terms), lambda t: F.contains(F.upper(v), t))
            after = F.filter(held, lambda t: F.rlike(F.upper(v), F.concat(F.lit(r"(?U)([^\w\s]|[0-9])\s*\Q"), t, F.lit(r"\E"))))
            at_term = F.instr(F.upper(v), F.get(after, F.lit(0)))
            return strip(F.substring(strip(F.when(at_term > 0, F.substring(v, F.lit(1), at_term - 1)).otherwise(v)), 1, 50))

        return let(at(hits, 0), lambda v: F.when(v == "", "").otherwise(let(v, cut)))

    rest = F.regexp_extract(text_of(c), rx(rf"(?s)^.*?(?:{ID_NUMBER})(.*)$"), 1)
    return let(full_lines(rest), of)


def buyer_phones(c: Column) -> Column:
    """All phone numbers on the first phone line after the second id number, and the line below: +56 and nine digits, or the last nine digits."""

    def of(rows: Column) -> Column:
        where = F.array_position(F.transform(rows, lambda x: F.upper(x).rlike("TELEFONO|TELÉFONO")), True).cast("int")

        def pick(k: Column) -> Column:
            def form(x: Column) -> Column:
                d = F.regexp_replace(x, r"[^\d+]", "")
                last = F.substring(d, -9, 9)
                return F.when((d.startswith("56") & (F.length(d) >= 11)) | (d.startswith("+56") & (F.length(d) >= 12)), F.concat(F.lit("+56"), last)).when(F.length(d) >= 8, F.when(F.length(d) < 9, d).otherwise(last)).otherwise("")

            numbers = all_of(F.concat(at(rows, k - 1), F.lit("\n"), at(rows, k)), PHONE, 0)
            return F.when(k > 0, F.filter(F.transform(numbers, form), lambda x: x != "")).otherwise(F.array().cast("array<string>"))

        return let(where, pick)

    rest = F.regexp_extract(text_of(c), rx(rf"(?s)^.*?(?:{ID_NUMBER}).*?(?:{ID_NUMBER})(.*)$"), 1)
    return let(full_lines(rest), of)


def buyer_phone(c: Column) -> Column:
    return let(buyer_phones(c), lambda a: at(a, 0))


def labelled_place(c: Column, label: str, places: list[str]) -> Column:
    place = found(upper(c), rf"(?:{label}\s*[:\-]?\s*)([A-Z\s]+)")
    return let(place, lambda p: F.when(p == "", "").otherwise(first_contained(p, longest_first(places))))


def buyer_commune(c: Column, communes: list[str]) -> Column:
    return labelled_place(c, "COMUNA", communes)


def buyer_city(c: Column, cities: list[str]) -> Column:
    return labelled_place(c, "CIUDAD", cities)


def plate(c: Column) -> Column:
    def of(raw: Column) -> Column:
        bare = F.regexp_replace(raw, r"\W", "")
        return F.when(bare.rlike(PLATE_FORMS), bare).otherwise(raw)

    return let(found(upper(c), PLATE), of)


def vehicle_type(c: Column) -> Column:
    """Longest type named after a vehicle-type label, else longest named as a whole word."""
    types = longest_first(VEHICLE_TYPES)
    labelled = [rf"(?U)TIPO(?:\s+DE)?\s+VEHICULO[\s:\-]*{t}(?=\b|[^A-Z])|VEHICULO[\s:\-]*{t}|TIPOVEHICULO{t}" for t in types]
    table = literal_rows([{"t": t, "p": p} for t, p in zip(types, labelled)], PAIR)
    words = literal_rows([{"t": t, "p": rf"(?U)\b{t}\b"} for t in types], PAIR)

    def of(u: Column) -> Column:
        # a type that isn't contained needs no pattern
        pick = lambda a: F.coalesce(F.get(F.filter(a, lambda s: F.contains(u, s["t"]) & F.rlike(u, s["p"])), F.lit(0))["t"], F.lit(""))
        return F.when(F.contains(u, F.lit("VEHICULO")), first_filled(F.array(pick(table), pick(words)))).otherwise(pick(words))

    return let(upper(c), of)


def make_text(c: Column) -> Column:
    """Text before COLOR, in plain capitals."""
    u = F.regexp_replace(F.translate(upper(c), ACCENTED, PLAIN), "[^\\x00-\\x7F]", "")
    return strip(F.regexp_replace(u, r"(?s)\bCOLOR\b.*$", ""))


def make_candidates(c: Column) -> Column:
    """Up to three words after each make label, line by line."""
    return F.filter(F.transform(lines_of(make_text(c)), lambda x: F.array_join(F.slice(F.split(F.regexp_replace(found(x, MAKE_LABEL), "^[ ,.:]+|[ ,.:]+$", ""), " +"), 1, 3), " ")), lambda v: v != "")


def make(c: Column, makes: list[str], close: Column | None = None) -> Column:
    """A labelled make of the list, or one close to it (close: per candidate, from closest()), else the longest make that stands in the text as a word."""
    terms = longest_first(makes)
    word_text = lambda t: F.concat(F.lit(" "), F.regexp_replace(t, r"[^A-Z0-9_]+", " "), F.lit(" "))
    exact = F.filter(make_candidates(c), lambda v: F.array_contains(terms_array(terms), v)) if terms else F.array().cast("array<string>")
    spelled = [" " + "".join(ch if ch.isalnum() or ch == "_" else " " for ch in t) + " " for t in terms]
    table = literal_rows([{"t": t, "p": s} for t, s in zip(terms, spelled)], PAIR) if terms else None
    word = let(word_text(make_text(c)), lambda u: F.coalesce(F.get(F.filter(table, lambda s: F.contains(u, s["p"])), F.lit(0))["t"], F.lit(""))) if terms else F.lit("")
    return first_filled(F.array(first_filled(exact) if close is None else close, word))


def model(c: Column) -> Column:
    return let(found(upper(c), r"(?:MODELO[\s:\-]*)([A-Z0-9\-./ ]{3,40})"), lambda v: strip(cut_at(v, MODEL_ENDS)))


def engine_number(c: Column) -> Column:
    """First run of signs with a digit beside or below an engine label, before the next label; else first such word; else first such run."""

    def bare(a: Column) -> Column:
        return F.filter(F.transform(a, lambda x: F.translate(x, "-", "")), lambda x: F.length(x).between(7, 20) & x.rlike(r"\d"))

    def of(u: Column) -> Column:
        rows = lines_of(u)
        near = F.transform(F.filter(F.transform(rows, lambda x, i: F.when(x.rlike(ENGINE_LABEL), strip(F.concat(x, F.lit(" "), at(rows, i + 1))))), lambda x: x.isNotNull()), lambda x: first_filled(bare(all_of(cut_at(x, ENGINE_ENDS), r"[A-Z0-9\-]{7,30}", 0))))
        words = F.filter(all_of(u, r"\b[A-Z0-9]{7,20}\b", 0), lambda x: x.rlike(r"\d"))
        return first_of(first_filled(near), at(words, 0), first_filled(bare(all_of(u, r"[A-Z0-9\-]{7,30}", 0))))

    return let(upper(c), of)


def chassis_valid(c: Column) -> Column:
    """12-20 letters and digits, at least three of each, without common words."""
    b = F.upper(F.translate(strip(c), "- ", ""))
    return b.rlike("^[A-Z0-9]{12,20}$") & (F.length(F.regexp_replace(b, "[^A-Z]", "")) >= 3) & (F.length(F.regexp_replace(b, "[^0-9]", "")) >= 3) & ~b.rlike(NOT_A_CHASSIS)


def chassis_number(c: Column) -> Column:
    def of(u: Column) -> Column:
        # every label holds one of the two stems
        labelled = F.when(F.contains(u, F.lit("CHAS")) | F.contains(u, F.lit("NUMERO CH")), F.translate(found(u, CHASSIS), " -", "")).otherwise("")
        words = F.filter(all_of(u, r"\b[A-Z0-9]{12,20}\b", 0), chassis_valid)
        runs = F.filter(all_of(u, r"[A-Z0-9\-]{12,30}", 0), chassis_valid)
        return first_of(let(labelled, lambda x: F.when(chassis_valid(x), x).otherwise("")), at(words, 0), at(runs, 0))

    return let(F.regexp_replace(F.regexp_replace(upper(c), r"([A-Z]{3,15})\s*:", "\n$1:"), "II|//|  ", "\n"), of)


def vehicle_number(c: Column) -> Column:
    return let(upper(c), lambda u: found(u, VEHICLE_NUMBER))


def series(c: Column) -> Column:
    return let(upper(c), lambda u: found(u, SERIES))


def colour(c: Column, colours: list[str]) -> Column:
    """Colours of the list after a colour label, taken greedily by three, two and one word, joined."""
    terms = terms_array(sorted({t.strip().upper() for t in colours}))

    def of(w: Column) -> Column:
        step = F.aggregate(
            F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0))), F.struct(F.lit(0).alias("next"), F.lit("").alias("out")),
            lambda s, i: F.when(i < s["next"], s).otherwise(
                let(F.coalesce(*[F.when((i + n <= F.size(w)) & F.array_contains(terms, F.array_join(F.slice(w, i + 1, n), " ")), F.lit(n)) for n in (3, 2, 1)]),
                    lambda n: F.struct((i + F.coalesce(n, F.lit(1))).alias("next"), F.when(n.isNotNull(), F.concat_ws(" ", F.when(s["out"] != "", s["out"]), F.array_join(F.slice(w, i + 1, n), " "))).otherwise(s["out"]).alias("out")))),
        )
        return step["out"]

    cleaned = F.trim(F.regexp_replace(F.regexp_replace(found(upper(c), COLOUR), rx(r"[^\wÁÉÍÓÚÑ\s]"), " "), rx(r"\s+"), " "))
    return let(F.split(cleaned, " "), of)


def year(c: Column) -> Column:
    return let(all_of(upper(c), YEAR), lambda a: first_filled(F.filter(a, lambda y: y.cast("int").between(1980, 2100))))


def weight_unit(c: Column) -> Column:
    def of(u: Column) -> Column:
        rows = lines_of(u)
        near = F.transform(rows, lambda x, i: F.when(x.rlike(WEIGHT_LABEL_FOR_UNIT), first_filled(F.array(found(x, WEIGHT_UNIT), found(at(rows, i + 1), WEIGHT_UNIT)))).otherwise(""))
        return first_of(first_filled(near), found(u, WEIGHT_UNIT))

    return let(upper(c), of)


def gross_weight(c: Column) -> Column:
    """Largest number above 10 on or below a weight label; points part thousands, a comma decimals; cut to a whole number."""

    def number(x: Column) -> Column:
        return F.translate(F.translate(F.regexp_extract(x, r"([\d\.,]+)", 1), ".", ""), ",", ".").try_cast("double")

    def of(rows: Column) -> Column:
        per = F.flatten(F.transform(F.filter(F.transform(rows, lambda x, i: F.struct(x.alias("x"), at(rows, i + 1).alias("y"))), lambda s: has(s["x"], WEIGHT_LABEL)), lambda s: F.array(number(s["x"]), number(s["y"]))))
        return F.coalesce(F.array_max(F.filter(per, lambda v: v > 10)).cast("long").cast("string"), F.lit(""))

    return let(lines_of(upper(c)), of)


def report_code_by_make(c: Column, make_: Column, prefixes: list[tuple[str, str]] | None = None) -> Column:
    """First code of the form XXXXXX-Y that begins with one of the make's prefixes."""
    table = literal_rows([{"t": m, "p": p} for m, p in (prefixes or REPORT_CODE_PREFIXES)], PAIR)
    own = F.filter(table, lambda s: s["t"] == F.upper(make_))
    return let(own, lambda o: first_filled(F.filter(all_of(upper(c), r"\b[A-Z0-9]{6,}\-[A-Z0-9]{1,3}\b", 0), lambda x: F.exists(o, lambda s: F.startswith(x, s["p"])))))


def report_code(c: Column, make_: Column, prefixes: list[tuple[str, str]] | None = None) -> Column:
    """First run of six signs with letter and digit on a report-code line, else by the make's prefix."""

    def of(u: Column) -> Column:
        near = F.flatten(F.transform(F.filter(lines_of(u), lambda x: has(x, REPORT_LABEL)), lambda x: all_of(x, r"\b([A-Z0-9\-]{6,})\b")))
        return first_filled(F.concat(F.slice(F.filter(near, lambda x: x.rlike("[A-Z]") & x.rlike(r"\d")), 1, 1), F.array(report_code_by_make(u, make_, prefixes))))

    return let(upper(c), of)


def fuel(c: Column) -> Column:
    def of(rows: Column) -> Column:
        hopeful = F.filter(with_next(rows), lambda x: F.contains(x, F.lit("COMBUSTIBLE")))
        labelled = F.transform(hopeful, lambda x: found(x, rf"(?:TIPO\s+DE\s+COMBUSTIBLE|TIPO\s+COMBUSTIBLE|COMBUSTIBLE)[\s:\-]*({FUELS})"))
        return first_of(first_filled(labelled), first_filled(F.transform(rows, lambda x: first_contained(x, FUEL_WORDS))))

    return let(lines_of(upper(c)), of)


def load_unit(c: Column) -> Column:
    return let(upper(c), lambda u: found(u, "(TONELADAS|KILOS|TON|KG)"))


def load(c: Column) -> Column:
    return let(upper(c), lambda u: F.translate(found(u, LOAD), ".,", ""))


def seats(c: Column) -> Column:
    def of(u: Column) -> Column:
        return first_filled(F.filter(F.array(found(u, r"ASIENTOS[\s:\-]*([0-9]+)"), found(u, r"([0-9]+)[\s\-]*ASIENTOS")), lambda v: v.try_cast("int") <= 60))

    return let(upper(c), of)


def doors(c: Column) -> Column:
    pattern = r"(?:PUERTAS[\s:\-\.]*(\d+)|(\d+)[\s:\-\.]*PUERTAS)"
    return let(upper(c), lambda u: let(first_filled(F.array(found(u, pattern, 1), found(u, pattern, 2))), lambda v: F.when(v.try_cast("int") <= 9, v).otherwise("")))


def power(c: Column) -> Column:
    def of(rows: Column) -> Column:
        # only lines that name power or its units, or follow one, can hold it
        pairs = F.transform(rows, lambda x, i: F.struct(x.alias("x"), F.concat_ws(" ", x, F.get(rows, i + 1)).alias("y")))
        hopeful = F.filter(pairs, lambda s: s["y"].rlike("POT|HP|CV"))
        return first_filled(F.flatten(F.transform(hopeful, lambda s: F.array(*[found(s["x"], p) for p in POWER], *[found(s["y"], p) for p in POWER]))))

    return let(full_lines(upper(c)), of)


def power_unit(c: Column) -> Column:
    return let(upper(c), lambda u: F.when(power(u) != "", found(u, "(KCAL/S|BTU/S|CV|HP|KP|KW)")).otherwise(""))


def axle_candidates(c: Column) -> Column:
    """What follows axle labels: one or two groups joined by a hyphen."""
    return F.transform(all_of(upper(c), AXLE, 0), lambda x: F.concat_ws("-", found(x, AXLE, 1), F.when(found(x, AXLE, 2) != "", found(x, AXLE, 2))))


def axles_exact(c: Column) -> Column:
    return let(axle_candidates(c), lambda a: first_filled(F.filter(a, lambda x: x.isin(AXLES))))


def drive(c: Column) -> Column:
    return let(upper(c), lambda u: found(u, DRIVE))


def bodywork(c: Column, kinds: list[str]) -> Column:
    terms = longest_first(kinds)

    def of(u: Column) -> Column:
        # only a text that holds a term needs its lines looked at
        held = first_contained(u, terms)
        return first_of(first_contained(found(u, BODYWORK), terms), F.when(held == "", "").otherwise(first_filled(F.transform(lines_of(u), lambda x: first_contained(x, terms)))))

    return let(upper(c), of)


def displacement(c: Column) -> Column:
    return let(upper(c), lambda u: first_filled(F.array(found(u, r"CILINDRADA[\s:\-]*([\d\.]+\s*CC)"), found(u, r"CILINDRADA[\s:\-]*([\d\.]+)"))))


def gearbox(c: Column) -> Column:
    """Kind named after a gearbox label (even if it is none of the two), else MANUAL before AUTOMATICA among all mentions."""

    def of(u: Column) -> Column:
        labelled = first_filled(F.array(*[found(u, rf"(?:{label})[\s:\-]*{GEARBOX}") for label in GEARBOX_LABELS]))
        named = F.transform(all_of(u, GEARBOX), gearbox_synonym)
        free = F.when(F.array_contains(named, "MANUAL"), "MANUAL").when(F.array_contains(named, "AUTOMATICA"), "AUTOMATICA").otherwise("")
        return F.when(labelled != "", gearbox_synonym(labelled)).otherwise(free)

    return let(upper(c), of)


def plain_amount(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "").try_cast("long")


def net_of(rows: Column) -> Column:
    """First amount above 100 on a net label's line or the three below; labels with NETO before the others. Null if none."""
    amounts_ = F.transform(rows, lambda x: let(F.translate(F.regexp_extract(x, r"([\d\.,]{3,})", 1), ".,", "").try_cast("long"), lambda n: F.when(n > 100, n)))

    def pick(a: Column) -> Column:
        def by(label: str, *stems: str) -> Column:
            # a line that holds none of the labels' stems needs no pattern
            here = lambda x: reduce(or_, [F.contains(x, F.lit(w)) for w in stems]) & has(x, label)
            near = F.flatten(F.transform(rows, lambda x, i: F.when(here(x), F.slice(a, i + 1, 4)).otherwise(F.array().cast("array<bigint>"))))
            return F.get(F.filter(near, lambda n: n.isNotNull()), F.lit(0))

        return F.coalesce(by(NET_FIRST, "NETO"), by(NET_SECOND, "TOTAL", "AFECTO", "ALECTO"))

    return let(amounts_, pick)


def net_amount(c: Column) -> Column:
    return let(full_lines(upper(c)), net_of)


def tax_of(rows: Column) -> Column:
    """First amount of at least 1,000 other than 1900 after a tax label, or on the three lines below it. Null if none."""

    def good(x: Column) -> Column:
        return let(plain_amount(F.regexp_extract(x, r"([\d\.,]{4,})", 1)), lambda n: F.when((n >= 1000) & (n != 1900), n))

    def pick(below: Column) -> Column:
        # every label has V and A, so other lines need no pattern
        named = F.filter(F.transform(rows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: s["x"].rlike(r"V\.?A"))

        def beside(s: Column) -> Column:
            return F.flatten(F.array(*[F.when(has(s["x"], label), F.concat(F.array(good(F.regexp_replace(s["x"], rx(f"(?s)^.*?(?:{label})"), ""))), F.slice(below, s["i"] + 2, 3))).otherwise(F.array().cast("array<bigint>")) for label in TAX_LABELS]))

        return F.get(F.filter(F.flatten(F.transform(named, beside)), lambda n: n.isNotNull()), F.lit(0))

    return let(F.transform(rows, good), pick)


def tax_amount(c: Column) -> Column:
    return let(full_lines(upper(c)), tax_of)


def amounts(c: Column) -> Column:
    """struct(neto, iva, total), nulls where there is none. total: largest dotted amount around the last total label that exceeds net and tax, else one within 100 of their sum, else the amount in words."""

    def of(rows: Column) -> Column:
        last = F.array_max(F.transform(rows, lambda x, i: F.when(F.contains(x, F.lit("TOTAL")) & has(x, TOTAL_LABEL), i)))

        def pick(s: Column) -> Column:
            net, tax = F.coalesce(s["net"], F.lit(0)), F.coalesce(s["tax"], F.lit(0))
            near = F.transform(F.slice(rows, F.greatest(s["k"] - 2, F.lit(1)), F.least(s["k"] + 3, F.lit(6)) + F.lit(1)), lambda x: F.translate(F.regexp_extract(x, r"(\d{1,3}(?:\.\d{3})+)", 1), ".", "").try_cast("long"))
            most = F.greatest(net, tax)
            around = F.get(F.filter(near, lambda n: F.abs(n - (net + tax)) <= 100), F.lit(0))
            # words are read only where no amount was found
            spoken = F.filter(F.transform(rows, lambda x, i: F.when(F.contains(x, F.lit("SON")), number_words(F.concat_ws(" ", x, F.get(rows, i + 1), F.get(rows, i + 2))))), lambda n: n > most)
            total = F.coalesce(F.when(s["k"].isNotNull(), F.coalesce(F.array_max(F.filter(near, lambda n: n > most)), around)), F.get(spoken, F.lit(0)))
            return F.struct(s["net"].alias("neto"), s["tax"].alias("iva"), total.alias("total"))

        return let(F.struct(net_of(rows).alias("net"), tax_of(rows).alias("tax"), last.alias("k")), pick)

    return let(full_lines(upper(c)), of)


def total_amount(c: Column) -> Column:
    return amounts(c)["total"]


def amount_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def contract_number(c: Column) -> Column:
    """Sign run with a digit after a contract or operation label, over a line and the one below it."""

    def of(rows: Column) -> Column:
        # every label holds one of the two stems, so other lines need no pattern
        hopeful = F.filter(with_next(rows), lambda x: F.contains(x, F.lit("CONTRAT")) | F.contains(x, F.lit("OPERAC")))
        hits = F.flatten(F.transform(hopeful, lambda x: F.array(*[F.regexp_replace(found(x, p), "[ .:\\-]+$", "") for p in CONTRACTS])))
        return first_filled(F.filter(hits, lambda v: v.rlike(r"\d") & ~v.isin("CONTRATO", "OPERACION", "CODIGO", "INTERNO")))

    return let(lines_of(upper(c)), of)
