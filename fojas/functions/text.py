"""Text framing and cleaning as column expressions. Null counts as empty text throughout."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from fojas.functions.fixed import AMOUNT_WORDS, BODY_WORDS, MORE_AMOUNT_WORDS
from fojas.functions.reading import ACCENTED, PLAIN, let, literal_map

FOOTER_MARK = "[SEGMENTO_TOTALES]"
HEADER_MARK = "[SEGMENTO_CABECERA]"
#: Line ends that count as one newline.
LINE_ENDS = "\r\n|[\r\u000b\u000c\u001c\u001d\u001e\u0085  ]"


def rx(pattern: str) -> str:
    """Unicode-aware word classes where a pattern has any: they cost much time, so other patterns go without."""
    return "(?U)" + pattern if re.search(r"\\[wWbB]", pattern) else pattern


def text_of(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """Trim all white space."""
    return F.regexp_replace(c, r"^[\s\xa0]+|[\s\xa0]+$", "")


def lines_of(c: Column) -> Column:
    """All lines; every Unicode line end parts lines."""
    return F.split(F.regexp_replace(text_of(c), LINE_ENDS, "\n"), "\n")


def full_lines(c: Column) -> Column:
    """Trimmed lines that aren't blank."""
    return F.filter(F.transform(lines_of(c), strip), lambda x: x != "")


def found(c: Column, pattern: str, group: int = 1) -> Column:
    """First match's group, trimmed; '' on a miss."""
    return strip(F.regexp_extract(c, rx(pattern), group))


def first_filled(values: Column) -> Column:
    """First element that isn't '' or null, else ''."""
    return F.coalesce(F.get(F.filter(values, lambda x: F.coalesce(x, F.lit("")) != ""), F.lit(0)), F.lit(""))


def literal_rows(rows: list, schema: str) -> Column:
    """A list as one literal of the plan, folded when it is optimised, instead of one for each of its values."""
    return F.from_json(F.lit(json.dumps(rows, ensure_ascii=False)), f"array<{schema}>")


def terms_array(terms: list[str]) -> Column:
    return literal_rows(list(terms), "string")


def longest_first(terms) -> list[str]:
    """Upper-cased terms without repeats, longest first, then alphabetical."""
    return sorted({t.strip().upper() for t in terms if t and t.strip()}, key=lambda t: (-len(t), t))


def first_contained(c: Column, terms: list[str]) -> Column:
    """The first of the terms, in the order given, that the text contains; '' if none."""
    return first_filled(F.filter(terms_array(terms), lambda t: F.contains(c, t)))


def normalize_text(c: Column) -> Column:
    """Upper case, accents and digits to plain letters, all else to single blanks (STR1)."""
    u = F.translate(F.upper(text_of(c)), ACCENTED + "ªº", PLAIN + "AO")
    u = F.regexp_replace(u, "[^\\x00-\\x7F]", "")
    u = F.translate(u, "015348", "OISEAB")
    return F.trim(F.regexp_replace(F.regexp_replace(u, "[^A-Z\\s]", " "), "\\s+", " "))


def ngrams(words: Column, n: int) -> Column:
    """Sliding n-grams of an array of words; none if it is shorter (STR2)."""
    size = F.size(words)
    at = F.when(size >= n, F.sequence(F.lit(1), size - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.array_join(F.slice(words, i, n), " "))


def clean_value(c: Column) -> Column:
    """Value without marks and stray signs at its edges (STR3)."""
    v = F.regexp_replace(strip(text_of(c)), r"\[SEGMENTO_CABECERA\]", "")
    for pattern in (r"\.0$", r"-+$", r"!+$", r"\.{2,}$"):
        v = F.regexp_replace(v, pattern, "")
    v = strip(F.regexp_replace(strip(v), "^:|:$", ""))
    return strip(F.regexp_replace(v, "(?iu)^[^A-Z0-9ÁÉÍÓÚÑ]+|[^A-Z0-9ÁÉÍÓÚÑ]+$", ""))


def header_and_body(c: Column) -> Column:
    """struct(cabecera, cuerpo): parted at the earliest line that holds a body word and begins in the first half; otherwise both are the whole trimmed text. White space of two or more collapses in parted texts (STR4)."""
    has_word = "|".join(w.replace(".", r"\.") for w in BODY_WORDS)

    def of(t: Column) -> Column:
        rows = F.split(t, "\n")
        # only a text that holds a body word needs its lines looked at
        whole = F.struct(strip(t).alias("cabecera"), strip(t).alias("cuerpo"))
        return F.when(F.upper(t).rlike(has_word), by_line(t, rows)).otherwise(whole)

    def by_line(t: Column, rows: Column) -> Column:
        state = F.aggregate(
            rows,
            F.struct(F.lit(0).alias("at"), F.lit(-1).alias("cut")),
            lambda s, line: F.struct((s["at"] + F.length(line) + 1).alias("at"), F.when((s["cut"] < 0) & F.upper(line).rlike(has_word), s["at"]).otherwise(s["cut"]).alias("cut")),
        )

        def parted(s: Column) -> Column:
            ok = (s["cut"] >= 0) & (s["cut"] <= F.floor(F.length(t) / 2))
            head = F.regexp_replace(F.concat(F.lit(" "), strip(F.substring(t, F.lit(1), s["cut"]))), rx(r"\s{2,}"), " ")
            body = F.regexp_replace(F.concat(F.lit(" "), strip(F.substring(t, s["cut"] + 1, F.length(t)))), rx(r"\s{2,}"), " ")
            return F.struct(F.when(ok, head).otherwise(strip(t)).alias("cabecera"), F.when(ok, body).otherwise(strip(t)).alias("cuerpo"))

        return let(state, parted)

    return let(F.regexp_replace(text_of(c), LINE_ENDS, "\n"), of)


def footer(c: Column) -> Column:
    """From the totals mark to the end, or the whole trimmed text (STR5)."""
    t = text_of(c)
    at = F.instr(t, FOOTER_MARK)
    return strip(F.when(at > 0, F.substring(t, at, F.length(t))).otherwise(t))


def numbered_lines(c: Column) -> Column:
    """Lines with their numbers of four digits (PRJ4)."""
    return F.array_join(F.transform(lines_of(c), lambda x, i: F.concat(F.lpad((i + 1).cast("string"), 4, "0"), F.lit(": "), x)), "\n")


def entropy(c: Column) -> Column:
    """Shannon entropy over characters in bits, 0.0 for empty text (TXT1): from the counts of the sorted characters."""
    chars = F.filter(F.split(text_of(c), ""), lambda x: x != "")

    def of(a: Column) -> Column:
        n = F.size(a).cast("double")
        # the run lengths of the sorted characters, folded in one pass
        start = F.struct(F.lit("").alias("c"), F.lit(0.0).alias("k"), F.lit(0.0).alias("sum"))
        term = lambda k: F.when(k > 0, k * F.log2(k)).otherwise(0.0)
        total = F.aggregate(
            F.array_sort(a), start,
            lambda s, x: F.struct(x.alias("c"), F.when(x == s["c"], s["k"] + 1.0).otherwise(1.0).alias("k"), F.when(x == s["c"], s["sum"]).otherwise(s["sum"] + term(s["k"])).alias("sum")),
            lambda s: s["sum"] + term(s["k"]),
        )
        return F.when(n > 0, F.abs(F.log2(n) - total / n)).otherwise(0.0)

    return let(chars, of)


def number_words(c: Column, more: bool = False) -> Column:
    """Amount written in Spanish words after the last 'SON:', null if there is none (STR7): units add up, thousands and millions multiply what came before them, other words are passed over."""
    table = AMOUNT_WORDS | (MORE_AMOUNT_WORDS if more else {})
    u = F.translate(F.upper(text_of(c)), ACCENTED, PLAIN)
    words = F.split(F.trim(F.regexp_replace(F.regexp_replace(F.element_at(F.split(u, "SON:"), -1), "[^A-Z\\s]", ""), "\\s+", " ")), " ")
    values = F.filter(F.transform(words, lambda w: F.element_at(literal_map({k: float(v) for k, v in table.items()}), w)), lambda v: v.isNotNull())
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("part"))
    total = F.aggregate(
        values, start,
        lambda s, v: F.when(v >= 1000, F.struct((s["total"] + F.greatest(s["part"], F.lit(1.0)) * v).alias("total"), F.lit(0.0).alias("part"))).otherwise(F.struct(s["total"].alias("total"), (s["part"] + v).alias("part"))),
        lambda s: (s["total"] + s["part"]).cast("long"),
    )
    return F.when(total > 0, total)
