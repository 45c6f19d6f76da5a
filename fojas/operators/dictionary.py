"""Texts against lists of terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fojas.functions.text import first_contained, longest_first, terms_array

#: Up to so many terms a list is put into the plan as a literal; a longer one is joined (contained_in).
MOST_TERMS = 20_000


def terms_table(dictionary: DataFrame, column: str) -> DataFrame:
    """(t): distinct trimmed, upper-cased terms."""
    return dictionary.select(F.upper(F.trim(F.regexp_replace(column, "\ufeff", ""))).alias("t")).where("t <> ''").distinct()


def terms_of(dictionary: DataFrame, column: str) -> list[str]:
    """Distinct trimmed, upper-cased terms, longest first (SRC7, SRT3), for lists that are put into plans; for longer ones see contained_in."""
    rows = terms_table(dictionary, column).limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms: use contained_in")
    return longest_first(r["t"] for r in rows)


def contained_in(texts: DataFrame, column: str, dictionary: DataFrame, term: str) -> DataFrame:
    """(column, n, mas_largo) of the distinct texts: how many terms each contains, and the longest (JOIN7), by an equi-join on the texts' pieces of every length that terms have. For lists of any length."""
    terms = terms_table(dictionary, term)
    lengths = sorted(r[0] for r in terms.select(F.length("t")).distinct().collect())
    own = texts.select(column).where(F.col(column).isNotNull()).distinct()

    def pieces(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(column) - (n - 1), F.lit(1))), lambda i: F.substring(F.col(column), i, F.lit(n)))

    spans = F.flatten(F.array(*map(pieces, lengths))) if lengths else F.array().cast("array<string>")
    hits = own.select(column, F.explode(F.array_distinct(spans)).alias("t")).join(terms, "t").groupBy(column).agg(F.count("*").alias("n"), F.min_by("t", F.struct(-F.length("t"), F.col("t"))).alias("mas_largo"))
    return own.join(hits, column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("mas_largo", F.lit("")).alias("mas_largo"))


def contained_terms(c: Column, terms: list[str]) -> Column:
    """All terms that the text contains, in the order given (JOIN7)."""
    return F.filter(terms_array(terms), lambda t: F.contains(c, t))


def longest_contained(c: Column, terms: list[str]) -> Column:
    return first_contained(c, longest_first(terms))


def prefix_lookup(codes: DataFrame, prefixes: DataFrame, group: str, code: str, prefix: str) -> DataFrame:
    """Codes that begin with one of their group's prefixes, with the longest such prefix (JOIN8): equi-join on group and the prefix's text at each length that occurs."""
    lengths = sorted(r[0] for r in prefixes.select(F.length(prefix)).distinct().collect())
    heads = codes.withColumn("_head", F.explode(F.array(*[F.substring(code, 1, n) for n in lengths]))) if lengths else codes.withColumn("_head", F.lit(None).cast("string"))
    hits = heads.join(prefixes.select(group, F.col(prefix).alias("_head")).distinct(), [group, "_head"])
    return hits.groupBy(group, code).agg(F.max_by("_head", F.length("_head")).alias("prefijo"))
