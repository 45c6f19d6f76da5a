"""Similarity of strings as the standard library measures it: one vectorised Python pass for all fields that need it."""

from __future__ import annotations

import difflib
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from fojas.functions.fixed import AXLES, DOCUMENT_TYPES

_FOLD = {ord(a): b for a, b in zip("ÁÉÍÓÚÜÑ", "AEIOUUN")}


def plain_phrase(text: str) -> str:
    """The same as the column expression for plain text, for the phrases of the table."""
    t = text.upper().translate(_FOLD).translate(str.maketrans("015348", "OISEAB"))
    return re.sub(r"\s+", " ", re.sub(r"[^A-Z\s]", " ", t)).strip()


#: Phrase in plain text -> (type, what must not occur); where two phrases become the same, the later one holds.
PHRASES = {plain_phrase(p): (kind, plain_phrase(ban) if ban else None) for kind, rows in DOCUMENT_TYPES.items() for p, ban in rows}


@lru_cache(maxsize=200_000)
def closest(word: str, terms: tuple[str, ...], cutoff: float) -> str:
    """The term most similar to word at or above cutoff, or ''."""
    hit = difflib.get_close_matches(word, terms, n=1, cutoff=cutoff)
    return hit[0] if hit else ""


_PHRASE_LIST = tuple(PHRASES)


def document_type_of(plain: str) -> str:
    """Type of the first phrase, in scan order (2 to 5 words, then single ones), that is similar to a known one; DESCONOCIDO if none is."""
    words = [w for w in plain.split() if w != "S"]
    spans = [" ".join(words[i : i + n]) for n in range(2, 6) for i in range(len(words) - n + 1)]
    for span in [*spans, *words]:
        if span.replace(" ", "") in ("SS", "SSA", "S"):
            continue
        hit = closest(span, _PHRASE_LIST, 0.75)
        if hit:
            kind, ban = PHRASES[hit]
            if not (ban and ban in plain):
                return kind
    return "DESCONOCIDO"


def axles_of(candidates: list[str]) -> str:
    """The allowed arrangement equal to a candidate, else the most similar one of at least 0.6."""
    for c in candidates:
        if c in AXLES:
            return c
    best, score = "", 0.0
    for c in candidates:
        for a in sorted(AXLES):
            s = difflib.SequenceMatcher(None, c, a).ratio()
            if s > score:
                best, score = a, s
    return best if score >= 0.6 else ""


def fuzzy_fields(plain_head: Column, make_candidates: Column, axle_candidates: Column, words: Column, makes: list[str], kinds: list[str]) -> Column:
    """struct(tipo_doc, marca, ejes, tipo_carroceria, transmision), one Arrow round trip per batch.

    marca: first candidate that is a make or similar to one (0.8); tipo_carroceria (0.75) and transmision (0.6): terms
    similar to all the text's words taken together, as for texts of a word or two.
    """
    make_terms, kind_terms = tuple(makes), tuple(kinds)

    @F.pandas_udf("tipo_doc string, marca string, ejes string, tipo_carroceria string, transmision string")
    def run(head: pd.Series, candidates: pd.Series, axles: pd.Series, text: pd.Series) -> pd.DataFrame:
        known = set(make_terms)

        def make(cs) -> str:
            return next((m for c in cs if (m := c if c in known else closest(c, make_terms, 0.8))), "")

        def whole(t: str, terms: tuple[str, ...], cutoff: float) -> str:
            # a text much longer than any term can't be similar to one
            return closest(t, terms, cutoff) if terms and 0 < len(t) <= 4 * max(map(len, terms)) else ""

        return pd.DataFrame({
            "tipo_doc": [document_type_of(h or "") for h in head], "marca": [make(c) if c is not None else "" for c in candidates],
            "ejes": [axles_of(list(a)) if a is not None and len(a) else "" for a in axles],
            "tipo_carroceria": [whole(t or "", kind_terms, 0.75) for t in text], "transmision": [whole(t or "", ("MANUAL", "AUTOMATICA"), 0.6) for t in text],
        })

    return run(plain_head, make_candidates, axle_candidates, words)
