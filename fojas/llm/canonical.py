"""Freely typed values mapped to the entries of a reference list (problem 7).

The entries and their alias paths (words joined, reordered, abbreviated, misread) are laid in a trie that is searched
with a Levenshtein automaton: a state is the row of edit distances of the text's prefixes to the path so far, and a
branch is left as soon as no distance in its row is allowed. The allowed distance grows with the text's length.

All entries found come out, each with its cost: the edits, plus 0.2 for joined and 0.3 for reordered or abbreviated words,
0.4 for skeletons. Looked up besides, in this order: skeletons, if the text holds digits or nothing was near; entries that
the text (three letters or more) is the beginning of, at 0.5 and 0.1 per missing letter; and, for a text of four letters
that nothing was found for, entries within two edits. The cheapest entry is the one meant, of several the one of nearest
length, then the smaller; these are marked as ambiguous.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fojas.functions.reading import ACCENTED, PLAIN, canonical_field, strip_space
from fojas.functions.text import rx
from fojas.llm.misread import skeleton_text
from fojas.session import cut, read_table

# Abbreviations in use for words of colours, places and makes.
ABBREVIATIONS = {
    "AZUL": ["AZ"], "AMARILLO": ["AMLLO", "AM"], "BLANCO": ["BCO", "BLCO", "BL"], "CELESTE": ["CEL"], "DORADO": ["DOR"], "GRIS": ["GR", "GRS"],
    "NEGRO": ["NGO", "NEG"], "NARANJO": ["NJO", "NAR"], "PLATEADO": ["PLAT", "PLTDO"], "ROJO": ["RJO", "RO"], "VERDE": ["VDE", "VD"], "BEIGE": ["BGE"],
    "SANTA": ["STA"], "SANTO": ["STO"], "SAN": ["S"], "PUERTO": ["PTO"], "VILLA": ["V", "VA"], "ALTO": ["ATO", "A"], "LOS": ["L"],
    "INDUSTRIAL": ["IND", "INDUST"], "AGRICOLA": ["AGR", "AGRIC"], "DIESEL": ["DSL", "DSEL"], "MOTORS": ["MTRS", "MOT", "MTS"], "TRUCKS": ["TRKS", "TRK"],
}
# Labels that stand before or after a value on the sheets.
LABELS_BEFORE = r"^(?:COLOR|COL|MARCA|COMUNA DE|COMUNA)\b[.: ]*"
LABELS_AFTER = r"(?:[ /]+(?:COMBUSTIBLE|ANO|ANIO|MODELO|CHASIS|MOTOR|CIUDAD|REGION|FONO|COLOR|MARCA|COMUNA|SERIE|VIN))+$"
#: Most entries of one trie; of a longer list several are built, one after the other.
MOST_ENTRIES = 200_000
#: Tasks over which the rows of one value are spread.
SALTS = 8

_FOLD = str.maketrans(ACCENTED, PLAIN)


def tidy(text: str) -> str:
    """Upper case without accents, quotes, labels and punctuation; letters set apart are joined again."""
    t = text.upper().translate(_FOLD)
    t = re.sub(r"[\"'()\[\]]", " ", t)
    t = re.sub(r"\s+", " ", t.replace("-", " ")).strip(" ./,:;")
    t = re.sub(LABELS_AFTER, "", re.sub(LABELS_BEFORE, "", t)).strip(" ./,:;")
    t = re.sub(r"[.,;:]+ ?", " ", t).strip()
    words = t.split(" ")
    return "".join(words) if len(words) >= 3 and all(len(w) == 1 for w in words) else t


def tidied(c: Column) -> Column:
    """The same as a column expression."""
    t = F.regexp_replace(F.translate(F.upper(c), ACCENTED, PLAIN), r"[\"'()\[\]]", " ")
    t = F.regexp_replace(F.regexp_replace(F.replace(t, F.lit("-"), F.lit(" ")), rx(r"\s+"), " "), r"^[ ./,:;]+|[ ./,:;]+$", "")
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, rx(LABELS_BEFORE), ""), LABELS_AFTER, ""), r"^[ ./,:;]+|[ ./,:;]+$", "")
    t = F.trim(F.regexp_replace(t, r"[.,;:]+ ?", " "))
    return F.when(t.rlike(r"^[^ ]( [^ ]){2,}$"), F.replace(t, F.lit(" "), F.lit(""))).otherwise(t)


def allowed(length: int) -> int:
    """Edits allowed for a text of so many characters."""
    return 0 if length < 3 else 1 if length < 5 else 2 if length < 12 else 3


def alias_paths(entry: str) -> Iterator[tuple[str, float]]:
    """(path, cost) of an entry: itself, its words joined, reordered or abbreviated."""
    yield entry, 0.0
    words = entry.split(" ")
    if len(words) > 1:
        yield "".join(words), 0.2
        if len(words) <= 4:
            for p in permutations(words):
                if list(p) != words:
                    yield " ".join(p), 0.3
    for i, w in enumerate(words):
        for short in ABBREVIATIONS.get(w, []):
            if len(words) > 1 or len(short) > 2:
                yield " ".join([*words[:i], short, *words[i + 1 :]]), 0.3


class Trie:
    """Nodes are dicts from a letter to a node; under "" the (entry, cost) pairs of paths that end there."""

    def __init__(self, entries: list[str]):
        self.entries = set(entries)
        self.root: dict = {}
        self.shapes: dict[str, list[str]] = {}
        for e in entries:
            for path, cost in alias_paths(e.upper().translate(_FOLD)):
                node = self.root
                for ch in path:
                    node = node.setdefault(ch, {})
                node.setdefault("", []).append((e, cost))
            for path in {e, e.replace(" ", "")}:
                self.shapes.setdefault(skeleton_text(path), []).append(e)
        self.bones: dict = {}
        for s, es in self.shapes.items():
            node = self.bones
            for ch in s:
                node = node.setdefault(ch, {})
            node.setdefault("", []).extend((e, 0.4) for e in es)

    @staticmethod
    def search(root: dict, text: str, most: int) -> list[tuple[float, str]]:
        """(distance plus cost, entry) of all entries with a path within so many edits (insert, delete, replace, swap of neighbours)."""
        n, out = len(text), []
        start = list(range(n + 1))
        todo = [(root, "", start, None)]
        while todo:
            node, came, row, before = todo.pop()
            if "" in node and row[n] <= most:
                out += [(row[n] + cost, e) for e, cost in node[""]]
            for ch, child in node.items():
                if not ch:
                    continue
                new = [row[0] + 1]
                for j in range(1, n + 1):
                    d = min(new[j - 1] + 1, row[j] + 1, row[j - 1] + (text[j - 1] != ch))
                    if before is not None and j > 1 and text[j - 1] == came and text[j - 2] == ch:
                        d = min(d, before[j - 2] + 1)
                    new.append(d)
                if min(new) <= most:
                    todo.append((child, ch, new, row))
        return out

    def below(self, text: str) -> list[tuple[float, str]]:
        """Entries that text is the beginning of, dearer the more is missing."""
        node = self.root
        for ch in text:
            if ch not in node:
                return []
            node = node[ch]
        found, todo = [], [(node, 0)]
        while todo:
            node, depth = todo.pop()
            found += [(0.5 + 0.1 * depth, e) for e, cost in node.get("", []) if cost == 0.0]
            todo += [(child, depth + 1) for ch, child in node.items() if ch]
        return found

    def candidates(self, value: str) -> list[tuple[float, str]]:
        """Entries for a value, best first: (cost, entry), each entry once."""
        text = tidy(value)
        if not text:
            return []
        most = allowed(len(text))
        found = self.search(self.root, text, most)
        if re.search(r"[0-9€+|]", text) or not found:
            bone = skeleton_text(text)
            found += self.search(self.bones, bone, min(1, allowed(len(bone))))
        if len(text) >= 3:
            found += self.below(text)
        if len(text) == 4 and not found:
            found = self.search(self.root, text, 2)
        best: dict[str, float] = {}
        for c, e in found:
            best[e] = min(c, best.get(e, 99.0))
        return sorted((c, e) for e, c in best.items())


ENTRIES = "array<struct<entrada: string, distancia: double>>"


def candidate_entries(rows: DataFrame, entries: dict[str, list[str]]) -> DataFrame:
    """rows (..., campo, valor) with entradas: the entries of the field's list within the allowed distance, cheapest first. Every task looks each distinct value up once."""
    sent = rows.sparkSession.sparkContext.broadcast(entries)
    fields = rows.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tries = {k: Trie(v) for k, v in sent.value.items()}
        seen: dict[tuple[str, str], list[dict]] = {}
        for b in batches:
            out = []
            for key in zip(b["campo"], b["valor"]):
                if key not in seen:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen[key] = [{"entrada": e, "distancia": c} for c, e in (tries[key[0]].candidates(key[1]) if key[0] in tries else [])]
                out.append(seen[key])
            yield b[fields].assign(entradas=out)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    # equal values meet in the same tasks, SALTS of them, where each is looked up once
    size = max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salt = F.pmod(F.hash(F.lit(0), *[c for c in fields if c not in ("campo", "valor")]), F.lit(SALTS))
    return rows.repartition(size, "campo", "valor", salt).mapInPandas(run, f"{schema}, entradas {ENTRIES}")


def map_values(rows: DataFrame, entries: dict[str, list[str]], keep: list[str], most_entries: int | None = None) -> DataFrame:
    """(keep, campo, valor, termino, distancia, ambiguo, entradas): rows (keep, campo, valor) with the entry meant ('' if the list has none, distancia -1 then), whether another one is as near, and all entries within the distance.

    One shuffle, by value. Null and blank values drop out; values of fields without
    list and empty lists give ''.
    """
    size = most_entries or MOST_ENTRIES
    kept = rows.where(F.trim(F.regexp_replace("valor", r"[\s ]+", " ")) != "").select(*keep, "campo", "valor")
    parts = max([1, *(-(-len(v) // size) for v in entries.values())])
    if parts == 1:
        found = candidate_entries(kept, entries)
    else:
        numbered = cut(kept.withColumn("fila", F.monotonically_increasing_id()))
        found = None
        for i in range(parts):
            part = candidate_entries(numbered, {k: v[i * size : (i + 1) * size] for k, v in entries.items()})
            found = part if found is None else found.unionByName(part)
        columns = [*keep, "campo", "valor"]
        found = found.groupBy("fila").agg(*[F.first(c).alias(c) for c in columns], F.flatten(F.collect_list("entradas")).alias("entradas"))
        found = found.select(*columns, F.array_sort("entradas", lambda x, y: F.when(x["distancia"] != y["distancia"], F.signum(x["distancia"] - y["distancia"]).cast("int")).when(x["entrada"] < y["entrada"], -1).otherwise(1)).alias("entradas"))
    return found.select(*keep, "campo", "valor", "entradas").transform(chosen)


def chosen(found: DataFrame) -> DataFrame:
    """Adds termino, distancia and ambiguo by entradas."""
    length = F.length(tidied(F.col("valor")))
    near = F.filter("entradas", lambda x: x["distancia"] <= F.get(F.col("entradas"), F.lit(0))["distancia"] + 1e-9)
    best = F.array_min(F.transform(near, lambda x: F.struct(F.abs(F.length(x["entrada"]) - length).alias("d"), x["entrada"].alias("e"))))["e"]
    return found.withColumns({
        "termino": F.coalesce(best, F.lit("")), "distancia": F.coalesce(F.get(F.col("entradas"), F.lit(0))["distancia"], F.lit(-1.0)), "ambiguo": F.size(near) > 1,
    })


def dictionary(spark, folder: str, name: str, column: str) -> list[str]:
    """Entries in upper case without outer blanks, each once: a reference list, read whole."""
    rows = read_table(spark, folder, name).select(F.upper(strip_space(F.col(column))).alias("e")).where("e <> ''").distinct().orderBy("e")
    return [r["e"] for r in rows.collect()]


# Which list holds the entries of a field.
LISTS = {"color": ("diccionario_colores", "color"), "marca": ("diccionario_marcas", "marca"), "comuna_comprador": ("diccionario_comunas", "comuna")}


def p7_mapping(spark, folder: str) -> DataFrame:
    lists = {f: dictionary(spark, folder, *where) for f, where in LISTS.items()}
    rows = read_table(spark, folder, "campos").select(F.col("id").alias("campo_id"), canonical_field(F.col("campo")).alias("campo"), "valor").where(F.col("campo").isin(*LISTS))
    exact = spark.createDataFrame([(f, e) for f, entries in lists.items() for e in entries], "campo string, valor string")
    # the lists are here anyway; those of one trie each are small enough for every task
    exact = F.broadcast(exact) if sum(map(len, lists.values())) <= MOST_ENTRIES else exact
    return map_values(rows.join(exact, ["campo", "valor"], "left_anti"), lists, ["campo_id"])


def p7_found(spark, folder: str) -> DataFrame:
    return p7_mapping(spark, folder).select("campo_id", "termino")
