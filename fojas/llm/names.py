"""Spellings of names that mean the same person or firm (problem 3).

Distinct strings are parsed into parts (persons: given names and surnames; firms: trade, own words, legal form). Strings
with equal parts are one class. The distinct words that distinguish names (surnames, own words, given names that are not
common) are banded by MinHashes over their padded q-grams, the number of bands following from the collision curve; words
that share a band in a context that both occur in (a given name's initial, a firm's trade) and are similar are twins. Classes are candidates if all of their leading words are twins and the other
parts (given name or initial, trade, legal form) can be the same: an equi-join on composite keys, so that a surname that
a third of all names has is no bucket of all pairs. A pair is verified by Monge-Elkan similarity of its parts, and the
verified links are cut into stars around the most complete spellings.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fojas.functions.reading import ACCENTED, PLAIN, canonical_field
from fojas.llm.misread import skeleton_text
from fojas.session import cut, read_table, shuffled, spread

# Familiar forms of Spanish given names.
NICKNAMES = {
    "BETTY": "BEATRIZ", "BEA": "BEATRIZ", "CHARO": "ROSARIO", "CHAYO": "ROSARIO", "CHECHO": "SERGIO", "CHELA": "GRACIELA", "CHENTE": "VICENTE",
    "CHENCHO": "VICENTE", "CONCHITA": "CONCEPCION", "CONCHA": "CONCEPCION", "CONI": "CONCEPCION", "FENA": "FERNANDA", "FER": "FERNANDA", "NANDA": "FERNANDA", "LALO": "EDUARDO",
    "LOLA": "DOLORES", "LOLITA": "DOLORES", "MANOLO": "MANUEL", "MANU": "MANUEL", "LOLO": "MANUEL", "MARUJA": "MARIA", "MARI": "MARIA", "MARICA": "MARIA",
    "NACHO": "IGNACIO", "PANCHO": "FRANCISCO", "PACO": "FRANCISCO", "KIKO": "FRANCISCO", "CURRO": "FRANCISCO", "PEPE": "JOSE", "PEPITO": "JOSE", "CHEPE": "JOSE",
    "PATO": "PATRICIO", "TITIN": "HECTOR", "BETO": "ALBERTO", "TITO": "ROBERTO", "YOLI": "YOLANDA", "YOLA": "YOLANDA", "QUIQUE": "ENRIQUE", "KIKE": "ENRIQUE",
    "MEMO": "GUILLERMO", "GUILLE": "GUILLERMO", "WILLY": "GUILLERMO", "DANI": "DANIEL", "LUCHO": "LUIS", "LUCHITO": "LUIS", "TERE": "TERESA", "TETE": "TERESA",
    "JANA": "ALEJANDRA", "ALE": "ALEJANDRA", "JANI": "ALEJANDRA", "XIME": "XIMENA", "CLAUDI": "CLAUDIA", "NORMI": "NORMA", "JULI": "JULIA", "ROBER": "ROBERTO", "TOTI": "ROBERTO",
    "TITA": "NORMA", "CHIMENA": "XIMENA", "TOR": "HECTOR", "HECTITO": "HECTOR", "TOÑO": "ANTONIO", "CARLITOS": "CARLOS", "CHARLY": "CARLOS", "ROSI": "ROSA", "ANITA": "ANA",
}
# Trades that open a firm's name, with short forms that aren't their beginnings.
TRADES = {
    "AGRICOLA": [], "AUTOMOTRIZ": ["AUTOMOTORA"], "COMERCIAL": ["CIAL"], "CONSTRUCTORA": ["CTRA"], "DISTRIBUIDORA": [], "FORESTAL": [], "IMPORTADORA": [], "INDUSTRIAL": [],
    "INMOBILIARIA": [], "INVERSIONES": [], "MAQUINARIAS": [], "SERVICIOS": [], "SOCIEDAD": [], "TRANSPORTES": ["TTES", "TPTES"],
}
# Legal forms as they are written, without points and blanks.
LEGAL = {"SA": "SA", "SOCIEDADANONIMA": "SA", "SPA": "SPA", "LTDA": "LTDA", "LIMITADA": "LTDA", "LTD": "LTDA", "EIRL": "EIRL"}
NAME_FIELDS = ["nombre_proveedor", "nombre_comprador"]
Q, ROWS = 3, 4
#: Similarity of two words' q-gram sets (about one edit) at which they must meet with the given probability; unchanged words always meet.
MUST_MEET, RECALL = 0.55, 0.9
_FOLD = str.maketrans(ACCENTED, PLAIN)
_PRIME = (1 << 61) - 1


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """Fewest bands whose collision curve 1-(1-s^rows)^bands reaches recall at the similarity."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


@lru_cache(maxsize=500_000)
def edits(a: str, b: str, most: int = 3) -> int:
    """Optimal string alignment distance, or most+1 beyond it."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y))
            if before and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return row[-1]


@lru_cache(maxsize=500_000)
def word_similarity(a: str, b: str) -> float:
    """1 less the share of edits, on the spellings or their skeletons, whichever is nearer."""
    if a == b:
        return 1.0
    if skeleton_text(a) == skeleton_text(b):
        return 0.98
    n = max(len(a), len(b))
    most = 1 if n < 5 else 2 if n < 9 else 3
    d = min(edits(a, b, most), edits(skeleton_text(a), skeleton_text(b), most))
    return 1.0 - d / n if d <= most else 0.0


def monge_elkan(a: list[str], b: list[str]) -> float:
    """Mean over the words of the shorter list of the best similarity in the other list, each word of which is used once."""
    if not a or not b:
        return 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    free, total = list(long), 0.0
    for w in short:
        best = max(free, key=lambda x: word_similarity(w, x))
        total += word_similarity(w, best)
        free.remove(best)
    return total / len(short)


class Parser:
    """Splits names into parts, given the set of given names."""

    def __init__(self, given: set[str]):
        self.given = given | set(NICKNAMES.values())
        self.by_skeleton = {skeleton_text(g): g for g in self.given}
        self.cache: dict[str, tuple] = {}

    def given_name(self, w: str) -> str | None:
        if w in NICKNAMES:
            return NICKNAMES[w]
        if w in self.given:
            return w
        if (s := skeleton_text(w)) in self.by_skeleton:
            return self.by_skeleton[s]
        if len(w) >= 4:
            near = sorted((edits(w, g, 2), g) for g in self.given if abs(len(g) - len(w)) <= 2 and (g[0] == w[0] or g[-1] == w[-1]))
            if near and near[0][0] <= (1 if len(w) < 7 else 2):
                return near[0][1]
        return None

    def trade(self, w: str) -> str | None:
        for t, other in TRADES.items():
            if w in other or (len(w) >= 3 and t.startswith(w)) or (len(w) >= 6 and edits(w, t, 2) <= 2) or skeleton_text(w) == skeleton_text(t):
                return t
        return None

    def parts(self, name: str) -> tuple:
        """('F', trade, own words, legal form) or ('P', given names, surnames); initials are single letters."""
        if name not in self.cache:
            if len(self.cache) > 200_000:
                self.cache.clear()
            self.cache[name] = self._parts(name)
        return self.cache[name]

    def _parts(self, name: str) -> tuple:
        t = re.sub(r"\s+", " ", name.upper().translate(_FOLD)).strip()
        legal = ""
        # the legal form is at the end, or before a comma's inverted part
        m = re.search(r"[ ,](SOCIEDAD ANONIMA|S\.? ?P\.? ?A|S\.? ?A|E\.? ?I\.? ?R\.? ?L|LTDA?|LIMITADA)\.?$", t)
        if m:
            legal, t = LEGAL[re.sub(r"[. ]", "", m[1])], t[: m.start()]
        elif (last := t.rsplit(" ", 1)) and len(last) == 2 and len(last[1]) >= 6 and (edits(last[1], "LIMITADA", 2) <= 2 or skeleton_text("LIMITADA") == skeleton_text(last[1])):
            legal, t = "LTDA", last[0]
        head, comma, tail = t.partition(",")
        words = [w for w in re.split(r"[^A-Z0-9€+|]+", t) if w]
        trades = [(i, self.trade(w)) for i, w in enumerate(words)]
        named = [(i, x) for i, x in trades if x]
        if legal or (named and named[0][0] == 0 and len(words) > 1 and not self.given_name(words[0])):
            trade = named[0][1] if named and (named[0][0] == 0 or comma) else ""
            own = [w for i, w in enumerate(words) if not (trade and i == named[0][0])]
            return ("F", trade, tuple(own), legal)
        if comma:
            before = [w for w in re.split(r"[^A-Z0-9€+|]+", head) if w]
            after = [w for w in re.split(r"[^A-Z0-9€+|]+", tail) if w]
            return ("P", tuple(self.given_name(w) or w for w in after), tuple(before))
        firsts, lasts = [], []
        for w in words:
            g = self.given_name(w) if len(w) > 1 else None
            if g and len(firsts) < 3:
                firsts.append(g)
            elif len(w) == 1 and not lasts:
                firsts.append(w)
            else:
                lasts.append(w)
        return ("P", tuple(firsts), tuple(lasts))

    def readings(self, p: tuple) -> list[tuple[tuple[str, ...], tuple[str, ...]]]:
        """(given names, surnames) that a person's parts may be: one if a given name was recognised, else the usual orders of the words."""
        if p[1]:
            return [(p[1], p[2])] if p[2] else []
        w = p[2]
        n = len(w)
        if n < 2:
            return []
        if n == 2:
            return [(w[:1], w[1:]), (w[1:], w[:1])]
        return list(dict.fromkeys([(w[:1], w[1:]), (w[: n - 2], w[n - 2 :]), (w[n - 1 :], w[: n - 1]), (w[2:], w[:2])]))

    def keys(self, name: str) -> tuple[list[list[str]], list[list[str]]]:
        """(sought, offered): composite keys [prefix, word, ...] of a name. Two names that may be one share a sought and an offered key up to twins of the words, one way round or the other."""
        p = self.parts(name)
        return self.firm_keys(p) if p[0] == "F" else self.person_keys(p)

    @staticmethod
    def firm_keys(p: tuple) -> tuple[list[list[str]], list[list[str]]]:
        """Own words two and two (the sought side its first two, the offered side any two), one by itself, or all run together; trade and legal form may be missing on either side."""
        trade, own, legal = p[1], list(dict.fromkeys(p[2])), p[3]
        mine = [["2", *sorted(own[:2])]] if len(p[2]) > 1 and len(own) > 1 else [["1", *own[:1]]]
        theirs = [["2", *sorted(c)] for c in combinations(own, 2)] if len(p[2]) > 1 and len(own) > 1 else [["1", w] for w in own[:1]]
        run = ["J", "".join(p[2])] if own else []
        mine, theirs = mine + ([run] if run else []), theirs + ([run] if run else [])
        seek = [(t, x) for t in ([trade, "-"] if trade else ["*"]) for x in ([legal, "-"] if legal else ["*"])]
        give = [(t, x) for t in (trade or "-", "*") for x in (legal or "-", "*")]
        sides = []
        for places, words in ((seek, mine), (give, theirs)):
            sides.append([[f"F|{t}|{x}|{w[0]}", *w[1:]] for t, x in places for w in words if len(w) > 1])
        return sides[0], sides[1]

    def person_keys(self, p: tuple) -> tuple[list[list[str]], list[list[str]]]:
        """Given name and both surnames, or as many as there are. A full given name is sought among equal ones (a rare one among its twins), an initial among all that begin with it."""
        sought, offered = [], []
        for g, s in self.readings(p):
            first, full = g[0], len(g[0]) > 1
            if len(s) > 1 and len(s[0]) == 1:
                shapes = seek = [["2d", s[1]]]
            elif len(s) > 1 and len(s[1]) == 1:
                shapes = [["2i" + s[1], s[0]], ["2of", s[0]]]
                seek = [["2i" + s[1], s[0]], ["2f" + s[1], s[0]]]
            elif len(s) > 1:
                shapes = [["2", s[0], s[1]], ["2of", s[0]], ["2f" + s[1][0], s[0]], ["2d", s[1]]]
                seek = [["2", s[0], s[1]]]
            else:
                shapes, seek = [["1", s[0]]], [["1", s[0]], ["2of", s[0]]]
            if len(s) > 1 and not full:
                # one with an initial may have more surnames than one with a full given name
                seek = [*seek, ["1", s[0]], *([["2i" + s[1][0], s[0]]] if len(s[1]) > 1 else [])]
            if len(s) != 1 or len(s[0]) > 6:
                shapes, seek = [*shapes, ["J", "".join(s)]], [*seek, ["J", "".join(s)]]
            mark = "=" if full else "~"
            rare = full and first not in self.given
            for w in seek:
                sought.append([f"P{mark}|{w[0]}", *w[1:], first] if rare else [f"P{mark}{first}|{w[0]}", *w[1:]])
            for w in shapes:
                offered += [[f"P~{first[0]}|{w[0]}", *w[1:]]]
                if full:
                    offered += [[f"P={first}|{w[0]}", *w[1:]], [f"P=|{w[0]}", *w[1:], first]]
        return ([list(x) for x in dict.fromkeys(map(tuple, sought))], [list(x) for x in dict.fromkeys(map(tuple, offered))])

    def similarity(self, a: str, b: str) -> float:
        """Monge-Elkan similarity of the parts; 0 if some part speaks against one party."""
        p, q = self.parts(a), self.parts(b)
        if p[0] != q[0]:
            return 0.0
        if p[0] == "F":
            if p[1] and q[1] and p[1] != q[1]:
                return 0.0
            if p[3] and q[3] and p[3] != q[3]:
                return 0.0
            if not (p[3] and q[3]) and not (p[1] and q[1]):
                return 0.0
            x, y = list(p[2]), list(q[2])
            whole = word_similarity("".join(x), "".join(y))
            if len(x) != len(y):
                return whole if whole >= 0.85 else 0.0
            s = monge_elkan(x, y)
            least = min((max(word_similarity(u, v) for v in y) for u in x), default=0.0)
            s = max(s if least >= 0.6 else 0.0, whole if whole >= 0.9 else 0.0)
            return s - (0.05 if not (p[1] and q[1]) else 0.0)
        return self.person(p, q)

    @staticmethod
    def fit(u: str, v: str) -> float:
        """Similarity of two words of which either may be an initial."""
        if len(u) == 1 or len(v) == 1:
            return 0.85 if u[0] == v[0] else 0.0
        return word_similarity(u, v)

    @staticmethod
    def gendered(u: str, v: str) -> bool:
        """Whether two words differ by a last A or O only: names of two persons, not a misspelling."""
        return {u[-1], v[-1]} == {"A", "O"} and u[:-1] == v[:-1]

    def same_given(self, g: str, h: str) -> float:
        """Likeness of two given names: common ones must be equal, a rare one may be misread, either may be an initial."""
        if g == h:
            return 1.0
        if len(g) == 1 or len(h) == 1:
            return 0.85 if g[0] == h[0] else 0.0
        if (g in self.given and h in self.given) or self.gendered(g, h):
            return 0.0
        s = word_similarity(g, h)
        return s if s >= 0.75 else 0.0

    def person(self, p: tuple, q: tuple) -> float:
        """Best similarity of the readings of two persons' names."""
        if p == q:
            return 1.0
        if not p[1] and not q[1] and any(self.gendered(u, v) for u in p[2] for v in q[2]):
            return 0.0
        return max((self.persons(g, s, h, t) for g, s in self.readings(p) for h, t in self.readings(q)), default=0.0)

    def persons(self, g: tuple, s: tuple, h: tuple, t: tuple) -> float:
        last = self.fit(s[0], t[0])
        full = sum(len(a) > 1 and len(b) > 1 for a, b in zip(s, t))
        if last < 0.6 or not full:
            joined = word_similarity("".join(s), "".join(t)) if len(s) != len(t) else 0.0
            if joined < 0.85:
                return 0.0
            last = joined
        elif len(s) > 1 and len(t) > 1:
            second = self.fit(s[1], t[1])
            if second < 0.6:
                return 0.0
            last = (last + second) / 2
        else:
            last -= 0.1
        first = self.same_given(g[0], h[0])
        if not first:
            return 0.0
        if len(g) > 1 and len(h) > 1:
            other = self.same_given(g[1], h[1])
            if not other:
                return 0.0
            first = (first + other) / 2
        elif len(g) != len(h):
            first -= 0.1
        return (first + last) / 2

    def completeness(self, name: str) -> float:
        """Full words count whole, initials a quarter; signs that no letter is count against."""
        p = self.parts(name)
        words = [*p[1], *p[2]] if p[0] == "P" else [*([p[1]] if p[1] else []), *p[2]]
        return sum(1.0 if len(w) > 1 else 0.25 for w in words if w) - 0.5 * len(re.findall(r"[0-9€+|]", name))


def qgrams(words: list[str], q: int = Q) -> set[str]:
    """Padded q-grams of the skeleton of each word, so that order doesn't matter."""
    out = set()
    for w in words:
        s = "#" * (q - 1) + skeleton_text(w) + "#" * (q - 1)
        out |= {s[i : i + q] for i in range(len(s) - q + 1)}
    return out


def letters_mask(w: str) -> int:
    """A signed 64-bit set of a word's letters, repeated ones counted up to twice: one edit changes at most two bits, a swap of neighbours none."""
    seen: dict[str, int] = {}
    bits = 0
    for c in w:
        n = seen[c] = seen.get(c, -1) + 1
        bits |= 1 << (2 * (ord(c) - 65) + n if "A" <= c <= "Z" and n < 2 else 52 + (ord(c) + n) % 12)
    return bits - (1 << 64) if bits >> 63 else bits


class MinHasher:
    def __init__(self, bands: int, rows: int = ROWS, seed: int = 13):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(1, 1 << 31, bands * rows, dtype=np.uint64)
        self.b = rng.integers(0, 1 << 31, bands * rows, dtype=np.uint64)
        self.bands, self.rows = bands, rows

    def keys(self, grams: set[str]) -> list[int]:
        """One key per band."""
        h = np.fromiter((zlib.crc32(g.encode()) for g in grams), np.uint64, len(grams))
        low = ((h[:, None] * self.a + self.b) % np.uint64(4294967291)).min(axis=0).reshape(self.bands, self.rows)
        return [int(zlib.crc32(r.tobytes(), k)) for k, r in enumerate(low)]


def given_names(names: DataFrame, share: float = 0.004) -> set[str]:
    """Common given names: words that open a name or stand before its last two words in at least this share of the distinct names without legal form, so at most 3/share. Names with others are compared by their words' twins."""
    plain = F.translate(F.upper("nombre"), ACCENTED, PLAIN)
    firm = plain.rlike(r"[ ,](S\.? ?P\.? ?A|S\.? ?A|E\.? ?I\.? ?R\.? ?L|LTDA?|LIMITADA|ANONIMA)\.?\s*$")
    people = names.where(~firm & ~plain.rlike(",")).select(F.split(plain, " ").alias("w")).where(F.size("w").between(3, 4)).select(F.slice("w", 1, F.size("w") - 2).alias("w"))
    total = people.count()
    counted = people.select(F.explode("w").alias("w")).where(F.length("w") > 2).groupBy("w").agg(F.count("*").alias("n"))
    return {r["w"] for r in counted.where((F.col("n") >= 3) & (F.col("n") >= total * share)).collect()}


def stars(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(key, center): nodes (key, rank) cut into stars. edges (a, b, s), each link once.

    A node none of whose undecided neighbours has a higher rank becomes a centre and its undecided neighbours its
    satellites; this is repeated until all are decided, which each round brings nearer, as the highest open rank
    always is decided. Then each satellite goes to its most similar centre. Each round is a join of what is still
    undecided, cut by a checkpoint.
    """
    both = cut(edges.select("a", "b", "s").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "s")))
    ranked = nodes.select("key", "rank")
    links = cut(both.join(ranked.select(F.col("key").alias("a"), F.col("rank").alias("ra")), "a").join(ranked.select(F.col("key").alias("b"), F.col("rank").alias("rb")), "b"))
    open_, centers = links, None
    while True:
        best = open_.groupBy("a").agg(F.max(F.struct(F.col("rb").alias("r"), F.col("b").alias("k"))).alias("top"), F.first("ra").alias("ra"))
        fresh = cut(best.where(F.struct(F.col("ra").alias("r"), F.col("a").alias("k")) > F.col("top")).select(F.col("a").alias("key")))
        centers = fresh if centers is None else centers.union(fresh)
        # satellites and centres leave; nodes left without open neighbours become centres below
        taken = fresh.union(open_.join(fresh.withColumnRenamed("key", "b"), "b", "left_semi").select(F.col("a").alias("key"))).distinct()
        taken = cut(taken)
        open_ = cut(open_.join(taken.withColumnRenamed("key", "a"), "a", "left_anti").join(taken.withColumnRenamed("key", "b"), "b", "left_anti"))
        if open_.isEmpty():
            break
    near = links.join(centers.withColumnRenamed("key", "b"), "b", "left_semi").join(centers.withColumnRenamed("key", "a"), "a", "left_anti")
    chosen = near.groupBy(F.col("a").alias("key")).agg(F.max_by("b", F.struct("s", "rb", "b")).alias("center"))
    return nodes.select("key").join(chosen, "key", "left").select("key", F.coalesce("center", "key").alias("center"))


def contexts(keys: DataFrame) -> DataFrame:
    """(w, k, seek, offer): the distinct words of keys (seek, h, a, b, c) with the contexts in which they are sought or offered.

    A context follows from h and the word's place: a firm's trade, or the given name's initial and which part the word is
    (all shapes of a key together, the two places of a firm's pair together). Words of one h and place share it.
    """
    shape, place = F.substring_index("h", "|", -1), F.col("p.place")
    part = F.when(place == 0, F.when(shape == "J", "J").when(shape == "2d", "1").otherwise("0")).when((place == 1) & (shape == "2"), "1").otherwise("g")
    k = F.when(F.startswith("h", F.lit("F|")), F.concat(F.split("h", r"\|")[1], F.when(shape == "J", "|FJ").otherwise("|F"))).otherwise(F.concat(F.substring("h", 3, 1), F.lit("|P"), part))
    words = keys.select("seek", "h", F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.col(x).alias("w")) for i, x in enumerate("abc")])).alias("p"))
    return words.where("p.w <> ''").groupBy("p.w", k.alias("k")).agg(F.max("seek").alias("seek"), F.max(~F.col("seek")).alias("offer"))


def twins(words: DataFrame, hasher: MinHasher, least: float = 0.6) -> DataFrame:
    """(w, t): words (w, k, seek, offer) with those similar to them, themselves among them; words that no context k has one sought and the other offered aren't compared.

    Each word is hashed once; a band's bucket holds each spelling of a context once. Without contexts the buckets would
    fill as the words get denser, and the pairs in them grow with the square of the words.
    """

    def banded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sk = [skeleton_text(w) for w in b["w"]]
            forms = {"s": sk, "wo": ["".join(sorted(w)) for w in b["w"]], "so": ["".join(sorted(s)) for s in sk], "wm": [letters_mask(w) for w in b["w"]], "sm": [letters_mask(s) for s in sk]}
            yield b.assign(**forms, hs=[[k * 4_294_967_296 + h for k, h in enumerate(hasher.keys(qgrams([w])))] for w in b["w"]])

    by_word = words.groupBy("w").agg(F.collect_list(F.struct("k", "seek", "offer")).alias("ks")).withColumn("i", F.xxhash64("w"))
    forms = cut(shuffled(by_word).mapInPandas(banded, "w string, ks array<struct<k: string, seek: boolean, offer: boolean>>, i long, s string, wo string, so string, wm long, sm long, hs array<long>"))

    def buckets(side: str) -> DataFrame:
        rows = forms.select("i", F.expr(f"transform(filter(ks, x -> x.{side}), x -> xxhash64(x.k))").alias("ks"), "hs").where(F.size("ks") > 0)
        return rows.select("i", F.explode("ks").alias("k"), "hs").select("i", "k", F.explode("hs").alias("h")).select("i", F.xxhash64("h", "k").alias("h"))

    met = buckets("seek").join(buckets("offer").withColumnRenamed("i", "j"), "h").where("i <> j").select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).distinct()
    # as many edits as word_similarity allows; a swap of neighbours is two of these edits, and leaves the letters the same
    can = []
    # most that share a band differ in more letters than the edits allow; that is seen from their masks
    longest = "greatest(length(x.w), length(y.w), length(x.s), length(y.s))"
    bits = f"CASE WHEN {longest} < 5 THEN 2 WHEN {longest} < 9 THEN 4 ELSE 6 END"
    masks = f"least(bit_count(x.wm ^ y.wm), bit_count(x.sm ^ y.sm)) <= {bits}"
    for c, o in (("w", "wo"), ("s", "so")):
        most = f"CASE WHEN greatest(length(x.{c}), length(y.{c})) < 5 THEN 1 WHEN greatest(length(x.{c}), length(y.{c})) < 9 THEN 2 ELSE 3 END"
        d = f"levenshtein(x.{c}, y.{c}, 2 * {most})"
        can.append(f"(abs(length(x.{c}) - length(y.{c})) <= {most} and {d} >= 0 and ({d} <= {most} or levenshtein(x.{o}, y.{o}, 2 * (2 * {most} - {d})) >= 0))")
    form = forms.select("i", "w", "s", "wo", "so", "wm", "sm")
    near = met.alias("m").join(form.alias("x"), F.expr("m.i = x.i")).join(form.alias("y"), F.expr(f"m.j = y.i and {masks} and ({' or '.join(can)})")).select(F.col("x.w").alias("w"), F.col("y.w").alias("t"))

    def similar(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[[word_similarity(x, y) >= least for x, y in zip(b["w"], b["t"])]]

    close = cut(shuffled(near).mapInPandas(similar, "w string, t string"))
    return cut(close.union(close.select(F.col("t").alias("w"), F.col("w").alias("t"))).union(forms.select("w", F.col("w").alias("t"))))


def with_twins(sought: DataFrame, offered: DataFrame, like: DataFrame) -> DataFrame:
    """sought (m, h, a, b, c) with each word put as every one of its twins (like) that is offered under the same h in that place.

    Twins grow in number with the words that there are, and so do a key's by the power of its words. Few of them are
    offered beside the same given name or trade: those not offered go before the next word is put.
    """
    # the two words of a firm's pair stand in order, so that either may be in either place
    firm = F.startswith("h", F.lit("F|"))
    places = F.array(*[F.struct(F.when(firm, 0).otherwise(i).alias("place"), F.col(x).alias("w")) for i, x in enumerate("abc")])
    there = cut(offered.select("h", F.explode(places).alias("p")).select("h", "p.place", "p.w").where("w <> ''").distinct())

    def put(keys: DataFrame, i: int, x: str) -> DataFrame:
        as_twin = keys.join(like.select(F.col("w").alias(x), F.col("t").alias("t" + x)), x).drop(x).withColumnRenamed("t" + x, x)
        found = there.withColumnsRenamed({"w": x, "place": "at"})
        return as_twin.withColumn("at", F.when(firm, 0).otherwise(i)).join(found, ["h", "at", x], "left_semi").select("m", "h", "a", "b", "c")

    first = cut(put(sought, 0, "a"))
    two = put(first.where("b <> '' and c = ''"), 1, "b")
    three = put(put(first.where("b <> '' and c <> ''"), 1, "b"), 2, "c")
    swapped = firm & (F.col("b") != "") & (F.col("a") > F.col("b"))
    return first.where("b = ''").union(two).union(three).select("m", "h", F.when(swapped, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swapped, F.col("a")).otherwise(F.col("b")).alias("b"), "c")


def link_names(names: DataFrame, accept: float = 0.8) -> DataFrame:
    """(nombre, parte): every distinct non-blank string of names.nombre with the spelling that stands for its party.

    Null and blank strings drop out; an empty table gives an empty result. Repeated strings count as one.
    """
    texts = cut(names.where(F.trim("nombre") != "").groupBy("nombre").agg(F.count("*").alias("n")))
    parser = Parser(given_names(texts))
    hasher = MinHasher(bands_for(MUST_MEET, RECALL, ROWS))

    def classes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(key=["|".join(" ".join(x) if isinstance(x, tuple) else x for x in parser.parts(t)) for t in b["nombre"]], full=[parser.completeness(t) for t in b["nombre"]])

    keyed = cut(spread(texts).mapInPandas(classes, "nombre string, n long, key string, full double"))
    # the spelling that stands for a class: the most complete, most frequent
    nodes = cut(keyed.groupBy("key").agg(F.max_by("nombre", F.struct("full", "n", "nombre")).alias("name"), F.struct(F.max("full").alias("full"), F.sum("n").alias("n")).alias("rank")))

    def sides(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, seek, k[0], *(k[1:] + [""] * 3)[:3]) for i, t in zip(b["node"], b["name"]) for seek, ks in zip((True, False), parser.keys(t)) for k in ks]
            yield pd.DataFrame(rows, columns=["node", "seek", "h", "a", "b", "c"])

    numbered = cut(nodes.withColumn("node", F.xxhash64("key")))
    keys = cut(spread(numbered.select("node", "name")).mapInPandas(sides, "node long, seek boolean, h string, a string, b string, c string"))
    like = twins(contexts(keys), hasher)
    offered = keys.where("not seek").select(F.col("node").alias("n"), "h", "a", "b", "c")
    sought = with_twins(keys.where("seek").select(F.col("node").alias("m"), "h", "a", "b", "c"), offered, like)
    met = sought.join(offered, ["h", "a", "b", "c"]).where("m <> n")
    pairs = met.select(F.least("m", "n").alias("m"), F.greatest("m", "n").alias("n")).distinct()
    named = numbered.select("node", "key", "name")
    pairs = pairs.join(named.select(F.col("node").alias("m"), F.col("key").alias("a"), F.col("name").alias("p")), "m").join(named.select(F.col("node").alias("n"), F.col("key").alias("b"), F.col("name").alias("q")), "n")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = np.array([parser.similarity(p, q) for p, q in zip(b["p"], b["q"])])
            yield b.assign(s=s)[s >= accept][["a", "b", "s"]]

    edges = cut(shuffled(pairs.select("a", "b", "p", "q")).mapInPandas(verify, "a string, b string, s double"))
    star = stars(nodes, edges)
    named = star.join(nodes.select(F.col("key").alias("center"), F.col("name").alias("parte")), "center")
    return keyed.join(named, "key").select("nombre", "parte")


def p3_parties(spark, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "campos").where(canonical_field(F.col("campo")).isin(NAME_FIELDS)).select(F.col("valor").alias("nombre"))
    return link_names(rows)


def p3_found(spark, folder: str) -> DataFrame:
    """All pairs of spellings of a party, as the query's columns ask; the parties themselves are p3_parties."""
    linked = cut(p3_parties(spark, folder))
    other = linked.select("parte", F.col("nombre").alias("nombre_b"))
    return linked.withColumnRenamed("nombre", "nombre_a").join(other, "parte").where("nombre_a < nombre_b").select("nombre_a", "nombre_b")
