"""Repair of text read from scanned pages (problem 2).

Lines are labelled by a hidden Markov model over layout features as form field, running text, page furniture or break.
It starts from what each feature by itself suggests and is fitted by forward-backward passes whose counts are summed over
all texts: how states follow one another, what they look like, and which closing words lines of a state have (so that the
running headers of a corpus are learned, not listed). Words parted at line ends are found with a lexicon counted over the
whole corpus, and misread words as rare spellings that a common word turns into under the confusions of recognition.
Paragraphs are then put together again.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fojas.functions.reading import ACCENTED, PLAIN
from fojas.session import cut, read_table, spread

CAMPO, CUERPO, PAGINA, CORTE = range(4)
STATE_NAMES = ["campo", "cuerpo", "pagina", "corte"]
#: Rounds of fitting the line model (few, so that what features by themselves suggest still counts); a line's closing word is told apart if it makes up this share of the lines that can be furniture.
ROUNDS, TAIL_SHARE = 3, 1e-4
#: A word enters the lexicon if it was read so often.
FEWEST = 3
#: So many words of the lexicon are sent to every task; a larger one's rarer words are joined to the texts that hold them.
MOST_WORDS = 1_000_000
_FOLD = str.maketrans(ACCENTED, PLAIN)

# What recognition makes of a letter of running text.
CONFUSIONS = {
    "a": ["4", "@", "o"], "b": ["6", "8"], "c": ["e", "("], "d": ["cl"], "e": ["€", "3", "c"], "g": ["9", "6", "q"], "h": ["li", "b"], "i": ["l", "1", "j", "!"], "l": ["1", "i", "|", "I"],
    "m": ["rn", "nn"], "n": ["ri"], "o": ["0"], "q": ["g", "9"], "r": ["n"], "s": ["5", "$"], "t": ["+", "7", "f"], "u": ["ii", "v", "li"], "v": ["u"], "w": ["vv"], "y": ["v"], "z": ["2"],
    "í": ["l", "1"], "ó": ["0"], "é": ["€"], "á": ["4"], "ú": ["ii"], "ñ": ["n", "fi"],
}
# The confusions that are counted as such even between letters; the others need a sign that no word has.
SURE = {("d", "cl"), ("h", "li"), ("i", "l"), ("m", "rn"), ("u", "ii"), ("u", "li"), ("w", "vv"), ("l", "i"), ("l", "I")}

WORD = r"[a-záéíóúüñA-ZÁÉÍÓÚÜÑ0-9€+$@|!]+"
_WORD = re.compile(WORD)
_LETTERS = "a-záéíóúüñA-ZÁÉÍÓÚÜÑ"
_ODD = re.compile(r"[0-9€+$@|!]")


_BONE_TABLE = str.maketrans({"1": "i", "|": "i", "!": "i", "0": "o", "€": "e", "3": "e", "5": "s", "$": "s", "4": "a", "@": "a", "6": "b", "8": "b", "9": "b", "g": "b", "7": "t", "+": "t", "2": "z"})
# letters read as two are written out, which leaves no choice where strokes overlap ("cli" may be "cli", "di" or "ch")
_WRITTEN_OUT = str.maketrans({"m": "rn", "d": "ci", "h": "ii", "u": "ii", "w": "vv", "l": "i"})


# the three steps in one
_BONE = {c: chr(c).translate(_FOLD).translate(_BONE_TABLE).translate(_WRITTEN_OUT) for c in {*_FOLD, *_BONE_TABLE, *_WRITTEN_OUT}}


def bone(word: str) -> str:
    """Skeleton of a word, equal for a word and its misreadings."""
    return word.lower().translate(_BONE)


def unaccented(text: str) -> str:
    return text if text.isascii() else text.translate(_FOLD)


def misread_of(seen: str, word: str) -> bool:
    """Whether recognition can have turned word into seen, different spelling."""
    a, b = word.lower(), seen
    if a == b.lower():
        return False
    reach = {(0, 0)}
    todo = [(0, 0)]
    while todo:
        i, j = todo.pop()
        if i == len(a):
            if j == len(b):
                return True
            continue
        steps = [a[i], *CONFUSIONS.get(a[i], [])]
        for s in steps:
            piece = b[j : j + len(s)]
            if piece.lower() == s.lower():
                if s != a[i] and (a[i], s) not in SURE and not _ODD.search(s):
                    continue
                nxt = (i + 1, j + len(s))
                if nxt not in reach:
                    reach.add(nxt)
                    todo.append(nxt)
    return False


def pruned(words: list[tuple[int, str]], ratio: float = 0.08) -> list[tuple[int, str]]:
    """(count, word) of one skeleton without the misreadings of commoner ones, the commonest first."""
    kept: list[tuple[int, str]] = []
    for n, w in sorted(words, key=lambda x: (-x[0], x[1])):
        if not any(n < ratio * k and misread_of(w, c) for k, c in kept):
            kept.append((n, w))
    return kept


class Lexicon:
    """Words of running text that the corpus vouches for, by skeleton, and the compounds it writes with a hyphen, by the skeletons of their parts.

    classes: skeleton -> pruned (count, word); that of a compound has a hyphen. A skeleton's words are in one lexicon
    or the other: base is asked for those that this one doesn't have.
    """

    def __init__(self, classes: dict[str, list[tuple[int, str]]], base: Lexicon | None = None):
        self.by_bone = {k: [w for _, w in ws] for k, ws in classes.items() if "-" not in k}
        self.words = {w: n for k, ws in classes.items() if "-" not in k for n, w in ws}
        self.compounds = {w: n for k, ws in classes.items() if "-" in k for n, w in ws}
        self.base = base
        self.cache: dict[str, str | None] = {}
        #: Skeletons that were asked for and aren't here, if they are to be noted.
        self.missing: set[str] | None = None

    @classmethod
    def counted(cls, counts: dict[str, int]) -> Lexicon:
        """From counts of words and compounds."""
        classes: dict[str, list[tuple[int, str]]] = {}
        for w, n in counts.items():
            classes.setdefault(bone_key(w), []).append((n, w))
        return cls({k: pruned(ws) if "-" not in k else ws for k, ws in classes.items()})

    def count(self, w: str) -> int:
        """How often a word was read, 0 for others."""
        return self.words.get(w) or (self.base.words.get(w, 0) if self.base else 0)

    def compound(self, w: str) -> int:
        if self.missing is not None and w not in self.compounds:
            self.missing.add(bone_key(w))
        return self.compounds.get(w) or (self.base.compounds.get(w, 0) if self.base else 0)

    def source(self, seen: str) -> str | None:
        """The word that seen is a misreading of, or None."""
        if seen not in self.cache:
            if len(self.cache) > 300_000:
                self.cache.clear()
            b = bone(seen)
            if self.base and b not in self.by_bone:
                return self.base.source(seen)
            if self.missing is not None and b not in self.by_bone:
                self.missing.add(b)
                return None
            self.cache[seen] = None if self.count(seen.lower()) else next((c for c in self.by_bone.get(b, []) if misread_of(seen, c)), None)
        return self.cache[seen]

    def known(self, word: str) -> str | None:
        """The lexicon's word for a spelling, misread or not."""
        w = word.lower()
        return w if self.count(w) else self.source(word)


def bone_key(word: str) -> str:
    """Skeleton of a word, or of a compound's parts."""
    return "-".join(map(bone, word.split("-")))


def word_counts(texts: DataFrame, column: str) -> DataFrame:
    """(t, n): words and hyphened compounds inside lines of running text, over all rows, read at least FEWEST times."""
    lines = spread(texts.select(column)).select(F.explode(F.split(F.col(column), "\n")).alias("l")).where(F.col("l").rlike(r"(?:^|\s)[a-záéíóúüñ]{2,}\s.*[a-záéíóúüñ]{2,}"))
    marks = ".,;:()[]\"¿?¡"
    words = F.split(F.trim(F.lower(F.translate("l", marks + "\t\u000c", " " * (len(marks) + 2)))), " +")
    tokens = lines.select(words.alias("w")).select(F.explode(F.slice("w", 2, F.greatest(F.size("w") - 2, F.lit(0)))).alias("t"))
    counted = tokens.where(F.length("t") > 0).groupBy("t").agg(F.count("*").alias("n"))
    return counted.where((F.col("n") >= FEWEST) & F.col("t").rlike(rf"^[{_LETTERS}]+(-[{_LETTERS}]+)?$"))


def lexicon_rows(texts: DataFrame, column: str) -> DataFrame:
    """(k, words): per skeleton the pruned (n, t) of its words; the words of one skeleton are few, as they have its length."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(k=[bone_key(t) for t in b["t"]])

    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, [{"n": n, "t": t} for n, t in (pruned(ws) if "-" not in k else ws)]) for k, ws in zip(b["k"], ([(x["n"], x["t"]) for x in ws] for ws in b["words"]))]
            yield pd.DataFrame(rows, columns=["k", "words"])

    grouped = word_counts(texts, column).mapInPandas(keyed, "t string, n long, k string").groupBy("k").agg(F.collect_list(F.struct("n", "t")).alias("words"))
    return grouped.mapInPandas(prune, "k string, words array<struct<n: long, t: string>>")


_PAGE_PLAIN = re.compile(r"^\W*(?:(?:p[aá]g(?:ina)?|hoja|page|folio)\b\W*\d+(?:\W*(?:de|of|[/|])?\W*\d+)?|\d+\s*[|/]\s*\d+|[-–]+\s*\d+\s*[-–]+)\W*$", re.I)
_MONEY = re.compile(r"^\W*[\d.,$€ ]*\d\W*$")
_LABEL = re.compile(r"^[^a-z:]{2,24}(?:\([A-Z]+\))?:|^(?:N°|MONTO|IVA|TOTAL|NETO)\b")
_LOWER = re.compile(r"\b[a-záéíóúüñ][a-záéíóúüñ0-9€+]+")
SHAPES = 10
_DIGITS = re.compile(r"\d+")
_FIELD = re.compile(r"^[^:]{1,20}:")


def page_number(t: str) -> bool:
    if len(t) > 24 or t[-1] == "." or t[:4] == "hoja" or not re.search(r"\d", t):
        return False
    if _PAGE_PLAIN.match(t):
        return True
    # the words of a page number may themselves be misread
    words = re.findall(r"[^\W\d_][^\s.]*|\d+", t)
    return bool(words) and len(words) <= 5 and len(words[0]) >= 3 and bone(words[0]) in _PAGE_BONES and all(re.fullmatch(r"\d+|[dce]\S{0,3}|[|/]", w) for w in words[1:])


_PAGE_BONES = {bone(w) for w in ("pag", "página", "hoja", "page")}


def shape_of(t: str) -> int:
    if not t:
        return 0
    if page_number(t):
        return 1
    if t.isdigit() and len(t) <= 3:
        return 2
    if _MONEY.match(t):
        return 3
    if _LABEL.match(t):
        return 4
    lower = len(_LOWER.findall(t))
    words = len(t.split())
    if lower >= 3 and lower * 2 >= words:
        return 5
    if re.search(r"[|]| - |\(", t):
        return 8
    if lower and lower * 2 >= words:
        return 6
    if t.upper() == t:
        return 7
    return 9


#: Shapes of lines that can be furniture or repeat such a line.
RECURRING = (1, 4, 7, 8, 9)


def masked_line(t: str) -> str:
    """A line without accents and case, its numbers by one sign."""
    return _DIGITS.sub("#", unaccented(t.upper())) if t and len(t) < 90 else ""


@lru_cache(maxsize=200_000)
def facts(t: str) -> tuple[int, str, str, int]:
    """Of a stripped line: shape, and of lines that can be furniture: digits masked, skeleton, number of the closing word (0 for others)."""
    shape = shape_of(t)
    if shape not in RECURRING:
        return shape, "", "", 0
    loose = shape in (7, 8, 9) and len(t) < 110
    return shape, masked_line(t), bone(t) if loose else "", zlib.crc32(closing(t).encode()) or 1 if loose else 0


@lru_cache(maxsize=50_000)
def heading(t: str) -> tuple[str, str] | None:
    """Digits masked and skeleton of a line that can head a page."""
    return (masked_line(t), bone(t)) if len(t) > 6 and not _FIELD.match(t) else None


def closing(t: str) -> str:
    """Skeleton of a line's last word, a number behind it by one sign."""
    words = t.split()
    number = ""
    while words and not re.search(r"[^\W\d_]{3}", words[-1]):
        number = "#" if number or re.search(r"\d", words[-1]) else ""
        words.pop()
    return (bone(words[-1].strip(".,:;")) if words else "") + number


def line_features(lines: list[str]) -> tuple[list[int], list[int]]:
    """Per line one symbol out of its layout (shape, form feed, whether it repeats a head line of its text, recurs, stands beside a page number or at the foot of the text, or in a column of numbers), and the number of its closing word (0 where it can't be furniture)."""
    bare = [x.strip() for x in lines]
    known = [facts(t) for t in bare]
    shapes = [k[0] for k in known]
    masked = [k[1] for k in known]
    heads, seen_heads = [], 0
    for i, t in enumerate(bare):
        if t:
            seen_heads += 1
            if own := heading(t):
                heads.append((i, *own))
            if seen_heads == 5:
                break
    times = Counter(m for m in masked if m)
    symbols, tails = [], []
    last = len(lines) - 1
    foot = next((i for i in range(last, -1, -1) if bare[i]), -1)
    above = 0
    for i, t in enumerate(bare):
        s = shapes[i]
        head = False
        if s in (7, 8, 9) and len(t) < 110:
            m = masked[i]
            head = any(i > k and h in m for k, h, _ in heads)
            if not head and i > 5:
                b = known[i][2]
                head = any(i > k and b.startswith(hb) for k, _, hb in heads)
        # what recurs on lines close by is a list, not furniture
        again = s not in (0, 2, 3, 5, 6) and bool(masked[i]) and times[masked[i]] > 1 and masked[i] not in masked[max(0, i - 4) : i] and masked[i] not in masked[i + 1 : i + 5]
        near = (i > 0 and (shapes[i - 1] == 1 or "\x0c" in lines[i - 1])) or (i < last and (shapes[i + 1] == 1 or "\x0c" in lines[i + 1])) or i == foot
        column = s == 2 and above in (2, 7)
        symbols.append(((((s * 2 + ("\x0c" in lines[i])) * 2 + head) * 2 + again) * 2 + near) * 2 + column)
        tails.append(known[i][3])
        above = s or above
    return symbols, tails


N_SYMBOLS = SHAPES * 32
# What fitting starts from: states (field, text, furniture, break) of a line of each shape, 0 where the shape by itself rules a state
# out, and how often form feed, head line, recurrence, neighbour of a page number and (of numbers) a column stand in furniture and elsewhere.
SHAPE_START = np.array([
    [0.0, 0.0, 0.0, 1.0], [0.0, 0.0, 1.0, 0.0], [0.5, 0.0, 0.5, 0.0], [1.0, 0.0, 0.0, 0.0], [1.0, 0.0, 0.0, 0.0],
    [0.0, 1.0, 0.0, 0.0], [0.2, 0.8, 0.0, 0.0], [0.85, 0.0, 0.15, 0.0], [0.7, 0.0, 0.3, 0.0], [0.75, 0.0, 0.25, 0.0],
])
FLAG_START = np.array([[0.2, 0.05], [0.5, 0.1], [0.3, 0.1], [0.3, 0.1], [0.03, 0.95]])


class LineModel:
    """Hidden Markov model with four states; a line shows a symbol of its layout and, if it can be furniture, its closing word. tails: the closing words told apart, in order."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray, tail: np.ndarray, tails: np.ndarray):
        self.start, self.move, self.emit, self.tail, self.tails = start, move, emit, tail, tails

    @classmethod
    def first(cls, tails: np.ndarray) -> LineModel:
        """Where fitting starts: features by themselves, all successions alike."""
        emit = np.zeros((4, N_SYMBOLS))
        for sym in range(N_SYMBOLS):
            emit[:, sym] = SHAPE_START[sym >> 5]
            for k, (inside, outside) in enumerate(FLAG_START[: 5 if sym >> 5 == 2 else 4]):
                on = sym >> (4 - k) & 1
                emit[PAGINA, sym] *= inside if on else 1 - inside
                emit[[CAMPO, CUERPO, CORTE], sym] *= outside if on else 1 - outside
        emit /= emit.sum(axis=1, keepdims=True)
        n = len(tails) + 1
        return cls(np.full(4, 0.25), np.full((4, 4), 0.25), emit, np.full((4, n), 1 / n), tails)

    def codes(self, tails: list[int] | np.ndarray) -> np.ndarray:
        """Places of closing words among those told apart, from 1; -1 for none, 0 for others."""
        t = np.asarray(tails, np.int64)
        at = np.searchsorted(self.tails, t)
        known = np.append(self.tails, -1)[at] == t
        return np.where(t == 0, -1, np.where(known, at + 1, 0))

    def coded(self, symbols: list, tails: list) -> list[tuple[np.ndarray, np.ndarray]]:
        """(symbols, codes) of many texts, looked up at once."""
        if not tails:
            return []
        ends = np.cumsum([len(t) for t in tails])[:-1]
        return list(zip(symbols, np.split(self.codes(np.concatenate([np.asarray(t, np.int64) for t in tails])), ends)))

    def emissions(self, symbols: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return self.emit.T[symbols] * np.where(codes[..., None] >= 0, self.tail.T[np.maximum(codes, 0)], 1.0)

    @staticmethod
    def batches(texts: list[tuple[list[int] | np.ndarray, np.ndarray]], cells: int = 60_000) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
        """(places, symbols, codes, lengths): texts of like length side by side, padded."""
        order = sorted((i for i, t in enumerate(texts) if len(t[0])), key=lambda i: len(texts[i][0]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * len(texts[order[end]][0]) <= cells:
                end += 1
            part = order[at:end]
            size = len(texts[part[-1]][0])
            sym, code = np.zeros((len(part), size), np.int64), np.full((len(part), size), -1, np.int64)
            for k, i in enumerate(part):
                sym[k, : len(texts[i][0])], code[k, : len(texts[i][1])] = texts[i]
            yield part, sym, code, np.array([len(texts[i][0]) for i in part])
            at = end

    def expected(self, texts: list[tuple[list[int], list[int]]]) -> np.ndarray:
        """Expected counts over texts (symbols, codes), flat: start, move, emit, tail. Forward-backward."""
        n_tail = self.tail.shape[1]
        start, move, emit, tail = np.zeros(4), np.zeros((4, 4)), np.zeros((4, N_SYMBOLS)), np.zeros((4, n_tail))
        for _, sym, code, size in self.batches(texts):
            e = self.emissions(sym, code)
            there = np.arange(sym.shape[1]) < size[:, None]
            e[~there] = 1.0
            a, b = np.empty_like(e), np.empty_like(e)
            for t in range(sym.shape[1]):
                x = (self.start if t == 0 else a[:, t - 1] @ self.move) * e[:, t]
                a[:, t] = x / x.sum(axis=1, keepdims=True)
            b[:, -1] = 1.0
            for t in range(sym.shape[1] - 2, -1, -1):
                x = (e[:, t + 1] * b[:, t + 1]) @ self.move.T
                x[~there[:, t + 1]] = 1.0
                b[:, t] = x / x.sum(axis=1, keepdims=True)
            g = a * b
            g *= (there / g.sum(axis=2))[..., None]
            start += g[:, 0].sum(axis=0)
            x = a[:, :-1, :, None] * self.move * (e[:, 1:] * b[:, 1:])[:, :, None, :]
            x *= (there[:, 1:] / x.sum(axis=(2, 3)))[..., None, None]
            move += x.sum(axis=(0, 1))
            for k in range(4):
                emit[k] += np.bincount(sym.ravel(), g[..., k].ravel(), N_SYMBOLS)
                tail[k] += np.bincount(code[code >= 0], g[..., k][code >= 0], n_tail)
        return np.concatenate([start, move.ravel(), emit.ravel(), tail.ravel()])

    def refit(self, flat: np.ndarray) -> LineModel:
        """The model of expected counts; what a state has not shown keeps a little of its former probability."""
        ends = np.cumsum([4, 16, 4 * N_SYMBOLS, self.tail.size])
        parts = [flat[: ends[0]], flat[ends[0] : ends[1]].reshape(4, 4), flat[ends[1] : ends[2]].reshape(4, N_SYMBOLS), flat[ends[2] : ends[3]].reshape(self.tail.shape)]
        start, move, emit, tail = [(x + 20.0 * old) / (x + 20.0 * old).sum(axis=-1, keepdims=True) for x, old in zip(parts, (self.start, self.move, self.emit, self.tail))]
        return LineModel(start, move, emit, tail, self.tails)

    def decode(self, texts: list[tuple[list[int], list[int]]]) -> list[list[int]]:
        """Most probable states of each text (Viterbi)."""
        out: list[list[int]] = [[] for _ in texts]
        move = np.log(self.move)
        for part, sym, code, size in self.batches(texts):
            e = np.log(np.maximum(self.emissions(sym, code), 1e-300))
            came = np.zeros(sym.shape + (4,), np.int8)
            score = np.log(self.start) + e[:, 0]
            ends = np.zeros((len(part), 4))
            ends[size == 1] = score[size == 1]
            for t in range(1, sym.shape[1]):
                x = score[:, :, None] + move
                came[:, t] = x.argmax(axis=1)
                score = x.max(axis=1) + e[:, t]
                ends[size == t + 1] = score[size == t + 1]
            path = np.zeros(sym.shape, np.int8)
            k = ends.argmax(axis=1)
            rows = np.arange(len(part))
            for t in range(sym.shape[1] - 1, -1, -1):
                here = t < size
                path[here, t] = k[here]
                k = np.where(here, came[rows, t, k], k) if t else k
            for i, p, n in zip(part, path.tolist(), size.tolist()):
                out[i] = p[:n]
        return out

    def lines(self, lines: list[str]) -> list[int]:
        """States of one text's lines."""
        symbols, tails = line_features(lines)
        return self.decode([(symbols, self.codes(tails))])[0]


def fit_lines(texts: DataFrame, column: str, rounds: int = ROUNDS) -> LineModel:
    """The line model of all texts: their features are written once, each round sums expected counts over them; a fixed number of sums come to the driver."""

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [line_features(t.split("\n")) for t in b[column]]
            yield pd.DataFrame({"symbols": [g[0] for g in got], "tails": [g[1] for g in got]})

    features = spread(texts.where(F.length(column) > 0).select(column)).mapInPandas(seen, "symbols array<short>, tails array<long>")
    features = cut(features)
    words = cut(features.select(F.explode("tails").alias("t")).where("t <> 0").groupBy("t").agg(F.count("*").alias("n")))
    total = words.agg(F.sum("n")).first()[0] or 0
    tails = sorted(r["t"] for r in words.where(F.col("n") >= total * TAIL_SHARE).collect())
    model = LineModel.first(np.array(tails, np.int64))
    for _ in range(rounds):

        def expect(batches: Iterator[pd.DataFrame], model=model) -> Iterator[pd.DataFrame]:
            total = None
            for b in batches:
                c = model.expected(model.coded(b["symbols"].tolist(), b["tails"].tolist()))
                total = c if total is None else total + c
            if total is not None:
                at = np.flatnonzero(total)
                yield pd.DataFrame({"i": at, "x": total[at]})

        sums = features.mapInPandas(expect, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).toPandas()
        flat = np.zeros(4 + 16 + 4 * N_SYMBOLS + model.tail.size)
        flat[sums["i"].to_numpy(int)] = sums["x"].to_numpy()
        model = model.refit(flat)
    return model


_BACK = re.compile(rf"(?:[-¬­]\s*)?([{_LETTERS}0-9€+|!]+)")
_HEAD = re.compile(rf"^\W*?([{_LETTERS}0-9€+|!]+)")


def tail_of(line: str) -> tuple[str, int, bool] | None:
    """(last word of a line, where it begins, whether a hyphen follows), or None if the line ends in something else."""
    t = line.rstrip()
    m = _BACK.match(t[::-1])
    return (m[1][::-1], len(t) - m.end(), m.start(1) > 0) if m else None


def parted(line: str, following: str, lexicon: Lexicon) -> str | None:
    """The whole word if line ends inside a word that following goes on with, else None."""
    m, n = tail_of(line), _HEAD.match(following.strip())
    if not m or not n:
        return None
    (a, begin, dash), b = m, n[1]
    if following.strip()[: n.start(1)].strip():
        return None
    if a.isdigit() or b.isdigit():
        return None
    whole = lexicon.known(a + b)
    compound = f"{(lexicon.known(a) or a).lower()}-{(lexicon.known(b) or b).lower()}"
    if dash:
        before = re.search(rf"([{_LETTERS}]+)-$", line.rstrip()[:begin])
        joined = lexicon.compound(compound)
        if joined and (not whole or joined >= lexicon.count(whole)):
            return None
        if not whole and lexicon.known(a) and lexicon.known(b) and len(a) > 3 and len(b) > 3 and not before:
            return None
        return whole or (a + b)
    if not whole or not b[0].islower() or len(whole) < 4:
        return None
    if lexicon.count(a.lower()) and lexicon.count(b.lower()):
        return None
    return whole


class Judged(dict):
    """Answers of a function by word, kept."""

    def __init__(self, judge):
        super().__init__()
        self.judge = judge

    def __missing__(self, w: str) -> bool:
        if len(self) > 300_000:
            self.clear()
        out = self[w] = self.judge(w)
        return out


class Repairer:
    """Labels, marks and repairs one text."""

    def __init__(self, model: LineModel, lexicon: Lexicon):
        self.model, self.lexicon = model, lexicon
        self.judged = Judged(self.misread)

    def states(self, texts: list[str]) -> list[list[int]]:
        """States of the lines of many texts."""
        got = [line_features(t.split("\n")) for t in texts]
        return self.model.decode(self.model.coded([g[0] for g in got], [g[1] for g in got]))

    def read(self, text: str, states: list[int] | None = None) -> tuple[list[str], list[int], list[str | None], list[bool]]:
        """Lines, their states, the whole word a line ends inside of, whether a word of running text on it is misread."""
        lines = text.split("\n")
        states = self.model.lines(lines) if states is None else states
        inside: list[str | None] = [None] * len(lines)
        wrong = [False] * len(lines)
        body = [i for i, s in enumerate(states) if s == CUERPO]
        begun: dict[int, str] = {}
        for x, i in enumerate(body):
            if x + 1 < len(body):
                j = body[x + 1]
                gap = states[i + 1 : j]
                # other lines may stand between only across a page break
                if all(s in (PAGINA, CORTE) for s in gap) and (j == i + 1 or PAGINA in gap or "\x0c" in "".join(lines[i + 1 : j + 1])):
                    whole = parted(lines[i], lines[j], self.lexicon)
                    if whole:
                        inside[i] = whole
                        begun[j] = whole
        for i in body:
            words = _WORD.findall(lines[i])
            first = 1 if i in begun else 0
            last = len(words) - 1 if inside[i] else len(words)
            wrong[i] = any(map(self.judged.__getitem__, words[first:last]))
            if inside[i]:
                wrong[i] = wrong[i] or self.fragment(words[-1] if words else "", inside[i].lower(), True)
            if i in begun and words:
                wrong[i] = wrong[i] or self.fragment(words[0], begun[i].lower(), False)
        return lines, states, inside, wrong

    def misread(self, w: str) -> bool:
        if self.lexicon.count(w.lower()) or w.isdigit() or (len(w) == 1 and not _ODD.search(w)):
            return False
        if self.lexicon.source(w) is not None:
            return True
        # a sign that no word has, between small letters
        return bool(re.search(r"[a-záéíóúüñ](?:[€+@$]|[0-9])[a-záéíóúüñ]|[a-záéíóúüñ]{2}[0-9€+]$|^[0-9€+][a-záéíóúüñ]{2}", w)) and not re.fullmatch(r"\d+[a-z]{1,3}", w)

    @staticmethod
    def fragment(piece: str, whole: str, head: bool) -> bool:
        """Whether a word's part that stands on a line is misread."""
        p = piece.lower()
        return bool(p) and not (whole.startswith(p) if head else whole.endswith(p)) and p.translate(_FOLD) not in whole.translate(_FOLD)

    def paragraphs(self, text: str, states: list[int] | None = None) -> list[str]:
        """Continuous paragraphs of the running text: furniture left out, parted words joined, misread words restored."""
        lines, states, inside, _ = self.read(text, states)
        out: list[str] = []
        words: list[str] = []
        join = ""
        for i, line in enumerate(lines):
            s = states[i]
            if s == CUERPO:
                t = line.replace("\x0c", " ").strip()
                if join:
                    n = _HEAD.match(t)
                    t = join + (t[n.end() :] if n else t)
                    join = ""
                if inside[i]:
                    m = tail_of(t)
                    if m:
                        join = inside[i] if not m[0][0].isupper() else inside[i][0].upper() + inside[i][1:]
                        t = t[: m[1]].rstrip()
                if t:
                    words.append(_WORD.sub(self.restored, t))
            elif s == CORTE and not join and words and not self.continues(lines, states, i):
                out.append(re.sub(r"\s+", " ", " ".join(words)))
                words = []
            elif s == CAMPO and words:
                out.append(re.sub(r"\s+", " ", " ".join(words)))
                words = []
        if words or join:
            out.append(re.sub(r"\s+", " ", " ".join([*words, join]).strip()))
        return out

    def restored(self, m: re.Match) -> str:
        w = m[0]
        source = None if w.isdigit() else self.lexicon.source(w)
        return w if source is None else source[0].upper() + source[1:] if w[0].isupper() else source

    @staticmethod
    def continues(lines: list[str], states: list[int], i: int) -> bool:
        """Whether the break at i belongs to a page break within a paragraph."""
        after = next((j for j in range(i, len(lines)) if states[j] in (CUERPO, CAMPO)), None)
        before = next((j for j in range(i, -1, -1) if states[j] in (CUERPO, CAMPO)), None)
        if after is None or before is None or states[after] != CUERPO or states[before] != CUERPO:
            return False
        return PAGINA in states[before:after] and lines[after].strip()[:1].islower()


def lexicon_of(rows: list) -> Lexicon:
    return Lexicon({r["k"]: [(x["n"], x["t"]) for x in r["words"]] for r in rows})


def repair(texts: DataFrame, id_column: str, column: str, work, schema: str, most_words: int | None = None) -> DataFrame:
    """work(tool, ids, texts, states) -> pandas frame, over all texts with a tool fitted on all of them.

    The lexicon's most_words commonest skeletons go to every task. If there are more, each text is joined to the rest of
    those that it asks for, so the result is the same as with all of them at hand.
    """
    spark = texts.sparkSession
    most_words = MOST_WORDS if most_words is None else most_words
    there = texts.select(id_column, column).where(F.length(column) > 0)
    rows = cut(lexicon_rows(there, column))
    model = fit_lines(there, column)
    top = F.array_max(F.transform("words", lambda x: x["n"]))
    size = rows.count()
    near = rows if size <= most_words else rows.orderBy(top.desc(), "k").limit(most_words)
    sent = spark.sparkContext.broadcast((model, lexicon_of(near.collect())))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, lexicon = sent.value
        tool = Repairer(model, lexicon)
        for b in batches:
            for at in range(0, len(b), 1000):
                part = b.iloc[at : at + 1000]
                body = part[column].tolist()
                states = tool.states(body)
                if "more" in part:
                    for i, (t, st, more) in enumerate(zip(body, states, part["more"])):
                        own = tool if more is None or not len(more) else Repairer(model, Lexicon({r["k"]: [(x["n"], x["t"]) for x in r["words"]] for r in more}, lexicon))
                        yield work(own, part[id_column].iloc[i : i + 1].tolist(), [t], [st])
                else:
                    yield work(tool, part[id_column].tolist(), body, states)

    if size <= most_words:
        return spread(there).mapInPandas(run, schema)

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, lexicon = sent.value
        tool = Repairer(model, lexicon)
        for b in batches:
            out = []
            for key, t in zip(b["row"], b[column]):
                lexicon.missing = set()
                tool.judged.clear()
                tool.read(t)
                out += [(key, k) for k in lexicon.missing]
            lexicon.missing = None
            yield pd.DataFrame(out, columns=["row", "k"])

    numbered = cut(there.withColumn("row", F.monotonically_increasing_id()))
    rest = rows.join(near.select("k"), "k", "left_anti")
    wanted = spread(numbered).mapInPandas(asked, "row long, k string").join(rest, "k").groupBy("row").agg(F.collect_list(F.struct("k", "words")).alias("more"))
    return numbered.join(wanted, "row", "left").select(id_column, column, "more").mapInPandas(run, schema)


def marked_lines(texts: DataFrame, id_column: str = "id", column: str = "texto_extraccion", most_words: int | None = None) -> DataFrame:
    """(texto_id, linea, tipo): tipo pagina, guion or caracter. Null and empty texts have no line; whole texts are read."""

    def work(tool: Repairer, ids: list, body: list[str], states: list[list[int]]) -> pd.DataFrame:
        out = []
        for k, text, own in zip(ids, body, states):
            _, _, inside, wrong = tool.read(text, own)
            out += [(k, i + 1, "pagina") for i, s in enumerate(own) if s == PAGINA]
            out += [(k, i + 1, "guion") for i, w in enumerate(inside) if w is not None]
            out += [(k, i + 1, "caracter") for i, w in enumerate(wrong) if w]
        return pd.DataFrame(out, columns=["texto_id", "linea", "tipo"])

    return repair(texts, id_column, column, work, "texto_id long, linea long, tipo string", most_words)


def repaired(texts: DataFrame, id_column: str = "id", column: str = "texto_extraccion") -> DataFrame:
    """(texto_id, parrafos): the running text of each row as continuous paragraphs; null and empty texts have none."""

    def work(tool: Repairer, ids: list, body: list[str], states: list[list[int]]) -> pd.DataFrame:
        return pd.DataFrame({"texto_id": ids, "parrafos": ["\n\n".join(tool.paragraphs(t, s)) for t, s in zip(body, states)]})

    full = repair(texts, id_column, column, work, "texto_id long, parrafos string")
    return full.union(texts.where(F.coalesce(F.length(column), F.lit(0)) == 0).select(F.col(id_column).cast("long"), F.lit("")))


def p2_found(spark, folder: str) -> DataFrame:
    return marked_lines(read_table(spark, folder, "textos"))


def p2_paragraphs(spark, folder: str) -> DataFrame:
    return repaired(read_table(spark, folder, "textos"))
