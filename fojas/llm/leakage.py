"""Passages of held-out items inside a corpus (problem 9).

Words are folded (case, accents, misreadings), and every window of WINDOW words of the items and of all documents gets
a 64-bit SimHash with weighted words. The items' fingerprints are indexed by four blocks of 16 bits, each under all
values within one bit: any window within a Hamming distance of 7 shares one of these keys (8 differing bits would be
needed to spoil all four blocks twice), so none is missed. A candidate is verified by aligning document and item from
there outwards and weighing the shared words of the run.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fojas.llm.scanned import bone
from fojas.session import read_table, spread

#: Words of a fingerprinted window; a run of 20 words with one changed word holds an unchanged window.
WINDOW = 8
RADIUS = 7
BLOCKS = 4
#: Words of an item that a run must cover (about 20, less up to three that a misreading, parting or joining at its ends hides), and the share of its weight that must agree.
RUN, AGREE = 17, 0.7
#: About so many words of items are indexed at once: bounds what is sent to every task and the candidates of a window. More are searched for in several passes.
INDEX_WORDS = 50_000
CHUNK = 60_000

# the hyphen is looked for first, as most places have none
_PARTED = re.compile(r"[-­¬](?<=\w[-­¬])\s*\n\s*(?=\w)")
_TOKEN = re.compile(r"[^\W_]+(?:[€+|!@$][^\W_]+)*[€+]?|[€+][^\W_]+")


class Folded(dict):
    """Spellings already met, with their folded words."""

    def __missing__(self, t: str) -> str:
        if len(self) > 300_000:
            self.clear()
        out = self[t] = bone(t)
        return out


class Folder:
    """Text to folded words."""

    def __init__(self):
        self.seen = Folded()

    def words(self, text: str) -> list[str]:
        return list(map(self.seen.__getitem__, _TOKEN.findall(_PARTED.sub("", text.lower()))))


def signs(word: str, weight: float) -> np.ndarray:
    """The word's 64 signs, weighted: at most 12 each, so that the sum over a window of eight words stays within a byte."""
    bits = np.unpackbits(np.frombuffer(xxhash.xxh64_digest(word, seed=9), np.uint8))
    return ((bits.astype(np.int8) * 2 - 1) * round(weight * 4)).astype(np.int8)


class Signed(dict):
    """Signs of words that no item has, kept; they weigh 1."""

    def __missing__(self, w: str) -> np.ndarray:
        if len(self) > 100_000:
            self.clear()
        out = self[w] = signs(w, 1.0)
        return out


class Index:
    """Fingerprints of all windows of the items, findable within RADIUS."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW):
        folder = Folder()
        self.window = window
        self.items = {k: folder.words(t) for k, t in items if t}
        seen = Counter(w for ws in self.items.values() for w in set(ws))
        n = max(len(self.items), 1)
        self.weights = {w: float(np.clip(np.log((n + 1) / (c + 0.5)), 0.5, 3.0)) for w, c in seen.items()}
        self.vocabulary = {w: i for i, w in enumerate(self.weights)}
        self.unknown = Signed()
        self.signs = np.stack([signs(w, x) for w, x in self.weights.items()] or [np.zeros(64, np.int8)])
        keys, owner, place = [], [], []
        for k, ws in self.items.items():
            f = self.fingerprints(self.matrix(ws))
            keys.append(f)
            owner += [k] * len(f)
            place += range(len(f))
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        self.owner, self.place = np.array(owner, np.int64), np.array(place, np.int64)
        self.tables = []
        for b in range(BLOCKS):
            part = ((self.keys >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            near = np.concatenate([part, *[part ^ (1 << i) for i in range(16)]])
            who = np.tile(np.arange(len(part)), 17)
            order = np.argsort(near, kind="stable")
            self.tables.append((np.searchsorted(near[order], np.arange(65537)), who[order].astype(np.int32), self.keys[who[order]]))

    def matrix(self, words: list[str]) -> np.ndarray:
        """Signs of a text's words, [n, 64]; words that no item has weigh 1."""
        at = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        out = self.signs[at]
        other = np.flatnonzero(at < 0)
        if len(other):
            place: dict[str, int] = {}
            own = [place.setdefault(words[i], len(place)) for i in other]
            out[other] = np.stack(list(map(self.unknown.__getitem__, place)))[own]
        return out

    def fingerprints(self, m: np.ndarray) -> np.ndarray:
        """SimHash of each window; a text shorter than a window has one of all its words."""
        if not len(m):
            return np.zeros(0, np.uint64)
        w = min(self.window, len(m))
        if w == 8:
            # pairs, fours and eights of neighbours
            m = m[:-1] + m[1:]
            m = m[:-2] + m[2:]
            sums = m[:-4] + m[4:]
        else:
            sums = sum(m[k : len(m) - w + 1 + k].astype(np.int32) for k in range(w))
        return np.packbits(sums > 0, axis=1).view(">u8").ravel().astype(np.uint64)

    def near(self, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in f, index of item window) of all pairs within RADIUS."""
        left, right = [], []
        for b, (starts, who, keys) in enumerate(self.tables):
            part = ((f >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            begin = starts[part]
            n = starts[part + 1] - begin
            at = np.repeat(np.arange(len(f)), n)
            place = np.arange(len(at)) + np.repeat(begin - (np.cumsum(n) - n), n)
            ok = np.flatnonzero(np.bitwise_count(np.repeat(f, n) ^ keys[place]) <= RADIUS)
            left.append(at[ok])
            right.append(who[place[ok]])
        return np.concatenate(left), np.concatenate(right)

    def run(self, doc: list[str], item: list[str], p: int, q: int, passed: set[int] | None = None) -> tuple[int, float, int, int]:
        """(words of the item covered, share of weight that agrees, first and last place in the item) of the run through doc[p] and item[q], single changed, missing, added, parted or joined words passed over.

        The places in the document of its agreeing words on the diagonal p - q are added to passed.
        """
        same, other = 0.0, 0.0
        ends = []
        for step in (1, -1):
            i, j = (p, q) if step == 1 else (p - 1, q - 1)
            good = q if step == 1 else q
            pending = 0.0

            def eq(x: int, y: int) -> bool:
                return 0 <= x < len(doc) and 0 <= y < len(item) and doc[x] == item[y]

            while 0 <= i < len(doc) and 0 <= j < len(item):
                if doc[i] == item[j]:
                    same += self.weights.get(item[j], 1.0)
                    other += pending
                    pending = 0.0
                    good = j
                    if passed is not None and i - j == p - q:
                        passed.add(i)
                    i, j = i + step, j + step
                elif eq(i + step, j + step) and (eq(i + 2 * step, j + 2 * step) or eq(i + 3 * step, j + 3 * step)):
                    pending += self.weights.get(item[j], 1.0)
                    i, j = i + step, j + step
                elif eq(i + step, j) and eq(i + 2 * step, j + step):
                    pending += 0.5
                    i += step
                elif eq(i, j + step) and eq(i + step, j + 2 * step):
                    pending += self.weights.get(item[j], 1.0)
                    j += step
                elif eq(i + 2 * step, j + step) and eq(i + 3 * step, j + 2 * step):
                    pending += self.weights.get(item[j], 1.0)
                    i, j = i + 2 * step, j + step
                elif eq(i + step, j + 2 * step) and eq(i + 2 * step, j + 3 * step):
                    pending += self.weights.get(item[j], 1.0)
                    i, j = i + step, j + 2 * step
                else:
                    break
            ends.append(good)
        last, first = ends[0], min(ends[1], q)
        return last - first + 1, same / max(same + other, 1e-9), first, last

    def leaks(self, doc: list[str], places: np.ndarray, found: np.ndarray) -> list[tuple[int, int, float]]:
        """(item, longest run, agreement) of the verified items of one document. Every seed is verified that no run found on its diagonal has passed."""
        lines: dict[tuple[int, int], set[int]] = defaultdict(set)
        for p, x in zip(places.tolist(), found.tolist()):
            lines[int(self.owner[x]), p - int(self.place[x])].add(p)
        best: dict[int, tuple[int, float]] = {}
        for (k, shift), seeds in lines.items():
            item = self.items[k]
            # words of this diagonal that a run from it has passed
            done: set[int] = set()
            for p in sorted(seeds):
                for i in range(p, min(p + self.window, len(doc), len(item) + shift)):
                    if i in done or doc[i] != item[i - shift]:
                        continue
                    n, agree, _, _ = self.run(doc, item, i, i - shift, done)
                    if n >= min(RUN, len(item)) and agree >= AGREE and (n, agree) > best.get(k, (0, 0.0)):
                        best[k] = (n, agree)
        return [(k, n, a) for k, (n, a) in best.items()]


def leaked_items(documents: DataFrame, items: DataFrame, id_column: str = "doc_id", column: str = "text", item_id: str = "item_id", item_text: str = "texto", index_words: int | None = None) -> DataFrame:
    """(doc_id, item_id, palabras, acuerdo): documents that hold a run of at least RUN words of an item, with the longest run.

    All windows of all documents are compared, in whole texts; repeated documents are each reported. Null and empty
    texts and items have no windows; an empty list of items gives an empty result. Items are read in groups of about
    index_words, by hash; each group is one narrow pass over the documents, without shuffle. Words are weighed by how
    few items of the group have them.
    """
    words = items.select(F.sum(F.size(F.split(F.trim(item_text), r"\s+")))).first()[0] or 0
    groups = max(1, -(-int(words) // (index_words or INDEX_WORDS)))
    out = None
    for g in range(groups):
        own = items.where(F.col(item_text).isNotNull() & (F.pmod(F.xxhash64(item_id, item_text), F.lit(groups)) == g))
        found = passages(documents, Index([(r[0], r[1]) for r in own.select(item_id, item_text).collect()]), id_column, column)
        out = found if out is None else out.unionByName(found)
    return out


def passages(documents: DataFrame, index: Index, id_column: str, column: str) -> DataFrame:
    """(doc_id, item_id, palabras, acuerdo) of the items of one index."""
    sent = documents.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = sent.value
        folder = Folder()
        for b in batches:
            out = []
            group: list[tuple[int, list[str]]] = []
            size = 0

            def flush(group: list[tuple[int, list[str]]]) -> None:
                if not group or not len(index.keys):
                    return
                words = [w for _, ws in group for w in ws]
                m = index.matrix(words)
                ends = np.cumsum([len(ws) for _, ws in group])
                f = index.fingerprints(m)
                at, found = index.near(f)
                owner = np.searchsorted(ends, at, side="right")
                order = np.argsort(owner, kind="stable")
                at, found, owner = at[order], found[order], owner[order]
                cuts = np.flatnonzero(np.diff(owner)) + 1
                for part in np.split(np.arange(len(owner)), cuts):
                    if len(part):
                        k = owner[part[0]]
                        begin = ends[k - 1] if k else 0
                        out.extend((group[k][0], *leak) for leak in index.leaks(group[k][1], at[part] - begin, found[part]))

            for k, text in zip(b[id_column], b[column]):
                ws = folder.words(text) if text else []
                if ws:
                    group.append((k, ws))
                    size += len(ws)
                if size >= CHUNK:
                    flush(group)
                    group, size = [], 0
            flush(group)
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "palabras", "acuerdo"])

    return spread(documents.select(id_column, column)).mapInPandas(run, "doc_id long, item_id long, palabras int, acuerdo double")


def p9_leaks(spark, folder: str) -> DataFrame:
    return leaked_items(read_table(spark, folder, "documents"), read_table(spark, folder, "items_evaluacion"))


def p9_found(spark, folder: str) -> DataFrame:
    return p9_leaks(spark, folder).select("doc_id", "item_id")
