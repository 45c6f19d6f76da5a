"""Subject areas of documents by interpolated n-gram language models (problem 10).

One model per area is trained from documents that people labelled: a document's label says which areas its sentences may
be on, and expectation-maximisation finds out which sentence is on which, and which on none. The background model is
counted over all documents, each sentence by how likely it is on no area. A sentence belongs to the area whose cross-entropy per token is lower than the background's by a margin that is
calibrated on labelled documents the models were not trained on; a document has every area to which SHARE of its on-area
sentences belongs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fojas.llm.scanned import bone
from fojas.session import read_table, spread

#: Most labelled documents that the models are trained and calibrated on (those of smallest hash); their texts are read whole.
LABELLED = 3000
#: A longer training sentence, and a training document of more sentences, counts as much as one of this length, so that no odd text outweighs the rest.
TRAIN_WORDS, TRAIN_SENTENCES = 60, 60
#: One in so many labelled documents is held out to calibrate the margin.
HELD_OUT = 4
#: Weights of bigram, unigram and even distribution.
MIX = (0.6, 0.38, 0.02)
ROUNDS = 12
#: Share of a document's on-area sentences that makes an area its own.
SHARE = 0.25
FEWEST_WORDS = 3

_END = re.compile(r"(?<=[.!?])\s+|\n\s*\n")
# the hyphen is looked for first, as most places have none
_PARTED = re.compile(r"[-­¬](?<=\w[-­¬])\s*\n\s*(?=\w)")
_TOKEN = re.compile(r"[^\W_]+(?:[€+@$|!][^\W_]+)*[€+]?|[€+][^\W_]+")


class Folded(dict):
    """Tokens with what stands for them, kept: the folded word, or its number in a vocabulary (unknown for others)."""

    def __init__(self, vocabulary: dict[str, int] | None, unknown: int):
        super().__init__()
        self.vocabulary, self.unknown = vocabulary, unknown

    def __missing__(self, t: str):
        if len(self) > 200_000:
            self.clear()
        b = "#" if t.isdigit() else bone(t)
        out = self[t] = b if self.vocabulary is None else self.vocabulary.get(b, self.unknown)
        return out


class Tokens:
    """Text to sentences of folded words, or of their numbers in a vocabulary."""

    def __init__(self, vocabulary: dict[str, int] | None = None, unknown: int = -1):
        self.seen = Folded(vocabulary, unknown)

    def sentences(self, text: str) -> list[list]:
        text = _PARTED.sub("", text.lower())
        found = (_TOKEN.findall(s) for s in _END.split(text))
        return [list(map(self.seen.__getitem__, t)) for t in found if len(t) >= FEWEST_WORDS]


class Models:
    """Log-probabilities of known words [V, K] and known pairs [B, K] under the K models, the general one last."""

    def __init__(self, vocabulary: dict[str, int], keys: np.ndarray):
        self.vocabulary, self.keys = vocabulary, keys
        self.size = len(vocabulary) + 2  # one for unknown words, one for the start

    def tokens(self) -> Tokens:
        """Text to sentences of word ids."""
        return Tokens(self.vocabulary, self.size - 2)

    def encode(self, sentences: list[list]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word ids, pair places (-1 unknown) and first places of the sentences (of words or their ids), all joined."""
        unknown, start = self.size - 2, self.size - 1
        words = chain.from_iterable(sentences)
        ids = np.fromiter(words if sentences and isinstance(sentences[0][0], int) else (self.vocabulary.get(w, unknown) for w in words), np.int64)
        sizes = np.array([len(s) for s in sentences])
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[first] = start
        key = before * self.size + ids
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return ids, np.where(self.keys[at] == key, at, -1) if len(self.keys) else np.full(len(ids), -1), first

    def counts(self, ids: np.ndarray, pairs: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(weighted) counts of words and of known pairs."""
        known = pairs >= 0
        return np.bincount(ids, weights, self.size), np.bincount(pairs[known], None if weights is None else weights[known], len(self.keys))

    def train(self, ids: np.ndarray, pairs: np.ndarray, first: np.ndarray, weights: np.ndarray, general: tuple[np.ndarray, np.ndarray] | None) -> None:
        """weights [sentences, K]; general: counts of words and pairs of the background over all documents, in place of those of the last weights."""
        sizes = np.diff(np.append(first, len(ids)))
        k = weights.shape[1]
        own = np.repeat(np.arange(len(first)), sizes)
        uni, bi, hist = np.zeros((self.size, k)), np.zeros((len(self.keys), k)), np.zeros((self.size, k))
        before = self.keys // self.size
        for c in range(k):
            uni[:, c], bi[:, c] = general if general is not None and c == k - 1 else self.counts(ids, pairs, weights[own, c])
            hist[:, c] = np.bincount(before, bi[:, c], self.size)
        p1 = MIX[1] * (uni + 0.01) / (uni.sum(axis=0) + 0.01 * self.size) + MIX[2] / self.size
        self.word = np.log(p1).astype(np.float32)
        # the history's pairs count against some that were never met, so that rare ones don't count as certain
        self.pair = np.log(MIX[0] * bi / (hist[before] + 1.0) + p1[self.keys % self.size]).astype(np.float32)

    def off(self, ids: np.ndarray, pairs: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of each sentence to be on no area, as likely beforehand as on any."""
        score = self.score(ids, pairs, first)
        score[:, -1] += np.log(max(score.shape[1] - 1, 1))
        score -= score.max(axis=1, keepdims=True)
        p = np.exp(score)
        return p[:, -1] / p.sum(axis=1)

    def score(self, ids: np.ndarray, pairs: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log-probability of each sentence under each model, [sentences, K]."""
        lp = self.word[ids]
        known = pairs >= 0
        lp[known] = self.pair[pairs[known]]
        return np.add.reduceat(lp, first, axis=0, dtype=np.float64)


class Subjects:
    """Trained models with the calibrated margin. texts, labels: labelled documents; background(models) gives the counts of words and known pairs over all documents' sentences that are on no area."""

    def __init__(self, areas: list[str], texts: list[str], labels: list[set[str]], background):
        self.areas = areas
        tokens = Tokens()
        docs = [tokens.sentences(t) for t in texts]
        keep = [i for i, d in enumerate(docs) if d]
        docs, labels = [docs[i] for i in keep], [labels[i] for i in keep]
        self.margin, self.share, self.models, self.f1 = 0.1, SHARE, None, 0.0
        if not docs or not areas:
            return
        vocabulary = {w: i for i, (w, n) in enumerate(sorted(Counter(w for d in docs for s in d for w in s).items())) if n >= 2}
        vocabulary = {w: i for i, w in enumerate(vocabulary)}
        models = Models(vocabulary, np.zeros(0, np.int64))
        ids, _, first = models.encode([s for d in docs for s in d])
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[first] = models.size - 1
        key, n = np.unique(before * models.size + ids, return_counts=True)
        models.keys = key[n >= 2]
        self.models = models
        held = [i for i in range(len(docs)) if i % HELD_OUT == HELD_OUT - 1]
        seen = [i for i in range(len(docs)) if i % HELD_OUT != HELD_OUT - 1]
        retrain = self.fit([docs[i] for i in seen], [labels[i] for i in seen], None)
        general = background(models)
        if held:
            retrain(general)
            self.calibrate([docs[i] for i in held], [labels[i] for i in held])
        self.fit(docs, labels, general)

    def fit(self, docs: list, labels: list[set[str]], general_counts: tuple[np.ndarray, np.ndarray] | None):
        """Which sentence of the labelled documents is on which of their areas, by expectation-maximisation, and the models of the areas.

        Without counts of the background it is made of the sentences on no area. Gives back a function that trains the
        models anew with other counts.
        """
        models = self.models
        sentences = [s for d in docs for s in d]
        ids, pairs, first = models.encode(sentences)
        k = len(self.areas) + 1
        place = {a: i for i, a in enumerate(self.areas)}
        prior = np.full((len(docs), k), 0.02)
        for i, ls in enumerate(labels):
            for a in ls:
                prior[i, place[a]] = 0.5 / len(ls)
        prior[:, -1] = 0.35
        owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        sizes = np.diff(np.append(first, len(ids)))
        # long sentences and documents of many are weighed down
        count = np.minimum(1.0, TRAIN_WORDS / sizes) * np.minimum(1.0, TRAIN_SENTENCES / np.bincount(owner, minlength=len(docs)))[owner]
        kind: dict = {}
        same = np.array([kind.setdefault(" ".join(x), len(kind)) for x in sentences])
        # start: a document's sentences are on its areas unless they stand in documents of all kinds
        on = np.where(prior[:, :-1] > 0.02, prior[:, :-1], 0.0)
        common = general = self.common(same, owner, np.ones(len(owner), bool), on)
        weights = np.column_stack([on[owner], np.full(len(owner), 0.05)])
        weights[common] = np.eye(k)[-1]
        for turn in range(ROUNDS):
            models.train(ids, pairs, first, weights * count[:, None], general_counts)
            # early rounds compare softly, so that one odd word doesn't decide for good
            soft = min(1.0, (turn + 2) / (ROUNDS - 2))
            post = np.log(prior[owner]) + models.score(ids, pairs, first) * soft
            post -= post.max(axis=1, keepdims=True)
            post = np.exp(post)
            post /= post.sum(axis=1, keepdims=True)
            post[common] = np.eye(k)[-1]
            mixed = np.zeros_like(prior)
            np.add.at(mixed, owner, post)
            if turn >= 4:
                # by now the mixtures tell areas apart
                common = general | self.common(same, owner, np.ones(len(owner), bool), mixed[:, :-1])
                post[common] = np.eye(k)[-1]
            # a document's own mixture becomes its prior, its labels still counting
            for i, ls in enumerate(labels):
                base = np.full(k, 0.3)
                for a in ls:
                    base[place[a]] += 2.0 / len(ls)
                base[-1] += 1.0
                mixed[i] += base
            prior = mixed / mixed.sum(axis=1, keepdims=True)
            weights = post
        weights = weights * count[:, None]
        models.train(ids, pairs, first, weights, general_counts)
        return lambda counts: models.train(ids, pairs, first, weights, counts)

    @staticmethod
    def common(same: np.ndarray, owner: np.ndarray, use: np.ndarray, mixture: np.ndarray, fewest: int = 4, most: float = 0.5) -> np.ndarray:
        """Which sentences stand, word for word, in documents of so many areas that none holds more than the given share of them."""
        which = same[use]
        size = int(same.max()) + 1
        part = mixture / np.maximum(mixture.sum(axis=1, keepdims=True), 1e-9)
        pair = np.unique(np.stack([which, owner]), axis=1)
        sums = np.zeros((size, mixture.shape[1]))
        np.add.at(sums, pair[0], part[pair[1]])
        total = sums.sum(axis=1)
        spread = (total >= fewest) & (sums.max(axis=1) < most * total) & ((sums >= 0.15 * total[:, None] / mixture.shape[1]).sum(axis=1) >= 3)
        return spread[same]

    def calibrate(self, docs: list, labels: list[set[str]]) -> None:
        """The margin at which the labels of documents that were not trained on are found best: F1 of labels against areas given, each area too many or missing counting."""
        sentences = [s for d in docs for s in d]
        ids, pairs, first = self.models.encode(sentences)
        per_token = self.models.score(ids, pairs, first) / np.diff(np.append(first, len(ids)))[:, None]
        owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        tried = []
        for margin in (0.0, 0.05, 0.1, 0.2, 0.3, 0.45, 0.6):
            shares = self.shares(per_token, owner, len(docs), margin)
            found = [{self.areas[j] for j in np.flatnonzero(x >= self.share)} for x in shares]
            right = sum(len(f & ls) for f, ls in zip(found, labels))
            wrong = sum(len(f - ls) + len(ls - f) for f, ls in zip(found, labels))
            tried.append((2 * right / max(2 * right + wrong, 1), margin))
        # the strictest of the margins that are about as good as the best
        self.f1 = max(tried)[0]
        self.margin = max(m for f1, m in tried if f1 >= self.f1 - 1e-3)

    def shares(self, per_token: np.ndarray, owner: np.ndarray, n: int, margin: float) -> np.ndarray:
        """[documents, areas]: share of the on-area sentences."""
        k = len(self.areas)
        area = per_token[:, :k].argmax(axis=1)
        on = per_token[np.arange(len(area)), area] > per_token[:, k] + margin
        hits = np.zeros((n, k))
        np.add.at(hits, (owner[on], area[on]), 1.0)
        total = hits.sum(axis=1, keepdims=True)
        return np.where(total > 0, hits / np.maximum(total, 1), 0.0)

    def of(self, docs: list[list[list[str]]]) -> np.ndarray:
        """[documents, areas] shares of a batch; documents without sentences have none."""
        sentences = [s for d in docs for s in d]
        if not sentences or self.models is None:
            return np.zeros((len(docs), len(self.areas)))
        ids, pairs, first = self.models.encode(sentences)
        sizes = np.diff(np.append(first, len(ids)))
        owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        return self.shares(self.models.score(ids, pairs, first) / sizes[:, None], owner, len(docs), self.margin)


def background_counts(documents: DataFrame, models: Models) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the models' words and pairs over the whole texts of all documents, each sentence by its probability to be on no area; as many sums come to the driver as the models have cells."""
    sent = documents.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = sent.value
        tokens = models.tokens()
        uni, bi = np.zeros(models.size), np.zeros(len(models.keys))
        for b in batches:
            for at in range(0, len(b), 500):
                sentences = [s for t in b["text"].iloc[at : at + 500] for s in tokens.sentences(t)]
                if sentences:
                    ids, pairs, first = models.encode(sentences)
                    weight = np.repeat(models.off(ids, pairs, first), np.diff(np.append(first, len(ids))))
                    u, p = models.counts(ids, pairs, weight)
                    uni += u
                    bi += p
        both = np.concatenate([uni, bi])
        where = np.flatnonzero(both)
        yield pd.DataFrame({"i": where, "x": both[where]})

    got = spread(documents.where(F.length("text") > 0).select("text")).mapInPandas(run, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).toPandas()
    both = np.zeros(models.size + len(models.keys))
    both[got["i"].to_numpy(int)] = got["x"].to_numpy()
    return both[: models.size], both[models.size :]


def train_subjects(documents: DataFrame, labels: DataFrame, areas: DataFrame) -> Subjects:
    """Area models from at most LABELLED labelled documents, the background from all documents; labels outside the list of areas are left out."""
    names = sorted(r[0] for r in areas.select("tema").distinct().collect() if r[0])
    per = labels.where(F.col("tema").isin(names)).groupBy("doc_id").agg(F.collect_set("tema").alias("temas"))
    known = documents.where(F.length("text") > 0).select("doc_id", "text").join(per, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED).collect()
    return Subjects(names, [r["text"] for r in known], [set(r["temas"]) for r in known], lambda models: background_counts(documents, models))


def document_subjects(documents: DataFrame, labels: DataFrame, areas: DataFrame) -> DataFrame:
    """(doc_id, tema, parte): the areas of each document with their share of its on-area sentences.

    Whole texts of all rows are scored; null and empty texts and texts on no area have no row; repeated documents are
    each scored. Without labels or areas the result is empty.
    """
    sent = documents.sparkSession.sparkContext.broadcast(train_subjects(documents, labels, areas))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        subjects = sent.value
        tokens = subjects.models.tokens() if subjects.models else Tokens()
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.iloc[at : at + 500]
                shares = subjects.of([tokens.sentences(t) if t else [] for t in part["text"]])
                d, a = np.nonzero(shares >= subjects.share) if shares.size else (np.zeros(0, int), np.zeros(0, int))
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy()[d], "tema": np.array(subjects.areas, object)[a] if len(a) else np.zeros(0, object), "parte": shares[d, a]})

    return spread(documents.select("doc_id", "text")).mapInPandas(run, "doc_id long, tema string, parte double")


def p10_subjects(spark, folder: str) -> DataFrame:
    return document_subjects(read_table(spark, folder, "documents"), read_table(spark, folder, "etiquetas_tema"), read_table(spark, folder, "temas"))


def p10_found(spark, folder: str) -> DataFrame:
    return p10_subjects(spark, folder).select("doc_id", "tema")
