from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from fojas.llm import leakage as L

RNG = random.Random(6)
WORDS = ["".join(RNG.choice("bcdfglmnprst") + RNG.choice("aeiou") for _ in range(3)) for _ in range(900)]


def words(n, rng=RNG):
    return [rng.choice(WORDS) for _ in range(n)]


ITEMS = [(k, " ".join(words(50))) for k in range(1, 21)]


def test_neighbours_against_brute_force():
    """All window pairs within the radius are found."""
    ix = L.Index(ITEMS)
    rng = np.random.default_rng(1)
    f = ix.keys[rng.integers(0, len(ix.keys), 300)].copy()
    for i in range(len(f)):
        for b in rng.choice(64, rng.integers(0, 10), replace=False):
            f[i] ^= np.uint64(1) << np.uint64(b)
    a, b = ix.near(f)
    brute = {(i, j) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f[i] ^ ix.keys) <= L.RADIUS)}
    assert set(zip(a.tolist(), b.tolist())) == {(int(i), int(j)) for i, j in brute} and len(brute) > 200


def test_leaks(spark):
    rng = random.Random(9)
    docs, want = [], set()
    for d in range(1, 121):
        body = words(80, rng)
        k, text = ITEMS[d % 20]
        w = text.split()
        if d % 4 == 0:
            at = rng.randrange(0, 28)
            run = w[at : at + 22]
            run[rng.randrange(8, 14)] = "otrapalabra"
            body[40:40] = run
            want.add((d, k))
        elif d % 4 == 1:
            body[40:40] = w[10:21]
        text = " ".join(body)
        if d % 8 == 0:
            text = text.upper().replace(" ", " \n ", 30).replace("A", "Á", 5)
        docs.append((d, text))
    docs += [(500, None), (501, ""), (502, "palabra " * 30_000), (503, ITEMS[0][1]), (503, ITEMS[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    items = spark.createDataFrame([*ITEMS, (90, None), (91, ""), (92, "corto")], "item_id long, texto string")
    got = [(r["doc_id"], r["item_id"]) for r in L.leaked_items(df, items).collect()]
    assert got.count((503, ITEMS[0][0])) == 2
    small = {x for x in got if x[0] < 500}
    assert small <= want and len(small) >= 0.95 * len(want)


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert L.leaked_items(docs, spark.createDataFrame([], "item_id long, texto string")).count() == 0
    assert L.leaked_items(docs.where("doc_id < 0"), spark.createDataFrame(ITEMS, "item_id long, texto string")).count() == 0


def test_later_seeds_of_a_diagonal(spark):
    """A run behind two adjacent changed words or behind a short quote on the same diagonal is found, at its whole length."""
    rng = random.Random(4)
    item = words(60, rng)
    broken = [*item[:10], "uno", "dos", *item[12:]]
    quoted = [*item[:9], *words(21, rng), *item[30:60]]
    short = [*item[:10], "uno", "dos", *item[12:20], *words(40, rng)]
    twice = [*item[:18], *["uno"] * 4, *item[22:]]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate([broken, quoted, short, twice], 1)], "doc_id long, text string")
    got = {r["doc_id"]: (r["palabras"], r["acuerdo"]) for r in L.leaked_items(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, texto string")).collect()}
    assert got == {1: (48, 1.0), 2: (30, 1.0), 4: (38, 1.0)}


def test_items_in_several_passes(spark):
    docs = spark.createDataFrame([(k, " ".join(words(30) + t.split()[5:40] + words(30))) for k, t in ITEMS], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, texto string")
    got = {(r["doc_id"], r["item_id"]) for r in L.leaked_items(docs, items, index_words=200).collect()}
    assert got == {(k, k) for k, _ in ITEMS} == {(r["doc_id"], r["item_id"]) for r in L.leaked_items(docs, items).collect()}


def test_breaks_against_brute_force():
    """Two to four changed words at any place of an item: the longest run of agreeing words on a diagonal decides."""
    rng = random.Random(8)
    ix = L.Index(ITEMS)
    folder = L.Folder()
    for k, text in ITEMS[:10]:
        item = folder.words(text)
        for at in range(0, 49, 3):
            for n in (2, 3, 4):
                w = text.split()
                w[at : at + n] = words(len(w[at : at + n]), rng)
                doc = folder.words(" ".join(words(15, rng) + w + words(15, rng)))
                longest, here = 0, 0
                for x, y in zip(doc[15:], item):
                    here = here + 1 if x == y else 0
                    longest = max(longest, here)
                f = ix.fingerprints(ix.matrix(doc))
                found = {x[0]: x[1] for x in ix.leaks(doc, *ix.near(f))}
                if longest >= L.RUN:
                    assert found.get(k, 0) >= longest
                elif longest < L.RUN - 4:
                    assert k not in found or found[k] < 2 * L.RUN
