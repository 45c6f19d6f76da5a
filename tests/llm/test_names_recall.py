"""Recall of the whole candidate search against brute force, on names that no list knows, with changes at any place."""

from __future__ import annotations

import random
from itertools import combinations

from pyspark.sql import functions as F

from fojas.llm import names as N

RNG = random.Random(12)


def made(n: int) -> str:
    return "".join(RNG.choice("BCDFGLMNPRSTVZ") + RNG.choice("AEIOU") + RNG.choice(["", "N", "R", "L"]) for _ in range(n))


def typo(w: str) -> str:
    i = RNG.randrange(len(w))
    while w[i] == " ":
        i = RNG.randrange(len(w))
    return RNG.choice([w[:i] + w[i + 1 :], w[:i] + RNG.choice("XQW") + w[i:], w[:i] + RNG.choice("XQW") + w[i + 1 :]])


def brute(parser: N.Parser, values: list[str]) -> set[tuple[str, str]]:
    return {p for p in combinations(sorted(values), 2) if parser.similarity(*p) >= 0.8}


def met(parser: N.Parser, values: list[str]) -> set[tuple[str, str]]:
    """Pairs that share a sought and an offered key, twins of words by the bands."""
    hasher = N.MinHasher(N.bands_for(N.MUST_MEET, N.RECALL, N.ROWS))
    keys = {v: parser.keys(v) for v in values}
    words = sorted({w for s, o in keys.values() for k in (*s, *o) for w in k[1:]})
    bands = {w: set(enumerate(hasher.keys(N.qgrams([w])))) for w in words}
    twins = {w: [t for t in words if t == w or (bands[w] & bands[t] and N.word_similarity(w, t) >= 0.6)] for w in words}
    offered: dict = {}
    for v, (_, o) in keys.items():
        for k in o:
            offered.setdefault(tuple(k), set()).add(v)
    out = set()
    for v, (s, _) in keys.items():
        for k in s:
            grown = [(k[0],)]
            for w in k[1:]:
                grown = [(*g, t) for g in grown for t in twins[w]]
            for g in grown:
                if k[0].startswith("F|") and len(g) == 3:
                    g = (g[0], *sorted(g[1:]))
                out |= {tuple(sorted((v, x))) for x in offered.get(g, ()) if x != v}
    return out


def recall(values: list[str], given: set[str]) -> tuple[float, int]:
    parser = N.Parser(given)
    true = brute(parser, values)
    return len(true & met(parser, values)) / len(true), len(true)


def test_persons_with_given_names_seen_once():
    base = [f"{made(3)} {made(3)} {made(3)}" for _ in range(90)]
    values = list(dict.fromkeys(base + [typo(b) for b in base] + [typo(b) for b in base] + [f"{b.split(' ', 1)[1]}, {b.split(' ')[0]}" for b in base] + [b.rsplit(" ", 1)[0] for b in base]))
    share, n = recall(values, set())
    assert n > 200 and share >= 0.9


def test_persons_with_common_given_names():
    given = ["FERNANDA", "CLAUDIA", "DANIEL", "ROSARIO"]
    base = [f"{RNG.choice(given)} {made(3)} {made(3)}" for _ in range(90)]
    short = [f"{g[0]}. {s}" for g, s in (b.split(" ", 1) for b in base)]
    values = list(dict.fromkeys(base + [typo(b) for b in base] + [typo(b) for b in base] + short + [b.rsplit(" ", 1)[0] for b in base] + [b[: b.rindex(" ") + 2] + "." for b in base]))
    share, n = recall(values, set(given))
    assert n > 300 and share >= 0.9


def test_firms():
    trades = ["TRANSPORTES", "AGRICOLA", "COMERCIAL"]
    base = [f"{RNG.choice(trades)} {made(3)} {made(2)} LTDA" for _ in range(60)] + [f"{RNG.choice(trades)} {made(4)} SPA" for _ in range(60)]
    head = [b.split(" ", 1) for b in base]
    values = list(dict.fromkeys(base + [f"{t} {typo(r.rsplit(' ', 1)[0])} {r.rsplit(' ', 1)[1]}" for t, r in head] + [f"{t} {r.rsplit(' ', 1)[0]}" for t, r in head] + [f"{t} {r.rsplit(' ', 1)[0].replace(' ', '')} {r.rsplit(' ', 1)[1]}" for t, r in head]))
    share, n = recall(values, set())
    assert n > 150 and share >= 0.9


def test_names_no_list_knows_are_linked(spark):
    """Given names that stand once among many others; relatives stay apart."""
    values = ["ZULEMA CHERUBI PLERSECHE", "ZULEMA CHERUBI PLERSECHA", "CHERUBI PLERSECHE, ZULEMA", "Z. CHERUBI PLERSECHE", "GUMERSINDO ROJAS SOTO", "GUMERSINDO R0JAS SOTO", "GUMERSINDA ROJAS SOTO"]
    values += [f"FERNANDA {made(3)} {made(3)}" for _ in range(60)] + [f"CLAUDIA {made(3)} {made(3)}" for _ in range(60)]
    groups: dict = {}
    for r in N.link_names(spark.createDataFrame([(v,) for v in values], "nombre string")).collect():
        groups.setdefault(r["parte"], set()).add(r["nombre"])
    linked = {frozenset(g) for g in groups.values() if len(g) > 1}
    assert linked == {frozenset(values[:4]), frozenset(values[4:6])}


def test_a_surname_of_all_is_no_bucket(spark):
    """Candidates of one surname grow with the names, not with their square."""
    values = [f"FERNANDA GONZALEZ {made(4)}" for _ in range(300)]
    parser = N.Parser({"FERNANDA"})
    assert len(met(parser, values[:150])) < 150 and len(met(parser, values)) < 300
    df = spark.createDataFrame([(v,) for v in values], "nombre string").withColumn("h", F.lit("clash"))
    assert N.link_names(df).select("parte").distinct().count() >= 295


def test_long_rank_chains(spark):
    """As many rounds as it takes."""
    n = 36
    nodes = spark.createDataFrame([(f"{i:03d}", i) for i in range(n)], "key string, rank int")
    edges = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}", 0.9) for i in range(n - 1)], "a string, b string, s double")
    got = {r["key"]: r["center"] for r in N.stars(nodes, edges).collect()}
    assert [k for k, c in sorted(got.items()) if k == c] == [f"{i:03d}" for i in range(1, n, 2)]


def test_words_of_other_names_are_no_partners(spark, monkeypatch):
    """Surnames so dense that nearly all are alike: those that no given name's initial has in common aren't compared, nor do keys grow by them."""
    given = ["ANA", "BLAS", "CARLA", "DIEGO", "ELSA", "FELIX", "GLORIA", "HUGO", "IRENE", "JORGE", "KAREN", "LUIS", "MARTA", "NESTOR", "OLGA", "PABLO", "QUINO", "RAUL", "SARA", "TOMAS"]
    words = [f"PLA{v}{c}{u}GAR" for v in "AEIOU" for c in "BCDFGLMNRS" for u in "AEIO"]
    names = [f"{given[i % len(given)]} {words[i]} {words[(7 * i + 3) % len(words)]}" for i in range(len(words))]
    tables, cut = [], N.cut

    def seen(df):
        tables.append(cut(df))
        return tables[-1]

    monkeypatch.setattr(N, "cut", seen)
    linked = N.link_names(spark.createDataFrame([(v,) for v in names], "nombre string"))
    assert linked.count() == len(names)
    alike = max(t.count() for t in tables if t.columns == ["w", "t"])
    assert alike < 25 * len(words)
