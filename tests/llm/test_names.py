from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from fojas.llm import names as N

PARTIES = [
    ["FERNANDA CHERUBI PLERSECHE", "F. CHERUBI PLERSECHE", "FEÑA CHERUBI PLERSECHE", "CHERUBI PLERSECHE, FERNANDA", "FERNANDA CHRUBI PLERSECHE", "Fernanda Cherubi Pl3rseche"],
    ["CLAUDIA CHERUBI PLERSECHE", "CLAUDIA CHERUBI P."], ["DANIEL ROSARIO GESIBAL PLONFIMON", "DANIEL R. GESIBAL P.", "GESIBAL PLONFIMON DANIEL ROSARIO"],
    ["TRANSPORTES PLAGENAR S.A.", "TTES PLAGENAR SA", "transporte plagenar s.a.", "TRANSPORTES PL4GENAR S A", "PLAGENAR, TRANSPORTES S.A."], ["AUTOMOTRIZ PLAGENAR SPA", "AUTOM. PLAGENAR S.P.A."],
    ["AGRICOLA NAVISUR SALPUSON LIMITADA", "AGRICOLA NAVISURSALPUSON LIMITADA", "AGRIC. NAVISUR SALPUSON LTDA."], ["CONSUMIDOR FINAL"],
]
FILL = [f"{a} {b} {c}" for a in ("FERNANDA", "CLAUDIA", "DANIEL", "ROSARIO") for b, c in (("MOLTUBRA", "GENDICO"), ("SARTUPEN", "VILCHAMO"), ("BRUNDELA", "TOCAFIR"))]


def found(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "nombre string").withColumn("key", F.lit(1)).withColumn("n", F.lit("x"))
    groups: dict = {}
    for r in N.link_names(df).collect():
        groups.setdefault(r["parte"], []).append(r["nombre"])
    return {p for g in groups.values() for p in combinations(sorted(g), 2)}


def test_variants(spark):
    want = {p for g in PARTIES for p in combinations(sorted(g), 2)}
    values = [v for g in PARTIES for v in g] + FILL
    assert found(spark, values + values[:5] + [None, "", "  "]) == want


def test_long_and_single(spark):
    assert found(spark, ["A" * 30_000, "x", "FERNANDA", "-"]) == set()
    assert found(spark, ["solo"]) == set()


def test_empty(spark):
    assert N.link_names(spark.createDataFrame([], "nombre string")).count() == 0


def test_bands_follow_the_curve():
    b = N.bands_for(0.5, 0.9, 3)
    assert 1 - (1 - 0.5**3) ** b >= 0.9 > 1 - (1 - 0.5**3) ** (b - 1)


def test_stars(spark):
    nodes = spark.createDataFrame([("a", 3), ("b", 2), ("c", 1), ("d", 5), ("e", 0)], "key string, rank int")
    edges = spark.createDataFrame([("a", "b", 0.9), ("b", "c", 0.9), ("c", "d", 0.8)], "a string, b string, s double")
    got = {r["key"]: r["center"] for r in N.stars(nodes, edges).collect()}
    assert got == {"a": "a", "b": "a", "c": "d", "d": "d", "e": "e"}
    assert N.stars(nodes, edges.where("s > 1")).where("key = center").count() == 5
