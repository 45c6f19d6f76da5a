from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fojas.llm import canonical as C
from fojas.llm.names import edits

COLOURS = ["AZUL", "AZUL MARINO", "BLANCO PERLA", "CELESTE", "NEGRO", "ROJO", "ROSADO", "MORADO", "VERDE OLIVA", "VERDE AGUA"]


def test_entries_keep_their_accents():
    t = C.Trie(["CAFÉ", "NIÑO AZUL"])
    assert t.candidates("cafe")[0] == (0.0, "CAFÉ") and t.candidates("Café.")[0][1] == "CAFÉ" and t.candidates("azul nino")[0][1] == "NIÑO AZUL"


def test_paths():
    t = C.Trie(COLOURS)
    want = {
        "COLOR: vrede olvia": "VERDE OLIVA", "AZ. MARINO": "AZUL MARINO", "R O J O": "ROJO", "PERLA BLANCO": "BLANCO PERLA", "BLANCOPERLA": "BLANCO PERLA", '"NEGRO"': "NEGRO",
        "C3LE5TE": "CELESTE", "BLANCO PER": "BLANCO PERLA", "ROJA": "ROJO", "VERDE AGUA COMBUSTIBLE": "VERDE AGUA", "ROVADO": "ROSADO",
    }
    for text, entry in want.items():
        assert t.candidates(text)[0][1] == entry, text
    for text in ("CAMALEON", "N/I", "TORNASOL", "", " ", "X" * 50_000):
        assert t.candidates(text) == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="AZULROJ ", min_size=1, max_size=10), st.integers(0, 3))
def test_automaton_finds_all_within_distance(text, most):
    """Against the distance to every entry."""
    t = C.Trie([])
    for e in COLOURS:
        node = t.root
        for ch in e:
            node = node.setdefault(ch, {})
        node.setdefault("", []).append((e, 0.0))
    got = {(int(d), e) for d, e in C.Trie.search(t.root, text, most)}
    assert got == {(edits(text, e, 20), e) for e in COLOURS if edits(text, e, 20) <= most}


def test_table(spark):
    rows = spark.createDataFrame([(1, "color", "rojo"), (2, "color", None), (3, "color", "  "), (4, "color", "CAMALEON"), (5, "otro", "x"), (1, "color", "rojo")], "campo_id long, campo string, valor string").withColumn("termino", F.lit(9))
    got = sorted((r["campo_id"], r["termino"]) for r in C.map_values(rows, {"color": COLOURS}, ["campo_id"]).collect())
    assert got == [(1, "ROJO"), (1, "ROJO"), (4, ""), (5, "")]
    assert C.map_values(rows.where("campo_id < 0"), {"color": COLOURS}, ["campo_id"]).count() == 0
    assert [r["termino"] for r in C.map_values(rows.where("campo_id = 4"), {"color": []}, ["campo_id"]).collect()] == [""]


def test_all_entries_and_ambiguity(spark):
    rows = spark.createDataFrame([(1, "color", "VERDE"), (2, "color", "ROSADA"), (3, "color", "AZUL")], "campo_id long, campo string, valor string")
    got = {r["campo_id"]: r for r in C.map_values(rows, {"color": COLOURS}, ["campo_id"]).collect()}
    assert {e["entrada"] for e in got[1]["entradas"]} == {"VERDE OLIVA", "VERDE AGUA"} and got[1]["termino"] == "VERDE AGUA" and not got[1]["ambiguo"]
    assert got[2]["termino"] == "ROSADO" and got[3]["termino"] == "AZUL" and {"AZUL", "AZUL MARINO"} <= {e["entrada"] for e in got[3]["entradas"]}
    same = {r["campo_id"]: r for r in C.map_values(rows, {"color": ["SAN JUAN", "SAN JOSE"]}, ["campo_id"]).collect()}
    assert all(r["termino"] == "" and r["distancia"] == -1.0 and r["entradas"] == [] for r in same.values())
    tie = C.map_values(spark.createDataFrame([(1, "c", "SANTA")], rows.schema), {"c": ["SANTA FE", "SANTA CE"]}, ["campo_id"]).first()
    assert tie["ambiguo"] and tie["termino"] == "SANTA CE"


def test_long_lists_in_several_tries(spark):
    rows = spark.createDataFrame([(i, "color", v) for i, v in enumerate(["roja", "vrede olvia", "AZUL MARNO", "VERDE", "TORNASOL", "VERDE"])], "campo_id long, campo string, valor string")
    rows = rows.withColumn("fila", F.lit(0)).select("campo_id", "campo", "valor")
    want = sorted(map(str, C.map_values(rows, {"color": COLOURS}, ["campo_id"]).collect()))
    assert sorted(map(str, C.map_values(rows, {"color": COLOURS}, ["campo_id"], 3).collect())) == want


def test_tidy_column_is_the_function(spark):
    values = ["COLOR: vrede  olvia.", "R O J O", "\"Ñandú\" (gris)", "COMUNA DE SAN-JUAN / CIUDAD", "a.b,c", ""]
    df = spark.createDataFrame([(v,) for v in values], "v string").select("v", C.tidied(F.col("v")).alias("t"))
    assert all(r["t"] == C.tidy(r["v"]) for r in df.collect())
