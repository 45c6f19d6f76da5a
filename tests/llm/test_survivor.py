from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fojas.llm import survivor as V

CON = "documento_id long, metodo string, campo string, valor string, created_at timestamp, updated_at timestamp, deleted_at timestamp"
CAM = "id long, documento_id long, metodo string, campo string, valor string, score double, created_at timestamp, deleted_at timestamp"
DOC = "id long, hash_archivo string, created_at timestamp"
T0 = datetime(2024, 1, 1)


def run(spark, values, scores=(), docs=None):
    """values: (doc, valor, day or None[, campo[, deleted]])"""
    con = [(v[0], "doctr", v[3] if len(v) > 3 else "modelo", v[1], None if v[2] is None else T0 + timedelta(days=v[2]), None, T0 if len(v) > 4 else None) for v in values]
    cam = [(i, d, "doctr", "modelo", v, s, T0, None) for i, (d, v, s) in enumerate(scores)]
    docs = docs or [(d, "h", T0 + timedelta(days=d)) for d in sorted({v[0] for v in values})]
    out = V.survivors(spark.createDataFrame(con, CON).withColumn("v", F.lit("clash")).withColumn("grupo", F.lit(1)), spark.createDataFrame(cam, CAM), spark.createDataFrame(docs, DOC))
    return {(r["documento_id"], r["campo"]): r["valor"] for r in out.collect()}


def test_latest_version_survives(spark):
    assert run(spark, [(2, "RUNFAT 567 LX", 5), (3, "COLTAG 808 HD", 40)]) == {(2, "modelo"): "COLTAG 808 HD"}


def test_cut_off_and_placeholder_never_win(spark):
    assert run(spark, [(2, "RUNFAT 567 LX", 5), (3, "RUNFAT 56", 40), (4, "S/I", 50)]) == {(2, "modelo"): "RUNFAT 567 LX"}
    # a later cut-off form still dates its version
    assert run(spark, [(2, "RUNFAT 567 LX", 5), (3, "COLTAG 808", 30), (4, "RUNFAT 567", 60)]) == {(2, "modelo"): "RUNFAT 567 LX"}


def test_misread_form(spark):
    values = [(2, "GRIRBR 328", 1), (3, "GR1RBR 32B", 9)]
    assert run(spark, values, [(2, "GRIRBR 328", 0.6), (3, "GR1RBR 32B", 0.1)]) == {(2, "modelo"): "GRIRBR 328"}


def test_missing_timestamps_follow_learned_transitions(spark):
    docs, values = [], []
    for g in range(4):
        a, b = 10 + 2 * g, 11 + 2 * g
        docs += [(a, f"g{g}", T0), (b, f"g{g}", T0)]
        values += [(a, "VIEJO 1", 1), (b, "NUEVO 2", 20)]
    docs += [(50, "x", T0 + timedelta(days=9)), (51, "x", T0)]
    values += [(50, "VIEJO 1", None), (51, "NUEVO 2", None)]
    assert run(spark, values, docs=docs)[(50, "modelo")] == "NUEVO 2"


def test_edges(spark):
    got = run(spark, [(2, None, 1), (3, " ", 1), (4, "A 1", 1, "modelo", True)])
    assert got == {}
    assert run(spark, [(2, "S/I", 1), (3, "PENDIENTE", 2)])[(2, "modelo")] in ("S/I", "PENDIENTE")
    # one registration only is no group; files without hash neither
    assert run(spark, [(2, "A", 1), (3, "B", 2)], docs=[(2, "p", T0), (3, None, T0), (4, None, T0)]) == {}
    long = "Z" * 20_000
    assert run(spark, [(2, long, 1), (2, long, 1), (3, long, 2)]) == {(2, "modelo"): long}
    assert V.survivors(spark.createDataFrame([], CON), spark.createDataFrame([], CAM), spark.createDataFrame([], DOC)).count() == 0


def test_acyclic_takes_the_strongest_edges():
    closure, depth = V.acyclic([("a", "b", 5.0), ("b", "c", 4.0), ("c", "a", 3.0), ("c", "d", 1.0)])
    assert closure == {("a", "b"), ("b", "c"), ("a", "c"), ("a", "d"), ("b", "d"), ("c", "d")} and depth["d"] == 3


def test_precedence_is_transitive(spark):
    """A before B and B before C were seen, never A beside C: C survives over A; a dated version before which nothing stands keeps its place."""
    docs, values = [], []
    for g in range(8):
        a, b = 10 + 2 * g, 11 + 2 * g
        docs += [(a, f"g{g}", T0), (b, f"g{g}", T0)]
        values += [(a, "ALFA 1" if g < 4 else "BETA 2", 1), (b, "BETA 2" if g < 4 else "CELO 3", 20)]
    docs += [(50, "x", T0 + timedelta(days=9)), (51, "x", T0), (60, "y", T0), (61, "y", T0)]
    values += [(50, "ALFA 1", None), (51, "CELO 3", None), (60, "CELO 3", 5), (61, "ALFA 1", None)]
    got = run(spark, values, docs=docs)
    assert got[(50, "modelo")] == "CELO 3" and got[(60, "modelo")] == "CELO 3"


def test_standing_decides_where_values_do_not(spark):
    """The later registered file held the later value in all dated groups, so it does where timestamps are missing."""
    docs, values = [], []
    for g in range(30):
        a, b = 10 + 2 * g, 11 + 2 * g
        docs += [(a, f"g{g}", T0), (b, f"g{g}", T0 + timedelta(days=3))]
        values += [(a, f"QWRT {g + 100} A", 1), (b, f"MNBV {g + 500} B", 9)]
    docs += [(200, "x", T0 + timedelta(days=5)), (201, "x", T0)]
    values += [(200, "TRES 333 C", None), (201, "OTRO 444 D", None)]
    assert run(spark, values, docs=docs)[(200, "modelo")] == "TRES 333 C"


def test_held_out_timestamps(spark):
    docs, con = [], []
    for g in range(80):
        a, b = 10 + 2 * g, 11 + 2 * g
        docs += [(a, f"g{g}", T0), (b, f"g{g}", T0 + timedelta(days=3))]
        con += [(a, "doctr", "modelo", f"QWRT {g + 100} A", T0 + timedelta(days=1), None, None), (b, "doctr", "modelo", f"MNBV {g + 500} B", T0 + timedelta(days=9), None, None)]
    out = V.held_out_currency(spark.createDataFrame(con, CON), spark.createDataFrame([], CAM), spark.createDataFrame(docs, DOC)).collect()
    assert len(out) == 1 and out[0]["grupos"] >= 10 and out[0]["cuota"] == 1.0


def test_query_reads_every_document(spark, tmp_path):
    """A file registered as documento_id 1 and 2: both registrations count, and the listing of cases leaves out documento_id 1."""
    con = [(d, "doctr", "modelo", v, T0 + timedelta(days=n), None, None) for d, v, n in [(1, "GRIRBR 328", 40), (2, "RUNFAT 567 LX", 5), (3, "COLTAG 808 HD", 5), (4, "GR1RBR 32B", 9), (4, "GRIRBR 328", 9)]]
    cam = [(1, 1, "doctr", "modelo", "GRIRBR 328", 0.9, T0, None)]
    spark.createDataFrame(con, CON).write.parquet(f"{tmp_path}/consolidada.parquet")
    spark.createDataFrame(cam, CAM).write.parquet(f"{tmp_path}/campos.parquet")
    spark.createDataFrame([(1, "h", T0), (2, "h", T0), (3, "k", T0), (4, "k", T0)], DOC).write.parquet(f"{tmp_path}/documentos.parquet")
    got = {r["documento_id"]: (r["valor"], r["n_valores"]) for r in V.p6_survivors(spark, str(tmp_path)).collect()}
    assert got[1] == ("GRIRBR 328", 2) and set(got) == {1, 3}
    assert {r["documento_id"] for r in V.p6_found(spark, str(tmp_path)).collect()} == {3}
