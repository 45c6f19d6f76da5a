from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fojas.llm import consensus as C

COLS = "id long, documento_id long, metodo string, campo string, valor string, score double, created_at timestamp, deleted_at timestamp"
T0 = datetime(2024, 1, 1)


def row(i, doc, metodo, valor, campo="traccion", score=None, day=0, deleted=False):
    return (i, doc, metodo, campo, valor, score, T0 + timedelta(days=day), T0 if deleted else None)


def test_held_out_truth(spark):
    """Simulated methods of known quality: the consensus must beat the plain majority, and the reliabilities must be in order."""
    rng = random.Random(1)
    quality = {"nativo": 0.97, "doctr": 0.93, "easyocr": 0.75, "tesseract4": 0.45, "tesseract6": 0.45}
    values = ["4X2", "4X4", "6X2", "6X4", "8X4"]
    rows, truth = [], {}
    for doc in range(2, 700):
        t = truth[doc] = rng.choice(values)
        copied = rng.choice([v for v in values if v != t])
        for m in rng.sample(list(quality), 3):
            wrong = copied if m.startswith("tess") and rng.random() < 0.7 else rng.choice([v for v in values if v != t])
            rows.append(row(len(rows), doc, m, t if rng.random() < quality[m] else wrong))
    items, annotators = C.consensus(spark.createDataFrame(rows, COLS))
    got = {r["documento_id"]: r["valor"] for r in items.collect()}
    by: dict = {}
    for r in rows:
        by.setdefault(r[1], []).append(r[4])
    plain = sum(max(sorted(set(v)), key=v.count) == truth[d] for d, v in by.items())
    assert sum(got[d] == truth[d] for d in truth) > plain + 20
    fia = {r["metodo"]: r["fiabilidad"] for r in annotators.where("campo = 'traccion'").collect()}
    assert fia["nativo"] > fia["easyocr"] > fia["tesseract4"]


def test_latest_live_reading_and_edges(spark):
    rows = [
        row(1, 2, "doctr", "4x4"), row(2, 2, "doctr", " 4x2 ", day=1), row(3, 2, "doctr", "8X4", day=2, deleted=True), row(4, 3, "doctr", "6X2"), row(5, 3, "doctr", "", day=1),
        row(6, 4, "doctr", "4X2"), row(7, 4, "doctr", "4X2"), row(8, 5, "otro", "4X2"), row(9, 6, "doctr", None), row(10, 7, None, "x"), row(11, None, "doctr", "4X2"), row(12, 8, "doctr", "9" * 20000),
    ]
    df = spark.createDataFrame(rows, COLS).withColumn("v", F.lit("clash")).withColumn("pattern", F.lit(1))
    items, _ = C.consensus(df)
    got = {r["documento_id"]: (r["valor"], r["acuerdo"], r["n_valores"]) for r in items.collect()}
    assert set(got) == {2, 4, 5, 8} and got[2] == ("4X2", 1.0, 1) and got[4] == ("4X2", 1.0, 1)


def test_agreement_measure(spark):
    rows = [row(1, 2, "doctr", "4X2"), row(2, 2, "nativo", "4X2"), row(3, 2, "easyocr", "4X4")]
    items, _ = C.consensus(spark.createDataFrame(rows, COLS))
    r = items.first()
    assert abs(r["acuerdo"] - 1 / 3) < 1e-9 and r["n_metodos"] == 3 and r["valor"] == "4X2"


def test_empty(spark):
    items, annotators = C.consensus(spark.createDataFrame([], COLS))
    assert items.count() == 0 and annotators.count() == 0
