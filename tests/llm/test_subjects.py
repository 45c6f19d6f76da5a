from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from fojas.llm import subjects as S

NOUNS = {"mecanica": ["motor", "freno", "eje", "radiador"], "deporte": ["equipo", "torneo", "piloto", "copa"], "salud": ["paciente", "clínica", "lesión", "reposo"]}
VERBS = {"mecanica": "pierde aceite por la junta", "deporte": "gana el desempate por goles", "salud": "evoluciona sin fiebre ni dolor"}
PLAIN = ["Se deja copia de esta hoja en el archivo.", "Recibido conforme en la oficina.", "Para constancia firman las partes.", "Toda enmienda debe llevar firma."]


def sentence(rng, area):
    return f"{rng.choice(['Además', 'En este caso', 'Por otra parte'])}, el {rng.choice(NOUNS[area])} {rng.choice(['simple', 'doble', 'final'])} {VERBS[area]}."


def corpus():
    rng = random.Random(5)
    docs, labels, truth = [], [], {}
    for d in range(1, 301):
        areas = rng.sample(list(NOUNS), rng.choice([0, 1, 1, 1, 2]))
        s = [sentence(rng, a) for a in areas for _ in range(4)] + rng.sample(PLAIN, 2)
        if len(areas) == 1 and d % 5 == 0:
            s.append(sentence(rng, next(a for a in NOUNS if a not in areas)))  # a passing mention
        rng.shuffle(s)
        docs.append((d, " ".join(s)))
        truth[d] = set(areas)
        if areas and d % 3 == 0:
            wrong = d % 30 == 0
            labels.append((d, rng.choice([a for a in NOUNS if a not in areas]) if wrong else areas[0]))
    return docs, labels, truth


def test_held_out(spark):
    docs, labels, truth = corpus()
    extra = [(900, None), (901, ""), (902, "sin nada que decir " * 5000), (1, docs[0][1])]
    df = spark.createDataFrame(docs + extra, "doc_id long, text string").withColumn("tema", F.lit("clash"))
    got: dict = {}
    for r in S.document_subjects(df, spark.createDataFrame([*labels, (2, None), (None, "salud"), (3, "otro")], "doc_id long, tema string"), spark.createDataFrame([(a,) for a in NOUNS], "tema string")).collect():
        got.setdefault(r["doc_id"], set()).add(r["tema"])
    held = [d for d in truth if d not in dict(labels)]
    assert sum(got.get(d, set()) == truth[d] for d in held) >= 0.97 * len(held)
    assert not {900, 901} & set(got)


def test_empty(spark):
    docs = spark.createDataFrame([(1, "El motor pierde aceite por la junta.")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, tema string")
    assert S.document_subjects(docs, none, spark.createDataFrame([("salud",)], "tema string")).count() == 0
    assert S.document_subjects(docs.where("doc_id < 0"), none, spark.createDataFrame([], "tema string")).count() == 0


def counted(texts):
    """The background of a list of texts, as the distributed pass counts it."""

    def of(models):
        tokens = S.Tokens()
        ids, pairs, first = models.encode([x for t in texts for x in tokens.sentences(t)])
        return models.counts(ids, pairs, np.repeat(models.off(ids, pairs, first), np.diff(np.append(first, len(ids)))))

    return of


def test_probabilities_sum_to_at_most_one():
    docs, labels, _ = corpus()
    lab = dict(labels)
    known = [(t, {lab[d]}) for d, t in docs if d in lab]
    s = S.Subjects(sorted(NOUNS), [t for t, _ in known], [ls for _, ls in known], counted([t for _, t in docs]))
    assert np.all(np.exp(s.models.word.astype(float)).sum(axis=0) <= 1.0 + 1e-6)


def test_background_covers_all_documents(spark):
    """The distributed counts are those of all whole texts."""
    docs, _, _ = corpus()
    texts = [t for _, t in docs] + ["El motor pierde aceite. " * 400]
    models = S.Models({w: i for i, w in enumerate(sorted({w for x in S.Tokens().sentences(" ".join(texts)) for w in x}))}, np.zeros(0, np.int64))
    models.keys = np.array([3 * models.size + 5, 7 * models.size + 2])
    rng = np.random.default_rng(1)
    models.word, models.pair = np.log(rng.random((models.size, 4))).astype(np.float32), np.log(rng.random((2, 4))).astype(np.float32)
    got = S.background_counts(spark.createDataFrame([(t,) for t in [*texts, None, ""]], "text string"), models)
    want = counted(texts)(models)
    assert np.allclose(got[0], want[0]) and np.allclose(got[1], want[1]) and want[0].sum() > 100


def test_extra_areas_count_against_a_margin():
    """Calibration on held-out documents: an area given beside the label is an error."""
    docs, _, truth = corpus()
    known = [(t, truth[d]) for d, t in docs if truth[d]][:120]
    s = S.Subjects(sorted(NOUNS), [t for t, _ in known], [ls for _, ls in known], counted([t for _, t in docs]))
    assert s.f1 >= 0.95


def test_the_end_of_a_long_document_is_trained_on(spark):
    """The area of a labelled document may stand behind thousands of words."""
    docs, labels, truth = corpus()
    rng = random.Random(7)
    far = [(1000 + i, " ".join(rng.choice(PLAIN) for _ in range(400)) + " " + " ".join(f"El satélite {x} transmite telemetría desde su órbita." for x in ("menor", "mayor", "nuevo"))) for i in range(30)]
    df = spark.createDataFrame(docs + far + [(2000, "El satélite joven transmite telemetría desde su órbita. Para constancia firman las partes.")], "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(d, "espacio") for d, _ in far], "doc_id long, tema string")
    got = S.document_subjects(df, marks, spark.createDataFrame([(a,) for a in [*NOUNS, "espacio"]], "tema string")).where("doc_id = 2000").collect()
    assert [r["tema"] for r in got] == ["espacio"]
