from __future__ import annotations

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from fojas.llm import scanned as S

BODY = ["El servidor central guarda la respuesta en formato estructurado, en la unidad", "número siete. La consulta necesita un índice sobre la columna de búsqueda, según", "consta en la hoja. El acuerdo técnico-comercial vigente queda en el archivo general."]


def page(parted, n, total, name="FACTURA ELECTRONICA"):
    return "\n".join([f"{name} (continuación)" if n > 1 else name, *BODY, *parted, "", f"Página {n} de {total}"])


@pytest.fixture(scope="module")
def texts(spark):
    clean = [(i, page(["La flota pendiente vuelve sin flete de retorno, desde el día del mes."], 1, 1)) for i in range(40)]
    first = page(["La consulta pen-", "diente vuelve a la colurnna de búsqueda, según el técnico-", "comercial del arch", "ivo."], 1, 2)
    second = page(["El s€rvidor central gu4rda la hoja del acuerdo."], 2, 2)
    return spark.createDataFrame([*clean, (100, first + "\n\x0c" + second), (101, None), (102, ""), (103, "x" * 200_000), (104, page([], 1, 1)), (104, page([], 1, 1))], "id long, texto_extraccion string").withColumn("linea", F.lit("clash"))


def test_marks(texts):
    got = {}
    for r in S.marked_lines(texts).where("texto_id = 100").collect():
        got.setdefault(r["tipo"], set()).add(r["linea"])
    lines = texts.where("id = 100").first()["texto_extraccion"].split("\n")
    at = lambda part: next(i + 1 for i, x in enumerate(lines) if part in x)
    assert got["pagina"] == {at("Página 1"), at("Página 2"), at("(continuación)")}
    assert {at("pen-"), at("del arch")} <= got["guion"]
    assert not {i + 1 for i, x in enumerate(lines) if x.endswith("técnico-")} & got["guion"]
    assert got["caracter"] == {at("colurnna"), at("s€rvidor")}


def test_paragraphs(texts):
    got = {r["texto_id"]: r["parrafos"] for r in S.repaired(texts.where("id <> 103")).collect()}
    assert "La consulta pendiente vuelve a la columna de búsqueda" in got[100] and "comercial del archivo." in got[100]
    assert "El servidor central guarda la hoja" in got[100] and "Página" not in got[100] and got[101] == "" and got[102] == ""


def test_empty_table(texts):
    assert S.marked_lines(texts.where("id < 0")).count() == 0


def test_misreadings_are_directed():
    assert S.misread_of("carnión", "camión") and not S.misread_of("camión", "carnión")
    assert S.misread_of("liasta", "hasta") and S.misread_of("vu€lve", "vuelve") and not S.misread_of("hasta", "hasta")
    assert not S.misread_of("diente", "cliente")


def model_of(seed, tails=2):
    rng = np.random.default_rng(seed)
    norm = lambda a: a / a.sum(axis=-1, keepdims=True)
    return S.LineModel(norm(rng.random(4)), norm(rng.random((4, 4))), norm(rng.random((4, S.N_SYMBOLS))), norm(rng.random((4, tails + 1))), np.arange(5, 5 + tails))


def path_score(model, syms, codes, p):
    seen = sum(np.log(model.emit[k, s]) + (np.log(model.tail[k, c]) if c >= 0 else 0.0) for k, s, c in zip(p, syms, codes))
    return np.log(model.start[p[0]]) + sum(np.log(model.move[a, b]) for a, b in zip(p, p[1:])) + seen


def test_decode_is_the_best_path():
    """Viterbi against all paths, texts of several lengths side by side."""
    model = model_of(2)
    texts = [(s, np.array(c)) for s, c in (([3, 64, 17, 160, 5], [-1, 0, 2, -1, 1]), ([8], [1]), ([], []), ([3, 70], [-1, 2]))]
    assert model.codes([0, 5, 6, 7, 3]).tolist() == [-1, 1, 2, 0, 0]
    got = model.decode(texts)
    for (syms, codes), states in zip(texts, got):
        assert tuple(states) == (max(product(range(4), repeat=len(syms)), key=lambda p: path_score(model, syms, codes, p)) if syms else ())


def test_expected_counts_against_all_paths():
    model = model_of(3)
    texts = [([3, 64, 17], np.array([-1, 0, 2])), ([8, 9], np.array([1, -1]))]
    start, move, emit, tail = np.zeros(4), np.zeros((4, 4)), np.zeros((4, S.N_SYMBOLS)), np.zeros((4, 3))
    for syms, codes in texts:
        paths = list(product(range(4), repeat=len(syms)))
        w = np.exp([path_score(model, syms, codes, p) for p in paths])
        for p, x in zip(paths, w / w.sum()):
            start[p[0]] += x
            for a, b in zip(p, p[1:]):
                move[a, b] += x
            for k, sy, c in zip(p, syms, codes):
                emit[k, sy] += x
                if c >= 0:
                    tail[k, c] += x
    assert np.allclose(model.expected(texts), np.concatenate([start, move.ravel(), emit.ravel(), tail.ravel()]))


def sheets(seed, n):
    """Sheets with true states of their lines. Firms stand as field values and, by themselves, as running headers at page breaks; numbers in columns and as page numbers."""
    import random

    rng = random.Random(seed)
    firm = lambda: rng.choice(["TRANSPORTES", "AGRICOLA"]) + " " + "".join(rng.choice("BDFGLMN") + rng.choice("AEIOU") for _ in range(4)) + " " + rng.choice(["SPA", "LTDA"])
    out = []
    for _ in range(n):
        own = firm()
        lines = [(x, S.CAMPO) for x in ("FACTURA ELECTRONICA", own, f"FECHA: {rng.randint(10, 28)}-05-2024", rng.choice([own, firm()]), "CANTIDAD", str(rng.randint(2, 40)), str(rng.randint(2, 40)))]
        lines.append(("", S.CORTE))
        head = rng.choice([own, f"{firm()} (continuación)", f"Copia interna - rollo {rng.randint(100, 999)}"])
        for page in range(rng.randint(1, 3)):
            lines += [(x, S.CUERPO) for x in rng.sample(BODY, 2)]
            lines += rng.choice([[(f"Página {page + 1}", S.PAGINA)], [(str(page + 1), S.PAGINA)], [("", S.CORTE)]])
            lines += rng.choice([[(head, S.PAGINA)], [("\x0c" + head, S.PAGINA)], []])
            lines += [(x, S.CUERPO) for x in rng.sample(BODY, 1)]
        lines += [("", S.CORTE), (f"TOTAL $ {rng.randint(100, 900)}.000", S.CAMPO)]
        out.append(lines)
    return out


def test_fitted_model_on_held_out_sheets(spark):
    """Held-out sheets: the fitted model against each line by itself, and against what fitting starts from."""
    train, held = sheets(1, 400), sheets(2, 200)
    df = spark.createDataFrame([(i, "\n".join(x for x, _ in s)) for i, s in enumerate(train)], "id long, t string")
    model = S.fit_lines(df, "t")
    right = {"fitted": 0, "alone": 0, "unfitted": 0}
    total = 0
    first = S.LineModel.first(model.tails)
    for s in held:
        symbols, tails = S.line_features([x for x, _ in s])
        codes = model.codes(tails)
        import numpy as np

        alone = model.emissions(np.array(symbols), np.array(codes)).argmax(axis=1).tolist()
        for name, states in (("fitted", model.decode([(symbols, codes)])[0]), ("alone", alone), ("unfitted", first.decode([(symbols, codes)])[0])):
            right[name] += sum(k == y for k, (_, y) in zip(states, s))
        total += len(s)
    assert right["fitted"] >= 0.99 * total and right["fitted"] >= right["alone"] and right["fitted"] > right["unfitted"] + 50


def test_a_lexicon_in_parts_gives_the_same(texts):
    """With few words at hand, the others are joined to the texts that ask for them."""
    rows = lambda df: sorted(map(tuple, df.collect()))
    want = rows(S.marked_lines(texts))
    assert rows(S.marked_lines(texts, most_words=7)) == want and len(want) > 40
