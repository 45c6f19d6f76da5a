from __future__ import annotations

from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fojas.llm import packing as P


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=9), st.integers(0, 60))
def test_fullest_is_the_best_subset(lengths, room):
    counts: dict[int, int] = {}
    for x in lengths:
        counts[x] = counts.get(x, 0) + 1
    got = P.fullest(counts, room)
    best = max((sum(c) for n in range(len(lengths) + 1) for c in combinations(lengths, n) if sum(c) <= room), default=0)
    assert sum(got) == best and all(got.count(x) <= counts[x] for x in got)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_pack_keeps_all(lengths):
    bins = P.pack(lengths, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths))) and all(sum(lengths[i] for i in b) <= 50 for b in bins)


@pytest.mark.parametrize("shard", [1_500_000, 400])
def test_containers(spark, shard):
    sizes = [(i, (i * 37) % 90 + 1) for i in range(60)] + [(100, 250), (101, 0), (102, None), (5, 7), (5, 7)]
    df = spark.createDataFrame(sizes, "doc_id long, tokens long").withColumn("pieza", F.lit("clash"))
    caps = spark.createDataFrame([("a", 100), ("b", 1000), ("c", None), ("d", 0), ("a", 100)], "perfil string, capacidad_tokens int")
    rows = P.containers(df, caps, shard).collect()
    for perfil, cap in (("a", 100), ("b", 1000)):
        own = [r for r in rows if r["perfil"] == perfil]
        fill: dict = {}
        for r in own:
            fill[r["contenedor"]] = fill.get(r["contenedor"], 0) + r["tokens"]
        assert max(fill.values()) <= cap and sum(fill.values()) == sum(t or 0 for _, t in sizes)
        assert len([r for r in own if r["doc_id"] == 5]) == 3
        assert sorted(r["tokens"] for r in own if r["doc_id"] == 100) == ([50, 100, 100] if cap == 100 else [250])
        bound = -(-sum(fill.values()) // cap)
        assert len(fill) <= bound + (1 if shard > 1000 else 4)
    assert {r["perfil"] for r in rows} == {"a", "b"}


def test_items_that_fill_no_bin_stay_in_shards(spark, monkeypatch):
    """Items of 0.6 of the capacity, none of which go together: no group outgrows a shard."""
    most = []
    real = P.cut

    def seen(df):
        out = real(df)
        if "contenedor" in out.columns:
            most.append(out.withColumn("s", F.expr("substring_index(contenedor, '-', 2)")).groupBy("s").agg(F.sum("tokens").alias("t")).agg(F.max("t")).first()[0])
        return out

    monkeypatch.setattr(P, "cut", seen)
    sizes = spark.range(4096).select(F.col("id").alias("doc_id"), F.lit(60).cast("long").alias("tokens"))
    rows = P.containers(sizes, spark.createDataFrame([("a", 100)], "perfil string, capacidad_tokens int"), 6000)
    assert rows.select("contenedor").distinct().count() == rows.count() == 4096
    assert max(most) <= 2 * 6000


def test_tokens_are_the_tokenizers(spark):
    text = "uno dos  tres\n\n" * 40_000 + "y" * 60_000 + " fin"
    tool = P.encoder(f"{P.TOKENIZER_FOLDER}/{P.TOKENIZER}")
    assert P.token_counts(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["tokens"] == len(tool.encode_ordinary(text))


def test_tokens_and_empty(spark):
    docs = spark.createDataFrame([(1, "hola mundo"), (2, ""), (3, None), (4, "x" * 20_000), (5, "<|endoftext|>")], "doc_id long, text string")
    n = {r["doc_id"]: r["tokens"] for r in P.token_counts(docs).collect()}
    assert n[2] == n[3] == 0 and n[1] >= 2 and n[4] > 1000 and n[5] > 1
    caps = spark.createDataFrame([("a", 100)], "perfil string, capacidad_tokens int")
    assert P.containers(spark.createDataFrame([], "doc_id long, tokens long"), caps).count() == 0
