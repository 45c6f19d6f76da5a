"""Documents combined into containers of a fixed number of tokens by minimum bin slack (problem 8).

Documents are spread evenly over shards; each shard fills its bins one by one: the longest item left opens the bin and
a subset-sum table over the lengths left, kept as the bits of one integer, finds the fullest combination that fits. The
bins that a shard cannot fill well are packed again, over as many shards of the same size as their items need, until a
round saves few bins, so no task ever packs more than about SHARD_TOKENS (or SHARD_BINS containers, if these are larger).
An item longer than a container is cut into full pieces and a rest that is packed like any other.
"""

from __future__ import annotations

import base64
import os
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fojas.functions.reading import literal_map
from fojas.session import cut, read_table, spread

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
#: Folder of the public tokenizers' files.
TOKENIZER_FOLDER = "/opt/tokenizers"
#: About how many tokens one shard packs: bounds a task's work and memory whatever the corpus.
SHARD_TOKENS = 1_500_000
#: A shard has room for at least so many containers.
SHARD_BINS = 20
#: A bin less filled than this goes to the next round; a round that saves a smaller share of bins is the last.
FULL, GAIN = 0.98, 0.01

# Fixed value: public splitting pattern of byte-level vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoder(path: str):
    """The tokenizer of a rank file; special tokens are ordinary text."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, folder: str = TOKENIZER_FOLDER, name: str = TOKENIZER, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """(doc_id, tokens) of whole texts, as the tokenizer counts them; null and empty texts have 0. The tokenizer's file is read by the driver and sent to the executors."""
    documents.sparkSession.sparkContext.addFile(os.path.join(folder, name))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = encoder(SparkFiles.get(name))
        for b in batches:
            yield pd.DataFrame({"doc_id": b[id_column], "tokens": np.array([len(tool.encode_ordinary(t)) if t else 0 for t in b[column]], "int64")})

    return spread(documents.select(id_column, column)).mapInPandas(run, "doc_id long, tokens long")


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, at most as often as counted, with the largest sum not above room.

    Bit s of the table is set if some combination sums to s; the table is kept before each length, from which the
    combination is read off backwards. It stops as soon as room itself is reached.
    """
    if room <= 0:
        return []
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, size = min(counts[length], room // length), 1
        while left > 0:
            k = min(size, left)
            steps.append((reach, length, k))
            reach |= (reach << (length * k)) & mask
            left -= k
            size *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    out: list[int] = []
    for before, length, k in reversed(steps):
        if not before >> total & 1:
            out += [length] * k
            total -= length * k
    return out


def pack(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item positions; every length is between 1 and capacity."""
    where: dict[int, list[int]] = defaultdict(list)
    for i, x in enumerate(lengths):
        where[x].append(i)
    counts = {x: len(w) for x, w in where.items()}
    order = sorted(counts, reverse=True)
    bins, at = [], 0
    while at < len(order):
        longest = order[at]
        if not counts.get(longest):
            at += 1
            continue
        take = [longest]
        counts[longest] -= 1
        if not counts[longest]:
            del counts[longest]
        take += fullest(counts, capacity - longest)
        for x in take[1:]:
            counts[x] -= 1
            if not counts[x]:
                del counts[x]
        bins.append([where[x].pop() for x in take])
    return bins


def containers(sizes: DataFrame, profiles: DataFrame, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(perfil, capacidad_tokens, doc_id, pieza, tokens, contenedor): where every piece of every document goes.

    sizes: doc_id, tokens. Documents without tokens (null, empty) are in no container; a repeated doc_id is packed as
    often as it stands there. Only documents longer than the capacity are cut. contenedor is unique within its perfil.
    Capacities that are null or below 1 drop out; ties between equal lengths are settled by position.
    """
    spark = sizes.sparkSession
    caps = [(r[0], int(r[1])) for r in profiles.select("perfil", "capacidad_tokens").where("capacidad_tokens >= 1").distinct().orderBy("perfil", "capacidad_tokens").collect()]
    schema = "perfil string, capacidad_tokens int, doc_id long, pieza int, tokens long, contenedor string"
    if not caps:
        return spark.createDataFrame([], schema)
    table = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(p).cast("string").alias("perfil"), F.lit(c).alias("capacidad_tokens")) for k, (p, c) in enumerate(caps)])
    each = sizes.where("tokens > 0").select("doc_id", "tokens", F.explode(table).alias("c")).select("c.*", "doc_id", "tokens")
    whole = F.expr("CAST((tokens - 1) DIV capacidad_tokens AS INT)")
    pieces = each.select("k", "perfil", "capacidad_tokens", "doc_id", F.explode(F.sequence(F.lit(0), whole)).alias("pieza"), "tokens")
    pieces = pieces.withColumn("tokens", F.least(F.col("capacidad_tokens").cast("long"), F.expr("tokens - CAST(pieza AS BIGINT) * capacidad_tokens")))

    # a row number of the written table, so that rows with equal ids are spread as well
    pieces = cut(pieces).withColumn("fila", F.monotonically_increasing_id())

    def shards(k: int, tokens: int) -> int:
        return max(1, -(-tokens // max(shard_tokens, SHARD_BINS * caps[k][1])))

    def packed(df: DataFrame, n: dict[int, int], turn: int) -> DataFrame:
        def run(b: pd.DataFrame) -> pd.DataFrame:
            b = b.sort_values(["tokens", "doc_id", "pieza", "fila"], kind="stable").reset_index(drop=True)
            capacity = int(b["capacidad_tokens"].iloc[0])
            name = np.empty(len(b), object)
            fill = np.zeros(len(b))
            sizes_ = b["tokens"].tolist()
            for i, items in enumerate(pack(sizes_, capacity)):
                name[items] = f"{turn}-{b['shard'].iloc[0]}-{i}"
                fill[items] = sum(sizes_[x] for x in items) / capacity
            return b.assign(contenedor=name, lleno=fill)[["k", "perfil", "capacidad_tokens", "doc_id", "pieza", "tokens", "contenedor", "lleno", "fila"]]

        # shards of even size whatever the ids and however often one repeats
        spread = df.withColumn("shard", F.pmod(F.xxhash64("fila", F.lit(turn)), F.element_at(literal_map(n), F.col("k"))).cast("int"))
        return spread.groupBy("k", "shard").applyInPandas(run, "k int, " + schema + ", lleno double, fila long")

    def state(df: DataFrame) -> dict[int, tuple[int, int, int]]:
        """Per profile: bins, bins to be packed again, and the tokens that these hold."""
        per = df.groupBy("k", "contenedor").agg(F.min("lleno").alias("f"), F.sum("tokens").alias("t"))
        again = F.col("f") < FULL
        rows = per.groupBy("k").agg(F.count("*").alias("n"), F.count_if(again).alias("m"), F.coalesce(F.sum(F.when(again, F.col("t"))), F.lit(0)).alias("t")).collect()
        return {r["k"]: (r["n"], r["m"], int(r["t"])) for r in rows}

    total = {r[0]: int(r[1]) for r in pieces.groupBy("k").agg(F.sum("tokens")).collect()}
    n = {k: shards(k, t) for k, t in total.items()}
    done, before, poor, rest, turn = spark.createDataFrame([], schema), {}, None, pieces, 0
    while n:
        result = cut(packed(rest, n, turn))
        worse, last, go = [], [], {}
        for k, (bins, open_, left) in state(result).items():
            if k in before and bins > before[k]:
                worse.append(k)  # packing again used more bins: the former ones stay
            elif n[k] == 1 or not open_ or (k in before and bins > before[k] * (1 - GAIN)):
                last.append(k)
            else:
                go[k] = (open_, left)
        good = result.where(F.col("k").isin(last) | (F.col("k").isin(list(go)) & (F.col("lleno") >= FULL)))
        if worse:
            good = good.unionByName(poor.where(F.col("k").isin(worse)))
        done = done.unionByName(good.drop("k", "lleno", "fila"))
        poor = result.where(F.col("k").isin(list(go)) & (F.col("lleno") < FULL))
        rest = poor.drop("lleno", "contenedor")
        before, n, turn = {k: x[0] for k, x in go.items()}, {k: shards(k, x[1]) for k, x in go.items()}, turn + 1
    return done


def p8_containers(spark, folder: str) -> DataFrame:
    return containers(cut(token_counts(read_table(spark, folder, "documents"))), read_table(spark, folder, "capacidades"))


def p8_fill(spark, folder: str) -> DataFrame:
    """Per profile: containers, share of their room that is used, fewest containers any packing needs."""
    per = p8_containers(spark, folder).groupBy("perfil", "capacidad_tokens", "contenedor").agg(F.sum("tokens").alias("t"))
    return per.groupBy("perfil", "capacidad_tokens").agg(F.count("*").alias("contenedores"), (F.sum("t") / (F.count("*") * F.first("capacidad_tokens"))).alias("uso"), F.ceil(F.sum("t") / F.first("capacidad_tokens")).alias("cota"))
