"""Consensus of several annotators by a community confusion model (problem 1).

An annotator is a recognition method on one field. Annotators belong to communities; a community has one confusion
matrix, from the nature of the true value to how the reading relates to it (equal, look-alike, cut short, ...) and
the score given. An annotator's own matrix has a Dirichlet prior around its community's, so one with few labels is
judged by its community. Mean-field variational updates alternate between the items' posteriors (a distributed pass over
distinct patterns of readings, by the expected logarithms of all matrices) and the Dirichlet posteriors of annotators,
communities, memberships and classes (small, on the driver), until the evidence rises no more. Methods that repeat each
other's errors are found from how often two wrong readings are the same, and such a repetition counts for no second
witness. The methods are those that the data has; there may be any number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fojas.functions.reading import blank_to_null, canonical_field, literal_map
from fojas.llm.misread import skeleton
from fojas.session import cut, read_table

CONSENSUS_FIELDS = ["tipo_doc", "tipo_vehiculo", "combustible", "transmision", "traccion", "tipo_carroceria", "ejes", "placa_patente"]
KINDS = ["equal", "lookalike", "cut", "longer", "near", "known", "other"]
#: About how many readings of each kind a value could have instead: a particular one is that much less likely.
ALTERNATIVES = np.array([1.0, 6.0, 3.0, 10.0, 100.0, 6.0, 500.0])
SCORES, NATURES, COMMUNITIES = 5, 3, 4
#: A value is known if it makes up at least this share of a field's readings: at most 1/SHARE values a field.
SHARE = 0.005
#: Weight of the community in an annotator's matrix, and of the mean of all in a community's.
STRENGTH, SHARED = 20.0, 10.0
#: The evidence has settled if it rises by a smaller share; at most so many rounds.
SETTLED, ROUNDS = 1e-5, 25


def latest_readings(campos: DataFrame, fields: list[str]) -> DataFrame:
    """(documento_id, campo, metodo, v, score): each method's live row of latest created_at (then id), trimmed and upper-cased; blank ones dropped afterwards."""
    rows = campos.where(F.col("deleted_at").isNull() & F.col("documento_id").isNotNull() & F.col("metodo").isNotNull()).select(
        "documento_id", canonical_field(F.col("campo")).alias("campo"), "metodo", "valor", "score", "created_at", "id"
    )
    last = rows.where(F.col("campo").isin(fields)).groupBy("documento_id", "campo", "metodo").agg(F.max_by(F.struct("valor", "score"), F.struct("created_at", "id")).alias("x"))
    return last.select("documento_id", "campo", "metodo", F.upper(blank_to_null(F.col("x.valor"))).alias("v"), F.col("x.score").alias("score")).where(F.col("v").isNotNull())


def value_classes(readings: DataFrame, share: float = SHARE) -> DataFrame:
    """(campo, v, cls) of the known values: at most 1/share a field, whatever the size of the data, so it may be broadcast."""
    counted = readings.groupBy("campo", "v").agg(F.count("*").alias("n"))
    total = readings.groupBy("campo").agg(F.count("*").alias("all"))
    known = counted.join(F.broadcast(total), "campo").where(F.col("n") >= F.col("all") * share)
    return known.select("campo", "v", F.row_number().over(Window.partitionBy("campo").orderBy(F.desc("n"), "v")).alias("cls"))


def relation(t: Column, r: Column) -> Column:
    """Kind of reading r if the truth is t; both are structs (v, sk, cls)."""
    tv, rv = t["v"], r["v"]
    return (
        F.when(tv == rv, 0).when(t["sk"] == r["sk"], 1).when(F.startswith(tv, rv), 2).when(F.startswith(rv, tv), 3)
        .when(r["cls"] > 0, 5).when((F.length(tv) >= 4) & (F.levenshtein(tv, rv) <= 2), 4).otherwise(6)
    )


def shape(v: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(v, r"\d", "9"), r"\p{L}", "A")


def item_patterns(readings: DataFrame, fields: list[str], methods: list[str]) -> DataFrame:
    """One row per item: values (distinct readings, at most one per method) and pattern, the integers that the model looks at.

    pattern: field, number of values, then per method the value's index or -1, per method the score bucket, per value
    its class (known value, else -1 for the field's common shapes, -2 for others), per value its nature, then the
    relation of each value to each.
    """
    known = value_classes(readings)
    shapes = readings.groupBy("campo", shape(F.col("v")).alias("shape")).agg(F.count("*").alias("n"))
    common = shapes.withColumn("r", F.row_number().over(Window.partitionBy("campo").orderBy(F.desc("n"), "shape"))).where("r = 1").select("campo", "shape", F.lit(True).alias("common"))
    classed = readings.withColumn("shape", shape(F.col("v"))).join(F.broadcast(known), ["campo", "v"], "left").join(F.broadcast(common), ["campo", "shape"], "left")
    score = F.col("score")
    bucket = F.when(score.isNull() | F.isnan(score), 0).when(score < 0.2, 1).when(score < 0.45, 2).when(score < 0.8, 3).otherwise(4)
    nature = F.when(~F.col("v").rlike(r"\d"), 0).when(F.length("v") <= 4, 1).otherwise(2)
    value = F.struct("v", skeleton(F.col("v")).alias("sk"), F.coalesce("cls", F.when(F.col("common"), -1).otherwise(-2)).alias("cls"), nature.alias("nat"))
    method = F.element_at(literal_map({m: i for i, m in enumerate(methods)}), F.col("metodo"))
    items = classed.groupBy("documento_id", "campo").agg(F.array_sort(F.collect_list(F.struct(method.alias("m"), value.alias("x"), bucket.alias("s")))).alias("obs"))
    items = items.withColumn("vals", F.array_sort(F.array_distinct(F.col("obs.x"))))
    field = F.element_at(literal_map({f: i for i, f in enumerate(fields)}), F.col("campo"))
    ms = F.sequence(F.lit(0), F.lit(len(methods) - 1))

    def of_method(m: Column) -> Column:
        return F.get(F.filter("obs", lambda o: o["m"] == m), F.lit(0))

    pattern = F.concat(
        F.array(field, F.size("vals")),
        F.transform(ms, lambda m: (F.coalesce(F.array_position(F.col("vals"), of_method(m)["x"]), F.lit(0)) - 1).cast("int")),
        F.transform(ms, lambda m: F.coalesce(of_method(m)["s"], F.lit(0))),
        F.transform("vals", lambda v: v["cls"]), F.transform("vals", lambda v: v["nat"]),
        F.flatten(F.transform("vals", lambda t: F.transform("vals", lambda r: relation(t, r)))),
    )
    return items.select("documento_id", "campo", F.col("vals.v").alias("texts"), pattern.alias("pattern")).withColumnRenamed("texts", "vals")


K = len(KINDS)


def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of log gamma for positive numbers: recurrence up to 6, then the asymptotic series."""
    x = np.array(x, float)
    out = np.zeros_like(x)
    while (low := x < 6).any():
        out[low] -= 1 / x[low]
        x[low] += 1
    y = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y / 240)))


def expected_log(a: np.ndarray, axes: tuple[int, ...]) -> np.ndarray:
    """E[log p] under Dirichlets whose cells lie along axes."""
    return digamma(a) - digamma(a.sum(axis=axes, keepdims=True))


def unpack(patterns: list, m: int) -> tuple[np.ndarray, ...]:
    """Padded arrays of a batch: field [N], n [N], value of method [N,M], score [N,M], class [N,M], nature [N,M], kind [N,M,M]."""
    n = np.array([p[1] for p in patterns])
    field = np.array([p[0] for p in patterns])
    flat = np.full((len(patterns), 2 * m), 0)
    cls, nat, kind = np.full((len(patterns), m), -2), np.zeros((len(patterns), m), int), np.full((len(patterns), m, m), K - 1)
    for k in np.unique(n):
        at = np.flatnonzero(n == k)
        rows = np.array([patterns[i] for i in at])
        flat[at] = rows[:, 2 : 2 + 2 * m]
        cls[at, :k], nat[at, :k] = rows[:, 2 + 2 * m : 2 + 2 * m + k], rows[:, 2 + 2 * m + k : 2 + 2 * m + 2 * k]
        kind[np.ix_(at, range(k), range(k))] = rows[:, 2 + 2 * m + 2 * k :].reshape(-1, k, k)
    return field, n, flat[:, :m], flat[:, m:], cls, nat, kind


class Model:
    """Dirichlet posteriors by their expected logarithms: theta [field, method, nature, kind, score]; prior [field, class + 2]; same [method, method], how often two wrong readings agree."""

    def __init__(self, fields: int, methods: int, classes: int):
        self.fields, self.methods, self.classes = fields, methods, classes + 3
        start = np.array([0.75, 0.06, 0.04, 0.02, 0.03, 0.08, 0.02])
        self.theta = np.log(np.tile(start[:, None] / SCORES, (fields, methods, NATURES, 1, SCORES)))
        self.prior = np.full((fields, self.classes), -np.log(self.classes))
        self.same = np.full((methods, methods), 0.2)
        self.member: np.ndarray | None = None
        self.community = np.zeros((fields, methods), int)
        self.reliability = np.full((fields, methods), 0.75)
        self.seen = np.zeros((fields, methods))
        #: Cells of the sums of a round: theta, prior, twins, pairs, evidence.
        self.cells = self.theta.size + self.prior.size + 2 * methods * methods + 1

    def posterior(self, field, n, val, score, cls, nat, kind) -> tuple[np.ndarray, np.ndarray]:
        """[N, M]: probability of each value to be the true one; [N]: log evidence."""
        size, methods = val.shape
        at = np.arange(size)
        logp = np.full((size, methods), -1e9)
        for t in range(methods):
            here = t < n
            lp = self.prior[field, cls[:, t] + 2] - np.where(cls[:, t] < 0, np.log(200.0), 0.0)
            for m in range(methods):
                v = val[:, m]
                k = kind[at, t, np.maximum(v, 0)]
                each = 1.0 / ALTERNATIVES[k]
                for before in range(m):
                    twin = (val[:, before] == v) & (v >= 0) & (k > 0)
                    each = np.where(twin, np.maximum(each, self.same[before, m]), each)
                lp = lp + np.where(v >= 0, self.theta[field, m, nat[:, t], k, score[:, m]] + np.log(each), 0.0)
            logp[:, t] = np.where(here, lp, -1e9)
        most = logp.max(axis=1, keepdims=True)
        p = np.exp(logp - most)
        total = p.sum(axis=1, keepdims=True)
        return p / total, (most + np.log(total))[:, 0]

    def counts(self, p, weight, field, n, val, score, cls, nat, kind) -> np.ndarray:
        """Expected counts of a batch, flat: theta, prior, twins, pairs of wrong readings."""
        methods = self.methods
        c_theta, c_prior = np.zeros_like(self.theta), np.zeros_like(self.prior)
        twins, pairs = np.zeros((methods, methods)), np.zeros((methods, methods))
        at = np.arange(len(n))
        for t in range(methods):
            w = np.where(t < n, p[:, t], 0.0) * weight
            np.add.at(c_prior, (field, cls[:, t] + 2), w)
            wrong = (val >= 0) & (kind[at[:, None], t, np.maximum(val, 0)] > 0)
            for m in range(methods):
                v = val[:, m]
                np.add.at(c_theta, (field, m, nat[:, t], kind[at, t, np.maximum(v, 0)], score[:, m]), np.where(v >= 0, w, 0.0))
                for b in range(m):
                    both = wrong[:, m] & wrong[:, b]
                    pairs[b, m] += w[both].sum()
                    twins[b, m] += w[both & (val[:, b] == v)].sum()
        return np.concatenate([c_theta.ravel(), c_prior.ravel(), twins.ravel(), pairs.ravel()])

    def update(self, flat: np.ndarray) -> None:
        """Posteriors of everything but the items, from the expected counts of a round."""
        a, b, m2 = self.theta.size, self.prior.size, self.methods**2
        counted = flat[:a].reshape(self.theta.shape)
        twins, pairs = flat[a + b : a + b + m2].reshape(self.same.shape), flat[a + b + m2 : a + b + 2 * m2].reshape(self.same.shape)
        self.prior = expected_log(flat[a : a + b].reshape(self.prior.shape) + 0.5, (1,))
        self.same = np.exp(digamma(twins + 1.0) - digamma(pairs + 6.0))
        own = counted.reshape(self.fields * self.methods, NATURES, K, SCORES)
        people = len(own)
        if self.member is None:
            # communities begin as ranges of the share of equal readings, softly
            share = (own[:, :, 0].sum(axis=(1, 2)) + 3.0) / (own.sum(axis=(1, 2, 3)) + 4.0)
            place = np.argsort(np.argsort(share)) * COMMUNITIES // people
            self.member = np.full((people, COMMUNITIES), 0.1 / COMMUNITIES)
            self.member[np.arange(people), place] += 0.9
        base = own.sum(axis=0) + 0.05
        base = SHARED * base / base.sum(axis=(1, 2), keepdims=True)
        for _ in range(50):
            shared = base + np.einsum("ac,anks->cnks", self.member, own)
            fit = expected_log(1.0 + self.member.sum(axis=0), (0,)) + np.einsum("anks,cnks->ac", own, expected_log(shared, (2, 3)))
            fit = np.exp(fit - fit.max(axis=1, keepdims=True))
            fit /= fit.sum(axis=1, keepdims=True)
            moved, self.member = np.abs(fit - self.member).max(), fit
            if moved < 1e-6:
                break
        mean = shared / shared.sum(axis=(2, 3), keepdims=True)
        mixed = np.einsum("ac,cnks->anks", self.member, mean)
        self.theta = expected_log(own + STRENGTH * mixed, (2, 3)).reshape(self.theta.shape)
        self.community = self.member.argmax(axis=1).reshape(self.fields, self.methods)
        self.seen = own.sum(axis=(1, 2, 3)).reshape(self.fields, self.methods)
        equal = own[:, :, 0].sum(axis=(1, 2)) + STRENGTH * mixed[:, :, 0].sum(axis=2).mean(axis=1)
        self.reliability = (equal / (own.sum(axis=(1, 2, 3)) + STRENGTH)).reshape(self.fields, self.methods)


def fit(patterns: DataFrame, fields: int, methods: int, rounds: int = ROUNDS) -> Model:
    """patterns: (pattern, n). Each round is one pass; only the sums of the model's cells (a fixed number) come to the driver. Ends when the evidence has settled."""
    model = Model(fields, methods, int(1 / SHARE))
    before = -np.inf
    for _ in range(rounds if methods else 0):

        def expect(batches: Iterator[pd.DataFrame], model=model) -> Iterator[pd.DataFrame]:
            total = None
            for b in batches:
                if len(b):
                    x, n = unpack(b["pattern"].tolist(), methods), b["n"].to_numpy(float)
                    p, evidence = model.posterior(*x)
                    c = np.append(model.counts(p, n, *x), (evidence * n).sum())
                    total = c if total is None else total + c
            if total is not None:
                at = np.flatnonzero(total)
                yield pd.DataFrame({"i": at, "x": total[at]})

        sums = patterns.mapInPandas(expect, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).toPandas()
        flat = np.zeros(model.cells)
        flat[sums["i"].to_numpy(int)] = sums["x"].to_numpy()
        model.update(flat[:-1])
        if flat[-1] - before < SETTLED * abs(flat[-1]) or not len(sums):
            break
        before = flat[-1]
    return model


def consensus(campos: DataFrame, fields: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(items, annotators).

    items: (documento_id, campo, valor, p, acuerdo, n_metodos, n_valores); acuerdo is the share of pairs of methods
    that agree (1.0 with a single method). annotators: (metodo, campo, comunidad, lecturas, fiabilidad). Deleted, null
    and blank readings and those without method drop out; equal readings of repeated rows count once per method; an
    empty table gives empty items and no annotators.
    """
    fields = fields or CONSENSUS_FIELDS
    spark = campos.sparkSession
    readings = cut(latest_readings(campos, fields))
    methods = sorted(r[0] for r in readings.select("metodo").distinct().collect())
    size = len(methods)
    items = cut(item_patterns(readings, fields, methods or [""]))
    patterns = cut(items.groupBy("pattern").agg(F.count("*").alias("n")))
    model = fit(patterns, len(fields), size)

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = unpack(b["pattern"].tolist(), size)
                p, _ = model.posterior(*x)
                val = x[2]
                there = val >= 0
                read = there.sum(axis=1)
                each = [((val == t) & there).sum(axis=1) for t in range(size)]
                same, pairs = sum(k * (k - 1) for k in each), read * (read - 1)
                best = p.argmax(axis=1)
                yield pd.DataFrame({"documento_id": b["documento_id"].to_numpy(), "campo": b["campo"].to_numpy(), "valor": [v[i] for v, i in zip(b["vals"], best)], "p": p.max(axis=1), "acuerdo": np.where(pairs > 0, same / np.maximum(pairs, 1), 1.0), "n_metodos": read, "n_valores": x[1]})

    decided = items.mapInPandas(decide, "documento_id long, campo string, valor string, p double, acuerdo double, n_metodos long, n_valores long")
    table = [(m, f, int(model.community[i, j]), float(model.seen[i, j]), float(model.reliability[i, j])) for i, f in enumerate(fields) for j, m in enumerate(methods)]
    return decided, spark.createDataFrame(table, "metodo string, campo string, comunidad int, lecturas double, fiabilidad double")


def p1_consensus(spark, folder: str) -> DataFrame:
    return consensus(read_table(spark, folder, "campos").where("documento_id <> 1"))[0]


def p1_annotators(spark, folder: str) -> DataFrame:
    return consensus(read_table(spark, folder, "campos").where("documento_id <> 1"))[1]


def p1_found(spark, folder: str) -> DataFrame:
    return p1_consensus(spark, folder).where("n_valores >= 2").select("documento_id", "campo", "valor")
