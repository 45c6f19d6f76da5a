"""One surviving value per field for every group of duplicate files, by currency reasoning (problem 6).

Readings of one value (misread or cut-off forms of it) are first joined into a version; placeholders stand for no value.
Versions of a group are ordered in time by their timestamps. Where these are missing, precedence learned from the
timestamped versions takes their place: it is counted which class of values (a recurring value, else its outline) was
followed by which, and which standing (completeness, trust, place in the order of registration) by which. The significant
transitions, strongest first and without those that would close a cycle, are the precedence of a field; with a group's
timestamps it gives the group's partial order, standings deciding where values do not, and the topologically latest
version survives, in its best-read form. All steps are aggregations or equi-joins on (group, field, ...) keys after combining equal values, so a group that
holds a third of all rows stays split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fojas.functions.reading import blank_to_null, canonical_field
from fojas.llm.misread import skeleton
from fojas.session import cut, read_table

SURVIVOR_FIELDS = ["direccion_comprador", "modelo", "n_motor", "n_chasis", "telefono_comprador", "num_contrato"]
# Words that stand for a missing value.
PLACEHOLDERS = ["S/I", "N/I", "N/A", "NO INDICA", "SIN DATO", "PENDIENTE", "ILEGIBLE", "0", "?", "-", "---", "XX", "XXX", "XXXX", "XXXXX"]
#: Leading characters within which cut-off forms are looked for.
STEM = 4
#: Share of a field's versions from which a value or an outline is a class of its own: at most 2/KIND a field.
KIND = 0.02
#: How many standard deviations more often a transition was seen than its reverse, for it to count.
SIGNIFICANT = 2.0


def file_groups(documents: DataFrame) -> DataFrame:
    """(documento_id, hash_archivo, grupo, registrado): documents whose file is registered at least twice; grupo is the smallest id."""
    sizes = documents.where(F.col("hash_archivo").isNotNull()).groupBy("hash_archivo").agg(F.min("id").alias("grupo"), F.count("*").alias("n")).where("n > 1")
    return documents.select(F.col("id").alias("documento_id"), "hash_archivo", F.col("created_at").alias("registrado")).join(sizes.drop("n"), "hash_archivo")


def shape(v: Column) -> Column:
    """Outline of a value: its letters and digits by one sign each."""
    return F.regexp_replace(F.regexp_replace(F.upper(v), r"\p{L}", "A"), r"\d", "9")


def grouped_values(consolidated: DataFrame, campos: DataFrame, documents: DataFrame, fields: list[str]) -> DataFrame:
    """Equal values of a group's field in one row: (grupo, campo, v, creado, registrado, n, score, trust)."""
    groups = file_groups(documents)
    rows = (
        consolidated.where(F.col("deleted_at").isNull()).select("documento_id", canonical_field(F.col("campo")).alias("campo"), "metodo", blank_to_null(F.col("valor")).alias("v"), "created_at")
        .where(F.col("v").isNotNull() & F.col("campo").isin(fields)).join(groups, "documento_id")
    )
    scores = (
        campos.where(F.col("deleted_at").isNull()).withColumn("campo", canonical_field(F.col("campo"))).where(F.col("campo").isin(fields)).join(groups.select("documento_id"), "documento_id", "left_semi")
        .groupBy("documento_id", "campo", "metodo", blank_to_null(F.col("valor")).alias("v")).agg(F.max("score").alias("score"))
    )
    scored = rows.join(scores, ["documento_id", "campo", "metodo", "v"], "left")
    return scored.groupBy("grupo", "campo", "v").agg(
        F.max("created_at").alias("creado"), F.max("registrado").alias("registrado"), F.count("*").alias("n"), F.coalesce(F.avg("score"), F.lit(0.5)).alias("score")
    )


def versions(values: DataFrame, fields: int) -> DataFrame:
    """Adds version (the skeleton of the full value a form belongs to), vacia (stands for no value) and shaped (share of the field's values with the form's outline)."""
    outline = values.withColumn("shape", shape(F.col("v")))
    per = outline.groupBy("campo", "shape").agg(F.count("*").alias("k"))
    total = outline.groupBy("campo").agg(F.count("*").alias("all"))
    usual = per.join(F.broadcast(total), "campo").select("campo", "shape", (F.col("k") / F.col("all")).alias("shaped"))
    # a value that stands under at least half of the fields, under none of them mostly, names none of them
    by_field = values.groupBy("v", "campo").agg(F.count("*").alias("k")).groupBy("v").agg(F.count("*").alias("fields"), F.sum("k").alias("k"), F.max("k").alias("most"))
    shared = by_field.where((F.col("fields") >= max(3, fields // 2)) & (F.col("most") <= 0.6 * F.col("k"))).select("v", F.lit(True).alias("shared"))
    marked = outline.join(usual, ["campo", "shape"], "left").join(shared, "v", "left")
    empty = F.upper("v").isin(PLACEHOLDERS) | F.coalesce("shared", F.lit(False))
    sk = skeleton(F.regexp_replace("v", r"\s+", " "))
    near = Window.partitionBy("grupo", "campo", F.substring("sk", 1, STEM)).orderBy("sk")
    rest = near.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    keyed = marked.select("grupo", "campo", "v", "creado", "registrado", "n", "score", F.coalesce("shaped", F.lit(0.0)).alias("shaped"), empty.alias("vacia"), sk.alias("sk"))
    following = F.first(F.when(F.col("sk") != F.col("next"), F.col("next")), ignorenulls=True).over(rest)
    cutoff = keyed.withColumn("next", F.lead("sk").over(near)).withColumn("after", following)
    full = F.first(F.when(~F.startswith(F.coalesce("after", F.lit("")), F.col("sk")) | F.col("vacia"), F.col("sk")), ignorenulls=True).over(rest)
    return cutoff.withColumn("version", F.when(F.col("vacia"), F.col("sk")).otherwise(full)).drop("next", "after")


def classes(per: DataFrame) -> DataFrame:
    """Adds kind (the version's value if it recurs, else its outline if that does, else null) and standing in the group (as long as the longest or shorter, well read or not, registered first, last or between)."""
    full = per.where("not vacia")
    total = full.groupBy("campo").agg(F.count("*").alias("all"))
    kinds = full.select("campo", F.explode(F.array(F.concat(F.lit("="), "version"), F.concat(F.lit("~"), shape(F.col("version"))))).alias("kind")).groupBy("campo", "kind").agg(F.count("*").alias("k"))
    own = kinds.join(F.broadcast(total), "campo").where(F.col("k") >= F.col("all") * KIND).select("campo", "kind")
    named = full.withColumns({"as_value": F.concat(F.lit("="), "version"), "as_shape": F.concat(F.lit("~"), shape(F.col("version")))})
    for name in ("as_value", "as_shape"):
        named = named.join(F.broadcast(own.select("campo", F.col("kind").alias(name), F.lit(True).alias("own_" + name))), ["campo", name], "left")
    kind = F.when(F.col("own_as_value"), F.col("as_value")).when(F.col("own_as_shape"), F.col("as_shape"))
    ends = full.groupBy("grupo", "campo").agg(F.min("registrado").alias("first"), F.max("registrado").alias("last"), F.max(F.length("version")).alias("longest"))
    place = F.when(F.col("first") == F.col("last"), "o").when(F.col("registrado") == F.col("last"), "z").when(F.col("registrado") == F.col("first"), "a").otherwise("m")
    standing = F.concat(F.when(F.length("version") == F.col("longest"), "w").otherwise("c"), F.when(F.col("score") >= 0.2, "t").otherwise("u"), place)
    return named.join(ends, ["grupo", "campo"]).select(*per.columns, kind.alias("kind"), standing.alias("standing"))


def acyclic(edges: list[tuple[str, str, float]]) -> tuple[set[tuple[str, str]], dict[str, int]]:
    """Transitive closure and depths of edges (a before b, weight), taken strongest first; one that would close a cycle is left out."""
    after: dict[str, set[str]] = {}
    before: dict[str, set[str]] = {}
    for a, b, _ in sorted(edges, key=lambda e: (-e[2], e[0], e[1])):
        if a == b or a in after.get(b, ()):
            continue
        sources, targets = before.get(a, set()) | {a}, after.get(b, set()) | {b}
        for x in sources:
            after.setdefault(x, set()).update(targets)
        for y in targets:
            before.setdefault(y, set()).update(sources)
    closure = {(a, b) for a, bs in after.items() for b in bs}
    return closure, {b: len(xs) for b, xs in before.items()}


def precedence(full: DataFrame, cls: str) -> DataFrame:
    """(campo, a, b): class a is older than class b, learned from versions (grupo, campo, version, creado, and the class in column cls) with timestamps.

    Each older version is set against its group's latest. The classes of a field are bounded by KIND, so their
    transitions are few whatever the data; they are put in order on the driver.
    """
    dated = full.where(F.col("creado").isNotNull())
    latest = dated.groupBy("grupo", "campo").agg(F.max_by(cls, F.struct("creado", "version")).alias("b"), F.max("creado").alias("top"))
    seen = dated.join(latest, ["grupo", "campo"]).where((F.col("creado") < F.col("top")) & F.col(cls).isNotNull() & F.col("b").isNotNull())
    counts = {(r["campo"], r["a"], r["b"]): r["k"] for r in seen.groupBy("campo", F.col(cls).alias("a"), "b").agg(F.count("*").alias("k")).collect()}
    rules: dict[str, list] = {}
    for (campo, a, b), k in counts.items():
        back = counts.get((campo, b, a), 0)
        if a != b and (z := (k - back) / (k + back) ** 0.5) >= SIGNIFICANT:
            rules.setdefault(campo, []).append((a, b, z))
    rows = [(campo, a, b) for campo, edges in sorted(rules.items()) for a, b in sorted(acyclic(edges)[0])]
    return full.sparkSession.createDataFrame(rows, "campo string, a string, b string")


def behind(open_: DataFrame, rules: DataFrame, cls: str) -> DataFrame:
    """(grupo, campo, version) of open_ that the partial order puts before another one of their group.

    A dated version is before every later one. A version without timestamp is before those of a class that its class
    precedes. The latest dated version is before one without timestamp only if that one isn't itself before some dated
    version, as that would close a cycle against the timestamps.
    """
    key = ["grupo", "campo"]
    ruled = open_.select(*key, "version", "creado", "top", F.col(cls).alias("a")).join(rules, ["campo", "a"])
    undated = ruled.where(F.col("creado").isNull())
    present = open_.select(*key, F.col(cls).alias("b"), F.col("creado").isNotNull().alias("dated")).distinct()
    met = undated.join(present, [*key, "b"]).groupBy(*key, "version").agg(F.max("dated").alias("dated"))
    free = open_.where(F.col("creado").isNull()).join(met.where("dated"), [*key, "version"], "left_anti").select(*key, F.col(cls).alias("b")).distinct()
    head = ruled.where(F.col("creado") == F.col("top")).join(free, [*key, "b"]).select(*key, "version")
    older = open_.where(F.col("creado") < F.col("top")).select(*key, "version")
    return met.select(*key, "version").union(head).union(older).distinct()


def superseded(full: DataFrame) -> DataFrame:
    """(grupo, campo, version, before) of the groups that hold a version without timestamp: what values' precedence puts behind, then what standings put behind among the rest."""
    key = ["grupo", "campo"]
    undated = full.groupBy(*key).agg(F.count(F.when(F.col("creado").isNull(), 1)).alias("u"), F.max("creado").alias("top")).where("u > 0").select(*key, "top")
    open_ = cut(full.join(undated, key))
    by_value = cut(behind(open_, precedence(full, "kind"), "kind"))
    rest = open_.join(by_value, [*key, "version"], "left_anti")
    return by_value.union(behind(rest, precedence(full, "standing"), "standing")).withColumn("before", F.lit(True))


def survivors(consolidated: DataFrame, campos: DataFrame, documents: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """(documento_id, campo, valor, n_valores, n_versiones): the surviving value per group of equal files and field.

    documento_id is the smallest of the group. Deleted, null and blank rows drop out; groups whose rows all drop out
    have no row; a placeholder survives only where nothing else is there. Among versions that the partial order leaves
    latest, dated ones come first, by their time; ties: later registration, then more rows, then the better-read, then
    the value of larger hash.
    """
    fields = fields or SURVIVOR_FIELDS
    v = cut(versions(grouped_values(consolidated, campos, documents, fields), len(fields)))
    # a cut-off form never represents its version: the full skeleton comes first
    best = F.max_by("v", F.struct((F.col("sk") == F.col("version")).alias("full"), F.struct((F.col("score") >= 0.2).alias("ok"), "shaped", "n", "score", F.negative(F.length("v")), F.hash("v"))))
    per = v.groupBy("grupo", "campo", "version").agg(
        F.max("creado").alias("creado"), F.max("registrado").alias("registrado"), F.sum("n").alias("n"), F.min("vacia").alias("vacia"), F.max("score").alias("score"), best.alias("valor"), F.count("*").alias("forms")
    )
    per = cut(per)
    judged = per
    if not per.where("creado is null and not vacia").isEmpty():
        judged = per.join(superseded(cut(classes(per))), ["grupo", "campo", "version"], "left")
    else:
        judged = per.withColumn("before", F.lit(False))
    rank = F.struct(~F.col("vacia"), ~F.coalesce("before", F.lit(False)), F.coalesce("creado", F.to_timestamp(F.lit("0001-01-01"))), F.coalesce("registrado", F.to_timestamp(F.lit("0001-01-01"))), "n", "score", F.hash("valor"))
    return judged.groupBy("grupo", "campo").agg(F.max_by("valor", rank).alias("valor"), F.sum("forms").alias("n_valores"), F.count("*").alias("n_versiones")).select(F.col("grupo").alias("documento_id"), "campo", "valor", "n_valores", "n_versiones")


def held_out_currency(consolidated: DataFrame, campos: DataFrame, documents: DataFrame, fields: list[str] | None = None, one_in: int = 4) -> DataFrame:
    """(campo, grupos, iguales, cuota): of the groups with several versions whose timestamps were taken away (one in so many, by hash), how many keep the value that their timestamps gave."""
    groups = file_groups(documents)
    blind = groups.where(F.pmod(F.xxhash64("grupo"), F.lit(one_in)) == 0).select("documento_id", F.lit(True).alias("blind"))
    hidden = consolidated.join(blind, "documento_id", "left").withColumn("created_at", F.when(F.col("blind").isNull(), F.col("created_at"))).drop("blind")
    truth = survivors(consolidated, campos, documents, fields).where("n_versiones >= 2")
    got = survivors(hidden, campos, documents, fields).select("documento_id", "campo", F.col("valor").alias("got"))
    met = truth.join(got, ["documento_id", "campo"]).join(groups.join(blind, "documento_id").select(F.col("grupo").alias("documento_id")).distinct(), "documento_id", "left_semi")
    return met.groupBy("campo").agg(F.count("*").alias("grupos"), F.count_if(F.col("valor") == F.col("got")).alias("iguales")).withColumn("cuota", F.col("iguales") / F.col("grupos"))


def p6_survivors(spark, folder: str) -> DataFrame:
    return survivors(read_table(spark, folder, "consolidada"), read_table(spark, folder, "campos"), read_table(spark, folder, "documentos"))


def p6_found(spark, folder: str) -> DataFrame:
    """Of the groups with several values; the query leaves out documento_id 1."""
    return p6_survivors(spark, folder).where("documento_id <> 1 and n_valores >= 2").select("documento_id", "campo", "valor")


def p6_held_out(spark, folder: str) -> DataFrame:
    return held_out_currency(read_table(spark, folder, "consolidada"), read_table(spark, folder, "campos"), read_table(spark, folder, "documentos"))
