"""Best value per document and field, wide publication, and what goes with them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fojas.functions.normalize import publish_date
from fojas.functions.text import strip
from fojas.schema import FIELDS
from fojas.session import cut

#: Rank of methods among equal scores; methods not listed rank last.
METHOD_RANK = {"easyocr": 3, "doctr": 2, "paddleocr": 1}


def live(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("deleted_at").isNull())


def wanted(doc_id: int | None = None, campo: str | None = None) -> Column:
    """Optional conjuncts of a run (FLT5)."""
    parts = [F.lit(True)] + ([F.col("documento_id") == doc_id] if doc_id is not None else []) + ([F.col("campo") == campo] if campo is not None else [])
    return reduce(lambda a, b: a & b, parts)


def rank_of(metodo: Column, ranks: dict[str, int]) -> Column:
    out = F.lit(0)
    for m, r in ranks.items():
        out = F.when(metodo == m, r).otherwise(out)
    return out


def consolidate(fields: DataFrame, docs: DataFrame | None = None, doc_id: int | None = None, campo: str | None = None, include_deleted: bool = False, states: list[int] | None = None, method_rank: dict[str, int] | None = None) -> DataFrame:
    """(documento_id, campo, valor, metodo, score): the highest-scored filled value of each document and field (TOP1).

    Ties go to the method's rank, then its name, the smaller value and id. Null scores rank last. With docs and states
    only documents in these states count (a semi-join). Aggregated with partial combination: no group is sorted or
    collected, however many readings one document has.
    """
    rows = fields if include_deleted else live(fields)
    rows = rows.where(wanted(doc_id, campo) & F.col("valor").isNotNull() & (F.col("valor") != ""))
    if docs is not None:
        kept = docs.where(F.col("estado").isin(states)) if states else docs
        rows = rows.join(kept.select(F.col("id").alias("documento_id")), "documento_id", "left_semi")
    rank = rank_of(F.col("metodo"), method_rank or METHOD_RANK)
    # smallest of: negated score (null last), negated rank, then the texts
    key = F.struct(F.coalesce(-F.col("score"), F.lit(float("inf"))).alias("s"), (-rank).alias("r"), F.col("metodo"), F.col("valor"), F.col("id"))
    return rows.groupBy("documento_id", "campo").agg(F.min_by(F.struct("valor", "metodo", "score"), key).alias("x")).select("documento_id", "campo", "x.valor", "x.metodo", "x.score")


def publish_wide(consolidated: DataFrame, docs: DataFrame | None = None, fields: list[str] | None = None) -> DataFrame:
    """One row per document with a column per field, missing ones null (PIV1); the document's date in ISO form; with docs their names in front."""
    fields = fields or FIELDS
    rows = consolidated.where(F.col("campo").isin(fields))
    wide = rows.groupBy("documento_id").pivot("campo", fields).agg(F.max("valor"))
    if "fecha_documento" in fields:
        wide = wide.withColumn("fecha_documento", publish_date(F.col("fecha_documento")))
    if docs is None:
        return wide
    head = docs.select(F.col("id").alias("documento_id"), "nombre_archivo", F.coalesce(F.expr("nullif(archivo_padre, '')"), "nombre_archivo").alias("archivo_padre"), "numero_paginas", "tamano_bytes")
    return head.join(wide, "documento_id").withColumn("metodo", F.lit("script_pdf_copy"))


def latest_by_id(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The live row of highest id per key (TOP2)."""
    others = [c for c in rows.columns if c not in keys]
    return live(rows).groupBy(*keys).agg(F.max_by(F.struct(*others), F.col("id")).alias("x")).select(*keys, "x.*")


def preferred_method(rows: DataFrame, method: str) -> DataFrame:
    """Per document and field the value of the preferred method, else the first seen; order of arrival is the id (TOP3, TOP4)."""
    key = F.struct((F.col("metodo") != method).alias("other"), F.col("id"))
    return rows.where(F.coalesce(strip(F.col("valor")), F.lit("")) != "").groupBy("documento_id", "campo").agg(F.min_by(F.struct("valor", "metodo"), key).alias("x")).select("documento_id", "campo", "x.valor", "x.metodo")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], newest: str) -> DataFrame:
    """Rows of both, for each key the one with the latest newest; at a tie the new row (SNK2, SNK4)."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    others = [c for c in both.columns if c not in keys and c != "_new"]
    # a key may be null: it then counts as a value like any other
    return both.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(F.col(newest), F.col("_new"))).alias("x")).select(*keys, "x.*")


def override_merge(consolidated: DataFrame, overrides: DataFrame) -> DataFrame:
    """Consolidated values with those that people entered in their place (SNK13): an override wins, and adds fields that had none."""
    both = consolidated.select("documento_id", "campo", "valor", F.lit(0).alias("manual")).unionByName(overrides.select("documento_id", "campo", "valor", F.lit(1).alias("manual")))
    return both.groupBy("documento_id", "campo").agg(F.max_by(F.struct("valor", "manual"), F.struct("manual", "valor")).alias("x")).select("documento_id", "campo", "x.valor", "x.manual")


def field_pairs(fields: DataFrame) -> DataFrame:
    """Distinct (documento_id, campo) (AGG1)."""
    return fields.select("documento_id", "campo").distinct()


def field_order(campo: Column) -> Column:
    """Display position of a field, unknown ones last (SRT1)."""
    at = F.array_position(F.array(*[F.lit(f) for f in FIELDS]), campo)
    return F.when(at > 0, at).otherwise(F.lit(len(FIELDS) + 1))


def document_fields(fields: DataFrame, consolidated: DataFrame, doc_id: int, method: str) -> DataFrame:
    """Fields of one document by a method, or the consolidated ones for 'consolidado', in display order (SRC14)."""
    rows = live(consolidated) if method == "consolidado" else live(fields).where(F.col("metodo") == method)
    return rows.where(F.col("documento_id") == doc_id).select("campo", "valor").orderBy(field_order(F.col("campo")), "campo", "valor")


def neighbours(docs: DataFrame) -> DataFrame:
    """(id, anterior, siguiente): the ids before and after each id; its own where there is none (AGG4).

    Ids are sorted into ranges of even size whatever their spread, one per partition; a range's outer neighbours are the
    extremes of the ranges beside it, of which there is one row per partition.
    """
    spark = docs.sparkSession
    ranges = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # written once: the ranges are drawn by sampling, and both uses below must see the same ones
    ids = cut(docs.select("id").where(F.col("id").isNotNull()).distinct().repartitionByRange(ranges, "id").withColumn("b", F.spark_partition_id()))
    own = Window.partitionBy("b").orderBy("id")
    within = ids.withColumn("p", F.lag("id").over(own)).withColumn("n", F.lead("id").over(own))
    order = Window.orderBy("b")
    ends = ids.groupBy("b").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    edges = ends.select("b", F.lag("hi").over(order).alias("before"), F.lead("lo").over(order).alias("after"))
    return within.join(F.broadcast(edges), "b").select("id", F.coalesce("p", "before", "id").alias("anterior"), F.coalesce("n", "after", "id").alias("siguiente"))
