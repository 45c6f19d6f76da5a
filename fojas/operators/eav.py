"""Attribute-value rows into one wide, typed row per entity, and back (problem 4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fojas.functions.reading import blank_to_null, canonical_field, literal_map, read_date, read_integer
from fojas.schema import FIELD_KINDS, FIELDS

SQL_TYPES = {"int": "bigint", "double": "double", "date": "date", "string": "string"}


def read_decimal(c: Column) -> Column:
    """Number with a decimal comma or point, or null (fields kept as double)."""
    t = F.regexp_replace(blank_to_null(c), r"[^0-9.,]", "")
    t = F.when(t.rlike(r"^\d{1,3}(?:[.,]\d{3})+$"), F.regexp_replace(t, "[.,]", "")).otherwise(F.regexp_replace(t, ",", "."))
    return t.try_cast("double")


def typed_text(kind: Column, value: Column) -> Column:
    """The value in its field's plain written form, null if it can't be read as the field's kind."""
    return (
        F.when(kind == "int", read_integer(value).cast("string"))
        .when(kind == "date", F.date_format(read_date(value), "yyyy-MM-dd"))
        .when(kind == "double", read_decimal(value).cast("string"))
        .otherwise(blank_to_null(value))
    )


def best_readings(rows: DataFrame, fields: list[str], kinds: dict[str, str]) -> DataFrame:
    """(documento_id, pos, v): of the live readings of each field the form read most often; ties go to the higher score, then to the smaller text.

    Both aggregations combine before they shuffle, so a document that holds a third of all rows sends no more
    than a row per field, value and task.
    """
    pos = literal_map({f: i + 1 for i, f in enumerate(fields)})
    kind = literal_map({f: kinds.get(f, "string") for f in fields})
    named = rows.where(F.col("deleted_at").isNull() & F.col("documento_id").isNotNull()).select(
        "documento_id", canonical_field(F.col("campo")).alias("campo"), "valor", F.coalesce(F.col("score"), F.lit(0.0)).alias("score")
    )
    read = named.where(F.col("campo").isin(fields)).select(
        "documento_id", F.element_at(pos, F.col("campo")).alias("pos"), typed_text(F.element_at(kind, F.col("campo")), F.col("valor")).alias("v"), "score"
    )
    counted = read.where(F.col("v").isNotNull()).groupBy("documento_id", "pos", "v").agg(F.count("*").alias("n"), F.max("score").alias("s"))
    return counted.groupBy("documento_id", "pos").agg(F.min_by("v", F.struct(-F.col("n"), -F.col("s"), F.col("v"))).alias("v"))


def eav_to_wide(rows: DataFrame, fields: list[str] | None = None, kinds: dict[str, str] | None = None) -> DataFrame:
    """One row per documento_id with a typed column per field.

    rows: documento_id, campo, valor, score, deleted_at; further columns are ignored. Every entity of the input has a
    row, even if none of its values is live or can be read (all null then); rows without documento_id drop out; an
    empty table gives an empty table. Grid: each entity times the fixed list of fields, left-joined to the readings,
    collected in order of position, then fixed indices are cast to their types.
    """
    fields, kinds = fields or FIELDS, kinds or FIELD_KINDS
    best = best_readings(rows, fields, kinds)
    entities = rows.where(F.col("documento_id").isNotNull()).select("documento_id").distinct()
    grid = entities.select("documento_id", F.explode(F.sequence(F.lit(1), F.lit(len(fields)))).alias("pos"))
    cells = grid.join(best, ["documento_id", "pos"], "left")
    packed = cells.groupBy("documento_id").agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("cells"))
    return packed.select(
        "documento_id", *[F.get(F.col("cells"), F.lit(i))["v"].try_cast(SQL_TYPES[kinds.get(f, "string")]).alias(f) for i, f in enumerate(fields)]
    )


def wide_to_eav(wide: DataFrame, ids: list[str], fields: list[str], keep_blank: bool = False) -> DataFrame:
    """(ids, campo, valor) rows; null and blank values drop out unless keep_blank."""
    long = wide.select(*ids, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(ids, fields, "campo", "valor")
    return long if keep_blank else long.where(F.coalesce(F.col("valor"), F.lit("")) != "")


FOUND_FIELDS = ["anio", "asientos", "puertas", "cilindrada", "fecha_documento", "monto_neto", "monto_iva", "monto_total"]


def p4_wide(spark, folder: str) -> DataFrame:
    from fojas.session import read_table

    return eav_to_wide(read_table(spark, folder, "campos").where("documento_id <> 1"))


def p4_found(spark, folder: str) -> DataFrame:
    """The readable numbers and dates of the wide table, one row per (document, field)."""
    wide = p4_wide(spark, folder)
    return wide_to_eav(wide, ["documento_id"], FOUND_FIELDS)
