"""State as a column of an immutable table version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def advance(docs: DataFrame, touched: DataFrame, to: int, expected: int | None = None) -> DataFrame:
    """docs with estado set for the touched ids (documento_id) that are in the expected state; the others stay (SNK12)."""
    ids = touched.select(F.col("documento_id").alias("_id"), F.lit(True).alias("_hit")).distinct()
    hit = F.coalesce("_hit", F.lit(False)) & (F.lit(True) if expected is None else F.col("estado") == expected)
    return docs.join(ids, docs["id"] == ids["_id"], "left").withColumn("estado", F.when(hit, to).otherwise(F.col("estado"))).drop("_id", "_hit")


def pending_texts(texts: DataFrame, docs: DataFrame, state: int = 2, force_id: int | None = None) -> DataFrame:
    """Texts of live documents in a state, with the document's name; a forced id is read whatever its state (JOIN1, SRC5)."""
    named = docs.select(F.col("id").alias("documento_id"), "nombre_archivo", F.col("estado").alias("estado_documento"), F.col("deleted_at").alias("_gone"))
    rows = texts.join(named, "documento_id")
    keep = F.col("documento_id") == force_id if force_id is not None else (F.col("estado_documento") == state) & F.col("_gone").isNull() & F.col("deleted_at").isNull()
    return rows.where(keep).drop("_gone")


def unscored(fields: DataFrame) -> DataFrame:
    """Rows without score or with 0 (FLT3)."""
    return fields.where(F.col("score").isNull() | F.isnan("score") | (F.col("score") == 0))


def soft_delete(rows: DataFrame, ids: DataFrame, when: str, key: str = "documento_id") -> DataFrame:
    """rows with deleted_at set for the given keys where it is null."""
    gone = ids.select(F.col(key), F.lit(True).alias("_gone")).distinct()
    return rows.join(gone, key, "left").withColumn("deleted_at", F.when(F.col("deleted_at").isNull() & F.col("_gone"), F.lit(when).cast("timestamp")).otherwise(F.col("deleted_at"))).drop("_gone").select(*rows.columns)
