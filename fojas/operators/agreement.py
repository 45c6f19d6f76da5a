"""Scores by agreement of methods on a field."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fojas.functions.text import strip


def agreement_totals(fields: DataFrame, include_deleted: bool = False) -> DataFrame:
    """(documento_id, campo, n_valid, n_distinct, top_k, top): per field the filled readings, their distinct trimmed values, and the most common of these (the smaller at a tie) with its count."""
    rows = fields if include_deleted else fields.where(F.col("deleted_at").isNull())
    v = strip(F.coalesce("valor", F.lit("")))
    per = rows.withColumn("v", v).where(F.col("v") != "").groupBy("documento_id", "campo", "v").agg(F.count("*").alias("k"))
    # most common value: highest count, then smallest text
    return per.groupBy("documento_id", "campo").agg(F.sum("k").alias("n_valid"), F.count("*").alias("n_distinct"), F.max("k").alias("top_k"), F.min_by("v", F.struct(-F.col("k"), F.col("v"))).alias("top"))


def score_by_agreement(fields: DataFrame, doc_id: int | None = None, include_deleted: bool = False) -> DataFrame:
    """(id, documento_id, campo, metodo, valor, score) of all rows whose field has a filled value.

    All values different (one value alone too): 0.2 each. Otherwise the most common 1.0, others 0.3. Blanks 0.0.
    Counts combine before they are shuffled, and rows meet them by an equi-join, so a hot document is no one group.
    """
    rows = fields if include_deleted else fields.where(F.col("deleted_at").isNull())
    if doc_id is not None:
        rows = rows.where(F.col("documento_id") == doc_id)
    total = agreement_totals(rows, include_deleted=True)
    v = strip(F.coalesce("valor", F.lit("")))
    score = F.when(v == "", 0.0).when(F.col("n_valid") == F.col("n_distinct"), 0.2).when(v == F.col("top"), 1.0).otherwise(0.3)
    return rows.join(total, ["documento_id", "campo"]).select("id", "documento_id", "campo", "metodo", "valor", score.alias("score"))


def agreement_summary(fields: DataFrame) -> DataFrame:
    """Per field: items, items with disagreement, mean share of the most common value."""
    per = agreement_totals(fields)
    return per.groupBy("campo").agg(F.count("*").alias("items"), F.count_if(F.col("n_distinct") > 1).alias("disputed"), F.round(F.avg(F.col("top_k") / F.col("n_valid")), 6).alias("mean_top_share"))
