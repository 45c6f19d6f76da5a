"""Exports: CSV, JSON, JSONL, HTML, and the split into results and errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fojas.functions.normalize import normalize_field


def write_csv(df: DataFrame, path: str, excel: bool = False) -> None:
    """With header; with excel the header begins with a byte-order mark (SNK6)."""
    out = df.withColumnRenamed(df.columns[0], "﻿" + df.columns[0]) if excel else df
    out.write.mode("overwrite").option("header", True).csv(path)


def filled_map(fields: list[str]) -> Column:
    """Map of the fields that hold something."""
    return F.map_filter(F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f).cast("string"))]), lambda k, v: F.coalesce(v, F.lit("")) != "")


def entities(wide: DataFrame, fields: list[str], name: str = "archivo", text: str = "texto") -> DataFrame:
    """(archivo, texto, entidades) with only the filled fields (SNK7)."""
    return wide.select(F.col(name).alias("archivo"), F.col(text).alias("texto"), filled_map(fields).alias("entidades"))


def prompt_pairs(texts: DataFrame, rows: DataFrame, fields: list[str], instruction: str = "") -> DataFrame:
    """(prompt, response): each text with the JSON object of its document's normalized fields, empty ones as '' (SNK8).

    texts: documento_id, texto_extraccion; rows: documento_id, campo, valor, one row per document and field (others:
    the smallest value counts). A document with other fields only has an object of empty ones. The object is built by one aggregation per document over at most the listed fields.
    """
    named = rows.select("documento_id", "campo", F.when(F.col("campo").isin(fields), normalize_field(F.col("campo"), F.col("valor"))).alias("v"))
    per = named.groupBy("documento_id").agg(*[F.coalesce(F.min(F.when(F.col("campo") == f, F.col("v"))), F.lit("")).alias(f) for f in fields])
    response = per.select("documento_id", F.to_json(F.struct(*fields)).alias("response"))
    return texts.join(response, "documento_id").select("documento_id", F.concat(F.lit(instruction), "texto_extraccion").alias("prompt"), "response")


def html_escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def html_reports(rows: DataFrame) -> DataFrame:
    """(documento_id, html): a table of the document's fields by name (SNK9). rows: one per document and field."""
    cell = F.concat(F.lit("<tr><td>"), html_escape(F.col("campo")), F.lit("</td><td>"), html_escape(F.coalesce("valor", F.lit(""))), F.lit("</td></tr>"))
    body = rows.select("documento_id", "campo", cell.alias("tr")).groupBy("documento_id", "campo").agg(F.min("tr").alias("tr")).groupBy("documento_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("campo", "tr"))), lambda s: s["tr"]), "\n").alias("b"))
    return body.select("documento_id", F.concat(F.lit("<html><body><h1>Documento "), F.col("documento_id").cast("string"), F.lit("</h1><table>\n"), "b", F.lit("\n</table></body></html>")).alias("html"))


def report_files(reports: DataFrame) -> DataFrame:
    """(documento_id, archivo): the reports by the names under which they are served (SNK15); documents without id have none."""
    return reports.where(F.col("documento_id").isNotNull()).select("documento_id", F.concat(F.lit("documento_"), F.col("documento_id").cast("string"), F.lit(".html")).alias("archivo"))


def split_errors(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, dead letters) by the column error (SNK11)."""
    return results.where("error IS NULL").drop("error"), results.where("error IS NOT NULL")
