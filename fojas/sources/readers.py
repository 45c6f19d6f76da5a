"""Readers of files and settings."""

from __future__ import annotations

import configparser
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINARY_FILE = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def pdf_files(spark: SparkSession, folder: str, content: bool = True) -> DataFrame:
    """(path, nombre_archivo, length, modificationTime[, content]) of the folder's own PDFs, the ending in any case (SRC1, SRC3). Without content none is read."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").load(folder)
    cols = ["path", F.element_at(F.split("path", "/"), -1).alias("nombre_archivo"), "length", "modificationTime"] + (["content"] if content else [])
    return df.select(*cols)


def ocr_json(spark: SparkSession, folder: str) -> DataFrame:
    """(archivo, texto, pagina) of the newest ocr_datos_*.json by name; either of two key names for file and text (SRC6)."""
    schema = "archivo string, archivo_pdf string, texto_ocr string, texto string, pagina string"
    df = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "ocr_datos_*.json").json(folder).withColumn("_n", F.col("_metadata.file_name"))
    newest = df.agg(F.max("_n").alias("_n"))
    return df.join(F.broadcast(newest), "_n").select(F.coalesce("archivo", "archivo_pdf").alias("archivo"), F.coalesce("texto_ocr", "texto").alias("texto"), "pagina")


def dictionary_csv(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One-column list with header: byte-order mark off, trimmed, upper case, each once. A path that isn't there raises at once (SRC7, SRC13)."""
    df = spark.read.option("header", True).csv(path)
    name = next((c for c in df.columns if c.replace("﻿", "").strip().lower() == column), df.columns[0])
    return df.select(F.upper(F.trim(F.col(f"`{name}`"))).alias(column)).where(f"{column} <> ''").distinct()


def jsonl_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(prompt, response, campos): lines with a JSON object of fields in response; lines that don't parse have null campos (SRC9)."""
    return spark.read.schema("prompt string, response string").json(path).withColumn("campos", F.from_json("response", "map<string,string>"))


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


@dataclass
class Settings:
    """Settings of a run; nothing secret is kept here."""

    batch_files: int = 30
    delay_seconds: int = 5
    min_score: float = 0.4
    methods: tuple[str, ...] = ()


def read_settings(path: str | None = None) -> Settings:
    """From an INI file, the path by argument or FOJAS_CONFIG; missing keys keep their defaults (SRC11)."""
    where = path or os.environ.get("FOJAS_CONFIG")
    ini = configparser.ConfigParser()
    if where and not ini.read(where, encoding="utf-8"):
        raise FileNotFoundError(where)
    flags = ini["metodos"] if ini.has_section("metodos") else {}
    return Settings(
        ini.getint("pipeline", "max_archivos_por_tanda", fallback=30), ini.getint("pipeline", "delay_pipeline", fallback=5),
        ini.getfloat("score", "score_minimo_aceptable", fallback=0.4), tuple(k for k, v in flags.items() if v.strip().lower() in ("1", "true", "si", "yes", "on")),
    )


def enabled_texts(texts: DataFrame, settings: Settings) -> DataFrame:
    """Non-blank texts of enabled methods; all methods if none is named (TXT2, TXT3)."""
    kept = texts.where(F.regexp_replace(F.coalesce("texto_extraccion", F.lit("")), r"(?U)\s", "") != "")
    return kept.where(F.col("metodo").isin(list(settings.methods))) if settings.methods else kept
