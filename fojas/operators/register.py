"""Registration of files: identity, pages, kind and quality, and which rows are new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fojas.functions.text import strip


def register(incoming: DataFrame, registered: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Incoming files that aren't registered under the same hash and name, each once (JOIN5, SNK1)."""
    keys = keys or ["hash_archivo", "nombre_archivo"]
    return incoming.dropDuplicates(keys).join(registered.select(*keys).distinct(), keys, "left_anti")


def with_hashes(files: DataFrame, content: str = "content") -> DataFrame:
    """SHA-256 and MD5 of the content (PDF1)."""
    return files.withColumn("hash_archivo", F.sha2(F.col(content), 256)).withColumn("md5", F.md5(F.col(content)))


def document_kind(first_page_chars: Column) -> Column:
    """Fewer than 500 characters on the first page: a scanned sheet."""
    return F.when(first_page_chars < 500, "escaneado").otherwise("nativo")


def quality(resolution: Column) -> Column:
    """90, 70, 50 or 40 by the mean image resolution (PDF2)."""
    return F.when(resolution >= 300, 90).when(resolution >= 200, 70).when(resolution > 0, 50).otherwise(40)


def mean_resolution(values: Column) -> Column:
    """Mean of an array of image resolutions, 0.0 for none (AGG9)."""
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)).otherwise(0.0)


def parent_name(parent: Column, name: Column) -> Column:
    """A sheet without parent is its own (PDF4, PRJ2)."""
    return F.coalesce(F.when(parent != "", parent), name)


def explode_pages(docs: DataFrame, pages: str, name: str) -> DataFrame:
    """One row per page: several pages are named base_1.pdf, base_2.pdf ... with the file as parent; a single page keeps its name (PDF3). Files without page have no row."""
    many = F.size(pages) > 1
    base = F.regexp_replace(F.col(name), r"(?i)\.pdf$", "")
    rows = docs.select("*", many.alias("_many"), F.posexplode(pages).alias("pagina", "texto_pagina"))
    named = F.when(F.col("_many"), F.concat(base, F.lit("_"), (F.col("pagina") + 1).cast("string"), F.lit(".pdf"))).otherwise(F.col(name))
    return rows.withColumn("archivo_padre", F.col(name)).withColumn("nombre_pagina", named).withColumn("pagina", F.col("pagina") + 1).drop("_many")


def compare_manifest(files: DataFrame, manifest: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """(nombre_archivo, resultado): OK, SKIP (already there), MD5 MISMATCH or ERROR (not delivered) for each file of the manifest (SRC2)."""
    joined = manifest.select("nombre_archivo", F.col("md5").alias("expected")).join(files.select("nombre_archivo", "md5"), "nombre_archivo", "left")
    there = F.lit(False)
    if present is not None:
        joined = joined.join(present.select("nombre_archivo", F.lit(True).alias("there")).distinct(), "nombre_archivo", "left")
        there = F.coalesce("there", F.lit(False))
    return joined.select("nombre_archivo", F.when(there, "SKIP").when(F.col("md5").isNull(), "ERROR").when(F.col("md5") == F.col("expected"), "OK").otherwise("MD5 MISMATCH").alias("resultado"))


def status_counts(results: DataFrame, column: str = "resultado") -> DataFrame:
    """Counts per leading status word (AGG5)."""
    return results.groupBy(F.regexp_extract(column, r"^(OK|SKIP|MD5 MISMATCH|ERROR)", 1).alias("estado")).agg(F.count("*").alias("n"))


def blocks_in_reading_order(blocks: Column) -> Column:
    """Text of page blocks (structs x, y, texto) from top to bottom, left to right (OCR6)."""
    ordered = F.array_sort(F.transform(blocks, lambda b: F.struct(b["y"].alias("y"), b["x"].alias("x"), b["texto"].alias("texto"))))
    return F.array_join(F.transform(ordered, lambda b: b["texto"]), "\n")


def intake_names(files: DataFrame, column: str = "nombre_archivo") -> DataFrame:
    """PDF names in any case, without hidden and temporary ones (SRC3, SRC4, FLT9)."""
    return files.where(F.lower(column).endswith(".pdf") & ~F.col(column).rlike(r"^[.~]"))


def valid_text(content: Column) -> Column:
    """Text of UTF-8 bytes, invalid sequences dropped."""
    return F.replace(F.make_valid_utf8(content.cast("string")), F.lit("�"), F.lit(""))


def native_text(pages: Column) -> Column:
    """Text of a document's pages (an array), each under its header (OCR6)."""
    headed = F.transform(pages, lambda p, i: F.concat(F.lit("\n--- Página "), (i + 1).cast("string"), F.lit(" ---\n"), strip(F.coalesce(p, F.lit(""))), F.lit("\n")))
    return strip(F.array_join(headed, ""))


def upload_result(size: Column, there: Column, force: bool = False) -> Column:
    """Bytes that publishing a file transfers: 0 where it is already there and not forced, -1 where there is nothing to send, else its size (SNK10)."""
    return F.when(size.isNull(), -1).when(there & F.lit(not force), 0).otherwise(size).cast("long")
