"""Fill rates, log summaries and run counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fojas.functions.text import strip


def fill_rate(pairs: DataFrame, samples: int = 5, chars: int = 400) -> DataFrame:
    """Per field of (campo, valor, texto): rows, empty ones, their percentage, and the smallest few texts of empty ones, cut (AGG7).

    The texts kept per field are bounded at every step: each task keeps its smallest few, and these meet per field.
    """
    empty = strip(F.coalesce("valor", F.lit(""))) == ""
    rates = pairs.groupBy("campo").agg(F.count("*").alias("total"), F.count_if(empty).alias("vacios")).withColumn("pct_vacios", F.round(100.0 * F.col("vacios") / F.col("total"), 1))
    from pyspark.sql import Window

    short = pairs.where(empty).select("campo", F.substring("texto", 1, chars).alias("t")).distinct()
    salted = short.withColumn("salt", F.pmod(F.hash("t"), F.lit(64)))
    few = salted.withColumn("r", F.row_number().over(Window.partitionBy("campo", "salt").orderBy("t"))).where(F.col("r") <= samples)
    last = few.withColumn("r", F.row_number().over(Window.partitionBy("campo").orderBy("t"))).where(F.col("r") <= samples)
    kept = last.groupBy("campo").agg(F.array_sort(F.collect_list("t")).alias("muestras"))
    return rates.join(kept, "campo", "left").withColumn("muestras", F.coalesce("muestras", F.array().cast("array<string>")))


def parse_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """(ts, nivel, mensaje, fecha) of log lines of both layouts: 'ts | LEVEL | place | text' and 'ts - LEVEL - text'; lines of neither have nulls."""
    v = F.col(column)
    bar = r"^(\d{4}-\d{2}-\d{2}[^|]*?)\s*\|\s*([A-Z]+)\s*\|\s*[^|]*\|\s*(.*)$"
    dash = r"^(\d{4}-\d{2}-\d{2} \S+)\s+-\s+([A-Z]+)\s+-\s+(.*)$"

    def part(k: int) -> Column:
        return F.when(v.rlike(bar), F.regexp_extract(v, bar, k)).when(v.rlike(dash), F.regexp_extract(v, dash, k))

    return lines.select(v.alias("linea"), part(1).alias("ts"), part(2).alias("nivel"), part(3).alias("mensaje"), F.substring(part(1), 1, 10).try_cast("date").alias("fecha"))


def level_per_day(parsed: DataFrame, day: str | None = None) -> DataFrame:
    """Rows per day and level, the levels as columns, 0 where there is none (AGG6, FLT8)."""
    rows = parsed.where(F.col("fecha").isNotNull())
    if day:
        rows = rows.where(F.col("fecha") == F.lit(day).cast("date"))
    levels = ["INFO", "WARNING", "ERROR"]
    return rows.groupBy("fecha").agg(*[F.count_if(F.col("nivel") == x).alias(x) for x in levels])


def retained(parsed: DataFrame, today: str, days: int) -> DataFrame:
    """Lines not older than so many days; lines without date stay."""
    return parsed.where(F.col("fecha").isNull() | (F.datediff(F.lit(today).cast("date"), F.col("fecha")) <= days))


def day_summary(levels: DataFrame) -> DataFrame:
    """The day-by-level table as fixed-width lines, by day (SNK16)."""
    line = F.concat(F.rpad(F.col("fecha").cast("string"), 12, " "), *[F.lpad(F.col(x).cast("string"), 10, " ") for x in ("INFO", "WARNING", "ERROR")])
    return levels.orderBy("fecha").select("fecha", line.alias("linea"))


def run_totals(results: DataFrame) -> DataFrame:
    """Files and bytes per outcome of (resultado, bytes) (AGG8)."""
    return results.groupBy("resultado").agg(F.count("*").alias("archivos"), F.sum("bytes").alias("bytes"))


def summary_mail(lines: DataFrame, subject: str = "Resumen de registros") -> DataFrame:
    """(asunto, cuerpo): the message of a summary (fecha, linea), a line per day (SNK14); sending it is left to the caller. One row, of a line for each day that the logs span; without lines none."""
    sorted_ = F.array_sort(F.collect_list(F.struct("fecha", "linea")))
    return lines.groupBy(F.lit(subject).alias("asunto")).agg(F.array_join(F.transform(sorted_, lambda s: s["linea"]), "\n").alias("cuerpo"))
