"""The stages in order, in batch or per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fojas.functions.score import score_reading
from fojas.operators.agreement import score_by_agreement
from fojas.operators.consolidate import consolidate, live, publish_wide
from fojas.operators.extraction import Dictionaries, extract_rows
from fojas.operators.state import unscored
from fojas.schema import STATES
from fojas.streaming.intake import run_stream


def score_fields(fields: DataFrame, year: int, doc_id: int | None = None, rules: str = "effective", only_unscored: bool = True) -> DataFrame:
    """fields with score filled in by rule where it is missing or 0 (SC16). year: the current year."""
    new = score_reading(F.col("campo"), F.col("valor"), F.col("metodo"), year, rules)
    here = F.lit(True) if doc_id is None else F.col("documento_id") == doc_id
    open_ = (F.col("score").isNull() | F.isnan("score") | (F.col("score") == 0)) if only_unscored else F.lit(True)
    return fields.withColumn("score", F.when(here & open_, new).otherwise(F.col("score")))


def below_minimum(fields: DataFrame, minimum: float = 0.4) -> DataFrame:
    """Rows whose score isn't acceptable (SC17)."""
    return fields.where(F.coalesce("score", F.lit(0.0)) < minimum)


def run_batch(texts: DataFrame, year: int, dictionaries: Dictionaries | None = None, agreement_first: bool = False) -> dict[str, DataFrame]:
    """texts (documento_id, metodo, texto_extraccion) -> fields, scored, consolidated, wide; lazy throughout, no stage is written in between."""
    ids = F.xxhash64("documento_id", "metodo", "campo")
    fields = extract_rows(texts, dictionaries).withColumn("id", ids).withColumn("deleted_at", F.lit(None).cast("timestamp"))
    if agreement_first:
        fields = fields.drop("score").join(score_by_agreement(fields).select("id", "score"), "id", "left")
    scored = score_fields(fields, year)
    best = consolidate(scored)
    return {"fields": fields, "scored": scored, "consolidated": best, "wide": publish_wide(best)}


def to_publish(docs: DataFrame, name: str | None = None, every: bool = False, force: bool = False) -> DataFrame:
    """Live documents to be published: consolidated ones that aren't yet; name: this file only; every: whatever their state from consolidated on; force: those published before too."""
    rows = docs.where(F.col("deleted_at").isNull() & (F.col("estado") >= STATES["consolidated"] if every or force else F.col("estado") == STATES["consolidated"]) & (F.col("estado") != STATES["error"]))
    if not force:
        rows = rows.where(~F.coalesce("copiado_remoto", F.lit(False)))
    return rows if name is None else rows.where(F.col("nombre_archivo") == name)


def publish(docs: DataFrame, consolidated: DataFrame, name: str | None = None, every: bool = False, force: bool = False, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(wide, docs): the wide rows of the documents to be published, and docs with these in the state published.

    Written to path as Parquet if one is given; without it nothing is written (a dry run).
    """
    chosen = to_publish(docs, name, every, force)
    wide = publish_wide(live(consolidated), chosen)
    if path is not None:
        wide.write.mode("append" if name else "overwrite").parquet(path)
    done = wide.select(F.col("documento_id").alias("_id"), F.lit(True).alias("_done")).distinct()
    new = docs.join(done, docs["id"] == done["_id"], "left")
    hit = F.coalesce("_done", F.lit(False))
    return wide, new.withColumns({"estado": F.when(hit, STATES["published"]).otherwise(F.col("estado")), "copiado_remoto": F.when(hit, True).otherwise(F.col("copiado_remoto"))}).select(*docs.columns)


def run_pipeline(spark: SparkSession, texts: str, out: str, year: int, mode: str = "batch", dictionaries: Dictionaries | None = None, checkpoint: str | None = None, seconds: int | None = None) -> StreamingQuery | None:
    """Texts of a Parquet folder to fields, consolidated values and wide rows under out: all at once, or as files arrive (mode stream).

    A stream writes each micro-batch under its number, so a batch that is run again replaces what it wrote before;
    without seconds it works off what is there and ends.
    """
    if mode not in ("batch", "stream"):
        raise ValueError(f"no mode {mode}")

    def step(rows: DataFrame, batch: int | None = None) -> None:
        done = run_batch(rows, year, dictionaries)
        # written once and read again, as what follows stands on it
        at = "" if batch is None else f"/batch={batch}"
        done["scored"].write.mode("overwrite").parquet(f"{out}/fields{at}")
        best = consolidate(rows.sparkSession.read.parquet(f"{out}/fields{at}"))
        best.write.mode("overwrite").parquet(f"{out}/consolidated{at}")
        publish_wide(rows.sparkSession.read.parquet(f"{out}/consolidated{at}")).write.mode("overwrite").parquet(f"{out}/wide{at}")

    if mode == "batch":
        step(spark.read.parquet(texts))
        return None
    stream = spark.readStream.schema(spark.read.parquet(texts).schema).parquet(texts)
    return run_stream(stream, step, checkpoint or f"{out}/_checkpoint", seconds)


__all__ = ["below_minimum", "publish", "run_batch", "run_pipeline", "score_fields", "to_publish", "unscored"]
