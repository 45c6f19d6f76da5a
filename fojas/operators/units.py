"""Quantities written in different units, brought to one unit per measure (problem 5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fojas.functions.reading import canonical_field, let, literal_map, plain_upper
from fojas.session import cut, read_table

# Kg per unit of weight, kW per unit of power.
FACTORS = {
    "pbv": {"kg": 1.0, "ton": 1000.0, "lb": 0.45359237},
    "potencia_motor": {"kw": 1.0, "hp": 0.745699872, "cv": 0.73549875, "kcal/s": 4.184, "btu/s": 1.05505585},
}
# Written forms of the units, after upper case, without blanks and dots, misread letters restored.
SPELLINGS = {
    "pbv": {
        "KG": "kg", "KGS": "kg", "KILO": "kg", "KILOS": "kg", "KILOGRAMO": "kg", "KILOGRAMOS": "kg", "T": "ton", "TN": "ton", "TON": "ton",
        "TONS": "ton", "TONELADA": "ton", "TONELADAS": "ton", "MILKG": "ton", "MILKGS": "ton", "MILKILOS": "ton", "MILESDEKILOS": "ton",
        "MILESDEKG": "ton", "LB": "lb", "LBS": "lb", "LIBRA": "lb", "LIBRAS": "lb",
    },
    "potencia_motor": {
        "KW": "kw", "KVV": "kw", "KILOWATT": "kw", "KILOWATTS": "kw", "HP": "hp", "HF": "hp", "CABALLOS": "hp", "CV": "cv", "KCAL/S": "kcal/s",
        "KCALS": "kcal/s", "BTU/S": "btu/s", "BTUS": "btu/s",
    },
}
UNIT_FIELD = {"pbv": "unidad_pbv", "potencia_motor": "unidad_potencia"}
#: Base-unit range in which a value is believed.
RANGE = {"pbv": (500.0, 60000.0), "potencia_motor": (5.0, 1500.0)}
#: Most labelled documents the unit classifier is fitted on, and calibrated on.
TRAIN_ROWS = 20_000
CONFIDENT = 0.9
#: Most values of a category that the classifier tells apart; the rarer ones are one.
CATEGORIES = 30
#: Records on which sheets hang that nobody assigned to a document.
COLLECTING = (1,)


def read_unit(measure: str, c: Column) -> Column:
    """Unit named by a text, or null. Digits within unit words are read as the letters they stand for."""
    letters = F.translate(F.regexp_replace(plain_upper(c), r"[\s.]+", ""), "013568", "OIESGB")
    return F.element_at(literal_map(SPELLINGS[measure]), letters)


def split_quantity(measure: str, c: Column) -> Column:
    """struct(num, unit): the leading number as written (blanks removed), and the unit after it; nulls where absent.

    Letters inside the number that stand for digits are restored; text without a digit in the number gives num null.
    """

    def of(u: Column) -> Column:
        # L and O belong to the number unless they begin a pound word
        pattern = r"^([0-9OIL|](?:(?!L8S?$|LBS?\b|LIBRA)[0-9OQIL|., ])*)(.*)$"
        num = F.regexp_replace(F.translate(F.regexp_extract(u, pattern, 1), "OQIL|", "00111"), r"[., ]+$", "")
        # a space parts thousands only, so it reads as a point
        num = F.regexp_replace(num, " +", ".")
        return F.struct(F.when(num.rlike("[0-9]"), num).alias("num"), read_unit(measure, F.regexp_extract(u, pattern, 2)).alias("unit"))

    return let(plain_upper(c), of)


def base_value(measure: str, num: Column, unit: Column) -> Column:
    """num in the base unit. A separator before three digits may mean thousands or decimals: the reading that puts the value in the believed range is taken, thousands first."""
    low, high = RANGE[measure]
    factor = F.element_at(literal_map(FACTORS[measure]), unit)
    decimal = F.regexp_replace(F.regexp_replace(num, r"[.,](?=.*[.,])", ""), ",", ".").try_cast("double") * factor
    grouped = F.when(num.rlike(r"^\d{1,3}(?:[.,]\d{3})+$"), F.regexp_replace(num, "[.,]", "").try_cast("double") * factor)
    return F.when(grouped.between(low, high), grouped).when(decimal.between(low, high), decimal)


def reading_counts(rows: DataFrame) -> DataFrame:
    """(documento_id, campo, value, own, metodo, n): what the classifier and the conversion look at, one row per document and distinct reading, from one pass over rows (documento_id, campo, metodo, valor).

    value: the number of a quantity, the unit of a unit row, else the plain text; own: the unit within a quantity;
    metodo: the smallest of those that read it.
    """
    v = F.col("valor")
    quantity = [F.when(F.col("campo") == m, split_quantity(m, v)) for m in FACTORS]
    unit = [F.when(F.col("campo") == u, read_unit(m, v)) for m, u in UNIT_FIELD.items()]
    context = F.when(F.col("campo").isin("tipo_vehiculo", "anio"), plain_upper(v))
    read = rows.select("documento_id", "campo", "metodo", F.coalesce(*quantity).alias("q"), F.coalesce(*unit, context).alias("t"))
    read = read.select("documento_id", "campo", F.coalesce("q.num", "t").alias("value"), F.col("q.unit").alias("own"), "metodo").where(F.col("value").isNotNull())
    return read.groupBy("documento_id", "campo", "value", "own").agg(F.min("metodo").alias("metodo"), F.count("*").alias("n"))


def document_units(counts: DataFrame) -> DataFrame:
    """The unit most often named by the document's unit rows: (documento_id, campo, said)."""
    measure = F.element_at(literal_map({u: m for m, u in UNIT_FIELD.items()}), F.col("campo"))
    named = counts.where(F.col("campo").isin(*UNIT_FIELD.values()))
    return named.groupBy("documento_id", measure.alias("campo")).agg(F.max_by("value", F.struct("n", "value")).alias("said"))


KEY = ["documento_id", "campo", "hoja"]
NUMBERS = ["magnitude", "digits", "decimals", "native", "year"]
GROUPS = ["category", "neighbour", "source"]


def features(quantities: DataFrame, counts: DataFrame, documents: DataFrame) -> DataFrame:
    """Per quantity, what the classifier sees: magnitude and shape of the number, kind and method of the source, vehicle category, unit of the other measure, year. counts: those of documents that are one sheet, so readings of a collecting record have no context."""
    vehicle, year = F.col("campo") == "tipo_vehiculo", F.col("campo") == "anio"
    context = counts.where(vehicle | year).groupBy("documento_id").agg(
        F.max_by(F.when(vehicle, F.col("value")), F.when(vehicle, F.struct("n", "value"))).alias("vehicle"), F.max_by(F.when(year, F.col("value")), F.when(year, F.struct("n", "value"))).alias("year")
    )
    native = documents.groupBy(F.col("id").alias("documento_id")).agg(F.max((F.col("tipo_documento") == "nativo").cast("double")).alias("native"))
    other = quantities.where("hoja = ''").select("documento_id", F.when(F.col("campo") == "pbv", "potencia_motor").otherwise("pbv").alias("campo"), "hoja", F.col("unit").alias("neighbour"))
    plain = F.regexp_replace(F.col("num"), ",", ".")
    return (
        quantities.join(other, KEY, "left").join(context, "documento_id", "left").join(native, "documento_id", "left")
        .select(
            *KEY, "num", "unit",
            F.coalesce(F.log10(F.regexp_replace(plain, r"[.](?=.*[.])", "").try_cast("double") + 1.0), F.lit(0.0)).alias("magnitude"),
            F.length(F.regexp_replace(plain, "[^0-9]", "")).cast("double").alias("digits"),
            F.length(F.regexp_extract(plain, r"[.](\d*)$", 1)).cast("double").alias("decimals"),
            F.coalesce("native", F.lit(-1.0)).alias("native"),
            F.coalesce(F.regexp_extract("year", r"(\d{4})", 1).try_cast("double"), F.lit(-1.0)).alias("year"),
            F.coalesce("vehicle", F.lit("")).alias("category"), F.coalesce("neighbour", F.lit("")).alias("neighbour"), F.coalesce("metodo", F.lit("")).alias("source"),
        )
    )


def assembled(table: DataFrame) -> DataFrame:
    """table with its features as one vector. Categories are told apart as such: the CATEGORIES commonest by number, the rest as one."""
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    for c in GROUPS:
        common = [r[0] for r in table.groupBy(c).agg(F.count("*").alias("n")).orderBy(F.desc("n"), c).limit(CATEGORIES).collect()]
        table = table.withColumn(c, F.when(F.col(c).isin(common), F.col(c)).otherwise("*"))
    indexed = StringIndexer(inputCols=GROUPS, outputCols=[c + "_" for c in GROUPS], handleInvalid="keep", stringOrderType="alphabetAsc").fit(table).transform(table)
    return VectorAssembler(inputCols=NUMBERS + [c + "_" for c in GROUPS], outputCol="features").transform(indexed).select(*KEY, "num", "unit", "features")


def spread_hash(*seed: int) -> Column:
    """Hash of a quantity's document; of a collecting record, of the reading with it."""
    return F.xxhash64("documento_id", *map(F.lit, seed), F.nullif("hoja", F.lit("")))


def predict_units(table: DataFrame, measure: str, trees: int = 12, depth: int = 6) -> DataFrame:
    """(documento_id, campo, hoja, guess, p) for rows of table (assembled) without unit: random forest, calibrated by isotonic regression on labelled rows that it wasn't fitted on.

    Where fewer than two units are known there is nothing to choose between, and without rows to calibrate on nothing is
    certain: p is 0 then, and all go to review.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    units = list(FACTORS[measure])
    own = table.where(F.col("campo") == measure)
    label = F.element_at(literal_map({u: float(i) for i, u in enumerate(units)}), F.col("unit"))
    labelled = cut(own.where(F.col("unit").isNotNull()).withColumn("label", label).orderBy(spread_hash(), *KEY).limit(TRAIN_ROWS).select("documento_id", "hoja", "features", "label"))
    held = F.pmod(spread_hash(7), F.lit(4)) == 0
    unknown = own.where(F.col("unit").isNull())
    fit, test = labelled.where(~held), labelled.where(held)
    if fit.select("label").distinct().count() < 2 or test.isEmpty():
        return unknown.select(*KEY, F.lit(None).cast("string").alias("guess"), F.lit(0.0).alias("p"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=2 * CATEGORIES + 4, seed=11, featuresCol="features", labelCol="label").fit(fit)

    def scored(df: DataFrame) -> DataFrame:
        p = vector_to_array("probability")
        return forest.transform(df).withColumn("raw", F.array_max(p)).withColumn("k", (F.array_position(p, F.array_max(p)) - 1).cast("int"))

    checked = scored(test).select(F.col("raw"), (F.col("k") == F.col("label")).cast("double").alias("right"))
    out = IsotonicRegression(featuresCol="raw", labelCol="right", predictionCol="p").fit(checked).transform(scored(unknown))
    return out.select(*KEY, F.element_at(F.array(*[F.lit(u) for u in units]), F.col("k") + 1).alias("guess"), "p")


def in_base(num: Column, unit: Column) -> Column:
    return F.when(F.col("campo") == "pbv", base_value("pbv", num, unit)).otherwise(base_value("potencia_motor", num, unit))


def stated_quantities(campos: DataFrame, collecting: Sequence[int] = ()) -> tuple[DataFrame, DataFrame]:
    """(quantities, counts): per document and measure the number most readings give, with the unit stated for it and its base value, if any; and what was counted.

    hoja is '' there. The readings of a collecting record are of many sheets, so they aren't put to the vote and its unit
    rows speak for none of them: each number and the unit within it is a row, told apart by hoja, and counts leaves them out.
    """
    rows = campos.where(F.col("deleted_at").isNull() & F.col("documento_id").isNotNull()).select("documento_id", canonical_field(F.col("campo")).alias("campo"), "metodo", "valor")
    every = cut(reading_counts(rows.where(F.col("campo").isin(*FACTORS, *UNIT_FIELD.values(), "tipo_vehiculo", "anio"))))
    loose = F.col("documento_id").isin(*collecting)
    counts = every.where(~loose)
    read = counts.where(F.col("campo").isin(*FACTORS)).join(document_units(counts), ["documento_id", "campo"], "left").withColumnRenamed("value", "num").withColumn("unit", F.coalesce("own", "said"))
    voted = read.withColumn("base", in_base(F.col("num"), F.col("unit"))).groupBy("documento_id", "campo", "unit", F.round("base").alias("rounded")).agg(F.sum("n").alias("n"), F.max_by(F.struct("num", "metodo"), F.struct("n", "num")).alias("r"), F.max("base").alias("base"))
    one = voted.groupBy("documento_id", "campo").agg(F.max_by(F.struct("r.num", "unit", "base", "r.metodo"), F.struct(F.col("base").isNotNull(), F.col("unit").isNotNull(), "n", "base", "r.num")).alias("x"))
    single = every.where(loose & F.col("campo").isin(*FACTORS)).select("documento_id", "campo", F.concat_ws(" ", "value", "own").alias("hoja"), F.col("value").alias("num"), F.col("own").alias("unit"), in_base(F.col("value"), F.col("own")).alias("base"), "metodo")
    return cut(one.select("documento_id", "campo", F.lit("").alias("hoja"), "x.*").union(single)), counts


def guessed_units(seen: DataFrame) -> DataFrame:
    """(documento_id, campo, hoja, guess, p) of the rows without unit of both measures."""
    table = cut(assembled(seen))
    per = [predict_units(table, m) for m in FACTORS]
    return per[0].unionByName(per[1])


def common_units(campos: DataFrame, documents: DataFrame, confident: float = CONFIDENT, collecting: Sequence[int] = ()) -> DataFrame:
    """(documento_id, campo, num, unidad, p, base, destino): one value per document and measure, in kg or kW.

    destino: 'declarada' the unit stands in the value or in a unit row; 'asignada' the classifier is confident;
    'revisar' nothing names the unit and the classifier isn't confident, or no reading of the number is believable
    (base null then). Deleted rows, null, blank and unreadable values drop out; empty tables give an empty result.
    The value taken is the one most readings give; ties go to the larger. Of the documents named in collecting, which hold
    readings of many sheets, every number read is a row of its own.
    """
    one, counts = stated_quantities(campos, collecting)
    joined = one.join(guessed_units(features(one, counts, documents)), KEY, "left")
    sure = F.coalesce(F.col("p") >= confident, F.lit(False))
    unit = F.coalesce("unit", F.when(sure, F.col("guess")))
    value = F.coalesce("base", in_base(F.col("num"), unit))
    where = F.when(F.col("unit").isNotNull() & value.isNotNull(), "declarada").when(sure & value.isNotNull(), "asignada").otherwise("revisar")
    return joined.select("documento_id", "campo", "num", unit.alias("unidad"), F.when(F.col("unit").isNull(), F.coalesce("p", F.lit(0.0))).otherwise(1.0).alias("p"), value.alias("base"), where.alias("destino"))


def hidden_units(campos: DataFrame, documents: DataFrame, confident: float = CONFIDENT, one_in: int = 5, collecting: Sequence[int] = ()) -> DataFrame:
    """(campo, unidad, n, asignadas, correctas): the units of one in so many documents (readings of a collecting record) are hidden from the classifier and compared with what it assigns; the others go to review."""
    one, counts = stated_quantities(campos, collecting)
    hidden = F.pmod(spread_hash(3), F.lit(one_in)) == 0
    known = one.where(F.col("unit").isNotNull() & F.col("base").isNotNull())
    seen = features(known.withColumn("unit", F.when(~hidden, F.col("unit"))), counts, documents)
    met = known.where(hidden).select(*KEY, F.col("unit").alias("unidad")).join(guessed_units(seen), KEY)
    sure = F.col("p") >= confident
    return met.groupBy("campo", "unidad").agg(F.count("*").alias("n"), F.count_if(sure).alias("asignadas"), F.count_if(sure & (F.col("guess") == F.col("unidad"))).alias("correctas"))


def p5_common_units(spark, folder: str) -> DataFrame:
    return common_units(read_table(spark, folder, "campos"), read_table(spark, folder, "documentos"), collecting=COLLECTING)


def p5_found(spark, folder: str) -> DataFrame:
    """The stated quantities of documents; the query leaves out the collecting record, as its SQL does."""
    return p5_common_units(spark, folder).where("documento_id <> 1 and destino = 'declarada'").select("documento_id", "campo", F.round("base").cast("long").alias("valor"))


def p5_hidden_units(spark, folder: str) -> DataFrame:
    return hidden_units(read_table(spark, folder, "campos"), read_table(spark, folder, "documentos"), collecting=COLLECTING)
