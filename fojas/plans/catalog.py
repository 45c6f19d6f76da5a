"""Every query of the core, by name, with its SQL where SQL can state it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fojas.functions import extract as X
from fojas.functions import normalize as N
from fojas.functions.fixed import BODY_WORDS, REPORT_CODE_PREFIXES, YEAR_SIGNS
from fojas.functions.fuzzy import axles_of, document_type_of, fuzzy_fields
from fojas.functions.reading import ACCENTED, PLAIN, let, literal_map
from fojas.functions.score import check_digit, score_reading
from fojas.functions.text import clean_value, entropy, footer, header_and_body, ngrams, normalize_text, number_words, numbered_lines
from fojas.operators import agreement, audit, consolidate, eav, register, state, units
from fojas.operators import dictionary as terms
from fojas.operators.extraction import Dictionaries, extract_rows, extract_wide
from fojas.plans import oracle
from fojas.plans.pipeline import below_minimum, publish, run_batch, score_fields
from fojas.schema import FIELDS, TARGET_FIELDS
from fojas.session import read_table, shared_folder, spread
from fojas.sources import sinks
from fojas.sources.readers import Settings, dictionary_csv, enabled_texts, jsonl_pairs, log_lines
from fojas.streaming.intake import intake_sessions

Query = Callable[[SparkSession, str], DataFrame]
#: The year by which scores judge years and dates.
YEAR = 2025
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


LIVE = "deleted_at IS NULL"
RANK = "CASE metodo WHEN 'easyocr' THEN 3 WHEN 'doctr' THEN 2 WHEN 'paddleocr' THEN 1 ELSE 0 END"
TOP1 = (
    f"SELECT documento_id, campo, valor, metodo, score FROM (SELECT *, row_number() OVER (PARTITION BY documento_id, campo ORDER BY score DESC NULLS LAST, {RANK} DESC, metodo, valor, id) r "
    f"FROM campos WHERE {LIVE} AND valor <> '' AND {{where}}) WHERE r = 1"
)
# leading and trailing white space, as one pattern
EDGE = r"'^\s+|\s+$'"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, {EDGE}, '', 'g')"


@query(TOP1.format(where="TRUE"))
def consolidate_top1(spark, d):
    return consolidate.consolidate(read_table(spark, d, "campos"))


@query(TOP1.format(where="campo = 'marca'"))
def consolidate_one_field(spark, d):
    return consolidate.consolidate(read_table(spark, d, "campos"), campo="marca")


@query(TOP1.format(where="documento_id IN (SELECT id FROM documentos WHERE estado IN (4, 5, 6))"))
def consolidate_by_state(spark, d):
    return consolidate.consolidate(read_table(spark, d, "campos"), read_table(spark, d, "documentos"), states=[4, 5, 6])


@query(
    "SELECT documento_id, "
    + ", ".join((r"regexp_replace(max(CASE WHEN campo = 'fecha_documento' THEN valor END), '^([^-]*)-([^-]*)-([^-]{4})$', '\3-\2-\1')" if f == "fecha_documento" else f"max(CASE WHEN campo = '{f}' THEN valor END)") + f" AS {f}" for f in FIELDS)
    + f" FROM ({TOP1.format(where='TRUE')}) WHERE campo IN ({', '.join(repr(f) for f in FIELDS)}) GROUP BY documento_id"
)
def publish_wide(spark, d):
    return consolidate.publish_wide(consolidate.consolidate(read_table(spark, d, "campos")))


@query(
    "SELECT d.id AS documento_id, d.nombre_archivo, coalesce(nullif(d.archivo_padre, ''), d.nombre_archivo) AS archivo_padre, d.numero_paginas, d.tamano_bytes, "
    + ", ".join((r"regexp_replace(max(CASE WHEN campo = 'fecha_documento' THEN valor END), '^([^-]*)-([^-]*)-([^-]{4})$', '\3-\2-\1')" if f == "fecha_documento" else f"max(CASE WHEN campo = '{f}' THEN valor END)") + f" AS {f}" for f in FIELDS)
    + f", 'script_pdf_copy' AS metodo FROM documentos d JOIN consolidada c ON c.documento_id = d.id AND c.deleted_at IS NULL AND c.campo IN ({', '.join(repr(f) for f in FIELDS)}) GROUP BY ALL"
)
def publish_with_documents(spark, d):
    return consolidate.publish_wide(consolidate.live(read_table(spark, d, "consolidada")), read_table(spark, d, "documentos"))


PUBLISHED = "estado = 5 AND deleted_at IS NULL AND NOT coalesce(copiado_remoto, false)"


@query(
    "SELECT d.id AS documento_id, d.nombre_archivo, count(DISTINCT c.campo) AS campos FROM documentos d JOIN consolidada c ON c.documento_id = d.id AND c.deleted_at IS NULL AND c.valor IS NOT NULL "
    f"AND c.campo IN ({', '.join(repr(f) for f in FIELDS)}) WHERE d.estado = 5 AND d.deleted_at IS NULL AND NOT coalesce(d.copiado_remoto, false) GROUP BY ALL"
)
def publish_dry_run(spark, d):
    wide, _ = publish(read_table(spark, d, "documentos"), read_table(spark, d, "consolidada"))
    filled = sum((F.col(f).isNotNull().cast("long") for f in FIELDS), F.lit(0).cast("long"))
    return wide.select("documento_id", "nombre_archivo", filled.alias("campos"))


@query(f"SELECT id, CASE WHEN {PUBLISHED} AND id IN (SELECT documento_id FROM consolidada WHERE deleted_at IS NULL AND campo IN ({', '.join(repr(f) for f in FIELDS)})) THEN 6 ELSE estado END AS estado FROM documentos")
def publish_states(spark, d):
    return publish(read_table(spark, d, "documentos"), read_table(spark, d, "consolidada"))[1].select("id", "estado")


@query()
def pipeline_wide(spark, d):
    """Texts to fields, scores, best values and wide rows in one plan."""
    return run_batch(read_table(spark, d, "textos"), YEAR, dictionaries(spark, d))["wide"]


@query(
    "SELECT id, 'numero_paginas' AS campo, CAST(numero_paginas AS VARCHAR) AS valor FROM documentos WHERE numero_paginas IS NOT NULL UNION ALL SELECT id, 'tipo_documento', tipo_documento FROM documentos WHERE tipo_documento <> '' "
    "UNION ALL SELECT id, 'calidad_estimativa', CAST(calidad_estimativa AS VARCHAR) FROM documentos WHERE calidad_estimativa IS NOT NULL UNION ALL SELECT id, 'archivo_padre', archivo_padre FROM documentos WHERE archivo_padre <> ''"
)
def unpivot_fields(spark, d):
    return eav.wide_to_eav(read_table(spark, d, "documentos"), ["id"], ["numero_paginas", "tipo_documento", "calidad_estimativa", "archivo_padre"])


AGREE = (
    f"WITH v AS (SELECT *, {sql_strip('coalesce(valor, $$$$)')} AS v FROM campos WHERE {LIVE}), k AS (SELECT documento_id, campo, v, count(*) AS k FROM v WHERE v <> '' GROUP BY ALL), "
    "t AS (SELECT documento_id, campo, CAST(sum(k) AS BIGINT) AS n_valid, count(*) AS n_distinct, max(k) AS top_k, arg_min(v, struct_pack(a := -k, b := v)) AS top FROM k GROUP BY ALL) "
)


@query(AGREE + "SELECT v.id, v.documento_id, v.campo, v.metodo, v.valor, CAST(CASE WHEN v = '' THEN 0.0 WHEN n_valid = n_distinct THEN 0.2 WHEN v = top THEN 1.0 ELSE 0.3 END AS DOUBLE) AS score FROM v JOIN t USING (documento_id, campo)")
def agreement_scores(spark, d):
    return agreement.score_by_agreement(read_table(spark, d, "campos"))


@query(AGREE + "SELECT campo, count(*) AS items, count(*) FILTER (n_distinct > 1) AS disputed, round(avg(top_k / n_valid), 6) AS mean_top_share FROM t GROUP BY campo")
def agreement_summary(spark, d):
    return agreement.agreement_summary(read_table(spark, d, "campos"))


BARE = "upper(regexp_replace(v, '\\.', '', 'g'))"
DIGIT = "(11 - list_sum(list_transform(string_split(reverse(regexp_extract({b}, '^(\\d+)', 1)), ''), lambda x, i: CAST(x AS INT) * ((i - 1) % 6 + 2))) % 11)"


def sql_check(body: str) -> str:
    r = DIGIT.format(b=body)
    return f"CASE {r} WHEN 10 THEN 'K' WHEN 11 THEN '0' ELSE CAST({r} AS VARCHAR) END"


ALNUM_D = "regexp_full_match(v, '\\p{Nd}+')"
DATE_PARTS = "try_cast(regexp_replace(CASE WHEN regexp_full_match(v, '\\d{1,2}/\\d{1,2}/\\d{4}') THEN v END, '^(\\d+)/(\\d+)/(\\d+)$', '\\3-\\2-\\1') AS DATE)"
SCORE = f"""WITH x AS (SELECT *, {sql_strip('valor')} AS v FROM campos), s AS (SELECT *, CASE WHEN coalesce(valor, '') = '' THEN 0.0
WHEN campo IN ('rut_proveedor', 'rut_comprador') THEN least(1.0, 0.1 + CASE WHEN length(regexp_replace({BARE}, '\\D', '', 'g')) >= 7 THEN 0.2 ELSE 0 END + CASE WHEN regexp_full_match({BARE}, '\\d{{7,8}}-[0-9K]') THEN 0.3 ELSE 0 END
 + CASE WHEN regexp_full_match({BARE}, '\\d{{7,8}}-[0-9K]') AND {sql_check(BARE)} = right({BARE}, 1) THEN 0.4 ELSE 0 END)
WHEN campo = 'anio' THEN CASE WHEN regexp_full_match(v, '[+-]?\\d+') THEN CASE WHEN try_cast(v AS INT) BETWEEN 1900 AND {YEAR + 1} THEN 1.0 ELSE 0.1 END ELSE 0.0 END
WHEN campo = 'fecha_documento' THEN CASE WHEN {DATE_PARTS} IS NULL THEN 0.0 WHEN year({DATE_PARTS}) BETWEEN 1900 AND {YEAR} THEN 1.0 ELSE 0.1 END
WHEN campo IN ('vin', 'n_chasis') THEN CASE WHEN length(v) <> 17 THEN 0.3 WHEN contains('{YEAR_SIGNS}', upper(substr(v, 10, 1))) THEN 1.0 ELSE 0.1 END
WHEN campo IN ('monto_total', 'monto_neto', 'monto_iva') THEN CASE WHEN regexp_full_match(replace(v, '.', ''), '\\p{{Nd}}+') THEN 1.0 ELSE 0.1 END
WHEN campo = 'tipo_vehiculo' THEN CASE WHEN regexp_matches(upper(v), 'AUTO|VEHICULO') THEN 0.2 WHEN regexp_full_match(upper(v), '\\p{{L}}{{3,}}') THEN 1.0 ELSE 0.1 END
WHEN campo = 'carga' THEN CASE WHEN regexp_full_match(v, '\\p{{Nd}}{{2,}}') THEN 1.0 ELSE 0.1 END
WHEN campo IN ('tipo_doc', 'numero_documento', 'asientos', 'puertas', 'potencia_motor', 'ejes', 'cilindrada', 'cit', 'serie', 'pbv', 'n_motor') THEN CASE WHEN {ALNUM_D} THEN 1.0 ELSE 0.1 END
WHEN campo IN ('marca', 'transmision', 'combustible', 'tipo_carroceria', 'traccion') THEN CASE WHEN regexp_full_match(v, '\\p{{L}}{{2,}}') THEN 1.0 ELSE 0.1 END
WHEN campo IN ('color', 'placa_patente') THEN CASE WHEN regexp_full_match(v, '\\p{{L}}{{3,}}') THEN 1.0 ELSE 0.1 END
WHEN campo = 'unidad_pbv' THEN CASE WHEN regexp_full_match(v, '\\p{{L}}+') THEN 1.0 ELSE 0.1 END
ELSE CASE WHEN length(v) >= 3 THEN 0.6 ELSE 0.1 END END AS raw FROM x) """


@query(SCORE + "SELECT id, documento_id, campo, metodo, valor, CAST(round(CASE WHEN campo = 'tipo_doc' AND metodo = 'paddleocr' THEN least(1.0, raw + 0.2) ELSE raw END, 2) AS DOUBLE) AS score FROM s")
def score_by_rule(spark, d):
    return read_table(spark, d, "campos").select("id", "documento_id", "campo", "metodo", "valor", score_reading(F.col("campo"), F.col("valor"), F.col("metodo"), YEAR).alias("score"))


@query(SCORE + "SELECT id, CAST(CASE WHEN score IS NULL OR isnan(score) OR score = 0 THEN round(CASE WHEN campo = 'tipo_doc' AND metodo = 'paddleocr' THEN least(1.0, raw + 0.2) ELSE raw END, 2) ELSE score END AS DOUBLE) AS score FROM s")
def score_unscored(spark, d):
    return score_fields(read_table(spark, d, "campos"), YEAR).select("id", "score")


@query()
def score_strict(spark, d):
    return read_table(spark, d, "campos").select("id", "campo", score_reading(F.col("campo"), F.col("valor"), F.col("metodo"), YEAR, "strict").alias("score"))


@query(f"SELECT c_custkey, b AS cuerpo, {sql_check('b')} AS dv FROM (SELECT c_custkey, CAST(c_custkey + 10000000 AS VARCHAR) AS b FROM customer)")
def check_digits(spark, d):
    body = (F.col("c_custkey") + 10000000).cast("string")
    return read_table(spark, d, "customer").select("c_custkey", body.alias("cuerpo"), check_digit(body).alias("dv"))


@query("SELECT DISTINCT hash_archivo FROM documentos n WHERE estado < 4 AND hash_archivo IS NOT NULL AND NOT EXISTS (SELECT 1 FROM documentos o WHERE o.estado >= 4 AND o.hash_archivo = n.hash_archivo)")
def register_dedup(spark, d):
    docs = read_table(spark, d, "documentos")
    return register.register(docs.where("estado < 4 AND hash_archivo IS NOT NULL"), docs.where("estado >= 4"), ["hash_archivo"]).select("hash_archivo")


@query(
    "SELECT user_id, string_agg(t, chr(10) ORDER BY y, x, t) AS texto FROM (SELECT user_id, CAST(event_id % 7 AS DOUBLE) AS y, value AS x, event_type AS t FROM events) GROUP BY user_id"
)
def blocks_read_in_order(spark, d):
    blocks = read_table(spark, d, "events").groupBy("user_id").agg(F.collect_list(F.struct((F.col("event_id") % 7).cast("double").alias("y"), F.col("value").alias("x"), F.col("event_type").alias("texto"))).alias("b"))
    return blocks.select("user_id", register.blocks_in_reading_order(F.col("b")).alias("texto"))


@query(
    "SELECT doc_id, " + sql_strip("list_aggregate(list_transform(string_split(text, chr(10) || chr(10)), lambda p, i: chr(10) || '--- Página ' || i || ' ---' || chr(10) || " + sql_strip("p") + " || chr(10)), 'string_agg', '')") + " AS texto FROM documents"
)
def native_pages(spark, d):
    return read_table(spark, d, "documents").select("doc_id", register.native_text(F.split("text", "\n\n")).alias("texto"))


@query("SELECT p_brand AS archivo, coalesce(avg(p_size), 0.0) AS ppi, CAST(CASE WHEN avg(p_size) >= 300 THEN 90 WHEN avg(p_size) >= 200 THEN 70 WHEN avg(p_size) > 0 THEN 50 ELSE 40 END AS INT) AS calidad FROM part GROUP BY p_brand")
def image_resolutions(spark, d):
    per = read_table(spark, d, "part").groupBy(F.col("p_brand").alias("archivo")).agg(F.collect_list(F.col("p_size").cast("double")).alias("v"))
    return per.select("archivo", register.mean_resolution(F.col("v")).alias("ppi")).withColumn("calidad", register.quality(F.col("ppi")))


@query("SELECT id, CASE WHEN tamano_bytes IS NULL THEN -1 WHEN copiado_remoto THEN 0 ELSE tamano_bytes END AS enviado FROM documentos")
def upload_results(spark, d):
    return read_table(spark, d, "documentos").select("id", register.upload_result(F.col("tamano_bytes"), F.col("copiado_remoto")).alias("enviado"))


@query("SELECT doc_id, sha256(text) AS hash_archivo, md5(text) AS md5 FROM documents")
def content_hashes(spark, d):
    return register.with_hashes(read_table(spark, d, "documents"), "text").select("doc_id", "hash_archivo", "md5")


@query(
    "SELECT doc_id, CAST(i AS INT) AS pagina, CASE WHEN n > 1 THEN 'doc' || doc_id || '_' || i || '.pdf' ELSE 'doc' || doc_id || '.pdf' END AS nombre_pagina, length(p[i]) AS largo FROM "
    "(SELECT doc_id, string_split(text, chr(10) || chr(10)) AS p, len(string_split(text, chr(10) || chr(10))) AS n, unnest(generate_series(1, len(string_split(text, chr(10) || chr(10))))) AS i FROM documents)"
)
def page_explode(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("archivo"), F.split("text", "\n\n").alias("paginas"))
    return register.explode_pages(docs, "paginas", "archivo").select("doc_id", "pagina", "nombre_pagina", F.length("texto_pagina").cast("long").alias("largo"))


@query("SELECT doc_id, CASE WHEN n_chars < 500 THEN 'escaneado' ELSE 'nativo' END AS tipo FROM documents")
def document_kinds(spark, d):
    return read_table(spark, d, "documents").select("doc_id", register.document_kind(F.col("n_chars")).alias("tipo"))


@query("SELECT id, CAST(CASE WHEN resolucion_ppi >= 300 THEN 90 WHEN resolucion_ppi >= 200 THEN 70 WHEN resolucion_ppi > 0 THEN 50 ELSE 40 END AS INT) AS calidad, coalesce(nullif(archivo_padre, ''), nombre_archivo) AS padre FROM documentos")
def document_quality(spark, d):
    return read_table(spark, d, "documentos").select("id", register.quality(F.col("resolucion_ppi")).alias("calidad"), register.parent_name(F.col("archivo_padre"), F.col("nombre_archivo")).alias("padre"))


@query(
    "WITH c AS (SELECT doc_id, ch, count(*) AS k FROM (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents) GROUP BY ALL), n AS (SELECT doc_id, sum(k) AS n FROM c GROUP BY 1) "
    "SELECT doc_id, round(abs(log2(any_value(n)) - sum(k * log2(k)) / any_value(n)), 6) AS entropia FROM c JOIN n USING (doc_id) GROUP BY doc_id"
)
def text_entropy(spark, d):
    return spread(read_table(spark, d, "documents")).select("doc_id", F.round(entropy(F.col("text")), 6).alias("entropia"))


@query("SELECT t.id, t.documento_id, t.metodo, d.nombre_archivo FROM textos t JOIN documentos d ON d.id = t.documento_id WHERE d.estado = 3 AND d.deleted_at IS NULL AND t.deleted_at IS NULL")
def texts_pending(spark, d):
    return state.pending_texts(read_table(spark, d, "textos"), read_table(spark, d, "documentos"), 3).select("id", "documento_id", "metodo", "nombre_archivo")


SQL_PLAIN = (
    "trim(regexp_replace(regexp_replace(translate(regexp_replace(translate(upper(coalesce({x}, '')), '" + ACCENTED + "ªº', '" + PLAIN + r"AO'), '[^\x00-\x7F]', '', 'g'), '015348', 'OISEAB'), '[^A-Z\s]', ' ', 'g'), '\s+', ' ', 'g'))"
)


@query("SELECT doc_id, " + SQL_PLAIN.format(x="text") + " AS plano FROM documents")
def text_normalized(spark, d):
    return read_table(spark, d, "documents").select("doc_id", normalize_text(F.col("text")).alias("plano"))


def sql_clean(x: str) -> str:
    v = f"replace({sql_strip(f'coalesce({x}, $$$$)')}, '[SEGMENTO_CABECERA]', '')"
    for p in (r"\.0$", "-+$", "!+$", r"\.{2,}$"):
        v = f"regexp_replace({v}, '{p}', '')"
    v = sql_strip(f"regexp_replace({sql_strip(v)}, '^:|:$', '', 'g')")
    return sql_strip(f"regexp_replace({v}, '(?i)^[^A-Z0-9ÁÉÍÓÚÑáéíóúñ]+|[^A-Z0-9ÁÉÍÓÚÑáéíóúñ]+$', '', 'g')")


@query(f"SELECT id, {sql_clean('valor')} AS limpio FROM campos")
def text_cleaned(spark, d):
    return read_table(spark, d, "campos").select("id", clean_value(F.col("valor")).alias("limpio"))


@query("SELECT p_partkey, w[i] || ' ' || w[i + 1] AS bigrama FROM (SELECT p_partkey, w, unnest(generate_series(1, len(w) - 1)) AS i FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part))")
def part_bigrams(spark, d):
    return read_table(spark, d, "part").select("p_partkey", F.explode(ngrams(F.split("p_name", " "), 2)).alias("bigrama"))


FIRST_WORD = "nullif(least(" + ", ".join(f"coalesce(nullif(instr(u, '{w}'), 0), 999999999)" for w in BODY_WORDS) + "), 999999999)"
LINES = r"replace(replace(replace(coalesce(texto_extraccion, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(12), chr(10))"


@query(
    f"WITH t AS (SELECT id, {LINES} AS t, upper({LINES}) AS u FROM textos), w AS (SELECT *, {FIRST_WORD} AS p FROM t), c AS (SELECT *, CASE WHEN p IS NOT NULL THEN length(regexp_extract(substr(t, 1, CAST(p AS BIGINT) - 1), '(?s)^(?:.*\\n)?')) END AS cut FROM w) "
    f"SELECT id, CASE WHEN cut <= length(t) // 2 THEN regexp_replace(' ' || {sql_strip('substr(t, 1, cut)')}, '\\s{{2,}}', ' ', 'g') ELSE {sql_strip('t')} END AS cabecera, "
    f"CASE WHEN cut <= length(t) // 2 THEN regexp_replace(' ' || {sql_strip('substr(t, cut + 1)')}, '\\s{{2,}}', ' ', 'g') ELSE {sql_strip('t')} END AS cuerpo FROM c"
)
def header_body(spark, d):
    return spread(read_table(spark, d, "textos")).select("id", header_and_body(F.col("texto_extraccion")).alias("p")).select("id", "p.cabecera", "p.cuerpo")


@query(f"SELECT id, {sql_strip('CASE WHEN contains(t, $$[SEGMENTO_TOTALES]$$) THEN substr(t, instr(t, $$[SEGMENTO_TOTALES]$$)) ELSE t END')} AS pie FROM (SELECT id, coalesce(texto_extraccion, '') AS t FROM textos)")
def footer_segment(spark, d):
    return spread(read_table(spark, d, "textos")).select("id", footer(F.col("texto_extraccion")).alias("pie"))


@query(f"SELECT id, list_aggregate(list_transform(string_split(t, chr(10)), lambda x, i: lpad(CAST(i AS VARCHAR), 4, '0') || ': ' || x), 'string_agg', chr(10)) AS lineas FROM (SELECT id, {LINES} AS t FROM textos)")
def line_numbers(spark, d):
    return spread(read_table(spark, d, "textos")).select("id", numbered_lines(F.col("texto_extraccion")).alias("lineas"))


@query("SELECT DISTINCT CAST(l_quantity AS BIGINT) AS cantidad, CAST(l_quantity AS BIGINT) * 1000 AS leido FROM lineitem")
def amounts_in_words(spark, d):
    # The words from which the amounts are spelled.
    ones = ["", "UNO", "DOS", "TRES", "CUATRO", "CINCO", "SEIS", "SIETE", "OCHO", "NUEVE", "DIEZ", "ONCE", "DOCE", "TRECE", "CATORCE", "QUINCE", "DIECISEIS", "DIECISIETE", "DIECIOCHO", "DIECINUEVE"]
    tens = ["", "", "VEINTE", "TREINTA", "CUARENTA", "CINCUENTA", "SESENTA", "SETENTA", "OCHENTA", "NOVENTA"]
    spelled = {n: ones[n] if n < 20 else tens[n // 10] + (f" Y {ones[n % 10]}" if n % 10 else "") for n in range(1, 100)}
    words = F.concat(F.lit("SON: "), F.element_at(literal_map(spelled), F.col("cantidad").cast("int")), F.lit(" MIL PESOS"))
    return read_table(spark, d, "lineitem").select(F.col("l_quantity").cast("long").alias("cantidad")).distinct().select("cantidad", number_words(words).alias("leido"))


ID_SQL = r"(?:^|[^0-9])((?:\d{1,3}(?:\.\d{3}){1,2}|\d{7,8})-[\dK])"
U = "upper(coalesce(texto_extraccion, ''))"


def extraction(name: str, build: Callable[[Column], Column], sql: str | None = None) -> None:
    """A query that reads one field from every whole text."""

    def run(spark, d):
        return spread(read_table(spark, d, "textos")).select("id", build(F.col("texto_extraccion")).alias("valor"))

    run.__name__ = f"extract_{name}"
    query(sql and f"SELECT id, {sql} AS valor FROM textos")(run)


def sql_first(pattern: str) -> str:
    return sql_strip(f"regexp_extract({U}, '{pattern}', 1)")


extraction("numero_documento", X.document_number, sql_first(r"(?:^|[^\pL\pN_])(?:N[º°9*]?\s*[:\-]?\s*|N\s*[Oo]\s*[:\-]?\s*|FOLIO\s*[:\-]?\s*|NO\s*[:\-]?\s*)(\d{5,})(?:[^\pL\pN_]|$)"))
extraction("rut_proveedor", X.supplier_id, f"replace(coalesce(regexp_extract_all({U}, '{ID_SQL}', 1)[1], ''), '.', '')")
extraction("rut_comprador", X.buyer_id, f"replace(coalesce(regexp_extract_all({U}, '{ID_SQL}', 1)[2], ''), '.', '')")
extraction("placa_patente", X.plate, sql_first(r"(?:P(?:\.?P\.?U\.?)|PATENTE|PLACA)[\s:]*([A-Z]{2,4}\.?\d{2,4}(?:-\d{1,2})?)"))
extraction("vin", X.vehicle_number, sql_first(X.VEHICLE_NUMBER))
extraction("serie", X.series, sql_first(X.SERIES))
extraction("anio", X.year, f"coalesce(list_filter(regexp_extract_all({U}, '{X.YEAR}', 1), lambda y: CAST(y AS INT) BETWEEN 1980 AND 2100)[1], '')")
extraction("unidad_carga", X.load_unit, sql_first("(TONELADAS|KILOS|TON|KG)"))
extraction("carga", X.load, f"translate({sql_first(X.LOAD)}, '.,', '')")
extraction("traccion", X.drive, sql_first(X.DRIVE))
extraction("cilindrada", X.displacement, f"CASE WHEN {sql_first(r'CILINDRADA[\s:\-]*([\d\.]+\s*CC)')} <> '' THEN {sql_first(r'CILINDRADA[\s:\-]*([\d\.]+\s*CC)')} ELSE {sql_first(r'CILINDRADA[\s:\-]*([\d\.]+)')} END")
extraction("asientos", X.seats, f"coalesce(list_filter([{sql_first(r'ASIENTOS[\s:\-]*([0-9]+)')}, {sql_first(r'([0-9]+)[\s\-]*ASIENTOS')}], lambda v: try_cast(v AS INT) <= 60)[1], '')")
extraction("modelo", X.model, None)
extraction("tipo_vehiculo", X.vehicle_type)
extraction("puertas", X.doors)
extraction("fecha_documento", X.document_date)
extraction("nombre_proveedor", X.supplier_name)
extraction("nombre_comprador", X.buyer_name)
extraction("telefono_comprador", X.buyer_phone)
extraction("n_motor", X.engine_number)
extraction("n_chasis", X.chassis_number)
extraction("unidad_pbv", X.weight_unit)
extraction("pbv", X.gross_weight)
extraction("combustible", X.fuel)
extraction("potencia_motor", X.power)
extraction("unidad_potencia", X.power_unit)
extraction("transmision", X.gearbox)
extraction("monto_neto", lambda c: X.amount_text(X.net_amount(c)))
extraction("monto_iva", lambda c: X.amount_text(X.tax_amount(c)))
extraction("monto_total", lambda c: X.amount_text(X.total_amount(c)))
extraction("num_contrato", X.contract_number)


def dictionaries(spark, d) -> Dictionaries:
    lists = {c: terms.terms_of(read_table(spark, d, t), c) for t, c in (("diccionario_comunas", "comuna"), ("diccionario_marcas", "marca"), ("diccionario_colores", "color"))}
    return Dictionaries(communes=lists["comuna"], makes=lists["marca"], colours=lists["color"])


def listed_extraction(name: str, build: Callable[[Column, Dictionaries], Column]) -> None:
    """A query that reads one field with the lists from every whole text."""

    def run(spark, d):
        own = dictionaries(spark, d)
        return spread(read_table(spark, d, "textos")).select("id", build(F.col("texto_extraccion"), own).alias("valor"))

    run.__name__ = f"extract_{name}"
    query()(run)


listed_extraction("localidad", lambda t, d: X.locality(t, d.communes))
listed_extraction("direccion_comprador", lambda t, d: X.buyer_address(t, d.communes))
listed_extraction("ciudad_comprador", lambda t, d: X.buyer_city(t, d.cities or d.communes))
listed_extraction("color", lambda t, d: X.colour(t, d.colours))
listed_extraction("tipo_carroceria", lambda t, d: X.bodywork(t, d.bodies))
listed_extraction("marca", lambda t, d: X.make(t, d.makes))
# the codes of the make that is read from the same text, by the table of prefixes
listed_extraction("cit_por_marca", lambda t, d: let(X.make(t, [m for m, _ in REPORT_CODE_PREFIXES]), lambda m: X.report_code_by_make(t, m)))


@query(
    "WITH c AS (SELECT DISTINCT upper(trim(comuna)) AS t FROM diccionario_comunas WHERE trim(comuna) <> ''), x AS (SELECT id, " + sql_first(r"(?:COMUNA\s*[:\-]?\s*)([A-Z\s]+)")
    + " AS v FROM textos) SELECT id, coalesce((SELECT arg_min(t, struct_pack(a := -length(t), b := t)) FROM c WHERE contains(x.v, c.t)), '') AS valor FROM x"
)
def extract_comuna_comprador(spark, d):
    own = dictionaries(spark, d)
    return spread(read_table(spark, d, "textos")).select("id", X.buyer_commune(F.col("texto_extraccion"), own.communes).alias("valor"))


@query()
def extract_all_wide(spark, d):
    return extract_wide(read_table(spark, d, "textos").select("id", "documento_id", "metodo", "texto_extraccion"), dictionaries(spark, d)).drop("texto_extraccion")


@query()
def extract_all_rows(spark, d):
    return extract_rows(read_table(spark, d, "textos"), dictionaries(spark, d))


@query()
def extract_tipo_doc(spark, d):
    run = F.pandas_udf(lambda s: s.map(document_type_of), "string")
    return spread(read_table(spark, d, "textos")).select("id", run(normalize_text(F.substring(F.coalesce("texto_extraccion", F.lit("")), 1, 415))).alias("valor"))


@query()
def axles_similar(spark, d):
    run = F.pandas_udf(lambda s: s.map(lambda v: axles_of([v.upper()]) if v else ""), "string")
    return read_table(spark, d, "campos").where("campo = 'ejes'").select("id", run(F.coalesce("valor", F.lit(""))).alias("valor"))


@query()
def report_codes(spark, d):
    """The code on a report-code line, else the one with a prefix of the make read from the same text."""
    makes = terms.terms_of(read_table(spark, d, "diccionario_marcas"), "marca")
    text = F.coalesce("texto_extraccion", F.lit(""))
    # the make is needed only where some code has the form that begins with its prefix; it is bound once, as each row of the prefix table looks at it
    coded = X.upper(text).rlike(r"\b[A-Z0-9]{6,}\-[A-Z0-9]{1,3}\b")
    none = F.array().cast("array<string>")
    close = fuzzy_fields(F.lit(""), F.when(coded, X.make_candidates(text)).otherwise(none), none, F.lit(""), makes, [])["marca"]
    read = spread(read_table(spark, d, "textos")).select("id", text.alias("t"), coded.alias("coded"), close.alias("m"))
    own = F.when(F.col("coded"), X.make(F.col("t"), makes, F.col("m"))).otherwise("")
    return read.select("id", let(own, lambda m: X.report_code(F.col("t"), m)).alias("valor"))


@query(
    "WITH m AS (SELECT DISTINCT upper(trim(marca)) AS t FROM diccionario_marcas WHERE trim(marca) <> ''), v AS (SELECT DISTINCT upper(valor) AS v FROM campos WHERE campo = 'marca' AND valor IS NOT NULL) "
    "SELECT v.v AS valor, count(m.t) AS n, coalesce(arg_min(m.t, struct_pack(a := -length(m.t), b := m.t)), '') AS mas_largo FROM v LEFT JOIN m ON contains(v.v, m.t) GROUP BY v.v"
)
def dictionary_contained(spark, d):
    makes = terms.terms_of(read_table(spark, d, "diccionario_marcas"), "marca")
    v = read_table(spark, d, "campos").where("campo = 'marca' AND valor IS NOT NULL").select(F.upper("valor").alias("valor")).distinct()
    return v.select("valor", F.size(terms.contained_terms(F.col("valor"), makes)).cast("long").alias("n"), terms.longest_contained(F.col("valor"), makes).alias("mas_largo"))


@query(
    "WITH p AS (SELECT DISTINCT p_brand AS marca, substr(p_name, 1, 2 + length(p_brand) - 6) AS prefijo FROM part), c AS (SELECT DISTINCT p_brand AS marca, p_name AS codigo FROM part) "
    "SELECT c.marca, c.codigo, arg_max(p.prefijo, length(p.prefijo)) AS prefijo FROM c JOIN p ON p.marca = c.marca AND starts_with(c.codigo, p.prefijo) AND p.prefijo <> '' GROUP BY ALL"
)
def prefix_lookup(spark, d):
    part = read_table(spark, d, "part")
    prefixes = part.select(F.col("p_brand").alias("marca"), F.expr("substr(p_name, 1, 2 + length(p_brand) - 6)").alias("prefijo")).distinct().where("prefijo <> ''")
    return terms.prefix_lookup(part.select(F.col("p_brand").alias("marca"), F.col("p_name").alias("codigo")).distinct(), prefixes, "marca", "codigo", "prefijo")


def normal_form(name: str, build: Callable[[Column], Column], fields: list[str], sql: str | None = None) -> None:
    def run(spark, d):
        return read_table(spark, d, "campos").where(F.col("campo").isin(fields)).select("id", build(F.col("valor")).alias("valor"))

    run.__name__ = f"normalize_{name}"
    query(sql and f"SELECT id, {sql} AS valor FROM campos WHERE campo IN ({', '.join(repr(f) for f in fields)})")(run)


V = "coalesce(valor, '')"
SIMPLE = rf"regexp_replace(translate(regexp_replace(upper({sql_strip(V)}), '\s+', ' ', 'g'), 'ÁÉÍÓÚÑ', 'AEIOUN'), '[^\pL\pN_\s\-.]', '', 'g')"
normal_form("text", N.simple_text, ["marca", "modelo", "color", "tipo_vehiculo", "nombre_proveedor", "nombre_comprador"], SIMPLE)
normal_form("number", N.number_form, ["pbv", "asientos", "puertas", "anio"], f"CASE WHEN regexp_full_match(trim(translate({V}, '.,', '')), '\\d+') AND CAST(trim(translate({V}, '.,', '')) AS HUGEINT) > 0 THEN CAST(CAST(trim(translate({V}, '.,', '')) AS HUGEINT) AS VARCHAR) ELSE '' END")
normal_form("displacement", N.displacement_form, ["cilindrada"], f"CASE WHEN regexp_full_match(trim(translate({V}, '.,', '')), '\\d{{1,9}}') AND try_cast(trim(translate({V}, '.,', '')) AS BIGINT) BETWEEN 51 AND 19999 THEN trim(translate({V}, '.,', '')) ELSE '' END")
normal_form("power", N.power_form, ["potencia_motor"], f"CASE WHEN try_cast(regexp_extract({V}, '(\\d+)', 1) AS BIGINT) BETWEEN 21 AND 1999 THEN CAST(CAST(regexp_extract({V}, '(\\d+)', 1) AS BIGINT) AS VARCHAR) ELSE '' END")
normal_form("unit", N.unit_form, ["unidad_pbv", "unidad_potencia"], f"CASE WHEN upper({V}) IN ('KG', 'KGS', 'KILOS', 'KILO') THEN 'KG' WHEN upper({V}) IN ('HP', 'CV', 'HORSEPOWER') THEN 'HP' WHEN upper({V}) IN ('CC', 'CM3', 'CILINDRADA') THEN 'CC' WHEN upper({V}) IN ('L', 'LITRO', 'LITROS') THEN 'L' WHEN upper({V}) IN ('KM', 'KILOMETRO', 'KILOMETROS') THEN 'KM' ELSE upper({V}) END")
normal_form("vin", N.vehicle_number_form, ["vin", "n_chasis"], f"CASE WHEN regexp_full_match(replace(upper({sql_strip(V)}), ' ', ''), '[A-Z0-9]{{17}}') THEN replace(upper({sql_strip(V)}), ' ', '') ELSE '' END")
normal_form("gearbox", N.gearbox_form, ["transmision"], f"CASE WHEN contains(upper({V}), 'MANUAL') THEN 'MANUAL' WHEN regexp_matches(upper({V}), 'AUTOM[AÁ]TIC[AO]') THEN 'AUTOMATICA' WHEN contains(upper({V}), 'CVT') THEN 'CVT' ELSE {SIMPLE} END")
normal_form("fuel", N.fuel_form, ["combustible"], f"CASE WHEN contains(translate(upper({V}), 'ÁÉÍÓÚ', 'AEIOU'), 'DIESEL') THEN 'DIESEL' WHEN regexp_matches(translate(upper({V}), 'ÁÉÍÓÚ', 'AEIOU'), 'GASOLINA|BENCINA') THEN 'GASOLINA' WHEN contains(translate(upper({V}), 'ÁÉÍÓÚ', 'AEIOU'), 'ELECTRICO') THEN 'ELECTRICO' WHEN contains(translate(upper({V}), 'ÁÉÍÓÚ', 'AEIOU'), 'HIBRIDO') THEN 'HIBRIDO' ELSE {SIMPLE} END")
normal_form("id_number", N.id_number_form, ["rut_proveedor", "rut_comprador"], r"regexp_replace(regexp_replace(" + rf"regexp_replace(upper({V}), '[ .:-]|RUT|R\.U\.T\.?', '', 'g')" + r", '^(\d{1,2})(\d{3})(\d{3})([0-9K])$', '\1.\2.\3-\4'), '^0+([1-9])', '\1')")
normal_form("date", N.date_form, ["fecha_documento"])
normal_form("gearbox_synonym", N.gearbox_synonym, ["transmision"])


@query()
def normalize_all(spark, d):
    return read_table(spark, d, "campos").select("id", "campo", N.normalize_field(F.col("campo"), F.col("valor")).alias("valor"))


@query()
def export_entities(spark, d):
    return sinks.entities(publish_wide(spark, d).withColumn("archivo", F.col("documento_id").cast("string")).withColumn("texto", F.lit("")), FIELDS).select("archivo", F.to_json("entidades").alias("entidades"))


@query()
def export_prompt_pairs(spark, d):
    best = consolidate.consolidate(read_table(spark, d, "campos"))
    return sinks.prompt_pairs(consolidate.live(read_table(spark, d, "textos")).select("documento_id", "texto_extraccion"), best, TARGET_FIELDS)


@query()
def html_reports(spark, d):
    return sinks.html_reports(consolidate.consolidate(read_table(spark, d, "campos")))


@query(
    f"WITH few AS (SELECT campo, string_agg(t, '|' ORDER BY t) AS muestras FROM (SELECT *, row_number() OVER (PARTITION BY campo ORDER BY t) AS r FROM (SELECT DISTINCT campo, substr(coalesce(archivo_origen, ''), 1, 400) AS t FROM campos WHERE {sql_strip(V)} = '')) WHERE r <= 5 GROUP BY campo) "
    f"SELECT campo, count(*) AS total, count(*) FILTER ({sql_strip(V)} = '') AS vacios, round(100.0 * count(*) FILTER ({sql_strip(V)} = '') / count(*), 1) AS pct_vacios, coalesce(any_value(muestras), '') AS muestras FROM campos LEFT JOIN few USING (campo) GROUP BY campo"
)
def fill_rate_audit(spark, d):
    rates = audit.fill_rate(read_table(spark, d, "campos").withColumn("texto", F.coalesce("archivo_origen", F.lit(""))))
    return rates.withColumn("muestras", F.array_join("muestras", "|"))


LOG = "SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS s, CASE WHEN event_type = 'error' THEN 'ERROR' WHEN value > 50 THEN 'WARNING' ELSE 'INFO' END AS nivel, CAST(ts AS DATE) AS fecha, event_type FROM events"


def event_log(spark, d) -> DataFrame:
    level = F.when(F.col("event_type") == "error", "ERROR").when(F.col("value") > 50, "WARNING").otherwise("INFO")
    return read_table(spark, d, "events").select(F.concat_ws(" | ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), level, F.lit("main.py:1"), F.col("event_type")).alias("value"))


@query(f"SELECT CAST(fecha AS VARCHAR) AS fecha, count(*) FILTER (nivel = 'INFO') AS INFO, count(*) FILTER (nivel = 'WARNING') AS WARNING, count(*) FILTER (nivel = 'ERROR') AS ERROR FROM ({LOG}) GROUP BY fecha")
def log_levels_per_day(spark, d):
    return audit.level_per_day(audit.parse_log(event_log(spark, d))).withColumn("fecha", F.col("fecha").cast("string"))


@query(f"SELECT CAST(fecha AS VARCHAR) AS fecha, count(*) FILTER (nivel = 'INFO') AS INFO, count(*) FILTER (nivel = 'WARNING') AS WARNING, count(*) FILTER (nivel = 'ERROR') AS ERROR FROM ({LOG}) WHERE fecha = DATE '2024-01-15' GROUP BY fecha")
def log_levels_of_a_day(spark, d):
    return audit.level_per_day(audit.parse_log(event_log(spark, d)), "2024-01-15").withColumn("fecha", F.col("fecha").cast("string"))


@query(f"SELECT nivel, count(*) AS n FROM ({LOG}) WHERE date_diff('day', fecha, DATE '2024-02-01') <= 15 GROUP BY nivel")
def log_retention(spark, d):
    return audit.retained(audit.parse_log(event_log(spark, d)), "2024-02-01", 15).groupBy("nivel").agg(F.count("*").alias("n"))


@query("SELECT id, coalesce(lag(id) OVER (ORDER BY id), id) AS anterior, coalesce(lead(id) OVER (ORDER BY id), id) AS siguiente FROM documentos")
def neighbour_ids(spark, d):
    return consolidate.neighbours(read_table(spark, d, "documentos"))


@query("SELECT DISTINCT campo, CAST(coalesce(nullif(list_position([" + ", ".join(repr(f) for f in FIELDS) + f"], campo), 0), {len(FIELDS) + 1}) AS BIGINT) AS orden FROM campos")
def field_order_positions(spark, d):
    return read_table(spark, d, "campos").select("campo").distinct().select("campo", consolidate.field_order(F.col("campo")).cast("long").alias("orden"))


@query(f"SELECT documento_id, campo, id, metodo, valor FROM (SELECT *, row_number() OVER (PARTITION BY documento_id, campo ORDER BY id DESC) r FROM campos WHERE {LIVE}) WHERE r = 1")
def latest_row(spark, d):
    return consolidate.latest_by_id(read_table(spark, d, "campos").select("id", "documento_id", "campo", "metodo", "valor", "deleted_at"), ["documento_id", "campo"]).drop("deleted_at")


@query("SELECT documento_id, campo, valor, metodo FROM (SELECT *, row_number() OVER (PARTITION BY documento_id, campo ORDER BY (metodo <> 'nativo'), id) r FROM campos WHERE " + sql_strip(V) + " <> '') WHERE r = 1")
def preferred_method(spark, d):
    return consolidate.preferred_method(read_table(spark, d, "campos"), "nativo")


@query("SELECT DISTINCT documento_id, campo FROM campos")
def field_pairs(spark, d):
    return consolidate.field_pairs(read_table(spark, d, "campos"))


@query("SELECT campo, valor FROM consolidada WHERE documento_id = 3 AND deleted_at IS NULL")
def document_fields(spark, d):
    return consolidate.document_fields(read_table(spark, d, "campos"), read_table(spark, d, "consolidada"), 3, "consolidado")


@query("SELECT documento_id, metodo, id, entropia FROM (SELECT *, row_number() OVER (PARTITION BY documento_id, metodo ORDER BY id DESC) r FROM textos) WHERE r = 1")
def upsert_texts(spark, d):
    t = read_table(spark, d, "textos").select("documento_id", "metodo", "id", "entropia")
    return consolidate.upsert(t.where("entropia IS NULL"), t.where("entropia IS NOT NULL"), ["documento_id", "metodo"], "id")


@query("SELECT coalesce(a.documento_id, b.documento_id) AS documento_id, coalesce(a.campo, b.campo) AS campo, coalesce(b.valor, a.valor) AS valor, CAST(CASE WHEN b.documento_id IS NULL THEN 0 ELSE 1 END AS INT) AS manual FROM (" + TOP1.format(where="TRUE") + f") a FULL JOIN (SELECT documento_id, campo, max(valor) AS valor FROM campos WHERE {LIVE} AND metodo = 'nativo' AND valor IS NOT NULL GROUP BY ALL) b ON a.documento_id = b.documento_id AND a.campo = b.campo")
def override_merge(spark, d):
    rows = read_table(spark, d, "campos")
    manual = consolidate.live(rows).where("metodo = 'nativo' AND valor IS NOT NULL").select("documento_id", "campo", "valor")
    return consolidate.override_merge(consolidate.consolidate(rows), manual)


@query("SELECT CASE WHEN estado >= 2 THEN 'OK' ELSE 'ERROR' END AS estado, count(*) AS n FROM documentos GROUP BY 1")
def download_status(spark, d):
    docs = read_table(spark, d, "documentos").select("nombre_archivo", F.col("hash_archivo").alias("md5"), "estado")
    return register.status_counts(register.compare_manifest(docs.where("estado >= 2"), docs))


@query("SELECT campo, count(*) AS total, count(*) FILTER (deleted_at IS NULL) AS vivos FROM campos GROUP BY campo")
def soft_delete_visible(spark, d):
    rows = read_table(spark, d, "campos")
    return rows.groupBy("campo").agg(F.count("*").alias("total"), F.count_if(F.col("deleted_at").isNull()).alias("vivos"))


@query("SELECT id, CAST(CASE WHEN estado = 2 AND id IN (SELECT documento_id FROM campos) THEN 3 ELSE estado END AS INT) AS estado FROM documentos")
def state_transition(spark, d):
    return state.advance(read_table(spark, d, "documentos"), read_table(spark, d, "campos"), 3, 2).select("id", "estado")


@query("SELECT DISTINCT documento_id FROM campos WHERE score IS NULL OR isnan(score) OR score = 0")
def unscored_documents(spark, d):
    return state.unscored(read_table(spark, d, "campos")).select("documento_id").distinct()


@query(
    "WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 5 MINUTE THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), k AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) "
    "SELECT user_id, min(ts) AS inicio, max(ts) + INTERVAL 5 MINUTE AS fin, count(*) AS n FROM k GROUP BY user_id, k"
)
def intake_sessions_by_user(spark, d):
    return intake_sessions(read_table(spark, d, "events"), "user_id", "ts", "5 minutes")


@query("SELECT id, nombre_archivo FROM documentos WHERE lower(nombre_archivo) LIKE '%.pdf' AND NOT regexp_matches(nombre_archivo, '^[.~]')")
def intake_names(spark, d):
    return register.intake_names(read_table(spark, d, "documentos")).select("id", "nombre_archivo")


@query("SELECT CAST(estado AS VARCHAR) AS resultado, count(*) AS archivos, CAST(sum(tamano_bytes) AS BIGINT) AS bytes FROM documentos GROUP BY estado")
def run_totals(spark, d):
    return audit.run_totals(read_table(spark, d, "documentos").select(F.col("estado").cast("string").alias("resultado"), F.col("tamano_bytes").alias("bytes")))


@query("SELECT id, campo, score FROM campos WHERE coalesce(score, 0.0) < 0.4")
def below_minimum_score(spark, d):
    return below_minimum(read_table(spark, d, "campos")).select("id", "campo", "score")


@query(r"SELECT id, regexp_replace(valor, '^([^-]*)-([^-]*)-([^-]{4})$', '\3-\2-\1') AS fecha FROM campos WHERE campo = 'fecha_documento'")
def publish_dates(spark, d):
    return read_table(spark, d, "campos").where("campo = 'fecha_documento'").select("id", N.publish_date(F.col("valor")).alias("fecha"))


@query(f"SELECT CAST(fecha AS VARCHAR) AS fecha, rpad(CAST(fecha AS VARCHAR), 12, ' ') || lpad(CAST(i AS VARCHAR), 10, ' ') || lpad(CAST(w AS VARCHAR), 10, ' ') || lpad(CAST(e AS VARCHAR), 10, ' ') AS linea FROM (SELECT fecha, count(*) FILTER (nivel = 'INFO') AS i, count(*) FILTER (nivel = 'WARNING') AS w, count(*) FILTER (nivel = 'ERROR') AS e FROM ({LOG}) GROUP BY fecha)")
def log_summary_lines(spark, d):
    return audit.day_summary(audit.level_per_day(audit.parse_log(event_log(spark, d)))).withColumn("fecha", F.col("fecha").cast("string"))


@query("SELECT 'Resumen de registros' AS asunto, string_agg(linea, chr(10) ORDER BY fecha) AS cuerpo FROM (" + SQL["log_summary_lines"] + ")")
def log_summary_mail(spark, d):
    return audit.summary_mail(log_summary_lines(spark, d))


@query(f"SELECT DISTINCT documento_id, 'documento_' || documento_id || '.html' AS archivo FROM campos WHERE {LIVE} AND valor <> '' AND documento_id IS NOT NULL")
def report_files(spark, d):
    return sinks.report_files(html_reports(spark, d))


@query(f"SELECT id FROM textos WHERE {sql_strip('coalesce(texto_extraccion, $$$$)')} <> '' AND metodo IN ('doctr', 'nativo')")
def enabled_method_texts(spark, d):
    return enabled_texts(read_table(spark, d, "textos"), Settings(methods=("doctr", "nativo"))).select("id")


def written(spark, df: DataFrame, name: str, how: Callable[[DataFrame, str], None]) -> str:
    """The folder that df was written to, in the shared folder: files are read back by whatever executor."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    how(df, path)
    return path


@query("SELECT p_partkey AS clave, p_name AS nombre, CAST(p_size AS BIGINT) AS medida FROM part")
def csv_export(spark, d):
    part = read_table(spark, d, "part").select(F.col("p_partkey").cast("long").alias("clave"), F.col("p_name").alias("nombre"), F.col("p_size").cast("long").alias("medida"))
    return spark.read.option("header", True).schema("clave long, nombre string, medida long").csv(written(spark, part, "csv", lambda df, path: sinks.write_csv(df, path, excel=True)))


@query("SELECT DISTINCT upper(trim(marca)) AS marca FROM diccionario_marcas WHERE trim(marca) <> ''")
def dictionary_file(spark, d):
    marks = read_table(spark, d, "diccionario_marcas").select("marca")
    return dictionary_csv(spark, written(spark, marks, "lista", lambda df, path: sinks.write_csv(df, path, excel=True)), "marca")


@query(f"SELECT documento_id, count(*) AS pares, CAST(sum(length(valor)) AS BIGINT) AS signos FROM (SELECT documento_id, campo, max(coalesce(valor, '')) AS valor FROM ({TOP1.format(where='TRUE')}) WHERE campo IN ('marca', 'color', 'vin') GROUP BY ALL) GROUP BY documento_id")
def jsonl_export(spark, d):
    """Objects of three fields, written as lines of JSON and read again."""
    best = consolidate.consolidate(read_table(spark, d, "campos")).where(F.col("campo").isin("marca", "color", "vin"))
    objects = best.groupBy("documento_id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("campo", F.coalesce("valor", F.lit("")))))).alias("response"))
    lines = objects.select(F.col("documento_id").cast("string").alias("prompt"), "response")
    read = jsonl_pairs(spark, written(spark, lines, "jsonl", lambda df, path: df.write.json(path)))
    return read.select(F.col("prompt").cast("long").alias("documento_id"), F.size("campos").cast("long").alias("pares"), F.aggregate(F.map_values("campos"), F.lit(0).cast("long"), lambda a, v: a + F.length(v)).alias("signos"))


@query(f"SELECT CAST(fecha AS VARCHAR) AS fecha, count(*) FILTER (nivel = 'INFO') AS INFO, count(*) FILTER (nivel = 'WARNING') AS WARNING, count(*) FILTER (nivel = 'ERROR') AS ERROR FROM ({LOG}) GROUP BY fecha")
def log_file_levels(spark, d):
    return audit.level_per_day(audit.parse_log(log_lines(spark, written(spark, event_log(spark, d), "log", lambda df, path: df.write.text(path))))).withColumn("fecha", F.col("fecha").cast("string"))


@query("SELECT doc_id, n_chars AS signos FROM documents WHERE n_chars > 0")
def dead_letters(spark, d):
    """Texts that an engine fails on are parted from the others; here it fails on none but the empty ones."""
    docs = read_table(spark, d, "documents").select("doc_id", F.col("n_chars").alias("signos"), F.when(F.col("n_chars") > 0, F.lit(None)).otherwise("sin texto").cast("string").alias("error"))
    good, _ = sinks.split_errors(docs)
    return good


for _name, _f in (("p4_found", eav.p4_found), ("p4_wide", eav.p4_wide), ("p5_found", units.p5_found), ("p5_common_units", units.p5_common_units), ("p5_hidden_units", units.p5_hidden_units)):
    QUERIES[_name] = _f


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return SQL | oracle.pieces() | oracle.catalogued(TOP1.format(where="TRUE"), SCORE, SQL["publish_wide"], YEAR)

