"""SQL of queries whose statement is long, put together from named pieces. Patterns are those of the extractors; what the SQL dialect's expressions lack (looking around, Unicode word edges) is written out."""

from __future__ import annotations

from fojas.functions import extract as X
from fojas.functions.fixed import AMOUNT_WORDS, BODY_KINDS, COMMON_MAKES, REPORT_CODE_PREFIXES, VALID_COLOURS, VALID_DOCUMENT_TYPES, VALID_UNITS, VEHICLE_TYPES, YEAR_SIGNS
from fojas.functions.normalize import MONTH_NUMBERS, UNIT_FORMS
from fojas.functions.reading import ACCENTED, DIGITS_READ_AS_LETTERS, LETTERS_READ_AS_DIGITS, MONTHS, NUMBER_WORDS, PLAIN, THEIR_DIGITS, THEIR_LETTERS
from fojas.functions.text import longest_first
from fojas.operators.eav import FOUND_FIELDS
from fojas.operators.units import FACTORS, RANGE, SPELLINGS, UNIT_FIELD
from fojas.schema import FIELD_KINDS, FIELDS, TARGET_FIELDS

#: Before and after a word, as far as letters, digits and underscores go.
EDGE_BEFORE, EDGE_AFTER = r"(?:^|[^\pL\pN_])", r"(?:[^\pL\pN_]|$)"
BLANKS = r"^[\s\x{a0}]+|[\s\x{a0}]+$"


def q(text: str) -> str:
    """A text as SQL literal."""
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '{BLANKS}', '', 'g')"


def ext(x: str, pattern: str, group: int = 1) -> str:
    return strip(f"regexp_extract({x}, {q(pattern)}, {group})")


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def first(values: str) -> str:
    return f"coalesce(list_filter({values}, lambda v: v <> '')[1], '')"


TEXT = "coalesce(texto_extraccion, '')"
UPPER = f"upper({TEXT})"
ENDS = "replace(replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(12), chr(10))"
ALL_LINES = f"string_split({ENDS.format(x=UPPER)}, chr(10))"
FULL_LINES = f"list_filter(list_transform({ALL_LINES}, lambda x: {strip('x')}), lambda x: x <> '')"
RAW_LINES = f"list_filter(list_transform(string_split({ENDS.format(x=TEXT)}, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')"
NEXT = "CASE WHEN i < len(r) THEN " + strip("x") + " || ' ' || " + strip("r[i + 1]") + " ELSE " + strip("x") + " END"


def over(lines: str, value: str) -> str:
    """A query of value per text, with u the upper-case text and r its lines."""
    return f"SELECT id, {value} AS valor FROM (SELECT id, {UPPER} AS u, {lines} AS r FROM textos)"


def cut_at(x: str, ends: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN instr({x}, {q(w)}) > 0 THEN substr({x}, 1, instr({x}, {q(w)}) - 1)" for w in ends) + f" ELSE {x} END"


def listed(values: list[str]) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def synonym(x: str) -> str:
    # Words for the two gearboxes.
    manual, automatic = ["MANUAL", "MECANICA", "MECANIKO", "MECANICO", "MAN", "M/T"], ["AUTOMATICA", "AUTOM", "AUTOMATICO", "AUTOMATIKO", "A/T"]
    return f"CASE WHEN list_contains({listed(manual)}, upper({x})) THEN 'MANUAL' WHEN list_contains({listed(automatic)}, upper({x})) THEN 'AUTOMATICA' ELSE '' END"


def modelo() -> str:
    return f"SELECT id, {strip(cut_at('v', X.MODEL_ENDS))} AS valor FROM (SELECT id, {ext(UPPER, r'(?:MODELO[\s:\-]*)([A-Z0-9\-./ ]{3,40})')} AS v FROM textos)"


def puertas() -> str:
    pattern = r"(?:PUERTAS[\s:\-\.]*(\d+)|(\d+)[\s:\-\.]*PUERTAS)"
    return f"SELECT id, CASE WHEN try_cast(v AS INT) <= 9 THEN v ELSE '' END AS valor FROM (SELECT id, coalesce(nullif({ext(UPPER, pattern)}, ''), {ext(UPPER, pattern, 2)}) AS v FROM textos)"


def unidad_pbv() -> str:
    near = f"list_transform(r, lambda x, i: CASE WHEN {has('x', X.WEIGHT_LABEL_FOR_UNIT)} THEN coalesce(nullif({ext('x', X.WEIGHT_UNIT)}, ''), {ext('coalesce(r[i + 1], $$$$)', X.WEIGHT_UNIT)}) ELSE '' END)"
    return over(ALL_LINES, first(f"list_concat({near}, [{ext('u', X.WEIGHT_UNIT)}])"))


def pbv() -> str:
    number = lambda x: rf"try_cast(replace(replace(regexp_extract({x}, '([\d\.,]+)', 1), '.', ''), ',', '.') AS DOUBLE)"
    per = f"flatten(list_transform(r, lambda x, i: CASE WHEN {has('x', X.WEIGHT_LABEL)} THEN [{number('x')}, {number('coalesce(r[i + 1], $$$$)')}] ELSE [] END))"
    return over(ALL_LINES, f"coalesce(CAST(CAST(trunc(list_max(list_filter({per}, lambda v: v > 10))) AS BIGINT) AS VARCHAR), '')")


def combustible() -> str:
    labelled = f"list_transform(r, lambda x, i: {ext('(' + NEXT + ')', rf'(?:TIPO\s+DE\s+COMBUSTIBLE|TIPO\s+COMBUSTIBLE|COMBUSTIBLE)[\s:\-]*({X.FUELS})')})"
    held = f"list_transform(r, lambda x: coalesce(list_filter({listed(X.FUEL_WORDS)}, lambda f: contains(x, f))[1], ''))"
    return over(ALL_LINES, first(f"list_concat({labelled}, {held})"))


def power() -> str:
    both = "concat_ws(' ', x, r[i + 1])"
    per = [ext(c, p) for c in ("x", f"({both})") for p in X.POWER]
    return first(f"flatten(list_transform(r, lambda x, i: CASE WHEN {has(both, 'POT|HP|CV')} THEN [{', '.join(per)}] ELSE [] END))")


def transmision() -> str:
    labelled = first("[" + ", ".join(ext("u", rf"(?:{label})[\s:\-]*{X.GEARBOX}") for label in X.GEARBOX_LABELS) + "]")
    named = f"list_transform(regexp_extract_all(u, {q(X.GEARBOX)}, 1), lambda x: {synonym('x')})"
    return f"SELECT id, CASE WHEN l <> '' THEN {synonym('l')} WHEN list_contains(n, 'MANUAL') THEN 'MANUAL' WHEN list_contains(n, 'AUTOMATICA') THEN 'AUTOMATICA' ELSE '' END AS valor FROM (SELECT id, {labelled} AS l, {named} AS n FROM (SELECT id, {UPPER} AS u FROM textos))"


def net(r: str = "r", a: str = "a") -> str:
    by = lambda label: f"list_filter(flatten(list_transform({r}, lambda x, i: CASE WHEN {has('x', label)} THEN {a}[i : i + 3] ELSE [] END)), lambda n: n IS NOT NULL)[1]"
    return f"coalesce({by(X.NET_FIRST)}, {by(X.NET_SECOND)})"


NET_AMOUNTS = r"list_transform(r, lambda x: CASE WHEN try_cast(replace(replace(regexp_extract(x, '([\d\.,]{3,})', 1), '.', ''), ',', '') AS BIGINT) > 100 THEN try_cast(replace(replace(regexp_extract(x, '([\d\.,]{3,})', 1), '.', ''), ',', '') AS BIGINT) END)"


def good_tax(x: str) -> str:
    n = rf"try_cast(regexp_replace(regexp_extract({x}, '([\d\.,]{{4,}})', 1), '[^0-9]', '', 'g') AS BIGINT)"
    return f"CASE WHEN {n} >= 1000 AND {n} <> 1900 THEN {n} END"


def tax() -> str:
    parts = []
    for label in X.TAX_LABELS:
        rest = f"regexp_replace(x, {q(f'(?s)^.*?(?:{label})')}, '')"
        parts.append(f"CASE WHEN {has('x', label)} THEN list_concat([{good_tax(rest)}], t[i + 1 : i + 3]) ELSE [] END")
    per = f"flatten(list_transform(r, lambda x, i: CASE WHEN {has('x', r'V\.?A')} THEN flatten([{', '.join(parts)}]) ELSE [] END))"
    return f"list_filter({per}, lambda n: n IS NOT NULL)[1]"


AMOUNTS = f"(SELECT id, r, {NET_AMOUNTS} AS a, list_transform(r, lambda x: {good_tax('x')}) AS t FROM (SELECT id, {FULL_LINES} AS r FROM textos))"


def spoken(x: str) -> str:
    """Amount in words of a text: thousands and millions multiply what came before."""
    plain = f"translate(upper({x}), 'ÁÉÍÓÚÑÜ', 'AEIOUNU')"
    tokens = rf"string_split(trim(regexp_replace(regexp_replace(list_extract(string_split({plain}, 'SON:'), -1), '[^A-Z\s]', '', 'g'), '\s+', ' ', 'g')), ' ')"
    table = "MAP {" + ", ".join(f"{q(k)}: {float(v)}" for k, v in AMOUNT_WORDS.items()) + "}"
    values = f"list_filter(list_transform({tokens}, lambda w: {table}[w]), lambda v: v IS NOT NULL)"
    steps = f"list_prepend({{'t': 0.0::DOUBLE, 'p': 0.0::DOUBLE, 'v': 0.0::DOUBLE}}, list_transform({values}, lambda v: {{'t': 0.0::DOUBLE, 'p': 0.0::DOUBLE, 'v': v::DOUBLE}}))"
    total = f"list_reduce({steps}, lambda a, b: CASE WHEN b.v >= 1000 THEN {{'t': a.t + greatest(a.p, 1.0) * b.v, 'p': 0.0::DOUBLE, 'v': 0.0::DOUBLE}} ELSE {{'t': a.t, 'p': a.p + b.v, 'v': 0.0::DOUBLE}} END)"
    return f"list_transform([{total}], lambda s: CASE WHEN s.t + s.p > 0 THEN CAST(s.t + s.p AS BIGINT) END)[1]"


def monto_total() -> str:
    near = r"list_transform(r[greatest(k - 2, 1) : greatest(k - 2, 1) + least(k + 3, 6)], lambda x: try_cast(replace(regexp_extract(x, '(\d{1,3}(?:\.\d{3})+)', 1), '.', '') AS BIGINT))"
    said = f"list_filter(list_transform(r, lambda x, i: CASE WHEN contains(x, 'SON') THEN {spoken('concat_ws($$ $$, x, r[i + 1], r[i + 2])')} END), lambda n: n > greatest(n0, t0))[1]"
    k = f"list_max(list_transform(r, lambda x, i: CASE WHEN {has('x', X.TOTAL_LABEL)} THEN i - 1 END))"
    return (
        f"SELECT id, coalesce(CAST(coalesce(CASE WHEN k IS NOT NULL THEN coalesce(list_max(list_filter(near, lambda n: n > greatest(n0, t0))), list_filter(near, lambda n: abs(n - (n0 + t0)) <= 100)[1]) END, {said}) AS VARCHAR), '') AS valor "
        f"FROM (SELECT *, {near} AS near FROM (SELECT id, r, coalesce({net()}, 0) AS n0, coalesce({tax()}, 0) AS t0, {k} AS k FROM {AMOUNTS}))"
    )


def num_contrato() -> str:
    hits = f"flatten(list_transform(r, lambda x, i: [{', '.join(f'regexp_replace({ext("(" + NEXT + ")", p)}, {q("[ .:" + chr(92) + "-]+$")}, $$$$)' for p in X.CONTRACTS)}]))"
    return over(ALL_LINES, f"coalesce(list_filter({hits}, lambda v: regexp_matches(v, '\\d') AND v NOT IN ('CONTRATO', 'OPERACION', 'CODIGO', 'INTERNO'))[1], '')")


def tipo_vehiculo() -> str:
    types = longest_first(VEHICLE_TYPES)
    labelled = " ".join(rf"WHEN regexp_matches(u, {q(rf'TIPO(?:\s+DE)?\s+VEHICULO[\s:\-]*{t}(?:[^A-Z]|$)|VEHICULO[\s:\-]*{t}|TIPOVEHICULO{t}')}) THEN {q(t)}" for t in types)
    whole = " ".join(f"WHEN regexp_matches(u, {q(EDGE_BEFORE + t + EDGE_AFTER)}) THEN {q(t)}" for t in types)
    return f"SELECT id, coalesce(CASE WHEN contains(u, 'VEHICULO') THEN CASE {labelled} END END, CASE {whole} END, '') AS valor FROM (SELECT id, {UPPER} AS u FROM textos)"


def fecha_documento() -> str:
    dates = "list_transform(r, lambda x: CASE WHEN NOT regexp_matches(x, '\\d.*\\d{2}') OR " + has("x", X.DUE_DATE) + " THEN '' ELSE " + first("[" + ", ".join(ext("x", p) for p in X.DATES) + "]") + " END)"
    labelled = f"list_transform(r, lambda x, i: CASE WHEN {has('x', X.DATE_LABEL)} AND NOT {has('x', X.DUE_DATE)} THEN {first('d[i : i + 3]')} ELSE '' END)"
    return f"SELECT id, {first(f'list_concat({labelled}, d)')} AS valor FROM (SELECT *, {dates} AS d FROM (SELECT id, list_transform(string_split({UPPER}, chr(10)), lambda x: {strip('x')}) AS r FROM textos))"


ID_SEEN = r"(?:^|[^0-9])(?:\d{1,3}(?:\.\d{3}){1,2}|\d{7,8})-[\dK](?:[^0-9]|$)"


def nombre_proveedor() -> str:
    forms, bans = listed(X.LEGAL_FORMS), listed(X.NOT_A_SUPPLIER)
    w = r"list_transform(regexp_split_to_array(x, '\s+'), lambda w: upper(regexp_replace(w, '[^\pL\pN_]', '', 'g')))"
    firm = (
        f"(regexp_matches(upper(regexp_replace(x, '[^A-Za-z]', '', 'g')), {q('|'.join(X.LEGAL_FORMS))}) AND NOT list_has_any({w}, {bans}) AND (list_has_any({w}, {forms}) OR "
        f"list_has_any(list_transform({w}, lambda y, j: y || coalesce(({w})[j + 1], '')), {forms})))"
    )
    run = r"upper(regexp_replace(x, '[^\pL\pN_]', '', 'g'))"
    joined = f"list_filter(r, lambda x: NOT regexp_matches({run}, {q('|'.join(X.NOT_A_SUPPLIER))}) AND regexp_matches({run}, {q('|'.join(X.LEGAL_FORMS))}))"
    near = "list_concat(list_reverse(r[1 : k - 1]), r[k + 1 :])"
    return (
        f"SELECT id, CASE WHEN k > 0 THEN {first(f'list_concat(list_filter({near}, lambda x: {firm}), {joined})')} ELSE '' END AS valor FROM "
        f"(SELECT *, coalesce(list_position(list_transform(r, lambda x: {has('upper(x)', ID_SEEN)}), true), 0) AS k FROM (SELECT id, {RAW_LINES} AS r FROM textos))"
    )


def nombre_comprador() -> str:
    usable = lambda v: f"CASE WHEN {v} <> '' AND NOT {has(f'upper({v})', X.NOT_A_BUYER)} AND length(regexp_replace(upper({v}), '[^A-Z0-9]', '', 'g')) >= 3 AND regexp_matches(upper({v}), '[A-Z]') THEN {v} ELSE '' END"
    rest = "CASE " + " ".join(f"WHEN {has('upper(x)', label)} THEN regexp_replace(x, {q(f'(?is)^.*?(?:{label})')}, '')" for label in X.BUYER_LABELS) + " END"
    value = strip(rf"regexp_replace(regexp_replace(v, '(?i)[\(\[\{{]\s*[EA]S\s*[\)\]\}}]', '', 'g'), '^[ :.\-\t]+', '')")
    anchor = r"(?:^|[^\pL\pN_])(?:N[º°9]?\s*[:\-]?\s*|N\s*[Oo]\s*[:\-]?\s*|FOLIO\s*[:\-]?\s*|NO\s*[:\-]?\s*)(\d{5,})(?:[^\pL\pN_]|$)"
    beside = f"list_transform(s, lambda x, i: CASE WHEN i <= 20 THEN {rest} END)"
    pick = f"list_transform(b, lambda v, i: CASE WHEN v IS NULL THEN '' ELSE {first(f'list_concat([{usable(value)}], list_transform(s[i + 1 : i + 3], lambda y: {usable("y")}))')} END)"
    return (
        f"SELECT id, CASE WHEN k > 0 THEN {first(pick)} ELSE '' END AS valor FROM (SELECT *, {beside} AS b FROM (SELECT *, r[k + 1 : k + 23] AS s FROM "
        f"(SELECT *, coalesce(list_position(list_transform(r, lambda x: {has('upper(x)', anchor)}), true), 0) AS k FROM (SELECT id, {RAW_LINES} AS r FROM textos))))"
    )


def bare_runs(found: str) -> str:
    return f"list_filter(list_transform({found}, lambda y: replace(y, '-', '')), lambda y: length(y) BETWEEN 7 AND 20 AND regexp_matches(y, '\\d'))"


def n_motor() -> str:
    line = "strip_(x || ' ' || coalesce(r[i + 1], ''))".replace("strip_(", "(")
    runs = rf"regexp_extract_all({cut_at('z', X.ENGINE_ENDS)}, '[A-Z0-9\-]{{7,30}}')"
    near = f"list_transform(list_filter(list_transform(r, lambda x, i: CASE WHEN {has('x', X.ENGINE_LABEL)} THEN {strip(line)} END), lambda z: z IS NOT NULL), lambda z: {first(bare_runs(runs))})"
    whole = r"list_filter(list_filter(list_transform(regexp_extract_all(u, '[\pL\pN_]+'), lambda w: w), lambda w: regexp_full_match(w, '[A-Z0-9]{7,20}')), lambda w: regexp_matches(w, '\d'))"
    return over(ALL_LINES, first(f"list_concat({near}, ({whole})[1:1], {bare_runs(r"regexp_extract_all(u, '[A-Z0-9\-]{7,30}')")})"))


def chassis_valid(y: str) -> str:
    b = f"upper(replace(replace({strip(y)}, '-', ''), ' ', ''))"
    return f"(regexp_full_match({b}, '[A-Z0-9]{{12,20}}') AND length(regexp_replace({b}, '[^A-Z]', '', 'g')) >= 3 AND length(regexp_replace({b}, '[^0-9]', '', 'g')) >= 3 AND NOT {has(b, X.NOT_A_CHASSIS)})"


def n_chasis() -> str:
    u = rf"regexp_replace(regexp_replace({UPPER}, '([A-Z]{{3,15}})\s*:', chr(10) || '\1:', 'g'), 'II|//|  ', chr(10), 'g')"
    labelled = f"replace(replace({ext('u', X.CHASSIS)}, ' ', ''), '-', '')"
    whole = r"list_filter(regexp_extract_all(u, '[\pL\pN_]+'), lambda w: regexp_full_match(w, '[A-Z0-9]{12,20}') AND " + chassis_valid("w") + ")"
    runs = r"list_filter(regexp_extract_all(u, '[A-Z0-9\-]{12,30}'), lambda w: " + chassis_valid("w") + ")"
    return f"SELECT id, {first(f'list_concat([CASE WHEN {chassis_valid("l")} THEN l ELSE $$$$ END], ({whole})[1:1], ({runs})[1:1])')} AS valor FROM (SELECT *, {labelled} AS l FROM (SELECT id, {u} AS u FROM textos))"


# forms of values
V = "coalesce(valor, '')"
SIMPLE = rf"regexp_replace(translate(regexp_replace(upper({strip(V)}), '\s+', ' ', 'g'), 'ÁÉÍÓÚÑ', 'AEIOUN'), '[^\pL\pN_\s\-.]', '', 'g')"
BARE = f"trim(replace(replace({V}, '.', ''), ',', ''))"
NUMBER = rf"CASE WHEN regexp_full_match({BARE}, '\d+') AND try_cast({BARE} AS HUGEINT) > 0 THEN CAST(try_cast({BARE} AS HUGEINT) AS VARCHAR) ELSE '' END"
DISPLACEMENT = rf"CASE WHEN regexp_full_match({BARE}, '\d{{1,9}}') AND try_cast({BARE} AS BIGINT) BETWEEN 51 AND 19999 THEN {BARE} ELSE '' END"
POWER = rf"CASE WHEN try_cast(regexp_extract({V}, '(\d+)', 1) AS BIGINT) BETWEEN 21 AND 1999 THEN CAST(CAST(regexp_extract({V}, '(\d+)', 1) AS BIGINT) AS VARCHAR) ELSE '' END"
UNIT = "CASE " + " ".join(f"WHEN upper({V}) = {q(k)} THEN {q(v)}" for k, v in UNIT_FORMS.items()) + f" ELSE upper({V}) END"
VEHICLE_NUMBER = rf"CASE WHEN regexp_full_match(replace(upper({strip(V)}), ' ', ''), '[A-Z0-9]{{17}}') THEN replace(upper({strip(V)}), ' ', '') ELSE '' END"
PLAIN_V = f"translate(upper({V}), 'ÁÉÍÓÚ', 'AEIOU')"
GEARBOX = f"CASE WHEN contains({PLAIN_V}, 'MANUAL') THEN 'MANUAL' WHEN regexp_matches({PLAIN_V}, 'AUTOMATIC[AO]') THEN 'AUTOMATICA' WHEN contains({PLAIN_V}, 'CVT') THEN 'CVT' ELSE {SIMPLE} END"
FUEL = f"CASE WHEN contains({PLAIN_V}, 'DIESEL') THEN 'DIESEL' WHEN regexp_matches({PLAIN_V}, 'GASOLINA|BENCINA') THEN 'GASOLINA' WHEN contains({PLAIN_V}, 'ELECTRICO') THEN 'ELECTRICO' WHEN contains({PLAIN_V}, 'HIBRIDO') THEN 'HIBRIDO' ELSE {SIMPLE} END"
ID_NUMBER = r"regexp_replace(regexp_replace(" + rf"regexp_replace(upper({V}), '[ .:-]|RUT|R\.U\.T\.?', '', 'g')" + r", '^(\d{1,2})(\d{3})(\d{3})([0-9K])$', '\1.\2.\3-\4'), '^0+([1-9])', '\1')"


def date_form() -> str:
    v = rf"trim(regexp_replace(regexp_replace(upper({strip(V)}), '[^\pL\pN_\s/-]', '', 'g'), '\s+', ' ', 'g'))"
    months = "MAP {" + ", ".join(f"{q(k)}: {q(x)}" for k, x in MONTH_NUMBERS.items()) + "}"
    iso = f"try_cast(CASE WHEN regexp_full_match({v}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN {v} END AS DATE)"
    out = [f"WHEN year({iso}) BETWEEN 1900 AND 2100 THEN strftime({iso}, '%Y-%m-%d')"]
    forms = [(r"(\d{1,2})-(\d{1,2})-(\d{4})", False), (r"(\d{1,2})[-\s]?([A-Z]+)[-\s]?(\d{4})", True), (r"(\d{1,2})/(\d{1,2})/(\d{4})", False), (r"(\d{1,2})\s*(?:DE\s*)?([A-Z]+?)\s*(?:DE\s*)?(\d{4})", True)]
    for pattern, named in forms:
        part = lambda k: f"regexp_extract({v}, {q('^' + pattern + '$')}, {k})"  # noqa: B023, E731
        month = f"{months}[{part(2)}]" if named else part(2)
        out.append(f"WHEN regexp_full_match({v}, {q(pattern)}) AND try_cast({part(3)} AS INT) BETWEEN 1900 AND 2100 AND {month} IS NOT NULL THEN {part(3)} || '-' || lpad({month}, 2, '0') || '-' || lpad({part(1)}, 2, '0')")
    out.append(f"WHEN regexp_full_match({v}, '\\d{{4}}') AND try_cast({v} AS INT) BETWEEN 1900 AND 2100 THEN {v}")
    return "CASE " + " ".join(out) + " ELSE '' END"


def normal_form() -> str:
    """The normal form of a row's valor by its campo."""
    rules = [
        (["rut_proveedor", "rut_comprador"], ID_NUMBER), (["fecha_documento"], date_form()), (["unidad_pbv", "unidad_carga", "unidad_potencia"], UNIT), (["pbv", "carga", "asientos", "puertas", "anio"], NUMBER),
        (["cilindrada"], DISPLACEMENT), (["potencia_motor"], POWER), (["transmision"], GEARBOX), (["combustible"], FUEL), (["vin"], VEHICLE_NUMBER),
        (["marca", "modelo", "color", "tipo_vehiculo", "tipo_carroceria", "nombre_proveedor", "nombre_comprador", "traccion", "n_motor", "n_chasis", "serie", "cit", "ejes"], SIMPLE),
    ]
    return "CASE " + " ".join(f"WHEN campo IN ({', '.join(map(q, fs))}) THEN {x}" for fs, x in rules) + f" ELSE {strip(V)} END"


def strict(score: str, year: int) -> str:
    """score: the query with the tables x and s of the rules in force (columns of campos, v, raw)."""
    parts = r"regexp_replace(CASE WHEN regexp_full_match(v, '\d{1,2}/\d{1,2}/\d{4}') THEN v END, '^(\d+)/(\d+)/(\d+)$', '\3-\2-\1')"
    date = f"coalesce(try_cast({parts} AS DATE), try_cast(CASE WHEN regexp_full_match(v, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN v END AS DATE))"
    u = "upper(v)"
    return score + f"""SELECT id, campo, CAST(round(CASE WHEN campo = 'tipo_doc' AND metodo = 'paddleocr' THEN least(1.0, s + 0.2) ELSE s END, 2) AS DOUBLE) AS score FROM (SELECT *, CASE WHEN coalesce(valor, '') = '' THEN 0.0
WHEN campo = 'anio' THEN CASE WHEN NOT regexp_full_match(v, '\\p{{Nd}}+') THEN 0.0 WHEN try_cast(v AS INT) BETWEEN 1900 AND {year + 1} THEN 1.0 ELSE 0.1 END
WHEN campo = 'fecha_documento' THEN CASE WHEN {date} IS NULL THEN 0.0 WHEN year({date}) BETWEEN 2000 AND {year} THEN 1.0 ELSE 0.3 END
WHEN campo = 'placa_patente' THEN CASE WHEN regexp_full_match({u}, '[A-Z]{{2,4}}\\d{{2,4}}') THEN 1.0 ELSE 0.3 END
WHEN campo = 'marca' THEN CASE WHEN list_contains({listed(COMMON_MAKES)}, {u}) THEN 1.0 ELSE 0.1 END
WHEN campo = 'vin' THEN CASE WHEN length(v) = 17 AND NOT regexp_matches({u}, '[IOQ]') THEN CASE WHEN contains('{YEAR_SIGNS}', substr({u}, 10, 1)) THEN 1.0 ELSE 0.5 END ELSE 0.3 END
WHEN campo = 'color' THEN CASE WHEN list_contains({listed(VALID_COLOURS)}, {u}) THEN 1.0 ELSE 0.3 END WHEN campo = 'tipo_doc' THEN CASE WHEN list_contains({listed(VALID_DOCUMENT_TYPES)}, {u}) THEN 1.0 ELSE 0.1 END
WHEN campo IN ('unidad_pbv', 'unidad_carga', 'unidad_potencia') THEN CASE WHEN list_contains({listed(VALID_UNITS)}, {u}) THEN 1.0 ELSE 0.3 END ELSE raw END AS s FROM s)"""


def json_object(names: list[str], keep: str) -> str:
    """JSON text of the columns of these names, in order, those for which keep (with {{c}} for the column) holds."""
    parts = ", ".join(f"CASE WHEN {keep.format(c=n)} THEN {q(chr(34) + n + chr(34) + ':')} || CAST(to_json({n}) AS VARCHAR) END" for n in names)
    return f"'{{' || coalesce(list_aggregate(list_filter([{parts}], lambda x: x IS NOT NULL), 'string_agg', ','), '') || '}}'"


def pairs(top1: str) -> str:
    cols = ", ".join(f"coalesce(min(CASE WHEN campo = {q(f)} THEN n END), '') AS {f}" for f in TARGET_FIELDS)
    return (
        f"SELECT t.documento_id, t.texto_extraccion AS prompt, {json_object(TARGET_FIELDS, 'true')} AS response FROM textos t JOIN "
        f"(SELECT documento_id, {cols} FROM (SELECT documento_id, campo, {normal_form()} AS n FROM ({top1})) GROUP BY documento_id) w USING (documento_id) WHERE t.deleted_at IS NULL AND t.texto_extraccion IS NOT NULL"
    )


def reports(top1: str) -> str:
    escape = lambda x: f"replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"
    row = f"'<tr><td>' || {escape('campo')} || '</td><td>' || {escape(V)} || '</td></tr>'"
    return f"SELECT documento_id, '<html><body><h1>Documento ' || documento_id || '</h1><table>' || chr(10) || string_agg({row}, chr(10) ORDER BY campo) || chr(10) || '</table></body></html>' AS html FROM ({top1}) GROUP BY documento_id"


def catalogued(top1: str, score: str, wide: str, year: int) -> dict[str, str]:
    """Texts that stand on others of the catalogue."""
    return {
        "normalize_date": f"SELECT id, {date_form()} AS valor FROM campos WHERE campo = 'fecha_documento'",
        "normalize_gearbox_synonym": f"SELECT id, {synonym(V)} AS valor FROM campos WHERE campo = 'transmision'",
        "normalize_all": f"SELECT id, campo, {normal_form()} AS valor FROM campos",
        "score_strict": strict(score, year),
        "export_entities": f"SELECT CAST(documento_id AS VARCHAR) AS archivo, {json_object(FIELDS, 'coalesce({c}, $$$$) <> $$$$')} AS entidades FROM ({wide})",
        "export_prompt_pairs": pairs(top1), "html_reports": reports(top1),
    }


def terms(table: str, column: str, direction: str = "-length(t), t") -> str:
    """Terms of a list, longest first."""
    return f"(SELECT list(t ORDER BY {direction}) FROM (SELECT DISTINCT upper(trim({column})) AS t FROM {table} WHERE trim({column}) <> ''))"


def contained(x: str, of: str = "ts") -> str:
    return f"coalesce(list_filter({of}, lambda t: contains({x}, t))[1], '')"


def with_terms(value: str, table: str, column: str, lines: str = ALL_LINES) -> str:
    return f"SELECT id, {value} AS valor FROM (SELECT id, {UPPER} AS u, {lines} AS r, {terms(table, column)} AS ts FROM textos)"


def localidad() -> str:
    place = lambda p: f"regexp_replace({ext('u', p + r'[-:\s]*([A-Z\s]{3,30})')}, '(?s)[\\n\\r:.,].*$', '')"
    return with_terms(first("[" + ", ".join(contained(place(p)) for p in X.TAX_OFFICE) + "]"), "diccionario_comunas", "comuna")


def direccion_comprador() -> str:
    raw = []
    for label in X.ADDRESS_LABELS:
        beside = ext("upper(x)", label + r"\s*[:\-]?\s*(.+)")
        raw.append(f"WHEN {has('upper(x)', label)} THEN CASE WHEN {beside} <> '' THEN {beside} ELSE {strip('coalesce(r[i + 1], $$$$)')} END")
    hit = f"list_filter(list_transform(r, lambda x, i: CASE {' '.join(raw)} END), lambda v: v IS NOT NULL)[1]"
    clean = "regexp_replace(h, '(?i)^[^A-ZÁÉÍÓÚÑáéíóúñ0-9 ]+', '')"
    # terms that aren't contained need no pattern of their own
    term = r"list_filter(list_filter(ts, lambda t: contains(upper(v), t)), lambda t: regexp_matches(upper(v), '([^\pL\pN_\s]|[0-9])\s*' || regexp_escape(t)))[1]"
    cut = strip(f"substr({strip('CASE WHEN instr(upper(v), t) > 0 THEN substr(v, 1, instr(upper(v), t) - 1) ELSE v END')}, 1, 50)")
    rest = rf"regexp_extract({TEXT}, '(?s)^.*?(?:^|[^0-9])(?:\d{{1,3}}(?:\.\d{{3}}){{1,2}}|\d{{7,8}})-[\dkK]((?:[^0-9].*)?)$', 1)"
    lines = f"list_filter(list_transform(string_split({ENDS.format(x=rest)}, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')"
    return (
        f"SELECT id, CASE WHEN coalesce(h, '') = '' THEN '' ELSE {cut} END AS valor FROM (SELECT *, {term} AS t FROM (SELECT *, {clean} AS v FROM (SELECT id, ts, {hit} AS h FROM "
        f"(SELECT id, {lines} AS r, {terms('diccionario_comunas', 'comuna')} AS ts FROM textos))))"
    )


def telefono_comprador() -> str:
    number = r"(?:\d{1,3}(?:\.\d{3}){1,2}|\d{7,8})-[\dkK]"
    rest = f"regexp_extract({TEXT}, {q(rf'(?s)^.*?(?:^|[^0-9]){number}[^0-9](?:.*?[^0-9])?{number}((?:[^0-9].*)?)$')}, 1)"
    lines = f"list_filter(list_transform(string_split({ENDS.format(x=rest)}, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')"
    d = r"regexp_replace(x, '[^\d+]', '', 'g')"
    form = f"CASE WHEN (starts_with({d}, '56') AND length({d}) >= 11) OR (starts_with({d}, '+56') AND length({d}) >= 12) THEN '+56' || right({d}, 9) WHEN length({d}) >= 8 THEN right({d}, 9) ELSE '' END"
    near = f"regexp_extract_all(r[k] || chr(10) || coalesce(r[k + 1], ''), {q(X.PHONE)})"
    return (
        f"SELECT id, CASE WHEN k > 0 THEN {first(f'list_transform({near}, lambda x: {form})')} ELSE '' END AS valor FROM "
        f"(SELECT *, coalesce(list_position(list_transform(r, lambda x: regexp_matches(upper(x), 'TELEFONO|TELÉFONO')), true), 0) AS k FROM (SELECT id, {lines} AS r FROM textos))"
    )


def color() -> str:
    """Greedily three, two or one word; state: next place, text so far; v: the place looked at."""
    u = rf"trim(regexp_replace(regexp_replace({ext(UPPER, X.COLOUR)}, '[^\pL\pN_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
    has_n = lambda n: f"(b.v + {n} - 1 <= len(w) AND list_contains(ts, array_to_string(w[b.v : b.v + {n} - 1], ' ')))"
    joined = lambda n: f"{{'v': b.v + {n}, 'o': CASE WHEN a.o = '' THEN '' ELSE a.o || ' ' END || array_to_string(w[b.v : b.v + {n} - 1], ' ')}}"
    step = f"CASE WHEN b.v < a.v THEN a WHEN {has_n(3)} THEN {joined(3)} WHEN {has_n(2)} THEN {joined(2)} WHEN {has_n(1)} THEN {joined(1)} ELSE {{'v': b.v + 1, 'o': a.o}} END"
    places = "list_prepend({'v': 1::BIGINT, 'o': ''}, list_transform(generate_series(1, greatest(len(w), 1)), lambda i: {'v': i::BIGINT, 'o': ''}))"
    return f"SELECT id, list_reduce({places}, lambda a, b: {step}).o AS valor FROM (SELECT id, string_split({u}, ' ') AS w, {terms('diccionario_colores', 'color')} AS ts FROM textos)"


def tipo_carroceria() -> str:
    kinds = listed(longest_first(BODY_KINDS))
    return over(ALL_LINES, first(f"list_concat([{contained(ext('u', X.BODYWORK), kinds)}], list_transform(r, lambda x: {contained('x', kinds)}))"))


def marca(terms_: str) -> str:
    """A labelled make of the list, else the longest that stands in the text as words; column m."""
    plain = f"regexp_replace(translate({UPPER}, {q(ACCENTED)}, {q(PLAIN)}), '[^\\x00-\\x7F]', '', 'g')"
    text = strip(rf"regexp_replace({plain}, '(?s)\bCOLOR\b.*$', '')")
    label = X.MAKE_LABEL.replace("(?=", "(?:")
    found = ext("x", label)
    words = rf"array_to_string(regexp_split_to_array(regexp_replace({found}, '^[ ,.:]+|[ ,.:]+$', '', 'g'), ' +')[1:3], ' ')"
    labelled = f"list_filter(list_transform(string_split(s, chr(10)), lambda x: {words}), lambda v: v <> '' AND list_contains(ts, v))"
    run = "' ' || regexp_replace(s, '[^A-Z0-9_]+', ' ', 'g') || ' '"
    spelled = "' ' || regexp_replace(t, '[^\\pL\\pN_]', ' ', 'g') || ' '"
    word = f"coalesce(list_filter(ts, lambda t: contains({run}, {spelled}))[1], '')"
    return f"(SELECT id, u, CASE WHEN len({labelled}) > 0 THEN ({labelled})[1] ELSE {word} END AS m FROM (SELECT id, {UPPER} AS u, {text} AS s, {terms_} AS ts FROM textos))"


def cit_por_marca() -> str:
    makes = listed(longest_first(m for m, _ in REPORT_CODE_PREFIXES))
    prefixes = "[" + ", ".join(f"{{'m': {q(m)}, 'p': {q(p)}}}" for m, p in REPORT_CODE_PREFIXES) + "]"
    codes = r"regexp_extract_all(' ' || replace(u, ' ', '  ') || ' ', '[^\pL\pN_]([A-Z0-9]{6,}-[A-Z0-9]{1,3})[^\pL\pN_]', 1)"
    return f"SELECT id, coalesce(list_filter({codes}, lambda x: len(list_filter({prefixes}, lambda s: s.m = m AND starts_with(x, s.p))) > 0)[1], '') AS valor FROM {marca(makes)}"


# readings of numbers and dates
def plain_upper(x: str) -> str:
    return f"translate(upper({strip(x)}), {q(ACCENTED)}, {q(PLAIN)})"


def canonical(x: str) -> str:
    snake = rf"regexp_replace(lower(regexp_replace({strip(x)}, '(\p{{Ll}})(\p{{Lu}})', '\1_\2', 'g')), '[\s\-_.]+', '_', 'g')"
    return f"CASE WHEN {snake} IN ('año', 'ano', 'anio') THEN 'anio' ELSE translate({snake}, {q(ACCENTED)}, {q(PLAIN)}) END"


def digits(x: str) -> str:
    return f"translate({x}, {q(LETTERS_READ_AS_DIGITS)}, {q(THEIR_DIGITS)})"


def integer(x: str) -> str:
    """Whole number of a reading, as text; u is its tidied form."""
    shaped = f"regexp_full_match({x}, '[0-9OQDILSBZG|][0-9OQDILSBZG|., ]*') AND regexp_matches({x}, '[0-9]')"
    number = f"regexp_replace({digits(f"regexp_replace({x}, '[.,][0-9OQDILSBZG|]{{1,2}}$', '')")}, '[^0-9]', '', 'g')"
    words = "MAP {" + ", ".join(f"{q(k)}: {v}" for k, v in NUMBER_WORDS.items()) + "}"
    return f"CASE WHEN {shaped} THEN CAST(try_cast(nullif({number}, '') AS HUGEINT) AS VARCHAR) ELSE CAST({words}[{x}] AS VARCHAR) END"


def integer_form(x: str) -> str:
    u = rf"regexp_replace({plain_upper(x)}, '^(?:ANIO|ANO|CLP|MONTO|NETO|IVA|TOTAL|ASIENTOS|PUERTAS|CILINDRADA)?[:\s]*\$?\s*', '')"
    u = rf"regexp_replace({u}, '\s*(?:CC|C\.C\.|CM3|CMS|ASIENTOS?|PUERTAS?|PESOS)?[.\s]*$', '')"
    return f"regexp_replace({u}, '[.,]?-$', '')"


def date(x: str) -> str:
    """Date of a reading, as text; x is its tidied form."""
    g = "[0-9OQDILSBZG|]"
    ymd = f"({g}{{4}})[-/. ]({g}{{1,2}})[-/. ]({g}{{1,2}})"
    dmy = f"({g}{{1,2}})[-/. ]+(?:DE[L]? )?({g}{{1,2}}|[A-Z0-9]{{3,10}})[-/. ]+(?:DE[L]? )?({g}{{4}}|{g}{{2}})"
    part = lambda p, k: f"regexp_extract({x}, {q('^' + p + '$')}, {k})"
    made = lambda y, m, d: f"strftime(try_cast(CASE WHEN length({y}) = 2 THEN '20' || {y} ELSE {y} END || '-' || {m} || '-' || {d} AS DATE), '%Y-%m-%d')"
    months = "MAP {" + ", ".join(f"{q(k)}: {q(str(v))}" for k, v in MONTHS.items()) + "}"
    middle = part(dmy, 2)
    month = f"CASE WHEN length({middle}) <= 2 THEN {digits(middle)} ELSE {months}[substr(translate({middle}, {q(DIGITS_READ_AS_LETTERS)}, {q(THEIR_LETTERS)}), 1, 3)] END"
    first_ = made(*[digits(part(ymd, k)) for k in (1, 2, 3)])
    last = made(digits(part(dmy, 3)), f"({month})", digits(part(dmy, 1)))
    return f"CASE WHEN NOT regexp_matches({x}, '[0-9]') THEN NULL WHEN regexp_full_match({x}, {q(ymd)}) THEN {first_} WHEN regexp_full_match({x}, {q(dmy)}) AND ({month}) IS NOT NULL THEN {last} END"


def date_tidied(x: str) -> str:
    return rf"regexp_replace({plain_upper(x)}, '^(?:FECHA)?[:\s]*', '')"


def decimal(x: str) -> str:
    t = f"regexp_replace({x}, '[^0-9.,]', '', 'g')"
    return rf"CAST(try_cast(CASE WHEN regexp_full_match({t}, '\d{{1,3}}(?:[.,]\d{{3}})+') THEN regexp_replace({t}, '[.,]', '', 'g') ELSE replace({t}, ',', '.') END AS DOUBLE) AS VARCHAR)"


def best_cells(fields: list[str], others: str) -> str:
    """(documento_id, campo, v): of the live readings of each field the form read most often, then of the higher score, then the smaller; v in its field's written form. others: text for fields that are no number or date."""
    ints, dates, doubles = [[f for f in fields if FIELD_KINDS.get(f) == kind] for kind in ("int", "date", "double")]
    inside = lambda names: f"campo IN ({', '.join(map(q, names or ['']))})"
    value = f"CASE WHEN {inside(ints)} THEN {integer('i')} WHEN {inside(dates)} THEN {date('d')} WHEN {inside(doubles)} THEN {decimal('valor')} ELSE {others} END"
    return (
        f"SELECT documento_id, campo, arg_min(v, struct_pack(n := -n, s := -s, v := v)) AS v FROM (SELECT documento_id, campo, v, count(*) AS n, max(s) AS s FROM (SELECT documento_id, campo, s, {value} AS v FROM "
        f"(SELECT documento_id, {canonical('campo')} AS campo, valor, coalesce(score, 0.0) AS s, {integer_form('valor')} AS i, {date_tidied('valor')} AS d FROM campos WHERE deleted_at IS NULL AND documento_id <> 1) WHERE {inside(fields)}) "
        "WHERE v IS NOT NULL GROUP BY ALL) GROUP BY documento_id, campo"
    )


def wide_table() -> str:
    kinds = {"int": "BIGINT", "double": "DOUBLE", "date": "DATE"}
    cells = best_cells(FIELDS, f"nullif({strip('valor')}, '')")
    columns = ", ".join(f"try_cast(max(CASE WHEN campo = {q(f)} THEN v END) AS {kinds.get(FIELD_KINDS.get(f), 'VARCHAR')}) AS {f}" for f in FIELDS)
    return f"SELECT documento_id, {columns} FROM (SELECT DISTINCT documento_id FROM campos WHERE documento_id <> 1) LEFT JOIN ({cells}) USING (documento_id) GROUP BY documento_id"


# quantities
def split_number(measure: str, u: str) -> tuple[str, str]:
    """(number as written, the unit after it) of a tidied value. A pound word after the number is no part of it."""
    pattern = r"^([0-9OIL|][0-9OQIL|., ]*?)((?:L8S?$|LBS?(?:[^\pL\pN_]|$)|LIBRA).*|[^0-9OQIL|., ].*|)$"
    num = rf"regexp_replace(regexp_replace(translate(regexp_extract({u}, {q(pattern)}, 1), 'OQIL|', '00111'), '[., ]+$', ''), ' +', '.', 'g')"
    return f"CASE WHEN regexp_matches({num}, '[0-9]') THEN {num} END", unit(measure, f"regexp_extract({u}, {q(pattern)}, 2)")


def unit(measure: str, x: str) -> str:
    letters = rf"translate(regexp_replace({plain_upper(x)}, '[\s.]+', '', 'g'), '013568', 'OIESGB')"
    return "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in SPELLINGS[measure].items()) + f"}}[{letters}]"


def base(measure: str) -> str:
    low, high = RANGE[measure]
    factor = "MAP {" + ", ".join(f"{q(k)}: {v!r}::DOUBLE" for k, v in FACTORS[measure].items()) + "}[unit]"
    # all separators but the last part thousands
    decimal_ = rf"try_cast(replace(regexp_replace(regexp_extract(num, '^(.*?)([.,]?[^.,]*)$', 1), '[.,]', '', 'g') || regexp_extract(num, '^(.*?)([.,]?[^.,]*)$', 2), ',', '.') AS DOUBLE) * {factor}"
    grouped = rf"CASE WHEN regexp_full_match(num, '\d{{1,3}}(?:[.,]\d{{3}})+') THEN try_cast(regexp_replace(num, '[.,]', '', 'g') AS DOUBLE) * {factor} END"
    return f"CASE WHEN {grouped} BETWEEN {low} AND {high} THEN {grouped} WHEN {decimal_} BETWEEN {low} AND {high} THEN {decimal_} END"


def stated_units() -> str:
    per, said = [], []
    for m, u in UNIT_FIELD.items():
        num, own = split_number(m, "u")
        per.append(f"SELECT documento_id, {q(m)} AS campo, {num} AS num, {own} AS own FROM (SELECT documento_id, {plain_upper('valor')} AS u FROM named WHERE campo = {q(m)})")
        said.append(f"SELECT documento_id, {q(m)} AS campo, {unit(m, 'valor')} AS unit FROM named WHERE campo = {q(u)}")
    both = "CASE campo WHEN 'pbv' THEN " + base("pbv") + " ELSE " + base("potencia_motor") + " END"
    return (
        f"WITH named AS (SELECT documento_id, {canonical('campo')} AS campo, valor FROM campos WHERE deleted_at IS NULL AND documento_id <> 1 AND valor IS NOT NULL), "
        f"reads AS (SELECT documento_id, campo, num, own, count(*) AS n FROM ({' UNION ALL '.join(per)}) WHERE num IS NOT NULL GROUP BY ALL), "
        f"said AS (SELECT documento_id, campo, arg_max(unit, struct_pack(n := n, u := unit)) AS said FROM (SELECT documento_id, campo, unit, count(*) AS n FROM ({' UNION ALL '.join(said)}) WHERE unit IS NOT NULL GROUP BY ALL) GROUP BY ALL), "
        f"based AS (SELECT *, {both} AS base FROM (SELECT reads.*, coalesce(own, said) AS unit FROM reads LEFT JOIN said USING (documento_id, campo))), "
        "voted AS (SELECT documento_id, campo, unit, round(base) AS rounded, sum(n) AS n, max(base) AS base FROM based GROUP BY ALL), "
        "one AS (SELECT documento_id, campo, arg_max(base, struct_pack(b := base IS NOT NULL, u := unit IS NOT NULL, n := n, v := base)) AS base FROM voted WHERE base IS NOT NULL AND unit IS NOT NULL GROUP BY ALL) "
        "SELECT documento_id, campo, CAST(round(base) AS BIGINT) AS valor FROM one"
    )


def pieces() -> dict[str, str]:
    return {
        "extract_modelo": modelo(), "extract_puertas": puertas(), "extract_unidad_pbv": unidad_pbv(), "extract_pbv": pbv(), "extract_combustible": combustible(),
        "extract_potencia_motor": over(FULL_LINES, power()), "extract_unidad_potencia": over(FULL_LINES, f"CASE WHEN {power()} <> '' THEN {ext('u', '(KCAL/S|BTU/S|CV|HP|KP|KW)')} ELSE '' END"),
        "extract_transmision": transmision(), "extract_monto_neto": f"SELECT id, coalesce(CAST({net()} AS VARCHAR), '') AS valor FROM {AMOUNTS}", "extract_monto_iva": f"SELECT id, coalesce(CAST({tax()} AS VARCHAR), '') AS valor FROM {AMOUNTS}",
        "extract_monto_total": monto_total(), "extract_num_contrato": num_contrato(), "extract_tipo_vehiculo": tipo_vehiculo(), "extract_fecha_documento": fecha_documento(),
        "extract_nombre_proveedor": nombre_proveedor(), "extract_nombre_comprador": nombre_comprador(), "extract_n_motor": n_motor(), "extract_n_chasis": n_chasis(), "p4_found": f"SELECT documento_id, campo, v AS valor FROM ({best_cells(FOUND_FIELDS, 'NULL')})", "p4_wide": wide_table(), "p5_found": stated_units(), "extract_localidad": localidad(), "extract_direccion_comprador": direccion_comprador(), "extract_telefono_comprador": telefono_comprador(), "extract_color": color(), "extract_tipo_carroceria": tipo_carroceria(),
        "extract_ciudad_comprador": with_terms(contained(ext("u", r"(?:CIUDAD\s*[:\-]?\s*)([A-Z\s]+)")), "diccionario_comunas", "comuna"),
        "extract_marca": f"SELECT id, m AS valor FROM {marca(terms('diccionario_marcas', 'marca'))}", "extract_cit_por_marca": cit_por_marca(),
    }
