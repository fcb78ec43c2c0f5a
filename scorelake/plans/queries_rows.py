"""Queries of the per-row rules: cleaning (B), dates (C), text (D), categories (E), scoring output (N)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorelake.functions import categorize, clean, dates, scoring, text, vocab
from scorelake.operators import encode
from scorelake.operators.joins import left_join
from scorelake.plans import stand_ins as si
from scorelake.plans.registry import any_of, bit, joined, query, quote, r, rounded, sql_map, table
from scorelake.plans.scoring import decide
from scorelake.sizing import spread

C = F.col



def documents(spark, sf):
    """Texts dealt out to all cores when the table is one small file."""
    return spread(table(spark, sf, "documents").select("doc_id", "text", "lang"))


# B ---------------------------------------------------------------------------------------------

NUM = {n: f"coalesce(try_cast({n} AS DOUBLE), {d})" for n, d in vocab.NUMERIC_DEFAULTS.items()}


@query("first_present", "SELECT o_orderkey AS row_id, o_orderstatus AS status_value FROM orders")
def _(spark, sf):
    df = table(spark, sf, "orders").withColumnRenamed("o_orderstatus", "situacao")
    return df.select(C("o_orderkey").alias("row_id"), clean.first_present(df, vocab.STATUS_NAMES).alias("status_value"))


@query("coerce_numeric", f"WITH {si.REQUESTS} SELECT row_id, CAST({NUM['idade']} AS DOUBLE) AS idade, "
       f"{NUM['experiencia']} AS experiencia, {NUM['tempo_desempregado']} AS tempo_desempregado FROM requests")
def _(spark, sf):
    return si.requests(spark, sf).select(
        "row_id", *[clean.coerce_numeric(C(n), vocab.NUMERIC_DEFAULTS[n]).alias(n) for n in ("idade", "experiencia", "tempo_desempregado")])


EDU = sql_map("lower(educacao)", vocab.EDUCATION_ALIASES)


@query("normalize_values", f"WITH {si.REQUESTS} SELECT row_id, {EDU} AS educacao, "
       f"{sql_map('lower(vaga_area)', vocab.AREA_ALIASES)} AS vaga_area FROM requests")
def _(spark, sf):
    return si.requests(spark, sf).select(
        "row_id", clean.normalize_values(C("educacao"), vocab.EDUCATION_ALIASES).alias("educacao"),
        clean.normalize_values(C("vaga_area"), vocab.AREA_ALIASES).alias("vaga_area"))


EDU_REQ = sql_map("lower(nullif(educacao, ''))", vocab.EDUCATION_REQUEST_ALIASES)
LEVELS = ", ".join(quote(x) for x in vocab.EDUCATION_LEVELS)


@query("normalize_education", f"WITH {si.REQUESTS} SELECT row_id, {EDU_REQ} AS educacao, "
       f"CAST(coalesce(({EDU_REQ}) IN ({LEVELS}), true) AS INTEGER) AS valida FROM requests")
def _(spark, sf):
    return si.requests(spark, sf).select(
        "row_id", clean.normalize_education(C("educacao")).alias("educacao"), clean.education_valid(C("educacao")).cast("int").alias("valida"))


RULES = [
    ("idade_ausente", "try_cast(idade AS DOUBLE) IS NULL"),
    ("idade_fora_do_intervalo", "NOT (try_cast(idade AS DOUBLE) BETWEEN 18 AND 100)"),
    ("experiencia_ausente", "try_cast(experiencia AS DOUBLE) IS NULL"),
    ("experiencia_negativa", "try_cast(experiencia AS DOUBLE) < 0"),
    ("tempo_desempregado_negativo", "tempo_desempregado < 0"),
    ("salario_anterior_negativo", "salario_anterior < 0"),
    ("anos_estudo_fora_do_intervalo", "NOT (anos_estudo BETWEEN 0 AND 30)"),
    ("educacao_invalida", f"NOT coalesce(({EDU_REQ}) IN ({LEVELS}), true)"),
]
RULE_TEXT = "concat_ws('|', " + ", ".join(f"CASE WHEN {c} THEN {quote(n)} END" for n, c in RULES) + ")"


@query("check_constraints", f"WITH {si.REQUESTS} SELECT row_id, {RULE_TEXT} AS violations, "
       f"CAST({RULE_TEXT} = '' AS INTEGER) AS valid FROM requests")
def _(spark, sf):
    df = si.requests(spark, sf).withColumns({n: clean.coerce_numeric(C(n)) for n in ("idade", "experiencia")})
    out = clean.check_constraints(df)
    return out.select("row_id", joined(C("violations")).alias("violations"), C("valid").cast("int").alias("valid"))


SKILL_LIST = "coalesce(list_transform(string_split(habilidades, ','), lambda x: trim(x)), [])"


@query("normalize_list", f"WITH {si.REQUESTS} SELECT row_id, array_to_string({SKILL_LIST}, '|') AS habilidades, "
       f"CAST(len({SKILL_LIST}) AS INTEGER) AS n FROM requests")
def _(spark, sf):
    df = si.requests(spark, sf)
    items = clean.normalize_list(C("habilidades"), df.schema["habilidades"].dataType)
    return df.select("row_id", joined(items).alias("habilidades"), F.size(items).alias("n"))


ONEHOT_SQL = ", ".join(
    f"CAST(list_contains(list_transform({SKILL_LIST}, lambda x: lower(x)), {quote(s)}) AS INTEGER) AS \"skill_{s}\"" for s in vocab.PROFILE_SKILLS)


@query("skill_onehot", f"WITH {si.REQUESTS} SELECT row_id, {ONEHOT_SQL} FROM requests")
def _(spark, sf):
    df = si.requests(spark, sf)
    items = clean.normalize_list(C("habilidades"), df.schema["habilidades"].dataType)
    return df.select("row_id", *[c.alias(n) for n, c in clean.skill_onehot(items).items()])


RATIO_SQL = (f"greatest(1.0, CAST({NUM['idade']} AS DOUBLE))", NUM["experiencia"], NUM["tempo_desempregado"])


@query("ratio_features", f"WITH {si.REQUESTS} SELECT row_id, {RATIO_SQL[0]} AS idade, "
       f"{r(RATIO_SQL[1] + ' / ' + RATIO_SQL[0])} AS experiencia_por_idade, {r(f'{RATIO_SQL[1]} - {RATIO_SQL[2]}')} AS experiencia_ativa FROM requests")
def _(spark, sf):
    n = {c: clean.coerce_numeric(C(c), vocab.NUMERIC_DEFAULTS[c]) for c in ("idade", "experiencia", "tempo_desempregado")}
    ratios = clean.ratio_features(n["idade"], n["experiencia"], n["tempo_desempregado"])
    return rounded(si.requests(spark, sf).select("row_id", *[c.alias(k) for k, c in ratios.items()]))


@query("area_match", f"WITH {si.REQUESTS} SELECT row_id, {bit('lower(area_formacao) = lower(vaga_area)')} AS match_area FROM requests")
def _(spark, sf):
    return si.requests(spark, sf).select("row_id", clean.area_match(C("area_formacao"), C("vaga_area")).alias("match_area"))


@query("clamp_nonneg", f"WITH {si.REQUESTS} SELECT row_id, {r(f'greatest(0.0, {RATIO_SQL[1]} - {RATIO_SQL[2]})')} AS experiencia_ativa FROM requests")
def _(spark, sf):
    n = {c: clean.coerce_numeric(C(c), vocab.NUMERIC_DEFAULTS[c]) for c in ("experiencia", "tempo_desempregado")}
    return rounded(si.requests(spark, sf).select(
        "row_id", clean.clamp_nonneg(n["experiencia"] - n["tempo_desempregado"]).alias("experiencia_ativa")))


@query("align_schema", "SELECT o_orderkey, 0 AS missing_feature, o_totalprice FROM orders")
def _(spark, sf):
    return clean.align_schema(table(spark, sf, "orders"), ["o_orderkey", "missing_feature", "o_totalprice"])


JOB_SQL = (f"coalesce(vaga_id, 'desconhecido') AS vaga_id, lower(coalesce(vaga_titulo, '')) AS vaga_titulo, "
           f"{sql_map("lower(coalesce(vaga_area, ''))", vocab.AREA_ALIASES)} AS vaga_area, "
           f"{sql_map('lower(coalesce(vaga_senioridade, ' + quote('') + '))', vocab.SENIORITY_ALIASES)} AS vaga_senioridade")


@query("fill_job_fields", f"WITH {si.REQUESTS} SELECT row_id, {JOB_SQL} FROM requests")
def _(spark, sf):
    return clean.fill_job_fields(si.requests(spark, sf)).select("row_id", "vaga_id", "vaga_titulo", "vaga_area", "vaga_senioridade")


BATCH_SQL = f"""WITH {si.REQUESTS}, jobs AS (SELECT row_id, area_formacao, {JOB_SQL}, {EDU} AS educacao,
  {RATIO_SQL[0]} AS idade, {RATIO_SQL[1]} AS experiencia, {RATIO_SQL[2]} AS tempo_desempregado, {SKILL_LIST} AS skills FROM requests)
SELECT row_id, idade, experiencia, educacao, vaga_area, vaga_senioridade, CAST(list_contains(list_transform(skills, lambda x: lower(x)), 'python') AS INTEGER) AS skill_python,
  {bit('lower(area_formacao) = lower(vaga_area)')} AS match_area, {r('experiencia / idade')} AS experiencia_por_idade,
  {r('greatest(0.0, experiencia - tempo_desempregado)')} AS experiencia_ativa, 0 AS unseen_feature FROM jobs"""


@query("preprocess_batch", BATCH_SQL)
def _(spark, sf):
    wanted = ["row_id", "idade", "experiencia", "educacao", "vaga_area", "vaga_senioridade", "skill_python", "match_area",
              "experiencia_por_idade", "experiencia_ativa", "unseen_feature"]
    return rounded(clean.preprocess_batch(si.requests(spark, sf), wanted))


@query("to_int_flags", "SELECT conv_id, turn, CAST(coalesce(nullif(role, 'system') = 'user', false) AS INTEGER) AS is_user FROM conversations")
def _(spark, sf):
    flag = F.nullif(C("role"), F.lit("system")) == "user"
    return table(spark, sf, "conversations").select("conv_id", "turn", clean.to_int_flag(flag).alias("is_user"))


# C ---------------------------------------------------------------------------------------------


@query("parse_ts_lenient", """SELECT event_id, CAST(try_strptime(CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%d-%m-%Y')
  WHEN event_id % 3 = 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE props END, ['%d-%m-%Y', '%Y-%m-%d', '%Y-%m-%d %H:%M:%S']) AS TIMESTAMP) AS parsed FROM events""")
def _(spark, sf):
    kind = C("event_id") % 3
    raw = F.when(kind == 0, F.date_format("ts", "dd-MM-yyyy")).when(
        kind == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(C("props"))
    return table(spark, sf, "events").select("event_id", dates.parse_ts(raw).alias("parsed"))


@query("elapsed_days", f"WITH {si.PROSPECTS} SELECT row_id, {si.DAYS} AS dias FROM prospects")
def _(spark, sf):
    df = si.prospects(spark, sf)
    return df.select("row_id", dates.elapsed_days(C("data_candidatura"), C("ultima_atualizacao")).cast("int").alias("dias"))


@query("calendar_parts", """SELECT event_id, CAST(month(ts) AS INTEGER) AS mes_candidatura, CAST(year(ts) AS INTEGER) AS ano_candidatura,
  CAST(isodow(ts) - 1 AS INTEGER) AS dia_semana_candidatura, CAST(quarter(ts) AS INTEGER) AS trimestre_candidatura FROM events""")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", *[c.alias(n) for n, c in dates.calendar_parts(C("ts")).items()])


@query("month_edge_flags", """SELECT o_orderkey, CAST(day(o_orderdate) > 25 AS INTEGER) AS fim_do_mes,
  CAST(day(o_orderdate) <= 5 AS INTEGER) AS inicio_do_mes FROM orders""")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", *[c.alias(n) for n, c in dates.month_edges(C("o_orderdate")).items()])


@query("event_date", "SELECT event_id, CAST(ts AS DATE) AS date FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", dates.event_date(C("ts")).alias("date"))


# D ---------------------------------------------------------------------------------------------

# Words that occur in the given texts, beside the default lists.
LIKED, DISLIKED = ["anat", "the ", "tion", "éaux"], ["ment", "ering", "sch"]


def sentiment_sql(pos, neg):
    plus = " + ".join(f"CAST(contains(lower(text), {quote(t)}) AS INTEGER)" for t in pos)
    less = " - ".join(f"CAST(contains(lower(text), {quote(t)}) AS INTEGER)" for t in neg)
    return r(f"greatest(-1.0, least(1.0, ({plus} - {less}) / 5.0))")


@query("keyword_sentiment", f"SELECT doc_id, {sentiment_sql(vocab.POSITIVE_TERMS, vocab.NEGATIVE_TERMS)} AS padrao, "
       f"{sentiment_sql(LIKED, DISLIKED)} AS escolhido FROM documents")
def _(spark, sf):
    return rounded(documents(spark, sf).select(
        "doc_id", text.keyword_sentiment(C("text")).alias("padrao"), text.keyword_sentiment(C("text"), LIKED, DISLIKED).alias("escolhido")))


WORD_LIST = "regexp_extract_all({0}, '[^\\s\\x0b\\x1c-\\x1f\\x85\\xa0]+')"


@query("lexicon_sentiment", f"""WITH lexicon AS (SELECT token, (count(*) % 7) / 3.0 - 1 AS polarity FROM (
    SELECT unnest({WORD_LIST.format('lower(text)')}) AS token FROM benchmark) GROUP BY token),
  tokens AS (SELECT doc_id, unnest({WORD_LIST.format('lower(text)')}) AS token FROM documents),
  scored AS (SELECT doc_id, avg(polarity) AS s FROM tokens JOIN lexicon USING (token) GROUP BY doc_id)
  SELECT doc_id, {r('coalesce(s, 0.0)', 5)} AS sentiment FROM documents LEFT JOIN scored USING (doc_id)""")
def _(spark, sf):
    tokens = table(spark, sf, "benchmark").select(F.explode(text.words(F.lower("text"))).alias("token"))
    lexicon = tokens.groupBy("token").agg(((F.count(F.lit(1)) % 7) / 3.0 - 1).alias("polarity"))
    return rounded(text.lexicon_sentiment(documents(spark, sf), "doc_id", "text", lexicon), 5)


def salary_sql(column):
    found = ", ".join(
        f"try_cast(translate(nullif(regexp_extract({column}, {quote(p)}, 1, 'i'), ''), ',.', '.') AS DOUBLE)" for p in vocab.SALARY_PATTERNS)
    return f"coalesce({found})"


@query("extract_salary", f"""SELECT doc_id, {r(f"CASE WHEN v < 100 AND contains(lower(text), 'k') THEN v * 1000 ELSE v END", 4)} AS salario
  FROM (SELECT doc_id, text, {salary_sql('text')} AS v FROM documents)""")
def _(spark, sf):
    return rounded(documents(spark, sf).select("doc_id", text.extract_salary(C("text")).alias("salario")), 4)


@query("extract_days", """SELECT doc_id, try_cast(nullif(regexp_extract(lower(text), '(\\d+)\\s*dias?', 1), '') AS BIGINT) AS dias,
  try_cast(nullif(regexp_extract(lower(text), '(\\d{2,9})\\s*[a-z]', 1), '') AS BIGINT) AS outro FROM documents""")
def _(spark, sf):
    return documents(spark, sf).select(
        "doc_id", text.extract_days(C("text")).alias("dias"), text.extract_days(C("text"), r"(\d{2,9})\s*[a-z]").alias("outro"))


def engaged_sql(low, engaged, blockers, hired, denials):
    return f"(({any_of(low, hired)} AND NOT {any_of(low, denials)}) OR ({any_of(low, engaged)} AND NOT {any_of(low, blockers)}))"


ENGAGED = (["tion", "aux"], ["ering", "éonp"], ["benef", "rement"], ["queai"])


@query("engagement_flag", f"""SELECT doc_id,
  {bit(engaged_sql('lower(text)', vocab.ENGAGEMENT_TERMS, vocab.ENGAGEMENT_BLOCKERS, vocab.HIRED_TERMS, vocab.HIRED_DENIALS))} AS padrao,
  {bit(engaged_sql('lower(text)', *ENGAGED))} AS escolhido FROM documents""")
def _(spark, sf):
    return documents(spark, sf).select(
        "doc_id", text.engagement_flag(C("text")).cast("int").alias("padrao"),
        text.engagement_flag(C("text"), *ENGAGED).cast("int").alias("escolhido"))


@query("contains_any", f"SELECT conv_id, turn, {bit(any_of('lower(text)', vocab.CULTURE_TERMS))} AS fit_cultural FROM conversations")
def _(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", text.culture_flag(C("text")).cast("int").alias("fit_cultural"))


FOUND_TERMS = ["the", "and", "une", "der", "los", "rest", "api", "that"]
# Letters of the given languages count as word characters on both sides.
EDGE = "[^\\p{L}\\p{N}\\p{M}_]"


def term_sql(t):
    return f"regexp_matches(lower(text), {quote(f'(^|{EDGE})' + t + f'($|{EDGE})')})"


def terms_sql(terms):
    return "concat_ws('|', " + ", ".join(f"CASE WHEN {term_sql(t)} THEN {quote(t)} END" for t in terms) + ")"


@query("extract_terms", f"SELECT doc_id, {terms_sql(vocab.COMMENT_SKILLS)} AS habilidades, {terms_sql(FOUND_TERMS)} AS termos FROM documents")
def _(spark, sf):
    return documents(spark, sf).select(
        "doc_id", joined(text.extract_terms(C("text"))).alias("habilidades"), joined(text.extract_terms(C("text"), FOUND_TERMS)).alias("termos"))


@query("term_flags", "SELECT doc_id, " + ", ".join(f"CAST({term_sql(t)} AS INTEGER) AS menciona_{t}" for t in FOUND_TERMS + vocab.FLAGGED_SKILLS) + " FROM documents")
def _(spark, sf):
    flags = text.term_flags(C("__low"), FOUND_TERMS + vocab.FLAGGED_SKILLS)
    return text.with_lower(documents(spark, sf), "text").select("doc_id", *[c.cast("int").alias(n) for n, c in flags.items()])


MORE_PATTERNS = {**vocab.MENTION_PATTERNS, "menciona_artigo": r"\sune\s|the (and|of)", "menciona_acento": r"É[a-z]AUX?"}


@query("regex_flags", "SELECT doc_id, " + ", ".join(
    f"{bit(f'regexp_matches(text, {quote(p)}, {quote('i')})')} AS {n}" for n, p in MORE_PATTERNS.items()) + " FROM documents")
def _(spark, sf):
    flags = text.regex_flags(C("text"), C("__low"), MORE_PATTERNS)
    return text.with_lower(documents(spark, sf), "text").select("doc_id", *[c.cast("int").alias(n) for n, c in flags.items()])


GROUPS = {**vocab.MENTION_GROUPS, "menciona_frances": ["éaux", "ouè", "tion des"], "menciona_ingles_escrito": ["the ", "ing "]}


@query("keyword_group_flags", "SELECT doc_id, " + ", ".join(f"{bit(any_of('lower(text)', g))} AS {n}" for n, g in GROUPS.items()) + " FROM documents")
def _(spark, sf):
    flags = text.keyword_group_flags(C("__low"), GROUPS)
    return text.with_lower(documents(spark, sf), "text").select("doc_id", *[c.cast("int").alias(n) for n, c in flags.items()])


@query("text_length", "SELECT doc_id, CAST(coalesce(length(text), 0) AS INTEGER) AS tamanho FROM documents")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", text.text_length(C("text")).cast("int").alias("tamanho"))


@query("word_count", f"SELECT doc_id, CAST(coalesce(len({WORD_LIST.format('text')}), 0) AS INTEGER) AS palavras FROM documents")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", text.word_count(C("text")).cast("int").alias("palavras"))


@query("withdrawal_risk", f"""SELECT doc_id, CAST({any_of('lower(text)', ['éaux', 'ering the'])} OR ({any_of('lower(text)', ['tion'])}
  AND NOT {engaged_sql('lower(text)', *ENGAGED)}) AS INTEGER) AS risco FROM documents""")
def _(spark, sf):
    low = C("__low")
    risk = text.withdrawal_risk(
        text.contains_any(low, ["éaux", "ering the"]), text.contains_any(low, ["tion"]), text.engagement_flag(C("text"), *ENGAGED))
    return text.with_lower(documents(spark, sf), "text").select("doc_id", risk.alias("risco"))


# E ---------------------------------------------------------------------------------------------


def ladder_sql(low, steps, otherwise):
    return "CASE " + " ".join(f"WHEN {any_of(low, t)} THEN {quote(n)}" for n, t in steps) + f" ELSE {quote(otherwise)} END"


@query("seniority_from_title", f"SELECT doc_id, {ladder_sql('lower(substring(text, 1))', vocab.SENIORITY_LADDER, vocab.UNSPECIFIED)} AS senioridade FROM documents")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", categorize.seniority_from_title(C("text")).alias("senioridade"))


PARTS = [("Anel", ["ring", "washer"]), ("Corpo", ["widget", "gear"]), ("Fixo", ["bolt", "nut"])]


@query("area_from_title", f"""SELECT p_partkey, {ladder_sql('lower(p_name)', vocab.AREA_LADDER, vocab.AREA_OTHER)} AS area,
  {ladder_sql('lower(p_name)', PARTS, vocab.AREA_OTHER)} AS tipo FROM part""")
def _(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", categorize.area_from_title(C("p_name")).alias("area"), categorize.area_from_title(C("p_name"), PARTS).alias("tipo"))


@query("contract_type", f"""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN coalesce(nullif(o_orderpriority, '5-LOW'), {quote(vocab.UNSPECIFIED)})
  ELSE o_orderstatus END AS contrato FROM orders""")
def _(spark, sf):
    nested = F.when(C("o_orderkey") % 3 == 0, F.struct(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("tipo_contratacao")))
    df = table(spark, sf, "orders").select("o_orderkey", nested.alias("informacoes_basicas"), C("o_orderstatus").alias("tipo_contratacao"))
    return df.select("o_orderkey", categorize.contract_type(df).alias("contrato"))


RANKS = [("URGENT", 1), ("HIGH", 2), ("MEDIUM", 3), ("NOT", 4)]


@query("contract_rank", """SELECT o_orderkey, CASE WHEN contains(o_orderpriority, 'URGENT') THEN 1 WHEN contains(o_orderpriority, 'HIGH') THEN 2
  WHEN contains(o_orderpriority, 'MEDIUM') THEN 3 WHEN contains(o_orderpriority, 'NOT') THEN 4 ELSE 0 END AS posicao FROM orders""")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", categorize.contract_rank(C("o_orderpriority"), RANKS).alias("posicao"))


@query("classify_status", f"WITH {si.LABELLED} SELECT row_id, categoria_situacao FROM labelled")
def _(spark, sf):
    return si.prospects(spark, sf).select("row_id", categorize.classify_status(C("situacao")).alias("categoria_situacao"))


@query("binary_target", f"WITH {si.LABELLED} SELECT row_id, target_sucesso FROM labelled")
def _(spark, sf):
    category = categorize.classify_status(C("situacao"))
    return si.prospects(spark, sf).select("row_id", categorize.binary_target(category).alias("target_sucesso"))


RECLASS = (["tion", "aux"], ["ering", "ouè"], ["und", "éon"], ["ar", "en"])


def reclass_sql(low, success, denials, failure, progress):
    return (f"CASE WHEN lang <> 'de' THEN lang WHEN {any_of(low, success)} AND NOT {any_of(low, denials)} THEN 'sucesso' "
            f"WHEN {any_of(low, failure)} THEN 'fracasso' WHEN {any_of(low, progress)} THEN 'em_andamento' ELSE 'indefinido' END")


@query("reclassify_undefined", f"""WITH c AS (SELECT doc_id, {reclass_sql('lower(text)', *RECLASS)} AS categoria FROM documents)
  SELECT doc_id, categoria, CAST(categoria = 'sucesso' AS INTEGER) AS target_sucesso FROM c""")
def _(spark, sf):
    start = F.when(C("lang") == "de", "indefinido").otherwise(C("lang"))
    out = documents(spark, sf).select("doc_id", categorize.reclassify(start, C("text"), *RECLASS).alias("categoria"))
    return out.withColumn("target_sucesso", categorize.binary_target(C("categoria")))


@query("label_encode", f"""WITH v AS (SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), {quote(vocab.UNSPECIFIED)}) AS p, o_orderstatus FROM orders),
  codes AS (SELECT p, row_number() OVER (ORDER BY p) - 1 AS code FROM (SELECT DISTINCT p FROM v))
  SELECT o_orderkey, code AS o_orderpriority_encoded FROM v JOIN codes USING (p)""")
def _(spark, sf):
    df = table(spark, sf, "orders").withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return encode.label_encode(df, "o_orderpriority").select("o_orderkey", "o_orderpriority_encoded")


ROLES = ["assistant", "system", "user"]


@query("onehot", "SELECT conv_id, turn, " + ", ".join(f"CAST(role = '{v}' AS INTEGER) AS role_{v}" for v in ROLES) + " FROM conversations")
def _(spark, sf):
    return encode.onehot(table(spark, sf, "conversations").select("conv_id", "turn", "role"), "role").drop("role")


@query("onehot_drop_first", "SELECT conv_id, turn, " + ", ".join(f"CAST(role = '{v}' AS INTEGER) AS role_{v}" for v in ROLES[1:]) + " FROM conversations")
def _(spark, sf):
    return encode.onehot_drop_first(table(spark, sf, "conversations").select("conv_id", "turn", "role"), ["role"])


# N ---------------------------------------------------------------------------------------------


@query("recommend", f"WITH {si.REQUESTS} SELECT row_id, CAST(p >= 0.5 AS INTEGER) AS prediction, CASE WHEN p >= 0.5 THEN 'Recomendado' ELSE 'Não recomendado' END AS recommendation FROM requests")
def _(spark, sf):
    return si.requests(spark, sf).select("row_id", *[c.alias(n) for n, c in scoring.recommend(C("p")).items()])


@query("apply_threshold", f"WITH {si.REQUESTS} SELECT row_id, CAST(p >= 0.25 AS INTEGER) AS at_025, CAST(p >= 0.99 AS INTEGER) AS at_cap FROM requests")
def _(spark, sf):
    return si.requests(spark, sf).select(
        "row_id", scoring.apply_threshold(C("p"), 0.25).alias("at_025"), scoring.apply_threshold(C("p"), 1.5).alias("at_cap"))




@query("match_score", f"""WITH {si.REQUESTS} SELECT row_id, {r(f"CASE WHEN vaga_area IS NULL THEN NULL WHEN lower(area_formacao) = lower(vaga_area) THEN least(1.0, p * 1.2) ELSE p END", 10)} AS match_score FROM requests""")
def _(spark, sf):
    none = F.lit(None).cast("string")
    has = scoring.has_job(none, none, C("vaga_area"), none)
    matched = clean.area_match(C("area_formacao"), C("vaga_area"))
    return rounded(si.requests(spark, sf).select("row_id", scoring.match_score(C("p"), has, matched).alias("match_score")), 10)


@query("job_info", f"""WITH {si.REQUESTS} SELECT row_id, CASE WHEN coalesce(vaga_id, '') <> '' OR coalesce(vaga_titulo, '') <> '' OR coalesce(vaga_area, '') <> '' THEN
  concat_ws('|', coalesce(vaga_id, 'não especificado'), coalesce(vaga_titulo, 'não especificado'), coalesce(vaga_area, 'não especificada'), 'não especificada') END AS vaga FROM requests""")
def _(spark, sf):
    info = scoring.job_info(C("vaga_id"), C("vaga_titulo"), C("vaga_area"), F.lit(""))
    df = si.requests(spark, sf).select("row_id", info.alias("i"))
    return df.select("row_id", F.when(C("i").isNotNull(), F.concat_ws("|", "i.id", "i.titulo", "i.area", "i.senioridade")).alias("vaga"))


BAND = "CASE WHEN p > 0.9 THEN 'alta' WHEN p > 0.7 THEN 'boa' WHEN p > 0.5 THEN 'moderada' ELSE 'baixa' END"


@query("confidence_band", f"WITH {si.REQUESTS} SELECT row_id, {BAND} AS confianca FROM requests")
def _(spark, sf):
    return si.requests(spark, sf).select("row_id", scoring.confidence_band(C("p")).alias("confianca"))


def known_sql(c):
    return f"CASE WHEN lower(trim({c})) NOT IN ('string', 'none', '') THEN trim({c}) END"


SOFT = f"""known AS (SELECT *, {known_sql('area_formacao')} AS a, {known_sql('vaga_area')} AS w FROM requests),
soft AS (SELECT *, coalesce(contains(lower(w), lower(a)) OR contains(lower(a), lower(w)), false) AS m FROM known)"""


@query("soft_area_match", f"WITH {si.REQUESTS}, {SOFT} SELECT row_id, CAST(m AS INTEGER) AS match_area FROM soft")
def _(spark, sf):
    return si.requests(spark, sf).select("row_id", scoring.soft_area_match(C("area_formacao"), C("vaga_area")).cast("int").alias("match_area"))


YEARS = "try_cast(experiencia AS DOUBLE)"
YEARS_TEXT = f"coalesce(format('{{:.1f}}', {YEARS}) || ' anos', 'não especificada')"
LOW_FIT = f"coalesce((lower(vaga_senioridade) IN ('senior', 'sênior') AND {YEARS} < 6), false)"
MID_FIT = f"coalesce((lower(vaga_senioridade) IN ('pleno', 'pl') AND {YEARS} < 3), false)"
REASON = (f"CASE WHEN {LOW_FIT} THEN 'A vaga requer senioridade senior, mas o candidato possui ' || {YEARS_TEXT} || ' de experiência (geralmente esperado 6+ anos).' "
          f"WHEN {MID_FIT} THEN 'A vaga requer senioridade pleno, mas o candidato possui ' || {YEARS_TEXT} || ' de experiência (geralmente esperado 3+ anos).' "
          f"WHEN lower(vaga_senioridade) IN ('junior', 'jr') AND {YEARS} > 5 THEN 'O candidato possui ' || {YEARS_TEXT} || ' de experiência, superior ao geralmente esperado para uma vaga junior.' ELSE '' END")


@query("seniority_fit", f"WITH {si.REQUESTS} SELECT row_id, CAST(NOT ({LOW_FIT} OR {MID_FIT}) AS INTEGER) AS adequada, {REASON} AS razao FROM requests")
def _(spark, sf):
    fit = scoring.seniority_fit(C("vaga_senioridade"), C("experiencia").try_cast("double"))
    return si.requests(spark, sf).select("row_id", fit["ok"].cast("int").alias("adequada"), fit["reason"].alias("razao"))


EDU_TEXT = (f"CASE WHEN coalesce(e, '') = '' THEN {quote(vocab.EDUCATION_PHRASE_MISSING)} " +
            " ".join(f"WHEN e = {quote(k)} THEN {quote(v)}" for k, v in vocab.EDUCATION_PHRASES.items()) + f" ELSE {quote(vocab.EDUCATION_PHRASE_OTHER)} END")


@query("education_text", f"WITH {si.REQUESTS}, e AS (SELECT row_id, {EDU_REQ} AS e FROM requests) SELECT row_id, {EDU_TEXT} AS texto FROM e")
def _(spark, sf):
    return si.requests(spark, sf).select("row_id", scoring.education_text(clean.normalize_education(C("educacao"))).alias("texto"))


def bullets_sql(title, points):
    found = "list_filter([" + ", ".join(points) + "], lambda x: x IS NOT NULL)"
    return (f"CASE WHEN len({found}) > 0 THEN '{title}' || chr(10) || array_to_string(list_transform({found}, lambda x: '• ' || x), chr(10)) || chr(10) ELSE '' END")


PLACE = ("CASE WHEN w IS NULL THEN '' ELSE ' na área de ' || w END || CASE WHEN coalesce(vaga_senioridade, '') = '' THEN '' ELSE ', nível ' || vaga_senioridade END || '.' || chr(10) || chr(10)")
TITLE = "CASE WHEN coalesce(vaga_titulo, '') = '' THEN '' ELSE '{0}' || vaga_titulo END"
STRONG = bullets_sql("Pontos fortes:", [
    "CASE WHEN m THEN 'Formação em ' || a || ' compatível com a área da vaga (' || w || ')' END",
    f"CASE WHEN {YEARS} > 3 THEN 'Experiência sólida de ' || {YEARS_TEXT} END",
    "CASE WHEN tempo_desempregado < 0.5 THEN 'Curto período sem emprego, indicando atualização profissional' END",
    f"CASE WHEN len({SKILL_LIST}) > 0 THEN 'Competências relevantes: ' || array_to_string(list_slice({SKILL_LIST}, 1, 3), ', ') END"])
CAUTION = bullets_sql("Áreas de atenção:", [
    "CASE WHEN NOT m THEN 'Formação em ' || coalesce(a, 'None') || ' diferente da área da vaga (' || coalesce(w, 'None') || ')' END",
    f"CASE WHEN {LOW_FIT} OR {MID_FIT} THEN {REASON} END"])
REASONS = bullets_sql("Principais considerações:", [
    "CASE WHEN NOT m AND a IS NOT NULL AND w IS NOT NULL THEN 'Incompatibilidade entre a formação do candidato (' || a || ') e a área da vaga (' || w || ')' END",
    "CASE WHEN a IS NULL AND w IS NOT NULL THEN 'Candidato não especificou área de formação para vaga na área de ' || w END",
    "CASE WHEN a IS NOT NULL AND w IS NULL THEN 'Candidato com formação em ' || a || ', mas área da vaga não especificada' END",
    f"CASE WHEN {LOW_FIT} OR {MID_FIT} THEN {REASON} END",
    f"CASE WHEN {YEARS} < 2 THEN 'Experiência limitada de apenas ' || {YEARS_TEXT} END",
    "CASE WHEN tempo_desempregado > 1 THEN 'Período de ' || format('{:.1f}', tempo_desempregado) || ' anos sem emprego formal na área' END"])
EXPLAIN = f"""WITH {si.REQUESTS}, {SOFT}, said AS (SELECT row_id, p,
  'Análise indica ' || {BAND} || ' compatibilidade com a vaga' || {TITLE.format(' de ')} || {PLACE} || {STRONG}
    || CASE WHEN {STRONG} <> '' THEN chr(10) ELSE '' END || {CAUTION} AS yes,
  'O perfil apresenta ' || {BAND} || ' probabilidade de não atender completamente aos requisitos' || {TITLE.format(' da posição de ')} || {PLACE} || {REASONS}
    || CASE WHEN p < 0.3 THEN chr(10) || 'Sugerimos avaliar outros candidatos mais alinhados com os requisitos da posição.'
       ELSE chr(10) || 'O candidato não é recomendado para esta posição, mas pode ser considerado para outras funções mais alinhadas com seu perfil.' END AS no
  FROM soft)
SELECT row_id, trim(CASE WHEN p >= 0.5 THEN yes ELSE no END, ' ' || chr(10)) AS comment FROM said"""


@query("explain_text", EXPLAIN)
def _(spark, sf):
    df = si.requests(spark, sf).withColumnRenamed("p", "prediction_probability")
    skills = clean.normalize_list(C("habilidades"), df.schema["habilidades"].dataType)
    return decide(spread(df.withColumn("habilidades", skills))).select("row_id", "comment")
