"""Word lists, maps and patterns used as argument defaults."""

from __future__ import annotations

import numpy as np

# The results depend on these exact words, codes, limits and patterns.

SEGMENT_DEFAULT = "default"
UNSPECIFIED = "Não Especificado"
FALLBACK_DATE = "2021-01-01"

APPLICATION_DATE_NAMES = ["datacandidatura", "data_candidatura", "data"]
UPDATE_DATE_NAMES = ["ultimaatualizacao", "ultima_atualizacao", "data_atualizacao"]
STATUS_NAMES = ["situacao_candidato", "situacao_candidado", "situacao", "status"]
DATE_FORMATS = ["dd-MM-yyyy", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss"]

NUMERIC_DEFAULTS = {
    "idade": 30,
    "experiencia": 5,
    "tempo_desempregado": 0,
    "anos_estudo": 12,
    "salario_anterior": 0,
    "anos_ultimo_emprego": 0,
}

EDUCATION_ALIASES = {
    "fundamental": "ensino_fundamental",
    "medio": "ensino_medio",
    "superior": "ensino_superior",
    "graduacao": "ensino_superior",
    "pos": "pos_graduacao",
    "mestrado": "pos_graduacao",
    "doutorado": "pos_graduacao",
}

EDUCATION_REQUEST_ALIASES = {
    "fundamental": "ensino_fundamental",
    "ensino fundamental": "ensino_fundamental",
    "medio": "ensino_medio",
    "ensino médio": "ensino_medio",
    "ensino medio": "ensino_medio",
    "superior": "ensino_superior",
    "ensino superior": "ensino_superior",
    "graduacao": "ensino_superior",
    "graduação": "ensino_superior",
    "pos": "pos_graduacao",
    "pós": "pos_graduacao",
    "pos graduacao": "pos_graduacao",
    "pós graduação": "pos_graduacao",
    "pos-graduacao": "pos_graduacao",
    "mestrado": "pos_graduacao",
    "doutorado": "pos_graduacao",
}

EDUCATION_LEVELS = ["ensino_fundamental", "ensino_medio", "ensino_superior", "pos_graduacao"]

EDUCATION_PHRASES = {
    "ensino_fundamental": "formação de nível fundamental",
    "ensino_medio": "formação de nível médio",
    "ensino_superior": "formação superior",
    "pos_graduacao": "pós-graduação",
}
EDUCATION_PHRASE_OTHER = "formação acadêmica"
EDUCATION_PHRASE_MISSING = "formação não especificada"

AREA_ALIASES = {
    "ti": "tecnologia",
    "tecnologia": "tecnologia",
    "tech": "tecnologia",
    "vendas": "comercial",
    "comercial": "comercial",
    "marketing": "marketing",
    "recursos humanos": "rh",
    "rh": "rh",
    "financeiro": "financeiro",
    "finanças": "financeiro",
    "contabilidade": "financeiro",
    "administrativo": "administrativo",
    "adm": "administrativo",
    "engenharia": "engenharia",
}

SENIORITY_ALIASES = {
    "junior": "junior",
    "júnior": "junior",
    "jr": "junior",
    "pleno": "pleno",
    "pl": "pleno",
    "senior": "senior",
    "sênior": "senior",
    "sr": "senior",
    "especialista": "senior",
    "trainee": "junior",
    "estagiário": "estagio",
    "estagiario": "estagio",
    "estágio": "estagio",
}

PROFILE_SKILLS = [
    "python", "java", "javascript", "html", "css", "sql", "r", "c++", "c#", "php", "ruby", "swift",
    "kotlin", "analise_dados", "machine_learning", "ia", "estatistica",
]

POSITIVE_TERMS = [
    "aprovado", "contratado", "encaminhado", "interessado", "motivado", "entusiasmado", "ótimo",
    "excelente", "positivo",
]
NEGATIVE_TERMS = [
    "não", "reprovado", "desistiu", "declinou", "rejeitado", "sem interesse", "preocupado", "insatisfeito",
]

SALARY_PATTERNS = [
    r"R\$?\s*(\d{1,3}(?:\.\d{3})*(?:,\d{2})?)",
    r"(\d{1,3}(?:\.\d{3})*)\s*reais?",
    r"pretenso.*?(\d{1,3}(?:\.\d{3})*)",
    r"sal[aá]rio.*?(\d{1,3}(?:\.\d{3})*)",
    r"(\d{1,3}(?:\.\d{3})*)[kK]",
]
DAYS_PATTERN = r"(\d+)\s*dias?"

ENGAGEMENT_TERMS = [
    "interesse", "interessado", "motivado", "disponível", "empolgado", "comprometido", "dedicado",
    "gostaria", "quer", "aceita", "aceitou", "topou", "contente", "animado", "positivo", "encaminhar",
    "prosseguir", "continuar", "gostou", "aprovou", "contratado", "contratação",
]
ENGAGEMENT_BLOCKERS = [
    "não tem", "sem", "não possui", "não demonstrou", "pouco", "falta de", "desistiu", "declinou",
    "recusou", "não aceitou", "não quer", "não gostou", "não vai", "não está", "não pode", "fora do",
]
HIRED_TERMS = ["contratado", "contratação"]
HIRED_DENIALS = ["não contratado", "não foi contratado", "desistiu da contratação"]

CULTURE_TERMS = [
    "fit", "cultura", "valores", "adequado", "perfil", "alinhado", "equipe", "time", "comportamental",
    "compatível", "adaptação",
]

COMMENT_SKILLS = [
    "java", "python", "javascript", "react", "node", "angular", "aws", "cloud", "devops", "scrum",
    "agile", "sap", "abap", "sql", "database", "front-end", "backend", "mobile", "api", "rest", "spring",
    "django", "azure", "gcp", "microservices", "kubernetes", "docker", "ci/cd", "git", "arquitetura",
    "performance",
]
FLAGGED_SKILLS = ["java", "python", "sap", "cloud", "agile"]

MENTION_PATTERNS = {
    "menciona_ingles": r"ingl[eê]s",
    "menciona_contratacao": r"contrata|pj|clt|cooperado",
    "menciona_projeto": r"projeto|cliente",
    "menciona_valores": r"R\$|valor|salário|remuneração",
    "menciona_desistencia": r"desistiu|declinou|recusou|não aceitou",
    "menciona_outra_proposta": r"outra proposta|outra oferta|outro processo",
}

MENTION_GROUPS = {
    "menciona_inicio_projeto": ["inicio", "projeto", "começo", "começar", "início"],
    "menciona_cliente": ["cliente", "contratante"],
    "menciona_valor": ["valor", "salário", "remuneração", "proposta", "financeiro"],
    "menciona_outra_proposta": ["outra proposta", "outra oferta", "outro processo"],
    "menciona_aceitar": ["aceita", "aceitou", "aceitar", "topou", "aprovou"],
}

SENIORITY_LADDER = [
    ("Senior", ["senior", "sr", "sênior", "especialista", "specialist"]),
    ("Junior", ["junior", "jr", "júnior", "trainee"]),
    ("Pleno", ["pleno", "pl", "mid"]),
]

AREA_LADDER = [
    ("SAP", ["sap", "abap", "fico", "mm", "sd"]),
    ("Desenvolvimento", ["java", "python", ".net", "dev", "programador", "desenvolvedor"]),
    ("Data/BI", ["data", "bi", "analytics", "big data", "dados"]),
    ("DevOps/Cloud", ["devops", "cloud", "aws", "infra"]),
    ("Database", ["dba", "oracle", "database", "banco de dados"]),
]
AREA_OTHER = "Outros"

CONTRACT_RANKS = [
    ("PJ/Autônomo", 1),
    ("CLT Full", 2),
    ("Cooperado", 3),
    ("Hunting", 4),
    ("CLT Cotas", 5),
]

STATUS_CATEGORIES = {
    "sucesso": [
        "Contratado pela Decision", "Contratado como Hunting", "Aprovado", "Proposta Aceita",
        "Encaminhar Proposta", "Documentação PJ", "Documentação CLT", "Documentação Cooperado",
    ],
    "em_andamento": [
        "Prospect", "Inscrito", "Encaminhado ao Requisitante", "Entrevista Técnica",
        "Entrevista com Cliente", "Em avaliação pelo RH",
    ],
    "fracasso": [
        "No Aprovado pelo Cliente", "Não Aprovado pelo Cliente", "No Aprovado pelo RH",
        "Não Aprovado pelo RH", "No Aprovado pelo Requisitante", "Não Aprovado pelo Requisitante",
        "Desistiu", "Desistiu da Contratação", "Sem interesse nesta vaga", "Recusado",
    ],
}
STATUS_UNDEFINED = "indefinido"

RECLASSIFY_SUCCESS = ["contratado", "aprovado", "aceito", "proposta aceita"]
RECLASSIFY_SUCCESS_DENIALS = ["não foi contratado", "não aprovado"]
RECLASSIFY_FAILURE = ["desistiu", "recusou", "declinou", "sem interesse", "não aprovado"]
RECLASSIFY_PROGRESS = ["em análise", "avaliação", "aguardando", "entrevista marcada"]

ENCODED_COLUMNS = ["recrutador", "area_vaga", "senioridade_vaga", "modalidade", "tipo_contratacao"]
ONEHOT_COLUMNS = ["area_vaga", "senioridade_vaga", "tipo_contratacao"]

NUMERIC_FEATURES = [
    "dias_no_pipeline", "mes_candidatura", "ano_candidatura", "dia_semana_candidatura",
    "trimestre_candidatura", "fim_do_mes", "inicio_do_mes", "sentimento_comentario",
    "pretensao_salarial_extraida", "disponibilidade_dias", "tamanho_comentario",
    "qtd_palavras_comentario", "taxa_sucesso_recrutador", "total_candidatos_recrutador",
    "popularidade_area", "tempo_medio_pipeline_area", "taxa_sucesso_area", "taxa_sucesso_contratacao",
    "ranking_contratacao", "taxa_engajamento_recrutador",
]
BOOLEAN_FEATURES = [
    "menciona_ingles", "menciona_cliente", "menciona_projeto", "menciona_contratacao",
    "menciona_valores", "menciona_desistencia", "menciona_outra_proposta", "engajamento_positivo",
    "fit_cultural", "risco_desistencia", "recrutador_alto_desempenho", "tempo_acima_media",
    "menciona_inicio_projeto", "menciona_valor", "menciona_aceitar", "menciona_java",
    "menciona_python", "menciona_sap", "menciona_cloud", "menciona_agile",
]

LEAKY_NAME_TERMS = [
    "situacao", "status", "resultado", "contratado", "aprovado", "sucesso", "target", "output",
    "outcome", "decision", "final",
]
FUTURE_DATE_TERMS = ["final", "contratacao", "resultado"]

INSIGHT_GROUPS = {
    "Engajamento": ["engajamento"],
    "Recrutador": ["recrutador"],
    "Comentários": ["menciona_", "sentimento"],
    "Temporais": ["data", "dia", "mes", "tempo"],
    "Vaga": ["vaga", "area", "senioridade", "contratacao"],
}
POWER_GROUPS = {
    "Engajamento": ["engajamento", "fit", "interesse"],
    "Recrutador": ["recrutador"],
    "Texto": ["menciona_", "sentimento", "comentario"],
}
ENGAGEMENT_NAME_TERMS = ["engajamento", "sentimento", "menciona_"]
ATTRITION_NAME_TERMS = ["desistencia", "proposta", "recusou"]
KEY_FLAGS = [
    "engajamento_positivo", "menciona_desistencia", "menciona_outra_proposta", "fit_cultural",
    "taxa_sucesso_recrutador", "recrutador_alto_desempenho",
]

ID_COLUMNS = ["nome", "codigo", "job_id", "titulo_vaga"]
TEXT_COLUMNS = ["comentario"]

RECOMMENDED = "Recomendado"
NOT_RECOMMENDED = "Não recomendado"
AREA_MATCH_BOOST = 1.2

JOB_INFO_DEFAULTS = {
    "id": "não especificado",
    "titulo": "não especificado",
    "area": "não especificada",
    "senioridade": "não especificada",
}

CHOSEN_THRESHOLDS = [0.1, 0.2, 0.25, 0.3, 0.4, 0.5]
GRID_THRESHOLDS = np.linspace(0.05, 0.95, 19).tolist()

ROLE_LIMITS = {"admin": 100, "read-only": 30}
ROLE_LIMIT_OTHER = 10
LIMIT_WINDOW_SECONDS = 60

DRIFT_STD_LIMIT = 2.0
DRIFT_JS_LIMIT = 0.05
DRIFT_REPORT_LIMIT = 0.2
DRIFT_ALERT_LIMIT = 0.3
DRIFT_WATCH_LIMIT = 0.1
ACCURACY_DROP_LIMIT = 0.05
ERROR_RATE_LIMIT = 1.0
LATENCY_LIMIT_MS = 200.0
JS_EPSILON = 1e-10
DEFAULT_BASE_METRIC = 1.0
