"""Types, status literals and message templates shared by every operator.

The status literals, message templates and report labels are part of the
log's contract (other jobs read them back), so they are kept verbatim.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: run-log status domain (7 values) -------------------------
SUCESSO = "SUCESSO"
PULADO_INATIVO = "PULADO_INATIVO"
PULADO_JA_CORRIGIDO = "PULADO_JA_CORRIGIDO"
ERRO_API = "ERRO_API"
ERRO_COLISAO_IRRESOLVIVEL = "ERRO_COLISAO_IRRESOLVIVEL"
ERRO_PUT = "ERRO_PUT"
ERRO_REDIRECT = "ERRO_REDIRECT"

ALL_STATUSES = (
    SUCESSO,
    PULADO_INATIVO,
    PULADO_JA_CORRIGIDO,
    ERRO_API,
    ERRO_COLISAO_IRRESOLVIVEL,
    ERRO_PUT,
    ERRO_REDIRECT,
)

# A SKU with one of these statuses in the log is never selected again.
FINAL_STATUSES = (SUCESSO, PULADO_JA_CORRIGIDO, PULADO_INATIVO)

# Production batch size of the correction job.
DEFAULT_BATCH_SIZE = 150

# Every planned redirect is permanent.
REDIRECT_HTTP_STATUS = 301

# --- fixed values: message templates written to mensagem_erro ---------------
MSG_LOOKUP_FAILED = "Falha ao buscar ProductId: {}"
MSG_DETAILS_FAILED = "Falha ao buscar detalhes do produto: {}"
MSG_PROBE_FAILED = "Não foi possível verificar redirect existente para a URL atual: {}"
MSG_REMOVAL_FAILED = (
    "Redirect errôneo detectado (produto ativo redirecionando para outro "
    "destino), mas falha ao remover: {}"
)
MSG_REMOVED = "Redirect errôneo removido: produto ativo estava sendo redirecionado para '{}'."
MSG_COLLISION_PROBE_FAILED = "Falha ao checar colisão: {}"
MSG_SUFFIX_PROBE_FAILED = "Falha ao checar colisão (variação com sufixo): {}"
MSG_IRRESOLVABLE = (
    "Slug normalizado e variação com sufixo de SKU colidiram. "
    "Conflito original: productId {}."
)
MSG_PUT_FAILED = "Falha no PUT: {}"
MSG_REDIRECT_FAILED = "PUT confirmado, mas redirect falhou para {}: {}"
MSG_REDIRECT_SKIPPED = (
    "Redirect ignorado: as URLs de origem e destino seriam as mesmas "
    "(apenas case diferente no slug original)."
)
MSG_UNHANDLED = "Exceção não tratada: {}: {}"
MSG_SEPARATOR = " | "

# Reads and probes that an outside system may fail at; kinds of the failure table
# (kind, key, msg). Keys: the SKU, the product id, the probed path, the probed slug.
READ_SKU = "sku"
READ_PRODUCT = "product"
PROBE_REDIRECT = "redirect"
PROBE_SLUG = "slug"

# Texts for outcomes that an outside system would have supplied; ours.
NOT_FOUND_SKU = "SKU não encontrado no catálogo"
NOT_FOUND_PRODUCT = "produto não encontrado no catálogo"
EMPTY_SLUG = "slug vazio após normalização"
BAD_SUFFIX = "SKU não numérico não forma um slug com sufixo"

# --- fixed values: report texts ----------------------------------------------
SEVERITY_CRITICAL = "CRITICO"
SEVERITY_RETRY = "RETENTATIVAS_PENDENTES"
SEVERITY_CLEAN = "SEM_ERROS"
BADGE_CRITICAL = "ATENÇÃO — POSSÍVEL 404 (redirect falhou)"
BADGE_RETRY = "CONCLUÍDO (RETENTATIVAS PENDENTES)"
BADGE_CLEAN = "EXECUÇÃO SEM ERROS"
SUBJECT_CRITICAL = "🚨 ATENÇÃO"
SUBJECT_OK = "✅ SUCESSO"

# (order, label, summary column, alert when > 0)
REPORT_METRICS = (
    (1, "Total de SKUs processados", "total", False),
    (2, "Corrigidos com sucesso", "sucesso", False),
    (3, "Pulados — já corretos", "pulado_ja_corrigido", False),
    (4, "Pulados — produto inativo", "pulado_inativo", False),
    (5, "Colisões de slug detectadas", "total_colisoes", False),
    (6, "Erros de colisão irresolúvel", "erro_colisao", True),
    (7, "Erros de atualização (PUT)", "erro_put", True),
    (8, "Erros de redirect (⚠️ crítico)", "erro_redirect", True),
    (9, "Erros de API (leitura)", "erro_api", True),
)

# --- fixed values: summary count columns and the status each one counts ---------
STATUS_COUNTS = (
    ("sucesso", SUCESSO),
    ("pulado_inativo", PULADO_INATIVO),
    ("pulado_ja_corrigido", PULADO_JA_CORRIGIDO),
    ("erro_colisao", ERRO_COLISAO_IRRESOLVIVEL),
    ("erro_put", ERRO_PUT),
    ("erro_redirect", ERRO_REDIRECT),
    ("erro_api", ERRO_API),
)

# Number of critical SKUs shown inline in an alert before the ellipsis.
ALERT_LIST_LIMIT = 10

# --- fixed values: run-log schema -------------------------------------------------------------
LOG_SCHEMA = T.StructType(
    [
        T.StructField("execution_id", T.StringType(), nullable=False),
        T.StructField("timestamp", T.TimestampType(), nullable=False),
        T.StructField("sku_vtex", T.StringType(), nullable=False),
        T.StructField("product_id", T.LongType(), nullable=True),
        T.StructField("slug_original", T.StringType(), nullable=True),
        T.StructField("slug_normalizado", T.StringType(), nullable=True),
        T.StructField("slug_final", T.StringType(), nullable=True),
        T.StructField("houve_colisao", T.BooleanType(), nullable=True),
        T.StructField("product_id_conflitante", T.LongType(), nullable=True),
        T.StructField("is_active", T.BooleanType(), nullable=True),
        T.StructField("status", T.StringType(), nullable=True),
        T.StructField("put_confirmado", T.BooleanType(), nullable=True),
        T.StructField("redirect_confirmado", T.BooleanType(), nullable=True),
        T.StructField("redirect_destino", T.StringType(), nullable=True),
        T.StructField("mensagem_erro", T.StringType(), nullable=True),
        T.StructField("tempo_processamento_ms", T.IntegerType(), nullable=True),
    ]
)

LOG_COLUMNS = tuple(f.name for f in LOG_SCHEMA.fields)
NON_NULL_LOG_COLUMNS = tuple(f.name for f in LOG_SCHEMA.fields if not f.nullable)

# Older logs carry their time in this column instead of ``timestamp``.
LEGACY_TIME_COLUMN = "data_execucao"
