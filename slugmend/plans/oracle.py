"""DuckDB SQL for every registered query, over the driver's base tables.

Each statement starts with the scenario CTEs (the same definitions as
``slugmend.sources.fixtures``) and then states the result independently of
the Spark code. Message texts and labels are spliced in from
``slugmend.schemas`` so both sides print the same words.
"""

from __future__ import annotations

from slugmend import schemas as S
from slugmend.plans.queries import HEAD_BATCH


def lit(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def norm(x: str) -> str:
    """Slug normalisation in DuckDB."""
    return f"trim(regexp_replace(lower(strip_accents({x})), '[^a-z0-9]+', '-', 'g'), '-')"


def tmpl(text: str, *args: str) -> str:
    """Fill a ``{}`` template; a null value prints ``None``."""
    parts = text.split("{}")
    assert len(parts) == len(args) + 1
    out = [lit(parts[0])]
    for a, tail in zip(args, parts[1:]):
        out.append(f"coalesce(CAST({a} AS VARCHAR), 'None')")
        out.append(lit(tail))
    return "(" + " || ".join(out) + ")"


FINAL_IN = "(" + ", ".join(lit(s) for s in S.FINAL_STATUSES) + ")"

# Groups of products with hard cases: place, SKU, link, flag (g: 'grupo-<part key>').
_HARD = """
hard_products AS (
  SELECT p, c.place, 3000000 + 10 * p + c.place AS product_id, c.sku_id, c.link_id, c.is_active
  FROM (SELECT p, unnest([
      {'place': 0, 'sku_id': CAST(3000000 + 10 * p AS VARCHAR), 'link_id': g, 'is_active': true},
      {'place': 1, 'sku_id': CAST(3000001 + 10 * p AS VARCHAR), 'link_id': 'Grupo ' || p, 'is_active': true},
      {'place': 2, 'sku_id': CAST(3000002 + 10 * p AS VARCHAR), 'link_id': g || '-' || (3000001 + 10 * p), 'is_active': true},
      {'place': 3, 'sku_id': CAST(3000003 + 10 * p AS VARCHAR), 'link_id': 'GRUPO ' || p, 'is_active': true},
      {'place': 3, 'sku_id': 'z' || p, 'link_id': 'GRUPO ' || p, 'is_active': true},
      {'place': 4, 'sku_id': CAST(3000004 + 10 * p AS VARCHAR), 'link_id': NULL, 'is_active': NULL},
      {'place': 5, 'sku_id': CAST(3000005 + 10 * p AS VARCHAR), 'link_id': NULL, 'is_active': true},
      {'place': 6, 'sku_id': CAST(3000006 + 10 * p AS VARCHAR), 'link_id': '***', 'is_active': true},
      {'place': 7, 'sku_id': CAST(3000007 + 10 * p AS VARCHAR), 'link_id': 'Outro ' || p, 'is_active': NULL},
      {'place': 8, 'sku_id': CAST(3000008 + 10 * p AS VARCHAR), 'link_id': 'Grupo ' || p || ' 8 1 1', 'is_active': true},
      {'place': 9, 'sku_id': 'y' || p, 'link_id': 'gruPo ' || p, 'is_active': true}]) AS c
    FROM (SELECT p_partkey AS p, 'grupo-' || p_partkey AS g FROM part WHERE p_partkey % 20 = 4))
  UNION ALL
  SELECT p_partkey, 10, 8000000 + p_partkey, 'w' || p_partkey, 'Muito Pedido', true FROM part WHERE p_partkey % 20 = 7
),"""

FIXTURES = f"""{_HARD}
queue_src AS (
  SELECT CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS sku_id FROM part
  UNION ALL SELECT CAST(p_partkey AS VARCHAR) AS sku_id FROM part WHERE p_partkey % 50 = 0
  UNION ALL SELECT CAST(1000000 + s_suppkey AS VARCHAR) AS sku_id FROM supplier
  UNION ALL SELECT sku_id FROM hard_products
  UNION ALL SELECT 'x7' AS sku_id
),
catalog AS (
  SELECT CAST(p.p_partkey AS VARCHAR) AS sku_id, q.p_partkey AS product_id, q.p_size > 5 AS is_active,
    CASE q.p_partkey % 3
      WHEN 0 THEN concat(upper(q.p_name), ' ', q.p_brand)
      WHEN 1 THEN concat(replace(q.p_name, ' ', '-'), '-', replace(lower(q.p_brand), '#', '-'))
      ELSE concat('  ', q.p_name, '__', q.p_brand, '!') END AS link_id
  FROM part p JOIN part q
    ON q.p_partkey = p.p_partkey - (CASE WHEN p.p_partkey % 10 = 1 THEN 1 ELSE 0 END)
  UNION ALL SELECT sku_id, product_id, is_active, link_id FROM hard_products
),
latency AS (
  SELECT CAST(p_partkey AS VARCHAR) AS sku_id, CAST(p_partkey % 1000 AS INTEGER) AS ms FROM part WHERE p_partkey % 3 > 0
),
run_log AS (
  SELECT concat('exec-', CAST(CAST(ts AS DATE) AS VARCHAR)) AS execution_id,
    CASE WHEN CAST(ts AS DATE) > DATE '2024-01-10' THEN ts END AS "timestamp",
    CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-10' THEN ts END AS data_execucao,
    CAST(user_id AS VARCHAR) AS sku_vtex,
    CASE WHEN user_id % 3 = 0 OR event_type = 'error' THEN
           CASE event_id % 4 WHEN 0 THEN 'ERRO_API' WHEN 1 THEN 'ERRO_PUT'
                             WHEN 2 THEN 'ERRO_REDIRECT' ELSE 'ERRO_COLISAO_IRRESOLVIVEL' END
         WHEN event_type = 'signup' THEN 'PULADO_INATIVO'
         WHEN event_type = 'view' THEN 'PULADO_JA_CORRIGIDO'
         ELSE 'SUCESSO' END AS status,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 5 = 0 END AS houve_colisao,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(floor(value * 10) AS INTEGER) END AS tempo_processamento_ms,
    user_id * 10 AS product_id, event_id
  FROM events
),
products AS (
  SELECT product_id, min(link_id) AS link_id, bool_and(is_active) AS is_active FROM catalog GROUP BY product_id
),
sku_products AS (
  SELECT sku_id, min(product_id) AS product_id FROM catalog GROUP BY sku_id
),
redirects AS (
  SELECT '/' || lower(link_id) || '/p' AS from_path,
         min('/produto-antigo-' || CAST(product_id AS VARCHAR) || '/p') AS to_path
  FROM products WHERE product_id % 7 = 0 AND link_id IS NOT NULL GROUP BY 1
),
put_outcome AS (
  SELECT product_id, product_id % 29 = 0 AS erro,
         CASE WHEN product_id % 29 = 0 THEN 'HTTP 500 ao gravar LinkId' END AS msg
  FROM (SELECT DISTINCT product_id FROM catalog)
),
redirect_outcome AS (
  SELECT from_path, erro, CASE WHEN erro THEN 'HTTP 429 limite de redirects' END AS msg
  FROM (SELECT '/' || lower(link_id) || '/p' AS from_path, bool_or(product_id % 31 = 0) AS erro
        FROM products WHERE link_id IS NOT NULL GROUP BY 1)
),
removal_outcome AS (
  SELECT from_path, erro, CASE WHEN erro THEN 'HTTP 403 remoção negada' END AS msg
  FROM (SELECT '/' || lower(link_id) || '/p' AS from_path, bool_or(product_id % 35 = 0) AS erro
        FROM products WHERE link_id IS NOT NULL GROUP BY 1)
),
slug_texts AS (
  SELECT 'pages' AS src, page_id AS src_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS text FROM pages
  UNION ALL SELECT 'documents' AS src, doc_id AS src_id, text FROM documents
  UNION ALL SELECT 'part' AS src, p_partkey AS src_id, concat_ws(' ', p_name, p_brand, p_type) AS text FROM part
),
gate AS (
  SELECT sku_id, product_id, is_active, link_id AS slug_original, {norm('link_id')} AS slug_normalizado,
    CASE WHEN NOT coalesce(is_active, false) THEN {lit(S.PULADO_INATIVO)}
         WHEN {norm('link_id')} IS NULL OR {norm('link_id')} = '' THEN {lit(S.ERRO_API)}
         WHEN link_id = {norm('link_id')} THEN {lit(S.PULADO_JA_CORRIGIDO)}
         ELSE 'TRATAR' END AS gate
  FROM catalog
),
treated AS (SELECT * FROM gate WHERE gate = 'TRATAR'),
treated_products AS (
  SELECT DISTINCT product_id, slug_original AS link_id, slug_normalizado AS slug_final FROM treated
),
holders AS (
  SELECT link_id AS slug, min(product_id) AS h_min, max(product_id) AS h_max
  FROM products WHERE link_id IS NOT NULL GROUP BY link_id
),
queue_cand AS (
  SELECT s.sku_id FROM queue_src s
  WHERE s.sku_id IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM run_log l WHERE l.sku_vtex = s.sku_id AND l.status IN {FINAL_IN})
),
queue_batch AS (
  SELECT sku_id FROM queue_cand
  ORDER BY try_cast(sku_id AS BIGINT) NULLS LAST, sku_id LIMIT {S.DEFAULT_BATCH_SIZE}
),
summaries AS (
  SELECT execution_id, total, {", ".join(n for n, _ in S.STATUS_COUNTS)}, total_colisoes,
    CASE WHEN lat_n > 0 THEN CAST(lat_sum AS DOUBLE) / lat_n ELSE 0.0 END AS tempo_medio_ms,
    coalesce((epoch_us(ultimo_ts) - epoch_us(primeiro_ts)) // 1000000, 0) AS elapsed_sec,
    coalesce(strftime(ultimo_ts, '%d/%m/%Y %H:%M'), '—') AS run_ts
  FROM (
    SELECT execution_id, count(*) AS total,
      {", ".join(f"count(CASE WHEN status = {lit(s)} THEN 1 END) AS {n}" for n, s in S.STATUS_COUNTS)},
      count(CASE WHEN houve_colisao THEN 1 END) AS total_colisoes,
      sum(CAST(tempo_processamento_ms AS BIGINT)) AS lat_sum, count(tempo_processamento_ms) AS lat_n,
      min(coalesce(data_execucao, "timestamp")) AS primeiro_ts,
      max(coalesce(data_execucao, "timestamp")) AS ultimo_ts
    FROM run_log GROUP BY execution_id)
),
redirect_plan AS (
  SELECT product_id, 1 AS seq, '/' || link_id || '/p' AS from_path, '/' || slug_final || '/p' AS to_path
  FROM treated_products WHERE '/' || link_id || '/p' <> '/' || slug_final || '/p'
  UNION ALL
  SELECT product_id,
    CASE WHEN '/' || link_id || '/p' <> '/' || slug_final || '/p' THEN 2 ELSE 1 END AS seq,
    '/' || lower(link_id) || '/p' AS from_path, '/' || slug_final || '/p' AS to_path
  FROM treated_products
  WHERE '/' || lower(link_id) || '/p' <> '/' || slug_final || '/p'
    AND '/' || lower(link_id) || '/p' <> '/' || link_id || '/p'
)"""


def with_fixtures(body: str) -> str:
    return "WITH " + FIXTURES.strip() + "\n" + body.strip()


_SEVERITY = f"""
CASE WHEN erro_redirect > 0 THEN {{crit}}
     WHEN erro_put > 0 OR erro_api > 0 OR erro_colisao > 0 THEN {{retry}}
     ELSE {{clean}} END"""


def _severity(crit: str, retry: str, clean: str) -> str:
    return _SEVERITY.format(crit=lit(crit), retry=lit(retry), clean=lit(clean))


_METRICS = "\nUNION ALL\n".join(
    f"SELECT execution_id, {order} AS ordem, {lit(label)} AS metrica, CAST({col} AS BIGINT) AS valor, "
    f"{f'{col} > 0' if alert else 'false'} AS alerta FROM summaries"
    for order, label, col, alert in S.REPORT_METRICS
)

SQL: dict[str, str] = {
    "queue_next": "SELECT sku_id FROM queue_batch",
    "queue_head": f"""
        SELECT sku_id, count(*) AS n_copies
        FROM (SELECT sku_id,
                     row_number() OVER (ORDER BY try_cast(sku_id AS BIGINT) NULLS LAST, sku_id) AS rn
              FROM queue_cand)
        WHERE rn <= {HEAD_BATCH}
        GROUP BY sku_id""",
    "finalized_skus": f"SELECT sku_vtex, status FROM run_log WHERE status IN {FINAL_IN}",
    "queue_shortfall": f"""
        SELECT count(*) AS n_selected, CAST({S.DEFAULT_BATCH_SIZE} AS BIGINT) AS batch_size,
               count(*) < {S.DEFAULT_BATCH_SIZE} AS shortfall
        FROM queue_batch""",
    "queue_shortfall_whole": """
        SELECT count(*) AS n_selected, CAST(1000000000 AS BIGINT) AS batch_size, count(*) < 1000000000 AS shortfall
        FROM queue_cand""",
    "final_key_index": f"SELECT DISTINCT sku_vtex FROM run_log WHERE status IN {FINAL_IN} AND sku_vtex IS NOT NULL",
    "queue_next_indexed": "SELECT sku_id FROM queue_batch",
    "retryable_skus": f"""
        SELECT sku_vtex, count(*) AS attempts,
               coalesce(bool_or(status IN {FINAL_IN}), false) AS is_final,
               NOT coalesce(bool_or(status IN {FINAL_IN}), false) AS retry_pending,
               count(CASE WHEN status = 'ERRO_REDIRECT' THEN 1 END) > 0 AS manual_action
        FROM run_log WHERE sku_vtex IS NOT NULL GROUP BY sku_vtex""",
    "effective_time": """
        SELECT execution_id, sku_vtex, status, coalesce(data_execucao, "timestamp") AS effective_ts
        FROM run_log""",
    "run_last_seen": """
        SELECT execution_id, max(coalesce(data_execucao, "timestamp")) AS max_t
        FROM run_log GROUP BY execution_id""",
    "latest_run": """
        SELECT execution_id, max(coalesce(data_execucao, "timestamp")) AS max_t
        FROM run_log GROUP BY execution_id
        ORDER BY max_t DESC NULLS LAST, execution_id LIMIT 1""",
    "run_facts": """
        SELECT execution_id, status, count(*) AS n,
               min(coalesce(data_execucao, "timestamp")) AS min_t, max(coalesce(data_execucao, "timestamp")) AS max_t
        FROM run_log GROUP BY execution_id, status""",
    "latest_run_recorded": """
        SELECT execution_id, max(coalesce(data_execucao, "timestamp")) AS max_t
        FROM run_log GROUP BY execution_id
        ORDER BY max_t DESC NULLS LAST, execution_id LIMIT 1""",
    "status_frequency_recorded": """
        SELECT execution_id, status, n,
               row_number() OVER (PARTITION BY execution_id ORDER BY n DESC, status NULLS LAST) AS ordem
        FROM (SELECT execution_id, status, count(*) AS n FROM run_log GROUP BY execution_id, status)""",
    "run_summary": "SELECT * FROM summaries",
    "latest_run_summary": """
        SELECT * FROM summaries
        WHERE execution_id = (
          SELECT execution_id FROM run_log GROUP BY execution_id
          ORDER BY max(coalesce(data_execucao, "timestamp")) DESC NULLS LAST, execution_id LIMIT 1)""",
    "run_severity": f"""
        SELECT execution_id,
          {_severity(S.SEVERITY_CRITICAL, S.SEVERITY_RETRY, S.SEVERITY_CLEAN)} AS severity,
          {_severity(S.BADGE_CRITICAL, S.BADGE_RETRY, S.BADGE_CLEAN)} AS badge,
          CASE WHEN erro_redirect > 0 THEN {lit(S.SUBJECT_CRITICAL)} ELSE {lit(S.SUBJECT_OK)} END AS subject_prefix
        FROM summaries""",
    "report_metrics": _METRICS,
    "run_header": """
        SELECT execution_id,
          printf('%02dh %02dm %02ds', elapsed_sec // 3600, (elapsed_sec % 3600) // 60, elapsed_sec % 60) AS duracao,
          run_ts,
          concat_ws('/', CAST(sucesso AS VARCHAR), CAST(total AS VARCHAR)) AS placar
        FROM summaries""",
    "status_frequency": """
        SELECT execution_id, status, n,
               row_number() OVER (PARTITION BY execution_id ORDER BY n DESC, status NULLS LAST) AS ordem
        FROM (SELECT execution_id, status, count(*) AS n FROM run_log GROUP BY execution_id, status)""",
    "critical_skus": """
        SELECT execution_id, sku_vtex, product_id, 'redirect falhou no evento ' || event_id AS mensagem_erro
        FROM run_log WHERE status = 'ERRO_REDIRECT'""",
    "critical_alert": f"""
        , crit AS (SELECT execution_id, sku_vtex FROM run_log WHERE status = 'ERRO_REDIRECT'),
        counts AS (SELECT execution_id, count(*) AS n_criticos FROM crit GROUP BY execution_id),
        head AS (
          SELECT execution_id, string_agg(sku_vtex, ', ' ORDER BY sku_vtex) AS skus_lista
          FROM (SELECT execution_id, sku_vtex,
                       row_number() OVER (PARTITION BY execution_id ORDER BY sku_vtex NULLS LAST) AS rn
                FROM crit)
          WHERE rn <= {S.ALERT_LIST_LIMIT} GROUP BY execution_id)
        SELECT c.execution_id, c.n_criticos, h.skus_lista,
               CASE WHEN c.n_criticos > {S.ALERT_LIST_LIMIT} THEN '...' ELSE '' END AS sufixo
        FROM counts c JOIN head h ON h.execution_id = c.execution_id""",
    "slug_normalize": f"SELECT src, src_id, {norm('text')} AS slug FROM slug_texts",
    "slug_gate": "SELECT * FROM gate",
    "catalog_lookup": f"""
        SELECT q.sku_id, sp.product_id, p.link_id, p.is_active,
          sp.product_id IS NULL AS erro,
          CASE WHEN sp.product_id IS NULL THEN {tmpl(S.MSG_LOOKUP_FAILED, lit(S.NOT_FOUND_SKU))} END AS mensagem
        FROM queue_src q
        LEFT JOIN sku_products sp ON sp.sku_id = q.sku_id
        LEFT JOIN products p ON p.product_id = sp.product_id
        WHERE q.sku_id IS NOT NULL""",
    "catalog_lookup_pruned": f"""
        SELECT q.sku_id, sp.product_id, p.link_id, p.is_active, sp.product_id IS NULL AS erro,
          CASE WHEN sp.product_id IS NULL THEN {tmpl(S.MSG_LOOKUP_FAILED, lit(S.NOT_FOUND_SKU))} END AS mensagem
        FROM (SELECT DISTINCT sku_id FROM queue_src WHERE sku_id IS NOT NULL) q
        LEFT JOIN (SELECT sku_id, min(product_id) AS product_id FROM catalog
                   WHERE regexp_full_match(sku_id, '[0-9]+') GROUP BY sku_id) sp ON sp.sku_id = q.sku_id
        LEFT JOIN products p ON p.product_id = sp.product_id""",
    "slug_collisions": """
        SELECT sku_id, product_id, slug_normalizado, conflict IS NOT NULL AS colisao,
               conflict AS product_id_conflitante
        FROM (SELECT t.sku_id, t.product_id, t.slug_normalizado,
                CASE WHEN h.h_min <> t.product_id THEN h.h_min
                     WHEN h.h_max <> t.product_id THEN h.h_max END AS conflict
              FROM treated t LEFT JOIN holders h ON h.slug = t.slug_normalizado)""",
    "update_outcome": f"""
        SELECT t.sku_id, t.product_id, NOT coalesce(o.erro, false) AS put_confirmado,
          CASE WHEN coalesce(o.erro, false) THEN {tmpl(S.MSG_PUT_FAILED, 'o.msg')} END AS mensagem
        FROM treated t LEFT JOIN put_outcome o ON o.product_id = t.product_id""",
    "redirect_plan": f"SELECT product_id, seq, from_path, to_path, {S.REDIRECT_HTTP_STATUS} AS http_status FROM redirect_plan",
    "redirect_outcome": f"""
        , tried AS (
          SELECT p.product_id, p.seq, p.from_path, o.erro, o.msg
          FROM redirect_plan p LEFT JOIN redirect_outcome o ON o.from_path = p.from_path),
        ff AS (
          SELECT product_id, count(*) AS n_planned,
                 min(CASE WHEN coalesce(erro, false) THEN seq END) AS fail_seq
          FROM tried GROUP BY product_id),
        fail AS (
          SELECT t.product_id, t.seq, t.from_path, t.msg
          FROM tried t JOIN ff ON ff.product_id = t.product_id AND t.seq = ff.fail_seq)
        SELECT tp.product_id, '/' || tp.slug_final || '/p' AS redirect_destino,
          coalesce(ff.n_planned, 0) AS n_planejados,
          CASE WHEN f.seq IS NOT NULL THEN f.seq - 1 ELSE coalesce(ff.n_planned, 0) END AS n_criados,
          f.seq IS NULL AS redirect_confirmado,
          f.from_path AS path_falha,
          CASE WHEN f.seq IS NOT NULL THEN {tmpl(S.MSG_REDIRECT_FAILED, 'f.from_path', 'f.msg')}
               WHEN coalesce(ff.n_planned, 0) = 0 THEN {lit(S.MSG_REDIRECT_SKIPPED)} END AS mensagem
        FROM treated_products tp
        LEFT JOIN ff ON ff.product_id = tp.product_id
        LEFT JOIN fail f ON f.product_id = tp.product_id""",
    "wrongful_redirects": f"""
        SELECT t.sku_id, t.product_id, t.link_id, t.path_atual,
          r.to_path IS NOT NULL AS existe,
          r.to_path AS destino_antigo,
          r.to_path IS NOT NULL AND NOT coalesce(m.erro, false) AS removido,
          CASE WHEN r.to_path IS NOT NULL THEN
            CASE WHEN coalesce(m.erro, false) THEN {tmpl(S.MSG_REMOVAL_FAILED, 'm.msg')}
                 ELSE {tmpl(S.MSG_REMOVED, 'r.to_path')} END END AS observacao
        FROM (SELECT sku_id, product_id, slug_original AS link_id,
                     '/' || lower(slug_original) || '/p' AS path_atual FROM treated) t
        LEFT JOIN redirects r ON r.from_path = t.path_atual
        LEFT JOIN removal_outcome m ON m.from_path = t.path_atual""",
}


# --- sequential replay of the correction run (recursive CTE) ------------------------
#
# The batch is processed one row at a time, in queue order, exactly like
# the original loop: the state carried from row to row is the list of slugs
# claimed in the batch, the products already fixed and the changes made to
# the redirect registry. Everything that does not depend on that state is
# looked up per row beforehand (``rs``).

# Failed reads and probes, one row per key; the plain runs have none.
_FAILURES = """
, failed AS MATERIALIZED (
  SELECT kind, key, min(msg) AS msg FROM (
    SELECT 'sku' AS kind, CAST(p_partkey AS VARCHAR) AS key, 'HTTP 503 no SKU' AS msg FROM part WHERE p_partkey % 17 = 3
    UNION ALL SELECT 'product', CAST(p_partkey AS VARCHAR), 'HTTP 500 no produto' FROM part WHERE p_partkey % 19 = 5
    UNION ALL SELECT 'redirect', '/' || lower(link_id) || '/p', 'HTTP 429 na verificação'
      FROM catalog WHERE product_id % 21 = 0 AND link_id IS NOT NULL
    UNION ALL SELECT 'slug', 'grupo-' || p, 'HTTP 502 no slug' FROM hard_products WHERE place = 0 AND p % 80 = 4
    UNION ALL SELECT 'slug', 'grupo-' || p || '-' || sku_id, 'HTTP 502 no sufixo'
      FROM hard_products WHERE place = 3 AND p % 80 = 44)
  WHERE {failures} GROUP BY kind, key
)"""

_BATCH_STATE = f"""
, batch_rows AS MATERIALIZED (
  SELECT sku_id, row_number() OVER (ORDER BY try_cast(sku_id AS BIGINT) NULLS LAST, sku_id) AS rn
  FROM {{batch_source}}
),
rs AS MATERIALIZED (
  SELECT b.rn, b.sku_id, CASE WHEN fs.key IS NULL THEN sp.product_id END AS pid, p.link_id AS link0, p.is_active AS act,
    fs.msg AS sku_msg, fp.msg AS product_msg, fr.msg AS probe_msg, f1.msg AS slug_msg, f2.msg AS suffix_msg,
    {norm('p.link_id')} AS norm0,
    '/' || lower(p.link_id) || '/p' AS path0,
    '/' || p.link_id || '/p' AS exact0,
    {norm('p.link_id')} || '-' || b.sku_id AS s2,
    regexp_full_match(b.sku_id, '[0-9]+') AS sku_num,
    reg.to_path AS snap_to,
    coalesce(rm.erro, false) AS rem_fail, rm.msg AS rem_msg,
    CASE WHEN h1.h_min <> sp.product_id THEN h1.h_min WHEN h1.h_max <> sp.product_id THEN h1.h_max END AS snap1,
    CASE WHEN h2.h_min <> sp.product_id THEN h2.h_min WHEN h2.h_max <> sp.product_id THEN h2.h_max END AS snap2,
    coalesce(po.erro, false) AS put_fail, po.msg AS put_msg,
    coalesce(re.erro, false) AS ro_exact_fail, re.msg AS ro_exact_msg,
    coalesce(rl.erro, false) AS ro_lower_fail, rl.msg AS ro_lower_msg
  FROM batch_rows b
  LEFT JOIN sku_products sp ON sp.sku_id = b.sku_id
  LEFT JOIN products p ON p.product_id = sp.product_id
  LEFT JOIN failed fs ON fs.kind = 'sku' AND fs.key = b.sku_id
  LEFT JOIN failed fp ON fp.kind = 'product' AND fp.key = CAST(sp.product_id AS VARCHAR)
  LEFT JOIN failed fr ON fr.kind = 'redirect' AND fr.key = '/' || lower(p.link_id) || '/p'
  LEFT JOIN failed f1 ON f1.kind = 'slug' AND f1.key = {norm('p.link_id')}
  LEFT JOIN failed f2 ON f2.kind = 'slug' AND f2.key = {norm('p.link_id')} || '-' || b.sku_id
  LEFT JOIN redirects reg ON reg.from_path = '/' || lower(p.link_id) || '/p'
  LEFT JOIN removal_outcome rm ON rm.from_path = '/' || lower(p.link_id) || '/p'
  LEFT JOIN holders h1 ON h1.slug = {norm('p.link_id')}
  LEFT JOIN holders h2 ON h2.slug = {norm('p.link_id')} || '-' || b.sku_id
  LEFT JOIN put_outcome po ON po.product_id = sp.product_id
  LEFT JOIN redirect_outcome re ON re.from_path = '/' || p.link_id || '/p'
  LEFT JOIN redirect_outcome rl ON rl.from_path = '/' || lower(p.link_id) || '/p'
),
sim(i, claims, fixed, regc, r) AS (
  SELECT 0,
    []::STRUCT(slug VARCHAR, pid BIGINT)[],
    []::STRUCT(pid BIGINT, slug VARCHAR)[],
    []::STRUCT(path VARCHAR, to_path VARCHAR)[],
    NULL::STRUCT(rn BIGINT, sku_vtex VARCHAR, product_id BIGINT, slug_original VARCHAR,
                 slug_normalizado VARCHAR, slug_final VARCHAR, houve_colisao BOOLEAN,
                 product_id_conflitante BIGINT, is_active BOOLEAN, status VARCHAR,
                 put_confirmado BOOLEAN, redirect_confirmado BOOLEAN, redirect_destino VARCHAR,
                 mensagem_erro VARCHAR, treat0 BOOLEAN, probes BOOLEAN, found BOOLEAN, old_to VARCHAR,
                 rem_failed BOOLEAN, obs VARCHAR)
  UNION ALL
  SELECT i, claims, fixed, regc, r FROM (
    SELECT s.i + 1 AS i, st.*,
      list_filter(s.fixed, lambda x: x.pid = st.pid) AS fx,
      CASE WHEN len(fx) > 0 THEN fx[-1].slug END AS fixed_slug,
      coalesce(fixed_slug, st.link0) AS cur,
      CASE WHEN st.pid IS NULL THEN 'LOOKUP'
           WHEN st.product_msg IS NOT NULL THEN 'DETAILS'
           WHEN NOT coalesce(st.act, false) THEN 'INATIVO'
           WHEN fixed_slug IS NOT NULL THEN 'JA'
           WHEN st.norm0 IS NULL OR st.norm0 = '' THEN 'EMPTY'
           WHEN st.link0 = st.norm0 THEN 'JA'
           ELSE 'TREAT' END AS g,
      st.pid IS NOT NULL AND st.product_msg IS NULL AND coalesce(st.act, false) AND coalesce(st.norm0, '') <> ''
        AND st.link0 <> st.norm0 AS treat0,
      list_filter(s.regc, lambda x: x.path = st.path0) AS rc,
      CASE WHEN len(rc) > 0 THEN rc[-1].to_path ELSE st.snap_to END AS cur_to,
      g = 'TREAT' AND st.probe_msg IS NULL AND cur_to IS NOT NULL AS found,
      found AND NOT st.rem_fail AS removed,
      CASE WHEN g = 'TREAT' AND st.probe_msg IS NOT NULL THEN {tmpl(S.MSG_PROBE_FAILED, 'st.probe_msg')}
           WHEN found THEN CASE WHEN st.rem_fail THEN {tmpl(S.MSG_REMOVAL_FAILED, 'st.rem_msg')}
                                ELSE {tmpl(S.MSG_REMOVED, 'cur_to')} END END AS obs,
      list_filter(s.claims, lambda x: x.slug = st.norm0 AND x.pid <> st.pid) AS c1,
      coalesce(st.snap1, CASE WHEN len(c1) > 0 THEN c1[-1].pid END) AS h1,
      g = 'TREAT' AND st.slug_msg IS NOT NULL AS unprobed,
      g = 'TREAT' AND NOT unprobed AND h1 IS NOT NULL AS collided,
      collided AND NOT st.sku_num AS bad_suffix,
      collided AND st.sku_num AND st.suffix_msg IS NOT NULL AS unprobed2,
      list_filter(s.claims, lambda x: x.slug = st.s2 AND x.pid <> st.pid) AS c2,
      coalesce(st.snap2, CASE WHEN len(c2) > 0 THEN c2[-1].pid END) AS h2,
      collided AND NOT bad_suffix AND NOT unprobed2 AND h2 IS NOT NULL AS irres,
      CASE WHEN g = 'TREAT' AND NOT unprobed AND NOT bad_suffix AND NOT unprobed2 AND NOT irres
           THEN CASE WHEN collided THEN st.s2 ELSE st.norm0 END END AS final,
      final IS NOT NULL AND st.put_fail AS putfail,
      final IS NOT NULL AND NOT st.put_fail AS won,
      '/' || final || '/p' AS dest,
      won AND st.exact0 <> dest AS try1,
      won AND st.path0 <> dest AND st.path0 <> st.exact0 AS try2,
      try1 AND st.ro_exact_fail AS fail1,
      try2 AND NOT fail1 AND st.ro_lower_fail AS fail2,
      CASE g WHEN 'LOOKUP' THEN {lit(S.ERRO_API)} WHEN 'DETAILS' THEN {lit(S.ERRO_API)} WHEN 'INATIVO' THEN {lit(S.PULADO_INATIVO)}
             WHEN 'JA' THEN {lit(S.PULADO_JA_CORRIGIDO)} WHEN 'EMPTY' THEN {lit(S.ERRO_API)}
             ELSE CASE WHEN unprobed OR bad_suffix OR unprobed2 THEN {lit(S.ERRO_API)}
                       WHEN irres THEN {lit(S.ERRO_COLISAO_IRRESOLVIVEL)}
                       WHEN putfail THEN {lit(S.ERRO_PUT)}
                       WHEN fail1 OR fail2 THEN {lit(S.ERRO_REDIRECT)}
                       ELSE {lit(S.SUCESSO)} END END AS status,
      CASE WHEN g = 'LOOKUP' THEN {tmpl(S.MSG_LOOKUP_FAILED, f"coalesce(st.sku_msg, {lit(S.NOT_FOUND_SKU)})")}
           WHEN g = 'DETAILS' THEN {tmpl(S.MSG_DETAILS_FAILED, 'st.product_msg')}
           WHEN unprobed THEN {tmpl(S.MSG_COLLISION_PROBE_FAILED, 'st.slug_msg')}
           WHEN unprobed2 THEN {tmpl(S.MSG_SUFFIX_PROBE_FAILED, 'st.suffix_msg')}
           WHEN g = 'EMPTY' THEN {tmpl(S.MSG_UNHANDLED, "'ValueError'", lit(S.EMPTY_SLUG))}
           WHEN bad_suffix THEN {tmpl(S.MSG_UNHANDLED, "'ValueError'", lit(S.BAD_SUFFIX))}
           WHEN irres THEN {tmpl(S.MSG_IRRESOLVABLE, 'h1')}
           WHEN putfail THEN {tmpl(S.MSG_PUT_FAILED, 'st.put_msg')}
           WHEN fail1 THEN {tmpl(S.MSG_REDIRECT_FAILED, 'st.exact0', 'st.ro_exact_msg')}
           WHEN fail2 THEN {tmpl(S.MSG_REDIRECT_FAILED, 'st.path0', 'st.ro_lower_msg')} END AS err,
      nullif(concat_ws({lit(S.MSG_SEPARATOR)}, err, obs,
             CASE WHEN won AND NOT try1 AND NOT try2 THEN {lit(S.MSG_REDIRECT_SKIPPED)} END), '') AS msg,
      list_concat(s.regc,
        CASE WHEN removed THEN [{{'path': st.path0, 'to_path': NULL::VARCHAR}}] ELSE [] END,
        CASE WHEN try1 AND NOT fail1 THEN [{{'path': st.exact0, 'to_path': dest}}] ELSE [] END,
        CASE WHEN try2 AND NOT fail1 AND NOT fail2 THEN [{{'path': st.path0, 'to_path': dest}}] ELSE [] END
      ) AS regc,
      CASE WHEN won THEN list_append(s.claims, {{'slug': final, 'pid': st.pid}}) ELSE s.claims END AS claims,
      CASE WHEN won THEN list_append(s.fixed, {{'pid': st.pid, 'slug': final}}) ELSE s.fixed END AS fixed,
      {{'rn': st.rn, 'sku_vtex': st.sku_id, 'product_id': st.pid,
        'slug_original': CASE WHEN g NOT IN ('LOOKUP', 'DETAILS') THEN cur END,
        'slug_normalizado': CASE WHEN g IN ('JA', 'EMPTY', 'TREAT') THEN coalesce(fixed_slug, st.norm0) END,
        'slug_final': final,
        'houve_colisao': coalesce(collided, false),
        'product_id_conflitante': CASE WHEN collided THEN h1 END,
        'is_active': CASE WHEN g NOT IN ('LOOKUP', 'DETAILS') THEN st.act END,
        'status': status,
        'put_confirmado': coalesce(won, false),
        'redirect_confirmado': coalesce(won AND NOT (fail1 OR fail2), false),
        'redirect_destino': CASE WHEN won THEN dest END,
        'mensagem_erro': msg,
        'treat0': treat0, 'probes': g = 'TREAT', 'found': found, 'old_to': CASE WHEN found THEN cur_to END,
        'rem_failed': found AND st.rem_fail, 'obs': obs}} AS r
    FROM sim s JOIN rs st ON st.rn = s.i + 1
  )
),
replay AS (SELECT unnest(r) FROM sim WHERE i > 0)"""


def _replay(body: str, batch_source: str = "queue_cand", failures: str = "false") -> str:
    state = _FAILURES.replace("{failures}", failures) + _BATCH_STATE.replace("{batch_source}", batch_source)
    return "WITH RECURSIVE " + FIXTURES.strip() + state + "\n" + body.strip()


REPLAY_SQL: dict[str, str] = {
    "status_cascade": """
        SELECT sku_vtex, product_id, status, houve_colisao, product_id_conflitante, slug_final,
               put_confirmado, redirect_confirmado, redirect_destino
        FROM replay""",
    "run_log_rows": f"""
        SELECT 'exec-2024-02-01' AS execution_id, TIMESTAMP '2024-02-01 03:00:00' AS "timestamp",
          sku_vtex, product_id, slug_original, slug_normalizado, slug_final, houve_colisao,
          product_id_conflitante, is_active, status, put_confirmado, redirect_confirmado,
          redirect_destino, mensagem_erro, l.ms AS tempo_processamento_ms
        FROM replay LEFT JOIN latency l ON l.sku_id = sku_vtex""",
    "redirect_timeline": """
        SELECT sku_vtex AS sku_id, found AS existe, old_to AS destino_antigo, rem_failed AS removal_failed, obs AS observacao
        FROM (SELECT *, row_number() OVER (PARTITION BY sku_vtex ORDER BY rn) AS copy FROM replay)
        WHERE copy = 1 AND probes""",
    "slug_resolution": f"""
        SELECT sku_vtex AS sku_id,
          CASE WHEN status = {lit(S.PULADO_JA_CORRIGIDO)} THEN 'FIXED_BEFORE'
               WHEN status = {lit(S.ERRO_API)} THEN 'BAD_SUFFIX'
               WHEN status = {lit(S.ERRO_COLISAO_IRRESOLVIVEL)} THEN 'IRRESOLVABLE'
               WHEN status = {lit(S.ERRO_PUT)} THEN 'PUT_FAIL'
               ELSE 'WIN' END AS outcome,
          houve_colisao, product_id_conflitante, slug_final
        FROM (SELECT *, row_number() OVER (PARTITION BY sku_vtex ORDER BY rn) AS copy FROM replay)
        WHERE copy = 1 AND treat0""",
}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in SQL.items():
        body = body.strip()
        if body.startswith(","):
            # body adds its own CTEs after the shared ones
            out[name] = "WITH " + FIXTURES.strip() + body
        else:
            out[name] = with_fixtures(body)
    for name, body in REPLAY_SQL.items():
        out[name] = _replay(body)
    # the nightly batch: the next DEFAULT_BATCH_SIZE SKUs only
    out["correction_batch"] = _replay(REPLAY_SQL["run_log_rows"], "queue_batch")
    # the whole queue, with reads and probes that fail
    out["probe_failures"] = _replay(REPLAY_SQL["run_log_rows"], failures="true")
    return out
