"""The same results in DuckDB SQL, written apart from the library's expressions."""

from __future__ import annotations

ROOT = "/out/proj"
SCOPE = ("ds2", "ds0", "economy", "promo")

# --- scalar expressions ----------------------------------------------------------------


def json_quote(s: str) -> str:
    return f"""(CASE WHEN {s} = '' THEN '""' ELSE '"' || array_to_string(list_transform(
      string_split({s}, ''), lambda ch: CASE
        WHEN ch = '"' THEN '\\"' WHEN ch = '\\' THEN '\\\\'
        WHEN ch = chr(8) THEN '\\b' WHEN ch = chr(9) THEN '\\t' WHEN ch = chr(10) THEN '\\n'
        WHEN ch = chr(12) THEN '\\f' WHEN ch = chr(13) THEN '\\r'
        WHEN unicode(ch) BETWEEN 32 AND 126 THEN ch
        WHEN unicode(ch) > 65535 THEN printf('\\u%04x\\u%04x',
          55296 + ((unicode(ch) - 65536) // 1024), 56320 + ((unicode(ch) - 65536) % 1024))
        ELSE printf('\\u%04x', unicode(ch)) END), '') || '"' END)"""


def humanize(n: str) -> str:
    steps = "".join(
        f" WHEN ({n})::DOUBLE < {1024.0 ** (k + 1):.1f}::DOUBLE"
        f" THEN printf('%.1f {unit}', ({n})::DOUBLE / {1024.0 ** k:.1f}::DOUBLE)"
        for k, unit in ((1, "KiB"), (2, "MiB"), (3, "GiB"), (4, "TiB"))
    )
    last = f"printf('%.1f PiB', ({n})::DOUBLE / {1024.0 ** 5:.1f}::DOUBLE)"
    return (
        f"(CASE WHEN ({n}) IS NULL THEN '' WHEN ({n}) < 1024 THEN ({n})::VARCHAR || ' B'"
        f"{steps} ELSE {last} END)"
    )


def iso(ts: str) -> str:
    return (
        f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({ts}) % 1000000 = 0"
        f" THEN '' ELSE strftime({ts}, '.%f') END || '+00:00')"
    )


EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"
NL = "chr(10)"


def field(name: str, kind: str, mode: str, description: str) -> str:
    """One schema line; the arguments are SQL texts."""
    return (
        f"'  - name: ' || {name} || '  type: ' || {kind} || '  mode: ' || {mode}"
        f" || '  description: ' || {json_quote(description)}"
    )


def at(seconds: str) -> str:
    return f"make_timestamp(({seconds})::BIGINT * 1000000)"


# --- listings ------------------------------------------------------------------------------

EVENT = f"""
  SELECT 'proj' AS project, 'ds' || (user_id % 4) AS dataset, 'res_' || event_id AS name,
    event_id AS seq, event_type, user_id, value, props, ts,
    {iso(f"CASE WHEN user_id % 5 <> 0 THEN ts ELSE {EPOCH} END")} AS modified,
    CASE WHEN user_id % 3 <> 0 THEN {iso("date_trunc('second', ts)")} END AS created,
    CASE WHEN value < 20 THEN props ELSE '' END AS description,
    CASE WHEN user_id % 7 <> 0 THEN 'us-east1' END AS region,
    CASE WHEN value >= 2 THEN floor(value)::BIGINT ELSE 0 END AS row_count,
    CASE WHEN value >= 1 THEN event_id * 1000 END AS total_logical_bytes,
    'schema:' || {NL} || {field("'id'", "'INTEGER'", "'REQUIRED'", "''")} || {NL}
      || {field("event_type", "'STRING'", "'NULLABLE'", "props")} || {NL} AS schema,
    CASE WHEN value >= 5 THEN 'SELECT ' || value || ' AS v' ELSE '' END AS sql,
    CASE WHEN user_id % 2 = 0 THEN CASE WHEN value >= 10 THEN 'ts' ELSE 'ingestion_time' END
      END AS partitioning,
    CASE WHEN value >= 8 THEN 'id|' || event_type END AS clustering,
    CASE WHEN user_id % 3 = 1 THEN 'id' END AS primary_keys,
    CASE WHEN value >= 3 THEN 'gs://bucket/' || event_id || '.csv|gs://bucket/b.csv' ELSE ''
      END AS source_uris,
    CASE WHEN value >= 3 THEN 'CSV' ELSE '' END AS source_format
  FROM events
"""

ROUTINE = f"""
  SELECT lower(p_type) AS dataset, 'fn_' || p_partkey AS name, p_partkey AS seq,
    CASE WHEN p_size <> 1 THEN 'RETURN ' || p_retailprice || ';' ELSE '' END AS sql,
    CASE WHEN p_brand IN ('Brand#13', 'Brand#14') THEN 'SQL' ELSE p_brand END AS language,
    CASE WHEN p_size <> 2 THEN p_name || ' "' || p_brand || '"' ELSE '' END AS description,
    CASE WHEN p_type <> 'SMALL' THEN p_brand END AS return_type,
    {iso(f"CASE WHEN p_size <> 3 THEN {at('1700000000 + p_size * 86400')} ELSE {EPOCH} END")}
      AS modified,
    CASE WHEN p_size % 2 = 0
      THEN {iso("make_timestamp(1690000000000000 + p_partkey)")} END AS created,
    p_size % 7 <> 0 AS has_arguments,
    CASE WHEN p_size > 5 THEN p_name ELSE '' END AS name0,
    CASE WHEN p_type <> 'PROMO' THEN p_type ELSE 'ANY' END AS type0,
    CASE WHEN p_size > 25 THEN 'INOUT' ELSE 'IN' END AS mode0
  FROM part
"""

SAVED = """
  SELECT c.conv_id, c.text
  FROM conversations c
  JOIN (SELECT conv_id, min(turn) AS turn, count(*) AS turns FROM conversations GROUP BY conv_id) f
    ON c.conv_id = f.conv_id AND c.turn = f.turn
  WHERE f.turns > 3 AND c.role = 'user'
"""

SCHEDULED = f"""
  SELECT 'proj' AS project, 'us-east1' AS region, 'job ' || user_id AS name, event_id AS seq,
    CASE WHEN value >= 4 THEN 'SELECT ' || value ELSE '' END AS sql,
    CASE WHEN value >= 10 THEN 'every ' || user_id || ' hours' ELSE '' END AS schedule,
    {iso(f"CASE WHEN user_id % 6 <> 0 THEN ts ELSE {EPOCH} END")} AS modified
  FROM events WHERE event_type = 'error'
"""


def position(dataset: str) -> str:
    cases = " ".join(f"WHEN '{d}' THEN {i}" for i, d in enumerate(SCOPE))
    return f"(CASE {dataset} {cases} END)"


IN_SCOPE = "dataset IN (" + ", ".join(f"'{d}'" for d in SCOPE) + ")"


def order_text(stage: str) -> str:
    """``stage * 10^19 + seq`` as text, without big numbers."""
    return (
        f"CASE WHEN ({stage}) = 0 THEN seq::VARCHAR"
        f" ELSE ({stage})::VARCHAR || lpad(seq::VARCHAR, 19, '0') END"
    )


# --- sync state --------------------------------------------------------------------------------

ORDER_PATH = f"'{ROOT}/sales/models/' || %s || '.yaml'"
ORDER_STATE = """
  src AS (SELECT o_orderkey AS k, o_orderdate AS modified, o_orderpriority, o_custkey
          FROM orders),
  loc AS (SELECT l_orderkey AS k, count(*) AS lines,
            max(l_shipdate) FILTER (WHERE l_linestatus = 'F') AS committed
          FROM lineitem GROUP BY l_orderkey),
  both_sides AS (SELECT coalesce(src.k, loc.k) AS k, src.k IS NOT NULL AS has_src,
            loc.k IS NOT NULL AS has_file, modified, committed, lines, o_orderpriority, o_custkey
          FROM src FULL OUTER JOIN loc ON src.k = loc.k)
"""


def order_plan(forced: str, where: str, pending: bool = True) -> str:
    """Plan rows of the order tables; ``forced`` is a condition on ``both_sides``."""
    committed = iso("committed")
    state = ORDER_STATE if pending else ORDER_STATE.replace("FROM orders)", "FROM orders WHERE o_orderstatus <> 'P')")
    return f"""
WITH {state},
decided AS (SELECT *, {ORDER_PATH % "k"} AS path,
  CASE WHEN has_src AND ({forced}) THEN 'forced'
       WHEN NOT has_src THEN 'deleted_at_source'
       WHEN NOT has_file THEN 'new'
       WHEN committed IS NULL THEN 'uncommitted'
       WHEN modified <= committed THEN 'up_to_date'
       ELSE 'source_newer' END AS reason
  FROM both_sides WHERE {where})
SELECT path, CASE WHEN has_src THEN 'table' END AS kind,
  CASE WHEN reason IN ('forced', 'new', 'source_newer') THEN 'fetch'
       WHEN reason = 'up_to_date' THEN 'skip' ELSE 'warn' END AS action,
  reason, {iso("modified")} AS modified, {committed} AS committed
FROM decided"""


LISTED = "k IN (1, 2, 5, 7, 10, 11)"

# Objects that share paths. `ord` follows the kinds, then the order key.
COLLIDING = f"""
  obj AS (SELECT o_orderkey AS seq, o_custkey AS c, o_orderdate AS modified, o_orderstatus,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'view' WHEN '2-HIGH' THEN 'routine'
      WHEN '3-MEDIUM' THEN 'table' WHEN '4-NOT SPECIFIED' THEN 'external' ELSE 'scheduled' END AS kind,
    CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2
      WHEN '4-NOT SPECIFIED' THEN 3 ELSE 4 END * 100000000000 + o_orderkey AS ord,
    CASE o_orderpriority WHEN '1-URGENT' THEN '{ROOT}/ds/views/c' || o_custkey || '.sql'
      WHEN '2-HIGH' THEN '{ROOT}/ds/routines/c' || o_custkey || '.sql'
      WHEN '3-MEDIUM' THEN '{ROOT}/ds/models/c' || o_custkey || '.yaml'
      WHEN '4-NOT SPECIFIED' THEN '{ROOT}/ds/models/c' || o_custkey || '.yaml'
      ELSE '{ROOT}/scheduled_queries/c' || o_custkey || '.sql' END AS path,
    '{ROOT}/ds/models/c' || o_custkey || '.yaml' AS model_path
    FROM orders),
  files AS (SELECT CASE c_mktsegment WHEN 'MACHINERY' THEN '{ROOT}/ds/views/c' || c_custkey || '.sql'
      WHEN 'AUTOMOBILE' THEN '{ROOT}/ds/routines/c' || c_custkey || '.sql'
      WHEN 'HOUSEHOLD' THEN '{ROOT}/ds/models/c' || c_custkey || '.yaml'
      ELSE '{ROOT}/scheduled_queries/c' || c_custkey || '.sql' END AS path
    FROM customer WHERE c_mktsegment <> 'BUILDING'),
  commits AS (SELECT CASE o_orderstatus WHEN 'P' THEN '{ROOT}/ds/models/c' || o_custkey || '.yaml'
      ELSE '{ROOT}/ds/views/c' || o_custkey || '.sql' END AS path, max(o_orderdate) AS committed
    FROM orders WHERE o_orderstatus <> 'O' GROUP BY ALL),
  placed AS (SELECT obj.*, files.path IS NOT NULL AS has_file, committed
    FROM obj LEFT JOIN files USING (path) LEFT JOIN commits USING (path)),
  sql_objects AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY ord) > 1 AS behind
    FROM placed WHERE kind NOT IN ('table', 'external')),
  sql_decided AS (SELECT *, CASE WHEN NOT has_file AND NOT behind THEN 'new'
      WHEN committed IS NULL THEN 'uncommitted'
      WHEN modified <= committed THEN 'up_to_date' ELSE 'source_newer' END AS reason
    FROM sql_objects),
  model_touches AS (
    SELECT path, ord, TRUE AS gated, seq FROM placed WHERE kind IN ('table', 'external')
    UNION ALL
    SELECT model_path, ord, FALSE, seq FROM sql_decided
      WHERE kind IN ('view', 'routine') AND reason IN ('new', 'source_newer')),
  model_order AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY ord) > 1 AS behind
    FROM model_touches),
  model_decided AS (SELECT placed.*, CASE WHEN NOT has_file AND NOT behind THEN 'new'
      WHEN committed IS NULL THEN 'uncommitted'
      WHEN modified <= committed THEN 'up_to_date' ELSE 'source_newer' END AS reason
    FROM placed JOIN model_order ON gated AND placed.seq = model_order.seq),
  real_plan AS (
    SELECT seq, c, ord, kind, path, model_path, modified, o_orderstatus, reason FROM sql_decided
    UNION ALL
    SELECT seq, c, ord, kind, path, model_path, modified, o_orderstatus, reason FROM model_decided),
  dry_plan AS (SELECT *, CASE WHEN NOT has_file THEN 'new'
      WHEN committed IS NULL THEN 'uncommitted'
      WHEN modified <= committed THEN 'up_to_date' ELSE 'source_newer' END AS reason FROM placed)
"""
OUTCOME = """CASE WHEN reason IN ('new', 'source_newer') THEN 'fetch'
       WHEN reason = 'up_to_date' THEN 'skip' ELSE 'warn' END"""

# --- model files -----------------------------------------------------------------------------


def line(label: str, value: str) -> str:
    """``label: value`` and a line break, or nothing where the value is null."""
    return f"coalesce('{label}: ' || {value} || {NL}, '')"


def non_empty(value: str) -> str:
    return f"nullif({value}, '')"


ROUTINE_YAML = f"""'name: ' || name || {NL} || 'description: ' || {json_quote("description")} || {NL}
  || 'language: ' || language || {NL} || {line("created", "created")}
  || 'modified: ' || modified || {NL} || {line("return_type", "return_type")}
  || CASE WHEN has_arguments THEN 'arguments:' || {NL} || '  - name: ' || name0 || '  type: '
     || type0 || '  mode: ' || mode0 || {NL} || '  - name: y  type: INT64  mode: IN' || {NL}
     ELSE '' END"""

ORDER_YAML = f"""'name: ' || k || {NL} || 'description: "' || o_orderpriority || '"' || {NL}
  || 'row_count: ' || o_custkey || {NL} || 'modified: ' || {iso("modified")} || {NL}
  || 'schema:' || {NL}"""

BYTES = {
    "region": "4 + strlen(r_name)",
    "nation": "4 + strlen(n_name) + 4",
    "customer": "8 + strlen(c_name) + 4 + 8 + strlen(c_mktsegment)",
    "supplier": "8 + strlen(s_name) + 4 + 8",
    "part": "8 + strlen(p_name) + strlen(p_brand) + strlen(p_type) + 4 + 8",
    "orders": "8 + 8 + strlen(o_orderstatus) + 8 + 8 + strlen(o_orderpriority)",
    "lineitem": "8 + 8 + 8 + 4 + 8 + 8 + 8 + 8 + strlen(l_returnflag) + strlen(l_linestatus) + 8",
    "events": "8 + 8 + 8 + strlen(event_type) + 8 + strlen(props)",
    "documents": "8 + strlen(text) + strlen(lang) + strlen(source) + 8",
    "embeddings": "8 + 4 * len(embedding) + 4",
    "pages": "8 + strlen(url) + strlen(html)",
    "benchmark": "8 + strlen(text)",
    "labels": "8 + 4 + 4",
    "conversations": "8 + 8 + strlen(role) + strlen(text)",
}

ORACLES: dict[str, str] = {
    "list_views": f"""
SELECT project, dataset, name, seq, sql, description, region, modified, created, schema
FROM ({EVENT}) WHERE event_type = 'view'""",
    "list_tables": f"""
SELECT project, dataset, name, seq, description, region, row_count, total_logical_bytes,
  modified, created, schema
FROM ({EVENT}) WHERE event_type = 'click'""",
    "list_externals": f"""
SELECT project, dataset, name, seq, description, row_count, source_format, source_uris,
  modified, partitioning, clustering, primary_keys
FROM ({EVENT}) WHERE event_type = 'purchase'""",
    "list_routines": f"""
WITH r AS ({ROUTINE})
SELECT dataset, name, seq, sql, language, description, return_type, modified, created,
  0 AS pos, name0 AS arg_name, type0 AS arg_type, mode0 AS arg_mode
FROM r WHERE has_arguments
UNION ALL
SELECT dataset, name, seq, sql, language, description, return_type, modified, created,
  1, 'y', 'INT64', 'IN'
FROM r WHERE has_arguments
UNION ALL
SELECT dataset, name, seq, sql, language, description, return_type, modified, created,
  NULL, NULL, NULL, NULL
FROM r WHERE NOT has_arguments""",
    "table_model_meta": f"""
SELECT p_brand AS dataset, 't' || p_partkey AS name,
  CASE p_size % 4 WHEN 0 THEN NULL WHEN 2 THEN p_type ELSE 'ingestion_time' END AS partitioning,
  CASE WHEN p_type NOT IN ('PROMO', 'SMALL') THEN p_name || '|' || p_type END AS clustering,
  CASE WHEN p_size > 20 THEN 'a|' || p_name END AS primary_keys,
  CASE WHEN p_size > 30 THEN p_partkey ELSE 0 END AS row_count,
  {iso(EPOCH)} AS modified
FROM part""",
    "list_scheduled": SCHEDULED,
    "list_saved_first": f"""
SELECT 'proj' AS project, 'us-east1' AS region, 'query ' || conv_id AS name, conv_id AS seq,
  text AS sql, {iso(EPOCH)} AS modified
FROM ({SAVED})""",
    "listing_detail_join": """
SELECT d.doc_id::VARCHAR AS name, d.doc_id AS seq, quality::BIGINT AS row_count,
  toxic::BIGINT AS total_logical_bytes
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "defaults_fill": f"""
SELECT CASE lang WHEN 'en' THEN 'table' ELSE 'view' END AS kind, source AS dataset,
  d.doc_id::VARCHAR AS name,
  CASE WHEN lang <> 'en' THEN CASE WHEN toxic IS NULL THEN '' ELSE text END END AS sql,
  CASE WHEN quality = 1 THEN 'good' ELSE '' END AS description,
  CASE WHEN lang = 'en' THEN coalesce(quality, 0)::BIGINT END AS row_count,
  {iso(f"CASE WHEN toxic = 0 THEN {at('n_chars')} ELSE {EPOCH} END")} AS modified
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "inventory_union": f"""
WITH e AS ({EVENT}), r AS ({ROUTINE})
SELECT 'view' AS kind, dataset, name, seq, modified,
  '{ROOT}/' || dataset || '/views/' || name || '.sql' AS path,
  '{ROOT}/' || dataset || '/models/' || name || '.yaml' AS model_path,
  {order_text(f"{position('dataset')} * 4")} AS run_order
FROM e WHERE event_type = 'view' AND {IN_SCOPE}
UNION ALL
SELECT CASE event_type WHEN 'click' THEN 'table' ELSE 'external' END, dataset, name, seq, modified,
  '{ROOT}/' || dataset || '/models/' || name || '.yaml', NULL,
  {order_text(f"{position('dataset')} * 4 + CASE event_type WHEN 'click' THEN 2 ELSE 3 END")}
FROM e WHERE event_type IN ('click', 'purchase') AND {IN_SCOPE}
UNION ALL
SELECT 'routine', dataset, name, seq, modified,
  '{ROOT}/' || dataset || '/routines/' || name || '.sql',
  '{ROOT}/' || dataset || '/models/' || name || '.yaml',
  {order_text(f"{position('dataset')} * 4 + 1")}
FROM r WHERE {IN_SCOPE}
UNION ALL
SELECT 'scheduled', NULL, name, seq, modified,
  '{ROOT}/scheduled_queries/' || name || '.sql', NULL, {order_text(str(4 * len(SCOPE)))}
FROM ({SCHEDULED})
UNION ALL
SELECT 'saved', NULL, 'query ' || conv_id, conv_id, {iso(EPOCH)},
  '{ROOT}/saved_queries/query ' || conv_id || '.sql', NULL,
  {order_text(str(4 * len(SCOPE) + 1))}
FROM (SELECT *, conv_id AS seq FROM ({SAVED}))""",
    "schema_lines": f"""
SELECT p_partkey, 'schema:' || {NL}
  || {field("'p' || p_partkey", "'INTEGER'", "'REQUIRED'", "('key \"' || p_name || '\"')")} || {NL}
  || {field("p_brand", "p_type", "'NULLABLE'",
            f"(CASE WHEN p_size > 10 THEN p_name || {NL} || 'é' ELSE '' END)")} || {NL}
  || {field("'size'", "'RECORD'", "'REPEATED'", "p_size::VARCHAR")} || {NL} AS lines
FROM part""",
    "humanize": f"""
WITH c AS (
  SELECT source AS id, sum(strlen(text))::BIGINT AS n FROM documents GROUP BY source
  UNION ALL
  SELECT o_orderkey::VARCHAR, CASE o_orderpriority WHEN '1-URGENT' THEN o_orderkey * 256
    WHEN '2-HIGH' THEN -o_orderkey WHEN '3-MEDIUM' THEN o_orderkey
    WHEN '4-NOT SPECIFIED' THEN (o_orderkey % 4096) * 1099511627776 + o_orderkey END
  FROM orders)
SELECT id, n, {humanize("n")} AS size FROM c""",
    "json_quote": f"SELECT doc_id, {json_quote('text')} AS quoted FROM documents",
    "iso_ts": f"""
SELECT event_id, {iso("ts")} AS exact, {iso("date_trunc('second', ts)")} AS whole FROM events""",
    "parse_model_path": """
WITH m AS (SELECT p_partkey, p_type, p_name, p_size % 6 AS form, CASE p_size % 6
    WHEN 0 THEN 'proj/' || p_type || '/' || p_name
    WHEN 1 THEN 'proj/' || p_type || '/models/' || p_name || '.yaml'
    WHEN 2 THEN 'proj/' || p_type || '/' || p_name || '.v' || p_partkey || '.sql'
    WHEN 3 THEN 'proj/' || p_name
    WHEN 4 THEN 'proj//.' || p_name
    ELSE 'a/b/' || p_type || '/' || p_name || '/' END AS model FROM part),
p AS (SELECT *, CASE WHEN form IN (0, 1, 2, 4) THEN 'proj' END AS project,
    CASE WHEN form IN (0, 1, 2) THEN p_type WHEN form = 4 THEN '' END AS dataset,
    CASE form WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 2 THEN p_name || '.v' || p_partkey
      WHEN 4 THEN '.' || p_name END AS name FROM m)
SELECT p_partkey, model, project, dataset, name,
  CASE WHEN form IN (3, 5) THEN 'invalid model path ''' || model
    || ''': 3 or 4 segments needed, found ' || CASE form WHEN 3 THEN 2 ELSE 5 END END AS error,
  project || '.' || dataset || '.' || name AS ref, p_partkey::VARCHAR AS key_stem
FROM p""",
    "export_dest": f"""
WITH r AS (SELECT doc_id, 'proj/' || source || '/t' || (doc_id % 50) || '.sql' AS model,
    '{ROOT}/data/t' || (doc_id % 50) || '.csv' AS dest FROM documents)
SELECT doc_id, model, dest, count(*) OVER (PARTITION BY dest) AS same_dest FROM r""",
    "table_stats": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS name, count(*) AS row_count,"
        f" sum({size})::BIGINT AS total_logical_bytes FROM {name}"
        for name, size in BYTES.items()
    ),
    "last_commit": f"""
SELECT {ORDER_PATH % "l_orderkey"} AS path, {iso("max(l_shipdate)")} AS committed
FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey""",
    "dirty_tree": f"""
WITH s AS (SELECT {ORDER_PATH % "l_orderkey"} AS path FROM lineitem WHERE l_linestatus = 'O'),
r AS (SELECT unnest(['{ROOT}', '{ROOT}/sales', '{ROOT}/sale', '/out/pro']) AS root)
SELECT root, (SELECT count(*) FROM s
  WHERE s.path = r.root OR starts_with(s.path, r.root || '/')) > 0 AS dirty
FROM r""",
    "sync_plan": order_plan("FALSE", "TRUE", pending=False),
    "sync_plan_pull": order_plan("FALSE", "has_src"),
    "sync_plan_dry_run": f"""
WITH {COLLIDING}
SELECT kind, path, seq, {OUTCOME} AS action, reason FROM dry_plan""",
    "sync_plan_force": order_plan("TRUE", "TRUE", pending=False),
    "sync_plan_force_files": order_plan(LISTED, "has_src"),
    "sync_plan_force_table": order_plan(
        "k IN (SELECT c_custkey FROM customer) OR k IN (SELECT p_partkey * 3 FROM part)", "TRUE", pending=False
    ),
    "sync_plan_files_without_force": order_plan("FALSE", "has_src"),
    "path_collisions": f"""
WITH {COLLIDING}
SELECT 'real' AS mode, kind, path, seq, {OUTCOME} AS action, reason FROM real_plan
UNION ALL
SELECT 'dry', kind, path, seq, {OUTCOME}, reason FROM dry_plan""",
    "collision_winners": f"""
WITH {COLLIDING},
writes AS (
  SELECT path, ord, kind, modified, CASE kind
    WHEN 'view' THEN 'q' || seq
    WHEN 'routine' THEN '-- Routine: c' || c || {NL} || '-- Language: SQL' || {NL} || {NL} || 'q' || seq
    WHEN 'scheduled' THEN '-- Scheduled Query: c' || c || {NL} || '-- Schedule: daily' || {NL}
      || {NL} || 'q' || seq
    WHEN 'table' THEN 'name: c' || c || {NL} || 'description: "' || o_orderstatus || '"' || {NL}
      || 'row_count: ' || seq || {NL} || 'modified: ' || {iso("modified")} || {NL} || 'schema:' || {NL}
    ELSE 'name: c' || c || {NL} || 'description: "' || o_orderstatus || '"' || {NL}
      || 'source_format: CSV' || {NL} || 'source_uris:' || {NL} || 'modified: ' || {iso("modified")}
      || {NL} || 'row_count: ' || seq || {NL} || 'schema:' || {NL} END AS content
  FROM real_plan WHERE reason IN ('new', 'source_newer')
  UNION ALL
  SELECT model_path, ord, kind, modified, 'name: c' || c || {NL}
    || 'description: "' || o_orderstatus || '"' || {NL}
    || CASE kind WHEN 'view' THEN 'type: VIEW' || {NL} || 'modified: ' || {iso("modified")} || {NL}
         || 'schema:' || {NL}
       ELSE 'language: SQL' || {NL} || 'modified: ' || {iso("modified")} || {NL} END
  FROM real_plan WHERE reason IN ('new', 'source_newer') AND kind IN ('view', 'routine'))
SELECT path, arg_max(kind, ord) AS kind, arg_max(content, ord) AS content,
  {iso("arg_max(modified, ord)")} AS modified
FROM writes GROUP BY path""",
    "apply_plan": f"""
WITH {ORDER_STATE}
SELECT {ORDER_PATH % "k"} AS path,
  CASE WHEN has_src AND (NOT has_file OR (committed IS NOT NULL AND modified > committed))
    THEN {ORDER_YAML} ELSE 'old ' || lines END AS content,
  'table' AS kind
FROM both_sides WHERE has_file OR has_src""",
    "view_pair_paths": f"""
WITH e AS ({EVENT}), r AS ({ROUTINE}),
fetched AS (
  SELECT 'view' AS kind, dataset, name, 'views' AS folder FROM e
  WHERE event_type = 'view' AND (value >= 20 OR (value < 10
    AND CASE WHEN user_id % 5 <> 0 THEN ts ELSE {EPOCH} END > date_trunc('hour', ts)))
  UNION ALL
  SELECT 'routine', dataset, name, 'routines' FROM r)
SELECT '{ROOT}/' || dataset || '/' || folder || '/' || name || '.sql' AS path, kind FROM fetched
UNION ALL
SELECT '{ROOT}/' || dataset || '/models/' || name || '.yaml', kind FROM fetched""",
    "pull_version": f"""
WITH e AS (SELECT *, CASE WHEN user_id % 5 <> 0 THEN ts ELSE {EPOCH} END AS changed,
    'ds' || (user_id % 4) AS dataset, 'res_' || event_id AS name FROM events),
synced AS (
  SELECT CASE event_type
      WHEN 'view' THEN '{ROOT}/' || dataset || '/views/' || name || '.sql'
      ELSE '{ROOT}/' || dataset || '/models/' || name || '.yaml' END AS path,
    '{ROOT}/' || dataset || '/models/' || name || '.yaml' AS model_path,
    CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'table' ELSE 'external' END AS kind,
    event_type IN ('view', 'click') AND value < 20 AS on_disk,
    {IN_SCOPE} AND (event_type = 'purchase' OR value >= 20
      OR (value < 10 AND changed > date_trunc('hour', ts))) AS fetched
  FROM e WHERE event_type IN ('view', 'click', 'purchase')),
r AS ({ROUTINE})
SELECT path, kind, fetched FROM synced WHERE on_disk OR fetched
UNION ALL
SELECT model_path, kind, TRUE FROM synced WHERE kind = 'view' AND fetched
UNION ALL
SELECT '{ROOT}/' || dataset || '/routines/' || name || '.sql', 'routine', TRUE FROM r WHERE {IN_SCOPE}
UNION ALL
SELECT '{ROOT}/' || dataset || '/models/' || name || '.yaml', 'routine', TRUE FROM r WHERE {IN_SCOPE}
UNION ALL
SELECT DISTINCT '{ROOT}/scheduled_queries/' || name || '.sql', 'scheduled', TRUE FROM ({SCHEDULED})
UNION ALL
SELECT '{ROOT}/saved_queries/query ' || conv_id || '.sql', 'saved', TRUE FROM ({SAVED})""",
    "render_sql": f"""
SELECT CASE doc_id % 4
    WHEN 0 THEN '{ROOT}/' || source || '/views/doc_' || doc_id || '.sql'
    WHEN 1 THEN '{ROOT}/' || source || '/routines/doc_' || doc_id || '.sql'
    WHEN 2 THEN '{ROOT}/scheduled_queries/doc_' || doc_id || '.sql'
    ELSE '{ROOT}/saved_queries/doc_' || doc_id || '.sql' END AS path,
  CASE doc_id % 4 WHEN 0 THEN 'view' WHEN 1 THEN 'routine' WHEN 2 THEN 'scheduled'
    ELSE 'saved' END AS kind,
  CASE doc_id % 4
    WHEN 0 THEN ''
    WHEN 1 THEN '-- Routine: doc_' || doc_id || {NL} || '-- Language: ' || lang || {NL} || {NL}
    WHEN 2 THEN '-- Scheduled Query: doc_' || doc_id || {NL} || '-- Schedule: every ' || n_chars
      || ' hours' || {NL} || {NL}
    ELSE '-- Saved Query: doc_' || doc_id || {NL} || {NL} END || text AS content
FROM documents""",
    "render_yaml_table": f"""
SELECT '{ROOT}/' || lower(p_type) || '/models/part_' || p_partkey || '.yaml' AS path,
  'table' AS kind,
  'name: part_' || p_partkey || {NL}
  || 'description: ' || {json_quote("(p_name || ' \"' || p_brand || '\"')")} || {NL}
  || 'row_count: ' || p_size || {NL}
  || {line("created", f"CASE WHEN p_size % 2 = 0 THEN {iso(at('1690000000 + p_partkey'))} END")}
  || 'modified: ' || {iso("make_timestamp(1700000000000000 + p_partkey * 250000)")} || {NL}
  || {line("region", "CASE WHEN p_size % 3 = 0 THEN 'US' END")}
  || {line("partitioning", "CASE WHEN p_size % 5 <> 0 THEN p_type END")}
  || {line("clustering", "CASE WHEN p_size > 40 THEN '[' || p_brand || ', id]' END")}
  || {line("primary_keys", "CASE WHEN p_size < 20 THEN '[id]' END")}
  || {line("total_logical_bytes",
           f"CASE WHEN p_size % 7 <> 0 THEN {humanize('p_partkey * p_size * 1000')} END")}
  || 'schema:' || {NL}
  || CASE WHEN p_size <> 9 THEN {field("'id'", "'INTEGER'", "'REQUIRED'", "p_name")} || {NL}
     || {field("'v'", "p_type", "'NULLABLE'", "''")} || {NL} ELSE '' END AS content
FROM part""",
    "render_yaml_view": f"""
SELECT '{ROOT}/' || source || '/models/doc_' || doc_id || '.yaml' AS path, 'view' AS kind,
  'name: doc_' || doc_id || {NL} || 'description: ' || {json_quote("text")} || {NL}
  || 'type: VIEW' || {NL}
  || {line("created", f"CASE lang WHEN 'en' THEN {iso(at('n_chars'))} END")}
  || 'modified: ' || {iso(at("1700000000 + doc_id"))} || {NL}
  || {line("region", "CASE lang WHEN 'en' THEN 'EU' END")}
  || 'schema:' || {NL} || {field("lang", "'STRING'", "'NULLABLE'", "source")} || {NL} AS content
FROM documents""",
    "render_yaml_routine": f"""
SELECT '{ROOT}/' || dataset || '/models/' || name || '.yaml' AS path, 'routine' AS kind,
  {ROUTINE_YAML} AS content
FROM ({ROUTINE})""",
    "render_yaml_external": f"""
SELECT '{ROOT}/web/models/page_' || page_id || '.yaml' AS path, 'external' AS kind,
  'name: page_' || page_id || {NL}
  || 'description: ' || {json_quote("coalesce(s_name, '')")} || {NL}
  || 'source_format: ' || CASE WHEN s_nationkey > 5 THEN 'CSV' ELSE '' END || {NL}
  || 'source_uris:' || {NL} || '  - ' || url || {NL}
  || CASE WHEN s_nationkey <> 3 THEN '  - ' || s_name || {NL} ELSE '' END
  || 'modified: ' || {iso(at("1700000000 + page_id"))} || {NL}
  || {line("region", "CASE WHEN s_nationkey < 12 THEN 'EU' END")}
  || 'row_count: ' || strlen(html) || {NL}
  || {line("clustering", "CASE WHEN s_nationkey > 20 THEN '[' || s_name || ']' END")}
  || 'total_logical_bytes: ' || {humanize("strlen(html) * page_id")} || {NL}
  || 'schema:' || {NL} || {field("'html'", "'STRING'", "'NULLABLE'", "url")} || {NL} AS content
FROM pages LEFT JOIN supplier ON page_id = s_suppkey""",
    "export_csv": "SELECT * FROM customer",
    "export_parquet": "SELECT * FROM customer",
    "export_csv_text": "SELECT * FROM documents",
    "export_csv_times": f"SELECT * REPLACE ({iso('ts')} AS ts) FROM events",
}
ORACLES["pull_runs"] = ORACLES["pull_compact"] = ORACLES["pull_version"]
ORACLES["pull_repeat"] = f"SELECT *, TRUE AS same FROM ({ORACLES['pull_version']})"
ORACLES["accepted_run"] = f"""
WITH {ORDER_STATE},
decided AS (SELECT {ORDER_PATH % "k"} AS path, CASE WHEN NOT has_file THEN 'new'
  WHEN modified > DATE '1996-01-01' THEN 'source_newer' ELSE 'up_to_date' END AS reason
  FROM both_sides WHERE has_src)
SELECT path, CASE reason WHEN 'up_to_date' THEN 'skip' ELSE 'fetch' END AS action, reason FROM decided"""
ORACLES["untied_run_order"] = f"""
SELECT '{ROOT}/scheduled_queries/c' || o_custkey || '.sql' AS path, 1 AS n_new, count(*) AS objects, 1 AS files
FROM orders GROUP BY o_custkey"""
ORACLES["definition_paths"] = rf"""
SELECT page_id, '{ROOT}/' || regexp_replace('scheduled_queries/' || url || '.sql', '/(\.?/)+', '/', 'g') AS path
FROM pages"""
ORACLES["definition_files"] = """
SELECT source || '/views/doc_' || doc_id || '.sql' AS path, text || chr(13) || chr(10) AS content FROM documents"""
ORACLES["fetch_model"] = "SELECT *, 'out/proj/data/customer.csv' AS dest FROM customer"
ORACLES["list_saved_damaged"] = f"""
SELECT 'query ' || conv_id AS name, text AS sql FROM ({SAVED}) WHERE conv_id % 3 <> 0"""

# Whole texts of the files that a run over the catalog writes.
EVENT_TITLE = f"'name: ' || name || {NL} || 'description: ' || {json_quote('description')} || {NL}"
EVENT_TIMES = f"{line('created', 'created')} || 'modified: ' || modified || {NL} || {line('region', 'region')}"
EVENT_ROWS = f"'row_count: ' || row_count || {NL}"
EVENT_STORAGE = f"""{line("partitioning", "partitioning")}
  || {line("clustering", "'[' || replace(clustering, '|', ', ') || ']'")} || {line("primary_keys", "'[' || primary_keys || ']'")}
  || {line("total_logical_bytes", f"CASE WHEN total_logical_bytes IS NOT NULL THEN {humanize('total_logical_bytes')} END")}"""
EVENT_URIS = f"""'source_uris:' || {NL} || CASE WHEN source_uris = '' THEN ''
  ELSE '  - ' || replace(source_uris, '|', {NL} || '  - ') || {NL} END"""
ORACLES["pull_contents"] = f"""
WITH e AS (SELECT *, event_type IN ('view', 'click') AND value < 20 AS on_disk,
    {IN_SCOPE} AND (event_type = 'purchase' OR value >= 20 OR (value < 10
      AND CASE WHEN user_id % 5 <> 0 THEN ts ELSE {EPOCH} END > date_trunc('hour', ts))) AS fetched
  FROM ({EVENT}) WHERE event_type IN ('view', 'click', 'purchase')),
r AS (SELECT * FROM ({ROUTINE}) WHERE {IN_SCOPE})
SELECT '{ROOT}/' || dataset || CASE event_type WHEN 'view' THEN '/views/' || name || '.sql'
    ELSE '/models/' || name || '.yaml' END AS path,
  CASE WHEN NOT fetched THEN 'old' WHEN event_type = 'view' THEN sql
    WHEN event_type = 'click' THEN {EVENT_TITLE} || {EVENT_ROWS} || {EVENT_TIMES} || {EVENT_STORAGE} || schema
    ELSE {EVENT_TITLE} || 'source_format: ' || source_format || {NL} || {EVENT_URIS} || {EVENT_TIMES}
      || {EVENT_ROWS} || {EVENT_STORAGE} || schema END AS content
FROM e WHERE on_disk OR fetched
UNION ALL
SELECT '{ROOT}/' || dataset || '/models/' || name || '.yaml',
  {EVENT_TITLE} || 'type: VIEW' || {NL} || {EVENT_TIMES} || schema
FROM e WHERE event_type = 'view' AND fetched
UNION ALL
SELECT '{ROOT}/' || dataset || '/routines/' || name || '.sql',
  '-- Routine: ' || name || {NL} || '-- Language: ' || language || {NL} || {NL} || sql FROM r
UNION ALL
SELECT '{ROOT}/' || dataset || '/models/' || name || '.yaml', {ROUTINE_YAML} FROM r
UNION ALL
SELECT '{ROOT}/scheduled_queries/' || name || '.sql', '-- Scheduled Query: ' || name || {NL} || '-- Schedule: '
  || arg_min(schedule, seq) || {NL} || {NL} || arg_min(sql, seq) FROM ({SCHEDULED}) GROUP BY name
UNION ALL
SELECT '{ROOT}/saved_queries/query ' || conv_id || '.sql',
  '-- Saved Query: query ' || conv_id || {NL} || {NL} || text FROM ({SAVED})"""

ORACLES["kept_state"] = ORACLES["sync_plan_pull"]
ORACLES["kept_state_deleted"] = ORACLES["sync_plan"]
ORACLES["log_order_commit"] = f"""
    SELECT {ORDER_PATH % "l_orderkey"} AS path, {iso("arg_max(l_shipdate, l_linenumber::BIGINT * 1000000000000 + l_partkey * 10000 + l_suppkey)")} AS committed
    FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey"""
ORACLES["pull_after_failure"] = ORACLES["run_after_failure"] = ORACLES["pull_version"]
ORACLES["export_after_failure"] = ORACLES["export_csv"]
ORACLES["definition_files_uri"] = """
    SELECT p_brand || '/models/part_' || p_partkey || '.yaml' AS path, p_name || chr(10) AS content FROM part"""
ORACLES["long_scope"] = f"""
    SELECT '{ROOT}/d' || o_custkey || '/models/' || o_orderkey || '.yaml' AS path, c_custkey * 4 + 2 AS stage, o_orderkey AS seq
    FROM orders JOIN customer ON o_custkey = c_custkey"""
