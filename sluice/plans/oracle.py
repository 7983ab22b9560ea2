"""DuckDB SQL stating each registered query's expected result.

The oracle does not parse the rendered inputs; it computes what parsing,
validation and assembly must produce straight from the source columns and the
derivation rules in ``sluice.plans.derive``. Column names equal the Spark ones.
"""

from __future__ import annotations

from sluice.plans import settings
from sluice.plans.derive import EMPTY, HEADER_ONLY, MISSING, OVERSIZED, UPLOAD_HEADERS
from sluice.schema import MAX_UPLOAD_BYTES, POSTBACK_EVENT, POSTBACK_REQUIRED_FIELDS

# Derived per-event values (mirrors sluice.plans.derive).
E = """
WITH e AS (
  SELECT event_id AS i, user_id AS u, event_type AS et, value, props, ts,
    'dev-' || CAST(user_id AS VARCHAR) AS did,
    '10.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) || '.'
      || CAST((event_id // 256) % 256 AS VARCHAR) AS ip,
    CASE WHEN event_id % 10 = 5 THEN CAST(epoch_us(ts) // 1000000 AS VARCHAR)
         WHEN event_id % 10 = 7 THEN strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+08:00'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END AS ts_text,
    epoch_us(ts) // 1000 AS ms,
    regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS k,
    CAST(value AS VARCHAR) AS vtext
  FROM events)
"""


def _topic(col: str) -> str:
    r = settings.ROUTES
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in r.items() if k != "default")
    return f"CASE {col} {whens} ELSE '{r['default']}' END"


# Form validity (F1 order): did (body unless i%7 in (1,4); query copy when i%4=0), timestamp, event_type.
FORM_STATUS = """
  CASE WHEN i % 7 IN (1, 4) AND i % 4 <> 0 THEN 'Missing Required field: No did'
       WHEN i % 7 IN (2, 4) THEN 'Missing Required field: No timestamp'
       WHEN i % 7 = 3 THEN 'Missing Required field: No event_type' END
"""

FORMS = (
    E
    + f""", f AS (
  SELECT *, {FORM_STATUS} AS reason FROM e)
"""
)

ORACLE: dict[str, str] = {}

ORACLE["events_per_topic"] = (
    FORMS
    + f"""
SELECT {_topic('et')} AS topic, count(*) AS n_events FROM f WHERE reason IS NULL GROUP BY 1
"""
)

ORACLE["form_event_record"] = (
    FORMS
    + """
SELECT i AS request_id, 'TrackerEvent' AS event, '' AS id, ts_text AS timestamp,
  CASE WHEN i % 7 IN (1, 4) THEN 'other-' || CAST(i AS VARCHAR) ELSE did END AS did,
  CASE WHEN i % 5 <> 0 THEN 'a' || CAST(i AS VARCHAR) END AS aid,
  CASE WHEN i % 3 <> 0 THEN ip END AS ip,
  concat_ws(',', CASE WHEN i % 13 = 0 THEN 'event' END, 'event_type', CASE WHEN i % 8 = 0 THEN 'flag' END,
            CASE WHEN i % 13 = 0 THEN 'id' END, 'k', CASE WHEN i % 6 = 3 THEN 'note' END,
            CASE WHEN i % 11 = 0 THEN 'q' END, 'value') AS ext_keys,
  et AS ext_event_type, vtext AS ext_value, k AS ext_k,
  CASE WHEN i % 6 = 3 THEN '' END AS ext_note,
  CASE WHEN i % 11 = 0 THEN 'a=b=c&d e' END AS ext_q,
  CASE WHEN i % 8 = 0 THEN '' END AS ext_flag,
  CASE WHEN i % 13 = 0 THEN 'fake' END AS ext_event,
  CAST(NULL AS VARCHAR) AS ext_bad
FROM f WHERE reason IS NULL
"""
)

ORACLE["event_validation"] = (
    FORMS
    + """
SELECT i AS request_id, CASE WHEN reason IS NULL THEN 200 ELSE 400 END AS status, reason FROM f
"""
)

ORACLE["event_routing"] = (
    FORMS
    + f"""
SELECT i AS request_id, CASE WHEN i % 7 <> 3 THEN et END AS event_type,
  CASE WHEN reason IS NULL THEN {_topic('et')} END AS topic FROM f
"""
)

ORACLE["form_replies"] = (
    FORMS
    + """
SELECT i AS request_id, CASE WHEN reason IS NULL THEN 200 ELSE 400 END AS status,
  coalesce(reason, '1 messages have been writen.') AS reply FROM f
"""
)

ORACLE["client_address"] = (
    E
    + """
SELECT i AS request_id,
  CASE WHEN i % 3 = 2 THEN '203.0.113.' || CAST(i % 250 AS VARCHAR)
       ELSE ip || ':' || CAST(1024 + i % 50000 AS VARCHAR) END AS client_addr
FROM e
"""
)

ORACLE["form_url_params"] = """
WITH p AS (
  SELECT page_id, url,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
    list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda x: x <> '') AS pieces
  FROM pages)
SELECT page_id, path, CAST(len(pieces) AS INTEGER) AS n_params,
  array_to_string(list_sort(pieces), '&') AS params,
  nullif(regexp_extract(url, '\\?(?:[^#]*&)?page=([^&#]*)', 1), '') AS page,
  nullif(regexp_extract(url, '\\?(?:[^#]*&)?ref=([^&#]*)', 1), '') AS ref,
  nullif(regexp_extract(url, '\\?(?:[^#]*&)?utm_source=([^&#]*)', 1), '') AS utm_source
FROM p
"""

# --- partner postbacks ------------------------------------------------------
_PB_MISSING = " ".join(f"WHEN i % 19 = {n + 1} THEN 'Missing Required field: No {f}'" for n, f in enumerate(POSTBACK_REQUIRED_FIELDS))

POSTBACKS = (
    E
    + f""", pb AS (
  SELECT *,
    CASE WHEN i % 23 = 1 THEN ' 12 ' WHEN i % 23 = 2 THEN '1e3' WHEN i % 23 = 3 THEN ''
         WHEN i % 23 = 4 THEN '99999999999999999999' WHEN i % 23 = 5 THEN '-5'
         WHEN i % 23 = 6 THEN '253402300800000' ELSE CAST(ms AS VARCHAR) END AS pts
  FROM e),
v AS (
  SELECT *,
    CASE {_PB_MISSING}
         WHEN i % 17 IN (3, 5) THEN 'Sign mismatched!'
         WHEN i % 23 IN (1, 2, 3) THEN 'Failed to parse ts:strconv.ParseInt: parsing "' || pts || '": invalid syntax'
         WHEN i % 23 = 4 THEN 'Failed to parse ts:strconv.ParseInt: parsing "' || pts || '": value out of range'
         WHEN i % 23 = 6 THEN 'Failed to parse ts:timestamp out of range' END AS reason,
    CASE WHEN i % 19 BETWEEN 1 AND 9 OR i % 17 IN (3, 5) THEN 400
         WHEN i % 23 IN (1, 2, 3, 4, 6) THEN 500 ELSE 200 END AS status
  FROM pb)
"""
)

ORACLE["postback_verdicts"] = POSTBACKS + "SELECT i AS request_id, status, reason FROM v"

ORACLE["postback_records"] = (
    POSTBACKS
    + """
SELECT i AS request_id, '""" + POSTBACK_EVENT + """' AS event, 'kw' || CAST(i AS VARCHAR) AS id,
  strftime(epoch_ms(CAST(pts AS BIGINT)), '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
  'idfa-' || CAST(u AS VARCHAR) AS did, CAST(NULL AS VARCHAR) AS aid,
  CASE WHEN i % 3 <> 0 THEN ip END AS ip, 'ios' AS os,
  'adid,adname,appid,channel,device,point' AS ext_keys,
  'app' || CAST(u % 50 AS VARCHAR) AS ext_appid, 'ad-' || et AS ext_adname,
  CAST(i % 1000 AS VARCHAR) AS ext_adid, 'iPhone' || CAST(u % 5 + 8 AS VARCHAR) AS ext_device,
  k AS ext_point, 'c' || CAST(i % 3 AS VARCHAR) AS ext_channel
FROM v WHERE status = 200
"""
)

ORACLE["postback_outbox"] = (
    POSTBACKS
    + f"""
SELECT i AS source_id, 'GET' AS method,
  '{settings.POSTBACK_BASE_URL}?params=kw' || CAST(i AS VARCHAR) AS url,
  'Connection: keep-alive' AS headers, '{settings.ROUTES["default"]}' AS topic
FROM v WHERE status = 200
"""
)

# --- partner clicks -----------------------------------------------------------
CLICKS = (
    E
    + """, c AS (
  SELECT *,
    CASE WHEN i % 89 IN (7, 8) THEN 'undecodable'
         WHEN i % 97 = 3 THEN 'no_event'
         WHEN et <> 'click' THEN 'not_click'
         WHEN i % 31 = 0 OR i % 101 IN (1, 2, 3, 4) THEN 'no_extension'
         WHEN i % 5 = 1 THEN 'no_adv_id'
         WHEN i % 5 = 2 OR i % 10 = 3 THEN 'bad_adv_id'
         WHEN i % 37 = 2 THEN 'no_id'
         WHEN i % 41 = 3 THEN 'no_did'
         WHEN i % 13 = 0 THEN 'no_ip'
         WHEN i % 10 = 5 THEN 'bad_timestamp'
         WHEN i % 11 = 4 THEN 'no_device_model'
         ELSE 'ok' END AS verdict,
    CASE WHEN i % 8 IN (3, 5) THEN 'unknown'
         ELSE CAST(CAST(k AS INTEGER) % 10 + 7 AS VARCHAR) || '.' || CAST(CAST(k AS INTEGER) % 3 AS VARCHAR) END AS osv
  FROM e)
"""
)

ORACLE["click_verdicts"] = CLICKS + "SELECT i AS offset, verdict FROM c"

ORACLE["click_urls"] = (
    CLICKS
    + f"""
SELECT i AS source_id, 'GET' AS method,
  '{settings.CLICK_BASE_URL}?pid={settings.PARTNER_PID}&advid=adv' || CAST(u % 100 AS VARCHAR)
    || '&ip=' || ip || '&cts=' || CAST(ms AS VARCHAR) || '&osv=' || osv
    || '&idfa=' || upper(did) || '&keywords=auc-' || CAST(i AS VARCHAR) AS url,
  'Connection: keep-alive' AS headers
FROM c WHERE verdict = 'ok'
"""
)

# --- dead letters and replay --------------------------------------------------
REPLAY = (
    E
    + f""", r AS (
  SELECT *,
    CASE WHEN i % 5 <> 4 THEN 0 WHEN i % 10 = 4 THEN 1 ELSE 100 END AS attempt,
    i % 43 IN (1, 2, 3) AS bad
  FROM e)
"""
)

ORACLE["dead_letter_roundtrip"] = (
    REPLAY
    + f"""
SELECT attempt, CASE WHEN bad THEN 'undecodable' ELSE 'ok' END AS verdict,
  CASE WHEN NOT bad THEN 'a' || CAST(i AS VARCHAR) END AS aid,
  CASE WHEN NOT bad THEN did END AS did,
  CASE WHEN NOT bad THEN ts_text END AS timestamp,
  CASE WHEN NOT bad THEN et END AS event_type,
  CASE WHEN NOT bad THEN vtext END AS value,
  CASE WHEN NOT bad THEN k END AS k,
  CASE WHEN NOT bad THEN {_topic('et')} END AS topic
FROM r
"""
)

ORACLE["replay_summary"] = (
    REPLAY
    + """
SELECT attempt, count(*) FILTER (WHERE NOT bad) AS success, count(*) FILTER (WHERE bad) AS failed
FROM r GROUP BY attempt
"""
)

ORACLE["retry_generation"] = (
    REPLAY
    + """
SELECT attempt, CASE WHEN attempt + 1 <= 100 THEN attempt + 1 END AS next_attempt,
  CASE WHEN attempt + 1 <= 100 THEN 'retry' ELSE 'exhausted' END AS retry, count(*) AS n_lines
FROM r WHERE bad GROUP BY ALL
"""
)

# --- codec, messages, partitions ----------------------------------------------
ORACLE["codec_roundtrip"] = (
    E
    + """
SELECT true AS decoded, 'TrackerEvent' AS event, '' AS id, ts_text AS timestamp, did,
  'a' || CAST(i AS VARCHAR) AS aid, CASE WHEN i % 3 <> 0 THEN ip END AS ip,
  CAST(NULL AS VARCHAR) AS os, CAST(NULL AS VARCHAR) AS exchange,
  'event_type,k,value' AS ext_keys, et AS ext_event_type, vtext AS ext_value, k AS ext_k
FROM e
"""
)

ORACLE["topic_messages"] = (
    E
    + f"""
SELECT {_topic('et')} AS topic, CAST(NULL AS INTEGER) AS partition, true AS no_key,
  'a' || CAST(i AS VARCHAR) AS aid, et AS event_type
FROM e
"""
)

ORACLE["string_message"] = (
    E
    + f"""
SELECT {_topic('et')} AS topic, 'a' || CAST(i AS VARCHAR) AS aid, ts_text AS timestamp FROM e
"""
)

ORACLE["message_partitions"] = """
SELECT 'a' || CAST(event_id AS VARCHAR) AS aid, 3 AS manual_partition,
  CAST(NULL AS INTEGER) AS hash_partition, CAST(NULL AS INTEGER) AS random_partition
FROM events
"""

# --- request dispatch -----------------------------------------------------------
_PREFIX_VALUES = ", ".join(f"('{p}')" for p in settings.PREFIXES)
DISPATCH = f"""
WITH p AS (
  SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path FROM pages),
pre AS (SELECT * FROM (VALUES {_PREFIX_VALUES}) t(prefix)),
m AS (
  SELECT page_id, path, arg_max(prefix, length(prefix)) AS prefix
  FROM p LEFT JOIN pre ON starts_with(p.path, pre.prefix) GROUP BY page_id, path)
"""

ORACLE["prefix_match"] = (
    DISPATCH
    + """
SELECT page_id, path, prefix, CASE WHEN prefix IS NULL THEN 'No handler matched.' END AS reason FROM m
"""
)

ORACLE["request_count"] = DISPATCH + "SELECT count(*) AS n_requests, count(prefix) AS n_matched FROM m"

# --- CSV uploads ----------------------------------------------------------------
UPLOADS = (
    E
    + """, x AS (
  SELECT *, i // 500 AS upload_id, (i // 500) % 4 AS variant, (i % 53 = 0 OR i % 59 = 0) AS ragged,
    CASE WHEN i % 7 = 0 THEN 'x,"y"' WHEN i % 11 = 0 THEN 'line' || chr(10) || 'break'
         WHEN i % 13 = 0 THEN '' ELSE 'n' || CAST(i AS VARCHAR) END AS note
  FROM e)
"""
)

ORACLE["csv_event_record"] = (
    UPLOADS
    + f"""
SELECT upload_id, 'TrackerEvent' AS event, '' AS id, did, ts_text AS timestamp,
  CASE WHEN variant = 0 THEN 'a' || CAST(i AS VARCHAR) END AS aid,
  CASE WHEN variant = 0 THEN CASE WHEN i % 3 <> 0 THEN ip ELSE '' END END AS ip,
  CASE variant WHEN 0 THEN 'event_type,k,note,value' WHEN 1 THEN 'event_type,k,value' ELSE 'event_type,value' END AS ext_keys,
  et AS ext_event_type, vtext AS ext_value,
  CASE WHEN variant IN (0, 1) THEN k END AS ext_k,
  CASE WHEN variant = 0 THEN note END AS ext_note,
  {_topic('et')} AS topic
FROM x WHERE variant <> 3 AND NOT ragged
"""
)

ORACLE["csv_quarantine"] = (
    UPLOADS
    + """
SELECT upload_id, 500 AS status, 'Err read file:wrong number of fields' AS reason, count(*) AS n_rows
FROM x WHERE variant <> 3 AND ragged GROUP BY upload_id
"""
)

# Every upload with a file: those of the rows, and those that are a header only or above the cap.
# The one above the cap holds its header, the padding and two line ends.
_HEADER = ",".join(UPLOAD_HEADERS[0])
_LARGE = len(_HEADER) + MAX_UPLOAD_BYTES + 2
FILES = (
    UPLOADS
    + f""", u AS (SELECT DISTINCT upload_id, variant FROM x),
files AS (
  SELECT upload_id, CASE WHEN variant = 3 THEN 400 ELSE 200 END AS status,
    CASE WHEN variant = 3 THEN 'Missing Required field: No timestamp' END AS reason FROM u
  UNION ALL SELECT upload_id + {HEADER_ONLY}, 200, NULL FROM u WHERE upload_id % 4 = 1
  UNION ALL SELECT upload_id + {OVERSIZED}, 400, 'The file is too large:{_LARGE}bytes' FROM u WHERE upload_id % 50 = 3)
"""
)

ORACLE["csv_file_verdicts"] = FILES + "SELECT * FROM files"

ORACLE["upload_receipts"] = (
    FILES
    + """
SELECT files.upload_id, count(x.i) FILTER (WHERE NOT ragged) AS n_written,
  CAST(count(x.i) FILTER (WHERE NOT ragged) AS VARCHAR) || ' messages have been writen.' AS receipt
FROM files LEFT JOIN x ON x.upload_id = files.upload_id WHERE status = 200 GROUP BY files.upload_id
"""
)

ORACLE["stream_click_urls"] = ORACLE["click_urls"]

ORACLE["dead_letter_table"] = (
    FORMS
    + """
SELECT 0 AS attempt, reason AS error, count(*) AS n_letters, count(*) AS n_with_payload
FROM f WHERE reason IS NOT NULL GROUP BY reason
"""
)

ORACLE["stream_form_ingest"] = ORACLE["events_per_topic"]

ORACLE["topic_dump"] = (
    FORMS
    + f"""
SELECT '{settings.ROUTES["click"]}' AS topic, true AS decoded,
  CASE WHEN i % 7 IN (1, 4) THEN 'other-' || CAST(i AS VARCHAR) ELSE did END AS did,
  ts_text AS timestamp, CASE WHEN i % 5 <> 0 THEN 'a' || CAST(i AS VARCHAR) END AS aid,
  CASE WHEN i % 3 <> 0 THEN ip END AS ip, et AS event_type, vtext AS value
FROM f WHERE reason IS NULL AND et = 'click'
"""
)

ORACLE["replay_tables"] = (
    REPLAY
    + f"""
SELECT 'topic' AS "table", {_topic('et')} AS part, CAST(NULL AS VARCHAR) AS error, count(*) AS n
FROM r WHERE NOT bad GROUP BY 2
UNION ALL
SELECT 'dead_letter', CAST(CASE WHEN attempt + 1 <= 100 THEN attempt + 1 ELSE 101 END AS VARCHAR),
  CASE WHEN attempt + 1 <= 100 THEN 'undecodable' ELSE 'exhausted' END, count(*)
FROM r WHERE bad GROUP BY 2, 3
"""
)

ORACLE["partition_manual"] = (
    E
    + f"""
SELECT {_topic('et')} AS topic, 3 AS partition, 'a' || CAST(i AS VARCHAR) AS aid FROM e
"""
)

ORACLE["csv_header_check"] = (
    FILES
    + """
SELECT upload_id, reason IS NULL OR reason LIKE 'The file%' AS header_ok,
  CASE WHEN reason LIKE 'Missing%' THEN reason END AS missing
FROM files
"""
)

ORACLE["upload_size"] = FILES + "SELECT upload_id, reason IS NULL OR reason NOT LIKE 'The file%' AS within_cap FROM files"

ORACLE["upload_messages"] = (
    FILES
    + f"""
SELECT 'message' AS kind, {_topic('et')} AS name, count(*) AS n FROM x WHERE variant <> 3 AND NOT ragged GROUP BY 2
UNION ALL
SELECT 'dead_letter', 'Err read file:wrong number of fields', count(*) FROM x WHERE variant <> 3 AND ragged HAVING count(*) > 0
UNION ALL
SELECT 'dead_letter', reason, count(*) FROM files WHERE status <> 200 GROUP BY reason
"""
)

ORACLE["stream_upload_ingest"] = ORACLE["upload_messages"]

# Rows before an upload's first faulty one, where the original stops.
PREFIX = (
    FILES
    + """, cut AS (
  SELECT *, min(CASE WHEN ragged THEN i END) OVER (PARTITION BY upload_id) AS fault FROM x WHERE variant <> 3)
"""
)

ORACLE["csv_prefix_rows"] = (
    ORACLE["csv_event_record"].replace(UPLOADS, PREFIX).replace("FROM x WHERE variant <> 3 AND NOT ragged", "FROM cut WHERE fault IS NULL OR i < fault")
)

REQUESTS = f""", requests AS (
  SELECT files.upload_id, status, reason, any_value(fault) AS fault,
    count(cut.i) FILTER (WHERE fault IS NULL OR cut.i < fault) AS n_read
  FROM files LEFT JOIN cut ON cut.upload_id = files.upload_id GROUP BY files.upload_id, status, reason
  UNION ALL SELECT upload_id + {EMPTY}, 500, 'Failed to read the first line of file:EOF', NULL, 0 FROM u WHERE upload_id % 5 = 0
  UNION ALL SELECT upload_id + {MISSING}, 500, 'Failed to read upload file:', NULL, 0 FROM u WHERE upload_id % 5 = 2)
"""

ORACLE["upload_replies"] = (
    PREFIX
    + REQUESTS
    + """
SELECT upload_id, CASE WHEN status <> 200 THEN status WHEN fault IS NOT NULL THEN 500 ELSE 200 END AS status,
  n_read AS n_written,
  CASE WHEN status <> 200 THEN reason WHEN fault IS NOT NULL THEN 'Err read file:wrong number of fields'
    ELSE CAST(n_read AS VARCHAR) || ' messages have been writen.' END AS reply
FROM requests
"""
)

# The sink refuses every ninth line; lines are numbered within their upload.
ORACLE["stream_upload_replies"] = (
    PREFIX
    + REQUESTS
    + """, sends AS (
  SELECT upload_id, count(*) FILTER (WHERE NOT ragged AND line % 9 = 0) AS n_unsent,
    count(*) FILTER (WHERE NOT ragged AND line % 9 <> 0) AS n_sent, count(*) FILTER (WHERE ragged) AS n_ragged
  FROM (SELECT *, row_number() OVER (PARTITION BY upload_id ORDER BY i) AS line FROM x WHERE variant <> 3) GROUP BY upload_id)
SELECT r.upload_id,
  CASE WHEN status <> 200 THEN status WHEN coalesce(n_unsent, 0) > 0 THEN 500 ELSE 200 END AS status,
  coalesce(n_sent, 0) AS n_written,
  CASE WHEN status <> 200 THEN reason WHEN coalesce(n_unsent, 0) > 0 THEN 'Failed to send to kafka:refused'
    ELSE CAST(coalesce(n_sent, 0) AS VARCHAR) || ' messages have been writen.' END AS reply,
  coalesce(n_unsent, 0) AS n_unsent,
  coalesce(n_ragged, 0) + CASE WHEN status <> 200 THEN 1 ELSE 0 END AS n_rejected
FROM requests r LEFT JOIN sends ON sends.upload_id = r.upload_id
"""
)

# --- the dead-letter loop -----------------------------------------------------------
# Request N is refused until its try N % 4; damaged payloads never decode.
LOOP = (
    FORMS
    + f""", v AS (
  SELECT *, {_topic('et')} AS topic, i % 43 = 5 AS damaged,
    CASE WHEN i % 7 IN (1, 4) THEN 'other-' || CAST(i AS VARCHAR) ELSE did END AS form_did FROM f),
tries AS (
  SELECT *, unnest(generate_series(0, CASE WHEN damaged THEN 3 ELSE i % 4 END)) AS attempt
  FROM v WHERE reason IS NULL AND i % 4 > 0),
judged AS (
  SELECT *, CASE WHEN damaged AND attempt > 0 THEN 'undecodable' WHEN attempt < i % 4 THEN 'refused' END AS error FROM tries)
"""
)

ORACLE["dead_letter_replay"] = (
    LOOP
    + """
SELECT i AS request_id, 'unsent' AS kind, 1::BIGINT AS copies, attempt::INTEGER AS attempt,
  CASE WHEN error IS NULL THEN 'sent' ELSE 'failed' END AS outcome, error, topic,
  CASE WHEN NOT damaged THEN form_did END AS did, CASE WHEN NOT damaged THEN ts_text END AS timestamp,
  CASE WHEN NOT damaged THEN vtext END AS value
FROM judged
UNION ALL
SELECT i, 'rejected', 1, 0, 'failed', reason, NULL, NULL, NULL, NULL FROM v WHERE reason IS NOT NULL
"""
)

ORACLE["replayed_messages"] = (
    LOOP
    + """
SELECT topic, form_did AS did, ts_text AS timestamp, CASE WHEN i % 5 <> 0 THEN 'a' || CAST(i AS VARCHAR) END AS aid,
  et AS event_type, vtext AS value
FROM v WHERE reason IS NULL AND (i % 4 = 0 OR NOT damaged)
"""
)

ORACLE["replay_counts"] = (
    LOOP
    + """
SELECT "commit", sum(success)::BIGINT AS success, sum(failed)::BIGINT AS failed FROM (
  SELECT CASE WHEN attempt = 0 THEN 'ingest' ELSE 'replay-' || CAST(attempt AS VARCHAR) END AS "commit",
    (error IS NULL)::INTEGER AS success, (error IS NOT NULL)::INTEGER AS failed FROM judged
  UNION ALL SELECT 'ingest', 0, 1 FROM v WHERE reason IS NOT NULL)
GROUP BY "commit"
"""
)

ORACLE["stream_send_counts"] = (
    FORMS
    + """
SELECT who AS "by", count(*) FILTER (WHERE reason IS NULL AND i % 5 <> 0) AS success,
  count(*) FILTER (WHERE reason IS NULL AND i % 5 = 0) AS failed, count(*) FILTER (WHERE reason IS NOT NULL) AS rejected
FROM f, (VALUES ('counted'), ('kept')) w(who) GROUP BY who
"""
)

ORACLE["delivery_results"] = f"""
SELECT source_id, url, (CASE WHEN i % 13 = 1 OR i % 11 = 0 THEN NULL WHEN i % 7 = 0 THEN 503 ELSE 200 END)::INTEGER AS status,
  CASE WHEN i % 13 <> 1 AND i % 11 = 0 THEN 'timeout' END AS error,
  CASE WHEN i % 13 = 1 THEN 'no_result' WHEN i % 11 = 0 THEN 'no_reply' WHEN i % 7 = 0 THEN 'bad_reply' ELSE 'delivered' END AS outcome
FROM (SELECT source_id, source_id AS i, url FROM ({ORACLE['click_urls']}))
"""

ORACLE["click_at_most_once"] = f"SELECT source_id, url, 1::BIGINT AS n_sent FROM ({ORACLE['click_urls']})"

ORACLE["keyed_partitions"] = E + "SELECT did, count(*) AS n_messages, 1::BIGINT AS n_partitions, true AS in_range FROM e GROUP BY did"

ORACLE["prefix_table_match"] = """
WITH starts AS (
  SELECT DISTINCT unnest(list_transform(range(1, length(url) + 1), lambda n: url[1:n])) AS prefix FROM pages WHERE page_id % 2 = 0
  UNION SELECT '/'),
m AS (
  SELECT page_id, url, arg_max(prefix, length(prefix)) AS prefix
  FROM pages LEFT JOIN starts ON starts_with(url, prefix) GROUP BY page_id, url)
SELECT page_id, prefix, CASE WHEN prefix IS NULL THEN 'No handler matched.' END AS reason FROM m
"""
