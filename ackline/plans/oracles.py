"""Reference SQL of the catalog queries, for DuckDB over the same tables.

Written from the definitions (plain windows, as-of and interval joins), not from
the Spark plans. Stored objects are the texts of the documents.
"""

from __future__ import annotations

from ackline.plans.fixtures import with_views

_TP = "topic, partition_id"
_PROGRESS = "topic, partition_id, epoch"
_TOKEN = "topic, partition_id, epoch, record_offset"
_LOCATION = "topic, partition_id, record_offset"

# -- records ------------------------------------------------------------------

_RECORD_TEXT = f"""
SELECT {_LOCATION}, seq, key_text, payload_text,
       'event_type=' || h_type || CASE WHEN h_retry = 1 THEN ',retry=' ELSE '' END AS header_text,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text
FROM records"""

_SIZED = """
sized AS (SELECT topic, partition_id, record_offset, seq,
  coalesce(CAST(bit_length(payload_text) / 8 AS BIGINT), 0) AS payload_bytes,
  CAST(128 + coalesce(CAST(bit_length(key_text) / 8 AS BIGINT), 0) + coalesce(CAST(bit_length(payload_text) / 8 AS BIGINT), 0)
       + 10 + CAST(bit_length(h_type) / 8 AS BIGINT) + 5 * h_retry AS BIGINT) AS accounted_bytes,
  topic || '[' || partition_id || '] offset ' || record_offset AS location
  FROM records)"""

_GUARDED = f"""{_SIZED},
guarded AS (SELECT *,
  CASE WHEN payload_bytes > 8 THEN 'payload_too_large' WHEN accounted_bytes > 160 THEN 'budget_exceeded' END AS violation,
  CASE WHEN payload_bytes > 8 THEN 'record ' || location || ' has a ' || payload_bytes || ' byte payload, exceeding max_payload_bytes=8'
       WHEN accounted_bytes > 160 THEN 'record ' || location || ' accounts for ' || accounted_bytes || ' bytes, exceeding the 160 byte ingress budget'
  END AS message FROM sized)"""

# -- metadata -----------------------------------------------------------------

_BLANK = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]*"

_PARSED = """
j AS (SELECT *, CASE WHEN json_valid(payload_text) THEN payload_text END AS doc FROM object_records),
f AS (SELECT topic, partition_id, record_offset, payload_text,
  coalesce(json_type(doc) = 'OBJECT' AND json_type(doc, '$.bucket') = 'VARCHAR' AND json_type(doc, '$.key') = 'VARCHAR'
    AND json_type(doc, '$.size') = 'UBIGINT' AND coalesce(json_type(doc, '$.etag'), 'NULL') IN ('NULL', 'VARCHAR'), false) AS ok,
  doc ->> '$.bucket' AS bucket, doc ->> '$.key' AS object_key, doc ->> '$.etag' AS etag,
  TRY_CAST(doc ->> '$.size' AS BIGINT) AS size FROM j)"""

_RULES = [
    ("empty_field", "bucket", f"regexp_full_match(bucket, '{_BLANK}')"),
    ("null_character", "bucket", "contains(bucket, chr(0))"),
    ("empty_field", "key", "object_key = ''"),
    ("null_character", "key", "contains(object_key, chr(0))"),
    ("empty_object", None, "size = 0"),
    ("object_too_large", None, "size > 16384"),
    ("empty_field", "etag", f"regexp_full_match(etag, '{_BLANK}')"),
    ("null_character", "etag", "contains(etag, chr(0))"),
]


def _case(column: int) -> str:
    arms = ["WHEN payload_text IS NULL THEN " + ("'missing_payload'" if column == 0 else "NULL")]
    arms.append("WHEN NOT ok THEN " + ("'invalid_json'" if column == 0 else "NULL"))
    for rule in _RULES:
        arms.append(f"WHEN {rule[2]} THEN " + (f"'{rule[column]}'" if rule[column] else "NULL"))
    return "CASE " + " ".join(arms) + " END"


_DECODED = f"""{_PARSED},
g AS (SELECT *, {_case(0)} AS error_code, {_case(1)} AS error_field FROM f),
decoded AS (SELECT *, CASE error_code
    WHEN 'missing_payload' THEN 'record payload is missing'
    WHEN 'invalid_json' THEN 'object metadata is not valid JSON'
    WHEN 'empty_field' THEN 'object metadata field `' || error_field || '` must not be empty'
    WHEN 'null_character' THEN 'object metadata field `' || error_field || '` contains a null character'
    WHEN 'empty_object' THEN 'object metadata field `size` must be greater than zero'
    WHEN 'object_too_large' THEN 'object metadata size ' || size || ' exceeds configured maximum 16384' END AS error_message,
  topic || '[' || partition_id || '] offset ' || record_offset AS source_location FROM g)"""

_HITS = " UNION ALL ".join(
    f"SELECT {_LOCATION}, '{code}' AS error_code, "
    + (f"'{field}'" if field else "CAST(NULL AS VARCHAR)")
    + f" AS error_field FROM f WHERE ok AND {broken}"
    for code, field, broken in _RULES
)

# -- epochs -------------------------------------------------------------------

_INTERVALS = """
numbered AS (SELECT *,
  CAST(sum(CASE WHEN event = 'assigned' THEN 1 ELSE 0 END) OVER (ORDER BY seq, list_pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS epoch,
  lead(seq) OVER w AS to_seq, lead(event) OVER w AS closed_by
  FROM rebalance_log WHERE event <> 'error' WINDOW w AS (PARTITION BY topic, partition_id ORDER BY seq, list_pos)),
iv AS (SELECT topic, partition_id, epoch, seq AS from_seq, to_seq, closed_by FROM numbered WHERE event = 'assigned')"""


def _stamped(intervals: str) -> str:
    return f"""
stamped AS (SELECT r.topic, r.partition_id, r.record_offset, r.seq, e.epoch FROM records r
  LEFT JOIN {intervals} e ON r.topic = e.topic AND r.partition_id = e.partition_id
   AND r.seq >= e.from_seq AND (e.to_seq IS NULL OR r.seq < e.to_seq))"""


_FENCED = """
fenced AS (SELECT c.topic, c.partition_id, c.epoch, c.record_offset, c.seq, c.outcome, c.reason,
  coalesce(c.seq >= e.from_seq AND (e.to_seq IS NULL OR c.seq < e.to_seq), false) AS is_current
  FROM completions c LEFT JOIN fx_epochs e ON c.topic = e.topic AND c.partition_id = e.partition_id AND c.epoch = e.epoch)"""

# -- acks ---------------------------------------------------------------------

_SAFE = f"""
ok AS (SELECT {_TOKEN}, max(seq) AS s FROM completions WHERE outcome = 'succeeded' GROUP BY ALL),
st AS (SELECT d.topic, d.partition_id, d.epoch, d.record_offset, d.accounted_bytes, coalesce(ok.s > d.seq, false) AS done
  FROM deliveries d LEFT JOIN ok USING ({_TOKEN})),
cur AS (SELECT topic, partition_id, CAST(epoch AS BIGINT) AS epoch FROM fx_epochs WHERE to_seq IS NULL),
gap AS (SELECT {_PROGRESS}, min(CASE WHEN NOT done THEN record_offset END) AS g FROM st GROUP BY ALL),
safe AS (SELECT {_PROGRESS}, max(record_offset) + 1 AS safe_next_offset FROM st JOIN gap USING ({_PROGRESS})
  WHERE g IS NULL OR record_offset < g GROUP BY ALL),
live_safe AS (SELECT safe.* FROM safe SEMI JOIN cur USING ({_PROGRESS}))"""


def _positions(deliveries: str) -> str:
    return f"""{_FENCED},
live AS (SELECT * FROM fenced WHERE is_current AND outcome = 'succeeded'),
first_after AS (SELECT d.topic, d.partition_id, d.epoch, d.record_offset, d.seq, min(l.seq) AS c
  FROM {deliveries} d LEFT JOIN live l ON d.topic = l.topic AND d.partition_id = l.partition_id AND d.epoch = l.epoch
   AND d.record_offset = l.record_offset AND l.seq > d.seq GROUP BY ALL),
reach AS (SELECT *, max(coalesce(c, 9223372036854775807)) OVER (PARTITION BY {_PROGRESS} ORDER BY record_offset) AS r FROM first_after),
pos AS (SELECT *, CASE WHEN r < 9223372036854775807 THEN r END AS popped FROM reach),
adv AS (SELECT {_PROGRESS}, popped AS seq, max(record_offset) + 1 AS safe_next_offset FROM pos
  WHERE popped IS NOT NULL GROUP BY {_PROGRESS}, popped)"""


_EFFECTS = f"""{_positions("deliveries")},
x AS (SELECT f.topic, f.partition_id, f.epoch, f.record_offset, f.seq, f.is_current, a.safe_next_offset AS safe_before
  FROM (SELECT * FROM fenced WHERE outcome = 'succeeded') f ASOF LEFT JOIN adv a
    ON f.topic = a.topic AND f.partition_id = a.partition_id AND f.epoch = a.epoch AND f.seq > a.seq),
y AS (SELECT x.*, p.c, s.safe_next_offset,
  CASE WHEN NOT x.is_current THEN 'stale' WHEN x.record_offset < x.safe_before THEN 'below_safe'
       WHEN p.record_offset IS NULL THEN 'unknown' WHEN p.c < x.seq THEN 'repeat'
       WHEN s.seq IS NOT NULL THEN 'store' ELSE 'beyond_gap' END AS what
  FROM x LEFT JOIN pos p ON x.topic = p.topic AND x.partition_id = p.partition_id AND x.epoch = p.epoch
     AND x.record_offset = p.record_offset AND p.seq < x.seq
  LEFT JOIN adv s ON x.topic = s.topic AND x.partition_id = s.partition_id AND x.epoch = s.epoch AND x.seq = s.seq)"""

_VIOLATIONS = f"""
in_force AS (SELECT b.*, e.epoch AS current_epoch FROM bad_deliveries b LEFT JOIN fx_epochs e
  ON b.topic = e.topic AND b.partition_id = e.partition_id AND b.seq >= e.from_seq AND (e.to_seq IS NULL OR b.seq < e.to_seq)),
ordered AS (SELECT *, max(CASE WHEN epoch = current_epoch THEN record_offset END)
    OVER (PARTITION BY {_PROGRESS} ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_offset FROM in_force),
accepted AS (SELECT {_TOKEN}, seq FROM ordered
  WHERE epoch = current_epoch AND (last_offset IS NULL OR record_offset > last_offset)),
{_positions("accepted").strip()},
judged AS (SELECT o.*, CASE WHEN o.current_epoch IS NULL THEN 'unassigned' WHEN o.epoch <> o.current_epoch THEN 'epoch_mismatch'
    WHEN o.last_offset IS NULL OR o.record_offset > o.last_offset THEN 'ok'
    WHEN p.seq < o.seq AND (p.popped IS NULL OR p.popped > o.seq) THEN 'duplicate' ELSE 'non_monotonic' END AS verdict
  FROM ordered o LEFT JOIN pos p ON o.topic = p.topic AND o.partition_id = p.partition_id AND o.epoch = p.epoch
   AND o.record_offset = p.record_offset)"""

_COMMITS = f"""{_positions("deliveries")},
commits AS (SELECT a.topic, a.partition_id, a.epoch, time_bucket(INTERVAL '5 seconds', c.ts) AS w, max(a.safe_next_offset) AS committed_offset
  FROM adv a JOIN (SELECT * FROM completions WHERE outcome = 'succeeded') c
    ON a.topic = c.topic AND a.partition_id = c.partition_id AND a.epoch = c.epoch AND a.seq = c.seq GROUP BY ALL)"""

# -- budgets ------------------------------------------------------------------

_OCCUPANCY = """
occ AS (SELECT *, CAST(sum(queue_delta) OVER w AS BIGINT) AS queue_used, CAST(sum(bytes_delta) OVER w AS BIGINT) AS bytes_used
  FROM budget_events WINDOW w AS (ORDER BY seq ROWS UNBOUNDED PRECEDING)),
sig AS (SELECT *, queue_used * 100 >= 4 * 80 OR bytes_used * 100 >= 5120 * 80 AS should_pause,
  queue_used * 100 <= 4 * 50 AND bytes_used * 100 <= 5120 * 50 AS should_resume,
  event = 'enqueued' AND (queue_used - queue_delta >= 4 OR bytes_used > 5120) AS blocked FROM occ),
state AS (SELECT *, coalesce(last_value(s IGNORE NULLS) OVER (ORDER BY seq ROWS UNBOUNDED PRECEDING), false) AS paused
  FROM (SELECT *, CASE WHEN should_pause OR blocked THEN true WHEN should_resume THEN false END AS s FROM sig) q),
moves AS (SELECT *, lag(paused, 1, false) OVER (ORDER BY seq) AS was_paused FROM state)"""

# -- objects ------------------------------------------------------------------


def _quoted(column: str) -> str:
    return f"""'"' || replace(replace({column}, '\\', '\\\\'), '"', '\\"') || '"'"""


def _headers(requests: str) -> str:
    return f"""
hdr AS (SELECT m.bucket, m.object_key, m.size, m.etag, l.response_etag,
  CASE WHEN l.bucket IS NULL THEN 'get_failed' WHEN content_length IS NULL THEN 'length_omitted'
       WHEN content_length < 0 THEN 'length_negative' WHEN content_length <> m.size THEN 'length_differs'
       WHEN m.etag IS NOT NULL AND response_etag IS NULL THEN 'etag_omitted'
       WHEN m.etag IS NOT NULL AND response_etag <> m.etag THEN 'etag_differs' ELSE 'ok' END AS hv,
  CASE WHEN l.bucket IS NULL THEN NULL WHEN content_length IS NULL THEN 'S3 response omitted Content-Length'
       WHEN content_length < 0 THEN 'S3 response contained a negative Content-Length'
       WHEN content_length <> m.size THEN 'S3 Content-Length ' || content_length || ' does not match metadata size ' || m.size
       WHEN m.etag IS NOT NULL AND response_etag IS NULL THEN 'S3 response omitted ETag'
       WHEN m.etag IS NOT NULL AND response_etag <> m.etag
         THEN 'S3 ETag ' || {_quoted("response_etag")} || ' does not match metadata ETag ' || {_quoted("m.etag")} END AS hm
  FROM {requests} m LEFT JOIN listing l ON m.bucket = l.bucket AND m.object_key = l.object_key)"""


def _transfers(requests: str) -> str:
    return f"""{_headers(requests)},
sizes AS (SELECT DISTINCT bucket, object_key, size FROM {requests}),
t AS (SELECT c.*, m.size,
  CAST(sum(CASE WHEN kind = 'chunk' THEN n_bytes ELSE 0 END) OVER w AS BIGINT) AS received,
  arrived_ms - coalesce(lag(consumed_ms) OVER w, 0) AS waited_ms
  FROM chunks c JOIN sizes m ON c.bucket = m.bucket AND c.object_key = m.object_key WHERE kind = 'end' OR n_bytes > 0
  WINDOW w AS (PARTITION BY c.bucket, c.object_key, m.size ORDER BY chunk_index))"""


def _bodies(stall: str) -> str:
    return f"""
failing AS (SELECT *, CASE WHEN {stall} THEN 'stalled' WHEN kind = 'chunk' AND received > size THEN 'exceeded'
    WHEN kind = 'end' AND received <> size THEN 'truncated' WHEN kind = 'chunk' AND consumer_error IS NOT NULL THEN 'consumer_error' END AS bv
  FROM t),
worded AS (SELECT *, CASE WHEN kind = 'chunk' THEN received - n_bytes ELSE received END AS before_failure, CASE bv
    WHEN 'stalled' THEN 'S3 body made no progress for 20s'
    WHEN 'exceeded' THEN 'S3 body exceeded metadata size ' || size || ' after receiving ' || received || ' bytes'
    WHEN 'truncated' THEN 'S3 body size ' || received || ' does not match metadata size ' || size
    WHEN 'consumer_error' THEN 'object chunk consumer failed: ' || consumer_error END AS bm FROM failing),
body AS (SELECT bucket, object_key, size,
  coalesce(arg_min(bv, chunk_index) FILTER (bv IS NOT NULL), 'ok') AS bv,
  coalesce(arg_min(before_failure, chunk_index) FILTER (bv IS NOT NULL), max(received)) AS streamed_bytes,
  arg_min(bm, chunk_index) FILTER (bv IS NOT NULL) AS bm
  FROM worded GROUP BY bucket, object_key, size)"""


_VERDICT = """
verdicts AS (SELECT h.bucket, h.object_key, h.size, h.etag, h.response_etag,
  CASE WHEN hv <> 'ok' THEN hv ELSE coalesce(bv, 'incomplete') END AS verdict,
  CASE WHEN hv = 'get_failed' THEN 'get' WHEN hv <> 'ok' THEN 'headers' WHEN coalesce(bv, 'incomplete') <> 'ok' THEN 'body' END AS stage,
  CASE WHEN hv = 'get_failed' THEN 'S3 GetObject failed for s3://' || h.bucket || '/' || h.object_key
       WHEN hv <> 'ok' THEN 'S3 response validation failed for s3://' || h.bucket || '/' || h.object_key || ': ' || hm
       WHEN bv IS NULL THEN 'S3 body streaming failed for s3://' || h.bucket || '/' || h.object_key
       WHEN bv <> 'ok' THEN 'S3 body streaming failed for s3://' || h.bucket || '/' || h.object_key || ': ' || bm END AS message
  FROM hdr h LEFT JOIN body b ON h.bucket = b.bucket AND h.object_key = b.object_key AND h.size = b.size)"""

# What the faulty store of the download queries holds, from the documents themselves.
_STORED = """
stored AS (SELECT doc_id, source AS bucket, lang || '/' || doc_id || '.txt' AS object_key, md5(text) AS content_md5,
  strlen(text) + CASE WHEN doc_id % 13 = 0 THEN -1 WHEN doc_id % 11 = 0 THEN 1 ELSE 0 END AS n_stored,
  CASE WHEN doc_id % 19 = 0 THEN NULL WHEN doc_id % 17 = 0 THEN '"stale"' ELSE '"' || md5(text) || '"' END AS stored_etag
  FROM documents WHERE doc_id % 41 <> 0)"""
_GAVE_UP = "doc_id % 47 = 0 AND least(1024, n_stored) <= size AND n_stored > 0"
_DOWNLOADED = f"""{_headers('object_meta')},{_STORED},
moved AS (SELECT h.*, content_md5, CASE WHEN hv <> 'ok' THEN hv WHEN doc_id IS NULL THEN 'get_failed' WHEN {_GAVE_UP} THEN 'consumer_error'
    WHEN n_stored > size THEN 'exceeded' WHEN n_stored < size THEN 'truncated' ELSE 'ok' END AS verdict, n_stored
  FROM hdr h LEFT JOIN stored s ON h.bucket = s.bucket AND h.object_key = s.object_key)"""
_FETCHED = f"""{_DECODED},{_STORED},
moved AS (SELECT d.*, CASE WHEN error_code IS NOT NULL THEN error_code WHEN doc_id IS NULL THEN 'get_failed' WHEN n_stored <> size THEN 'length_differs'
    WHEN etag IS NOT NULL AND stored_etag IS NULL THEN 'etag_omitted' WHEN etag <> stored_etag THEN 'etag_differs'
    WHEN {_GAVE_UP} THEN 'consumer_error' ELSE 'ok' END AS verdict, n_stored, stored_etag
  FROM decoded d LEFT JOIN (SELECT * EXCLUDE (bucket, object_key), bucket AS b, object_key AS k FROM stored) s ON d.bucket = b AND d.object_key = k)"""

_FULL = f"{_transfers('object_meta')},{_bodies('waited_ms > 20000')},{_VERDICT}"
_WANTED = """
wanted AS (SELECT DISTINCT bucket, object_key, size, etag FROM decoded WHERE error_code IS NULL)"""


def _q(views: list[str], ctes: str, select: str) -> str:
    return with_views(views, f"WITH {ctes.strip()}\n{select}" if ctes else select)


_ACKS = ["deliveries", "completions", "fx_epochs"]
_TRANSFER = ["object_meta", "listing", "chunks"]
_SAFE_ROWS = f"SELECT {_PROGRESS}, safe_next_offset FROM live_safe"

_ASSIGNED_ROWS = _q(
    ["rebalance_log", "records"],
    f"{_INTERVALS},{_stamped('iv')}",
    f"SELECT {_LOCATION}, seq, epoch FROM stamped WHERE epoch IS NOT NULL",
)
_COMMIT_ROWS = _q(
    _ACKS,
    _COMMITS,
    f"SELECT {_PROGRESS}, strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start, committed_offset FROM commits",
)
_IN_FLIGHT_ROWS = _q(
    _ACKS,
    _SAFE,
    f"""SELECT {_PROGRESS}, count(*) AS n_records, CAST(sum(accounted_bytes) AS BIGINT) AS n_bytes, min(record_offset) AS first_offset
FROM st SEMI JOIN cur USING ({_PROGRESS}) WHERE NOT done GROUP BY {_PROGRESS}""",
)
_CHUNK_ROWS = _q(
    ["object_meta"],
    "n AS (SELECT *, CAST(ceil(size / 1024.0) AS BIGINT) AS k FROM object_meta)",
    """SELECT 'chunk' AS kind, bucket, object_key, CAST(i AS INTEGER) AS chunk_index, least(1024, size - 1024 * i) AS n_bytes
FROM (SELECT *, unnest(range(k)) AS i FROM n) u
UNION ALL SELECT 'end', bucket, object_key, CAST(k AS INTEGER), 0 FROM n""",
)

ORACLES: dict[str, str] = {
    "safe_prefix": _q(_ACKS, _SAFE, _SAFE_ROWS),
    "read_record_log": _q(["records"], "", _RECORD_TEXT),
    "object_chunks": _CHUNK_ROWS,
    "fetch_small_objects": _q(
        ["object_meta"],
        "",
        """SELECT m.bucket, m.object_key, m.size, CASE WHEN m.size <= 4096 THEN md5(d.text) END AS content_md5,
  CASE WHEN m.size > 4096 THEN 'announced size ' || m.size || ' is over the limit of 4096 bytes' END AS read_error
FROM object_meta m JOIN documents d ON m.doc_id = d.doc_id""",
    ),
    "record_envelope": _q(["records"], "", _RECORD_TEXT),
    "accounted_bytes": _q(["records"], _SIZED, f"SELECT {_LOCATION}, accounted_bytes FROM sized"),
    "record_location": _q(["records"], _SIZED, f"SELECT {_LOCATION}, location FROM sized"),
    "decode_metadata": _q(
        ["object_records"],
        _DECODED,
        f"""SELECT {_LOCATION}, CASE WHEN error_code IS NULL THEN bucket END AS bucket,
  CASE WHEN error_code IS NULL THEN object_key END AS object_key, CASE WHEN error_code IS NULL THEN size END AS size,
  CASE WHEN error_code IS NULL THEN etag END AS etag,
  CASE WHEN error_code IS NULL THEN 's3://' || bucket || '/' || object_key END AS location, error_code, error_field FROM decoded""",
    ),
    "metadata_rule_hits": _q(["object_records"], _PARSED, _HITS),
    "reject_messages": _q(
        ["object_records"],
        _DECODED,
        f"""SELECT {_LOCATION}, 'metadata decode failed for ' || source_location || ': ' || error_message AS failure
FROM decoded WHERE error_code IS NOT NULL""",
    ),
    "reject_table": _q(
        ["object_records"],
        _DECODED,
        f"""SELECT {_LOCATION}, payload_text, CASE WHEN error_code IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
  error_code, error_message FROM decoded""",
    ),
    "payload_guard": _q(
        ["records"], _GUARDED, f"SELECT {_LOCATION}, payload_bytes, accounted_bytes, violation, message FROM guarded"
    ),
    "fail_closed_first_violation": _q(
        ["records"],
        _GUARDED,
        f"SELECT {_LOCATION}, seq, violation, message FROM guarded WHERE violation IS NOT NULL ORDER BY seq LIMIT 1",
    ),
    "assignment_epochs": _q(
        ["rebalance_log"],
        _INTERVALS,
        f"SELECT seq, list_pos, {_TP}, epoch FROM numbered WHERE event = 'assigned'",
    ),
    "effective_revokes": _q(
        ["rebalance_log"],
        _INTERVALS,
        f"SELECT to_seq AS seq, {_TP}, epoch FROM iv WHERE closed_by = 'revoked'",
    ),
    "epoch_intervals": _q(
        ["rebalance_log"], _INTERVALS, f"SELECT {_PROGRESS}, from_seq, to_seq, closed_by FROM iv"
    ),
    "current_assignments": _q(["rebalance_log"], _INTERVALS, f"SELECT {_PROGRESS} FROM iv WHERE to_seq IS NULL"),
    "records_with_epoch": _ASSIGNED_ROWS,
    "records_with_epoch_by_join": _q(
        ["fx_epochs", "records"],
        _stamped("fx_epochs"),
        f"SELECT {_LOCATION}, seq, CAST(epoch AS BIGINT) AS epoch FROM stamped WHERE epoch IS NOT NULL",
    ),
    "unassigned_records": _q(
        ["rebalance_log", "records"],
        f"{_INTERVALS},{_stamped('iv')}",
        f"SELECT {_LOCATION}, seq FROM stamped WHERE epoch IS NULL",
    ),
    "fenced_events": _q(
        ["completions", "fx_epochs"], _FENCED, f"SELECT {_TOKEN}, seq, outcome, is_current FROM fenced"
    ),
    "live_events": _q(
        ["completions", "fx_epochs"],
        "",
        f"""SELECT {_TOKEN}, seq, outcome FROM completions
SEMI JOIN (SELECT topic, partition_id, epoch FROM fx_epochs WHERE to_seq IS NULL) c USING ({_PROGRESS})""",
    ),
    "rebalance_errors": _q(
        ["rebalance_log"],
        "",
        "SELECT seq, message, 'Kafka rebalance failed: ' || message AS failure FROM rebalance_log WHERE event = 'error'",
    ),
    "rebalance_counts": _q(
        ["rebalance_log"],
        _INTERVALS,
        """SELECT r.seq, r.event, count(*) AS n_listed,
  count(CASE WHEN r.event = 'assigned' OR i.epoch IS NOT NULL THEN 1 END) AS n_effective
FROM rebalance_log r LEFT JOIN iv i ON r.event = 'revoked' AND i.closed_by = 'revoked' AND i.to_seq = r.seq
 AND i.topic = r.topic AND i.partition_id = r.partition_id
WHERE r.event <> 'error' GROUP BY r.seq, r.event""",
    ),
    "delivery_violations": _q(
        ["bad_deliveries", "completions", "fx_epochs"],
        _VIOLATIONS,
        f"""SELECT {_TOKEN}, seq, verdict, CASE verdict
  WHEN 'unassigned' THEN 'delivery references unassigned partition ' || topic || '[' || partition_id || ']'
  WHEN 'epoch_mismatch' THEN 'delivery epoch ' || epoch || ' does not match assignment epoch ' || CAST(current_epoch AS BIGINT) || ' for ' || topic || '[' || partition_id || ']'
  WHEN 'duplicate' THEN 'duplicate in-flight delivery for ' || topic || '[' || partition_id || '] at offset ' || record_offset
  WHEN 'non_monotonic' THEN 'non-monotonic delivery for ' || topic || '[' || partition_id || ']: offset ' || record_offset || ' followed ' || last_offset
  END AS message FROM judged""",
    ),
    "first_success": _q(
        ["completions"],
        "",
        f"SELECT {_TOKEN}, min(seq) AS first_seq FROM completions WHERE outcome = 'succeeded' GROUP BY {_TOKEN}",
    ),
    "final_snapshot": _q(_ACKS, _SAFE, _SAFE_ROWS + f" ORDER BY {_TP}"),
    "prefix_advances": _q(
        _ACKS, _positions("deliveries"), f"SELECT {_PROGRESS}, seq, safe_next_offset FROM adv"
    ),
    "completion_effects": _q(
        _ACKS,
        _EFFECTS,
        f"""SELECT {_TOKEN}, seq,
  CASE what WHEN 'stale' THEN 'stale' WHEN 'unknown' THEN 'unknown_delivery' WHEN 'store' THEN 'store_next' ELSE 'unchanged' END AS effect,
  CASE WHEN what IN ('below_safe', 'repeat', 'beyond_gap') THEN what END AS cause,
  CASE WHEN what = 'store' THEN safe_next_offset END AS safe_next_offset,
  CASE WHEN what = 'unknown' THEN 'completion references unknown delivery for ' || topic || '[' || partition_id || '] at offset ' || record_offset END AS message
FROM y""",
    ),
    "failed_completions": _q(
        ["completions", "fx_epochs"],
        _FENCED,
        f"""SELECT {_TOKEN}, seq, reason, NOT is_current AS is_stale,
  'downstream processing failed for ' || topic || '[' || partition_id || '] offset ' || record_offset || ': ' || reason AS message
FROM fenced WHERE outcome = 'failed'""",
    ),
    "stream_safe_prefix": _q(_ACKS, _SAFE, _SAFE_ROWS),
    "stream_first_success": _q(
        _ACKS,
        _positions("deliveries"),
        f"SELECT {_TOKEN}, c AS first_seq FROM first_after WHERE c IS NOT NULL",
    ),
    "stream_records_with_epoch": _ASSIGNED_ROWS,
    "record_states": _q(
        _ACKS,
        f"{_SAFE},{_COMMITS}",
        f"""SELECT st.topic, st.partition_id, st.epoch, st.record_offset,
  CASE WHEN record_offset < k.committed_offset THEN 'COMMITTED' WHEN record_offset < s.safe_next_offset THEN 'STORED'
       WHEN done THEN 'COMPLETED' ELSE 'DELIVERED' END AS state
FROM st SEMI JOIN cur USING ({_PROGRESS})
LEFT JOIN safe s USING ({_PROGRESS})
LEFT JOIN (SELECT {_PROGRESS}, max(committed_offset) AS committed_offset FROM commits GROUP BY ALL) k USING ({_PROGRESS})""",
    ),
    "replay_set": _q(
        ["log_records", *_ACKS],
        f"""{_COMMITS},
passed AS (SELECT * FROM commits WHERE w + INTERVAL '5 seconds' <= (SELECT max(ts) FROM log_records)),
latest AS (SELECT topic, partition_id, max(epoch) AS epoch FROM passed GROUP BY ALL),
at_ AS (SELECT topic, partition_id, max(committed_offset) AS committed_offset FROM passed SEMI JOIN latest USING ({_PROGRESS}) GROUP BY ALL)""",
        f"""SELECT r.topic, r.partition_id, r.record_offset, s.committed_offset, d.record_offset IS NOT NULL AS replayed_success
FROM log_records r LEFT JOIN at_ s ON r.topic = s.topic AND r.partition_id = s.partition_id
LEFT JOIN (SELECT DISTINCT {_LOCATION} FROM completions WHERE outcome = 'succeeded') d
  ON r.topic = d.topic AND r.partition_id = d.partition_id AND r.record_offset = d.record_offset
WHERE s.committed_offset IS NULL OR r.record_offset >= s.committed_offset""",
    ),
    "committed_by_interval": _COMMIT_ROWS,
    "in_flight": _IN_FLIGHT_ROWS,
    "safe_prefix_in_steps": _q(_ACKS, _SAFE, _SAFE_ROWS),
    "in_flight_in_steps": _IN_FLIGHT_ROWS,
    "stream_commits": _COMMIT_ROWS,
    "budget_occupancy": _q(
        ["budget_events"], _OCCUPANCY, "SELECT seq, event, queue_used, bytes_used FROM occ"
    ),
    "watermark_signals": _q(["budget_events"], _OCCUPANCY, "SELECT seq, should_pause, should_resume FROM sig"),
    "admission_blocked": _q(
        ["budget_events"], _OCCUPANCY, "SELECT seq, record_offset, queue_used, bytes_used FROM sig WHERE blocked"
    ),
    "paused_state": _q(["budget_events"], _OCCUPANCY, "SELECT seq, blocked, paused FROM state"),
    "pause_transitions": _q(
        ["budget_events"],
        _OCCUPANCY,
        """SELECT seq, CASE WHEN paused THEN 'pause' ELSE 'resume' END AS action, queue_used, bytes_used
FROM moves WHERE paused <> was_paused""",
    ),
    "peak_concurrency": _q(
        ["work_spans"],
        """edges AS (SELECT start_tick AS tick, 1 AS delta FROM work_spans UNION ALL SELECT end_tick, -1 FROM work_spans)""",
        "SELECT CAST(max(n) AS BIGINT) AS peak FROM (SELECT sum(delta) OVER (ORDER BY tick, delta ROWS UNBOUNDED PRECEDING) AS n FROM edges) q",
    ),
    "verify_headers": _q(
        _TRANSFER,
        _transfers("object_meta"),
        "SELECT bucket, object_key, size, etag AS if_match, hv AS verdict, hm AS message FROM hdr",
    ),
    "verify_body": _q(
        _TRANSFER,
        f"{_transfers('object_meta')},{_bodies('false')}",
        "SELECT bucket, object_key, bv AS verdict, streamed_bytes, bm AS message FROM body",
    ),
    "stalled_bodies": _q(
        _TRANSFER,
        _transfers("object_meta"),
        "SELECT bucket, object_key, chunk_index, kind, waited_ms FROM t WHERE waited_ms > 20000",
    ),
    "object_verdict": _q(_TRANSFER, _FULL, "SELECT bucket, object_key, verdict, stage, message FROM verdicts"),
    "download_summary": _q(
        _TRANSFER,
        _FULL,
        "SELECT bucket, object_key, size, response_etag AS etag FROM verdicts WHERE verdict = 'ok'",
    ),
    "object_chunks_source": _CHUNK_ROWS,
    "download_objects": _q(
        ["object_meta", "listing"],
        _DOWNLOADED,
        """SELECT bucket, object_key, verdict,
  CASE WHEN verdict = 'get_failed' THEN 'get' WHEN hv <> 'ok' THEN 'headers' WHEN verdict <> 'ok' THEN 'body' END AS stage,
  CASE WHEN verdict = 'get_failed' THEN 'S3 GetObject failed for s3://' || bucket || '/' || object_key
       WHEN hv <> 'ok' THEN 'S3 response validation failed for s3://' || bucket || '/' || object_key || ': ' || hm
       WHEN verdict <> 'ok' THEN 'S3 body streaming failed for s3://' || bucket || '/' || object_key || ': ' || CASE verdict
         WHEN 'consumer_error' THEN 'object chunk consumer failed: the reader gave up on the first part'
         WHEN 'exceeded' THEN 'S3 body exceeded metadata size ' || size || ' after receiving ' || n_stored || ' bytes'
         ELSE 'S3 body size ' || n_stored || ' does not match metadata size ' || size END END AS message,
  CAST(CASE verdict WHEN 'ok' THEN size WHEN 'truncated' THEN n_stored WHEN 'exceeded' THEN size // 1024 * 1024 ELSE 0 END AS BIGINT) AS streamed_bytes,
  response_etag, CASE WHEN verdict = 'ok' THEN content_md5 END AS content_md5
FROM moved""",
    ),
    "download_completions": _q(
        ["object_records"],
        _FETCHED,
        f"""SELECT {_LOCATION}, CASE WHEN verdict = 'ok' THEN 'succeeded' ELSE 'failed' END AS outcome,
  CASE WHEN error_code IS NOT NULL THEN error_message
       WHEN verdict = 'get_failed' THEN 'S3 GetObject failed for s3://' || bucket || '/' || object_key
       WHEN verdict = 'consumer_error' THEN 'S3 body streaming failed for s3://' || bucket || '/' || object_key
         || ': object chunk consumer failed: the reader gave up on the first part'
       WHEN verdict <> 'ok' THEN 'S3 response validation failed for s3://' || bucket || '/' || object_key || ': ' || CASE verdict
         WHEN 'length_differs' THEN 'S3 Content-Length ' || n_stored || ' does not match metadata size ' || size
         WHEN 'etag_omitted' THEN 'S3 response omitted ETag'
         ELSE 'S3 ETag ' || {_quoted("stored_etag")} || ' does not match metadata ETag ' || {_quoted("etag")} END END AS reason
FROM moved""",
    ),
    "object_completions": _q(
        ["object_records", "listing", "chunks"],
        f"{_DECODED},{_WANTED},{_transfers('wanted')},{_bodies('waited_ms > 20000')},{_VERDICT}",
        f"""SELECT {_LOCATION},
  CASE WHEN error_code IS NULL AND v.verdict = 'ok' AND d.size % 7 <> 0 THEN 'succeeded' ELSE 'failed' END AS outcome,
  CASE WHEN error_code IS NOT NULL THEN error_message WHEN v.verdict <> 'ok' THEN v.message
       WHEN d.size % 7 = 0 THEN 'size refused for ' || d.bucket || '/' || d.object_key END AS reason
FROM decoded d LEFT JOIN verdicts v ON d.error_code IS NULL AND d.bucket = v.bucket AND d.object_key = v.object_key
 AND d.size = v.size AND d.etag IS NOT DISTINCT FROM v.etag""",
    ),
    "run_object_processor": _q(
        ["object_records"],
        _DECODED,
        f"""SELECT {_LOCATION}, CASE WHEN size % 7 = 0 THEN 'failed' ELSE 'succeeded' END AS outcome,
  CASE WHEN size % 7 = 0 THEN 'size refused for ' || bucket || '/' || object_key END AS reason
FROM decoded WHERE error_code IS NULL""",
    ),
    "discard_completions": _q(
        ["deliveries"],
        "",
        f"SELECT {_TOKEN}, seq, 'succeeded' AS outcome, CAST(NULL AS VARCHAR) AS reason FROM deliveries",
    ),
    "run_with_sink": _q(
        ["records"],
        "",
        f"SELECT {_LOCATION}, 'succeeded' AS outcome, CAST(NULL AS VARCHAR) AS reason FROM records",
    ),
    "run_with_object_processor": _q(
        ["object_records"],
        _DECODED,
        f"""SELECT {_LOCATION}, CASE WHEN error_code IS NULL AND size % 7 <> 0 THEN 'succeeded' ELSE 'failed' END AS outcome,
  CASE WHEN error_code IS NOT NULL THEN error_message
       WHEN size % 7 = 0 THEN 'size refused for ' || bucket || '/' || object_key END AS reason FROM decoded""",
    ),
    # The first run stops each partition at its first record that fails; the
    # second delivers everything from there on.
    "stream_replay": _q(
        ["records"],
        f"""stops AS (SELECT {_TP}, min(record_offset) AS stop FROM records WHERE record_offset % 1000 = 401 GROUP BY ALL),
r AS (SELECT records.topic, records.partition_id, record_offset, coalesce(record_offset >= stop, false) AS again
  FROM records LEFT JOIN stops ON records.topic = stops.topic AND records.partition_id = stops.partition_id)""",
        f"""SELECT {_LOCATION}, CASE WHEN again THEN 2 ELSE 1 END AS n_deliveries, 1 AS first_run,
  CASE WHEN again THEN 2 ELSE 1 END AS last_run, CASE WHEN again THEN 2 ELSE 1 END AS last_success FROM r""",
    ),
    "replay_unanswered": _q(
        ["records"],
        "",
        f"""SELECT {_LOCATION}, CAST(CASE WHEN record_offset IN (401, 402) THEN 1 ELSE 0 END AS BIGINT) AS n_unanswered,
  true AS succeeded FROM records""",
    ),
    "run_audit": _q(
        ["records"], "", f"SELECT {_TP}, max(record_offset) + 1 AS committed_offset FROM records GROUP BY {_TP}"
    ),
}
