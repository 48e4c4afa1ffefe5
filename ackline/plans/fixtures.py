"""Test inputs derived from the given tables, in SQL both Spark and DuckDB run.

Every view grows with the tables. ``assignment_events`` is the control log that
goes with ``deliveries``: every error event ends an epoch of topic ``events``,
while those of topic ``steady`` last for half of the log or all of it, and the
log ends while records of theirs are open. ``rebalance_log`` is a denser one for
the queries that read nothing but a control log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ackline.operators.epochs import assigned_records, epoch_intervals
from ackline.schemas import PARTITION
from ackline.session import cut, workspace

TABLES = ("events", "documents")

VIEWS: dict[str, str] = {
    "records": """
SELECT 'events' AS topic, CAST(event_id % 4 AS INT) AS partition_id, event_id AS record_offset,
       event_id * 10000 AS seq, ts,
       CASE WHEN event_id % 89 <> 0 THEN concat('u', user_id) END AS key_text,
       CASE WHEN event_id % 97 <> 0 THEN props END AS payload_text,
       event_type AS h_type, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS h_retry
FROM events""",
    "log_records": """
SELECT topic, partition_id, record_offset, seq, ts, key_text, payload_text, h_type, h_retry FROM records
UNION ALL
SELECT 'steady', partition_id, record_offset, seq + 1, ts, key_text, payload_text, h_type, h_retry FROM records""",
    "assignment_events": """
SELECT CAST(seq AS BIGINT) AS seq, event, CAST(list_pos AS INT) AS list_pos, topic,
       CAST(partition_id AS INT) AS partition_id, message
FROM (
  SELECT -5000 AS seq, 'assigned' AS event, partition_id AS list_pos, 'events' AS topic, partition_id, '' AS message
  FROM (SELECT DISTINCT event_id % 4 AS partition_id FROM events) p
  UNION ALL
  SELECT event_id * 10000 + 5000, 'revoked', 0, 'events', event_id % 4, '' FROM events WHERE event_type = 'error'
  UNION ALL
  SELECT event_id * 10000 + 5000, 'revoked', 1, 'events', 9, '' FROM events WHERE event_type = 'error'
  UNION ALL
  SELECT (event_id + 5) * 10000 + 6000, 'assigned', 0, 'events', event_id % 4, '' FROM events WHERE event_type = 'error'
  UNION ALL
  SELECT event_id * 10000 + 7000, 'error', 0, 'events', event_id % 4, concat('coordinator unreachable ', event_id)
  FROM events WHERE event_type = 'error'
  UNION ALL
  SELECT -4000, 'assigned', partition_id, 'steady', partition_id, '' FROM (SELECT DISTINCT event_id % 4 AS partition_id FROM events) p
  UNION ALL
  SELECT half * 10000 + 5500, 'revoked', 0, 'steady', 1, '' FROM (SELECT CAST(floor(max(event_id) / 2) AS BIGINT) AS half FROM events) h
  UNION ALL
  SELECT half * 10000 + 5600, 'assigned', partition_id, 'steady', partition_id, ''
  FROM (SELECT CAST(floor(max(event_id) / 2) AS BIGINT) AS half FROM events) h, (SELECT 1 AS partition_id UNION ALL SELECT 2) p) t""",
    "rebalance_log": """
SELECT seq, CASE event_type WHEN 'signup' THEN 'assigned' WHEN 'purchase' THEN 'revoked' ELSE 'error' END AS event,
       list_pos, 'events' AS topic, CAST((user_id + list_pos) % 4 AS INT) AS partition_id,
       CASE WHEN event_type = 'error' THEN concat('coordinator unreachable ', event_id) ELSE '' END AS message
FROM (
  SELECT event_id * 10000 - 3000 AS seq, event_id, user_id, event_type, 0 AS list_pos FROM events
  UNION ALL
  SELECT event_id * 10000 - 3000, event_id, user_id, event_type, 1 FROM events
  WHERE event_id % 2 = 0 AND event_type <> 'error') e
WHERE event_type IN ('signup', 'purchase', 'error')""",
    "fx_epochs": """
SELECT topic, partition_id, epoch, seq AS from_seq, to_seq FROM (
  SELECT topic, partition_id, event, seq,
         sum(CASE WHEN event = 'assigned' THEN 1 ELSE 0 END) OVER (ORDER BY seq, list_pos ROWS UNBOUNDED PRECEDING) AS epoch,
         lead(seq) OVER (PARTITION BY topic, partition_id ORDER BY seq) AS to_seq
  FROM assignment_events WHERE event <> 'error') x
WHERE event = 'assigned'""",
    "deliveries": """
SELECT r.topic, r.partition_id, CAST(e.epoch AS BIGINT) AS epoch, r.record_offset, r.seq,
       128 + coalesce(CAST(bit_length(r.key_text) / 8 AS BIGINT), 0) + coalesce(CAST(bit_length(r.payload_text) / 8 AS BIGINT), 0)
           + 10 + CAST(bit_length(r.h_type) / 8 AS BIGINT) + 5 * r.h_retry AS accounted_bytes
FROM log_records r JOIN fx_epochs e ON r.topic = e.topic AND r.partition_id = e.partition_id
 AND r.seq >= e.from_seq AND (e.to_seq IS NULL OR r.seq < e.to_seq)""",
    "bad_deliveries": """
SELECT topic, partition_id, epoch, record_offset, seq FROM deliveries
UNION ALL SELECT topic, partition_id, epoch, record_offset, seq + 7000 FROM deliveries WHERE record_offset % 251 = 250
UNION ALL SELECT topic, partition_id, epoch, record_offset, seq + 1206500 FROM deliveries WHERE record_offset % 241 = 240
UNION ALL SELECT topic, partition_id, epoch + 100, record_offset, seq + 8000 FROM deliveries WHERE record_offset % 307 = 306
UNION ALL SELECT topic, 7, epoch, record_offset, seq + 9000 FROM deliveries WHERE record_offset % 401 = 400""",
    "completions": """
SELECT d.topic, d.partition_id, d.epoch, d.record_offset,
       (d.record_offset + (d.record_offset * 7919) % 50) * 10000 + 100 + d.record_offset % 1000 AS seq, r.ts,
       CASE WHEN d.record_offset % 997 = 996 THEN 'failed' ELSE 'succeeded' END AS outcome,
       CASE WHEN d.record_offset % 997 = 996 THEN 'the store was closed' END AS reason
FROM deliveries d JOIN log_records r ON d.topic = r.topic AND d.partition_id = r.partition_id AND d.record_offset = r.record_offset
WHERE d.topic = 'events' AND d.record_offset % 501 <> 500
UNION ALL
SELECT d.topic, d.partition_id, d.epoch, d.record_offset,
       (d.record_offset + 60) * 10000 + 2000 + d.record_offset % 1000, r.ts, 'succeeded', NULL
FROM deliveries d JOIN log_records r ON d.topic = r.topic AND d.partition_id = r.partition_id AND d.record_offset = r.record_offset
WHERE d.topic = 'events' AND d.record_offset % 211 = 0
UNION ALL
SELECT d.topic, d.partition_id, d.epoch, d.record_offset + 1,
       (d.record_offset + 60) * 10000 + 3100 + d.record_offset % 1000, r.ts, 'succeeded', NULL
FROM deliveries d JOIN log_records r ON d.topic = r.topic AND d.partition_id = r.partition_id AND d.record_offset = r.record_offset
WHERE d.topic = 'events' AND d.record_offset % 701 = 699
UNION ALL
SELECT d.topic, d.partition_id, d.epoch + 500, d.record_offset,
       (d.record_offset + 60) * 10000 + 4200 + d.record_offset % 1000, r.ts, 'failed', 'late failure of another epoch'
FROM deliveries d JOIN log_records r ON d.topic = r.topic AND d.partition_id = r.partition_id AND d.record_offset = r.record_offset
WHERE d.topic = 'events' AND d.record_offset % 883 = 882
UNION ALL
SELECT d.topic, d.partition_id, d.epoch, d.record_offset, w.seq, r.ts,
       CASE WHEN d.partition_id = 0 AND d.record_offset % 997 = 996 THEN 'failed' ELSE 'succeeded' END,
       CASE WHEN d.partition_id = 0 AND d.record_offset % 997 = 996 THEN 'the store was closed' END
FROM deliveries d JOIN log_records r ON d.topic = r.topic AND d.partition_id = r.partition_id AND d.record_offset = r.record_offset
JOIN (SELECT record_offset, (record_offset + (record_offset * 7919) % 50) * 10000 + 7100 + record_offset % 1000 AS seq FROM records) w
  ON d.record_offset = w.record_offset
WHERE d.topic = 'steady' AND w.seq <= (SELECT max(seq) FROM records) AND NOT (d.partition_id = 0 AND d.record_offset % 501 = 500)""",
    "budget_events": """
SELECT seq, 'enqueued' AS event, record_offset, 1 AS queue_delta, accounted_bytes AS bytes_delta FROM deliveries WHERE topic = 'events'
UNION ALL SELECT (record_offset + (record_offset * 13) % 5) * 10000 + 4000 + record_offset % 1000, 'dequeued', record_offset, -1, 0 FROM deliveries WHERE topic = 'events'
UNION ALL SELECT (record_offset + 5 + CASE WHEN record_offset % 400 < 200 THEN (record_offset * 7919) % 50 ELSE 0 END) * 10000 + 6000 + record_offset % 1000, 'released', record_offset, 0, -accounted_bytes FROM deliveries WHERE topic = 'events'""",
    "object_records": """
SELECT 'objects' AS topic, CAST(doc_id % 8 AS INT) AS partition_id, doc_id AS record_offset, doc_id,
  CASE doc_id % 20
    WHEN 0 THEN NULL
    WHEN 1 THEN 'not-json'
    WHEN 2 THEN concat('{"bucket":"","key":"', k, '","size":', n, '}')
    WHEN 3 THEN concat('{"bucket":"  ","key":"', k, '","size":', n, '}')
    WHEN 4 THEN concat('{"bucket":"', b, '","key":"","size":', n, '}')
    WHEN 5 THEN concat('{"bucket":"', b, '","key":"', k, '","size":0}')
    WHEN 6 THEN concat('{"bucket":"', b, '","key":"', k, '","size":"', n, '"}')
    WHEN 7 THEN concat('{"key":"', k, '","size":', n, '}')
    WHEN 8 THEN concat('{"bucket":"', b, '","key":"', k, '","size":', n, ',"etag":""}')
    WHEN 9 THEN concat('{"bucket":"', b, '","key":"', k, '","size":16385}')
    WHEN 10 THEN concat('{"bucket":"', b, '","key":"', k, '","size":', n, ',"etag":null}')
    WHEN 11 THEN concat('{"bucket":"', b, '","key":"', k, '","size":', n, ',"etag":"', e, '","trace":{"id":[1,2]}}')
    WHEN 12 THEN concat('{"bucket":5,"key":"', k, '","size":', n, '}')
    WHEN 13 THEN concat('{"bucket":"', b, '","key":"', k, '","size":-1}')
    WHEN 14 THEN concat('{"bucket":"', b, '","key":"', k, chr(92), 'u0000","size":', n, '}')
    WHEN 15 THEN concat('{"bucket":"', b, '","key":"', k, '","size":1.5}')
    WHEN 16 THEN concat('{"bucket":"', b, '","key":" ","size":', n, '}')
    WHEN 17 THEN concat('{"bucket":"', b, '","key":"', k, '","size":', n, '}')
    WHEN 18 THEN concat('{"bucket":"', b, '","key":"', k, '","size":', n, '} x')
    ELSE concat('{"bucket":"', b, '","key":"', k, '","size":', n, ',"etag":"', e, '"}')
  END AS payload_text
FROM (SELECT doc_id, source AS b, concat(lang, '/', doc_id, '.txt') AS k, CAST(bit_length(text) / 8 AS BIGINT) AS n,
             concat(chr(92), '"', md5(text), chr(92), '"') AS e FROM documents) d""",
    "object_meta": """
SELECT doc_id, source AS bucket, concat(lang, '/', doc_id, '.txt') AS object_key, CAST(bit_length(text) / 8 AS BIGINT) AS size,
       CASE WHEN doc_id % 4 <> 3 THEN concat('"', md5(text), '"') END AS etag
FROM documents""",
    "listing": """
SELECT bucket, object_key,
       CASE WHEN doc_id % 37 = 0 THEN NULL WHEN doc_id % 29 = 0 THEN -1 WHEN doc_id % 23 = 0 THEN size + 1 ELSE size END AS content_length,
       CASE WHEN doc_id % 19 = 0 THEN NULL WHEN doc_id % 17 = 0 THEN '"stale"' ELSE coalesce(etag, '"unrequested"') END AS response_etag
FROM object_meta WHERE doc_id % 31 <> 0""",
    "chunks": """
WITH obj AS (SELECT *, CAST(ceil(size / 1024.0) AS BIGINT) AS n,
               CASE WHEN doc_id % 3 = 0 THEN 25000 ELSE 0 END + CASE WHEN doc_id % 41 = 0 THEN 30000 ELSE 0 END AS shift
        FROM object_meta),
sent AS (SELECT *, unnest(range(n - CASE WHEN doc_id % 13 = 0 THEN 1 ELSE 0 END)) AS i FROM obj),
body AS (
  SELECT doc_id, bucket, object_key, CAST(i * 10 AS INT) AS chunk_index, least(1024, size - 1024 * i) AS n_bytes,
         i * 100 + 10 + CASE WHEN i >= 1 THEN shift ELSE 0 END AS arrived_ms,
         CASE WHEN i = 0 AND doc_id % 3 = 0 THEN 25000 ELSE 0 END AS slow,
         CASE WHEN i = 0 AND doc_id % 47 = 0 THEN 'the reader gave up on the first part' END AS consumer_error
  FROM sent
  UNION ALL
  SELECT doc_id, bucket, object_key, CAST(n * 10 AS INT), 7, n * 100 + 10 + shift, 0, NULL FROM obj WHERE doc_id % 11 = 0
  UNION ALL
  SELECT doc_id, bucket, object_key, 5, 0, 60 + CASE WHEN doc_id % 3 = 0 THEN 25000 ELSE 0 END, 0, NULL FROM obj WHERE doc_id % 5 = 0)
SELECT 'chunk' AS kind, bucket, object_key, chunk_index, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(arrived_ms AS BIGINT) AS arrived_ms,
       CAST(arrived_ms + 20 + slow AS BIGINT) AS consumed_ms, consumer_error FROM body
UNION ALL
SELECT 'end', bucket, object_key, CAST(n * 10 + 1 AS INT), 0, CAST(n * 100 + 200 + shift + CASE WHEN doc_id % 43 = 0 THEN 30000 ELSE 0 END AS BIGINT), NULL, NULL FROM obj""",
    "work_spans": """
SELECT doc_id, doc_id * 10 AS start_tick, doc_id * 10 + 1 + (doc_id * 37) % 75 AS end_tick FROM documents""",
}

# As in the view of deliveries.
ACCOUNTED = (
    "128 + coalesce(CAST(bit_length(key_text) / 8 AS BIGINT), 0) + coalesce(CAST(bit_length(payload_text) / 8 AS BIGINT), 0)"
    " + 10 + CAST(bit_length(h_type) / 8 AS BIGINT) + 5 * h_retry"
)

DEPENDS: dict[str, list[str]] = {
    "log_records": ["records"],
    "fx_epochs": ["assignment_events"],
    "deliveries": ["log_records", "fx_epochs"],
    "bad_deliveries": ["deliveries"],
    "completions": ["deliveries", "log_records", "records"],
    "budget_events": ["deliveries"],
    "listing": ["object_meta"],
    "chunks": ["object_meta"],
}

# Spark unfolds chunk numbers instead of joining to a number table.
SPARK_VIEWS: dict[str, str] = {
    "chunks": """
WITH obj AS (SELECT *, CAST(ceil(size / 1024.0) AS BIGINT) AS n,
               CASE WHEN doc_id % 3 = 0 THEN 25000 ELSE 0 END + CASE WHEN doc_id % 41 = 0 THEN 30000 ELSE 0 END AS shift
        FROM object_meta),
sent AS (SELECT *, n - CASE WHEN doc_id % 13 = 0 THEN 1 ELSE 0 END AS n_sent FROM obj),
body AS (
  SELECT doc_id, bucket, object_key, CAST(i * 10 AS INT) AS chunk_index, least(1024, size - 1024 * i) AS n_bytes,
         i * 100 + 10 + CASE WHEN i >= 1 THEN shift ELSE 0 END AS arrived_ms,
         CASE WHEN i = 0 AND doc_id % 3 = 0 THEN 25000 ELSE 0 END AS slow,
         CASE WHEN i = 0 AND doc_id % 47 = 0 THEN 'the reader gave up on the first part' END AS consumer_error
  FROM sent LATERAL VIEW explode(CASE WHEN n_sent > 0 THEN sequence(0, n_sent - 1) END) t AS i
  UNION ALL
  SELECT doc_id, bucket, object_key, CAST(n * 10 AS INT), 7, n * 100 + 10 + shift, 0, NULL FROM obj WHERE doc_id % 11 = 0
  UNION ALL
  SELECT doc_id, bucket, object_key, 5, 0, 60 + CASE WHEN doc_id % 3 = 0 THEN 25000 ELSE 0 END, 0, NULL FROM obj WHERE doc_id % 5 = 0)
SELECT 'chunk' AS kind, bucket, object_key, chunk_index, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(arrived_ms AS BIGINT) AS arrived_ms,
       CAST(arrived_ms + 20 + slow AS BIGINT) AS consumed_ms, consumer_error FROM body
UNION ALL
SELECT 'end', bucket, object_key, CAST(n * 10 + 1 AS INT), 0, CAST(n * 100 + 200 + shift + CASE WHEN doc_id % 43 = 0 THEN 30000 ELSE 0 END AS BIGINT), NULL, NULL FROM obj""",
}


# Views with joins or heavy expressions, stored as tables at first use; the
# others are projections and unions of tables and stay lazy.
STORED = ("fx_epochs", "deliveries", "completions", "object_meta", "chunks")


class Inputs:
    """The views over one data folder.

    The logs of a real deployment are tables that several queries read, so those
    that take work to derive are evaluated once per session and folder.
    """

    # Folder and schema of what is stored, by session, working folder, data folder and name.
    _stored: dict[tuple[str | None, ...], tuple[str, StructType | None]] = {}

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._registered: set[str] = set()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in STORED:
            return self.store(name, lambda: self._view(name))
        return self._view(name)

    def store(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The stored table ``name``, made on first use."""

        def write(path: str) -> StructType:
            df = make()
            df.write.parquet(path)
            return df.schema

        path, schema = self._once(name, write)
        return self.spark.read.schema(schema).parquet(path)

    def folder(self, name: str, write: Callable[[str], None]) -> str:
        """A folder ``name`` filled by ``write`` on first use."""
        return self._once(name, write)[0]

    def _once(self, name: str, write: Callable[[str], StructType | None]) -> tuple[str, StructType | None]:
        root = self.spark.conf.get("spark.checkpoint.dir", None)
        key = (self.spark.sparkContext.applicationId, root, self.sf_dir, name)
        if key not in self._stored:
            path = workspace(self.spark, f"log-{name}")
            self._stored[key] = (path, write(path))
        return self._stored[key]

    def intervals(self, log: str) -> DataFrame:
        """The epoch intervals of an assignment log, worked out anew by every query."""
        return cut(epoch_intervals(self[log]), f"intervals-{log}")

    def _view(self, name: str) -> DataFrame:
        # By scans: in SQL one task would order the whole log, and records meet all intervals of their partition.
        if name == "fx_epochs":
            return epoch_intervals(self["assignment_events"]).drop("closed_by")
        if name == "deliveries":
            # Bytes are counted before the scan: it then moves numbers instead of texts.
            records = self["log_records"].select(*PARTITION, "record_offset", "seq", F.expr(ACCOUNTED).alias("accounted_bytes"))
            records = assigned_records(records, self.intervals("assignment_events"))
            return records.select(*PARTITION, "epoch", "record_offset", "seq", "accounted_bytes")
        for needed in DEPENDS.get(name, TABLES):
            if needed not in self._registered:
                self[needed].createOrReplaceTempView(needed)
                self._registered.add(needed)
        return self.spark.sql(SPARK_VIEWS.get(name, VIEWS[name]))


def with_views(names: list[str], query: str) -> str:
    """One statement: the needed views as common table expressions before ``query``."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in DEPENDS.get(name, []):
                add(needed)
            ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{name} AS ({VIEWS[name]}\n)" for name in ordered]
    query = query.strip()
    if query.startswith("WITH "):
        return "WITH " + ",\n".join([*parts, query.removeprefix("WITH ")])
    return "WITH " + ",\n".join(parts) + "\n" + query
