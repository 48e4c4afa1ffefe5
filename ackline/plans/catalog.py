"""Named queries over a data folder, one per operator."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ackline.functions.metadata import decode_metadata, metadata_rule_hits
from ackline.operators import acks, budget, downloads, epochs, objects, processing, records, snapshots
from ackline.plans.fixtures import Inputs
from ackline.schemas import OBJECT, PARTITION, PROGRESS, TOKEN
from ackline.session import ROCKSDB, STATE_STORE, cut, workspace
from ackline.sources import objects as stores
from ackline.sources.chunk_source import load_object_chunks
from ackline.sources.record_log import in_order, read_record_log, stream_record_log, write_record_log
from ackline.streaming import commits, prefix, run
from ackline.streaming import epochs as stream_epochs

# Parameters the queries are run with.
MAX_OBJECT_SIZE = 16_384
CHUNK_BYTES = 1024
IDLE_TIMEOUT_MS = 20_000
BUDGET = {"queue_total": 4, "bytes_total": 5120, "pause_high_percent": 80, "resume_low_percent": 50}
MAX_PAYLOAD_BYTES = 8
MEMORY_BUDGET_BYTES = 160
PAYLOAD_TEXT = "payload_text"
LOCATION = [*PARTITION, "record_offset"]
# Ranges a log is fed to a stream in.
STREAM_RANGES = 3
# Steps in which snapshots are carried on.
STEPS = 2


def _time_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


# -- inputs in the library's schemas ------------------------------------------


def _messages(inputs: Inputs) -> DataFrame:
    """The records as a Kafka source would deliver them."""
    event_type = F.struct(
        F.lit("event_type").alias("key"), F.col("h_type").cast("binary").alias("value")
    )
    retry = F.struct(F.lit("retry").alias("key"), F.lit(None).cast("binary").alias("value"))
    return inputs["records"].select(
        "topic",
        F.col("partition_id").alias("partition"),
        F.col("record_offset").alias("offset"),
        F.col("key_text").cast("binary").alias("key"),
        F.col("payload_text").cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(F.col("h_retry") == 1, F.array(event_type, retry)).otherwise(F.array(event_type)).alias("headers"),
        "seq",
    )


def _records(inputs: Inputs) -> DataFrame:
    return records.record_envelope(_messages(inputs))


def _record_text(df: DataFrame) -> DataFrame:
    headers = F.concat_ws(
        ",",
        F.transform(
            "headers",
            lambda h: F.concat(h["key"], F.lit("="), F.coalesce(h["value"].cast("string"), F.lit(""))),
        ),
    )
    return df.select(
        *LOCATION,
        "seq",
        F.col("rec_key").cast("string").alias("key_text"),
        F.col("payload").cast("string").alias("payload_text"),
        headers.alias("header_text"),
        _time_text(F.col("ts")).alias("ts_text"),
    )


def _log_of_records(inputs: Inputs) -> str:
    """A record log folder holding all records, written once."""
    return inputs.folder("records", lambda path: write_record_log(_records(inputs), path))


def _object_store(inputs: Inputs) -> str:
    """A folder holding every document as an object, written once."""
    objects_of_documents = inputs["documents"].select(
        F.col("source").alias("bucket"),
        F.concat("lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("object_key"),
        F.col("text").alias("content"),
    )
    return inputs.folder("objects", lambda path: stores.write_objects(objects_of_documents, path))


def _acks(inputs: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    return inputs["deliveries"], inputs["completions"], inputs.intervals("assignment_events")


def _positions(logs: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
    return cut(acks.prefix_positions(*logs), "prefix-positions")


def _object_records(inputs: Inputs) -> DataFrame:
    return inputs["object_records"].select(*LOCATION, PAYLOAD_TEXT)


def _object_tokens(inputs: Inputs) -> DataFrame:
    return _object_records(inputs).withColumns(
        {"epoch": F.lit(1).cast("long"), "seq": F.col("record_offset") * 10}
    )


def _guarded(inputs: Inputs) -> DataFrame:
    return records.payload_guard(
        _records(inputs), max_payload_bytes=MAX_PAYLOAD_BYTES, memory_budget_bytes=MEMORY_BUDGET_BYTES
    )


def _verdicts(inputs: Inputs) -> DataFrame:
    return objects.object_verdict(
        inputs["object_meta"], inputs["listing"], inputs["chunks"], idle_timeout_ms=IDLE_TIMEOUT_MS
    )


def reject_by_size(metadata: processing.ObjectMetadata) -> None:
    """Sample processor: fails objects whose size is a multiple of 7."""
    if metadata.size % 7 == 0:
        raise ValueError(f"size refused for {metadata.bucket}/{metadata.key}")


def _faulty_store(inputs: Inputs) -> stores.FolderStore:
    """The documents as objects with etags beside them: some absent, cut short, too long, or with a wrong etag or none."""
    docs = inputs["documents"].select(
        "doc_id",
        F.col("source").alias("bucket"),
        F.concat("lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("object_key"),
        F.col("text").cast("binary").alias("body"),
        F.concat(F.lit('"'), F.md5(F.col("text").cast("binary")), F.lit('"')).alias("etag"),
    ).filter("doc_id % 41 <> 0")
    shorter = F.expr("substring(body, 1, greatest(octet_length(body) - 1, 0))")
    body = F.when(F.expr("doc_id % 13 = 0"), shorter).when(F.expr("doc_id % 11 = 0"), F.concat("body", F.lit(b"x"))).otherwise(F.col("body"))
    etag = F.when(F.expr("doc_id % 17 = 0"), F.lit('"stale"')).otherwise(F.col("etag"))
    beside = docs.filter("doc_id % 19 <> 0").select(
        "bucket", F.concat("object_key", F.lit(".etag")).alias("object_key"), etag.cast("binary").alias("content")
    )
    stored = docs.select("bucket", "object_key", body.alias("content")).unionByName(beside)
    root = inputs.folder("faulty-objects", lambda path: stores.write_objects(stored, path))
    return stores.FolderStore(root, chunk_bytes=CHUNK_BYTES, etag_suffix=".etag")


class DigestBody:
    """Sample consumer: the MD5 of a body; gives up on the objects of every 47th document."""

    def __init__(self, metadata: processing.ObjectMetadata):
        self.number = int(metadata.key.rsplit("/", 1)[1].removesuffix(".txt"))
        self.digest = hashlib.md5()

    def chunk(self, data: bytes) -> None:
        if self.number % 47 == 0:
            raise ValueError("the reader gave up on the first part")
        self.digest.update(data)

    def finish(self) -> str:
        return self.digest.hexdigest()


# -- queries ------------------------------------------------------------------


def read_record_log_query(inputs: Inputs) -> DataFrame:
    return _record_text(read_record_log(inputs.spark, _log_of_records(inputs)))


def object_chunks(inputs: Inputs) -> DataFrame:
    chunks = stores.read_object_chunks(
        inputs["object_meta"], _object_store(inputs), chunk_bytes=CHUNK_BYTES, range_chunks=16
    )
    return chunks.select("kind", *OBJECT, "chunk_index", "n_bytes")


def object_chunks_source(inputs: Inputs) -> DataFrame:
    chunks = load_object_chunks(
        inputs["object_meta"], _object_store(inputs), chunk_bytes=CHUNK_BYTES, range_chunks=16, task_bytes=64 << 20
    )
    return chunks.select("kind", *OBJECT, "chunk_index", "n_bytes")


def download_objects(inputs: Inputs) -> DataFrame:
    """Verified downloads from a faulty store, with the listing's headers and a digest of every body."""
    done = downloads.download_objects(
        inputs["object_meta"], _faulty_store(inputs), DigestBody, listing=inputs["listing"], idle_timeout_ms=IDLE_TIMEOUT_MS
    )
    return done.select(
        *OBJECT, "verdict", "stage", "message", "streamed_bytes", "response_etag", F.col("result").alias("content_md5")
    )


def download_completions(inputs: Inputs) -> DataFrame:
    """From record payloads to completions through the store's own headers and bodies."""
    completed = downloads.download_completions(
        _object_tokens(inputs),
        _faulty_store(inputs),
        DigestBody,
        payload=PAYLOAD_TEXT,
        max_object_size=MAX_OBJECT_SIZE,
        idle_timeout_ms=IDLE_TIMEOUT_MS,
    )
    return completed.select(*LOCATION, "outcome", "reason")


def fetch_small_objects(inputs: Inputs) -> DataFrame:
    fetched = stores.fetch_small_objects(
        inputs["object_meta"], _object_store(inputs), max_bytes=4096
    )
    return fetched.select(*OBJECT, "size", F.md5("content").alias("content_md5"), "read_error")


def record_envelope(inputs: Inputs) -> DataFrame:
    return _record_text(_records(inputs))


def accounted_bytes(inputs: Inputs) -> DataFrame:
    return records.with_accounted_bytes(_records(inputs)).select(*LOCATION, "accounted_bytes")


def record_location(inputs: Inputs) -> DataFrame:
    return records.with_location(_records(inputs)).select(*LOCATION, "location")


def decode_metadata_query(inputs: Inputs) -> DataFrame:
    decoded = decode_metadata(_object_records(inputs), PAYLOAD_TEXT, max_object_size=MAX_OBJECT_SIZE)
    return decoded.select(
        *LOCATION, *OBJECT, F.col("size").cast("long").alias("size"), "etag", "location",
        "error_code", "error_field",
    )


def metadata_rule_hits_query(inputs: Inputs) -> DataFrame:
    hits = metadata_rule_hits(_object_records(inputs), PAYLOAD_TEXT, max_object_size=MAX_OBJECT_SIZE)
    return hits.select(*LOCATION, "error_code", "error_field")


def reject_messages(inputs: Inputs) -> DataFrame:
    _, rejected = records.split_rejects(
        _object_records(inputs), PAYLOAD_TEXT, max_object_size=MAX_OBJECT_SIZE
    )
    return rejected.select(*LOCATION, "failure")


def reject_table(inputs: Inputs) -> DataFrame:
    routed = records.route_rejects(
        _object_records(inputs), PAYLOAD_TEXT, max_object_size=MAX_OBJECT_SIZE
    )
    return routed.select(*LOCATION, PAYLOAD_TEXT, "status", "error_code", "error_message")


def payload_guard(inputs: Inputs) -> DataFrame:
    return _guarded(inputs).select(*LOCATION, "payload_bytes", "accounted_bytes", "violation", "message")


def fail_closed_first_violation(inputs: Inputs) -> DataFrame:
    rows = _guarded(inputs).select(*LOCATION, "seq", "violation", "message")
    return records.first_violation(rows)


def assignment_epochs(inputs: Inputs) -> DataFrame:
    return epochs.assignment_epochs(inputs["rebalance_log"])


def effective_revokes(inputs: Inputs) -> DataFrame:
    return epochs.effective_revokes(epochs.epoch_intervals(inputs["rebalance_log"]))


def epoch_intervals(inputs: Inputs) -> DataFrame:
    return epochs.epoch_intervals(inputs["rebalance_log"])


def current_assignments(inputs: Inputs) -> DataFrame:
    return epochs.current_assignments(epochs.epoch_intervals(inputs["rebalance_log"]))


def records_with_epoch(inputs: Inputs) -> DataFrame:
    stamped = epochs.assigned_records(
        inputs["records"].select(*LOCATION, "seq"), inputs.intervals("rebalance_log")
    )
    return stamped.select(*LOCATION, "seq", "epoch")


def records_with_epoch_by_join(inputs: Inputs) -> DataFrame:
    stamped = epochs.assigned_records(
        inputs["records"].select(*LOCATION, "seq"), inputs.intervals("assignment_events"), method="join"
    )
    return stamped.select(*LOCATION, "seq", "epoch")


def unassigned_records(inputs: Inputs) -> DataFrame:
    return epochs.unassigned_records(
        inputs["records"].select(*LOCATION, "seq"), inputs.intervals("rebalance_log")
    )


def fenced_events(inputs: Inputs) -> DataFrame:
    completions = inputs["completions"].select(*TOKEN, "seq", "outcome")
    return epochs.fence(completions, inputs.intervals("assignment_events"))


def live_events(inputs: Inputs) -> DataFrame:
    completions = inputs["completions"].select(*TOKEN, "seq", "outcome")
    return epochs.live_events(completions, inputs.intervals("assignment_events"))


def rebalance_errors(inputs: Inputs) -> DataFrame:
    return epochs.rebalance_errors(inputs["rebalance_log"])


def rebalance_counts(inputs: Inputs) -> DataFrame:
    return epochs.rebalance_counts(inputs["rebalance_log"], inputs.intervals("rebalance_log"))


def delivery_violations(inputs: Inputs) -> DataFrame:
    _, completions, intervals = _acks(inputs)
    return acks.delivery_violations(inputs["bad_deliveries"], completions, intervals)


def first_success(inputs: Inputs) -> DataFrame:
    return acks.first_success(inputs["completions"])


def safe_prefix(inputs: Inputs) -> DataFrame:
    return acks.safe_prefix(*_acks(inputs))


def final_snapshot(inputs: Inputs) -> DataFrame:
    return acks.final_snapshot(*_acks(inputs))


def prefix_advances(inputs: Inputs) -> DataFrame:
    return acks.prefix_advances(*_acks(inputs))


def completion_effects(inputs: Inputs) -> DataFrame:
    return acks.completion_effects(*_acks(inputs))


def failed_completions(inputs: Inputs) -> DataFrame:
    _, completions, intervals = _acks(inputs)
    return acks.failed_completions(completions, intervals)


def record_states(inputs: Inputs) -> DataFrame:
    logs = _acks(inputs)
    by_interval = acks.committed_by_interval(*logs, positions=_positions(logs))
    committed = by_interval.groupBy(*PROGRESS).agg(F.max("committed_offset").alias("committed_offset"))
    return acks.record_states(*logs, committed)


def replay_set(inputs: Inputs) -> DataFrame:
    """What a restart at the end of the log reads again: the last interval that has passed is committed."""
    logs = _acks(inputs)
    log = inputs["log_records"]
    by_interval = acks.committed_by_interval(*logs, positions=_positions(logs))
    passed = by_interval.join(F.broadcast(log.agg(F.max("ts").alias("now"))), F.col("window_end") <= F.col("now"))
    committed = acks.last_committed(passed)
    return acks.replay_set(log.select(*LOCATION, "seq"), committed, logs[1], auto_offset_reset="earliest").select(
        *LOCATION, "committed_offset", "replayed_success"
    )


def committed_by_interval(inputs: Inputs) -> DataFrame:
    logs = _acks(inputs)
    return acks.committed_by_interval(*logs, positions=_positions(logs)).select(
        *PROGRESS, _time_text(F.col("window_start")).alias("window_start"), "committed_offset"
    )


def _in_steps(inputs: Inputs) -> tuple[snapshots.Snapshot, DataFrame]:
    """The last snapshot of logs taken in range by range of ``seq``, and the epoch intervals."""
    deliveries, completions, intervals = _acks(inputs)
    root = workspace(inputs.spark, "snapshots")
    log = cut(commits.ack_log(deliveries, completions), "ack-log")
    step = snapshots.empty(inputs.spark)
    for number, part in enumerate(in_order(log, STEPS)):
        new = part.filter("kind = 'delivered'").select(*TOKEN, "seq", "accounted_bytes")
        done = part.filter("kind = 'completed'").select(*TOKEN, "seq", "ts", "outcome")
        step = snapshots.advance(step, new, done, intervals, f"{root}/{number}")
    return step, intervals


def safe_prefix_in_steps(inputs: Inputs) -> DataFrame:
    return snapshots.safe_prefix(*_in_steps(inputs))


def in_flight_in_steps(inputs: Inputs) -> DataFrame:
    return snapshots.in_flight(*_in_steps(inputs))


def stream_commits(inputs: Inputs) -> DataFrame:
    """Offsets committed by interval while a stream of the ack log goes on."""
    spark = inputs.spark
    deliveries, completions, intervals = _acks(inputs)
    root = workspace(spark, "commit-stream")
    log = cut(commits.ack_log(deliveries, completions), "ack-log")
    for part in in_order(log, STREAM_RANGES):
        part.write.mode("append").parquet(f"{root}/log")
        commits.stream_commits(stream_record_log(spark, f"{root}/log", log.schema), lambda: intervals, root).awaitTermination()
    return commits.committed(spark, root).select(
        *PROGRESS, _time_text(F.col("window_start")).alias("window_start"), "committed_offset"
    )


def in_flight(inputs: Inputs) -> DataFrame:
    return acks.in_flight(*_acks(inputs))


def budget_occupancy(inputs: Inputs) -> DataFrame:
    return budget.budget_occupancy(inputs["budget_events"]).select("seq", "event", "queue_used", "bytes_used")


def watermark_signals(inputs: Inputs) -> DataFrame:
    signals = budget.watermark_signals(budget.budget_occupancy(inputs["budget_events"]), **BUDGET)
    return signals.select("seq", "should_pause", "should_resume")


def admission_blocked(inputs: Inputs) -> DataFrame:
    judged = budget.admission_blocked(
        budget.budget_occupancy(inputs["budget_events"]),
        queue_total=BUDGET["queue_total"],
        bytes_total=BUDGET["bytes_total"],
    )
    return judged.filter("blocked").select("seq", "record_offset", "queue_used", "bytes_used")


def paused_state(inputs: Inputs) -> DataFrame:
    return budget.paused_state(inputs["budget_events"], **BUDGET).select("seq", "blocked", "paused")


def pause_transitions(inputs: Inputs) -> DataFrame:
    return budget.pause_transitions(inputs["budget_events"], **BUDGET)


def peak_concurrency(inputs: Inputs) -> DataFrame:
    return budget.peak_concurrency(inputs["work_spans"])


def verify_headers(inputs: Inputs) -> DataFrame:
    judged = objects.verify_headers(objects.distinct_requests(inputs["object_meta"]), inputs["listing"])
    return judged.select(*OBJECT, "size", "if_match", "verdict", "message")


def verify_body(inputs: Inputs) -> DataFrame:
    judged = objects.verify_body(objects.distinct_requests(inputs["object_meta"]), inputs["chunks"])
    return judged.select(*OBJECT, "verdict", "streamed_bytes", "message")


def stalled_bodies(inputs: Inputs) -> DataFrame:
    return objects.stalled_bodies(
        objects.distinct_requests(inputs["object_meta"]), inputs["chunks"], idle_timeout_ms=IDLE_TIMEOUT_MS
    )


def object_verdict(inputs: Inputs) -> DataFrame:
    return _verdicts(inputs).select(*OBJECT, "verdict", "stage", "message")


def download_summary(inputs: Inputs) -> DataFrame:
    return objects.download_summary(_verdicts(inputs))


def object_completions(inputs: Inputs) -> DataFrame:
    completed = objects.object_completions(
        _object_tokens(inputs),
        inputs["listing"],
        inputs["chunks"],
        payload=PAYLOAD_TEXT,
        processor=reject_by_size,
        max_object_size=MAX_OBJECT_SIZE,
        idle_timeout_ms=IDLE_TIMEOUT_MS,
    )
    return completed.select(*LOCATION, "outcome", "reason")


def run_object_processor(inputs: Inputs) -> DataFrame:
    accepted, _ = records.split_rejects(
        _object_records(inputs), PAYLOAD_TEXT, max_object_size=MAX_OBJECT_SIZE
    )
    processed = processing.run_object_processor(
        accepted.select(*LOCATION, *OBJECT, "size", "etag"), reject_by_size
    )
    return processed.select(*LOCATION, "outcome", "reason")


def discard_completions(inputs: Inputs) -> DataFrame:
    return records.discard(inputs["deliveries"])


def _run_stream(
    inputs: Inputs, purpose: str, log: DataFrame, transform: Callable[[DataFrame], DataFrame], mode: str
) -> DataFrame:
    """Append ``log`` range by range and run a stateful stream, restarted each time, over it; what it put out."""
    spark = inputs.spark
    root = workspace(spark, purpose)
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        for part in in_order(log, STREAM_RANGES):
            part.write.mode("append").parquet(f"{root}/log")
            query = (
                transform(stream_record_log(spark, f"{root}/log", log.schema))
                .writeStream.outputMode(mode)
                .foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{root}/out/batch={n}"))
                .option("checkpointLocation", f"{root}/checkpoint")
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)
    return spark.read.parquet(f"{root}/out")


def _prefix_stream(inputs: Inputs) -> DataFrame:
    """Updates of the prefix stream over deliveries, completions and assignments."""
    return _run_stream(inputs, "prefix-stream", prefix.ack_events(*_acks(inputs)), prefix.stream_prefix, "update")


def stream_safe_prefix(inputs: Inputs) -> DataFrame:
    """Safe offsets of the epochs in force, from the block states a stream put out."""
    blocks = prefix.latest_blocks(_prefix_stream(inputs))
    return acks.live_prefix(acks.merge_blocks(blocks), inputs.intervals("assignment_events"))


def stream_first_success(inputs: Inputs) -> DataFrame:
    """The first success of every delivery while its epoch was in force, each put out once by a stream."""
    return prefix.first_successes(_prefix_stream(inputs))


def stream_records_with_epoch(inputs: Inputs) -> DataFrame:
    """Records stamped with the epoch in force by a stream of records and assignment changes."""
    log = stream_epochs.with_changes(inputs["records"].select(*LOCATION, "seq"), inputs.intervals("rebalance_log"))
    out = _run_stream(inputs, "epoch-stream", log, stream_epochs.stream_assigned, "append")
    return out.select(*LOCATION, "seq", "epoch")


def _poisoned(first_epoch_only: bool) -> run.Sink:
    """Sample sink: offsets 401, 1401, ... fail in the first run."""

    def sink(delivered: DataFrame) -> DataFrame:
        poison = (F.col("record_offset") % 1000 == 401) & (F.col("epoch") == 1)
        bad = poison if first_epoch_only else F.lit(False)
        return delivered.select(
            *TOKEN,
            F.when(bad, "failed").otherwise("succeeded").alias("outcome"),
            F.when(bad, "the store was closed").alias("reason"),
        )

    return sink


def _stream_run(inputs: Inputs, failing: bool) -> tuple[run.RunPaths, list[str]]:
    """Run to the end of the record log; after a failure, start again with a new epoch."""
    paths = run.RunPaths(workspace(inputs.spark, "sink-run"))
    log = _log_of_records(inputs)
    errors: list[str] = []
    for epoch in (1, 2) if failing else (1,):
        query = run.run_with_sink(
            stream_record_log(inputs.spark, log), _poisoned(failing), paths, epoch=epoch
        )
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            if not failing or epoch > 1:
                raise
            errors.append(str(error))
    return paths, errors


def run_with_sink(inputs: Inputs) -> DataFrame:
    paths, _ = _stream_run(inputs, failing=False)
    return run.read_acks(inputs.spark, paths).select(*LOCATION, "outcome", "reason")


def stream_replay(inputs: Inputs) -> DataFrame:
    """Deliveries per record over a failed run and its restart."""
    paths, _ = _stream_run(inputs, failing=True)
    return (
        run.read_acks(inputs.spark, paths)
        .groupBy(*LOCATION)
        .agg(
            F.count(F.lit(1)).alias("n_deliveries"),
            F.min("epoch").alias("first_run"),
            F.max("epoch").alias("last_run"),
            F.max(F.when(F.col("outcome") == "succeeded", F.col("epoch"))).alias("last_success"),
        )
    )


def _silent_at(offsets: tuple[int, ...]) -> run.Sink:
    """Sample sink: gives no outcome for ``offsets`` in the first run."""

    def sink(delivered: DataFrame) -> DataFrame:
        answered = delivered.filter(~(F.col("record_offset").isin(*offsets) & (F.col("epoch") == 1)))
        return answered.select(*TOKEN, F.lit("succeeded").alias("outcome"), F.lit(None).cast("string").alias("reason"))

    return sink


def _log_in_parts(inputs: Inputs) -> str:
    """The record log as eight files by offset, for runs over several micro-batches."""
    return inputs.folder(
        "record-parts", lambda path: write_record_log(_records(inputs).repartitionByRange(8, "record_offset"), path)
    )


def replay_unanswered(inputs: Inputs) -> DataFrame:
    """Per record: attempts without an outcome, and whether one succeeded.

    The log comes in four micro-batches. The first run stops at the batch that
    holds the two records its sink leaves out; the second delivers them again.
    """
    paths = run.RunPaths(workspace(inputs.spark, "silent-run"))
    log = _log_in_parts(inputs)
    for epoch in (1, 2):
        stream = stream_record_log(inputs.spark, log, max_files_per_trigger=2)
        query = run.run_with_sink(stream, _silent_at((401, 402)), paths, epoch=epoch)
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if epoch > 1:
                raise
    acks_of_run = run.read_acks(inputs.spark, paths)
    return acks_of_run.groupBy(*LOCATION).agg(
        F.count_if(F.col("outcome").isNull()).alias("n_unanswered"),
        F.bool_or(F.coalesce(F.col("outcome") == "succeeded", F.lit(False))).alias("succeeded"),
    )


def run_audit(inputs: Inputs) -> DataFrame:
    """The safe offset of every partition, worked out from what a failed run and its restart wrote."""
    paths, _ = _stream_run(inputs, failing=True)
    return run.committed_offsets(run.read_acks(inputs.spark, paths))


def run_with_object_processor(inputs: Inputs) -> DataFrame:
    """A run over the object records; it fails closed, having acked every record."""
    spark = inputs.spark
    paths = run.RunPaths(workspace(spark, "object-run"))
    none = F.lit(None)
    log = inputs["object_records"].select(
        *LOCATION,
        (F.col("record_offset") * 10).alias("seq"),
        none.cast("binary").alias("rec_key"),
        F.col("payload_text").cast("binary").alias("payload"),
        none.cast("array<struct<key string, value binary>>").alias("headers"),
        none.cast("timestamp").alias("ts"),
    )
    write_record_log(log, f"{paths.root}/log")
    query = run.run_with_object_processor(
        stream_record_log(spark, f"{paths.root}/log"),
        reject_by_size,
        paths,
        epoch=1,
        max_object_size=MAX_OBJECT_SIZE,
    )
    try:
        query.awaitTermination()
    except StreamingQueryException as error:
        if "downstream processing failed" not in str(error):
            raise
    return run.read_acks(spark, paths).select(*LOCATION, "outcome", "reason")


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "safe_prefix": safe_prefix,
    "read_record_log": read_record_log_query,
    "object_chunks": object_chunks,
    "object_chunks_source": object_chunks_source,
    "fetch_small_objects": fetch_small_objects,
    "record_envelope": record_envelope,
    "accounted_bytes": accounted_bytes,
    "record_location": record_location,
    "decode_metadata": decode_metadata_query,
    "metadata_rule_hits": metadata_rule_hits_query,
    "reject_messages": reject_messages,
    "reject_table": reject_table,
    "payload_guard": payload_guard,
    "fail_closed_first_violation": fail_closed_first_violation,
    "assignment_epochs": assignment_epochs,
    "effective_revokes": effective_revokes,
    "epoch_intervals": epoch_intervals,
    "current_assignments": current_assignments,
    "records_with_epoch": records_with_epoch,
    "records_with_epoch_by_join": records_with_epoch_by_join,
    "unassigned_records": unassigned_records,
    "fenced_events": fenced_events,
    "live_events": live_events,
    "rebalance_errors": rebalance_errors,
    "rebalance_counts": rebalance_counts,
    "delivery_violations": delivery_violations,
    "first_success": first_success,
    "final_snapshot": final_snapshot,
    "prefix_advances": prefix_advances,
    "completion_effects": completion_effects,
    "failed_completions": failed_completions,
    "stream_safe_prefix": stream_safe_prefix,
    "stream_first_success": stream_first_success,
    "stream_records_with_epoch": stream_records_with_epoch,
    "record_states": record_states,
    "replay_set": replay_set,
    "committed_by_interval": committed_by_interval,
    "in_flight": in_flight,
    "safe_prefix_in_steps": safe_prefix_in_steps,
    "in_flight_in_steps": in_flight_in_steps,
    "stream_commits": stream_commits,
    "budget_occupancy": budget_occupancy,
    "watermark_signals": watermark_signals,
    "admission_blocked": admission_blocked,
    "paused_state": paused_state,
    "pause_transitions": pause_transitions,
    "peak_concurrency": peak_concurrency,
    "verify_headers": verify_headers,
    "verify_body": verify_body,
    "stalled_bodies": stalled_bodies,
    "object_verdict": object_verdict,
    "download_summary": download_summary,
    "download_objects": download_objects,
    "download_completions": download_completions,
    "object_completions": object_completions,
    "run_object_processor": run_object_processor,
    "discard_completions": discard_completions,
    "run_with_sink": run_with_sink,
    "run_with_object_processor": run_with_object_processor,
    "stream_replay": stream_replay,
    "replay_unanswered": replay_unanswered,
    "run_audit": run_audit,
}


def on_folder(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Turn a query over :class:`Inputs` into one over (session, data folder)."""
    return lambda spark, sf_dir: build(Inputs(spark, sf_dir))
