"""Continuous evidence ingestion (ST1-ST4) with Structured Streaming.

    readStream (JSON envelopes) -> explode -> parse (P12-P15)
        -> duplicates within the watermark dropped (ST2)
        -> foreachBatch:
             flows of the new events (J2), append to the store (S12)
             the touched batches' running totals, changed by what the new
               deliveries add and replace, and the terminated ones finalized
               (ST3, ST4): summaries (S14) and step details

The latest delivery of an event wins, as in the batch path.  The stream drops
literal repeats (same event, same text) within ``watermark`` of their arrival,
which bounds its state (128 bits of an event's key and text, in RocksDB), and
marks events that it sees for the first time.
Only events without that mark can have been counted before, and only their
stored deliveries are read back (``running_totals``).  A repeat that comes
after the watermark is stored again, and settled by its batch's age.  Summaries
are appended in versions, so a replayed epoch or a new checkpoint adds an
equal version and loses nothing.

Whether a batch terminated is a property of its stored evidence.  Late evidence
of a terminated batch re-finalizes it (``refinalize_late``); without the flag a
batch's summary is written only in a micro-batch that carries its terminal
event, as the reference does (its step details go on growing).
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from runledger import schemas
from runledger.operators import evidence as evo
from runledger.session import conf_set, folders_dropped, materialized
from runledger.sources import evidence_store as store
from runledger.sources import snapshots
from runledger.streaming import running_totals as running


_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb."
# Keys in RocksDB, on disk.  Outside the heap are its filters and indexes (under
# two bytes a key) and the write buffers of each state partition.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state."
        "RocksDBStateStoreProvider",
    _ROCKSDB + "writeBufferSizeMB": "32",
    _ROCKSDB + "maxWriteBufferNumber": "3",
    _ROCKSDB + "trackTotalNumberOfRows": "false",  # a look-up for each put
}


@dataclass
class EvidenceStreamConfig:
    landing: str                 # folder (or glob) the envelopes arrive in
    store: str                   # evidence table
    summaries: str               # summary table
    checkpoint: str              # stream checkpoint, shared storage
    ingested_at: str             # arrival of events without a timestamp
    max_files_per_trigger: int | None = None
    refinalize_late: bool = True
    mode: str = "by_step"
    raw_archive: str | None = None   # S16 when set (a second query)
    # State-store partitions of the de-dup (fixed at the first start);
    # default: the cluster's parallelism.
    state_partitions: int | None = None
    # Keep the de-dup keys in RocksDB (off-heap, spills to disk); else in the
    # session's provider, whose default holds all keys in the heap.
    rocksdb_state: bool = True

    # How long literal repeats are recognised in the stream.
    watermark: str = "1 day"

    # Small parts of the tables are packed every so many micro-batches
    # (none: never), and replaced parts removed after ``retain`` seconds.
    compact_every: int | None = 16
    retain: float = snapshots.RETAIN_SECONDS

    @property
    def details(self) -> str:
        return self.summaries.rstrip("/") + "_steps"

    @property
    def totals(self) -> str:
        return self.summaries.rstrip("/") + "_totals"


def envelope_stream(spark: SparkSession, cfg: EvidenceStreamConfig
                    ) -> DataFrame:
    """ST1: envelopes as a streaming DataFrame (any source of the same
    schema, e.g. a message bus, can replace the file source)."""
    reader = spark.readStream.schema(schemas.LOG_ENVELOPE)
    if cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger",
                               str(cfg.max_files_per_trigger))
    return reader.json(cfg.landing)


def evidence_events(envelopes: DataFrame, ingested_at: str) -> DataFrame:
    """Parsed, flattened evidence events of (streaming) envelopes, without
    flows."""
    return evo.parse_log_events(evo.explode_envelopes(envelopes), None,
                                ingested_at, evo.STORED)


FIRST = "first_seen_event"


# What the de-dup keeps of an event or a mark: 128 bits, whatever its texts.
STATE_KEY = ["_state_key", "_state_key2"]


def with_first_marks(events: DataFrame) -> DataFrame:
    """Every event twice: as it is, and as a mark of its key alone, of which
    the de-dup below lets through the first."""
    step = F.coalesce("step", F.lit("unknown"))
    event = F.coalesce("event_id", F.lit(""))
    twice = events.withColumn(FIRST, F.explode(F.array(
        F.lit(False), F.lit(True))))
    return twice.select(
        "batch_id", step.alias("step"), event.alias("event_id"), FIRST,
        *[F.when(~F.col(FIRST), F.col(c)).alias(c) for c in events.columns
          if c not in evo.EVENT_KEY])


def with_state_key(events: DataFrame) -> DataFrame:
    """Equal for literal repeats of an event, and for marks of one key (a mark
    has no hash)."""
    return events.withColumns({
        name: F.xxhash64(F.lit(seed), FIRST, *evo.EVENT_KEY, "event_hash")
        for seed, name in enumerate(STATE_KEY)})


def compact_tables(spark: SparkSession, cfg: EvidenceStreamConfig,
                   version: int) -> None:
    """Pack the small parts of all tables.  An epoch that runs again reads
    the totals of the versions before it: these and its own stay."""
    store.compact_evidence(spark, cfg.store)
    store.compact_versions(spark, cfg.totals, running.TOTALS + ", bucket int",
                           ["batch_id"], before=version)
    store.compact_versions(spark, cfg.summaries, store.VERSIONED_SUMMARY,
                           ["batch_id"])
    store.compact_versions(spark, cfg.details, None, evo.EVENT_KEY)
    for path in (cfg.store, cfg.totals, cfg.summaries, cfg.details):
        snapshots.vacuum(spark, path, cfg.retain)


def make_batch_writer(spark: SparkSession, cfg: EvidenceStreamConfig,
                      flow_map: DataFrame | None = None):
    """The ``foreachBatch`` function over new events without flows, with or
    without marks of first events (exposed for direct testing)."""

    generations: dict[str, int] = {}
    partitions = spark.conf.get("spark.sql.shuffle.partitions")

    def process(events: DataFrame, epoch_id: int) -> None:
        # The query's id stays with its checkpoint.
        stream = (spark.sparkContext.getLocalProperty("sql.streaming.queryId")
                  or cfg.checkpoint)
        if stream not in generations:
            generations[stream] = running.generation_of(spark, cfg.totals,
                                                        stream)
        generation = generations[stream]
        version = generation * running.EPOCHS + epoch_id
        # The stream's session plans for the state: few partitions, fixed.
        session = events.sparkSession
        with (conf_set(session, "spark.sql.shuffle.partitions", partitions),
              conf_set(session, "spark.sql.adaptive.enabled", "true"),
              folders_dropped(spark)):
            # Parsed once: everything below reads the micro-batch.
            both = materialized(events, "micro-batch")
            new, firsts = both, None
            if FIRST in both.columns:
                new = both.where(~F.col(FIRST)).drop(FIRST)
                firsts = both.where(FIRST)
            store.append_evidence(evo.with_flow(new, flow_map), cfg.store,
                                  version)
            known = materialized(running.read_totals(
                spark, cfg.totals, new.select("batch_id"), version),
                "known-totals")
            plus, minus = running.changes(
                spark, new, known, firsts, cfg.store, generation, version,
                cfg.watermark)
            totals = materialized(running.new_totals(
                known, plus, minus, cfg.mode, generation, version), "totals")
            totals = running.rebuilt(spark, totals, cfg.store, cfg.mode,
                                     version)
            store.append_rows(totals, cfg.totals)
            done = totals.where("terminal_events > 0")
            if not cfg.refinalize_late:
                done = evo.restrict_to(done, evo.terminal_batches(new))
            later = time.time_ns() // 1_000_000   # later runs win
            store.write_summaries(evo.finish_rollup(done), cfg.summaries,
                                  later)
            store.write_details(evo.step_details(plus, signals=True),
                                cfg.details, version)
            if cfg.compact_every and (epoch_id + 1) % cfg.compact_every == 0:
                compact_tables(spark, cfg, version)

    return process


def start_evidence_stream(spark: SparkSession, cfg: EvidenceStreamConfig,
                          flow_map: DataFrame | None = None,
                          available_now: bool = True
                          ) -> list[StreamingQuery]:
    """Start the stream (and the raw archive when configured); with
    ``available_now`` it processes what has arrived -- in several
    micro-batches when a file cap is set -- and stops."""
    envelopes = envelope_stream(spark, cfg)
    events = (with_state_key(with_first_marks(evidence_events(
                  envelopes, cfg.ingested_at)))
              # The time of arrival here, so that nothing is ever too late.
              .withColumn("_time", F.current_timestamp())
              .withWatermark("_time", cfg.watermark)
              .dropDuplicatesWithinWatermark(STATE_KEY)
              .drop("_time", *STATE_KEY))
    writer = (events.writeStream
              .foreachBatch(make_batch_writer(spark, cfg, flow_map))
              .option("checkpointLocation", cfg.checkpoint))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime="30 seconds"))
    # The stream copies the session's settings when it starts; the number
    # of shuffle (and state-store) partitions is sized for this query only.
    overrides = {"spark.sql.shuffle.partitions": str(
        cfg.state_partitions or spark.sparkContext.defaultParallelism)}
    if cfg.rocksdb_state:
        overrides |= ROCKSDB
    previous = {k: spark.conf.get(k, None) for k in overrides}
    for k, v in overrides.items():
        spark.conf.set(k, v)
    try:
        queries = [writer.start()]
    finally:
        for k, v in previous.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    if cfg.raw_archive:
        raw = (envelopes.select(F.to_json(F.struct("*")).alias("value"))
               .writeStream.format("text")
               .option("path", cfg.raw_archive)
               .option("checkpointLocation", cfg.checkpoint + "_raw"))
        raw = (raw.trigger(availableNow=True) if available_now
               else raw.trigger(processingTime="30 seconds"))
        queries.append(raw.start())
    return queries


def run_until_done(queries: list[StreamingQuery]) -> None:
    """Wait for available-now queries and surface their failures."""
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
