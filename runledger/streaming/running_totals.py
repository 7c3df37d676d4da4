"""Running totals of batches that can take events back (ST3, ST4).

A batch's totals are its roll-up before the status: sums, counts, the first
and the last time, and the number of terminal events.  A micro-batch adds its
new events to them.  Where an event has been counted before and its later
delivery wins, the old delivery is subtracted; so the totals are those of the
latest delivery of each event, as in the batch roll-up, and no stored history
is read but what the stream can't know:

* the stored deliveries of events that may have been counted before: those the
  stream has seen in an earlier micro-batch, and all events of a batch whose
  totals come from another checkpoint or are older than the stream's memory;
* the stored rows of a batch whose first or last time was taken back.

Totals are appended in versions that grow with the checkpoint's generation and
the epoch.  An epoch reads older versions only (of the totals and of the
stored deliveries), so one that runs again writes the same totals again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.operators import evidence as evo
from runledger.operators.keyed import latest_per_key
from runledger.session import materialized
from runledger.sources import evidence_store as store

SUMS = [*evo.PARTIAL_SUMS, "terminal_events"]
TOTALS = ("batch_id string, "
          + ", ".join(f"{c} bigint" for c in SUMS)
          + ", started timestamp_ntz, ended timestamp_ntz, "
            "generation bigint, first_seen timestamp, version bigint")
GENERATIONS = "stream string, generation bigint"
EPOCHS = 1 << 32     # epochs of one generation

# What is kept of a delivery: the roll-up's input and the step's places.
DELIVERY = [*evo.ROLLUP_INPUT, "input_s3", "output_s3"]


def generation_of(spark: SparkSession, path: str, stream: str) -> int:
    """Number of a checkpoint among all that wrote these totals."""
    known = store.read_rows(spark, f"{path}_generations", GENERATIONS)
    found = known.where(F.col("stream") == stream).agg(
        F.min("generation")).first()[0]
    if found is not None:
        return found
    last = known.agg(F.max("generation")).first()[0]
    number = 0 if last is None else last + 1
    store.append_rows(spark.createDataFrame(
        [(stream, number)], GENERATIONS).coalesce(1), f"{path}_generations")
    return number


def read_totals(spark: SparkSession, path: str,
                batches: DataFrame | None = None,
                before: int | None = None) -> DataFrame:
    """The latest totals of every (or the given) batch, of versions below
    ``before``."""
    rows = store.restrict_to_batches(store.read_rows(
        spark, path, TOTALS + ", bucket int"), batches)
    if before is not None:
        rows = rows.where(F.col("version") < before)
    return latest_per_key(rows.drop("bucket"), ["batch_id"], ["version"])


def _normal_key(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "step": F.coalesce("step", F.lit("unknown")),
        "event_id": F.coalesce("event_id", F.lit(""))})


def _suspects(best: DataFrame, known: DataFrame, firsts: DataFrame | None,
              generation: int, memory: str) -> DataFrame:
    """The events (EVENT_KEY) that may have been counted before."""
    if firsts is None:
        return best.join(known.select("batch_id"), "batch_id",
                         "left_semi").select(*evo.EVENT_KEY)
    lasting = ((F.col("generation") == generation)
               & (F.col("first_seen") >= F.current_timestamp()
                  - F.expr(f"INTERVAL {memory}")))
    rows = best.join(known.select("batch_id", lasting.alias("lasting")),
                     "batch_id")
    new = _normal_key(firsts).select(*evo.EVENT_KEY, F.lit(True).alias("new"))
    return rows.join(new.distinct(), evo.EVENT_KEY, "left").where(
        "not lasting or new is null").select(*evo.EVENT_KEY)


def _stored_best(spark: SparkSession, events: DataFrame, path: str,
                 version: int) -> DataFrame:
    """The latest stored delivery of each of the events."""
    rows = store.read_evidence(
        spark, path, batches=events, dedup=False, before=version,
        columns=DELIVERY)
    return evo.dedup_events(_normal_key(rows).join(
        events, evo.EVENT_KEY, "left_semi"), DELIVERY)


def changes(spark: SparkSession, deliveries: DataFrame, known: DataFrame,
            firsts: DataFrame | None, evidence: str, generation: int,
            version: int, memory: str) -> tuple[DataFrame, DataFrame | None]:
    """Deliveries that count from now on, and those they replace (none: no
    event of the micro-batch had been counted)."""
    # Read by the totals, the step details and the look-up of suspects.
    best = materialized(_normal_key(evo.dedup_events(deliveries, DELIVERY)),
                        "latest")
    suspects = materialized(_suspects(best, known, firsts, generation,
                                      memory), "suspects")
    if not suspects.limit(1).count():
        return best, None
    old = materialized(_stored_best(spark, suspects, evidence, version),
                       "counted-before")
    if not old.limit(1).count():
        return best, None
    both = best.withColumn("is_old", F.lit(False)).unionByName(
        old.withColumn("is_old", F.lit(True)))
    plus = evo.dedup_events(both, [*DELIVERY, "is_old"]).where(
        "not is_old").drop("is_old")
    plus = materialized(plus, "counted-now")
    return plus, old.join(plus.select(*evo.EVENT_KEY), evo.EVENT_KEY,
                          "left_semi")


def _taken_back(bound: str, better) -> Column:
    """Whether a batch's first or last time went with a replaced event."""
    old, now = F.col(f"minus.{bound}"), F.col(f"plus.{bound}")
    return (old == F.col(f"known.{bound}")) & ~F.coalesce(
        better(now, old), F.lit(False))


def new_totals(known: DataFrame, plus: DataFrame, minus: DataFrame | None,
               mode: str, generation: int, version: int) -> DataFrame:
    """Totals of the batches that changed, with ``rebuild`` where the first
    or last time has to be looked up."""
    added = evo.rollup_partials(plus, mode)
    taken = evo.rollup_partials(minus, mode) if minus is not None else \
        added.limit(0)
    rows = (added.alias("plus")
            .join(known.alias("known"), "batch_id", "left")
            .join(taken.alias("minus"), "batch_id", "left"))

    def total(c: str) -> Column:
        return (F.coalesce(f"known.{c}", F.lit(0)) + F.col(f"plus.{c}")
                - F.coalesce(f"minus.{c}", F.lit(0))).cast("bigint").alias(c)

    return rows.select(
        "batch_id", *[total(c) for c in SUMS],
        F.least("known.started", "plus.started").alias("started"),
        F.greatest("known.ended", "plus.ended").alias("ended"),
        # Totals that another checkpoint began stay under its name.
        F.coalesce("known.generation", F.lit(generation)).alias("generation"),
        F.coalesce("known.first_seen", F.current_timestamp())
        .alias("first_seen"), F.lit(version).cast("bigint").alias("version"),
        F.coalesce(_taken_back("started", lambda a, b: a <= b)
                   | _taken_back("ended", lambda a, b: a >= b),
                   F.lit(False)).alias("rebuild"))


def rebuilt(spark: SparkSession, totals: DataFrame, evidence: str, mode: str,
            version: int) -> DataFrame:
    """``totals`` with the marked batches' times from their stored rows (the
    micro-batch's own are stored by now)."""
    marked = totals.where("rebuild").select("batch_id")
    if not marked.limit(1).count():
        return totals.drop("rebuild")
    rows = store.read_evidence(spark, evidence, batches=marked,
                               before=version + 1, columns=evo.ROLLUP_INPUT)
    times = rows.groupBy("batch_id").agg(
        F.min("ts").alias("s"), F.max("ts").alias("e"),
        F.lit(True).alias("found"))
    return totals.join(times, "batch_id", "left").withColumns({
        "started": F.when(F.col("found"), F.col("s"))
        .otherwise(F.col("started")),
        "ended": F.when(F.col("found"), F.col("e"))
        .otherwise(F.col("ended"))}).drop("rebuild", "s", "e", "found")
