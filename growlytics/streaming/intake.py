"""Event intake as Structured Streaming: L1-L3.

The reference buffers tracked events in a process-local queue and inserts
them in batches (at most once: a failed insert loses its batch).  Here the
producer drops JSON payloads into a landing folder and a streaming query

1. L1 normalises them: a missing ``event_time`` becomes the arrival time,
   a missing ``event_id`` becomes ``EVT_`` + 32 upper-case hex digits of a
   random id: a label, never a key, so that equal payloads stay apart; a
   malformed ``event_time`` becomes the arrival time instead of an error
   that would stop the stream at every restart;
2. L3 projects to the ``fact_events`` shape (+ ``date_id``), and
3. L2 writes each micro-batch as a partition of its own, ``batch_id=N``, and
   notes it in a ledger last.

**Replays of a batch.**  A batch that is run again (the driver died between
its write and Spark's commit) overwrites its own partition and its own ledger
entry: the sink holds its rows once.  Readers take the batches of the ledger
only (:func:`read_sink`), so that a batch in the making is not seen.

**Replays of an event.**  Events with a producer's id are kept once, however
late a retry comes: a batch drops repeats of its own, then those whose id an
earlier batch holds.  The sink keeps the ids of each batch, with their arrival
day, beside its rows; the join's large side is that index of ids, and
``replay_days`` can bound how far back it is read (None: all of it).
Events without a producer's id are all kept.

**Marts.**  Each batch also leaves its user-day states (mergeable sums,
:mod:`growlytics.operators.user_days`); :func:`live_user_days` merges those of
the ledger's batches, so the marts follow the stream and survive replays in
the same way.

``maxFilesPerTrigger`` bounds a micro-batch the way the reference's 50-event
flush does.  Checkpoints and landing folders live under the shared folder
named by ``spark.checkpoint.dir`` so a restarted driver (or a lost executor)
resumes from the last committed batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from growlytics.config import Params
from growlytics.functions.dates import date_id
from growlytics.operators.user_days import merged, user_days
from growlytics.sources.schemas import TRACK_SCHEMA


def read_landing(spark: SparkSession, landing: str, max_files_per_trigger: int = 50) -> DataFrame:
    """Streaming source over the landing folder (explicit schema)."""
    return (
        spark.readStream.schema(TRACK_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .json(landing)
        .withColumn("_file", F.col("_metadata.file_path"))
    )


def normalise(raw: DataFrame) -> DataFrame:
    """L1: fill event_time and event_id, stamp the arrival time."""
    arrival = F.current_timestamp()
    generated = F.concat(F.lit("EVT_"), F.upper(F.regexp_replace(F.uuid(), "-", "")))
    return raw.select(
        F.coalesce(F.col("event_id"), generated).alias("event_id"),
        F.col("user_id"),
        F.col("event_type"),
        F.coalesce(F.try_to_timestamp("event_time"), arrival).alias("event_time"),
        arrival.alias("ingested_at"),
        F.col("event_id").isNotNull().alias("given_id"),
    )


def to_fact_events(events: DataFrame) -> DataFrame:
    """L3: the fact_events projection (stateless, same micro-batch)."""
    return events.select("event_id", "user_id", "event_type", date_id(F.col("event_time")).alias("date_id"),
                         "event_time", "ingested_at", "given_id")


def intake(spark: SparkSession, landing: str, max_files_per_trigger: int = 50) -> DataFrame:
    """L1 + L3 as one streaming DataFrame."""
    return to_fact_events(normalise(read_landing(spark, landing, max_files_per_trigger)))


def _once(batch: DataFrame) -> DataFrame:
    """One row per producer's id (the least of its rows, so that a rerun takes
    the same one); rows without one all stay."""
    given = batch.where("given_id").groupBy("event_id").agg(
        F.min(F.struct("event_time", "user_id", "event_type", "date_id", "ingested_at")).alias("r"))
    given = given.select("event_id", "r.user_id", "r.event_type", "r.date_id", "r.event_time", "r.ingested_at", F.lit(True).alias("given_id"))
    return given.unionByName(batch.where("NOT given_id"))


def ledger(spark: SparkSession, sink: str) -> list[int]:
    """The completed batches of a sink."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sink}/_ledger")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(p)) if fs.exists(p) else []


def _batches(spark: SparkSession, folder: str, batches: list[int]) -> DataFrame | None:
    if not batches:
        return None
    return spark.read.option("basePath", folder).parquet(*[f"{folder}/batch_id={i}" for i in batches])


def write_batch(batch: DataFrame, batch_id: int, sink: str, replay_days: int | None = None, p: Params | None = None,
                then: Callable[[str], None] | None = None) -> None:
    """L2: the micro-batch as partition ``batch_id`` of the sink.  ``then`` is
    called after each step with its name (tests fail there)."""
    spark, step = batch.sparkSession, then or (lambda name: None)
    earlier = [i for i in ledger(spark, sink) if i != batch_id]
    rows = _once(batch)
    known = _batches(spark, f"{sink}/_ids", earlier)
    if known is not None:
        mine = rows.where("given_id").select("event_id")
        if replay_days is not None:
            known = known.where(F.col("day") >= F.date_sub(F.current_date(), replay_days))
        # the ids of this batch that are known: the index is read, not moved,
        # where the batch is small enough for Spark to send it round
        seen = known.join(mine, "event_id", "left_semi").select("event_id").distinct()
        rows = rows.join(seen, "event_id", "left_anti")
    rows.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
    step("rows")
    written = spark.read.parquet(f"{sink}/batch_id={batch_id}")
    ids = written.where("given_id").select("event_id", F.to_date("ingested_at").alias("day"))
    ids.write.mode("overwrite").parquet(f"{sink}/_ids/batch_id={batch_id}")
    none = written.limit(0)
    days = user_days(
        none.select("user_id", F.lit(None).cast("timestamp").alias("session_start"), F.lit("").alias("device_type"), F.lit("").alias("session_id")),
        written, none.select("user_id", F.lit(None).cast("date").alias("payment_date"), F.lit(None).cast("decimal(18,2)").alias("amount")), p or Params.reference())
    days.write.mode("overwrite").parquet(f"{sink}/_user_days/batch_id={batch_id}")
    step("states")
    note = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sink}/_ledger/{batch_id}")
    note.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(note, True).close()
    step("ledger")


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    """The events of all completed batches."""
    out = _batches(spark, sink, ledger(spark, sink))
    if out is None:
        raise FileNotFoundError(f"no batch of {sink} has been completed")
    return out.drop("batch_id", "given_id")


def live_user_days(spark: SparkSession, sink: str) -> DataFrame:
    """The user-day mart of the streamed events."""
    states = _batches(spark, f"{sink}/_user_days", ledger(spark, sink))
    if states is None:
        raise FileNotFoundError(f"no batch of {sink} has been completed")
    return merged(states.drop("batch_id"), "user_id", "day")


def start(stream: DataFrame, sink: str, checkpoint: str, available_now: bool = False,
          interval: str = "5 seconds", replay_days: int | None = None, p: Params | None = None) -> StreamingQuery:
    """L2: batches into the sink; ``available_now`` drains what is there
    (tests, catch-up), otherwise a 5-second processing-time trigger."""
    w = stream.writeStream.foreachBatch(lambda df, i: write_batch(df, i, sink, replay_days, p)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def run_available(spark: SparkSession, landing: str, sink: str, checkpoint: str, **options) -> None:
    q = start(intake(spark, landing), sink, checkpoint, available_now=True, **options)
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise q.exception()


def write_payloads(events: DataFrame, landing: str) -> None:
    """Producer side: write tracked events as JSON payload files (one file
    per input split; no shuffle)."""
    out = events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"),
    )
    out.write.mode("append").json(landing)
