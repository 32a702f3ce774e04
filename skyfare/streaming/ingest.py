"""Incremental load of landed responses.

New JSON-lines files in a landing folder are picked up by a file-source
stream run with ``trigger(availableNow=True)``: each run processes exactly
the files not yet recorded in the checkpoint, then stops. Each micro-batch is
staged once, then archived and its quotes upserted from there. Both tables
record (stream, epoch) with the change, so a micro-batch that comes again
after a crash adds nothing to a table that has it already: rows with a NULL
in their key and identical responses included.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyfare import constants as C
from skyfare.operators import ingest, mutation
from skyfare.schemas import RAW_JSON
from skyfare.session import scratch_path
from skyfare.sources import tables as T
from skyfare.sources.tables import Warehouse

# Landed timestamps keep microseconds.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
# Landed files to a micro-batch. A backlog is worked off in so many at a time,
# in one run; no file is left out.
MAX_FILES_PER_TRIGGER = 10_000


def land_responses(responses: DataFrame, folder: str) -> None:
    """Write responses as JSON lines (the landed-file format)."""
    line = F.to_json(F.struct(
        F.col("ingested_at"), F.col("route_code"), F.col("params"), F.col("response")),
        {"timestampFormat": TIMESTAMP_FORMAT})
    responses.select(line.alias("value")).write.mode("append").text(folder)


def read_landed(spark: SparkSession, folder: str) -> DataFrame:
    """Batch read of landed responses with the declared schema."""
    return (spark.read.schema(RAW_JSON).option("timestampFormat", TIMESTAMP_FORMAT)
            .json(folder))


@dataclass
class IngestStats:
    batches: int = 0
    responses: int = 0
    quotes: int = 0
    inserted: int = 0
    updated: int = 0
    touched: set = field(default_factory=set)   # quote_date partitions rewritten
    history: list = field(default_factory=list)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name a checkpoint folder goes by in the tables' records: made with
    the folder and gone with it, since a new checkpoint counts epochs anew."""
    path = f"{checkpoint.rstrip('/')}/_stream_id"
    if not T.fs_exists(spark, path):
        T.fs_write_text(spark, path, uuid.uuid4().hex)
    return T.fs_read_text(spark, path)


def load_batch(spark: SparkSession, wh: Warehouse, batch: DataFrame, epoch: int,
               stream: str, stats: IngestStats, grid: DataFrame | None = None,
               store_json: bool = True, source_name: str = C.DEFAULT_SOURCE_NAME,
               zone: str | None = None, keep_unpriced: bool = False) -> None:
    """One micro-batch: archive the responses, upsert the quotes they yield.

    Either step may have been done by an earlier attempt at this epoch; the
    table's own record tells, and it is then skipped.
    """
    path, seen = scratch_path(spark, "epoch"), Observation()
    batch.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    n = seen.get["n"]
    if n:
        rows = spark.read.schema(batch.schema).parquet(path)
        if store_json:
            mutation.append_rows(ingest.archive_rows(rows, keep_unpriced), wh.raw_json, kind="json",
                                 zone=zone, op=(stream, epoch))
        # Last wins by time of landing: file time, file, block, then the order
        # in the block. Row ids alone would follow the splits, largest first.
        place = ("_place",) if "_place" in batch.columns else ()
        quotes = ingest.parse_responses(rows, carry=place)
        if grid is not None:
            made = ingest.build_quote_batch(grid, quotes, source_name, carry=place)
        else:
            made = quotes.select(
                "origin", "destination", "departure_date",
                F.col("ingested_at").alias("quote_ts"),
                F.col("price").alias("price_aud"), "stops", "airline_code",
                F.lit(source_name).alias("source"), *place)
        made = made.withColumn("seq", F.struct(*place, F.monotonically_increasing_id().alias("at")))
        res = mutation.upsert_quotes(spark, wh.raw_quotes, made, zone=zone, op=(stream, epoch))
        stats.batches += 1
        stats.responses += n
        stats.quotes += res.input_rows
        stats.inserted += res.inserted
        stats.updated += res.updated
        stats.touched.update(res.touched)
        stats.history.append((epoch, n, res.input_rows))
    T.fs_delete(spark, path)


def ingest_landed(spark: SparkSession, wh: Warehouse, landing: str, checkpoint: str,
                  grid: DataFrame | None = None, store_json: bool = True,
                  source_name: str = C.DEFAULT_SOURCE_NAME, zone: str | None = None,
                  max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
                  archive_dir: str | None = None) -> IngestStats:
    """Load every landed file not loaded before, then stop.

    A backlog is loaded in micro-batches of ``max_files_per_trigger`` files.

    ``archive_dir``: move each landed file there once its batch is committed
    (the file source's ``cleanSource=archive``), so the landing folder, which
    the source lists on every trigger, does not grow without bound.
    """
    stats = IngestStats()
    stream = stream_id(spark, checkpoint)

    def load(batch: DataFrame, epoch: int) -> None:
        load_batch(spark, wh, batch, epoch, stream, stats, grid, store_json, source_name, zone)

    reader = (spark.readStream.schema(RAW_JSON)
              .option("timestampFormat", TIMESTAMP_FORMAT)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    landed = reader.json(landing).select("*", F.struct(
        "_metadata.file_modification_time", "_metadata.file_path",
        "_metadata.file_block_start").alias("_place"))
    q = (landed.writeStream.foreachBatch(load)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return stats
