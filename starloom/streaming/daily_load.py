"""Incremental day-by-day load of production files with Structured
Streaming.

The reference loads one day's file per scheduled run and accumulates the
silver table by keyed upsert.  Here the landing folder is a stream of files:
each micro-batch (new files only; progress kept in the checkpoint under
the shared folder) is read by the headers of its files, parsed once, split
into good and quarantined rows, and upserted into the silver table with
``foreachBatch``.  The upsert is
idempotent, so a micro-batch replayed after a failure leaves the same
table: the sink is effectively exactly-once.  Of several rows of one
reading the later file's wins (by file day, then modification time), in one
batch or across batches, so the batch size does not change the table.
``availableNow`` processes
what has landed and stops, the batch-scheduled equivalent of a daily run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starloom.operators.cleanse import silver_production
from starloom.operators.load import upsert_table
from starloom.session import cut_lineage
from starloom.sources.csv import FILE_ORDER, parse_production, read_csv, split_quarantine, to_bronze


# Fixed value: the schema of Spark's binary file source.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def file_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files by their path; their content is read by each micro-batch,
    one reader per header layout."""
    r = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(landing).select("path")


def load_batch(batch: DataFrame, epoch_id: int, root: str, quarantine_path: str) -> None:
    """One micro-batch: quarantine its bad rows, upsert its good rows.
    Safe to replay: the quarantine folder of the epoch is overwritten and
    the upsert is idempotent."""
    good, bad = split_quarantine(batch)
    (bad.withColumn("epoch", F.lit(epoch_id)).write.mode("overwrite")
     .parquet(f"{quarantine_path}/epoch={epoch_id}"))
    silver = silver_production(to_bronze(good, batch_id=f"epoch-{epoch_id}"), keep=FILE_ORDER)
    upsert_table(batch.sparkSession, root, "silver_production", silver, ["production_id"], FILE_ORDER,
                 partition_col="date", newer_only=True)


def start_daily_load(spark: SparkSession, landing: str, root: str,
                     quarantine_path: str, checkpoint: str,
                     max_files_per_trigger: int | None = None,
                     available_now: bool = True) -> StreamingQuery:
    def load(batch: DataFrame, epoch_id: int) -> None:
        files = sorted(r[0] for r in batch.collect())  # the paths of one trigger
        if files:
            parsed = cut_lineage(parse_production(read_csv(batch.sparkSession, files)), "parsed")
            load_batch(parsed, epoch_id, root, quarantine_path)

    w = (file_stream(spark, landing, max_files_per_trigger).writeStream
         .foreachBatch(load).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
