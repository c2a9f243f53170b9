"""Load trip CSVs as they land, with the batch high-water-mark upsert.

A file-source stream over the landing folder yields the *paths* of new files
(the binary-file source without its content column, so no body is read by
the stream itself). Each micro-batch then reads its files by column name
(``rides.sources.csv``), stages them and applies ``IncrementalTable.load``.

The stream checkpoint hands over each file once, so every row is taken, late
ones too, and upserted by ``ride_id``: a ride that arrives again replaces the
earlier one, in the order of file modification time, then path, then the
values of the row. Rows without a ``ride_id`` all stay. The outcome does not
depend on how files fall into micro-batches. The table records the number of
the last micro-batch it took, so one that is replayed after a failure changes
nothing. ``maxFilesPerTrigger`` bounds how many paths one micro-batch collects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rides.operators.incremental import IncrementalTable
from rides.plans.staging import stg_trips
from rides.sources.csv import read_trips_csv
from rides.sources.files import Admission

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def in_arrival_order(trips: DataFrame, files: list[str]) -> DataFrame:
    """``trips`` with ``_order``, the number of their file among ``files``."""
    order = trips.sparkSession.createDataFrame(
        [(f, i) for i, f in enumerate(files)], "source_file string, _order int")
    return trips.join(F.broadcast(order), "source_file", "left").select(*trips.columns, "_order")


def start_trip_stream(spark: SparkSession, landing_dir: str, table_path: str,
                      checkpoint_location: str, max_files_per_trigger: int = 1000,
                      available_now: bool = False,
                      processing_time: str | None = None) -> StreamingQuery:
    table = IncrementalTable(spark, table_path)
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
                  .option("pathGlobFilter", "*.csv")
                  .option("recursiveFileLookup", "true")
                  .option("maxFilesPerTrigger", max_files_per_trigger)
                  .load(landing_dir)
                  .select("path", "length", "modificationTime"))

    def load_batch(batch_df, epoch_id):
        rows = batch_df.where(F.col("length") > 0).collect()   # <= maxFilesPerTrigger paths
        rows = sorted((r for r in rows if not r["path"].rsplit("/", 1)[-1].startswith("._")),
                      key=lambda r: (r["modificationTime"], r["path"]))
        if not rows:
            return
        adm = Admission(admitted=[(r["path"], r["length"]) for r in rows])
        raw = read_trips_csv(spark, adm.paths, admission=adm)
        table.load(in_arrival_order(stg_trips(raw), adm.paths), every_row=True, order=["_order"],
                   epoch=(checkpoint_location, epoch_id))

    writer = (files.writeStream.foreachBatch(load_batch)
                   .option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
