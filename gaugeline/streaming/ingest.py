"""Streaming form of raw-to-bronze: same operators, file stream source, merge per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gaugeline.operators import documents
from gaugeline.plans.ingest import write_bronze
from gaugeline.sources.raw import raw_texts
from gaugeline.sources.storage import join_path


def read_raw_stream(spark: SparkSession, input_dir: str, multi_line: bool = True,
                    max_files: int | None = None) -> DataFrame:
    """Document texts as they arrive below the ``location_*`` folders."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return raw_texts(reader, multi_line, join_path(input_dir, "location_*"))


def first_deliveries(rows: DataFrame, horizon: str) -> DataFrame:
    """Readings whose event id did not arrive within the last ``horizon``, by the state of the stream.

    Time is that of arrival, the micro-batch's own: a late reading, whatever its timestamp, is no less
    new than others, and none is dropped for being late. Ids are forgotten after the horizon, so the
    state is bounded by what arrives in that time; later repetitions are caught by the merge. Readings
    without id, and texts that are no documents, stand for themselves by the place they come from.
    """
    key = F.coalesce(F.when(F.col(documents.REASON).isNull(), F.col("eventId")),
                     F.col(documents.PLACE))
    return (rows.withColumns({"_arrived": F.current_timestamp(), "_delivery": key})
            .withWatermark("_arrived", horizon).dropDuplicatesWithinWatermark(["_delivery"])
            .drop("_arrived", "_delivery"))


def stream_raw_to_bronze(spark: SparkSession, input_dir: str, output_dir: str,
                         checkpoint_dir: str, multi_line: bool = True,
                         available_now: bool = True, interval: str = "1 minute",
                         max_files: int | None = None, ids_fix_date: bool = False,
                         schema: T.StructType | None = None, horizon: str | None = "1 hour"
                         ) -> StreamingQuery:
    """Start the stream. ``available_now`` processes what is there and ends; ``ids_fix_date`` as
    in the batch job: merges then read only the dates of a micro-batch.

    Day batches and single-reading documents may arrive side by side. Repeated event ids within
    ``horizon`` are dropped before the merge (None: by the merge alone); a micro-batch that is repeated
    after a failure is harmless, as the merge goes by event id.
    """
    texts = read_raw_stream(spark, input_dir, multi_line, max_files)
    rows = documents.document_readings(documents.parse_documents(texts, schema), schema)
    if horizon is not None:
        rows = first_deliveries(rows, horizon)
    writer = (rows.writeStream.option("checkpointLocation", checkpoint_dir)
              .foreachBatch(lambda batch, _id: write_bronze(batch, output_dir,
                                                            ids_fix_date=ids_fix_date) and None))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=interval))
    return writer.start()
