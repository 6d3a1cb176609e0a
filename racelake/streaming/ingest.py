"""One ingest log for every landing table, kept by Structured Streaming.

Landing pages (one JSON page per line) arrive as files, a folder a table.  A file-source
stream a table, run with ``trigger(availableNow=True)``, takes in the files that its
checkpoint has not listed yet and stops.  So no run opens an old file, no list of files
passes through the driver's Python, and a failed run resumes where it stopped.  Batch and
stream loads are the same code over the same checkpoint and write the same layout.

A micro-batch is written under a label of its own, the last partition column of every raw
table (``_batch_id``; telemetry: year, session_key, _batch_id).  A batch run again after a
failure overwrites its own label and nothing else.  The label holds the start of the
stream's id, so streams with checkpoints of their own never meet in one label.

Lines that are not JSON are counted while the batch is parsed and written to
``raw/_rejects/<table>`` only if there are any.  Empty files and folders add nothing; a
folder that does not exist yet is skipped.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BATCH = "_batch_id"
#: Files are told apart by the checkpoint alone, however old they are when they arrive.
NO_AGE_LIMIT = "36500d"

Parser = Callable[..., DataFrame]


def batch_label(batch: DataFrame, batch_id: int) -> str:
    """Name of a micro-batch: the same when it is run again, unlike that of any other stream."""
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
    return f"b{stream.replace('-', '')[:12]}_{batch_id:08d}"


def pages_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """json, file: the lines of the new files of a folder."""
    reader = spark.readStream.format("text").option("maxFileAge", NO_AGE_LIMIT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(landing_dir).select(F.col("value").alias("json"), F.col("_metadata.file_path").alias("file"))


def start_available_now(pages: DataFrame, checkpoint_dir: str, write: Callable[[DataFrame, str], None]) -> StreamingQuery:
    """Start a run over all new pages; ``write`` gets each micro-batch with its label."""
    return (pages.writeStream.foreachBatch(lambda batch, batch_id: write(batch, batch_label(batch, batch_id)))
            .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())


def write_label(df: DataFrame, label: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace what this label holds in the table, and nothing else."""
    (df.withColumn(BATCH, F.lit(label)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by, BATCH).parquet(path))


def run_available_now(
    spark: SparkSession,
    landing_dir: str,
    parse: Parser,
    sink_dir: str,
    checkpoint_dir: str,
    partition_by: Sequence[str] = (),
    on_batch: Callable[[DataFrame, str], None] | None = None,
    max_files_per_trigger: int | None = None,
) -> None:
    """Process every landing file not processed before, then stop.

    ``on_batch`` gets the parsed batch and its label after it was written, to rebuild
    downstream tables for just the keys the batch touched."""
    def write(batch: DataFrame, label: str) -> None:
        parsed = parse(batch.select("json"))
        write_label(parsed, label, sink_dir, partition_by)
        if on_batch is not None:
            on_batch(parsed.withColumn(BATCH, F.lit(label)), label)

    start_available_now(pages_stream(spark, landing_dir, max_files_per_trigger), checkpoint_dir, write).awaitTermination()


def raw_writer(warehouse, table: str, parse: Parser, telemetry: bool, ingested_at: str | None = None,
               on_batch: Callable[[str], None] | None = None) -> Callable[[DataFrame, str], None]:
    """How a micro-batch of pages gets into a raw table; one pass unless lines are rejected."""
    from racelake.sources.openf1 import write_telemetry

    path = warehouse.path("raw", table)

    def write(batch: DataFrame, label: str) -> None:
        broken = (F.trim("json") != "") & F.try_parse_json("json").isNull()
        seen = Observation()
        rows = parse(batch.observe(seen, F.count_if(broken).alias("broken")).select("json"), ingested_at)
        if telemetry:
            write_telemetry(rows.withColumn(BATCH, F.lit(label)), path, mode="overwrite")
        else:
            write_label(rows, label, path)
        if seen.get["broken"]:
            write_label(batch.filter(broken), label, warehouse.path("raw", f"_rejects/{table}"))
        if on_batch is not None:
            on_batch(label)
    return write


def start_feed(spark: SparkSession, warehouse, landing_dir: str, table: str, write, checkpoint_dir: str | None = None,
               max_files_per_trigger: int | None = None) -> StreamingQuery | None:
    """Start the run of one raw table; None while its folder does not exist."""
    try:
        pages = pages_stream(spark, landing_dir, max_files_per_trigger)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return start_available_now(pages, checkpoint_dir or warehouse.path("state", f"ingest/{table}"), write)


def finish(queries: Sequence[StreamingQuery]) -> None:
    """Wait for all runs; then raise the first failure, if any (the others are complete)."""
    failed = None
    for q in queries:
        try:
            q.awaitTermination()
        except Exception as e:  # noqa: BLE001 - raised below, once all have ended
            failed = failed or e
    if failed is not None:
        raise failed


def stream_telemetry(
    spark: SparkSession,
    landing_dir: str,
    warehouse,
    checkpoint_dir: str | None,
    boundaries: DataFrame,
    location: DataFrame,
    distance: DataFrame,
    smap: DataFrame,
    of1_drivers: DataFrame,
    driver_map: DataFrame,
    max_files_per_trigger: int | None = None,
) -> None:
    """Car-sample pages -> raw car table; after each micro-batch the lap-telemetry mart is
    rebuilt for exactly the sessions with new rows (whole sessions, dynamic partition
    overwrite).  Without a ``checkpoint_dir`` the run shares the ingest log of the batch
    load, so either of the two takes in a file, never both."""
    from racelake.plans.pipeline import read_evolving, rebuild_telemetry
    from racelake.plans.staging import stg_car_data
    from racelake.sources.openf1 import parse_car_data

    def rebuild(_label: str) -> None:
        # only the folders of new labels are read to find their sessions, and only the
        # folders of those sessions are read in full
        car = stg_car_data(read_evolving(spark, warehouse.path("raw", "car_data")))
        rebuild_telemetry(spark, warehouse, car, boundaries, location, distance, smap, of1_drivers, driver_map)

    write = raw_writer(warehouse, "car_data", parse_car_data, telemetry=True, on_batch=rebuild)
    q = start_feed(spark, warehouse, landing_dir, "car_data", write, checkpoint_dir, max_files_per_trigger)
    finish([] if q is None else [q])
