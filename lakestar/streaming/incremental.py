"""Run the ELT job once per micro-batch of newly arrived raw CSV files.

The file stream discovers new files; each micro-batch goes through the
same ``plans.job.run`` (checks, quarantine, star, append or merge load,
reconciliation, run record). The stream's checkpoint must live on shared
storage: it records which files were processed, so a restarted or failed
driver resumes where it stopped. A micro-batch that had been committed when
the driver failed is delivered again; its run id is made of the stream's id
(which the checkpoint keeps) and the batch's number, so the job finds it in
the run history and loads nothing: every file counts exactly once, in append
mode, too.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.job import Config, PipelineError, run
from ..sources.csv import read_raw_csv


def stream_id(batch: DataFrame) -> str:
    """The id of the stream that a micro-batch belongs to; it outlives restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def run_id_of(stream: str, batch_id: int) -> str:
    return str(uuid.uuid5(uuid.NAMESPACE_OID, f"{stream}/{batch_id}"))


def start_incremental_load(spark: SparkSession, raw_dir: str, warehouse: str, *,
                           checkpoint_location: str, mode: str = "merge",
                           categories: DataFrame | None = None,
                           run_date: dt.date | None = None,
                           available_now: bool = True,
                           fail_on_check_error: bool = True,
                           max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what exists, then stops."""
    if mode not in ("append", "merge"):
        raise ValueError("streaming loads are incremental: mode must be 'append' or 'merge'")
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # The stream only finds the new files; the batch reader reads them, so
    # headers, quoting and surplus fields are treated as in a batch run.
    lines = reader.text(raw_dir).select(F.col("_metadata.file_path").alias("file"))

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        files = sorted(r["file"] for r in batch.distinct().collect())  # one row a file of the trigger
        if not files:
            return
        cfg = Config(warehouse=warehouse, load_mode=mode,
                     run_date=run_date or dt.datetime.now(dt.timezone.utc).date(),
                     run_id=run_id_of(stream_id(batch), batch_id), fail_on_check_error=fail_on_check_error)
        result = run(spark, read_raw_csv(spark, files), cfg, categories=categories)
        if not result.recon_passed:
            # Like a scheduled task: a load that does not reconcile fails the
            # batch, so the stream stops before recording it as processed.
            raise PipelineError(f"post-load reconciliation failed for micro-batch {batch_id}")

    writer = lines.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
