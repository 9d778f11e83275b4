"""UPL-9, incremental form: ingest an upload folder with Structured Streaming.

A file source lists the new uploads; ``foreachBatch`` reads each file of the
micro-batch with the batch reader (so columns are mapped by their normalised
header, in any order, and a file that lacks a column fails) and runs the same
cleanse / resolve / load as a single upload.  ``maxFilesPerTrigger=1`` gives one
micro-batch per file; ``Trigger.AvailableNow`` processes what is there and
stops.  Loads are idempotent (insert-or-ignore on a deterministic order number,
exact customer names first, upsert on (date, drug)), and each file of an epoch is
a batch that the warehouse loads and records once, so a micro-batch replayed
after an executor or driver failure writes no row and no ledger entry twice.  Progress lives in the
checkpoint folder under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from medistar.params import Params
from medistar.plans.pipeline import load_upload
from medistar.plans.warehouse import Warehouse
from medistar.session import shared_path
from medistar.sources.uploads import read_upload


def upload_stream(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """Streaming DataFrame of the paths of new uploads (their content is not read here)."""
    return (spark.readStream.format("binaryFile").schema(
                "path string, modificationTime timestamp, length long, content binary")
            .option("pathGlobFilter", "*.csv*").option("maxFilesPerTrigger", files_per_batch)
            .load(folder).select("path"))


def start_upload_stream(spark: SparkSession, folder: str, kind: str, wh: Warehouse, params: Params | None = None,
                        checkpoint: str | None = None, available_now: bool = True, reports: list | None = None):
    params = params or Params()
    ckpt = checkpoint or shared_path(spark, "streams", f"uploads_{kind}")

    # epochs are numbered per checkpoint, so the checkpoint is part of a batch's name
    stream = hashlib.sha1(ckpt.encode()).hexdigest()[:8]
    staging = shared_path(spark, "streams", f"uploads_{kind}_staging")

    def run_batch(df: DataFrame, epoch_id: int) -> None:
        # at most files_per_batch paths; each file is staged as a table, then loaded with
        # the job's own session; a replayed epoch overwrites its own staging folder
        for i, row in enumerate(df.orderBy("path").collect()):
            up = read_upload(spark, row["path"])
            if up.kind != kind:
                raise ValueError(f"{row['path']} is an upload of kind {up.kind}, not {kind}")
            path = f"{staging}/epoch={epoch_id}/file={i}"
            up.df.write.mode("overwrite").parquet(path)
            batch = spark.read.parquet(path)
            one = params.with_(batch_id=f"{params.batch_id}_STREAM_{stream}_{epoch_id}_{i}", once=True)
            rep = load_upload(batch, kind, wh, one)
            if reports is not None:
                reports.append({"epoch": epoch_id, **rep})

    w = upload_stream(spark, folder).writeStream.foreachBatch(run_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
