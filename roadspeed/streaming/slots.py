"""Silver as a stream over landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from roadspeed.plans.config import LakeConfig
from roadspeed.plans.slots import apply_files, file_columns

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def stream_slots(
    spark: SparkSession, cfg: LakeConfig, checkpoint: str, files_per_batch: int = 1000, **trigger: object
) -> StreamingQuery:
    """Start a stream that brings each landed raw file into silver; by default it ends when no file is left.

    The stream carries the names of files only; a batch reads their rows. Batches may come twice after a failure, as a file
    replaces its own totals. A file that lands late changes its day and no other, so there is no watermark after which rows
    are lost. A file that is written anew under its old name is not seen; ``refresh_silver`` finds it.
    """
    landed = (
        spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", files_per_batch)
        .load(f"{cfg.zone('raw')}/date=*/*.csv")
    )
    named = landed.select(*file_columns())  # the contents are pruned, so no file is opened

    def bring(batch: DataFrame, _: int) -> None:
        apply_files(batch.sparkSession, cfg, batch)

    writer = named.writeStream.foreachBatch(bring).option("checkpointLocation", checkpoint).queryName("slots")
    return writer.trigger(**(trigger or {"availableNow": True})).start()
