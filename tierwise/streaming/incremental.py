"""STR-01: incremental bronze ingestion as a Structured Streaming job.

New source files are picked up by the file source; every micro-batch is merged
into the versioned target by the same ``ingest`` dispatcher as the batch path
(first batch = full load, later batches = keyed upsert of the batch).  With
``trigger(availableNow=True)`` the job processes everything present and stops,
so it can be scheduled like the batch job while the checkpoint remembers which
files were already merged.

Replays are safe: if an executor or the driver dies after a version was published
but before the checkpoint commit, the same epoch is run again.  The manifest notes
the stream and the epoch that published it, so the second run publishes nothing.

``newest_wins`` is for files that arrive out of order or twice.  Copies of a row
delivered within ``repeat_window`` of each other are dropped by the stream's own state
(``dropDuplicatesWithinWatermark`` on the arrival, so no row is ever late and the state
holds one entry for each row of that window, not of the table).  What is left is merged
under a version guard: within a batch and against the table the row with the latest
audit date stays, so an older file never takes back a newer state, however late it comes
and whether or not the state still knows the row.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.digests import row_hash
from ..operators.ingest import LoadResult, ingest
from ..sources.catalog import TableSpec
from ..sources.store import VersionedTable

ARRIVED, CONTENT = "__arrived", "__content"


def _once(stream: DataFrame, spec: TableSpec, repeat_window: str) -> DataFrame:
    """The stream without rows that arrived before, within ``repeat_window``."""
    keyed = stream.withColumns({ARRIVED: F.current_timestamp(), CONTENT: row_hash(stream, stream.columns)})
    once = keyed.withWatermark(ARRIVED, repeat_window).dropDuplicatesWithinWatermark([*spec.keys, CONTENT])
    return once.drop(ARRIVED, CONTENT)


def published(target: VersionedTable, stream_id: str, epoch_id: int) -> bool:
    """Whether the table holds that epoch of the stream already."""
    last = (target.meta().get("streams") or {}).get(stream_id)
    return last is not None and last >= epoch_id


def incremental_ingest(spark: SparkSession, spec: TableSpec, source_dir: str, schema: StructType,
                       target: VersionedTable, as_of, checkpoint: str,
                       max_files_per_trigger: int | None = None, drift: str = "fail",
                       newest_wins: bool = False, repeat_window: str = "2 days") -> list[LoadResult]:
    """Merge every not-yet-seen file of ``source_dir`` into ``target``; a table
    without keys is replaced as a whole by the batch path and refused here."""
    if spec.keyless:
        raise ValueError(f"{spec.name} has no keys: its files cannot be merged one by one")
    if newest_wins and not spec.audit_col:
        raise ValueError(f"{spec.name} has no audit column to tell the newest row by")
    # deliveries may land in sub-folders; they are never partition columns
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    if newest_wins:
        stream = _once(stream, spec, repeat_window)
    # the micro-batch *is* the change set: no look-back window on top of it
    # (the order that picks one of several rows of a key stays that of the batch path)
    batch_spec = dataclasses.replace(spec, audit_col=None, fallback_col=None, sentinel=None, order=spec.dedup_order(),
                                     latest_wins=newest_wins or spec.latest_wins)
    results: list[LoadResult] = []

    def merge_batch(df: DataFrame, epoch_id: int) -> None:
        # the stream's own id, kept in its checkpoint: a new checkpoint is another stream
        stream_id = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if df.isEmpty() or (stream_id and published(target, stream_id, epoch_id)):
            return
        streams = {**(target.meta().get("streams") or {}), **({stream_id: epoch_id} if stream_id else {})}
        results.append(ingest(batch_spec, df, target, as_of, drift=drift, guard=spec.audit_col if newest_wins else None, meta={"streams": streams}))

    q = (stream.writeStream.foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return results
