"""Drive the incremental load from a directory of daily extracts with Structured Streaming.

Each extract is announced by one small JSON control record ``{"run_ts": "<iso>", "root": "<dir>"}`` where
``<dir>/<SourceTable>/`` holds that day's Parquet snapshot of every source table. The stream's checkpoint
remembers which control files were processed, and the ledger (``plans.ledger``) which extracts, so each extract is loaded
exactly once; ``availableNow`` processes everything that has arrived and stops (a scheduled job), ``processingTime`` keeps
watching.

Only the control records (one row per day) reach the driver; the data itself is read and processed by the
incremental run's Spark jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from starloom.plans import car_service as CS
from starloom.plans.ledger import Extract, apply_extract
from starloom.sources.store import Store

CONTROL_SCHEMA = "run_ts string, root string"


def load_extract(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{root.rstrip('/')}/{t}") for t in CS.SOURCE_TABLES.values()}


def run_increments(spark: SparkSession, store: Store, control_dir: str, checkpoint_location: str,
                   available_now: bool = True, on_delete: str = "close") -> StreamingQuery:
    """Start the stream; every micro-batch applies its extracts in run-timestamp order, through the ledger: a batch that is
    replayed after a failure skips what was applied and resumes what wasn't, a late extract finds its place."""

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        sess = batch.sparkSession
        for rec in batch.select("run_ts", "root").orderBy("run_ts").collect():
            apply_extract(sess, store, Extract(rec["run_ts"], rec["root"]), load_extract, on_delete=on_delete)

    w = (spark.readStream.schema(CONTROL_SCHEMA).json(control_dir).writeStream
         .foreachBatch(per_batch).option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
