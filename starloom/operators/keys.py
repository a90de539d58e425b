"""Surrogate keys.

* ``hash_key`` (in ``functions``): 60-bit md5 key, no coordination -- the default.
* ``date_hour_key`` / ``flags_mask`` (in ``functions``): smart keys, the lookup join disappears.
* ``dense_key`` (here): consecutive keys ``start + 1 .. start + n`` in natural-key order, without a single-
  partition window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import checkpoint_dir


def dense_key(df: DataFrame, order: Sequence[str], key: str = "key", start: int = 0,
              num_partitions: int | None = None) -> DataFrame:
    """Assign ``start + rank`` by ``order`` (which should be a total order: the natural key).

    Two passes, like ``zipWithIndex``: rows are range-partitioned and sorted by ``order`` and the result is
    checkpointed to the shared checkpoint folder (so both passes see the same rows and a lost executor does not
    reshuffle them); the per-partition row counts -- one number per partition, not per row -- give each
    partition its offset; each row's key is ``start + offset[partition] + position in partition + 1``.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ranged = ranged.checkpoint(eager=True)
    counts = dict(ranged.groupBy("_pid").count().collect())
    offsets, acc = [], start
    for pid in range(max(counts, default=-1) + 1):
        offsets.append(acc)
        acc += counts.get(pid, 0)
    if not offsets:
        return ranged.drop("_pid", "_mid").withColumn(key, F.lit(None).cast("bigint"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    off = F.element_at(F.array(*[F.lit(o).cast("bigint") for o in offsets]), F.col("_pid") + 1)
    return ranged.withColumn(key, (off + pos + 1).cast("bigint")).drop("_pid", "_mid")
