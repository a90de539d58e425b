"""Source readers: relational tables (JDBC, partitioned reads), file snapshots, and the CSV extract with a
quarantine for corrupt records. Every reader applies an explicit schema -- no inference on the hot path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.sources.csv_ranges import read_csv_ranges


def read_jdbc(spark: SparkSession, url: str, table: str, props: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None, fetchsize: int = 10000) -> DataFrame:
    """Read an OLTP table (or ``(query) alias``) in parallel slices of ``partition_column`` (the integer PK).
    Predicates and projections applied later are pushed into the SQL each slice runs."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetchsize)
    for k, v in (props or {}).items():
        r = r.option(k, v)
    if partition_column and lower is not None and upper is not None and num_partitions:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def read_snapshot(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None
                  ) -> DataFrame:
    """A daily extract of a source table as files (parquet / orc / json)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def write_jdbc(df: DataFrame, url: str, table: str, props: Mapping[str, str] | None = None,
               mode: str = "append", batchsize: int = 1000, truncate: bool = False,
               target_columns: list[str] | None = None) -> None:
    """Append (or truncate-and-load) a relational target; ``batchsize`` rows per INSERT batch. With
    ``target_columns``, columns the target lacks are left out."""
    if target_columns is not None:
        df, _ = project_to(df, target_columns)
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batchsize)
    if truncate:
        w = w.option("truncate", "true")
    for k, v in (props or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()


def read_csv_with_quarantine(spark: SparkSession, path: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Read a headered CSV extract as text columns: ``(good, bad)``, which partition its records whatever columns are
    read from them. Files are read by byte ranges, also where quoted values hold line breaks (``sources.csv_ranges``)."""
    return read_csv_ranges(spark, path, columns)


def write_csv(df: DataFrame, path: str) -> None:
    """Write a CSV extract that ``read_csv_with_quarantine`` reads back (empty texts as NULL, which CSV can't tell from
    them)."""
    df.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def project_to(df: DataFrame, target_columns: list[str]) -> tuple[DataFrame, list[str]]:
    """Schema-drift guard: keep only the target's columns (in the target's order); report the dropped ones."""
    keep = [c for c in target_columns if c in df.columns]
    dropped = [c for c in df.columns if c not in target_columns]
    return df.select(*keep), dropped
