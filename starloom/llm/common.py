"""Shared pieces of the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a maximal run of characters that are none of the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda variable over a one-element array. Plain substitution
    would evaluate the expression again at every mention."""
    return F.transform(F.array(value), use)[0]


def keep(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``name`` as a computed value that later projections read instead of repeating ``value`` (the optimizer
    merges neighbouring projections, but not across a generator). Always one output row per row."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow(run, schema)`` in workers that can import this package from where the driver did, however the
    driver found it. (On a cluster without a shared installation the package is passed to the job as usual.)"""
    env, root = df.sparkSession.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df.mapInArrow(run, schema)


def slices(rows: Iterable, weight, limit: int) -> Iterator[list]:
    """Consecutive slices of ``rows`` with at most ``limit`` total weight each (a heavier row is alone), so that a
    batch of very long texts never has all its intermediate arrays in memory at once."""
    out, total = [], 0
    for r in rows:
        w = weight(r)
        if out and total + w > limit:
            yield out
            out, total = [], 0
        out.append(r)
        total += w
    if out:
        yield out
