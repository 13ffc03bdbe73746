"""Written intermediate tables, and column names that cannot clash with a caller's."""

from __future__ import annotations

import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.session import quoted, remove_folder, scratch_path

#: What parts words, everywhere in this subpackage.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below the cluster's shared folder and read it back.

    Cuts the lineage and fixes generated row numbers: a lost executor costs a re-read, not other rows. The driver lets go of the
    query that wrote it, so that a long row of steps takes no more of its memory than one.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    release(df.sparkSession)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def discard(*staged: DataFrame) -> None:
    """Delete staged tables once all that is built on them is staged itself, and have Spark delete the shuffles it no longer needs."""
    for frame in staged:
        remove_folder(frame.sparkSession, frame._staged_at)
    release(staged[0].sparkSession)


def release(spark: SparkSession) -> None:
    """Have the driver let go of what finished queries leave behind: plans, broadcasts and the records of their shuffles.

    Spark's cleaner follows the garbage collector, which an idle heap seldom calls; many jobs in a row fill it first.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark._jvm.System.gc()


def col(name: str) -> Column:
    """A top-level column, whatever characters its name has."""
    return F.col(quoted(name))


def without(df: DataFrame, names) -> DataFrame:
    """Drop the columns that an operator is about to add; names match without regard to case."""
    taken = {n.lower() for n in names}
    return df.select(*[col(c) for c in df.columns if c.lower() not in taken])


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Add a row number that is unique, not dense. It is fixed only once the frame is staged."""
    return df.withColumn(name, F.monotonically_increasing_id())


def retyped(schema: T.StructType) -> T.StructType:
    """The schema with every field nullable, as files give it back."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
