"""The staged lake: gzip JSON lines under dated folders, loaded into a table at the end."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import quoted
from ..sources.files import CORRUPT, lake_folder, read_lake

# JSON timestamps with microseconds; the writer's default keeps milliseconds.
WALL_CLOCK_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TIMESTAMP_PATTERN = WALL_CLOCK_PATTERN + "XXX"


def batch_exists(spark: SparkSession, folder: str, batch_id: str) -> bool:
    """Whether a batch id is in the lake already. Looks at folder names only."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/extracted_date=*/batch_id={batch_id}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def drop_batch(spark: SparkSession, folder: str, batch_id: str) -> None:
    """Delete a batch that was refused, so that a corrected retry can be staged."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/extracted_date=*/batch_id={batch_id}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(path) or []:
        fs.delete(status.getPath(), True)


#: Text of one gzip file, which no reader can split, before compression. Rows whose text is measured for it.
FILE_BYTES, MEASURED = 256 << 20, 1_000
#: With up to so many dates every task may write a file for each.
FEW_DATES = 4


def rows_of_a_file(df: DataFrame, most: int | None = None) -> int:
    """How many rows a file of about ``FILE_BYTES`` has, by the mean text of a bounded number of rows."""
    text = F.octet_length(F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns])))
    mean = df.limit(MEASURED).agg(F.avg(text).alias("b")).first()["b"] or 1.0
    fits = max(1, int(FILE_BYTES / max(mean, 1.0)))
    return min(fits, most) if most else fits


def stage_to_lake(
    df: DataFrame,
    root: str,
    stream: str,
    batch_id: str,
    as_of: dt.datetime,
    dataset: str = "default",
    max_records_per_file: int | None = None,
) -> str:
    """Write rows to ``<root>/<dataset>/<table>/extracted_date=…/batch_id=…`` and return the folder.

    The date is the record's own extraction date, or that of ``as_of`` if it has
    none. Where there are few dates tasks write what they hold, without a shuffle. Else rows
    are dealt by date and part of a date, as many parts as its rows need, so that files grow neither with tasks times dates
    nor with the rows of one date. gzip cannot be split on reading, so files are bounded in bytes.
    A batch that is there already is never written over. ``df`` is read twice and should come from files.
    """
    spark = df.sparkSession
    folder = lake_folder(root, stream, dataset)
    if batch_exists(spark, folder, batch_id):
        raise FileExistsError(f"batch {batch_id} is already staged under {folder}")
    extracted = F.col("_sdc_extracted_at") if "_sdc_extracted_at" in df.columns else F.lit(None).cast("timestamp")
    dated = df.withColumn("extracted_date", F.coalesce(extracted.cast("date"), F.lit(as_of.date())))
    most = rows_of_a_file(df, max_records_per_file)
    dates = dated.groupBy("extracted_date").agg(F.ceil(F.count("*") / most).cast("int").alias("parts"))
    told = dates.agg(F.count("*").alias("dates"), F.sum("parts").alias("parts")).first()
    if told["dates"] > FEW_DATES:
        # a row a date, so small enough for Spark to broadcast by its own measure
        counted = dated.join(dates, "extracted_date")
        part = F.pmod(F.monotonically_increasing_id(), F.col("parts"))  # rows come from files, in their order
        dated = counted.withColumn("parts", part).repartition(int(told["parts"]), "extracted_date", "parts").drop("parts")
    (
        dated.withColumn("batch_id", F.lit(batch_id))
        .write.mode("append")
        .partitionBy("extracted_date", "batch_id")
        .option("compression", "gzip")
        .option("timestampFormat", TIMESTAMP_PATTERN)
        .option("timestampNTZFormat", WALL_CLOCK_PATTERN)
        .option("maxRecordsPerFile", most)
        .json(folder)
    )
    return folder


def lake_load(
    spark: SparkSession,
    root: str,
    stream: str,
    struct: T.StructType,
    batch_ids: Iterable[str] | None = None,
    dates: Iterable[str] | None = None,
    dataset: str = "default",
) -> DataFrame:
    """All staged rows of a stream as table rows, in one job. Rows that do not fit fail the load."""
    rows = read_lake(spark, root, stream, struct, dates, batch_ids, dataset)
    whole = F.when(F.col(CORRUPT).isNull(), F.lit(None)).otherwise(
        F.raise_error(F.concat(F.lit("staged row does not fit the table: "), F.col(CORRUPT)))
    )
    return rows.filter(whole.cast("string").isNull()).drop(CORRUPT, "extracted_date", "batch_id")
