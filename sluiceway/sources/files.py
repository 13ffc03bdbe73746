"""Records that arrive as files: batch files named by a log, and the staged lake."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import table_name_of
from ..functions.types import StreamSpec, to_struct
from ..session import quoted
from .messages import mentions, parsed_once, read_lines

CORRUPT = "_corrupt_record"
BATCH_BODY = (
    "type STRING, stream STRING, encoding STRUCT<format: STRING, compression: STRING>, manifest ARRAY<STRING>"
)


def batch_manifest(msgs: DataFrame) -> DataFrame:
    """Files announced by BATCH messages: ``(stream, file, format, compression)``."""
    return (
        msgs.filter(mentions("BATCH"))
        .select(parsed_once(F.col("payload"), BATCH_BODY))
        .filter("type = 'BATCH'")
        .select("stream", F.explode("manifest").alias("file"), "encoding.format", "encoding.compression")
    )


#: File names that one reader is given; more files are read by several.
FILES_A_READER = 10_000
BATCH_FORMATS = ("jsonl", "parquet")


def batch_files(msgs: DataFrame) -> dict[str, dict[str, list[str]]]:
    """Names of the announced files by stream and format. They come row by row, so no task or buffer holds all names of a
    stream; a repeated name counts once. A format that has no reader here stops the load."""
    found: dict[str, dict[str, list[str]]] = {}
    named = batch_manifest(msgs).select("stream", F.coalesce("format", F.lit("jsonl")).alias("format"), "file").distinct()
    for row in named.toLocalIterator():
        if row.format not in BATCH_FORMATS:
            raise ValueError(f"{row.stream}: batch files in format {row.format}; only {' and '.join(BATCH_FORMATS)} are read")
        found.setdefault(row.stream, {}).setdefault(row.format, []).append(row.file)
    return {stream: {kind: sorted(names) for kind, names in by.items()} for stream, by in found.items()}


def _chunks(files: list[str]) -> list[list[str]]:
    return [files[i : i + FILES_A_READER] for i in range(0, len(files), FILES_A_READER)]


def batch_text(spark: SparkSession, files: list[str]) -> DataFrame:
    """Lines of JSON-lines files with their order: ``(seq, payload)``."""
    parts = [read_lines(spark, some) for some in _chunks(files)]
    return reduce(DataFrame.unionByName, parts).filter(F.trim("payload") != "")


def _merged_parquet(spark: SparkSession, files: list[str]) -> list[DataFrame]:
    """Readers of Parquet files: one, if their schemas can be merged, else those of either half."""
    try:
        return [spark.read.option("mergeSchema", "true").parquet(*files)]
    except Exception as failure:  # a column has another type in some files
        if len(files) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(failure):
            raise
    half = len(files) // 2
    return [*_merged_parquet(spark, files[:half]), *_merged_parquet(spark, files[half:])]


def batch_columns(spark: SparkSession, files: list[str]) -> list[DataFrame]:
    """Rows of Parquet files as ``(seq, record)``, a frame for each set of files whose schemas can be merged. Fields that a file
    lacks are null."""
    seq = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
    )
    readers = [rows for some in _chunks(files) for rows in _merged_parquet(spark, some)]
    return [rows.select(seq.alias("seq"), F.struct(*[F.col(quoted(c)) for c in rows.columns]).alias("record")) for rows in readers]


def json_reader_schema(struct: T.StructType) -> T.StructType:
    """A declared schema plus the column that keeps the text of rows that do not fit it."""
    return T.StructType([*struct.fields, T.StructField(CORRUPT, T.StringType())])


def read_batch_files(
    spark: SparkSession, paths: str | list[str], spec: StreamSpec, resolver: int = 1
) -> DataFrame:
    """Scan JSON-lines files (gzip by suffix) with the declared schema of a stream.

    A gzip file is one task, so producers should keep files to a few hundred MB.
    Rows that do not fit keep their text in ``_corrupt_record``.
    """
    struct = to_struct(spec.json_schema, resolver)
    return (
        spark.read.schema(json_reader_schema(struct))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(paths)
    )


def lake_folder(root: str, stream: str, dataset: str = "default") -> str:
    """Folder of a stream in the lake: ``<root>/<dataset>/<table>``."""
    return f"{root.rstrip('/')}/{dataset}/{table_name_of(stream)}"


def read_lake(
    spark: SparkSession,
    root: str,
    stream: str,
    struct: T.StructType,
    dates: Iterable[str] | None = None,
    batch_ids: Iterable[str] | None = None,
    dataset: str = "default",
) -> DataFrame:
    """Scan the staged files of a stream in one job.

    ``dates`` and ``batch_ids`` are folder levels, so they prune whole folders
    before anything is opened.
    """
    layout = [T.StructField("extracted_date", T.DateType()), T.StructField("batch_id", T.StringType())]
    schema = T.StructType([*json_reader_schema(struct).fields, *layout])
    df = (
        spark.read.schema(schema)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(lake_folder(root, stream, dataset))
    )
    if dates is not None:
        df = df.filter(F.col("extracted_date").isin(*[F.lit(d).cast("date") for d in dates]))
    if batch_ids is not None:
        df = df.filter(F.col("batch_id").isin(*batch_ids))
    return df
