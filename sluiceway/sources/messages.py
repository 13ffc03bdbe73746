"""The message log: JSON lines of interleaved SCHEMA, RECORD and STATE messages.

A *message frame* has the columns

* ``seq``      struct(file, block, line): the order of lines in the log. Only used
               to pick a first or last line and to break ties, never to sort data.
* ``payload``  the line as it stands.
* ``type``, ``stream``  read from the line; Catalyst drops the parse if unused.

Small facts about a log (schemas, the last state) are looked up behind a plain
substring test, so that pass over a large log is bound by reading, not parsing.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.types import StreamSpec

# Types of the envelope keys; `record` is typed per stream.
HEAD = "type STRING, stream STRING"
SCHEMA_BODY = f"{HEAD}, schema STRING, key_properties ARRAY<STRING>, bookmark_properties ARRAY<STRING>"
STATE_BODY = "type STRING, value STRING"


def mentions(*words: str) -> Column:
    """True for every ``payload`` whose JSON can contain one of the words (and maybe for others).

    JSON may write any character as ``\\uXXXX``, so lines with an escape always
    pass. Words with characters JSON escapes in other ways are not tested at all.
    """
    if not all(re.fullmatch(r"[A-Za-z0-9_.\- ]+", word) for word in words):
        return F.lit(True)
    line = F.col("payload")
    return reduce(lambda a, b: a | b, [line.contains(word) for word in (*words, "\\u")])


def parsed_once(payload: Column, schema: str, options: dict[str, str] | None = None) -> Column:
    """Generator that parses a line once and yields its fields as columns.

    A filter on a parsed field is not pushed below a generator. Below a plain
    projection it would be, and every line would be parsed a second time.
    """
    return F.inline(F.array(F.from_json(payload, schema, options or {})))


def with_order(lines: DataFrame) -> DataFrame:
    """Give lines of a batch frame their ``seq``; frames that have one keep it."""
    if "seq" in lines.columns:
        return lines
    located = {"file", "block"} <= set(lines.columns)
    seq = F.struct(
        (F.col("file") if located else F.lit("")).alias("file"),
        (F.col("block") if located else F.lit(0).cast("long")).alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return lines.select(seq.alias("seq"), *[c for c in lines.columns if c not in ("file", "block")])


def _located(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("payload"),
    )


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of a log with their order: ``(seq, payload)``."""
    return with_order(_located(spark.read.text(path)))


def log_identity(spark: SparkSession, path: str | list[str]) -> str:
    """What tells a log on disk from another: its paths, how many files they hold, of how many bytes, and when they changed."""
    told = []
    for given in [path] if isinstance(path, str) else path:
        at = spark._jvm.org.apache.hadoop.fs.Path(given)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in fs.globStatus(at) or []:
            size = fs.getContentSummary(status.getPath())
            told.append(f"{status.getPath()} {size.getFileCount()} {size.getLength()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(told)).encode()).hexdigest()


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Lines of a growing folder of logs, as a stream: ``(file, block, payload)``.

    ``max_files`` or ``max_bytes`` bounds a micro-batch (it takes one file at least). ``with_order`` completes the order inside
    ``foreachBatch``, where the batch is an ordinary frame.
    """
    if max_files and max_bytes:
        raise ValueError("a micro-batch is bounded by files or by bytes, not by both")
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return _located(reader.load(path))


def as_messages(lines: DataFrame) -> DataFrame:
    """Message frame over lines from anywhere (a ``payload`` column, or one text column)."""
    if "payload" not in lines.columns:
        lines = lines.select(F.col(lines.columns[0]).alias("payload"))
    head = F.from_json("payload", HEAD)
    ordered = with_order(lines).withColumn("head", head)
    return ordered.select("seq", "payload", "head.type", "head.stream")


def read_messages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Scan message logs into a message frame."""
    return as_messages(read_lines(spark, path))


def records_of(msgs: DataFrame, stream: str) -> DataFrame:
    """RECORD messages of one stream."""
    return msgs.filter((F.col("type") == "RECORD") & (F.col("stream") == stream))


def declared_schemas(msgs: DataFrame) -> DataFrame:
    """First SCHEMA message of each stream: ``(stream, schema, key_properties, bookmark_properties)``.

    ``min_by`` combines on the map side, so a log that repeats its schema before
    every batch shuffles one row per task and stream.
    """
    body = ("schema", "key_properties", "bookmark_properties")
    return (
        msgs.filter(mentions("SCHEMA"))
        .select("seq", parsed_once(F.col("payload"), SCHEMA_BODY))
        .filter("type = 'SCHEMA' AND stream IS NOT NULL")
        .groupBy("stream")
        .agg(F.min_by(F.struct(*body), "seq").alias("first"))
        .select("stream", "first.*")
    )


def _spec(stream: str, row: Row) -> StreamSpec:
    return StreamSpec(
        stream,
        json.loads(row.schema or "{}"),
        tuple(row.key_properties or ()),
        tuple(row.bookmark_properties or ()),
    )


def stream_specs(msgs: DataFrame) -> dict[str, StreamSpec]:
    """The streams a log declares. Collects one row per stream: metadata only."""
    return {row.stream: _spec(row.stream, row) for row in declared_schemas(msgs).collect()}


@dataclass
class LogFacts:
    """What a log says about itself: schemas, whether it names batch files, and the last state."""

    specs: dict[str, StreamSpec] = field(default_factory=dict)
    batches: bool = False
    state: str | None = None


def log_facts(msgs: DataFrame) -> LogFacts:
    """All facts in a single pass over the log. Collects a row per stream and kind of message."""
    found = (
        msgs.filter(mentions("SCHEMA", "STATE", "BATCH"))
        .select("seq", parsed_once(F.col("payload"), f"{SCHEMA_BODY}, value STRING"))
        .filter("type = 'STATE' OR (type IN ('SCHEMA', 'BATCH') AND stream IS NOT NULL)")
        .groupBy("type", F.when(F.col("type") == "SCHEMA", F.col("stream")).alias("stream"))
        .agg(
            F.min_by(F.struct("schema", "key_properties", "bookmark_properties"), "seq").alias("first"),
            F.max_by("value", "seq").alias("last"),
        )
        .collect()
    )
    facts = LogFacts()
    for row in found:
        if row.type == "SCHEMA":
            facts.specs[row.stream] = _spec(row.stream, row.first)
        elif row.type == "BATCH":
            facts.batches = True
        else:
            facts.state = row.last
    return facts


def unknown_streams(msgs: DataFrame, known: Iterable[str]) -> DataFrame:
    """Streams that have records but no schema, with their record counts."""
    is_known = F.col("stream").isin(*known) if known else F.lit(False)
    return (
        msgs.filter((F.col("type") == "RECORD") & ~F.coalesce(is_known, F.lit(False)))
        .groupBy("stream")
        .agg(F.count("*").alias("records"))
    )


def latest_state(msgs: DataFrame) -> DataFrame:
    """The last STATE of a log as ``(state)``: no row if there is none."""
    return (
        msgs.filter(mentions("STATE"))
        .select("seq", parsed_once(F.col("payload"), STATE_BODY))
        .filter("type = 'STATE'")
        .agg(F.max_by("value", "seq").alias("state"))
        .filter("state IS NOT NULL")
    )
