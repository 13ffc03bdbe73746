"""From message lines to table rows, for both table shapes.

Each line is parsed once. Columns that travel beside the record (order, raw
line, reject reason) carry a ``__`` prefix, so they cannot meet a record's keys.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import NameRules, rename_struct
from ..functions.numbers import json_value
from ..functions.types import METADATA_COLUMNS, StreamSpec, to_struct, with_metadata
from ..session import quoted
from ..sources.files import CORRUPT, batch_columns, batch_text
from ..sources.messages import mentions, parsed_once
from .quality import has_keys, reject_reason

SEQ, PAYLOAD, REJECT, OUTCOME = "__seq", "__payload", "__reject", "__outcome"
HIDDEN = (SEQ, PAYLOAD, REJECT, OUTCOME)
#: Where a line goes: into the table, to the rejects of its stream, to the lines of no stream, or it is a bookmark.
#: Lines that name batch files have been followed up already.
GOOD, REJECTED, STRAY, STATE, BATCH = "good", "rejected", "stray", "state", "batch"
OUTCOMES = (GOOD, REJECTED, STRAY, STATE, BATCH)
_KIND = "__kind"
_OPTIONS = {"columnNameOfCorruptRecord": CORRUPT}


def _text(name: str) -> T.StructField:
    return T.StructField(name, T.StringType())


def _envelope(record: T.DataType) -> T.StructType:
    return T.StructType(
        [
            _text("type"),
            _text("stream"),
            T.StructField("time_extracted", T.TimestampType()),
            T.StructField("version", T.LongType()),
            _text("value"),
            T.StructField("record", record),
            _text(CORRUPT),
        ]
    )


def stray_reason(known: Sequence[str]) -> Column:
    """Why a parsed line belongs to no stream; null if it does."""
    declared = F.coalesce(F.col("stream").isin(*known), F.lit(False)) if known else F.lit(False)
    return F.when(F.col("type").isNull(), F.lit("not a message")).when(
        (F.col("type") == "RECORD") & ~declared, F.lit("a record without a schema")
    )


def _parsed(msgs: DataFrame, stream: str, record: T.DataType, prefilter: bool, known: Sequence[str] | None) -> DataFrame:
    """Parsed records of a stream. With the ``known`` streams of the log, lines of no stream and bookmarks stay beside them."""
    lines = msgs.filter(mentions(stream)) if prefilter else msgs
    beside = [F.col("seq").alias(SEQ)] if "seq" in msgs.columns else []
    parsed = lines.select(
        *beside, F.col("payload").alias(PAYLOAD), parsed_once(F.col("payload"), _envelope(record), _OPTIONS)
    )
    kind = F.when((F.col("type") == "RECORD") & (F.col("stream") == stream), F.lit(GOOD))
    if known is not None:
        kind = kind.when(stray_reason(known).isNotNull(), F.lit(STRAY)).when(F.col("type") == "STATE", F.lit(STATE)).when(F.col("type") == "BATCH", F.lit(BATCH))
        why = F.when(F.col("type") == "STATE", F.col("value")).otherwise(F.coalesce(stray_reason(known), F.lit("")))
        parsed = parsed.withColumn("value", why)
    return parsed.withColumn(_KIND, kind).filter(F.col(_KIND).isNotNull())


def _beside(parsed: DataFrame) -> list[str]:
    return [c for c in (SEQ, PAYLOAD, "value", _KIND) if c in parsed.columns]


def _routed(corrupt: Column, keys_ok: Column) -> list[Column]:
    """The reject reason (or a bookmark's value) and the outcome of each line."""
    own = F.col(_KIND) == GOOD
    reason = F.when(own, reject_reason(corrupt, keys_ok)).otherwise(F.col("value"))
    return [reason.alias(REJECT), F.when(own & reason.isNotNull(), F.lit(REJECTED)).otherwise(F.col(_KIND)).alias(OUTCOME)]


def unquoted(text: Column, struct: T.StructType) -> Column:
    """JSON text in which quoted scalars stand bare under properties that are declared as numbers or booleans.

    Only forms that come back exactly are touched: whole numbers of up to 18 digits, decimals of up to 15, ``true`` and
    ``false``. A name that is declared as text anywhere in the schema is left alone.
    """
    kinds: dict[str, set[str]] = {}

    def walk(dtype: T.DataType) -> None:
        if isinstance(dtype, T.ArrayType):
            walk(dtype.elementType)
        elif isinstance(dtype, T.StructType):
            for f in dtype.fields:
                kinds.setdefault(f.name, set()).add(f.dataType.simpleString() if not isinstance(f.dataType, T.StructType) else "struct")
                walk(f.dataType)

    walk(struct)
    for kind, form in _BARE.items():
        names = sorted(n for n, found in kinds.items() if found == {kind} and re.fullmatch(r"[A-Za-z0-9_.\- ]+", n))
        if names:
            any_of = "|".join(re.escape(n) for n in names)
            text = F.regexp_replace(text, f'"({any_of})":"({form})"', '"$1":$2')
    return text


# What a quoted value of each type may look like; it reads back as the same text.
_BARE = {
    "bigint": r"0|-?[1-9][0-9]{0,17}",
    "double": r"0|-?(?:0(?=\.)|[1-9][0-9]{0,14})(?:\.[0-9]{0,14}[1-9])?(?<![0-9.]{17})",
    "boolean": "true|false",
}


def parse_records(
    msgs: DataFrame, spec: StreamSpec, resolver: int = 1, prefilter: bool = True, known: Sequence[str] | None = None
) -> DataFrame:
    """Typed records of a stream, keys as declared: ``record`` plus envelope columns.

    Undeclared keys are dropped. A value that does not fit its type leaves the
    line in ``_corrupt_record``, after a second look that only such lines get:
    written as normalised JSON, ``1.0`` fits an integer, and so does ``"5"``.
    """
    struct = with_metadata(to_struct(spec.json_schema, resolver))
    parsed = _parsed(msgs, spec.name, struct, prefilter, known)
    return settled(parsed, struct, _record_of_line())


def _record_of_line() -> Column:
    """The record of a message line as VARIANT."""
    return F.from_json(PAYLOAD, "record VARIANT")["record"]


def settled(parsed: DataFrame, struct: T.StructType, again: Column) -> DataFrame:
    """Parsed rows after the second look: ``again`` is the record of a line that did not fit, as VARIANT."""
    body = T.StructType([T.StructField("record", struct), _text(CORRUPT)])
    second = F.from_json(F.concat(F.lit('{"record":'), unquoted(F.to_json(again), struct), F.lit("}")), body, _OPTIONS)
    first = F.struct(
        F.col("record"),
        F.when(F.col("record").isNull(), F.coalesce(F.col(CORRUPT), F.col(PAYLOAD)))
        .otherwise(F.col(CORRUPT))
        .alias(CORRUPT),
    )
    chosen = F.when(F.col(CORRUPT).isNull(), first).otherwise(F.coalesce(second, first))
    return parsed.select(*_beside(parsed), "time_extracted", "version", F.inline(F.array(chosen)))


def _envelope_of(rows: DataFrame, stream: str, text: Column, *columns: Column) -> DataFrame:
    """Records that arrive without an envelope, in the columns of :func:`_parsed`; ``text`` is the record's JSON."""
    none, head = F.lit(None), json.dumps({"type": "RECORD", "stream": stream})[:-1] + ', "record": '
    return rows.select(
        F.col("seq").alias(SEQ),
        F.concat(F.lit(head), text, F.lit("}")).alias(PAYLOAD),
        none.cast("timestamp").alias("time_extracted"),
        none.cast("bigint").alias("version"),
        F.lit(GOOD).alias(_KIND),
        *columns,
    )


def _fitted(column: Column, have: T.DataType, want: T.DataType) -> tuple[Column, Column]:
    """A value of a typed file in its declared type, and whether that was possible without loss."""
    if have.simpleString() == want.simpleString():
        return column, F.lit(True)
    if isinstance(want, T.VariantType):
        return json_value(column), F.lit(True)
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        there = {f.name: f for f in have.fields}
        parts = [_fitted(column.getField(f.name), there[f.name].dataType, f.dataType) if f.name in there else (F.lit(None).cast(f.dataType), F.lit(True)) for f in want.fields]
        made = F.struct(*[c.alias(f.name) for (c, _), f in zip(parts, want.fields)])
        fits = reduce(lambda a, b: a & b, [ok for _, ok in parts])
        return F.when(column.isNotNull(), made), column.isNull() | fits
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        inner = lambda at: lambda e: _fitted(e, have.elementType, want.elementType)[at]
        return F.transform(column, inner(0)), column.isNull() | F.forall(column, inner(1))
    if isinstance(want, T.StringType):
        text = column.cast("string") if isinstance(have, T.AtomicType) else F.to_json(column)
        return text, F.lit(True)
    if not (isinstance(have, T.AtomicType) and isinstance(want, T.AtomicType)):
        return F.lit(None).cast(want), column.isNull()
    changed = column.try_cast(want)
    back = changed.cast("string") == column if isinstance(have, T.StringType) and not isinstance(want, (T.TimestampType, T.DateType)) else changed.try_cast(have).eqNullSafe(column)
    return changed, column.isNull() | (changed.isNotNull() & back)


def batch_records(spark: SparkSession, files: Mapping[str, list[str]], spec: StreamSpec, resolver: int | None) -> DataFrame | None:
    """Records of batch files by format, in the columns of :func:`parse_records`; without a ``resolver`` as VARIANT.

    JSON lines are parsed with the stream's schema and get the second look; columns of Parquet files are fitted to it. What does
    not fit is in ``_corrupt_record``, as JSON text.
    """
    struct = with_metadata(to_struct(spec.json_schema, resolver)) if resolver else T.VariantType()
    frames = []
    if "jsonl" in files:
        lines, text = batch_text(spark, files["jsonl"]), F.col("payload")
        if resolver:
            body = T.StructType([T.StructField("record", struct), _text(CORRUPT)])
            rows = lines.select("seq", "payload", parsed_once(F.concat(F.lit('{"record":'), text, F.lit("}")), body, _OPTIONS))
            rows = _envelope_of(rows, spec.name, text, F.col("record"), F.when(F.col(CORRUPT).isNotNull(), text).alias(CORRUPT))
            frames.append(settled(rows, struct, _record_of_line()))
        else:
            record = F.try_parse_json(text)
            frames.append(_envelope_of(lines, spec.name, text, record.alias("record"), F.when(record.isNull(), text).alias(CORRUPT)))
    for rows in batch_columns(spark, files["parquet"]) if "parquet" in files else ():
        text = F.to_json("record")
        record, fits = _fitted(F.col("record"), rows.schema["record"].dataType, struct)
        frames.append(_envelope_of(rows, spec.name, text, record.alias("record"), F.when(~fits, text).alias(CORRUPT)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None


def _instant(value: dt.datetime | str) -> dt.datetime:
    moment = dt.datetime.fromisoformat(value) if isinstance(value, str) else value
    return moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)


def _as_timestamp(value: dt.datetime | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(_instant(value).isoformat()).cast("timestamp")


def _stamps(
    found: Mapping[str, Column], extracted: Column, version: Column, as_of, batch_started=None
) -> dict[str, Column]:
    """The six metadata values of a row received at ``as_of``."""
    return {
        "_sdc_extracted_at": F.coalesce(found["_sdc_extracted_at"], extracted),
        "_sdc_received_at": _as_timestamp(as_of),
        "_sdc_batched_at": _as_timestamp(batch_started or as_of),
        "_sdc_deleted_at": found["_sdc_deleted_at"],
        "_sdc_sequence": F.unix_millis(as_of) if isinstance(as_of, Column) else F.lit(int(_instant(as_of).timestamp() * 1000)).cast("long"),
        "_sdc_table_version": F.coalesce(version, found["_sdc_table_version"]),
    }


def stamp_metadata(df: DataFrame, as_of: dt.datetime | str, batch_started=None) -> DataFrame:
    """Set the metadata columns of a frame.

    The time is an argument, not a clock reading, so a repeated run writes the
    same rows. ``time_extracted`` and ``version`` columns are used if present.
    """
    def column(name: str, dtype: T.DataType) -> Column:
        return F.col(quoted(name)).cast(dtype) if name in df.columns else F.lit(None).cast(dtype)

    found = {n: column(n, t) for n, t in METADATA_COLUMNS.items()}
    extracted = column("time_extracted", T.TimestampType())
    version = column("version", T.LongType())
    stamped = _stamps(found, extracted, version, as_of, batch_started)
    kept = [F.col(quoted(c)) for c in df.columns if c not in (*METADATA_COLUMNS, "time_extracted", "version")]
    return df.select(*kept, *[stamped[n].alias(n) for n in METADATA_COLUMNS])


def _keys_ok(keys: tuple[str, ...], typed: Mapping[str, Column]) -> Column:
    """Every key is in the record. Only rows with a null key are looked up in the JSON again."""
    if not keys:
        return F.lit(True)
    in_doubt = F.lit(any(k not in typed for k in keys))
    for key in keys:
        if key in typed:
            in_doubt = in_doubt | typed[key].isNull()
    again = has_keys(_record_of_line(), keys)
    return F.when(in_doubt, F.coalesce(again, F.lit(False))).otherwise(F.lit(True))


def project_denormalized(
    msgs: DataFrame,
    spec: StreamSpec,
    rules: NameRules | Mapping[str, bool] | None = None,
    resolver: int = 1,
    as_of: dt.datetime | str | None = None,
    hidden: bool = False,
    prefilter: bool = True,
    known: Sequence[str] | None = None,
    more: DataFrame | None = None,
) -> DataFrame:
    """Records of a stream as typed columns.

    Renaming is a cast of the parsed struct to the same struct with ruled names,
    at every depth, so schema and data always agree. ``hidden`` keeps the order,
    raw line, reject reason and outcome beside the columns; ``known`` and ``more`` need it. ``more`` has records that are parsed
    already, in the columns of :func:`parse_records`.
    """
    struct = with_metadata(to_struct(spec.json_schema, resolver))
    target = rename_struct(struct, rules)
    place = {src.name: dst.name for src, dst in zip(struct.fields, target.fields)}
    parsed = parse_records(msgs, spec, resolver, prefilter, known)
    if more is not None:
        parsed = parsed.unionByName(more, allowMissingColumns=True)
    record = F.col("record") if struct == target else F.col("record").cast(target)
    beside = _beside(parsed) if hidden else []
    rows = parsed.select(*beside, "time_extracted", "version", CORRUPT, record.alias("record"))

    def value(name: str) -> Column:
        return F.col("record").getField(place[name])

    columns = {f.name: value(f.name) for f in struct.fields}
    if as_of is not None:
        found = {n: value(n) for n in METADATA_COLUMNS}
        columns.update(_stamps(found, F.col("time_extracted"), F.col("version"), as_of))
    out = [columns[src.name].alias(dst.name, metadata=dst.metadata) for src, dst in zip(struct.fields, target.fields)]
    if hidden:
        rows = rows if "value" in rows.columns else rows.withColumn("value", F.lit(None).cast("string"))
        out += [F.col(c) for c in beside if c in (SEQ, PAYLOAD)]
        out += _routed(F.col(CORRUPT), _keys_ok(spec.key_properties, columns))
    return rows.select(*out)


def project_fixed(
    msgs: DataFrame,
    spec: StreamSpec | str,
    as_of: dt.datetime | str | None = None,
    hidden: bool = False,
    prefilter: bool = True,
    known: Sequence[str] | None = None,
    more: DataFrame | None = None,
) -> DataFrame:
    """Records of a stream in the fixed shape: the record as VARIANT, metadata as columns.

    The metadata keys leave ``data``. Rebuilding an object costs, so only lines
    whose text can hold such a key are rebuilt. ``hidden``, ``known`` and ``more`` are as for :func:`project_denormalized`.
    """
    spec = StreamSpec(spec) if isinstance(spec, str) else spec
    parsed = _parsed(msgs, spec.name, T.VariantType(), prefilter, known)
    parsed = parsed.select(*_beside(parsed), "time_extracted", "version", "record", CORRUPT)
    if more is not None:
        parsed = parsed.unionByName(more, allowMissingColumns=True)
    record = F.col("record")
    may_hold = F.col(PAYLOAD).isNull() | F.col(PAYLOAD).contains("_sdc_") | F.col(PAYLOAD).contains("\\u")
    fields = F.try_variant_get(record, "$", "map<string,variant>")
    rest = F.to_variant_object(F.map_filter(fields, lambda k, _: ~k.isin(*METADATA_COLUMNS)))
    found = {
        n: F.when(may_hold, F.try_variant_get(record, f"$.{n}", t.simpleString())) for n, t in METADATA_COLUMNS.items()
    }
    if as_of is not None:
        found = _stamps(found, F.col("time_extracted"), F.col("version"), as_of)
    data = F.when(may_hold, F.coalesce(rest, record)).otherwise(record)
    rows = parsed.select(
        *(_beside(parsed) if hidden else []),
        *([F.coalesce(F.col(CORRUPT), F.when(record.isNull(), F.coalesce(F.col(PAYLOAD), F.lit("")))).alias(CORRUPT)] if hidden else []),
        data.alias("data"),
        *[found[n].alias(n) for n in METADATA_COLUMNS],
    )
    out = [F.col("data"), *[F.col(n) for n in METADATA_COLUMNS]]
    if hidden:
        rows = rows if "value" in rows.columns else rows.withColumn("value", F.lit(None).cast("string"))
        keys_ok = F.coalesce(has_keys(F.col("data"), spec.key_properties), F.lit(False))
        out += [F.col(c) for c in (SEQ, PAYLOAD) if c in rows.columns]
        out += _routed(F.col(CORRUPT), keys_ok)
    return rows.select(*out)
