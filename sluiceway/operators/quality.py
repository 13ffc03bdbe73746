"""Row checks: which rows may be loaded, and why the others may not."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import quoted
from ..sources.files import CORRUPT

MISSING_KEY = "a key property is missing"
UNREADABLE = "not JSON, or a value does not fit its declared type"


def json_path(*names: str) -> str:
    """A JSON path whose steps are taken literally, whatever characters they hold."""
    return "$" + "".join(f"['{n}']" if '"' in n else f'["{n}"]' for n in names)


def has_keys(data: Column, keys: Iterable[str]) -> Column:
    """Every key is present in a VARIANT object. An explicit null counts as present."""
    tests = [F.variant_get(data, json_path(k), "variant").isNotNull() for k in keys]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _data_of(df: DataFrame) -> Column:
    """The record of each row as VARIANT: the ``data`` column, or the message line."""
    if "data" in df.columns:
        column = F.col("data")
        is_text = isinstance(df.schema["data"].dataType, T.StringType)
        return F.try_parse_json(column) if is_text else column
    return F.from_json("payload", "record VARIANT")["record"]


def keys_present(df: DataFrame, keys: Iterable[str]) -> Column:
    """Presence test for a fixed frame (``data``) or a denormalized one.

    A typed column cannot tell a missing key from a null one. Only rows whose
    typed key is null are looked up in the JSON again.
    """
    keys = list(keys)
    if not keys:
        return F.lit(True)
    again = F.coalesce(has_keys(_data_of(df), keys), F.lit(False))
    typed = [F.col(quoted(k)).isNotNull() for k in keys if k in df.columns]
    if "data" in df.columns or len(typed) < len(keys):
        return again
    return F.when(reduce(lambda a, b: a & b, typed), F.lit(True)).otherwise(again)


def split_valid(df: DataFrame, keys: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that hold every key property, and rows that do not."""
    ok = keys_present(df, keys)
    return df.filter(ok), df.filter(~ok)


def split_corrupt(df: DataFrame, column: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """Rows that were read as declared, and rows that were not."""
    return df.filter(F.col(column).isNull()).drop(column), df.filter(F.col(column).isNotNull())


def reject_reason(corrupt: Column, keys_ok: Column) -> Column:
    """Why a row cannot be loaded; null for good rows."""
    return F.when(corrupt.isNotNull(), F.lit(UNREADABLE)).when(~keys_ok, F.lit(MISSING_KEY))
