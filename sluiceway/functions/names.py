"""Table and column naming.

Names are computed once per schema on the driver. The data is then renamed by
position: a struct is cast to the same struct with other field names, which
Spark does without looking at a single row in Python.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import quoted

# Where a new word starts, and what a table name may not hold.
WORD_START = re.compile("((?!^)(?<!_)[A-Z][a-z]+|(?<=[a-z0-9])[A-Z])")
NOT_IN_TABLE_NAME = "[^a-z0-9_]"


@dataclass(frozen=True)
class NameRules:
    """Opt-in column-name rules; all off means names are kept."""

    quote: bool = False
    lower: bool = False
    add_underscore_when_invalid: bool = False
    snake_case: bool = False
    replace_period_with_underscore: bool = False

    @classmethod
    def of(cls, rules: NameRules | Mapping[str, bool] | None) -> NameRules:
        """Accept a mapping too; rules this version does not know are ignored."""
        if isinstance(rules, NameRules):
            return rules
        known = {f.name for f in fields(cls)}
        return cls(**{k: bool(v) for k, v in (rules or {}).items() if k in known})


def transform_name(name: str, rules: NameRules | Mapping[str, bool] | None = None) -> str:
    """Apply the rules to one column name.

    Order: snake case (which lower-cases), lower case, leading digit, quotes,
    periods. A name that arrives in back-quotes leaves in back-quotes.
    """
    r = NameRules.of(rules)
    bare = name.strip("`")
    steps = (
        (r.snake_case, lambda s: WORD_START.sub(r"_\1", s)),
        (r.snake_case or r.lower, str.lower),
        (r.add_underscore_when_invalid, lambda s: f"_{s}" if s[:1].isdigit() else s),
        (r.quote or (name[:1] == "`" and name[-1:] == "`"), lambda s: f"`{s}`"),
        (r.replace_period_with_underscore, lambda s: s.replace(".", "_")),
    )
    for wanted, step in steps:
        if wanted:
            bare = step(bare)
    return bare


def data_name(name: str, rules: NameRules | Mapping[str, bool] | None = None) -> str:
    """The name a column has in the data. Quotes belong to DDL text only."""
    return transform_name(name, rules).strip("`")


def unique_names(names: Iterable[str]) -> list[str]:
    """Suffix repeated names with ``_1``, ``_2``… in the given order.

    JSON keys differ by case and Spark columns by default do not, so names are
    compared without case.
    """
    taken: set[str] = set()
    seen: dict[str, int] = {}
    out = []
    for name in names:
        base, chosen = name.lower(), name
        while chosen.lower() in taken:
            seen[base] = seen.get(base, 0) + 1
            chosen = f"{name}_{seen[base]}"
        taken.add(chosen.lower())
        out.append(chosen)
    return out


def rename_struct(struct: T.StructType, rules: NameRules | Mapping[str, bool] | None = None) -> T.StructType:
    """The same struct, position by position, with ruled and unique names at every level."""
    names = unique_names(data_name(f.name, rules) for f in struct.fields)
    return T.StructType(
        [T.StructField(n, _rename_type(f.dataType, rules), True, f.metadata) for n, f in zip(names, struct.fields)]
    )


def _rename_type(dtype: T.DataType, rules) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return rename_struct(dtype, rules)
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_rename_type(dtype.elementType, rules), True)
    return dtype


def rename(df: DataFrame, rules: NameRules | Mapping[str, bool] | None) -> DataFrame:
    """Rename a frame's columns, down through structs and arrays of structs."""
    target = rename_struct(df.schema, rules)
    return df.select(
        *[_as(F.col(quoted(old.name)), old.dataType, new) for old, new in zip(df.schema.fields, target.fields)]
    )


def _as(column: Column, have: T.DataType, field: T.StructField) -> Column:
    if have.jsonValue() != field.dataType.jsonValue():
        column = column.cast(field.dataType)
    return column.alias(field.name)


def key_names(keys: Iterable[str] | None, rules: NameRules | Mapping[str, bool] | None = None) -> list[str]:
    """Key properties under the column rules."""
    return [data_name(k, rules) for k in keys or ()]


def table_name(stream: Column | str) -> Column:
    """Table name of a stream, as a column expression."""
    column = F.col(stream) if isinstance(stream, str) else stream
    return F.regexp_replace(F.lower(column), NOT_IN_TABLE_NAME, "_")


def table_name_of(stream: str) -> str:
    """Table name of one stream known on the driver."""
    return re.sub(NOT_IN_TABLE_NAME, "_", stream.lower())
