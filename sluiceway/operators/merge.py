"""Keyed merge: latest-row dedupe, upsert, and the checks that guard it.

How the plans scale:

* Dedupe is ``row_number`` filtered to 1. Spark then keeps one row per key and
  task *before* the shuffle (``WindowGroupLimit``), so a key that holds a third
  of the rows reaches its final task as one row per map task.
* Upsert is a left join of the target to the source (updates) and an anti join
  (inserts), not a full outer join: a full outer join can neither broadcast a
  small source nor have a skewed key split by adaptive execution. A small staged
  source is broadcast by Spark's own size check, and the target is not shuffled.
* One key-only pass over the target (``key_matches``) says which source keys it has.
  Conflicts, touched partitions and inserts are all read off it, so a staged
  match costs one narrow scan however many of them are asked for.
* Source rows with a null key can never match, so they skip the joins instead of
  meeting in one task. A key that is hot in the source alone is folded into one
  row, on the map side, before it reaches the update join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import quoted
from .evolve import conform

DEFAULT_ORDER = ("_sdc_extracted_at", "_sdc_received_at", "_sdc_sequence")
SOURCE_ROWS = "source_rows"
_HIT, _REST = "__hit", "__rest"


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """The newest row of each key. Null keys form one group.

    ``order`` runs from most to least important, newest (largest) first, nulls
    last. By default it is extraction time, receipt time, then queueing order.
    """
    chosen = order if order is not None else [c for c in DEFAULT_ORDER if c in df.columns]
    newest = [_column(c).desc_nulls_last() for c in chosen]
    window = Window.partitionBy(*[F.col(quoted(k)) for k in keys]).orderBy(*newest)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def _column(item: str | Column) -> Column:
    return F.col(quoted(item)) if isinstance(item, str) else item


def merge_columns(target: Sequence[str], source: Sequence[str], keys: Sequence[str]) -> list[str]:
    """Columns a merge writes: those both sides have, without regard to case, in target order. Checks the keys."""
    if not keys:
        raise ValueError("an upsert needs key properties")
    there = {c.lower() for c in source}
    shared = [c for c in target if c.lower() in there]
    if not shared:
        raise ValueError("source and target share no columns")
    absent = [k for k in keys if k.lower() not in {c.lower() for c in shared}]
    if absent:
        raise ValueError(f"key properties missing from the shared columns: {', '.join(absent)}")
    return shared


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(quoted(k)).isNull() for k in keys])


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], renamed: dict[str, str]) -> Column:
    return reduce(
        lambda a, b: a & b, [left[quoted(k)] == right[quoted(renamed.get(k, k))] for k in keys]
    )


def key_range(source: DataFrame, keys: Sequence[str]) -> Column:
    """A test on the target's keys that the source's smallest and largest key give, for the scan to skip files by."""
    plain = [k for k in keys if isinstance(source.schema[k].dataType, T.AtomicType)]
    if not plain:
        return F.lit(True)
    ends = [f(F.col(quoted(k))).alias(f"{n}{i}") for i, k in enumerate(plain) for n, f in (("low", F.min), ("high", F.max))]
    found = source.agg(*ends).first()
    if any(v is None for v in found):
        return F.lit(False)
    tests = []
    for i, k in enumerate(plain):
        kind = source.schema[k].dataType
        tests += [F.col(quoted(k)) >= F.lit(found[f"low{i}"]).cast(kind), F.col(quoted(k)) <= F.lit(found[f"high{i}"]).cast(kind)]
    return reduce(lambda a, b: a & b, tests)


def key_matches(target: DataFrame, source: DataFrame, keys: Sequence[str], *beside: str) -> DataFrame:
    """The target's rows whose key the source has: the keys, ``source_rows`` of that key, and columns ``beside``.

    Reads key columns of either side, and ``beside`` of the target. The source's repeats are counted on the map side before they
    can pile up; a key that is hot in the target is split by adaptive execution.
    """
    given = source.filter(~any_null(keys)).groupBy(*_all(keys)).agg(F.count("*").alias(SOURCE_ROWS))
    return target.select(*_all(keys), *_all(beside)).join(given, list(keys), "inner")


def matched_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys that occur on both sides."""
    return key_matches(target, source, keys).select(*_all(keys)).distinct()


def unmatched(source: DataFrame, matched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not among the matched ones; rows with a null key never are."""
    fresh = source.filter(~any_null(keys)).join(matched, list(keys), "left_anti").select(*_all(source.columns))
    return fresh.unionByName(source.filter(any_null(keys)))


def one_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of each key that is not null. Keys that match have one row anyway (see ``conflicts``); hot ones that
    match nothing are folded before the shuffle."""
    others = [c for c in source.columns if c not in keys]
    rest = F.any_value(F.struct(*_all(others))).alias(_REST)
    folded = source.filter(~any_null(keys)).groupBy(*_all(keys)).agg(rest)
    return folded.select(*[F.col(quoted(c)) if c in keys else F.col(_REST).getField(c).alias(c) for c in source.columns])


def _all(columns: Sequence[str]) -> list[Column]:
    return [F.col(quoted(c)) for c in columns]


def updated_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    shared: Sequence[str],
    only_if_newer: bool = False,
    newer_by: str = "_sdc_extracted_at",
) -> DataFrame:
    """The target with matched rows carrying the source's values.

    A matched null overwrites: the choice hangs on the match, not on the value.
    """
    changed = [c for c in shared if c not in keys]
    there = {c: f"__src_{c}" for c in shared}
    incoming = source.select(*[F.col(quoted(c)).alias(there[c]) for c in shared], F.lit(True).alias(_HIT))
    joined = target.join(incoming, _same_keys(target, incoming, keys, there), "left")
    take = F.col(_HIT).isNotNull()
    if only_if_newer:
        mine, theirs = F.col(quoted(newer_by)), F.col(quoted(there[newer_by]))
        take = take & (mine.isNull() | (theirs >= mine))
    return joined.select(
        *[
            (F.when(take, F.col(quoted(there[c]))).otherwise(F.col(quoted(c))) if c in changed else F.col(quoted(c))).alias(c)
            for c in target.columns
        ]
    )


def shared_rows(target: T.StructType, source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The source's shared columns under the target's names and types, and the keys under the target's names."""
    shared = merge_columns(target.fieldNames(), source.columns, keys)
    wanted = {k.lower() for k in keys}
    given = {f.name.lower(): f for f in source.schema.fields}
    columns = [conform(F.col(quoted(given[c.lower()].name)), given[c.lower()].dataType, target[c].dataType).alias(c) for c in shared]
    return source.select(*columns), [c for c in shared if c.lower() in wanted]


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    only_if_newer: bool = False,
    matched: DataFrame | None = None,
) -> DataFrame:
    """The target after a keyed merge with the source.

    Shared non-key columns of matched rows are updated, unmatched rows inserted
    with their shared columns. Source-only columns are dropped; target-only ones
    keep their values on update and are null on insert. With nothing to update
    the merge only inserts. The source should be unique on the keys it shares with
    the target (see ``conflicts``) and cheap to read again: stage it first.
    ``matched`` takes the distinct matched keys where they are known already;
    ``target`` may then leave out rows that match nothing.
    """
    rows, keys = shared_rows(target.schema, source, keys)
    shared = rows.columns
    if only_if_newer and DEFAULT_ORDER[0] not in shared:
        raise ValueError(f"only_if_newer needs {DEFAULT_ORDER[0]!r} on both sides")
    if matched is None:
        matched = matched_keys(target, rows, keys)
    has_updates = any(c not in keys for c in shared)
    kept = updated_rows(target, one_per_key(rows, keys), keys, shared, only_if_newer) if has_updates else target
    padded = unmatched(rows, matched, keys).select(
        *[
            (F.col(quoted(f.name)) if f.name in shared else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.schema.fields
        ]
    )
    return kept.unionByName(padded)


def conflicts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the target that more than one source row would update, with the row counts.

    Such a merge has no defined result. The count combines on the map side.
    """
    return conflicting(key_matches(target, source, keys), keys)


def conflicting(matches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The conflicts among matches that are known already."""
    return matches.filter(F.col(SOURCE_ROWS) > 1).select(*_all(keys), SOURCE_ROWS).distinct()


__all__ = [
    "conflicting", "conflicts", "dedupe_latest", "key_matches", "key_range", "matched_keys", "merge_columns", "one_per_key",
    "shared_rows", "unmatched", "updated_rows", "upsert",
]
