"""Mixing sources to target weights, by histograms over hash buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.staging import WORD, col, stage, without

#: Bits of a row's hash, and bits that one histogram resolves.
HASH_BITS = 60
LEVEL_BITS = 12

OUTPUT = ("size", "source_size", "target", "taken")


def text_size(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of an MD5 over id and text."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Target of each source: ``share`` of all sizes by weight, none above ``most`` times its source's size.

    ``sizes`` has ``source`` and ``source_size``, a row a source. Weights repeat in code point order, null last.
    Ranks come from sorted ranges and their counts, shares from one sum a round, so the number of sources is free.
    """
    ranged = stage(
        sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()),
        "mix-sources",
    )
    in_part = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    parts = ranged.groupBy("part").count()
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    starts = parts.select("part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("start"))
    ranked = ranged.withColumn("at", F.row_number().over(in_part) - 1).join(starts, "part")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("start") + F.col("at")) % len(weights) + 1).cast("int"))
    weighed = stage(ranked.select("source", "source_size", weight.alias("weight")), "mix-weights")

    cap = F.col("source_size") * float(most)
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    rate, previous = 0.0, None
    while rate != previous:
        previous = rate
        above = F.col("weight") * F.lit(rate) > cap
        capped, left = weighed.agg(
            F.sum(F.when(above, cap).otherwise(0.0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))
        ).first()
        if not left:
            break
        rate = (share * total - capped) / left
    return weighed.withColumn("target", F.least(F.col("weight") * F.lit(rate), cap))


def mix_plan(sized: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """A row a source: ``source, source_size, target, base, bound``.

    A row is taken ``base`` times, and once more if its hash is under ``bound``. The bound is found top down: sizes
    by source and leading hash bits, the bucket in which the budget runs out, then only that bucket by its next bits,
    until it holds one hash. Bounds grow with the budget, so a smaller mix is part of a larger one.
    """
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    full = F.col("target") >= F.col("source_size")
    plan = stage(
        targets.withColumn("base", F.when(full, F.lit(1)).otherwise(F.lit(0)))
        .withColumn("extra", F.col("target") - F.when(full, F.col("source_size")).otherwise(F.lit(0)))
        .withColumn("before", F.lit(0).cast("long"))
        .withColumn("prefix", F.lit(0).cast("long")),
        "mix-plan",
    )
    state, bits, found = plan.select("source", "extra", "before", "prefix"), 0, []
    while bits < HASH_BITS:
        here = F.shiftright(sized["h"], HASH_BITS - bits) if bits else F.lit(0).cast("long")
        inside = sized.join(state.withColumnRenamed("source", "of"), sized["source"].eqNullSafe(F.col("of")) & (here == F.col("prefix")))
        bits += LEVEL_BITS
        counted = inside.groupBy(
            "source", "extra", "before", F.shiftright("h", HASH_BITS - bits).alias("bucket")
        ).agg(F.sum("size").alias("size"), F.min("h").alias("first"), F.max("h").alias("last"))
        upto = F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))  # at most 4,096 rows
        edge = stage(
            counted.withColumn("upto", upto).where((F.col("upto") > F.col("extra")) & (F.col("upto") - F.col("size") <= F.col("extra"))),
            "mix-level",
        )
        done = edge.where((F.col("first") == F.col("last")) | F.lit(bits >= HASH_BITS))
        nearer = 2 * F.col("upto") - F.col("size") <= 2 * F.col("extra")
        found.append(done.select(F.col("source").alias("of"), F.when(nearer, F.col("last") + 1).otherwise(F.col("first")).alias("bound")))
        rest = edge.where(F.col("first") != F.col("last"))
        if rest.isEmpty():
            break
        state = rest.select("source", "extra", (F.col("upto") - F.col("size")).alias("before"), F.col("bucket").alias("prefix"))
    bounds = found[0]
    for more in found[1:]:
        bounds = bounds.union(more)
    joined = plan.join(bounds, plan["source"].eqNullSafe(bounds["of"]), "left")
    return stage(
        joined.select("source", "source_size", "target", "base", F.coalesce("bound", F.lit(1 << HASH_BITS)).alias("bound")), "mix-bounds"
    )


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Add ``size, source_size, target, taken`` to documents (``doc_id, text, source`` and any others).

    ``taken`` counts the words that the mix takes of a row: 0, 1 or 2 times its size, for ``most`` up to 2.
    A source's sum of ``taken`` is as near its target as whole rows allow. Nothing is sorted, and no row is dropped.

    Null source: a source of its own, last in order. Null or empty text: size 0. Null id: hashed as empty text.
    Rows alike in id and text have one hash and are taken or left together. No rows: no rows. Input columns named
    like an output column are replaced.
    """
    if not 0 <= most <= 2 or share < 0:
        raise ValueError("most must lie between 0 and 2, share must not be negative")
    sized = stage(
        docs.select(col("source").alias("source"), text_size(col("text")).alias("size"), row_hash(col("doc_id"), col("text")).alias("h")),
        "mix-sizes",
    )
    plan = mix_plan(sized, weights, share, most).select(
        F.col("source").alias("__of"), "source_size", "target", F.col("base").alias("__base"), F.col("bound").alias("__bound")
    )
    keep = without(docs, [*OUTPUT, "__of", "__base", "__bound", "__h"])
    measured = keep.withColumn("size", text_size(col("text"))).withColumn("__h", row_hash(col("doc_id"), col("text")))
    times = F.col("__base") + F.when(F.col("__h") < F.col("__bound"), 1).otherwise(0)
    return measured.join(plan, col("source").eqNullSafe(F.col("__of"))).select(
        *[col(c) for c in keep.columns], "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken")
    )
