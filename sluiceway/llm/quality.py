"""Quality classifier: a sparse ensemble of rules over text statistics."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.llm.staging import col, quoted, release, stage, without
from sluiceway.llm.textops import SLICE, text_buffer, word_slices

#: Most labelled rows that the rules are fitted on (those of smallest id hash).
SAMPLE_ROWS = 20_000
TREES, DEPTH = 16, 4
#: Lasso strength: the larger, the fewer rules.
LASSO = 0.002
THRESHOLD = 0.7

OUTPUT = ("held_out", "score", "predicted")

STATISTICS = (
    "chars", "words", "word_length", "capital_runs", "symbols", "bangs", "bars", "digits",
    "distinct_words", "repeats", "line_words", "sentences",
)


def _table(keep) -> np.ndarray:
    return np.array([bool(keep(b)) for b in range(256)])


_CHAR = _table(lambda b: b & 0xC0 != 0x80)  # bytes that begin a code point
_SYMBOL = _table(lambda b: chr(b) in r"#$%&*@^~<>{}\/=+_")
_BANG, _BAR, _NEWLINE = (_table(lambda b, c=c: chr(b) == c) for c in "!|\n")
_DIGIT = _table(lambda b: 48 <= b <= 57)
_STOP = _table(lambda b: chr(b) in ".?")
_UPPER = _table(lambda b: 65 <= b <= 90)

#: A rule: conditions (statistic, True for "at most", threshold), all to hold.
Rule = tuple[tuple[str, bool, float], ...]


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from; a null id is not one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def statistics(column) -> np.ndarray:
    """The statistics of each text of an Arrow column, a row a text. Long columns and texts are counted in slices."""
    data, offsets = text_buffer(column)
    n = len(offsets) - 1
    out = {name: np.zeros(n) for name in STATISTICS}
    classes = {"chars": _CHAR, "symbols": _SYMBOL, "bangs": _BANG, "bars": _BAR, "digits": _DIGIT, "sentences": _STOP, "line_words": _NEWLINE}
    for lo in range(int(offsets[0]), int(offsets[-1]), SLICE):
        hi = min(lo + SLICE, int(offsets[-1]))
        raw = data[lo:hi]
        first, last = int(np.searchsorted(offsets, lo, "right")) - 1, int(np.searchsorted(offsets, hi, "left"))
        edges = np.clip(offsets[first : last + 1], lo, hi) - lo
        for name, table in classes.items():
            sums = np.concatenate([[0], np.cumsum(table[raw], dtype=np.int64)])
            out[name][first:last] += np.diff(sums[edges])
        upper = _UPPER[data[lo : min(hi + 2, len(data))]]
        three = np.flatnonzero(upper[:-2] & upper[1:-1] & upper[2:]) + lo
        row = np.searchsorted(offsets, three, "right") - 1
        begins = (three + 2 < offsets[row + 1]) & ((three == offsets[row]) | ~_UPPER[data[np.maximum(three - 1, 0)]])
        np.add.at(out["capital_runs"], row[begins], 1)
    for first, bounds, h, _ in word_slices(column):
        rows = len(bounds) - 1
        owner = np.repeat(np.arange(rows), np.diff(bounds))
        order = np.lexsort((h, owner))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
        at = slice(first, first + rows)
        out["words"][at] = np.diff(bounds)
        out["distinct_words"][at] = np.bincount(owner[order][new], minlength=rows)
        out["repeats"][at] = np.bincount(owner[same], minlength=rows)
    words, chars = np.maximum(out["words"], 1), np.maximum(out["chars"], 1)
    for name in ("capital_runs", "bangs", "bars", "distinct_words", "repeats", "sentences"):
        out[name] /= words
    for name in ("symbols", "digits"):
        out[name] /= chars
    out["word_length"] = out["chars"] / words
    out["line_words"] = out["words"] / (out["line_words"] + 1)
    return np.column_stack([out[name] for name in STATISTICS]) if n else np.zeros((0, len(STATISTICS)))


def with_statistics(docs: DataFrame, prefix: str = "__q_") -> DataFrame:
    """Add the statistics of the whole text, doubles named with a prefix; a null text counts as empty."""
    at = [c.lower() for c in docs.columns].index("text")
    names = [prefix + n for n in STATISTICS]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = statistics(batch.column(at))
            columns = [*batch.columns, *[pa.array(told[:, k]) for k in range(len(names))]]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *names])

    schema = T.StructType(docs.schema.fields + [T.StructField(n, T.DoubleType()) for n in names])
    return docs.mapInArrow(add, schema)


def rules_of(tree_text: str) -> list[Rule]:
    """Every path from a tree's root to a node, as a rule; ``tree_text`` is the forest's printed form."""
    rules: dict[Rule, None] = {}
    path: list[tuple[int, tuple[str, bool, float]]] = []
    for line in tree_text.splitlines():
        if not (m := re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line)):
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth]
        path.append((depth, (STATISTICS[int(m[2])], m[3] == "<=", float(m[4]))))
        rules[simplified(tuple(c for _, c in path))] = None
    return list(rules)


def simplified(rule: Rule) -> Rule:
    """Of several bounds of one kind on one statistic, only the tightest."""
    tight: dict[tuple[str, bool], float] = {}
    for name, most, at in rule:
        known = tight.get((name, most))
        tight[name, most] = at if known is None else (min if most else max)(known, at)
    return tuple((n, m, tight[n, m]) for n, m in sorted(tight))


@dataclass(frozen=True)
class RuleModel:
    """Rules, their weights, and what a text without any rule has."""

    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    def score(self, prefix: str = "__q_") -> Column:
        """The chance of label 1, as a column expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            total = total + F.when(condition(rule, prefix), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def condition(rule: Rule, prefix: str = "__q_") -> Column:
    out = None
    for name, most, at in rule:
        one = F.col(prefix + name) <= at if most else F.col(prefix + name) > at
        out = one if out is None else out & one
    return out


def fit_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> RuleModel:
    """Learn from ``labels(doc_id, quality)`` of documents that are not held out.

    A random forest over the statistics gives the paths, a logistic model with lasso penalty over all of them keeps
    those that matter. At most ``sample_rows`` labels are used, so they can be broadcast; all else is scored by the
    rules. Null labels and ids are passed over; repeated labels count again. Without labels a text has 0.5, with one kind of label only
    (n + 1) / (all + 2).
    """
    asked = labels.select(col("doc_id").alias("__id"), col("quality").cast("double").alias("__label")).where(
        F.col("__id").isNotNull() & F.col("__label").isin(0.0, 1.0) & ~held_out(F.col("__id"))
    )
    asked = asked.orderBy(F.xxhash64("__id"), "__id", "__label").limit(sample_rows)
    texts = docs.select(col("doc_id").alias("__id"), col("text").alias("text")).join(F.broadcast(asked), "__id")
    sample = stage(with_statistics(texts).drop("text"), "quality-sample")
    counts = {r["__label"]: r["count"] for r in sample.groupBy("__label").count().collect()}
    good, every = counts.get(1.0, 0), sum(counts.values())
    if good in (0, every):
        return RuleModel((), (), math.log((good + 1) / (every - good + 1)))
    # ordered, so that the same rows give the same trees
    sample = sample.repartition(4, "__id").sortWithinPartitions("__id", "__label")
    told = stage(sample.select("*", array_to_vector(F.array(*["__q_" + n for n in STATISTICS])).alias("__features")), "quality-features")
    forest = RandomForestClassifier(
        featuresCol="__features", labelCol="__label", numTrees=trees, maxDepth=depth, seed=17, minInstancesPerNode=5, maxBins=64
    ).fit(told)
    rules = rules_of(forest.toDebugString)
    if not rules:
        return RuleModel((), (), math.log((good + 1) / (every - good + 1)))
    release(docs.sparkSession)  # a forest and a logistic model are a hundred jobs
    held = F.array(*[condition(r).cast("double") for r in rules])
    lasso_model = LogisticRegression(featuresCol="__rules", labelCol="__label", elasticNetParam=1.0, regParam=lasso, maxIter=40).fit(
        told.select("__label", array_to_vector(held).alias("__rules"))
    )
    kept = [(r, float(w)) for r, w in zip(rules, lasso_model.coefficients.toArray()) if abs(w) > 1e-6]
    return RuleModel(tuple(r for r, _ in kept), tuple(w for _, w in kept), float(lasso_model.intercept))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **fit) -> DataFrame:
    """Add ``held_out, score, predicted`` to documents (``doc_id, text`` and any others).

    ``predicted`` is 1 where the score is at least ``threshold``. Scores depend on the text alone: its id, source, language and labels are never
    read for them. Rows are scored where they are read, without a shuffle. Null or empty texts are scored like others, by
    the statistics of an empty text. Null ids are not held out. Repeated rows score alike. No rows: no rows. Input
    columns named like an output column are replaced.
    """
    model = fit_rules(docs, labels, **fit)
    release(docs.sparkSession)
    base = without(docs, OUTPUT)
    scored = with_statistics(base)
    return scored.select(
        *[F.col(quoted(c)) for c in base.columns], held_out(col("doc_id")).alias("held_out"), model.score().alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
