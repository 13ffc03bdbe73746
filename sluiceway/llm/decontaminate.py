"""Benchmark decontamination by pigeonhole edit matching."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.staging import col

#: One edit is allowed for so many characters of an item.
CHARS_PER_EDIT = 15
#: Items are searched in blocks of about so many characters, each a pass over the documents.
BLOCK_CHARS = 1_000_000


def normalised(text: str) -> str:
    """Lower case, and runs of white space as one space."""
    return " ".join(text.lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """Split into ``budget`` + 1 pieces of nearly equal length: (offset, piece)."""
    cuts = [k * len(item) // (budget + 1) for k in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks_of(item: str) -> dict[str, int]:
    """Bit i of a character's mask is set where the item has it at i."""
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def nearest(item: str, text: str, budget: int, masks: dict[str, int] | None = None) -> tuple[int, int] | None:
    """Least edit distance of the item to any substring of ``text``, and where the first such one ends; None above the budget.

    Myers' bit-parallel recurrence: a column of the edit matrix as two bit vectors of vertical differences. The
    text may begin anywhere, so no difference enters at the top.
    """
    m = len(item)
    masks = masks if masks is not None else masks_of(item)
    every, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = every, 0, m
    best: tuple[int, int] | None = None
    for end, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        zero = (((eq & up) + up) ^ up) | eq | down
        plus = down | (every & ~(zero | up))
        minus = up & zero
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = plus << 1 & every
        up = (minus << 1 | ~(zero | plus)) & every
        down = plus & zero
        if score <= budget and (best is None or score < best[0]):
            best = (score, end)
    return best


class Matcher:
    """The pieces of a block of items as one automaton."""

    def __init__(self, items: list[tuple[int, str]], chars_per_edit: int) -> None:
        self.items = []
        where: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            budget = len(text) // chars_per_edit
            at = len(self.items)
            self.items.append((item_id, text, budget, masks_of(text)))
            for offset, piece in pieces(text, budget):
                where.setdefault(piece, []).append((at, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def find(self, text: str, first_only: bool = False) -> list[tuple[int, int, int]]:
        """(item id, distance, end) of every item that stands in the normalised text within its budget."""
        spans: dict[int, list[list[int]]] = {}
        for end, (size, places) in self.automaton.iter(text):
            for at, offset in places:
                _, item, budget, _ = self.items[at]
                lo = end + 1 - size - offset - budget
                hi = lo + len(item) + 2 * budget
                known = spans.setdefault(at, [])
                if known and lo <= known[-1][1] and hi >= known[-1][0]:
                    known[-1][0], known[-1][1] = min(lo, known[-1][0]), max(hi, known[-1][1])
                else:
                    known.append([lo, hi])
        out = []
        for at, windows in spans.items():
            item_id, item, budget, masks = self.items[at]
            best = None
            for lo, hi in windows:
                lo = max(0, lo)
                hit = nearest(item, text[lo:hi], budget, masks)
                if hit and (best is None or hit[0] < best[0]):
                    best = (hit[0], lo + hit[1])
            if best:
                out.append((item_id, *best))
                if first_only:
                    return out
        return out


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size; no more than one block and one row is held."""
    block, size = [], 0
    for row in items.select(col("item_id").alias("item_id"), col("text").alias("text")).where("text is not null").toLocalIterator():
        text = normalised(row["text"])
        if not text:
            continue
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    if block:
        yield block


def find_leaks(docs: DataFrame, items: DataFrame, chars_per_edit: int = CHARS_PER_EDIT, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, distance, found_end``: each benchmark item that stands in a document.

    Texts are lower-cased and their white space collapsed. An item of m characters may differ by m //
    ``chars_per_edit`` edits. It is split into one piece more than that; then one piece at least stands unchanged.
    Exact hits of pieces are found in one pass over the whole text, and the text around a hit is compared by Myers' bit-parallel distance.
    ``distance`` is the least over the text, ``found_end`` the first place where it is reached.

    The items are a query set against all rows, in blocks of at most ``block_chars`` characters (or one item); documents
    are read once a block and never shuffled. Null or blank items and texts match nothing. Repeated items or documents
    give their rows again; null ids stay null. No rows on either side: no rows. Other columns are left out.
    """
    texts = docs.select(col("doc_id").alias("doc_id"), col("text").alias("text")).where("text is not null")
    out = None
    for block in _blocks(items, block_chars):

        def scan(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, chars_per_edit)
            for batch in batches:
                rows: list[tuple] = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    rows += [(doc_id, *hit) for hit in matcher.find(normalised(text.as_py()))]
                cols = list(zip(*rows)) if rows else [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (batch.schema.field("doc_id").type, pa.int64(), pa.int32(), pa.int64()))],
                    ["doc_id", "item_id", "distance", "found_end"],
                )

        schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, item_id long, distance int, found_end long"
        part = texts.mapInArrow(scan, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return texts.select("doc_id", F.lit(None).cast("long").alias("item_id"), F.lit(0).alias("distance"), F.lit(0).cast("long").alias("found_end")).limit(0)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, chars_per_edit: int = CHARS_PER_EDIT, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents in which :func:`find_leaks` finds no item, all columns kept. Null and blank texts stay."""
    at = [c.lower() for c in docs.columns].index("text")
    for block in _blocks(items, block_chars):

        def clean(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, chars_per_edit)
            for batch in batches:
                keep = [text is None or not matcher.find(normalised(text), True) for text in map(lambda v: v.as_py(), batch.column(at))]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
