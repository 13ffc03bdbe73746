"""LM scoring by a hashed maximum-entropy model: a softmax over word classes, and one over the words of a class."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceway.llm.staging import col, discard, numbered, release, stage
from sluiceway.llm.textops import mix, text_buffer, word_slices

#: Classes: the end, so many frequent words each alone, and for all others so many frequent endings (three bytes) each
#: alone, the rest of the endings by hash.
ALONE, ENDINGS, HASHED_ENDINGS = 79, 96, 16
CLASSES = 1 + ALONE + ENDINGS + HASHED_ENDINGS
#: Rows of hashed bigram features, besides those of the bias, the word before and the word before that.
BIGRAM_ROWS = 4_096
#: Counts that fit into what is sent to tasks; words beyond are counted by a join.
SENT_WORDS = 1 << 18
#: Gradient updates, and the strength of the Gaussian prior in counts.
UPDATES, PRIOR = 24, 3.0

#: The pair of words before a token is a feature of the word: what is taken off its counts, the strength of the prior of its
#: weights, and their gradient updates.
DISCOUNT, WORD_PRIOR, WORD_UPDATES = 0.5, 0.5, 1
#: Pairs are dealt to blocks by the first bits of their hashes, and blocks are learned from and looked up in so many turns; only one
#: turn's tokens are on disk at a time.
BLOCK_BITS, TURNS = 12, 4
#: Tokens that a task adds up at once.
ADDED = 1 << 20

_END = np.uint64(0x5851F42D4C957F2D)  # the hash that stands for the end of a text
_BEGIN, _ONE, _TWO = np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_HISTORY = CLASSES + 1  # a class before, or the beginning
_CONTEXTS = _HISTORY * _HISTORY
_ROWS = 1 + 2 * _HISTORY + BIGRAM_ROWS


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from; a null id is not one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 == 2


@dataclass
class Scheme:
    """What tells a token's class: sorted hashes of the words that are a class each, sorted endings likewise."""

    alone: np.ndarray
    endings: np.ndarray

    def classes(self, hashes: np.ndarray, tails: np.ndarray) -> np.ndarray:
        out = 1 + ALONE + ENDINGS + (mix(tails.astype(np.uint64)) % np.uint64(HASHED_ENDINGS)).astype(np.int64)
        for known, values, first in ((self.endings, tails, 1 + ALONE), (self.alone, hashes, 1)):
            if len(known):
                at = np.minimum(np.searchsorted(known, values), len(known) - 1)
                out = np.where(known[at] == values, first + at, out)
        return np.where(hashes == _END, 0, out)


def _token_slices(column) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, token offsets of its rows, token hashes, endings), an end behind each row's words."""
    for first, bounds, h, tails in word_slices(column):
        ends = bounds[1:]
        yield first, bounds + np.arange(len(bounds)), np.insert(h, ends, _END), np.insert(tails, ends, 0)


def _contexts(classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The two classes before each token as one number; ``starts``: where rows begin."""
    one = np.empty(len(classes), np.int64)
    one[1:] = classes[:-1]
    one[starts] = CLASSES
    two = np.empty(len(classes), np.int64)
    two[1:] = one[:-1]
    two[starts] = CLASSES
    return two * _HISTORY + one


def word_pairs(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The two words before each token, hashed; ``starts``: where rows begin."""
    one = np.empty(len(h), np.uint64)
    one[1:] = h[:-1]
    one[starts] = _BEGIN
    two = np.empty(len(h), np.uint64)
    two[1:] = one[:-1]
    two[starts] = _BEGIN
    return mix(one * _ONE + two * _TWO)


def weight_keys(pairs: np.ndarray, classes: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the normaliser of a class after a pair, and the weight of a word after a pair, are looked up by."""
    return mix(pairs * _ONE + classes.astype(np.uint64)), mix(pairs * _TWO + h)


def feature_rows(contexts: np.ndarray) -> np.ndarray:
    """Weight rows of each context: bias, word before, skip to the word before that, and both hashed."""
    one, two = contexts % _HISTORY, contexts // _HISTORY
    both = (mix(contexts.astype(np.uint64) + np.uint64(1)) % np.uint64(BIGRAM_ROWS)).astype(np.int64)
    return np.stack([np.zeros_like(one), 1 + one, 1 + _HISTORY + two, 1 + 2 * _HISTORY + both], axis=1)


def log_chances(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Natural log softmax over classes for each line of feature rows."""
    z = weights[rows].sum(1)
    z -= z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


@dataclass
class Model:
    """What scoring sends to tasks; bounded by the constants above, whatever the corpus."""

    scheme: Scheme
    words: np.ndarray  # sorted hashes of words whose counts are here
    counts: np.ndarray
    classes: np.ndarray
    weights: np.ndarray
    class_log: np.ndarray  # log10 of sizes
    total: int  # N
    kinds: int  # V
    sizes: np.ndarray  # each class's count, kinds and one unseen word together


def count_words(texts: DataFrame) -> DataFrame:
    """``h, tail, n``: how often each token occurs. Tasks add up what they read before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, classes = [], []
            for _, _, h, c in _token_slices(batch.column(0)):
                hashes.append(h)
                classes.append(c)
            if hashes:
                h, at, n = np.unique(np.concatenate(hashes), return_index=True, return_counts=True)
                c = np.concatenate(classes)[at]
                for i in range(0, len(h), 200_000):
                    part = slice(i, i + 200_000)
                    yield pa.RecordBatch.from_arrays([pa.array(h[part].view(np.int64)), pa.array(c[part].astype(np.int32)), pa.array(n[part])], ["h", "tail", "n"])

    return texts.select("text").mapInArrow(count, "h long, tail int, n long").groupBy("h").agg(F.min("tail").alias("tail"), F.sum("n").alias("n"))


def count_events(texts: DataFrame, scheme: Scheme) -> DataFrame:
    """``context, counts``: how often each class follows each pair of classes, at most one row a pair."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(_CONTEXTS * CLASSES, np.int64)
        for batch in batches:
            for _, bounds, h, tails in _token_slices(batch.column(0)):
                c = scheme.classes(h, tails)
                np.add.at(cells, _contexts(c, bounds[:-1]) * CLASSES + c, 1)
        some = np.flatnonzero(cells)
        for i in range(0, len(some), 200_000):
            part = some[i : i + 200_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array((part // CLASSES).astype(np.int32)), pa.array((part % CLASSES).astype(np.int32)), pa.array(cells[part])], ["context", "class", "n"]
            )

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for told in batch.column("told").to_pylist():
                row = np.zeros(CLASSES, np.int64)
                row[[x["class"] for x in told]] = [x["n"] for x in told]
                rows.append(row.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("context"), pa.array(rows, pa.binary())], ["context", "counts"])

    summed = texts.select("text").mapInArrow(count, "context int, class int, n long").groupBy("context", "class").agg(F.sum("n").alias("n"))
    told = summed.groupBy("context").agg(F.collect_list(F.struct("class", "n")).alias("told"))  # at most CLASSES entries
    return told.mapInArrow(dense, "context int, counts binary")


def count_pairs(texts: DataFrame, scheme: Scheme) -> DataFrame:
    """``pair, cls, h, n``: how often each word follows a pair of words that occurs more than once.

    Every token of every text counts. Tasks add up ``ADDED`` tokens at a time; rows are dealt by pair then, which serves both sums. As
    many rows as the corpus has, without a bound.
    """

    def summed(told: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        pairs, h, c = (np.concatenate(x) for x in zip(*told))
        _, at, n = np.unique(weight_keys(pairs, c, h)[1], return_index=True, return_counts=True)
        for i in range(0, len(at), 200_000):
            j, m = at[i : i + 200_000], n[i : i + 200_000]
            columns = [pa.array(pairs[j].view(np.int64)), pa.array(c[j].astype(np.int32)), pa.array(h[j].view(np.int64)), pa.array(m)]
            yield pa.RecordBatch.from_arrays(columns, ["pair", "cls", "h", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told, held = [], 0
            for _, bounds, h, tails in _token_slices(batch.column(0)):
                told.append((word_pairs(h, bounds[:-1]), h, scheme.classes(h, tails)))
                held += len(h)
                if held >= ADDED:
                    yield from summed(told)
                    told, held = [], 0
            if told:
                yield from summed(told)

    dealt = texts.select("text").mapInArrow(count, "pair long, cls int, h long, n long").repartition("pair")
    words = dealt.groupBy("pair", "cls", "h").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy("pair"))
    return words.withColumn("all", total).where("all > 1").drop("all")


def train_words(counted: DataFrame, vocabulary: DataFrame, sizes: np.ndarray, updates: int = WORD_UPDATES) -> DataFrame:
    """``pair, cls, h, lam, extra``: weights of words after pairs, and what their class's normaliser has beyond 1.

    Within class c, after a pair of words, a word has the chance b * exp(lam) / (1 + extra): b is its share of the class, lam its
    weight (0 without one), and extra the sum of b * (exp(lam) - 1) over the words that have one, so chances sum to 1. Counts less
    ``DISCOUNT`` are what the weights should make the model expect. They begin where model and counts are mixed evenly;
    each update is a gradient step over all words, scaled by a bound of the curvature. Rows are dealt by pair once, and all sums are
    over the rows of one pair and class. The table grows with the corpus, and the driver sees nothing of it.
    """
    size = F.get(F.array(*[F.lit(float(x)) for x in np.maximum(sizes, 1)]), F.col("cls"))
    words = counted.join(vocabulary.select("h", F.col("n").alias("c")), "h")
    target = F.greatest(F.col("n") - F.lit(DISCOUNT), F.lit(0.0))
    of_class = Window.partitionBy("pair", "cls")
    table = words.select("pair", "cls", "h", target.alias("n"), ((F.col("c") + 1.0) / size).alias("b")).repartition("pair")
    table = table.withColumn("seen", F.sum("n").over(of_class)).withColumn("lam", F.log1p(F.col("n") / (F.col("seen") * F.col("b"))))
    extra = F.sum(F.col("b") * F.expm1("lam")).over(of_class)
    for _ in range(updates):
        table = table.withColumn("extra", extra)
        expected = F.col("seen") * F.col("b") * F.exp("lam") / (1 + F.col("extra"))
        step = (F.col("n") - expected - WORD_PRIOR * F.col("lam")) / (F.greatest(expected, "n") + WORD_PRIOR)
        table = table.withColumn("lam", F.col("lam") + step)
    return table.withColumn("extra", extra).select("pair", "cls", "h", "lam", "extra")


def train_weights(events: DataFrame, updates: int = UPDATES) -> np.ndarray:
    """Fit the class softmax to the counted events by full gradients, each a job over all contexts.

    Every task adds its contexts' expectations by weight row; the driver holds the weights (bounded) and takes a step
    scaled by a bound of the curvature. The bias starts at the log frequencies of the classes.
    """
    spark = events.sparkSession

    def expected(weights: np.ndarray | None) -> np.ndarray:
        """Sums by weight row and class: as observed without weights, else as the model expects them."""
        sent = spark.sparkContext.broadcast(None if weights is None else weights.astype(np.float32))

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w = sent.value
            out, touched = np.zeros((_ROWS, CLASSES)), np.zeros(_ROWS, bool)
            for batch in batches:
                for i in range(0, batch.num_rows, 2048):
                    part = batch.slice(i, 2048)
                    n = np.frombuffer(b"".join(part.column("counts").to_pylist()), np.int64).reshape(-1, CLASSES)
                    rows = feature_rows(part.column("context").to_numpy().astype(np.int64))
                    told = n if w is None else np.exp(log_chances(w, rows)) * n.sum(1, keepdims=True)
                    for k in range(rows.shape[1]):
                        order = np.argsort(rows[:, k], kind="stable")
                        keys, at = np.unique(rows[order, k], return_index=True)
                        out[keys] += np.add.reduceat(told[order], at, axis=0)
                    touched[rows.ravel()] = True
            some = np.flatnonzero(touched)
            packed = [out[r].astype(np.float32).tobytes() for r in some]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(packed, pa.binary())], ["row", "sums"])

        total = np.zeros((_ROWS, CLASSES))
        for r in events.mapInArrow(add, "row int, sums binary").toLocalIterator(prefetchPartitions=True):
            total[r["row"]] += np.frombuffer(r["sums"], np.float32)
        sent.destroy()
        return total

    observed = expected(None)
    weights = np.zeros((_ROWS, CLASSES))
    if not observed.any():
        return weights
    weights[0] = np.log((observed[0] + 0.5) / (observed[0] + 0.5).sum())
    bias = weights[0].copy()
    for _ in range(updates):
        model = expected(weights)
        pull = weights.copy()
        pull[0] -= bias
        # a context has one row of each of the four kinds, so a fourth of the diagonal step cannot overshoot
        weights -= (model - observed + PRIOR * pull) / (4 * np.maximum(model, observed) + PRIOR)
    return weights


def fit_model(texts: DataFrame) -> tuple[Model, DataFrame, DataFrame]:
    """The model, the counts of all training words (``h, tail, n``) and the weights of words (see :func:`train_words`); the latter two
    stay tables, and the weights are worked out only if asked for: scoring learns them block by block (see :func:`tied_gains`)."""
    vocabulary = stage(count_words(texts), "lm-words")
    total, kinds = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # the least count at which no more than SENT_WORDS words are left, from a histogram of bounded size
    step = F.floor(F.log2("n") * 16).cast("int")
    steps = sorted(((r["s"], r["count"]) for r in vocabulary.groupBy(step.alias("s")).count().collect()), reverse=True)
    least, held = 1 << 62, 0
    for s, n in steps:
        if held + n > SENT_WORDS:
            break
        least, held = s, held + n
    often = vocabulary.where(step >= least).select("h", "tail", "n").toArrow()
    words = often.column("h").to_numpy().view(np.uint64)
    order = np.argsort(words)
    words, counts, last = words[order], often.column("n").to_numpy()[order], often.column("tail").to_numpy()[order].astype(np.uint32)
    rank = np.lexsort((words, -counts))
    alone = np.sort(words[[i for i in rank[: ALONE + 1] if words[i] != _END][:ALONE]])
    tails = vocabulary.where(F.col("tail") != 0).groupBy("tail").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "tail").limit(ENDINGS)
    scheme = Scheme(alone, np.sort(np.array([r["tail"] for r in tails.collect()], np.uint32)))

    def class_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(CLASSES)
        for batch in batches:
            c = scheme.classes(batch.column("h").to_numpy().view(np.uint64), batch.column("tail").to_numpy().astype(np.uint32))
            out += np.bincount(c, batch.column("n").to_numpy() + 1, CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], ["sizes"])

    size = np.zeros(CLASSES)
    for r in vocabulary.mapInArrow(class_sizes, "sizes array<double>").toLocalIterator():
        size += np.array(r["sizes"])
    size[1 + ALONE :] += 1  # a word not seen in training; classes of one word have none
    events = stage(count_events(texts, scheme).repartition(8, "context"), "lm-events")
    weights = train_weights(events)
    discard(events)
    release(texts.sparkSession)
    after = train_words(count_pairs(texts, scheme), vocabulary, size)
    sizes = np.maximum(size, 1)
    return Model(scheme, words, counts, scheme.classes(words, last), weights, np.log10(sizes), int(total), int(kinds), sizes), vocabulary, after


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, where each stands, and which each of the given ones is."""
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    at = np.empty(len(keys), np.int64)
    at[order] = np.cumsum(new) - 1
    return keys[order[new]], order[new], at


def word_weights(pairs: np.ndarray, words: np.ndarray, c: np.ndarray, classes: np.ndarray, n: np.ndarray, sizes: np.ndarray, updates: int = WORD_UPDATES):
    """:func:`train_words` for all words after some pairs, each word after a pair once: sorted keys of words after pairs and their log10
    weights less normalisers, then sorted keys of classes after pairs and their normalisers. Pairs that occur once have none."""
    _, _, at = _distinct(pairs)
    some = np.flatnonzero(np.bincount(at, n)[at] > 1)
    pairs, words, c, classes, n = (x[some] for x in (pairs, words, c, classes, n))
    of_class, of_word = weight_keys(pairs, classes, words)
    of_class, _, at = _distinct(of_class)
    target = np.maximum(n - DISCOUNT, 0.0)
    b, seen = (c + 1.0) / sizes[classes], np.bincount(at, target, len(of_class))[at]
    lam = np.log1p(target / (seen * b))
    extra = np.bincount(at, b * np.expm1(lam), len(of_class))
    for _ in range(updates):
        expected = seen * b * np.exp(lam) / (1 + extra[at])
        lam = lam + (target - expected - WORD_PRIOR * lam) / (np.maximum(expected, target) + WORD_PRIOR)
        extra = np.bincount(at, b * np.expm1(lam), len(of_class))
    normaliser = -np.log10(1 + extra)
    order = np.argsort(of_word)
    return of_word[order], (lam / np.log(10) + normaliser[at])[order], of_class, normaliser


#: Words after pairs, packed: the seven last bytes of the pair (the first is the block's), and a frequent word's number, or what is
#: known of another word.
_PAIR_BYTES, _CODE_BYTES = 7, 3
_RARE = np.dtype([("h", "<u8"), ("c", "<i8"), ("cls", "<i2")])
_PACKED = "block int, kind int, rare boolean, base long, pairs binary, words binary, told binary"
_COUNTS, _TOKENS = 0, 1  # kinds: how often training texts have a word after a pair, and which texts have it


def _bytes(values: np.ndarray, width: int) -> np.ndarray:
    values = np.ascontiguousarray(values)
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize)[:, :width])


def _numbers(raw: np.ndarray, width: int, kind: str) -> np.ndarray:
    out = np.zeros((len(raw) // width, np.dtype(kind).itemsize), np.uint8)
    out[:, :width] = raw.reshape(-1, width)
    return out.view(kind).ravel()


def _packed(kind: int, base: int, pairs: np.ndarray, words: np.ndarray, told: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each block: its pairs, words and what is told of them. ``words``: numbers of frequent words, or ``_RARE``."""
    rare = words.dtype == _RARE
    block = (pairs >> np.uint64(64 - BLOCK_BITS)).astype(np.int64)
    if len(block) and (np.diff(block) < 0).any():
        order = np.argsort(pairs)
        block, pairs, words, told = block[order], pairs[order], words[order], told[order]
    cuts = np.concatenate([np.flatnonzero(np.diff(block, prepend=-1)), [len(block)]])
    blocks = block[cuts[:-1]]

    def column(values: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(blocks), [None, pa.py_buffer((cuts * values.shape[1]).astype(np.int32)), pa.py_buffer(values)])

    width = _RARE.itemsize if rare else _CODE_BYTES
    columns = [column(_bytes(pairs, _PAIR_BYTES)), column(_bytes(words, width)), column(_bytes(told, told.dtype.itemsize))]
    fixed = [pa.array(blocks.astype(np.int32)), pa.array(np.full(len(blocks), kind, np.int32)), pa.array(np.full(len(blocks), rare)), pa.array(np.full(len(blocks), base))]
    if len(blocks):
        yield pa.RecordBatch.from_arrays([*fixed, *columns], ["block", "kind", "rare", "base", "pairs", "words", "told"])


def _counted(pairs: np.ndarray, ids: np.ndarray, words: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What training texts have, each word after a pair once. ``ids`` tell words apart."""
    low = np.uint64((1 << 64 - BLOCK_BITS) - 1)
    order = np.argsort(pairs & ~low | mix(pairs * _TWO + ids) & low)  # by block; what is alike stands together
    pairs, ids, words = pairs[order], ids[order], words[order]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:] != pairs[:-1]) | (ids[1:] != ids[:-1])
    at = np.flatnonzero(new)
    yield from _packed(_COUNTS, 0, pairs[at], words[at], np.diff(at, append=len(pairs)).astype("<u4"))


def _coded_tokens(batch: pa.RecordBatch, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token offsets of the rows of scored texts, the numbers of their tokens, hashes, and pairs before."""
    data, offsets = text_buffer(batch.column("codes"))
    codes = _numbers(data[offsets[0] : offsets[-1]], _CODE_BYTES, "<u4")
    bounds = (offsets - offsets[0]) // _CODE_BYTES
    h = words[np.minimum(codes, len(words) - 1)] if len(words) else np.zeros(len(codes), np.uint64)
    h[codes >= SENT_WORDS] = batch.column("rest").flatten().to_numpy().view(np.uint64)
    return bounds, codes, h, word_pairs(h, bounds[:-1])


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with rows numbered without a gap and no more tokens than a task adds up at once, unless in a single row."""
    uid, n = batch.column("uid").to_numpy(), batch.column("n_tokens").to_numpy()
    rows = np.arange(len(uid))
    part = np.stack([np.cumsum(n) // ADDED, uid - rows, rows >> 16])
    cuts = [0, *(np.flatnonzero((np.diff(part) != 0).any(0)) + 1).tolist(), len(uid)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def tied_gains(told: DataFrame, rare: DataFrame, sent, turn: int) -> DataFrame:
    """``uid, tied``: what the weights of words after pairs add to each text's score, of the pairs whose turn it is.

    ``told`` has the texts as numbers of words, ``rare`` the tokens whose words have no number with their counts. Tokens are dealt by
    block of pairs, packed. A block's counts come first and are added up to what training has after its pairs, each word once; the
    weights are learned from all of them (see :func:`word_weights`) and its tokens then looked up as they pass by. So a task holds one
    block's distinct words after pairs, however often texts repeat them.
    """

    def due(pairs: np.ndarray) -> np.ndarray:
        return (pairs >> np.uint64(64 - BLOCK_BITS)) % np.uint64(TURNS) == np.uint64(turn)

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch):
                bounds, codes, _, pairs = _coded_tokens(part, sent.value.words)
                own = np.flatnonzero((codes < SENT_WORDS) & due(pairs))
                row = (np.searchsorted(bounds, own, "right") - 1).astype("<u2")
                learned = own[~np.array(part.column("apart").to_pylist(), bool)[row]]
                yield from _counted(pairs[learned], codes[learned].astype(np.uint64), codes[learned])
                yield from _packed(_TOKENS, part.column("uid")[0].as_py(), pairs[own], codes[own], row)

    def seldom(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack(tables: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(tables)
            pairs, h = (table.column(c).to_numpy().view(np.uint64) for c in ("pair", "h"))
            words = np.empty(len(h), _RARE)
            words["h"], words["c"], words["cls"] = h, table.column("n").to_numpy(), table.column("cls").to_numpy()
            learned = ~np.array(table.column("apart").to_pylist(), bool)
            yield from _counted(pairs[learned], h[learned], words[learned])
            yield from _packed(_TOKENS, 0, pairs, words, table.column("uid").to_numpy().astype("<i8"))

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch.filter(pa.array(due(batch.column("pair").to_numpy().view(np.uint64)))))
            if sum(x.num_rows for x in held) >= ADDED:
                yield from pack(held)
                held = []
        if held:
            yield from pack(held)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        none = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.uint64), np.zeros(0)
        block, counts, tokens, table, gains = None, [], [], None, []
        held = {"counts": 0, "tokens": 0, "gains": 0}

        def add_up() -> None:
            pairs, words, c, classes, n = (np.concatenate(x) for x in zip(*counts))
            _, at, back = _distinct(mix(pairs * _TWO + words))
            counts[:] = [(pairs[at], words[at], c[at], classes[at], np.bincount(back, n))]
            held["counts"] = 0

        def look_up() -> None:
            pairs, words, classes, uid = (np.concatenate(x) for x in zip(*tokens))
            tokens.clear()
            held["tokens"] = 0
            of_word, weight, of_class, normaliser = table
            if not len(of_word):
                return
            by_class, by_word = weight_keys(pairs, classes, words)
            at, cls = np.minimum(np.searchsorted(of_word, by_word), len(of_word) - 1), np.minimum(np.searchsorted(of_class, by_class), len(of_class) - 1)
            gain = np.where(of_word[at] == by_word, weight[at], np.where(of_class[cls] == by_class, normaliser[cls], 0.0))
            gains.append((uid, gain))
            held["gains"] += len(uid)

        def summed() -> Iterator[pa.RecordBatch]:
            uid, gain = (np.concatenate(x) for x in zip(*gains))
            gains.clear()
            held["gains"] = 0
            uid, _, at = _distinct(uid)
            yield pa.RecordBatch.from_arrays([pa.array(uid), pa.array(np.bincount(at, gain))], ["uid", "tied"])

        def runs(batch: pa.RecordBatch) -> Iterator[tuple]:
            """Rows of one block and kind together."""
            raws = [text_buffer(batch.column(x)) for x in ("pairs", "words", "told")]
            fixed = [batch.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("block", "kind", "rare")]
            base = batch.column("base").to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(np.stack(fixed)) != 0).any(0)) + 1).tolist(), batch.num_rows]
            for i, j in zip(cuts[:-1], cuts[1:]):
                of, kind, rare_words = (int(x[i]) for x in fixed)
                pairs, words, said = (raw[offsets[i] : offsets[j]] for raw, offsets in raws)
                pairs = _numbers(pairs, _PAIR_BYTES, "<u8") | np.uint64(of >> BLOCK_BITS - 8 << 8 * _PAIR_BYTES)
                if rare_words:
                    known = words.view(_RARE)
                    words, c, classes = known["h"], known["c"], known["cls"].astype(np.int64)
                else:
                    codes = _numbers(words, _CODE_BYTES, "<u4")
                    words, c, classes = codes.astype(np.uint64), m.counts[codes], m.classes[codes]
                if kind == _COUNTS:
                    yield of, kind, (pairs, words, c, classes, said.view("<u4").astype(np.float64))
                elif rare_words:
                    yield of, kind, (pairs, words, classes, said.view("<i8"))
                else:
                    uid = np.repeat(base[i:j], np.diff(raws[0][1][i : j + 1]) // _PAIR_BYTES) + said.view("<u2")
                    yield of, kind, (pairs, words, classes, uid)

        for batch in batches:
            for of, kind, items in runs(batch) if batch.num_rows else ():
                if of != block:
                    if tokens:
                        look_up()
                    block, table = of, None
                    counts.clear()
                    held["counts"] = 0
                if kind == _COUNTS:
                    counts.append(items)
                    held["counts"] += len(items[0])
                    if held["counts"] >= ADDED:
                        add_up()
                    continue
                if table is None:
                    if counts:
                        add_up()
                    table = word_weights(*counts[0], m.sizes) if counts else none
                    counts.clear()
                tokens.append(items)
                held["tokens"] += len(items[0])
                if held["tokens"] >= ADDED:
                    look_up()
                if held["gains"] >= ADDED:
                    yield from summed()
        if tokens:
            look_up()
        if gains:
            yield from summed()

    packed = told.select("uid", "apart", "n_tokens", "codes", "rest").mapInArrow(often, _PACKED).union(rare.mapInArrow(seldom, _PACKED))
    settled = packed.repartition("block").sortWithinPartitions("block", "kind", "rare").mapInArrow(settle, "uid long, tied double")
    return settled.groupBy("uid").agg(F.sum("tied").alias("tied"))


def score_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: a row for each of ``docs(doc_id, text)``.

    Tokens are a text's words (A-Z lower-cased) and one end. ``base_score`` sums log10((c + 1) / (N + V + 1)) over
    tokens, with c, N and V counted over all training documents. ``score`` is the model's log10 probability: of a
    token's class given the two classes before, by a softmax over bias, bigram, skip and hashed trigram features, times that of the
    token within its class, by a softmax whose weights are those of words after pairs of words (see :func:`train_words`) and
    whose base is the token's share, (c + 1) of the class's counts, kinds and one unseen word. Frequent words are a class each.

    Learned from documents that are not held out: word counts, class events and words after pairs, of all of them, then gradient
    updates over either. Counts of at most ``SENT_WORDS`` frequent words are sent to tasks; those of all others come by a join on
    hashes, and the weights of words are learned and looked up by block of pairs, ``TURNS`` of them one after another (see
    :func:`tied_gains`), so vocabulary and n-grams grow with the corpus. Texts are kept as numbers of words meanwhile.

    Null or empty text: the end alone. Null ids learn. Repeated rows count again. Without training documents every
    count is 0. No rows: no rows. Other columns are left out, so they cannot clash.
    """
    spark: SparkSession = docs.sparkSession
    base = docs.select(col("doc_id").alias("doc_id"), F.coalesce(col("text"), F.lit("")).alias("text"))
    base = base.withColumn("apart", held_out(F.col("doc_id")))
    model, vocabulary, _ = fit_model(base.where(~F.col("apart")).select("text"))
    sent = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        table = np.empty((_CONTEXTS, CLASSES), np.float32)
        for i in range(0, _CONTEXTS, 1024):
            some = np.arange(i, min(i + 1024, _CONTEXTS))
            table[i : i + 1024] = log_chances(m.weights, feature_rows(some)) / np.log(10)
        unseen_base = np.log10(m.total + m.kinds + 1)
        ones = np.log10(m.counts + 1.0)
        for batch in batches:
            for first, bounds, h, tails in _token_slices(batch.column("text")):
                c = m.scheme.classes(h, tails)
                starts = bounds[:-1]
                chance = table[_contexts(c, starts), c].astype(np.float64) - m.class_log[c]
                at = np.minimum(np.searchsorted(m.words, h), max(0, len(m.words) - 1))
                here = m.words[at] == h if len(m.words) else np.zeros(len(h), bool)
                own = np.where(here, ones[at] if len(ones) else 0.0, 0.0)
                rest = np.flatnonzero(~here)
                cuts = np.searchsorted(rest, bounds).astype(np.int32)
                n = np.diff(bounds)
                part = batch.slice(first, len(starts))
                # the number of a frequent word; of others their class, which counts on from there
                codes = _bytes(np.where(here, at, SENT_WORDS + c).astype("<u4"), _CODE_BYTES)
                places = pa.py_buffer((bounds * _CODE_BYTES).astype(np.int32))
                sums = np.add.reduceat(own, starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("apart"), pa.array(n.astype(np.int64)), pa.array(np.add.reduceat(here.astype(np.int64), starts)),
                        pa.array(sums - n * unseen_base), pa.array(sums + np.add.reduceat(chance, starts)),
                        pa.ListArray.from_arrays(pa.array(cuts), pa.array(h[rest].view(np.int64))),
                        pa.Array.from_buffers(pa.binary(), len(n), [None, places, pa.py_buffer(codes)]),
                    ],
                    ["doc_id", "apart", "n_tokens", "known", "base", "model", "rest", "codes"],
                )

    def rare_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch):
                bounds, codes, h, pairs = _coded_tokens(part, sent.value.words)
                own = np.flatnonzero(codes >= SENT_WORDS)
                row = pa.array(np.searchsorted(bounds, own, "right") - 1)
                columns = [part.column("uid").take(row), part.column("apart").take(row), *[pa.array(x[own].view(np.int64)) for x in (pairs, h)]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(codes[own].astype(np.int32) - SENT_WORDS)], ["uid", "apart", "pair", "h", "cls"])

    fields = f"doc_id {base.schema['doc_id'].dataType.simpleString()}, apart boolean, n_tokens long, known long, base double, model double, rest array<long>, codes binary"
    told = stage(numbered(base.mapInArrow(score, fields), "uid"), "lm-scores")
    rare = told.mapInArrow(rare_tokens, "uid long, apart boolean, pair long, h long, cls int").join(vocabulary.select("h", "n"), "h", "left")
    rare = stage(rare.withColumn("n", F.coalesce("n", F.lit(0)).cast("long")), "lm-rare")
    found = rare.where("n > 0").groupBy("uid").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1.0)).alias("gain"))
    tied = None
    for turn in range(TURNS):
        part = stage(tied_gains(told, rare, sent, turn), "lm-tied")
        tied = part if tied is None else tied.union(part)
        release(spark)
    tied = tied.groupBy("uid").agg(F.sum("tied").alias("tied"))
    gain = F.coalesce("gain", F.lit(0.0))
    return told.drop("rest", "codes").join(found, "uid", "left").join(tied, "uid", "left").select(
        "doc_id",
        F.col("apart").alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + gain).alias("base_score"),
        (F.col("model") + gain + F.coalesce("tied", F.lit(0.0))).alias("score"),
    )
