"""Line dedup over content-defined chunks of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.staging import WORD, col, discard, numbered, quoted, release, stage, without

#: A line of at least so many words is a chunk of its own: its content alone sets both its boundaries.
LONG_LINE = 8
#: Between shorter lines, one boundary in this many lines on average.
MEAN_LINES = 2
#: Repeated chunks go where a run of them has at least so many words.
MIN_WORDS = 50

OUTPUT = ("lines_removed",)


def _own(df: DataFrame, *columns: tuple[str, Column]) -> DataFrame:
    """Add columns behind a generator, so that what is built on them reads them instead of computing them again."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns]))))


def line_number(line: Column) -> Column:
    """28 bits of a line's MD5."""
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def chunked(df: DataFrame, text: Column, long_line: int, mean_lines: int) -> DataFrame:
    """Add ``__chunks``, ``__words`` and ``__starts``, a text's chunks of lines, their word counts and first lines, and
    ``__w``, the words of each line.

    A line ends a chunk when it or the next line is long, or when the rolling hash of it and the line before is
    0 modulo ``mean_lines``. That depends on neighbouring lines only, so lines put in or taken out elsewhere do not
    move a boundary. Chunks joined by newlines give the text back.
    """
    df = _own(df, ("__lines", F.split(F.coalesce(text, F.lit("")), "\n", -1)))
    df = _own(
        df,
        ("__h", F.transform("__lines", line_number)),
        ("__w", F.transform("__lines", lambda line: F.coalesce(F.regexp_count(line, F.lit(WORD)), F.lit(0)))),
        ("__n", F.size("__lines")),
    )

    def at(array: str, i: Column) -> Column:
        return F.get(array, i)

    def ends(i: Column) -> Column:
        rolled = (at("__h", i) * 31 + F.coalesce(at("__h", i - 1), F.lit(0))) % mean_lines == 0
        return (i == F.col("__n") - 1) | (at("__w", i) >= long_line) | (at("__w", i + 1) >= long_line) | rolled

    df = _own(df, ("__ends", F.filter(F.sequence(F.lit(0), F.col("__n") - 1), ends)))

    def start(k: Column) -> Column:
        return F.coalesce(F.get("__ends", k - 1) + 1, F.lit(0))

    spans = F.transform("__ends", lambda e, k: F.struct(start(k).alias("s"), (e - start(k) + 1).alias("n")))
    df = _own(df, ("__spans", spans))
    return _own(
        df,
        ("__chunks", F.transform("__spans", lambda x: F.array_join(F.slice("__lines", x["s"] + 1, x["n"]), "\n"))),
        ("__words", F.transform("__spans", lambda x: F.aggregate(F.slice("__w", x["s"] + 1, x["n"]), F.lit(0), lambda a, b: a + b))),
        ("__starts", F.transform("__spans", lambda x: x["s"])),
    ).drop("__lines", "__h", "__n", "__ends", "__spans")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, long_line: int = LONG_LINE, mean_lines: int = MEAN_LINES) -> DataFrame:
    """Take out of ``text`` the chunks of lines that stand elsewhere already, and add ``lines_removed``.

    Texts are cut into chunks at content-defined boundaries (see :func:`chunked`). Of equal chunks, the one with the
    smallest (doc_id, row, place) stays; every other one is removed where it stands in a run of repeated chunks of
    together at least ``min_words`` words. Lines beside a repeated chunk that equal those beside the
    copy that stays belong to the run as well, on either side up to ``min_words`` words from the chunk, so a passage's
    first and last lines count and go though their chunks hold other lines too. A hash picks what may be equal, then bytes are compared: chunks are grouped
    by their text. Lines without words neither count nor end a run, and those inside a removed run go with it. A single
    short line that many documents share (a heading, a greeting) therefore stays, and so does a passage's first copy.
    Every row stays: a text of nothing but repeats becomes empty.

    Only functions of Spark run. Each step is staged, and what only it read is deleted then. A passage in a third of all documents is counted before the shuffle and
    found again by joins that adaptive execution can split. Null text: stays null. Null ids sort first. Repeated rows:
    the later ones repeat the first. Chunks without words never count as repeats. No rows: no rows. A column named
    ``lines_removed`` is replaced.
    """
    source = without(docs, [*OUTPUT, "__uid"])
    # the chunks hold the text from here on, so that it is written and moved once
    cut = chunked(numbered(source, "__uid"), col("text"), long_line, mean_lines).withColumn("__null", col("text").isNull()).drop("text")
    kept = stage(cut, "lines-docs")
    place_fields = (col("doc_id").alias("doc_id"), F.col("__uid").alias("uid"), F.col("pos"))
    place = F.struct(*place_fields)
    told = kept.select(
        col("doc_id"), "__uid", F.posexplode(F.transform(F.arrays_zip("__chunks", "__words"), lambda x: F.struct(F.xxhash64(x["__chunks"]).alias("hash"), x["__words"].alias("words"))))
    ).select("doc_id", "__uid", "pos", "col.hash", "col.words")
    told = stage(told.where("words > 0"), "lines-hashes")
    repeated = told.groupBy("hash").agg(F.count("*").alias("n"), F.min(place).alias("head")).where("n > 1")
    marks = told.join(repeated, "hash").where(
        (F.col("__uid") != F.col("head.uid")) | (F.col("pos") != F.col("head.pos"))
    )
    # candidates by hash: runs long enough, per row; then their bytes and those of the chunks that would stay
    by_row = marks.groupBy("__uid").agg(F.sort_array(F.collect_list(F.struct("pos", "hash"))).alias("marks"))
    by_row = by_row.join(kept.select("__uid", "__words", _room(long_line).alias("__room")), "__uid")
    runs = stage(_own(by_row, ("long", _long_runs(min_words))).where(F.size("long") > 0).select("__uid", "long"), "lines-runs")
    release(docs.sparkSession)
    wanted = runs.select(F.inline(F.transform("long", lambda x: F.struct(x["hash"].alias("hash"), x["edge"].alias("edge")))))
    wanted = wanted.groupBy("hash").agg(F.max("edge").alias("edge"))
    heads = repeated.join(wanted, "hash").select(F.col("head.uid").alias("__uid"), F.col("head.pos").alias("pos"), "edge")
    asked = runs.select("__uid", F.inline(F.transform("long", lambda x: F.struct(x["pos"].alias("pos"), x["edge"].alias("edge"))))).union(heads)
    asked = asked.groupBy("__uid", "pos").agg(F.max("edge").alias("edge")).groupBy("__uid").agg(F.collect_list(F.struct("pos", "edge")).alias("asked"))
    # a row for each of many texts: joined by a shuffle at any size, so that no executor holds the table whole
    asked = stage(asked, "lines-asked")
    discard(told, runs)

    texts = kept.select(col("doc_id"), "__uid", "__chunks", "__starts", "__w").join(asked.hint("merge"), "__uid")
    edged = F.exists("asked", lambda m: m["edge"])
    texts = _own(
        texts,
        ("__lines", F.when(edged, F.split(F.array_join("__chunks", "\n"), "\n", -1))),
        ("__worded", F.when(edged, F.filter(F.sequence(F.lit(0), F.size("__w") - 1), lambda i: F.get("__w", i) > 0))),
    )
    texts = stage(texts.select("doc_id", "__uid", F.inline(F.transform("asked", lambda m: _asked(m, min_words)))), "lines-texts")
    discard(asked)
    sides = F.struct(*place_fields, "above", "below")
    equal = texts.groupBy("chunk").agg(F.min(sides).alias("head"))
    later = texts.join(equal, "chunk").where((F.col("__uid") != F.col("head.uid")) | (F.col("pos") != F.col("head.pos")))
    first, last = _reach("above"), _reach("below")
    later = later.select("__uid", F.coalesce(first, "first").alias("first"), F.coalesce(last, "last").alias("last"))
    before = F.max("last").over(Window.partitionBy("__uid").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    spans = later.select("__uid", "first", "last", before.alias("before"))
    spans = stage(spans.groupBy("__uid").agg(F.sort_array(F.collect_list(F.struct("first", "last", "before"))).alias("__spans")), "lines-spans")
    discard(texts)
    joined = _own(kept.join(spans.hint("merge"), "__uid", "left"), ("__gone", _gone(min_words)))
    lines = F.split(F.array_join("__chunks", "\n"), "\n", -1)
    joined = _own(joined, ("__lines", F.when(F.size("__gone") > 0, lines)))

    def stay(i: Column) -> Column:
        begin = F.coalesce(F.get("__gone", i - 1)["last"] + 1, F.lit(0))
        return F.slice("__lines", begin + 1, F.coalesce(F.get("__gone", i)["first"], F.size("__lines")) - begin)

    rest = F.flatten(F.transform(F.sequence(F.lit(0), F.size("__gone")), stay))
    text = F.when(~F.col("__null"), F.array_join(F.when(F.col("__lines").isNull(), F.col("__chunks")).otherwise(rest), "\n"))
    removed = F.aggregate("__gone", F.lit(0), lambda a, g: a + g["last"] - g["first"] + 1)
    return joined.select(*[(text.alias(c) if c.lower() == "text" else F.col(quoted(c))) for c in source.columns], removed.alias("lines_removed"))


def _parts(items: Column, begins) -> Column:
    """A sorted array cut before each place where ``begins`` holds."""
    cuts = F.filter(F.sequence(F.lit(0), F.size(items)), lambda i: (i == F.size(items)) | (i == 0) | begins(i))
    spans = F.zip_with(cuts, F.slice(cuts, 2, F.greatest(F.size(cuts), F.lit(1))), lambda a, b: F.struct(a.alias("a"), (b - a).alias("n")))
    return F.transform(F.filter(spans, lambda x: x["n"].isNotNull()), lambda x: F.slice(items, x["a"] + 1, x["n"]))


def _total(words: Column) -> Column:
    return F.aggregate(words, F.lit(0), lambda a, w: a + w)


def _between(values: str, left: Column, right: Column) -> Column:
    """What stands after place ``left`` and before place ``right``."""
    return F.slice(values, left + 2, F.greatest(right - left - 1, F.lit(0)))


def _room(long_line: int) -> Column:
    """Of each chunk, the words that a run may take from it if it is no repeat, or -1 if it ends the run.

    A long line is a chunk wherever it stands: one that equals a line of the copy that stays is a repeat itself.
    """

    def room(words: Column, p: Column) -> Column:
        lines = F.coalesce(F.get("__starts", p + 1), F.size("__w")) - F.get("__starts", p)
        return F.when((words >= long_line) & (lines == 1), -1).otherwise(words)

    return F.transform("__words", room)


def _long_runs(min_words: int) -> Column:
    """Of a row's ``marks``, sorted by place, those in runs that may have enough words together.

    ``edge`` tells those of runs whose neighbours or gaps hold words, which have to be compared line by line.
    """

    def at(i: Column) -> Column:
        return F.coalesce(F.when(i >= 0, F.get("marks", i)["pos"]), F.when(i < 0, -1).otherwise(F.size("__words")))

    def begins(i: Column) -> Column:
        return F.exists(_between("__room", at(i - 1), at(i)), lambda w: w < 0)

    def taken(room: Column) -> Column:
        """Words after the last chunk that ends a run."""
        return F.aggregate(room, F.lit(0), lambda a, w: F.when(w < 0, 0).otherwise(a + w))

    def judged(part: Column) -> Column:
        first, last = F.get(part, F.lit(0)), F.get(part, F.size(part) - 1)
        inner = F.slice("__words", first["pos"] + 1, last["pos"] - first["pos"] + 1)
        beside = taken(_between("__room", at(first["i"] - 1), first["pos"])) + taken(F.reverse(_between("__room", last["pos"], at(last["i"] + 1))))
        edge = (beside > 0) | (F.size(F.filter(inner, lambda w: w > 0)) > F.size(part))
        own = F.transform(part, lambda m: F.struct(m["pos"].alias("pos"), m["hash"].alias("hash"), edge.alias("edge")))
        return F.when(_total(inner) + beside >= min_words, own)

    marks = F.transform("marks", lambda m, i: F.struct(m["pos"].alias("pos"), m["hash"].alias("hash"), i.alias("i")))
    return F.flatten(F.filter(F.transform(F.filter(_parts(marks, begins), lambda part: F.size(part) > 0), judged), lambda part: part.isNotNull()))


def _asked(mark: Column, min_words: int) -> Column:
    """A chunk, its first and last lines and, at an edge, the lines with words around it, nearest first."""
    p = mark["pos"]
    first = F.get("__starts", p)
    last = F.coalesce(F.get("__starts", p + 1), F.size("__w")) - 1
    own = F.slice("__w", first + 1, last - first + 1)
    top = F.array_position("__worded", first + F.array_position(F.transform(own, lambda w: w > 0), True).cast("int") - 1).cast("int")
    bottom = top + F.size(F.filter(own, lambda w: w > 0)) - 1

    def lines(places: Column) -> Column:
        near = F.transform(places, lambda i: F.struct(i.alias("i"), F.get("__lines", i).alias("line"), F.get("__w", i).alias("w")))
        # every line has a word, so min_words lines are enough; those beyond min_words words go
        near = F.filter(near, lambda x, i: F.aggregate(F.slice(near, 1, i), F.lit(0), lambda a, y: a + y["w"]) < min_words)
        return F.when(mark["edge"], F.transform(near, lambda x: F.struct(x["i"].alias("i"), x["line"].alias("line"))))

    above = lines(F.reverse(F.slice("__worded", F.greatest(top - min_words, F.lit(1)), F.least(top - 1, F.lit(min_words)))))
    below = lines(F.slice("__worded", bottom + 1, min_words))
    return F.struct(
        p.alias("pos"), F.get("__chunks", p).alias("chunk"), first.alias("first"), last.alias("last"), above.alias("above"), below.alias("below")
    )


def _reach(side: str) -> Column:
    """The last line of a side that is equal, and all before it, to the head's; null if the first is not."""
    own, other = F.col(side), F.col(f"head.{side}")
    equal = F.zip_with(own, other, lambda a, b: F.coalesce(a["line"] == b["line"], F.lit(False)))
    stop = F.array_position(equal, False).cast("int")
    return F.get(own, F.when(stop > 0, stop - 1).otherwise(F.size(equal)) - 1)["i"]


def _gone(min_words: int) -> Column:
    """The first and last lines of a row's runs of repeated spans that have enough words together."""

    def begins(i: Column) -> Column:
        span = F.get("__spans", i)
        return F.exists(_between("__w", span["before"], span["first"]), lambda w: w > 0)

    spans = F.coalesce("__spans", F.array().cast("array<struct<first:int,last:int,before:int>>"))
    runs = F.transform(
        F.filter(_parts(spans, begins), lambda part: F.size(part) > 0),
        lambda part: F.struct(F.get(part, F.lit(0))["first"].alias("first"), F.array_max(F.transform(part, lambda x: x["last"])).alias("last")),
    )
    return F.filter(runs, lambda r: _total(F.slice("__w", r["first"] + 1, r["last"] - r["first"] + 1)) >= min_words)
