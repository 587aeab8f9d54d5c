"""Removal of line runs that occur before, with a suffix array over line ids.

The corpus is one sequence of lines, a document's lines in order and the documents in
order of their key. A suffix starts at every line that occurs more than once; it ends
where a line is unique or the document ends. Prefix doubling gives each suffix the rank
of its first 1, 2, 4, ... lines among all suffixes: ranks of twice the length come from
sorting pairs of ranks. Suffixes of equal rank stand together in the suffix array, and
such an interval has a longest common prefix of at least that many lines. Intervals of
other depths are those whose suffixes agree in two overlapping ranks.

A suffix's runs are those of ``min_words`` words that would have fewer without their
last line, or without their first. An interval of such a depth with more than one suffix
is a repeated run; its first suffix stays, the lines of all later ones go. A longer
repeated run is a union of such runs: each of its lines has ``min_words`` words from it
to the end, or from the start to it, or stands in the shortest run from the start. So
maximal runs go as a whole, and a line's first occurrence in the corpus always stays.

All of it is DataFrame functions. Ranks are taken by a range sort, groups are combined
before the shuffle, and rows of a line that is in every document are spread by position.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..plans.ranking import ranked
from ..plans.staging import staged
from .names import fresh

MIN_WORDS = 50  # space-separated pieces of a run; an empty line counts as one
_AT = ["_doc", "_text", "_line"]  # key, hash of the text, line number from 0


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Each line's place, number of words and hash (128 bits)."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("_doc"), F.xxhash64(whole).alias("_text"), F.split(whole, "\n").alias("lines"))
    rows = rows.select("_doc", "_text", F.posexplode_outer("lines").alias("_line", "line"))
    words = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "))) + 1
    return rows.select(*_AT, words.alias("words"), F.xxhash64("line").alias("one"), F.xxhash64(F.lit(1), "line").alias("two"))


def _shared(rows: DataFrame, by: list[str], rank: str) -> DataFrame:
    """The rows whose values ``by`` others have too, with the rank of these values."""
    classes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*by)
    classes = ranked(classes, [F.col(c) for c in by]).withColumnRenamed("position", rank)
    return rows.join(classes, by).drop(*by)


def _later(runs: DataFrame) -> DataFrame:
    """All runs of each interval but the first, with the first one's place."""
    interval, place = ["lines", "rank", "last"], F.struct("_doc", "_text", "_line")
    first = runs.groupBy(*interval).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # Written, so that the join deals both sides out itself and can split a frequent run.
    later = runs.join(staged(first, "first-runs"), interval).filter(place > F.col("first"))
    return later.select(*_AT, "lines", F.col("first._doc").alias("first_doc"), F.col("first._line").alias("first_line"))


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All later copies of runs: _doc, _text (hash), _line (its first), lines, and where
    the first copy is: first_doc, first_line. Runs may overlap."""
    # A row that occurs twice is one document at one place.
    lines = staged(_lines(docs, key, text).distinct(), "lines")
    suffixes = _shared(lines, ["one", "two"], "rank")
    document = Window.partitionBy("_doc", "_text").orderBy("_line")
    island = Window.partitionBy("_doc", "_text", "island")
    suffixes = (
        suffixes.withColumn("island", F.col("_line") - F.row_number().over(document))
        .withColumn("there", F.sum("words").over(island))
        .filter(F.col("there") >= min_words)
    )
    # From low, the fewest lines from here that have min_words words, to high, the most
    # that would have fewer without the first; each line has one at least.
    ahead = F.collect_list("words").over(island.orderBy("_line").rowsBetween(0, min_words - 1))
    reached = F.aggregate(
        ahead,
        F.struct(*[F.lit(0).alias(c) for c in ("low", "high", "words")]),
        lambda s, w: F.struct(
            (s["low"] + F.when(s["words"] < min_words, 1).otherwise(0)).alias("low"),
            (s["high"] + F.when(s["words"] + w - F.get(ahead, F.lit(0)) < min_words, 1).otherwise(0)).alias("high"),
            (s["words"] + w).alias("words"),
        ),
    )
    low, high = (F.when(F.col("reached.words") >= min_words, c) for c in (F.col("reached.low"), F.greatest("reached.low", "reached.high")))
    suffixes = staged(suffixes.withColumn("reached", reached).select(*_AT, "rank", low.alias("low"), high.alias("high")), "suffixes")
    deepest = suffixes.agg(F.max("high")).first()[0] or 0

    found, level, reach = [], suffixes, 1
    while reach <= deepest:
        # Runs of reach to 2 * reach - 1 lines: the ranks of their first and last reach lines.
        here = level.filter((F.col("low") < 2 * reach) & (F.col("high") >= reach))
        depths = F.sequence(F.greatest("low", F.lit(reach)), F.least("high", F.lit(2 * reach - 1)))
        here = here.select(*_AT, "rank", F.explode(depths).alias("lines"))
        ends = level.select("_doc", "_text", F.col("_line").alias("end"), F.col("rank").alias("last"))
        same = F.col("_doc").eqNullSafe(F.col("d")) & (F.col("_text") == F.col("t")) & (F.col("_line") + F.col("lines") - reach == F.col("end"))
        part = here.join(ends.toDF("d", "t", "end", "last"), same).select(*_AT, "lines", "rank", "last")
        found.append(staged(_later(staged(part, "runs")), "later-runs"))
        if 2 * reach <= deepest:
            after = level.select("_doc", "_text", "_line", "rank").toDF("d", "t", "e", "next")
            same = F.col("_doc").eqNullSafe(F.col("d")) & (F.col("_text") == F.col("t")) & (F.col("_line") + reach == F.col("e"))
            pairs = level.join(after, same).select(*_AT, "low", "high", "rank", "next")
            pairs = _shared(staged(pairs, "suffix-pairs").withColumnRenamed("rank", "front"), ["front", "next"], "rank")
            level = staged(pairs, "suffixes")
        reach *= 2
    if not found:
        return suffixes.select(*_AT, F.col("low").alias("lines"), F.col("_doc").alias("first_doc"), F.col("_line").alias("first_line")).limit(0)
    return reduce(DataFrame.unionByName, found)


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, counts: bool = False, drop_emptied: bool = False
) -> DataFrame:
    """``docs`` without the later copies of repeated runs, and with ``counts`` also the
    columns n_lines (before) and n_deleted.

    Documents are taken in ascending order of their key, nulls first, and those of the
    same key in the order of a hash of their text; the first copy stays. Rows equal in
    key and text are one document, each of them gets the same text. A document all of
    whose lines go has the text null, so that it differs from an empty one, or is left
    out with ``drop_emptied``; a null text is one empty line. All other rows and columns
    stay, whatever the columns' names.
    """
    runs = repeated_runs(docs, key, text, min_words)
    gone = runs.groupBy("_doc", "_text").agg(
        F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("_line"), F.col("_line") + F.col("lines") - 1)))).alias("_gone")
    )
    own, split = fresh(docs.columns, "_runs"), fresh(docs.columns, "_split")
    gone = gone.select(F.struct("_doc", "_text", "_gone").alias(own))
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    same = F.col(f"`{key}`").eqNullSafe(F.col(f"{own}._doc")) & (F.xxhash64(whole) == F.col(f"{own}._text"))
    joined = docs.join(gone, same, "left")
    out = F.col(f"{own}._gone")
    # Behind a generator the text is split once, and only where lines go.
    joined = joined.select("*", F.explode_outer(F.array(F.when(out.isNotNull(), F.split(whole, "\n")))).alias(split))
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), out)
    left = F.array_join(F.transform(kept, lambda i: F.get(split, i)), "\n")
    left = F.when(out.isNull(), F.col(f"`{text}`")).when(F.size(kept) > 0, left)
    columns = [left.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    if counts:
        number = F.octet_length(whole) - F.octet_length(F.replace(whole, F.lit("\n"))) + 1
        columns += [number.cast("long").alias("n_lines"), F.coalesce(F.size(out), F.lit(0)).cast("long").alias("n_deleted")]
    if drop_emptied:
        joined = joined.filter(out.isNull() | (F.size(kept) > 0))
    return joined.select(*columns)
