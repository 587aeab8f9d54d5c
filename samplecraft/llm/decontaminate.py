"""Benchmark texts in training documents, found by spaced seeds.

A spaced seed is a mask over consecutive words: the words at its ones are hashed, those
at its zeros are ignored. The two masks are chosen so that any 13 words of which at
most two are substituted hold a seed of the one or the other whole (checked over all
ways in the tests). Documents' seeds are looked up among the benchmark's; around every
hit the words are compared one by one, and ``LEAST`` equal ones of ``SPAN`` make an
overlap. Of an item of ``LOOSE`` words or more, but fewer than ``SPAN``, all words but one
must be equal: its masks are its two halves, one of which a substitution leaves whole. An
item of fewer than ``LOOSE`` words must occur whole, and one of fewer than ``SHORTEST``,
which stands in texts by chance, must be a line of its own.

Words are runs of letters and digits in lower case. All of it is DataFrame functions.
A benchmark is small next to a corpus: the hashes of its seeds go to all tasks as sets,
at most ``SEEDS`` at a time; a larger benchmark takes more passes over the documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.staging import staged
from .names import fresh

#: Weight 6, both begin with two ones, which are looked up first.
MASKS = ("11101011", "110100111")
SPAN = 13  # words of an overlap
LEAST = 11  # of which are equal
LOOSE = 7  # words of an item from which on one may be substituted
SHORTEST = 4  # words of an item that is found inside lines
SEEDS = 50_000  # hashes that a task holds at once


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _seed(mask: str, at: str) -> str:
    """SQL for a mask's hash over the array ``w`` from the position ``at``, from 0; null
    where it goes past the end."""
    chosen = [f"get(w, {at} + {k})" for k, bit in enumerate(mask) if bit == "1"]
    return f"if({at} + {len(mask) - 1} < size(w), xxhash64({len(mask)}, {', '.join(chosen)}), null)"


def _short_masks(n: int) -> set[tuple[str, int]]:
    """Masks of ones, and where they begin, for an item of ``n`` < ``SPAN`` words."""
    if n < LOOSE:
        return {("1" * n, 0)}
    return {("1" * (n // 2), 0), ("1" * (n - n // 2), n // 2)}


def _item_seeds(items: DataFrame) -> tuple[DataFrame, list[str]]:
    """item, place, mask, seed, first (hash of two words) of all seeds, with w; and the masks."""
    lengths = [r.n for r in items.filter(F.size("w") < SPAN).select(F.size("w").alias("n")).distinct().orderBy("n").collect()]
    at = lambda rows, mask, place: rows.select("item", "w", place.alias("place"), F.lit(mask).alias("mask"))
    parts = []
    for mask in MASKS:
        long = items.filter(F.size("w") >= SPAN)
        parts.append(at(long, mask, F.explode(F.sequence(F.lit(0), F.size("w") - len(mask)))))
    for n in lengths:
        parts += [at(items.filter(F.size("w") == n), mask, F.lit(place)) for mask, place in sorted(_short_masks(n))]
    masks = sorted({mask for n in lengths for mask, _ in _short_masks(n)})
    seed = reduce(lambda other, m: F.when(F.col("mask") == m, F.expr(_seed(m, "place"))).otherwise(other), [*MASKS, *masks], F.lit(None).cast("long"))
    placed = reduce(DataFrame.unionByName, parts)
    return placed.withColumn("seed", seed).withColumn("first", F.expr(_seed("11", "place"))), [*MASKS, *masks]


def _whole_lines(docs: DataFrame, items: DataFrame, key: str, text: str) -> DataFrame:
    """The documents of which a line has the words of an item and no others."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = docs.select(F.col(f"`{key}`").alias("_doc"), F.xxhash64(whole).alias("_text"), F.explode(F.split(whole, "\n")).alias("line"))
    short = lines.select("_doc", "_text", words(F.col("line")).alias("w")).filter(F.size("w").between(1, SHORTEST - 1))
    n = F.size("w")
    return short.join(items, "w").select("_doc", "_text", "item", n.alias("equal"), n.alias("span"), F.lit(None).cast("int").alias("doc_word"), F.lit(0).alias("item_word"))


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row for each document and item that overlap: _doc, _text (the text's hash),
    item, equal (words of the best overlap), span (words it is out of), doc_word and
    item_word (where the seed of the first best one stands, from 0; doc_word is null
    where a whole line is the item).

    A null text has no words; rows equal in key and text are one document; repeated
    items are one item, and items that share a number are told apart by their words.
    """
    items = benchmark.select(F.col(f"`{item}`").alias("item"), words(F.col(f"`{item_text}`")).alias("w")).distinct()
    seeds, masks = _item_seeds(items.filter(F.size("w") >= SHORTEST))
    seeds = staged(seeds.distinct(), "benchmark-seeds")
    shortest = items.filter(F.size("w").between(1, SHORTEST - 1))
    lines = None if shortest.isEmpty() else _whole_lines(docs, shortest, key, text)
    total = seeds.select("seed").distinct().count()
    passes = -(-total // SEEDS)
    before = SPAN - 1  # words in front of a seed that an overlap can have, and behind its start
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # Behind a generator the words are computed once, not for each look at one of them.
    rows = docs.select(F.col(f"`{key}`").alias("_doc"), F.xxhash64(whole).alias("_text"), F.explode_outer(F.array(words(whole))).alias("w"))
    found = []
    for turn in range(passes):
        part = seeds.filter(F.pmod(F.col("seed"), F.lit(passes)) == turn)
        held = part.groupBy("mask").agg(F.collect_set("seed").alias("seeds"), F.collect_set("first").alias("firsts")).collect()
        firsts = {x for r in held for x in r.firsts}
        among = lambda values: "(" + ", ".join(f"{x}L" if x > -(1 << 63) else "-9223372036854775807L - 1L" for x in sorted(values)) + ")"
        tests = [f"{_seed(r.mask, 'i')} IN {among(r.seeds)}" for r in held]
        hit = f"{_seed('11', 'i')} IN {among(firsts)} AND ({' OR '.join(tests)})"
        places = F.expr(f"filter(if(size(w) < 2, array(), sequence(0, size(w) - 2)), i -> {hit})")
        hits = rows.select("_doc", "_text", "w", F.explode_outer(places).alias("at")).filter("at is not null")
        # The words around a hit, from ``before`` words in front of it; null beyond the text.
        around = F.transform(F.sequence(F.lit(-before), F.lit(before)), lambda o: F.when(F.col("at") + o >= 0, F.get("w", F.col("at") + o)))
        own = [F.expr(_seed(m, "at")).alias(f"seed{k}") for k, m in enumerate(masks)]
        hits = hits.select("_doc", "_text", "at", around.alias("around"), *own)
        keys = F.explode(F.array(*[F.struct(F.lit(m).alias("mask"), F.col(f"seed{k}").alias("seed")) for k, m in enumerate(masks)]))
        hits = hits.select("_doc", "_text", "at", "around", keys.alias("k")).select("_doc", "_text", "at", "around", "k.mask", "k.seed")
        found.append(hits.join(part.withColumnRenamed("w", "words"), ["mask", "seed"]))
    if not found:
        return _whole_lines(docs, shortest, key, text).distinct()
    hits = reduce(DataFrame.unionByName, found)
    theirs = lambda o: F.when(F.col("place") + o >= 0, F.get("words", F.col("place") + o))
    equal = F.transform(
        F.sequence(F.lit(-before), F.lit(before)), lambda o: F.when(F.get("around", o + before) == theirs(o), 1).otherwise(0)
    )
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(before)), lambda s: F.aggregate(F.slice("same", s + 1, SPAN), F.lit(0), lambda a, b: a + b)))
    hits = hits.withColumn("same", equal).withColumn("equal", best).withColumn("span", F.least(F.size("words"), F.lit(SPAN)))
    # Where the span is the whole item, all of its words must be there, or all but one.
    enough = F.when(F.col("span") < LOOSE, F.col("span")).when(F.col("span") < SPAN, F.col("span") - 1).otherwise(LEAST)
    hits = hits.filter(F.col("equal") >= enough)
    best = hits.groupBy("_doc", "_text", "item").agg(
        F.max("equal").alias("equal"),
        F.max("span").alias("span"),
        F.min_by(F.col("at"), F.struct(-F.col("equal"), F.col("at"), F.col("place"))).alias("doc_word"),
        F.min_by(F.col("place"), F.struct(-F.col("equal"), F.col("at"), F.col("place"))).alias("item_word"),
    )
    if lines is None:
        return best
    # Items that share a number may be of both kinds.
    return best.unionByName(lines).groupBy("_doc", "_text", "item").agg(
        *(F.max_by(c, F.struct("equal", F.col("doc_word").isNotNull())).alias(c) for c in ("equal", "span", "doc_word", "item_word"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the documents that overlap with a benchmark item. Columns stay,
    whatever their names; an empty benchmark leaves all documents."""
    own = fresh(docs.columns, "_bad")
    bad = overlaps(docs, benchmark, key, text, item, item_text).select(F.struct("_doc", "_text").alias(own)).distinct()
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    same = F.col(f"`{key}`").eqNullSafe(F.col(f"{own}._doc")) & (F.xxhash64(whole) == F.col(f"{own}._text"))
    return docs.join(bad, same, "left_anti")
