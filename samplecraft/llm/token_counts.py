"""How many tokens each section of a document has.

A document is encoded once and whole, so its tokens are those that a model sees. Their
character offsets are joined to the sections' character spans. A token that crosses a
boundary goes by one of these rules:

* ``first``: to the section that has its first character,
* ``last``: to the section that has its last character,
* ``split``: to every section by the part of its characters that lies there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .tokens import SLICE, encoder

TOKENIZER = "byte_bpe_50k.json"  # its tokens hold white space, so they can cross lines
RULES = ("first", "last", "split")


def counted(first: np.ndarray, after: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each span, and how many of these reach over the span's border.

    ``first`` and ``after`` are the tokens' first character and the one after the last;
    both only grow, as encoders give them. A token without characters counts as the one
    where it stands. Spans may overlap; each is then counted on its own.
    """
    last = np.maximum(after - 1, first)

    def across(x):  # the tokens that reach over x stand from a up to b
        a = np.searchsorted(last, x)
        return a, np.maximum(np.searchsorted(first, x), a)

    def before(x):  # tokens in front of x, the crossing ones in part
        a, b = across(x)
        total = a.astype(float)
        for k in range(int((b - a).max(initial=0))):
            some = a + k < b
            t = (a + k)[some]
            total[some] += (x[some] - first[t]) / (last[t] + 1 - first[t])
        return total

    ends = np.maximum(starts, ends)
    (a, b), (c, d) = across(starts), across(ends)
    if rule == "split":
        both = np.maximum(np.minimum(b, d) - np.maximum(a, c), 0)  # cover the whole span
        return before(ends) - before(starts), np.where(ends > starts, b - a + d - c - both, 0)
    if rule == "first":
        low = np.searchsorted(first, starts)
        return (np.searchsorted(first, ends) - low).astype(float), np.maximum(d - np.maximum(c, low), 0)
    high = np.searchsorted(last, ends)
    return (high - np.searchsorted(last, starts)).astype(float), np.maximum(np.minimum(b, high) - a, 0)


def _lines(texts: pa.Array, begins: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """The lines of all texts, each with its line feed: text, number, start and end."""
    data, bounds = W.text_bytes(texts)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    feeds = np.flatnonzero(data == 10) + 1
    owner = np.searchsorted(bounds, feeds - 1, side="right") - 1  # empty texts have no bytes
    count = np.bincount(owner, minlength=len(texts)) + 1
    at = np.concatenate([[0], np.cumsum(count)])
    first = np.zeros(at[-1], bool)
    first[at[:-1]] = True
    starts = np.zeros(at[-1], np.int64)
    starts[first], starts[~first] = begins[:-1], before[feeds]
    last = np.zeros(at[-1], bool)
    last[at[1:] - 1] = True
    ends = np.zeros(at[-1], np.int64)
    ends[last], ends[~last] = begins[1:], before[feeds]
    number = np.arange(at[-1]) - np.repeat(at[:-1], count)
    return np.repeat(np.arange(len(texts)), count), pa.array(number).cast(pa.string()), starts, ends


def _given(sections: pa.Array, begins: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """The sections of all texts, cut to the texts: text, name, start and end."""
    owner, labels, starts, ends = [], [], [], []
    for n, own in enumerate(sections.to_pylist()):
        for s in own or []:
            if s:
                low, high = int(begins[n]), int(begins[n + 1])
                owner.append(n)
                labels.append(None if s["section"] is None else str(s["section"]))
                starts.append(min(max(low + (s["start"] or 0), low), high))
                ends.append(min(max(low + (s["end"] or 0), low), high))
    return np.array(owner, np.int64), pa.array(labels, pa.string()), np.array(starts, np.int64), np.array(ends, np.int64)


def fields_as_text(fields: list[str], joiner: str = "\n") -> tuple[Column, Column]:
    """One text of several string columns, and the sections (name, start, end) they
    have in it. A null field is empty; a joiner belongs to the field before it."""
    parts = [F.concat(F.coalesce(F.col(f"`{f}`"), F.lit("")), F.lit(joiner if i + 1 < len(fields) else "")) for i, f in enumerate(fields)]
    sections, start = [], F.lit(0).cast("long")
    for name, part in zip(fields, parts):
        end = start + F.char_length(part)
        sections.append(F.struct(F.lit(name).alias("section"), start.alias("start"), end.cast("long").alias("end")))
        start = end
    return F.concat(*parts), F.array(*sections)


def count_tokens(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sections: str | None = None,
    tokenizer: str = TOKENIZER,
    rule: str = "first",
) -> DataFrame:
    """One row for each section of each document: ``key``, section, start, end, n_tokens,
    crossing (tokens that count here and reach over the section's border), doc_tokens.

    ``sections`` names a column of (section, start, end) structs in characters; without
    it each line is a section, named by its number from 0. A null text is empty and has
    one empty line; a document whose sections are null or empty has no rows. Spans are
    cut to the text, tokens outside of all sections count only in doc_tokens. Repeated
    rows are documents of their own; columns that are not named are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{text}`").alias("text"),
        *([F.col(f"`{sections}`").alias("sections")] if sections else []),
    )
    names = ["key", "section", "start", "end", "n_tokens", "crossing", "doc_tokens"]

    def run(batches):
        encode = encoder(tokenizer)
        for batch in batches:
            texts = batch.column("text")
            for i, j in W.slices(W.text_bytes(texts)[1], SLICE):
                part = texts.slice(i, j - i)
                # Characters and tokens are counted through all texts of the slice.
                first, after, at, begins = encode.spans(part)
                if sections:
                    owner, labels, starts, ends = _given(batch.column("sections").slice(i, j - i), begins)
                else:
                    owner, labels, starts, ends = _lines(part, begins)
                tokens, crossing = counted(first, after, starts, ends, rule)
                size = np.diff(at)[owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(pa.array(owner + i, pa.int64())),
                        labels,
                        *(pa.array(x, pa.int64()) for x in (starts - begins[owner], ends - begins[owner])),
                        pa.array(tokens, pa.float64()),
                        *(pa.array(x, pa.int64()) for x in (crossing, size)),
                    ],
                    names,
                )

    schema = f"key {kind}, section string, start long, end long, n_tokens double, crossing long, doc_tokens long"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
