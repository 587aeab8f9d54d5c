"""Which tokens of two tokenizers cover the same bytes of a text.

Both tokenizers' tokens are rows of incidence matrices in CSR form: of tokens and bytes, and
of tokens and *groups*. A group is what lies between two byte offsets at which tokens of both
end. Rows are multiplied as Gustavson does: for each entry of a row of A the row of B-transposed
that it points to is added up. The byte product gives the overlap links (with the
bytes that two tokens share), the group product the shared-group links.

How many documents of the corpus hold a pair of ids linked is counted in three steps, since
neither all pairs of all documents nor the table of counts fit a task:

1. Texts are encoded once, in slices of bounded size. A slice's row has its distinct pairs with
   the documents that hold them, and each document's links as places in this list.
2. The slices' counts are added up to the corpus's; a window over an A id, whose
   partners the other vocabulary bounds, marks its highest.
3. Each slice gets the counts of its own pairs back by a join on the pair, which Spark
   splits where a pair is in very many slices, and its documents are added up.
"""

from __future__ import annotations

import hashlib
import json
import os
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..plans.staging import staged
from . import words as W
from .tokens import tokenizer_file

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
SLICE = 1_000_000  # bytes of text in a row of the staged table, unless one text is longer
EXPANDED = 4_000_000  # products of one step of a row product
FEW = 32  # tokens of a group
PAIRS = 1_000_000  # distinct pairs that a task holds while it adds up


class CSR(NamedTuple):
    """A sparse matrix: the entries of row i are ``ptr[i]`` to ``ptr[i + 1]``."""

    ptr: np.ndarray
    col: np.ndarray
    val: np.ndarray
    width: int  # columns

    @property
    def height(self) -> int:
        return len(self.ptr) - 1

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(self.height), np.diff(self.ptr))

    def transposed(self) -> "CSR":
        order = np.argsort(self.col, kind="stable") if (np.diff(self.col) < 0).any() else slice(None)
        ptr = np.concatenate([[0], np.cumsum(np.bincount(self.col, minlength=self.width))])
        return CSR(ptr, self.rows()[order], self.val[order], self.height)


def summed(row: np.ndarray, col: np.ndarray, val: np.ndarray, shape: tuple[int, int]) -> CSR:
    """The matrix with these entries, equal places added up."""
    place = row * shape[1] + col
    if (place[1:] < place[:-1]).any():
        order = np.argsort(place, kind="stable")
        place, val = place[order], val[order]
    first = np.ones(len(place), bool)
    first[1:] = place[1:] != place[:-1]
    at = np.flatnonzero(first)
    if len(at) < len(place):
        place, val = place[at], np.add.reduceat(val, at)
    row, col = np.divmod(place, max(shape[1], 1))
    return CSR(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=shape[0]))]), col, val, shape[1])


def product(a: CSR, b: CSR, most: int = EXPANDED) -> CSR:
    """``a @ b`` by Gustavson's row products, rows at a time so that their entries' products
    are at most ``most``, or those of one row."""
    length = np.diff(b.ptr)[a.col]  # of the row of b that each entry points to
    until = np.concatenate([[0], np.cumsum(length)])
    of_row = until[a.ptr]
    parts, i = [], 0
    while i < a.height:
        j = max(i + 1, int(np.searchsorted(of_row, of_row[i] + most, side="right")) - 1)
        own = slice(a.ptr[i], a.ptr[j])
        size = length[own]
        at = np.arange(of_row[j] - of_row[i]) + np.repeat(b.ptr[a.col[own]] - (until[own] - of_row[i]), size)
        row = np.repeat(np.repeat(np.arange(j - i), np.diff(a.ptr[i : j + 1])), size)
        parts.append(summed(row, b.col[at], np.repeat(a.val[own], size) * b.val[at], (j - i, b.width)))
        i = j
    ptr = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *(np.diff(p.ptr) for p in parts)]))])
    empty = np.zeros(0, np.int64)
    return CSR(ptr, np.concatenate([empty, *(p.col for p in parts)]), np.concatenate([empty, *(p.val for p in parts)]), b.width)


def token_bytes(ends: np.ndarray, starts: np.ndarray) -> CSR:
    """Tokens and the bytes they cover."""
    size = ends - starts
    ptr = np.concatenate([[0], np.cumsum(size)])
    col = np.arange(ptr[-1]) + np.repeat(starts - ptr[:-1], size)
    return CSR(ptr, col, np.ones(len(col), np.int64), int(ends[-1]) if len(ends) else 0)


def overlap_links(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray) -> CSR:
    """Tokens of A and of B that share bytes, with how many."""
    return product(token_bytes(ends_a, starts_a), token_bytes(ends_b, starts_b).transposed())


def _byte_values() -> dict[str, int]:
    """The characters that byte-level tokenizers write bytes as: visible Latin-1 ones
    stand for themselves, the others in order from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def _ranked(path: str, entries: list[bytes]):
    """The file's tokenizer for the faster of the two libraries, or None if it has rules
    besides byte-level merges in the order of their ids."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    model, before = rules["model"], rules.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not rules.get("normalizer")
    if not plain or model.get("type") != "BPE" or model.get("ignore_merges") or model.get("dropout"):
        return None
    merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    made = [model["vocab"].get(m.replace(" ", "", 1)) for m in merges]
    first = 256
    if made != list(range(first, first + len(merges))) or sorted(entries[:first]) != [bytes([b]) for b in range(256)]:
        return None
    import public_tokenizers
    import tiktoken

    ranks = {entry: i for i, entry in enumerate(entries[: first + len(merges)])}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Vocabulary:
    """Ids of texts, and each id's bytes."""

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = tokenizer_file(name)
        if path.endswith(".model"):
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            names = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
            entries = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
            self.encode = lambda texts: pieces.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.encode_special_tokens = True  # their strings are ordinary text
            value = _byte_values()
            known = library.get_vocab(with_added_tokens=True)
            entries = [b""] * (max(known.values()) + 1)
            for token, i in known.items():
                entries[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
            ranked = _ranked(path, entries)
            if ranked:
                self.encode = lambda texts: [ranked.encode_ordinary(" " + t) for t in texts]
            else:
                self.encode = lambda texts: [e.ids for e in library.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        self.size = np.array([len(e) for e in entries], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin, plus the end."""
        found = self.encode(texts)
        at = np.concatenate([[0], np.cumsum([len(f) for f in found], dtype=np.int64)])
        return np.fromiter(chain.from_iterable(found), np.int64, at[-1]), at

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.data[np.arange(ends[-1] if len(ids) else 0) + np.repeat(self.begin[ids] - (ends - size), size)]


@lru_cache(maxsize=4)
def vocabulary(name: str) -> Vocabulary:
    """This worker's vocabulary, kept from task to task."""
    return Vocabulary(name)


class Aligned(NamedTuple):
    """Tokens of several texts one after the other. Bytes and groups are numbered through."""

    a: np.ndarray  # ids
    b: np.ndarray
    at_a: np.ndarray  # where each text's tokens begin, plus the end
    at_b: np.ndarray
    ends_a: np.ndarray  # the byte after each token
    ends_b: np.ndarray
    group_a: np.ndarray  # of each token
    group_b: np.ndarray
    groups: np.ndarray  # where each text's groups begin, plus the end


def _spelled(vocab: Vocabulary, ids: np.ndarray, at: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of which texts the joined bytes of the tokens are the text's."""
    until = np.concatenate([[0], np.cumsum(vocab.size[ids])])[at]
    right = np.diff(until) == np.diff(bounds)
    spelled = vocab.bytes_of(ids)
    for k in np.flatnonzero(right).tolist():
        right[k] = np.array_equal(spelled[until[k] : until[k + 1]], data[bounds[k] : bounds[k + 1]])
    return right


def aligned(texts: list[str], a: Vocabulary, b: Vocabulary) -> Aligned:
    """Tokens and groups of each text with a space before it; none for an empty text, and
    where the bytes of either side's tokens are not those of space and text."""
    data, bounds = W.text_bytes(pa.array([" " + t if t else "" for t in texts], pa.string()))
    good, sides = np.diff(bounds) > 0, []
    for vocab in (a, b):
        own, at = vocab.ids(texts)
        sides.append((vocab, own, at))
        good &= _spelled(vocab, own, at, data, bounds)
    out = []
    for vocab, own, at in sides:
        count = np.where(good, np.diff(at), 0)
        ids = own[np.repeat(good, np.diff(at))]
        out.append((ids, np.concatenate([[0], np.cumsum(count)]), np.cumsum(vocab.size[ids])))
    (a_ids, at_a, ends_a), (b_ids, at_b, ends_b) = out
    text_ends = np.cumsum(np.where(good, np.diff(bounds), 0))
    n = int(text_ends[-1]) if len(text_ends) else 0
    cut, other = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    cut[ends_a], other[ends_b] = True, True
    cut &= other  # a text's end is always one
    group = np.zeros(n + 2, np.int64)  # how many cuts are before a byte
    np.cumsum(cut, out=group[1:])
    groups = np.concatenate([[0], group[text_ends + 1]])
    return Aligned(a_ids, b_ids, at_a, at_b, ends_a, ends_b, group[ends_a], group[ends_b], groups)


def _incidence(ids: np.ndarray, group: np.ndarray, width: int) -> tuple[CSR, np.ndarray]:
    """Tokens and their groups, and the tokens' ids. In a group of many tokens those of one
    id are one row that counts them, so a long group of few ids stays small."""
    many = (np.bincount(group, minlength=width) > FEW)[group] if len(group) else np.zeros(0, bool)
    count = np.ones(len(ids), np.int64)
    if many.any():
        most = int(ids.max()) + 1
        rows, times = np.unique(group[many] * most + ids[many], return_counts=True)
        group, ids = np.concatenate([group[~many], rows // most]), np.concatenate([ids[~many], rows % most])
        count = np.concatenate([count[~many], times])
        order = np.argsort(group, kind="stable")
        group, ids, count = group[order], ids[order], count[order]
    return CSR(np.arange(len(ids) + 1), group, count, width), ids


def group_links(x: Aligned, size_a: int, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, id of A, id of B, links), sorted: how many pairs of tokens with these ids are
    in one group."""
    width = int(x.groups[-1])
    a, ids_a = _incidence(x.a, x.group_a, width)
    b, ids_b = _incidence(x.b, x.group_b, width)
    links = product(a, b.transposed())
    row = links.rows()
    text = np.searchsorted(x.groups, np.arange(width), side="right")[a.col[row]] - 1
    key = (text * size_a + ids_a[row]) * size_b + ids_b[links.col]
    place = np.sort(key)
    first = np.ones(len(place), bool)
    first[1:] = place[1:] != place[:-1]
    at = np.flatnonzero(first)
    place, total = place[at], np.diff(np.append(at, len(place)))
    several = np.flatnonzero(links.val > 1)  # each is in total once already
    np.add.at(total, np.searchsorted(place, key[several]), links.val[several] - 1)
    return place // (size_a * size_b), place // size_b % size_a, place % size_b, total


def spelled_groups(x: Aligned) -> list[bytes]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3``: decimal ids in order."""
    width, n = int(x.groups[-1]), len(x.a) + len(x.b)
    until_a, until_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=width))]).astype(np.int64) for g in (x.group_a, x.group_b))
    ids, mark = np.zeros(n, np.int64), np.full(n, ord(","), np.uint8)
    ids[np.arange(len(x.a)) + until_b[x.group_a]] = x.a  # behind B's tokens of earlier groups
    ids[np.arange(len(x.b)) + until_a[x.group_b + 1]] = x.b
    mark[until_a[1:] + until_b[:-1] - 1], mark[until_a[1:] + until_b[1:] - 1] = ord("|"), ord(";")
    known = 1 + int(ids.max(initial=0))
    spelling = np.array([str(i) for i in range(known)], f"S{len(str(known - 1)) + 1}")
    digits = np.char.str_len(spelling)[ids]
    table = spelling.view(np.uint8).reshape(known, -1)[ids]
    table[np.arange(n), digits] = mark
    flat = table[np.arange(table.shape[1]) <= digits[:, None]]
    total = np.concatenate([[0], np.cumsum(digits + 1)])[x.at_a + x.at_b]
    return [flat[i : max(i, j - 1)].tobytes() for i, j in zip(total[:-1].tolist(), total[1:].tolist())]


# -- over a corpus -------------------------------------------------------------------


def _slices(docs: DataFrame, key: str, text: str, tokenizers: tuple[str, str]) -> DataFrame:
    """A row for each slice of documents: its keys and their figures, its distinct pairs
    with the number of its documents that hold them, and per document how many links it
    has of which pairs (numbered in the slice)."""
    kind = docs.schema[key].dataType.simpleString()
    schema = (
        f"slice string, keys array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, overlaps array<long>, "
        "spelled array<string>, pair_a binary, pair_b binary, holders binary, entries binary, places binary, links binary"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        a, b = (vocabulary(t) for t in tokenizers)
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            column = batch.column("text")
            for i, j in W.slices(W.text_bytes(column)[1], SLICE):
                x = aligned([t or "" for t in column.slice(i, j - i).to_pylist()], a, b)
                doc, id_a, id_b, links = group_links(x, len(a.size), len(b.size))
                pairs, place, holders = np.unique(id_a * len(b.size) + id_b, return_inverse=True, return_counts=True)
                entries = np.bincount(doc, minlength=j - i)
                shared = overlap_links(x.ends_a - a.size[x.a], x.ends_a, x.ends_b - b.size[x.b], x.ends_b)
                overlaps = np.diff(shared.ptr[x.at_a])
                spelled = [hashlib.sha256(s).hexdigest() if s else "" for s in spelled_groups(x)]
                lists = [batch.column("key").slice(i, j - i), *(pa.array(v, pa.int64()) for v in (np.diff(x.at_a), np.diff(x.at_b), np.diff(x.groups), overlaps)), pa.array(spelled, pa.string())]
                packed = [pairs // len(b.size), pairs % len(b.size), holders, entries, place]
                values = [pa.array([f"{task}-{number}"], pa.string())]
                values += [pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), v) for v in lists]
                values += [pa.array([v.astype("<u4").tobytes()], pa.binary()) for v in packed]
                values.append(pa.array([links.astype("<i8").tobytes()], pa.binary()))
                number += 1
                yield pa.RecordBatch.from_arrays(values, names)

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, schema)


def _unpacked(batch: pa.RecordBatch, name: str, row: int, kind: str = "<u4") -> np.ndarray:
    return np.frombuffer(batch.column(name)[row].as_buffer(), kind).astype(np.int64)


def pair_counts(slices: DataFrame) -> DataFrame:
    """a, b, n (documents that hold the pair linked), best (n is the highest of a's).
    Tasks add up before the shuffle."""

    def run(batches):
        held, many = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(held >> 32), pa.array(held & 0xFFFFFFFF), pa.array(many)], ["a", "b", "n"])

        for batch in batches:
            for row in range(batch.num_rows):
                pairs = (_unpacked(batch, "pair_a", row) << 32) | _unpacked(batch, "pair_b", row)
                held, back = np.unique(np.concatenate([held, pairs]), return_inverse=True)
                many = np.bincount(back, np.concatenate([many, _unpacked(batch, "holders", row)]), len(held)).astype(np.int64)
                if len(held) > PAIRS:
                    yield out()
                    held, many = held[:0], many[:0]
        yield out()

    counts = slices.select("pair_a", "pair_b", "holders").mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a")))


def _listed(slices: DataFrame) -> DataFrame:
    """slice, place, a, b: the pairs of each slice."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                a, b = _unpacked(batch, "pair_a", row), _unpacked(batch, "pair_b", row)
                own = pa.array([batch.column("slice")[row].as_py()] * len(a), pa.string())
                yield pa.RecordBatch.from_arrays([own, pa.array(np.arange(len(a)), pa.int32()), pa.array(a), pa.array(b)], ["slice", "place", "a", "b"])

    return slices.select("slice", "pair_a", "pair_b").mapInArrow(run, "slice string, place int, a long, b long")


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizers: tuple[str, str] = (TOKENIZER_A, TOKENIZER_B)) -> tuple[DataFrame, DataFrame]:
    """The alignment of each document, and the corpus's pairs.

    The first table has one row for each document: ``key``, n_a, n_b (tokens), n_groups,
    n_overlaps (pairs of tokens that share a byte), n_links (pairs of tokens in one
    group), n_best (those whose pair of ids is in as many documents as any of its A id,
    ties included), count_sum (these numbers of documents, over all links), groups_sha256.
    The second has a, b, n and best: linked ids, in how many documents, and whether no
    other partner of the A id is in more.

    A null or empty text has no tokens, and zeros, and so has one that either tokenizer
    does not spell byte by byte; its groups_sha256 is empty. Repeated rows are documents
    of their own. Columns that are not named are ignored, whatever their names.
    """
    slices = staged(_slices(docs, key, text, tokenizers), "aligned-slices", compression="zstd")
    counts = staged(pair_counts(slices), "pair-counts")
    answers = _listed(slices).join(counts, ["a", "b"]).groupBy("slice").agg(F.collect_list(F.struct("place", "n", "best")).alias("answers"))
    rows = slices.drop("pair_a", "pair_b", "holders").join(answers, "slice", "left")
    kind = docs.schema[key].dataType.simpleString()
    names = ["key", "n_a", "n_b", "n_groups", "n_overlaps", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                answer = batch.column("answers")[row].values
                found, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if answer is not None:
                    place = answer.field("place").to_numpy()
                    found, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
                    found[place] = answer.field("n").to_numpy()
                    best[place] = answer.field("best").to_numpy(zero_copy_only=False)
                at = np.concatenate([[0], np.cumsum(_unpacked(batch, "entries", row))])
                place, links = _unpacked(batch, "places", row), _unpacked(batch, "links", row, "<i8")
                sums = [np.diff(np.concatenate([[0], np.cumsum(v)])[at]) for v in (links, links * best[place], links * found[place])]
                lists = [batch.column(c)[row].values for c in ("keys", "n_a", "n_b", "n_groups", "overlaps")]
                yield pa.RecordBatch.from_arrays([*lists, *(pa.array(v, pa.int64()) for v in sums), batch.column("spelled")[row].values], names)

    schema = f"key {kind}, n_a long, n_b long, n_groups long, n_overlaps long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key), counts
