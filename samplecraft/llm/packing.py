"""Vector bin packing of training examples into sequences.

A sequence has three limits at once: tokens, segments (examples or pieces of them) and
loss-bearing tokens. Sequences are filled one after the other from a pool of waiting
examples: of those that still fit in every dimension, the next is the one whose demand
has the largest dot product with the room that is left, both as parts of the limits. So
an example that uses what is plentiful is taken before one that uses what is scarce.

Each task packs the rows of its own partition, holding at most ``POOL`` examples and
``HELD`` tokens (or one example), so nothing is shuffled and memory is bounded; what
that costs is one unfinished sequence for each partition. Sequence numbers are unique:
the partition's number times 2^40 plus a counter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .tokens import SLICE, WORD_TOKENIZER, encoder

TOKENS = 2048
SEGMENTS = 128
POOL = 2048  # examples that wait in a task
HELD = 4_000_000  # tokens that wait in a task
END = 1  # the id that ends a document
_COUNTER = 40  # bits of a sequence's number within its partition


class Pool:
    """Waiting examples of a task and the sequences made of them.

    ``cut`` allows an example to be cut so that a sequence gets full.
    """

    def __init__(self, limits: tuple[int, int, int], cut: bool):
        self.limits = np.array(limits, dtype=np.float64)
        self.cut = cut
        self.demand = np.zeros((0, 3))
        self.key = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        self.sequences = 0
        self.room, self.offset = self.limits.copy(), 0

    def add(self, keys: np.ndarray, demand: np.ndarray) -> None:
        self.demand = np.concatenate([self.demand, demand])
        self.key = np.concatenate([self.key, keys])
        self.start = np.concatenate([self.start, np.zeros(len(keys), np.int64)])

    def __len__(self) -> int:
        return len(self.key)

    def _close(self) -> None:
        self.sequences += 1
        self.room, self.offset = self.limits.copy(), 0

    def _take(self, i: int, tokens: int) -> tuple[int, int, int, int, int]:
        """Place the first ``tokens`` of a waiting example in the open sequence."""
        piece = (int(self.key[i]), int(self.start[i]), tokens, self.sequences, self.offset)
        whole = self.demand[i, 0] <= tokens
        used = self.demand[i].copy() if whole else np.array([tokens, 1, tokens])  # cut ones count whole
        self.room -= used
        self.offset += tokens
        if whole:
            last = len(self.key) - 1
            for a in (self.demand, self.key, self.start):
                a[i] = a[last]
            self.demand, self.key, self.start = self.demand[:last], self.key[:last], self.start[:last]
        else:
            self.start[i] += tokens
            self.demand[i] -= [tokens, 0, used[2]]
        return piece

    def pieces(self, least: int) -> Iterator[tuple[int, int, int, int, int]]:
        """Place examples while more than ``least`` wait: key, start, tokens, sequence
        (counted from 0), offset."""
        while len(self.key) > least:
            if (self.room <= 0).any() if self.cut else (self.room[:2] <= 0).any():
                self._close()
            # The last segment of a sequence is better cut to size than left short.
            only = self.cut and self.room[1] < 2
            fits = (self.demand <= self.room).all(axis=1)
            if only:
                fits &= self.demand[:, 0] >= self.room[0]
            if fits.any():
                score = self.demand @ (self.room / self.limits**2)
                i = int(np.argmax(np.where(fits, score, -1.0)))
                yield self._take(i, int(self.demand[i, 0]))
            elif self.cut:
                i = int(np.argmax(self.demand[:, 0]))
                yield self._take(i, int(min(self.demand[i, 0], self.room[0], self.room[2])))
            elif self.offset:
                self._close()
            else:  # more than a whole sequence allows: one of its own
                i = int(np.argmax((self.demand > self.room).any(axis=1)))
                yield self._take(i, int(self.demand[i, 0]))
                self._close()


def binary_tail(pieces: list[tuple[int, int, int, int, int]], first: int) -> list[tuple[int, int, int, int, int]]:
    """The pieces of one unfinished sequence, cut again so that each of the sequences
    they make (numbered from ``first``) has a power of two as its length."""
    out, sequence, offset = [], first, 0
    left = sum(p[2] for p in pieces)
    size = 1 << (left.bit_length() - 1) if left else 0
    for key, start, length, _, _ in pieces:
        while length:
            n = min(length, size - offset)
            out.append((key, start, n, sequence, offset))
            start, length, offset, left = start + n, length - n, offset + n, left - n
            if offset == size:
                sequence, offset, size = sequence + 1, 0, 1 << (left.bit_length() - 1) if left else 0
    return out


def pack_examples(
    examples: DataFrame,
    key: str = "example_id",
    tokens: str = "tokens",
    loss_tokens: str = "loss_tokens",
    limits: tuple[int, int, int] = (TOKENS, SEGMENTS, TOKENS),
) -> DataFrame:
    """Pack whole examples: ``key`` (as it is), tokens, loss_tokens, sequence_id, offset.

    Nothing is cut. Null or negative counts are 0; an example without tokens still is a
    segment. An example that alone breaks a limit gets a sequence of its own. Repeated
    rows are packed once each. Other columns are ignored.
    """
    kind = examples.schema[key].dataType
    rows = examples.select(
        F.col(f"`{key}`").alias("key"),
        *[F.greatest(F.coalesce(F.col(f"`{c}`").cast("long"), F.lit(0)), F.lit(0)).alias(n) for c, n in ((tokens, "tokens"), (loss_tokens, "loss_tokens"))],
    )

    def pack(batches):
        base, pool, waiting, seen = TaskContext.get().partitionId() << _COUNTER, Pool(limits, cut=False), {}, 0

        def drained(least):
            found = [(*waiting.pop(k), base + s, o) for k, _, _, s, o in pool.pieces(least)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found) if found else ([],) * 5, types)], names)

        for batch in batches:
            names = ["key", "tokens", "loss_tokens", "sequence_id", "offset"]
            types = [batch.schema.field("key").type, *[pa.int64()] * 4]
            rows = list(zip(*(batch.column(c).to_pylist() for c in names[:3])))
            for i in range(0, len(rows), POOL):
                part = rows[i : i + POOL]
                keys = np.arange(seen, seen + len(part))
                seen += len(part)
                waiting |= dict(zip(keys.tolist(), part))
                pool.add(keys, np.array([(t, 1, loss) for _, t, loss in part], dtype=np.float64))
                yield drained(POOL)
        if seen:
            yield drained(0)

    schema = f"key {kind.simpleString()}, tokens long, loss_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(pack, schema).withColumnRenamed("key", key)


def pack_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = WORD_TOKENIZER,
    end: int = END,
    limits: tuple[int, int, int] = (TOKENS, SEGMENTS, TOKENS),
    with_ids: bool = False,
) -> DataFrame:
    """Encode whole documents, end each with ``end`` and pack them, cut where it helps.

    One row for each piece: ``key``, start (ids of the document before it), length,
    ids_crc32 (of the piece's ids as little-endian unsigned 32-bit integers),
    doc_tokens, sequence_id, offset, and with ``with_ids`` the ids. Every id of a
    document counts for the loss. Full sequences have ``limits[0]`` ids; what a
    partition has left at its end is cut into sequences whose lengths are powers of
    two. A null text is an empty one, which still has the end id; repeated rows are
    documents of their own; no rows give no rows; other columns are ignored.
    """
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def pack(batches):
        encode, pool = encoder(tokenizer), Pool(limits, cut=True)
        base, seen, held = TaskContext.get().partitionId() << _COUNTER, 0, 0
        documents, left = {}, {}  # of those not wholly written: key and ids, ids to write
        done, opened = [], []  # pieces of finished sequences, of the one being filled
        names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]

        def fill(least):
            nonlocal done, opened
            for piece in pool.pieces(least):
                if opened and opened[0][3] != piece[3]:
                    done += opened
                    opened = []
                opened.append(piece)

        def written():
            nonlocal done, held
            columns: list[list] = [[] for _ in names]
            for k, start, length, sequence, offset in done:
                own, ids = documents[k]
                piece = ids[start : start + length]
                values = (own, start, length, zlib.crc32(piece.astype("<u4").tobytes()), len(ids), base + sequence, offset, piece)
                for c, v in zip(columns, values):
                    c.append(v)
                left[k] -= length
                if not left[k]:
                    held -= len(ids)
                    del documents[k], left[k]
            done = []
            kinds = [key_type, *[pa.int64()] * 6, pa.list_(pa.int32())]
            n = 8 if with_ids else 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns[:n], kinds)], names[:n])

        for batch in batches:
            key_type = batch.schema.field("key").type
            keys, texts = batch.column("key").to_pylist(), batch.column("text")
            for i, j in W.slices(W.text_bytes(texts)[1], SLICE):
                ids, at = encode.ids(texts.slice(i, j - i))
                new = np.arange(seen, seen + j - i)
                seen += j - i
                for n, k in enumerate(new.tolist()):
                    own = np.append(ids[at[n] : at[n + 1]], np.int32(end))
                    documents[k], left[k] = (keys[i + n], own), len(own)
                    held += len(own)
                size = np.diff(at) + 1.0
                pool.add(new, np.stack([size, np.ones(j - i), size], axis=1))
                while len(pool) > POOL or held > HELD and len(pool) > 1:
                    fill(max(1, len(pool) - 256))
                    yield written()
        if seen:
            fill(0)
            whole = sum(p[2] for p in opened) == limits[0]
            done += opened if whole or not opened else binary_tail(opened, opened[0][3])
            yield written()

    schema = f"key {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(pack, schema + (", ids array<int>" if with_ids else "")).withColumnRenamed("key", key)
