"""Token ids in files: frequency-ranked, byte-aligned, with separate control bytes.

The format, a Parquet dataset that Spark writes and reads on any store:

* ``blocks``: rows of whole documents in ascending (bucket, block) order, which is
  ascending order of the document's key. A block has the number of ids before it, its
  documents' keys and id counts, ``control`` and ``data``. Control has two bits for
  each id, four ids to a byte, lowest first: the number of data bytes of that id, less
  one. Data has those bytes, little-endian, of the id's rank.
* ``ranks``: the id of each rank. Rank 0 is the id that occurs most often in the whole
  corpus (ties: the smaller id), so the frequent ids need one byte.

A document's ids stay together in one block, so the longest document bounds memory.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.staging import new_path, staged
from . import words as W
from .ranges import LEAST_KEY, bucket_of, key_splits
from .tokens import SLICE, WORD_TOKENIZER, encoder

END = 2  # the id that ends a document
BLOCK = 1 << 20  # ids in a block, unless one document has more
BUCKET = 8_000_000  # ids in a bucket of consecutive documents, about

#: Data bytes of four ids, for each control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1


def coded(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, dtype="<u4")
    lengths = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = lengths - 1
    control = codes.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decoded(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ``count`` values: lengths by table lookup, then all bytes at once."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    at = np.cumsum(lengths) - lengths
    source = np.frombuffer(data, np.uint8)
    values = source[at].astype(np.uint32) if count else np.zeros(0, np.uint32)
    for k in range(1, int(lengths.max(initial=1))):
        longer = lengths > k
        values[longer] |= source[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def encoded(docs: DataFrame, key: str, text: str, tokenizer: str, end: int) -> DataFrame:
    """key, n_tokens and the ids of each document as little-endian 16- or 32-bit bytes.

    At the end of each partition stands a row without tokens whose ``counts`` says how
    often each id occurred in it (64 bits each), so that counting takes no pass over the
    ids.
    """

    def run(batches):
        encode = encoder(tokenizer)
        width = "<u2" if encode.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        counts = np.zeros(end + 1, np.int64)
        for batch in batches:
            texts = batch.column("text")
            for i, j in W.slices(W.text_bytes(texts)[1], SLICE):
                ids, at = encode.ids(texts.slice(i, j - i))
                own = np.bincount(ids, minlength=len(counts))
                own[: len(counts)] += counts
                own[end] += j - i
                counts = own
                parts = [np.append(ids[a:b], np.int32(end)) for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(i, j - i),
                        pa.array([len(p) for p in parts], pa.int64()),
                        pa.array([p.astype(width).tobytes() for p in parts], pa.binary()),
                        pa.nulls(j - i, pa.binary()),
                    ],
                    names,
                )
        last = [(None, pa.int64()), (0, pa.int64()), (b"", pa.binary()), (counts.astype("<i8").tobytes(), pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in last], names)

    names = ["key", "n_tokens", "ids", "counts"]

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "key long, n_tokens long, ids binary, counts binary")


def _ids(ids: bytes, count: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * count else "<u4")


def id_counts(counts: DataFrame) -> DataFrame:
    """How often each id occurs in the whole corpus: id, n. Summed in tasks first."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for one in batch.column("counts"):
                own = np.frombuffer(one.as_buffer(), "<i8")
                if len(own) > len(total):
                    total = np.concatenate([total, np.zeros(len(own) - len(total), np.int64)])
                total[: len(own)] += own
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["id", "n"])

    return counts.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = WORD_TOKENIZER,
    end: int = END,
) -> str:
    """Encode all documents and write them below ``path``; returns ``path``.

    A null text is an empty one: its only id is ``end``. Repeated rows are documents of
    their own; documents of the same key follow one another in the order of their
    ids. A null key comes first. No rows give files without blocks. Columns other than
    the key (a long) and the text are ignored.
    """
    spark = docs.sparkSession
    stored = staged(encoded(docs, key, text, tokenizer, end), "token-ids", compression="zstd")
    rows = stored.filter("n_tokens > 0").select("key", "n_tokens", "ids")
    # At most one row for each id of the tokenizer, whose vocabulary bounds it.
    order = id_counts(stored.select("counts").filter("counts IS NOT NULL")).orderBy(F.desc("n"), "id").select("id").toPandas()["id"].to_numpy()
    spark.createDataFrame([(int(end), [int(x) for x in order])], "end_id int, ids array<int>").coalesce(1).write.parquet(f"{path}/ranks")
    ranks = np.zeros(int(order.max(initial=0)) + 1, np.uint32)
    ranks[order] = np.arange(len(order))

    splits = key_splits(rows, "key", BUCKET, weight="n_tokens")
    rows = rows.withColumn("bucket", bucket_of(splits)(F.coalesce("key", F.lit(LEAST_KEY))))
    totals = {r.bucket: r.n for r in rows.groupBy("bucket").agg(F.sum("n_tokens").alias("n")).collect()}
    before, so_far = {}, 0
    for b in sorted(totals):
        before[b], so_far = so_far, so_far + totals[b]

    def pack(batches):
        state: dict = {"bucket": None}

        def block():
            values = np.concatenate([ranks[p] for p in state["parts"]])
            control, data = coded(values)
            row = [state["bucket"], state["block"], state["first"], state["keys"], [len(p) for p in state["parts"]], control, data]
            state["first"] += len(values)
            state.update(block=state["block"] + 1, parts=[], keys=[], held=0)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names)

        names = ["bucket", "block", "first", "keys", "counts", "control", "data"]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        for batch in batches:
            for k, n, ids, b in zip(*(batch.column(c) for c in ("key", "n_tokens", "ids", "bucket"))):
                b, n = b.as_py(), n.as_py()
                if b != state["bucket"]:
                    if state.get("parts"):
                        yield block()
                    state = {"bucket": b, "block": 0, "first": before[b], "parts": [], "keys": [], "held": 0}
                if state["held"] and state["held"] + n > BLOCK:
                    yield block()
                state["parts"].append(_ids(ids.as_py(), n))
                state["keys"].append(k.as_py())
                state["held"] += n
        if state.get("parts"):
            yield block()

    blocks = (
        rows.repartitionById(len(splits) + 1, "bucket")
        .sortWithinPartitions("bucket", F.col("key").asc_nulls_first(), "ids")
        .mapInArrow(pack, "bucket int, block int, first long, keys array<long>, counts array<long>, control binary, data binary")
    )
    blocks.write.option("compression", "zstd").parquet(f"{path}/blocks")
    return path


def read_token_files(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """The documents of token files: ``key``, start (ids of all documents before it),
    n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers), and with
    ``with_ids`` the ids."""
    order = np.array(spark.read.parquet(f"{path}/ranks").first().ids, np.uint32)
    blocks = spark.read.parquet(f"{path}/blocks")

    def unpack(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                first, keys, counts, control, data = (batch.column(c)[row].as_py() for c in ("first", "keys", "counts", "control", "data"))
                ids = order[decoded(control, data, sum(counts))] if len(order) else np.zeros(0, np.uint32)
                ends = np.cumsum(counts)
                parts = np.split(ids.astype("<u4"), ends[:-1])
                columns = [
                    pa.array(keys, pa.int64()),
                    pa.array(first + ends - counts, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    names = ["key", "start", "n_tokens", "ids_crc32", "ids"]
    schema = "key long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return blocks.mapInArrow(unpack, schema).withColumnRenamed("key", key)


def new_token_files(docs: DataFrame, **options) -> str:
    """Write to a new folder of the cluster's shared folder; returns its path."""
    return write_token_files(docs, new_path(docs.sparkSession, "token-files"), **options)
