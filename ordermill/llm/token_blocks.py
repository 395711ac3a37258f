"""Token ids in patched frame-of-reference blocks.

A shard file holds the ids of neighbouring documents as one run, cut into blocks of BLOCK ids::

    magic "OMTB1\\0\\0\\0" | n_docs u64 | n_ids u64 | n_blocks u64
    documents: doc_id i64[n_docs], is_null u8[n_docs], first id u64[n_docs + 1]
    block index: place of the block's words in the payload u64[n_blocks + 1]
    block minimum u32[n_blocks], width u8[n_blocks], exceptions before the block u64[n_blocks + 1]
    exception lists: place in block u16[n], full difference u32[n]
    payload u32[]: per block and lane 32 values of the block's width

A block's minimum is subtracted, the width is that of the PERCENTILE-th difference, and differences that
need more go to the exception list. A value's place in the payload follows from the index, so one block
can be read alone. Shards are written by the tasks that sort the documents; a manifest names the shards
of the attempts that counted, so a lost or repeated task leaves at most an unread file.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import crc, modest_batches, quoted, saved
from ordermill.llm.tokens import END, tokenizer, vocabulary_path
from ordermill.session import fresh_dir

MAGIC = b"OMTB1\0\0\0"
LANES, PER_LANE = 32, 32
BLOCK = LANES * PER_LANE
PERCENTILE = 95
#: Ids from which a shard is closed.
SHARD_IDS = 4 << 20
WIDTHS = 33


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that hold each value; exact below 2**53."""
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.uint8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, BLOCK) values below 2**width to (blocks, width * LANES) words."""
    v = values.reshape(-1, PER_LANE, LANES)
    out = np.zeros((len(v), width, LANES), np.uint32)
    for k in range(PER_LANE):
        word, shift = divmod(k * width, 32)
        out[:, word] |= v[:, k] << np.uint32(shift)
        if shift + width > 32:
            out[:, word + 1] |= v[:, k] >> np.uint32(32 - shift)
    return out.reshape(len(v), -1)


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    p = packed.reshape(-1, width, LANES)
    out = np.zeros((len(p), PER_LANE, LANES), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for k in range(PER_LANE):
        word, shift = divmod(k * width, 32)
        v = p[:, word] >> np.uint32(shift)
        if shift + width > 32:
            v = v | p[:, word + 1] << np.uint32(32 - shift)
        out[:, k] = v & mask
    return out.reshape(len(p), BLOCK)


def encode(doc_ids: list[int | None], ids: list[bytes], percentile: int = PERCENTILE) -> bytes:
    """One shard: the documents' ids (little-endian u32) in the order given."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    firsts = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids], dtype=np.uint64)]).astype("<u8")
    blocks = -(-len(flat) // BLOCK)
    padded = np.empty(blocks * BLOCK, np.uint32)
    padded[: len(flat)] = flat
    padded[len(flat) :] = flat[-1] if len(flat) else 0
    table = padded.reshape(blocks, BLOCK)
    least = table.min(axis=1) if blocks else np.zeros(0, np.uint32)
    diff = table - least[:, None]
    cut = BLOCK * percentile // 100 - 1
    widths = _bits(np.partition(diff, cut, axis=1)[:, cut]) if blocks else np.zeros(0, np.uint8)
    large = diff >> np.minimum(widths, 31)[:, None].astype(np.uint32) > 0
    large[widths == 32] = False
    rows, places = np.nonzero(large)
    values = diff[rows, places]
    diff[rows, places] = 0
    before = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=blocks))]).astype("<u8")
    index = np.concatenate([[0], np.cumsum(widths.astype(np.uint64) * LANES)]).astype("<u8")
    payload = np.zeros(int(index[-1]), "<u4")
    for width in np.unique(widths):
        if width:
            which = np.flatnonzero(widths == width)
            at = index[which].astype(np.int64)[:, None] + np.arange(int(width) * LANES)
            payload[at] = _pack(diff[which], int(width))
    null = np.array([d is None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    parts = (numbers, null, firsts, index, least.astype("<u4"), widths, before, places.astype("<u2"), values.astype("<u4"), payload)
    return MAGIC + struct.pack("<QQQ", len(ids), len(flat), blocks) + b"".join(x.tobytes() for x in parts)


class Shard:
    """A shard's bytes, read by block."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token shard")
        self.n_docs, self.n_ids, self.n_blocks = struct.unpack_from("<QQQ", data, 8)
        at = 32

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, int(n), at)
            at += out.nbytes
            return out

        numbers, null = take("<i8", self.n_docs), take("u1", self.n_docs)
        self.doc_ids = [None if x else int(d) for d, x in zip(numbers, null)]
        self.firsts = take("<u8", self.n_docs + 1)
        self._index = take("<u8", self.n_blocks + 1)
        self._least, self._widths = take("<u4", self.n_blocks), take("u1", self.n_blocks)
        self._before = take("<u8", self.n_blocks + 1)
        n = int(self._before[-1])
        self._places, self._values = take("<u2", n), take("<u4", n)
        self._payload = take("<u4", self._index[-1])

    def blocks(self, first: int, end: int) -> np.ndarray:
        """The ids of blocks ``first`` to ``end`` (exclusive) in a row; nothing else is unpacked."""
        out = np.zeros((end - first, BLOCK), np.uint32)
        widths = self._widths[first:end]
        for width in np.unique(widths):
            if width:
                which = np.flatnonzero(widths == width)
                at = self._index[first:end][which].astype(np.int64)[:, None] + np.arange(int(width) * LANES)
                out[which] = _unpack(self._payload[at], int(width))
        before = self._before[first : end + 1].astype(np.int64)
        rows = np.repeat(np.arange(end - first), np.diff(before))
        out[rows, self._places[before[0] : before[-1]]] = self._values[before[0] : before[-1]]
        return (out + self._least[first:end, None]).reshape(-1)

    def ids(self) -> np.ndarray:
        return self.blocks(0, self.n_blocks)[: self.n_ids]

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document, from its own blocks."""
        a, b = int(self.firsts[k]), int(self.firsts[k + 1])
        if a == b:
            return np.zeros(0, np.uint32)
        first = a // BLOCK
        return self.blocks(first, -(-b // BLOCK))[a - first * BLOCK : b - first * BLOCK]


MANIFEST = "part int, ordinal int, file string, n_docs bigint, n_ids bigint, bytes bigint"


def write(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
          shard_ids: int = SHARD_IDS, percentile: int = PERCENTILE) -> tuple[str, DataFrame]:
    """Write all texts' ids in ascending id order (null ids last); (folder, manifest with a row per shard).

    Rows with equal ids stay apart, in the order of their texts. The folder lies in the shared one, where
    every executor writes by its address. An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    modest_batches(spark)
    folder, path = fresh_dir(spark, "tokens"), vocabulary or vocabulary_path()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        part, ordinal = TaskContext.get().partitionId(), 0
        encoder = tokenizer(path)
        doc_ids: list = []
        ids: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal ordinal, held
            data = encode(doc_ids, ids, percentile)
            file = f"shard-{part:06d}-{ordinal:04d}-{uuid.uuid4().hex}.omtb"
            with store.open_output_stream(f"{root}/{file}") as out:
                out.write(data)
            row = dict(part=[part], ordinal=[ordinal], file=[file], n_docs=[len(ids)], n_ids=[held], bytes=[len(data)])
            ordinal, held = ordinal + 1, 0
            doc_ids.clear()
            ids.clear()
            kinds = {"part": pa.int32(), "ordinal": pa.int32(), "file": pa.string()}
            return pa.RecordBatch.from_pydict(row, pa.schema([(k, kinds.get(k, pa.int64())) for k in row]))

        for batch in batches:
            for number, encoded in zip(batch.column(0).to_pylist(), encoder.ids(batch.column(1).to_pylist())):
                doc_ids.append(number)
                ids.append(encoded)
                held += len(encoded) // 4
                if held >= shard_ids:
                    yield close()
        if ids:
            yield close()

    rows = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).alias("text"))
    order = [F.col("id").asc_nulls_last(), F.col("text").asc_nulls_first()]
    placed = rows.repartitionByRange(F.col("id").asc_nulls_last()).sortWithinPartitions(*order)
    return folder, saved(placed.mapInArrow(shards, MANIFEST), "token-manifest")


READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def read(folder: str, manifest: DataFrame) -> DataFrame:
    """A row per document, from the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    order = Window.orderBy("part", "ordinal").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(order), F.lit(0))).select("file", "first")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_stream(f"{root}/{file}") as source:
                    shard = Shard(source.read())
                ids, firsts = shard.ids().astype("<u4"), shard.firsts.astype(np.int64)
                crcs = [crc(ids[a:b].tobytes()) for a, b in zip(firsts[:-1], firsts[1:])]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(shard.doc_ids, pa.int64()), "start": firsts[:-1] + first,
                    "n_tokens": np.diff(firsts), "ids_crc32": pa.array(crcs, pa.int64()),
                })

    files = manifest.count()
    return starts.repartition(max(1, min(files, 20_000)), "file").mapInArrow(decoded, READ)


def op2(docs: DataFrame) -> DataFrame:
    return read(*write(docs))


__all__ = ["END", "Shard", "encode", "op2", "read", "write"]
