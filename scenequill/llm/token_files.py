"""Token ids on disk: fixed-width bit packing with block offsets.

A shard is one byte string: a header, the doc_ids, where each document's ids begin, a table of block offsets, and blocks of
4096 ids, each id in the fewest bits that hold the vocabulary. A block unpacks with three numpy calls, and any document is
read by touching only its own blocks. Shards are written through Spark's Parquet writer, one row per shard, so that its
commit protocol covers them on every file system: a retried or lost task leaves no half-written shard. ``Shard`` reads the
same bytes from memory or from a mapped file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_id, documents, keyed, partitions, python_ready, slices, stage
from .tokens import encoder, vocabulary, with_end

MAGIC, BLOCK, SHARD_IDS = b"TIDS0001", 4096, 1 << 22
_HEAD = struct.Struct("<8sIIQQQ")  # magic, bits, documents, ids, blocks, ids before it in its part


def pack_bits(ids: np.ndarray, bits: int) -> np.ndarray:
    """Big-endian bit string of the ids, ``bits`` each, padded to a whole byte."""
    wide = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(wide[:, 32 - bits :])


def unpack_bits(packed: np.ndarray, n: int, bits: int) -> np.ndarray:
    wide = np.zeros((n, 32), np.uint8)
    wide[:, 32 - bits :] = np.unpackbits(packed, count=n * bits).reshape(n, bits)
    return np.packbits(wide, axis=1).view(">u4").reshape(n).astype(np.uint32)


def write_shard(doc_ids: np.ndarray, starts: np.ndarray, ids: np.ndarray, bits: int, before: int = 0) -> bytes:
    """``starts``: where each document's ids begin, and the end of the last."""
    blocks = [pack_bits(ids[i : i + BLOCK], bits).tobytes() for i in range(0, len(ids), BLOCK)]
    at = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    head = _HEAD.pack(MAGIC, bits, len(doc_ids), len(ids), len(blocks), before)
    return b"".join([head, doc_ids.astype("<i8").tobytes(), starts.astype("<u8").tobytes(), at.tobytes(), *blocks])


class Shard:
    def __init__(self, image: bytes | memoryview | np.memmap):
        b = np.frombuffer(image, np.uint8)
        magic, self.bits, docs, self.n_ids, blocks, self.before = _HEAD.unpack(b[: _HEAD.size].tobytes())
        if magic != MAGIC:
            raise ValueError("not a token shard")
        o = _HEAD.size
        self.doc_ids = b[o : (o := o + 8 * docs)].view("<i8")
        self.starts = b[o : (o := o + 8 * (docs + 1))].view("<u8").astype(np.int64)
        self.at = b[o : (o := o + 8 * (blocks + 1))].view("<u8").astype(np.int64)
        self.payload = b[o:]

    def read(self, lo: int, hi: int) -> np.ndarray:
        """The ids [lo, hi); touches only their blocks."""
        if hi <= lo:
            return np.zeros(0, np.uint32)
        out = []
        for k in range(lo // BLOCK, -(-hi // BLOCK)):
            n = min(BLOCK, self.n_ids - k * BLOCK)
            out.append(unpack_bits(self.payload[self.at[k] : self.at[k + 1]], n, self.bits))
        return np.concatenate(out)[lo - lo // BLOCK * BLOCK :][: hi - lo]

    def document(self, i: int) -> np.ndarray:
        return self.read(int(self.starts[i]), int(self.starts[i + 1]))


def write_tokens(docs: DataFrame, path: str | None = None, to: str | None = None) -> DataFrame:
    """Encode ``docs`` and write shards in ascending doc_id order; returns the table of shards: part, shard, before (ids in
    the part's earlier shards), n_ids, image. Parts are ranges of doc_id; within one, shards follow each other."""
    path = path or vocabulary("word_bpe_49k.json")
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        bits = max(1, (enc.size - 1).bit_length())
        part = TaskContext.get().partitionId()
        shard, before, held = 0, 0, []

        def flush() -> pa.RecordBatch:
            ids = np.concatenate([h[1] for h in held])
            sizes = np.concatenate([h[2] for h in held])
            image = write_shard(np.concatenate([h[0] for h in held]), np.concatenate([[0], np.cumsum(sizes)]), ids, bits, before)
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (part, shard, before, len(ids))] + [pa.array([image], pa.binary())], ["part", "shard", "before", "n_ids", "image"])

        for b in slices(batches, most=8 << 20):
            ids, at = with_end(*enc.texts(b.column("text")))
            held.append((b.column("_id").to_numpy(), ids, np.diff(at)))
            if (n := sum(len(h[1]) for h in held)) >= SHARD_IDS:
                yield flush()
                shard, before, held = shard + 1, before + n, []
        if held:
            yield flush()

    python_ready(spark)
    ordered = keyed(docs).repartitionByRange(partitions(spark), "_id", "_rk").sortWithinPartitions("_id", "_rk").select("_id", "text")
    return stage(ordered.mapInArrow(run, "part long, shard long, before long, n_ids long, image binary"), "token-shards", to)


def read_tokens(shards: DataFrame) -> DataFrame:
    """_id, start (ids of all documents before it), n_tokens, ids_crc32, read back from shards."""
    spark = shards.sparkSession
    # one row for each part: as many as the writer had partitions, whatever the size of the corpus
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    base, total = {}, 0
    for r in totals:
        base[r["part"]] = total
        total += r["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, image in zip(b.column("part").to_pylist(), b.column("image"), strict=True):
                s = Shard(image.as_buffer())
                ids = s.read(0, s.n_ids).astype("<u4")
                crc = [zlib.crc32(ids[x:y]) for x, y in zip(s.starts[:-1], s.starts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.doc_ids), pa.array(base[part] + s.before + s.starts[:-1], pa.int64()), pa.array(np.diff(s.starts), pa.int64()), pa.array(crc, pa.int64())],
                    ["_id", "start", "n_tokens", "ids_crc32"],
                )

    python_ready(spark)
    return shards.select("part", "image").mapInArrow(run, "_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_files(spark, sf_dir) -> DataFrame:
    """A null or empty text has the end id alone; a null doc_id comes first; repeated rows follow each other."""
    return read_tokens(write_tokens(documents(spark, sf_dir))).select(doc_id(), "start", "n_tokens", "ids_crc32")
