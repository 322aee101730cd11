"""Packing documents into fixed windows by minimum bin slack.

Documents become ids plus an end id, cut into pieces of at most a window. How many pieces there are of each length is all
that planning needs: at most 2048 numbers, whatever the size of the corpus. Over this histogram a bitset subset-sum dynamic
programme (one bit for each reachable fill, multiplicities by binary splitting) finds the multiset of remaining lengths
that fills a window closest to capacity; walking back through the bitsets gives how many of each length it takes. The
pattern is repeated as long as the counts allow. Where even the best multiset leaves slack and pieces remain, one piece is
cut to fill it, and its rest returns to the histogram, so that a corpus of one hot length packs as well as any other.

The plan maps ranks of equal-length pieces to windows. The task that cuts documents numbers its pieces of each length; a
piece's rank is that number plus the count of such pieces in earlier tasks. So ranks need no sort, no length's pieces meet in
one task, and ids travel once, to join the few numbers that say where they go.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import data, doc_id, documents, keyed, offsets, slices, python_ready, stage
from .tokens import encoder, vocabulary, with_end

WINDOW = 2048


def best_fill(count: dict[int, int], window: int) -> dict[int, int]:
    """How many of each length fill a window closest to capacity."""
    mask, reach, steps = (1 << (window + 1)) - 1, 1, []
    for length in sorted(count, reverse=True):
        left, k = min(count[length], window // length), 1
        while left:
            take = min(k, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, k = left - take, k * 2
        if reach >> window & 1:
            break
    fill, out = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> fill & 1:
            fill -= length * take
            out[length] = out.get(length, 0) + take
    return out


def plan(histogram: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Rows of (length, first rank, pieces, depth, cut from, fragment length, index of the first, a window's share k, first
    sequence, offset): the ranks [first, first + pieces) of that length have a fragment in sequence (first sequence + i // k)
    at offset + i % k * fragment length, where i runs from the index. ``depth`` numbers a piece's fragments."""
    # segments of a class: (piece length, first rank, pieces, cut from, depth)
    segments = {n: [(n, 0, c, 0, 0)] for n, c in histogram.items() if c}
    count = {n: c for n, c in histogram.items() if c}
    rows, sequence = [], 0

    def take(length: int, n: int) -> list[tuple]:
        out, have = [], segments[length]
        count[length] -= n
        while n:
            src, rank, c, cut, depth = have.pop()
            use = min(n, c)
            out.append((src, rank, use, cut, depth))
            if use < c:
                have.append((src, rank + use, c - use, cut, depth))
            n -= use
        if not count[length]:
            del count[length], segments[length]
        return out

    def give(length: int, got: list[tuple], k: int, offset: int, size: int) -> None:
        i = 0
        for src, rank, n, cut, depth in got:
            rows.append((src, rank, n, depth, cut, size, i, k, sequence, offset))
            i += n

    while count:
        pattern = best_fill(count, window)
        slack = window - sum(n * k for n, k in pattern.items())
        donor = max((n for n in count if count[n] > pattern.get(n, 0)), key=lambda n: (count[n] - pattern.get(n, 0), n), default=None) if slack else None
        need = {n: k + (n == donor) for n, k in pattern.items()} | ({donor: pattern.get(donor, 0) + 1} if donor else {})
        times = min(count[n] // k for n, k in need.items())
        offset = 0
        for n, k in sorted(pattern.items(), reverse=True):
            give(n, take(n, k * times), k, offset, n)
            offset += n * k
        if donor:
            got = take(donor, times)
            give(donor, got, 1, offset, slack)
            rest = donor - slack
            segments.setdefault(rest, []).extend((src, rank, n, cut + slack, depth + 1) for src, rank, n, cut, depth in got)
            count[rest] = count.get(rest, 0) + times
        sequence += times
    return np.array(rows, np.int64).reshape(-1, 10)


class Places:
    """A plan by rank: one sorted table for each depth."""

    def __init__(self, rows: np.ndarray):
        self.tables = []
        for depth in range(int(rows[:, 3].max()) + 1 if len(rows) else 0):
            t = rows[rows[:, 3] == depth]
            self.tables.append(t[np.lexsort((t[:, 1], t[:, 0]))])

    def find(self, length: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each depth: which pieces have such a fragment, and columns (cut from, size, sequence, offset)."""
        for t in self.tables:
            key = t[:, 0] * (1 << 48) + t[:, 1]
            at = np.searchsorted(key, length * (1 << 48) + rank, "right") - 1
            row = t[np.maximum(at, 0)]
            ok = (at >= 0) & (row[:, 0] == length) & (rank < row[:, 1] + row[:, 2])
            row, i = row[ok], rank[ok] - row[ok][:, 1] + row[ok][:, 6]
            yield np.flatnonzero(ok), np.stack([row[:, 4], row[:, 5], row[:, 8] + i // row[:, 7], row[:, 9] + i % row[:, 7] * row[:, 5]], 1)


def pieces(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """piece (a number), part, nth (of its length in its part), _id, start, length, doc_tokens, ids (little-endian, 2 bytes each
    where the vocabulary allows)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        kind = "<u2" if enc.size <= 1 << 16 else "<u4"
        part, made, seen = TaskContext.get().partitionId(), 0, np.zeros(window + 1, np.int64)
        for b in slices(batches, most=8 << 20):
            ids, at = with_end(*enc.texts(b.column("text")))
            n = np.diff(at)
            parts = -(-n // window)
            doc = np.repeat(np.arange(len(n)), parts)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = nth * window
            length = np.minimum(window, n[doc] - start)
            raw = ids.astype(kind)
            bounds = np.append(at[doc] + start, at[-1]) * raw.itemsize
            packed = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(raw.tobytes())])
            order = np.argsort(length, kind="stable")
            run = np.concatenate([[True], np.diff(length[order]) > 0])
            nth = np.zeros(len(doc), np.int64)
            nth[order] = np.arange(len(doc)) - np.maximum.accumulate(np.where(run, np.arange(len(doc)), 0))
            nth += seen[length]
            seen += np.bincount(length, minlength=window + 1)
            for i in range(0, len(doc), 4000):
                s = slice(i, i + 4000)
                piece = (part << 33) + made + np.arange(i, i + len(doc[s]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(piece), pa.array(np.full(len(piece), part)), pa.array(nth[s]), b.column("_id").take(pa.array(doc[s])), pa.array(start[s]), pa.array(length[s]), pa.array(n[doc[s]]), packed[s]],
                    ["piece", "part", "nth", "_id", "start", "length", "doc_tokens", "ids"],
                )
            made += len(doc)

    python_ready(docs.sparkSession)
    return keyed(docs).mapInArrow(cut, "piece long, part long, nth long, _id long, start long, length long, doc_tokens long, ids binary")


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece: _id, start, length, doc_tokens, ids, ids_crc32, sequence_id, offset.

    Every document has at least its end id. Repeated rows are packed once each; which of two pieces of one length gets which
    place follows the order of the input's files, all else is fixed by the rows. All sequences but the last are full."""
    path = path or vocabulary("byte_bpe_50k.json")
    spark = docs.sparkSession
    cut = stage(pieces(docs, path, window), "pieces")
    counts = stage(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row for each length, so at most ``window``
    places = Places(plan(histogram, window))
    # a row for each length and task
    below = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = stage(counts.select("length", "part", below.alias("base")), "piece-bases")
    ranks = cut.select("piece", "length", "part", "nth").join(bases.hint("merge"), ["length", "part"]).select("piece", (F.col("base") + F.col("nth")).cast("long").alias("rank"))
    ranked = cut.join(stage(ranks, "piece-ranks").hint("merge"), "piece")
    shared = spark.sparkContext.broadcast(places)  # its size depends on the window, not on the corpus

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            length, rank, start = (b.column(c).to_numpy() for c in ("length", "rank", "start"))
            o, raw = offsets(b.column("ids")), data(b.column("ids"))
            size = (o[1:] - o[:-1]) // length
            kind = "<u2" if size[0] == 2 else "<u4"
            for which, f in shared.value.find(length, rank):
                if not len(which):
                    continue
                lo = o[which] + f[:, 0] * size[which]
                hi = lo + f[:, 1] * size[which]
                ids = [raw[x:y].view(kind).astype("<u4") for x, y in zip(lo, hi, strict=True)]
                at = pa.array(which)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("_id").take(at), pa.array(start[which] + f[:, 0]), pa.array(f[:, 1]), b.column("doc_tokens").take(at),
                        pa.array([raw[x:y].tobytes() for x, y in zip(lo, hi, strict=True)], pa.binary()), pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(f[:, 2]), pa.array(f[:, 3]),
                    ],
                    ["_id", "start", "length", "doc_tokens", "ids", "ids_crc32", "sequence_id", "offset"],
                )

    return ranked.select("_id", "start", "length", "doc_tokens", "ids", "rank").mapInArrow(put, "_id long, start long, length long, doc_tokens long, ids binary, ids_crc32 long, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids: the pieces of each sequence joined in order (at most a window's, so a bounded group)."""
    parts = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", "n_tokens", F.expr("aggregate(p, X'', (a, x) -> concat(a, x.ids))").alias("ids"))


def op4_packing(spark, sf_dir) -> DataFrame:
    """All documents in sequences of 2048 tokens, by ``pack``. A null or empty text is its end id alone; texts of any length are
    cut where windows end; repeated rows are packed once each; an empty table gives no rows; other columns are not read."""
    return pack(documents(spark, sf_dir)).select(doc_id(), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
