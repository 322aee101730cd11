"""Suffix-array dedup of repeated byte strings.

Every byte goes that lies in a string of ``length`` bytes which also begins earlier in the corpus. No suffix array of the
whole corpus is built; equal strings are brought together first:

1. Winnowing: of the K-byte grams of every ``length``-byte window the one with the least hash is the window's anchor. Equal
   windows have equal anchors at equal places, so a window can only repeat if its anchor does. One shuffle of anchor
   hashes, streamed in sorted order, leaves the places of repeated anchors. Documents whose whole text came before go
   whole and take no further part.
2. Each such place sends its context, the bytes of the windows that it is the anchor of, to the anchor's hash. Sorted by
   (anchor, context, place), copies follow each other: all but the first of equal contexts are covered whole and stream
   through, so a passage of any number of copies takes no memory.
3. Distinct contexts of an anchor are cut to the parts whose window hashes come twice, which loses no equal windows. Of
   these a suffix array is built (linear grouping by Lyndon prefixes), in blocks of many anchors. Neighbouring suffixes that
   agree on ``length`` bytes are one class, and all its members but the earliest mark their bytes.
4. Contexts of an anchor that are too many for a block go into a further round under longer keys: its windows are parted by where
   in them the anchor lies, and what all windows of a part have in common is their key. Parts get narrower from round to round;
   in the last a key is a whole window, and equal ones follow each other as in 2. No group has to fit into a task.
5. Marks are united per document and the bytes that stay are hashed.

An anchor that holds a large share of all rows, known from a sample, is dealt by text as well: of its equal contexts all but the
first in each part are covered, and the firsts meet in the next round. The sample decides how rows are dealt, never what goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import data, doc_id, documents, free_shuffles, hot_keys, keyed, offsets, partitions, python_ready, ranges, slices, stage
from .lyndon_suffix_array import suffix_array

K = 32
#: Bytes of contexts in a suffix array, and of one key's distinct contexts before they go on under longer keys; widths of the parts.
BLOCK, MOST_CONTEXTS = 1 << 17, 1 << 20
WIDTHS = (18, 5, 1)
CHUNK = 1 << 23  # of a very long text
WHOLE = 1 << 62  # end of the span of a later copy


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """64-bit hashes of the K-byte grams at each place (K is a power of two), by doubling."""
    h, width = b.astype(np.uint64) + np.uint64(1), 1
    while width < K:
        h = h[: len(h) - width] * np.uint64(0x9E3779B97F4A7C15) + (h[width:] ^ (h[width:] >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        width *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(31))


def anchors(b: np.ndarray, o: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts ``b[o[i]:o[i + 1]]``: places of the anchors, ascending, their hashes, and the starts of the first and
    the last window that each is the anchor of (those between are, too)."""
    none = np.zeros(0, np.int64)
    if len(b) < length:
        return none, none.view(np.uint64), none, none
    if len(b) > CHUNK + 2 * length:
        parts = []
        for lo in range(0, len(b) - length + 1, CHUNK):
            hi = min(len(b), lo + CHUNK + length)
            inner = np.unique(np.clip(o, lo, hi)) - lo
            p, h, first, last = anchors(b[lo:hi], inner, length)
            parts.append((p + lo, h, first + lo, last + lo))
        at, h, first, last = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(at, kind="stable")
        begin = np.flatnonzero(np.diff(at[order], prepend=-1)) if len(at) else none
        return at[order][begin], h[order][begin], np.minimum.reduceat(first[order], begin) if len(at) else none, np.maximum.reduceat(last[order], begin) if len(at) else none
    h = gram_hashes(b)
    w = length - K + 1
    # least (hash, place): the place breaks ties, leftmost first
    m = (h & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= w:
        m = np.minimum(m[: len(m) - width], m[width:])
        width *= 2
    if width < w:
        m = np.minimum(m[: len(m) - (w - width)], m[w - width :])
    inside = np.zeros(len(b) + 1, np.int64)  # windows that lie within one text
    size = np.diff(o)
    long = size >= length
    inside[o[:-1][long]] += 1
    inside[o[1:][long] - length + 1] -= 1
    start = np.flatnonzero(np.cumsum(inside)[: len(m)] > 0)
    own = (m[start] & np.uint64((1 << 24) - 1)).astype(np.int64)
    begin = np.flatnonzero(np.diff(own, prepend=-1))
    at = own[begin]
    return at, h[at], start[begin], start[np.append(begin[1:], len(own)) - 1] if len(own) else none


def _docs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for b in slices(batches, most=2 << 20):
        o = offsets(b.column("text"))
        yield b, data(b.column("text"))[int(o[0]) : int(o[-1])], o - o[0]


HOT = 1 << 15


def _pack(pos: np.ndarray, before: np.ndarray, more: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Place of an anchor, how far before it its first window begins, how many windows follow that one, and whether it is hot."""
    return pos << 32 | before << 16 | hot.astype(np.int64) * HOT | more


def anchor_rows(docs: DataFrame, length: int, hot: np.ndarray, salts: int) -> DataFrame:
    """h, salt (-1 but for hot anchors; equal texts have equal ones), _id, _rk, pos (packed)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, raw, o in _docs(batches):
            at, h, first, last = anchors(raw, o, length)
            h, doc = h.view(np.int64), np.searchsorted(o, at, "right") - 1
            which = np.isin(h, hot) if len(hot) else np.zeros(len(h), bool)
            rk = b.column("_rk").to_numpy()[doc]
            salt = np.where(which, rk % salts, -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(salt), b.column("_id").take(pa.array(doc)), pa.array(rk), pa.array(_pack(at - o[doc], at - first, last - first, which))], ["h", "salt", "_id", "_rk", "pos"])

    return keyed(docs).mapInArrow(find, "h long, salt int, _id long, _rk long, pos long")


def repeated_anchors(docs: DataFrame, length: int) -> DataFrame:
    """_id, _rk, places array<long> (packed) of the anchors that come at two places at least. Of equal texts only the first
    document counts."""

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the last row so far: not yet given out, unless its hash came before
        came = False
        for t in batches:
            if not t.num_rows:
                continue
            if last is not None:
                t = pa.Table.from_batches([last, t]).combine_chunks().to_batches()[0]
            h, s, r, p = (t.column(c).to_numpy() for c in ("h", "salt", "_rk", "pos"))
            fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1]) | (p[1:] != p[:-1])])
            if not fresh.all():  # the same place of an equal text
                t, h, s = t.filter(pa.array(fresh)), h[fresh], s[fresh]
            again = np.concatenate([[False], (h[1:] == h[:-1]) & (s[1:] == s[:-1])])
            held = last is not None and came
            keep = again | (s >= 0)
            keep[:-1] |= again[1:]
            if held:
                keep[0] = False  # given out with its batch
            came = bool(again[-1]) or s[-1] >= 0 or (held and len(h) == 1)
            # the last row goes out now if it repeats a former one or is hot, else it waits
            if not again[-1] and s[-1] < 0:
                keep[-1] = False
            yield t.filter(pa.array(keep)).select(["_id", "_rk", "pos"])
            last = t.slice(t.num_rows - 1)

    spark = docs.sparkSession
    python_ready(spark)
    p = partitions(spark)
    hot = hot_keys(anchor_rows(docs.sample(0.02, 7), length, np.zeros(0, np.int64), 1), "h")
    found = anchor_rows(docs, length, hot, p).repartition(p, "h", "salt").sortWithinPartitions("h", "salt", "_rk", "pos", "_id")
    places = stage(found.mapInArrow(repeated, "_id long, _rk long, pos long"), "repeated-anchors")
    free_shuffles(spark)
    return places.groupBy("_id", "_rk").agg(F.collect_list("pos").alias("places"))


def _cut(raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(raw[ranges(begin, size)])])


def _contexts(length: int, salts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            o, raw = offsets(b.column("text")), data(b.column("text"))
            v = b.column("places").flatten().to_numpy()
            doc = np.repeat(np.arange(b.num_rows), pc.list_value_length(b.column("places")).to_numpy())
            for part in range(0, len(v), 4000):
                d, x = doc[part : part + 4000], v[part : part + 4000]
                at, before, size = x >> 32, x >> 16 & 65535, (x & (HOT - 1)) + length
                rk = b.column("_rk").to_numpy()[d]
                salt = np.where(x & HOT, rk % salts, -1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [_cut(raw, o[d] + at, np.full(len(d), K)), pa.array(salt), _cut(raw, o[d] + at - before, size), b.column("_id").take(pa.array(d)), pa.array(rk), pa.array(at - before), pa.array(before.astype(np.int32))],
                    ["gram", "salt", "ctx", "_id", "_rk", "start", "at"],
                )

    return run


def shared_parts(raw: np.ndarray, begin: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which contexts ``raw[begin:begin + size]`` have a window whose hash comes twice, and the part of each from its first
    such window to the end of its last: nothing outside these can repeat."""
    h = gram_hashes(raw)
    count = size - length + 1
    start = ranges(begin, count)
    w = np.zeros(len(start), np.uint64)
    for j in {*range(0, length - K, K), length - K}:
        w = w * np.uint64(0x9E3779B97F4A7C15) + h[start + j]
    order = np.argsort(w)
    same = w[order][1:] == w[order][:-1]
    twice = np.zeros(len(w), bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    hit = np.flatnonzero(twice)
    which = np.repeat(np.arange(len(begin)), count)[hit]
    edge = np.flatnonzero(np.diff(which, prepend=-1))
    ends = np.append(edge[1:], len(which)) - 1
    return (which[edge], start[hit[edge]], start[hit[ends]] + length) if len(hit) else (which, which, which)


def class_marks(contexts: list[bytes], places: list[tuple[int, int, int]], length: int) -> list[tuple[int, int, int]]:
    """(context, begin, end): windows of the contexts (first found at ``places``: _id, _rk, start) that come earlier."""
    text = bytearray()
    begin = []
    for c in contexts:
        begin.append(len(text))
        text += c
        text.append(0)
    sizes = np.array([len(c) for c in contexts])
    begin = np.array(begin)
    sa = np.array(suffix_array(bytes(text)), np.int64)
    which = np.searchsorted(begin, sa, "right") - 1
    inside = sa - begin[which] + length <= sizes[which]
    sa, which = sa[inside], which[inside]
    if len(sa) < 2:
        return []
    raw = np.frombuffer(bytes(text), np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(raw, length)
    same = np.concatenate([(windows[sa[i : i + 65536]][: len(sa) - 1 - i] == windows[sa[i + 1 : i + 65537]]).all(1) for i in range(0, len(sa) - 1, 65536)])
    cls = np.concatenate([[0], np.cumsum(~same)])
    place = np.array(places, np.int64)[which]
    start = place[:, 2] + sa - begin[which]
    order = np.lexsort((start, place[:, 1], place[:, 0], cls))
    first = np.concatenate([[True], cls[order][1:] != cls[order][:-1]])
    lead = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    later = (start[order] != start[lead]) | (place[order, 0] != place[lead, 0]) | (place[order, 1] != place[lead, 1])
    hit = order[later]
    w, at = which[hit], sa[hit] - begin[which[hit]]
    order = np.lexsort((at, w))
    w, at = w[order], at[order]
    if not len(w):
        return []
    new = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (at[1:] != at[:-1] + 1)]))
    ends = np.append(new[1:], len(w)) - 1
    return list(zip(w[new].tolist(), at[new].tolist(), (at[ends] + length).tolist(), strict=True))


ROW = {"key": "long", "salt": "int", "ctx": "binary", "_id": "long", "_rk": "long", "start": "long", "at": "int"}
OUT = ROW | {"begin": "long", "end": "long"}


def narrowed(t: pa.Table, length: int, width: int) -> pa.RecordBatch:
    """Contexts as rows of ROW under longer keys: of each, its windows parted by how far before the anchor they begin, ``width``
    of these distances to a part; the key is the hash of the bytes that all windows of such a part have in common."""
    from xxhash import xxh64_intdigest as h

    rows: dict[str, list] = {c: [] for c in ROW}
    for c, i, r, s, at in zip(*(t.column(x).to_pylist() for x in ("ctx", "_id", "_rk", "start", "at")), strict=True):
        count = len(c) - length + 1
        for near in range(max(0, at - count + 1) // width * width, at + 1, width):
            far = near + width - 1  # windows begin near .. far bytes before the anchor
            lo, hi = max(0, at - far), min(count - 1, at - near)
            if lo <= hi:
                key = h(c[at - near : at - far + length], near + 1)
                for name, x in zip(ROW, (key - (key >> 63 << 64), -1, c[lo : hi + length], i, r, s + lo, at - lo), strict=True):
                    rows[name].append(x)
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[ROW[c]]) for c, v in rows.items()], list(ROW))


def _marks(length: int, width: int | None, most_contexts: int = MOST_CONTEXTS):
    """Rows of ROW sorted by (key, salt, ctx, _id, _rk, start) to marks (begin and end set) and rows for a further round: firsts of
    salted keys, and contexts of crowded keys in parts of ``width`` (None: there is no further round)."""

    def marks(i: np.ndarray, r: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
        n = len(i)
        none = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
        cols = {c: pa.nulls(n, none[k]) for c, k in ROW.items()} | {"_id": pa.array(i), "_rk": pa.array(r), "begin": pa.array(begin), "end": pa.array(end)}
        return pa.RecordBatch.from_arrays([cols[c] for c in OUT], list(OUT))

    def onward(t: pa.RecordBatch | pa.Table) -> pa.RecordBatch:
        cols = [t.column(c) for c in ROW]
        cols = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols]
        return pa.RecordBatch.from_arrays([*cols, *[pa.nulls(t.num_rows, pa.int64())] * 2], list(OUT))

    def passed(t: pa.Table) -> Iterator[pa.RecordBatch]:
        for i in range(0, t.num_rows, 2000):
            yield onward(narrowed(t.slice(i, 2000), length, width))

    def of_block(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key = t.column("key").to_numpy()
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(begin, len(key)))
        ctx = t.column("ctx").combine_chunks()
        o = offsets(ctx)
        held = o[np.append(begin[1:], len(key))] - o[begin]
        many = np.repeat((held > most_contexts) & (width is not None), size)
        if many.any():
            yield from passed(t.filter(pa.array(many)))
        some = np.flatnonzero(np.repeat(size > 1, size) & ~many)
        if not len(some):
            return
        raw = data(ctx)
        which, x, y = shared_parts(raw, o[:-1][some], np.diff(o)[some], length)
        if not len(which):
            return
        at = some[which]
        i, r, s = (t.column(c).to_numpy()[at] for c in ("_id", "_rk", "start"))
        s = s + x - o[at]
        hits = class_marks([raw[u:v].tobytes() for u, v in zip(x, y, strict=True)], list(zip(i.tolist(), r.tolist(), s.tolist(), strict=True)), length)
        if hits:
            c, u, v = np.array(hits, np.int64).T
            yield marks(i[c], r[c], s[c] + u, s[c] + v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # key, salt and context of the last row
        crowded = None  # the key whose contexts are passed on
        pending: list[pa.RecordBatch] = []
        held = 0
        for b in batches:
            if not b.num_rows:
                continue
            key, salt, ctx = b.column("key").to_numpy(), b.column("salt").to_numpy(), b.column("ctx")
            new = np.ones(b.num_rows, bool)
            new[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1]) | ~pc.equal(ctx[1:], ctx[:-1]).to_numpy(zero_copy_only=False)
            new[0] = last is None or (key[0], salt[0]) != last[0] or ctx[0].as_py() != last[1]
            place = np.stack([b.column(c).to_numpy() for c in ("_id", "_rk", "start")], 1)
            nth = np.cumsum(new) - 1 + (not new[0])
            first = np.concatenate([np.zeros((0, 3), np.int64) if new[0] else last[2][None], place[new]])
            last = (key[-1], salt[-1]), ctx[-1].as_py(), first[-1]
            # an equal context comes before: the whole of it goes, unless it is that of a row which repeats the first
            again = ~new & (place != first[nth]).any(1)
            if again.any():
                i, r, s = place[again].T
                yield marks(i, r, s, s + np.diff(offsets(ctx))[again])
            if (first := new & (salt >= 0)).any():
                yield onward(b.filter(pa.array(first)))
            b = b.filter(pa.array(new & (salt < 0)))
            if crowded is not None:
                more = int((b.column("key").to_numpy() == crowded).sum())
                yield from passed(pa.Table.from_batches([b.slice(0, more)]))
                b = b.slice(more)
                if b.num_rows:
                    crowded = None
            pending.append(b)
            o = offsets(b.column("ctx"))
            held += int(o[-1] - o[0])
            if held >= BLOCK:
                t = pa.Table.from_batches(pending).combine_chunks()
                key = t.column("key").to_numpy()
                cut = int(np.argmax(key == key[-1]))
                if cut:
                    yield from of_block(t.slice(0, cut).combine_chunks())
                t = t.slice(cut).combine_chunks()
                if t.column("ctx").nbytes > most_contexts and width is not None:
                    yield from passed(t)
                    crowded, t = int(key[-1]), t.slice(0, 0)
                pending, held = t.to_batches(), 0
        if pending and (t := pa.Table.from_batches(pending).combine_chunks()).num_rows:
            yield from of_block(t)

    return run


def later_copies(docs: DataFrame) -> DataFrame:
    """_id, _rk of the documents whose whole text an earlier document has. Digests are shuffled, no texts; both sides of the
    join are shuffled, so that adaptive execution can split a group of very many copies."""
    own = keyed(docs).select("_id", "_rk", F.xxhash64(F.lit(11), "text").alias("h2"), F.octet_length("text").alias("n"))
    first = own.groupBy("_rk", "h2", "n").agg(F.min("_id").alias("first"), F.count("*").alias("m")).where("m > 1")
    own = stage(own, "text-digests")
    return own.join(stage(first, "first-copies"), ["_rk", "h2", "n"]).where("_id <> first").select("_id", "_rk")


def repeated_spans(docs: DataFrame, length: int = 100) -> DataFrame:
    """_id, _rk, spans array<struct<b,e>>: byte ranges that go, not yet united."""
    spark = docs.sparkSession
    places = repeated_anchors(docs, length)
    p = partitions(spark)
    ctx = keyed(docs).join(places.hint("merge"), ["_id", "_rk"]).select("_id", "_rk", "text", "places").mapInArrow(_contexts(length, p), "gram binary, salt int, ctx binary, _id long, _rk long, start long, at int")
    rows = ctx.select(F.xxhash64("gram").alias("key"), *list(ROW)[1:])
    found, kinds = None, ", ".join(f"{c} {k}" for c, k in OUT.items())
    for n, width in enumerate([*WIDTHS, None]):
        ordered = rows.repartition(p, "key", "salt").sortWithinPartitions("key", "salt", "ctx", "_id", "_rk", "start")
        out = stage(ordered.mapInArrow(_marks(length, width), kinds), f"repeat-marks{n}")
        free_shuffles(spark)
        new = out.where("begin IS NOT NULL").select("_id", "_rk", "begin", "end")
        found = new if found is None else found.union(new)
        rest = out.where("begin IS NULL")
        if not rest.take(1):
            break
        # firsts of hot keys meet under their own key; contexts of crowded ones have longer keys by now
        rows = rest.select("key", F.lit(-1).alias("salt"), *list(ROW)[2:])
    copies = later_copies(docs).select("_id", "_rk", F.lit(0).cast("long").alias("begin"), F.lit(WHOLE).cast("long").alias("end"))
    spans = found.union(copies)
    return spans.groupBy("_id", "_rk").agg(F.collect_set(F.struct(F.col("begin").alias("b"), F.col("end").alias("e"))).alias("spans"))


def united(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted((s["b"], s["e"]) for s in spans):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((b, e))
    return out


def whole(spans: list[tuple[int, int]], n: int, length: int) -> list[tuple[int, int]]:
    """The spans within a text of n bytes; that of a later copy covers all of it, or nothing of a text under ``length``."""
    return [(b, min(e, n)) for b, e in spans] if n >= length else []


def suffix_dedup(docs: DataFrame, length: int = 100) -> DataFrame:
    """One row per row: _id, n_bytes, n_removed, spans (maximal removed byte ranges, flat: begin, end, ...), kept (the bytes
    that stay, perhaps cut within a character). Rows that repeat doc_id and text are one document, so each keeps what it
    keeps; texts shorter than ``length`` stay whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column("text").cast(pa.binary()).to_pylist()
            spans = [whole(united(s or []), len(t), length) for s, t in zip(b.column("spans").to_pylist(), texts, strict=True)]
            kept = []
            for t, sp in zip(texts, spans, strict=True):
                edges = [0, *(x for s in sp for x in s), len(t)]
                kept.append(b"".join(t[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(map(len, texts), pa.int64()), pa.array([sum(y - x for x, y in s) for s in spans], pa.int64()), pa.array([[x for y in s for x in y] for s in spans], pa.list_(pa.int64())), pa.array(kept, pa.binary())],
                ["_id", "n_bytes", "n_removed", "spans", "kept"],
            )

    spans = repeated_spans(docs, length)
    both = keyed(docs).join(spans.hint("merge"), ["_id", "_rk"], "left").select("_id", "text", "spans")
    return both.mapInArrow(run, "_id long, n_bytes long, n_removed long, spans array<long>, kept binary")


def op2_suffix_dedup(spark, sf_dir) -> DataFrame:
    """Every whole text of documents as bytes, by ``suffix_dedup`` with 100 bytes. A null text has no bytes; very long texts go
    through in chunks; rows that repeat doc_id and text are one document; an empty table gives no rows; other columns are not
    read."""
    out = suffix_dedup(documents(spark, sf_dir), 100)
    return out.select(doc_id(), "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
