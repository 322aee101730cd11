"""SimHash near-dedup with deletion-variant signatures.

Two 64-bit fingerprints that differ in at most three bits have a half (of 32 bits) in which they differ in at most one.
Each distinct fingerprint is indexed under the 64 variants of its halves with one bit struck out; equality of a variant
makes candidates, which are then verified. Copies share a fingerprint and are reduced to one before any of this.

Variants are shuffled and sorted by key, and each task streams its runs. In a run of up to SMALL fingerprints all pairs are
compared (a constant for each member); in a longer one only a spanning forest of the links is given out, so a group's
output stays linear in its size. A run beyond LARGE goes back to be indexed again, by variants of the bits that are still
free, which bounds runs after two more levels by 2^11.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, distinct_rows, doc_id, documents, keyed, partitions, python_ready, slices, stage
from .components import components

SMALL, LARGE, RADIUS = 48, 2048, 3


def shingle_hashes(words: list[bytes], n: int) -> list[int]:
    """Unsigned XXH64, seed 42, of the n-word shingles; of all words where there are fewer; nothing of none."""
    from xxhash import xxh64_intdigest as h

    if not words:
        return []
    if len(words) < n:
        return [h(b" ".join(words), 42)]
    return [h(b" ".join(s), 42) for s in zip(*(words[i:] for i in range(n)), strict=False)]


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half the hashes; zero without hashes. Signed."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):  # a long text's bits are counted piece by piece
        ones += np.unpackbits(hashes[i : i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def by_text(docs: DataFrame, f: Callable[[bytes], list[int]]) -> DataFrame:
    """_id, _rk and an array of 64-bit fingerprints of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_rk"), pa.array([f(t) for t in texts], pa.list_(pa.int64()))], ["_id", "_rk", "fps"])

    python_ready(docs.sparkSession)
    return keyed(docs).mapInArrow(run, "_id long, _rk long, fps array<long>")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64))


def _forest(fp: np.ndarray, node: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among a run's members."""
    order = np.argsort(fp, kind="stable")
    fp, node = fp[order], node[order]
    same = np.flatnonzero(fp[1:] == fp[:-1])
    out = list(zip(node[same].tolist(), node[same + 1].tolist(), strict=True))
    first = np.concatenate([[True], fp[1:] != fp[:-1]])
    fp, node = fp[first], node[first]
    todo = np.ones(len(fp), bool)
    for root in range(len(fp)):
        if not todo[root]:
            continue
        todo[root], front = False, [root]
        while front:
            i = front.pop()
            near = np.flatnonzero(todo & (_popcount(fp ^ fp[i]) <= radius))
            todo[near] = False
            out += [(int(node[i]), int(node[j])) for j in near]
            front += near.tolist()
    return out


def _shared_code(x: np.ndarray) -> np.ndarray:
    """The first of the variants 0..63 that fingerprints with difference ``x`` share: the key under which their link is
    given out, once."""
    low, high = x & 0xFFFFFFFF, (x >> 32) & 0xFFFFFFFF
    bit = lambda y: np.where(y == 0, 0, np.log2(np.maximum(y, 1)).astype(np.int64))
    return np.where(_popcount(low) <= 1, bit(low), 32 + bit(high))


def _link(radius: int, first: bool, last: bool) -> Callable:
    """Sorted (key, fp, node) to links (u, v, null) and, of runs that are too long, members (key, node, fp)."""

    def emit(u: list, v: list, hot: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (u, v, hot)], ["u", "v", "hot"])

    def runs_of(key: np.ndarray, fp: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(begin, len(key)))
        keep = np.repeat((size > 1) & (size <= SMALL), size)
        k, f, n = key[keep], fp[keep], node[keep]
        d = 1
        us, vs = [], []
        while d < len(k) and d < SMALL:
            same = k[d:] == k[:-d]
            if not same.any():
                break
            x = f[d:] ^ f[:-d]
            near = same & (_popcount(x) <= radius)
            if first:
                near[near] = _shared_code(x[near]) == (k[d:][near] >> 32) & 63
            us.append(n[:-d][near])
            vs.append(n[d:][near])
            d += 1
        if us:
            yield emit(np.concatenate(us), np.concatenate(vs), [None] * sum(map(len, us)))
        for i in np.flatnonzero(size > SMALL):
            s = slice(begin[i], begin[i] + size[i])
            if size[i] > LARGE and not last:
                yield emit(key[s], node[s], fp[s])
            elif pairs := _forest(fp[s], node[s], radius):
                yield emit([p[0] for p in pairs], [p[1] for p in pairs], [None] * len(pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 3
        handed = None  # the key of a long run whose members are being passed on
        for b in batches:
            cols = [np.concatenate([r, b.column(c).to_numpy()]) for r, c in zip(rest, ("key", "fp", "node"), strict=True)]
            if not len(cols[0]):
                continue
            if handed is not None:
                end = int(np.searchsorted(cols[0], handed, "right"))
                if end:
                    yield emit(cols[0][:end], cols[2][:end], cols[1][:end])
                cols = [c[end:] for c in cols]
                if not len(cols[0]):
                    rest = cols
                    continue
                handed = None
            cut = int(np.searchsorted(cols[0], cols[0][-1]))
            yield from runs_of(*(c[:cut] for c in cols)) if cut else ()
            rest = [c[cut:] for c in cols]
            if len(rest[0]) > LARGE and not last:
                handed = rest[0][0]
                yield emit(rest[0], rest[2], rest[1])
                rest = [c[:0] for c in rest]
        if len(rest[0]):
            yield from runs_of(*rest)

    return run


def _variants(fp: Column, key: Column | None, width: int, parts: int, salt: Column) -> Column:
    """Keys of ``parts`` segments of ``width`` bits, each with one bit struck out."""
    out = []
    for p in range(parts):
        lo, mask = p * width, (1 << width) - 1
        seg = F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit(mask))
        for j in range(width):
            rest = seg.bitwiseAND(F.lit(mask & ~(1 << j)))
            out.append(F.shiftleft(salt.cast("long"), 38) + F.lit((p * 32 + j) << 32) + rest if key is None else F.xxhash64(key, salt, F.lit(lo * 64 + j), rest))
    return F.array(*out)


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``node``, ``fp``, ``tab`` (fingerprints of different tables are not compared) to staged links ``u``, ``v``: together
    they connect exactly what fingerprints within ``radius`` (at most 3) connect."""
    spark = nodes.sparkSession
    python_ready(spark)
    # few distinct fingerprints lie in few files, but each makes 64 rows: they are spread before
    nodes = nodes.select("node", "fp", "tab").repartition(partitions(spark))
    at = nodes.select("node", "fp", F.explode(_variants(F.col("fp"), None, 32, 2, F.col("tab"))).alias("key"))
    out, empty = None, spark.createDataFrame([], "u long, v long")
    for level in range(3):
        found = at.select("key", "fp", "node").repartition(partitions(spark), "key").sortWithinPartitions("key", "fp")
        found = stage(found.mapInArrow(_link(radius, level == 0, level == 2), "u long, v long, hot long"), f"links{level}")
        new = found.where("hot IS NULL").select("u", "v")
        out = new if out is None else out.union(new)
        hot = found.where("hot IS NOT NULL").select(F.col("u").alias("key"), F.col("v").alias("node"), F.col("hot").alias("fp"))
        if not hot.take(1):
            break
        # within radius 3 some quarter, then some eighth, of the fingerprint differs in at most one bit
        keys = _variants(F.col("fp"), F.col("key"), 16 >> level, 4 << level, F.lit(level))
        at = hot.select("node", "fp", F.explode(keys).alias("key"))
    return empty if out is None else out


def op5_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged fingerprints (_id, _rk, fp) of 3-word shingles, and fp -> component_id."""

    def simhash(text: bytes) -> list[int]:
        return [fingerprint(np.array(shingle_hashes(text.lower().split(), 3), np.uint64))]

    rows = stage(by_text(docs, simhash).select("_id", "_rk", F.col("fps")[0].alias("fp")), "simhash")
    groups = rows.groupBy("fp").agg(F.min("_id").alias("first"))
    roots = components(links(groups.select(F.col("fp").alias("node"), "fp", F.lit(0).alias("tab")))).withColumnRenamed("node", "fp")
    # only fingerprints in links need a join; each of the others is its own component
    linked = groups.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    ids = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows, linked.join(ids, "root").select("fp", "component_id")


def op5_simhash_near_dedup(spark, sf_dir) -> DataFrame:
    """Null and empty texts have fingerprint zero; repeated rows get equal rows."""
    rows, component = op5_links(documents(spark, sf_dir))
    out = rows.join(component.hint("merge"), "fp")
    return out.select(doc_id(), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.nullif(F.col("component_id"), F.lit(NO_ID)).alias("component_id"))


# --- as a stage ---

#: A pair of near copies has at least this Jaccard similarity (numerator, denominator) of its sets of SHINGLE-word runs.
SHINGLE, ALIKE = 5, (4, 5)
#: Fingerprints whose 16-bit bands make candidates, and further ones, of which candidates may differ in at most NEAR bits
#: (at similarity 0.8 about 19 of 128 differ). Runs of up to FEW compare all pairs at once.
TABLES, CHECKS, NEAR, FEW, BLOCK = 16, 2, 32, 16, 4096
#: Share of the bits of all fingerprints in which candidates across the groups found so far may differ: over three standard
#: deviations above the 0.151 of a similarity of 0.8, so that texts far less alike are not brought together.
MOST_DIFFER = 0.185


def shingle_set(text: bytes) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text.lower().split(), SHINGLE), np.uint64))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return ALIKE[1] * both >= ALIKE[0] * (len(a) + len(b) - both)


def table_fingerprints(text: bytes, tables: int = TABLES + CHECKS) -> list[int]:
    """Fingerprints of the set of shingles, whose hashes are scrambled anew for each table."""
    h = shingle_set(text)
    if not len(h):
        return [0] * tables
    ones = np.zeros(64 * tables, np.int64)
    by = (np.arange(tables, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    for i in range(0, len(h), 255):  # so many fit a byte's count
        x = h[i : i + 255, None] * by
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        x *= by
        x ^= x >> np.uint64(31)
        ones += np.add.reduce(np.unpackbits(x.view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(h), bitorder="little").view("<i8").tolist()


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, fps to a row for each 16-bit band: key, node and two check fingerprints."""
    for b in batches:
        for i in range(0, b.num_rows, 500):
            part = b.slice(i, 500)
            fps = np.array(part.column("fps").to_pylist(), np.int64)
            values = np.ascontiguousarray(fps[:, :-CHECKS]).view(np.uint16).astype(np.int64)
            n = values.shape[1]
            key = (np.arange(n) << 16) + values
            out = [key.ravel(), *(np.repeat(x, n) for x in (part.column("node").to_numpy(), fps[:, -2], fps[:, -1]))]
            yield pa.RecordBatch.from_arrays([*map(pa.array, out)], BAND)


BAND = ["key", "node", "c0", "c1"]


def _differ(c0: np.ndarray, c1: np.ndarray, d0: np.ndarray, d1: np.ndarray) -> np.ndarray:
    return _popcount(c0 ^ d0) + _popcount(c1 ^ d1)


def _far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows of fingerprints differ in a larger share of all bits than those of texts that are alike."""
    return np.bitwise_count(x ^ y).sum(1, dtype=np.int64) > MOST_DIFFER * 64 * x.shape[1]


def _centre(c: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(c.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(2 * bits.sum(0, dtype=np.int64) > len(c)).view("<i8")


def _tree(node: np.ndarray, c0: np.ndarray, c1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the candidates of a long run. Members nearest to the run's centre are roots first: a text that the
    others were made from is likelier to be alike to them than they are to one another."""
    if len(node) <= BLOCK:
        busy = np.concatenate([(_differ(c0[i : i + 256, None], c1[i : i + 256, None], c0, c1) <= NEAR).sum(1) > 1 for i in range(0, len(node), 256)])
        node, c0, c1 = node[busy], c0[busy], c1[busy]
    if not len(node):
        return node, node
    order = np.argsort(_differ(c0, c1, _centre(c0), _centre(c1)), kind="stable")
    node, c0, c1 = node[order], c0[order], c1[order]
    us, vs, todo = [], [], np.ones(len(node), bool)
    for root in range(len(node)):
        if not todo[root]:
            continue
        todo[root], front = False, [root]
        while front and todo.any():
            i = front.pop(0)
            rest = np.flatnonzero(todo)
            near = rest[_differ(c0[rest], c1[rest], c0[i], c1[i]) <= NEAR]
            todo[near] = False
            us.append(np.full(len(near), node[i]))
            vs.append(node[near])
            front += near.tolist()
    return (np.concatenate(us), np.concatenate(vs)) if us else (node[:0], node[:0])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key to candidates u, v, long: all pairs of a short run, a spanning forest of a long one."""

    def emit(u: np.ndarray, v: np.ndarray, long: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v)), pa.array(np.full(len(u), int(long), np.int64))], ["u", "v", "long"])

    def runs_of(key: np.ndarray, node: np.ndarray, c0: np.ndarray, c1: np.ndarray) -> Iterator[pa.RecordBatch]:
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(begin, len(key)))
        keep = np.repeat((size > 1) & (size <= FEW), size)
        k, n, x, y = (c[keep] for c in (key, node, c0, c1))
        for d in range(1, FEW):
            same = np.flatnonzero(k[d:] == k[:-d])
            if not len(same):
                break
            near = same[_differ(x[same], y[same], x[same + d], y[same + d]) <= NEAR]
            if len(near):
                yield emit(n[near], n[near + d], False)
        for i in np.flatnonzero(size > FEW):
            s = slice(begin[i], begin[i] + size[i])
            u, v = _tree(node[s], c0[s], c1[s])
            if len(u):
                yield emit(u, v, True)

    held: list[list[np.ndarray]] = []  # rows that may belong to a run which goes on
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(c).to_numpy() for c in BAND]
        if cols[0][-1] != (held[0][0][0] if held else cols[0][0]) or not held and cols[0][-1] != cols[0][0]:
            cut = int(np.searchsorted(cols[0], cols[0][-1]))
            yield from runs_of(*(np.concatenate([*(h[i] for h in held), c[:cut]]) for i, c in enumerate(cols)))
            held, cols = [], [c[cut:] for c in cols]
        held.append(cols)
    if held:
        yield from runs_of(*(np.concatenate([h[i] for h in held]) for i in range(len(BAND))))


def _found(nodes: DataFrame, name: str) -> DataFrame:
    """Staged, distinct candidates u, v, long of ``nodes`` (node, fps)."""
    spark = nodes.sparkSession
    rows = nodes.mapInArrow(_bands, "key long, node long, c0 long, c1 long")
    rows = rows.repartition(partitions(spark), "key").sortWithinPartitions("key")
    return stage(rows.mapInArrow(_candidates, "u long, v long, long long").groupBy("u", "v").agg(F.max("long").alias("long")), name)


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tree (node, label, fps, own) to links u, v: of all pairs of a tree those that are alike and that neither their
    labels nor links before have connected. A pair is verified where it is found, so rows are fewer than nodes."""

    def links_of(rows: list[dict]) -> pa.RecordBatch:
        every = np.array([x["fps"] for x in rows], np.int64).view(np.uint64)
        own = [np.frombuffer(x["own"], np.uint64) for x in rows]
        label = np.unique([x["label"] for x in rows], return_inverse=True)[1]
        us, vs = [], []
        for i in range(len(rows) - 1):
            j = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
            for k in j[~_far(every[i : i + 1], every[j])].tolist():
                if label[k] != label[i] and alike(own[i], own[k]):
                    us.append(rows[i]["node"])
                    vs.append(rows[k]["node"])
                    label[label == label[k]] = label[i]
        return pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    held: list[dict] = []
    for b in batches:
        for x in b.to_pylist():
            if held and held[0]["tree"] != x["tree"]:
                yield links_of(held)
                held = []
            held.append(x)
    if held:
        yield links_of(held)


def _verified(candidates: DataFrame, nodes: DataFrame, docs: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Staged candidates u, v with ``ok``: whether their texts are alike. ``nodes``: node, _id, _rk. Also the staged sets (node, own)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            own = [shingle_set(t).tobytes() for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(own, pa.binary())], ["node", "own"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, z = (b.column(c).to_pylist() for c in ("a", "z"))
            ok = [alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, z, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("u"), b.column("v"), pa.array(ok, pa.bool_())], ["u", "v", "ok"])

    ids = candidates.select(F.col("u").alias("node")).union(candidates.select("v")).distinct()
    texts = keyed(docs).join(ids.join(nodes, "node"), ["_id", "_rk"]).select("node", "text").dropDuplicates(["node"])
    own = stage(texts.mapInArrow(sets, "node long, own binary"), f"{name}-sets")
    a, z = own.select(F.col("node").alias("u"), F.col("own").alias("a")), own.select(F.col("node").alias("v"), F.col("own").alias("z"))
    return stage(candidates.join(a, "u").join(z, "v").select("u", "v", "a", "z").mapInArrow(judge, "u long, v long, ok boolean"), name), own


def near_links(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``nodes`` (node, fps, _id, _rk) to links u, v that connect what candidates of at least ALIKE connect.

    Long runs first give a spanning forest, whose links are verified. Where one of a tree's links does not hold, all pairs of its
    nodes that links have not connected are compared, in one place: two nodes of a long run that could be alike are always
    in one tree. So no row is made for a pair, and a large group costs rows as it has members."""
    first = _found(nodes.select("node", "fps"), "near-candidates")
    judged, own = _verified(first.select("u", "v"), nodes.select("node", "_id", "_rk"), docs, "near-judged")
    links = judged.where("ok").select("u", "v")
    forest = first.where("long = 1")
    failed = forest.join(judged.where("NOT ok"), ["u", "v"])
    if not failed.take(1):
        return links
    of = forest.select(F.col("u").alias("node")).union(forest.select("v")).distinct()
    trees = of.join(components(forest.select("u", "v")), "node", "left").select("node", F.coalesce("root", "node").alias("tree"))
    open_trees = trees.join(failed.select(F.col("u").alias("node")).distinct(), "node").select("tree").distinct()
    labels = trees.join(open_trees, "tree").join(components(links), "node", "left").select("node", "tree", F.coalesce("root", "node").alias("label"))
    rows = labels.join(nodes.select("node", "fps"), "node").join(own, "node").select("tree", "node", "label", "fps", "own")
    rows = rows.repartition(partitions(docs.sparkSession), "tree").sortWithinPartitions("tree", "node")
    return links.union(stage(rows.mapInArrow(_within, "u long, v long"), "near-within"))


def near_dedup(docs: DataFrame, tables: int = TABLES) -> DataFrame:
    """The rows of ``docs`` that stay, all their columns: of each group of near copies the one with the smallest doc_id.

    Texts are linked when at least 0.8 of their five-word shingles, as sets, agree. Candidates are texts that share one of the
    four bands of one of ``tables`` fingerprints; each is verified. Texts without words are alike, and repeated rows are copies."""
    spark = docs.sparkSession
    rows = by_text(docs, lambda t: table_fingerprints(t, tables + CHECKS)).withColumn("node", F.monotonically_increasing_id())
    rows = stage(rows, "table-simhash")
    # equal in all tables: one node for the lot
    same = rows.groupBy("fps").agg(F.min(F.struct("_id", "_rk", "node")).alias("top")).withColumn("node", F.col("top.node"))
    roots = components(near_links(same.select("node", "fps", "top._id", "top._rk"), docs))
    linked = same.join(roots, "node", "left").select("fps", "top", F.coalesce("root", "node").alias("root"))
    stay = linked.groupBy("root").agg(F.min("top").alias("first")).select("first._id", "first._rk")
    return distinct_rows(docs, stay)
