"""Points to boxes, boxes to relations. Aggregations with map-side combine, column arithmetic else."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .draws import draw, half_up

AXES = ("x", "y", "z")
OBJECT = ["scene_id", "object_id"]
#: Rows that a task gathers before it looks at the scenes among them; pairs of points whose distances are in memory at a time.
HELD, TILE, WIDE = 1 << 16, 1 << 16, 1 << 10


def objects(points: DataFrame, *more: Column) -> DataFrame:
    """Per object: mean (m*), box centre (c*), extent (e*), volume, number of points. One shuffle."""
    aggs = [f(a).alias(f"{n}{a}") for a in AXES for n, f in (("lo", F.min), ("hi", F.max), ("m", F.avg))]
    g = points.groupBy(*OBJECT).agg(*aggs, F.count("*").alias("n_points"), *more)
    cols = [((F.col(f"lo{a}") + F.col(f"hi{a}")) / 2).alias(f"c{a}") for a in AXES] + [(F.col(f"hi{a}") - F.col(f"lo{a}")).alias(f"e{a}") for a in AXES]
    box = g.select(*OBJECT, *[F.round(f"m{a}", 6).alias(f"m{a}") for a in AXES], *cols, "n_points", *[c for c in g.columns if c not in OBJECT and c[:2] not in ("lo", "hi") and c not in ("mx", "my", "mz", "n_points")])
    return box.withColumn("volume", F.col("ex") * F.col("ey") * F.col("ez"))


def pairs(objs: DataFrame, ordered: bool = True) -> DataFrame:
    """Self-join within a scene: a_*, b_*; ordered pairs, or each pair once."""
    a = objs.select("scene_id", *[F.col(c).alias(f"a_{c}") for c in objs.columns if c != "scene_id"])
    b = objs.select("scene_id", *[F.col(c).alias(f"b_{c}") for c in objs.columns if c != "scene_id"])
    j = a.join(b, "scene_id")
    return j.where(F.col("a_object_id") != F.col("b_object_id") if ordered else F.col("a_object_id") < F.col("b_object_id"))


def _a(c):
    return F.col(f"a_{c}"), F.col(f"b_{c}")


#: name: (statistic, True if the greater one holds). Ties are false.
PREDICATES = {"left": ("mx", False), "right": ("mx", True), "above": ("my", True), "below": ("my", False), "wide": ("ex", True), "thin": ("ex", False),
              "big": ("volume", True), "small": ("volume", False), "tall": ("ey", True), "short": ("ey", False), "behind": ("cz", True), "front": ("cz", False)}
CHOICES = ("left", "right", "above", "below", "tall", "short")


def predicate(name: str) -> Column:
    stat, greater = PREDICATES[name]
    a, b = _a(stat)
    return a > b if greater else a < b


def choice(name: str) -> Column:
    """The object that the relation holds for; ties go to B."""
    return F.when(predicate(name), F.col("a_object_id")).otherwise(F.col("b_object_id"))


def vertical_distance() -> Column:
    a, b = _a("cy")
    return F.abs(a - b)


def horizontal_distance() -> Column:
    (ax, bx), (az, bz) = _a("cx"), _a("cz")
    return F.sqrt((ax - bx) * (ax - bx) + (az - bz) * (az - bz))


def with_human_distance(df: DataFrame, out: str, metres: Column, *key: Column) -> DataFrame:
    """``df`` with ``out``, a length as people would say it, tenfold: "12.5 centimeters". Unit and precision are drawn by a hash
    of ``key``; the value has two decimals, and then 0, 1 or 2 of them unless it is zero or no number. Built in steps of
    columns, as one expression would repeat its parts many times."""
    own = df.columns
    t = df.withColumns({"_m": metres * 10, "_u": draw(10, *key, F.lit("unit")), "_places": draw(3, *key, F.lit("places"))})
    t = t.withColumns({"_first": F.col("_u") < F.when(F.col("_m") < 3, 6).otherwise(7), "_small": F.col("_m") < 1})
    unit = F.when(F.col("_first"), F.when(F.col("_small"), "centimeters").otherwise("meters")).otherwise(F.when(F.col("_small"), "inches").otherwise("feet"))
    factor = F.when(F.col("_first"), F.when(F.col("_small"), 100.0).otherwise(1.0)).otherwise(F.when(F.col("_small"), 39.37).otherwise(3.281))
    t = t.withColumns({"_v": half_up(F.col("_m") * factor, 2), "_unit": unit})
    v, places = F.col("_v"), F.col("_places")
    said = F.when(F.isnan(v) | (v == 0), v).when(places == 0, half_up(v)).when(places == 1, half_up(v, 1)).otherwise(v)
    return t.withColumn(out, F.concat(said.cast("string"), F.lit(" "), "_unit")).select(*[c for c in own if c != out], out)


def _least_squares(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each point of p (three rows of coordinates) the least squared distance to those of q, and the other way; a TILE of pairs at a time."""
    n, m = p.shape[1], q.shape[1]
    own, other = np.full(n, np.inf), np.full(m, np.inf)
    wide = min(m, WIDE)
    high = max(1, TILE // wide)
    for i in range(0, n, high):
        for j in range(0, m, wide):
            d = np.subtract.outer(p[0, i : i + high], q[0, j : j + wide])
            d *= d
            for a in (1, 2):
                e = np.subtract.outer(p[a, i : i + high], q[a, j : j + wide])
                e *= e
                d += e
            np.minimum(own[i : i + high], d.min(1), out=own[i : i + high])
            np.minimum(other[j : j + wide], d.min(0), out=other[j : j + wide])
    return own, other


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by scene, points (x, y, z of object a) and asked pairs (a, b) mixed, to a row for each asked pair of objects with points."""
    names = ["scene_id", "a_object_id", "b_object_id"]

    def scenes(t: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids = pa.chunked_array([*t.column("a_object_id").chunks, *t.column("b_object_id").chunks]).combine_chunks().dictionary_encode()
        code = ids.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        a, b = code[: t.num_rows], code[t.num_rows :]
        xyz = np.stack([t.column(c).to_numpy() for c in AXES])
        rows, found = [], []
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), t.num_rows], strict=True):
            asked = lo + np.flatnonzero(b[lo:hi] >= 0)
            points = lo + np.flatnonzero(b[lo:hi] < 0)
            if not len(asked) or not len(points):
                continue
            points = points[np.argsort(a[points], kind="stable")]
            objects, begin = np.unique(a[points], return_index=True)
            cloud = dict(zip(objects.tolist(), np.split(xyz[:, points], begin[1:], axis=1), strict=True))
            done: dict[tuple[int, int], tuple] = {}
            for i, k, m in zip(asked.tolist(), a[asked].tolist(), b[asked].tolist(), strict=True):
                if k not in cloud or m not in cloud:
                    continue
                if (k, m) not in done:  # both directions come of the same distances
                    for key, square in zip(((k, m), (m, k)), _least_squares(cloud[k], cloud[m]), strict=True):
                        d = np.sqrt(square)
                        done[key] = d.mean(), d.min(), d.max(), len(d)
                rows.append(i)
                found.append(done[k, m])
            if len(rows) >= 10_000:
                yield give(t, rows, found)
                rows, found = [], []
        if rows:
            yield give(t, rows, found)

    def give(t: pa.Table, rows: list[int], found: list[tuple]) -> pa.RecordBatch:
        own = t.select(names).take(pa.array(rows)).combine_chunks()
        cols = [pa.array(c, pa.int64() if k == 3 else pa.float64()) for k, c in enumerate(zip(*found, strict=True))]
        return pa.RecordBatch.from_arrays([*(own.column(c).combine_chunks() for c in names), *cols], [*names, "mean", "least", "greatest", "n"])

    def edges(t: pa.Table) -> np.ndarray:
        scene = pc.dictionary_encode(t.column("scene_id").combine_chunks())
        return np.flatnonzero(np.diff(scene.indices.to_numpy(), prepend=-1))

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < HELD:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        starts = edges(t)
        if len(starts) > 1:
            yield from scenes(t.slice(0, int(starts[-1])).combine_chunks(), starts[:-1])
        t = t.slice(int(starts[-1])).combine_chunks()
        held, rows = t.to_batches(), t.num_rows if t.num_rows < HELD else 0  # a large scene is not looked at with each batch
    if held and (t := pa.Table.from_batches(held).combine_chunks()).num_rows:
        yield from scenes(t, edges(t))


def nearest_distances(points: DataFrame, chosen: DataFrame) -> DataFrame:
    """For each chosen ordered pair (scene_id, a_object_id, b_object_id): mean, least and greatest distance from a point of A
    to its nearest point of B, and the number of A's points. Each point is shuffled once, by its scene, whatever the number of
    pairs; a task holds the points of one scene, or some HELD rows of small ones, as columns of numbers."""
    ship(points.sparkSession)
    kinds = {c: chosen.schema[c].dataType for c in ("scene_id", "a_object_id", "b_object_id")}
    none = lambda kind: F.lit(None).cast(kind)
    p = points.select(F.col("scene_id").cast(kinds["scene_id"]).alias("scene_id"), F.col("object_id").cast(kinds["a_object_id"]).alias("a_object_id"), none(kinds["b_object_id"]).alias("b_object_id"), *[F.col(a).cast("double").alias(a) for a in AXES])
    c = chosen.select("scene_id", "a_object_id", "b_object_id", *[none("double").alias(a) for a in AXES])
    rows = p.where("scene_id IS NOT NULL AND a_object_id IS NOT NULL").union(c.where("scene_id IS NOT NULL AND a_object_id IS NOT NULL AND b_object_id IS NOT NULL"))
    out = ", ".join([f"{k} {v.simpleString()}" for k, v in kinds.items()] + ["mean double", "least double", "greatest double", "n long"])
    return rows.repartition("scene_id").sortWithinPartitions("scene_id").mapInArrow(_near, out)


def oriented_volume(points: DataFrame) -> DataFrame:
    """Volume of the box along the principal axes, and its saving over the axis-aligned one: moments and their eigenvectors
    in one aggregation and one small UDF, then one more aggregation over the projected points."""
    cov = [F.covar_pop(a, b).alias(f"v{a}{b}") for i, a in enumerate(AXES) for b in AXES[i:]]
    stats = points.groupBy(*OBJECT).agg(*cov)

    @F.pandas_udf("array<double>")
    def axes(xx: pd.Series, xy: pd.Series, xz: pd.Series, yy: pd.Series, yz: pd.Series, zz: pd.Series) -> pd.Series:
        m = np.stack([np.stack([xx, xy, xz], 1), np.stack([xy, yy, yz], 1), np.stack([xz, yz, zz], 1)], 1)
        return pd.Series(list(np.linalg.eigh(m)[1].transpose(0, 2, 1).reshape(len(xx), 9)))

    turned = points.join(stats.select(*OBJECT, axes(*[f"v{a}{b}" for i, a in enumerate(AXES) for b in AXES[i:]]).alias("r")), OBJECT)
    proj = [sum((F.col("r")[3 * k + i] * F.col(a) for i, a in enumerate(AXES)), F.lit(0.0)).alias(f"p{k}") for k in range(3)]
    out = turned.select(*OBJECT, *proj, *AXES).groupBy(*OBJECT).agg(
        *[(F.max(c) - F.min(c)).alias(f"o{c}") for c in ("p0", "p1", "p2")], *[(F.max(c) - F.min(c)).alias(f"e{c}") for c in AXES]
    )
    o, e = F.col("op0") * F.col("op1") * F.col("op2"), F.col("ex") * F.col("ey") * F.col("ez")
    return out.select(*OBJECT, o.alias("oriented_volume"), e.alias("aligned_volume"), (1 - F.try_divide(o, e)).alias("saving"))


def unproject(u: Column, v: Column, z: Column, fx: float, fy: float, cx: float, cy: float) -> list[Column]:
    return [((u - cx) * z / fx).alias("x"), ((v - cy) * z / fy).alias("y"), z.alias("z")]


def relation_2d(dx: Column, dy: Column, band: float = 10.0) -> Column:
    """Where b is, seen from a: both halves always, "aligned" within the band."""
    h = F.when(dx < -band, "left of").when(dx > band, "right of").otherwise("horizontally aligned with")
    v = F.when(dy < -band, "above").when(dy > band, "below").otherwise("vertically aligned with")
    return F.concat(h, F.lit(" and "), v, F.lit(" a"))


def cloud_distances(points: DataFrame, chosen: DataFrame) -> DataFrame:
    """Least, mean and greatest over the nearest-point distances of both directions of each chosen pair, taken together."""
    both = chosen.select("scene_id", "a_object_id", "b_object_id", F.explode(F.array(F.lit(False), F.lit(True))).alias("back"))
    way = both.select("scene_id", F.when(F.col("back"), F.col("b_object_id")).otherwise(F.col("a_object_id")).alias("a_object_id"), F.when(F.col("back"), F.col("a_object_id")).otherwise(F.col("b_object_id")).alias("b_object_id")).distinct()
    d = nearest_distances(points, way)
    pair = lambda x: (F.least("a_object_id", "b_object_id") if x == "a" else F.greatest("a_object_id", "b_object_id")).alias(f"{x}_object_id")
    each = d.groupBy("scene_id", pair("a"), pair("b"))
    return each.agg(F.min("least").alias("least"), (F.sum(F.col("mean") * F.col("n")) / F.sum("n")).alias("mean"), F.max("greatest").alias("greatest"))


def focal_length(k: Column) -> Column:
    """The focal length of a camera matrix, array<array<double>> or a batch of them: its first element."""
    return F.get(F.get(k, F.lit(0)), F.lit(0))


def box_bounds(centre: Column, extent: Column) -> Column:
    """struct<low,high> of a box given as two arrays of three."""
    half = lambda s: F.zip_with(centre, extent, lambda c, e: c + s * e / 2)
    return F.struct(half(-1).alias("low"), half(1).alias("high"))


def taller(a_extent: Column, b_extent: Column) -> Column:
    return a_extent[1] > b_extent[1]


def larger(a_extent: Column, b_extent: Column) -> Column:
    volume = lambda e: e[0] * e[1] * e[2]
    return volume(a_extent) > volume(b_extent)
