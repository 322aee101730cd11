"""Masks, depth and boxes in images: pixel tables (scene_id, mask_id, y, x) and columns of numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from .draws import draw

MASK = ["scene_id", "mask_id"]


def on(value: Column, threshold: float = 0.5) -> Column:
    """Whether a mask's pixel is set, for masks of 0/255, of booleans and of shares alike."""
    v = value.cast("double")
    return F.when(v > 1, v / 255).otherwise(v) > threshold


def mask_boxes(masks: DataFrame, pixels: DataFrame) -> DataFrame:
    """Half-open box x1, y1, x2, y2 of each mask in ``masks``; (0, 0, 0, 0) for one without pixels."""
    g = pixels.groupBy(*MASK).agg(F.min("x").alias("x1"), F.min("y").alias("y1"), (F.max("x") + 1).alias("x2"), (F.max("y") + 1).alias("y2"), F.count("*").alias("n"))
    return masks.join(g, MASK, "left").fillna(0, ["x1", "y1", "x2", "y2", "n"])


def not_empty(boxes: DataFrame) -> DataFrame:
    return boxes.where("n > 0")


def crop_square(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column, room: float = 1.1) -> Column:
    """struct<x1,y1,x2,y2> of the square around a box's centre, ``room`` times its longer side, within the image."""
    half = F.floor(F.greatest(x2 - x1, y2 - y1) * room) / 2
    cx, cy = (x1 + x2) / 2, (y1 + y2) / 2
    at = lambda v, most: F.greatest(F.lit(0), F.least(most, F.floor(v))).cast("long")
    return F.struct(at(cx - half, width).alias("x1"), at(cy - half, height).alias("y1"), at(cx + half, width).alias("x2"), at(cy + half, height).alias("y2"))


def box_mask(boxes: DataFrame) -> DataFrame:
    """The pixels of half-open boxes."""
    y = boxes.withColumn("y", F.explode(F.sequence("y1", F.col("y2") - 1)))
    return y.withColumn("x", F.explode(F.sequence("x1", F.col("x2") - 1))).select(*MASK, "y", "x")


def masked_points(pixels: DataFrame, depth: DataFrame, fx: float, fy: float, cx: float, cy: float) -> DataFrame:
    """Points (scene_id, mask_id, x, y, z) of the masks' pixels that have a finite, positive depth (scene_id, y, x, z)."""
    j = pixels.join(depth, ["scene_id", "y", "x"]).where(finite(F.col("z")) & (F.col("z") > 0))
    return j.select(*MASK, ((F.col("x") - cx) * F.col("z") / fx).alias("x"), ((F.col("y") - cy) * F.col("z") / fy).alias("y"), "z")


def without_points(masks: DataFrame, points: DataFrame) -> DataFrame:
    """scene_id, dropped: how many masks of a scene have no points."""
    has = points.select(*MASK).distinct().withColumn("has", F.lit(True))
    return masks.join(has, MASK, "left").groupBy("scene_id").agg(F.count_if(F.col("has").isNull()).alias("dropped"))


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def cloud_of(depth: DataFrame, width: int, height: int, most: float = 10.0) -> DataFrame:
    """Points of a depth map in millimetres (scene_id, y, x, z), without those beyond ``most`` metres or without depth."""
    f = 1.5 * width
    z = F.col("z") / 1000.0
    return depth.where((z > 0) & (z < most)).select("scene_id", ((F.col("x") - width / 2) * z / f).alias("x"), ((F.col("y") - height / 2) * z / f).alias("y"), z.alias("z"))


def depth_at(asked: DataFrame, depth: DataFrame, width: int, height: int) -> DataFrame:
    """``asked`` (scene_id, u, v) with the depth of the nearest pixel, clamped to the image."""
    near = lambda c, n: F.greatest(F.lit(0), F.least(F.lit(n - 1), F.bround(c).cast("int"))).cast("long")
    d = depth.select("scene_id", F.col("y").cast("long").alias("_y"), F.col("x").cast("long").alias("_x"), "z")
    return asked.withColumns({"_x": near(F.col("u"), width), "_y": near(F.col("v"), height)}).join(d, ["scene_id", "_x", "_y"], "left").drop("_x", "_y")


def distance_3d(ax: Column, ay: Column, az: Column, bx: Column, by: Column, bz: Column) -> Column:
    return F.round(F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by) + (az - bz) * (az - bz)), 3)


def polygon_box(flat: Column) -> Column:
    """struct<x1,y1,x2,y2>, one decimal, of a polygon given as x, y, x, y, ...; null for fewer than three corners."""
    part = lambda odd: F.filter(flat, lambda v, i: (i % 2) == odd)
    side = lambda f, odd: F.round(f(part(odd)), 1)
    return F.when(F.size(flat) >= 6, F.struct(side(F.array_min, 0).alias("x1"), side(F.array_min, 1).alias("y1"), side(F.array_max, 0).alias("x2"), side(F.array_max, 1).alias("y2")))


def degenerate(boxes: Column, width: Column, height: Column, share: float = 0.6) -> Column:
    """Whether some box covers more than ``share`` of the image. No boxes: no."""
    return F.exists(boxes, lambda b: (b["x2"] - b["x1"]) * (b["y2"] - b["y1"]) / (width * height) > share)


def confident(boxes: DataFrame, least: float = 0.3) -> DataFrame:
    return boxes.where(F.col("score") >= least)


def corners_of(cx: Column, cy: Column, w: Column, h: Column) -> list[Column]:
    """Centre and size to corners."""
    return [(cx - w / 2).alias("x1"), (cy - h / 2).alias("y1"), (cx + w / 2).alias("x2"), (cy + h / 2).alias("y2")]


def detections(boxes: Column, labels: Column) -> Column:
    """array<struct<x1,y1,x2,y2,label>> with one decimal; a missing label is empty."""
    return F.transform(boxes, lambda b, i: F.struct(*[F.round(b[n], 1).alias(c) for n, c in enumerate(("x1", "y1", "x2", "y2"))], F.coalesce(F.get(labels, i), F.lit("")).alias("label")))


def region_tokens(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    """A region as four location tokens of 0 to 999."""
    at = lambda v, n: F.concat(F.lit("<loc_"), F.floor(v * 999 / n).cast("string"), F.lit(">"))
    return F.concat(at(x1, width), at(y1, height), at(x2, width), at(y2, height))


def model_size(width: Column, height: Column, to: int = 518, step: int = 14) -> Column:
    """struct<width,height> of an image scaled to ``to`` wide, its height a multiple of ``step``, cut to ``to``."""
    h = F.bround(height * to / width / step) * step
    return F.struct(F.lit(to).cast("long").alias("width"), F.least(h, F.lit(to)).cast("long").alias("height"))


def masked_value(value: Column, mask: Column) -> Column:
    return value * F.when(on(mask), 1).otherwise(0)


def medoid(points: DataFrame, k: int) -> DataFrame:
    """scene_id, rank, point_id: the point with the least sum of distances to the others of its scene (rank 0) and the ``k``
    next to it. One scene's points to a group, in blocks."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("point_id")
        p = pdf[["x", "y"]].to_numpy(float)
        total = np.concatenate([np.sqrt(((p[i : i + 512, None] - p[None]) ** 2).sum(2)).sum(1) for i in range(0, len(p), 512)])
        m = int(total.argmin())
        order = np.argsort(((p - p[m]) ** 2).sum(1), kind="stable")
        order = np.concatenate([[m], order[order != m]])[: k + 1]
        return pd.DataFrame({"scene_id": pdf["scene_id"].iloc[0], "rank": np.arange(len(order)), "point_id": pdf["point_id"].to_numpy()[order]})

    return points.groupBy("scene_id").applyInPandas(run, "scene_id long, rank long, point_id long")


def heat_samples(pixels: DataFrame, n: int, percentile: float = 0.95, seed: int = 0) -> DataFrame:
    """Up to ``n`` drawn pixels of each scene's heat map (scene_id, y, x, heat) above its percentile, likelier where it is
    hotter: exponential keys by the softmax weight, the least ``n`` of them."""
    low = pixels.groupBy("scene_id").agg(F.percentile("heat", F.lit(percentile / 100 if percentile > 1 else percentile)).alias("low"), F.max("heat").alias("top"))
    some = pixels.join(low, "scene_id").where("heat >= low")
    u = (draw(1 << 40, F.lit(seed), F.col("scene_id"), F.col("y"), F.col("x")) + 1) / float((1 << 40) + 1)
    keyed = some.withColumn("k", -F.log(u) / F.exp(F.col("heat") - F.col("top")))
    per = keyed.groupBy("scene_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("k", "y", "x", "heat"))), 1, n).alias("p"))
    return per.select("scene_id", F.posexplode("p").alias("rank", "p")).select("scene_id", F.col("rank").cast("long").alias("rank"), "p.y", "p.x", "p.heat")


def without_outliers(points: DataFrame, neighbours: int = 20, ratio: float = 2.0) -> DataFrame:
    """Points whose mean distance to their nearest neighbours is at most the cloud's mean of these plus ``ratio`` deviations.
    One object's points to a group."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf[["x", "y", "z"]].to_numpy(float)
        k = min(neighbours, len(p) - 1)
        if k < 1:
            return pdf
        near = np.concatenate([np.sqrt(np.partition(((p[i : i + 256, None] - p[None]) ** 2).sum(2), k, axis=1)[:, : k + 1]).sum(1) / k for i in range(0, len(p), 256)])
        return pdf[near <= near.mean() + ratio * near.std()]

    return points.groupBy("scene_id", "object_id").applyInPandas(run, points.schema)


def upright(points: DataFrame, least: float = 0.3, within: float = 0.01, rounds: int = 1000, seed: int = 0) -> DataFrame:
    """Clouds (scene_id, point_id, x, y, z) turned so that their main plane is level, and ``canonical``: whether they were. The
    plane is found by drawn triples of points (RANSAC); a cloud whose plane holds at most ``least`` of its points stays. One
    scene to a group; points are tested in blocks of planes."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf[["x", "y", "z"]].to_numpy(float)
        if len(p) < 3:
            return pdf.assign(canonical=False)
        rng = np.random.default_rng(seed)
        three = p[rng.integers(0, len(p), (rounds, 3))]
        normal = np.cross(three[:, 1] - three[:, 0], three[:, 2] - three[:, 0])
        length = np.linalg.norm(normal, axis=1)
        ok = length > 1e-12
        if not ok.any():
            return pdf.assign(canonical=False)
        normal, origin = normal[ok] / length[ok, None], three[ok, 0]
        held = np.concatenate([(np.abs((p @ normal[i : i + 64].T) - (origin[i : i + 64] * normal[i : i + 64]).sum(1)) <= within).mean(0) for i in range(0, len(normal), 64)])
        best = int(held.argmax())
        if held[best] <= least:
            return pdf.assign(canonical=False)
        n = normal[best] * (1 if normal[best][1] >= 0 else -1)
        v, c = np.cross(n, [0.0, 1.0, 0.0]), float(n[1])
        s = np.array([[0, -v[2], v[1]], [v[2], 0, -v[0]], [-v[1], v[0], 0]])
        turn = np.eye(3) + s + s @ s / (1 + c)
        q = (p - origin[best]) @ turn.T * [-1, -1, 1]  # and half a turn about z
        return pdf.assign(x=q[:, 0], y=q[:, 1], z=q[:, 2], canonical=True)

    return points.groupBy("scene_id").applyInPandas(run, StructType([*points.schema.fields, StructField("canonical", BooleanType())]))


def decoded_confidence(logits: Column, start: int) -> Column:
    """The first of two logits as a probability."""
    a, b = F.get(logits, F.lit(start)), F.get(logits, F.lit(start + 1))
    return 1 / (1 + F.exp(b - a))


def angles(logits: Column) -> Column:
    """struct<azimuth,polar,rotation,confidence> of 902 logits: 360 bins, 180 bins from -90, 360 bins from -180, and two."""
    first = lambda s, n: F.array_position(F.slice(logits, s + 1, n), F.array_max(F.slice(logits, s + 1, n))) - 1
    return F.struct(first(0, 360).cast("double").alias("azimuth"), (first(360, 180) - 90).cast("double").alias("polar"), (first(540, 360) - 180).cast("double").alias("rotation"), decoded_confidence(logits, 900).alias("confidence"))


def concatenated(*clouds: DataFrame) -> DataFrame:
    out = clouds[0]
    for c in clouds[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    return out
