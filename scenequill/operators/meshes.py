"""Mesh text: parse, quantise, sort, print. Poses and masks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_FACES, BINS = 500, 64


def parse_obj(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mesh_id, text) to vertices (mesh_id, vid, x, y, z) and faces (mesh_id, fid, pos, vid), 0-based; other lines are left."""
    lines = files.select("mesh_id", F.posexplode(F.split("text", "\n")).alias("line", "t")).select("mesh_id", "line", F.split(F.trim("t"), "\\s+").alias("p"))
    nth = F.row_number().over(Window.partitionBy("mesh_id").orderBy("line")) - 1
    v = lines.where(F.col("p")[0] == "v").select("mesh_id", nth.cast("long").alias("vid"), *[F.get("p", F.lit(i)).try_cast("double").alias(a) for i, a in ((1, "x"), (2, "y"), (3, "z"))])
    f = lines.where(F.col("p")[0] == "f").select("mesh_id", nth.cast("long").alias("fid"), "p")
    f = f.select("mesh_id", "fid", F.posexplode(F.slice("p", 2, F.size("p") - 1)).alias("pos", "ref"))
    return v, f.select("mesh_id", "fid", F.col("pos").cast("long").alias("pos"), (F.substring_index("ref", "/", 1).try_cast("long") - 1).alias("vid"))


def small_meshes(faces: DataFrame, most: int = MAX_FACES) -> DataFrame:
    return faces.groupBy("mesh_id").agg(F.countDistinct("fid").alias("n")).where(F.col("n") <= most).select("mesh_id")


def quantize(vertices: DataFrame, bins: int = BINS) -> DataFrame:
    """Each axis scaled to its mesh's range and floored to 0..bins-1; a flat axis is 0. Ranges come from one aggregation."""
    r = vertices.groupBy("mesh_id").agg(*[f(a).alias(f"{n}{a}") for a in "xyz" for n, f in (("lo", F.min), ("hi", F.max))])
    q = lambda a: F.when(F.col(f"hi{a}") > F.col(f"lo{a}"), F.floor((F.col(a) - F.col(f"lo{a}")) / (F.col(f"hi{a}") - F.col(f"lo{a}")) * (bins - 1))).otherwise(0).cast("long").alias(a)
    return vertices.join(r, "mesh_id").select("mesh_id", "vid", *[q(a) for a in "xyz"])


def sort_mesh(vertices: DataFrame, faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices by z, faces renumbered to match and ordered by their sorted corners."""
    new = (F.row_number().over(Window.partitionBy("mesh_id").orderBy("z", "vid")) - 1).cast("long")
    v = vertices.withColumn("new", new)
    f = faces.join(v.select("mesh_id", "vid", "new"), ["mesh_id", "vid"]).groupBy("mesh_id", "fid").agg(F.array_sort(F.collect_list(F.struct("pos", "new"))).alias("c"))
    corners = f.select("mesh_id", "fid", F.transform("c", lambda x: x["new"]).alias("c"))
    nth = (F.row_number().over(Window.partitionBy("mesh_id").orderBy(F.array_sort("c"), "fid")) - 1).cast("long")
    return v.select("mesh_id", F.col("new").alias("vid"), "x", "y", "z"), corners.select("mesh_id", nth.alias("fid"), "c")


def mesh_text(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    s = lambda *c: F.concat_ws(" ", *[x.cast("string") for x in c])
    v = vertices.select("mesh_id", F.lit(0).alias("k"), F.col("vid").alias("i"), s(F.lit("v"), F.col("x"), F.col("y"), F.col("z")).alias("t"))
    f = faces.select("mesh_id", F.lit(1).alias("k"), F.col("fid").alias("i"), F.concat(F.lit("f "), F.array_join(F.transform("c", lambda x: (x + 1).cast("string")), " ")).alias("t"))
    lines = v.union(f).groupBy("mesh_id").agg(F.array_sort(F.collect_list(F.struct("k", "i", "t"))).alias("l"))
    return lines.select("mesh_id", F.concat(F.array_join(F.transform("l", lambda x: x["t"]), "\n"), F.lit("\n")).alias("text"))


def turned(x: Column, y: Column, quarter: Column) -> list[Column]:
    """One of the four turns about z."""
    q = F.pmod(quarter, F.lit(4))
    return [F.when(q == 0, x).when(q == 1, -y).when(q == 2, -x).otherwise(y), F.when(q == 0, y).when(q == 1, x).when(q == 2, -y).otherwise(-x)]


def joint_relation(dx: Column, dy: Column) -> Column:
    """Where a is of b, in image coordinates, from b - a: same, or the larger axis decides."""
    same = (F.abs(dx) < 1e-6) & (F.abs(dy) < 1e-6)
    return F.when(same, "same").when(F.abs(dx) >= F.abs(dy), F.when(dx > 0, "left").otherwise("right")).otherwise(F.when(dy > 0, "above").otherwise("below"))


def decode_bins(logits: Column, start: int, n: int) -> Column:
    """Index of the first greatest logit of a slice."""
    s = F.slice(logits, start + 1, n)
    return (F.array_position(s, F.array_max(s)) - 1).cast("long")


def non_maximum(boxes: DataFrame, limit: float = 0.5) -> DataFrame:
    """(image_id, box_id, x1, y1, x2, y2, score) without boxes that overlap a better one: greedy, one image to a group."""

    def keep(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["score", "box_id"], ascending=[False, True])
        b, out = pdf[["x1", "y1", "x2", "y2"]].to_numpy(), []
        area = (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1])
        alive = np.ones(len(b), bool)
        for i in range(len(b)):
            if alive[i]:
                out.append(i)
                lo, hi = np.maximum(b[i, :2], b[:, :2]), np.minimum(b[i, 2:], b[:, 2:])
                inter = np.prod(np.clip(hi - lo, 0, None), 1)
                alive &= inter / np.maximum(area + area[i] - inter, 1e-12) <= limit
        return pdf.iloc[out]

    return boxes.groupBy("image_id").applyInPandas(keep, boxes.schema)


class StubBackend:
    """Stands in for a model: a fixed unit vector from the sum of the input's bytes."""

    def encode(self, images: list[bytes]) -> np.ndarray:
        return np.eye(4, dtype=np.float32)[[sum(i) % 4 for i in images]]


BACKENDS: dict[str, type] = {"stub": StubBackend}


def register_backend(name: str, backend: type) -> None:
    if not isinstance(backend, type):
        raise TypeError("a backend is a class")
    BACKENDS[name] = backend


def embed(images: DataFrame, backend: str = "stub") -> DataFrame:
    """image_id, content to a unit vector; a null or failing image gives null for its own row alone."""
    if backend not in BACKENDS:
        raise ValueError(f"unknown backend {backend}")
    make = BACKENDS[backend]

    @F.pandas_udf("array<float>")
    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for s in it:
            out = []
            for x in s:
                try:
                    out.append(None if x is None else model.encode([x])[0])
                except Exception:  # noqa: BLE001  a failing row is null, as the contract of backends says
                    out.append(None)
            yield pd.Series(out)

    return images.withColumn("embedding", run("content"))
